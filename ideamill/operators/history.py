"""Validity columns and the default member of a dimension."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.settings import DEFAULT_GOAL, OPEN_DATE


def validity(df: DataFrame, run: date | datetime, open_end: str | None = None) -> DataFrame:
    """Add ``valid_from`` (the run), ``valid_to`` (open) and ``is_current``."""
    end = F.lit(open_end) if open_end else F.lit(OPEN_DATE)
    return df.withColumns({
        "valid_from": F.lit(run).cast("timestamp"),
        "valid_to": end.cast("timestamp"),
        "is_current": F.lit(True),
    })


def with_default_goal(goals: DataFrame) -> DataFrame:
    """The goals dimension with the member that stands for 'no goal'."""
    schema = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in goals.schema.fields
        if f.name in DEFAULT_GOAL
    )
    row = goals.sparkSession.createDataFrame(
        [tuple(DEFAULT_GOAL[c] for c in goals.columns if c in DEFAULT_GOAL)], schema)
    return goals.unionByName(row, allowMissingColumns=True)
