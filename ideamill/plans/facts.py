"""The submission fact: one row per idea with its ranked contributors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.functions.values import known_key, timestamp_or
from ideamill.operators.lookup import look_up, new_records
from ideamill.operators.numbering import running_number, surrogate_keys
from ideamill.operators.reshape import members_json
from ideamill.settings import (
    HOT_GROUP_ROWS, MEMBERS_PER_CELL, NULL_SUBMIT_TIMESTAMP, USER_COLUMNS,
)


def ranked_contributors(contributions: DataFrame, users: DataFrame,
                        hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Contributors (``idea_id``, ``user_id``, ``user_key``) numbered in an idea by user."""
    numbered = running_number(
        contributions.select("idea_id", "user_id"), ["idea_id"], ["user_id"], "user_num",
        hot_rows)
    return look_up(numbered, users, {"user_id": "user_db_id"}, "id", "user_key")


def contributor_columns(ranked: DataFrame, per_cell: int = MEMBERS_PER_CELL) -> DataFrame:
    """Per idea: ``user_id_1`` .. ``user_id_4`` and the first JSON cell, in one shuffle."""
    first = [
        F.max(F.when(F.col("user_num") == i, F.col("user_key"))).alias(f"user_id_{i}")
        for i in range(1, USER_COLUMNS + 1)
    ]
    member = F.struct(
        "user_num", F.concat(F.lit("user_id_"), F.col("user_num")).alias("key"), "user_key")
    held = (F.col("user_num") <= per_cell) & F.col("user_key").isNotNull()
    entries = F.transform(
        F.array_sort(F.collect_list(F.when(held, member))),
        lambda m: F.struct(m["key"].alias("key"), m["user_key"].alias("value")))
    return ranked.groupBy("idea_id").agg(
        *first, F.to_json(F.map_from_entries(entries)).alias("users"))


def more_contributors(ranked: DataFrame, per_cell: int = MEMBERS_PER_CELL) -> DataFrame:
    """Further JSON cells (1, 2, ...) of ideas with more contributors than one cell holds."""
    return members_json(
        ranked.where(F.col("user_num") > per_cell), "idea_id", "user_num", "user_key",
        "user_id", "users", per_cell)


def submission_members(contributions: DataFrame, users: DataFrame, dim_idea: DataFrame,
                       per_cell: int = MEMBERS_PER_CELL, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """The members table next to the fact: every contributor of every idea, in cells 0, 1, ...

    ``users`` of the fact is cell 0; an idea with more contributors goes on in further cells, so
    that no row holds an unbounded group and no contributor is lost.
    """
    cells = members_json(ranked_contributors(contributions, users, hot_rows), "idea_id", "user_num", "user_key", "user_id",
                         "users", per_cell).withColumnRenamed("idea_id", "idea_db_id")
    found = look_up(cells, dim_idea, {"idea_db_id": "idea_db_id"}, "id", "idea_id")
    return found.where("idea_id IS NOT NULL").select("idea_id", "cell", "users")


def submission_fact(stage: DataFrame, contributions: DataFrame, users: DataFrame,
                    dim_idea: DataFrame, hot_rows: int = HOT_GROUP_ROWS,
                    per_cell: int = MEMBERS_PER_CELL) -> DataFrame:
    """Submissions with warehouse keys; ideas that are not in the dimension are left out.

    Load submission_members() with it: that table holds the contributors beyond the first cell.
    """
    wide = contributor_columns(ranked_contributors(contributions, users, hot_rows), per_cell)
    wide = wide.withColumnRenamed("idea_id", "idea_db_id")
    found = look_up(stage, dim_idea, {"idea_db_id": "idea_db_id"}, "id", "idea_id")
    joined = found.where("idea_id IS NOT NULL").join(wide, "idea_db_id", "left")
    keys = [f"user_id_{i}" for i in range(1, USER_COLUMNS + 1)]
    return joined.select(
        "idea_id", known_key(F.col("company_id")).alias("company_id"),
        *[known_key(F.col(k)).alias(k) for k in keys], "users",
        known_key(F.col("goal_id")).alias("goal_id"),
        timestamp_or(F.col("submitted_at"), NULL_SUBMIT_TIMESTAMP).alias("submitted_at"))


def submission_rows(fact: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows to append to the fact: ideas that are not in it yet."""
    return surrogate_keys(new_records(fact, loaded, "idea_id"), loaded, ["idea_id"])
