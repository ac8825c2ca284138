"""Vectors of ideas as records for a vector index, in numbered batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.functions.vectors import mean_of_valid, text_to_vector
from ideamill.operators.lookup import look_up, new_records
from ideamill.operators.numbering import batch_number
from ideamill.operators.reshape import keep_first
from ideamill.schemas import VECTOR_COLUMNS
from ideamill.settings import EXPORT_BATCH, VECTOR_SIZE


def idea_vectors(dim_idea: DataFrame, fact: DataFrame, size: int = VECTOR_SIZE,
                 as_text: bool = False, columns: list[str] = VECTOR_COLUMNS) -> DataFrame:
    """Ideas with their submission keys and ``combined_emb``, the mean of their valid vectors.

    Ideas without any valid vector are left out.
    """
    # A submission loaded twice must not double a vector's id.
    keys = keep_first(fact.select("idea_id", "goal_id", "company_id"), ["idea_id"], ["goal_id", "company_id"])
    vectors = [text_to_vector(F.col(c)) if as_text else F.col(c) for c in columns]
    kept = [c for c in dim_idea.columns if c not in columns]
    return (
        dim_idea.withColumnRenamed("id", "idea_id").withColumn(
            "combined_emb", mean_of_valid(vectors, size))
        .where("combined_emb IS NOT NULL")
        .join(keys, "idea_id", "left")
        .select(*["idea_id" if c == "id" else c for c in kept], "goal_id", "company_id",
                "combined_emb")
    )


def vector_records(ideas: DataFrame, companies: DataFrame, goals: DataFrame,
                   exported: DataFrame, rows: int = EXPORT_BATCH) -> DataFrame:
    """Records ``id``, ``values``, ``metadata`` not exported yet, with their ``batch_no``."""
    with_company = look_up(ideas, companies, {"company_id": "id"}, "company_db_id",
                           "company_db_id", unique=True)
    with_goal = look_up(with_company, goals, {"goal_id": "id"}, "goal_db_id", "goal_db_id",
                        unique=True)
    records = with_goal.select(
        F.col("idea_db_id").cast("string").alias("id"),
        F.col("combined_emb").alias("values"),
        F.struct("idea_db_id", "company_db_id", "goal_db_id").alias("metadata"),
        F.col("idea_db_id").alias("_order"))
    new = new_records(records, exported, "id")
    return batch_number(new, ["_order"], rows).drop("_order")
