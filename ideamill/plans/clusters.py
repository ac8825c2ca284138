"""Ideas clustered per company and labelled from model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.operators.clustering import RESTARTS, ROUNDS, SEED, cluster_groups
from ideamill.operators.labels import chunk_ideas, description_or_solution, label_ideas
from ideamill.operators.lookup import look_up, new_records
from ideamill.operators.numbering import surrogate_keys
from ideamill.plans.export import idea_vectors
from ideamill.schemas import VECTOR_COLUMNS
from ideamill.settings import FIT_POINTS, VECTOR_SIZE
from ideamill.sources.tables import written

GROUP = ["company_id", "cluster_number"]


def clustered_ideas(dim_idea: DataFrame, fact: DataFrame, loaded: DataFrame,
                    size: int = VECTOR_SIZE, as_text: bool = False,
                    columns: list[str] = VECTOR_COLUMNS, restarts: int = RESTARTS,
                    rounds: int = ROUNDS, seed: int = SEED, block_points: int = FIT_POINTS
                    ) -> DataFrame:
    """Ideas not clustered yet with their cluster and distance, per company; written once."""
    ideas = idea_vectors(
        new_records(dim_idea, loaded, "idea_db_id"), fact, size, as_text, columns)
    found = cluster_groups(
        ideas, "company_id", "combined_emb", restarts, rounds, seed, block_points)
    return written(found.select(
        "idea_db_id", "company_id", "goal_id", "cluster_number", "distance_centroid", "name",
        "description", "solution_1"), "clustered")


def ideas_to_label(clustered: DataFrame) -> DataFrame:
    """Clustered ideas with the text to label, their index and their chunk."""
    text = description_or_solution(F.col("solution_1"), F.col("description"))
    return chunk_ideas(clustered.withColumn("description", text), GROUP, ["idea_db_id"])


def labelled_rows(chunked: DataFrame, answers: DataFrame, dim_idea: DataFrame,
                  loaded: DataFrame) -> DataFrame:
    """Rows to append to the table of clustered ideas."""
    labelled = label_ideas(chunked, answers, GROUP)
    found = look_up(labelled, dim_idea, {"idea_db_id": "idea_db_id"}, "id", "idea_id")
    rows = found.select(
        "idea_id", "idea_db_id", "company_id", "goal_id", "idea_c_name", "idea_c_description",
        "cluster_name", "cluster_description", "cluster_number", "distance_centroid",
        "final_cluster_name")
    return surrogate_keys(
        new_records(rows, loaded, "idea_db_id"), loaded, ["idea_db_id", "idea_c_name"])
