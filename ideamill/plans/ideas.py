"""Field classification table and the wide idea dimension."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ideamill import schemas
from ideamill.functions.text import keep_listed_columns
from ideamill.functions.values import (
    compact_left, known_key, moment_of, normalise_missing, not_blank, timestamp_or,
)
from ideamill.functions.vectors import vector_to_text
from ideamill.operators.embedding import (
    classify_by_keywords, classify_fields, embed_texts, text_digest, unseen_texts,
)
from ideamill.operators.history import validity
from ideamill.operators.lookup import known_rows, look_up, new_records
from ideamill.operators.numbering import surrogate_keys
from ideamill.operators.reshape import pivot_first
from ideamill.plans.forms import answers_of_companies, idea_attributes
from ideamill.settings import LOOKUP_MISS, MAX_TIMESTAMP, SMALL_TABLE_BYTES, UNUSED_CATEGORIES
from ideamill.sources.tables import append_rows, written


def new_answers(answers: DataFrame, fields: DataFrame, ideas: DataFrame, companies: DataFrame,
                dim_idea: DataFrame) -> DataFrame:
    """Cleaned answers of known companies whose idea is not loaded yet.

    Loaded ideas are dropped first, and each table is cleaned before the joins repeat its texts.
    """
    loaded = dim_idea.select(F.col("idea_db_id").alias("idea_id"))
    unseen = new_records(answers, loaded, "idea_id")
    return answers_of_companies(
        keep_listed_columns(unseen), keep_listed_columns(fields), keep_listed_columns(ideas),
        companies)


def class_table_rows(answers: DataFrame, loaded: DataFrame,
                     classify: Callable[[Column, Column], Column] = classify_by_keywords
                     ) -> DataFrame:
    """Rows to append to the classification table: fields that are not in it yet."""
    fields = classify_fields(
        new_records(answers, loaded, ["company_id", "field_id"]),
        ["field_id", "title", "description"], classify)
    return surrogate_keys(fields, loaded, ["company_id", "field_id"])


def categorised_answers(answers: DataFrame, class_table: DataFrame) -> DataFrame:
    """Answers with the category of their field, without the unused categories."""
    known = known_rows(answers, class_table, {"company_id": "company_id"})
    found = look_up(
        known, class_table, {"company_id": "company_id", "title": "name"}, "category",
        "category", default=F.lit(LOOKUP_MISS), order="id")
    return found.where(~F.col("category").isin(*UNUSED_CATEGORIES))


def wide_ideas(answers: DataFrame, vectors: DataFrame | None, attributes: DataFrame) -> DataFrame:
    """One row per idea: attributes, six problems, six solutions and the digests of their vectors.

    ``answers`` carry a category, ``vectors`` map text digests to vectors, ``attributes`` hold
    one row per idea. The pivot and all that follows sees digests; with_vectors() puts vectors in
    their place. Without ``vectors`` the digests are NULL. The rows are a plan: a consumer of a few
    columns computes no more, several consumers write it first.
    """
    if vectors is None:
        marked = answers.withColumn("known", F.lit(None).cast("string"))
    else:
        known = vectors.where("vector IS NOT NULL").select(F.col("digest").alias("known")).distinct()
        key = F.when(not_blank(F.col("field_answer")), text_digest(F.col("field_answer")))
        marked = answers.withColumn("_digest", key).join(known, F.col("_digest") == F.col("known"), "left")
    per_idea = pivot_first(
        marked.withColumns({
            "name": F.col("idea_name"), "description": F.col("field_answer"),
            "category_name": F.col("category")}),
        ["idea_id"], "category_name", ["field_id"],
        {"field_answer": schemas.TEXT_COLUMN_OF, "known": schemas.VECTOR_COLUMN_OF},
        others=["company_id", "name", "description", "category", "created_at", "updated_at"],
        ties={"known": "field_answer"})
    joined = per_idea.join(attributes, "idea_id", "left").withColumnRenamed("idea_id", "idea_db_id")
    return compact_left(normalise_missing(joined), schemas.FAMILIES)


def with_vectors(wide: DataFrame, vectors: DataFrame, small_bytes: int = SMALL_TABLE_BYTES) -> DataFrame:
    """The written wide rows with vectors for the digests in their vector columns.

    The vector table is measured first. Up to ``small_bytes`` it is sent to the tasks, and each slot looks its
    vector up in place. Beyond, a slot meets its vector by digest and an idea's slots come back as one list, so
    that vectors move once. Of several vectors of a digest the greatest counts.
    """
    known = vectors.where("vector IS NOT NULL").groupBy("digest").agg(F.max("vector").alias("vector"))
    size = vectors.agg(F.coalesce(F.sum(8 * F.size("vector") + F.length("digest")), F.lit(0))).first()[0]
    if size <= small_bytes:
        known = written(known, "vectors")
        for c in schemas.VECTOR_COLUMNS:
            held = F.broadcast(known.select(F.col("digest").alias("_digest"), F.col("vector").alias("_vector")))
            wide = wide.join(held, F.col(c) == F.col("_digest"), "left").withColumn(c, F.col("_vector")).drop("_digest", "_vector")
        return wide
    slots = F.explode(F.array(*[
        F.struct(F.lit(c).alias("slot"), F.col(c).alias("digest")) for c in schemas.VECTOR_COLUMNS]))
    wanted = wide.select("idea_db_id", slots.alias("_kept")).select("idea_db_id", "_kept.*").where(
        "digest IS NOT NULL")
    held = wanted.join(known, "digest").groupBy("idea_db_id").agg(
        F.collect_list(F.struct("slot", "vector")).alias("_vectors"))

    def of_slot(name: str) -> Column:
        return F.get(F.filter("_vectors", lambda v: v["slot"] == name), F.lit(0))["vector"]

    return wide.join(held, "idea_db_id", "left").withColumns({
        c: of_slot(c) for c in schemas.VECTOR_COLUMNS}).drop("_vectors")


def fill_vectors(answers: DataFrame, vectors: DataFrame, embed: Callable[[Column], Column]) -> DataFrame:
    """Vectors, written, for the answer texts that have none yet; each distinct text is asked once."""
    return embed_texts(unseen_texts(answers, "field_answer", vectors), embed)


def idea_dimension_rows(wide: DataFrame, loaded: DataFrame, run: datetime,
                        vectors_as_text: bool = False) -> DataFrame:
    """Rows to append to the idea dimension."""
    rows = validity(wide, run, open_end=MAX_TIMESTAMP).withColumns({
        c: timestamp_or(moment_of(wide, c)) for c in ("created_at", "updated_at")})
    if vectors_as_text:
        rows = rows.withColumns({
            c: vector_to_text(F.col(c)) for c in schemas.VECTOR_COLUMNS})
    columns = [
        "idea_db_id", *schemas.IDEA_ATTRIBUTES, *schemas.PROBLEMS, *schemas.SOLUTIONS,
        *schemas.VECTOR_COLUMNS, "created_at", "updated_at", "valid_from", "valid_to",
        "is_current",
    ]
    return surrogate_keys(
        new_records(rows.select(*columns), loaded, "idea_db_id"), loaded, ["idea_db_id"],
        unique=True)


def submission_stage(wide: DataFrame, companies: DataFrame, goals: DataFrame) -> DataFrame:
    """Submission rows by business key of the idea; unknown companies and goals become 0."""
    with_company = look_up(
        wide.select("idea_db_id", "company_id", "goal_id", "submitted_at"), companies,
        {"company_id": "company_db_id"}, "id", "_company")
    with_goal = look_up(with_company, goals, {"goal_id": "goal_db_id"}, "id", "_goal")
    return with_goal.select(
        "idea_db_id", known_key(F.col("_company")).alias("company_id"),
        known_key(F.col("_goal")).alias("goal_id"),
        timestamp_or(moment_of(wide, "submitted_at")).alias("submitted_at"))


def load_ideas(answers: DataFrame, class_table: DataFrame, vectors: DataFrame,
               ideas: DataFrame, tags: DataFrame, ideas_tags: DataFrame, dim_idea: DataFrame,
               companies: DataFrame, goals: DataFrame, run: datetime,
               embed: Callable[[Column], Column] | None = None, vector_table: str | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """Rows for the idea dimension and the submission stage.

    With ``embed``, texts without a vector get one from the caller first; ``vector_table`` is the
    path of the vector table that the new vectors are added to.
    """
    given = categorised_answers(answers, class_table)
    if embed:
        made = fill_vectors(given, vectors, embed)
        if vector_table:
            append_rows(made, vector_table, ["digest", "vector"])
        vectors = vectors.select("digest", "vector").unionByName(made)
    wide = written(wide_ideas(given, vectors, idea_attributes(ideas, tags, ideas_tags)), "wide")
    return (idea_dimension_rows(with_vectors(wide, vectors), dim_idea, run),
            submission_stage(wide, companies, goals))
