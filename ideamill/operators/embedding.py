"""Field classification and text embedding with a function or a table given by the caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ideamill.functions.text import category_in, newline_to_space
from ideamill.functions.values import field_description, not_blank
from ideamill.operators.lookup import new_records
from ideamill.operators.numbering import number_categories
from ideamill.operators.reshape import keep_first
from ideamill.sources.tables import written

# Keyword rules used when the caller gives no model. The first match decides.
KEYWORD_RULES = (
    ("Idea name", "nombre|name|titulo|título"),
    ("Problem", "problem|necesidad|oportunidad|contexto|need"),
    ("Solution", "soluci|solution|propuesta|busca|idea"),
)


def classify_by_keywords(title: Column, description: Column) -> Column:
    text = F.lower(F.concat_ws(" ", title, field_description(description)))
    rules = [F.when(text.rlike(words), F.lit(name)) for name, words in KEYWORD_RULES]
    return F.coalesce(*rules, F.lit("Other"))


def classify_fields(answers: DataFrame, order: list[str],
                    classify: Callable[[Column, Column], Column] = classify_by_keywords
                    ) -> DataFrame:
    """One row per form field of a company with its numbered category.

    ``classify`` gets the title and description columns and returns the model's answer column
    (built-in expressions or a pandas UDF); it sees each field once.
    """
    fields = keep_first(
        answers.select("company_id", "field_id", "title", "description", *[
            c for c in order if c not in ("company_id", "field_id", "title", "description")]),
        ["field_id", "company_id"], order)
    # The plain answer is written before anything reads it: each use of a column would ask again.
    asked = written(fields.select(
        "company_id", "field_id", F.col("title").alias("name"), "description",
        classify(F.col("title"), F.col("description")).alias("category"),
    ), "fields")
    named = asked.withColumn("category", category_in(F.col("category")))
    return number_categories(named, "company_id", "category", ["field_id"])


def text_digest(text: Column) -> Column:
    """Key of a text in the vector table: the digest of the whole one-line text."""
    return F.sha2(newline_to_space(text), 256)


def unseen_texts(df: DataFrame, text: str, vectors: DataFrame) -> DataFrame:
    """Distinct non-blank texts (``digest``, ``text``) without a vector yet."""
    texts = (
        df.where(not_blank(F.col(text)))
        .select(text_digest(F.col(text)).alias("digest"),
                newline_to_space(F.col(text)).alias("text"))
        .groupBy("digest").agg(F.first("text").alias("text"))
    )
    return new_records(texts, vectors, "digest")


def embed_texts(texts: DataFrame, embed: Callable[[Column], Column]) -> DataFrame:
    """Vectors (``digest``, ``vector``) of texts by the caller's column function.

    The result is a written table, so each text is asked once; add it to the vector table. A text
    whose vector is NULL is tried again in the next run.
    """
    made = written(texts.select("digest", embed(F.col("text")).alias("vector")), "vectors")
    return made.where("vector IS NOT NULL")


def attach_vectors(df: DataFrame, text: str, vectors: DataFrame, output: str) -> DataFrame:
    """Add the vector of each text; blank and unknown texts keep NULL."""
    known = vectors.select(F.col("digest").alias("_digest"), F.col("vector").alias(output))
    key = F.when(not_blank(F.col(text)), text_digest(F.col(text)))
    return df.withColumn("_digest", key).join(known, "_digest", "left").drop("_digest")
