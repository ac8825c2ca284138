"""A training corpus from raw documents: five stages, each a table of Parquet that the next one reads.

Every stage but the last returns the columns of documents: toxic documents go, of equal texts the
row with the largest doc_id stays, of near duplicates the one with the smallest, byte strings that
came earlier are cut out, and the rest is packed into sequences of token ids. Nulls in any column,
repeated keys and an empty table are the stages' own cases; other columns stay as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ideamill.llm import exact_dedup, near_copies, packing, substrings, toxicity
from ideamill.llm.common import table, written
from ideamill.llm.queries import VOCABULARY
from ideamill.settings import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score as toxic go; null and empty texts are scored too, and an empty table stays empty."""
    configure(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null is empty) the row with the largest doc_id stays."""
    configure(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose five-word shingles have a similarity of 0.8 or more the row with the smallest doc_id stays."""
    configure(spark)
    return near_copies.keep_one(docs)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that came earlier are cut out of texts; all rows stay."""
    configure(spark)
    return substrings.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all texts in sequences of 2048; a null text has the end id alone."""
    configure(spark)
    return packing.packed_documents(docs, VOCABULARY, end_id=1, length=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeated_strings),
    ("packing", pack_sequences),
]
# The stages can't be said in SQL: the tests hold each one against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, rows, sf_dir)
