"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words and their stems, of neighbouring words and of
words with one between them. Training goes over a bounded sample of labelled rows; per-coordinate rates and the L1
term leave few weights, which travel with the tasks that score every whole text.

Contract: null and wordless texts have no feature and get the score of the bias; repeated rows are
scored alike; of repeated labels the highest counts; rows without a label or key aren't learned
from; without labels of both kinds nothing is learned and every score is 0; an empty table gives no
row; texts of any length are scored whole; lang, source and doc_id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ideamill.llm.common import raw_texts

SLOT_BITS = 20
# Words count by their first bytes too, so that a stem is known with any ending.
STEM_BYTES = 5
# The bounded sample: labelled rows, and the longest text among them. Longer ones are scored all the same.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 1 << 16
EPOCHS = 5
_ASCII_MARKS = b"\"#$%&()*+,./:;<=>?@[\\]^_`{|}~!"
_MARKS = bytes.maketrans(_ASCII_MARKS, b" " * len(_ASCII_MARKS))


@dataclass(frozen=True)
class Weights:
    """The weights that are not zero, by slot."""
    slots: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << SLOT_BITS, np.float32)
        out[self.slots] = self.values
        return out


def features(raw: bytes) -> np.ndarray:
    """Distinct slots of a text's words, their stems, word pairs and skip pairs."""
    words = raw.lower().translate(_MARKS).split()
    digest = xxhash.xxh64_intdigest
    h = np.array(list(map(digest, words)), np.uint64)
    stems = np.array([digest(w) for w in {w[:STEM_BYTES] for w in words}], np.uint64) + np.uint64(1)
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    grams = np.concatenate([h, stems, h[:-1] * a + h[1:] * b, h[:-2] * c + h[2:] * a]) * b
    return np.unique((grams ^ (grams >> np.uint64(29))) * c >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _chance(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[np.ndarray], labels: list[int], alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.0) -> Weights:
    """FTRL-proximal over the rows in the order given, EPOCHS times."""
    share = float(np.mean(labels)) if labels else 0.0
    base = float(np.log(share / (1 - share))) if 0 < share < 1 else -35.0
    z, n = np.zeros(1 << SLOT_BITS), np.zeros(1 << SLOT_BITS)
    bias, bias_n = base, 0.0

    def weights(x):
        own = z[x]
        return np.where(np.abs(own) <= l1, 0.0, (np.sign(own) * l1 - own) / ((beta + np.sqrt(n[x])) / alpha + l2))

    if 0 < share < 1:
        for _ in range(EPOCHS):
            for x, y in zip(rows, labels):
                w = weights(x)
                g = float(_chance(w.sum() + bias)) - y
                root = np.sqrt(n[x])
                z[x] += g - (np.sqrt(root * root + g * g) - root) / alpha * w
                n[x] += g * g
                bias_n += g * g
                bias -= 0.1 * g / np.sqrt(1 + bias_n)
    every = weights(np.arange(len(z)))
    used = np.flatnonzero(every)
    return Weights(used.astype(np.int32), every[used].astype(np.float32), bias)


def fold(key: Column, of: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(of))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, y, turn) of at most that many labelled documents, by a hash of doc_id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("y")).withColumn("turn", F.xxhash64("doc_id"))
    some = known.orderBy("turn", "doc_id").limit(rows)
    # At most `rows` rows of three numbers.
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "text", "y", "turn")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Weights:
    """Weights from the labelled rows given; the caller leaves out those that are held back."""
    def run(batches: Iterator[pa.RecordBatch]):
        rows, ys, turns = [], [], []
        for b in batches:
            rows += map(features, raw_texts(b.column(0)))
            ys += b.column(1).to_pylist()
            turns += b.column(2).to_pylist()
        order = sorted(range(len(rows)), key=lambda i: (turns[i], ys[i], len(rows[i])))
        w = fit([rows[i] for i in order], [ys[i] for i in order])
        yield pa.RecordBatch.from_arrays([pa.array([w.slots.tobytes()]), pa.array([w.values.tobytes()]), pa.array([w.bias])],
                                         ["slots", "values", "bias"])

    sample = labelled_sample(docs, labels, label).where(F.octet_length("text") <= SAMPLE_BYTES).select("text", "y", "turn")
    # One task holds the bounded sample.
    row = sample.repartition(1).mapInArrow(run, "slots binary, values binary, bias double").first()
    if row is None:
        return fit([], [])
    return Weights(np.frombuffer(row.slots, np.int32), np.frombuffer(row["values"], np.float32), row.bias)


def scored(docs: DataFrame, weights: Weights, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (doc_id) and the score of every whole text."""
    keep = keep or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]):
        dense = weights.dense()
        for b in batches:
            sums = np.array([dense[features(raw)].sum(dtype=np.float64) for raw in raw_texts(b.column(0))])
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(_chance(sums + weights.bias), pa.float64())], [*keep, "score"])

    schema = StructType([docs.schema[c] for c in keep]).add("score", "double")
    return docs.select(F.col("text").alias("_text"), *keep).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5) -> DataFrame:
    """docs without the rows scored 0.5 or more; learned from the labels of all folds but the first."""
    weights = train(docs, labels.where(fold(F.col("doc_id"), folds) != 0), label)
    rows = docs.select("text", F.struct("*").alias("row"))
    return scored(rows, weights, ["row"]).where("score < 0.5").select("row.*")
