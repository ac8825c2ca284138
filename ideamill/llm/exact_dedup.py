"""Exact duplicates by counting quotient filters.

Each partition counts its 64-bit text fingerprints in a counting quotient filter: a fingerprint's
leading bits name the slice and the quotient, the rest is the remainder; a quotient's remainders
stand sorted in one run, each with its count. Filters of one slice merge without loss by merging
their sorted remainders and adding counts. Fingerprints counted once belong to texts that occur
once. Only rows with other fingerprints are compared by their bytes, as groups of whole texts.

Contract: null counts as the empty text; repeated rows are rows of a group like others, one of equal
doc_ids stays; null doc_ids are smaller than any other; an empty table gives no row; texts of any
length are compared whole; other columns don't matter. Group values are map-side combined aggregates
and joins that adaptive execution splits, so no task holds a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.llm.common import written

SLICE_BITS = 12
QUOTIENT_BITS = 12


class CountingQuotientFilter:
    """The filter of one slice: run lengths by quotient, sorted remainders, and their counts."""

    def __init__(self, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.runs, self.remainders, self.counts = runs, remainders, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, slice_bits: int) -> CountingQuotientFilter:
        """Of fingerprints (sorted, distinct, all of one slice) and their counts."""
        rest = np.uint64(64 - slice_bits - QUOTIENT_BITS)
        quotients = (fingerprints >> rest) & np.uint64((1 << QUOTIENT_BITS) - 1)
        runs = np.bincount(quotients.astype(np.int64), minlength=1 << QUOTIENT_BITS).astype(np.uint32)
        return cls(runs, fingerprints & np.uint64((1 << int(rest)) - 1), counts.astype(np.uint64))

    def keys(self, slice_bits: int) -> np.ndarray:
        """Quotient and remainder of each entry as one sorted number."""
        rest = np.uint64(64 - slice_bits - QUOTIENT_BITS)
        return np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs) << rest | self.remainders

    @staticmethod
    def merged(filters: list[CountingQuotientFilter], slice_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of several filters: equal remainders of a quotient add their counts."""
        keys = np.concatenate([f.keys(slice_bits) for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def repeated_fingerprints(fingerprints: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """(print, copies) of the values of the long column `print` that occur more than once."""
    def local(batches: Iterator[pa.RecordBatch]):
        held = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches if b.num_rows]
        if not held:
            return
        prints, counts = np.unique(np.concatenate(held), return_counts=True)
        slices = (prints >> np.uint64(64 - slice_bits)).astype(np.int64)
        bounds = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1], True])
        rows: list[list] = [[], [], [], []]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = CountingQuotientFilter.of(prints[a:b], counts[a:b], slice_bits)
            used = np.flatnonzero(own.runs).astype(np.uint32)
            # Empty quotients aren't sent: used quotients with their run lengths are.
            for column, value in zip(rows, (int(slices[a]), np.stack([used, own.runs[used]]).tobytes(),
                                            own.remainders.tobytes(), own.counts.tobytes())):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32()), *[pa.array(x, pa.binary()) for x in rows[1:]]], ["slice", "runs", "remainders", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        filters = []
        for runs, remainders, counts in zip(group["runs"], group["remainders"], group["counts"]):
            used, lengths = np.frombuffer(runs, np.uint32).reshape(2, -1)
            every = np.zeros(1 << QUOTIENT_BITS, np.uint32)
            every[used] = lengths
            filters.append(CountingQuotientFilter(every, np.frombuffer(remainders, np.uint64), np.frombuffer(counts, np.uint64)))
        keys, counts = CountingQuotientFilter.merged(filters, slice_bits)
        many = counts > 1
        prints = np.uint64(group["slice"].iloc[0]) << np.uint64(64 - slice_bits) | keys[many]
        return pd.DataFrame({"print": prints.view(np.int64), "copies": counts[many].astype(np.int64)})

    parts = fingerprints.select("print").mapInArrow(local, "slice int, runs binary, remainders binary, counts binary")
    return parts.groupBy("slice").applyInPandas(merge, "print long, copies long")


def _with_print(docs: DataFrame) -> DataFrame:
    """(row: all columns, text, print, place)"""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct("*").alias("row"), text.alias("text"), F.xxhash64(text).alias("print"),
                       F.monotonically_increasing_id().alias("place"))


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row; the largest doc_id of equal texts stays."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("print"))
    repeated = written(repeated_fingerprints(rows), "repeated")
    alone = rows.select("doc_id", "print", F.sha2("text", 256).alias("text_sha256")).join(repeated, "print", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    shared = written(rows.join(repeated.select("print"), "print").withColumn("place", F.monotonically_increasing_id()), "shared")
    groups = shared.groupBy("print", "text").agg(
        F.max(F.struct("doc_id", "place")).alias("stays"), F.count("*").alias("group_size"))
    verified = shared.join(groups, ["print", "text"]).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("place") == F.col("stays.place")).alias("kept"), F.sha2("text", 256).alias("text_sha256"))
    return alone.unionByName(verified)


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without the rows that duplicate_groups() does not keep; all columns as they were."""
    rows = _with_print(docs)
    repeated = written(repeated_fingerprints(rows), "repeated")
    alone = rows.join(repeated.select("print"), "print", "left_anti").select("row.*")
    order = F.struct("row.doc_id", "place")
    one = rows.join(repeated.select("print"), "print").groupBy("print", "text").agg(F.max_by("row", order).alias("row"))
    return alone.unionByName(one.select("row.*"))
