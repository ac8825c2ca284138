"""Near copies by wide SimHash fingerprints: five-word shingles, similarity of 0.8 and more.

Texts of similarity 0.8 on five words differ in some 15 % of their fingerprint bits (the angle of their shingle counts
over pi). 64 bits tell that badly, and no few blocks of them agree. So a fingerprint has ``TABLES`` * ``BLOCK_BITS`` bits, all
drawn from one hash per shingle. Two fingerprints meet in a shard if one block of bits agrees, which at 15 % happens with
1 - (1 - 0.85^16)^40 = 0.95, and are linked if at most ``RADIUS`` bits differ. Shards are BK-trees as in simhash; what a
task sends on is at most one link per fingerprint and shard.

Contract: null and wordless texts have no near copies; texts of fewer words than a shingle are one shingle, so that only
equal word sequences meet; repeated rows and repeated or null doc_ids are rows like others; of a component the row of the
smallest doc_id stays (rows without one last, ties by place); an empty table gives no row; texts are read whole; all columns
stay as they were, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ideamill.llm.common import parts_for, raw_texts, written
from ideamill.llm.components import components
from ideamill.llm.simhash import TREE_POINTS, linked_rows

WORDS = 5
BLOCK_BITS, TABLES = 16, 40
BITS = BLOCK_BITS * TABLES
# 17.5 % of the bits: 0.15 is the share at similarity 0.8, 0.014 its deviation, 0.19 the share at 0.7.
RADIUS = 112
SHARD_ROWS = 1 << 17
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _more_hashes(hashes: np.ndarray) -> np.ndarray:
    """BITS bits for each hash: the hash and mixed followers."""
    with np.errstate(over="ignore"):
        x = hashes[:, None] + np.arange(BITS // 64, dtype=np.uint64) * _STEP
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def wide_fingerprint(raw: bytes, words: int = WORDS, seed: int = 42) -> bytes | None:
    """The fingerprint of a text's word shingles, repeats included; None without words."""
    found = raw.lower().split()
    if not found:
        return None
    text, sizes = b" ".join(found), np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    last = min(words, len(found)) - 1
    starts = (ends - sizes)[:len(found) - last].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], seed) for a, b in zip(starts, ends[last:].tolist())], np.uint64)
    # Equal shingles are hashed on once.
    hashes, counts = np.unique(hashes, return_counts=True)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 11):
        bits = np.unpackbits(_more_hashes(hashes[i:i + (1 << 11)]).astype("<u8").view(np.uint8), axis=1, bitorder="little")
        some = counts[i:i + (1 << 11)]
        ones += bits.sum(0, dtype=np.int64) if some.max() == 1 else some @ bits
    return np.packbits(2 * ones > counts.sum(), bitorder="little").tobytes()


def _fingerprints(docs: DataFrame) -> DataFrame:
    """row (all columns), place and print."""
    rows = docs.select(F.col("text").alias("_text"), F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"))
    schema = StructType([rows.schema["row"], rows.schema["place"]]).add("print", "binary")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            prints = pa.array([wide_fingerprint(raw) for raw in raw_texts(b.column(0))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), prints], ["row", "place", "print"])

    return rows.mapInArrow(run, schema)


def near_links(prints: DataFrame, tree_points: int = TREE_POINTS) -> DataFrame:
    """(a, b): links between the places of a written table of distinct fingerprints (place, print)."""
    def shards(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            blocks = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, TABLES).astype(np.int64)
            keys = (blocks + (np.arange(TABLES) << BLOCK_BITS)).astype(np.int32)
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, t]), *b.columns], ["shard", "place", "print"])

    keys = prints.select("place", "print").mapInArrow(shards, "shard int, place long, print binary")
    # A large shard is cut into trees that meet pairwise. Written, so that so few rows are seen to be few.
    hot = written(keys.groupBy("shard").count().where(F.col("count") > tree_points)
                  .select("shard", F.ceil(F.col("count") / tree_points).cast("int").alias("trees")), "hot-shards")
    trees = F.coalesce("trees", F.lit(1))
    dealt = (keys.join(hot, "shard", "left").withColumn("own", F.pmod(F.xxhash64("place"), trees).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), trees - 1)))
             .select("shard", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("asks"), "own", "place", "print"))
    parts = parts_for(TABLES * prints.count(), SHARD_ROWS)

    def link(batches: Iterator[pa.RecordBatch]):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        shard, tree, asks, own, place = (table.column(c).to_numpy() for c in ("shard", "tree", "asks", "own", "place"))
        points = np.frombuffer(b"".join(table.column("print").to_pylist()), "<u8").reshape(-1, BITS // 64)
        order = np.lexsort((place, own != tree, asks, tree, shard))
        shard, tree, asks, own, place, points = (x[order] for x in (shard, tree, asks, own, place, points))
        new = np.r_[True, (shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1]) | (asks[1:] != asks[:-1])]
        root = linked_rows(np.cumsum(new), points, own == tree, own == asks, RADIUS)
        linked = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(place[linked]), pa.array(place[root[linked]])], ["a", "b"])

    return dealt.repartition(parts, "shard", "tree", "asks").mapInArrow(link, "a long, b long")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with the row of the smallest doc_id of each component of near copies; all columns as they were."""
    rows = written(_fingerprints(docs), "wide-prints")
    first = F.min(F.struct(F.col("row.doc_id").isNull(), "row.doc_id", "place")).alias("first")
    # One place stands for all rows of a fingerprint.
    distinct = written(rows.where("print IS NOT NULL").groupBy("print").agg(first).select(
        F.col("first.place").alias("place"), "first", "print"), "distinct-prints")
    linked = components(near_links(distinct.select("place", "print")))
    members = distinct.select("place", "first").join(linked.withColumnRenamed("a", "place"), "place", "left").withColumn(
        "member", F.coalesce("b", "place"))
    stays = members.groupBy("member").agg(F.min("first").alias("first")).select(F.col("first.place").alias("place"))
    gone = rows.where("print IS NOT NULL").select("place").join(stays, "place", "left_anti")
    return rows.join(gone, "place", "left_anti").select("row.*")
