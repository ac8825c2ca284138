"""Token ids in binary shard files with a minimal perfect hash index from document key to place.

A file is a Parquet folder written by Spark, so any store that Spark writes to will do. Its rows are
blocks of a shard: raw little-endian ids of consecutive documents in ascending key order, the start
of each document in them, and an index. The index is a minimal perfect hash of the block's keys
(hash and displace): a pilot per bucket sends each key to a slot of its own, which holds a 32-bit
fingerprint of the key, the first row of the key and its number of rows.

Contract: a null text is an empty one and leaves the end id alone; null keys come first, are stored
and read back but cannot be looked up; repeated keys keep all their rows, ordered by a hash of the
text; texts of any length are encoded whole, and a block with one very long text is as long as it
needs; an empty table gives files without blocks; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ideamill.llm.common import MAX_PARTS, part_id, raw_texts, shuffle_parts, starts_of_parts
from ideamill.llm.words import LibraryIds

BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 1 << 16
KEYS_PER_BUCKET = 4
_PILOTS = np.arange(1, 257, dtype=np.uint64)
_SEED, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

BLOCK_SCHEMA = (
    "shard int, block int, first_key long, last_key long, n_rows long, n_tokens long, start_in_shard long, width int, "
    "payload binary, row_keys binary, row_null binary, row_starts binary, pilots binary, fingerprints binary, "
    "slot_rows binary, slot_counts binary"
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _STEP
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key_hash(keys: np.ndarray) -> np.ndarray:
    return _mixed(keys.astype(np.int64).view(np.uint64) + _SEED)


class PerfectHash:
    """Slots 0 to n-1 for n distinct keys. A negative pilot names the slot of a bucket's only key."""

    def __init__(self, pilots: np.ndarray, fingerprints: np.ndarray):
        self.pilots, self.fingerprints = pilots, fingerprints

    @staticmethod
    def _slot(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
        return (_mixed(hashes ^ (pilots * _SEED)) % np.uint64(n)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The hash of distinct keys, and the slot of each."""
        n = len(keys)
        hashes, slots = _key_hash(keys), np.zeros(n, np.int64)
        buckets = max(1, -(-n // KEYS_PER_BUCKET))
        pilots = np.zeros(buckets, np.int64)
        bucket = (hashes >> np.uint64(32)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=buckets)
        starts = np.cumsum(sizes) - sizes
        free = np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable").tolist():
            members = order[starts[b]:starts[b] + sizes[b]]
            if len(members) < 2:
                break
            base = np.uint64(0)
            while True:
                tried = _PILOTS + base
                at = cls._slot(hashes[members][None, :], tried[:, None], n)
                spread = np.sort(at, 1)
                good = free[at].all(1) & (spread[:, 1:] != spread[:, :-1]).all(1)
                if good.any():
                    k = int(good.argmax())
                    pilots[b], slots[members] = int(tried[k]), at[k]
                    free[at[k]] = False
                    break
                base += np.uint64(len(_PILOTS))
        alone = np.flatnonzero(sizes == 1)
        spare = np.flatnonzero(free)
        pilots[alone] = -1 - spare
        slots[order[starts[alone]]] = spare
        fingerprints = np.zeros(n, np.uint32)
        fingerprints[slots] = hashes.astype(np.uint32)
        return cls(pilots, fingerprints), slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where the stored fingerprint says that the key is not there."""
        n = len(self.fingerprints)
        if not n or not len(keys):
            return np.full(len(keys), -1)
        hashes = _key_hash(keys)
        pilots = self.pilots[(hashes >> np.uint64(32)).astype(np.int64) % len(self.pilots)]
        slots = np.where(pilots < 0, -1 - pilots, self._slot(hashes, pilots.astype(np.uint64), n))
        return np.where(self.fingerprints[slots] == hashes.astype(np.uint32), slots, -1)


class _Blocks:
    """Collects the documents of one shard and cuts them into blocks."""

    def __init__(self, shard: int, width: int):
        self.shard, self.width, self.block, self.start = shard, width, 0, 0
        self.keys, self.nulls, self.parts, self.size = [], [], [], 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key or 0)
        self.nulls.append(key is None)
        self.parts.append(ids)
        self.size += len(ids)

    def full(self) -> bool:
        return self.size >= BLOCK_BYTES or len(self.keys) >= BLOCK_ROWS

    def cut(self) -> pa.RecordBatch:
        keys, null = np.array(self.keys, np.int64), np.array(self.nulls, bool)
        starts = np.cumsum([0] + [len(p) // self.width for p in self.parts])
        own, first, counts = np.unique(keys[~null], return_index=True, return_counts=True)
        index, slots = PerfectHash.build(own)
        slot_rows, slot_counts = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        slot_rows[slots], slot_counts[slots] = first + null.sum(), counts
        n = int(starts[-1])
        row = {
            "shard": self.shard, "block": self.block, "first_key": int(own[0]) if len(own) else None,
            "last_key": int(own[-1]) if len(own) else None, "n_rows": len(keys), "n_tokens": n,
            "start_in_shard": self.start, "width": self.width, "payload": b"".join(self.parts),
            "row_keys": keys.tobytes(), "row_null": null.tobytes(), "row_starts": starts.astype(np.int64).tobytes(),
            "pilots": index.pilots.tobytes(), "fingerprints": index.fingerprints.tobytes(),
            "slot_rows": slot_rows.tobytes(), "slot_counts": slot_counts.tobytes(),
        }
        self.block, self.start = self.block + 1, self.start + n
        self.keys, self.nulls, self.parts, self.size = [], [], [], 0
        types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        names = [x.split() for x in BLOCK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([row[k]], types[t]) for k, t in names], [k for k, _ in names])


def write_token_files(docs: DataFrame, path: str, file: str, end_id: int, shards: int | None = None) -> None:
    """Encode every text, append end_id, and write shards of ascending doc_id to path."""
    shards = min(MAX_PARTS, shards or shuffle_parts(docs.sparkSession))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")

    def run(batches: Iterator[pa.RecordBatch]):
        library = LibraryIds.of(file)
        end, blocks = np.array([end_id], library.dtype).tobytes(), _Blocks(part_id(), library.dtype.itemsize)
        for b in batches:
            for key, ids in zip(b.column(0).to_pylist(), library.encode(raw_texts(b.column(2)))):
                blocks.add(key, ids + end)
                if blocks.full():
                    yield blocks.cut()
        if blocks.keys:
            yield blocks.cut()

    (keyed.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .mapInArrow(run, BLOCK_SCHEMA).write.parquet(path))


def token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


class Block:
    """One block as read: ids by key through the index, or by row."""

    def __init__(self, row: dict):
        as_array = np.frombuffer
        self.ids = as_array(row["payload"], f"<u{row['width']}")
        self.keys, self.null = as_array(row["row_keys"], np.int64), as_array(row["row_null"], bool)
        self.starts = as_array(row["row_starts"], np.int64)
        self.index = PerfectHash(as_array(row["pilots"], np.int64), as_array(row["fingerprints"], np.uint32))
        self.rows, self.counts = as_array(row["slot_rows"], np.int64), as_array(row["slot_counts"], np.int64)

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; no rows where the key is not in the block."""
        slots = self.index.find(keys)
        return (np.where(slots < 0, 0, self.rows[slots]), np.where(slots < 0, 0, self.counts[slots])) if len(
            self.rows) else (np.zeros(len(keys), np.int64),) * 2

    def ids_of_row(self, row: int) -> np.ndarray:
        return self.ids[self.starts[row]:self.starts[row + 1]]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored row, each found through its block's index."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                known = np.flatnonzero(~block.null)
                own = np.unique(block.keys[known])
                first, counts = block.rows_of(own)
                found = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                if len(found) != len(known):
                    raise ValueError(f"the index of shard {row['shard']}, block {row['block']} misses keys")
                keys = [None] * int(block.null.sum()) + np.repeat(own, counts).tolist()
                order = [*np.flatnonzero(block.null).tolist(), *found.tolist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * len(order), pa.int32()), pa.array(keys, pa.int64()),
                    pa.array(block.starts[order] + row["start_in_shard"], pa.int64()),
                    pa.array((block.starts[1:] - block.starts[:-1])[order], pa.int64()),
                    pa.array([_crc(block.ids_of_row(i)) for i in order], pa.int64()),
                ], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    # One row per shard, MAX_PARTS at most.
    starts = F.broadcast(starts_of_parts(totals, "shard", "tokens", "before"))
    rows = files.mapInArrow(run, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "shard")


def lookup(files: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) for each row of keys.doc_id that is stored, one row per stored document.

    Keys go to the shards whose key range holds them; a shard with its keys is one task's work.
    """
    ranges = files.groupBy("shard").agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi"))
    # One row per shard, MAX_PARTS at most; shards with null keys only have no range.
    bounds = sorted((r.hi, r.lo, r.shard) for r in ranges.where("lo IS NOT NULL").collect())
    hi, lo = np.array([b[0] for b in bounds], np.int64), np.array([b[1] for b in bounds], np.int64)

    def places(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            got = np.array(b.column(0).drop_null().to_pylist(), np.int64)
            first, last = np.searchsorted(hi, got, "left"), np.searchsorted(lo, got, "right")
            pairs = [(k, bounds[s][2]) for k, x, y in zip(got.tolist(), first.tolist(), last.tolist()) for s in range(x, y)]
            yield pa.RecordBatch.from_arrays([
                pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int32())], ["doc_id", "shard"])

    def fetch(wanted: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        own, out = np.unique(wanted["doc_id"].to_numpy(np.int64)), []
        for row in stored.to_dict("records"):
            block = Block(row)
            for key, first, count in zip(own.tolist(), *(x.tolist() for x in block.rows_of(own))):
                out += [(key, block.ids_of_row(i).astype(np.int32)) for i in range(first, first + count) if block.keys[i] == key]
        return pd.DataFrame(out, columns=["doc_id", "ids"])

    routed = keys.select(F.col("doc_id").cast("long")).distinct().mapInArrow(places, "doc_id long, shard int")
    return (routed.groupBy("shard").cogroup(files.groupBy("shard"))
            .applyInPandas(fetch, "doc_id long, ids array<int>"))
