"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts earlier, in a document of a
smaller key or further ahead in the same one. Whole texts never meet:

1. Each window of LENGTH bytes is filed under the smallest hash of its GRAM-byte strings. Equal
   windows have equal hashes, so a run of windows under a hash that no other run has is unique.
2. The other runs' bytes go to shards by hash. Equal runs are joined first: all but the earliest are
   repeats as a whole. The rest of a shard is sorted as one suffix array by Larsson-Sadakane
   refinement (ranks double their depth, sorted groups are left alone), neighbours get their common
   prefixes in Kasai's way (a suffix has its predecessor's prefix less one byte unless the byte
   before differs), and equal windows stand side by side.
3. A hash with more than HOT_RUNS runs is dealt to several shards. Each gives on its distinct runs.
   Digests of their windows meet in buckets, which answer which digests other shards have too; only
   those windows travel on, once a shard, and are compared byte for byte. So the windows of one hash
   lie in as many buckets as their number asks for.

Documents are told apart by doc_id, file and row number. Contract: null doc_ids come first; equal
doc_ids go by a hash of the file and the row number, so of repeated rows one stays; null and short
texts lose nothing; texts of any length are read whole; an empty table gives no row; other columns
are not read, and keep_first() returns them as they were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ideamill.llm.common import parts_for, raw_texts, written

LENGTH = 100
GRAM = 24
# Bytes hashed together, bytes of text for each part that compares hashes, bytes of runs in a shard.
GROUP_BYTES = 1 << 18
PART_BYTES = 24 << 20
SHARD_BYTES = 1 << 20
HOT_RUNS = 4_096
# Hashes with about this many runs in a sample of the texts are spread before they are counted.
SPREAD_RUNS = 1 << 18
SAMPLED = 64
# Windows of hot hashes compared together.
BUCKET_WINDOWS = 1 << 18
_NO_KEY = -(1 << 63)
_KEY = ["key", "tie", "row"]
_KEY_SCHEMA = "key long, tie long, row long"


def _eights(buffer: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    n = max(0, len(buffer) - 7)
    out = np.empty(n, np.uint64)
    raw = buffer.tobytes()
    for o in range(min(8, n)):
        out[o::8] = np.frombuffer(raw, f"{order}u8", (n - o + 7) // 8, o)
    return out


def _sliding(of: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """Smallest or largest of each `width` neighbours, in steps that double."""
    step = 1
    while 2 * step <= width:
        x = of(x[:-step], x[step:])
        step *= 2
    return of(x[:step - width], x[width - step:]) if width > step else x


def window_runs(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, text number, first window, windows) of the runs of windows filed under one hash.

    The number of windows is negative where the run's hash comes twice in it, so that windows of the
    same run may be equal.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    count = len(buffer) - length + 1
    if count < 1:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    eights = _eights(buffer, "<")
    eights ^= eights >> np.uint64(31)
    h = eights[:-16] * a
    h += eights[8:-8] * b
    h ^= h >> np.uint64(29)
    h *= c
    h += eights[16:] * a
    h ^= h >> np.uint64(32)
    h *= b
    width = length - GRAM + 1
    low = _sliding(np.minimum, h, width)
    starts = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), np.maximum(sizes - length + 1, 0))
    place = np.arange(len(text)) + np.repeat(starts - (np.cumsum(np.maximum(sizes - length + 1, 0)) - np.maximum(sizes - length + 1, 0)),
                                             np.maximum(sizes - length + 1, 0))
    own = low[place]
    first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (text[1:] != text[:-1])]) if len(own) else np.zeros(0, np.int64)
    runs, begin, of = np.diff(np.r_[first, len(own)]), place[first], text[first]
    # A hash is in use where it equals the largest of its windows' smallest; one that comes twice in a
    # run is in use at two neighbouring such places.
    edge = np.zeros(width - 1, np.uint64)
    used = h[_sliding(np.maximum, np.concatenate([edge, low, edge]), width) == h]
    twice = np.unique(used[1:][used[1:] == used[:-1]])
    if len(twice):
        runs = np.where(np.isin(own[first], twice), -runs, runs)
    return own[first], of, begin - starts[of], runs


def suffix_order(buffer: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes' first `depth` bytes or more, and ranks of half that depth.

    ends[i] is where the text of position i ends; a suffix stops there. Larsson-Sadakane refinement:
    the rank of a suffix is the last place of its group, and only groups of several are sorted on.
    """
    n = len(buffer)
    first = _eights(np.concatenate([buffer, np.zeros(8, np.uint8)]), ">")[:n]
    rest = np.minimum(ends - np.arange(n), 8).astype(np.uint64)
    first &= ~np.uint64(0) << ((np.uint64(8) - rest) * np.uint64(8))
    order = np.argsort(first, kind="stable")
    new = np.r_[True, first[order][1:] != first[order][:-1]]
    rank, reached = np.empty(n, np.int64), 8

    def last_places(new: np.ndarray) -> np.ndarray:
        starts = np.flatnonzero(new)
        return np.repeat(np.r_[starts[1:], len(new)] - 1, np.diff(np.r_[starts, len(new)]))

    rank[order] = last_places(new)
    half = rank.copy()
    while reached < depth:
        half = rank.copy()
        # Groups of several: places whose neighbour has the same rank.
        ranks = half[order]
        same = ranks[1:] == ranks[:-1]
        open_ = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
        if not len(open_):
            break
        at = order[open_]
        ahead = at + reached
        second = np.where(ahead < ends[at], half[np.minimum(ahead, n - 1)], -1)
        inner = np.lexsort((second, half[at]))
        at, second = at[inner], second[inner]
        order[open_] = at
        group = half[at]
        new = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        rank[at] = open_[last_places(new)]
        reached *= 2
    return order, half


def common_prefixes(buffer: np.ndarray, ends: np.ndarray, order: np.ndarray, half: np.ndarray, limit: int) -> np.ndarray:
    """For each place of the order but the first, the bytes shared with the place before: exact from
    half of the sorted depth up to limit, any smaller number below.

    Kasai's rule in array form: where the bytes before a suffix and its neighbour agree and their
    suffixes are neighbours too, the prefix is one byte shorter than theirs. The rest is compared.
    """
    n = len(buffer)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    some = np.flatnonzero((before >= 0) & (half == half[before]))
    prefix = np.zeros(n, np.int64)
    if len(some):
        near = before[some]
        follows = (some > 0) & (near > 0) & (before[some - 1] == near - 1) & (half[some - 1] == half[near - 1]) & (
            buffer[some - 1] == buffer[near - 1]) & (ends[some - 1] == ends[some]) & (ends[near - 1] == ends[near])
        heads = some[~follows]
        eights = _eights(np.concatenate([buffer, np.zeros(8, np.uint8)]), "<")
        left, right = heads, before[heads]
        room = np.minimum(ends[left] - left, ends[right] - right)
        got, on = np.zeros(len(heads), np.int64), np.arange(len(heads))
        while len(on):
            differ = eights[left[on] + got[on]] ^ eights[right[on] + got[on]]
            lowest = (differ & (~differ + np.uint64(1))).astype(np.float64)
            step = np.where(differ == 0, 8, np.log2(np.where(differ == 0, 1, lowest)).astype(np.int64) // 8)
            got[on] = np.minimum(got[on] + step, room[on])
            on = on[(step == 8) & (got[on] < room[on])]
        prefix[heads] = got
        # Each follower takes its head's prefix less the distance.
        head = heads[np.searchsorted(heads, some, "right") - 1]
        prefix[some] = np.maximum(prefix[head] - (some - head), 0)
    return np.minimum(prefix[order[1:]], limit)


class _Runs:
    """Distinct runs of a shard with the earliest place of each."""

    def __init__(self):
        self.number: dict[tuple[int, bytes], int] = {}
        self.owner: list[tuple] = []
        self.spans: dict[tuple, list[int]] = {}

    def add(self, name: tuple[int, bytes], key: tuple, first: int) -> None:
        place = (*key, first)
        known = self.number.setdefault(name, len(self.owner))
        if known == len(self.owner):
            self.owner.append(place)
            return
        old = self.owner[known]
        if place < old:
            self.owner[known], place = place, old
        self.repeat(place[:3], place[3], place[3] + len(name[1]))

    def repeat(self, key: tuple, start: int, stop: int) -> None:
        self.spans.setdefault(key, []).extend((start, stop))

    def repeat_windows(self, run: np.ndarray, at: np.ndarray, length: int) -> None:
        """Windows at those places of those runs are repeats."""
        if not len(run):
            return
        order = np.lexsort((at, run))
        run, at = run[order], at[order]
        first = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1)])
        last = np.r_[first[1:], len(run)] - 1
        for r, a, b in zip(run[first].tolist(), at[first].tolist(), at[last].tolist()):
            *key, start = self.owner[r]
            self.repeat(tuple(key), start + a, start + b + length)

    def rows(self) -> list[tuple]:
        return [(*key, np.array(s, np.int64).tobytes()) for key, s in self.spans.items()]


def _later(groups: np.ndarray, place: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which members are not the first of their group by (key, place)."""
    order = np.lexsort((place, key, groups))
    first = np.r_[True, groups[order][1:] != groups[order][:-1]]
    return order[~first]


def _key_ranks(owner: list[tuple]) -> np.ndarray:
    ranks = {k: i for i, k in enumerate(sorted({o[:3] for o in owner}))}
    return np.array([ranks[o[:3]] for o in owner], np.int64)


def sort_runs(runs: _Runs, length: int = LENGTH) -> None:
    """Mark the repeated windows of distinct runs through one suffix array."""
    names = [name[1] for name in runs.number]
    if len(names) < 2 and not any(len(x) > length for x in names):
        return
    sizes = np.array([len(x) for x in names], np.int64)
    buffer = np.frombuffer(b"".join(names), np.uint8)
    ends = np.repeat(np.cumsum(sizes), sizes)
    order, half = suffix_order(buffer, ends, length)
    shared = common_prefixes(buffer, ends, order, half, length)
    equal = shared >= length
    member = np.flatnonzero(np.r_[equal, False] | np.r_[False, equal])
    if not len(member):
        return
    groups = np.cumsum(~np.r_[False, equal])[member]
    at = order[member]
    run = np.repeat(np.arange(len(names)), sizes)[at]
    offset = at - (np.cumsum(sizes) - sizes)[run]
    start = np.array([o[3] for o in runs.owner], np.int64)
    later = _later(groups, start[run] + offset, _key_ranks(runs.owner)[run])
    runs.repeat_windows(run[later], offset[later], length)


def window_digests(buffer: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A digest of the `length` bytes from each position on; equal windows have equal ones."""
    eights, n = _eights(buffer, "<"), max(0, len(buffer) - length + 1)
    h, a = np.zeros(n, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for o in [*range(0, length - 8, 8), length - 8]:
        h ^= eights[o:o + n]
        h *= a
        h ^= h >> np.uint64(32)
    return h


def _packed(runs: _Runs) -> tuple:
    """Runs with the places of their owners, as binary columns."""
    return (zstandard.ZstdCompressor(level=1).compress(b"".join(name[1] for name in runs.number)),
            np.array([len(name[1]) for name in runs.number], "<i4").tobytes(), np.array(runs.owner, "<i8").T.tobytes())


def _packed_windows(runs: bytes, sizes: bytes, length: int) -> tuple[np.ndarray, ...]:
    """The bytes of packed runs, and position, run number and digest of each window."""
    buffer, sizes = np.frombuffer(zstandard.ZstdDecompressor().decompress(runs), np.uint8), np.frombuffer(sizes, "<i4").astype(np.int64)
    counts, starts = sizes - length + 1, np.cumsum(sizes) - sizes
    run = np.repeat(np.arange(len(sizes)), counts)
    at = np.arange(len(run)) - (np.cumsum(counts) - counts)[run] + starts[run]
    return buffer, at, run, window_digests(buffer, length)[at]


def _in_buckets(digests: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (digests % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]]) if len(order) else order
    for own in np.split(order, starts[1:]):
        if len(own):
            yield int(bucket[own[0]]), own


def _by_place(windows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by window and place (key, tie, row, start), and which places of it begin a new window."""
    _, groups = np.unique(windows, return_inverse=True)
    order = np.lexsort((*places[::-1], groups))
    return order, np.r_[True, groups[order][1:] != groups[order][:-1]]


def merged_spans(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, tie, row, spans): the repeats between the packed runs of hot hashes, a row for each shard
    and deal: shard, deal, n (windows), runs, sizes, places. packed must be a written table."""
    buckets = parts_for(packed.agg(F.sum("n")).first()[0] or 0, BUCKET_WINDOWS)

    def digests(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for row in b.to_pylist():
                own = np.unique(_packed_windows(row["runs"], row["sizes"], length)[3])
                dealt = [(bucket, own[at].tobytes()) for bucket, at in _in_buckets(own, buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(dealt), pa.int32()), pa.array([row["deal"]] * len(dealt), pa.int32()),
                     pa.array([d[0] for d in dealt], pa.int32()), pa.array([d[1] for d in dealt], pa.binary())],
                    ["shard", "deal", "bucket", "digests"])

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        held = [np.frombuffer(x, np.uint64) for x in group["digests"]]
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        several = found[counts > 1]
        out = group[["shard", "deal"]].assign(digests=[x[np.isin(x, several)].tobytes() for x in held])
        return out[out["digests"].str.len() > 0]

    def windows(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for row in b.to_pylist():
                buffer, at, run, digest = _packed_windows(row["runs"], row["sizes"], length)
                some = np.flatnonzero(np.isin(digest, np.frombuffer(b"".join(row["several"]), np.uint64)))
                at, run, digest = at[some], run[some], digest[some]
                starts = np.cumsum(sizes := np.frombuffer(row["sizes"], "<i4").astype(np.int64)) - sizes
                places = np.frombuffer(row["places"], "<i8").reshape(4, -1)[:, run].copy()
                places[3] += at - starts[run]
                body = np.lib.stride_tricks.sliding_window_view(buffer, length)[at]
                # Equal windows of the shard are marked already: the earliest stands for them.
                order, new = _by_place(body.view(f"S{length}").ravel(), places)
                first = order[new]
                dealt = [(bucket, body[first[x]].tobytes(), places[:, first[x]].tobytes()) for bucket, x in _in_buckets(digest[first], buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d[0] for d in dealt], pa.int32()), *[pa.array([d[i] for d in dealt], pa.binary()) for i in (1, 2)]],
                    ["bucket", "windows", "places"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        places = np.concatenate([np.frombuffer(x, "<i8").reshape(4, -1) for x in group["places"]], axis=1)
        order, new = _by_place(np.frombuffer(b"".join(group["windows"]), f"S{length}"), places)
        found: dict[tuple, list[int]] = {}
        for *key, start in places[:, order[~new]].T.tolist():
            found.setdefault(tuple(key), []).extend((start, start + length))
        return pd.DataFrame([(*key, np.array(x, np.int64).tobytes()) for key, x in found.items()], columns=[*_KEY, "spans"])

    several = (packed.select("shard", "deal", "runs", "sizes").mapInArrow(digests, "shard int, deal int, bucket int, digests binary")
               .groupBy("bucket").applyInPandas(shared, "shard int, deal int, digests binary")
               .groupBy("shard", "deal").agg(F.collect_list("digests").alias("several")))
    return (packed.join(several, ["shard", "deal"]).select("runs", "sizes", "places", "several")
            .mapInArrow(windows, "bucket int, windows binary, places binary")
            .groupBy("bucket").applyInPandas(merge, f"{_KEY_SCHEMA}, spans binary"))


def _identified(docs: DataFrame, *more: str) -> DataFrame:
    """key, tie and row of each document, its text, and further columns. Rows that are in no file are written once."""
    named = docs.select("doc_id", "text", *more)
    try:
        source = _with_places(docs, named.columns)
    except AnalysisException:
        source = _with_places(written(named, "documents"), named.columns)
    return source.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_KEY)).alias("key"), F.xxhash64("file").alias("tie"),
                         "row", "text", "doc_id", *more)


def _with_places(docs: DataFrame, columns: list[str]) -> DataFrame:
    # The hidden column of the files, also beside a column of that name.
    place = docs.metadataColumn("_metadata")
    return docs.select(place["file_path"].alias("file"), place["row_index"].alias("row"), *columns)


_RUN = np.dtype([("hash", "<u8"), ("first", "<i8"), ("windows", "<i4"), ("deal", "<i4")])


def spread_hashes(rows: DataFrame, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of very many runs, in order, and about how many shards each needs."""
    def hashes(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            raws, begin, size = raw_texts(b.column(0)), 0, 0
            for i, raw in enumerate(raws):
                size += len(raw)
                if size >= GROUP_BYTES or i == len(raws) - 1:
                    found, counts = np.unique(window_runs(raws[begin:i + 1], length)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["hash", "n"])
                    begin, size = i + 1, 0

    sample = rows.where(F.pmod(F.xxhash64(*_KEY), F.lit(SAMPLED)) == 0).select("text")
    # A hash of two runs or more in the sample is known to be repeated.
    found = (sample.mapInArrow(hashes, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= max(2, SPREAD_RUNS // SAMPLED)).collect())
    hot, counts = np.array([r["hash"] for r in found], np.int64).view(np.uint64), np.array([r["n"] for r in found], np.int64)
    order = np.argsort(hot)
    return hot[order], -(-counts[order] * SAMPLED // HOT_RUNS)


def repeated_runs(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, tie, row, runs): for each document its runs under hashes that other runs have too."""
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(volume, PART_BYTES)
    hot, deals = spread_hashes(rows, length)

    def local(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            keys = [b.column(i).to_numpy() for i in range(3)]
            raws, begin, size = raw_texts(b.column(3)), 0, 0
            for i, raw in enumerate(raws):
                size += len(raw)
                if size >= GROUP_BYTES or i == len(raws) - 1:
                    h, text, first, windows = window_runs(raws[begin:i + 1], length)
                    # A spread hash goes by its text, to parts of its own.
                    part = np.where(np.isin(h, hot), parts + (text + keys[0][begin] + keys[2][begin]) % parts, (h % np.uint64(parts)).astype(np.int64))
                    order = np.argsort(part, kind="stable")
                    cuts = np.searchsorted(part[order], np.arange(2 * parts + 1))
                    out: list[list] = [[], [], []]
                    head = [int(k[begin]) for k in keys]
                    for p in np.flatnonzero(np.diff(cuts)).tolist():
                        at = order[cuts[p]:cuts[p + 1]]
                        used, number = np.unique(text[at], return_inverse=True)
                        names = np.stack([k[begin + used] for k in keys])
                        body = [h[at].tobytes(), number.astype("<i4").tobytes(), first[at].astype("<i4").tobytes(), windows[at].astype("<i4").tobytes()]
                        out[0].append(p)
                        out[1].append(names.astype("<i8").tobytes())
                        out[2].append(b"".join(body))
                    named = [pa.array([x] * len(out[0]), pa.int64()) for x in head]
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *named, *[pa.array(x, pa.binary()) for x in out[1:]]],
                                                     ["part", *_KEY, "names", "body"])
                    begin, size = i + 1, 0

    def repeated(group: pd.DataFrame) -> pd.DataFrame:
        bodies = []
        for body in group["body"]:
            n = len(body) // 20
            bodies.append((np.frombuffer(body, "<u8", n), np.frombuffer(body, "<i4", 3 * n, 8 * n).reshape(3, n)))
        every = np.concatenate([b[0] for b in bodies])
        order = np.argsort(every, kind="stable")
        new = np.r_[True, every[order][1:] != every[order][:-1]]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(every)])
        turn = np.arange(len(every)) - np.repeat(starts, sizes)
        # -1: alone; 0: one shard; above: the shards of a hot hash, dealt out in turn.
        deal = np.empty(len(every), np.int32)
        within = np.concatenate([b[1][2] for b in bodies])[order] < 0
        deal[order] = np.where((np.repeat(sizes, sizes) < 2) & ~within, -1, np.where(np.repeat(sizes, sizes) > HOT_RUNS, 1 + turn // HOT_RUNS, 0))
        if (part := int(group["part"].iloc[0])) >= parts:
            deal[order] = 1 + (turn + part * 7_919) % deals[np.searchsorted(hot, every[order])]
        del order, every, turn
        out, begin = [], 0
        for *ids, names, (h, (number, first, windows)) in zip(*(group[c] for c in _KEY), group["names"], bodies):
            own = deal[begin:begin + len(h)]
            begin += len(h)
            at = np.flatnonzero(own >= 0)
            if not len(at):
                continue
            table = np.empty(len(at), _RUN)
            table["hash"], table["first"], table["windows"], table["deal"] = h[at], first[at], np.abs(windows[at]), own[at]
            names = np.frombuffer(names, "<i8").reshape(3, -1)
            used, of = np.unique(number[at], return_inverse=True)
            out.append((*ids, names[:, used].tobytes(), of.astype("<i4").tobytes(), table.tobytes()))
        return pd.DataFrame(out, columns=[*_KEY, "names", "of", "runs"])

    def by_document(group: pd.DataFrame) -> pd.DataFrame:
        found: dict[tuple, list[bytes]] = {}
        for names, of, table in zip(group["names"], group["of"], group["runs"]):
            names, of = np.frombuffer(names, "<i8").reshape(3, -1).T.tolist(), np.frombuffer(of, "<i4")
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(len(names) + 1)).tolist()
            table = np.frombuffer(table, _RUN)[order]
            for key, x, y in zip(names, cuts, cuts[1:]):
                found.setdefault(tuple(key), []).append(table[x:y].tobytes())
        return pd.DataFrame([(*key, b"".join(own)) for key, own in found.items()], columns=[*_KEY, "runs"])

    # A group of texts is named by its first document.
    found = rows.select(*_KEY, "text").mapInArrow(local, f"part int, {_KEY_SCHEMA}, names binary, body binary")
    some = found.groupBy("part").applyInPandas(repeated, f"{_KEY_SCHEMA}, names binary, of binary, runs binary")
    return written(some.groupBy(*_KEY).applyInPandas(by_document, f"{_KEY_SCHEMA}, runs binary"), "runs")


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, tie, row, spans): for each document with repeats the spans to remove, as they come."""
    runs = repeated_runs(rows, length)

    def weigh(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            tables = [np.frombuffer(x, _RUN) for x in b.column(0).to_pylist()]
            sizes = [int(t["windows"].sum()) + (length - 1) * len(t) for t in tables]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n"])

    shards = parts_for(runs.select("runs").mapInArrow(weigh, "n long").agg(F.sum("n")).first()[0] or 0, SHARD_BYTES)

    def cut(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found: dict[tuple[int, int], dict] = {}
            names = list(zip(*(b.column(i).to_pylist() for i in range(3))))
            for key, raw, table in zip(names, raw_texts(b.column(3)), b.column(4).to_pylist()):
                table = np.frombuffer(table, _RUN)
                for h, first, windows, deal in zip(*(table[c].tolist() for c in _RUN.names)):
                    run = raw[first:first + windows + length - 1]
                    # Equal runs of the batch travel once, with all their places.
                    found.setdefault((h % shards, deal), {}).setdefault((h, run), []).append((*key, first))
            rows_out = [[], [], [], [], [], [], []]
            small = zstandard.ZstdCompressor(level=1).compress
            for (shard, deal), own in found.items():
                values = (shard, deal, np.array([n[0] for n in own], "<u8").tobytes(), small(b"".join([n[1] for n in own])),
                          np.array([len(n[1]) for n in own], "<i4").tobytes(), np.array([len(p) for p in own.values()], "<i4").tobytes(), np.array([x for p in own.values() for x in p], "<i8").T.tobytes())
                for column, value in zip(rows_out, values):
                    column.append(value)
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows_out, kinds)],
                                             ["shard", "deal", "hashes", "runs", "sizes", "counts", "places"])

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        own, deal, shard = _Runs(), int(group["deal"].iloc[0]), int(group["shard"].iloc[0])
        for hashes, runs, sizes, counts, places in zip(*(group[c] for c in ("hashes", "runs", "sizes", "counts", "places"))):
            runs, stops = zstandard.ZstdDecompressor().decompress(runs), np.cumsum(np.frombuffer(sizes, "<i4")).tolist()
            names = [runs[x:y] for x, y in zip([0, *stops], stops)]
            place = iter(np.frombuffer(places, "<i8").reshape(4, -1).T.tolist())
            for h, name, n in zip(np.frombuffer(hashes, "<u8").tolist(), names, np.frombuffer(counts, "<i4").tolist()):
                for _ in range(n):
                    *key, first = next(place)
                    own.add((h, name), tuple(key), first)
        sort_runs(own, length)
        columns = [*_KEY, "spans", "shard", "deal", "n", "runs", "sizes", "places"]
        out = [(*r, -1, 0, 0, None, None, None) for r in own.rows()]
        if deal:
            out.append((0, 0, 0, None, shard, deal, sum(len(name[1]) - length + 1 for name in own.number), *_packed(own)))
        return pd.DataFrame(out, columns=columns)

    pieces = rows.select(*_KEY, "text").join(runs, _KEY).mapInArrow(
        cut, "shard int, deal int, hashes binary, runs binary, sizes binary, counts binary, places binary")
    sorted_ = written(pieces.groupBy("shard", "deal").applyInPandas(
        sort, f"{_KEY_SCHEMA}, spans binary, shard int, deal int, n long, runs binary, sizes binary, places binary"), "sorted")
    merged = merged_spans(sorted_.where("shard >= 0").select("shard", "deal", "n", "runs", "sizes", "places"), length)
    spans = sorted_.where("shard < 0").select(*_KEY, "spans").unionByName(merged)
    return spans.groupBy(*_KEY).agg(F.collect_list("spans").alias("spans"))


def _removed(spans: list[bytes] | None) -> list[tuple[int, int]]:
    """The maximal removed stretches, in order."""
    if not spans:
        return []
    pairs = np.concatenate([np.frombuffer(s, np.int64) for s in spans]).reshape(-1, 2)
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, pairs.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _kept(raw: bytes, removed: list[tuple[int, int]]) -> bytes:
    stops = [0, *[b for _, b in removed]]
    return b"".join([raw[a:b] for a, b in zip(stops, [*[a for a, _ in removed], len(raw)])])


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out: list[list] = [[], [], [], []]
            for raw, spans in zip(raw_texts(b.column(1)), b.column(2).to_pylist()):
                removed = _removed(spans)
                for column, value in zip(out, (len(raw), sum(y - x for x, y in removed), len(removed), hashlib.sha256(_kept(raw, removed)).hexdigest())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, pa.int64()) for x in out[:3]], pa.array(out[3], pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _identified(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.join(repeated_spans(rows, length), _KEY, "left").select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def keep_first(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with repeated strings cut out of their texts; characters cut in two go as well.

    Texts that lose nothing, null ones included, and all other columns stay as they were.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = [_kept(raw, _removed(spans)).decode("utf-8", "ignore") for raw, spans in zip(raw_texts(b.column(0)), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column(2)], ["text", carrier])

    def quoted(name: str) -> str:
        return f"`{name.replace('`', '``')}`"

    # Spark tells names apart without regard to case.
    carrier, taken = "whole", {c.lower() for c in docs.columns}
    while carrier in taken:
        carrier += "_"
    rows = _identified(docs.withColumn(carrier, F.struct(*[F.col(quoted(c)) for c in docs.columns])), carrier)
    joined = rows.join(repeated_spans(rows, length), _KEY, "left")
    same = joined.where("spans IS NULL").select(f"{carrier}.*")
    schema = StructType().add("text", "string").add(carrier, joined.schema[carrier].dataType)
    cut = joined.where("spans IS NOT NULL").select("text", "spans", carrier).mapInArrow(run, schema)
    return same.unionByName(cut.select(*[F.col("text") if c == "text" else F.col(f"{carrier}.{quoted(c)}") for c in docs.columns]))
