"""Best-fit decreasing packing of tokenized documents into sequences of a fixed length.

Documents are encoded first; only pieces (document, start, length, checksum) are packed. A document
longer than a sequence is cut into full windows and a rest. Each part of the pieces is packed by
itself: longest first, each into the open sequence with the least room that still holds it, which a
segment tree indexed by remaining room finds. Full windows fill a sequence each.

Contract: a null text is an empty one and has the end id alone; repeated rows are packed each;
equal lengths go by document, start and checksum; null keys are kept; an empty table gives no piece;
a text of any length is packed whole; other columns are not read. Padding stays little because a
part holds PART_PIECES pieces: only a part's last sequences stay partly empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.llm.common import part_id, parts_for, raw_texts, starts_of_parts, written
from ideamill.llm.words import LibraryIds

PART_PIECES = 1 << 17


def pieces(docs: DataFrame, file: str, end_id: int, length: int, keep_ids: bool = False) -> DataFrame:
    """Documents as ids with end_id, cut at multiples of length: one row per piece."""
    def run(batches: Iterator[pa.RecordBatch]):
        library = LibraryIds.of(file)
        end = np.array([end_id], library.dtype).tobytes()
        for b in batches:
            counts, checks, kept = [], [], []
            for packed in library.encode(raw_texts(b.column(1))):
                ids = np.frombuffer(packed + end, library.dtype).astype("<u4")
                counts.append(len(ids))
                for start in range(0, len(ids), length):
                    piece = ids[start:start + length]
                    checks.append(zlib.crc32(piece))
                    if keep_ids:
                        kept.append(piece.astype(np.int32))
            total = np.array(counts, np.int64)
            parts = -(-total // length)
            row = np.repeat(np.arange(len(total)), parts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            arrays = [b.column(0).take(pa.array(row)), *map(pa.array, (start, np.minimum(length, total[row] - start))),
                      pa.array(checks, pa.int64()), pa.array(total[row])]
            if keep_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names[:len(arrays)])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids)


class RoomTree:
    """Open sequences by remaining room: leaf r counts those with room r, inner nodes add up."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        i, count = room + self.size, self.count
        while i:
            count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int:
        """The smallest room of at least need, or -1."""
        i, count = need + self.size, self.count
        if not count[i]:
            # Up until a right neighbour holds something, then down its left edge.
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return -1
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.size

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each of the lengths, given longest first, and the number of sequences."""
    full = int((lengths == length).sum())
    sequence, offset = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
    tree, used = RoomTree(length), full
    for i, need in enumerate(lengths[full:].tolist(), full):
        room = tree.tightest(need)
        if room < 0:
            room, own = length, used
            used += 1
        else:
            own = tree.take(room)
        sequence[i], offset[i] = own, length - room
        if room > need:
            tree.put(room - need, own)
    return sequence, offset, used


def pack(cut: DataFrame, length: int, part_pieces: int = PART_PIECES) -> DataFrame:
    """The pieces with sequence_id (gapless from 0) and offset. cut must be a written table.

    It has the columns of pieces(). Pieces are dealt out by a hash of the whole piece.
    """
    parts = parts_for(cut.count(), part_pieces)
    names = cut.columns

    def run(batches: Iterator[pa.RecordBatch]):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset, _ = best_fit_decreasing(table["length"].to_numpy(), length)
        part = np.full(len(sequence), part_id(), np.int32)
        table = table.append_column("part", pa.array(part)).append_column("in_part", pa.array(sequence, pa.int64()))
        yield from table.append_column("offset", pa.array(offset, pa.int64())).to_batches(max_chunksize=10_000)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    dealt = cut.repartition(parts, "doc_id", "start", "ids_crc32")
    placed = written(dealt.mapInArrow(run, f"{schema}, part int, in_part long, offset long"), "packed")
    totals = placed.groupBy("part").agg((F.max("in_part") + 1).alias("sequences"))
    # One row per part: MAX_PARTS at most, or as many as the session raises a repartition to.
    starts = F.broadcast(starts_of_parts(totals, "part", "sequences", "before"))
    return placed.join(starts, "part").select(
        *names, (F.col("in_part") + F.col("before")).alias("sequence_id"), "offset")


def packed_documents(docs: DataFrame, file: str, end_id: int, length: int, keep_ids: bool = False) -> DataFrame:
    """Encode, cut and pack whole documents."""
    return pack(written(pieces(docs, file, end_id, length, keep_ids), "pieces"), length)
