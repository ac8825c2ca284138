"""Byte-pair encoding and decoding with a contiguous rank array per word.

Contract: null and empty texts have no ids and decode to the empty text; special tokens written in
a text get their own id; a text of any length is encoded whole; repeated rows give repeated rows;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from ideamill.llm.common import raw_texts
from ideamill.llm.words import WordMemo, byte_marks

NO_RANK = 1 << 30
# Words merged together.
ROWS = 4_096
# Words of more parts than this are merged through a heap: repeated scans would cost their square.
SCAN_PARTS = 256


class RankArrayBpe:
    """The encoder and decoder of one vocabulary file with word ends."""

    _loaded: dict[str, RankArrayBpe] = {}

    @classmethod
    def of(cls, file: str) -> RankArrayBpe:
        if file not in cls._loaded:
            cls._loaded[file] = cls(file)
        return cls._loaded[file]

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.rank, merged = {}, []
        for n, (a, b) in enumerate(model["merges"]):
            self.rank.setdefault(vocab[a] << 20 | vocab[b], n)
            merged.append(vocab[a + b])
        self.merged = np.array([*merged, 0], np.int32)
        pairs = np.array(sorted(self.rank), np.int64)
        self.pairs = np.append(pairs, np.iinfo(np.int64).max)
        self.pair_ranks = np.array([*[self.rank[p] for p in pairs.tolist()], NO_RANK], np.int32)
        self.file, self.marks, self.library = file, byte_marks(), None
        self.inner = [vocab.get(m) for m in self.marks]
        self.last = [vocab.get(m + end) for m in self.marks]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # Of each id its decimal text and its token's text, a space after each.
        self.id_bytes = {i: b"%d " % i for i in self.token}
        self.token_bytes = {i: t.encode() + b" " for i, t in self.token.items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The file's \s is the Unicode property; Python's class would add four control characters.
        self.pieces = regex.compile(pattern.replace("[^\\s", "[^\\p{White_Space}"), regex.V0)
        self.marked = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.memo = WordMemo(self._letters, self._whole_value, self._both)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], NO_RANK)

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        """Merge the parts of each word: the lowest rank first, of equal ranks the leftmost.

        Words of like length stand in the rows of one array: the parts between boundaries, and next
        to them the ranks of adjacent parts. Each round scans every row for its lowest rank, deletes
        that boundary and looks up the two neighbouring ranks again; rows without a rank leave.
        """
        done: list[list[int]] = [[]] * len(words)
        short = []
        for i, ids in enumerate(words):
            if len(ids) > SCAN_PARTS:
                done[i] = self._merge_long(ids)
            else:
                short.append(i)
        short.sort(key=lambda i: len(words[i]))
        for k in range(0, len(short), ROWS):
            rows = np.array(short[k:k + ROWS])
            sizes = np.array([len(words[i]) for i in rows.tolist()])
            width = int(sizes.max())
            parts = np.full((len(rows), width), -1, np.int32)
            parts[np.arange(width) < sizes[:, None]] = [x for i in rows.tolist() for x in words[i]]
            inside = np.arange(1, width) < sizes[:, None]
            ranks = np.where(inside, self.ranks_of(parts[:, :-1], parts[:, 1:]), NO_RANK)
            while len(rows):
                low = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
                at = np.arange(len(rows))
                lowest = ranks[at, low] if ranks.shape[1] else np.full(len(rows), NO_RANK)
                if (over := lowest == NO_RANK).any():
                    for i, n, ids in zip(rows[over].tolist(), sizes[over].tolist(), parts[over].tolist()):
                        done[i] = ids[:n]
                    rows, sizes, parts, ranks, low, lowest = (x[~over] for x in (rows, sizes, parts, ranks, low, lowest))
                    if not len(rows):
                        break
                    at = np.arange(len(rows))
                parts[at, low] = self.merged[lowest]
                cols = np.arange(parts.shape[1] - 1)
                parts = np.take_along_axis(parts, cols + (cols > low[:, None]), 1)
                cols = cols[:-1]
                ranks = np.take_along_axis(ranks, cols + (cols >= low[:, None]), 1)
                sizes = sizes - 1
                for side in (low - 1, low):
                    has = np.flatnonzero((side >= 0) & (side + 1 < sizes))
                    spot = side[has]
                    ranks[has, spot] = self.ranks_of(parts[has, spot], parts[has, spot + 1])
        return done

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, rank, merged = len(ids), self.rank.get, self.merged
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            low, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or rank(ids[i] << 20 | ids[j]) != low:
                continue
            ids[i], ids[j], after[i] = int(merged[low]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := rank(ids[a] << 20 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [i for i in ids if i >= 0]

    def _parts(self, raw: bytes) -> list[int]:
        """The parts that one pre-token starts with: its bytes, the last one marked as word end."""
        inner = self.inner
        ids = [inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return [i for i in ids if i is not None]

    def _pieces(self, part: str) -> list[bytes]:
        """The normalized pre-tokens of a part without special tokens."""
        if "Cn" in map(unicodedata.category, part):
            # Characters newer than Python's tables: the library's own tables say what they are.
            library = self.library = self.library or Tokenizer.from_file(self.file)
            text = library.normalizer.normalize_str(part)
            value = {m: b for b, m in enumerate(self.marks)}
            return [bytes(value[c] for c in piece) for piece, _ in library.pre_tokenizer.pre_tokenize_str(text)]
        text = "".join(map(str.lower, unicodedata.normalize("NFC", part)))
        return [piece.encode() for piece in self.pieces.findall(text)]

    def _whole(self, word: str) -> list[int]:
        ids = []
        for part in self.marked.split(word):
            if part in self.special:
                ids.append(self.special[part])
            else:
                for merged in self.merge([self._parts(p) for p in self._pieces(part)]):
                    ids += merged
        return ids

    def _value(self, ids: list[int]) -> tuple[list[int], int, bytes, bytes]:
        """The ids, their number, and their decimal and decoded texts with a space after each id."""
        return (ids, len(ids), b"".join(map(self.id_bytes.__getitem__, ids)),
                b"".join(map(self.token_bytes.__getitem__, ids)))

    def _whole_value(self, word: str) -> tuple[list[int], int, bytes, bytes]:
        return self._value(self._whole(word))

    def _letters(self, words: list[str]) -> Iterator[tuple[list[int], int, bytes, bytes]]:
        return map(self._value, self.merge([self._parts(w.encode()) for w in words]))

    def _both(self, a: tuple, b: tuple) -> tuple[list[int], int, bytes, bytes]:
        return a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of whole texts."""
        raws = [(t or "").encode() for t in texts]
        return [[i for value in values for i in value[0]] for values in self.memo.values(raws)]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by one space: the vocabulary names no decoder. Unknown ids are left out."""
        return " ".join([t for i in ids if (t := self.token.get(i)) is not None])

    def both_as_text(self, raws: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
        """For each whole text its id count, its ids as decimal text and its decoded text."""
        for values in self.memo.values(raws):
            _, counts, ids, tokens = zip(*values) if values else ((),) * 4
            yield sum(counts), b"".join(ids)[:-1], b"".join(tokens)[:-1]


def encode_texts(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): every whole text as token ids."""
    def run(batches: Iterator[pa.RecordBatch]):
        bpe = RankArrayBpe.of(file)
        for b in batches:
            ids = bpe.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the decoded texts of id arrays."""
    def run(batches: Iterator[pa.RecordBatch]):
        bpe = RankArrayBpe.of(file)
        for b in batches:
            texts = [bpe.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"{key} {encoded.schema[key].dataType.simpleString()}, text string")


def round_trip_digests(docs: DataFrame, file: str) -> DataFrame:
    """Per document the id count and the digests of its ids and of its decoded text, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]):
        bpe = RankArrayBpe.of(file)
        for b in batches:
            counts, of_ids, of_text = [], [], []
            for n, ids, text in bpe.both_as_text(raw_texts(b.column(1))):
                counts.append(n)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
