"""Alignment of two tokenizers: where their tokens end together, and how often which ids meet there.

Tokenizer A is byte-level (tokenizers library), B a piece model (sentencepiece) that puts a space before the text; A reads
the text with that space. The ends of both id lists are kept in dictionaries from end to index; the ends in both, sorted,
slice the lists into groups. In a group only the last tokens end together, so each slice gives one link.

Neither tokenizer joins a space to what stands before it, so a text is cut before single spaces between other characters
and each word is aligned once per worker; the tests compare with whole texts. A linked pair has one token whose bytes are
the end of the other's. That makes a list of all possible pairs, fixed by the two vocabularies (324,300 here): counts are
one array over that list, and this array alone is sent to the driver and to the tasks.

Contract: a null or empty text, or one whose tokens' bytes in A or B aren't those of the text behind a space, has no tokens
and zeros; strings of special tokens in a text are plain text; repeated rows are aligned and counted each; null keys are
kept; texts of any length are aligned whole; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ideamill.llm.common import written
from ideamill.llm.words import byte_marks

# Words in each of a memo's two generations; longer words are not kept.
MEMO_WORDS = 200_000
MEMO_LENGTH = 64
# New words that are encoded together, as one text.
WORDS_AT_ONCE = 1_000
GROUP_CHARS = 1 << 20
_LATIN_END = chr(0x250)
# U+180E is white space to some pattern libraries only: no cut next to it.
_CUT = re.compile(r"(?<=[^\s\u180e]) (?=[^\s\u180e])")
_OPEN_END = re.compile(r"[\s\u180e]\Z")


def common_ends(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The ends that both id lists have, sorted, and how many ids of A and of B each one closes."""
    a_at = dict(zip(a_ends, range(1, len(a_ends) + 1)))
    b_at = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    ends = sorted(a_at.keys() & b_at.keys())
    return ends, list(map(a_at.__getitem__, ends)), list(map(b_at.__getitem__, ends))


def slices(a_ids: list, b_ids: list, a_stops: list[int], b_stops: list[int]) -> Iterator[tuple[list, list]]:
    """Both id lists cut into groups at their common ends."""
    return zip((a_ids[i:j] for i, j in zip([0, *a_stops], a_stops)), (b_ids[i:j] for i, j in zip([0, *b_stops], b_stops)))


def byte_level_entries(file: str) -> dict[int, bytes]:
    """The bytes of each id of a byte-level vocabulary; special tokens have none."""
    from tokenizers import Tokenizer

    value = {mark: bytes([b]) for b, mark in enumerate(byte_marks())}
    vocab = Tokenizer.from_file(file).get_vocab(with_added_tokens=False)
    return {i: b"".join(map(value.__getitem__, entry)) for entry, i in vocab.items() if all(c in value for c in entry)}


def rank_encoding(file: str, entries: dict[int, bytes]):
    """The same vocabulary by ranks, if its ids are in the order of its merges; faster for plain letters."""
    import json

    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    model = json.loads(tokenizer.to_str())["model"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    first = len(entries) - len(pairs)
    if any(model["vocab"].get(a + b) != first + n for n, (a, b) in enumerate(pairs)):
        return None
    return tiktoken.Encoding("by-rank", pat_str=PATTERN, mergeable_ranks={raw: i for i, raw in entries.items()}, special_tokens={})


def piece_entries(model) -> dict[int, bytes]:
    """The bytes of each id of a piece model."""
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        found[i] = bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("\u2581", " ").encode()
    return found


def possible_pairs(a: dict[int, bytes], b: dict[int, bytes], width: int) -> np.ndarray:
    """The sorted codes a * width + b of all pairs of which one's bytes are an end of the other's."""
    codes: list[int] = []
    for one, other, left, right in ((a, b, width, 1), (b, a, 1, width)):
        by_bytes: dict[bytes, list[int]] = {}
        for i, raw in other.items():
            by_bytes.setdefault(raw, []).append(i)
        for i, raw in one.items():
            for start in range(len(raw)):
                codes += [i * left + j * right for j in by_bytes.get(raw[start:], ())]
    return np.unique(np.array(codes, np.int64))


class Aligner:
    """Aligns words and texts under two tokenizer files; one per worker process, so that its memo serves all tasks."""

    _loaded: dict[tuple[str, str], Aligner] = {}

    @classmethod
    def of(cls, a_file: str, b_file: str) -> Aligner:
        if (a_file, b_file) not in cls._loaded:
            cls._loaded[a_file, b_file] = cls(a_file, b_file)
        return cls._loaded[a_file, b_file]

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a_bytes, self.b_bytes = byte_level_entries(a_file), piece_entries(self.b)
        self.a_lean = rank_encoding(a_file, self.a_bytes)
        self.width = self.b.get_piece_size()
        if any(b" " in raw.lstrip(b" ") for raw in self.b_bytes.values()):
            raise ValueError("a piece of the second vocabulary joins a space to what stands before it")
        self.pairs = possible_pairs(self.a_bytes, self.b_bytes, self.width)
        self.now: dict = {}
        self.older: dict = {}

    def words(self, words: list[str]) -> list[tuple | None]:
        """Per word behind a space: ids in A, in B, groups, their digits and their links' numbers; None if bytes differ.

        Several words are encoded as one text, so only the last may end in white space.
        """
        if not words:
            return []
        raws = [b" " + w.encode() for w in words]
        joined = b"".join(raws)
        text = joined.decode()
        # Up to here what is a letter is the same to all pattern libraries.
        if self.a_lean and max(text) < _LATIN_END:
            a_ids = self.a_lean.encode_ordinary(text)
        else:
            a_ids = self.a.encode(text, add_special_tokens=False).ids
        b_ids = self.b.encode(text[1:], num_threads=1)
        a_parts, b_parts = list(map(self.a_bytes.get, a_ids)), list(map(self.b_bytes.get, b_ids))
        if None in a_parts or None in b_parts or b"".join(a_parts) != joined or b"".join(b_parts) != joined:
            # One of the words is to blame: halve until it stands alone.
            half = len(words) // 2
            return self.words(words[:half]) + self.words(words[half:]) if half else [None]
        ends, a_stops, b_stops = common_ends(list(accumulate(map(len, a_parts))), list(accumulate(map(len, b_parts))))
        digits = [f"{a[0] if len(a) == 1 else ','.join(map(str, a))}|{b[0] if len(b) == 1 else ','.join(map(str, b))}"
                  for a, b in slices(a_ids, b_ids, a_stops, b_stops)]
        # In a group only the last ids end together.
        a_last, b_last = np.array(a_stops, np.int64), np.array(b_stops, np.int64)
        links = np.array(a_ids, np.int64)[a_last - 1] * self.width + np.array(b_ids, np.int64)[b_last - 1]
        numbers = np.searchsorted(self.pairs, links).astype("<u4").tobytes()
        # A word ends where a token of A and one of B do.
        last = np.searchsorted(np.array(ends), np.cumsum([len(r) for r in raws]))
        n_a, n_b = (np.diff(x[last], prepend=0).tolist() for x in (a_last, b_last))
        stops = (last + 1).tolist()
        return [(a, b, j - i, ";".join(digits[i:j]).encode(), numbers[4 * i:4 * j])
                for a, b, i, j in zip(n_a, n_b, [0, *stops], stops)]

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, bytes]]:
        """Per text: ids in A, in B, groups, the sha256 of the groups and the links' numbers."""
        group, size = [], 0
        for i, text in enumerate(texts):
            group.append(_CUT.split(text) if text else [])
            size += len(text or "")
            if size >= GROUP_CHARS or i == len(texts) - 1:
                long = self._learn(set().union(*group))
                for words in group:
                    yield self._joined(words, long)
                group, size = [], 0

    def _joined(self, words: list[str], long: dict) -> tuple[int, int, int, str, bytes]:
        now = self.now
        found = [long[w] if w in long else now[w] for w in words] if long else list(map(now.__getitem__, words))
        if not found or None in found:
            return 0, 0, 0, "", b""
        n_a, n_b, n_groups, digits, numbers = zip(*found)
        return sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(b";".join(digits)).hexdigest(), b"".join(numbers)

    def _learn(self, words: set[str]) -> dict:
        """Have all words in the memo; those too long for it, or with white space at the end, are returned."""
        if len(self.now) > MEMO_WORDS:
            self.older, self.now = self.now, {}
        new = words.difference(self.now)
        known = new.intersection(self.older)
        self.now.update((w, self.older[w]) for w in known)
        new = new - known
        short = [w for w in new if len(w) <= MEMO_LENGTH and not _OPEN_END.search(w)]
        short.sort(key=lambda w: max(w, default="") >= _LATIN_END)
        for start in range(0, len(short), WORDS_AT_ONCE):
            some = short[start:start + WORDS_AT_ONCE]
            self.now.update(zip(some, self.words(some)))
        return {w: self.words([w])[0] for w in new if w not in self.now}


def alignments(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, groups_sha256 and links (numbers of possible pairs, 4 bytes each)."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *StructType.fromDDL(
        "n_a long, n_b long, n_groups long, groups_sha256 string, links binary")])
    kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]):
        aligner = Aligner.of(a_file, b_file)
        for b in batches:
            rows = list(aligner.texts(b.column(1).to_pylist()))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n): how many links of all documents hold each possible pair that occurs."""
    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(0, np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                counts = np.bincount(np.frombuffer(raw, "<u4"))
                if len(counts) > len(total):
                    total = np.pad(total, (0, len(counts) - len(total)))
                total[:len(counts)] += counts
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(total[pair], pa.int64())], ["pair", "n"])

    parts = links.select("links").mapInArrow(run, "pair long, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def pair_table(counts: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """(a, b, n): the counts by ids."""
    def run(batches: Iterator[pa.RecordBatch]):
        aligner = Aligner.of(a_file, b_file)
        for b in batches:
            codes = aligner.pairs[b.column(0).to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes // aligner.width), pa.array(codes % aligner.width), b.column(1)], ["a", "b", "n"])

    return counts.select("pair", "n").mapInArrow(run, "a long, b long, n long")


def with_counts(links: DataFrame, counts: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """The documents of a written links table with n_links, n_best and count_sum.

    counts has a row per possible pair at most, a number that the vocabularies fix.
    """
    found = counts.toPandas()
    aligner = Aligner.of(a_file, b_file)
    n = np.zeros(len(aligner.pairs), np.int64)
    n[found["pair"].to_numpy()] = found["n"].to_numpy()
    b_ids = aligner.pairs % aligner.width
    highest = np.zeros(aligner.width, np.int64)
    np.maximum.at(highest, b_ids, n)
    shared = links.sparkSession.sparkContext.broadcast((n, n == highest[b_ids]))
    own = [c for c in links.columns if c != "links"]
    schema = StructType([*[links.schema[c] for c in own], *StructType.fromDDL("n_links long, n_best long, count_sum long")])

    def run(batches: Iterator[pa.RecordBatch]):
        count, best = shared.value
        for b in batches:
            rows = []
            for raw in b.column(len(own)).to_pylist():
                pairs = np.frombuffer(raw, "<u4")
                rows.append((len(pairs), int(best[pairs].sum()), int(count[pairs].sum())))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(own)], *[pa.array(c, pa.int64()) for c in columns]], schema.names)

    return links.select(*own, "links").mapInArrow(run, schema)


def alignment_digests(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Alignments of all documents with the corpus-wide counts of their links."""
    links = written(alignments(docs, a_file, b_file), "links", compression="zstd")
    return with_counts(links, pair_counts(links), a_file, b_file)
