"""Alignment of two tokenizers against whole texts encoded by the libraries."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
import sentencepiece
from tokenizers import Tokenizer

from ideamill.llm import alignment
from ideamill.llm.common import table
from ideamill.llm.queries import BYTE_LEVEL, PIECES, QUERIES
from ideamill.llm.words import byte_marks
from tests.llm.conftest import edge_rows

NAME = "op12_hash_set_alignment"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def plain(libraries, text):
    """The groups of a whole text, by the definition."""
    if not text:
        return []
    a, b = libraries
    value = {mark: bytes([i]) for i, mark in enumerate(byte_marks())}
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_parts = [b"".join(value[c] for c in a.id_to_token(i)) for i in a_ids]
    b_parts = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in b_ids for p in [b.id_to_piece(i)]]
    if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
        return []
    a_ends, b_ends = list(accumulate(map(len, a_parts))), list(accumulate(map(len, b_parts)))
    groups, i, j, ends = [], 0, 0, set(b_ends)
    where = {e: n for n, e in enumerate(b_ends, 1)}
    for n, e in enumerate(a_ends, 1):
        if e in ends:
            groups.append((a_ids[i:n], b_ids[j:where[e]]))
            i, j = n, where[e]
    return groups


def plain_table(libraries, rows):
    found = [(d, plain(libraries, t)) for d, t in rows]
    counts, highest = Counter(), defaultdict(int)
    for _, groups in found:
        counts.update((a[-1], b[-1]) for a, b in groups)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = Counter()
    for d, groups in found:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        want[d, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
             sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(text.encode()).hexdigest() if text else ""] += 1
    return want, counts


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("folder", ["edge", "/root/testdata/sf0.001"])
def test_op12_equals_whole_texts(spark, edge_folder, libraries, folder):
    if folder == "edge":
        folder, rows = edge_folder, edge_rows()
    else:
        rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = QUERIES[NAME](spark, folder).collect()
    want, counts = plain_table(libraries, rows)
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == want
    links = alignment.alignments(table(spark, folder, "documents"), BYTE_LEVEL, PIECES)
    pairs = alignment.pair_table(alignment.pair_counts(links), BYTE_LEVEL, PIECES).collect()
    assert {(r.a, r.b): r.n for r in pairs} == counts


def test_odd_texts_align_like_whole_ones(libraries):
    rng = random.Random(7)
    letters = ["a", "B", "the", " ", " ", "  ", "\n", "é", "'s", "1", "22", ".", " ", "᠎", "\x00", "日", " ", "😀", "<s>",
               "\t", "<|endoftext|>", "\x1c", "\x85", "<0x0A>", "é", "xyz" * 40]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(3_000)]
    texts += ["▁", "a ▁b", " ", "   ", "\n", " \n ", "x ", " x", "a  b", "a" * 5_000, "ab cd" * 5_000, None, ""]
    found = alignment.Aligner.of(BYTE_LEVEL, PIECES).texts(texts)
    for text, (n_a, n_b, n_groups, digest, links) in zip(texts, found, strict=True):
        groups = plain(libraries, text)
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        assert (n_a, n_b, n_groups) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups)), text
        assert digest == (hashlib.sha256(shown.encode()).hexdigest() if groups else "") and len(links) == 4 * n_groups


def test_memo_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_WORDS", 10)
    aligner = alignment.Aligner(BYTE_LEVEL, PIECES)
    texts = [" ".join(f"w{(i * 7 + k) % 60}" for k in range(9)) for i in range(50)]
    monkeypatch.setattr(alignment, "GROUP_CHARS", 1)
    monkeypatch.setattr(alignment, "WORDS_AT_ONCE", 3)
    assert list(aligner.texts(texts)) == list(alignment.Aligner.of(BYTE_LEVEL, PIECES).texts(texts))


def test_slices_of_a_known_case():
    ends, a_stops, b_stops = alignment.common_ends([2, 3, 6], [3, 4, 6])
    assert (ends, a_stops, b_stops) == ([3, 6], [2, 3], [1, 3])
    assert list(alignment.slices([1, 2, 3], [7, 8, 9], a_stops, b_stops)) == [([1, 2], [7]), ([3], [8, 9])]


def test_op12_empty_table(spark, empty_folder):
    assert QUERIES[NAME](spark, empty_folder).count() == 0
