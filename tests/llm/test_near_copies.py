"""Near copies by wide fingerprints against plain ones, and their recall at given similarities."""

import random

import numpy as np
import pytest
import xxhash

from ideamill.llm import near_copies
from tests.llm.conftest import CLASHING

MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def plain_print(text, words=5):
    """The bits of a text as one integer."""
    found = (text or "").encode().lower().split()
    if not found:
        return None
    shingles = [b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    ones = [0] * 640
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for k in range(10):
            own = mixed(h + k * 0x9E3779B97F4A7C15 & MASK)
            for i in range(64):
                ones[64 * k + i] += own >> i & 1
    return sum(1 << i for i, n in enumerate(ones) if 2 * n > len(shingles))


def plain_groups(texts):
    """For each text the number of its component, None without words: links by one equal block and 112 bits."""
    cache = {t: plain_print(t) for t in set(texts)}
    prints = [cache[t] for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            b = prints[j]
            if a is None or b is None or (a ^ b).bit_count() > 112:
                continue
            if any((a ^ b) >> 16 * t & 0xFFFF == 0 for t in range(40)):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [None if p is None else find(i) for i, p in enumerate(prints)]


def changed(rng, words, share):
    """A copy in which single words are replaced until the similarity of five-word shingles is about share."""
    def shingles(w):
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    copy, own = list(words), shingles(words)
    while True:
        trial = list(copy)
        trial[rng.randrange(len(trial))] = f"new{rng.random()}"
        other = shingles(trial)
        if len(own & other) / len(own | other) < share:
            return copy
        copy = trial


def vocabulary(rng):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(2_000)]


def test_fingerprints_equal_plain_ones():
    rng = random.Random(1)
    words = vocabulary(rng)
    for n in (0, 1, 4, 5, 6, 300):
        text = " ".join(rng.choice(words) for _ in range(n)) + " the the the the the the"[:n * 4]
        want = plain_print(text)
        assert near_copies.wide_fingerprint(text.encode()) == (want.to_bytes(80, "little") if want is not None else None)
    assert near_copies.wide_fingerprint(("a b " * 3_000).encode()) == plain_print("a b " * 3_000).to_bytes(80, "little")


def test_pairs_of_a_similarity_of_four_fifths_are_found(spark):
    """Recall of 0.9 and more at similarity 0.8, and no link between other texts."""
    rng = random.Random(2)
    words, rows = vocabulary(rng), []
    for pair in range(300):
        own = [rng.choice(words) for _ in range(rng.randint(150, 500))]
        rows += [(2 * pair, " ".join(own)), (2 * pair + 1, " ".join(changed(rng, own, 0.8)))]
    kept = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(2 * p in kept for p in range(300))
    assert sum(2 * p + 1 not in kept for p in range(300)) >= 0.9 * 300


@pytest.mark.parametrize("tree_points", [4_096, 5])
def test_groups_equal_plain_ones(spark, tmp_path, tree_points):
    rng = random.Random(3)
    words, texts = vocabulary(rng), []
    for size in (40, 7, 3, 2, 1, 1):
        own = [rng.choice(words) for _ in range(120)]
        texts += [" ".join(changed(rng, own, 0.93)) for _ in range(size)]
    texts += ["a", "A", "a b c", "a b c d", "", None]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "place long, text string")
    rows = [(r.place, near_copies.wide_fingerprint((r.text or "").encode())) for r in table.collect()]
    distinct = {p: i for i, p in reversed(rows) if p}
    spark.createDataFrame([(i, p) for p, i in distinct.items()], "place long, print binary").write.parquet(f"{tmp_path}/prints")
    links = near_copies.near_links(spark.read.parquet(f"{tmp_path}/prints"), tree_points).collect()
    root = {i: i for i in distinct.values()}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    want = plain_groups(texts)
    assert {i: find(distinct[p]) for i, p in rows if p} == {i: g for i, g in enumerate(want) if g is not None}


def test_edge_rows_stay_as_they_were(spark, edge_docs):
    rows = [tuple(r) for r in edge_docs.collect()]
    got = near_copies.keep_one(edge_docs)
    assert got.columns == edge_docs.columns and set(CLASHING) <= set(got.columns)
    found = [tuple(r) for r in got.collect()]
    groups = plain_groups([r[1] for r in rows])
    best = {}
    for r, g in zip(rows, groups):
        if g is not None and (g not in best or (r[0] is None, r[0] or 0) < best[g]):
            best[g] = (r[0] is None, r[0] or 0)
    assert len(found) == sum(g is None for g in groups) + len(best)
    assert not set(map(repr, found)) - set(map(repr, rows))
    assert {(r[0] is None, r[0] or 0) for r in found if plain_print(r[1]) is not None} == set(best.values())
    assert near_copies.keep_one(edge_docs.limit(0)).count() == 0


def test_distances_of_words_and_rows():
    a, b = np.array([3, 0], np.uint64), np.array([0, 0], np.uint64)
    from ideamill.llm.simhash import distances
    assert distances(a, b).tolist() == [2, 0] and distances(a[None], b[None]).tolist() == [2]
