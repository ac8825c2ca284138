"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from ideamill.llm import exact_dedup, simhash
from ideamill.llm.queries import QUERIES
from tests.llm.conftest import edge_rows


def test_op9_groups(spark, edge_folder):
    got = QUERIES["op9_counting_quotient_filter"](spark, edge_folder).collect()
    groups = defaultdict(list)
    for d, t in edge_rows():
        groups[t or ""].append(d)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for d in ids:
            want[d, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_op9_colliding_fingerprints_are_told_apart(spark, edge_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: exact_dedup.F.lit(7).cast("long"))
    got = exact_dedup.duplicate_groups(edge_docs).collect()
    assert Counter(r.group_size for r in got) == Counter(
        n for n in Counter(t or "" for _, t in edge_rows()).values() for _ in range(n))


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3_000, 20_000).astype(np.uint64) * np.uint64(0x1234567)
    merged = []
    for part in np.split(values, 8):
        prints, counts = np.unique(part, return_counts=True)
        merged.append(exact_dedup.CountingQuotientFilter.of(prints, counts, 12))
    keys, counts = exact_dedup.CountingQuotientFilter.merged(merged, 12)
    want = Counter(values.tolist())
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(want)


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_op4_components(spark, edge_folder):
    got = QUERIES["op4_simhash_bk_trees"](spark, edge_folder).collect()
    rows = edge_rows()
    prints = [plain_print(t) for _, t in rows]
    roots = plain_components(prints)
    low = defaultdict(list)
    for (d, _), r in zip(rows, roots):
        low[r] += [d] if d is not None else []
    want = Counter((d, f"{p:016x}", min(low[r], default=None)) for (d, _), p, r in zip(rows, prints, roots))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("tree_points", [7, 4_096])
def test_links_of_dense_and_chained_prints(spark, tmp_path, tree_points):
    rng = random.Random(5)
    prints = set()
    for _ in range(6):
        p = rng.getrandbits(64)
        for _ in range(60):
            prints.add(p)
            for _ in range(rng.randint(1, 5)):
                p ^= 1 << rng.randrange(64)
    prints |= {rng.getrandbits(64) for _ in range(400)} | {0, (1 << 64) - 1, 7}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    spark.createDataFrame(signed, "print long").write.parquet(str(tmp_path / "p"))
    links = simhash.near_links(spark.read.parquet(str(tmp_path / "p")), tree_points)
    number = {s[0]: i for i, s in enumerate(signed)}
    member = {number[r.a]: number[r.b] for r in simhash.components(links).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for i, r in enumerate(plain_components(prints)):
        got[member.get(i, i)].add(i)
        want[r].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("operator, key", [
    (exact_dedup, lambda t: t or ""), (simhash, None)])
def test_keep_one(spark, edge_docs, operator, key):
    got = operator.keep_one(edge_docs)
    assert got.schema == edge_docs.schema
    rows = edge_rows()
    groups = [key(t) for _, t in rows] if key else plain_components([plain_print(t) for _, t in rows])
    ids = defaultdict(list)
    for (d, _), g in zip(rows, groups):
        ids[g].append(d)
    pick = max if operator is exact_dedup else min
    want = Counter(pick((d for d in own if d is not None), default=None) for own in ids.values())
    assert Counter(r.doc_id for r in got.collect()) == want


@pytest.mark.parametrize("name", ["op4_simhash_bk_trees", "op9_counting_quotient_filter"])
def test_empty_table(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).count() == 0
    for operator in (exact_dedup, simhash):
        assert operator.keep_one(spark.read.parquet(f"{empty_folder}/documents.parquet")).count() == 0
