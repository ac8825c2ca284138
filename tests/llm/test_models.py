"""Toxicity, quality and language-model scores: exact values by brute force, verdicts on held-out rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ideamill.llm import language_model, quality, toxicity
from ideamill.llm.common import table
from ideamill.llm.queries import QUERIES
from tests.llm.conftest import edge_rows

DATA = "/root/testdata/sf0.1"
WORD = r"[^\x20\x09-\x0D]+"


def rest(key, of):
    return zlib.crc32(str(key).encode()) % of


@pytest.fixture(scope="module")
def labelled_folder(spark, edge_folder):
    marks = [(d, int(i % 3 > 0), int(i % 4 == 0)) for i, (d, _) in enumerate(edge_rows()) if i % 2]
    marks += [(5, None, 1), (None, 1, 1), (7, 1, None), (9, 0, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{edge_folder}/labels.parquet")
    return edge_folder


@pytest.fixture(scope="module")
def empty_labelled(spark, empty_folder):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{empty_folder}/labels.parquet")
    return empty_folder


def test_op5_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op5_ftrl_toxicity"](spark, DATA).collect()}
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (rest(d, 5) == 0) for d, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in table(spark, DATA, "labels").collect() if rest(r.doc_id, 5) == 0]
    caught, kept = [p for p, y in held if y], [p for p, y in held if not y]
    # 3,200 labelled rows don't hold all toxic stems of four languages; 16,000 give a recall above 0.99.
    assert sum(caught) >= 0.75 * len(caught) and sum(kept) <= 0.01 * len(kept)


def test_op5_edges(spark, labelled_folder):
    got = QUERIES["op5_ftrl_toxicity"](spark, labelled_folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in edge_rows())
    scores = {d: s for d, s in ((r.doc_id, r.score) for r in got)}
    assert scores[0] == scores[1] == scores[2]


def test_ftrl_is_sparse():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.append(rng.integers(100, 10_000, 40), 5 if i % 4 == 0 else 6)) for i in range(2_000)]
    weights = toxicity.fit(rows, [int(i % 4 == 0) for i in range(2_000)])
    dense = weights.dense()
    assert dense[5] > 1 and dense[6] < 0 and len(weights.slots) < 1_000


def plain_base(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in many for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_op8_base_values(spark, labelled_folder):
    got = QUERIES["op8_boosted_quality"](spark, labelled_folder).collect()
    want = Counter()
    for d, t in edge_rows():
        base = plain_base(t)
        want[(d, *base, base[0] < 10 or 100 * base[4] > 20 * base[0])] += 1
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_op8_on_held_out_rows(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    part = toxicity.fold(labels.doc_id, 5) == 0
    got = {r.doc_id: r.kept for r in quality.judged(docs, quality.train(docs, labels.where(~part))).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.where(part).collect()]
    good, bad = [k for k, q in held if q], [k for k, q in held if not q]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_trees_obey_their_signs():
    rng = np.random.default_rng(2)
    x = rng.random((3_000, 3))
    y = (x[:, 0] + 0.3 * np.sin(20 * x[:, 1]) + 0.2 * rng.standard_normal(3_000) > 0.6).astype(float)
    forest = quality.fit(x, y, [1, -1, 0])
    grid = np.linspace(0, 1, 50)
    for other in rng.random((20, 3)):
        rows = np.repeat(other[None], 50, 0)
        rows[:, 0] = grid
        assert (np.diff(forest.chance(rows)) >= 0).all()
        rows = np.repeat(other[None], 50, 0)
        rows[:, 1] = grid
        assert (np.diff(forest.chance(rows)) <= 0).all()


def plain_lm(rows):
    tokens = [(d, d is not None and rest(d, 10) == 0, re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]) for d, t in rows]
    counts = Counter(w for _, held, words in tokens if not held for w in words)
    n, v = sum(counts.values()), len(counts)
    for d, held, words in tokens:
        yield d, held, len(words), sum(counts[w] > 0 for w in words), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)


def test_op10_base(spark, edge_folder, monkeypatch):
    got = QUERIES["op10_log_bilinear"](spark, edge_folder).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    left = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=key)
    right = sorted(((*x[:5], round(x[5], 6)) for x in plain_lm(edge_rows())), key=key)
    assert left == right and all(r.score < 0 for r in got)


def test_op10_model_beats_the_base_on_held_out_rows(spark):
    got = [r for r in QUERIES["op10_log_bilinear"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_log_chances_add_up_to_one():
    whole = language_model.Totals((b"a", b"b", b"c"), np.array([5.0, 3, 2, 4, 6]), 20, 9)
    model = language_model.Model.start(whole)
    for one, two in ((5, 5), (0, 3), (4, 1)):
        every = language_model.log_chances(model, np.full(5, one), np.full(5, two), np.arange(5))
        assert math.isclose((10 ** every).sum(), 1, rel_tol=1e-5)
    # Four other distinct words with six tokens between them, and one place for unseen words.
    assert math.isclose((10 ** whole.other(np.array([2.0, 1, 1, 1, 1, 0]))).sum(), 1, rel_tol=0.02)


@pytest.mark.parametrize("name", ["op5_ftrl_toxicity", "op8_boosted_quality", "op10_log_bilinear"])
def test_empty_table(spark, empty_labelled, name):
    assert QUERIES[name](spark, empty_labelled).count() == 0
