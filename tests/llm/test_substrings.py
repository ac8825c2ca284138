"""Repeated strings against a brute-force scan."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from ideamill.llm import simhash, substrings, toxicity
from ideamill.llm.queries import QUERIES
from tests.llm.conftest import CLASHING, edge_rows


def plain(texts, length=100):
    """texts in key order: kept bytes, removed bytes and spans of each."""
    seen = set()
    for raw in texts:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            window = raw[i:i + length]
            if window in seen:
                gone[i:i + length] = True
            seen.add(window)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        yield kept, int(gone.sum()), int((gone[1:] < gone[:-1]).sum())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def passages(seed=1):
    """Shared passages at any offset, copies, near copies, periodic texts, repeats inside a text."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [prose(rng.randint(15, 80)) for _ in range(8)]
    rows = []
    for i in range(150):
        text = prose(rng.randint(5, 120))
        for _ in range(rng.randint(0, 3)):
            cut = rng.randint(0, len(text))
            text = text[:cut] + rng.choice(shared)[rng.randint(0, 20):] + text[cut:]
        rows.append((i * 3, text))
    rows += [(1000 + i, rows[i][1]) for i in range(20)]
    for i in range(60):
        text = list(rows[7][1] + rows[8][1])
        text[rng.randrange(len(text))] = "#"
        rows.append((2000 + i, "".join(text)))
    for i, n in enumerate((37, 60, 76, 77, 90, 101)):
        line = prose(40)[:n]
        rows += [(2500 + i, prose(30) + line * 6 + prose(30)), (2600 + i, (line + prose(5)) * 4), (2700 + i, line * 3)]
    return rows + [(4, "ab" * 400), (3006, "ab" * 300 + "c"), (3007, "z" * 99), (3008, "z" * 100), (3009, "z" * 101), (3010, "x\x00" * 90)]


@pytest.mark.parametrize("hot", [4_096, 7])
def test_op7_against_a_scan(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_RUNS", hot)
    rows = passages()
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_suffix_arrays"](spark, folder).collect()}
    rows = ordered(rows)
    for (d, t), (kept, removed, spans) in zip(rows, plain([t.encode() for _, t in rows])):
        r = got[d]
        assert (d, r.n_bytes, r.n_removed, r.n_spans) == (d, len(t.encode()), removed, spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_op7_gathers_no_hot_hash(spark, tmp_path, monkeypatch):
    """A phrase of most texts with other text around it: right results, and no task holds all its runs."""
    monkeypatch.setattr(substrings, "HOT_RUNS", 64)
    monkeypatch.setattr(substrings, "PART_BYTES", 1 << 16)
    monkeypatch.setattr(substrings, "BUCKET_WINDOWS", 512, raising=False)
    monkeypatch.setattr(substrings, "SPREAD_RUNS", 512, raising=False)
    grouped = GroupedData.applyInPandas

    def bounded(self, func, schema):
        def checked(group):
            held = sum(len(x) for c in group for x in group[c] if isinstance(x, (bytes, bytearray)))
            assert held < 150_000, f"{held} bytes in one group"
            return func(group)
        return grouped(self, checked, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", bounded)
    rng = random.Random(9)
    noise = lambda: "".join(rng.choice("abcdefgh") for _ in range(90))
    phrase, lines = "the phrase that most of these texts have in common, other text stands around it", [noise() for _ in range(40)]
    rows = [(i, noise() + phrase + (rng.choice(lines) if i % 4 == 0 else noise())) for i in range(3_000)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op7_suffix_arrays"](spark, folder).collect()}
    want = {d: (removed, spans, hashlib.sha256(kept).hexdigest()) for (d, _), (kept, removed, spans) in zip(rows, plain([t.encode() for _, t in rows]))}
    assert got == want and sum(x[0] > 0 for x in want.values()) > 500


def test_op7_edges(spark, edge_folder):
    got = QUERIES["op7_suffix_arrays"](spark, edge_folder).collect()
    rows = ordered(edge_rows())
    sums = Counter()
    for (d, t), (kept, removed, spans) in zip(rows, plain([(t or "").encode() for _, t in rows])):
        sums[d, len((t or "").encode()), removed, spans, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == sums


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"ab"), n)) for n in (300, 1, 57, 220)] + [b"a" * 250, b"ab" * 130]
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts])
    order, half = substrings.suffix_order(buffer, ends, 100)
    raw = buffer.tobytes()
    heads = [raw[i:min(i + 100, ends[i])] for i in order.tolist()]
    assert [h.ljust(100, b"\0") for h in heads] == sorted(h.ljust(100, b"\0") for h in heads)
    shared = substrings.common_prefixes(buffer, ends, order, half, 100)
    for a, b, n in zip(heads, heads[1:], shared.tolist()):
        assert (n >= 100) == (a == b and len(a) == 100)


def test_keep_first_keeps_columns(spark, edge_folder):
    docs = spark.read.parquet(f"{edge_folder}/documents.parquet")
    got = substrings.keep_first(docs)
    assert got.columns == docs.columns
    rows = ordered(edge_rows())
    want = Counter((d, t if not n else kept.decode("utf-8", "ignore")) for (d, t), (kept, n, _) in zip(rows, plain([(t or "").encode() for _, t in rows])))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert Counter(r[CLASHING[0]] for r in got.collect()) == Counter(r[CLASHING[0]] for r in docs.collect())


def test_stages_keep_columns_of_any_name(spark):
    text = "".join(random.Random(2).choices("abcdef ", k=300))
    docs = spark.createDataFrame([(1, text, 5, 6, 7), (2, "x" + text, 8, 9, 10)], "doc_id long, text string, Whole int, `a b:c,d` int, `e``f` int")
    got = {r[0]: tuple(r) for r in substrings.keep_first(docs).collect()}
    assert got == {1: (1, text, 5, 6, 7), 2: (2, "x", 8, 9, 10)}
    kept = [simhash.keep_one(docs), toxicity.scored(docs.select("text", F.struct("*").alias("row")), toxicity.Weights(np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0), ["row"]).select("row.*")]
    for other in kept:
        assert other.columns == docs.columns and (1, text, 5, 6, 7) in [tuple(r) for r in other.collect()]


def test_empty_table(spark, empty_folder):
    assert QUERIES["op7_suffix_arrays"](spark, empty_folder).count() == 0
    assert substrings.keep_first(spark.read.parquet(f"{empty_folder}/documents.parquet")).count() == 0


def test_rows_in_no_file_are_written_once(spark, edge_docs, monkeypatch):
    """An own column named like the hidden one, a map column, and a table without texts."""
    calls = []
    real = substrings.written
    monkeypatch.setattr(substrings, "written", lambda df, name, **k: calls.append(name) or real(df, name, **k))
    docs = edge_docs.select("doc_id", "text", F.lit(1).alias("_metadata"), F.create_map(F.lit("k"), "doc_id").alias("held"))
    got = substrings.keep_first(docs)
    assert got.columns == docs.columns and got.count() == docs.count() and calls.count("documents") <= 1
    with pytest.raises(AnalysisException):
        substrings.keep_first(edge_docs.drop("text"))
