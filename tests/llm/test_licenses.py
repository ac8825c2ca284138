"""Licence scan against plain searches, and the expression parser against hand-made cases."""

import random
import re
from collections import Counter

import pytest

from ideamill.llm import licenses
from ideamill.llm.common import table
from ideamill.llm.queries import QUERIES
from tests.llm.conftest import edge_rows

NAME = "op13_license_expressions"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = WORD.findall((text or "").translate(LOW))
    places = []
    for phrase, label in {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(own)] == own]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def shown(rows):
    return Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)


def check(spark, folder, rows):
    got = QUERIES[NAME](spark, folder).collect()
    assert shown(got) == Counter((d, *plain(t)) for d, t in rows)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def test_op13_base_equals_plain_search(spark, edge_folder):
    check(spark, edge_folder, edge_rows())
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    check(spark, "/root/testdata/sf0.01", [(r.doc_id, r.text) for r in docs.collect()])


def test_op13_overlaps_borders_and_marks(spark, tmp_path):
    rng = random.Random(4)
    bits = ["mit", "MIT", "License", "license", "general", "public", "Apache", "é", "_", "-", "\n", ".", "ſ", "K", "mitx", "\x00"]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", "", "-", "\t"]) for _ in range(rng.randint(1, 40))) for _ in range(500)]
    texts += ["MIT license mit license MIT-LICENSE", "permit license", "mit licenses", "general public license" * 2, None, ""]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, str(tmp_path), rows)


@pytest.mark.parametrize("text, labels, level", [
    ("MIT", "mit", 0.2), ("MIT OR GPL-3.0-only", "gpl,mit", 0.2), ("mit AND gpl-3.0-only", "gpl,mit", 0.7),
    ("MIT OR Apache-2.0 AND GPL-2.0+", "apache,gpl,mit", 0.2), ("(MIT OR Apache-2.0) AND GPL-2.0+", "apache,gpl,mit", 0.7),
    ("GPL-2.0-only WITH Classpath-exception-2.0", "gpl", 0.6), ("GPL-2.0 WITH x AND MIT", "gpl,mit", 0.6),
    ("LicenseRef-Proprietary", "reserved", 1.0), ("Foo-1.0", "unknown", 0.4), ("MIT Copyright GPL", "mit", 0.2),
    ("(MIT OR", "", 0.0), ("(MIT", "", 0.0), ("MIT OR (GPL", "mit", 0.2), ("OR MIT", "", 0.0), ("MIT OR\nGPL", "mit", 0.2),
    ("((MIT)) OR lgpl-2.1", "lgpl,mit", 0.2), ("MIT) OR GPL", "mit", 0.2), ("", "", 0.0),
    ("MIT OR SPDX-License-Identifier: GPL", "gpl,mit", 0.7),
])
def test_expressions(text, labels, level):
    *_, found, score = licenses.scan_text(f"# SPDX-License-Identifier: {text}".encode())
    assert found == labels and score == pytest.approx(level)


def test_long_expressions_take_linear_time():
    chain = "spdx-license-identifier: " + " or ".join(["mit", "gpl"] * 50_000)
    nested = "spdx-license-identifier: " + "(" * 100_000 + "mit" + ")" * 100_000
    assert licenses.scan_text(chain.encode())[3:] == ("gpl,mit", 0.2)
    assert licenses.scan_text(nested.encode())[3:] == ("mit", 0.2)


def test_notices_have_places_and_phrases(spark):
    docs = spark.createDataFrame([(1, "Under the GNU Lesser General Public License, or CC BY-SA.")], "doc_id long, text string")
    row = licenses.scanned(docs).first()
    assert {(n.phrase, n.label, n.word) for n in row.notices} == {
        ("lesser general public license", "lgpl", 3), ("general public license", "gpl", 4), ("cc by", "cc-by", 8), ("cc by sa", "cc-by-sa", 8)}
    assert row.labels == "cc-by,cc-by-sa,gpl,lgpl" and row.score == 0.7


def test_op13_empty_table(spark, empty_folder):
    assert QUERIES[NAME](spark, empty_folder).count() == 0
