"""The pipeline against plain versions of its stages, and without the package."""

import subprocess
import sys
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from ideamill.llm import toxicity
from ideamill.llm.common import table
from ideamill.llm.queries import VOCABULARY
from tests.llm.test_near_copies import plain_groups
from tests.llm.test_substrings import plain

DATA = "/root/testdata/sf0.001"


def test_stages_against_plain_ones(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    weights = toxicity.train(docs, labels.where(toxicity.fold(labels.doc_id, 5) != 0))
    dense = weights.dense()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(d, t) for d, t in rows if dense[toxicity.features(t.encode())].sum() + weights.bias < 0]
    rows = {t: d for d, t in sorted(rows)}
    rows = sorted((d, t) for t, d in rows.items())
    groups = defaultdict(list)
    for n, (row, root) in enumerate(zip(rows, plain_groups([t for _, t in rows]))):
        groups[n if root is None else -1 - root].append(row)
    rows = sorted(min(g) for g in groups.values())
    texts = [kept.decode("utf-8", "ignore") for kept, _, _ in plain([t.encode() for _, t in rows])]
    library = Tokenizer.from_file(VOCABULARY)
    want = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for (d, _), t in zip(rows, texts)}
    got = corpus_pipeline.run(spark, DATA).collect()
    found = {r.doc_id: r.doc_tokens for r in got}
    assert sorted(set(found.items()) ^ set(want.items())) == []
    assert sum(r.length for r in got) == sum(want.values())


def test_stages_return_the_columns_of_documents(spark, edge_folder):
    spark.createDataFrame([(3, 1, 0), (5, 1, 0), (7, 1, 0), (8, 1, 0), (4, 0, 1), (11, 0, 1)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{edge_folder}/labels.parquet")
    docs = table(spark, edge_folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, edge_folder).columns == docs.columns
    got = corpus_pipeline.run(spark, edge_folder).collect()
    ids = np.array([r.sequence_id for r in got])
    assert set(ids) == set(range(ids.max() + 1))


def test_pipeline_on_an_empty_table(spark, empty_folder):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{empty_folder}/labels.parquet")
    assert corpus_pipeline.run(spark, empty_folder).count() == 0


def test_the_rest_works_without_the_package():
    code = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("ideamill.llm", "corpus_pipeline")):
            raise ImportError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
names = e.queries()
assert "submission_fact" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(e.oracle_sql()) <= set(names)
"""
    assert subprocess.run([sys.executable, "-c", code], check=False).returncode == 0
