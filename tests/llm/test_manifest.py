"""Merkle manifest against a plain tree, SQL and planted changes."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ideamill.llm import merkle
from ideamill.llm.common import table
from ideamill.llm.queries import ORACLES, QUERIES
from tests.compare import connect, spark_rows, sql_rows

NAME = "op11_octopus_multiproofs"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """The root of a level and the proof of each of its nodes."""
    proofs = [[] for _ in digests]
    places = list(range(len(digests)))
    while len(digests) > 1:
        for proof, i in zip(proofs, places):
            run = i // 16 * 16
            proof += [d for j, d in enumerate(digests[run:run + 16], run) if j != i]
        digests = [h("".join(digests[i:i + 16])) for i in range(0, len(digests), 16)]
        places = [i // 16 for i in places]
    return digests[0], proofs


def plain_rows(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(sources[s], key=lambda x: x[:3]),) for s in order}
    trees = {s: (leaves, *climb([x[2] for x in leaves])) for s, (leaves,) in trees.items()}
    root, above = climb([trees[s][1] for s in order])
    found = Counter()
    for s, up in zip(order, above):
        leaves, subroot, proofs = trees[s]
        for (known, key, leaf, r), proof in zip(leaves, proofs):
            tampered = known and zlib.crc32(str(key).encode()) % 5 == 0 and r["text"] and r["text"] != r["text"].translate(low)
            found[r["doc_id"], leaf, subroot, root, h("".join(proof + up)), bool(tampered)] += 1
    return found


def shown(rows):
    return Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], not r["verified"]) for r in rows)


def test_op11_edge_rows(spark, edge_folder):
    rows = [r.asDict() for r in table(spark, edge_folder, "documents").collect()]
    assert shown(QUERIES[NAME](spark, edge_folder).collect()) == plain_rows(rows)


def test_op11_equals_sql_with_folds_of_tampered_leaves(spark, edge_folder):
    for folder in ("/root/testdata/sf0.001", edge_folder):
        assert spark_rows(QUERIES[NAME](spark, folder))[::2] == sql_rows(connect(folder), ORACLES[NAME])[::2]


def many(spark, n=3_000):
    rng = random.Random(5)
    data = [(i, f"Text {rng.random()}", "en", None if i % 3 else f"s{rng.randrange(300)}", i) for i in range(n)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


def test_small_parts_many_sources_and_a_hot_one(spark):
    docs = many(spark)
    manifest = merkle.build_manifest(docs)
    got = merkle.proofs(manifest, part_leaves=100).select("*", F.sha2("siblings", 256).alias("proof_sha256")).collect()
    want = Counter()
    for (key, leaf, subroot, root, proof, _), n in plain_rows([r.asDict() for r in docs.collect()]).items():
        want[key, leaf, subroot, root, proof] += n
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == want
    assert {r.folded_root for r in got} == {manifest.root}


def test_proofs_of_some_leaves_fetch_the_minimal_union(spark):
    manifest = merkle.build_manifest(many(spark))
    some = manifest.leaves.where("doc_id in (1, 2, 33, 2999, 1500)")
    got = merkle.proofs(manifest, some).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 33, 1500, 2999] and {r.folded_root for r in got} == {manifest.root}
    # Leaves 0 to 15 give their parent; only the parent's siblings are missing.
    assert list(merkle.missing_nodes(range(16), 40)) == [(1, 1), (1, 2)]
    assert list(merkle.missing_nodes([0, 17], 18)) == [*[(0, i) for i in range(1, 17)]]
    assert list(merkle.missing_nodes([3], 1)) == []


@pytest.mark.parametrize("changed", [0, 7, 17])
def test_a_changed_leaf_does_not_fold_to_the_root(changed):
    digests = [h(str(i)) for i in range(18)]
    branches = merkle.Branches(dict(enumerate(digests)), 18, {})
    assert branches.root == climb(digests)[0]
    assert branches.fold(changed, digests[changed]) == branches.root
    other = digests[:changed] + [h("x")] + digests[changed + 1:]
    assert branches.fold(changed, h("x")) == climb(other)[0] != branches.root


def test_op11_empty_and_single(spark, empty_folder, edge_docs):
    assert QUERIES[NAME](spark, empty_folder).count() == 0
    one = merkle.proofs(merkle.build_manifest(edge_docs.where("doc_id = 3"))).collect()
    assert [(r.leaf == r.subroot == r.root == r.folded_root, r.siblings) for r in one] == [(True, "")]
