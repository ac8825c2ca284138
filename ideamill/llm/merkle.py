"""Merkle manifest of a document table, and proofs of all its documents by octopus multiproofs.

Each row is a leaf: the digest of its fields. The leaves of a source, in ascending order of doc_id, are the first level of
the source's tree; runs of ``FANOUT`` nodes become the node above them. The sources' roots, in order of source, are the
leaves of the top tree (``TOP``), whose root stands for the table. All nodes are one written table (tree, level, place).

Leaves are dealt into parts of ``PART_LEAVES`` neighbours. A part computes which node digests its leaves' proofs need and its
own leaves can't give (the minimal union, level by level), fetches these once, derives the nodes that its proofs share, and
writes out each proof by itself. A fold stops where it meets a node that the part has derived: the rest would be the same.

Contract: null fields are marked, null sources are a source of their own and come first, null doc_ids come first in their
source; equal doc_ids go by leaf digest, equal leaves follow each other in any order, as nothing tells them apart; a text of
any length is one field; one source may hold any share of the rows; one row or one source is its own root and its proof is
empty; an empty table has no nodes and no root; other columns are not read.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ideamill.llm.common import written
from ideamill.operators.numbering import global_number

FANOUT = 16
PART_LEAVES = 1 << 13
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(columns: Iterable[Column]) -> Column:
    """The digest of fields, each as '-' if null, else its length in bytes, ':' and its value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


@dataclass(frozen=True)
class Manifest:
    """leaves: source, doc_id, leaf, probe, tree, idx, n (leaves of the tree), place; nodes: tree, level, idx, n, digest."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int
    root: str | None


def _levels(first: DataFrame, most: int) -> list[DataFrame]:
    """The nodes of all levels of trees whose first level has up to most nodes: (tree, level, idx, n, digest)."""
    levels = [first]
    while most > 1:
        run = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        above = (
            levels[-1].where("n > 1")
            .groupBy("tree", "level", "n", F.floor(F.col("idx") / FANOUT).alias("parent"))
            .agg(F.sha2(F.array_join(run["digest"], ""), 256).alias("digest"))
            .select("tree", (F.col("level") + 1).alias("level"), F.col("parent").alias("idx"),
                    F.ceil(F.col("n") / FANOUT).alias("n"), "digest"))
        levels.append(written(above, "merkle-level"))
        most = -(-most // FANOUT)
    return levels


def build_manifest(docs: DataFrame, probe: Column | None = None) -> Manifest:
    """The tables of the manifest. probe: another value of the text, whose digest each leaf's row carries along."""
    own = [F.col(c) for c in FIELDS]
    leaf, other = leaf_digest(own), F.lit(None).cast("string")
    if probe is not None:  # Null where the text is as it was: the digest would be the leaf's.
        other = F.when(~probe.eqNullSafe(F.col("text")), leaf_digest([*own[:-1], probe]))
    rows = written(docs.select("source", "doc_id", leaf.alias("leaf"), other.alias("probe"),
                               F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    placed = global_number(rows, ["source", "doc_id", "leaf", "row"], "place", 0)
    sources = placed.groupBy("source").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    sources = written(global_number(sources, ["source"], "tree", 0), "merkle-sources")
    sizes = sources.agg(F.max("n"), F.count("*")).first()
    most, trees = sizes[0] or 0, sizes[1]
    # A hot source is split by adaptive execution where sources are too many for a broadcast.
    by_source = sources.withColumnRenamed("source", "_source")
    leaves = written(placed.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "doc_id", "leaf", "probe", "tree", (F.col("place") - F.col("first")).alias("idx"), "n", "place"), "merkle-placed")
    level = F.lit(0).cast("long").alias("level")
    levels = _levels(leaves.select("tree", level, "idx", "n", F.col("leaf").alias("digest")), most)
    roots = _union(levels).where("n = 1").select(
        F.lit(TOP).cast("long").alias("tree"), level, F.col("tree").alias("idx"),
        F.lit(trees).cast("long").alias("n"), "digest")
    top = _levels(written(roots, "merkle-roots"), trees)
    nodes = _union(levels + top)
    root = top[-1].where("n = 1").select("digest").first()
    return Manifest(leaves, nodes, trees, root[0] if root else None)


def _union(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole


def missing_nodes(places: Iterable[int], n: int) -> Iterator[tuple[int, int]]:
    """(level, place) of the nodes that the proofs of some leaves of a tree of n need and these can't give."""
    known, level = sorted(set(places)), 0
    while n > 1:
        have = set(known)
        parents = sorted({i // FANOUT for i in known})
        for p in parents:
            for i in range(p * FANOUT, min(n, (p + 1) * FANOUT)):
                if i not in have:
                    yield level, i
        known, level, n = parents, level + 1, -(-n // FANOUT)


class Branches:
    """The part of a tree above some leaves, derived from them and the fetched nodes."""

    def __init__(self, leaves: dict[int, str], n: int, fetched: dict[tuple[int, int], str]):
        self.runs: list[dict[int, list[str]]] = []
        digests, level = leaves, 0
        while n > 1:
            runs, above = {}, {}
            for p in sorted({i // FANOUT for i in digests}):
                run = [digests[i] if i in digests else fetched[level, i] for i in range(p * FANOUT, min(n, (p + 1) * FANOUT))]
                runs[p], above[p] = run, _hash("".join(run))
            self.runs.append(runs)
            digests, level, n = above, level + 1, -(-n // FANOUT)
        self.root = digests[0]
        self._shared: dict[int, str] = {}

    def siblings(self, place: int) -> str:
        """The digests of the siblings of a leaf's path, level by level; what neighbours share is joined once."""
        if not self.runs:
            return ""
        run, at = self.runs[0][place // FANOUT], place % FANOUT
        parent = place // FANOUT
        if parent not in self._shared:
            parts, i = [], parent
            for runs in self.runs[1:]:
                other = runs[i // FANOUT]
                parts += other[:i % FANOUT] + other[i % FANOUT + 1:]
                i //= FANOUT
            self._shared[parent] = "".join(parts)
        return "".join(run[:at] + run[at + 1:]) + self._shared[parent]

    def fold(self, place: int, digest: str) -> str:
        """The root that a leaf's digest and the siblings of its path give."""
        for runs in self.runs:
            run, at = runs[place // FANOUT], place % FANOUT
            if run[at] == digest:
                return self.root
            digest = _hash("".join([*run[:at], digest, *run[at + 1:]]))
            place //= FANOUT
        return digest


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def proofs(manifest: Manifest, leaves: DataFrame | None = None, part_leaves: int = PART_LEAVES,
           digests: bool = False) -> DataFrame:
    """Per leaf: source, doc_id, leaf, subroot, root, the proof and folded_root (of the probe, else the leaf).

    leaves: the rows of the manifest's leaves to prove, all by default. The proof is siblings, the digests of the path's
    siblings one after the other, or with digests only their proof_sha256.
    """
    proof = "proof_sha256" if digests else "siblings"
    wanted = manifest.leaves if leaves is None else leaves
    wanted = wanted.withColumn("part", F.floor(F.col("place") / part_leaves))
    missing = wanted.select("part", "tree", "idx", "n").groupBy("part").applyInPandas(
        _missing_of_part(manifest.trees), "part long, tree long, level long, idx long")
    fetched = missing.join(manifest.nodes.drop("n"), ["tree", "level", "idx"])
    schema = StructType([
        StructField("source", wanted.schema["source"].dataType), StructField("doc_id", wanted.schema["doc_id"].dataType),
        *StructType.fromDDL(f"leaf string, subroot string, root string, {proof} string, folded_root string")])
    return wanted.groupBy("part").cogroup(fetched.groupBy("part")).applyInPandas(
        _prove_part(manifest.trees, proof), schema)


def _missing_of_part(trees: int):
    def missing(pdf):
        import pandas as pd

        part, rows = pdf["part"].iloc[0], []
        for (tree, n), own in pdf.groupby(["tree", "n"]):
            rows += [(part, tree, level, i) for level, i in missing_nodes(own["idx"].tolist(), int(n))]
        rows += [(part, TOP, level, i) for level, i in missing_nodes(pdf["tree"].tolist(), trees)]
        return pd.DataFrame(rows, columns=["part", "tree", "level", "idx"])

    return missing


def _prove_part(trees: int, proof: str):
    shown = _hash if proof == "proof_sha256" else str

    def prove(pdf, nodes):
        import pandas as pd

        fetched: dict[int, dict] = {}
        for tree, level, i, digest in nodes[["tree", "level", "idx", "digest"]].itertuples(index=False):
            fetched.setdefault(tree, {})[level, i] = digest
        branches = {}
        for (tree, n), own in pdf.groupby(["tree", "n"]):
            branches[tree] = Branches(dict(zip(own["idx"], own["leaf"])), int(n), fetched.get(tree, {}))
        top = Branches({t: b.root for t, b in branches.items()}, trees, fetched.get(TOP, {}))
        above = {t: top.siblings(t) for t in branches}
        rows = []
        for leaf, probe, tree, i in zip(pdf["leaf"], pdf["probe"], pdf["tree"], pdf["idx"]):
            own = branches[tree]
            subroot = own.fold(i, leaf if probe is None else probe)
            folded = top.root if subroot == own.root else top.fold(tree, subroot)
            rows.append((own.root, top.root, shown(own.siblings(i) + above[tree]), folded))
        found = pd.DataFrame(rows, columns=["subroot", "root", proof, "folded_root"], index=pdf.index)
        return pd.concat([pdf[["source", "doc_id", "leaf"]], found], axis=1)

    return prove


def audit_digests(docs: DataFrame, tampered: Column) -> DataFrame:
    """All rows proven against the manifest of docs, with the texts in lower case where tampered holds."""
    probe = F.when(F.coalesce(tampered, F.lit(False)), ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return proofs(build_manifest(docs, probe), digests=True).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
