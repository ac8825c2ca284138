"""SimHash fingerprints of word shingles, linked through BK-trees.

Fingerprints at most RADIUS bits apart agree in two of five blocks of their bits, so distinct
fingerprints are dealt to shards by the values of two blocks, in all ten ways. Each shard is a
BK-tree: a node's children are keyed by their Hamming distance to it, and a search follows only the
edges within the radius of the distance found. Trees of many shards are built and searched together,
a level at a time. A shard of more than TREE_POINTS fingerprints is cut into trees of that size, and
each tree is sent to the shard's other blocks. Each task unites what it links and gives at most one
link per fingerprint, not all pairs.

Contract: null and wordless texts have fingerprint zero and are linked like others; repeated rows and
repeated or null doc_ids are rows like others; a component's id is its smallest known doc_id; an
empty table gives no row; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ideamill.llm.common import parts_for, raw_texts, written
from ideamill.llm.components import components

RADIUS = 3
TREE_POINTS = 4_096
SHARD_ROWS = 1 << 18
FRONTIER = 1 << 22
# Bits of the five blocks: first bit and width.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


def fingerprint(raw: bytes, words: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's word shingles, repeats included; a shorter text is one shingle."""
    found = raw.lower().split()
    if not found:
        return 0
    text, sizes = b" ".join(found), np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    last = min(words, len(found)) - 1
    starts = (ends - sizes)[:len(found) - last].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], seed) for a, b in zip(starts, ends[last:].tolist())], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 13):
        ones += np.unpackbits(hashes[i:i + (1 << 13)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (doc_id) and print, the fingerprint as a signed long."""
    keep = keep or ["doc_id"]
    fields = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            prints = np.array([fingerprint(raw, words, seed) for raw in raw_texts(b.column(0))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(prints, pa.int64())], [*keep, "print"])

    schema = StructType(fields).add("print", "long")
    return docs.select(F.col("text").alias("_text"), *keep).mapInArrow(run, schema)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints: one word each, or a row of words."""
    bits = np.bitwise_count(a ^ b)
    return bits.astype(np.int64) if bits.ndim == 1 else bits.sum(axis=1, dtype=np.int64)


class BkForest:
    """BK-trees over points sorted by group; the first point of a group is its root."""

    def __init__(self, points: np.ndarray, roots: np.ndarray):
        self.points, self.bits = points, 64 * points[:1].size
        waiting = np.flatnonzero(roots != np.arange(len(points)))
        parent, codes, nodes = roots[waiting], [], []
        while len(waiting):
            code = parent * (self.bits + 1) + distances(points[waiting], points[parent])
            own, first, which = np.unique(code, return_index=True, return_inverse=True)
            child = waiting[first]
            codes.append(own)
            nodes.append(child)
            left = waiting != child[which]
            waiting, parent = waiting[left], child[which][left]
        codes, nodes = np.concatenate([*codes, np.zeros(0, np.int64)]), np.concatenate([*nodes, np.zeros(0, np.int64)])
        order = np.argsort(codes)
        self.codes, self.nodes = codes[order], nodes[order]

    def near(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, point number) of all matches in the query's tree."""
        found, query, node = [], np.arange(len(queries)), roots
        while len(query):
            d = distances(queries[query], self.points[node])
            hit = d <= radius
            found.append((query[hit], node[hit]))
            edge = node * (self.bits + 1)
            first = np.searchsorted(self.codes, edge + np.maximum(d - radius, 0), "left")
            count = np.searchsorted(self.codes, edge + np.minimum(d + radius, self.bits), "right") - first
            query, d = np.repeat(query, count), np.repeat(first - (np.cumsum(count) - count), count)
            node = self.nodes[d + np.arange(len(d))]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; root[x] ends as the smallest member of x's set."""
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root[:] = root[root]


def linked_rows(group: np.ndarray, points: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int) -> np.ndarray:
    """For each row (sorted by group, tree rows first) a row it is linked to, itself if none."""
    root = np.arange(len(points))
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    first = np.repeat(starts, sizes)
    # A tree needs a root; groups of a single row have nothing to link.
    alive = in_tree[first] & (np.repeat(sizes, sizes) > 1)
    tree = np.flatnonzero(in_tree & alive)
    place = np.zeros(len(points), np.int64)
    place[tree] = np.arange(len(tree))
    forest = BkForest(points[tree], place[first[tree]])
    asking = np.flatnonzero(asks & alive)
    # Searches of at most FRONTIER pairs of words at a time, even if no edge is cut off.
    load = np.cumsum(np.repeat(np.add.reduceat(in_tree.astype(np.int64), starts), sizes)[asking]) if len(asking) else asking
    most = FRONTIER // points[:1].size if len(points) else FRONTIER
    for chunk in np.split(asking, np.searchsorted(load, np.arange(most, load[-1] if len(load) else 0, most))):
        if len(chunk):
            query, node = forest.near(points[chunk], place[first[chunk]], radius)
            _unite(root, chunk[query], tree[node])
    return root


def _shards(print_: Column) -> Column:
    """The shard keys of a fingerprint: pair of blocks and the two values, as one long."""
    def value(first: int, width: int) -> Column:
        return F.shiftrightunsigned(print_, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    return F.array(*[
        (F.shiftleft(value(*one), 13).bitwiseOR(value(*two)) + F.lit(n << 32).cast("long"))
        for n, (one, two) in enumerate(combinations(BLOCKS, 2))])


def near_links(prints: DataFrame, tree_points: int = TREE_POINTS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column print) whose components are those of all
    pairs at most RADIUS bits apart. prints must be a written table."""
    rows = prints.select("print", F.explode(_shards(F.col("print"))).alias("shard"))
    hot = (rows.groupBy("shard").count().where(F.col("count") > tree_points)
           .select("shard", F.ceil(F.col("count") / tree_points).cast("int").alias("trees")))
    own = F.pmod(F.xxhash64("print"), F.coalesce("trees", F.lit(1))).cast("int")
    dealt = (rows.join(hot, "shard", "left").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("trees", F.lit(1)) - 1)))
             .select("shard", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("asks"), "own", "print"))
    parts = parts_for(10 * prints.count(), SHARD_ROWS)

    def link(batches: Iterator[pa.RecordBatch]):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        shard, tree, asks, own, points = (table.column(i).to_numpy() for i in range(5))
        points = points.view(np.uint64)
        order = np.lexsort((points, own != tree, asks, tree, shard))
        shard, tree, asks, own, points = (x[order] for x in (shard, tree, asks, own, points))
        new = np.r_[True, (shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1]) | (asks[1:] != asks[:-1])]
        root = linked_rows(np.cumsum(new), points, own == tree, own == asks, RADIUS)
        linked = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(points[x].view(np.int64), pa.int64()) for x in (linked, root[linked])], ["a", "b"])

    return dealt.repartition(parts, "shard", "tree", "asks").mapInArrow(link, "a long, b long")


def linked_prints(prints: DataFrame) -> DataFrame:
    """(print, member): fingerprints in a component of several, with a common member."""
    return components(near_links(prints)).select(F.col("a").alias("print"), F.col("b").alias("member"))


def near_duplicate_groups(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, print, component_id) for every row."""
    rows = written(fingerprints(docs, words, seed), "prints")
    distinct = written(rows.groupBy("print").agg(F.min("doc_id").alias("low")), "distinct-prints")
    members = distinct.join(linked_prints(distinct), "print", "left").withColumn("member", F.coalesce("member", "print"))
    lowest = members.groupBy("member").agg(F.min("low").alias("component_id"))
    named = members.join(lowest, "member").select("print", "component_id")
    return rows.join(named, "print").select("doc_id", "print", "component_id")


def keep_one(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """docs with the row of the smallest doc_id of each component; all columns as they were."""
    rows = docs.select("text", F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"))
    rows = written(fingerprints(rows, words, seed, ["row", "place"]), "prints")
    distinct = written(rows.groupBy("print").agg(F.min(F.struct(F.col("row.doc_id").isNull(), "row.doc_id", "place")).alias("first")),
                       "distinct-prints")
    # Rows leave that are not the first of their fingerprint, or whose fingerprint's first is not its component's.
    members = distinct.join(linked_prints(distinct), "print", "left").withColumn("member", F.coalesce("member", "print"))
    stays = members.groupBy("member").agg(F.min("first").alias("first")).select(F.col("first.place").alias("place"))
    gone = rows.select("place").join(stays, "place", "left_anti")
    return rows.join(gone, "place", "left_anti").select("row.*")
