"""Silhouette by plain Euclidean distance, as matrix products of bounded blocks.

Points of a group lie in bins of about a block each, sorted by cluster. A cluster of up to a block lies in
one bin whole, so the mean distance to it is known within one task; a larger one has bins of its own, which
a task reads one after the other. A task holds one bin of points and one bin of others; what leaves it is
two numbers a point, never a pair of rows.

Many labellings of the same points (``silhouette_means``) share the distances: points lie in chunks, a task
holds two of them and measures each pair once, and a product with the marks of all clusters of all labellings
gives the sums of both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ideamill.settings import BLOCK_BYTES, BLOCK_POINTS, task_count
from ideamill.sources.tables import written

STEP_VALUES = 1 << 20
# Points of a chunk, points of a side of the distances held at once, and most tasks of the pairs of chunks.
CHUNK_POINTS, TILE, PAIR_TASKS = 16_384, 256, 512
# Closer pairs, as a share of squared lengths, are measured from differences.
CLOSE = 1e-9


def binned(points: DataFrame, keys: list[str], block_points: int = BLOCK_POINTS) -> DataFrame:
    """Points (keys, point, cluster, weight, vector) packed into bins: bin is where, piece which part of it."""
    clusters = points.groupBy(*keys, "cluster").agg(F.count("*").alias("in_cluster"))
    groups = clusters.groupBy(*keys).agg(F.ceil(F.sum("in_cluster") / block_points).alias("bins"))
    large = F.col("in_cluster") > block_points
    pieces = F.ceil(F.col("in_cluster") / block_points)
    place = (
        points.join(clusters, [*keys, "cluster"]).join(groups, keys)
        .withColumn("bin", F.when(large, F.concat(F.lit("c"), F.col("cluster").cast("string")))
                    .otherwise(F.pmod(F.xxhash64("cluster"), "bins").cast("string")))
        .withColumn("piece", F.when(large, F.pmod(F.xxhash64("point"), pieces)).otherwise(F.lit(0).cast("long")))
    )
    return place.groupBy(*keys, "bin", "piece").agg(
        F.sort_array(F.collect_list(F.struct("cluster", "point", "weight", "vector"))).alias("p")
    ).select(*keys, "bin", "piece", F.col("p.cluster").alias("clusters"), F.col("p.point").alias("points"),
             F.col("p.weight").cast("array<double>").alias("weights"), F.flatten("p.vector").alias("x"))


def distance_sums(x, others, weights, starts):
    """Weighted sums of Euclidean distances of each point to the runs of others that begin at starts."""
    import numpy as np

    found = np.empty((len(x), len(starts)))
    size, step = (others * others).sum(axis=1), max(1, STEP_VALUES // len(others))
    for first in range(0, len(x), step):
        part = x[first:first + step]
        own = (part * part).sum(axis=1)[:, None]
        gap = own + size - 2.0 * (part @ others.T)
        # A difference of large numbers says nothing about near points: measure those again.
        i, j = np.nonzero(gap < 1e-9 * (own + size))
        gap[i, j] = ((part[i] - others[j]) ** 2).sum(axis=1)
        found[first:first + step] = np.add.reduceat(np.sqrt(np.maximum(gap, 0.0)) * weights, starts, axis=1)
    return found


def silhouette_points(points: DataFrame, keys: list[str], block_points: int = BLOCK_POINTS) -> DataFrame:
    """Silhouette of each distinct point: (keys, point, cluster, weight, silhouette).

    points: (keys, point, cluster, weight, vector), one row per distinct point and cluster of a group. A point
    alone in its cluster has 0; where a group has one cluster only there is none.
    """

    bins = written(binned(points, keys, block_points), "bins")
    own = bins.select(*keys, F.col("bin").alias("own_bin"), F.col("piece").alias("own_piece"))
    where = [*keys, "own_bin", "own_piece"]
    tasks = task_count(points.sparkSession)
    met = (
        own.join(bins.select(*keys, F.col("bin").alias("other"), F.col("clusters").alias("other_clusters"),
                             F.col("weights").alias("other_weights"), F.col("x").alias("other_x")), keys)
        .join(bins.select(*keys, F.col("bin").alias("own_bin"), F.col("piece").alias("own_piece"), "clusters", "x"), where)
        .repartition(tasks, *where, "other")
    )
    kept = StructType([points.schema[k] for k in keys])
    schema = StructType([*kept, *StructType.fromDDL(
        "own_bin string, own_piece long, inside array<double>, outside array<double>")])

    def values(batch, name, row):
        return batch[name][row].values.to_numpy(zero_copy_only=False)

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All pieces of one other bin: its clusters are whole after the last one."""
        import numpy as np

        total = None
        for b in batches:
            for row in range(b.num_rows):
                mine, theirs = values(b, "clusters", row), values(b, "other_clusters", row)
                x = values(b, "x", row).reshape(len(mine), -1)
                weights = values(b, "other_weights", row)
                names, starts = np.unique(theirs, return_index=True)
                sums = distance_sums(x, values(b, "other_x", row).reshape(len(theirs), -1), weights, starts)
                mass = np.add.reduceat(weights, starts)
                if total is None:
                    total, held, first = sums, mass, b.slice(row, 1)
                    same = mine[:, None] == names
                else:  # Further pieces of one large cluster.
                    total, held = total + sums, held + mass
        with np.errstate(invalid="ignore", divide="ignore"):
            inside = np.where(same, np.where(held > 1, total / (held - 1), np.nan), -np.inf).max(axis=1)
            outside = np.where(same, np.inf, total / held).min(axis=1)
        yield pa.RecordBatch.from_arrays(
            [*[first[c] for c in where], pa.array([inside], pa.list_(pa.float64())),
             pa.array([outside], pa.list_(pa.float64()))], schema.names)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        inside = None
        for b in batches:
            for row in range(b.num_rows):
                near, far = values(b, "inside", row), values(b, "outside", row)
                if inside is None:
                    inside, outside, first = near, far, b.slice(row, 1)
                # maximum keeps NaN: a point alone in its cluster.
                inside, outside = np.maximum(inside, near), np.minimum(outside, far)
        yield pa.RecordBatch.from_arrays(
            [*[first[c] for c in where], pa.array([inside], pa.list_(pa.float64())),
             pa.array([outside], pa.list_(pa.float64()))], schema.names)

    found = met.groupBy(*where, "other").applyInArrow(gaps, schema).groupBy(*where).applyInArrow(least, schema)
    each = F.inline(F.arrays_zip("points", "clusters", "weights", "inside", "outside"))
    bins = bins.withColumnsRenamed({"bin": "own_bin", "piece": "own_piece"}).drop("x")
    score = F.when(F.isnan("inside"), 0.0).when(F.col("outside") < float("inf"),
                                                (F.col("outside") - F.col("inside")) / F.greatest("outside", "inside"))
    return bins.join(found, where).select(*keys, each).select(
        *keys, F.col("points").alias("point"), F.col("clusters").alias("cluster"),
        F.col("weights").cast("long").alias("weight"), score.alias("silhouette"))


# Many labellings ------------------------------------------------------------

def pair_sums(x, y, marks, others, same: bool = False):
    """Sums of distances of the points x to those marked in others, and of the points y to those marked in marks.

    marks has a row a point of x and a column a cluster, with weights; others those of y. same: y is x.
    """
    import numpy as np

    mine, theirs = np.zeros(marks.shape), np.zeros(others.shape)
    left, right = (x * x).sum(axis=1), (y * y).sum(axis=1)
    # The product gives |x|^2 - 2 xy + |y|^2.
    a = np.column_stack([x, left, np.ones(len(x))])
    b = np.column_stack([-2.0 * y, np.ones(len(y)), right])
    for i in range(0, len(x), TILE):
        at = slice(i, i + TILE)
        for j in range(i if same else 0, len(y), TILE):
            to = slice(j, j + TILE)
            gap = a[at] @ b[to].T
            least = CLOSE * (left[at].max() + right[to].max())
            if gap.min() < least:
                # A difference of large numbers says nothing about near points: measure those again.
                p, q = np.nonzero(gap < least)
                for part in range(0, len(p), TILE):
                    r, c = p[part:part + TILE], q[part:part + TILE]
                    gap[r, c] = ((x[i + r] - y[j + c]) ** 2).sum(axis=1)
            np.sqrt(gap, out=gap)
            mine[at] += gap @ others[to]
            if not same or j > i:
                theirs[to] += gap.T @ marks[at]
    return (mine + theirs, None) if same else (mine, theirs)


def mean_parts(sums, mass, labels, weights, counts):
    """Weighted sum of the silhouettes of points under each labelling; none where a labelling has one cluster only.

    sums and mass have a column a cluster, the labellings of counts clusters side by side; labels has one a point and labelling.
    """
    import numpy as np

    found, first, rows = [], 0, np.arange(len(sums))
    for n, count in enumerate(counts):
        far, held, own = sums[:, first:first + count], mass[first:first + count], labels[:, n]
        first += count
        if (held > 0).sum() < 2:
            found.append(None)
            continue
        with np.errstate(invalid="ignore", divide="ignore"):
            inside = far[rows, own] / (held[own] - 1)
            means = np.where(held > 0, far / held, np.inf)
            means[rows, own] = np.inf
            outside = means.min(axis=1)
            score = (outside - inside) / np.maximum(outside, inside)
        # A point alone in its cluster has 0.
        found.append(float(weights @ np.where((held[own] > 1) & (np.maximum(outside, inside) > 0), score, 0.0)))
    return found


def silhouette_means(points: DataFrame, labels: DataFrame, group: str, chunk_points: int = CHUNK_POINTS) -> DataFrame:
    """Mean silhouette of each labelling of a group's points: (group, k, silhouette).

    points: (group, point, vector, weight), one row per distinct point; labels: (group, k, point, cluster) with clusters
    from 0 to k - 1, for the same k at all points of a group. A point alone in its cluster has 0; where a group has
    one cluster only there is none. Both are written tables.
    """
    length = F.max(F.size("vector"))
    most = F.greatest(F.lit(1), F.least(F.lit(chunk_points), F.floor(F.lit(BLOCK_BYTES) / 8 / length)))
    sizes = points.groupBy(group).agg(length.cast("long").alias("length"), F.ceil(F.count("*") / most).alias("n_chunks"))
    sizes = written(sizes, "sizes")
    n, tasks = F.col("n_chunks"), task_count(points.sparkSession)
    pairs = int(sizes.agg(F.sum(n * (n + 1) / 2)).first()[0] or 0)
    pair_tasks = max(tasks, min(PAIR_TASKS, pairs))
    lists = labels.groupBy(group, "point").agg(F.sort_array(F.collect_list(F.struct("k", "cluster"))).alias("l"))
    chunks = (
        points.join(lists, [group, "point"]).join(sizes, group)
        .groupBy(group, F.pmod(F.xxhash64("point"), "n_chunks").alias("chunk"), "n_chunks", "length")
        .agg(F.sort_array(F.collect_list(F.struct("point", "weight", "vector", "l"))).alias("p"))
        .select(group, "chunk", "n_chunks", "length", F.get("p", F.lit(0))["l"]["k"].alias("counts"),
                F.flatten("p.l")["cluster"].alias("labels"), F.col("p.weight").cast("array<double>").alias("weights"),
                F.flatten("p.vector").alias("x"))
    )
    # A chunk goes to each pair that it is part of: the pairs a <= b of a group follow each other.
    other = F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    a, b = F.least("chunk", "other"), F.greatest("chunk", "other")
    dealt = (
        written(chunks, "chunks").repartition(tasks, group, "chunk").withColumn("other", other)
        .withColumns({"a": a, "b": b})
        .withColumn("place", F.col("a") * n + F.col("b") - F.expr("a * (a + 1) div 2"))
        .repartitionById(pair_tasks, F.pmod(F.xxhash64(group) % pair_tasks + F.col("place"), F.lit(pair_tasks)).cast("int"))
        .sortWithinPartitions(group, "a", "b", "chunk")
    )
    kind = StructType([points.schema[group]])
    partly = StructType([*kind, *StructType.fromDDL(
        "chunk long, counts array<long>, sums array<double>, mass array<double>, labels array<long>, weights array<double>")])
    ended = StructType([*kind, *StructType.fromDDL("k long, total double, weight double")])

    def values(batch, name, row):
        return batch[name][row].values.to_numpy(zero_copy_only=False)

    def read(batch, row):
        """Vectors, marks of all clusters and weights of a chunk."""
        import numpy as np

        counts, weights = values(batch, "counts", row).astype(np.int64), values(batch, "weights", row)
        own = values(batch, "labels", row).reshape(len(weights), -1)
        marks, starts = np.zeros((len(weights), int(counts.sum()))), np.cumsum(counts) - counts
        marks[np.arange(len(weights))[:, None], own + starts] = weights[:, None]
        return values(batch, "x", row).reshape(len(weights), -1), marks, weights

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(batch, row, found, mass, whole):
            # The labels of a chunk come with its own pair.
            shown = [batch[c].slice(row, 1) if whole else pa.nulls(1, batch[c].type) for c in ("labels", "weights")]
            return pa.RecordBatch.from_arrays(
                [batch[group].slice(row, 1), batch["chunk"].slice(row, 1), batch["counts"].slice(row, 1),
                 *[pa.array([v], pa.list_(pa.float64())) for v in (found.ravel(), mass)], *shown], partly.names)

        held = None
        for batch in batches:
            for row in range(batch.num_rows):
                first, second = batch["a"][row].as_py(), batch["b"][row].as_py()
                x, marks, weights = read(batch, row)
                if first == second:
                    yield result(batch, row, pair_sums(x, x, marks, marks, True)[0], marks.sum(axis=0), True)
                elif held is None:
                    held = batch.slice(row, 1), x, marks
                else:  # The second chunk of a pair comes after the first.
                    before, y, others = held
                    held = None
                    mine, theirs = pair_sums(x, y, marks, others)
                    yield result(batch, row, mine, others.sum(axis=0), False)
                    yield result(before, 0, theirs, marks.sum(axis=0), False)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = mass = whole = None
        for batch in batches:
            for row in range(batch.num_rows):
                some, held = values(batch, "sums", row), values(batch, "mass", row)
                total, mass = (some.copy(), held.copy()) if total is None else (total + some, mass + held)
                if batch["labels"][row].is_valid:
                    whole = batch.slice(row, 1)
        counts, weights = values(whole, "counts", 0), values(whole, "weights", 0)
        found = mean_parts(total.reshape(len(weights), -1), mass, values(whole, "labels", 0).reshape(len(weights), -1),
                           weights, counts)
        yield pa.RecordBatch.from_arrays(
            [whole[group].take(pa.array([0] * len(counts), pa.int64())), pa.array(counts), pa.array(found, pa.float64()),
             pa.array([weights.sum()] * len(counts))], ended.names)

    parts = dealt.mapInArrow(sums, partly).groupBy(group, "chunk").applyInArrow(means, ended)
    return parts.groupBy(group, "k").agg((F.sum("total") / F.sum("weight")).alias("silhouette"))
