"""How many clusters, and how good are they: sweeps, silhouette and a two-dimensional view."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.functions.vectors import vector_digest
from ideamill.operators.clustering import block_pairs, with_points
from ideamill.operators.kmeans import SEED, fit_groups, labelled, prepared
from ideamill.operators.silhouettes import CHUNK_POINTS, silhouette_means, silhouette_points
from ideamill.settings import BLOCK_POINTS, FIT_POINTS
from ideamill.sources.tables import written

# Restarts and rounds of a sweep's fits.
SWEEP_RESTARTS, SWEEP_ROUNDS = 10, 300
# Up to so many clusters of all counts together, the silhouettes of a sweep share their distances.
SHARED_CLUSTERS = 256


def _features(df: DataFrame, vector: str) -> DataFrame:
    return df.where(F.col(vector).isNotNull()).withColumn(
        "features", array_to_vector(F.col(vector).cast("array<double>")))


def sweep_labels(df: DataFrame, group: str, vector: str, least: int, most: int, restarts: int = SWEEP_RESTARTS,
                 rounds: int = SWEEP_ROUNDS, seed: int = SEED, block_points: int = FIT_POINTS
                 ) -> tuple[DataFrame, DataFrame]:
    """K-means of every group for ``least`` to ``most`` clusters, all fits in one job.

    Gives the written points (group, point, vector, weight) and their labels (group, k, point, cluster,
    distance). A group has fits up to its number of distinct vectors; rows without group or vector are left out.
    """
    slice_points = min(block_points, BLOCK_POINTS)
    points, sizes, blocks = prepared(with_points(df, group, vector), group, vector, slice_points)
    counts = F.explode(F.sequence(F.lit(least).cast("long"), F.lit(most).cast("long")))
    fits = sizes.withColumn("clusters", counts).where("clusters <= n_points")
    centers = fit_groups(points, blocks, fits, group, restarts, rounds, seed, block_points)
    labels = labelled(blocks, centers, group, ["clusters"], slice_points)
    return points, written(labels.withColumnRenamed("clusters", "k"), "sweep")


def elbow_sweep(df: DataFrame, group: str, vector: str, most: int = 10, **options) -> DataFrame:
    """Within-cluster sum of squares of each group for 1 to ``most`` clusters: (group, k, wss)."""
    points, labels = sweep_labels(df, group, vector, 1, most, **options)
    weighted = labels.join(points.select(group, "point", "weight"), [group, "point"])
    return weighted.groupBy(group, "k").agg(
        F.sum(F.col("weight") * F.col("distance") * F.col("distance")).alias("wss"))


def silhouette_sweep(df: DataFrame, group: str, vector: str, most: int = 10, block_points: int = FIT_POINTS,
                     **options) -> DataFrame:
    """Mean Euclidean silhouette of each group for 2 to ``most`` clusters: (group, k, silhouette)."""
    points, labels = sweep_labels(df, group, vector, 2, most, block_points=block_points, **options)
    if most * (most + 1) // 2 <= SHARED_CLUSTERS:
        return silhouette_means(points, labels, group, min(block_points, CHUNK_POINTS))
    rows = labels.join(points, [group, "point"]).select(group, "k", "point", "cluster", "weight", "vector")
    found = silhouette_points(rows, [group, "k"], min(block_points, BLOCK_POINTS))
    weight = F.col("weight")
    return found.groupBy(group, "k").agg(
        (F.sum(F.col("silhouette") * weight) / F.sum(weight)).alias("silhouette"))


def within_sum_of_squares(df: DataFrame, groups: list[str], vector: str) -> DataFrame:
    """Sum of squared distances to the group mean, from sums alone: sum|x|^2 - |sum x|^2 / n."""
    value = array_to_vector(F.col(vector).cast("array<double>"))
    square = F.aggregate(F.col(vector).cast("array<double>"), F.lit(0.0),
                         lambda a, x: a + x * x)
    sums = df.groupBy(*groups).agg(
        F.count("*").alias("n"), F.sum(square).alias("_sq"),
        vector_to_array(Summarizer.sum(value)).alias("_sum"))
    return sums.select(*groups, "n", (
        F.col("_sq") - F.aggregate("_sum", F.lit(0.0), lambda a, x: a + x * x) / F.col("n")
    ).alias("wss"))


def silhouette(df: DataFrame, group: str, cluster: str, vector: str,
               block: int = BLOCK_POINTS) -> DataFrame:
    """Silhouette of every row inside its group, under a given labelling (squared Euclidean).

    The mean distance to a cluster follows from its size, its vector sum and its sum of squares,
    so no pair of rows is formed. Rows and cluster records meet in bounded blocks.
    """
    kind = df.schema[group].dataType.simpleString()
    label = df.schema[cluster].dataType.simpleString()
    rows = df.withColumn("_x", F.col(vector).cast("array<double>"))
    square = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v * v)
    records = rows.groupBy(group, cluster).agg(
        F.count("*").alias("n"), F.sum(square).alias("sq"),
        vector_to_array(Summarizer.sum(array_to_vector(F.col("_x")))).alias("total"))
    source = rows.withColumn("point", vector_digest(F.col("_x")))
    points = source.groupBy(group, "point", F.col(cluster).alias("own")).agg(
        F.first("_x").alias("x"))

    def gaps(points_pdf, records_pdf):
        import numpy as np
        import pandas as pd

        names = [group, "point", "own", "inside", "outside"]
        if points_pdf.empty or records_pdf.empty:
            return pd.DataFrame(columns=names)
        x = np.stack(points_pdf["x"].to_numpy()).astype(float)
        total = np.stack(records_pdf["total"].to_numpy()).astype(float)
        n = records_pdf["n"].to_numpy(dtype=float)
        sq = records_pdf["sq"].to_numpy(dtype=float)
        far = (x * x).sum(axis=1)[:, None] * n + sq - 2.0 * (x @ total.T)
        mine = points_pdf["own"].to_numpy()[:, None] == records_pdf[cluster].to_numpy()[None, :]
        inside = np.where(mine, far / np.maximum(n - 1, 1), np.nan)
        outside = np.where(mine, np.inf, far / n)
        return pd.DataFrame({
            group: points_pdf[group].to_numpy(),
            "point": points_pdf["point"].to_numpy(),
            "own": points_pdf["own"].to_numpy(),
            "inside": [None if np.isnan(r).all() else float(np.nanmax(r)) for r in inside],
            "outside": [None if np.isinf(v) else float(v) for v in outside.min(axis=1)],
        })[names]

    left, right = block_pairs(points, records, group, cluster, block)
    found = left.cogroup(right).applyInPandas(
        gaps, f"{group} {kind}, point string, own {label}, inside double, outside double",
    ).groupBy(group, "point", "own").agg(
        F.max("inside").alias("_in"), F.min("outside").alias("_out"))
    single = records.select(group, cluster, "n")
    score = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(
        (F.col("_out") - F.col("_in")) / F.greatest("_out", "_in"))
    return (
        source.join(found.withColumnRenamed("own", cluster), [group, "point", cluster])
        .join(single, [group, cluster])
        .select(*df.columns, score.alias("silhouette"))
    )


def euclidean_silhouette(df: DataFrame, group: str, cluster: str, vector: str,
                         block_points: int = BLOCK_POINTS) -> DataFrame:
    """Silhouette of every row inside its group, under a given labelling, by plain Euclidean distance.

    Rows without a group, a cluster or a vector have none. Copies count as rows: each is at distance zero
    from the others.
    """
    rows = df.withColumn("_x", F.col(vector).cast("array<double>")).withColumn("_point", vector_digest(F.col("_x")))
    points = rows.where(F.col(group).isNotNull() & F.col(cluster).isNotNull() & F.col("_x").isNotNull()).groupBy(
        group, F.col(cluster).alias("cluster"), F.col("_point").alias("point")).agg(
        F.first("_x").alias("vector"), F.count("*").alias("weight"))
    found = silhouette_points(written(points, "points"), [group], block_points).select(
        F.col(group).alias("_group"), F.col("cluster").alias("_cluster"), F.col("point").alias("_found"), "silhouette")
    same = (F.col(group) == F.col("_group")) & (F.col(cluster) == F.col("_cluster")) & (F.col("_point") == F.col("_found"))
    return rows.join(found, same, "left").select(*df.columns, "silhouette")


def project_2d(df: DataFrame, vector: str) -> DataFrame:
    """Add ``pc1`` and ``pc2``: the first two principal components."""
    data = _features(df, vector)
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(data)
    pc = vector_to_array("_pc")
    return model.transform(data).select(*df.columns, pc[0].alias("pc1"), pc[1].alias("pc2"))
