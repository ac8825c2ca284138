"""Queries on vectors, clustering and cluster quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ideamill.functions.vectors import (
    mean_of_valid, mean_vectors, text_to_vector, vector_sizes, vector_to_text,
)
from ideamill.operators.clustering import (
    assign_nearest, assignment_work, centroids, cluster_groups, distance_to_centroid,
)
from ideamill.operators.quality import (
    elbow_sweep, euclidean_silhouette, project_2d, silhouette, silhouette_sweep, sweep_labels,
    within_sum_of_squares,
)
from ideamill.sources.tables import written
from registry.base import new_registry
from registry.stand_ins import Tables

QUERIES, ORACLES, query = new_registry()

SIZE = 64  # length of the driver's vectors


def _points(t: Tables):
    """Embeddings as ideas of ten companies."""
    return t.embeddings.select(
        "vec_id", F.col("label").cast("long").alias("company_id"),
        F.col("embedding").cast("array<double>").alias("vector"))


def _total(vector):
    return F.aggregate(vector, F.lit(0.0), lambda a, x: a + x)


@query("""WITH parsed AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT vec_id, 64 AS n_parts, round(v[1], 6) AS first, round(list_sum(v), 4) AS total,
  label = 3 AS is_missing
FROM parsed JOIN embeddings USING (vec_id)""")
def vector_serialize(t: Tables):
    vector = F.when(F.col("company_id") == 3, F.array_repeat(F.lit(float("nan")), SIZE)).otherwise(
        F.col("vector"))
    rows = _points(t).select(
        "vec_id", vector_to_text(vector).alias("maybe"), vector_to_text(F.col("vector"))
        .alias("text"))
    parts = text_to_vector(F.col("text"))
    return rows.select(
        "vec_id", F.size(F.split("text", ",")).alias("n_parts"),
        F.round(F.get(parts, F.lit(0)), 6).alias("first"),
        F.round(_total(parts), 4).alias("total"), F.col("maybe").isNull().alias("is_missing"))


@query("""SELECT p_partkey, 3 AS n_parts, p_retailprice AS first, CAST(p_size AS DOUBLE) AS second,
  TRY_CAST(p_type AS DOUBLE) AS third FROM part""")
def vector_parse(t: Tables):
    text = F.concat_ws(",", F.col("p_retailprice").cast("string"),
                       F.col("p_size").cast("string"), "p_type")
    rows = t.part.select("p_partkey", text_to_vector(text).alias("v"))
    return rows.select(
        "p_partkey", F.size("v").alias("n_parts"), F.get("v", F.lit(0)).alias("first"),
        F.get("v", F.lit(1)).alias("second"), F.get("v", F.lit(2)).alias("third"))


@query("""WITH wide AS (SELECT vec_id, embedding::DOUBLE[] AS a,
  list_reverse(embedding::DOUBLE[]) AS b, label FROM embeddings),
means AS (SELECT vec_id, CASE WHEN label = 5 THEN NULL WHEN label = 3 THEN a ELSE
  list_transform(list_zip(a, b), lambda p: (p[1] + p[2]) / 2) END AS m FROM wide)
SELECT vec_id, round(m[1], 6) AS first, round(m[20], 6) AS inner_one, round(list_sum(m), 4) AS total
FROM means WHERE m IS NOT NULL""")
def mean_valid_vectors(t: Tables):
    """A vector, its reverse, one of wrong length and a missing one."""
    vector, label = F.col("vector"), F.col("company_id")
    mean = mean_of_valid([
        F.when(label != 5, vector), F.when(~label.isin(3, 5), F.reverse(vector)),
        F.slice(vector, 1, 10), F.lit(None).cast("array<double>")], SIZE)
    rows = _points(t).select("vec_id", mean.alias("m")).where("m IS NOT NULL")
    return rows.select(
        "vec_id", F.round(F.get("m", F.lit(0)), 6).alias("first"),
        F.round(F.get("m", F.lit(19)), 6).alias("inner_one"),
        F.round(_total(F.col("m")), 4).alias("total"))


@query("""SELECT label AS company_id, count(DISTINCT n) AS n_sizes, min(n) AS min_size,
  max(n) AS max_size, count(DISTINCT n) <= 1 AS is_consistent
FROM (SELECT CAST(label AS BIGINT) AS label, CASE WHEN label > 6 AND embedding[1] > 0 THEN 10
  ELSE CAST(len(embedding) AS BIGINT) END AS n FROM embeddings) GROUP BY label""")
def vector_dim_check(t: Tables):
    cut = F.when((F.col("company_id") > 6) & (F.get("vector", F.lit(0)) > 0),
                 F.slice("vector", 1, 10)).otherwise(F.col("vector"))
    return vector_sizes(_points(t).withColumn("vector", cut), ["company_id"], "vector")


SQL_CENTROIDS = """points AS (SELECT vec_id, CAST(label AS BIGINT) AS company_id,
  CASE WHEN embedding[1] > 0.05 THEN 2 WHEN embedding[1] > -0.05 THEN 1 ELSE 0 END AS cluster,
  embedding::DOUBLE[] AS v FROM embeddings),
long AS (SELECT vec_id, company_id, cluster, unnest(v) AS x, unnest(range(64)) AS d FROM points),
centroid AS (SELECT company_id, cluster, d, avg(x) AS c FROM long GROUP BY ALL)"""


def _labelled(t: Tables):
    first = F.get("vector", F.lit(0))
    return _points(t).withColumn("cluster", F.when(first > 0.05, 2).when(first > -0.05, 1)
                                 .otherwise(0))


@query(f"""WITH {SQL_CENTROIDS} SELECT company_id, cluster, round(sum(c), 4) AS total,
  round(max(c), 6) AS highest FROM centroid GROUP BY ALL""")
def mean_vector_per_cluster(t: Tables):
    centers = mean_vectors(_labelled(t), ["company_id", "cluster"], "vector")
    return centers.select("company_id", "cluster", F.round(_total(F.col("centroid")), 4)
                          .alias("total"), F.round(F.array_max("centroid"), 6).alias("highest"))


@query(f"""WITH {SQL_CENTROIDS} SELECT vec_id, company_id, cluster,
  round(sqrt(sum((x - c) * (x - c))), 6) AS distance_centroid
FROM long JOIN centroid USING (company_id, cluster, d) GROUP BY ALL""")
def distance_to_own_centroid(t: Tables):
    rows = _labelled(t)
    centers = centroids(rows, "company_id", "cluster", "vector")
    found = distance_to_centroid(rows, centers, "company_id", "cluster", "vector")
    return found.select("vec_id", "company_id", "cluster",
                        F.round("distance_centroid", 6).alias("distance_centroid"))


@query(f"""WITH {SQL_CENTROIDS}, gaps AS (SELECT l.vec_id, l.company_id, centroid.cluster,
  sqrt(sum((x - c) * (x - c))) AS gap
FROM long l JOIN centroid ON centroid.company_id = l.company_id AND centroid.d = l.d GROUP BY ALL)
SELECT vec_id, company_id, arg_min(cluster, gap) AS cluster, round(min(gap), 6)
  AS distance_centroid FROM gaps GROUP BY ALL""")
def assign_nearest_centroid(t: Tables):
    """Centroids are saved as a table, read again, and every vector gets the nearest one."""
    rows = _labelled(t)
    saved = written(centroids(rows, "company_id", "cluster", "vector"), "centroids")
    found = assign_nearest(rows.drop("cluster"), saved, "company_id", "cluster", "vector")
    return found.select("vec_id", "company_id", "cluster",
                        F.round("distance_centroid", 6).alias("distance_centroid"))


SQL_ONE_EACH = """seeds AS (SELECT vec_id AS cluster, CAST(label AS BIGINT) AS company_id, embedding::DOUBLE[] AS c
  FROM embeddings WHERE vec_id % 5 = 0),
gaps AS (SELECT e.vec_id, company_id, cluster, list_sum(list_transform(list_zip(embedding::DOUBLE[], c),
  lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS gap FROM embeddings e JOIN seeds ON e.label = company_id)"""


def _many_centroids(t: Tables):
    """A fifth of the vectors saved as centroids."""
    rows = _points(t)
    return rows, rows.where("vec_id % 5 = 0").select(
        F.col("vec_id").alias("cluster"), "company_id", F.col("vector").alias("centroid"))


@query(f"""WITH {SQL_ONE_EACH} SELECT vec_id, company_id, arg_min(cluster, gap) AS cluster,
  round(sqrt(min(gap)), 6) AS distance_centroid FROM gaps GROUP BY ALL""")
def assign_nearest_pruned(t: Tables):
    """As many centroids as a tenth or more of the rows: the triangle inequality rules most out or none."""
    rows, saved = _many_centroids(t)
    found = assign_nearest(rows, saved, "company_id", "cluster", "vector", prune_above=0)
    return found.select("vec_id", "company_id", "cluster", F.round("distance_centroid", 6).alias("distance_centroid"))


@query(f"""WITH {SQL_ONE_EACH} SELECT company_id, count(*) AS pairs, true AS within FROM gaps GROUP BY company_id""")
def assignment_visits(t: Tables):
    """Points times centroids of a whole comparison; the pruned one never does more."""
    rows, saved = _many_centroids(t)
    work = assignment_work(rows, saved, "company_id", "cluster", "vector")
    return work.select("company_id", "pairs", (F.col("visits") <= F.col("pairs")).alias("within"))


@query()
def grouped_kmeans(t: Tables):
    """Clusters per company; k-means labels are not comparable, so tests check invariants."""
    return cluster_groups(_points(t), "company_id", "vector").drop("vector")


@query("""SELECT CAST(label AS BIGINT) AS company_id, count(*) AS n_ideas,
  greatest(1, CAST(round_even(count(*) / 10, 0) AS BIGINT)) AS n_clusters,
  CAST(0 AS DOUBLE) AS distance_error, CAST(0 AS BIGINT) AS not_nearest
FROM embeddings GROUP BY label""")
def grouped_kmeans_invariants(t: Tables):
    """Whatever the labels: every idea is in the cluster of its nearest centroid, centroids are
    the means of their clusters, and the number of clusters follows the rule."""
    return _invariants(_points(t))


def _invariants(rows):
    found = written(cluster_groups(rows, "company_id", "vector"), "clusters")
    saved = written(centroids(found, "company_id", "cluster_number", "vector"), "centroids")
    again = distance_to_centroid(
        found, saved, "company_id", "cluster_number", "vector", "to_mean")
    nearest = assign_nearest(
        again.withColumnRenamed("cluster_number", "fitted")
        .withColumnRenamed("distance_centroid", "distance_fitted"),
        saved, "company_id", "cluster_number", "vector")
    gap = F.abs(F.col("distance_fitted") - F.col("to_mean"))
    return nearest.groupBy("company_id").agg(
        F.count("*").alias("n_ideas"), F.count_distinct("fitted").alias("n_clusters"),
        F.round(F.max(gap), 6).alias("distance_error"),
        F.sum((F.col("fitted") != F.col("cluster_number")).cast("long")).alias("not_nearest"))


@query("""SELECT CAST(1 AS BIGINT) AS company_id, count(*) AS n_ideas,
  greatest(1, CAST(round_even(count(*) / 10, 0) AS BIGINT)) AS n_clusters,
  CAST(0 AS DOUBLE) AS distance_error, CAST(0 AS BIGINT) AS not_nearest FROM embeddings""")
def one_company_kmeans_invariants(t: Tables):
    """All rows as one company."""
    return _invariants(_points(t).withColumn("company_id", F.lit(1).cast("long")))


@query("""WITH long AS (SELECT label, vec_id, unnest(embedding::DOUBLE[]) AS x,
  unnest(range(64)) AS d FROM embeddings),
mean AS (SELECT label, d, avg(x) AS c FROM long GROUP BY ALL)
SELECT CAST(label AS BIGINT) AS company_id, count(DISTINCT vec_id) AS n,
  round(sum((x - c) * (x - c)), 5) AS wss FROM long JOIN mean USING (label, d) GROUP BY label""")
def elbow_one_cluster(t: Tables):
    return within_sum_of_squares(_points(t), ["company_id"], "vector").withColumn(
        "wss", F.round("wss", 5))


@query()
def elbow_by_count(t: Tables):
    """Sum of squares of every company for 1 to 10 clusters."""
    return elbow_sweep(_points(t), "company_id", "vector")


@query("""SELECT CAST(label AS BIGINT) AS company_id, k, k AS n_clusters, count(*) AS n_ideas,
  CAST(0 AS DOUBLE) AS identity_error FROM embeddings, (SELECT unnest(range(1, 11)) AS k)
GROUP BY label, k HAVING k <= count(DISTINCT embedding)""")
def elbow_identity(t: Tables):
    """The sweep's sums of squared distances against sum|x|^2 - |sum x|^2 / n of its own clusters."""
    points, labels = sweep_labels(_points(t), "company_id", "vector", 1, 10)
    rows = labels.join(points, ["company_id", "point"])
    inside = within_sum_of_squares(
        rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("weight").cast("int")))),
        ["company_id", "k", "cluster"], "vector")
    by_cluster = rows.groupBy("company_id", "k", "cluster").agg(
        F.sum("weight").alias("rows"), F.sum(F.col("weight") * F.col("distance") ** 2).alias("measured"))
    return by_cluster.join(inside, ["company_id", "k", "cluster"]).groupBy("company_id", "k").agg(
        F.count("*").alias("n_clusters"), F.sum("rows").alias("n_ideas"),
        F.round(F.abs(F.sum("measured") - F.sum("wss")), 6).alias("identity_error"))


SQL_SILHOUETTE = """points AS (SELECT vec_id, CAST(label AS BIGINT) AS company_id,
  CASE WHEN embedding[1] > 0.05 THEN 2 WHEN embedding[1] > -0.05 THEN 1 ELSE 0 END AS cluster,
  embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (SELECT a.vec_id, a.company_id, a.cluster AS own, b.cluster AS other,
  list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS gap
  FROM points a JOIN points b ON a.company_id = b.company_id AND a.vec_id <> b.vec_id),
means AS (SELECT vec_id, company_id, own, other, avg(gap) AS g FROM pairs GROUP BY ALL),
sides AS (SELECT vec_id, company_id, own, min(g) FILTER (own = other) AS inside,
  min(g) FILTER (own <> other) AS outside FROM means GROUP BY ALL)"""


@query(f"""WITH {SQL_SILHOUETTE} SELECT vec_id, company_id, own AS cluster, CASE WHEN inside IS NULL
  THEN 0.0 ELSE round((outside - inside) / greatest(outside, inside), 5) END AS silhouette
FROM sides""")
def silhouette_fixed_labels(t: Tables):
    return silhouette(_labelled(t), "company_id", "cluster", "vector", block=20).select(
        "vec_id", "company_id", "cluster", F.round("silhouette", 5).alias("silhouette"))


@query(f"""WITH {SQL_SILHOUETTE.replace("list_sum(", "sqrt(list_sum(").replace(" AS gap", ") AS gap")}
SELECT vec_id, company_id, own AS cluster, CASE WHEN inside IS NULL
  THEN 0.0 ELSE round((outside - inside) / greatest(outside, inside), 5) END AS silhouette
FROM sides""")
def euclidean_silhouette_fixed_labels(t: Tables):
    return euclidean_silhouette(_labelled(t), "company_id", "cluster", "vector").select(
        "vec_id", "company_id", "cluster", F.round("silhouette", 5).alias("silhouette"))


@query()
def silhouette_by_count(t: Tables):
    """Mean Euclidean silhouette of every company for 2 to 10 clusters."""
    return silhouette_sweep(_points(t), "company_id", "vector")


@query()
def pca_2d(t: Tables):
    return project_2d(_points(t), "vector").drop("vector")
