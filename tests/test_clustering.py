import numpy as np
import pytest
from pyspark.sql import functions as F

from ideamill.operators import kmeans
from ideamill.operators.clustering import (
    assign_nearest, assignment_work, centroids, cluster_groups, distance_to_centroid,
)
from ideamill.operators.quality import (
    elbow_sweep, euclidean_silhouette, project_2d, silhouette, silhouette_sweep, sweep_labels,
    within_sum_of_squares,
)
from ideamill.operators import quality, silhouettes
from ideamill.settings import BLOCK_BYTES

SCHEMA = "id long, company_id long, vector array<double>"


def points(spark, sizes, dims=4, seed=0):
    rng = np.random.default_rng(seed)
    data, number = [], 0
    for company, size in sizes.items():
        for _ in range(size):
            data.append((number, company, rng.normal(size=dims).tolist()))
            number += 1
    return spark.createDataFrame(data, SCHEMA)


def by_company(clustered):
    groups = {}
    for r in clustered.collect():
        groups.setdefault(r["company_id"], []).append(r)
    return groups


def centers_of(rows):
    return {c: np.mean([r["vector"] for r in rows if r["cluster_number"] == c], axis=0)
            for c in {r["cluster_number"] for r in rows}}


def test_counts_centroids_and_distances(spark):
    sizes = {1: 1, 2: 5, 3: 14, 4: 15, 5: 16, 6: 25, 7: 35}
    groups = by_company(cluster_groups(points(spark, sizes), "company_id", "vector"))
    expected = {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2, 7: 4}
    for company, rows in groups.items():
        assert len(rows) == sizes[company]
        centers = centers_of(rows)
        assert sorted(centers) == list(range(expected[company]))
        for r in rows:
            gaps = {c: np.linalg.norm(np.array(r["vector"]) - m) for c, m in centers.items()}
            assert r["distance_centroid"] == pytest.approx(gaps[r["cluster_number"]], abs=1e-9)
            assert gaps[r["cluster_number"]] <= min(gaps.values()) + 1e-9


def test_rows_without_company_or_vector_are_left_out(spark):
    df = spark.createDataFrame(
        [(1, None, [1.0]), (2, 1, None), (3, 1, [2.0])], SCHEMA)
    found = cluster_groups(df, "company_id", "vector").collect()
    assert [(r["id"], r["cluster_number"], r["distance_centroid"]) for r in found] == [
        (3, 0, 0.0)]


def test_same_seed_same_result(spark):
    df = points(spark, {1: 40, 2: 30})
    runs = [sorted(tuple(r) for r in cluster_groups(
        df, "company_id", "vector", seed=7).select("id", "cluster_number").collect())
        for _ in range(2)]
    assert runs[0] == runs[1]


def test_close_to_the_best_of_many_random_starts(spark):
    df = points(spark, {1: 60}, seed=3)
    found = cluster_groups(df, "company_id", "vector")
    inertia = found.agg(F.sum(F.col("distance_centroid") ** 2)).first()[0]
    x = np.array([r["vector"] for r in df.collect()])
    random_starts = []
    for trial in range(20):
        rng = np.random.default_rng(trial)
        c = x[rng.choice(len(x), 6, replace=False)]
        for _ in range(100):
            labels = ((x[:, None] - c) ** 2).sum(-1).argmin(1)
            c = np.array([x[labels == k].mean(0) if (labels == k).any() else c[k]
                          for k in range(6)])
        random_starts.append(((x - c[labels]) ** 2).sum())
    assert inertia <= 1.02 * min(random_starts) and inertia < np.mean(random_starts)


def test_a_third_of_all_rows_are_copies(spark):
    df = points(spark, {1: 40}).unionByName(spark.range(100, 120).select(
        "id", F.lit(1).cast("long").alias("company_id"),
        F.array_repeat(F.lit(9.0), 4).alias("vector")))
    rows = cluster_groups(df, "company_id", "vector").collect()
    assert len(rows) == 60 and len({r["cluster_number"] for r in rows}) == 6
    assert len({r["cluster_number"] for r in rows if r["id"] >= 100}) == 1


def test_fewer_points_than_clusters(spark):
    df = spark.range(40).select("id", F.lit(1).cast("long").alias("company_id"),
                                F.array((F.col("id") % 2).cast("double")).alias("vector"))
    rows = cluster_groups(df, "company_id", "vector").collect()
    assert len(rows) == 40 and {r["distance_centroid"] for r in rows} == {0.0}


@pytest.mark.parametrize("block_points", [25, 5])
def test_blocks_do_not_change_the_clusters(spark, block_points):
    """One block and several, with centres in one slice (25) or two (5), give the same fit of each company."""
    df = points(spark, {1: 80, 2: 20, 3: 40}, seed=5)
    def fit(n):
        rows = cluster_groups(df, "company_id", "vector", restarts=3, block_points=n).collect()
        return {r["id"]: (r["cluster_number"], pytest.approx(r["distance_centroid"], abs=1e-9)) for r in rows}
    found = fit(block_points)
    assert len(found) == 140 and found == fit(4_096)


def test_a_company_of_many_blocks_keeps_the_rule(spark):
    df = points(spark, {1: 300, 2: 20})
    rows = cluster_groups(df, "company_id", "vector", restarts=2, block_points=64).collect()
    groups = {c: [r for r in rows if r["company_id"] == c] for c in (1, 2)}
    assert [len(groups[c]) for c in (1, 2)] == [300, 20] and len({r["id"] for r in rows}) == 320
    centers = centers_of(groups[1])
    assert sorted(centers) == list(range(30)) and {r["cluster_number"] for r in groups[2]} == {0, 1}
    for r in groups[1]:
        gaps = {c: np.linalg.norm(np.array(r["vector"]) - m) for c, m in centers.items()}
        assert r["distance_centroid"] == pytest.approx(gaps[r["cluster_number"]], abs=1e-9)
        assert gaps[r["cluster_number"]] <= min(gaps.values()) + 1e-9


def test_blocks_are_bounded_by_points_and_bytes(spark):
    df = points(spark, {1: 500, 2: 3}).withColumn("point", F.col("id").cast("string"))
    made = kmeans.weighted_points(df, "company_id", "vector")
    sizes = kmeans.group_sizes(made, "company_id", 100)
    assert {r["company_id"]: (r["n_rows"], r["n_points"], r["length"], r["n_blocks"]) for r in sizes.collect()} == {
        1: (500, 500, 4, 5), 2: (3, 3, 4, 1)}
    blocks = kmeans.point_blocks(made, sizes, "company_id").collect()
    assert len(blocks) == 6 and max(len(b["points"]) for b in blocks) < 200
    assert sum(len(b["points"]) for b in blocks) == 503 and all(len(b["x"]) == 4 * len(b["points"]) for b in blocks)
    long = df.where("company_id = 2").withColumn("vector", F.array_repeat(F.lit(1.0), BLOCK_BYTES // 16))
    assert kmeans.group_sizes(kmeans.weighted_points(long, "company_id", "vector"), "company_id").first()["n_blocks"] == 2


def test_draws_follow_weight_times_distance():
    marks = np.random.default_rng(0).integers(-2**62, 2**62, 5)
    weights, near = np.array([1.0, 2.0, 3.0, 4.0, 5.0]), np.array([5.0, 4.0, 0.0, 1.0, 1.0])
    first = np.zeros(5)
    for restart in range(20_000):
        first[kmeans.priorities(marks, weights, near, 42, restart, 1).argmin()] += 1
    assert first / 20_000 == pytest.approx(weights * near / (weights * near).sum(), abs=0.015)
    assert np.isinf(kmeans.priorities(marks, weights, near, 42, 0, 1)[2])


def test_empty_table_has_no_clusters(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cluster_groups(none, "company_id", "vector").isEmpty()
    assert elbow_sweep(none, "company_id", "vector").isEmpty()
    assert silhouette_sweep(none, "company_id", "vector").isEmpty()


def test_assignment_equals_brute_force(spark):
    df = points(spark, {1: 90, 2: 30})
    found = cluster_groups(df, "company_id", "vector")
    saved = centroids(found, "company_id", "cluster_number", "vector")
    new = points(spark, {1: 80, 2: 10}, seed=9)
    for block, prune_above in ((7, 4096), (4096, 4096), (7, 0), (4096, 0), (2, 1)):
        rows = assign_nearest(new, saved, "company_id", "cluster_number", "vector", block, prune_above)
        table = {}
        for r in saved.collect():
            table.setdefault(r["company_id"], {})[r["cluster_number"]] = np.array(r["centroid"])
        got = rows.collect()
        assert len(got) == 90
        for r in got:
            gaps = {c: np.linalg.norm(np.array(r["vector"]) - m)
                    for c, m in table[r["company_id"]].items()}
            assert r["cluster_number"] == min(gaps, key=gaps.get)
            assert r["distance_centroid"] == pytest.approx(min(gaps.values()))
    own = distance_to_centroid(found, saved, "company_id", "cluster_number", "vector", "again")
    assert own.where(F.abs(F.col("again") - F.col("distance_centroid")) > 1e-9).isEmpty()


def test_silhouette_equals_brute_force(spark):
    df = points(spark, {1: 40}).withColumn("cluster", (F.col("id") % 3).cast("int"))
    alone = df.withColumn("cluster", F.when(F.col("id") == 0, 9).otherwise(F.col("cluster")))
    data = alone.collect()
    x = np.array([r["vector"] for r in data])
    labels = np.array([r["cluster"] for r in data])
    far = ((x[:, None] - x) ** 2).sum(-1)
    expected = {}
    for i, r in enumerate(data):
        own = (labels == labels[i]) & (np.arange(len(x)) != i)
        if not own.any():
            expected[r["id"]] = 0.0
            continue
        a = far[i][own].mean()
        b = min(far[i][labels == c].mean() for c in set(labels) - {labels[i]})
        expected[r["id"]] = (b - a) / max(a, b)
    for block in (8, 4096):
        found = silhouette(alone, "company_id", "cluster", "vector", block).collect()
        assert {r["id"]: pytest.approx(r["silhouette"]) for r in found} == expected


def test_pruned_assignment_visits_a_part(spark):
    """Points around 100 far places, each place a centroid: a point visits few pivots; copies and ties go by number."""
    rng = np.random.default_rng(6)
    places = rng.uniform(-1_000, 1_000, size=(100, 3))
    rows = spark.createDataFrame([(i, 1, (places[i % 100] + rng.normal(size=3)).tolist()) for i in range(900)], SCHEMA)
    saved = spark.createDataFrame(
        [(1, c, p.tolist()) for c, p in enumerate(places)] + [(1, 100 + c, places[c].tolist()) for c in range(9)],
        "company_id long, cluster int, centroid array<double>")
    found = assign_nearest(rows, saved, "company_id", "cluster", "vector", block=200, prune_above=0).collect()
    assert len(found) == 900 and all(r["cluster"] == r["id"] % 100 for r in found)
    work = assignment_work(rows, saved, "company_id", "cluster", "vector", block=200).first()
    assert work["pairs"] == 900 * 109 and work["visits"] < 0.6 * work["pairs"]


def test_assignment_leaves_out_rows_without_vector_or_centroids(spark):
    rows = spark.createDataFrame([(1, 1, [1.0]), (2, 1, None), (3, 2, [1.0]), (4, None, [1.0])], SCHEMA)
    saved = spark.createDataFrame([(1, "a", [0.0]), (1, "b", [3.0])], "company_id long, cluster string, centroid array<double>")
    for prune_above in (0, 9):
        found = assign_nearest(rows, saved, "company_id", "cluster", "vector", prune_above=prune_above).collect()
        assert [(r["id"], r["cluster"], r["distance_centroid"]) for r in found] == [(1, "a", 1.0)]


def plain_silhouette(x, labels):
    far = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    found = []
    for i in range(len(x)):
        own = (labels == labels[i]) & (np.arange(len(x)) != i)
        if not own.any():
            found.append(0.0)
            continue
        a = far[i][own].mean()
        b = min(far[i][labels == c].mean() for c in set(labels) - {labels[i]})
        found.append((b - a) / max(a, b))
    return found


@pytest.mark.parametrize("block_points", [7, 16, 4_096])
def test_euclidean_silhouette_equals_brute_force(spark, block_points):
    """Bins of a few points: clusters are spread over several pieces, and the rows hold copies and a lone point."""
    df = points(spark, {1: 40, 2: 25}).withColumn("cluster", F.when(F.col("id") == 0, 9).otherwise((F.col("id") % 3).cast("int")))
    df = df.unionByName(df.where("id in (3, 4, 5, 50)").withColumn("id", F.col("id") + 100))
    data = df.collect()
    expected = {}
    for company in (1, 2):
        rows = [r for r in data if r["company_id"] == company]
        scores = plain_silhouette(np.array([r["vector"] for r in rows]), np.array([r["cluster"] for r in rows]))
        expected |= {r["id"]: s for r, s in zip(rows, scores)}
    found = euclidean_silhouette(df, "company_id", "cluster", "vector", block_points).collect()
    assert {r["id"]: r["silhouette"] for r in found} == pytest.approx(expected)


def test_silhouette_of_one_cluster_and_missing_values(spark):
    df = spark.createDataFrame(
        [(1, 1, [0.0, 1.0]), (2, 1, [1.0, 0.0]), (3, 2, None), (4, None, [0.0, 0.0])], SCHEMA).withColumn("cluster", F.lit(0))
    found = euclidean_silhouette(df, "company_id", "cluster", "vector").collect()
    assert sorted((r["id"], r["silhouette"]) for r in found) == [(1, None), (2, None), (3, None), (4, None)]


def test_sweeps_of_all_companies_in_one_job(spark):
    df = points(spark, {1: 30, 2: 4, 3: 12}, seed=2)
    made, labels = sweep_labels(df, "company_id", "vector", 1, 5, restarts=3)
    rows = labels.join(made, ["company_id", "point"]).collect()
    assert {(r["company_id"], r["k"]) for r in rows} == {(c, k) for c in (1, 2, 3) for k in range(1, 6) if k <= 4 or c != 2}
    wss = {(r["company_id"], r["k"]): r["wss"] for r in elbow_sweep(df, "company_id", "vector", most=5, restarts=3).collect()}
    scores = {(r["company_id"], r["k"]): r["silhouette"]
              for r in silhouette_sweep(df, "company_id", "vector", most=5, restarts=3).collect()}
    for key in wss:
        own = [r for r in rows if (r["company_id"], r["k"]) == key]
        x, label = np.array([r["vector"] for r in own]), np.array([r["cluster"] for r in own])
        assert len(set(label)) == key[1]
        assert wss[key] == pytest.approx(sum(((x[label == c] - x[label == c].mean(0)) ** 2).sum() for c in set(label)), abs=1e-9)
        if key[1] > 1:
            assert scores[key] == pytest.approx(np.mean(plain_silhouette(x, label)))
    assert all(wss[c, k] <= wss[c, k - 1] + 1e-9 for c, k in wss if k > 1)


def test_sweeps_and_projection(spark):
    rng = np.random.default_rng(1)
    data = [(i, 1, (rng.normal(size=3) + 20 * (i % 3)).tolist()) for i in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    wss = {r["k"]: r["wss"] for r in elbow_sweep(df, "company_id", "vector", most=5).collect()}
    assert sorted(wss) == [1, 2, 3, 4, 5]
    x = np.array([d[2] for d in data])
    assert wss[1] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert wss[1] > 10 * wss[3]
    scores = {r["k"]: r["silhouette"]
              for r in silhouette_sweep(df, "company_id", "vector", most=5).collect()}
    assert max(scores, key=scores.get) == 3
    one = within_sum_of_squares(df, ["company_id"], "vector").first()
    assert one["wss"] == pytest.approx(wss[1])
    view = project_2d(df, "vector").collect()
    pc = np.array([[r["pc1"], r["pc2"]] for r in sorted(view, key=lambda r: r["id"])])
    _, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.var(pc[:, 0], ddof=1) == pytest.approx(s[0] ** 2 / 59)
    assert np.var(pc[:, 1], ddof=1) == pytest.approx(s[1] ** 2 / 59)


@pytest.mark.parametrize("clusters", [1, 6, 40])
def test_measuring_only_what_may_have_changed_gives_the_whole_rounds(clusters):
    """The fit of a task against rounds that measure every point against every centre, also with equal distances."""
    rng = np.random.default_rng(4)
    for x in (rng.normal(size=(400, 5)), np.unique(rng.integers(0, 4, (400, 3)), axis=0).astype(float)):
        weights, marks = rng.integers(1, 4, len(x)).astype(float), rng.integers(-2**62, 2**62, len(x))
        centers, cost, empty = kmeans.fit_block(x, weights, marks, clusters, 2, 300, 42)
        gaps = ((x[:, None] - centers) ** 2).sum(-1)
        label = gaps.argmin(1)
        assert cost == pytest.approx(weights @ gaps.min(1), abs=1e-9) and empty == clusters - len(set(label))
        held, _, _ = kmeans.fit_block(x, weights, marks, clusters, 2, 0, 42)
        for _ in range(300):
            label = ((x[:, None] - held) ** 2).sum(-1).argmin(1)
            mass, total = kmeans.cluster_sums(x * weights[:, None], weights, label, clusters)
            moved = np.where(mass[:, None] > 0, total / np.maximum(mass, 1e-300)[:, None], held)
            if np.allclose(moved, held, rtol=0, atol=1e-12):
                break
            held = moved
        assert len(x) < 400 or centers == pytest.approx(held, abs=1e-9)


def test_a_group_of_several_blocks_takes_no_job_a_round(spark, monkeypatch):
    """Above a block and below the size a task may hold, a fit needs no round of Spark jobs, and no slice of all its centres."""
    def rounds(*_):
        raise AssertionError("rounds over blocks")
    monkeypatch.setattr(kmeans, "block_pass", rounds)
    df = points(spark, {1: 5_000, 2: 30}).withColumn("point", F.col("id").cast("string"))
    made, sizes, blocks = kmeans.prepared(df, "company_id", "vector")
    assert {r["company_id"]: r["n_blocks"] for r in sizes.collect()} == {1: 2, 2: 1}
    fits = sizes.withColumn("clusters", F.lit(3).cast("long"))
    found = kmeans.fit_groups(made, blocks, fits, "company_id", restarts=3, rounds=5).collect()
    assert sorted((r["company_id"], r["cluster"]) for r in found) == [(c, n) for c in (1, 2) for n in range(3)]


def test_copies_of_blocks_grow_with_the_points_alone(spark):
    """The share of restarts of a task hangs on the number of fits, so what is shuffled grows as the points do."""
    seen = []
    for size in (40, 4_000):
        df = points(spark, {1: size}).withColumn("point", F.col("id").cast("string"))
        made, sizes, blocks = kmeans.prepared(df, "company_id", "vector")
        fits = sizes.withColumn("clusters", F.lit(2).cast("long"))
        plan = kmeans._fit_whole(blocks, fits, "company_id", 50, 5, 42)._jdf.queryExecution().toString()
        seen.append("sequence(0, 49" in plan)
    assert seen == [True, True]


def test_few_centres_measure_only_points_whose_slack_is_used_up(monkeypatch):
    """The rounds that measure every point give the same centres; most points of most rounds are not measured."""
    measured, measure = [], kmeans._FewCenters.measure
    monkeypatch.setattr(kmeans._FewCenters, "measure", lambda s, c, rows: measured.append(len(rows)) or measure(s, c, rows))
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6_000, 8))
    weights, marks = rng.integers(1, 4, len(x)).astype(float), rng.integers(-2**62, 2**62, len(x))
    for moved in (x, x * 1e-3, x + 1e3):
        measured.clear()
        centers, cost, empty = kmeans.fit_block(moved, weights, marks, 7, 1, 300, 42)
        whole, whole_cost, whole_empty = kmeans._fit_many(moved, weights, marks, 7, 1, 300, 42)
        assert cost == pytest.approx(whole_cost, rel=1e-9) and empty == whole_empty == 0
        assert centers - moved[0] == pytest.approx(whole - moved[0], rel=1e-6, abs=1e-6 * np.abs(x).max())
        assert len(measured) > 40 and sum(measured) < 0.5 * len(measured) * len(x)


def test_few_centres_of_equal_distances():
    """Points on a lattice lie between centres: differences decide, the first of equal ones wins, and nothing is lost."""
    x = np.stack(np.meshgrid(*[np.arange(6.0)] * 3), -1).reshape(-1, 3)
    held, centers = kmeans._FewCenters(x, np.ones(len(x))), np.array([[1.0, 1, 1], [3, 1, 1], [1, 3, 1], [3, 3, 3]])
    held.begin(4)
    gaps = ((x[:, None] - centers) ** 2).sum(-1)
    assert (held.measure(centers, np.arange(len(x))) == gaps.argmin(1)).all()
    near, second = np.sqrt(np.sort(gaps)[:, :2]).T
    assert (held.key <= (second - near) / held.scale).all() and (held.key[second == near] <= 0).all()


def test_counts_of_a_restart_share_its_draws():
    rng = np.random.default_rng(9)
    x, weights = rng.normal(size=(300, 4)), np.ones(300)
    marks = rng.integers(-2**62, 2**62, 300)
    together = {c: (centers, cost, empty) for c, centers, cost, empty in kmeans.fit_counts(
        x, weights, marks, [1, 2, 5, 9, 40], 3, 300, 42)}
    for count, (centers, cost, empty) in together.items():
        alone = kmeans.fit_block(x, weights, marks, count, 3, 300, 42)
        assert (centers == alone[0]).all() and (cost, empty) == alone[1:] and len(centers) == count


def test_counts_of_a_sweep_do_not_multiply_the_copies(spark):
    """Ten counts of twenty companies: a share takes the restarts of all counts, so each company is copied ten times at most."""
    df = points(spark, {c: 12 for c in range(20)}).withColumn("point", F.col("id").cast("string"))
    made, sizes, blocks = kmeans.prepared(df, "company_id", "vector")
    fits = sizes.withColumn("clusters", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(10).cast("long"))))
    seen, fit_counts = spark.sparkContext.accumulator(0), kmeans.fit_counts

    def counted(x, *rest):
        seen.add(1)
        return fit_counts(x, *rest)

    kmeans.fit_counts = counted
    try:
        found = kmeans._fit_whole(blocks, fits, "company_id", 10, 20, 42).groupBy("company_id", "clusters").count().collect()
    finally:
        kmeans.fit_counts = fit_counts
    assert {(r["company_id"], r["clusters"], r["count"]) for r in found} == {(c, k, k) for c in range(20) for k in range(1, 11)}
    assert seen.value == 200


@pytest.mark.parametrize("chunk_points", [9, 4_096])
def test_silhouettes_of_many_labellings_equal_brute_force(spark, chunk_points):
    """Several chunks of a company; copies, a point alone in its cluster, an empty and an only cluster."""
    rng = np.random.default_rng(12)
    data = [(company, str(i), rng.normal(size=3).round(1 if company == 2 else 6).tolist(), int(rng.integers(1, 4)))
            for company, size in ((1, 50), (2, 23), (3, 4)) for i in range(size)]
    named = [(company, k, point, 1 if company == 3 and k == 2 else 0 if point == "0" else 1 + int(point) % (k - 1 or 1))
             for company, point, _, _ in data for k in ((2, 3, 5) if company < 3 else (2, 3))]
    made = spark.createDataFrame(data, "company_id long, point string, vector array<double>, weight long")
    labels = spark.createDataFrame(named, "company_id long, k long, point string, cluster long")
    found = {(r["company_id"], r["k"]): r["silhouette"]
             for r in silhouettes.silhouette_means(made, labels, "company_id", chunk_points).collect()}
    label_of = {(c, k, p): n for c, k, p, n in named}
    for company, k in {(c, k) for c, k, _, _ in named}:
        rows = [(v, label_of[company, k, p]) for c, p, v, w in data if c == company for _ in range(w)]
        label = np.array([n for _, n in rows])
        if len(set(label)) == 1:
            assert found[company, k] is None
        else:
            assert found[company, k] == pytest.approx(np.mean(plain_silhouette(np.array([v for v, _ in rows]), label)))
    assert len(found) == 8


def test_a_sweep_measures_each_pair_of_points_once(spark, monkeypatch):
    """All counts share the distances; above SHARED_CLUSTERS each count measures its own, with the same means."""
    def each_count(*_):
        raise AssertionError("distances of every count")
    df = points(spark, {1: 60, 2: 3}, seed=4)
    own = silhouettes.silhouette_points
    monkeypatch.setattr(quality, "silhouette_points", each_count)
    shared = {(r["company_id"], r["k"]): r["silhouette"] for r in silhouette_sweep(df, "company_id", "vector", most=4, restarts=2).collect()}
    monkeypatch.setattr(quality, "silhouette_points", own)
    monkeypatch.setattr(quality, "SHARED_CLUSTERS", 0)
    alone = {(r["company_id"], r["k"]): r["silhouette"] for r in silhouette_sweep(df, "company_id", "vector", most=4, restarts=2).collect()}
    assert set(shared) == {(1, 2), (1, 3), (1, 4), (2, 2), (2, 3)} and shared == pytest.approx(alone)


def test_sums_of_pairs_by_tiles_equal_brute_force(monkeypatch):
    """Tiles within a chunk and across two, with points that lie close to each other far from zero."""
    monkeypatch.setattr(silhouettes, "TILE", 7)
    rng = np.random.default_rng(13)
    x, y, marks, others = rng.normal(size=(30, 3)), rng.normal(size=(17, 3)), rng.random((30, 4)), rng.random((17, 4))
    x[5], y[3] = x[4] + 1e-7, x[9] - 1e-7
    x, y = x + 10, y + 10
    far = np.sqrt(((x[:, None] - y) ** 2).sum(-1))
    mine, theirs = silhouettes.pair_sums(x, y, marks, others)
    assert mine == pytest.approx(far @ others) and theirs == pytest.approx(far.T @ marks)
    own = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    assert silhouettes.pair_sums(x, x, marks, marks, True)[0] == pytest.approx(own @ marks)


def test_many_centres_are_screened_in_single_precision(monkeypatch):
    """Double precision only where single cannot tell two centres apart; labels, also of equal distances, are those of double."""
    seen, two_nearest = {"float32": 0, "float64": 0}, kmeans.two_nearest

    def counted(x, square, centers):
        seen[x.dtype.name] += len(x)
        return two_nearest(x, square, centers)

    monkeypatch.setattr(kmeans, "two_nearest", counted)
    rng = np.random.default_rng(14)
    for x in (rng.normal(size=(3_000, 6)), rng.normal(size=(3_000, 6)) + 50, np.unique(rng.integers(0, 6, (900, 3)), axis=0) + 7.0):
        centers = x[rng.choice(len(x), 90, replace=False)]
        held = kmeans._Assignment(x)
        held.meet(centers, np.arange(90))
        gaps = ((x[:, None] - centers) ** 2).sum(-1)
        assert (held.label == gaps.argmin(1)).all() and held.near == pytest.approx(gaps.min(1))
        assert (held.other <= np.sort(gaps)[:, 1] + 1e-9).all()
    seen.update(float32=0, float64=0)
    kmeans._Assignment(rng.normal(size=(3_000, 6))).meet(centers := rng.normal(size=(90, 6)), np.arange(90))
    assert seen["float32"] == 3_000 and seen["float64"] < 60 and len(centers) == 90


def test_values_that_are_no_numbers_stay_in_double_precision():
    x = np.array([[1.0, 2.0], [np.nan, 0.0], [3.0, 1.0]])
    assert kmeans._Assignment(x).held is None
    kmeans.fit_block(x, np.ones(3), np.arange(3), 2, 0, 5, 42)


def test_fits_of_all_counts_keep_the_identity_of_their_sums(monkeypatch):
    """Cost is sum|x|^2 - |sum x|^2 / n of the own clusters, with copies, and no count measures every point in every round."""
    def whole_rounds(*_):
        raise AssertionError("all points in every round")
    monkeypatch.setattr(kmeans, "_fit_many", whole_rounds)
    rng = np.random.default_rng(15)
    x, weights = rng.normal(size=(500, 4)), rng.integers(1, 5, 500).astype(float)
    for clusters, centers, cost, empty in kmeans.fit_counts(x, weights, rng.integers(-2**62, 2**62, 500), [*range(1, 11)], 0, 300, 42):
        label = ((x[:, None] - centers) ** 2).sum(-1).argmin(1)
        inside = sum((weights[own] @ x[own] ** 2 - (weights[own] @ x[own]) ** 2 / weights[own].sum()).sum()
                     for own in (label == c for c in range(clusters)))
        assert empty == 0 and cost == pytest.approx(inside, abs=1e-6)
