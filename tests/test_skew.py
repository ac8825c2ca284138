"""One key with a third of all rows: results stay whole and no task gets the group."""

import pytest
from pyspark.sql import functions as F

from ideamill.operators.lookup import left_join_many, look_up
from ideamill.operators.numbering import chunk_number, running_number
from ideamill.operators.reshape import first_non_null, keep_first
from ideamill.plans.facts import submission_fact

ROWS = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    return spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id",
        (F.col("id") % 97).alias("v"))


def test_numbers_of_a_hot_key_are_spread(spark, hot):
    found = running_number(hot, ["k"], ["id"], "n", hot_rows=1000)
    assert found.where("k = 0").agg(F.max("n"), F.count_distinct("n")).first() == (
        ROWS // 3, ROWS // 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # The window adds up ranges; rows are placed, not sorted again.
    assert windows and all("_range" in line and "_place" not in line for line in windows)


def test_chunks_of_a_hot_key(spark, hot):
    chunks = chunk_number(hot, ["k"], ["id"], hot_rows=1000)
    sizes = chunks.where("k = 0").groupBy("chunk").count()
    assert sizes.agg(F.min("count"), F.max("count"), F.count("*")).first() == (
        5, 5, ROWS // 15)


def test_group_values_of_a_hot_key_are_combined_first(spark, hot):
    found = first_non_null(hot, ["k"], ["v"], ["id"])
    assert found.where("k = 0").first()["v"] == 0
    assert keep_first(hot, ["k"], ["id"]).count() == ROWS - ROWS // 3 + 1
    for df in (found, keep_first(hot, ["k"], ["id"])):
        assert "partial_min_by" in df._jdf.queryExecution().executedPlan().toString()


SMALL_SIZES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture
def no_broadcast(spark):
    """Joins as on large tables: shuffled, with the size limits cut to the fixture."""
    before = {name: spark.conf.get(name, None) for name in SMALL_SIZES}
    for name, value in SMALL_SIZES.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def test_hot_key_of_a_lookup_is_split(spark, hot, no_broadcast):
    rows = hot.withColumn("text", F.sha2(F.col("id").cast("string"), 256)).repartition(8)
    table = spark.range(ROWS).select(F.col("id").alias("key"), (F.col("id") + 7).alias("x"))
    found = look_up(rows, table, {"k": "key"}, "x", "x", unique=True)
    total = found.agg(F.count("*"), F.sum(F.when(F.col("x") == 7, 1)), F.max("text"))
    assert total.collect()[0][:2] == (ROWS, ROWS // 3)
    assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_the_right_side_is_dealt_to_parts(spark, hot, no_broadcast, tmp_path):
    """A third of the right side has one key: parts of it meet copies of the left row, and each side is scanned once."""
    left = spark.range(-5, ROWS).select(
        F.when(F.col("id") >= 0, F.col("id")).alias("k"), (F.col("id") + 1).alias("x")).unionByName(
        spark.createDataFrame([(0, -1), (ROWS * 2, -2)], "k long, x long"))
    left.write.parquet(str(tmp_path / "left"))
    hot.write.parquet(str(tmp_path / "right"))
    left, right = spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right"))
    spread, plain = left_join_many(left, right, "k", hot_rows=500), left.join(right, "k", "left")
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    plan = spread._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert [sum(f"/{side}]" in line for line in scans) for side in ("left", "right")] == [1, 1]
    parts = spread.where("k = 0").groupBy("x").count().collect()
    assert {r["x"]: r["count"] for r in parts} == {1: ROWS // 3, -1: ROWS // 3}
    sizes = right.withColumn("part", F.pmod(F.xxhash64("k", "id", "v"), F.lit(20))).where("k = 0").groupBy("part").count()
    assert sizes.agg(F.max("count")).first()[0] < 700


def test_fact_with_a_hot_idea(spark):
    contributions = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).cast("long")
        .alias("idea_id"), F.col("id").alias("user_id"))
    users = spark.range(9000).select((F.col("id") + 1).alias("id"),
                                     F.col("id").alias("user_db_id"))
    ideas = contributions.select(F.col("idea_id").alias("idea_db_id")).distinct().withColumn(
        "id", F.col("idea_db_id") + 5)
    stage = ideas.select("idea_db_id", F.lit(1).cast("long").alias("company_id"),
                         F.lit(1).cast("long").alias("goal_id"),
                         F.lit(None).cast("timestamp").alias("submitted_at"))
    plain = submission_fact(stage, contributions, users, ideas)
    spread = submission_fact(stage, contributions, users, ideas, hot_rows=500)
    assert spread.count() == ideas.count()
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()
