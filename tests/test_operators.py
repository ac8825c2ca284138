import json
from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ideamill.operators.history import validity, with_default_goal
from ideamill.operators.lookup import (
    known_rows, left_join_many, look_up, new_records, update_column,
)
from ideamill.operators.numbering import (
    batch_number, carry_forward, chunk_number, first_groups, global_number, number_categories,
    running_number, surrogate_keys,
)
from ideamill.operators.reshape import (
    cluster_count, first_non_null, keep_first, members_json, pivot_first, rank_pivot,
)
from ideamill.plans.facts import more_contributors, ranked_contributors, submission_fact


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_new_records_twice_loads_nothing(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    loaded = spark.createDataFrame([(2,)], "k long")
    new = new_records(source, loaded, "k")
    assert rows(new) == [(1, "a"), (None, "c")]
    again = new_records(source.where("k IS NOT NULL"), loaded.unionByName(new.select("k")), "k")
    assert again.isEmpty() and again.schema == source.schema


def test_lookup_default_unknown_null_and_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "k long")
    table = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "two", 1)],
                                  "key long, v string, n long")
    found = look_up(df, table, {"k": "key"}, "v", "v", order="n")
    assert rows(found) == [(1, "new"), (2, "two"), (9, None), (None, None)]
    found = look_up(df, table, {"k": "key"}, "v", "v", F.lit("None"), order="n")
    assert rows(found) == [(1, "new"), (2, "two"), (9, "None"), (None, "None")]
    assert rows(known_rows(df, table, {"k": "key"})) == [(1,), (2,)]


def test_update_column(spark):
    table = spark.createDataFrame([(1, 0.5), (2, 0.25)], "k long, d double")
    updates = spark.createDataFrame([(2, 0.75), (3, 1.0)], "k long, d double")
    assert rows(update_column(table, updates, "k", "d")) == [(1, 0.5), (2, 0.75)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 10**6)),
                min_size=1, max_size=200))
def test_numbers_by_ranges_equal_the_window(spark, data):
    df = spark.createDataFrame(data, "g string, o long")
    plain = rows(running_number(df, ["g"], ["o"], "n"))
    assert rows(running_number(df, ["g"], ["o"], "n", hot_rows=0)) == plain
    for g in {d[0] for d in data}:
        numbers = [r[2] for r in sorted(plain, key=lambda r: r[1]) if r[0] == g]
        assert numbers == list(range(1, len(numbers) + 1))


def test_hot_group_spans_ranges(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("g"), "id")
    hot = running_number(df, ["g"], ["id"], "n", hot_rows=100)
    plain = running_number(df, ["g"], ["id"], "n")
    assert hot.exceptAll(plain).isEmpty() and hot.count() == 20_000


@pytest.mark.parametrize("size", [3_000, 12_000])
def test_ties_are_numbered_alike_at_any_size(spark, size):
    """All rows share the key: the other column decides in the window and in both range branches."""
    df = spark.range(size).select(
        F.lit("g").alias("g"), F.lit(1).alias("o"), (F.col("id") * 7919 % 15_013).alias("x")).repartition(7)
    plain = running_number(df, ["g"], ["o"], "n")
    spread = running_number(df, ["g"], ["o"], "n", hot_rows=100)
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()
    assert [r.n for r in plain.orderBy("x").select("n").collect()] == list(range(1, size + 1))


def test_hot_copies_are_numbered(spark):
    """Two thirds of the rows are one row: no order can split them."""
    df = spark.range(90_000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("o"))
    found = running_number(df, ["g"], ["o"], "n", hot_rows=100)
    assert found.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 90_000, 90_000)
    assert found.exceptAll(running_number(df, ["g"], ["o"], "n")).isEmpty()
    busiest = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert busiest < 45_000


def test_left_join_many(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k long, w string")
    assert rows(left_join_many(left, right, "k").select("k", "v", "w")) == rows(
        left.join(right, "k", "left").select("k", "v", "w"))


def test_surrogate_keys_follow_the_highest(spark):
    new = spark.range(1000).select((F.col("id") * 7).alias("k"), F.lit("x").alias("v"))
    loaded = spark.createDataFrame([(41, 5), (12, 3)], "id long, k long")
    for unique in (False, True):
        keyed = surrogate_keys(new, loaded, ["k"], unique=unique)
        assert keyed.columns == ["id", "k", "v"]
        found = rows(keyed.select("id", "k"))
        assert sorted(found) == [(42 + i, 7 * i) for i in range(1000)]
    empty = surrogate_keys(new.limit(0), loaded.limit(0), ["k"])
    assert empty.isEmpty() and empty.columns == ["id", "k", "v"]


def test_global_number_and_batches(spark):
    df = spark.range(250).select((F.lit(1000) - F.col("id")).alias("k"))
    assert sorted(rows(global_number(df, ["k"], "n", start=0))) == [
        (751 + i, i) for i in range(250)]
    sizes = batch_number(df, ["k"]).groupBy("batch_no").count()
    assert rows(sizes) == [(0, 100), (1, 100), (2, 50)]


def test_category_numbers(spark):
    data = [(1, 10, "Problem"), (1, 11, "Other"), (1, 12, "Problem"), (1, 13, "Solution"),
            (2, 14, "Problem"), (1, 15, "Idea name"), (1, 16, "Problem")]
    df = spark.createDataFrame(data, "company_id long, field_id long, category string")
    for hot in (1, 1000):
        found = number_categories(df, "company_id", "category", ["field_id"], hot_rows=hot)
        assert dict((r[1], r[2]) for r in found.collect()) == {
            10: "Problem 1", 11: "Other", 12: "Problem 2", 13: "Solution 1", 14: "Problem 1",
            15: "Idea name", 16: "Problem 3"}


def test_chunks_and_carry_forward(spark):
    df = spark.range(12).select(F.lit(1).alias("g"), "id")
    found = rows(chunk_number(df, ["g"], ["id"]).select("id", "chunk", "position"))
    assert sorted(found) == [(i, i // 5, i % 5) for i in range(12)]
    labels = spark.createDataFrame(
        [(1, 0, "a"), (1, 1, None), (1, 2, "c"), (2, 0, "d")], "g long, chunk long, name string")
    carried = carry_forward(labels, ["g"], ["name"]).select("g", "chunk", "previous_name")
    assert rows(carried) == [(1, 0, None), (1, 1, "a"), (1, 2, None), (2, 0, None)]


def test_first_groups(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "c"), (1, "d")], "g long, v string")
    assert rows(first_groups(df, ["g"], 2)) == [(1, "b"), (1, "d"), (2, "c")]


def test_first_non_null_is_ordered(spark):
    df = spark.createDataFrame(
        [(1, 3, "late", 1.0), (1, 1, None, None), (1, 2, "early", 2.0), (1, 2, "Early", None),
         (2, 1, None, None)], "k long, o long, v string, d double")
    assert rows(first_non_null(df, ["k"], ["v", "d"], ["o"])) == [
        (1, "Early", 2.0), (2, None, None)]


def test_pivot_has_a_fixed_schema(spark):
    df = spark.createDataFrame(
        [(1, "Problem 1", 1, "p", [1.0]), (1, "Solution 1", 2, "s", None),
         (1, "Problem 7", 3, "lost", [3.0])],
        "k long, category string, o long, text string, v array<double>")
    wide = pivot_first(df, ["k"], "category", ["o"], {
        "text": {"Problem 1": "problem_1", "Problem 2": "problem_2", "Solution 1": "solution_1"},
        "v": {"Problem 1": "prob_1_embedded"}}, others=["text"], ties={"v": "text"})
    assert wide.columns == ["k", "problem_1", "problem_2", "solution_1", "prob_1_embedded",
                            "text"]
    assert rows(wide) == [(1, "p", None, "s", [1.0], "p")]


def test_keep_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 5, "n"), (None, 4, "m")],
                               "k long, o long, v string")
    assert rows(keep_first(df, ["k"], ["o"])) == [(1, 1, "a"), (None, 4, "m")]


def test_cluster_count_rounds_half_to_even(spark):
    sizes = [1, 5, 14, 15, 16, 25, 35, 1360]
    df = spark.createDataFrame([(s,) for s in sizes], "n long")
    assert [r[0] for r in df.select(cluster_count(F.col("n"))).collect()] == [
        1, 1, 1, 2, 2, 2, 4, 136]


def contributors(spark):
    """Ideas with 1, 4 and 6 contributors; user 103 has no dimension row."""
    contributions = spark.createDataFrame(
        [(1, 101)] + [(2, u) for u in (104, 102, 101, 103)] + [(3, u) for u in range(101, 107)],
        "idea_id long, user_id long")
    users = spark.createDataFrame(
        [(u - 100, u) for u in (101, 102, 104, 105, 106)], "id long, user_db_id long")
    return contributions, users


def test_rank_pivot_and_json(spark):
    ranked = ranked_contributors(*contributors(spark))
    assert rows(rank_pivot(ranked, "idea_id", "user_num", "user_key", "user_id")) == [
        (1, 1, None, None, None), (2, 1, 2, None, 4), (3, 1, 2, None, 4)]
    cells = {(r[0], r[1]): json.loads(r[2]) for r in members_json(
        ranked, "idea_id", "user_num", "user_key", "user_id").collect()}
    assert cells == {
        (1, 0): {"user_id_1": 1}, (2, 0): {"user_id_1": 1, "user_id_2": 2, "user_id_4": 4},
        (3, 0): {"user_id_1": 1, "user_id_2": 2, "user_id_4": 4, "user_id_5": 5,
                 "user_id_6": 6}}


def test_large_groups_go_on_in_further_cells(spark):
    contributions = spark.range(2500).select(F.lit(1).cast("long").alias("idea_id"),
                                             F.col("id").alias("user_id"))
    users = spark.range(2500).select((F.col("id") + 1).alias("id"),
                                     F.col("id").alias("user_db_id"))
    for hot in (100, 10**6):
        ranked = ranked_contributors(contributions, users, hot_rows=hot)
        first = members_json(ranked, "idea_id", "user_num", "user_key", "user_id").where(
            "cell = 0")
        more = more_contributors(ranked)
        members = {}
        for r in first.unionByName(more).collect():
            part = json.loads(r["users"])
            assert len(part) <= 1000
            members |= part
        assert members == {f"user_id_{i}": i for i in range(1, 2501)}


def test_submission_fact(spark):
    stage = spark.createDataFrame(
        [(1, 7, 8, datetime(2024, 1, 1)), (2, None, None, None), (3, 7, 8, None), (5, 7, 8, None),
         (6, 7, 8, None)],
        "idea_db_id long, company_id long, goal_id long, submitted_at timestamp")
    ideas = spark.createDataFrame([(11, 1), (12, 2), (13, 3), (16, 6)],
                                  "id long, idea_db_id long")
    fact = submission_fact(stage, *contributors(spark), ideas)
    found = {r["idea_id"]: r for r in fact.collect()}
    assert sorted(found) == [11, 12, 13, 16]
    assert found[12]["company_id"] == 0 and found[12]["goal_id"] == 0
    assert found[12]["submitted_at"] == datetime(1900, 1, 1)
    assert [found[13][f"user_id_{i}"] for i in range(1, 5)] == [1, 2, 0, 4]
    assert [found[16][f"user_id_{i}"] for i in range(1, 5)] == [0, 0, 0, 0]
    assert found[16]["users"] is None


def test_validity_and_default_goal(spark):
    df = spark.createDataFrame([(5, "Goal")], "goal_db_id long, goal_name string")
    row = validity(df, date(2024, 5, 1)).first()
    assert (row["valid_from"], row["valid_to"], row["is_current"]) == (
        datetime(2024, 5, 1), datetime(9999, 12, 31), True)
    assert rows(with_default_goal(df)) == [(0, "Sin meta"), (5, "Goal")]


@pytest.mark.parametrize("name", ["id", "k"])
def test_number_column_may_replace_nothing(spark, name):
    df = spark.createDataFrame([(1,), (2,)], "a long")
    assert global_number(df, ["a"], name).columns == ["a", name]
