"""Queries on group aggregates, pivots, numbering, keys and history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ideamill import schemas
from ideamill.functions.values import compact_left, ensure_columns
from ideamill.operators.history import validity, with_default_goal
from ideamill.operators.labels import chunk_ideas
from ideamill.operators.lookup import new_records, update_column
from ideamill.operators.numbering import (
    carry_forward, global_number, number_categories, running_number, surrogate_keys,
)
from ideamill.operators.reshape import (
    cluster_count, first_non_null, keep_first, members_json, pivot_first, rank_pivot,
)
from ideamill.plans.facts import more_contributors, ranked_contributors, submission_members
from registry.base import new_registry
from registry.stand_ins import CONTRIBUTIONS, DIM_USERS, Tables, with_day_text

QUERIES, ORACLES, query = new_registry()

LINE_VALUES = """staged AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
  CASE WHEN l_discount > 0.02 THEN l_shipdate END AS shipped,
  CASE WHEN l_quantity >= 10 THEN l_quantity END AS quantity FROM lineitem)"""


@query(f"""WITH {LINE_VALUES} SELECT l_orderkey,
  arg_min(flag, {{'a': l_linenumber, 'b': flag}}) FILTER (flag IS NOT NULL) AS flag,
  arg_min(shipped, {{'a': l_linenumber, 'b': shipped}}) FILTER (shipped IS NOT NULL) AS shipped,
  arg_min(quantity, {{'a': l_linenumber, 'b': quantity}}) FILTER (quantity IS NOT NULL) AS quantity
FROM staged GROUP BY l_orderkey""")
def first_non_null_values(t: Tables):
    staged = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_discount") > 0.02, F.col("l_shipdate")).alias("shipped"),
        F.when(F.col("l_quantity") >= 10, F.col("l_quantity")).alias("quantity"))
    return first_non_null(staged, ["l_orderkey"], ["flag", "shipped", "quantity"],
                          ["l_linenumber"])


def _slots(kind: str, prefix: str) -> str:
    """SQL: the values of a family in slot order, moved left over the missing ones."""
    first = ", ".join(
        f"arg_min(answer, {{'a': l_suppkey, 'b': answer}}) "
        f"FILTER (category = '{kind} {i}' AND answer IS NOT NULL)" for i in range(1, 7))
    return f"list_filter([{first}], lambda x: x IS NOT NULL) AS {prefix}s"


@query(f"""WITH staged AS (SELECT l_orderkey, l_suppkey,
  CASE WHEN l_linestatus = 'F' THEN 'Problem ' ELSE 'Solution ' END || l_linenumber AS category,
  CASE WHEN l_quantity > 15 THEN lpad(CAST(CAST(l_quantity AS INT) AS VARCHAR), 2, '0') END
    AS answer FROM lineitem),
lists AS (SELECT l_orderkey, {_slots('Problem', 'problem')}, {_slots('Solution', 'solution')},
  min(l_suppkey) AS user_id FROM staged GROUP BY l_orderkey)
SELECT l_orderkey AS idea_db_id, user_id,
  {", ".join(f"problems[{i}] AS problem_{i}, solutions[{i}] AS solution_{i}" for i in range(1, 7))},
  CAST(NULL AS VARCHAR) AS stage FROM lists""")
def category_pivot_wide(t: Tables):
    kind = F.when(F.col("l_linestatus") == "F", F.lit("Problem")).otherwise(F.lit("Solution"))
    text = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    staged = t.lineitem.select(
        "l_orderkey", F.col("l_suppkey").alias("user_id"),
        F.concat_ws(" ", kind, "l_linenumber").alias("category"),
        F.when(F.col("l_quantity") > 15, text).alias("answer"))
    wide = pivot_first(staged, ["l_orderkey"], "category", ["user_id"],
                       {"answer": schemas.TEXT_COLUMN_OF}, others=["user_id"])
    named = wide.withColumnsRenamed({"l_orderkey": "idea_db_id"})
    full = ensure_columns(named, {"stage": "string", "problem_1": "string"})
    return compact_left(full, [schemas.PROBLEMS, schemas.SOLUTIONS])


RANKED = f"""{CONTRIBUTIONS}, {DIM_USERS}, ranked AS (
SELECT idea_id, row_number() OVER (PARTITION BY idea_id ORDER BY user_id) AS user_num,
  id AS user_key FROM contributions LEFT JOIN dim_users ON user_db_id = user_id)"""


@query(f"""WITH {RANKED} SELECT idea_id,
  {", ".join(f"max(user_key) FILTER (user_num = {i}) AS user_id_{i}" for i in range(1, 5))}
FROM ranked GROUP BY idea_id""")
def rank_pivot_users(t: Tables):
    ranked = ranked_contributors(t.contributions, t.dim_users)
    return rank_pivot(ranked, "idea_id", "user_num", "user_key", "user_id")


@query(f"""WITH {RANKED} SELECT idea_id, CAST(0 AS BIGINT) AS cell,
  '{{' || coalesce(string_agg('"user_id_' || user_num || '":' || user_key, ',' ORDER BY user_num)
    FILTER (user_key IS NOT NULL), '') || '}}' AS users
FROM ranked GROUP BY idea_id""")
def members_as_json(t: Tables):
    ranked = ranked_contributors(t.contributions, t.dim_users)
    return members_json(ranked, "idea_id", "user_num", "user_key", "user_id")


@query(f"""WITH {RANKED} SELECT idea_id, (user_num - 1) // 3 AS cell,
  '{{' || coalesce(string_agg('"user_id_' || user_num || '":' || user_key, ',' ORDER BY user_num)
    FILTER (user_key IS NOT NULL), '') || '}}' AS users
FROM ranked WHERE user_num > 3 GROUP BY ALL""")
def members_in_further_cells(t: Tables):
    ranked = ranked_contributors(t.contributions, t.dim_users)
    return more_contributors(ranked, per_cell=3)


@query(f"""WITH {RANKED} SELECT idea_id + 1000 AS idea_id,
  coalesce(string_agg('"user_id_' || user_num || '":' || user_key, ',' ORDER BY user_num)
    FILTER (user_key IS NOT NULL), '') AS users
FROM ranked GROUP BY idea_id""")
def submission_members_whole(t: Tables):
    """Cells of two, put together again: no contributor of any idea is missing."""
    ideas = t.contributions.select("idea_id").distinct().select(
        F.col("idea_id").alias("idea_db_id"), (F.col("idea_id") + 1000).alias("id"))
    cells = submission_members(t.contributions, t.dim_users, ideas, per_cell=2)
    inside = F.expr("substring(users, 2, length(users) - 2)")
    held = F.transform(F.array_sort(F.collect_list(F.struct("cell", inside.alias("text")))), lambda c: c["text"])
    return cells.groupBy("idea_id").agg(F.array_join(F.filter(held, lambda x: x != ""), ",").alias("users"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey) = 1""")
def dedupe_keep_first(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return keep_first(rows, ["l_orderkey", "l_linenumber"],
                      ["l_shipdate", "l_partkey", "l_suppkey"])


@query("""SELECT event_id, user_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""")
def dedupe_row_number(t: Tables):
    return keep_first(t.events.select("event_id", "user_id", "event_type", "ts"),
                      ["user_id", "event_type"], ["event_id"])


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def unique_values(t: Tables):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


CATEGORY_OF_PART = """CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'Problem'
  WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Solution' ELSE 'Other' END"""


@query(f"""WITH staged AS (SELECT p_partkey AS field_id, p_size AS company_id,
  {CATEGORY_OF_PART} AS category FROM part)
SELECT field_id, company_id, category || CASE WHEN category = 'Other' THEN '' ELSE ' ' ||
  row_number() OVER (PARTITION BY company_id, category ORDER BY field_id) END AS category
FROM staged""")
def category_numbering(t: Tables):
    fields = t.part.select(
        F.col("p_partkey").alias("field_id"), F.col("p_size").alias("company_id"),
        F.expr(CATEGORY_OF_PART).alias("category"))
    return number_categories(fields, "company_id", "category", ["field_id"])


@query("""SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey,
    l_suppkey, l_extendedprice) AS n FROM lineitem""")
def running_number_hot_groups(t: Tables):
    """Three groups hold all rows: numbered by key ranges, not one task per group."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.lineitem.select("l_returnflag", *order)
    return running_number(rows, ["l_returnflag"], order, "n", hot_rows=1000)


@query("""SELECT o_orderkey, o_totalprice,
  row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders""")
def running_number_whole_table(t: Tables):
    return global_number(t.orders.select("o_orderkey", "o_totalprice"),
                         ["o_totalprice", "o_orderkey"], "n")


CHUNKED = """chunked AS (SELECT c_nationkey, c_custkey, c_name, n AS index, n // 5 AS chunk,
  n % 5 AS position FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey
  ORDER BY c_custkey) - 1 AS n FROM customer))"""


def _chunked(t: Tables):
    rows = t.customer.select("c_nationkey", "c_custkey", "c_name")
    return chunk_ideas(rows, ["c_nationkey"], ["c_custkey"])


@query(f"WITH {CHUNKED} SELECT * FROM chunked")
def chunk_of_five(t: Tables):
    return _chunked(t)


@query(f"""WITH {CHUNKED} SELECT c_nationkey, chunk, c_name AS label,
  lag(c_name) OVER (PARTITION BY c_nationkey ORDER BY chunk) AS previous_label
FROM chunked WHERE position = 0""")
def carry_forward_label(t: Tables):
    labels = _chunked(t).where("position = 0").select(
        "c_nationkey", "chunk", F.col("c_name").alias("label"))
    return carry_forward(labels, ["c_nationkey"], ["label"])


@query("""SELECT l_suppkey, count(*) AS n,
  greatest(1, CAST(round_even(count(*) / 10, 0) AS BIGINT)) AS n_clusters
FROM lineitem GROUP BY l_suppkey""")
def cluster_count_rule(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).withColumn(
        "n_clusters", cluster_count(F.col("n")))


@query("""WITH loaded AS (SELECT s_suppkey AS company_db_id, s_suppkey + 1 AS id FROM supplier
  WHERE s_nationkey < 5)
SELECT (SELECT max(id) FROM loaded) + row_number() OVER (ORDER BY s_suppkey) AS id,
  s_suppkey AS company_db_id, s_name
FROM supplier WHERE s_suppkey NOT IN (SELECT company_db_id FROM loaded)""")
def surrogate_key_rows(t: Tables):
    rows = t.supplier.select(F.col("s_suppkey").alias("company_db_id"), "s_name", "s_nationkey")
    loaded = rows.where("s_nationkey < 5").withColumn("id", F.col("company_db_id") + 1)
    new = new_records(rows, loaded, "company_db_id").drop("s_nationkey")
    return surrogate_keys(new, loaded, ["company_db_id"])


@query("""SELECT s_suppkey, s_name, '' AS country, TIMESTAMP '2024-05-01 00:00:00' AS valid_from,
  '9999-12-31' AS valid_to, true AS is_current FROM supplier""")
def validity_columns(t: Tables):
    rows = t.supplier.select("s_suppkey", "s_name").withColumn("country", F.lit(""))
    return with_day_text(validity(rows, date(2024, 5, 1)))


@query("""SELECT p_partkey + 1 AS goal_db_id, p_name AS goal_name, true AS active FROM part
UNION ALL SELECT 0, 'Sin meta', true""")
def default_member(t: Tables):
    goals = t.part.select((F.col("p_partkey") + 1).alias("goal_db_id"),
                          F.col("p_name").alias("goal_name"), F.lit(True).alias("active"))
    return with_default_goal(goals)


@query("""WITH updates AS (SELECT l_orderkey, max(l_extendedprice) AS price FROM lineitem
  WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(price, o_totalprice) AS o_totalprice
FROM orders LEFT JOIN updates ON l_orderkey = o_orderkey""")
def backfill_update(t: Tables):
    updates = t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"))
    return update_column(t.orders.select("o_orderkey", "o_totalprice"), updates, "o_orderkey",
                         "o_totalprice")
