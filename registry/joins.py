"""Queries on filters, lookups, form joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ideamill.functions.values import (
    known_key, normalise_missing, not_blank, timestamp_or, without_time_zone,
)
from ideamill.operators.lookup import (
    known_rows, left_join_many, left_join_on, look_up, new_records,
)
from ideamill.operators.numbering import first_groups
from ideamill.plans import forms
from ideamill.settings import LOOKUP_MISS, UNUSED_CATEGORIES
from registry.base import new_registry
from registry.stand_ins import (
    ANSWERS, DIM_COMPANY, DIM_GOALS, DIM_IDEA, DIM_USERS, FIELDS, IDEAS, TAGS, Tables,
)

QUERIES, ORACLES, query = new_registry()


@query(f"""WITH {DIM_IDEA}
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM dim_idea WHERE idea_db_id = l_orderkey)""")
def new_record_filter(t: Tables):
    source = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return new_records(source, t.dim_idea.withColumnRenamed("idea_db_id", "l_orderkey"),
                       "l_orderkey")


@query(f"""WITH {DIM_COMPANY}
SELECT c_custkey, c_nationkey, c_mktsegment,
  c_acctbal >= 0 AND trim(c_name) NOT IN ('', 'None') AS has_text
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_nationkey IN (SELECT company_db_id FROM dim_company)
  AND c_mktsegment NOT IN ('Other', 'None', 'Category: Other')
  AND n_name NOT ILIKE '%nation_2%' AND n_regionkey = 1""")
def known_company_filter(t: Tables):
    # The nations with a 2 in front stand for the demo companies.
    company = t.nation.select(
        F.col("n_nationkey").alias("id"), "n_regionkey",
        F.regexp_replace("n_name", "NATION_2", "DEMO_").alias("name"))
    chosen = forms.companies_without_demos(company)
    known = known_rows(t.customer, t.dim_company, {"c_nationkey": "company_db_id"})
    rows = known_rows(known, chosen.where("n_regionkey = 1"), {"c_nationkey": "id"})
    text = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_name"))
    return rows.where(~F.col("c_mktsegment").isin(*UNUSED_CATEGORIES)).select(
        "c_custkey", "c_nationkey", "c_mktsegment", not_blank(text).alias("has_text"))


@query(f"""WITH {DIM_GOALS}, staged AS (
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderstatus = 'O' THEN 'O' END AS status,
  CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS price,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate
       ELSE TIMESTAMP '2262-04-11 23:47:16.854775' END AS submitted_at FROM orders)
SELECT o_orderkey, coalesce(id, 0) AS goal_id, status, price, submitted_at
FROM staged LEFT JOIN dim_goals ON goal_db_id = o_custkey""")
def key_lookup_default(t: Tables):
    staged = t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "P", "None")
        .when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
        .alias("status"),
        F.when(F.col("o_totalprice") < 100000, F.lit(float("nan")))
        .otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("submitted_at"))
    found = look_up(normalise_missing(staged), t.dim_goals, {"o_custkey": "goal_db_id"}, "id",
                    "goal_id")
    return found.select(
        "o_orderkey", known_key(F.col("goal_id")).alias("goal_id"), "status", "price",
        timestamp_or(F.col("submitted_at")).alias("submitted_at"))


@query(f"""WITH {DIM_COMPANY}, {DIM_GOALS}
SELECT o_orderkey, g.goal_db_id, c.company_db_id
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN dim_goals g ON g.id = o_custkey
LEFT JOIN dim_company c ON c.id = c_nationkey + 100
WHERE g.goal_db_id IS NOT NULL""")
def reverse_lookup(t: Tables):
    fact = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("o_custkey").alias("goal_id"),
        (F.col("c_nationkey") + 100).alias("company_id"))
    goal = look_up(fact, t.dim_goals, {"goal_id": "id"}, "goal_db_id", "goal_db_id",
                   unique=True)
    company = look_up(goal, t.dim_company, {"company_id": "id"}, "company_db_id",
                      "company_db_id", unique=True)
    return company.where("goal_db_id IS NOT NULL").select(
        "o_orderkey", "goal_db_id", "company_db_id")


@query("""WITH class_table AS (
SELECT p_size AS company_id, p_name AS name, arg_max(p_type, p_partkey) AS category
FROM part WHERE p_retailprice >= 1000 GROUP BY ALL)
SELECT p_partkey, coalesce(category, 'None') AS category
FROM part LEFT JOIN class_table ON company_id = p_size AND name = p_name""")
def two_key_lookup_last_wins(t: Tables):
    table = t.part.where("p_retailprice >= 1000").select(
        F.col("p_size").alias("company_id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("category"), "p_partkey")
    found = look_up(t.part, table, {"p_size": "company_id", "p_name": "name"}, "category",
                    "category", default=F.lit(LOOKUP_MISS), order="p_partkey")
    return found.select("p_partkey", "category")


@query(f"""WITH {ANSWERS}, {FIELDS}, {IDEAS}
SELECT a.idea_id, f.id AS field_id, a.answer AS field_answer, f.company_id, f.title,
  i.title AS idea_name, a.updated_at
FROM answers a JOIN fields f ON f.id = a.company_form_field_id
JOIN ideas i ON i.id = a.idea_id""")
def answers_three_way(t: Tables):
    rows = forms.answers_with_fields(t.answers, t.fields, t.ideas)
    return rows.select("idea_id", "field_id", "field_answer", "company_id", "title",
                       "idea_name", without_time_zone(F.col("updated_at")).alias("updated_at"))


@query(f"""WITH {ANSWERS}, {FIELDS}, {IDEAS}, {DIM_COMPANY}
SELECT 'known' AS origin, a.idea_id, f.id AS field_id, f.company_id, f.title, i.title AS idea_name
FROM answers a JOIN fields f ON f.id = a.company_form_field_id JOIN ideas i ON i.id = a.idea_id
WHERE f.company_id IN (SELECT company_db_id FROM dim_company)
UNION ALL
SELECT 'field', NULL, id, company_id, title, NULL FROM fields""")
def per_company_union(t: Tables):
    known = forms.answers_of_companies(t.answers, t.fields, t.ideas, t.dim_company).select(
        F.lit("known").alias("origin"), "idea_id", "field_id", "company_id", "title",
        "idea_name")
    rest = t.fields.select(
        "title", "company_id", F.col("id").alias("field_id"), F.lit("field").alias("origin"))
    return known.unionByName(rest, allowMissingColumns=True)


@query(f"""WITH {IDEAS}, {TAGS}
SELECT DISTINCT t.name AS tag_name, t.description AS tag_description, t.id AS tag_id, t.tag_type,
  i.id AS idea_id, i.user_id, i.goal_id, i.is_private, i.stage, i.like_ideas_count,
  i.average_general, i.submited_at AS submitted_at
FROM ideas i LEFT JOIN (ideas_tags x JOIN tags t ON t.id = x.tag_id) ON x.idea_id = i.id""")
def tag_left_right_distinct(t: Tables):
    return forms.idea_metadata(t.ideas, t.tags, t.ideas_tags)


@query(f"""WITH {IDEAS}, {TAGS}, {ANSWERS}, metadata AS (
SELECT DISTINCT i.id AS idea_id, t.name AS tag_name, t.id AS tag_id, i.stage
FROM ideas i LEFT JOIN (ideas_tags x JOIN tags t ON t.id = x.tag_id) ON x.idea_id = i.id)
SELECT a.idea_id, a.company_form_field_id AS field_id, tag_id, tag_name, stage
FROM answers a LEFT JOIN metadata USING (idea_id)""")
def answers_with_metadata(t: Tables):
    metadata = forms.idea_metadata(t.ideas, t.tags, t.ideas_tags)
    return left_join_many(t.answers, metadata, "idea_id").select(
        "idea_id", F.col("company_form_field_id").alias("field_id"), "tag_id", "tag_name",
        "stage")


@query(f"""WITH {DIM_IDEA}
SELECT id, idea_db_id, l_suppkey AS company_id, l_partkey AS goal_id
FROM dim_idea LEFT JOIN lineitem ON l_orderkey = idea_db_id AND l_returnflag = 'A'""")
def dim_fact_left(t: Tables):
    fact = t.lineitem.where("l_returnflag = 'A'").select(
        F.col("l_orderkey").alias("idea_db_id"), F.col("l_suppkey").alias("company_id"),
        F.col("l_partkey").alias("goal_id"))
    return left_join_many(t.dim_idea, fact, "idea_db_id").select(
        "id", "idea_db_id", "company_id", "goal_id")


@query(f"""WITH {DIM_USERS}
SELECT s_suppkey, s_name, id AS user_id FROM supplier LEFT JOIN dim_users ON user_db_id = s_suppkey
""")
def diff_key_left(t: Tables):
    users = t.dim_users.withColumnRenamed("id", "user_id")
    return left_join_on(t.supplier.select("s_suppkey", "s_name"), users, "s_suppkey",
                        "user_db_id")


# Form definitions: forms are customers, their fields parts, companies nations.
FORM_TABLES = """companies AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name
  FROM nation),
forms AS (SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS company_id,
  CASE WHEN c_acctbal < 4000 THEN 1 ELSE 0 END AS form_type FROM customer),
form_fields AS (SELECT p_partkey AS id, CAST(c_nationkey AS BIGINT) AS company_id,
  CAST(p_size AS BIGINT) AS form_id, p_name AS title, p_type AS description
  FROM part JOIN customer ON c_custkey = p_size),
form_answers AS (SELECT l_orderkey AS idea_id, l_partkey AS company_form_field_id,
  l_returnflag AS answer FROM lineitem WHERE l_linestatus = 'F')"""
ONE_COMPANY = 2


def _form_tables(t: Tables):
    companies = t.nation.selectExpr("CAST(n_nationkey AS LONG) AS id", "n_name AS name")
    definitions = t.customer.selectExpr(
        "c_custkey AS id", "CAST(c_nationkey AS LONG) AS company_id",
        "CASE WHEN c_acctbal < 4000 THEN 1 ELSE 0 END AS form_type")
    fields = t.part.join(t.customer, F.col("c_custkey") == F.col("p_size")).selectExpr(
        "p_partkey AS id", "CAST(c_nationkey AS LONG) AS company_id",
        "CAST(p_size AS LONG) AS form_id", "p_name AS title", "p_type AS description")
    answers = t.lineitem.where("l_linestatus = 'F'").selectExpr(
        "l_orderkey AS idea_id", "l_partkey AS company_form_field_id",
        "l_returnflag AS answer")
    return companies, definitions, fields, answers


@query(f"""WITH {FORM_TABLES}
SELECT company_id, form_id, id AS field_id, title AS field_title, description AS field_description
FROM form_fields WHERE form_id IN (
  SELECT f.id FROM companies c JOIN forms f ON c.id = f.company_id
  JOIN form_fields x ON x.form_id = f.id
  WHERE c.id = {ONE_COMPANY} AND f.form_type = 0 AND x.company_id = c.id
    AND x.id IN (SELECT company_form_field_id FROM form_answers))""")
def nested_in_forms(t: Tables):
    return forms.forms_of_company(*_form_tables(t), company=ONE_COMPANY)


@query(f"""WITH {FORM_TABLES}, chosen AS (
SELECT company_id, form_id, id AS field_id, title AS field_title, description AS field_description
FROM form_fields WHERE form_id IN (
  SELECT f.id FROM forms f JOIN form_fields x ON x.form_id = f.id
  WHERE f.company_id = {ONE_COMPANY} AND f.form_type = 0 AND x.company_id = {ONE_COMPANY}
    AND x.id IN (SELECT company_form_field_id FROM form_answers)))
SELECT chosen.*, a.idea_id, a.answer AS field_answer FROM chosen
JOIN form_fields f ON f.id = chosen.field_id AND f.company_id = {ONE_COMPANY}
JOIN form_answers a ON a.company_form_field_id = f.id""")
def cte_forms_answers(t: Tables):
    return forms.form_answers(*_form_tables(t), company=ONE_COMPANY)


@query(f"""WITH {FORM_TABLES} SELECT id, company_id, form_id FROM form_fields
WHERE id IN (SELECT company_form_field_id FROM form_answers)""")
def answered_fields_semi(t: Tables):
    _, _, fields, answers = _form_tables(t)
    return forms.answered_fields(fields, answers).select("id", "company_id", "form_id")


@query(f"""WITH {FORM_TABLES} SELECT id, count(*) AS n_answers
FROM form_fields JOIN form_answers ON company_form_field_id = id GROUP BY id
ORDER BY n_answers, id""")
def answer_counts(t: Tables):
    _, _, fields, answers = _form_tables(t)
    return forms.answer_counts(fields, answers)


@query("""SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name,
  CAST(s_nationkey AS BIGINT) AS objectives_package_id, CAST(n_regionkey AS BIGINT) AS company_id,
  n_name AS package_name FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def two_table_inner(t: Tables):
    objectives = t.supplier.selectExpr(
        "s_suppkey AS id", "s_name AS name",
        "CAST(s_nationkey AS LONG) AS objectives_package_id")
    packages = t.nation.selectExpr(
        "CAST(n_nationkey AS LONG) AS id", "CAST(n_regionkey AS LONG) AS company_id",
        "n_name AS name", "n_name AS description", "n_regionkey AS objective_package_type")
    return forms.objectives_with_packages(objectives, packages).select(
        "id", "name", "objectives_package_id", "company_id", "package_name")


@query("""SELECT c_custkey AS id, c_name AS first_name, n_nationkey AS area_id, n_name AS area
FROM (SELECT * FROM customer WHERE c_acctbal > 9000) RIGHT JOIN nation
ON n_nationkey = c_nationkey""")
def users_of_areas(t: Tables):
    users = t.customer.where("c_acctbal > 9000").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"),
        F.col("c_nationkey").alias("area_id"))
    areas = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return forms.users_of_areas(users, areas)


@query("""SELECT c_nationkey, c_custkey, c_name FROM customer WHERE c_nationkey IN (
  SELECT DISTINCT c_nationkey FROM customer ORDER BY c_nationkey LIMIT 7)""")
def first_n_groups(t: Tables):
    return first_groups(t.customer.select("c_nationkey", "c_custkey", "c_name"),
                        ["c_nationkey"], 7)


@query("""SELECT 'head' AS part, * FROM (SELECT o_orderkey, o_totalprice FROM orders
  ORDER BY o_totalprice, o_orderkey LIMIT 100)
UNION ALL SELECT 'tail', * FROM (SELECT o_orderkey, o_totalprice FROM orders
  ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5)""")
def head_and_tail_rows(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    head = rows.orderBy("o_totalprice", "o_orderkey").limit(100)
    tail = rows.orderBy(F.desc("o_totalprice"), F.desc("o_orderkey")).limit(5)
    return head.withColumn("part", F.lit("head")).unionByName(
        tail.withColumn("part", F.lit("tail")))
