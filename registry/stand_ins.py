"""The driver tables in the shapes of the warehouse sources.

Companies are nations, users suppliers or customers, goals and tags parts, ideas orders, form
answers order lines, form fields suppliers, and embeddings the vectors of the answer texts.
The SQL texts give the same tables to the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ideamill.functions.values import day_text
from ideamill.operators.embedding import text_digest
from ideamill.settings import configure
from ideamill.sources.tables import read_table


def with_day_text(df: DataFrame, column: str = "valid_to") -> DataFrame:
    """The open end of a row as text: pandas holds no timestamp of the year 9999."""
    return df.withColumn(column, day_text(F.col(column)))


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    @property
    def dim_company(self) -> DataFrame:
        return self.nation.where("n_regionkey <> 4").selectExpr(
            "n_nationkey + 100L AS id", "CAST(n_nationkey AS LONG) AS company_db_id")

    @property
    def dim_users(self) -> DataFrame:
        return self.supplier.where("s_acctbal >= 1000").selectExpr(
            "s_suppkey + 1000 AS id", "s_suppkey AS user_db_id")

    @property
    def dim_idea(self) -> DataFrame:
        return self.orders.where("o_orderstatus <> 'P'").selectExpr(
            "o_orderkey + 5000 AS id", "o_orderkey AS idea_db_id")

    @property
    def dim_goals(self) -> DataFrame:
        return self.part.where("p_size > 10").selectExpr(
            "p_partkey + 10 AS id", "p_partkey AS goal_db_id")

    @property
    def ideas(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_orderkey AS id", "o_orderpriority AS title",
            "concat('Order of ', o_custkey) AS description", "o_custkey AS user_id",
            "o_custkey AS goal_id", "o_orderstatus = 'F' AS is_private",
            "o_orderstatus AS stage", "year(o_orderdate) AS like_ideas_count",
            "o_totalprice AS average_general",
            "CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS submited_at")

    @property
    def fields(self) -> DataFrame:
        return self.supplier.selectExpr(
            "s_suppkey AS id", "CAST(s_nationkey AS LONG) AS company_id", "s_name AS title",
            "CASE WHEN s_acctbal < 3000 THEN 'El problema' WHEN s_acctbal < 7000 THEN "
            "'Your solution' WHEN s_acctbal < 8000 THEN 'Tu nombre' ELSE '' END AS description",
            "s_suppkey AS form_field_id", "CAST(s_nationkey AS LONG) AS form_id")

    @property
    def answers(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "l_orderkey AS idea_id", "l_suppkey AS company_form_field_id",
            "CASE WHEN l_discount < 0.01 THEN '' WHEN l_discount < 0.02 THEN 'None' "
            "ELSE concat('answer ', CAST(l_quantity AS INT)) END AS answer",
            "l_shipdate AS created_at", "l_shipdate AS updated_at")

    @property
    def tags(self) -> DataFrame:
        return self.part.selectExpr(
            "p_partkey AS id", "p_name AS name", "p_brand AS description",
            "p_size AS tag_type")

    @property
    def ideas_tags(self) -> DataFrame:
        return self.lineitem.where("l_returnflag = 'R'").selectExpr(
            "l_partkey AS tag_id", "l_orderkey AS idea_id")

    @property
    def contributions(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "l_orderkey AS idea_id", "l_suppkey AS user_id").distinct()

    @property
    def text_vectors(self) -> DataFrame:
        """Vector table of the answer texts."""
        text = F.concat(F.lit("answer "), F.col("vec_id"))
        return self.embeddings.select(
            text_digest(text).alias("digest"),
            F.col("embedding").cast("array<double>").alias("vector"))


DIM_COMPANY = """dim_company AS (SELECT CAST(n_nationkey + 100 AS BIGINT) AS id,
  CAST(n_nationkey AS BIGINT) AS company_db_id
  FROM nation WHERE n_regionkey <> 4)"""
DIM_USERS = """dim_users AS (SELECT s_suppkey + 1000 AS id, s_suppkey AS user_db_id
  FROM supplier WHERE s_acctbal >= 1000)"""
DIM_IDEA = """dim_idea AS (SELECT o_orderkey + 5000 AS id, o_orderkey AS idea_db_id
  FROM orders WHERE o_orderstatus <> 'P')"""
DIM_GOALS = """dim_goals AS (SELECT p_partkey + 10 AS id, p_partkey AS goal_db_id
  FROM part WHERE p_size > 10)"""
IDEAS = """ideas AS (SELECT o_orderkey AS id, o_orderpriority AS title,
  'Order of ' || o_custkey AS description, o_custkey AS user_id, o_custkey AS goal_id,
  o_orderstatus = 'F' AS is_private, o_orderstatus AS stage,
  CAST(year(o_orderdate) AS INT) AS like_ideas_count, o_totalprice AS average_general,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS submited_at FROM orders)"""
FIELDS = """fields AS (SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS company_id,
  s_name AS title, CASE WHEN s_acctbal < 3000 THEN 'El problema' WHEN s_acctbal < 7000 THEN
  'Your solution' WHEN s_acctbal < 8000 THEN 'Tu nombre' ELSE '' END AS description,
  s_suppkey AS form_field_id, CAST(s_nationkey AS BIGINT) AS form_id FROM supplier)"""
ANSWERS = """answers AS (SELECT l_orderkey AS idea_id, l_suppkey AS company_form_field_id,
  CASE WHEN l_discount < 0.01 THEN '' WHEN l_discount < 0.02 THEN 'None'
  ELSE 'answer ' || CAST(l_quantity AS INT) END AS answer,
  l_shipdate AS created_at, l_shipdate AS updated_at FROM lineitem)"""
TAGS = """tags AS (SELECT p_partkey AS id, p_name AS name, p_brand AS description,
  p_size AS tag_type FROM part), ideas_tags AS (SELECT l_partkey AS tag_id,
  l_orderkey AS idea_id FROM lineitem WHERE l_returnflag = 'R')"""
CONTRIBUTIONS = """contributions AS (SELECT DISTINCT l_orderkey AS idea_id,
  l_suppkey AS user_id FROM lineitem)"""
