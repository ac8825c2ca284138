"""Insert-only loads of the company, user, goal and category dimensions.

Each function gives the rows to append: unseen business keys only, with surrogate keys after the
highest loaded one. An empty source gives an empty table of the same schema.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.functions.values import company_name, day_of
from ideamill.operators.history import validity, with_default_goal
from ideamill.operators.lookup import look_up, new_records
from ideamill.operators.numbering import surrogate_keys
from ideamill.operators.reshape import keep_first


def _days(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: day_of(df, c) for c in columns})


def company_rows(source: DataFrame, loaded: DataFrame, run: date) -> DataFrame:
    """Source columns: company_db_id, company_name, status_active, created_at, updated_at."""
    new = new_records(source, loaded, "company_db_id")
    new = keep_first(new, ["company_db_id"], ["company_db_id", "updated_at"])
    named = new.withColumn("company_name", company_name(F.col("company_name")))
    rows = validity(_days(named, ["created_at", "updated_at"]), run)
    return surrogate_keys(rows, loaded, ["company_db_id"])


def user_rows(source: DataFrame, companies: DataFrame, loaded: DataFrame, run: date
              ) -> DataFrame:
    """Source columns: user_db_id, company_db_id, name, ..., created_at, updated_at."""
    new = new_records(source, loaded, "user_db_id")
    new = keep_first(new, ["user_db_id"], ["user_db_id", "updated_at"])
    found = look_up(new, companies, {"company_db_id": "company_db_id"}, "id", "company_id")
    rows = _days(found.drop("company_db_id"), ["created_at", "updated_at"])
    return surrogate_keys(
        validity(rows.withColumn("country", F.lit("")), run), loaded, ["user_db_id"])


def goal_rows(source: DataFrame, companies: DataFrame, loaded: DataFrame, run: date,
              default_member: bool = False) -> DataFrame:
    """Source columns: goal_db_id, company_id (business key), goal_name, ..., updated_at.

    With ``default_member`` the load that finds no member 'no goal' adds it.
    """
    new = new_records(source, loaded, "goal_db_id")
    new = keep_first(new, ["goal_db_id"], ["goal_db_id", "updated_at"])
    found = look_up(new, companies, {"company_id": "company_db_id"}, "id", "_company")
    named = found.withColumn("company_id", F.col("_company")).drop("_company")
    rows = validity(_days(named, ["end_campaign", "created_at", "updated_at"]), run)
    if default_member:
        rows = new_records(with_default_goal(rows), loaded, "goal_db_id")
    return surrogate_keys(rows, loaded, ["goal_db_id"])


def category_rows(source: DataFrame, companies: DataFrame, loaded: DataFrame) -> DataFrame:
    """Categories of known companies; source columns: id, name, description, id_company, status."""
    renamed = source.withColumnsRenamed({
        "id": "id_category_db", "name": "category_name", "description": "category_description",
        "id_company": "company_id", "status": "status_active"})
    new = keep_first(new_records(renamed, loaded, "id_category_db"),
                     ["id_category_db"], ["id_category_db", "company_id"])
    found = look_up(new, companies, {"company_id": "company_db_id"}, "id", "_company")
    known = found.where("_company IS NOT NULL")
    return surrogate_keys(
        known.withColumn("company_id", F.col("_company")).drop("_company"), loaded,
        ["id_category_db"])


def tag_rows(source: DataFrame, companies: DataFrame, ideas: DataFrame, loaded: DataFrame
             ) -> DataFrame:
    """Idea tags with warehouse keys of idea and company; unknown keys stay NULL."""
    renamed = source.withColumnsRenamed({
        "id": "id_idea_tag_db", "name": "tag_name", "description": "tag_description"})
    new = keep_first(new_records(renamed, loaded, "id_idea_tag_db"),
                     ["id_idea_tag_db"], ["id_idea_tag_db"])
    with_idea = look_up(new, ideas, {"idea_id": "idea_db_id"}, "id", "_idea")
    with_both = look_up(with_idea, companies, {"company_id": "company_db_id"}, "id", "_company")
    return surrogate_keys(
        with_both.withColumns({"idea_id": F.col("_idea"), "company_id": F.col("_company")})
        .drop("_idea", "_company"), loaded, ["id_idea_tag_db"])
