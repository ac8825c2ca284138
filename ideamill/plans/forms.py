"""Form definitions and answers: the joins around companies, forms, fields and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.operators.lookup import known_rows, left_join_many
from ideamill.operators.reshape import first_non_null


def answers_with_fields(answers: DataFrame, fields: DataFrame, ideas: DataFrame) -> DataFrame:
    """Each answer with its form field and its idea."""
    field = fields.select(
        F.col("id").alias("field_id"), "company_id", "title", "description", "form_field_id",
        "form_id")
    idea = ideas.select(
        F.col("id").alias("idea_id"), F.col("title").alias("idea_name"),
        F.col("description").alias("idea_description"))
    given = answers.select(
        "idea_id", F.col("company_form_field_id").alias("field_id"),
        F.col("answer").alias("field_answer"), "created_at", "updated_at")
    return given.join(field, "field_id").join(idea, "idea_id")


def answers_of_companies(answers: DataFrame, fields: DataFrame, ideas: DataFrame,
                         companies: DataFrame) -> DataFrame:
    """Answers of all known companies in one join; the fields are cut down first."""
    known = known_rows(fields, companies, {"company_id": "company_db_id"})
    return answers_with_fields(answers, known, ideas)


def answered_fields(fields: DataFrame, answers: DataFrame) -> DataFrame:
    """Fields with at least one answer."""
    return known_rows(fields, answers, {"id": "company_form_field_id"})


def answer_counts(fields: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers per field, the least answered first. Counted before the join."""
    counts = answers.groupBy(F.col("company_form_field_id").alias("id")).agg(
        F.count("*").alias("n_answers"))
    return fields.select("id").join(counts, "id").orderBy("n_answers", "id")


def forms_of_company(companies: DataFrame, forms: DataFrame, fields: DataFrame,
                     answers: DataFrame, company: int, form_type: int = 0) -> DataFrame:
    """All fields of the company's forms of one type that hold an answered field."""
    chosen = companies.where(F.col("id") == company)
    own = known_rows(forms.where(F.col("form_type") == form_type), chosen, {"company_id": "id"})
    used = answered_fields(known_rows(fields, chosen, {"company_id": "id"}), answers)
    with_answers = known_rows(own, used, {"id": "form_id"})
    return known_rows(fields, with_answers, {"form_id": "id"}).select(
        "company_id", "form_id", F.col("id").alias("field_id"),
        F.col("title").alias("field_title"), F.col("description").alias("field_description"))


FORM_ANSWERS = """
WITH chosen AS (
  SELECT id AS company_id FROM {companies} WHERE id = :company
), used AS (
  SELECT id, form_id FROM {fields}
  WHERE company_id IN (SELECT company_id FROM chosen)
    AND id IN (SELECT DISTINCT company_form_field_id FROM {answers})
), definition AS (
  SELECT company_id, form_id, id AS field_id, title AS field_title,
         description AS field_description
  FROM {fields}
  WHERE form_id IN (
    SELECT id FROM {forms}
    WHERE form_type = :form_type AND company_id IN (SELECT company_id FROM chosen)
      AND id IN (SELECT DISTINCT form_id FROM used))
), given AS (
  SELECT a.idea_id, f.id AS field_id, a.answer AS field_answer
  FROM {answers} a JOIN {fields} f ON a.company_form_field_id = f.id
  WHERE f.company_id = :company
)
SELECT company_id, form_id, field_id, field_title, field_description, idea_id, field_answer
FROM definition JOIN given USING (field_id)
"""


def form_answers(companies: DataFrame, forms: DataFrame, fields: DataFrame, answers: DataFrame,
                 company: int, form_type: int = 0) -> DataFrame:
    """Form definitions of a company joined with the answers given to them."""
    return companies.sparkSession.sql(
        FORM_ANSWERS, args={"company": company, "form_type": form_type}, companies=companies,
        forms=forms, fields=fields, answers=answers)


def companies_without_demos(companies: DataFrame) -> DataFrame:
    return companies.where(~F.ilike("name", F.lit("%demo%")))


def objectives_with_packages(objectives: DataFrame, packages: DataFrame) -> DataFrame:
    package = packages.select(
        F.col("id").alias("objectives_package_id"), "company_id",
        F.col("name").alias("package_name"), F.col("description").alias("package_description"),
        "objective_package_type")
    return objectives.join(package, "objectives_package_id")


def users_of_areas(users: DataFrame, areas: DataFrame) -> DataFrame:
    """Every area with its users; an area without users gives one row."""
    area = areas.select(F.col("id").alias("area_id"), F.col("name").alias("area"))
    return left_join_many(area, users, "area_id")


def _tagged(tags: DataFrame, ideas_tags: DataFrame) -> DataFrame:
    tag = tags.select(
        F.col("id").alias("tag_id"), F.col("name").alias("tag_name"),
        F.col("description").alias("tag_description"), "tag_type")
    return tag.join(ideas_tags.select("tag_id", "idea_id"), "tag_id")


def _idea_columns(ideas: DataFrame) -> DataFrame:
    return ideas.select(
        F.col("id").alias("idea_id"), "user_id", "goal_id", "is_private", "stage",
        "like_ideas_count", "average_general", F.col("submited_at").alias("submitted_at"))


def idea_metadata(ideas: DataFrame, tags: DataFrame, ideas_tags: DataFrame) -> DataFrame:
    """Ideas with their tags, one row per tag; an untagged idea keeps one row."""
    return left_join_many(_idea_columns(ideas), _tagged(tags, ideas_tags), "idea_id").distinct()


def idea_attributes(ideas: DataFrame, tags: DataFrame, ideas_tags: DataFrame) -> DataFrame:
    """One row per idea: its columns and the first value of each tag column, by tag.

    The same values as the first ones of ``idea_metadata``, but the tags are reduced before the
    join, so that neither ideas nor answers are repeated per tag.
    """
    first = first_non_null(
        _tagged(tags, ideas_tags), ["idea_id"],
        ["tag_name", "tag_description", "tag_type"], ["tag_id"])
    return _idea_columns(ideas).join(first, "idea_id", "left")
