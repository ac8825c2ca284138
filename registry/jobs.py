"""Queries that run the end-to-end jobs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ideamill import schemas
from ideamill.operators.embedding import (
    attach_vectors, classify_fields, embed_texts, text_digest, unseen_texts,
)
from ideamill.operators.labels import chunk_texts, live_answers
from ideamill.operators.lookup import look_up, new_records
from ideamill.operators.numbering import surrogate_keys
from ideamill.plans import clusters, dimensions, export, facts, ideas
from ideamill.plans.forms import idea_attributes
from ideamill.settings import scratch_path
from ideamill.sources.tables import write_records, written
from ideamill.sources.vector_table import read_vectors, upsert_vectors
from ideamill.streaming.incremental import (
    BATCH_COLUMNS, Target, load_stream, load_targets, read_landing, visible_rows,
)
from registry.base import new_registry
from registry.stand_ins import (
    ANSWERS, CONTRIBUTIONS, DIM_COMPANY, DIM_GOALS, DIM_IDEA, DIM_USERS, FIELDS, IDEAS, TAGS,
    Tables, with_day_text,
)

QUERIES, ORACLES, query = new_registry()

RUN = datetime(2024, 5, 1)
HISTORY = """TIMESTAMP '2024-05-01' AS valid_from, '9999-12-31' AS valid_to,
  true AS is_current"""
SQL_MS = "CAST(round({}) AS BIGINT) * 100000000"


def _empty(t: Tables, schema: str):
    return t.spark.createDataFrame([], schema)


def _companies(t: Tables):
    ms = F.round("s_acctbal").cast("long") * 100_000_000
    return t.supplier.select(
        F.col("s_suppkey").alias("company_db_id"),
        F.when(F.col("s_acctbal") > 1000, F.col("s_name")).alias("company_name"),
        (F.col("s_acctbal") > 0).alias("status_active"), ms.alias("created_at"),
        (ms + 86_400_000).alias("updated_at"))


def _loaded_companies(t: Tables):
    return t.supplier.where("s_nationkey < 5").selectExpr(
        "s_suppkey + 1 AS id", "s_suppkey AS company_db_id")


SQL_COMPANIES = f"""loaded AS (SELECT s_suppkey + 1 AS id, s_suppkey AS company_db_id
  FROM supplier WHERE s_nationkey < 5),
rows AS (SELECT s_suppkey AS company_db_id, s_acctbal > 1000 AS has_name,
  CASE WHEN s_acctbal > 1000 THEN s_name ELSE 'Sin nombre' END AS company_name,
  s_acctbal > 0 AS status_active,
  CAST(epoch_ms({SQL_MS.format('s_acctbal')}) AS DATE) AS created_at,
  CAST(epoch_ms({SQL_MS.format('s_acctbal')} + 86400000) AS DATE) AS updated_at,
  {HISTORY} FROM supplier)"""


@query(f"""WITH {SQL_COMPANIES}
SELECT (SELECT max(id) FROM loaded) + row_number() OVER (ORDER BY company_db_id) AS id,
  rows.* EXCLUDE (has_name)
FROM rows WHERE company_db_id NOT IN (SELECT company_db_id FROM loaded)""")
def dimension_companies(t: Tables):
    return with_day_text(dimensions.company_rows(_companies(t), _loaded_companies(t), RUN))


@query(f"""WITH {DIM_COMPANY} SELECT row_number() OVER (ORDER BY c_custkey) AS id,
  c_custkey AS user_db_id, c_name AS name, d.id AS company_id, c_mktsegment AS contract_profile,
  CAST(epoch_ms({SQL_MS.format('abs(c_acctbal)')}) AS DATE) AS created_at,
  CAST(epoch_ms({SQL_MS.format('abs(c_acctbal)')}) AS DATE) AS updated_at, '' AS country, {HISTORY}
FROM customer LEFT JOIN dim_company d ON company_db_id = c_nationkey""")
def dimension_users(t: Tables):
    ms = F.round(F.abs("c_acctbal")).cast("long") * 100_000_000
    source = t.customer.select(
        F.col("c_custkey").alias("user_db_id"),
        F.col("c_nationkey").cast("long").alias("company_db_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("contract_profile"), ms.alias("created_at"),
        ms.alias("updated_at"))
    return with_day_text(dimensions.user_rows(
        source, t.dim_company, _empty(t, "id long, user_db_id long"), RUN))


@query(f"""WITH {DIM_COMPANY} SELECT (SELECT max(p_partkey) + 7 FROM part WHERE p_size > 45)
  + row_number() OVER (ORDER BY p_partkey) AS id, p_partkey AS goal_db_id, d.id AS company_id,
  p_name AS goal_name, p_type AS goal_description, p_size > 5 AS active,
  CAST(epoch_ms({SQL_MS.format('p_retailprice')}) AS DATE) AS end_campaign,
  DATE '2020-03-04' AS created_at, CAST(NULL AS DATE) AS updated_at, {HISTORY}
FROM part LEFT JOIN dim_company d ON company_db_id = p_size WHERE p_size <= 45""")
def dimension_goals(t: Tables):
    source = t.part.select(
        F.col("p_partkey").alias("goal_db_id"), F.col("p_size").cast("long").alias("company_id"),
        F.col("p_name").alias("goal_name"), F.col("p_type").alias("goal_description"),
        (F.col("p_size") > 5).alias("active"),
        (F.round("p_retailprice").cast("long") * 100_000_000).alias("end_campaign"),
        F.lit("2020-03-04 05:06:07").alias("created_at"), F.lit("no date").alias("updated_at"))
    loaded = t.part.where("p_size > 45").selectExpr(
        "p_partkey + 7 AS id", "p_partkey AS goal_db_id")
    return with_day_text(dimensions.goal_rows(source, t.dim_company, loaded, RUN))


@query(f"""WITH {DIM_COMPANY}, goals AS (SELECT p_partkey + 1 AS goal_db_id, d.id AS company_id, p_name AS goal_name,
  p_size > 5 AS active, DATE '2020-03-04' AS created_at, {HISTORY} FROM part LEFT JOIN dim_company d ON company_db_id = p_size
UNION ALL SELECT 0, NULL, 'Sin meta', true, DATE '2021-01-01', TIMESTAMP '2021-01-01', '9999-12-31', true)
SELECT row_number() OVER (ORDER BY goal_db_id) AS id, * FROM goals""")
def dimension_goals_with_default(t: Tables):
    """The first load adds the member 'no goal'; the second finds it and all goals loaded."""
    source = t.part.select(
        (F.col("p_partkey") + 1).alias("goal_db_id"), F.col("p_size").cast("long").alias("company_id"),
        F.col("p_name").alias("goal_name"), (F.col("p_size") > 5).alias("active"),
        F.lit(None).cast("long").alias("end_campaign"), F.lit("2020-03-04 05:06:07").alias("created_at"),
        F.lit(None).cast("long").alias("updated_at"))
    rows = written(dimensions.goal_rows(
        source, t.dim_company, _empty(t, "id long, goal_db_id long"), RUN, default_member=True), "goals")
    again = dimensions.goal_rows(source, t.dim_company, rows, RUN, default_member=True)
    return with_day_text(rows.unionByName(again)).drop("end_campaign", "updated_at")


@query(f"""WITH {DIM_COMPANY} SELECT row_number() OVER (ORDER BY c_custkey) AS id,
  c_custkey AS id_category_db, c_mktsegment AS category_name, c_name AS category_description,
  d.id AS company_id, c_acctbal > 0 AS status_active
FROM customer JOIN dim_company d ON company_db_id = c_nationkey""")
def dimension_categories(t: Tables):
    source = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"),
        F.col("c_name").alias("description"),
        F.col("c_nationkey").cast("long").alias("id_company"),
        (F.col("c_acctbal") > 0).alias("status"))
    return dimensions.category_rows(
        source, t.dim_company, _empty(t, "id long, id_category_db long"))


@query(f"""WITH {DIM_COMPANY}, {DIM_IDEA}, tags AS (SELECT l_orderkey, min(l_suppkey) AS supp
  FROM lineitem GROUP BY l_orderkey)
SELECT row_number() OVER (ORDER BY l_orderkey) AS id, l_orderkey AS id_idea_tag_db,
  'Tag ' || supp AS tag_name, i.id AS idea_id, c.id AS company_id
FROM tags LEFT JOIN dim_idea i ON idea_db_id = l_orderkey
LEFT JOIN dim_company c ON company_db_id = supp""")
def idea_tag_rows(t: Tables):
    source = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("company_id")).select(
        F.col("l_orderkey").alias("id"), F.concat(F.lit("Tag "), "company_id").alias("name"),
        F.col("l_orderkey").alias("idea_id"), "company_id")
    return dimensions.tag_rows(source, t.dim_company, t.dim_idea,
                               _empty(t, "id long, id_idea_tag_db long"))


SQL_CLASSES = f"""{FIELDS}, {ANSWERS}, {IDEAS}, {DIM_COMPANY}, named AS (
SELECT f.company_id, f.id AS field_id, f.title AS name, f.description,
  CASE WHEN description = 'El problema' THEN 'Problem' WHEN description = 'Your solution'
    THEN 'Solution' WHEN description = 'Tu nombre' THEN 'Idea name' ELSE 'Other' END AS category
FROM fields f WHERE f.company_id IN (SELECT company_db_id FROM dim_company)
  AND f.id IN (SELECT company_form_field_id FROM answers JOIN ideas ON ideas.id = idea_id)),
class_table AS (SELECT row_number() OVER (ORDER BY company_id, field_id) AS id,
  company_id, field_id, name, description, category || CASE WHEN category IN ('Problem',
    'Solution') THEN ' ' || row_number() OVER (PARTITION BY company_id, category
    ORDER BY field_id) ELSE '' END AS category FROM named)"""


def _landed_answers(t: Tables):
    """The cleaned answers, landed as a table for the jobs that follow."""
    return written(ideas.new_answers(t.answers, t.fields, t.ideas, t.dim_company,
                                     _empty(t, "idea_db_id long")), "answers")


def _class_table(t: Tables, answers):
    return ideas.class_table_rows(answers, _empty(t, schemas.PARAM_CLASS_TABLE))


@query(f"WITH {SQL_CLASSES} SELECT * FROM class_table")
def field_classification(t: Tables):
    return _class_table(t, _landed_answers(t))


@query("""SELECT p_partkey AS field_id, CAST(p_size AS BIGINT) AS company_id,
  p_name AS name, p_type AS description,
  CASE p_type WHEN 'STANDARD' THEN 'Problem' WHEN 'ECONOMY' THEN 'Solution' ELSE 'Other' END ||
  CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN ' ' || row_number() OVER (
    PARTITION BY p_size, p_type ORDER BY p_partkey) ELSE '' END AS category FROM part""")
def field_classification_by_model(t: Tables):
    """The caller's column function stands for the model and answers in whole sentences."""
    def model(title, description):
        return F.concat(F.lit("The category is "), F.when(description == "STANDARD", "Problem")
                        .when(description == "ECONOMY", "Solution").otherwise("Other"))

    answers = t.part.select(
        F.col("p_size").cast("long").alias("company_id"), F.col("p_partkey").alias("field_id"),
        F.col("p_name").alias("title"), F.col("p_type").alias("description"))
    return classify_fields(answers, ["field_id"], model)


@query(f"""WITH {ANSWERS}, distinct_texts AS (SELECT DISTINCT answer FROM answers
  WHERE trim(answer) NOT IN ('', 'None')),
known AS (SELECT 'answer ' || vec_id AS answer, round(embedding[1]::DOUBLE, 6) AS first
  FROM embeddings WHERE label < 5),
embedded AS (SELECT answer, coalesce(first, CAST(length(answer) AS DOUBLE)) AS first
  FROM distinct_texts LEFT JOIN known USING (answer))
SELECT a.idea_id, a.company_form_field_id AS field_id, e.first
FROM answers a LEFT JOIN embedded e USING (answer)""")
def embedding_attach(t: Tables):
    """The texts of half of the labels have no vector yet and get one from the caller."""
    cache = new_records(t.text_vectors, t.embeddings.where("label >= 5").select(
        text_digest(F.concat(F.lit("answer "), F.col("vec_id"))).alias("digest")), "digest")
    new = unseen_texts(t.answers, "answer", cache)
    made = embed_texts(new, lambda text: F.array_repeat(F.length(text).cast("double"), 64))
    table = written(cache.unionByName(made), "vectors")
    rows = attach_vectors(t.answers, "answer", table, "vector")
    return rows.select("idea_id", F.col("company_form_field_id").alias("field_id"),
                       F.round(F.get("vector", F.lit(0)), 6).alias("first"))


def _wide_sql() -> str:
    """The wide idea rows: per idea the first value of each category, moved left."""
    def first(value: str, test: str = "true") -> str:
        tie = "answer" if value == "vector" else value
        return (f"arg_min({value}, {{'a': field_id, 'b': {tie}}}) "
                f"FILTER ({value} IS NOT NULL AND {test})")

    def family(kind: str, value: str) -> str:
        items = ", ".join(first(value, f"category = '{kind} {i}'") for i in range(1, 7))
        drop = "x IS NOT NULL AND x NOT IN ('', 'None')" if value == "answer" else "x IS NOT NULL"
        return f"list_filter([{items}], lambda x: {drop})"

    clean = "CASE WHEN {0} NOT IN ('', 'None') THEN {0} END"
    return f"""{SQL_CLASSES}, {TAGS}, {DIM_GOALS},
given AS (SELECT a.idea_id, f.id AS field_id, f.company_id, a.answer, a.created_at, a.updated_at,
  i.title AS name, coalesce(c.category, 'None') AS category, e.embedding::DOUBLE[] AS vector
FROM answers a JOIN fields f ON f.id = a.company_form_field_id JOIN ideas i ON i.id = a.idea_id
LEFT JOIN (SELECT company_id, name, arg_max(category, id) AS category FROM class_table
  GROUP BY ALL) c ON c.company_id = f.company_id AND c.name = f.title
LEFT JOIN embeddings e ON a.answer = 'answer ' || e.vec_id
WHERE f.company_id IN (SELECT company_id FROM class_table)),
grouped AS (SELECT idea_id, {family('Problem', 'answer')} AS problems,
  {family('Solution', 'answer')} AS solutions, {family('Problem', 'vector')} AS problem_vectors,
  {family('Solution', 'vector')} AS solution_vectors,
  {first('vector', "category = 'Idea name'")} AS name_vector,
  {first('company_id')} AS company_id, {first('name')} AS name, {first('answer')} AS description,
  {first('category')} AS category, {first('created_at')} AS created_at,
  {first('updated_at')} AS updated_at
FROM given WHERE category NOT IN ('Other', 'None', 'Category: Other') GROUP BY idea_id),
tagged AS (SELECT idea_id, arg_min(name, id) AS tag_name, arg_min(description, id) AS tag_description,
  arg_min(tag_type, id) AS tag_type
  FROM ideas_tags JOIN tags ON id = tag_id GROUP BY idea_id),
wide AS (SELECT g.* REPLACE ({clean.format('g.description')} AS description), t.tag_name,
  t.tag_description, t.tag_type, i.goal_id, i.stage, i.is_private, i.like_ideas_count, i.average_general,
  i.submited_at AS submitted_at
FROM grouped g JOIN ideas i ON i.id = g.idea_id LEFT JOIN tagged t ON t.idea_id = g.idea_id)"""


@query(f"""WITH {_wide_sql()}
SELECT row_number() OVER (ORDER BY idea_id) AS id, idea_id AS idea_db_id, tag_name, tag_description,
  tag_type, category, stage, is_private, like_ideas_count, average_general, name, description,
  {", ".join(f"problems[{i}] AS problem_{i}, solutions[{i}] AS solution_{i}" for i in range(1, 7))},
  {", ".join(f"round(list_sum(problem_vectors[{i}]), 4) AS prob_{i}_embedded, "
             f"round(list_sum(solution_vectors[{i}]), 4) AS sol_{i}_embedded" for i in range(1, 7))},
  round(list_sum(name_vector), 4) AS name_embedded, created_at, updated_at,
  TIMESTAMP '2024-05-01' AS valid_from, TIMESTAMP '2262-04-11 23:47:16.854775' AS valid_to,
  true AS is_current FROM wide""")
def ideas_wide(t: Tables):
    """All columns of the dimension; of each vector the total of its values."""
    wide = written(_wide(t, t.text_vectors), "wide")
    dimension = ideas.idea_dimension_rows(
        ideas.with_vectors(wide, t.text_vectors), _empty(t, "id long, idea_db_id long"), RUN)
    return dimension.withColumns({
        c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 4) for c in schemas.VECTOR_COLUMNS})


def _wide(t: Tables, vectors):
    answers = _landed_answers(t)
    return ideas.wide_ideas(
        ideas.categorised_answers(answers, _class_table(t, answers)), vectors,
        idea_attributes(t.ideas, t.tags, t.ideas_tags))


@query(f"""WITH {_wide_sql()}
SELECT idea_id AS idea_db_id, coalesce(c.id, 0) AS company_id, coalesce(g.id, 0) AS goal_id,
  coalesce(submitted_at, TIMESTAMP '2262-04-11 23:47:16.854775') AS submitted_at
FROM wide LEFT JOIN dim_company c ON c.company_db_id = company_id
LEFT JOIN dim_goals g ON g.goal_db_id = goal_id""")
def submission_stage(t: Tables):
    """No vector is looked up for the stage, and the wide rows shrink to its columns."""
    return ideas.submission_stage(_wide(t, None), t.dim_company, t.dim_goals)


SQL_FACT = f"""{DIM_IDEA}, {DIM_USERS}, {CONTRIBUTIONS},
ranked AS (SELECT idea_id AS idea_db_id, id AS user_key,
  row_number() OVER (PARTITION BY idea_id ORDER BY user_id) AS user_num
  FROM contributions LEFT JOIN dim_users ON user_db_id = user_id),
wide AS (SELECT idea_db_id,
  {", ".join(f"max(user_key) FILTER (user_num = {i}) AS user_id_{i}" for i in range(1, 5))},
  '{{' || coalesce(string_agg('"user_id_' || user_num || '":' || user_key, ',' ORDER BY user_num)
    FILTER (user_key IS NOT NULL), '') || '}}' AS users FROM ranked GROUP BY idea_db_id),
fact AS (SELECT d.id AS idea_id, o_custkey AS company_id,
  {", ".join(f"coalesce(user_id_{i}, 0) AS user_id_{i}" for i in range(1, 5))}, users,
  CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_custkey END AS goal_id,
  CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '1900-01-01' ELSE o_orderdate END AS submitted_at
FROM orders JOIN dim_idea d ON d.idea_db_id = o_orderkey
LEFT JOIN wide w ON w.idea_db_id = o_orderkey)"""


def _fact(t: Tables, **bounds):
    stage = t.orders.select(
        F.col("o_orderkey").alias("idea_db_id"), F.col("o_custkey").alias("company_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("goal_id"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("submitted_at"))
    return facts.submission_fact(stage, t.contributions, t.dim_users, t.dim_idea, **bounds)


@query(f"WITH {SQL_FACT} SELECT * FROM fact")
def submission_fact(t: Tables):
    return _fact(t)


@query(f"""WITH {SQL_FACT}, loaded AS (SELECT idea_id, idea_id - 5000 AS id FROM fact
  WHERE submitted_at >= TIMESTAMP '1996-01-01')
SELECT (SELECT max(id) FROM loaded) + row_number() OVER (ORDER BY idea_id) AS id, *
FROM fact WHERE idea_id NOT IN (SELECT idea_id FROM loaded)""")
def submission_append(t: Tables):
    """The load run again: submissions since 1996 are in the fact already."""
    fact = _fact(t)
    loaded = fact.where("submitted_at >= TIMESTAMP '1996-01-01'").selectExpr(
        "idea_id - 5000 AS id", "idea_id")
    return facts.submission_rows(fact, loaded)


def _vector_ideas(t: Tables):
    """Embeddings as ideas with two vectors, and their submissions."""
    vector = F.col("embedding").cast("array<double>")
    dim_idea = t.embeddings.select(
        F.col("vec_id").alias("id"), (F.col("vec_id") + 100).alias("idea_db_id"),
        F.concat(F.lit("Idea "), "vec_id").alias("name"), F.lit("Text").alias("description"),
        F.when(F.col("label") > 4, F.lit("Solve it")).alias("solution_1"),
        F.when(F.col("label") != 9, vector).alias("name_embedded"),
        F.when(F.col("label") < 5, F.reverse(vector)).alias("sol_1_embedded"))
    fact = t.embeddings.select(
        F.col("vec_id").alias("idea_id"), (F.col("label") + 100).cast("long")
        .alias("company_id"), (F.col("vec_id") + 10).alias("goal_id"))
    return dim_idea, fact, ["name_embedded", "sol_1_embedded"]


def _records(t: Tables, exported):
    dim_idea, fact, columns = _vector_ideas(t)
    found = export.idea_vectors(dim_idea, fact, 64, columns=columns)
    records = export.vector_records(found, t.dim_company, t.dim_goals, exported)
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return records.select(
        "id", "metadata.*", "batch_no", F.round(F.get("values", F.lit(0)), 6).alias("first"),
        F.round(total, 4).alias("total"))


SQL_RECORDS = f"""{DIM_COMPANY}, {DIM_GOALS}, means AS (SELECT vec_id, label,
  CASE WHEN label < 5 THEN list_transform(list_zip(embedding::DOUBLE[],
    list_reverse(embedding::DOUBLE[])), lambda p: (p[1] + p[2]) / 2)
  ELSE embedding::DOUBLE[] END AS m FROM embeddings WHERE label <> 9),
records AS (SELECT CAST(vec_id + 100 AS VARCHAR) AS id, vec_id + 100 AS idea_db_id,
  CAST(company_db_id AS BIGINT) AS company_db_id, goal_db_id, round(m[1], 6) AS first,
  round(list_sum(m), 4) AS total
FROM means LEFT JOIN dim_company c ON c.id = label + 100
LEFT JOIN dim_goals g ON g.id = vec_id + 10)"""


@query(f"""WITH {SQL_RECORDS} SELECT *,
  (row_number() OVER (ORDER BY idea_db_id) - 1) // 100 AS batch_no FROM records""")
def vector_export(t: Tables):
    return _records(t, _empty(t, "id string"))


@query(f"""WITH {SQL_RECORDS} SELECT *,
  (row_number() OVER (ORDER BY idea_db_id) - 1) // 100 AS batch_no FROM records
WHERE id NOT IN (SELECT CAST(vec_id + 100 AS VARCHAR) FROM embeddings WHERE label = 2)""")
def vector_export_new(t: Tables):
    exported = t.embeddings.where("label = 2").select(
        (F.col("vec_id") + 100).cast("string").alias("id"))
    return _records(t, exported)


@query("""SELECT CAST(vec_id AS VARCHAR) AS id, label = 2 AS is_changed, round(list_sum(embedding::DOUBLE[]) *
  CASE WHEN label = 2 THEN 2 ELSE 1 END, 4) AS total FROM embeddings""")
def vector_upsert(t: Tables):
    """Two exports into the keyed vector table: the second has changed vectors of one label and all of another."""
    path = scratch_path(t.spark, "vector-table")
    vector = F.col("embedding").cast("array<double>")
    records = t.embeddings.select(
        F.col("vec_id").cast("string").alias("id"), "label", vector.alias("values"), F.lit(False).alias("is_changed"))
    upsert_vectors(records.where("label <> 4").drop("label"), path, buckets=16)
    changed = records.where("label IN (2, 4)").withColumns({
        "values": F.when(F.col("label") == 2, F.transform("values", lambda v: v * 2)).otherwise(F.col("values")),
        "is_changed": F.col("label") == 2})
    upsert_vectors(changed.drop("label"), path, buckets=16)
    found = read_vectors(t.spark, path, "id string, values array<double>, is_changed boolean")
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return found.select("id", "is_changed", F.round(total, 4).alias("total"))


def _clusters_labelled(t: Tables):
    dim_idea, fact, columns = _vector_ideas(t)
    loaded = _empty(t, schemas.PARAM_CLUSTERED_IDEAS)
    found = clusters.clustered_ideas(dim_idea, fact, loaded, 64, columns=columns)
    chunked = clusters.ideas_to_label(found)

    def model(prompt: str) -> str:
        import json
        import re

        ideas = [{"index": int(i), "idea_name": "New " + n, "idea_description": "Short"}
                 for i, n in re.findall(r"'index': (\d+), 'idea_name': ([^,]*)", prompt)]
        name = "Group after another" if prompt.startswith("After") else "First group"
        return json.dumps({"ideas": ideas, "cluster_name": name, "cluster_description": "Text"})

    def read_label(answer: str) -> tuple[str, str]:
        import json

        read = json.loads(answer)
        return read["cluster_name"], read["cluster_description"]

    answers = live_answers(
        chunk_texts(chunked, clusters.GROUP), clusters.GROUP, "Name:\n{ideas}",
        "After {cluster_name} ({cluster_description}):\n{ideas}", model, read_label)
    return clusters.labelled_rows(chunked, answers, dim_idea, loaded)


@query()
def clusters_labelled(t: Tables):
    """Cluster the ideas of each company and label every chunk by a function of its prompt."""
    return _clusters_labelled(t)


@query("""SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id AS idea_id,
  vec_id + 100 AS idea_db_id, CAST(label + 100 AS BIGINT) AS company_id, vec_id + 10 AS goal_id,
  'New Idea ' || vec_id AS idea_c_name, 'Short' AS idea_c_description, 'Text'
    AS cluster_description FROM embeddings WHERE label <> 9""")
def clusters_labelled_ideas(t: Tables):
    """The part of the labelled ideas that does not depend on the cluster they fell into."""
    return _clusters_labelled(t).drop(
        "cluster_number", "distance_centroid", "cluster_name", "final_cluster_name")


@query(f"""WITH {SQL_COMPANIES}
SELECT row_number() OVER (ORDER BY has_name DESC, company_db_id) AS id,
  rows.* EXCLUDE (has_name), CAST(CASE WHEN has_name THEN 0 ELSE 1 END AS BIGINT) AS load_batch
FROM rows""")
def stream_incremental_load(t: Tables):
    """Land two files, load them as a stream, land the first one again, load again."""
    landing, target = scratch_path(t.spark, "landing"), scratch_path(t.spark, "dim_company")
    checkpoint = scratch_path(t.spark, "progress")
    schema = ("id long, company_db_id long, company_name string, status_active boolean, "
              "created_at date, updated_at date, " + schemas.HISTORY)

    def load():
        stream = read_landing(t.spark, f"{landing}/*", schemas.RAW_COMPANY)
        load_stream(stream, target, schema, checkpoint, lambda batch, loaded:
                    dimensions.company_rows(batch, loaded, RUN)).awaitTermination()

    source = _companies(t)
    for day, rows in enumerate([
        source.where("company_name IS NOT NULL"), source.where("company_name IS NULL"),
        source.where("company_name IS NOT NULL"),
    ]):
        write_records(rows, landing, date(2024, 5, 1 + day))
        load()
    return with_day_text(t.spark.read.schema(f"{schema}, {BATCH_COLUMNS}").parquet(target).drop("load_run"))


@query("""SELECT row_number() OVER (ORDER BY n_regionkey >= 3, n_nationkey) AS id, CAST(n_nationkey AS BIGINT)
  AS company_db_id, CAST(n_regionkey + 1 AS BIGINT) AS region_id, r_name AS region_name
FROM nation JOIN region ON r_regionkey = n_regionkey""")
def stream_two_targets(t: Tables):
    """Two landings, each loaded into a region dimension and a company dimension that holds its keys."""
    landing, manifest, checkpoint = (scratch_path(t.spark, n) for n in ("landing", "manifest", "progress"))
    schema = "company_db_id long, region_db_id long, region_name string"

    def regions(batch, loaded):
        new = new_records(batch.select("region_db_id", "region_name").distinct(), loaded["regions"], "region_db_id")
        return surrogate_keys(new, loaded["regions"], ["region_db_id"])

    def companies(batch, loaded):
        new = new_records(batch, loaded["companies"], "company_db_id")
        keyed = look_up(new, loaded["regions"], {"region_db_id": "region_db_id"}, "id", "region_id")
        return surrogate_keys(keyed.select("company_db_id", "region_id"), loaded["companies"], ["company_db_id"])

    targets = {
        "regions": Target(scratch_path(t.spark, "regions"), "id long, region_db_id long, region_name string", regions),
        "companies": Target(scratch_path(t.spark, "companies"), "id long, company_db_id long, region_id long", companies)}
    source = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("company_db_id"), F.col("n_regionkey").cast("long").alias("region_db_id"),
        F.col("r_name").alias("region_name"))
    for day, rows in enumerate([source.where("region_db_id < 3"), source]):
        write_records(rows, landing, date(2024, 5, 1 + day))
        load_targets(read_landing(t.spark, f"{landing}/*", schema), targets, manifest, checkpoint).awaitTermination()
    found = visible_rows(t.spark, targets["companies"], manifest).drop("load_run", "load_batch")
    return look_up(found, visible_rows(t.spark, targets["regions"], manifest), {"region_id": "id"}, "region_name", "region_name",
                   unique=True)
