"""Queries on text cleaning, dates, prompts, model answers and file round trips."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ideamill.functions.text import (
    category_in, fill_template, flatten_label_ideas, keep_listed, keep_listed_columns,
    newline_to_space, parse_keyed_answer, parse_label_answer, prompt_text, strip_fences,
)
from ideamill.functions.values import (
    company_name, day_text, epoch_ms_to_date, field_description, part_after, text_to_date,
    timestamp_or, word_at,
)
from ideamill.operators.labels import (
    chunk_ideas, chunk_texts, description_or_solution, label_ideas, long_text_line, prompts,
)
from ideamill.settings import NULL_SUBMIT_TIMESTAMP, scratch_path
from ideamill.sources.tables import (
    append_rows, read_query, read_records, read_sheet, read_table, write_records, write_sheet,
    write_stage,
)
from registry.base import new_registry
from registry.stand_ins import Tables

QUERIES, ORACLES, query = new_registry()

# The white space that is collapsed, in the notation of the SQL engine.
SQL_SPACE = (r"[\t\n\v\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
             r"\x{202f}\x{205f}\x{3000}]+")
SQL_LINE = (f"substr(replace(replace(trim(regexp_replace(text, '{SQL_SPACE}', ' ', 'g')), '\"', "
            "''), '''', ''), 1, 800)")


@query(r"""SELECT doc_id, regexp_replace(text, '[^\x09\x0A\x0D\x20-\x7EÁÉÍÓÚáéíóú]', '', 'g')
  AS text, regexp_replace(source, '[^\x09\x0A\x0D\x20-\x7EÁÉÍÓÚáéíóú]', '', 'g') AS source
FROM documents""")
def keep_list_clean(t: Tables):
    return keep_listed_columns(t.documents.select("doc_id", "text", "source"))


@query(r"""SELECT conv_id, turn, regexp_replace(text, '[^\x09\x0A\x0D\x20-\x7EÁÉÍÓÚáéíóúñçèê]',
  '', 'g') AS text FROM conversations""")
def keep_list_with_more(t: Tables):
    return t.conversations.select(
        "conv_id", "turn", keep_listed(F.col("text"), "ñçèê").alias("text"))


@query(f"""SELECT doc_id, {SQL_LINE} AS line, substr(trim(regexp_replace(text, '{SQL_SPACE}', ' ',
  'g')), 1, 500) AS short, CASE WHEN lang = 'en' THEN 'No data' ELSE {SQL_LINE} END AS described
FROM documents""")
def prompt_text_clean(t: Tables):
    text = F.col("text")
    return t.documents.select(
        "doc_id", prompt_text(text).alias("line"),
        prompt_text(text, 500, drop_quotes=False).alias("short"),
        prompt_text(F.when(F.col("lang") != "en", text)).alias("described"))


@query("SELECT conv_id, turn, replace(text, chr(10), ' ') AS text FROM conversations")
def newline_as_space(t: Tables):
    return t.conversations.select("conv_id", "turn", newline_to_space(F.col("text")).alias("text"))


ANSWER_OF_PART = """CASE WHEN p_size < 10 THEN 'Category: Problem' WHEN p_size < 20 THEN
  'The Solution to the Problem' WHEN p_size < 30 THEN 'Idea name' WHEN p_size < 40 THEN
  'Category: Other' ELSE p_name END"""


@query(f"""SELECT p_partkey, CASE WHEN p_size < 20 THEN 'Problem' WHEN p_size < 30 THEN 'Idea name'
  WHEN p_size < 40 THEN 'Other' ELSE p_name END AS category FROM part""")
def category_extract(t: Tables):
    return t.part.select("p_partkey", category_in(F.expr(ANSWER_OF_PART)).alias("category"))


@query("""SELECT s_suppkey, CASE WHEN CAST(round(s_acctbal * 100) AS BIGINT) * 10000000
    BETWEEN -9223372036854 AND 9223372036854 THEN
  CAST(epoch_ms(CAST(round(s_acctbal * 100) AS BIGINT) * 10000000) AS DATE) END AS created_at,
  CASE WHEN s_nationkey > 5 THEN DATE '2023-02-17' END AS parsed_at FROM supplier""")
def epoch_ms_to_day(t: Tables):
    ms = F.round(F.col("s_acctbal") * 100).cast("long") * 10_000_000
    text = F.when(F.col("s_nationkey") > 5, F.lit("2023-02-17 10:11:12")).otherwise(
        F.concat(F.lit("not a day "), F.col("s_name")))
    return t.supplier.select("s_suppkey", epoch_ms_to_date(ms).alias("created_at"),
                             text_to_date(text).alias("parsed_at"))


@query("""SELECT page_id, CASE WHEN url LIKE '%.com/%' THEN regexp_extract(url, '.*\\.com/(.*)$', 1)
  ELSE url END AS key, nullif(split_part(url, '/', 4), '') AS part FROM pages""")
def path_part(t: Tables):
    part = word_at(F.col("url"), 3, "/")
    return t.pages.select("page_id", part_after(F.col("url"), ".com/").alias("key"),
                          F.when(part != "", part).alias("part"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
  strftime(o_orderdate, '%d-%m-%Y') AS day_first,
  CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1900-01-01' ELSE o_orderdate END AS submitted_at,
  CASE WHEN o_orderstatus = 'P' THEN 'Sin nombre' ELSE o_orderpriority END AS company_name,
  CASE WHEN o_orderstatus = 'P' THEN 'No description' ELSE o_orderstatus END AS description
FROM orders""")
def day_text_and_defaults(t: Tables):
    pending = F.col("o_orderstatus") == "P"
    return t.orders.select(
        "o_orderkey", day_text(F.col("o_orderdate")).alias("day"),
        day_text(F.col("o_orderdate"), day_first=True).alias("day_first"),
        timestamp_or(F.when(~pending, F.col("o_orderdate")), NULL_SUBMIT_TIMESTAMP)
        .alias("submitted_at"),
        company_name(F.when(~pending, F.col("o_orderpriority"))).alias("company_name"),
        field_description(F.when(pending, "").otherwise(F.col("o_orderstatus")))
        .alias("description"))


# Prompts and answers: clusters are nations, ideas customers.
FIRST = "Rename these ideas:\n{ideas}\nAnswer as JSON."
NEXT = "The last label was {cluster_name} ({cluster_description}). Rename:\n{ideas}"
CHUNKED = """chunked AS (SELECT c_nationkey, c_custkey, c_name, c_mktsegment, n AS index,
  n // 5 AS chunk, n % 5 AS position FROM (SELECT *, row_number() OVER (
  PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS n FROM customer))"""


def _chunked(t: Tables):
    text = description_or_solution(
        F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")), F.col("c_name"))
    rows = t.customer.select(
        "c_nationkey", "c_custkey", F.col("c_name").alias("name"), text.alias("description"))
    return chunk_ideas(rows, ["c_nationkey"], ["c_custkey"])


@query("""WITH chunked AS (SELECT c_nationkey, n // 5 AS chunk,
  string_agg(format('{}.''index'': {}, ''idea_name'': {}, ''idea_description'': {}', n % 5, n,
    c_name, CASE WHEN c_acctbal > 5000 THEN c_mktsegment ELSE c_name END), chr(10) ORDER BY n)
    AS ideas, min(c_name) AS label
  FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS n
    FROM customer) GROUP BY ALL)
SELECT c_nationkey, chunk, CASE WHEN chunk = 0 THEN
    'Rename these ideas:' || chr(10) || ideas || chr(10) || 'Answer as JSON.'
  ELSE 'The last label was ' || lag(label) OVER (PARTITION BY c_nationkey ORDER BY chunk)
    || ' (About ' || (chunk - 1) || '). Rename:' || chr(10) || ideas END AS prompt FROM chunked""")
def prompt_assembly(t: Tables):
    chunked = _chunked(t)
    labels = chunked.groupBy("c_nationkey", "chunk").agg(
        F.min("name").alias("cluster_name")).withColumn(
        "cluster_description", F.concat(F.lit("About "), F.col("chunk")))
    texts = chunk_texts(chunked, ["c_nationkey"])
    return prompts(texts, ["c_nationkey"], FIRST, NEXT, labels).select(
        "c_nationkey", "chunk", "prompt")


@query("""SELECT doc_id, CASE WHEN length('[Idea number ' || doc_id || ': Name: ' || source
    || '| Description: ' || text || ']') + 1 > 1000
  THEN '[Idea number ' || doc_id || ': Name: ' || source || '| Description: '
    || substr(text, 1, 500) || ']' || chr(10)
  ELSE '[Idea number ' || doc_id || ': Name: ' || source || '| Description: ' || text || ']'
    || chr(10) END AS line FROM documents""")
def long_text_lines(t: Tables):
    return t.documents.select(
        "doc_id", long_text_line("doc_id", "source", "text").alias("line"))


def _answers(t: Tables):
    """Model answers written from the data: plain, fenced, with single quotes, or broken."""
    idea = F.format_string(
        '{"index": %d, "idea_name": "%s", "idea_description": "About %s"}',
        F.col("index"), F.col("name"), F.col("c_custkey").cast("string"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("position", idea.alias("text")))),
                        lambda x: x["text"])
    first = F.min_by("name", "position")
    body = F.format_string(
        '{"ideas": [%s], "cluster_name": "Group %s", "cluster_description": "Of nation %d"}',
        F.array_join(lines, ", "), first, F.col("c_nationkey"))
    answers = _chunked(t).groupBy("c_nationkey", "chunk").agg(body.alias("body"))
    kind = F.col("c_nationkey")
    broken = F.replace(F.col("body"), F.lit('"Group '), F.lit('"The "Group" '))
    return answers.select(
        "c_nationkey", "chunk",
        F.when(kind < 6, F.col("body"))
        .when(kind < 12, F.concat(F.lit("```json\n"), F.col("body"), F.lit("\n```")))
        .when(kind < 16, F.translate("body", '"', "'"))
        .when(kind < 20, broken)
        .otherwise(F.lit("I cannot answer that.")).alias("answer"))


CHUNK_LABELS = f"""{CHUNKED}, labels AS (SELECT c_nationkey, chunk,
  CASE WHEN c_nationkey < 16 THEN 'Group ' || min(c_name) WHEN c_nationkey < 20 THEN
    'The Group ' || min(c_name) END AS cluster_name,
  CASE WHEN c_nationkey < 20 THEN 'Of nation ' || c_nationkey END AS cluster_description,
  CASE WHEN c_nationkey < 16 THEN 'parsed' WHEN c_nationkey < 20 THEN 'repaired'
    ELSE 'unusable' END AS answer_state FROM chunked GROUP BY c_nationkey, chunk)"""


@query(f"""WITH {CHUNK_LABELS} SELECT c_nationkey, chunk, cluster_name, cluster_description,
  answer_state, CASE WHEN answer_state = 'unusable' THEN -1 ELSE n END AS n_ideas
FROM labels JOIN (SELECT c_nationkey, chunk, count(*) AS n FROM chunked GROUP BY ALL)
USING (c_nationkey, chunk)""")
def response_parse(t: Tables):
    return parse_label_answer(_answers(t), "answer").select(
        "c_nationkey", "chunk", "cluster_name", "cluster_description", "answer_state",
        F.coalesce(F.size("ideas"), F.lit(-1)).cast("long").alias("n_ideas"))


@query(f"""WITH {CHUNK_LABELS} SELECT c_nationkey, chunk, index, c_name AS idea_name,
  'About ' || c_custkey AS idea_description, cluster_name, cluster_description
FROM labels JOIN chunked USING (c_nationkey, chunk) WHERE answer_state <> 'unusable'""")
def nested_flatten(t: Tables):
    parsed = parse_label_answer(_answers(t), "answer")
    return flatten_label_ideas(parsed, ["c_nationkey", "chunk"])


@query(f"""WITH {CHUNK_LABELS} SELECT c_custkey, chunk, index,
  CASE WHEN answer_state <> 'unusable' THEN c_name END AS idea_c_name,
  CASE WHEN answer_state <> 'unusable' THEN 'About ' || c_custkey END AS idea_c_description,
  cluster_name, cluster_description, last_value(cluster_name) OVER (PARTITION BY c_nationkey
    ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final_cluster_name
FROM labels JOIN chunked USING (c_nationkey, chunk)""")
def cluster_labelling(t: Tables):
    return label_ideas(_chunked(t), _answers(t), ["c_nationkey"]).select(
        "c_custkey", "chunk", "index", "idea_c_name", "idea_c_description", "cluster_name",
        "cluster_description", "final_cluster_name")


@query("""SELECT c_nationkey, c_custkey AS index, c_name AS idea_name,
  c_mktsegment AS idea_description, 'Nation ' || c_nationkey AS cluster_name,
  'Segment' AS cluster_description FROM customer""")
def response_map_parse(t: Tables):
    """One keyed answer per idea, as the batched form returns them."""
    answer = F.format_string(
        '{"%d": {"name": "%s", "description": "%s"}, "cluster_name": "Nation %d", '
        '"cluster_description": "Segment"}',
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return parse_keyed_answer(
        t.customer.select("c_nationkey", answer.alias("answer")), "answer", ["c_nationkey"])


@query("""SELECT conv_id, turn, replace(replace(role, 'user', ''), 'x', '') AS role,
  'Say: ' || text AS prompt FROM conversations""")
def fences_and_templates(t: Tables):
    fenced = F.concat(F.lit("```json"), F.translate(F.replace("role", F.lit("user"), F.lit("")),
                                                    "x", ""), F.lit("```"))
    return t.conversations.select(
        "conv_id", "turn", strip_fences(fenced).alias("role"),
        fill_template("Say: {text}", text=F.col("text")).alias("prompt"))


# File round trips in the shared folder.
RUN = date(2024, 5, 1)


@query("""SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS created_at, value, props,
  DATE '2024-05-01' AS load_date FROM events""")
def landing_round_trip(t: Tables):
    path = scratch_path(t.spark, "landing")
    created = F.unix_millis(F.col("ts").cast("timestamp")).alias("created_at")
    rows = t.events.select("event_id", "user_id", "event_type", created, "value", "props")
    write_records(rows, path, RUN)
    schema = "event_id long, user_id long, event_type string, created_at long, value double, " \
             "props string, load_date date"
    return read_records(t.spark, path, schema)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, DATE '2024-05-01' AS load_date
FROM lineitem""")
def stage_round_trip(t: Tables):
    path = scratch_path(t.spark, "stage")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    write_stage(rows, path, RUN)
    write_stage(rows, path, RUN)
    return read_table(t.spark, path)


@query("""SELECT doc_id, text, lang FROM documents
UNION ALL SELECT doc_id, text, lang FROM documents""")
def append_load(t: Tables):
    path = scratch_path(t.spark, "append")
    append_rows(t.documents, path, ["doc_id", "text", "lang"])
    append_rows(t.documents, path, ["doc_id", "text", "lang"])
    return read_table(t.spark, path)


@query("SELECT doc_id, text, source FROM documents")
def sheet_round_trip(t: Tables):
    path = scratch_path(t.spark, "sheet")
    write_sheet(t.documents.select("doc_id", "text", "source"), path)
    return read_sheet(t.spark, path, "doc_id long, text string, source string")


@query("""SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey""")
def query_text_scan(t: Tables):
    return read_query(t.spark, "SELECT s_nationkey, count(*) AS n FROM {users} GROUP BY 1",
                      users=t.supplier)
