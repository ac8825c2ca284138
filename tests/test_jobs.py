import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ideamill import schemas
from ideamill.operators.embedding import (
    attach_vectors, classify_fields, embed_texts, text_digest, unseen_texts,
)
from ideamill.operators.labels import chunk_ideas, chunk_texts, label_ideas, live_answers, prompts
from ideamill.plans import clusters, dimensions, export, ideas
from ideamill.settings import scratch_path, shared_folder
from ideamill.sources.tables import (
    read_records, read_sheet, read_table, write_records, write_sheet, write_stage,
)
from ideamill.operators.numbering import surrogate_keys
from ideamill.operators.lookup import look_up, new_records
from ideamill.streaming.incremental import Target, load_stream, load_targets, read_landing, visible_rows

RUN = datetime(2024, 5, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_the_folder_of_the_session_is_used(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", folder)
    assert spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(folder)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_company_rows(spark):
    source = spark.createDataFrame(
        [(1, "Old", True, 0, 0), (2, None, True, 1_700_000_000_000, None),
         (3, "New", False, 86_400_000, 86_400_000)], schemas.RAW_COMPANY)
    loaded = spark.createDataFrame([(10, 1)], "id long, company_db_id long")
    new = dimensions.company_rows(source, loaded, RUN)
    assert rows(new.select("id", "company_db_id", "company_name", "created_at", "updated_at",
                           "is_current")) == [
        (11, 2, "Sin nombre", date(2023, 11, 14), None, True),
        (12, 3, "New", date(1970, 1, 2), date(1970, 1, 2), True)]
    again = dimensions.company_rows(
        source, loaded.unionByName(new.select("id", "company_db_id")), RUN)
    assert again.isEmpty() and again.schema == new.schema


def test_user_and_goal_rows(spark):
    companies = spark.createDataFrame([(100, 1)], "id long, company_db_id long")
    users = spark.createDataFrame(
        [(1, 7, "A", 0, 0), (9, 8, "B", 0, 0)],
        "company_db_id long, user_db_id long, name string, created_at long, updated_at long")
    empty = spark.createDataFrame([], "id long, user_db_id long")
    found = dimensions.user_rows(users, companies, empty, RUN)
    assert rows(found.select("id", "user_db_id", "company_id", "country")) == [
        (1, 7, 100, ""), (2, 8, None, "")]
    goals = spark.createDataFrame(
        [(5, 1, "G", None, "2024-01-01", "2024-01-01 10:00:00")],
        "goal_db_id long, company_id long, goal_name string, end_campaign long, "
        "created_at string, updated_at string")
    found = dimensions.goal_rows(
        goals, companies, spark.createDataFrame([], "id long, goal_db_id long"), RUN)
    assert rows(found.select("id", "goal_db_id", "company_id", "end_campaign", "updated_at")) == [
        (1, 5, 100, None, date(2024, 1, 1))]


@pytest.fixture(scope="module")
def forms(spark):
    """Two companies; seven problem fields in company 1, one idea per case."""
    fields = spark.createDataFrame(
        [(i, 1, f"Problema {i}", "el problema", i, 1) for i in range(1, 8)]
        + [(8, 1, "Tu propuesta", "", 8, 1), (9, 1, "Nombre", "", 9, 1),
           (10, 1, "Fecha", "cuando", 10, 1), (20, 2, "Problema", "", 20, 2),
           (30, 3, "Problema", "", 30, 3)],
        "id long, company_id long, title string, description string, form_field_id long, "
        "form_id long")
    given = [
        (1, 2, "second"), (1, 4, "fourth"), (1, 8, "solve"), (1, 9, "Name"), (1, 10, "soon"),
        (2, 1, ""), (2, 3, "third"), (2, 5, None), (2, 7, "seventh"),
        (3, 20, "only"), (4, 30, "unknown company"), (5, 10, "no category"),
        (6, 1, "a​ñb"), (6, 8, "None"), (7, 1, "loaded already"),
    ]
    answers = spark.createDataFrame(
        [(i, f, a, datetime(2024, 1, f), None) for i, f, a in given],
        "idea_id long, company_form_field_id long, answer string, created_at timestamp, "
        "updated_at timestamp")
    table = spark.createDataFrame(
        [(i, f"Idea {i}", "text", 50 + i, 60 + i, True, "open", i, 0.5,
          datetime(2024, 2, i) if i != 2 else None) for i in range(1, 8)],
        "id long, title string, description string, user_id long, goal_id long, "
        "is_private boolean, stage string, like_ideas_count int, average_general double, "
        "submited_at timestamp")
    tags = spark.createDataFrame(
        [(1, "red", None, 1), (2, "blue", "B", 2)],
        "id long, name string, description string, tag_type int")
    ideas_tags = spark.createDataFrame([(2, 1), (1, 1), (2, 3)], "tag_id long, idea_id long")
    companies = spark.createDataFrame([(100, 1), (200, 2)], "id long, company_db_id long")
    goals = spark.createDataFrame([(900, 61)], "id long, goal_db_id long")
    dim_idea = spark.createDataFrame([(40, 7)], "id long, idea_db_id long")
    return answers, fields, table, tags, ideas_tags, companies, goals, dim_idea


def test_ideas_from_answers_to_dimension(spark, forms):
    answers, fields, table, tags, ideas_tags, companies, goals, dim_idea = forms
    given = ideas.new_answers(answers, fields, table, companies, dim_idea)
    assert {r["idea_id"] for r in given.select("idea_id").collect()} == {1, 2, 3, 5, 6}
    empty = spark.createDataFrame([], schemas.PARAM_CLASS_TABLE)
    classes = ideas.class_table_rows(given, empty)
    named = {(r["company_id"], r["field_id"]): r["category"] for r in classes.collect()}
    assert named[1, 1] == "Problem 1" and named[1, 7] == "Problem 6"
    assert (1, 6) not in named  # a field without answers
    assert named[1, 8] == "Solution 1" and named[1, 9] == "Idea name"
    assert named[1, 10] == "Other" and named[2, 20] == "Problem 1"
    assert ideas.class_table_rows(given, classes).isEmpty()

    vectors = spark.createDataFrame(
        [("fourth", [4.0]), ("third", [3.0]), ("Name", [9.0])], "text string, vector array<double>"
    ).select(text_digest(F.col("text")).alias("digest"), "vector")
    dimension, stage = ideas.load_ideas(
        given, classes, vectors, table, tags, ideas_tags, dim_idea, companies, goals, RUN)
    found = {r["idea_db_id"]: r for r in dimension.collect()}
    assert sorted(found) == [1, 2, 3, 6]
    assert sorted(r["id"] for r in found.values()) == [41, 42, 43, 44]
    one = found[1]
    assert (one["problem_1"], one["problem_2"], one["problem_3"]) == ("second", "fourth", None)
    # Text and vector families move left on their own.
    assert (one["prob_1_embedded"], one["prob_2_embedded"]) == ([4.0], None)
    assert (one["solution_1"], one["name_embedded"], one["name"]) == ("solve", [9.0], "Idea 1")
    assert (one["tag_name"], one["tag_description"], one["tag_type"]) == ("red", "B", 1)
    two = found[2]
    assert (two["problem_1"], two["problem_2"], two["problem_3"]) == ("third", "seventh", None)
    assert two["tag_name"] is None and two["stage"] == "open"
    assert two["prob_1_embedded"] == [3.0] and two["description"] is None
    assert found[6]["problem_1"] == "ab" and found[6]["solution_1"] is None
    text = dimension.select("valid_to", "updated_at").first()
    assert text["valid_to"].year == 2262 and text["updated_at"].year == 2262
    submissions = {r["idea_db_id"]: r for r in stage.collect()}
    assert (submissions[1]["company_id"], submissions[1]["goal_id"]) == (100, 900)
    assert (submissions[3]["company_id"], submissions[3]["goal_id"]) == (200, 0)
    assert submissions[2]["submitted_at"].year == 2262


def test_vectors_are_the_same_for_small_and_large_tables(spark):
    """Looked up in place or met by digest; a digest with two vectors has the greater one."""
    names = schemas.VECTOR_COLUMNS
    data = [(i, *[f"d{(i * 3 + n) % 20}" if (i + n) % 4 else None for n in range(len(names))]) for i in range(40)] + [
        (99, *[None] * len(names))]
    wide = spark.createDataFrame(data, "idea_db_id long, " + ", ".join(f"{c} string" for c in names))
    vectors = spark.createDataFrame(
        [(f"d{i}", [float(i), 1.0]) for i in range(15)] + [("d3", [9.0, 0.0]), ("d4", None)], "digest string, vector array<double>")
    value = {f"d{i}": [float(i), 1.0] for i in range(15)} | {"d3": [9.0, 0.0]}
    want = {r[0]: [value.get(d) for d in r[1:]] for r in data}
    for small_bytes in (1 << 20, 0):
        found = ideas.with_vectors(wide, vectors, small_bytes)
        assert found.columns == wide.columns
        assert {r["idea_db_id"]: [r[c] for c in names] for r in found.collect()} == want


def test_the_load_fills_missing_vectors_once(spark, tmp_path):
    given = spark.createDataFrame(
        [(1, 1, "known", 7, "T"), (2, 1, "new text", 7, "T"), (3, 1, "new text", 7, "T"), (4, 1, " ", 7, "T")],
        "idea_id long, field_id long, field_answer string, company_id long, title string").withColumns({
            c: F.lit(None).cast(kind) for c, kind in {
                "idea_name": "string", "description": "string", "created_at": "date", "updated_at": "date"}.items()})
    classes = spark.createDataFrame([(1, 7, 1, "T", None, "Problem 1")], schemas.PARAM_CLASS_TABLE)
    table = spark.createDataFrame([(i, None, None, None) for i in range(1, 5)],
                                  "id long, title string, description string, user_id long").withColumns({
        c: F.lit(None).cast(kind) for c, kind in {
            "goal_id": "long", "is_private": "boolean", "stage": "string", "like_ideas_count": "int",
            "average_general": "double", "submited_at": "timestamp"}.items()})
    tags = spark.createDataFrame([], "id long, name string, description string, tag_type int")
    known = spark.createDataFrame([("known", [1.0])], "text string, vector array<double>").select(
        text_digest(F.col("text")).alias("digest"), "vector")
    path = str(tmp_path / "vectors")
    known.write.parquet(path)
    asked = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<double>")
    def embed(text):
        asked.add(len(text))
        return text.map(lambda x: [float(len(x))])

    keys = spark.createDataFrame([], "id long, company_db_id long, goal_db_id long, idea_db_id long")
    for turn in range(2):
        dimension, stage = ideas.load_ideas(
            given, classes, spark.read.parquet(path), table, tags,
            spark.createDataFrame([], "tag_id long, idea_id long"), keys, keys, keys, RUN, embed, path)
        found = {r["idea_db_id"]: r["prob_1_embedded"] for r in dimension.collect()}
        assert found == {1: [1.0], 2: [8.0], 3: [8.0], 4: None} and stage.count() == 4 and asked.value == 1
        # What was made is read from the table from now on.
        assert spark.read.parquet(path).count() == 2


def test_later_rows_win_in_the_class_table(spark):
    table = spark.createDataFrame(
        [(1, 1, "T", "Problem 1"), (2, 1, "T", "Solution 1"), (3, 2, "U", "Problem 1")],
        "id long, company_id long, name string, category string")
    answers = spark.createDataFrame(
        [(1, "T"), (1, "missing"), (2, "U"), (9, "T")], "company_id long, title string")
    found = ideas.categorised_answers(answers, table)
    assert rows(found) == [(1, "T", "Solution 1"), (2, "U", "Problem 1")]


def test_model_sees_each_field_once(spark):
    answers = spark.createDataFrame(
        [(1, 5, "T", "d")] * 40 + [(1, 6, "S", "d")],
        "company_id long, field_id long, title string, description string")
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def model(title, description):
        seen.add(len(title))
        return title.map({"T": "It is a Problem", "S": "Solution"})

    found = classify_fields(answers, ["field_id"], model)
    assert rows(found.select("field_id", "category")) == [(5, "Problem 1"), (6, "Solution 1")]
    assert seen.value == 2


def test_only_new_texts_are_embedded(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b\nc",), ("",), ("None",), (None,)],
                               "answer string")
    cache = df.where("answer = 'a'").distinct().select(
        text_digest(F.col("answer")).alias("digest"),
        F.array(F.lit(1.0)).alias("vector"))
    new = unseen_texts(df, "answer", cache)
    assert [r["text"] for r in new.collect()] == ["b c"]
    made = embed_texts(new, lambda text: F.array(F.length(text).cast("double")))
    found = attach_vectors(df, "answer", cache.unionByName(made), "v")
    assert rows(found) == sorted([("a", [1.0]), ("a", [1.0]), ("b\nc", [3.0]), ("", None),
                                  ("None", None), (None, None)], key=repr)


GROUP = ["company_id", "cluster_number"]


def cluster_rows(spark, size):
    return spark.range(size).select(
        F.lit(1).cast("long").alias("company_id"), F.lit(4).cast("long").alias("cluster_number"),
        F.col("id").alias("idea_db_id"), F.concat(F.lit("Idea "), "id").alias("name"),
        F.when(F.col("id") != 1, "A \"text\"").alias("description"))


def test_prompts_carry_the_label_before(spark):
    chunked = chunk_ideas(cluster_rows(spark, 7), GROUP, ["idea_db_id"])
    labels = spark.createDataFrame(
        [(1, 4, 0, "First", "one")],
        "company_id long, cluster_number long, chunk long, cluster_name string, "
        "cluster_description string")
    found = prompts(chunk_texts(chunked, GROUP), GROUP, "Ideas:\n{ideas}",
                    "{cluster_name}/{cluster_description}:\n{ideas}", labels)
    text = {r["chunk"]: r["prompt"] for r in found.collect()}
    assert text[0].split("\n")[:3] == [
        "Ideas:", "0.'index': 0, 'idea_name': Idea 0, 'idea_description': A text",
        "1.'index': 1, 'idea_name': Idea 1, 'idea_description': No data"]
    assert text[1] == ("First/one:\n0.'index': 5, 'idea_name': Idea 5, 'idea_description': A text"
                       "\n1.'index': 6, 'idea_name': Idea 6, 'idea_description': A text")


def test_labels_join_back(spark):
    chunked = chunk_ideas(cluster_rows(spark, 11), GROUP, ["idea_db_id"])

    def answer(indexes, name):
        return json.dumps({
            "ideas": [{"index": i, "idea_name": f"N{i}", "idea_description": "D"}
                      for i in indexes], "cluster_name": name, "cluster_description": "T"})

    answers = spark.createDataFrame(
        [(1, 4, 0, answer([0, 1, 2, 4], "Start")), (1, 4, 1, "no answer"),
         (1, 4, 2, answer([10], "End"))],
        "company_id long, cluster_number long, chunk long, answer string")
    found = {r["idea_db_id"]: r for r in label_ideas(chunked, answers, GROUP).collect()}
    assert len(found) == 11
    assert (found[0]["idea_c_name"], found[0]["cluster_name"]) == ("N0", "Start")
    assert found[3]["idea_c_name"] is None and found[3]["cluster_name"] is None
    assert found[7]["cluster_name"] is None
    assert found[10]["cluster_name"] == "End"
    assert {r["final_cluster_name"] for r in found.values()} == {"End"}


def test_live_model_is_asked_once_per_chunk_in_order(spark):
    chunked = chunk_ideas(
        cluster_rows(spark, 23).unionByName(
            cluster_rows(spark, 6).withColumn("cluster_number", F.lit(5).cast("long"))),
        GROUP, ["idea_db_id"])
    asked = spark.sparkContext.accumulator(0)

    def model(prompt):
        asked.add(1)
        before = prompt.split("|")[1] if prompt.startswith("next") else ""
        return json.dumps({"ideas": [], "cluster_name": before + "x", "cluster_description": ""})

    def label(answer):
        import json

        read = json.loads(answer)
        return read["cluster_name"], read["cluster_description"]

    found = live_answers(chunk_texts(chunked, GROUP), GROUP, "first {ideas}",
                         "next|{cluster_name}|{ideas}", model, label)
    names = {(r["cluster_number"], r["chunk"]): json.loads(r["answer"])["cluster_name"]
             for r in found.collect()}
    assert names == {(4, i): "x" * (i + 1) for i in range(5)} | {(5, 0): "x", (5, 1): "xx"}
    found.count()
    assert asked.value == 7


@pytest.mark.parametrize("per_wave", [1, 2])
def test_a_failed_wave_alone_is_asked_again(spark, tmp_path, per_wave):
    """The run stops in the wave of chunk 2; the next one asks that wave and the rest, not the waves before."""
    texts = spark.createDataFrame(
        [(c, n, f"{c}/{n}") for c in range(6) for n in range(1 + c)], "cluster long, chunk long, ideas string")
    asked, broken = spark.sparkContext.accumulator(0), tmp_path / "broken"
    broken.touch()

    def model(prompt):
        if "/2" in prompt and broken.exists():
            raise RuntimeError("no model")
        asked.add(1)
        return prompt.split("|")[-1]

    def run():
        return live_answers(texts, ["cluster"], "{ideas}", "{cluster_name}|{ideas}", model, lambda a: (a, ""),
                            per_wave, str(tmp_path / "answers"))

    with pytest.raises(Exception, match="no model"):
        run()
    done = asked.value
    broken.unlink()
    found = {(r["cluster"], r["chunk"]): r["answer"] for r in run().collect()}
    assert found == {(c, n): f"{c}/{n}" for c in range(6) for n in range(1 + c)}
    # The waves before chunk 2 hold 6 + 5 texts; of the broken wave some may have been asked.
    assert done >= 11 and asked.value - done == 21 - 11
    assert run().count() == 21 and asked.value - done == 10


def test_an_unusable_answer_keeps_the_label_and_marks_in_texts_stay(spark):
    texts = spark.createDataFrame(
        [(1, 0, "a"), (1, 1, "{cluster_name}"), (1, 2, "c")], "cluster long, chunk long, ideas string")

    def model(prompt):
        return f"label {prompt}" if "a" == prompt else f"unusable {prompt}"

    def label(answer):
        if answer.startswith("unusable"):
            raise ValueError(answer)
        return "L", "{ideas}"

    found = live_answers(texts, ["cluster"], "{ideas}", "{cluster_name}/{cluster_description}/{ideas}", model, label)
    assert [r["answer"] for r in found.orderBy("chunk").collect()] == [
        "label a", "unusable L/{ideas}/{cluster_name}", "unusable L/{ideas}/c"]


def test_a_repeated_index_gives_one_label(spark):
    chunked = spark.createDataFrame([(1, 0, 0), (1, 0, 1)], "cluster long, chunk long, index long")
    answer = json.dumps({"ideas": [
        {"index": 0, "idea_name": "first", "idea_description": ""}, {"index": 0, "idea_name": "second", "idea_description": ""},
        {"index": 1, "idea_name": "other", "idea_description": ""}], "cluster_name": "n", "cluster_description": "d"})
    answers = spark.createDataFrame([(1, 0, answer)], "cluster long, chunk long, answer string")
    found = label_ideas(chunked, answers, ["cluster"])
    assert sorted((r["index"], r["idea_c_name"]) for r in found.collect()) == [(0, "first"), (1, "other")]


def test_models_are_asked_once_per_item(spark):
    from pyspark.sql.functions import pandas_udf
    from pyspark.sql import functions as F

    asked = spark.sparkContext.accumulator(0)

    def build(kind, value, fixed):
        def call(text):
            asked.add(len(text))
            return text.map(lambda _: value)

        udf = pandas_udf(call, kind)
        return udf if fixed else udf.asNondeterministic()

    texts = spark.range(10).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").cast("string").alias("text"))
    answers = spark.range(10).selectExpr("id AS field_id", "1L AS company_id", "'t' AS title", "'d' AS description")
    for fixed in (True, False):
        before = asked.value
        made = embed_texts(texts, build("array<double>", [1.0], fixed))
        assert made.count() == 10 and len(made.collect()) == 10 and asked.value - before == 10
        before = asked.value
        model = build("string", "Category: Problem", fixed)
        found = classify_fields(answers, ["field_id"], lambda title, description: model(title))
        assert found.count() == 10 and len(found.collect()) == 10 and asked.value - before == 10


def test_a_fresh_progress_folder_keeps_loaded_rows(spark, tmp_path):
    schema = "key long"

    def load(progress):
        stream = read_landing(spark, f"{tmp_path}/landing", schema)
        load_stream(stream, f"{tmp_path}/target", schema, f"{tmp_path}/{progress}", lambda batch, loaded:
                    batch.join(loaded, "key", "left_anti")).awaitTermination()

    for keys, progress in (((1, 2), "one"), ((2, 3), "two"), ((4,), "two")):
        spark.createDataFrame([(k,) for k in keys], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/landing")
        load(progress)
    assert sorted(r["key"] for r in spark.read.parquet(f"{tmp_path}/target").collect()) == [1, 2, 3, 4]


def test_vector_export_skips_exported(spark):
    dim_idea = spark.createDataFrame(
        [(1, 11, [1.0, 2.0], [3.0, 4.0]), (2, 12, None, [1.0]), (3, 13, None, [5.0, 6.0]),
         (4, 14, [7.0, 8.0], None)],
        "id long, idea_db_id long, name_embedded array<double>, sol_1_embedded array<double>")
    fact = spark.createDataFrame([(1, 900, 100), (3, 0, 100)],
                                 "idea_id long, goal_id long, company_id long")
    companies = spark.createDataFrame([(100, 1)], "id long, company_db_id long")
    goals = spark.createDataFrame([(900, 9)], "id long, goal_db_id long")
    found = export.idea_vectors(dim_idea, fact, 2, columns=["name_embedded", "sol_1_embedded"])
    exported = spark.createDataFrame([("14",)], "id string")
    records = export.vector_records(found, companies, goals, exported, rows=1)
    assert rows(records) == [
        ("11", [2.0, 3.0], (11, 1, 9), 0), ("13", [5.0, 6.0], (13, 1, None), 1)]


def test_clusters_are_not_repeated(spark):
    dim_idea = spark.range(30).select(
        F.col("id"), (F.col("id") + 100).alias("idea_db_id"), F.lit("N").alias("name"),
        F.lit("D").alias("description"), F.lit(None).cast("string").alias("solution_1"),
        F.array(F.sin("id"), F.cos("id")).alias("name_embedded"))
    fact = spark.range(25).select(F.col("id").alias("idea_id"), F.lit(1).cast("long")
                                  .alias("goal_id"), F.lit(7).cast("long").alias("company_id"))
    loaded = dim_idea.where("id < 5").select("idea_db_id")
    found = clusters.clustered_ideas(dim_idea, fact, loaded, 2, columns=["name_embedded"],
                                     restarts=5)
    assert {r["idea_db_id"] for r in found.collect()} == set(range(105, 125))
    assert {r["cluster_number"] for r in found.collect()} == {0, 1}


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\n\"b\""), (2, None)], "id long, text string")
    write_records(df, f"{tmp_path}/raw", date(2024, 5, 1))
    write_records(df.limit(0), f"{tmp_path}/raw", date(2024, 5, 2))
    assert rows(read_records(spark, f"{tmp_path}/raw", "id long, text string").drop(
        "load_date")) == rows(df)
    (tmp_path / "array.json").write_text('[{"id": 1, "text": "x"}, {"id": 2}]')
    assert rows(read_records(spark, f"{tmp_path}/array.json", "id long, text string",
                             array_files=True)) == [(1, "x"), (2, None)]
    write_stage(df, f"{tmp_path}/stage", date(2024, 5, 1))
    write_stage(df, f"{tmp_path}/stage", date(2024, 5, 1))
    write_stage(df.limit(1), f"{tmp_path}/stage", date(2024, 5, 2))
    days = read_table(spark, f"{tmp_path}/stage").groupBy("load_date").count()
    assert rows(days) == [(date(2024, 5, 1), 2), (date(2024, 5, 2), 1)]
    write_sheet(df, f"{tmp_path}/sheet")
    assert rows(read_sheet(spark, f"{tmp_path}/sheet", "id long, text string")) == rows(df)


STREAM_SCHEMA = ("id long, company_db_id long, company_name string, status_active boolean, "
                 "created_at date, updated_at date, " + schemas.HISTORY)


def load(spark, folder, clean="off", archive=None):
    landing = read_landing(spark, f"{folder}/raw", schemas.RAW_COMPANY, clean, archive)
    load_stream(landing, f"{folder}/dim", STREAM_SCHEMA, f"{folder}/progress",
                lambda batch, loaded: dimensions.company_rows(batch, loaded, RUN)
                ).awaitTermination()


def land(folder, name, *companies):
    (folder / "raw").mkdir(exist_ok=True)
    (folder / "raw" / name).write_text("\n".join(
        json.dumps({"company_db_id": c, "company_name": f"C{c}", "created_at": 0})
        for c in companies))


def test_stream_loads_each_key_once(spark, tmp_path):
    land(tmp_path, "a.json", 1, 2)
    land(tmp_path, "empty.json")
    load(spark, tmp_path)
    load(spark, tmp_path)
    land(tmp_path, "b.json", 2, 3)
    land(tmp_path, "copy.json", 1, 2)
    load(spark, tmp_path)
    found = spark.read.parquet(f"{tmp_path}/dim").select("id", "company_db_id")
    assert rows(found) == [(1, 1), (2, 2), (3, 3)]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    """The batch was written, then the run died before the progress was committed."""
    land(tmp_path, "a.json", 1, 2)
    load(spark, tmp_path)
    land(tmp_path, "b.json", 2, 3)
    load(spark, tmp_path)
    commit = tmp_path / "progress" / "commits" / "1"
    for file in (commit, commit.with_name(".1.crc")):
        if file.exists():
            file.unlink()
    load(spark, tmp_path)
    found = spark.read.parquet(f"{tmp_path}/dim").select("id", "company_db_id")
    assert rows(found) == [(1, 1), (2, 2), (3, 3)]


def test_consumed_files_are_archived(spark, tmp_path):
    for day, name in enumerate(("a.json", "b.json", "c.json")):
        land(tmp_path, name, day)
        load(spark, tmp_path, "archive", f"{tmp_path}/used")
    kept = {p.name for p in (tmp_path / "raw").glob("*.json")}
    moved = {p.name for p in (tmp_path / "used").rglob("*.json")}
    assert kept | moved == {"a.json", "b.json", "c.json"} and "a.json" in moved


def test_a_batch_of_several_targets_is_loaded_as_a_unit(spark, tmp_path):
    """The load stops between the dimension and the fact; its replay loads each key of both once."""
    landing, manifest = str(tmp_path / "landing"), str(tmp_path / "manifest")
    broken = tmp_path / "broken"

    def teams(batch, loaded):
        new = new_records(batch.select("team").distinct(), loaded["teams"], "team")
        return surrogate_keys(new, loaded["teams"], ["team"])

    def people(batch, loaded):
        if broken.exists():
            raise RuntimeError("lost")
        new = look_up(new_records(batch, loaded["people"], "person"), loaded["teams"], {"team": "team"}, "id", "team_id")
        return surrogate_keys(new.select("person", "team_id"), loaded["people"], ["person"])

    targets = {"teams": Target(str(tmp_path / "teams"), "id long, team string", teams),
               "people": Target(str(tmp_path / "people"), "id long, person string, team_id long", people)}

    def land(rows, day):
        write_records(spark.createDataFrame(rows, "person string, team string"), landing, date(2024, 5, day))

    def load():
        stream = read_landing(spark, f"{landing}/*", "person string, team string")
        load_targets(stream, targets, manifest, str(tmp_path / "progress")).awaitTermination()

    def seen(name, *columns):
        return sorted(tuple(r) for r in visible_rows(spark, targets[name], manifest).select(*columns).collect())

    land([("a", "x"), ("b", "y")], 1)
    load()
    assert seen("teams", "id", "team") == [(1, "x"), (2, "y")]
    assert seen("people", "id", "person", "team_id") == [(1, "a", 1), (2, "b", 2)]
    land([("b", "y"), ("c", "z"), ("d", "x")], 2)
    broken.touch()
    with pytest.raises(Exception, match="lost"):
        load()
    # The dimension's folder is there; no reader sees it.
    assert seen("teams", "id", "team") == [(1, "x"), (2, "y")]
    broken.unlink()
    load()
    load()
    assert seen("teams", "id", "team") == [(1, "x"), (2, "y"), (3, "z")]
    assert seen("people", "id", "person", "team_id") == [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 1)]
