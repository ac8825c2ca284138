import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ideamill import schemas
from ideamill.functions.text import (
    category_in, keep_listed, newline_to_space, parse_keyed_answer, parse_label_answer,
    prompt_text, strip_fences,
)
from ideamill.functions.values import (
    compact_left, day_of, ensure_columns, epoch_ms_to_date, known_key, moment_of,
    normalise_missing, not_blank, part_after, text_to_date, timestamp_or, word_at,
)
from ideamill.functions.vectors import (
    distance, mean_of_valid, text_to_vector, vector_digest, vector_sizes, vector_to_text,
)


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


def test_missing_values_collapse(spark):
    df = spark.createDataFrame(
        [("", float("nan"), 1), ("None", 2.0, None), (None, None, 3), ("x", 0.5, 4)],
        "a string, b double, c long")
    assert [tuple(r) for r in normalise_missing(df).collect()] == [
        (None, None, 1), (None, 2.0, None), (None, None, 3), ("x", 0.5, 4)]
    kept = normalise_missing(df, ["b"]).collect()
    assert [r["a"] for r in kept] == ["", "None", None, "x"]


def test_blank_answers(spark):
    rows = [(None,), ("",), ("  ",), ("None",), ("text",)]
    assert values(spark, rows, "a string", not_blank(F.col("a"))) == [
        False, False, False, False, True]


def test_known_key_and_dates(spark):
    assert values(spark, [(None,), (7,)], "a int", known_key(F.col("a"))) == [0, 7]
    rows = [(0,), (1_700_000_000_000,), (-1,), (2**62,), (None,)]
    assert values(spark, rows, "a long", epoch_ms_to_date(F.col("a"))) == [
        date(1970, 1, 1), date(2023, 11, 14), date(1969, 12, 31), None, None]
    rows = [("2023-05-06",), ("2023-05-06 07:08:09",), ("yesterday",), (None,)]
    assert values(spark, rows, "a string", text_to_date(F.col("a"))) == [
        date(2023, 5, 6), date(2023, 5, 6), None, None]
    late = values(spark, [(None,)], "a timestamp", timestamp_or(F.col("a")).cast("string"))
    assert late == ["2262-04-11 23:47:16.854775"]


def test_moments_of_three_kinds(spark):
    df = spark.createDataFrame(
        [(1_700_000_000_123, "2023-11-14 22:13:20", datetime(2023, 11, 14, 22, 13, 20)),
         (2**62, "soon", None)], "ms long, text string, ts timestamp")
    found = df.select(*[moment_of(df, c) for c in df.columns]).collect()
    assert [v.replace(microsecond=0) for v in found[0]] == [datetime(2023, 11, 14, 22, 13, 20)] * 3
    assert tuple(found[1]) == (None, None, None)
    days = df.select(*[day_of(df, c) for c in df.columns]).collect()
    assert tuple(days[0]) == (date(2023, 11, 14),) * 3 and tuple(days[1]) == (None,) * 3


def test_text_parts(spark):
    rows = [("https://x.com/raw/a.json",), ("raw/a.json",)]
    assert values(spark, rows, "a string", part_after(F.col("a"), ".com/")) == [
        "raw/a.json", "raw/a.json"]
    assert values(spark, [("u1 u2",), ("u1",)], "a string", word_at(F.col("a"), 1)) == [
        "u2", None]


def test_keep_list_drops_letters_outside_it(spark):
    text = "¿Qué año? ñandú\t\"a\"\r\n— ü\x00€"
    assert values(spark, [(text,)], "a string", keep_listed(F.col("a"))) == [
        "Qué ao? andú\t\"a\"\r\n "]
    assert values(spark, [(text,)], "a string", keep_listed(F.col("a"), "ñü¿")) == [
        "¿Qué año? ñandú\t\"a\"\r\n ü"]


def python_prompt_text(text):
    if text is None:
        return "No data"
    return " ".join(text.split()).replace('"', "").replace("'", "")[:800]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(
    alphabet=st.sampled_from("ab\"' \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  é"), max_size=40),
    min_size=20, max_size=60))
def test_prompt_text_equals_python(spark, texts):
    rows = [(t,) for t in texts]
    assert values(spark, rows, "a string", prompt_text(F.col("a"))) == [
        python_prompt_text(t) for t in texts]


def test_prompt_text_cases(spark):
    rows = [(None,), ("",), ("a  \"b\"  c",), ("x" * 900,), ("é" * 801,)]
    assert values(spark, rows, "a string", prompt_text(F.col("a"))) == [
        python_prompt_text(r[0]) for r in rows]
    assert values(spark, [("a 'b' " + "c" * 600,)], "a string",
                  prompt_text(F.col("a"), 500, drop_quotes=False)) == [
        ("a 'b' " + "c" * 600)[:500]]
    assert values(spark, [("a\nb\r\nc",)], "a string", newline_to_space(F.col("a"))) == [
        "a b\r c"]


def test_category_order(spark):
    rows = [("Category: Problem",), ("Solution of a Problem",), ("Idea name, Problem",),
            ("Others",), ("problem",), ("",), (None,)]
    assert values(spark, rows, "a string", category_in(F.col("a"))) == [
        "Problem", "Problem", "Idea name", "Other", "problem", "", None]


def test_vector_text(spark):
    nan = float("nan")
    rows = [([1.0, -2.5],), ([nan, nan],), (None,), ([nan, 1e-5],)]
    assert values(spark, rows, "v array<double>", vector_to_text(F.col("v"))) == [
        "1.0,-2.5", None, None, "NaN,1.0E-5"]
    back = values(spark, rows, "v array<double>", text_to_vector(vector_to_text(F.col("v"))))
    assert back[0] == [1.0, -2.5] and back[1] is None and back[3][1] == 1e-5
    assert values(spark, [("1, 2e-05 ,x",)], "s string", text_to_vector(F.col("s"))) == [
        [1.0, 2e-05, None]]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1,
                         max_size=6), min_size=10, max_size=40))
def test_vector_text_round_trip(spark, vectors):
    rows = [(v,) for v in vectors]
    assert values(spark, rows, "v array<double>",
                  text_to_vector(vector_to_text(F.col("v")))) == vectors


def test_mean_of_valid_vectors(spark):
    nan = float("nan")
    rows = [
        ([1.0, 2.0], [3.0, 4.0], None),
        ([1.0, 2.0], [3.0, 4.0, 5.0], None),
        ([1.0, nan], [3.0, 4.0], [5.0, 6.0]),
        ([nan, 1.0], [nan, 3.0], None),
        (None, [1.0], None),
        (None, None, None),
    ]
    columns = [F.col(c) for c in "abc"]
    found = values(spark, rows, "a array<double>, b array<double>, c array<double>",
                   mean_of_valid(columns, 2))
    assert found[:3] == [[2.0, 3.0], [1.0, 2.0], [3.0, 5.0]]
    assert math.isnan(found[3][0]) and found[3][1] == 2.0
    assert found[4:] == [None, None]


def test_thirteen_vectors_of_full_size(spark):
    names = schemas.VECTOR_COLUMNS
    assert len(names) == 13
    df = spark.range(3).select(*[
        F.array_repeat(F.col("id") + F.lit(float(i)), 1536).alias(n)
        for i, n in enumerate(names)])
    for i, r in enumerate(df.select(mean_of_valid([F.col(n) for n in names]).alias("m"))
                          .collect()):
        assert r["m"] == [pytest.approx(i + 6.0)] * 1536


def test_distance_sizes_and_digest(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], [3.0, 4.0]), (1, [1.0], [1.0])],
                               "g long, a array<double>, b array<double>")
    assert [r[0] for r in df.select(distance(F.col("a"), F.col("b"))).collect()] == [5.0, 0.0]
    sizes = vector_sizes(df, ["g"], "a").first()
    assert (sizes["n_sizes"], sizes["is_consistent"]) == (2, False)
    digests = [tuple(r) for r in df.select(
        vector_digest(F.col("a")), vector_digest(F.col("b"))).collect()]
    assert digests[1][0] == digests[1][1] and digests[0][0] != digests[0][1]


def test_compact_left_keeps_order_and_leaves_no_gap(spark):
    rows = [(None, "b", None, "d", None, "f"), ("a", None, None, None, None, None),
            (None,) * 6]
    names = [f"p{i}" for i in range(1, 7)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    assert [tuple(r) for r in compact_left(df, [names]).collect()] == [
        ("b", "d", "f", None, None, None), ("a",) + (None,) * 5, (None,) * 6]


def test_families_compact_on_their_own(spark):
    df = spark.createDataFrame(
        [("x", "y", None, [2.0])],
        "t1 string, t2 string, v1 array<double>, v2 array<double>")
    row = compact_left(df, [["t1", "t2"], ["v1", "v2"]]).first()
    assert (row["t1"], row["t2"], row["v1"], row["v2"]) == ("x", "y", [2.0], None)


def test_ensure_columns(spark):
    df = ensure_columns(spark.createDataFrame([(1,)], "a long"),
                        {"a": "long", "b": "string", "c": "array<double>"})
    assert df.dtypes == [("a", "bigint"), ("b", "string"), ("c", "array<double>")]
    assert tuple(df.first()) == (1, None, None)


VALID = ('{"ideas": [{"index": 3, "idea_name": "N", "idea_description": "D"}], '
         '"cluster_name": "C", "cluster_description": "T"}')


def test_label_answers(spark):
    unescaped = VALID.replace('"N"', '"The "N" one"')
    missing = '{"ideas": [{"index": 3, "idea_name": "N"}'
    rows = [(VALID,), ("```json\n" + VALID + "\n```",), (VALID.replace('"', "'"),),
            (unescaped,), (missing,), ("Sorry.",), (None,),
            (VALID.replace('"index": 3', '"index": "3"'),)]
    found = parse_label_answer(spark.createDataFrame(rows, "answer string"), "answer").collect()
    assert [r["answer_state"] for r in found] == [
        "parsed", "parsed", "parsed", "repaired", "unusable", "unusable", "unusable", "parsed"]
    for r in (found[0], found[1], found[2], found[7]):
        assert tuple(r["ideas"][0]) == (3, "N", "D")
        assert (r["cluster_name"], r["cluster_description"]) == ("C", "T")
    assert tuple(found[3]["ideas"][0]) == (3, "The N one", "D")
    assert found[3]["cluster_name"] == "C" and found[3]["cluster_description"] == "T"
    assert found[5]["ideas"] is None and found[5]["cluster_name"] is None


def test_keyed_answers(spark):
    text = ('{"0": {"name": "A", "description": "a"}, "12": {"name": "B", "description": "b"}, '
            '"cluster_name": "C", "cluster_description": "T"}')
    df = spark.createDataFrame([(1, text), (2, "none")], "c long, answer string")
    found = sorted(tuple(r) for r in parse_keyed_answer(df, "answer", ["c"]).collect())
    assert found == [(1, 0, "A", "a", "C", "T"), (1, 12, "B", "b", "C", "T")]


def test_fences(spark):
    assert values(spark, [("```json{}```",)], "a string", strip_fences(F.col("a"))) == ["{}"]


def test_midnight_is_kept(spark):
    found = values(spark, [(datetime(2024, 1, 1),)], "a timestamp", timestamp_or(F.col("a")))
    assert found == [datetime(2024, 1, 1)]
