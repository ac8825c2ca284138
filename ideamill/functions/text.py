"""Text cleaning, categories and model-answer parsing."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ideamill.schemas import LABEL_ANSWER
from ideamill.settings import CATEGORIES, NO_TEXT, PROMPT_TEXT_LENGTH

# The characters kept by the cleaner, the white space that is collapsed,
# the code fences, the line format of a prompt and the punctuation dropped in a repair.
KEPT_CHARACTERS = r"\x09\x0A\x0D\x20-\x7EÁÉÍÓÚáéíóú"
WHITE_SPACE = r"(?U)[\s\x1c-\x1f]+"
FENCES = "```json|```"
PROMPT_LINE = "%d.'index': %s, 'idea_name': %s, 'idea_description': %s"
REPAIR_DROPS = '"\n}]'


def keep_listed(column: Column, extra: str = "") -> Column:
    """Drop every character outside the keep list (plus ``extra``)."""
    return F.regexp_replace(column, f"[^{KEPT_CHARACTERS}{extra}]", "")


def keep_listed_columns(df: DataFrame, extra: str = "") -> DataFrame:
    """Apply the keep list to every text column."""
    return df.withColumns({
        f.name: keep_listed(F.col(f.name), extra)
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    })


def prompt_text(column: Column, length: int = PROMPT_TEXT_LENGTH,
                drop_quotes: bool = True) -> Column:
    """One line of text for a prompt: white space collapsed, quotes dropped, cut."""
    line = F.trim(F.regexp_replace(column, WHITE_SPACE, " "))
    if drop_quotes:
        line = F.translate(line, "\"'", "")
    return F.coalesce(F.substring(line, 1, length), F.lit(NO_TEXT))


def newline_to_space(column: Column) -> Column:
    return F.translate(column, "\n", " ")


def category_in(column: Column) -> Column:
    """First known category named in the text, else the text itself."""
    named = [F.when(column.contains(name), F.lit(name)) for name in CATEGORIES]
    return F.coalesce(*named, column)


def strip_fences(column: Column) -> Column:
    return F.regexp_replace(column, FENCES, "")


def fill_template(template: str, **values: Column) -> Column:
    """Put column values at the ``{name}`` marks of a template; marks inside values stay."""
    return F.concat(*[
        F.coalesce(values[part], F.lit("")) if is_mark else F.lit(part)
        for part, is_mark in template_parts(template, values)])


def template_parts(template: str, names: Iterable[str]) -> list[tuple[str, bool]]:
    """The template cut at its ``{name}`` marks: each plain piece, and each name with True."""
    marks = re.compile("{(" + "|".join(map(re.escape, names)) + ")}")
    return [(part, i % 2 == 1) for i, part in enumerate(marks.split(template))]


def _after(column: Column, mark: str) -> Column:
    """Bare text between a key mark and the next comma; NULL without the mark."""
    found = F.get(F.regexp_extract_all(column, F.lit(mark + "([^,]*)"), F.lit(1)), F.lit(0))
    return F.trim(F.translate(found, REPAIR_DROPS, ""))


def _all_after(column: Column, mark: str) -> Column:
    found = F.regexp_extract_all(column, F.lit(mark + "([^,]*)"), F.lit(1))
    return F.transform(found, lambda x: F.trim(F.translate(x, REPAIR_DROPS, "")))


def _repaired(column: Column) -> Column:
    """Read an answer that is not valid JSON by its key marks."""
    index = _all_after(column, '"index": ')
    name = _all_after(column, '"idea_name": ')
    text = _all_after(column, '"idea_description":')
    cluster_name = _after(column, '"cluster_name": ')
    cluster_text = _after(column, '"cluster_description": ')
    whole = (
        (F.size(index) > 0) & (F.size(index) == F.size(name)) & (F.size(name) == F.size(text))
        & cluster_name.isNotNull() & cluster_text.isNotNull()
    )
    ideas = F.transform(
        F.arrays_zip(index.alias("i"), name.alias("n"), text.alias("t")),
        lambda x: F.struct(
            x["i"].alias("index"), x["n"].alias("idea_name"), x["t"].alias("idea_description")
        ),
    )
    return F.when(whole, F.struct(
        ideas.alias("ideas"), cluster_name.alias("cluster_name"),
        cluster_text.alias("cluster_description"),
    ))


def parse_label_answer(df: DataFrame, answer: str) -> DataFrame:
    """Add ``ideas``, ``cluster_name``, ``cluster_description`` and ``answer_state``.

    An answer is read as JSON (single quotes allowed, code fences removed), else by its key
    marks, else it is 'unusable' and its columns stay NULL.
    """
    schema = f"{LABEL_ANSWER}, _corrupt_record string"
    read = F.from_json(
        strip_fences(F.col(answer)), schema, {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    valid = (
        F.col("_read._corrupt_record").isNull() & F.col("_read.ideas").isNotNull()
        & F.col("_read.cluster_name").isNotNull()
    )
    staged = df.withColumn("_read", read)
    staged = staged.withColumn("_parsed", F.when(valid, F.struct(
        "_read.ideas", "_read.cluster_name", "_read.cluster_description")))
    staged = staged.withColumn(
        "_fixed", F.when(F.col("_parsed").isNull(), _repaired(F.col(answer))))
    best = F.coalesce(F.col("_parsed"), F.col("_fixed"))
    return staged.select(
        *df.columns,
        F.transform(best["ideas"], lambda x: F.struct(
            x["index"].try_cast("long").alias("index"), x["idea_name"].alias("idea_name"),
            x["idea_description"].alias("idea_description"),
        )).alias("ideas"),
        best["cluster_name"].alias("cluster_name"),
        best["cluster_description"].alias("cluster_description"),
        F.when(F.col("_parsed").isNotNull(), "parsed")
        .when(F.col("_fixed").isNotNull(), "repaired").otherwise("unusable")
        .alias("answer_state"),
    )


def flatten_label_ideas(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per labelled idea of an answer; answers without ideas give no row."""
    return df.select(*keep, "cluster_name", "cluster_description", F.inline("ideas"))


def parse_keyed_answer(df: DataFrame, answer: str, keep: list[str]) -> DataFrame:
    """Rows of an answer ``{"<id>": {"name", "description"}, "cluster_name", ...}``."""
    entries = F.from_json(strip_fences(F.col(answer)), "map<string, string>")
    staged = df.select(*keep, entries.alias("_entries"))
    rows = staged.select(
        *keep,
        F.col("_entries")["cluster_name"].alias("cluster_name"),
        F.col("_entries")["cluster_description"].alias("cluster_description"),
        F.explode("_entries").alias("_key", "_value"),
    ).where(F.col("_key").rlike("^[0-9]+$"))
    idea = F.from_json("_value", "name string, description string")
    return rows.select(
        *keep, F.col("_key").cast("long").alias("index"),
        idea["name"].alias("idea_name"), idea["description"].alias("idea_description"),
        "cluster_name", "cluster_description",
    )
