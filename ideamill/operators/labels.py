"""Cluster labelling: chunks of ideas, prompts, model answers and the join back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ideamill.functions.text import (
    PROMPT_LINE, fill_template, flatten_label_ideas, parse_label_answer, prompt_text,
    template_parts,
)
from ideamill.operators.numbering import chunk_number, values_before
from ideamill.operators.reshape import keep_first
from ideamill.settings import CHUNK_ROWS, HOT_GROUP_ROWS, scratch_path, task_count


def description_or_solution(solution: Column, description: Column) -> Column:
    """The text of an idea for labelling: its first solution where there is one."""
    return F.coalesce(solution, description)


def chunk_ideas(ideas: DataFrame, group: list[str], order: list[str], rows: int = CHUNK_ROWS,
                hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Add ``index`` (place in the cluster), ``chunk`` and ``position`` (place in the chunk)."""
    chunked = chunk_number(ideas, group, order, rows, hot_rows)
    return chunked.withColumn("index", F.col("chunk") * rows + F.col("position"))


def prompt_line(position: str, index: str, name: str, description: str) -> Column:
    return F.format_string(
        PROMPT_LINE, F.col(position), F.col(index).cast("string"),
        prompt_text(F.col(name)), prompt_text(F.col(description)),
    )


def long_text_line(number: str, name: str, description: str, limit: int = 1000,
                   cut: int = 500) -> Column:
    """The bracketed line form; the description is cut when the line passes the limit."""
    def line(text: Column) -> Column:
        return F.concat(
            F.lit("[Idea number "), F.col(number).cast("string"), F.lit(": Name: "),
            F.coalesce(name, F.lit("None")), F.lit("| Description: "), text, F.lit("]\n"))

    whole = F.coalesce(F.col(description), F.lit("None"))
    return F.when(F.length(line(whole)) > limit, line(F.substring(whole, 1, cut))).otherwise(
        line(whole))


def chunk_texts(chunked: DataFrame, group: list[str], name: str = "name",
                description: str = "description") -> DataFrame:
    """One row per chunk with its numbered idea lines; a chunk holds a few rows at most."""
    line = F.struct("position", prompt_line("position", "index", name, description).alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"])
    return chunked.groupBy(*group, "chunk").agg(F.array_join(lines, "\n").alias("ideas"))


def prompts(texts: DataFrame, group: list[str], first: str, following: str,
            labels: DataFrame | None = None) -> DataFrame:
    """Add ``prompt``. From the second chunk on, the template takes the label before.

    ``labels`` holds ``cluster_name`` and ``cluster_description`` per group and chunk.
    """
    if labels is None:
        return texts.withColumn("prompt", fill_template(first, ideas=F.col("ideas")))
    carried = values_before(labels, group, ["cluster_name", "cluster_description"])
    joined = texts.join(carried, [*group, "chunk"], "left")
    later = fill_template(
        following, ideas=F.col("ideas"), cluster_name=F.col("previous_cluster_name"),
        cluster_description=F.col("previous_cluster_description"))
    start = fill_template(first, ideas=F.col("ideas"))
    return joined.select(
        *texts.columns, F.when(F.col("chunk") == 0, start).otherwise(later).alias("prompt"))


def live_answers(texts: DataFrame, group: list[str], first: str, following: str,
                 answer: Callable[[str], str],
                 read_label: Callable[[str], tuple[str, str] | None],
                 chunks_per_wave: int = 1, folder: str | None = None) -> DataFrame:
    """Ask the caller's model in waves; each prompt carries the label of the chunk before.

    A wave asks the next ``chunks_per_wave`` chunks of all clusters at once and writes the answers with
    the labels they leave; the next wave joins them. A lost executor repeats its part of one wave, and a
    run with a ``folder`` goes on after the waves that an earlier run left whole there. Chunks of a
    cluster are numbered from 0 without gaps, as chunk_ideas does. An answer that ``read_label`` can't
    read (None or a ValueError, LookupError or TypeError) is stored as it came and leaves the label.
    """
    spark, tasks = texts.sparkSession, task_count(texts.sparkSession)
    folder = (folder or scratch_path(spark, "answers")).rstrip("/")
    asked = StructType([
        *[texts.schema[g] for g in group], *StructType.fromDDL("chunk long, answer string"), *StructType.fromDDL(LABEL)])
    waves = scratch_path(spark, "waves")
    numbered = texts.select(*group, "chunk", "ideas").withColumn("wave", F.floor(F.col("chunk") / chunks_per_wave))
    numbered.repartition(tasks, "wave", *group).write.partitionBy("wave").parquet(waves)
    numbered = spark.read.schema(numbered.schema).parquet(waves)
    # As many numbers as the longest cluster has waves.
    sizes = {r["wave"]: r["count"] for r in numbered.groupBy("wave").count().collect()}
    for wave in sorted(sizes):
        if _wave_rows(spark, folder, wave, asked) == sizes[wave]:
            continue
        rows = numbered.where(F.col("wave") == wave).drop("wave")
        before = _wave(spark, folder, wave - 1, asked) if wave else spark.createDataFrame([], asked)
        label = before.groupBy(*group).agg(F.max_by(F.struct("label_name", "label_text"), "chunk").alias("label")).select(
            *group, "label.*")
        placed = rows.join(label, group, "left").repartition(tasks, *group).sortWithinPartitions(*group, "chunk")
        placed.mapInPandas(_ask(group, first, following, answer, read_label), asked).write.mode("overwrite").parquet(
            f"{folder}/wave={wave}")
    if not sizes:
        return spark.createDataFrame([], asked).select(*group, "chunk", "answer")
    return spark.read.schema(asked).parquet(folder).select(*group, "chunk", "answer")


LABEL = "label_name string, label_text string"


def _wave(spark: SparkSession, folder: str, wave: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/wave={wave}")


def _wave_rows(spark: SparkSession, folder: str, wave: int, schema: StructType) -> int:
    """Rows an earlier run left; a broken one leaves none, as files appear when the write ends."""
    try:
        return _wave(spark, folder, wave, schema).count()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def _ask(group: list[str], first: str, following: str, answer, read_label):
    def filled(template, **values):
        return "".join(values[part] if is_mark else part
                       for part, is_mark in template_parts(template, values))

    def read(reply):
        try:
            return read_label(reply)
        except (ValueError, LookupError, TypeError):
            return None

    def ask(batches):
        import pandas as pd

        last_key = label = None
        for pdf in batches:
            replies, labels = [], []
            for row in pdf.to_dict("records"):
                key = tuple(row[g] for g in group)
                if key != last_key:
                    last_key = key
                    label = (row["label_name"], row["label_text"]) if isinstance(row["label_name"], str) else None
                prompt = filled(first, ideas=row["ideas"]) if label is None else filled(
                    following, ideas=row["ideas"], cluster_name=label[0],
                    cluster_description=label[1] or "")
                reply = answer(prompt)
                if found := read(reply):
                    label = found[0] or "", found[1]
                replies.append(reply)
                labels.append(label or (None, None))
            yield pd.DataFrame({**{g: pdf[g] for g in group}, "chunk": pdf["chunk"], "answer": replies,
                                "label_name": [x[0] for x in labels], "label_text": [x[1] for x in labels]})

    return ask


def label_ideas(chunked: DataFrame, answers: DataFrame, group: list[str]) -> DataFrame:
    """Join the answers (``group``, ``chunk``, ``answer``) back to the ideas by index.

    Adds ``idea_c_name``, ``idea_c_description``, the chunk's ``cluster_name`` and
    ``cluster_description``, and ``final_cluster_name``, the label of the last chunk.
    Ideas without a usable answer keep NULL labels; of an index that an answer repeats the first
    label counts.
    """
    parsed = parse_label_answer(answers, "answer")
    named = parsed.withColumn("ideas", F.transform("ideas", lambda x, i: x.withField("_turn", i)))
    once = keep_first(flatten_label_ideas(named, [*group, "chunk"]), [*group, "chunk", "index"], ["_turn"])
    labelled = (
        once.drop("_turn")
        .withColumnsRenamed({"idea_name": "idea_c_name",
                             "idea_description": "idea_c_description"})
    )
    last = parsed.groupBy(*group).agg(
        F.max_by("cluster_name", "chunk").alias("final_cluster_name"))
    return (
        chunked.join(labelled, [*group, "chunk", "index"], "left").join(last, group, "left")
    )
