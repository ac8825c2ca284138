"""Incremental dimension loads from a landing folder, safe to replay."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Rows = Callable[[DataFrame, DataFrame], DataFrame]
# The folders a batch is stored under: the run that loaded it and its number there.
BATCH_COLUMNS = "load_run string, load_batch long"


def read_landing(spark: SparkSession, path: str, schema: str, clean: str = "off",
                 archive: str | None = None, array_files: bool = False) -> DataFrame:
    """Stream of landed JSON records; each file is used once.

    ``clean`` is 'off', 'delete' or 'archive': what happens to a file after its batch.
    """
    reader = spark.readStream.schema(schema).option("multiLine", array_files).option(
        "cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.json(path)


def loaded_rows(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """The target table, empty before its first load."""
    schema = f"{schema}, {BATCH_COLUMNS}"
    typed = spark.read.schema(schema)
    try:
        return typed.parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_stream(landing: DataFrame, target: str, schema: str, checkpoint: str, rows: Rows
                ) -> StreamingQuery:
    """Append the new rows of all landed files to the target and stop when none is left.

    ``rows(batch, loaded)`` gives the rows to append. Each batch owns one folder of the target,
    named by the id in the checkpoint and its number, and overwrites it when it is replayed after
    a failure, so a key is loaded once. A new checkpoint has a new id: it starts at batch 0 again
    but leaves the folders of other runs alone and counts their rows as loaded.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        run = _run_id(spark, checkpoint)
        loaded = loaded_rows(spark, target, schema).where(
            (F.col("load_run") != run) | (F.col("load_batch") != number))
        rows(batch, loaded.drop("load_run", "load_batch")).write.mode("overwrite").parquet(
            f"{target}/load_run={run}/load_batch={number}")

    return (
        landing.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


@dataclass(frozen=True)
class Target:
    """A table of a common load. ``rows(batch, loaded)`` gives its new rows; loaded maps the names of
    all targets to their loaded rows, those of earlier targets with what this batch adds to them."""

    path: str
    schema: str
    rows: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]


def visible_rows(spark: SparkSession, target: Target, manifest: str) -> DataFrame:
    """The rows of the batches that the manifest names: those that all targets have whole."""
    whole = loaded_rows(spark, manifest, "targets int").select("load_run", "load_batch").distinct()
    return loaded_rows(spark, target.path, target.schema).join(whole, ["load_run", "load_batch"], "left_semi")


def load_targets(landing: DataFrame, targets: dict[str, Target], manifest: str, checkpoint: str) -> StreamingQuery:
    """Load each batch into several targets as a unit, and stop when no landed file is left.

    A batch writes its folder of every target in turn and then its row of the manifest. Readers see the
    batches in the manifest only, so a batch that stopped between two targets is not seen; its replay has
    the same run and number and overwrites what is there. Each key is loaded once.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        run = _run_id(spark, checkpoint)
        place = f"load_run={run}/load_batch={number}"
        other = (F.col("load_run") != run) | (F.col("load_batch") != number)
        loaded = {name: visible_rows(spark, t, manifest).where(other).drop("load_run", "load_batch")
                  for name, t in targets.items()}
        batch.persist()
        for name, target in targets.items():
            folder = f"{target.path}/{place}"
            target.rows(batch, loaded).write.mode("overwrite").parquet(folder)
            loaded[name] = loaded[name].unionByName(spark.read.schema(target.schema).parquet(folder))
        spark.createDataFrame([(len(targets),)], "targets int").coalesce(1).write.mode("overwrite").parquet(
            f"{manifest}/{place}")
        batch.unpersist()

    return (
        landing.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
