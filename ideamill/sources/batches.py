"""Inserts in numbered batches with tries and a ledger, as a Python data source.

A plan is a written table: the rows with their batch number, which no later run changes. Each task gives
whole batches to the caller's insert, trying again where it fails. A batch that fails for good does not stop
the others: the task reports it, and the commit writes the finished batches to the ledger before it raises. An
aborted job writes down what its finished tasks report. The next run leaves out the batches in the ledger.

A task that is lost after an insert and before its report is run again, so an insert gets the batch number: a sink
that keeps it with the rows can refuse a batch that it has.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from time import sleep

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ideamill.operators.numbering import batch_number
from ideamill.settings import EXPORT_BATCH, task_count
from ideamill.sources.tables import written

# Fixed value: tries of a batch.
TRIES = 10
LEDGER = "batch_no long, rows long, tries long"
Insert = Callable[[int, list[dict]], None]


@dataclass
class Report(WriterCommitMessage):
    """What a task did: (batch, rows, tries) of its finished batches, (batch, error) of the others."""

    done: list[tuple[int, int, int]]
    failed: list[tuple[int, str]]


def _write_ledger(ledger: str, reports: list) -> list[tuple[int, str]]:
    """Add the finished batches to the ledger, one file a run; the batches that failed."""
    done = [row for r in reports if r for row in r.done]
    if done:
        store, path = fs.FileSystem.from_uri(ledger)
        store.create_dir(path, recursive=True)
        columns = zip(*done)
        table = pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("batch_no", "rows", "tries"), columns)})
        pq.write_table(table, f"{path}/{uuid.uuid4().hex}.parquet", filesystem=store)
    return [row for r in reports if r for row in r.failed]


class BatchWriter(DataSourceWriter):
    def __init__(self, insert: Insert, ledger: str, tries: int, pause: float):
        self.insert, self.ledger, self.tries, self.pause = insert, ledger, tries, pause

    def write(self, iterator: Iterator) -> Report:
        done, failed = [], []
        for number, rows in groupby(iterator, key=lambda row: row["batch_no"]):
            batch = [{k: v for k, v in row.asDict().items() if k != "batch_no"} for row in rows]
            for attempt in range(1, self.tries + 1):
                try:
                    self.insert(number, batch)
                except Exception as error:  # noqa: BLE001: whatever the sink raises counts as a try
                    if attempt == self.tries:
                        failed.append((number, repr(error)))
                    else:
                        sleep(self.pause)
                else:
                    done.append((number, len(batch), attempt))
                    break
        return Report(done, failed)

    def commit(self, messages: list) -> None:
        if failed := _write_ledger(self.ledger, messages):
            raise RuntimeError(f"{len(failed)} batches failed after {self.tries} tries, the first: {failed[0]}")

    def abort(self, messages: list) -> None:
        # A commit that raised has written its ledger; entries that come twice do no harm.
        _write_ledger(self.ledger, messages)


def batch_sink(insert: Insert, ledger: str, tries: int = TRIES, pause: float = 0.0) -> type[DataSource]:
    """A data source that gives its rows to insert, batch by batch."""
    class BatchSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return "ideamill_batches"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return BatchWriter(insert, ledger, tries, pause)

    return BatchSink


def batch_plan(df: DataFrame, order: list[str], rows: int = EXPORT_BATCH) -> DataFrame:
    """The rows with ``batch_no``, written: the same batches in every run of the plan."""
    return written(batch_number(df, order, rows), "batch-plan")


def inserted(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger: finished batches with their rows and tries."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger).groupBy("batch_no").agg(
            F.max("rows").alias("rows"), F.max("tries").alias("tries"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def insert_batches(plan: DataFrame, insert: Insert, ledger: str, tries: int = TRIES, pause: float = 0.0) -> None:
    """Insert the batches of a plan that are not in the ledger; raises if some fail, after all were tried."""
    spark = plan.sparkSession
    spark.dataSource.register(batch_sink(insert, ledger, tries, pause))
    open_rows = plan.join(inserted(spark, ledger).select("batch_no"), "batch_no", "left_anti")
    placed = open_rows.repartition(task_count(spark), "batch_no").sortWithinPartitions("batch_no")
    placed.write.format("ideamill_batches").mode("append").save()
