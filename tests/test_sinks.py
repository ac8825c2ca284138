"""Batched inserts with a ledger, and the keyed vector table."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ideamill.sources.batches import batch_plan, insert_batches, inserted
from ideamill.sources.vector_table import bucket_of, read_vectors, upsert_vectors


def file_sink(folder):
    """An insert that fails twice for batch 1, always for batch 3 while a file stands, and keeps each call in a file."""
    def insert(number, rows):
        import json
        import uuid

        os.makedirs(folder, exist_ok=True)
        tried = f"{folder}/try-{number}-{uuid.uuid4().hex}"
        open(tried, "w").close()
        tries = sum(name.startswith(f"try-{number}-") for name in os.listdir(folder))
        if number == 1 and tries <= 2 or number == 3 and os.path.exists(f"{folder}/down"):
            raise ConnectionError(f"batch {number}")
        with open(f"{folder}/rows-{number}-{uuid.uuid4().hex}", "w") as out:
            json.dump(rows, out)

    return insert


def in_sink(folder):
    found = Counter()
    for name in os.listdir(folder):
        if name.startswith("rows-"):
            with open(f"{folder}/{name}") as rows:
                found.update((int(name.split("-")[1]), r["id"]) for r in json.load(rows))
    return found


def test_a_batch_that_fails_twice_is_in_the_sink_once(spark, tmp_path):
    folder, ledger = str(tmp_path / "sink"), str(tmp_path / "ledger")
    os.makedirs(folder)
    plan = batch_plan(spark.range(25).withColumn("text", F.lit("a")), ["id"], 10)
    insert_batches(plan, file_sink(folder), ledger)
    assert in_sink(folder) == Counter((i // 10, i) for i in range(25))
    assert sorted(map(tuple, inserted(spark, ledger).collect())) == [(0, 10, 1), (1, 10, 3), (2, 5, 1)]
    insert_batches(plan, file_sink(folder), ledger)
    assert in_sink(folder) == Counter((i // 10, i) for i in range(25))


def test_a_sink_that_is_down_gets_only_the_missing_batches_later(spark, tmp_path):
    folder, ledger = str(tmp_path / "sink"), str(tmp_path / "ledger")
    os.makedirs(folder)
    (tmp_path / "sink" / "down").touch()
    plan = batch_plan(spark.range(45), ["id"], 10)
    with pytest.raises(Exception, match="2 batches failed after 2 tries"):
        insert_batches(plan, file_sink(folder), ledger, tries=2)
    # Batch 1 needs a third try as well.
    assert {r["batch_no"] for r in inserted(spark, ledger).collect()} == {0, 2, 4}
    (tmp_path / "sink" / "down").unlink()
    insert_batches(plan, file_sink(folder), ledger, tries=3)
    assert in_sink(folder) == Counter((i // 10, i) for i in range(45))
    assert inserted(spark, ledger).count() == 5


def test_an_empty_plan_inserts_nothing(spark, tmp_path):
    insert_batches(batch_plan(spark.range(0), ["id"], 10), file_sink(str(tmp_path / "sink")), str(tmp_path / "ledger"))
    assert not (tmp_path / "sink").exists() and inserted(spark, str(tmp_path / "ledger")).isEmpty()


def test_upserts_rewrite_touched_buckets_only(spark, tmp_path):
    path, schema = str(tmp_path / "vectors"), "id string, values array<double>, turn int"
    assert read_vectors(spark, path, schema).isEmpty()

    def records(ids, turn):
        return spark.createDataFrame([(str(i), [float(i + turn)], turn) for i in ids], schema)

    upsert_vectors(records(range(100), 0), path, buckets=16)
    before = {name: os.stat(f"{path}/{name}").st_mtime_ns for name in os.listdir(path) if name.startswith("bucket=")}
    change = records([3, 4, 200], 1).unionByName(records([4], 2))
    upsert_vectors(change, path, order=["turn"], buckets=16)
    got = {r["id"]: (r["values"], r["turn"]) for r in read_vectors(spark, path, schema).collect()}
    assert read_vectors(spark, path, schema).count() == 101
    assert got == {str(i): ([float(i)], 0) for i in range(100)} | {"3": ([4.0], 1), "4": ([6.0], 2), "200": ([201.0], 1)}
    touched = {f"bucket={r[0]}" for r in change.select(bucket_of(F.col("id"), 16)).distinct().collect()}
    after = {name: os.stat(f"{path}/{name}").st_mtime_ns for name in os.listdir(path) if name.startswith("bucket=")}
    assert {n for n in after if after[n] != before.get(n)} <= touched and len(touched) < 4
    upsert_vectors(records([], 0), path, buckets=16)
    assert read_vectors(spark, path, schema).count() == 101
