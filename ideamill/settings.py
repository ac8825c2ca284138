"""Fixed values, session options and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date, datetime

from pyspark.sql import SparkSession

# Fixed values ---------------------------------------------------------------
MISSING_MARKS = ("", "None")
UNKNOWN_KEY = 0
OPEN_DATE = date(9999, 12, 31)
MAX_TIMESTAMP = "2262-04-11 23:47:16.854775"
NULL_SUBMIT_TIMESTAMP = "1900-01-01 00:00:00"
NO_COMPANY_NAME = "Sin nombre"
NO_TEXT = "No data"
NO_DESCRIPTION = "No description"
LOOKUP_MISS = "None"

CATEGORIES = ("Idea name", "Problem", "Solution", "Other")
NUMBERED_CATEGORIES = ("Problem", "Solution")
UNUSED_CATEGORIES = ("Other", "None", "Category: Other")

SLOTS = 6
USER_COLUMNS = 4
VECTOR_SIZE = 1536
EXPORT_BATCH = 100
CHUNK_ROWS = 5
PROMPT_TEXT_LENGTH = 800

DEFAULT_GOAL = {
    "goal_db_id": 0,
    "company_id": None,
    "goal_name": "Sin meta",
    "goal_description": "No hay meta asignada",
    "active": True,
    "ideas_reception": True,
    "is_private": False,
    "end_campaign": datetime(2021, 1, 1),
    "created_at": datetime(2021, 1, 1),
    "updated_at": datetime(2021, 1, 1),
    "valid_from": datetime(2021, 1, 1),
    "valid_to": datetime(9999, 12, 31),
    "is_current": True,
}

# Size bounds ----------------------------------------------------------------
# A group with more rows than this is numbered by range partitions, not in one task.
HOT_GROUP_ROWS = 1_000_000
# Members held in one JSON text cell; a larger group gets further cells.
MEMBERS_PER_CELL = 1_000
# Points, and bytes of their vectors, in one block of a task.
BLOCK_POINTS = 4_096
BLOCK_BYTES = 16 << 20
# Points, and bytes of their vectors, of a group whose k-means a task computes from all its blocks.
FIT_POINTS = 131_072
FIT_BYTES = 64 << 20
# A table measured to be no larger is sent to every task.
SMALL_TABLE_BYTES = 32 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options that the results and the skew handling rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even where that costs one more shuffle after the join.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ideamill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def task_count(spark: SparkSession) -> int:
    """Tasks of a shuffle that must not be merged because its rows are small."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
