"""A table of vectors by id that takes upserts: bucket folders, of which only the touched ones are rewritten."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ideamill.sources.tables import written

BUCKETS = 256


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_vectors(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, empty before its first export."""
    try:
        return spark.read.schema(f"{schema}, bucket int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, bucket int")


def upsert_vectors(records: DataFrame, path: str, key: str = "id", order: list[str] | None = None,
                   buckets: int = BUCKETS) -> None:
    """Put the records into the table at path: a known key's record is replaced, a new one added.

    Of records with the same key the last in ``order`` counts (by default any of the equal ones). Folders of buckets
    that no record touches are neither read nor written. The merged rows are a written table before the folders are
    overwritten, so a job that fails can run again. One writer at a time; ``buckets`` belongs to the table.
    """
    spark = records.sparkSession
    last = F.max_by(F.struct(*records.columns), F.struct(*(order or [key])))
    new = written(
        records.groupBy(key).agg(last.alias("row")).select("row.*").withColumn("bucket", bucket_of(F.col(key), buckets)), "records")
    # As many numbers as the table has buckets.
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
    if not touched:
        return
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields)
    old = read_vectors(spark, path, schema).where(F.col("bucket").isin(touched))
    merged = written(new.unionByName(old.join(new.select(key), key, "left_anti")), "merged")
    merged.repartition(len(touched), "bucket").write.partitionBy("bucket").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").parquet(path)
