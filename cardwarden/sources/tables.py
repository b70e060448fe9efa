"""Tables in and out: raw loads, scans with a declared schema, views, derived tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from cardwarden import schemas
from cardwarden.session import scratch_path
from cardwarden.sources.files import Files

#: Bytes of source files for each bucket. One task holds and sorts the rows of a bucket, which take four to eight
#: times the bytes of their CSV lines.
BUCKET_BYTES = 64 << 20


def _reader(spark: SparkSession, schema: T.StructType, fmt: str) -> DataFrameReader:
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        # Compare the header with the schema by name, and stop at the first bad row.
        reader = reader.options(header=True, enforceSchema=False, mode="FAILFAST")
    return reader


def read_transactions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _reader(spark, schemas.TRANSACTIONS, fmt).load(path)


def read_identity(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _reader(spark, schemas.IDENTITY, fmt).load(path)


def load_raw(
    spark: SparkSession,
    source: str,
    table: str,
    schema: T.StructType,
    fmt: str = "csv",
    buckets: int | None = None,
) -> None:
    """Load historical files into a table.

    Load both raw tables with the same number of ``buckets`` and their join on
    the transaction id needs no shuffle; ``bucket_count`` gives one for both.
    """
    rows = _reader(spark, schema, fmt).load(source)
    materialize(rows, table, bucket_by=schemas.KEY if buckets else None, buckets=buckets)


def bucket_count(spark: SparkSession, *sources: str, least: int = 1, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are loaded from these files and joined: enough for the largest, ``least`` or more."""
    largest = max(Files(spark).size(source) for source in sources)
    return max(least, math.ceil(largest / bucket_bytes))


def register_views(frames: dict[str, DataFrame]) -> None:
    """Create or replace one lazy view per name."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def materialize(
    frame: DataFrame,
    table: str,
    partition_by: str | None = None,
    bucket_by: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Create or replace a table from a frame and return a scan of it.

    A scan knows its size, so later joins choose a broadcast from a measured
    number and not from an estimate through an aggregation.
    """
    writer = frame.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by and buckets:
        # Bring equal buckets together first, or every task writes every bucket.
        writer = (
            frame.repartition(buckets, bucket_by)
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, bucket_by)
            .sortBy(bucket_by)
        )
        if partition_by:
            writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return frame.sparkSession.table(table)


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared scratch folder, and read back.

    For a frame that several passes read and no table name is wanted: it is
    computed once, its lineage ends at the files, and it outlives lost executors.
    """
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
