"""The counters of ingest in a table, a row for each batch, so that they outlive the query."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from cardwarden.streaming.compaction import committed
from cardwarden.streaming.ingest import BATCH_PARTITION, ROUTES, create_batch_table, write_batch

COUNTERS = StructType([StructField(c, LongType()) for c in ("messages", *ROUTES)])
STREAM, BATCH = BATCH_PARTITION


def create_counter_table(spark: SparkSession, table: str) -> None:
    create_batch_table(spark, table, COUNTERS)


class CounterWriter(StreamingQueryListener):
    """Writes the observed metrics of each batch into its own partition of a table.

    Add it with ``spark.streams.addListener`` before ingest starts. A batch that is reported again replaces its row.
    """

    def __init__(self, spark: SparkSession, table: str, metrics: str = "ingest") -> None:
        if not spark.catalog.tableExists(table):
            raise ValueError(f"table {table} does not exist; the listener does not create it")
        self._spark, self._table, self._metrics = spark, table, metrics

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self._metrics)
        if found is not None:
            row = self._spark.createDataFrame([tuple(found[c] for c in COUNTERS.names)], COUNTERS)
            write_batch(row.coalesce(1), self._table, str(progress.id), progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def wait_for_batch(spark: SparkSession, table: str, stream: str, batch_id: int, seconds: float = 60) -> None:
    """Wait until the table has the row of a batch: reports come after the batch, on their own thread."""
    until = time.monotonic() + seconds
    while True:
        spark.catalog.refreshTable(table)
        if not spark.table(table).where((F.col(STREAM) == stream) & (F.col(BATCH) == batch_id)).isEmpty():
            return
        if time.monotonic() > until:
            raise TimeoutError(f"no counters of batch {batch_id} after {seconds} seconds")
        time.sleep(0.2)


def fill_counters(spark: SparkSession, counters: str, table: str, dead_letters: str, checkpoint: str) -> int:
    """Count what the output tables hold of committed batches that have no row, and write it. Returns how many there were.

    A driver that is lost between a batch's commit and its report leaves such a batch. Call it before batches are compacted.
    """
    stream, last = committed(spark, checkpoint)
    for name in (counters, table, dead_letters):
        spark.catalog.refreshTable(name)
    known = spark.table(counters).where(F.col(STREAM) == stream).select(BATCH)
    outcomes = spark.table(table).select(*BATCH_PARTITION, F.lit("valid").alias("route")).unionByName(
        spark.table(dead_letters).select(*BATCH_PARTITION, F.col("reason").alias("route"))
    )
    counted = (
        outcomes.where((F.col(STREAM) == stream) & (F.col(BATCH) <= last))
        .join(F.broadcast(known), BATCH, "left_anti")  # a number per batch
        .groupBy(BATCH)
        .agg(F.count(F.lit(1)).alias("messages"), *[F.count_if(F.col("route") == r).alias(r) for r in ROUTES])
    )
    rows = counted.collect()  # a row per batch
    for r in rows:
        row = spark.createDataFrame([tuple(r[c] for c in COUNTERS.names)], COUNTERS)
        write_batch(row.coalesce(1), counters, stream, r[BATCH])
    return len(rows)


def counter_totals(spark: SparkSession, table: str) -> DataFrame:
    """Messages per route over all batches."""
    totals = spark.table(table).agg(*[F.sum(r).alias(r) for r in ROUTES])
    each = F.array(*[F.struct(F.lit(r).alias("route"), F.coalesce(r, F.lit(0)).alias("messages")) for r in ROUTES])
    return totals.select(F.inline(each))
