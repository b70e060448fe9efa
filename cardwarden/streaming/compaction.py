"""Few large files in place of the many small ones that batches leave, while readers go on.

Readers use a view over the batch table. A compaction writes the rows of closed batches, those in the commit log of the stream's
checkpoint, which never run again, into one more generation of a second table, and then replaces the view: it reads the
generations up to this one, and of the batch table only what they don't have. The view is the one thing that readers see
change, so a row is there once before, during and after. Batches go when the next compaction finds them replaced, so a
reader that has begun still has its files.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardwarden.sources.files import Files
from cardwarden.streaming.ingest import BATCH_PARTITION

STREAM, BATCH = BATCH_PARTITION
GENERATION = "generation"
_CLOSED, _GENERATION = "compaction.closed", "compaction.generation"
FILE_BYTES = 128 << 20


def committed(spark: SparkSession, checkpoint: str) -> tuple[str, int]:
    """Id of the stream of a checkpoint, and its last committed batch; -1 without any."""
    files = Files(spark)
    stream = json.loads(files.text(f"{checkpoint}/metadata"))["id"]
    return stream, max((int(n) for n in files.names(f"{checkpoint}/commits") if n.isdigit()), default=-1)


def _state(spark: SparkSession, view: str) -> tuple[dict[str, int], int]:
    if not spark.catalog.tableExists(view):
        return {}, 0
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    return json.loads(found.get(_CLOSED, "{}")), int(found.get(_GENERATION, 0))


def _columns(spark: SparkSession, table: str) -> list[str]:
    return [f"`{c}`" for c in spark.table(table).columns]


def _show(spark: SparkSession, view: str, table: str, closed: dict[str, int], generation: int) -> None:
    columns = ", ".join(_columns(spark, table))
    open_ = " AND ".join(f"NOT ({STREAM} = '{s}' AND {BATCH} <= {n})" for s, n in sorted(closed.items()))
    parts = [f"SELECT {columns} FROM {table}" + (f" WHERE {open_}" if open_ else "")]
    if generation:
        parts.append(f"SELECT {columns} FROM {table}__compact WHERE {GENERATION} <= {generation}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_CLOSED}' = '{json.dumps(closed)}', '{_GENERATION}' = '{generation}') "
        f"AS {' UNION ALL '.join(parts)}"
    )


def create_read_view(spark: SparkSession, view: str, table: str) -> None:
    """The view that readers use instead of the batch table. Keeps what compactions have done."""
    _show(spark, view, table, *_state(spark, view))


def _batches(spark: SparkSession, table: str, upto: dict[str, int]) -> list[tuple[str, int]]:
    """Batch partitions of a table up to the given batch of each stream."""
    names = (r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    found = [dict(p.split("=", 1) for p in n.split("/")) for n in names]
    return sorted((f[STREAM], int(f[BATCH])) for f in found if int(f[BATCH]) <= upto.get(f[STREAM], -1))


def _drop(spark: SparkSession, table: str, batches: list[tuple[str, int]]) -> None:
    for at in range(0, len(batches), 500):
        parts = ", ".join(f"PARTITION ({STREAM} = '{s}', {BATCH} = {b})" for s, b in batches[at : at + 500])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def _rewritten(rows: DataFrame, files: int) -> DataFrame:
    """The rows in about so many files, in the order of the commit log. A large batch is several files."""
    columns = [c for c in rows.columns if c not in BATCH_PARTITION]
    return rows.repartitionByRange(files, BATCH, F.xxhash64(*columns)).sortWithinPartitions(BATCH)


def compact(spark: SparkSession, table: str, view: str, checkpoint: str, file_bytes: int = FILE_BYTES) -> int:
    """Compact the closed batches of a stream. Returns how many batches that were not yet.

    One compaction of a view at a time. One that breaks off changes nothing for readers, and the next does its work again.
    """
    stream, last = committed(spark, checkpoint)
    closed, generation = _state(spark, view)
    spark.catalog.refreshTable(table)
    _drop(spark, table, _batches(spark, table, closed))
    fresh = [b for s, b in _batches(spark, table, {stream: last}) if b > closed.get(stream, -1)]
    if not fresh:
        return 0
    home = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])["location"].rstrip("/")
    size = sum(Files(spark).size(f"{home}/{STREAM}={stream}/{BATCH}={b}") for b in fresh)
    rows = spark.table(table).where((F.col(STREAM) == stream) & F.col(BATCH).between(fresh[0], fresh[-1]))
    if not spark.catalog.tableExists(f"{table}__compact"):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        spark.sql(f"CREATE TABLE {table}__compact ({fields}, {GENERATION} int) USING parquet PARTITIONED BY ({GENERATION})")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table}__compact PARTITION ({GENERATION} = {generation + 1}) SELECT * FROM {{rows}}",
        rows=_rewritten(rows, max(1, math.ceil(size / file_bytes))),
    )
    _show(spark, view, table, closed | {stream: last}, generation + 1)
    return len(fresh)
