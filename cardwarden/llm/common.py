"""Scratch tables, skew-proof joins and connected components for the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a fixed, small width up to which a measured side is broadcast.
BROADCAST_ROWS = 200_000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or else one below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """frame, written once to the shared folder and read from there. options: of the writer.

    Cuts the lineage: what follows survives the loss of executors without the work before it.
    """
    spark = frame.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").options(**options).parquet(path)
    kept = spark.read.schema(frame.schema).parquet(path)
    kept.stored_at = path  # for drop()
    return kept


def drop(*frames: DataFrame) -> None:
    """Delete tables that stored() wrote and nothing reads any more."""
    for frame in frames:
        spark, path = frame.sparkSession, frame.stored_at
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(docs: DataFrame, row: str | None) -> DataFrame:
    """docs with a column `row` in place of whatever else is called so: the one that is named, or else a new number.

    New numbers depend on how Spark splits the input, which may differ from one reading to the next. So they are written
    once, with doc_id and text only, and all later joins read that table; drop_numbered() deletes it. A row that
    is named must be stored already.
    """
    if row:
        return docs.withColumn("row", F.col(row))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")


def drop_numbered(rows: DataFrame, row: str | None) -> None:
    """Delete what numbered(docs, row) wrote, if it did."""
    if not row:
        drop(rows)


def small_side(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored frame of narrow rows: marked for broadcast if it has at most limit rows, else left to the planner."""
    return F.broadcast(frame) if frame.count() <= limit else frame


def salted_join(many: DataFrame, one: DataFrame, key: str | list[str], spread: str, how: str = "inner", lanes: int = 16) -> DataFrame:
    """Join on key where many may hold a third of its rows under one key.

    Rows of many are dealt over lanes by the column spread; the rows of one are repeated for each lane.
    """
    lane = "_lane"
    left = many.withColumn(lane, F.pmod(F.xxhash64(spread), F.lit(lanes)).cast("int"))
    right = one.withColumn(lane, F.explode(F.array([F.lit(i) for i in range(lanes)])))
    return left.join(right, [*([key] if isinstance(key, str) else key), lane], how).drop(lane)


def ranked(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """rows, written in this order, with `place`: 0, 1, 2 and so on over all of them.

    The rows are dealt over tasks by range. What lies before a range is known from one count per range, so no task
    sees all rows. Ties keep the order in which they were written.
    """
    numbered_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = stored(numbered_, label)
    range_ = F.shiftright("_at", 33).alias("_range")
    counts = dealt.groupBy(range_).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row per task
    starts = stored(counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start")), f"{label}-ranges")
    placed = dealt.withColumn("_range", F.shiftright("_at", 33)).join(small_side(starts), "_range")
    return placed.withColumn("place", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_range", "_start")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node that can be reached. Nodes without an edge are absent.

    Large-star and small-star steps in turn until the edges stop changing. Each step keeps, per node, a
    minimum that is aggregated before the shuffle, so that a node with very many edges is no hot group.
    """
    current = stored(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct(), "edges"
    )
    sums = None
    while True:
        both = current.unionByName(current.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("u")).agg(F.least(F.min("lo"), F.first("hi")).alias("m"))
        # large star: neighbours above u go to u's minimum
        large = (
            current.join(least, current["lo"] == least["u"])
            .select(F.col("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        # small star: neighbours below or at u, and u itself, go to u's minimum
        down = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = (
            large.join(down, large["hi"] == down["u"])
            .select(F.explode(F.array("lo", "hi")).alias("hi"), F.col("m").alias("lo"))
            .where("hi <> lo")
            .distinct()
        )
        after = stored(small, "edges")
        now = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
        drop(current)
        current = after
        if sums == tuple(now):
            break
        sums = tuple(now)
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(roots)
