"""What a task holds, and what a job costs, does not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from cardwarden.sources import tables
from checks import bind, queries


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """A folder with events and orders of our own; an event id comes twice, and there are nulls."""
    root = tmp_path_factory.mktemp("given")
    i = F.col("id")
    spark.range(900).select(
        (i % 890).alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), i % 24, i % 60, i % 60)).alias("ts"),
        F.when(i % 11 != 0, i % 40).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "click", "purchase", "error"))), (i % 4 + 1).cast("int")).alias("event_type"),
        ((i * 7) % 100 + 0.25).alias("value"),
        F.concat(F.lit('{"k": '), i % 100, F.lit("}")).alias("props"),
    ).write.parquet(f"{root}/events.parquet")
    spark.range(500).select(
        i.alias("o_orderkey"), (i % 90).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority")
    ).write.parquet(f"{root}/orders.parquet")
    return str(root)


def test_the_loaded_raw_tables_have_buckets_by_size(spark, given, monkeypatch):
    monkeypatch.setattr(queries, "bucket_count", lambda *at, least: tables.bucket_count(*at, least=least, bucket_bytes=20_000))
    loaded = []
    monkeypatch.setattr(queries, "load_raw", lambda *at, **named: (loaded.append(named["buckets"]), tables.load_raw(*at, **named)))
    joined = queries.load_raw_join(spark, given)
    assert len(loaded) == 2 and loaded[0] == loaded[1] > 8
    assert joined.select("TransactionID").exceptAll(bind.transactions(spark, given).select("TransactionID")).isEmpty()
    assert joined.count() == 900


def test_parts_of_the_messages_are_written_by_several_tasks(spark, given, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda _, purpose: str(tmp_path / purpose))
    table, refused = "parts_stream", "parts_refused"
    for name in (table, refused):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    queries.ingest.create_stream_tables(spark, table, refused)
    runs = [q.lastProgress.batchId for q in queries._ingest_parts(spark, given, table, refused, str(tmp_path / "checkpoint"))]
    assert runs == [0, 1, 2, 3]
    files = [f.name for f in (tmp_path / "messages").iterdir() if f.name.startswith("part-")]
    assert len(files) > 4
    assert spark.table(table).count() + spark.table(refused).count() == 900
    batches = spark.table(table).unionByName(spark.table(refused), allowMissingColumns=True).groupBy("ingest_batch").count().collect()
    assert len(batches) == 4 and min(r["count"] for r in batches) > 0
