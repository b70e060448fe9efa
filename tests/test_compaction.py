"""Compaction of closed batches, and counters that last: before, during, after, and after failures."""

import json

import pytest
from pyspark.sql import functions as F

from cardwarden.sources.files import Files
from cardwarden.sources.messages import read_messages
from cardwarden.streaming import compaction, ingest
from cardwarden.streaming.counters import (
    CounterWriter, counter_totals, create_counter_table, fill_counters, wait_for_batch,
)
from checks import bind
from tests.conftest import SMALL

TABLES = ("many_files", "refused_files", "counters")
VIEW = "all_rows"


@pytest.fixture
def job(spark, tmp_path):
    """Ingests messages [first, last) as one batch per call."""
    drop = [*TABLES, f"{TABLES[0]}__compact"]
    for name in drop:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP VIEW IF EXISTS {VIEW}")
    ingest.create_stream_tables(spark, *TABLES[:2])
    compaction.create_read_view(spark, VIEW, TABLES[0])
    messages = bind.messages(spark, SMALL)

    def run(first, last, checkpoint="checkpoint"):
        folder = tmp_path / f"in-{checkpoint}"
        messages.where(F.col("event_id").between(first, last - 1)).select("value").coalesce(1).write.mode("append").text(str(folder))
        query = ingest.start_ingest(read_messages(spark, str(folder)), *TABLES[:2], str(tmp_path / checkpoint), available_now=True)
        query.awaitTermination()
        for name in TABLES[:2]:
            spark.catalog.refreshTable(name)
        return query

    run.checkpoint = str(tmp_path / "checkpoint")
    yield run
    spark.sql(f"DROP VIEW IF EXISTS {VIEW}")
    for name in drop:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _files(spark):
    """Part files of both tables."""
    out = 0
    for name in (TABLES[0], f"{TABLES[0]}__compact"):
        if spark.catalog.tableExists(name):
            home = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])["location"]
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(home)
            found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(hadoop, True)
            while found.hasNext():
                out += found.next().getPath().getName().startswith("part-")
    return out


def _rows(frame):
    return sorted(str((r.TransactionID, r.TransactionAmt, r.ingest_batch)) for r in frame.collect())


def test_readers_see_the_same_rows_before_during_and_after(spark, job):
    for k in range(6):
        job(100 * k, 100 * k + 100)
    before, files = _rows(spark.table(VIEW)), _files(spark)
    during = spark.table(VIEW)  # planned before the compaction, read after it
    during_rows = during.where("TransactionAmt > 0")
    assert compaction.compact(spark, TABLES[0], VIEW, job.checkpoint) == 6
    assert _rows(spark.table(VIEW)) == before == _rows(during) and during_rows.count() > 0
    # nothing new; the small files go now
    assert compaction.compact(spark, TABLES[0], VIEW, job.checkpoint) == 0
    assert _rows(spark.table(VIEW)) == before
    assert _files(spark) < files and _files(spark) == 1
    # later batches are there at once, and join the next generation
    job(600, 700)
    job(700, 800)
    now = _rows(spark.table(VIEW))
    assert len(now) > len(before) and set(before) < set(now)
    assert compaction.compact(spark, TABLES[0], VIEW, job.checkpoint) == 2
    compaction.compact(spark, TABLES[0], VIEW, job.checkpoint)
    assert _rows(spark.table(VIEW)) == now and _files(spark) == 2


def test_a_compaction_that_breaks_changes_nothing(spark, job, monkeypatch):
    for k in range(3):
        job(100 * k, 100 * k + 100)
    before = _rows(spark.table(VIEW))
    with monkeypatch.context() as patch:
        def broken(*args):
            raise OSError("before the view")

        patch.setattr(compaction, "_show", broken)
        with pytest.raises(OSError):
            compaction.compact(spark, TABLES[0], VIEW, job.checkpoint)
    assert _rows(spark.table(VIEW)) == before
    job(300, 400)
    now = _rows(spark.table(VIEW))
    assert compaction.compact(spark, TABLES[0], VIEW, job.checkpoint) == 4
    assert _rows(spark.table(VIEW)) == now


def test_only_committed_batches_and_only_this_stream(spark, job, tmp_path):
    job(0, 100)
    job(100, 200)
    job(200, 300, checkpoint="other")
    # the second batch lost its commit: it will run again
    commits = tmp_path / "checkpoint" / "commits"
    (commits / "1").unlink()
    (commits / ".1.crc").unlink(missing_ok=True)
    before = _rows(spark.table(VIEW))
    assert compaction.compact(spark, TABLES[0], VIEW, job.checkpoint) == 1
    job(300, 400)  # runs batch 1 again, then batch 2
    now = _rows(spark.table(VIEW))
    assert set(before) <= set(now) and len(now) == len(set(now))
    assert compaction.compact(spark, TABLES[0], VIEW, str(tmp_path / "other")) == 1
    assert compaction.compact(spark, TABLES[0], VIEW, job.checkpoint) == 2
    compaction.compact(spark, TABLES[0], VIEW, job.checkpoint)
    assert _rows(spark.table(VIEW)) == now


def test_files_are_in_the_order_of_the_commits_and_of_the_size_asked(spark, job):
    for k in range(4):
        job(250 * k, 250 * k + 250)
    rows = spark.table(VIEW).count()
    compaction.compact(spark, TABLES[0], VIEW, job.checkpoint, file_bytes=8_000)
    parts = spark.table(f"{TABLES[0]}__compact").groupBy(F.input_file_name().alias("f")).agg(F.min("ingest_batch").alias("a"), F.max("ingest_batch").alias("b")).orderBy("f").collect()
    assert len(parts) > 4 and sum(1 for _ in parts) < rows
    assert all(x.b <= y.a for x, y in zip(parts, parts[1:]))


def test_counters_outlive_the_query_and_a_lost_report(spark, job):
    create_counter_table(spark, TABLES[2])
    listener = CounterWriter(spark, TABLES[2])
    spark.streams.addListener(listener)
    try:
        for k in range(2):
            query = job(300 * k, 300 * k + 300)
            wait_for_batch(spark, TABLES[2], str(query.id), query.lastProgress.batchId)
    finally:
        spark.streams.removeListener(listener)
    job(600, 1000)  # nobody listens
    want = {r.route: r.messages for r in ingest.stream_totals(ingest.route_messages(bind.messages(spark, SMALL))).collect()}
    assert sum(r.messages for r in counter_totals(spark, TABLES[2]).collect()) == 600
    assert fill_counters(spark, TABLES[2], *TABLES[:2], job.checkpoint) == 1
    assert fill_counters(spark, TABLES[2], *TABLES[:2], job.checkpoint) == 0
    spark.catalog.refreshTable(TABLES[2])
    assert {r.route: r.messages for r in counter_totals(spark, TABLES[2]).collect()} == want
    assert Files(spark).exists(job.checkpoint)
    with pytest.raises(ValueError, match="does not exist"):
        CounterWriter(spark, "no_table")
    with pytest.raises(TimeoutError):
        wait_for_batch(spark, TABLES[2], "none", 0, seconds=0)
