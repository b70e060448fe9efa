"""Card history, out-of-fold rates, stream dedup and bounded reads: edges, skew, restarts."""

import statistics

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.history import (
    attach_card_history, attach_out_of_fold, card_history, out_of_fold_rates,
)
from cardwarden.plans.feature_tables import feature_frame, unbiased_feature_frame
from cardwarden.sources.messages import read_messages
from cardwarden.sources.tables import stored
from cardwarden.streaming import ingest
from cardwarden.streaming.bounded import take_messages
from cardwarden.streaming.dedup import start_dedup
from checks import bind
from tests.conftest import SMALL

ROW = "TransactionID long, card1 long, TransactionDT long, TransactionAmt double, isFraud long"


def _history(spark, rows, **options):
    frame = spark.createDataFrame(rows, ROW)
    known = attach_card_history(frame, stored(card_history(frame, **options), "history"))
    return {r.TransactionID: r for r in known.collect()}


def test_ties_nulls_and_first_rows(spark):
    rows = [
        (1, 7, 100, 10.0, 1), (2, 7, 100, 30.0, 0), (3, 7, 200, 50.0, None), (4, 7, 90_000, None, 0),
        (5, 7, 200_000, 1.0, 1), (6, None, 100, 5.0, 1), (7, 7, None, 5.0, 1), (8, 8, 150, 5.0, 0),
    ]
    got = _history(spark, rows)
    assert len(got) == len(rows)
    facts = {i: (r.card1_tx_count, r.card1_avg_amt, r.card1_historical_fraud_rate) for i, r in got.items()}
    assert facts[1] == facts[2] == facts[8] == (0, None, None)
    assert facts[3] == (2, 20.0, 0.5)
    assert facts[4] == (3, 30.0, 0.5)
    assert facts[5] == (4, 30.0, pytest.approx(1 / 3))
    assert facts[6] == facts[7] == (None, None, None)
    assert got[3].card1_std_amt == pytest.approx(statistics.stdev([10, 30]))
    assert got[5].card1_std_amt == pytest.approx(20.0)
    assert got[1].card1_std_amt is None


@pytest.mark.parametrize("block", [1, 7, 10**9])
def test_blocks_do_not_change_the_history(spark, block):
    rows = [(i, i % 3, (i * 37) % 50, (i * 7919) % 100 / 7, i % 2) for i in range(200)]
    got = _history(spark, rows, block=block)
    for i, card, time, _, _ in rows:
        before = [r for r in rows if r[1] == card and r[2] < time]
        assert got[i].card1_tx_count == len(before)
        if len(before) > 1:
            assert got[i].card1_std_amt == pytest.approx(statistics.stdev(r[3] for r in before), abs=1e-3)
            assert got[i].card1_historical_fraud_rate == pytest.approx(statistics.mean(r[4] for r in before))


def test_equal_amounts_have_no_deviation(spark):
    got = _history(spark, [(i, 1, i, 0.1, 0) for i in range(50)])
    assert {r.card1_std_amt for r in got.values()} == {None, 0.0}


def test_a_hot_card_is_many_tasks(spark):
    """A card with half of all rows: its history is dealt by block, and its rows to many tasks."""
    n = 20_000
    rows = spark.range(n).select(
        F.col("id").alias("TransactionID"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") + 10).cast("long").alias("card1"),
        (F.col("id") * 100).alias("TransactionDT"),
        F.lit(1.0).alias("TransactionAmt"),
        F.lit(0).cast("long").alias("isFraud"),
    )
    sizes = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        known = attach_card_history(rows, stored(card_history(rows), "history"))
        assert known.where("card1 = 1").agg(F.max("card1_tx_count")).first()[0] == n // 2 - 1
        tasks = known.where("card1 = 1").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in tasks) < n // 4
        # a block of a card is a window of its own
        blocks = rows.groupBy("card1", F.floor(F.col("TransactionDT") / 86_400)).count()
        assert blocks.agg(F.max("count")).first()[0] < 1_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", sizes)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_row_never_sees_its_own_label(spark):
    rows = [(i, i % 4, i, 1.0, i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, ROW)
    rates = {}
    for flip in (None, 17):
        changed = frame.withColumn("isFraud", F.when(F.col("TransactionID") == flip, 1 - F.col("isFraud")).otherwise(F.col("isFraud"))) if flip else frame
        known = attach_out_of_fold(changed, out_of_fold_rates(changed, "card1", "rate"), "card1")
        rates[flip] = {r.TransactionID: r.rate for r in known.collect()}
    assert rates[None][17] == rates[17][17]
    same_card = [i for i, card, *_ in rows if card == 17 % 4 and i % 5 != 17 % 5]
    assert all(rates[None][i] != rates[17][i] for i in same_card)
    # a key that only one fold has
    lone = spark.createDataFrame([(5, 1, 1, 1.0, 1), (10, 1, 1, 1.0, 1), (1, None, 1, 1.0, 1)], ROW)
    assert {r.rate for r in attach_out_of_fold(lone, out_of_fold_rates(lone, "card1", "rate"), "card1").collect()} == {None}


def test_unbiased_features_have_the_same_columns(spark, features):
    frame = unbiased_feature_frame(bind.transactions(spark, SMALL), bind.identity(spark, SMALL))
    assert frame.columns == features.columns and frame.dtypes == feature_frame(
        bind.transactions(spark, SMALL), bind.identity(spark, SMALL)).dtypes
    assert frame.count() == features.count()


# Streams --------------------------------------------------------------------------

RECORD = "TransactionID long, TransactionDT long, ingested_at timestamp, TransactionAmt double"


def _dedup(spark, folder, table, checkpoint, delay="100 seconds"):
    source = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(folder)
    query = start_dedup(source, table, checkpoint, delay=delay, stream=table, available_now=True)
    query.awaitTermination()
    spark.catalog.refreshTable(table)
    return query


def _put(spark, folder, rows):
    spark.createDataFrame([(i, t, None, float(a)) for i, t, a in rows], RECORD).coalesce(1).write.mode("append").parquet(folder)


def test_repeats_late_rows_and_restart(spark, tmp_path):
    folder, checkpoint, table = str(tmp_path / "in"), str(tmp_path / "checkpoint"), "unique_records"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    ingest.create_batch_table(spark, table, spark.createDataFrame([], RECORD).schema)
    _put(spark, folder, [(1, 1000, 1), (2, 1010, 1), (1, 1020, 2)])
    _dedup(spark, folder, table, checkpoint)
    got = {r.TransactionID: r.TransactionAmt for r in spark.table(table).collect()}
    assert set(got) == {1, 2}

    # the ids outlive the restart; 3 is out of order within the delay
    _put(spark, folder, [(2, 1030, 9), (3, 950, 1)])
    _dedup(spark, folder, table, checkpoint)
    assert sorted(r.TransactionID for r in spark.table(table).collect()) == [1, 2, 3]

    # event time goes on: what is older than the watermark is dropped, and an id that was forgotten is new again
    _put(spark, folder, [(4, 5000, 1)])
    _dedup(spark, folder, table, checkpoint)
    _put(spark, folder, [(5, 1000, 1), (1, 5001, 3)])
    query = _dedup(spark, folder, table, checkpoint)
    assert sorted(r.TransactionID for r in spark.table(table).collect()) == [1, 1, 2, 3, 4]
    dropped = [s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators]
    assert sum(dropped) == 1

    # the last batch again, as after a failure before its commit
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    _dedup(spark, folder, table, checkpoint)
    assert sorted(r.TransactionID for r in spark.table(table).collect()) == [1, 1, 2, 3, 4]
    spark.sql(f"DROP TABLE {table}")


def test_exactly_n_messages_over_batches_and_restarts(spark, tmp_path):
    folder, checkpoint, table = str(tmp_path / "in"), str(tmp_path / "checkpoint"), "bounded_messages"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    schema = spark.createDataFrame([], "value string").schema
    ingest.create_batch_table(spark, table, schema)

    def put(first, n):
        spark.range(first, first + n).selectExpr("CAST(id AS STRING) AS value").coalesce(1).write.mode("append").text(folder)

    def take():
        return take_messages(read_messages(spark, folder, max_files_per_trigger=1), 25, table, checkpoint, table)

    put(0, 10)
    assert take() == 10
    put(10, 10)
    put(20, 10)
    put(30, 10)
    assert take() == 25
    assert take() == 25
    put(40, 10)
    assert take() == 25
    values = [int(r.value) for r in spark.table(table).collect()]
    assert len(set(values)) == 25 and set(range(20)) <= set(values)
    spark.sql(f"DROP TABLE {table}")


def test_jobs_refuse_absent_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="does not exist"):
        take_messages(read_messages(spark, str(tmp_path / "in")), 1, "no_table", str(tmp_path / "c"))
    records = spark.readStream.schema(RECORD).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="does not exist"):
        start_dedup(records, "no_table", str(tmp_path / "c"))
