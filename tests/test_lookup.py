"""The hot-key join gives a plain left join's rows, and spreads the load."""

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.aggregates import card_aggregates
from cardwarden.operators.lookup import attach_by_key

# Key 1 holds a third of all rows, a quarter has no key, the rest is thin.
ROWS = 12_000


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(ROWS).select(
        F.col("id").alias("TransactionID"),
        F.expr(
            "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 4 = 0 THEN NULL ELSE 10 + id % 700 END"
        ).alias("card1"),
        (F.col("id") % 97).cast("double").alias("TransactionAmt"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 2)).alias("isFraud"),
    )


@pytest.mark.parametrize("hot_share", [1e-4, 0.01, 1.0])
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_same_rows_as_a_left_join(spark, rows, hot_share, broadcast):
    lookup = card_aggregates(rows).where("card1 % 10 <> 7")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = attach_by_key(
            rows, lookup, "card1", "card1_tx_count", "TransactionID", hot_share=hot_share
        )
        want = rows.join(lookup, "card1", "left").select(*got.columns)
        assert got.count() == ROWS
        assert got.exceptAll(want).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_lookup(spark, rows):
    lookup = card_aggregates(rows.limit(0))
    got = attach_by_key(rows, lookup, "card1", "card1_tx_count", "TransactionID")
    assert got.count() == ROWS
    assert got.where("card1_tx_count IS NOT NULL").isEmpty()


def test_no_task_gets_the_hot_key(spark, rows):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lookup = card_aggregates(rows)

        def largest(frame):
            # Use a joined column, or the optimizer drops the join.
            sizes = frame.groupBy(F.spark_partition_id().alias("p")).agg(
                F.count(F.lit(1)).alias("n"), F.max("card1_tx_count").alias("used")
            )
            return sizes.where("used > 0").agg(F.max("n")).first()[0]

        joined = attach_by_key(
            rows, lookup, "card1", "card1_tx_count", "TransactionID", hot_share=0.01
        )
        assert largest(joined) < 2 * ROWS / 16
        assert largest(rows.join(lookup, "card1", "left")) > ROWS / 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_share_must_be_a_share(rows):
    with pytest.raises(ValueError):
        attach_by_key(rows, rows, "card1", "card1", "TransactionID", hot_share=0)
