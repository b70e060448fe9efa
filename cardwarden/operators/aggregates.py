"""Per-key feature aggregates, class weights and report aggregates.

All are plain hash aggregates: partial results are built before the shuffle, so
a key that holds a third of the rows arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cardwarden.functions.features import is_late_night, tx_hour
from cardwarden.schemas import LABEL


def card_aggregates(transactions: DataFrame) -> DataFrame:
    """Count, mean, deviation and fraud rate of each card.

    The rate is NULL for a card without labelled rows.
    """
    return (
        transactions.where(F.col("card1").isNotNull())
        .groupBy("card1")
        .agg(
            F.count(F.lit(1)).alias("card1_tx_count"),
            F.avg("TransactionAmt").alias("card1_avg_amt"),
            F.stddev_samp("TransactionAmt").alias("card1_std_amt"),
            F.avg(LABEL).alias("card1_historical_fraud_rate"),
        )
    )


def email_domain_risk(transactions: DataFrame) -> DataFrame:
    """Count and fraud rate of each purchaser email domain. A blank one counts as missing, as in the flags."""
    return (
        transactions.where(F.col("P_emaildomain") != "")
        .groupBy("P_emaildomain")
        .agg(
            F.count(F.lit(1)).alias("email_tx_count"),
            F.avg(LABEL).alias("email_domain_fraud_rate"),
        )
    )


def class_weights(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight n / (k * n_c) of each class, which gives every class the same total."""
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy()  # one row per class
    total, number = F.sum("n").over(classes), F.count(F.lit(1)).over(classes)
    return counts.select(
        label, "n", (total.cast("double") / (number * F.col("n"))).alias("class_weight")
    )


def rate_by(rows: DataFrame, key: str, label: str = LABEL) -> DataFrame:
    """Rows, fraud rows and fraud rate of each group; the rate is over labelled rows."""
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(F.col(label) == 1).alias("fraud"),
        F.round(F.avg(label), 6).alias("fraud_rate"),
    )


def rate_by_product(rows: DataFrame) -> DataFrame:
    return rate_by(rows, "ProductCD")


def rate_by_risk(scores: DataFrame) -> DataFrame:
    return rate_by(scores, "risk_level", "actual_fraud")


def overall_rate(rows: DataFrame, label: str = LABEL) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(F.col(label) == 1).alias("fraud"),
        F.round(F.avg(label), 6).alias("fraud_rate"),
    )


def late_night_lift(stamped: DataFrame, label: str = LABEL) -> DataFrame:
    """Fraud rate of hours 0 to 5, of the other hours, and their ratio less one."""
    night = is_late_night(tx_hour(F.col("transaction_timestamp"))) == 1
    rates = stamped.agg(
        F.avg(F.when(night, F.col(label))).alias("night_rate"),
        F.avg(F.when(~night, F.col(label))).alias("day_rate"),
    )
    lift = F.try_divide("night_rate", "day_rate") - 1
    return rates.select(
        F.round("night_rate", 6).alias("night_rate"),
        F.round("day_rate", 6).alias("day_rate"),
        F.round(lift, 6).alias("lift"),
    )


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once. Shuffles the key column only."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


