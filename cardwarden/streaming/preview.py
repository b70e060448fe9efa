"""A readable preview of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def amount_text(amount: Column) -> Column:
    """A dollar amount in plain digits, also from ten million up, where a cast
    to text switches to an exponent."""
    plain = F.regexp_replace(amount.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    large = (F.abs(amount) >= 1e7) & (F.abs(amount) < 1e16)
    return F.concat(F.lit("$"), F.when(large, plain).otherwise(amount.cast("string")))


def preview(rows: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order, with labels in place of flags."""
    columns = [
        F.col("TransactionID"),
        F.when(F.coalesce(F.col("isFraud"), F.lit(0)) != 0, "FRAUD").otherwise("Legit").alias("label"),
        amount_text(F.col("TransactionAmt")).alias("amount"),
        F.col("ProductCD"),
        F.col("card4"),
        F.col("P_emaildomain"),
        F.col("DeviceType"),
        F.col("tx_hour"),
        F.when(F.coalesce(F.col("is_late_night"), F.lit(0)) != 0, "Late night")
        .otherwise("Daytime")
        .alias("time_of_day"),
    ]
    if "ingested_at" in rows.columns:
        columns.append(F.col("ingested_at"))
    return rows.orderBy(*order_by).limit(n).select(*columns)
