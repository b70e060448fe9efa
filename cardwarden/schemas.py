"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, STRING, TIMESTAMP = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _struct(*groups: tuple[T.DataType, list[str]]) -> T.StructType:
    """Fields in order; only the transaction id is required."""
    return T.StructType(
        [T.StructField(n, t, nullable=n != "TransactionID") for t, names in groups for n in names]
    )


def _family(prefix: str, numbers, width: int = 0) -> list[str]:
    return [f"{prefix}{n:0{width}d}" for n in numbers]


# 394 columns: 4 integers, 14 strings, the rest doubles.
TRANSACTIONS = _struct(
    (LONG, ["TransactionID", "isFraud", "TransactionDT"]),
    (DOUBLE, ["TransactionAmt"]),
    (STRING, ["ProductCD"]),
    (LONG, ["card1"]),
    (DOUBLE, ["card2", "card3"]),
    (STRING, ["card4"]),
    (DOUBLE, ["card5"]),
    (STRING, ["card6"]),
    (DOUBLE, ["addr1", "addr2", "dist1", "dist2"]),
    (STRING, ["P_emaildomain", "R_emaildomain"]),
    (DOUBLE, _family("C", range(1, 15)) + _family("D", range(1, 16))),
    (STRING, _family("M", range(1, 10))),
    (DOUBLE, _family("V", range(1, 340))),
)

# 41 columns. The id_* columns are doubles but for these.
TEXT_IDENTITY_NUMBERS = {12, 15, 16, 23, 27, 28, 29, 30, 31, 33, 34, 35, 36, 37, 38}
IDENTITY = T.StructType(
    [T.StructField("TransactionID", LONG, nullable=False)]
    + [
        T.StructField(f"id_{n:02d}", STRING if n in TEXT_IDENTITY_NUMBERS else DOUBLE)
        for n in range(1, 39)
    ]
    + [T.StructField("DeviceType", STRING), T.StructField("DeviceInfo", STRING)]
)

# The 22 columns of the table the stream appends to.
STREAM_TABLE = _struct(
    (LONG, ["TransactionID", "isFraud", "TransactionDT"]),
    (DOUBLE, ["TransactionAmt"]),
    (STRING, ["ProductCD"]),
    (LONG, ["card1"]),
    (STRING, ["card4", "card6"]),
    (DOUBLE, ["addr1", "addr2", "dist1"]),
    (STRING, ["P_emaildomain", "R_emaildomain", "DeviceType", "DeviceInfo"]),
    (LONG, ["tx_hour", "tx_day_of_week", "is_late_night"]),
    (DOUBLE, ["log_tx_amt"]),
    (LONG, ["email_is_null", "device_is_null"]),
    (TIMESTAMP, ["ingested_at"]),
)

# Rows the stream could not accept, with the reason and the untouched message.
DEAD_LETTER = T.StructType(
    [
        T.StructField("reason", STRING),
        T.StructField("TransactionID", STRING),
        T.StructField("missing", T.ArrayType(STRING)),
        T.StructField("bad_fields", T.ArrayType(STRING)),
        T.StructField("value", STRING),
        T.StructField("ingested_at", TIMESTAMP),
    ]
)

# Transaction side of the joined view, in order (fixed values); the timestamp
# is put after TransactionDT.
VIEW_TRANSACTION_COLUMNS = (
    ["TransactionID", "isFraud", "TransactionDT", "transaction_timestamp", "TransactionAmt"]
    + ["ProductCD", "card1", "card2", "card3", "card4", "card5", "card6"]
    + ["addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain"]
    + _family("C", range(1, 15))
    + _family("D", [1, 2, 3, 4, 5, 10, 11, 15])
    + _family("M", range(1, 10))
    + _family("V", [1, 2, 3, 4, 5, 12, 13, 14, 15, 70, 76, 78, 82, 83])
)
# Identity side (fixed values).
VIEW_IDENTITY_COLUMNS = _family(
    "id_", [1, 2, 3, 5, 6, 9, 10, 11, 12, 15, 16, 23, 27, 28, 29, 31, 35, 36, 37, 38], 2
) + ["DeviceType", "DeviceInfo"]

LABEL = "isFraud"
KEY = "TransactionID"

# Model inputs (fixed values). The logistic model takes all of them, the
# boosted trees all but the amount bucket.
LOGISTIC_FEATURES = [
    "TransactionAmt", "log_tx_amt", "amt_bucket", "amt_decimal_part",
    "tx_hour", "tx_day_of_week", "is_late_night", "card1", "card4", "card6",
    "addr1", "dist1_is_null", "dist2_is_null", "P_emaildomain", "email_is_null",
    "email_domain_fraud_rate", "DeviceType", "device_is_null", "is_mobile",
    "card1_tx_count", "card1_avg_amt", "card1_std_amt", "card1_historical_fraud_rate",
    "amt_zscore_vs_card", "C1", "C2", "C5", "C6", "C13", "C14",
    "D1", "D4", "D10", "D15", "M4", "M5", "M6",
]
BOOSTED_FEATURES = [f for f in LOGISTIC_FEATURES if f != "amt_bucket"]
TEXT_FEATURES = ["amt_bucket", "card4", "card6", "P_emaildomain", "DeviceType", "M4", "M5", "M6"]

FEATURE_TABLE_COLUMNS = [KEY, LABEL, "ProductCD", *LOGISTIC_FEATURES]
