"""Bind the given tables to transactions, identity, messages and requests.

Events become transactions, orders become identity records. The expressions in
``EVENT_COLUMNS`` and ``IDENTITY_COLUMNS`` are SQL that Spark and DuckDB read
alike, so both engines start from the same rows; everything computed from those
rows is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardwarden import schemas
from cardwarden.functions import features as fx
from cardwarden.functions.risk import label_probabilities
from cardwarden.operators.scoring import PREDICTED, PROBS

# Event columns the expressions below use: event_id, secs, k, user_id, value, event_type.
EVENTS_SPARK = """
    SELECT event_id, user_id, event_type, value,
           timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS secs,
           CAST(get_json_object(props, '$.k') AS BIGINT) AS k
    FROM {events}
"""
EVENTS_DUCKDB = """
    SELECT event_id, user_id, event_type, value,
           epoch_us(ts) // 1000000 AS secs,
           CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
    FROM events
"""


def _cases(subject: str, values: list[str | None]) -> str:
    whens = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)
    )
    return f"CASE {subject} {whens} END"


EMAILS = ["gmail.com"] * 4 + ["yahoo.com", "hotmail.com", "outlook.com", "anonymous.com", "", None]
EVENT_COLUMNS = {
    "TransactionID": "event_id",
    # Events with a small k have no label yet.
    "isFraud": (
        "CAST(CASE WHEN k < 5 THEN NULL WHEN event_type = 'error' AND value >= 60 THEN 1 "
        "WHEN event_type = 'purchase' AND k >= 92 THEN 1 ELSE 0 END AS BIGINT)"
    ),
    "TransactionDT": f"secs - {fx.DATA_EPOCH}",
    "TransactionAmt": "value",
    "ProductCD": (
        "CASE event_type WHEN 'view' THEN 'W' WHEN 'click' THEN 'C' WHEN 'purchase' THEN 'H' "
        "WHEN 'error' THEN 'R' ELSE 'S' END"
    ),
    "card1": "NULLIF(user_id, 0)",
    "card2": "CAST(100 + k AS DOUBLE)",
    "card3": "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(150 AS DOUBLE) END",
    "card4": _cases("user_id % 4", ["visa", "mastercard", "american express", "discover"]),
    "card5": "CAST(100 + user_id % 140 AS DOUBLE)",
    "card6": _cases("user_id % 2", ["credit", "debit"]),
    "addr1": "CASE WHEN k < 20 THEN NULL ELSE CAST(100 + user_id AS DOUBLE) END",
    "addr2": "CASE WHEN k % 2 = 0 THEN NULL ELSE CAST(87 AS DOUBLE) END",
    "dist1": "CASE WHEN k % 5 < 3 THEN NULL ELSE value * 2 END",
    "dist2": "CASE WHEN k % 10 < 9 THEN NULL ELSE value * 3 END",
    "P_emaildomain": _cases("k % 10", EMAILS),
    "R_emaildomain": _cases("(k + user_id) % 10", EMAILS),
    **{f"C{n}": f"CAST((k + {n}) % {n + 3} AS DOUBLE)" for n in range(1, 15)},
    **{
        f"D{n}": f"CASE WHEN (k + {n}) % 7 = 0 THEN NULL ELSE CAST((k * {n}) % 100 AS DOUBLE) END"
        for n in range(1, 16)
    },
    **{f"M{n}": _cases(f"(k + {n}) % 3", ["T", "F", None]) for n in range(1, 10)},
    **{
        f"V{n}": f"CAST((k * {n}) % 11 AS DOUBLE)"
        for n in (int(c[1:]) for c in schemas.VIEW_TRANSACTION_COLUMNS if c.startswith("V"))
    },
}
ORDERS_DUCKDB = "SELECT * FROM orders"
IDENTITY_COLUMNS = {
    "TransactionID": "2 * o_orderkey",  # every other transaction has no identity record
    **{
        f"id_{n:02d}": (
            _cases(f"(o_custkey + {n}) % 3", ["Found", "NotFound", None])
            if n in schemas.TEXT_IDENTITY_NUMBERS
            else f"CASE WHEN (o_custkey + {n}) % 5 = 0 THEN NULL "
            f"ELSE CAST((o_custkey * {n}) % 97 AS DOUBLE) END"
        )
        for n in range(1, 39)
    },
    "DeviceType": _cases(
        "CAST(substr(o_orderpriority, 1, 1) AS INT)", ["", "desktop", "mobile", "desktop", "", None]
    ),
    "DeviceInfo": "substr(o_orderpriority, 3)",
}

# Two fixed linear scores that stand in for fitted models where a result must
# be computable on both sides: intercept and weights.
FIXED_SCORES = {
    "XGBoost": (
        -3.2,
        {
            "TransactionAmt": 0.006,
            "amt_zscore_vs_card": 0.35,
            "card1_historical_fraud_rate": 6.0,
            "email_domain_fraud_rate": 5.0,
            "is_late_night": 0.4,
            "is_mobile": 0.3,
        },
    ),
    "Logistic Regression": (
        -2.4,
        {"log_tx_amt": 0.25, "card1_historical_fraud_rate": 8.0, "tx_day_of_week": 0.05},
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table. One file of one row group is a single task, however many cores there are, so a table
    of fewer files than cores is spread over them."""
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return frame if len(frame.inputFiles()) >= cores else frame.repartition(cores)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EVENTS_SPARK, events=_table(spark, sf_dir, "events"))


def _typed(expressions: dict[str, str], schema: StructType) -> list[str]:
    return [
        f"CAST({expressions.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema
    ]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 394 declared columns; those outside the joined view are NULL."""
    return events(spark, sf_dir).selectExpr(*_typed(EVENT_COLUMNS, schemas.TRANSACTIONS))


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.selectExpr(*_typed(IDENTITY_COLUMNS, schemas.IDENTITY))


def fixed_predict(rows: DataFrame, name: str = "XGBoost") -> DataFrame:
    """Predictions of a fixed score, in the shape that a fitted model's have."""
    intercept, weights = FIXED_SCORES[name]
    logit = F.lit(intercept)
    for column, weight in weights.items():
        logit = logit + F.lit(weight) * F.col(column)
    return (
        rows.withColumn("_p", 1 / (1 + F.exp(-logit)))
        .withColumns(
            {
                PREDICTED: F.when(F.col("_p") > 0.5, 1).otherwise(0).cast("bigint"),
                PROBS: label_probabilities(F.col("_p")),
            }
        )
        .drop("_p")
    )


# Messages come in fifteen shapes, told apart by the event id.
MESSAGE_SHAPES = 15
MALFORMED_SHAPES = (1, 6, 7, 11, 12)
_DEVICE = _cases("user_id % 3", ["desktop", "mobile", None])


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields a message carries, before they are written as text."""
    tx = events(spark, sf_dir).select(
        "event_id",
        F.timestamp_seconds("secs").alias("ts"),
        *[F.expr(sql).alias(c) for c, sql in EVENT_COLUMNS.items()],
        F.expr(_DEVICE).alias("DeviceType"),
    )
    return tx.select(
        "event_id",
        "TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD",
        "card1", "card2", "card3", "card4", "card5", "card6",
        "addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain",
        "C1", "C2", "C3", "C4", "C5", "C6", "C13", "C14",
        "DeviceType", F.lit("Windows").alias("DeviceInfo"),
        fx.tx_hour(F.col("ts")).alias("tx_hour"),
        fx.tx_day_of_week(F.col("ts")).alias("tx_day_of_week"),
        fx.is_late_night(fx.tx_hour(F.col("ts"))).alias("is_late_night"),
        fx.log_tx_amt(F.col("TransactionAmt")).alias("log_tx_amt"),
        fx.is_blank(F.col("P_emaildomain")).alias("email_is_null"),
        fx.is_blank(F.col("DeviceType")).alias("device_is_null"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ingested_at"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, some of them broken in known ways."""
    rows = message_rows(spark, sf_dir)
    shaped = ["event_id", "TransactionID", "TransactionAmt", "ProductCD", "addr1"]
    rest = F.to_json(
        F.struct(*[c for c in rows.columns if c not in shaped]), {"ignoreNullFields": "false"}
    )
    return (
        rows.withColumns({"shape": F.col("event_id") % MESSAGE_SHAPES, "rest": rest})
        .selectExpr(
            "event_id",
            "shape",
            """concat(
                '{"TransactionID": ',
                CASE shape WHEN 4 THEN concat('"', TransactionID, '"')
                    WHEN 5 THEN concat('"tx', TransactionID, '"') ELSE CAST(TransactionID AS STRING) END,
                ', "TransactionAmt": ',
                CASE shape WHEN 3 THEN '0' WHEN 8 THEN concat('" ', TransactionAmt, ' "')
                    WHEN 9 THEN 'null' ELSE CAST(TransactionAmt AS STRING) END,
                CASE shape WHEN 2 THEN ', "ProductCD": ""' WHEN 9 THEN ''
                    ELSE concat(', "ProductCD": "', ProductCD, '"') END,
                ', "addr1": ',
                CASE shape WHEN 10 THEN '"n/a"' ELSE coalesce(CAST(addr1 AS STRING), 'null') END,
                ', ', CASE shape WHEN 13 THEN regexp_replace(substr(rest, 2), '"isFraud":[^,}]*', '"isFraud":0.7')
                    WHEN 14 THEN regexp_replace(substr(rest, 2), '"tx_hour":[^,}]*', '"tx_hour":3.9')
                    ELSE substr(rest, 2) END) AS whole""",
        )
        .selectExpr(
            "event_id",
            """CASE shape WHEN 1 THEN substr(whole, 1, length(whole) - 1)
                WHEN 6 THEN concat(whole, ' trailing') WHEN 7 THEN concat('[', whole, ']')
                WHEN 11 THEN replace(whole, '"', "'") WHEN 12 THEN concat(whole, '] x')
                ELSE whole END AS value""",
        )
    )


# Requests come in nine shapes.
REQUEST_SHAPES = 9


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per event, with the event's time as the scoring clock."""
    return (
        events(spark, sf_dir)
        .selectExpr(
            "event_id",
            "timestamp_seconds(secs) AS clock",
            f"event_id % {REQUEST_SHAPES} AS shape",
            "CAST(value AS STRING) AS amt",
            "CAST(user_id AS STRING) AS card",
            """concat(', "P_emaildomain": "gmail.com", "DeviceType": "desktop", "C2": 3',
                ', "card1_avg_amt": 40.5, "card1_std_amt": 12.5, "card1_tx_count": 7',
                ', "card1_historical_fraud_rate": 0.', lpad(CAST(k AS STRING), 2, '0'), ', "D1": null') AS known""",
        )
        .selectExpr(
            "event_id",
            "clock",
            """concat('{', CASE shape
                WHEN 0 THEN concat('"TransactionAmt": ', amt, ', "card1": ', card, known)
                WHEN 1 THEN concat('"TransactionAmt": ', amt)
                WHEN 2 THEN concat('"TransactionAmt": ', amt, ', "card1": null, "card1_avg_amt": null',
                    ', "card1_std_amt": null, "card1_tx_count": null, "unknown_field": [1, 2]')
                WHEN 3 THEN concat('"TransactionAmt": ', amt, known, ', "C1": null')
                WHEN 4 THEN concat('"card1": ', card, known)
                WHEN 5 THEN concat('"TransactionAmt": -5.5', known)
                WHEN 6 THEN concat('"TransactionAmt": ', amt, ', "card1": 0, "card1_avg_amt": 0.0',
                    ', "card1_std_amt": 0, "P_emaildomain": "", "DeviceType": "mobile"')
                WHEN 7 THEN concat('"TransactionAmt": "', amt, '", "email_domain_fraud_rate": 0.25')
                ELSE concat('"TransactionAmt": ', amt, ', "C1": "abc"') END, '}') AS value""",
        )
    )
