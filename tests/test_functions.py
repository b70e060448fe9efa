from datetime import datetime, timezone

from pyspark.sql import functions as F

from cardwarden.functions import features as fx
from cardwarden.functions.risk import risk_level
from cardwarden.streaming.preview import amount_text


def _column(spark, values, kind, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clock_is_utc_in_any_session_zone(spark):
    seconds = [0, 21599, 21600, 86399, 1_512_000_000, 1_704_067_207, -1, -86_400 * 4]
    clock = [datetime.fromtimestamp(s, timezone.utc) for s in seconds]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)

            def ts(v):
                return F.timestamp_seconds(v)

            assert _column(spark, seconds, "bigint", lambda v: fx.tx_hour(ts(v))) == [
                c.hour for c in clock
            ]
            assert _column(spark, seconds, "bigint", lambda v: fx.tx_day_of_week(ts(v))) == [
                c.weekday() for c in clock
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_amounts(spark):
    amounts = [0.5, 1.5, 2.5, 49.99, 50.0, 199.99, 200.0, 999.99, 1000.0, 12.03125, 1234.56]
    buckets = _column(spark, amounts, "double", fx.amt_bucket)
    assert buckets == [
        "low", "low", "low", "low", "medium", "medium",
        "high", "high", "very_high", "low", "very_high",
    ]
    parts = _column(spark, amounts, "double", fx.amt_decimal_part)
    assert parts == [round(a - round(a), 4) for a in amounts]
    assert _column(spark, [-1.0, -2.0, None], "double", fx.log_tx_amt) == [None, None, None]


def test_zscore_without_history(spark):
    rows = spark.createDataFrame(
        [(10.0, None, None), (10.0, 0.0, 0.0), (10.0, 4.0, 0.0), (10.0, 4.0, 3.0), (10.5, 10.0, 16.0)],
        "a double, m double, d double",
    )
    got = [r.z for r in rows.select(fx.zscore(F.col("a"), F.col("m"), F.col("d")).alias("z")).collect()]
    assert got == [0.0, 0.0, 6.0, 2.0, 0.0312]


def test_risk_levels(spark):
    values = [0.8, 0.7999999, 0.5, 0.4999, 0.3, 0.2999999, 0.0, None]
    assert _column(spark, values, "double", risk_level) == [
        "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "SAFE", "SAFE", "SAFE",
    ]
    assert _column(spark, values, "double", lambda p: risk_level(p, on_rounded=True)) == [
        "HIGH", "HIGH", "MEDIUM", "LOW", "LOW", "LOW", "SAFE", "SAFE",
    ]


def test_amount_text(spark):
    values = [12.31, 12.0, 12345678.5, 98765432.0, 0.01]
    assert _column(spark, values, "double", amount_text) == [f"${v}" for v in values]


def test_odd_numbers_have_a_defined_bucket(spark):
    rows = spark.createDataFrame([(float("nan"),), (None,), (0.9,)], "p double")
    both = rows.select(risk_level(F.col("p")).alias("a"), risk_level(F.col("p"), on_rounded=True).alias("b"))
    assert [(r.a, r.b) for r in both.collect()] == [("SAFE", "SAFE"), ("SAFE", "SAFE"), ("HIGH", "HIGH")]
    assert rows.select(fx.amt_bucket(F.lit(None).cast("double")).alias("x")).first().x is None
