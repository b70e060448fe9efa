"""Scoring of JSON requests, batch or stream.

One code path for both: defaults, checks and derived features are columns, and
the model is any function that adds predictions. A request that cannot be
scored gives a row with an ``error`` and never fails the job.

- ``invalid_request``: not one JSON object, no amount, or a field of the wrong kind
- ``scoring_failed``: well-formed, but with a value the model query cannot take
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cardwarden.functions import features as fx
from cardwarden.functions.barrier import once
from cardwarden.functions.loose_values import Loose
from cardwarden.functions.risk import prob_of_label, risk_level
from cardwarden.operators.scoring import PREDICTED, PROBS
from cardwarden.schemas import LOGISTIC_FEATURES
from cardwarden.streaming.ingest import parse_messages

REQUIRED = object()

# Request fields: type, and the value of a field that is absent (fixed values).
REQUEST_FIELDS: dict[str, tuple[str, object]] = {
    "TransactionAmt": ("double", REQUIRED),
    "ProductCD": ("string", "W"),
    "card1": ("bigint", 1000),
    "card4": ("string", None),
    "card6": ("string", None),
    "addr1": ("double", None),
    "P_emaildomain": ("string", None),
    "DeviceType": ("string", None),
    "C1": ("double", 1.0),
    "C2": ("double", 1.0),
    "C5": ("double", 0.0),
    "C6": ("double", 1.0),
    "C13": ("double", 1.0),
    "C14": ("double", 1.0),
    "D1": ("double", None),
    "D4": ("double", None),
    "D10": ("double", None),
    "D15": ("double", None),
    "M4": ("string", None),
    "M5": ("string", None),
    "M6": ("string", None),
    "card1_tx_count": ("bigint", 1),
    "card1_avg_amt": ("double", None),
    "card1_std_amt": ("double", None),
    "card1_historical_fraud_rate": ("double", 0.035),
    "email_domain_fraud_rate": ("double", 0.035),
}
# Numbers with a replacement for null: 0 here, other values in ``request_features``.
ZERO_IF_NULL = ["addr1", "D1", "D4", "D10", "D15"]
# Numbers that may be left out but not sent as null.
NOT_NULL = [
    "C1", "C2", "C5", "C6", "C13", "C14",
    "card1_historical_fraud_rate", "email_domain_fraud_rate",
]
READERS = {
    "double": Loose.to_double,
    "bigint": Loose.to_exact_long,
    "string": Loose.only_text,
}


def parse_requests(requests: DataFrame, value: str = "value") -> DataFrame:
    """Add ``request``, typed and with defaults, and ``invalid`` for bad requests."""
    rows = parse_messages(requests, list(REQUEST_FIELDS), value)
    typed, bad = [], [F.col("fields").isNull()]
    for name, (kind, default) in REQUEST_FIELDS.items():
        sent = Loose.of(name)
        read = READERS[kind](sent)
        filled = read
        if default is REQUIRED:
            bad.append(sent.is_null())
        elif default is not None:
            filled = F.when(sent.is_absent(), F.lit(default).cast(kind)).otherwise(read)
        bad.append(~sent.is_null() & F.col("request")[name].isNull())
        typed.append(filled.alias(name))
    # One struct, so that the flag below reads values and does not repeat the casts.
    rows = once(rows, request=F.struct(*typed))
    invalid = F.array_contains(F.array(*bad), True)
    return rows.withColumn("invalid", invalid).drop("fields", "kinds")


def _finite(number: Column) -> Column:
    return ~F.isnan(number) & (F.abs(number) < float("inf"))


def request_features(parsed: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add the model features of each request and its ``error``.

    Hour and weekday are those of the scoring clock. A request carries no
    distances, so both are flagged as missing.
    """
    clock = F.current_timestamp() if clock is None else clock
    kept = [c for c in parsed.columns if c not in ("request", "invalid")]
    rows = parsed.withColumn("scored_at", clock.cast("timestamp")).select(
        *kept, "scored_at", "invalid", "request.*"
    )
    amount, ts = F.col("TransactionAmt"), F.col("scored_at")
    null_sent = [F.col(n).isNull() for n in NOT_NULL]
    replaced = {
        "card1": fx.or_if_falsy(F.col("card1"), F.lit(1000)).cast("bigint"),
        "card1_tx_count": fx.or_if_falsy(F.col("card1_tx_count"), F.lit(1)).cast("bigint"),
        "card1_avg_amt": fx.or_if_falsy(F.col("card1_avg_amt"), amount),
        "card1_std_amt": fx.or_if_falsy(F.col("card1_std_amt"), F.lit(1.0)),
    } | {n: F.coalesce(F.col(n), F.lit(0.0)) for n in ZERO_IF_NULL}
    derived = {
        "log_tx_amt": fx.log_tx_amt(amount),
        "amt_decimal_part": fx.amt_decimal_part(amount),
        "amt_bucket": fx.amt_bucket(amount),
        "amt_zscore_vs_card": fx.zscore(amount, F.col("card1_avg_amt"), F.col("card1_std_amt")),
        "tx_hour": fx.tx_hour(ts),
        "tx_day_of_week": fx.tx_day_of_week(ts),
        "is_late_night": fx.is_late_night(fx.tx_hour(ts)),
        "dist1_is_null": F.lit(1).cast("bigint"),
        "dist2_is_null": F.lit(1).cast("bigint"),
        "email_is_null": fx.is_blank(F.col("P_emaildomain")),
        "device_is_null": fx.is_blank(F.col("DeviceType")),
        "is_mobile": fx.is_mobile(F.col("DeviceType")),
    }
    numbers = [n for n, (kind, _) in REQUEST_FIELDS.items() if kind == "double"]
    failed = [
        *null_sent,
        amount <= -1,
        *[~_finite(F.col(n)) for n in [*numbers, "amt_zscore_vs_card"]],
    ]
    return (
        rows.withColumns(replaced)
        .withColumns(derived)
        .withColumn(
            "error",
            F.when(F.col("invalid"), "invalid_request").when(
                F.array_contains(F.array(*[F.coalesce(f, F.lit(False)) for f in failed]), True),
                "scoring_failed",
            ),
        )
        .select(*kept, "scored_at", "error", "ProductCD", *LOGISTIC_FEATURES)
    )


def score_requests(
    requests: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    clock: Column | None = None,
    value: str = "value",
    model: str = "xgboost",
) -> DataFrame:
    """The answer to each request, next to the request's own columns.

    ``predict`` adds the predicted label and the label probabilities, for example
    ``functools.partial(models.predict, model)``.
    """
    scored = predict(request_features(parse_requests(requests, value), clock))
    ok = F.col("error").isNull()
    p = prob_of_label(F.col(PROBS), 1)
    answer = {
        "fraud_probability": F.bround(p, 6),
        "predicted_fraud": F.col(PREDICTED).cast("bigint"),
        "risk_level": risk_level(p, on_rounded=True),
        "transaction_amount": F.col("TransactionAmt"),
        "model": F.lit(model),
        "scored_at": F.col("scored_at"),
    }
    return scored.select(
        *requests.columns, *[F.when(ok, c).alias(n) for n, c in answer.items()], "error"
    )
