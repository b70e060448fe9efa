"""The model feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardwarden.functions import features as fx
from cardwarden.operators.history import FOLD, TIME, attach_card_history, attach_out_of_fold
from cardwarden.operators.lookup import attach_by_key
from cardwarden.schemas import FEATURE_TABLE_COLUMNS, KEY


def time_features(view: DataFrame) -> DataFrame:
    ts = F.col("transaction_timestamp")
    return view.withColumns(
        {
            "tx_hour": fx.tx_hour(ts),
            "tx_day_of_week": fx.tx_day_of_week(ts),
            "is_late_night": fx.is_late_night(fx.tx_hour(ts)),
        }
    )


def amount_features(view: DataFrame) -> DataFrame:
    amount = F.col("TransactionAmt")
    return view.withColumns(
        {
            "log_tx_amt": fx.log_tx_amt(amount),
            "amt_decimal_part": fx.amt_decimal_part(amount),
            "amt_bucket": fx.amt_bucket(amount),
        }
    )


def null_flags(view: DataFrame) -> DataFrame:
    return view.withColumns(
        {
            "email_is_null": fx.is_blank(F.col("P_emaildomain")),
            "device_is_null": fx.is_blank(F.col("DeviceType")),
            "is_mobile": fx.is_mobile(F.col("DeviceType")),
            "dist1_is_null": fx.flag(F.col("dist1").isNull()),
            "dist2_is_null": fx.flag(F.col("dist2").isNull()),
        }
    )


def ml_features(view: DataFrame, cards: DataFrame, domains: DataFrame) -> DataFrame:
    """One row per row of the view, 40 columns.

    ``cards`` and ``domains`` are the aggregates of this module's neighbours, best
    as stored tables: the planner then knows their size. In place of the aggregates,
    ``cards`` may be a ``card_history`` and ``domains`` rates by fold.
    """
    rows = null_flags(amount_features(time_features(view)))
    if TIME in cards.columns:
        rows = attach_card_history(rows, cards)
    else:
        rows = attach_by_key(rows, cards, "card1", weight="card1_tx_count", spread_by=KEY)
    if FOLD in domains.columns:
        rows = attach_out_of_fold(rows, domains, "P_emaildomain")
    else:
        rows = attach_by_key(
            rows, domains, "P_emaildomain", weight="email_tx_count", spread_by=KEY
        )
    base_rate = F.lit(fx.BASE_FRAUD_RATE)
    return rows.withColumns(
        {
            "card1_historical_fraud_rate": F.coalesce("card1_historical_fraud_rate", base_rate),
            "email_domain_fraud_rate": F.coalesce("email_domain_fraud_rate", base_rate),
            "amt_zscore_vs_card": fx.zscore(
                F.col("TransactionAmt"), F.col("card1_avg_amt"), F.col("card1_std_amt")
            ),
        }
    ).select(*FEATURE_TABLE_COLUMNS)
