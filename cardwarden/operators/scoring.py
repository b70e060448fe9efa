"""Batch scores of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardwarden.functions.risk import prob_at, risk_level
from cardwarden.operators.aggregates import duplicate_keys
from cardwarden.schemas import KEY, LABEL

PREDICTED = "predicted_isFraud"
PROBS = "predicted_isFraud_probs"
CARRIED_COLUMNS = [
    "TransactionAmt", "ProductCD", "card4", "card6", "P_emaildomain", "DeviceType",
    "tx_hour", "is_late_night", "amt_bucket", "card1_historical_fraud_rate",
    "email_domain_fraud_rate", "amt_zscore_vs_card",
]


def fraud_scores(predictions: DataFrame) -> DataFrame:
    """The 17 score columns of each prediction, without a join.

    Predictions keep the columns they were made from, so the features need not be
    joined back. Right as long as transaction ids are unique: see ``score_join``.
    """
    p = prob_at(F.col(PROBS), 0)
    return predictions.where(F.col(KEY).isNotNull()).select(
        KEY,
        F.col(LABEL).alias("actual_fraud"),
        F.col(PREDICTED).alias("predicted_fraud"),
        F.round(p, 6).alias("fraud_probability"),
        *CARRIED_COLUMNS,
        risk_level(p).alias("risk_level"),
    )


def score_join(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """The same columns through a join of predictions to features on the id.

    An id that occurs k times among both gives k * k rows, and a duplicate
    without a label takes part on the feature side.
    """
    slim = predictions.select(KEY, PREDICTED, PROBS)
    return fraud_scores(features.join(slim, KEY))


def fraud_scores_checked(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """``fraud_scores`` if the feature table's ids are unique, else ``score_join``.

    The check is a job of its own that shuffles only the ids, counted before the
    shuffle.
    """
    if duplicate_keys(features.select(KEY).where(F.col(KEY).isNotNull()), KEY).isEmpty():
        return fraud_scores(predictions)
    return score_join(predictions, features)
