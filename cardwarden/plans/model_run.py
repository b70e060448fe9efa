"""Feature table to trained models, their comparison, scores and reports."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from cardwarden.operators import models
from cardwarden.operators.aggregates import (
    late_night_lift,
    overall_rate,
    rate_by_product,
    rate_by_risk,
)
from cardwarden.operators.base_view import with_timestamp
from cardwarden.operators.boosted_forest import ForestConfig, train_boosted_forest
from cardwarden.operators.scoring import fraud_scores_checked
from cardwarden.operators.splits import labelled_rows
from cardwarden.sources.versions import replace_table

LOGISTIC, BOOSTED = "Logistic Regression", "XGBoost"


def train_and_compare(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    model_folder: str,
    logistic: models.LogisticConfig | None = None,
    boosted: ForestConfig | models.BoostedConfig | None = None,
) -> dict[str, DataFrame]:
    """Train both models, save them, and return comparison and importance.

    Unless told otherwise, the boosted model fits a forest a round, and both give frequent texts their own
    category and missing numbers the mean.
    """
    ensembles = isinstance(boosted, models.BoostedConfig)
    trained = {
        LOGISTIC: models.train_logistic(train, logistic or models.LogisticConfig(encoding="frequent")),
        BOOSTED: models.train_boosted(train, boosted) if ensembles else train_boosted_forest(train, boosted),
    }
    models.save_model(trained[LOGISTIC], f"{model_folder}/model_logistic_regression")
    models.save_model(trained[BOOSTED], f"{model_folder}/model_xgboost")
    return {
        "comparison": models.compare(
            {name: partial(models.predict, model) for name, model in trained.items()}, test
        ),
        "importance": models.feature_importance(
            spark, trained[BOOSTED], f"{model_folder}/model_xgboost"
        ),
    }


def score_table(
    features: DataFrame, model_path: str, table: str = "fraud_scores"
) -> DataFrame:
    """Score every labelled row with a saved model and store the scores."""
    predictions = models.predict(models.load_model(model_path), labelled_rows(features))
    return replace_table(fraud_scores_checked(predictions, features), table)


def reports(transactions: DataFrame, scores: DataFrame) -> dict[str, DataFrame]:
    """The dashboard's measures, each one aggregation without a join."""
    return {
        "overall_rate": overall_rate(transactions),
        "rate_by_product": rate_by_product(transactions),
        "late_night_lift": late_night_lift(with_timestamp(transactions)),
        "rate_by_risk": rate_by_risk(scores),
    }
