"""Raw tables to feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.operators.aggregates import card_aggregates, email_domain_risk
from cardwarden.operators.base_view import base_view
from cardwarden.operators.history import card_history, out_of_fold_rates
from cardwarden.operators.ml_features import ml_features
from cardwarden.operators.splits import test_split, train_split
from cardwarden.schemas import KEY
from cardwarden.sources.tables import register_views, stored
from cardwarden.sources.versions import replace_table

VIEW = "v_transactions_with_identity"


def feature_frame(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """The feature table without named tables, for ad hoc queries.

    Card and domain aggregates count transactions and need no identity column, so
    they read the transaction table and not the joined view. They are stored
    first, like the named tables: their joins then start from a measured size, and
    where that is small, the wide rows are not shuffled for them.
    """
    return ml_features(
        base_view(transactions, identity),
        stored(card_aggregates(transactions), "card_aggregates"),
        stored(email_domain_risk(transactions), "email_domain_risk"),
    )


def unbiased_feature_frame(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """The feature table, its card columns from earlier transactions only and its domain rates from other folds.

    The same columns as ``feature_frame``, for training without labels that leak.
    """
    rates = out_of_fold_rates(transactions, "P_emaildomain", "email_domain_fraud_rate")
    return ml_features(
        base_view(transactions, identity),
        stored(card_history(transactions), "card_history"),
        stored(rates, "email_domain_rates"),
    )


def build_feature_tables(
    spark: SparkSession,
    transactions: DataFrame,
    identity: DataFrame,
    database: str | None = None,
    buckets: int | None = None,
    store_split: bool = False,
) -> dict[str, DataFrame]:
    """Create the view and the derived tables, and return a scan of each.

    The aggregates are stored before they are joined, so the planner knows their
    measured size and broadcasts only what is small. Each table is replaced in one step. The split is a row filter;
    unless ``store_split`` asks for copies it becomes two views.
    """

    def name(table: str) -> str:
        return f"{database}.{table}" if database else table

    view = base_view(transactions, identity)
    register_views({VIEW: view})
    cards = replace_table(card_aggregates(transactions), name("card_aggregates"))
    domains = replace_table(email_domain_risk(transactions), name("email_domain_risk"))
    features = replace_table(
        ml_features(view, cards, domains),
        name("ml_features"),
        bucket_by=KEY if buckets else None,
        buckets=buckets,
    )
    split = {"train_data": train_split(features), "test_data": test_split(features)}
    if store_split:
        split = {n: replace_table(frame, name(n)) for n, frame in split.items()}
    else:
        register_views(split)
    return {
        VIEW: view,
        "card_aggregates": cards,
        "email_domain_risk": domains,
        "ml_features": features,
        **split,
    }
