"""The joined view of transactions and identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardwarden.functions.features import DATA_EPOCH, transaction_timestamp
from cardwarden.schemas import KEY, VIEW_IDENTITY_COLUMNS, VIEW_TRANSACTION_COLUMNS


def with_timestamp(transactions: DataFrame, epoch: int = DATA_EPOCH) -> DataFrame:
    return transactions.withColumn(
        "transaction_timestamp", transaction_timestamp(F.col("TransactionDT"), epoch)
    )


def base_view(transactions: DataFrame, identity: DataFrame, epoch: int = DATA_EPOCH) -> DataFrame:
    """Every transaction with its identity columns, NULL where there is no record.

    Lazy: a consumer that needs three columns reads three columns of each side.
    An id with several identity records yields one row for each. Measures that
    need no identity column are better taken from ``with_timestamp``, which
    spares them the join.
    """
    left = with_timestamp(transactions, epoch).select(*VIEW_TRANSACTION_COLUMNS)
    return left.join(identity.select(KEY, *VIEW_IDENTITY_COLUMNS), KEY, "left")
