"""Per-key features that keep a row's own label, and what came after it, out of the row.

``card_history`` takes the place of ``card_aggregates`` and ``out_of_fold_rates`` that of the label rates of
``email_domain_risk``: same column names, but keyed by card and moment, or by key and fold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwarden.operators.lookup import attach_by_key
from cardwarden.schemas import KEY, LABEL
from cardwarden.sources.tables import stored

CARD, TIME, AMOUNT = "card1", "TransactionDT", "TransactionAmt"
FOLD, FOLDS = "fold", 5
#: Seconds of a time block. A card has at most one row a second in a block, so a block is a bounded window.
BLOCK = 86_400
#: Amounts are summed as whole numbers of this fraction, so that no order of adding changes a sum.
UNIT = 10_000
_ROWS_NOW = "rows_now"


def _integer(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def card_history(transactions: DataFrame, block: int = BLOCK) -> DataFrame:
    """Count, mean, deviation and fraud rate of the transactions of a card before each second in which it has one.

    One row per card and second; transactions of the same second don't see one another. Sums go up in two levels: totals per card
    and block of time, their prefix sums, and prefix sums inside a block. So a card that holds a third of all rows is as
    many tasks as it has blocks, and no window holds more than ``block`` rows.

    Amounts count to four decimals and up to 10 ** 14. The mean is NULL before the first amount, the deviation before the second, the
    rate before the first label. Rows without a card or a time have no history.
    """
    units = F.round(F.col(AMOUNT) * UNIT).try_cast("decimal(18,0)")
    moments = (
        transactions.where(F.col(CARD).isNotNull() & F.col(TIME).isNotNull())
        .groupBy(CARD, TIME)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(units).alias("amounts"),
            _integer(F.sum(units)).alias("units"),
            F.sum(_integer(units) * units).alias("squares"),
            F.count(LABEL).alias("labelled"),
            F.sum(F.col(LABEL).cast("long")).alias("fraud"),
        )
        .withColumn("block", F.floor(F.col(TIME) / block).cast("long"))
    )
    moments = stored(moments, "card-moments")
    sums = ("n", "amounts", "units", "squares", "labelled", "fraud")

    def before(*keys: str, order: str) -> Window:
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    totals = moments.groupBy(CARD, "block").agg(*[F.sum(c).alias(c) for c in sums])
    starts = totals.select(CARD, "block", *[F.sum(c).over(before(CARD, order="block")).alias(f"{c}_to_block") for c in sums])
    inside = moments.withColumns({f"{c}_in_block": F.sum(c).over(before(CARD, "block", order=TIME)) for c in sums})
    zero = F.lit(0)
    both = {c: F.coalesce(f"{c}_to_block", zero) + F.coalesce(f"{c}_in_block", zero) for c in sums}
    known = inside.withColumnRenamed("n", _ROWS_NOW).join(starts, [CARD, "block"]).select(CARD, TIME, _ROWS_NOW, *[v.alias(c) for c, v in both.items()])
    n, total, squares = F.col("amounts"), _integer(F.col("units")), _integer(F.col("squares"))
    # n * sum(x * x) - sum(x) ** 2, exact while it fits 38 digits
    spread = F.try_subtract(F.try_multiply(_integer(n), squares), F.try_multiply(total, total)).cast("double")
    rough = n * squares.cast("double") - total.cast("double") * total.cast("double")
    variance = F.try_divide(F.greatest(F.coalesce(spread, rough), F.lit(0.0)), n.cast("double") * (n - 1))
    return known.select(
        CARD,
        TIME,
        _ROWS_NOW,
        F.col("n").alias("card1_tx_count"),
        (F.try_divide(total.cast("double"), n) / UNIT).alias("card1_avg_amt"),
        (F.sqrt(variance) / UNIT).alias("card1_std_amt"),
        F.try_divide(F.col("fraud").cast("double"), "labelled").alias("card1_historical_fraud_rate"),
    )


def _joint(*names: str) -> Column:
    """The columns as one key; NULL if any of them is."""
    return F.when(reduce(Column.__and__, [F.col(n).isNotNull() for n in names]), F.struct(*names))


def _attach(rows: DataFrame, lookup: DataFrame, *names: str) -> DataFrame:
    joint = "_joint"
    values = [c for c in lookup.columns if c not in (*names, _ROWS_NOW)]
    known = lookup.select(_joint(*names).alias(joint), *values, _ROWS_NOW)
    attached = attach_by_key(rows.withColumn(joint, _joint(*names)), known, joint, weight=_ROWS_NOW, spread_by=KEY)
    return attached.drop(joint, _ROWS_NOW)


def attach_card_history(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Rows with what ``card_history`` knows of their card before their time. Store the history first."""
    return _attach(rows, history, CARD, TIME)


def with_fold(rows: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Add ``fold``, which depends on the transaction id only."""
    return rows.withColumn(FOLD, F.pmod(F.col(KEY), F.lit(folds)))


def out_of_fold_rates(rows: DataFrame, key: str, rate: str, folds: int = FOLDS, label: str = LABEL) -> DataFrame:
    """Fraud rate of each value of ``key`` over the rows outside of each fold: key, fold, ``rate``.

    Labels are summed by key and fold before the shuffle, and a fold's sums are taken off its key's, of which there
    are ``folds`` rows. So no task sees the rows of a hot key. The rate is NULL without a label in the other folds.
    A blank text counts as missing, as elsewhere.
    """
    known = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    parts = with_fold(rows.where(known), folds).groupBy(key, FOLD).agg(
        F.count(F.lit(1)).alias(_ROWS_NOW), F.count(label).alias("labelled"), F.coalesce(F.sum(label), F.lit(0)).alias("fraud")
    )
    whole = Window.partitionBy(key)

    def others(name: str) -> Column:
        return F.sum(name).over(whole) - F.col(name)

    return parts.select(key, FOLD, _ROWS_NOW, F.try_divide(others("fraud").cast("double"), others("labelled")).alias(rate))


def attach_out_of_fold(rows: DataFrame, rates: DataFrame, key: str, folds: int = FOLDS) -> DataFrame:
    """Rows with the rate of their key over the rows of other folds. Store the rates first."""
    return _attach(with_fold(rows, folds), rates, key, FOLD).drop(FOLD)
