"""Attach per-key values to a large frame when some keys are very common."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key is hot when it holds at least this share of all rows. There can be no
# more than 1 / HOT_SHARE such keys, whatever the size of the data, so the
# broadcast of hot keys has a fixed bound of 10,000 rows.
HOT_SHARE = 1e-4
# Lanes that rows without a partner in the shuffled join are spread over.
LANES = 4096


def attach_by_key(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    spread_by: str,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Left join ``rows`` to a lookup that has one row per key.

    ``weight`` is the lookup's column with the number of rows of each key. Hot
    keys are answered from a broadcast table. All other keys join by shuffle, and
    there the hot rows and the rows with a NULL key, which can find no partner
    any more, are spread over many partitions by ``spread_by``. So no task gets
    more than its share, even if one key holds a third of all rows.

    The shuffled side carries no hint: Spark broadcasts it if its measured size
    is below the session's threshold.
    """
    if not 0 < hot_share <= 1:
        raise ValueError("hot_share must be in (0, 1]")
    values = [c for c in lookup.columns if c != key]
    packed = F.struct(*values)
    total = lookup.agg(F.sum(weight)).scalar()
    hot_from = total * F.lit(hot_share)
    hot = lookup.where(F.col(weight) >= hot_from).select(
        F.col(key).alias("_hot_key"), packed.alias("_hot")
    )
    # The lane of a cold key must depend on the key: a constant would be moved out
    # of the join's keys, and the lanes would no longer part the rows.
    own_lane = F.pmod(F.xxhash64(key), F.lit(LANES))
    cold = lookup.where(F.col(weight) < hot_from).select(
        F.col(key).alias("_cold_key"), own_lane.alias("_cold_lane"), packed.alias("_cold")
    )
    is_cold = F.col(key).isNotNull() & F.col("_hot_key").isNull()
    lane = F.when(is_cold, own_lane).otherwise(LANES + F.pmod(F.xxhash64(spread_by), F.lit(LANES)))
    with_hot = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_lane", lane
    )
    joined = with_hot.join(
        cold,
        (F.col(key) == F.col("_cold_key")) & (F.col("_lane") == F.col("_cold_lane")),
        "left",
    )
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*rows.columns, *[found[v].alias(v) for v in values])
