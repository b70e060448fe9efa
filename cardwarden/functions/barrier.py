"""Evaluate an expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A plain projection may be repeated: a later filter on the column is pushed
    below it with its expression copied in, and merged projections copy it again.
    That is fine for cheap expressions. For a JSON parse that many columns are
    derived from, it multiplies the work and the plan. A one-element ``inline`` is
    a boundary that filters and projections do not cross, and stays in the same
    stage. The expressions stay in the projection below it, where common parts are
    shared and long code is split.
    """
    kept = [c for c in rows.columns if c not in columns]
    computed = rows.select(*kept, *[c.alias(f"_once_{n}") for n, c in columns.items()])
    packed = F.struct(*[F.col(f"_once_{n}").alias(n) for n in columns])
    return computed.select(*kept, F.inline(F.array(packed)))
