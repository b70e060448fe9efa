"""Risk buckets and probability access."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Lower bounds of the buckets (fixed values); anything else is SAFE.
RISK_BOUNDS = [("HIGH", 0.8), ("MEDIUM", 0.5), ("LOW", 0.3)]


def risk_level(probability: Column, on_rounded: bool = False) -> Column:
    """Bucket a probability; NULL and NaN are SAFE.

    Batch scoring buckets the exact value, request scoring the value rounded to
    six places, so 0.7999999 is MEDIUM in one and HIGH in the other.
    """
    p = F.nanvl(probability.cast("double"), F.lit(0.0))
    p = F.bround(p, 6) if on_rounded else p
    bucket = F.when(p >= RISK_BOUNDS[0][1], RISK_BOUNDS[0][0])
    for name, bound in RISK_BOUNDS[1:]:
        bucket = bucket.when(p >= bound, name)
    return bucket.otherwise("SAFE")


def label_probabilities(probability: Column) -> Column:
    """Per-label probabilities; element 0 is the fraud label."""
    return F.array(
        F.struct(F.lit(1).cast("bigint").alias("label"), probability.alias("prob")),
        F.struct(F.lit(0).cast("bigint").alias("label"), (1 - probability).alias("prob")),
    )


def prob_of_label(probs: Column, label: int) -> Column:
    """Probability of a label, found by its value and not by its place."""
    return F.get(F.filter(probs, lambda e: e["label"] == label), F.lit(0))["prob"]


def prob_at(probs: Column, index: int) -> Column:
    """Probability at a place of the array, NULL beyond its end."""
    return F.get(probs, F.lit(index))["prob"]
