"""Row filters that define the training, test and scoring sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardwarden.schemas import KEY, LABEL

# Last digits 0-7 of the id train, 8 and 9 test (fixed values).
TRAIN_DIGITS = 8


def train_split(features: DataFrame) -> DataFrame:
    """About 80% of the rows. A row filter: no shuffle, the same rows every time."""
    return features.where(F.col(KEY) % 10 < TRAIN_DIGITS)


def test_split(features: DataFrame) -> DataFrame:
    return features.where(F.col(KEY) % 10 >= TRAIN_DIGITS)


def labelled_rows(features: DataFrame, label: str = LABEL) -> DataFrame:
    return features.where(F.col(label).isNotNull())
