"""Boosted trees with a forest a round: each round fits several trees to the same gradients.

Trees are models of Spark ML. A tree that is fitted to -gradient / hessian, weighted by the hessian, splits by the
second-order gain, and its leaves are the second-order steps -sum(gradient) / sum(hessian).
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardwarden.operators.encoding import fit_encoding, fitted_stages
from cardwarden.operators.models import VECTOR, WEIGHT, with_class_weight
from cardwarden.operators.splits import labelled_rows
from cardwarden.operators.tree_growth import LEAST_SAMPLED, Row, Tree, batch_columns, grow
from cardwarden.schemas import BOOSTED_FEATURES, KEY, LABEL
from cardwarden.sources.tables import stored

VALUES, MARGIN, _DRAWN = "_values", "_margin", "_drawn"
#: Rounds after which the margins are written, so that no row walks through more trees than theirs.
KEEP_EVERY = 10


@dataclass(frozen=True)
class ForestConfig:
    features: list[str] = field(default_factory=lambda: list(BOOSTED_FEATURES))
    rounds: int = 50
    trees: int = 4  # a round
    row_share: float = 0.8  # drawn anew for each tree
    column_share: float = 0.8  # drawn anew for each tree
    balanced: bool = True
    max_depth: int = 6
    learn_rate: float = 0.3  # of a round; each of its trees has an equal part
    least_hessian: float = 1.0  # of a leaf
    max_bins: int = 256
    max_categories: int = 200
    seed: int = 42


def _drawn(row_share: float, *draw: int) -> Column:
    """A fixed part of the rows, by transaction id and draw."""
    place = F.pmod(F.xxhash64(KEY, *[F.lit(d) for d in draw]), F.lit(1 << 30))
    return place < int(row_share * (1 << 30))


def _drawn_columns(width: int, share: float, *draw: int) -> list[int]:
    """The columns that a tree may split on, in order."""
    return sorted(random.Random(str(draw)).sample(range(width), max(1, round(share * width))))


def _margins(batch: pa.RecordBatch, values: np.ndarray, rounds: list[list[Tree]], learn_rate: float) -> np.ndarray:
    margin = batch[MARGIN].to_numpy()
    for trees in rounds:
        mean = reduce(np.add, [tree.prediction[tree.leaf_of_values(values)] for tree in trees]) / len(trees)
        margin = margin + learn_rate * mean
    return margin


def _read(batch: pa.RecordBatch, rounds: list[list[Tree]], learn_rate: float) -> Row:
    """Second-order steps and hessians by the margins of a batch and the rounds since they were written."""
    values = batch_columns(batch, VALUES)
    p = 1 / (1 + np.exp(-_margins(batch, values, rounds, learn_rate)))
    curve = np.maximum(p * (1 - p), 1e-16)
    return values, (batch[LABEL].to_numpy() - p) / curve, batch[WEIGHT].to_numpy() * curve, batch_columns(batch, _DRAWN)


def _moved(rows: DataFrame, rounds: list[list[Tree]], learn_rate: float) -> DataFrame:
    """The rows with the margins after these rounds."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margin = _margins(batch, batch_columns(batch, VALUES), rounds, learn_rate)
                yield batch.set_column(batch.schema.get_field_index(MARGIN), MARGIN, pa.array(margin))

    return rows.mapInArrow(move, rows.schema)


def _fit_round(
    rows: DataFrame, sample: DataFrame, width: int, categories: dict[int, int], since: list[list[Tree]], round_: int, config: ForestConfig
) -> list[Tree]:
    draws = [_drawn(config.row_share, config.seed, round_, k) if config.row_share < 1 else F.lit(True) for k in range(config.trees)]
    learn_rate, least_hessian, row_share = config.learn_rate, config.least_hessian, config.row_share
    return grow(
        *[frame.select(LABEL, WEIGHT, VALUES, MARGIN, F.array(*draws).alias(_DRAWN)) for frame in (rows, sample)],
        read=lambda batch: _read(batch, since, learn_rate),
        columns=[_drawn_columns(width, config.column_share, config.seed, round_, k) for k in range(config.trees)],
        categories=categories,
        max_bins=config.max_bins,
        max_depth=config.max_depth,
        least=lambda hessian: min(least_hessian / (hessian * row_share), 0.499),
    )


def _doubles(spark: SparkSession, values: np.ndarray) -> JavaObject:
    """An array of the JVM, sent at once."""
    jvm = spark._jvm
    array = spark.sparkContext._gateway.new_array(jvm.double, values.size)
    jvm.java.nio.ByteBuffer.wrap(values.astype(">f8").tobytes()).asDoubleBuffer().get(array)
    return array


def _spark_tree(spark: SparkSession, tree: Tree, categories: dict[int, int], width: int) -> JavaObject:
    """The same tree as a model of Spark's, in which two leaves that predict the same are one."""
    ml, arrays, variance = spark._jvm.org.apache.spark.ml, spark._jvm.java.util.Arrays, spark._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    node_leaf, node_inner, by_number, by_category = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
    sums = _doubles(spark, tree.sums)
    prediction, impurity = tree.prediction.tolist(), tree.impurity.tolist()
    made: dict[int, tuple[JavaObject, bool]] = {}
    for n in reversed(range(len(tree.feature))):
        stats = variance(arrays.copyOfRange(sums, 3 * n, 3 * n + 3), 0)
        left, right, f = int(tree.child[n]), int(tree.child[n]) + 1, int(tree.feature[n])
        if f < 0 or (made[left][1] and made[right][1] and prediction[left] == prediction[right]):
            made[n] = node_leaf(prediction[n] if f < 0 else prediction[left], impurity[n], stats), True
            continue
        if f in categories:
            split = by_category(f, _doubles(spark, np.flatnonzero(tree.goes_left[n])), categories[f])
        else:
            split = by_number(f, float(tree.threshold[n]))
        made[n] = node_inner(prediction[n], impurity[n], float(tree.gain[n]), made[left][0], made[right][0], split, stats), False
    uid = ml.util.Identifiable.randomUID("dtr")
    return ml.regression.DecisionTreeRegressionModel(uid, made[0][0], width)


def _classifier(spark: SparkSession, trees: list[JavaObject], weight: float) -> GBTClassificationModel:
    """The trees as one model. Its probability is that of twice the weighted sum."""
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    members = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        members[i], weights[i] = tree, weight / 2
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("boostedForest")
    model = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, members, weights))
    model.setFeaturesCol(VECTOR).setPredictionCol("_prediction_0")
    return model.setRawPredictionCol("_raw_0").setProbabilityCol("_probability_0")


def train_boosted_forest(train: DataFrame, config: ForestConfig | None = None) -> PipelineModel:
    """Boosted trees, ``trees`` of them a round, each on its own draw of rows and columns.

    Encoded rows are written once. A round reads them with the margins so far, and grows its trees side by side from histograms; the
    mean of their predictions is added to the margins. Only trees, and sums by node, column and bin, reach the driver.
    """
    config = config or ForestConfig()
    rows = with_class_weight(labelled_rows(train), balanced=config.balanced)
    encoding = fit_encoding(rows, config.features, config.max_categories)
    stages, numbers, categories = fitted_stages(encoding)
    assembler = VectorAssembler(inputCols=numbers + categories, outputCol=VECTOR)
    encoder = Pipeline(stages=[*stages, assembler]).fit(rows)
    width = len(numbers) + len(categories)
    # one of a column's categories is missing values, one all others
    sizes = {len(numbers) + i: len(codes) + 2 for i, codes in enumerate(encoding.codes.values())}
    values = encoder.transform(rows).select(KEY, LABEL, WEIGHT, vector_to_array(VECTOR).alias(VALUES), F.lit(0.0).alias(MARGIN))
    current = stored(values, "encoded")
    sampled = max(config.max_bins**2, LEAST_SAMPLED) / max(config.row_share * current.count(), 1)
    sample = current if sampled >= 1 else stored(current.where(_drawn(sampled, config.seed)), "sampled")
    forest: list[Tree] = []
    since: list[list[Tree]] = []
    for round_ in range(config.rounds):
        trees = _fit_round(current, sample, width, sizes, since, round_, config)
        forest += trees
        since.append(trees)
        if (round_ + 1) % KEEP_EVERY == 0 and round_ + 1 < config.rounds:
            moved = stored(_moved(current, since, config.learn_rate), "margins")
            sample = moved if sample is current else stored(_moved(sample, since, config.learn_rate), "sampled")
            current, since = moved, []
    made = [_spark_tree(train.sparkSession, tree, sizes, width) for tree in forest]
    return PipelineModel(stages=[*encoder.stages, _classifier(train.sparkSession, made, config.learn_rate / config.trees)])
