"""Training, prediction, evaluation and inspection of the two classifiers.

Training and inference are Spark ML's. This module chooses encodings whose
driver-side state stays bounded, balances the classes, and puts predictions
into the shape the scoring jobs read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardwarden.functions.risk import label_probabilities, prob_of_label
from cardwarden.operators.aggregates import class_weights
from cardwarden.operators.encoding import fit_encoding, fitted_stages
from cardwarden.operators.metrics import evaluation, top_k
from cardwarden.operators.scoring import PREDICTED, PROBS
from cardwarden.operators.splits import labelled_rows
from cardwarden.schemas import BOOSTED_FEATURES, LABEL, LOGISTIC_FEATURES, TEXT_FEATURES
from cardwarden.session import scratch_path
from cardwarden.sources.versions import model_folder, replace_model

WEIGHT = "_class_weight"
VECTOR = "_features"


@dataclass(frozen=True)
class LogisticConfig:
    features: list[str] = field(default_factory=lambda: list(LOGISTIC_FEATURES))
    iterations: int = 20
    l2: float = 0.1
    balanced: bool = True
    # Categories of every text column; at most max_bins.
    max_categories: int = 200
    # "hashed" texts with missing numbers as 0, or "frequent" values with their own category and means
    encoding: str = "hashed"


@dataclass(frozen=True)
class BoostedConfig:
    features: list[str] = field(default_factory=lambda: list(BOOSTED_FEATURES))
    rounds: int = 50
    # Independently seeded ensembles whose margins are averaged.
    parallel_trees: int = 4
    row_share: float = 0.8
    column_share: float = 0.8
    balanced: bool = True
    max_depth: int = 6
    learn_rate: float = 0.3
    max_bins: int = 256
    # Categories of every text column; at most max_bins.
    max_categories: int = 200
    seed: int = 42
    # as in LogisticConfig
    encoding: str = "hashed"


def _quote(name: str) -> str:
    return f"`{name}`"


def encoding_stages(features: list[str], width: int) -> tuple[list, list[str], list[str]]:
    """Stages that turn features into number columns, and the names they make.

    Missing numbers become 0. Every text column is hashed into ``width`` categories, whatever
    number of values it has, so the encoding never depends on the data. The categories
    are declared as such, and trees split them as sets.
    """
    texts = [f for f in features if f in TEXT_FEATURES]
    numbers = [f for f in features if f not in TEXT_FEATURES]
    made = [
        f"coalesce(nanvl(CAST({_quote(n)} AS DOUBLE), 0.0D), 0.0D) AS {_quote('num_' + n)}"
        for n in numbers
    ]
    # Blank text counts as missing, as it does in the null flags.
    made += [
        f"CAST(pmod(xxhash64(coalesce(nullif({_quote(t)}, ''), '<none>')), {width}) AS STRING) AS {_quote('txt_' + t)}"
        for t in texts
    ]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")]
    if texts:
        index = StringIndexerModel.from_arrays_of_labels(
            [[str(i) for i in range(width)]] * len(texts),
            inputCols=[f"txt_{t}" for t in texts],
            outputCols=[f"cat_{t}" for t in texts],
        )
        stages.append(index)
    return stages, [f"num_{n}" for n in numbers], [f"cat_{t}" for t in texts]


def _encoding(rows: DataFrame, config: LogisticConfig | BoostedConfig) -> tuple[list, list[str], list[str]]:
    if config.encoding == "frequent":
        return fitted_stages(fit_encoding(rows, config.features, config.max_categories))
    if config.encoding != "hashed":
        raise ValueError('encoding is "hashed" or "frequent"')
    return encoding_stages(config.features, config.max_categories)


def with_class_weight(rows: DataFrame, label: str = LABEL, balanced: bool = True) -> DataFrame:
    """Add n / (2 * n_c) per row, from one counting pass that returns a row per label."""
    if not balanced:
        return rows.withColumn(WEIGHT, F.lit(1.0))
    # a third row shows that there are other labels, however many there are
    counted = class_weights(rows, label).limit(3).collect()
    weights = {r[label]: r["class_weight"] for r in counted}
    if not set(weights) <= {0, 1}:
        raise ValueError("labels are 0 or 1")
    if len(weights) < 2:
        raise ValueError("training rows need both labels")
    return rows.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])))


def train_logistic(train: DataFrame, config: LogisticConfig | None = None) -> PipelineModel:
    """L2 logistic regression on one-hot text and plain numbers."""
    config = config or LogisticConfig()
    rows = with_class_weight(labelled_rows(train), balanced=config.balanced)
    stages, numbers, categories = _encoding(rows, config)
    hot = [f"hot_{c}" for c in categories]
    if hot:
        stages.append(OneHotEncoder(inputCols=categories, outputCols=hot, handleInvalid="keep"))
    assembler = VectorAssembler(inputCols=numbers + hot, outputCol=VECTOR)
    classifier = LogisticRegression(
        featuresCol=VECTOR,
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=config.iterations,
        regParam=config.l2,
        elasticNetParam=0.0,
        predictionCol="_prediction",
        rawPredictionCol="_raw",
        probabilityCol="_probability",
    )
    return Pipeline(stages=[*stages, assembler, classifier]).fit(rows)


def train_boosted(train: DataFrame, config: BoostedConfig | None = None) -> PipelineModel:
    """Boosted trees with row and column sampling.

    Spark grows one tree a round. ``parallel_trees`` ensembles with their own
    seeds, and so their own row and column samples, stand in for several trees a
    round. They read the same encoded rows, and are fitted side by side so that
    the small jobs at the top of one tree do not leave the cluster idle.
    """
    config = config or BoostedConfig()
    rows = with_class_weight(labelled_rows(train), balanced=config.balanced)
    stages, numbers, categories = _encoding(rows, config)
    assembler = VectorAssembler(inputCols=numbers + categories, outputCol=VECTOR)
    encoder = Pipeline(stages=[*stages, assembler]).fit(rows)
    encoded = encoder.transform(rows).select(LABEL, WEIGHT, VECTOR)
    encoded.persist(StorageLevel.MEMORY_AND_DISK)

    def fit(i: int) -> GBTClassificationModel:
        trainer = GBTClassifier(
            featuresCol=VECTOR,
            labelCol=LABEL,
            weightCol=WEIGHT,
            maxIter=config.rounds,
            maxDepth=config.max_depth,
            maxBins=config.max_bins,
            stepSize=config.learn_rate,
            subsamplingRate=config.row_share,
            featureSubsetStrategy=str(config.column_share),
            seed=config.seed + i,
            predictionCol=f"_prediction_{i}",
        )
        trainer.setRawPredictionCol(f"_raw_{i}").setProbabilityCol(f"_probability_{i}")
        return trainer.fit(encoded)

    try:
        with ThreadPool(config.parallel_trees) as pool:
            task = inheritable_thread_target(train.sparkSession)(fit)
            ensembles = pool.map(task, range(config.parallel_trees))
    finally:
        encoded.unpersist()
    return PipelineModel(stages=[*encoder.stages, *ensembles])


def boosted_stages(model: PipelineModel) -> list[GBTClassificationModel]:
    return [s for s in model.stages if isinstance(s, GBTClassificationModel)]


def _margin(raw: str):
    return vector_to_array(F.col(raw))[1]


def predict(model: Transformer, rows: DataFrame) -> DataFrame:
    """The rows with the predicted label and the probability of each label.

    Batch or stream. Element 0 of the probabilities is the fraud label.
    """
    scored = model.transform(rows)
    ensembles = boosted_stages(model)
    if ensembles:
        margins = [_margin(m.getRawPredictionCol()) for m in ensembles]
        margin = reduce(lambda a, b: a + b, margins) / len(margins)
        fraud = 1 / (1 + F.exp(-2 * margin))
    else:
        fraud = vector_to_array(F.col("_probability"))[1]
    return (
        scored.withColumn("_fraud", fraud)
        .select(
            *rows.columns,
            F.when(F.col("_fraud") > 0.5, 1).otherwise(0).cast("bigint").alias(PREDICTED),
            label_probabilities(F.col("_fraud")).alias(PROBS),
        )
    )


def compare(predictors: dict[str, Callable[[DataFrame], DataFrame]], test: DataFrame) -> DataFrame:
    """One row per model, in the order given: ROC-AUC, precision, recall and F1 over labelled rows.

    A predictor adds what ``predict`` adds, e.g. ``partial(predict, model)``. All of them score the
    same rows in one pass, and the measures are grouped by model.
    """
    rows, results = labelled_rows(test), []
    for place, predictor in enumerate(predictors.values()):
        result = F.struct(
            F.lit(place).alias("place"),
            F.col(PREDICTED).alias("predicted"),
            prob_of_label(F.col(PROBS), 1).alias("score"),
        )
        results.append(f"_result_{place}")
        rows = predictor(rows).withColumn(results[-1], result).drop(PREDICTED, PROBS)
    each = rows.select(LABEL, F.explode(F.array(*results)).alias("result")).select(LABEL, "result.*")
    measures = evaluation(each, LABEL, "predicted", "score", by=["place"])
    names = test.sparkSession.createDataFrame(list(enumerate(predictors)), "place int, model string")
    return (
        names.join(measures, "place", "left")
        .orderBy("place")
        .select("model", "roc_auc", "precision", "recall", "f1_score")
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """By position; names come from the first frame."""
    return reduce(DataFrame.union, frames)


def save_model(model: PipelineModel, path: str) -> None:
    """Write a model as the newest version below ``path``; the one before stays in use until it is whole."""
    replace_model(SparkSession.active(), path, lambda folder: model.write().save(folder))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(model_folder(SparkSession.active(), path))


def split_nodes(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """Inner nodes of all trees of a saved boosted model: feature index and gain."""
    path = model_folder(spark, path)
    digits = len(str(len(model.stages)))
    frames = [
        spark.read.parquet(f"{path}/stages/{i:0{digits}d}_{stage.uid}/data")
        .where(F.col("nodeData.leftChild") >= 0)
        .select(
            F.col("nodeData.split.featureIndex").alias("feature_index"),
            F.col("nodeData.gain").alias("gain"),
        )
        for i, stage in enumerate(model.stages)
        if isinstance(stage, GBTClassificationModel)
    ]
    if not frames:
        raise ValueError("the model has no boosted trees")
    return union_all(frames)


def split_counts(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """Splits and gain of every feature that some tree splits on."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = [c.split("_", 1)[1] for c in assembler.getInputCols()]
    name_of = F.array(*[F.lit(n) for n in names])
    return (
        split_nodes(spark, model, path)
        .groupBy("feature_index")
        .agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
        .select(F.get(name_of, F.col("feature_index")).alias("feature"), "splits", "gain")
    )


def feature_importance(
    spark: SparkSession, model: PipelineModel, path: str | None = None, k: int = 15
) -> DataFrame:
    """The ``k`` features with the most splits.

    Reads the tree nodes of the model saved at ``path``; saves it first if there
    is none.
    """
    if path is None:
        path = scratch_path(spark, "model")
        save_model(model, path)
    counts = split_counts(spark, model, path)
    importance = F.round(F.col("splits").cast("double"), 4).alias("importance")
    return top_k(counts.select("feature", importance), "importance", "feature", k)
