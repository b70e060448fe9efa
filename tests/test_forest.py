"""Encodings learnt from training rows, and boosting with a forest a round."""

import math
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import functions as F

from cardwarden.functions.risk import prob_of_label
from cardwarden.operators import models
from cardwarden.operators.boosted_forest import ForestConfig, train_boosted_forest
from cardwarden.operators import boosted_forest
from cardwarden.operators.encoding import fit_encoding, fitted_stages, frequent_values, number_means
from cardwarden.operators.scoring import PROBS
from cardwarden.operators.splits import labelled_rows, train_split
from cardwarden.operators import tree_growth
from cardwarden.operators.tree_growth import batch_columns, grow
from cardwarden.operators.splits import test_split as held_out
from cardwarden.schemas import KEY, LABEL
from checks.queries import ONE

QUICK = ForestConfig(rounds=3, max_depth=3)


@pytest.fixture(scope="module")
def forest(features):
    return train_boosted_forest(train_split(features), QUICK)


def _probability(model, rows):
    return models.predict(model, rows).select(KEY, LABEL, prob_of_label(F.col(PROBS), 1).alias("p"))


def _encoded(encoding, rows):
    stages, numbers, categories = fitted_stages(encoding)
    for stage in stages:
        rows = stage.transform(rows)
    return rows.select(*numbers, *categories)


def test_frequent_values_have_codes_of_their_own(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 4 == 0, "gmail.com").when(F.col("id") % 4 == 1, "aol.com")
        .when(F.col("id") % 40 == 2, "").when(F.col("id") % 40 == 6, None)
        .otherwise(F.concat(F.lit("d"), F.col("id"))).alias("P_emaildomain"),
        F.lit("T").alias("M4"),
    )
    found = {(r.feature, r.value): (r.n, r.code) for r in frequent_values(rows, ["P_emaildomain", "M4"], 198).collect()}
    # equal counts go by value; values of a single row are not frequent
    assert found == {("P_emaildomain", "aol.com"): (5000, 0), ("P_emaildomain", "gmail.com"): (5000, 1), ("M4", "T"): (20_000, 0)}
    encoding = fit_encoding(rows, ["P_emaildomain", "M4"], 200)
    codes = _encoded(encoding, spark.createDataFrame([("gmail.com",), ("aol.com",), ("",), (None,), ("new.org",), ("d7",)], "P_emaildomain string").withColumn("M4", F.lit(None).cast("string")))
    assert [r.cat_P_emaildomain for r in codes.collect()] == [2.0, 1.0, 0.0, 0.0, 3.0, 3.0]
    # no more codes than there are categories
    assert len(fit_encoding(rows, ["P_emaildomain"], 3).codes["P_emaildomain"]) == 1


def test_missing_numbers_become_the_mean(spark):
    rows = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (4.0, None)], "D1 double, D4 double")
    assert number_means(rows, ["D1", "D4"]).first().asDict() == {"D1": 2.5, "D4": 0.0}
    encoding = fit_encoding(rows, ["D1", "D4"], 200)
    assert [tuple(r) for r in _encoded(encoding, rows).collect()] == [(1.0, 0.0), (2.5, 0.0), (2.5, 0.0), (4.0, 0.0)]


def test_probabilities_and_importance(spark, forest, features, tmp_path):
    out = _probability(forest, labelled_rows(held_out(features)))
    assert out.where(~F.col("p").between(0, 1)).isEmpty() and out.agg(F.count_distinct("p")).first()[0] > 5
    path = str(tmp_path / "forest")
    models.save_model(forest, path)
    again = _probability(models.load_model(path), labelled_rows(held_out(features)))
    assert again.exceptAll(out).isEmpty()
    (stage,) = models.boosted_stages(forest)
    assert len(stage.trees) == 12
    inner = sum((tree.numNodes - 1) // 2 for tree in stage.trees)
    assert models.split_counts(spark, forest, path).agg(F.sum("splits")).first()[0] == inner


def test_same_seed_same_forest(features, forest):
    rows = labelled_rows(held_out(features))
    again = train_boosted_forest(train_split(features), QUICK)
    assert _probability(again, rows).exceptAll(_probability(forest, rows)).isEmpty()


def test_each_tree_draws_its_columns(features):
    config = ForestConfig(features=["TransactionAmt", "C1", "C2", "D1"], rounds=2, column_share=0.25, max_depth=2)
    model = train_boosted_forest(train_split(features), config)
    for stage in models.boosted_stages(model):
        for tree in stage.trees:
            used = [i for i, v in enumerate(tree.featureImportances.toArray()) if v > 0]
            assert len(used) <= 1


def test_one_tree_a_round_on_all_rows_is_newtons_step(features):
    """All trees alike, one split: the closed form in checks.oracle, here for one round."""
    config = ForestConfig(features=ONE, rounds=1, row_share=1.0, column_share=1.0, max_depth=1, balanced=False)
    rows = labelled_rows(train_split(features))
    got = {r.is_late_night: r.p for r in models.predict(train_boosted_forest(rows, config), rows).select("is_late_night", prob_of_label(F.col(PROBS), 1).alias("p")).distinct().collect()}
    for r in rows.groupBy("is_late_night").agg(F.avg(LABEL).alias("y")).collect():
        assert got[r.is_late_night] == pytest.approx(1 / (1 + math.exp(-0.3 * 4 * (r.y - 0.5))))


def test_a_leaf_holds_the_least_hessian(features):
    """Half of the whole hessian in each leaf leaves no room for a second split."""
    rows = labelled_rows(train_split(features))
    config = ForestConfig(rounds=1, row_share=1.0, column_share=1.0, balanced=False, least_hessian=rows.count() * 0.25 * 0.45)
    (stage,) = models.boosted_stages(train_boosted_forest(rows, config))
    assert all(tree.depth <= 1 for tree in stage.trees)


def test_both_models_compare(features):
    train = train_split(features)
    predictors = {"forest": partial(models.predict, train_boosted_forest(train, QUICK)),
                  "logistic": partial(models.predict, models.train_logistic(train, models.LogisticConfig(encoding="frequent")))}
    assert [r.model for r in models.compare(predictors, held_out(features)).collect()] == ["forest", "logistic"]
    with pytest.raises(ValueError, match="encoding"):
        models.train_logistic(train, models.LogisticConfig(encoding="other"))


@pytest.mark.parametrize("least", [0.0, 0.05])
def test_a_grown_tree_is_sparks(spark, least):
    """On rows with more values than bins, zeros, and categories of which one is empty; two trees draw other rows and columns."""
    rows = spark.range(3000).select(
        "id", (F.round(F.randn(1) * 5, 2) * (F.rand(2) < 0.8).cast("int")).alias("a"), F.round(F.rand(3) * 9).alias("b"),
        F.floor(F.rand(4) * 5).cast("string").alias("c"), F.randn(5).alias("noise"), (F.rand(6) + 0.1).alias("weight"),
    )
    rows = rows.withColumn("target", F.sin("a") + F.col("b") * (F.col("c") == "2").cast("int") / 5 + F.col("noise") / 3)
    rows = StringIndexerModel.from_labels(list("03142") + ["none"], "c", "n").transform(rows)
    rows = VectorAssembler(inputCols=["a", "b", "n"], outputCol="x").transform(rows).cache()
    plain = rows.select(models.vector_to_array("x").alias("x"), "target", "weight", F.array(F.lit(True), F.col("id") % 3 > 0).alias("drawn"))

    def read(batch):
        return batch_columns(batch, "x"), batch["target"].to_numpy(), batch["weight"].to_numpy(), batch_columns(batch, "drawn")

    grown = grow(plain, plain, read, [[0, 1, 2], [0, 2]], {2: 6}, 32, 4, lambda _: least)
    for tree, columns, drawn in zip(grown, (["a", "b", "n"], ["a", "n"]), (rows, rows.where("id % 3 > 0"))):
        ours = DecisionTreeRegressionModel(boosted_forest._spark_tree(spark, tree, {2: 6}, 3)).setFeaturesCol("x").setPredictionCol("p")
        vectors = VectorAssembler(inputCols=columns, outputCol="own")
        theirs = DecisionTreeRegressor(featuresCol="own", labelCol="target", weightCol="weight", maxDepth=4, maxBins=32, minWeightFractionPerNode=least).fit(vectors.transform(drawn))
        both = theirs.transform(vectors.transform(ours.transform(rows))).select("p", "prediction").collect()
        assert ours.numNodes == theirs.numNodes > 5
        assert np.allclose([r.p for r in both], [r.prediction for r in both], rtol=1e-9)


def test_a_round_takes_as_many_jobs_whatever_its_trees(spark, features):
    rows, jobs = train_split(features), []
    for trees in (1, 4):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "a round")
        try:
            train_boosted_forest(rows, ForestConfig(features=["TransactionAmt", "C1"], rounds=1, trees=trees, column_share=1.0, max_depth=3))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    assert 0 < jobs[1] <= jobs[0] + 2


def test_equal_targets_are_not_split(spark):
    rows = spark.range(1000).select(F.array(F.col("id").cast("double")).alias("x"), F.lit(0.1).alias("target"), (F.rand(1) + 0.1).alias("weight"), F.array(F.lit(True)).alias("drawn"))

    def read(batch):
        return batch_columns(batch, "x"), batch["target"].to_numpy(), batch["weight"].to_numpy(), batch_columns(batch, "drawn")

    (tree,) = grow(rows, rows, read, [[0]], {}, 32, 4, lambda _: 0.0)
    assert len(tree.feature) == 1
    with pytest.raises(Exception, match="NaN or infinite"):
        grow(rows.withColumn("x", F.array(F.lit(float("inf")))), rows, read, [[0]], {}, 32, 4, lambda _: 0.0)
    with pytest.raises(ValueError, match="needs rows"):
        grow(rows.withColumn("drawn", F.array(F.lit(False))), rows, read, [[0]], {}, 32, 4, lambda _: 0.0)


def test_bins_are_of_drawn_rows_and_columns_and_in_large_blocks():
    rng = np.random.default_rng(3)
    batches = [pa.RecordBatch.from_arrays([pa.array(rng.random(40))], ["x"]) for _ in range(5)]
    drawn = lambda x: np.array([x < 0.5, x >= 0.25])
    read = lambda batch: (np.array([batch["x"].to_numpy()] * 3), batch["x"].to_numpy(), np.ones(batch.num_rows), drawn(batch["x"].to_numpy()))
    places = [{0: np.array([0.1, 0.3])}, {1: np.array([0.5]), 2: np.array([0.2, 0.9])}]
    (block,) = tree_growth._binned(iter(batches), read, places, np.uint8)
    x = np.concatenate([b["x"].to_numpy() for b in batches])
    first, second = (x[own] for own in drawn(x))
    expected = [np.searchsorted(places[0][0], first), np.searchsorted([0.5], second), np.searchsorted([0.2, 0.9], second)]
    assert np.frombuffer(block["bins"][0].as_py(), np.uint8).tolist() == np.concatenate(expected).tolist()
    assert np.frombuffer(block["target"][0].as_py()).tolist() == x.tolist()
