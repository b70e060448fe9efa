"""Properties that any fitted model must have."""

import pytest
from pyspark.sql import functions as F

from cardwarden.functions.risk import label_probabilities, prob_of_label
from cardwarden.operators import models
from cardwarden.operators.aggregates import class_weights, email_domain_risk
from cardwarden.operators.scoring import PREDICTED, PROBS
from cardwarden.operators.splits import labelled_rows, train_split
from cardwarden.operators.splits import test_split as held_out
from cardwarden.plans.model_run import BOOSTED, LOGISTIC, reports, score_table, train_and_compare
from cardwarden.schemas import LABEL
from checks import bind
from tests.conftest import SMALL

QUICK = models.BoostedConfig(rounds=3, parallel_trees=2, max_depth=3)


@pytest.fixture(scope="module")
def boosted(features):
    return models.train_boosted(train_split(features), QUICK)


@pytest.fixture(scope="module")
def logistic(features):
    return models.train_logistic(train_split(features))


@pytest.mark.parametrize("name", ["boosted", "logistic"])
def test_probabilities(name, request, features):
    model = request.getfixturevalue(name)
    rows = labelled_rows(held_out(features))
    out = models.predict(model, rows)
    assert out.columns == [*rows.columns, PREDICTED, PROBS]
    assert out.count() == rows.count()
    p1, p0 = prob_of_label(F.col(PROBS), 1), prob_of_label(F.col(PROBS), 0)
    bad = out.where((F.abs(p1 + p0 - 1) > 1e-12) | ~p1.between(0, 1))
    assert bad.isEmpty()
    assert out.where((p1 > 0.5) != (F.col(PREDICTED) == 1)).isEmpty()


def test_same_seed_same_model(features, boosted, tmp_path):
    again = models.train_boosted(train_split(features), QUICK)
    rows = labelled_rows(held_out(features))
    want = models.predict(boosted, rows)
    assert models.predict(again, rows).exceptAll(want).isEmpty()
    path = str(tmp_path / "model")
    models.save_model(boosted, path)
    assert models.predict(models.load_model(path), rows).exceptAll(want).isEmpty()


def test_one_ensemble_gives_sparks_own_probability(features):
    model = models.train_boosted(
        train_split(features), models.BoostedConfig(rounds=2, parallel_trees=1, max_depth=2)
    )
    rows = labelled_rows(features)
    ours = models.predict(model, rows).select(
        "TransactionID", prob_of_label(F.col(PROBS), 1).alias("p")
    )
    theirs = model.transform(rows).select(
        "TransactionID", models.vector_to_array("_probability_0")[1].alias("q")
    )
    off = ours.join(theirs, "TransactionID").where("abs(p - q) > 1e-12")
    assert off.isEmpty()


def test_weights_balance_the_classes(features):
    rows = models.with_class_weight(labelled_rows(features))
    totals = [r.w for r in rows.groupBy(LABEL).agg(F.sum(models.WEIGHT).alias("w")).collect()]
    assert totals[0] == pytest.approx(totals[1])
    assert sum(totals) == pytest.approx(labelled_rows(features).count())
    by_label = {r[LABEL]: r.class_weight for r in class_weights(features).collect()}
    for r in rows.select(LABEL, models.WEIGHT).distinct().collect():
        assert r[models.WEIGHT] == pytest.approx(by_label[r[LABEL]])


def test_training_needs_both_labels(features):
    with pytest.raises(ValueError, match="both labels"):
        models.train_logistic(features.where("isFraud = 0"))


def test_importance_counts_every_split(spark, boosted, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(boosted, path)
    inner = sum(
        (tree.numNodes - 1) // 2 for stage in models.boosted_stages(boosted) for tree in stage.trees
    )
    counts = models.split_counts(spark, boosted, path)
    assert counts.agg(F.sum("splits")).first()[0] == inner
    top = models.feature_importance(spark, boosted, path, k=5).collect()
    assert len(top) == min(5, counts.count())
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)
    assert {r.feature for r in top} <= set(QUICK.features)


@pytest.mark.parametrize("values", [20, 5_000])
def test_text_is_encoded_alike_whatever_its_values(features, values):
    wide = train_split(features).withColumn(
        "P_emaildomain", F.concat(F.lit("d"), F.col("TransactionID") % values)
    )
    config = models.BoostedConfig(rounds=2, parallel_trees=1, max_depth=2, max_categories=50)
    model = models.train_boosted(wide, config)
    out = models.predict(model, held_out(features))
    sizes = [len(labels) for labels in model.stages[1].labelsArray]
    assert set(sizes) == {50}
    assert out.count() == held_out(features).count()
    config = models.LogisticConfig(max_categories=50, iterations=3)
    out = models.predict(models.train_logistic(wide, config), held_out(features))
    assert out.count() == held_out(features).count()


def test_labels_other_than_0_and_1_are_refused(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,)], "isFraud int")
    with pytest.raises(ValueError, match="0 or 1"):
        models.with_class_weight(rows)


def test_a_stream_gets_the_batch_predictions(spark, boosted, features, tmp_path):
    features.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(features.schema).parquet(str(tmp_path / "in"))
    query = (
        models.predict(boosted, stream).writeStream.format("memory")
        .queryName("stream_predictions").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.table("stream_predictions")
    assert got.count() == features.count()
    assert got.exceptAll(models.predict(boosted, features)).isEmpty()


def test_whole_run(spark, features, tmp_path):
    out = train_and_compare(
        spark, train_split(features), held_out(features), str(tmp_path), boosted=QUICK
    )
    rows = out["comparison"].collect()
    assert [r.model for r in rows] == [LOGISTIC, BOOSTED]
    assert all(0 <= r.roc_auc <= 1 for r in rows)
    assert out["importance"].columns == ["feature", "importance"]
    scores = score_table(features, str(tmp_path / "model_xgboost"))
    assert scores.count() == labelled_rows(features).count()
    made = reports(bind.transactions(spark, SMALL), scores)
    assert made["rate_by_risk"].agg(F.sum("transactions")).first()[0] == scores.count()
    assert made["overall_rate"].first().transactions == features.count()
    assert made["late_night_lift"].count() == 1 and made["rate_by_product"].count() == 5


def test_models_are_compared_in_one_pass(spark):
    def fixed(share):
        return lambda rows: rows.withColumns(
            {PREDICTED: (F.col("x") * share > 0.5).cast("bigint"), PROBS: label_probabilities(F.col("x") * share)}
        )

    rows = spark.createDataFrame([(0, 0.1), (1, 0.9), (1, 0.4), (0, 0.6), (None, 0.3)], "isFraud int, x double")
    got = models.compare({"b": fixed(1.0), "a": fixed(0.5)}, rows).collect()
    assert [(r.model, r.roc_auc, r.precision, r.recall) for r in got] == [("b", 0.75, 0.5, 0.5), ("a", 0.75, None, 0.0)]
    empty = models.compare({"b": fixed(1.0)}, rows.where("false")).collect()
    assert [(r.model, r.roc_auc, r.f1_score) for r in empty] == [("b", None, None)]


def test_a_blank_domain_is_missing(spark):
    rows = spark.createDataFrame([("", 1), ("a.com", 0), (None, 1)], "P_emaildomain string, isFraud int")
    assert [r.P_emaildomain for r in email_domain_risk(rows).collect()] == ["a.com"]
