"""Batch scores with repeated ids, and requests at the edges."""

from datetime import datetime

from pyspark.sql import functions as F

from cardwarden.operators.requests import parse_requests, request_features, score_requests
from cardwarden.operators.scoring import fraud_scores, fraud_scores_checked, score_join
from cardwarden.operators.splits import labelled_rows
from checks import bind


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_unique_ids_need_no_join(features):
    predictions = bind.fixed_predict(labelled_rows(features))
    scores = fraud_scores_checked(predictions, features)
    assert _same(scores, fraud_scores(predictions))
    assert _same(scores, score_join(predictions, features))
    assert len(scores.columns) == 17
    assert "Join" not in scores._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_ids_fan_out(features):
    twice = features.where("TransactionID < 20").select("*", F.explode(F.array(F.lit(0), F.lit(1))))
    twice = twice.withColumn(
        "isFraud", F.when(F.col("col") == 0, F.coalesce("isFraud", F.lit(0)))
    ).drop("col")
    predictions = bind.fixed_predict(labelled_rows(twice))
    scores = fraud_scores_checked(predictions, twice)
    # One labelled prediction of each id meets two feature rows, one without a label.
    assert scores.count() == 40
    assert scores.where("actual_fraud IS NULL").count() == 20


def _answers(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    clock = F.lit(datetime(2024, 1, 6, 3, 0)).cast("timestamp")
    return frame, clock


def test_request_errors(spark):
    cases = {
        '{"TransactionAmt": 10}': None,
        '{"TransactionAmt": "10.5"}': None,
        '{"TransactionAmt": true}': None,
        '{"TransactionAmt": 10, "card1": 12.0}': None,
        '{"TransactionAmt": 10, "card1": "12"}': None,
        '{"TransactionAmt": 10, "card4": "it\'s"}': None,
        '{"TransactionAmt": 10, "ProductCD": null, "addr1": null, "D15": null}': None,
        '{"TransactionAmt": null}': "invalid_request",
        "{}": "invalid_request",
        "[]": "invalid_request",
        "not json": "invalid_request",
        '{"TransactionAmt": "ten"}': "invalid_request",
        '{"TransactionAmt": 10, "card1": 12.5}': "invalid_request",
        '{"TransactionAmt": 10, "card4": 5}': "invalid_request",
        '{"TransactionAmt": 10, "C1": [1]}': "invalid_request",
        '{"TransactionAmt": -1}': "scoring_failed",
        '{"TransactionAmt": NaN}': "scoring_failed",
        '{"TransactionAmt": Infinity}': "scoring_failed",
        '{"TransactionAmt": 10, "C13": null}': "scoring_failed",
        '{"TransactionAmt": 10, "email_domain_fraud_rate": null}': "scoring_failed",
        '{"TransactionAmt": 10, "card1_avg_amt": NaN}': "scoring_failed",
    }
    frame, clock = _answers(spark, list(cases))
    answers = score_requests(frame, bind.fixed_predict, clock).orderBy("i").collect()
    assert [a.error for a in answers] == list(cases.values())
    for a in answers:
        assert (a.fraud_probability is None) == (a.error is not None)
        assert (a.model == "xgboost") == (a.error is None)


def test_request_defaults(spark):
    texts = [
        '{"TransactionAmt": 299.99}',
        '{"TransactionAmt": 299.99, "card1": 0, "card1_tx_count": 0, "card1_avg_amt": 0, "card1_std_amt": null}',
        '{"TransactionAmt": 299.99, "card1_avg_amt": 100, "card1_std_amt": 50, "P_emaildomain": "x"}',
    ]
    frame, clock = _answers(spark, texts)
    rows = request_features(parse_requests(frame), clock).orderBy("i").collect()
    first, second, third = rows
    assert (first.ProductCD, first.card1, first.card1_tx_count) == ("W", 1000, 1)
    assert (first.C1, first.C5, first.addr1, first.D15) == (1.0, 0.0, 0.0, 0.0)
    assert (first.dist1_is_null, first.email_is_null, first.is_mobile) == (1, 1, 0)
    assert first.card1_historical_fraud_rate == first.email_domain_fraud_rate == 0.035
    assert (first.tx_hour, first.tx_day_of_week, first.is_late_night) == (3, 5, 1)
    assert (first.amt_bucket, first.log_tx_amt, first.amt_decimal_part) == ("high", 5.7071, -0.01)
    assert (second.card1, second.card1_tx_count) == (1000, 1)
    assert (second.card1_avg_amt, second.card1_std_amt) == (299.99, 1.0)
    assert second.amt_zscore_vs_card == 0.0
    assert (third.amt_zscore_vs_card, third.email_is_null) == (3.9998, 0)
