"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardwarden.functions.risk import prob_at, prob_of_label, risk_level
from cardwarden.operators import aggregates as agg
from cardwarden.operators import boosted_forest, encoding, metrics, models, splits
from cardwarden.operators import ml_features as mlf
from cardwarden.operators.base_view import base_view, with_timestamp
from cardwarden.operators.history import (
    attach_card_history, attach_out_of_fold, card_history, out_of_fold_rates,
)
from cardwarden.operators.requests import parse_requests, request_features, score_requests
from cardwarden.operators.scoring import PREDICTED, PROBS, fraud_scores, score_join
from cardwarden.plans.feature_tables import build_feature_tables, feature_frame, unbiased_feature_frame
from cardwarden.schemas import (
    FEATURE_TABLE_COLUMNS, IDENTITY, KEY, LABEL, LOGISTIC_FEATURES, STREAM_TABLE, TEXT_FEATURES, TRANSACTIONS,
)
from cardwarden.session import scratch_path
from cardwarden.sources.files import Files
from cardwarden.sources.tables import bucket_count, load_raw, stored
from cardwarden.sources.versions import replace_table
from cardwarden.sources.messages import encode_messages, filter_attr, read_bounded, read_messages
from cardwarden.streaming import ingest
from cardwarden.streaming.bounded import take_messages
from cardwarden.streaming.compaction import compact, create_read_view
from cardwarden.streaming.counters import CounterWriter, counter_totals, create_counter_table, wait_for_batch
from cardwarden.streaming.dedup import start_dedup
from cardwarden.streaming.preview import preview
from cardwarden.streaming.scoring import create_score_table, start_scoring
from checks import bind

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Averages are rounded for the comparison: two engines add in different orders.
DIGITS = 9
ROUNDED = {
    "card1_avg_amt", "card1_std_amt", "card1_historical_fraud_rate", "email_domain_fraud_rate",
}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore avoids a clash."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(c, DIGITS) for c in rows.columns if c in ROUNDED})


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return base_view(bind.transactions(spark, sf), bind.identity(spark, sf))


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_frame(bind.transactions(spark, sf), bind.identity(spark, sf))


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return bind.fixed_predict(splits.labelled_rows(_features(spark, sf)))


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.route_messages(bind.messages(spark, sf))


# Features -------------------------------------------------------------------


@query
def base_view_(spark, sf):
    return _view(spark, sf)


@query
def time_features(spark, sf):
    rows = mlf.time_features(with_timestamp(bind.transactions(spark, sf)))
    return rows.select(KEY, "transaction_timestamp", "tx_hour", "tx_day_of_week", "is_late_night")


@query
def amt_features(spark, sf):
    rows = mlf.amount_features(bind.transactions(spark, sf))
    return rows.select(KEY, "TransactionAmt", "log_tx_amt", "amt_decimal_part", "amt_bucket")


@query
def null_flags(spark, sf):
    rows = mlf.null_flags(_view(spark, sf))
    flags = ["email_is_null", "device_is_null", "is_mobile", "dist1_is_null", "dist2_is_null"]
    return rows.select(KEY, *flags)


@query
def card_aggregates(spark, sf):
    return rounded(agg.card_aggregates(bind.transactions(spark, sf)))


@query
def email_domain_risk(spark, sf):
    return rounded(agg.email_domain_risk(bind.transactions(spark, sf)))


@query
def ml_features(spark, sf):
    return rounded(_features(spark, sf))


@query
def train_split(spark, sf):
    return rounded(splits.train_split(_features(spark, sf)))


@query
def test_split(spark, sf):
    return rounded(splits.test_split(_features(spark, sf)))


@query
def labelled_rows(spark, sf):
    rows = splits.labelled_rows(bind.transactions(spark, sf))
    return rows.select(KEY, LABEL, "TransactionAmt", "ProductCD")


@query
def split_rows(spark, sf):
    features = _stored_features(spark, sf)
    parts = {"train": splits.train_split(features), "test": splits.test_split(features)}
    return models.union_all([f.agg(F.count("*").alias("n")).select(F.lit(n).alias("split"), "n") for n, f in parts.items()])


@query
def card_history_(spark, sf):
    """Of every transaction, what its card did before."""
    rows = bind.transactions(spark, sf).select(KEY, LABEL, "card1", "TransactionDT", "TransactionAmt")
    known = attach_card_history(rows, stored(card_history(rows), "card_history"))
    return rounded(known).select(
        KEY, "card1_tx_count", "card1_avg_amt", "card1_std_amt", "card1_historical_fraud_rate"
    )


@query
def out_of_fold(spark, sf):
    """Of every transaction, the rates of its card and domain over the other folds."""
    rows = bind.transactions(spark, sf).select(KEY, LABEL, "card1", "P_emaildomain")
    for key, rate in (("card1", "card1_historical_fraud_rate"), ("P_emaildomain", "email_domain_fraud_rate")):
        rows = attach_out_of_fold(rows, stored(out_of_fold_rates(rows, key, rate), "rates"), key)
    return rounded(rows.drop("card1", "P_emaildomain", LABEL))


@query
def unbiased_features(spark, sf):
    rows = unbiased_feature_frame(bind.transactions(spark, sf), bind.identity(spark, sf))
    return rounded(rows).drop("amt_zscore_vs_card")


# Tables ---------------------------------------------------------------------


@query
def load_raw_join(spark, sf):
    """Both raw tables as CSV files, loaded into bucketed tables and joined."""
    sources, tables = [], []
    for rows in (bind.transactions(spark, sf), bind.identity(spark, sf)):
        sources.append(scratch_path(spark, "raw"))
        rows.write.csv(sources[-1], header=True)
    buckets = bucket_count(spark, *sources, least=8)
    for path, schema in zip(sources, (TRANSACTIONS, IDENTITY), strict=True):
        table = f"raw_{uuid.uuid4().hex}"
        load_raw(spark, path, table, schema, buckets=buckets)
        tables.append(spark.table(table))
    return base_view(*tables)


@query
def feature_tables(spark, sf):
    """The training rows, read from the tables that the whole job makes."""
    database = f"features_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    built = build_feature_tables(
        spark, bind.transactions(spark, sf), bind.identity(spark, sf), database=database
    )
    return rounded(built["train_data"])


@query
def rebuilt_table(spark, sf):
    """The labelled training rows, from a table that is replaced by its own rows and survives a write that breaks."""
    name = f"rebuilt_{uuid.uuid4().hex}"
    replace_table(bind.transactions(spark, sf).select(KEY, LABEL, "TransactionAmt", "ProductCD"), name)
    try:
        replace_table(spark.table(name).withColumn(LABEL, F.raise_error(F.lit("broken"))), name)
    except Exception as error:
        if "broken" not in str(error):
            raise
    return replace_table(splits.labelled_rows(spark.table(name)), name)


# Reports --------------------------------------------------------------------


@query
def class_weights(spark, sf):
    weights = agg.class_weights(bind.transactions(spark, sf))
    return weights.withColumn("class_weight", F.round("class_weight", DIGITS))


@query
def rate_by_product(spark, sf):
    return agg.rate_by_product(bind.transactions(spark, sf))


@query
def late_night_lift(spark, sf):
    return agg.late_night_lift(with_timestamp(bind.transactions(spark, sf)))


@query
def overall_rate(spark, sf):
    return agg.overall_rate(bind.transactions(spark, sf))


# Scores and metrics ---------------------------------------------------------


@query
def risk_level_(spark, sf):
    p = prob_at(F.col(PROBS), 0)
    return _predictions(spark, sf).select(
        KEY,
        risk_level(p).alias("batch_level"),
        risk_level(p, on_rounded=True).alias("service_level"),
    )


@query
def prob_by_label(spark, sf):
    probs = F.col(PROBS)
    return _predictions(spark, sf).select(
        KEY,
        F.round(prob_of_label(probs, 1), 6).alias("fraud_prob"),
        F.round(prob_of_label(probs, 0), 6).alias("legit_prob"),
        F.round(prob_at(probs, 0), 6).alias("first_prob"),
        prob_at(probs, 2).alias("absent_prob"),
    )


@query
def fraud_scores_(spark, sf):
    return rounded(fraud_scores(_predictions(spark, sf)))


@query
def score_join_(spark, sf):
    features = _stored_features(spark, sf)
    predictions = bind.fixed_predict(splits.labelled_rows(features))
    return rounded(score_join(predictions, features))


@query
def rate_by_risk(spark, sf):
    return agg.rate_by_risk(fraud_scores(_predictions(spark, sf)))


@query
def confusion_metrics(spark, sf):
    measures = metrics.confusion_metrics(_predictions(spark, sf), LABEL, PREDICTED)
    return measures.withColumns(
        {c: F.round(c, DIGITS) for c in ("precision", "recall", "f1_score", "accuracy")}
    )


@query
def roc_auc(spark, sf):
    scores = _predictions(spark, sf).select(LABEL, prob_at(F.col(PROBS), 0).alias("p"))
    return metrics.roc_auc(scores, LABEL, "p").select(F.round("roc_auc", DIGITS).alias("roc_auc"))


def _fixed_predictor(name):
    return lambda rows: bind.fixed_predict(rows, name)


@query
def model_comparison(spark, sf):
    predictors = {n: _fixed_predictor(n) for n in ("Logistic Regression", "XGBoost")}
    compared = models.compare(predictors, splits.test_split(_features(spark, sf)))
    measures = ("roc_auc", "precision", "recall", "f1_score")
    return compared.withColumns({c: F.round(c, DIGITS) for c in measures})


@query
def union_scores(spark, sf):
    rows = splits.labelled_rows(_stored_features(spark, sf))
    scored = [
        bind.fixed_predict(rows, name).select(
            KEY, F.lit(name).alias("model"), F.round(prob_of_label(F.col(PROBS), 1), 6).alias("fraud_probability")
        )
        for name in bind.FIXED_SCORES
    ]
    return models.union_all(scored)


@query
def top_k(spark, sf):
    cards = agg.card_aggregates(bind.transactions(spark, sf)).select(
        "card1", F.round("card1_historical_fraud_rate", DIGITS).alias("fraud_rate")
    )
    return metrics.top_k(cards, by="fraud_rate", name="card1", k=15)


# Messages -------------------------------------------------------------------


@query
def bounded_read(spark, sf):
    return read_bounded(bind.messages(spark, sf), 100, ["event_id"]).select("event_id")


@query
def encode_messages_(spark, sf):
    encoded = encode_messages(bind.message_rows(spark, sf).drop("event_id"))
    fields = F.from_json("value", "TransactionID bigint, TransactionAmt double, card1 bigint")
    return encoded.select(
        fields["TransactionID"].alias("TransactionID"),
        fields["TransactionAmt"].alias("TransactionAmt"),
        fields["card1"].alias("card1"),
        F.col("attributes")["is_fraud"].alias("is_fraud"),
        F.col("attributes")["product_cd"].alias("product_cd"),
    )


@query
def filter_attr_(spark, sf):
    encoded = encode_messages(bind.message_rows(spark, sf).drop("event_id"))
    risky = filter_attr(encoded, "product_cd", "C")
    return risky.select(
        F.get_json_object("value", "$.TransactionID").cast("bigint").alias("TransactionID")
    )


@query
def preview_(spark, sf):
    return preview(bind.message_rows(spark, sf), 10, [KEY])


@query
def parse_json(spark, sf):
    parsed = ingest.parse_messages(bind.messages(spark, sf))
    return parsed.select("event_id", F.col("fields").isNotNull().cast("bigint").alias("parsed"))


@query
def validate_required(spark, sf):
    checked = ingest.validate(ingest.parse_messages(bind.messages(spark, sf)))
    return checked.where(F.col("missing").isNotNull()).select(
        "event_id", F.array_join("missing", ",").alias("missing")
    )


@query
def cast_fields(spark, sf):
    cast = ingest.cast_fields(ingest.validate(ingest.parse_messages(bind.messages(spark, sf))))
    names = ["TransactionID", "TransactionAmt", "card1", "addr1", "addr2", "dist1", "isFraud", "tx_hour"]
    return cast.where(F.col("record").isNotNull()).select(
        "event_id",
        *[F.col("record")[n].alias(n) for n in names],
        F.array_join("bad_fields", ",").alias("bad_fields"),
    )


def _conformed(rows):
    names = [f.name for f in STREAM_TABLE if f.name != ingest.STAMP]
    return rows.select(*names, F.col(ingest.STAMP).isNotNull().cast("bigint").alias("is_stamped"))


@query
def conform_schema(spark, sf):
    return _conformed(ingest.conform(_routed(spark, sf)))


@query
def stream_ingest(spark, sf):
    """The messages as files of lines, read and written by the streaming job."""
    path, tag = scratch_path(spark, "messages"), uuid.uuid4().hex
    bind.messages(spark, sf).select("value").write.text(path)
    table, refused = f"stream_{tag}", f"refused_{tag}"
    ingest.create_stream_tables(spark, table, refused)
    ingest.start_ingest(
        read_messages(spark, path), table, refused, scratch_path(spark, "ingest"), stream=f"ingest_{tag}", available_now=True
    ).awaitTermination()
    return _conformed(spark.table(table))


def _ingest_parts(spark, sf, table, refused, checkpoint):
    """The messages in four parts, each ingested as a batch in a run of its own; yields the query after each run."""
    path = scratch_path(spark, "messages")
    messages = stored(bind.messages(spark, sf).select("value", (F.rand(1) * 4).cast("int").alias("part")), "messages")
    had = 0
    for part in range(4):
        messages.where(F.col("part") == part).select("value").write.mode("append").text(path)
        # as many files as tasks wrote, all of them in one batch
        have = sum(name.startswith("part-") for name in Files(spark).names(path))
        query = ingest.start_ingest(
            read_messages(spark, path, max_files_per_trigger=have - had), table, refused, checkpoint, available_now=True
        )
        had = have
        query.awaitTermination()
        yield query


@query
def ingest_ledger(spark, sf):
    """The valid records appended to a table of the declared columns only; every batch is written twice."""
    table = f"plain_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STREAM_TABLE)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")
    routed = stored(_routed(spark, sf), "routed")
    for batch, part in enumerate((routed.where("route = 'valid' AND record.TransactionID % 2 = 0"), routed.where("record.TransactionID % 2 <> 0"))):
        for _ in range(2):
            ingest.write_valid(part, table, "messages", batch)
    return _conformed(spark.table(table))


@query
def ingest_compacted(spark, sf):
    """The valid records as readers see them after batches were compacted twice."""
    tag, checkpoint = uuid.uuid4().hex, scratch_path(spark, "ingest")
    table, refused, view = f"stream_{tag}", f"refused_{tag}", f"all_{tag}"
    ingest.create_stream_tables(spark, table, refused)
    create_read_view(spark, view, table)
    for run, _ in enumerate(_ingest_parts(spark, sf, table, refused, checkpoint)):
        if run % 2 == 0:
            compact(spark, table, view, checkpoint)
    return _conformed(spark.table(view))


@query
def ingest_counters(spark, sf):
    """Messages per route, from the rows that a listener has written for each batch over several runs."""
    tag, checkpoint = uuid.uuid4().hex, scratch_path(spark, "ingest")
    table, refused, counters = f"stream_{tag}", f"refused_{tag}", f"counters_{tag}"
    ingest.create_stream_tables(spark, table, refused)
    create_counter_table(spark, counters)
    listener = CounterWriter(spark, counters)
    spark.streams.addListener(listener)
    try:
        for query_ in _ingest_parts(spark, sf, table, refused, checkpoint):
            wait_for_batch(spark, counters, str(query_.id), query_.lastProgress.batchId)
    finally:
        spark.streams.removeListener(listener)
    return counter_totals(spark, counters)


@query
def stream_dedup(spark, sf):
    """The valid records, then all of them again with another amount: the first of each id stays, also over a restart."""
    path, tag = scratch_path(spark, "records"), uuid.uuid4().hex
    table, checkpoint = f"unique_{tag}", scratch_path(spark, "dedup")
    first = stored(_conformed(ingest.conform(_routed(spark, sf))), "records")
    ingest.create_batch_table(spark, table, first.schema)
    for records in (first, first.withColumn("TransactionAmt", F.col("TransactionAmt") + 1)):
        records.write.mode("append").parquet(path)
        start_dedup(
            spark.readStream.schema(first.schema).parquet(path), table, checkpoint,
            event_time=F.timestamp_seconds("TransactionDT"), delay="3650 days", stream=table, available_now=True,
        ).awaitTermination()
    return spark.table(table).drop(*ingest.BATCH_PARTITION)


@query
def stream_bounded(spark, sf):
    """Half of the messages, taken from a stream in two runs, and how many different ones they are."""
    path, tag = scratch_path(spark, "messages"), uuid.uuid4().hex
    table, checkpoint = f"bounded_{tag}", scratch_path(spark, "bounded")
    messages = stored(bind.messages(spark, sf).select("value"), "messages")
    ingest.create_batch_table(spark, table, messages.schema)
    n = messages.count() // 2
    for part in messages.randomSplit([1.0, 1.0, 1.0, 1.0], seed=1):
        part.repartition(2).write.mode("append").text(path)
        take_messages(read_messages(spark, path, max_files_per_trigger=1), n, table, checkpoint, table)
    taken = spark.table(table).join(messages.distinct(), "value", "left_semi")
    return taken.agg(F.count("*").alias("taken"), F.count_distinct("value").alias("different"))


@query
def dead_letters(spark, sf):
    return ingest.dead_letters(_routed(spark, sf)).select(
        "reason", KEY, F.array_join("missing", ",").alias("missing"),
        F.array_join("bad_fields", ",").alias("bad_fields"),
    )


@query
def route_totals(spark, sf):
    return ingest.stream_totals(_routed(spark, sf))


@query
def request_features_(spark, sf):
    parsed = parse_requests(bind.requests(spark, sf))
    rows = request_features(parsed, clock=F.col("clock"))
    columns = [c for c in FEATURE_TABLE_COLUMNS if c not in (KEY, LABEL)]
    return rows.where(F.col("error").isNull()).select("event_id", *columns)


@query
def score_requests_(spark, sf):
    answers = score_requests(bind.requests(spark, sf), bind.fixed_predict, clock=F.col("clock"))
    return answers.drop("clock", "value")


@query
def stream_scores(spark, sf):
    """The requests as files, read, scored and written by the streaming job."""
    path, tag = scratch_path(spark, "requests"), uuid.uuid4().hex
    written = bind.requests(spark, sf)
    written.write.parquet(path)
    table = f"scores_{tag}"
    source = spark.readStream.schema(written.schema).parquet(path)
    create_score_table(source, table)
    start_scoring(
        source, bind.fixed_predict, table, scratch_path(spark, "scoring"), clock=F.col("clock"),
        stream=table, available_now=True,
    ).awaitTermination()
    return spark.table(table).drop("clock", "value", *ingest.BATCH_PARTITION)


# Models: no SQL equivalent, checked for invariants by the tests ---------------


def _stored_features(spark, sf):
    return stored(_features(spark, sf), "ml_features")


def _test_scores(train, features):
    model = train(splits.train_split(features))
    test = splits.labelled_rows(splits.test_split(features))
    return models.predict(model, test).select(
        KEY, LABEL, PREDICTED, prob_of_label(F.col(PROBS), 1).alias("fraud_probability")
    )


@query
def train_logistic(spark, sf):
    return _test_scores(models.train_logistic, _stored_features(spark, sf))


@query
def train_boosted(spark, sf):
    return _test_scores(models.train_boosted, _stored_features(spark, sf))


@query
def model_fraud_scores(spark, sf):
    features = _stored_features(spark, sf)
    model = models.train_boosted(splits.train_split(features))
    return fraud_scores(models.predict(model, splits.labelled_rows(features)))


@query
def feature_importance(spark, sf):
    model = models.train_boosted(splits.train_split(_stored_features(spark, sf)))
    return models.feature_importance(spark, model)


# Models of one 0/1 feature, whose probabilities have a closed form --------------


ONE = ["is_late_night"]


def _one_split(features):
    config = models.BoostedConfig(
        features=ONE, rounds=1, parallel_trees=1, row_share=1.0, column_share=1.0, max_depth=1
    )
    return models.train_boosted(splits.train_split(features), config)


def _rounded_scores(rows, digits):
    return rows.withColumn("fraud_probability", F.round("fraud_probability", digits))


@query
def logistic_one_feature(spark, sf):
    config = models.LogisticConfig(features=ONE, l2=0.0, iterations=100)
    features = _stored_features(spark, sf)
    return _rounded_scores(_test_scores(lambda t: models.train_logistic(t, config), features), 5)


@query
def boosted_one_feature(spark, sf):
    features = _stored_features(spark, sf)
    return _rounded_scores(_test_scores(lambda _: _one_split(features), features), DIGITS)


@query
def boosted_one_feature_scores(spark, sf):
    features = _stored_features(spark, sf)
    return rounded(fraud_scores(models.predict(_one_split(features), splits.labelled_rows(features))))


@query
def boosted_one_feature_splits(spark, sf):
    return models.feature_importance(spark, _one_split(_stored_features(spark, sf)))


# Models of a forest a round, and what they learn from the rows besides trees --------


@query
def category_codes(spark, sf):
    """Codes of the frequent values of each text feature, by the training rows."""
    rows = splits.labelled_rows(splits.train_split(_stored_features(spark, sf)))
    return encoding.frequent_values(rows, TEXT_FEATURES, 198)


@query
def number_means(spark, sf):
    """What stands for a missing number."""
    rows = splits.labelled_rows(splits.train_split(_stored_features(spark, sf)))
    numbers = [c for c in LOGISTIC_FEATURES if c not in TEXT_FEATURES]
    return encoding.number_means(rows, numbers).select(*[F.round(c, 6).alias(c) for c in numbers])


@query
def boosted_forest_(spark, sf):
    """The full model: 50 rounds of four trees."""
    return _test_scores(boosted_forest.train_boosted_forest, _stored_features(spark, sf))


@query
def boosted_forest_two_rounds(spark, sf):
    config = boosted_forest.ForestConfig(features=ONE, rounds=2, row_share=1.0, column_share=1.0, max_depth=1)
    features = _stored_features(spark, sf)
    return _rounded_scores(_test_scores(lambda t: boosted_forest.train_boosted_forest(t, config), features), DIGITS)
