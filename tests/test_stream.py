"""Ingest and scoring as streams: restart, replay, refusal, equality with batch."""



import pytest
from pyspark.sql import functions as F

from cardwarden.operators.requests import score_requests
from cardwarden.sources.messages import encode_messages, filter_attr, read_messages, with_attributes
from cardwarden.schemas import STREAM_TABLE
from cardwarden.streaming import ingest
from cardwarden.streaming.scoring import create_score_table, start_scoring
from checks import bind
from tests.conftest import SMALL


@pytest.fixture
def tables(spark):
    names = ("streaming_transactions", "dead_letter")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    ingest.create_stream_tables(spark, *names)
    yield names
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _write(messages, folder):
    messages.select("value").coalesce(1).write.mode("append").text(str(folder))


def _run(spark, source, tables, checkpoint, files=None):
    query = ingest.start_ingest(
        read_messages(spark, path=str(source), max_files_per_trigger=files),
        *tables, checkpoint=str(checkpoint), available_now=True,
    )
    query.awaitTermination()
    return query


def _counts(spark, tables):
    for name in tables:  # the stream writes in a session of its own
        spark.catalog.refreshTable(name)
    good = spark.table(tables[0]).count()
    bad = {r.reason: r["count"] for r in spark.table(tables[1]).groupBy("reason").count().collect()}
    return good, bad


def test_ingest_restart_and_replay(spark, tables, tmp_path):
    source, checkpoint = tmp_path / "in", tmp_path / "checkpoint"
    messages = bind.messages(spark, SMALL)
    want = {r.route: r.messages for r in ingest.stream_totals(ingest.route_messages(messages)).collect()}
    half = F.col("event_id") < 500

    _write(messages.where(half), source)
    query = _run(spark, source, tables, checkpoint)
    seen = [p.observedMetrics["ingest"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m.messages for m in seen) == 500
    first = _counts(spark, tables)

    _write(messages.where(~half), source)
    _run(spark, source, tables, checkpoint, files=1)
    good, bad = _counts(spark, tables)
    assert {"valid": good, **bad} == want
    assert first[0] < good

    # Nothing new: nothing changes.
    _run(spark, source, tables, checkpoint)
    assert _counts(spark, tables) == (good, bad)

    # The second batch runs again, as after a failure before its commit.
    owner = spark.table(tables[0]).select("ingest_stream").first()[0]
    write = ingest.batch_writer(*tables, stream=owner)
    write(ingest.route_messages(messages.where(~half)), 1)
    assert _counts(spark, tables) == (good, bad)

    row = spark.table(tables[0]).orderBy("TransactionID").first()
    assert row.ingested_at.year >= 2025
    raw = spark.table(tables[1]).where("reason = 'malformed'").first()
    assert len(raw.value) > 100


def test_two_checkpoints_share_a_table(spark, tables, tmp_path):
    """Both count their batches from 0, and neither replaces the other's rows."""
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.txt").write_text("".join(f'{{"{name}": {i}}}\n' for i in range(5)))
        _run(spark, str(tmp_path / name), tables, str(tmp_path / f"checkpoint-{name}"))
    assert sum(_counts(spark, tables)[1].values()) == 10


def test_tables_must_exist(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="does not exist"):
        ingest.start_ingest(
            read_messages(spark, path=str(tmp_path / "in")), "no_table", "no_letters", str(tmp_path / "c")
        )


def test_source_needs_exactly_one_kind(spark):
    with pytest.raises(ValueError):
        read_messages(spark)


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    requests = bind.requests(spark, SMALL).where("event_id % 9 <> 5 OR event_id < 500")
    folder = tmp_path / "requests"
    requests.select(F.to_json(F.struct("event_id", "clock", "value")).alias("value")).write.text(str(folder))
    envelope = spark.readStream.format("text").load(str(folder)).select(
        F.from_json("value", "event_id bigint, clock timestamp, value string").alias("m")
    )
    query = (
        score_requests(envelope.select("m.*"), bind.fixed_predict, clock=F.col("clock"))
        .writeStream.format("memory")
        .queryName("stream_scores")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batch = score_requests(requests, bind.fixed_predict, clock=F.col("clock"))
    streamed = spark.table("stream_scores")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).isEmpty()


def test_stream_totals_in_complete_mode(spark, tmp_path):
    rows = bind.message_rows(spark, SMALL).drop("event_id")
    _write(encode_messages(rows), tmp_path / "in")
    totals = ingest.stream_totals(
        ingest.route_messages(read_messages(spark, path=str(tmp_path / "in")))
    )
    query = (
        totals.writeStream.format("memory").queryName("stream_totals")
        .outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r.route: r for r in spark.table("stream_totals").collect()}
    # Only the transaction with id 0 counts as missing its id.
    assert got["invalid"].messages == 1
    assert got["valid"].messages == rows.count() - 1
    assert got["valid"].fraud + got["valid"].legit == got["valid"].messages


def test_append_to_a_table_of_the_declared_columns(spark, tables, tmp_path):
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reversed(STREAM_TABLE.fields))
    spark.sql("DROP TABLE IF EXISTS plain_transactions")
    spark.sql(f"CREATE TABLE plain_transactions ({columns}) USING parquet")
    messages = bind.messages(spark, SMALL)
    _write(messages, tmp_path / "in")
    outputs = ("plain_transactions", tables[1])
    _run(spark, tmp_path / "in", outputs, tmp_path / "checkpoint")
    want = ingest.conform(ingest.route_messages(messages)).drop("ingested_at")
    got = spark.table("plain_transactions").select(want.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()
    spark.sql("DROP TABLE plain_transactions")


def test_scoring_restart_and_replay(spark, tmp_path):
    requests = bind.requests(spark, SMALL)
    half, source = F.col("event_id") < 500, str(tmp_path / "requests")
    spark.sql("DROP TABLE IF EXISTS scores")
    create_score_table(requests, "scores")

    def run():
        stream = spark.readStream.schema(requests.schema).parquet(source)
        start_scoring(
            stream, bind.fixed_predict, "scores", str(tmp_path / "checkpoint"),
            clock=F.col("clock"), available_now=True,
        ).awaitTermination()
        spark.catalog.refreshTable("scores")

    requests.where(half).coalesce(1).write.mode("append").parquet(source)
    run()
    assert spark.table("scores").count() == requests.where(half).count()
    requests.where(~half).coalesce(1).write.mode("append").parquet(source)
    run()
    want = score_requests(requests, bind.fixed_predict, clock=F.col("clock"))
    got = spark.table("scores").select(want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()

    # The last batch was written, but its commit was lost: it runs again and changes nothing.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    again = spark.table("scores").select(want.columns)
    assert again.count() == want.count()
    assert again.exceptAll(want).isEmpty()
    spark.sql("DROP TABLE scores")


def test_headers_become_attributes(spark):
    frame = spark.sql(
        """SELECT * FROM VALUES
        (1, array(named_struct('key', 'is_fraud', 'value', binary('0')),
                  named_struct('key', 'is_fraud', 'value', binary('1')),
                  named_struct('key', 'empty', 'value', CAST(NULL AS BINARY)))),
        (2, array(named_struct('key', 'is_fraud', 'value', binary('0')))),
        (3, CAST(NULL AS ARRAY<STRUCT<key: STRING, value: BINARY>>)) AS t(id, headers)"""
    )
    got = with_attributes(frame)
    assert {r.id: r.attributes for r in got.collect()} == {
        1: {"is_fraud": "1", "empty": None}, 2: {"is_fraud": "0"}, 3: None,
    }
    assert [r.id for r in filter_attr(got, "is_fraud", "1").collect()] == [1]
    assert with_attributes(frame.drop("headers")).columns == ["id"]
