"""Replacing tables and models in one step, and appending batches once."""

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import models
from cardwarden.schemas import STREAM_TABLE
from cardwarden.sources.files import Files
from cardwarden.sources.tables import materialize
from cardwarden.sources.versions import drop_table, model_folder, replace_model, replace_table, table_version
from cardwarden.streaming import ingest, ledger
from checks import bind
from tests.conftest import SMALL


@pytest.fixture
def name(spark):
    yield "kept_rows"
    drop_table(spark, "kept_rows")
    assert not [r for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("kept_rows")]


def _versions(spark, name):
    return [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(name + "__v")]


def test_a_broken_write_leaves_the_old_rows(spark, name):
    replace_table(spark.range(5), name)
    broken = spark.range(100).select(F.when(F.col("id") == 70, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, name)
    assert spark.table(name).count() == 5
    assert replace_table(spark.range(7), name).count() == 7


def test_a_table_can_be_rebuilt_from_itself(spark, name):
    replace_table(spark.range(10), name)
    for n in (9, 8, 7):
        replace_table(spark.table(name).where(F.col("id") < n), name)
        assert spark.table(name).count() == n
    assert len(_versions(spark, name)) == 2


def test_readers_keep_their_version(spark, name):
    began = replace_table(spark.range(10), name)
    replace_table(spark.range(3).withColumn("more", F.lit("x")), name)  # other columns too
    assert began.count() == 10 and spark.table(name).columns == ["id", "more"]


def test_a_plain_table_becomes_a_version(spark, name):
    materialize(spark.range(4), name)
    assert replace_table(spark.table(name).union(spark.range(2)), name).count() == 6
    assert table_version(spark, name) in [v for v in _versions(spark, name)]


def test_buckets_and_partitions_stay_known(spark, name):
    rows = spark.range(100).withColumn("part", F.col("id") % 3)
    found = replace_table(rows, name, partition_by="part", bucket_by="id", buckets=4)
    plan = found.where("part = 1").groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(part" in plan


def test_a_broken_save_leaves_the_old_model(spark, features, tmp_path):
    path = str(tmp_path / "model")
    config = models.LogisticConfig(iterations=1)
    first = models.train_logistic(features, config)
    models.save_model(first, path)
    before = model_folder(spark, path)

    def half(folder):
        first.stages[0].write().save(f"{folder}/stages/0_x")
        raise OSError("disk full")

    with pytest.raises(OSError):
        replace_model(spark, path, half)
    assert model_folder(spark, path) == before
    assert len(models.load_model(path).stages) == len(first.stages)
    for _ in range(3):
        models.save_model(first, path)
    assert len([n for n in Files(spark).names(path) if n.startswith("v")]) == 2
    # a model without versions is read as it is
    first.write().save(str(tmp_path / "plain"))
    assert len(models.load_model(str(tmp_path / "plain")).stages) == len(first.stages)


def test_short_texts_are_put_whole(spark, tmp_path):
    files, path = Files(spark), str(tmp_path / "a" / "note")
    assert not files.exists(path) and files.names(str(tmp_path / "a")) == []
    for text in ("one\n", "two é\n", ""):
        files.put(path, text)
        assert files.text(path) == text
    assert [n for n in files.names(str(tmp_path / "a")) if not n.startswith(".")] == ["note"]


# The ledger -----------------------------------------------------------------------


@pytest.fixture
def plain(spark):
    spark.sql("DROP TABLE IF EXISTS plain_rows")
    spark.sql("CREATE TABLE plain_rows (value STRING, id BIGINT) USING parquet")
    yield "plain_rows"
    spark.sql("DROP TABLE plain_rows")


def _ids(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(r.id for r in spark.table(table).collect())


def test_a_batch_is_appended_once(spark, plain):
    assert ledger.takes_ledger(spark, plain)
    rows = spark.range(20).withColumn("value", F.lit("x")).repartition(3)
    for _ in range(3):
        ingest.write_batch(rows, plain, "s", 0)
        assert _ids(spark, plain) == list(range(20))
    ingest.write_batch(spark.range(20, 22).select("id"), plain, "s", 1)
    ingest.write_batch(spark.range(22, 23), plain, "other", 0)
    assert _ids(spark, plain) == list(range(23))
    assert ledger.appended_batches(spark, plain, "s") == [0, 1]
    with pytest.raises(ValueError, match="no column"):
        ingest.write_batch(rows.withColumn("more", F.lit(1)), plain, "s", 2)


@pytest.mark.parametrize("step", ["plan", "first move", "second move", "done"])
def test_a_batch_that_broke_off_goes_on(spark, plain, step, monkeypatch):
    """Each step fails once; the batch runs again and adds what is missing."""
    calls = {"move": 0}
    put, move = Files.put, Files.move

    def broken_put(self, path, text):
        if path.endswith(f".{step}"):
            raise OSError(step)
        put(self, path, text)

    def broken_move(self, source, target):
        calls["move"] += 1
        if step.endswith("move") and calls["move"] == (1 if step.startswith("first") else 2):
            raise OSError(step)
        move(self, source, target)

    rows = spark.range(30).withColumn("value", F.lit("x")).repartition(3)
    with monkeypatch.context() as patch:
        patch.setattr(Files, "put", broken_put)
        patch.setattr(Files, "move", broken_move)
        with pytest.raises(OSError, match=step):
            ingest.write_batch(rows, plain, "s", 7)
    ingest.write_batch(rows, plain, "s", 7)
    assert _ids(spark, plain) == list(range(30))


def test_scoring_replay_on_a_plain_table(spark, tmp_path):
    """The replay of the partitioned table's test, on a table of the declared columns only."""
    from cardwarden.operators.requests import score_requests
    from cardwarden.streaming.scoring import ANSWER, start_scoring

    requests, source, table = bind.requests(spark, SMALL), str(tmp_path / "in"), "plain_scores"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*requests.schema, *ANSWER])
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")

    def run():
        stream = spark.readStream.schema(requests.schema).parquet(source)
        start_scoring(stream, bind.fixed_predict, table, str(tmp_path / "checkpoint"), clock=F.col("clock"), available_now=True).awaitTermination()
        spark.catalog.refreshTable(table)

    for half in (F.col("event_id") < 500, F.col("event_id") >= 500):
        requests.where(half).coalesce(1).write.mode("append").parquet(source)
        run()
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    want = score_requests(requests, bind.fixed_predict, clock=F.col("clock"))
    got = spark.table(table).select(want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    spark.sql(f"DROP TABLE {table}")


def test_other_tables_have_no_ledger(spark):
    spark.sql("DROP TABLE IF EXISTS parted_rows")
    spark.sql("CREATE TABLE parted_rows (value STRING, id BIGINT) USING parquet PARTITIONED BY (id)")
    assert not ledger.takes_ledger(spark, "parted_rows")
    spark.sql("DROP TABLE parted_rows")
    assert len(STREAM_TABLE) == 22
