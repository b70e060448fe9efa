"""Loads with a declared schema, co-located joins, and the build of the tables."""

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.operators.base_view import base_view
from cardwarden.plans.feature_tables import VIEW, build_feature_tables, feature_frame
from cardwarden.sources import tables
from cardwarden.sources.messages import encode_messages, filter_attr, read_bounded
from checks import bind
from tests.conftest import SMALL


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def csv_folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    frames = {"tx": bind.transactions(spark, SMALL), "id": bind.identity(spark, SMALL)}
    for name, frame in frames.items():
        frame.coalesce(1).write.option("header", True).csv(str(root / name))
    return {name: str(root / name) for name in frames}


def test_csv_reads_equal_the_source(spark, csv_folders):
    want = bind.transactions(spark, SMALL)
    got = tables.read_transactions(spark, csv_folders["tx"], "csv")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.TRANSACTIONS]
    # An empty CSV field and a missing one are the same.
    blank = F.when(F.col("P_emaildomain") != "", F.col("P_emaildomain")).alias("mail")
    columns = ["TransactionID", "isFraud", "TransactionAmt", "card1", "card4", "D15", "M9", blank]
    assert got.select(*columns).exceptAll(want.select(*columns)).isEmpty()
    assert got.count() == want.count()


def test_csv_with_a_bad_number_stops(spark, tmp_path):
    names = [f.name for f in schemas.IDENTITY]
    (tmp_path / "x.csv").write_text(",".join(names) + "\n" + ",".join(["abc"] * len(names)) + "\n")
    with pytest.raises(Exception, match="(?i)malformed|bad|FAILED_READ"):
        tables.read_identity(spark, str(tmp_path), "csv").collect()


def test_csv_with_another_header_stops(spark, tmp_path):
    names = [f.name for f in schemas.IDENTITY][::-1]
    (tmp_path / "x.csv").write_text(",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ"):
        tables.read_identity(spark, str(tmp_path), "csv").collect()


def test_buckets_follow_the_size_of_the_files(spark, tmp_path):
    for name, rows in (("few", 10), ("many", 1000)):
        spark.range(rows).select(F.lpad(F.col("id").cast("string"), 9, "0")).coalesce(1).write.text(str(tmp_path / name))
    few, many = str(tmp_path / "few"), str(tmp_path / "many")  # 10 bytes a row
    assert tables.bucket_count(spark, few, bucket_bytes=1000) == 1
    assert tables.bucket_count(spark, few, many, bucket_bytes=1000) in (10, 11)  # the largest, check sums included or not
    assert tables.bucket_count(spark, few, least=8) == 8


def test_bucketed_raw_tables_join_without_a_shuffle(spark, csv_folders):
    tables.load_raw(spark, csv_folders["tx"], "raw_transactions", schemas.TRANSACTIONS, buckets=4)
    tables.load_raw(spark, csv_folders["id"], "raw_identity", schemas.IDENTITY, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = base_view(spark.table("raw_transactions"), spark.table("raw_identity"))
        assert "Exchange" not in _plan(view)
        assert view.count() == bind.transactions(spark, SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_view_reads_only_what_is_asked(spark, tmp_path):
    bind.transactions(spark, SMALL).write.parquet(str(tmp_path / "tx"))
    bind.identity(spark, SMALL).write.parquet(str(tmp_path / "id"))
    view = base_view(
        tables.read_transactions(spark, str(tmp_path / "tx")),
        tables.read_identity(spark, str(tmp_path / "id")),
    )
    plan = _plan(view.where("isFraud IS NOT NULL").select("TransactionID", "DeviceType"))
    assert "IsNotNull(isFraud)" in plan
    assert "ReadSchema: struct<TransactionID:bigint,isFraud:bigint>" in plan
    assert "ReadSchema: struct<TransactionID:bigint,DeviceType:string>" in plan


def test_build_feature_tables(spark, features):
    built = build_feature_tables(
        spark, bind.transactions(spark, SMALL), bind.identity(spark, SMALL), buckets=2
    )
    assert spark.table(VIEW).count() == features.count()
    digits = {c: F.round(c, 9) for c in ("card1_avg_amt", "card1_std_amt")}
    want = features.withColumns(digits)
    got = spark.table("ml_features").select(*features.columns).withColumns(digits)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    train, test = spark.table("train_data").count(), spark.table("test_data").count()
    assert train + test == features.count() and test == built["test_data"].count()
    # A second run replaces the tables.
    build_feature_tables(spark, bind.transactions(spark, SMALL), bind.identity(spark, SMALL))
    assert spark.table("ml_features").count() == features.count()


def test_messages(spark):
    encoded = encode_messages(bind.message_rows(spark, SMALL).drop("event_id"))
    assert filter_attr(encoded, "is_fraud", "1").count() == (
        bind.message_rows(spark, SMALL).where("isFraud = 1").count()
    )
    # Nulls are written out, not left out.
    missing = encoded.where(~F.col("value").contains('"addr1":'))
    assert missing.isEmpty()
    assert read_bounded(bind.messages(spark, SMALL), 7, ["event_id"]).count() == 7


def test_small_stored_lookups_do_not_shuffle_the_rows(spark, tmp_path):
    # Inputs of known size, so that only the lookups' joins are under test.
    bind.transactions(spark, SMALL).write.parquet(str(tmp_path / "tx"))
    bind.identity(spark, SMALL).write.parquet(str(tmp_path / "id"))
    frame = feature_frame(
        tables.read_transactions(spark, str(tmp_path / "tx")),
        tables.read_identity(spark, str(tmp_path / "id")),
    )
    plan = _plan(frame)
    assert "Exchange hashpartitioning" not in plan
    assert plan.count("BroadcastHashJoin") == 5
