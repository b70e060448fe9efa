"""Strict message ingest: parse, validate, cast, route, write.

Every message gets exactly one route.

- ``malformed``: not UTF-8, not one JSON object, or anything after it
- ``invalid``: a required field is missing or falsy
- ``cast_error``: a field that the table declares holds a value it cannot take
- ``valid``: the rest
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, DoubleType, LongType, StructType

from cardwarden.functions import loose_values as loose
from cardwarden.functions.barrier import once
from cardwarden.functions.loose_values import Loose
from cardwarden.schemas import DEAD_LETTER, KEY, STREAM_TABLE
from cardwarden.streaming.ledger import append_once, takes_ledger

REQUIRED_FIELDS = ["TransactionID", "TransactionAmt", "ProductCD"]
# Numeric fields that are cast only when truthy; a falsy one never rejects a row.
GUARDED_FIELDS = ["card1", "addr1", "addr2", "dist1"]
STAMP = "ingested_at"
MESSAGE_FIELDS = [f.name for f in STREAM_TABLE if f.name != STAMP]
ROUTES = ["valid", "invalid", "cast_error", "malformed"]
# Partition columns of the output tables: the streaming query's id and the number of its batch.
BATCH_PARTITION = ["ingest_stream", "ingest_batch"]


def parse_json_objects(rows: DataFrame, fields: list[str], value: str) -> DataFrame:
    """Add ``fields``, a struct of VARIANT, NULL where the text is not one JSON object.

    The text is parsed as the first element of an array whose second element is
    a seal made from the text's own digest. Text that closes the array early, or
    that carries further objects, moves or loses the seal and is refused.
    """
    text = F.col(value)
    columns = ", ".join(f"`{f}`: variant" for f in fields)
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit(', {"__seal": "'), F.col("_seal"), F.lit('"}]')),
        f"array<struct<{columns}, __seal: string>>",
        {"allowSingleQuotes": "false"},
    )
    sealed = once(
        rows.withColumn("_seal", F.when(F.is_valid_utf8(text), F.sha2(text, 256))), _parsed=parsed
    )
    whole = (F.size("_parsed") == 2) & (F.get("_parsed", F.lit(1))["__seal"] == F.col("_seal"))
    # The parser takes +INF and -INF as numbers, which JSON readers do not.
    odd_infinity = text.contains("INF") & F.regexp_replace(
        text, r'"(\\.|[^"\\])*+"', '""'
    ).rlike("[+-]INF")
    return sealed.withColumn(
        "fields", F.when(whole & ~odd_infinity, F.get("_parsed", F.lit(0)))
    ).drop("_seal", "_parsed")


def parse_messages(
    messages: DataFrame, fields: list[str] | None = None, value: str = "value"
) -> DataFrame:
    """Add ``fields``, the declared fields of each message, and their ``kinds``.

    Both are NULL if the message is malformed.
    """
    names = fields or MESSAGE_FIELDS
    text = messages.withColumn(value, F.col(value).cast("string"))
    parsed = parse_json_objects(text, names, value)
    return parsed.withColumn("kinds", loose.field_kinds(F.col("fields"), names))


def _if_parsed(column: Column) -> Column:
    return F.when(F.col("fields").isNotNull(), column)


def _names(checks: list[Column]) -> Column:
    """The names that are not NULL, as an array.

    Joined and split again: a filter over the array would evaluate every check
    outside of generated code.
    """
    joined = F.concat_ws(",", *checks)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))


def validate(parsed: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Add ``missing``: the names of required fields that are absent or falsy."""
    checks = [F.when(Loose.of(f).is_falsy(), F.lit(f)) for f in required or REQUIRED_FIELDS]
    return parsed.withColumn("missing", _if_parsed(_names(checks)))


#: Numbers of which the original stores the whole part
TRUNCATED_FIELDS = ("TransactionID", "card1")


def _typed(name: str, data_type: DataType) -> Column:
    field = Loose.of(name)
    if isinstance(data_type, LongType):
        # the original takes the whole part of these two only; elsewhere a fraction is an error
        return field.to_long() if name in TRUNCATED_FIELDS else field.to_exact_long()
    if isinstance(data_type, DoubleType):
        return field.to_double()
    return field.text()


def cast_fields(validated: DataFrame) -> DataFrame:
    """Add ``record`` with the declared types and ``bad_fields`` with failed casts."""
    targets = [f for f in STREAM_TABLE if f.name != STAMP]
    typed = F.struct(*[_typed(f.name, f.dataType).alias(f.name) for f in targets])
    failed = []
    for f in targets:
        field = Loose.of(f.name)
        blank = field.is_falsy() if f.name in GUARDED_FIELDS else field.is_null()
        failed.append(F.when(F.col("record")[f.name].isNull() & ~blank, F.lit(f.name)))
    return validated.withColumn("record", _if_parsed(typed)).withColumn(
        "bad_fields", _if_parsed(_names(failed))
    )


def route(cast: DataFrame) -> DataFrame:
    """Add ``route``, the one output each message belongs to."""
    return cast.withColumn(
        "route",
        F.when(F.col("fields").isNull(), "malformed")
        .when(F.size("missing") > 0, "invalid")
        .when(F.size("bad_fields") > 0, "cast_error")
        .otherwise("valid"),
    )


def stamp(rows: DataFrame) -> DataFrame:
    """Set the ingest time, whatever the message said."""
    return rows.withColumn(STAMP, F.current_timestamp())


def route_messages(messages: DataFrame) -> DataFrame:
    """All element-wise steps in one stage, without a shuffle.

    Untyped values are gone from the result, so it can be cached or written.
    """
    rows = route(cast_fields(validate(parse_messages(messages))))
    outcome = {c: F.col(c) for c in ("route", "record", "missing", "bad_fields")}
    routed = once(rows, **outcome, message_id=Loose.of(KEY).text())
    return stamp(routed.select(*outcome, "message_id", "value"))


def conform(routed: DataFrame) -> DataFrame:
    """Valid rows with exactly the declared columns; absent fields are NULL."""
    columns = [
        F.col(STAMP) if f.name == STAMP else F.col("record")[f.name].alias(f.name)
        for f in STREAM_TABLE
    ]
    return routed.where(F.col("route") == "valid").select(*columns)


def dead_letters(routed: DataFrame) -> DataFrame:
    """Every refused message, whole, with the reason."""
    return routed.where(F.col("route") != "valid").select(
        F.col("route").alias("reason"),
        F.col("message_id").alias(KEY),
        "missing",
        "bad_fields",
        "value",
        STAMP,
    )


def route_counters() -> list[Column]:
    """Metrics that replace a log line per bad record."""
    return [F.count(F.lit(1)).alias("messages")] + [
        F.count_if(F.col("route") == r).alias(r) for r in ROUTES
    ]


def stream_totals(routed: DataFrame) -> DataFrame:
    """Messages, fraud messages and fraud share per route."""
    fraud = F.count_if(F.col("record")["isFraud"] == 1)
    return routed.groupBy("route").agg(
        F.count(F.lit(1)).alias("messages"),
        fraud.alias("fraud"),
        (F.count(F.lit(1)) - fraud).alias("legit"),
        F.round(fraud / F.count(F.lit(1)), 6).alias("fraud_share"),
    )


def create_batch_table(spark: SparkSession, table: str, schema: StructType) -> None:
    """Create a table that is partitioned by streaming query and batch."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {table} ({columns}, ingest_stream string, ingest_batch bigint) "
        f"USING parquet PARTITIONED BY ({', '.join(BATCH_PARTITION)})"
    )


def create_stream_tables(spark: SparkSession, table: str, dead_letter_table: str) -> None:
    """Create the two output tables. Ingest itself never creates them."""
    create_batch_table(spark, table, STREAM_TABLE)
    create_batch_table(spark, dead_letter_table, DEAD_LETTER)


def write_batch(rows: DataFrame, table: str, stream: str, batch_id: int) -> None:
    """Replace the batch's own partition and nothing else.

    A plain table of files, with the columns of ``rows`` only, is appended to by a ledger, which adds a batch once however
    often it runs. To a table that is neither, a batch that runs again adds its rows again.
    """
    catalog = rows.sparkSession.catalog
    if not catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; ingest does not create it")
    if not re.fullmatch(r"[\w.-]+", stream):
        raise ValueError("a stream name has letters, digits, dots, dashes and underscores only")
    if not {c.name for c in catalog.listColumns(table)}.issuperset(BATCH_PARTITION):
        if takes_ledger(rows.sparkSession, table):
            append_once(rows, table, stream, batch_id)
        else:
            rows.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=rows)
        return
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} "
        f"PARTITION (ingest_stream = '{stream}', ingest_batch = {int(batch_id)}) "
        "SELECT * FROM {rows}",
        rows=rows,
    )


def write_valid(routed: DataFrame, table: str, stream: str, batch_id: int) -> None:
    write_batch(conform(routed), table, stream, batch_id)


def write_dead_letters(routed: DataFrame, table: str, stream: str, batch_id: int) -> None:
    write_batch(dead_letters(routed), table, stream, batch_id)


def batch_owner(batch: DataFrame, stream: str) -> str:
    """Id of the streaming query that the batch belongs to; outside of one, ``stream``."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or stream


def batch_writer(
    table: str, dead_letter_table: str, stream: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that parses once and writes both outputs.

    Each batch owns one partition per table and overwrites it, so a batch that
    runs again after a failure leaves no duplicates. The partition is named by the id
    of the streaming query, which lives in its checkpoint: another checkpoint, which
    counts its batches from 0 again, never overwrites what is there. Outside a
    streaming query ``stream`` is the name.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        owner = batch_owner(batch, stream)
        routed = batch.persist()
        try:
            write_valid(routed, table, owner, batch_id)
            write_dead_letters(routed, dead_letter_table, owner, batch_id)
        finally:
            routed.unpersist()

    return write


def start_ingest(
    messages: DataFrame,
    table: str,
    dead_letter_table: str,
    checkpoint: str,
    stream: str = "transactions",
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start the ingest of a streaming frame.

    ``available_now`` takes what the source holds and stops. The counters are in
    the query's progress under ``ingest``.
    """
    catalog = messages.sparkSession.catalog
    for name in (table, dead_letter_table):
        if not catalog.tableExists(name):
            raise ValueError(f"table {name} does not exist; ingest does not create it")
    first, *rest = route_counters()
    routed = route_messages(messages).observe("ingest", first, *rest)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        routed.writeStream.queryName(stream)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_writer(table, dead_letter_table, stream))
        .trigger(**trigger)
        .start()
    )
