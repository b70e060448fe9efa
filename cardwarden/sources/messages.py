"""Message sources and the message encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """An unbounded frame with one message per row in ``value``.

    Either a folder that receives files of one message per line, or the options
    of a Kafka source, whose headers become ``attributes``.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either a path or Kafka options")
    if kafka is not None:
        options = {"includeHeaders": "true"} | kafka
        return with_attributes(spark.readStream.format("kafka").options(**options).load())
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def with_attributes(messages: DataFrame) -> DataFrame:
    """Kafka ``headers`` as ``attributes``, a map of texts; of a repeated name, the last value.

    A frame without headers, or a message without any, is left with what it has.
    """
    if "headers" not in messages.columns:
        return messages
    headers = F.col("headers")
    names = F.array_distinct(F.transform(headers, lambda h: h["key"]))
    last = F.transform(
        names,
        lambda name: F.struct(
            name, F.element_at(F.filter(headers, lambda h: h["key"] == name), -1)["value"].cast("string")
        ),
    )
    return messages.withColumn("attributes", F.map_from_entries(last)).drop("headers")


def read_bounded(messages: DataFrame, n: int, order_by: list[str | Column]) -> DataFrame:
    """The first ``n`` messages of a batch frame in a stated order."""
    return messages.orderBy(*order_by).limit(n)


def encode_messages(rows: DataFrame, fraud: str = "isFraud", product: str = "ProductCD") -> DataFrame:
    """One JSON message per row, nulls written out, with attributes to filter on."""
    return rows.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
        F.create_map(
            F.lit("is_fraud"),
            F.col(fraud).cast("string"),
            F.lit("product_cd"),
            F.col(product),
        ).alias("attributes"),
    )


def filter_attr(messages: DataFrame, name: str, value: str) -> DataFrame:
    return messages.where(F.col("attributes")[name] == value)
