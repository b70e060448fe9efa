"""Scoring of a stream of requests into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from cardwarden.operators.requests import score_requests
from cardwarden.streaming.ingest import batch_owner, create_batch_table, write_batch

# What score_requests adds to a request, in order (fixed names).
ANSWER = StructType(
    [
        StructField("fraud_probability", DoubleType()),
        StructField("predicted_fraud", LongType()),
        StructField("risk_level", StringType()),
        StructField("transaction_amount", DoubleType()),
        StructField("model", StringType()),
        StructField("scored_at", TimestampType()),
        StructField("error", StringType()),
    ]
)


def create_score_table(requests: DataFrame, table: str) -> None:
    """Create the output table for requests with these columns. Scoring itself never creates it."""
    create_batch_table(requests.sparkSession, table, StructType([*requests.schema, *ANSWER]))


def start_scoring(
    requests: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    clock: Column | None = None,
    value: str = "value",
    model: str = "xgboost",
    stream: str = "scores",
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start to answer a streaming frame of requests; see ``score_requests``.

    Each batch owns one partition of the table, as in ``batch_writer``: a batch that runs again after
    a failure replaces its answers. Without ``clock`` all requests of a batch are scored at one time.
    """
    if not requests.sparkSession.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; scoring does not create it")

    def write(batch: DataFrame, batch_id: int) -> None:
        answers = score_requests(batch, predict, clock, value, model)
        write_batch(answers, table, batch_owner(batch, stream), batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        requests.writeStream.queryName(stream)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )
