"""Stream records without repeats of an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwarden.schemas import KEY
from cardwarden.streaming.ingest import STAMP, batch_owner, write_batch


def record_time() -> Column:
    """Event time of a record: its TransactionDT, which messages give in seconds since 1970, or else the ingest time."""
    return F.coalesce(F.timestamp_seconds("TransactionDT"), F.col(STAMP))


def drop_repeats(records: DataFrame, event_time: Column, delay: str, key: str = KEY) -> DataFrame:
    """The first record of each id, as long as repeats are less than ``delay`` of event time apart.

    An id is remembered until the watermark, the latest event time seen less ``delay``, is ``delay`` beyond its own time; so the state
    holds the ids of that span and no more, dealt over tasks by id. A record that is older than the watermark is dropped, whether a repeat or not,
    and counted under ``numRowsDroppedByWatermark`` in the progress of the query: choose ``delay`` longer than messages take.
    Records without an event time have to get one first, see ``record_time``. NULL is an id like others.
    """
    time = "_event_time"
    timed = records.withColumn(time, event_time).withWatermark(time, delay)
    return timed.dropDuplicatesWithinWatermark([key]).drop(time)


def start_dedup(
    records: DataFrame,
    table: str,
    checkpoint: str,
    event_time: Column | None = None,
    delay: str = "1 hour",
    key: str = KEY,
    stream: str = "unique_transactions",
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start to write the first record of each id of a streaming frame into an existing table.

    Each batch owns one partition of the table, as in ``batch_writer``, and the ids are in the checkpoint with the offsets: neither a
    batch that runs again nor a restart lets a repeat through.
    """
    if not records.sparkSession.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; this job does not create it")
    unique = drop_repeats(records, record_time() if event_time is None else event_time, delay, key)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, table, batch_owner(batch, stream), batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        unique.writeStream.queryName(stream)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )
