"""A given number of messages of a stream, and no more."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, functions as F

from cardwarden.streaming.ingest import BATCH_PARTITION, batch_owner, write_batch


def take_messages(messages: DataFrame, n: int, table: str, checkpoint: str, stream: str = "bounded") -> int:
    """Write the first ``n`` messages that a streaming frame holds into a table, and stop. Returns how many are there now.

    The count of admitted messages is the state of the stream's limit, so it goes on after a restart from the same checkpoint, which
    takes what is missing, if the source holds it. Bound the source's batches (``max_files_per_trigger``): what lies behind the batch
    that has the last message is then not read. Each task gives up to ``n`` rows of a batch to the one that counts.
    """
    spark = messages.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; this job does not create it")
    enough, owner = threading.Event(), []

    def taken(session) -> int:
        return session.table(table).where(F.col(BATCH_PARTITION[0]) == owner[0]).count()

    def write(batch: DataFrame, batch_id: int) -> None:
        owner[:] = [batch_owner(batch, stream)]
        write_batch(batch, table, owner[0], batch_id)
        if taken(batch.sparkSession) >= n:
            enough.set()

    query = (
        messages.limit(n).writeStream.queryName(stream)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    owner[:] = [str(query.id)]
    while query.isActive and not enough.wait(0.2):
        pass
    if enough.is_set():
        query.stop()
    query.awaitTermination()
    spark.catalog.refreshTable(table)
    return taken(spark)
