"""Appends of batches to a plain table of files, each of them once.

A ledger beside the table's files, in a folder that readers skip, knows each batch of each stream: its rows are staged as files, the
names of the staged files are written down, the files are moved into the table under names of their own, and the
batch is marked as done. A batch that runs again goes on where it broke off; a batch that is done adds nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardwarden.sources.files import Files

_FOLDER = "_ledger"


def _described(spark: SparkSession, table: str) -> dict:
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def takes_ledger(spark: SparkSession, table: str) -> bool:
    """Whether a table is files in one folder: a Spark table with neither partitions nor buckets."""
    facts = _described(spark, table)
    plain = not facts.get("partition_columns") and int(facts.get("num_buckets") or 0) <= 0
    return plain and facts.get("type") in ("MANAGED", "EXTERNAL") and facts.get("provider") in ("parquet", "orc", "json", "csv")


def append_once(rows: DataFrame, table: str, stream: str, batch_id: int) -> None:
    """Append the rows of a batch; nothing if the ledger says that the batch has been appended.

    Columns go by name; one that ``rows`` lacks is NULL, and one that the table lacks is refused. The files of a batch become
    visible one by one. A batch must have the same rows whenever it runs, as those of a stream have.
    """
    spark = rows.sparkSession
    facts, files = _described(spark, table), Files(spark)
    schema = spark.table(table).schema
    if extra := set(rows.columns) - set(schema.names):
        raise ValueError(f"table {table} has no column {', '.join(sorted(extra))}")
    home = facts["location"].rstrip("/")
    entry = f"{home}/{_FOLDER}/{stream}/{int(batch_id)}"
    plan, staged, done = f"{entry}.plan", f"{entry}.rows", f"{entry}.done"
    if files.exists(done):
        return
    if not files.exists(plan):
        typed = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        rows.select(*typed).write.mode("overwrite").format(facts["provider"]).save(staged)
        files.put(plan, "\n".join(n for n in files.names(staged) if n.startswith("part-")))
    for name in files.text(plan).split():
        if files.exists(f"{staged}/{name}"):
            files.move(f"{staged}/{name}", f"{home}/{stream}-{int(batch_id)}-{name}")
    files.put(done, "")
    files.delete(staged)
    spark.catalog.refreshTable(table)


def appended_batches(spark: SparkSession, table: str, stream: str) -> list[int]:
    """Numbers of the batches of a stream that the table has whole."""
    home = _described(spark, table)["location"].rstrip("/")
    names = Files(spark).names(f"{home}/{_FOLDER}/{stream}")
    return sorted(int(n.removesuffix(".done")) for n in names if n.endswith(".done"))
