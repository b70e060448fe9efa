"""From raw documents to token ids: five stages, each over all that the one before kept.

The first four return rows of docs as they are, all columns included; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import bpe, decontaminate, exact_dedup, ngram_join, toxicity
from cardwarden.llm.common import salted_join, small_side, stored

#: SQL for the rows of run(): none, the stages are no SQL. tests/llm compares them with brute force.
ORACLE_SQL = None


#: Column that numbers the rows within a stage.
ROW = "_row_number"


def _numbered(docs: DataFrame) -> DataFrame:
    """docs, its rows numbered. Written once: another reading of docs may be split, and so numbered, in another way."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows numbered in gone."""
    return docs.join(small_side(stored(gone.select(F.col("row").alias(ROW)), "gone")), ROW, "left_anti").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject: those with a score under 0.5. It learns from the labelled documents among docs.

    Null and empty texts have the score of a text without known words; equal texts have equal scores, so repeated
    rows stay or go together. Without labels nothing goes. A null doc_id has no label and is scored like others.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.labelled_sample(docs, labels))
    return toxicity.with_scores(docs, model, "_toxicity").where("_toxicity < 0.5").drop("_toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id. Null texts count as empty, so one row of all empty ones stays."""
    rows = _numbered(docs)
    return _without(rows, exact_dedup.exact_groups(rows, ROW).where("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the row with the smallest doc_id; texts without words all stay.

    Rows without doc_id come after those with one; of several with the same doc_id, one stays.
    """
    rows = _numbered(docs)
    classes = stored(ngram_join.ngram_classes(rows, ROW).where("label is not null").select("row", "doc_id", "label"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    first = classes.groupBy("label").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    # rows of groups, less the one that stays; a large group is dealt over lanes
    gone = salted_join(classes, stored(first, "first"), "label", "row").where(F.col("row") != F.col("first.row"))
    return _without(rows, gone)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item.

    Null and empty texts, and those too short for a stretch that counts, stay; so does everything where the benchmark is
    empty. Rows are judged one by one: repeated rows go together, whatever their doc_id.
    """
    rows = _numbered(docs)
    found = decontaminate.overlaps(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ROW)
    return _without(rows, found.select("row").distinct())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as counts and digests: doc_id, n_tokens, ids_sha256, decoded_sha256.

    One row per row of docs, in which a null text is empty, and an empty text has no token and the digest of no bytes.
    """
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.bpe_round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
