"""Session settings the jobs rely on, and where they may leave intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(name: str = "cardwarden", cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own session."""
    cores = str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # The JVM never compiles a method above 8000 bytes; wide projections are
        # faster outside whole-stage code than interpreted inside it.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared checkpoint folder the session names.

    On a cluster ``spark.checkpoint.dir`` points at storage that every executor
    reaches. A session without it uses a folder in its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/cardwarden/{purpose}-{uuid.uuid4().hex}"
