"""Session factory with the settings that the engine's results rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI casts and adaptive execution (coalescing, skewed joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return builder.config(map=settings | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


_OWN: dict[str, str] = {}


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name that driver and executors share, below ``spark.checkpoint.dir``; only a local master may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _OWN.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tidemark-")
        _OWN[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
