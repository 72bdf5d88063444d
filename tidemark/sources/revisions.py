"""Published revisions: the best of each day, two publishers as one timeline, and what is still to read."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.schema import REVISION

#: A revision below this share of the day's largest is a broken upload.
LEAST_SHARE = 0.5
#: Below this size a day's best revision is skipped.
LEAST_BYTES = 50_000_000

LISTING = T.StructType([T.StructField(n, t) for n, t in (("source", T.StringType()), ("created", T.StringType()), ("size", T.LongType()), ("url", T.StringType()), ("api_hash", T.StringType()))])


def best_per_day(listing: DataFrame, least_bytes: int = LEAST_BYTES, least_share: float = LEAST_SHARE) -> DataFrame:
    """One revision for each source and day of a listing (source, created, size, url, api_hash).

    The latest healthy revision wins (healthy: at least the given share of the
    day's largest); without one the largest stands in and is marked to skip.
    """
    rows = listing.where("created is not null and created <> ''").withColumns({"snapshot_date": F.substring("created", 1, 10), "size": F.coalesce("size", F.lit(0).cast("long"))})
    largest = rows.groupBy("source", "snapshot_date").agg(F.max("size").alias("largest"))
    rows = rows.join(largest, ["source", "snapshot_date"])
    healthy = (F.col("size") >= F.col("largest") * least_share) & (F.col("largest") > 0)
    one = F.struct("created", "size", "url", "api_hash")
    day = rows.groupBy("source", "snapshot_date", "largest").agg(
        F.max_by(one, F.when(healthy, F.struct("created", "size", F.coalesce("url", F.lit(""))))).alias("good"),
        F.max_by(one, F.struct("size", "created", F.coalesce("url", F.lit("")))).alias("any"),
    )
    best = F.coalesce("good", "any")
    undersized = F.concat(F.lit("every revision that day is undersized (largest "), F.format_number("largest", 0), F.lit(" B)"))
    floor = F.concat(F.format_number(best["size"], 0), F.lit(f" B is below the {least_bytes:,} B floor"))
    return day.select(
        "source",
        "snapshot_date",
        F.element_at(F.split(F.coalesce(best["url"], F.lit("")), "/"), -1).alias("slug"),
        F.coalesce(best["url"], F.lit("")).alias("url"),
        F.coalesce(best["api_hash"], F.lit("")).alias("api_hash"),
        best["size"].alias("size"),
        best["created"].alias("created"),
        F.when(F.col("good").isNull(), undersized).when(best["size"] < least_bytes, floor).otherwise("").alias("skip_reason"),
    )


def merge_timeline(revisions: DataFrame, preferred: str) -> DataFrame:
    """One revision for each day: readable before skipped, then the preferred source, then by name."""
    w = Window.partitionBy("snapshot_date").orderBy(F.col("skip_reason") != "", F.col("source") != preferred, "source")
    return revisions.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def pending(revisions: DataFrame, done: DataFrame) -> DataFrame:
    """Revisions whose (source, snapshot_date) is not done."""
    return revisions.join(done.select("source", F.col("snapshot_date").cast("string").alias("snapshot_date")).distinct(), ["source", "snapshot_date"], "left_anti")


def is_ahead(held: str | None, published: str | None) -> bool:
    """Whether a day was published that is not held."""
    return bool(published) and (not held or published > held)


def dump_timeline(revisions: DataFrame, path: str) -> None:
    revisions.select(REVISION.fieldNames()).orderBy("snapshot_date", "source").coalesce(1).write.mode("overwrite").json(path)


def load_timeline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVISION).json(path)


def download(chunks: Callable[[], Iterable[bytes]], target: str, length: int | None = None, tries: int = 4, wait: float = 1.0) -> str:
    """Writes a stream to ``target`` and returns its sha256; short or failed reads are tried again with growing waits."""
    for attempt in range(tries):
        digest, size, part = hashlib.sha256(), 0, Path(f"{target}.part")
        try:
            with part.open("wb") as out:
                for chunk in chunks():
                    out.write(chunk)
                    digest.update(chunk)
                    size += len(chunk)
            if length is not None and size != length:
                raise OSError(f"{size} of {length} bytes")
            part.rename(target)
            return digest.hexdigest()
        except OSError:
            part.unlink(missing_ok=True)
            if attempt == tries - 1:
                raise
            time.sleep(wait * 2**attempt)
    raise AssertionError


def artefacts(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and sha256 of every file below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def load_listing(spark: SparkSession, source: str, payload: str) -> DataFrame:
    """The revisions of a portal's answer (JSON text) as a listing."""
    raw = json.loads(payload).get("result", {}).get("resource_revisions", [])
    rows = [(source, r.get("resource_created"), r.get("size"), r.get("url"), r.get("file_hash_sum")) for r in raw]
    return spark.createDataFrame(rows, LISTING)
