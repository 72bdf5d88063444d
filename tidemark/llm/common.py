"""Helpers shared by the corpus operators: the shared work folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own; a
    cluster without it is an error, since executors could not see each
    other's files.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _OWN[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: its lineage is cut and it survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Deletes a table made by ``staged`` that nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path.getParent(), True)
        break


def small_batches(spark: SparkSession) -> None:
    """Batches of 2,000 rows to and from Python unless the user chose a number: long texts make wide rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, "2000")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs of a block; what the user has set stays as it is."""
    own = [name for name in values if spark.conf.get(name, None) is None]
    for name in own:
        spark.conf.set(name, values[name])
    try:
        yield
    finally:
        for name in own:
            spark.conf.unset(name)


def release() -> None:
    """Hands freed memory of this worker back to the system, so that workers of other operators have it."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect(1)
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches; once its own arrays are gone, ``release``: an idle worker would hold them for all later stages."""

    def held(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return held


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def keyed_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key (bigint) and the text (string; null: empty), under the fixed names ``k`` and ``t``."""
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
