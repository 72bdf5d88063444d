"""Reproducible exports, versioned state, state copies without quarantined data, manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.revisions import artefacts

PHONE = r"^[0-9]{9,13}$"


class PersonalDataFound(ValueError):
    """A table that is about to be published holds what looks like phone numbers."""


def export(df: DataFrame, path: str, order: list[str], fmt: str = "parquet", files: int = 1) -> None:
    """Rows in a total order, in ``files`` files (one: byte for byte the same on every run).

    ``order`` must end in a unique column.  With more files each holds one
    range of the order, so a large table is not squeezed through one task.
    """
    ordered = df.orderBy(*order).coalesce(1) if files == 1 else df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    writer = ordered.write.mode("overwrite")
    if fmt == "parquet":
        writer.option("compression", "zstd").parquet(path)
    else:
        writer.option("header", True).option("escape", '"').csv(path)


def guard_personal(df: DataFrame, names: tuple[str, ...] = ("dtl", "phone", "nomer", "msisdn"), pattern: str = PHONE) -> dict[str, int]:
    """How many values of suspicious columns look like phone numbers; one pass for all columns. Raises if any does."""
    at = [c for c in df.columns if any(n in c.lower() for n in names) and isinstance(df.schema[c].dataType, T.StringType)]
    if not at:
        return {}
    row = df.agg(*[F.count_if(F.trim(F.col(f"`{c}`")).rlike(pattern)).alias(c) for c in at]).first()
    found = {c: row[c] for c in at}
    if any(found.values()):
        raise PersonalDataFound(", ".join(f"{c}: {n}" for c, n in found.items() if n))
    return found


class Versions:
    """Immutable versions of named tables under a root; a pointer written last makes a version current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> int:
        """The number of the current version; 0 before the first."""
        pointers = self._path(f"{self.root}/_committed")
        if not self._fs.exists(pointers):
            return 0
        return max([int(s.getPath().getName()) for s in self._fs.listStatus(pointers)], default=0)

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        version = self.current() if version is None else version
        path = f"{self.root}/v{version:08d}/{name}"
        return self.spark.read.parquet(path) if version and self._fs.exists(self._path(path)) else None

    def commit(self, tables: dict[str, DataFrame]) -> int:
        """Writes all tables as the next version; a crash before the pointer leaves the old version current."""
        version = self.current() + 1
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.root}/v{version:08d}/{name}")
        self._fs.create(self._path(f"{self.root}/_committed/{version}"), True).close()
        return version

    def prune(self, keep: int = 2) -> None:
        """Deletes all versions but the last ``keep``."""
        for version in range(1, self.current() - keep + 1):
            self._fs.delete(self._path(f"{self.root}/v{version:08d}"), True)

    def copy(self, target: str, skip: str = "quarantine") -> "Versions":
        """The current version without quarantined tables, checked for personal data, under a new root; no file is shared."""
        version = self.current()
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/v{version:08d}"))] if version else []
        tables = {n: self.read(n) for n in names if not n.startswith(skip)}
        for df in tables.values():
            guard_personal(df)
        out = Versions(self.spark, target)
        out.commit(tables)
        return out


def manifest(spark: SparkSession, path: str, counts: dict[str, int], coverage: dict[str, float]) -> str:
    """JSON of counts, coverage and the artefacts below ``path`` with size and checksum, in order."""
    files = [r.asDict() for r in artefacts(spark, path).withColumn("path", F.element_at(F.split("path", "/"), -1)).orderBy("path").collect()]
    return json.dumps({"counts": counts, "coverage": coverage, "artefacts": files}, ensure_ascii=False, indent=1, sort_keys=True)
