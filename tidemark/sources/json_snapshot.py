"""Snapshot files: JSON arrays of flat objects, read as text only, repaired if their brackets are broken.

Spark's multi-line reader silently keeps just the first array of a broken file,
so a scanner that knows strings from structure looks at the brackets first.  It
also writes the objects one a line, which makes the file splittable.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark import StorageLevel
from pyspark.errors import PythonException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import FIELDS


class BrokenSnapshot(ValueError):
    """The file is truncated or not a listing; nothing can be repaired."""


@dataclass(frozen=True)
class Scan:
    """What the scanner found: the objects' texts, and how many faults it passed over."""

    objects: list[str]
    faults: int


def scan(text: str) -> Scan:
    """The top-level objects of one or more arrays.

    Accepted faults: objects before, between or after arrays, arrays in a row,
    empty elements.  Brackets inside strings are text.  Anything unclosed, or
    other values at the top, is refused.
    """
    objects: list[str] = []
    depth, begin, in_string, escaped = 0, -1, False, False
    inside, arrays, faults, comma = False, 0, 0, True
    for i, c in enumerate(text):
        if in_string:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                in_string = False
            continue
        if depth:
            if c == '"':
                in_string = True
            elif c in "{[":
                depth += 1
            elif c in "}]":
                depth -= 1
                if not depth:
                    objects.append(text[begin : i + 1])
                    comma = False
            continue
        if c == "{":
            faults += (not inside) or (inside and not comma)
            begin, depth = i, 1
        elif c == "[":
            faults += inside or arrays > 0 or bool(objects)
            inside, arrays, comma = True, arrays + 1, True
        elif c == "]":
            faults += not inside
            inside = False
        elif c == ",":
            faults += comma or not inside
            comma = True
        elif not c.isspace() and c != "﻿":
            raise BrokenSnapshot(f"unexpected {c!r} at {i}")
    if depth or in_string or inside or not arrays:
        raise BrokenSnapshot("the file ends inside a value" if depth or inside else "there is no array")
    return Scan(objects, faults)


def read_objects(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Objects (a text column ``value``) as columns of text: known fields whatever their case, the rest by their own names.

    Field names are discovered over the whole input; values keep their JSON
    text, nested ones included, so no inference can change an unchanged record.
    """
    rows = lines.select(F.from_json("value", "map<string,string>").alias("m"))
    names = [r["k"] for r in rows.select(F.explode(F.map_keys("m")).alias("k")).distinct().orderBy("k").collect()]  # the file's few field names
    taken: dict[str, list[str]] = {}
    for n in names:
        taken.setdefault(n.lower() if n.lower() in FIELDS else n, []).append(n)
    columns = [F.coalesce(*[F.element_at("m", F.lit(n)) for n in sources]).alias(name) for name, sources in taken.items()]
    return rows.select(*columns) if columns else rows.select(F.lit(None).cast("string").alias("id")).where("false")


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, str, int]:
    """(rows, read mode, repairs) of one snapshot file.

    The mode is ``json`` or ``repaired``.  The file is scanned by the task that
    reads it, so any store will do and the driver never holds it.  The number
    of rows always equals the number of objects.
    """
    lines, faults = _scanned(spark, path)
    return _rows(spark, lines), _mode(faults), faults


@contextmanager
def snapshot(spark: SparkSession, path: str) -> Iterator[tuple[DataFrame, str, int]]:
    """``read_snapshot`` that lets go of the scanned objects at the end, for those who read many files."""
    lines, faults = _scanned(spark, path)
    try:
        yield _rows(spark, lines), _mode(faults), faults
    finally:
        lines.unpersist()


def _rows(spark: SparkSession, lines: DataFrame) -> DataFrame:
    return read_objects(spark, lines.where("value is not null").select("value"))


def _mode(faults: int) -> str:
    return "repaired" if faults else "json"


def _scanned(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The objects of one file, kept on disk, and how many faults were repaired."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                got = scan(bytes(content).decode("utf-8"))
                yield pd.DataFrame({"value": [None], "faults": [got.faults]})
                for i in range(0, len(got.objects), 10_000):
                    part = got.objects[i : i + 10_000]
                    for o in part:
                        json.loads(o)
                    yield pd.DataFrame({"value": part, "faults": 0})

    lines = files.mapInPandas(expand, "value string, faults int").persist(StorageLevel.DISK_ONLY)
    try:
        seen = lines.agg(F.count_if(F.col("value").isNull()).alias("files"), F.sum("faults").alias("faults")).first()
    except PythonException as e:
        found = re.search(r"(?:BrokenSnapshot|JSONDecodeError|UnicodeDecodeError): (.*)", str(e))
        lines.unpersist()
        raise BrokenSnapshot(found.group(1) if found else "unreadable") from e
    if seen["files"] != 1:
        lines.unpersist()
        raise BrokenSnapshot(f"{seen['files']} files at {path}")
    return lines, seen["faults"]


def resolve_columns(df: DataFrame) -> dict[str, str]:
    """Known field -> the column that carries it, whatever its case."""
    lower = {c.lower(): c for c in df.columns}
    return {f: lower[f] for f in FIELDS if f in lower}


def drift(df: DataFrame) -> tuple[list[str], list[str]]:
    """(extra, missing) columns against the known fields."""
    here = {c.lower() for c in df.columns}
    return sorted(here - set(FIELDS)), sorted(set(FIELDS) - here)


def projected(df: DataFrame) -> DataFrame:
    """Known fields as text (null where missing) and all other columns packed into extra_json."""
    at = resolve_columns(df)
    extra = [c for c in df.columns if c not in at.values()]
    known = [F.col(f"`{at[f]}`").cast("string").alias(f) if f in at else F.lit(None).cast("string").alias(f) for f in FIELDS]
    packed: Column = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in sorted(extra)]), {"ignoreNullFields": "false"}) if extra else F.lit(None).cast("string")
    return df.select(*known, packed.alias("extra_json"))
