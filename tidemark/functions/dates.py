"""Plausible dates: null what cannot be, repair what has one reading."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_YEAR = 2004
_ISO = r"^(\d{4})-(\d{2})-(\d{2})([T ].*)?$"
_STAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"


def timestamp_of(text: Column) -> Column:
    """An ISO date or time as a timestamp without zone; anything else is null."""
    return F.when(text.rlike(_STAMP), text.try_cast("timestamp_ntz"))


def plausible(text: Column, as_of: date) -> Column:
    """The timestamp if it lies from 2004 to the day after ``as_of``."""
    t = timestamp_of(text)
    return F.when(t.between(F.lit(f"{MIN_YEAR}-01-01 00:00:00").cast("timestamp_ntz"), F.date_add(F.lit(as_of), 1).cast("timestamp_ntz")), t)


def implausible(text: Column, as_of: date) -> Column:
    """Three-valued: null for a text that is no timestamp, false for a null."""
    t = timestamp_of(text)
    return text.isNotNull() & ~t.between(F.lit(f"{MIN_YEAR}-01-01 00:00:00").cast("timestamp_ntz"), F.date_add(F.lit(as_of), 1).cast("timestamp_ntz"))


def repair(text: Column, max_year: int) -> Column:
    """struct(value, verdict): ok, repaired (first two digits of the year swapped), implausible, unparsable or empty."""
    bare = F.trim(text)
    year = F.regexp_extract(bare, _ISO, 1)
    swapped = F.concat(F.substring(year, 2, 1), F.substring(year, 1, 1), F.substring(year, 3, 2))
    inside = lambda y: y.try_cast("int").between(MIN_YEAR, max_year)
    verdict = F.when(F.coalesce(bare, F.lit("")) == "", "empty").when(year == "", "unparsable").when(inside(year), "ok").when(inside(swapped), "repaired").otherwise("implausible")
    value = F.when(verdict == "ok", text).when(verdict == "repaired", F.concat(swapped, F.substring(bare, 5, 1 << 20)))
    return F.struct(value.alias("value"), verdict.alias("verdict"))
