"""From a raw snapshot to one typed row a key: quarantine, drift, projection, hashing, deduplication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.schema import FIELDS
from tidemark.sources.json_snapshot import drift, projected, resolve_columns

#: Personal fields, and what a bare phone number looks like.
PERSONAL = ("nomer",)
PHONE = r"^[0-9]{9,13}$"


def content_hash(columns: tuple[str, ...] = FIELDS) -> Column:
    """md5 of all fields, joined by bars; null counts as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def deduplicated(df: DataFrame, key: str | list[str], order: list) -> DataFrame:
    """One row of each key, the first in the given order (which should be total)."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def quarantine(raw: DataFrame) -> DataFrame:
    """record_key, field, value of all personal data: named fields, ``nomer`` inside ``dtl`` arrays, bare phone numbers in ``dtl``."""
    at = resolve_columns(raw)
    key = F.col(f"`{at['id']}`").cast("string") if "id" in at else F.lit(None).cast("string")
    found = [F.struct(F.lit(c.lower()).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in raw.columns if c.lower() in PERSONAL]
    dtl = F.col(f"`{at['dtl']}`").cast("string") if "dtl" in at else F.lit(None).cast("string")
    elements = F.from_json(F.when(F.ltrim(dtl).startswith("["), dtl), "array<map<string,string>>")
    nested = F.transform(F.flatten(F.transform(F.coalesce(elements, F.array().cast("array<map<string,string>>")), lambda m: F.map_values(F.map_filter(m, lambda k, v: F.lower(k).isin(*PERSONAL))))), lambda v: F.struct(F.lit("dtl.nomer").alias("field"), v.alias("value")))
    phone = F.array(F.struct(F.lit("dtl").alias("field"), F.when(F.trim(dtl).rlike(PHONE), F.trim(dtl)).alias("value")))
    rows = raw.select(key.alias("record_key"), F.explode(F.concat(F.array(*found).cast("array<struct<field:string,value:string>>") if found else F.array().cast("array<struct<field:string,value:string>>"), nested, phone)).alias("q"))
    return rows.select("record_key", "q.field", "q.value").where("value is not null and trim(value) <> ''").distinct()


def masked_dtl(dtl: Column) -> Column:
    """``dtl`` without personal data: phone numbers null, arrays without their personal members."""
    elements = F.from_json(F.when(F.ltrim(dtl).startswith("["), dtl), "array<map<string,string>>")
    rest = F.transform(elements, lambda m: F.map_filter(m, lambda k, v: ~F.lower(k).isin(*PERSONAL)))
    return F.when(F.trim(dtl).rlike(PHONE), F.lit(None)).when(elements.isNotNull(), F.when(F.size(F.flatten(F.transform(rest, F.map_keys))) > 0, F.to_json(rest))).otherwise(dtl)


@dataclass(frozen=True)
class Staged:
    """A snapshot ready to fold, with what was taken out and found on the way."""

    snapshot: DataFrame
    quarantined: DataFrame
    rejected: DataFrame
    extra: list[str]
    missing: list[str]
    stats: dict[str, int]


def stage(raw: DataFrame) -> Staged:
    """Personal data leaves first; rows without a key are rejected; of equal keys the least content hash stays."""
    extra, missing = drift(raw)
    clean = raw.drop(*[c for c in raw.columns if c.lower() in PERSONAL])
    rows = projected(clean).withColumn("dtl", masked_dtl(F.col("dtl"))).withColumn("content_hash", content_hash())
    snapshot = deduplicated(rows.where("id is not null"), "id", ["content_hash", "extra_json"])
    counted = rows.agg(F.count(F.lit(1)).alias("rows_raw"), F.count("id").alias("keyed"), F.count_distinct("id").alias("records")).first()
    stats = {"rows_raw": counted["rows_raw"], "rows_dupe_id": counted["keyed"] - counted["records"], "rows_without_id": counted["rows_raw"] - counted["keyed"], "record_count": counted["records"]}
    return Staged(snapshot, quarantine(raw), rows.where("id is null"), extra, missing, stats)


def insert_if_absent(held: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """``held`` and the rows of ``more`` whose keys (nulls equal) it lacks."""
    a, b = more.alias("a"), held.alias("b")
    same = None
    for k in keys:
        one = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        same = one if same is None else same & one
    return held.unionByName(more.alias("a").join(b, same, "left_anti").select([F.col(f"a.{c}") for c in more.columns]).distinct())
