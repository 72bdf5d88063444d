"""A code -> brand and model dictionary by consensus of records, merged with an outside list, and records filled from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_share(rows: DataFrame, key: str, value: list[str]) -> DataFrame:
    """key, value columns, c, tot: each key's most frequent value with its count and the key's count; ties go to the least value."""
    counted = rows.groupBy(key, *value).agg(F.count(F.lit(1)).alias("c"))
    total = F.sum("c").over(Window.partitionBy(key))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("c"), *value))
    return counted.withColumns({"tot": total, "rn": rank}).where("rn = 1").drop("rn")


def build(records: DataFrame, least_records: int = 5, least_purity: float = 0.9, least_model_purity: float = 0.8, source: str = "register") -> DataFrame:
    """tac, brand, manufacturer, model, release_year, records, purity, source from records with a valid checksum."""
    valid = records.where("tac is not null and imei_luhn_valid")
    b = top_share(valid.where("brand is not null"), "tac", ["brand", "manufacturer"]).withColumn("purity", F.col("c") / F.col("tot"))
    m = top_share(valid.where("model is not null"), "tac", ["model"]).where(F.col("c") / F.col("tot") >= least_model_purity).select("tac", "model")
    kept = b.where((F.col("tot") >= least_records) & (F.col("purity") >= least_purity))
    return kept.join(m, "tac", "left").select("tac", "brand", "manufacturer", "model", F.lit(None).cast("int").alias("release_year"), F.col("tot").alias("records"), F.round("purity", 4).alias("purity"), F.lit(source).alias("source"))


def external_entries(raw: DataFrame) -> DataFrame:
    """tac (eight digits), brand, model, release_year from an outside list (Brand, TAC, SPECS): one row a code, the least of ties.

    The model is the first part of the specs without the brand, or else the
    second; the brand is taken literally, whatever characters it has.
    """
    rows = raw.where(F.trim("TAC").rlike("^[0-9]+$")).select(F.lpad(F.trim("TAC"), 8, "0").alias("tac"), F.upper(F.trim("Brand")).alias("brand"), F.trim("SPECS").alias("specs"))

    def part(n: int) -> Column:
        p = F.upper(F.trim(F.split_part("specs", F.lit(","), F.lit(n))))
        return F.nullif(F.trim(F.when(F.startswith(p, F.col("brand")), F.substr(p, F.length("brand") + 1)).otherwise(p)), F.lit(""))

    year = F.nullif(F.regexp_extract("specs", r"\b((?:19|20)[0-9]{2})\b", 1), F.lit("")).try_cast("int")
    rows = rows.withColumns({"model": F.coalesce(part(1), part(2)), "release_year": year})
    return rows.groupBy("tac").agg(F.min("brand").alias("brand"), F.min("model").alias("model"), F.min("release_year").alias("release_year"))


def merge_external(own: DataFrame, entries: DataFrame, brands: DataFrame, name: str) -> DataFrame:
    """The dictionary with codes that only the outside list has, and with its models where consensus had none.

    ``brands`` maps the list's brands (nz_raw) to brand and manufacturer.
    """
    named = entries.join(brands.select(F.col("nz_raw").alias("brand"), F.col("brand").alias("b"), F.col("manufacturer").alias("m")), "brand", "left")
    new = named.join(own.select("tac"), "tac", "left_anti").select("tac", F.coalesce("b", "brand").alias("brand"), F.coalesce("m", "brand").alias("manufacturer"), "model", "release_year", F.lit(0).cast("bigint").alias("records"), F.lit(None).cast("double").alias("purity"), F.lit(name).alias("source"))
    models = entries.where("model is not null").select("tac", F.col("model").alias("x"))
    refilled = own.join(models, "tac", "left").withColumn("model", F.coalesce("model", "x")).drop("x")
    return refilled.unionByName(new)


def fill(records: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Records with brand, manufacturer and model from their code where the text gave none, and where each came from."""
    d = dictionary.select(F.col("tac").alias("d_tac"), *[F.col(c).alias(f"d_{c}") for c in ("brand", "manufacturer", "model", "release_year", "purity", "source")])
    rows = records.join(d, F.col("tac") == F.col("d_tac"), "left")
    has_b, d_b = F.col("brand").isNotNull(), F.col("d_brand").isNotNull()
    flags = {
        "release_year": F.col("d_release_year"),
        "brand_source": F.when(has_b, "text").when(d_b, F.concat(F.lit("tac:"), F.col("d_source"))),
        "tac_confidence": F.when(~has_b & d_b, F.col("d_purity")),
        "brand_conflict": has_b & d_b & (F.col("brand") != F.col("d_brand")),
        "tac_from_invalid_imei": (F.col("brand").isNull() | F.col("model").isNull()) & F.col("d_tac").isNotNull() & ~F.coalesce("imei_luhn_valid", F.lit(False)),
    }
    filled = {c: F.coalesce(F.col(c), F.col(f"d_{c}")) for c in ("brand", "manufacturer", "model")}
    kept = [c for c in records.columns if c not in flags]
    return rows.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in kept], *[v.alias(k) for k, v in flags.items()])


def model_key(records: DataFrame, lines: DataFrame) -> DataFrame:
    """``records`` with model_key: the model without its brand and without one leading line word of the brand.

    ``lines`` has brand and line_word in upper case; of several fitting words
    the greatest counts.  Brands and words are taken literally.
    """
    brand = F.upper(F.col("brand"))
    up = F.upper(F.col("model"))
    bare = F.trim(F.when(brand.isNotNull() & F.rlike(up, F.concat(F.lit(r"^\Q"), brand, F.lit(r"\E\s"))), F.substr(up, F.length(brand) + 1)).otherwise(up))
    rows = records.withColumns({"__b": brand, "__m": bare})
    pairs = rows.select("__b", "__m").where("__m is not null").distinct().join(lines.select(F.col("brand").alias("__b"), "line_word"), "__b")
    fits = pairs.where((F.col("__m") == F.col("line_word")) | F.startswith(F.col("__m"), F.concat("line_word", F.lit(" ")))).groupBy("__b", "__m").agg(F.max("line_word").alias("__w"))
    joined = rows.join(fits, ["__b", "__m"], "left")
    rest = F.when(F.col("__w").isNull(), F.col("__m")).otherwise(F.trim(F.substr(F.col("__m"), F.length("__w") + 1)))
    return joined.withColumn("model_key", F.nullif(rest, F.lit(""))).drop("__b", "__m", "__w")
