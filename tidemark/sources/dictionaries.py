"""Dictionaries that users bring as CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import clean


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, all columns as text, malformed lines dropped, ``#`` lines skipped."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.option("header", True).option("mode", "DROPMALFORMED").option("comment", "#").option("enforceSchema", False).schema(schema).csv(path)


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def brand_aliases(rows: DataFrame) -> DataFrame:
    """alias (cleaned), brand, manufacturer; of equal aliases the first by ``position`` (or by brand) stays."""
    order = "position" if "position" in rows.columns else "brand"
    named = rows.select(clean(F.col("alias")).alias("alias"), F.trim("brand").alias("brand"), F.trim(F.when(F.coalesce("manufacturer", F.lit("")) != "", F.col("manufacturer")).otherwise(F.col("brand"))).alias("manufacturer"), F.col(order).alias("__o"))
    return first_of(named.where("alias <> ''"), "alias", "__o").drop("__o")


def word_aliases(rows: DataFrame) -> dict[str, str]:
    """Upper-case word -> its canonical form (a dictionary file of tens of words)."""
    found = rows.select(F.upper(F.trim("alias")).alias("a"), F.trim("canonical").alias("c")).where("a <> ''").groupBy("a").agg(F.min("c").alias("c"))
    return {r["a"]: r["c"] for r in found.collect()}


def line_words(rows: DataFrame) -> DataFrame:
    """brand, line_word in upper case, without blanks."""
    return rows.select(F.upper(F.trim("brand")).alias("brand"), F.upper(F.trim("line_word")).alias("line_word")).where("line_word <> ''").distinct()
