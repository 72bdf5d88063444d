"""Entity resolution of free text against a dictionary: exact, longest prefix, glued, fuzzy; nearest entries; regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import places
from tidemark.functions.distance import osa_distance
from tidemark.functions.text import clean, defuse_homoglyphs, normalize_model, script_mixed

#: Bump when ``resolve`` changes its mind about anything: cached results are keyed by it.
RESOLVER_VERSION = 1


def longest_token_prefix(rows: DataFrame, key: str, text: str, entries: DataFrame, entry: str, longest: int = 3) -> DataFrame:
    """key and the entry that equals the most leading tokens (1 to ``longest``) of the text: equality joins on built keys."""
    tokens = F.split(F.col(text), " ")
    heads = F.transform(F.sequence(F.lit(1), F.least(F.size(tokens), F.lit(longest))), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(tokens, 1, n), " ").alias("head")))
    wide = rows.select(key, F.explode(heads).alias("h")).select(key, "h.n", "h.head")
    hits = wide.join(entries.select(F.col(entry).alias("head")).distinct(), "head")
    return hits.groupBy(key).agg(F.max_by("head", "n").alias(entry), F.max("n").alias("tokens"))


def longest_string_prefix(rows: DataFrame, key: str, head: str, entries: DataFrame, entry: str) -> DataFrame:
    """key, the longest entry that properly begins the head, and the tail behind it.

    The tail must hold something, and something besides letters unless the
    entry has five characters or more.
    """
    prefixes = F.transform(F.sequence(F.lit(1), F.length(head) - 1), lambda n: F.struct(n.alias("n"), F.substr(F.col(head), F.lit(1), n).alias("p"), F.btrim(F.substr(F.col(head), n + 1), F.lit("-_ ")).alias("tail")))
    wide = rows.where(F.length(head) > 1).select(key, F.explode(prefixes).alias("x")).select(key, "x.*")
    wide = wide.where((F.col("tail") != "") & (~F.col("tail").rlike(r"^\p{L}+$") | (F.col("n") >= 5)))
    hits = wide.join(entries.select(F.col(entry).alias("p")).distinct(), "p", "left_semi")  # a semi join never broadcasts the prefixes, which planning takes for no larger than the rows
    return hits.groupBy(key).agg(F.max_by("p", "n").alias(entry), F.max_by("tail", "n").alias("tail"))


def budget(length: Column) -> Column:
    """Edits that a word of this length may be off by."""
    return F.when(length <= 6, 1).otherwise(2)


def within_edits(rows: DataFrame, key: str, word: str, entries: DataFrame, entry: str, edits: Column | int) -> DataFrame:
    """key, entry, distance of all pairs within the number of edits; lengths meet by an equality join on the band."""
    allowed = edits if isinstance(edits, Column) else F.lit(edits)
    banded = rows.select(key, F.col(word).alias("__w"), allowed.alias("__e")).withColumn("__n", F.explode(F.sequence(F.length("__w") - F.col("__e"), F.length("__w") + F.col("__e"))))
    pairs = banded.join(entries.select(F.col(entry), F.length(entry).alias("__n")).distinct(), "__n")
    return pairs.withColumn("distance", osa_distance(F.col("__w"), F.col(entry))).where("distance <= __e").select(key, entry, "distance")


def resolve(spellings: DataFrame, aliases: DataFrame, words: dict[str, str] | None = None, column: str = "nz_raw", fold_width: bool = True) -> DataFrame:
    """nz_raw, nz_clean, brand, manufacturer, model, method, homoglyph_fixed, script_mixed of every distinct spelling.

    ``aliases`` has alias (cleaned), brand and manufacturer.  Methods in order
    of preference: empty, exact, prefix, glued, fuzzy, none.  A fuzzy match that
    two brands claim at the same distance is refused.
    """
    rows = spellings.select(F.col(column).alias("nz_raw")).distinct()
    rows = rows.withColumn("cleaned", clean(F.col("nz_raw"), fold_width)).withColumns({"nz_clean": defuse_homoglyphs(F.col("cleaned")), "script_mixed": script_mixed(F.col("cleaned"))})
    rows = rows.withColumns({"homoglyph_fixed": F.col("nz_clean") != F.col("cleaned"), "tokens": F.split("nz_clean", " "), "sid": F.col("nz_clean")})
    texts = rows.where("nz_clean <> ''").select("sid", "nz_clean", "tokens").distinct().withColumn("head", F.col("tokens")[0])
    exact = texts.join(aliases.select("alias"), texts["nz_clean"] == aliases["alias"], "left_semi").select("sid", F.col("nz_clean").alias("alias"), F.lit(0).alias("rank"), F.lit("exact").alias("method"), F.lit(None).cast("string").alias("model"))
    prefix = _prefixed(texts, aliases)
    glued = longest_string_prefix(texts, "sid", "head", aliases, "alias").join(texts.select("sid", F.col("tokens").alias("all")), "sid")
    glued = glued.select("sid", "alias", F.lit(2).alias("rank"), F.lit("glued").alias("method"), F.concat_ws(" ", F.col("tail"), F.slice("all", 2, 1 << 20)).alias("model"))
    sure = exact.unionByName(prefix).unionByName(glued)
    open_ = texts.where(F.length("head") >= 4).join(sure.select("sid").distinct(), "sid", "left_anti")
    near = within_edits(open_, "sid", "head", aliases, "alias", budget(F.length("head"))).join(aliases.select("alias", "brand"), "alias")
    closest = near.groupBy("sid").agg(F.min("distance").alias("d")).join(near, "sid").where("distance = d")
    fuzzy = closest.groupBy("sid").agg(F.min("alias").alias("alias"), F.count_distinct("brand").alias("claims")).where("claims = 1").join(texts.select("sid", "tokens"), "sid")
    fuzzy = fuzzy.select("sid", "alias", F.lit(3).alias("rank"), F.lit("fuzzy").alias("method"), F.nullif(F.array_join(F.slice("tokens", 2, 1 << 20), " "), F.lit("")).alias("model"))
    best = sure.unionByName(fuzzy).groupBy("sid").agg(F.min_by(F.struct("alias", "method", "model"), "rank").alias("m"))
    found = best.select("sid", "m.*").join(aliases.select("alias", "brand", "manufacturer"), "alias").select("sid", "brand", "manufacturer", "method", normalize_model(F.col("model"), words).alias("model"))
    out = rows.join(found, "sid", "left")
    method = F.when(F.col("nz_clean") == "", "empty").otherwise(F.coalesce("method", F.lit("none")))
    return out.select("nz_raw", "nz_clean", "brand", "manufacturer", "model", method.alias("method"), "homoglyph_fixed", "script_mixed")


def _prefixed(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    hits = longest_token_prefix(texts, "sid", "nz_clean", aliases, "alias").withColumnRenamed("tokens", "n").join(texts.select("sid", "tokens"), "sid")
    rest = F.nullif(F.array_join(F.slice(F.col("tokens"), F.col("n") + 1, F.greatest(F.size("tokens") - F.col("n"), F.lit(0))), " "), F.lit(""))
    return hits.select("sid", "alias", F.lit(1).alias("rank"), F.lit("prefix").alias("method"), rest.alias("model"))


def nearest(queries: DataFrame, query: str, entries: DataFrame, entry: str, limit: int = 5, least: float = 0.7, band: int = 3) -> DataFrame:
    """query, entry, similarity: the closest entries of each query, most alike first, then by name."""
    q = queries.select(F.col(query).alias("query")).where("query <> ''").distinct()
    banded = q.withColumn("__n", F.explode(F.sequence(F.length("query") - band, F.length("query") + band)))
    pairs = banded.join(entries.select(F.col(entry).alias("entry"), F.length(entry).alias("__n")).distinct(), "__n")
    longest = F.greatest(F.length("query"), F.length("entry"))
    scored = pairs.withColumn("s", 1.0 - osa_distance(F.col("query"), F.col("entry")) / longest).where(F.col("s") >= least).withColumn("similarity", F.round("s", 3))
    w = Window.partitionBy("query").orderBy(F.desc("similarity"), "entry")
    return scored.withColumn("position", F.row_number().over(w)).where(F.col("position") <= limit).select("query", "entry", "similarity", "position")


def regions(names: DataFrame, column: str = "ovd") -> DataFrame:
    """ovd, region, unit_type of every distinct unit name."""
    units = names.select(F.col(column).alias("ovd")).where("trim(ovd) <> ''").distinct().withColumn("direct", places.region_by_marks_and_stems(F.col("ovd")))
    spark = names.sparkSession
    stems = spark.createDataFrame([(s, r, i) for i, (s, r) in enumerate(places.stems())], "stem string, region string, i int")
    words = units.where("direct is null").withColumn("word", places.letters_key(F.col("ovd"))).where(F.length("word") >= places.LEAST_TOKEN)
    near = within_edits(words, "ovd", "word", stems, "stem", places.EDITS).join(stems, "stem").groupBy("ovd").agg(F.min_by("region", "i").alias("near"))
    return units.join(near, "ovd", "left").select("ovd", F.coalesce("direct", "near").alias("region"), places.unit_kind(F.col("ovd")).alias("unit_type"))
