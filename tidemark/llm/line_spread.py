"""Cross-site boilerplate lines: found by how many distinct sites carry them, removed everywhere but once.

A line is compared by its text without leading and trailing blanks; blank lines
are never counted or removed.  A line that occurs fewer than ``min_sites`` times
cannot be on that many sites, so a plain count (combined before the shuffle)
leaves few lines.  Each of those gets a HyperLogLog sketch of its sites; sketches
merge by aggregation, so a line on every page costs one small row a task.  Where the
estimate is within the sketch's error of the threshold, sites are counted
exactly.  Occurrences of boilerplate lines are removed except the first (lowest
document id, then position), so that no text is lost from the corpus as a whole.

Only DataFrame functions are used.

Defined results: a null or empty text has one empty line, which stays; a null
site adds to no line's spread but its documents are cleaned too; equal rows of
one id are treated alike; rows with a null id come first; an empty table gives
no rows; other columns pass through, and own names win over clashing ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_staged, staged, table

LG_K = 12
BLANKS = " \t\r"
_LEAST = -(1 << 63)


def _prepared(docs: DataFrame, key: str, text: str, site: str | None = None) -> DataFrame:
    """k (null: the least number), th (tells rows of one id apart), site and lines."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    more = [F.col(f"`{site}`").cast("string").alias("site")] if site else []
    return docs.select(F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(_LEAST)).alias("k"), F.xxhash64(t).alias("th"), *more, F.split(t, "\n").alias("lines"))


def _line_key(line: Column) -> list[Column]:
    """128 bits of the line's hash."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2")]


def boilerplate(docs: DataFrame, key: str, text: str, site: str, min_sites: int) -> tuple[DataFrame, DataFrame]:
    """(occurrences k, th, pos of lines that may be boilerplate with h1, h2; boilerplate lines h1, h2, sites, first)."""
    lines = _prepared(docs, key, text, site).select("k", "th", "site", F.posexplode("lines").alias("pos", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''").select("k", "th", "site", "pos", *_line_key(F.col("line")))
    frequent = staged(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("h1", "h2"), "frequent")
    places = staged(lines.join(frequent, ["h1", "h2"], "left_semi"), "places")
    drop_staged(frequent)
    margin = max(1, math.ceil(4 * 1.04 / math.sqrt(1 << LG_K) * min_sites))
    spread = places.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min(F.struct("k", "th", "pos")).alias("first"))
    spread = staged(spread.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites"), "first").where(F.col("sites") >= min_sites - margin), "spread")
    near = spread.where(F.col("sites") <= min_sites + margin).select("h1", "h2")
    exact = places.join(near, ["h1", "h2"], "left_semi").where("site is not null").groupBy("h1", "h2", "site").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count("one").alias("exact"))
    found = spread.join(exact, ["h1", "h2"], "left").select("h1", "h2", F.coalesce("exact", F.when(F.col("sites") > min_sites + margin, F.col("sites")), F.lit(0)).alias("sites"), "first").where(F.col("sites") >= min_sites)
    return places, staged(found, "boilerplate")


def remove_boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = 10) -> DataFrame:
    """``docs`` with cleaned text, and n_lines and n_removed behind its own columns."""
    return _without(docs, *boilerplate(docs, key, text, site, min_sites), key, text)


def repeated(docs: DataFrame, key: str, text: str, more_words: int) -> tuple[DataFrame, DataFrame]:
    """Like ``boilerplate``, for lines of more than ``more_words`` words that occur twice or more, on whatever sites."""
    lines = _prepared(docs, key, text).select("k", "th", F.posexplode("lines").alias("pos", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.regexp_count("line", F.lit(r"[^ \t\r]+")) > more_words).select("k", "th", "pos", *_line_key(F.col("line")))
    found = staged(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "th", "pos")).alias("first")).where("n > 1").select("h1", "h2", "first"), "repeated")
    return staged(lines.join(found.select("h1", "h2"), ["h1", "h2"], "left_semi"), "places"), found


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", more_words: int = 50) -> DataFrame:
    """``docs`` with every long line only where it occurs first, and n_lines and n_removed behind its own columns."""
    return _without(docs, *repeated(docs, key, text, more_words), key, text)


def _without(docs: DataFrame, places: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` without the ``places`` of ``found`` lines, but for the first of each."""
    gone = places.join(found, ["h1", "h2"]).where(~F.struct("k", "th", "pos").eqNullSafe(F.col("first")))
    gone = staged(gone.groupBy("k", "th").agg(F.collect_set("pos").alias("gone")), "removals")
    drop_staged(places)
    own = [c for c in docs.columns if c not in (text, "n_lines", "n_removed")]
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"),
        F.col(f"`{text}`").cast("string").alias("whole"),
        F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(_LEAST)).alias("k"),
        F.xxhash64(t).alias("th"),
        (F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
    )
    session = docs.sparkSession._jsparkSession
    if int(str(gone._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > session.sessionState().conf().autoBroadcastJoinThreshold():
        gone = gone.hint("shuffle_hash")  # the removals are held, the texts go by unsorted; fewer are broadcast, and no text is shuffled
    joined = whole.join(gone, ["k", "th"], "left")
    left = lambda lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: F.get(lines, i)), "\n")
    clean = F.when(F.col("gone").isNull(), F.col("whole")).otherwise(F.transform(F.array(F.split("whole", "\n")), left)[0])  # bound by a lambda, a text is split once
    out = joined.select(
        "own",
        clean.alias("clean"),
        "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )
    return out.select(*[F.col("clean").alias(c) if c == text else F.col("own").getField(c).alias(c) for c in docs.columns if c == text or c in own], "n_lines", "n_removed")


def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all documents; lines on ten sources or more are boilerplate."""
    clean = remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return clean.select("doc_id", "n_lines", "n_removed", F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars_left"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


OP6_SQL = r"""
WITH l AS (
  SELECT doc_id, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
s AS (SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM l),
b AS (SELECT bare FROM s WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10),
r AS (SELECT s.doc_id, s.pos, s.line, b.bare IS NOT NULL AND row_number() OVER (PARTITION BY s.bare ORDER BY s.doc_id, s.pos) > 1 AS gone
      FROM s LEFT JOIN b ON s.bare = b.bare),
t AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS clean
      FROM r GROUP BY doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed,
       CAST(length(clean) AS BIGINT) AS n_chars_left, md5(clean) AS text_md5
FROM t
"""
