"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; nothing is collected, and a vertex
with a great many links is a skewed join key, which adaptive execution splits
because both sides of the join are read from written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, staged


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(k, comp) for every vertex of ``links`` (a, b): comp is the smallest vertex reachable.

    Loops and repeated links are allowed; an empty table gives no rows.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = staged(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large")
        least2 = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least2.select("a", F.col("m").alias("b")))
        after = staged(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        for old in (edges, least, large, least2):
            drop_staged(old)
        edges, now = after, _state(after)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("k"), F.col("b").alias("comp")).unionByName(edges.select(F.col("b").alias("k"), F.col("b").alias("comp"))).distinct()
