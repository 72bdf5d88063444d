"""The whole series folded at once, when it is known which snapshots may close records.

A key's presences are looked at in order.  Between a presence and the next one
the key was closed by the first trusted snapshot in between, if there is one;
that snapshot is looked up by index in a small calendar.  Everything else is a
window over the key or an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def calendar(snapshots: DataFrame) -> DataFrame:
    """i (1..n), day, source, trusted, previous source and day, and the next trusted index after i, for (day, source, trusted)."""
    w = Window.orderBy("day")  # one row a snapshot
    rows = snapshots.withColumn("i", F.row_number().over(w)).withColumns({"prev_source": F.lag("source").over(w), "prev_day": F.lag("day").over(w)})
    ahead = Window.orderBy("i").rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumn("next_trusted", F.min(F.when(F.col("trusted"), F.col("i"))).over(ahead))


def fold_series(presences: DataFrame, snapshots: DataFrame) -> DataFrame:
    """State after the last snapshot, from presences (record_key, day, content_hash) and snapshots (day, source, trusted)."""
    days = calendar(snapshots)
    w = Window.partitionBy("record_key").orderBy("i")
    rows = presences.join(F.broadcast(days), "day")  # one row a snapshot: bounded by the number of days read
    rows = rows.withColumns({"next_i": F.lead("i").over(w), "last_hash": F.lag("content_hash").over(w)})
    closed = F.when(F.col("next_trusted") < F.coalesce("next_i", F.lit(1 << 30)), F.col("next_trusted"))
    rows = rows.withColumn("closed_by", closed).withColumn("was_closed", F.lag("closed_by").over(w).isNotNull())
    changed = F.col("last_hash").isNotNull() & (F.col("last_hash") != F.col("content_hash"))
    rows = rows.withColumn("moved", F.col("last_hash").isNull() | changed | F.col("was_closed"))
    state = rows.groupBy("record_key").agg(
        F.max_by("content_hash", "i").alias("content_hash"),
        F.min("day").alias("first_seen"),
        F.max_by("closed_by", "i").alias("closed_by"),
        F.max(F.when(F.col("was_closed"), F.col("day"))).alias("returned_at"),
        (1 + F.count_if(changed & F.col("source").eqNullSafe(F.col("prev_source")))).cast("bigint").alias("revision_no"),
        F.count("closed_by").alias("disappeared_count"),
        F.min_by("source", "i").alias("first_source"),
        F.max_by("source", F.when(F.col("moved"), F.col("i"))).alias("last_source"),
    )
    closing = days.select(F.col("i").alias("closed_by"), F.col("day").alias("disappeared_at"), F.col("prev_day").alias("last_seen"))
    state = state.join(F.broadcast(closing), "closed_by", "left")
    return state.select("record_key", "content_hash", "first_seen", "last_seen", "disappeared_at", "returned_at", F.col("closed_by").isNull().alias("is_present"), "revision_no", "disappeared_count", "first_source", "last_source")


def events_of_series(presences: DataFrame, snapshots: DataFrame) -> DataFrame:
    """record_key, event, day: appeared, changed, returned and disappeared events of the whole series."""
    days = calendar(snapshots)
    w = Window.partitionBy("record_key").orderBy("i")
    rows = presences.join(F.broadcast(days), "day").withColumns({"next_i": F.lead("i").over(w), "last_hash": F.lag("content_hash").over(w)})
    rows = rows.withColumn("closed_by", F.when(F.col("next_trusted") < F.coalesce("next_i", F.lit(1 << 30)), F.col("next_trusted")))
    was_closed = F.lag("closed_by").over(w).isNotNull()
    rows = rows.withColumn("event", F.when(F.col("last_hash").isNull(), "appeared").when(F.col("last_hash") != F.col("content_hash"), "changed").when(was_closed, "returned"))
    here = rows.where("event is not null").select("record_key", "event", "day")
    gone = rows.where("closed_by is not null").join(F.broadcast(days.select(F.col("i").alias("closed_by"), F.col("day").alias("closing_day"))), "closed_by")
    return here.unionByName(gone.select("record_key", F.lit("disappeared").alias("event"), F.col("closing_day").alias("day")))
