"""Folding snapshots into keyed state: one full outer join, gates, history, aggregates, ledger."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import FIELDS, LEDGER, STATE

PAYLOAD = [f for f in FIELDS if f != "id"]


class OutOfOrder(ValueError):
    """A day before the last folded one."""


class TooSmall(ValueError):
    """The file arrived whole and is not the register."""


@dataclass(frozen=True)
class Limits:
    """When a snapshot may close records."""

    least_rows: int = 700_000
    missing_per_day: float = 0.02
    missing_most: float = 0.25

    def allowance(self, gap_days: int) -> float:
        return min(self.missing_most, self.missing_per_day * max(1, gap_days))


@dataclass(frozen=True)
class Previous:
    """The last folded snapshot."""

    day: date
    source: str


@dataclass(frozen=True)
class Verdict:
    """What the gates made of a snapshot."""

    appeared: int
    changed: int
    missing: int
    present_before: int
    suspect: bool
    reason: str

    @property
    def disappeared(self) -> int:
        return 0 if self.suspect else self.missing


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def matched(state: DataFrame, snapshot: DataFrame) -> DataFrame:
    """State and snapshot side by side as structs ``r`` and ``s``; either may be null."""
    r = state.select(F.struct(*state.columns).alias("r"))
    s = snapshot.select(F.struct(*snapshot.columns).alias("s"))
    return r.join(s, F.col("r.record_key") == F.col("s.id"), "full_outer")


def _cases() -> dict[str, Column]:
    here, known = F.col("s").isNotNull(), F.col("r").isNotNull()
    present = F.coalesce(F.col("r.is_present"), F.lit(False))
    differs = here & known & ~F.col("r.content_hash").eqNullSafe(F.col("s.content_hash"))
    return {"appeared": here & ~known, "changed": differs, "returned": here & known & ~present, "missing": ~here & present}


def judge(pairs: DataFrame, rows: int, day: date, source: str, previous: Previous | None, limits: Limits) -> Verdict:
    """Measures everything in one pass before anything is written, then applies the gates."""
    if rows < limits.least_rows:
        raise TooSmall(f"{rows} rows are below the floor of {limits.least_rows}")
    if previous and day < previous.day:
        raise OutOfOrder(f"{day} is before {previous.day}")
    c = _cases()
    n = pairs.agg(F.count_if(c["appeared"]).alias("a"), F.count_if(c["changed"]).alias("c"), F.count_if(c["missing"]).alias("m"), F.count_if(F.coalesce(F.col("r.is_present"), F.lit(False))).alias("p")).first()
    suspect, reason = False, ""
    if previous and previous.source != source:
        suspect, reason = True, f"source changed from {previous.source} to {source}"
    elif previous:
        allowed = limits.allowance((day - previous.day).days)
        if n["m"] > n["p"] * allowed:
            suspect, reason = True, f"{n['m']} of {n['p']} records missing, {allowed:.1%} allowed"
    return Verdict(n["a"], n["c"], n["m"], n["p"], suspect, reason)


def next_state(pairs: DataFrame, day: date, source: str, previous: Previous | None, suspect: bool) -> DataFrame:
    """The state after a snapshot; the truth table of the fold as one projection."""
    c = _cases()
    today = F.lit(day)
    before = F.lit(previous.day if previous else day)
    bump = bool(previous and previous.source == source)
    closes = c["missing"] & F.lit(not suspect)
    moved = c["appeared"] | c["changed"] | c["returned"]
    r, s = (lambda n: F.col(f"r.{n}")), (lambda n: F.col(f"s.{n}"))
    fresh = c["appeared"] | c["changed"]
    out = {"record_key": F.coalesce(r("record_key"), s("id"))}
    for f in PAYLOAD:
        out[f] = F.when(fresh, s(f)).otherwise(r(f))
    out["extra_json"] = F.when(fresh, F.coalesce(s("extra_json"), r("extra_json"))).otherwise(r("extra_json"))
    out["content_hash"] = F.when(fresh, s("content_hash")).otherwise(r("content_hash"))
    out["first_seen"] = F.coalesce(r("first_seen"), today)
    out["last_seen"] = F.when(closes, before).when(moved, F.lit(None)).otherwise(r("last_seen"))
    out["disappeared_at"] = F.when(closes, today).when(moved, F.lit(None)).otherwise(r("disappeared_at"))
    out["returned_at"] = F.when(c["returned"], today).otherwise(r("returned_at"))
    out["is_present"] = F.when(closes, False).when(moved, True).otherwise(r("is_present"))
    out["revision_no"] = F.when(c["appeared"], 1).otherwise(r("revision_no") + F.when(c["changed"] & F.lit(bump), 1).otherwise(0))
    out["disappeared_count"] = F.when(c["appeared"], 0).otherwise(r("disappeared_count") + F.when(closes, 1).otherwise(0))
    out["first_source"] = F.coalesce(r("first_source"), F.lit(source))
    out["last_source"] = F.when(moved, F.lit(source)).otherwise(r("last_source"))
    return pairs.select(*[out[f.name].cast(f.dataType).alias(f.name) for f in STATE.fields])


def history(pairs: DataFrame, day: date, source: str, suspect: bool) -> DataFrame:
    """record_key, event, snapshot_date, source and content of every transition.

    Beside appeared, changed, disappeared and absent (missing from a suspect
    snapshot) there is ``returned`` for a record that came back unchanged, so
    that the log alone replays presence.
    """
    c = _cases()
    event = F.when(c["appeared"], "appeared").when(c["changed"], "changed").when(c["returned"], "returned").when(c["missing"], F.lit("absent" if suspect else "disappeared"))
    content = [F.coalesce(F.col(f"s.{f}"), F.when(F.col("s").isNull(), F.col(f"r.{f}"))).alias(f) for f in [*PAYLOAD, "content_hash"]]
    rows = pairs.select(F.coalesce(F.col("r.record_key"), F.col("s.id")).alias("record_key"), event.alias("event"), F.lit(day).alias("snapshot_date"), F.lit(source).alias("source"), *content)
    return rows.where("event is not null").withColumns({"year": F.year("snapshot_date"), "month": F.month("snapshot_date")})


def aggregates(state: DataFrame, day: date, source: str) -> DataFrame:
    """snapshot_date, source, dimension, key, records: total, closed, by year and by unit, from one scan."""
    dims = F.array(
        F.when(F.col("is_present"), F.struct(F.lit("total").alias("dimension"), F.lit("all").alias("key"))),
        F.when(~F.col("is_present"), F.struct(F.lit("closed_cumulative").alias("dimension"), F.lit("all").alias("key"))),
        F.when(F.col("is_present") & (F.col("insert_date") >= "2004"), F.struct(F.lit("registered_year").alias("dimension"), F.substring("insert_date", 1, 4).alias("key"))),
        F.when(F.col("is_present") & (F.trim("ovd") != ""), F.struct(F.lit("ovd").alias("dimension"), F.col("ovd").alias("key"))),
    )
    rows = state.select(F.explode(F.array_compact(dims)).alias("d")).groupBy("d.dimension", "d.key").agg(F.count(F.lit(1)).alias("records"))
    return rows.select(F.lit(day).alias("snapshot_date"), F.lit(source).alias("source"), "dimension", "key", "records")


def ledger_row(spark: SparkSession, source: str, day: date, **values) -> DataFrame:
    """One ledger row; columns not given are null."""
    full = {f.name: None for f in LEDGER.fields} | {"source": source, "snapshot_date": day} | values
    return spark.createDataFrame([tuple(full[f.name] for f in LEDGER.fields)], LEDGER)


def upsert_ledger(ledger: DataFrame, more: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Rows of ``more`` replace those of the same (source, snapshot_date); with ``only`` just these columns change."""
    keys = ["source", "snapshot_date"]
    o, n = ledger.alias("o"), more.alias("n")
    on = (F.col("o.source") == F.col("n.source")) & (F.col("o.snapshot_date") == F.col("n.snapshot_date"))
    newer = F.col("n.source").isNotNull()
    columns = []
    for c in ledger.columns:
        if c in keys:
            columns.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        elif only and c not in only:
            columns.append(F.when(F.col("o.source").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            columns.append(F.when(newer, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return o.join(n, on, "full_outer").select(*columns)


def observations(ledger: DataFrame) -> DataFrame:
    """The days that were read: snapshot_date, source, record_count, closures_trusted, days_since_previous."""
    from pyspark.sql.window import Window

    folded = ledger.where(F.coalesce("status", F.lit("folded")) == "folded")
    w = Window.orderBy("snapshot_date", "source")  # one row a day
    gap = F.datediff("snapshot_date", F.lag("snapshot_date").over(w)).cast("bigint")
    return folded.select("snapshot_date", "source", "record_count", (~F.coalesce("is_suspect", F.lit(False))).alias("closures_trusted"), gap.alias("days_since_previous"))


def with_asof(rows: DataFrame, calendar: DataFrame, day: str, out: str, calendar_day: str = "snapshot_date") -> DataFrame:
    """``rows`` with the last calendar day strictly before ``day``.

    Distinct days of both sides are merged and walked once in order, so the
    cost per row is one equality join on the day.
    """
    from pyspark.sql.window import Window

    marks = calendar.select(F.col(calendar_day).alias("d")).distinct().select("d", F.col("d").alias("mark"))
    asked = rows.select(F.col(day).alias("d")).where("d is not null").distinct()
    merged = asked.select("d", F.lit(None).cast("date").alias("mark"), F.lit(True).alias("asked")).unionByName(marks.withColumn("asked", F.lit(False)))
    w = Window.orderBy(F.col("d"), F.col("asked").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a few thousand days
    found = merged.withColumn(out, F.last("mark", ignorenulls=True).over(w)).where("asked").select(F.col("d").alias("__d"), out)
    return rows.join(found, F.col(day) == F.col("__d"), "left").drop("__d")
