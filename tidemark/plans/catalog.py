"""Registry of the engine's queries over the driver's tables: each operator on real rows, with DuckDB SQL beside it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import dates, identifiers, places, text
from tidemark.functions.distance import osa_distance
from tidemark.operators import closed_form, consensus, fold, match, normalise, quality, stage
from tidemark.plans import reports
from tidemark.session import work_dir
from tidemark.sources import revisions
from tidemark.sources.sinks import Versions
from tidemark.streaming.fold_stream import Folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name, with the SQL that gives the same result."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["state_fold_events"](spark, sf_dir)


# --- keyed state ---------------------------------------------------------------------------------


def _presences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is present on a day with a purchase or an error; the day's content is the last such event's kind.

    Other kinds are no presence, as in the SQL: the days without one are the gaps that close records.
    """
    rows = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "error")).select(F.col("user_id").cast("string").alias("record_key"), F.col("ts").cast("date").alias("day"), "ts", "event_id", "event_type")
    return rows.groupBy("record_key", "day").agg(F.md5(F.max_by("event_type", F.struct("ts", "event_id"))).alias("content_hash"))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day")).distinct()
    return days.select("day", F.when(F.dayofmonth("day") <= 15, "a").otherwise("b").alias("source"), (F.dayofmonth("day") % 7 != 0).alias("trusted"))


_SERIES = """
p AS (SELECT CAST(user_id AS VARCHAR) AS record_key, CAST(ts AS DATE) AS day, md5(arg_max(event_type, (ts, event_id))) AS content_hash
      FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1, 2),
s AS (SELECT day, row_number() OVER (ORDER BY day) AS i, CASE WHEN day(day) <= 15 THEN 'a' ELSE 'b' END AS source, day(day) % 7 <> 0 AS trusted
      FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)),
c AS (SELECT *, lag(source) OVER (ORDER BY i) AS prev_source, lag(day) OVER (ORDER BY i) AS prev_day,
             min(CASE WHEN trusted THEN i END) OVER (ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_trusted FROM s),
r AS (SELECT p.*, c.i, c.source, c.prev_source, c.next_trusted, lead(c.i) OVER w AS next_i, lag(content_hash) OVER w AS last_hash
      FROM p JOIN c USING (day) WINDOW w AS (PARTITION BY record_key ORDER BY c.i)),
x AS (SELECT *, CASE WHEN next_trusted < coalesce(next_i, 1000000000) THEN next_trusted END AS closed_by FROM r),
y AS (SELECT *, lag(closed_by) OVER (PARTITION BY record_key ORDER BY i) IS NOT NULL AS was_closed FROM x)
"""


@query(f"""
WITH {_SERIES},
g AS (SELECT record_key, arg_max(content_hash, i) AS content_hash, min(day) AS first_seen, max(i) AS last_i,
             max(CASE WHEN was_closed THEN day END) AS returned_at,
             1 + count(*) FILTER (WHERE last_hash <> content_hash AND source = prev_source) AS revision_no,
             count(closed_by) AS disappeared_count, arg_min(source, i) AS first_source,
             arg_max(source, i) FILTER (WHERE last_hash IS NULL OR last_hash <> content_hash OR was_closed) AS last_source
      FROM y GROUP BY record_key)
SELECT g.record_key, g.content_hash, g.first_seen, c.prev_day AS last_seen, c.day AS disappeared_at, g.returned_at,
       y.closed_by IS NULL AS is_present, CAST(g.revision_no AS BIGINT) AS revision_no, g.disappeared_count, g.first_source, g.last_source
FROM g JOIN y ON y.record_key = g.record_key AND y.i = g.last_i LEFT JOIN c ON c.i = y.closed_by
""")
def state_fold_events(spark, sf_dir):
    """A month of daily snapshots folded into state, closures only by trusted days."""
    return closed_form.fold_series(_presences(spark, sf_dir), _snapshots(spark, sf_dir))


@query(f"""
WITH {_SERIES}
SELECT record_key, CASE WHEN last_hash IS NULL THEN 'appeared' WHEN last_hash <> content_hash THEN 'changed' ELSE 'returned' END AS event, day
FROM y WHERE last_hash IS NULL OR last_hash <> content_hash OR was_closed
UNION ALL SELECT y.record_key, 'disappeared', c.day FROM y JOIN c ON c.i = y.closed_by
""")
def history_events(spark, sf_dir):
    """All transitions of the series, with returns of unchanged records."""
    return closed_form.events_of_series(_presences(spark, sf_dir), _snapshots(spark, sf_dir))


def _halves(spark: SparkSession, sf_dir: str) -> list[tuple[date, DataFrame]]:
    """Three snapshots of orders: as they are, without every ninth and with some changed, and all again."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("nz"), F.col("o_orderstatus").alias("ovd"), F.col("o_orderkey").alias("k"))
    blank = [F.lit(None).cast("string").alias(c) for c in ("insert_date", "imei", "nk", "dk", "dtl")]
    first = o.select("id", "nz", "ovd", *blank)
    second = o.where("k % 9 <> 0").select("id", F.when(F.col("k") % 4 == 0, F.lower("nz")).otherwise(F.col("nz")).alias("nz"), "ovd", *blank)
    third = o.where("k % 10 <> 1").select("id", F.when(F.col("k") % 4 == 0, F.lower("nz")).otherwise(F.col("nz")).alias("nz"), "ovd", *blank)
    return [(date(2024, 1, 1), first), (date(2024, 1, 2), second), (date(2024, 1, 4), third)]


_GATED = fold.Limits(least_rows=1, missing_per_day=0.5, missing_most=0.5)


def _folded(spark: SparkSession, sf_dir: str, limits: fold.Limits, sources: str) -> tuple[Folder, list]:
    """The three snapshots folded into a new state below the shared folder, with their outcomes."""
    folder = Folder(spark, work_dir(spark, "state"), limits)
    return folder, [folder.fold(raw, source, day) for source, (day, raw) in zip(sources, _halves(spark, sf_dir))]


_LOWER = "(o_orderkey % 4 = 0 AND lower(o_orderpriority) <> o_orderpriority)"


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS record_key, 'appeared' AS event, DATE '2024-01-01' AS snapshot_date FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 9 = 0 THEN 'disappeared' ELSE 'changed' END, DATE '2024-01-02' FROM orders WHERE o_orderkey % 9 = 0 OR {_LOWER}
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 10 = 1 THEN 'disappeared' WHEN {_LOWER} THEN 'changed' ELSE 'returned' END, DATE '2024-01-04'
  FROM orders WHERE (o_orderkey % 10 = 1) <> (o_orderkey % 9 = 0)""")
def history_gated(spark, sf_dir):
    """Every transition of three snapshots that passed the gates."""
    return _folded(spark, sf_dir, _GATED, "aaa")[0].history().select("record_key", "event", "snapshot_date")


@query(f"""
SELECT DATE '2024-01-01' AS snapshot_date, count(*) AS appeared, 0 AS changed, 0 AS missing, 0 AS disappeared, false AS is_suspect FROM orders
UNION ALL SELECT DATE '2024-01-02', 0, count(*) FILTER (WHERE o_orderkey % 9 <> 0 AND {_LOWER}), count(*) FILTER (WHERE o_orderkey % 9 = 0), 0, true FROM orders
UNION ALL SELECT DATE '2024-01-04', 0, count(*) FILTER (WHERE o_orderkey % 9 = 0 AND o_orderkey % 10 <> 1 AND {_LOWER}), count(*) FILTER (WHERE o_orderkey % 10 = 1), 0, true FROM orders""")
def fold_gates(spark, sf_dir):
    """A drop beyond the allowance and a change of publisher make snapshots suspect: they close nothing."""
    folder, _ = _folded(spark, sf_dir, fold.Limits(least_rows=1, missing_per_day=0.02, missing_most=0.05), "aab")
    return folder.ledger().select("snapshot_date", "appeared", "changed", "missing", "disappeared", "is_suspect")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS record_key,
  CASE WHEN (o_orderkey % 9 <> 0 OR o_orderkey % 10 <> 1) AND o_orderkey % 4 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS nz,
  DATE '2024-01-01' AS first_seen,
  CASE WHEN o_orderkey % 10 = 1 AND o_orderkey % 9 = 0 THEN DATE '2024-01-01' WHEN o_orderkey % 10 = 1 THEN DATE '2024-01-02' END AS last_seen,
  CASE WHEN o_orderkey % 10 = 1 AND o_orderkey % 9 = 0 THEN DATE '2024-01-02' WHEN o_orderkey % 10 = 1 THEN DATE '2024-01-04' END AS disappeared_at,
  CASE WHEN o_orderkey % 9 = 0 AND o_orderkey % 10 <> 1 THEN DATE '2024-01-04' END AS returned_at,
  o_orderkey % 10 <> 1 AS is_present,
  CAST(CASE WHEN o_orderkey % 4 = 0 AND lower(o_orderpriority) <> o_orderpriority AND (o_orderkey % 9 <> 0 OR o_orderkey % 10 <> 1) THEN 2 ELSE 1 END AS INTEGER) AS revision_no,
  CAST(CASE WHEN o_orderkey % 9 = 0 OR o_orderkey % 10 = 1 THEN 1 ELSE 0 END AS INTEGER) AS disappeared_count
FROM orders
""")
def state_fold_gated(spark, sf_dir):
    """Three snapshots folded one after another through the gates, each by one full outer join; every state is committed before the next fold."""
    versions, state, previous = Versions(spark, work_dir(spark, "state")), fold.empty_state(spark), None
    for day, raw in _halves(spark, sf_dir):
        staged = stage.stage(raw)
        pairs = fold.matched(state, staged.snapshot)
        verdict = fold.judge(pairs, staged.stats["rows_raw"], day, "a", previous, _GATED)
        versions.commit({"state": fold.next_state(pairs, day, "a", previous, verdict.suspect)})
        state, previous = versions.read("state"), fold.Previous(day, "a")
    return state.select("record_key", "nz", "first_seen", "last_seen", "disappeared_at", "returned_at", "is_present", "revision_no", "disappeared_count")


@query("SELECT event_id, user_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def dedup_latest_per_key(spark, sf_dir):
    """The last event of each user and kind."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return stage.deduplicated(rows, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query("""
SELECT 'total' AS dimension, 'all' AS key, count(*) AS records FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'closed_cumulative', 'all', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'registered_year', strftime(o_orderdate, '%Y'), count(*) FROM orders WHERE o_orderstatus <> 'F' AND strftime(o_orderdate, '%Y') >= '2004' GROUP BY ALL
UNION ALL SELECT 'ovd', o_orderpriority, count(*) FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL
""")
def snapshot_aggregates(spark, sf_dir):
    """Four kinds of counts from one scan."""
    state = table(spark, sf_dir, "orders").select((F.col("o_orderstatus") != "F").alias("is_present"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("insert_date"), F.col("o_orderpriority").alias("ovd"))
    return fold.aggregates(state, date(2024, 1, 1), "a").select("dimension", "key", "records")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days as readings."""
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("record_count"))
    w = F.dayofmonth("snapshot_date")
    return days.select(F.lit("a").alias("source"), "snapshot_date", F.when(w % 5 == 0, "duplicate").otherwise("folded").alias("status"), (w % 3 == 0).alias("is_suspect"), "record_count")


_OBS = """o AS (SELECT snapshot_date, 'a' AS source, record_count, day(snapshot_date) % 3 <> 0 AS closures_trusted, snapshot_date - lag(snapshot_date) OVER (ORDER BY snapshot_date) AS days_since_previous
 FROM (SELECT CAST(o_orderdate AS DATE) AS snapshot_date, count(*) AS record_count FROM orders GROUP BY 1) WHERE day(snapshot_date) % 5 <> 0)"""


@query(f"WITH {_OBS} SELECT snapshot_date, source, record_count, closures_trusted, CAST(days_since_previous AS BIGINT) AS days_since_previous FROM o")
def observations_gap(spark, sf_dir):
    """Days read, and days since the reading before."""
    return fold.observations(_ledger(spark, sf_dir))


@query(f"""WITH {_OBS}
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS first_seen, x.m AS first_seen_after, CAST(CAST(l_shipdate AS DATE) - x.m AS BIGINT) AS first_seen_days
FROM lineitem LEFT JOIN (SELECT d, (SELECT max(o.snapshot_date) FROM o WHERE o.snapshot_date < d) AS m FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)) x ON x.d = CAST(l_shipdate AS DATE)
""")
def first_seen_asof(spark, sf_dir):
    """The last reading strictly before each ship day."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("first_seen"))
    out = fold.with_asof(rows, fold.observations(_ledger(spark, sf_dir)), "first_seen", "first_seen_after")
    return out.withColumn("first_seen_days", F.datediff("first_seen", "first_seen_after").cast("bigint"))


@query(f"""WITH {_OBS},
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', (SELECT min(snapshot_date) FROM o)), date_trunc('month', (SELECT max(snapshot_date) FROM o)), INTERVAL 1 MONTH)) AS DATE) AS period),
s AS (SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS period, count(*) AS n, max(days_since_previous) AS gap FROM o GROUP BY 1),
e AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, count(*) AS n FROM lineitem GROUP BY 1)
SELECT m.period, coalesce(s.n, 0) AS days_observed, CAST(datediff('day', m.period, CAST(m.period + INTERVAL 1 MONTH AS DATE)) AS BIGINT) AS days_in_month,
       round(100.0 * coalesce(s.n, 0) / datediff('day', m.period, CAST(m.period + INTERVAL 1 MONTH AS DATE)), 1) AS coverage_pct,
       CAST(s.gap AS BIGINT) AS longest_gap_days, coalesce(e.n, 0) AS first_seen_here, coalesce(s.n, 0) > 0 AS is_measured
FROM m LEFT JOIN s USING (period) LEFT JOIN e USING (period)
""")
def monthly_coverage(spark, sf_dir):
    """Readings and first sightings a month, unread months included."""
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("first_seen"))
    return reports.monthly_coverage(fold.observations(_ledger(spark, sf_dir)), seen)


# --- the register: records made of line items ----------------------------------------------------

_RECORDS = r"""
rec AS (
 SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS record_key, 'Unit ' || CAST(l_suppkey % 40 AS VARCHAR) AS ovd, l_shipdate AS insert_date,
   CASE WHEN l_quantity <= 45 THEN upper(p_brand) END AS brand, CASE WHEN l_quantity <= 30 THEN upper(p_name) END AS model, p_name AS nz_raw,
   CASE WHEN l_linenumber = 7 THEN 'short' || CAST(l_orderkey AS VARCHAR) ELSE '35' || lpad(CAST(l_partkey * 7919 % 1000000 AS VARCHAR), 6, '0') || lpad(CAST(l_orderkey AS VARCHAR), 6, '0') || CASE WHEN l_linenumber <= 4 THEN CAST(l_linenumber AS VARCHAR) WHEN l_linenumber = 5 THEN '' ELSE '-77' END END AS imei_raw,
   l_returnflag <> 'R' AS is_present, CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS disappeared_at
 FROM lineitem JOIN part ON p_partkey = l_partkey),
dig AS (SELECT *, regexp_replace(imei_raw, '[^0-9]', '', 'g') AS d FROM rec),
bas AS (SELECT *, length(d) AS n, CASE WHEN d = '' OR d LIKE '00%' THEN NULL WHEN length(d) IN (15, 17, 18) THEN substr(d, 1, 15) WHEN length(d) IN (14, 16) THEN substr(d, 1, 14) END AS base FROM dig),
luh AS (SELECT *, CASE WHEN base IS NOT NULL THEN (10 - (list_sum(list_transform(range(1, 15), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(base, i, 1) AS INTEGER) ELSE (CAST(substr(base, i, 1) AS INTEGER) * 2) % 10 + (CAST(substr(base, i, 1) AS INTEGER) * 2) // 10 END)) % 10)) % 10 END AS chk FROM bas),
nrm AS (SELECT *, CASE WHEN length(base) = 14 THEN base || CAST(CAST(chk AS INTEGER) AS VARCHAR) ELSE base END AS imei_norm FROM luh),
norm AS (SELECT record_key, ovd, insert_date, brand, brand AS manufacturer, model, nz_raw, imei_raw, is_present, disappeared_at, n AS imei_digits, imei_norm, length(base) = 14 AS imei_was_repaired,
   CASE WHEN imei_norm IS NULL AND n BETWEEN 8 AND 13 THEN 'SERIAL' WHEN imei_norm IS NULL THEN 'INVALID' WHEN n = 16 THEN 'IMEISV' ELSE 'IMEI' END AS imei_kind,
   substr(imei_norm, 1, 8) AS tac, substr(imei_norm, 9, 6) AS snr, substr(imei_norm, 15, 1) AS check_digit, CAST(chk AS INTEGER) = CAST(substr(imei_norm, 15, 1) AS INTEGER) AS imei_luhn_valid FROM nrm)
"""


def _register(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    n = F.col("l_linenumber")
    tail = F.when(n <= 4, n.cast("string")).when(n == 5, "").otherwise("-77")
    imei = F.when(n == 7, F.concat(F.lit("short"), F.col("l_orderkey").cast("string"))).otherwise(F.concat(F.lit("35"), F.lpad((F.col("l_partkey") * 7919 % 1000000).cast("string"), 6, "0"), F.lpad(F.col("l_orderkey").cast("string"), 6, "0"), tail))
    rows = rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("record_key"),
        F.concat(F.lit("Unit "), (F.col("l_suppkey") % 40).cast("string")).alias("ovd"),
        F.col("l_shipdate").alias("insert_date"),
        F.when(F.col("l_quantity") <= 45, F.upper("p_brand")).alias("brand"),
        F.when(F.col("l_quantity") <= 45, F.upper("p_brand")).alias("manufacturer"),
        F.when(F.col("l_quantity") <= 30, F.upper("p_name")).alias("model"),
        F.col("p_name").alias("nz_raw"),
        imei.alias("imei_raw"),
        (F.col("l_returnflag") != "R").alias("is_present"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("date")).alias("disappeared_at"),
    )
    return identifiers.with_parts(rows, "imei_raw")


@query(f"WITH {_RECORDS} SELECT record_key, CAST(imei_digits AS INTEGER) AS imei_digits, imei_norm, imei_was_repaired, imei_kind, tac, snr, check_digit, imei_luhn_valid FROM norm")
def imei_normalise(spark, sf_dir):
    """Identifiers to 15 digits, their kind, parts and checksum."""
    return _register(spark, sf_dir).select("record_key", "imei_digits", "imei_norm", "imei_was_repaired", "imei_kind", "tac", "snr", "check_digit", "imei_luhn_valid")


@query(f"WITH {_RECORDS} SELECT record_key, CASE WHEN length(replace(d, substr(d, 1, 1), '')) > 0 THEN imei_norm END AS imei FROM nrm")
def imei_canonical(spark, sf_dir):
    """Identifiers in their canonical form; those of one repeated digit are refused."""
    return _register(spark, sf_dir).select("record_key", identifiers.canonical(F.col("imei_raw")).alias("imei"))


@query(f"WITH {_RECORDS} SELECT imei_kind, imei_luhn_valid, imei_was_repaired, count(*) AS records FROM norm GROUP BY ALL")
def luhn_validity(spark, sf_dir):
    """Checksums by kind."""
    return _register(spark, sf_dir).groupBy("imei_kind", "imei_luhn_valid", "imei_was_repaired").agg(F.count(F.lit(1)).alias("records"))


@query(f"WITH {_RECORDS} SELECT CAST(date_trunc('year', insert_date) AS DATE) AS period, count(*) AS records, count(brand) AS with_brand FROM norm GROUP BY 1")
def by_year(spark, sf_dir):
    return reports.by_year(_register(spark, sf_dir))


@query(f"WITH {_RECORDS} SELECT brand, count(*) AS records, count(DISTINCT tac) AS tacs, round(100.0 * count(*) FILTER (WHERE imei_luhn_valid) / count(*), 2) AS luhn_pct FROM norm WHERE brand IS NOT NULL GROUP BY 1")
def by_brand(spark, sf_dir):
    return reports.by_brand(_register(spark, sf_dir))


@query(f"WITH {_RECORDS} SELECT ovd, count(*) AS records, CAST(min(insert_date) AS DATE) AS first_record, CAST(max(insert_date) AS DATE) AS last_record FROM norm GROUP BY 1")
def by_unit(spark, sf_dir):
    return reports.by_unit(_register(spark, sf_dir))


@query(f"WITH {_RECORDS} SELECT disappeared_at AS period, count(*) AS closed FROM norm WHERE disappeared_at IS NOT NULL GROUP BY 1")
def closures(spark, sf_dir):
    return reports.closures(_register(spark, sf_dir))


_DICT = r"""
vb AS (SELECT tac, brand, manufacturer, count(*) AS c, sum(count(*)) OVER (PARTITION BY tac) AS tot, row_number() OVER (PARTITION BY tac ORDER BY count(*) DESC, brand, manufacturer) AS rn
       FROM norm WHERE tac IS NOT NULL AND brand IS NOT NULL AND imei_luhn_valid GROUP BY tac, brand, manufacturer),
vm AS (SELECT tac, model, count(*) AS c, sum(count(*)) OVER (PARTITION BY tac) AS tot, row_number() OVER (PARTITION BY tac ORDER BY count(*) DESC, model) AS rn
       FROM norm WHERE tac IS NOT NULL AND model IS NOT NULL AND imei_luhn_valid GROUP BY tac, model),
dic AS (SELECT vb.tac, vb.brand, vb.manufacturer, CASE WHEN vm.c * 1.0 / vm.tot >= 0.8 THEN vm.model END AS model, CAST(vb.tot AS BIGINT) AS records, round(vb.c * 1.0 / vb.tot, 4) AS purity, 'register' AS source
        FROM vb LEFT JOIN vm ON vm.tac = vb.tac AND vm.rn = 1 WHERE vb.rn = 1 AND vb.tot >= 5 AND vb.c * 1.0 / vb.tot >= 0.9)
"""


@query(f"WITH {_RECORDS}, {_DICT} SELECT * FROM dic")
def tac_consensus(spark, sf_dir):
    """Code -> brand and model where records agree."""
    return consensus.build(_register(spark, sf_dir)).drop("release_year")


@query(f"""WITH {_RECORDS}, {_DICT}
SELECT record_key, coalesce(r.brand, d.brand) AS brand, coalesce(r.model, d.model) AS model,
  CASE WHEN r.brand IS NOT NULL THEN 'text' WHEN d.brand IS NOT NULL THEN 'tac:' || d.source END AS brand_source,
  CASE WHEN r.brand IS NULL AND d.brand IS NOT NULL THEN d.purity END AS tac_confidence,
  r.brand IS NOT NULL AND d.brand IS NOT NULL AND r.brand <> d.brand AS brand_conflict,
  (r.brand IS NULL OR r.model IS NULL) AND d.tac IS NOT NULL AND coalesce(r.imei_luhn_valid, false) = false AS tac_from_invalid_imei
FROM norm r LEFT JOIN dic d ON d.tac = r.tac""")
def tac_fill_provenance(spark, sf_dir):
    """Records filled from the consensus dictionary, with where each value came from."""
    records = _register(spark, sf_dir)
    return consensus.fill(records, consensus.build(records)).select("record_key", "brand", "model", "brand_source", "tac_confidence", "brand_conflict", "tac_from_invalid_imei")


@query(f"""WITH {_RECORDS}
SELECT 'records_total' AS metric, count(*) AS value FROM norm UNION ALL SELECT 'records_present', count(*) FILTER (WHERE is_present) FROM norm
UNION ALL SELECT 'records_disappeared', count(disappeared_at) FROM norm UNION ALL SELECT 'brand_resolved', count(brand) FROM norm
UNION ALL SELECT 'model_resolved', count(model) FROM norm UNION ALL SELECT 'homoglyph_fixed', count(*) FILTER (WHERE nz_raw LIKE 'r%') FROM norm
UNION ALL SELECT 'imei_usable', count(imei_norm) FROM norm UNION ALL SELECT 'imei_luhn_valid', count(*) FILTER (WHERE imei_luhn_valid) FROM norm
UNION ALL SELECT 'imei_repaired', count(*) FILTER (WHERE imei_was_repaired) FROM norm UNION ALL SELECT 'imei_invalid', count(*) FILTER (WHERE imei_kind = 'INVALID') FROM norm
UNION ALL SELECT 'insert_date_implausible', count(*) FILTER (WHERE insert_date < TIMESTAMP '1998-01-01') FROM norm UNION ALL SELECT 'distinct_tac', count(DISTINCT tac) FROM norm
UNION ALL SELECT 'distinct_brand', count(DISTINCT brand) FROM norm UNION ALL SELECT 'distinct_nz_raw', count(DISTINCT nz_raw) FROM norm""")
def quality_metrics(spark, sf_dir):
    """Fourteen metrics, eleven of them from one aggregation."""
    flags = {"homoglyph_fixed": F.startswith("nz_raw", F.lit("r")), "insert_date_implausible": F.col("insert_date") < F.lit("1998-01-01").cast("timestamp_ntz")}
    return reports.quality_metrics(_register(spark, sf_dir).withColumns(flags))


_FLAGS = ", nz_raw AS nz_clean, CASE WHEN brand IS NULL THEN 'none' ELSE 'exact' END AS nz_method, nz_raw LIKE 'r%' AS homoglyph_fixed, coalesce(brand IS NOT NULL AND model IS NULL AND ovd LIKE '%7', false) AS brand_conflict, insert_date < TIMESTAMP '1998-01-01' AS insert_date_implausible, strftime(insert_date, '%Y-%m-%d') AS insert_date_raw, CASE WHEN ovd LIKE '%1' THEN NULL ELSE ovd END AS region"


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _register(spark, sf_dir).withColumns(
        {
            "nz_clean": F.col("nz_raw"),
            "nz_method": F.when(F.col("brand").isNull(), "none").otherwise("exact"),
            "homoglyph_fixed": F.startswith("nz_raw", F.lit("r")),
            "brand_conflict": F.col("brand").isNotNull() & F.col("model").isNull() & F.endswith("ovd", F.lit("7")),
            "insert_date_implausible": F.col("insert_date") < F.lit("1998-01-01").cast("timestamp_ntz"),
            "insert_date_raw": F.date_format("insert_date", "yyyy-MM-dd"),
            "region": F.when(~F.endswith("ovd", F.lit("1")), F.col("ovd")),
        }
    )


@query(f"""WITH {_RECORDS}, f AS (SELECT *{_FLAGS} FROM norm)
SELECT record_key, 'nz' AS field, nz_raw AS raw_value, 'brand_unresolved' AS issue FROM f WHERE brand IS NULL AND nz_method <> 'empty'
UNION ALL SELECT record_key, 'nz', nz_raw, 'script_mixed' FROM f WHERE homoglyph_fixed AND brand IS NULL
UNION ALL SELECT record_key, 'brand', nz_raw, 'conflicts_with_tac' FROM f WHERE brand_conflict
UNION ALL SELECT record_key, 'imei', imei_raw, 'imei_unusable' FROM f WHERE imei_norm IS NULL
UNION ALL SELECT record_key, 'imei', imei_raw, 'imei_checksum_failed' FROM f WHERE imei_norm IS NOT NULL AND NOT imei_luhn_valid
UNION ALL SELECT record_key, 'insert_date', insert_date_raw, 'date_implausible' FROM f WHERE insert_date_implausible
UNION ALL SELECT record_key, 'model', nz_raw, 'model_missing' FROM f WHERE brand IS NOT NULL AND model IS NULL
UNION ALL SELECT record_key, 'ovd', ovd, 'region_unknown' FROM f WHERE region IS NULL AND trim(ovd) <> ''""")
def issue_log(spark, sf_dir):
    """Eight kinds of issues from one scan."""
    return normalise.issues(_flagged(spark, sf_dir))


@query(f"""WITH {_RECORDS}, f AS (SELECT *{_FLAGS}, coalesce(brand, '') || CASE WHEN model IS NULL THEN '' ELSE ' ' || model END AS named FROM norm)
SELECT record_key, 'nz' AS field, nz_raw AS value_before, named AS value_after, nz_method AS reason FROM f WHERE brand IS NOT NULL AND upper(trim(nz_raw)) <> named
UNION ALL SELECT record_key, 'imei', imei_raw, imei_norm, CASE WHEN imei_was_repaired THEN 'check_digit_restored' ELSE 'reformatted' END FROM f WHERE imei_norm IS NOT NULL AND imei_raw <> imei_norm
UNION ALL SELECT record_key, 'imei', imei_raw, NULL, 'unusable_' || lower(imei_kind) FROM f WHERE imei_norm IS NULL
UNION ALL SELECT record_key, 'insert_date', insert_date_raw, NULL, 'implausible_date_nulled' FROM f WHERE insert_date_implausible""")
def change_log(spark, sf_dir):
    """What was rewritten, and why, from one scan."""
    return normalise.changes(_flagged(spark, sf_dir))


@query(f"WITH {_RECORDS} SELECT nz_raw, nz_raw AS nz_clean, count(*) AS records FROM norm WHERE brand IS NULL GROUP BY 1 ORDER BY records DESC, nz_raw LIMIT 20")
def top_unmatched(spark, sf_dir):
    """The twenty most frequent spellings without a brand."""
    return reports.unmatched(_flagged(spark, sf_dir), 20)


@query(f"""WITH {_RECORDS}, n AS (SELECT tac, count(*) AS c FROM norm WHERE tac IS NOT NULL GROUP BY 1),
w AS (SELECT c, sum(c) OVER (ORDER BY c DESC) * 1.0 / sum(c) OVER () AS share, row_number() OVER (ORDER BY c DESC, tac) AS rn FROM n)
SELECT count(*) AS tacs, max(rn) FILTER (WHERE share <= 0.5) AS tacs_50, max(rn) FILTER (WHERE share <= 0.8) AS tacs_80, max(rn) FILTER (WHERE share <= 0.95) AS tacs_95 FROM w""")
def tac_concentration(spark, sf_dir):
    """How many codes cover half, four fifths and 95 % of the records.

    Codes are grouped by their count first, so the ordered pass sees one row for
    each distinct count, not one for each code.
    """
    n = _register(spark, sf_dir).where("tac is not null").groupBy("tac").agg(F.count(F.lit(1)).alias("c"))
    levels = n.groupBy("c").agg(F.count(F.lit(1)).alias("k"))
    w = Window.orderBy(F.desc("c"))
    levels = levels.withColumns({"rows": F.sum(F.col("c") * F.col("k")).over(w), "codes": F.sum("k").over(w), "all": F.sum(F.col("c") * F.col("k")).over(Window.partitionBy(F.lit(1)))})
    share = F.col("rows").cast("double") / F.col("all")
    return levels.agg(F.sum("k").alias("tacs"), *[F.max(F.when(share <= s, F.col("codes"))).alias(f"tacs_{int(s * 100)}") for s in (0.5, 0.8, 0.95)])


_FIELDS = {
    "record_key": {"nullable": False, "severity": "critical"},
    "imei_norm": {"length": 15, "regex": "^[0-9]{15}$", "min_fill_rate": 0.8},
    "imei_kind": {"nullable": False, "allowed_values": ["IMEI", "IMEISV"], "severity": "critical"},
    "brand": {"min_fill_rate": 0.95},
    "imei_luhn_valid": {"min_true_share": 0.5, "max_true_share": 0.9},
    "disappeared_at": {"min_value": "1996-01-01", "max_value": "2001-01-01", "type": "date"},
}


@query(f"""WITH {_RECORDS}
SELECT 'record_key' AS field, 'not_null' AS "check", count(*) FILTER (WHERE record_key IS NULL) AS bad, count(*) AS considered FROM norm
UNION ALL SELECT 'imei_norm', 'length', count(*) FILTER (WHERE length(imei_norm) <> 15), count(*) FROM norm
UNION ALL SELECT 'imei_norm', 'regex', count(*) FILTER (WHERE NOT regexp_matches(imei_norm, '^[0-9]{{15}}$')), count(*) FROM norm
UNION ALL SELECT 'imei_norm', 'fill_rate', count(*) FILTER (WHERE imei_norm IS NULL), count(*) FROM norm
UNION ALL SELECT 'imei_kind', 'not_null', count(*) FILTER (WHERE imei_kind IS NULL), count(*) FROM norm
UNION ALL SELECT 'imei_kind', 'allowed_values', count(*) FILTER (WHERE imei_kind NOT IN ('IMEI', 'IMEISV')), count(*) FROM norm
UNION ALL SELECT 'brand', 'fill_rate', count(*) FILTER (WHERE brand IS NULL), count(*) FROM norm
UNION ALL SELECT 'imei_luhn_valid', 'true_share', count(*) FILTER (WHERE NOT imei_luhn_valid), count(imei_luhn_valid) FROM norm
UNION ALL SELECT 'imei_luhn_valid', 'true_share_max', count(*) FILTER (WHERE imei_luhn_valid), count(*) FROM norm
UNION ALL SELECT 'disappeared_at', 'range', count(*) FILTER (WHERE disappeared_at < DATE '1996-01-01' OR disappeared_at > DATE '2001-01-01'), count(*) FROM norm""")
def dq_field_checks(spark, sf_dir):
    """All declared field checks in one aggregation."""
    _, found = quality.measure(_register(spark, sf_dir), _FIELDS, date(2024, 1, 1))
    return spark.createDataFrame([(c.field, c.name, bad, of) for c, bad, of in found], 'field string, `check` string, bad bigint, considered bigint')


_ASSERTIONS = {
    "usable_is_15_digits": "SELECT count(*) FROM records_normalized WHERE imei_norm IS NOT NULL AND length(imei_norm) <> 15",
    "tac_is_prefix": "SELECT count(*) FROM records_normalized WHERE imei_norm IS NOT NULL AND tac <> substr(imei_norm, 1, 8)",
    "parts_reassemble": "SELECT count(*) FROM records_normalized WHERE imei_norm IS NOT NULL AND tac || snr || check_digit <> imei_norm",
    "present_not_closed": "SELECT count(*) FROM records_normalized WHERE is_present AND disappeared_at IS NOT NULL",
    "closed_has_date": "SELECT count(*) FROM records_normalized WHERE NOT is_present AND disappeared_at IS NULL",
    "record_key_unique": "SELECT count(*) FROM (SELECT record_key FROM records_normalized GROUP BY 1 HAVING count(*) > 1)",
    "one_brand_per_tac": "SELECT count(*) FROM (SELECT tac FROM records_normalized WHERE tac IS NOT NULL GROUP BY 1 HAVING count(DISTINCT brand) > 1)",
    "model_without_brand": "SELECT count(*) FROM records_normalized WHERE model IS NOT NULL AND brand IS NULL",
}


@query(f"WITH {_RECORDS}, records_normalized AS (SELECT * FROM norm) " + " UNION ALL ".join(f"SELECT '{n}' AS name, ({q}) AS bad" for n, q in _ASSERTIONS.items()))
def dq_assertions(spark, sf_dir):
    """Cross-field and uniqueness assertions."""
    config = {"table": "records_normalized", "assertions": [{"name": n, "sql": q} for n, q in _ASSERTIONS.items()]}
    report = quality.run(_register(spark, sf_dir), config, date(2024, 1, 1))
    return spark.createDataFrame([(r.check, r.bad) for r in report.results if r.field == "_assertion_"], "name string, bad bigint")


# --- joins ---------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_lines(spark, sf_dir):
    """Anti join."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS k FROM customer), n AS (SELECT CASE WHEN n_nationkey <> 3 THEN n_nationkey END AS k, n_name FROM nation)
SELECT c_custkey, n_name FROM c LEFT JOIN n ON c.k IS NOT DISTINCT FROM n.k""")
def null_safe_join(spark, sf_dir):
    """Left join in which nulls meet nulls."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("k"))
    n = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") != 3, F.col("n_nationkey")).alias("nk"), "n_name")
    return c.join(n, F.col("k").eqNullSafe(F.col("nk")), "left").select("c_custkey", "n_name")


@query("""
WITH a AS (SELECT o_orderkey AS k, o_custkey, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 3 <> 1)
SELECT a.k, a.s AS before, b.s AS after FROM a JOIN b ON a.k = b.k WHERE a.s <> b.s""")
def changed_rows(spark, sf_dir):
    """Equal keys, different content."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    a = o.where("k % 3 <> 0").select("k", F.col("s").alias("before"))
    b = o.where("k % 3 <> 1").select("k", F.when(F.col("k") % 5 == 0, "X").otherwise(F.col("s")).alias("after"))
    return a.join(b, "k").where("before <> after")


@query("""
WITH h AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS v FROM customer WHERE c_custkey % 2 = 0),
m AS (SELECT DISTINCT c_custkey - c_custkey % 3 AS k, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS v FROM customer)
SELECT * FROM h UNION ALL SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.k IS NOT DISTINCT FROM m.k AND h.v IS NOT DISTINCT FROM m.v)""")
def insert_if_absent(spark, sf_dir):
    """Insert what is not there, nulls equal."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("v"))
    held = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), "v")
    more = c.select((F.col("c_custkey") - F.col("c_custkey") % 3).alias("k"), "v")
    return stage.insert_if_absent(held, more, ["k", "v"])


@query("""
WITH e AS (SELECT lpad(CAST(c_custkey % 300 AS VARCHAR), 8, '0') AS tac, min('BRAND ' || CAST(c_nationkey AS VARCHAR)) AS brand,
  min(nullif(trim(upper(trim(split_part(c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) || ', ' || c_name, ',', 1)))), '')) AS model FROM customer GROUP BY 1),
d AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS tac, upper(s_name) AS brand, CASE WHEN s_suppkey % 2 = 0 THEN 'M' || CAST(s_nationkey AS VARCHAR) END AS model FROM supplier)
SELECT d.tac, d.brand, coalesce(d.model, e.model) AS model, 'register' AS source FROM d LEFT JOIN e USING (tac)
UNION ALL SELECT e.tac, e.brand, e.model, 'outside' FROM e WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.tac = e.tac)""")
def external_merge_anti(spark, sf_dir):
    """An outside list fills gaps and adds only codes that are missing."""
    raw = table(spark, sf_dir, "customer").select(F.concat(F.lit("Brand "), F.col("c_nationkey").cast("string")).alias("Brand"), (F.col("c_custkey") % 300).cast("string").alias("TAC"), F.concat("c_mktsegment", F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(", "), "c_name").alias("SPECS"))
    own = table(spark, sf_dir, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("tac"), F.upper("s_name").alias("brand"), F.upper("s_name").alias("manufacturer"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("M"), F.col("s_nationkey").cast("string"))).alias("model"), F.lit(None).cast("int").alias("release_year"), F.lit(1).cast("bigint").alias("records"), F.lit(1.0).alias("purity"), F.lit("register").alias("source"))
    entries = consensus.external_entries(raw)
    nobody = spark.createDataFrame([], "nz_raw string, brand string, manufacturer string")
    return consensus.merge_external(own, entries, nobody, "outside").select("tac", "brand", "model", "source")


@query("""
WITH l(brand, w) AS (VALUES ('BRAND#1', 'SMALL'), ('BRAND#1', 'RED'), ('BRAND#2', 'SMALL'), ('BRAND#2', 'SMALL RING'), ('BRAND#3', 'HOT'), ('BRAND#4', 'BLUE')),
p AS (SELECT p_partkey, upper(p_brand) AS b, CASE WHEN p_size % 3 = 0 THEN upper(p_brand) || ' ' ELSE '' END || upper(p_name) AS model FROM part),
s AS (SELECT *, trim(CASE WHEN starts_with(model, b || ' ') THEN substr(model, length(b) + 1) ELSE model END) AS m FROM p),
f AS (SELECT s.*, (SELECT max(l.w) FROM l WHERE l.brand = s.b AND (s.m = l.w OR starts_with(s.m, l.w || ' '))) AS w FROM s)
SELECT p_partkey, model, nullif(CASE WHEN w IS NULL THEN m ELSE trim(substr(m, length(w) + 1)) END, '') AS model_key FROM f""")
def model_line_strip(spark, sf_dir):
    """Models without their brand and one leading line word."""
    lines = spark.createDataFrame([("BRAND#1", "SMALL"), ("BRAND#1", "RED"), ("BRAND#2", "SMALL"), ("BRAND#2", "SMALL RING"), ("BRAND#3", "HOT"), ("BRAND#4", "BLUE")], "brand string, line_word string")
    p = table(spark, sf_dir, "part").select("p_partkey", F.upper("p_brand").alias("brand"), F.concat(F.when(F.col("p_size") % 3 == 0, F.concat(F.upper("p_brand"), F.lit(" "))).otherwise(""), F.upper("p_name")).alias("model"))
    return consensus.model_key(p, lines).select("p_partkey", "model", "model_key")


_ENTRIES = ["SMALL", "SMALL RING", "RED WIDGET", "RED", "BLUE", "HOT GEAR 1", "LARGE", "OLD BO", "WIDGE", "GIZMO"]
_ENTRY_SQL = "e(entry) AS (VALUES " + ", ".join(f"('{e}')" for e in _ENTRIES) + ")"


def _entries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e,) for e in _ENTRIES], "entry string")


@query(f"""WITH {_ENTRY_SQL}, q AS (SELECT p_partkey, upper(p_name) || ' ' || CAST(p_size AS VARCHAR) AS q FROM part),
m AS (SELECT p_partkey, entry, length(entry) - length(replace(entry, ' ', '')) + 1 AS n FROM q JOIN e ON q = entry OR starts_with(q, entry || ' '))
SELECT p_partkey, arg_max(entry, n) AS entry, CAST(max(n) AS INTEGER) AS tokens FROM m WHERE n <= 3 GROUP BY 1""")
def longest_prefix_match(spark, sf_dir):
    """The dictionary entry that equals the most leading words."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.upper("p_name"), F.lit(" "), F.col("p_size").cast("string")).alias("q"))
    return match.longest_token_prefix(rows, "p_partkey", "q", _entries(spark), "entry")


@query(f"""WITH {_ENTRY_SQL}, q AS (SELECT p_partkey, replace(upper(p_name), ' ', '') || CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS q FROM part),
m AS (SELECT p_partkey, entry, trim(substr(q, length(entry) + 1), '-_ ') AS tail FROM q JOIN e ON starts_with(q, entry) AND length(q) > length(entry))
SELECT p_partkey, arg_max(entry, length(entry)) AS entry, arg_max(tail, length(entry)) AS tail FROM m
WHERE tail <> '' AND (NOT regexp_matches(tail, '^[A-Z]+$') OR length(entry) >= 5) GROUP BY 1""")
def glued_prefix_match(spark, sf_dir):
    """The longest entry that a run-together word starts with."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.replace(F.upper("p_name"), F.lit(" "), F.lit("")), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("")).alias("q"))
    return match.longest_string_prefix(rows, "p_partkey", "q", _entries(spark), "entry")


_TYPO = "CASE WHEN length(w) < 4 THEN w WHEN p_size % 3 = 0 THEN substr(w, 1, 1) || substr(w, 3, 1) || substr(w, 2, 1) || substr(w, 4) WHEN p_size % 3 = 1 THEN substr(w, 1, length(w) - 1) ELSE w || 'X' END"


def _typos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_size", F.explode(F.split(F.upper("p_name"), " ")).alias("w"))
    return rows.selectExpr(f"{_TYPO} as typo").distinct()


@query(f"""WITH {_ENTRY_SQL}, t AS (SELECT DISTINCT {_TYPO} AS typo FROM (SELECT p_size, unnest(string_split(upper(p_name), ' ')) AS w FROM part))
SELECT typo, entry, CAST(damerau_levenshtein(typo, entry) AS INTEGER) AS distance FROM t JOIN e ON abs(length(typo) - length(entry)) <= CASE WHEN length(typo) <= 6 THEN 1 ELSE 2 END
WHERE damerau_levenshtein(typo, entry) <= CASE WHEN length(typo) <= 6 THEN 1 ELSE 2 END""")
def fuzzy_match_osa(spark, sf_dir):
    """Distinct misspelt words against the dictionary, within one or two edits."""
    return match.within_edits(_typos(spark, sf_dir), "typo", "typo", _entries(spark), "entry", match.budget(F.length("typo")))


@query(f"""WITH {_ENTRY_SQL}, t AS (SELECT DISTINCT {_TYPO} AS typo FROM (SELECT p_size, unnest(string_split(upper(p_name), ' ')) AS w FROM part)),
s AS (SELECT typo, entry, 1.0::DOUBLE - damerau_levenshtein(typo, entry)::DOUBLE / greatest(length(typo), length(entry)) AS s FROM t JOIN e ON abs(length(typo) - length(entry)) <= 3)
SELECT typo AS query, entry, round(s, 3) AS similarity, CAST(row_number() OVER (PARTITION BY typo ORDER BY round(s, 3) DESC, entry) AS INTEGER) AS position FROM s WHERE s >= 0.6 QUALIFY position <= 3""")
def nearest_topk(spark, sf_dir):
    """The three nearest entries of each misspelt word (a top-k report)."""
    return match.nearest(_typos(spark, sf_dir), "typo", _entries(spark), "entry", limit=3, least=0.6)


_ALIASES = [("BRAND#1", "One", "One Ltd"), ("BRAND#2", "Two", "Two Ltd"), ("BRAND#12", "Twelve", "Two Ltd"), ("GALAXY", "Star", "Star Co"), ("GALAXY TAB", "StarTab", "Star Co")]


@query()
def resolve_spellings(spark, sf_dir):
    """Distinct free-text spellings to brand, model and method (tested against a direct version of the rules)."""
    aliases = spark.createDataFrame(_ALIASES, "alias string, brand string, manufacturer string")
    p = table(spark, sf_dir, "part")
    nz = F.when(F.col("p_size") % 5 == 0, F.concat_ws(" ", "p_brand", "p_name")).when(F.col("p_size") % 5 == 1, F.concat(F.lit("galaxy tab "), F.col("p_name"))).when(F.col("p_size") % 5 == 2, F.concat(F.lit("galaxy"), F.col("p_size").cast("string"))).when(F.col("p_size") % 5 == 3, F.concat(F.lit("glaaxy "), F.col("p_name"))).otherwise(F.col("p_name"))
    return match.resolve(p.select(nz.alias("nz_raw")), aliases)


@query("""
WITH m(stem, i) AS (VALUES ('blog.', 1), ('m.', 2), ('example.com', 3), ('example.net', 4), ('/en/', 5), ('/fr/', 6))
SELECT page_id, (SELECT arg_max(stem, length(stem) * 100 - i) FROM m WHERE contains(url, stem)) AS stem FROM pages""")
def contains_longest_stem(spark, sf_dir):
    """The longest of some stems that a text contains, as one conditional expression."""
    stems = {s: s for s in ("blog.", "m.", "example.com", "example.net", "/en/", "/fr/")}
    return table(spark, sf_dir, "pages").select("page_id", places.longest_contained(F.col("url"), stems).alias("stem"))


_UNITS = "CASE s_suppkey % 27 WHEN 24 THEN 'м. Київ' WHEN 25 THEN NULL WHEN 26 THEN 'м. Севастополь' ELSE list_extract([" + ", ".join(f"'{r} область'" for r in places.REGIONS) + "], CAST(s_suppkey % 27 AS INTEGER) + 1) END"


@query(f"SELECT s_suppkey, {_UNITS} AS region FROM supplier")
def unit_regions(spark, sf_dir):
    """The regions that free-text names of units stand for: special marks, then the longest stem."""
    k = (F.col("s_suppkey") % 27).cast("int")
    stems = F.array(*[F.lit(stem.lower() + "ької області") for stem, _ in places.stems()])
    name = F.when(k == 24, "ГУ у м. КИЄВІ").when(k == 25, "Departament").when(k == 26, "відділ у м. Севастополі").otherwise(F.concat(F.lit("ГУ у "), F.get(stems, k)))
    return table(spark, sf_dir, "supplier").select("s_suppkey", places.region_by_marks_and_stems(name).alias("region"))


@query("SELECT range AS i, range * range AS square FROM range(1000)")
def generated_range(spark, sf_dir):
    """A generated range of numbers."""
    return spark.range(1000).select(F.col("id").alias("i"), (F.col("id") * F.col("id")).alias("square"))


@query("SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 1000.0 GROUP BY 1")
def bound_parameters(spark, sf_dir):
    """A statement with bound parameters."""
    return spark.sql("SELECT o_orderpriority, count(*) AS orders FROM {o} WHERE o_orderstatus = :status AND o_totalprice > :least GROUP BY 1", args={"status": "O", "least": 1000.0}, o=table(spark, sf_dir, "orders"))


# --- text ----------------------------------------------------------------------------------------

_MIX = "translate(upper(p_name) || ' ' || p_brand, 'AEO', CASE WHEN p_partkey % 3 = 0 THEN 'АЕО' WHEN p_partkey % 3 = 1 THEN 'АEО' ELSE 'AEO' END)"


@query(f"""WITH p AS (SELECT p_partkey, {_MIX} AS t FROM part),
w AS (SELECT p_partkey, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS i FROM p),
c AS (SELECT *, length(regexp_replace(w, '[^A-Za-z]', '', 'g')) AS l, length(regexp_replace(w, '[^Ѐ-ӿ]', '', 'g')) AS c FROM w)
SELECT p_partkey, string_agg(CASE WHEN c > 0 AND l > c THEN translate(w, 'АЕО', 'AEO') ELSE w END, ' ' ORDER BY i) AS repaired, bool_or(c > 0 AND l > 0) AS mixed FROM c GROUP BY 1""")
def homoglyph_repair(spark, sf_dir):
    """Look-alikes repaired in words that are mostly Latin."""
    p = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_MIX} as t")
    return p.select("p_partkey", text.defuse_homoglyphs(F.col("t")).alias("repaired"), text.script_mixed(F.col("t")).alias("mixed"))


@query(f"""WITH w AS (SELECT unnest(string_split({_MIX}, ' ')) AS w FROM part),
c AS (SELECT length(regexp_replace(w, '[^A-Za-z]', '', 'g')) > 0 AS l, length(regexp_replace(w, '[^Ѐ-ӿ]', '', 'g')) > 0 AS c FROM w)
SELECT CASE WHEN l AND c THEN 'mixed' WHEN l THEN 'latin' WHEN c THEN 'cyrillic' ELSE 'none' END AS script, count(*) AS words FROM c GROUP BY 1""")
def script_profile(spark, sf_dir):
    """Words by alphabet."""
    w = table(spark, sf_dir, "part").select(F.explode(F.split(F.expr(_MIX), " ")).alias("w"))
    return w.groupBy(text.script_of(F.col("w")).alias("script")).agg(F.count(F.lit(1)).alias("words"))


@query(r"""SELECT conv_id, turn, md5(upper(trim(regexp_replace(regexp_replace(replace(coalesce(text, ''), 'ß', 'SS'), '["''«»`()\[\]{}]', ' ', 'g'), '[\s/,;+\-_.]+', ' ', 'g')))) AS clean_md5 FROM conversations""")
def clean_text(spark, sf_dir):
    """Noise and separators removed, upper case."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(text.clean(F.col("text")).cast("binary")).alias("clean_md5"))


_DATE = "CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '' WHEN 2 THEN 'soon' WHEN 3 THEN '02' || substr(strftime(o_orderdate, '%Y-%m-%d'), 3, 2) || substr(strftime(o_orderdate, '%Y-%m-%d'), 5) WHEN 4 THEN NULL ELSE '2' || strftime(o_orderdate, '%d') || '7-01-05T10:00:00' END"


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 6
    t = F.when(k == 0, iso).when(k == 1, "").when(k == 2, "soon").when(k == 3, F.concat(F.lit("02"), F.substring(iso, 3, 2), F.substring(iso, 5, 20))).when(k == 5, F.concat(F.lit("2"), F.date_format("o_orderdate", "dd"), F.lit("7-01-05T10:00:00")))
    return table(spark, sf_dir, "orders").select("o_orderkey", t.alias("t"))


@query(f"""WITH o AS (SELECT o_orderkey, {_DATE} AS t FROM orders), c AS (SELECT *, CASE WHEN regexp_matches(t, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ].*)?$') THEN try_cast(t AS TIMESTAMP) END AS v FROM o)
SELECT o_orderkey, CASE WHEN v BETWEEN TIMESTAMP '2004-01-01' AND TIMESTAMP '2024-01-02' THEN v END AS plausible, t IS NOT NULL AND NOT (v BETWEEN TIMESTAMP '2004-01-01' AND TIMESTAMP '2024-01-02') AS implausible FROM c""")
def date_plausibility(spark, sf_dir):
    """Dates outside the possible become null; the flag is three-valued."""
    as_of = date(2024, 1, 1)
    return _dated(spark, sf_dir).select("o_orderkey", dates.plausible(F.col("t"), as_of).alias("plausible"), dates.implausible(F.col("t"), as_of).alias("implausible"))


@query(f"""WITH o AS (SELECT o_orderkey, {_DATE} AS t FROM orders),
y AS (SELECT *, regexp_extract(trim(t), '^([0-9]{{4}})-[0-9]{{2}}-[0-9]{{2}}([T ].*)?$', 1) AS y FROM o),
s AS (SELECT *, substr(y, 2, 1) || substr(y, 1, 1) || substr(y, 3) AS s FROM y),
v AS (SELECT *, CASE WHEN trim(coalesce(t, '')) = '' THEN 'empty' WHEN y = '' THEN 'unparsable' WHEN try_cast(y AS INTEGER) BETWEEN 2004 AND 2024 THEN 'ok' WHEN try_cast(s AS INTEGER) BETWEEN 2004 AND 2024 THEN 'repaired' ELSE 'implausible' END AS verdict FROM s)
SELECT o_orderkey, CASE verdict WHEN 'ok' THEN t WHEN 'repaired' THEN s || substr(trim(t), 5) END AS value, verdict FROM v""")
def date_repair(spark, sf_dir):
    """Swapped digits of the year put right where that has one reading."""
    return _dated(spark, sf_dir).select("o_orderkey", dates.repair(F.col("t"), 2024).alias("r")).select("o_orderkey", "r.value", "r.verdict")


@query(r"""
WITH d AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CASE c_custkey % 4 WHEN 0 THEN lpad(CAST(c_custkey * 7919 AS VARCHAR), 10, '3') WHEN 1 THEN '*' WHEN 2 THEN lpad(CAST(c_custkey AS VARCHAR), 15, '4') END AS dtl, CASE WHEN c_custkey % 10 = 0 THEN c_name END AS nomer FROM customer)
SELECT id AS record_key, 'dtl' AS field, dtl AS value FROM d WHERE regexp_matches(dtl, '^[0-9]{9,13}$') UNION ALL SELECT id, 'nomer', nomer FROM d WHERE nomer IS NOT NULL""")
def pii_quarantine(spark, sf_dir):
    """Personal values leave a snapshot before anything else is stored."""
    k = F.col("c_custkey")
    dtl = F.when(k % 4 == 0, F.lpad((k * 7919).cast("string"), 10, "3")).when(k % 4 == 1, "*").when(k % 4 == 2, F.lpad(k.cast("string"), 15, "4"))
    raw = table(spark, sf_dir, "customer").select(k.cast("string").alias("ID"), dtl.alias("DTL"), F.when(k % 10 == 0, F.col("c_name")).alias("NOMER"))
    return stage.quarantine(raw)


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_keys(props)[1] AS first_key, '{"k":"' || json_extract_string(props, '$.k') || '","u":"' || CAST(user_id AS VARCHAR) || '"}' AS packed FROM events""")
def json_repack(spark, sf_dir):
    """JSON members read, listed and packed again."""
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", F.element_at(m, "k").cast("int").alias("k"), F.json_object_keys("props")[0].alias("first_key"), F.to_json(F.struct(F.element_at(m, "k").alias("k"), F.col("user_id").cast("string").alias("u"))).alias("packed"))


@query("SELECT vec_id, i, CAST(round(v::DOUBLE * 2, 4) AS DOUBLE) AS doubled FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) WHERE v > 0")
def nested_transform(spark, sf_dir):
    """A list transformed, unnested and filtered."""
    pairs = F.transform("embedding", lambda x, i: F.struct((i + 1).cast("bigint").alias("i"), F.round(x.cast("double") * 2, 4).alias("doubled"), (x > 0).alias("keep")))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.explode(pairs).alias("p")).where("p.keep").select("vec_id", "p.i", "p.doubled")


# --- profiles, ledgers, revisions ----------------------------------------------------------------


@query("""SELECT round(avg(CASE WHEN text IS NULL OR trim(text) = '' THEN 1.0 ELSE 0.0 END), 6) AS text_empty, round(avg(CASE WHEN lang = 'en' THEN 0.0 ELSE 1.0 END), 6) AS not_english,
round(avg(CASE WHEN n_chars < 100 THEN 1.0 ELSE 0.0 END), 6) AS short FROM documents""")
def null_rate_profile(spark, sf_dir):
    """Shares of empty and odd values in one pass."""
    share = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    d = table(spark, sf_dir, "documents")
    return d.agg(share(F.col("text").isNull() | (F.trim("text") == "")).alias("text_empty"), share(~F.col("lang").eqNullSafe("en")).alias("not_english"), share(F.col("n_chars") < 100).alias("short"))


@query("SELECT CAST(length(imei) AS INTEGER) AS length, count(*) AS records FROM (SELECT regexp_replace(text, '[^0-9]', '', 'g') AS imei FROM documents) GROUP BY 1")
def length_histogram(spark, sf_dir):
    """How many digits texts hold."""
    return table(spark, sf_dir, "documents").groupBy(F.length(F.regexp_replace("text", "[^0-9]", "")).alias("length")).agg(F.count(F.lit(1)).alias("records"))


@query("SELECT upper(p_brand) AS brand, count(DISTINCT p_name) AS spellings, count(DISTINCT split_part(p_name, ' ', 1)) AS heads FROM part GROUP BY 1 HAVING count(DISTINCT p_name) > 1")
def spelling_variants(spark, sf_dir):
    """Distinct spellings of each brand."""
    return table(spark, sf_dir, "part").groupBy(F.upper("p_brand").alias("brand")).agg(F.count_distinct("p_name").alias("spellings"), F.count_distinct(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("heads")).where("spellings > 1")


@query("""
WITH s AS (SELECT *, CASE o_orderkey % 10 WHEN 0 THEN 'duplicate' WHEN 1 THEN 'skipped' WHEN 2 THEN 'failed' WHEN 3 THEN NULL ELSE 'folded' END AS status, CAST(floor(o_totalprice) AS BIGINT) AS bytes FROM orders)
SELECT count(*) AS revisions, count(*) FILTER (WHERE coalesce(status, 'folded') = 'folded') AS folded, count(*) FILTER (WHERE status = 'duplicate') AS duplicate, count(*) FILTER (WHERE status = 'skipped') AS skipped,
 count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(bytes) AS BIGINT) AS bytes_published, CAST(sum(bytes) FILTER (WHERE coalesce(status, 'folded') = 'folded') AS BIGINT) AS bytes_downloaded,
 CAST(sum(bytes) FILTER (WHERE status = 'duplicate') AS BIGINT) AS bytes_not_fetched, CAST(sum(o_custkey) AS BIGINT) AS rows_read, CAST(sum(o_custkey % 7) AS BIGINT) AS rows_dropped_dupe_id, CAST(sum(o_orderkey % 2) AS BIGINT) AS rows_repaired,
 count(*) FILTER (WHERE o_orderkey % 2 = 1) AS files_repaired, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date FROM s""")
def volume_summary(spark, sf_dir):
    """What was published, fetched and dropped, in one pass over a ledger."""
    k = F.col("o_orderkey")
    status = F.when(k % 10 == 0, "duplicate").when(k % 10 == 1, "skipped").when(k % 10 == 2, "failed").when(k % 10 > 3, "folded")
    ledger = table(spark, sf_dir, "orders").select(status.alias("status"), F.floor("o_totalprice").cast("bigint").alias("bytes"), F.col("o_custkey").alias("rows_raw"), (F.col("o_custkey") % 7).alias("rows_dupe_id"), (k % 2).alias("rows_repaired"), F.when(k % 2 == 1, "repaired").otherwise("json").alias("read_mode"), F.col("o_orderdate").cast("date").alias("snapshot_date"))
    return reports.volume(ledger)


_LISTING = "SELECT CASE WHEN user_id % 2 = 0 THEN 'mvs' ELSE 'npu' END AS source, strftime(ts, '%Y-%m-%dT%H:%M:%S') || lpad(CAST(event_id AS VARCHAR), 8, '0') AS created, CAST(floor(value * 100) AS BIGINT) AS size, 'http://x/' || CAST(event_id AS VARCHAR) AS url FROM events WHERE event_type = 'error'"
_BEST = f"""l AS ({_LISTING}), d AS (SELECT *, substr(created, 1, 10) AS snapshot_date, max(size) OVER (PARTITION BY source, substr(created, 1, 10)) AS largest FROM l),
b AS (SELECT *, row_number() OVER (PARTITION BY source, snapshot_date ORDER BY (size >= largest * 0.5 AND largest > 0) DESC, CASE WHEN size >= largest * 0.5 AND largest > 0 THEN created END DESC, size DESC, created DESC) AS rn FROM d),
t AS (SELECT source, snapshot_date, split_part(url, '/', 4) AS slug, size, created, CASE WHEN NOT (size >= largest * 0.5 AND largest > 0) THEN 'undersized' WHEN size < 3000 THEN 'small' ELSE '' END AS skip FROM b WHERE rn = 1)"""


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best revisions of a listing that the events of kind error stand for, as in the SQL; other kinds are no revisions."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    listing = e.select(F.when(F.col("user_id") % 2 == 0, "mvs").otherwise("npu").alias("source"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lpad(F.col("event_id").cast("string"), 8, "0")).alias("created"), F.floor(F.col("value") * 100).cast("bigint").alias("size"), F.concat(F.lit("http://x/"), F.col("event_id").cast("string")).alias("url"), F.lit("").alias("api_hash"))
    return revisions.best_per_day(listing, least_bytes=3000)


def _kind(reason):
    return F.when(reason == "", "").when(reason.startswith("every"), "undersized").otherwise("small").alias("skip")


@query(f"WITH {_BEST} SELECT * FROM t")
def best_revision_per_day(spark, sf_dir):
    """The latest healthy revision of each publisher and day."""
    return _best(spark, sf_dir).select("source", "snapshot_date", "slug", "size", "created", _kind(F.col("skip_reason")))


@query(f"WITH {_BEST} SELECT source, snapshot_date, slug, size, created, skip FROM t QUALIFY row_number() OVER (PARTITION BY snapshot_date ORDER BY skip <> '', source <> 'npu', source) = 1")
def timeline_merge(spark, sf_dir):
    """Two publishers as one series of days."""
    return revisions.merge_timeline(_best(spark, sf_dir), "npu").select("source", "snapshot_date", "slug", "size", "created", _kind(F.col("skip_reason")))


@query(f"WITH {_BEST} SELECT source, snapshot_date FROM t WHERE day(CAST(snapshot_date AS DATE)) % 4 <> 0")
def pending_revisions(spark, sf_dir):
    """Revisions that no ledger row covers."""
    best = _best(spark, sf_dir)
    done = best.where(F.dayofmonth(F.col("snapshot_date").cast("date")) % 4 == 0).select("source", "snapshot_date")
    return revisions.pending(best, done).select("source", "snapshot_date")


@query("""
WITH o AS (SELECT CAST(n_regionkey AS VARCHAR) AS source, DATE '2024-01-01' + n_nationkey AS snapshot_date, 'folded' AS status, CAST(n_nationkey AS BIGINT) AS record_count FROM nation WHERE n_nationkey < 15),
n AS (SELECT CAST(n_regionkey AS VARCHAR) AS source, DATE '2024-01-01' + n_nationkey AS snapshot_date, 'failed' AS status FROM nation WHERE n_nationkey >= 10)
SELECT coalesce(n.source, o.source) AS source, coalesce(n.snapshot_date, o.snapshot_date) AS snapshot_date, coalesce(n.status, o.status) AS status, o.record_count FROM o FULL JOIN n ON o.source = n.source AND o.snapshot_date = n.snapshot_date""")
def ledger_upsert(spark, sf_dir):
    """Outcomes merged into a ledger without touching its counts."""
    from tidemark.schema import LEDGER

    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("source"), F.date_add(F.lit(date(2024, 1, 1)), F.col("n_nationkey").cast("int")).alias("snapshot_date"), F.col("n_nationkey").alias("k"))
    full = lambda df, **v: df.select(*[(v[f.name] if f.name in v else F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields])
    held = full(rows.where("k < 15"), status=F.lit("folded"), record_count=F.col("k"))
    more = full(rows.where("k >= 10"), status=F.lit("failed"))
    return fold.upsert_ledger(held, more, only=["status", "reason"]).select("source", "snapshot_date", "status", "record_count")


@query("""
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN replace(replace(upper(p_name), 'O', 'О'), 'A', 'А') ELSE upper(p_name) END AS t FROM part)
SELECT p_partkey, t AS words, translate(replace(t, ' ', ''), 'ОА', 'OA') || '5' AS code FROM p""")
def model_code_letters(spark, sf_dir):
    """Words without digits stay as they are; only codes are put into Latin letters."""
    t = F.when(F.col("p_size") % 2 == 0, F.translate(F.upper("p_name"), "OA", "ОА")).otherwise(F.upper("p_name"))
    rows = table(spark, sf_dir, "part").select("p_partkey", t.alias("t"))
    code = F.concat(F.replace("t", F.lit(" "), F.lit("")), F.lit("5"))
    return rows.select("p_partkey", text.normalize_model(F.col("t")).alias("words"), text.normalize_model(code).alias("code"))


@query("""WITH b AS (SELECT DISTINCT p_brand FROM part), s AS (SELECT p_brand, substr(p_brand, 1, 2) || substr(p_brand, 4, 1) || substr(p_brand, 3, 1) || substr(p_brand, 5, 20) AS swapped FROM b)
SELECT p_brand, swapped, CAST(CASE WHEN p_brand = swapped THEN 0 ELSE damerau_levenshtein(p_brand, swapped) END AS INTEGER) AS distance FROM s""")
def osa_distances(spark, sf_dir):
    """Distances of all distinct brand names to their neighbours in order."""
    b = table(spark, sf_dir, "part").select("p_brand").distinct()
    pairs = b.select("p_brand", F.concat(F.substring("p_brand", 1, 2), F.substring("p_brand", 4, 1), F.substring("p_brand", 3, 1), F.substring("p_brand", 5, 20)).alias("swapped"))
    return pairs.select("p_brand", "swapped", osa_distance(F.col("p_brand"), F.col("swapped")).alias("distance"))


@query("SELECT * FROM (VALUES ('balance', 'extra'), ('dk', 'missing'), ('dtl', 'missing'), ('imei', 'missing'), ('insert_date', 'missing'), ('nk', 'missing'), ('ovd', 'missing')) AS t(name, kind)")
def schema_drift(spark, sf_dir):
    """Columns that a snapshot has too many or too few."""
    from tidemark.sources.json_snapshot import drift

    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("NZ"), F.col("c_acctbal").alias("balance"))
    extra, missing = drift(raw)
    return spark.createDataFrame([(c, "extra") for c in extra] + [(c, "missing") for c in missing], "name string, kind string")
