from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import normalise, quality
from tidemark.operators.fold import LEDGER, empty_state, ledger_row, upsert_ledger
from tidemark.plans import reports
from tidemark.schema import STATE


@pytest.fixture
def rows(spark):
    return spark.range(1000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") < 700, "m").alias("model"), (F.col("id") % 2 == 0).alias("flag"), F.lit(date(2020, 1, 1)).alias("day"))


@pytest.mark.parametrize(
    ("spec", "status"),
    [
        ({"model": {"min_fill_rate": 0.645}}, "PASS"),
        ({"model": {"min_fill_rate": 0.9695, "severity": "critical"}}, "FAIL"),
        ({"model": {"min_fill_rate": 0.9695}}, "WARN"),
        ({"k": {"nullable": False, "regex": "^[0-9]+$", "distinct_count": True}}, "PASS"),
        ({"k": {"length": 3, "severity": "critical"}}, "FAIL"),
        ({"model": {"allowed_values": ["m"]}}, "PASS"),
        ({"flag": {"min_true_share": 0.5, "max_true_share": 0.5}}, "PASS"),
        ({"flag": {"max_true_share": 0.4}}, "WARN"),
        ({"day": {"min_value": "2019-01-01", "max_value": "today", "type": "date"}}, "PASS"),
        ({"day": {"max_value": "2019-01-01", "type": "date"}}, "WARN"),
    ],
)
def test_field_checks(rows, spec, status):
    assert quality.run(rows, {"fields": spec}, date(2024, 1, 1)).status == status


def test_assertions_floor_and_order(rows):
    report = quality.run(rows, {"table": "t_rows", "row_count_min": 2000, "assertions": [{"name": "one", "sql": "SELECT count(*) FROM t_rows WHERE model IS NULL", "severity": "warning", "title": "Один", "title_en": "One"}], "fields": {"k": {"nullable": False}}})
    assert [r.check for r in report.results] == ["row_count", "one", "not_null"] and report.status == "FAIL"
    assert "| One | FAIL |" in report.markdown("en") and "| Один | FAIL |" in report.markdown("uk")


def test_empty_table(spark):
    report = quality.run(spark.createDataFrame([], "a string"), {"fields": {"a": {"nullable": False, "min_fill_rate": 0.5, "min_true_share": 0.0}}})
    assert {r.check: r.status for r in report.results} == {"row_count": "PASS", "not_null": "PASS", "fill_rate": "FAIL", "true_share": "PASS"}


def test_rebuild_runs_whole(spark):
    def record(k, nz, imei, ins, present, seen):
        base = {f.name: None for f in STATE.fields} | {"record_key": k, "nz": nz, "imei": imei, "insert_date": ins, "ovd": "Київська область", "first_seen": seen, "is_present": present, "revision_no": 1, "first_source": "a", "last_source": "a"}
        if not present:
            base |= {"last_seen": date(2020, 9, 22), "disappeared_at": date(2021, 3, 31)}
        return tuple(base[f.name] for f in STATE.fields)

    state = spark.createDataFrame([record("1", "nokia 3310", "356938035643809", "2019-01-01", True, date(2020, 9, 22)), record("2", "", "123", "1019-01-01", False, date(2021, 3, 31)), record("3", None, None, "", True, date(2021, 3, 31)), record("4", "??x", "356938035643809", None, True, date(2021, 3, 31))], STATE)
    ledger = empty_ledger = spark.createDataFrame([], LEDGER)
    for day, status in ((date(2020, 9, 22), "folded"), (date(2021, 1, 15), "duplicate"), (date(2021, 3, 31), "folded")):
        ledger = upsert_ledger(ledger, ledger_row(spark, "a", day, status=status, record_count=3, is_suspect=False))
    aliases = spark.createDataFrame([("NOKIA", "Nokia", "HMD")], "alias string, brand string, manufacturer string")
    lines = spark.createDataFrame([], "brand string, line_word string")
    out = normalise.rebuild(state, ledger, aliases, {}, lines, date(2024, 1, 1))
    records = {r["record_key"]: r for r in out["records"].collect()}
    assert records["1"]["first_seen_after"] is None and records["2"]["first_seen_days"] == 190 and records["2"]["disappeared_days"] == 190
    assert records["1"]["insert_date"] == datetime(2019, 1, 1) and records["2"]["insert_date_implausible"] is True and records["3"]["insert_date_implausible"] is None
    assert records["2"]["nz_method"] == records["3"]["nz_method"] == "empty", "an empty spelling has a method of its own"
    issues = {(r["record_key"], r["issue"]): r["raw_value"] for r in out["issues"].collect()}
    assert issues[("2", "date_implausible")] == "1019-01-01", "the raw date, not the spelling"
    assert ("4", "brand_unresolved") in issues and ("2", "imei_unusable") in issues and ("2", "brand_unresolved") not in issues
    coverage = reports.monthly_coverage(out["observations"], out["records"].select("first_seen")).collect()
    assert len(coverage) == 7 and [r["is_measured"] for r in coverage] == [True] + [False] * 5 + [True] and coverage[-1]["longest_gap_days"] == 190
    metrics = {r["metric"]: r["value"] for r in reports.quality_metrics(out["records"]).collect()}
    assert len(metrics) == 14 and metrics["records_total"] == 4 and metrics["brand_resolved"] == 1
    assert "| ??x |" in reports.review(metrics, [tuple(r) for r in reports.unmatched(out["records"]).collect()], "uk")
    assert empty_ledger.count() == 0 and empty_state(spark).count() == 0


def test_volume(spark):
    rows = [ledger_row(spark, "a", date(2020, 1, i + 1), status=s, bytes=b) for i, (s, b) in enumerate([("folded", 300), (None, 400), ("duplicate", 300), ("skipped", 3)])]
    df = rows[0]
    for r in rows[1:]:
        df = df.unionByName(r)
    v = reports.volume(df).first()
    assert (v["revisions"], v["folded"], v["bytes_published"], v["bytes_downloaded"], v["bytes_not_fetched"]) == (4, 2, 1003, 700, 300)
    assert reports.human(1_500_000) == "1.50 MB" and reports.human(12, "uk") == "12 Б"


def test_row_assertions_join_the_field_pass(spark):
    assert quality.row_condition("SELECT count(*) FROM t WHERE a > 1 AND b IS NULL", "t") == "a > 1 AND b IS NULL"
    for sql in ("SELECT count(*) FROM u WHERE a > 1", "SELECT count(*) FROM t WHERE a IN (SELECT b FROM u)", "SELECT count(DISTINCT a) FROM t WHERE a > 1", "SELECT count(*) FROM (SELECT a FROM t GROUP BY 1)", "SELECT count(*) FROM t"):
        assert quality.row_condition(sql, "t") is None
    df = spark.createDataFrame([(1, 1), (1, 2), (3, None)], "a int, b int")
    config = {"table": "asserted", "assertions": [{"name": n, "sql": f"SELECT count(*) FROM {q}"} for n, q in {"big": "asserted WHERE a > 2", "twice": "(SELECT a FROM asserted GROUP BY a HAVING count(*) > 1)", "null": "asserted where b > 5;", "other": "(SELECT 1 WHERE false)"}.items()]}
    report = quality.run(df, config)
    assert {r.check: r.bad for r in report.results if r.field == "_assertion_"} == {"big": 1, "twice": 1, "null": 0, "other": 0}
