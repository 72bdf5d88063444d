import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import stage
from tidemark.schema import REVISION
from tidemark.sources import json_snapshot as js
from tidemark.sources import revisions as rv
from tidemark.sources import sinks


@pytest.mark.parametrize(
    ("text", "n", "faults"),
    [
        ('[{"a":1},{"a":2}]', 2, 0),
        ("[]", 0, 0),
        ('[{"a":1}]{"a":2}[{"a":3},{"a":4}]', 4, 2),
        ('[{"a":1}][{"a":2}]', 2, 1),
        ('[{"a":1},,{"a":2}]', 2, 1),
        ('[{"a":"]{ [ \\" ,,"},{"a":[1,{"b":2}]}]', 2, 0),
    ],
)
def test_scan(text, n, faults):
    got = js.scan(text)
    assert (len(got.objects), got.faults) == (n, faults)
    assert all(json.loads(o) for o in got.objects)


@pytest.mark.parametrize("text", ['[{"a":1},{"a"', '[{"a":1}', '{"a":1}', "", '[1, 2]', '[{"a":"x]'])
def test_refused(text):
    with pytest.raises(js.BrokenSnapshot):
        js.scan(text)


def test_read_keeps_text_and_case(spark, tmp_path):
    p = tmp_path / "s.json"
    p.write_text(json.dumps([{"ID": "1", "INSERT_DATE": "2019-01-01T00:00:00", "x": 5}, {"id": "2", "INSERT_DATE": "", "DTL": [{"NOMER": "123", "b": "c"}]}]))
    df, mode, repairs = js.read_snapshot(spark, str(p))
    rows = {r["id"]: r.asDict() for r in js.projected(df).collect()}
    assert mode == "json" and repairs == 0
    assert rows["1"]["insert_date"] == "2019-01-01T00:00:00" and rows["2"]["insert_date"] == ""
    assert json.loads(rows["1"]["extra_json"]) == {"x": "5"} and json.loads(rows["2"]["dtl"]) == [{"NOMER": "123", "b": "c"}]
    assert js.drift(df)[0] == ["x"]
    staged = stage.stage(df)
    assert [tuple(r) for r in staged.quarantined.collect()] == [("2", "dtl.nomer", "123")]
    kept = {r["id"]: r["dtl"] for r in staged.snapshot.collect()}
    assert json.loads(kept["2"]) == [{"b": "c"}]


def test_broken_and_repaired_files(spark, tmp_path):
    (tmp_path / "cut.json").write_text('[{"ID":"1"},{"ID"')
    with pytest.raises(js.BrokenSnapshot, match="inside a value"):
        js.read_snapshot(spark, str(tmp_path / "cut.json"))
    (tmp_path / "two.json").write_text('[{"ID":"1"}]{"ID":"2"}[{"ID":"3"}]')
    df, mode, repairs = js.read_snapshot(spark, str(tmp_path / "two.json"))
    assert (sorted(r["id"] for r in df.collect()), mode, repairs) == (["1", "2", "3"], "repaired", 2)
    (tmp_path / "none.json").write_text("[]")
    assert js.read_snapshot(spark, str(tmp_path / "none.json"))[0].count() == 0


def test_phones_are_quarantined_and_other_numbers_kept(spark):
    raw = spark.createDataFrame([("1", "380501234567"), ("2", "123456789012345"), ("3", "*"), ("4", None)], "id string, dtl string")
    staged = stage.stage(raw)
    assert [tuple(r) for r in staged.quarantined.collect()] == [("1", "dtl", "380501234567")]
    assert {r["id"]: r["dtl"] for r in staged.snapshot.collect()} == {"1": None, "2": "123456789012345", "3": "*", "4": None}


def test_revisions(spark):
    listing = spark.createDataFrame([("mvs", "2020-01-01T01", 100, "http://x/a", "h1"), ("mvs", "2020-01-01T02", 10, "http://x/b", "h2"), ("mvs", "2020-01-02T01", 5, "http://x/c", "h3"), ("npu", "2020-01-01T05", 90, "http://x/d", "h4"), ("npu", "", 90, "http://x/e", "h5"), ("npu", "2020-01-03", 0, None, None)], rv.LISTING)
    best = rv.best_per_day(listing, least_bytes=50)
    got = {(r["source"], r["snapshot_date"]): (r["slug"], r["skip_reason"]) for r in best.collect()}
    assert got[("mvs", "2020-01-01")] == ("a", "") and got[("npu", "2020-01-01")] == ("d", "")
    assert got[("mvs", "2020-01-02")][1].startswith("5 B is below") and got[("npu", "2020-01-03")][1].startswith("every revision")
    merged = rv.merge_timeline(best, "npu").orderBy("snapshot_date").collect()
    assert [(r["source"], r["snapshot_date"]) for r in merged] == [("npu", "2020-01-01"), ("mvs", "2020-01-02"), ("npu", "2020-01-03")]
    done = spark.createDataFrame([("npu", date(2020, 1, 1))], "source string, snapshot_date date")
    assert rv.pending(best, done).count() == 3


def test_timeline_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "2020-01-01", "s", "u", "h", 3, "c", "")], REVISION)
    rv.dump_timeline(df, str(tmp_path / "t"))
    assert rv.load_timeline(spark, str(tmp_path / "t")).collect() == df.collect()


@pytest.mark.parametrize(("held", "published", "ahead"), [(None, "2020-01-01", True), ("2020-01-01", "2020-01-01", False), ("2020-01-01", "2020-01-02", True), ("2020-01-01", "", False), (None, None, False)])
def test_is_ahead(held, published, ahead):
    assert rv.is_ahead(held, published) is ahead


def test_download_retries_and_checks_length(tmp_path):
    tries = []

    def chunks():
        tries.append(1)
        if len(tries) == 1:
            raise OSError("lost")
        yield b"abc"

    assert rv.download(chunks, str(tmp_path / "f"), 3, wait=0) == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    with pytest.raises(OSError):
        rv.download(lambda: [b"a"], str(tmp_path / "g"), 2, wait=0)
    assert not list(tmp_path.glob("*.part"))


def test_export_is_reproducible(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 10).alias("a"), F.col("id"))
    hashes = []
    for i in range(2):
        sinks.export(df.orderBy(F.rand(i)), str(tmp_path / f"e{i}"), ["a", "id"])
        hashes.append([r["sha256"] for r in rv.artefacts(spark, str(tmp_path / f"e{i}")).where("path like '%.parquet'").collect()])
    assert hashes[0] == hashes[1] and len(hashes[0]) == 1


def test_versions_commit_copy_and_guard(spark, tmp_path):
    v = sinks.Versions(spark, str(tmp_path / "state"))
    assert v.current() == 0 and v.read("records") is None
    records = spark.createDataFrame([("1", "123456789012345")], "record_key string, dtl string")
    secret = spark.createDataFrame([("1", "dtl", "380509999999")], "record_key string, field string, value string")
    v.commit({"records": records, "quarantine_personal": secret})
    copied = v.copy(str(tmp_path / "public"))
    assert copied.read("records").count() == 1 and copied.read("quarantine_personal") is None
    assert b"380509999999" not in b"".join(p.read_bytes() for p in (tmp_path / "public").rglob("*") if p.is_file())
    v.commit({"records": spark.createDataFrame([("1", "380509999999")], "record_key string, dtl string")})
    with pytest.raises(sinks.PersonalDataFound):
        v.copy(str(tmp_path / "public2"))
    v.commit({"records": records})
    v.prune(1)
    assert v.current() == 3 and v.read("records").count() == 1


def test_manifest(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    got = json.loads(sinks.manifest(spark, str(tmp_path), {"records": 1}, {"brand": 0.5}))
    assert got["artefacts"] == [{"path": "x.bin", "bytes": 3, "sha256": "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"}]
