import json
from datetime import date

import pytest
from pyspark.sql import types as T

from tidemark.operators import fold
from tidemark.streaming.fold_stream import Folder, fold_stream

LOOSE = fold.Limits(least_rows=1, missing_per_day=1.0, missing_most=1.0)


def raw(spark, rows):
    return spark.createDataFrame(rows, "id string, nz string, dtl string")


def test_folder_is_idempotent_and_atomic(spark, tmp_path):
    f = Folder(spark, str(tmp_path / "s"), LOOSE)
    assert f.fold(raw(spark, [("1", "a", "380501234567"), ("2", "b", None)]), "a", date(2024, 1, 1), "h1").status == "folded"
    assert f.fold(raw(spark, [("1", "a", None)]), "a", date(2024, 1, 1), "h1").status == "skipped"
    assert f.fold(raw(spark, [("1", "a", None)]), "a", date(2024, 1, 2), "h1").status == "duplicate"
    out = f.fold(raw(spark, [("1", "a2", "380501234567")]), "a", date(2024, 1, 3), "h2")
    assert out.verdict.changed == 1 and out.verdict.disappeared == 1
    assert f.quarantined().count() == 1, "quarantined once across repeats"
    assert {(r["source"], str(r["snapshot_date"]), r["status"]) for r in f.ledger().collect()} == {("a", "2024-01-01", "folded"), ("a", "2024-01-02", "duplicate"), ("a", "2024-01-03", "folded")}
    assert {(r["record_key"], r["event"]) for r in f.history().where("snapshot_date = '2024-01-03'").collect()} == {("1", "changed"), ("2", "disappeared")}
    before = f.versions.current()
    with pytest.raises(fold.OutOfOrder):
        f.fold(raw(spark, [("1", "a", None)]), "a", date(2024, 1, 2), "h3")
    assert f.versions.current() == before
    # a crash before the pointer: files of the next version without a commit change nothing
    f.state().limit(0).write.parquet(f"{tmp_path}/s/v{before + 1:08d}/state")
    assert f.state().count() == 2


def test_two_folds_of_one_day_keep_all_events(spark, tmp_path):
    f = Folder(spark, str(tmp_path / "s"), LOOSE)
    f.fold(raw(spark, [("1", "a", None), ("2", "b", None)]), "a", date(2024, 1, 1), "h1", api_hash="p1")
    f.fold(raw(spark, [("1", "a", None), ("2", "b", None), ("3", "c", None)]), "a", date(2024, 1, 1), "h2", api_hash="p2")
    assert sorted((r["fold"], r["record_key"], r["event"]) for r in f.history().collect()) == [(1, "1", "appeared"), (1, "2", "appeared"), (2, "3", "appeared")]
    assert f.state().count() == 3
    # a fold that crashed before its commit: its events do not count, and the repeated fold writes them again
    f.history().where("fold = 2").drop("fold", "snapshot_date", "source").write.parquet(f"{tmp_path}/s/history/snapshot_date=2024-01-02/source=a/fold=3")
    assert f.history().count() == 3
    f.fold(raw(spark, [("1", "a", None), ("2", "b", None)]), "a", date(2024, 1, 2), "h3", api_hash="p3")
    assert [(r["record_key"], r["event"]) for r in f.history().where("fold = 3").collect()] == [("3", "disappeared")]
    assert f.known_by_hash("p3") == ("a", date(2024, 1, 2)) and f.known_by_hash("p9") is None and f.known_by_hash(None) is None


def test_stream_folds_files_in_order(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "snapshot_date", "id", "nz")])
    days = {"2024-01-01": [("1", "a"), ("2", "b")], "2024-01-02": [("1", "a")], "2024-01-03": [("1", "a"), ("2", "b")]}
    import os

    for i, (day, rows) in enumerate(days.items()):
        p = src / f"{day}.json"
        p.write_text("".join(json.dumps({"source": "a", "snapshot_date": day, "id": k, "nz": v}) + "\n" for k, v in rows))
        os.utime(p, (1_700_000_000 + i * 60,) * 2)
    for _ in range(2):  # the second run finds nothing new
        fold_stream(spark, str(src), str(tmp_path / "state"), str(tmp_path / "ckpt"), schema, LOOSE).awaitTermination()
    state = {r["record_key"]: r for r in Folder(spark, str(tmp_path / "state")).state().collect()}
    assert str(state["2"]["returned_at"]) == "2024-01-03" and state["2"]["disappeared_count"] == 1 and state["1"]["revision_no"] == 1
