import json
from datetime import date

from tidemark import cli
from tidemark.operators import fold
from tidemark.operators.quality import Report, Result
from tidemark.schema import REVISION
from tidemark.streaming import backfill
from tidemark.streaming.fold_stream import Folder

LOOSE = fold.Limits(least_rows=2, missing_per_day=1.0, missing_most=1.0)


def published(tmp_path, days):
    """day -> (file text, publisher's checksum, reason to skip), as rows of a timeline."""
    out = []
    for day, (text, api_hash, reason) in days.items():
        file = tmp_path / f"pub_{day}.json"
        file.write_text(text)
        out.append(("a", day, file.name, file.as_uri(), api_hash, file.stat().st_size, day, reason))
    return out


def rows(n, word="x"):
    return json.dumps([{"ID": str(i), "NZ": f"{word}{i}"} for i in range(n)])


def statuses(f):
    return {str(r["snapshot_date"]): r["status"] for r in f.ledger().collect()}


def test_backfill_folds_skips_halts_and_resumes(spark, tmp_path):
    days = {
        "2024-01-01": (rows(4), "h1", ""),
        "2024-01-02": (rows(4), "h1", ""),  # the publisher's checksum says it is the same
        "2024-01-03": (rows(4), "h3", ""),  # the same bytes under another checksum
        "2024-01-04": (rows(3), "h4", "undersized"),
        "2024-01-05": (rows(1), "h5", ""),  # below the floor
        "2024-01-06": ("no json", "h6", ""),
        "2024-01-07": (rows(3), "h7", ""),
    }
    timeline = published(tmp_path, days)
    f, work, note = Folder(spark, str(tmp_path / "s"), LOOSE), str(tmp_path / "work"), str(tmp_path / "progress.json")
    fetched = []

    def fetch(url, target, size):
        fetched.append(url[-15:-5])
        return backfill.fetch_url(url, target, size)

    out = backfill.run(f, spark.createDataFrame(timeline, REVISION), work, fetch, lookahead=1, progress=note)
    assert (out.folded, out.duplicate, out.skipped, out.failed, out.halted, out.complete) == (1, 2, 2, 1, "2024-01-06", False)
    assert statuses(f) == {"2024-01-01": "folded", "2024-01-02": "duplicate", "2024-01-03": "duplicate", "2024-01-04": "skipped", "2024-01-05": "skipped", "2024-01-06": "failed"}
    assert "2024-01-04" not in fetched
    assert [p.name for p in (tmp_path / "work").rglob("*.json")] == ["a_2024-01-06.json"] and (tmp_path / "work" / "failed").is_dir()
    assert json.loads((tmp_path / "progress.json").read_text())["done"] == 6
    # a publisher mends the file: the same command goes on where it ended, and no settled day is fetched again
    fetched.clear()
    timeline[5] = published(tmp_path, {"2024-01-06": (rows(4, "y"), "h6", "")})[0]
    out = backfill.run(f, spark.createDataFrame(timeline, REVISION), work, fetch)
    assert (out.folded, out.failed, out.already, out.complete) == (2, 0, 5, True) and fetched == ["2024-01-06", "2024-01-07"]
    assert f.state().where("is_present").count() == 3
    assert f.ledger().where("status = 'folded' and bytes > 0 and reason is null").count() == 3
    # a day that turns up late is reported and left alone; an empty timeline is no work
    late = published(tmp_path, {"2023-12-31": (rows(4), "h0", "")})
    out = backfill.run(f, spark.createDataFrame(late, REVISION), work, fetch)
    assert (out.total, out.behind, out.complete) == (0, ["2023-12-31"], True)
    assert backfill.run(f, spark.createDataFrame([], REVISION), work, fetch).total == 0


def test_checksum_known_before_the_run_is_not_fetched(spark, tmp_path):
    f = Folder(spark, str(tmp_path / "s"), LOOSE)
    f.fold(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, nz string"), "b", date(2024, 1, 1), "h", api_hash="p")
    out = backfill.run(f, spark.createDataFrame(published(tmp_path, {"2024-01-02": (rows(4), "p", "")}), REVISION), str(tmp_path / "w"), fetch=None)
    assert out.duplicate == 1 and out.bytes_not_fetched == len(rows(4)) and out.bytes_fetched == 0


def test_command_line_from_listing_to_state(spark, tmp_path, capsys):
    (tmp_path / "d1.json").write_text(rows(3))
    entry = {"resource_created": "2024-01-01T01:00:00", "size": 60_000_000, "url": (tmp_path / "d1.json").as_uri(), "file_hash_sum": "h"}
    (tmp_path / "l.json").write_text(json.dumps({"result": {"resource_revisions": [entry]}}))
    state, timeline, work = (str(tmp_path / x) for x in ("s", "t", "w"))
    assert cli.main(["timeline", timeline, "--listing", f"a={tmp_path}/l.json"]) == 0
    assert cli.main(["watch", state, timeline]) == 0
    # the listing's size is not the file's: noted as failed, nothing folded
    assert cli.main(["backfill", state, timeline, work, "--floor", "1", "--keep-going"]) == 1
    assert "failed 1" in capsys.readouterr().out
    Folder(spark, state, LOOSE).fold(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, nz string"), "a", date(2024, 1, 1), "h")
    assert cli.main(["watch", state, timeline]) == 3


def test_report_lists_failures_first():
    report = Report("t", 10, "2024-01-01", [Result("a|b", "not_null", "PASS", "info", 10, 0, ""), Result("c", "regex", "FAIL", "critical", 10, 2, "<x>")])
    page, text = report.html("uk", {"records": 1234}), report.markdown()
    assert page.count("<table>") == 2 and "&lt;x&gt;" in page and "1,234" in page and "шаблон" in page and 'class="fail"' in page
    assert text.index("| c | pattern | FAIL") < text.index("| a\\|b | always given | PASS")
    assert report.html().count("<table>") == 2 and Report("t", 0, "x").html().count("<table>") == 1
