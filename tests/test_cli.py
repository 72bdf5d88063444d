import json

from tidemark import cli


def test_fold_to_export(spark, tmp_path, capsys):
    state, out, target = (str(tmp_path / x) for x in ("state", "out", "target"))
    rows = [{"ID": str(i), "NZ": "nokia 3310", "IMEI": "35693803564380", "INSERT_DATE": "2019-01-01", "OVD": "Київська область", "DTL": "380501234567"} for i in range(6)]
    for day, n in (("2024-01-01", 6), ("2024-01-02", 5)):
        (tmp_path / f"{day}.json").write_text(json.dumps(rows[:n]))
        assert cli.main(["fold", state, str(tmp_path / f"{day}.json"), "a", day, "--floor", "1"]) == 0
    assert cli.main(["fold", state, str(tmp_path / "2024-01-02.json"), "a", "2024-01-02", "--floor", "1"]) == 3
    (tmp_path / "a.csv").write_text("alias,brand,manufacturer,note\nnokia,Nokia,HMD,\n")
    assert cli.main(["normalise", state, out, "--aliases", str(tmp_path / "a.csv"), "--as-of", "2024-02-01"]) == 0
    (tmp_path / "c.json").write_text(json.dumps({"table": "records_normalized", "row_count_min": 1, "fields": {"record_key": {"nullable": False, "severity": "critical"}}, "assertions": [{"name": "unique", "sql": "SELECT count(*) FROM (SELECT record_key FROM records_normalized GROUP BY 1 HAVING count(*) > 1)"}]}))
    assert cli.main(["check", out, str(tmp_path / "c.json")]) == 0
    assert cli.main(["export", out, target]) == 0
    assert cli.main(["state", state, str(tmp_path / "public")]) == 0
    assert cli.main(["volume", state]) == 0
    assert "folded: 2" in capsys.readouterr().out
    manifest = json.loads((tmp_path / "target" / "manifest.json").read_text())
    assert manifest["counts"]["records_total"] == 6 and manifest["coverage"]["brand_resolved"] == 1.0
    assert b"380501234567" not in b"".join(p.read_bytes() for p in (tmp_path / "public").rglob("*") if p.is_file())
