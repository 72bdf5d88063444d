"""Command line: fold snapshots, rebuild the published tables, check them, report and export.

    python -m tidemark.cli fold STATE FILE SOURCE DAY [--floor N]
    python -m tidemark.cli normalise STATE OUT --aliases CSV [--lines CSV] [--external CSV]
    python -m tidemark.cli check OUT CONFIG
    python -m tidemark.cli export OUT TARGET
    python -m tidemark.cli state STATE TARGET
    python -m tidemark.cli volume STATE
    python -m tidemark.cli timeline OUT --listing SOURCE=FILE [--listing ...] [--prefer SOURCE]
    python -m tidemark.cli watch STATE TIMELINE
    python -m tidemark.cli backfill STATE TIMELINE WORK [--limit N] [--lookahead N] [--floor N] [--progress FILE] [--keep-going]
    python -m tidemark.cli report OUT CONFIG TARGET [--lang en|uk]
    python -m tidemark.cli unmatched OUT [--lang en|uk]

``fold`` and ``watch`` end with status 3 if there was nothing new, ``check`` with
1 if a critical check failed, ``backfill`` with 1 if it could not finish.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.operators import fold, normalise, quality
from tidemark.plans import reports
from tidemark.session import session
from tidemark.sources import dictionaries, json_snapshot, revisions, sinks
from tidemark.streaming import backfill
from tidemark.streaming.fold_stream import Folder

ORDER = {"records": ["record_key"], "changes": ["record_key", "field", "reason", "value_before"], "issues": ["record_key", "field", "issue"], "dictionary": ["tac"], "observations": ["snapshot_date"]}


def _fold(spark, a) -> int:
    raw, mode, repairs = json_snapshot.read_snapshot(spark, a.file)
    digest = spark.read.format("binaryFile").load(a.file).select(F.sha2("content", 256)).first()[0]
    limits = fold.Limits(least_rows=a.floor) if a.floor is not None else fold.Limits()
    out = Folder(spark, a.state, limits).fold(raw, a.source, date.fromisoformat(a.day), digest, mode, repairs)
    print(out.status, out.reason)
    return 0 if out.status == "folded" else 3


def _normalise(spark, a) -> int:
    f = Folder(spark, a.state)
    aliases = dictionaries.brand_aliases(dictionaries.read_csv(spark, a.aliases, ["alias", "brand", "manufacturer", "note"]))
    lines = dictionaries.line_words(dictionaries.read_csv(spark, a.lines, ["brand", "line_word", "share_pct", "note"])) if a.lines else spark.createDataFrame([], "brand string, line_word string")
    words = dictionaries.word_aliases(dictionaries.read_csv(spark, a.words, ["alias", "canonical"])) if a.words else None
    external = dictionaries.read_csv(spark, a.external, ["Brand", "TAC", "SPECS"]) if a.external else None
    for name, df in normalise.rebuild(f.state(), f.ledger(), aliases, words, lines, date.fromisoformat(a.as_of) if a.as_of else date.today(), external).items():
        df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    return 0


def _check(spark, a) -> int:
    records = spark.read.parquet(f"{a.out}/records")
    report = quality.run(records, quality.load_config(Path(a.config).read_text(encoding="utf-8")))
    print(report.markdown(a.lang))
    return 1 if report.status == "FAIL" else 0


def _export(spark, a) -> int:
    for name, order in ORDER.items():
        df = spark.read.parquet(f"{a.out}/{name}")
        sinks.guard_personal(df)
        sinks.export(df, f"{a.target}/{name}", order)
    records = spark.read.parquet(f"{a.out}/records")
    counts = _metrics(records)
    total = max(1, counts["records_total"])
    coverage = {k: round(counts[k] / total, 4) for k in ("brand_resolved", "model_resolved", "imei_luhn_valid")}
    Path(a.target, "manifest.json").write_text(sinks.manifest(spark, a.target, counts, coverage), encoding="utf-8")
    return 0


def _state(spark, a) -> int:
    sinks.Versions(spark, a.state).copy(a.target)
    return 0


def _volume(spark, a) -> int:
    for k, v in reports.volume(Folder(spark, a.state).ledger()).first().asDict().items():
        print(f"{k}: {reports.human(v) if k.startswith('bytes') and v is not None else v}")
    return 0


def _timeline(spark, a) -> int:
    listings = [x.split("=", 1) for x in a.listing]
    best = [revisions.best_per_day(revisions.load_listing(spark, source, Path(file).read_text(encoding="utf-8"))) for source, file in listings]
    revisions.dump_timeline(revisions.merge_timeline(reduce(lambda x, y: x.unionByName(y), best), a.prefer or listings[0][0]), a.out)
    return 0


def _watch(spark, a) -> int:
    held = Folder(spark, a.state).ledger().where("status = 'folded'").agg(F.max("snapshot_date").cast("string")).first()[0]
    published = revisions.load_timeline(spark, a.timeline).where("skip_reason = ''").agg(F.max("snapshot_date")).first()[0]
    print(f"held {held or '-'}, published {published or '-'}")
    return 0 if revisions.is_ahead(held, published) else 3


def _backfill(spark, a) -> int:
    limits = fold.Limits(least_rows=a.floor) if a.floor is not None else fold.Limits()
    out = backfill.run(Folder(spark, a.state, limits), revisions.load_timeline(spark, a.timeline), a.work, lookahead=a.lookahead or 2, limit=a.limit or 0, halt=not a.keep_going, progress=a.progress)
    print(f"folded {out.folded}, duplicate {out.duplicate}, skipped {out.skipped}, failed {out.failed}, already {out.already}, behind {len(out.behind)}")
    return 0 if out.complete and not out.failed else 1


def _report(spark, a) -> int:
    records = spark.read.parquet(f"{a.out}/records")
    report = quality.run(records, quality.load_config(Path(a.config).read_text(encoding="utf-8")))
    Path(a.target).write_text(report.html(a.lang, _metrics(records)), encoding="utf-8")
    return 1 if report.status == "FAIL" else 0


def _unmatched(spark, a) -> int:
    records = spark.read.parquet(f"{a.out}/records")
    print(reports.review(_metrics(records), [tuple(r) for r in reports.unmatched(records).collect()], a.lang))  # a top-k report
    return 0


def _metrics(records) -> dict[str, int]:
    return {r["metric"]: r["value"] for r in reports.quality_metrics(records).collect()}  # fourteen rows


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--master")
    sub = top.add_subparsers(required=True)
    for name, run, positional, options in (
        ("fold", _fold, ["state", "file", "source", "day"], {"--floor": int}),
        ("normalise", _normalise, ["state", "out"], {"--aliases": str, "--lines": str, "--words": str, "--external": str, "--as-of": str}),
        ("check", _check, ["out", "config"], {"--lang": str}),
        ("export", _export, ["out", "target"], {}),
        ("state", _state, ["state", "target"], {}),
        ("volume", _volume, ["state"], {}),
        ("timeline", _timeline, ["out"], {"--listing": list, "--prefer": str}),
        ("watch", _watch, ["state", "timeline"], {}),
        ("backfill", _backfill, ["state", "timeline", "work"], {"--limit": int, "--lookahead": int, "--floor": int, "--progress": str, "--keep-going": bool}),
        ("report", _report, ["out", "config", "target"], {"--lang": str}),
        ("unmatched", _unmatched, ["out"], {"--lang": str}),
    ):
        p = sub.add_parser(name)
        for x in positional:
            p.add_argument(x)
        for x, kind in options.items():
            if kind in (bool, list):
                p.add_argument(x, **({"action": "store_true"} if kind is bool else {"action": "append", "required": True}))
                continue
            p.add_argument(x, type=kind, default="en" if x == "--lang" else None, required=x == "--aliases")
        p.set_defaults(run=run)
    a = top.parse_args(argv)
    return a.run(session("tidemark", a.master), a)


if __name__ == "__main__":
    sys.exit(main())
