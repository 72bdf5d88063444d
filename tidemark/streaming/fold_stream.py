"""Folding snapshots one after another: the ordered driver loop, and the same as a streaming sink."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import fold
from tidemark.operators.stage import Staged, stage
from tidemark.schema import LEDGER, STATE
from tidemark.sources.sinks import Versions


@dataclass(frozen=True)
class Outcome:
    """What became of one snapshot: folded, skipped (already done), duplicate, refused."""

    source: str
    day: date
    status: str
    reason: str = ""
    verdict: fold.Verdict | None = None


class Folder:
    """Versioned state under a root, moved forward by one snapshot at a time.

    Every fold writes the next version and commits it with a pointer written
    last; a repeated (source, day, checksum) is skipped, so a batch that is
    delivered again after a crash does no harm.  A day before the last folded
    one is an error; the same day again replaces nothing but folds on top, and
    its events are kept beside those of the first (a fold that is repeated after a
    crash writes its own again).
    """

    def __init__(self, spark: SparkSession, root: str, limits: fold.Limits = fold.Limits()):
        self.spark, self.limits = spark, limits
        self.versions = Versions(spark, root)
        self.history_path = f"{root.rstrip('/')}/history"

    def state(self) -> DataFrame:
        held = self.versions.read("state")
        return held if held is not None else self.spark.createDataFrame([], STATE)

    def ledger(self) -> DataFrame:
        held = self.versions.read("ledger")
        return held if held is not None else self.spark.createDataFrame([], LEDGER)

    def quarantined(self) -> DataFrame:
        held = self.versions.read("quarantine_personal")
        return held if held is not None else self.spark.createDataFrame([], "record_key string, field string, value string")

    def _aggregates(self) -> DataFrame:
        held = self.versions.read("aggregates")
        return held if held is not None else self.spark.createDataFrame([], "snapshot_date date, source string, dimension string, key string, records bigint")

    def known_by_hash(self, api_hash: str | None) -> tuple[str, date] | None:
        """(source, day) of the folded snapshot that the publisher gave the same checksum, the earliest one: there is no need to download it again."""
        if not api_hash:
            return None
        seen = self.ledger().where((F.coalesce("status", F.lit("folded")) == "folded") & (F.col("api_hash") == F.lit(api_hash))).orderBy("snapshot_date", "source").first()
        return (seen["source"], seen["snapshot_date"]) if seen else None

    def fold(self, raw: DataFrame, source: str, day: date, sha256: str | None = None, read_mode: str = "json", repairs: int = 0, api_hash: str | None = None, size: int | None = None) -> Outcome:
        """Stages, judges and folds one snapshot."""
        ledger = self.ledger()
        own = (F.col("source") == source) & (F.col("snapshot_date") == F.lit(day))
        same = ledger.where((F.col("status") == "folded") & (F.col("sha256") == F.lit(sha256))).orderBy(own.desc(), "snapshot_date", "source")
        if sha256 and (seen := same.first()):
            if (seen["source"], seen["snapshot_date"]) == (source, day):
                return Outcome(source, day, "skipped", "already folded")
            self._note(source, day, status="duplicate", reason=f"same bytes as {seen['snapshot_date']}", sha256=sha256, api_hash=api_hash, bytes=size)
            return Outcome(source, day, "duplicate")
        last = ledger.where("status = 'folded'").orderBy(F.desc("snapshot_date")).first()
        previous = fold.Previous(last["snapshot_date"], last["source"]) if last else None
        staged = stage(raw)
        pairs = fold.matched(self.state(), staged.snapshot).persist()
        try:
            verdict = fold.judge(pairs, staged.stats["rows_raw"], day, source, previous, self.limits)
            self._write(pairs, staged, verdict, source, day, previous, sha256, read_mode, repairs, api_hash, size)
        finally:
            pairs.unpersist()
        return Outcome(source, day, "folded", verdict.reason, verdict)

    def _write(self, pairs: DataFrame, staged: Staged, verdict: fold.Verdict, source: str, day: date, previous, sha256, read_mode, repairs, api_hash, size) -> None:
        from tidemark.operators.stage import insert_if_absent

        events = fold.history(pairs, day, source, verdict.suspect).drop("snapshot_date", "source")
        events.write.mode("overwrite").parquet(f"{self.history_path}/snapshot_date={day}/source={source}/fold={self.versions.current() + 1}")
        state = fold.next_state(pairs, day, source, previous, verdict.suspect)
        row = fold.ledger_row(
            self.spark, source, day, status="folded", api_hash=api_hash, sha256=sha256, bytes=size, read_mode=read_mode, rows_repaired=repairs, rows_raw=staged.stats["rows_raw"],
            rows_dupe_id=staged.stats["rows_dupe_id"], record_count=staged.stats["record_count"], appeared=verdict.appeared, changed=verdict.changed,
            missing=verdict.missing, disappeared=verdict.disappeared, is_suspect=verdict.suspect, suspect_reason=verdict.reason or None,
        )
        totals = self._aggregates().where(~((F.col("snapshot_date") == F.lit(day)) & (F.col("source") == source)))
        self.versions.commit(
            {
                "state": state,
                "quarantine_personal": insert_if_absent(self.quarantined(), staged.quarantined, ["record_key", "field", "value"]),
                "aggregates": totals.unionByName(fold.aggregates(state, day, source)),
                "ledger": fold.upsert_ledger(self.ledger(), row),
            }
        )
        self.versions.prune()

    def _note(self, source: str, day: date, **values) -> None:
        row = fold.ledger_row(self.spark, source, day, **values)
        self.versions.commit({"state": self.state(), "quarantine_personal": self.quarantined(), "aggregates": self._aggregates(), "ledger": fold.upsert_ledger(self.ledger(), row, only=["status", "reason"])})

    def skip(self, source: str, day: date, status: str, reason: str, size: int | None = None, api_hash: str | None = None) -> None:
        """Records that a revision was not folded, and why."""
        self._note(source, day, status=status, reason=reason, bytes=size, api_hash=api_hash)

    def history(self) -> DataFrame:
        """All events so far; ``fold`` is the version of the state that they led to, and orders the folds of one day.

        Events of a fold that never came to be committed are left out.
        """
        return self.spark.read.option("basePath", self.history_path).parquet(self.history_path).where(F.col("fold") <= self.versions.current())


def fold_stream(spark: SparkSession, path: str, root: str, checkpoint: str, schema: T.StructType, limits: fold.Limits = fold.Limits(), source: str = "source", day: str = "snapshot_date"):
    """Folds files as they arrive, a snapshot a file in lexical order of arrival, until none is left.

    Rows carry their source and day.  Delivery is at least once; the folder's
    ledger makes it exactly once.
    """
    folder = Folder(spark, root, limits)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)

    def apply(batch: DataFrame, number: int) -> None:
        keys = batch.select(F.col(source).alias("s"), F.col(day).cast("date").alias("d")).distinct().orderBy("d", "s").collect()  # the snapshots of one file
        for k in keys:
            rows = batch.where((F.col(source) == k["s"]) & (F.col(day).cast("date") == F.lit(k["d"]))).drop(source, day)
            mark = rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.count(F.lit(1))).first()
            folder.fold(rows, k["s"], k["d"], sha256=f"{k['s']}|{k['d']}|{mark[0]}|{mark[1]}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
