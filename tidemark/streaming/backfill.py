"""Working through a timeline of published revisions: fetched ahead, folded in order, resumable after every one.

The loop runs over days, of which there are a few thousand at most; all rows
stay in Spark.  The ledger is the only memory: a run that is stopped or killed
goes on where it ended, failed revisions are tried again, and revisions before
the last folded day are reported and left alone, since a fold only goes forward.
"""

from __future__ import annotations

import json
import shutil
import time
import urllib.request
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.operators import fold
from tidemark.sources import json_snapshot, revisions
from tidemark.streaming.fold_stream import Folder

#: What needs no second look; ``failed`` is not among them.
SETTLED = ("folded", "duplicate", "skipped")


@dataclass
class Summary:
    """What a run did; ``behind`` are days that come before the last folded one, ``halted`` the day that stopped it."""

    total: int = 0
    folded: int = 0
    duplicate: int = 0
    skipped: int = 0
    failed: int = 0
    already: int = 0
    bytes_fetched: int = 0
    bytes_not_fetched: int = 0
    behind: list[str] = field(default_factory=list)
    halted: str | None = None

    @property
    def complete(self) -> bool:
        return self.folded + self.duplicate + self.skipped + self.failed >= self.total


def fetch_url(url: str, target: str, size: int | None = None) -> str:
    """Streams an address (http, https or file) to ``target``; its sha256."""

    def chunks() -> Iterator[bytes]:
        request = urllib.request.Request(url, headers={"User-Agent": "tidemark"})
        with urllib.request.urlopen(request, timeout=300) as answer:
            while block := answer.read(1 << 20):
                yield block

    return revisions.download(chunks, target, size or None)


def plan(folder: Folder, timeline: DataFrame, limit: int = 0) -> tuple[list[Row], Summary]:
    """The revisions still to do, by day and source, and a summary that says what is settled or too late."""
    settled = folder.ledger().where(F.col("status").isin(*SETTLED)).select("source", "snapshot_date")
    last = folder.ledger().where("status = 'folded'").agg(F.max("snapshot_date").cast("string")).first()[0]
    todo = revisions.pending(timeline, settled).orderBy("snapshot_date", "source").collect()  # a row a day
    behind = [r["snapshot_date"] for r in todo if last and r["snapshot_date"] < last]
    ahead = todo[len(behind) :]
    ahead = ahead[:limit] if limit else ahead
    return ahead, Summary(total=len(ahead), already=settled.count(), behind=behind)


def run(
    folder: Folder,
    timeline: DataFrame,
    work: str,
    fetch: Callable[[str, str, int | None], str] = fetch_url,
    lookahead: int = 2,
    limit: int = 0,
    halt: bool = True,
    progress: str | None = None,
) -> Summary:
    """Folds every pending revision of ``timeline``; ``work`` must be a folder that driver and executors share.

    Up to ``lookahead`` files are fetched while one is folded.  A revision with
    a reason to skip, or with a publisher's checksum that was folded before, is
    noted and not fetched.  A snapshot below the row floor is skipped.  Any
    other error is noted as failed, its file is kept under ``failed``, and with
    ``halt`` the run ends there, because folding on would close what the missing
    day held.  ``progress`` names a JSON file that is rewritten after every day.
    """
    todo, out = plan(folder, timeline, limit)
    Path(work).mkdir(parents=True, exist_ok=True)
    started = time.monotonic()
    with ThreadPoolExecutor(max_workers=max(1, lookahead)) as pool:
        for revision, fetched in _ahead(pool, todo, work, fetch, max(1, lookahead), folder, out):
            path, day = _path(work, revision), date.fromisoformat(revision["snapshot_date"])
            try:
                _one(folder, revision, day, path, fetched, out)
            except fold.TooSmall as e:
                out.skipped += 1
                folder.skip(revision["source"], day, "skipped", str(e)[:500])
            except Exception as e:  # noqa: BLE001 - whatever went wrong is noted in the ledger
                out.failed += 1
                folder.skip(revision["source"], day, "failed", f"{type(e).__name__}: {e}"[:500])
                _keep(path, Path(work, "failed"))
                if halt:
                    out.halted = revision["snapshot_date"]
                    break
            finally:
                path.unlink(missing_ok=True)
                _write(progress, out, started)
    for left in todo:
        _path(work, left).unlink(missing_ok=True)
    _write(progress, out, started)
    return out


def _path(work: str, revision: Row) -> Path:
    return Path(work, f"{revision['source']}_{revision['snapshot_date']}.json")


def _ahead(pool, todo: Iterable[Row], work: str, fetch, lookahead: int, folder: Folder, out: Summary) -> Iterator[tuple[Row, Future | None]]:
    """The revisions in order, with what fetches them: started early, but passed over if that proves needless by then."""
    waiting: deque[tuple[Row, Future | None]] = deque()
    rest = iter(todo)

    def start() -> None:
        while len(waiting) <= lookahead and (r := next(rest, None)) is not None:
            needless = r["skip_reason"] or folder.known_by_hash(r["api_hash"])
            waiting.append((r, None if needless else pool.submit(fetch, r["url"], str(_path(work, r)), r["size"])))

    try:
        start()
        while waiting:
            yield waiting.popleft()
            start()
    finally:
        for _, fetched in waiting:
            if fetched is not None:
                fetched.cancel()


def _one(folder: Folder, revision: Row, day: date, path: Path, fetched: Future | None, out: Summary) -> None:
    source, size = revision["source"], revision["size"]
    if revision["skip_reason"]:
        out.skipped += 1
        folder.skip(source, day, "skipped", revision["skip_reason"], size=size, api_hash=revision["api_hash"])
        return
    if seen := folder.known_by_hash(revision["api_hash"]):
        out.duplicate += 1
        out.bytes_not_fetched += (size or 0) if fetched is None else 0
        folder.skip(source, day, "duplicate", f"same checksum as {seen[0]} {seen[1]}", size=size, api_hash=revision["api_hash"])
        if fetched is not None:
            fetched.exception()  # it was under way when its twin was folded
        return
    digest = fetched.result()
    got = path.stat().st_size
    out.bytes_fetched += got
    with json_snapshot.snapshot(folder.spark, str(path)) as (raw, mode, repairs):
        done = folder.fold(raw, source, day, digest, mode, repairs, revision["api_hash"] or None, got)
    if done.status == "folded":
        out.folded += 1
    else:
        out.duplicate += 1


def _keep(path: Path, folder: Path) -> None:
    if path.exists():
        folder.mkdir(parents=True, exist_ok=True)
        shutil.move(str(path), str(folder / path.name))


def _write(progress: str | None, out: Summary, started: float) -> None:
    if progress:
        done = out.folded + out.duplicate + out.skipped + out.failed
        seconds = time.monotonic() - started
        more = {"done": done, "complete": out.complete, "elapsed_s": round(seconds, 1), "left_s": round(seconds / done * (out.total - done), 1) if done else None}
        part = Path(f"{progress}.part")
        part.write_text(json.dumps(asdict(out) | more), encoding="utf-8")
        part.replace(progress)
