"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` writes one row for each segment of about ``SEGMENT`` bytes of
text, as search engines do: sorted term hashes, and for each term its token
positions in the segment, delta-coded.  A segment holds whole documents, so no
posting list is longer than a segment and nothing is shuffled by term; a
passage that a third of all documents share costs each segment its own part.

Searches read the index once and take the test phrases in blocks of bounded
size against each segment.  The postings of two terms that are neighbours in a
phrase are intersected first, shifted by one, for all pairs at once; phrases
with a pair that is absent drop out, the rest start from the postings of their
rarest pair (a single word: from its own), shifted by its offset, and are
intersected with the other terms' postings, ``CANDIDATES`` places at a time.
Proximity searches start from a phrase's rarest term and keep the places that
have all its other terms near, the rarer ones first.

Defined results: null and empty texts have no words and no hits; a phrase whose
id is null marks words but is not counted among items; repeated ids count
once; rows that repeat a document id stay separate; an empty benchmark hits
nothing; further columns are not read.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import keyed_text, releasing, table, work_path

SEGMENT = 8 << 20
BLOCK_BYTES = 4 << 20
CANDIDATES = 1 << 20
_NO_ID = -(1 << 63)

_INDEX = "part int, seg int, docs binary, words binary, terms binary, freqs binary, postings binary"


def _planes(values: np.ndarray) -> bytes:
    """u32 values by byte significance, so that the codec squeezes the high bytes."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def build_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the positional index of all documents to ``path`` and returns its table."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seg = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = np.asarray(batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False), np.int64)
            data, offsets = tk.string_buffers(batch.column(1))
            for a, b in tk.row_chunks(offsets, SEGMENT):
                piece, local = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, row = tk.word_spans(piece, local, tk.ALNUM)
                hashes = tk.word_hashes(piece, start, end, tk.ALNUM)
                order = np.argsort(hashes, kind="stable")
                ranked = hashes[order]
                first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, np.int64)
                freqs = np.diff(np.append(first, len(ranked)))
                deltas = np.diff(order, prepend=0)
                deltas[first] = order[first]
                counts = np.bincount(row, minlength=b - a)
                yield pa.record_batch(
                    [pa.array([part], pa.int32()), pa.array([seg], pa.int32())] + [pa.array([x], pa.binary()) for x in (keys[a:b].astype("<i8").tobytes(), counts.astype("<u4").tobytes(), ranked[first].astype("<u8").tobytes(), _planes(freqs), _planes(deltas))],
                    ["part", "seg", "docs", "words", "terms", "freqs", "postings"],
                )
                seg += 1

    rows = keyed_text(docs, key, text)
    rows.mapInArrow(releasing(segments), _INDEX).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, number within it) of ``counts[i]`` members of each i."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def _pieces(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_spread`` in pieces of at most CANDIDATES members."""
    to = np.cumsum(counts)
    for a in range(0, int(to[-1]) if len(to) else 0, CANDIDATES):
        at = np.arange(a, min(a + CANDIDATES, int(to[-1])))
        which = np.searchsorted(to, at, side="right")
        yield which, at - (to - counts)[which]


class Segment:
    """One index row."""

    def __init__(self, row: dict):
        self.docs = np.frombuffer(row["docs"], "<i8")
        self.words = np.frombuffer(row["words"], "<u4").astype(np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(self.words)))
        self.length = int(self.bounds[-1])
        self._terms = np.frombuffer(row["terms"], "<u8")
        self._freqs = _unplanes(row["freqs"]).astype(np.int64)
        self._slots = np.concatenate(([0], np.cumsum(self._freqs)))
        self._deltas = _unplanes(row["postings"])

    def open(self, query_terms: np.ndarray) -> None:
        """Reads the postings of sorted query terms."""
        terms = self._terms
        at = np.searchsorted(terms, query_terms)
        at[at == len(terms)] = 0
        found = terms[at] == query_terms if len(terms) else np.zeros(len(query_terms), bool)
        #: of each query term: how often it occurs here, and where its postings start in ``positions``
        self.freq = np.where(found, self._freqs[at] if len(terms) else 0, 0)
        self.start = np.concatenate(([0], np.cumsum(self.freq)))
        which, within = _spread(self.freq)
        sums = np.cumsum(self._deltas[(self._slots[at][which] if len(terms) else which) + within].astype(np.int64))
        self.positions = sums - np.concatenate(([0], sums))[self.start[:-1]][which]
        #: the query term at each position, or -1: all shifted postings at once
        self.term_at = np.full(self.length, -1, np.int32)
        self.term_at[self.positions] = which

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, at, side="right") - 1

    def occurrences(self, phrases: "Phrases") -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, first position) of every exact occurrence, in pieces."""
        single = np.flatnonzero(phrases.sizes == 1)
        term = phrases.flat[phrases.begin[single]]
        for which, within in _pieces(self.freq[term]):
            yield single[which], self.positions[self.start[term[which]] + within]
        if self.length < 2 or not len(phrases.pairs):
            return
        # neighbouring terms inside a document: the intersection of the postings of every pair of the phrases
        left, right = self.term_at[:-1].astype(np.int64), self.term_at[1:]
        inside = (left >= 0) & (right >= 0)
        ends = self.bounds[1:-1]
        inside[ends[(ends > 0) & (ends < self.length)] - 1] = False
        spot = np.flatnonzero(inside)
        code = left[spot] * len(phrases.terms) + right[spot]
        pair = np.minimum(np.searchsorted(phrases.pairs, code), len(phrases.pairs) - 1)
        known = phrases.pairs[pair] == code
        spot, pair = spot[known], pair[known]
        spot = spot[np.argsort(pair, kind="stable")]
        pair_freq = np.bincount(pair, minlength=len(phrases.pairs))
        pair_start = np.cumsum(pair_freq) - pair_freq
        longer = np.flatnonzero(phrases.sizes > 1)
        flat_to = np.cumsum(phrases.sizes[longer])
        for a, b in tk.row_chunks(np.concatenate(([0], flat_to)), CANDIDATES):
            some = longer[a:b]
            owner, within = _spread(phrases.sizes[some] - 1)
            number = phrases.flat_pair[phrases.begin[some][owner] + within]
            freq = pair_freq[number]
            first = np.cumsum(phrases.sizes[some] - 1) - (phrases.sizes[some] - 1)
            least = np.minimum.reduceat(freq, first)
            rarest = np.flatnonzero(freq == least[owner])
            rarest = rarest[np.concatenate(([True], owner[rarest][1:] != owner[rarest][:-1]))]  # the first of each phrase
            for rank, nth in _pieces(least):
                which = some[rank]
                place = spot[pair_start[number[rarest[rank]]] + nth]
                at = place - within[rarest[rank]]
                doc = self.doc_of(place)
                fits = (at >= self.bounds[doc]) & (at + phrases.sizes[which] <= self.bounds[doc + 1])
                which, at, step = which[fits], at[fits], 0
                done: list[tuple[np.ndarray, np.ndarray]] = []
                while len(at):
                    same = self.term_at[at + step] == phrases.flat[phrases.begin[which] + step]
                    which, at, step = which[same], at[same], step + 1
                    ready = phrases.sizes[which] == step
                    if ready.any():
                        done.append((which[ready], at[ready]))
                        which, at = which[~ready], at[~ready]
                for found in done:
                    yield found

    def near(self, sets: "Sets", slop: int) -> Iterator[tuple[int, int, int]]:
        """(set, first position, size) of the shortest span from each first position that holds a set's words, at most ``slop`` words more than its item has."""
        if not len(sets.sizes) or not self.length:
            return
        freq = self.freq[sets.flat]
        least = np.minimum.reduceat(freq, sets.begin)
        alive = np.flatnonzero(least > 0)
        if not len(alive):
            return
        owner, within = _spread(sets.sizes[alive])
        flat = sets.flat[sets.begin[alive][owner] + within]
        flat = flat[np.lexsort((self.freq[flat], owner))]  # each set's terms, the rarest first
        begin = np.cumsum(sets.sizes[alive]) - sets.sizes[alive]
        wide = sets.words[alive] + slop
        span = self.length + 1
        keys = np.repeat(np.arange(len(self.freq)), self.freq) * span + self.positions
        for rank, nth in _pieces(self.freq[flat[begin]]):
            place = self.positions[self.start[flat[begin[rank]]] + nth]
            doc = self.doc_of(place)
            low = np.maximum(self.bounds[doc], place - wide[rank] + 1)
            high = np.minimum(self.bounds[doc + 1], place + wide[rank]) - 1
            for r in range(1, int(sets.sizes[alive].max())):
                more = sets.sizes[alive][rank] > r
                if not more.any():
                    break
                term = flat[np.where(more, begin[rank] + r, begin[rank])].astype(np.int64) * span
                spot = np.minimum(np.searchsorted(keys, term + low), len(keys) - 1)
                keep = ~more | ((keys[spot] >= term + low) & (keys[spot] <= term + high))
                rank, low, high = rank[keep], low[keep], high[keep]
            order = np.lexsort((low, rank))
            held: tuple[int, int, int] | None = None
            for w, lo, hi in zip(rank[order].tolist(), low[order].tolist(), high[order].tolist()):
                if held and held[0] == w and lo <= held[2] and self._one_doc(held[1], hi):
                    held = (w, held[1], max(held[2], hi))
                    continue
                if held:
                    yield from self._spans(*held, flat, begin, wide, alive, sets)
                held = (w, lo, hi)
            if held:
                yield from self._spans(*held, flat, begin, wide, alive, sets)

    def _one_doc(self, a: int, b: int) -> bool:
        return bool(np.searchsorted(self.bounds, a, side="right") == np.searchsorted(self.bounds, b, side="right"))

    def _spans(self, w: int, low: int, high: int, flat, begin, wide, alive, sets) -> Iterator[tuple[int, int, int]]:
        """The shortest spans from each first position between ``low`` and ``high``, by two pointers."""
        size = int(sets.sizes[alive[w]])
        wanted = set(flat[begin[w] : begin[w] + size].tolist())
        terms = self.term_at[low : high + 1].tolist()
        counts: dict[int, int] = {}
        last = 0  # terms[first:last] is held
        for first, t in enumerate(terms):
            while last < len(terms) and len(counts) < size:
                x = terms[last]
                if x in wanted:
                    counts[x] = counts.get(x, 0) + 1
                last += 1
            if len(counts) < size:
                return
            if t in wanted:
                if last - first <= wide[w]:
                    yield int(alive[w]), low + first, last - first
                counts[t] -= 1
                if not counts[t]:
                    del counts[t]


class Phrases:
    """A block of test phrases as windows of at most ``window`` words, or whole; equal ones are kept once.

    ``flat`` holds their term numbers one after another, ``flat_pair`` at each
    of them the number of the pair that it makes with the next.
    """

    def __init__(self, items: list[tuple[str | None, str]], window: int | None, with_sets: bool = False):
        self.terms, words, bounds = _tokens(items)
        self.ids = [None if k is None else str(k) for k, _ in items]
        n = np.diff(bounds)
        if window:
            size = np.minimum(n, window)
            owner, within = _spread(np.where(n > 0, n - size + 1, 0))
            start, size = bounds[:-1][owner] + within, size[owner]
            value = tk.splitmix(np.arange(1, len(self.terms) + 1, dtype=np.uint64))
            mixed = size.astype(np.uint64)
            with np.errstate(over="ignore"):
                for j in range(int(size.max(initial=0))):
                    here = np.flatnonzero(size > j)
                    mixed[here] = mixed[here] * np.uint64(0xA0761D6478BD642F) + value[words[start[here] + j]]
            _, first, at = np.unique(tk.splitmix(mixed), return_index=True, return_inverse=True)
        else:
            owner = np.flatnonzero(n > 0)
            start, size = bounds[:-1][owner], n[owner]
            first, at = _distinct([words[a : a + k].tobytes() for a, k in zip(start.tolist(), size.tolist())])
        self.sizes = size[first]
        which, within = _spread(self.sizes)
        self.flat = words[start[first][which] + within]
        self.begin = np.cumsum(self.sizes) - self.sizes
        order = np.lexsort((owner, at))
        self.owner, self.owner_at = owner[order], np.searchsorted(at[order], np.arange(len(first) + 1))
        codes = words[:-1].astype(np.int64) * len(self.terms) + words[1:]
        inner = np.ones(len(codes), bool)
        borders = bounds[1:-1]
        inner[borders[(borders > 0) & (borders < len(words))] - 1] = False
        pair_at = np.zeros(len(words), np.int32)  # of each word and the next in its item
        self.pairs, pair_at[:-1][inner] = np.unique(codes[inner], return_inverse=True)
        self.flat_pair = pair_at[start[first][which] + within]
        self.sets = Sets(words, bounds) if with_sets else None

    def owners(self, which: int) -> list[int]:
        return self.owner[self.owner_at[which] : self.owner_at[which + 1]].tolist()


class Sets:
    """The distinct terms of each item and its number of words; equal ones are kept once, items without words not at all."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        some = [i for i in range(len(bounds) - 1) if bounds[i] < bounds[i + 1]]
        parts = [np.unique(words[bounds[i] : bounds[i + 1]]) for i in some]
        words_of = np.diff(bounds)[some]
        first, at = _distinct([x.tobytes() + int(n).to_bytes(8, "little") for x, n in zip(parts, words_of)])
        self.sizes = np.array([len(parts[i]) for i in first], np.int64)
        self.words = words_of[first]
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([parts[i] for i in first]) if len(first) else np.zeros(0, np.int32)
        self._items: list[list[int]] = [[] for _ in first]
        for i, k in zip(some, at.tolist()):
            self._items[k].append(i)

    def owners(self, which: int) -> list[int]:
        return self._items[which]


def _distinct(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(where each distinct one comes first, the number of each one)."""
    seen: dict[bytes, int] = {}
    first, at = [], []
    for i, x in enumerate(parts):
        if x not in seen:
            seen[x] = len(first)
            first.append(i)
        at.append(seen[x])
    return np.array(first, np.int64), np.array(at, np.int64)


def _tokens(items: list[tuple[str | None, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct term hashes, the term number of every word, where each item's words begin)."""
    data, offsets = tk.string_buffers(pa.array([t for _, t in items], pa.large_string()))
    start, end, row = tk.word_spans(data, offsets, tk.ALNUM)
    terms, words = np.unique(tk.word_hashes(data, start, end, tk.ALNUM), return_inverse=True)
    return terms, words.ravel().astype(np.int32), np.searchsorted(row, np.arange(len(items) + 1))


def phrase_blocks(items: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """The test items in blocks of about ``block_bytes`` of text: what one search sends to the executors."""
    rows = items.select(F.col(f"`{key}`").cast("string").alias("k"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = -(-total // block_bytes)
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == b)
        yield [(r["k"], r["t"]) for r in part.collect()]


def _blocks(index: DataFrame, items: DataFrame, key: str, text: str, window: int | None, with_sets: bool) -> list:
    """The blocks of test phrases as broadcasts; the driver holds one at a time."""
    sc = index.sparkSession.sparkContext
    return [sc.broadcast(Phrases(block, window, with_sets)) for block in phrase_blocks(items, key, text)]


def _each(blocks: list) -> Iterator[Phrases]:
    """The blocks one after another; of several, a worker holds one at a time."""
    for shared in blocks:
        yield shared.value
        if len(blocks) > 1:
            shared.__dict__.pop("_value", None)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Segment]]:
    for batch in batches:
        for r in range(batch.num_rows):
            row = {name: batch.column(i)[r].as_py() for i, name in enumerate(batch.schema.names)}
            yield row, Segment(row)


def phrase_hits(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", window: int = 10, slop: int | None = None) -> DataFrame:
    """doc_id, n_words, runs (merged spans of hit words), item_ids, near_ids (of items whose words stand within ``slop``) of every document."""
    blocks = _blocks(index, items, key, text, window, slop is not None)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, segment in _segments(batches):
            n = len(segment.docs)
            covered = np.zeros(segment.length + 1, np.int32)
            names: dict[int, set] = {}
            close: dict[int, set] = {}
            for phrases in _each(blocks):
                segment.open(phrases.terms)
                for which, at in segment.occurrences(phrases):
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + phrases.sizes[which], -1)
                    for d, w in np.unique(np.stack((segment.doc_of(at), which)), axis=1).T.tolist():
                        names.setdefault(d, set()).update(phrases.ids[i] for i in phrases.owners(w))
                if slop is not None:
                    hits = {(w, a) for w, a, _ in segment.near(phrases.sets, slop)}
                    if hits:
                        w, a = np.array(sorted(hits)).T
                        for d, i in set(zip(segment.doc_of(a).tolist(), w.tolist())):
                            close.setdefault(d, set()).update(phrases.ids[x] for x in phrases.sets.owners(i))
            hit = np.cumsum(covered)[:-1] > 0
            edge = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
            cuts = segment.bounds[1:-1]  # runs end where their document ends
            cuts = cuts[(cuts > 0) & (cuts < len(hit))]
            both = np.unique(cuts[hit[cuts] & hit[cuts - 1]])
            starts = np.sort(np.concatenate((np.flatnonzero(edge == 1), both)))
            ends = np.sort(np.concatenate((np.flatnonzero(edge == -1), both)))
            run_doc = segment.doc_of(starts)
            run_at = np.searchsorted(run_doc, np.arange(n + 1))
            base = segment.bounds[run_doc]
            runs = pa.StructArray.from_arrays([pa.array((starts - base).astype(np.int32)), pa.array((ends - base).astype(np.int32))], ["s", "e"])
            lists = [pa.array([sorted(found[d] - {None}) if d in found else [] for d in range(n)], pa.list_(pa.string())) for found in (names, close)]
            yield pa.record_batch(
                [pa.array(segment.docs, mask=segment.docs == _NO_ID), pa.array(segment.words), pa.ListArray.from_arrays(pa.array(run_at.astype(np.int32)), runs), *lists],
                ["doc_id", "n_words", "runs", "item_ids", "near_ids"],
            )

    return index.mapInArrow(releasing(search), "doc_id bigint, n_words bigint, runs array<struct<s:int,e:int>>, item_ids array<string>, near_ids array<string>")


def phrase_matches(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", slop: int | None = None) -> DataFrame:
    """doc_id, item_id, start, size of every whole-phrase match.

    ``slop`` None: the words in order and adjacent.  ``slop`` n: the phrase's
    distinct words in any order inside at most that many words more than the
    phrase has; the shortest such span at each first word is returned.
    """
    blocks = _blocks(index, items, key, text, None, slop is not None)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, segment in _segments(batches):
            for phrases in _each(blocks):
                segment.open(phrases.terms)
                if slop is None:
                    found = ((w, a, int(phrases.sizes[w])) for which, at in segment.occurrences(phrases) for w, a in zip(which.tolist(), at.tolist()))
                    owners = phrases.owners
                else:
                    found, owners = sorted(set(segment.near(phrases.sets, slop))), phrases.sets.owners
                rows = []
                for w, a, size in found:
                    d = int(segment.doc_of(np.array([a]))[0])
                    rows += [(None if segment.docs[d] == _NO_ID else int(segment.docs[d]), phrases.ids[o], a - int(segment.bounds[d]), size) for o in owners(w)]
                    if len(rows) > 100_000:
                        yield _match_batch(rows)
                        rows = []
                yield _match_batch(rows)

    return index.mapInArrow(releasing(search), "doc_id bigint, item_id string, start bigint, size bigint")


def _match_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["doc_id", "item_id", "start", "size"])


def contamination(docs: DataFrame, benchmark: DataFrame, index_path: str, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = 10, slop: int | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near, item_ids, near_ids, runs of every document."""
    hits = phrase_hits(build_index(docs, index_path, key, text), benchmark, item_key, item_text, window, slop)
    ids = F.array_sort("item_ids")
    covered = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"])
    return hits.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        F.size("near_ids").cast("bigint").alias("n_near"),
        ids.alias("item_ids"),
        "near_ids",
        "runs",
    )


def op9_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all documents against all benchmark items: 10-word windows, and items with all their words within five words more."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), work_path(spark, "phrases"), slop=5)
    return out.drop("item_ids", "near_ids", "runs")
