"""Near-duplicate groups by an LSH forest over MinHash signatures.

1.  Every document gets its set of distinct word shingles (64-bit hashes), a
    digest of the set and a signature of ``TREES * DEPTH`` minimum hashes.
    Documents with equal sets are one vertex (the smallest id) from here on.
2.  The forest: tree t orders all signatures by the values from position
    ``t * DEPTH`` on, around the end.  Rows whose first ``LEAST_DEPTH`` values
    nobody shares leave; the rest are dealt out by ranges of the order, so a
    region of any size splits evenly.  Candidates are the next ``NEIGHBOURS`` rows, those with the
    longest common prefix; depth thus adapts to how dense a region is.  The
    rows at range boundaries meet in a second small pass.
3.  Candidates whose signatures agree enough are confirmed on the full sets,
    and confirmed links make components.
4.  Where a region (a common prefix of 2, 4, 8 or 16 values in a tree) still
    holds several components, each of its members is compared with the
    region's hubs: the members that agree most with their neighbours, of the
    whole region and of each of ``LANES`` parts of it.  A star of near copies
    around one original is completed this way without pairing all its members.
5.  The rest exactly: a link that is still missing inside a region has an end
    outside the region's largest component.  These members are the query set of
    their region and meet all its members in blocks: pairs whose signatures
    agree enough are confirmed on their whole sets, and only links leave a task.
    Blocks bound what a task holds, whatever the region's size.

Signatures only choose candidates; every link is confirmed on whole sets.  Two
texts at the threshold share no region with a probability below 1e-5, and a pair
at the threshold agrees too little (five standard deviations) with one below
1e-6; apart from that no link between components is missed.  In a group whose
similarities lie around the threshold the last step takes time in proportion to
its members times those that belong to other components.

Defined results: a null or empty text has no shingles and links with nothing;
fewer words than a shingle make one shingle of them all; rows that repeat an id
are one vertex, so that their texts' groups are one; a row with a null id is
kept and links with nothing; an empty table gives no rows; further columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import drop_staged, keyed_text, releasing, staged, table
from .graph import components

TREES, DEPTH, LEAST_DEPTH, NEIGHBOURS, LANES = 12, 8, 2, 2, 4
SIZE = TREES * DEPTH
HEAD = 9  # bytes of an order before the signature
CHUNK = 2 << 20
#: A block of step 5: shingles of its query set, and rows that they meet.
QUERY_SHINGLES, MEMBERS = 1 << 20, 512
#: Ids up to this many are sent to the scan of the texts; more are joined by shuffle.
ID_LIMIT = 1_000_000
_MULTIPLY = tk.stream(0xF0E57, SIZE) | np.uint64(1)


def shingle_sets(keys: pa.Array, texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, sorted distinct shingle hashes) of every row of a batch."""
    data, offsets = tk.string_buffers(texts)
    for a, b in tk.row_chunks(offsets, CHUNK):
        piece, local = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        start, end, row = tk.word_spans(piece, local, tk.SPACED)
        hashes = tk.word_hashes(piece, start, end, tk.SPACED)
        bounds = np.searchsorted(row, np.arange(b - a + 1))
        for i in range(b - a):
            found = tk.shingle_hashes(hashes[bounds[i] : bounds[i + 1]], k)
            if len(found) > 1:
                found = np.sort(found)
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
            yield a + i, found


def signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """(16 bits of each minimum hash, a 64-bit number of each tree's first LEAST_DEPTH whole minimum hashes), most significant bytes first, so that bytes sort as values do."""
    least = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, (1 << 20) // SIZE)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), step):
            np.minimum(least, np.multiply.outer(_MULTIPLY, shingles[i : i + step]).min(axis=1), out=least)
        least = tk.splitmix(least)
        heads = np.zeros(TREES, np.uint64)
        for j in range(LEAST_DEPTH):
            heads = tk.splitmix(heads + least[j::DEPTH])
    return (least >> np.uint64(48)).astype(">u2").tobytes(), heads.astype(">u8").tobytes()


def signatures(rows: DataFrame, k: int) -> DataFrame:
    """k, n_shingles, d1, d2 (digest of the set), sig and heads of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes, digests, sigs, heads = np.zeros(n, np.int64), np.zeros((n, 2), np.int64), [None] * n, [None] * n
            with np.errstate(over="ignore"):
                for i, found in shingle_sets(batch.column(0), batch.column(1), k):
                    sizes[i] = len(found)
                    if len(found):
                        digests[i, 0] = np.sum(found, dtype=np.uint64).astype(np.int64)
                        digests[i, 1] = np.sum(tk.splitmix(found ^ np.uint64(0xABCDEF)), dtype=np.uint64).astype(np.int64)
                        sigs[i], heads[i] = signature(found)
            yield pa.record_batch([batch.column(0), pa.array(sizes), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(sigs, pa.binary()), pa.array(heads, pa.binary())], ["k", "n_shingles", "d1", "d2", "sig", "heads"])

    return rows.mapInArrow(releasing(sign), "k bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary, heads binary")


def _order_columns() -> list:
    """Of each tree: its number, the head's number, and the signature from the tree's first value on, around the end."""
    step = 2 * DEPTH
    return [F.concat(F.lit(bytes([t])), F.substring("heads", 1 + 8 * t, 8), F.substring("sig", 1 + t * step, 2 * SIZE), *([F.substring("sig", 1, t * step)] if t else [])) for t in range(TREES)]


def _same(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the signature values agree, row by row, of orders of one tree."""
    a, b = x[:, HEAD:].reshape(len(x), -1, 2), y[:, HEAD:].reshape(len(y), -1, 2)
    return (a == b).all(axis=2).sum(axis=1)


def _pairs(orders: np.ndarray, keys: np.ndarray, first_new: int = 0) -> list[np.ndarray]:
    """[a, b, same] of rows and their next neighbours with a common prefix; only pairs that end at or after first_new."""
    out = []
    for gap in range(1, NEIGHBOURS + 1):
        if len(keys) <= gap:
            break
        near = np.flatnonzero((orders[:-gap, :HEAD] == orders[gap:, :HEAD]).all(axis=1))
        near = near[near + gap >= first_new]
        if len(near):
            out.append(np.stack((keys[near], keys[near + gap], _same(orders[near], orders[near + gap])), axis=1))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = tk.string_buffers(column)
    return data.reshape(len(column), HEAD + 2 * SIZE)


def regions(reps: DataFrame) -> DataFrame:
    """(region, t, k, n_shingles): the regions, documents with one head in a tree, that hold several documents; numbers travel here, not signatures."""
    heads = [F.struct(F.xxhash64(F.lit(t), F.substring("heads", 1 + 8 * t, 8)).alias("region"), F.lit(t).alias("t")) for t in range(TREES)]
    places = reps.select("k", "n_shingles", F.explode(F.array(*heads)).alias("p")).select("p.region", "p.t", "k", "n_shingles")
    shared = staged(places.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("region"), "regions")
    out = staged(places.join(shared, "region", "left_semi"), "places")
    drop_staged(shared)
    return out


def neighbours(live: DataFrame) -> DataFrame:
    """(a, b, same): rows (k, sig, heads, trees) next to each other in one of their trees, with how many signature values agree."""
    mine = [F.when(F.array_contains("trees", t), order) for t, order in enumerate(_order_columns())]
    orders = live.select("k", F.explode(F.array_compact(F.array(*mine))).alias("ord"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tail_o, tail_k, opened = np.zeros((0, HEAD + 2 * SIZE), np.uint8), np.zeros(0, np.int64), False

        def made(pairs, edges):
            none = len(edges)
            a, b, s = pairs.T if len(pairs) else np.zeros((3, 0), np.int64)
            return pa.record_batch(
                [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(none, pa.int64())]) for x in (a, b, s)]
                + [pa.concat_arrays([pa.nulls(len(a), t), pa.array([e[i] for e in edges], t)]) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                ["a", "b", "same", "border", "at", "k", "ord"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            found = _matrix(batch.column(1))
            edges = []
            if not opened:
                opened = True
                edges = [(part, i, int(keys[i]), found[i].tobytes()) for i in range(min(NEIGHBOURS, len(keys)))]
            for a in range(0, len(keys), 1 << 14):
                o, k = np.concatenate((tail_o, found[a : a + (1 << 14)])), np.concatenate((tail_k, keys[a : a + (1 << 14)]))
                got = _pairs(o, k, len(tail_k))
                yield made(np.concatenate(got) if got else np.zeros((0, 3), np.int64), edges)
                edges, tail_o, tail_k = [], o[-NEIGHBOURS:].copy(), k[-NEIGHBOURS:].copy()
        if opened:
            yield made(np.zeros((0, 3), np.int64), [(part + 1, i - len(tail_k), int(tail_k[i]), tail_o[i].tobytes()) for i in range(len(tail_k))])

    walked = orders.repartitionByRange("ord", "k").sortWithinPartitions("ord", "k").mapInArrow(releasing(walk), "a bigint, b bigint, same bigint, border int, at int, k bigint, ord binary")
    walked = staged(walked, "neighbours")

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")  # the end of one range, then the start of the next
        o = np.frombuffer(b"".join(pdf["ord"]), np.uint8).reshape(len(pdf), -1)
        got = _pairs(o, pdf["k"].to_numpy(np.int64), int((pdf["at"] < 0).sum()))
        return pd.DataFrame(np.concatenate(got) if got else np.zeros((0, 3), np.int64), columns=["a", "b", "same"])

    inner = walked.where("a is not null").select("a", "b", "same")
    return inner.unionByName(walked.where("border is not null").select("border", "at", "k", "ord").groupBy("border").applyInPandas(across, "a bigint, b bigint, same bigint"))


def _with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose k is among ``ids``, without shuffling the texts while the ids are few."""
    return rows.join(F.broadcast(ids) if ids.limit(ID_LIMIT + 1).count() <= ID_LIMIT else ids, "k", "left_semi")


def shingle_table(rows: DataFrame, k: int) -> DataFrame:
    """k and its whole set, as sorted 64-bit hashes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, at, size = [], [], 0
            for i, x in shingle_sets(batch.column(0), batch.column(1), k):
                held.append(x.tobytes())
                at.append(i)
                size += len(held[-1])
                if size > 16 << 20:
                    yield pa.record_batch([batch.column(0).take(pa.array(at)), pa.array(held, pa.binary())], ["k", "shingles"])
                    held, at, size = [], [], 0
            yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), pa.array(held, pa.binary())], ["k", "shingles"])

    return rows.mapInArrow(releasing(sets), "k bigint, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) with 100 * intersection >= percent * union of the whole sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, xo), (y, yo) = tk.string_buffers(batch.column(2)), tk.string_buffers(batch.column(3))
            keep = []
            for i in range(batch.num_rows):
                p, q = np.frombuffer(x[xo[i] : xo[i + 1]].tobytes(), np.uint64), np.frombuffer(y[yo[i] : yo[i + 1]].tobytes(), np.uint64)
                if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                    continue
                both = np.sort(np.concatenate((p, q)))
                inter = int((both[1:] == both[:-1]).sum())
                if 100 * inter >= percent * (len(p) + len(q) - inter):
                    keep.append(i)
            if keep:
                yield pa.record_batch([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep))], ["a", "b"])

    left = sets.select(F.col("k").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("k").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(releasing(compare), "a bigint, b bigint")


def _hub_pairs(live: DataFrame, active: DataFrame, comps: DataFrame) -> DataFrame:
    """(a, b): members of a region with several components, and the region's hubs in other components."""
    members = active.join(comps, "k", "left").select("k", "score", F.coalesce("comp", "k").alias("comp")).join(live.select("k", "sig", "heads"), "k")
    members = staged(members, "members")
    orders = members.select("k", "comp", "score", F.explode(F.array(*_order_columns())).alias("ord"))
    lane = F.pmod(F.xxhash64("k"), F.lit(LANES)).cast("int")
    regions = orders.select("k", "comp", "score", F.explode(F.array(*[F.xxhash64(F.lit(d), F.substring("ord", 1, HEAD + 2 * d)) for d in (2, 4, 8, 16)])).alias("region"))
    hubs = regions.withColumn("lane", lane).groupBy("region", "lane").agg(F.max(F.struct("score", F.col("k").alias("h"), F.col("comp").alias("hc"))).alias("hub"), F.min("comp").alias("least"), F.max("comp").alias("most"))
    hubs = staged(hubs, "hubs")
    mixed = hubs.groupBy("region").agg(F.min("least").alias("l"), F.max("most").alias("m")).where("l <> m").select("region")
    hubs = staged(hubs.join(mixed, "region", "left_semi").select("region", "hub.h", "hub.hc"), "hubs")
    pairs = regions.join(hubs, "region").where("comp <> hc")
    return staged(pairs.select(F.least("k", "h").alias("a"), F.greatest("k", "h").alias("b")).distinct(), "pairs")


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray], dict[str, np.ndarray]]]:
    """(block, its queries, some of its members) of rows sorted by block and role; queries come before members."""

    def columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        out: dict[str, np.ndarray] = {}
        for i, name in enumerate(names):
            column = batch.column(i)
            if name in ("sig", "heads"):
                data, _ = tk.string_buffers(column)
                out[name] = data.reshape(batch.num_rows, -1)
            elif name == "shingles":
                data, offsets = tk.string_buffers(column)
                whole = data.tobytes()
                parts = np.empty(batch.num_rows, object)
                for j in range(batch.num_rows):
                    parts[j] = np.frombuffer(whole[offsets[j] : offsets[j + 1]], np.uint64)
                out[name] = parts
            else:
                out[name] = column.to_numpy(zero_copy_only=False)
        return out

    held: list[dict[str, np.ndarray]] = []
    queries: dict[str, np.ndarray] | None = None
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = columns(batch)
        keys = np.stack((x["region"], x["qb"].astype(np.int64), x["mb"].astype(np.int64), x["role"].astype(np.int64)))
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            part = {n: v[a:b] for n, v in x.items()}
            block = tuple(keys[:3, a].tolist())
            if block != now:
                now, held, queries = block, [], None
            if keys[3, a] == 0:
                held.append(part)
                continue
            if queries is None and held:
                queries, held = {n: np.concatenate([h[n] for h in held]) for n in held[0]}, []
            if queries is not None:
                for i in range(0, b - a, 512):
                    yield now, queries, {n: v[i : i + 512] for n, v in part.items()}


def _open_pairs(q: dict[str, np.ndarray], m: dict[str, np.ndarray], floor: int) -> np.ndarray:
    """Which (query, member) may be linked: other components, enough agreement, and this is the first tree whose region they share."""
    out = q["comp"][:, None] != m["comp"][None, :]
    out &= (q["k"][:, None] < m["k"][None, :]) | (m["is_query"] == 0)[None, :]  # two queries meet once
    i, j = np.nonzero(out)
    for a in range(0, len(i), 1 << 15):
        x, y = i[a : a + (1 << 15)], j[a : a + (1 << 15)]
        good = (q["sig"].view(">u2")[x] == m["sig"].view(">u2")[y]).sum(axis=1) >= floor
        earlier = q["heads"].view(">u8")[x] == m["heads"].view(">u8")[y]
        good &= earlier.argmax(axis=1) == q["t"][x]
        out[x, y] = good
    return out


def crowded(live: DataFrame, places: DataFrame, comps: DataFrame, floor: int) -> DataFrame:
    """Blocks of step 5 that hold candidates: a region's members outside its largest component (role 0) against all its members (role 1)."""
    labelled = staged(places.join(comps, "k", "left").select("region", "t", "k", "n_shingles", F.coalesce("comp", "k").alias("comp")), "labelled")
    sizes = labelled.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    sizes = sizes.groupBy("region").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.struct("n", "s", "comp")).alias("big"))
    # of at most NEIGHBOURS + 1 members every two were neighbours
    mixed = sizes.where((F.col("n") > NEIGHBOURS + 1) & (F.col("big.n") < F.col("n"))).select(
        "region",
        F.col("big.comp").alias("most"),
        F.ceil((F.col("s") - F.col("big.s")) / QUERY_SHINGLES).cast("int").alias("nq"),
        F.ceil(F.col("n") / MEMBERS).cast("int").alias("nm"),
    )
    members = labelled.join(staged(mixed, "mixed"), "region").withColumn("is_query", (F.col("comp") != F.col("most")).cast("int"))
    chance = F.xxhash64("k")
    as_member = F.transform(F.sequence(F.lit(0), F.col("nq") - 1), lambda i: F.struct(i.alias("qb"), F.pmod(chance, F.col("nm")).cast("int").alias("mb"), F.lit(1).alias("role")))
    as_query = F.transform(F.sequence(F.lit(0), F.col("nm") - 1), lambda i: F.struct(F.pmod(chance, F.col("nq")).cast("int").alias("qb"), i.alias("mb"), F.lit(0).alias("role")))
    dealt = members.select("region", "k", "t", "comp", "is_query", F.explode(F.when(F.col("is_query") == 1, F.concat(as_member, as_query)).otherwise(as_member)).alias("d"))
    names = ["region", "qb", "mb", "role", "k", "t", "comp", "is_query", "sig", "heads"]
    dealt = dealt.select("region", "d.*", "k", "t", "comp", "is_query").join(live.select("k", "sig", "heads"), "k").select(*names)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, wanted = None, None

        def made(role: int, x: dict[str, np.ndarray], some: np.ndarray, block: tuple) -> pa.RecordBatch:
            n = len(some)
            fixed = [np.full(n, block[0]), *(np.full(n, v, np.int32) for v in (*block[1:], role))]
            rest = [x[c][some] for c in ("k", "t", "comp", "is_query")]
            return pa.record_batch([*map(pa.array, fixed), *map(pa.array, rest), *(pa.array([r.tobytes() for r in x[c][some]], pa.binary()) for c in ("sig", "heads"))], names)

        last = None
        for block, q, m in _blocks(batches, names):
            if q is not queries:
                if queries is not None and wanted.any():
                    yield made(0, queries, np.flatnonzero(wanted), last)
                queries, wanted, last = q, np.zeros(len(q["k"]), bool), block
            found = _open_pairs(q, m, floor)
            wanted |= found.any(axis=1)
            if (some := np.flatnonzero(found.any(axis=0))).size:
                yield made(1, m, some, block)
        if queries is not None and wanted.any():
            yield made(0, queries, np.flatnonzero(wanted), last)

    return dealt.repartition("region", "qb", "mb").sortWithinPartitions("region", "qb", "mb", "role", "k").mapInArrow(releasing(keep), "region bigint, qb int, mb int, role int, k bigint, t int, comp bigint, is_query int, sig binary, heads binary")


def _missing_links(dealt: DataFrame, sets: DataFrame, floor: int, percent: int) -> DataFrame:
    """(a, b): of each query of the blocks a link to every component that one leads to."""
    names = ["region", "qb", "mb", "role", "k", "t", "comp", "is_query", "sig", "heads", "shingles"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, known = None, set()
        for _, q, m in _blocks(batches, names):
            if q is not queries:
                queries, known = q, set()
            found = _open_pairs(q, m, floor)
            n_m = np.array([len(x) for x in m["shingles"]])
            links = []
            for i in np.flatnonzero(found.any(axis=1)).tolist():
                mine = q["shingles"][i]
                for j in np.flatnonzero(found[i] & (100 * np.minimum(n_m, len(mine)) >= percent * np.maximum(n_m, len(mine)))).tolist():
                    if (i, int(m["comp"][j])) in known:
                        continue
                    other = m["shingles"][j]
                    spot = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                    both = int((mine[spot] == other).sum())
                    if 100 * both >= percent * (len(mine) + len(other) - both):
                        known.add((i, int(m["comp"][j])))
                        links.append((int(q["k"][i]), int(m["k"][j])))
            if links:
                yield pa.record_batch([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])

    rows = dealt.join(sets, "k").select(*names)
    return rows.repartition("region", "qb", "mb").sortWithinPartitions("region", "qb", "mb", "role", "k").mapInArrow(releasing(compare), "a bigint, b bigint")


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``comps`` (k, comp) after more links (a, b), a written table that is not read again."""
    if links.isEmpty():
        return comps
    out = staged(components(comps.select(F.col("k").alias("a"), F.col("comp").alias("b")).unionByName(links)), "components")
    drop_staged(links)
    drop_staged(comps)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; ``words`` to a shingle, linked from ``percent`` % Jaccard on."""
    rows = keyed_text(docs, key, text)
    signed = staged(signatures(rows, words), "signatures")
    groups = signed.where("n_shingles > 0 and k is not null").groupBy("d1", "d2", "n_shingles").agg(F.min(F.struct("k", "sig", "heads")).alias("first"), F.count(F.lit(1)).alias("n"))
    reps = staged(groups.select("d1", "d2", "n_shingles", "first.k", "first.sig", "first.heads", "n"), "representatives")

    places = regions(reps)
    live = staged(reps.select("k", "sig", "heads").join(places.groupBy("k").agg(F.collect_set("t").alias("trees")), "k"), "live")
    near = neighbours(live)
    near = staged(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "same").where(F.col("same") >= SIZE // 2).distinct(), "candidates")
    ends = near.select(F.col("a").alias("k"), "same").unionByName(near.select(F.col("b").alias("k"), "same"))
    active = staged(ends.groupBy("k").agg(F.avg("same").alias("score")), "active")
    sets = staged(shingle_table(_with_ids(rows, active.select("k")), words), "sets")
    floor = int(SIZE * (percent / 100 - 0.2))  # five standard deviations below the threshold
    links = staged(confirmed(near.where(F.col("same") >= floor).select("a", "b"), sets, percent), "links")
    comps = staged(components(links), "components")
    drop_staged(links)
    more = confirmed(_hub_pairs(live, active, comps).join(near.where(F.col("same") >= floor), ["a", "b"], "left_anti"), sets, percent)
    comps = _joined(comps, staged(more, "links"))
    dealt = staged(crowded(live, places, comps, floor), "crowded")
    if not dealt.isEmpty():
        own = staged(shingle_table(_with_ids(rows, staged(dealt.select("k").distinct(), "ids")), words), "sets")
        comps = _joined(comps, staged(_missing_links(dealt, own, floor, percent), "links"))
        drop_staged(own)
    drop_staged(dealt)
    for old in (sets, places, live, near, active):
        drop_staged(old)

    copies = staged(reps.where("n > 1").select("d1", "d2", "n_shingles", F.col("k").alias("rep")), "copies")
    # an id with several texts links their groups
    texts = signed.where("n_shingles > 0 and k is not null").select("k", F.struct("d1", "d2", "n_shingles").alias("d"))
    several = staged(texts.groupBy("k").agg(F.min("d").alias("x"), F.max("d").alias("y")).where("x <> y").select("k"), "several")
    if not several.isEmpty():
        theirs = signed.join(several, "k", "left_semi").where("n_shingles > 0").join(copies, ["d1", "d2", "n_shingles"])
        comps = _joined(comps, staged(theirs.select(F.col("k").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct(), "links"))
    drop_staged(reps)

    placed = signed.select("k", "d1", "d2", "n_shingles").join(copies, ["d1", "d2", "n_shingles"], "left").select("k", "n_shingles", F.coalesce("rep", "k").alias("rep"))
    placed = placed.join(comps.select(F.col("k").alias("rep"), "comp"), "rep", "left")
    component = F.coalesce("comp", "rep")
    return placed.select(F.col("k").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(F.col("k") == component, F.lit(True)).alias("kept"))


def op2_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all documents, shingles of four words, similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)
