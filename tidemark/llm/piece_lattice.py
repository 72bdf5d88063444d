"""SentencePiece segmentation by forward filtering and backward sampling over the piece lattice.

The lattice of a unit of text (a word with the spaces before it, or a run of
control characters) has an edge for every piece that matches at a place; a
character without a piece of its own passes through its bytes.  A piece of rank
r weighs (r + 2) ** -sharpness.  Forward sums run from the unit's start; each
segmentation is then drawn from the end back, an edge with the probability that
its own path sums give it.  Random numbers depend on the seed, the row's key, the unit's number in the row and
the step alone.  A draw is compared with shares of 2 ** -36 inside its node, so
that a row gets the same pieces in any partitioning, wherever its units are held.

A unit of more than ``LONG`` bytes (text without spaces) is cut at the places
that no edge crosses: its lattice falls into independent parts there, so the
distribution stays the same.  Parts that stay long are summed in the logarithms,
all of a chunk at once; those of more than ``HUGE`` bytes keep only their
forward sums and find their edges again block by block on the way back.

Forward sums are kept by distinct unit for as long as a task runs (bounded;
what does not fit is computed again).  Decoding joins the pieces' bytes; a
literal U+2581 goes through bytes, so the text comes back exactly.

Defined results: null and empty texts have no pieces; a null key counts as 0;
rows that repeat key and text get the same pieces; an empty table gives no
rows; further columns pass through unchanged.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import fresh, releasing, small_batches, table

CHUNK = 768 << 10
LONG, HUGE, PLACES = 64, 4096, 32 << 10
CACHE_EDGES = 2_000_000
#: New units summed at once.
UNITS = 8192
#: A share of a node in fixed point: 36 bits, behind the number of its node.
SHARE_BITS = 36
_ALL = tk.ByteClass(np.ones(256, bool), lower=False)
_SPACE = 0x20
_MARK = "▁"


class Lattice:
    """Pieces by hash and length, and the forward sums of the units seen so far."""

    _one: dict[tuple, "Lattice"] = {}

    def __init__(self, path: str, sharpness: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte_id = np.zeros(256, np.int32)
        self.bytes = [b""] * size
        normal: dict[bytes, int] = {}
        rank = np.zeros(size)
        for i in range(size):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.byte_id[value], self.bytes[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                raw = model.id_to_piece(i).replace(_MARK, " ").encode()
                self.bytes[i] = raw
                normal[raw] = i
                rank[i] = min(max(0.0, -model.get_score(i)), size)
        self.log_weight = -sharpness * np.log(rank + 2)
        self.byte_weight = -sharpness * math.log(size + 2)
        self.piece_of = normal
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum([len(b) for b in self.bytes])))
        self.longest = max(map(len, normal))
        self.edge_weight = self.log_weight.copy()
        self.edge_weight[self.byte_id] = self.byte_weight
        self._plant(normal)
        self.tilt = 5.0  # a factor for each byte: all segmentations of a unit have the same, so it only keeps sums in range
        self.clear()

    @classmethod
    def at(cls, path: str, sharpness: float) -> "Lattice":
        if (path, sharpness) not in cls._one:
            cls._one[path, sharpness] = cls(path, sharpness)
        return cls._one[path, sharpness]

    def _plant(self, pieces: dict[bytes, int]) -> None:
        """The tree of the pieces' bytes: the next node by node and byte (0: none), inner nodes first, and the piece that ends at a node (-1: none)."""
        number = {b"": 0}
        for raw in pieces:
            for n in range(1, len(raw)):
                number.setdefault(raw[:n], len(number))
        self.inner = len(number)
        for raw in pieces:
            number.setdefault(raw, len(number))
        used = sorted({raw[-1] for raw in number if raw})
        self.column = np.zeros(256, np.uint8)  # 0: a byte of no piece
        self.column[used] = np.arange(1, len(used) + 1)
        self.columns = len(used) + 1
        nodes = [raw for raw in number if raw]
        self.next = np.zeros(self.inner * self.columns, np.int32)
        spots = np.array([number[raw[:-1]] for raw in nodes], np.int64) * self.columns + self.column[[raw[-1] for raw in nodes]]
        self.next[spots] = [number[raw] for raw in nodes]
        self.ends_piece = np.full(len(number), -1, np.int32)
        self.ends_piece[[number[raw] for raw in pieces]] = list(pieces.values())

    def clear(self) -> None:
        self.end_node = tk.HashTable()
        self._key, self._back, self._piece = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self._entry = np.zeros(0, np.int32)  # of each node: its first edge
        self.held = self.nodes = 0

    @property
    def key(self) -> np.ndarray:
        return self._key[: self.held]

    @property
    def back(self) -> np.ndarray:
        return self._back[: self.held]

    @property
    def piece(self) -> np.ndarray:
        return self._piece[: self.held]

    def _hold(self, edges: int, nodes: int) -> None:
        """Room for so many edges and nodes in all."""
        if edges > len(self._key):
            room = max(edges, len(self._key) * 5 // 4)
            self._key, self._back, self._piece = (np.concatenate((x[: self.held], np.zeros(room - self.held, x.dtype))) for x in (self._key, self._back, self._piece))
        if nodes > len(self._entry):
            self._entry = np.concatenate((self._entry, np.zeros(max(nodes, len(self._entry) * 5 // 4) - len(self._entry), np.int32)))

    def edges(self, data: np.ndarray, unit_start: np.ndarray, unit_end: np.ndarray, before: int | None = None):
        """(from byte, to byte, piece, log weight) of all edges inside the units, which tile ``data``; of characters that start ``before`` a place, if given."""
        a, b, piece = self._edges(data, unit_start, unit_end, before)
        return a, b, piece, self.edge_weight[piece]

    def _edges(self, data: np.ndarray, unit_start: np.ndarray, unit_end: np.ndarray, before: int | None = None):
        limit = np.repeat(unit_end, unit_end - unit_start)
        lead = (data & 0xC0) != 0x80
        at = np.flatnonzero(lead)
        width = np.diff(np.append(at, len(data)))
        if before is not None:
            at, width = at[at < before], width[at < before]
        alone = np.zeros(len(data), bool)  # characters with a piece of their own
        found = []
        byte = self.column[data]
        live, node, room, wide = at, np.zeros(len(at), np.int32), limit[at] - at, width
        for n in range(1, self.longest + 1):
            more = np.flatnonzero((room >= n) & (node < self.inner))
            live, room, wide = live[more], room[more], wide[more]
            node = self.next[node[more].astype(np.int64) * self.columns + byte[live + (n - 1)]]
            more = np.flatnonzero(node)
            if not len(more):
                break
            live, room, wide, node = live[more], room[more], wide[more], node[more]
            piece = self.ends_piece[node]
            hit = np.flatnonzero(piece >= 0)
            begin, piece = live[hit], piece[hit]
            found.append((begin, begin + n, piece))
            alone[begin[wide[hit] == n]] = True
        own = alone[at]
        bare, count = at[~own], width[~own]
        spots = np.repeat(bare, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        found.append((spots, spots + 1, self.byte_id[data[spots]]))
        return [np.concatenate(x) for x in zip(*found)]

    def add(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Forward sums of new units of at most HUGE bytes: in the logarithms if one has more than LONG."""
        self._add(hashes, np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([len(p) for p in pieces]))

    def _add(self, hashes: np.ndarray, data: np.ndarray, ends: np.ndarray) -> None:
        """The same, for units that tile ``data``."""
        lens = np.diff(ends, prepend=0)
        begins = ends - lens
        count = np.arange(len(ends))
        a, b, piece = self._edges(data, begins, ends)
        # a unit of n bytes has the nodes 0..n; node numbers: begin + unit + place; edges go by end node, then piece
        size_bits, piece_bits = int(self.longest).bit_length(), len(self.bytes).bit_length()
        packed = ((b + np.repeat(count, lens)[a]) << (size_bits + piece_bits)) | (piece.astype(np.int64) << size_bits) | (b - a)
        packed.sort()
        b, piece = packed >> (size_bits + piece_bits), (packed >> size_bits) & ((1 << piece_bits) - 1)
        a = b - (packed & ((1 << size_bits) - 1))
        roots = begins + count
        own = np.repeat(roots, lens + 1)[b]  # the root of each edge's unit
        place, root = b - own, a == own
        total = len(data) + len(ends)
        widest = int(lens.max())
        order = np.argsort(place.astype(np.uint16) if widest < 1 << 16 else place, kind="stable")
        cuts = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=widest + 1)[1:])))
        start, end = a, b
        a, b, weight = a[order], b[order], self.edge_weight[piece[order]]  # by place, as the sums run
        if widest <= LONG:
            weight = np.exp(weight + self.tilt * (b - a))
            forward = np.zeros(total)
            forward[roots] = 1.0
            share = np.zeros(len(a))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                value = forward[a[lo:hi]] * weight[lo:hi]
                share[lo:hi] = value
                np.add.at(forward, b[lo:hi], value)
        else:
            forward = np.full(total, -np.inf)
            forward[roots] = 0.0
            share = np.zeros(len(a))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                value, to = forward[a[lo:hi]] + weight[lo:hi], b[lo:hi]
                first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
                top = np.maximum.reduceat(value, first)
                node = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(to))))
                share[lo:hi] = np.exp(value - np.where(np.isfinite(top), top, 0.0)[node])
                with np.errstate(divide="ignore"):
                    forward[to[first]] = np.where(np.isfinite(top), top, 0.0) + np.log(np.add.reduceat(share[lo:hi], first))
        by_end = np.empty(len(order))
        by_end[order] = share
        alive = np.flatnonzero(by_end > 0)
        a, b, piece, root, share = start[alive], end[alive], piece[alive], root[alive], by_end[alive]
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        size = np.diff(np.append(first, len(b)))
        within = self._shares(share, first, size)
        shift, at = self.nodes, self.held
        self._hold(at + len(b), shift + total + 1)
        new = slice(at, at + len(b))
        self._key[new] = ((b + shift) << SHARE_BITS) + within
        self._back[new] = np.where(root, -1, a + shift)
        self._piece[new] = piece
        self._entry[b[first] + shift] = first + at
        self.end_node.add(hashes, ends + count + shift)
        self.held += len(b)
        self.nodes += total + 1

    def _drawn(self, node: np.ndarray, share: np.ndarray) -> np.ndarray:
        """The edge of each node that holds the share: the first whose running sum is above it."""
        target = (node << SHARE_BITS) + share
        edge = self._entry[node]
        on = np.flatnonzero(self._key[edge] <= target)
        while len(on):
            edge[on] += 1
            on = on[self._key[edge[on]] <= target[on]]
        return edge

    @staticmethod
    def _shares(share: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Running sums of each node's shares in fixed point, from the node's own edges alone; the last is the whole."""
        out = np.zeros(len(share))
        total = np.zeros(len(first))
        for j in range(int(size.max(initial=0))):  # as many steps as a node has edges at most
            here = np.flatnonzero(size > j)
            total[here] += share[first[here] + j]
            out[first[here] + j] = total[here]
        fixed = np.floor(out / np.repeat(total, size) * 2.0**SHARE_BITS).astype(np.int64)
        fixed[first + size - 1] = 1 << SHARE_BITS
        return fixed

    def cut(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the parts of long units between the places that no edge crosses."""
        lens = end - start
        to = np.cumsum(lens)
        flat = np.concatenate([data[s:e] for s, e in zip(start.tolist(), end.tolist())])
        origin = np.repeat(start - (to - lens), lens)  # of each byte: its place in ``data`` less that in ``flat``
        crossed = np.zeros(len(flat) + 1, np.int32)
        for lo in range(0, len(flat), PLACES):  # edges of the characters that start in one block of places
            hi = min(lo + PLACES, len(flat))
            top = min(hi + self.longest, len(flat))
            own = slice(int(np.searchsorted(to, lo, side="right")), int(np.searchsorted(to, top - 1, side="right")) + 1)
            begins, ends = np.maximum((to - lens)[own], lo) - lo, np.minimum(to[own], top) - lo
            a, b, _, _ = self.edges(flat[lo:top], begins, ends, hi - lo)
            np.add.at(crossed, a + lo + 1, 1)
            np.add.at(crossed, b + lo, -1)
        free = np.cumsum(crossed)[:-1] == 0
        free &= (flat & 0xC0) != 0x80
        free[to - lens] = True
        places = np.flatnonzero(free)
        return (found := places + origin[places]), found + np.diff(np.append(places, len(flat)))

    def sample_huge(self, data: np.ndarray, draw) -> list[int]:
        """One part of more than HUGE bytes, in the logarithms; draw(step) gives the uniform numbers."""
        size = len(data)
        forward = np.full(size + 1, -np.inf)
        forward[0] = 0.0

        def ending(lo: int, hi: int):
            """The edges that end at the places lo + 1 .. hi, by their end, and where those of each place begin."""
            base = max(0, lo - self.longest)
            while base and (data[base] & 0xC0) == 0x80:
                base -= 1
            a, b, piece, weight = self.edges(data[base:hi], np.array([0]), np.array([hi - base]))
            own = np.flatnonzero(b + base > lo)
            own = own[np.lexsort((piece[own], b[own]))]
            a, b = a[own] + base, b[own] + base
            return a, piece[own], weight[own], np.searchsorted(b, np.arange(lo + 1, hi + 2))

        blocks = [(lo, min(lo + PLACES, size)) for lo in range(0, size, PLACES)]
        for lo, hi in blocks:
            a, _, weight, cuts = ending(lo, hi)
            for end in range(lo + 1, hi + 1):
                part = slice(cuts[end - lo - 1], cuts[end - lo])
                if part.start < part.stop:
                    terms = forward[a[part]] + weight[part]
                    top = terms.max()
                    forward[end] = top if top == -np.inf else top + math.log(np.exp(terms - top).sum())
        out, node, step = [], size, 0
        for lo, hi in reversed(blocks):
            a, piece, weight, cuts = ending(lo, hi)
            while node > lo:
                part = slice(cuts[node - lo - 1], cuts[node - lo])
                sums = np.cumsum(np.exp(forward[a[part]] + weight[part] - forward[node]))
                pick = min(int(np.searchsorted(sums, draw(step) * sums[-1], side="right")), len(sums) - 1)
                out.append(int(piece[part][pick]))
                node = int(a[part][pick])
                step += 1
        return out[::-1]

    def sample(self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of the rows' ids) for rows of text."""
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        full = np.flatnonzero(sizes)
        data = np.insert(data, offsets[full], _SPACE)  # the dummy prefix of rows with text
        offsets = np.concatenate(([0], np.cumsum(sizes + (sizes > 0))))
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        start, end, row = units(data, offsets)
        long = np.flatnonzero(end - start > LONG)
        if len(long):
            more_s, more_e = self.cut(data, start[long], end[long])
            start, end = np.sort(np.concatenate((np.delete(start, long), more_s))), np.sort(np.concatenate((np.delete(end, long), more_e)))
            row = np.searchsorted(offsets, start, side="right") - 1
        hashes = tk.word_hashes(data, start, end, _ALL)
        first_unit = np.searchsorted(row, np.arange(n))
        number = np.arange(len(start)) - first_unit[row]
        with np.errstate(over="ignore"):
            row_seed = tk.splitmix(keys.astype(np.int64).view(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
            unit_seed = tk.splitmix(row_seed[row] + number.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))

        def draws(s: np.ndarray, step: int) -> np.ndarray:
            with np.errstate(over="ignore"):
                return (tk.splitmix(s + np.uint64((step + 1) * 0xC2B2AE3D27D4EB4F & tk.MASK)) >> np.uint64(11)) * 2.0**-53

        size = end - start
        huge = np.flatnonzero(size > HUGE)
        if self.held > CACHE_EDGES:
            self.clear()
        node = np.full(len(start), -1, np.int64)
        for least, most in ((0, LONG), (LONG, HUGE)):
            some = np.flatnonzero((size > least) & (size <= most))
            known = self.end_node.find(hashes[some])
            unknown = np.flatnonzero(known < 0)
            if len(unknown):
                fresh, first = np.unique(hashes[some[unknown]], return_index=True)
                spots = some[unknown[first]]
                for lo in range(0, len(spots), UNITS):
                    some_new = spots[lo : lo + UNITS]
                    lens = size[some_new]
                    to = np.cumsum(lens)
                    self._add(fresh[lo : lo + UNITS], data[np.arange(int(to[-1])) + np.repeat(start[some_new] - (to - lens), lens)], to)
                known = self.end_node.find(hashes[some])
            node[some] = known
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        active = np.flatnonzero(size <= HUGE)
        state = node[active]
        while len(active):
            edge = self._drawn(state, (draws(unit_seed[active], len(steps)) * 2.0**SHARE_BITS).astype(np.int64))
            steps.append((active, self._piece[edge]))
            state = self._back[edge].astype(np.int64)
            going = state >= 0
            active, state = active[going], state[going]
        counts = np.zeros(len(start), np.int64)
        for who, _ in steps:
            counts[who] += 1
        slow = {}
        for u in huge.tolist():
            s = unit_seed[u : u + 1]
            slow[u] = self.sample_huge(data[start[u] : end[u]], lambda step, s=s: float(draws(s, step)[0]))
            counts[u] = len(slow[u])
        to = np.cumsum(counts)
        ids = np.empty(int(to[-1]), np.int32)
        for step, (who, pieces) in enumerate(steps):
            ids[to[who] - 1 - step] = pieces
        for u, found in slow.items():
            ids[to[u] - len(found) : to[u]] = found
        per_row = np.concatenate(([0], to))[np.append(first_unit, len(start))]
        return ids, per_row

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the rows' texts, without the dummy prefix."""
        lens = self.starts[ids + 1] - self.starts[ids]
        to = np.cumsum(lens)
        total = int(to[-1]) if len(to) else 0
        flat = self.flat[np.arange(total) + np.repeat(self.starts[ids] - (to - lens), lens)]
        ends = np.concatenate(([0], to))[offsets]
        filled = np.flatnonzero(np.diff(ends))
        flat = np.delete(flat, ends[filled])
        return flat, ends - np.concatenate(([0], np.cumsum(np.diff(ends) > 0)))


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the units, which tile the text: a unit starts where spaces start and where control characters start or end."""
    space, control = data == _SPACE, data < _SPACE
    begins = np.empty(len(data), bool)
    begins[0] = True
    begins[1:] = (space[1:] & ~space[:-1]) | (control[1:] != control[:-1])
    cuts = offsets[1:-1]
    begins[cuts[cuts < len(data)]] = True
    start = np.flatnonzero(begins)
    return start, np.append(start[1:], len(data)), np.searchsorted(offsets, start, side="right") - 1


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", seed: int = 0, sharpness: float = 1.0, with_ids: bool = True) -> DataFrame:
    """``docs`` with pieces (array<int>, if asked for), n_pieces, pieces_crc32 and lossless behind its own columns."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    made = ["pieces"] * with_ids + ["n_pieces", "pieces_crc32", "lossless"]
    fields = [f for f in docs.schema.fields if f.name not in made]
    schema = T.StructType([*fields, *([T.StructField("pieces", T.ArrayType(T.IntegerType()))] if with_ids else []), T.StructField("n_pieces", T.LongType()), T.StructField("pieces_crc32", T.LongType()), T.StructField("lossless", T.BooleanType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice.at(model_path, sharpness)
        for batch in batches:
            keys = np.asarray(batch.column(batch.num_columns - 2).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            data, offsets = tk.string_buffers(batch.column(batch.num_columns - 1))
            for a, b in tk.row_chunks(offsets, CHUNK):
                part, local = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                ids, per_row = lattice.sample(part, local, keys[a:b], seed)
                back, ends = lattice.decode(ids, per_row)
                if np.array_equal(ends, local) and np.array_equal(back, part):
                    same = np.ones(b - a, bool)
                else:
                    same = np.array([np.array_equal(back[ends[i] : ends[i + 1]], part[local[i] : local[i + 1]]) for i in range(b - a)])
                raw = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(per_row[:-1].tolist(), per_row[1:].tolist())]
                columns = [c.slice(a, b - a) for c in batch.columns[:-2]]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(per_row.astype(np.int32)), pa.array(ids)))
                columns += [pa.array(np.diff(per_row)), pa.array(crcs, pa.int64()), pa.array(same)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)], schema=arrow)
        lattice.clear()

    small_batches(docs.sparkSession)
    kept = docs.drop(*[m for m in made if m in docs.columns])
    k, t = fresh(docs, "k", "t")
    return kept.select("*", F.col(f"`{key}`").cast("bigint").alias(k), F.col(f"`{text}`").cast("string").alias(t)).mapInArrow(releasing(run), schema)


def decode(pieces: DataFrame, model_path: str, column: str = "pieces", out: str = "text") -> DataFrame:
    """``pieces`` with the text that its arrays of ids stand for; a null array gives an empty text."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [f for f in pieces.schema.fields if f.name != out]
    schema = T.StructType([*fields, T.StructField(out, T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice.at(model_path, 1.0)
        for batch in batches:
            texts = []
            for ids in batch.column(batch.num_columns - 1).to_pylist():
                ids = np.array(ids or [], np.int64)
                flat, _ = lattice.decode(ids, np.array([0, len(ids)]))
                texts.append(flat.tobytes().decode("utf-8"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, arrow.field(out).type)], schema=arrow)

    return pieces.drop(out).select("*", F.col(f"`{column}`").alias(fresh(pieces, "ids")[0])).mapInArrow(run, schema)


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: every document's sampled pieces as number and checksum, and whether they decode to the text."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False).select("doc_id", "n_pieces", "pieces_crc32", "lossless")
