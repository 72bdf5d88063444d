"""Token ids as canonical, length-limited Huffman codes in independent blocks.

Two passes over the text.  The first counts ids over the whole corpus (word
counts times the ids of each distinct word); the counts, at most one per
vocabulary entry, give a canonical code by package-merge.  The second deals
the documents out by ranges of the key, tokenises them in key order and writes
blocks: whole documents, closed once a block has ``block_ids`` ids, with a bit
offset every ``STRIDE`` ids.  Any block decodes alone; its lanes (one for each
bit offset) decode side by side with a table of 2**``max_bits`` entries.

File format (a Parquet dataset, so any store that Spark reaches will do):

``blocks/``  part int, block int, start_in_part long, n_ids long, doc_ids, doc_lens
             (arrays), payload binary (codes, most significant bit first),
             marks binary (little-endian u32 bit offsets)
``code/``    id int, bits int: the canonical code is rebuilt from the lengths

Defined results: a null or empty text has the end id alone; documents with a
null key come first; rows that repeat a key stay separate, ordered by a hash of
their text;
an empty table gives an empty dataset; further columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import keyed_text, releasing, settings, table, work_path

STRIDE = 128
CHUNK = 2 << 20
CACHE = 800_000
#: Unknown units in one text for the tokenizer: longer ones cost it more a unit.
TOGETHER = 2000
#: Texts and blocks pass in small steps: so many rows of a usual batch take an executor some hundred MB of buffers.
STEP_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20)}
STEP_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "256"}
#: Blocks in a row group, of which a reader takes one at a time.
GROUP = 8


def _kinds() -> np.ndarray:
    """Byte -> 0 white space, 1 letter, 2 digit, 3 punctuation, 4 anything that needs the whole word."""
    out = np.full(256, 4, np.uint8)
    out[[*range(0x09, 0x0E), 0x20]] = 0
    out[0x21:0x7F] = 3
    out[0x30:0x3A] = 2
    out[0x41:0x5B] = out[0x61:0x7B] = 1
    out[[0x27, 0x3C]] = 4  # contractions; special tokens start with "<"
    return out


class TextEncoder:
    """Ids of texts by way of their pre-tokens, kept by hash for as long as a worker lives.

    The tokenizer lower-cases, drops white space and joins nothing across it,
    so a text's ids are its words' ids in order.  Words of ASCII and Latin
    letters, digits and punctuation are cut where the pre-tokeniser cuts them
    (runs of letters, single digits, runs of other characters); a word with
    anything else is looked up whole.
    """

    _one: dict[str, "TextEncoder"] = {}
    _kind = _kinds()
    _kind_of = _kind.tobytes()
    _lower = tk.ByteClass(_kind != 0, lower=True)

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.ends_word[i] = piece.endswith("</w>")
        self.clear()

    @classmethod
    def at(cls, path: str) -> "TextEncoder":
        if path not in cls._one:
            cls._one[path] = cls(path)
        return cls._one[path]

    def clear(self) -> None:
        self.slots = tk.HashTable((2 * CACHE).bit_length())  # the whole cache fits without growing
        self.ids, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)  # of each slot: whether it was found since room was made

    def make_room(self) -> None:
        """Drops what was not found again since the last time; everything, if that leaves more than half of CACHE."""
        used = np.flatnonzero(self.slots.keys)
        used = used[self.again[self.slots.values[used]]]
        hashes, old = self.slots.keys[used], self.slots.values[used]
        ids, offsets = self.ids, self.offsets
        self.clear()
        if len(old) <= CACHE // 2:
            self.slots.add(hashes, np.arange(len(old)))
            self.ids, lens = gather(ids, offsets, old)
            self.offsets = np.concatenate(([0], np.cumsum(lens)))
            self.again = np.zeros(len(old), bool)

    def units(self, data: np.ndarray, offsets: np.ndarray):
        """(start, end, row, looked up whole) of the units of the rows."""
        kind = np.frombuffer(bytearray(data.tobytes()).translate(self._kind_of), np.uint8)
        none = np.zeros(0, np.int64)
        if not kind.any():
            return none, none, none, np.zeros(0, bool)
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
        if len(lead):  # U+00C0 to U+017F are letters but for two signs; U+0130 lower-cases to two characters
            point = data[lead + 1].astype(np.int64) + (data[lead].astype(np.int64) << 8)
            lead = lead[~np.isin(point, (0xC397, 0xC3B7, 0xC4B0))]
            kind[lead] = kind[lead + 1] = 1
        # a change of kind is a cut, in a word and at its borders; so are single digits and the rows' borders
        cut = np.empty(len(data), bool)
        cut[0] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut[1:] |= kind[1:] == 2
        borders = offsets[1:-1]
        cut[borders[borders < len(data)]] = True
        begins = np.flatnonzero(cut)
        kinds = kind[begins]
        rows = np.searchsorted(begins, offsets[:-1])
        opens = np.empty(len(begins), bool)  # runs that start a word: behind white space or at a row's start
        opens[0] = True
        np.equal(kinds[:-1], 0, out=opens[1:])
        opens[rows[rows < len(begins)]] = True
        opens &= kinds != 0
        ends = np.append(begins[1:], len(data))
        row = np.repeat(np.arange(len(rows)), np.diff(np.append(rows, len(begins))))
        if (kinds == 4).any():
            used = np.flatnonzero(kinds)
            first = np.flatnonzero(opens[used])
            whole = np.bitwise_or.reduceat(kinds[used] == 4, first)
            size = np.diff(np.append(first, len(used)))
            ends[used[first]] = np.where(whole, ends[used[first + size - 1]], ends[used[first]])
            inner = np.repeat(whole, size)
            keep = ~inner | opens[used]
            return begins[used[keep]], ends[used[keep]], row[used[keep]], inner[keep]
        used = np.flatnonzero(kinds)
        return begins[used], ends[used], row[used], np.zeros(len(used), bool)

    def _encode(self, raw: bytes, start: list[int], end: list[int], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of units: the plain ones many to a text, told apart by their last pieces."""
        run = self.tokenizer.encode_batch_fast
        sizes = np.zeros(len(start), np.int64)
        parts: list = [None] * len(start)
        plain = np.flatnonzero(~whole)
        words = [raw[start[i] : end[i]] for i in plain.tolist()]
        texts = [b" ".join(words[i : i + TOGETHER]).decode("utf-8", "replace") for i in range(0, len(words), TOGETHER)]
        got = np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in run(texts, add_special_tokens=False))])
        lasts = np.flatnonzero(self.ends_word[got])
        if len(lasts) != len(plain):
            raise ValueError("a pre-token has no single last piece: this tokenizer does not mark word ends")
        sizes[plain] = np.diff(np.concatenate(([-1], lasts)))
        if not whole.any():
            return got, sizes
        rest = np.flatnonzero(whole)
        single = run([raw[start[i] : end[i]].decode("utf-8", "replace") for i in rest.tolist()], add_special_tokens=False)
        for i, x in zip(rest.tolist(), single):
            parts[i] = np.array(x.ids, np.uint32)
            sizes[i] = len(parts[i])
        for i, x in zip(plain.tolist(), np.split(got, lasts[:-1] + 1) if len(lasts) else []):
            parts[i] = x
        return np.concatenate(parts), sizes

    def lookup(self, data: np.ndarray, offsets: np.ndarray):
        """(row of each unit, number of each unit, ids of all slots, their offsets)."""
        start, end, row, whole = self.units(data, offsets)
        hashes = tk.word_hashes(data, start, end, self._lower)
        odd = np.flatnonzero(whole)
        if len(odd):
            hashes[odd] = tk.splitmix(tk.word_hashes(data, start[odd], end[odd], tk.SPACED_EXACT))
        slot = self.slots.find(hashes)
        unknown = np.flatnonzero(slot < 0)
        if len(unknown) and self.slots.count + len(unknown) > CACHE and self.slots.count and self.slots.count + len(np.unique(hashes[unknown])) > CACHE:
            self.again[np.delete(slot, unknown)] = True
            self.make_room()
            slot = self.slots.find(hashes)
            unknown = np.flatnonzero(slot < 0)
        self.again[slot if not len(unknown) else np.delete(slot, unknown)] = True
        if len(unknown):
            fresh, first, inverse = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            spots = unknown[first]
            ids, sizes = self._encode(data.tobytes(), start[spots].tolist(), end[spots].tolist(), whole[spots])
            base = len(self.offsets) - 1
            self.slots.add(fresh, np.arange(base, base + len(fresh)))
            self.ids = np.concatenate((self.ids, ids))
            self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(sizes)))
            self.again = np.concatenate((self.again, np.zeros(len(fresh), bool)))
            slot[unknown] = base + inverse
        return row, slot, self.ids, self.offsets


def gather(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated lists of ``rows`` and their lengths."""
    lens = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(offsets[rows] - (ends - lens), lens)], lens


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge; 0 for an id that never occurs."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit codes of {max_bits} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.float64)
    leaf_flags, packages = [], np.zeros(0)
    for _ in range(max_bits):
        merged = np.concatenate((weights, packages))
        rank = np.argsort(merged, kind="stable")
        leaf_flags.append(rank < n)
        merged = merged[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, bits = 2 * n - 2, np.zeros(n, np.uint8)
    for flags in reversed(leaf_flags):
        leaves = int(flags[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = bits
    return lengths


@dataclass
class Code:
    """Canonical code from lengths: ids of one length are numbered in ascending order."""

    lengths: np.ndarray
    max_bits: int

    def __post_init__(self):
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        bits = self.lengths[order].astype(np.int64)
        step = np.left_shift(np.int64(1), self.max_bits - bits)
        left = np.concatenate(([0], np.cumsum(step)[:-1])) if len(order) else np.zeros(0, np.int64)
        self.codes = np.zeros(len(self.lengths), np.uint32)
        self.codes[order] = (left >> (self.max_bits - bits)).astype(np.uint32)
        self._order, self._left, self._step = order, left, step

    def decode_table(self) -> np.ndarray:
        """For each ``max_bits`` bits: id * 32 + length."""
        out = np.zeros(1 << self.max_bits, np.uint32)
        body = np.repeat((self._order.astype(np.uint32) << np.uint32(5)) | self.lengths[self._order], self._step)
        out[: len(body)] = body
        return out


def encode_block(ids: np.ndarray, code: Code) -> tuple[bytes, bytes]:
    """(payload, marks) of a run of ids."""
    bits = code.lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    offsets = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    out = np.zeros(total // 32 + 3, np.uint32)
    for a in range(0, len(ids), 1 << 16):
        at, width = offsets[a : a + (1 << 16)], bits[a : a + (1 << 16)]
        # each code in 64 bits from its 32-bit word on; codes that start in one word share no bit, so their sum joins them
        code64 = code.codes[ids[a : a + (1 << 16)]].astype(np.uint64) << (64 - (at & 31) - width).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        sums, word = np.add.reduceat(code64, first), word[first]
        out[word] |= (sums >> np.uint64(32)).astype(np.uint32)
        out[word + 1] |= sums.astype(np.uint32)
    return out.astype(">u4").tobytes()[: (total + 7) // 8], offsets[::STRIDE].astype("<u4").tobytes()


def decode_block(payload: bytes, marks: bytes, n: int, decode_table: np.ndarray, max_bits: int) -> np.ndarray:
    """The ids of a block; each bit offset starts a lane, and lanes advance together."""
    if not n:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    window = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
    at = np.frombuffer(marks, "<u4").astype(np.int64)
    lanes = len(at)
    out = np.empty((STRIDE, lanes), np.uint32)
    shift = np.uint32(32 - max_bits)
    tail = n - (lanes - 1) * STRIDE
    for step in range(STRIDE):
        if step == tail:
            at = at[: lanes - 1]
            if not len(at):
                break
        entry = decode_table[(window[at >> 3] << (at & 7).astype(np.uint32)) >> shift]
        out[step, : len(at)] = entry >> np.uint32(5)
        at = at + (entry & np.uint32(31))
    return out.T.reshape(-1)[:n]


def count_ids(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(id, n): how often each id occurs in all texts; one row an id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = TextEncoder.at(tokenizer_path), np.zeros(1 << 16, np.int64)
        for batch in batches:
            data, offsets = tk.string_buffers(batch.column(0))
            for a, b in tk.row_chunks(offsets, CHUNK):
                part = offsets[a : b + 1] - offsets[a]
                _, form, ids, starts = encoder.lookup(data[offsets[a] : offsets[b]], part)
                times = np.bincount(form, minlength=len(starts) - 1)
                used = np.flatnonzero(times)
                flat, lens = gather(ids, starts, used)
                sums = np.bincount(flat, weights=np.repeat(times[used], lens))
                if len(sums) > len(total):
                    total = np.concatenate((total, np.zeros(len(sums) - len(total), np.int64)))
                total[: len(sums)] += sums.astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return docs.select("t").mapInArrow(releasing(count), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


_BLOCKS = "part int, block int, start_in_part bigint, n_ids bigint, doc_ids array<bigint>, doc_lens array<bigint>, payload binary, marks binary"


def write_encoded(docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, max_bits: int = 18, block_ids: int = 1 << 17) -> None:
    """Encodes every text with the tokenizer and writes the dataset described above to ``path``."""
    with settings(docs.sparkSession, STEP_BYTES | STEP_ROWS):
        _write_encoded(docs, path, tokenizer_path, key, text, end_id, max_bits, block_ids)


def _write_encoded(docs: DataFrame, path: str, tokenizer_path: str, key: str, text: str, end_id: int, max_bits: int, block_ids: int) -> None:
    spark = docs.sparkSession
    rows = keyed_text(docs, key, text)
    counted = count_ids(rows, tokenizer_path).collect()  # at most one row an id of the vocabulary
    n_docs = rows.count()
    counts = np.zeros(max([end_id, *(r["id"] for r in counted)]) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    counts[end_id] += n_docs
    lengths = code_lengths(counts, max_bits)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(lengths)  # one byte an id of the vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, code = TextEncoder.at(tokenizer_path), Code(shared.value, max_bits)
        held, doc_ids, doc_lens, n, block, start = [], [], [], 0, 0, 0

        def close():
            nonlocal held, doc_ids, doc_lens, n, block, start
            payload, marks = encode_block(np.concatenate(held), code)
            row = pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start]), pa.array([n]), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([doc_lens], pa.list_(pa.int64())), pa.array([payload], pa.binary()), pa.array([marks], pa.binary())],
                ["part", "block", "start_in_part", "n_ids", "doc_ids", "doc_lens", "payload", "marks"],
            )
            block, start = block + 1, start + n
            held, doc_ids, doc_lens, n = [], [], [], 0
            return row

        for batch in batches:
            keys = batch.column(0).to_pylist()
            data, offsets = tk.string_buffers(batch.column(1))
            for a, b in tk.row_chunks(offsets, CHUNK):
                row, form, ids, starts = encoder.lookup(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                flat, lens = gather(ids, starts, form)
                sizes = np.bincount(row, weights=lens, minlength=b - a).astype(np.int64)
                ends = np.cumsum(sizes)
                whole = np.insert(flat, ends, np.uint32(end_id)) if len(flat) else np.full(b - a, end_id, np.uint32)
                at = 0
                for i in range(b - a):  # documents, not words
                    size = int(sizes[i]) + 1
                    held.append(whole[at : at + size])
                    doc_ids.append(keys[a + i])
                    doc_lens.append(size)
                    at, n = at + size, n + size
                    if n >= block_ids:
                        yield close()
        if n:
            yield close()

    ordered = rows.withColumn("h", F.xxhash64("t"))  # rows that repeat a key have an order and can be dealt out too
    ordered.repartitionByRange("k", "h").sortWithinPartitions("k", "h").select("k", "t").mapInArrow(releasing(encode), _BLOCKS).write.option("parquet.block.row.count.limit", GROUP).parquet(f"{path}/blocks")


def read_encoded(spark: SparkSession, path: str, with_ids: bool = False, max_bits: int = 18) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, decoded from the files at ``path``."""
    for name, value in STEP_BYTES.items():  # stays set, since the rows are read later
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    code_rows = spark.read.parquet(f"{path}/code").collect()  # one row an id of the vocabulary
    lengths = np.zeros(max([0, *(r["id"] for r in code_rows)]) + 1, np.uint8)
    for r in code_rows:
        lengths[r["id"]] = r["bits"]
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row a partition
    before, total = {}, 0
    for r in sums:
        before[r["part"]], total = total, total + r["n"]
    shared = spark.sparkContext.broadcast((lengths, before))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, before = shared.value
        lookup = Code(lengths, max_bits).decode_table()
        for batch in batches:
            for r in range(batch.num_rows):
                one = {name: batch.column(i)[r].as_py() for i, name in enumerate(batch.schema.names)}
                ids = decode_block(one["payload"], one["marks"], one["n_ids"], lookup, max_bits).astype("<u4")
                ends = np.cumsum(one["doc_lens"])
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), one["doc_lens"])]
                first = before[one["part"]] + one["start_in_part"]
                columns = [pa.array(one["doc_ids"], pa.int64()), pa.array(first + ends - one["doc_lens"]), pa.array(one["doc_lens"], pa.int64()), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return blocks.select("part", "start_in_part", "n_ids", "doc_ids", "doc_lens", "payload", "marks").mapInArrow(releasing(decode), schema)


def op7_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: encode all documents, read the files back, report each document's place and checksum."""
    import public_tokenizers

    path = work_path(spark, "huffman")
    write_encoded(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_encoded(spark, path)
