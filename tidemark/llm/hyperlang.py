"""Language identification with hyperdimensional n-gram profiles.

Each letter has a random +1/-1 vector, made from its code point alone.  A
trigram's vector binds its letters: the first rotated by two places, the second
by one, multiplied element by element with the third.  A text's vector bundles
(adds) the vectors of its trigrams, a language's prototype bundles those of all
its training texts, and a text goes to the prototype with the largest cosine.

Counting trigrams first makes bundling a product of a small count matrix with
the vectors of the trigrams at hand; the sum is the same.

Defined results: null texts and texts without a letter are ``und`` with score
0, as are all texts if nothing could be learned; ties go to the language first
in alphabetical order; training rows with a null language or text teach
nothing; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import fresh, releasing, small_batches, staged, table

DIM = 1024
ROWS, CHUNK = 96, 256 << 10
#: More languages than this are refused: their prototypes are collected and sent to every task.
MOST_LANGUAGES = 4096
_TOP = 0x110000


@functools.cache
def _letters() -> np.ndarray:
    """Code point -> lower-cased letter's code point, or 0 for what is no letter."""
    out = np.zeros(_TOP, np.uint32)
    for i in range(_TOP):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, three columns of letters, which distinct trigram) of the trigrams inside words; 0 stands for a word's border.

    Returns row of each trigram, the distinct trigrams (n x 3) and each one's number.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    letters = _letters()[points]
    letters = np.append(np.insert(letters, begins[:-1], 0), np.uint32(0))
    row = np.append(np.repeat(np.arange(len(offsets) - 1), np.diff(begins) + 1), len(offsets) - 2)
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    letters, row = letters[keep], row[keep]
    if len(letters) < 3:
        return np.zeros(0, np.int64), np.zeros((0, 3), np.uint32), np.zeros(0, np.int64)
    seen = np.zeros(_TOP, bool)
    seen[letters] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(_TOP, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    x, n = number[letters], len(alphabet)
    middle = letters[1:-1] != 0
    code = ((x[:-2] * n + x[1:-1]) * n + x[2:])[middle]
    if n**3 <= 1 << 20:
        present = np.zeros(n**3, bool)
        present[code] = True
        distinct = np.flatnonzero(present)
        rank = np.zeros(n**3, np.int64)
        rank[distinct] = np.arange(len(distinct))
        which = rank[code]
    else:
        distinct, which = np.unique(code, return_inverse=True)
    columns = np.stack((alphabet[distinct // (n * n)], alphabet[distinct // n % n], alphabet[distinct % n]), axis=1)
    return row[1:-1][middle], columns, which


@functools.cache
def _letter_vector(point: int, dim: int) -> np.ndarray:
    bits = np.unpackbits(tk.stream(0x1A96 + point * 0x10001, dim // 64).view(np.uint8))
    return bits.astype(np.float32) * 2 - 1


def trigram_vectors(columns: np.ndarray, dim: int) -> np.ndarray:
    """The bound vector of each trigram."""
    points, at = np.unique(columns, return_inverse=True)
    base = np.stack([_letter_vector(int(p), dim) for p in points])
    at = at.reshape(columns.shape)
    out = np.roll(base, 2, axis=1)[at[:, 0]]
    out *= np.roll(base, 1, axis=1)[at[:, 1]]
    out *= base[at[:, 2]]
    return out


def bundles(data: np.ndarray, offsets: np.ndarray, dim: int) -> np.ndarray:
    """A row's bundled vector for each text; zeros without a letter."""
    n = len(offsets) - 1
    row, columns, which = trigrams(data, offsets)
    if not len(row):
        return np.zeros((n, dim), np.float32)
    counts = np.bincount(row * len(columns) + which, minlength=n * len(columns)).reshape(n, -1).astype(np.float32)
    return counts @ trigram_vectors(columns, dim)


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for a, b in tk.row_chunks(offsets, CHUNK):
        for i in range(a, b, ROWS):
            yield i, min(b, i + ROWS)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """(languages, their prototypes) from all rows with a language: one vector a language."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = tk.string_buffers(batch.column(0))
            names, codes = np.unique(np.asarray(batch.column(1).to_pylist(), object).astype(str), return_inverse=True)
            for a, b in _chunks(offsets):
                row, columns, which = trigrams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if not len(row):
                    continue
                counts = np.bincount(codes[a:b][row] * len(columns) + which, minlength=len(names) * len(columns)).reshape(len(names), -1)
                used = np.flatnonzero(counts.any(axis=1))
                added = counts[used].astype(np.float32) @ trigram_vectors(columns, dim)
                for i, v in zip(used.tolist(), added.astype(np.float64)):
                    sums[names[i]] = sums.get(names[i], 0) + v
        for name, v in sums.items():
            yield pa.record_batch([pa.array([name] * dim), pa.array(np.arange(dim)), pa.array(v)], ["lang", "i", "v"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l")).where("t is not null and l is not null")
    sums = staged(rows.mapInArrow(releasing(learn), "lang string, i bigint, v double").groupBy("lang", "i").agg(F.sum("v").alias("v")), "prototypes")
    if sums.count() > MOST_LANGUAGES * dim:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: their prototypes do not fit the driver")
    found = sums.collect()  # languages x dim numbers
    names = sorted({r["lang"] for r in found})
    protos = np.zeros((len(names), dim))
    place = {x: i for i, x in enumerate(names)}
    for r in found:
        protos[place[r["lang"]], r["i"]] = r["v"]
    return names, protos


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the cosine, from 0 to 1) behind its own columns."""
    small_batches(docs.sparkSession)
    names, protos = model
    norms = np.linalg.norm(protos, axis=1, keepdims=True)
    unit = (protos / np.where(norms > 0, norms, 1)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((names, unit))
    dim = protos.shape[1]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, unit = shared.value
        known = pa.array([*names, "und"])
        for batch in batches:
            data, offsets = tk.string_buffers(batch.column(batch.num_columns - 1))
            best, score = np.full(batch.num_rows, len(names)), np.zeros(batch.num_rows)
            for a, b in _chunks(offsets):
                vectors = bundles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], dim)
                size = np.linalg.norm(vectors, axis=1)
                if not len(names) or not size.any():
                    continue
                cosine = (vectors @ unit.T) / np.where(size > 0, size, 1)[:, None]
                best[a:b] = np.where(size > 0, cosine.argmax(axis=1), len(names))
                score[a:b] = np.where(size > 0, np.clip(cosine.max(axis=1), 0, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], known.take(pa.array(best)), pa.array(score)], schema=out)

    kept = docs.select("*", F.col(f"`{text}`").cast("string").alias(fresh(docs, "t")[0]))
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    kept = kept.drop("lang_pred", "score") if len(fields) != len(docs.schema.fields) else kept
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = to_arrow_schema(schema)
    return kept.mapInArrow(releasing(label), schema)


def in_training(key) -> "F.Column":
    """The contract's split: the checksum of the id's text, modulo 4, is not 2."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) != 2


def op8_hyperdimensional_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: learn from three quarters of the documents, label all."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(in_training(F.col("doc_id"))))
    held = docs.select("doc_id", "text", F.coalesce(~in_training(F.col("doc_id")), F.lit(True)).alias("held_out"))
    return predict(held, model).select("doc_id", "held_out", "lang_pred", "score")
