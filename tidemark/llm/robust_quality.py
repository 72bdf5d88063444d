"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates per language and source.

Each text gives counts (words, characters in words, symbols, repeated lines,
words in repeated three-word windows).  Base rules come first.  For the rest a
vector of transformed statistics is compared with the estimates of its language
and source: mean and covariance of the ``SUPPORT`` share of rows with the least
distances, found by concentration steps from medians (each step takes the rows
below the group's distance quantile and computes their moments).  Each step is
a partial aggregation, so a source with a third of all rows is one small row a
task.  Groups under ``LEAST_ROWS`` rows use their language's estimate, or all
rows'.  A variance floor keeps statistics that are constant in a group (no
symbols at all, say) from turning trifles into outliers.

Defined results: null and empty texts have no words and fail the base rules;
null languages and sources are groups of their own; rows that repeat an id are
judged alike if their texts and groups are equal; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import drop_staged, small_batches, staged, table

CHUNK = 2 << 20
SUPPORT, STEPS, LEAST_ROWS = 0.6, 4, 50
#: So many groups (some 200 bytes each) are sent to every task; more are joined, each group in so many shares.
GROUP_LIMIT, SHARES = 100_000, 64
#: Squared distances above this are outliers: the chi-square quantile of 0.9999 for four dimensions.
CUT = 23.513
#: The statistics and the least standard deviation that counts for each.  One of the last two alone passes
#: the cut above some 40 % of repeated words or lines; labelled good documents reach 28 % and 33 %.
FLOORS = {"word_length": 0.05, "symbols": 0.06, "repeats": 0.145, "same_lines": 0.145}
NAMES = list(FLOORS)
#: Correlation of what the floors add: the words of repeated lines are repeated words and do not count twice.
TOGETHER = np.eye(4)
TOGETHER[2, 3] = TOGETHER[3, 2] = 0.5
_LINES = tk.ByteClass(np.arange(256) != 0x0A, lower=False)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row of a chunk."""
    n = len(offsets) - 1
    start, end, row = tk.word_spans(data, offsets, tk.SPACED_EXACT)
    words = np.bincount(row, minlength=n)
    hashes = tk.word_hashes(data, start, end, tk.SPACED_EXACT)
    repeated = np.zeros(n, np.int64)
    if len(hashes) > 2:
        with np.errstate(over="ignore"):
            window = tk.splitmix((hashes[:-2] * np.uint64(3) + hashes[1:-1]) * np.uint64(0xA0761D6478BD642F) + hashes[2:] + tk.splitmix(row[:-2].astype(np.uint64)))
        at = np.flatnonzero(row[:-2] == row[2:])
        _, which, times = np.unique(window[at], return_inverse=True, return_counts=True)
        first = at[times[which] > 1]
        hit = np.zeros(len(hashes), bool)
        for j in range(3):
            hit[first + j] = True
        repeated = np.bincount(row[hit], minlength=n)
    ls, le, lr = tk.word_spans(data, offsets, _LINES)
    filled = np.concatenate(([0], np.cumsum(tk.SPACED_EXACT.is_word[data])))
    real = filled[le] > filled[ls]
    ls, le, lr = ls[real], le[real], lr[real]
    lines = np.bincount(lr, minlength=n)
    with np.errstate(over="ignore"):
        keys = tk.splitmix(tk.word_hashes(data, ls, le, _LINES) + tk.splitmix(lr.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    return {
        "n_words": words,
        "word_chars": _sums((data & 0xC0) != 0x80, offsets) - _sums(~tk.SPACED_EXACT.is_word[data], offsets),
        "n_symbols": _sums(_SYMBOL[data], offsets),
        "n_dup_lines": lines - np.bincount(lr[first], minlength=n),
        "n_repeat_words": repeated,
        "n_lines": lines,
    }


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """k, lang, source and the counts of every row."""
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.string_buffers(batch.column(3))
            parts = [counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in tk.row_chunks(offsets, CHUNK)]
            if parts:
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64)) for c in columns]], ["k", "lang", "source", *columns])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(count, "k bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in columns))


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words).alias("word_length"),
        F.sqrt(F.col("n_symbols") / words).alias("symbols"),
        F.sqrt(F.col("n_repeat_words") / words).alias("repeats"),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("same_lines"),
    ]


def _distance() -> Column:
    """Squared Mahalanobis distance from m0.., with the precisions p00.."""
    d = [F.col(n) - F.col(f"m{i}") for i, n in enumerate(NAMES)]
    terms = [d[i] * d[j] * F.col(f"p{i}{j}") * (1 if i == j else 2) for i in range(len(d)) for j in range(i, len(d))]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


_PARAMS = "level int, lang string, source string, n bigint, " + ", ".join(f"m{i} double" for i in range(len(NAMES))) + ", " + ", ".join(f"p{i}{j} double" for i in range(len(NAMES)) for j in range(i, len(NAMES)))


def consistency(p: int, share: float) -> float:
    """The factor that makes the covariance of the central share of normal rows the whole one: share / P(chi2(p + 2) <= its quantile)."""

    def below(x: float, k: int) -> float:  # chi-square distribution for even degrees of freedom
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))

    low, high = 0.0, 200.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid, p) < share else (low, mid)
    return share / below(low, p + 2)


def precision(cov: np.ndarray) -> np.ndarray:
    """Inverse covariance with each variance raised to its floor."""
    floors = np.array(list(FLOORS.values())) ** 2
    lacking = np.sqrt(np.maximum(floors - np.maximum(np.diag(cov), 0), 0))
    wide = cov + np.outer(lacking, lacking) * TOGETHER
    return np.linalg.inv(0.95 * wide + 0.05 * np.diag(np.diag(wide)))


def _with_precision(moments: DataFrame, factor: float) -> DataFrame:
    """Parameters of each group from its moments s_i and q_ij over c rows."""
    p = len(NAMES)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                c = max(r["c"], 1)
                mean = np.array([r[f"s{i}"] / c for i in range(p)])
                cov = np.array([[r[f"q{min(i, j)}{max(i, j)}"] / c - mean[i] * mean[j] for j in range(p)] for i in range(p)]) * factor
                inv = precision(cov)
                out.append([r["level"], r["lang"], r["source"], r["n"], *mean, *[inv[i, j] for i in range(p) for j in range(i, p)]])
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _PARAMS.split(", ")])

    return moments.mapInPandas(solve, _PARAMS)


def _moments(used: Column) -> list[Column]:
    x = [F.when(used, F.col(n)) for n in NAMES]
    return [F.sum(x[i]).alias(f"s{i}") for i in range(len(x))] + [F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i in range(len(x)) for j in range(i, len(x))]


GROUP = ["level", "lang", "source"]


def _beside(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group's columns: sent to every task while the groups are few, else joined in salted shares."""
    if groups.limit(GROUP_LIMIT + 1).count() <= GROUP_LIMIT:
        return rows.join(F.broadcast(groups), keys)
    salted = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return rows.withColumn("__salt", F.pmod(F.xxhash64(*NAMES), F.lit(SHARES)).cast("int")).join(salted, [*keys, "__salt"]).drop("__salt")


def fit(vectors: DataFrame, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """Estimates for each (lang, source) of ``vectors``: own, its language's or all rows', by size."""
    levels = F.explode(F.array(F.struct(F.lit(0).alias("level"), F.col("lang").alias("l"), F.col("source").alias("s")), F.struct(F.lit(1).alias("level"), F.col("lang").alias("l"), F.lit("").alias("s")), F.struct(F.lit(2).alias("level"), F.lit("").alias("l"), F.lit("").alias("s"))))
    rows = vectors.select(levels.alias("g"), *NAMES).select("g.level", F.col("g.l").alias("lang"), F.col("g.s").alias("source"), *NAMES)
    middle = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(n, [0.25, 0.5, 0.75], 10000).alias(n) for n in NAMES])
    wide = [F.greatest((F.col(n)[2] - F.col(n)[0]) / 1.349, F.lit(f)) for n, f in FLOORS.items()]
    start = middle.select(*GROUP, "n", *[F.col(n)[1].alias(f"m{i}") for i, n in enumerate(NAMES)], *[(1 / (wide[i] * wide[i]) if i == j else F.lit(0.0)).alias(f"p{i}{j}") for i in range(len(NAMES)) for j in range(i, len(NAMES))])
    params = staged(start, "estimates")
    factor = consistency(len(NAMES), support)
    for _ in range(steps):
        placed = _beside(rows, params, GROUP).withColumn("d", _distance())
        bounds = staged(placed.groupBy(*GROUP).agg(F.percentile_approx("d", support, 10000).alias("bound")), "bounds")
        inner = _beside(rows, params.join(bounds, GROUP), GROUP).withColumn("used", _distance() <= F.col("bound"))
        after = staged(_with_precision(inner.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.count_if("used").alias("c"), *_moments(F.col("used"))), factor), "estimates")
        drop_staged(params)
        drop_staged(bounds)
        params = after
    rest = [c.split()[0] for c in _PARAMS.split(", ")[3:]]
    own = params.where("level = 0").select("lang", "source", F.struct(*rest).alias("own"))
    tongue = params.where("level = 1").select("lang", F.struct(*rest).alias("tongue"))
    row = params.where("level = 2").select(*rest).first()
    every = F.struct(*[F.lit(row[c] if row else None).cast(params.schema[c].dataType).alias(c) for c in rest])
    chosen = own.join(tongue, "lang").withColumn("every", every)
    best = F.when(F.col("own.n") >= LEAST_ROWS, F.col("own")).when(F.col("tongue.n") >= LEAST_ROWS, F.col("tongue")).otherwise(F.col("every"))
    return staged(chosen.select("lang", "source", best.alias("e")).select("lang", "source", "e.*"), "estimates")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed, distance (squared; null if the base rules decide) and kept of every row."""
    found = staged(statistics(docs, key, text, lang, source), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = found.withColumn("base_failed", failed).select("*", *_vector())
    estimates = fit(rows.where("not base_failed").select("lang", "source", *NAMES))
    good = _beside(rows.where("not base_failed"), estimates, ["lang", "source"]).withColumn("distance", _distance())
    out = good.select(*rows.columns, "distance").unionByName(rows.where("base_failed").withColumn("distance", F.lit(None).cast("double")))
    return out.select(F.col("k").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("distance") <= CUT)).alias("kept"), "distance")


def op3_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all documents."""
    return judge(table(spark, sf_dir, "documents"))
