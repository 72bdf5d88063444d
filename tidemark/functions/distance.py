"""Edit distance in which swapping two neighbours costs one (optimal string alignment)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def osa(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours, none inside another."""
    if a == b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    rows: list[list[int]] = [list(range(len(b) + 1))]
    for i in range(1, len(a) + 1):
        row = [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            best = rows[-1][j - 1] + (a[i - 1] != b[j - 1])
            best = min(best, rows[-1][j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and a[i - 2 : i] == b[j - 2 : j][::-1]:
                best = min(best, rows[-2][j - 2] + 1)
            row[j] = best
        rows = [rows[-1], row]
    return rows[-1][-1]


@F.pandas_udf(T.IntegerType())
def _osa_column(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple, int] = {}
    out = []
    for pair in zip(a, b):
        if pair[0] is None or pair[1] is None:
            out.append(None)
            continue
        if pair not in known:
            known[pair] = osa(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="Int32")


def osa_distance(a: Column, b: Column) -> Column:
    """The distance as a column; null if either side is.  Meant for distinct values that a length band has thinned out."""
    return _osa_column(a, b)


def similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty texts are alike."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - osa_distance(a, b) / longest)
