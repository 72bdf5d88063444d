"""Free-text repair: noise, mixed alphabets, model codes."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cyrillic letters and the Latin letters they look like.
HOMOGLYPHS = {
    "А": "A",
    "В": "B",
    "С": "C",
    "Е": "E",
    "Н": "H",
    "І": "I",
    "Ј": "J",
    "К": "K",
    "М": "M",
    "О": "O",
    "Р": "P",
    "Ѕ": "S",
    "Т": "T",
    "Х": "X",
    "Ү": "Y",
    "а": "a",
    "в": "b",
    "с": "c",
    "е": "e",
    "н": "h",
    "і": "i",
    "к": "k",
    "м": "m",
    "о": "o",
    "р": "p",
    "т": "t",
    "х": "x",
}

# What other Cyrillic letters mean inside a model code.
MODEL_LETTERS = {
    "Б": "B",
    "Г": "G",
    "Д": "D",
    "З": "Z",
    "И": "I",
    "Й": "I",
    "Л": "L",
    "П": "P",
    "У": "U",
    "Ф": "F",
    "Ц": "C",
    "Э": "E",
    "Ы": "Y",
    "Ь": "",
    "Ъ": "",
}

# Characters that become a space.
NOISE = "[\"'«»`()\\[\\]{}]"
SEPARATORS = r"[\s/,;+\-_.]+"

_LATIN, _CYRILLIC = "[A-Za-z]", "[Ѐ-ӿ]"


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None else unicodedata.normalize("NFKC", v))


def compatible(text: Column) -> Column:
    """Unicode compatibility form.  ASCII and basic Cyrillic are already in it, so only other rows would need the function; the engine still evaluates one Arrow pass."""
    return _nfkc(text)


def clean(text: Column, fold_width: bool = True) -> Column:
    """Noise and separators to single spaces, trimmed, upper case; null gives the empty text.

    ``fold_width`` False leaves the compatibility form out and stays inside the
    JVM, for input that is known to be ASCII, Latin-1 letters or Cyrillic.
    """
    t = F.coalesce(text, F.lit(""))
    t = compatible(t) if fold_width else t
    t = F.regexp_replace(F.regexp_replace(t, NOISE, " "), "(?U)" + SEPARATORS, " ")
    return F.upper(F.trim(t))


def _count(token: Column, pattern: str) -> Column:
    return F.regexp_count(token, F.lit(pattern))


def _replaced(token: Column, table: dict[str, str]) -> Column:
    """Every letter by the table's; letters with an empty replacement go."""
    kept = [k for k, v in table.items() if v]
    gone = [k for k, v in table.items() if not v]
    return F.translate(token, "".join(kept + gone), "".join(table[k] for k in kept))


def defuse_homoglyphs(text: Column) -> Column:
    """Look-alikes to Latin in the tokens that are mostly but not only Latin."""
    fix = lambda t: F.when((_count(t, _CYRILLIC) > 0) & (_count(t, _LATIN) > _count(t, _CYRILLIC)), _replaced(t, HOMOGLYPHS)).otherwise(t)
    return F.array_join(F.transform(F.split(text, " "), fix), " ")


def script_of(token: Column) -> Column:
    """latin, cyrillic, mixed or none."""
    latin, cyrillic = _count(token, _LATIN) > 0, _count(token, _CYRILLIC) > 0
    return F.when(latin & cyrillic, "mixed").when(latin, "latin").when(cyrillic, "cyrillic").otherwise("none")


def script_mixed(text: Column) -> Column:
    """Whether some token mixes alphabets."""
    return F.exists(F.split(text, " "), lambda t: (_count(t, _LATIN) > 0) & (_count(t, _CYRILLIC) > 0))


def normalize_model(model: Column, words: dict[str, str] | None = None) -> Column:
    """Known words by their canonical form; tokens with a digit or of one letter get Latin letters."""
    letters = MODEL_LETTERS | {k: v for k, v in HOMOGLYPHS.items() if k not in MODEL_LETTERS}
    lookup = F.create_map(*[F.lit(x) for pair in (words or {}).items() for x in pair]) if words else None

    def one(t: Column) -> Column:
        code = F.when(t.rlike("[0-9]") | (F.length(t) == 1), _replaced(t, letters)).otherwise(t)
        return F.coalesce(F.element_at(lookup, t), code) if lookup is not None else code

    return F.when(model.isNull() | (model == ""), model).otherwise(F.array_join(F.transform(F.split(model, " "), one), " "))
