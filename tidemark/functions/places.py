"""Region and kind of the unit that a free-text name stands for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The regions' adjectives.
REGIONS = (
    "Вінницька",
    "Волинська",
    "Дніпропетровська",
    "Донецька",
    "Житомирська",
    "Закарпатська",
    "Запорізька",
    "Івано-Франківська",
    "Київська",
    "Кіровоградська",
    "Луганська",
    "Львівська",
    "Миколаївська",
    "Одеська",
    "Полтавська",
    "Рівненська",
    "Сумська",
    "Тернопільська",
    "Харківська",
    "Херсонська",
    "Хмельницька",
    "Черкаська",
    "Чернівецька",
    "Чернігівська",
)

# Marks of units outside the regions, checked first.
MARKS = {
    "КИЄВ": "м. Київ",
    "СЕВАСТОПОЛ": "м. Севастополь",
    "СЕВАСТПОЛ": "м. Севастополь",
    "КРИМ": "Автономна Республіка Крим",
    "КРЫМ": "Автономна Республіка Крим",
}

# Kinds of units and the pattern of each, first match wins.
UNIT_KINDS = {
    "районне управління": r"РАЙОНН\w*\s+УПРАВЛІНН",
    "управління": "УПРАВЛІНН",
    "відділення": "ВІДДІЛЕНН",
    "відділ": "ВІДДІЛ",
}

EDITS, LEAST_TOKEN = 2, 6


def letters_key(name: Column) -> Column:
    """Upper-case letters only, with Ї as І."""
    return F.regexp_replace(F.replace(F.upper(name), F.lit("Ї"), F.lit("І")), "[^А-ЯІЄҐЫЭЪ]", "")


def stems() -> list[tuple[str, str]]:
    """(stem, region) of every region, in their order."""
    return [(r.upper().replace("Ї", "І").replace("-", "").removesuffix("ЬКА"), f"{r} область") for r in REGIONS]


def unit_kind(name: Column) -> Column:
    out = None
    for kind, pattern in UNIT_KINDS.items():
        hit = F.upper(name).rlike("(?U)" + pattern)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def longest_contained(text: Column, stems: dict[str, object], first: Column | None = None) -> Column:
    """The value of the longest stem that the text contains (of equally long ones the earlier), behind the branches of ``first``; null if there is none."""
    out = first
    for stem, value in sorted(stems.items(), key=lambda x: -len(x[0])):
        hit = text.contains(stem)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.lit(None).cast("string") if out is None else out


def region_by_marks_and_stems(name: Column) -> Column:
    """Special marks first, then the longest stem that the name contains; null if there is none."""
    key = letters_key(name)
    out = None
    for mark, region in MARKS.items():
        out = F.when(key.contains(mark), region) if out is None else out.when(key.contains(mark), region)
    return longest_contained(key, dict(stems()), out)
