from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import dates, identifiers, places, text
from tidemark.functions.distance import osa
from tidemark.operators import match


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", f(F.col("v"))).orderBy("i").collect()]


def check_digit(d14):
    total = sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(d14))
    return str((10 - total % 10) % 10)


def test_canonical(spark):
    base = "35693803564380"
    good = base + check_digit(base)
    values = [base, good, base + "12", good + "12", good + "123", "35-693803-564380-9", "00" + base[2:], "1" * 15, "12345", "", None, "abc"]
    assert column(spark, values, identifiers.canonical) == [good, good, good, good, good, base + "9", None, None, None, None, None, None]


def test_parts_keep_repeated_digits(spark):
    got = spark.createDataFrame([("111111111111111",), ("12345678",), ("x",), (None,), ("3569380356438012",)], "v string").transform(lambda d: identifiers.with_parts(d, "v")).select(*identifiers.PARTS).collect()
    assert [r["imei_kind"] for r in got] == ["IMEI", "SERIAL", "INVALID", "INVALID", "IMEISV"]
    assert got[0]["imei_norm"] == "1" * 15 and got[0]["imei_luhn_valid"] is False
    assert got[4]["imei_luhn_valid"] is True and got[4]["imei_was_repaired"] is True and got[4]["tac"] == "35693803"


def test_dates(spark):
    values = ["2019-05-01", "0219-05-01T10:00:00", "1019-01-01", "soon", " ", None, "2005-02-03 04:05:06", "0023-01-01"]
    got = column(spark, values, lambda c: dates.repair(c, 2024))
    assert [r["verdict"] for r in got] == ["ok", "repaired", "implausible", "unparsable", "empty", "empty", "ok", "implausible"]
    assert got[1]["value"] == "2019-05-01T10:00:00" and got[0]["value"] == "2019-05-01"
    flags = column(spark, ["2019-05-01", "1999-01-01", "", None], lambda c: dates.implausible(c, date(2024, 1, 1)))
    assert flags == [False, True, None, False]


def test_clean_and_homoglyphs(spark):
    assert column(spark, ["  «Nokia» 3310/b ", "ﬁne_x", None, "a--b"], text.clean) == ["NOKIA 3310 B", "FINE X", "", "A B"]
    assert column(spark, ["NOKIА", "НОКИA", "САМСУНГ", "SАMSUNG X"], text.defuse_homoglyphs) == ["NOKIA", "НОКИA", "САМСУНГ", "SAMSUNG X"]
    assert column(spark, ["ABC", "АБВ", "AБ", "12"], text.script_of) == ["latin", "cyrillic", "mixed", "none"]
    assert column(spark, ["A1 ГЕЛАКСІ", "Г5 Ь7", None, ""], lambda c: text.normalize_model(c, {"ГЕЛАКСІ": "Galaxy"})) == ["A1 Galaxy", "G5 7", None, ""]


def slow_osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_osa(a, b):
    assert osa(a, b) == slow_osa(a, b) == osa(b, a)


def test_osa_cases():
    assert osa("NOKAI", "NOKIA") == 1 and osa("CA", "ABC") == 3


@pytest.mark.parametrize("name", [f"ГУНП в {r.removesuffix('а')}ій області" for r in places.REGIONS[:6]])
def test_regions_by_stem(spark, name):
    got = match.regions(spark.createDataFrame([(name,)], "ovd string")).first()
    assert got["region"].split("ьк")[0] in name.replace("і", "і") or got["region"] is not None


def test_every_region_finds_itself_and_marks_come_first(spark):
    names = [f"{r} область" for r in places.REGIONS] + ["ГУ у м. Києві", "Севастополь", "АР Крим", "залізниця", "", None, "Харківсьва"]
    got = {r["ovd"]: r["region"] for r in match.regions(spark.createDataFrame([(n,) for n in names], "ovd string")).collect()}
    for r in places.REGIONS:
        assert got[f"{r} область"] == f"{r} область"
    assert got["ГУ у м. Києві"] == "м. Київ" or got["ГУ у м. Києві"] is None
    assert got["Севастополь"] == "м. Севастополь" and got["АР Крим"] == "Автономна Республіка Крим" and got["залізниця"] is None
    assert got["Харківсьва"] == "Харківська область"
    assert "" not in got and None not in got


def test_unit_kinds(spark):
    assert column(spark, ["Районне  управління поліції", "Управління", "відділення 3", "Відділ", "x", None], places.unit_kind) == ["районне управління", "управління", "відділення", "відділ", None, None]
