from tidemark.operators import consensus, match
from tidemark.sources.dictionaries import brand_aliases, read_csv, word_aliases

ALIASES = [("NOKIA", "Nokia", "HMD"), ("SAMSUNG", "Samsung", "Samsung"), ("SAMSUNG GALAXY", "Samsung", "Samsung"), ("MI", "Xiaomi", "Xiaomi"), ("REDMI", "Redmi", "Xiaomi"), ("BRAVIS", "Bravis", "Bravis"), ("BRAVUS", "Bravus", "Other")]


def resolved(spark, values):
    aliases = spark.createDataFrame(ALIASES, "alias string, brand string, manufacturer string")
    rows = match.resolve(spark.createDataFrame([(v,) for v in values], "nz_raw string"), aliases).collect()
    return {r["nz_raw"]: (r["brand"], r["model"], r["method"]) for r in rows}


def test_methods(spark):
    got = resolved(spark, ["Nokia", "nokia 3310", "Samsung Galaxy S5", "NOKIA3310 x", "nokai 1", "мі", "MIX", "BRAVAS 2", "zz", "", None, "NOKIА 5", "«»", "REDMINOTE"])
    assert got["Nokia"] == ("Nokia", None, "exact")
    assert got["nokia 3310"] == ("Nokia", "3310", "prefix")
    assert got["Samsung Galaxy S5"] == ("Samsung", "S5", "prefix")
    assert got["NOKIA3310 x"] == ("Nokia", "3310 X", "glued")
    assert got["nokai 1"] == ("Nokia", "1", "fuzzy")
    assert got["MIX"] == (None, None, "none"), "a short entry must not swallow a word"
    assert got["BRAVAS 2"] == (None, None, "none"), "two brands at one distance are refused"
    assert got["zz"] == (None, None, "none")
    assert got[""] == got[None] == got["«»"] == (None, None, "empty")
    assert got["NOKIА 5"] == ("Nokia", "5", "prefix")
    assert got["REDMINOTE"] == ("Redmi", "NOTE", "glued")


def test_prefixes_of_rows_are_never_broadcast(spark):
    rows = spark.range(3).selectExpr("id", "array('NOKIA3310', 'REDMI', 'MIX')[id] as head")
    got = match.longest_string_prefix(rows, "id", "head", spark.createDataFrame([("NOKIA",), ("NOKIA3",), ("MI",), ("REDMI",), ("MI",)], "entry string"), "entry")
    assert "BuildLeft" not in got._jdf.queryExecution().sparkPlan().toString(), "only the dictionary may go to the driver"
    assert [tuple(r) for r in got.collect()] == [(0, "NOKIA3", "310")]


def test_nearest(spark):
    entries = spark.createDataFrame([(a,) for a, _, _ in ALIASES], "entry string")
    got = match.nearest(spark.createDataFrame([("NOKAI",), ("BRAVOS",), ("",)], "q string"), "q", entries, "entry", limit=2, least=0.6).orderBy("query", "position").collect()
    assert [(r["query"], r["entry"], r["similarity"]) for r in got] == [("BRAVOS", "BRAVIS", 0.833), ("BRAVOS", "BRAVUS", 0.833), ("NOKAI", "NOKIA", 0.8)]


def test_dictionaries_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("alias,brand,manufacturer,note\n# comment\nнокиа,Nokia,HMD,\nNokia ,Nokia,,x\n")
    got = {r["alias"]: (r["brand"], r["manufacturer"]) for r in brand_aliases(read_csv(spark, str(tmp_path / "a.csv"), ["alias", "brand", "manufacturer", "note"])).collect()}
    assert got == {"НОКИА": ("Nokia", "HMD"), "NOKIA": ("Nokia", "Nokia")}
    (tmp_path / "w.csv").write_text("alias,canonical\nгелаксі,Galaxy\n")
    assert word_aliases(read_csv(spark, str(tmp_path / "w.csv"), ["alias", "canonical"])) == {"ГЕЛАКСІ": "Galaxy"}


def records(spark, rows):
    return spark.createDataFrame(rows, "tac string, brand string, manufacturer string, model string, imei_luhn_valid boolean")


def test_consensus_and_fill(spark):
    rows = [("1", "A", "A", "M", True)] * 9 + [("1", "B", "B", None, True)] + [("2", "A", "A", "M", True)] * 4 + [("3", "A", "A", "M", True)] * 3 + [("3", "B", "B", "N", True)] * 3 + [("1", None, None, None, False), (None, None, None, None, None)]
    d = consensus.build(records(spark, rows))
    got = [tuple(r) for r in d.collect()]
    assert got == [("1", "A", "A", "M", None, 10, 0.9, "register")]
    filled = consensus.fill(records(spark, rows), d).collect()
    bare = [r for r in filled if r["tac"] == "1" and r["imei_luhn_valid"] is False][0]
    assert (bare["brand"], bare["brand_source"], bare["tac_confidence"], bare["tac_from_invalid_imei"]) == ("A", "tac:register", 0.9, True)
    assert [r["brand_conflict"] for r in filled if r["brand"] == "B" and r["tac"] == "1"] == [True]


def test_external_list_with_a_real_year(spark):
    raw = spark.createDataFrame([("Nokia", "123", "Nokia 3310, phone, 2001"), ("No.kia", "77777777", "NoXkia 5, x"), ("Nokia", "x", "y"), ("Nokia", "123", "Nokia 3210, 1999")], "Brand string, TAC string, SPECS string")
    got = {r["tac"]: (r["brand"], r["model"], r["release_year"]) for r in consensus.external_entries(raw).collect()}
    assert got == {"00000123": ("NOKIA", "3210", 1999), "77777777": ("NO.KIA", "NOXKIA 5", None)}, "years come out, and brands are no patterns"


def test_model_key(spark):
    lines = spark.createDataFrame([("SAMSUNG", "GALAXY"), ("SAMSUNG", "GALAXY TAB"), ("A+B", "X")], "brand string, line_word string")
    rows = spark.createDataFrame([("Samsung", "Samsung Galaxy S5"), ("Samsung", "Galaxy Tab 2"), ("Samsung", "GALAXY"), ("A+B", "A+B X 1"), (None, "Q"), ("Samsung", None)], "brand string, model string")
    got = [r["model_key"] for r in consensus.model_key(rows, lines).collect()]
    assert sorted(got, key=str) == sorted(["S5", "2", None, "1", "Q", None], key=str)
