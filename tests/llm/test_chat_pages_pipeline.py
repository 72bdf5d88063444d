import json

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import SF, against_sql, by_id, docs

import corpus_pipeline
from tidemark.llm import page_wrapper as pw
from tidemark.llm import preference_chat as pc
from tidemark.llm import queries


def test_chat_against_sql(spark):
    against_sql(pc.op1_preference_chat(spark, SF), pc.OP1_SQL)


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("extra", F.lit(1))


def test_preference_pairs(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "good"), (2, 0, "system", "s"), (2, 1, "user", "hi"), (2, 2, "assistant", "bad"), (2, 3, "user", None), (3, 0, "user", "q"), (4, 0, "user", "q"), (4, 1, None, "a<|im_end|>"), (5, None, "user", "x"), (5, None, "assistant", "y"), (None, 0, "user", "z")]
    pairs = spark.createDataFrame([(10, 1, 2), (11, 3, 4), (12, 3, 3), (13, 5, 1), (14, 99, 1)], "pair_id bigint, chosen_id bigint, rejected_id bigint")
    got = by_id(pc.preference_pairs(pc.with_pairs(turns(spark, rows).withColumn("side", F.lit("clash")), pairs)), "pair_id")
    p = got[10]
    assert p["n_common_turns"] == 2 and p["prompt"] == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n" and p["status"] == "pair"
    (s, e), = [(x["s"], x["e"]) for x in p["chosen_mask"]]
    assert p["chosen"][s:e] == "good<|im_end|>"
    (s, e), = [(x["s"], x["e"]) for x in p["rejected_mask"]]
    assert p["rejected"][s:e] == "bad<|im_end|>" and p["rejected"].endswith("<|im_start|>user\n<|im_end|>\n")
    assert got[11]["status"] == "prefix" and got[11]["chosen"] == "" and "unknown\na<| im_end|>" in got[11]["rejected"]
    assert got[12]["status"] == "equal" and got[12]["n_common_turns"] == 1
    assert got[13]["n_common_turns"] == 0 and got[13]["chosen"].startswith("<|im_start|>assistant\ny")
    assert got[14]["chosen"] == "" and got[14]["chosen_id"] is None
    none = turns(spark, []).withColumn("pair_id", F.lit(1)).withColumn("side", F.lit(0))
    assert pc.preference_pairs(none).count() == 0


def test_replies_of_neighbours(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "one"), (0, 2, "user", "and"), (0, 3, "assistant", "two"), (0, 4, "user", "bye"), (1, 0, "user", "yo"), (1, 1, "assistant", "three"), (2, 0, "user", "alone"), (2, 1, "assistant", "four"), (4, 0, "user", "no reply"), (5, 0, "assistant", "five"), (-1, 0, "assistant", "minus"), (-2, 0, "assistant", "minus"), (None, 0, "user", "z")]
    df = turns(spark, rows).withColumn("c", F.lit("clash")).withColumn("side", F.lit("clash")).withColumn("id", F.lit(7))
    got = by_id(pc.format_pairs(pc.replaced_replies(df)), "pair_id")
    assert set(got) == {0, 1, 2, 4, 5, -1, -2}
    assert got[0]["n_common_turns"] == 3 and got[0]["rejected_id"] == 1 and got[0]["rejected"] == "<|im_start|>assistant\nthree<|im_end|>\n" and got[0]["status"] == "pair"
    assert got[0]["chosen"].startswith("<|im_start|>assistant\ntwo") and got[0]["chosen"].endswith("bye<|im_end|>\n")
    assert got[1]["n_common_turns"] == 1 and "two" in got[1]["rejected"]
    assert (got[2]["n_common_turns"], got[2]["rejected_id"], got[2]["rejected"], got[2]["status"]) == (1, None, "", "prefix")
    assert (got[4]["n_common_turns"], got[4]["status"]) == (1, "equal") and (got[5]["rejected_id"], got[5]["status"]) == (None, "prefix")
    assert got[-1]["status"] == got[-2]["status"] == "equal" and got[-1]["rejected_id"] == -2
    pairs = spark.createDataFrame([(10, 0, 1)], "pair_id bigint, chosen_id bigint, rejected_id bigint")
    assert pc.preference_pairs(pc.with_pairs(df, pairs)).count() == 1


def test_most_pairs_share_turns(spark):
    got = pc.op1_preference_chat(spark, SF)
    assert got.where("n_common_turns > 0").count() > 0.9 * got.count()


def page(i, body="", extra="", comments=""):
    return f"""<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style></head><body class="site"><header><a href=/>Site</a></header>
<nav><ul><li><a href=1>Home</a><li><a href=2>Item {i}</a></ul></nav><div id="cookie-notice">We use cookies {i}</div>
<div class="wrap"><div class="content"><h2>Headline {i}</h2>{extra}<p>First &amp; foremost   text<br>of page {i} &lt;b&gt;.</p><p>Second <b>bold</b> and <a href=x>a link</a> number {i}{body}</div>
<div class="sidebar"><p>Related {i}</p><p>More {i}</p></div><section class="comments"><p>Nice {i}!</p>{comments}</section></div>
<form><input><button>Send {i}</button></form><div class="ad-box"><p>Buy {i}</p></div><!-- <p>hidden</p> --><script>var t="<p>x</p>";</script><footer>(c) 2020 {i}</footer></body></html>"""


def test_pages(spark):
    lines = lambda i: [f"Headline {i}", f"First & foremost text of page {i} <b>.", f"Second bold and a link number {i}"]
    rows = [(i, f"http://a.example/{i}", page(i, extra="<blockquote>Quote</blockquote>" if i % 3 == 0 else "", comments="<p>Me too</p>" * (i % 4))) for i in range(12)]
    rows += [(100, "http://a.example/x", None), (101, None, ""), (102, "not a url", "just text"), (103, "http://a.example/long", page(7, body="".join(f"<p>Paragraph {k}" for k in range(3000)))), (104, "http://a.example/1", page(1)), (104, "http://a.example/1", page(1))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit(1)).repartition(3)
    out = pw.extract(df, pw.infer(df)).collect()
    got = {r["page_id"]: r for r in out}
    assert len(out) == len(rows)
    for i in range(12):
        want = lines(i)
        if i % 3 == 0:
            want.insert(1, "Quote")
        assert got[i]["text"].split("\n") == want
    assert got[100]["text"] == got[101]["text"] == "" and got[102]["text"] == "just text" and got[102]["n_chars"] == 9
    assert got[103]["text"].split("\n")[-1] == "Paragraph 2999" and len(got[103]["text"].split("\n")) == 3003
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert pw.extract(none, pw.infer(none)).count() == 0


def test_wrapper_expression_has_groups_slots_and_options():
    pages = ["<body><div class=m><h1>A</h1><p>x<p>y</div><i>z</i></body>", "<body><div class=m><h1>B</h1><p>x</div><ul><li>1<li>2</ul></body>", "<body><div class=m><h1>C</h1><h2>s</h2><p>x<h2>t</h2><p>y</div></body>"]
    root = None
    for p in pages:
        own = pw.page_wrapper(pw.blocks(p))
        root = own if root is None else pw.merge(root, own)
    text = root.expression()
    assert root.pages == 3 and "<h1> #TEXT </>" in text and "( <p> #TEXT </> )+" in text and "( <ul>" in text and ")?" in text
    again = pw.Node.load(json.loads(json.dumps(root.dump())))
    assert again.expression() == text


def test_merging_wrappers_does_not_need_the_pages_order():
    found = [pw.blocks(page(i)) for i in range(6)]
    def wrapper(order):
        root = None
        for i in order:
            own = pw.page_wrapper(found[i])
            root = own if root is None else pw.merge(root, own)
        return root
    left = pw.merge(wrapper([0, 1, 2]), wrapper([3, 4, 5]))
    assert pw.rules(left) == pw.rules(wrapper([5, 3, 1, 0, 2, 4]))


def test_pipeline_stages(spark):
    words = lambda k, n=40: " ".join(f"t{k}w{i}" for i in range(n))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(i, words(i), "en", f"s{i % 15}") for i in range(20)]
    rows += [(100, words(3), "en", "s1"), (101, words(3) + " x", "en", "s2"), (102, "12 34", "en", "s0"), (103, None, "en", "s0"), (104, words(50) + " " + item, "en", "s0")]
    rows += [(200 + i, f"{words(200 + i)}\nshared footer line\n{words(300 + i)}", "en", f"s{i}") for i in range(12)]
    d, counts = docs(spark, rows), {}
    for name, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, SF)
        d = spark.createDataFrame(d.collect(), d.schema)
        counts[name] = {r["doc_id"]: r for r in d.collect()}
        if name != "sentencepiece":
            assert d.columns == corpus_pipeline.COLUMNS
    assert not {102, 103} & set(counts["language_id"]) and len(counts["language_id"]) == len(rows) - 2
    assert set(counts["line_dedup"]) == set(counts["language_id"]) and sum("shared footer" in r["text"] for r in counts["line_dedup"].values()) == 1
    assert set(counts["line_dedup"]) - set(counts["near_dedup"]) == {100, 101}
    assert set(counts["near_dedup"]) - set(counts["decontaminate"]) == {104}
    assert all(r["lossless"] and r["n_pieces"] > 0 for r in counts["sentencepiece"].values())
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_stages_go_by_texts_of_repeated_and_null_ids(spark):
    words = lambda k, n=40: " ".join(f"t{k}w{i}" for i in range(n))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    a, b, c = words(1), words(2), words(3) + " " + item
    rows = [(3, a), (7, a), (7, b), (7, b), (8, b + " x"), (9, c), (9, words(4)), (None, words(5)), (None, words(6) + " " + item), (None, None), (None, words(5)), (10, words(7))]
    d = docs(spark, rows).withColumn("v", F.lit("clash")).withColumn("H", F.lit(0)).withColumn("lang", F.when(F.col("doc_id") == 3, F.col("lang")))
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, d, SF).collect()]
    assert {x for x in kept if x[0] is not None and x[0] in (3, 9, 10)} == {(3, a), (9, c), (9, words(4)), (10, words(7))}
    assert sorted(i for i, t in kept if t in (b, b + " x")) in ([7], [8]) and len([x for x in kept if x[0] is None]) == 4
    kept = sorted(((r["doc_id"] or -1, r["text"] or "") for r in corpus_pipeline.decontaminate(spark, d, SF).collect()))
    assert kept == sorted((i or -1, t or "") for i, t in rows if item not in (t or ""))
    none = docs(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLE_SQL) == {"op1_preference_chat", "op5_license_rules", "op6_line_spread"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_returns_every_row(spark, name):
    df = queries.QUERIES[name](spark, SF)
    table = {"op1_preference_chat": "conversations", "op4_page_wrapper": "pages"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    want = rows.select("conv_id").distinct().count() if table == "conversations" else rows.count()
    assert df.count() == want
