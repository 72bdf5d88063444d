"""Main texts of pages: parts of pages that markup, names or sizes must not hide, and rules against a direct count."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import page_wrapper as pw


def wrapper(found):
    root = None
    for f in found:
        if f:
            own = pw.page_wrapper(f)
            root = own if root is None else pw.merge(root, own)
    return root


def main_texts(pages):
    found = [pw.blocks(p) for p in pages]
    root = wrapper(found)
    return [pw.main_text(f, pw.rules(root) if root else None) for f in found]


LONG = "word " * 200 + "end"


@pytest.mark.parametrize(
    "html, want",
    [
        ("<html><head><title>x</title><p>Body para one", "Body para one"),
        ("<html><head><meta charset=x><link rel=y>Loose text<body><p>one</body></html><p>two", "Loose text\none\ntwo"),
        ("<article><header><h1>My Title</h1></header><p>..</article>", "My Title\n.."),
        ("<article><header class='entry-header post-header'><h1>T</h1><p>by A</p></header><div class=post-body><p>x</div></article>", "T\nby A\nx"),
        ("<body><div class='search-results'><p>One</p><p>Two</p></div></body>", "One\nTwo"),
        ("<body><div class='login'><h1>Log in</h1><p>One</p></div></body>", "Log in\nOne"),
        (f"<article><h1>Short</h1><section>{LONG}</section></article>", f"Short\n{LONG}"),
        ("<p title=don't>It is fine</p><p title='a>b' class=\"x>y\">too</p>", "It is fine\ntoo"),
        ("<p>a</p><select><option>A<option>B<p>after</p>", "a\nafter"),
        ("<p>a</p><object><p>in an object", "a\nin an object"),
        ("<p>a</p><button>go <p>text</p><button>send</button>", "a\ngo\ntext"),
        ("<p>a<!-- unclosed <b>x</b> text</p>", "ax text"),
        ("<p>a<!--> b <!-- c --> d <!-- e --!> f</p>", "a b d f"),
        ("<svg/><p>ok <svg><text>no</text></svg></p>", "ok"),
        ("<script>if (a<b) '</p>'</script ><p>x</p><style>p{}", "x\np{}"),
        ("<div class='with-sidebar'><p>in</p></div><div class=sidebar><p>out</p></div>", "in"),
        ("<div class='page sidebar-left'><main><h1>T</h1><p>in</p></main></div><aside><p>out</p></aside>", "T\nin"),
        ("<body><header><h1>Site</h1></header><article><h2>Art</h2><p>txt</p></article><div class=comments><article class=comment><p>nice</p></article></div>", "Art\ntxt"),
        ("<form id=all><main><p>in</p></main><form><input>search</form></form>", "in"),
        ("<nav><p>only a menu</p></nav><div class=ad>buy</div>", ""),
        ("<p>x <a name=top> y<p>z</p><ul><li>plain</ul>", "x y\nz\nplain"),
        ("<p>1 &lt; 2 &amp;&nbsp; 3 < 4 &eacute;&#x41;&#66;</p>", "1 < 2 & 3 < 4 \u00e9AB"),
        ("<div>" * 3000 + "deep <p>down" + "</div>" * 3000, "deep\ndown"),
        ("", ""),
    ],
)
def test_single_pages(html, want):
    assert main_texts([html]) == [want]


def test_template_of_two_distinct_pages_goes():
    page = lambda i: f"<body><div class=top><p>Imprint {'x' * 500}</p></div><div class='text id-{i}'><p>Story {i}</p><p>More {i}</p></div></body>"
    assert main_texts([page(1), page(2)]) == [f"Story {i}\nMore {i}" for i in (1, 2)]
    assert main_texts([page(1)] * 3)[0].startswith("Imprint"), "copies of one page say nothing"


def test_class_numbers_do_not_tell_pages_apart():
    found = [pw.blocks(f"<body><div class='post-{i} id{i}'><p>Story {i}</p></div></body>") for i in range(50)]
    assert wrapper(found).size() == wrapper(found[:1]).size()


def test_groups_of_any_length_fold():
    for k in (1, 2, 5, 9, 30):
        row = "".join(f"<dt class=c{chr(97 + j % 26)}{'z' * (j // 26)}>n</dt>" for j in range(k))
        one, many = (pw.page_wrapper(pw.blocks(f"<body><dl>{row * n}</dl></body>")) for n in (2, 40))
        assert one.size() == many.size() <= k + 5


def direct_places(found):
    """path -> what a wrapper should know of it, counted on all pages without any alignment."""
    out = {}
    for f in found:
        seen = {}
        for path, aside, text, linked in f:
            for i in range(1, len(path) + 1):
                seen.setdefault(path[:i], [])
            seen.setdefault(path, []).append((aside, text, min(linked, len(text))))
        for path, own in seen.items():
            x = out.setdefault(path, {"pages": 0, "chars": 0, "linked": 0, "aside": False, "texts": set(), "most": 0})
            x["pages"] += 1
            x["chars"] += sum(len(t) for _, t, _ in own)
            x["linked"] += sum(n for _, _, n in own)
            x["aside"] |= any(a for a, _, _ in own)
            x["texts"] |= {t for _, t, _ in own}
    return out


def random_page(rng, host, i):
    parts = [f"<nav><a href=1>Home</a></nav><div class=notice{host}><p>Notice of {host}</p></div>"]
    body = "".join(rng.choice((f"<p>Text {i} {rng.random()}</p>", f"<h2>Head {rng.random()}</h2>", f"<ul><li>{rng.random()}<li>{rng.random()}</ul>", f"<p><a href=x>link {i}</a> and {rng.random()}</p>")) for _ in range(rng.randrange(1, 9)))
    parts.append((f"<article><h1>Title {i}</h1>{body}</article>", f"<div class=text><h1>Title {i}</h1>{body}</div>")[host % 2])
    parts.append(f"<div class=box{host}><p>House {host}</p></div><ul class=more><li><a href=1>One {i}</a><li><a href=2>Two {i}</a></ul>" if host % 3 else "")
    return "<body>" + "".join(parts) + f"<footer>end {rng.random()}</footer></body>"


def test_wrappers_against_a_direct_count():
    """Aligned and merged in any order, wrappers know of each path what a plain count over all pages gives."""
    rng = random.Random(4)
    for host in range(12):
        found = [pw.blocks(random_page(rng, host, i)) for i in range(rng.randrange(2, 8))]
        halves = pw.merge(wrapper(found[::2]), wrapper(found[1::2]))
        at, want = pw.places(halves), direct_places(found)
        at.pop((), None)
        assert set(at) == set(want)
        for p, x in want.items():
            got = at[p]
            assert (got["chars"], got["linked"]) == (x["chars"], x["linked"]), p
            assert got["pages"] <= x["pages"] and (got["plus"] or got["pages"] == x["pages"]), p  # a place that moves about is several places
            assert got["text"] == (None if not x["texts"] else next(iter(x["texts"])) if len(x["texts"]) == 1 else ""), p
        rule = pw.rules(halves)
        for f in found:
            text = pw.main_text(f, rule).split("\n")
            assert text == [t for p, aside, t, _ in f if not aside and not t.startswith(("Notice", "House")) and not any("more" in s for s in p)]


def test_rules_too_big_to_send_give_the_same_texts(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, f"http://h{i % 3}.example/{i}", random_page(rng, i % 3, i)) for i in range(30)] + [(7, "http://h1.example/7", random_page(rng, 1, 7)), (99, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("salt", F.lit("clash")).withColumn("rule", F.lit(1)).repartition(4)
    few = sorted(map(tuple, pw.extract(df, pw.infer(df)).collect()), key=str)
    monkeypatch.setattr(pw, "RULE_BYTES", -1)
    assert sorted(map(tuple, pw.extract(df, pw.infer(df)).collect()), key=str) == few and len(few) == len(rows)


def test_a_long_page_takes_time_in_proportion():
    page = lambda n: "<body><article>" + "".join(f"<p>Text {i}</p><h2 id=s{'abcdefgh'[i % 8]}{i}>Head</h2>" for i in range(n)) + "</article></body>"
    took = []
    for n in (2_000, 16_000):
        begin = time.process_time()
        assert len(main_texts([page(n)])[0].split("\n")) == 2 * n
        took.append(time.process_time() - begin)
    assert took[1] < 30 * max(took[0], 0.05)
