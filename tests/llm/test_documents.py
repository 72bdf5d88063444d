"""Operators over documents against brute force, with nulls, empties, ties, repeats, long texts, empty tables and clashing columns."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import against_sql, by_id, docs, words

from tidemark.llm import graph, huffman, hyperlang, license_rules, line_spread, lsh_forest, phrase_index, piece_lattice, robust_quality
from tidemark.llm import textkernel as tk
from tidemark.llm.common import settings, table, work_path

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- near duplicates -----------------------------------------------------------------------------


def shingles(t, k):
    w = WORDS.findall(low(t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def exact_components(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                parent[b] = a
    return {i: (len(s), find(i)) for (i, _), s in zip(rows, sets)}


def test_near_duplicates(spark):
    rng = random.Random(5)
    rows, k = [], 0
    for _ in range(25):
        base = words(rng, rng.randrange(30, 90)).split()
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3))):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            rows.append((k, " ".join(copy)))
            k += 1
    hub = words(rng, 60).split()  # a star of near copies
    for _ in range(60):
        copy = list(hub)
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
        k += 1
    rows += [(k, ""), (k + 1, None), (k + 2, "A b"), (k + 3, "a  B"), (k + 4, "a b c"), (k + 5, "x " * 30_000), (k + 6, "X\n" * 30_000)]
    df = docs(spark, rows).withColumn("component_id", F.lit("clash")).withColumn("k", F.lit(None))
    got = by_id(lsh_forest.near_duplicates(df, words=4))
    want = exact_components([(i, t or "") for i, t in rows], 4)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_near_duplicates_of_repeated_and_null_ids(spark):
    df = docs(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f")])
    rows = lsh_forest.near_duplicates(df, words=4).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [True]
    assert lsh_forest.near_duplicates(docs(spark, [])).count() == 0


def test_an_id_with_several_texts_is_one_vertex(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    got = [tuple(r)[:1] + tuple(r)[2:] for r in lsh_forest.near_duplicates(docs(spark, [(7, a), (3, a), (7, b), (9, b), (7, ""), (5, "z"), (5, "y")]), words=4).collect()]
    assert sorted(got) == [(3, 3, True), (5, 5, True), (5, 5, True), (7, 3, False), (7, 3, False), (7, 3, False), (9, 3, False)]


def test_crowded_regions_lose_no_link(spark, monkeypatch):
    """Near copies with similarities about the threshold, met in small blocks; hubs and neighbours alone would lose links."""
    rng = random.Random(11)
    monkeypatch.setattr(lsh_forest, "MEMBERS", 40)
    monkeypatch.setattr(lsh_forest, "QUERY_SHINGLES", 600)
    monkeypatch.setattr(lsh_forest, "LANES", 1)
    rows, base = [], words(rng, 60, 4000).split()
    for i in range(300):
        copy = list(base)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(copy)))
    got = by_id(lsh_forest.near_duplicates(docs(spark, rows), words=4))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == exact_components(rows, 4)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["k"]: r["comp"] for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- quality -------------------------------------------------------------------------------------


def test_quality_counts_and_verdicts(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randrange(60, 200)), "en", f"s{i % 2}") for i in range(240)]
    junk = [(1000 + i, " ".join(w + "###" for w in words(rng, 80).split()), "en", "s0") for i in range(8)]
    odd = [(2000, None), (2001, ""), (2002, "a b\n\na b\n \na b"), (2003, "x y z " * 30), (2004, "é文 \t\r\n|<>&$ q"), (2005, words(rng, 70), None, None)]
    rows = rows + junk + odd
    got = by_id(robust_quality.judge(docs(spark, rows).withColumn("distance", F.lit("clash"))))
    for r in rows:
        t = r[1] or ""
        w = WORDS.findall(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        hit = {i + j for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        g = got[r[0]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert g["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
    assert not any(got[i]["kept"] for i in range(1000, 1008)) and all(got[i]["kept"] for i in range(240)) and got[2005]["kept"]
    assert robust_quality.judge(docs(spark, [])).count() == 0


def test_concentration_steps_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (400, 4)) @ np.diag([0.2, 0.3, 0.6, 0.5]) + 1
    x[:60] += 5
    names = robust_quality.NAMES
    df = spark.createDataFrame([("en", "s", *map(float, r)) for r in x], "lang string, source string, " + ", ".join(f"{n} double" for n in names))
    row = robust_quality.fit(df).first()
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
    mean, wide = q[1], np.maximum((q[2] - q[0]) / 1.349, list(robust_quality.FLOORS.values()))
    inv = np.diag(1 / wide**2)
    for _ in range(robust_quality.STEPS):
        d = np.einsum("ij,jk,ik->i", x - mean, inv, x - mean)
        inner = x[d <= np.quantile(d, robust_quality.SUPPORT, method="inverted_cdf")]
        mean = inner.mean(axis=0)
        inv = robust_quality.precision(np.cov(inner.T, bias=True) * robust_quality.consistency(4, robust_quality.SUPPORT))
    assert np.allclose([row[f"m{i}"] for i in range(4)], mean, atol=0.02)
    assert np.allclose([row[f"p{i}{i}"] for i in range(4)], np.diag(inv), rtol=0.05)
    assert np.allclose(mean, 1, atol=0.15), "the shifted rows do not move the centre"


# --- licences, lines -----------------------------------------------------------------------------


def test_licences_against_sql(spark):
    against_sql(license_rules.op5_license_rules(spark, SF), license_rules.OP5_SQL)


def test_licence_rules(spark):
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    bsd = bsd.replace("met: ", "met:\n")
    three = bsd + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    rows = [(1, bsd), (2, three), (3, "Some text. Released under the MIT License."), (4, None), (5, ""), (6, "released under  the MIT license!\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License"), (7, "the MIT License"), (8, ("word " * 20 + ". ") * 3000 + "Licensed under the Apache License, Version 2.0.")]
    got = by_id(license_rules.scan(docs(spark, rows).withColumn("licenses", F.lit("clash"))))
    assert {i: r["licenses"] for i, r in got.items()} == {1: ["BSD-2-Clause"], 2: ["BSD-3-Clause"], 3: ["MIT"], 4: [], 5: [], 6: ["MIT", "CC-BY-NC-4.0"], 7: [], 8: ["Apache-2.0"]}
    assert got[6]["license_classes"] == ["permissive", "noncommercial"] and got[8]["n_sentences"] == 3001 and got[4]["n_sentences"] == 0
    assert license_rules.scan(docs(spark, [])).count() == 0


def test_lines_against_sql(spark):
    against_sql(line_spread.op6_line_spread(spark, SF), line_spread.OP6_SQL)


def test_line_removal(spark):
    rows = [(i, f"own {i}\n  menu  \nown too {i}\n\nmenu", "en", f"s{i % 12}") for i in range(24)]
    rows += [(100, "nearly", "en", f"s{i}") for i in range(1)] + [(200 + i, "on nine sites", "en", f"t{i}") for i in range(9)] + [(300 + i, "on one site", "en", "t0") for i in range(30)]
    rows += [(400, None), (401, ""), (402, "menu", None, None), (403, "a\n" * 5000 + "menu")]
    df = docs(spark, rows).withColumn("n_removed", F.lit("clash")).withColumn("lines", F.lit(1)).withColumn("gone", F.lit(2))
    out = line_spread.remove_boilerplate(df)
    got = by_id(out)
    assert got[0]["text"] == "own 0\n  menu  \nown too 0\n" and got[0]["n_removed"] == 1, "the first occurrence stays"
    assert all(got[i]["text"] == f"own {i}\nown too {i}\n" and got[i]["n_removed"] == 2 for i in range(1, 24))
    assert all(got[200 + i]["n_removed"] == 0 for i in range(9)) and all(got[300 + i]["n_removed"] == 0 for i in range(30))
    assert got[400]["text"] is None and got[401]["text"] == "" and got[402]["text"] == "" and got[403]["text"].count("a") == 5000 and "menu" not in got[403]["text"]
    assert got[5]["lines"] == 1 and got[5]["gone"] == 2
    assert line_spread.remove_boilerplate(docs(spark, [])).count() == 0


def test_line_removal_sorts_no_texts(spark):
    rows = [(i, "menu\n\n" * (i % 3) + f"own {i}\n", "en", f"s{i}") for i in range(40)] + [(50, "\n"), (51, "\n\nmenu\n")]
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan(line_spread.remove_boilerplate(docs(spark, rows))), "with few removals no text is shuffled"
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        out = line_spread.remove_boilerplate(docs(spark, rows))
        assert "SortMergeJoin" not in plan(out) and "ShuffledHashJoin" in plan(out), "only the removals are held, texts are not sorted"
    finally:
        spark.conf.set(name, before)
    got = by_id(out)
    assert got[1]["text"] == "menu\n\nown 1\n" and got[2]["text"] == "\n\nown 2\n" and got[3]["text"] == "own 3\n" and got[50]["text"] == "\n" and got[51]["text"] == "\n\n"
    assert [got[i]["n_lines"] for i in (1, 2, 3, 50, 51)] == [4, 6, 2, 2, 4] and [got[i]["n_removed"] for i in (1, 2, 3, 50, 51)] == [0, 2, 0, 0, 1]


# --- token ids -----------------------------------------------------------------------------------


def test_code_lengths():
    counts = np.array([0, 5, 9, 12, 13, 16, 45, 1])
    lengths = huffman.code_lengths(counts, 18)
    assert lengths[0] == 0 and sum(2.0 ** -int(x) for x in lengths if x) == 1.0
    heap = sorted(c for c in counts.tolist() if c)
    best = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        best += a + b
        heapq.heappush(heap, a + b)
    assert int((lengths * counts).sum()) == best and huffman.code_lengths(counts, 3).max() == 3
    assert huffman.code_lengths(np.array([0, 7]), 18).tolist() == [0, 1] and not huffman.code_lengths(np.zeros(3, int), 18).any()
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)
    fib = [1, 1]
    while len(fib) < 40:
        fib.append(fib[-1] + fib[-2])
    limited = huffman.code_lengths(np.array(fib), 12)
    assert limited.max() == 12 and sum(2.0 ** -int(x) for x in limited) <= 1.0


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = np.minimum(rng.geometric(0.01, n), 3000).astype(np.uint32)
        code = huffman.Code(huffman.code_lengths(np.bincount(ids, minlength=3001), 18), 18)
        payload, marks = huffman.encode_block(ids, code)
        assert (huffman.decode_block(payload, marks, n, code.decode_table(), 18) == ids).all()


def test_ids_against_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    direct = Tokenizer.from_file(path)
    odd = ["Don't  stop—now! 123abc", "", None, "İstanbul ǆ ﬁ <|endoftext|> a<|startoftext|>b", "é é x\u0085y z\x1cq", "𝔘nicode 日本語 ''s 'S'll", "A'B \x00 <| |>", "x" * 5000, "a\tb\x0bc\x0cd\re", "ŒŠž×÷ß ŉ"]
    rng = random.Random(3)
    odd += ["".join(rng.choice("aB é'ſ1.,<|\ń中") for _ in range(60)) for _ in range(60)]
    rows = list(enumerate(odd)) + [(500, "same"), (500, "same")]
    out = work_path(spark, "t7")
    huffman.write_encoded(docs(spark, rows).withColumn("t", F.lit(1)), out, path, block_ids=64)
    got = sorted(huffman.read_encoded(spark, out, with_ids=True).collect(), key=lambda r: r["start"])
    at = 0
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: x[0])):
        ids = direct.encode(t or "", add_special_tokens=False).ids + [1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (i, at, len(ids), ids), t
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(rows)


def test_ids_of_an_empty_table(spark):
    import public_tokenizers

    out = work_path(spark, "t7e")
    huffman.write_encoded(docs(spark, []), out, public_tokenizers.path("word_bpe_49k.json"))
    assert huffman.read_encoded(spark, out).count() == 0


def test_texts_and_blocks_pass_in_small_steps(spark, monkeypatch):
    import public_tokenizers
    import pyarrow.dataset as ds

    def measured(run):
        def held(batches):
            def small(batch):
                assert batch.slice(0, batch.num_rows - 1).nbytes < 5 << 18, "the row that reaches the limit is the last"
                return batch

            yield from run(map(small, batches))

        wrapped.append(run.__name__)
        return held

    wrapped = []
    monkeypatch.setattr(huffman, "releasing", measured)
    path, out = public_tokenizers.path("word_bpe_49k.json"), work_path(spark, "t7s")
    text = "".join(random.Random(5).choices("abcdefgh \n", k=8_000))
    rows = [(i, f"{i} {text}") for i in range(700)] + [(700, text * 400)]
    name, other = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"
    huffman.write_encoded(docs(spark, rows, 1), out, path, block_ids=1 << 15)
    assert spark.conf.get(name, None) is None, "a setting of the writer stays behind"
    files = list(ds.dataset(out.removeprefix("file:") + "/blocks").get_fragments())
    groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.metadata.num_row_groups)]
    assert sum(groups) > 16 and max(groups) <= 8
    before = spark.conf.get(other, None)
    try:
        got = huffman.read_encoded(spark, out).orderBy("doc_id").collect()
    finally:
        if before is None:
            spark.conf.unset(other)
    encoder = huffman.TextEncoder(path)
    sizes = [len(encoder.tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows[::100]]
    assert [r["n_tokens"] for r in got[::100]] == sizes and len(got) == len(rows)
    assert wrapped == ["count", "encode", "decode"]


def test_settings_hold_for_a_block_and_leave_what_the_user_set(spark):
    own, chosen = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.shuffle.partitions"
    before = spark.conf.get(chosen)
    with pytest.raises(KeyError), settings(spark, {own: "256", chosen: "977"}):
        assert spark.conf.get(own) == "256" and spark.conf.get(chosen) == before
        raise KeyError
    assert spark.conf.get(own, None) is None and spark.conf.get(chosen) == before


def _units_one_by_one(row):
    """The units of a row, and which are looked up whole, character by character."""
    out = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", row):
        kinds = ["letter" if re.match("[A-Za-zÀ-ÖØ-öø-įı-ſ]", c) else "digit" if re.match("[0-9]", c) else "sign" if "!" <= c <= "~" and c not in "'<" else "odd" for c in word]
        if "odd" in kinds:
            out.append((word, True))
            continue
        for i, (c, kind) in enumerate(zip(word, kinds)):
            if i and kind == kinds[i - 1] != "digit":
                out[-1] = (out[-1][0] + c, False)
            else:
                out.append((c, False))
    return out


def test_units_of_rows_equal_those_found_one_by_one():
    import public_tokenizers

    encoder = huffman.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(11)
    for _ in range(600):
        rows = ["".join(rng.choices("abAB 12 9\t\n\x00\x7f'<>.,-éÉ×÷İıſĀ文\U0001F600", k=rng.choice((0, 1, 3, 12, 40)))) for _ in range(rng.randrange(6))]
        data, offsets = tk.string_buffers(pa.array(rows, pa.string()))
        start, end, row, whole = encoder.units(data, offsets)
        got = [(int(r), data[s:e].tobytes().decode(), bool(w)) for s, e, r, w in zip(start, end, row, whole)]
        assert got == [(i, *unit) for i, text in enumerate(rows) for unit in _units_one_by_one(text)]


def test_unknown_units_go_to_the_tokenizer_in_texts_of_bounded_size():
    import public_tokenizers

    encoder = huffman.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer, sizes = encoder.tokenizer, []

    class Seen:
        @staticmethod
        def encode_batch_fast(texts, **options):
            sizes.extend(len(t.split()) for t in texts)
            return tokenizer.encode_batch_fast(texts, **options)

    encoder.tokenizer = Seen
    words = sorted({"".join(random.Random(i).choices("abcdefgh", k=8)) for i in range(9000)})
    data, offsets = tk.string_buffers(pa.array([" ".join(words)]))
    _, form, ids, starts = encoder.lookup(data, offsets)
    got, _ = huffman.gather(ids, starts, form)
    assert got.tolist() == tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    assert sum(sizes) == len(words) and max(sizes) <= 2000


def test_units_found_again_stay_when_room_is_made(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(huffman, "CACHE", 400)
    encoder = huffman.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer, met = encoder.tokenizer, Counter()

    class Seen:
        @staticmethod
        def encode_batch_fast(texts, **options):
            met.update(w for t in texts for w in t.split())
            return tokenizer.encode_batch_fast(texts, **options)

    encoder.tokenizer = Seen
    rng = random.Random(2)
    common = sorted({"".join(rng.choices("abcdefgh", k=7)) for _ in range(90)})
    for size in [100] * 12 + [600, 100]:  # 600: more than the cache holds
        text = " ".join([*common, *("".join(rng.choices("ijklmnop", k=9)) for _ in range(size)), "日本" + rng.choice("中文")])
        data, offsets = tk.string_buffers(pa.array([text]))
        _, form, ids, starts = encoder.lookup(data, offsets)
        assert huffman.gather(ids, starts, form)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.slots.count == len(encoder.offsets) - 1 == len(encoder.again) <= max(400, size + 200)
    assert max(met[w] for w in common) == 1


def test_the_table_of_units_has_room_for_the_whole_cache_from_the_start(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(huffman, "CACHE", 100_000)
    encoder = huffman.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    keys = encoder.slots.keys
    for part in np.split(tk.stream(8, huffman.CACHE), 10):
        encoder.slots.add(part, np.arange(len(part)))
    assert encoder.slots.keys is keys and len(keys) <= 4 * huffman.CACHE


def test_cutting_units_costs_less_than_twice_their_hashing():
    import time

    import public_tokenizers

    encoder = huffman.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    data, offsets = tk.string_buffers(pa.array(["plain words of 12 letters, and étude " * 100] * 500))
    start, end, _, _ = encoder.units(data, offsets)

    def least(run):
        took = []
        for _ in range(7):
            began = time.thread_time()
            run()
            took.append(time.thread_time() - began)
        return min(took)

    assert least(lambda: encoder.units(data, offsets)) < 2 * least(lambda: tk.word_hashes(data, start, end, encoder._lower))


# --- languages -----------------------------------------------------------------------------------


def test_language_accuracy_and_odd_texts(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    out = hyperlang.op8_hyperdimensional_langid(spark, "/root/testdata/sf0.01").join(d.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert held[0] > 0.97 and held[1] > 200
    assert out.where("score < 0 or score > 1").count() == 0
    model = hyperlang.fit(docs(spark, [(1, "the thing of the", "en"), (2, "der die das und", "de"), (3, "x", None), (4, None, "fr")]))
    assert model[0] == ["de", "en"]
    rows = docs(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "a"), (5, "THE THING"), (6, "und der " * 20_000)]).withColumn("score", F.lit("clash"))
    got = by_id(hyperlang.predict(rows, model))
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[5]["lang_pred"] == "en" and got[6]["lang_pred"] == "de"
    empty = hyperlang.fit(docs(spark, []))
    assert by_id(hyperlang.predict(docs(spark, [(1, "word")]), empty))[1]["lang_pred"] == "und"
    assert hyperlang.predict(docs(spark, []), model).count() == 0


def test_prediction_does_not_depend_on_the_batch():
    texts = ["the thing", "été à la", "日本語 text", "", "q"]
    import pyarrow as pa

    from tidemark.llm import textkernel as tk

    together = hyperlang.bundles(*tk.string_buffers(pa.array(texts)), 256)
    for i, t in enumerate(texts):
        assert np.allclose(hyperlang.bundles(*tk.string_buffers(pa.array([t])), 256)[0], together[i])


# --- decontamination -----------------------------------------------------------------------------


def windows(t, n=10):
    w = ALNUM.findall(low(t))
    k = min(n, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if w else []


def contamination_by_hand(rows, items):
    where = {}
    for i, t in items:
        for w in windows(t):
            where.setdefault(w, set()).add(i)
    out = {}
    for i, t in rows:
        w = ALNUM.findall(low(t))
        hit, found = set(), set()
        for k in {len(x) for x in where}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in where:
                    hit.update(range(a, a + k))
                    found |= where[tuple(w[a : a + k])]
        ids = sorted(str(x) for x in found if x is not None)
        out[i] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_decontamination(spark, monkeypatch, block):
    rng = random.Random(8)
    items = [(i, words(rng, rng.randrange(3, 25), 60)) for i in range(30)] + [(40, None), (41, "..."), (42, "lone"), (None, words(rng, 12))]
    rows = []
    for i in range(120):
        t = words(rng, rng.randrange(0, 60), 60)
        for _ in range(rng.randrange(0, 3)):
            t += " " + " ".join((rng.choice(items)[1] or "").split()[: rng.randrange(1, 25)]).upper().replace(" ", ", ")
        rows.append((i, t))
    rows += [(500, None), (501, ""), (502, "Lone"), (503, "y " * 40_000 + "lone")]
    monkeypatch.setattr(phrase_index, "SEGMENT", 2000)
    blocks = phrase_index.phrase_blocks
    monkeypatch.setattr(phrase_index, "phrase_blocks", lambda i, k, t: blocks(i, k, t, block))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = by_id(phrase_index.contamination(docs(spark, rows).withColumn("n_hit", F.lit(0)), bench, work_path(spark, "t9")))
    assert {i: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for i, r in got.items()} == contamination_by_hand(rows, items)


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = by_id(phrase_index.contamination(docs(spark, [(1, "a b")]), none, work_path(spark, "t9")))
    assert (got[1]["n_words"], got[1]["contaminated"], got[1]["n_items"]) == (2, False, 0)
    assert phrase_index.contamination(docs(spark, []), none, work_path(spark, "t9")).count() == 0


def test_phrase_and_proximity_matches(spark):
    index = phrase_index.build_index(docs(spark, [(1, "the quick brown fox jumps"), (2, "brown the quick one two fox"), (3, "fox")]), work_path(spark, "t9"))
    items = spark.createDataFrame([("p", "Quick brown"), ("q", "quick fox")], "item_id string, text string")
    exact = sorted((r["doc_id"], r["item_id"], r["start"], r["size"]) for r in phrase_index.phrase_matches(index, items).collect())
    assert exact == [(1, "p", 1, 2)]
    near = sorted((r["doc_id"], r["item_id"], r["start"], r["size"]) for r in phrase_index.phrase_matches(index, items, slop=2).collect())
    assert near == [(1, "p", 1, 2), (1, "q", 1, 3), (2, "p", 0, 3), (2, "q", 2, 4)]


def near_by_hand(rows, items, slop):
    out = set()
    for d, t in rows:
        w = ALNUM.findall(low(t))
        for i, x in items:
            wanted, most = set(ALNUM.findall(low(x))), len(ALNUM.findall(low(x))) + slop
            for a in range(len(w)):
                if wanted and w[a] in wanted:
                    size = next((b - a for b in range(a + 1, min(len(w), a + most) + 1) if wanted <= set(w[a:b])), None)
                    if size:
                        out.add((d, i, a, size))
    return out


def test_matches_against_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(phrase_index, "SEGMENT", 900)
    monkeypatch.setattr(phrase_index, "CANDIDATES", 7)
    items = [(i, words(rng, rng.randrange(1, 7), 9)) for i in range(25)] + [(30, "w1 w1 w1"), (31, "W1 W1 w1"), (32, "")]
    rows = [(i, words(rng, rng.randrange(0, 40), 9)) for i in range(60)] + [(90, "w1 " * 300), (91, None)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    index = phrase_index.build_index(docs(spark, rows), work_path(spark, "t9"))
    got = sorted((r["doc_id"], int(r["item_id"]), r["start"], r["size"]) for r in phrase_index.phrase_matches(index, bench, slop=2).collect())
    assert got == sorted(near_by_hand(rows, items, 2))
    exact = set()
    for d, t in rows:
        w = ALNUM.findall(low(t))
        for i, x in items:
            p = ALNUM.findall(low(x))
            exact |= {(d, i, a, len(p)) for a in range(len(w) - len(p) + 1) if p and w[a : a + len(p)] == p}
    got = sorted((r["doc_id"], int(r["item_id"]), r["start"], r["size"]) for r in phrase_index.phrase_matches(index, bench).collect())
    assert got == sorted(exact)
    near = by_id(phrase_index.contamination(docs(spark, rows), bench, work_path(spark, "t9"), slop=2))
    assert {d: r["n_near"] for d, r in near.items()} == {d: len({i for e, i, _, _ in near_by_hand(rows, items, 2) if e == d}) for d, _ in rows}


def test_common_words_do_not_fill_the_memory():
    """A block of 4 MB of phrases over a heavy-tailed vocabulary: candidates stay bounded."""
    import tracemalloc

    rng = np.random.default_rng(1)
    share = 1 / np.arange(1, 3001)
    text = lambda n: " ".join(f"w{i}" for i in rng.choice(3000, n, p=share / share.sum()))
    items = [(str(i), text(60)) for i in range(16_500)]
    rows = [(i, text(2000)) for i in range(60)] + [(60, items[5][1])]
    index = _segment_of([t for _, t in rows])
    tracemalloc.start()
    phrases = phrase_index.Phrases(items, 10, True)
    index.open(phrases.terms)
    found = [(w, a) for which, at in index.occurrences(phrases) for w, a in zip(which.tolist(), at.tolist())]
    near = list(index.near(phrases.sets, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30, peak
    assert {a for _, a in found} >= set(range(120_000, 120_051)) and any(5 in phrases.sets.owners(w) for w, _, _ in near)


def _segment_of(texts):
    import pyarrow as pa

    data, offsets = phrase_index.tk.string_buffers(pa.array(texts, pa.large_string()))
    start, end, row = phrase_index.tk.word_spans(data, offsets, phrase_index.tk.ALNUM)
    hashes = phrase_index.tk.word_hashes(data, start, end, phrase_index.tk.ALNUM)
    order = np.argsort(hashes, kind="stable")
    terms, first = np.unique(hashes[order], return_index=True)
    deltas = np.diff(order, prepend=0)
    deltas[first] = order[first]
    freqs = np.diff(np.append(first, len(order)))
    return phrase_index.Segment({"docs": np.arange(len(texts)).astype("<i8").tobytes(), "words": np.bincount(row, minlength=len(texts)).astype("<u4").tobytes(), "terms": terms.astype("<u8").tobytes(), "freqs": phrase_index._planes(freqs), "postings": phrase_index._planes(deltas)})


# --- pieces --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_are_lossless_and_reproducible(spark, model_path):
    import sentencepiece

    rows = [(1, "Hello  world\n\tnew line "), (2, ""), (3, None), (4, "▁x ▁▁ é文\U0001F600\x00"), (5, " lead"), (6, "w" * 500 + " 日本語" * 80), (7, "abc " * 30_000), (8, "same text here"), (8, "same text here"), (9, "same text here")]
    df = docs(spark, rows).withColumn("pieces", F.lit("clash"))
    a = piece_lattice.encode(df, model_path, seed=4).collect()
    b = piece_lattice.encode(df.repartition(1), model_path, seed=4).collect()
    key = lambda r: (r["doc_id"], r["pieces"])
    assert sorted(map(key, a)) == sorted(map(key, b)) and all(r["lossless"] for r in a)
    reader = sentencepiece.SentencePieceProcessor(model_file=model_path)
    for r in a:
        if r["doc_id"] not in (2, 3, 4):
            assert reader.decode(r["pieces"]) == r["text"]
        assert r["n_pieces"] == len(r["pieces"]) and r["pieces_crc32"] == zlib.crc32(np.array(r["pieces"], "<u4").tobytes())
    back = piece_lattice.decode(piece_lattice.encode(docs(spark, rows), model_path, seed=4).drop("text"), model_path)
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == sorted((i, t or "") for i, t in rows)
    same = [r["pieces"] for r in a if r["doc_id"] == 8]
    assert same[0] == same[1]
    other = piece_lattice.encode(df, model_path, seed=5).collect()
    assert sorted(map(key, other)) != sorted(map(key, a))
    assert piece_lattice.encode(docs(spark, []), model_path).count() == 0


def paths(lattice, raw):
    """Every segmentation of a unit with its weight."""
    if not raw:
        return [((), 1.0)]
    out = []
    for n in range(1, len(raw) + 1):
        piece = lattice.piece_of.get(raw[:n])
        if piece is not None:
            out += [((piece, *rest), w * np.exp(lattice.log_weight[piece])) for rest, w in paths(lattice, raw[n:])]
    return out


def test_samples_follow_the_path_weights(model_path):
    lattice = piece_lattice.Lattice.at(model_path, 0.5)
    raw = b" hello"
    weights = {p: w for p, w in paths(lattice, raw)}
    total = sum(weights.values())
    n = 40_000
    data = np.frombuffer(b"hello" * n, np.uint8)
    ids, offsets = lattice.sample(data, np.arange(n + 1) * 5, np.arange(n), 1)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:]))
    assert set(seen) <= set(weights)
    for p, w in weights.items():
        want = n * w / total
        assert abs(seen[p] - want) < 6 * np.sqrt(want + 1) + 3


def test_long_units_follow_the_path_weights(model_path):
    lattice = piece_lattice.Lattice.at(model_path, 0.5)
    weights = {p: w for p, w in paths(lattice, b"abab")}
    rng = np.random.default_rng(0)
    seen = Counter(tuple(lattice.sample_huge(np.frombuffer(b"abab", np.uint8), lambda step: rng.random())) for _ in range(4000))
    total = sum(weights.values())
    for p, w in weights.items():
        want = 4000 * w / total
        assert abs(seen[p] - want) < 6 * np.sqrt(want + 1) + 3


def test_middling_units_follow_the_path_weights(model_path, monkeypatch):
    """Parts summed in the logarithms, drawn through the table as short ones are."""
    monkeypatch.setattr(piece_lattice, "LONG", 3)
    lattice = piece_lattice.Lattice(model_path, 0.5)
    weights = {p: w for p, w in paths(lattice, b" hello")}
    n, total = 20_000, sum(weights.values())
    ids, offsets = lattice.sample(np.frombuffer(b"hello" * n, np.uint8), np.arange(n + 1) * 5, np.arange(n), 1)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:]))
    assert set(seen) <= set(weights)
    for p, w in weights.items():
        assert abs(seen[p] - n * w / total) < 6 * np.sqrt(n * w / total + 1) + 3


def test_parts_end_only_where_no_edge_crosses(model_path, monkeypatch):
    lattice = piece_lattice.Lattice.at(model_path, 1.0)
    monkeypatch.setattr(piece_lattice, "PLACES", 50)
    raw = [("深度学习模型" * 9 + "abcabc" + "ру́сский" * 8).encode(), b"https://example.org/" + b"x" * 90, "ภาษาไทย".encode() * 12]
    data = np.frombuffer(b"".join(raw), np.uint8)
    end = np.cumsum([len(r) for r in raw])
    start = end - np.array([len(r) for r in raw])
    s, e = lattice.cut(data, start, end)
    want = []
    for x, y in zip(start.tolist(), end.tolist()):
        a, b, _, _ = lattice.edges(data[x:y], np.array([0]), np.array([y - x]))
        inner = [p for p in range(1, y - x) if not ((a < p) & (b > p)).any() and (data[x + p] & 0xC0) != 0x80]
        want += [(x + p, x + q) for p, q in zip([0, *inner], [*inner, y - x])]
    assert list(zip(s.tolist(), e.tolist())) == want


def test_extreme_draws_stay_inside_their_node(model_path):
    """The largest draw, after more than two million nodes: the same pieces as in an empty table, and the text comes back."""
    texts = ["internationalisation of heterogeneous thresholds", "a" * 300, "深度学习" * 30, "x" * 5000]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    plain = piece_lattice.Lattice(model_path, 1.0)
    full = piece_lattice.Lattice(model_path, 1.0)
    full.add(np.array([1], np.uint64), [b" some"])
    full.nodes = 3_000_000
    for lattice in (plain, full):
        lattice.sample(data, offsets, np.arange(len(texts)), 0)  # units are known from here on
    draws = np.float64(1 - 2.0**-53)
    got = []
    for lattice in (plain, full):
        state = np.sort(lattice.end_node.values[lattice.end_node.keys != 0])[1 if lattice is full else 0 :]
        while len(state):
            target = (state << piece_lattice.SHARE_BITS) + (np.full(len(state), draws) * 2.0**piece_lattice.SHARE_BITS).astype(np.int64)
            edge = np.searchsorted(lattice.key, target, side="right")
            assert ((lattice.key[edge] - 1) >> piece_lattice.SHARE_BITS == state).all()
            state = lattice.back[edge].astype(np.int64)
            state = state[state >= 0]
    for lattice in (plain, full):
        ids, rows = lattice.sample(data, offsets, np.arange(len(texts)), 3)
        back, ends = lattice.decode(ids, rows)
        assert np.array_equal(back, data) and np.array_equal(ends, offsets)
        got.append(ids.tolist())
    assert got[0] == got[1]


def test_edges_and_draws_need_no_binary_search(model_path, monkeypatch):
    """New units take a step in the pieces' tree a byte and draws start at their node: searches are a few a row or unit, not a few a byte."""
    lattice = piece_lattice.Lattice(model_path, 1.0)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("etaoinshrdlé文") for _ in range(rng.randrange(5, 12))) for _ in range(200)).encode() for _ in range(20)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    looked_up, search = [0], np.searchsorted

    def counted(a, v, *more, **named):
        looked_up[0] += np.size(v)
        return search(a, v, *more, **named)

    monkeypatch.setattr(np, "searchsorted", counted)
    ids, per_row = lattice.sample(data, offsets, np.arange(len(texts)), 0)
    monkeypatch.undo()
    back, ends = lattice.decode(ids, per_row)
    assert np.array_equal(back, data) and np.array_equal(ends, offsets)
    assert looked_up[0] < len(data) / 2
    raw = texts[0][:400]
    raw = raw[: raw.rindex(b" ")]
    a, b, piece, _ = lattice.edges(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))
    starts = [i for i in range(len(raw)) if raw[i] & 0xC0 != 0x80]
    want = {(i, j, lattice.piece_of[raw[i:j]]) for i in starts for j in range(i + 1, len(raw) + 1) if raw[i:j] in lattice.piece_of}
    bare = [(i, j) for i, j in zip(starts, [*starts[1:], len(raw)]) if raw[i:j] not in lattice.piece_of]
    want |= {(x, x + 1, int(lattice.byte_id[raw[x]])) for i, j in bare for x in range(i, j)}
    assert set(zip(a.tolist(), b.tolist(), piece.tolist())) == want and len(a) == len(want)


def test_text_without_spaces_costs_little_more(model_path):
    import time

    lattice = piece_lattice.Lattice.at(model_path, 1.0)
    rng = random.Random(3)
    english = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(90_000)).encode()[:400_000]
    chinese = "".join(chr(0x4E00 + int(rng.paretovariate(0.6)) % 6000) for _ in range(400_000 // 3)).encode()
    took = []
    for raw in (english, chinese):
        lattice.clear()
        begin = time.process_time()
        ids, rows = lattice.sample(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), np.array([1]), 0)
        took.append((time.process_time() - begin) / len(raw))
        back, _ = lattice.decode(ids, rows)
        assert back.tobytes() == raw
    assert took[1] < 2 * took[0], took
