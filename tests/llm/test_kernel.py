import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
import re
import weakref

from tidemark.llm import common, lsh_forest, phrase_index, piece_lattice
from tidemark.llm import textkernel as tk

TEXT = st.text(st.sampled_from("aB c\t\né9-文\U0001F600.'"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_those_of_the_pattern(rows):
    data, offsets = tk.string_buffers(pa.array(rows, pa.string()))
    for kind, pattern in ((tk.SPACED, r"[^\x20\x09-\x0D]+"), (tk.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        start, end, row = tk.word_spans(data, offsets, kind)
        got = [(int(r), data[s:e].tobytes().decode()) for s, e, r in zip(start, end, row)]
        low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        want = [(i, w) for i, t in enumerate(rows) for w in re.findall(pattern, low(t or ""))]
        assert [(r, low(w)) for r, w in got] == want
        hashes = tk.word_hashes(data, start, end, kind)
        assert len(set(hashes.tolist())) == len({w for _, w in want})


def test_hash_ignores_place_and_block(monkeypatch):
    text = "ab " * 50 + "x" * 300 + " " + "x" * 300 + " y"
    data, offsets = tk.string_buffers(pa.array([text]))
    start, end, _ = tk.word_spans(data, offsets, tk.SPACED)
    whole = tk.word_hashes(data, start, end, tk.SPACED)
    assert len(set(whole.tolist())) == 3
    monkeypatch.setattr(tk, "BLOCK", 64)
    assert (tk.word_hashes(data, start, end, tk.SPACED)[:50] == whole[:50]).all()


def test_sliced_and_large_arrays():
    a = pa.array(["aa", None, "b", "cc"]).slice(1, 2)
    data, offsets = tk.string_buffers(a)
    assert data.tobytes() == b"b" and offsets.tolist() == [0, 0, 1]
    data, offsets = tk.string_buffers(a.cast(pa.large_string()))
    assert data.tobytes() == b"b"
    assert tk.string_buffers(pa.array([], pa.string()))[1].tolist() == [0]


def test_hash_table():
    keys = tk.stream(3, 50_000)
    t = tk.HashTable(4)
    t.add(keys[:100], np.arange(100))
    t.add(keys[100:], np.arange(100, 50_000))
    assert (t.find(keys) == np.arange(50_000)).all() and (t.find(tk.stream(9, 1000)) == -1).all()
    z = np.zeros(1, np.uint64)
    t.add(z, [7])
    assert t.find(z)[0] == 7


def test_byte_classes_share_their_powers():
    kinds = (tk.SPACED, tk.SPACED_EXACT, tk.ALNUM, piece_lattice._ALL)
    assert len({id(x) for kind in kinds for x in kind.powers()}) == 2
    assert sum(x.nbytes for x in tk.SPACED.powers()) < 8 << 20


def test_words_longer_than_a_block_hash_like_others(monkeypatch):
    data, offsets = tk.string_buffers(pa.array(["x" * 300_000 + " ab " + "y" * 700_000]))
    start, end, _ = tk.word_spans(data, offsets, tk.SPACED)
    got = tk.word_hashes(data, start, end, tk.SPACED)
    monkeypatch.setattr(tk, "BLOCK", 1 << 20)
    assert (tk.word_hashes(data, start, end, tk.SPACED) == got).all()


def test_memory_is_released_after_a_task_and_its_arrays(monkeypatch):
    seen, kept = [], []

    def run(batches):
        for x in batches:
            big = np.zeros(x)
            kept.append(weakref.ref(big))
            yield len(big)

    monkeypatch.setattr(common, "release", lambda: seen.append([r() for r in kept]))
    assert list(common.releasing(run)([10, 20])) == [10, 20]
    assert seen == [[None, None]]


def test_scans_of_the_pipeline_release_their_memory(spark, tmp_path, monkeypatch):
    wrapped = []
    for module in (lsh_forest, phrase_index, piece_lattice):
        monkeypatch.setattr(module, "releasing", lambda run: wrapped.append(run.__module__) or run)
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string")
    lsh_forest.signatures(docs, 5)
    phrase_index.build_index(docs, str(tmp_path / "index"))
    import public_tokenizers

    piece_lattice.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    assert wrapped == [m.__name__ for m in (lsh_forest, phrase_index, piece_lattice)]
