import importlib
import importlib.util
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"


def same(spark, name, sf=SF):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    df = catalog.QUERIES[name](spark, sf)
    got = df.collect()
    cursor = con.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)

    def plain(v):
        return round(v, 6) if isinstance(v, float) else v.isoformat(sep=" ") if hasattr(v, "hour") else v

    a = sorted(str([plain(r[c]) for c in sorted(names)]) for r in got)
    b = sorted(str([plain(dict(zip(names, r))[c]) for c in sorted(names)]) for r in want)
    assert a == b


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_against_duckdb(spark, name):
    same(spark, name)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_is_the_flagship(spark):
    assert entry_module.entry(spark).columns[0] == "record_key"


def test_imports_without_the_corpus_operators(monkeypatch):
    for m in [m for m in sys.modules if m.startswith("tidemark.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "tidemark.llm", None)
    module = importlib.reload(entry_module)
    assert set(module.queries()) == set(catalog.QUERIES) and set(module.oracle_sql()) == set(catalog.ORACLE_SQL)
    monkeypatch.undo()
    importlib.reload(entry_module)


def test_an_error_inside_the_corpus_operators_is_not_hidden(monkeypatch):
    for m in [m for m in sys.modules if m.startswith("tidemark.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, m)
    spec = importlib.util.find_spec("corpus_pipeline")
    if not spec:
        pytest.skip("the corpus operators are not here")
    monkeypatch.setitem(sys.modules, "numpy", None)
    with pytest.raises(ImportError):
        importlib.reload(entry_module)
    monkeypatch.undo()
    importlib.reload(entry_module)


def test_sql_is_only_for_registered_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
