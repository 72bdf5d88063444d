import duckdb
import os

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows, parts=3):
    """Documents from (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.repartition(parts) if full else df


def by_id(df, key="doc_id"):
    out = {}
    for r in df.collect():
        assert r[key] not in out, f"{key} {r[key]} twice"
        out[r[key]] = r
    return out


def against_sql(df, sql, sf=SF):
    """Whether DuckDB gives the same rows."""
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(str([dict(zip(names, r))[c] for c in sorted(names)]) for r in cursor.fetchall())
    got = sorted(str([r[c] for c in sorted(names)]) for r in df.collect())
    assert got == want


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
