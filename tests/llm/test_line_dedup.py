import collections
import hashlib

import duckdb
from chatledger.llm import line_dedup as L
from chatledger.llm import queries
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain(rows, least=10, chars=1):
    """doc_id, lines, dropped and hash of each row; rows of equal id and text are one document."""
    found = collections.Counter()
    for _, text in {(i, t or "") for i, t in rows}:
        found.update({key(x) for x in text.split("\n")})
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < chars or found[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def spark_rows(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=str)


def test_query_against_plain_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in queries.op13_line_dedup(spark, sf).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())
    assert found == sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(rows))
    assert sum(r[2] for r in found) > 0
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    sql = con.execute(f"select doc_id, n_lines, n_dropped, kept_sha256 from ({queries.ORACLE['op13_line_dedup']})").fetchall()
    assert sorted(sql) == found


def test_odd_rows(spark):
    shared = "A Shared line"
    rows = [(i, f"own {i}\n  a shared LINE\t\n{shared}\r\n\n") for i in range(10)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (None, f"x\n{shared}"), (None, None), (23, "é É\nÀ"), (24, shared)]
    rows += [(30, f"nine {x}") for x in range(9)] + [(31, "nine times")] * 12  # one id, texts that differ; repeated rows
    rows += [(40 + i, "eight\nnine times") for i in range(8)]  # nine documents
    rows += [(60, "\n".join([shared, "own"] * 5000) + "\n" + "z" * 300_000)]
    docs = spark.createDataFrame(rows, DOCS)
    assert spark_rows(L.line_dedup(docs)) == plain(rows)
    assert spark_rows(L.line_dedup(docs, min_docs=2)) == plain(rows, 2)
    assert spark_rows(L.line_dedup(docs, min_docs=2, min_chars=6)) == plain(rows, 2, 6)
    names = "h1 h2 id t pos line key first docs lines head word bits keep n_lines n_dropped".split()
    wide = docs.withColumns({n: F.lit("clash") for n in names})
    found = L.line_dedup(wide)
    assert spark_rows(found) == plain(rows)
    assert found.where("id = 'clash' and head = 'clash'").count() == len(rows)
    assert L.line_dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_common_lines_of_every_weight(spark, monkeypatch):
    """Heavy keys go by a broadcast, the rest by a shuffle: any border between them gives the same."""
    rows = [(i, "\n".join(f"line {k}" for k in range(70) if i % (k + 1) == 0)) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    for heavy in (1, 20, 10**6):
        monkeypatch.setattr(L, "HEAVY", heavy)
        assert spark_rows(L.line_dedup(docs, min_docs=7)) == plain(rows, 7)


def test_bitmaps_hold_only_what_is_dropped(spark):
    text = "\n".join(f"own {i}" for i in range(1000))
    rows = [(1, text + "\nboth"), (2, "both\n" + text.replace("own", "mine"))]
    maps = {r["id"]: r["keep"] for r in L.keep_bitmaps(spark.createDataFrame(rows, DOCS), min_docs=2).collect()}
    assert [(x["word"], x["bits"]) for x in maps[1]] == [(15, ~(1 << 40))]
    assert [(x["word"], x["bits"]) for x in maps[2]] == [(0, ~1)]


def test_keep_first(spark):
    rows = [(2, "b\na\nb"), (1, "a\nc\na"), (3, "c\nd")]
    found = L.line_dedup(spark.createDataFrame(rows, DOCS), min_docs=2, keep_first=True)
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {1: "a\nc", 2: "b\nb", 3: "d"}


def test_no_python_in_the_plan(spark):
    plan = L.line_dedup(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
