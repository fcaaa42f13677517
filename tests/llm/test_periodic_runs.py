import hashlib
import random
import re
import zlib

import numpy as np
from chatledger.llm import periodic_runs as P
from chatledger.llm import queries
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(a, least=1):
    """(start, length, smallest period) of all maximal stretches of three periods, period by period."""
    n, out = len(a), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and a[i] == a[i + q]:
                i += 1
            if i - s >= 2 * q:
                out.setdefault((s, i - s + q), q)
            i += i == s or 1
    return sorted((s, m, q) for (s, m), q in out.items() if m >= least)


def plain_row(doc_id, text, planted=True):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if planted and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 24)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = (None,) * 4
    if runs:
        s, m, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, m, q, 1000 * m // q)
    return (len(runs), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def texts(rng, sizes):
    out = []
    for n in sizes:
        sigma = rng.choice([1, 2, 3, 50])
        a = [rng.randrange(sigma) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n > 10 else 0):
            s = rng.randrange(n)
            p = rng.randint(1, max(1, (n - s) // 3))
            b = [rng.randrange(sigma) for _ in range(p)]
            if rng.random() < 0.5 and p > 4:
                r = rng.randint(1, p // 3 + 1)
                b = (b[:r] * (p // r + 1))[:p]
            for i in range(s, min(n, s + int(p * rng.uniform(2.5, 6)))):
                a[i] = b[(i - s) % p]
        out.append(a)
    return out


def test_runs_against_all_periods():
    rng = random.Random(1)
    for _ in range(200):
        batch = texts(rng, [rng.choice([0, 1, 5, 30, 100, 300, 700]) for _ in range(rng.randint(1, 6))])
        for a, found in zip(batch, P.batch_runs(batch), strict=True):
            assert sorted(map(tuple, found.tolist())) == plain_runs(a)


def test_words_made_of_repeats():
    fibonacci, last = [0, 1], [0]
    while len(fibonacci) < 2000:
        fibonacci, last = fibonacci + last, fibonacci
    thue_morse = [i.bit_count() & 1 for i in range(300)] * 5
    for a in (fibonacci, thue_morse, [0] * 500, [0, 1] * 300 + [1, 0] * 300, list(range(40)) * 9 + list(range(13)) * 20):
        assert sorted(map(tuple, P.batch_runs([a])[0].tolist())) == plain_runs(a)


def test_colliding_hashes_are_verified(monkeypatch):
    """With a hash that forgets most words, what is proposed too long is extended word by word."""
    a = texts(random.Random(3), [400])[0] + list(range(30)) * 4
    real = P._mixed
    monkeypatch.setattr(P, "_mixed", lambda x: real(x & np.uint64(3)))
    for s, m, q in P.batch_runs([a])[0].tolist():
        assert a[s : s + m - q] == a[s + q : s + m]
        assert (s == 0 or a[s - 1] != a[s - 1 + q]) and (s + m == len(a) or a[s + m] != a[s + m - q])


def test_selected_positions_depend_on_context_only():
    a = np.array(texts(random.Random(4), [900])[0] * 2)
    for t in (4, 8, 16, 32):
        runs = P._small_period_runs(a) if t <= 24 else P.runs_of(a)
        at = set(P.synchronising_set(P._Hashes(a), len(a), t, runs).tolist())
        for i in range(900 - 2 * t):
            assert (i in at) == (i + 900 in at)


def result(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) for r in df.collect()}


def test_query_against_plain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = result(queries.op12_periodic_runs(spark, "/root/testdata/sf0.001"))
    assert len(found) == len(docs)
    for d in docs:
        if len(d["text"] or "") < 8000:
            assert found[d["doc_id"]] == plain_row(d["doc_id"], d["text"]), d["doc_id"]
    assert sum(r[0] > 0 for r in found.values()) >= 10


def test_odd_rows(spark, odd_docs, clashing, no_docs, tmp_path):
    found = P.find_runs(odd_docs).collect()
    assert len(found) == odd_docs.count() and found[0].asDict().keys() == {*odd_docs.columns, "runs", "collapsed"}
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["runs"] == [] and by_id[i]["collapsed"] == "" for i in (1, 2, 3))
    assert by_id[8]["collapsed"] == " ".join(WORD.findall(by_id[8]["text"]))
    assert sorted(P.find_runs(clashing).select("doc_id", "collapsed").collect(), key=str) == sorted(((r["doc_id"], r["collapsed"]) for r in found), key=str)
    assert P.find_runs(no_docs).collect() == []
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    for r in odd_docs.where(F.length("text") < 5000).union(odd_docs.where("text is null")).collect():
        assert result(queries.op12_periodic_runs(spark, str(tmp_path)))[r["doc_id"]] == plain_row(r["doc_id"], r["text"])


def test_one_long_text_with_a_long_period(spark):
    period = [f"w{i}" for i in range(20_000)]
    text = " ".join(["x", *period, *period, *period, *period[:5], "y"])
    row = P.find_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 60_005, 20_000)]
    assert row["collapsed"] == " ".join(["x", *period, "y"])
