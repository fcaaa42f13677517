import re

import numpy as np
import pytest
import xxhash
from chatledger.llm import simhash
from chatledger.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two THREE", "a b c d", "É a b c d e\x0bf", "a a a a a a b", "ÀB Cd " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("budget", [0, 1, 4])
def test_trie_join_finds_all_pairs(budget):
    rng = np.random.default_rng(budget)
    base = rng.integers(0, 1 << 63, 20).astype(np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (200, 3)).astype(np.uint64), axis=1)
    v = np.unique(np.concatenate([base, base[rng.integers(0, 20, 200)] ^ flips]))
    got = {tuple(sorted(p)) for p in simhash.trie_pairs(v, [(0, len(v), 0, len(v))], budget).tolist()}
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= budget}
    assert got == want
    m = len(v) // 2
    cross = {tuple(sorted(p)) for p in simhash.trie_pairs(v, [(0, m, m, len(v))], budget).tolist()}
    assert cross == {(i, j) for i, j in want if i < m <= j}


@pytest.mark.parametrize("cell_rows", [8, 1024])
def test_links_connect_what_is_near(spark, cell_rows):
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 30)
    near = [int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 63, (12, 2))]
    values = sorted({int(x) for x in base} | set(near) | {0, 15, 31, -1})
    nodes = spark.createDataFrame([(v,) for v in values], "fp bigint")
    edges = simhash.link_fingerprints(nodes, cell_rows=cell_rows)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    pairs = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    want = components(pairs, values)
    assert {n: got.get(n, n) for n in values} == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == components([e for e in edges if e[0] != e[1]], {x for e in edges for x in e} )


def test_query_on_documents(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    fp = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    ids = sorted(fp)
    want = components([(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fp[a] ^ fp[b]).bit_count() <= 4], ids)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fp[i]:016x}", want[i]) for i in ids}
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == set(want.values())


def test_odd_rows(odd_docs, no_docs, clashing):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 6, 7, 8, 9]
