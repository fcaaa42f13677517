import numpy as np
import pytest
from chatledger.llm import ann, pivot_dedup

from tests.llm.test_simhash import components

KIND = "vec_id bigint, embedding array<float>"


def clustered(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, dim))
    x = base[rng.integers(0, 40, n)] + rng.normal(size=(n, dim)) * rng.choice([0, 0.02, 0.3, 1], (n, 1))
    return x.astype(np.float32)


def frame(spark, x):
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [float("inf")] + [1.0] * 15), (1005, [None] + [1.0] * 15), (1100, [1.0, 2.0]), (1101, [2.0, 4.1])]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + odd, KIND)


@pytest.mark.parametrize("cell_rows", [16, 512])
def test_pivot_links(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(pivot_dedup, "CELL_ROWS", cell_rows)
    x = clustered(1)
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    got = {r.vec_id: r for r in pivot_dedup.near_duplicate_vectors(frame(spark, x), pivots=32, nearest=6).collect()}
    want = near.sum(axis=1) - 1
    found = sum(got[i].n_links for i in range(len(x)))
    assert all(got[i].n_links <= want[i] for i in range(len(x)))
    assert found >= 0.97 * want.sum()
    for i in range(1000, 1006):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[1101].component_id == 1100 and not got[1101].kept


def test_pivot_links_are_all_found_with_few_pivots(spark):
    # Every vector is near all pivots, so nothing can be missed: counts and components are exact.
    x = clustered(2)
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    got = {r.vec_id: r for r in pivot_dedup.near_duplicate_vectors(frame(spark, x), pivots=4, nearest=4).collect()}
    assert [got[i].n_links for i in range(len(x))] == (near.sum(axis=1) - 1).tolist()
    want = components([(i, j) for i, j in np.argwhere(near).tolist() if i < j], range(len(x)))
    assert {i: got[i].component_id for i in range(len(x))} == want


@pytest.mark.parametrize("median", [0.94, 0.96, 0.9996])
def test_links_in_a_near_copy_group_of_a_third(spark, median):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:1000] = x[0] * np.sqrt(median) + x[:1000] * np.sqrt(1 - median)
    x[1000:1100] = x[1100:1200] + rng.normal(size=(100, 64)) * 0.02
    x = x.astype(np.float32)
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KIND)
    got = {r.vec_id: r.n_links for r in pivot_dedup.near_duplicate_vectors(df).collect()}
    assert [got[i] for i in range(1000)] == want[:1000].tolist()
    assert all(got[i] <= want[i] for i in got) and sum(got.values()) >= 0.99 * want.sum()


@pytest.mark.parametrize("block", [7, 512])
def test_whole_search_is_exact(spark, block):
    x = clustered(3)
    x[50:60] = x[40]  # ties
    df = frame(spark, x)
    got = {}
    for r in ann.nearest_neighbours(df, df.where("vec_id % 10 = 0"), share=1.0, block=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    y = x.astype(np.float64)
    for q in range(0, len(x), 10):
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        assert [(k, i) for k, i, _ in sorted(got[q])] == [(k + 1, i) for k, i in enumerate(order)]
        assert np.allclose([s for _, _, s in sorted(got[q])], d[order], rtol=1e-12)
    assert sorted(got) == [*range(0, len(x), 10), 1100]
    assert [v for _, v, _ in got[1100]] == [1101]


def test_recall_on_a_share_of_the_leaves(spark):
    from tests.conftest import SF_SMALL

    path = SF_SMALL.replace("0.001", "0.1")
    df = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding")
    rows = df.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    hit = total = 0
    got = {}
    for r in ann.nearest_neighbours(df, df.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q, found in got.items():
        at = np.flatnonzero(ids == q)[0]
        d = ((x - x[at]) ** 2).sum(axis=1)
        d[at] = np.inf
        want = set(ids[np.argsort(d, kind="stable")[:10]].tolist())
        hit, total = hit + len(want & found), total + 10
    assert total and hit / total >= 0.9


def recall_of(spark, x, where, near_rows=None):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KIND)
    got = {}
    for r in ann.nearest_neighbours(df, df.where(where)).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    y, hit, asked = x.astype(np.float64), 0, [q for q in got if q != near_rows]
    for q in asked:
        d = ((y - y[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hit += len(set(np.argsort(d, kind="stable")[:10].tolist()) & set(got[q].values()))
    return hit / (10 * len(asked)), got


def test_recall_beside_a_third_of_equal_vectors(spark):
    x = np.random.default_rng(1).normal(size=(12_000, 64)).astype(np.float32)
    x[:4000] = x[0]
    recall, got = recall_of(spark, x, "vec_id = 7 or vec_id % 120 = 1 and vec_id > 4000", 7)
    assert [got[7][k] for k in range(1, 11)] == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10]
    assert len(got) > 60 and recall >= 0.9


@pytest.mark.parametrize("dim", [64, 256, 768])
def test_recall_at_any_width(spark, dim):
    x = np.random.default_rng(dim).normal(size=(11_000, dim)).astype(np.float32)
    assert recall_of(spark, x, "vec_id % 200 = 0")[0] >= 0.9


def test_structure_needs_fewer_leaves():
    rng = np.random.default_rng(3)
    flat = rng.normal(size=(6000, 64))
    lines = rng.normal(size=(6000, 4)) @ rng.normal(size=(4, 64))
    budgets = [ann.Forest(x).budget_for(x, 0.95, 10) for x in (flat, lines)]
    assert budgets[1] < 0.2 * 6000 < budgets[0] < 6000


def test_empty_tables(spark):
    none = spark.createDataFrame([], KIND)
    assert pivot_dedup.near_duplicate_vectors(none).count() == 0
    assert ann.nearest_neighbours(none, none).count() == 0


def test_repeated_ids_nulls_and_extra_columns(spark):
    from pyspark.sql import functions as F

    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [0.0, 1.0]), (3, [0.0, 2.0])]
    df = spark.createDataFrame(rows, KIND).withColumns({n: F.lit("x") for n in ("id", "v", "c", "n", "dim", "key", "cell", "side", "leaf")})
    got = sorted((r.vec_id or 0, r.n_links) for r in pivot_dedup.near_duplicate_vectors(df).collect())
    assert got == [(0, 1), (1, 2), (1, 2), (2, 2), (3, 1)]
    found = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest_neighbours(df, df.where("vec_id = 1")).orderBy("rank").collect()]
    assert found == [(1, 1, 2), (1, 2, 3)]
