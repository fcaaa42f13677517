"""Embedding near-duplicates by a pivot-permutation index.

Pivots are a bounded sample of the vectors, kept well apart: one within ``APART`` times the link angle
of another is dropped, and the other is crowded.  A vector is described by its ``nearest`` pivots in order
of nearness; it is posted in the inverted list of every pair of its first ``nearest`` pivots, so two
vectors meet where they share at least two pivots.  In a list, pairs whose count of shared pivots
reaches ``shared`` are verified by cosine in double precision.  A pair is counted in one list only,
that of its smallest shared pair of pivots.  Equal vectors are one class with a count.

Vectors within that angle of a crowded pivot are at home at the nearest such pivot.  They go to its list
instead, and to the list goes each vector that by the triangle inequality can link with one at home
there: all links of vectors at home are found.  A pair is counted at the smaller of its homes.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.blocks import into_cells
from chatledger.llm.common import group_bounds, materialize, prepare, whole_groups
from chatledger.llm.components import connected_components, star_edges

PIVOTS = 512  # bound of the sample that the driver gets
NEAREST = 7
SHARED = 2
APART = 1.5
COSINE = 0.95
CELL_ROWS = 512


def usable(vector_col: str):
    """Not null, of finite components, and not all zero."""
    v = F.col(vector_col)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    scale = np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    rows = rows / scale
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def matrix(column) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def same_kind(rows: DataFrame, vector_col: str) -> DataFrame:
    """A column ``dim``: only vectors of one length are compared."""
    return rows.withColumn("dim", F.size(vector_col))


@dataclass(frozen=True)
class Pivots:
    rows: np.ndarray  # unit vectors
    crowded: np.ndarray  # numbers of those that others of the sample lie near


def angle(cosine: float, times: float = 1.0) -> float:
    """Cosine of ``times`` the angle of ``cosine``."""
    return float(np.cos(min(np.pi, times * np.arccos(np.clip(cosine, -1, 1)))))


def well_apart(rows: np.ndarray, cosine: float = COSINE) -> Pivots:
    """Each row that is not near one kept before it."""
    near = rows @ rows.T >= angle(cosine, APART)
    kept, crowded = [], set()
    for i in range(len(rows)):
        by = np.flatnonzero(near[i, kept])
        if len(by):
            crowded.update(by.tolist())
        else:
            kept.append(i)
    return Pivots(rows[kept], np.array(sorted(crowded), np.int64))


def choose_pivots(classes: DataFrame, pivots: int = PIVOTS, cosine: float = COSINE) -> dict[int, Pivots]:
    """Unit pivots per vector length: the vector of the smallest hash in each of ``pivots`` buckets, well apart."""
    pick = classes.groupBy("dim", F.pmod(F.xxhash64(F.lit("pivot"), "c"), F.lit(pivots)).alias("b")).agg(F.min_by("v", "c").alias("v"))
    by: dict[int, list] = {}
    for r in pick.orderBy("dim", "b").collect():
        by.setdefault(r.dim, []).append(r.v)
    return {d: well_apart(unit(np.array(v, np.float64)), cosine) for d, v in by.items()}


def homes(near: np.ndarray, pivots: Pivots, cosine: float = COSINE) -> tuple[np.ndarray, list[list[int]]]:
    """Home of each row (-1: none) and the crowded pivots in whose lists it is, from its cosines with all pivots."""
    home, lists = np.full(len(near), -1), [[] for _ in near]
    if not len(pivots.crowded):
        return home, lists
    near, p = near[:, pivots.crowded], pivots.rows[pivots.crowded]
    best = near.argmax(axis=1)
    top = near[np.arange(len(near)), best]
    at_home = top >= angle(cosine, APART)
    home[at_home] = pivots.crowded[best[at_home]]
    # A row that links with one at home in h is within the link angle of it, and hardly beyond the plane between h and its own best.
    gap = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))[best]
    reach = (near >= angle(cosine, APART + 1) - 1e-9) & (top[:, None] - near <= np.sqrt(2 - 2 * cosine) * gap + 1e-9)
    # Pairs of two homes are counted at the smaller one.
    reach &= ~at_home[:, None] | (np.arange(len(p)) <= best[:, None])
    for i, j in np.argwhere(reach).tolist():
        lists[i].append(int(pivots.crowded[j]))
    return home, lists


def link_vectors(classes: DataFrame, pivots: dict[int, Pivots], cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per cell and class that links: (c, other, links): a class number, the least class it reaches in the cell, and the rows it links with.

    ``classes`` has c (class number), n (rows of the class), dim, v.
    """
    prepare(classes.sparkSession)
    parts = list(combinations(range(nearest), 2))

    def describe(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                dims = part.column("dim").to_numpy()
                for d in np.unique(dims).tolist():
                    rows = part.filter(pa.array(dims == d))
                    p = pivots[d]
                    cosines = unit(matrix(rows.column("v"))) @ p.rows.T
                    home, at = homes(cosines, p, cosine)
                    near = np.argsort(-cosines, axis=1, kind="stable")[:, :nearest]
                    near = np.sort(near, axis=1)  # the set of nearest pivots; order beyond that does not change who meets
                    added = [pa.array(near.tolist(), pa.list_(pa.int32())), pa.array(home, pa.int32()), pa.array(at, pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*rows.schema.names, "near", "home", "at"])

    described = classes.select("c", "n", "dim", "v").mapInArrow(describe, "c bigint, n bigint, dim int, v array<double>, near array<int>, home int, at array<int>")
    described = materialize(described)
    pair = F.explode(F.filter(F.array(*(F.when(F.size("near") > j, F.struct(F.get("near", F.lit(i)).alias("i"), F.get("near", F.lit(j)).alias("j"))) for i, j in parts)), lambda x: x.isNotNull()))
    # Fewer than two pivots: all vectors share the one list.
    posts = described.where("home < 0").select("c", "dim", F.when(F.size("near") > 1, F.col("near")).otherwise(F.array(F.lit(0), F.lit(1))).alias("near"))
    posts = posts.select("c", "dim", "near", pair.alias("p")).select("c", "dim", (F.col("p.i") * 65536 + F.col("p.j")).cast("int").alias("list"))
    # Lists of crowded pivots have numbers below zero.
    posts = posts.union(described.select("c", "dim", F.explode("at").alias("h")).select("c", "dim", (F.lit(-1) - F.col("h")).cast("int").alias("list")))
    posts = posts.select("c", F.xxhash64("dim", "list").alias("key"), "list")
    cells = into_cells(posts, "key", "c", cell_rows).select("cell", "side", "list", "c")
    rows = cells.join(described.drop("at"), "c")

    def run(batches):
        for group in whole_groups(batches, "cell", 4096):
            cell = group.column("cell").to_numpy()
            edges = group_bounds(cell)
            lists, side, c, n, homed = (group.column(x).to_numpy() for x in ("list", "side", "c", "n", "home"))
            near_all, vec_all = group.column("near").combine_chunks(), group.column("v").combine_chunks()
            out = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                near = matrix(near_all.slice(a, b - a)).astype(np.int64)
                v = unit(matrix(vec_all.slice(a, b - a)))
                s = side[a:b]
                left, right = (np.flatnonzero(s != 1), np.flatnonzero(s != 0))
                if lists[a] < 0:
                    h = homed[a:b] == -1 - lists[a]
                    close = v[left] @ v[right].T
                    i, j = np.nonzero((close >= cosine - 1e-9) & (h[left][:, None] | h[right]))
                else:
                    # Shared-pivot counts from the inverted lists of the cell.
                    names, at = np.unique(near, return_inverse=True)
                    held = np.zeros((b - a, len(names)), np.float32)
                    held[np.repeat(np.arange(b - a), near.shape[1]), at.ravel()] = 1
                    count = held[left] @ held[right].T
                    i, j = np.nonzero(count >= min(shared, near.shape[1]))
                i, j = left[i], right[j]
                if s[0] == 2:
                    i, j = i[i < j], j[i < j]
                good = (v[i] * v[j]).sum(axis=1) >= cosine if len(i) <= 200_000 else np.concatenate([(v[i[k : k + 200_000]] * v[j[k : k + 200_000]]).sum(axis=1) >= cosine for k in range(0, len(i), 200_000)])
                i, j = i[good], j[good]
                if lists[a] >= 0 and near.shape[1] > 1:
                    # The pair's own list: its two smallest shared pivots.
                    both = held[i] * held[j]
                    first = both.argmax(axis=1)
                    both[np.arange(len(i)), first] = 0
                    own = names[first] * 65536 + names[both.argmax(axis=1)] == lists[a]
                    i, j = i[own], j[own]
                if not len(i):
                    continue
                ids = c[a:b]
                links = np.bincount(i, n[a:b][j], b - a) + np.bincount(j, n[a:b][i], b - a)
                by_id = np.argsort(ids, kind="stable")
                rank = np.empty_like(by_id)
                rank[by_id] = np.arange(b - a)
                label = star_edges(np.stack([rank[i], rank[j]], axis=1), b - a)
                hit = np.flatnonzero(links)
                out.append((ids[hit], ids[by_id][label[rank[hit]]], links[hit].astype(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["c", "other", "links"])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "c bigint, other bigint, links bigint")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, pivots: int = PIVOTS, nearest: int = NEAREST) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id``, ``kept`` (the id is its component's).

    Null, zero and non-finite vectors link with nothing and are their own component.  Repeated vectors
    link with each other.  Vectors of other lengths are not compared.
    """
    flat = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable(vector_col), flat).alias("v"))
    # One class per vector; its number is the hash that the rows can be found by again.
    keyed = rows.withColumns({"c": F.xxhash64("v"), "c2": F.hash("v")})
    classes = keyed.where("v is not null").groupBy("c", "c2").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.first("v").alias("v"))
    classes = materialize(classes.withColumn("dim", F.size("v")))
    links = materialize(link_vectors(classes, choose_pivots(classes, pivots, cosine), cosine, nearest).groupBy("c", "other").agg(F.sum("links").alias("links")))
    comps = connected_components(links.select(F.col("c").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("c"), F.col("component").alias("root"))
    counted = links.groupBy("c").agg(F.sum("links").alias("links"))
    known = classes.select("c", "n", "least").join(counted, "c", "left").join(comps, "c", "left").withColumn("root", F.coalesce("root", "c"))
    # Written, so that the join can split a large component.
    least = materialize(known.groupBy("root").agg(F.min("least").alias("component_id")))
    of = known.join(least, "root").select("c", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = keyed.select("id", F.when(F.col("v").isNotNull(), F.col("c")).alias("c")).join(of, "c", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
