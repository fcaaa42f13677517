"""Approximate nearest neighbours: a forest of random-projection trees.

Equal vectors are one class with the smallest of its ids, as many as an answer can hold.  The trees are
fitted on a bounded sample of the classes (``SAMPLE``); every class is indexed in one leaf of each
tree.  A query goes down all trees through one shared priority queue, ordered by the margin to the
planes crossed, and visits leaves until they hold a share of the sample, each vector counted once.
That share is measured: held-out vectors of the sample go down the trees, and the share is the least one
at which ``RECALL`` of their true neighbours in the sample are met.  Flat data of many dimensions so
gets more leaves than data with structure, at every table size by the same rule.  The candidates of the visited leaves are reranked by exact Euclidean distance in double precision.

Leaves are dealt into blocks, and so are the queries that visit a leaf, so a popular leaf does not meet
in one task; each task keeps a query's best only.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import blocks_of, group_bounds, materialize, prepare, whole_groups
from chatledger.llm.pivot_dedup import matrix, usable

NEIGHBOURS = 10
TREES = 12
SAMPLE = 32768
LEAF = 64  # sample rows in a leaf
RECALL = 0.95  # of the held-out vectors' neighbours, sets the share of the sample that a query's leaves hold
HELD_OUT = 256  # sample vectors that the share is measured with
BLOCK = 512


class Forest:
    """Trees in arrays: a node has a plane and two children; a child below zero is leaf ``-1 - child``."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 0) -> None:
        self.planes, self.offsets, self.children, self.held = [], [], [], []  # held: sample rows of each leaf
        rng = np.random.default_rng(seed)
        self.roots = [self._grow(sample, np.arange(len(sample)), leaf, rng) for _ in range(trees)]
        dim = sample.shape[1]
        self.planes = np.array(self.planes, np.float64).reshape(-1, dim)
        self.offsets = np.array(self.offsets, np.float64)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)
        self.sample_rows = len(sample)

    def _grow(self, x: np.ndarray, rows: np.ndarray, leaf: int, rng) -> int:
        root = [0]
        todo = [(rows, root, 0)]
        while todo:
            rows, parent, side = todo.pop()
            split = self._split(x, rows, rng) if len(rows) > leaf else None
            if split is None:
                parent[side] = -1 - len(self.held)
                self.held.append(rows)
                continue
            plane, offset, left = split
            parent[side] = len(self.planes)
            self.planes.append(plane)
            self.offsets.append(offset)
            self.children.append([0, 0])
            todo += [(rows[left], self.children[-1], 0), (rows[~left], self.children[-1], 1)]
        return root[0]

    @staticmethod
    def _split(x, rows, rng):
        for _ in range(4):
            a, b = x[rng.choice(rows, 2, replace=False)]
            plane = a - b
            size = np.sqrt((plane * plane).sum())
            if size > 0 and np.isfinite(size):
                plane = plane / size
                p = x[rows] @ plane
                offset = float(np.median(p))
                left = p <= offset
                if np.isfinite(offset) and 0 < left.sum() < len(rows):
                    return plane, offset, left
        return None  # all but equal

    def leaves(self, v: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree."""
        out = np.empty((len(v), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(v), root)
            while (live := np.flatnonzero(at >= 0)).size:
                node = at[live]
                right = (v[live] * self.planes[node]).sum(axis=1) > self.offsets[node]
                at[live] = self.children[node, right.astype(np.int64)]
            out[:, t] = -1 - at
        return out

    def walk(self, q: np.ndarray) -> Iterator[tuple[int, int]]:
        """Leaves by the shared priority queue, and how many different sample rows the leaves up to each hold."""
        margins = (self.planes @ q - self.offsets).tolist() if len(self.planes) else []
        queue = [(0.0, root) for root in self.roots]
        heapq.heapify(queue)
        seen = 0
        known = np.zeros(self.sample_rows, bool)
        while queue:
            cost, node = heapq.heappop(queue)
            while node >= 0:
                m = margins[node]
                near, far = self.children_list[node][::-1] if m > 0 else self.children_list[node]
                heapq.heappush(queue, (max(cost, abs(m)), far))
                node = near
            rows = self.held[-1 - node]
            seen += len(rows) - int(np.count_nonzero(known[rows]))
            known[rows] = True
            yield -1 - node, seen

    def visit(self, q: np.ndarray, budget: int) -> list[int]:
        """Leaves until they hold ``budget`` different sample rows; all leaves of the first tree where that is every row."""
        if budget >= self.sample_rows:
            return self.first_tree
        out = []
        for leaf, seen in self.walk(q):
            out.append(leaf)
            if seen >= budget:
                break
        return out

    def budget_for(self, sample: np.ndarray, recall: float, k: int, held_out: int = HELD_OUT) -> int:
        """Sample rows to visit so that ``recall`` of the ``k`` nearest of held-out sample rows are met.

        What a query looks for in the whole table lies nearer to it than what it finds in the sample, so the
        recall on the table is at least about that measured.  Rows too few to measure with: all."""
        n = len(sample)
        if n <= k + 1:
            return n
        needed = []
        squares = np.einsum("ij,ij->i", sample, sample)
        for j in np.linspace(0, n - 1, min(held_out, n)).astype(np.int64).tolist():
            d = squares - 2 * (sample @ sample[j])  # in the order of the distances
            d[j] = np.inf
            left = set(np.argpartition(d, k - 1)[:k].tolist())
            before = 0
            for leaf, seen in self.walk(sample[j]):
                met = left.intersection(self.held[leaf].tolist())
                needed += [before + 1] * len(met)
                left -= met
                before = seen
                if not left:
                    break
        return int(np.quantile(needed, recall, method="higher"))

    @property
    def first_tree(self) -> list[int]:
        """All leaves of one tree, which hold every vector once."""
        out, todo = [], [self.roots[0]]
        while todo:
            node = todo.pop()
            if node < 0:
                out.append(-1 - node)
            else:
                todo += self.children_list[node]
        return out

    @property
    def children_list(self):
        if not hasattr(self, "_list"):
            self._list = self.children.tolist()
        return self._list


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = x - q
    out = np.sqrt((d * d).sum(axis=1))
    odd = ~np.isfinite(out)
    if odd.any():  # squares too large for a double
        m = np.abs(d[odd]).max(axis=1, keepdims=True)
        out[odd] = m[:, 0] * np.sqrt(((d[odd] / m) ** 2).sum(axis=1))
    return out


def _best(q: np.ndarray, ids: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best, each candidate once."""
    order = np.lexsort((ids, d, q))
    q, ids = q[order], ids[order]
    once = np.ones(len(q), bool)
    once[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])  # the same candidate has the same distance
    order, q = order[once], q[once]
    bounds = group_bounds(q)
    rank = np.arange(len(q)) - np.repeat(bounds[:-1], np.diff(bounds))
    return order[rank < k]


def fit_forests(vectors: DataFrame, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, k: int = NEIGHBOURS, recall: float = RECALL, share: float | None = None) -> dict[int, Forest]:
    """A forest per vector length, with the ``budget`` of its visits; the driver gets ``sample`` classes (of the smallest hash per bucket) at most."""
    pick = vectors.groupBy(F.pmod(F.xxhash64(F.lit("sample"), "c"), F.lit(sample)).alias("b")).agg(F.min_by(F.struct("dim", "v"), F.struct("c", "c2")).alias("x"))
    rows = pick.select("b", "x.dim", F.col("x.v").alias("v")).toArrow().combine_chunks().sort_by("b")
    dims = rows.column("dim").to_numpy()
    out = {}
    for d in sorted(set(dims.tolist())):
        x = matrix(rows.filter(pa.array(dims == d)).column("v"))
        out[d] = f = Forest(x, trees, leaf)
        f.budget = f.budget_for(x, recall, k) if share is None else math.ceil(share * len(x))
    return out


def vector_classes(rows: DataFrame, ids: int) -> DataFrame:
    """c, c2, dim, v of each different vector of ``rows`` (id, dim, v), and ``own``: its ``ids`` smallest ids."""
    keyed = rows.withColumns({"c": F.xxhash64("v"), "c2": F.hash("v")})
    # The rank's limit holds before the shuffle too, so a vector of very many rows sends few of them.
    rank = F.row_number().over(Window.partitionBy("c", "c2").orderBy("id")).alias("k")
    least = keyed.select("c", "c2", "id").distinct().select("c", "c2", "id", rank).where(F.col("k") <= ids)
    least = least.groupBy("c", "c2").agg(F.sort_array(F.collect_list("id")).alias("own"))
    return materialize(keyed.groupBy("c", "c2").agg(F.first("dim").alias("dim"), F.first("v").alias("v")).join(least, ["c", "c2"]))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS, trees: int = TREES, recall: float = RECALL, share: float | None = None, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest rows found for each query.

    ``share`` of the sample is visited where it is given (1: every row), else what ``recall`` asks for.

    Rows with the query's own id are no candidates.  Null, zero and non-finite vectors take no part;
    vectors meet those of their own length only.  Ties go to the smaller id.  A vector id that is given
    several times counts once, at its smallest distance.  No vectors: no rows.
    """
    prepare(vectors.sparkSession)
    flat = lambda df: df.where(usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.size(vector_col).alias("dim"), F.col(vector_col).alias("v"))
    rows, asked = flat(vectors), flat(queries)
    # One id more than is asked for, as a query's own id is no candidate.
    classes = vector_classes(rows, k + 1)
    forests = fit_forests(classes, trees, sample, k=k, recall=recall, share=share)
    classes = classes.select(F.get("own", F.lit(0)).alias("id"), "dim", "v", "own")
    asked = asked.withColumn("own", F.array().cast("array<bigint>"))
    kind = rows.schema["v"].dataType.simpleString()
    ddl = f"leaf bigint, id bigint, v {kind}, own array<bigint>"

    def each(batches, choose):
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                dims = part.column("dim").to_numpy()
                for d in np.unique(dims).tolist():
                    if d not in forests:
                        continue
                    same = part.filter(pa.array(dims == d))
                    leaf, at = choose(forests[d], matrix(same.column("v")))
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf * 65536 + d), *(same.column(x).take(take) for x in ("id", "v", "own"))], names=["leaf", "id", "v", "own"])

    def place(batches):
        yield from each(batches, lambda f, v: (f.leaves(v).ravel(), np.repeat(np.arange(len(v)), len(f.roots))))

    def visit(batches):
        def choose(f, v):
            found = [f.visit(q, f.budget) for q in v]
            return np.array([x for r in found for x in r], np.int64), np.repeat(np.arange(len(v)), [len(r) for r in found])

        yield from each(batches, choose)

    index, visits = classes.mapInArrow(place, ddl), asked.mapInArrow(visit, ddl)
    per_leaf = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).join(visits.groupBy("leaf").agg(F.count(F.lit(1)).alias("m")), "leaf")
    per_leaf = materialize(per_leaf.select("leaf", blocks_of(F.col("n"), block).alias("ki"), blocks_of(F.col("m"), block).alias("kq")))

    def dealt(df, side, own, other):
        spread = df.join(per_leaf, "leaf").withColumn("b", F.pmod(F.xxhash64(F.lit("block"), "id"), F.col(own)))
        spread = spread.withColumn("o", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        i, q = ("b", "o") if side == 0 else ("o", "b")
        return spread.select(F.xxhash64("leaf", F.col(i).cast("int"), F.col(q).cast("int")).alias("cell"), F.lit(side).alias("side"), "id", "v", "own")

    cells = dealt(index, 0, "ki", "kq").union(dealt(visits, 1, "kq", "ki"))

    def rerank(batches):
        for group in whole_groups(batches, "cell", 4096):
            cell, side, ids = (group.column(x).to_numpy() for x in ("cell", "side", "id"))
            vec, held = group.column("v").combine_chunks(), group.column("own").combine_chunks()
            size = held.value_lengths().to_numpy()
            start, held = np.cumsum(size) - size, held.flatten().to_numpy()
            bounds = group_bounds(cell)
            out = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                s = side[a:b]
                i, q = np.flatnonzero(s == 0), np.flatnonzero(s == 1)
                if not len(i) or not len(q):
                    continue
                v = matrix(vec.slice(a, b - a))
                x, least, many, first = v[i], ids[a:b][i], size[a:b][i], start[a:b][i]
                for j in q:
                    d = distances(x, v[j])
                    d[(least == ids[a + j]) & (many == 1)] = np.inf
                    # All that tie with the k-th stay until ids decide.
                    near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
                    # The ids of these classes.
                    n = many[near]
                    own = held[np.repeat(first[near] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                    d = np.repeat(d[near], n)[own != ids[a + j]]
                    own = own[own != ids[a + j]]
                    out.append((np.full(len(own), ids[a + j]), own, d))
            if out:
                q, c, d = (np.concatenate(x) for x in zip(*out, strict=True))
                keep = _best(q, c, d, k)
                yield pa.RecordBatch.from_arrays([pa.array(q[keep]), pa.array(c[keep]), pa.array(d[keep])], names=["query_id", "vec_id", "score"])

    found = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(rerank, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
