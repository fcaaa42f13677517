"""SimHash near-duplicates: 64-bit fingerprints and a binary-trie self-join within a Hamming budget.

Equal fingerprints are one node.  Nodes within the budget agree on at least ``BLOCKS - budget`` of
``BLOCKS`` blocks of bits; for each choice of blocks the tries below equal blocks are joined with
themselves: pairs of trie nodes go down together, differing bits add up, and a pair over the budget
is pruned.  The join is exact.  Only a spanning forest of the links of each cell leaves a task.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.blocks import into_cells
from chatledger.llm.common import group_bounds, least_row, materialize, prepare, whole_groups, with_fields
from chatledger.llm.components import connected_components, star_edges

SHINGLE = 4
MAX_DISTANCE = 4
BLOCKS = 6
CELL_ROWS = 1024
FRONTIER = 1_000_000  # trie-node pairs expanded at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes; no words give 0."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(start[: len(words) - k + 1].tolist(), end[k - 1 :].tolist(), strict=True)], np.uint64)
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for s in range(0, n, 1 << 16):
        counts += np.unpackbits(hashes[s : s + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in column ``name`` in place of the text."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                fp = np.array([fingerprint(t.as_py(), shingle) for t in part.column(at)], np.uint64).view(np.int64)
                rest = [i for i in range(part.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in rest), pa.array(fp)], names=[*(part.schema.names[i] for i in rest), name])

    return docs.mapInArrow(run, with_fields(docs.drop(text_col).schema, f"`{name}` bigint"))


def rotations(blocks: int = BLOCKS, budget: int = MAX_DISTANCE) -> list[np.ndarray]:
    """Bit orders (highest first) that put each choice of ``blocks - budget`` blocks in front."""
    if blocks <= budget:
        raise ValueError("more blocks than differing bits are needed")
    parts = np.array_split(np.arange(63, -1, -1), blocks)
    out = []
    for chosen in combinations(range(blocks), blocks - budget):
        rest = [i for i in range(blocks) if i not in chosen]
        out.append(np.concatenate([parts[i] for i in (*chosen, *rest)]))
    return out


def trie_pairs(values: np.ndarray, groups: list[tuple[int, int, int, int]], budget: int) -> np.ndarray:
    """Pairs (i, j) of places whose values differ in at most ``budget`` bits.

    ``values`` are sorted within ranges.  ``groups`` are pairs of ranges (a, b, c, d): [a, b) is joined with
    [c, d), or with itself if they are the same.  Each range is a trie: a node at a depth is the run of
    values that agree on the bits above.
    """
    found = []
    todo = [(np.array(groups, np.int64).reshape(-1, 4), np.zeros(len(groups), np.int64), 63)] if groups else []
    while todo:
        node, diff, bit = todo.pop()
        if len(node) > FRONTIER:
            half = len(node) // 2
            todo += [(node[:half], diff[:half], bit), (node[half:], diff[half:], bit)]
            continue
        if bit < 0:
            # Leaves: equal values on both sides.  Values are distinct in a range, so a node is one place.
            found.append(node[:, [0, 2]])
            continue
        # Single places are compared at once: what is left of their tries is one path each.
        single = (node[:, 1] - node[:, 0] == 1) & (node[:, 3] - node[:, 2] == 1)
        if single.any():
            x = values[node[single, 0]] ^ values[node[single, 2]]
            ok = np.bitwise_count(x) <= budget
            found.append(node[single][ok][:, [0, 2]])
            node, diff = node[~single], diff[~single]
        if not len(node):
            continue
        mask = np.uint64(1) << np.uint64(bit)
        ones = np.concatenate(([0], np.cumsum((values & mask) != 0)))

        def split(lo, hi):
            return hi - (ones[hi] - ones[lo])  # zeros come first in a sorted range

        a, b, c, d = node.T
        m, k = split(a, b), split(c, d)
        same = (a == c) & (b == d)
        children = [(a, m, c, k, diff), (m, b, k, d, diff), (a, m, k, d, diff + 1)]
        children.append((m[~same], b[~same], c[~same], k[~same], diff[~same] + 1))
        new = np.concatenate([np.stack(x[:4], axis=1) for x in children])
        cost = np.concatenate([x[4] for x in children])
        whole = (new[:, 0] < new[:, 1]) & (new[:, 2] < new[:, 3]) & (cost <= budget)
        lone = (new[:, 1] - new[:, 0] == 1) & (new[:, 0] == new[:, 2]) & (new[:, 1] == new[:, 3])  # a place with itself
        todo.append((new[whole & ~lone], cost[whole & ~lone], bit - 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def link_fingerprints(nodes: DataFrame, budget: int = MAX_DISTANCE, blocks: int = BLOCKS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints within ``budget`` bits of each other; ``nodes`` has distinct ``fp``."""
    prepare(nodes.sparkSession)
    orders = rotations(blocks, budget)

    def rotated(order):
        # Runs of neighbouring bits move together, as built-in expressions.
        runs, s = [], 0
        for e in range(1, 65):
            if e == 64 or order[e] != order[e - 1] - 1:
                runs.append((int(order[s]), int(order[e - 1]), s, e))
                s = e
        out = F.lit(0).cast("bigint")
        for top, low, s, e in runs:
            mask = (1 << (top - low + 1)) - 1
            piece = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(piece, 64 - e))
        return out

    sizes = [sum(len(np.array_split(np.arange(64), blocks)[i]) for i in chosen) for chosen in combinations(range(blocks), blocks - budget)]
    choices = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), rotated(o).alias("r"), F.shiftrightunsigned(rotated(o), 64 - n).alias("head")) for k, (o, n) in enumerate(zip(orders, sizes, strict=True)))))
    rows = nodes.select("fp", choices.alias("x")).select("fp", "x.r", F.xxhash64("x.k", "x.head").alias("key"))
    cells = into_cells(rows, "key", "fp", cell_rows).select("cell", "side", "fp", "r")

    def run(batches):
        for group in whole_groups(batches, "cell", 4096):
            cell, side, fp, r = (group.column(x).to_numpy() for x in ("cell", "side", "fp", "r"))
            value = r.view(np.uint64)
            order = np.lexsort((value, side, cell))
            cell, side, fp, value = cell[order], side[order], fp[order], value[order]
            ranges = []
            edges = group_bounds(cell)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if side[a] == 2:
                    ranges.append((a, b, a, b))
                else:
                    m = a + int(np.searchsorted(side[a:b], 1))
                    ranges.append((a, m, m, b))
            pairs = trie_pairs(value, [x for x in ranges if x[0] < x[1] and x[2] < x[3]], budget)
            if len(pairs):
                ids, at = np.unique(fp, return_inverse=True)
                label = star_edges(at[pairs], len(ids))
                moved = np.flatnonzero(label != np.arange(len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["a", "b"])

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = MAX_DISTANCE) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable by links).

    Null and word-free texts have fingerprint zero and link like any other.  Repeated rows give a row
    each.  A null id counts only where a component has no other.
    """
    rows = materialize(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), "t", shingle))
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    links = connected_components(link_fingerprints(nodes.select("fp"), budget)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    by_fp = nodes.join(links, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Written, so that the join can split a large component.
    least = materialize(by_fp.groupBy("root").agg(F.min("least").alias("component_id")))
    of = by_fp.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(of, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` less all but one of each component: the one of the smallest id (a null id comes last).

    Where rows share that id, the one of the smallest text hash stays, and of rows equal in both that of the
    smallest hash of the other columns.
    """
    # Names that no input column has.
    k, h = "__llm_key", "__llm_hash"
    rows = docs.withColumns({k: F.xxhash64(id_col), h: F.xxhash64(text_col)})
    keys = materialize(fingerprints(rows.select(F.col(id_col).alias("id"), F.col(k).alias("k"), F.col(h).alias("h"), F.col(text_col).alias("t")), "t", shingle))
    first = keys.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "h", "k")).alias("x"))
    links = connected_components(link_fingerprints(first.select("fp"), budget)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    kept = first.join(links, "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("x").alias("x")).select(F.col("x.k").alias(k), F.col("x.h").alias(h))
    return least_row(rows.join(kept, [k, h], "left_semi"), [k, h], text_col, "__llm_row").select(*(F.col(f"__llm_row.`{c}`").alias(c) for c in docs.columns))
