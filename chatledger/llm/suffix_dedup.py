"""Removal of every byte covered by a long string that also starts elsewhere.

All suffixes of a corpus do not fit a shuffle, so suffixes are sorted where repeats can be:

1. Anchors.  Each window of ``length`` bytes names one anchor, the leftmost smallest hash of its
   ``gram``-byte strings.  Equal windows name the same anchor at the same place, so windows can only
   be equal if the grams of their anchors are.  Grams seen once are dropped.
2. Classes.  Anchors with equal context (the bytes of all windows that name them) are counted by a
   partial aggregation; a context seen twice repeats as a whole.
3. Suffix sort.  The distinct contexts of one gram are merge-sorted by the suffixes that start at
   the anchor, and by the reversed prefixes that end there.  Two suffixes are compared by prefix
   polynomial hashes and binary search for their common extension; each neighbour's extension is then
   verified on the bytes.  Windows at distance ``d`` before the anchor are equal if the suffixes share
   ``length - d`` bytes and the prefixes ``d``; both orders cut into classes tell which.
4. Grams with over ``max_group`` distinct contexts go another exact way: each window is hashed
   and counted on its own, so no task holds such a group.

Results do not depend on the hashes' luck but for 128-bit equality of contexts and texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import group_bounds, materialize, prepare, whole_groups

LENGTH = 400
GRAM = 96
MAX_GROUP = 1024
CELLS = 2_000_000  # class rows evaluated at once
_B = 0x9E3779B97F4A7C15 | 1
_INV = pow(_B, -1, 1 << 64)
_U = np.uint64


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def need(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), 1 << 14)
            up = np.full(size, _B, _U)
            down = np.full(size, _INV, _U)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS = _Powers()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``h`` such that ``(h[j] - h[i]) * base**i`` hashes ``data[i:j]`` (times a constant of the length)."""
    _POWERS.need(len(data))
    out = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _POWERS.down[: len(data)], out=out[1:])
    return out


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(gram hash, first window, last window, anchor) per anchor of one text."""
    n, w = len(data), length - gram + 1
    if n < length:
        return (np.zeros(0, _U), *(np.zeros(0, np.int64),) * 3)
    h = prefix_hashes(data)
    m = n - gram + 1
    g = (h[gram:] - h[:m]) * _POWERS.up[:m]
    g = (g ^ (g >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    g ^= g >> _U(32)
    # Smallest (hash, place) in each run of w places, by blocks of w: tail of one block, head of the next.
    key = (g & _U(0xFFFFFFFF00000000)) | np.arange(m, dtype=_U)
    rows = -(-m // w)
    padded = np.full(rows * w, np.iinfo(np.uint64).max, _U)
    padded[:m] = key
    square = padded.reshape(rows, w)
    head = np.minimum.accumulate(square, axis=1).ravel()
    tail = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    at = (np.minimum(tail[:windows], head[w - 1 : w - 1 + windows]) & _U(0xFFFFFFFF)).astype(np.int64)
    starts = group_bounds(at)
    p = at[starts[:-1]]
    return g[p], starts[:-1], starts[1:] - 1, p


class _Contexts:
    """Contexts laid out in one buffer, compared from their anchors outward by hashes."""

    def __init__(self, contexts: list[bytes], left: np.ndarray) -> None:
        size = np.fromiter(map(len, contexts), np.int64, len(contexts))
        self.data = np.frombuffer(b"".join(contexts), np.uint8)
        self.at = np.cumsum(size) - size + left  # the anchor
        self.extent = {1: size - left, -1: left}
        self.hash = prefix_hashes(self.data)
        self.up = _POWERS.up

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, way: int) -> np.ndarray:
        """Whether ``size`` bytes beside the anchors hash alike."""
        i, j = (a, b) if way > 0 else (a - size, b - size)
        return (self.hash[i + size] - self.hash[i]) * self.up[i] == (self.hash[j + size] - self.hash[j]) * self.up[j]

    def common(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        """Length of the common extension, by binary search over hashes."""
        a, b = self.at[x], self.at[y]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.extent[way][x], self.extent[way][y])
        while (live := low < high).any():
            mid = (low + high + 1) >> 1
            good = self.same(a, b, mid, way)
            low = np.where(live & good, mid, low)
            high = np.where(live & ~good, mid - 1, high)
        return low

    def byte(self, x: np.ndarray, k: np.ndarray, way: int) -> np.ndarray:
        """The byte ``k`` steps from the anchor, or -1 past the extent."""
        inside = k < self.extent[way][x]
        place = np.where(inside, self.at[x] + (k if way > 0 else -1 - k), 0)
        return np.where(inside, self.data[place].astype(np.int16), np.int16(-1))

    def before(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        k = self.common(x, y, way)
        a, b = self.byte(x, k, way), self.byte(y, k, way)
        return (a < b) | ((a == b) & (x < y))

    def verified(self, x: np.ndarray, y: np.ndarray, k: np.ndarray, way: int) -> np.ndarray:
        """Whether ``k`` bytes really agree and the next ones are in order."""
        ok = self.byte(x, k, way) <= self.byte(y, k, way)
        for s in range(0, len(x), 4096):
            part = slice(s, s + 4096)
            reps = k[part]
            row = np.repeat(np.arange(len(reps)), reps)
            step = np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps)
            step = step if way > 0 else -1 - step
            wrong = self.data[self.at[x[part]][row] + step] != self.data[self.at[y[part]][row] + step]
            ok[part] &= np.bincount(row, wrong, len(reps)) == 0
        return ok

    def exact(self, x: int, way: int) -> bytes:
        a, e = int(self.at[x]), int(self.extent[way][x])
        return self.data[a : a + e].tobytes() if way > 0 else self.data[a - e : a][::-1].tobytes()

    def sort(self, bounds: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
        """Each group's members in order of their extensions, and each one's length in common with the next (-1 at a group's end)."""
        n = len(self.at)
        order = np.arange(n)
        sizes = np.diff(bounds)
        first = np.repeat(bounds[:-1], sizes)
        last = np.repeat(bounds[1:], sizes)
        width = 1
        while width < (sizes.max() if len(sizes) else 0):
            # Merge neighbouring runs of every group at once: a member's new place is its place in
            # its run and the number of members of the other run that come before it.
            place = np.flatnonzero(last - first > width)
            local = place - first[place]
            run = local // width
            other = first[place] + (run ^ 1) * width
            low = np.minimum(other, last[place])
            high = np.minimum(other + width, last[place])
            begin = low.copy()
            mine = order[place]
            while (live := np.flatnonzero(low < high)).size:
                mid = (low[live] + high[live]) >> 1
                theirs = order[mid]
                less = self.before(theirs, mine[live], way)
                low[live] = np.where(less, mid + 1, low[live])
                high[live] = np.where(less, high[live], mid)
            target = first[place] + (run & ~1) * width + local % width + (low - begin)
            order = order.copy()
            order[target] = mine
            width *= 2
        shared = np.full(n, -1, np.int64)
        inner = np.flatnonzero(np.arange(1, n + 1) < last)
        x, y = order[inner], order[inner + 1]
        shared[inner] = self.common(x, y, way)
        bad = inner[~self.verified(x, y, shared[inner], way)]
        for g in np.unique(first[bad]) if len(bad) else ():  # a hash collision: sort that group's bytes
            e = int(last[g])
            order[g:e] = sorted(range(g, e), key=lambda i: (self.exact(i, way), i))
            for k in range(g, e - 1):
                u, v = self.exact(order[k], way), self.exact(order[k + 1], way)
                shared[k] = next((i for i, (p, q) in enumerate(zip(u, v)) if p != q), min(len(u), len(v)))
        return order, shared


def repeated_distances(contexts: list[bytes], left: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, first, last distance) of the windows that two members of a group share; members of a group are distinct."""
    c = _Contexts(contexts, left)
    order_r, shared_r = c.sort(bounds, 1)
    order_l, shared_l = c.sort(bounds, -1)
    top = length - gram
    sizes = np.diff(bounds)
    group = np.repeat(np.arange(len(sizes)), sizes)
    # Distances at which the classes of either order change.
    inner = shared_r >= 0
    change = np.concatenate([np.zeros(len(sizes), np.int64), length - shared_r[inner], shared_l[shared_l >= 0] + 1])
    owner = np.concatenate([np.arange(len(sizes)), group[inner], group[shared_l >= 0]])
    keep = (change >= 0) & (change <= top)
    points = np.unique(owner[keep] * (top + 2) + change[keep])
    owner, change = points // (top + 2), points % (top + 2)
    until = np.where(np.append(owner[1:] == owner[:-1], False), np.append(change[1:], 0) - 1, top)
    out: list[tuple[np.ndarray, ...]] = []
    cells = sizes[owner]
    total = np.cumsum(cells)
    s = 0
    while s < len(points):
        e = max(s + 1, int(np.searchsorted(total, (total[s - 1] if s else 0) + CELLS, "right")))
        reps = cells[s:e]
        offset = np.cumsum(reps) - reps
        slot = np.arange(int(reps.sum())) - np.repeat(offset, reps)
        at = np.repeat(bounds[owner[s:e]], reps) + slot
        d = np.repeat(change[s:e], reps)
        start = slot == 0
        # Classes in either order: a new one begins where the neighbours share too little.
        prev = np.maximum(at - 1, 0)
        cls_r = np.cumsum(start | (shared_r[prev] < length - d))
        cls_l = np.cumsum(start | (shared_l[prev] < d))
        base = np.repeat(offset, reps) - np.repeat(bounds[owner[s:e]], reps)
        by_r, by_l = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        by_r[base + order_r[at]] = cls_r
        by_l[base + order_l[at]] = cls_l
        _, inverse, counts = np.unique((by_r << 32) | by_l, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(counts[inverse] > 1)
        # Two members in one class share the window, so it lies within both.
        out.append((at[hit], d[hit], np.repeat(until[s:e], reps)[hit]))
        s = e
    member, first, last = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*out) if out else ((), (), ())))
    return member, first, last


def _signed(x) -> np.ndarray:
    return np.asarray(x, _U).view(np.int64)


def _bytes_hash(data: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(data)
    return h >> 64, h & 0xFFFFFFFFFFFFFFFF


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """(t, t2, ivs) of every text that has repeated windows: hashes of the text, and its intervals of window starts."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(id_col)).alias("dk"), *_text_key(text), text.cast("binary").alias("data")).where(F.octet_length("data") >= length)

    def find(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                out: list[tuple] = []
                for k in range(part.num_rows):
                    raw = part.column(3)[k].as_py()
                    g, lo, hi, p = anchors(np.frombuffer(raw, np.uint8), length, gram)
                    ctx = [_bytes_hash(raw[a : b + length]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                    out.append((k, g, lo, hi + length - lo, p - lo, ctx))
                reps = np.array([len(x[1]) for x in out], np.int64)
                if not reps.sum():
                    continue
                take = pa.array(np.repeat(np.arange(part.num_rows), reps))
                ctx = np.array([c for x in out for c in x[5]], _U).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i).take(take) for i in range(3)),
                        pa.array(_signed(np.concatenate([x[1] for x in out]))),
                        pa.array(_signed(ctx[:, 0].copy())),
                        pa.array(_signed(ctx[:, 1].copy())),
                        *(pa.array(np.concatenate([x[i] for x in out]).astype(np.int32)) for i in (2, 3, 4)),
                    ],
                    names=["dk", "t", "t2", "g", "c1", "c2", "lo", "size", "left"],
                )

    found = materialize(rows.mapInArrow(find, "dk bigint, t bigint, t2 bigint, g bigint, c1 bigint, c2 bigint, lo int, size int, left int"))
    # Small sides of joins are written: Spark splits a hot key's partition only between plain exchanges.
    seen_again = materialize(found.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g"))
    repeated = found.join(seen_again, "g", "left_semi")
    key = ["g", "c1", "c2", "left"]
    # Grouped by one struct: by its parts, Spark would aggregate where the join has put a gram, hot or not.
    classes = repeated.groupBy(F.struct(*key).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("dk", "t", "t2", "lo", "size")).alias("rep"))
    classes = materialize(classes.select("key.*", "n", "rep"))

    # A context seen twice: all its windows repeat, from the first (distance left) to the last.
    whole = classes.where("n > 1").select(*key, (length - (F.col("rep.size") - F.col("left"))).alias("d1"), F.col("left").alias("d2"))

    groups = materialize(classes.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    wanted = classes.join(groups, "g").select("rep.dk", "rep.t", "rep.t2", F.struct("rep.lo", "rep.size", *key, "m").alias("a"))
    by_doc = wanted.groupBy("dk", "t", "t2").agg(F.collect_list("a").alias("list"))  # as many as a text has anchors

    def cut(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                raw, items = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                if items:
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array([x[i] for x in items], pa.int64()) for i in ("g", "c1", "c2")),
                            *(pa.array([x[i] for x in items], pa.int32()) for i in ("left", "m")),
                            pa.array([raw[x["lo"] : x["lo"] + x["size"]] for x in items], pa.binary()),
                        ],
                        names=["g", "c1", "c2", "left", "m", "ctx"],
                    )

    contexts = materialize(rows.join(by_doc, ["dk", "t", "t2"]).select("data", "list").mapInArrow(cut, "g bigint, c1 bigint, c2 bigint, left int, m int, ctx binary"))

    def compare(batches):
        for group in whole_groups(batches, "g", 4096):
            cols = [group.column(x).to_numpy() for x in key]
            new = np.ones(len(cols[0]), bool)  # repeated rows of the input give a context twice
            new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
            group = group.filter(pa.array(new))
            cols = [c[new] for c in cols]
            member, first, last = repeated_distances(group.column("ctx").to_pylist(), cols[3].astype(np.int64), group_bounds(cols[0]), length, gram)
            if len(member):
                yield pa.RecordBatch.from_arrays([pa.array(c[member]) for c in cols] + [pa.array(x.astype(np.int32)) for x in (first, last)], names=[*key, "d1", "d2"])

    ddl = "g bigint, c1 bigint, c2 bigint, left int, d1 int, d2 int"
    few = contexts.where(F.col("m") <= max_group).select(*key, "ctx").repartition("g").sortWithinPartitions(*key).mapInArrow(compare, ddl)

    def windows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                raw, left = batch.column("ctx")[k].as_py(), batch.column("left")[k].as_py()
                n = len(raw) - length + 1
                h = np.array([_bytes_hash(raw[i : i + length]) for i in range(n)], _U)
                same = [pa.array(np.full(n, batch.column(x)[k].as_py(), np.int64)) for x in key[:3]]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(np.full(n, left, np.int32)), pa.array((left - np.arange(n)).astype(np.int32)), pa.array(_signed(h[:, 0].copy())), pa.array(_signed(h[:, 1].copy()))],
                    names=[*key, "d", "w1", "w2"],
                )

    each = contexts.where(F.col("m") > max_group).select(*key, "ctx").dropDuplicates(key).mapInArrow(windows, "g bigint, c1 bigint, c2 bigint, left int, d int, w1 bigint, w2 bigint")
    again = materialize(each.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2"))
    many = each.join(again, ["w1", "w2"], "left_semi").select(*key, F.col("d").alias("d1"), F.col("d").alias("d2"))

    shared = materialize(whole.unionByName(few).unionByName(many).groupBy(*key).agg(F.collect_set(F.struct("d1", "d2")).alias("ds")))
    # Back to texts: windows start at the anchor less the distance.
    starts = F.transform("ds", lambda x: F.struct((F.col("lo") + F.col("left") - x.d2).alias("a"), (F.col("lo") + F.col("left") - x.d1).alias("b")))
    return found.join(shared, key).select("t", "t2", F.explode(starts).alias("iv")).groupBy("t", "t2").agg(F.collect_set("iv").alias("ivs"))


def _text_key(text):
    return F.xxhash64(text).alias("t"), F.shiftleft(F.octet_length(text).cast("bigint"), 32).bitwiseXOR(F.crc32(text.cast("binary"))).alias("t2")


def covered(intervals: list[tuple[int, int]], length: int, n: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows that start in the intervals (both ends included)."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        a, b = max(a, 0), min(b + length, n)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` and ``kept`` (the bytes left).

    Null text counts as empty; texts shorter than ``length`` keep all.  Repeated rows count as separate
    texts, so both lose what they share.  Whole texts are read as UTF-8 bytes; matches stay within one text.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be from 1 to length")
    repeats = materialize(find_repeats(docs, id_col, text_col, length, gram, max_group))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.cast("binary").alias("data"), *_text_key(text))
    joined = rows.join(repeats, ["t", "t2"], "left").select("id", "data", "ivs")

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                out = []
                for k in range(part.num_rows):
                    raw = part.column(1)[k].as_py()
                    spans = covered([(x["a"], x["b"]) for x in part.column(2)[k].as_py() or ()], length, len(raw))
                    edges = [0, *(x for span in spans for x in span), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in spans], kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds))], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return joined.mapInArrow(run, ddl).withColumnRenamed("id", id_col)
