"""Periodic runs of words: every maximal stretch that repeats with a period at least three times.

The words of a batch of documents stand in one array of numbers, documents parted by numbers used
once, so no repeat crosses them.  Runs are found by rising period:

1. Periods below ``SMALL`` are read off directly: stretches where word ``i`` equals word ``i + q``.
2. For ``t = SMALL/2, SMALL, 2 SMALL, ...`` (periods ``2t`` to ``4t``) a string synchronising set is
   selected: position ``i`` is in it if, of the hashes of the ``t``-word strings that start at ``i`` to
   ``i + t``, the smallest is that at one of the two ends.  Strings with a period of at most ``t/3`` take
   no part; the runs already found say which these are.  So a position is selected by its next ``2t``
   words only, and any stretch of period ``q >= 2t`` has one in each ``q`` starts.
3. A run of period ``q`` in ``2t .. 4t`` and length ``3q`` therefore holds two selected positions ``q``
   apart with equal next ``2t`` words.  Equal contexts are sorted together, and each is paired with the
   following ones less than ``4t`` away; they lie over ``t/3`` apart, so there are twelve at most.
4. A pair proposes its distance as a period.  Prefix polynomial hashes and binary search give how
   far both places agree to the right and to the left, hence the whole run; a run of several
   periods keeps the smallest.  Each run is verified on the words; one that fails is extended word by word.

Work is O(n) a scale, scales are the binary logarithm of the longest document, and a scale looks only at
documents of six times its ``t`` words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger.llm.common import prepare, with_fields

SMALL = 8  # periods below are read off directly
LEAST = 24  # words of a run at least
TIMES = 3  # periods of a run at least
BATCH_BYTES = 4 << 20
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
_B = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_TOP = _U(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Hashes:
    """Prefix polynomial hashes modulo 2^64 of an array of numbers."""

    def __init__(self, a: np.ndarray) -> None:
        n = len(a)
        self.inverse = self._powers(pow(_B, -1, 1 << 64), n)
        self.prefix = np.zeros(n + 1, _U)
        np.cumsum(_mixed(a.astype(_U) + _U(_B)) * self._powers(_B, n)[:n], out=self.prefix[1:])

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n + 1, base, _U)
        out[0] = 1
        return np.cumprod(out, out=out)

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def common(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the longest common extension of ``i`` and ``j``, at most ``most``: to the right, or ``back``."""
        low, high = np.zeros(len(i), np.int64), most.astype(np.int64)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            at = mid if back else 0
            same = self.of(i - at, mid) == self.of(j - at, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, from blocks' running minima in both directions."""
    n = len(x) - width + 1
    wide = np.full(-(-len(x) // width) * width, _TOP, _U)
    wide[: len(x)] = x
    blocks = wide.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Of runs (start, length, period) of the same place, that of the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)))] if len(runs) else runs


def _small_period_runs(a: np.ndarray) -> np.ndarray:
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, min(SMALL, len(a))):
        start, length = _stretches(a[:-q] == a[q:])
        long = length >= (TIMES - 1) * q
        start, length = start[long], length[long] + q
        found.append(np.column_stack((start, length, np.full(len(start), q))))
    return _smallest_periods(np.concatenate(found))


def synchronising_set(h: _Hashes, n: int, t: int, runs: np.ndarray) -> np.ndarray:
    """Positions selected among the first ``n`` at scale ``t``; ``runs`` hold all those of period up to ``t/3``."""
    ids = _mixed(h.of(np.arange(n - t + 1), t)) >> _U(1)
    dull = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] >= t) & (runs[:, 0] + t <= n)]
    if len(dull):
        mark = np.zeros(n - t + 2, np.int64)
        np.add.at(mark, dull[:, 0], 1)
        np.add.at(mark, np.minimum(dull[:, 0] + dull[:, 1] - t, n - t) + 1, -1)
        ids[np.cumsum(mark)[:-1] > 0] = _TOP
    least = _sliding_min(ids, t + 1)
    m = len(least)
    return np.flatnonzero((least != _TOP) & ((ids[:m] == least) | (ids[t : t + m] == least)))


def _extended(a: np.ndarray, start: int, length: int, q: int) -> tuple[int, int, int]:
    """The run of period ``q`` around a place, word by word, beginning with its middle."""
    middle = start + (length - q) // 2
    lo, hi = middle, middle
    while lo > 0 and a[lo - 1] == a[lo - 1 + q]:
        lo -= 1
    while hi + q < len(a) and a[hi] == a[hi + q]:
        hi += 1
    return lo, hi + q - lo, q


def runs_of(a: np.ndarray, longest: Callable[[int], int] | None = None) -> np.ndarray:
    """All runs of at least ``TIMES`` periods in ``a`` as rows (start, length, smallest period).

    ``longest(t)``: how many numbers from the left need be looked at for runs of ``6 t`` (default: all).
    """
    runs = _small_period_runs(a)
    h, t = _Hashes(a), SMALL // 2
    while (n := longest(t) if longest else len(a)) >= 2 * TIMES * t:
        at = synchronising_set(h, n, t, runs)
        context = h.of(at, 2 * t)
        order = np.lexsort((at, context))
        at, context = at[order], context[order]
        pairs, k = [], 1
        near = np.arange(len(at))
        while True:
            near = near[near + k < len(at)]
            near = near[(context[near] == context[near + k]) & (at[near + k] - at[near] < 4 * t)]
            if not len(near):
                break
            far = near[at[near + k] - at[near] >= 2 * t]
            pairs.append((at[far], at[far + k]))
            k += 1
        if pairs:
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            right, left = h.common(i, j, n - j), h.common(i, j, i, back=True)
            found = np.column_stack((i - left, j + right - (i - left), j - i))
            found = np.unique(found[found[:, 1] >= TIMES * found[:, 2]], axis=0)
            right = [np.array_equal(a[s : s + m - q], a[s + q : s + m]) for s, m, q in found]
            for x in np.flatnonzero(~np.array(right, bool)):  # a collision of hashes
                found[x] = _extended(a, *found[x].tolist())
            found = found[found[:, 1] >= TIMES * found[:, 2]]
            runs = _smallest_periods(np.concatenate((runs, found)))
        t *= 2
    return runs


def batch_runs(texts: list[list[int]]) -> list[np.ndarray]:
    """``runs_of`` each list of numbers, found together: the longest stand first, numbers used once between them."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    a = np.zeros(int(starts[-1]), np.int64)
    for k, s in zip(order, starts, strict=False):
        a[s : s + len(texts[k])] = texts[k]
    a[starts[1:] - 1] = -1 - np.arange(len(texts))

    def longest(t: int) -> int:
        return int(starts[np.searchsorted(-sizes, -2 * TIMES * t, "right")])

    runs = runs_of(a, longest)
    which = np.searchsorted(starts, runs[:, 0], "right") - 1
    cut = np.searchsorted(which, np.arange(len(texts) + 1))
    out: list[np.ndarray] = [runs[:0]] * len(texts)
    for x, k in enumerate(order):
        if cut[x] < cut[x + 1]:
            out[k] = runs[cut[x] : cut[x + 1]] - [int(starts[x]), 0, 0]
    return out


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with about ``BATCH_BYTES`` of text, or one longer text."""
    for batch in batches:
        text = batch.column("__text").cast(pa.binary())
        lo, held = 0, 0
        for k in range(batch.num_rows):
            held += len(text[k].as_buffer())
            if held >= BATCH_BYTES or k + 1 == batch.num_rows:
                yield batch.slice(lo, k + 1 - lo), text.slice(lo, k + 1 - lo).to_pylist()
                lo, held = k + 1, 0


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[object, int], np.ndarray | None] | None = None, least: int = LEAST) -> DataFrame:
    """Each row with ``runs`` (start, length and period in words, by start, then period) and ``collapsed``, the
    text's words, joined by single spaces, without those that a run repeats after its first period.

    A run has at least ``least`` words and three periods.  ``rewrite(id, n)`` may give the numbers of the words that
    a text of ``n`` words is replaced by before it is searched.  Null, empty and blank texts have no words, no runs and
    an empty ``collapsed``.  Texts of any length are searched whole, each in one task.  Repeated rows each give
    their row; ties and null ids have no influence.  Other columns are kept; ``runs`` and ``collapsed`` replace
    columns of these names.
    """
    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c.lower() not in {"runs", "collapsed"}]
    rows = docs.select(*(F.col(f"`{c}`") for c in rest), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    schema = with_fields(T.StructType([f for f in rows.schema if f.name != "__text"]), f"runs {RUN}, collapsed string")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch, texts in _documents(batches):
            words = [t.split() for t in texts]  # bytes: the six white-space characters of ASCII
            if rewrite:
                for k, row_id in enumerate(batch.column(id_col).to_pylist()):
                    if (places := rewrite(row_id, len(words[k]))) is not None:
                        words[k] = [words[k][p] for p in places.tolist()]
            number: dict[bytes, int] = {}
            found = batch_runs([[number.setdefault(w, len(number)) for w in x] for x in words])
            collapsed, listed = [], []
            for x, runs in zip(words, found, strict=True):
                runs = runs[runs[:, 1] >= least]
                listed.append([{"start": s, "length": m, "period": q} for s, m, q in runs.tolist()])
                if len(runs):
                    drop = np.zeros(len(x) + 1, np.int64)
                    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
                    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
                    x = [x[p] for p in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
                collapsed.append(b" ".join(x))
            kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "__text"]
            out = pa.array(collapsed, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*kept, pa.array(listed, kind), out], [f.name for f in schema])

    return rows.mapInArrow(search, schema)
