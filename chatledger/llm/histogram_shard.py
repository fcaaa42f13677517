"""Sharding by histogram sort.

Documents are ordered by (text hash, id hash, row number); equal texts lie side by side.  Splitters
between shards are found by counting the exact bytes below candidate key boundaries: each round counts
the bytes of ``2**BITS`` bins inside the bracket of every splitter that is not settled, and takes the
bin that holds the wanted byte as the new bracket, until a bin is within the tolerance.  A group of
equal texts is cut only where it is larger than the tolerance.  Rows move once, to their shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import materialize

SHARDS = 16
BITS = 10
TOLERANCE = 0.001  # of a shard's bytes
ROWS_PER_BIN = 20_000
_MIN = -(1 << 63)
WORDS = ("k0", "k1", "k2")


@dataclass(frozen=True)
class Bracket:
    """Keys whose words before ``word`` equal ``exact`` and whose ``bits`` highest bits of ``word`` are ``prefix``."""

    word: int = 0
    exact: tuple[int, ...] = ()
    bits: int = 0
    prefix: int = 0

    def holds(self) -> Column:
        ok = F.lit(True)
        for name, value in zip(WORDS, self.exact, strict=False):
            ok &= F.col(name) == F.lit(value)
        if self.bits:
            ok &= _high(WORDS[self.word], self.bits) == F.lit(self.prefix)
        return ok

    def step(self) -> int:
        return min(BITS, 64 - self.bits)

    def child(self, i: int) -> Bracket:
        bits, prefix = self.bits + self.step(), (self.prefix << self.step()) | i
        if bits < 64:
            return Bracket(self.word, self.exact, bits, prefix)
        return Bracket(self.word + 1, (*self.exact, _signed(prefix)), 0, 0)

    def tightened(self, least: int, most: int) -> Bracket:
        """The bracket of the bits that all its keys have in common, given the extremes of its word."""
        if least == most:
            return Bracket(self.word + 1, (*self.exact, least), 0, 0)
        bits = 64 - ((least - _MIN) ^ (most - _MIN)).bit_length()
        return Bracket(self.word, self.exact, bits, (least - _MIN) >> (64 - bits))

    def low(self) -> tuple[int, ...]:
        """Smallest key inside."""
        rest = len(WORDS) - self.word - 1
        return (*self.exact, _signed(self.prefix << (64 - self.bits)), *[_MIN] * rest)[: len(WORDS)]


def _signed(unsigned: int) -> int:
    """The signed long that has this place in the order of signed longs."""
    return unsigned + _MIN


def _high(name: str, bits: int) -> Column:
    flipped = F.col(name).bitwiseXOR(F.lit(_MIN))
    return F.shiftrightunsigned(flipped, 64 - bits) if bits < 64 else flipped


def find_splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[tuple[int, ...]]:
    """First keys of shards 1 and up.  The driver gets at most ``(shards - 1) * 2**BITS`` counts a round."""
    total = None
    brackets: dict[int, Bracket] = {s: Bracket() for s in range(1, shards)}
    below = dict.fromkeys(brackets, 0)  # exact bytes below the bracket
    done: dict[int, tuple[int, ...]] = {}
    while brackets:
        distinct = list(dict.fromkeys(brackets.values()))
        which, bin_, word = F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
        for i, b in enumerate(distinct):
            inside = b.holds()
            which = F.when(inside, F.lit(i)).otherwise(which)
            deeper = _high(WORDS[b.word], b.bits + b.step()).bitwiseAND(F.lit((1 << b.step()) - 1).cast("bigint"))
            bin_ = F.when(inside, deeper).otherwise(bin_)
            word = F.when(inside, F.col(WORDS[b.word])).otherwise(word)
        inside = keys.select(which.alias("w"), bin_.alias("b"), word.alias("k"), "size").where("w is not null")
        counted = inside.groupBy("w", "b").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("k").alias("least"), F.max("k").alias("most")).collect()
        if total is None:
            total = sum(r.bytes for r in counted)
        hist: dict[int, list] = {}
        for r in counted:
            hist.setdefault(r.w, []).append(r)
        slack = tolerance * total / shards
        for s, b in list(brackets.items()):
            want, at = total * s / shards, below[s]
            for r in sorted(hist.get(distinct.index(b), []), key=lambda r: r.b):
                size = r.bytes
                if at + size >= want:
                    inner = b.child(r.b).tightened(r.least, r.most) if b.bits < 64 else b
                    if size <= slack or r.rows == 1 or inner.word >= len(WORDS):
                        nearer = want - at <= at + size - want
                        done[s] = b.child(r.b).low() if nearer else _after(b, r.b)
                        del brackets[s]
                    else:
                        brackets[s], below[s] = inner, at
                    break
                at += size
            else:  # no bytes at all
                done[s] = b.low()
                del brackets[s]
    return [done[s] for s in sorted(done)]


def _after(b: Bracket, i: int) -> tuple[int, ...]:
    """Smallest key past bin ``i`` of a bracket."""
    prefix, bits = ((b.prefix << b.step()) | i) + 1, b.bits + b.step()
    if prefix < 1 << bits:
        low = (*b.exact, _signed(prefix << (64 - bits)))
        return (*low, *[_MIN] * (len(WORDS) - len(low)))
    if not b.word:
        return (-_MIN,) * len(WORDS)  # past every key
    up = list(b.exact)
    up[-1] += 1
    return (*up, *[_MIN] * (len(WORDS) - len(up)))


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row: id, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard``, ``slot`` (gapless from 0 in a shard).

    Null text has size 1 and the checksum of the empty text.  Repeated rows are rows of their own and may
    part where they straddle a splitter.  No rows: no rows.  Sizes of shards differ by ``tolerance`` of a
    shard and a document at most.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("k0"),
        F.xxhash64(F.lit("id"), F.col(id_col)).alias("k1"),
        F.xxhash64(F.monotonically_increasing_id()).alias("k2"),  # parts rows that are equal otherwise; written below, so drawn once
    )
    keys = materialize(keys)
    splitters = find_splitters(keys, shards, tolerance)
    shard = F.lit(0)
    for s in splitters:
        at_least, equal = F.lit(False), F.lit(True)
        for name, value in zip(WORDS, s, strict=True):
            if value >= 1 << 63:
                equal = F.lit(False)
                break
            at_least |= equal & (F.col(name) > F.lit(value))
            equal &= F.col(name) == F.lit(value)
        shard = shard + (at_least | equal).cast("int")
    bins = max(64, -(-keys.count() // (shards * ROWS_PER_BIN)))
    rows = keys.withColumns({"shard": shard, "bin": F.pmod(F.xxhash64("k0", "k1", "k2"), F.lit(bins))})
    # Numbers within small bins, after the count of the bins before.
    counts = rows.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)))
    inner = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("k0", "k1", "k2")) - 1
    numbered = rows.withColumn("inner", inner).join(before.select("shard", "bin", "before"), ["shard", "bin"])
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("inner") + F.coalesce("before", F.lit(0))).cast("bigint").alias("slot"))


def write_shards(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", shards: int = SHARDS, tolerance: float = TOLERANCE, files: int = 1) -> None:
    """Write ``docs`` under ``path`` as folders ``__shard=0`` and up, each in ``files`` files, by one exchange."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({"k0": F.xxhash64(text), "k1": F.xxhash64(F.lit("id"), F.col(id_col)), "k2": F.lit(0).cast("bigint")})
    splitters = find_splitters(keyed.select("k0", "k1", "k2", (F.octet_length(text).cast("bigint") + 1).alias("size")), shards, tolerance)
    shard = F.lit(0)
    for s in splitters:
        shard = shard + ((F.col("k0") > s[0]) | ((F.col("k0") == s[0]) & (F.col("k1") >= s[1]))).cast("int") if s[0] < 1 << 63 else shard
    out = docs.columns
    keyed.withColumn("__shard", shard).withColumn("__file", F.pmod("k1", F.lit(files))).repartition(shards * files, "__shard", "__file").select("__shard", *out).write.partitionBy("__shard").parquet(path)
