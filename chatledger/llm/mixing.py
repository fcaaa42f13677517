"""Mixing sources to target weights, in DataFrame operations only.

The words of a source, document after document in hash order, are packed into blocks of ``BLOCK``
words.  Each output shard draws its counts of sources as a multinomial over the targets.  A source's
draws are numbered over the shards; number ``j`` goes through a pseudorandom permutation of the
source's block indexes (a new one each epoch), and blocks are joined by index.  Draws beyond a source's
target are not taken and missing ones come in one more shard, so each source meets its target within a block.
A source gets no more draws than twice its blocks, so no block is taken more than twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import WORD, least_row, materialize

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
SHARE = 1.5  # of all words
EPOCHS = 2  # a source is taken this often at most
BLOCK = 64  # words
SHARDS = 256
ROUNDS = 16  # of the permutation
SEED = 20240613
CHUNK = 4096
TICKET_BUCKETS = 4096
ROWS_PER_BIN = 20_000
DRAWS_PER_TASK = 1_000_000


def permuted(x: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 .. n-1 by swap-or-not rounds."""

    def swap(acc, r):
        partner = F.pmod(F.xxhash64(F.lit(SEED), F.lit("partner"), *key, r) - acc, n)
        coin = F.xxhash64(F.lit(SEED), F.lit("coin"), *key, r, F.greatest(acc, partner))
        return F.when(coin.bitwiseAND(F.lit(1).cast("bigint")) == 1, partner).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), x.cast("bigint"), swap)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK) -> DataFrame:
    """Per source: number ``s``, ``source_size``, ``target``, ``blocks``, draws ``n`` and first draw ``first``.

    ``sizes`` has (source, source_size): a table of sources, not of documents.  A target stops at
    ``epochs`` times the source's size; the excess goes to the others by weight until none is above:
    with sources by size over weight, all before the first that keeps its share stop.
    """
    all_ = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("s") % len(weights) + 1).cast("int"))
    t = sizes.withColumn("s", place.cast("int")).withColumn("w", weight)
    t = t.withColumns({"cap": F.col("source_size") * float(epochs), "all": F.sum("source_size").over(all_) * share, "weights": F.sum("w").over(all_)})
    t = t.withColumn("ratio", F.col("cap") / F.col("w"))
    before = Window.orderBy("ratio", "s").rowsBetween(Window.unboundedPreceding, -1)
    taken = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    t = t.withColumn("level", (F.col("all") - taken("cap")) / (F.col("weights") - taken("w")))
    settled = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "s", "level"))).over(all_)
    t = t.withColumn("target", F.least("cap", F.col("w") * F.coalesce(settled["level"], F.lit(float("inf")))))
    t = t.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("bigint"))
    # The last block may be short, so draws count a source's mean block.
    n = F.when(F.col("source_size") > 0, F.least(F.col("blocks") * epochs, F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint"))).otherwise(F.lit(0))
    t = t.withColumn("n", n.cast("bigint"))
    first = F.coalesce(F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return t.select("source", "s", "source_size", "target", "blocks", "n", first.alias("first"))


def draw(targets: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """Per shard and source: (s, shard, j0, count): the multinomial counts and the number of a source's draws before."""
    spark = targets.sparkSession
    wide = max(1, -(-total // TICKET_BUCKETS))
    tickets = targets.where("n > 0").select("s", "n", "first", F.explode(F.sequence(F.expr(f"first div {wide}"), F.expr(f"(first + n - 1) div {wide}"))).alias("bucket"))
    per = max(1, -(-total // shards))
    slots = spark.range(total).select(F.expr(f"id div {per}").cast("int").alias("shard"), F.pmod(F.xxhash64(F.lit(SEED), F.lit("draw"), "id"), F.lit(total)).alias("ticket"))
    slots = slots.withColumn("bucket", F.expr(f"ticket div {wide}"))
    inside = (F.col("ticket") >= F.col("first")) & (F.col("ticket") < F.col("first") + F.col("n"))
    counts = slots.join(tickets, "bucket").where(inside).groupBy("s", "shard").agg(F.count(F.lit(1)).alias("drawn"))
    by_shard = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("j0", F.coalesce(F.sum("drawn").over(by_shard), F.lit(0)))
    kept = counts.join(targets.select("s", "n"), "s").select("s", "shard", "j0", F.least(F.col("drawn"), F.col("n") - F.col("j0")).alias("count"))
    drawn = counts.groupBy("s").agg(F.sum("drawn").alias("drawn"))
    more = targets.join(drawn, "s", "left").select("s", F.lit(shards).alias("shard"), F.coalesce("drawn", F.lit(0)).alias("j0"), (F.col("n") - F.coalesce("drawn", F.lit(0))).alias("count"))
    return kept.union(more).where("count > 0")


def pick_blocks(targets: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """(s, shard, epoch, block) of every draw taken."""
    runs = draw(targets, total, shards)
    chunks = runs.withColumn("c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1, F.lit(CHUNK).cast("bigint"))))
    chunks = chunks.select("s", "shard", (F.col("j0") + F.col("c")).alias("j"), F.least(F.lit(CHUNK), F.col("count") - F.col("c")).alias("count"))
    # A fixed number of partitions: the rows are few here, so Spark would merge them, but many below.
    parts = max(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // DRAWS_PER_TASK))
    chunks = chunks.repartition(parts, "s", "j")
    each = chunks.select("s", "shard", F.explode(F.sequence(F.col("j"), F.col("j") + F.col("count") - 1)).alias("j")).join(targets.select("s", "blocks"), "s")
    epoch = F.expr("j div blocks")
    return each.select("s", "shard", epoch.alias("epoch"), permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.col("s"), epoch).alias("block"))


def _source_hash(source_col: str) -> Column:
    source = F.col(f"`{source_col}`").cast("string")
    return F.xxhash64(source.isNull(), source)


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share, epochs, block) -> tuple[DataFrame, DataFrame, int]:
    """Rows (id, h, s, size, start) by place in their source, the targets, and the number of draws."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("bigint")
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), _source_hash(source_col).alias("hs"), F.col(source_col).cast("string").alias("source"), size.alias("size")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, share, epochs, block))
    total = targets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    bins = max(64, -(-rows.count() // ROWS_PER_BIN))
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rows = rows.withColumns({"k": F.xxhash64(F.lit(SEED), "id", "h")}).withColumn("bin", F.pmod("k", F.lit(bins)))
    held = rows.groupBy("s", "bin").agg(F.sum("size").alias("words"))
    before = held.withColumn("before", F.coalesce(F.sum("words").over(Window.partitionBy("s").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("s", "bin", "before")
    inner = F.coalesce(F.sum("size").over(Window.partitionBy("s", "bin").orderBy("k", "id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("inner", inner).join(before, ["s", "bin"])
    return placed.select("id", "h", "hs", "s", "source_size", "target", "size", (F.col("before") + F.col("inner")).alias("start")), targets, total


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """A row for each block that a document lies in: word ``lo`` of the document and ``len`` words from there."""
    spread = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    lo = F.greatest(F.lit(0).cast("bigint"), F.col("block") * block - F.col("start"))
    hi = F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start"))
    return spread.withColumns({"lo": lo, "len": hi - lo})


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """Per row: id, ``size``, ``source_size``, ``target`` (its source's), ``taken`` (words the mix takes, repeats counted).

    Null and word-free texts have size 0 and give nothing.  A null source is a source, the last.  Repeated
    rows each have a place of their own.  Reruns agree: nothing depends on the order of rows.
    """
    placed, targets, total = _placed(docs, id_col, text_col, source_col, weights, share, epochs, block)
    times = pick_blocks(targets, total, shards).groupBy("s", "block").agg(F.count(F.lit(1)).alias("times"))
    key = ["id", "s", "start", "size", "source_size", "target"]
    taken = _pieces(placed, block).join(times, ["s", "block"], "left").groupBy(*key).agg(F.sum(F.col("len") * F.coalesce("times", F.lit(0))).alias("taken"))
    empty = placed.where("size = 0").select(*key, F.lit(0).cast("bigint").alias("taken"))
    return taken.union(empty).select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str = "n_chars", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """The mix as rows of ``docs``: for each place of a document and epoch, its words in blocks taken, in order.

    A document taken whole keeps its text; else its words are joined by single spaces.  Documents of which
    nothing is taken do not appear.  Other columns are kept.  Rows of equal id, text and source have a place
    each in the mix, and the row of the smallest hash of its other columns stands for all of them.
    """
    placed, targets, total = _placed(docs, id_col, text_col, source_col, weights, share, epochs, block)
    picks = pick_blocks(targets, total, shards).select("s", "epoch", "block")
    one = ["id", "h", "hs", "start", "epoch", "size"]
    parts = _pieces(placed, block).join(picks, ["s", "block"]).groupBy(*one).agg(F.sum("len").alias("words"), F.sort_array(F.collect_list(F.struct("lo", "len"))).alias("parts"))
    k, h, hs, row, times, words = (f"__llm_{n}" for n in ("key", "hash", "source", "row", "times", "words"))
    taken = F.struct((F.col("words") < F.col("size")).alias("cut"), "parts")
    parts = parts.groupBy(F.xxhash64("id").alias(k), F.col("h").alias(h), F.col("hs").alias(hs)).agg(F.collect_list(taken).alias(times))
    keyed = docs.withColumns({k: F.xxhash64(F.col(f"`{id_col}`")), h: F.xxhash64(F.col(f"`{text_col}`")), hs: _source_hash(source_col)})
    joined = least_row(keyed, [k, h, hs], text_col, row).join(parts, [k, h, hs])
    # The text is split once for all its places and epochs, and only the texts made from it leave the expression.
    split = F.when(F.exists(times, lambda t: t.cut), F.regexp_extract_all(F.col(f"{row}.`{text_col}`"), F.lit(f"({WORD})")))
    some = lambda t, w: F.array_join(F.flatten(F.transform(t.parts, lambda p: F.slice(w, (p.lo + 1).cast("int"), p.len.cast("int")))), " ")
    texts = F.transform(F.array(split), lambda w: F.transform(times, lambda t: F.when(t.cut, some(t, w))))[0]
    out = joined.select(row, F.explode(texts).alias(words))
    cut = F.col(words).isNotNull()
    kept = {c: F.col(f"{row}.`{c}`") for c in docs.columns}
    kept[text_col] = F.coalesce(F.col(words), kept[text_col])
    if length_col in docs.columns:
        kept[length_col] = F.when(cut, F.length(words).cast(docs.schema[length_col].dataType)).otherwise(kept[length_col])
    return out.select(*(c.alias(n) for n, c in kept.items()))
