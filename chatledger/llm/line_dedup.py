"""Removal of lines that many documents share, in DataFrame operations only.

1. Each line becomes a 128-bit hash of its key with its document and position; no text moves.
2. The hashes are range-partitioned by (hash, document) and sorted by (hash, document, position).  A
   common line spreads over as many ranges as its share of all rows asks for.  One pass over the order
   marks the first line of each hash in each document.
3. Marks are summed by hash, first within a partition: the number of documents that a line is found in.
4. Hashes found in enough documents are joined back to the lines.  Those that hold over 1 / ``HEAVY`` of the
   lines to drop are ``HEAVY`` at most, whatever the input, and are broadcast; no other hash is large.
5. Lines to drop set bits in 64-line words of their document's keep bitmap.  Words of which all lines
   stay are left out, so a bitmap is as long as what is dropped.  Only bitmaps go back to the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import materialize

MIN_DOCS = 10
MIN_CHARS = 1
HEAVY = 1000
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]
DOC = ["id", "t"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def _document(id_col: str, text_col: str) -> list[Column]:
    """What names a document: its id and a hash of its text."""
    return [F.col(f"`{id_col}`").alias("id"), F.xxhash64(_text(text_col)).alias("t")]


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, id, t, pos) of each line with a key of ``min_chars`` code points or more."""
    rows = docs.select(*_document(id_col, text_col), F.posexplode(F.split(_text(text_col), "\n")).alias("pos", "line"))
    rows = rows.select("id", "t", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "id", "t", "pos")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """(id, t, keep) of the documents that lose lines: ``keep`` is an array of (word, bits), by word.

    Bit ``i`` of word ``w`` tells whether line ``64 w + i`` stays; words not listed stay whole.  A key of at least
    ``min_chars`` code points found in ``min_docs`` documents or more loses all its lines, or with ``keep_first`` all but
    the first by document and position.  ``t`` is the text's hash: rows of equal id and text are one document,
    rows of equal id and other text are different ones.
    """
    ranged = hashed_lines(docs, id_col, text_col, min_chars).repartitionByRange(*HASH, *DOC)
    ordered = ranged.sortWithinPartitions(*HASH, *DOC, "pos")
    first = F.row_number().over(Window.partitionBy(*HASH, *DOC).orderBy("pos")) == 1
    lines = materialize(ordered.withColumn("first", first))
    counts = lines.groupBy(*HASH).agg(F.sum(F.col("first").cast("bigint")).alias("docs"), F.count(F.lit(1)).alias("lines"), F.min(F.struct("id", "t", "pos")).alias("head"))
    common = materialize(counts.where(F.col("docs") >= min_docs))
    total = common.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("n")).first()["n"]
    heavy = F.col("lines") * HEAVY > total
    keys = [*HASH, "head"] if keep_first else HASH
    few, many = common.where(heavy).select(*keys), common.where(~heavy).select(*keys)
    rest = lines.join(F.broadcast(few.select(*HASH)), HASH, "left_anti")
    dropped = lines.join(F.broadcast(few), HASH).unionByName(rest.join(many, HASH))
    if keep_first:
        dropped = dropped.where(F.struct("id", "t", "pos") != F.col("head"))
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = dropped.groupBy(*DOC, F.expr("pos div 64").cast("int").alias("word")).agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
    return words.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


# One bit mask a word up to the last listed, once a row, then a look at each line's bit.
_DENSE = "flatten(transform(keep, (x, j) -> concat(array_repeat(-1L, x.word - if(j = 0, 0, get(keep, j - 1).word + 1)), array(x.bits))))"
_STAYS = "coalesce(shiftrightunsigned(get(d, cast(i div 64 as int)), cast(i % 64 as int)) & 1L, 1L) = 1L"
_KEPT = f"transform(array({_DENSE}), d -> array_join(filter(split(`__text`, '\\n'), (line, i) -> {_STAYS}), '\\n'))[0]"
_LOST = "aggregate(keep, 0L, (n, x) -> n + 64 - bit_count(x.bits))"


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text that the bitmaps keep, and ``n_lines`` (before), ``n_dropped`` and ``keep``."""
    rest = [c for c in docs.columns if c.lower() not in {"n_lines", "n_dropped", "keep"}]
    names = {c: f"__c{i}" for i, c in enumerate(rest)}
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), _text(text_col).alias("__text"), *_document(id_col, text_col))
    joined = rows.alias("a").join(bitmaps.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.t") == F.col("b.t")), "left")
    joined = joined.select(*names.values(), "__text", "keep")
    kept = F.when(F.col("keep").isNull(), F.col("__text")).otherwise(F.expr(_KEPT))
    out = [kept.alias(c) if c == text_col else F.col(n).alias(c) for c, n in names.items()]
    n_lines = F.size(F.split("__text", "\n")).cast("bigint")
    return joined.select(*out, n_lines.alias("n_lines"), F.coalesce(F.expr(_LOST), F.lit(0)).cast("bigint").alias("n_dropped"), "keep")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """Each row with its text less the lines that ``min_docs`` documents or more share, as ``drop_lines`` gives it.

    Runs jobs while it is built.  Null and empty texts have one empty line, whose key is empty, and give an empty
    text.  Rows of equal id and text count as one document and each give their row; a null id is an id.  Texts of
    any length are split whole.  Nothing depends on the order of rows.  Other columns are kept; ``n_lines``,
    ``n_dropped`` and ``keep`` replace columns of these names.
    """
    return drop_lines(docs, keep_bitmaps(docs, id_col, text_col, min_docs, min_chars, keep_first), id_col, text_col)
