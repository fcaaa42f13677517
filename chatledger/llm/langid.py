"""Language ID by compression: the language whose raw-content zstandard dictionary makes the text smallest.

The dictionaries come from a bounded sample of labelled rows: per language at most ``SAMPLE_DOCS``
documents (those of the smallest hash in as many buckets), ``SAMPLE_CHARS`` characters of each, from a place
set by the id's hash, and ``DICTIONARY_BYTES`` bytes in all.  Whole texts are compressed, in lower case like the
dictionaries.  Sizes are code lengths: with the language's share of the labelled rows as its prior, ``score``
is the posterior of the best language, and a document whose score is below ``MIN_SCORE`` is rejected.  A text is
narrow if its smallest size is hardly below its rival, the next language or the text compressed without any
dictionary: by less than ``MIN_BYTES`` and a share of the square root of its bytes.  No prior counts there.
A narrow text is taken by its words, if the letters in whole words of one dictionary outnumber those of any
other by ``WORD_MARGIN`` of all its letters, and else rejected.  Unlearnt scripts, ties and most noise go, and so
do short texts without known words.  Where one language is learnt, the text without a dictionary is the only
rival, and long texts of another script may pass.  Letters are those of Unicode's letter classes.

Null texts and texts without a letter are ``und`` with score 0 and rejected.  Ties go to the language
with more labelled rows, then to the smaller value.  With no labelled row every document is ``und``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import prepare, with_fields

SAMPLE_DOCS = 256
SAMPLE_CHARS = 2048
DICTIONARY_BYTES = 1 << 17
ALL_DICTIONARY_BYTES = 1 << 25
LEVEL = 7
MIN_SCORE = 0.5
MIN_BYTES = 2
MIN_MARGIN = 0.03
WORD_MARGIN = 0.5
UNDETERMINED = "und"
_WORD = regex.compile(r"\p{L}+")
_LETTER = regex.compile(r"\p{L}")


def held_out(id_col: Column) -> Column:
    """Documents never learnt from: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Language:
    dictionary: bytes
    rows: int  # labelled rows


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> dict[str, Language]:
    """Dictionary and count per language.  The driver gets at most ``sample_docs`` pieces of ``SAMPLE_CHARS`` a language."""
    labelled = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}") & ~held_out(F.col("i")))
    places = F.greatest(F.lit(1), F.char_length("t") - SAMPLE_CHARS + 1)
    start = F.pmod(F.xxhash64(F.lit("place"), F.col("i").cast("string")), places.cast("bigint")).cast("int") + 1
    piece = F.struct(F.xxhash64(F.col("i").cast("string")).alias("h"), F.substring("t", start, F.lit(SAMPLE_CHARS)).alias("t"))
    bucket = F.pmod(F.xxhash64(F.lit("bucket"), F.col("i").cast("string")), F.lit(sample_docs))
    rows = labelled.select("l", bucket.alias("b"), piece.alias("p")).groupBy("l", "b").agg(F.min("p").alias("p"), F.count(F.lit(1)).alias("n")).select("l", "p.h", "p.t", "n").collect()
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r.l, []).append((r.h, r.t, r.n))
    limit = min(DICTIONARY_BYTES, ALL_DICTIONARY_BYTES // max(1, len(by)))
    return {lang: Language(" ".join(t for _, t, _ in sorted(by[lang])).lower().encode()[:limit], sum(n for _, _, n in by[lang])) for lang in sorted(by)}


def narrow(sizes: list[int], without: int, length: int) -> bool:
    """Whether the smallest of ``sizes`` is too near to the next, or to the size ``without`` a dictionary."""
    best, *others = sorted(sizes)
    return min([*others[:1], without]) - best < max(MIN_BYTES, MIN_MARGIN * math.sqrt(length))


def by_words(text: str, known: list[set[str]]) -> int | None:
    """Which of the ``known`` words cover the text, if those of one language do clearly."""
    words = _WORD.findall(text)
    held = [sum(len(w) for w in words if w in k) for k in known]
    best, second = [*sorted(held, reverse=True), 0][:2]
    return held.index(best) if best - second >= WORD_MARGIN * sum(map(len, words)) else None


def classify(docs: DataFrame, languages: dict[str, Language], text_col: str = "text", level: int = LEVEL, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with columns ``lang_pred``, ``score`` and ``rejected`` (replacing columns of these names)."""
    prepare(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "rejected")
    at = docs.columns.index(text_col)
    # Most labelled rows first, so that the first of equal costs wins.
    names = sorted(languages, key=lambda x: (-languages[x].rows, x))

    def run(batches):
        tools = []
        known = [set(_WORD.findall(languages[name].dictionary.decode(errors="ignore"))) for name in names]
        plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        total = sum(x.rows for x in languages.values())
        for name in names:
            d = zstandard.ZstdCompressionDict(languages[name].dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            tools.append((zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False), -math.log2(languages[name].rows / total)))

        def one(text):
            if not names or not text or not _LETTER.search(text):
                return UNDETERMINED, 0.0, True
            data = text.lower().encode()
            sizes = [len(tool.compress(data)) for tool, _ in tools]
            bits = [8 * size + prior for size, (_, prior) in zip(sizes, tools, strict=True)]
            best = min(bits)
            score = 1 / sum(2.0 ** max(best - b, -1000.0) for b in bits)
            at = bits.index(best)
            if narrow(sizes, len(plain.compress(data)), len(data)):
                clear = by_words(text.lower(), known)
                if clear is None:
                    return names[at], score, True
                at, score = clear, 1 / sum(2.0 ** min(max(bits[clear] - b, -1000.0), 1000.0) for b in bits)
                return names[at], score, False
            return names[at], score, score < min_score

        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                out = [one(t.as_py()) for t in part.column(at)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())],
                    names=[*part.schema.names, "lang_pred", "score", "rejected"],
                )

    return docs.mapInArrow(run, with_fields(docs.schema, "lang_pred string, score double, rejected boolean"))


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, then classify every row."""
    return classify(docs, learn(docs, id_col, text_col, lang_col), text_col)
