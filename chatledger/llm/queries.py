"""The registered queries of the operators, one each, over the whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger.llm import ann, conversation_repair, histogram_shard, html_extract, langid, line_dedup, mixing, periodic_runs, pii, pivot_dedup, simhash, suffix_dedup, unigram
from chatledger.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.detect_pii(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return unigram.encode_documents(docs, unigram.load()).drop("tokens")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_histogram_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    shards = histogram_shard.assign_shards(docs)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op9_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    dictionaries = langid.learn(docs)
    found = langid.classify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs jobs while it is built.  The hash of a conversation's repaired rows is one stream of them."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    done = conversation_repair.digest(conversation_repair.repair(conversation_repair.damage(rows)))
    every = rows.select("conv_id").distinct()
    joined = every.join(done, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repeat_words(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the ids, the places of the words that make a document periodic from word ``a`` on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    a, g = h // 10 % n, h // 10
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((np.arange(a), a + np.arange(n - a) % p))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = periodic_runs.find_runs(docs, rewrite=repeat_words)
    # Runs come by start, then period: a later one must be longer for its period to be taken.
    best = F.expr("aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0), (b, x) -> if(x.length * b.period > b.length * x.period, x, b))")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("b"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * b.length div b.period")
    return out.select("doc_id", "n_runs", "b.start", "b.length", "b.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs jobs while it is built."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_suffix_dedup, op3_ann, op4_html_extract, op5_sentencepiece, op6_simhash, op7_histogram_shard, op8_mixing, op9_pivot_dedup, op10_langid, op11_conversation_repair, op12_periodic_runs, op13_line_dedup)
}
ORACLE: dict[str, str] = {
    "op13_line_dedup": """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
common as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(common.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where common.key is null), '')) as kept_sha256
from keyed left join common using (key)
group by doc_id
""",
}
