"""The corpus pipeline: raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.  All but the
last return the columns of ``documents``.  A document's language and source columns are never inputs
of a prediction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatledger.llm import langid, mixing, pii, simhash, unigram
from chatledger.llm.common import materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those rejected go: no letters, or a narrow margin."""
    found = langid.classify(docs, langid.learn(docs))
    return found.where("not rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest id."""
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal spans replaced by their kind."""
    return pii.mask_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at target weights: a row for each document and epoch that it is taken in."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix, checked by decoding them."""
    return unigram.encode_documents(docs, unigram.load())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again.  Runs jobs while it is built."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs


# Compression, bit distances over components and Viterbi paths are not SQL; tests/llm/test_pipeline.py holds the
# stages against plain versions on a fixture.
ORACLE_SQL = None
