"""JSON-lines and JSON-array scans (S3 sessions, S4 extractor results, S5 table arrays)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger import schemas as S
from chatledger.operators.sessions import first_n


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_sessions(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """S3 + L1: session records; ``limit`` falsy means all of them."""
    return first_n(spark.read.schema(S.SESSION_SCHEMA).json(path), limit)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Extractor result lines -> (session_id, conversation_id, client_id, result VARIANT, error)."""
    v = F.try_parse_json("value")
    return spark.read.text(path).select(
        F.try_variant_get(v, "$._session_id", "string").alias("session_id"),
        F.try_variant_get(v, "$._conversation_id", "string").alias("conversation_id"),
        F.try_variant_get(v, "$._client_id", "string").alias("client_id"),
        v.alias("result"),
        F.coalesce(
            F.try_variant_get(v, "$.error", "string"),
            F.when(v.isNull(), F.lit("invalid JSON line")),
        ).alias("error"),
    )


def read_json_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON array file (or folder of them).  Missing path -> empty frame; a file with
    any malformed record contributes no rows (the original loader returns [] for it)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    df = (
        spark.read.schema(full)
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    # Spark refuses scans that need only the corrupt-record column; name a data column too
    # (the extra disjunct is never true).
    probe = F.length(F.col(schema.names[0]).cast("string")) < 0
    bad = df.filter(F.col("_corrupt").isNotNull() | probe).select("_file").distinct()
    return df.join(bad, "_file", "left_anti").select(*schema.names)


def read_results_table(spark: SparkSession, path: str) -> DataFrame:
    """Results written by ``sinks.write_results_table`` (VARIANT column, no JSON parsing)."""
    return spark.read.parquet(path).select("session_id", "conversation_id", "client_id", "result", "error")
