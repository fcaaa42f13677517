"""Incremental chat ingest.

New chat files in a folder are picked up by name (the checkpoint is the ledger of files already read).
Each micro-batch writes its cleaned messages into a ledger partitioned by (bucket, batch), and carries on
the state of the conversations that it touched: per hour the messages, first and last time, and the running
count and session number at its start.  It reads no earlier message: summaries of hours merge, and the
rows before a conversation's first new message give the numbers to go on from.  A message that comes late
renumbers the hours after it, a row an hour.  Writes are idempotent on replay.

``read_sessions`` ranks messages within their hour and adds the numbers of the hour's latest state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chatledger import schemas as S
from chatledger.functions import text as X
from chatledger.operators import messages as M
from chatledger.sources.chat_csv import CSV_GLOB, field_count, is_chat_file

FOREVER = "36500d"
BUCKETS = 256  # more buckets, less of the ledger read per batch


def bucket_of(conversation_id, buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64(conversation_id), F.lit(buckets)).cast("int")


def start(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint: str,
    ts_format: str = M.DEFAULT_TS_FORMAT,
    available_now: bool = True,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    schema = T.StructType(list(S.RAW_CHAT_SCHEMA.fields) + [T.StructField("_corrupt", T.StringType())])
    stream = (
        spark.readStream.schema(schema)
        .option("multiLine", "true")
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("pathGlobFilter", CSV_GLOB)
        .option("fileNameOnly", "true")
        .option("maxFileAge", FOREVER)  # files count as new by name, whatever their age
        .csv(raw_dir)
        .select("*", F.col("_metadata.file_name").alias("_fname"), F.col("_metadata.file_path").alias("_fpath"), F.col("_metadata.file_size").alias("_fsize"))
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark_ = batch.sparkSession
        name = X.decoded_file_name(F.col("_fname"))
        width_ok = F.col("_corrupt").isNull() | (field_count(F.col("_corrupt")) <= len(S.RAW_CHAT_COLUMNS))
        raw = batch.filter(is_chat_file(name, F.col("_fsize")) & width_ok).select(
            *S.RAW_CHAT_COLUMNS,
            name.alias("filename"),
            X.decoded_file_name(F.col("_fpath")).alias("file_path"),
            # orders by batch, then by the row's place in it
            F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.monotonically_increasing_id().alias("row")).alias("file_row"),
        )
        clean = M.assign_ids_and_roles(M.clean_messages(raw, ts_format))
        clean = clean.withColumn("bucket", bucket_of(F.col("conversation_id"), buckets)).withColumn("batch", F.lit(batch_id))
        clean.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{out_dir}/messages")
        fresh = spark_.read.schema(clean.schema).parquet(f"{out_dir}/messages").filter(F.col("batch") == batch_id)
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most `buckets` values
        if not touched:
            return
        # A replayed batch must not see itself or batches after it.
        state = _state(spark_, out_dir, (F.col("batch") < batch_id) & F.col("bucket").isin(touched))
        new = M.continue_buckets(state, M.bucket_summary(fresh))
        new = new.withColumns({"bucket": bucket_of(F.col("conversation_id"), buckets), "batch": F.lit(batch_id)})
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{out_dir}/hours")

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


_HOURS = "conversation_id string, _bucket bigint, _n bigint, _first_us bigint, _last_us bigint, _offset bigint, _prev_last_us bigint, _session_no bigint, bucket int, batch bigint"


def _state(spark: SparkSession, out_dir: str, which: F.Column) -> DataFrame:
    """Each hour of each conversation as the latest batch has it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/hours")
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return spark.createDataFrame([], _HOURS).select(*M.BUCKET_STATE)
    hours = spark.read.schema(_HOURS).parquet(f"{out_dir}/hours").filter(which)
    rest = [c for c in M.BUCKET_STATE if c not in ("conversation_id", "_bucket")]
    latest = hours.groupBy("conversation_id", "_bucket").agg(F.max_by(F.struct(*rest), "batch").alias("s"))
    return latest.select("conversation_id", "_bucket", "s.*")


def read_sessions(spark: SparkSession, out_dir: str) -> DataFrame:
    """All messages so far with index, gap and session: the messages of the ledger by the latest state of their hours."""
    msgs = spark.read.parquet(f"{out_dir}/messages").drop("bucket", "batch")
    return M.place_messages(msgs, _state(spark, out_dir, F.lit(True)))
