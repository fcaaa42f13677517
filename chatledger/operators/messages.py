"""Message cleaning, ids/roles and 24-hour sessions.

Input contract (``raw``): the 12 string columns of a chat export plus ``filename``,
``file_path`` and ``file_row`` (a per-file increasing row number taken right after the scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatledger import schemas as S
from chatledger.functions import text as X

DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
GAP_US = S.SESSION_GAP_HOURS * HOUR_US
BUCKET_US = HOUR_US  # any width up to the session gap keeps the bucket argument valid


def clean_messages(raw: DataFrame, ts_format: str = DEFAULT_TS_FORMAT) -> DataFrame:
    """Type timestamps, drop rows without a send time and system notices, clean text, flag media."""
    return (
        raw.withColumn("sent_at", X.parse_timestamp_ntz("sent_at", ts_format))
        .withColumn("read_at", X.parse_timestamp_ntz("read_at", ts_format))
        .filter(F.col("sent_at").isNotNull())
        # a missing direction is kept: null-safe inequality
        .filter(~F.col("direction").eqNullSafe(F.lit(S.DIRECTION_NOTICE)))
        .withColumn("text", X.strip(F.coalesce(F.col("text"), F.lit(""))))
        .withColumn("is_media", X.strip(F.coalesce(F.col("media_type"), F.lit(""))) != "")
    )


def assign_ids_and_roles(msgs: DataFrame) -> DataFrame:
    return (
        msgs.withColumn("conversation_id", X.conversation_id("filename"))
        .withColumn("client_id", X.client_id("contact", "chat_id"))
        .withColumn("role", X.role("direction"))
    )


def sessionize(msgs: DataFrame, bucket_us: int = BUCKET_US) -> DataFrame:
    """Number messages per conversation and split sessions at gaps strictly over 24 hours.

    Adds ``message_index`` (0-based, ordered by ``sent_at`` then ``file_row``), ``gap_hours``
    (to the previous message, 0 for the first) and ``session_id`` (``<conv>__s<n>``).

    Skew-aware plan: no window over raw messages spans a whole conversation.  Messages are
    bucketed by time (``bucket_us``, at most the 24-hour gap; one hour by default); a gap inside
    one bucket can never exceed 24 hours, so a session can only start at the first message of
    a bucket.  A per-(conversation, bucket) summary (partial aggregation, a few values per
    bucket) carries the running message count and the break count, and the only window over
    raw messages is per (conversation, bucket).
    """
    if not 0 < bucket_us <= GAP_US:
        raise ValueError("bucket width must be positive and at most the session gap")
    m = _bucketed(msgs, bucket_us)
    # summary per (conversation, bucket): partial aggregation, so its shuffle carries a few
    # values per conversation-bucket rather than rows (cheaper than reusing the window's shuffle,
    # which column pruning would make a second full-row exchange)
    return place_messages(m, number_buckets(_summary(m)))


def _bucketed(msgs: DataFrame, bucket_us: int) -> DataFrame:
    return msgs.withColumn("_us", X.epoch_micros("sent_at")).withColumn("_bucket", F.floor(F.col("_us") / F.lit(bucket_us)))


def _summary(m: DataFrame) -> DataFrame:
    return m.groupBy("conversation_id", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.min("_us").alias("_first_us"), F.max("_us").alias("_last_us"))


def bucket_summary(msgs: DataFrame, bucket_us: int = BUCKET_US) -> DataFrame:
    """Per conversation and time bucket: messages, first and last time.  Summaries of parts merge into that of the whole."""
    return _summary(_bucketed(msgs, bucket_us))


BUCKET_STATE = ["conversation_id", "_bucket", "_n", "_first_us", "_last_us", "_offset", "_prev_last_us", "_session_no"]


def number_buckets(summary: DataFrame, port: DataFrame | None = None) -> DataFrame:
    """``summary`` with messages before (``_offset``), last time before and session number at a bucket's start.

    ``port`` has what lies before a conversation's first bucket here: ``_port`` of its messages, last time and session.
    """
    wd = Window.partitionBy("conversation_id").orderBy("_bucket")
    prior = wd.rowsBetween(Window.unboundedPreceding, -1)
    if port is None:
        none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("last_us"), F.lit(1).cast("bigint").alias("session"))
        df = summary.withColumn("_port", none)
    else:
        df = summary.join(port, "conversation_id", "left")
    return (
        df.withColumn("_offset", F.coalesce(F.sum("_n").over(prior), F.lit(0)) + F.coalesce("_port.n", F.lit(0)))
        .withColumn("_prev_last_us", F.coalesce(F.lag("_last_us").over(wd), F.col("_port.last_us")))
        .withColumn("_brk", F.coalesce(((F.col("_first_us") - F.col("_prev_last_us")) > GAP_US).cast("int"), F.lit(0)))
        .withColumn("_session_no", F.coalesce("_port.session", F.lit(1)) + F.sum("_brk").over(wd.rowsBetween(Window.unboundedPreceding, 0)))
        .select(*BUCKET_STATE)
    )


def continue_buckets(state: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``number_buckets`` that change when the summary ``new`` of further messages comes in.

    ``state`` holds the rows so far.  A conversation's rows before its first new message stay as they are, and
    the last of them carries the running numbers on; only rows from there on are merged and renumbered, so late
    messages cost what comes after them.
    """
    start = new.groupBy("conversation_id").agg(F.min("_bucket").alias("_from"))
    touched = state.join(start, "conversation_id")
    kept = F.struct((F.col("_offset") + F.col("_n")).alias("n"), F.col("_last_us").alias("last_us"), F.col("_session_no").alias("session"))
    port = touched.filter(F.col("_bucket") < F.col("_from")).groupBy("conversation_id").agg(F.max_by(kept, "_bucket").alias("_port"))
    names = ["conversation_id", "_bucket", "_n", "_first_us", "_last_us"]
    both = touched.filter(F.col("_bucket") >= F.col("_from")).select(*names).unionByName(new.select(*names))
    merged = both.groupBy("conversation_id", "_bucket").agg(F.sum("_n").alias("_n"), F.min("_first_us").alias("_first_us"), F.max("_last_us").alias("_last_us"))
    return number_buckets(merged, port)


def place_messages(m: DataFrame, numbered: DataFrame, bucket_us: int = BUCKET_US) -> DataFrame:
    """Messages with index, gap and session from the numbers of their buckets."""
    if "_bucket" not in m.columns:
        m = _bucketed(m, bucket_us)
    wi = Window.partitionBy("conversation_id", "_bucket").orderBy("_us", "file_row")
    ranked = m.withColumn("_rn", F.row_number().over(wi)).withColumn("_prev_us", F.lag("_us").over(wi))
    gap_us = F.coalesce(
        F.col("_us") - F.col("_prev_us"),
        F.col("_us") - F.col("_prev_last_us"),
        F.lit(0),
    )
    return (
        ranked.join(numbered.select("conversation_id", "_bucket", "_offset", "_prev_last_us", "_session_no"), ["conversation_id", "_bucket"])
        .withColumn("message_index", (F.col("_offset") + F.col("_rn") - 1).cast("bigint"))
        .withColumn("gap_hours", gap_us / F.lit(1e6) / F.lit(3600.0))
        .withColumn("session_id", F.concat(F.col("conversation_id"), F.lit(S.SESSION_SEPARATOR), F.col("_session_no").cast("string")))
        .drop("_us", "_bucket", "_rn", "_prev_us", "_offset", "_prev_last_us", "_session_no")
    )


def normalise(raw: DataFrame, ts_format: str = DEFAULT_TS_FORMAT) -> DataFrame:
    """Full stage 1: clean -> ids/roles -> sessions."""
    return sessionize(assign_ids_and_roles(clean_messages(raw, ts_format)))


def normalise_summary(msgs: DataFrame) -> DataFrame:
    """Files, messages, conversations and sessions after normalisation (one row).

    Rows are counted per (file, conversation, session) first, so the distinct counts expand a
    few rows per session instead of every message.
    """
    per = msgs.groupBy("file_path", "conversation_id", "session_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.countDistinct("file_path").alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("messages"),
        F.countDistinct("conversation_id").alias("conversations"),
        F.countDistinct("session_id").alias("sessions"),
    )
