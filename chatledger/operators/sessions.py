"""Session records, per-session dates, first contact and transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger import schemas as S
from chatledger.functions import text as X


def exportable(msgs: DataFrame) -> DataFrame:
    """Messages that go into session records: user/assistant role and non-empty text."""
    return msgs.filter(F.col("role").isin(S.ROLE_USER, S.ROLE_ASSISTANT) & (F.length("text") > 0))


def _ordered_messages() -> F.Column:
    # sort key first so array_sort orders by (sent_at, message_index)
    return F.array_sort(
        F.collect_list(
            F.struct(
                F.col("sent_at").alias("k1"),
                F.col("message_index").alias("k2"),
                F.col("role"),
                F.col("text").alias("content"),
                X.iso_timestamp("sent_at").alias("timestamp"),
            )
        )
    )


def session_records(msgs: DataFrame) -> DataFrame:
    """One nested record per (conversation, session): client of the first message and the
    ordered ``messages`` array of {role, content, timestamp}."""
    grouped = exportable(msgs).groupBy("conversation_id", "session_id").agg(
        F.min_by("client_id", F.struct("sent_at", "message_index")).alias("client_id"),
        _ordered_messages().alias("_m"),
    )
    return grouped.select(
        "conversation_id",
        "session_id",
        F.coalesce("client_id", F.lit("")).alias("client_id"),
        F.transform("_m", lambda e: F.struct(e["role"].alias("role"), e["content"].alias("content"), e["timestamp"].alias("timestamp"))).alias("messages"),
    )


def session_summary(msgs: DataFrame) -> DataFrame:
    """Scalar per-session facts (partial aggregation only; no arrays)."""
    return exportable(msgs).groupBy("conversation_id", "session_id").agg(
        F.min_by("client_id", F.struct("sent_at", "message_index")).alias("client_id"),
        F.count(F.lit(1)).alias("n_messages"),
        F.min("sent_at").alias("first_at"),
        F.max("sent_at").alias("last_at"),
    )


def session_last_date(msgs: DataFrame) -> DataFrame:
    """Date (YYYY-MM-DD) of the last exported message of each session."""
    return exportable(msgs).groupBy("session_id").agg(
        F.substring(X.iso_timestamp(F.max("sent_at")), 1, 10).alias("last_date")
    )


def client_first_contact(summary: DataFrame) -> DataFrame:
    """First session of each client in record order (conversation_id, session_id as strings),
    timestamp of its first message."""
    return summary.groupBy("client_id").agg(
        X.iso_timestamp(F.min_by("first_at", F.struct("conversation_id", "session_id"))).alias("first_contact")
    )


def _lines(msgs: DataFrame, with_ts: bool) -> F.Column:
    label = F.when(F.col("role") == S.ROLE_USER, F.lit(S.TRANSCRIPT_USER_LABEL)).otherwise(F.lit(S.TRANSCRIPT_BUSINESS_LABEL))
    body = F.concat(label, F.lit(": "), F.col("text"))
    if with_ts:
        body = F.concat(F.lit("["), X.iso_timestamp("sent_at"), F.lit("] "), body)
    return body


def transcripts(msgs: DataFrame, style: str = "orders") -> DataFrame:
    """Whole-session transcript text handed to an extractor.

    ``orders``: header CONVERSATION_ID / CLIENT_ID and ``[ts] Cliente: ...`` lines;
    ``faq``: header ``Cliente ID:`` and lines without timestamps.
    """
    with_ts = style == "orders"
    ex = exportable(msgs).withColumn("_line", _lines(msgs, with_ts))
    g = ex.groupBy("conversation_id", "session_id").agg(
        F.min_by("client_id", F.struct("sent_at", "message_index")).alias("client_id"),
        F.array_sort(F.collect_list(F.struct("sent_at", "message_index", "_line"))).alias("_l"),
    )
    body = F.array_join(F.transform("_l", lambda e: e["_line"]), "\n")
    cid = F.coalesce("client_id", F.lit(""))
    if with_ts:
        h1, h2 = S.TRANSCRIPT_ORDERS_HEADER
        header = F.concat(F.lit(h1), F.col("conversation_id"), F.lit("\n"), F.lit(h2), cid)
    else:
        header = F.concat(F.lit(S.TRANSCRIPT_FAQ_HEADER), cid)
    return g.select(
        "conversation_id",
        "session_id",
        cid.alias("client_id"),
        F.concat(header, F.lit("\n"), body).alias("transcript"),
    )


def first_n(records: DataFrame, n: int | None) -> DataFrame:
    """Records in file order; ``n`` falsy (None or 0) means all of them."""
    ordered = records.orderBy("conversation_id", "session_id")
    return ordered.limit(n) if n else ordered


def first_records(msgs: DataFrame, n: int | None) -> DataFrame:
    """``first_n`` of the session records of ``msgs``: the sessions are chosen by their scalar
    keys, and only the messages of those are nested."""
    if n:
        chosen = exportable(msgs).select("conversation_id", "session_id").distinct().orderBy("conversation_id", "session_id").limit(n)
        msgs = msgs.join(chosen, ["conversation_id", "session_id"], "left_semi")
    return first_n(session_records(msgs), n)
