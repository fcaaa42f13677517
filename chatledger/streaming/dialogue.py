"""Streaming sale dialogue (T2) and sale registration.

updates (JSON files) -> authorised / client lookup (stream-static joins) ->
groupBy(chat).applyInPandasWithState(step) -> foreachBatch: replies and completed sales.
Each micro-batch is one version of the tables under ``out_dir`` (``sources/versioned.py``): its replies, new
clients, orders, items and rejected sales become visible together or not at all, and a batch replayed after a
failure changes nothing that is committed.  The lookup by phone reads the clients that earlier batches
registered anew in each batch, beside the given ones.  Ids of orders and items derive from (chat, update).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from chatledger import schemas as S
from chatledger.operators import bot as B
from chatledger.session import ship_package
from chatledger.sources import versioned as V
from chatledger.streaming import dialogue_state as DS
from chatledger.streaming.ingest import FOREVER

UPDATE_FILE_SCHEMA = T.StructType(list(S.UPDATE_SCHEMA.fields) + [T.StructField("ts", T.TimestampNTZType())])


def dialogue_outputs(prepared_stream: DataFrame) -> DataFrame:
    return (
        prepared_stream.select(*B.UPDATE_COLUMNS)
        .groupBy("chat_id")
        .applyInPandasWithState(B.iter_state_rows, B.OUTPUT_SCHEMA, B.STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    )


REGISTERED = "id string, phone string, name string, source_client_id string"


def known_clients(spark: SparkSession, out_dir: str, clients: DataFrame | None) -> DataFrame:
    """The given clients and those registered so far, which come after any given one of the same phone."""
    new = V.read_anew(spark, out_dir, "clients", REGISTERED).select("id", "phone", "name", F.lit("9999-12-31").cast("timestamp_ntz").alias("created_at"))
    return new if clients is None else clients.select("id", "phone", "name", F.col("created_at").cast("timestamp_ntz").alias("created_at")).unionByName(new)


def registered_clients(spark: SparkSession, out_dir: str) -> DataFrame:
    """A row for each client that the stream registered: as its last sale as a new one has it."""
    rows = V.read_table(spark, out_dir, "clients", REGISTERED)
    last = F.max_by(F.struct("phone", "name", "source_client_id"), "version").alias("r")
    return rows.groupBy("id").agg(last).select("id", "r.*")


def start(
    spark: SparkSession,
    updates_dir: str,
    out_dir: str,
    checkpoint: str,
    clients: DataFrame | None = None,
    products: DataFrame | None = None,
    allowed_chats: DataFrame | None = None,
    available_now: bool = True,
    typed_state: bool = False,
    idle_seconds: float | None = None,
) -> StreamingQuery:
    """Start the stream.  With ``typed_state`` the dialogue is kept in typed variables (``dialogue_state``), where it can be
    queried and, with ``idle_seconds``, ends by a timer (not with ``available_now``: a batch follows as long as
    timers may run out); a checkpoint of one kind is not one of the other."""
    ship_package(spark)
    if allowed_chats is not None and allowed_chats.isEmpty():
        allowed_chats = None  # an empty list admits everybody
    stream = spark.readStream.schema(UPDATE_FILE_SCHEMA).option("maxFileAge", FOREVER).json(updates_dir)
    prepared = B.prepare_updates(stream, known_clients(spark, out_dir, clients), allowed_chats)
    if idle_seconds is not None and (available_now or not typed_state):
        raise ValueError("idle_seconds needs typed_state and a stream that goes on (available_now=False)")
    idle_ms = None if idle_seconds is None else int(idle_seconds * 1000)
    outputs = DS.typed_outputs(prepared, idle_ms) if typed_state else dialogue_outputs(prepared)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            V.write_version(out_dir, batch_id, {"replies": batch} | B.sale_rows(B.completed_sales(batch), products))
        finally:
            batch.unpersist()

    w = outputs.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    if not typed_state:
        return w.start()
    provider = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(provider)
    spark.conf.set(provider, DS.ROCKSDB)  # the query keeps the setting it is started with
    try:
        return w.start()
    finally:
        spark.conf.set(provider, was)
