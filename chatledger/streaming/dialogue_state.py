"""The sale dialogue (T2) with typed state variables and timers, in place of one JSON text a chat.

``dialogue``: a value (state, phone, client, total, product being chosen, last update seen).  ``cart``: a map by line number,
so a batch writes the lines it adds and no others.  A timer a chat ends a dialogue that is left open for
``idle_ms`` milliseconds: it becomes idle, its cart goes, and a row with reply ``expired`` says so.  Both variables
can be read as tables from the checkpoint (``open_dialogues``, ``open_carts``).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatledger.operators import bot as B

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DIALOGUE = (
    T.StructType()
    .add("state", "string")
    .add("telefono", "string")
    .add("client_id", "string")
    .add("nombre", "string")
    .add("es_nuevo", "boolean")
    .add("total", "long")
    .add("name", "string")  # of the product being chosen
    .add("variant", "string")
    .add("last_update_id", "long")
)
LINE_NO = T.StructType().add("line", "integer")
LINE = T.StructType().add("name", "string").add("variant", "string").add("cantidad", "long")
PLAIN = ("state", "telefono", "client_id", "nombre", "es_nuevo", "total")


class SaleDialogue(StatefulProcessor):
    """``bot.step`` for each update of a chat, in order of update id within a batch."""

    def __init__(self, idle_ms: int | None = None) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.dialogue = handle.getValueState("dialogue", DIALOGUE)
        self.cart = handle.getMapState("cart", LINE_NO, LINE)

    def _load(self) -> dict:
        st = B.initial_state()
        kept = self.dialogue.get()
        if kept is None:
            return st
        kept = dict(zip(DIALOGUE.names, kept, strict=True))
        st.update({n: kept[n] for n in PLAIN}, last_update_id=kept["last_update_id"])
        st["actual"] = None if kept["name"] is None else [kept["name"], kept["variant"]]
        lines = sorted((k[0], list(v)) for k, v in self.cart.iterator())
        st["productos"] = [line for _, line in lines]
        return st

    def _save(self, before: dict, st: dict) -> None:
        name, variant = st["actual"] or (None, None)
        self.dialogue.update((*(st[n] for n in PLAIN), name, variant, st["last_update_id"]))
        had, has = before["productos"], st["productos"]
        if has[: len(had)] != had:  # another sale's cart
            self.cart.clear()
            had = []
        for i in range(len(had), len(has)):
            self.cart.updateValue((i,), tuple(has[i]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before = self._load()
        st, out = B.run_chat(int(key[0]), pd.concat(list(rows)), before)
        self._save(before, st)
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if st["state"] != "idle":
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield pd.DataFrame(out, columns=B.OUTPUT_SCHEMA.names)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        before = self._load()
        if before["state"] == "idle":
            return
        st = B.initial_state() | {"last_update_id": before["last_update_id"]}
        self._save(before, st)
        row = {"chat_id": int(key[0]), "update_id": st["last_update_id"], "state": st["state"], "reply": "expired", "sale_json": None}
        yield pd.DataFrame([row], columns=B.OUTPUT_SCHEMA.names)


def typed_outputs(prepared_stream: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """Replies and sales of a stream of prepared updates; the query needs the RocksDB state store."""
    mode = "None" if idle_ms is None else "ProcessingTime"
    rows = prepared_stream.select(*B.UPDATE_COLUMNS)
    return rows.groupBy("chat_id").transformWithStateInPandas(SaleDialogue(idle_ms), B.OUTPUT_SCHEMA, "Append", mode)


def _variable(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def open_dialogues(spark: SparkSession, checkpoint: str) -> DataFrame:
    """chat_id and the dialogue's value of every chat that is not idle, as of the last committed batch."""
    rows = _variable(spark, checkpoint, "dialogue").select(F.col("key.chat_id").alias("chat_id"), "value.*")
    return rows.filter(F.col("state") != "idle")


def open_carts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """chat_id, line, name, variant, cantidad of every cart line held, as of the last committed batch."""
    rows = _variable(spark, checkpoint, "cart")
    return rows.select(F.col("key.chat_id").alias("chat_id"), F.col("user_map_key.line").alias("line"), "user_map_value.*")
