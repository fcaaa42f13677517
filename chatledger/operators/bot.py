"""Sale dialogue of the messaging bot, as data.

Updates (messages and button callbacks) are keyed by chat.  One pure transition function
``step`` drives both the batch replay (``mapInArrow`` over sorted segments) and the streaming
job (``applyInPandasWithState`` in ``streaming/dialogue.py``), so a replay equals the
stream.  Replies and completed sales are emitted as rows; nothing calls out.

The dialogue is sequential per chat; chats are independent, so work spreads by chat key.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger import schemas as S
from chatledger.functions import text as X
from chatledger.session import ship_package

# ---------------------------------------------------------------------------
# Column helpers
# ---------------------------------------------------------------------------
bot_money = X.bot_money
bot_phone = X.bot_phone


def valid_name(text: Column) -> Column:
    return F.length(text) >= S.BOT_MIN_NAME_LENGTH


def button_ids(products: DataFrame, name: str = "name", variant: str = "variant") -> DataFrame:
    """Callback id and display name for each (name, variant)."""
    return products.select(
        F.col(name).alias("name"),
        F.col(variant).alias("variant"),
        X.product_display_name(name, variant).alias("display_name"),
        X.product_button_id(name, variant).alias("button_id"),
    )


def cart_text(lines: Column) -> Column:
    """Cart lines array<struct<name, variant, cantidad>> -> the cart block of a message."""
    body = F.transform(
        lines,
        lambda e: F.concat(F.lit("  • "), e["cantidad"].cast("string"), F.lit("x "), X.product_display_name(e["name"], e["variant"])),
    )
    return F.when(
        F.coalesce(F.size(lines), F.lit(0)) > 0,
        F.concat(F.lit("🛒 <b>Productos:</b>\n"), F.array_join(body, "\n")),
    ).otherwise(F.lit("🛒 <b>Carrito vacío</b>"))


def sale_summary(name: Column, is_new: Column, phone: Column, lines: Column, total: Column) -> Column:
    """Confirmation message: client (marked new), phone, cart and total with thousands."""
    client = F.concat(
        F.lit("👤 <b>Cliente:</b> "),
        F.coalesce(name.cast("string"), F.lit("None")),
        F.when(is_new, F.lit(" (nuevo)")).otherwise(F.lit("")),
        F.lit("\n📱 <b>Tel:</b> "),
        F.coalesce(phone, F.lit("None")),
    )
    money = F.concat(F.lit("💰 <b>Total:</b> $"), F.coalesce(X.thousands(total), F.lit("None")), F.lit(" COP"))
    return F.concat(F.lit("📦 <b>Confirmar venta:</b>\n\n"), client, F.lit("\n\n"), cart_text(lines), F.lit("\n\n"), money)


# ---------------------------------------------------------------------------
# transition function (pure Python, per update)
# ---------------------------------------------------------------------------
def _catalogue_by_button() -> dict[str, tuple[str, str | None]]:
    out = {}
    for name, variant in S.CATALOGUE:
        v = variant or ""
        out[f"{name.lower()}_{v.lower().replace(' ', '_')}"] = (name, variant)
    return out


CATALOGUE_BY_BUTTON = _catalogue_by_button()
QUANTITY_BUTTONS = {str(n) for n in S.BOT_QUANTITIES}


def initial_state() -> dict:
    return {
        "state": "idle",
        "telefono": None,
        "nombre": None,
        "client_id": None,
        "es_nuevo": False,
        "productos": [],
        "actual": None,
        "total": None,
        "last_update_id": -1,
    }


def _reset(st: dict, state: str = "idle") -> dict:
    fresh = initial_state()
    fresh["state"] = state
    fresh["last_update_id"] = st["last_update_id"]
    return fresh


def _int_total(text: str) -> int | None:
    t = text.replace("$", "").replace(".", "").replace(",", "").replace(" ", "")
    # The rule of text.bot_money: ASCII digits that a long holds.
    if not re.fullmatch(r"[+-]?[0-9]+", t) or not 0 < int(t) < 1 << 63:
        return None
    return int(t)


def step(st: dict, u: dict) -> tuple[dict, str, dict | None]:
    """Apply one update.  ``u`` has update_id, kind ('message' | 'callback' | other),
    text, data, allowed, found_client_id, found_name.  Returns (state, reply, sale)."""
    uid = int(u["update_id"])
    if uid <= st["last_update_id"]:
        return st, "duplicate", None
    st = dict(st)
    st["last_update_id"] = uid
    kind = u.get("kind")
    if kind == "callback":
        return _callback(st, u)
    if kind != "message":
        return st, "ignored", None
    text = (u.get("text") or "").strip()
    if not text:
        return st, "ignored", None
    if not u.get("allowed", True):
        return st, "unauthorised", None
    if text in ("/start", "/cancelar"):
        return _reset(st), "welcome" if text == "/start" else "cancelled", None
    if text == "/venta":
        return _reset(st, "esperando_telefono"), "ask_phone", None
    if text == "/id":
        return st, "your_id", None
    if text in ("/ayuda", "/help"):
        return st, "help", None
    state = st["state"]
    if state == "esperando_telefono":
        digits = "".join(ch for ch in text if ch.isdigit())
        if len(digits) < S.BOT_MIN_PHONE_DIGITS:
            return st, "bad_phone", None
        st["telefono"] = digits
        if u.get("found_client_id"):
            st.update(client_id=u["found_client_id"], nombre=u.get("found_name"), es_nuevo=False, state="seleccionando_productos")
            return st, "client_found", None
        st.update(es_nuevo=True, state="esperando_nombre")
        return st, "new_client", None
    if state == "esperando_nombre":
        if len(text) < S.BOT_MIN_NAME_LENGTH:
            return st, "short_name", None
        st.update(nombre=text, state="seleccionando_productos")
        return st, "ask_products", None
    if state == "esperando_total":
        total = _int_total(text)
        if total is None:
            return st, "bad_total", None
        st.update(total=total, state="confirmacion")
        return st, "summary", None
    return st, "hint", None


def _callback(st: dict, u: dict) -> tuple[dict, str, dict | None]:
    if not u.get("allowed", True):
        return st, "unauthorised", None
    data = u.get("data") or ""
    if data.startswith("prod_"):
        pid = data[5:]
        if pid == "finalizar":
            if not st["productos"]:
                return st, "cart_empty", None
            st["state"] = "esperando_total"
            return st, "ask_total", None
        prod = CATALOGUE_BY_BUTTON.get(pid)
        if prod is None:
            return st, "ignored", None
        st.update(actual=list(prod), state="seleccionando_cantidad")
        return st, "ask_quantity", None
    if data.startswith("cant_"):
        q = data[5:]
        if q == "cancelar":
            st.update(actual=None, state="seleccionando_productos")
            return st, "ask_products", None
        if q not in QUANTITY_BUTTONS:
            return st, "error", None
        n = int(q)
        if st["actual"] is None:
            st["state"] = "seleccionando_productos"
            return st, "error", None
        name, variant = st["actual"]
        st["productos"] = st["productos"] + [[name, variant, n]]
        st.update(actual=None, state="seleccionando_productos")
        return st, "added", None
    if data.startswith("confirm_"):
        if data == "confirm_si":
            if st["state"] != "confirmacion":
                return _reset(st), "sale_rejected", None
            sale = {
                "telefono": st["telefono"],
                "nombre": st["nombre"],
                "client_id": st["client_id"],
                "es_nuevo": bool(st["es_nuevo"]),
                "productos": st["productos"],
                "total": st["total"],
            }
            return _reset(st), "sale_saved", sale
        return _reset(st), "sale_cancelled", None
    return st, "ack", None


# ---------------------------------------------------------------------------
# drivers
# ---------------------------------------------------------------------------
LINE_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("variant", T.StringType()), T.StructField("cantidad", T.LongType())]
    )
)
OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("chat_id", T.LongType()),
        T.StructField("update_id", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("reply", T.StringType()),
        T.StructField("sale_json", T.StringType()),
    ]
)
STATE_SCHEMA = T.StructType([T.StructField("state_json", T.StringType())])
UPDATE_COLUMNS = ["chat_id", "update_id", "kind", "text", "data", "allowed", "found_client_id", "found_name"]


def run_chat(chat_id: int, rows: pd.DataFrame, st: dict) -> tuple[dict, list[dict]]:
    out = []
    for u in rows.sort_values("update_id", kind="stable").to_dict("records"):
        st, reply, sale = step(st, u)
        out.append(
            {
                "chat_id": int(chat_id),
                "update_id": int(u["update_id"]),
                "state": st["state"],
                "reply": reply,
                "sale_json": json.dumps(sale, ensure_ascii=False) if sale else None,
            }
        )
    return st, out


def _replay(pdf: pd.DataFrame) -> pd.DataFrame:
    if pdf.empty:
        return pd.DataFrame(columns=OUTPUT_SCHEMA.names)
    _, out = run_chat(int(pdf["chat_id"].iloc[0]), pdf, initial_state())
    return pd.DataFrame(out, columns=OUTPUT_SCHEMA.names)


def prepare_updates(updates: DataFrame, clients: DataFrame | None, allowed_chats: DataFrame | None) -> DataFrame:
    """Flatten raw updates, mark authorised chats, and attach the client found for the
    digits of a message (stream-static left join; digits-only match)."""
    msg, cb = F.col("message"), F.col("callback_query")
    flat = updates.select(
        F.coalesce(msg["chat"]["id"], cb["message"]["chat"]["id"]).alias("chat_id"),
        F.col("update_id"),
        F.when(cb.isNotNull(), F.lit("callback")).when(msg.isNotNull(), F.lit("message")).alias("kind"),
        X.strip(F.coalesce(msg["text"], F.lit(""))).alias("text"),
        cb["data"].alias("data"),
        *[c for c in ["ts"] if c in updates.columns],
    )
    if allowed_chats is None:
        flat = flat.withColumn("allowed", F.lit(True))
    else:
        allow = allowed_chats.select(F.col("chat_id").alias("_a")).distinct()
        flat = flat.join(allow, flat["chat_id"] == allow["_a"], "left")
        # An empty allow-list admits everybody; a stream has its list tested when it starts.
        everybody = F.lit(False) if updates.isStreaming else allowed_chats.select(F.count(F.lit(1)) == 0).scalar()
        flat = flat.withColumn("allowed", F.col("_a").isNotNull() | everybody).drop("_a")
    if clients is None:
        return flat.withColumn("found_client_id", F.lit(None).cast("string")).withColumn("found_name", F.lit(None).cast("string"))
    from chatledger.operators.mart import clients_by_phone

    # Only a message with the digits of a phone (as ``step`` counts them, or more) is looked up; the others are most updates.
    phone_like = (F.col("kind") == "message") & (F.length(F.regexp_replace("text", r"[^\p{Nd}\p{No}]", "")) >= S.BOT_MIN_PHONE_DIGITS)
    looked = clients_by_phone(clients, flat.withColumn("_digits", F.when(phone_like, X.digits_only("text"))), "_digits")
    return looked.withColumnRenamed("client_id", "found_client_id").withColumnRenamed("client_name", "found_name").drop("_digits", "found")


def replay_whole(prepared: DataFrame) -> DataFrame:
    """Reference replay: each chat's whole update history as one group (small inputs/tests)."""
    ship_package(prepared.sparkSession)
    return prepared.select(*UPDATE_COLUMNS).groupBy("chat_id").applyInPandas(_replay, OUTPUT_SCHEMA)


# Updates after which the dialogue state is known whatever came before (the update itself
# is still applied to the prior state; the next one starts a new segment).
RESET_MESSAGES = {"/start": "idle", "/cancelar": "idle", "/venta": "esperando_telefono"}
RESET_STATES = {"_idle": "idle", "_phone": "esperando_telefono"}  # the states that a reset leaves
SEGMENT_BUCKET = 1 << 20  # update-id range per bucket when locating the previous reset


def _state_after_reset() -> Column:
    text, data = F.col("text"), F.coalesce(F.col("data"), F.lit(""))
    out = F.when((F.col("kind") == "callback") & F.col("allowed") & data.startswith("confirm_"), F.lit("idle"))
    for cmd, state in RESET_MESSAGES.items():
        out = out.when((F.col("kind") == "message") & F.col("allowed") & (text == cmd), F.lit(state))
    return out


def segments(prepared: DataFrame) -> DataFrame:
    """Tag every update with the last reset strictly before it in its chat
    (``_seg_id`` = its update id, -1 if none; ``_seg_state`` = state after it).

    Located without a window over a whole chat: a window per (chat, update-id bucket) finds
    resets earlier in the same bucket; a per-bucket summary with a running max over buckets
    supplies the latest reset of earlier buckets.
    """
    d = prepared.select(*UPDATE_COLUMNS).withColumn("_b", F.floor(F.col("update_id") / F.lit(SEGMENT_BUCKET)))
    # The last reset to either state, as two numbers: a maximum of structs would sort all updates once more.
    d = d.withColumn("_rs", _state_after_reset())
    last = {c: F.max(F.when(F.col("_rs") == state, F.col("update_id"))) for c, state in RESET_STATES.items()}
    before = Window.partitionBy("chat_id", "_b").orderBy("update_id").rowsBetween(Window.unboundedPreceding, -1)
    per_b = d.groupBy("chat_id", "_b").agg(*[m.alias(f"_max{c}") for c, m in last.items()])
    d = d.select("*", *[m.over(before).alias(f"_in{c}") for c, m in last.items()])
    earlier = Window.partitionBy("chat_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.select("chat_id", "_b", *[F.max(f"_max{c}").over(earlier).alias(f"_prev{c}") for c in last])
    j = d.join(per_b, ["chat_id", "_b"], "left")
    idle, phone = (F.greatest(f"_in{c}", f"_prev{c}") for c in ("_idle", "_phone"))
    return j.select(
        *UPDATE_COLUMNS,
        F.coalesce(F.greatest(idle, phone), F.lit(-1).cast("bigint")).alias("_seg_id"),
        F.when(phone.isNotNull() & (idle.isNull() | (phone > idle)), F.lit(RESET_STATES["_phone"])).otherwise(F.lit(RESET_STATES["_idle"])).alias("_seg_state"),
    )


def _values(column: pa.Array) -> list:
    """``to_pylist`` by way of numpy, many times faster; a column of integers with nulls has no such form."""
    if pa.types.is_integer(column.type) and column.null_count:
        return column.to_pylist()
    return column.to_numpy(zero_copy_only=False).tolist()


def _replay_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replay a partition sorted by chat, segment and update; only the current dialogue's state is held."""
    chat, seg, st = None, None, None
    read = ("chat_id", "_seg_id", "_seg_state", "update_id", "kind", "text", "data", "allowed", "found_client_id", "found_name")
    for batch in batches:
        columns = [_values(batch.column(c)) for c in read]
        states, replies, sales = [], [], []
        for c, s, start, uid, kind, text, data, allowed, client_id, name in zip(*columns, strict=True):
            if st is None or s != seg or c != chat:
                chat, seg, st = c, s, initial_state()
                st.update(state=start, last_update_id=s)
            update = {"update_id": uid, "kind": kind, "text": text, "data": data, "allowed": allowed, "found_client_id": client_id, "found_name": name}
            st, reply, sale = step(st, update)
            states.append(st["state"])
            replies.append(reply)
            sales.append(json.dumps(sale, ensure_ascii=False) if sale else None)
        out = [pa.array(x, pa.string()) for x in (states, replies, sales)]
        yield pa.RecordBatch.from_arrays([batch.column("chat_id"), batch.column("update_id"), *out], names=OUTPUT_SCHEMA.names)


def replay(prepared: DataFrame) -> DataFrame:
    """Batch twin of the streaming dialogue.  A chat's history is cut at reset updates and
    each segment replays independently from the known state, so one busy chat spreads over
    many segments; the output equals ``replay_whole``.  Segments are a few updates long, so a
    task replays all of its partition in one pass instead of one pandas group at a time."""
    ship_package(prepared.sparkSession)
    rows = segments(prepared).repartition("chat_id", "_seg_id").sortWithinPartitions("chat_id", "_seg_id", "update_id")
    return rows.mapInArrow(_replay_segments, OUTPUT_SCHEMA)


def completed_sales(outputs: DataFrame) -> DataFrame:
    sale_t = T.StructType(
        [
            T.StructField("telefono", T.StringType()),
            T.StructField("nombre", T.StringType()),
            T.StructField("client_id", T.StringType()),
            T.StructField("es_nuevo", T.BooleanType()),
            T.StructField("productos", T.ArrayType(T.ArrayType(T.StringType()))),
            T.StructField("total", T.LongType()),
        ]
    )
    s = outputs.filter(F.col("sale_json").isNotNull()).withColumn("_s", F.from_json("sale_json", sale_t))
    lines = F.transform(
        "_s.productos",
        lambda a: F.struct(a[0].alias("name"), a[1].alias("variant"), a[2].try_cast("bigint").alias("cantidad")),
    )
    return s.select("chat_id", "update_id", "_s.telefono", "_s.nombre", "_s.client_id", "_s.es_nuevo", lines.alias("productos"), "_s.total")


def sale_rows(sales: DataFrame, products: DataFrame | None, order_date: Column | None = None) -> dict[str, DataFrame]:
    """New clients, orders and items of completed sales, with ids derived from
    (chat, update) so a replayed batch rewrites the same rows."""
    # a total the order table cannot hold fails the whole sale (all-or-nothing): rejects
    fits = F.col("total").try_cast("decimal(12,2)").isNotNull()
    rejects = sales.filter(~fits)
    sales = sales.filter(fits)
    key = F.concat_ws(":", F.col("chat_id").cast("string"), F.col("update_id").cast("string"))
    new_src = F.concat(F.lit(S.BOT_SOURCE_PREFIX), F.col("telefono"))
    client_id = F.when(F.col("es_nuevo"), X.uuid_from(F.concat(F.lit("client:"), new_src))).otherwise(F.col("client_id"))
    base = sales.withColumn("_order_id", X.uuid_from(F.concat(F.lit("bot-order:"), key))).withColumn("_client", client_id)
    # One row per client: of several sales to one new phone the last names it.
    new = base.filter(F.col("es_nuevo")).groupBy(F.col("_client").alias("id")).agg(
        F.max_by(F.struct(F.col("telefono").alias("phone"), F.col("nombre").alias("name"), new_src.alias("source_client_id")), F.struct("update_id", "chat_id")).alias("_r")
    )
    clients = new.select("id", "_r.*")
    orders = base.select(
        F.col("_order_id").alias("id"),
        F.col("_client").alias("client_id"),
        (order_date if order_date is not None else F.current_date()).alias("order_date"),
        F.col("total").cast("decimal(12,2)").alias("total"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("string").alias("source_session_id"),
    )
    items = base.select("_order_id", "chat_id", "update_id", F.posexplode("productos").alias("pos", "l")).select(
        X.uuid_from(F.concat(F.lit("bot-item:"), F.col("chat_id").cast("string"), F.lit(":"), F.col("update_id").cast("string"), F.lit(":"), F.col("pos").cast("string"))).alias("id"),
        F.col("_order_id").alias("order_id"),
        F.lit(None).cast("string").alias("product_id"),
        F.col("l.name").alias("product_name"),
        F.col("l.variant").alias("variant"),
        F.col("l.cantidad").try_cast("int").alias("quantity"),
        F.lit(S.BOT_ITEM_UNIT).alias("unit"),
    )
    if products is not None:
        from chatledger.operators.mart import resolve_product_ids

        items = resolve_product_ids(items, products)
    return {"clients": clients, "orders": orders, "order_items": items, "rejects": rejects}


def iter_state_rows(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """applyInPandasWithState body: continue from the stored state, emit outputs."""
    chat_id = int(key[0])
    st = json.loads(state.get[0]) if state.exists else initial_state()
    frames = [p for p in pdfs if not p.empty]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    st, out = run_chat(chat_id, rows, st)
    state.update((json.dumps(st, ensure_ascii=False),))
    yield pd.DataFrame(out, columns=OUTPUT_SCHEMA.names)
