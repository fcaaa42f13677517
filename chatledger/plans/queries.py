"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Outputs render dates and timestamps as ISO text and money as DOUBLE (summed exactly as
DECIMAL first) so results compare value-for-value with the SQL oracle on another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from chatledger.functions import text as X
from chatledger.llm.common import materialize
from chatledger.operators import access as AC
from chatledger.operators import bot as B
from chatledger.operators import catalogue as CT
from chatledger.operators import extract as EX
from chatledger.operators import maintained as MV
from chatledger.operators import manifest as MF
from chatledger.operators import mart as MT
from chatledger.operators import messages as M
from chatledger.operators import orders as O
from chatledger.operators import reports as R
from chatledger.operators import sessions as SS
from chatledger.plans import adapters as A
from chatledger.sources.chat_csv import is_chat_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def render(df: DataFrame) -> DataFrame:
    """Dates -> 'YYYY-MM-DD', timestamps -> ISO text, decimals -> DOUBLE, ints -> BIGINT."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = X.iso_timestamp(f.name)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str):
    def deco(fn):
        def run(spark, sf):
            return render(fn(spark, sf))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


# ---------------------------------------------------------------------------
# stage 1: messages and sessions
# ---------------------------------------------------------------------------
def _clean(spark, sf):
    return M.clean_messages(A.raw_messages(spark, sf), A.RAW_TS_FORMAT)


def _msgs(spark, sf):
    return M.sessionize(M.assign_ids_and_roles(_clean(spark, sf)))


@query("messages_clean")
def q_messages_clean(spark, sf):
    return _clean(spark, sf).select(
        "file_row", "chat_id", X.iso_timestamp("sent_at").alias("sent_at"), "direction", "text", "is_media"
    )


@query("message_ids_roles")
def q_message_ids_roles(spark, sf):
    return M.assign_ids_and_roles(_clean(spark, sf)).select("file_row", "conversation_id", "client_id", "role")


@query("client_id_normalise")
def q_client_id_normalise(spark, sf):
    raw = A.raw_messages(spark, sf)
    return raw.select("chat_id", "contact", X.client_id("contact", "chat_id").alias("client_id")).distinct()


@query("message_index")
def q_message_index(spark, sf):
    return _msgs(spark, sf).select("file_row", "conversation_id", "message_index")


@query("message_gaps")
def q_message_gaps(spark, sf):
    return _msgs(spark, sf).select("file_row", "gap_hours")


@query("message_sessions")
def q_message_sessions(spark, sf):
    return _msgs(spark, sf).select("file_row", "conversation_id", "message_index", "session_id")


@query("normalise_summary")
def q_normalise_summary(spark, sf):
    return M.normalise_summary(_msgs(spark, sf))


@query("session_records")
def q_session_records(spark, sf):
    rec = SS.session_records(_msgs(spark, sf))
    return rec.select(
        "conversation_id",
        "session_id",
        "client_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.element_at("messages", 1)["timestamp"].alias("first_timestamp"),
        F.element_at("messages", -1)["timestamp"].alias("last_timestamp"),
        F.element_at("messages", -1)["role"].alias("last_role"),
    )


@query("session_last_date")
def q_session_last_date(spark, sf):
    return SS.session_last_date(_msgs(spark, sf))


@query("client_first_contact")
def q_client_first_contact(spark, sf):
    return SS.client_first_contact(SS.session_summary(_msgs(spark, sf)))


@query("transcript_orders")
def q_transcript_orders(spark, sf):
    return SS.transcripts(_msgs(spark, sf), "orders").select("session_id", "transcript")


@query("transcript_faq")
def q_transcript_faq(spark, sf):
    return SS.transcripts(_msgs(spark, sf), "faq").select("session_id", "transcript")


SESSIONS_FIRST_N = 5


@query("sessions_first_n")
def q_sessions_first_n(spark, sf):
    rec = SS.first_records(_msgs(spark, sf), SESSIONS_FIRST_N)
    return rec.select("conversation_id", "session_id", "client_id", F.size("messages").cast("bigint").alias("n_messages"))


# ---------------------------------------------------------------------------
# mart views, statistics and maintenance
# ---------------------------------------------------------------------------
def _mart(spark, sf):
    return A.mart_clients(spark, sf), A.mart_orders(spark, sf), A.mart_products(spark, sf), A.mart_items(spark, sf)


@query("client_summary")
def q_client_summary(spark, sf):
    return R.client_summary(A.mart_clients(spark, sf), A.mart_orders(spark, sf))


@query("orders_with_client")
def q_orders_with_client(spark, sf):
    return R.orders_with_client(A.mart_orders(spark, sf), A.mart_clients(spark, sf))


@query("sales_by_month")
def q_sales_by_month(spark, sf):
    return R.sales_by_month(A.mart_orders(spark, sf))


@query("top_products")
def q_top_products(spark, sf):
    return R.top_products(A.mart_items(spark, sf))


@query("mart_counts")
def q_mart_counts(spark, sf):
    c, o, p, i = _mart(spark, sf)
    return R.table_counts({"clients": c, "orders": o, "products": p, "order_items": MT.valid_items(i)})


@query("total_sales")
def q_total_sales(spark, sf):
    return R.total_sales(A.mart_orders(spark, sf))


@query("best_product")
def q_best_product(spark, sf):
    return R.best_product(A.mart_items(spark, sf))


@query("daily_summary")
def q_daily_summary(spark, sf):
    return R.daily_summary(A.mart_orders(spark, sf))


@query("recent_clients")
def q_recent_clients(spark, sf):
    return R.recent_clients(A.mart_clients(spark, sf), 10).select("id", "name", "phone", "created_at")


@query("client_month")
def q_client_month(spark, sf):
    return R.client_month(A.mart_orders(spark, sf))


@query("mark_delivered")
def q_mark_delivered(spark, sf):
    return MT.mark_delivered(A.mart_orders(spark, sf), None, A.run_ts()).select("id", "client_id", "status", "updated_at")


@query("items_valid")
def q_items_valid(spark, sf):
    return MT.valid_items(A.mart_items(spark, sf)).select("id", "order_id", "product_name", "variant", "quantity")


@query("item_product_id")
def q_item_product_id(spark, sf):
    items = MT.valid_items(A.mart_items(spark, sf))
    return MT.resolve_product_ids(items, A.mart_products(spark, sf)).select("id", "product_name", "variant", "product_id")


@query("client_by_phone")
def q_client_by_phone(spark, sf):
    return MT.clients_by_phone(A.mart_clients(spark, sf), A.phone_lookups(spark, sf), "phone_input")


def _last(batch):
    """One row per id; the highest values in all columns decide."""
    return MT.dedupe_last(batch, "id", [c for c in batch.columns if c != "id"])


@query("upsert_clients")
def q_upsert_clients(spark, sf):
    return MT.upsert_clients(A.mart_clients(spark, sf), _last(A.batch_clients(spark, sf)), A.run_ts())


@query("upsert_orders")
def q_upsert_orders(spark, sf):
    return MT.upsert_orders(A.mart_orders(spark, sf), _last(A.batch_orders(spark, sf)), A.run_ts())


@query("upsert_products")
def q_upsert_products(spark, sf):
    return MT.upsert_products(A.mart_products(spark, sf), _last(A.batch_products(spark, sf)), A.run_ts())


@query("upsert_items")
def q_upsert_items(spark, sf):
    target = MT.resolve_product_ids(MT.valid_items(A.mart_items(spark, sf)), A.mart_products(spark, sf))
    return MT.upsert_items(target, _last(A.batch_items(spark, sf)), A.run_ts())


def _maintained_orders(spark, sf):
    """What the orders before a load and the changes of the load add up to.  The batch and the changes are written:
    each stored table reads them, and would join anew."""
    before, batch = A.mart_orders(spark, sf), materialize(_last(A.batch_orders(spark, sf)))
    old = MV.touched(before, batch)
    changed = MV.changes(old, MT.upsert_orders(old, batch, A.run_ts()), batch)
    changed = materialize(changed.select("client_id", "order_date", "total", "sign"))
    return MV.merged(MV.contributions(orders=MV.whole(before)), MV.contributions(orders=changed))


@query("maintained_client_summary")
def q_maintained_client_summary(spark, sf):
    return MV.client_summary(A.mart_clients(spark, sf), _maintained_orders(spark, sf))


@query("maintained_sales_by_month")
def q_maintained_sales_by_month(spark, sf):
    return MV.sales_by_month(_maintained_orders(spark, sf))


@query("maintained_top_products")
def q_maintained_top_products(spark, sf):
    before, batch = MT.valid_items(A.mart_items(spark, sf)), materialize(_last(A.batch_items(spark, sf)))
    old = MV.touched(before, batch)
    changed = MV.changes(old, MT.upsert_items(old, batch, A.run_ts()), batch)
    changed = materialize(changed.select("product_name", "variant", "order_id", "quantity", "sign"))
    return MV.top_products(MV.merged(MV.contributions(order_items=MV.whole(before)), MV.contributions(order_items=changed)))


@query("catalog_match")
def q_catalog_match(spark, sf):
    """Every part's name as written with typing errors, and the part name it is nearest to."""
    return CT.match_names(A.typed_names(spark, sf), A.part_names(spark, sf))


@query("delete_propagation")
def q_delete_propagation(spark, sf):
    c, o, p, i = _mart(spark, sf)
    i = MT.resolve_product_ids(MT.valid_items(i), p)
    dc, do, dp = A.deletions(spark, sf)
    out = MT.propagate_deletes(c, o, p, i, dc, do, dp)
    parts = [
        out["clients"].agg(F.count(F.lit(1)).alias("remaining"), F.lit(0).cast("bigint").alias("nulled")).withColumn("table_name", F.lit("clients")),
        out["orders"].agg(F.count(F.lit(1)).alias("remaining"), F.count_if(F.col("client_id").isNull()).alias("nulled")).withColumn("table_name", F.lit("orders")),
        out["products"].agg(F.count(F.lit(1)).alias("remaining"), F.lit(0).cast("bigint").alias("nulled")).withColumn("table_name", F.lit("products")),
        out["order_items"].agg(F.count(F.lit(1)).alias("remaining"), F.count_if(F.col("product_id").isNull()).alias("nulled")).withColumn("table_name", F.lit("order_items")),
    ]
    res = parts[0]
    for x in parts[1:]:
        res = res.unionByName(x)
    return res.select("table_name", "remaining", F.col("nulled").cast("bigint").alias("nulled"))


@query("quality_report")
def q_quality_report(spark, sf):
    c, o, p, i = _mart(spark, sf)
    return MT.quality_report(c, o, p, MT.resolve_product_ids(i, p))


# ---------------------------------------------------------------------------
# extractor results -> orders, items, clients, flat sales
# ---------------------------------------------------------------------------
def _results(spark, sf):
    return O.parse_results(A.extraction_results(spark, sf))


def _dated(spark, sf):
    return O.with_order_date(O.exported_orders(_results(spark, sf)), SS.session_last_date(_msgs(spark, sf)))


@query("extract_parse")
def q_extract_parse(spark, sf):
    r = _results(spark, sf)
    return r.select(
        "session_id", "error", F.col("result").isNotNull().alias("parsed"),
        O.vget(F.col("result"), "$.order.order_type").alias("order_type"),
    )


@query("extract_status")
def q_extract_status(spark, sf):
    return O.extract_status(_results(spark, sf))


@query("orders_confirmed")
def q_orders_confirmed(spark, sf):
    return O.exported_orders(_results(spark, sf)).select("session_id", "order_type")


@query("order_date_fallback")
def q_order_date_fallback(spark, sf):
    return _dated(spark, sf).select("session_id", "order_date", "order_date_source")


@query("date_source_counts")
def q_date_source_counts(spark, sf):
    return O.date_source_counts(_dated(spark, sf))


@query("money_parse_export")
def q_money_parse_export(spark, sf):
    t = O.typed_orders(_results(spark, sf))
    return t.select("session_id", O.vget(F.col("approx_total"), "$").alias("approx_total_text"), O.money(F.col("approx_total")).alias("total"))


@query("product_label")
def q_product_label(spark, sf):
    return O.exported_orders(_results(spark, sf)).select("session_id", O.product_label(F.col("products")).alias("products"))


@query("sales_flat")
def q_sales_flat(spark, sf):
    return O.sales_flat(_dated(spark, sf))


@query("orders_table")
def q_orders_table(spark, sf):
    return O.orders_table(_dated(spark, sf), A.run_ts())


@query("items_table")
def q_items_table(spark, sf):
    return O.items_table(O.exported_orders(_results(spark, sf)))


@query("clients_table")
def q_clients_table(spark, sf):
    first = SS.client_first_contact(SS.session_summary(_msgs(spark, sf)))
    return O.clients_table(O.exported_orders(_results(spark, sf)), first, A.run_ts())


@query("order_date_parse")
def q_order_date_parse(spark, sf):
    o = O.orders_table(_dated(spark, sf), A.run_ts())
    return o.select("id", F.col("order_date").alias("order_date_text"), X.parse_date_lenient("order_date").alias("order_date"))


@query("created_at_parse")
def q_created_at_parse(spark, sf):
    first = SS.client_first_contact(SS.session_summary(_msgs(spark, sf)))
    c = O.clients_table(O.exported_orders(_results(spark, sf)), first, A.run_ts())
    return c.select("source_client_id", X.parse_iso_timestamp("created_at").alias("created_at"))


# ---------------------------------------------------------------------------
# native rule extractor (orders; FAQ / sale / client) and FAQ reports
# ---------------------------------------------------------------------------
def _feats(spark, sf):
    return EX.message_features(_msgs(spark, sf))


@query("order_signals")
def q_order_signals(spark, sf):
    f = EX.session_facts(_feats(spark, sf))
    return f.select("session_id", *EX.SIGNAL_NAMES, "has_order", "order_type")


@query("mention_extract")
def q_mention_extract(spark, sf):
    return EX.session_facts(_feats(spark, sf)).select("session_id", "payment_method", "city", "address", "approx_total", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"))


@query("customer_mention")
def q_customer_mention(spark, sf):
    return EX.session_facts(_feats(spark, sf)).select("session_id", "customer_phone", "customer_name")


@query("sale_state")
def q_sale_state(spark, sf):
    return EX.session_facts(_feats(spark, sf)).select("session_id", F.col("sale_state").alias("estado"))


@query("catalog_canonical")
def q_catalog_canonical(spark, sf):
    return EX.product_mentions(_feats(spark, sf)).select("session_id", "message_index", "pos", "mention", "name", "variant", "quantity", "unit")


@query("faq_pairs")
def q_faq_pairs(spark, sf):
    return EX.faq_pairs(_feats(spark, sf))


@query("extract_orders_rules")
def q_extract_orders_rules(spark, sf):
    return EX.extract_orders(_msgs(spark, sf)).drop("response", "conversation_id", "client_id")


@query("extract_faq_rules")
def q_extract_faq_rules(spark, sf):
    r = EX.extract_faq(_msgs(spark, sf))
    return r.select(
        "session_id",
        F.size("faqs").cast("bigint").alias("n_faqs"),
        F.col("venta.estado").alias("venta_estado"),
        F.col("venta.total").alias("venta_total"),
        F.size("venta.productos").cast("bigint").alias("venta_n_productos"),
        F.col("cliente.nombre").alias("cliente_nombre"),
        F.col("cliente.ciudad").alias("cliente_ciudad"),
    )


@query("faq_frequency")
def q_faq_frequency(spark, sf):
    return EX.pair_frequency(EX.faq_pairs(_feats(spark, sf)))


@query("sales_detected")
def q_sales_detected(spark, sf):
    s = EX.sales_detected(EX.extract_faq(_msgs(spark, sf)))
    return s.select(
        "session_id", "client_id", "direccion", "total", "metodo_pago", "estado",
        F.array_join("productos", "; ").alias("productos"),
    )


@query("client_notes")
def q_client_notes(spark, sf):
    return EX.client_notes(EX.extract_faq(_msgs(spark, sf)))


# ---------------------------------------------------------------------------
# file selection, manifests, request gating
# ---------------------------------------------------------------------------
@query("chat_file_filter")
def q_chat_file_filter(spark, sf):
    ls = A.file_listing(spark, sf)
    return ls.select("file_name", "file_size", is_chat_file(F.col("file_name"), F.col("file_size")).alias("selected"))


@query("manifest_diff")
def q_manifest_diff(spark, sf):
    remote, local = A.manifests(spark, sf)
    return MF.manifest_diff(remote, local)


@query("manifest_missing_sample")
def q_manifest_missing_sample(spark, sf):
    remote, local = A.manifests(spark, sf)
    return MF.missing_sample(remote, local, 10)


@query("authorised_updates")
def q_authorised_updates(spark, sf):
    r = AC.authorise(A.request_log(spark, sf), A.allowed_chats(spark, sf), A.BOT_SECRET)
    return r.select("event_id", "client_ip", "ip_ok", "token_ok", "user_allowed", "authorised")


# ---------------------------------------------------------------------------
# bot parsers, buttons, summaries and the dialogue replay
# ---------------------------------------------------------------------------
@query("money_parse_bot")
def q_money_parse_bot(spark, sf):
    t = A.bot_texts(spark, sf)
    return t.select("o_orderkey", "total_text", B.bot_money(F.col("total_text")).alias("total"))


@query("phone_parse_bot")
def q_phone_parse_bot(spark, sf):
    t = A.bot_texts(spark, sf)
    return t.select("o_orderkey", "phone_text", B.bot_phone(F.col("phone_text")).alias("phone"))


@query("product_button_id")
def q_product_button_id(spark, sf):
    return B.button_ids(A.mart_products(spark, sf))


@query("sale_summary_text")
def q_sale_summary_text(spark, sf):
    """Confirmation text for every mart order: client, phone, cart lines and total."""
    items = MT.valid_items(A.mart_items(spark, sf))
    lines = items.groupBy("order_id").agg(
        F.array_sort(
            F.collect_list(F.struct("id", "quantity", "product_name", "variant"))
        ).alias("_l")
    )
    o = A.mart_orders(spark, sf)
    c = A.mart_clients(spark, sf).select(F.col("id").alias("_cid"), F.col("name").alias("_cn"), F.col("phone").alias("_cp"))
    j = o.join(c, o["client_id"] == c["_cid"], "left").join(lines, o["id"] == lines["order_id"], "left")
    cart = F.transform(
        "_l", lambda e: F.struct(e["product_name"].alias("name"), e["variant"].alias("variant"), e["quantity"].alias("cantidad"))
    )
    return j.select(
        o["id"].alias("order_id"),
        B.sale_summary(F.col("_cn"), F.col("client_id").isNull(), F.col("_cp"), cart, F.col("total")).alias("summary"),
    )


@query("order_short_code")
def q_order_short_code(spark, sf):
    return A.mart_orders(spark, sf).select("id", X.short_code("id").alias("short_code"))


def _dialogue(spark, sf):
    prepared = B.prepare_updates(A.bot_updates(spark, sf), A.mart_clients(spark, sf), A.allowed_chats(spark, sf))
    return B.replay(prepared)


@query("dialogue_sales")
def q_dialogue_sales(spark, sf):
    return B.completed_sales(_dialogue(spark, sf)).select(
        "chat_id", "update_id", "telefono", "nombre", "client_id", "es_nuevo", F.size("productos").alias("lines"), "total"
    )


@query("dialogue_replies")
def q_dialogue_replies(spark, sf):
    return _dialogue(spark, sf).groupBy("reply", "state").agg(F.count(F.lit(1)).alias("n"))


def _bot_rows(spark, sf):
    sales = B.completed_sales(_dialogue(spark, sf))
    ts = A.bot_updates(spark, sf).select(F.col("update_id").alias("_u"), F.to_date("ts").alias("_d"))
    sales = sales.join(ts, sales["update_id"] == ts["_u"], "left")
    return B.sale_rows(sales, A.mart_products(spark, sf), F.col("_d"))


@query("bot_orders")
def q_bot_orders(spark, sf):
    return _bot_rows(spark, sf)["orders"]


@query("bot_items")
def q_bot_items(spark, sf):
    return _bot_rows(spark, sf)["order_items"]


@query("bot_clients")
def q_bot_clients(spark, sf):
    return _bot_rows(spark, sf)["clients"]


@query("bot_sale_rejects")
def q_bot_sale_rejects(spark, sf):
    """Sales whose total the order table cannot hold."""
    return _bot_rows(spark, sf)["rejects"].select("chat_id", "update_id", "telefono", "total")
