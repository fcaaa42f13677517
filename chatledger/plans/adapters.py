"""Input views derived deterministically from the driver tables.

The driver's tables carry no chat data, so each view maps a table onto the shape a stage
expects.  ``plans/oracle.py`` states the same mappings in SQL.  Every view reads whole
tables.  Modulo rules label rows (make a value blank, pick a label); only the views of a load
batch, of deletions, of a manifest and of an allow-list hold a part of their rows, because a part
is what they stand for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger import schemas as S
from chatledger.functions.text import uuid_from
from chatledger.llm.common import materialize
from chatledger.sources.tables import table

RAW_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _pick(values: list, index: Column) -> Column:
    """values[index] for a 0-based integer column (a constant array lookup, no join)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# ---------------------------------------------------------------------------
# V_msg: chat export rows from ``events``
# ---------------------------------------------------------------------------
# Test inputs: invented chat lines, about every topic that the extractor looks for and some that it
# does not.  A row picks one by (event_id * 7 + user_id).
CLIENT_PHRASES = [
    "Buenas, quisiera comprar algo para la oficina",
    "Para el lunes necesito 4 cajas de muffins",
    "Quiero 5 paquetes grandes",
    "Me das 6 brownies",
    "Quedo pendiente de mi encargo",
    "Van 3 arepas de maduro y queso y 2 de yuca y queso",
    "Ponme 12 arepitas y 1 de brownies",
    "Serán 7 unidades en total",
    "Mi casa queda por la calle 10 con 43",
    "Dejen todo en portería, apto 1201",
    "El edificio es blanco, torre norte",
    "Nos encontramos en el barrio Belén",
    "¿Reciben tarjeta o toca pagar con efectivo?",
    "Acabo de mandar el comprobante",
    "Hice la transferencia hace un rato",
    "Prefiero Bancolombia",
    "El pago va por Nequi",
    "¿El domiciliario demora mucho?",
    "Sigue sin aparecer lo que compré",
    "Me dicen que va en camino",
    "¿Cuáles sabores manejan?",
    "Envíame precios por favor",
    "Cancela lo que hablamos",
    "Al final ya no lo necesito",
    "Me llamo Teresa",
    "Soy Camilo, de la tienda",
    "¿Hay mufins de bananno?",
    "Un brownie y una gaseosa",
    "1 caja de wafles de yuca y queso",
    "Mi papá es diabético, ¿qué le sirve?",
    "¿El envío a Sabaneta tiene costo?",
    "¿Cuánto cuesta una caja de muffins de zanahria?",
    "¿En qué horario atienden?",
    "Estoy en Itagüí",
    "Daviplata me queda fácil",
    "¿Quiénes son ustedes?",
    "Jajaja qué rico",
]
BUSINESS_PHRASES = [
    "Su domiciliario salió, va en camino",
    "Cada caja está a $21.500",
    "Sí, vamos hasta Envigado",
    "Varios son sin azúcar",
    "De lunes a sábado, todo el día",
    "Recibimos Nequi y efectivo",
    "El local está en Medellín",
    "Anotado, el total es $63.900",
    "Con gusto",
]


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    uid = F.col("user_id").cast("string")
    eid = F.col("event_id")
    direction = (
        F.when(F.col("event_type").isin("view", "purchase"), F.lit(S.DIRECTION_INCOMING))
        .when(F.col("event_type") == "click", F.lit(S.DIRECTION_OUTGOING))
        .when(F.col("event_type") == "error", F.lit(S.DIRECTION_NOTICE))
    )
    contact = (
        F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("+57 300 "), F.lpad(uid, 7, "0")))
        .when(F.col("user_id") % 4 == 1, F.lit(""))
        .when(F.col("user_id") % 4 == 2, F.concat(F.lit("Cliente "), uid))
        .otherwise(F.concat(F.lit(" 300-"), F.lpad(uid, 5, "0"), F.lit(" ")))
    )
    pick = eid * 7 + F.col("user_id")
    phrase = F.when(F.col("event_type") == "click", _pick(BUSINESS_PHRASES, pick % len(BUSINESS_PHRASES))).otherwise(
        _pick(CLIENT_PHRASES, pick % len(CLIENT_PHRASES))
    )
    text = (
        F.when(eid % 11 == 0, F.lit(""))
        .when(eid % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), phrase, F.lit("\n")))
    )
    media = F.when(F.col("value") > 300, F.lit("  ")).when(F.col("value") > 30, F.lit("image"))
    none = F.lit(None).cast("string")
    return ev.select(
        F.concat(F.lit("WhatsApp - u"), uid).alias("chat_id"),
        F.when(eid % 97 == 0, F.lit("bad")).otherwise(F.date_format("ts", RAW_TS_FORMAT)).alias("sent_at"),
        none.alias("read_at"),
        direction.alias("direction"),
        none.alias("col4"),
        contact.alias("contact"),
        none.alias("status"),
        none.alias("col8"),
        text.alias("text"),
        none.alias("media_filename"),
        media.alias("media_type"),
        none.alias("media_metadata"),
        F.concat(F.lit("WhatsApp - u"), uid, F.lit(".csv")).alias("filename"),
        F.concat(F.lit("raw_chats/WhatsApp - u"), uid, F.lit(".csv")).alias("file_path"),
        eid.alias("file_row"),
    )


# ---------------------------------------------------------------------------
# Mart tables from customer / orders / lineitem
# ---------------------------------------------------------------------------
RUN_TS = "2025-01-01 00:00:00"  # fixed load time so outputs repeat (no wall clock)
CITIES = ["Medellín", "Bogotá", "Envigado", "Itagüí"]
PAYMENTS = ["Nequi", "Daviplata", "efectivo", "transferencia"]


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


def source_client_id(custkey: Column) -> Column:
    k = custkey.cast("string")
    return F.when(custkey % 2 == 0, F.concat(F.lit("+57300"), F.lpad(k, 7, "0"))).otherwise(
        F.concat(F.lit("WhatsApp - Cliente "), k)
    )


def client_uuid(source_id: Column) -> Column:
    return uuid_from(F.concat(F.lit("client:"), source_id))


def order_uuid(session_id: Column) -> Column:
    return uuid_from(F.concat(F.lit("order:"), session_id))


def product_uuid(name: Column, variant: Column) -> Column:
    return uuid_from(F.concat(F.lit("product:"), name, F.lit(":"), F.coalesce(variant, F.lit(""))))


def mart_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    k = F.col("c_custkey")
    src = source_client_id(k)
    created = F.expr("timestampadd(MINUTE, c_custkey % 1000, TIMESTAMP_NTZ'2023-01-01 00:00:00')")
    return c.select(
        client_uuid(src).alias("id"),
        F.when(k % 4 == 3, F.lit(None).cast("string")).otherwise(F.concat(F.lit("+57300"), F.lpad(k.cast("string"), 7, "0"))).alias("phone"),
        F.col("c_name").alias("name"),
        src.alias("source_client_id"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def order_client_key(custkey: Column) -> Column:
    """Customer an order is booked to: customers with key % 10 = 0 hand their orders to the
    next key, so they stay in the client table without orders (every order is kept)."""
    return F.when(custkey % 10 == 0, custkey + 1).otherwise(custkey)


def mart_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    sess = F.concat(F.lit("o"), ok.cast("string"))
    return o.select(
        order_uuid(sess).alias("id"),
        F.when(ok % 19 == 0, F.lit(None).cast("string")).otherwise(client_uuid(source_client_id(order_client_key(ck)))).alias("client_id"),
        F.when(ok % 17 == 0, F.lit(None).cast("date")).otherwise(F.to_date("o_orderdate")).alias("order_date"),
        F.when(ok % 7 == 0, F.lit(None).cast("string")).otherwise(_pick(CITIES, ck % 4)).alias("city"),
        F.concat(F.lit("Calle "), (ck % 100).cast("string"), F.lit(" # "), (ok % 50).cast("string")).alias("address"),
        _pick(PAYMENTS, ok % 4).alias("payment_method"),
        F.when(ok % 13 == 0, F.lit(None).cast("decimal(12,2)")).otherwise(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"),
        F.when(F.col("o_orderstatus") == "F", F.lit("delivered"))
        .when(F.col("o_orderstatus") == "O", F.lit("pending"))
        .otherwise(F.lit("confirmed"))
        .alias("status"),
        sess.alias("source_session_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
    )


def catalogue_name(partkey: Column) -> Column:
    names = [n for n, _ in S.CATALOGUE]
    blank = partkey % 97 == 0
    return F.when(blank, F.lit("")).otherwise(_pick(names, partkey % len(names)))


def catalogue_variant(partkey: Column) -> Column:
    variants = [v for _, v in S.CATALOGUE]
    return _pick(variants, partkey % len(variants))


def mart_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    key = F.concat_ws(":", F.lit("item:o"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    pk = F.col("l_partkey")
    return li.select(
        uuid_from(key).alias("id"),
        order_uuid(F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))).alias("order_id"),
        F.lit(None).cast("string").alias("product_id"),
        catalogue_name(pk).alias("product_name"),
        catalogue_variant(pk).alias("variant"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.lit(S.BOT_ITEM_UNIT).alias("unit"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("created_at"),
    )


def mart_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct non-blank (name, variant) of the items (the loader's products table).

    It is written as a table: a distinct of the items is taken for as large as they are, and items joined
    with it would be dealt out by product, a few huge keys."""
    items = mart_items(spark, sf_dir).filter(F.coalesce(F.col("product_name"), F.lit("")) != "")
    d = items.select(F.col("product_name").alias("name"), "variant").distinct()
    return materialize(d.select(product_uuid(F.col("name"), F.col("variant")).alias("id"), "name", "variant", run_ts().alias("created_at")))


# ---------------------------------------------------------------------------
# Incoming batches for the upsert operators (derived from the same tables)
# ---------------------------------------------------------------------------
def batch_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third customer re-sent: phone missing for even keys (old phone kept), new name;
    keys divisible by 5 arrive under a new source id (inserts)."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name").filter(F.col("c_custkey") % 3 == 0)
    k = F.col("c_custkey")
    src = F.when(k % 5 == 0, F.concat(F.lit("nuevo-"), source_client_id(k))).otherwise(source_client_id(k))
    return c.select(
        client_uuid(src).alias("id"),
        F.when(k % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("+57301"), F.lpad(k.cast("string"), 7, "0"))).alias("phone"),
        F.upper("c_name").alias("name"),
        src.alias("source_client_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def batch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth order re-sent (city dropped, status cancelled or missing); every 40th
    arrives under a new session id (an insert)."""
    base = mart_orders_all(spark, sf_dir).filter(F.col("_ok") % 4 == 0)
    return base.select(
        "id",
        "client_id",
        "order_date",
        F.lit(None).cast("string").alias("city"),
        "address",
        "payment_method",
        "total",
        F.when(F.col("_ok") % 8 == 0, F.lit("cancelled")).otherwise(F.lit(None).cast("string")).alias("status"),
        "source_session_id",
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def mart_orders_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-sent order rows keyed like ``mart_orders``, keeping the order key as ``_ok``."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    base = F.concat(F.lit("o"), ok.cast("string"))
    sess = F.when(ok % 40 == 0, F.concat(base, F.lit("-b"))).otherwise(base)
    return o.select(
        ok.alias("_ok"),
        order_uuid(sess).alias("id"),
        client_uuid(source_client_id(order_client_key(ck))).alias("client_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.concat(F.lit("Calle "), (ck % 100).cast("string"), F.lit(" # "), (ok % 50).cast("string")).alias("address"),
        _pick(PAYMENTS, ok % 4).alias("payment_method"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        sess.alias("source_session_id"),
    )


def batch_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Muffin rows re-sent with their variant upper-cased (same ids: updates)."""
    p = mart_products(spark, sf_dir).filter(F.col("name") == "Muffin")
    return p.select("id", "name", F.upper("variant").alias("variant"), F.lit(None).cast("timestamp_ntz").alias("created_at"))


def batch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines re-sent: quantity missing for every third order (-> 1); orders divisible
    by 5 arrive under new ids (inserts); blank names are skipped by the loader."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    li = li.filter(F.col("l_linenumber") == 1)
    ok = F.col("l_orderkey")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    key = F.when(ok % 5 == 0, F.concat_ws(":", F.lit("item:new:o"), *parts)).otherwise(F.concat_ws(":", F.lit("item:o"), *parts))
    pk = F.col("l_partkey")
    return li.select(
        uuid_from(key).alias("id"),
        order_uuid(F.concat(F.lit("o"), ok.cast("string"))).alias("order_id"),
        F.lit(None).cast("string").alias("product_id"),
        catalogue_name(pk).alias("product_name"),
        catalogue_variant(pk).alias("variant"),
        F.when(ok % 3 == 0, F.lit(None).cast("int")).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.lit("paquete").alias("unit"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
    )


def deletions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Delete lists: every 50th customer, every 50th order (key % 50 = 2), Banano products."""
    c = table(spark, sf_dir, "customer", "c_custkey").filter(F.col("c_custkey") % 50 == 1)
    dc = c.select(client_uuid(source_client_id(F.col("c_custkey"))).alias("id"))
    o = table(spark, sf_dir, "orders", "o_orderkey").filter(F.col("o_orderkey") % 50 == 2)
    do = o.select(order_uuid(F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))).alias("id"))
    dp = mart_products(spark, sf_dir).filter(F.col("variant") == "Banano").select("id")
    return dc, do, dp


def phone_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phones typed into the bot: one per customer, spaced, without '+'."""
    c = table(spark, sf_dir, "customer", "c_custkey")
    k = F.col("c_custkey").cast("string")
    return c.select(F.concat(F.lit("57 300 "), F.lpad(k, 7, "0")).alias("phone_input"))


# ---------------------------------------------------------------------------
# V_res: order-extraction output per session, from orders + lineitem
# ---------------------------------------------------------------------------
SESSIONS_PER_USER_SLOT = 64  # order key -> (user = key div 64, session number = key % 64)


def _jstr(c: Column) -> Column:
    """JSON text of a string column, 'null' for NULL (escapes backslash, quote, newline)."""
    e = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), e, F.lit('"')))


def _obj(pairs: list[tuple[str, Column]]) -> Column:
    parts = []
    for i, (k, v) in enumerate(pairs):
        parts += [F.lit(("," if i else "{") + f'"{k}":'), v]
    parts.append(F.lit("}"))
    return F.concat(*parts)


def _product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    pk, ln = F.col("l_partkey"), F.col("l_linenumber")
    q = F.col("l_quantity").cast("int").cast("string")
    qty = (
        F.when(ln == 4, F.lit("null"))
        .when(ln == 5, F.concat(F.lit('"'), q, F.lit('"')))
        .when(ln == 6, F.lit("0"))
        .when(ln == 7, F.lit('"dos"'))
        .otherwise(q)
    )
    elem = _obj(
        [
            ("name", _jstr(catalogue_name(pk))),
            ("variant", _jstr(catalogue_variant(pk))),
            ("presentation", F.lit("null")),
            ("quantity_units", qty),
            ("unit", F.when(ln == 3, F.lit('""')).otherwise(F.lit('"caja"'))),
            ("unit_price_approx", F.col("l_extendedprice").cast("string")),
        ]
    )
    return li.groupBy("l_orderkey").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    ln.alias("a"), pk.alias("b"), F.col("l_suppkey").alias("c"),
                    F.col("l_quantity").alias("d"), F.col("l_extendedprice").alias("f"), elem.alias("e"),
                )
            )
        ).alias("_p")
    ).select("l_orderkey", F.concat(F.lit("["), F.array_join(F.transform("_p", lambda x: x["e"]), ","), F.lit("]")).alias("products_json"))


def extraction_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extractor output per session: metadata, raw response text and error."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    o = o.join(_product_lines(spark, sf_dir), o["o_orderkey"] == F.col("l_orderkey"), "left")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    uid = F.floor(k / SESSIONS_PER_USER_SLOT).cast("string")
    conv = F.concat(F.lit("WhatsApp - u"), uid)
    sess = F.concat(conv, F.lit(S.SESSION_SEPARATOR), (k % SESSIONS_PER_USER_SLOT).cast("string"))
    ck = c.cast("string")
    phone = (
        F.when(c % 4 == 0, F.concat(F.lit("+57300"), F.lpad(ck, 7, "0")))
        .when(c % 4 == 1, F.concat(F.lit("300"), F.lpad(ck, 7, "0")))
    )
    name = F.when(c % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Cliente "), ck))
    customer = F.when(c % 23 == 0, F.lit("null")).otherwise(_obj([("phone", _jstr(phone)), ("name", _jstr(name))]))
    otype = (
        F.when(k % 29 == 0, F.lit("cancelled"))
        .when(F.col("o_orderstatus") == "F", F.lit("confirmed"))
        .when(F.col("o_orderstatus") == "P", F.lit("delivery_followup"))
        .otherwise(F.lit("quotation"))
    )
    d = F.col("o_orderdate")
    odate = (
        F.when(k % 3 == 0, F.lit(None).cast("string"))
        .when((k % 3 == 1) & (k % 5 == 0), F.date_format(d, "yyyy-M-d"))
        .when((k % 3 == 1) & (k % 7 == 0), F.date_format(d, "dd/MM/yyyy"))
        .when((k % 3 == 2) & (k % 11 == 0), F.lit(""))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    tot = F.col("o_totalprice")
    dotted = F.replace(F.format_number(F.floor(tot), 0), F.lit(","), F.lit("."))
    total = (
        F.when(k % 2 == 0, tot.cast("string"))
        .when(k % 10 == 1, F.concat(F.lit('"$'), dotted, F.lit('"')))
        .when(k % 10 == 3, F.concat(F.lit('"'), dotted, F.lit(',50"')))
        .when(k % 10 == 5, F.lit('"consultar"'))
        .when(k % 10 == 7, F.lit("null"))
        .otherwise(F.concat(F.lit('"'), F.floor(tot).cast("string"), F.lit('"')))
    )
    pj = F.col("products_json")
    products = (
        F.when(k % 43 == 0, F.lit('"ver chat"'))
        .when(k % 47 == 0, F.lit("[]"))
        .when(pj.isNull(), F.lit("null"))
        .when(k % 53 == 0, F.concat(F.expr("substring(products_json, 1, length(products_json) - 1)"), F.lit(',"extra"]')))
        .otherwise(pj)
    )
    order = F.when(k % 37 == 0, F.lit("null")).otherwise(
        _obj(
            [
                ("has_order", F.when(F.col("o_orderstatus") == "O", F.lit("false")).otherwise(F.lit("true"))),
                ("order_type", _jstr(otype)),
                ("order_date", _jstr(odate)),
                ("city", _jstr(F.when(k % 7 == 0, F.lit("")).otherwise(_pick(CITIES, c % 4)))),
                ("address", _jstr(F.concat(F.lit("Calle "), (c % 100).cast("string"), F.lit(" # "), (k % 50).cast("string")))),
                ("payment_method", _jstr(_pick(PAYMENTS, k % 4))),
                ("approx_total", total),
                ("products", products),
            ]
        )
    )
    response = _obj([("conversation_id", _jstr(conv)), ("customer", customer), ("order", order)])
    response = F.when(k % 101 == 50, F.lit('{"order": {"order_type": "confirmed", ')).otherwise(response)
    rate_limited = k % 89 == 0
    return o.select(
        sess.alias("session_id"),
        conv.alias("conversation_id"),
        source_client_id(c).alias("client_id"),
        F.when(rate_limited, F.lit(None).cast("string")).otherwise(response).alias("response"),
        F.when(rate_limited, F.lit("Max retries exceeded (rate limit)")).alias("error"),
    )


# ---------------------------------------------------------------------------
# File listings and manifests from ``documents``
# ---------------------------------------------------------------------------
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chat folder listing: name and size per document, with varied suffixes."""
    d = table(spark, sf_dir, "documents", "doc_id", "n_chars")
    k = F.col("doc_id")
    ks = k.cast("string")
    name = (
        F.when(k % 5 == 0, F.concat(F.lit("WhatsApp - d"), ks, F.lit(".csv")))
        .when(k % 5 == 1, F.concat(F.lit("WhatsApp - d"), ks, F.lit(".CSV")))
        .when(k % 5 == 2, F.concat(F.lit("WhatsApp - d"), ks, F.lit(".txt")))
        .when(k % 5 == 3, F.concat(F.lit("d"), ks, F.lit(" WhatsApp Business.csv")))
        .otherwise(F.concat(F.lit("chat d"), ks, F.lit(".csv")))
    )
    size = F.when(k % 13 == 0, F.lit(0).cast("bigint")).otherwise(F.col("n_chars"))
    return d.select(name.alias("file_name"), size.alias("file_size"))


def manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Remote names (with duplicates) and local names (some missing, some extra)."""
    d = table(spark, sf_dir, "documents", "doc_id")
    k = F.col("doc_id")
    remote = d.select(
        F.concat(F.lit("chat_"), F.when(k % 11 == 0, k - 1).otherwise(k).cast("string"), F.lit(".csv")).alias("name")
    )
    local = d.filter(k % 3 != 0).select(F.concat(F.lit("chat_"), k.cast("string"), F.lit(".csv")).alias("name")).unionByName(
        d.filter(k % 7 == 0).select(F.concat(F.lit("viejo_"), k.cast("string"), F.lit(".csv")).alias("name"))
    )
    return remote, local


# ---------------------------------------------------------------------------
# Webhook request log and bot inputs from ``events``
# ---------------------------------------------------------------------------
BOT_SECRET = ""  # blank: any token accepted and the source-range test applies


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    e, u = F.col("event_id"), F.col("user_id")
    return ev.select(
        e.alias("event_id"),
        F.col("ts"),
        u.alias("chat_id"),
        F.concat(F.lit("149.154."), (160 + u % 20).cast("string"), F.lit("."), (e % 256).cast("string")).alias("peer_ip"),
        F.when(e % 3 == 0, F.concat(F.lit(" 91.108."), (4 + e % 6).cast("string"), F.lit("."), (u % 256).cast("string"), F.lit(", 10.0.0.1"))).alias("x_forwarded_for"),
        F.when(e % 3 == 1, F.when(e % 7 == 0, F.lit("not-an-ip")).otherwise(F.concat(F.lit("149.154.17"), (e % 10).cast("string"), F.lit(".9")))).alias("x_real_ip"),
        F.when(e % 4 == 0, F.lit("wrong")).otherwise(F.lit("s3cret")).alias("secret_token"),
    )


def allowed_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allow-list, written as a table for the reason given at ``mart_products``."""
    ev = table(spark, sf_dir, "events", "user_id")
    return materialize(ev.filter(F.col("user_id") % 10 != 9).select(F.col("user_id").alias("chat_id")).distinct())


def bot_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messaging updates per chat (= user): commands, phones, names, product and quantity
    buttons, totals and confirmations, chosen from the event type and value.  Two of three
    purchases are whole dialogues of eight updates, some of which go wrong at one step."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    e, u, v, t = F.col("event_id"), F.col("user_id"), F.col("value"), F.col("event_type")
    scripted = (t == "purchase") & (e % 3 != 0)
    buttons = [f"prod_{n.lower()}_{(vv or '').lower().replace(' ', '_')}" for n, vv in S.CATALOGUE]
    caller = F.when(e % 5 == 0, u + 5_000_000).otherwise(u)  # a fifth are nobody's number yet
    # What an event says is chosen before it becomes updates, and each choice stands once: all of it for every update, nested
    # into the structs below, makes one generated method too long for the JVM to compile.
    ev = ev.select(
        (e * 8).alias("_first"),
        u.alias("_chat"),
        "ts",
        scripted.alias("_scripted"),
        F.when(e % 37 == 0, F.lit("12")).otherwise(F.concat(F.lit("+57 300 "), F.lpad(caller.cast("string"), 7, "0"))).alias("_phone"),
        F.when(e % 31 == 0, F.lit("A")).otherwise(F.concat(F.lit("Cliente "), e.cast("string"))).alias("_name"),
        F.when(e % 23 == 0, F.lit("abc")).when(e % 29 == 0, F.lit("99999999999")).otherwise(F.concat(F.lit("$"), (20 + e % 900).cast("string"), F.lit(".000"))).alias("_total"),
        F.when((t == "signup") & (v < 8), F.lit("/venta"))
        .when(t == "signup", F.concat(F.lit("+57 300 "), F.lpad(u.cast("string"), 7, "0")))
        .when((t == "view") & (v < 3), F.lit("123"))
        .when((t == "view") & (v > 250), F.lit("A"))
        .when(t == "view", F.concat(F.lit("Cliente "), u.cast("string")))
        .when((t == "error") & (v < 60) & (e % 7 == 0), F.lit("abc"))
        .when((t == "error") & (v < 60), F.lit("$66.000"))
        .alias("_own_text"),
        F.when(scripted, _pick(buttons, e % len(buttons))).alias("_button"),
        F.when(e % 19 == 0, F.lit("cant_3000000000")).otherwise(F.concat(F.lit("cant_"), (1 + e % 10).cast("string"))).alias("_quantity"),
        F.when(e % 11 == 0, F.lit("confirm_no")).otherwise(F.lit("confirm_si")).alias("_confirm"),
        F.when((t == "purchase") & (e % 4 == 0), F.lit("prod_finalizar"))
        .when((t == "purchase") & (e % 17 == 0), F.lit("prod_desconocido"))
        .when(t == "purchase", _pick(buttons, e % len(buttons)))
        .when((t == "click") & (e % 13 == 0), F.lit("cant_cancelar"))
        .when(t == "click", F.concat(F.lit("cant_"), (1 + e % 10).cast("string")))
        .when((t == "error") & (v >= 60) & (e % 5 == 0), F.lit("confirm_no"))
        .when((t == "error") & (v >= 60), F.lit("confirm_si"))
        .alias("_own_data"),
    )
    steps = F.when(F.col("_scripted"), F.sequence(F.lit(0), F.lit(7))).otherwise(F.array(F.lit(-1)))
    ev = ev.select("*", F.explode(steps).alias("i"))
    i = F.col("i")
    text = F.when(i == 0, F.lit("/venta"))
    for at, said in ((1, "_phone"), (2, "_name"), (6, "_total"), (-1, "_own_text")):
        text = text.when(i == at, F.col(said))
    data = F.when(i == 5, F.lit("prod_finalizar"))
    for at, said in ((3, "_button"), (4, "_quantity"), (7, "_confirm"), (-1, "_own_data")):
        data = data.when(i == at, F.col(said))
    ev = ev.select((F.col("_first") + F.greatest(i, F.lit(0))).alias("update_id"), "_chat", text.alias("_text"), data.alias("_data"), "ts")
    update_id, text, data = F.col("update_id"), F.col("_text"), F.col("_data")
    chat = F.struct(F.col("_chat").alias("id"))
    message = F.when(
        text.isNotNull(),
        F.struct(update_id.alias("message_id"), chat.alias("chat"), F.struct(F.lit("Ana").alias("first_name")).alias("from"), text.alias("text")),
    )
    callback = F.when(
        data.isNotNull(),
        F.struct(update_id.cast("string").alias("id"), data.alias("data"), F.struct(update_id.alias("message_id"), chat.alias("chat")).alias("message")),
    )
    return ev.select("update_id", message.alias("message"), callback.alias("callback_query"), "ts")


def bot_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and phones as typed into the bot, from order totals and customer keys."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    whole = F.floor("o_totalprice").cast("bigint")
    dotted = F.replace(F.format_number(whole, 0), F.lit(","), F.lit("."))
    total = (
        F.when(k % 6 == 0, F.concat(F.lit("$"), dotted))
        .when(k % 6 == 1, F.format_number(whole, 0))
        .when(k % 6 == 2, F.concat(F.lit(" "), whole.cast("string"), F.lit(" ")))
        .when(k % 6 == 3, F.lit("abc"))
        .when(k % 6 == 4, F.lit("-5"))
        .otherwise(F.lit("0"))
    )
    phone = F.when(k % 9 == 0, F.lit("12 34")).otherwise(F.concat(F.lit("+57 (300) "), F.lpad((k % 10000000).cast("string"), 7, "0")))
    return o.select(k.alias("o_orderkey"), total.alias("total_text"), phone.alias("phone_text"))


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_name").select(F.col("p_name").alias("name"))


def typed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as a client writes them: a character is missing, for every third part one is wrong at the
    end, and every seventh name has a word before it that makes it no catalogue name."""
    k, n = F.col("p_partkey"), F.col("p_name")
    at = (1 + k % F.length(n)).cast("int")
    cut = F.concat(F.substring(n, F.lit(1), at - 1), F.substring(n, at + 1, F.length(n)))
    short = F.when(k % 3 == 0, F.concat(F.expr("left(_s, length(_s) - 1)"), F.lit("x"))).otherwise(F.col("_s"))
    text = F.when(k % 7 == 0, F.concat(F.lit("otro "), short)).otherwise(short)
    return table(spark, sf_dir, "part", "p_partkey", "p_name").withColumn("_s", cut).select("p_partkey", text.alias("mention"))
