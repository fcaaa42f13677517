"""Extractor results -> orders, items, clients and the flat sales export.

Results are semi-structured and untrusted: the response text is parsed into a VARIANT
column once, and every field is read with ``try_variant_get`` so one bad value makes one
field NULL, never the whole row (``from_json`` to a struct would null the whole array).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatledger import schemas as S
from chatledger.functions import text as X



# ---------------------------------------------------------------------------
# variant helpers
# ---------------------------------------------------------------------------
def vget(v: Column, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(v, path, typ)


def vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


NUMERIC_TYPE = r"^(DECIMAL|BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT)"


def typed(v: Column) -> Column:
    """Stage a variant with its type name so later tests evaluate ``schema_of_variant`` once."""
    return F.struct(v.alias("v"), vtype(v).alias("t"))


def is_string(v: Column, t: Column | None = None) -> Column:
    return (vtype(v) if t is None else t) == "STRING"


def is_number(v: Column, t: Column | None = None) -> Column:
    return (vtype(v) if t is None else t).rlike(NUMERIC_TYPE)


def is_object(v: Column, t: Column | None = None) -> Column:
    return (vtype(v) if t is None else t).startswith("OBJECT")


def is_array(v: Column, t: Column | None = None) -> Column:
    return (vtype(v) if t is None else t).startswith("ARRAY")


def truthy(v: Column, t: Column | None = None) -> Column:
    """Python truthiness of a JSON value (null, false, 0, '', [] and {} are false)."""
    t = vtype(v) if t is None else t
    return (
        F.when(v.isNull() | t.isNull(), F.lit(False))
        .when(t.isin("NULL", "VOID"), F.lit(False))
        .when(t == "STRING", vget(v, "$", "string") != "")
        .when(t == "BOOLEAN", vget(v, "$", "boolean"))
        .when(t.rlike(NUMERIC_TYPE), vget(v, "$", "double") != 0)
        .when(t == "OBJECT<>", F.lit(False))
        .when(t.startswith("ARRAY"), F.size(vget(v, "$", "array<variant>")) > 0)
        .otherwise(F.lit(True))
    )


def money(v: Column, t: Column | None = None) -> Column:
    """Export money rule: text is cleaned ('$', thousands dots, decimal comma); numbers pass."""
    t = vtype(v) if t is None else t
    return (
        F.when(t == "STRING", X.money_text_to_number(vget(v, "$", "string")))
        .when(t.rlike(NUMERIC_TYPE), vget(v, "$", "double"))
    )


# ---------------------------------------------------------------------------
# parse (E4) and status
# ---------------------------------------------------------------------------
def parse_results(ext: DataFrame) -> DataFrame:
    """(session_id, conversation_id, client_id, response, error) -> + ``result`` VARIANT.

    An unparsable response becomes an error row; an ``error`` key inside the response also
    counts as an error.

    The parse is produced by a one-element ``inline`` so it is evaluated once per row: filters
    on fields of ``result`` (for example the exported order types) cannot be pushed below a
    generator, whereas below a plain projection Catalyst would substitute and re-run the parse
    inside the filter.
    """
    parsed = ext.select(
        "session_id",
        "conversation_id",
        "client_id",
        "response",
        "error",
        F.inline(F.array(F.struct(F.try_parse_json("response").alias("result")))),
    )
    v = F.col("result")
    err = F.coalesce(
        F.col("error"),
        F.when(F.col("response").isNotNull() & v.isNull(), F.lit("invalid JSON response")),
        vget(v, "$.error", "string"),
        F.when(F.col("response").isNull(), F.lit("no response")),
    )
    return parsed.select("session_id", "conversation_id", "client_id", "result", err.alias("error"))


def extract_status(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("error").isNull()).alias("ok"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )


# ---------------------------------------------------------------------------
# typed projections
# ---------------------------------------------------------------------------
def typed_orders(results: DataFrame) -> DataFrame:
    """Typed projection of an order result; every field is read by its full path from the
    parsed root (no intermediate sub-variant copies)."""
    r = F.col("result")
    return results.select(
        "session_id",
        "conversation_id",
        "client_id",
        vget(r, "$.order.order_type").alias("order_type"),
        vget(r, "$.order.order_date").alias("order_date_text"),
        vget(r, "$.order.city").alias("city"),
        vget(r, "$.order.address").alias("address"),
        vget(r, "$.order.payment_method").alias("payment_method"),
        vget(r, "$.order.approx_total", "variant").alias("approx_total"),
        vget(r, "$.order.products", "variant").alias("products"),
        vget(r, "$.customer.phone").alias("customer_phone"),
        vget(r, "$.customer.name").alias("customer_name"),
    )


def exported_orders(results: DataFrame) -> DataFrame:
    """order_type confirmed or delivery_followup (has_order is not consulted)."""
    return typed_orders(results).filter(F.col("order_type").isin(*S.EXPORTED_ORDER_TYPES))


def with_order_date(orders: DataFrame, last_dates: DataFrame) -> DataFrame:
    """Result date if non-empty, else the session's last message date, else NULL."""
    j = orders.join(last_dates, "session_id", "left")
    llm = F.coalesce(F.col("order_date_text"), F.lit("")) != ""
    return (
        j.withColumn("order_date", F.when(llm, F.col("order_date_text")).otherwise(F.col("last_date")))
        .withColumn(
            "order_date_source",
            F.when(llm, F.lit("llm")).when(F.col("last_date").isNotNull(), F.lit("last_message")).otherwise(F.lit("none")),
        )
        .drop("last_date")
    )


def date_source_counts(dated: DataFrame) -> DataFrame:
    return dated.groupBy("order_date_source").agg(F.count(F.lit(1)).alias("orders"))


def _product_elements(products: Column) -> Column:
    return F.when(is_array(products), vget(products, "$", "array<variant>"))


def product_label(products: Column) -> Column:
    """'Muffin (Banano) x2 caja; Brownie x1' — objects only, non-list -> ''."""

    def stage(e):
        var = vget(e, "$.variant", "variant")
        qty = vget(e, "$.quantity_units", "variant")
        unit = vget(e, "$.unit", "variant")
        return F.struct(
            vtype(e).alias("et"),
            F.coalesce(vget(e, "$.name"), F.lit("")).alias("name"),
            typed(var).alias("var"),
            typed(qty).alias("qty"),
            typed(unit).alias("unit"),
        )

    def part(x, field):
        return F.when(truthy(x[field]["v"], x[field]["t"]), vget(x[field]["v"], "$"))

    staged = F.filter(F.transform(_product_elements(products), stage), lambda x: x["et"].startswith("OBJECT"))
    label = F.transform(
        staged,
        lambda x: F.concat_ws(
            " ",
            x["name"],
            F.concat(F.lit("("), part(x, "var"), F.lit(")")),
            F.concat(F.lit("x"), part(x, "qty")),
            part(x, "unit"),
        ),
    )
    return F.coalesce(F.array_join(label, "; "), F.lit(""))


def sales_flat(dated: DataFrame) -> DataFrame:
    """The 13-column flat sales export."""
    return dated.select(
        "conversation_id",
        "session_id",
        "client_id",
        "customer_phone",
        "customer_name",
        "order_type",
        "order_date",
        "order_date_source",
        "city",
        "address",
        "payment_method",
        vget(F.col("approx_total"), "$").alias("approx_total"),
        product_label(F.col("products")).alias("products"),
    )


def client_key(source_id: Column) -> Column:
    return X.uuid_from(F.concat(F.lit("client:"), source_id))


def orders_table(dated: DataFrame, run_ts: Column) -> DataFrame:
    """Order rows of the mart export (ids derived from the session / client key)."""
    return dated.select(
        X.uuid_from(F.concat(F.lit("order:"), F.col("session_id"))).alias("id"),
        client_key(F.col("client_id")).alias("client_id"),
        X.blank_to_null("order_date").alias("order_date"),
        X.blank_to_null("city").alias("city"),
        X.blank_to_null("address").alias("address"),
        X.blank_to_null("payment_method").alias("payment_method"),
        money(F.col("approx_total")).alias("total"),
        F.coalesce(F.col("order_type"), F.lit("confirmed")).alias("status"),
        F.col("session_id").alias("source_session_id"),
        run_ts.alias("created_at"),
    )


def items_table(orders: DataFrame) -> DataFrame:
    """One row per *object* element of ``order.products``; position kept for the id."""
    ex = orders.select("session_id", F.posexplode(_product_elements(F.col("products"))).alias("pos", "e"))
    e = F.col("e")
    exact, approx = vget(e, "$.unit_price", "variant"), vget(e, "$.unit_price_approx", "variant")
    # A JSON null is a value of its own type, not SQL NULL.
    price = F.when(F.coalesce(vtype(exact), F.lit("VOID")) != "VOID", exact).otherwise(approx)
    qty = vget(e, "$.quantity_units", "variant")
    st = ex.select(
        "session_id",
        "pos",
        vtype(e).alias("et"),
        vget(e, "$.name").alias("name"),
        vget(e, "$.variant").alias("variant"),
        vget(e, "$.unit").alias("unit"),
        qty.alias("q"),
        vtype(qty).alias("qt"),
        price.alias("p"),
        vtype(price).alias("pt"),
    ).filter(F.col("et").startswith("OBJECT"))
    q, qt = F.col("q"), F.col("qt")
    qnum = F.when(qt.rlike(NUMERIC_TYPE), vget(q, "$", "double")).when(qt == "STRING", X.strip(vget(q, "$")).try_cast("double"))
    return st.select(
        X.uuid_from(F.concat(F.lit("item:"), F.col("session_id"), F.lit(":"), F.col("pos").cast("string"))).alias("id"),
        X.uuid_from(F.concat(F.lit("order:"), F.col("session_id"))).alias("order_id"),
        F.coalesce(F.col("name"), F.lit("")).alias("product_name"),
        X.blank_to_null("variant").alias("variant"),
        F.when(~truthy(q, qt), F.lit(1)).otherwise(F.round(qnum).try_cast("bigint")).alias("quantity"),
        X.blank_to_null("unit").alias("unit"),
        money(F.col("p"), F.col("pt")).alias("unit_price"),
    )


def clients_table(orders: DataFrame, first_contact: DataFrame, run_ts: Column) -> DataFrame:
    """A4 with F2/F3: one client per source id, customer data of its first order by session id."""
    first = orders.groupBy(F.col("client_id").alias("source_client_id")).agg(
        F.min_by(F.struct("customer_phone", "customer_name"), F.col("session_id")).alias("_c")
    )
    src = F.col("source_client_id")
    cp = F.col("_c.customer_phone")
    phone = F.when(F.coalesce(cp, F.lit("")).startswith("+"), cp).when(src.startswith("+"), src)
    nm = F.col("_c.customer_name")
    fallback = X.strip(F.replace(src, F.lit("WhatsApp - "), F.lit("")))
    name = F.when(
        (F.coalesce(nm, F.lit("")) == "") & phone.isNull() & ~src.startswith("+"), fallback
    ).otherwise(nm)
    fc = first_contact.select(F.col("client_id").alias("_fc_id"), "first_contact")
    j = first.join(fc, first["source_client_id"] == fc["_fc_id"], "left")
    return j.select(
        client_key(src).alias("id"),
        phone.alias("phone"),
        X.blank_to_null(name).alias("name"),
        src.alias("source_client_id"),
        F.coalesce(F.col("first_contact"), X.iso_timestamp(run_ts)).alias("created_at"),
    )
