"""Order mart maintenance: idempotent upserts, delete propagation, lookups, quality rules.

Plain Parquet tables have no constraints and no MERGE, so each table write is a new
version: a left join of the current table with the incoming batch on ``id``, and the inserts.  Ids are content-derived, so re-loading a batch is a no-op apart from ``updated_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatledger import schemas as S


def dedupe_last(batch: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Keep one row per key: the one with the highest values of ``order_cols`` (last wins).

    Uses a partial aggregate (``max_by``) so a hot key costs one small combiner value,
    never a sorted group.
    """
    cols = [c for c in batch.columns if c != key]
    packed = F.max_by(F.struct(*cols), F.struct(*order_cols)).alias("_r")
    return batch.groupBy(key).agg(packed).select(key, "_r.*")


def _upsert(target: DataFrame, batch: DataFrame, rules: dict[str, Column], columns: list[str]) -> DataFrame:
    """New table version: one left join of the target with the batch gives untouched and updated
    rows in a pass; inserts are the batch's rows whose id the target does not have (a second scan
    of the target, of its ids only).  Spark broadcasts a batch below its own size threshold."""
    joined = target.alias("t").join(batch.alias("s"), F.col("t.id") == F.col("s.id"), "left")
    hit = F.col("s.id").isNotNull()
    out = []
    for c in columns:
        rule = rules.get(c)
        # a column not written by the upsert keeps the target's value
        out.append((F.col(f"t.{c}") if rule is None else F.when(hit, rule).otherwise(F.col(f"t.{c}"))).alias(c))
    known = target.select(F.col("id").alias("_hit"))
    inserts = batch.join(known, batch["id"] == known["_hit"], "left_anti").select(*columns)
    return joined.select(*out).unionByName(inserts)


def upsert_clients(target: DataFrame, batch: DataFrame, run_ts: Column) -> DataFrame:
    """phone, name = COALESCE(new, old); source_client_id = new; created_at kept;
    updated_at = run time on every row that takes the update branch."""
    b = batch.withColumn("updated_at", run_ts)
    rules = {
        "phone": F.coalesce(F.col("s.phone"), F.col("t.phone")),
        "name": F.coalesce(F.col("s.name"), F.col("t.name")),
        "source_client_id": F.col("s.source_client_id"),
        "created_at": F.col("t.created_at"),
        "updated_at": run_ts,
    }
    return _upsert(target, b, rules, S.CLIENTS_SCHEMA.names)


def upsert_orders(target: DataFrame, batch: DataFrame, run_ts: Column) -> DataFrame:
    b = batch.withColumn("updated_at", run_ts).withColumn("status", F.coalesce(F.col("status"), F.lit("pending")))
    replaced = ["client_id", "order_date", "city", "address", "payment_method", "total", "status", "source_session_id"]
    rules = {c: F.col(f"s.{c}") for c in replaced}
    rules["created_at"] = F.col("t.created_at")
    rules["updated_at"] = run_ts
    return _upsert(target, b, rules, S.ORDERS_SCHEMA.names)


def upsert_products(target: DataFrame, batch: DataFrame, run_ts: Column) -> DataFrame:
    b = batch.withColumn("created_at", run_ts)
    rules = {"name": F.col("s.name"), "variant": F.col("s.variant"), "created_at": F.col("t.created_at")}
    return _upsert(target, b, rules, S.PRODUCTS_SCHEMA.names)


def valid_items(items: DataFrame) -> DataFrame:
    """Items with a product name (NULL and '' are skipped by the loader)."""
    return items.filter(F.coalesce(F.col("product_name"), F.lit("")) != "")


def upsert_items(target: DataFrame, batch: DataFrame, run_ts: Column) -> DataFrame:
    """Six columns replaced; ``product_id`` is never written by a load; quantity defaults to 1."""
    b = (
        valid_items(batch)
        .withColumn("created_at", run_ts)
        .withColumn("product_id", F.lit(None).cast("string"))
        .withColumn("quantity", F.coalesce(F.col("quantity"), F.lit(1)))
    )
    replaced = ["order_id", "product_name", "variant", "quantity", "unit", "unit_price"]
    rules = {c: F.col(f"s.{c}") for c in replaced}
    rules["product_id"] = F.col("t.product_id")
    rules["created_at"] = F.col("t.created_at")
    return _upsert(target, b, rules, S.ORDER_ITEMS_SCHEMA.names)


def resolve_product_ids(items: DataFrame, products: DataFrame) -> DataFrame:
    """product_id = the catalogue row with the same name and the same variant (NULL matches
    NULL); several matches -> the smallest id.  The null-safe key stays an equi-join key."""
    one = products.groupBy("name", "variant").agg(F.min("id").alias("_pid"))
    j = items.join(
        one,
        (items["product_name"] == one["name"]) & items["variant"].eqNullSafe(one["variant"]),
        "left",
    )
    return j.select(*[F.col("_pid").alias("product_id") if c == "product_id" else items[c] for c in items.columns])


LOOKUP_SPREAD = 1 << 12  # keys over which rows without a number are dealt out


def clients_by_phone(clients: DataFrame, lookups: DataFrame, phone_col: str = "phone", digits_match: bool = True) -> DataFrame:
    """For each lookup phone: the first client (by created_at, id) with that phone, or NULLs.

    ``digits_match`` also matches '+57300…' to '57300…' (bot input is digits only).  A NULL looks up nothing.
    """
    key = F.regexp_replace("phone", r"[^\p{Nd}]", "") if digits_match else F.col("phone")
    one = (
        clients.filter(F.col("phone").isNotNull())
        .withColumn("_k", key)
        .groupBy("_k")
        .agg(F.min_by(F.struct("id", "name"), F.struct("created_at", "id")).alias("_c"))
    )
    lk = F.regexp_replace(phone_col, r"[^\p{Nd}]", "") if digits_match else F.col(phone_col)
    # Rows that look up no number (NULL) match nothing; they are dealt out over many keys, where the one key NULL would
    # send them all to one task.
    spread = F.pmod(F.xxhash64(*[F.col(c) for c, kind in lookups.dtypes if "map<" not in kind and "variant" not in kind]), F.lit(LOOKUP_SPREAD))
    lk = F.coalesce(F.concat(F.lit("="), lk), F.concat(F.lit("-"), spread.cast("string")))
    one = one.select(F.concat(F.lit("="), F.col("_k")).alias("_k"), "_c")
    j = lookups.withColumn("_lk", lk).join(one, F.col("_lk") == F.col("_k"), "left")
    return j.select(
        *[F.col(c) for c in lookups.columns],
        F.col("_c.id").alias("client_id"),
        F.col("_c.name").alias("client_name"),
        F.col("_c.id").isNotNull().alias("found"),
    )


def propagate_deletes(
    clients: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    items: DataFrame,
    deleted_clients: DataFrame,
    deleted_orders: DataFrame,
    deleted_products: DataFrame,
) -> dict[str, DataFrame]:
    """ON DELETE SET NULL / CASCADE rules: orders lose a deleted client, items of a deleted
    order go, items lose a deleted product.  Delete lists are single-column ``id`` frames."""
    dc = deleted_clients.select(F.col("id").alias("_dc")).distinct()
    do = deleted_orders.select(F.col("id").alias("_do")).distinct()
    dp = deleted_products.select(F.col("id").alias("_dp")).distinct()
    new_clients = clients.join(dc, clients["id"] == dc["_dc"], "left_anti")
    o = orders.join(dc, orders["client_id"] == dc["_dc"], "left")
    o = o.withColumn("client_id", F.when(F.col("_dc").isNull(), F.col("client_id"))).drop("_dc")
    new_orders = o.join(do, o["id"] == do["_do"], "left_anti")
    new_products = products.join(dp, products["id"] == dp["_dp"], "left_anti")
    i = items.join(do, items["order_id"] == do["_do"], "left_anti")
    i = i.join(dp, i["product_id"] == dp["_dp"], "left")
    i = i.withColumn("product_id", F.when(F.col("_dp").isNull(), F.col("product_id"))).drop("_dp")
    return {"clients": new_clients, "orders": new_orders, "products": new_products, "order_items": i}


def quality_report(clients: DataFrame, orders: DataFrame, products: DataFrame, items: DataFrame) -> DataFrame:
    """One row per constraint rule of the mart DDL with its violation count.

    Each table is scanned once.  A row gives a fact for every key it holds or refers to, and one
    for every rule that it breaks by itself; facts are counted per (kind, key) with a partial
    aggregation, so a hot key is a few combiner rows.  A key held more than once is a duplicate, a
    key referred to and not held makes its references orphans.
    """
    lim = S.MART_STRING_LIMITS

    def too_long(table: str) -> dict[str, Column]:
        return {f"{table}.{c}_too_long": F.length(c) > n for c, n in lim[table].items()}

    def fact(kind: str, key: Column, held: int, refers: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.lit(held).alias("held"), F.lit(refers).alias("refers"))

    def holds(kind: str, key: Column) -> Column:  # NULLs never collide in a UNIQUE constraint
        return F.when(key.isNotNull(), fact(kind, key, 1, 0))

    def refers(kind: str, key: Column) -> Column:
        return F.when(key.isNotNull(), fact(kind, key, 0, 1))

    def facts(df: DataFrame, keys: list[Column], broken: dict[str, Column]) -> DataFrame:
        own = [F.when(c, fact(rule, F.lit(None).cast("string"), 0, 1)) for rule, c in broken.items()]
        return df.select(F.inline(F.filter(F.array(*keys, *own), lambda x: x.isNotNull())))

    col = F.col
    name_variant = F.when(col("name").isNotNull() & col("variant").isNotNull(), F.to_json(F.array("name", "variant")))
    broken = {
        "clients": {"clients.source_client_id_null": col("source_client_id").isNull(), "clients.id_null": col("id").isNull()} | too_long("clients"),
        "orders": {"orders.id_null": col("id").isNull(), "orders.status_domain": ~col("status").isin(*S.ORDER_STATUSES)}
        | too_long("orders")
        | {"orders.total_out_of_range": F.abs(col("total")) >= F.lit(10**10)},
        "products": {"products.name_null": col("name").isNull()} | too_long("products"),
        "order_items": {"order_items.product_name_null": col("product_name").isNull()} | too_long("order_items"),
    }
    keys = {
        "clients": [holds("clients.id", col("id")), holds("clients.source_client_id", col("source_client_id"))],
        "orders": [holds("orders.id", col("id")), refers("clients.id", col("client_id"))],
        "products": [holds("products.id", col("id")), holds("products.name_variant", name_variant)],
        "order_items": [holds("order_items.id", col("id")), refers("orders.id", col("order_id")), refers("products.id", col("product_id"))],
    }
    tables = {"clients": clients, "orders": orders, "products": products, "order_items": items}
    parts = [facts(df, keys[t], broken[t]) for t, df in tables.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    per_key = every.groupBy("kind", "key").agg(F.sum("held").alias("held"), F.sum("refers").alias("refers"))
    orphans = {"clients.id": "orders.client_id_orphan", "orders.id": "order_items.order_id_orphan", "products.id": "order_items.product_id_orphan"}
    found = per_key.groupBy("kind").agg(
        F.count_if(col("held") > 1).alias("duplicates"),
        F.sum(F.when(col("held") == 0, col("refers")).otherwise(0)).alias("loose"),
    )
    # The rules, fixed and few: those that nothing breaks are reported with 0.
    rules = [(r, r, False) for t in broken for r in broken[t]]
    rules += [(f"{k}_duplicate", k, True) for k in ("clients.id", "clients.source_client_id", "orders.id", "products.id", "products.name_variant", "order_items.id")]
    rules += [(rule, k, False) for k, rule in orphans.items()]
    wanted = clients.sparkSession.createDataFrame(rules, "rule string, kind string, duplicate boolean")
    count = F.when(col("duplicate"), col("duplicates")).otherwise(col("loose"))
    return wanted.join(found, "kind", "left").select("rule", F.coalesce(count, F.lit(0)).cast("bigint").alias("violations"))


def latest_open_order(orders: DataFrame) -> DataFrame:
    """Per client, the id of the latest open (pending/confirmed) order by (order_date, created_at, id)."""
    open_ = orders.filter(F.col("client_id").isNotNull() & F.col("status").isin("pending", "confirmed"))
    return open_.groupBy("client_id").agg(
        F.max_by("id", F.struct(F.coalesce("order_date", F.lit("0001-01-01").cast("date")), "created_at", "id")).alias("order_id")
    )


def mark_delivered(orders: DataFrame, clients_ids: DataFrame | None, run_ts: Column) -> DataFrame:
    """Set the latest open order of each given client (all clients if None) to 'delivered'."""
    latest = latest_open_order(orders)
    if clients_ids is not None:
        latest = latest.join(clients_ids.select(F.col("id").alias("client_id")).distinct(), "client_id", "left_semi")
    hit = latest.select(F.col("order_id").alias("_hit"))
    j = orders.join(hit, orders["id"] == hit["_hit"], "left")
    changed = F.col("_hit").isNotNull()
    return j.select(
        *[
            F.when(changed, F.lit("delivered")).otherwise(F.col("status")).alias("status")
            if c == "status"
            else F.when(changed, run_ts).otherwise(F.col("updated_at")).alias("updated_at")
            if c == "updated_at"
            else F.col(c)
            for c in orders.columns
        ]
    )


__all__ = [
    "dedupe_last",
    "upsert_clients",
    "upsert_orders",
    "upsert_products",
    "upsert_items",
    "valid_items",
    "resolve_product_ids",
    "clients_by_phone",
    "propagate_deletes",
    "quality_report",
    "mark_delivered",
    "latest_open_order",
]
