"""Mart views and statistics (A6-A11) kept up to date by the changes of each load.

A change is a row of a mart table before a load (``sign`` -1) or after it (+1).  ``contributions`` aggregates changes into
signed rows of a few stored tables: sums and counts, and multisets where a sum does not do (dates for ``MAX``, orders for a
distinct count), so a deleted row takes back exactly what it gave.  A load writes its contributions as one version
(``sources/versioned.py``): its work grows with the rows it changes, and a load recorded again changes nothing.  Views add the
versions up; ``compact`` writes them as one.  Loads are numbered upwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger import schemas as S
from chatledger.sources import versioned as V

MONEY = "decimal(22,2)"
# Stored tables: keys, then the measures that add up; a key whose first measure is 0 is gone.
STORED = {
    "client_orders": (["client_id"], {"n": "bigint", "amount": MONEY}),
    "client_dates": (["client_id", "order_date"], {"n": "bigint"}),
    "days": (["order_date"], {"n": "bigint", "amount": MONEY}),
    "products": (["product_name", "variant"], {"n": "bigint", "quantity": "bigint", "with_quantity": "bigint"}),
    "product_orders": (["product_name", "variant", "order_id"], {"n": "bigint"}),
    "tables": (["table_name"], {"n": "bigint", "amount": MONEY}),
}
KEY_TYPES = {"order_date": "date"}
DDL = {t: ", ".join([f"{k} {KEY_TYPES.get(k, 'string')}" for k in keys] + [f"{m} {kind}" for m, kind in sums.items()]) for t, (keys, sums) in STORED.items()}


def whole(table: DataFrame) -> DataFrame:
    """A table that was empty before: every row is new."""
    return table.withColumn("sign", F.lit(1))


def changes(before: DataFrame, after: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a table whose id is in ``ids`` (the ids a load may have touched; one column ``id``), as they were and are."""
    ids = ids.select("id").distinct()
    old = before.join(ids, "id", "left_semi").withColumn("sign", F.lit(-1))
    return old.unionByName(after.join(ids, "id", "left_semi").withColumn("sign", F.lit(1)))


def touched(before: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a table that a load of ``ids`` may change: an upsert of these alone gives the same changes as one of the whole table."""
    return before.join(ids.select("id").distinct(), "id", "left_semi").select(*before.columns)


def deleted_ids(orders: DataFrame, items: DataFrame, deleted_clients: DataFrame, deleted_orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids of the orders and items that ``mart.propagate_deletes`` changes where the views see it."""
    do, dc = deleted_orders.select("id").distinct(), deleted_clients.select(F.col("id").alias("client_id")).distinct()
    o = do.unionByName(orders.join(dc, "client_id", "left_semi").select("id"))
    return o, items.join(do.withColumnRenamed("id", "order_id"), "order_id", "left_semi").select("id")


def _add_up(rows: DataFrame, table: str) -> DataFrame:
    keys, sums = STORED[table]
    return rows.groupBy(*keys).agg(*[F.sum(m).cast(kind).alias(m) for m, kind in sums.items()])


def contributions(**changed: DataFrame) -> dict[str, DataFrame]:
    """Signed rows of the stored tables from the changes of ``clients``, ``orders``, ``products`` and ``order_items``
    (any of them may be left out)."""
    sign, out = F.col("sign").cast("bigint"), {}
    money = F.coalesce("total", F.lit(0).cast("decimal(12,2)")) * F.col("sign")
    if (o := changed.get("orders")) is not None:
        o = o.select("client_id", "order_date", sign.alias("n"), money.alias("amount"))
        with_client, with_date = F.col("client_id").isNotNull(), F.col("order_date").isNotNull()
        out["client_orders"] = _add_up(o.filter(with_client), "client_orders")
        out["client_dates"] = _add_up(o.filter(with_client & with_date), "client_dates")
        out["days"] = _add_up(o.filter(with_date), "days")
    if (i := changed.get("order_items")) is not None:
        i = i.filter(F.col("product_name") != "")
        quantity = F.coalesce(F.col("quantity").cast("bigint"), F.lit(0)) * sign
        has = F.when(F.col("quantity").isNotNull(), sign).otherwise(0)
        i = i.select("product_name", "variant", "order_id", sign.alias("n"), quantity.alias("quantity"), has.alias("with_quantity"))
        out["products"] = _add_up(i, "products")
        out["product_orders"] = _add_up(i.filter(F.col("order_id").isNotNull()), "product_orders")
    counts = None
    for name, df in changed.items():
        amount = F.sum(money) if name == "orders" else F.lit(0)
        n = df.agg(F.coalesce(F.sum(sign), F.lit(0)).alias("n"), F.coalesce(amount, F.lit(0)).cast(MONEY).alias("amount"))
        n = n.select(F.lit(name).alias("table_name"), "n", "amount")
        counts = n if counts is None else counts.unionByName(n)
    return out | {"tables": counts}


def record(root: str, load_no: int, contributed: dict[str, DataFrame]) -> bool:
    """Store a load's contributions; False if this load, or a later one, is there already."""
    spark = next(iter(contributed.values())).sparkSession
    done = V.committed(spark, root)
    if done and load_no <= done[-1]:
        return False
    rows = {t: contributed[t] if t in contributed else spark.createDataFrame([], DDL[t]) for t in STORED}
    return V.write_version(root, load_no, rows)


def record_load(spark: SparkSession, root: str, load_no: int, new_dir: str, old_dir: str | None = None) -> bool:
    """Store the changes that ``load.load_mart`` made to get from ``old_dir`` to ``new_dir``: only rows of its batch count."""
    changed = {}
    for table, schema in S.MART_SCHEMAS.items():
        after = spark.read.schema(schema).parquet(f"{new_dir}/{table}")
        if old_dir is None:
            changed[table] = whole(after)
            continue
        batch = spark.read.parquet(f"{new_dir}/staged/{table}").filter(F.col("_reject").isNull())
        changed[table] = changes(spark.read.schema(schema).parquet(f"{old_dir}/{table}"), after, batch.select("id"))
    return record(root, load_no, contributions(**changed))


def merged(*runs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The stored tables that several loads' contributions add up to."""
    out = {}
    for t in STORED:
        rows = [r[t] for r in runs if t in r]
        if not rows:
            continue
        every = rows[0]
        for r in rows[1:]:
            every = every.unionByName(r)
        total = _add_up(every, t)
        out[t] = total if t == "tables" else total.filter(F.col("n") != 0)
    return out


def stored(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return merged({t: V.read_table(spark, root, t, DDL[t]).drop("version") for t in STORED})


def compact(spark: SparkSession, root: str, new_root: str) -> bool:
    """All versions as one, under ``new_root``, numbered as the last: later loads go on there."""
    return V.write_version(new_root, V.committed(spark, root)[-1], stored(spark, root))


# ---------------------------------------------------------------------------
# the views, from the stored tables
# ---------------------------------------------------------------------------
def client_summary(clients: DataFrame, st: dict[str, DataFrame]) -> DataFrame:
    last = st["client_dates"].groupBy("client_id").agg(F.max("order_date").alias("last_order_date"))
    per = st["client_orders"].join(last, "client_id", "left")
    j = clients.select("id", "name", "phone").join(per, F.col("id") == F.col("client_id"), "left")
    amount = F.coalesce("amount", F.lit(0).cast(MONEY)).alias("total_spent")
    return j.select("id", "name", "phone", F.coalesce("n", F.lit(0)).alias("total_orders"), amount, "last_order_date")


def daily_summary(st: dict[str, DataFrame]) -> DataFrame:
    return st["days"].select("order_date", F.col("n").alias("orders"), F.col("amount").alias("revenue"))


def sales_by_month(st: dict[str, DataFrame]) -> DataFrame:
    per = st["days"].groupBy(F.trunc("order_date", "month").alias("month"))
    return per.agg(F.sum("n").alias("total_orders"), F.sum("amount").cast(MONEY).alias("total_revenue")).orderBy(F.col("month").desc())


def _quantity() -> F.Column:
    return F.when(F.sum("with_quantity") > 0, F.sum("quantity"))


def top_products(st: dict[str, DataFrame]) -> DataFrame:
    of = ["product_name", "variant"]
    orders = st["product_orders"].groupBy(*of).agg(F.count(F.lit(1)).alias("order_count"))
    sums = st["products"].groupBy(*of).agg(_quantity().alias("total_quantity"))
    # NULL variants are a group too, so the two meet by a union and not by a join.
    none = F.lit(None).cast("bigint")
    both = sums.withColumn("order_count", none).unionByName(orders.withColumn("total_quantity", none))
    out = both.groupBy(*of).agg(F.max("total_quantity").alias("total_quantity"), F.coalesce(F.max("order_count"), F.lit(0)).alias("order_count"))
    return out.orderBy(F.col("total_quantity").desc_nulls_first())


def best_product(st: dict[str, DataFrame]) -> DataFrame:
    per = st["products"].groupBy("product_name").agg(_quantity().alias("total_qty"))
    return per.orderBy(F.col("total_qty").desc_nulls_first(), "product_name").limit(1)


def table_counts(st: dict[str, DataFrame]) -> DataFrame:
    return st["tables"].select("table_name", F.col("n").alias("rows"))


def total_sales(st: dict[str, DataFrame]) -> DataFrame:
    return st["tables"].filter(F.col("table_name") == "orders").select(F.col("amount").alias("total_sales"))
