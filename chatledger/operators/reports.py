"""Mart views and statistics (client summary, orders with client, sales by month, top
products, counts, totals) and the bot's report commands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _money_sum(c: str) -> F.Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("decimal(22,2)"))


def client_summary(clients: DataFrame, orders: DataFrame) -> DataFrame:
    """Per client: order count, COALESCE(SUM(total), 0), last order date; clients without
    orders included.  Orders are aggregated per client *before* the join (partial
    aggregation; the join then sees one row per client on each side)."""
    per = orders.filter(F.col("client_id").isNotNull()).groupBy("client_id").agg(
        F.count("id").alias("total_orders"),
        F.sum("total").alias("_spent"),
        F.max("order_date").alias("last_order_date"),
    )
    j = clients.join(per, clients["id"] == per["client_id"], "left")
    return j.select(
        clients["id"],
        clients["name"],
        clients["phone"],
        F.coalesce(F.col("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.col("_spent"), F.lit(0).cast("decimal(22,2)")).alias("total_spent"),
        F.col("last_order_date"),
    )


def orders_with_client(orders: DataFrame, clients: DataFrame) -> DataFrame:
    c = clients.select(F.col("id").alias("_cid"), F.col("name").alias("client_name"), F.col("phone").alias("client_phone"))
    j = orders.join(c, orders["client_id"] == c["_cid"], "left")
    return j.select(
        F.col("id").alias("order_id"),
        "order_date",
        "city",
        "address",
        "payment_method",
        "total",
        "status",
        "client_name",
        "client_phone",
    )


def sales_by_month(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("order_date").isNotNull())
        .groupBy(F.trunc("order_date", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("total_orders"), _money_sum("total").alias("total_revenue"))
        .orderBy(F.col("month").desc())
    )


def top_products(items: DataFrame) -> DataFrame:
    """Quantity and distinct orders per (name, variant); NULL variant is its own group;
    quantity descending with NULLs first (the SQL engine's DESC default)."""
    return (
        items.filter(F.col("product_name").isNotNull() & (F.col("product_name") != ""))
        .groupBy("product_name", "variant")
        .agg(F.sum("quantity").alias("total_quantity"), F.countDistinct("order_id").alias("order_count"))
        .orderBy(F.col("total_quantity").desc_nulls_first())
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = r if out is None else out.unionByName(r)
    return out


def total_sales(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("total").isNotNull()).agg(_money_sum("total").alias("total_sales"))


def best_product(items: DataFrame) -> DataFrame:
    """Best-selling product name (sum of quantity); ties broken by name."""
    return (
        items.filter(F.col("product_name") != "")
        .groupBy("product_name")
        .agg(F.sum("quantity").alias("total_qty"))
        .orderBy(F.col("total_qty").desc_nulls_first(), F.col("product_name"))
        .limit(1)
    )


def daily_summary(orders: DataFrame, day: str | None = None) -> DataFrame:
    """Orders and revenue of one day (``day`` = 'YYYY-MM-DD'); every day when None."""
    o = orders.filter(F.col("order_date").isNotNull())
    if day is not None:
        o = o.filter(F.col("order_date") == F.lit(day).cast("date"))
    return o.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"), _money_sum("total").alias("revenue"))


def recent_clients(clients: DataFrame, n: int = 10) -> DataFrame:
    return clients.orderBy(F.col("created_at").desc_nulls_last(), F.col("id")).limit(n)


def client_month(orders: DataFrame, client_id: str | None = None, month: str | None = None) -> DataFrame:
    """Orders and total per (client, month); restricted to one client / month when given."""
    o = orders.filter(F.col("client_id").isNotNull() & F.col("order_date").isNotNull())
    if client_id is not None:
        o = o.filter(F.col("client_id") == client_id)
    m = F.date_format("order_date", "yyyy-MM")
    if month is not None:
        o = o.filter(m == month)
    return o.groupBy("client_id", m.alias("month")).agg(F.count(F.lit(1)).alias("orders"), _money_sum("total").alias("total"))
