"""K8: load the exported JSON tables into the mart, as a new version of its Parquet tables.

A load reads ``clients.json``, ``orders.json``, ``products.json`` and ``order_items.json`` (each a JSON
array), casts their text, upserts each batch into the version before and writes the new version into
a folder of its own.  A load that is run again writes the same tables; one that is lost leaves the
version before as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger import schemas as S
from chatledger.functions import text as X
from chatledger.operators import mart as MT
from chatledger.sources.jsonl import read_json_table

UPSERTS = {"clients": MT.upsert_clients, "orders": MT.upsert_orders, "products": MT.upsert_products, "order_items": MT.upsert_items}
# What a load does not write: the upsert sets them.
NOT_LOADED = {"clients": {"updated_at"}, "orders": {"updated_at"}, "products": {"created_at"}, "order_items": {"product_id", "created_at"}}
LENIENT = (T.DateType, T.TimestampNTZType)  # text that is none becomes NULL, any other value that does not fit rejects its row


def _typed(name: str, kind: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(kind, T.DateType):
        return X.parse_date_lenient(name)
    if isinstance(kind, T.TimestampNTZType):
        return X.parse_iso_timestamp(name)
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.DecimalType):
        return c.try_cast("decimal(38,6)").try_cast(kind)
    return c.try_cast("decimal(38,6)").try_cast(kind)


def typed_batch(raw: DataFrame, table: str) -> DataFrame:
    """The batch in the mart's types, with ``_reject``: why the row cannot be loaded, else NULL.

    A row without an id, and one with a number that its column cannot hold or a text longer than it,
    is rejected; items without a product name are skipped.  ``_seq`` keeps the order of the rows."""
    loaded = [f for f in S.MART_SCHEMAS[table].fields if f.name not in NOT_LOADED[table]]
    reason = F.when(F.col("id").isNull(), F.lit("no id"))
    if table == "order_items":
        reason = reason.when(F.coalesce("product_name", F.lit("")) == "", F.lit("no product name"))
    for f in loaded:
        limit = S.MART_STRING_LIMITS[table].get(f.name)
        if limit:
            reason = reason.when(F.length(f.name) > limit, F.lit(f"{f.name} too long"))
        if not isinstance(f.dataType, (T.StringType, *LENIENT)):
            reason = reason.when(F.col(f.name).isNotNull() & _typed(f.name, f.dataType).isNull(), F.lit(f"{f.name} out of range"))
    return raw.select(reason.alias("_reject"), F.monotonically_increasing_id().alias("_seq"), *[_typed(f.name, f.dataType).alias(f.name) for f in loaded])


def read_batch(spark: SparkSession, json_dir: str, table: str) -> DataFrame:
    names = [f.name for f in S.MART_SCHEMAS[table].fields if f.name not in NOT_LOADED[table]]
    raw = read_json_table(spark, f"{json_dir}/{table}.json", T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return typed_batch(raw, table)


def load_mart(spark: SparkSession, json_dir: str, new_dir: str, old_dir: str | None = None, run_ts: Column | None = None) -> dict[str, dict[str, int]]:
    """Write the next version of the mart under ``new_dir``; ``old_dir`` is the version before (none: empty).

    Rows not loaded are written to ``new_dir/rejects/<table>`` with their reason.  Of rows with one id
    the last wins.  Returns (loaded, rejected) counts per table."""
    if old_dir is not None and old_dir.rstrip("/") == new_dir.rstrip("/"):
        raise ValueError("a new version needs a folder of its own")
    # One time for the whole load, and for its retries.
    run_ts = F.lit(spark.sql("SELECT CAST(current_timestamp() AS TIMESTAMP_NTZ)").first()[0]).cast("timestamp_ntz") if run_ts is None else run_ts
    counts = {}
    for table, upsert in UPSERTS.items():
        schema = S.MART_SCHEMAS[table]
        staged = f"{new_dir}/staged/{table}"
        read_batch(spark, json_dir, table).write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged)
        good, bad = rows.filter(F.col("_reject").isNull()).drop("_reject"), rows.filter(F.col("_reject").isNotNull())
        bad.drop("_seq").write.mode("overwrite").parquet(f"{new_dir}/rejects/{table}")
        batch = MT.dedupe_last(good, "id", ["_seq"]).drop("_seq")
        if table in ("clients", "orders"):
            batch = batch.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
        target = spark.read.schema(schema).parquet(f"{old_dir}/{table}") if old_dir else spark.createDataFrame([], schema)
        upsert(target, batch, run_ts).write.mode("overwrite").parquet(f"{new_dir}/{table}")
        n = rows.agg(F.count_if(F.col("_reject").isNull()).alias("loaded"), F.count_if(F.col("_reject").isNotNull()).alias("rejected")).first()
        counts[table] = n.asDict()
    return counts
