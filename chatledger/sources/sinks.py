"""Writers for each stage's outputs (K1-K7).  All are plain DataFrame writes; the layout
is JSON lines / CSV / Parquet folders rather than single local files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# The export's columns.
SALES_COLUMNS = [
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
    "approx_total",
    "products",
]


def write_messages(msgs: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1 / K2: the message table as Parquet, or CSV with a header (newlines stay quoted)."""
    w = msgs.write.mode(mode)
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.option("header", "true").option("escape", '"').option("quoteAll", "false").csv(path)


def write_sessions(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one JSON object per session, UTF-8, NULL fields written explicitly, in order of
    conversation and session (as text): part files follow each other in that order (L2)."""
    records = records.orderBy("conversation_id", "session_id")
    records.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_results(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: extractor results as JSON lines (the response object plus metadata keys).  A response
    that is no object becomes an error line."""
    is_object = F.coalesce(F.schema_of_variant("result").startswith("OBJECT"), F.lit(False))
    error = F.when(F.col("result").isNotNull(), F.coalesce("error", F.lit("response is not an object"))).otherwise(F.col("error"))
    line = F.when(is_object, F.to_json(F.col("result"))).otherwise(F.to_json(F.struct(error.alias("error"))))
    meta = F.to_json(
        F.struct(
            F.col("session_id").alias("_session_id"),
            F.col("conversation_id").alias("_conversation_id"),
            F.col("client_id").alias("_client_id"),
        )
    )
    # splice the metadata keys into the object: '{...' + ',' + '"_session_id":...}'
    ln = F.col("line")
    body = F.expr("substring(meta, 2)")
    merged = F.when(ln == "{}", F.concat(F.lit("{"), body)).otherwise(
        F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit(","), body)
    )
    results.select(line.alias("line"), meta.alias("meta")).select(merged.alias("value")).write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5 / K7: JSON lines (one object per row)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_sales_csv(sales: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: the 13 named columns, header, NULL written as an empty field."""
    sales.select(*SALES_COLUMNS).write.mode(mode).option("header", "true").option("nullValue", "").option("emptyValue", "").csv(path)


def write_results_table(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parsed extractor results as Parquet with a ``VARIANT`` column: responses are parsed
    once here, and every later stage reads binary variants instead of re-parsing JSON."""
    results.select("session_id", "conversation_id", "client_id", "result", "error").write.mode(mode).parquet(path)


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows that ``write`` wrote of ``df``, counted while they are written."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def export_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """K7: each table as JSON lines under ``folder``; the rows written of each."""
    return {name: counted(df, lambda d, n=name: write_json(d, f"{folder}/{n}")) for name, df in tables.items()}
