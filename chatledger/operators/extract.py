"""Session extraction: the pluggable extractor job and the native rule extractor.

``run_extractor`` sends whole transcripts to any user-supplied function inside
``mapInPandas`` (bounded concurrency per task, retry with exponential back-off on rate
limits, failures become error rows).  The default extractor needs no Python at all: the
rules below are Column expressions and per-session aggregates, so they run inside
whole-stage code generation and aggregate partially before any shuffle.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger import schemas as S
from chatledger.functions import rules as RU
from chatledger.functions import text as X
from chatledger.functions.dates import mentioned_date
from chatledger.operators.messages import BUCKET_US
from chatledger.operators.sessions import exportable
from chatledger.session import ship_package

SIGNAL_NAMES = ["intent", "product_qty", "delivery", "payment", "followup", "cancel", "info"]


# ---------------------------------------------------------------------------
# per-message features
# ---------------------------------------------------------------------------
def message_features(msgs: DataFrame) -> DataFrame:
    """Exportable messages with folded text, signal flags and vocabulary hits."""
    ex = exportable(msgs).withColumn("_f", RU.folded(F.col("text")))
    f = F.col("_f")
    cols = [RU.signal(n, f).alias(n) for n in SIGNAL_NAMES + ["question"]]
    return ex.select(
        "*",
        *cols,
        RU.term(RU.PAYMENT_TERMS, f).alias("payment_term"),
        f.rlike(RU.GENERIC_TRANSFER[0]).alias("generic_transfer"),
        RU.term(RU.CITY_TERMS, f).alias("city_term"),
        F.when(f.contains("total"), X.blank_to_null(F.regexp_extract("text", RU.AMOUNT, 1))).alias("amount_text"),
        X.blank_to_null(F.regexp_extract("text", RU.NAME_INTRO, 1)).alias("intro_name"),
        mentioned_date(f, F.col("sent_at")).alias("named_date"),
    )


def next_in_order(df: DataFrame, part: list[str], bucket: Column, order: list[str], cols: list[str], prefix: str = "next_") -> DataFrame:
    """``lead`` of ``cols`` within ``part`` ordered by ``order`` without a window spanning
    the whole partition: a window per (part, bucket) plus, for the last row of a bucket,
    the first row of the next non-empty bucket from a small per-bucket summary."""
    d = df.withColumn("_b", bucket)
    wb = Window.partitionBy(*part, "_b").orderBy(*order)
    within = d.select(
        "*",
        *[F.lead(c).over(wb).alias(prefix + c) for c in cols],
        F.lead(F.lit(1)).over(wb).isNull().alias("_lastb"),
    )
    firsts = d.groupBy(*part, "_b").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
    wn = Window.partitionBy(*part).orderBy("_b")
    nxt = firsts.select(*part, "_b", F.lead("_first").over(wn).alias("_nb"))
    j = within.join(nxt, part + ["_b"], "left")
    return j.select(
        *df.columns,
        *[F.when(F.col("_lastb"), F.col("_nb")[c]).otherwise(F.col(prefix + c)).alias(prefix + c) for c in cols],
    )


def _bucket(ts: str) -> Column:
    return F.floor(X.epoch_micros(ts) / F.lit(BUCKET_US))


# ---------------------------------------------------------------------------
# F19 product mentions
# ---------------------------------------------------------------------------
def product_mentions(feats: DataFrame) -> DataFrame:
    """One row per product mention: canonical name, catalogue variant, quantity, unit."""
    m = feats.select(
        "conversation_id",
        "session_id",
        "message_index",
        # what follows each mention, up to the next one
        F.split("_f", RU.PRODUCT_MENTION).alias("_between"),
        F.posexplode(F.regexp_extract_all("_f", F.lit(RU.PRODUCT_MENTION), 0)).alias("pos", "mention"),
    )
    alias = F.regexp_extract("mention", "([a-z]+)$", 1)
    name = RU.alias_name(alias)
    return m.select(
        "conversation_id",
        "session_id",
        "message_index",
        "pos",
        "mention",
        name.alias("name"),
        RU.resolve_variant(name, F.get("_between", F.col("pos") + 1)).alias("variant"),
        X.blank_to_null(F.regexp_extract("mention", "^([0-9]+)", 1)).try_cast("bigint").alias("quantity"),
        X.blank_to_null(F.regexp_extract("mention", "^[0-9]+ (caja|paquete)", 1)).alias("unit"),
    )


# ---------------------------------------------------------------------------
# F20, F21, F23, F24 session facts
# ---------------------------------------------------------------------------
def _first_by_index(c: Column) -> Column:
    return F.min_by(c, F.when(c.isNotNull(), F.col("message_index")))


def session_facts(feats: DataFrame) -> DataFrame:
    """One row per session with signal flags, order type, mentions and sale state."""
    g = feats.groupBy("conversation_id", "session_id").agg(
        F.min_by("client_id", "message_index").alias("client_id"),
        *[F.bool_or(n).alias(n) for n in SIGNAL_NAMES],
        F.coalesce(
            _first_by_index(F.col("payment_term")),
            F.when(F.bool_or("generic_transfer"), F.lit(RU.GENERIC_TRANSFER[1])),
        ).alias("payment_method"),
        _first_by_index(F.col("city_term")).alias("city"),
        _first_by_index(F.when(F.col("delivery"), F.col("text"))).alias("address"),
        _first_by_index(F.col("amount_text")).alias("_amount"),
        _first_by_index(F.col("named_date")).alias("order_date"),
        _first_by_index(F.when(F.col("role") == S.ROLE_USER, F.col("intro_name"))).alias("customer_name"),
    )
    c = {n: F.col(n) for n in SIGNAL_NAMES}
    order_type = (
        F.when(c["cancel"], F.lit("cancelled"))
        .when(c["followup"], F.lit("delivery_followup"))
        .when(c["intent"] | c["product_qty"] | c["delivery"] | c["payment"], F.lit("confirmed"))
        .when(c["info"], F.lit("quotation"))
        .otherwise(F.lit("unclear"))
    )
    sale_signs = ~c["cancel"] & (c["intent"] | c["product_qty"] | c["delivery"] | c["payment"] | c["followup"])
    estado = F.when(sale_signs & (c["followup"] | (c["delivery"] & c["payment"])), F.lit("confirmada")).when(sale_signs, F.lit("probable"))
    return g.select(
        "*",
        order_type.alias("order_type"),
        # any of the five conditions, whatever became of the order
        (c["intent"] | c["product_qty"] | c["delivery"] | c["payment"] | c["followup"]).alias("has_order"),
        estado.alias("sale_state"),
        X.money_text_to_number(F.col("_amount")).alias("approx_total"),
        F.when(F.col("client_id").rlike(RU.PHONE_LIKE), F.col("client_id")).alias("customer_phone"),
    ).drop("_amount")


# ---------------------------------------------------------------------------
# F22 FAQ pairs
# ---------------------------------------------------------------------------
def faq_pairs(feats: DataFrame) -> DataFrame:
    """A client question answered by the very next exported message, from the business."""
    nx = next_in_order(
        feats.select("conversation_id", "session_id", "message_index", "sent_at", "role", "text", "question", "_f"),
        ["conversation_id"],
        _bucket("sent_at"),
        ["sent_at", "message_index"],
        ["session_id", "role", "text"],
    )
    q = nx.filter(
        (F.col("role") == S.ROLE_USER)
        & F.col("question")
        & (F.col("next_role") == S.ROLE_ASSISTANT)
        & (F.col("next_session_id") == F.col("session_id"))
    )
    return q.select(
        "session_id",
        F.col("message_index").alias("pos"),
        F.col("text").alias("pregunta"),
        F.col("next_text").alias("respuesta"),
        RU.faq_category(F.col("_f")).alias("categoria"),
    )


# ---------------------------------------------------------------------------
# X1 / X2 default extractors
# ---------------------------------------------------------------------------
def extract_orders(msgs: DataFrame) -> DataFrame:
    """Order extraction per session: flat facts plus the result JSON in the extractor
    contract (conversation_id, customer, order{...products}) in column ``response``."""
    feats = message_features(msgs)
    facts = session_facts(feats)
    prods = product_mentions(feats).groupBy("session_id").agg(
        F.array_sort(
            F.collect_list(F.struct("message_index", "pos", "name", "variant", "quantity", "unit"))
        ).alias("_p")
    )
    j = facts.join(prods, "session_id", "left")
    products = F.coalesce(
        F.transform(
            "_p",
            lambda p: F.struct(
                p["name"].alias("name"),
                p["variant"].alias("variant"),
                F.lit(None).cast("string").alias("presentation"),
                p["quantity"].alias("quantity_units"),
                p["unit"].alias("unit"),
                F.lit(None).cast("double").alias("unit_price_approx"),
            ),
        ),
        F.array().cast(
            "array<struct<name:string,variant:string,presentation:string,quantity_units:bigint,unit:string,unit_price_approx:double>>"
        ),
    )
    order = F.struct(
        F.col("has_order"),
        F.col("order_type"),
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        F.col("city"),
        F.col("address"),
        F.col("payment_method"),
        F.col("approx_total"),
        products.alias("products"),
    )
    customer = F.struct(F.col("customer_phone").alias("phone"), F.col("customer_name").alias("name"))
    response = F.to_json(
        F.struct(F.col("conversation_id"), customer.alias("customer"), order.alias("order")),
        {"ignoreNullFields": "false"},
    )
    return j.select(
        "session_id",
        "conversation_id",
        "client_id",
        "has_order",
        "order_type",
        "order_date",
        "city",
        "address",
        "payment_method",
        "approx_total",
        "customer_phone",
        "customer_name",
        F.size(products).alias("n_products"),
        response.alias("response"),
    )


def extract_faq(msgs: DataFrame) -> DataFrame:
    """FAQ / sale / client extraction per session (faqs array, venta or NULL, cliente or NULL)."""
    feats = message_features(msgs)
    facts = session_facts(feats)
    pairs = faq_pairs(feats).groupBy("session_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "pregunta", "respuesta", "categoria"))).alias("faqs")
    )
    names = product_mentions(feats).groupBy("session_id").agg(
        F.array_sort(F.collect_list(F.struct("message_index", "pos", X.product_display_name("name", "variant").alias("label")))).alias("_n")
    )
    j = facts.join(pairs, "session_id", "left").join(names, "session_id", "left")
    venta = F.when(
        F.col("sale_state").isNotNull(),
        F.struct(
            F.coalesce(F.transform("_n", lambda e: e["label"]), F.array().cast("array<string>")).alias("productos"),
            F.col("address").alias("direccion"),
            F.col("approx_total").alias("total"),
            F.col("payment_method").alias("metodo_pago"),
            F.col("sale_state").alias("estado"),
        ),
    )
    cliente = F.when(
        F.col("customer_name").isNotNull() | F.col("city").isNotNull(),
        F.struct(
            F.col("customer_name").alias("nombre"),
            F.lit(None).cast("string").alias("telefono"),
            F.col("city").alias("ciudad"),
            F.lit(None).cast("string").alias("notas"),
        ),
    )
    faqs = F.coalesce(F.col("faqs"), F.array().cast("array<struct<pos:bigint,pregunta:string,respuesta:string,categoria:string>>"))
    return j.select("session_id", "conversation_id", "client_id", faqs.alias("faqs"), venta.alias("venta"), cliente.alias("cliente"))


# ---------------------------------------------------------------------------
# A5 and P12 over FAQ results
# ---------------------------------------------------------------------------
def faq_frequency(faq_results: DataFrame) -> DataFrame:
    """``pair_frequency`` of the ``faqs`` arrays of extraction results."""
    ex = faq_results.select("session_id", F.posexplode("faqs").alias("pos", "q"))
    return pair_frequency(ex.select("session_id", "pos", "q.pregunta", "q.respuesta", "q.categoria"))


def pair_frequency(pairs: DataFrame) -> DataFrame:
    """Questions grouped by lower(strip(question)); first seen (session, position) keeps its
    text, answer and category (default 'otro'); ordered by frequency then first seen.

    ``pairs`` are rows as ``faq_pairs`` gives them, so no array per session is built.
    """
    ex = pairs.withColumn("categoria", F.coalesce(F.col("categoria"), F.lit(S.FAQ_DEFAULT_CATEGORY)))
    ex = ex.withColumn("_key", F.lower(X.strip(F.coalesce("pregunta", F.lit("")))))
    g = ex.filter(F.col("_key") != "").groupBy("_key").agg(
        F.count(F.lit(1)).alias("frecuencia"),
        F.min_by(F.struct("pregunta", "respuesta", "categoria"), F.struct("session_id", "pos")).alias("_first"),
        F.min(F.struct("session_id", "pos")).alias("_seen"),
    )
    return g.orderBy(F.col("frecuencia").desc(), F.col("_seen")).select(
        "_first.pregunta", "_first.respuesta", "_first.categoria", "frecuencia"
    )


def sales_detected(faq_results: DataFrame) -> DataFrame:
    return faq_results.filter(F.col("venta").isNotNull()).select(
        "venta.*", F.col("session_id"), F.col("client_id")
    )


def client_notes(faq_results: DataFrame) -> DataFrame:
    return faq_results.filter(F.col("cliente").isNotNull()).select("cliente.*", F.col("client_id"))


# ---------------------------------------------------------------------------
# X1 / X2 pluggable job
# ---------------------------------------------------------------------------
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("conversation_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


FAQ_CONCURRENCY = 10


class RateLimited(Exception):
    """Raise from an extractor to request a retry with back-off."""


def _caller(extractor: Callable[[str], str], max_retries: int, base_delay: float, retry_on_rate_limit: bool) -> Callable[[str], tuple[str | None, str | None]]:
    """One call with its retries: (response, error), one of them None."""

    def call(text: str) -> tuple[str | None, str | None]:
        for attempt in range(max_retries):
            try:
                out = extractor(text)
                json.loads(out)  # a non-JSON reply is an error row
                return out, None
            except Exception as e:  # noqa: BLE001
                msg = str(e)
                limited = isinstance(e, RateLimited) or "429" in msg or "rate_limit" in msg.lower()
                if limited and retry_on_rate_limit:
                    time.sleep(base_delay * (2**attempt))
                    continue
                return None, msg
        return None, "Max retries exceeded (rate limit)"

    return call


def run_extractor(
    transcripts: DataFrame,
    extractor: Callable[[str], str],
    concurrency: int = 5,
    max_retries: int = 5,
    base_delay: float = 1.0,
    retry_on_rate_limit: bool = True,
) -> DataFrame:
    """Apply ``extractor(transcript) -> JSON text`` to every session.

    Runs inside ``mapInPandas``: each task keeps ``concurrency`` calls in flight, so the
    cluster-wide cap is tasks x concurrency.  Rate-limit failures (``RateLimited`` or a
    message containing '429' / 'rate_limit') are retried ``max_retries`` times with
    ``base_delay * 2**attempt`` seconds of back-off; other failures become error rows.
    The output is the (metadata, response, error) contract consumed by ``parse_results``.
    """

    call = _caller(extractor, max_retries, base_delay, retry_on_rate_limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for b in batches:
                res = list(pool.map(call, b["transcript"].tolist()))
                yield pd.DataFrame(
                    {
                        "session_id": b["session_id"],
                        "conversation_id": b["conversation_id"],
                        "client_id": b["client_id"],
                        "response": [r for r, _ in res],
                        "error": [e for _, e in res],
                    }
                )

    ship_package(transcripts.sparkSession)
    cols = transcripts.select("session_id", "conversation_id", "client_id", "transcript")
    return cols.mapInPandas(run, RESULT_SCHEMA)


def run_faq_extractor(transcripts: DataFrame, extractor: Callable[[str], str], concurrency: int = FAQ_CONCURRENCY) -> DataFrame:
    """``run_extractor`` for the FAQ contract: no retries; a failed session has the empty result
    (no faqs, no sale, no client) with its error, in ``response`` as in ``error``."""
    return _with_empty_faqs(run_extractor(transcripts, extractor, concurrency=concurrency, max_retries=1, retry_on_rate_limit=False))


def _with_empty_faqs(out: DataFrame) -> DataFrame:
    empty = F.to_json(
        F.struct(
            F.array().cast("array<string>").alias("faqs"),
            F.lit(None).cast("string").alias("venta"),
            F.lit(None).cast("string").alias("cliente"),
            F.col("error").alias("error"),
        ),
        {"ignoreNullFields": "false"},
    )
    return out.withColumn("response", F.coalesce("response", empty))


CALL = "transcript_hash string, response string, error string"


def _ledger_files(ledger: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(ledger if "://" in ledger else f"file://{ledger}")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """transcript_hash, response, error of every call kept under ``ledger``."""
    fs, root = _ledger_files(ledger)
    fs.create_dir(f"{root}/calls", recursive=True)
    return spark.read.schema(CALL).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{ledger}/calls")


def run_extractor_resumable(
    transcripts: DataFrame,
    extractor: Callable[[str], str],
    ledger: str,
    in_flight: int = 5,
    max_retries: int = 5,
    base_delay: float = 1.0,
    retry_on_rate_limit: bool = True,
) -> DataFrame:
    """``run_extractor`` with one cap for the whole job, and a ledger that a run started again goes on from.

    The calls are spread over ``in_flight`` tasks that call one after the other, so no more than that many are in flight
    however many executors there are (a job with speculative execution apart).  Each answer is kept in a file of its own
    under ``ledger`` (a folder that all machines share and pyarrow opens), named by the transcript's hash, before the next
    call begins; neither a lost task nor a rerun calls for it again.  Equal transcripts are one call.  Failed calls are
    rows of this run with their error and are tried again by the next.  Runs its calls while the result is built; a cap
    this low, not the ledger's number of files, bounds what a run can do.
    """
    spark = transcripts.sparkSession
    call = _caller(extractor, max_retries, base_delay, retry_on_rate_limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _ledger_files(ledger)
        for b in batches:
            failed = []
            for h, text in zip(b["transcript_hash"], b["transcript"], strict=True):
                folder = f"{root}/calls/{h[:2]}"
                path = f"{folder}/{h}.json"
                if fs.get_file_info(path).type == pafs.FileType.File:
                    continue  # an earlier attempt at this task
                response, error = call(text)
                if error is not None:
                    failed.append((h, None, error))
                    continue
                fs.create_dir(folder, recursive=True)
                made = f"{folder}/.{h}.{uuid.uuid4().hex}"
                with fs.open_output_stream(made) as f:
                    f.write(json.dumps({"transcript_hash": h, "response": response}).encode())
                fs.move(made, path)
            yield pd.DataFrame(failed, columns=["transcript_hash", "response", "error"], dtype="object")

    ship_package(spark)
    keyed = transcripts.select("session_id", "conversation_id", "client_id", "transcript", F.sha2(F.coalesce("transcript", F.lit("")), 256).alias("transcript_hash"))
    known = read_ledger(spark, ledger).select("transcript_hash")
    asked = keyed.groupBy("transcript_hash").agg(F.first(F.coalesce("transcript", F.lit(""))).alias("transcript")).join(known, "transcript_hash", "left_anti")
    # A stated number of partitions is one that adaptive execution keeps.
    failures = f"{ledger}/failures/{uuid.uuid4().hex}"
    asked.repartition(in_flight, "transcript_hash").mapInPandas(run, CALL).write.parquet(failures)
    answers = read_ledger(spark, ledger).unionByName(spark.read.schema(CALL).parquet(failures))
    return keyed.join(answers, "transcript_hash", "left").select(*RESULT_SCHEMA.names)


def run_faq_extractor_resumable(transcripts: DataFrame, extractor: Callable[[str], str], ledger: str, in_flight: int = FAQ_CONCURRENCY) -> DataFrame:
    """``run_extractor_resumable`` for the FAQ contract (see ``run_faq_extractor``)."""
    return _with_empty_faqs(run_extractor_resumable(transcripts, extractor, ledger, in_flight, max_retries=1, retry_on_rate_limit=False))


def dry_run(transcripts: DataFrame) -> tuple[int, str | None]:
    """What an extraction would process: the number of sessions, and the first one's transcript.

    No extractor is called; the driver gets two values."""
    first = F.min_by("transcript", F.struct("conversation_id", "session_id"))
    r = transcripts.agg(F.count(F.lit(1)).alias("n"), first.alias("t")).first()
    return r["n"], r["t"]
