"""Loading the exported JSON tables: casts, rejects, upserts, versions."""

import json

import pytest
from pyspark.sql import functions as F

from chatledger.operators import extract as EX
from chatledger.operators import load
from chatledger.sources import sinks

TS = "2025-01-01 00:00:00"


def write(folder, **tables):
    folder.mkdir()
    for name, rows in tables.items():
        (folder / f"{name}.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    return str(folder)


def tables(spark, path):
    return {t: sorted(map(tuple, spark.read.parquet(f"{path}/{t}").collect()), key=str) for t in load.UPSERTS}


def test_load_twice_and_again(spark, tmp_path):
    first = write(
        tmp_path / "a",
        clients=[
            {"id": "c1", "phone": "+57300", "name": "Ana", "source_client_id": "s1", "created_at": "2024-01-02T03:04:05"},
            {"id": "c1", "phone": None, "name": "Ana B", "source_client_id": "s1", "created_at": "nunca"},
            {"id": None, "phone": "1", "name": "x", "source_client_id": "s0"},
            {"id": "c2", "phone": "9" * 21, "name": "y", "source_client_id": "s2"},
        ],
        orders=[
            {"id": "o1", "client_id": "c1", "order_date": "2024-01-02", "total": 10.5},
            {"id": "o2", "client_id": "c1", "order_date": "ayer", "total": "1e30"},
            {"id": "o3", "client_id": "c1", "order_date": "ayer", "total": None, "status": "confirmed"},
        ],
        order_items=[
            {"id": "i1", "order_id": "o1", "product_name": "Torta", "quantity": 2, "unit_price": 5},
            {"id": "i2", "order_id": "o1", "product_name": "", "quantity": 2},
            {"id": "i3", "order_id": "o1", "product_name": "Pan", "quantity": None},
            {"id": "i4", "order_id": "o1", "product_name": "Pan", "quantity": 30_000_000_000},
        ],
    )
    ts = F.lit(TS).cast("timestamp_ntz")
    v1, v2, v3 = (str(tmp_path / v) for v in ("v1", "v2", "v3"))
    counts = load.load_mart(spark, first, v1, run_ts=ts)
    assert counts == {
        "clients": {"loaded": 2, "rejected": 2},
        "orders": {"loaded": 2, "rejected": 1},
        "products": {"loaded": 0, "rejected": 0},  # no such file
        "order_items": {"loaded": 2, "rejected": 2},
    }
    one = tables(spark, v1)
    assert [(r[0], r[2]) for r in one["clients"]] == [("c1", "Ana B")]  # the last row of an id wins
    orders = {r[0]: r for r in one["orders"]}
    assert orders["o1"][7] == "pending" and str(orders["o1"][6]) == "10.50" and orders["o3"][2] is None
    assert {r[0]: r[5] for r in one["order_items"]} == {"i1": 2, "i3": 1}
    assert {r["_reject"] for r in spark.read.parquet(f"{v1}/rejects/order_items").collect()} == {"no product name", "quantity out of range"}
    # the same files again change nothing
    load.load_mart(spark, first, v2, v1, run_ts=ts)
    assert tables(spark, v2) == one
    # a later file updates and inserts
    second = write(tmp_path / "b", clients=[{"id": "c1", "phone": None, "name": None, "source_client_id": "s9"}, {"id": "c3", "source_client_id": "s3"}])
    load.load_mart(spark, second, v3, v2, run_ts=ts)
    clients = {r.id: r for r in spark.read.parquet(f"{v3}/clients").collect()}
    assert clients["c1"].name == "Ana B" and clients["c1"].source_client_id == "s9" and set(clients) == {"c1", "c3"}
    assert tables(spark, v3)["orders"] == one["orders"]
    with pytest.raises(ValueError):
        load.load_mart(spark, second, v3, v3)


def test_results_that_are_no_objects_become_errors(spark, tmp_path):
    df = spark.createDataFrame([("s1", "[1]"), ("s2", "5"), ("s3", '{"a": 1}'), ("s4", None)], "session_id string, t string")
    df = df.select("session_id", F.lit("c").alias("conversation_id"), F.lit("x").alias("client_id"), F.try_parse_json("t").alias("result"), F.lit(None).cast("string").alias("error"))
    path = str(tmp_path / "r")
    sinks.write_results(df, path)
    lines = {x["_session_id"]: x for x in (json.loads(r.value) for r in spark.read.text(path).collect())}
    assert "error" in lines["s1"] and "error" in lines["s2"] and lines["s3"]["a"] == 1 and set(lines) == {"s1", "s2", "s3", "s4"}


def test_faq_extractor_keeps_the_error_and_never_retries(spark):
    def extractor(text):
        if "mal" in text:
            raise RuntimeError("429 rate_limit")
        return json.dumps({"faqs": [{"pregunta": text}]})

    t = spark.createDataFrame([("s1", "c1", "x", "bien"), ("s2", "c1", "x", "mal")], "session_id string, conversation_id string, client_id string, transcript string")
    out = {r.session_id: r for r in EX.run_faq_extractor(t, extractor).collect()}
    assert json.loads(out["s1"].response)["faqs"] == [{"pregunta": "bien"}] and out["s1"].error is None
    failed = json.loads(out["s2"].response)
    assert failed["faqs"] == [] and failed["venta"] is None and failed["cliente"] is None and "429" in failed["error"]
    assert EX.dry_run(t) == (2, "bien")
    assert EX.dry_run(t.limit(0)) == (0, None)
