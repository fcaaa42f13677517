"""Extractor result parsing and export on literal JSON fixtures (FIXTURES.md section 3)."""

import json

from pyspark.sql import functions as F

from chatledger.operators import orders as O
from chatledger.sources import jsonl, sinks


def run_ts():
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


def order(order_type="confirmed", total=45000, products=None, date="2024-05-01", customer=None):
    return json.dumps(
        {
            "conversation_id": "c",
            "customer": customer if customer is not None else {"phone": "+57300", "name": "Ana"},
            "order": {
                "has_order": True,
                "order_type": order_type,
                "order_date": date,
                "city": "",
                "address": "Calle 1",
                "payment_method": "Nequi",
                "approx_total": total,
                "products": products if products is not None else [],
            },
        }
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, "session_id string, conversation_id string, client_id string, response string, error string")


def test_parse_and_money(spark):
    rows = [
        ("s1", "c", "+57300", order(total=45000), None),
        ("s2", "c", "+57300", order(total="$45.000"), None),
        ("s3", "c", "+57300", order(total="45,5"), None),
        ("s4", "c", "+57300", order(total="45000.50"), None),
        ("s5", "c", "+57300", order(total="abc"), None),
        ("s6", "c", "+57300", order(total=None), None),
        ("s7", "c", "+57300", "{not json", None),
        ("s8", "c", "+57300", None, "rate limit"),
        ("s9", "c", "+57300", json.dumps({"order": None, "customer": None}), None),
    ]
    res = O.parse_results(frame(spark, rows))
    st = O.extract_status(res).collect()[0]
    assert (st.ok, st.errors) == (7, 2)
    t = {r.session_id: r.total for r in O.typed_orders(res).select("session_id", O.money(F.col("approx_total")).alias("total")).collect()}
    assert t["s1"] == 45000 and t["s2"] == 45000 and t["s3"] == 45.5 and t["s4"] == 4500050
    assert t["s5"] is None and t["s6"] is None and t["s9"] is None
    assert O.exported_orders(res).count() == 6  # error rows and a null order drop out


def test_items_and_labels(spark):
    prods = [
        {"name": "Muffin", "variant": "Banano", "quantity_units": 2, "unit": "caja", "unit_price_approx": 22000},
        "texto suelto",
        {"name": "Brownie", "variant": None, "quantity_units": 0, "unit": ""},
        {"name": "Arepa", "variant": "", "quantity_units": "dos", "unit_price": "$5.000"},
        {"name": None, "quantity_units": 2.5},
    ]
    rows = [
        ("s1", "c", "+57300", order(products=prods), None),
        ("s2", "c", "+57300", order(products="ver chat"), None),
        ("s3", "c", "+57300", order(products=[]), None),
    ]
    ex = O.exported_orders(O.parse_results(frame(spark, rows)))
    items = O.items_table(ex).orderBy("id").collect()
    assert len(items) == 4  # the string element is skipped
    by_name = {r.product_name: r for r in items}
    assert by_name["Muffin"].quantity == 2 and by_name["Muffin"].unit_price == 22000
    assert by_name["Brownie"].quantity == 1 and by_name["Brownie"].unit is None  # 0 -> 1, '' -> NULL
    assert by_name["Arepa"].variant is None and by_name["Arepa"].quantity is None and by_name["Arepa"].unit_price == 5000
    assert by_name[""].quantity == 3  # NULL name -> '' (skipped later); 2.5 rounds like an INTEGER column
    labels = {r.session_id: r.products for r in ex.select("session_id", O.product_label(F.col("products")).alias("products")).collect()}
    assert labels["s1"] == "Muffin (Banano) x2 caja; Brownie; Arepa xdos;  x2.5"
    assert labels["s2"] == "" and labels["s3"] == ""


def test_date_fallback_and_clients(spark):
    rows = [
        ("s1", "c", "+57300", order(date=""), None),
        ("s2", "c", "WhatsApp - Ana", order(date=None, customer={"phone": "300", "name": ""}), None),
        ("s3", "c", "WhatsApp - Ana", order(date="2024-01-02", customer={"phone": None, "name": "Ana B"}), None),
    ]
    ex = O.exported_orders(O.parse_results(frame(spark, rows)))
    last = spark.createDataFrame([("s1", "2024-03-03")], "session_id string, last_date string")
    d = {r.session_id: (r.order_date, r.order_date_source) for r in O.with_order_date(ex, last).collect()}
    assert d == {"s1": ("2024-03-03", "last_message"), "s2": (None, "none"), "s3": ("2024-01-02", "llm")}
    fc = spark.createDataFrame([("+57300", "2024-01-01T08:00:00")], "client_id string, first_contact string")
    cl = {r.source_client_id: r for r in O.clients_table(ex, fc, run_ts()).collect()}
    assert cl["+57300"].phone == "+57300" and cl["+57300"].created_at == "2024-01-01T08:00:00"
    # first order by session id wins: s2 has no name and no phone -> name from the source id
    assert cl["WhatsApp - Ana"].phone is None and cl["WhatsApp - Ana"].name == "Ana"
    assert cl["WhatsApp - Ana"].created_at == "2025-01-01T00:00:00"


def test_results_sink_roundtrip(spark, tmp_path):
    rows = [("s1", "c1", "+57300", order(), None), ("s2", "c2", "x", None, "boom")]
    res = O.parse_results(frame(spark, rows))
    path = str(tmp_path / "ventas_llm")
    sinks.write_results(res, path)
    back = {r.session_id: r for r in jsonl.read_results(spark, path).collect()}
    assert back["s1"].error is None and back["s1"].conversation_id == "c1"
    assert back["s2"].error == "boom" and back["s2"].client_id == "x"


def test_json_table_missing_and_malformed(spark, tmp_path):
    from chatledger import schemas as S

    assert jsonl.read_json_table(spark, str(tmp_path / "nope.json"), S.PRODUCTS_SCHEMA).count() == 0
    good = tmp_path / "t" / "good.json"
    good.parent.mkdir()
    good.write_text(json.dumps([{"id": "p1", "name": "Muffin", "variant": None}]))
    (tmp_path / "t" / "bad.json").write_text('[{"id": "p2", "name": ')
    out = jsonl.read_json_table(spark, str(tmp_path / "t"), S.PRODUCTS_SCHEMA).collect()
    assert [r.id for r in out] == ["p1"]


def test_results_variant_table_roundtrip(spark, tmp_path):
    prods = [{"name": "Muffin", "variant": "Banano", "quantity_units": 2, "unit": "caja"}]
    rows = [("s1", "c", "+57300", order(products=prods, total="$45.000"), None), ("s2", "c", "x", "{bad", None)]
    res = O.parse_results(frame(spark, rows))
    path = str(tmp_path / "results_variant")
    sinks.write_results_table(res, path)
    back = jsonl.read_results_table(spark, path)
    a = sorted(map(tuple, O.items_table(O.exported_orders(back)).collect()))
    b = sorted(map(tuple, O.items_table(O.exported_orders(res)).collect()))
    assert a == b and len(a) == 1
    assert {r.session_id: r.error for r in back.collect()}["s2"] == "invalid JSON response"
