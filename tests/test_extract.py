"""Pluggable extractor job and native rules on invented chats."""

import json

import pandas as pd
from pyspark.sql import functions as F

from chatledger.operators import extract as EX
from chatledger.operators import messages as M


def msgs_frame(spark, rows):
    """rows: (conversation, minutes, role, text) -> a normalised message frame."""
    data = []
    for i, (conv, minutes, role, text) in enumerate(rows):
        data.append(
            (
                conv,
                (pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=minutes)).to_pydatetime(),
                {"user": "Entrante", "assistant": "Saliente"}[role],
                "+57 300 123 4567",
                text,
                conv + ".csv",
                i,
            )
        )
    df = spark.createDataFrame(
        data, "chat_id string, sent_at timestamp_ntz, direction string, contact string, text string, filename string, file_row long"
    ).withColumn("file_path", F.col("filename"))
    return M.sessionize(M.assign_ids_and_roles(df))


def test_rules_on_examples(spark):
    rows = [
        ("a", 0, "user", "Buenas, habla Pedro"),
        ("a", 1, "user", "Me das 2 mufins de chocolate, gracias"),
        ("a", 2, "user", "Mi barrio es Belén, calle 30, apto 5"),
        ("a", 3, "user", "El pago va por Nequi"),
        ("a", 4, "assistant", "Anotado, el total es $45.000"),
        ("b", 0, "user", "Envíame la carta"),
        ("b", 1, "assistant", "Varios son sin azúcar"),
        ("c", 0, "user", "Cancela lo que hablamos"),
        ("d", 0, "user", "¿El domiciliario demora mucho?"),
        ("e", 0, "user", "¿Cuánto cuesta una caja de muffins de zanahria?"),
        ("e", 1, "user", "Ponme 3 arepitas de yuca y queso"),
    ]
    out = {r.conversation_id: r for r in EX.extract_orders(msgs_frame(spark, rows)).collect()}
    a = out["a"]
    assert (a.order_type, a.has_order, a.payment_method, a.approx_total) == ("confirmed", True, "Nequi", 45000.0)
    assert a.customer_name == "Pedro" and a.customer_phone == "+573001234567"
    assert a.address.startswith("Mi barrio es")
    assert out["b"].order_type == "quotation" and not out["b"].has_order
    assert out["c"].order_type == "cancelled"
    assert out["d"].order_type == "delivery_followup" and out["d"].has_order
    resp = json.loads(a.response)
    assert resp["order"]["products"][0]["name"] == "Muffin" and resp["order"]["products"][0]["variant"] == "Chocolate"
    assert resp["order"]["products"][0]["quantity_units"] == 2
    mentions = EX.product_mentions(EX.message_features(msgs_frame(spark, rows)))
    got = {(r.name, r.variant, r.quantity) for r in mentions.filter(F.col("conversation_id") == "e").collect()}
    assert got == {("Muffin", "Zanahoria", None), ("Arepa", "Yuca y Queso", 3)}


def test_faq_pairs_and_frequency(spark):
    rows = [
        ("a", 0, "user", "¿El envío a Sabaneta tiene costo?"),
        ("a", 1, "assistant", "Sí, hasta Sabaneta"),
        ("b", 0, "user", "  ¿el envío a sabaneta tiene costo?  "),
        ("b", 1, "assistant", "Sí"),
        ("c", 0, "user", "¿En qué horario atienden?"),
        ("c", 1, "user", "hola"),
    ]
    res = EX.extract_faq(msgs_frame(spark, rows))
    freq = EX.faq_frequency(res).collect()
    assert len(freq) == 1  # the unanswered question is not a pair
    assert freq[0].frecuencia == 2 and freq[0].pregunta == "¿El envío a Sabaneta tiene costo?" and freq[0].categoria == "envio"


def test_next_in_order_crosses_day_buckets(spark):
    rows = [("a", 0, "user", "Mi papá es diabético, ¿qué le sirve?"), ("a", 60 * 30, "assistant", "Varios son sin azúcar")]
    pairs = EX.faq_pairs(EX.message_features(msgs_frame(spark, rows))).collect()
    assert pairs == []  # 30 h later: a new session, so no pair
    rows = [("a", 60 * 23, "user", "Mi papá es diabético, ¿qué le sirve?"), ("a", 60 * 25, "assistant", "Varios son sin azúcar")]
    pairs = EX.faq_pairs(EX.message_features(msgs_frame(spark, rows))).collect()
    assert [p.categoria for p in pairs] == ["diabeticos"]  # answer falls in the next day bucket


def test_run_extractor_retries_and_errors(spark):
    calls = {}

    def fake(text):
        n = calls.get(text, 0)
        calls[text] = n + 1
        if "limit" in text and n < 2:
            raise EX.RateLimited("429 rate_limit")
        if "boom" in text:
            raise ValueError("boom")
        if "bad" in text:
            return "not json"
        return json.dumps({"order": {"order_type": "confirmed"}})

    t = spark.createDataFrame(
        [("s1", "c", "x", "ok"), ("s2", "c", "x", "limit"), ("s3", "c", "x", "boom"), ("s4", "c", "x", "bad")],
        "session_id string, conversation_id string, client_id string, transcript string",
    ).coalesce(1)
    out = {r.session_id: r for r in EX.run_extractor(t, fake, concurrency=2, base_delay=0.01).collect()}
    assert out["s1"].error is None and out["s2"].error is None
    assert out["s3"].error == "boom" and out["s4"].error is not None
    never = {r.session_id: r.error for r in EX.run_extractor(t.filter("session_id = 's2'"), lambda s: (_ for _ in ()).throw(EX.RateLimited("x")), max_retries=2, base_delay=0.01).collect()}
    assert never["s2"] == "Max retries exceeded (rate limit)"


def test_pluggable_extractor_end_to_end(spark):
    """Transcripts -> any text->JSON function -> parsed results -> mart rows."""
    from chatledger.operators import orders as O
    from chatledger.operators import sessions as SS

    rows = [("a", 0, "user", "Me das 2 mufins de chocolate, gracias"), ("a", 1, "user", "El pago va por Nequi")]
    transcripts = SS.transcripts(msgs_frame(spark, rows), "orders")

    def model(text):
        assert text.startswith("CONVERSATION_ID: a\nCLIENT_ID: +573001234567\n[2024-01-01T00:00:00] Cliente: ")
        return json.dumps(
            {
                "conversation_id": "a",
                "customer": {"phone": "+573001234567", "name": None},
                "order": {"order_type": "confirmed", "approx_total": "$45.000",
                          "products": [{"name": "Muffin", "variant": "Chocolate", "quantity_units": 2}]},
            }
        )

    res = O.parse_results(EX.run_extractor(transcripts, model, concurrency=2))
    ex = O.exported_orders(res)
    assert [r.session_id for r in ex.collect()] == ["a__s1"]
    items = O.items_table(ex).collect()
    assert [(i.product_name, i.variant, i.quantity) for i in items] == [("Muffin", "Chocolate", 2)]
    assert O.orders_table(O.with_order_date(ex, SS.session_last_date(msgs_frame(spark, rows))), F.current_timestamp()).collect()[0].total == 45000


def orders_of(spark, *texts):
    return EX.extract_orders(msgs_frame(spark, [(f"c{i}", 0, "user", t) for i, t in enumerate(texts)])).orderBy("conversation_id").collect()


def test_any_sign_of_an_order_is_one(spark):
    got = orders_of(spark, "Quiero hacer un encargo", "Van 2 cajas de muffins y 1 de brownies", "El pago va por Nequi, mi barrio es Belén", "Envíame la carta", "Cancela lo que hablamos")
    assert [r.has_order for r in got] == [True, True, True, False, False]


def test_one_huge_quantity_stops_nobody(spark):
    got = orders_of(spark, "Quiero 99999999999999999999 arepas", "Quiero 2 arepas")
    assert [json.loads(r.response)["order"]["products"][0]["quantity_units"] for r in got] == [None, 2]


def test_each_mention_has_its_own_variant_and_quantity(spark):
    rows = [("a", 0, "user", "Van 2 arepas de maduro y queso y 1 arepa de yuca y queso y 3 de brownies")]
    m = EX.product_mentions(EX.message_features(msgs_frame(spark, rows))).orderBy("pos").collect()
    assert [(r.name, r.variant, r.quantity) for r in m] == [("Arepa", "Maduro y Queso", 2), ("Arepa", "Yuca y Queso", 1), ("Brownie", None, 3)]


def test_odd_result_values(spark):
    from chatledger.functions import text as X
    from chatledger.operators import orders as O

    products = ['{"name":"A","quantity_units":1e30,"unit_price":null,"unit_price_approx":5}', '{"name":"B","quantity_units":"NaN","unit_price":7,"unit_price_approx":5}', '{"name":"C","quantity_units":2}']
    body = '{"conversation_id":"c","order":{"order_type":"confirmed","products":[' + ",".join(products) + "]}}"
    res = spark.createDataFrame([("s", "c", "x", body, None)], EX.RESULT_SCHEMA)
    items = {r.product_name: r for r in O.items_table(O.exported_orders(O.parse_results(res))).collect()}
    assert [items[n].quantity for n in "ABC"] == [None, None, 2]
    assert [items[n].unit_price for n in "AB"] == [5, 7]
    texts = spark.createDataFrame([("45d",), ("NaN",), ("inf",), ("$1.500,5",), ("1e3",)], "t string")
    assert [r.n for r in texts.select(X.money_text_to_number("t").alias("n")).collect()] == [None, None, None, 1500.5, 1000.0]
