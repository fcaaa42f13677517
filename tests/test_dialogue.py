"""Sale dialogue: transition table, batch replay, and the stream with a restart."""

import json
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chatledger.operators import bot as B
from chatledger.sources import versioned as V
from chatledger.streaming import dialogue as D


def run(updates):
    st = B.initial_state()
    out = []
    for u in updates:
        st, reply, sale = B.step(st, u)
        out.append((st["state"], reply, sale))
    return st, out


def msg(i, text, **kw):
    return {"update_id": i, "kind": "message", "text": text, "allowed": True, **kw}


def cb(i, data, **kw):
    return {"update_id": i, "kind": "callback", "data": data, "allowed": True, **kw}


def test_full_sale_new_client():
    st, out = run(
        [
            msg(1, "/venta"),
            msg(2, "12 34"),
            msg(3, "300 123 4567"),
            msg(4, "A"),
            msg(5, "Ana"),
            cb(6, "prod_finalizar"),
            cb(7, "prod_muffin_banano"),
            cb(8, "cant_2"),
            cb(9, "prod_brownie_"),
            cb(10, "cant_1"),
            cb(11, "prod_finalizar"),
            msg(12, "abc"),
            msg(13, "$66.000"),
            cb(14, "confirm_si"),
        ]
    )
    replies = [r for _, r, _ in out]
    assert replies == [
        "ask_phone", "bad_phone", "new_client", "short_name", "ask_products", "cart_empty",
        "ask_quantity", "added", "ask_quantity", "added", "ask_total", "bad_total", "summary", "sale_saved",
    ]
    sale = out[-1][2]
    assert sale["telefono"] == "3001234567" and sale["nombre"] == "Ana" and sale["es_nuevo"]
    assert sale["productos"] == [["Muffin", "Banano", 2], ["Brownie", None, 1]] and sale["total"] == 66000
    assert st["state"] == "idle"


def test_known_client_and_guards():
    st, out = run(
        [
            msg(1, "/venta"),
            msg(2, "3001234567", found_client_id="c1", found_name="Bea"),
            cb(3, "cant_3"),  # no current product: state moves, error reply
            cb(4, "prod_unknown"),
            cb(5, "confirm_si"),  # not in confirmation: rejected, reset
            cb(5, "confirm_si"),  # repeated update id: ignored
            msg(6, "hola", allowed=False),
        ]
    )
    assert [r for _, r, _ in out] == ["ask_phone", "client_found", "error", "ignored", "sale_rejected", "duplicate", "unauthorised"]
    assert all(s is None for _, _, s in out)
    assert st["state"] == "idle"


def test_cancel_at_each_state():
    for prefix in ([], [msg(2, "3001234567")], [msg(2, "3001234567"), msg(3, "Ana")]):
        seq = [msg(1, "/venta"), *prefix, msg(9, "/cancelar")]
        st, out = run(seq)
        assert st["state"] == "idle" and out[-1][1] == "cancelled"


def updates_rows():
    rows = []

    def m(i, chat, text):
        return {"update_id": i, "message": {"message_id": i, "chat": {"id": chat}, "from": {"first_name": "x"}, "text": text}}

    def c(i, chat, data):
        return {"update_id": i, "callback_query": {"id": str(i), "data": data, "message": {"message_id": i, "chat": {"id": chat}}}}

    script = [
        (m, "/venta"), (m, "3001234567"), (m, "Ana"), (c, "prod_waffle_yuca_y_queso"), (c, "cant_4"),
        (c, "prod_finalizar"), (m, "45.000"), (c, "confirm_si"),
    ]
    i = 0
    for step_no, (f, v) in enumerate(script):
        for chat in (10, 20):  # interleaved chats
            i += 1
            rows.append((step_no, f(i, chat, v)))
    return rows


def test_batch_replay_equals_stream_with_restart(spark, tmp_path):
    rows = updates_rows()
    base = tmp_path / "updates"
    base.mkdir()
    all_updates = [r for _, r in rows]
    # batch replay
    upd = spark.read.schema(D.UPDATE_FILE_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(u) for u in all_updates]))
    batch = B.completed_sales(B.replay(B.prepare_updates(upd, None, None))).collect()
    assert sorted(r.chat_id for r in batch) == [10, 20]
    assert all(r.total == 45000 and r.productos[0].cantidad == 4 for r in batch)
    # stream in two runs over the same checkpoint (restart between them)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    first = [u for s, u in rows if s < 4]
    second = [u for s, u in rows if s >= 4]
    (base / "a.json").write_text("\n".join(json.dumps(u) for u in first))
    q = D.start(spark, str(base), out, ckpt)
    q.awaitTermination(120)
    (base / "b.json").write_text("\n".join(json.dumps(u) for u in second))
    q = D.start(spark, str(base), out, ckpt)
    q.awaitTermination(120)
    orders = spark.read.parquet(f"{out}/orders").collect()
    assert len(orders) == 2 and all(float(o.total) == 45000 for o in orders)
    clients = spark.read.parquet(f"{out}/clients").collect()
    assert {c.source_client_id for c in clients} == {"telegram_3001234567"}
    items = spark.read.parquet(f"{out}/order_items").collect()
    assert [(i.product_name, i.variant, i.quantity) for i in items] == [("Waffle", "Yuca y Queso", 4)] * 2


def sale_updates(first_id, chat, phone, name=None):
    """A whole sale: with a name where the phone is expected to be new."""
    texts = ["/venta", phone, *([name] if name else [])]
    rows = [{"message": {"message_id": 1, "chat": {"id": chat}, "text": t}} for t in texts]
    rows += [{"callback_query": {"id": "1", "data": d, "message": {"message_id": 1, "chat": {"id": chat}}}} for d in ("prod_waffle_yuca_y_queso", "cant_2", "prod_finalizar")]
    rows += [{"message": {"message_id": 1, "chat": {"id": chat}, "text": "9000"}}]
    rows += [{"callback_query": {"id": "1", "data": "confirm_si", "message": {"message_id": 1, "chat": {"id": chat}}}}]
    return [{"update_id": first_id + i} | r for i, r in enumerate(rows)]


def test_a_client_registered_by_one_batch_is_found_by_the_next(spark, tmp_path):
    base, out, ckpt = tmp_path / "updates", str(tmp_path / "out"), str(tmp_path / "ckpt")
    base.mkdir()
    given = spark.createDataFrame([("g1", "+57 3110000000", "Given", None)], "id string, phone string, name string, created_at timestamp_ntz")
    (base / "a.json").write_text("\n".join(json.dumps(u) for u in sale_updates(0, 1, "3001112233", "Ana")))
    query = D.start(spark, str(base), out, ckpt, clients=given, available_now=False)
    try:
        query.processAllAvailable()
        # the same running query: its static side is read anew in each batch
        second = sale_updates(100, 2, "300 111 2233") + sale_updates(200, 3, "573110000000")
        (base / "b.json").write_text("\n".join(json.dumps(u) for u in second))
        query.processAllAvailable()
    finally:
        query.stop()
    replies = V.read_table(spark, out, "replies", B.OUTPUT_SCHEMA).collect()
    assert {r.chat_id for r in replies if r.reply == "new_client"} == {1}
    assert {r.chat_id for r in replies if r.reply == "client_found"} == {2, 3}
    assert {r.chat_id for r in replies if r.reply == "sale_saved"} == {1, 2, 3}
    clients = D.registered_clients(spark, out).collect()
    assert [(c.name, c.phone) for c in clients] == [("Ana", "3001112233")]
    orders = spark.read.parquet(f"{out}/orders").collect()
    assert sorted(o.client_id for o in orders) == sorted([clients[0].id, clients[0].id, "g1"])


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "mart")
    good = spark.createDataFrame([(1, "a")], "id int, name string")
    bad = good.withColumn("name", F.raise_error(F.lit("no space left")).cast("string"))
    assert V.write_version(root, 0, {"clients": good, "orders": good, "order_items": good})
    for name in ("orders", "order_items"):  # a failure after the first or the second table
        tables = {"clients": good, "orders": good, "order_items": good} | {name: bad}
        with pytest.raises(Exception, match="no space left"):
            V.write_version(root, 1, tables)
        assert V.committed(spark, root) == [0]
        for table in tables:
            assert [r.version for r in V.read_table(spark, root, table, good.schema).collect()] == [0]
            assert V.read_anew(spark, root, table, good.schema).count() == 1
    anew = V.read_anew(spark, root, "orders", good.schema)
    assert anew.count() == 1
    more = spark.createDataFrame([(2, "b"), (3, None)], good.schema)
    assert V.write_version(root, 1, {"clients": good, "orders": more, "order_items": good})
    assert not V.write_version(root, 1, {"clients": bad, "orders": bad, "order_items": bad})  # replayed: nothing is written
    assert sorted(anew.collect()) == [(1, "a"), (2, "b"), (3, None)]
    assert V.read_table(spark, root, "orders", good.schema).count() == 3
    assert V.read_table(spark, str(tmp_path / "none"), "orders", good.schema).collect() == []
    assert V.read_anew(spark, str(tmp_path / "none"), "orders", good.schema).collect() == []


def test_odd_quantities_and_totals_are_errors():
    st = B.initial_state() | {"state": "seleccionando_cantidad", "actual": ["Waffle", None]}
    for data in ("cant_3000000000", "cant_0", "cant_11", "cant_x", "cant_\u0663"):
        _, reply, _ = B.step(st, {"update_id": 1, "kind": "callback", "data": data})
        assert reply == "error"
    assert [B._int_total(t) for t in ("1_000", "\u0661\u0662", "$1.000", "9" * 30, "-5")] == [None, None, 1000, None, None]


def test_an_empty_allow_list_admits_everybody(spark):
    upd = spark.read.schema(D.UPDATE_FILE_SCHEMA).json(spark.sparkContext.parallelize([json.dumps({"update_id": 1, "message": {"chat": {"id": 5}, "text": "/venta"}})]))
    none = spark.createDataFrame([], "chat_id bigint")
    one = spark.createDataFrame([(6,)], "chat_id bigint")
    assert [B.prepare_updates(upd, None, a).collect()[0].allowed for a in (none, one)] == [True, False]


def test_segmented_replay_equals_whole_chat_replay(spark):
    from chatledger.plans import adapters as A
    from tests.conftest import SF_SMALL

    prepared = B.prepare_updates(A.bot_updates(spark, SF_SMALL), A.mart_clients(spark, SF_SMALL), A.allowed_chats(spark, SF_SMALL))
    dup = prepared.limit(5)  # replayed deliveries of the same updates
    prepared = prepared.unionByName(dup)
    whole = sorted(map(tuple, B.replay_whole(prepared).collect()), key=str)
    seg = sorted(map(tuple, B.replay(prepared).collect()), key=str)
    assert whole == seg
    assert B.segments(prepared).select("chat_id", "_seg_id").distinct().count() > prepared.select("chat_id").distinct().count()


def test_many_short_segments_take_no_group_each(spark):
    upd = [{"update_id": i, "message": {"chat": {"id": i % 7}, "text": "/venta" if i % 14 < 7 else "12"}} for i in range(1, 4000)]
    upd.append({"update_id": 5000})  # names no chat: ignored
    df = spark.read.schema(D.UPDATE_FILE_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(u) for u in upd]))
    out = B.replay(B.prepare_updates(df, None, None))
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.update_id: (r.chat_id, r.reply) for r in out.collect()}
    assert got.pop(5000) == (None, "ignored")
    # Chat 0 gets its first command with update 14.
    assert got == {i: (i % 7, "ask_phone" if i % 14 < 7 else "hint" if i == 7 else "bad_phone") for i in range(1, 4000)}


def test_updates_without_a_phone_do_not_meet_in_one_task(spark):
    texts = {0: "Ana", 1: "$66.000", 2: "/venta", 3: "+57 300 0000001", 4: "\u00b2\u00b2\u00b2\u00b2\u00b2\u00b212"}
    upd = [{"update_id": i, "message": {"chat": {"id": i % 7}, "text": texts[i % 5]}} for i in range(2000)]
    upd += [{"update_id": 2000 + i, "callback_query": {"data": "cant_2", "message": {"chat": {"id": i % 7}}}} for i in range(2000)]
    df = spark.read.schema(D.UPDATE_FILE_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(u) for u in upd]))
    clients = spark.createDataFrame([("c1", "+573000000001", "Ana", None), ("c2", "12", "Eva", None), ("c3", "none", "Bea", None)], "id string, phone string, name string, created_at timestamp_ntz")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = B.prepare_updates(df, clients, None).select("text", "found_client_id", F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    found = [r for r in out if r.found_client_id]
    assert {(r.text, r.found_client_id) for r in found} == {(texts[3], "c1"), (texts[4], "c2")} and len(found) == 800
    rest = [r.p for r in out if not r.found_client_id]
    assert len(rest) == 3200 and max(rest.count(p) for p in set(rest)) < 800  # before: all of a text in one


def test_updates_are_made_by_methods_that_the_jvm_compiles(spark, capfd):
    from chatledger.plans import adapters as A
    from tests.conftest import SF_SMALL

    A.bot_updates(spark, SF_SMALL).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capfd.readouterr().out)]
    assert sizes and max(sizes) < 8000  # longer ones are interpreted


def test_the_last_reset_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(B, "SEGMENT_BUCKET", 4)
    texts = ["/venta", "hola", "/cancelar", "hola", "x", "/start", "y", "/venta", "z", "300 111 2233", "Ana", "w", "/id"]
    upd = [{"update_id": i, "message": {"chat": {"id": i % 2}, "text": texts[i * 5 % len(texts)]}} for i in range(120)]
    df = spark.read.schema(D.UPDATE_FILE_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(u) for u in upd]))
    prepared = B.prepare_updates(df, None, None)
    assert sorted(map(tuple, B.replay(prepared).collect()), key=str) == sorted(map(tuple, B.replay_whole(prepared).collect()), key=str)
    want, last = {}, {}
    for i, u in enumerate(upd):
        chat, text = i % 2, u["message"]["text"]
        want[i] = last.get(chat, (-1, "idle"))
        if text in B.RESET_MESSAGES:
            last[chat] = (i, B.RESET_MESSAGES[text])
    assert {r.update_id: (r["_seg_id"], r["_seg_state"]) for r in B.segments(prepared).collect()} == want
