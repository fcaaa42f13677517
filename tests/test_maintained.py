import datetime as dt
import random
from decimal import Decimal

from chatledger import schemas as S
from chatledger.operators import maintained as M
from chatledger.operators import mart as MT
from chatledger.operators import reports as R

ORDERS, ITEMS, CLIENTS = S.MART_SCHEMAS["orders"], S.MART_SCHEMAS["order_items"], S.MART_SCHEMAS["clients"]


def frame(spark, schema, rows):
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def an_order(rng, oid):
    total = rng.choice([None, Decimal("10.50"), Decimal("0.00"), Decimal(rng.randrange(1, 10**9)) / 100])
    return {"id": oid, "client_id": rng.choice([None, "c1", "c2", "c3"]), "total": total, "order_date": rng.choice([None, dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 3, 9)]), "status": "pending"}


def an_item(rng, iid):
    return {"id": iid, "order_id": rng.choice(["o1", "o2", "o3", "o9"]), "product_name": rng.choice(["Waffle", "Muffin", ""]), "variant": rng.choice([None, "Mora"]), "quantity": rng.choice([None, 1, 5])}


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def agree(spark, clients, orders, items, st):
    pairs = [
        (R.client_summary(clients, orders), M.client_summary(clients, st)),
        (R.daily_summary(orders), M.daily_summary(st)),
        (R.sales_by_month(orders), M.sales_by_month(st)),
        (R.top_products(items), M.top_products(st)),
        (R.best_product(items), M.best_product(st)),
        (R.table_counts({"orders": orders, "order_items": items}), M.table_counts(st)),
        (R.total_sales(orders), M.total_sales(st)),
    ]
    for want, got in pairs:
        assert [f.name for f in want.schema] == [f.name for f in got.schema]
        assert [f.dataType for f in want.schema] == [f.dataType for f in got.schema]
        assert sorted_rows(want) == sorted_rows(got)


def test_views_after_upserts_and_deletes(spark, tmp_path):
    rng, root = random.Random(4), str(tmp_path / "views")
    clients = frame(spark, CLIENTS, [{"id": f"c{i}", "name": f"n{i}", "source_client_id": f"s{i}"} for i in range(1, 5)])
    orders, items = {}, {}
    for load in range(4):
        o_ids, i_ids = ({f"{k}{rng.randrange(12)}" for _ in range(6)} for k in "oi")
        before = (frame(spark, ORDERS, orders.values()), frame(spark, ITEMS, items.values()))
        for ids, held, make in ((o_ids, orders, an_order), (i_ids, items, an_item)):
            for x in ids:  # rows that come, change or go
                if x in held and rng.random() < 0.4:
                    del held[x]
                else:
                    held[x] = make(rng, x)
        after = (frame(spark, ORDERS, orders.values()), frame(spark, ITEMS, items.values()))
        ids = [spark.createDataFrame([(x,) for x in s], "id string") for s in (o_ids, i_ids)]
        changed = [M.changes(b, a, i) for b, a, i in zip(before, after, ids, strict=True)]
        assert M.record(root, load, M.contributions(orders=changed[0], order_items=changed[1]))
    assert not M.record(root, 2, M.contributions(orders=changed[0]))  # a load that is run again
    agree(spark, clients, after[0], after[1], M.stored(spark, root))
    small = str(tmp_path / "small")
    assert M.compact(spark, root, small) and not M.record(small, 3, M.contributions(orders=changed[0]))
    agree(spark, clients, after[0], after[1], M.stored(spark, small))
    # everything goes: nothing is left behind
    gone = [M.changes(a, a.limit(0), a.select("id")) for a in after]
    assert M.record(small, 4, M.contributions(orders=gone[0], order_items=gone[1]))
    agree(spark, clients, after[0].limit(0), after[1].limit(0), M.stored(spark, small))


def test_deletes_that_propagate(spark):
    rng = random.Random(9)
    clients = frame(spark, CLIENTS, [{"id": f"c{i}"} for i in range(1, 4)])
    orders = frame(spark, ORDERS, [an_order(rng, f"o{i}") for i in range(9)])
    items = frame(spark, ITEMS, [an_item(rng, f"i{i}") for i in range(30)])
    products = spark.createDataFrame([], S.MART_SCHEMAS["products"])
    one = lambda x: spark.createDataFrame([(x,)], "id string")
    out = MT.propagate_deletes(clients, orders, products, items, one("c1"), one("o2"), one("p"))
    o_ids, i_ids = M.deleted_ids(orders, items, one("c1"), one("o2"))
    delta = M.contributions(orders=M.changes(orders, out["orders"], o_ids), order_items=M.changes(items, out["order_items"], i_ids))
    st = M.merged(M.contributions(orders=M.whole(orders), order_items=M.whole(items)), delta)
    agree(spark, out["clients"], out["orders"], out["order_items"], st)


def test_a_load_is_recorded_from_its_folders(spark, tmp_path):
    import json

    from chatledger.operators.load import load_mart

    def write(folder, orders, items):
        folder.mkdir()
        tables = {"clients": [{"id": "c1", "source_client_id": "s1"}], "orders": orders, "products": [], "order_items": items}
        for name, rows in tables.items():
            (folder / f"{name}.json").write_text(json.dumps(rows))
        return str(folder)

    order = lambda i, total: {"id": f"o{i}", "client_id": "c1", "order_date": "2024-05-0" + str(i), "total": total}
    item = lambda i, q: {"id": f"i{i}", "order_id": "o1", "product_name": "Waffle", "quantity": q}
    first = write(tmp_path / "a", [order(1, 5), order(2, 7)], [item(1, 2)])
    second = write(tmp_path / "b", [order(2, 9), order(3, None)], [item(1, 4), item(2, 1)])
    v1, v2, root = (str(tmp_path / x) for x in ("v1", "v2", "views"))
    load_mart(spark, first, v1)
    assert M.record_load(spark, root, 1, v1)
    load_mart(spark, second, v2, v1)
    assert M.record_load(spark, root, 2, v2, v1) and not M.record_load(spark, root, 2, v2, v1)
    st = M.stored(spark, root)
    t = {name: spark.read.schema(s).parquet(f"{v2}/{name}") for name, s in S.MART_SCHEMAS.items()}
    assert sorted_rows(M.client_summary(t["clients"], st)) == sorted_rows(R.client_summary(t["clients"], t["orders"]))
    assert sorted_rows(M.top_products(st)) == [("Waffle", None, 5, 1)]
    assert sorted_rows(M.table_counts(st)) == sorted_rows(R.table_counts(t))
    assert M.total_sales(st).first()[0] == Decimal("14.00")


def test_changes_come_from_touched_orders_alone(spark):
    from chatledger.operators import mart as MT
    from chatledger.operators import maintained as MV
    from chatledger.plans import adapters as A
    from chatledger.plans import queries as Q
    from tests.conftest import SF_SMALL

    before, batch = A.mart_orders(spark, SF_SMALL), Q._last(A.batch_orders(spark, SF_SMALL))
    old = MV.touched(before, batch)
    assert 0 < old.count() < before.count()
    rows = lambda b: sorted(map(str, MV.changes(b, MT.upsert_orders(b, batch, A.run_ts()), batch).select("id", "client_id", "order_date", "total", "status", "sign").collect()))
    assert rows(old) == rows(before)
    # No stored table joins the load with the orders anew.
    plan = Q.q_maintained_client_summary(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "LeftSemi" not in plan
