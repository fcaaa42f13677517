"""Upsert idempotence, COALESCE rules, delete propagation, quality rules, lookups."""

from pyspark.sql import functions as F

from chatledger.operators import mart as MT
from chatledger.operators import reports as R
from chatledger.plans import adapters as A
from tests.conftest import SF_SMALL

TS = "2025-01-01 00:00:00"


def _ts(spark, s):
    return F.lit(s).cast("timestamp_ntz")


def clients_fixture(spark):
    rows = [
        ("c1", "+573001", "Ana", "src1", None, None),
        ("c2", "+573002", "Bob", "src2", None, None),
    ]
    return spark.createDataFrame(rows, "id string, phone string, name string, source_client_id string, created_at timestamp_ntz, updated_at timestamp_ntz")


def test_upsert_clients_rules_and_idempotence(spark):
    target = clients_fixture(spark)
    batch = spark.createDataFrame(
        [("c1", None, "ANA", "src1b", None, None), ("c3", "+573003", "Cid", "src3", None, None)],
        target.schema,
    )
    once = MT.upsert_clients(target, batch, _ts(spark, TS))
    twice = MT.upsert_clients(once, batch, _ts(spark, TS))
    a = {r.id: r for r in once.collect()}
    assert a["c1"].phone == "+573001"  # NULL phone keeps the old one
    assert a["c1"].name == "ANA" and a["c1"].source_client_id == "src1b"
    assert a["c2"].updated_at is None  # untouched row keeps its stamp
    assert str(a["c1"].updated_at) == TS
    assert a["c3"].created_at is None  # explicit NULL insert
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_upsert_items_keeps_product_id_and_skips_blank(spark):
    schema = "id string, order_id string, product_id string, product_name string, variant string, quantity int, unit string, unit_price decimal(10,2), created_at timestamp_ntz"
    target = spark.createDataFrame([("i1", "o1", "p1", "Muffin", "Banano", 2, "caja", None, None)], schema)
    batch = spark.createDataFrame(
        [("i1", "o1", None, "Muffin", "Chocolate", None, "caja", None, None), ("i2", "o1", None, "", None, 1, None, None, None)],
        schema,
    )
    out = {r.id: r for r in MT.upsert_items(target, batch, _ts(spark, TS)).collect()}
    assert set(out) == {"i1"}
    assert out["i1"].product_id == "p1" and out["i1"].variant == "Chocolate" and out["i1"].quantity == 1


def test_dedupe_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "id string, seq int, v string")
    out = {r.id: r.v for r in MT.dedupe_last(df, "id", ["seq"]).collect()}
    assert out == {"a": "y", "b": "z"}


def test_delete_propagation(spark):
    c = clients_fixture(spark)
    o = spark.createDataFrame([("o1", "c1"), ("o2", "c2")], "id string, client_id string")
    p = spark.createDataFrame([("p1", "Muffin", "Banano")], "id string, name string, variant string")
    i = spark.createDataFrame([("i1", "o1", "p1"), ("i2", "o2", "p1")], "id string, order_id string, product_id string")
    ids = lambda *x: spark.createDataFrame([(v,) for v in x], "id string")
    out = MT.propagate_deletes(c, o, p, i, ids("c1"), ids("o2"), ids("p1"))
    assert {r.id: r.client_id for r in out["orders"].collect()} == {"o1": None}
    assert [(r.id, r.product_id) for r in out["order_items"].collect()] == [("i1", None)]
    assert out["products"].count() == 0 and out["clients"].count() == 1


def test_resolve_product_ids_null_variant(spark):
    items = spark.createDataFrame(
        [("i1", None, "Brownie", None), ("i2", None, "Muffin", "Banano"), ("i3", None, "Muffin", None)],
        "id string, product_id string, product_name string, variant string",
    )
    products = spark.createDataFrame([("pb", "Brownie", None), ("pm", "Muffin", "Banano"), ("pm0", "Muffin", "Banano")], "id string, name string, variant string")
    out = {r.id: r.product_id for r in MT.resolve_product_ids(items, products).collect()}
    assert out == {"i1": "pb", "i2": "pm", "i3": None}


def test_quality_report_finds_planted_violations(spark):
    c = A.mart_clients(spark, SF_SMALL)
    o = A.mart_orders(spark, SF_SMALL)
    p = A.mart_products(spark, SF_SMALL)
    i = MT.resolve_product_ids(A.mart_items(spark, SF_SMALL), p)
    rep = {r.rule: r.violations for r in MT.quality_report(c, o, p, i).collect()}
    assert rep["orders.client_id_orphan"] == 0
    assert rep["order_items.order_id_orphan"] == 0
    assert rep["products.name_variant_duplicate"] == 0


def test_client_summary_includes_clients_without_orders(spark):
    c = A.mart_clients(spark, SF_SMALL)
    o = A.mart_orders(spark, SF_SMALL)
    s = R.client_summary(c, o)
    assert s.count() == c.count()
    assert s.filter(F.col("total_orders") == 0).count() > 0


def test_clients_by_phone_digits(spark):
    c = clients_fixture(spark).withColumn("created_at", F.lit(TS).cast("timestamp_ntz"))
    lk = spark.createDataFrame([("57 3001",), ("999",)], "p string")
    out = {r.p: r.client_id for r in MT.clients_by_phone(c, lk, "p").collect()}
    assert out == {"57 3001": "c1", "999": None}


def test_items_are_not_dealt_out_by_product(spark):
    from chatledger.plans.queries import QUERIES
    from tests.conftest import SF_SMALL

    limit = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(limit)
    spark.conf.set(limit, "20k")  # below the items, above the products
    try:
        for name in ("item_product_id", "upsert_items"):
            df = QUERIES[name](spark, SF_SMALL)
            assert "hashpartitioning(product_name" not in df._jdf.queryExecution().executedPlan().toString(), name
    finally:
        spark.conf.set(limit, was)
