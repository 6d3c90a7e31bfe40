from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart.operators import dense_keys, keep_first
from tallymart.plans import load, quality
from tallymart.plans import star as etl
from tallymart.rules import Rules

from build import item, mapping, order, raw_tables, values


def test_status_of_every_kind(spark):
    statuses = {"o1": "delivered", "o2": "shipped", "o3": "canceled", "o4": None}
    raw = raw_tables(
        spark,
        orders=[order(k, status=v) for k, v in statuses.items()],
        order_items=[item(k) for k in statuses],
    )
    assert mapping(etl.build_fact(raw), "order_id", "payment_status") == {
        "o1": "Success", "o2": "Failed", "o3": "Failed", "o4": "Failed",
    }


def test_channel_of_every_payment(spark):
    kinds = {"o1": "credit_card", "o2": "boleto", "o3": "voucher", "o4": None}
    raw = raw_tables(
        spark,
        orders=[order(k) for k in [*kinds, "o5"]],
        order_items=[item(k) for k in [*kinds, "o5"]],
        payments=[(k, 1, v, Decimal("1.00")) for k, v in kinds.items()],
    )
    assert mapping(etl.build_fact(raw), "order_id", "channel") == {
        "o1": "Web", "o2": "Mobile", "o3": "Other", "o4": "Unknown", "o5": "Unknown",
    }


def test_first_payment_skips_untyped(spark):
    raw = raw_tables(
        spark,
        payments=[
            ("o1", 3, "credit_card", Decimal("1.00")),
            ("o1", 2, "boleto", Decimal("2.00")),
            ("o1", 1, None, Decimal("4.00")),
        ],
    )
    assert values(etl.payments_by_order(raw), "payment_type", "payment_value") == [
        ("boleto", Decimal("7.00"))
    ]


def test_repeated_item_keeps_first_in_order(spark):
    raw = raw_tables(
        spark,
        orders=[order("o1")],
        order_items=[item("o1", 1, "p2", "1.00"), item("o1", 1, "p1", "9.00"), item("o1", 2, "p3")],
    )
    assert sorted(values(etl.build_fact(raw), "product_id", "revenue")) == [
        ("p1", Decimal("1.80")), ("p3", Decimal("2.00")),
    ]


def test_repeated_order_does_not_multiply_items(spark):
    raw = raw_tables(
        spark,
        orders=[order("o1", placed="2020-02-01 00:00:00"), order("o1", placed="2020-01-01 00:00:00")],
        order_items=[item("o1")],
    )
    assert values(etl.build_fact(raw), "order_date") == [(dt.date(2020, 1, 1),)]


def test_unusable_items_are_dropped(spark):
    raw = raw_tables(
        spark,
        orders=[order("o1"), order("o2", customer=None), order("o3", placed=None)],
        order_items=[
            item("o1", 1, price=None), item("o1", 2, price="0.00"), item("o1", 3, product=None),
            item("o1", 4), item("o2"), item("o3"), item("nowhere"),
        ],
    )
    assert etl.build_fact(raw).count() == 1
    audit = mapping(quality.etl_audit(raw), "stage", "n_rows")
    assert audit["items_unique"] == 7
    assert audit["items_incomplete"] == 4
    assert audit["fact_orders"] == 1
    assert audit["items_repeated"] == 0


def test_money_columns(spark):
    raw = raw_tables(spark, orders=[order("o1")], order_items=[item("o1", price="12.34")])
    assert values(etl.build_fact(raw), "quantity", "revenue", "cost", "profit") == [
        (1, Decimal("2.47"), Decimal("1.48"), Decimal("0.99"))
    ]
    dearer = Rules(currency_rate=Decimal("0.50"), cost_ratio=Decimal("0.9"))
    assert values(etl.build_fact(raw, dearer), "revenue", "cost", "profit") == [
        (Decimal("6.17"), Decimal("5.55"), Decimal("0.62"))
    ]


def test_segments_by_order_count(spark):
    wanted = {"c0": 0, "c1": 1, "c2": 2, "c5": 5, "c6": 6}
    raw = raw_tables(
        spark,
        orders=[order(f"{c}-{i}", customer=c) for c, n in wanted.items() for i in range(n)],
        customers=[(c, "u", "town", "SP") for c in wanted],
    )
    dim = etl.build_dim_customer(raw)
    assert mapping(dim, "customer_id", "segment") == {
        "c0": "New", "c1": "New", "c2": "Returning", "c5": "Returning", "c6": "VIP",
    }
    assert mapping(dim, "customer_id", "signup_date")["c0"] is None
    assert mapping(dim, "customer_id", "customer_key") == {
        "c0": 1, "c1": 2, "c2": 3, "c5": 4, "c6": 5,
    }


def test_categories_and_prices(spark):
    raw = raw_tables(
        spark,
        products=[("p1", "beleza"), ("p2", None), ("p3", "unknown"), ("p1", "beleza")],
        category_translation=[("beleza", "beauty")],
        order_items=[item("o1", 1, "p1", "0.05"), item("o1", 1, "p1", "0.10"), item("o2", 1, "p3", "9.99")],
    )
    rows = values(
        etl.build_dim_product(raw), "product_key", "product_id", "category", "brand",
        "unit_price", "unit_cost",
    )
    assert sorted(rows) == [
        (1, "p1", "beauty", "Generic", Decimal("0.02"), Decimal("0.01")),
        (2, "p2", "Other", "Generic", None, None),
        (3, "p3", "Other", "Generic", Decimal("2.00"), Decimal("1.20")),
    ]


def test_date_dimension(spark):
    raw = raw_tables(
        spark,
        orders=[
            order("o1", placed="2016-09-04 21:15:19"), order("o2", placed="2016-09-04 01:00:00"),
            order("o3", placed="2017-12-31 23:59:59"), order("o4", placed=None),
        ],
    )
    rows = values(
        etl.build_dim_date(raw), "date_key", "date", "year", "month", "quarter", "weekday"
    )
    assert sorted(rows) == [
        (20160904, dt.date(2016, 9, 4), 2016, 9, 3, "Sunday"),
        (20171231, dt.date(2017, 12, 31), 2017, 12, 4, "Sunday"),
    ]


def test_load_drops_rows_without_keys(spark):
    raw = raw_tables(
        spark,
        orders=[order("o1"), order("o2", customer="stranger")],
        order_items=[item("o1"), item("o1", 2, "missing"), item("o2")],
        customers=[("c1", "u", "town", "SP")],
        products=[("p1", None)],
    )
    clean = etl.build_clean(raw)
    assert load.map_keys(clean).count() == 3
    loaded = load.load_fact(clean)
    assert values(loaded, "order_id", "order_date_key", "customer_key", "product_key") == [
        ("o1", 20200115, 1, 1)
    ]
    assert loaded.exceptAll(etl.build_star(raw).fact_orders).count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_dense_keys_do_not_depend_on_partitions(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        ids = spark.range(0, 5000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))
        got = values(dense_keys(ids, "id", "key"), "key", "id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    ordered = sorted(r.id for r in ids.collect())
    assert sorted(got) == list(enumerate(ordered, start=1))


def test_dense_keys_of_nothing(spark):
    assert dense_keys(spark.createDataFrame([], "id string"), "id", "key").count() == 0


def test_keep_first_limits_groups_before_the_shuffle(spark):
    copies = spark.range(20000).select((F.col("id") % 2).alias("k"), (F.col("id") % 7).alias("v"))
    first = keep_first(copies, ["k"], ["v"])
    assert sorted(values(first, "k", "v")) == [(0, 0), (1, 0)]
    plan = first._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_orders_left_join_keeps_items_without_order(spark):
    raw = raw_tables(spark, orders=[order("o1")], order_items=[item("o1"), item("none")])
    got = mapping(etl.items_with_orders(raw), "order_id", "order_status")
    assert got == {"o1": "delivered", "none": None}


def test_fact_join_needs_no_outer_join(spark, sf_dir):
    from checks import stars

    plan = etl.build_fact(stars.raw(spark, sf_dir, "plain"))._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().splitlines() if "Join " in line]
    # Only the payments of an order may be missing.
    assert sum("LeftOuter" in line for line in joins) == 1
