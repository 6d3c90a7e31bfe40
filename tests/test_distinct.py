"""Distinct counts by bitmaps and sketches: equal to counting, mergeable, and no ids shuffled."""

from __future__ import annotations

import random

import pytest
from build import mapping, sale, star_of
from pyspark.sql import functions as F

from tallymart.plans import distinct, kpi


def many(spark, rows: int, seed: int):
    """Sales with keys over two bitmap buckets, months with gaps, and a customer with a third of all."""
    rng = random.Random(seed)
    sales = [
        sale(
            f"o{seed}-{k}", f"20{rng.choice('18 19'.split())}-{rng.choice('01 02 03 11 12'.split())}-0{rng.randrange(1, 9)}",
            customer=rng.choice([7, rng.randrange(1, 60), 32_760 + rng.randrange(20)]), product=rng.randrange(1, 4),
            status=rng.choice(["Success", "Success", "Failed"]), channel=rng.choice(["Web", "Mobile"]),
        )
        for k in range(rows)
    ]
    return star_of(spark, sales)


@pytest.mark.parametrize("cross_year", [False, True])
def test_retention_has_the_rows_of_the_exact_one(spark, cross_year):
    for rows, seed in ((1, 1), (40, 2), (400, 3)):
        star = many(spark, rows, seed)
        assert distinct.retention(star, cross_year).collect() == kpi.retention(star, cross_year).collect()
    empty = star._replace(fact_orders=star.fact_orders.limit(0))
    assert distinct.retention(empty).count() == 0


def test_customers_and_null_keys(spark):
    star = many(spark, 300, 4)
    paid = star.fact_orders.where("payment_status = 'Success'")
    want = mapping(paid.groupBy("channel").agg(F.countDistinct("customer_key").alias("n")), "channel", "n")
    lost = star._replace(fact_orders=star.fact_orders.unionByName(star.fact_orders.withColumn("customer_key", F.lit(None).cast("long"))))
    for each in (star, lost):
        assert mapping(distinct.customers_by_channel(each), "channel", "customers") == want


def test_stored_bitmaps_of_two_builds_merge(spark, tmp_path):
    first, second = many(spark, 200, 5), many(spark, 200, 6)
    both = first._replace(fact_orders=first.fact_orders.unionByName(second.fact_orders),
                          dim_date=first.dim_date.unionByName(second.dim_date).distinct())
    for k, star in enumerate((first, second)):
        distinct.customer_bitmaps(star).write.parquet(f"{tmp_path}/bitmaps/{k}")
        distinct.order_sketches(star).write.parquet(f"{tmp_path}/sketches/{k}")
    bitmaps = spark.read.parquet(f"{tmp_path}/bitmaps/*")
    assert distinct.retention(both, bitmaps=bitmaps).collect() == kpi.retention(both).collect()
    sketches = spark.read.parquet(f"{tmp_path}/sketches/*")
    exact = mapping(distinct.orders_by_category(both), "category", "orders")
    about = mapping(distinct.orders_by_category(both, sketches), "category", "orders_about")
    assert exact == about  # few orders are counted exactly


def test_no_customer_is_shuffled(spark, sf_dir):
    """Bitmaps cross the exchanges, customer keys do not."""
    from checks import stars

    star = stars.star(spark, sf_dir, "graded")
    for report in (distinct.retention(star), distinct.customers_by_month(star), distinct.customers_by_channel(star)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert dealt and not any("customer_key" in line for line in dealt)
        assert "SortMergeJoin" not in plan and "bitmap_construct_agg" in plan


def test_sketch_error_on_many_orders(spark):
    """200,000 orders: within three standard errors, for sketches of two sizes."""
    orders = spark.range(200_000).selectExpr("concat('o', id) AS order_id", "id % 40 AS day")
    for bits in (10, distinct.SKETCH_BITS):
        stored = orders.groupBy("day").agg(F.hll_sketch_agg("order_id", bits).alias("sketch"))
        about = distinct.approximate_orders(stored).first()["orders_about"]
        assert abs(about - 200_000) <= 3 * 0.83 / 2 ** (bits / 2) * 200_000
