"""Plans and results that have to hold when keys are skewed and dimensions are large."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from checks import stars
from checks.catalog import comparable
from tallymart.plans import insights, kpi, load, quality, questions
from tallymart.plans import star as etl
from tallymart.sources.raw import RawTables


@contextmanager
def settings(spark, **values):
    names = {key: key.replace("__", ".") for key in values}
    before = {name: spark.conf.get(name, None) for name in names.values()}
    for key, name in names.items():
        spark.conf.set(name, values[key])
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# No size-based broadcast, and partitions counted as skewed from a few KB on.
LARGE = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="24k",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__adaptive__coalescePartitions__minPartitionSize="4k",
)


def _rows(df):
    return sorted(map(tuple, comparable(df).collect()), key=repr)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_raw(spark) -> RawTables:
    """30,000 items; a third of them in one order, of one product and one customer each."""
    n, orders, products, customers = 30000, 6000, 500, 700

    def pick(column, salt, size, hot):
        drawn = F.pmod(F.xxhash64(column + salt), F.lit(size))
        return F.when(F.pmod(F.xxhash64(column + salt + 1), F.lit(3)) == 0, hot).otherwise(drawn)

    i = F.col("id")
    day = F.pmod(F.xxhash64(i + 70), F.lit(200)).cast("int")
    return RawTables(
        orders=spark.range(orders).select(
            i.alias("order_id"),
            pick(i, 10, customers, 7).alias("customer_id"),
            F.date_add(F.lit("2020-11-01").cast("date"), day)
            .cast("timestamp_ntz")
            .alias("order_purchase_timestamp"),
            F.when(F.pmod(i, F.lit(9)) == 0, "canceled").otherwise("delivered").alias("order_status"),
        ),
        # Each item twice, with different prices.
        order_items=spark.range(2 * n).select(
            pick(i % n, 20, orders, 11).alias("order_id"),
            (i % n).cast("int").alias("order_item_id"),
            pick(i % n, 30, products, 5).alias("product_id"),
            (F.pmod(F.xxhash64(i), F.lit(9000)) / 100 + 1).cast("decimal(18,2)").alias("price"),
        ),
        customers=spark.range(customers).select(
            i.alias("customer_id"), F.lit("u").alias("customer_unique_id"),
            F.lit("town").alias("customer_city"), F.lit("SP").alias("customer_state"),
        ),
        products=spark.range(products).select(
            i.alias("product_id"),
            F.concat(F.lit("c"), i % 10).alias("product_category_name"),
        ),
        payments=spark.range(orders).select(
            i.alias("order_id"), F.lit(1).alias("payment_sequential"),
            F.when(i % 4 == 0, "boleto").otherwise("credit_card").alias("payment_type"),
            F.lit(1).cast("decimal(18,2)").alias("payment_value"),
        ),
        category_translation=spark.range(8).select(
            F.concat(F.lit("c"), i).alias("product_category_name"),
            F.concat(F.lit("en"), i).alias("product_category_name_english"),
        ),
    )


def test_hot_keys_are_split_and_give_the_same_star(spark, hot_raw):
    small = _rows(etl.build_star(hot_raw).fact_orders)
    assert len(small) == 30000
    with settings(spark, **LARGE, spark__sql__shuffle__partitions="32"):
        fact = etl.build_star(hot_raw).fact_orders
        # Items by product, orders by customer, items by order.
        assert _final_plan(fact).split("Initial Plan")[0].count("skew=true") == 3
        assert _rows(fact) == small
        assert _rows(load.load_fact(etl.build_clean(hot_raw))) == small


REPORTS = [
    kpi.retention, kpi.revenue_per_customer, kpi.revenue_by_category, kpi.monthly_trend,
    kpi.channel_by_month, kpi.customer_segments, kpi.top_customers, questions.product_margin,
    questions.segment_churn, questions.category_recommendation, questions.category_mix,
    insights.generate, quality.validation_report,
]


@pytest.mark.parametrize("report", REPORTS, ids=lambda r: f"{r.__module__}.{r.__name__}")
def test_reports_do_not_depend_on_partitioning(spark, sf_dir, report):
    star = stars.star(spark, sf_dir, "graded")
    usual = _rows(report(star))
    with settings(spark, **LARGE, spark__sql__shuffle__partitions="3"):
        assert _rows(report(star)) == usual


@pytest.mark.parametrize("build", [etl.build_dim_customer, etl.build_dim_product])
def test_dimensions_do_not_depend_on_partitioning(spark, sf_dir, build):
    raw = stars.raw(spark, sf_dir, "graded")
    usual = _rows(build(raw))
    with settings(spark, **LARGE, spark__sql__shuffle__partitions="5"):
        assert _rows(build(raw)) == usual


@pytest.mark.parametrize(
    "report",
    [kpi.revenue_by_category, kpi.revenue_per_customer, kpi.top_customers, kpi.executive],
    ids=lambda r: r.__name__,
)
def test_fact_is_summed_before_any_shuffle(spark, sf_dir, report):
    """Below the lowest exchange on the fact's side there is a partial aggregate."""
    star = stars.star(spark, sf_dir, "graded")
    with settings(spark, **LARGE, spark__sql__adaptive__enabled="false"):
        lines = report(star)._jdf.queryExecution().executedPlan().toString().splitlines()
    scans = [k for k, line in enumerate(lines) if "FileScan" in line and "payment_status" in line]
    assert scans
    for k in scans:
        above = next(j for j in range(k, -1, -1) if "Exchange" in lines[j])
        assert any("HashAggregate" in line and "partial" in line or "keys=[" in line
                   for line in lines[above:k]), lines[above:k]
        assert "SortMergeJoin" not in "".join(lines[above:k])
    assert not any("CartesianProduct" in line or "NestedLoop" in line for line in lines)


def test_scans_read_only_what_a_report_needs(spark, sf_dir):
    star = stars.star(spark, sf_dir, "graded")
    plan = kpi.monthly_trend(star)._jdf.queryExecution().executedPlan().toString()
    fact = next(line for line in plan.splitlines() if "payment_status" in line and "FileScan" in line)
    assert "EqualTo(payment_status,Success)" in fact
    assert "cost" not in fact and "customer_key" not in fact and "channel" not in fact
