"""Business questions: margins, churn, failing channels, categories to drop."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mean, percent, tier
from ..operators import percent_ranks
from ..rules import DEFAULT_RULES, Rules
from ..sources.star import Star
from . import kpi
from .totals import (
    category_and_total_orders,
    category_orders,
    category_totals,
    channel_totals,
    dated,
    margin,
    orders_of,
    paid_items,
    product_totals,
)

# Tier labels and the percentages that separate them.
MARGIN_TIERS = ((10, "LOW MARGIN"), (20, "MEDIUM MARGIN"), "HEALTHY MARGIN")
CHURN_TIERS = ((70, "HIGH CHURN"), (50, "MODERATE CHURN"), "LOW CHURN")
FAILURE_TIERS = ((5, "HIGH FAILURE"), (2, "MODERATE FAILURE"), "LOW FAILURE")
DISCONTINUE = "DISCONTINUE - Low margin, low revenue"
REVIEW_MARGIN = "REVIEW - Low margin"
REVIEW_REVENUE = "REVIEW - Low revenue"
KEEP = "KEEP"
DISCONTINUE_MARGIN, DISCONTINUE_RANK = 10, 0.7
REVIEW_MARGIN_BELOW, REVIEW_RANK = 15, 0.8


def _share_above(part: str, whole: str, pct: int) -> Column:
    """part / whole > pct percent, without rounding."""
    return F.col(part) * F.lit(Decimal(100)) > F.col(whole) * F.lit(Decimal(pct))


def _share_below(part: str, whole: str, pct: int) -> Column:
    return F.col(part) * F.lit(Decimal(100)) < F.col(whole) * F.lit(Decimal(pct))


def product_margin(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Products that sell well, with their margin tier; the tier tests the unrounded margin."""
    *steps, healthy = MARGIN_TIERS
    best = (
        product_totals(star)
        .where(F.col("revenue") > F.lit(rules.min_product_revenue))
        .withColumn("profit_margin_pct", margin())
        .orderBy(F.col("revenue").desc(), "profit_margin_pct", "product_id")
        .limit(rules.product_limit)
    )
    status = [(_share_below("profit", "revenue", pct), label) for pct, label in steps]
    return (
        orders_of(star, best, "product_key", rules.product_limit)
        .select(
            "product_id",
            "category",
            "order_count",
            F.col("revenue").alias("total_revenue"),
            F.col("profit").alias("total_profit"),
            "profit_margin_pct",
            tier(status, healthy).alias("margin_status"),
        )
        .orderBy(F.col("total_revenue").desc(), "profit_margin_pct", "product_id")
    )


def customer_activity(star: Star) -> DataFrame:
    """First and last day, distinct orders and days between, per customer with a paid item."""
    days = (
        dated(paid_items(star), star)
        .groupBy("customer_key")
        .agg(
            F.min("date").alias("first_order_date"),
            F.max("date").alias("last_order_date"),
            F.countDistinct("order_id").alias("total_orders"),
        )
    )
    return days.join(star.dim_customer.select("customer_key", "segment"), "customer_key").select(
        "customer_key",
        "segment",
        "first_order_date",
        "last_order_date",
        "total_orders",
        F.datediff("last_order_date", "first_order_date").alias("days_active"),
    )


def segment_churn(star: Star) -> DataFrame:
    """Share of a segment's buyers with exactly one order; the tier tests the rounded share."""
    *steps, low = CHURN_TIERS
    segments = (
        customer_activity(star)
        .groupBy("segment")
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("total_orders").alias("_orders"),
            F.sum("days_active").alias("_days"),
            F.count_if(F.col("total_orders") == 1).alias("one_time_customers"),
        )
    )
    customers = F.col("customer_count")
    churn = F.col("churn_rate_pct")
    return (
        segments.select(
            "segment",
            "customer_count",
            mean(F.col("_orders"), customers).alias("avg_orders_per_customer"),
            mean(F.col("_days"), customers, 0).alias("avg_days_active"),
            "one_time_customers",
            percent(F.col("one_time_customers"), customers).alias("churn_rate_pct"),
        )
        .withColumn("churn_status", tier([(churn > pct, label) for pct, label in steps], low))
        .orderBy(churn.desc(), "segment")
    )


def channel_failure(star: Star) -> DataFrame:
    """Failed payments and lost revenue per channel; the tier tests the unrounded share."""
    *steps, low = FAILURE_TIERS
    return (
        channel_totals(star)
        .select(
            "channel",
            F.col("items").alias("total_orders"),
            F.col("paid_items").alias("successful_orders"),
            F.col("failed_items").alias("failed_orders"),
            percent(F.col("failed_items"), F.col("items")).alias("failure_rate_pct"),
            F.col("paid_revenue").alias("successful_revenue"),
            F.col("failed_revenue").alias("lost_revenue"),
            tier(
                [(_share_above("failed_items", "items", pct), label) for pct, label in steps], low
            ).alias("failure_status"),
        )
        .orderBy(F.col("failure_rate_pct").desc(), "channel")
    )


def category_ranking(star: Star) -> DataFrame:
    """Category totals with percent ranks, best first, by revenue and by margin.

    The windows run over one row per category.
    """
    by_revenue = Window.orderBy(F.col("total_revenue").desc())
    by_margin = Window.orderBy(F.col("profit_margin_pct").desc())
    return (
        category_orders(star)
        .select(
            "category",
            F.col("orders").alias("order_count"),
            F.col("revenue").alias("total_revenue"),
            F.col("profit").alias("total_profit"),
            margin().alias("profit_margin_pct"),
            mean(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
        )
        .withColumn("revenue_percentile", F.percent_rank().over(by_revenue))
        .withColumn("margin_percentile", F.percent_rank().over(by_margin))
    )


def product_ranking(star: Star) -> DataFrame:
    """Paid products with percent ranks by revenue and by margin, best first.

    The catalogue may be large, so ranks come from ranges, not from one window.
    """
    ranked = product_totals(star).select(
        "product_id", "category", F.col("revenue").alias("total_revenue"),
        margin().alias("profit_margin_pct"),
    )
    ranked = percent_ranks(ranked, "total_revenue", "revenue_percentile")
    return percent_ranks(ranked, "profit_margin_pct", "margin_percentile")


def category_recommendation(star: Star) -> DataFrame:
    """What to do with each category, most urgent first."""
    margin_pct, rank = F.col("profit_margin_pct"), F.col("revenue_percentile")
    steps = [
        ((margin_pct < DISCONTINUE_MARGIN) & (rank > DISCONTINUE_RANK), DISCONTINUE),
        (margin_pct < REVIEW_MARGIN_BELOW, REVIEW_MARGIN),
        (rank > REVIEW_RANK, REVIEW_REVENUE),
    ]
    urgency = tier([(condition, i) for i, (condition, _) in enumerate(steps)], len(steps))
    return (
        category_ranking(star)
        .withColumn("recommendation", tier(steps, KEEP))
        .orderBy(urgency, F.col("total_revenue").desc(), "category")
        .drop("revenue_percentile", "margin_percentile")
    )


def top_customers(star: Star, limit: int = DEFAULT_RULES.customer_limit) -> DataFrame:
    return kpi.top_customers(star, limit, with_profit=True)


def category_mix(star: Star) -> DataFrame:
    """Products, distinct orders and revenue per category, with shares of the paid total.

    The order share is taken of all distinct orders, so shares may add up to
    more than 100: an order counts in each of its categories.
    """
    # One pass gives the categories and the total, a row more in the report; a sale
    # of an unknown product counts in the total only.
    products = category_totals(star).select("category", F.col("products").alias("product_count"))
    report = Window.partitionBy()
    of_total = lambda name: F.max(F.when(F.col("_total") == 1, F.col(name))).over(report)
    categories = (
        category_and_total_orders(star)
        .withColumns({"_all_orders": of_total("orders"), "_all_revenue": of_total("revenue")})
        .where((F.col("_total") == 0) & F.col("category").isNotNull())
    )
    return (
        categories.join(products, "category")
        .select(
            "category",
            "product_count",
            F.col("orders").alias("order_count"),
            F.col("revenue").alias("total_revenue"),
            percent(F.col("orders"), F.col("_all_orders")).alias("order_share_pct"),
            percent(F.col("revenue"), F.col("_all_revenue")).alias("revenue_share_pct"),
        )
        .orderBy(F.col("total_revenue").desc(), "category")
    )
