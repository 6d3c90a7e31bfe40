"""Key performance indicators over the star.

Counting follows the reports these stand for: where a column is called
total_orders or order_count it counts order items unless the docstring says
distinct orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mean, percent
from ..operators import top_ranked
from ..rules import DEFAULT_RULES, Rules
from ..sources.star import Star
from .totals import (
    category_totals,
    channel_totals,
    customer_sums,
    customer_totals,
    dated,
    margin,
    monthly_channel_totals,
    monthly_totals,
    orders_of,
    overall_totals,
    paid_items,
)


#: Longer lists are ranked by ranges, not gathered and sorted by one task.
LONG_LIST = 100_000


def _desc(name: str) -> Column:
    return F.col(name).desc()


# -- executive ---------------------------------------------------------------


def revenue(star: Star) -> DataFrame:
    return overall_totals(star).select(
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        margin().alias("profit_margin_pct"),
    )


def success_rate(star: Star) -> DataFrame:
    return overall_totals(star).select(
        F.col("items").alias("total_orders"),
        F.col("paid_items").alias("successful_orders"),
        percent(F.col("paid_items"), F.col("items")).alias("success_rate_pct"),
    )


def executive(star: Star) -> DataFrame:
    """Revenue, profit, margin and success rate in one pass over the fact."""
    return overall_totals(star).select(
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        margin().alias("profit_margin"),
        percent(F.col("paid_items"), F.col("items")).alias("order_success_rate"),
        F.col("items").alias("total_orders"),
        F.col("paid_items").alias("successful_orders"),
    )


# -- operational -------------------------------------------------------------


def retention(star: Star, cross_year: bool = False) -> DataFrame:
    """Share of a month's customers who also bought in the month before.

    The month before January is not looked up unless ``cross_year`` is set.
    Works on distinct customer months, so a customer's group holds at most one
    row per calendar month.
    """
    month_no = F.col("year") * 12 + F.col("month")
    seen = (
        dated(paid_items(star), star)
        .select("customer_key", "year", "month", month_no.alias("month_no"))
        .distinct()
    )
    previous = F.lag("month_no").over(Window.partitionBy("customer_key").orderBy("month_no"))
    kept = previous == F.col("month_no") - 1
    if not cross_year:
        kept = kept & (F.col("month") > 1)
    months = (
        seen.withColumn("_kept", kept)
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("current_customers"),
            F.count_if("_kept").alias("retained_customers"),
        )
    )
    rate = percent(F.col("retained_customers"), F.col("current_customers"))
    return months.withColumn("retention_rate_pct", rate).orderBy("year", "month")


def failed_by_channel(star: Star) -> DataFrame:
    return (
        channel_totals(star)
        .select(
            "channel",
            F.col("items").alias("total_orders"),
            F.col("failed_items").alias("failed_orders"),
            percent(F.col("failed_items"), F.col("items")).alias("failed_payment_pct"),
        )
        .orderBy(_desc("failed_payment_pct"), "channel")
    )


def order_value(star: Star) -> DataFrame:
    """Mean, smallest and largest value of a paid item."""
    sums = paid_items(star).agg(
        F.sum("revenue").alias("revenue"),
        F.count("*").alias("items"),
        F.min("revenue").alias("min_order_value"),
        F.max("revenue").alias("max_order_value"),
    )
    return sums.select(
        mean(F.col("revenue"), F.col("items")).alias("avg_order_value"),
        "min_order_value",
        "max_order_value",
    )


def revenue_per_customer(star: Star) -> DataFrame:
    """Per segment, over customers with a paid item."""
    segments = (
        customer_sums(star)
        .join(star.dim_customer.select("customer_key", "segment"), "customer_key")
        .groupBy("segment")
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("items").alias("items"),
            F.sum("revenue").alias("total_revenue"),
        )
    )
    return segments.select(
        "segment",
        "customer_count",
        "total_revenue",
        mean(F.col("total_revenue"), F.col("items")).alias("avg_revenue_per_order"),
        mean(F.col("total_revenue"), F.col("customer_count")).alias("revenue_per_customer"),
    ).orderBy(_desc("revenue_per_customer"), "segment")


def revenue_by_category(star: Star, limit: int = DEFAULT_RULES.category_limit) -> DataFrame:
    """Top categories by revenue."""
    return (
        category_totals(star)
        .select(
            "category",
            F.col("items").alias("order_count"),
            F.col("revenue").alias("total_revenue"),
            F.col("profit").alias("total_profit"),
            margin().alias("profit_margin_pct"),
        )
        .orderBy(_desc("total_revenue"), "category")
        .limit(limit)
    )


# -- trends ------------------------------------------------------------------


def monthly_trend(star: Star) -> DataFrame:
    """Distinct paid orders, revenue, profit and margin per month."""
    return monthly_totals(star).select(
        "year",
        "month",
        F.col("orders").alias("order_count"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        margin().alias("profit_margin_pct"),
    ).orderBy("year", "month")


def channel_by_month(star: Star) -> DataFrame:
    """Items, revenue and failure share per month and channel, paid or not."""
    return (
        monthly_channel_totals(star)
        .select(
            "year",
            "month",
            "channel",
            F.col("items").alias("order_count"),
            "revenue",
            percent(F.col("failed_items"), F.col("items")).alias("failed_pct"),
        )
        .orderBy("year", "month", "channel")
    )


# -- dashboard API -----------------------------------------------------------


def average_order_value(star: Star) -> DataFrame:
    return order_value(star).select("avg_order_value")


def segment_revenue_per_customer(star: Star) -> DataFrame:
    return revenue_per_customer(star).select("segment", "revenue_per_customer")


def channel_failed_payments(star: Star) -> DataFrame:
    return failed_by_channel(star).select("channel", "failed_payment_pct")


def operational(star: Star) -> dict[str, DataFrame]:
    return {
        "avg_order_value": average_order_value(star),
        "revenue_per_customer": segment_revenue_per_customer(star),
        "failed_payments": channel_failed_payments(star),
    }


def monthly_trends(star: Star) -> DataFrame:
    """The monthly trend with a ``YYYY-MM`` label."""
    label = F.format_string("%d-%02d", "year", "month")
    return monthly_trend(star).withColumn("year_month", label)


def category_performance(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return revenue_by_category(star, rules.category_api_limit)


def customer_segments(star: Star) -> DataFrame:
    """All customers of a segment, with the distinct orders and revenue of those who paid."""
    segments = (
        star.dim_customer.select("customer_key", "segment")
        .join(customer_totals(star), "customer_key", "left")
        .groupBy("segment")
        .agg(
            F.count("*").alias("customer_count"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("order_count"),
            F.sum("items").alias("items"),
            F.sum("revenue").alias("total_revenue"),
        )
    )
    return segments.select(
        "segment",
        "customer_count",
        "order_count",
        "total_revenue",
        mean(F.col("total_revenue"), F.col("items")).alias("avg_order_value"),
    ).orderBy(_desc("total_revenue"), "segment")


def channel_performance(star: Star) -> DataFrame:
    return (
        channel_totals(star)
        .select(
            "channel",
            F.col("items").alias("total_orders"),
            F.col("paid_items").alias("successful_orders"),
            F.col("paid_revenue").alias("revenue"),
            percent(F.col("failed_items"), F.col("items")).alias("failure_rate_pct"),
        )
        .orderBy(_desc("revenue"), "channel")
    )


def top_customers(
    star: Star, limit: int = DEFAULT_RULES.customer_limit, with_profit: bool = False
) -> DataFrame:
    """Customers with the most paid revenue, ties by customer id.

    A list too long for one task (over LONG_LIST) is ranked by ranges.
    """
    customers = star.dim_customer.select("customer_key", "customer_id", "segment", "country")
    known = customer_sums(star).join(customers, "customer_key")
    if limit > LONG_LIST:
        best = top_ranked(known, "revenue", "customer_id", limit, "place").drop("place")
    else:
        best = known.orderBy(_desc("revenue"), "customer_id").limit(limit)
    profit = [F.col("profit").alias("total_profit")] if with_profit else []
    return (
        orders_of(star, best, "customer_key", limit)
        .select(
            "customer_id",
            "segment",
            "country",
            "order_count",
            F.col("revenue").alias("total_revenue"),
            *profit,
            mean(F.col("revenue"), F.col("items")).alias("avg_order_value"),
        )
        .orderBy(_desc("total_revenue"), "customer_id")
    )
