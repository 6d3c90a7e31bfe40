"""Rule-based insights.  Each rule returns records of one shape; ``generate`` unites them.

Rules work on report-sized totals (a row per category, channel or segment), so
numbering their records needs no distribution.
"""

from __future__ import annotations

from functools import reduce
from string import Formatter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent
from ..operators import numbered
from ..rules import DEFAULT_RULES, Rules
from ..sources.star import Star
from .totals import category_totals, channel_totals, margin, one_time_customers

COLUMNS = ["rule_order", "rank", "type", "category", "title", "message", "severity"]

# Record texts and severities.
HIGH, MEDIUM, LOW = "high", "medium", "low"
PRODUCT_PERFORMANCE = ("warning", "Product Performance")
PAYMENT_OPERATIONS = ("alert", "Payment Operations")
CUSTOMER_RETENTION = ("info", "Customer Retention")
CATEGORY_MANAGEMENT = ("recommendation", "Category Management")
TOP_PERFORMERS = ("success", "Top Performers")
LOW_MARGIN_TITLE = "Low Margin Alert: {category}"
LOW_MARGIN_TEXT = (
    "Category '{category}' has {margin}% margin (below {threshold}% threshold)"
    " with ${revenue} revenue"
)
FAILURE_TITLE = "High Failure Rate: {channel} Channel"
FAILURE_TEXT = "{channel} channel has {rate}% payment failure rate, losing ${lost} in revenue"
RETENTION_TITLE = "Retention Concern: {segment} Segment"
RETENTION_TEXT = "{share}% of {segment} customers ({customers}) made only one purchase"
REVIEW_TITLE = "Categories to Review for Discontinuation"
REVIEW_TEXT = "Consider reviewing these low-revenue, low-margin categories: {categories}"
TOP_TITLE = "Top Category: {category}"
TOP_TEXT = "Generated ${revenue} in revenue with ${profit} profit"


def _text(template: str, **values: Column) -> Column:
    """Fill a template's ``{name}`` places with string columns."""
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        pieces += [F.lit(literal)] if literal else []
        pieces += [values[name]] if name else []
    return F.concat(*pieces)


def _number(value: Column, decimals: int = 0) -> Column:
    """Thousands separators, half-even on the double, as printed reports do."""
    return F.format_number(value.cast("double"), decimals)


def _records(
    df: DataFrame, rule_order: int, kind: tuple[str, str], title: Column, message: Column,
    severity: Column,
) -> DataFrame:
    return df.select(
        F.lit(rule_order).alias("rule_order"),
        "rank",
        F.lit(kind[0]).alias("type"),
        F.lit(kind[1]).alias("category"),
        title.alias("title"),
        message.alias("message"),
        severity.alias("severity"),
    )


def low_margin(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Categories whose rounded margin is under the threshold."""
    limit = rules.low_margin_pct
    found = (
        category_totals(star)
        .withColumn("margin", margin())
        .where(F.col("margin") < F.lit(limit))
    )
    found = numbered(found, [F.col("revenue").desc(), F.col("category")], "rank")
    return _records(
        found,
        1,
        PRODUCT_PERFORMANCE,
        _text(LOW_MARGIN_TITLE, category=F.col("category")),
        _text(
            LOW_MARGIN_TEXT,
            category=F.col("category"),
            margin=_number(F.col("margin"), 1),
            threshold=F.lit(str(float(limit))),
            revenue=_number(F.col("revenue")),
        ),
        F.when(F.col("margin") < F.lit(limit / 2), HIGH).otherwise(MEDIUM),
    )


def failed_payments(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Channels whose rounded share of failed items is over the threshold."""
    limit = rules.failed_payment_pct
    found = (
        channel_totals(star)
        .withColumn("rate", percent(F.col("failed_items"), F.col("items")))
        .where(F.col("rate") > F.lit(limit))
    )
    found = numbered(found, [F.col("rate").desc(), F.col("channel")], "rank")
    return _records(
        found,
        2,
        PAYMENT_OPERATIONS,
        _text(FAILURE_TITLE, channel=F.col("channel")),
        _text(
            FAILURE_TEXT,
            channel=F.col("channel"),
            rate=_number(F.col("rate"), 1),
            lost=_number(F.col("failed_revenue")),
        ),
        F.when(F.col("rate") > F.lit(limit * 2), HIGH).otherwise(MEDIUM),
    )


def customer_retention(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Segments in which too many of all customers bought exactly once."""
    segments = (
        star.dim_customer.select("customer_key", "segment")
        .join(one_time_customers(star), "customer_key", "left")
        .groupBy("segment")
        .agg(F.count("*").alias("customers"), F.count_if("one_time").alias("one_time"))
        .withColumn("share", percent(F.col("one_time"), F.col("customers")))
        .where(F.col("share") > F.lit(rules.one_time_pct))
    )
    found = numbered(segments, [F.col("share").desc(), F.col("segment")], "rank")
    return _records(
        found,
        3,
        CUSTOMER_RETENTION,
        _text(RETENTION_TITLE, segment=F.col("segment")),
        _text(
            RETENTION_TEXT,
            share=_number(F.col("share"), 1),
            segment=F.col("segment"),
            customers=F.format_number("one_time", 0),
        ),
        F.lit(MEDIUM),
    )


def category_review(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One record naming the weakest categories, lowest revenue first; none if there are none."""
    by_revenue = Window.orderBy("revenue")
    weakest = (
        category_totals(star)
        .select("category", "revenue", margin().alias("margin"))
        .withColumn("place", F.percent_rank().over(by_revenue))
        .where(F.col("place") < rules.review_revenue_rank)
        .where(F.col("margin") < F.lit(rules.review_margin_pct))
        .orderBy("revenue", "category")
        .limit(rules.review_limit)
    )
    listed = weakest.agg(
        F.array_sort(F.collect_list(F.struct("revenue", "category")))["category"].alias("names")
    ).where(F.size("names") > 0)
    return _records(
        listed.withColumn("rank", F.lit(1)),
        4,
        CATEGORY_MANAGEMENT,
        F.lit(REVIEW_TITLE),
        _text(REVIEW_TEXT, categories=F.array_join("names", ", ")),
        F.lit(LOW),
    )


def top_category(star: Star) -> DataFrame:
    """The category with the most revenue; none for an empty warehouse."""
    best = category_totals(star).orderBy(F.col("revenue").desc(), "category").limit(1)
    return _records(
        best.withColumn("rank", F.lit(1)),
        5,
        TOP_PERFORMERS,
        _text(TOP_TITLE, category=F.col("category")),
        _text(TOP_TEXT, revenue=_number(F.col("revenue")), profit=_number(F.col("profit"))),
        F.lit(LOW),
    )


def generate(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Records of all rules, in rule order."""
    parts = [
        low_margin(star, rules),
        failed_payments(star, rules),
        customer_retention(star, rules),
        category_review(star, rules),
        top_category(star),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("rule_order", "rank")


def summary(insights: DataFrame) -> DataFrame:
    """Number of records, in total and per severity."""
    return insights.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("severity") == level).alias(level) for level in (HIGH, MEDIUM, LOW)],
    )
