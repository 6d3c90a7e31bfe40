"""Dashboard payload and the small tables its page derives from the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import percent, tier
from ..operators import numbered
from ..rules import DEFAULT_RULES, Rules
from ..sources.star import Star
from . import insights, kpi

# Limits and labels of the page.
TOP_CATEGORIES = 10
FEED_LENGTH = 6
ALERT_PCT, DANGER_PCT = 5, 10
LOW_MARGIN_PCT, VERY_LOW_MARGIN_PCT = 10, 5
DANGER, WARNING, OK = "danger", "warning", "ok"
ID_LENGTH, ELLIPSIS = 12, "…"
BUBBLE_FACTOR, BUBBLE_BASE = 1.5, 8.0

# Payload field -> report column, in the order the page reads them.
TRENDS = {
    "year_month": "year_month", "revenue": "total_revenue",
    "profit": "total_profit", "orders": "order_count",
}
CATEGORIES = {
    "category": "category", "revenue": "total_revenue", "profit": "total_profit",
    "margin": "profit_margin_pct", "orders": "order_count",
}
SEGMENTS = {
    "segment": "segment", "customer_count": "customer_count", "order_count": "order_count",
    "revenue": "total_revenue", "avg_order_value": "avg_order_value",
}
CHANNELS = {
    "channel": "channel", "total_orders": "total_orders",
    "successful_orders": "successful_orders", "revenue": "revenue",
    "failure_rate": "failure_rate_pct",
}
KPIS = [
    "total_revenue", "total_profit", "profit_margin", "order_success_rate",
    "total_orders", "successful_orders",
]
CUSTOMER = [
    "customer_id", "segment", "country", "order_count", "total_revenue", "avg_order_value",
]
INSIGHT = ["type", "category", "title", "message", "severity"]


# -- payload -----------------------------------------------------------------


def _ordered_list(report: DataFrame, order_by: list[Column], fields: list[str]) -> DataFrame:
    """One row: the report as an array of structs in the given order."""
    placed = numbered(report, order_by, "_place")
    rows = F.array_sort(F.collect_list(F.struct("_place", F.struct(*fields).alias("row"))))
    return placed.agg(rows["row"].alias("rows"))


def _columns(report: DataFrame, order_by: list[Column], fields: dict[str, str]) -> Column:
    """The report as a struct of arrays, one array per payload field."""
    rows = _ordered_list(report, order_by, list(fields.values()))
    return rows.select(
        F.struct(*[F.col("rows")[source].alias(name) for name, source in fields.items()])
    ).scalar()


def _rows(report: DataFrame, order_by: list[Column], fields: list[str]) -> Column:
    return _ordered_list(report, order_by, fields).scalar()


def payload(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One nested row with everything the page shows."""
    spark = star.fact_orders.sparkSession
    by_revenue = [F.col("total_revenue").desc()]
    return spark.range(1).select(
        kpi.executive(star).select(F.struct(*KPIS)).scalar().alias("kpis"),
        _columns(kpi.monthly_trends(star), [F.col("year"), F.col("month")], TRENDS).alias("trends"),
        _columns(
            kpi.category_performance(star, rules), [*by_revenue, F.col("category")], CATEGORIES
        ).alias("categories"),
        _columns(kpi.customer_segments(star), [*by_revenue, F.col("segment")], SEGMENTS).alias(
            "segments"
        ),
        _rows(
            kpi.top_customers(star, rules.customer_limit),
            [*by_revenue, F.col("customer_id")],
            CUSTOMER,
        ).alias("top_customers"),
        _columns(
            kpi.channel_performance(star), [F.col("revenue").desc(), F.col("channel")], CHANNELS
        ).alias("channels"),
        _rows(
            insights.generate(star, rules), [F.col("rule_order"), F.col("rank")], INSIGHT
        ).alias("insights"),
    )


def payload_json(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The payload as one JSON document; fields without a value are written as null."""
    nested = payload(star, rules)
    return nested.select(
        F.to_json(F.struct(*nested.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def write_payload(star: Star, path: str, rules: Rules = DEFAULT_RULES) -> None:
    payload_json(star, rules).coalesce(1).write.mode("overwrite").text(path)


def read_payload(spark: SparkSession, path: str, star: Star) -> DataFrame:
    """Parse a written payload back into the nested row, typed like ``payload(star)``."""
    schema = payload(star).schema
    return spark.read.text(path).select(F.from_json("value", schema).alias("p")).select("p.*")


# -- tables on the page ------------------------------------------------------


def top_categories(categories: DataFrame) -> DataFrame:
    """First ten of the category report."""
    return categories.orderBy(F.col("total_revenue").desc(), "category").limit(TOP_CATEGORIES)


def low_margin_table(categories: DataFrame) -> DataFrame:
    """Low margins among the reported categories, lowest first."""
    pct = F.col("profit_margin_pct")
    return (
        categories.where(pct < LOW_MARGIN_PCT)
        .select(
            "category",
            "total_revenue",
            "profit_margin_pct",
            tier([(pct < VERY_LOW_MARGIN_PCT, DANGER)], WARNING).alias("severity"),
        )
        .orderBy("profit_margin_pct", "category")
    )


def category_bubbles(categories: DataFrame) -> DataFrame:
    """Revenue against profit, bubble size growing with the root of the order count."""
    return categories.select(
        "category",
        "total_revenue",
        "total_profit",
        "profit_margin_pct",
        (F.sqrt("order_count") * BUBBLE_FACTOR + BUBBLE_BASE).alias("bubble_size"),
    )


def operational_alerts(channels: DataFrame) -> DataFrame:
    """Channels over the alert threshold."""
    return channels.where(F.col("failure_rate_pct") > ALERT_PCT).select(
        "channel", "failure_rate_pct"
    )


def channel_tiers(channels: DataFrame) -> DataFrame:
    rate = F.col("failure_rate_pct")
    return channels.withColumn(
        "tier", tier([(rate > DANGER_PCT, DANGER), (rate > ALERT_PCT, WARNING)], OK)
    )


def segment_share(segments: DataFrame) -> DataFrame:
    """Each segment's share of all customers; the window spans the three segment rows."""
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return segments.withColumn("_everyone", everyone).select(
        "segment",
        "customer_count",
        percent(F.col("customer_count"), F.col("_everyone")).alias("customer_share_pct"),
    )


def customer_rank(customers: DataFrame) -> DataFrame:
    """The top customers numbered, their ids shortened."""
    ranked = numbered(customers, [F.col("total_revenue").desc(), F.col("customer_id")], "position")
    shown = F.substring(F.coalesce(F.col("customer_id").cast("string"), F.lit("")), 1, ID_LENGTH)
    return ranked.select(
        "position",
        F.concat(shown, F.lit(ELLIPSIS)).alias("short_id"),
        "segment",
        "country",
        "order_count",
        "total_revenue",
        "avg_order_value",
    )


def insight_feed(records: DataFrame) -> DataFrame:
    """The first insights, with the number of all; the window spans the insight records."""
    return (
        records.withColumn("insight_count", F.count("*").over(Window.partitionBy()))
        .orderBy("rule_order", "rank")
        .limit(FEED_LENGTH)
    )
