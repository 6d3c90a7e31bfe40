"""Every registered query: a name, the star it reads and the plan that answers it."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import channel_of, segment_of
from tallymart.operators import dense_keys, top_ranked
from tallymart.plans import dashboard, distinct, insights, kpi, load, quality, questions, totals
from tallymart.plans import star as etl
from tallymart.plans.totals import with_summaries
from tallymart.rules import DEFAULT_RULES, Rules
from tallymart.sources.driver_tables import broken_star
from tallymart.sources.raw import RAW_FILES, RawTables, Staged, read_raw_csv, reject_counts, stage_raw_csv
from tallymart.sources.shared import shared_dir, store
from tallymart.sources.star import (
    Star,
    read_clean,
    read_warehouse,
    register_views,
    write_clean,
    write_warehouse,
)

from . import stars

Query = Callable[[SparkSession, str], DataFrame]

# The graded star stays under the usual one-time share, so one query lowers the limit.
WATCHFUL = Rules(one_time_pct=Decimal(30))


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for engines that type sums differently."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _on_raw(name: str, plan: Callable) -> Query:
    return lambda spark, sf_dir: comparable(plan(stars.raw(spark, sf_dir, name)))


def _on_star(name: str, plan: Callable) -> Query:
    return lambda spark, sf_dir: comparable(plan(stars.star(spark, sf_dir, name)))


# -- plans that exist only as a query ----------------------------------------


def channel_map(raw) -> DataFrame:
    paid = etl.payments_by_order(raw)
    return paid.select("order_id", "payment_type", channel_of(F.col("payment_type")).alias("channel"))


def segment_assign(raw) -> DataFrame:
    return etl.customer_orders(raw).select(
        "customer_id",
        "order_count",
        segment_of(F.col("order_count"), DEFAULT_RULES).alias("segment"),
    )


def surrogate_keys(raw) -> DataFrame:
    return dense_keys(etl.unique_customers(raw).select("customer_id"), "customer_id", "customer_key")


def broken(plan: Callable) -> Query:
    return lambda spark, sf_dir: comparable(plan(broken_star(stars.star(spark, sf_dir, "plain"))))


def raw_csv(raw) -> RawTables:
    """The raw tables written as CSV files and read back by the package's reader."""
    spark = raw.orders.sparkSession
    directory = shared_dir(spark, "raw")
    for name, df in raw._asdict().items():
        df.write.option("header", True).csv(f"{directory}/{RAW_FILES[name]}")
    return read_raw_csv(spark, directory)


def _quoted(value: Column) -> Column:
    """A CSV field as other writers make it: quoted, quotes doubled."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def faulty_csv(raw) -> Staged:
    """The raw tables as hand-made CSV lines, some of which do not fit, staged.

    Items of every fifth order have no number as price in line 1, and every seventh
    order's line 2 ends early; every eleventh order has no time but a word; every third
    customer's line has a field too many.  Towns have commas and quotes in them.
    """
    spark = raw.orders.sparkSession
    directory = shared_dir(spark, "raw")
    order, number = F.col("order_id"), F.col("order_item_id")
    lines = {name: [F.col(c) for c in df.columns] for name, df in raw._asdict().items()}
    town = F.concat(F.lit('the "'), "customer_city", F.lit('", or so'))
    lines["customers"][2] = town
    lines["order_items"][3] = F.when((order % 5 == 0) & (number == 1), F.lit("free")).otherwise(F.col("price").cast("string"))
    lines["orders"][2] = F.when(order % 11 == 0, F.lit("soon")).otherwise(F.col("order_purchase_timestamp").cast("string"))
    for name, df in raw._asdict().items():
        line = F.concat_ws(",", *map(_quoted, lines[name]))
        if name == "order_items":
            short = F.concat_ws(",", order.cast("string"), number.cast("string"))
            line = F.when((order % 7 == 0) & (number == 2), short).otherwise(line)
        if name == "customers":
            line = F.when(F.col("customer_id") % 3 == 0, F.concat(line, F.lit(",x"))).otherwise(line)
        # One column, its name the header, and a separator that no line has: lines go out as they are.
        plain = {"header": True, "sep": "\x01", "quote": "\x00", "escapeQuotes": False}
        df.select(line.alias(",".join(df.columns))).write.options(**plain).csv(f"{directory}/{RAW_FILES[name]}")
    return stage_raw_csv(spark, directory)


def raw_csv_rejects(raw) -> DataFrame:
    return reject_counts(faulty_csv(raw).rejects)


def raw_csv_kept_customers(raw) -> DataFrame:
    return faulty_csv(raw).raw.customers.select("customer_id", "customer_city")


def clean_csv_table(table: str) -> Callable:
    def back(raw) -> DataFrame:
        spark, directory = raw.orders.sparkSession, shared_dir(raw.orders.sparkSession, "clean")
        write_clean(etl.build_clean(raw), directory, "csv")
        return getattr(read_clean(spark, directory, "csv"), table)

    return back


def warehouse_table(table: str) -> Callable:
    """A table after the clean zone and the warehouse, both as Parquet files."""

    def back(raw) -> DataFrame:
        spark = raw.orders.sparkSession
        clean_dir, warehouse_dir = shared_dir(spark, "clean"), shared_dir(spark, "warehouse")
        write_clean(etl.build_clean(raw), clean_dir)
        write_warehouse(load.load_star(read_clean(spark, clean_dir)), warehouse_dir)
        return getattr(read_warehouse(spark, warehouse_dir), table)

    return back


def payload_part(select: Callable) -> Callable:
    """A part of the payload after it was written and parsed."""

    def back(star: Star) -> DataFrame:
        spark = star.fact_orders.sparkSession
        path = shared_dir(spark, "payload")
        dashboard.write_payload(star, path)
        return select(dashboard.read_payload(spark, path, star))

    return back


def _channels(payload: DataFrame) -> DataFrame:
    fields = payload.schema["channels"].dataType.names
    return payload.select(F.inline(F.arrays_zip(*[F.col(f"channels.{c}") for c in fields])))


def dimension_lookup(star: Star) -> DataFrame:
    register_views(star)
    return star.dim_customer.sparkSession.sql("SELECT customer_key, customer_id FROM dim_customer")


def sql_category_status(star: Star) -> DataFrame:
    register_views(star)
    return star.fact_orders.sparkSession.sql(
        """
        SELECT p.category, f.payment_status, count(*) AS items, sum(f.revenue) AS revenue
        FROM fact_orders f JOIN dim_product p ON f.product_key = p.product_key
        GROUP BY p.category, f.payment_status
        """
    )


def payload_round_trip(star: Star) -> DataFrame:
    """The written payload parsed again, its trend arrays as rows."""
    spark = star.fact_orders.sparkSession
    path = shared_dir(spark, "payload")
    dashboard.write_payload(star, path)
    trends = dashboard.read_payload(spark, path, star).select(
        F.explode(F.arrays_zip(*[F.col(f"trends.{c}") for c in dashboard.TRENDS])).alias("t")
    )
    return trends.select("t.*")


def _stored_bitmaps(plan: Callable) -> Callable:
    """A report from bitmaps that were written before."""

    def report(star: Star) -> DataFrame:
        return plan(star, bitmaps=store(distinct.customer_bitmaps(star), "bitmaps"))

    return report


def sketched_orders(star: Star) -> DataFrame:
    return distinct.sketch_error(star, store(distinct.order_sketches(star), "sketches"))


def ranked_customers(star: Star) -> DataFrame:
    """The better half of the paying customers with their places, by ranges."""
    sums = totals.customer_sums(star).join(
        star.dim_customer.select("customer_key", "customer_id"), "customer_key"
    )
    sums = store(sums.select("customer_id", F.col("revenue").alias("total_revenue")), "ranked")
    return top_ranked(sums, "total_revenue", "customer_id", sums.count() // 2, "place")


def _on_summaries(plan: Callable) -> Query:
    """Reports that need many sums write them first."""
    return lambda spark, sf_dir: comparable(
        plan(with_summaries(stars.star(spark, sf_dir, "graded")))
    )


def _table(report: Callable[[Star], DataFrame], view: Callable) -> Query:
    return _on_star("graded", lambda star: view(report(star)))


QUERIES: dict[str, Query] = {
    # star schema build
    "items_with_orders": _on_raw("plain", etl.items_with_orders),
    "payments_by_order": _on_raw("plain", etl.payments_by_order),
    "order_items_dedup": _on_raw("plain", etl.unique_items),
    "channel_map": _on_raw("plain", channel_map),
    "order_headers": _on_raw("graded", etl.order_headers),
    "fact_orders_build": _on_raw("plain", etl.build_fact),
    "fact_orders_build_graded": _on_raw("graded", etl.build_fact),
    "customer_signup": _on_raw("plain", etl.customer_orders),
    "customer_segment_assign": _on_raw("graded", segment_assign),
    "surrogate_keys": _on_raw("graded", surrogate_keys),
    "dim_customer_build": _on_raw("plain", etl.build_dim_customer),
    "dim_customer_build_graded": _on_raw("graded", etl.build_dim_customer),
    "category_translate": _on_raw("plain", etl.translated_products),
    "product_price_stats": _on_raw("plain", etl.product_price_stats),
    "dim_product_build": _on_raw("plain", etl.build_dim_product),
    "dim_date_build": _on_raw("plain", etl.build_dim_date),
    "star_build": _on_raw("graded", lambda raw: etl.build_star(raw).fact_orders),
    "etl_audit": _on_raw("plain", quality.etl_audit),
    "etl_audit_graded": _on_raw("graded", quality.etl_audit),
    "dim_profile": _on_star("graded", quality.dimension_profile),
    # sinks, load, validation
    "clean_csv_round_trip": _on_raw("plain", clean_csv_table("fact_orders")),
    "fact_key_lookup": _on_raw("plain", lambda raw: load.load_fact(etl.build_clean(raw))),
    "warehouse_load": _on_raw("graded", warehouse_table("fact_orders")),
    "dimension_lookup": _on_star("graded", dimension_lookup),
    "sql_category_status": _on_star("graded", sql_category_status),
    "warehouse_row_counts": _on_star("plain", quality.row_counts),
    "orphan_counts": _on_star("plain", quality.orphan_counts),
    "dq_not_null": _on_star("plain", quality.null_counts),
    "dq_unique": _on_star("plain", quality.duplicate_keys),
    "dq_domain": _on_star("plain", quality.domain_violations),
    "warehouse_validation": _on_star("graded", quality.validation_report),
    # the same checks where there is something to find
    "broken_orphan_counts": broken(quality.orphan_counts),
    "broken_not_null": broken(quality.null_counts),
    "broken_unique": broken(quality.duplicate_keys),
    "broken_domain": broken(quality.domain_violations),
    "broken_validation": broken(quality.validation_report),
    # copies with nulls in them change nothing
    "dedup_null_copies": _on_raw("copied", etl.build_fact),
    "dedup_null_copies_customer": lambda spark, sf_dir: comparable(
        etl.build_dim_customer(
            stars.raw(spark, sf_dir, "copied")._replace(
                orders=stars.raw(spark, sf_dir, "plain").orders
            )
        )
    ),
    "dedup_null_copies_product": _on_raw("copied", etl.translated_products),
    # files
    "raw_csv_build": _on_raw("plain", lambda raw: etl.build_fact(raw_csv(raw))),
    "raw_csv_dim_customer": _on_raw("plain", lambda raw: etl.build_dim_customer(raw_csv(raw))),
    "raw_csv_dim_product": _on_raw("plain", lambda raw: etl.build_dim_product(raw_csv(raw))),
    "raw_csv_rejects": _on_raw("plain", raw_csv_rejects),
    "raw_csv_kept_customers": _on_raw("plain", raw_csv_kept_customers),
    "raw_csv_kept_fact": _on_raw("plain", lambda raw: etl.build_fact(faulty_csv(raw).raw)),
    "clean_csv_dim_customer": _on_raw("plain", clean_csv_table("dim_customer")),
    "clean_csv_dim_product": _on_raw("plain", clean_csv_table("dim_product")),
    "clean_csv_dim_date": _on_raw("plain", clean_csv_table("dim_date")),
    "warehouse_dim_customer": _on_raw("graded", warehouse_table("dim_customer")),
    "warehouse_dim_product": _on_raw("graded", warehouse_table("dim_product")),
    "warehouse_dim_date": _on_raw("graded", warehouse_table("dim_date")),
    # KPI reports
    "kpi_revenue": _on_star("graded", kpi.revenue),
    "kpi_success_rate": _on_star("graded", kpi.success_rate),
    "kpi_retention": _on_star("plain", kpi.retention),
    "kpi_retention_cross_year": _on_star("plain", lambda s: kpi.retention(s, cross_year=True)),
    "bitmap_retention": _on_star("plain", _stored_bitmaps(distinct.retention)),
    "bitmap_retention_cross_year": _on_star(
        "plain", lambda s: distinct.retention(s, cross_year=True)
    ),
    "bitmap_customers_by_month": _on_star("graded", _stored_bitmaps(distinct.customers_by_month)),
    "bitmap_customers_by_channel": _on_star("graded", distinct.customers_by_channel),
    "sketched_orders_by_category": _on_star("graded", sketched_orders),
    "kpi_failed_by_channel": _on_star("graded", kpi.failed_by_channel),
    "kpi_order_value": _on_star("graded", kpi.order_value),
    "kpi_revenue_per_customer": _on_star("graded", kpi.revenue_per_customer),
    "kpi_revenue_by_category": _on_star("graded", kpi.revenue_by_category),
    "kpi_monthly_trend": _on_star("plain", kpi.monthly_trend),
    "kpi_channel_monthly": _on_star("graded", kpi.channel_by_month),
    # business questions
    "aq_product_margin": _on_star("graded", questions.product_margin),
    "aq_customer_activity": _on_star("graded", questions.customer_activity),
    "aq_segment_churn": _on_star("graded", questions.segment_churn),
    "aq_channel_failure": _on_star("graded", questions.channel_failure),
    "aq_category_ranking": _on_star("graded", questions.category_ranking),
    "aq_product_ranking": _on_star("graded", questions.product_ranking),
    "aq_ranked_customers": _on_star("graded", ranked_customers),
    "aq_category_recommendation": _on_star("graded", questions.category_recommendation),
    "aq_top_customers": _on_star("graded", questions.top_customers),
    "aq_category_mix": _on_star("graded", questions.category_mix),
    # KPI API
    "api_executive_kpis": _on_star("graded", kpi.executive),
    "api_aov": _on_star("graded", kpi.average_order_value),
    "api_revenue_per_customer": _on_star("graded", kpi.segment_revenue_per_customer),
    "api_failed_payments": _on_star("graded", kpi.channel_failed_payments),
    "api_monthly_trends": _on_star("graded", kpi.monthly_trends),
    "api_category_performance": _on_star("graded", kpi.category_performance),
    "api_customer_segments": _on_star("graded", kpi.customer_segments),
    "api_channel_performance": _on_star("graded", kpi.channel_performance),
    "api_top_customers": _on_star("graded", kpi.top_customers),
    # insights
    "insight_low_margin": _on_star("graded", insights.low_margin),
    "insight_failed_payments": _on_star("graded", insights.failed_payments),
    "insight_retention": _on_star("graded", lambda s: insights.customer_retention(s, WATCHFUL)),
    "insight_category_review": _on_star("graded", insights.category_review),
    "insight_top_category": _on_star("graded", insights.top_category),
    "insights_all": _on_star("graded", insights.generate),
    "insights_summary": _on_star("graded", lambda s: insights.summary(insights.generate(s))),
    # dashboard
    "summaries_daily": _on_star("graded", totals.daily_totals),
    "summaries_customers": _on_star("graded", totals.customer_totals),
    "summaries_products": _on_star("graded", totals.product_totals),
    "dashboard_payload": _on_summaries(dashboard.payload_json),
    "payload_round_trip": _on_summaries(payload_round_trip),
    "payload_customers": _on_summaries(
        payload_part(lambda payload: payload.select(F.inline("top_customers")))
    ),
    "payload_channels": _on_summaries(payload_part(_channels)),
    "payload_insights": _on_summaries(payload_part(lambda p: p.select(F.inline("insights")))),
    "dash_low_margin": _table(kpi.category_performance, dashboard.low_margin_table),
    "dash_top_categories": _table(kpi.category_performance, dashboard.top_categories),
    "dash_category_bubble": _table(kpi.category_performance, dashboard.category_bubbles),
    "dash_ops_alerts": _table(kpi.channel_performance, dashboard.operational_alerts),
    "dash_channel_tier": _table(kpi.channel_performance, dashboard.channel_tiers),
    "dash_segment_share": _table(kpi.customer_segments, dashboard.segment_share),
    "dash_customer_rank": _table(kpi.top_customers, dashboard.customer_rank),
    "dash_insight_feed": _on_star("graded", lambda s: dashboard.insight_feed(insights.generate(s))),
}
