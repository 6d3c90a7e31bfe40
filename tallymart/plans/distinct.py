"""Distinct counts that add up: exact bitmaps of customers, approximate sketches of orders.

Both are stored per day and channel and merge: those of a month, a channel or of two
builds come from the stored ones without the fact.  Customer keys are dense, so a
bitmap of 32,768 keys is 4 kB at most and is made in the map tasks; what is
shuffled are bitmaps, never (group, customer) rows.  Order ids are not dense, and a
sketch counts them within a share set by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import percent
from ..sources.star import Star
from .totals import dated, paid_items

#: Bits of a sketch's size; the standard error is about 0.83 / sqrt(2 ** bits), 0.65 % for 14.
SKETCH_BITS = 14


def customer_bitmaps(star: Star) -> DataFrame:
    """Paying customers: order_date_key, channel, bucket, bits.

    ``bits`` has a bit for each customer key of the bucket; keys that are null count for nothing.
    """
    key = F.col("customer_key")
    return (
        paid_items(star)
        .where(key.isNotNull())
        .groupBy("order_date_key", "channel", F.bitmap_bucket_number(key).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))
    )


def merged(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Bitmaps per group and bucket, from any that were stored, also of several builds."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def customers(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Distinct paying customers per group."""
    counted = merged(bitmaps, *by).withColumn("n", F.bitmap_count("bits"))
    return counted.groupBy(*by).agg(F.sum("n").alias("customers"))


def customers_by_month(star: Star, bitmaps: DataFrame | None = None) -> DataFrame:
    """Distinct paying customers per month; ``bitmaps`` are stored ones, else the fact is read."""
    bitmaps = customer_bitmaps(star) if bitmaps is None else bitmaps
    return customers(dated(bitmaps, star), "year", "month").orderBy("year", "month")


def customers_by_channel(star: Star, bitmaps: DataFrame | None = None) -> DataFrame:
    """Distinct paying customers per channel."""
    bitmaps = customer_bitmaps(star) if bitmaps is None else bitmaps
    return customers(bitmaps, "channel").orderBy("channel")


def retention(star: Star, cross_year: bool = False, bitmaps: DataFrame | None = None) -> DataFrame:
    """The rows of ``kpi.retention``; those retained are the AND of two months' bitmaps.

    Each month's bitmap stands once for itself and once for the month after it; where
    both meet in a bucket they are combined in the aggregation, so no month is joined to another.
    """
    bitmaps = customer_bitmaps(star) if bitmaps is None else bitmaps
    months = merged(dated(bitmaps, star), "year", "month")
    number = F.col("year") * 12 + F.col("month") - 1
    asked = F.lit(True) if cross_year else F.col("month") < 12
    stood = months.select(
        "bucket", "bits",
        F.inline(F.array(
            F.struct(number.alias("at"), F.lit(0).alias("before")),
            F.struct(F.when(asked, number + 1).alias("at"), F.lit(1).alias("before")),
        )),
    ).where(F.col("at").isNotNull())
    own = F.when(F.col("before") == 0, F.col("bits"))
    met = stood.groupBy("at", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg(own)).alias("current"),
        F.count_if(F.col("before") == 0).alias("here"),
        F.when(F.count(F.lit(1)) == 2, F.bitmap_count(F.bitmap_and_agg("bits"))).otherwise(0).alias("kept"),
    )
    return (
        met.groupBy("at")
        .agg(
            F.sum(F.when(F.col("here") > 0, F.col("current")).otherwise(0)).alias("current_customers"),
            F.sum("kept").alias("retained_customers"),
        )
        .where("current_customers > 0")
        .select(
            F.expr("int(at div 12)").alias("year"),
            F.expr("int(at % 12 + 1)").alias("month"),
            "current_customers",
            "retained_customers",
            percent(F.col("retained_customers"), F.col("current_customers")).alias("retention_rate_pct"),
        )
        .orderBy("year", "month")
    )


def order_sketches(star: Star, bits: int = SKETCH_BITS) -> DataFrame:
    """Paid orders: order_date_key, channel, category, sketch; a few kB per row at most."""
    categories = star.dim_product.select("product_key", "category")
    return (
        paid_items(star)
        .join(categories, "product_key")
        .groupBy("order_date_key", "channel", "category")
        .agg(F.hll_sketch_agg("order_id", bits).alias("sketch"))
    )


def approximate_orders(sketches: DataFrame, *by: str) -> DataFrame:
    """About how many distinct paid orders a group has; groups by any of the sketches' columns."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("orders_about")
    )


def orders_by_category(star: Star, sketches: DataFrame | None = None) -> DataFrame:
    """Distinct paid orders per category: exact, or with ``sketches`` about as many.

    Exact counts shuffle each (category, order) once; sketches shuffle themselves.
    """
    if sketches is not None:
        return approximate_orders(sketches, "category")
    categories = star.dim_product.select("product_key", "category")
    return (
        paid_items(star).join(categories, "product_key")
        .groupBy("category").agg(F.countDistinct("order_id").alias("orders"))
    )


def sketch_error(star: Star, sketches: DataFrame) -> DataFrame:
    """Per category the exact orders and whether the sketch is within 3 standard errors, or 1."""
    about = orders_by_category(star, sketches)
    allowed = F.greatest(F.col("orders") * (3 * 0.83 / 2 ** (SKETCH_BITS / 2)), F.lit(1.0))
    return (
        orders_by_category(star).join(about, "category")
        .select("category", "orders", (F.abs(F.col("orders_about") - F.col("orders")) <= allowed).alias("within_bound"))
    )
