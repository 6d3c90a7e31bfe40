"""The test tables as raw input (see FIXTURES.md).

Three mappings.  ``plain_raw`` keeps the tables as they are; ``copied_raw`` adds broken
copies; ``graded_raw`` grades
order failures by channel and product costs by brand, so that every tier, alert
and drop rule has something to act on.  Both read the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY
from .raw import RawTables
from .star import Star

# Fixed values of the mapping.
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "4-NOT SPECIFIED": "debit_card",
}
TRANSLATED_BRANDS = 20
CANCELED_DAYS = {"1-URGENT": 4, "2-HIGH": 11, "3-MEDIUM": 25, "4-NOT SPECIFIED": 25}
CANCELED_DAYS_DEFAULT = 55


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(col: Column, values: dict, default=None) -> Column:
    mapped = F.lit(default)
    for key, value in values.items():
        mapped = F.when(col == key, F.lit(value)).otherwise(mapped)
    return mapped


def _orders(orders: DataFrame, customer_id: Column, placed: Column, status: Column) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        customer_id.alias("customer_id"),
        placed.alias("order_purchase_timestamp"),
        status.alias("order_status"),
    )


def _payments(orders: DataFrame) -> DataFrame:
    """A typed payment unless the priority is low; open orders first have an untyped one."""
    kind = _lookup(F.col("o_orderpriority"), PAYMENT_BY_PRIORITY)
    value = F.col("o_totalprice").cast(MONEY)
    untyped = F.when(
        F.col("o_orderstatus") == "P",
        F.struct(
            F.lit(0).alias("seq"), F.lit(None).cast("string").alias("type"), value.alias("value")
        ),
    )
    typed = F.when(
        kind.isNotNull(),
        F.struct(F.lit(1).alias("seq"), kind.alias("type"), value.alias("value")),
    )
    return orders.select(
        "o_orderkey", F.explode(F.array_compact(F.array(untyped, typed))).alias("p")
    ).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("p.seq").alias("payment_sequential"),
        F.col("p.type").alias("payment_type"),
        F.col("p.value").alias("payment_value"),
    )


def _items(lineitem: DataFrame, *extra: Column) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        *extra,
    )


def _customers(customer: DataFrame, customer_id: Column) -> DataFrame:
    return customer.select(
        customer_id.alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_category_name")
    )


def _translation(spark: SparkSession) -> DataFrame:
    return spark.range(1, TRANSLATED_BRANDS + 1).select(
        F.format_string("Brand#%d", "id").alias("product_category_name"),
        F.format_string("category_%d", "id").alias("product_category_name_english"),
    )


def plain_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """Orders with status F are delivered, the others keep their status."""
    orders, part = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "part")
    status = F.col("o_orderstatus")
    customers = _table(spark, sf_dir, "customer").join(
        _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return RawTables(
        orders=_orders(
            orders,
            F.col("o_custkey"),
            F.col("o_orderdate"),
            F.when(status == "F", "delivered").otherwise(status),
        ),
        order_items=_items(_table(spark, sf_dir, "lineitem")),
        customers=_customers(customers, F.col("c_custkey")),
        products=_products(part),
        payments=_payments(orders),
        category_translation=_translation(spark),
    )


def copied_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """The plain tables with broken copies beside them, that a dedup has to pass over.

    A third of the items again without product and price, a fifth of the orders
    without purchase time and status, a seventh of the customers without state and
    city, a half of the products without category.
    """
    raw = plain_raw(spark, sf_dir)

    def with_copies(df: DataFrame, every: int, key: str, lost: list[str]) -> DataFrame:
        copies = df.where(F.col(key) % every == 0)
        return df.unionByName(
            copies.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in lost})
        )

    return raw._replace(
        order_items=with_copies(raw.order_items, 3, "order_id", ["product_id", "price"]),
        orders=with_copies(raw.orders, 5, "order_id", ["order_purchase_timestamp", "order_status"]),
        customers=with_copies(raw.customers, 7, "customer_id", ["customer_state", "customer_city"]),
        products=with_copies(raw.products, 2, "product_id", ["product_category_name"]),
    )


def broken_star(star: Star) -> Star:
    """A star with orphans, nulls, repeated keys, foreign labels and orders of two customers."""

    def lost(when: Column, name: str, instead=None) -> Column:
        return F.when(when, F.lit(instead)).otherwise(F.col(name))

    order, customer, product = F.col("order_id"), F.col("customer_key"), F.col("product_key")
    first, second = F.col("date_key") % 100 == 1, F.col("date_key") % 100 == 2
    return star._replace(
        fact_orders=star.fact_orders.withColumns(
            {
                "order_date_key": lost(order % 17 == 0, "order_date_key", 19000101),
                "customer_key": F.when(order % 11 == 0, -customer).otherwise(customer),
                "product_key": lost(order % 13 == 0, "product_key"),
                "revenue": lost(order % 19 == 0, "revenue"),
                "payment_status": lost(product % 23 == 0, "payment_status", "Refunded"),
            }
        ),
        dim_customer=star.dim_customer.withColumns(
            {
                "customer_id": lost(customer % 29 == 0, "customer_id"),
                "segment": lost(customer % 7 == 0, "segment", "Gold"),
            }
        ).unionByName(star.dim_customer.where(customer % 31 == 0)),
        dim_product=star.dim_product.where(product % 41 != 0).withColumn(
            "product_id", lost(product % 37 == 0, "product_id")
        ),
        dim_date=star.dim_date.withColumn("weekday", lost(first, "weekday")).unionByName(
            star.dim_date.where(second)
        ),
    )


def graded_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """Graded failures and margins.

    A customer is an account per calendar year, so order counts spread over all
    segments, and the customer table repeats an account per order.  Pending
    orders have no purchase time.  Orders of the first days of a year are
    canceled, the number of days depends on the priority.
    """
    orders, part = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "part")
    placed = F.col("o_orderdate")
    limit = _lookup(F.col("o_orderpriority"), CANCELED_DAYS, CANCELED_DAYS_DEFAULT)
    account = F.concat_ws("-", F.col("c_custkey"), F.coalesce(F.year(placed), F.lit(0)))
    customers = (
        _table(spark, sf_dir, "customer")
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    cost_ratio = ((F.lit(730) + 12 * brand) / 1000).cast("decimal(4,3)")
    ratios = part.select("p_partkey", cost_ratio.alias("cost_ratio"))
    items = _table(spark, sf_dir, "lineitem").join(
        ratios, F.col("l_partkey") == F.col("p_partkey")
    )
    return RawTables(
        orders=_orders(
            orders,
            F.concat_ws("-", F.col("o_custkey"), F.year(placed)),
            F.when(F.col("o_orderstatus") != "P", placed),
            F.when(F.dayofyear(placed) <= limit, "canceled").otherwise("delivered"),
        ),
        order_items=_items(items, F.col("cost_ratio")),
        customers=_customers(customers, account),
        products=_products(part),
        payments=_payments(orders),
        category_translation=_translation(spark),
    )
