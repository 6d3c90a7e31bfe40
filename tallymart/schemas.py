"""Column types of the raw, clean, warehouse and insight tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()

RAW = {
    "orders": _struct(
        order_id=_S, customer_id=_S, order_purchase_timestamp=T.TimestampNTZType(), order_status=_S
    ),
    "order_items": _struct(order_id=_S, order_item_id=_I, product_id=_S, price=MONEY),
    "customers": _struct(
        customer_id=_S, customer_unique_id=_S, customer_city=_S, customer_state=_S
    ),
    "products": _struct(product_id=_S, product_category_name=_S),
    "payments": _struct(
        order_id=_S, payment_sequential=_I, payment_type=_S, payment_value=MONEY
    ),
    "category_translation": _struct(
        product_category_name=_S, product_category_name_english=_S
    ),
}

DIMENSIONS = {
    "dim_customer": _struct(
        customer_key=_L, customer_id=_S, country=_S, signup_date=T.DateType(), segment=_S
    ),
    "dim_product": _struct(
        product_key=_L, product_id=_S, category=_S, brand=_S, unit_cost=MONEY, unit_price=MONEY
    ),
    "dim_date": _struct(
        date_key=_I, date=T.DateType(), year=_I, month=_I, quarter=_I, weekday=_S
    ),
}

_MEASURES = dict(
    quantity=_I, revenue=MONEY, cost=MONEY, profit=MONEY, payment_status=_S, channel=_S
)

CLEAN = {
    **DIMENSIONS,
    "fact_orders": _struct(
        order_id=_S, order_date=T.DateType(), customer_id=_S, product_id=_S, **_MEASURES
    ),
}

WAREHOUSE = {
    **DIMENSIONS,
    "fact_orders": _struct(
        order_id=_S, order_date_key=_I, customer_key=_L, product_key=_L, **_MEASURES
    ),
}

# Constraints the warehouse tables have to meet; checked by plans.quality.
NOT_NULL = {
    "dim_date": ["date", "year", "month", "quarter", "weekday"],
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "fact_orders": [
        "order_id", "order_date_key", "customer_key", "product_key",
        "quantity", "revenue", "cost", "profit",
    ],
}
UNIQUE = [
    ("dim_date", ["date_key"]),
    ("dim_customer", ["customer_key"]),
    ("dim_customer", ["customer_id"]),
    ("dim_product", ["product_key"]),
    ("dim_product", ["product_id"]),
    ("fact_orders", ["order_id", "product_key"]),
]
DOMAIN = [
    ("dim_customer", "segment", ["New", "Returning", "VIP"]),
    ("fact_orders", "payment_status", ["Success", "Failed"]),
]
FOREIGN_KEYS = [
    ("customer_key", "dim_customer", "customer_key"),
    ("product_key", "dim_product", "product_key"),
    ("order_date_key", "dim_date", "date_key"),
]


def conform(df: DataFrame, schema: T.StructType, keep_ids: bool = False) -> DataFrame:
    """Select and cast the columns of ``schema`` by name.

    ``keep_ids`` leaves the natural id columns in the type they came in, for
    sources whose ids are numbers.
    """
    ids = {"order_id", "customer_id", "product_id"} if keep_ids else set()
    return df.select(
        *[
            F.col(f.name) if f.name in ids else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
