"""Small raw tables and stars made from literal rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from tallymart.schemas import RAW, WAREHOUSE
from tallymart.sources.raw import RawTables
from tallymart.sources.star import TABLES, Star


def raw_tables(spark: SparkSession, **rows) -> RawTables:
    return RawTables(
        **{name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in RAW.items()}
    )


def order(order_id, customer="c1", placed="2020-01-15 10:00:00", status="delivered"):
    moment = dt.datetime.fromisoformat(placed) if placed else None
    return (order_id, customer, moment, status)


def item(order_id, number=1, product="p1", price="10.00"):
    return (order_id, number, product, Decimal(price) if price else None)


def star_of(spark: SparkSession, sales, customers=None, products=None) -> Star:
    """A star from (order, date, customer, product, revenue, profit, status, channel) rows.

    Keys are the numbers given; dimensions hold what the rows mention plus
    ``customers`` {key: segment} and ``products`` {key: category}.
    """
    sales = list(sales)
    customers = customers or {s[2]: "New" for s in sales}
    products = products or {s[3]: f"cat{s[3]}" for s in sales}
    days = sorted({s[1] for s in sales})
    fact = [
        (
            s[0], int(s[1].replace("-", "")), s[2], s[3], 1, Decimal(s[4]),
            Decimal(s[4]) - Decimal(s[5]), Decimal(s[5]), s[6], s[7],
        )
        for s in sales
    ]
    rows = {
        "fact_orders": fact,
        "dim_customer": [(k, f"id{k}", "XX", None, seg) for k, seg in customers.items()],
        "dim_product": [(k, f"p{k}", cat, "Generic", None, None) for k, cat in products.items()],
        "dim_date": [
            (int(d.replace("-", "")), dt.date.fromisoformat(d), int(d[:4]), int(d[5:7]),
             (int(d[5:7]) + 2) // 3, dt.date.fromisoformat(d).strftime("%A"))
            for d in days
        ],
    }
    return Star(**{t: spark.createDataFrame(rows[t], WAREHOUSE[t]) for t in TABLES})


def sale(
    order_id, day="2020-01-15", customer=1, product=1, revenue="100.00", profit="40.00",
    status="Success", channel="Web",
):
    return (order_id, day, customer, product, revenue, profit, status, channel)


def values(df, *columns) -> list[tuple]:
    return [tuple(row[c] for c in columns) for row in df.collect()]


def mapping(df, key: str, value: str) -> dict:
    return {row[key]: row[value] for row in df.collect()}
