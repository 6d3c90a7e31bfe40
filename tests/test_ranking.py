"""Ranks by ranges against the window functions and a sort."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators import percent_ranks, top_ranked
from tallymart.plans import kpi


def rows(df) -> list:
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("values", [
    "id % 7", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END", "id", "1", "CASE WHEN id % 4 > 0 THEN id % 10 END",
])
def test_percent_ranks_are_those_of_the_window(spark, values, descending):
    for size in (0, 1, 2, 500):
        df = spark.range(size).selectExpr("id", f"{values} AS v")
        order = F.col("v").desc() if descending else F.col("v").asc()
        want = df.withColumn("share", F.percent_rank().over(Window.orderBy(order)))
        assert rows(percent_ranks(df, "v", "share", descending)) == rows(want)


@pytest.mark.parametrize("limit", [0, 1, 10, 333, 5000])
def test_top_ranked_is_the_sort(spark, limit):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 900 WHEN id % 5 > 0 THEN id * 37 % 1000 END AS v")
    want = [(r.id, r.v) for r in df.orderBy(F.col("v").desc(), "id").limit(limit).collect()]
    got = sorted(top_ranked(df, "v", "id", limit, "place").collect(), key=lambda r: r.place)
    assert [(r.id, r.v) for r in got] == want and [r.place for r in got] == list(range(1, len(want) + 1))


def test_a_million_places_without_one_task(spark):
    df = spark.range(1_300_000).selectExpr("id", "pmod(xxhash64(id), 100000) AS v")
    top = top_ranked(df, "v", "id", 1_000_001, "place")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        top = top_ranked(df, "v", "id", 1_000_001, "place")
        sizes = [r["count"] for r in top.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 1_000_001 and max(sizes) < 400_000
    assert top.agg(F.countDistinct("place"), F.max("place")).first() == (1_000_001, 1_000_001)
    order = top.orderBy("place").limit(50).collect()
    assert [(r.v, r.id) for r in order] == [
        (r.v, r.id) for r in df.orderBy(F.col("v").desc(), "id").limit(50).collect()
    ]


def test_long_lists_of_customers_are_the_same(spark, sf_dir, monkeypatch):
    from checks import stars

    star = stars.star(spark, sf_dir, "graded")
    want = kpi.top_customers(star, 40).collect()
    monkeypatch.setattr(kpi, "LONG_LIST", 5)
    assert kpi.top_customers(star, 40).collect() == want
