"""What is computed, sorted and shuffled once, and how wide."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import stars
from tallymart.operators import dense_keys, top_ranked
from tallymart.plans import star as etl


def _below_exchanges(df) -> list[str]:
    """The plan's lines under its lowest exchanges: what a task does to the input it reads."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return lines[max(k for k, line in enumerate(lines) if "Exchange" in line) + 1 :]


def _counted(spark, rows: int):
    """A frame of ``rows`` rows and an accumulator of how many were computed."""
    seen = spark.sparkContext.accumulator(0)

    def value(i):
        seen.add(1)
        return i * 7 % 1000

    counting = F.udf(value, "bigint").asNondeterministic()
    return spark.range(rows).select(F.col("id"), counting("id").alias("value")), seen


def test_payments_sort_no_input_split(spark, sf_dir):
    paid = etl.payments_by_order(stars.raw(spark, sf_dir, "plain"))
    assert "Sort" not in "".join(_below_exchanges(paid))


def test_measures_are_added_behind_the_joins(spark, sf_dir):
    fact = etl.build_star(stars.raw(spark, sf_dir, "graded")).fact_orders
    lines = fact._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [k for k, line in enumerate(lines) if "Join" in line]
    assert joins and not any("AS profit" in line for line in lines[joins[0] :])


def test_keys_compute_their_input_once(spark):
    rows, seen = _counted(spark, 500)
    keyed = dense_keys(rows.select("id", "value"), "id", "key")
    assert [r["key"] for r in keyed.orderBy("id").collect()] == list(range(1, 501))
    assert seen.value == 500


def test_long_lists_compute_their_input_once(spark):
    rows, seen = _counted(spark, 1000)
    best = top_ranked(rows, "value", "id", 100, "place").collect()
    assert sorted((r["place"], r["value"]) for r in best) == [(p, 1000 - p) for p in range(1, 101)]
    assert seen.value == 1000
