from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.functions import mean, money, percent, ratio


def _exact(num: Fraction, den: Fraction, places: int) -> Decimal:
    scaled = abs(num) * 10**places / den
    units = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Decimal(units if num >= 0 else -units).scaleb(-places)


cents = st.integers(-(10**14), 10**14)
counts = st.integers(1, 10**12)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cents, counts), min_size=20, max_size=200))
def test_ratio_matches_exact_fractions(spark, pairs):
    rows = [(Decimal(a).scaleb(-2), b) for a, b in pairs]
    df = spark.createDataFrame(rows, "a decimal(28,2), b bigint")
    for places in (0, 2):
        got = df.select("a", "b", ratio(F.col("a"), F.col("b"), places).alias("r")).collect()
        assert [r.r for r in got] == [
            _exact(Fraction(r.a), Fraction(r.b), places) for r in got
        ]


def test_percent_of_negative_and_zero(spark):
    df = spark.createDataFrame(
        [(Decimal("-1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00")), (None, None)],
        "part decimal(28,2), whole decimal(28,2)",
    )
    got = [r[0] for r in df.select(percent(F.col("part"), F.col("whole"))).collect()]
    assert got == [Decimal("-33.33"), None, None]


def test_half_units_round_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (3, 8)], "a bigint, b bigint")
    assert [r[0] for r in df.select(mean(F.col("a"), F.col("b"))).collect()] == [
        Decimal("0.13"), Decimal("-0.13"), Decimal("0.38"),
    ]


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.0150"),), (Decimal("0.0149"),)], "a decimal(18,4)")
    got = [r[0] for r in df.select(money(F.col("a"))).collect()]
    assert got == [Decimal("0.02"), Decimal("0.01")]
    assert got[0] == Decimal("0.015").quantize(Decimal("0.01"), ROUND_HALF_UP)
