"""Deterministic keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the remaining columns.

    A null sorts after every value, so a broken copy never displaces a whole
    one.  The order is total over the frame's columns, so rows that still tie
    are equal.  The rank filter is planned as a group limit before the shuffle:
    each map task sends at most one row per key, however many copies it holds.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    first = Window.partitionBy(*keys).orderBy(
        *(F.col(c).asc_nulls_last() for c in [*order_by, *rest])
    )
    return (
        df.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") == 1).drop("_nth")
    )
