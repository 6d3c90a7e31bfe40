"""Helpers for report-sized frames (one row per category, month, channel...)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """Row number over a whole report; only for frames that are already aggregated."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order_by)))


def unpivot_counts(df: DataFrame, name: str, value: str) -> DataFrame:
    """One wide row of counters to one row per counter."""
    return df.unpivot([], [F.col(f"`{c}`") for c in df.columns], name, value)
