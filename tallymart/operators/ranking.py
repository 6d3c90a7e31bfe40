"""Ranks over whole tables without a window in one task.

Rows are cut into ranges, placed inside their range, and offsets are summed up over
one row per range.  The sorted rows are written to the shared folder, because the
bounds of the ranges are sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import store, stored


def _running(rows: DataFrame, order: Sequence[Column], weight: Column) -> DataFrame:
    """Adds ``_before``, the weight of all rows before a row, and ``_total``."""
    placed = store(
        rows.withColumn("_weight", weight)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id()),
        "ranking",
    )
    parts = placed.groupBy("_part").agg(F.sum("_weight").alias("_held"))
    # One row per range, as many as there are shuffle partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_held").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")
        .select(*rows.columns, (F.col("_offset") + F.col("_inside")).alias("_before"), "_total")
    )


def percent_ranks(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """Adds the percent rank by ``value``, as the window function has it; nulls last if descending.

    Equal values share a rank.  They are counted first, in the map tasks, so a value that a
    third of all rows have is one row when the ranges are cut.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    ranked = _running(counts, [order], F.col("_n")).select(
        F.col(value).alias("_value"), "_before", "_total"
    )
    share = F.when(F.col("_total") > 1, F.col("_before") / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_value"))).select(*df.columns, share.alias(name))


def top_ranked(df: DataFrame, value: str, tie: str, limit: int, name: str) -> DataFrame:
    """The ``limit`` rows with the largest ``value``, equal ones by ``tie``, and their place from 1.

    A threshold from an approximate quantile leaves little more than the rows wanted; where
    it leaves fewer, all rows are ranked.  The driver sees three numbers.  The rows are
    counted, cut and ranked from a written table, so that ``df`` is computed once.
    """
    df = stored(df, "ranked")
    total = df.count()
    kept = df
    if total > 2 * limit:
        share = max(0.0, 1 - 1.1 * limit / total - 0.0002)
        least = df.agg(F.percentile_approx(value, share, 20_000)).first()[0]
        if least is not None:
            pruned = df.where(F.col(value) >= F.lit(least))
            kept = pruned if pruned.count() >= limit else df
    order = [F.col(value).desc(), F.col(tie).asc()]
    ranked = _running(kept, order, F.lit(1).cast("long"))
    return ranked.where(F.col("_before") < limit).select(
        *df.columns, (F.col("_before") + 1).alias(name)
    )
