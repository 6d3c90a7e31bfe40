"""Places within groups, without bringing a group together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import store


def in_ranges(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows sorted over partitions, with ``_part`` and the ascending ``_place``; written.

    The place before the shuffle is the last key, so equal rows are cut as well.
    """
    place = F.monotonically_increasing_id()
    keys = [*keys, "_tie"]
    return store(
        rows.withColumn("_tie", place)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_place", place)
        .withColumn("_part", F.spark_partition_id()),
        "ranks",
    )


def ranked_within(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0, without gaps within the group) and ``n``, the group's rows.

    ``order`` names columns, ascending, nulls first; rows equal in all of them get
    different ranks in any order.  Nulls are a group.  A range shuffle cuts a large group, a
    run of equal rows too, over many tasks; offsets come from one row per group and
    partition.  The sorted rows are written to the shared folder, because the bounds
    of the ranges are sampled.
    """
    placed = in_ranges(rows, [group, *order])
    found = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_count")
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = found.select(
        "_group", "_of", "_first",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"),
        F.sum("_count").over(whole).alias("n"),
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of"))
    rank = F.col("_place") - F.col("_first") + F.col("_before")
    return placed.join(offsets, same).select(*rows.columns, rank.alias("rank"), "n")
