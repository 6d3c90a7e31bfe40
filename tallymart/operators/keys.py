"""Dense surrogate keys without funnelling the table through one task.

Rows with equal ids get different keys, in the order in which they are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import forget, store

_OFFSET_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def dense_keys(df: DataFrame, order_by: str, key: str) -> DataFrame:
    """Number the rows 1..N in the order of the unique column ``order_by``.

    The table is written first, because a range shuffle computes its input twice,
    for the bounds and for the rows.  The range shuffle sorts it across partitions;
    the position inside a partition is the low part of the monotonic id.  The sorted table is written
    to the shared folder, because range bounds are sampled and a second run of
    the same plan could cut elsewhere.  What is summed up and broadcast is one
    row per written partition, bounded by the shuffle partition count.
    """
    rows = store(df, "unkeyed")
    placed = store(
        rows.repartitionByRange(order_by)
        .sortWithinPartitions(order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "keys",
    )
    forget(rows)
    part = F.shiftright("_place", _OFFSET_BITS)
    within = F.col("_place").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(within) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + within + 1).alias(key), *df.columns)
    )
