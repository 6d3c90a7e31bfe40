"""Rendezvous hashing of record keys over weighted shards.

Every shard bids for every key with -ln(u) / weight, u being a hash of key and
shard in (0, 1); the least bid wins.  A bid depends on the key and that shard
alone, so another shard takes just the keys it bids least for, and each shard
gets keys in proportion to its weight.

A place within the shard (slot) needs no task that sees a whole shard: rows are
numbered inside small buckets of a shard, and the bucket sizes, of a number that
is a parameter, are summed up.  A bucket follows from id, checksum and size, so the rows
of one id, however many, are cut over the buckets of its shard as far as their texts differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import filled

_HEX = 13  # digits of a digest: 52 bits, which a double holds exactly


def _digest(key: Column, salt: str) -> Column:
    """A number of 52 bits from the text ``salt:key``, by MD5."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("bigint")


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, whose bid for the key (a string, not null) is the least."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    bids = [
        F.struct(
            (-F.ln((_digest(key, str(shard)) + 0.5) / float(16**_HEX)) / float(weight)).alias("bid"),
            F.lit(shard).alias("shard"),
        )
        for shard, weight in enumerate(weights)
    ]
    return F.array_min(F.array(*bids))["shard"]


def assign(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    weights: Sequence[float] = (1.0,) * 40,
    next_weight: float = 1.0,
    overhead: int = 16,
    buckets: int = 256,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The key of a record is its id as text, for a null id the text ``null``; rows
    with equal ids share a shard and get slots of their own.  ``size`` is the
    UTF-8 length of the text plus ``overhead``, a null text counts as empty.
    ``grown_shard`` is the shard with one more, of ``next_weight``.  Slots run from
    0 without gaps in the order of bucket, id (null first), checksum and size.
    ``buckets`` per shard should be at least the rows of a shard divided by a million.
    """
    content = filled(text)
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        key.alias("key"),
        (F.octet_length(content) + overhead).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        winner(key, [*weights, next_weight]).alias("grown_shard"),
        # Without the last shard, the others bid as before.
        winner(key, weights).alias("shard"),
    )
    whole = F.concat_ws(":", "key", "text_crc32", "size")
    rows = rows.withColumn("bucket", (_digest(whole, "bucket") % buckets).cast("int"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    # One row per shard and bucket: a number set by the parameters.
    sizes = rows.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("place")).alias("slot"),
        "grown_shard",
    )
