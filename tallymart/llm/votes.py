"""Bit votes of term hashes, summed in packed lanes.

A term hash votes for each of its set bits and against each clear one; the
fingerprint has the bits that are set in over half of the hashes.  Shifting a
hash by 0 to 31 and masking gives 32 longs whose sums hold two counters of 32
bits each, which no array of hashes can overflow.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HALF = 32
_LANES = 1 | 1 << _HALF


def fingerprints(df: DataFrame, key: Sequence[str], hashes: str, name: str) -> DataFrame:
    """One row per key: the columns of ``key`` and the 64-bit fingerprint ``name``.

    ``key`` must tell the rows apart.  ``hashes`` is an array of long; an empty
    or null one gives fingerprint 0.  Each task sums the votes of its own rows
    first, so a row sends one partial sum, whatever its length.
    """
    # Generated apart from the projection below, so that the array's expression
    # is computed once per row.
    votes = df.select(*key, F.explode_outer(hashes).alias("_hash"))
    lanes = [
        F.sum(F.shiftrightunsigned("_hash", k).bitwiseAND(F.lit(_LANES))).alias(f"_lane{k}")
        for k in range(_HALF)
    ]
    counted = votes.groupBy(*key).agg(F.count("_hash").alias("_votes"), *lanes)
    return counted.select(*key, majority().alias(name))


def majority() -> Column:
    """The bits set in over half of the votes; none where there are no votes."""
    bits = [
        F.shiftleft((2 * _counter(bit) > F.col("_votes")).cast("bigint"), bit)
        for bit in range(2 * _HALF)
    ]
    return F.coalesce(reduce(Column.bitwiseOR, bits), F.lit(0).cast("bigint"))


def _counter(bit: int) -> Column:
    lane = F.shiftrightunsigned(f"_lane{bit % _HALF}", bit // _HALF * _HALF)
    return lane.bitwiseAND(F.lit((1 << _HALF) - 1))


def as_hex(fingerprint: str | Column) -> Column:
    """16 lowercase hex digits of a 64-bit value."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
