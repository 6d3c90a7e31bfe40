"""SimHash near-dedup by covering locality-sensitive hashing.

Every bit gets a nonzero label of ``radius + 1`` binary digits, dealt in turn in
a seeded order.  Each nonzero vector v of that many digits gives one mask: the
bits whose label has an odd product with v.  The labels of ``radius`` differing
bits span at most ``radius`` dimensions, so some v is orthogonal to all of them:
its mask covers none of the differing bits, and the pair agrees in that table.
With 2^(radius+1) - 1 tables no pair within the radius is missed.

Fingerprints that share a bucket with another are candidates.  They are linked
without listing the pairs of a bucket, which a large group of near copies would
square: for an even radius 2h, two fingerprints are within it if and only if
some 64-bit value lies within h of both, so each candidate names the values
around it and those that name the same one are linked to the least of them.  An
odd radius is the even one below, plus the bit flips of one more step, taken
from one side only.
"""

from __future__ import annotations

import random
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..sources.shared import store
from . import votes
from .components import components
from .text import ascii_lower, filled, shingle_hashes, words

BITS = 64


def covering_masks(radius: int, seed: int = 42) -> list[int]:
    """The bit masks of the tables, as signed 64-bit numbers."""
    size = 1 << (radius + 1)
    order = random.Random(seed).sample(range(BITS), BITS)
    label = {bit: 1 + place % (size - 1) for place, bit in enumerate(order)}
    masks = []
    for vector in range(1, size):
        bits = [bit for bit in range(BITS) if (label[bit] & vector).bit_count() % 2]
        masks.append(_signed(sum(1 << bit for bit in bits)))
    return masks


def shingle_fingerprints(
    docs: DataFrame, text: str, shingle: int, key: list[str], name: str
) -> DataFrame:
    """SimHash of the lower-cased (A-Z) word shingles of each text, one row per ``key``."""
    split = docs.select(*key, words(ascii_lower(filled(text))).alias("_words"))
    hashed = split.select(*key, shingle_hashes("_words", shingle).alias("_hashes"))
    return votes.fingerprints(hashed, key, "_hashes", name)


def candidates(classes: DataFrame, fingerprint: str, radius: int) -> DataFrame:
    """The distinct fingerprints that share a bucket of some table with another one."""
    tables = [
        F.struct(F.lit(t).alias("table"), F.col(fingerprint).bitwiseAND(F.lit(mask)).alias("part"))
        for t, mask in enumerate(covering_masks(radius))
    ]
    placed = classes.select(fingerprint, F.inline(F.array(*tables)))
    shared = placed.groupBy("table", "part").agg(F.count("*").alias("n")).where("n > 1")
    return placed.join(shared, ["table", "part"], "left_semi").select(fingerprint).distinct()


def links(found: DataFrame, fingerprint: str, radius: int) -> DataFrame:
    """Links (a, b) that connect just the candidates a chain of steps within the radius connects.

    A value within ``radius // 2`` steps of a fingerprint is its hub.  The rows
    are candidates times hubs, and a hub has at most as many fingerprints as lie
    within ``radius // 2`` of it, so there is no hot group.
    """
    own = F.col(fingerprint)
    near = found.select(own.alias("a"), F.explode(_around(own, radius // 2)).alias("hub"))
    if radius % 2 == 0:
        least = near.groupBy("hub").agg(F.min("a").alias("b"), F.count("*").alias("n"))
        return near.join(least.where("n > 1"), "hub").where("a != b").select("a", "b").distinct()
    far = found.select(own.alias("b"), F.explode(_around(own, radius // 2 + 1)).alias("hub"))
    return near.join(far, "hub").where("a != b").select("a", "b").distinct()


def near_groups(fingerprinted: DataFrame, fingerprint: str, doc_id: str, radius: int) -> DataFrame:
    """One row per distinct fingerprint: (fingerprint, component_id).

    ``component_id`` is the least id of the documents reachable through links of
    at most ``radius`` differing bits, the own ones included; null where all of
    these ids are null.
    """
    classes = fingerprinted.groupBy(fingerprint).agg(F.min(doc_id).alias("_least"))
    classes = store(classes, "fingerprints")
    found = candidates(classes, fingerprint, radius)
    roots = components(links(found, fingerprint, radius), "a", "b")
    # A root has no row of its own among the nodes.
    rooted = classes.join(
        roots.withColumnRenamed("node", fingerprint), fingerprint, "left"
    ).withColumn("root", F.coalesce("root", fingerprint))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    return rooted.join(least, "root").select(fingerprint, "component_id")


def simhash_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id.

    A null text is an empty one; texts without words have fingerprint 0 and are
    linked like any other.  Repeated rows are kept.  No rows give no rows.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), filled(text).alias("text")).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    marked = store(
        shingle_fingerprints(keyed, "text", shingle, ["doc_id", "_row"], "fingerprint").drop(
            "_row"
        ),
        "simhash",
    )
    groups = near_groups(marked, "fingerprint", "doc_id", radius)
    return marked.join(groups, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """The documents without near copies: of each group the row with the least id stays.

    Ids that are null come last; of several rows with the least id the one with the
    least hash of its columns stays, and of equal rows one.  Columns are those of
    ``docs``.  Rows are found again by two hashes of all their columns, never by
    place, which a changed number of executors may shift between two scans.
    """
    # The row travels as one column, so none of its names can clash.
    named = {f.name: F.col("`" + f.name.replace("`", "``") + "`") for f in docs.schema.fields}
    columns = [named[f.name] for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    whole = [*columns, *(c.isNull() for c in columns)]
    key = ["hash1", "hash2"]
    hashes = [F.xxhash64(F.lit(salt), *whole).alias(f"hash{salt}") for salt in (1, 2)]
    keyed = docs.select(named[doc_id].alias("doc_id"), filled(named[text]).alias("text"), *hashes)
    marked = store(
        shingle_fingerprints(keyed, "text", shingle, ["doc_id", *key], "fingerprint"), "simhash"
    )
    groups = near_groups(marked.withColumn("own", F.col("fingerprint")), "fingerprint", "own", radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *key))
    kept = (
        marked.join(groups, "fingerprint")
        .groupBy("component_id")
        .agg(first.alias("first"))
        .select("first.hash1", "first.hash2")
    )
    # The rank needs no shuffle beside that of the join.
    alike = Window.partitionBy(*key).orderBy("hash1")
    rows = docs.select(F.struct(*(c.alias(n) for n, c in named.items())).alias("row"), *hashes)
    found = rows.join(kept, key, "left_semi").withColumn("nth", F.row_number().over(alike))
    return found.where("nth = 1").select(*(F.col("row")[n].alias(n) for n in docs.columns))


def _around(value: Column, steps: int) -> Column:
    """Array of all values at most ``steps`` bit flips away."""
    flips = [
        _signed(reduce(int.__xor__, (1 << b for b in bits), 0))
        for k in range(steps + 1)
        for bits in combinations(range(BITS), k)
    ]
    return F.transform(F.array(*map(F.lit, flips)), lambda flip: value.bitwiseXOR(flip))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value
