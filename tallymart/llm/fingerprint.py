"""SimHash fingerprints of documents and search within a Hamming radius.

Terms are word shingles; each occurrence is a vote of the term's hash, so terms
weigh as often as they occur.  All columns are DataFrame expressions.

The search cuts the fingerprint's bits into blocks.  Of ``blocks`` blocks at most
``radius`` can differ, so two fingerprints within the radius agree on some choice
of the others: each choice is a table that keys the fingerprints by its blocks,
that is, by its bits of a permutation that brings these blocks to the front.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import store
from . import votes
from .text import filled, shingle_hashes, words

BITS = 64


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return (F.lit(BITS) - F.bit_count(a.bitwiseXOR(b))) / F.lit(float(BITS))


def block_masks(radius: int, blocks: int) -> list[int]:
    """A mask for each choice of ``blocks - radius`` blocks, as signed 64-bit numbers."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def within_radius(
    queries: DataFrame, fingerprints: DataFrame, name: str, radius: int = 3, blocks: int = 6
) -> DataFrame:
    """All (query, found, distance) of distinct fingerprints at most ``radius`` bits apart.

    Both frames have the fingerprint in column ``name``; nulls find nothing.  With
    6 blocks and radius 3 there are 20 tables of 31 to 33 bits each, so only a few
    unlike fingerprints meet in a bucket.  The output is as large as the answer:
    ask with a set of queries, not with all documents.
    """
    masks = [
        F.struct(F.lit(t).alias("table"), F.col(name).bitwiseAND(F.lit(mask)).alias("part"))
        for t, mask in enumerate(block_masks(radius, blocks))
    ]
    asked, held = (
        frame.select(name).where(F.col(name).isNotNull()).distinct()
        .select(F.col(name).alias(as_), F.inline(F.array(*masks)))
        for frame, as_ in ((queries, "query"), (fingerprints, "found"))
    )
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    met = asked.join(held, ["table", "part"]).select("query", "found", distance.alias("distance"))
    return met.where(F.col("distance") <= radius).distinct()


def fingerprints(
    docs: DataFrame, key: list[str], text: str, shingle: int = 3, name: str = "fingerprint"
) -> DataFrame:
    """One row per ``key``: the fingerprint of the text as a long.  ``key`` tells the rows apart."""
    split = docs.select(*key, words(filled(text)).alias("_words"))
    hashed = split.select(*key, shingle_hashes("_words", shingle).alias("_hashes"))
    return votes.fingerprints(hashed, key, "_hashes", name)


def with_next(
    docs: DataFrame, doc_id: str, text: str, rows_per_range: int = 2000, most_ranges: int = 20_000
) -> DataFrame:
    """Each document and the text after it: doc_id, text, next_text, range, place, guest.

    The order is by descending id, null last, then by the text's checksum and the
    text; the document after the last is the first.  No task sees the whole order:
    ids are cut at quantiles into ranges, and each range also gets the first row of
    the range after it, marked as a guest, to be dropped by the caller.  What the
    driver sees are the cuts and one id per range.  Rows with equal ids share a range.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), filled(text).alias("text"))
    ranges = max(1, min(most_ranges, rows.count() // rows_per_range))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 50_000)).first()[0] if shares else None
    cuts = sorted(set(cuts or []))
    # Ranges are numbered along the order.
    rows = rows.withColumn(
        "range",
        F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
            F.lit(len(cuts)) - _cuts_below(F.col("doc_id"), cuts)
        ),
    )
    order = [F.col("doc_id").desc_nulls_last(), F.crc32(F.col("text").cast("binary")), F.col("text")]
    tops = sorted(rows.groupBy("range").agg(F.max("doc_id")).collect())
    places = [
        (found, top, tops[k - 1][0]) for k, (found, top) in enumerate(tops)
    ]  # the first range's top is the guest of the last
    heads = rows.sparkSession.createDataFrame(places, "of int, top bigint, to int")
    same = (F.col("range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top"))
    first = Window.partitionBy("to").orderBy(*order)
    guests = (
        rows.join(F.broadcast(heads), same)
        .withColumn("nth", F.row_number().over(first))
        .where("nth = 1")
        .select("doc_id", "text", F.col("to").alias("range"), F.lit(1).alias("guest"))
    )
    along = Window.partitionBy("range").orderBy("guest", *order)
    return (
        rows.withColumn("guest", F.lit(0))
        .unionByName(guests)
        .withColumn("next_text", F.lead("text").over(along))
        .withColumn("place", F.row_number().over(along))
    )


def _cuts_below(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are less than the value, by bisection."""
    if not cuts:
        return F.lit(0)
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # folded once
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            F.coalesce(F.get(held, at + step - 1) < value, F.lit(False)), at + step
        ).otherwise(at),
    )


def report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One row per document: its fingerprint, that of an edited text, and how alike they are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex),
    near_edited, near_next, and n_near, for ids divisible by 100 the number of other
    documents whose fingerprints are within ``radius`` bits (else null).

    The edited text is the text with its last n_chars // 2 code points replaced by
    as many from the start of the next document's, or by all if it has fewer.  A
    single document is its own next one.  A null text is empty, and has
    fingerprint 0.  Repeated rows are kept, each next to the other.
    """
    size = F.col("n_chars")
    half = F.floor(size / 2).cast("int")
    placed = with_next(docs, doc_id, text).withColumn("n_chars", F.char_length("text"))
    edited = F.concat(
        F.substring("text", F.lit(1), size - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    row = ["range", "place", "guest", "doc_id", "n_chars"]
    bodies = placed.withColumn("edited", edited).select(
        *row,
        F.inline(
            F.array(
                F.struct(F.lit("").alias("sha"), F.col("text").alias("body")),
                F.struct(F.sha2("edited", 256).alias("sha"), F.col("edited").alias("body")),
            )
        ),
    )
    marked = fingerprints(bodies, [*row, "sha"], "body", shingle)
    own = F.col("sha") == ""
    both = marked.groupBy(*row).agg(
        F.max(F.when(own, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(~own, F.col("fingerprint"))).alias("edited_fingerprint"),
        F.max("sha").alias("edited_sha256"),
    )
    along = Window.partitionBy("range").orderBy("place")
    chained = store(
        both.withColumn("next", F.lead("fingerprint").over(along)).where("guest = 0"), "prints"
    )
    result = chained.select(
        "doc_id",
        size.cast("bigint").alias("n_chars"),
        "edited_sha256",
        votes.as_hex("fingerprint").alias("fingerprint"),
        votes.as_hex("edited_fingerprint").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
        F.col("fingerprint").alias("query"),
        F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False)).alias("asked"),
    )
    asked = chained.where(F.col("doc_id") % 100 == 0)
    classes = chained.groupBy("fingerprint").agg(F.count("*").alias("documents"))
    found = within_radius(asked, classes, "fingerprint", radius)
    near = (
        found.join(classes, found["found"] == classes["fingerprint"])
        .groupBy("query")
        .agg((F.sum("documents") - 1).alias("n_near"))
        .withColumn("asked", F.lit(True))
    )
    return result.join(near, ["query", "asked"], "left").drop("query", "asked")
