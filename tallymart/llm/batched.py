"""Python functions over batches of texts, one result per document."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def by_document(
    docs: DataFrame,
    doc_id: str,
    text: str,
    run: Callable[[list[str]], Iterable[tuple]],
    schema: str,
) -> DataFrame:
    """doc_id and the columns of ``schema``: a tuple per text of each batch; null texts are empty.

    Ids travel as text, because a null among numbers would turn them into floats.
    """
    kind = docs.schema[doc_id].dataType
    names = StructType.fromDDL(schema).names

    def batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.DataFrame(list(run(frame["text"].tolist())), columns=names)
            out.insert(0, "doc_id", frame["doc_id"].tolist())
            yield out

    sent = docs.select(
        F.col(f"`{doc_id}`").cast("string").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    made = sent.mapInPandas(batch, f"doc_id string, {schema}")
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """(place, texts) of runs of at most ``most`` bytes, or of one text; only these become Python strings."""
    sizes = pa.compute.binary_length(texts.cast(pa.binary())).to_pylist()
    start = held = 0
    for k, size in enumerate(sizes):
        if held and held + size > most:
            yield start, texts.slice(start, k - start).to_pylist()
            start, held = k, 0
        held += size
    if start < len(sizes):
        yield start, texts.slice(start).to_pylist()


def keep_rows(docs: DataFrame, text: str, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows for whose text ``keep`` says so, all columns untouched; null texts are empty."""
    at = docs.columns.index(text)

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or "" for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(keep(texts), pa.bool_()))

    # Names with dots are no names to mapInArrow, so columns travel by place.
    placed = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    return placed.mapInArrow(batch, placed.schema).toDF(*docs.columns)


def lowered(text: str) -> str:
    """Lower case, character by character, so that offsets stay."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def least_hashed(
    rows: DataFrame, group: str, key: str, most: int, sizes: dict
) -> DataFrame:
    """(group, key) of the ``most`` keys of each group with the least hashes, each once.

    ``sizes`` has the rows of each group, which are few.  Only hashes under a share
    that leaves about four times as many rows, or 64, are ranked, so what meets in one
    task does not grow with the table.
    """
    hashed = F.xxhash64(F.lit(5), key)
    share = F  # one CASE, not nested: there may be many groups
    for name, size in sizes.items():
        share = share.when(F.col(group) == name, F.lit(min(1.0, max(4 * most, 64) / max(size, 1))))
    share = share.otherwise(F.lit(0.0)) if sizes else F.lit(0.0)
    near = rows.where(F.pmod(hashed, F.lit(1 << 31)) / float(1 << 31) < share).select(group, key)
    order = Window.partitionBy(group).orderBy(F.pmod(hashed, F.lit(1 << 31)), key)
    ranked = near.distinct().withColumn("nth", F.row_number().over(order))
    return ranked.where(F.col("nth") <= most).select(group, key)


def sampled(rows: DataFrame, group: str, most: int, sizes: dict) -> DataFrame:
    """About ``most`` rows at most of each group: (doc_id, text, group), least hashes first.

    Equal rows count once.  ``sizes`` is as in ``least_hashed``.
    """
    keyed = rows.select(group, F.xxhash64("doc_id", "text").alias("key"))
    chosen = least_hashed(keyed, group, "key", most, sizes)
    held = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    # ``chosen`` has at most ``most`` rows per group.
    found = held.join(F.broadcast(chosen), [group, "key"])
    return found.groupBy(group, "key").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
