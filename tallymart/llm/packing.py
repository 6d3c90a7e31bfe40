"""Best-fit packing of token sequences by exact-complement hashing.

Documents are cut into pieces of at most ``capacity`` tokens.  How pieces share
sequences depends on lengths alone, so the driver plans over the number of
pieces of each length, ``capacity`` numbers whatever the input.  From the longest
length down, the gap beside it is filled exactly by a single length, a pair or a
triple from sums indexed over the lengths still available; as many sequences of
that make-up are planned as the counts allow, at once.  Where nothing fills the
gap exactly, the longest length that fits goes in and the rest of the gap is
tried again.  The n-th piece of a length then takes the n-th place planned for it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import store
from .batched import slices
from .bpe import BATCH_CHARS, Encoder, Vocabulary

BUCKETS = 256


class Available:
    """Numbers of pieces by length, with the sums that they can fill."""

    def __init__(self, counts: dict[int, int]):
        self.counts = Counter({k: n for k, n in counts.items() if n > 0})
        self._index()

    def _index(self) -> None:
        """Bit s of ``singles`` and ``pairs``: some length, some two lengths sum up to s."""
        self.singles = sum(1 << k for k in self.counts)
        self.pairs = 0
        for k in self.counts:
            self.pairs |= self.singles << k
        self.down = sorted(self.counts, reverse=True)

    def take(self, lengths: list[int], times: int) -> None:
        gone = False
        for k, n in Counter(lengths).items():
            self.counts[k] -= n * times
            if not self.counts[k]:
                del self.counts[k]
                gone = True
        if gone:
            self._index()

    def has(self, lengths: list[int]) -> bool:
        return all(self.counts[k] >= n for k, n in Counter(lengths).items())

    def exact(self, gap: int, beside: list[int]) -> list[int] | None:
        """A single, pair or triple that fills the gap beside lengths taken already."""
        if self.singles >> gap & 1 and self.has([*beside, gap]):
            return [gap]
        found = self._pair(gap, beside)
        if found:
            return found
        for k in self.down:
            if k < gap and self.pairs >> (gap - k) & 1:
                found = self._pair(gap - k, [*beside, k])
                if found:
                    return [k, *found]
            if 3 * k < gap:
                break
        return None

    def _pair(self, total: int, beside: list[int]) -> list[int] | None:
        if self.pairs >> total & 1:
            for k in self.down:
                if 2 * k < total:
                    break
                if k < total and self.singles >> (total - k) & 1:
                    if self.has([*beside, k, total - k]):
                        return [k, total - k]
        return None

    def longest_fit(self, gap: int, beside: list[int]) -> int | None:
        return next((k for k in self.down if k <= gap and self.has([*beside, k])), None)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Make-ups of sequences and how often each is used; every piece is used once."""
    left, made = Available(counts), []
    while left.counts:
        chosen = [left.down[0]]
        gap = capacity - chosen[0]
        while gap:
            filling = left.exact(gap, chosen)
            if filling is None:
                best = left.longest_fit(gap, chosen)
                if best is None:
                    break
                filling = [best]
            chosen += filling
            gap -= sum(filling)
        times = min(left.counts[k] // n for k, n in Counter(chosen).items())
        left.take(chosen, times)
        made.append((chosen, times))
    return made


def places(made: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first, end, sequence, offset): the pieces of a length numbered first to end - 1
    go to the sequences from ``sequence`` on, one each, at that offset."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for k in lengths:
            rows.append((k, used[k], used[k] + times, sequence, offset))
            used[k] += times
            offset += k
        sequence += times
    return rows


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; all but the first are full."""
    first = size if size <= capacity else size % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, size, capacity))]


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int, end_id: int, doc_id: str, text: str,
    special: bool = False, batch_bytes: int = BATCH_CHARS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, bucket of every piece.

    ``bucket`` deals the pieces of a task out in turn, so that those of one length
    can be numbered in many groups.
    """
    encoder = Encoder(Vocabulary.from_json(vocabulary, special))

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "bucket"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = 0
        for part in parts:
            docs_of = part.column(0).to_pylist()
            for first, texts in slices(part.column(1), batch_bytes):
                rows = []
                for at, ids in enumerate(encoder.encode(texts), first):
                    ids = np.append(ids, end_id).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        crc = zlib.crc32(ids[start : start + length])
                        rows.append((docs_of[at], k, start, length, crc, dealt % BUCKETS))
                        dealt += 1
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    kind = docs.schema[doc_id].dataType
    sent = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    made = sent.mapInArrow(
        run, "doc_id string, piece int, start long, length long, ids_crc32 long, bucket int"
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 without gaps among the pieces of each length.

    Pieces are numbered inside (length, bucket); the sizes of these groups, of a
    number set by capacity and BUCKETS, are summed up.
    """
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    placed = pieces.withColumn("place", F.row_number().over(inside) - 1)
    return placed.join(offsets, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("place")
    )


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    special: bool = False,
    batch_bytes: int = BATCH_CHARS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each text (null: empty) is encoded by the tokenizer file, with ``special`` added
    tokens in it as their single ids, and ``end_id`` is put after it; texts of more than
    ``capacity`` ids are cut into full pieces after a first one that may be shorter.
    Repeated rows are pieces of their own.  No rows give no sequences.

    A task encodes ``batch_bytes`` of text at a time; more take more memory and less
    time, as a word is replayed once per batch.
    """
    made = token_pieces(docs, vocabulary, capacity, end_id, doc_id, text, special, batch_bytes)
    pieces = store(made, "pieces")
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    planned = docs.sparkSession.createDataFrame(
        places(plan(counts, capacity)),
        "length long, first long, end long, sequence long, offset long",
    )
    # Every make-up uses up a length or leaves less of it than it takes, so the
    # plan has a few rows per length, whatever the number of pieces.
    ranked = numbered(pieces)
    fits = (
        (ranked["length"] == planned["length"])
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("end"))
    )
    return ranked.join(F.broadcast(planned), fits).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
    )
