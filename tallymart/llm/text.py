"""Column expressions on text: words, ASCII case, shingle hashes."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def filled(text: str | Column) -> Column:
    """The text as a string, null as empty."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def indexes(count: Column) -> Column:
    """0 .. count - 1; empty if count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def shingle_hashes(words_name: str, size: int) -> Column:
    """XXH64 (seed 42) of each run of ``size`` words joined by a space.

    ``words_name`` names a column of the frame, not an expression: the lambda
    would compute an expression anew for each element.  Fewer words give one
    hash of the whole sequence, none an empty array.
    """
    held = F.col(words_name)
    count = F.size(held)
    runs = F.transform(
        F.sequence(F.lit(0), count - size),
        lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(held, i + k) for k in range(size)))),
    )
    return (
        F.when(count >= size, runs)
        .when(count == 0, F.array().cast("array<bigint>"))
        .otherwise(F.array(F.xxhash64(F.array_join(held, " "))))
    )
