"""Quality rules as a short-circuit cascade.

A rule rejects a document by a condition on measures of its text.  What each
rule costs and how many documents it rejects is estimated on a sample; then the
rules run in the order of rejections per cost, and the measures of a rule are
only computed for documents that no earlier rule has rejected.  The order
changes the time, never the verdict.

All measures are column expressions.  Intermediate arrays are columns of their
own, projected before they are used, because a lambda would compute an
expression from outside anew for each element.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import filled, indexes, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """Rejects where ``rejects()`` holds over the columns named in ``measures``."""

    name: str
    measures: tuple[str, ...]
    rejects: Callable[[], Column]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda: F.col("n_words") < 20),
    Rule(
        "repeated_words",
        ("n_words", "n_repeat_words"),
        lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
    ),
)
MORE_RULES = (
    Rule(
        "symbols", ("n_words", "n_symbols"), lambda: 10 * F.col("n_symbols") > F.col("n_words")
    ),
    Rule(
        "duplicate_lines",
        ("n_lines", "n_dup_lines"),
        lambda: 2 * F.col("n_dup_lines") > F.col("n_lines"),
    ),
    Rule(
        "stuttering",
        ("n_words", "n_stutters"),
        lambda: 5 * F.col("n_stutters") > F.col("n_words"),
    ),
    Rule(
        "word_length",
        ("n_words", "word_chars"),
        lambda: (F.col("word_chars") < 2 * F.col("n_words"))
        | (F.col("word_chars") > 40 * F.col("n_words")),
    ),
)


def _repeat_words(df: DataFrame, add: Callable) -> DataFrame:
    """Words in windows of WINDOW words that occur twice or more in the text.

    Hashes show that all windows differ, which settles most texts; where two
    hashes are equal, the windows themselves are sorted and compared.  Repeated
    windows at p1 < p2 < ... cover min(WINDOW, p2 - p1) + ... + WINDOW words.
    """
    held, last = F.col("_words"), F.size("_words") - WINDOW
    window = lambda i: [F.get(held, i + k) for k in range(WINDOW)]
    starts = indexes(last + 1)
    df = add(df, "_hashes", F.transform(starts, lambda i: F.xxhash64(*window(i))))
    df = df.withColumn("_again", F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
    grams = F.transform(
        starts, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("gram"), i.alias("at"))
    )
    df = df.withColumn("_grams", F.when(F.col("_again"), F.sort_array(grams)))
    gram = lambda i: F.get(F.col("_grams"), i)["gram"]
    twice = F.filter(
        indexes(F.size("_grams")),
        lambda i: F.coalesce(gram(i) == gram(i - 1), F.lit(False))
        | F.coalesce(gram(i) == gram(i + 1), F.lit(False)),
    )
    df = df.withColumn("_twice", F.when(F.col("_again"), twice))
    places = F.sort_array(F.transform("_twice", lambda i: F.get(F.col("_grams"), i)["at"]))
    df = df.withColumn("_places", places).drop("_grams", "_twice", "_hashes")
    covered = F.aggregate(
        indexes(F.size("_places")),
        F.lit(0).cast("bigint"),
        lambda sum_, i: sum_
        + F.least(
            F.coalesce(F.get("_places", i + 1) - F.get("_places", i), F.lit(WINDOW)), F.lit(WINDOW)
        ),
    )
    df = add(df, "n_repeat_words", F.when(F.col("_again"), covered).otherwise(F.lit(0)))
    return df.drop("_places", "_again")


def _lines(df: DataFrame, add: Callable) -> DataFrame:
    lines = F.filter(
        F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    df = add(df, "_lines", lines)
    df = add(df, "n_lines", F.size("_lines"))
    unlike = F.size(F.array_distinct("_lines"))
    return add(df, "n_dup_lines", F.col("n_lines") - unlike).drop("_lines")


def _stutters(df: DataFrame, add: Callable) -> DataFrame:
    held = F.col("_words")
    same = F.filter(indexes(F.size(held)), lambda i: F.get(held, i) == F.get(held, i - 1))
    return add(df, "n_stutters", F.size(same))


# The step that adds each measure, from the columns _text and _words.
MEASURES: dict[str, Callable[[DataFrame, Callable], DataFrame]] = {
    "n_words": lambda df, add: add(df, "n_words", F.size("_words")),
    "word_chars": lambda df, add: add(
        df, "word_chars", F.char_length(F.array_join("_words", ""))
    ),
    "n_symbols": lambda df, add: add(df, "n_symbols", F.regexp_count("_text", F.lit(SYMBOLS))),
    "n_lines": _lines,
    "n_dup_lines": _lines,
    "n_repeat_words": _repeat_words,
    "n_stutters": _stutters,
}


def measured(df: DataFrame, names: Sequence[str], alive: Column | None = None) -> DataFrame:
    """Adds measures that are still missing, as longs; only where ``alive``, else null."""

    def add(frame: DataFrame, name: str, value: Column) -> DataFrame:
        value = value if name.startswith("_") else value.cast("bigint")
        return frame.withColumn(name, value if alive is None else F.when(alive, value))

    for name in names:
        if name not in df.columns:
            df = MEASURES[name](df, add)
    return df


def cascade(df: DataFrame, rules: Sequence[Rule], verdict: str = "failed_rule") -> DataFrame:
    """Adds the name of the first rule that rejects the row, null where all accept it.

    ``df`` has _text and _words; measures that it has already are used as they are.
    The result passes through a generator: a filter on the verdict is not pushed
    below one, where the optimizer would put the measures' expressions into it,
    each as often as it is named.
    """
    df = df.withColumn(verdict, F.lit(None).cast("string"))
    for rule in rules:
        alive = F.col(verdict).isNull()
        df = measured(df, rule.measures, alive)
        df = df.withColumn(
            verdict, F.when(alive, F.when(rule.rejects(), F.lit(rule.name))).otherwise(F.col(verdict))
        )
    return df.drop("_text", "_words").select(F.inline(F.array(F.struct("*"))))


def prepared(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The columns to keep as the struct _doc, with the row's text and words."""
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_doc")
    texts = docs.select(row, filled(F.col(f"`{text}`")).alias("_text"))
    return texts.withColumn("_words", words(F.col("_text")))


def by_rejection_per_cost(
    docs: DataFrame, text: str, rules: Sequence[Rule], rows: int = SAMPLE_ROWS, seed: int = 7
) -> list[Rule]:
    """The rules in the order of rejections per second on a sample of about ``rows`` documents.

    A rule's cost is the time of a job that applies it alone, less that of a job
    that applies none.  Ties and an empty sample leave the given order.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = docs.select(F.col(f"`{text}`").alias("text"))
    # All tasks of the scan sample; what they found, about ``rows`` rows, is dealt to a few.
    sample = sample.sample(min(1.0, rows / total), seed).repartition(8)
    sample = prepared(sample, "text", ["text"]).drop("_doc").persist()
    try:
        sample.count()

        def run(rule: Rule | None) -> tuple[float, int]:
            frame = measured(sample, rule.measures) if rule else sample
            rejects = rule.rejects() if rule else F.size("_words") < 0
            start = time.perf_counter()
            rejected = frame.agg(F.count_if(rejects)).first()[0]
            return time.perf_counter() - start, rejected

        idle = min(run(None)[0] for _ in range(2))
        rate = {}
        for rule in rules:
            seconds, rejected = run(rule)
            rate[rule.name] = rejected / max(seconds - idle, 1e-3)
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda rule: -rate[rule.name])


def judged(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = BASE_RULES + MORE_RULES
) -> DataFrame:
    """The columns of ``docs`` as the struct _doc, and ``failed_rule``, null where kept.

    The rules run in the order estimated on a sample.  A null text has no words.
    """
    ordered = by_rejection_per_cost(docs, text, rules)
    return cascade(prepared(docs, text, docs.columns), ordered).select("_doc", "failed_rule")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with the columns of ``docs``.

    A null text has no words and is rejected; repeated rows are judged alike and stay
    repeated.  No rows give none.
    """
    kept = judged(docs, text).where(F.col("failed_rule").isNull())
    return kept.select(*(F.col("_doc")[c].alias(c) for c in docs.columns))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, all base measures, base_failed, kept.

    The base measures are wanted for every document, so the cascade only spares
    the measures of the other rules.  Repeated rows are kept; no rows give none.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = by_rejection_per_cost(source, "text", MORE_RULES)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    frame = measured(prepared(source, "text", ["doc_id"]), base)
    failed = F.lit(False)
    for rule in BASE_RULES:
        failed = failed | rule.rejects()
    frame = frame.withColumn("base_failed", failed)
    passing = Rule("base", (), lambda: F.col("base_failed"))
    frame = cascade(frame, [passing, *ordered])
    return frame.select(
        F.col("_doc")["doc_id"].alias("doc_id"), *base, "base_failed",
        F.col("failed_rule").isNull().alias("kept"),
    )
