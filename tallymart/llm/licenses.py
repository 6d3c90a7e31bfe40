"""License scans by winnowed fingerprints of templates and banded alignment.

Templates and texts are sequences of lower-case words.  Each template of n words may
be met with at most E edits, a fifth of its words.  E edits leave at most E + 1 runs
of unchanged words, one of them with R = ceil(matched / (E + 1)) words or more.
The template's grams of g words are winnowed in windows of w with g + w - 1 = R, so
every run of R words has a kept gram and an inverted index of the kept grams, looked
up with all grams of a text, misses no template.  A hit names a template and a
diagonal; around it, E diagonals to each side, template and text are aligned by the
least edits, which tells the matched words and the span.

Words that tell licenses apart (names, versions, terms) have to match, and none of
another license may stand in the span; where only the version differs, the family is
reported.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batched import by_document, lowered
from .license_texts import TEMPLATES

COVERAGE, LONGEST_GRAM = 0.8, 3
TOKEN = re.compile(r"\w+")
#: Words that tell licenses apart; so do numbers.
IDENTITY = frozenset(
    "affero agpl apache bsd bsl cc cc0 clause 0bsd epl gnu gpl isc later lesser lgpl mit mozilla mpl nc nd only sa "
    "unlicense zlib".split()
)
_GOES_ON = re.compile(r"\.0*[1-9]")
#: In longer templates other words and numbers may come in between, as of a list.
SHORT_TEMPLATE = 40


def edits_allowed(size: int, least: float = COVERAGE) -> tuple[int, int]:
    """(words that have to match, edits allowed) for a template of ``size`` words."""
    matched = int(np.ceil(least * size - 1e-9))
    return matched, max(1, size - matched)


def gram_and_window(size: int, least: float = COVERAGE) -> tuple[int, int]:
    """Words of a gram and grams of a window that no allowed number of edits can evade."""
    matched, edits = edits_allowed(size, least)
    run = -(-matched // (edits + 1))
    gram = max(1, min(LONGEST_GRAM, run - 1))
    return gram, run - gram + 1


def winnowed(hashes: list[int], window: int) -> list[int]:
    """Places of the least hash of each window, the last of equal ones."""
    kept = set()
    for at in range(max(1, len(hashes) - window + 1)):
        part = hashes[at : at + window]
        kept.add(at + max(k for k, h in enumerate(part) if h == min(part)))
    return sorted(kept)


def aligned(
    template: list[int], words: list[int], first: int, last: int
) -> tuple[int, list[tuple[int, int]]]:
    """(edits, matched places) of the template against the part of ``words`` that needs the least.

    A missing, replaced or inserted word is an edit; the part may begin and end anywhere.
    Only the diagonals (place in words less place in template) first to last are looked
    at.  Of parts with equal edits the one that matches more counts, then the first to end.
    """
    width = last - first + 1
    far = len(template) + len(words) + 1
    # (edits, -matched) after each row by diagonal; steps: 0 a pair, 1 template word missing, 2 inserted.
    costs = [(0, 0) if 0 <= first + k <= len(words) else (far, 0) for k in range(width)]
    steps: list[list[int]] = []
    for row, wanted in enumerate(template):
        here, chosen = [], []
        for k in range(width):
            at = row + first + k  # the word that would be paired
            options = []
            if 0 <= at < len(words):
                edits, matched = costs[k]
                same = words[at] == wanted
                options.append((edits + (not same), matched - same, 0))
            if k + 1 < width and 0 <= at + 1 <= len(words):
                edits, matched = costs[k + 1]
                options.append((edits + 1, matched, 1))
            if k and 0 < at + 1 <= len(words):
                edits, matched = here[k - 1]
                options.append((edits + 1, matched, 2))
            edits, matched, step = min(options, default=(far, 0, 0))
            here.append((edits, matched))
            chosen.append(step)
        costs = here
        steps.append(chosen)
    ends = [(edits, matched, k) for k, (edits, matched) in enumerate(costs)]
    edits, _, k = min(ends, default=(far, 0, 0))
    if edits >= far:
        return far, []
    pairs, row = [], len(template) - 1
    while row >= 0:
        step, at = steps[row][k], row + first + k
        if step == 0:
            if words[at] == template[row]:
                pairs.append((row, at))
            row -= 1
        elif step == 1:
            row, k = row - 1, k + 1
        else:
            k -= 1
    return edits, pairs[::-1]


def family(name: str) -> str:
    """The license without its version and what follows it."""
    return re.sub(r"-\d.*", "", name)


class Templates:
    """The inverted index from kept grams to template and place."""

    def __init__(self, templates: Sequence[tuple[str, str]], least: float = COVERAGE):
        if not all(TOKEN.search(text) for _, text in templates):
            raise ValueError("a template needs a word")
        self.names = [name for name, _ in templates]
        self.numbers: dict[str, int] = {}
        self.words, self.limits, self.kept = [], [], []
        postings: dict[int, list[tuple[int, int, int]]] = {}
        tokens_of = [TOKEN.findall(lowered(text)) for _, text in templates]
        for tokens in tokens_of:
            self.words.append([self.numbers.setdefault(t, len(self.numbers) + 1) for t in tokens])
            self.limits.append(edits_allowed(len(tokens), least))
        self.base = len(self.numbers) + 1
        for template, tokens in enumerate(tokens_of):
            gram, window = gram_and_window(len(tokens), least)
            codes = self.codes(np.array(self.words[template], np.int64), gram).tolist()
            hashes = [zlib.crc32(" ".join(tokens[k : k + gram]).encode()) for k in range(len(codes))]
            self.kept.append(winnowed(hashes, window))
            postings.setdefault(gram, []).extend((codes[p], template, p) for p in self.kept[-1])
        #: By gram length: codes in order, with their templates and places.
        self.index = {
            gram: tuple(np.array(column, np.int64) for column in zip(*sorted(held), strict=True))
            for gram, held in postings.items()
        }
        self.digits = {n for word, n in self.numbers.items() if word.isdecimal()}
        self.telling = {n for word, n in self.numbers.items() if word in IDENTITY} | self.digits

    def codes(self, numbers: np.ndarray, gram: int) -> np.ndarray:
        """A number for each run of ``gram`` words, -1 where a word is in no template."""
        if len(numbers) < gram:
            return np.zeros(0, np.int64)
        out = np.zeros(len(numbers) - gram + 1, np.int64)
        known = np.ones(len(out), bool)
        for k in range(gram):
            part = numbers[k : k + len(out)]
            out = out * self.base + part
            known &= part > 0
        return np.where(known, out, -1)

    def hits(self, numbers: np.ndarray) -> dict[int, list[int]]:
        """Diagonals with a kept gram of the text, in order, by template."""
        found: dict[int, set[int]] = {}
        for gram, (codes, templates, places) in self.index.items():
            own = self.codes(numbers, gram)
            low, high = np.searchsorted(codes, own, "left"), np.searchsorted(codes, own, "right")
            for at in np.flatnonzero(high > low).tolist():
                for k in range(low[at], high[at]):
                    found.setdefault(int(templates[k]), set()).add(at - int(places[k]))
        return {template: sorted(diagonals) for template, diagonals in found.items()}

    def verdict(
        self, template: int, pairs: list[tuple[int, int]], tokens: list[str]
    ) -> str | None:
        """The license to report by its identity words: the template's, its family, or none."""
        words = self.words[template]
        rows, places = {r for r, _ in pairs}, {p for _, p in pairs}
        missing = {w for r, w in enumerate(words) if r not in rows and w in self.telling}
        between: list[str] = []
        if len(words) <= SHORT_TEMPLATE:
            between = [tokens[k] for k in range(pairs[0][1], pairs[-1][1]) if k not in places]
        if missing - self.digits or IDENTITY.intersection(between):
            return None
        if missing or any(word.isdecimal() for word in between):
            return family(self.names[template])
        return self.names[template]

    def found(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, matched, start, end) in the order of the text; offsets in code points.

        Of overlapping finds, the one with more matched words stays, then the higher
        coverage, the earlier start and the first template.
        """
        low = lowered(text)
        tokens = TOKEN.findall(low)
        get = self.numbers.get
        numbers = np.fromiter((get(t, 0) for t in tokens), np.int64, len(tokens))
        finds = []
        for template, diagonals in self.hits(numbers).items():
            words, (least, most) = self.words[template], self.limits[template]
            mine = np.array(words)
            seen = set()
            for diagonal in diagonals:
                shift = max(0, diagonal - most)
                near = numbers[shift : max(0, diagonal + most + len(words))]
                present = np.zeros(self.base, bool)
                present[near] = True
                if np.count_nonzero(present[mine]) < least:
                    continue
                edits, pairs = aligned(
                    words, near.tolist(), diagonal - most - shift, diagonal + most - shift
                )
                if edits > most or len(pairs) < least:
                    continue
                pairs = [(row, at + shift) for row, at in pairs]
                span = pairs[0][1], pairs[-1][1] + 1
                if span in seen:
                    continue
                seen.add(span)
                name = self.verdict(template, pairs, tokens)
                if name is not None:
                    finds.append((len(pairs), len(pairs) / len(words), *span, template, name))
        finds.sort(key=lambda f: (-f[0], -f[1], f[2], f[4]))
        kept: list[tuple] = []
        taken = np.zeros(len(tokens), bool)
        for find in finds:
            if not taken[find[2] : find[3]].any():
                taken[find[2] : find[3]] = True
                kept.append(find)
        if not kept:
            return []
        edges = [m.span() for m in TOKEN.finditer(low)]
        out = []
        for matched, coverage, start, end, _, name in sorted(kept, key=lambda f: f[2]):
            if tokens[end - 1].isdecimal() and _GOES_ON.match(low, edges[end - 1][1]):
                name = family(name)  # the version goes on
            out.append((name, coverage, matched, edges[start][0], edges[end - 1][1]))
        return out


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    doc_id: str = "doc_id",
    text: str = "text",
    least: float = COVERAGE,
) -> DataFrame:
    """One row per license found: doc_id, license, coverage, matched, start, end.

    ``coverage`` is the share of a template's words that the text has in order, at least
    ``least``; start and end are code points, end exclusive.  Null and empty texts have
    no licenses.  Repeated rows give repeated finds; no rows give none.
    """
    held = Templates(templates, least)

    def run(texts: list[str]) -> Iterable[tuple]:
        for t in texts:
            keys = ("license", "coverage", "matched", "start", "end")
            yield ([dict(zip(keys, f, strict=True)) for f in held.found(t)],)

    found = by_document(
        docs, doc_id, text, run,
        "found array<struct<license: string, coverage: double, matched: bigint, start: bigint, end: bigint>>",
    )
    return found.select("doc_id", F.inline("found"))
