"""Byte-level BPE by corpus-level merge replay.

A batch of texts is one corpus.  Its distinct pieces (matches of the pattern) are
laid out as one array of byte tokens, and an inverted index holds, for each rank,
the positions where that rank's pair stands.  Every rank is applied once, in order,
to all of its positions at a time; only the touched neighbours are looked up anew
and enter the index.  Texts are then put together from the pieces' ids.

A text is cut at single spaces before the pattern is matched, so each distinct
run between spaces is matched once per batch.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a batch of texts that are encoded together.
BATCH_CHARS = 5_000_000
_NEVER = np.int32(2**31 - 1)
#: Where a space has white space on its left, a run of it reaches over the cut.
_BLANK_THEN_SPACE = tuple(f"{c} " for c in "\t\n\x0b\x0c\r \x85\xa0")


def _class(letter: str, end: int = 0x250) -> str:
    return "".join(re.escape(chr(i)) for i in range(end) if unicodedata.category(chr(i))[0] == letter)


def _latin_pattern() -> re.Pattern:
    """The pattern for texts below U+0250, where the classes can be listed."""
    letters, digits, blanks = _class("L"), _class("N"), r"\t-\r \x85\xa0"
    return re.compile(
        rf" ?[{letters}]+| ?[{digits}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{blanks}{letters}{digits}]+"
        rf"|[{blanks}]+(?![^{blanks}])|[{blanks}]+"
    )


def _full_pattern() -> regex.Pattern:
    blank = r"\p{White_Space}"
    return regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{blank}\p{{L}}\p{{N}}]+"
        rf"|{blank}+(?![^{blank}])|{blank}+"
    )


class _Numbers(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def _sorted_once(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)
    return numbers[np.r_[True, numbers[1:] != numbers[:-1]]] if len(numbers) else numbers


def gathered(
    flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray
) -> np.ndarray:
    """The runs ``flat[starts[c] : starts[c] + sizes[c]]`` of the chosen c, one after another."""
    lengths = sizes[chosen]
    ends = np.cumsum(lengths, dtype=np.int64)
    if not len(ends):
        return flat[:0]
    shift = np.repeat(starts[chosen] - (ends - lengths), lengths)
    return flat[shift + np.arange(ends[-1])]


class Vocabulary:
    """Tokens by id and the merges in rank order.

    ``merges`` are (left id, right id, rank, new id).  With ``whole``, a piece that
    is a token itself is not split at all.  ``added`` are contents that are one id
    wherever they stand; no pattern or merge sees them.
    """

    def __init__(
        self, tokens: list[bytes], merges: np.ndarray, whole: bool, added: dict[str, int] | None = None
    ):
        self.tokens, self.whole, self.added = tokens, whole, added or {}
        self.ids = {token: i for i, token in enumerate(tokens)}
        #: Ids of what is not replayed: whole tokens by their bytes, added ones by their id.
        self.known = (self.ids if whole else {}) | {i: i for i in self.added.values()}
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        keys = merges[:, 0].astype(np.int64) * len(tokens) + merges[:, 1]
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = merges[order, 2].astype(np.int32)
        self.made = np.zeros(int(merges[:, 2].max()) + 1, np.int32)
        self.made[merges[:, 2]] = merges[:, 3]
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    @classmethod
    def from_ranks(cls, path: str) -> Vocabulary:
        """A file of base64 tokens and ranks; two tokens merge where their bytes are a token."""
        with open(path, "rb") as lines:
            ranked = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        tokens = [b""] * (max(ranked.values()) + 1)
        for token, rank in ranked.items():
            tokens[rank] = token
        merges = [
            (ranked[token[:k]], ranked[token[k:]], rank, rank)
            for token, rank in ranked.items()
            for k in range(1, len(token))
            if token[:k] in ranked and token[k:] in ranked
        ]
        return cls(tokens, np.array(merges), True)

    @classmethod
    def from_json(cls, path: str, special: bool = False) -> Vocabulary:
        """A tokenizer file with a vocabulary in byte characters and a list of merges.

        With ``special``, the file's added tokens are single ids, as the library has
        them when loaded; without, their text is like any other, as with the
        library's ``encode_special_tokens``.
        """
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        added = {t["content"]: t["id"] for t in held.get("added_tokens", ())} if special else {}
        for t in held.get("added_tokens", ()) if special else ():
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"added token with a rule of its own: {t}")
        # Printable bytes stand for themselves, the others for U+0100 onwards, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
        ids = model["vocab"]
        tokens = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for name, i in ids.items():
            tokens[i] = bytes(byte[c] for c in name) if set(name) <= byte.keys() else b""
        for name, i in added.items():
            tokens[i] = name.encode()
        merges = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            merges.append((ids[a], ids[b], rank, ids[a + b]))
        return cls(tokens, np.array(merges), False, added)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NEVER)

    def decode(self, ids: np.ndarray) -> bytes:
        return gathered(self.flat, self.starts, self.sizes, ids).tobytes()

    def one_by_one(self, piece: bytes) -> list[int]:
        """A single piece, least rank first, leftmost among equals."""
        held = [int(self.bytes[b]) for b in piece]
        while len(held) > 1:
            ranks = self.pair_ranks(np.array(held[:-1]), np.array(held[1:]))
            at = int(ranks.argmin())
            if ranks[at] == _NEVER:
                break
            held[at : at + 2] = [int(self.made[ranks[at]])]
        return held

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces, with the start and the number of those of each piece."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        text = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(text)
        token = self.bytes[text]
        ends = np.cumsum(sizes)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        full = sizes > 0
        after[ends[full] - 1] = -1
        before[(ends - sizes)[full]] = -1
        rank_at = np.full(n + 1, _NEVER, np.int32)  # of the pair that starts there; [-1] is no place
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(places: np.ndarray) -> np.ndarray:
            """Looks the pairs at these places up and adds them to the index."""
            following = after[places]
            ranks = self.pair_ranks(token[places], token[following])
            ranks[following < 0] = _NEVER
            rank_at[places] = ranks
            some = ranks != _NEVER
            places, found = places[some], ranks[some]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            edges = [0, *cuts.tolist(), len(found)] if len(found) else []
            for lo, hi in zip(edges, edges[1:], strict=False):
                rank = int(found[lo])
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(queue, rank)
                index[rank].append(places[lo:hi])
            return ranks

        if n:
            enter(np.arange(n, dtype=np.int32))
        odd: list[np.ndarray] = []
        while queue:
            rank = heapq.heappop(queue)
            parts = index.pop(rank)
            places = parts[0] if len(parts) == 1 else _sorted_once(np.concatenate(parts))
            places = places[rank_at[places] == rank]
            if not len(places):
                continue
            taken = after[places]
            touching = np.r_[False, taken[:-1] == places[1:]]
            if touching.any():  # of a run of overlapping pairs, every other one
                number = np.arange(len(places))
                first = np.maximum.accumulate(np.where(touching, 0, number))
                keep = (number - first) % 2 == 0
                places, taken = places[keep], taken[keep]
            following = after[taken]
            token[places] = self.made[rank]
            token[taken] = -1
            rank_at[taken] = _NEVER
            after[places] = following
            some = following >= 0
            before[following[some]] = places[some]
            left = before[places]
            touched = _sorted_once(np.r_[places, left[left >= 0]])
            ranks = enter(touched)
            late = ranks < rank
            if late.any():
                odd.append(touched[late])
        left_over = token >= 0
        flat = token[left_over].astype(np.uint32)
        so_far = np.r_[0, np.cumsum(left_over)]
        starts = so_far[ends - sizes]
        number = so_far[ends] - starts
        if odd:  # a pair of an earlier rank arose: the order within the piece decides
            again = _sorted_once(np.searchsorted(ends, np.concatenate(odd), side="right"))
            for k in again.tolist():
                ids = np.array(self.one_by_one(pieces[k]), np.uint32)
                starts[k], number[k] = len(flat), len(ids)
                flat = np.r_[flat, ids]
        return flat, starts, number


class Encoder:
    """Encodes batches of texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # Most runs are one word, which is one match of the pattern.
        self.word = re.compile(rf" ?[{_class('L')}]+\Z")
        self.latin, self.full = _latin_pattern(), _full_pattern()
        self.beyond = re.compile("[^\x00-ɏ]")
        # The longest first, where one begins another.
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None

    def pieces(self, text: str) -> list[str]:
        """The pattern's matches."""
        if text.isascii() or not self.beyond.search(text):
            return self.latin.findall(text)
        return self.full.findall(text)

    def runs(self, text: str) -> list[str]:
        """The text in parts that match the pattern alone as they do together."""
        if text[-1:] == " " or any(pair in text for pair in _BLANK_THEN_SPACE) or not (
            text.isascii() or not self.beyond.search(text)
        ):
            return self.pieces(text)
        return text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.pieces(text)

    def parts(self, text: str) -> list[str | int]:
        """The runs of the text between added tokens, and the ids of these."""
        if self.added is None or not self.added.search(text):
            return self.runs(text)
        out: list[str | int] = []
        for k, part in enumerate(self.added.split(text)):
            out += [self.vocabulary.added[part]] if k % 2 else self.runs(part)
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; all texts are one corpus."""
        runs, pieces = _Numbers(), _Numbers()
        numbered = []
        for text in texts:
            parts = self.parts(text)
            numbered.append(np.fromiter(map(runs.__getitem__, parts), np.int32, len(parts)))
        held_sizes, held = array("q"), array("q")  # numbers side by side, not as objects
        for run in runs:
            if isinstance(run, int) or self.word.match(run):
                held_sizes.append(1)
                held.append(pieces[run])
            else:
                inside = self.pieces(run)
                held_sizes.append(len(inside))
                held.extend(map(pieces.__getitem__, inside))
        del runs
        run_sizes, run_flat = np.frombuffer(held_sizes, np.int64), np.frombuffer(held, np.int64)
        flat, starts, sizes = self._encode_pieces(
            [p if isinstance(p, int) else p.encode() for p in pieces]
        )
        # The ids of each run, from those of its pieces.
        ids = gathered(flat, starts, sizes, run_flat)
        edges = np.r_[0, np.cumsum(sizes[run_flat])]
        ends = np.cumsum(run_sizes)
        id_starts = edges[ends - run_sizes]
        id_sizes = edges[ends] - id_starts
        for parts in numbered:
            yield gathered(ids, id_starts, id_sizes, parts)

    def _encode_pieces(self, pieces: list[bytes | int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = self.vocabulary.known
        rest = [p for p in pieces if p not in known]
        flat, starts, sizes = self.vocabulary.replay(rest)
        if len(rest) == len(pieces):
            return flat, starts, sizes
        all_starts, all_sizes = np.zeros(len(pieces), np.int64), np.ones(len(pieces), np.int64)
        is_rest = np.array([p not in known for p in pieces])
        all_starts[is_rest], all_sizes[is_rest] = starts, sizes
        singles = np.array([known[p] for p in pieces if p in known], np.uint32)
        all_starts[~is_rest] = len(flat) + np.arange(len(singles))
        return np.r_[flat, singles], all_starts, all_sizes


def batches(texts: list[str], most: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of at most ``most`` characters, or of one text."""
    start = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text) > most:
            yield slice(start, k)
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``vocabulary`` is the path of a rank file; the driver reads it and sends the
    tables, some megabytes, to the tasks.  A null text is empty and has no tokens.
    The ids are hashed as little-endian unsigned 32-bit numbers, the bytes that
    they decode to beside them.  Each row gives one row; tasks hold one batch.
    """
    encoder = Encoder(Vocabulary.from_ranks(vocabulary))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            rows = []
            for part in batches(texts):
                for ids in encoder.encode(texts[part]):
                    rows.append(
                        (
                            len(ids),
                            hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                            hashlib.sha256(encoder.vocabulary.decode(ids)).hexdigest(),
                        )
                    )
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield pd.concat([frame[["doc_id"]].reset_index(drop=True), out], axis=1)

    # Ids travel as text: a null among them would turn numbers into floats.
    kind = docs.schema[doc_id].dataType
    sent = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    made = sent.mapInPandas(
        run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))
