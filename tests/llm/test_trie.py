"""The trie of conversations against sets of prefixes."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from tallymart.llm import trie
from tallymart.llm.queries import QUERIES

COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def sequences(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    """Rebuilt conversations of (conv_id, turn, role, text); a % b as SQL has it."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            held[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r[3], r[4]) for r in sorted(turns)] for c, turns in held.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(donor, [])[:h] + turns[h:]
    return out


def brute(rows: list[tuple]) -> Counter:
    made = sequences(rows)
    ids, chars, parent, depth, members, ends = {}, [0], [None], [0], [set()], [[]]
    for c, turns in made.items():
        at = 0
        members[0].add(c)
        for turn in turns:
            if (at, turn) not in ids:
                ids[at, turn] = len(chars)
                chars.append(len(turn[1]))
                parent.append(at)
                depth.append(depth[at] + 1)
                members.append(set())
                ends.append([])
            at = ids[at, turn]
            members[at].add(c)
        ends[at].append(c)
    children, leaves, saved = Counter(parent), Counter(), Counter()
    for k in reversed(range(len(chars))):  # children have larger numbers
        leaves[k] += not children[k]
        saved[k] += (len(members[k]) - 1) * chars[k]
        leaves[parent[k]] += leaves[k]
        saved[parent[k]] += saved[k]
    out = Counter()
    for k in range(len(chars)) if made else ():
        sha = hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
        up = None if parent[k] is None else min(members[parent[k]])
        out[min(members[k]), depth[k], up, len(members[k]), children[k], leaves[k], saved[k], sha] += 1
    return out


def got(df) -> Counter:
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def as_rows(df) -> list[tuple]:
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def test_query_against_brute_force(spark, sf_dir):
    path = sf_dir.replace("0.001", "0.01")
    rows = as_rows(spark.read.parquet(f"{path}/conversations.parquet"))
    assert got(QUERIES["op13_conversation_trie"](spark, path)) == brute(rows)


@pytest.mark.parametrize("swept_turns, long_turns", [(3, 100_000), (20, 4), (1, 1), (100_000, 100_000)])
def test_burst_swept_and_long(spark, swept_turns, long_turns):
    """Few different turns, so that prefixes are shared and conversations repeat."""
    rows = []
    for c in range(240):
        size = (c * 37) % 9 if c % 3 else 4
        for t in range(size):
            rows.append((c, t, "user" if t % 2 else "bot", f"w{c * (t + 3) % (2 + t // 2)}" if c % 3 else f"same {t}"))
    rows += [(1000, t, "user", f"long {t // 2}") for t in range(2500)]
    rows += [(2000, t, "user", f"long {t // 2}") for t in range(2500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if swept_turns < 100:  # these two share 2,500 turns, a round each
        df = df.where("conv_id < 1000 OR turn < 30")
    nodes = trie.conversation_trie(df, swept_turns=swept_turns, long_turns=long_turns)
    assert got(nodes) == brute(as_rows(df))


def test_long_chains(spark):
    """One conversation with most of all turns is cut, and so are copies of it."""
    rows = [(c, t, "user", f"{t} x") for c in (107, 205, 309) for t in range(1500)]
    rows += [(c, t, "user", f"y{c % 3}") for c in range(50) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(trie.conversation_trie(df, swept_turns=50, long_turns=500)) == brute(as_rows(df))
    alone = df.where("conv_id > 100")
    assert got(trie.conversation_trie(alone, swept_turns=50, long_turns=500)) == brute(as_rows(alone))


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost", 0),
        (1, None, None, None, 1),
        (1, None, None, None, 1),
        (1, 3, "user", "b", 1),
        (1, 3, "user", "a", 1),
        (1, 3, "user", "a", 1),
        (2, 1, "", "", 2),
        (-105, 1, "é", "é" * 70_000, 2),
        (-100, 1, "é", "first", 2),
        (200, 0, "user", "x", 2),
        (201, 0, "user", "y", 2),
        (207, 0, None, "", 2),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, len int")
    df = df.selectExpr("*", "len AS conv", "len AS pos", "len AS tid", "len AS `a.b`", "len AS head")
    for swept_turns in (1, 1000):
        assert got(trie.conversation_trie(df, swept_turns=swept_turns)) == brute(as_rows(df))
    empty = trie.conversation_trie(df.limit(0))
    assert empty.count() == 0 and set(COLUMNS) <= set(empty.columns)
    assert trie.conversation_trie(df.where("conv_id IS NULL")).count() == 0


def test_turnless_conversation(spark):
    """Own turns all replaced, by a conversation that is not there."""
    c = next(c for c in range(301, 400) if zlib.crc32(str(c).encode()) % 6 == 5)
    df = spark.createDataFrame([(c, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert got(trie.conversation_trie(df)) == Counter(
        [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    )
