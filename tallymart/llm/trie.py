"""Prefix trie of conversations as a burst trie.

A turn is its digest.  Conversations with equal turns are one class with a weight.
Classes stand in containers under the heads of the trie.  A container of more turns
than a task should sweep is burst: its classes are dealt to containers by the digest of
their next turn, and its head becomes a node of its own.  The containers that remain are
sorted by their suffixes and swept: a stack of the open nodes is all that a task
holds.  Totals of swept containers are added up along the burst heads at the end.

Every step but the sweep handles turns in long form, a row each, so a conversation
of any length is cut over tasks; one that is alone in its container is a chain and
needs no sweep.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import store
from .ranks import ranked_within
from .text import filled

#: A container of more turns is burst.
SWEPT_TURNS = 1000
#: A conversation of more turns is not one row of a container.
LONG_TURNS = 100_000
NOTHING = hashlib.sha256(b"").hexdigest()

_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string"
)


def placed_turns(
    rows: DataFrame, conv_id: str, turn: str, role: str, text: str, long_turns: int = LONG_TURNS
) -> DataFrame:
    """(conv, pos, tid, chars): the turns of each conversation numbered from 0.

    Turns ascend by number, null first, equal numbers by digest.  ``tid`` is the
    digest of role and text, ``chars`` the text's code points.
    """
    who, said = filled(F.col(f"`{role}`")), filled(F.col(f"`{text}`"))
    whole = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256)
    turns = rows.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.substring(whole, 1, 32)).alias("tid"),
        F.char_length(said).cast("long").alias("chars"),
    )
    inside = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "tid")
    number = (F.row_number().over(inside) - 1).cast("long")
    long = turns.groupBy("conv").count().where(F.col("count") > long_turns).select("conv")
    if long.isEmpty():
        return turns.select("conv", number.alias("pos"), "tid", "chars")
    short = turns.join(long, "conv", "left_anti").select("conv", number.alias("pos"), "tid", "chars")
    cut = ranked_within(turns.join(long, "conv", "left_semi"), "conv", ["turn", "tid"])
    return short.unionByName(cut.select("conv", F.col("rank").alias("pos"), "tid", "chars"))


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: (conv, pos, tid, chars) and (conv, len).

    The first h turns of c are those of conversation c - c % ``every``, h being the
    checksum of c modulo ``most``; then come its own after its first h.
    """
    donors = (
        turns.where(f"conv % {every} = 0 AND pos < {most - 1}")
        .groupBy(F.col("conv").alias("donor"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "tid", "chars"))).alias("lead"))
    )
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = store(
        turns.groupBy("conv").agg(F.count("*").alias("n")).withColumn("h", h)
        .join(donors, F.expr(f"conv - conv % {every}") == F.col("donor"), "left")
        .withColumn("k", F.least(F.col("h"), F.coalesce(F.size("lead"), F.lit(0))).cast("long"))
        .select("conv", "n", "h", "k", F.slice("lead", F.lit(1), F.col("k").cast("int")).alias("lead")),
        "conversations",
    )
    lead = convs.where("k > 0").select("conv", F.inline("lead"))
    own = (
        turns.join(convs.select("conv", "h", "k"), "conv").where("pos >= h")
        .select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "tid", "chars")
    )
    size = F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return (
        store(lead.unionByName(own), "rebuilt"),
        convs.select("conv", size.alias("len")),
    )


def classes_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct sequence of turns: cls (its least conversation), len, w, ends.

    ``w`` counts its conversations, ``ends`` is the SHA-256 of their ids, ascending,
    comma-joined.  Sequences are told apart by their length and two hashes of all
    (place, turn), which are combined in the map tasks; no sequence is gathered.
    """
    signs = turns.groupBy("conv").agg(
        *(F.bit_xor(F.xxhash64(F.lit(seed), "pos", "tid")).alias(f"s{seed}") for seed in (1, 2))
    )
    key = ["len", "s1", "s2"]
    marked = store(convs.join(signs, "conv", "left").fillna(0, ["s1", "s2"]), "sequences")
    groups = store(
        marked.groupBy(*key).agg(F.min("conv").alias("cls"), F.count("*").alias("w")), "classes"
    )
    alone = groups.where("w = 1").select(
        "cls", "len", "w", F.sha2(F.col("cls").cast("string"), 256).alias("ends")
    )
    shared = groups.where("w > 1")
    members = ranked_within(marked.join(shared, key).select("cls", "conv"), "cls", ["conv"])
    # The digest of a class is one chain of bytes; it is fed with texts of a thousand ids.
    texts = members.groupBy("cls", F.expr("rank div 1000").alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None

        def out(cls, found):
            return pa.RecordBatch.from_pydict({"cls": pa.array([cls], pa.int64()), "ends": [found.hexdigest()]})

        for batch in batches:
            for cls, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if cls != held:
                    if sums is not None:
                        yield out(held, sums)
                    held, sums = cls, hashlib.sha256(ids.encode())
                else:
                    sums.update(f",{ids}".encode())
        if sums is not None:
            yield out(held, sums)

    ends = (
        texts.repartition("cls").sortWithinPartitions("cls", "chunk").select("cls", "ids")
        .mapInArrow(digest, "cls long, ends string")
    )
    return store(alone.unionByName(shared.join(ends, "cls").select("cls", "len", "w", "ends")), "weighted")


class _Node:
    __slots__ = ("chars", "children", "depth", "ends", "leaves", "owner", "saved", "waiting", "w")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars = depth, chars
        self.owner = self.ends = None
        self.w = self.children = self.leaves = self.saved = 0
        #: Closed children, which need the least member of this node.
        self.waiting: list[_Node] = []

    def row(self, parent: int | None, head: str | None) -> tuple:
        return (
            self.owner, self.depth, parent, self.w, self.children, self.leaves, self.saved,
            self.ends, head,
        )


def swept(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes of the containers: rows as in ``_NODE`` and the head's name for the top ones.

    ``rows`` are (head, depth, parent, chars, cls, w, ends, tids, sizes): container by
    container, suffixes ascending.
    """
    stack: list[_Node] = []
    path: list = []
    head = above = None

    def closed() -> Iterator[tuple]:
        node = stack.pop()
        if not node.children:
            node.leaves = 1
        node.saved += (node.w - 1) * node.chars
        for child in node.waiting:
            yield child.row(node.owner, None)
        node.waiting = []
        if not stack:
            yield node.row(above, head)
            return
        parent = stack[-1]
        parent.w += node.w
        parent.owner = node.owner if parent.owner is None else min(parent.owner, node.owner)
        parent.leaves += node.leaves
        parent.saved += node.saved
        parent.children += 1
        parent.waiting.append(node)

    for name, depth, parent, chars, cls, w, ends, tids, sizes in rows:
        if name != head or not stack:
            while stack:
                yield from closed()
            head, above, path = name, parent, []
            stack.append(_Node(depth, chars))
        same = 0
        for a, b in zip(path, tids):  # noqa: B905
            if a != b:
                break
            same += 1
        while len(stack) > same + 1:
            yield from closed()
        for k in range(same, len(tids)):
            stack.append(_Node(depth + k + 1, sizes[k]))
        path = tids
        node = stack[-1]
        node.w += w
        node.owner = cls if node.owner is None else min(node.owner, cls)
        node.ends = ends
    while stack:
        yield from closed()


def _sweep(containers: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of (head, depth, parent, chars, cls, w, ends); ``head`` names the top node of each."""
    suffixes = (
        turns.select(F.col("conv").alias("cls"), "pos", "tid", F.col("chars").alias("size"))
        .join(containers.select("cls", "depth"), "cls").where("pos >= depth")
        .groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("pos", "tid", "size"))).alias("suffix"))
    )
    rows = containers.join(suffixes, "cls", "left").select(
        "head", "depth", "parent", "chars", "cls", "w", "ends",
        F.coalesce("suffix.tid", F.array().cast("array<binary>")).alias("tids"),
        F.coalesce("suffix.size", F.array().cast("array<bigint>")).alias("sizes"),
    )
    schema = pa.schema([
        *((n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
        ("ends", pa.string()), ("head", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        def handed(held: list[tuple]) -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        held = []
        for row in swept(each()):
            held.append(row)
            if len(held) == 10_000:
                yield handed(held)
                held = []
        if held:
            yield handed(held)

    ordered = rows.repartition("head").sortWithinPartitions("head", "tids")
    return ordered.mapInArrow(run, f"{_NODE}, head string")


def _chains(containers: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of containers with one class, in long form; columns as of ``_sweep``."""
    nodes = turns.select(F.col("conv").alias("cls"), (F.col("pos") + 1).alias("at"), F.col("chars").alias("size"))
    nodes = nodes.join(containers, "cls").where("at >= depth")
    top = containers.where("depth = 0").withColumns({"at": F.lit(0).cast("long"), "size": F.lit(0).cast("long")})
    nodes = nodes.unionByName(top).withColumn("bucket", F.expr("at div 1000"))
    # Sums from the end: inside buckets of turns, and over the sums of the buckets.
    back = Window.partitionBy("cls").orderBy(F.col("bucket").desc())
    after = nodes.groupBy("cls", "bucket").agg(F.sum("size").alias("held")).select(
        "cls", "bucket",
        F.coalesce(F.sum("held").over(back.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("after"),
    )
    inside = Window.partitionBy("cls", "bucket").orderBy(F.col("at").desc())
    to_end = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return nodes.withColumn("inside", to_end).join(after, ["cls", "bucket"]).select(
        F.col("cls").alias("conv_id"),
        F.col("at").alias("depth"),
        F.when(F.col("at") > F.col("depth"), F.col("cls")).otherwise(F.col("parent")).alias("parent_conv_id"),
        F.col("w").alias("n_convs"),
        F.when(F.col("at") < F.col("len"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("w") - 1) * (F.col("inside") + F.col("after"))).alias("saved_tokens"),
        F.when(F.col("at") == F.col("len"), F.col("ends")).alias("ends"),
        F.when(F.col("at") == F.col("depth"), F.col("head")).alias("head"),
    )


def burst_trie(
    turns: DataFrame, classes: DataFrame, swept_turns: int = SWEPT_TURNS, long_turns: int = LONG_TURNS
) -> DataFrame:
    """All nodes of the trie of ``classes``, whose turns are (conv, pos, tid, chars).

    Rounds go on while a container is too large, one turn deeper each; only its
    classes take part, with one turn each.  The number of large containers reaches the driver.
    """
    held = [F.col(c) for c in ("cls", "len", "w", "ends")]
    total = classes.agg(
        F.count("*").alias("n"), F.sum("len").alias("rest"), F.sum("w").alias("w"), F.min("cls").alias("owner")
    )
    large = (F.col("n") > 1) & (F.col("rest") > swept_turns)
    none = F.lit(None).cast("long")
    heads = store(
        total.where("n > 0").select(
            F.lit("").alias("head"), F.lit(None).cast("string").alias("above"), "owner",
            none.alias("parent"), F.lit(0).cast("long").alias("chars"), "w", "n", "rest",
        ),
        "heads",
    )
    placed = classes.select(*held, F.lit("").alias("head"))
    containers, levels, states = [], [], []
    depth = 0
    while True:
        if depth:
            dealt = placed.join(heads.select("head", "parent", "chars", "n", "rest"), "head")
        else:  # one head, so its one row needs no join
            root = heads.first() or {"n": 0, "rest": 0}
            dealt = placed.select(
                "*", none.alias("parent"), F.lit(0).cast("long").alias("chars"),
                F.lit(root["n"]).cast("long").alias("n"), F.lit(root["rest"]).cast("long").alias("rest"),
            )
        containers.append(
            store(
                dealt.where(~large).select(
                    "head", F.lit(depth).cast("long").alias("depth"), "parent", "chars", *held,
                    "n", "rest",
                ),
                "containers",
            )
        )
        levels.append(heads)
        if not heads.where(large).count():
            break
        state = store(dealt.where(large).select("head", *held), "oversized")
        states.append(state)
        following = turns.where(F.col("pos") == depth).select(F.col("conv").alias("cls"), "tid", "chars")
        step = store(
            state.join(following, "cls").select(
                *held, F.col("head").alias("above"), "chars",
                F.md5(F.concat(F.col("head").cast("binary"), F.col("tid"))).alias("head"),
            ),
            "burst",
        )
        kids = step.groupBy("head").agg(
            F.any_value("above").alias("above"), F.min("cls").alias("owner"),
            F.any_value("chars").alias("chars"), F.sum("w").alias("w"), F.count("*").alias("n"),
            F.sum(F.col("len") - (depth + 1)).alias("rest"),
        )
        owners = heads.select(F.col("head").alias("above"), F.col("owner").alias("parent"))
        heads = store(kids.join(owners, "above"), "heads")
        placed = step.select(*held, "head")
        depth += 1

    rest = containers[0]
    for more in containers[1:]:
        rest = rest.unionByName(more)
    single = (F.col("n") == 1) & (F.col("rest") > long_turns)
    found = _sweep(rest.where(~single), turns)
    if not classes.where(F.col("len") > long_turns).isEmpty():
        found = found.unionByName(_chains(rest.where(single), turns))
    found = store(found, "nodes")
    tops = found.where("head IS NOT NULL").select("head", "n_leaves", "saved_tokens")

    # From the deepest burst heads up.
    burst, below = [], None
    for at in reversed(range(depth)):
        kids = levels[at + 1].select(F.col("head").alias("kid"), F.col("above").alias("head"))
        totals = tops if below is None else tops.unionByName(below.select("head", "n_leaves", "saved_tokens"))
        sums = kids.join(totals.withColumnRenamed("head", "kid"), "kid").groupBy("head").agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("kept"),
        )
        ended = states[at].where(F.col("len") == at).select("head", "ends")
        below = store(
            levels[at].where(large).join(sums, "head").join(ended, "head", "left").select(
                F.col("owner").alias("conv_id"), F.lit(at).cast("long").alias("depth"),
                F.col("parent").alias("parent_conv_id"), F.col("w").alias("n_convs"), "n_children",
                "n_leaves", (F.col("kept") + (F.col("w") - 1) * F.col("chars")).alias("saved_tokens"),
                "ends", "head",
            ),
            "burst-nodes",
        )
        burst.append(below)
    for level in burst:
        found = found.unionByName(level)
    return found.drop("head")


def conversation_trie(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    every: int = 100,
    most: int = 6,
    swept_turns: int = SWEPT_TURNS,
    long_turns: int = LONG_TURNS,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt``).

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (in code points), ends_sha256.  Turns without a conversation id belong to
    no conversation and are left out; null roles and texts are empty.  Repeated rows
    are turns of their own.  No conversations give no nodes, not even a root.
    """
    placed = store(placed_turns(rows, conv_id, turn, role, text, long_turns), "turns")
    turns, convs = rebuilt(placed, every, most)
    nodes = burst_trie(turns, classes_of(turns, convs), swept_turns, long_turns)
    return nodes.withColumn("ends_sha256", F.coalesce("ends", F.lit(NOTHING))).drop("ends")
