"""Merkle manifest of a data set by butterfly exchange.

Every document is a leaf; the leaves of a language form a tree with runs of eight,
and the roots of the languages, the subroots, form another above them.

A partition is an aligned block of 8^3 leaves, which hashes its own subtree.  Then blocks
meet in rounds, as in a butterfly: in round r a block and the blocks that differ from
it in the r-th digit of their number, to base eight, swap the subtree roots they have
so far, and each hashes the parent for itself.  After the last round every block
has the root and the siblings on its way up, so no pass leads down again.  Where the
last subtree has fewer blocks than its sisters, its blocks serve several of theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import store
from .ranks import ranked_within
from .text import ascii_lower

FANOUT = 8
#: Levels inside a block, so FANOUT ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 3


def depth(leaves: int) -> int:
    """Levels above the leaves: while there are several nodes, runs of FANOUT become one."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FANOUT), levels + 1
    return levels


def _depth(leaves: Column) -> Column:
    """``depth`` as a column: the powers of FANOUT below the number."""
    return sum(F.when(leaves > FANOUT**k, 1).otherwise(0) for k in range(21))


def sized(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _joined(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ""), 256)


def blocks_of(items: DataFrame, tree: str, order: list[str], digest: str) -> DataFrame:
    """One row per block of a tree: tree, n, block, ``items``, node.

    ``items`` are the rows of the block, at most FANOUT ** BLOCK_LEVELS, in the order
    (``order``, then digest, nulls first); ``n`` counts the leaves of the tree, ``node``
    is the block's subtree root.
    """
    size = FANOUT**BLOCK_LEVELS
    ranked = ranked_within(items, tree, [*order, digest])
    held = [F.col(c) for c in items.columns if c != tree]
    blocks = ranked.groupBy(tree, F.expr(f"rank div {size}").alias("block")).agg(
        F.any_value("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("rank", *held))).alias("items"),
    )
    # A row of nodes per level; columns, because an expression used twice is computed twice.
    levels = _depth(F.col("n"))
    blocks = blocks.withColumn("_nodes", F.col(f"items.{digest}"))
    for k in range(BLOCK_LEVELS):
        runs = F.sequence(F.lit(0), F.expr(f"(size(_nodes) - 1) div {FANOUT}").cast("int"))
        above = F.transform(
            runs, lambda i: _joined(F.slice(F.col("_nodes"), i * FANOUT + 1, F.lit(FANOUT)))
        )
        blocks = blocks.withColumn("_nodes", F.when(levels > k, above).otherwise(F.col("_nodes")))
    return store(blocks.select(tree, "n", "block", "items", F.col("_nodes")[0].alias("node")), "leaves")


def butterfly(blocks: DataFrame, tree: str) -> DataFrame:
    """One row per block: tree, block, node (now the root of its tree) and path.

    ``path`` has, for each level above the block, the siblings to the ``left`` and to
    the ``right`` as concatenated digests.
    """
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    state = blocks.select(tree, "n", "block", "node", nothing.alias("path"))
    # One number reaches the driver.
    most = blocks.agg(F.max("n")).first()[0] or 0
    for done in range(max(0, depth(most) - BLOCK_LEVELS)):
        state = _round(state, tree, done)
    return store(state, "paths")


def _round(state: DataFrame, tree: str, done: int) -> DataFrame:
    """Blocks swap roots with those that differ in the digit number ``done`` and hash the parent."""
    width = FANOUT**done  # blocks of a subtree so far
    group = width * FANOUT
    total = F.expr(f"(n + {FANOUT**BLOCK_LEVELS - 1}) div {FANOUT**BLOCK_LEVELS}")
    block = F.col("block")
    low, digit = block % width, F.expr(f"block div {width}") % FANOUT
    # Blocks of the own subtree; a last one may have fewer than ``width``, and then its
    # blocks take turns for those of its sisters.
    own = F.least(F.lit(width), total - (block - low))
    base = block - block % group
    served = F.flatten(
        F.transform(
            F.array(*(F.lit(d * width).cast("bigint") for d in range(FANOUT))),
            lambda at: F.transform(
                F.sequence(low, F.lit(width - 1).cast("bigint"), own), lambda x: base + at + x
            ),
        )
    )
    active = state.where(total > width).withColumn("_total", total)
    sent = active.select(
        tree, "n", "_total", F.explode(served).alias("to"), digit.alias("digit"), "node",
        block.alias("of"), "path",
    ).where(F.col("to") < F.col("_total"))
    met = (
        sent.select(tree, "n", "to", F.struct("digit", "node").alias("part"),
                    F.when(F.col("of") == F.col("to"), F.col("path")).alias("path"))
        .groupBy(tree, "to")
        .agg(
            F.any_value("n").alias("n"),
            # At most FANOUT.
            F.array_sort(F.collect_list("part")).alias("parts"),
            F.first("path", ignorenulls=True).alias("path"),
        )
    )
    nodes = F.col("parts.node")
    # The digits present have no gaps, so the own one is the place in the run.
    place = (F.expr(f"to div {width}") % FANOUT).cast("int")
    step = F.struct(
        F.array_join(F.slice(nodes, F.lit(1), place), "").alias("left"),
        F.array_join(F.slice(nodes, place + 2, F.lit(FANOUT)), "").alias("right"),
    )
    met = met.select(
        tree, "n", F.col("to").alias("block"), _joined(nodes).alias("node"),
        F.concat("path", F.array(step)).alias("path"),
    )
    finished = state.where(total <= width)
    return met.unionByName(finished)


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


def inside_paths(leaves: list[str], levels: int) -> list[list[tuple[str, str]]]:
    """Siblings left and right of each leaf on each level inside a block."""
    paths: list[list[tuple[str, str]]] = [[] for _ in leaves]
    nodes, width = leaves, 1
    for _ in range(levels):
        runs = [nodes[at : at + FANOUT] for at in range(0, len(nodes), FANOUT)]
        for k, path in enumerate(paths):
            run, place = runs[k // width // FANOUT], k // width % FANOUT
            path.append(("".join(run[:place]), "".join(run[place + 1 :])))
        nodes = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
        width *= FANOUT
    return paths


def leaves_of(
    docs: DataFrame, fields: list[str], tree: str, doc_id: str, text: str, tampered: Column
) -> DataFrame:
    """(doc_id, tree, leaf, tampered): digests of the rows, and of those rows as tampered with."""
    parts = [sized(F.col(f"`{f}`")) for f in fields]
    changed = [sized(ascii_lower(F.col(f"`{text}`").cast("string"))) if f == text else sized(F.col(f"`{f}`")) for f in fields]
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{tree}`").cast("string").alias("tree"),
        F.sha2(F.concat(*parts), 256).alias("leaf"),
        F.when(F.coalesce(tampered, F.lit(False)), F.sha2(F.concat(*changed), 256)).alias("tampered"),
    )


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tree: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
    tamper_every: int = 3,
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes ``fields`` of the row, each ``-`` if null, else sized.  Leaves of a
    ``tree`` (null is one) ascend by id, null first; equal ids by their digest, so
    repeated rows are leaves of their own.  Trees ascend bytewise, null first.  Where
    ``tamper_every`` divides the id's checksum, never for a null id, the proof is also
    held against the row with A-Z of its text lower-cased; all others are held against
    their own leaf.  No rows give no rows.
    """
    id_sum = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    # Written once: cutting ranges reads its input twice, and these rows come from whole texts.
    leaves = store(leaves_of(docs, list(fields), tree, doc_id, text, id_sum % tamper_every == 0), "digests")
    blocks = blocks_of(leaves, "tree", ["doc_id"], "leaf")
    paths = butterfly(blocks, "tree")
    # A row per tree; the tree above them is made alike.
    subroots = paths.where("block = 0").select(
        F.lit(0).alias("above"), F.col("tree").alias("under"), F.col("node").alias("subroot")
    )
    top_blocks = blocks_of(subroots, "above", ["under"], "subroot")
    tops = top_blocks.join(
        butterfly(top_blocks, "above").select("block", F.col("node").alias("root"), F.col("path").alias("top_path")),
        "block",
    )

    top_schema = pa.schema([
        ("under", pa.string()), ("root", pa.string()),
        ("top_path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
    ])

    def above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, items, root, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                inside = inside_paths([i["subroot"] for i in items], min(BLOCK_LEVELS, depth(n)))
                for item, own in zip(items, inside, strict=True):
                    steps = [{"left": a, "right": b} for a, b in own]
                    rows.append({"under": item["under"], "root": root, "top_path": steps + path})
            yield pa.RecordBatch.from_pylist(rows, schema=top_schema)

    above_trees = tops.select("n", "items", "root", "top_path").mapInArrow(
        above, "under string, root string, top_path array<struct<left:string,right:string>>"
    )
    same_block = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))
    ways = paths.join(above_trees, F.col("tree").eqNullSafe(F.col("under"))).select(
        F.col("tree").alias("_tree"), F.col("block").alias("_block"), F.col("node").alias("subroot"),
        "root", F.concat("path", "top_path").alias("path"),
    )
    sent = blocks.join(ways, same_block).select("n", "items", "subroot", "root", "path")

    schema = pa.schema(
        [(n, pa.string()) for n in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [("verified", pa.bool_())]
    )

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, items, subroot, root, upper in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                after = [(s["left"], s["right"]) for s in upper]
                inside = inside_paths([i["leaf"] for i in items], min(BLOCK_LEVELS, depth(n)))
                rows = []
                for item, own in zip(items, inside, strict=True):
                    path = own + after
                    proof = hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest()
                    found = folded(item["tampered"] or item["leaf"], path)
                    rows.append(
                        (item["doc_id"], item["leaf"], subroot, root, proof, found, found == root)
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                    schema=schema,
                )

    # Ids travel as text whatever their type.
    kind = docs.schema[doc_id].dataType
    as_text = F.transform(
        "items",
        lambda i: F.struct(i["doc_id"].cast("string").alias("doc_id"), i["leaf"].alias("leaf"), i["tampered"].alias("tampered")),
    )
    made = sent.withColumn("items", as_text).mapInArrow(
        prove,
        "doc_id string, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean",
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))
