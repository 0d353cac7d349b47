"""A Merkle manifest of a table: one hash tree per group of rows, kept as blocks in van Emde Boas order.

Leaves of a group stand in key order; every FANOUT consecutive nodes become one node above, until one is left.
The trees are cut into aligned subtrees of LEVELS levels above their leaves. A block stores its subtree as one
binary value: the upper half of its levels first, then the subtrees below, each laid out the same way. So a node and
its relatives stand close together at any scale, the block's root is its first digest, and places are arithmetic.
Roots of blocks are the leaves of the next tier of blocks; roots of groups are the leaves of one last tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tablewright.llm.shared import ranked_within
from tablewright.session import persist_to_shared

FANOUT = 8
LEVELS = 3  # levels above the leaves of a block: at most 512 leaves
DIGEST = 32

# ---------------------------------------------------------------- addresses


def nodes_in(levels: int) -> int:
    """Nodes of a complete subtree with so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` of one ``depth`` (0 is the root) in a complete subtree of ``levels`` levels."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    below = FANOUT ** (depth - top)
    lower = levels - top
    return nodes_in(top) + index // below * nodes_in(lower) + address(depth - top, index % below, lower)


@lru_cache(maxsize=64)
def places(depth: int, levels: int) -> np.ndarray:
    return address(depth, np.arange(FANOUT**depth), levels)


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    height = 0
    while FANOUT**height < n:
        height += 1
    return height


# ---------------------------------------------------------------- one block


def digest_of(parts: list[bytes]) -> bytes:
    """H of digests: their hex texts, concatenated."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def build_block(leaves: np.ndarray, height: int) -> bytes:
    """The stored subtree above ``leaves`` (rows of 32 bytes); absent nodes of an incomplete one are zeros."""
    store = np.zeros((nodes_in(height + 1), DIGEST), np.uint8)
    store[places(height, height + 1)[: len(leaves)]] = leaves
    n = len(leaves)
    for depth in range(height - 1, -1, -1):
        below = hexed(store, depth + 1, height, n)
        n = -(-n // FANOUT)
        made = [bytes.fromhex(digest_of(below[i : i + FANOUT]).decode()) for i in range(0, len(below), FANOUT)]
        store[places(depth, height + 1)[:n]] = np.frombuffer(b"".join(made), np.uint8).reshape(n, DIGEST)
    return store.tobytes()


def hexed(store: np.ndarray, depth: int, height: int, n: int) -> list[bytes]:
    """The first ``n`` digests of a depth as hex texts, by their addresses."""
    text = store[places(depth, height + 1)[:n]].tobytes().hex().encode()
    return [text[i : i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)]


def paths(store: bytes, n: int, height: int) -> Iterator[tuple[bytes, bytes]]:
    """For each of ``n`` leaves: siblings up to the block's root (hex texts), and how many of them stand before and
    after the path's node at each level (two bytes a level)."""
    grid = np.frombuffer(store, np.uint8).reshape(-1, DIGEST)
    wide = 2 * DIGEST
    levels, width = [], n
    for depth in range(height, 0, -1):
        row = hexed(grid, depth, height, width)
        levels.append([b"".join(row[i : i + FANOUT]) for i in range(0, width, FANOUT)])
        width = -(-width // FANOUT)
    for leaf in range(n):
        at, siblings, steps = leaf, [], bytearray()
        for runs in levels:
            run, own = runs[at // FANOUT], at % FANOUT
            siblings += [run[: own * wide], run[(own + 1) * wide :]]
            steps += bytes((own, len(run) // wide - own - 1))
            at //= FANOUT
        yield b"".join(siblings), bytes(steps)


def fold(leaf: bytes, siblings: bytes, steps: bytes) -> bytes:
    """The root that a leaf leads to along its siblings; all digests are hex texts."""
    node, at = leaf, 0
    for before, after in zip(steps[::2], steps[1::2], strict=True):
        middle, end = at + before * 2 * DIGEST, at + (before + after) * 2 * DIGEST
        node = digest_of([siblings[at:middle], node, siblings[middle:end]])
        at = end
    return node


# ---------------------------------------------------------------- tables of blocks


def field(value: Column) -> Column:
    """One input of a leaf: '-' for null, else its length in UTF-8 bytes, ':' and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def extent(n: int, block: int, levels: int) -> tuple[int, int]:
    """(leaves, height) of a block of a tree with ``n`` nodes on this tier; the last tier's only block is as high as it needs."""
    span = FANOUT**levels
    return (n, height_of(n)) if n <= span else (min(span, n - block * span), levels)


def blocks_of(nodes: DataFrame, carry: bool, levels: int) -> DataFrame:
    """``(tree, rank, n, digest[, row])`` to ``(tree, block, n, store[, rows])``: a group is one block's leaves."""
    span = FANOUT**levels
    schema = StructType([StructField("tree", nodes.schema["tree"].dataType)]).add("block", "long").add("n", "long").add("store", "binary")
    if carry:
        schema = schema.add("rows", ArrayType(nodes.schema["row"].dataType))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("rank").combine_chunks()
        n = table.column("n")[0].as_py()
        leaves = np.frombuffer(b"".join(table.column("digest").to_pylist()), np.uint8).reshape(-1, DIGEST)
        height = extent(n, 0, levels)[1]
        columns = {"tree": pa.array([key[0].as_py()], key[0].type), "block": pa.array([key[1].as_py()], pa.int64()),
                   "n": pa.array([n], pa.int64()), "store": pa.array([build_block(leaves, height)], pa.binary())}
        if carry:
            row = table.column("row").combine_chunks()
            row = row.chunk(0) if isinstance(row, pa.ChunkedArray) else row
            columns["rows"] = pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row)
        return pa.table(columns)

    block = F.floor(F.col("rank") / span).cast("long")
    return nodes.withColumn("block", block).groupBy("tree", "block").applyInArrow(build, schema)


def root_of(store: str = "store") -> Column:
    return F.substring(F.col(store), 1, DIGEST)


def tiers_of(nodes: DataFrame, levels: int, carry: bool = False) -> list[DataFrame]:
    """Blocks over the nodes, blocks over the roots of those, and so on until every tree has one block left."""
    span = FANOUT**levels
    tiers = [persist_to_shared(blocks_of(nodes, carry, levels), "blocks")]
    while True:
        roots = tiers[-1].where(F.col("n") > span).select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("n") / span).cast("long").alias("n"), root_of().alias("digest")
        )
        if roots.isEmpty():
            return tiers
        tiers.append(persist_to_shared(blocks_of(roots, False, levels), "blocks"))


ABOVE = ["up_siblings", "up_steps", "subroot", "root"]


def paths_below(blocks: DataFrame, levels: int) -> DataFrame:
    """Blocks with the path of their root to the path of each of their leaves: ``(tree, rank, <path>)``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, height = extent(row["n"], row["block"], levels)
                found = list(paths(row["store"], n, height))
                first = row["block"] * FANOUT**levels
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["tree"]] * n, batch.schema.field("tree").type), pa.array(range(first, first + n), pa.int64()),
                    pa.array([s + row["up_siblings"] for s, _ in found], pa.binary()), pa.array([s + row["up_steps"] for _, s in found], pa.binary()),
                    pa.array([row["subroot"]] * n, pa.binary()), pa.array([row["root"]] * n, pa.binary()),
                ], names=["tree", "rank", *ABOVE])

    schema = StructType([StructField("tree", blocks.schema["tree"].dataType)]).add("rank", "long")
    for c in ABOVE:
        schema = schema.add(c, "binary")
    return blocks.select("tree", "block", "n", "store", *ABOVE).mapInArrow(walk, schema)


def descend(tiers: list[DataFrame], final: DataFrame, levels: int) -> DataFrame:
    """The lowest tier with the path of every block's root; ``final`` holds ``(tree, <path>)`` of each tree's root."""
    above, path = None, F.struct(*ABOVE).alias("path")
    for blocks in reversed(tiers):
        own = final.select(F.col("tree").alias("__t"), F.lit(0).cast("long").alias("__b"), path)
        if above is not None:
            # A tree whose last block is higher up has its path from there.
            higher = above.select(F.col("tree").alias("__t"), F.col("rank").alias("__b"), path)
            taller = blocks.where(F.col("n") > FANOUT**levels).select(F.col("tree").alias("__x")).distinct()
            own = own.join(taller, F.col("__t").eqNullSafe(F.col("__x")), "left_anti").union(higher)
        placed = blocks.join(own, F.col("tree").eqNullSafe(F.col("__t")) & (F.col("block") == F.col("__b"))).drop("__t", "__b")
        placed = placed.select(*blocks.columns, "path.*")
        if blocks is tiers[0]:
            return placed
        above = persist_to_shared(paths_below(placed, levels), "paths")
    raise ValueError("no tiers")


@dataclass
class Manifest:
    """Blocks of all trees and of the tree over their roots. ``rows`` of the lowest tier carry keys and presented leaves."""

    tiers: list[DataFrame]
    top: list[DataFrame]
    levels: int
    groups: DataFrame  # (tree, rank, n, digest): the roots of the trees in their order

    def root(self) -> str | None:
        """The root over everything; None for an empty table."""
        found = self.top[-1].select(F.lower(F.hex(root_of())).alias("r")).first()
        return found["r"] if found else None


def build(docs: DataFrame, fields: list[str], tree: str = "lang", key: str = "doc_id",
          presented: dict[str, Column] | None = None, levels: int = LEVELS) -> Manifest:
    """Write the manifest of ``docs``: a tree per value of ``tree``, leaves in order of ``key``.

    A leaf hashes ``fields``, null and empty apart. ``presented`` replaces fields by other values: these are not
    what the manifest records, but what ``audit`` checks against it. Null keys come first, rows with equal keys stand
    in the order of their digests, equal rows are leaves of their own. A null tree is a tree of its own, the first.
    An empty table has no tree and no root. Columns not named here are not read.
    """
    leaf = leaf_digest([F.col(f) for f in fields])
    shown = leaf if not presented else leaf_digest([presented.get(f, F.col(f)) for f in fields])
    rows = docs.select(F.col(tree).alias("tree"), F.col(key).alias("key"), F.unhex(leaf).alias("digest"), F.unhex(shown).alias("shown"))
    rows = persist_to_shared(rows, "leaves")  # hashed once; the ranks need two passes
    placed = ranked_within(rows, "tree", [F.col("key"), F.col("digest"), F.col("shown")])
    row = F.struct("key", "shown").alias("row")
    tiers = tiers_of(placed.select("tree", F.col("__rank").alias("rank"), F.col("__count").alias("n"), "digest", row), levels, carry=True)
    roots = None
    for blocks in tiers:
        done = blocks.where(F.col("n") <= FANOUT**levels).select("tree", root_of().alias("digest"))
        roots = done if roots is None else roots.union(done)
    roots = persist_to_shared(roots, "roots").withColumn("all", F.lit(0))
    groups = ranked_within(roots, "all", [F.col("tree")]).select("tree", F.col("__rank").alias("rank"), F.col("__count").alias("n"), "digest")
    groups = persist_to_shared(groups, "groups")
    top = tiers_of(groups.select(F.lit(0).alias("tree"), "rank", "n", "digest"), levels)
    return Manifest(tiers, top, levels, groups)


def audit(manifest: Manifest, key: str = "doc_id") -> DataFrame:
    """Check every presented leaf: ``(<key>, leaf, subroot, root, siblings, steps, folded_root, verified)``.

    ``siblings`` are the hex digests that prove the leaf, level by level up to the root and left to right; ``steps``
    holds two bytes a level, how many of them stand before and after. ``folded_root`` is what the presented leaf leads
    to along them, ``verified`` whether that is the root.
    """
    levels, empty = manifest.levels, F.lit(b"")
    start = manifest.top[-1].select(F.lit(0).alias("tree"), empty.alias("up_siblings"), empty.alias("up_steps"), empty.alias("subroot"), root_of().alias("root"))
    upper = paths_below(descend(manifest.top, start, levels), levels).drop("tree", "subroot")
    final = manifest.groups.join(upper, "rank").select("tree", "up_siblings", "up_steps", F.col("digest").alias("subroot"), "root")
    final = persist_to_shared(final, "paths")
    blocks = descend(manifest.tiers, final, levels)
    names = [key, "leaf", "subroot", "root", "siblings", "steps", "folded_root", "verified"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.schema.get_field_index("rows")
            for i, row in enumerate(batch.drop_columns(["rows"]).to_pylist()):
                n, height = extent(row["n"], row["block"], levels)
                rows = batch.column(of).slice(i, 1).flatten()
                shown = rows.field(1).to_pylist()
                leaves = hexed(np.frombuffer(row["store"], np.uint8).reshape(-1, DIGEST), height, height, n)
                root = row["root"].hex()
                siblings, steps, folded = [], [], []
                for claim, (s, t) in zip(shown, paths(row["store"], n, height), strict=True):
                    siblings.append(s + row["up_siblings"])
                    steps.append(t + row["up_steps"])
                    folded.append(fold(claim.hex().encode(), siblings[-1], steps[-1]).decode())
                yield pa.RecordBatch.from_arrays([
                    rows.field(0), pa.array([x.decode() for x in leaves]), pa.array([row["subroot"].hex()] * n), pa.array([root] * n),
                    pa.array([s.decode() for s in siblings]), pa.array(steps, pa.binary()), pa.array(folded), pa.array([f == root for f in folded]),
                ], names=names)

    kind = StructType([StructField(key, blocks.schema["rows"].dataType.elementType["key"].dataType)])
    for name, type_ in zip(names[1:], ["string"] * 4 + ["binary", "string", "boolean"], strict=True):
        kind = kind.add(name, type_)
    return blocks.mapInArrow(check, kind)
