"""Merkle manifest of a table, and its versions: trees of aligned blocks, changed by path copying.

Rows are the leaves of one tree per language; the roots of these trees are the leaves of one more
tree. A node is the hash of up to eight neighbours. Aligned blocks of 8^4 leaves are single
records, so a task climbs four levels at once, and block roots are the leaves of the next round.

A changed leaf makes a version of the tree. It shares all nodes with the original but its own
ancestors, which are copied: first inside the leaf's block, then along the block's way to the root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bounded, dealt, ordered_number, stored, wrapped

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
BLOCK_LEVELS = 4
BLOCK = FAN**BLOCK_LEVELS
# Blocks whose ways to the root may be sent to every task: at most some 10 KB each.
BROADCAST_BLOCKS = 2_000

WAY = "array<struct<left: binary, right: binary>>"
_WAY = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def digest(*parts: bytes) -> bytes:
    """Lowercase hex digits of the hash of the parts laid end to end."""
    return sha256(b"".join(parts)).hexdigest().encode()


def encoded(column: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def lower_case(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def climb(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """The levels over a block's nodes, themselves first; `total` is the width of the whole level."""
    levels = [nodes]
    while total > 1 and len(levels) <= BLOCK_LEVELS:
        below = levels[-1]
        levels.append([digest(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
        total = -(-total // FAN)
    return levels


def siblings(level: list[bytes], i: int) -> tuple[bytes, bytes]:
    """The other nodes of a node's run: those before it and those after it."""
    first = i - i % FAN
    return b"".join(level[first:i]), b"".join(level[i + 1 : first + FAN])


def way_up(levels: list[list[bytes]], i: int) -> list[tuple[bytes, bytes]]:
    """Siblings of leaf i and of its ancestors, up to the block's root."""
    return [siblings(level, i // FAN**k) for k, level in enumerate(levels[:-1])]


def copied_path(leaf: bytes, way: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The ancestors a new leaf needs of its own, lowest first: all that a version adds."""
    copies = []
    for left, right in way:
        leaf = digest(left, leaf, right)
        copies.append(leaf)
    return copies


@dataclass
class Tree:
    """The rounds of a tree or of many: blocks (tree, total, block, nodes) from the leaves upwards,
    and what is left of each tree (tree, digest)."""

    rounds: list[DataFrame]
    roots: DataFrame


def in_blocks(nodes: DataFrame, *more: str) -> DataFrame:
    """One record per aligned block: at most BLOCK nodes in order of their slots."""
    block = F.expr(f"slot div {BLOCK}").alias("block")
    members = F.array_sort(F.collect_list(F.struct("slot", "digest", *more)))
    return nodes.groupBy("tree", "total", block).agg(members.alias("nodes"))


def _block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        total = b.column(1).to_pylist()
        found, width = [], []
        for members, t in zip(b.column(3).to_pylist(), total):
            levels = climb([x.hex().encode() for x in members], t)
            found.append(bytes.fromhex(levels[-1][0].decode()))
            width.append(-(-t // FAN ** (len(levels) - 1)))
        columns = [b.column(0), pa.array(width, pa.int64()), b.column(2), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["tree", "total", "slot", "digest"])


def grown(blocks: DataFrame) -> Tree:
    """Round by round: the roots of one round's blocks are the nodes of the next one's. A round
    leaves one node of 8^4, so their number is the logarithm of the widest tree's."""
    rounds = [blocks]
    while True:
        digests = F.transform("nodes", lambda x: x["digest"])
        slim = rounds[-1].select("tree", "total", "block", digests.alias("digests"))
        tops = stored(slim.mapInArrow(_block_roots, "tree string, total bigint, slot bigint, digest binary"), "tops")
        if tops.where("total > 1").isEmpty():
            return Tree(rounds, tops.select("tree", "digest"))
        rounds.append(stored(in_blocks(tops), "blocks"))


def _node_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        trees, totals, members, ways, tops = (b.column(c).to_pylist() for c in range(5))
        for tree, total, nodes, way, top in zip(trees, totals, members, ways, tops):
            levels = climb([x["digest"].hex().encode() for x in nodes], total)
            rest = [(x["left"], x["right"]) for x in way]
            out = [[{"left": a, "right": z} for a, z in way_up(levels, i) + rest] for i in range(len(nodes))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * len(nodes), pa.string()),
                    pa.array([x["slot"] for x in nodes], pa.int64()),
                    pa.array(out, _WAY),
                    pa.array([top] * len(nodes), pa.binary()),
                ],
                ["tree", "block", "way", "top"],
            )


def with_ways(blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """Blocks with the way from their root up, and the root of their tree."""
    return blocks.join(bounded(ways, BROADCAST_BLOCKS), ["tree", "block"])


def block_ways(tree: Tree, tops: DataFrame) -> DataFrame:
    """(tree, block, way, top) for the lowest blocks; `tops` has them for each tree's last block."""
    ways = tops
    for blocks in reversed(tree.rounds[1:]):
        joined = with_ways(blocks, ways).select("tree", "total", "nodes", "way", "top")
        ways = stored(joined.mapInArrow(_node_ways, f"tree string, block bigint, way {WAY}, top binary"), "ways")
    return ways


def leaves(docs: DataFrame, fields: tuple[str, ...], changed: dict[str, Column], when: Column) -> DataFrame:
    """Stored: tree key, id, digest, and the digest of the changed row where there is one."""
    inside = {c: F.col("row")[c] for c in fields}
    before = F.concat(*[encoded(inside[c]) for c in fields])
    after = F.concat(*[encoded(F.col("new")[c] if c in changed else inside[c]) for c in fields])
    new = F.struct(F.lit(0).alias("none"), *[v.alias(c) for c, v in changed.items()])
    rows = wrapped(docs, new=new, tampered=F.coalesce(when, F.lit(False)))
    lang = inside["lang"].cast("string")
    key = F.coalesce(F.concat(F.lit("v"), lang), F.lit("n"))
    slim = rows.select(
        key.alias("tree"),
        inside["doc_id"].alias("doc_id"),
        F.unhex(F.sha2(before, 256)).alias("digest"),
        F.when(F.col("tampered"), F.unhex(F.sha2(after, 256))).alias("changed"),
    )
    return stored(dealt(slim), "leaves")


def with_slots(rows: DataFrame) -> DataFrame:
    """`slot` and `total`: a leaf's place in its tree and the tree's width, from sorted ranges. A
    tree may span many ranges; one count per tree and range is summed up."""
    order = ["tree", "doc_id", "digest"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = stored(ranges.withColumn("at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("at", 33).alias("part")
    counts = ranges.groupBy("tree", part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("base"),
        F.sum("n").over(tree).alias("total"),
    )
    placed = ranges.withColumn("part", part).join(bounded(stored(base, "bases")), ["tree", "part"])
    return placed.withColumn("slot", F.col("at") + F.col("base")).drop("at", "base", "part")


def manifest(
    docs: DataFrame,
    changed: Callable[[DataFrame], dict[str, Column]] | None = None,
    when: Callable[[DataFrame], Column] | None = None,
    fields: tuple[str, ...] = FIELDS,
) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, and for the version in which this
    row has its `changed` columns `when` that holds (else for the original) folded_root, verified
    and copies, the digests of the ancestors copied for it, lowest first.

    By default the letters A-Z of the texts whose id has a crc32 that 3 divides are lower-cased.
    Nulls in any field are hashed as `-`; a null language is a tree of its own, the first one;
    a null id comes first in its tree and isn't changed by default. Rows with the same id are leaves
    of their own in the order of their digests; equal rows have the same digests but each its own
    place. A single row is its own subroot and root, with the hash of nothing as proof. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    new = changed(docs) if changed else {"text": lower_case(docs["text"])}
    which = when(docs) if when else F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    rows = with_slots(leaves(docs, fields, new, which))
    forest = grown(stored(in_blocks(rows, "doc_id", "changed"), "blocks"))

    # The subroots are the leaves of one more tree.
    subroots = ordered_number(forest.roots, [F.col("tree")], "slot")
    subroots = stored(subroots.withColumn("total", forest.roots.agg(F.count(F.lit(1))).scalar()), "subroots")
    top = grown(stored(in_blocks(subroots.withColumn("tree", F.lit(""))), "blocks"))
    last = top.roots.first()
    root = last["digest"] if last else b""

    nothing = F.array().cast(WAY)
    start = top.rounds[-1].select("tree", "block", nothing.alias("way"), F.lit(root).alias("top"))
    above = with_ways(top.rounds[0], block_ways(top, start)).select("tree", "total", "nodes", "way", "top")
    above = above.mapInArrow(_node_ways, f"tree string, block bigint, way {WAY}, top binary")
    of_trees = subroots.select("tree", F.col("slot").alias("block"), F.col("digest").alias("subroot"))
    starts = above.drop("tree", "top").join(of_trees, "block").select("tree", F.lit(0).cast("bigint").alias("block"), "way", F.col("subroot").alias("top"))

    kind = docs.schema["doc_id"].dataType
    schema = (
        f"doc_id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean, copies array<string>"
    )
    hex_root = root.hex().encode()

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            totals, ways, tops = (b.column(c).to_pylist() for c in (0, 2, 3))
            for k in range(b.num_rows):
                members = b.column(1)[k].values
                yield _proofs(members, totals[k], ways[k], tops[k].hex(), hex_root, schema)

    placed = with_ways(forest.rounds[0], block_ways(forest, stored(starts, "ways")))
    return placed.select("total", "nodes", "way", "top").mapInArrow(proofs, schema)


def _proofs(members: pa.StructArray, total: int, way: list, subroot: str, root: bytes, schema: str) -> pa.RecordBatch:
    """The rows of one block."""
    nodes = [x.hex().encode() for x in members.field("digest").to_pylist()]
    levels = climb(nodes, total)
    rest = [(x["left"], x["right"]) for x in way]
    above = b"".join(a + z for a, z in rest)
    # What a proof adds from a node upwards is the same for all leaves below that node.
    tails = {(len(levels) - 1, 0): above}

    def tail(level: int, i: int) -> bytes:
        if (level, i) not in tails:
            left, right = siblings(levels[level], i)
            tails[level, i] = left + right + tail(level + 1, i // FAN)
        return tails[level, i]

    proof, folded, copies = [], [], []
    for i, new in enumerate(members.field("changed").to_pylist()):
        if len(levels) > 1:
            left, right = siblings(nodes, i)
            proof.append(sha256(left + right + tail(1, i // FAN)).hexdigest())
        else:
            proof.append(sha256(above).hexdigest())
        leaf = nodes[i] if new is None else new.hex().encode()
        path = copied_path(leaf, way_up(levels, i) + rest)
        folded.append(path[-1] if path else leaf)
        copies.append([] if new is None else [x.decode() for x in path])
    n = len(nodes)
    return pa.RecordBatch.from_arrays(
        [
            members.field("doc_id"),
            pa.array([x.decode() for x in nodes], pa.string()),
            pa.array([subroot] * n, pa.string()),
            pa.array([root.decode()] * n, pa.string()),
            pa.array(proof, pa.string()),
            pa.array([x.decode() for x in folded], pa.string()),
            pa.array([x == root for x in folded], pa.bool_()),
            pa.array(copies, pa.list_(pa.string())),
        ],
        ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copies"],
    )
