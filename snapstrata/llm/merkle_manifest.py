"""Merkle dataset manifest with a butterfly exchange.

Nodes of a group stand in order, and every three consecutive ones become their hash, level by level, until one is
left. Blocks of 3 ** HEIGHT consecutive leaves are whole subtrees, so each is hashed by itself. Then the blocks of
a group exchange roots: in round r, those whose numbers differ in ternary digit r swap the roots of the subtrees of
3 ** r blocks that they stand for, and each hashes the parent for itself. After the last round every block has all
siblings above it; nothing is sent down the tree again. In a last subtree that lacks blocks, the blocks that are
there answer for the missing ones by turns. The roots of the groups are the leaves of one more tree of the same kind.

What moves: a row of about a hundred bytes for each document once by ranges of (source, doc_id) and twice by block;
in each of the log3(blocks) rounds at most three rows a block. Texts don't move. A source may hold any share of
the rows: ranges and blocks cut it. Each step is stored in the shared folder.

Edge cases: nulls are written `-`; empty texts are `0:`; leaves with the same doc_id stand in order of their hashes
(null ids first), equal rows in any order, as that changes nothing but which of them comes first; an id that is null
is not tampered with; an empty table has no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.llm.common import stored

FANOUT, HEIGHT = 3, 7

#: Siblings of a node, level by level: what is hashed before and after it.
PATH = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """Length in bytes and the value itself, so that no two rows read alike."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column) -> Column:
    fields = [field(F.col(x)) for x in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*fields, field(text)), 256)


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` (stored; column `grp`, not null) with `place` in its group by `order`, and the group's size `size`.

    Rows are dealt by ranges, each range counts its rows of each group, and offsets come from these counts. Equal rows
    are spread by a number of their own.
    """
    c = F.col
    keys = ["grp", *order]
    dealt = nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "tie").sortWithinPartitions(*keys).drop("tie")
    sorted_ = stored(dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ranges")
    counts = sorted_.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # A row for each range and group in it: ranges follow each other, so there are at most ranges + groups of them.
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        counts.select(
            "grp", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - c("first")).alias("shift"),
            F.sum("n").over(Window.partitionBy("grp")).alias("size"),
        ),
        "offsets",
    )
    return sorted_.join(offsets, ["grp", "part"]).withColumn("place", c("at") + c("shift")).drop("part", "at", "shift")


def _levels(nodes: list[str], alone: bool, fanout: int, height: int) -> list[list[str]]:
    """The levels of a block's subtree: all `height` of them, or up to one node where the block is alone in its group."""
    levels = [nodes]
    while len(levels[-1]) > 1 or (not alone and len(levels) <= height):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def _paths(levels: list[list[str]], fanout: int) -> list[list[tuple[str, str]]]:
    """For each node of the lowest level its siblings: (before, after) by level."""
    paths: list[list[tuple[str, str]]] = []
    for i in range(len(levels[0])):
        path, at = [], i
        for level in levels[:-1]:
            first = at - at % fanout
            path.append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
            at //= fanout
        paths.append(path)
    return paths


def fold(node: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        node = digest(before + node + after)
    return node


def _in_blocks(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    width = F.lit(fanout**height)
    return placed.withColumns({"block": F.floor(F.col("place") / width), "blocks": F.ceil(F.col("size") / width)})


def block_roots(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    """grp, block, blocks, node: the root of each block's subtree."""

    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        alone = table["blocks"][0].as_py() == 1
        top = _levels(table["node"].to_pylist(), alone, fanout, height)[-1]
        return table.slice(0, 1).select(["grp", "block", "blocks"]).append_column("node", pa.array(top))

    rows = _in_blocks(placed.select("grp", "size", "place", "node"), fanout, height)
    return rows.groupBy("grp", "block").applyInArrow(root, "grp string, block long, blocks long, node string")


def exchanged(blocks: DataFrame, fanout: int) -> DataFrame:
    """grp, block, node (the group's root), path (siblings of the block's root up to it)."""
    c = F.col
    state = stored(blocks.withColumn("path", F.expr(f"cast(array() as {PATH})")), "blocks")
    most, reach = state.agg(F.max("blocks")).first()[0] or 0, 1
    while reach < most:
        # Blocks are dealt into subtrees of `reach`; what is one subtree already has its root.
        mine = F.floor(c("block") / reach)
        first = mine - mine % fanout
        active = c("blocks") > reach
        siblings = F.filter(F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda d: first + d), lambda s: s * reach < c("blocks"))
        # How many blocks stand in this block's subtree and in another one; the last can lack some.
        held = F.least(F.lit(reach), c("blocks") - mine * reach)
        turn = c("block") - mine * reach

        def served(s: Column) -> Column:
            there = F.least(F.lit(reach), c("blocks") - s * reach)
            own = F.when(s == mine, F.array(turn)).otherwise(
                F.when(turn < there, F.sequence(turn, there - 1, held)).otherwise(F.expr("cast(array() as array<bigint>)"))
            )
            return F.transform(own, lambda x: s * reach + x)

        to = F.when(active, F.flatten(F.transform(siblings, served))).otherwise(F.array("block"))
        sent = state.select("grp", F.explode(to).alias("to"), "blocks", F.struct(mine.alias("subtree"), "node").alias("got"), F.when(c("block") == c("to"), c("path")).alias("path"))
        met = sent.groupBy("grp", c("to").alias("block")).agg(
            F.first("blocks").alias("blocks"), F.array_sort(F.collect_list("got")).alias("got"), F.first("path", ignorenulls=True).alias("path")
        )
        side = lambda test: F.array_join(F.transform(F.filter("got", test), lambda g: g["node"]), "")
        step = F.array(F.struct(side(lambda g: g["subtree"] < mine).alias("before"), side(lambda g: g["subtree"] > mine).alias("after")))
        state = stored(
            met.select(
                "grp", "block", "blocks",
                F.when(active, F.sha2(side(lambda g: F.lit(True)), 256)).otherwise(c("got")[0]["node"]).alias("node"),
                F.when(active, F.concat("path", step)).otherwise(c("path")).alias("path"),
            ),
            "exchange",
        )
        reach *= fanout
    return state.select("grp", "block", "node", "path")


Opened = Callable[[pa.Table, list[list[tuple[str, str]]], str], pa.Table]


def opened(placed: DataFrame, upper: DataFrame, rows: Opened, schema: str, fanout: int, height: int) -> DataFrame:
    """`rows(leaves of a block in order, their paths up to the root, root)` for each block; `upper` has grp, block, node, path."""

    def run(leaves: pa.Table, above: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("place")
        alone = leaves["blocks"][0].as_py() == 1
        higher = [(p["before"], p["after"]) for p in above["path"][0].as_py()]
        paths = _paths(_levels(leaves["node"].to_pylist(), alone, fanout, height), fanout)
        return rows(leaves, [p + higher for p in paths], above["node"][0].as_py())

    blocks = _in_blocks(placed, fanout, height).groupBy("grp", "block")
    return blocks.cogroup(upper.groupBy("grp", "block")).applyInArrow(run, schema)


def manifest(docs: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: a row for each document.

    Where 2 divides the CRC of the id, what is folded is the leaf of the text without line feeds.
    """
    c = F.col
    id_type = docs.schema["doc_id"].dataType.simpleString()
    tampered = (F.crc32(c("doc_id").cast("string").cast("binary")) % 2 == 0) & (F.instr("text", "\n") > 0)
    leaves = stored(
        docs.select(
            # Null sources come first, the others in order of their bytes.
            F.when(c("source").isNull(), "0").otherwise(F.concat(F.lit("1"), c("source").cast("string"))).alias("grp"),
            "doc_id", leaf(c("text")).alias("node"),
            F.when(tampered, leaf(F.translate("text", "\n", ""))).alias("changed"),
        ),
        "leaves",
    )
    placed = stored(ranked(leaves, ["doc_id", "node"]), "placed")
    subtrees = stored(exchanged(block_roots(placed, fanout, height), fanout), "subtrees")

    # The groups' roots are leaves of one more tree: its only group has no name.
    roots = stored(subtrees.where("block = 0").select(F.lit("").alias("grp"), c("grp").alias("source"), "node"), "subroots")
    sources = stored(ranked(roots, ["source"]), "sources")

    def of_source(rows: pa.Table, paths: list, root: str) -> pa.Table:
        path = pa.array([[{"before": b, "after": a} for b, a in p] for p in paths], pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))
        return pa.table({"grp": rows["source"], "subroot": rows["node"], "root": pa.array([root] * len(rows)), "rest": path})

    tops = opened(sources, exchanged(block_roots(sources, fanout, height), fanout), of_source, f"grp string, subroot string, root string, rest {PATH}", fanout, height)
    upper = subtrees.join(stored(tops, "tops"), "grp").select("grp", "block", F.concat("path", "rest").alias("path"), F.struct("subroot", "root").alias("node"))

    def of_document(rows: pa.Table, paths: list, top: dict) -> pa.Table:
        nodes = rows["node"].to_pylist()
        proofs = [digest("".join([x for pair in p for x in pair])) for p in paths]
        folded = [fold(changed or node, p) for node, changed, p in zip(nodes, rows["changed"].to_pylist(), paths)]
        same = lambda x: pa.array([x] * len(nodes), pa.string())
        return pa.table(
            {
                "doc_id": rows["doc_id"], "leaf": rows["node"], "subroot": same(top["subroot"]), "root": same(top["root"]),
                "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded), "verified": pa.array([f == top["root"] for f in folded]),
            }
        )

    schema = f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return opened(placed, upper, of_document, schema, fanout, height)
