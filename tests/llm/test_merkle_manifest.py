"""The manifest against a tree built in plain Python, with blocks so small that they exchange roots for many rounds."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from snapstrata.llm import merkle_manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes):
    """Root, and the siblings of each node by level as (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % 3
            paths[k].append((nodes[first:i], nodes[i + 1 : first + 3]))
        nodes, at = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], [i // 3 for i in at]
    return nodes[0] if nodes else None, paths


def plainly(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made, subroots = {}, []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sub, paths = tree([leaf(r) for r in groups[name]])
        made[name] = paths
        subroots.append(sub)
    root, tops = tree(subroots)
    out = Counter()
    for name, sub, top in zip(names, subroots, tops):
        for r, path in zip(groups[name], made[name]):
            whole = path + top
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4]))
            for before, after in whole:
                node = h(*before, node, *after)
            out[(r[0], leaf(r), sub, root, h(*(x for b, a in whole for x in [*b, *a])), node, node == root)] += 1
    return out


def got(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r[n] for n in names) for r in df.select(*names).collect())


def rows(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i * 7 % 1009, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i]), rng.choice([f"line {i}\nmore", f"über {i}", None, "", "a\n\nb"])) for i in range(n)]


@pytest.mark.parametrize("height", [1, 2])
def test_against_a_plain_tree(spark, height):
    data = rows(260, ["hot"] * 6 + ["a", "ä", "Z", "", None])
    df = spark.createDataFrame(data, SCHEMA)
    assert got(merkle_manifest.manifest(df, height=height)) == plainly(data)


@pytest.mark.parametrize("n", [1, 3, 4, 10, 28])
def test_ragged_groups_exchange_with_those_that_are_there(spark, n):
    """One group of n blocks: every block ends with the root and as many siblings as the plain tree gives it."""
    data = [(i, "s", "en", 1, f"t{i}\n") for i in range(3 * n - 1)]
    assert got(merkle_manifest.manifest(spark.createDataFrame(data, SCHEMA), height=1)) == plainly(data)


def test_odd_rows(spark):
    long = "wort " * 100_000
    data = [(None, None, None, None, None), (None, "a", "en", 1, "x\n"), (5, "a", "en", 1, "same\n"), (5, "a", "en", 1, "same\n"), (5, "a", "en", 1, "other"), (6, "a", None, 0, ""), (7, "b", "en", 2, long)]
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in ("grp", "node", "place", "size", "block", "path", "changed", "tie", "part")})
    assert got(merkle_manifest.manifest(df)) == plainly(data)
    assert merkle_manifest.manifest(df.where("false")).count() == 0


def test_a_hot_key_is_cut_into_ranges(spark):
    """Equal rows are spread: no range holds them all, and places are still 0 to n - 1."""
    nodes = spark.range(0, 6000, 1, 4).select(F.lit("g").alias("grp"), F.lit(7).alias("doc_id"), F.lit("n").alias("node"))
    placed = merkle_manifest.ranked(nodes, ["doc_id", "node"])
    assert sorted(r["place"] for r in placed.collect()) == list(range(6000))
    dealt = nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(4, "grp", "tie")
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 3000
