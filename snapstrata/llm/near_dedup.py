"""MinHash near-dedup by Order MinHash, with candidates verified by banded alignment.

A document is the sequence of its shingles of five words; equal shingles are told apart by how many came before.
Each of `2 * BANDS` random orders picks the two least of these, and keeps them in the order of the text. So two
documents agree in a sample when they share the picked shingles and have them in the same order, which happens about
as often as their edits leave pairs of shingles alone. Two samples make a band; documents that agree in a band
are candidates.

Candidates are verified by alignment: the longest common subsequence of their shingles, within the band of
diagonals that a similarity of 0.8 can reach, as bit-parallel steps. The similarity is shared shingles by all of
both, shared ones counted once; of texts without repeats or moved passages it is the Jaccard index.

Equal texts are one node, so copies cost one row each. In a bucket of up to `SMALL` nodes all are compared. In a
larger one each is first compared with the most central node, whose bands most others have. Where that leaves more than
one class, every pair of different classes is compared: nodes outside the bucket's largest class meet all nodes of the
bucket in cells of two blocks, which hold at most about `BLOCK` of each. A cell verifies its pairs itself and returns
one link for two classes, so links don't grow by the pairs. Comparisons do in a bucket of many classes, and so, by one
for every `BLOCK` of its nodes, do the copies of a node with its text. Pairs that share several bands are compared in the first of these; those whose sets of shingles are too
different to be alike are told by a count. So no candidate is dropped for the size of its bucket: what is missed is
missed by all bands, a pair at similarity 0.8 about once in 4,600 ((1 - 0.8^4)^16). Classes are the connected
components of the links found.

Words are split at white space, with A-Z in lower case. Edge cases: null texts are empty; texts without words
are alike when they are equal; texts of under five words have one shingle, all of them; rows that repeat an id
with other texts are documents of their own; null ids get no class; empty tables give no rows; further columns
are ignored by `classes` and passed on by `kept`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import mixed, set_aside, stored
from snapstrata.llm.components import components
from snapstrata.llm.rolling import Hashes, Rolling, batches

SIZE, SIMILARITY = 5, 0.8
BANDS, SMALL, BLOCK = 16, 8, 512
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEEDS = mixed(np.arange(1, 2 * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: bytes, hashes: Hashes) -> np.ndarray:
    words = hashes.of(text.translate(LOWER).split())
    if not len(words):
        return words
    starts = np.arange(max(1, len(words) - SIZE + 1))
    return Rolling(words, 0).of(starts, np.minimum(starts + SIZE, len(words)))


def labelled(sequence: np.ndarray) -> np.ndarray:
    """Shingles with the number of equal ones before, as one hash."""
    order = np.argsort(sequence, kind="stable")
    run = sequence[order]
    fresh = np.concatenate([[True], run[1:] != run[:-1]])
    if fresh.all():
        return mixed(sequence)
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))
    before = np.empty(len(run), np.uint64)
    before[order] = (np.arange(len(run)) - begin).astype(np.uint64)
    return mixed(sequence + before * np.uint64(0xD1342543DE82EF95))


def bands(sequence: np.ndarray) -> np.ndarray:
    """Order MinHash: for each order the two least labelled shingles as they stand in the text; two orders to a band."""
    marks = labelled(sequence)
    picked = []
    step = max(1, (1 << 20) // len(marks))  # bounds the table of orders for very long texts
    for at in range(0, len(_SEEDS), step):
        order = marks[None, :] * _SEEDS[at : at + step, None]
        rows = np.arange(len(order))
        one = order.argmin(axis=1)
        order[rows, one] = np.uint64(0xFFFFFFFFFFFFFFFF)
        two = order.argmin(axis=1)
        left, right = np.minimum(one, two), np.maximum(one, two)
        picked.append(mixed(marks[left] * np.uint64(0x9FB21C651E98DF25) + marks[right]))
    samples = np.concatenate(picked)
    return mixed(samples[0::2] * np.uint64(0xA0761D6478BD642F) + samples[1::2] + np.arange(BANDS, dtype=np.uint64))


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two shingle sequences by banded alignment, 0 when it is known to be under `least`."""
    if len(a) > len(b):
        a, b = b, a
    total = len(a) + len(b)
    need = int(np.ceil(total * least / (1 + least) - 1e-9))
    if len(a) < need or not len(a):
        return 0.0
    short = len(a)
    differ = np.flatnonzero(a != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    differ = np.flatnonzero(a[::-1] != b[::-1][: len(a)])
    tail = int(differ[0]) if len(differ) else len(a)
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(a):
        return max(0.0, (same := head + tail + _common(a, b, need - head - tail)) / (total - same)) if need - head - tail <= len(a) else 0.0
    return (head + tail) / (total - head - tail)


def _common(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Length of the longest common subsequence of a and b, exact if it is at least `need`.

    Places of `a` are bits of a number that holds only the diagonals within reach; each element of `b` is one step of
    the bit-parallel recurrence, and a cleared bit is one more common element.
    """
    reach = len(a) + len(b) - 2 * max(need, 0)
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a.tolist()):
        places.setdefault(x, []).append(i)
    whole: dict[int, int] = {}
    for x, at in places.items():
        if len(at) > 16:
            whole[x] = sum(1 << i for i in at) if len(at) < 64 else int.from_bytes(np.packbits(a == np.uint64(x), bitorder="little").tobytes(), "little")
    width = 2 * reach + 1
    mask = (1 << width) - 1
    state, left = mask, 0  # bit k is place j - reach + k of a; those that leave the band are counted in `left`
    first = -reach
    for j, x in enumerate(b.tolist()):
        if j:
            left += not state & 1
            state = state >> 1 | 1 << (width - 1)
            first += 1
        at = places.get(x)
        if at is None:
            continue
        if len(at) > 16:
            match = (whole[x] >> first if first >= 0 else whole[x] << -first) & mask
        else:
            match = 0
            for i in at:
                if 0 <= i - first < width:
                    match |= 1 << (i - first)
        if match:
            match &= state
            state = (state + match | state & ~match) & mask
    return left + width - state.bit_count()


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, row, one, two (hash of the words, or of a text without any), bands (none without words)."""

    def rows(batch: dict, hashes: Hashes) -> dict:
        made: dict[str, list] = {x: [] for x in ("one", "two", "bands")}
        for text in batch["text"]:
            words = b" ".join(text.translate(LOWER).split())
            whole = xxhash.xxh3_128_intdigest(words or b"\n" + text)
            made["one"].append((whole >> 64) - (1 << 63))
            made["two"].append((whole & (1 << 64) - 1) - (1 << 63))
            made["bands"].append(bands(shingles(text, hashes)).view(np.int64) if words else [])
        kinds = {"bands": pa.list_(pa.int64())}
        return {x: pa.array(v, kinds.get(x, pa.int64())) for x, v in made.items()} | {x: pa.array(batch[x], pa.int64()) for x in ("doc_id", "row")}

    return batches(docs, rows, "doc_id long, row long, one long, two long, bands array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are alike."""
    c = F.col
    both = pairs.join(texts.select(c("node").alias("a"), c("text").alias("text_a")), "a").join(
        texts.select(c("node").alias("b"), c("text").alias("text_b")), "b"
    )

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches_:
            last: dict[int, np.ndarray] = {}
            found: tuple[list, list] = ([], [])
            column = lambda x: batch.column(x).cast(pa.binary())
            for a, b, text_a, text_b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), column("text_a"), column("text_b")):
                if len(last) > 64:
                    last.clear()
                for node, text in ((a, text_a), (b, text_b)):
                    if node not in last:
                        last[node] = shingles(text.as_py(), hashes)
                if aligned(last[a], last[b]) >= SIMILARITY:
                    found[0].append(a)
                    found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _buckets(members: DataFrame) -> DataFrame:
    """Members (key, band, node, class, weight) of buckets with more than one class, with size and the most central node.

    The only join of a round by bucket: the other side has a row for each bucket.
    """
    c = F.col
    sums = members.groupBy("key").agg(
        F.count("*").alias("size"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.max(F.struct("weight", "node", "class")).alias("centre"),
    )
    sums = sums.where("low < high").select("key", "size", c("centre.node").alias("hub"), c("centre.class").alias("hub_class"))
    return stored(members.join(sums, "key"), "buckets")


def _candidates(buckets: DataFrame, small: int) -> DataFrame:
    """Pairs (a < b) of different classes: all in small buckets, each node with the most central one in large ones."""
    c = F.col
    few = buckets.where(c("size") <= small).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("node", "class"))).alias("nodes"))
    pairs = few.select(F.explode("nodes").alias("x"), "nodes").select(
        c("x.node").alias("a"), F.explode(F.filter("nodes", lambda y: (y["node"] > c("x.node")) & (y["class"] != c("x.class")))).alias("y")
    ).select("a", c("y.node").alias("b"))
    spokes = buckets.where((c("size") > small) & (c("class") != c("hub_class")))
    return pairs.union(spokes.select(F.least("node", "hub"), F.greatest("node", "hub"))).distinct()


def _rest(buckets: DataFrame, labels: DataFrame, contents: DataFrame, texts: DataFrame, block: int) -> DataFrame:
    """Links (a, b) in large buckets that hold more than one class: all that join classes, one or more for each two of them.

    Nodes outside the bucket's largest class ("probes") meet every node of it. Both are dealt into blocks, and a cell has
    one block of each: rows are nodes by the blocks they meet, never pairs.
    """
    c = F.col
    members = buckets.select("key", "band", "node").join(labels, "node", "left").select("key", "band", "node", F.coalesce("label", "node").alias("class"))
    counts = members.groupBy("key", "class").agg(F.count("*").alias("n"))
    sums = counts.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "class")).alias("top")).where(c("top.n") < c("size"))
    blocks = lambda n: F.ceil(n / F.lit(block)).cast("int")
    sums = stored(sums.select("key", c("top.class").alias("main"), blocks(c("size")).alias("rows"), blocks(c("size") - c("top.n")).alias("columns")), "rest")
    members = stored(members.join(sums, "key").join(contents.select("node", "bands"), "node"), "unlike")
    dealt = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    given = ["key", "band", "node", "class", "bands", (c("class") != c("main")).alias("odd")]
    cells = members.select(*given, F.lit(False).alias("probe"), dealt(c("rows")).alias("i"), every(c("columns")).alias("j")).union(
        members.where(c("class") != c("main")).select(*given, F.lit(True), every(c("rows")), dealt(c("columns")))
    )
    cells = cells.join(texts, "node")

    def run(table: pa.Table) -> pa.Table:
        return pa.table([pa.array(x, pa.int64()) for x in _cell(table, Hashes())], ["a", "b"])

    return cells.groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def _cell(table: pa.Table, hashes: Hashes) -> tuple[list, list]:
    """Alike pairs of a probe and another node, of those that join two classes; the pair's first common band is the cell's."""
    node, label, odd, probe = (table.column(x).to_numpy() for x in ("node", "class", "odd", "probe"))
    band = table.column("band")[0].as_py()
    bands_ = np.array(table.column("bands").to_pylist(), np.int64)
    here, at = np.unique(node, return_inverse=True)  # a node may be here as a probe and as another
    first = np.full(len(here), -1)
    first[at[::-1]] = np.arange(len(node))[::-1]
    texts = table.column("text").cast(pa.binary())
    runs = [shingles(texts[int(k)].as_py(), hashes) for k in first]
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    codes = np.unique(np.concatenate([labelled(x) for x in runs]), return_inverse=True)[1]
    begin = np.cumsum(lengths) - lengths
    root = {int(x): int(x) for x in np.unique(label)}

    def top(x: int) -> int:
        while root[x] != x:
            x = root[x] = root[root[x]]
        return x

    found: tuple[list, list] = ([], [])
    marked = np.zeros(int(codes.max(initial=0)) + 1, bool)
    others = np.flatnonzero(~probe)
    for p in np.flatnonzero(probe):
        mine = at[p]
        n, m = lengths[mine], lengths[at[others]]
        fit = (label[others] != label[p]) & (np.minimum(n, m) >= np.maximum(n, m) * SIMILARITY - 1e-9)
        fit &= ~odd[others] | (node[others] > node[p])  # two probes meet in both orders
        meet = others[fit]
        if len(meet):
            meet = meet[(bands_[meet] == bands_[p]).argmax(axis=1) == band]
        if not len(meet):
            continue
        marked[codes[begin[mine] : begin[mine] + n]] = True
        for o in meet:
            a, b = top(int(label[p])), top(int(label[o]))
            if a == b:
                continue
            k = at[o]
            same = int(np.count_nonzero(marked[codes[begin[k] : begin[k] + lengths[k]]]))
            # Not more than the shared shingles can be in the same order.
            if same >= SIMILARITY * (n + lengths[k] - same) - 1e-9 and aligned(runs[mine], runs[k]) >= SIMILARITY:
                root[a] = b
                found[0].append(int(node[p]))
                found[1].append(int(node[o]))
        marked[codes[begin[mine] : begin[mine] + n]] = False
    return found


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of nodes after new links: components of the links between labels, carried over to their nodes."""
    c = F.col
    ends = links
    for x in ("a", "b"):
        ends = ends.join(labels.toDF(x, f"label_{x}"), x, "left").withColumn(x, F.coalesce(f"label_{x}", x)).drop(f"label_{x}")
    roots = stored(components(ends.select("a", "b")), "roots")
    moved = labels.join(roots.toDF("label", "root"), "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return stored(moved.union(roots.join(labels.select("node"), "node", "left_anti").select("node", "label")), "labels")


def classes(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, row (hash of the text), class_id (the smallest id of its class), copy_of (the smallest id with equal words).

    `block` bounds the nodes of either side that a task compares at once."""
    c = F.col
    keyed = docs.select(c("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null")
    keyed = keyed.withColumn("row", F.xxhash64("text"))
    signed = stored(_signed(keyed), "signatures")
    contents = signed.groupBy("one", "two").agg(F.min(F.struct("doc_id", "row", "bands")).alias("at"))
    contents = stored(contents.select("one", "two", "at.doc_id", "at.row", "at.bands", F.xxhash64("one", "two").alias("node")), "contents")

    keys = contents.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(keys.join(sizes, "key"), "shared")
    # How many others share a node's bands: the text that near copies were made from has more than each of them.
    weights = stored(shared.groupBy("node").agg(F.sum("size").alias("weight")), "weights")
    chosen = contents.join(weights, "node").select("doc_id", "row", "node")
    texts = stored(keyed.join(chosen, ["doc_id", "row"]).groupBy("node").agg(F.min("text").alias("text")), "texts")

    members = shared.join(weights, "node").select("key", "band", "node", c("node").alias("class"), "weight")
    labels = contents.where("false").select("node", c("node").alias("label"))
    buckets = _buckets(members)
    found = stored(_verified(stored(_candidates(buckets, SMALL), "pairs"), texts), "found")
    if not found.isEmpty():
        labels = _joined(labels, found)
    large = buckets.where(c("size") > SMALL)
    if not large.isEmpty():
        found = stored(_rest(large, labels, contents, texts, block), "found")
        if not found.isEmpty():
            labels = _joined(labels, found)

    named = contents.join(labels, "node", "left").withColumn("class", F.coalesce("label", "node"))
    ids = named.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    named = named.join(ids, "class").select("one", "two", "class_id", c("doc_id").alias("copy_of"))
    return signed.join(named, ["one", "two"]).select("doc_id", "row", "class_id", "copy_of")


def kept(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each class: the one of smallest id. Rows equal in id and text count once; null ids stay."""
    frame, back = set_aside(docs, "doc_id", "text")
    keyed = frame.withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))))
    first = classes(docs).groupBy("class_id").agg(F.min(F.struct("doc_id", "row")).alias("at")).select("at.doc_id", "at.row")
    chosen = keyed.join(first, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"])
    return back(chosen).unionByName(docs.where("doc_id is null"))
