"""Substring dedup: passages of `SPAN` words that an earlier document has are cut, found by FM-indexes.

A window is `SPAN` consecutive words. Which windows may meet is settled by their least hash of `GRAM` words, which
equal windows share: windows of a document that follow each other and share it make a stretch, and stretches of one
such hash go to one shard. Hashes that only one document has are dropped, and equal stretches are kept once, with the
smallest document that has them. So shards hold little of the corpus, however often a passage occurs.

In a shard, the stretches are put in an FM-index (Burrows-Wheeler transform in a wavelet matrix) and streamed through
it: backward search from an end gives matching statistics, the longest part before it that occurs in a smaller
document. Every window within it counts as repeated; where it is shorter than a window, every window that holds it and
the word before it does not. A document larger than the first one with a stretch has all of the stretch's windows
repeated. A hash whose different stretches all belong to one document is not searched: its windows are nowhere else.

A hash with more than `crowd` different stretches (a passage with many surroundings) would make a shard too large; its
stretches are taken apart into windows, each a row of its hash, and grouped by that instead.

Texts are read twice and shuffled for the documents that own stretches and for the final cut; in between, rows are
hashes and places. Intermediate tables are written to the shared folder.

Edge cases: null texts are empty; texts under `SPAN` words lose nothing; null ids neither lose words nor take them
from others; rows that repeat an id are one document with several texts, which take nothing from each other; repeats
inside one document stay; empty tables give no rows; columns of the input other than id and text pass through `cut`.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import set_aside, stored
from snapstrata.llm.fm_index import FmIndex
from snapstrata.llm.rolling import Hashes, Rolling, batches

SPAN, GRAM = 50, 10

def stretches(words: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Least hash, hash of all words, first window and number of windows of each stretch of a document."""
    windows = len(words) - span + 1
    if windows < 1:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    starts = np.arange(len(words) - gram + 1)
    grams = Rolling(words, 0).of(starts, starts + gram)
    least = np.lib.stride_tricks.sliding_window_view(grams, span - gram + 1).argmin(axis=1) + starts[:windows]
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    number = np.diff(np.append(first, windows))
    return grams[least[first]], Rolling(words, 1).of(first, first + number + span - 1), first, number


def _marks(docs: DataFrame, span: int, gram: int) -> DataFrame:
    def rows(batch: dict, hashes: Hashes) -> dict:
        found = [stretches(hashes.of(x.split()), span, gram) for x in batch["text"]]
        lengths = [len(x[0]) for x in found]
        least, whole, first, number = (np.concatenate([x[i] for x in found]) if found else [] for i in range(4))
        repeat = lambda name: np.repeat(np.array(batch[name], np.int64), lengths)
        return {
            "least": least.view(np.int64), "whole": whole.view(np.int64), "doc_id": repeat("doc_id"), "row": repeat("row"),
            "first": first.astype(np.int32), "number": number.astype(np.int16),
        }

    return batches(docs, rows, "least long, whole long, doc_id long, row long, first int, number short")


def settled(fm: FmIndex, coded: list[np.ndarray], owners: np.ndarray, group: np.ndarray, span: int) -> np.ndarray:
    """Bits of the windows of each sequence that one of a smaller owner has. Equal windows lie in sequences of one group.

    A sequence's windows that are not settled follow each other, from `low` to `high`. They are searched by turns from the
    end of the last one, where a long match settles all windows within it, and from the end of the first one, which all
    of them hold: where that match ends too soon, all windows that reach further to the left are settled at once.
    """
    text = np.concatenate(coded)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    begin = np.cumsum(lengths) - lengths
    windows = np.zeros(len(coded), np.int64)
    least = np.full(group.max(initial=-1) + 1, len(coded))
    np.minimum.at(least, group, owners)
    searched = np.flatnonzero(owners > least[group])
    origin = begin[searched]
    low, high = origin.copy(), origin + lengths[searched] - span
    from_first, pays = (np.ones(len(searched), bool) for _ in range(2))  # this turn; whether the next such turn may settle many

    def then(which: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, a, b = from_first[which], low[which], high[which]
        window = np.where(first, a, b)
        hit = left <= window
        bits = (np.int64(2) << (window - origin[which])) - (np.int64(1) << (left - origin[which]))
        windows[searched[which]] |= np.where(hit, bits, 0)
        low[which] = a = np.where(first, np.maximum(left, a + 1), a)
        high[which] = b = np.where(first, b, np.minimum(left, b) - 1)
        half = window + span - left >= span // 2
        pays[which] = np.where(first, ~hit, pays[which] | hit | half)
        from_first[which] = ~first & pays[which]
        return a <= b, np.where(from_first[which], a, b) + span - 1, a

    at = low + span - 1
    fm.search(text, at, low, owners[searched], then)
    return windows


def _searched(segments: DataFrame, span: int, gram: int, shards: int) -> DataFrame:
    """least, whole, number, windows: bits of the windows of each stretch that a smaller document has."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        split = [x.split(" ") for x in frame["words"]]  # as they were joined: other white space of Unicode is part of a word
        index = defaultdict(count(1).__next__)
        coded = [np.fromiter(map(index.__getitem__, ws), np.int64, len(ws)) for ws in split]
        owners = pd.factorize(frame["doc_id"], sort=True)[0]
        windows = settled(FmIndex(coded, owners, 2 * span), coded, owners, pd.factorize(frame["least"])[0], span)
        hit = windows != 0
        return pd.DataFrame({"least": frame["least"][hit], "whole": frame["whole"][hit], "number": frame["number"][hit], "windows": windows[hit]})

    shard = F.pmod(F.xxhash64("least"), F.lit(shards))
    return segments.groupBy(shard.alias("shard")).applyInPandas(run, "least long, whole long, number short, windows long")


def repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, crowd: int = 2000, shard_words: int = 400_000) -> DataFrame:
    """doc_id, row (hash of the text), places: for documents with repeated windows, first window of a stretch and the
    bits of its repeated ones. `docs` has doc_id and text, and `row`."""
    c = F.col
    key = ["least", "whole", "number"]
    marks = stored(_marks(docs.where("doc_id is not null"), span, gram), "marks")
    # Stored, so that the join below reads two plain shuffles, of which a hot partition can be split.
    shared = stored(marks.groupBy("least").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("least"), "repeated")
    marks = stored(marks.join(shared, "least"), "shared")
    contents = stored(
        marks.groupBy(*key).agg(F.min(F.struct("doc_id", "row", "first")).alias("at")).select(*key, "at.*"), "contents"
    )
    # A hash whose different stretches all belong to one document has nothing to search. Stored, for the same reason.
    sought = stored(
        contents.groupBy("least").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a < b")
        .select("least", (c("n") > crowd).alias("crowded")),
        "sought",
    )
    owners = (
        contents.join(sought, "least")
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct(*key, "first", "crowded")).alias("pieces"))
    )

    def rows(batch: dict, hashes: Hashes) -> dict:
        made: dict[str, list] = {x: [] for x in (*key, "doc_id", "words", "window", "place")}
        for doc, text, pieces in zip(batch["doc_id"], batch["text"], batch["pieces"]):
            words = text.split()
            rolling = Rolling(hashes.of(words), 1) if any(p["crowded"] for p in pieces) else None
            for p in pieces:
                n, first = p["number"], p["first"]
                starts = np.arange(first, first + n)
                one = [None] if not p["crowded"] else rolling.of(starts, starts + span).view(np.int64).tolist()
                for place, window in enumerate(one):
                    for x in key:
                        made[x].append(p[x])
                    made["doc_id"].append(doc)
                    made["words"].append(None if p["crowded"] else b" ".join(words[first : first + n + span - 1]).decode("utf-8", "replace"))
                    made["window"].append(window)
                    made["place"].append(place)
        kinds = {"number": pa.int16(), "words": pa.string(), "place": pa.int32()}
        return {x: pa.array(v, kinds.get(x, pa.int64())) for x, v in made.items()}

    cut = stored(
        batches(
            docs.join(owners, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"]).select("doc_id", "text", "pieces"), rows,
            "least long, whole long, number short, doc_id long, words string, window long, place int",
        ),
        "pieces",
    )
    segments = cut.where("words is not null")
    total = segments.agg(F.sum(c("number") + (span - 1))).first()[0] or 0
    searched = _searched(segments.select(*key, "doc_id", "words"), span, gram, int(total // shard_words) + 1)

    apart = cut.where("window is not null")
    firsts = apart.groupBy("window").agg(F.min("doc_id").alias("first_doc"))
    crowded = (
        apart.join(firsts, "window").where("first_doc < doc_id")
        .groupBy(*key).agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("windows"))
    )
    found = stored(searched.unionByName(crowded), "found")

    # Stored for the same reason: the marks of one stretch may be a third of all, and are split in the join below.
    verdicts = stored(contents.select(*key, c("doc_id").alias("first_doc")).join(found, key, "left"), "verdicts")
    everything = F.expr("shiftleft(1L, cast(number as int)) - 1")
    return (
        marks.join(verdicts, key)
        .withColumn("bits", F.when(c("doc_id") > c("first_doc"), everything).otherwise(c("windows")))
        .where("bits is not null and bits <> 0")
        .groupBy("doc_id", "row").agg(F.collect_set(F.struct("first", "bits")).alias("places"))
    )


def removed(n: int, places: list[dict] | None, span: int = SPAN) -> np.ndarray:
    """Which of n words lie in a repeated window."""
    change = np.zeros(n + 1, np.int64)
    for p in places or ():
        bits, at = p["bits"], p["first"]
        while bits:
            low = (bits & -bits).bit_length() - 1
            run = (~(bits >> low) & -~(bits >> low)).bit_length() - 1  # ones in a row
            change[at + low] += 1
            change[at + low + run + span - 1] -= 1
            bits &= ~(((1 << run) - 1) << low)
    return np.cumsum(change[:-1]) > 0


def _with_places(docs: DataFrame) -> DataFrame:
    keyed = docs.withColumn("row", F.xxhash64("text"))
    return keyed.join(repeats(keyed.select("doc_id", "text", "row")), ["doc_id", "row"], "left")


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of the kept words joined by one space."""

    def rows(batch: dict, _) -> dict:
        made: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": []}
        for text, places in zip(batch["text"], batch["places"]):
            words = text.split()
            gone = removed(len(words), places)
            kept = [w for w, g in zip(words, gone) if not g] if places else words
            made["n_words"].append(len(words))
            made["n_removed"].append(len(words) - len(kept))
            made["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return {x: pa.array(v, pa.string() if x == "kept_sha256" else pa.int64()) for x, v in made.items()} | {"doc_id": pa.array(batch["doc_id"], pa.int64())}

    placed = _with_places(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return batches(placed.select("doc_id", "text", "places"), rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def kept_text(text: bytes, places: list[dict] | None) -> bytes:
    """The text without its repeated words; what is kept keeps its white space."""
    if not places:
        return text
    starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    gone = removed(len(starts), places)
    ends = [*starts[1:], len(text)]
    return text[: starts[0]] + b"".join(text[a:b] for a, b, g in zip(starts, ends, gone) if not g)


def cut(docs: DataFrame) -> DataFrame:
    """The documents with repeated words cut from their texts, all columns in place; null texts come out empty."""
    frame, back = set_aside(docs, "doc_id", "text")
    names = frame.columns
    schema = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in frame.schema)
    placed = _with_places(frame.withColumn("text", F.coalesce("text", F.lit("")))).select(*names, "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            made = [kept_text(t, p).decode("utf-8", "replace") for t, p in zip(texts, batch.column("places").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()) if x == "text" else batch.column(x) for x in names], names)

    return back(placed.mapInArrow(run, schema))
