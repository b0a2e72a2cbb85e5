"""Cross-tokenizer alignment with an associative fragment monoid.

Byte offsets where tokens of both vocabularies end cut a text into groups, and the two tokens that end there are
linked. A byte range of a text gives a fragment: an open head (tokens up to its first common end), closed groups,
and an open tail (tokens after its last one), or tokens only where it has no common end. Fragments are put together
in any bracketing: the tail before and the head after are one group. So a very long text is dealt to tasks by
ranges of `chunk` bytes, whose edges lie anywhere, also inside tokens, and its fragments are reduced as a tree, `fan`
neighbours at a time; a text of one range is its own fragment.

A range's tokens are those that end in it. They come from encoding it from the last safe cut before it to the first
one after it: both vocabularies always cut before a single space between characters that are not white space. A
stretch without safe cuts that is longer than a range is left to the range it starts in.

Two tokens that are linked end together, so one is a suffix of the other, and a suffix has but one length: the possible
pairs are numbered beforehand, about 600,000 for the two public vocabularies (`Pairs.size`), whatever the corpus. That
bounds what is broadcast: a count for each number. Each text is encoded once; its links are stored as such numbers,
counted, and met with the counts. What moves: the counts, and the ranges and fragments of texts of several ranges.

Edge cases: texts that are null, empty, or that a vocabulary does not give back byte for byte have no tokens: zeros and
an empty string; repeated rows count each; ids may be null or repeated; empty tables give no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.bpe_lexicon import merger, token_bytes
from snapstrata.llm.common import stored, texts

CHUNK, FAN = 1 << 15, 4

#: A space between characters that are not white space, in UTF-8. Both vocabularies cut before it.
_WIDE = (rb"\xc2[\x85\xa0]", rb"\xe1\x9a\x80", rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]", rb"\xe2\x81\x9f", rb"\xe3\x80\x80")
SAFE = re.compile(
    rb"(?<![\t-\r\x1c-\x20])" + b"".join(b"(?<!" + w + b")" for w in _WIDE) + rb" (?![\t-\r\x1c-\x20]|" + b"|".join(_WIDE) + rb"|\Z)"
)


class Bytes:
    """Byte-level vocabulary of the tokenizers library, by the ranks of its tokens; special ones are plain text."""

    def __init__(self, path: str):
        self.tokens, self.encoding = token_bytes(path), merger(path)

    def encode(self, items: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(x) for x in items]


class Pieces:
    """Sentencepiece vocabulary with byte fallback; `encode` adds the space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.fallback = np.array([m.is_byte(i) for i in range(len(names))])
        self.tokens = [bytes([int(x[3:5], 16)]) if b else x.replace("▁", " ").encode() for x, b in zip(names, self.fallback)]
        if any(re.search("[^▁]▁", x) for x in names):
            raise ValueError("a piece of this vocabulary reaches over a space, so texts cannot be cut there")

    def encode(self, items: list[str]) -> list[list[int]]:
        return self.model.encode(items, num_threads=1)


class Pairs:
    """A number for each pair of tokens of which one is a suffix of the other.

    Those with a first token at least as long: the first token and the second one's length (0 for a fallback byte).
    The others: the second token and the first one's length.
    """

    def __init__(self, a: Bytes, b: Pieces):
        for tokens in (a.tokens, [t for t, f in zip(b.tokens, b.fallback) if not f]):
            if len(set(tokens)) < len(tokens):
                raise ValueError("tokens of the same bytes cannot be told apart by their length")
        self.a, self.b = (np.fromiter(map(len, x.tokens), np.int64) for x in (a, b))
        slot = np.where(b.fallback, 0, self.b)
        self.slot = slot
        self.first = np.concatenate([[0], np.cumsum(self.a + 1)])
        self.second = self.first[-1] + np.concatenate([[0], np.cumsum(self.b)])
        self.size = int(self.second[-1])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(self.b[b] <= self.a[a], self.first[a] + self.slot[b], self.second[b] + self.a[a]).astype(np.int32)


class Fragment(NamedTuple):
    """What a byte range holds. `closed` is None where it has no common end: then all tokens are in the head."""

    head_a: np.ndarray
    head_b: np.ndarray
    closed: str | None
    tail_a: np.ndarray
    tail_b: np.ndarray
    links: np.ndarray
    n_a: int
    n_b: int
    whole: bool

    def __add__(self, other: Fragment) -> Fragment:
        links = np.concatenate([self.links, other.links])
        n_a, n_b, whole = self.n_a + other.n_a, self.n_b + other.n_b, self.whole and other.whole
        join = np.concatenate
        if self.closed is None:
            head = (join([self.head_a, other.head_a]), join([self.head_b, other.head_b]))
            return Fragment(*head, other.closed, other.tail_a, other.tail_b, links, n_a, n_b, whole)
        across = (join([self.tail_a, other.head_a]), join([self.tail_b, other.head_b]))
        if other.closed is None:
            return Fragment(self.head_a, self.head_b, self.closed, *across, links, n_a, n_b, whole)
        closed = f"{self.closed}{printed(*across)};{other.closed}"
        return Fragment(self.head_a, self.head_b, closed, other.tail_a, other.tail_b, links, n_a, n_b, whole)


def printed(a: np.ndarray, b: np.ndarray) -> str:
    return f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}"


_NONE = np.zeros(0, np.int32)
EMPTY = Fragment(_NONE, _NONE, None, _NONE, _NONE, _NONE, 0, 0, True)
ODD = EMPTY._replace(whole=False)


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Bytes(path_a), Pieces(path_b)
        self.pairs = Pairs(self.a, self.b)
        # A token's number with what follows it: more of its side, the other side, the next group.
        self.width = max(len(self.a.tokens), len(self.b.tokens))
        self.signs = [f"{i}{x}" for x in (",", "|", ";") for i in range(self.width)]

    def fragment(self, ids_a: list[int], ids_b: list[int], text: bytes, low: int, high: int) -> Fragment:
        """Of the tokens of `text` those that end after byte `low` and not after `high`."""
        give = lambda tokens, ids: b"".join(map(tokens.__getitem__, ids))
        if give(self.a.tokens, ids_a) != text or give(self.b.tokens, ids_b) != text:
            return ODD
        a, b = np.array(ids_a, np.int32), np.array(ids_b, np.int32)
        ends_a, ends_b = np.cumsum(self.pairs.a[a]), np.cumsum(self.pairs.b[b])
        if low > 0 or high < len(text):
            in_a, in_b = ((e > low) & (e <= high) for e in (ends_a, ends_b))
            a, ends_a, b, ends_b = a[in_a], ends_a[in_a], b[in_b], ends_b[in_b]
        # No token is empty, so ends are distinct on either side.
        _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        links = self.pairs.of(a[at_a], b[at_b])
        if not len(links):
            return Fragment(a, b, None, _NONE, _NONE, links, len(a), len(b), True)
        head, last = (at_a[0] + 1, at_b[0] + 1), (at_a[-1] + 1, at_b[-1] + 1)
        closed = self.closed(a[head[0] : last[0]], b[head[1] : last[1]], at_a[1:] - head[0], at_b[1:] - head[1])
        return Fragment(a[: head[0]], b[: head[1]], closed, a[last[0] :], b[last[1] :], links, len(a), len(b), True)

    def closed(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> str:
        """Groups as `a,a|b;`, each with the mark behind it; `at_a` and `at_b` are the places of their last tokens."""
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[at_a], end_b[at_b] = 1, 1
        group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
        # Before a token stand its own side's and, of the other side, that of the groups before (or of this one too).
        before_a, before_b = np.concatenate([[0], at_b + 1]), at_a + 1
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + before_a[group_a]] = a + self.width * end_a
        out[np.arange(len(b)) + before_b[group_b]] = b + 2 * self.width * end_b
        return "".join(map(self.signs.__getitem__, out.tolist()))


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each Python worker."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def ranges(text: bytes, chunk: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, stop, low, high) for each byte range: encode text[start:stop], take tokens that end after low, up to high."""
    cuts = np.array([0, *(m.start() for m in SAFE.finditer(text)), len(text)])

    def around(edge: int) -> tuple[int, int]:
        k = int(np.searchsorted(cuts, edge, "left"))
        return int(cuts[max(k - 1, 0)] if cuts[k] != edge else edge), int(cuts[k])

    edges = [*range(0, len(text), chunk), len(text)]
    for low, high in zip(edges, edges[1:]):
        (start, after), (before, stop) = around(low), around(high)
        if after - start > chunk:  # the stretch over the lower edge belongs to the range it starts in
            start = low = after
        if stop - before > chunk:
            high = stop
        if low < high:
            yield start, stop, low, high


FRAGMENT = "head_a array<int>, head_b array<int>, closed string, tail_a array<int>, tail_b array<int>, links array<int>, n_a long, n_b long, whole boolean"
_KINDS = {"array<int>": pa.list_(pa.int32()), "string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}


def columns(fragments: list[Fragment]) -> list[pa.Array]:
    kinds = [x.rsplit(" ", 1)[1] for x in FRAGMENT.split(", ")]
    return [pa.array(values, _KINDS[kind]) for values, kind in zip(zip(*fragments) if fragments else [()] * len(kinds), kinds)]


def _fragments(table: pa.Table) -> list[Fragment]:
    made = []
    for i in range(table.num_rows):
        row = [table.column(x)[i] for x in Fragment._fields]
        made.append(Fragment(*(x.values.to_numpy() if isinstance(x, pa.ListScalar) else x.as_py() for x in row)))
    return made


ALIGNED = "n_a long, n_b long, groups_sha256 string, links array<int>"


def finished(fragments: list[Fragment]) -> list[pa.Array]:
    """Columns of `ALIGNED` for the fragments of whole texts."""
    rows = []
    for f in fragments:
        if not f.whole or f.closed is None:
            rows.append((0, 0, "", _NONE))
        else:
            groups = f"{printed(f.head_a, f.head_b)};{f.closed}"[:-1]
            rows.append((f.n_a, f.n_b, hashlib.sha256(groups.encode()).hexdigest(), f.links))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
    return [pa.array(values, kind) for values, kind in zip(zip(*rows) if rows else [()] * 4, kinds)]


def _batches(batch: pa.RecordBatch, size: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in slices of about `size` bytes of text."""
    step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield part, part.column("text").cast(pa.binary()).to_pylist()


def _short(docs: DataFrame, path_a: str, path_b: str, id_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(path_a, path_b)
        for batch in batches:
            for part, bytes_ in _batches(batch):
                items = [x.decode("utf-8", "replace") for x in bytes_]
                ids = zip(made.a.encode([" " + x for x in items]), made.b.encode(items))
                fragments = [made.fragment(a, b, b" " + x, 0, len(x) + 1) if x else ODD for (a, b), x in zip(ids, bytes_)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *finished(fragments)], ["doc_id", "n_a", "n_b", "groups_sha256", "links"])

    return docs.mapInArrow(run, f"doc_id {id_type}, {ALIGNED}")


def _long(docs: DataFrame, path_a: str, path_b: str, id_type: str, chunk: int, fan: int) -> DataFrame:
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text").cast(pa.binary())):
                text = b" " + text.as_py()
                parts = list(ranges(text, chunk))
                # One range's text at a time: what comes out is not larger than a few ranges.
                for no, (start, stop, low, high) in enumerate(parts):
                    values = [[row], [doc.as_py()], [no], [len(parts)], [text[start:stop]], [low - start], [high - start]]
                    kinds = [pa.int64(), batch.column("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["row", "doc_id", "no", "parts", "piece", "low", "high"])
                row += 1

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(path_a, path_b)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                piece, low, high = (one.column(x)[0].as_py() for x in ("piece", "low", "high"))
                # Pieces start with a space, which the second vocabulary adds by itself. A piece is cut between characters.
                try:
                    text = piece.decode()
                    fragment = made.fragment(made.a.encode([text])[0], made.b.encode([text[1:]])[0], piece, low, high)
                except UnicodeDecodeError:
                    fragment = ODD
                yield pa.RecordBatch.from_arrays([*(one.column(x) for x in ("row", "doc_id", "no", "parts")), *columns([fragment])], names)

    names = ["row", "doc_id", "no", "parts", *Fragment._fields]
    schema = f"row long, doc_id {id_type}, no long, parts long, {FRAGMENT}"
    pieces = docs.mapInArrow(cut, f"row long, doc_id {id_type}, no long, parts long, piece binary, low long, high long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = stored(pieces.repartition(tasks, "row", "no").mapInArrow(encoded, schema), "fragments")
    most, width = level.agg(F.max("parts")).first()[0] or 0, 1

    def reduced(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        first, *rest = _fragments(table)
        for f in rest:
            first = first + f
        return pa.table([*(table.slice(0, 1)[x] for x in ("row", "doc_id", "no", "parts")), *columns([first])], names=names)

    while width < most:
        width *= fan
        level = stored(level.groupBy("row", F.floor(F.col("no") / width).alias("part")).applyInArrow(reduced, schema), "fragments")

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([one.column("doc_id"), *finished(_fragments(pa.Table.from_batches([one])))], ["doc_id", "n_a", "n_b", "groups_sha256", "links"])

    return level.mapInArrow(end, f"doc_id {id_type}, {ALIGNED}")


def linked(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_a, n_b, groups_sha256, links (pairs by number): a stored row for each document."""
    base, size = texts(docs), F.octet_length("text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    short = _short(base.where(size <= chunk), path_a, path_b, id_type)
    return stored(short.unionByName(_long(base.where(size > chunk), path_a, path_b, id_type, chunk, fan)), "links")


def counted(links: DataFrame, size: int) -> np.ndarray:
    """How many links hold each pair. Every task adds up its own; their sums have at most `size` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            flat = batch.column("links").flatten().to_numpy()
            if len(flat):
                n += np.bincount(flat, minlength=size)
        pairs = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int32()), pa.array(n[pairs])], ["pair", "n"])

    sums = links.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return out


def aligned(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `path_a` is a byte-level vocabulary of the tokenizers library, `path_b` a sentencepiece model, which the workers have.
    """
    pairs = aligner(path_a, path_b).pairs
    links = linked(docs, path_a, path_b, chunk, fan)
    counts = counted(links, pairs.size)
    sent = links.sparkSession.sparkContext.broadcast(counts)
    best = links.sparkSession.sparkContext.broadcast(_best(pairs, counts, path_a, path_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("links")
            flat, ends = lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_pylist()])
            sums = [np.concatenate([[0], np.cumsum(x[flat])]) for x in (sent.value, best.value.astype(np.int64))]
            total, top = (s[ends[1:]] - s[ends[:-1]] for s in sums)
            n = pa.array(np.diff(ends), pa.int64())
            made = {"n_groups": n, "n_links": n, "n_best": pa.array(top), "count_sum": pa.array(total)}
            yield pa.RecordBatch.from_arrays([made.get(x) if x in made else batch.column(x) for x in out], out)

    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return links.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{x} long" for x in out[1:-1]) + ", groups_sha256 string")


def _best(pairs: Pairs, counts: np.ndarray, path_a: str, path_b: str) -> np.ndarray:
    """Whether a pair's count is the highest of its second token."""
    made = aligner(path_a, path_b)
    used = np.flatnonzero(counts)
    # From a number back to the second token: by its own place, or as the suffix of that length of the first one.
    of_bytes = {t: i for i, (t, f) in enumerate(zip(made.b.tokens, made.b.fallback)) if not f}
    of_byte = {t: i for i, (t, f) in enumerate(zip(made.b.tokens, made.b.fallback)) if f}
    second = np.empty(len(used), np.int64)
    for k, number in enumerate(used.tolist()):
        if number >= pairs.first[-1]:
            second[k] = np.searchsorted(pairs.second, number, "right") - 1
        else:
            a = int(np.searchsorted(pairs.first, number, "right")) - 1
            length = number - int(pairs.first[a])
            token = made.a.tokens[a]
            second[k] = of_bytes[token[-length:]] if length else of_byte[token[-1:]]
    top = np.zeros(len(made.b.tokens), np.int64)
    np.maximum.at(top, second, counts[used])
    out = np.zeros(len(counts), bool)
    out[used] = counts[used] == top[second]
    return out
