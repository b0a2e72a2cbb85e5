"""Harmonic packing of token sequences.

Capacity C is divided into reciprocal classes: class k holds pieces of floor(C / k) tokens, k to a sequence. A
document is cut into the largest piece of a class that it fills, again and again, down to less than the smallest
class; such rests run on from one sequence to the next, cut where one is full. So a full sequence of class k holds
a fixed number of pieces and lacks at most k - 1 tokens, those of rests lack none, and no sequence depends on
what another class or worker does.

Each partition is packed as it streams by: memory holds one open sequence for each class, there is no shuffle,
and sequence ids are made of the partition's number and a count. At the end of a partition its open sequences
(fewer than `CLASSES` of each length) run on like rests; the last one is cut at powers of two, which need no padding.

Ids are those of the tokenizers library. Texts of plain letters are split here as the vocabulary splits them and merged
by tiktoken, which is several times as fast, a mark standing for the end of a piece. Other texts go to the library. White
space never lies inside a token of this vocabulary, so they are encoded piece by piece between it, and pieces met before
are looked up in a bounded table.

Edge cases: null and empty texts are one token, the end mark; repeated rows are packed each; texts may be longer
than any sequence; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from snapstrata.llm.bpe_lexicon import unicode_bytes
from snapstrata.llm.common import texts

CAPACITY, CLASSES, END = 2048, 16, 1

#: Where normalisation is just lower case: no letter here is put together with others or changed in length.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-įĲ-ſ]+")
#: The vocabulary's own split, over such text in lower case.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")


#: Texts of such characters and ASCII white space only, and the vocabulary's split of them in lower case.
WHOLE = re.compile(PLAIN.pattern[:-2] + r" \t-\r]*")
WHOLE_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ \t-\r]+")
#: Stands for the end of a piece; no text of `WHOLE` has it.
MARK = "\x01"


def merger(path: str):
    """The vocabulary's merges for tiktoken: None where they don't follow from the order of its tokens.

    Every piece ends with the mark, and the vocabulary's last-letter tokens are that letter and the mark. They stand
    before all merges, so tiktoken puts the mark to the last letter first, and then merges in the vocabulary's order.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, special = spec["model"], {t["id"] for t in spec["added_tokens"]}
    end, vocabulary, letters = model["end_of_word_suffix"], model["vocab"], unicode_bytes()
    merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
    first = 2 * len(letters)
    if not end or any(vocabulary.get(a + b) != first + k for k, (a, b) in enumerate(merges)):
        return None
    ranks = {}
    for token, i in vocabulary.items():
        if i not in special:
            body = token.removesuffix(end)
            ranks[bytes(letters[c] for c in body) + (MARK.encode() if body != token else b"")] = i
    return tiktoken.Encoding("pieces", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts as unsigned 32-bit bytes, by merging or through two bounded tables of pieces met before."""

    def __init__(self, path: str, bound: int = 120_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merger = merger(path)
        self.bound = bound
        self.chunks: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _library(self, items: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.library.encode_batch_fast(items, add_special_tokens=False)]

    def _learn(self, chunks: set[bytes]) -> None:
        split: dict[bytes, list[str]] = {}
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            # Marks like <|endoftext|> in a text are special only as a whole.
            split[chunk] = PIECE.findall(text.lower()) if PLAIN.fullmatch(text) and "<|" not in text else [text]
        pieces = self.pieces
        new = list({p for ps in split.values() for p in ps if p not in pieces})
        pieces.update(zip(new, self._library(new)))
        self.chunks.update((c, pieces[ps[0]] if len(ps) == 1 else b"".join([pieces[p] for p in ps])) for c, ps in split.items())

    def encode(self, batch: list[bytes]) -> Iterator[bytes]:
        texts = [x.decode("utf-8", "replace") for x in batch]
        plain = [self.merger is not None and WHOLE.fullmatch(x) is not None and "<|" not in x for x in texts]
        others = self._tabled([x for x, p in zip(batch, plain) if not p])
        for text, p in zip(texts, plain):
            yield self._merged(text) if p else next(others)

    def _merged(self, text: str) -> bytes:
        pieces = [*WHOLE_PIECE.findall(text.lower()), ""]
        return array("I", self.merger.encode_ordinary(MARK.join(pieces))).tobytes()

    def _tabled(self, batch: list[bytes]) -> Iterator[bytes]:
        # A few megabytes of words at a time are looked up together.
        start = 0
        while start < len(batch):
            stop, size = start, 0
            while stop < len(batch) and (size < 1 << 21 or stop == start):
                size += len(batch[stop])
                stop += 1
            words = [x.split() for x in batch[start:stop]]
            # Of a full table the older half goes; what is frequent is soon back. Pieces are dear to work out, chunks are not.
            if len(self.chunks) > self.bound:
                self.chunks = dict(islice(self.chunks.items(), len(self.chunks) - self.bound // 2, None))
            if len(self.pieces) > 2 * self.bound:
                self.pieces = dict(islice(self.pieces.items(), len(self.pieces) - self.bound, None))
            new = {w for ws in words for w in ws}.difference(self.chunks)
            if new:
                self._learn(new)
            known = self.chunks
            for ws in words:
                yield b"".join([known[w] for w in ws])
            start = stop


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker, so that later tasks find its tables filled."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """Takes documents, gives rows (document, start, ids, tokens of the document, sequence, offset)."""

    def __init__(self, capacity: int, classes: int, first_sequence: int):
        self.capacity = capacity
        self.sizes = [capacity // k for k in range(1, classes + 1)]
        self.open: list[list[tuple]] = [[] for _ in self.sizes]
        self.run: list[tuple] = []  # the sequence of rests that is being filled
        self.run_length = 0
        self.next_sequence = first_sequence
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, ids, total, self.next_sequence, offset))
            offset += len(ids) // 4
        self.next_sequence += 1

    def _rest(self, piece: tuple) -> None:
        doc, start, ids, total = piece
        while ids:
            room = (self.capacity - self.run_length) * 4
            self.run.append((doc, start, ids[:room], total))
            self.run_length += len(self.run[-1][2]) // 4
            start, ids = start + room // 4, ids[room:]
            if self.run_length == self.capacity:
                self._close(self.run)
                self.run, self.run_length = [], 0

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.sizes[-1]:
            k = next(k for k, size in enumerate(self.sizes) if size <= total - start)
            self.open[k].append((doc, start, ids[4 * start : 4 * (start + self.sizes[k])], total))
            start += self.sizes[k]
            if len(self.open[k]) == k + 1:
                self._close(self.open[k])
                self.open[k] = []
        if start < total:
            self._rest((doc, start, ids[4 * start :], total))

    def finish(self) -> None:
        for pieces in self.open:
            for piece in pieces:
                self._rest(piece)
        left, self.run, whole = self.run, [], self.capacity
        length, self.run_length = self.run_length, 0
        for size in (1 << i for i in reversed(range(whole.bit_length()))):
            if not length & size:
                continue
            part, room = [], size * 4
            while room:
                doc, start, ids, total = left.pop(0)
                part.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    left.insert(0, (doc, start + room // 4, ids[room:], total))
                room -= len(part[-1][2])
            self._close(part)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, classes: int = CLASSES) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row for each piece.

    `path` is the vocabulary's file, which the workers have.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    end = array("I", [END]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encode = Packer(capacity, classes, TaskContext.get().partitionId() << 33), encoder(path).encode
        kind = pa.int64()

        def made() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            docs, starts, ids, totals, sequences, offsets = zip(*rows) if rows else [()] * 6
            columns = [starts, [len(x) // 4 for x in ids], [zlib.crc32(x) for x in ids], totals, sequences, offsets]
            return pa.RecordBatch.from_arrays([pa.array(docs, kind), *(pa.array(c, pa.int64()) for c in columns)], names)

        for batch in batches:
            kind = batch.column("doc_id").type
            ids = batch.column("doc_id").to_pylist()
            for doc, tokens in zip(ids, encode(batch.column("text").cast(pa.binary()).to_pylist())):
                packer.add(doc, tokens + end)
                if len(packer.rows) > 20_000:
                    yield made()
        packer.finish()
        yield made()

    return texts(docs).mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{x} long" for x in names[1:]))
