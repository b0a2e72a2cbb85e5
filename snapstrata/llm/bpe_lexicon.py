"""BPE by lexicon: frequent words are looked up in a minimal acyclic transducer, others are merged.

Words of all texts are counted; those that make up at least `share` of them all (so at most 1 / share words) are
encoded once and compiled, in order, into an automaton in which equal suffixes are one state. Along a word's path
the outputs add up to its number, and the number leads to its ids. The arrays go to the workers as one block that
they map into memory. Words of a batch walk the automaton together; words it lacks are merged by tiktoken with the
vocabulary's ranks, and by the library where they may hold a special token.

Texts are cut where the vocabulary's own pre-tokenizer always cuts: before a space that opens a word and around
white space. So ids of a text are those of its words one after the other. Each text is encoded by itself; the only
shuffle is that of the word counts.

Edge cases: null and empty texts have no ids; special tokens written out in a text get their ids, as the library
does it; invalid UTF-8 reads as U+FFFD; an empty table has an empty lexicon and gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import tempfile
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import mapped, texts

#: Unicode's white space, as a class of regular expressions.
WHITE = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + chr(0x2000) + "-" + chr(0x200A)
WORD = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def compiled(words: Iterable[bytes], ids: Iterable[list[int]]) -> bytes:
    """The transducer of sorted, distinct words and their ids, as one block of arrays."""
    words, ids = list(words), list(ids)
    finals: list[bool] = []
    arcs: list[dict[int, int]] = []
    register: dict[tuple, int] = {}

    def state() -> int:
        finals.append(False)
        arcs.append({})
        return len(arcs) - 1

    path, before = [state()], b""

    def fold(depth: int) -> None:
        """States below `depth` on the path of the last word are done: each becomes its like, if there is one."""
        while len(path) > depth + 1:
            done = path.pop()
            like = register.setdefault((finals[done], tuple(arcs[done].items())), done)
            arcs[path[-1]][before[len(path) - 1]] = like

    for word in words:
        same = len(os.path.commonprefix([word, before]))
        fold(same)
        for letter in word[same:]:
            new = state()
            arcs[path[-1]][letter] = new
            path.append(new)
        finals[path[-1]] = True
        before = word
    fold(0)
    # States in use, children first; how many words each leads to; what its arcs add to a word's number.
    count: dict[int, int] = {}
    stack = [path[0]]
    while stack:
        s = stack[-1]
        left = [t for t in arcs[s].values() if t not in count]
        if left:
            stack += left
        else:
            stack.pop()
            count[s] = finals[s] + sum(count[t] for t in arcs[s].values())
    number = {s: i for i, s in enumerate(sorted(count))}
    keys, targets, adds = [], [], []
    for s in sorted(count):
        n = int(finals[s])
        for letter, t in sorted(arcs[s].items()):
            keys.append(number[s] << 8 | letter)
            targets.append(number[t])
            adds.append(n)
            n += count[t]
    ends = np.cumsum([0, *map(len, ids)])
    parts = [
        np.array(keys, np.int64), np.array(targets, np.int32), np.array(adds, np.int32), np.array([finals[s] for s in sorted(count)], np.uint8),
        ends.astype(np.int64), np.array([i for x in ids for i in x], np.uint32),
    ]
    head = json.dumps([[p.dtype.str, len(p)] for p in parts]).encode()
    head += b" " * (-(len(head) + 8) % 8)
    return len(head).to_bytes(8, "little") + head + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)


class Lexicon:
    """A compiled block, mapped into memory."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(self.map[:8], "little")
        at, parts = 8 + size, []
        for kind, n in json.loads(self.map[8:at]):
            parts.append(np.frombuffer(self.map, kind, n, at))
            at += -(-parts[-1].nbytes // 8) * 8
        self.keys, self.targets, self.adds, self.finals, self.ends, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 for those that are not in it."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not words:
            return out
        letters = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        live = np.flatnonzero(lengths > 0)
        states, sums, depth = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64), 0
        while len(live):
            keys = states << 8 | letters[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            on = self.keys[at] == keys
            live, at, sums = live[on], at[on], sums[on]
            states, sums, depth = self.targets[at].astype(np.int64), sums + self.adds[at], depth + 1
            ended = lengths[live] == depth
            found = ended & (self.finals[states] == 1)
            out[live[found]] = sums[found]
            live, states, sums = live[~ended], states[~ended], sums[~ended]
        return out

    def found(self, words: list[str]) -> dict[str, bytes]:
        """Ids, as unsigned 32-bit bytes, of the words that are in it."""
        numbers = self.numbers([w.encode() for w in words]).tolist()
        return {w: self.ids[self.ends[n] : self.ends[n + 1]].tobytes() for w, n in zip(words, numbers) if n >= 0}


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def unicode_bytes() -> dict[str, int]:
    """Byte-level vocabularies write bytes as printable characters: those that are printable in Latin-1 as
    themselves, the others in order from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}


def token_bytes(path: str) -> list[bytes]:
    """What each id of a byte-level vocabulary stands for."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = unicode_bytes()
    vocabulary = {i: bytes(byte[c] for c in t) for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]


def merger(path: str):
    """tiktoken with the vocabulary's ranks; special tokens are plain text to it. Its split is the vocabulary's own."""
    import public_tokenizers
    import tiktoken

    special = library(path).get_added_tokens_decoder()
    ranks = {t: i for i, t in enumerate(token_bytes(path)) if i not in special}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Codec:
    def __init__(self, path: str, block: bytes):
        self.lexicon, self.library, self.bytes, self.merger = Lexicon(block), library(path), token_bytes(path), merger(path)
        (self.line,) = self.merger.encode_ordinary("\n")

    def words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word: from the transducer, else merged; what may hold a special token is merged by the library."""
        out = self.lexicon.found(words)
        unseen = [w for w in words if w not in out]
        marked = [w for w in unseen if "<|" in w]
        out.update(zip(marked, [array("I", x.ids).tobytes() for x in self.library.encode_batch_fast(marked, add_special_tokens=False)]))
        merge = self.merger.encode_ordinary
        out.update([(w, array("I", merge(w)).tobytes()) for w in unseen if w.isspace()])
        # The others by one call, a line each: they hold no line feed, and that is always a token of its own between them.
        lined = [w for w in unseen if "<|" not in w and not w.isspace()]
        ids = np.array(merge("\n".join([*lined, ""])) if lined else [], np.uint32)
        ends = np.flatnonzero(ids == self.line).tolist()
        block = ids.tobytes()
        out.update([(w, block[4 * a + 4 : 4 * b]) for w, a, b in zip(lined, [-1, *ends], ends)])
        return out

    def encode(self, batch: list[str]) -> list[list[int]]:
        cut = [WORD.findall(x) for x in batch]
        ids = self.words(list({w for ws in cut for w in ws}))
        return [np.frombuffer(b"".join([ids[w] for w in ws]), np.uint32).tolist() for ws in cut]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def lexicon(docs: DataFrame, path: str, share: float = 2e-6) -> bytes:
    """Words of at least `share` of all, each with the space before it, compiled with their ids."""
    words = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "[ \n]+")).alias("word")).where("word <> ''")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    total = docs.select(F.size(F.split(F.coalesce("text", F.lit("")), "[ \n]+")).alias("n")).agg(F.sum("n")).first()[0] or 0
    # At most 1 / share of them.
    frequent = sorted(f" {r['word']}" for r in counts.where(F.col("n") >= max(2.0, share * total)).select("word").collect())
    frequent = sorted((w for w in frequent if WORD.fullmatch(w)), key=str.encode)
    return compiled([w.encode() for w in frequent], [x.ids for x in library(path).encode_batch_fast(frequent, add_special_tokens=False)])


_codecs: dict[tuple, Codec] = {}


def encoded(docs: DataFrame, path: str, share: float = 2e-6) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256.

    `path` is the vocabulary's file, which the workers have.
    """
    block = lexicon(docs, path, share)
    key, sent = hashlib.sha256(block).hexdigest(), docs.sparkSession.sparkContext.broadcast(block)

    def rows(batch: list[bytes], _) -> dict:
        if (path, key) not in _codecs:
            _codecs.clear()
            _codecs[path, key] = Codec(path, sent.value)
        codec = _codecs[path, key]
        decimal = [str(i) for i in range(len(codec.bytes))]
        made: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        start = 0
        while start < len(batch):
            stop, size = start, 0
            while stop < len(batch) and (size < 1 << 22 or stop == start):
                size += len(batch[stop])
                stop += 1
            for ids in codec.encode([x.decode("utf-8", "replace") for x in batch[start:stop]]):
                made["n_tokens"].append(len(ids))
                made["ids_sha256"].append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                made["decoded_sha256"].append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            start = stop
        return made | {"n_tokens": pa.array(made["n_tokens"], pa.int64())}

    return mapped(texts(docs), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
