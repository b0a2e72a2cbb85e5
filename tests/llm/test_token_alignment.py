"""Alignment of two vocabularies against a plain count over whole texts, and the laws of its fragments."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapstrata.llm import token_alignment as T
from snapstrata.llm.bpe_lexicon import token_bytes
from snapstrata.llm.common import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def models():
    import sentencepiece

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    names = [second.id_to_piece(i) for i in range(second.get_piece_size())]
    return first, token_bytes(A), second, [bytes.fromhex(x[3:5]) if second.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]


def plainly(models, rows):
    first, bytes_a, second, bytes_b = models
    made, counts = [], Counter()
    for doc, text in rows:
        groups, links = [], []
        if text:
            want = (" " + text).encode()
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            if b"".join(bytes_a[i] for i in a) == want == b"".join(bytes_b[i] for i in b):
                ends = [[sum(len(k[i]) for i in ids[: n + 1]) for n in range(len(ids))] if len(ids) < 40 else None for k, ids in ((bytes_a, a), (bytes_b, b))]
                for n, (k, ids) in enumerate(((bytes_a, a), (bytes_b, b))):
                    if ends[n] is None:
                        at, ends[n] = 0, []
                        for i in ids:
                            at += len(k[i])
                            ends[n].append(at)
                at_b = {e: n for n, e in enumerate(ends[1])}
                i = j = 0
                for n, e in enumerate(ends[0]):
                    if e in at_b:
                        m = at_b[e]
                        groups.append(",".join(map(str, a[i : n + 1])) + "|" + ",".join(map(str, b[j : m + 1])))
                        links.append((a[n], b[m]))
                        i, j = n + 1, m + 1
            else:
                a = b = []
        else:
            a = b = []
        counts.update(links)
        made.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return Counter((d, na, nb, g, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), s) for d, na, nb, g, x, s in made)


def got(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r[n] for n in names) for r in df.select(*names).collect())


LONG = [
    "".join(random.Random(5).choice(["ein ", "wort", "über", " ", "\n", "日本 ", "x" * 70, "'s ", "12 "]) for _ in range(4000)),
    "y" * 5000 + " " + "word " * 300 + "z" * 3000,
    "日本語" * 900,
    "　a  b c  d" * 300,
    " " * 3000,
]
ODD = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "<|endoftext|> <s> </s> <0x41>"), (6, "a\0b\tc\r\n"), (7, "ｆull width　space"), (7, "same"), (7, "same"), (None, "no id"), (8, "é ß İ ﬁ")]


def test_whole_table(spark, models):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    assert got(T.aligned(docs, A, B)) == plainly(models, [tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("chunk", [64, 1000])
def test_long_texts_in_ranges(spark, models, chunk):
    rows = [*ODD, *((100 + i, x) for i, x in enumerate(LONG))]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("row", "no", "part", "parts", "links", "pair", "n", "n_a", "whole")})
    assert got(T.aligned(df, A, B, chunk=chunk, fan=3)) == plainly(models, rows)
    assert T.aligned(df.where("false"), A, B).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 64, 1000])
def test_every_token_lies_in_one_range(chunk):
    """Ranges follow each other over the whole text, and encoding from cut to cut gives the tokens of the whole."""
    made = T.aligner(A, B)
    for text in LONG[:4]:
        text = text[:1500]
        whole = (" " + text).encode()
        parts = list(T.ranges(whole, chunk))
        assert parts[0][2] == 0 and parts[-1][3] == len(whole) and all(p[3] == q[2] for p, q in zip(parts, parts[1:]))
        assert all(start <= low < high <= stop for start, stop, low, high in parts)
        whole_fragment = made.fragment(made.a.encode([" " + text])[0], made.b.encode([text])[0], whole, 0, len(whole))
        total = T.EMPTY
        for start, stop, low, high in parts:
            piece = whole[start:stop].decode()
            total = total + made.fragment(made.a.encode([piece])[0], made.b.encode([piece[1:]])[0], piece.encode(), low - start, high - start)
        assert same(total, whole_fragment)


def same(x, y):
    return all(a.tolist() == b.tolist() if hasattr(a, "tolist") else a == b for a, b in zip(x, y))


@pytest.mark.parametrize("n", [150, 600])
def test_fragments_are_a_monoid(n):
    made, rng = T.aligner(A, B), random.Random(9)
    text = " ".join("".join(rng.choice("etaoinsh") for _ in range(rng.randint(2, 14))) for _ in range(250))
    whole, ids_a, ids_b = (" " + text).encode(), made.a.encode([" " + text])[0], made.b.encode([text])[0]
    edges = sorted({0, len(whole), *(rng.randrange(len(whole)) for _ in range(n))})
    parts = [made.fragment(ids_a, ids_b, whole, low, high) for low, high in zip(edges, edges[1:])]
    assert any(f.closed is None for f in parts) if n == 600 else any(len(f.tail_a) for f in parts)
    while len(parts) > 1:  # in any bracketing
        i = rng.randrange(len(parts) - 1)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    assert same(parts[0], made.fragment(ids_a, ids_b, whole, 0, len(whole)))
    parts = [made.fragment(ids_a, ids_b, whole, low, high) for low, high in zip(edges, edges[1:])]
    for _ in range(200):
        i = rng.randrange(len(parts) - 2)
        x, y, z = parts[i : i + 3]
        assert same((x + y) + z, x + (y + z)) and same(T.EMPTY + x, x) and same(x + T.EMPTY, x)


def test_pair_numbers_are_distinct_and_bounded():
    made = T.aligner(A, B)
    at = {t: i for i, (t, f) in enumerate(zip(made.b.tokens, made.b.fallback)) if not f}
    first = {t: i for i, t in enumerate(made.a.tokens)}
    pairs = [(i, at[t[k:]]) for t, i in first.items() for k in range(len(t)) if t[k:] in at]
    pairs += [(first[t[k:]], i) for t, i in at.items() for k in range(1, len(t)) if t[k:] in first]
    import numpy as np

    numbers = made.pairs.of(*np.array(pairs).T)
    assert len(set(numbers.tolist())) == len(pairs) and 0 <= numbers.min() and numbers.max() < made.pairs.size < 800_000
