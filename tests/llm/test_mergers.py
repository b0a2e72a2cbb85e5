"""Merging by tiktoken against the tokenizers library, on texts made of the vocabularies' own tokens and of random letters."""

import random
import re
from array import array

import pytest

from snapstrata.llm import bpe_lexicon, packing
from snapstrata.llm.common import vocabulary

LETTERS = "abcdefghijklmnopqrstuvwxyzàéßöñÿžſ'!?.#0123456789ABCÉÀ"


def strings(tokens, n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        yield "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 14)))
        yield "".join(rng.choice(tokens) for _ in range(rng.randint(1, 5)))


@pytest.fixture(scope="module")
def tokens():
    return [t.decode("utf-8", "ignore") for t in bpe_lexicon.token_bytes(vocabulary("byte_bpe_50k.json"))]


def test_pieces_with_an_end_mark(tokens):
    encoder = packing.Encoder(vocabulary("word_bpe_49k.json"))
    assert encoder.merger is not None
    rng = random.Random(3)
    words = list(strings(tokens, 30_000, 4))
    texts = ["".join(rng.choice([" ", "\n", "\t ", ""]) + w for w in words[i : i + 12]) for i in range(0, len(words), 12)]
    texts += ["", " ", "\n\t", "'s 's'LL I'm", "<|endoftext|> a", "日本 語", "é İstanbul", "\x01 a\x01b", "a b", "x\x1cy", "½ ² ª µ"]
    plain = sum(packing.WHOLE.fullmatch(x) is not None and "<|" not in x for x in texts)
    assert 1000 < plain < len(texts)
    want = [array("I", x.ids).tobytes() for x in encoder.library.encode_batch_fast(texts, add_special_tokens=False)]
    assert list(encoder.encode([x.encode() for x in texts])) == want


def test_every_token_merges_to_itself_or_as_the_library_says(tokens):
    encoder = packing.Encoder(vocabulary("word_bpe_49k.json"))
    words = [w for w in dict.fromkeys(t.strip().lower() for t in tokens) if w and packing.WHOLE.fullmatch(w) and "<|" not in w and not re.search(r"\s", w)]
    want = [array("I", x.ids).tobytes() for x in encoder.library.encode_batch_fast(words, add_special_tokens=False)]
    assert [encoder._merged(w) for w in words] == want


def test_byte_level_ranks(tokens):
    path = vocabulary("byte_bpe_50k.json")
    merger, library = bpe_lexicon.merger(path), bpe_lexicon.library(path)
    library.encode_special_tokens = True
    items = [*strings(tokens, 30_000, 5), "<|endoftext|>", "", "İſ a　 b", *tokens]
    assert [merger.encode_ordinary(x) for x in items] == [x.ids for x in library.encode_batch_fast(items, add_special_tokens=False)]


def test_words_by_lexicon_or_merge(tokens):
    path = vocabulary("byte_bpe_50k.json")
    codec = bpe_lexicon.Codec(path, bpe_lexicon.compiled([b" the"], [bpe_lexicon.library(path).encode(" the", add_special_tokens=False).ids]))
    items = [" ".join(["the", *strings(tokens, 4, seed), "<|endoftext|>" if seed % 3 == 0 else "x"]) for seed in range(1500)]
    assert codec.encode(items) == [x.ids for x in codec.library.encode_batch_fast(items, add_special_tokens=False)]
