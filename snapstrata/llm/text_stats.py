"""Counts over whole texts, from which the quality operators draw."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from snapstrata.llm.common import mapped, texts

COUNTS = (
    "n_bytes", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_digits", "n_marks",
)
SYMBOLS, UPPER, DIGITS, MARKS = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b".,;:!?"
SPACE = b" \t\n\v\f\r"


def repeated(words: list[bytes]) -> tuple[int, int]:
    """Words inside 3-word windows that the text has twice or more; number of different words."""
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    n = len(index)
    if len(ids) < 4 or n == len(ids):
        return 0, n
    pairs = ids[:-1] * n + ids[1:]
    if n >= 1 << 20:  # the product of three would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    codes = pairs[:-1] * n + ids[2:]
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    if not same.any():
        return 0, n
    twice = np.zeros(len(codes), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(codes)] |= twice
    return int(covered.sum()), n


def counted(text: bytes) -> tuple[int, ...]:
    words = text.split()
    spaces = len(text) - len(text.translate(None, SPACE))
    code_points = len(text) - len(text.translate(None, bytes(range(128, 192))))  # bytes that go on a code point
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    covered, distinct = repeated(words)
    lacks = lambda kind: len(text) - len(text.translate(None, kind))
    return (
        len(text), len(words), len(text) - spaces - code_points, lacks(SYMBOLS), len(lines), len(lines) - len(set(lines)),
        covered, distinct, lacks(UPPER), lacks(DIGITS), lacks(MARKS),
    )


def statistics(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, further columns as they are (`text` too, if named: null comes out empty), and COUNTS of each text.

    Null and empty texts count nothing.
    """

    def rows(batch: list, _) -> dict:
        table = np.array([counted(x) for x in batch], np.int64).reshape(-1, len(COUNTS))
        return dict(zip(COUNTS, table.T))

    fields = {x.name: x.dataType.simpleString() for x in docs.schema}
    passed = ("doc_id", *more)
    more = tuple(x for x in more if x != "text")
    schema = ", ".join([f"{x} {fields[x]}" for x in passed] + [f"{x} long" for x in COUNTS])
    return mapped(texts(docs, *more), rows, schema, passed)
