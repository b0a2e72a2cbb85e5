"""License scans: fuzzy search for short notices.

A notice of n letters may be found with up to k edits. Cut into k + 1 pieces, it leaves at least one piece
whole however the edits fall (pigeonhole), so exact finds of the pieces are the only places to look at.
There the `regex` library matches the notice with at most k errors, and gives the span.

Texts are compared as words: letters and digits (A-Z in lower case) and everything from U+0080 on, joined by
one space. A notice begins and ends at words.

Each text is looked at by itself in Arrow batches; there is no shuffle, and memory holds a batch. Edge cases:
null and empty texts have no words and no spans; repeated rows each get a row; overlapping places all count;
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import regex
from pyspark.sql import DataFrame

from snapstrata.llm.common import mapped, texts

#: Everything but words is a space; A-Z become a-z.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Notice:
    label: str
    words: str
    errors: int  # letters that may be put in, left out or changed
    base: bool = False


BASE = (
    Notice("gpl", "gnu general public license", 2, True),
    Notice("apache", "apache license", 1, True),
    Notice("cc-by", "cc by", 0, True),
    Notice("mit", "mit license", 1, True),
)
NOTICES = BASE + (
    Notice("agpl", "gnu affero general public license", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("gpl", "this program is free software you can redistribute it and or modify it", 5),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 5),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 5),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("cc-by-nc", "cc by nc", 0),
    Notice("cc-by-sa", "cc by sa", 0),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 5),
    Notice("reserved", "all rights reserved", 1),
)


class Searcher:
    def __init__(self, notices: Sequence[Notice]):
        self.notices = notices
        self.seeds: list[tuple[bytes, int, int]] = []  # piece, notice, place of the piece in the notice
        self.fuzzy = []
        for i, n in enumerate(notices):
            words = n.words.encode()
            cuts = [len(words) * j // (n.errors + 1) for j in range(n.errors + 2)]
            self.seeds += [(words[a:b], i, a) for a, b in zip(cuts, cuts[1:])]
            self.fuzzy.append(regex.compile(rb"(?b)(?<= )(?:%s){e<=%d}(?= )" % (regex.escape(words), n.errors)))

    def spans(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(notice, errors, start, end) in a text of words with a space before, between and after them."""
        found = set()
        near: dict[int, list[tuple[int, int]]] = {}
        for piece, i, at in self.seeds:
            words, k = self.notices[i].words.encode(), self.notices[i].errors
            place = text.find(piece)
            while place >= 0:
                start = place - at
                if start > 0 and text.startswith(words, start) and text[start - 1] == 32 == text[start + len(words)]:
                    found.add((i, 0, start, start + len(words)))
                elif k:
                    near.setdefault(i, []).append((max(0, start - k - 1), start + len(words) + k + 1))
                place = text.find(piece, place + 1)
        for i, windows in near.items():
            exact = {x[2:] for x in found if x[0] == i}
            done = -1
            for a, b in sorted(windows):
                # A window is as wide as one match can be; one that starts inside a match is looked at from the match's end.
                m = self.fuzzy[i].search(text, max(a, done), b + 1)
                if m and not any(s < m.end() and m.start() < e for s, e in exact):
                    found.add((i, sum(m.fuzzy_counts), m.start(), m.end()))
                    done = m.end()
        return sorted(found, key=lambda x: (x[2], x[3], x[0]))


def scan(docs: DataFrame, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """doc_id, n_words, base figures, labels, score, and `spans`: label, errors, first word and the word after the last.

    `score` is the likeness of the best find: 1 less its errors by letters of the notice; 0 without any.
    """

    def rows(batch: list, _) -> dict:
        search = Searcher(notices)
        made: dict[str, list] = {x: [] for x in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
        for text in batch:
            words = text.translate(TABLE).split()
            line = b" %s " % b" ".join(words)
            spans = search.spans(line)
            places = [(notices[i], e, line.count(b" ", 0, a) - 1, line.count(b" ", 0, b)) for i, e, a, b in spans]
            base = [x for x in places if x[0].base and not x[1]]
            made["n_words"].append(len(words))
            made["n_base"].append(len(base))
            made["first_word"].append(min((x[2] for x in base), default=None))
            made["last_word"].append(max((x[2] for x in base), default=None))
            made["base_labels"].append(",".join(sorted({x[0].label for x in base})))
            made["labels"].append(",".join(sorted({x[0].label for x in places})))
            made["score"].append(max((1 - x[1] / len(x[0].words) for x in places), default=0.0))
            made["spans"].append([f"{n.label} {e} {a} {b}" for n, e, a, b in places])
        import pyarrow as pa

        made["first_word"], made["last_word"] = pa.array(made["first_word"], pa.int64()), pa.array(made["last_word"], pa.int64())
        made["spans"] = pa.array(made["spans"], pa.list_(pa.string()))
        return made

    return mapped(
        texts(docs), rows,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>",
    )
