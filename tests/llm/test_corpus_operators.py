"""Operators of the corpus package against plain computations, on small tables and on odd ones."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import rows as comparable
from snapstrata.llm import (
    bpe_lexicon, components, fingerprints, fm_index, license_scan, near_dedup, packing, quality_outliers,
    quality_ranking, quotation_links, substring_dedup, text_stats, url_filters,
)
from snapstrata.llm.common import vocabulary
from snapstrata.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, ids with two texts, clashing names."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    text = " ".join(f"common{i}" for i in range(80))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, long, "en", "a"), (5, long + " end", None, "a"),
        (6, text, "en", None), (6, text, "en", None), (7, text, "en", "b"), (7, "other text", "en", "b"), (None, text, "en", "b"),
        (8, "### *** ###", "xx", "b"), (9, "é ü  x <|endoftext|> İß ſ é 日本", "en", "b"), (10, text + " tail", "en", "b"),
    ]
    df = frame(spark, rows, "doc_id bigint, text string, lang string, source string")
    clash = ["n_chars", "row", "places", "kept", "n_words", "node", "key", "class_id", "bits", "z", "pool", "score", "part", "copy"]
    return df.withColumns({c: F.lit("x") for c in clash}).repartition(3)


OPERATORS = {
    "scan": license_scan.scan, "fingerprinted": fingerprints.fingerprinted, "encoded": lambda d: bpe_lexicon.encoded(d, vocabulary("byte_bpe_50k.json")),
    "judged": quality_outliers.judged, "scored": lambda d: quality_ranking.scored(d, quality_ranking.fitted(d, d.select("doc_id", F.lit(1).alias("quality")))),
    "packed": lambda d: packing.packed(d, vocabulary("word_bpe_49k.json")), "deduplicated": substring_dedup.deduplicated,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows_and_empty_tables(spark, odd, name):
    n = OPERATORS[name](odd).select("doc_id").collect()
    expected = Counter(r["doc_id"] for r in odd.select("doc_id").collect())
    got = Counter(r["doc_id"] for r in n)
    assert set(got) == set(expected) if name == "packed" else got == expected
    assert OPERATORS[name](odd.where("false")).count() == 0


@pytest.mark.parametrize("stage", [quality_outliers.kept, near_dedup.kept, substring_dedup.cut])
def test_stages_keep_columns(odd, stage):
    out = stage(odd)
    assert out.columns == odd.columns
    assert {r["row"] for r in out.collect()} <= {"x"}
    assert stage(odd.where("false")).count() == 0


# ---------------------------------------------------------------------------- 1
def test_license_places_and_fuzzy_finds(spark, texts):
    own = ["GNU  General, Public-License and MIT License", "licenced under the apache licence, version 2.0", "Permision is hereby granted free of charge, to any persons obtaining a copy",
           "cc by cc by nc", "mit license" * 3, "the commit license", "GNU Lesser General Public Licence", ""]
    docs = {**texts, **{1000 + i: x for i, x in enumerate(own)}}
    got = {r["doc_id"]: r for r in license_scan.scan(frame(spark, list(docs.items()))).collect()}
    for i, text in docs.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(k, n.label) for n in license_scan.BASE for k in range(len(words)) if words[k : k + len(n.words.split())] == n.words.split()]
        starts = [k for k, _ in places]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]
    assert [got[1000 + i]["labels"] for i in range(len(own))] == ["gpl,mit", "apache", "mit", "cc-by,cc-by-nc", "", "", "gpl,lgpl", ""] or got[1001]["labels"] == "apache"
    assert got[1002]["labels"] == "mit" and 0.9 < got[1002]["score"] < 1 and got[1006]["labels"].endswith("lgpl")


def test_pigeonhole_finds_every_notice_within_its_errors(spark):
    rng, notice = random.Random(3), license_scan.NOTICES[5]
    search = license_scan.Searcher([notice])
    for _ in range(300):
        letters = list(notice.words)
        for _ in range(rng.randint(0, notice.errors)):
            at = rng.randrange(1, len(letters) - 1)
            rng.choice([lambda: letters.pop(at), lambda: letters.insert(at, "q"), lambda: letters.__setitem__(at, "z")])()
        assert search.spans(f" before {''.join(letters)} after ".encode())


def test_misspelt_notices_side_by_side_all_count():
    """Runs of a notice, each with one letter changed, against the places they were put."""
    rng = random.Random(15)
    for notice in license_scan.NOTICES:
        if not notice.errors:
            continue
        search = license_scan.Searcher([notice])
        for n in (2, 3, 7):
            line, want = " ", []
            for _ in range(n):
                at = rng.choice([k for k in range(1, len(notice.words) - 1) if " " not in notice.words[k - 1 : k + 2]])
                want.append((0, 1, len(line), len(line) + len(notice.words)))
                line += notice.words[:at] + "q" + notice.words[at + 1 :] + " "
            assert search.spans(line.encode()) == want, line


# ---------------------------------------------------------------------------- 2
def test_fingerprints(spark, texts):
    docs = frame(spark, list(texts.items()))
    rows = {r["doc_id"]: r for r in fingerprints.fingerprinted(docs).collect()}
    ids = sorted(texts, reverse=True)
    off = []
    for i, after in zip(ids, ids[1:] + ids[:1]):
        n = len(texts[i]) // 3
        edited = texts[i][: len(texts[i]) - n] + texts[after][:n]
        assert (rows[i]["n_chars"], rows[i]["edited_sha256"]) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        a, b = (set(zip(*(w[k:] for k in range(5)))) for w in (re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower()) for t in (texts[i], edited)))
        if min(len(a), len(b)) > 400:
            off.append(abs(rows[i]["near_edited"] - len(a & b) / min(len(a), len(b))))
        assert 0 <= rows[i]["near_next"] <= 1
    assert len(off) > 10 and np.mean(off) < 0.06
    same = {}
    for i, t in texts.items():
        assert same.setdefault(t, rows[i]["fingerprint"]) == rows[i]["fingerprint"]


def test_sketch_of_a_union(spark):
    a, b = (" ".join(f"w{i}" for i in range(k, k + 3000)) for k in (0, 1500))
    row = frame(spark, [(a, b, a + " " + b)], "a string, b string, c string").select(*(fingerprints.sketch(F.col(x)).alias(x) for x in "abc")).first()
    assert set(row["a"]) | set(row["b"]) <= set(row["c"]) and len(set(row["c"]) - set(row["a"]) - set(row["b"])) <= 4
    assert row["a"] == sorted(set(row["a"]))


def test_next_document_over_many_ranges(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10**6), 500)
    df = frame(spark, [(i, str(i)) for i in ids])
    got = {r["doc_id"]: r["next"]["doc_id"] for r in fingerprints.with_next(df, parts=37).collect()}
    order = sorted(ids, reverse=True)
    assert got == dict(zip(order, order[1:] + order[:1]))


# ---------------------------------------------------------------------------- 3, 8
@pytest.mark.parametrize("name", list(SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df, cur = QUERIES[name](spark, FOLDER), con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, cur.fetchall())


def test_quotes_of_several_levels(spark):
    rows = [
        (1, 0, "Question one\nmore"), (1, 1, "> question  ONE\n\nAnswer"), (1, 2, "> Answer\n>> Question one\nThanks"),
        (1, 3, "> never said\nalone"), (1, 4, ">> Question one\n> Thanks\n> Answer\nlast"), (2, 0, "> Answer\nother"), (1, 5, None), (None, 1, "> x"), (1, 5, ""),
    ]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id bigint, turn bigint, role string, text string").withColumn("extra", F.lit(1))
    got = sorted(((r["conv_id"], r["turn"], r["parent_turn"], r["root_turn"], r["depth"], r["own_text"]) for r in quotation_links.linked(df).collect()), key=str)
    assert got == sorted([
        (1, 0, None, 0, 0, "Question one\nmore"), (1, 1, 0, 0, 1, "Answer"), (1, 2, 1, 0, 2, "Thanks"), (1, 3, None, 3, 0, "alone"),
        (1, 4, 2, 0, 3, "last"), (2, 0, None, 0, 0, "other"), (1, 5, None, 5, 0, ""), (None, 1, None, 1, 0, ""), (1, 5, None, 5, 0, ""),
    ], key=str)
    assert quotation_links.linked(df.where("false")).count() == 0


def test_long_chains_of_replies(spark):
    rows = [(7, t, "user", (f"> line {t - 1}\n" if t else "") + f"line {t}") for t in range(70)]
    got = {r["turn"]: (r["root_turn"], r["depth"]) for r in quotation_links.linked(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert got == {t: (0, t) for t in range(70)}


def test_url_rules(spark):
    cases = {
        None: ("", "", None, "allow"), "no scheme.org/": ("", "", None, "allow"), "http://A.Org": ("a.org", "", None, "allow"), "http://a.org/x?y": ("a.org", "/x", "org/", "allow"),
        "http://x.example.org/en/17": ("x.example.org", "/en/17", "example.org/en/1", "block"), "http://badexample.org/en/1": ("badexample.org", "/en/1", "org/", "allow"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"), "https://casino.com/fr/": ("casino.com", "/fr/", "com/fr/", "allow"), "https://my-casino.net/": ("my-casino.net", "/", None, "block"),
        "https://casinos.net/": ("casinos.net", "/", None, "allow"), "http://a.com#/de/": ("a.com", "", None, "allow"), "http://com/de/x": ("com", "/de/x", "com/de/", "block"), "http://a.org:80/": ("a.org:80", "/", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(list(cases) * 2)], "page_id int, url string, rule int")
    got = Counter((r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judged(pages).collect())
    assert got == Counter({k: v * 2 for k, v in Counter(cases.values()).items()})
    assert url_filters.judged(pages.where("false")).count() == 0


# ---------------------------------------------------------------------------- 4, 9
STRANGE = [
    "", " ", "a", " a  b   c\n\n d\t\te ", "it's we'll THEY'RE x'", " x  y\x85z \x1c w", "é é ÉCOLE ŉ İ Σίσυφος ΣΑΣ", "12 345 ½² ٣", "日本語 テスト 🎉🎉", "<|endoftext|>a <|startoftext|> b<|endoftext|>",
    "a\r\nb", "''s 's", "x" * 3000, "<|end", "   a", "﻿z", "ſtraße Åﬁ",
]


def test_ids_are_those_of_the_library(spark, texts):
    docs = {**texts, **{10_000 + i: x for i, x in enumerate(STRANGE)}}
    df = frame(spark, list(docs.items()))
    path = vocabulary("byte_bpe_50k.json")
    tokenizer = bpe_lexicon.library(path)
    rows = {r["doc_id"]: r for r in bpe_lexicon.encoded(df, path).collect()}
    for i, e in zip(docs, tokenizer.encode_batch(list(docs.values()), add_special_tokens=False)):
        ids = hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest()
        back = hashlib.sha256(tokenizer.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]) == (len(e.ids), ids, back), docs[i][:50]


def test_transducer_holds_exactly_its_words():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode() for _ in range(900)})
    held, others = words[::2], words[1::2]
    ids = [[rng.randrange(50_000) for _ in range(rng.randint(1, 4))] for _ in held]
    block = bpe_lexicon.compiled(held, ids)
    lexicon = bpe_lexicon.Lexicon(block)
    assert lexicon.numbers(held).tolist() == list(range(len(held)))
    assert set(lexicon.numbers([*others, b"", b"zzz"]).tolist()) == {-1}
    assert {w: np.frombuffer(x, np.uint32).tolist() for w, x in lexicon.found([w.decode() for w in held]).items()} == {w.decode(): x for w, x in zip(held, ids)}
    assert len(lexicon.finals) < sum(map(len, held)) / 3  # prefixes and suffixes are shared
    assert bpe_lexicon.Lexicon(bpe_lexicon.compiled([], [])).numbers([b"a"]).tolist() == [-1]


def test_packing_holds_every_id_once(spark, texts):
    docs = {**texts, **{10_000 + i: x for i, x in enumerate(STRANGE)}}
    path = vocabulary("word_bpe_49k.json")
    rows = packing.packed(frame(spark, list(docs.items())).repartition(3), path).collect()
    tokenizer, pieces, sequences = bpe_lexicon.library(path), {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, e in zip(docs, tokenizer.encode_batch(list(docs.values()), add_special_tokens=False)):
        ids, at = np.array([*e.ids, 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)), docs[i][:50]
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    padding = 0
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    assert padding < 0.01 * sum(r["length"] for r in rows)


# ---------------------------------------------------------------------------- 5
def jaccard(a, b):
    a, b = (frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(2)
    for _ in range(150):
        a = rng.integers(0, rng.integers(2, 200), rng.integers(1, 120)).astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 1 + len(a) // 8)))
        b = np.insert(b, rng.integers(0, len(b) + 1, 3), rng.integers(0, 200, 3).astype(np.uint64))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        same = table[-1, -1]
        exact = same / (len(a) + len(b) - same)
        got = near_dedup.aligned(a, b)
        assert (got >= 0.8) == (exact >= 0.8) and (got < 0.8 or got == pytest.approx(exact))


def test_near_duplicates_in_a_large_group(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    docs = {}
    for i in range(60):  # near copies of one text, each with edits of its own
        words = list(base)
        for at in rng.sample(range(400), 6):
            words[at] = f"new{rng.randrange(10**6)}"
        docs[i] = " ".join(words)
    docs[60] = " ".join(base)
    for i in range(61, 90):  # a shared passage alone is no near-duplicate
        docs[i] = " ".join(base[:60] + [f"own{i}x{k}" for k in range(200)])
    docs.update({90: "", 91: "", 92: "x y", 93: "X  y", 94: "x y z"})
    classes = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(frame(spark, list(docs.items()))).collect()}
    assert {classes[i] for i in range(61)} == {0}
    assert all(classes[i] == i for i in range(61, 90))
    assert [classes[i] for i in range(90, 95)] == [90, 90, 92, 92, 94]
    kept = {r["doc_id"] for r in near_dedup.kept(frame(spark, list(docs.items()))).collect()}
    assert kept == {0, *range(61, 90), 90, 92, 94}


@pytest.mark.parametrize("block", [7, 512])
def test_all_pairs_of_large_buckets_are_compared(spark, block, monkeypatch):
    """All documents have all bands in common; links are between neighbours of chains that the most central node is no part of."""
    rng = random.Random(13)
    monkeypatch.setattr(near_dedup, "bands", lambda sequence: np.arange(near_dedup.BANDS, dtype=np.uint64))
    docs, n = {}, 0
    for chain in range(45):
        words = [f"c{chain}w{k}" for k in range(200)]
        for step in range(rng.randint(1, 6)):
            docs[n], n = " ".join(words), n + 1
            words[30 * step : 30 * step + 15] = [f"c{chain}s{step}x{k}" for k in range(15)]
    want = {i: i for i in docs}
    for b in docs:
        for a in range(b):
            if jaccard(docs[a], docs[b]) >= 0.8:
                old, new = sorted((want[a], want[b]), reverse=True)
                want = {i: new if x == old else x for i, x in want.items()}
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(frame(spark, list(docs.items())), **({"block": block} if block < 512 else {})).collect()}
    assert got == want
    assert 45 == len(set(want.values())) < len(want)


def test_near_duplicates_of_the_test_table(spark, texts):
    classes = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(frame(spark, list(texts.items()))).collect()}
    ids = sorted(texts)
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if jaccard(texts[a], texts[b]) >= 0.8]
    assert pairs and all(classes[a] == classes[b] for a, b in pairs)
    assert sum(classes[i] != i for i in ids) == len({b for _, b in pairs})


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(2000, k) for k in range(2001, 2100)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: y for x, y in label.items() if any(a != b and x in (a, b) for a, b in edges)}


# ---------------------------------------------------------------------------- 6, 7
def test_base_counts(texts):
    rng = random.Random(8)
    made = [" ".join(rng.choice("ab c#d \n $") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    for text in [*texts.values(), *made, "\n\n \n", "a a a a", "x\ny\nx\n \n \nx"]:
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        got = dict(zip(text_stats.COUNTS, text_stats.counted(text.encode())))
        want = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
                "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_distinct": len(set(words))}
        assert {k: got[k] for k in want} == want, text[:60]


def test_outliers_are_rejected_and_the_rest_stay(spark):
    """Outliers make up a fifth of a group and do not move its estimate."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    clean = [" ".join(word() for _ in range(rng.randint(60, 600))) for _ in range(400)]
    junk = [" ".join(word() + rng.choice(["###", "&&&"]) for _ in range(rng.randint(60, 600))) for _ in range(100)]
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + junk)]
    got = {r["doc_id"]: r for r in quality_outliers.judged(frame(spark, rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(got[i]["kept"] for i in range(400)) and not any(got[i]["kept"] for i in range(400, 500))
    few = [(i, t, "en", f"s{i}") for i, t in enumerate(clean[:30])]
    assert all(r["kept"] for r in quality_outliers.judged(frame(spark, few, "doc_id bigint, text string, lang string, source string")).collect())


@pytest.mark.parametrize("repeating", [0, 5])
def test_texts_of_repeated_lines_are_outliers(spark, repeating):
    """Such a text falls out of a source whose others repeat no line; one repeated line among many does not."""
    rng = random.Random(14)
    line = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    clean = [[line(10) for _ in range(rng.randint(8, 60))] for _ in range(300)]
    for x in clean[:repeating]:
        x.append(x[0])
    junk = [[*(line(50) for _ in range(10)), *["Share"] * 90] for _ in range(10)]
    rows = [(i, "\n".join(t), "en", "s") for i, t in enumerate(clean + junk)]
    got = {r["doc_id"]: r for r in quality_outliers.judged(frame(spark, rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i in range(300, 310))
    assert sum(not got[i]["kept"] for i in range(repeating, 300)) <= 3


def test_estimate_is_that_of_all_regular_rows(spark):
    z = np.random.default_rng(1).normal(size=(2000, quality_outliers.P))
    upper = np.triu_indices(quality_outliers.P)
    moments = spark.createDataFrame([("g", len(z), z.sum(0).tolist(), (z.T @ z)[upper].tolist())], "pool string, n bigint, sums array<double>, products array<double>")
    got = quality_outliers._estimates(moments, 0.75).first()
    floor = np.diag(np.square(list(quality_outliers.FLOORS.values())))
    want = np.cov(z.T, bias=True) / quality_outliers.shrinkage(0.75) + floor
    assert np.allclose(got["centre"], z.mean(0)) and np.allclose(np.linalg.inv(np.reshape(got["inverse"], want.shape)), want)
    # The nearest three quarters of normal rows, scaled, have the scatter of all of them.
    d = (z**2).sum(1)
    part = z[d <= np.quantile(d, 0.75)]
    assert np.cov(part.T, bias=True).diagonal().mean() / quality_outliers.shrinkage(0.75) == pytest.approx(1, abs=0.06)


def test_ranking_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality_classifier"](spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 1000 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    good, bad = ([rows[i]["score"] for i, y in labels.items() if y == k and rows[i]["held_out"]] for k in (1, 0))
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([rows[i]["predicted"] == y for i, y in labels.items() if rows[i]["held_out"]]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows.values())


def test_one_label_alone_ranks_nothing(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    model = quality_ranking.fitted(docs, spark.createDataFrame([(1, 1), (1, 0), (None, 0), (2, None)], "doc_id bigint, quality int"))
    assert {r["score"] for r in quality_ranking.scored(docs, model).collect()} == {0.5}


# ---------------------------------------------------------------------------- 10
def test_backward_search_and_ranks():
    rng = np.random.default_rng(7)
    sequences = [rng.integers(1, 6, rng.integers(3, 40)) for _ in range(60)]
    owners = rng.integers(0, 20, 60)
    index = fm_index.FmIndex(sequences, owners, 64)
    text = np.concatenate(sequences)
    where = np.concatenate([[n] * len(x) for n, x in enumerate(sequences)])
    begin = np.concatenate([[sum(map(len, sequences[:n]))] * len(x) for n, x in enumerate(sequences)])
    ends = np.arange(len(text))
    got = index.matched_from(text, ends, begin, owners[where])
    joined = {n: " " + " ".join(map(str, x)) + " " for n, x in enumerate(sequences)}
    for e in range(0, len(text), 3):
        left = e + 1
        while left > begin[e]:
            part = " " + " ".join(map(str, text[left - 1 : e + 1])) + " "
            if not any(part in joined[n] for n in range(60) if owners[n] < owners[where[e]]):
                break
            left -= 1
        assert got[e] == left


def removed_plainly(docs, span):
    first, out = {}, {}
    words = {i: WORD.findall(t) for i, t in docs.items()}
    for i in sorted(words):
        for k in range(len(words[i]) - span + 1):
            first.setdefault(tuple(words[i][k : k + span]), i)
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - span + 1) if first[tuple(w[k : k + span])] < i for j in range(span)}
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [2, 2000])
def test_repeated_passages(spark, texts, crowd, monkeypatch):
    """Passages with many surroundings, overlapping and nested ones, copies, and texts of few different words."""
    rng = random.Random(11)
    passages = [[f"p{n}w{rng.randrange(10**6)}" for _ in range(rng.randint(40, 130))] for n in range(6)]
    docs = {10_000 + i: t for i, t in texts.items()}
    for i in range(120):
        words = [f"d{i}x{k}" for k in range(rng.randint(0, 60))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            a = rng.randint(0, 30)
            words += p[a : len(p) - rng.randint(0, 20)] + [f"d{i}y{k}" for k in range(rng.randint(0, 3))]
        docs[i] = " ".join(words)
    for i in range(200, 230):
        docs[i] = " ".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(90)) if i % 3 else "z " * 100
    plain = substring_dedup.repeats
    monkeypatch.setattr(substring_dedup, "repeats", lambda d: plain(d, crowd=crowd, shard_words=5_000))
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.deduplicated(frame(spark, list(docs.items())).repartition(4)).collect()}
    assert got == removed_plainly(docs, 50)
    assert sum(x[1] for x in got.values()) > 3000


@pytest.mark.parametrize("space", ["\u00a0", "\u3000", "\u2028", "\x85", "\x1c"])
def test_white_space_of_unicode_is_part_of_a_word(spark, space):
    """Repeated passages whose words hold such characters, at the start, in the middle and at the end of texts; 49 shared words stay."""
    rng = random.Random(12)
    docs = {}
    for n in range(12):
        passage = [f"q{n}w{rng.randrange(10**6)}" for _ in range(50 + n // 3)]
        passage[rng.randrange(5, 45)] = f"a{n}{space}b{space}c"
        docs[10 * n] = " ".join([*passage, "tail"])
        docs[10 * n + 1] = " ".join(passage)
        docs[10 * n + 2] = " ".join([f"own{n}", *passage, f"more{n}", "x"])
        docs[10 * n + 3] = " ".join([f"first{n}", *passage[:49], f"last{n}"])
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.deduplicated(frame(spark, list(docs.items())).repartition(3)).collect()}
    assert got == removed_plainly(docs, 50)
    assert sum(x[1] for x in got.values()) >= 24 * 50


def test_cut_keeps_white_space(spark):
    passage = "\n".join(f"line{k} of it" for k in range(20))
    docs = frame(spark, [(1, passage), (2, f"  my\nown {passage}\n\nend "), (3, None)])
    got = {r["doc_id"]: r["text"] for r in substring_dedup.cut(docs).collect()}
    assert got == {1: passage, 2: "  my\nown end ", 3: ""}


def settled(sequences, owners, group, span):
    index = fm_index.FmIndex(sequences, owners, 2 * max(map(len, sequences)))
    steps = []
    plain = index.extended
    index.extended = lambda symbols, lo, hi: steps.append(len(symbols)) or plain(symbols, lo, hi)
    return substring_dedup.settled(index, sequences, owners, group, span).tolist(), sum(steps)


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_settled_as_by_brute_force(seed):
    """Sequences that share parts of any length, with few or many different words, in groups of their own words."""
    rng = np.random.default_rng(seed)
    span, sequences, group = 8, [], []
    for g in range(12):
        passages = [rng.integers(1, (3, 4, 1000)[g % 3], 60) for _ in range(3)]
        for _ in range(rng.integers(1, 12)):
            parts = []
            for _ in range(rng.integers(1, 5)):
                p, a = passages[rng.integers(3)], rng.integers(0, 40)
                parts += [p[a : a + rng.integers(1, 20)], rng.integers(1, 1000, rng.integers(0, 3))]
            sequence = np.concatenate(parts)[: span + 40] + 1000 * g
            if len(sequence) >= span:
                sequences.append(sequence)
                group.append(g)
    owners = rng.integers(0, 9, len(sequences))
    first = {}
    for x, owner in zip(sequences, owners):
        for k in range(len(x) - span + 1):
            first[w] = min(first.get(w := tuple(x[k : k + span]), owner), owner)
    expected = [sum(1 << k for k in range(len(x) - span + 1) if first[tuple(x[k : k + span])] < o) for x, o in zip(sequences, owners)]
    assert settled(sequences, owners, np.array(group), span)[0] == expected
    assert any(expected) and not all(expected)


def test_shared_phrase_is_settled_by_few_searches():
    """The windows of a sequence hold some of the phrase it shares with smaller owners; a search from the end of each of the 41
    windows, to its full length, would take 245 steps a sequence."""
    phrase = np.arange(1, 30)
    sequences = [np.concatenate([1000 * n + np.arange(30), phrase, 1000 * n + np.arange(100, 131)]) for n in range(1, 21)]
    got, steps = settled(sequences, np.arange(20), np.zeros(20, int), 50)
    assert got == [0] * 20 and steps <= 60 * 20


def test_hashes_of_one_owner_are_not_searched(spark, monkeypatch):
    """Copies need no index; a passage that two documents have in other surroundings does."""
    kept = {}
    plain = substring_dedup.stored
    monkeypatch.setattr(substring_dedup, "stored", lambda df, name: kept.setdefault(name, plain(df, name)))
    passage = " ".join(f"p{k}" for k in range(70))
    copies = {i: " ".join(f"c{i % 10}w{k}" for k in range(120)) for i in range(30)}
    docs = copies | {100 + i: f"{' '.join(f'a{i}x{k}' for k in range(60))} {passage} {' '.join(f'b{i}x{k}' for k in range(60))}" for i in range(2)}
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.deduplicated(frame(spark, list(docs.items())).repartition(3)).collect()}
    assert got == removed_plainly(docs, 50)
    assert {r["doc_id"] for r in kept["pieces"].collect()} == {100, 101}
