"""Token counts against the library, ranked search and whitening against plain versions."""

from __future__ import annotations

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terravane.llm import queries, search, tokens, whitening

SMALL = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BPE)


def count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


# --- token counts ---------------------------------------------------------------------------

ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n  \t x\r\n y  ",
    "it's we'll I'd they've 'tis ''s",
    "a<|endoftext|>b <|endoftext|><|endoftext|> c <|endof",
    "\x1c\x1d\x85\xa0 　x y ﻿",
    "漢字かな交じり文。 ไทย العربية ½ ٣٤ Ⅷ",
    "new letters \U00010940\U00010941 ՘x ౜1 ࢏ a՘",
    "🙂🙂 👩‍👩‍👧 é ́",
    "x" * 5000 + " " * 3000 + "1" * 3000 + "\n" * 500,
]


def test_tokens_of_odd_texts(spark, monkeypatch):
    rows = [(i, t, "x") for i, t in enumerate(ODD_TEXTS)] + [(1, "", "y"), (None, "two words", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, tokens.count_tokens(docs, BPE, limit=10).collect()), key=str)
    want = [(i, len((t or "").encode()), count(t), count(t) > 10) for i, t, _ in rows]
    assert got == sorted(want, key=str)
    assert tokens.count_tokens(docs.limit(0), BPE).count() == 0


def test_tokens_of_the_table_with_and_without_frequent_words(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = {r["doc_id"]: count(r["text"]) for r in docs.collect()}
    for sample in (0, tokens.SAMPLE):
        got = tokens.count_tokens(docs, BPE, sample=sample).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert {r["doc_id"] for r in got if r["over_limit"]} == {k for k, n in want.items() if n > 1024}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("a1 '\n\t.s<|"))))
def test_tokens_of_any_text(text):
    assert COUNTS(text) == count(text)


COUNTS = tokens.Counts(open(BPE, encoding="utf-8").read(), {"a": 1})


def test_tokens_through_small_pieces_and_a_small_cache(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 7)
    monkeypatch.setattr(tokens, "CACHE", 5)
    counts = tokens.Counts(open(BPE, encoding="utf-8").read(), {" the": 1})
    for text in ODD_TEXTS[1:]:
        assert counts(text * 3) == count(text * 3)
        assert len(counts.words) <= 6


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokens.check_spec(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


# --- ranked search --------------------------------------------------------------------------


def plain_terms(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = (text or "").translate(str.maketrans(upper, upper.lower()))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def plain_search(docs, items, top=10):
    """Every document scored against every item; ``docs`` and ``items`` are pairs of id and text."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    big_n, big_l = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in set(items):
        scores = []
        for doc, c, n in held:
            m = 25 + 75 * n * big_n // big_l
            score = 0
            for t in plain_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores)[:top], 1):
            found.append((item, rank, doc, -score))
    return sorted(found, key=str)


def searched(spark, docs, items, **options):
    docs = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, n string, score int")
    items = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    return sorted(map(tuple, search.search(docs, items, **options).collect()), key=str)


def test_search_of_the_table(spark):
    got = sorted(map(tuple, queries.op12_lexical_search(spark, SMALL).collect()), key=str)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    assert got == plain_search(list(map(tuple, docs)), list(map(tuple, items)))


ITEMS = [(1, "Blue whale whale"), (2, "blue"), (2, "blue"), (2, "green ÄÖ"), (3, None), (4, "..."), (None, "whale"), (5, "unmet")]
DOCS = [(i, "blue whale " + "filler " * (i % 5)) for i in range(40)]
DOCS += [(7, "blue whale"), (None, "blue whale"), (50, None), (51, ""), (52, "- -"), (53, "Äö ÄÖ green_green"), (54, "x " * 9000 + "WHALE")]


def test_search_of_odd_rows_and_ties(spark):
    want = plain_search(DOCS, ITEMS)
    assert searched(spark, DOCS, ITEMS) == want and len(want) > 30
    assert searched(spark, DOCS, ITEMS, top=3) == plain_search(DOCS, ITEMS, 3)
    assert searched(spark, DOCS[:0], ITEMS) == searched(spark, DOCS, ITEMS[:0]) == []
    assert searched(spark, [(1, None), (2, "!")], ITEMS) == []


def test_search_in_small_blocks_and_pieces(spark, monkeypatch):
    assert search.item_blocks(spark.createDataFrame(ITEMS, "item_id long, text string"), 20).select("block").distinct().count() > 2
    blocks = search.item_blocks
    monkeypatch.setattr(search, "item_blocks", lambda items: blocks(items, 20))
    monkeypatch.setattr(search, "CELLS", 7)
    monkeypatch.setattr(search, "PIECE", 5)
    assert searched(spark, DOCS, ITEMS) == plain_search(DOCS, ITEMS)


# --- whitening ------------------------------------------------------------------------------


def plain_whitening(vectors, components=8):
    """Whitened values by doubles, and deviations by Python's integers."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return deviation, centred @ axes / np.sqrt(values), values / np.trace(covariance)


def whitened(spark, vectors, **options):
    rows = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, n string")
    return whitening.whiten(rows, **options).collect()


def compare_whitening(rows, vectors, components=8):
    deviation, values, explained = plain_whitening([v for _, v in vectors], components)
    width = values.shape[1]
    assert len(rows) == len(vectors) * width
    by_id = {(r["vec_id"], r["component"]): r for r in rows}
    for k in range(width):
        got = np.array([by_id[i, k + 1]["whitened"] for i, _ in vectors])
        sign = np.sign(got @ values[:, k])
        assert np.abs(got * sign - values[:, k]).max() < 1e-8
        assert all(math.isclose(by_id[i, k + 1]["explained"], explained[k], rel_tol=1e-9) for i, _ in vectors)
    for (i, _), d in zip(vectors, deviation, strict=True):
        assert by_id[i, 1]["deviation"] == (d if d < 1 << 63 else None)
    assert {r["n"] for r in rows} == {len(vectors)}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_whitening_of_the_table(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare_whitening(queries.op13_whitening(spark, SMALL).collect(), list(map(tuple, vectors)))


def test_whitening_of_wide_ranges_and_few_entries(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 100)
    rng = np.random.default_rng(1)
    small = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * (1, 1000, 0.01)]) for i in range(333)]
    compare_whitening(whitened(spark, small), small)
    large = [(i, [float(np.float32(c)) for c in rng.normal(size=2) * (3e9, 1e10)]) for i in range(70)]
    compare_whitening(whitened(spark, large), large)


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=12)]) for i in range(80)]
    bad = [(100, None), (101, []), (102, [None] * 12), (103, [math.nan] + [0.0] * 11), (104, [math.inf] * 12), (105, [1.0])]
    compare_whitening(whitened(spark, good + bad), good)
    rows = whitened(spark, good[:1] * 3 + [(None, good[0][1])])
    assert len(rows) == 32 and {(r["deviation"], r["whitened"], r["explained"]) for r in rows} == {(0, None, None)}
    # Rank 1: one component is real, the others have nothing to be divided by.
    rows = whitened(spark, [(i, [float(i)] * 4) for i in range(10)])
    assert {r["component"] for r in rows if r["whitened"] is None} == {2, 3, 4}
    assert rows[0]["identity_error"] < 1e-9
    assert whitened(spark, bad[:5]) == whitened(spark, []) == []
    assert len(whitened(spark, [(1, [1e38, -1e38]), (2, [0.0, 1.0]), (3, [-3e38, 3e38])])) == 6
