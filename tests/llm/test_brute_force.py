"""Language filters against exact sets of n-grams, densities against a plain recursive walk."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from xml.etree import ElementTree

import numpy as np
import pytest

from terravane.llm import extract, language

MIXED = "/root/testdata/sf0.01"


# --- language -------------------------------------------------------------------------------


def plain_grams(text):
    """All 3- to 5-grams of the words of a text, lower-cased, with one gap around each word."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    joined = f" {' '.join(letters.split())} "
    return [joined[i : i + n] for n in (3, 4, 5) for i in range(len(joined) - n + 1)] if letters.split() else []


@pytest.fixture(scope="module")
def labelled(spark):
    return [(r["lang"], r["text"]) for r in spark.read.parquet(f"{MIXED}/documents.parquet").collect()]


def hashes_of(gram):
    return language.gram_hashes([gram], LETTERS)[0]


LETTERS = language._letters()


@pytest.mark.parametrize(
    "text", ["", "12 !!", "a", "Ab", "It's 5 o'clock.", "  ÉTÉ\n\tà la mer ", "x1y22zzz", "漢字かな", "don’t—stop"]
)
def test_grams_are_those_of_the_plain_text(text):
    want = plain_grams(text)
    hashes, owners = language.gram_hashes([text, "other words here"], LETTERS)
    assert (owners == 0).sum() == len(want)
    assert sorted(Counter(hashes[owners == 0].tolist()).values()) == sorted(Counter(want).values())


def test_filters_against_exact_sets(labelled):
    counts = defaultdict(Counter)
    for lang, text in labelled[:400]:
        if lang:
            counts[lang].update(plain_grams(text))
    exact = {lang: {g for g, _ in c.most_common(3000)} for lang, c in counts.items()}
    by_hash = {}
    for lang, text in labelled[:400]:
        joined = f" {' '.join(''.join(c if c.isalpha() else ' ' for c in (text or '').lower()).split())} "
        by_hash.update(zip(plain_grams(text), language.gram_hashes([joined], LETTERS)[0].tolist(), strict=False))
    filters = language.Filters.build({l: np.array(sorted(by_hash[g] for g in s), np.uint64) for l, s in exact.items()})
    texts = [t for _, t in labelled[400:700]]
    share, total = filters.share(texts, LETTERS)
    agree = checked = 0
    for i, text in enumerate(texts):
        grams = plain_grams(text)
        assert total[i] == len(grams)
        if not grams:
            continue
        want = [sum(g in exact[l] for g in grams) / len(grams) for l in filters.languages]
        # The correction takes off what chance adds; with few n-grams chance varies more.
        assert np.abs(share[i] - want).max() < 0.02 + 1 / math.sqrt(len(grams)) / 2
        if sorted(want)[-1] - sorted(want)[-2] > 0.05:
            checked += 1
            agree += int(np.argmax(want)) == int(share[i].argmax())
    assert checked > 200 and agree == checked


def test_documents_counted_by_language_fit(spark, labelled):
    docs = spark.createDataFrame([(i, t, l) for i, (l, t) in enumerate(labelled)], "doc_id long, text string, lang string")
    filters = language.fit(docs)
    assert filters.languages == sorted({l for l, _ in labelled if l})
    assert filters.table.any(axis=1).mean() < 0.5


# --- pages ----------------------------------------------------------------------------------


def plain_density(node, body):
    """Composite text density of an element by its definition, without memory of other elements."""

    def chars(e):
        return len("".join("".join(e.itertext()).split()))

    def links(e):
        return chars(e) if e.tag == "a" else sum(links(c) for c in e)

    def tags(e):
        return sum(1 + tags(c) for c in e)

    def link_tags(e):
        return tags(e) + 1 if e.tag == "a" else sum(link_tags(c) for c in e)

    c, t, lc, lt = chars(node), max(tags(node), 1), links(node), link_tags(node)
    linked = links(body) / max(chars(body), 1)
    ratio = c / max(lc, 1) * t / max(lt, 1)
    if ratio <= 1:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + linked * c + math.e)
    return c / t * (math.log(ratio) if base <= 1 + 1e-12 else math.log(ratio) / math.log(base))


def random_tree(rng, depth=0):
    name = str(rng.choice(["div", "section", "span", "b", "a"] if depth else ["div"]))
    element = ElementTree.Element(name)
    element.text = "word " * int(rng.integers(0, 30))
    for _ in range(int(rng.integers(0, 4)) if depth < 5 and name != "a" else 0):
        child = random_tree(rng, depth + 1)
        child.tail = "tail " * int(rng.integers(0, 6))
        element.append(child)
    return element


@pytest.mark.parametrize("seed", range(30))
def test_densities_against_a_plain_walk(seed):
    body = ElementTree.Element("body")
    rng = np.random.default_rng(seed)
    body.extend([random_tree(rng) for _ in range(3)])
    builder = extract.Builder()
    builder.feed(ElementTree.tostring(body, encoding="unicode", short_empty_elements=False))
    nodes = extract._order(builder.root)
    extract._measure(nodes)
    plain = [body]
    for element in plain:
        plain += list(element)
    assert [n.name for n in nodes] == [e.tag for e in plain]
    want = [plain_density(e, body) for e in plain]
    assert np.allclose([n.density for n in nodes], want)
    best = max(range(len(plain)), key=lambda i: nodes[i].total)
    sums = [
        sum(plain_density(c, body) for c in e)
        + len("".join((e.text or "").split()))
        + sum(len("".join((c.tail or "").split())) for c in e)
        for e in plain
    ]
    assert math.isclose(sums[best], max(sums))
