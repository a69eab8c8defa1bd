"""The pipeline stage by stage, and queries against their SQL."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from compare import difference
from test_operators import groups

import corpus_pipeline
from terravane.llm import copies, decontaminate, queries

SMALL = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        assert docs.count() > 0.5 * before.count(), name
    bench = [decontaminate.squeeze(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = docs.collect()
    assert not any(item in decontaminate.squeeze(r["text"]) for r in rows for item in bench)
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
    shards = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(r["doc_id"] for r in shards) == Counter(r["doc_id"] for r in rows)


#: Rows that each stage leaves of the odd documents: those without a letter go first, of the four
#: copies of one text the first stays, and the mix takes no source more than three times.
ODD = {
    "language": [1, 1, 2, 6, 6, 8, None],
    "near copies": [1, 6, 6, 8],
    "benchmark": [1, 6, 6, 8],
}


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs, some in ((odd_docs, True), (no_docs, False)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            ids = sorted((r["doc_id"] for r in docs.collect()), key=lambda i: (i is None, i))
            assert ids == (ODD.get(name, ids) if some else [])
        if some:
            assert set(ids) == {1, 6, 8} and max(Counter(ids).values()) <= 6
        shards = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
        assert Counter(r["doc_id"] for r in shards) == Counter(ids)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, sf_dir, name):
    assert difference(spark, queries.QUERIES[name], queries.SQL[name], sf_dir) is None


def plain_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_first_of_copies(docs):
    """Ids that stay when all pairs are compared by their sets of 5-word shingles."""
    sets = {k: plain_shingles(t) for k, t in docs.items()}
    owners, common = defaultdict(list), Counter()
    for k in sorted(sets):
        for s in sets[k]:
            common.update((k, other) for other in owners[s])
            owners[s].append(k)
    ids = sorted(sets)
    near = [(ids.index(a), ids.index(b)) for (a, b), n in common.items() if 9 * n >= 4 * (len(sets[a]) + len(sets[b]))]
    blank = [i for i, k in enumerate(ids) if not sets[k]]
    root = groups(len(ids), near + [(blank[0], i) for i in blank[1:]])
    return [k for i, k in enumerate(ids) if root[i] == i]


def edited(rng, words, share):
    return [f"w{rng.integers(10**6)}" if rng.random() < share else w for w in words]


def test_near_copies_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    seeds = [[f"w{rng.integers(10**6)}" for _ in range(n)] for n in (60, 200, 900) for _ in range(8)]
    for words in seeds:
        docs[len(docs) + 10_000] = " ".join(words)
        for share in (0.01, 0.02, 0.025, 0.03, 0.04, 0.06):
            docs[len(docs) + 10_000] = " ".join(edited(rng, words, share))
    docs[90_000], docs[90_001] = None, "Five  words of a\ntext"
    docs[90_002] = "five words of a text"
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    kept = corpus_pipeline.keep_first_of_near_copies(spark, rows, SMALL)
    assert sorted(r["doc_id"] for r in kept.collect()) == plain_first_of_copies(docs)


@pytest.mark.parametrize("limits", [(8, 1 << 21), (1024, 900)])
def test_near_copies_in_chains_through_small_leaves(spark, monkeypatch, limits):
    monkeypatch.setattr(copies, "LEAF", limits[0])
    monkeypatch.setattr(copies, "HEAVIEST", limits[1])
    rng = np.random.default_rng(9)
    docs, words = {}, [f"w{rng.integers(10**6)}" for _ in range(300)]
    for i in range(60):
        docs[i] = " ".join(words)
        words = edited(rng, words, 0.02)
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.keep_first_of_near_copies(spark, rows, SMALL).collect())
    assert kept == plain_first_of_copies(docs)


def plain_print(text):
    """Majority bits of the hashes of the set of 5-word shingles, bit by bit."""
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in plain_shingles(text)]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_fingerprints_find_near_copies_without_the_bands(spark, monkeypatch):
    """With band keys that no two texts share, the groups are those of linked fingerprints, verified."""

    def own_keys(hashes):
        return np.full(32, xxhash.xxh64_intdigest(hashes.tobytes(), 7), np.uint64)

    monkeypatch.setattr(copies, "band_keys", own_keys)
    rng = np.random.default_rng(11)
    docs = {}
    for words in [[f"w{rng.integers(10**6)}" for _ in range(n)] for n in (150, 400, 900) for _ in range(4)]:
        for share in (0, 0.002, 0.004, 0.008, 0.03):
            docs[len(docs)] = " ".join(edited(rng, words, share))
    # Texts of few shingles: fingerprints are alike where the sets are not.
    for i in range(40):
        docs[len(docs)] = " ".join(f"x{rng.integers(2)}" for _ in range(7 + i % 3))
    sets, prints = ([f(docs[k]) for k in sorted(docs)] for f in (plain_shingles, plain_print))
    pairs = [(a, b) for a in range(len(docs)) for b in range(a)]
    linked = groups(len(docs), [(a, b) for a, b in pairs if (prints[a] ^ prints[b]).bit_count() <= 4])
    near = [(a, b) for a, b in pairs if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))]
    root = groups(len(docs), [(a, b) for a, b in near if linked[a] == linked[b]])
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.keep_first_of_near_copies(spark, rows, SMALL).collect())
    assert kept == [i for i in range(len(docs)) if root[i] == i]
    assert len(kept) < len(docs) - 20
