"""Each operator against brute force over whole tables, and on odd and empty input."""

from __future__ import annotations

import math
import re
import time
import zlib
from collections import defaultdict
from html import unescape

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane.llm import (
    decontaminate,
    extract,
    language,
    lines,
    mixing,
    quality,
    queries,
    sharding,
    simhash,
    units,
    vectors,
)

SMALL = "/root/testdata/sf0.001"
MIXED = "/root/testdata/sf0.01"


def docs_of(spark, sf_dir=SMALL):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def groups(n, linked):
    """Smallest index reachable from each of ``n`` over ``linked`` pairs."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


# --- language -------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    rows = language.identify(docs_of(spark, MIXED)).join(
        docs_of(spark, MIXED).select("doc_id", "lang"), "doc_id"
    ).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    apart = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in apart) >= 0.98 * len(apart)


def test_language_ignores_labels_of_held_out_documents(spark):
    docs = docs_of(spark).select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(language.held_out(), "zz").otherwise(F.col("lang")))
    assert sorted(language.identify(docs).collect()) == sorted(language.identify(other).collect())


def test_language_long_text_in_pieces_counts_once(monkeypatch):
    letters = language._letters()
    text = "alpha beta gamma delta " * 40
    known = {"a": language.gram_hashes([text], letters)[0][:50]}
    whole = language.Filters.build(known).share([text], letters)
    monkeypatch.setattr(language, "PIECE", 100)
    parts = language.Filters.build(known).share([text], letters)
    assert abs(whole[0][0, 0] - parts[0][0, 0]) < 0.05


def test_language_odd_rows(spark, odd_docs, no_docs):
    rows = language.identify(odd_docs).collect()
    assert len(rows) == 12
    named = defaultdict(set)
    for r in rows:
        named[r["doc_id"]].add(r["lang_pred"])
    assert named[3] == named[4] == named[5] == named[7] == {"und"}
    assert "und" not in named[8]
    assert language.identify(no_docs).count() == 0


# --- SimHash --------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_simhash(rows):
    marks = sorted({int(r["fingerprint"], 16) for r in rows})
    place = {m: i for i, m in enumerate(marks)}
    near = [(i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    root = groups(len(marks), near)
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            k = root[place[int(r["fingerprint"], 16)]]
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    for r in rows:
        assert r["component_id"] == least.get(root[place[int(r["fingerprint"], 16)]])


def test_simhash_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 16)
    docs = docs_of(spark)
    rows = simhash.simhash_groups(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows[:60]:
        assert int(r["fingerprint"], 16) == plain_fingerprint(texts[r["doc_id"]])
    check_simhash(rows)


@pytest.mark.parametrize("n", [1, simhash.SMALL + 1, simhash.MEDIUM + 1])
def test_no_four_bits_escape_all_bands(n):
    bands = simhash.layout(n)
    rng = np.random.default_rng(n)
    for _ in range(20_000):
        bits = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any((bits & mask).bit_count() <= radius for mask, radius in bands)


@pytest.mark.parametrize("limits", [(1 << 20, 1 << 27), (0, 1 << 27), (0, 0)])
def test_near_fingerprints_are_linked_through_small_leaves(spark, monkeypatch, limits):
    monkeypatch.setattr(simhash, "LEAF", 32)
    monkeypatch.setattr(simhash, "SMALL", limits[0])
    monkeypatch.setattr(simhash, "MEDIUM", limits[1])
    rng = np.random.default_rng(3)
    seeds = rng.integers(-(2**62), 2**62, 120)
    near = [int(s) ^ sum(1 << int(b) for b in rng.choice(62, k, replace=False)) for s in seeds for k in (1, 4, 5)]
    hot = [int(seeds[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a in range(20) for b in range(20, 40)]
    marks = sorted({*map(int, seeds), *near, *hot})
    found = spark.createDataFrame([(m,) for m in marks], "fp long")
    got = {r["fp"]: r["group"] for r in simhash.near_groups(found).collect()}
    bits = np.array(marks, np.int64).view(np.uint64)
    pairs = np.argwhere(np.bitwise_count(bits[:, None] ^ bits) <= 4)
    root = groups(len(marks), pairs)
    assert [got[m] for m in marks] == [marks[k] for k in root]


def test_simhash_odd_rows(odd_docs, no_docs):
    rows = simhash.simhash_groups(odd_docs).collect()
    assert len(rows) == 12
    check_simhash(rows)
    kept = simhash.first_of_groups(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 6, 7, 8]
    assert simhash.simhash_groups(no_docs).count() == 0 == simhash.first_of_groups(no_docs).count()


# --- decontamination ------------------------------------------------------------------------


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_myers_is_the_edit_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item = "".join(rng.choice(list("abc"), rng.integers(1, 20)))
        text = "".join(rng.choice(list("abc"), rng.integers(0, 40)))
        assert decontaminate.myers(item, text) == plain_distance(item, text)


def test_leaks_against_comparing_everything(spark):
    items = ["The quick brown fox jumps over the lazy dog near the river bank.", "short item", "!!", None]
    edited = items[0].replace("quick", "quikc").replace("lazy", "la zy").upper()
    far = items[0].replace("quick brown", "slow green").replace("lazy dog", "idle cat").replace("river", "ocean")
    texts = [items[0], f"before {edited} after", far, "a SHORT-item here", "shart item", None, "", "x" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (0, items[0])], "item_id long, text string")
    rows = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.contaminated(docs, bench).collect()}
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items[:2]):
            distance = plain_distance(decontaminate.squeeze(item), decontaminate.squeeze(text))
            if distance <= decontaminate.budget(decontaminate.squeeze(item)):
                expected[d, i] = distance
    assert rows == expected and len(expected) == 3
    clean = {r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in expected}


def test_leaks_on_odd_rows(odd_docs, no_docs):
    items = odd_docs.selectExpr("doc_id AS item_id", "text")
    found = decontaminate.contaminated(odd_docs, items).collect()
    assert {r["item_id"] for r in found} >= {1, 2, 6}
    assert decontaminate.decontaminate(odd_docs, items.limit(0)).count() == 12
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(odd_docs, items.limit(0)).count() == 0


# --- mixing ---------------------------------------------------------------------------------


@pytest.mark.parametrize("sf_dir", [SMALL, MIXED])
def test_mix_meets_targets(spark, sf_dir):
    rows = mixing.mix(docs_of(spark, sf_dir)).collect()
    taken, goal, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        goal[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert {k: v[1] for k, v in goal.items()} == dict(size)
    assert all(taken[k] == round(v[0]) for k, v in goal.items())
    assert abs(sum(v[0] for v in goal.values()) - sum(size.values())) < 1


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 2), (None, 50)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # b and c stop at three times their size; a and the null source weigh 1 and 1 of the rest.
    assert got == {"a": 72.0, "b": 3.0, "c": 6.0, None: 72.0}


def test_targets_of_many_sources_against_plain_shares(spark):
    rng = np.random.default_rng(6)
    sizes = {f"s{i:04d}": int(rng.pareto(0.7) * 50) for i in range(700)}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes))}
    full, left = set(), sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in full]
        unit = (left - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in free)
        more = {s for s in free if 3 * sizes[s] <= unit * weight[s]}
        if not more:
            break
        full |= more
    want = {s: 3.0 * sizes[s] if s in full else unit * weight[s] for s in sizes}
    assert all(math.isclose(got[s], want[s], abs_tol=1e-5) for s in sizes) and 0 < len(full) < 700


def test_mix_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 12 and sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd_docs).collect()))
    made = mixing.mixed(odd_docs)
    assert made.columns == odd_docs.columns
    words = sum(len((r["text"] or "").split()) for r in made.collect())
    assert words == sum(r["taken"] for r in rows)
    assert mixing.mix(no_docs).count() == 0 == mixing.mixed(no_docs).count()


# --- shards ---------------------------------------------------------------------------------


def test_curve_visits_every_cell_step_by_step(spark):
    cells = spark.range(512).selectExpr("id % 8 AS x", "id div 8 % 8 AS y", "id div 64 AS z")
    curve = sharding.hilbert(F.col("x"), F.col("y"), F.col("z"), 3)
    rows = sorted(cells.select(curve.alias("at"), "x", "y", "z").collect())
    assert [r["at"] for r in rows] == list(range(512))
    steps = [sum(abs(a[k] - b[k]) for k in "xyz") for a, b in zip(rows, rows[1:], strict=False)]
    assert set(steps) == {1}


def check_shards(rows, texts=None):
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and 0 <= r["shard"] < 40 and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[k]) for k in range(40)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_over_whole_tables(spark):
    docs = docs_of(spark, MIXED)
    rows = sharding.shard(docs).collect()
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 16, zlib.crc32(texts[r["doc_id"]]))
    check_shards(rows)
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in rows)


def test_shards_odd_rows(odd_docs, no_docs):
    rows = sharding.shard(odd_docs).collect()
    assert len(rows) == 12
    check_shards(rows)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 5} == {(16, None)}
    assert sharding.shard(no_docs).count() == 0


# --- lines ----------------------------------------------------------------------------------


def plain_line_dedup(docs, width=3):
    seen, out = set(), {}
    for doc, text in sorted(docs.items()):
        rows = text.split("\n")
        gone = set()
        for i in range(len(rows) - width + 1):
            window = tuple(r.strip(" ") for r in rows[i : i + width])
            if window in seen:
                gone |= set(range(i, i + width))
            seen.add(window)
        out[doc] = "\n".join(r for i, r in enumerate(rows) if i not in gone), len(gone)
    return out


def test_lines_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in docs_of(spark).collect()}
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup_lines(docs_of(spark)).collect()}
    assert got == plain_line_dedup(docs)


def test_lines_extend_runs_and_repeat_within_a_document(spark):
    rows = {1: "a\nb\nc\nd\ne", 2: "x\nb\nc\nd\ne\ny", 3: "b\nc", 4: "q\nq\nq\nq\nq", 5: " a \nb\nc"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
    assert got == {k: v[0] for k, v in plain_line_dedup(rows).items()}
    assert got[2] == "x\ny" and got[3] == "b\nc" and got[5] == ""


@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_lines_of_few_kinds_against_brute_force(spark, width):
    rng = np.random.default_rng(width)
    rows = {i: "\n".join(rng.choice(list("abcd"), rng.integers(1, 25))) for i in range(80)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup_lines(docs, width).collect()}
    assert got == plain_line_dedup(rows, width)


def test_every_window_has_a_selected_line_and_few_are_selected(spark):
    text = "\n".join(f"line {i}" for i in range(3000))
    docs = spark.createDataFrame([(1, text, 1)], "doc_id long, text string, key long")
    rows = lines.fingerprints(docs, 5).collect()
    assert sorted(r["pos"] - w["back"] for r in rows for w in r["around"]) == list(range(2996))
    assert len(rows) == len({r["pos"] for r in rows}) and 0.28 < len(rows) / 3000 < 0.38  # 2 / (5 + 1)


def test_lines_of_long_texts_in_linear_time(spark):
    def docs(n):
        body = "\n".join(f"line number {i} of words" for i in range(n))
        return spark.createDataFrame([(1, body), (2, f"{body}\nown")], "doc_id long, text string")

    rows = lines.dedup_lines(docs(40_000)).select("doc_id", "text", "n_removed").collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {1: 0, 2: 40_000}
    assert {r["text"] for r in rows if r["doc_id"] == 2} == {"own"}
    assert seconds(lambda: lines.dedup_lines(docs(40_000))) < seconds(lambda: lines.dedup_lines(docs(200))) + 5


def test_lines_odd_rows(odd_docs, no_docs):
    rows = lines.dedup_lines(odd_docs).collect()
    assert len(rows) == 12
    texts = [r["text"] for r in rows if r["doc_id"] in (1, 2)]
    assert sum(bool(t) for t in texts) == 2  # both rows of id 1 are one document
    assert lines.dedup_lines(no_docs).count() == 0


# --- blocks of the benchmark ----------------------------------------------------------------


def test_benchmark_in_blocks_gives_the_same_hits(spark, monkeypatch):
    docs, bench = docs_of(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    clean = sorted(r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect())
    blocks = decontaminate.item_blocks
    assert blocks(bench, 3000).select("block").distinct().count() > 2
    monkeypatch.setattr(decontaminate, "item_blocks", lambda items: blocks(items, 3000))
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == whole and whole
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()) == clean


# --- units ----------------------------------------------------------------------------------


OTHER_MARKS = "\u3002\uff01\uff1f\uff0e\uff61\u104b\u17d4\u0964\u06d4\u061f"
CLOSERS = ".!?\u300d\u300f\u201d\u2019\uff09"


def plain_sentences(text):
    """Sentences of every line, character by character, each with the white space behind it."""
    at, start = 0, 0
    while at < len(text):
        stop = at
        if text[at] in ".!?":
            while stop < len(text) and text[stop] in ".!?":
                stop += 1
            if stop == len(text) or not text[stop].isspace():
                at = stop
                continue
        elif text[at] in OTHER_MARKS:
            while stop < len(text) and text[stop] in OTHER_MARKS + CLOSERS:
                stop += 1
        elif text[at] != "\n":
            at += 1
            continue
        while stop < len(text) and text[stop].isspace() and text[stop] != "\n":
            stop += 1
        stop += stop < len(text) and text[stop] == "\n"
        yield start, stop
        at = start = stop
    if start < len(text):
        yield start, len(text)


def plain_units(text):
    """Sentences joined within their line until they have six words."""
    start, words = None, []
    for a, b in plain_sentences(text):
        start = a if start is None else start
        words += text[a:b].lower().split()
        if len(words) >= 6 or text[a:b].endswith("\n") or b == len(text):
            yield start, b, " ".join(words)
            start, words = None, []


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab .!?\n\t\u3002\u201d", max_size=60))
def test_units_of_any_text(text):
    got = [(a, b) for a, b, _ in units.units(text)]
    assert got == [(a, b) for a, b, _ in plain_units(text)]


def plain_unit_dedup(docs):
    seen, out = set(), {}
    for doc, text in sorted(docs.items()):
        kept = []
        for start, stop, unit in plain_units(text):
            if unit.count(" ") + 1 >= units.WORDS and unit in seen:
                continue
            seen.add(unit)
            kept.append(text[start:stop])
        out[doc] = "".join(kept)
    return out


def seconds(build):
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def test_units_of_long_texts_in_linear_time(spark):
    """20,000 shared lines among own ones: a text is cut once, not once a span."""

    def docs(n):
        shared = [f"the shared line number {i} has some words" for i in range(n)]
        rows = [(d, "\n".join(f"{x}\nown line {i} of document {d} with words" for i, x in enumerate(shared))) for d in (1, 2)]
        return spark.createDataFrame(rows, "doc_id long, text string")

    rows = units.dedup_units(docs(20_000)).select("doc_id", F.size("kept").alias("n")).collect()
    assert sorted(map(tuple, rows)) == [(1, 1), (2, 20_000)]
    assert seconds(lambda: units.dedup_units(docs(20_000))) < seconds(lambda: units.dedup_units(docs(200))) + 5


def test_units_cover_texts(spark):
    for r in docs_of(spark).collect():
        spans = list(units.units(r["text"]))
        assert "".join(r["text"][a:b] for a, b, _ in spans) == r["text"]


def test_units_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in docs_of(spark, MIXED).collect()}
    rows = units.dedup_units(docs_of(spark, MIXED)).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == plain_unit_dedup(docs)
    for r in rows:
        assert "".join(docs[r["doc_id"]][s["start"] : s["stop"]] for s in r["kept"]) == r["text"]


def test_a_passage_inside_other_sentences_goes(spark):
    passage = " ".join(f"Sentence {i} of the shared passage has these words." for i in range(8))
    docs = spark.createDataFrame(
        [(1, f"Own beginning here {passage} own end."), (2, f"Something else {passage} And more of it, quite other.")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r["text"] for r in units.dedup_units(docs).collect()}
    assert passage in got[1] and "Sentence 3" not in got[2] and "quite other" in got[2]


@pytest.mark.parametrize(
    "shared",
    ["這是兩份文件共有的一個很長的句子。", "これは二つの文書にある長い一文です。", "ประโยคนี้ยาวมากและปรากฏอยู่ในเอกสารทั้งสองฉบับ\n"],
)
def test_repeats_in_text_without_spaces_go(spark, shared):
    docs = {1: f"自己的開頭在這裡寫下來了。{shared}甲乙丙。", 2: f"另外一個完全不同的開頭在此。\n{shared}短句。", 3: "短句。"}
    docs[1] = docs[1] if not shared.endswith("\n") else f"หนึ่ง\n{shared}สอง"
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in units.dedup_units(rows).collect()}
    assert got[1] == docs[1] and got[3] == "短句。"
    assert got[2] == "另外一個完全不同的開頭在此。\n短句。"


def test_units_odd_rows(odd_docs, no_docs):
    rows = units.dedup_units(odd_docs).collect()
    assert len(rows) == 12 and {r["text"] for r in rows if r["doc_id"] == 5} == {None}
    assert units.dedup_units(no_docs).count() == 0


# --- vectors --------------------------------------------------------------------------------


def check_vectors(ids, x, rows, recall=1.0):
    x = x / np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    got = {r["vec_id"]: r for r in rows}
    found = sum(got[i]["n_links"] for i in ids)
    assert recall * linked.sum() <= found <= linked.sum()
    if found == linked.sum():
        root = groups(len(ids), np.argwhere(linked))
        assert [got[i]["component_id"] for i in ids] == [ids[k] for k in root]


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAF", 64)
    rng = np.random.default_rng(5)
    seeds = rng.standard_normal((150, 32))
    near = [s + rng.standard_normal(32) * scale for s in seeds for scale in (0.1, 0.3, 0.45)]
    hot = [seeds[0] + rng.standard_normal(32) * 0.05 for _ in range(200)]
    x = np.concatenate([seeds, near, hot, seeds[:20]])
    ids = list(range(len(x)))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    check_vectors(ids, x, vectors.near_vectors(rows).collect(), recall=0.97)


def test_vectors_of_the_table(spark):
    table = spark.read.parquet(f"{MIXED}/embeddings.parquet")
    pairs = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    rows = vectors.near_vectors(table).collect()
    check_vectors([p[0] for p in pairs], np.array([p[1] for p in pairs], float), rows)


def test_trees_keep_the_recall_of_deep_tables(spark):
    """Pairs of cosine 0.9 and 20 levels: those that some tree does not part."""
    n, levels = vectors.LEAF * round(0.56**-20), 20
    rng = np.random.default_rng(6)
    a, b = rng.standard_normal((2, 2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.9 * a + 0.19**0.5 * b / np.linalg.norm(b, axis=1)[:, None]
    x = np.concatenate([a, b])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    at = np.zeros((vectors.trees_for(n), len(x), levels))
    for r in vectors.projections(rows, levels, len(at)).collect():
        at[r["tree"] % len(at), r["id"]] = r["at"]
    one, other = at[:, :2000], at[:, 2000:]
    parted = (np.minimum(one, other) <= -vectors.OVERLAP) & (np.maximum(one, other) > vectors.OVERLAP)
    assert parted.any(axis=2).all(axis=0).mean() <= 0.005
    assert vectors.trees_for(0) == vectors.trees_for(1024) == vectors.TREES
    for size in (10**5, 10**6, 10**7, 10**8, 10**9):
        deep = math.log(size / 1024) / -math.log(0.56)
        assert (1 - 0.946**deep) ** vectors.trees_for(size) <= 0.002


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    values = [None, [], [0.0, 0.0], [1.0, None], [1.0, nan], [1.0, inf], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [1.0], [3e38, 6e38 / 2]]
    schema = "vec_id long, embedding array<float>, size string, id string"
    rows = spark.createDataFrame([(i, v, "x", "y") for i, v in enumerate(values)], schema)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(rows).collect()}
    assert all(got[i] == (0, i, True) for i in (0, 1, 2, 3, 4, 5, 9))
    assert got[6] == (3, 6, True) and got[7] == (3, 6, False) and got[8] == (3, 6, False)
    assert vectors.near_vectors(rows.limit(0)).count() == 0


# --- quality --------------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    rows = queries.op8_quality(spark, MIXED).collect()
    assert len(rows) == 1000
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIXED}/labels.parquet").collect()}
    apart = [r for r in rows if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(r["kept"] == labels[r["doc_id"]] for r in apart) >= 0.95 * len(apart)
    for r in rows:
        assert min(r["path_posterior"], r["host_posterior"]) > 0 and 0 <= r["score"] <= 1


def test_sparse_sites_shrink_to_the_mean(spark):
    docs = [(i, "the same words for all of them", "big", "p") for i in range(200)]
    docs += [(1000 + i, "the same words for all of them", "bad", "p") for i in range(200)]
    docs += [(2000, "the same words for all of them", "small", "p")]
    labels = [(i, 1) for i in range(200)] + [(1000 + i, int(i < 20)) for i in range(200)] + [(2000, 0)]
    rows = quality.score_quality(
        spark.createDataFrame(docs, "doc_id long, text string, host string, path string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
        F.col("host"),
        F.col("path"),
    ).collect()
    host = {r["host_posterior"] for r in rows if r["doc_id"] == 2000}
    by = {r["doc_id"]: r["host_posterior"] for r in rows}
    assert by[1000] < 0.2 and by[0] > 0.9 and by[1000] < host.pop() < by[0]


def plain_posteriors(sites, mean, strength):
    """Site posteriors by plain sums; ``sites`` has ``(host, path, truth)`` of each document."""
    hosts, paths = defaultdict(list), defaultdict(list)
    for host, path, truth in sites:
        hosts[host].append(truth)
        paths[host, path].append(truth)
    rate = {h: sum(t) / len(t) for h, t in hosts.items()}
    spread = sum(len(t) * (sum(t) / len(t) - rate[h]) ** 2 for (h, _), t in paths.items())
    left = {k: 1 - len(t) / len(hosts[k[0]]) for k, t in paths.items()}
    expected = sum(left[k] * rate[k[0]] * (1 - rate[k[0]]) for k in paths)
    free = sum(len(t) * left[k] for k, t in paths.items())
    inner = sum(len(t) * rate[k[0]] * (1 - rate[k[0]]) for k, t in paths.items()) / len(sites)
    share = min(max((spread - expected) / free / inner, 1 / (1 + quality.MOST)), 0.5)
    own = 1 / share - 1
    host = {h: (sum(t) + strength * mean) / (len(t) + strength) for h, t in hosts.items()}
    return {k: (host[k[0]], (sum(t) + own * host[k[0]]) / (len(t) + own)) for k, t in paths.items()}


@pytest.mark.parametrize("differ", [0.0, 0.3])
def test_site_posteriors_against_plain_sums(spark, differ):
    rng = np.random.default_rng(4)
    sites = []
    for h in range(12):
        rate = rng.beta(4, 4)
        for p in range(6):
            own = float(np.clip(rate + rng.normal() * differ, 0.02, 0.98))
            sites += [(f"h{h}", f"p{p}", int(rng.random() < own)) for _ in range(rng.integers(1, 60))]
    docs = spark.createDataFrame([(i, "words", h, p) for i, (h, p, _) in enumerate(sites)], "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(sites)], "doc_id long, quality int")
    rows = quality.score_quality(docs, labels, F.col("host"), F.col("path")).collect()
    hosts = defaultdict(list)
    for h, _, t in sites:
        hosts[h].append(t)
    totals = spark.createDataFrame([(float(len(t)), float(sum(t))) for t in hosts.values()], "host_n double, host_good double")
    want = plain_posteriors(sites, *quality._prior(totals))
    for r in rows:
        host, path = want[sites[r["doc_id"]][:2]]
        assert math.isclose(r["host_posterior"], host, abs_tol=1e-6) and math.isclose(r["path_posterior"], path, abs_tol=1e-6)
    spread = {round(r["path_posterior"] - r["host_posterior"], 3) for r in rows}
    assert (max(map(abs, spread)) > 0.1) == (differ > 0)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (6, None), (99, 1)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        rows = quality.score_quality(odd_docs, marks, F.col("source"), F.col("lang")).collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(no_docs, labels, F.col("source"), F.col("lang")).count() == 0


# --- pages ----------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title></head><body><header>Site header</header><div id="cookie-notice">We use
cookies, accept all of them now</div><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="wrap">
<div class="sidebar">Side stuff <a href=a>x</a></div><main><h1>Title &amp; more</h1><p>First para with
&eacute; and&nbsp;<i>inline</i> text that is long enough, really long.<p>Second
  para, also long enough to be part of the article.</p><ul><li>One item<li>Two item</ul>
<script>var x="<p>no</p>";</script><form><input>Form text</form><div class="ad">Buy now</div></main>
<section id="comments"><div class="comment">I liked this article so much, thank you all.</div></section></div>
<footer>foot</footer></body>"""


def test_article_of_a_page():
    assert extract.main_text(PAGE).split("\n") == [
        "Title & more",
        "First para with é and inline text that is long enough, really long.",
        "Second para, also long enough to be part of the article.",
        "One item",
        "Two item",
    ]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        ("just text", "just text"),
        ("<div>" * 20_000 + "deep", "deep"),
        ("<p>cut <b>off here <a hre", "cut off here"),
    ],
)
def test_odd_pages(html, text):
    assert extract.main_text(html).startswith(text) and (text or not extract.main_text(html))


def test_pages_of_the_table(spark):
    rows = extract.extract(spark.read.parquet(f"{SMALL}/pages.parquet")).collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        assert r["n_chars"] == len(r["text"]) and r["text"] == extract.main_text(html[r["page_id"]])
        inner = re.search(r"<article>(.*?)(</article>|$)", html[r["page_id"]], re.S)[1]
        own = re.sub(r'<div class="ad">.*?</div>|<(script|style)>.*?</\1>', " ", inner, flags=re.S)
        shown = unescape(re.sub(r"<[^>]*>", " ", own))
        assert r["text"].split() == shown.split()


BODY = "<h1>Headline of the page</h1>" + "".join(f"<p>{f'Paragraph {i} has words, more words. ' * 6}</p>" for i in range(5))


@pytest.mark.parametrize(
    "html",
    [
        f'<div class="site has-sidebar">{BODY}</div>',
        f'<div id="page" class="no-comments"><article>{BODY}</article></div>',
        f'<div class="share-enabled"><div class="social-science">{BODY}</div></div>',
        f'<div class="form-page with-header">{BODY}</div>',
        f'<article>{BODY.replace("<p>", """<p class="notice">""")}</article>',
        f"<form><input>{BODY}</form>",
        f'<form><div class="sidebar">Side stuff here</div><main>{BODY}</main></form>',
        f'<div class="widget"><article>{BODY}</article></div><div class="comment-list">Nice text, thanks.</div>',
        f'<article>{BODY}</article><section id="comments"><article class="comment-body">{"So nice. " * 400}</article></section>',
    ],
)
def test_marks_take_no_article_away(html):
    lines_of = re.findall(r"<(?:h1|p)[^>]*>(.*?)</", BODY)
    assert extract.main_text(html).split("\n") == [" ".join(x.split()) for x in lines_of]


def sections(n: int, letters: int) -> str:
    return "<section>" + "".join(f"<p>{'abcde fghi ' * (letters // 11)}end {i}.</p>" for i in range(n)) + "</section>"


@pytest.mark.parametrize(
    "page",
    [
        "<nav><a href=x>Home</a></nav><article>{}</article><footer>foot</footer>",
        "<nav><a href=x>Home</a></nav><main><div>{}</div></main><div><a href=y>More of this</a></div>",
        "<div><ul><li><a href=x>Home</a><li><a href=z>News of the day</a></ul><div>{}</div></div>",
        "<article><div>{}</div></article><div><a href=y>More of this</a></div>",
    ],
)
def test_nested_sections_stay_whole(page):
    head = "A headline of the page, of forty letters"
    body = f"<h1>{head}</h1>{sections(5, 400)}<h2>Short</h2>{sections(3, 90)}"
    want = [" ".join(x.split()) for x in re.findall(r"<(?:h1|h2|p)>(.*?)</", body)]
    assert extract.main_text(page.format(body)).split("\n") == want


def test_headline_beside_the_article_stays():
    html = f"<nav>n</nav><h1>Headline</h1><article>{sections(5, 400)}</article><div>Rights reserved</div>"
    assert extract.main_text(html).split("\n")[0] == "Headline" and "Rights" not in extract.main_text(html)
