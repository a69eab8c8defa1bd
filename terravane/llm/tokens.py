"""Token counts: frequent pre-tokens from a broadcast table, the others through worker caches."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Documents the table of frequent pre-tokens is taken from, about; pre-tokens that a task adds to
#: it and that it holds, at most. They decide what is looked up and what is encoded, never a count.
SAMPLE, PER_TASK, TABLE = 1000, 2048, 32_768
#: Pre-tokens a worker remembers beside the table, and the longest of them.
CACHE, LONGEST = 200_000, 64
#: Code points and rows handled at a time.
PIECE, SLICE = 1 << 17, 256

# --- fixed values: the pre-tokens of byte-level BPE, and the same for ASCII alone --------------
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")

#: No pre-token goes from a character to the space behind it: a text may be cut there.
_CUT = re.compile(r"(?<=\S)[ \n]")


class Words(dict):
    """Tokens of each pre-token: the frequent ones, and a bounded cache of the others met."""

    def __init__(self, tokenizer: Tokenizer, frequent: dict[str, int]):
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.room = tokenizer, frequent, CACHE

    def __missing__(self, word: str) -> int:
        n = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= LONGEST:
            if not self.room:
                self.clear()
                self.update(self.frequent)
                self.room = CACHE
            self.room -= 1
            self[word] = n
        return n


class Counts:
    """The number of tokens of a text, as the tokenizer in ``spec`` (its JSON) gives it.

    Special strings are tokens of their own. What lies between them is cut into pre-tokens, and
    since a pre-token is encoded by itself, their numbers of tokens add up.
    """

    def __init__(self, spec: str, frequent: dict[str, int]):
        self.tokenizer = Tokenizer.from_str(spec)
        self.words = Words(self.tokenizer, frequent)
        added = sorted((t["content"] for t in json.loads(spec)["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.same, self.other = set(), set()

    def __call__(self, text: str) -> int:
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(p) for part in parts for p in pieces(part))

    def _plain(self, piece: str) -> int:
        if piece.isascii():
            split = ASCII
        elif self._agrees(set(piece)):
            split = SPLIT
        else:
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return sum(sum(map(self.words.__getitem__, some)) for some in cut(split, piece))

    def _agrees(self, letters: set[str]) -> bool:
        """Whether the library takes every character for what the pattern takes it: the two may
        follow different versions of Unicode. A character is compared when it is first met."""
        for c in letters - self.same - self.other:
            probes = [f"{before}{c}" for before in "a1!"]
            ours = [len(SPLIT.findall(p)) for p in probes]
            theirs = [len(self.tokenizer.pre_tokenizer.pre_tokenize_str(p)) for p in probes]
            (self.same if ours == theirs else self.other).add(c)
        return not letters & self.other


def pieces(text: str) -> Iterator[str]:
    """``text`` in parts of about :data:`PIECE` code points that no pre-token crosses."""
    at = 0
    while at < len(text):
        found = _CUT.search(text, at + PIECE)
        stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


def cut(split: re.Pattern, piece: str) -> Iterator[list[str]]:
    """Pre-tokens of a piece; those of a piece without any place to cut come in several lists."""
    if len(piece) <= 4 * PIECE:
        yield split.findall(piece)
        return
    found = (m.group() for m in split.finditer(piece))
    while some := list(islice(found, PIECE)):
        yield some


def check_spec(spec: str) -> None:
    """Refuse a tokenizer whose pre-tokens are not those of byte-level BPE."""
    parsed = json.loads(spec)
    pre = parsed.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    marks = ("single_word", "lstrip", "rstrip", "normalized")
    bare = not any(t.get(m) for t in parsed["added_tokens"] for m in marks)
    if not (plain and bare and parsed["model"]["type"] == "BPE" and parsed.get("normalizer") is None):
        raise ValueError("the table of pre-tokens is made for byte-level BPE without a normaliser")


def frequent_words(texts: DataFrame, doc: Column, sample: int = SAMPLE) -> list[str]:
    """The most frequent pre-tokens of about ``sample`` documents, picked by a hash of their id.

    Each task counts its own and gives its :data:`PER_TASK` most frequent ones, so nothing is
    shuffled and no more than that by the number of sampled documents reaches the driver.
    """
    total = texts.count()
    picked = texts.where(F.pmod(F.xxhash64(doc, F.lit(17)), F.lit(max(1, total))) < sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for piece in pieces(text.as_py()):
                    for some in cut(SPLIT, piece):
                        met.update(some)
            met = Counter(dict(met.most_common(TABLE)))
        best = [(w, n) for w, n in met.most_common(PER_TASK) if len(w) <= LONGEST]
        columns = [pa.array([w for w, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    merged: Counter[str] = Counter()
    for row in picked.select("text").mapInArrow(count, "word string, n long").collect():
        merged[row["word"]] += row["n"]
    return [w for w, _ in sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:TABLE]]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    ``tokenizer`` is the path of a byte-level BPE in JSON, read on the driver. Each text is
    counted whole, map-side: its pre-tokens are looked up in a broadcast table of frequent ones,
    and a worker encodes each of the others once and remembers it. Numbers equal those of the
    library without begin and end tokens; special strings inside a text are special tokens.

    A null text counts as an empty one, with no bytes and no tokens; repeated rows and null ids
    each keep their row; an empty table gives an empty result; other columns are not read.
    """
    spec = Path(tokenizer).read_text("utf-8")
    check_spec(spec)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = frequent_words(texts, F.col("doc_id"), sample)
    library = Tokenizer.from_str(spec)
    lengths = [len(library.encode(w, add_special_tokens=False).ids) for w in words]
    sent = docs.sparkSession.sparkContext.broadcast({"spec": spec, "words": words, "lengths": lengths})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The broadcast value outlives a task: the worker's next one finds its cache there.
        state = sent.value
        if "counts" not in state:
            state["counts"] = Counts(state["spec"], dict(zip(state["words"], state["lengths"], strict=True)))
        counts = state["counts"]
        for batch in batches:
            column = batch.column(2)
            n: list[int] = []
            for at in range(0, len(batch), SLICE):
                n += map(counts, column.slice(at, SLICE).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    sized = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
