"""Quality by document evidence and the record of the site, hierarchical empirical Bayes."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import stored

#: Labelled documents that the document classifier is fitted on, about.
SAMPLE = 20_000
KEEP = 0.5
#: Strength of the path prior at most, which it has where paths differ no more than by chance.
MOST = 10_000.0

#: Counts and shares of a text, and buckets that its words and their endings are hashed into.
SHARES, BUCKETS = 10, 128
FEATURES = SHARES + BUCKETS
#: Rows handled at a time.
SLICE = 256
_ODD = re.compile(r"[^\w\s.,;:'\"()\-]")


def features(text: str | None) -> list[float]:
    """Shares and lengths of the whole text that tell prose from junk, then its words and the last
    three letters of each, hashed, as shares of all words."""
    words = (text or "").split()
    n, size = max(len(words), 1), max(len(text or ""), 1)
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text or "")))
    bare = sum(1 for w in words if w.isalpha())
    repeats = sum(1 for a, b in zip(words, words[1:], strict=False) if a == b)
    lexical = np.zeros(BUCKETS)
    for word, times in Counter(words).items():
        low = word.lower().encode()
        lexical[zlib.crc32(low) % BUCKETS] += times
        lexical[zlib.crc32(low[-3:], 1) % BUCKETS] += times
    return [
        math.log1p(len(words)),
        letters / size,
        bare / n,
        sum(1 for w in words if w.isupper()) / n,
        len(_ODD.findall(text or "")) / n,
        repeats / n,
        len(set(words)) / n,
        sum(map(len, words)) / n / 10,
        sum(1 for w in words if w[-1] in ".!?") / n,
        math.log1p(sum(1 for c in (text or "") if c.isdigit())) / 5,
        *(lexical / n).tolist(),
    ]


@dataclass
class Evidence:
    """Logistic regression on :func:`features` and the squares of the shares among them."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def _spread(x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), x, x[:, :SHARES] ** 2], axis=1)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Evidence:
        """Newton's method, with a ridge that keeps separable data finite."""
        if not len(x):
            return cls(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(1 + FEATURES + SHARES))
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = cls._spread(np.clip((x - mean) / scale, -5, 5))
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (y - p) - penalty * w
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = self._spread(np.clip((x - self.mean) / self.scale, -5, 5))
        return np.clip(z @ self.weights, -15, 15)


def _measured(texts: pa.Array) -> np.ndarray:
    """Features of each text, a few rows at a time."""
    parts = [texts.slice(at, SLICE).to_pylist() for at in range(0, len(texts), SLICE)]
    return np.array([features(t) for part in parts for t in part], np.float64).reshape(-1, FEATURES)


def taught(docs: DataFrame, known: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of about ``sample`` labelled documents, picked by a hash of their id.

    The picked labels are broadcast, about ``sample`` rows of two numbers, so no text moves.
    """
    draw = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1_000_000))
    picked = known.where(draw < int(min(1.0, sample / max(known.count(), 1)) * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(list(_measured(batch.column(1)).astype(np.float32)), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), x, batch.column(2)], ["doc_id", "x", "label"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
    rows = joined.mapInArrow(run, "doc_id long, x array<float>, label double").orderBy("doc_id", "x").collect()
    return np.array([r["x"] for r in rows], float).reshape(len(rows), FEATURES), np.array([r["label"] for r in rows], float)


def judged(docs: DataFrame, host: Column, path: Column, model: Evidence) -> DataFrame:
    """``doc_id``, ``host``, ``path`` and the evidence (log-odds) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast((model.mean, model.scale, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Evidence(*sent.value)
        for batch in batches:
            logit = pa.array(fitted.logit(_measured(batch.column(3))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], logit], ["doc_id", "host", "path", "evidence"])

    rows = docs.select(
        F.col("doc_id").cast("long"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        F.col("text").cast("string"),
    )
    return rows.mapInArrow(run, "doc_id long, host string, path string, evidence double")


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    learn: Column | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """Quality of every row of ``docs`` from its text and from its site.

    A logistic regression on whole-text features, fitted on about ``sample`` labelled documents
    picked by a hash (only those where ``learn`` over ``doc_id`` holds), gives each document its
    evidence. A document adds its label, or the evidence's probability where it has none, to
    its host and its path. A host's posterior is shrunk to the global mean as strongly as the
    spread of the hosts asks for (moments of a beta prior), a path's to its host's as strongly as
    the spread of paths within hosts does. The score joins the document's log-odds with those by
    which its path, without the document itself, differs from the mean.

    Returns ``doc_id``, ``evidence`` (log-odds), ``host_posterior``, ``path_posterior``,
    ``score`` (0 to 1) and ``kept`` (score of a half or more) for each row. A null host or path
    is a site of its own, a null text has no words, labels that contradict each other for one
    id are averaged, null labels and labels without document teach nothing; without any label
    every score is a half; an empty table gives an empty result.
    """
    known = labels.where("doc_id is not null and quality is not null")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.avg(F.col("quality").cast("double")).alias("label")
    )
    known = stored(known, "labels")
    model = Evidence.fit(*taught(docs, known, sample))
    rows = stored(judged(docs, host, path, model), "judged")
    weighed = rows.join(known, rows["doc_id"] == known["_id"], "left").drop("_id")
    weighed = stored(weighed, "evidence")
    truth = F.coalesce("label", 1 / (1 + F.exp(-F.col("evidence"))))
    counted = weighed.groupBy("host", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.round(F.sum(truth), 6).alias("good")
    )
    paths = stored(counted, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.round(F.sum("good"), 6).alias("host_good"))
    hosts = stored(hosts, "hosts")
    mean, strength = _prior(hosts)
    posterior = (F.col("host_good") + strength * mean) / (F.col("host_n") + strength)
    hosts = hosts.select(F.col("host").alias("_host"), "host_n", "host_good", posterior.alias("host_posterior"))
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
    inner = _path_strength(sites)
    own = (F.col("good") + inner * F.col("host_posterior")) / (F.col("n") + inner)
    sites = sites.select("_host", F.col("path").alias("_path"), "n", "good", "host_n", "host_good", "host_posterior", own.alias("path_posterior"))
    sites = stored(sites, "sites")
    scored = weighed.join(
        sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
    )
    # What the others say of the site: a document's own word is in its evidence.
    host = (F.col("host_good") - truth + strength * mean) / (F.col("host_n") - 1 + strength)
    others = (F.col("good") - truth + inner * host) / (F.col("n") - 1 + inner)
    others = F.least(F.greatest(others, F.lit(1e-6)), F.lit(1 - 1e-6))
    site = F.ln(others / (1 - others)) - math.log(mean / (1 - mean))
    score = 1 / (1 + F.exp(-(F.col("evidence") + site)))
    result = scored.withColumn("score", score)
    return result.select(
        "doc_id", "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= KEEP).alias("kept")
    )


def _path_strength(sites: DataFrame) -> float:
    """Documents of its host that a path counts as before it has any of its own, by moments: the
    spread of paths around their hosts beyond what chance gives paths of their sizes."""
    host_rate = F.col("host_good") / F.col("host_n")
    chance = host_rate * (1 - host_rate)
    off = F.col("n") * (F.col("good") / F.col("n") - host_rate) ** 2
    left = 1 - F.col("n") / F.col("host_n")
    total = sites.agg(F.sum(off), F.sum(left * chance), F.sum(F.col("n") * left), F.sum(F.col("n") * chance), F.sum("n")).first()
    spread, expected, free, weighed, n = (float(v or 0) for v in total)
    inner = weighed / n if n else 0.0
    if not inner or free <= 0:
        return MOST
    share = min(max((spread - expected) / free / inner, 1 / (1 + MOST)), 0.5)
    return round(1 / share - 1, 6)


def _prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and strength of the beta prior of hosts by moments: their spread beyond chance.

    Means stay off 0 and 1, so that log-odds are finite.
    """
    total = hosts.agg(F.sum("host_n"), F.sum("host_good"), F.count(F.lit(1)), F.sum(F.col("host_n") ** 2)).first()
    n, good, count, squares = (float(v or 0) for v in total)
    if not n:
        return 0.5, 1.0
    mean = min(max(good / n, 1e-3), 1 - 1e-3)
    rate = F.col("host_good") / F.col("host_n")
    spread = float(hosts.agg(F.sum(F.col("host_n") * (rate - mean) ** 2)).first()[0] or 0)
    inner = mean * (1 - mean)
    between = (spread - (count - 1) * inner) / max(n - squares / n, 1e-9)
    share = min(max(between / inner, 1e-4), 0.5)
    return mean, 1 / share - 1
