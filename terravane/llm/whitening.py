"""Embedding whitening: exact cross-products from AND-popcounts of bit planes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import stored

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Entries beyond this, scaled, are taken for it: past it doubles are no whole numbers any more.
LARGEST = float(1 << 53)
#: Rows packed into words at a time; bits of weight that one sum of a task carries.
ROWS, LIMB = 8192, 30


def whole_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id`` and ``x``, every entry as a whole number, of the vectors that can be used, and
    their number of entries."""
    entries = F.col("embedding").cast("array<double>")
    fine = ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = vectors.where(F.col("embedding").isNotNull() & fine & (F.size("embedding") > 0))
    near = F.transform(entries, lambda c: F.least(F.greatest(c * SCALE, F.lit(-LARGEST)), F.lit(LARGEST)))
    whole = F.transform(near, lambda c: F.floor(c) + SHIFT)
    rows = usable.select(F.col("vec_id").cast("long"), whole.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    width = most["size"] if most else 0
    return rows.where(F.size("x") == width), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def bounds(rows: DataFrame, width: int) -> list[tuple[int, int]]:
    """Least and largest entry of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = None, None
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(0), width)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            columns = [pa.array(np.arange(width)), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "low", "high"])

    found = rows.select("x").mapInArrow(run, "dim long, low long, high long")
    each = found.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return [(r["low"], r["high"]) for r in each.orderBy("dim").collect()]


def planes(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of the columns of ``y``, 64 rows to a word: column by column, low bits first."""
    packed = []
    for i, n in enumerate(bits):
        for b in range(n):
            packed.append(np.packbits((y[:, i] >> np.uint64(b)).astype(np.uint8) & 1))
    words = np.zeros((len(packed), -(-len(y) // 64) * 8), np.uint8)
    words[:, : -(-len(y) // 8)] = packed
    return words.view(np.uint64)


def scatter(rows: DataFrame, low: list[int], bits: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of ``y[i] * y[j]`` over all rows for ``i <= j``, ``y`` being the entries less
    the least of their dimension; one more dimension that is always 1 gives the plain sums.

    A product of two entries is a weighted sum over pairs of their bits, and a pair of planes
    adds up to the popcount of their AND. Weights come in limbs of :data:`LIMB` bits, one sum
    each, so that no sum of a task overflows. Tasks hand on a row for each pair of dimensions.
    """
    width, limbs = len(low), max(1, -(-2 * max(bits) // LIMB))
    owner = np.repeat(np.arange(width + 1), [*bits, 1])
    bit = np.concatenate([*(np.arange(n) for n in bits), [0]])
    names = ["i", "j", *(f"s{k}" for k in range(limbs))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.array(low, np.int64)
        sums = np.zeros((limbs, width + 1, width + 1), np.int64)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                x = _matrix(batch.column(0).slice(at, ROWS), width)
                y = np.hstack(((x - least).view(np.uint64), np.ones((len(x), 1), np.uint64)))
                plane = planes(y, [*bits, 1])
                for p in range(len(plane)):
                    both = np.bitwise_count(plane[p] & plane[p:]).sum(axis=1, dtype=np.int64)
                    # Two planes of one dimension are met once and count twice.
                    level = bit[p] + bit[p:] + ((owner[p:] == owner[p]) & (np.arange(p, len(plane)) > p))
                    for k in range(limbs):
                        part = np.where(level // LIMB == k, both << (level % LIMB), 0)
                        own = np.bincount(owner[p:], part, width + 1).astype(np.int64)
                        sums[k, owner[p]] += own
        i, j = np.triu_indices(width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *(pa.array(s[i, j]) for s in sums)], names)

    schema = ", ".join(f"{n} long" for n in names)
    parts = rows.select("x").mapInArrow(run, schema)
    total = [F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in names[2:]]
    return {
        (r["i"], r["j"]): sum(int(r[f"s{k}"]) << (LIMB * k) for k in range(limbs))
        for r in parts.groupBy("i", "j").agg(*total).collect()
    }


def principal(sums: dict[tuple[int, int], int], width: int, components: int) -> tuple[np.ndarray, list]:
    """Unit eigenvectors of the covariance by falling eigenvalue, and ``(eigenvalue, share)`` of each.

    The covariance is centred in whole numbers, ``n * sum(y[i] * y[j]) - sum(y[i]) * sum(y[j])``,
    and becomes floating point in one division.
    """
    n = sums[width, width]
    centred = [[n * sums[i, j] - sums[i, width] * sums[j, width] if i <= j else 0 for j in range(width)] for i in range(width)]
    upper = np.array([[c / (n * n) for c in row] for row in centred])
    values, vectors = np.linalg.eigh(upper + np.triu(upper, 1).T)
    trace = sum(centred[i][i] for i in range(width)) / (n * n)
    best = range(width - 1, max(-1, width - 1 - components), -1)
    return vectors[:, best], [(float(values[k]), float(values[k]) / trace if trace else None) for k in best]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every usable vector on the first ``components`` whitened principal components of all of them.

    An entry ``c`` counts as the whole number ``x = floor(1024 * c) + 100000``. The sums of
    products behind the covariance are exact: each dimension's entries, less their least, are
    packed bit by bit into words across rows, and weighted popcounts of the ANDs of two planes add
    up to a cross-product. Tasks hand on sums, one row for each pair of dimensions; the driver
    holds the covariance, its size the square of a vector's length, and never a vector.

    Returns ``vec_id``, ``component`` (from 1), ``n`` (vectors), ``deviation`` (the sum over
    dimensions of ``(n * x - S) ** 2``, exact; null where it exceeds a long), ``whitened``,
    ``explained`` and ``identity_error`` (of the whitened values as they are, over all rows).

    Vectors that are null or empty or hold a null or non-finite entry are dropped, and so are
    those of another length than most have. Scaled entries beyond 2 ** 53 count as that.
    ``whitened`` is null on a component whose eigenvalue is less than 1e-12 of the largest times the
    vector's length, where doubles cannot tell it from none; so it is if all vectors are equal,
    and ``explained`` then is null too. Repeated rows and null ids keep their rows and count; an empty table gives an empty
    result; other columns are not read.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, deviation long, z array<double>"
    rows, width = whole_vectors(vectors)
    count, parts, error = 0, [], None
    projected = spark.createDataFrame([], schema)
    if width:
        ends = bounds(rows, width)
        low = [a for a, _ in ends]
        sums = scatter(rows, low, [(b - a).bit_length() for a, b in ends])
        count = sums[width, width]
        axes, parts = principal(sums, width, components)
        total = [sums[i, width] + count * low[i] for i in range(width)]
        real = [k for k, (e, _) in enumerate(parts) if e > 1e-12 * width * parts[0][0]]
        scaled = axes[:, real] / np.sqrt([parts[k][0] for k in real])
        sent = spark.sparkContext.broadcast((count, total, scaled, real, len(parts)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total, scaled, real, columns = sent.value
            for batch in batches:
                for at in range(0, len(batch), ROWS):
                    part = batch.slice(at, ROWS)
                    off, deviation = deviations(_matrix(part.column(1), len(total)), n, total)
                    z = np.full((len(part), columns), np.nan)
                    z[:, real] = (off / n) @ scaled
                    flat = pa.array(z.ravel(), mask=np.isnan(z).ravel())
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * columns, pa.int32()), flat)
                    yield pa.RecordBatch.from_arrays([part.column(0), deviation, lists], ["vec_id", "deviation", "z"])

        projected = stored(rows.mapInArrow(run, schema), "whitened")
        pairs = [(i, j) for i in real for j in real if i <= j]
        if pairs:
            found = projected.agg(*[F.covar_pop(F.col("z")[i], F.col("z")[j]) for i, j in pairs]).first()
            error = max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))
    share = F.array(*[F.lit(s).cast("double") for _, s in parts] or [F.lit(None).cast("double")])
    spread = projected.select("vec_id", "deviation", F.posexplode("z").alias("_k", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("_k") + 1).alias("component"),
        F.lit(count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("_k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def deviations(x: np.ndarray, n: int, total: list[int]) -> tuple[np.ndarray, pa.Array]:
    """``n * x - S`` and its sum of squares in each row; in Python's integers where 64 bits are too few."""
    reach = int(max(abs(int(x.max())), abs(int(x.min())))) * n + max(map(abs, total))
    if reach < 1 << 62:
        off = x * n - np.array(total, np.int64)
        if int(np.abs(off).max()) ** 2 * len(total) < 1 << 63:
            return off, pa.array((off * off).sum(axis=1))
    exact = x.astype(object) * n - np.array(total, object)
    squares = (exact * exact).sum(axis=1)
    return exact.astype(np.float64), pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
