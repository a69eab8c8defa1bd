"""Mixing sources to target weights by prefix sums over a hash-random order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import in_order, offsets, renamed, running, scope, stored

WEIGHTS, EPOCHS, SEED = (1, 2, 3), 3, 42

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Target words of each source, from ``source`` and ``source_size``, one row for each source.

    Sources by code point, null last, take ``weights`` in turn and share the sum of all sizes by
    weight. A source stops at ``epochs`` times its size and the rest share the excess: with
    sources in order of size by weight, the first of them stop, and the share of a unit of
    weight follows from what is left. Adds ``target``, ``rank`` (from 0) and ``start`` (words of
    the sources before).

    Sums over the sources before one are prefix sums in range partitions, like those over
    documents: sources may be as many as there are hosts. The driver gets three totals.
    """
    with scope(sizes.sparkSession):
        first = in_order(stored(sizes, "sizes"), F.col("source").asc_nulls_last())
        placed = stored(running(first, "source_size"), "sources")
        counts = offsets(placed, F.count(F.lit(1))).withColumnRenamed("_before", "_rows")
        starts = stored(offsets(placed, F.sum("source_size")).join(counts, "_part"), "starts")
        rank = F.col("_rows") + F.col("_place").bitwiseAND((1 << 33) - 1)
        ranked = placed.join(starts, "_part").select(
            "source", "source_size", rank.alias("rank"), (F.col("_before") + F.col("_within")).alias("start")
        )
        turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
        weighed = stored(ranked.withColumn("weight", turn.cast("long")), "weighed")
        words, weight = (int(v or 0) for v in weighed.agg(F.sum("source_size"), F.sum("weight")).first())

        fill = in_order(weighed, F.col("source_size") / F.col("weight"), "rank")
        summed = running(fill, "source_size").withColumnRenamed("_within", "_words")
        filled = stored(running(summed, "weight"), "filled")
        less = offsets(filled, F.sum("source_size")).withColumnRenamed("_before", "_words_before")
        less = stored(less.join(offsets(filled, F.sum("weight")), "_part"), "less")
        used = F.lit(words) - epochs * (F.col("_words_before") + F.col("_words"))
        level = used.cast("double") / (F.lit(weight) - F.col("_before") - F.col("_within")).cast("double")
        limit = F.col("source_size") * F.lit(float(epochs))
        levelled = filled.join(less, "_part").withColumn("level", level)
        known = levelled.withColumn("stops", limit <= F.col("level") * F.col("weight"))
        goals = known.select("source", "source_size", "rank", "start", "weight", "level", "stops")
        goals = stored(goals, "levels", keep=True)
    unit = goals.agg(F.max(F.when(~F.col("stops"), F.col("level")))).first()[0]
    target = limit if unit is None else F.when(F.col("stops"), limit).otherwise(F.least(limit, F.lit(unit) * F.col("weight")))
    return goals.select("source", "source_size", "rank", "start", F.round(target, 6).alias("target"))


def mix(docs: DataFrame, seed: int = SEED, keep: list[str] | None = None, store: bool = True) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``; columns of these names
    are replaced, every row stays and so do the columns of ``keep`` (all, if it is None).

    A row's size is its number of words. Each source's rows are put in the order of a hash of
    their id; prefix sums of sizes give each row its place among the words of its source. Whole
    epochs are repeated while the target holds them, and the last one is cut at exactly the
    words that are left, so that the words taken of a source are its target rounded to a whole
    number, and no row is taken more than three times. Null and blank texts have size 0, a null
    source is a source of its own, null ids come last in the order, equal ids are told apart by
    size and then by a hash of the whole row, rows equal in all of it are exchangeable. An
    empty table gives an empty result.
    """
    added = ("size", "source_size", "target", "taken")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    plain, names = renamed(docs)
    doc = F.col(names["doc_id"])
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), doc.cast("string")).cast("binary"))
    size = F.coalesce(F.regexp_count(F.col(names["text"]), F.lit(WORD)), F.lit(0)).cast("long")
    rows = plain.select(
        *[names[c] for c in kept],
        size.alias("size"),
        F.col(names["source"]).alias("_source"),
        doc.isNull().alias("_last"),
        key.alias("_key"),
        F.xxhash64(*plain.columns).alias("_row"),
    )
    with scope(docs.sparkSession):
        # The sums, the ranges and the rows dealt out by them all need the words: stored, they are
        # counted once. Where whole texts go along, counting again costs less than writing them.
        rows = stored(rows, "sized") if store else rows
        sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
        goals = stored(targets(sizes), "targets")
        ranked = rows.join(goals, F.col("_source").eqNullSafe(goals["source"])).drop(goals["source"])
        ordered = in_order(ranked, "rank", "_last", "_key", "size", "_row")
        placed = stored(running(ordered, "size"), "mixed", keep=True)
        starts = stored(offsets(placed, F.sum("size")), "starts", keep=True)
    joined = placed.join(F.broadcast(starts), "_part")
    words = F.round("target").cast("long")
    before = F.col("_before") + F.col("_within") - F.col("start")
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    rest = words - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    taken = (whole * F.col("size") + part).cast("long")
    return joined.select(*[F.col(names[c]).alias(c) for c in kept], "size", "source_size", "target", taken.alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    The document at which a source's target is reached comes last with the words left of it.
    """
    size, total, copy = F.col("_size"), F.col("_taken"), F.col("_copy")
    plain, where = renamed(docs)
    known = [F.col(where[c]).alias(c) for c in ("doc_id", "text", "source")]
    taken = mix(plain.select("*", *known), seed, plain.columns, store=False)
    taken = taken.toDF(*plain.columns, "_size", "_source_size", "_target", "_taken")
    times = F.when(size > 0, F.ceil(total / size)).otherwise(0).cast("int")
    copies = taken.where(total > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    left = total - (copy - 1) * size
    text = F.col(where["text"])
    parts = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    blank = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    cut = F.array_join(F.slice(parts, F.lit(1), (left + blank).cast("int")), "")
    result = copies.withColumn("_whole", left >= size).withColumn("_text", F.when(left >= size, text).otherwise(cut))
    changed = {where["text"]: F.col("_text")}
    if "n_chars" in where:
        length = F.length("_text").cast(docs.schema["n_chars"].dataType)
        changed[where["n_chars"]] = F.when(F.col("_whole"), F.col(where["n_chars"])).otherwise(length)
    return result.select(*[changed.get(w, F.col(w)).alias(c) for c, w in where.items()])
