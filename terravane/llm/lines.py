"""Line dedup by winnowing: selected window minima, matched positions, runs extended both ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.tables import stored

#: Lines in a window: a run of at least so many lines that occurs again is found for certain.
WINDOW = 3


def fingerprints(texts: DataFrame, width: int) -> DataFrame:
    """``pos``, ``mark`` and ``around`` for every line that is selected, with ``doc_id`` and ``key``.

    Of each window of ``width`` lines the one with the least hash is selected, the last of equal
    ones, so that equal windows select the same line: about ``2 / (width + 1)`` of all lines in
    the end. ``around`` holds, for every window that selects the line, how many lines of it lie
    before the line and two digests of the whole window.
    """
    lines = F.split("text", "\n")
    low = F.transform(lines, lambda line: F.xxhash64(F.trim(line)))
    high = F.transform(lines, lambda line: F.xxhash64(F.lit(1), F.trim(line)))
    hashed = texts.select("doc_id", "key", low.alias("_low"), high.alias("_high")).where(F.size("_low") >= width)
    marked = F.transform("_low", lambda h, i: F.struct(h.alias("mark"), (-i).alias("back")))
    starts = F.sequence(F.lit(1), F.size("_low") - width + 1)
    ranked = hashed.select("*", marked.alias("_marked"), starts.alias("_starts"))
    least = F.transform("_starts", lambda s: F.array_min(F.slice("_marked", s, F.lit(width))))
    chosen = ranked.select("*", least.alias("_least"))

    def around(pos: Column) -> Column:
        first = F.greatest(pos - (width - 1), F.lit(0))
        last = F.least(pos, F.size("_least") - 1)
        own = F.filter(F.sequence(first, last), lambda s: F.get("_least", s) == F.get("_marked", pos))

        def window(s: Column) -> Column:
            digests = [F.xxhash64(F.slice(c, s + 1, F.lit(width))) for c in ("_low", "_high")]
            return F.struct((pos - s).alias("back"), digests[0].alias("low"), digests[1].alias("high"))

        return F.transform(own, window)

    places = F.array_distinct(F.transform("_least", lambda m: -m["back"]))
    rows = F.transform(
        places, lambda pos: F.struct(pos.alias("pos"), F.get("_low", pos).alias("mark"), around(pos).alias("around"))
    )
    return chosen.select("doc_id", "key", F.inline(rows))


def _is(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def dedup_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Documents without the runs of lines that an earlier document or line already had.

    Lines end at ``\\n`` and compare without spaces at their ends. Of every ``width`` lines in a
    row the one with the least hash is selected as fingerprint, so two equal runs of that many
    lines select the same one. Only fingerprints are stored, and only those met at several places
    go on. There, places are matched by the lines around them: a fingerprint with an earlier
    place of equal lines, in the order of ``doc_id`` (nulls last), a hash of the text, and line, is
    extended back and forth over as many lines as its matching windows reach, and what its run
    and those of its neighbours cover goes, however long. In a passage that repeats within itself
    every later window goes as well.

    Returns ``doc_id``, ``text``, ``n_lines`` and ``n_removed`` for each row; other columns are
    not read. A null text stays null with no lines, an empty one is one line; rows equal in id
    and text are one document and get the same result; an empty table gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("key", F.xxhash64("text"))
    marks = stored(fingerprints(base.where("text is not null"), width), "fingerprints")
    met = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    several = marks.join(stored(met, "met"), "mark", "left_semi")
    spread = several.select("doc_id", "key", "pos", "mark", F.explode("around").alias("w"))
    places = stored(spread.select("doc_id", "key", "pos", "mark", "w.*"), "places")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", (F.col("pos") - F.col("back")).alias("start"))
    first = places.groupBy("mark", "low", "high").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = first.where("first <> last").select("mark", "low", "high", "first.doc_id", "first.key", "first.start")
    repeated = stored(repeated.toDF("mark", "low", "high", "_doc", "_key", "_start"), "repeated")
    own = _is("doc_id", "_doc") & (F.col("key") == F.col("_key")) & (F.col("pos") - F.col("back") == F.col("_start"))
    later = places.join(repeated, ["mark", "low", "high"]).where(~own)
    back, forth = F.max("back"), width - 1 - F.min("back")
    runs = later.groupBy("doc_id", "key", "pos").agg((F.col("pos") - back).alias("start"), (F.col("pos") + forth).alias("stop"))
    # What stays between the runs of a document: a run covers up to the furthest end so far.
    order = Window.partitionBy("doc_id", "key").orderBy("start", "stop")
    covered = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    gaps = stored(runs.withColumn("_from", covered + 1), "runs")
    gap = F.when(F.col("_from") < F.col("start"), F.struct(F.col("_from").alias("start"), (F.col("start") - F.col("_from")).alias("n")))
    kept = gaps.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(gap)).alias("_gaps"), F.max("stop").alias("_last"))
    kept = kept.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "_gaps", "_last")
    # The hint keeps one plan at every size: the texts move once.
    whole = base.join(stored(kept, "gaps").hint("merge"), _is("doc_id", "_doc") & (F.col("key") == F.col("_key")), "left")
    marked = whole.select("doc_id", "text", F.split("text", "\n").alias("_lines"), "_gaps", "_last")
    rest = F.struct((F.col("_last") + 1).alias("start"), (F.size("_lines") - F.col("_last") - 1).alias("n"))
    parts = F.transform(F.array_append("_gaps", rest), lambda g: F.slice("_lines", g["start"] + 1, g["n"]))
    text = F.when(F.col("_last").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(parts), "\n"))
    left = F.aggregate("_gaps", F.size("_lines") - F.col("_last") - 1, lambda n, g: n + g["n"])
    return marked.select(
        "doc_id",
        text.alias("text"),
        F.coalesce(F.size("_lines"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_lines") - left, F.lit(0)).alias("n_removed"),
    )
