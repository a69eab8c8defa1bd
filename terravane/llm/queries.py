"""The ``opN_`` queries: thin wrappers that apply an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import (
    decontaminate,
    extract,
    language,
    lines,
    mixing,
    quality,
    search,
    sharding,
    simhash,
    tokens,
    units,
    vectors,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, benchmark)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.dedup_units(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, keep=["doc_id"])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The host is the source, a path the source's documents in one language."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score_quality(docs, labels, F.col("source"), F.col("lang"), learn=~language.held_out())


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_line_dedup,
        op3_decontamination,
        op4_substring_dedup,
        op5_embedding_dedup,
        op6_hilbert_shards,
        op7_mixing,
        op8_quality,
        op9_main_text,
        op10_simhash,
        op11_token_counts,
        op12_lexical_search,
        op13_whitening,
    )
}

SQL: dict[str, str] = {
    "op2_line_dedup": r"""
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, text, unnest(range(len(lines))) AS line, unnest(lines) AS content FROM docs
), windows AS (
  SELECT doc_id, line AS start, trim(content) AS a,
         lead(trim(content), 1) OVER w AS b, lead(trim(content), 2) OVER w AS c
  FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY line)
), later AS (
  SELECT doc_id, start, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, start) AS nth
  FROM windows WHERE c IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, start + unnest([0, 1, 2]) AS line FROM later WHERE nth > 1
), kept AS (
  SELECT n.doc_id, string_agg(content, chr(10) ORDER BY line) FILTER (g.line IS NULL) AS text,
         count(*) AS n_lines, count(g.line) AS n_removed
  FROM numbered n LEFT JOIN gone g USING (doc_id, line) GROUP BY n.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(n_lines, 0)::INTEGER AS n_lines, coalesce(n_removed, 0)::INTEGER AS n_removed
FROM docs d LEFT JOIN kept k USING (doc_id)
""",
    "op7_mixing": r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, (rank % 3 + 1)::DOUBLE AS weight, (SELECT sum(source_size) FROM sources)::DOUBLE AS everything FROM sources
), rounds AS (
  SELECT 0 AS step, w.*, false AS full_up, everything / (SELECT sum(weight) FROM weighed) AS unit FROM weighed w
  UNION ALL
  SELECT step + 1, source, source_size, rank, weight, everything, now_full,
         (everything - sum(CASE WHEN now_full THEN 3.0 * source_size ELSE 0 END) OVER ())
           / nullif(sum(CASE WHEN now_full THEN 0 ELSE weight END) OVER (), 0)
  FROM (SELECT *, full_up OR unit IS NULL OR 3.0 * source_size <= unit * weight AS now_full FROM rounds)
  WHERE step < (SELECT count(*) FROM sources)
), goals AS (
  SELECT source, source_size, rank,
         round(CASE WHEN full_up OR unit IS NULL THEN 3.0 * source_size
               ELSE least(3.0 * source_size, unit * weight) END::DOUBLE, 6) AS target
  FROM rounds WHERE step = (SELECT max(step) FROM rounds)
), placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS words,
         coalesce(sum(size) OVER (PARTITION BY rank ORDER BY doc_id IS NULL, md5(concat_ws(':', '42', doc_id::VARCHAR)), size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN words // source_size * size
          + greatest(0, least(size, words % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM placed
""",
    "op12_lexical_search": r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS doc, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), lengths AS (
  SELECT doc, doc_id, count(*) AS n FROM terms GROUP BY doc, doc_id
), totals AS (
  SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lengths
), counted AS (
  SELECT doc, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc, term
), weighed AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, totals GROUP BY term, big_n
), valued AS (
  SELECT doc, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // big_l))) AS value
  FROM counted JOIN lengths USING (doc) JOIN weighed USING (term), totals
), scored AS (
  SELECT item_id, doc, doc_id, sum(value * times)::BIGINT AS score
  FROM valued JOIN (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term) USING (term)
  GROUP BY item_id, doc, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
""",
}
