"""Corpus preparation: language, near-duplicates, benchmark leaks, mix, shards.

Each stage takes the documents that the one before it kept and returns documents, all columns,
but for the last one, which assigns the shards. Columns of any name travel along, an empty table
gives an empty one, and repeated rows are rows of their own until the near copies are taken out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terravane.llm import copies, decontaminate, language, mixing, sharding
from terravane.llm.tables import stored

#: A document whose best language has less than this share of its n-grams is rejected.
LEAST_SCORE = 0.25


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without a letter and those whose
    n-grams none of the languages has go, null, empty and blank texts among them. Null ids and
    null labels teach nothing, their documents are judged like any other; of languages that fit
    equally the first by name counts; a text of any length is judged whole."""
    return language.keep_known(docs, language.fit(docs), LEAST_SCORE)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, Jaccard similarity >= 0.8): the
    one with the smallest id. SimHash fingerprints propose the groups, min-hash bands the copies that
    differ by more bits, the whole sets of shingles decide. Null ids come last, equal ids are told apart by a hash of the row, of rows equal
    in all columns one stays, and texts without a word are copies of each other."""
    return copies.first_of_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, whole texts searched. A null text holds
    nothing and stays; items that are null or without a letter or digit match nothing."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document comes as often as its source's target asks for. A null source
    is a source of its own, null ids come last in its order, equal ids are told apart by size and a
    hash of the row; documents without a word add nothing and go."""
    return mixing.mixed(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row along the curve; nulls come last in their order, rows of a
    cell go by text checksum and id."""
    return sharding.shard(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near copies", keep_first_of_near_copies),
    ("benchmark", drop_benchmark_leaks),
    ("mix", mix_sources),
    ("shards", assign_shards),
]

#: None: the stages hash shingles and n-grams in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
