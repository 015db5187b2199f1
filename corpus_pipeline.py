"""A corpus pipeline of five stages: language, repeated lines, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritstone.llm import langid, linededup, mixing, packing, shinglesets
from gritstone.llm._store import keep


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, or not one letter) go; the others get the language that the model finds.

    Where no document has a language, there is no model: documents with letters stay as they are.
    """
    models = langid.train(docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()))
    if models is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    own = "lang" + "_" * max(map(len, docs.columns))  # no column's name
    found = langid.identify(docs, models, docs.columns, out=(own, own + "_score")).where(F.col(own) != "und")
    return found.select(*(F.col(own).alias(c) if c == "lang" else F.col(c) for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines go from all documents but the first; documents of which nothing is left go."""
    count = "removed" + "_" * max(map(len, docs.columns))  # no column's name
    found = linededup.dedup_lines(docs, count=count)
    return found.where((F.col(count) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; groups link sets of five-word shingles of a Jaccard similarity of 0.8 or more.

    Pairs come from the grid of fingerprints first; sketches of the sets find those that are too far apart in bits.
    """
    return shinglesets.one_of_each(docs, words=5, least=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or the blocks of them that the mix takes, a row for each time."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequences and places."""
    return packing.packed(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: SQL can't express the model of the first stage, the hashes of the second and third, or the tokens of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
