"""The registered queries of this subpackage's operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritstone.llm import langid, linededup, mixing, packing, pii, simhash, spotsigs, tokencount, toxicity, vptree
from gritstone.llm._store import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out())
    scorer = toxicity.train(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, scorer, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(documents(spark, sf_dir))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    spans = pii.spans_text(F.sort_array(F.concat("base", "added"))).alias("spans")
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"), spans, F.size("added").cast("long").alias("n_added"))


def op5_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vptree.nearest(vptree.build(vectors, k=5), vectors.where("vec_id % 50 = 0"), k=5, relax=1.05)


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_neighbours(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), words=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(~langid.held_out() & F.col("doc_id").isNotNull()))
    return langid.identify(docs.withColumn("held_out", langid.held_out()), model, ["doc_id", "held_out"])


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(documents(spark, sf_dir))
    return found.select("doc_id", "text", "n_chars", "removed_lines")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {}
