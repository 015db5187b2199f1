"""Incremental loads: by watermark, by new keys, and as a stream that ends when its input does."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gritstone.sources.sinks import exists, merged_insert, merged_replace, replace


def above_watermark(source: DataFrame, target: DataFrame | None, mark: str) -> DataFrame:
    """Rows whose mark is strictly above the target's highest; the mark is one row, so this adds no shuffle of the source."""
    if target is None:
        return source
    top = target.agg(F.max(mark).alias("__top"))
    return source.join(F.broadcast(top), F.col("__top").isNull() | (F.col(mark) > F.col("__top"))).drop("__top")


def unseen(source: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of keys that the target lacks; late rows of seen keys are left out."""
    return source if target is None else source.join(target.select(*keys).distinct(), list(keys), "left_anti")


def unseen_results(compute: Callable[[DataFrame], DataFrame], source: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Computed over the full history, then only unseen keys: windows see all rows before theirs."""
    return unseen(compute(source), target, keys)


def resume(source: DataFrame, done: DataFrame, keys: Sequence[str], skip_existing: bool = False, missing: str | None = None, only: Column | None = None, most: int | None = None) -> DataFrame:
    """The rows that an interrupted load still has to process.

    ``skip_existing`` leaves out keys that ``done`` has; ``missing`` leaves out only those whose column of that name is filled there.
    ``only`` is a predicate such as a season; ``most`` takes so many keys, the smallest first.
    """
    out = source if only is None else source.where(only)
    if missing is not None:
        out = unseen(out, done.where(F.col(missing).isNotNull()), keys)
    elif skip_existing:
        out = unseen(out, done, keys)
    if most is not None:
        out = out.join(out.select(*keys).distinct().orderBy(*keys).limit(most), list(keys), "left_semi")
    return out


def refresh(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame] = lambda df: df, full: bool = False, mode: str = "keys", mark: str | None = None) -> DataFrame:
    """Bring a stored table up to date.

    mode ``keys``: unseen results over the full history are added. mode ``mark``: rows above the watermark are computed and replace
    those of their keys. ``full`` computes all anew.
    """
    if full or not exists(spark, path):
        return replace(compute(source), path)
    old = spark.read.parquet(path)
    if mode == "mark":
        assert mark is not None
        return replace(merged_replace(old, compute(above_watermark(source, old, mark)), keys), path)
    return replace(merged_insert(old, unseen_results(compute, source, old, keys), keys), path)


def stream_once(spark: SparkSession, folder: str, schema, path: str, keys: Sequence[str], checkpoint: str, compute: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Files not yet seen, as a stream with a checkpoint that ends when all are read; each batch replaces the rows of its keys.

    A batch that is run again after a failure replaces its own rows, so each file counts once.
    """

    def batch(df: DataFrame, _: int) -> None:
        new = compute(df)
        session = df.sparkSession
        if exists(session, path):
            new = merged_replace(session.read.parquet(path), new, keys)
        replace(new, path)

    q = spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(path)


def windowed_counts(stream: DataFrame, at: str, key: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and key, with a bound on late rows; works on streams and tables alike."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
