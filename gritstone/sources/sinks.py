"""Write modes of tables in folders. Each replaces a table by a new version, so a failed write leaves the old one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def replace(df: DataFrame, path: str) -> DataFrame:
    """Write beside the table, then put the new version in its place; ``df`` may read the table itself.

    The old version is moved aside first and deleted last. If the new one cannot take its place, the old one is moved back; after a crash
    between the two moves, it stands beside the path under a name that ends in ``.old``.
    """
    spark = df.sparkSession
    new = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.parquet(new)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    a, b, old = hadoop.Path(new), hadoop.Path(path), hadoop.Path(f"{new}.old")
    fs = b.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = fs.exists(b)
    if had and not fs.rename(b, old):
        fs.delete(a, True)
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(a, b):
        if had:
            fs.rename(old, b)
        raise OSError(f"cannot put the new version of {path} in place")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def stage(df: DataFrame, path: str, name: str) -> DataFrame:
    """CREATE TEMP TABLE AS: the result written once, and a view of that name on it."""
    out = replace(df, path)
    out.createOrReplaceTempView(name)
    return out


def partitioned(df: DataFrame, path: str, keys: Sequence[str], force: bool = False) -> None:
    """A folder for each key; keys that are there already are left alone unless forced."""
    spark = df.sparkSession
    if exists(spark, path) and not force:
        df = df.join(spark.read.parquet(path).select(*keys).distinct(), list(keys), "left_anti")
    mode = "overwrite" if force else "append"
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*keys).parquet(path)


def merged_insert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Old rows and the new rows of keys not seen; of new rows of one key the first by ``order`` counts."""
    fresh = latest(new, keys, order) if order else new.dropDuplicates(list(keys))
    return old.unionByName(fresh.join(old.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def merged_replace(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete by key, then insert: the incremental merge. Columns of either side are kept, null where a side lacks them."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).where("__n = 1").drop("__n")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row of the greatest version of each key; among equals the new one."""
    both = old.withColumn("__s", F.lit(0)).unionByName(new.withColumn("__s", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, [F.desc_nulls_last(version), F.desc("__s")]).drop("__s")


def updated(df: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """UPDATE ... FROM: columns of ``values`` replace those of rows with a partner; ``values`` has a row a key at most."""
    own = [c for c in values.columns if c not in keys]
    found = values.select(*keys, *(F.col(c).alias(f"__{c}") for c in own), F.lit(True).alias("__hit"))
    joined = df.join(found, list(keys), "left")
    new = [F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c) if c in df.columns else F.lit(None)).alias(c) for c in own]
    return joined.select(*(F.col(c) for c in df.columns if c not in own), *new)


def flagged(df: DataFrame, done: DataFrame, keys: Sequence[str], flag: str, reason: str | None = None) -> DataFrame:
    """Rows of processed keys get the flag, and the reason where one is given."""
    there = done.select(*keys, *([F.col(reason).alias("__reason")] if reason else []), F.lit(True).alias("__hit"))
    out = df.join(there, list(keys), "left").withColumn(flag, F.coalesce("__hit", F.col(flag) if flag in df.columns else F.lit(False)))
    if reason:
        out = out.withColumn(reason, F.coalesce("__reason", F.col(reason) if reason in df.columns else F.lit(None)))
    return out.drop("__hit", "__reason")


def csv_export(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small report table as text; more rows than ``most`` are an error, as reports are of aggregates."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows: a report is of aggregates")
    line = lambda xs: "| " + " | ".join("" if x is None else str(x) for x in xs) + " |"
    return "\n".join([f"## {title}", "", line(df.columns), line(["---"] * len(df.columns)), *map(line, rows), ""])
