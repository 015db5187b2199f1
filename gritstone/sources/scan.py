"""Scans: schema-tolerant Parquet, CSV and JSON, with lineage from file paths and times."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files as one table; columns that a file lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (spark.read.parquet(p) for p in paths))


def csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None, encodings: Sequence[str] = ("UTF-8", "ISO-8859-1"), **options) -> DataFrame:
    """CSV with a header, as text unless a schema is given; files that aren't valid in the first encoding are read in the next.

    A file is invalid if decoding leaves a replacement character. Each file is judged by itself.
    """
    def read(encoding: str) -> DataFrame:
        reader = spark.read.option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE").options(**options)
        return (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)

    first = read(encodings[0])
    if len(encodings) < 2:
        return first
    text = [c for c, k in first.dtypes if k == "string"]
    broken = reduce(lambda a, b: a | b, (F.coalesce(F.col(c).contains("�"), F.lit(False)) for c in text)) if text else F.lit(False)
    named = first.withColumn("__f", F.col("_metadata.file_path"))
    bad = named.where(broken).select("__f").distinct()
    again = read(encodings[1]).withColumn("__f", F.col("_metadata.file_path")).join(bad, "__f", "left_semi")
    return named.join(bad, "__f", "left_anti").unionByName(again, allowMissingColumns=True).drop("__f")


def present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The named columns that are there, renamed: select-if-present."""
    return df.select(*(F.col(a).alias(b) for a, b in names.items() if a in df.columns))


def first_present(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns by the first of their aliases that is there; those that none serves are left out."""
    out = []
    for name, options in aliases.items():
        found = next((c for c in options if c in df.columns), None)
        if found:
            out.append(F.col(found).alias(name))
    return df.select(*out)


def seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def json_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object a file, plain or gzip, in all folders below."""
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(schema).json(path)


def path_part(pattern: str, group: int = 1, path: Column | None = None) -> Column:
    """A part of the file's path, null where the pattern isn't found."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_path") if path is None else path, pattern, group), F.lit(""))


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """``source`` and ``scraped_at``, the file's time as ISO text, by which incremental loads compare."""
    return df.withColumn("source", F.lit(source)).withColumn("scraped_at", F.date_format("_metadata.file_modification_time", "yyyy-MM-dd'T'HH:mm:ss"))


def embedded_json(text: Column, start: str, schema: str) -> Column:
    """A JSON object within a page's script, after the text that a pattern finds."""
    return F.from_json(F.regexp_extract(text, start + r"\s*(\{.*\})", 1), schema)


def tables_like(spark: SparkSession, pattern: str) -> DataFrame:
    """name, column and type of the catalog's tables and views whose names match."""
    rows = [(x.name, c.name, c.dataType) for x in spark.catalog.listTables(pattern=pattern) for c in spark.catalog.listColumns(x.name)]
    return spark.createDataFrame(rows, "name string, column string, type string")


def subset(spark: SparkSession, source: str, target: str, predicates: Mapping[str, str]) -> dict[str, DataFrame]:
    """Copies of the tables of a folder, each filtered: a small fixture of a large store."""
    out = {}
    for name, predicate in predicates.items():
        spark.read.parquet(f"{source}/{name}").where(predicate).write.mode("overwrite").parquet(f"{target}/{name}")
        out[name] = spark.read.parquet(f"{target}/{name}")
    return out


def register(spark: SparkSession, name: str, table) -> DataFrame:
    """An Arrow table or pandas frame of the driver as a relation with a name for SQL."""
    out = spark.createDataFrame(table)
    out.createOrReplaceTempView(name)
    return out
