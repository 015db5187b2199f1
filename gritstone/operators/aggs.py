"""Aggregations: conditional, weighted, distributional, and profiles of whole tables in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritstone.operators.windows import first_per, ratio


def flags(key: str, values: Sequence, prefix: str = "is_") -> list[Column]:
    """A row per entity and attribute becomes a wide row of 0/1 flags: one expression for each value."""
    return [F.max(F.when(F.col(key) == v, 1).otherwise(0)).alias(f"{prefix}{v}") for v in values]


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of products over the sum of weights; rows with a null in either count in neither."""
    both = value.isNotNull() & weight.isNotNull()
    return ratio(F.sum(F.when(both, value * weight)), F.sum(F.when(both, weight)))


def entropy(p: Column) -> Column:
    """Normalised Shannon entropy of shares that sum to 1 over a group: 1 for equal shares, null for a single one."""
    return ratio(-F.sum(p * F.ln(F.nullif(p, F.lit(0.0)))), F.ln(F.nullif(F.count("*"), F.lit(1)).cast("double")))


def shares(df: DataFrame, keys: Sequence[str], of: Sequence[str], name: str = "share") -> DataFrame:
    """Counts of (keys, of) with their share among the keys: a window over an aggregate."""
    n = df.groupBy(*keys, *of).agg(F.count("*").alias("n"))
    return n.withColumn(name, F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def grid_shares(x: Column, y: Column, cells: int = 5, top: float = 100.0, prefix: str = "cell") -> list[Column]:
    """Share of a group's rows in each cell of a square grid over [0, top); rows at top or with nulls are in no cell but count."""
    step = top / cells
    return [
        F.avg(F.when((x >= i * step) & (x < (i + 1) * step) & (y >= k * step) & (y < (k + 1) * step), 1.0).otherwise(0.0)).alias(f"{prefix}_{i}_{k}")
        for i in range(cells)
        for k in range(cells)
    ]


def geometric_value(n: Column, x: Column, y: Column) -> Column:
    """Count weighted by nearness of the mean position to the goal's centre at (100, 50)."""
    return n / (1.0 + F.sqrt(F.pow(100.0 - F.avg(x), 2) + F.pow(50.0 - F.avg(y), 2)))


def degrees(edges: DataFrame, keys: Sequence[str], src: str, dst: str, weight: str) -> DataFrame:
    """In and out degrees, weights, share of the weight and a centrality proxy of each node of directed graphs by key."""
    ends = edges.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col(src).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), F.col(weight).alias("wo"), F.lit(0).cast("long").alias("wi"), F.col(dst).alias("other")),
                F.struct(F.col(dst).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), F.lit(0).cast("long").alias("wo"), F.col(weight).alias("wi"), F.col(src).alias("other")),
            )
        ).alias("e"),
    )
    by = ends.groupBy(*keys, "e.node").agg(
        F.count_distinct(F.when(F.col("e.o") == 1, F.col("e.other"))).alias("degree_out"),
        F.count_distinct(F.when(F.col("e.i") == 1, F.col("e.other"))).alias("degree_in"),
        F.sum("e.wo").alias("weight_out"),
        F.sum("e.wi").alias("weight_in"),
    )
    all_ = Window.partitionBy(*keys)
    n = F.count("*").over(all_)
    pairs = F.nullif(n * (n - 1), F.lit(0))
    return by.withColumn("weight_share", ratio(F.col("weight_out"), F.sum("weight_out").over(all_))).withColumn(
        "centrality", F.round(F.col("degree_in") * F.col("degree_out") / pairs, 4)
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """column, n_null, n and filled share of each column, by key: one aggregation, turned to rows."""
    cols = list(columns) if columns else [c for c in df.columns if c not in by]
    wide = df.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    long = wide.unpivot([*by, "n"], cols, "column", "n_null")
    return long.select(*by, "column", "n_null", "n", (1.0 - F.col("n_null") / F.nullif("n", F.lit(0))).alias("filled"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """x, y and Pearson's r of each pair, over the rows in which no column is null; one pass."""
    whole = df.select(*columns).dropna()
    pairs = [(a, b) for a in columns for b in columns]
    wide = whole.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    long = wide.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    parts = F.split("pair", r"\|")
    return long.select(parts[0].alias("x"), parts[1].alias("y"), "r")


def binned(c: Column, edges: Sequence[float]) -> Column:
    """Labels of right-closed bins (low, high]; null outside."""
    out = None
    for lo, hi in zip(edges, edges[1:]):
        p, label = (c > lo) & (c <= hi), F.lit(f"({lo:g}, {hi:g}]")
        out = F.when(p, label) if out is None else out.when(p, label)
    assert out is not None
    return out


def sweep(df: DataFrame, grid: Sequence[dict[str, float]], condition: Column, measures: Sequence[Column]) -> DataFrame:
    """Measures of the rows that pass, for each point of a parameter grid. The grid is a short list, and is broadcast."""
    spark = df.sparkSession
    names = list(grid[0])
    points = spark.createDataFrame([tuple(float(p[n]) for n in names) for p in grid], ", ".join(f"{n} double" for n in names))
    return df.join(F.broadcast(points), condition).groupBy(*names).agg(*measures)


def compare_distributions(a: DataFrame, b: DataFrame, c: str) -> DataFrame:
    """Share of each value in two tables and their difference; values that one lacks count 0."""
    def of(df: DataFrame, name: str) -> DataFrame:
        n = df.groupBy(c).count()
        return n.select(F.col(c).alias(f"__{name}"), (F.col("count") / F.sum("count").over(Window.partitionBy(F.lit(0)))).alias(name))

    both = of(a, "a").join(of(b, "b"), F.col("__a").eqNullSafe(F.col("__b")), "full")
    x, y = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return both.select(F.coalesce("__a", "__b").alias(c), x.alias("share_a"), y.alias("share_b"), (x - y).alias("difference"))


def argmax_column(columns: Sequence[str]) -> Column:
    """Name of the column of the largest value, the first of equals; null if all are null."""
    top = F.greatest(*columns)
    out = None
    for c in columns:
        out = F.when(F.col(c) == top, F.lit(c)) if out is None else out.when(F.col(c) == top, F.lit(c))
    assert out is not None
    return out


def best_of_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return first_per(df, keys, order)
