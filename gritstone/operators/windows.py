"""Window specifications and expressions over ordered rows. All are Catalyst expressions; equal specs share one sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def ordered(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def previous(keys: Sequence[str], order: Sequence[str | Column], n: int) -> WindowSpec:
    """The n rows before the current one, which itself stays out."""
    return ordered(keys, order).rowsBetween(-n, -1)


def before(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    """All rows before the current one."""
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def until(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    """All rows up to and with the current one."""
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, 0)


def after(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    """All rows after the current one."""
    return ordered(keys, order).rowsBetween(1, Window.unboundedFollowing)


def whole(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.nullif(b, F.lit(0))


def rolling(columns: dict[str, Column], keys: Sequence[str], order: Sequence[str | Column], sizes: Sequence[int] = (3, 5, 10)) -> list[Column]:
    """Means of each expression over the previous rows, for each size: ``<name>_<size>``."""
    return [F.avg(c).over(previous(keys, order, n)).alias(f"{name}_{n}") for n in sizes for name, c in columns.items()]


def rolling_ratio(columns: dict[str, tuple[Column, Column]], keys: Sequence[str], order: Sequence[str | Column], sizes: Sequence[int] = (3, 5, 10)) -> list[Column]:
    """Ratios of sums over the previous rows, for each size."""
    return [
        ratio(F.sum(a).over(w), F.sum(b).over(w)).alias(f"{name}_{n}") for n in sizes for w in [previous(keys, order, n)] for name, (a, b) in columns.items()
    ]


def island_id(starts: Column, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Number of starts up to the row: gaps and islands."""
    return F.sum(F.when(starts, 1).otherwise(0)).over(until(keys, order))


def changes(c: Column, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Whether the value differs from the row before; the first row of a key counts as a change."""
    w = ordered(keys, order)
    return (F.row_number().over(w) == 1) | ~c.eqNullSafe(F.lag(c).over(w))


def carried(c: Column, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """The last value that isn't null, up to the row."""
    return F.last(c, ignorenulls=True).over(until(keys, order))


def last_known(c: Column, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """The last value that isn't null before the row: lag ignoring nulls."""
    return F.last(c, ignorenulls=True).over(before(keys, order))


def next_known(c: Column, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """The first value that isn't null after the row."""
    return F.first(c, ignorenulls=True).over(after(keys, order))


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """The first n rows of each key: what QUALIFY or DISTINCT ON select. Spark limits groups before it shuffles them."""
    return df.withColumn("__n", F.row_number().over(ordered(keys, order))).where(F.col("__n") <= n).drop("__n")


def familiarity(c: str, keys: Sequence[str], order: Sequence[str | Column], n: int = 5) -> Column:
    """How many of the n rows before have the row's value; null in the first row."""
    w = ordered(keys, order)
    same = [F.when(F.lag(c, i).over(w) == F.col(c), 1).otherwise(0) for i in range(1, n + 1)]
    return F.when(F.lag(c, 1).over(w).isNull(), None).otherwise(sum(same[1:], same[0]))


def drawdown(balance: Column, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """(balance - highest so far) / highest so far."""
    top = F.max(balance).over(until(keys, order))
    return ratio(balance - top, top)


def longest_streak(df: DataFrame, flag: Column, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Length of the longest run of rows with the flag, by key."""
    w = ordered(keys, order)
    run = df.withColumn("__f", F.coalesce(flag, F.lit(False))).withColumn("__r", F.row_number().over(w))
    run = run.withColumn("__g", F.col("__r") - F.sum(F.col("__f").cast("int")).over(until(keys, order)))
    lengths = run.where("__f").groupBy(*keys, "__g").agg(F.count("*").alias("__n")).groupBy(*keys).agg(F.max("__n").alias("longest_streak"))
    return df.select(*keys).distinct().join(lengths, list(keys), "left").fillna(0, ["longest_streak"])
