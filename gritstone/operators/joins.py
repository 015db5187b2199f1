"""Joins beyond equality, as windows where the semantics allow it, else as equi joins with a residual condition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.operators.windows import after, first_per
from gritstone.session import ship


def asof_latest(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, values: Sequence[str], strict: bool = True, tie: str | None = None) -> DataFrame:
    """``left`` with the values of the latest right row (strictly) before it, by key.

    One shuffle of the union of both sides by key and a running last value; no pair of rows is made. Among right rows of one time the
    one with the greatest ``tie`` counts.
    """
    names = left.columns
    lrow = F.struct(*names)
    rrow = F.struct(*([F.col(tie).alias("__tie")] if tie else []), *values)
    l = left.select(*keys, F.col(at).alias("__at"), lrow.alias("__l"), F.lit(None).cast(right.select(rrow.alias("r")).schema["r"].dataType).alias("__r"))
    r = right.select(*keys, F.col(right_at).alias("__at"), F.lit(None).cast(left.select(lrow.alias("l")).schema["l"].dataType).alias("__l"), rrow.alias("__r"))
    # Rows of one time: with a strict comparison left rows come first, else right rows do.
    side = F.col("__r").isNull().cast("int")
    order = [F.col("__at").asc_nulls_first(), F.desc(side) if strict else F.asc(side), *([F.col("__r")["__tie"]] if tie else [])]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r).withColumn("__r", F.last("__r", ignorenulls=True).over(w)).where("__l is not null")
    return both.select("__l.*", *(F.when(F.col("__at").isNotNull(), F.col("__r")[v]).alias(v) for v in values))


def asof_running(df: DataFrame, keys: Sequence[str], at: str, value: Column, strict: bool = False) -> Column:
    """Highest value among a key's rows up to (or before) the row's time, rows of its own time included unless strict."""
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(Window.unboundedPreceding, -1 if strict else 0)
    return F.max(value).over(w)


def next_after(value: Column, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """The first value that isn't null in the rows after."""
    return F.first(value, ignorenulls=True).over(after(keys, order))


def band(left: DataFrame, right: DataFrame, keys: Sequence[str], condition: Column, how: str = "inner") -> DataFrame:
    """Equality on the keys with a range condition kept within the join, so pairs outside of the band are never made."""
    on = [left[k] == right[k] for k in keys]
    return left.join(right, [*on, condition], how)


def binned_band(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, width: float) -> DataFrame:
    """Pairs with |at - right_at| <= width: right rows go to three bins of that width, so hot keys are cut along the range too.

    Clashing right columns should be renamed before.
    """
    l = left.withColumn("__bin", F.floor(F.col(at) / width).cast("long"))
    r = right.withColumn("__bin", F.explode(F.expr(f"sequence(cast(floor({right_at} / {width}) as bigint) - 1, cast(floor({right_at} / {width}) as bigint) + 1)")))
    return l.join(r, [*keys, "__bin"]).where(F.abs(F.col(at) - F.col(right_at)) <= width).drop("__bin")


def days_before(keys: Sequence[str], date: Column, first: int, last: int = 1):
    """A window of the rows dated from ``first`` to ``last`` days before the row's date."""
    day = F.datediff(date, F.lit("1970-01-01"))
    return Window.partitionBy(*keys).orderBy(day).rangeBetween(-first, -last)


def semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_semi")


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner; unlike NOT IN, nulls in ``other`` don't empty the result."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def flagged(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` with a boolean: whether the keys occur in ``other`` (EXISTS as a value)."""
    there = other.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(there, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(False)))


def covered(df: DataFrame, value: Column, is_covered: Column) -> Column:
    """0 where a covered row has no value, null where the row isn't covered."""
    return F.when(is_covered, F.coalesce(value, F.lit(0)))


def opponent(df: DataFrame, match: str, team: str, columns: Sequence[str], prefix: str = "opp_") -> DataFrame:
    """Rows of two teams a match beside the other team's columns."""
    other = df.select(F.col(match).alias("__m"), F.col(team).alias(f"{prefix}{team}"), *(F.col(c).alias(f"{prefix}{c}") for c in columns))
    return df.join(other, (F.col(match) == F.col("__m")) & (F.col(team) != F.col(f"{prefix}{team}"))).drop("__m")


def chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All keys of all frames with each frame's columns: a full outer join by left joins on the union of keys."""
    base = frames[0].select(*keys)
    for f in frames[1:]:
        base = base.union(f.select(*keys))
    out = base.distinct()
    for f in frames:
        out = out.join(f, list(keys), "left")
    return out


def best_lookup(df: DataFrame, candidates: Sequence[Column], default: Column, name: str) -> DataFrame:
    """The first candidate that isn't null, else the default."""
    return df.withColumn(name, F.coalesce(*candidates, default))


def token_sort(c: Column) -> Column:
    """Lower-cased words in order: what a token-sort ratio compares."""
    return F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), " ")), " ")


def most_edits(n: int, least: float) -> int:
    """Inserted and deleted letters that strings of ``n`` letters together may differ by at a ratio of ``least``.

    Their number is even if ``n`` is.
    """
    most = int(n * (1 - least / 100) + 1e-9)
    return most - (most - n) % 2


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each letter of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    left = full
    for c in b:
        both = left & places.get(c, 0)
        left = ((left + both) | (left - both)) & full
    return len(a) - left.bit_count()


def fuzzy_best(names: DataFrame, dimension: DataFrame, name: str, entry: str, least: float = 90.0) -> DataFrame:
    """Each distinct name with its most similar dimension entry of at least ``least`` (of 100).

    Similarity is the token-sort ratio: 200 common letters in order / both lengths, of sorted words; rounded to a whole number (half to
    even) it must be ``least`` or more, as in the library of the source. Complete: an entry is cut into
    one segment more than the letters that may differ, so one is whole in the name, shifted by those letters at most; pairs that
    share such a segment are scored. Ties go to the first entry.
    """
    if not 0.5 < least <= 100:
        raise ValueError("least must be over 0.5 and at most 100")
    ship(names.sparkSession)
    low = least - 0.5

    def cuts(own: int, other: int) -> list[tuple[int, int]]:
        n = most_edits(own + other, low) + 1
        return [(i * own // n, (i + 1) * own // n) for i in range(n)]

    def partners(n: int) -> range:
        ratio = low / (200 - low)
        return range(int(n * ratio), int(n / ratio) + 2)

    def keys(s: str, is_entry: bool) -> set[str]:
        out = set()
        for n in partners(len(s)):
            most = most_edits(len(s) + n, low)
            if abs(len(s) - n) > most:
                continue
            la, lb = (n, len(s)) if is_entry else (len(s), n)
            for i, (x, y) in enumerate(cuts(lb, la)):
                starts = [x] if is_entry else range(max(0, x - most), min(la - (y - x), x + most) + 1)
                out.update(f"{la} {lb} {i} {s[k : k + y - x]}" for k in starts)
        return out

    def keyed(df: DataFrame, c: str, out: str, is_entry: bool) -> DataFrame:
        own = df.select(F.col(c).alias(out)).where(F.col(out).isNotNull()).distinct().withColumn(f"{out}_s", token_sort(F.col(out)))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    k = list(keys(s, is_entry))
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array([x] * len(k), pa.string()), pa.array([s] * len(k), pa.string())], names=["__k", out, f"{out}_s"])

        return own.mapInArrow(deal, f"__k string, {out} string, {out}_s string")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = [200.0 * common_letters(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["a", "b", "score"])

    pairs = keyed(names, name, "a", False).join(keyed(dimension, entry, "b", True), "__k").select("a", "b", "a_s", "b_s").distinct()
    scored = pairs.mapInArrow(score, "a string, b string, score double").where(F.bround("score") >= least)
    best = first_per(scored, ["a"], [F.desc("score"), "b"])
    return best.select(F.col("a").alias(name), F.col("b").alias(entry), F.round("score", 4).alias("score"))
