"""Data contracts: rules checked in one pass over a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``bad`` is true for violating rows; up to ``allowed`` (a share) of them pass."""

    name: str
    bad: Column
    severity: str = "error"
    allowed: float = 0.0


def not_null(c: str, mostly: float = 1.0, severity: str = "error") -> Rule:
    return Rule(f"not_null_{c}", F.col(c).isNull(), severity, 1.0 - mostly)


def accepted(c: str, values: Sequence, severity: str = "error") -> Rule:
    return Rule(f"accepted_{c}", F.coalesce(~F.col(c).isin(*values), F.lit(False)), severity)


def between(c: str, low: float, high: float, severity: str = "error") -> Rule:
    return Rule(f"between_{c}", F.coalesce(~F.col(c).between(low, high), F.lit(False)), severity)


def positive(c: str, severity: str = "error") -> Rule:
    return Rule(f"positive_{c}", F.coalesce(F.col(c) < 0, F.lit(False)), severity)


def valid_odds(c: str, severity: str = "error") -> Rule:
    return Rule(f"odds_{c}", F.coalesce(F.col(c) <= 1, F.lit(False)), severity)


def probability(c: str, severity: str = "error") -> Rule:
    return Rule(f"probability_{c}", F.coalesce((F.col(c) < 0) | (F.col(c) > 1), F.lit(False)), severity)


def not_after(c: str, limit: Column, severity: str = "error") -> Rule:
    return Rule(f"not_after_{c}", F.coalesce(F.col(c) > limit, F.lit(False)), severity)


def at_least(a: str, b: str, severity: str = "error") -> Rule:
    """a >= b where both are known."""
    return Rule(f"{a}_at_least_{b}", F.coalesce(F.col(a) < F.col(b), F.lit(False)), severity)


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, severity, n, violations and passed of all rules, by one aggregation."""
    wide = df.agg(F.count("*").alias("__n"), *(F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(rules)))
    own = [
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col("__n").alias("n"), F.col(f"r{i}").alias("violations"),
            (F.col(f"r{i}") <= F.col("__n") * F.lit(float(r.allowed))).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return wide.select(F.explode(F.array(*own)).alias("x")).select("x.*")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def outliers(df: DataFrame, rules: dict[str, Column], key: str, examples: int = 3) -> DataFrame:
    """rule, n and the first few keys of the rows over each limit; the rows themselves stay. One pass, bounded state."""
    hits = df.select(key, F.explode(F.array_compact(F.array(*(F.when(p, F.lit(name)) for name, p in rules.items())))).alias("rule"))
    from gritstone.operators.windows import first_per

    few = first_per(hits, ["rule"], [F.col(key)], examples).groupBy("rule").agg(F.array_join(F.sort_array(F.collect_list(key)), ",").alias("examples"))
    return hits.groupBy("rule").agg(F.count("*").alias("n")).join(few, "rule")


def gate(results: DataFrame) -> None:
    """Raise if a rule of severity error fails; the report has a row for each rule."""
    failed = [f"{r['rule']} ({r['violations']})" for r in results.where("severity = 'error' and not passed").collect()]
    if failed:
        raise ValueError("contract broken: " + ", ".join(failed))
