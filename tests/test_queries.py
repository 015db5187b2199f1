"""Every registered query runs; those with SQL give what DuckDB gives for it."""

from __future__ import annotations

import math

import duckdb
import pytest

from gritstone.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"stacked_probabilities"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return "null"
        if isinstance(x, bool) or not isinstance(x, (int, float)) and not hasattr(x, "as_integer_ratio"):
            return str(x)
        return f"{float(x):.6f}".replace("-0.000000", "0.000000")

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    if name in SLOW:
        pytest.skip("fits models; test_stacking tests its parts")
    df = registry.queries()[name](spark, DIR)
    rows = [tuple(r) for r in df.collect()]
    if name not in registry.oracle_sql():
        assert df.columns and rows
        return
    rel = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert normal(rows, df.columns) == normal(rel.fetchall(), rel.columns)


def test_band_binned_rounds_seconds(spark, tmp_path):
    c = duckdb.connect()
    at = [(0, "12:00:00.5"), (0, "12:00:01.5"), (0, "12:00:00.499999"), (1, "12:00:00.5"), (1, "12:00:01.5"), (1, "12:00:01.499999"), (1, "12:00:02.500001"), (-1, "11:59:59.6"), (-1, "12:00:00.4")]
    values = [f"(timestamp '{day} {t}' + to_days({d}), '{kind}')" for day in ("2024-01-02", "1969-12-30") for d, t in at for kind in ("purchase", "click")]
    c.sql(f"create table events as select row_number() over () as event_id, 7::bigint as user_id, event_type, ts from (values {', '.join(values)}) as v(ts, event_type)")
    c.sql(f"copy events to '{tmp_path}/events.parquet'")
    rows = [tuple(r) for r in registry.queries()["band_binned"](spark, str(tmp_path)).collect()]
    assert sorted(rows) == sorted(c.sql(registry.oracle_sql()["band_binned"]).fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.oracle_sql()) <= set(e.queries())
