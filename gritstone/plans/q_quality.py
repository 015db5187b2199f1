"""Queries of data contracts and audits (inventory 2.12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.operators import quality as q
from gritstone.plans.registry import Tables, query

_RULES = (
    ("not_null_l_orderkey", "error", "l_orderkey is null", 0.0),
    ("accepted_l_returnflag", "warn", "l_returnflag not in ('A', 'N')", 0.0),
    ("between_l_discount", "error", "l_discount not between 0 and 0.08", 0.0),
    ("positive_l_quantity", "error", "l_quantity < 0", 0.0),
    ("odds_l_quantity", "warn", "l_quantity <= 1", 0.0),
    ("probability_l_tax", "error", "l_tax < 0 or l_tax > 1", 0.0),
    ("l_extendedprice_at_least_l_quantity", "error", "l_extendedprice < l_quantity", 0.0),
)


@query("Q1 Q3 Q4 Q6 F3", " union all ".join(f"select '{n}' as rule, '{s}' as severity, count(*) as n, count(*) filter (where {p}) as violations, count(*) filter (where {p}) <= count(*) * {m} as passed from lineitem" for n, s, p, m in _RULES))
def quality_report(t: Tables) -> DataFrame:
    rules = [
        q.not_null("l_orderkey"), q.accepted("l_returnflag", ["A", "N"], "warn"), q.between("l_discount", 0, 0.08), q.positive("l_quantity"), q.valid_odds("l_quantity", "warn"), q.probability("l_tax"),
        q.at_least("l_extendedprice", "l_quantity"),
    ]
    return q.report(t.lineitem, rules)


@query("Q2 K17", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def unique_violations(t: Tables) -> DataFrame:
    return q.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("Q5", "select 'future' as test, count(*) as violations from orders where o_orderdate > timestamp '2030-01-01' union all select 'range', count(*) from part where p_size not between 0 and 45 union all select 'coverage', case when avg(case when k is not null then 1.0 else 0.0 end) < 0.95 then 1 else 0 end from orders left join (select distinct l_orderkey as k from lineitem) on k = o_orderkey")
def singular_tests(t: Tables) -> DataFrame:
    future = t.orders.agg(F.lit("future").alias("test"), F.count_if(F.col("o_orderdate") > F.to_timestamp_ntz(F.lit("2030-01-01 00:00:00"))).alias("violations"))
    size = t.part.agg(F.lit("range").alias("test"), F.count_if(~F.col("p_size").between(0, 45)).alias("violations"))
    there = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("k", F.lit(1))
    share = F.avg(F.when(F.col("k").isNotNull(), 1.0).otherwise(0.0))
    cover = t.orders.join(there, "o_orderkey", "left").agg(F.lit("coverage").alias("test"), F.when(share < 0.95, 1).otherwise(0).cast("long").alias("violations"))
    return future.union(size).union(cover)


@query("Q5", "select count(*) as leaks from (select o_orderkey, count(*) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 5 preceding and 1 preceding) as n, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as r from orders) where r = 1 and n > 0")
def leakage_test(t: Tables) -> DataFrame:
    from gritstone.operators import windows as w

    key, order = ["o_custkey"], ["o_orderdate", "o_orderkey"]
    rows = t.orders.select(F.count("*").over(w.previous(key, order, 5)).alias("n"), F.row_number().over(w.ordered(key, order)).alias("r"))
    return rows.agg(F.count_if((F.col("r") == 1) & (F.col("n") > 0)).alias("leaks"))


@query(
    "P11 P9",
    """with h as (select l_orderkey, 'many' as rule from lineitem where l_quantity > 49 union all select l_orderkey, 'dear' from lineitem where l_extendedprice > 100000)
    select rule, count(*) as n, (select string_agg(l_orderkey::varchar, ',' order by l_orderkey) from (select l_orderkey from h h2 where h2.rule = h.rule order by 1 limit 3)) as examples from h group by 1""",
)
def outlier_audit(t: Tables) -> DataFrame:
    return q.outliers(t.lineitem, {"many": F.col("l_quantity") > 49, "dear": F.col("l_extendedprice") > 100000}, "l_orderkey")


@query("Q7", "select count(*) filter (where s like '____-____') as well_formed, count(*) as n from (select year(o_orderdate) || '-' || (year(o_orderdate) + 1) as s from orders)")
def season_format(t: Tables) -> DataFrame:
    y = F.year("o_orderdate")
    s = F.concat_ws("-", y.cast("string"), (y + 1).cast("string"))
    return t.orders.agg(F.count_if(s.like("____-____")).alias("well_formed"), F.count("*").alias("n"))
