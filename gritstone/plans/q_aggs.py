"""Queries of aggregations (inventory 2.5 and 2.11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.operators import aggs as a
from gritstone.operators import graph
from gritstone.operators.windows import ratio
from gritstone.plans.registry import Tables, query


@query(
    "A1",
    """select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as qty, round(avg(l_extendedprice), 4) as price, min(l_discount) as least, max(l_tax) as most
    from lineitem group by all""",
)
def hash_group_by(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.avg("l_extendedprice"), 4).alias("price"), F.min("l_discount").alias("least"), F.max("l_tax").alias("most")
    )


_TYPES = ("signup", "error", "click", "view", "purchase")


@query("A2", "select user_id, " + ", ".join(f"count(*) filter (where event_type = '{x}') as n_{x}" for x in _TYPES) + ", count(*) filter (where value > 50 and event_type <> 'error') as large from events group by 1")
def filter_counts(t: Tables) -> DataFrame:
    own = [F.count_if(F.col("event_type") == x).alias(f"n_{x}") for x in _TYPES]
    return t.events.groupBy("user_id").agg(*own, F.count_if((F.col("value") > 50) & (F.col("event_type") != "error")).alias("large"))


@query(
    "A3",
    """select user_id, round(avg(value) filter (where event_type = 'view'), 4) as view_value, round(sum(value) filter (where event_type = 'purchase'), 4) as bought,
    count(value) filter (where event_type = 'click') as clicks from events group by 1""",
)
def filter_avgs(t: Tables) -> DataFrame:
    v = lambda x: F.when(F.col("event_type") == x, F.col("value"))
    return t.events.groupBy("user_id").agg(F.round(F.avg(v("view")), 4).alias("view_value"), F.round(F.sum(v("purchase")), 4).alias("bought"), F.count(v("click")).alias("clicks"))


@query("A4", "select user_id, " + ", ".join(f"max(case when event_type = '{x}' then 1 else 0 end) as is_{x}" for x in _TYPES) + " from events group by 1")
def eav_flags(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(*a.flags("event_type", _TYPES))


@query("A5", "select l_suppkey, count(distinct l_partkey) as parts, count(distinct l_partkey) filter (where l_discount > 0.05) as cheap_parts from lineitem group by 1")
def distinct_filter(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct(F.when(F.col("l_discount") > 0.05, F.col("l_partkey"))).alias("cheap_parts"))


@query("A6", "select o_custkey, count(*) as n from orders group by 1 having count(*) >= 12")
def having_min(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 12")


@query("A7 T3", "select o_custkey, arg_max(o_orderpriority, struct_pack(p := o_totalprice, k := o_orderkey)) as priority from orders group by 1")
def arg_max_tie(t: Tables) -> DataFrame:
    """The key makes ties definite."""
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct("o_totalprice", "o_orderkey")).alias("priority"))


@query("A8", "select o_custkey, bool_or(o_orderstatus = 'P') as any_p, max(o_totalprice > 300000) as any_large, max(o_orderpriority) as last_priority from orders group by 1")
def bool_or_max(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "P").alias("any_p"), F.max(F.col("o_totalprice") > 300000).alias("any_large"), F.max("o_orderpriority").alias("last_priority"))


@query(
    "A9",
    "select l_partkey, round(sum(l_discount * greatest(coalesce(nullif(l_quantity, 13), 90) - 10, 0)) / nullif(sum(greatest(coalesce(nullif(l_quantity, 13), 90) - 10, 0)), 0), 6) as mean from lineitem group by 1",
)
def weighted_mean(t: Tables) -> DataFrame:
    weight = F.greatest(F.coalesce(F.nullif("l_quantity", F.lit(13.0)), F.lit(90.0)) - 10, F.lit(0.0))
    return t.lineitem.groupBy("l_partkey").agg(F.round(a.weighted_mean(F.col("l_discount"), weight), 6).alias("mean"))


@query(
    "A10",
    """with s as (select l_suppkey, l_partkey, count(*) as n from lineitem group by all), p as (select l_suppkey, n * 1.0 / sum(n) over (partition by l_suppkey) as p from s)
    select l_suppkey, round(-sum(p * ln(p)) / nullif(ln(count(*)), 0), 6) as entropy from p group by 1""",
)
def entropy_norm(t: Tables) -> DataFrame:
    return a.shares(t.lineitem, ["l_suppkey"], ["l_partkey"], "p").groupBy("l_suppkey").agg(F.round(a.entropy(F.col("p")), 6).alias("entropy"))


_EDGES = """(select year(l_shipdate) as yr, s_nationkey as src, c_nationkey as dst, count(*) as weight from lineitem join supplier on l_suppkey = s_suppkey
join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey where s_nationkey <> c_nationkey group by all)"""


def _edges(t: Tables) -> DataFrame:
    """Lines from suppliers' to customers' nations, a graph for each year."""
    e = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    e = e.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    e = e.select(F.year("l_shipdate").cast("long").alias("yr"), F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst"))
    return e.where("src <> dst").groupBy("yr", "src", "dst").agg(F.count("*").alias("weight"))


@query(
    "A12 D11",
    f"""with e as {_EDGES}, o as (select yr, src as node, count(distinct dst) as degree_out, cast(sum(weight) as bigint) as weight_out from e group by all),
    i as (select yr, dst as node, count(distinct src) as degree_in, cast(sum(weight) as bigint) as weight_in from e group by all),
    b as (select yr, node, coalesce(degree_out, 0) as degree_out, coalesce(degree_in, 0) as degree_in, coalesce(weight_out, 0) as weight_out, coalesce(weight_in, 0) as weight_in from o full join i using (yr, node))
    select *, round(weight_out / sum(weight_out) over (partition by yr), 6) as weight_share, round(degree_in * degree_out * 1.0 / (count(*) over (partition by yr) * (count(*) over (partition by yr) - 1)), 4) as centrality from b""",
)
def network_degrees(t: Tables) -> DataFrame:
    return a.degrees(_edges(t), ["yr"], "src", "dst", "weight").withColumn("weight_share", F.round("weight_share", 6))


@query(
    "A11",
    f"""with e as {_EDGES}, n as (select yr, count(*) as n from (select yr, src as v from e union select yr, dst from e) group by 1)
    select yr, round(count(*) * 1.0 / nullif(any_value(n) * (any_value(n) - 1), 0), 6) as density, round(max(weight) * 1.0 / sum(weight), 6) as top_share from e join n using (yr) group by 1""",
)
def density(t: Tables) -> DataFrame:
    e = _edges(t)
    n = e.select("yr", F.explode(F.array("src", "dst")).alias("v")).groupBy("yr").agg(F.count_distinct("v").alias("n"))
    by = e.groupBy("yr").agg(F.count("*").alias("edges"), F.max("weight").alias("top"), F.sum("weight").alias("all")).join(n, "yr")
    return by.select("yr", F.round(F.col("edges") / F.nullif(F.col("n") * (F.col("n") - 1), F.lit(0)), 6).alias("density"), F.round(F.col("top") / F.col("all"), 6).alias("top_share"))


@query(
    "A13",
    "select o_custkey, o_orderpriority, n, round(n * 1.0 / sum(n) over (partition by o_custkey), 6) as share from (select o_custkey, o_orderpriority, count(*) as n from orders group by all)",
)
def share_of_group(t: Tables) -> DataFrame:
    return a.shares(t.orders, ["o_custkey"], ["o_orderpriority"]).withColumn("share", F.round("share", 6))


@query(
    "A14 T15",
    "select l_returnflag, "
    + ", ".join(
        f"round(avg(case when l_quantity * 2 >= {20 * i} and l_quantity * 2 < {20 * i + 20} and l_discount * 1000 >= {20 * k} and l_discount * 1000 < {20 * k + 20} then 1.0 else 0.0 end), 6) as cell_{i}_{k}"
        for i in range(5)
        for k in range(5)
    )
    + " from lineitem group by 1",
)
def grid_shares(t: Tables) -> DataFrame:
    cells = a.grid_shares(F.col("l_quantity") * 2, F.col("l_discount") * 1000)
    by = t.lineitem.groupBy("l_returnflag").agg(*cells)
    return by.select("l_returnflag", *(F.round(c, 6).alias(c) for c in by.columns[1:]))


@query("A15", "select l_returnflag, round(count(*) / (1 + sqrt(pow(100 - avg(l_quantity), 2) + pow(50 - avg(l_tax * 100), 2))), 4) as value from lineitem group by 1")
def geo_value(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.round(a.geometric_value(F.count("*"), F.col("l_quantity"), F.col("l_tax") * 100), 4).alias("value"))


@query("A16", "select o_custkey, round(stddev(o_totalprice), 3) as deviation from orders group by 1")
def stddev_grp(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.round(F.stddev_samp("o_totalprice"), 3).alias("deviation"))


@query("A17", "select l_suppkey, round(avg(l_quantity), 5) as x, round(avg(case when l_returnflag = 'R' then l_tax end), 6) as y_returned from lineitem group by 1")
def centroid_cond(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.avg("l_quantity"), 5).alias("x"), F.round(F.avg(F.when(F.col("l_returnflag") == "R", F.col("l_tax"))), 6).alias("y_returned"))


@query("A18", "select (l_suppkey * 13) % 100 as related, count(*) as credited from lineitem where l_returnflag = 'A' group by 1")
def credit_related(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'A'").groupBy(((F.col("l_suppkey") * 13) % 100).alias("related")).agg(F.count("*").alias("credited"))


_NULLED = "(select user_id, case when event_type <> 'error' then value end as value, case when event_id % 7 <> 0 then event_id end as event_id from events)"


def _nulled(t: Tables) -> DataFrame:
    return t.events.select("user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), F.when(F.col("event_id") % 7 != 0, F.col("event_id")).alias("event_id"))


@query(
    "A19 A34 P40",
    " union all ".join(f"select '{c}' as \"column\", count(*) filter (where {c} is null) as n_null, count(*) as n, round(1 - count(*) filter (where {c} is null) * 1.0 / count(*), 6) as filled from {_NULLED}" for c in ("user_id", "value", "event_id")),
)
def null_profile(t: Tables) -> DataFrame:
    df = _nulled(t)
    return a.null_profile(df, a.numeric_columns(df)).withColumn("filled", F.round("filled", 6))


@query(
    "A20",
    " union all ".join(
        f"select year(o_orderdate) as yr, '{c}' as \"column\", count(*) filter (where {x} is null) as n_null, count(*) as n, round(1 - count(*) filter (where {x} is null) * 1.0 / count(*), 6) as filled from orders group by 1"
        for c, x in (("price", "case when o_orderstatus <> 'P' then o_totalprice end"), ("prio", "nullif(o_orderpriority, '5-LOW')"))
    ),
)
def fill_by_year(t: Tables) -> DataFrame:
    df = t.orders.select(F.year("o_orderdate").cast("long").alias("yr"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"))
    return a.null_profile(df, by=["yr"]).withColumn("filled", F.round("filled", 6))


_CORR = ("l_quantity", "l_extendedprice", "l_discount")


@query("A21", " union all ".join(f"select '{x}' as x, '{y}' as y, round(corr({x}, {y}), 6) as r from lineitem where l_quantity is not null and l_extendedprice is not null and l_discount is not null" for x in _CORR for y in _CORR))
def corr_matrix(t: Tables) -> DataFrame:
    return a.correlations(t.lineitem, _CORR).withColumn("r", F.round("r", 6))


@query(
    "A22 M1",
    """with q as (select o_orderpriority as k, quantile_cont(o_totalprice, 0.01) as lo, quantile_cont(o_totalprice, 0.99) as hi, quantile_cont(o_totalprice, 0.5) as mid from orders where year(o_orderdate) < 1997 group by 1)
    select o_orderkey, round(greatest(least(o_totalprice, hi), lo), 4) as clipped, round(mid, 4) as median from orders join q on k = o_orderpriority""",
)
def percentiles_winsor(t: Tables) -> DataFrame:
    """Limits are fitted on the years before 1997 and clip all years."""
    q = t.orders.where(F.year("o_orderdate") < 1997).groupBy(F.col("o_orderpriority").alias("k")).agg(F.percentile("o_totalprice", F.array(F.lit(0.01), F.lit(0.99), F.lit(0.5))).alias("q"))
    clipped = F.greatest(F.least("o_totalprice", F.col("q")[1]), F.col("q")[0])
    return t.orders.join(F.broadcast(q), F.col("k") == F.col("o_orderpriority")).select("o_orderkey", F.round(clipped, 4).alias("clipped"), F.round(F.col("q")[2], 4).alias("median"))


@query(
    "A23",
    """with x as (select o_orderpriority as p, count(*) * 1.0 / sum(count(*)) over () as s from orders where o_orderstatus = 'F' group by 1), y as (select o_orderpriority as p, count(*) * 1.0 / sum(count(*)) over () as s from orders where o_orderstatus = 'P' and o_orderpriority < '4' group by 1)
    select coalesce(x.p, y.p) as o_orderpriority, round(coalesce(x.s, 0), 6) as share_a, round(coalesce(y.s, 0), 6) as share_b, round(coalesce(x.s, 0) - coalesce(y.s, 0), 6) as difference from x full join y on x.p = y.p""",
)
def dist_compare(t: Tables) -> DataFrame:
    out = a.compare_distributions(t.orders.where("o_orderstatus = 'F'"), t.orders.where("o_orderstatus = 'P' and o_orderpriority < '4'"), "o_orderpriority")
    return out.select("o_orderpriority", *(F.round(c, 6).alias(c) for c in ("share_a", "share_b", "difference")))


@query(
    "A24 A25",
    """select case when l_discount > -1 and l_discount <= 0.02 then '(-1, 0.02]' when l_discount > 0.02 and l_discount <= 0.05 then '(0.02, 0.05]' when l_discount > 0.05 and l_discount <= 0.1 then '(0.05, 0.1]' end as bin,
    l_returnflag, count(*) as n, round(avg(l_quantity), 5) as win, round(sum(l_extendedprice * l_tax) / nullif(sum(l_extendedprice), 0), 6) as roi from lineitem group by all""",
)
def bin_roi(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(a.binned(F.col("l_discount"), [-1, 0.02, 0.05, 0.1]).alias("bin"), "l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.avg("l_quantity"), 5).alias("win"), F.round(ratio(F.sum(F.col("l_extendedprice") * F.col("l_tax")), F.sum("l_extendedprice")), 6).alias("roi")
    )


@query("A26", "select l_returnflag, round(avg(case l_linestatus when 'O' then l_tax else l_discount end - 0.05), 6) as gap from lineitem group by 1")
def model_market_gap(t: Tables) -> DataFrame:
    chosen = F.when(F.col("l_linestatus") == "O", F.col("l_tax")).otherwise(F.col("l_discount"))
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg(chosen - 0.05), 6).alias("gap"))


@query(
    "A27 A33",
    """select edge::double as edge, conf::double as conf, count(*) as n, round(avg(l_tax - 0.04), 6) as roi from lineitem, (select unnest([0.0, 0.02, 0.04, 0.06, 0.08]) as edge) e, (select unnest([10.0, 20.0, 30.0, 40.0]) as conf) c
    where l_discount > edge and l_quantity > conf group by all having count(*) >= 30""",
)
def grid_sweep(t: Tables) -> DataFrame:
    grid = [{"edge": e, "conf": c} for e in (0.0, 0.02, 0.04, 0.06, 0.08) for c in (10.0, 20.0, 30.0, 40.0)]
    passes = (F.col("l_discount") > F.col("edge")) & (F.col("l_quantity") > F.col("conf"))
    return a.sweep(t.lineitem, grid, passes, [F.count("*").alias("n"), F.round(F.avg(F.col("l_tax") - 0.04), 6).alias("roi")]).where("n >= 30")


@query(
    "A28",
    """with p as (select toxic, 1 - least(n_chars, 5000) / 5000.0 as p from labels join documents using (doc_id)),
    s as (select th, sum(case when p >= th and toxic = 1 then 1 else 0 end) as tp, sum(case when p >= th then 1 else 0 end) as pp, sum(toxic) as t from p, (select unnest([0.2, 0.4, 0.6, 0.8]) as th) g group by 1)
    select th::double as th, round(2.0 * tp / nullif(pp + t, 0), 6) as f1 from s""",
)
def threshold_f1(t: Tables) -> DataFrame:
    """F1 of one class over thresholds; the grid meets one row of counts for each threshold."""
    p = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select("toxic", (1 - F.least("n_chars", F.lit(5000)) / 5000.0).alias("p"))
    hit = F.col("p") >= F.col("th")
    s = a.sweep(p, [{"th": x} for x in (0.2, 0.4, 0.6, 0.8)], F.lit(True), [F.count_if(hit & (F.col("toxic") == 1)).alias("tp"), F.count_if(hit).alias("pp"), F.sum("toxic").alias("t")])
    return s.select("th", F.round(2.0 * F.col("tp") / F.nullif(F.col("pp") + F.col("t"), F.lit(0)), 6).alias("f1"))


@query(
    "A29",
    """with m as (select median(l_quantity) as q, median(l_extendedprice) as p from lineitem), r as (select median(l_quantity) as q, median(l_extendedprice) as p from lineitem where l_returnflag = 'R' and l_discount > 0.08)
    select 'l_quantity' as feature, round(abs(r.q - m.q), 4) as difference from m, r union all select 'l_extendedprice', round(abs(r.p - m.p), 4) from m, r""",
)
def median_shift(t: Tables) -> DataFrame:
    cols = ["l_quantity", "l_extendedprice"]
    odd = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08)
    one = t.lineitem.agg(*(F.abs(F.percentile(F.when(odd, F.col(c)), 0.5) - F.percentile(c, 0.5)).alias(c) for c in cols))
    return one.unpivot([], cols, "feature", "difference").withColumn("difference", F.round("difference", 4))


_PROB = "(select toxic, least(greatest(1 - least(n_chars, 5000) / 5000.0, 0.01), 0.99) as p from labels join documents using (doc_id))"


def _prob(t: Tables) -> DataFrame:
    p = 1 - F.least("n_chars", F.lit(5000)) / 5000.0
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select("toxic", F.least(F.greatest(p, F.lit(0.01)), F.lit(0.99)).alias("p"))


@query(
    "A30 A31",
    f"""with c as (select floor(p * 10) as b, avg(p) as mp, avg(toxic) as mt from {_PROB} group by 1)
    select round(avg(-ln(case when toxic = 1 then p else 1 - p end)), 6) as logloss, round(avg(pow(p - toxic, 2) + pow((1 - p) - (1 - toxic), 2)), 6) as brier,
    round(avg(case when (p >= 0.5)::int = toxic then 1.0 else 0.0 end), 6) as accuracy, round((select avg(abs(mp - mt)) from c), 6) as calibration from {_PROB}""",
)
def logloss_brier(t: Tables) -> DataFrame:
    p = _prob(t)
    bins = p.groupBy(F.floor(F.col("p") * 10).alias("b")).agg(F.avg("p").alias("mp"), F.avg("toxic").alias("mt")).agg(F.round(F.avg(F.abs(F.col("mp") - F.col("mt"))), 6).alias("calibration"))
    true = F.when(F.col("toxic") == 1, F.col("p")).otherwise(1 - F.col("p"))
    brier = F.pow(F.col("p") - F.col("toxic"), 2) + F.pow((1 - F.col("p")) - (1 - F.col("toxic")), 2)
    one = p.agg(F.round(F.avg(-F.ln(true)), 6).alias("logloss"), F.round(F.avg(brier), 6).alias("brier"), F.round(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("toxic")).cast("double")), 6).alias("accuracy"))
    return one.join(F.broadcast(bins), F.lit(True))


@query("A32", "select o_custkey, count(*) as bets, round(avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end), 6) as win_rate, round(sum(case when o_orderstatus = 'F' then o_totalprice * 0.9 else -o_totalprice end) / sum(o_totalprice), 6) as roi from orders group by 1")
def backtest_metrics(t: Tables) -> DataFrame:
    won = F.col("o_orderstatus") == "F"
    profit = F.when(won, F.col("o_totalprice") * 0.9).otherwise(-F.col("o_totalprice"))
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("bets"), F.round(F.avg(won.cast("double")), 6).alias("win_rate"), F.round(F.sum(profit) / F.sum("o_totalprice"), 6).alias("roi"))


@query(
    "A35",
    """with a as (select p_brand as feature, count(*) as gain from part where p_size < 25 group by 1), b as (select p_brand as feature, count(*) as split from part where p_size >= 20 group by 1)
    select feature, round((coalesce(gain, 0) + coalesce(split, 0)) / 2.0, 4) as importance from a full join b using (feature)""",
)
def importance_merge(t: Tables) -> DataFrame:
    x = t.part.where("p_size < 25").groupBy(F.col("p_brand").alias("feature")).agg(F.count("*").alias("gain"))
    y = t.part.where("p_size >= 20").groupBy(F.col("p_brand").alias("feature")).agg(F.count("*").alias("split"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return x.join(y, "feature", "full").select("feature", F.round((zero("gain") + zero("split")) / 2.0, 4).alias("importance"))


@query("P46", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_discount >= l_tax and l_discount >= 0.05 then 'l_discount' when l_tax >= 0.05 then 'l_tax' else 'base' end as top, greatest(l_discount, l_tax, 0.05) as most from lineitem")
def argmax_columns(t: Tables) -> DataFrame:
    own = t.lineitem.withColumn("base", F.lit(0.05))
    return own.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", a.argmax_column(["l_discount", "l_tax", "base"]).alias("top"), F.greatest("l_discount", "l_tax", "base").alias("most"))


@query("F4 T13")
def betweenness(t: Tables) -> DataFrame:
    """Exact weighted betweenness of each year's graph of nations."""
    return graph.betweenness(_edges(t), ["yr"], "src", "dst", "weight")
