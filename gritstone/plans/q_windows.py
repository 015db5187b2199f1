"""Queries over ordered rows (inventory 2.6 and 2.7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gritstone.operators import windows as w
from gritstone.plans.registry import Tables, query

CUST = (["o_custkey"], ["o_orderdate", "o_orderkey"])
USER = (["user_id"], ["ts", "event_id"])
LINE = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_C = "over (partition by o_custkey order by o_orderdate, o_orderkey"
_U = "over (partition by user_id order by ts, event_id"
_L = "order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("W1 P42 F2 S13", "select o_orderkey, " + ", ".join(f"round(avg(o_totalprice) {_C} rows between {n} preceding and 1 preceding), 5) as price_{n}" for n in (3, 5, 10)) + " from orders")
def roll_avg_prev(t: Tables) -> DataFrame:
    cols = w.rolling({"price": F.col("o_totalprice")}, *CUST)
    out = t.orders.select("o_orderkey", *cols)
    return out.select("o_orderkey", *(F.round(c, 5).alias(c) for c in out.columns[1:]))


@query("W2", "select o_orderkey, round(avg(o_totalprice) over (partition by o_custkey, o_orderstatus order by o_orderdate, o_orderkey rows between 5 preceding and 1 preceding), 4) as price_5 from orders")
def roll_avg_prev_status(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.avg("o_totalprice").over(w.previous(["o_custkey", "o_orderstatus"], CUST[1], 5)), 4).alias("price_5"))


_P = f"over (partition by l_partkey {_L} rows between 5 preceding and 1 preceding)"


@query(
    "W3 W5",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(sum(l_discount * l_extendedprice) {_P} / nullif(sum(l_extendedprice) {_P}, 0), 5) as discount_share,
    round(avg(l_quantity) {_P} / nullif(avg(l_extendedprice) {_P}, 0) - 1, 5) as over_performance from lineitem""",
)
def roll_ratio(t: Tables) -> DataFrame:
    p = w.previous(["l_partkey"], LINE, 5)
    share = w.rolling_ratio({"d": (F.col("l_discount") * F.col("l_extendedprice"), F.col("l_extendedprice"))}, ["l_partkey"], LINE, [5])[0]
    over = w.ratio(F.avg("l_quantity").over(p), F.avg("l_extendedprice").over(p)) - 1
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(share, 5).alias("discount_share"), F.round(over, 5).alias("over_performance"))


@query("W4", f"select o_orderkey, round(avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end) {_C} rows between 5 preceding and 1 preceding), 4) as rate from orders")
def roll_rate(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).over(w.previous(*CUST, 5)), 4).alias("rate"))


@query(
    "W6",
    f"""select o_orderkey, count(*) {_C} rows between unbounded preceding and 1 preceding) as n_before,
    round(sum(o_totalprice) {_C} rows between unbounded preceding and 1 preceding), 2) as spent_before from orders""",
)
def expanding_prev(t: Tables) -> DataFrame:
    b = w.before(*CUST)
    return t.orders.select("o_orderkey", F.count("*").over(b).alias("n_before"), F.round(F.sum("o_totalprice").over(b), 2).alias("spent_before"))


@query(
    "W7 W8",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::varchar as shipped, count(*) over h as n, round(avg(l_quantity) over h, 4) as quantity, count(*) over a as n_all
    from lineitem window h as (partition by l_suppkey, l_partkey {_L} rows between 10 preceding and 1 preceding), a as (partition by l_suppkey, l_partkey {_L} rows between unbounded preceding and 1 preceding)""",
)
def h2h_prev10(t: Tables) -> DataFrame:
    keys = ["l_suppkey", "l_partkey"]
    h, a = w.previous(keys, LINE, 10), w.before(keys, LINE)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"),
        F.count("*").over(h).alias("n"), F.round(F.avg("l_quantity").over(h), 4).alias("quantity"), F.count("*").over(a).alias("n_all"),
    )


@query("W9", f"select event_id, cast(sum(case when event_type = 'purchase' then 1 else 0 end) {_U} rows between unbounded preceding and current row) as bigint) as purchases from events")
def running_count(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).over(w.until(*USER)).alias("purchases"))


@query("W10", "select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey order by cast(o_orderdate as date)), 2) as spent from orders")
def peers_cumsum(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.sum("o_totalprice").over(w.ordered(["o_custkey"], [F.to_date("o_orderdate")])), 2).alias("spent"))


_LAGS = " + ".join(f"case when lag(o_orderpriority, {i}) {_C}) = o_orderpriority then 1 else 0 end" for i in range(1, 6))


@query(
    "W11",
    f"""select o_orderkey, cast(case when lag(o_orderpriority) {_C}) is null then null else {_LAGS} end as integer) as familiar,
    case when lag(o_orderpriority) {_C}) is distinct from o_orderpriority then 1 else 0 end as changed from orders""",
)
def lag_familiarity(t: Tables) -> DataFrame:
    changed = w.changes(F.col("o_orderpriority"), *CUST).cast("int")
    return t.orders.select("o_orderkey", w.familiarity("o_orderpriority", *CUST).alias("familiar"), changed.alias("changed"))


@query(
    "W12 T20",
    f"""select o_orderkey, days, case when days <= 3 then 1 else 0 end as short_rest, case when days >= 14 then 1 else 0 end as long_rest
    from (select o_orderkey, date_diff('day', lag(o_orderdate) {_C}), o_orderdate) as days from orders)""",
)
def days_since_prev(t: Tables) -> DataFrame:
    days = F.datediff("o_orderdate", F.lag("o_orderdate").over(w.ordered(*CUST))).cast("long")
    flag = lambda p: F.when(p, 1).otherwise(0)
    return t.orders.select("o_orderkey", days.alias("days")).select("*", flag(F.col("days") <= 3).alias("short_rest"), flag(F.col("days") >= 14).alias("long_rest"))


@query(
    "W13",
    """select o_custkey, yr, round(price, 4) as price, round(lag(price) over (partition by o_custkey order by yr), 4) as prior_price
    from (select o_custkey, year(o_orderdate) as yr, avg(o_totalprice) as price from orders group by all)""",
)
def prior_year_avg(t: Tables) -> DataFrame:
    by = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("yr")).agg(F.avg("o_totalprice").alias("price"))
    return by.select("o_custkey", "yr", F.round("price", 4).alias("price"), F.round(F.lag("price").over(w.ordered(["o_custkey"], ["yr"])), 4).alias("prior_price"))


@query("W14 W15", f"select event_id, lead(event_type) {_U}) as next_type, round(lead(value) {_U}), 4) as next_value from events")
def lead_next_event(t: Tables) -> DataFrame:
    o = w.ordered(*USER)
    return t.events.select("event_id", F.lead("event_type").over(o).alias("next_type"), F.round(F.lead("value").over(o), 4).alias("next_value"))


@query(
    "W16",
    f"""select event_id, round(lag(v ignore nulls) {_U}), 4) as before_, round(lead(v ignore nulls) {_U}), 4) as after_
    from (select *, case when event_type in ('view', 'purchase') then value end as v from events)""",
)
def lag_ignore_nulls(t: Tables) -> DataFrame:
    v = F.when(F.col("event_type").isin("view", "purchase"), F.col("value"))
    return t.events.select("event_id", F.round(w.last_known(v, *USER), 4).alias("before_"), F.round(w.next_known(v, *USER), 4).alias("after_"))


@query(
    "W17",
    """select o_custkey, max(case when a = 1 then o_orderkey end) as first_order, max(case when d = 1 then o_orderkey end) as last_order from (
    select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as a, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as d from orders) group by 1""",
)
def first_last_pick(t: Tables) -> DataFrame:
    key = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", key).alias("first_order"), F.max_by("o_orderkey", key).alias("last_order"))


@query(
    "W18",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::varchar as shipped, min(l_quantity) over p as least, max(l_quantity) over p as most, count(*) over p as n,
    round(l_extendedprice / nullif(sum(l_extendedprice) over p, 0), 5) as share from lineitem window p as (partition by l_orderkey)""",
)
def part_totals(t: Tables) -> DataFrame:
    p = w.whole(["l_orderkey"])
    share = w.ratio(F.col("l_extendedprice"), F.sum("l_extendedprice").over(p))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"),
        F.min("l_quantity").over(p).alias("least"), F.max("l_quantity").over(p).alias("most"), F.count("*").over(p).alias("n"), F.round(share, 5).alias("share"),
    )


_ISLAND = f"""with f as (select *, case when lag(ts) {_U}) is null or lag(event_type) {_U}) is distinct from event_type or epoch(ts) - epoch(lag(ts) {_U})) > 1800 then 1 else 0 end as s from events),
g as (select *, cast(sum(s) {_U} rows between unbounded preceding and current row) as bigint) as island from f)"""


@query(
    "W19 D12",
    _ISLAND + " select user_id, island, count(*) as n, round(sum(value), 4) as total, min(event_type) as event_type, min(event_id) as first_event from g group by user_id, island",
)
def islands_sessions(t: Tables) -> DataFrame:
    """Islands of a user's activity: a new one begins when the type changes or half an hour passes."""
    o = w.ordered(*USER)
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(o).cast("timestamp"))
    starts = w.changes(F.col("event_type"), *USER) | (gap > 1800 * 1_000_000)
    tagged = t.events.withColumn("starts", starts).withColumn("island", w.island_id(F.col("starts"), *USER))
    return tagged.groupBy("user_id", "island").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.min("event_type").alias("event_type"), F.min("event_id").alias("first_event")
    )


@query(
    "W20 J11",
    f"select event_id, round(last_value(case when event_type = 'purchase' then value end ignore nulls) {_U} rows between unbounded preceding and current row), 4) as state, "
    f"max(case when event_type = 'purchase' then event_id end) {_U} rows between unbounded preceding and current row) as running_max from events",
)
def ffill_state(t: Tables) -> DataFrame:
    bought = F.col("event_type") == "purchase"
    return t.events.select(
        "event_id", F.round(w.carried(F.when(bought, F.col("value")), *USER), 4).alias("state"), F.max(F.when(bought, F.col("event_id"))).over(w.until(*USER)).alias("running_max")
    )


@query("W21 P26", f"select event_id, case when lead(event_type) {_U}) is distinct from event_type then 1 else 0 end as rupture from events")
def rupture_flags(t: Tables) -> DataFrame:
    return t.events.select("event_id", (~F.lead("event_type").over(w.ordered(*USER)).eqNullSafe(F.col("event_type"))).cast("int").alias("rupture"))


@query("W22 W23 O4 P12", "select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def dedup_latest(t: Tables) -> DataFrame:
    return w.first_per(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "W24",
    f"select event_id, round(row_number() {_U}) / count(*) over (partition by user_id), 4) as weight from events",
)
def seq_weight(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.round(F.row_number().over(w.ordered(*USER)) / F.count("*").over(w.whole(["user_id"])), 4).alias("weight"))


@query(
    "W25",
    f"""select l_orderkey, round(sum(case when rk <= 3 then l_extendedprice else 0 end) / nullif(sum(l_extendedprice), 0), 5) as top3 from (
    select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber, l_partkey, l_suppkey, l_shipdate) as rk from lineitem) group by 1""",
)
def top3_share(t: Tables) -> DataFrame:
    rk = F.row_number().over(w.ordered(["l_orderkey"], [F.desc("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]))
    top = F.sum(F.when(F.col("rk") <= 3, F.col("l_extendedprice")).otherwise(0.0))
    return t.lineitem.withColumn("rk", rk).groupBy("l_orderkey").agg(F.round(w.ratio(top, F.sum("l_extendedprice")), 5).alias("top3"))


@query("W26", f"select o_orderkey, count(*) {_C} rows between 5 preceding and 1 preceding) as n from orders")
def window_row_count(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.count("*").over(w.previous(*CUST, 5)).alias("n"))


@query(
    "W27",
    """select o_custkey, round(avg(o_totalprice) filter (where rn <= 5), 5) as last5, round(avg(o_totalprice) filter (where rn <= 10), 5) as last10 from (
    select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) group by 1""",
)
def rolling_by_rank(t: Tables) -> DataFrame:
    rn = F.row_number().over(w.ordered(["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]))
    mean = lambda n: F.round(F.avg(F.when(F.col("rn") <= n, F.col("o_totalprice"))), 5).alias(f"last{n}")
    return t.orders.withColumn("rn", rn).groupBy("o_custkey").agg(mean(5), mean(10))


_BAL = f"1000000 + sum(case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end) {_C} rows between unbounded preceding and current row)"


@query("W28", f"select o_orderkey, round((b - top) / nullif(top, 0), 6) as drawdown from (select o_orderkey, b, max(b) {_C} rows between unbounded preceding and current row) as top from (select *, {_BAL} as b from orders))")
def drawdown(t: Tables) -> DataFrame:
    sign = F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    balance = t.orders.withColumn("b", F.lit(1_000_000.0) + F.sum(sign).over(w.until(*CUST)))
    return balance.select("o_orderkey", F.round(w.drawdown(F.col("b"), *CUST), 6).alias("drawdown"))


@query(
    "W29",
    """with r as (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as r, o_orderstatus = 'F' as f from orders),
    g as (select o_custkey, r - row_number() over (partition by o_custkey order by r) as g from r where f), n as (select o_custkey, g, count(*) as n from g group by all)
    select c.o_custkey, coalesce(max(n), 0) as longest_streak from (select distinct o_custkey from orders) c left join n using (o_custkey) group by 1""",
)
def max_losing_streak(t: Tables) -> DataFrame:
    return w.longest_streak(t.orders, F.col("o_orderstatus") == "F", *CUST)


@query(
    "W30",
    "select p_brand, round(sum(n * p_size * 2.0 / total), 5) as position from (select *, sum(n) over (partition by p_brand) as total from (select p_brand, p_size, count(*)::double as n from part group by all)) group by 1",
)
def weighted_position(t: Tables) -> DataFrame:
    n = t.part.groupBy("p_brand", "p_size").count()
    share = F.col("count") / F.sum("count").over(w.whole(["p_brand"]))
    return n.withColumn("share", share).groupBy("p_brand").agg(F.round(F.sum(F.col("share") * F.col("p_size") * 2.0), 5).alias("position"))


@query("O1 O2 O3", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def topk(t: Tables) -> DataFrame:
    return t.orders.orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("O5", "select distinct l_partkey, l_suppkey from lineitem")
def distinct_pairs(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    "T7",
    f"select o_orderkey, round(avg(case when o_orderpriority like '1%' then 1.0 else 0.0 end) {_C} rows between 2 preceding and current row), 4) as exact_frame_3 from orders",
)
def exact_frame(t: Tables) -> DataFrame:
    frame = w.ordered(*CUST).rowsBetween(-2, Window.currentRow)
    return t.orders.select("o_orderkey", F.round(F.avg(F.when(F.col("o_orderpriority").like("1%"), 1.0).otherwise(0.0)).over(frame), 4).alias("exact_frame_3"))
