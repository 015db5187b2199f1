"""Queries of joins and set operations (inventory 2.4 and 2.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gritstone.operators import joins as j
from gritstone.operators import windows as w
from gritstone.plans.registry import Tables, query


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


@query(
    "J1 J3",
    """select o_orderkey, c_name, n_name, r_name, c_mktsegment from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
    left join region on n_regionkey = r_regionkey""",
)
def star_assembly(t: Tables) -> DataFrame:
    """Nation and region have 25 and 5 rows by definition, so they are broadcast."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    o = o.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return o.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("o_orderkey", "c_name", "n_name", "r_name", "c_mktsegment")


@query("J2", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand from lineitem join part on l_partkey = p_partkey where p_size > 40")
def inner_join(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part.where("p_size > 40"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_brand")


@query(
    "J4 P44",
    """select o_orderkey, l_linenumber, case when l_quantity > 25 then 'large' else 'small' end as role from orders
    join lineitem on l_orderkey = o_orderkey and ((o_orderstatus = 'F' and l_quantity > 25) or (o_orderstatus = 'O' and l_quantity <= 25) or o_orderstatus = 'P')""",
)
def role_or_join(t: Tables) -> DataFrame:
    """An equi-join on a key of few rows; which of them fit depends on the other side's role."""
    large, status = F.col("l_quantity") > 25, F.col("o_orderstatus")
    role = ((status == "F") & large) | ((status == "O") & ~large) | (status == "P")
    out = t.orders.join(t.lineitem, (F.col("o_orderkey") == F.col("l_orderkey")) & role)
    return out.select("o_orderkey", "l_linenumber", F.when(large, "large").otherwise("small").alias("role"))


@query(
    "J5 J30",
    """with h as (select o_custkey, o_orderstatus as s, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by all)
    select a.o_custkey, a.n as h_n, a.total as h_total, b.n as a_n, b.total as a_total from h a join h b on a.o_custkey = b.o_custkey and a.s = 'F' and b.s = 'O'""",
)
def pivot_home_away(t: Tables) -> DataFrame:
    by = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    side = lambda s, p: by.where(F.col("o_orderstatus") == s).select("o_custkey", F.col("n").alias(f"{p}_n"), F.col("total").alias(f"{p}_total"))
    return side("F", "h").join(side("O", "a"), "o_custkey")


@query(
    "J6",
    """with s as (select o_orderpriority as team, year(o_orderdate) as match, count(*) as n from orders group by all)
    select a.match, a.team, b.team as opp_team, a.n, b.n as opp_n from s a join s b on a.match = b.match and a.team <> b.team""",
)
def opponent_self_join(t: Tables) -> DataFrame:
    s = t.orders.groupBy(F.col("o_orderpriority").alias("team"), F.year("o_orderdate").cast("long").alias("match")).agg(F.count("*").alias("n"))
    return j.opponent(s, "match", "team", ["n"])


@query(
    "J7",
    """select a.l_orderkey, a.l_partkey as part_a, b.l_partkey as part_b, count(*) as n from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_partkey < b.l_partkey group by all""",
)
def mirror_pairs(t: Tables) -> DataFrame:
    a = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("part_a"))
    b = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("part_b"))
    return a.join(b, (F.col("l_orderkey") == F.col("o")) & (F.col("part_a") < F.col("part_b"))).groupBy("l_orderkey", "part_a", "part_b").agg(F.count("*").alias("n"))


@query(
    "J8",
    """with e as (select *, case when event_type = 'error' then row_number() over (partition by user_id, event_type order by ts, event_id) end as cum from events)
    select a.event_id, coalesce(max(b.cum), 0) as errors from e a left join e b on a.user_id = b.user_id and b.ts <= a.ts group by 1""",
)
def asof_cum_max(t: Tables) -> DataFrame:
    """Running counts up to the row's time, rows of the same time included: a window with peers, where the reference joins by inequality."""
    n = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id"))
    cum = t.events.withColumn("cum", F.when(F.col("event_type") == "error", n).cast("long"))
    upto = Window.partitionBy("user_id").orderBy("ts")  # the default frame has the peers
    return cum.select("event_id", F.coalesce(F.max("cum").over(upto), F.lit(0).cast("long")).alias("errors"))


@query(
    "J9 J10 T8",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::varchar as shipped, o.o_orderkey as last_order from (
      select l.*, x.o_custkey, row_number() over () as rid from lineitem l join orders x on l_orderkey = x.o_orderkey) l
    left join orders o on o.o_custkey = l.o_custkey and o.o_orderdate < l.l_shipdate
    qualify row_number() over (partition by rid order by o.o_orderdate desc, o.o_orderkey desc) = 1""",
)
def asof_before(t: Tables) -> DataFrame:
    """The customer's latest order strictly before each shipping date."""
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    found = j.asof_latest(lines, t.orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("last_order")), ["o_custkey"], "l_shipdate", "o_orderdate", ["last_order"], tie="last_order")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"), "last_order")


@query(
    "J12",
    """select a.event_id, min(struct_pack(ts := b.ts, event_id := b.event_id)).event_id as next_buy from events a left join events b
    on a.user_id = b.user_id and b.event_type = 'purchase' and (b.ts, b.event_id) > (a.ts, a.event_id) group by 1""",
)
def next_after(t: Tables) -> DataFrame:
    bought = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return t.events.select("event_id", j.next_after(bought, ["user_id"], ["ts", "event_id"]).alias("next_buy"))


@query(
    "J13",
    """select a.event_id, count(b.event_id) as near from events a left join events b on a.user_id = b.user_id and b.event_type = 'view'
    and epoch(b.ts) > epoch(a.ts) and epoch(b.ts) <= epoch(a.ts) + 864000 where a.event_type = 'error' group by 1""",
)
def band_minutes(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"))
    a = e.where("event_type = 'error'").select("event_id", "user_id", "s")
    b = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("other"), F.col("s").alias("s2"))
    found = j.band(a, b, ["user_id"], (F.col("s2") > F.col("s")) & (F.col("s2") <= F.col("s") + 864000), "left")
    return found.groupBy("event_id").agg(F.count("other").alias("near"))


@query(
    "J14",
    """select a.event_id, b.event_id as other from events a join events b on a.user_id = b.user_id and a.event_type = 'purchase' and b.event_type = 'click'
    and abs(epoch(a.ts)::bigint - epoch(b.ts)::bigint) <= 86400""",
)
def band_binned(t: Tables) -> DataFrame:
    """Seconds are rounded as the SQL's cast to a whole number does, halves to even."""
    s = F.rint(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("long")
    e = t.events.select("event_id", "user_id", "event_type", s.alias("s"))
    a = e.where("event_type = 'purchase'").select("event_id", "user_id", "s")
    b = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("other"), F.col("s").alias("s2"))
    return j.binned_band(a, b, ["user_id"], "s", "s2", 86400).select("event_id", "other")


@query(
    "J15 J16 T21",
    """select o_orderkey, count(o_orderkey) over w as n, round(sum(o_totalprice) over w, 2) as spent, round(avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 5 preceding and 1 preceding), 5) as last5
    from orders window w as (partition by o_custkey order by cast(o_orderdate as date) range between interval 180 days preceding and interval 1 day preceding)""",
)
def interval_days(t: Tables) -> DataFrame:
    b = j.days_before(["o_custkey"], F.to_date("o_orderdate"), 180)
    last5 = F.avg("o_totalprice").over(w.previous(["o_custkey"], ["o_orderdate", "o_orderkey"], 5))
    return t.orders.select("o_orderkey", F.count("o_orderkey").over(b).alias("n"), F.round(F.sum("o_totalprice").over(b), 2).alias("spent"), F.round(last5, 5).alias("last5"))


@query(
    "J17",
    """with s as (select o_orderpriority, year(o_orderdate) as yr, avg(o_totalprice) as m from orders group by all)
    select a.o_orderpriority, a.yr, round(avg(b.m), 4) as prior from s a left join s b on a.o_orderpriority = b.o_orderpriority and b.yr < a.yr group by all""",
)
def season_prior_mean(t: Tables) -> DataFrame:
    s = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").cast("long").alias("yr")).agg(F.avg("o_totalprice").alias("m"))
    return s.select("o_orderpriority", "yr", F.round(F.avg("m").over(w.before(["o_orderpriority"], ["yr"])), 4).alias("prior"))


@query("J18", "select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 45)")
def semi_in(t: Tables) -> DataFrame:
    return j.semi(t.orders, t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"]).select("o_orderkey")


@query(
    "J19",
    """select o_custkey, count(*) filter (where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')) as returned, count(*) as n from orders group by 1""",
)
def exists_filter(t: Tables) -> DataFrame:
    back = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return j.flagged(t.orders, back, ["o_orderkey"], "back").groupBy("o_custkey").agg(F.count_if("back").alias("returned"), F.count("*").alias("n"))


@query("J20 J23 U5 I2", "select o_orderkey from orders o where not exists (select 1 from lineitem where l_orderkey = o.o_orderkey)")
def anti_key(t: Tables) -> DataFrame:
    return j.anti(t.orders, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"]).select("o_orderkey")


@query(
    "J21 J22 I3",
    "select distinct l_partkey, l_suppkey from lineitem a where year(l_shipdate) >= 1998 and not exists (select 1 from lineitem b where year(b.l_shipdate) < 1998 and a.l_partkey = b.l_partkey and a.l_suppkey = b.l_suppkey)",
)
def anti_tuple(t: Tables) -> DataFrame:
    late = F.year("l_shipdate") >= 1998
    return j.anti(t.lineitem.where(late), t.lineitem.where(~late), ["l_partkey", "l_suppkey"]).select("l_partkey", "l_suppkey").distinct()


@query("T4", "select n_nationkey from nation where not exists (select 1 from (select case when c_nationkey < 20 then c_nationkey end as k from customer) where k = n_nationkey)")
def anti_null(t: Tables) -> DataFrame:
    other = t.customer.select(F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).alias("n_nationkey"))
    return j.anti(t.nation, other, ["n_nationkey"]).select("n_nationkey")


@query("J24 J28 I1", "select event_id from events where ts > (select max(ts) from events where event_type = 'signup')")
def scalar_watermark(t: Tables) -> DataFrame:
    """The mark is one row, so the cross join adds a column."""
    mark = t.events.where("event_type = 'signup'").agg(F.max("ts").alias("mark"))
    return t.events.join(F.broadcast(mark), F.col("ts") > F.col("mark")).select("event_id")


@query(
    "J27",
    """select o_orderkey, (select min(p_retailprice) from part where p_size = (o_custkey % 50) + 1) as least from orders""",
)
def scalar_lookup(t: Tables) -> DataFrame:
    least = t.part.groupBy("p_size").agg(F.min("p_retailprice").alias("least"))
    return t.orders.join(least, (F.col("o_custkey") % 50) + 1 == F.col("p_size"), "left").select("o_orderkey", "least")


@query(
    "J29",
    """with a as (select l_partkey as k, count(*) as lines from lineitem where l_returnflag = 'R' group by 1), b as (select l_partkey as k, round(sum(l_quantity), 2) as qty from lineitem where l_discount > 0.08 group by 1),
    c as (select p_partkey as k, p_size from part where p_size < 10), u as (select k from a union select k from b union select k from c)
    select u.k, lines, qty, p_size from u left join a using (k) left join b using (k) left join c using (k)""",
)
def master_left_chain(t: Tables) -> DataFrame:
    a = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("k")).agg(F.count("*").alias("lines"))
    b = t.lineitem.where("l_discount > 0.08").groupBy(F.col("l_partkey").alias("k")).agg(F.round(F.sum("l_quantity"), 2).alias("qty"))
    c = t.part.where("p_size < 10").select(F.col("p_partkey").alias("k"), "p_size")
    return j.chain([a, b, c], ["k"])


@query("J31", "select o_orderkey, s_name, c_mktsegment from orders join customer on o_custkey = c_custkey left join supplier on s_suppkey = o_orderkey % 150")
def prediction_join(t: Tables) -> DataFrame:
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return o.join(t.supplier, F.col("s_suppkey") == F.col("o_orderkey") % 150, "left").select("o_orderkey", "s_name", "c_mktsegment")


@query(
    "J32 J34",
    """with d as (select p_brand, min(p_name) as canon from part where p_size > 25 group by 1), e as (select lower(p_brand) as slug, min(p_type) as kind from part where p_size <= 25 and p_retailprice > 1000 group by 1)
    select p_partkey, coalesce(d.canon, e.kind, 'Minor') as name from part left join d on part.p_name = d.canon left join e on lower(part.p_brand) = e.slug and p_size < 30""",
)
def slug_lookup(t: Tables) -> DataFrame:
    d = t.part.where("p_size > 25").groupBy("p_brand").agg(F.min("p_name").alias("canon")).select("canon")
    e = t.part.where("p_size <= 25 and p_retailprice > 1000").groupBy(F.lower("p_brand").alias("slug")).agg(F.min("p_type").alias("kind"))
    p = t.part.join(d, F.col("p_name") == F.col("canon"), "left").join(e, (F.lower("p_brand") == F.col("slug")) & (F.col("p_size") < 30), "left")
    return j.best_lookup(p, [F.col("canon"), F.col("kind")], F.lit("Minor"), "name").select("p_partkey", "name")


@query("J33")
def fuzzy_best(t: Tables) -> DataFrame:
    """Part names with their words reversed and a letter dropped, matched with the part names."""
    at = F.pmod(F.col("p_partkey"), F.length("p_name")).cast("int")
    edited = F.concat(F.substring("p_name", F.lit(1), at), F.expr("substring(p_name, int(pmod(p_partkey, length(p_name))) + 2)"))
    noisy = t.part.select(F.concat_ws(" ", F.reverse(F.split(edited, " "))).alias("noisy"))
    return j.fuzzy_best(noisy, t.part, "noisy", "p_name", 90.0)


@query(
    "J35",
    """with k as (select distinct user_id from events), p as (select user_id, count(*) as n from events where event_type = 'purchase' group by 1)
    select c_custkey, case when k.user_id is not null then coalesce(p.n, 0) end as buys from customer left join k on c_custkey = k.user_id left join p on c_custkey = p.user_id""",
)
def coverage_zero_vs_null(t: Tables) -> DataFrame:
    per = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count_if(F.col("event_type") == "purchase").alias("n"), F.lit(True).alias("seen"))
    c = t.customer.join(per, "c_custkey", "left")
    return c.select("c_custkey", j.covered(c, F.col("n"), F.col("seen").isNotNull()).alias("buys"))


@query(
    "J36",
    """select n_nationkey, count(*) as n from nation join (select c_nationkey as a, (c_nationkey * 7) % 25 as b from customer) on n_nationkey = a or n_nationkey = b group by 1""",
)
def or_columns(t: Tables) -> DataFrame:
    """A row that matches by both columns counts once, so both columns become one distinct list."""
    both = t.customer.select(F.explode(F.array_distinct(F.array("c_nationkey", (F.col("c_nationkey") * 7) % 25))).alias("n_nationkey"))
    return t.nation.join(both, "n_nationkey").groupBy("n_nationkey").agg(F.count("*").alias("n"))


@query(
    "J37 Q7",
    """select count(*) as total, count(l.k) as matched, round(100.0 * count(l.k) / count(*), 3) as percent, 100.0 * count(l.k) / count(*) >= 95 as enough
    from orders left join (select distinct l_orderkey as k from lineitem) l on o_orderkey = k""",
)
def join_rate_audit(t: Tables) -> DataFrame:
    there = j.flagged(t.orders, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"], "there")
    percent = 100.0 * F.count_if("there") / F.count("*")
    return there.agg(F.count("*").alias("total"), F.count_if("there").alias("matched"), F.round(percent, 3).alias("percent"), (percent >= 95).alias("enough"))


@query("J25", "select p_partkey, unnest(range(1, len(string_split(p_name, ' ')) + 1)) as place, unnest(string_split(p_name, ' ')) as word from part")
def lateral_unnest(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "word")).select("p_partkey", (F.col("i") + 1).cast("long").alias("place"), "word")


@query("U1", "select c_custkey as k, c_name as name from customer union all select s_suppkey, s_name from supplier union all select c_custkey, c_name from customer where c_acctbal < 0")
def union_all(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return c.union(t.supplier.select("s_suppkey", "s_name")).union(t.customer.where("c_acctbal < 0").select("c_custkey", "c_name"))


@query("U2", "select c_nationkey as k from customer union select s_nationkey from supplier")
def union_distinct(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("U3", "select e.vec_id, i as place, round(embedding[i + 1]::double, 6) as value from embeddings e, range(0, 64) r(i)")
def unroll_positions(t: Tables) -> DataFrame:
    """One explode instead of a union of as many selections."""
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("place", "v")).select("vec_id", F.col("place").cast("long").alias("place"), F.round(F.col("v").cast("double"), 6).alias("value"))


@query("U4 S1", "select c_custkey as k, c_name as name, c_mktsegment as segment, null::double as balance from customer union all by name select s_suppkey as k, s_name as name, s_acctbal as balance from supplier")
def by_name_union(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return c.unionByName(t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), allowMissingColumns=True)
