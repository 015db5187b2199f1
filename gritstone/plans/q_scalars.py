"""Queries of projections, predicates and scalar functions (inventory 2.3 and 2.9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.functions import scalars as s
from gritstone.operators.windows import ratio
from gritstone.plans.registry import Tables, query

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_L = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("P1 P2 P3 P4", "select o_orderkey as match_id, o_custkey as team_id, o_totalprice as goals, o_orderdate::varchar as played from orders")
def project_rename(t: Tables) -> DataFrame:
    names = {"o_orderkey": "match_id", "o_custkey": "team_id", "o_totalprice": "goals", "absent": "nothing"}
    kept = t.orders.drop("o_orderpriority", "o_orderstatus", "not_there").withColumnsRenamed(names)
    return kept.withColumn("played", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).drop("o_orderdate")


@query("P5 P6 P7", "select p_partkey, try_cast(nullif(trim(case when p_size % 3 = 0 then '  ' when p_size % 3 = 1 then p_size::varchar || ' ' else p_name end), '') as double) as size from part")
def blank_cast(t: Tables) -> DataFrame:
    raw = F.when(F.col("p_size") % 3 == 0, "  ").when(F.col("p_size") % 3 == 1, F.concat(F.col("p_size").cast("string"), F.lit(" "))).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", s.blank_to_double(raw).alias("size"))


@query("P8 P10", "select event_id, coalesce(case when event_type <> 'error' then value end, 0) as value from events where event_type <> 'signup'")
def zero_fill_reject(t: Tables) -> DataFrame:
    own = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), F.when(F.col("event_type") != "signup", F.col("event_type")).alias("kind"))
    return own.dropna(subset=["event_id", "kind"]).fillna(0.0, ["value"]).drop("kind")


@query("P13", "select o_orderkey, try_cast(substr(case when o_orderkey % 5 = 0 then 'n/a' else o_orderdate::varchar end, 1, 10) as date)::varchar as day, case when o_orderkey % 5 <> 0 then o_orderdate::date::varchar end as day_first from orders")
def date_coercion(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.col("o_orderdate").cast("string"))
    european = F.when(F.col("o_orderkey") % 5 == 0, "31/31/99").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return t.orders.select("o_orderkey", s.iso_date(text).cast("string").alias("day"), s.day_first(european).cast("string").alias("day_first"))


@query(
    "P14 T6",
    """select o_orderkey, y || '-' || (y + 1) as season from (select o_orderkey, year(o_orderdate) as y from orders)""",
)
def season_norm(t: Tables) -> DataFrame:
    y = F.year("o_orderdate")
    last = F.lpad(((y + 1) % 100).cast("string"), 2, "0")
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string")))
        .when(F.col("o_orderkey") % 4 == 1, F.concat(y.cast("string"), F.lit("/"), last))
        .when(F.col("o_orderkey") % 4 == 2, F.concat(F.substring(y.cast("string"), 3, 2), F.lit("-"), last))
        .otherwise(y.cast("string"))
    )
    return t.orders.select("o_orderkey", s.season(text).alias("season"))


@query(
    "P15 P23",
    """select o_orderkey, case when r = 'D' then 'D' when (r = 'W') = (v <> 'Away') then 'H' else 'A' end as code, case when v = 'Home' then o_totalprice else o_custkey end as own from
    (select *, case o_orderstatus when 'F' then 'W' when 'O' then 'L' else 'D' end as r, case o_orderkey % 3 when 0 then 'Home' when 1 then 'Away' else 'Neutral' end as v from orders)""",
)
def result_encoder(t: Tables) -> DataFrame:
    r = F.when(F.col("o_orderstatus") == "F", "W").when(F.col("o_orderstatus") == "O", "L").otherwise("D")
    k = F.col("o_orderkey") % 3
    v = F.when(k == 0, "Home").when(k == 1, "Away").otherwise("Neutral")
    return t.orders.select("o_orderkey", s.result_code(r, v).alias("code"), F.when(v == "Home", F.col("o_totalprice")).otherwise(F.col("o_custkey").cast("double")).alias("own"))


_ODDS = "1 + l_quantity / 10 as h, 1 + l_extendedprice / 20000 as d, 1 + l_tax * 50 as a"


@query(
    "P16",
    f"select {_L}, round((1 / h) / (1 / h + 1 / d + 1 / a), 6) as p_h, round((1 / d) / (1 / h + 1 / d + 1 / a), 6) as p_d, round((1 / a) / (1 / h + 1 / d + 1 / a), 6) as p_a from (select *, {_ODDS} from lineitem)",
)
def implied_prob(t: Tables) -> DataFrame:
    odds = [1 + F.col("l_quantity") / 10, 1 + F.col("l_extendedprice") / 20000, 1 + F.col("l_tax") * 50]
    return t.lineitem.select(*LINE, *(F.round(p, 6).alias(f"p_{k}") for p, k in zip(s.implied(odds), "hda")))


_DCPW = """least(greatest(l_quantity * 2, 0), 100) / 100 as d, case when l_returnflag = 'R' and l_linestatus = 'F' then 1.0 when l_returnflag = 'A' then 0.6 when l_linestatus = 'O' then 0.3 end as c,
case when l_tax >= 0.06 then least(1, 0.9 + case when l_quantity < 25 then 0.2 else 0 end) when l_tax >= 0.03 then least(1, 0.5 + case when l_quantity < 25 then 0.2 else 0 end) else 0.1 end as p,
case when l_discount < 0.03 then 0.5 when l_discount < 0.06 then 0.8 else 1.0 end as w"""


@query(
    "P17 P18 P19 P20 P21 P22",
    f"""select {_L}, round(c::double, 4) as chance, round(p::double, 4) as pressure, round(w::double, 4) as weight, round(case when l_linestatus = 'O' then d * c * (0.5 + 0.3 * p + 0.2 * w) when c is not null then sqrt(d * c) * (0.5 + 0.3 * p + 0.2 * w) end, 6) as action_value
    from (select *, {_DCPW} from lineitem)""",
)
def action_value(t: Tables) -> DataFrame:
    """Five axes by priority ladders, and their composite: a root for one class of actions, a product for the other."""
    q = F.col("l_quantity")
    d = F.least(F.greatest(q * 2, F.lit(0.0)), F.lit(100.0)) / 100
    c = s.ladder([((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1.0), (F.col("l_returnflag") == "A", 0.6), (F.col("l_linestatus") == "O", 0.3)])
    bonus = F.when(q < 25, 0.2).otherwise(0.0)
    p = s.ladder([(F.col("l_tax") >= 0.06, F.least(F.lit(1.0), 0.9 + bonus)), (F.col("l_tax") >= 0.03, F.least(F.lit(1.0), 0.5 + bonus))], F.lit(0.1))
    w = s.ladder([(F.col("l_discount") < 0.03, 0.5), (F.col("l_discount") < 0.06, 0.8)], F.lit(1.0))
    axes = t.lineitem.select(*LINE, "l_linestatus", d.alias("d"), c.alias("c"), p.alias("p"), w.alias("w"))
    mix = 0.5 + 0.3 * F.col("p") + 0.2 * F.col("w")
    value = F.when(F.col("l_linestatus") == "O", F.col("d") * F.col("c") * mix).when(F.col("c").isNotNull(), F.sqrt(F.col("d") * F.col("c")) * mix)
    return axes.select(*LINE, F.round("c", 4).alias("chance"), F.round("p", 4).alias("pressure"), F.round("w", 4).alias("weight"), F.round(value, 6).alias("action_value"))


@query("P24 P25", "select o_orderkey from orders where not (o_orderstatus = 'F' and o_totalprice > 200000) and o_orderpriority in ('1-URGENT', '2-HIGH') and o_totalprice between 1000 and 400000 and o_orderpriority not like '3%' and o_orderpriority ilike '%h%'")
def predicates(t: Tables) -> DataFrame:
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)
    p = F.col("o_orderpriority")
    return t.orders.where(~gone).where(p.isin("1-URGENT", "2-HIGH") & F.col("o_totalprice").between(1000, 400000) & ~p.like("3%") & p.ilike("%h%")).select("o_orderkey")


@query("P27", f"select {_L}, case when l_quantity > 30 and l_discount < 0.05 then true else false end as progressive, case when l_tax > 0.04 or l_returnflag = 'R' then 1 else 0 end as creative from lineitem")
def threshold_flags(t: Tables) -> DataFrame:
    progressive = F.when((F.col("l_quantity") > 30) & (F.col("l_discount") < 0.05), True).otherwise(False)
    return t.lineitem.select(*LINE, progressive.alias("progressive"), F.when((F.col("l_tax") > 0.04) | (F.col("l_returnflag") == "R"), 1).otherwise(0).alias("creative"))


@query(
    "P28",
    f"""select {_L}, case when x < 100.0 / 3 then 'A' when x < 200.0 / 3 then 'B' else 'C' end || case when y < 20 then '1' when y < 40 then '2' when y < 60 then '3' when y < 80 then '4' else '5' end as zone
    from (select *, l_quantity * 2 as x, l_discount * 1000 as y from lineitem)""",
)
def zone_code(t: Tables) -> DataFrame:
    return t.lineitem.select(*LINE, s.zone(F.col("l_quantity") * 2, F.col("l_discount") * 1000).alias("zone"))


_W, _T = 9.6, 38.0


@query(
    "P29",
    f"""select {_L}, case when z < 38.0 / 3 then 'low' when z < 76.0 / 3 then 'mid' else 'high' end || '_' || case when y < 45.2 + 3.2 then 'left' when y < 45.2 + 6.4 then 'centre' else 'right' end as zone,
    round(abs(y - 50) / 4.8, 6) as "offset", round(least(sqrt(pow((y - 45.2) / 9.6, 2) + pow(z / 38, 2)), sqrt(pow((y - 45.2) / 9.6, 2) + pow((z - 38) / 38, 2)), sqrt(pow((y - 54.8) / 9.6, 2) + pow(z / 38, 2)), sqrt(pow((y - 54.8) / 9.6, 2) + pow((z - 38) / 38, 2))), 4) as corner_distance
    from (select *, 45.2::double + l_quantity * 0.191 as y, l_discount::double * 379 as z from lineitem)""",
)
def shot_placement(t: Tables) -> DataFrame:
    zone, offset, corner = s.goal_mouth(F.lit(45.2) + F.col("l_quantity") * 0.191, F.col("l_discount") * 379)
    return t.lineitem.select(*LINE, zone, F.round(offset, 6).alias("offset"), F.round(corner, 4).alias("corner_distance"))


@query(
    "P30",
    f"""select {_L}, round(sqrt(dx * dx + dy * dy), 5) as distance, round(degrees(acos(greatest(-1, least(1, (dx * dx + (dy - 3.66) * (dy + 3.66)) / nullif(sqrt(dx * dx + pow(dy - 3.66, 2)) * sqrt(dx * dx + pow(dy + 3.66, 2)), 0))))), 4) as angle
    from (select *, (100 - l_quantity * 1.9) * 1.05 as dx, (l_tax * 1000 - 50) * 0.68 as dy from lineitem)""",
)
def geometry_angle(t: Tables) -> DataFrame:
    distance, angle = s.set_piece(F.col("l_quantity") * 1.9, F.col("l_tax") * 1000)
    return t.lineitem.select(*LINE, F.round(distance, 5).alias("distance"), F.round(angle, 4).alias("angle"))


@query(
    "P31 P32",
    f"""select {_L}, case when l_quantity < 10 then 'near_post' when l_quantity < 40 then 'centre' else 'far_post' end as landing, case when l_returnflag = 'R' then 'shot' when l_linestatus = 'F' then 'cleared' when l_tax > 0.05 then 'lost' else 'kept' end as outcome from lineitem""",
)
def set_piece_classes(t: Tables) -> DataFrame:
    landing = s.ladder([(F.col("l_quantity") < 10, "near_post"), (F.col("l_quantity") < 40, "centre")], "far_post")
    outcome = s.ladder([(F.col("l_returnflag") == "R", "shot"), (F.col("l_linestatus") == "F", "cleared"), (F.col("l_tax") > 0.05, "lost")], "kept")
    return t.lineitem.select(*LINE, landing.alias("landing"), outcome.alias("outcome"))


@query(
    "P33",
    """select p_partkey, try_cast(split_part(f, '-', 1) as integer) as defenders, case when n = 3 then try_cast(split_part(f, '-', 2) as integer) when n = 4 then try_cast(split_part(f, '-', 2) as integer) + try_cast(split_part(f, '-', 3) as integer) end as midfielders,
    try_cast(split_part(f, '-', -1) as integer) as attackers from (select *, len(string_split(f, '-')) as n from (select p_partkey, case p_size % 3 when 0 then '4-3-3' when 1 then '4-2-3-1' else '3-5-' || (p_size % 4) end as f from part))""",
)
def formation_parts(t: Tables) -> DataFrame:
    k = F.col("p_size") % 3
    f = F.when(k == 0, "4-3-3").when(k == 1, "4-2-3-1").otherwise(F.concat(F.lit("3-5-"), (F.col("p_size") % 4).cast("string")))
    return t.part.select("p_partkey", *s.formation(f))


@query("P34 P41 K11", "select c_custkey, c_acctbal, null::double as h2h_rate, null::varchar as formation from customer")
def align_columns(t: Tables) -> DataFrame:
    """Expected columns in order; those that the table lacks are typed nulls."""
    expected = {"c_custkey": "bigint", "c_acctbal": "double", "h2h_rate": "double", "formation": "string"}
    df = t.customer
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in expected.items()))


@query(
    "P35 P37",
    """select l_suppkey, round(case when r > 0 then a / r end, 6) as f_ratio, round(ln((a + 1.0) / (r + 1.0)), 6) as f_log, round(abs(a - r) * 1.0 / nullif(n, 0), 6) as f_diff, round(greatest(a * 1.0 / n - 0.3, 0) * case when r > 100 then 1 else 0 end, 6) as upset
    from (select l_suppkey, count(*) filter (where l_returnflag = 'A')::double as a, count(*) filter (where l_returnflag = 'R')::double as r, count(*)::double as n from lineitem group by 1)""",
)
def draw_signals(t: Tables) -> DataFrame:
    count = lambda f: F.count_if(F.col("l_returnflag") == f).cast("double")
    by = t.lineitem.groupBy("l_suppkey").agg(count("A").alias("a"), count("R").alias("r"), F.count("*").cast("double").alias("n"))
    a, r, n = F.col("a"), F.col("r"), F.col("n")
    upset = F.greatest(ratio(a, n) - 0.3, F.lit(0.0)) * F.when(r > 100, 1).otherwise(0)
    return by.select("l_suppkey", F.round(F.when(r > 0, ratio(a, r)), 6).alias("f_ratio"), F.round(F.ln((a + 1) / (r + 1)), 6).alias("f_log"), F.round(ratio(F.abs(a - r), n), 6).alias("f_diff"), F.round(upset, 6).alias("upset"))


@query(
    "P36",
    """with s as (select o_orderpriority as team, year(o_orderdate) as match, avg(o_totalprice) as x_3, count(*)::double as x_5 from orders group by all)
    select a.match, a.team, b.team as opp, round(a.x_3 - b.x_3, 4) as diff_x_3, round(a.x_5 - b.x_5, 4) as diff_x_5 from s a join s b on a.match = b.match and a.team <> b.team""",
)
def differentials(t: Tables) -> DataFrame:
    s_ = t.orders.groupBy(F.col("o_orderpriority").alias("team"), F.year("o_orderdate").cast("long").alias("match")).agg(F.avg("o_totalprice").alias("x_3"), F.count("*").cast("double").alias("x_5"))
    b = s_.select(F.col("team").alias("opp"), F.col("match").alias("m"), F.col("x_3").alias("o_x_3"), F.col("x_5").alias("o_x_5"))
    both = s_.join(b, (F.col("match") == F.col("m")) & (F.col("team") != F.col("opp")))
    return both.select("match", "team", "opp", *(F.round(F.col(c) - F.col(f"o_{c}"), 4).alias(f"diff_{c}") for c in ("x_3", "x_5")))


@query("P38 P39", "select o_orderkey, case when year(o_orderdate) < 1996 then 'train' when year(o_orderdate) < 1998 then 'val' else 'test' end as part from orders where o_orderstatus in ('F', 'O') and o_totalprice > 1000")
def temporal_split(t: Tables) -> DataFrame:
    chosen = {"o_orderstatus": ["F", "O"]}
    df = t.orders.where("o_totalprice > 1000")
    for c, values in chosen.items():
        df = df.where(F.col(c).isin(values))
    y = F.year("o_orderdate")
    return df.select("o_orderkey", F.when(y < 1996, "train").when(y < 1998, "val").otherwise("test").alias("part"))


@query(
    "P45",
    """with n as (select distinct p_name from part), k as (select p_name, row_number() over (order by p_name) as r from n)
    select p_name, case when p_name like 'a%' then 1 else cast('20240101' || lpad(r::varchar, 6, '0') as bigint) end as team_id from k""",
)
def surrogate_ids(t: Tables) -> DataFrame:
    """A dimension of distinct names is ranked as a whole; known ids stay."""
    from gritstone.operators.ranks import dense_positions

    names = dense_positions(t.part.select("p_name").distinct(), "p_name", "r")
    known = F.when(F.col("p_name").like("a%"), F.lit(1).cast("long"))
    return names.select("p_name", F.coalesce(known, s.surrogate(F.lit("20240101"), F.col("r"), 6)).alias("team_id"))


@query("P43 S21", "select p_partkey, case p_size % 3 when 0 then p_size * 1000.0::double + 10 when 1 then p_size * 1.0::double else p_size / 1000.0::double end as value from part")
def market_values(t: Tables) -> DataFrame:
    n, k = F.col("p_size").cast("string"), F.col("p_size") % 3
    text = F.when(k == 0, F.concat(n, F.lit(",01 Mrd. €"))).when(k == 1, F.concat(n, F.lit(" mio. €"))).otherwise(F.concat(n, F.lit(" Tsd. €")))
    return t.part.select("p_partkey", s.market_value(text).alias("value"))


@query("slug", "select p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') as slug, regexp_replace('eng' || upper(p_name), '^[a-z]{2,3}([A-Z])', '\\1') as stripped from part")
def slugify(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", s.slug(F.col("p_name")).alias("slug"), s.strip_country_prefix(F.concat(F.lit("eng"), F.upper("p_name"))).alias("stripped"))


@query(
    "D13 hash",
    "select o_orderkey, sha1(concat_ws('|', o_orderkey::varchar, o_orderstatus, o_orderpriority)) as key, 'm_' || substr(sha1(concat_ws('|', least(o_orderstatus, o_orderpriority), greatest(o_orderstatus, o_orderpriority), o_custkey::varchar)), 1, 10) as pair from orders",
)
def sha1_key(t: Tables) -> DataFrame:
    key = s.sha_key([F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")])
    return t.orders.select("o_orderkey", key.alias("key"), s.pair_key(F.col("o_orderstatus"), F.col("o_orderpriority"), [F.col("o_custkey")], "m_").alias("pair"))


@query(
    "math date T1 T2",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(sqrt(l_quantity), 6) as root, round(ln(nullif(l_discount, 0)), 6) as log, round(l_extendedprice / nullif(l_tax, 0), 4) as per,
    date_diff('day', timestamp '1992-01-01', l_shipdate) as days, (l_shipdate - interval 14 day)::date::varchar as before from lineitem""",
)
def scalar_functions(t: Tables) -> DataFrame:
    return t.lineitem.select(
        *LINE, F.round(F.sqrt("l_quantity"), 6).alias("root"), F.round(F.ln(F.nullif("l_discount", F.lit(0.0))), 6).alias("log"), F.round(ratio(F.col("l_extendedprice"), F.col("l_tax")), 4).alias("per"),
        F.datediff("l_shipdate", F.lit("1992-01-01")).cast("long").alias("days"), F.date_sub("l_shipdate", 14).cast("string").alias("before"),
    )
