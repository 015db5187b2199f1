"""Queries that write files and tables and read them back: scans, HTML tables, archives and write modes (inventory 2.1, 2.2, 2.8)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritstone.plans.registry import Tables, query
from gritstone.sources import html, match_json, scan, sinks
from gritstone.sources.store import fresh_folder
from gritstone.streaming import incremental

_ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders"


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("S2 K13", "select o_orderkey::varchar as o_orderkey, o_orderstatus, o_custkey from orders")
def csv_round_trip(t: Tables) -> DataFrame:
    """An export, scanned lazily as text; only the columns that are read are parsed."""
    path = fresh_folder(t.spark)
    sinks.csv_export(_orders(t), path)
    return scan.csv(t.spark, path).select("o_orderkey", "o_orderstatus", F.col("o_custkey").cast("long").alias("o_custkey"))


@query("S3", "select 'é' || c_name as name, c_custkey::varchar as key from customer")
def csv_encodings(t: Tables) -> DataFrame:
    """Files of two encodings in one scan: each is decoded by what it is."""
    path = fresh_folder(t.spark)
    own = t.customer.select(F.concat(F.lit("é"), "c_name").alias("name"), F.col("c_custkey").alias("key"))
    for encoding, odd in (("UTF-8", 0), ("ISO-8859-1", 1)):
        own.where(F.col("key") % 2 == odd).write.option("header", True).option("encoding", encoding).csv(f"{path}/{encoding}")
    return scan.csv(t.spark, [f"{path}/UTF-8", f"{path}/ISO-8859-1"])


@query("S14", _ORDERS)
def seed_scan(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark)
    sinks.csv_export(_orders(t), path)
    return scan.seed(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")


def _pages(t: Tables, head: Column, cells: Column, tail: str = "</table>") -> DataFrame:
    """A page for each customer, with a row for each of the customer's orders."""
    rows = t.orders.withColumn("r", cells).groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("r")), "").alias("rows"))
    return rows.select("o_custkey", F.concat(head, "rows", F.lit(tail)).alias("html"))


@query("S4", "select o_custkey, o_orderkey, o_orderstatus, cast(floor(o_totalprice) as bigint) as price from orders")
def html_by_attribute(t: Tables) -> DataFrame:
    """Rows keyed by their cells' attribute; repeated header rows don't count, and a note in brackets goes."""
    td = lambda name, c: F.concat(F.lit(f'<td data-stat="{name}">'), c, F.lit("</td>"))
    head = F.lit('<h1>Orders</h1><table><tr><th data-stat="key">Key</th><th data-stat="status">S</th></tr>')
    price = F.concat(F.floor("o_totalprice").cast("string"), F.lit(" (1)"))
    cells = F.concat(F.lit("<tr>"), td("key", F.col("o_orderkey").cast("string")), td("status", F.col("o_orderstatus")), td("price", price), F.lit("</tr>"))
    found = html.explode_pages(_pages(t, head, cells), "o_custkey", "html")
    c = F.col("cells")
    return found.select("o_custkey", c["key"].cast("long").alias("o_orderkey"), c["status"].alias("o_orderstatus"), c["price"].cast("long").alias("price"))


@query("S5", "select o_custkey, o_orderkey, o_orderstatus as name from orders")
def html_by_header(t: Tables) -> DataFrame:
    """The first table with the wanted headers, after another one; ranks before names go."""
    td = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    head = F.lit("<table><tr><th>Other</th></tr><tr><td>1</td></tr></table><table><tr><th>Key</th><th>Club</th></tr>")
    cells = F.concat(F.lit("<tr>"), td(F.col("o_orderkey").cast("string")), td(F.concat(F.lit("12. "), "o_orderstatus")), F.lit("</tr>"))
    found = html.explode_pages(_pages(t, head, cells), "o_custkey", "html", "header", wanted=["Key", "Club"], least_rows=1)
    c = F.col("cells")
    return found.select("o_custkey", c["Key"].cast("long").alias("o_orderkey"), c["Club"].alias("name"))


@query("S8 S21", "select o_custkey, 'Club ' || o_orderkey as name, o_orderkey::varchar as id, '€' || o_orderkey || 'k' as value from orders")
def html_clubs(t: Tables) -> DataFrame:
    """Club rows by the id in their link, with the last cell that looks like money."""
    key = F.col("o_orderkey").cast("string")
    cells = F.concat(F.lit('<tr><td><a href="/club/verein/'), key, F.lit('/x">Club '), key, F.lit("</a></td><td>€1</td><td>€"), key, F.lit("k</td></tr>"))
    found = html.explode_pages(_pages(t, F.lit("<table><tr><th>Club</th></tr>"), cells), "o_custkey", "html", "links")
    c = F.col("cells")
    return found.select("o_custkey", c["name"].alias("name"), c["id"].alias("id"), c["value"].alias("value"))


def _matches(t: Tables) -> DataFrame:
    """A match archive's object for each nation, by plain arithmetic."""
    n = "n_nationkey"
    player = f"named_struct('playerId', cast({n} * 10 + i as int), 'shirtNo', cast(i as int), 'name', concat('p', i), 'position', 'MF', 'isFirstEleven', i < 2, 'height', 180, 'stats', map('ratings', map('1', 6.0D, '90', 6.5D + i)))"
    side = lambda k, field: (
        f"named_struct('teamId', cast({n} * 2 + {k} as int), 'name', concat('t', {n} * 2 + {k}), 'field', '{field}', 'averageAge', 25.5D, 'stats', map('possession', map('1', 3.0D)), 'players', transform(sequence(0, 2), i -> {player}), "
        f"'formations', array(named_struct('formationId', cast({n} % 4 as int), 'formationName', concat('f', {n} % 4), 'period', 1, 'startMinuteExpanded', 0, 'endMinuteExpanded', 90, 'captainPlayerId', cast({n} * 10 as int), "
        f"'playerIds', array({n} * 10, {n} * 10 + 1), 'formationSlots', array(1, 2), 'formationPositions', array(named_struct('vertical', 1.0D, 'horizontal', 2.0D)))))"
    )
    event = f"named_struct('eventId', cast(i as int), 'minute', cast(i as int), 'second', 2.0D, 'expandedMinute', cast(i as int), 'period', named_struct('value', 1, 'displayName', 'FirstHalf'), 'teamId', cast({n} * 2 + i % 2 as int), 'x', i * 1.5D, 'type', named_struct('value', cast(i % 3 as int), 'displayName', concat('t', i % 3)), 'isTouch', i % 2 = 0)"
    whole = f"to_json(named_struct('matchId', concat('m', {n}), 'events', transform(sequence(0, {n} % 5), i -> {event}), 'home', {side(0, 'home')}, 'away', {side(1, 'away')}, 'playerIdNameDictionary', map('1', concat('n', {n})), 'venueName', n_name, 'ftScore', '1 : 0'))"
    return t.nation.select(n, F.expr(whole).alias("value"))


def _archive(t: Tables) -> DataFrame:
    """One object a file, compressed, in folders by match; read back from all folders below."""
    path = fresh_folder(t.spark)
    _matches(t).repartition("n_nationkey").write.partitionBy("n_nationkey").option("compression", "gzip").text(path)
    return scan.json_files(t.spark, path, match_json.MATCH)


@query("S6 S9", "select 'm' || n_nationkey as ws_match_id, i::integer as row_num, (n_nationkey * 2 + i % 2)::integer as team_id, i * 1.5::double as x, (i % 3)::integer as type_id, i % 2 = 0 as is_touch, false as is_shot from nation, range(0, 5) r(i) where i <= n_nationkey % 5")
def json_archive_events(t: Tables) -> DataFrame:
    return match_json.events(_archive(t)).select("ws_match_id", "row_num", "team_id", "x", "type_id", "is_touch", "is_shot")


@query("S10 S12", "select 'm' || n_nationkey as ws_match_id, (n_nationkey * 2 + k)::integer as team_id, (n_nationkey * 10 + i)::integer as player_id, i < 2 as is_first_eleven, 6.5 + i::double as rating from nation, range(0, 2) s(k), range(0, 3) r(i)")
def json_archive_players(t: Tables) -> DataFrame:
    return match_json.player_match(_archive(t)).select("ws_match_id", "team_id", "player_id", F.coalesce("is_first_eleven", F.lit(False)).alias("is_first_eleven"), "rating")


@query(
    "S10 S11",
    """select 'm' || n_nationkey as ws_match_id, (n_nationkey * 2 + k)::integer as team_id, 't' || (n_nationkey * 2 + k) as name, case k when 0 then 'home' else 'away' end as field, (n_nationkey % 4)::integer as formation_id, 'f' || (n_nationkey % 4) as formation_name,
    '[' || n_nationkey * 10 || ',' || (n_nationkey * 10 + 1) || ']' as player_ids, n_name as venue_name, '1 : 0' as ft_score, 1::bigint as n_names from nation, range(0, 2) s(k)""",
)
def json_archive_facts(t: Tables) -> DataFrame:
    """Team, formation, match and dictionary facts of the archive, beside each other."""
    own = _archive(t)
    sides = own.select(F.col("matchId").alias("ws_match_id"), F.explode(F.array("home", "away")).alias("s")).select("ws_match_id", F.col("s.teamId").alias("team_id"), F.col("s.name").alias("name"))
    team = match_json.team_match(own).select("ws_match_id", "team_id", "field")
    lines = match_json.formations(own).select("ws_match_id", "team_id", "formation_id", "player_ids")
    names = match_json.players_ref(own).agg(F.count("*").alias("n_names"))
    out = sides.join(team, ["ws_match_id", "team_id"]).join(lines, ["ws_match_id", "team_id"]).join(match_json.formations_ref(own), "formation_id")
    out = out.join(match_json.match_meta(own).select("ws_match_id", "venue_name", "ft_score"), "ws_match_id").crossJoin(F.broadcast(names))  # one row
    return out.select("ws_match_id", "team_id", "name", "field", "formation_id", "formation_name", "player_ids", "venue_name", "ft_score", "n_names")


@query("S16", "select 'orders' as tab, o_orderkey as key from orders where o_totalprice > 300000 union all select 'customer', c_custkey from customer where c_acctbal < 0")
def fixture_subset(t: Tables) -> DataFrame:
    """Filtered copies of two tables of another store."""
    made = scan.subset(t.spark, t.sf_dir, fresh_folder(t.spark), {"orders.parquet": "o_totalprice > 300000", "customer.parquet": "c_acctbal < 0"})
    orders, customers = made["orders.parquet"], made["customer.parquet"]
    return orders.select(F.lit("orders").alias("tab"), F.col("o_orderkey").alias("key")).unionByName(customers.select(F.lit("customer").alias("tab"), F.col("c_custkey").alias("key")))


@query("S17", "select c_custkey, w from customer join (values ('BUILDING', 1.5::double), ('MACHINERY', 2.0::double)) s(seg, w) on c_mktsegment = seg")
def registered_frame(t: Tables) -> DataFrame:
    """A frame of the driver as a relation in SQL."""
    scan.register(t.spark, "segment_weights", pd.DataFrame({"seg": ["BUILDING", "MACHINERY"], "w": [1.5, 2.0]}))
    t.customer.createOrReplaceTempView("customers_now")
    return t.spark.sql("select c_custkey, w from customers_now join segment_weights on c_mktsegment = seg")


@query("S19", "select o_orderkey, 'orders feed' as source, true as dated from orders")
def lineage_columns(t: Tables) -> DataFrame:
    own = scan.with_lineage(t.orders, "orders feed")
    return own.select("o_orderkey", "source", F.col("scraped_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$").alias("dated"))


@query("K1 I6", "select o_orderkey, case when o_orderstatus = 'O' then 'second' when o_orderstatus = 'F' then 'first' else 'forced' end as load, o_orderstatus from orders")
def partitioned_outputs(t: Tables) -> DataFrame:
    """Folders by key: those that are there are skipped by the second load, and only forced ones are written anew."""
    path = fresh_folder(t.spark)
    own = t.orders.select("o_orderkey", "o_orderstatus")
    sinks.partitioned(own.where("o_orderstatus <> 'O'").withColumn("load", F.lit("first")), path, ["o_orderstatus"])
    sinks.partitioned(own.withColumn("load", F.lit("second")), path, ["o_orderstatus"])
    sinks.partitioned(own.where("o_orderstatus = 'P'").withColumn("load", F.lit("forced")), path, ["o_orderstatus"], force=True)
    return t.spark.read.parquet(path).select("o_orderkey", "load", "o_orderstatus")


@query("K2 K3", "select o_orderkey, o_totalprice * 2 as price from orders where o_orderkey % 3 = 0")
def replaced_table(t: Tables) -> DataFrame:
    """A table is emptied and filled from another source, then replaced by what is computed from itself."""
    path = fresh_folder(t.spark)
    sinks.replace(t.customer.select(F.col("c_custkey").alias("o_orderkey"), F.col("c_acctbal").alias("price")), path)
    now = sinks.replace(t.orders.select("o_orderkey", F.col("o_totalprice").alias("price")), path)
    return sinks.replace(now.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("price") * 2).alias("price")), path)


@query("K12", "select o_custkey, count(*) as n, max(o_orderkey) as last from orders group by 1 having count(*) > 10")
def staged_table(t: Tables) -> DataFrame:
    """A stage written once and read by name."""
    sinks.stage(t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last")), fresh_folder(t.spark), "orders_by_customer")
    return t.spark.sql("select * from orders_by_customer where n > 10")


@query("K15", "select '## Nations' || chr(10) || chr(10) || '| region | n |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || r || ' | ' || n || ' |', chr(10) order by r) || chr(10) as report from (select n_regionkey as r, count(*) as n from nation group by 1)")
def markdown_report(t: Tables) -> DataFrame:
    """A report table of an aggregate as text."""
    by = t.nation.groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("n")).orderBy("region")
    return t.spark.createDataFrame([(sinks.markdown(by, "Nations"),)], "report string")


@query(
    "I7",
    """select 'new' as mode, o_orderkey from orders where o_orderkey not in (select o_orderkey from orders where o_orderdate < '1995-01-01') union all select 'unfilled', o_orderkey from orders where not (o_orderdate < '1995-01-01' and o_custkey % 2 = 0)
    union all select 'status', o_orderkey from orders where o_orderstatus = 'F' union all (select 'first', o_orderkey from orders order by o_orderkey limit 100)""",
)
def resume_modes(t: Tables) -> DataFrame:
    """What a load that was interrupted still has to do, by each mode."""
    done = t.orders.where("o_orderdate < '1995-01-01'").select("o_orderkey", F.when(F.col("o_custkey") % 2 == 0, "x").alias("slots"))
    key = ["o_orderkey"]
    modes = {
        "new": incremental.resume(t.orders, done, key, skip_existing=True), "unfilled": incremental.resume(t.orders, done, key, missing="slots"), "status": incremental.resume(t.orders, done, key, only=F.col("o_orderstatus") == "F"),
        "first": incremental.resume(t.orders, done, key, most=100),
    }
    first, *rest = (df.select(F.lit(m).alias("mode"), "o_orderkey") for m, df in modes.items())
    for df in rest:
        first = first.unionByName(df)
    return first


@query("I8 I5", "select o_orderkey, case when year(o_orderdate) < 1997 then 2 else 3 end as run from orders union all select o_orderkey, 9 from orders where false")
def full_refresh(t: Tables) -> DataFrame:
    """A stored table after a first load, a full one, and one by watermark."""
    path, at = fresh_folder(t.spark), F.col("o_orderdate")
    run = lambda n: (lambda df: df.select("o_orderkey", "o_orderdate", F.lit(n).alias("run")))
    early = t.orders.where("year(o_orderdate) < 1997")
    incremental.refresh(t.spark, path, early, ["o_orderkey"], run(1))
    incremental.refresh(t.spark, path, early, ["o_orderkey"], run(2), full=True)
    return incremental.refresh(t.spark, path, t.orders, ["o_orderkey"], run(3), mode="mark", mark="o_orderdate").where(at.isNotNull()).select("o_orderkey", "run")
