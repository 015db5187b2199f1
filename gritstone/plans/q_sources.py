"""Queries of sources, sinks and nested types (inventory 2.1, 2.2 and 2.10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.operators import windows as w
from gritstone.plans.registry import Tables, query
from gritstone.sources import html, match_json, scan, sinks
from gritstone.streaming import incremental


@query("S7 D7", "select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k, coalesce(try_cast(json_extract_string(props, '$.k') as integer), 0) > 50 as large from events")
def json_fields(t: Tables) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    return t.events.select("event_id", k.alias("k")).select("event_id", "k", (F.coalesce("k", F.lit(0)) > 50).alias("large"))


@query("S7", "select event_id, try_cast(regexp_extract('var data = ' || props || ';', 'data = \\{\"k\": (\\d+)\\}', 1) as integer) as k from events")
def json_in_script(t: Tables) -> DataFrame:
    page = F.concat(F.lit("<script>var data ="), F.col("props"), F.lit(";</script>"))
    return t.events.select("event_id", scan.embedded_json(page, "data =", "k int")["k"].alias("k"))


@query("S9 S11 F5", "select vec_id, i - 1 as slot, round(embedding[i]::double, 5) as value from embeddings, range(1, 65) r(i) where abs(embedding[i]) > 0.2")
def json_explode(t: Tables) -> DataFrame:
    e = t.embeddings.select("vec_id", F.posexplode("embedding").alias("slot", "v")).where(F.abs("v") > F.lit(0.2).cast("float"))
    return e.select("vec_id", F.col("slot").cast("long").alias("slot"), F.round(F.col("v").cast("double"), 5).alias("value"))


@query("D9 S12", "select vec_id, len(embedding) as n, round(list_sum(list_transform(embedding, lambda x: x::double)), 4) as total, round(list_max(embedding)::double, 5) as top, round(embedding[1]::double, 5) as first from embeddings")
def array_stats(t: Tables) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    return t.embeddings.select(
        "vec_id", F.size("embedding").cast("long").alias("n"), F.round(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.round(F.array_max(e), 5).alias("top"), F.round(F.get(e, F.lit(0)), 5).alias("first")
    )


@query(
    "D8 S12",
    """with m as (select user_id, event_type, event_id, value from events) select user_id, round(sum(value), 4) as total, round(arg_max(value, event_id), 4) as last from m group by 1""",
)
def map_sum(t: Tables) -> DataFrame:
    """A series {event: value} for each user, summed, and the value of its greatest key."""
    series = t.events.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("event_id").cast("string").alias("k"), F.col("value").alias("v")))).alias("m"))
    return series.select("user_id", F.round(match_json.series_sum(F.col("m")), 4).alias("total"), F.round(match_json.last_minute_value(F.col("m")), 4).alias("last"))


@query(
    "J26",
    """select vec_id, i - 1 as place, (vec_id + i * 7) % 11 as slot, round(embedding[((vec_id + i * 7) % 11)]::double, 5) as position from embeddings, range(1, 12) r(i) where (vec_id + i * 7) % 11 > 0""",
)
def slot_lookup(t: Tables) -> DataFrame:
    """Parallel arrays are zipped; a position is looked up by its slot's value, not by the index."""
    slots = F.transform(F.sequence(F.lit(1), F.lit(11)), lambda i: (F.col("vec_id") + i * 7) % 11)
    e = t.embeddings.select("vec_id", "embedding", F.posexplode(slots).alias("place", "slot")).where("slot > 0")
    return e.select("vec_id", F.col("place").cast("long").alias("place"), "slot", F.round(F.get("embedding", (F.col("slot") - 1).cast("int")).cast("double"), 5).alias("position"))


@query("")
def html_extract(t: Tables) -> DataFrame:
    """Title, links and words of each page, by a parser in batches."""
    return html.outlines(t.pages)


@query("S18", "select page_id, regexp_extract(url, '^https?://([^/]+)', 1) as host, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) as lang, try_cast(nullif(regexp_extract(url, '[?&]page=(\\d+)', 1), '') as integer) as page from pages")
def path_metadata(t: Tables) -> DataFrame:
    u = F.col("url")
    part = lambda p: F.coalesce(scan.path_part(p, path=u), F.lit(""))
    return t.pages.select("page_id", part("^https?://([^/]+)").alias("host"), part("^https?://[^/]+/([a-z]{2})/").alias("lang"), scan.path_part(r"[?&]page=(\d+)", path=u).try_cast("int").alias("page"))


@query("S15", "select 'orders' as name, column_name as \"column\" from (describe orders)")
def catalog_columns(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("orders")
    return scan.tables_like(t.spark, "orders").select("name", "column")


@query("S20", "select o_orderkey as match_id, o_totalprice as prob_H from orders")
def alias_scan(t: Tables) -> DataFrame:
    return scan.first_present(t.orders, {"match_id": ["final_match_id", "o_orderkey"], "prob_H": ["prob_home", "o_totalprice"], "absent": ["nothing"]})


@query("K4 K7 I2", "select o_orderkey, o_custkey, case when year(o_orderdate) < 1997 then 'old' else 'new' end as load from orders")
def incr_insert(t: Tables) -> DataFrame:
    """The table as loaded before 1997, then all of it again: seen keys stay as they are."""
    cols = ["o_orderkey", "o_custkey"]
    old = t.orders.where(F.year("o_orderdate") < 1997).select(*cols, F.lit("old").alias("load"))
    return sinks.merged_insert(old, t.orders.select(*cols, F.lit("new").alias("load")), ["o_orderkey"])


@query("K5 K8 K9", "select o_orderkey, case when year(o_orderdate) >= 1997 then o_totalprice * 2 else o_totalprice end as price from orders")
def delete_insert(t: Tables) -> DataFrame:
    """The whole table, then a reload of the orders since 1997 at other prices."""
    old = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"))
    new = t.orders.where(F.year("o_orderdate") >= 1997).select("o_orderkey", (F.col("o_totalprice") * 2).alias("price"))
    return sinks.merged_replace(old, new, ["o_orderkey"])


@query("K6", "select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def upsert_latest(t: Tables) -> DataFrame:
    """Each customer's latest order before 1997, then that of the years since: the later version stays."""
    cols = ["o_custkey", "o_orderkey", "o_totalprice", F.struct("o_orderdate", "o_orderkey").alias("version")]
    since = F.year("o_orderdate") >= 1997
    one = lambda df: sinks.latest(df.select(*cols), ["o_custkey"], [F.desc("version")])
    return sinks.upsert(one(t.orders.where(~since)), one(t.orders.where(since)), ["o_custkey"], "version").drop("version")


@query("K10 K18", "select c_custkey, coalesce(n * 1.0::double, c_acctbal) as c_acctbal, n is not null as is_done from customer left join (select o_custkey, count(*) as n from orders where o_totalprice > 400000 group by 1) on o_custkey = c_custkey")
def update_from(t: Tables) -> DataFrame:
    big = t.orders.where("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").cast("double").alias("c_acctbal"))
    out = sinks.updated(t.customer.select("c_custkey", "c_acctbal"), big, ["c_custkey"])
    return sinks.flagged(out, big, ["c_custkey"], "is_done")


@query("I1 I5", "select o_orderkey from orders where o_orderdate > (select max(o_orderdate) from orders where year(o_orderdate) < 1997)")
def incr_watermark(t: Tables) -> DataFrame:
    loaded = t.orders.where("year(o_orderdate) < 1997")
    return incremental.above_watermark(t.orders, loaded, "o_orderdate").select("o_orderkey")


@query(
    "I3 I4 T9",
    "select * from (select o_orderkey, o_orderdate::varchar as day, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as last from orders) where day >= '1998'",
)
def incr_full_history(t: Tables) -> DataFrame:
    """Computed over all rows, then only those not yet in the target, so each row sees what came before."""
    last = lambda df: df.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"), F.lag("o_orderkey").over(w.ordered(["o_custkey"], ["o_orderdate", "o_orderkey"])).alias("last"))
    return incremental.unseen_results(last, t.orders, t.orders.where("year(o_orderdate) < 1998"), ["o_orderkey"])


@query("stream", "select event_type, count(*) as n, round(sum(value), 3) as total, (epoch(date_trunc('hour', ts)))::bigint as hour from events group by event_type, date_trunc('hour', ts)")
def windowed_counts(t: Tables) -> DataFrame:
    """The aggregation that also runs on a stream with a bound on late rows."""
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    out = incremental.windowed_counts(e, "ts", "event_type")
    return out.select("event_type", "n", F.round("total", 3).alias("total"), F.unix_seconds("w.start").alias("hour"))
