"""A match log in the models' schema, derived from the driver's tables by plain arithmetic, so that models run on any size of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.models import events as ev
from gritstone.plans.registry import Tables
from gritstone.sources import sinks
from gritstone.sources.store import fresh_folder

# Event types and qualifiers that the log's rows take in turn.
TYPES = (1, 1, 1, 1, 1, 1, 1, 3, 4, 7, 8, 12, 13, 15, 16, 41, 44, 45, 49, 61, 1, 1, 44, 17)
QUALIFIERS = (5, 6, 107, 124, 233, 11113, 210, 170, 285, 286, 2, 55, 22, 20, 15, 26)


def _pick(values: tuple[int, ...], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def events(t: Tables) -> DataFrame:
    e = F.col("event_id")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    kind = _pick(TYPES, e * 13)
    qualifier = _pick(QUALIFIERS, e * 5)
    team = (e % 2 + 1).cast("int")
    # A duel names the match's next event as its other side, an assisted shot the event before it.
    linked = F.when(qualifier == 233, F.lead("event_id").over(order)).when(qualifier == 55, F.lag("event_id").over(order)).otherwise(e + 1)
    qualified = lambda kind_, value: F.struct(F.struct(kind_.alias("value"), F.lit("q").alias("displayName")).alias("type"), value.cast("string").alias("value"))
    opposite = F.when(kind.isin(4, 7, 44, 45, 50) & (qualifier != 233), qualified(F.lit(233), F.lead("event_id").over(order)))
    own = t.events.select(
        F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("match_id"), team.alias("team_id"), (team * 100 + (e * 7) % 11).cast("int").alias("player_id"), e.cast("int").alias("event_id"), F.row_number().over(order).alias("row_num"),
        F.row_number().over(order).alias("expanded_minute"), (e % 60).cast("int").alias("second"), F.lit(1).alias("period"), kind.alias("type_id"), F.concat(F.lit("t"), kind.cast("string")).alias("type_name"),
        F.when(e % 3 == 0, 0).otherwise(1).alias("outcome_id"), kind.isin(13, 14, 15, 16).alias("is_shot"), (e % 4 != 0).alias("is_touch"), ((e * 31) % 1000 / 10.0).alias("x"), ((e * 17) % 1000 / 10.0).alias("y"),
        ((e * 37) % 1000 / 10.0).alias("end_x"), ((e * 41) % 1000 / 10.0).alias("end_y"), F.when(kind == 17, "Yellow").alias("card_type"), F.when(kind.isin(15, 16), (team * 100 + (e * 3) % 11).cast("int")).alias("related_player_id"),
        (45 + (e * 7) % 100 / 10.0).alias("goal_mouth_y"), ((e * 11) % 380 / 10.0).alias("goal_mouth_z"),
        F.to_json(F.array_compact(F.array(qualified(qualifier, linked), opposite))).alias("qualifiers_json"),
    )
    return own


def index(t: Tables) -> DataFrame:
    u = t.events.select("user_id").distinct()
    date = F.date_add(F.lit("2020-01-01").cast("date"), F.col("user_id").cast("int"))
    return u.select(
        F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("match_id"), date.alias("match_date"), F.lit("2020-2021").alias("season"), F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")).alias("league_source"),
        F.lit("2021-01-01T00:00:00").alias("scraped_at"), F.lit(1).alias("team_id"), F.lit(2).alias("opponent_id"),
    )


_STAGES: dict[tuple[str, str], dict[str, DataFrame]] = {}
_FOLDERS: dict[tuple[str, str], str] = {}


def stages(t: Tables) -> dict[str, DataFrame]:
    """The event models' inputs and first results, each node of the dataflow a written table; written anew if its folder is gone."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _STAGES or not sinks.exists(t.spark, f"{_FOLDERS[key]}/passes"):
        folder = _FOLDERS[key] = fresh_folder(t.spark)
        kept = lambda name, df: sinks.replace(df, f"{folder}/{name}")
        e = kept("events", events(t))
        q = kept("quals", ev.qualifiers(e))
        rich = kept("enriched", ev.enriched(e, q, index(t)))
        chains = kept("chains", ev.possession_chains(rich, q))
        _STAGES[key] = {"events": e, "quals": q, "index": index(t), "enriched": rich, "values": kept("values", ev.values(rich)), "chains": chains, "passes": kept("passes", ev.passes(chains))}
    return _STAGES[key]


def backbone(t: Tables) -> DataFrame:
    """Two rows for each order: the customer at home, another one away."""
    o = F.col("o_orderkey")
    return _two_sides(t.orders.select(
        F.concat(F.lit("o"), o.cast("string")).alias("match_id"), F.to_date("o_orderdate").alias("date"), F.concat_ws("-", F.year("o_orderdate").cast("string"), (F.year("o_orderdate") + 1).cast("string")).alias("season"),
        F.concat(F.lit("L"), (F.col("o_custkey") % 2).cast("string")).alias("league_source"), (F.col("o_custkey") % 20).cast("long").alias("h"), ((F.col("o_custkey") + o) % 19 + 20).cast("long").alias("a"), (o % 4).cast("int").alias("hg"), (o % 3).cast("int").alias("ag"), o.alias("k"),
    ))


def event_backbone(t: Tables) -> DataFrame:
    """Two rows for each match of the event log, in the same columns."""
    u = F.col("user_id")
    number = lambda c: c.cast("int")
    return _two_sides(t.events.select("user_id").distinct().join(index(t).select("match_id", "match_date", "season", "league_source"), F.concat(F.lit("m"), u.cast("string")) == F.col("match_id")).select(
        "match_id", F.col("match_date").alias("date"), "season", "league_source", F.lit(1).alias("h"), F.lit(2).alias("a"), number(u % 4).alias("hg"), number(u % 3).alias("ag"), u.alias("k"),
    ))


def _two_sides(base: DataFrame) -> DataFrame:
    """Both sides' rows of matches (match_id, date, season, league_source, h, a, hg, ag, k), with facts by plain arithmetic on k."""
    result = F.when(F.col("hg") > F.col("ag"), "H").when(F.col("hg") < F.col("ag"), "A").otherwise("D")
    side = lambda team, other, venue, gf, ga, s: base.select(
        "match_id", F.col(team).alias("team_id"), F.col(other).alias("opponent_id"), "date", F.lit(venue).alias("venue"), "season", "league_source", F.lit("Big5").alias("comp_category"), result.alias("result_1n2"),
        F.when((F.col("k") + s) % 3 == 0, "4-3-3").when((F.col("k") + s) % 3 == 1, "4-2-3-1").otherwise("3-5-2").alias("formation"), F.col(gf).alias("gf"), F.col(ga).alias("ga"),
        *(((F.col("k") * m + s * 3) % n + 1.0).alias(c) for c, m, n in (("possession", 7, 40), ("shots_on_target_faced", 3, 9), ("saves", 5, 7), ("save_pct", 11, 90), ("shots_total", 13, 20), ("shots_on_target", 17, 8), ("fouls_committed", 19, 15), ("interceptions", 23, 12), ("tackles_won", 29, 18), ("np_xg", 31, 3), ("np_xg_conceded", 37, 3), ("ppda", 41, 14), ("ppda_allowed", 43, 14), ("season_att_rating", 47, 6), ("season_def_rating", 53, 6), ("ws_dribbles_pg", 3, 11), ("ws_fouled_pg", 5, 11), ("ws_shots_ot_pg", 7, 6))),
        *(((F.col("k") + s) % n == 0).cast("int").alias(c) for c, n in (("clean_sheet", 3), ("red_cards", 17), ("second_yellow_cards", 23))), *(((F.col("k") + s) % 5 / 2.0 + 1.5).alias(f"odds_{b}_{x}") for b in ("pinnacle", "avg") for x in ("team", "draw", "opp")),
        *((0.2 + (F.col("k") + s) % 7 / 20.0).alias(f"{b}_prob_{x}") for b in ("pinnacle", "market") for x in ("team", "draw", "opp")),
    )
    return side("h", "a", "Home", "hg", "ag", 0).unionByName(side("a", "h", "Away", "ag", "hg", 1))
