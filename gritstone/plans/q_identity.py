"""Queries of the identity models and the backbone (inventory 2.14), on provider tables derived from orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritstone.models import identity, team
from gritstone.plans.registry import Tables, query

#: Ids of the sides that play away, apart from the customers' keys.
_AWAY = 1_000_000_000
_O = f"""o as (select o_orderkey as k, cast(o_orderdate as date) as d, 'L' || (o_custkey % 2) as lg, year(o_orderdate) || '-' || (year(o_orderdate) + 1) as se, o_custkey as h, {_AWAY} + o_orderkey % 1000 as a from orders),
reg as (select 'r' || k as match_id, d, lg, se, h, a from o where k % 7 <> 0)"""


def _orders(t: Tables) -> DataFrame:
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    return t.orders.select(
        k.alias("k"), F.to_date("o_orderdate").alias("date"), F.concat(F.lit("L"), (F.col("o_custkey") % 2).cast("string")).alias("league_source"), F.concat_ws("-", y.cast("string"), (y + 1).cast("string")).alias("season"),
        F.col("o_custkey").alias("h"), (k % 1000 + _AWAY).alias("a"),
    )


def _registry(t: Tables) -> DataFrame:
    """Known matches; every seventh is missing."""
    return _orders(t).where("k % 7 <> 0").select(_match(), F.col("date").alias("match_date"), "league_source", "season", F.col("h").alias("home_team_id"), F.col("a").alias("away_team_id"))


def _match() -> Column:
    return F.concat(F.lit("r"), F.col("k").cast("string")).alias("match_id")


def _club(c: str) -> Column:
    return F.concat(F.lit("club "), F.col(c).cast("string"))


def _mapping(t: Tables) -> DataFrame:
    """A row for each alias of a club."""
    ids = t.customer.select(F.col("c_custkey").alias("team_id")).unionByName(t.spark.range(1000).select((F.col("id") + _AWAY).alias("team_id")))
    return ids.select("team_id", _club("team_id").alias("club_name"), F.explode(F.array(F.lit("one"), F.lit("two"))).alias("alias"))


@query(
    "int_fbref_schedule int_fbref_keeper int_fbref_misc int_fbref_shooting J3 J4",
    f"""with {_O}, s as (select k, d, lg, se, case when k % 5 = 0 then a else h end as t, case when k % 5 = 0 then h else a end as op, case when k % 5 = 0 then 'Neutral' else 'Home' end as venue, (k % 100)::varchar as poss from o)
    select match_id, s.d as date, s.lg as league_source, s.se as season, venue, poss, t as team_id, op as opponent_id, k from s left join reg on s.d = reg.d and s.lg = reg.lg and s.se = reg.se and ((venue = 'Home' and t = h) or (venue = 'Neutral' and (t = h or t = a)))""",
)
def identity_team_facts(t: Tables) -> DataFrame:
    """Facts by team name; on neutral ground the team is the away side of the registry's match."""
    neutral = F.col("k") % 5 == 0
    name = lambda x, y: F.when(neutral, _club(x)).otherwise(_club(y))
    own = _orders(t).select(
        "k", "date", "league_source", "season", F.when(neutral, "Neutral").otherwise("Home").alias("venue"), (F.col("k") % 100).cast("string").alias("poss"), name("a", "h").alias("team"), name("h", "a").alias("opponent"),
        F.lit("x").alias("raw_team"), F.lit("y").alias("raw_opponent"),
    )
    return identity.team_match_facts(own, _mapping(t), _registry(t))


@query(
    "int_odds J36",
    f"""with {_O}, f as (select match_id, o.d as date, o.lg as league_source, o.se as season, o.h as team_id, o.a as opponent_id, k, k % 30 / 10.0::double as odds_avg_h from o left join reg using (d, lg, se, h, a))
    select * from f union all select match_id, date, league_source, season, opponent_id, team_id, k, odds_avg_h from f""",
)
def identity_odds(t: Tables) -> DataFrame:
    own = _orders(t).select("k", "date", "league_source", "season", _club("h").alias("home_team"), _club("a").alias("away_team"), (F.col("k") % 30 / 10.0).alias("odds_avg_h"))
    return identity.odds(own, _mapping(t), _registry(t))


def _goals_schedule(t: Tables) -> DataFrame:
    own = _orders(t).select((F.col("k") + 5).alias("match_id"), "league_source", "season", "date", _club("h").alias("home_team"), _club("a").alias("away_team"), F.lit("x").alias("raw_home_team"), F.lit("y").alias("raw_away_team"))
    return identity.expected_goals_schedule(own, _mapping(t), _registry(t))


_US = "us as (select k + 5 as us_match_id, o.lg as league_source, o.se as season, o.d as date, o.h as team_id, o.a as opponent_id, match_id from o left join reg on o.lg = reg.lg and o.se = reg.se and o.h = reg.h and o.a = reg.a)"


@query("int_understat_schedule", f"with {_O}, {_US} select * from us")
def identity_goals_schedule(t: Tables) -> DataFrame:
    return _goals_schedule(t)


@query("int_understat_stats", f"with {_O}, {_US} select k + 5 as us_match_id, (k % 3)::varchar as home_np_xg, match_id from o left join us on k + 5 = us_match_id")
def identity_goals_stats(t: Tables) -> DataFrame:
    own = _orders(t).select((F.col("k") + 5).alias("match_id"), (F.col("k") % 3).cast("string").alias("home_np_xg"))
    return identity.expected_goals_stats(own, _goals_schedule(t))


def _index(t: Tables) -> DataFrame:
    own = _orders(t).select(
        F.concat(F.lit("w"), F.col("k").cast("string")).alias("ws_match_id"), F.col("date").alias("match_date"), "league_source", "season", _club("h").alias("home_team_name"), _club("a").alias("away_team_name"),
        (F.col("k") * 2).alias("home_team_id"), (F.col("k") * 2 + 1).alias("away_team_id"),
    )
    return identity.match_index(own, _mapping(t), _registry(t))


_WS = "ws as (select 'w' || k as ws_match_id, o.d as match_date, o.lg as league_source, o.se as season, k * 2 as ws_home_team_id, k * 2 + 1 as ws_away_team_id, o.h as team_id, o.a as opponent_id, match_id, k from o left join reg using (d, lg, se, h, a))"
_TEAM = "case when {0} = ws_home_team_id then ws.team_id when {0} = ws_away_team_id then ws.opponent_id end as team_id"


@query("int_whoscored_match_index", f"with {_O}, {_WS} select * exclude (k), 'club ' || team_id as home_team_name, 'club ' || opponent_id as away_team_name from ws")
def identity_match_index(t: Tables) -> DataFrame:
    return _index(t)


def _provider(t: Tables, *more: Column, sides: int = 3) -> DataFrame:
    """Rows of each side of each match by provider ids; the third side is no team of the match."""
    side = F.explode(F.sequence(F.lit(0), F.lit(sides - 1))).alias("i")
    own = _orders(t).select("k", F.concat(F.lit("w"), F.col("k").cast("string")).alias("ws_match_id"), side)
    return own.select("ws_match_id", (F.col("k") * 2 + F.col("i")).alias("team_id"), F.lit(None).cast("string").alias("match_id"), *more)


@query(
    "int_whoscored_events int_whoscored_formations int_whoscored_team_match P44",
    f"with {_O}, {_WS} select match_id, {_TEAM.format('k * 2 + i')}, k * 10 + i as row_num from ws, range(0, 3) r(i)",
)
def identity_translated(t: Tables) -> DataFrame:
    """Provider ids to canonical ones, for events, formations and team facts alike; a team of neither side gets a null."""
    return identity.translated(_provider(t, (F.col("k") * 10 + F.col("i")).alias("row_num")), _index(t))


@query("int_whoscored_team_season", "select 'club ' || c_custkey as team, c_custkey % 4 as goals, c_custkey as team_id from customer union all select 'unknown', 1, null")
def identity_team_season(t: Tables) -> DataFrame:
    own = t.customer.select(_club("c_custkey").alias("team"), (F.col("c_custkey") % 4).alias("goals"))
    own = own.unionByName(t.spark.range(1).select(F.lit("unknown").alias("team"), F.lit(1).cast("long").alias("goals")))
    return identity.team_season(own, _mapping(t))


def _player_match(t: Tables) -> DataFrame:
    series = F.to_json(F.create_map(F.lit("touches"), F.create_map(F.lit("1"), (F.col("k") % 10).cast("double"), F.lit("5"), F.lit(2.5)), F.lit("shotsTotal"), F.create_map(F.lit("3"), (F.col("k") % 3).cast("double"))))
    return _provider(t, (F.col("k") % 500 * 10 + F.col("i")).alias("player_id"), (170 + F.col("k") % 30).alias("height"), (60 + F.col("k") % 25).alias("weight"), series.alias("stats_json"), sides=2)


@query(
    "int_whoscored_player_match J1 D8",
    f"with {_O}, {_WS} select match_id, {_TEAM.format('k * 2 + i')}, k % 500 * 10 + i as player_id, k % 10 + 2.5::double as touches, (k % 3)::double as shots_total, 0.0::double as passes_total from ws, range(0, 2) r(i)",
)
def identity_player_match(t: Tables) -> DataFrame:
    return identity.player_match(_player_match(t), _index(t)).select("match_id", "team_id", "player_id", "touches", "shots_total", "passes_total")


@query(
    "int_whoscored_players",
    f"""with {_O}, {_WS}, m as (select match_id, season, {_TEAM.format('k * 2 + i')}, k % 500 * 10 + i as player_id, 170 + k % 30 as height, 60 + k % 25 as weight from ws, range(0, 2) r(i))
    select player_id, season, team_id, max(case when player_id < 2500 then 'player ' || player_id end) as player_name, max(height) as height, max(weight) as weight, count(*) as n_matchs from m where match_id is not null and team_id is not null group by 1, 2, 3""",
)
def identity_players(t: Tables) -> DataFrame:
    """Players by season and team, with the names that are known."""
    names = t.spark.range(2500).select(F.col("id").alias("player_id"), F.concat(F.lit("player "), F.col("id").cast("string")).alias("player_name"))
    return identity.players(identity.player_match(_player_match(t), _index(t)), _index(t), names)


def _lineup(t: Tables) -> DataFrame:
    """Two periods of each side, each with four players and a hole among the slots."""
    own = _provider(t, F.col("k"), F.explode(F.array(F.lit(0), F.lit(1))).alias("formation_seq"), sides=2)
    k, s = F.col("k"), F.col("formation_seq")
    p = F.to_json(F.array(*(k % 500 * 10 + j for j in range(4))))
    slots = F.to_json(F.array(s + 1, F.lit(3), F.lit(0), F.lit(4)))
    places = F.to_json(F.array(*(F.struct((k % 7 + j).cast("double").alias("vertical"), (F.lit(j) * 1.5).alias("horizontal")) for j in range(4))))
    return identity.lineup(
        own.select(
            "ws_match_id", "team_id", "match_id", "formation_seq", (s + 4).alias("formation_id"), F.lit(1).alias("period"), (s * 60).alias("start_minute"), F.when(s == 0, 60).alias("end_minute"), (k % 500 * 10).alias("captain_player_id"),
            p.alias("player_ids"), slots.alias("formation_slots"), places.alias("formation_positions"),
        ),
        _index(t),
    )


_LINE = f"""with {_O}, {_WS}, li as (select match_id, {_TEAM.format('k * 2 + i')}, q.s as formation_seq, (q.s + 4)::integer as formation_id, 1 as period, (q.s * 60)::integer as start_minute, case when q.s = 0 then 60 end as end_minute, k % 500 * 10 + j as player_id,
(case j when 0 then q.s + 1 when 1 then 3 when 2 then 0 else 4 end)::integer as slot, j = 0 as is_captain, k, k * 2 + i as side from ws, range(0, 2) r(i), range(0, 2) q(s), range(0, 4) p(j)),
ln as (select *, (k % 7 + slot - 1)::double as grid_vertical, (slot - 1) * 1.5::double as grid_horizontal from li where slot > 0)"""


@query("int_whoscored_lineup J26", _LINE + " select * exclude (k, side) replace (formation_seq::integer as formation_seq) from ln")
def identity_lineup(t: Tables) -> DataFrame:
    return _lineup(t)


@query(
    "int_whoscored_lineup_agg A7 A9",
    _LINE
    + """, w as (select *, greatest(coalesce(end_minute, 90) - start_minute, 0) as dur from ln)
    select match_id, team_id, player_id, round(sum(grid_vertical * dur) / nullif(sum(dur), 0), 5) as avg_vertical, round(sum(grid_horizontal * dur) / nullif(sum(dur), 0), 5) as avg_horizontal,
    first(slot order by dur desc, slot) as primary_slot, bool_or(is_captain) as is_captain, count(*) as n_formation_periods from w group by 1, 2, 3""",
)
def identity_lineup_summary(t: Tables) -> DataFrame:
    out = identity.lineup_summary(_lineup(t))
    return out.withColumns({c: F.round(c, 5) for c in ("avg_vertical", "avg_horizontal")})


def _sides(t: Tables) -> DataFrame:
    both = F.explode(F.array(F.struct(F.col("h").alias("t"), F.col("a").alias("o"), F.lit("Home").alias("v")), F.struct(F.col("a").alias("t"), F.col("h").alias("o"), F.lit("Away").alias("v")))).alias("s")
    own = _orders(t).where("k % 7 <> 0").select("k", _match(), "date", "league_source", "season", both)
    return own.select("k", "match_id", "date", "league_source", "season", F.col("s.t").alias("team_id"), F.col("s.o").alias("opponent_id"), F.col("s.v").alias("venue"), (F.col("s.v") == "Home").cast("int").alias("i"))


@query(
    "backbone J29 J5",
    f"""with {_O}, b as (select k, 'r' || k as match_id, h as team_id, a as opponent_id, d as date, 'Home' as venue, se as season, lg as league_source, 1 as i from o where k % 7 <> 0 union all select k, 'r' || k, a, h, d, 'Away', se, lg, 0 from o where k % 7 <> 0)
    select match_id, team_id, opponent_id, date, venue, (k % 60)::double as possession, case when k % 3 <> 0 then k % 9 + i end as saves, case when k % 2 = 0 then k % 20 end as shots_total, k % 4 as yellow_cards,
    case when k % 5 <> 0 then case when i = 1 then (k % 3)::double else (k % 4)::double end end as np_xg, case when k % 5 <> 0 then case when i = 1 then (k % 4)::double else (k % 3)::double end end as np_xg_conceded,
    case when k % 5 <> 0 then case when i = 1 then (k % 11)::double else (k % 13)::double end end as ppda, case when team_id < {_AWAY} then (team_id % 10 + i)::double end as season_att_rating,
    case when k % 2 = 1 then case when i = 1 then k % 30 / 10.0::double else k % 50 / 10.0::double end end as odds_avg_team, case when k % 2 = 1 then k % 40 / 10.0::double end as odds_avg_draw, case when k % 2 = 1 then 0.5::double end as pinnacle_prob_opp from b""",
)
def identity_backbone(t: Tables) -> DataFrame:
    """Two rows for each match from eight sources, some of which lack rows."""
    s = _sides(t)
    k, i = F.col("k"), F.col("i")
    num = lambda c, name: c.cast("int").alias(name)
    key = ["match_id", "team_id"]
    schedule = s.select(*key, "opponent_id", "date", "venue", "season", "league_source", F.lit("Big5").alias("comp_category"), F.lit("H").alias("result_1n2"), F.lit("4-3-3").alias("formation"), F.lit(1).alias("gf"), F.lit(0).alias("ga"), (k % 60).cast("string").alias("poss"))
    keeper = s.where("k % 3 <> 0").select(*key, num(k, "sota"), (k % 9 + i).alias("saves"), num(k, "save_pct"), F.lit(0).alias("cs"))
    shooting = s.where("k % 2 = 0").select(*key, (k % 20).alias("standard_sh"), num(k, "standard_sot"), num(k, "standard_g_sh"))
    misc = s.select(*key, (k % 4).alias("crdy"), *(num(k, c) for c in ("crdy2", "crdr", "fls", "int", "tklw")))
    xg_matches = s.where("k % 5 <> 0").select("match_id")
    text = lambda c, name: c.cast("string").alias(name)
    xg = s.where("i = 1").select("match_id", *(text(k % n, c) for c, n in (("home_np_xg", 3), ("away_np_xg", 4), ("home_ppda", 11), ("away_ppda", 13), ("home_np_xg_diff", 2), ("away_np_xg_diff", 2))))
    rated = ("att_rating", "def_rating", "dribbles_pg", "fouled_pg", "shots_ot_pg")
    ratings = s.where(F.col("team_id") < _AWAY).select("team_id", "season", "league_source").distinct()
    ratings = ratings.select("*", *((F.col("team_id") % 10 + j).cast("double").alias(f"ws_{side}_{c}") for side, j in (("home", 1), ("away", 0)) for c in rated))
    odds = s.where("k % 2 = 1").select(
        *key, *((k % n / 10.0).alias(f"{p}_{x}") for p in ("odds_pinnacle", "odds_avg") for x, n in (("h", 30), ("d", 40), ("a", 50))), *(F.lit(0.5).alias(f"{p}_{x}") for p in ("pinnacle_prob", "market_prob") for x in "hda")
    )
    out = team.backbone(schedule, keeper, shooting, misc, xg_matches, xg, ratings, odds)
    return out.select(*key, "opponent_id", "date", "venue", "possession", "saves", "shots_total", "yellow_cards", "np_xg", "np_xg_conceded", "ppda", "season_att_rating", "odds_avg_team", "odds_avg_draw", "pinnacle_prob_opp")
