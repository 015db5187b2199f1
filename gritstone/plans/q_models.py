"""Queries of the composed models (inventory 2.14), on a match log derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.models import events as ev
from gritstone.models import gold, network, setpieces, team
from gritstone.plans import match_log, model_sql
from gritstone.plans.registry import Tables, query
from gritstone.sources import sinks
from gritstone.sources.store import fresh_folder


def _rounded(df: DataFrame, places: int = 5) -> DataFrame:
    return df.select(*(F.round(c, places).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes))


_T = "[" + ", ".join(map(str, match_log.TYPES)) + "]"
_Q = "[" + ", ".join(map(str, match_log.QUALIFIERS)) + "]"
_LOG = f"""with e as (select 'm' || user_id as match_id, cast(event_id % 2 + 1 as integer) as team_id, event_id, cast(row_number() over (partition by user_id order by ts, event_id) as integer) as row_num,
{_T}[(event_id * 13) % {len(match_log.TYPES)} + 1] as type_id, case when event_id % 3 = 0 then 0 else 1 end as outcome_id, (event_id * 31) % 1000 / 10.0::double as x, {_Q}[(event_id * 5) % {len(match_log.QUALIFIERS)} + 1] as q from events),
s as (select *, sum(case when type_id = 16 and outcome_id = 1 then 1 else 0 end) over (partition by match_id, team_id order by row_num) as mine, sum(case when type_id = 16 and outcome_id = 1 then 1 else 0 end) over (partition by match_id order by row_num) as both_ from e),
v as (select *, both_ - mine as theirs from s)"""


@query(
    "int_event_enriched event_values events_qual P17 P22 A4 J8 T16",
    _LOG
    + """, a as (select *, case when type_id in (1, 3, 13, 14, 15, 16, 42) then x / 100 when type_id in (7, 8, 12, 45, 49, 74) then (100 - x) / 100 when type_id in (44, 4, 50) and q = 285 then (100 - x) / 100 when type_id in (44, 4, 50) and q = 286 then x / 100 end as d,
    case when type_id = 16 then 1.0 when q = 170 then 0.9 when q = 11113 then 0.65 when q = 210 then 0.55 when type_id = 15 then 0.4 when type_id in (13, 14) then 0.1 when type_id = 3 and outcome_id = 1 then 0.3 when type_id = 3 then 0.05 else 0.0 end::double as c,
    case when type_id in (7, 8, 12, 49, 74) and outcome_id = 1 then 1.0 when type_id = 45 then 0.6 when type_id in (7, 8, 12, 49, 74) then 0.3 when type_id in (44, 4, 50) and q = 285 and outcome_id = 1 then 1.0 when type_id in (44, 4, 50) and q = 285 then 0.3 end::double as f,
    case when type_id in (44, 4, 45, 50, 7) then least(1.0, 0.8 + case when x < 50 then 0.2 else 0 end) when q = 233 then least(1.0, 0.6 + case when x < 50 then 0.2 else 0 end) when x < 50 then 0.2 else 0.0 end::double as p,
    case when row_num >= 75 and mine < theirs then 1.0 when row_num >= 75 and mine > theirs then 0.85 when row_num >= 75 and mine > 0 then 0.75 when row_num >= 75 then 0.6 when mine < theirs then 0.7 when mine = theirs and mine > 0 then 0.5 when mine > theirs then 0.4 else 0.3 end::double as w from v)
    select match_id, row_num, cast(mine as bigint) as team_score, cast(theirs as bigint) as opp_score, round(case when type_id in (1, 3, 13, 14, 15, 16, 42) then sqrt(d * c) * (0.5 + 0.3 * p + 0.2 * w) when type_id in (7, 8, 12, 45, 49, 74) then d * f * (0.5 + 0.3 * p + 0.2 * w)
    when type_id in (44, 4, 50) and q = 285 then d * f * (0.5 + 0.3 * p + 0.2 * w) when type_id in (44, 4, 50) and q = 286 then sqrt(d * c) * (0.5 + 0.3 * p + 0.2 * w) end, 5) as action_value from a""",
)
def model_event_values(t: Tables) -> DataFrame:
    return match_log.stages(t)["values"].select("match_id", "row_num", "team_score", "opp_score", F.round("action_value", 5).alias("action_value"))


@query(
    "player_possession_chains W16 W19 W20 W21 D12",
    model_sql.typed("ch", "match_id string, row_num int, chain_id string, chain_number bigint, chain_team_id int, chain_trigger string, is_rupture int", "select * from ch"),
)
def model_possession_chains(t: Tables) -> DataFrame:
    return match_log.stages(t)["chains"].select("match_id", "row_num", "chain_id", "chain_number", "chain_team_id", "chain_trigger", "is_rupture")


@query(
    "player_passes_raw W14 P27",
    model_sql.typed("pa", "match_id string, row_num int, passer_id int, receiver_id int, is_progressive boolean, is_creative boolean, is_buildup boolean", "select * from pa"),
)
def model_passes(t: Tables) -> DataFrame:
    return match_log.stages(t)["passes"].select("match_id", "row_num", "passer_id", "receiver_id", "is_progressive", "is_creative", "is_buildup")


@query(
    "player_network_passes player_network_centrality A12 T14",
    model_sql.typed("ce", "match_id string, team_id int, player_id int, season string, league_source string, degree_out bigint, weighted_degree_out bigint, n_creative_out bigint, n_progressive_out bigint, degree_in bigint, weighted_degree_in bigint, pass_share double, creative_rate double, betweenness_proxy double", "select * from ce"),
)
def model_centrality(t: Tables) -> DataFrame:
    return network.centrality(network.pass_edges(match_log.stages(t)["passes"]))


@query("player_network_betweenness F4 I5")
def model_betweenness(t: Tables) -> DataFrame:
    return network.betweenness(network.pass_edges(match_log.stages(t)["passes"]))


@query("team_network_features A10 A11 A17", model_sql.team_network())
def model_team_network(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return network.team_network(network.centrality(network.pass_edges(s["passes"])), s["passes"])


@query("player_network_duels J7", model_sql.duels())
def model_duels(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return ev.duels(s["enriched"], s["quals"])


@query(
    "player_xg_chain W23 W24",
    model_sql.typed("xg", "match_id string, chain_id string, player_id int, position_in_chain int, chain_length bigint, position_weight double, chain_number bigint, chain_team_id int, season string, league_source string, shot_event_id int, shot_minute int, shot_type_id int, xg_proxy double, is_counter_attack boolean, is_shooter boolean, is_assister boolean, xgchain double, xgchain_weighted double, xgbuildup double, xgbuildup_weighted double", "select * from xg"),
)
def model_xg_chain(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return network.xg_chain(s["chains"], s["values"], s["quals"])


@query(
    "threat_conceded",
    model_sql.typed("th", "match_id string, chain_id string, player_id int, team_id int, position_in_chain int, chain_length bigint, position_weight double, is_keeper boolean, has_error_leading_to_goal boolean, chain_number bigint, chain_team_id int, xg_proxy double, season string, league_source string, shot_event_id int, is_penalty boolean, threat_conceded double, threat_conceded_weighted double", "select * from th"),
)
def model_threat_conceded(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return network.threat_conceded(network.xg_chain(s["chains"], s["values"], s["quals"]), s["chains"], s["quals"])


@query("player_zone_transitions U1 J11 W15 P28 A13", model_sql.zone_transitions())
def model_zone_transitions(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return network.zone_transitions(s["passes"], s["enriched"], s["quals"])


@query("int_shot_placement P29 W22", model_sql.shot_placement())
def model_shot_placement(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return ev.shot_placement(s["enriched"], s["values"]).select("match_id", "row_num", "placement_zone", *(F.round(c, 5).alias(c) for c in ("offset_center", "corner_dist", "pre_shot_xg_proxy")))


@query("corner_profiles P31 J12 A7", model_sql.corner_profiles())
def model_corners(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return _rounded(setpieces.corner_profiles(s["chains"], s["values"], s["quals"]))


@query("freekick_profiles P30 P32", model_sql.freekick_profiles())
def model_freekicks(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return _rounded(setpieces.freekick_profiles(s["chains"], s["values"], s["quals"]))


@query("player_match_stats A2 A3 A14 A15 A18 J19 P21", model_sql.player_match_stats())
def model_player_match_stats(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return _rounded(team.player_match_stats(s["events"], s["quals"], s["index"]))


@query("team_features_ws J6 J13 J14 A5 A6", model_sql.team_features())
def model_team_features(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    return _rounded(team.team_features(s["events"], s["quals"]))


_BB = """with o as (select 'o' || o_orderkey as match_id, cast(o_orderdate as date) as date, o_custkey % 20 as h, (o_custkey + o_orderkey) % 19 + 20 as a, cast(o_orderkey % 4 as integer) as hg, cast(o_orderkey % 3 as integer) as ag, o_orderkey as k,
year(o_orderdate) || '-' || (year(o_orderdate) + 1) as season, 'L' || (o_custkey % 2) as league_source from orders),
r as (select *, case when hg > ag then 'H' when hg < ag then 'A' else 'D' end as res from o),
b as (select match_id, h as team_id, a as opponent_id, date, 'Home' as venue, hg as gf, ag as ga, res, season, league_source, k * 31 % 3 + 1.0::double as np_xg, k * 13 % 20 + 1.0::double as shots from r union all select match_id, a, h, date, 'Away', ag, hg, res, season, league_source, (k * 31 + 3) % 3 + 1.0::double, (k * 13 + 3) % 20 + 1.0::double from r)"""


@query(
    "h2h_history W6 W7 W8 I3",
    _BB
    + """ select match_id, team_id, cast(count(*) over w as bigint) as h2h_played, cast(sum(case when (res = 'H' and venue = 'Home') or (res = 'A' and venue = 'Away') then 1 else 0 end) over w as bigint) as h2h_wins, round(avg(gf) over w10, 5) as h2h_avg_gf_10
    from b window w as (partition by team_id, opponent_id order by date, match_id rows between unbounded preceding and 1 preceding), w10 as (partition by team_id, opponent_id order by date, match_id rows between 10 preceding and 1 preceding)""",
)
def model_h2h(t: Tables) -> DataFrame:
    h = team.h2h_history(match_log.backbone(t))
    return h.select("match_id", "team_id", F.coalesce("h2h_played", F.lit(0)).alias("h2h_played"), "h2h_wins", F.round("h2h_avg_gf_10", 5).alias("h2h_avg_gf_10"))


_S = "over (partition by team_id, season, league_source order by date, match_id rows between {} preceding and 1 preceding)"
_WIN = "(res = 'H' and venue = 'Home') or (res = 'A' and venue = 'Away')"


@query(
    "features_rolling W1 W2 W3 W4 W11 W12 W13 P33 P42",
    _BB
    + " select match_id, team_id, date_diff('day', lag(date) over (partition by team_id order by date, match_id), date)::integer as days_since_last_match, "
    + ", ".join(
        f"round(avg(gf) {_S.format(n)}, 5) as avg_gf_{n}, round(avg(np_xg) {_S.format(n)} / nullif(avg(shots) {_S.format(n)}, 0), 5) as shot_quality_ratio_{n}, round(avg(case when {_WIN} then 3.0 when res = 'D' then 1.0 else 0.0 end) {_S.format(n)}, 5) as points_pg_roll_{n}"
        for n in (3, 5, 10)
    )
    + f", round(avg(case when res = 'D' then 1.0 else 0.0 end) {_S.format(2)}, 5) as draw_rate_3 from b",
)
def model_features_rolling(t: Tables) -> DataFrame:
    r = gold.features_rolling(match_log.backbone(t))
    cols = [f"{c}_{n}" for n in gold.SIZES for c in ("avg_gf", "shot_quality_ratio", "points_pg_roll")]
    return _rounded(r.select("match_id", "team_id", "days_since_last_match", *cols, "draw_rate_3"))


def _written(t: Tables, df: DataFrame) -> DataFrame:
    """A stage that several windows read, written once."""
    return sinks.replace(df, fresh_folder(t.spark))


@query("rolling_corners J35 W5", model_sql.rolling_corners())
def model_rolling_corners(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    b = _event_backbone(s)
    return _rounded(setpieces.rolling_corners(b, s["chains"], _written(t, setpieces.corner_profiles(s["chains"], s["values"], s["quals"]))))


@query("rolling_freekicks J35 W5", model_sql.rolling_freekicks())
def model_rolling_freekicks(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    b = _event_backbone(s)
    return _rounded(setpieces.rolling_freekicks(b, s["chains"], _written(t, setpieces.freekick_profiles(s["chains"], s["values"], s["quals"]))))


def _event_backbone(s: dict[str, DataFrame]) -> DataFrame:
    sides = F.explode(F.array(F.struct(F.lit(1).alias("t"), F.lit(2).alias("o")), F.struct(F.lit(2).alias("t"), F.lit(1).alias("o")))).alias("s")
    return s["index"].select("match_id", F.col("match_date").alias("date"), "season", "league_source", sides).select("match_id", F.col("s.t").alias("team_id"), F.col("s.o").alias("opponent_id"), "date", "season", "league_source")


@query("features_players A1 W26 W30", model_sql.features_players())
def model_features_players(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    stats = team.player_match_stats(s["events"], s["quals"], s["index"])
    return _rounded(gold.features_players(stats, network.centrality(network.pass_edges(s["passes"])), network.xg_chain(s["chains"], s["values"], s["quals"])), 6)


@query("features_whoscored J15 W25 T8 T9 T21", model_sql.features_whoscored())
def model_features_whoscored(t: Tables) -> DataFrame:
    s = match_log.stages(t)
    stats = team.player_match_stats(s["events"], s["quals"], s["index"])
    return _rounded(gold.features_whoscored(_event_backbone(s), team.team_features(s["events"], s["quals"]), stats, s["index"]))


def _draw(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Backbone, form, style with squads, and draw signals, all of the event log's matches."""
    s = match_log.stages(t)
    b = match_log.event_backbone(t)
    rolling = gold.features_rolling(b)
    stats = team.player_match_stats(s["events"], s["quals"], s["index"])
    style = gold.features_whoscored(b, team.team_features(s["events"], s["quals"]), stats, s["index"])
    behaviour = gold.draw_behaviour(s["events"], s["quals"], s["index"])
    return b, rolling, style, gold.features_draw(b, rolling, style, behaviour)


@query("features_draw P35 J9 J13 J17 W10 T11")
def model_features_draw(t: Tables) -> DataFrame:
    return _rounded(_draw(t)[-1])


@query("features_final P36 P37 J5 T10")
def model_features_final(t: Tables) -> DataFrame:
    b, rolling, style, draw = _draw(t)
    final = gold.features_final(rolling, style, draw, team.h2h_history(b), b)
    return _rounded(final.select("match_id", "team_id", *(c for c in final.columns if "diff" in c or c.startswith(("h2h_", "rating_", "upset", "draw_aff", "form_", "squad_", "f1_", "f20_")))))
