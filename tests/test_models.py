"""Models on a match made by hand."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gritstone.models import events as ev
from gritstone.models import gold, identity, network, team

COLS = "match_id string, team_id int, player_id int, event_id int, row_num int, expanded_minute int, second int, period int, type_id int, type_name string, outcome_id int, is_shot boolean, is_touch boolean, x double, y double, end_x double, end_y double, card_type string, related_player_id int, goal_mouth_y double, goal_mouth_z double, qualifiers_json string"


def q(*pairs):
    return json.dumps([{"type": {"value": k, "displayName": str(k)}, "value": v} for k, v in pairs])


def event(n, team_, player, kind, minute, second=0, ok=1, quals=(), x=50.0, end_x=70.0):
    return ("m", team_, player, n, n, minute, second, 1, kind, str(kind), ok, kind in (13, 14, 15, 16), True, x, 50.0, end_x, 50.0, None, None, 50.0, 10.0, q(*quals))


EVENTS = [
    event(1, 1, 11, 1, 1), event(2, 1, 12, 1, 1, 5), event(3, 2, 21, 8, 1, 9), event(4, 2, 22, 1, 1, 12),
    event(5, 2, 21, 4, 2, 0, 1), event(6, 1, 11, 4, 2, 0, 0), event(7, 2, 22, 1, 2, 10, quals=[(5, None)]), event(8, 2, 23, 16, 2, 20, quals=[(55, "7")], x=90.0),
    event(9, 1, 11, 1, 3, quals=[(6, None)], x=99.0), event(10, 2, 29, 41, 3, 4), event(11, 1, 12, 49, 3, 8), event(12, 1, 11, 44, 4, 0, 1, quals=[(233, "13")]), event(13, 2, 21, 44, 4, 0, 0, quals=[(233, "12")]),
    event(14, 2, 24, 12, 5), event(15, 2, 24, 1, 5, 5), event(16, 1, None, 1, 6),
]


@pytest.fixture(scope="module")
def log(spark):
    e = spark.createDataFrame(EVENTS, COLS).cache()
    i = spark.createDataFrame([("m", dt.date(2024, 1, 1), "s", "l", "t")], "match_id string, match_date date, season string, league_source string, scraped_at string")
    quals = ev.qualifiers(e).cache()
    rich = ev.enriched(e, quals, i).cache()
    return e, quals, i, rich, ev.possession_chains(rich, quals).cache()


def test_scores_include_the_goals_minute(log):
    rows = {r["row_num"]: (r["team_score"], r["opp_score"]) for r in log[3].collect()}
    assert rows[4] == (0, 0) and rows[5] == (1, 0) and rows[6] == (0, 1) and rows[9] == (0, 1) and 16 not in rows


def test_values(log):
    v = {r["row_num"]: r for r in ev.values(log[3]).collect()}
    assert v[8]["chance_creation"] == 1.0 and v[8]["danger_position"] == 0.9
    assert v[3]["def_execution_quality"] == 1.0 and v[3]["danger_position"] == 0.5 and v[12]["action_value"] is None
    assert abs(v[8]["action_value"] - 0.9**0.5 * (0.5 + 0.2 * 0.4)) < 1e-9


def test_possession_chains(log):
    rows = {r["row_num"]: r for r in log[4].collect()}
    n = [rows[i]["chain_number"] for i in range(1, 16)]
    # Passes; interception; the free kick after the foul; the corner; the ball won after the punch; the clearance that its team keeps.
    assert n[0] == n[1] and n[2] == n[3] == n[1] + 1 and n[6] == n[7] > n[3] and n[8] > n[7] and n[10] > n[9] and n[14] > n[13]
    assert rows[3]["chain_trigger"] == "recovery" and rows[7]["chain_trigger"] == "free_kick" and rows[9]["chain_trigger"] == "corner" and rows[1]["chain_trigger"] == "open_play"
    assert rows[12]["chain_number"] == rows[13]["chain_number"] and rows[8]["chain_team_id"] == 2


def test_passes_and_network(log):
    p = ev.passes(log[4])
    pairs = {(r["passer_id"], r["receiver_id"]) for r in p.collect()}
    assert (11, 12) in pairs and (22, 23) in pairs
    edges = network.pass_edges(p)
    assert {r["player_id"]: r["degree_out"] for r in network.centrality(edges).collect()}[11] >= 1
    assert network.betweenness(edges).columns == ["match_id", "team_id", "player_id", "betweenness"]


def test_xg_chain(log):
    x = {r["player_id"]: r for r in network.xg_chain(log[4], ev.values(log[3]), log[1]).where("shot_event_id = 8").collect()}
    assert x[23]["is_shooter"] and x[23]["xgbuildup"] is None and x[22]["is_assister"] and x[22]["xgchain"] == 1.0 and x[22]["xgbuildup"] is None
    assert x[22]["position_weight"] == 0.5 and x[23]["position_weight"] == 1.0


def test_duels(log):
    d = ev.duels(log[3], log[1]).collect()
    assert [(r["event_id_a"], r["event_id_b"], r["outcome_a"], r["outcome_b"]) for r in d] == [(12, 13, 1, 0)]


def test_player_stats(log):
    rows = {r["player_id"]: r for r in team.player_match_stats(log[0], log[1], log[2]).collect()}
    assert rows[23]["n_shots"] == 1 and rows[23]["xg_contribution"] == pytest.approx(1 / 11) and rows[11]["n_aerial_won"] == 1 and rows[11]["n_actions"] == 4
    assert sum(v for k, v in rows[11].asDict().items() if k.startswith("pct_z")) == pytest.approx(1.0)
    assert len(rows[11]) > 270


def test_lineup_hole_moves_nobody(spark):
    f = spark.createDataFrame(
        [("w", 7, 0, 2, 1, 0, 45, 5, "[5, 6, 8]", "[1, 0, 3]", json.dumps([{"vertical": float(i), "horizontal": 10.0 * i} for i in (1, 2, 3)]))],
        "ws_match_id string, team_id int, formation_seq int, formation_id int, period int, start_minute int, end_minute int, captain_player_id int, player_ids string, formation_slots string, formation_positions string",
    )
    i = spark.createDataFrame([("w", "m", 7, 9, 70, 90)], "ws_match_id string, match_id string, ws_home_team_id int, ws_away_team_id int, team_id int, opponent_id int")
    rows = {r["player_id"]: r for r in identity.lineup(f, i).collect()}
    assert set(rows) == {5, 8} and rows[8]["grid_vertical"] == 3.0 and rows[5]["is_captain"] and rows[5]["team_id"] == 70
    s = {r["player_id"]: r for r in identity.lineup_summary(identity.lineup(f, i)).collect()}
    assert s[8]["avg_horizontal"] == 30.0 and s[8]["primary_slot"] == 3


def test_identity_of_odds_and_facts(spark):
    mapping = spark.createDataFrame([("a", "Alpha", 1), ("al", "Alpha", 1), ("b", "Beta", 2)], "alias string, club_name string, team_id long")
    day = dt.date(2024, 1, 1)
    registry = spark.createDataFrame([("m1", day, 1, 2, "L", "S"), ("m2", day, 3, 4, "L", "S")], "match_id string, match_date date, home_team_id long, away_team_id long, league_source string, season string")
    o = spark.createDataFrame([(day, "S", "L", "Alpha", "Beta", 2.0)], "date date, season string, league_source string, home_team string, away_team string, odds_avg_h double")
    assert sorted((r["match_id"], r["team_id"], r["opponent_id"]) for r in identity.odds(o, mapping, registry).collect()) == [("m1", 1, 2), ("m1", 2, 1)]
    facts = [(day, "L", "S", v, t, p, 1) for v, t, p in (("Home", "Alpha", "Beta"), ("Away", "Beta", "Alpha"), ("Neutral", "Beta", "Alpha"), ("Away", "Alpha", "Beta"))]
    f = spark.createDataFrame(facts, "date date, league_source string, season string, venue string, team string, opponent string, gf int")
    got = [(r["venue"], r["team_id"], r["match_id"]) for r in identity.team_match_facts(f, mapping, registry).collect()]
    assert sorted(got, key=str) == sorted([("Home", 1, "m1"), ("Away", 2, "m1"), ("Neutral", 2, "m1"), ("Away", 1, None)], key=str)


def test_first_matches_have_no_form(spark):
    from gritstone.plans import match_log
    from gritstone.plans.registry import Tables

    b = match_log.backbone(Tables(spark, "/root/testdata/sf0.001"))
    r = gold.features_rolling(b, (3,))
    first = r.where("days_since_last_match is null")
    assert first.where("avg_gf_3 is not null or draw_rate_3 is not null or is_short_rest = 1 or is_return_from_break = 1").count() == 0
    assert r.count() == b.count() and first.count() == b.select("team_id").distinct().count()
    assert r.where(F.col("form_n_defenders").isNull()).count() == 0
