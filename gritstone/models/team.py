"""Team and player match aggregates, and the backbone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.functions.scalars import blank_to_double
from gritstone.models import constants as k
from gritstone.models.events import flagged, is_goal, with_scores
from gritstone.operators import windows as w

TEAM = ["match_id", "team_id"]
PLAYER = ["match_id", "team_id", "player_id"]


def backbone(schedule: DataFrame, keeper: DataFrame, shooting: DataFrame, misc: DataFrame, xg_schedule: DataFrame, xg_stats: DataFrame, ratings: DataFrame, odds: DataFrame) -> DataFrame:
    """A row for each team of each match, from six sources, seen from the team's side. Suspended matches are left out."""
    names = {"sota": "shots_on_target_faced", "saves": "saves", "save_pct": "save_pct", "cs": "clean_sheet"}
    shot = {"standard_sh": "shots_total", "standard_sot": "shots_on_target", "standard_g_sh": "goals_per_shot"}
    card = {"crdy": "yellow_cards", "crdy2": "second_yellow_cards", "crdr": "red_cards", "fls": "fouls_committed", "int": "interceptions", "tklw": "tackles_won"}
    pick = lambda df, cols: df.select(*TEAM, *(F.col(a).alias(b) for a, b in cols.items())).where("match_id is not null")
    own = schedule.select(*TEAM, "opponent_id", "date", "venue", "season", "league_source", "comp_category", "result_1n2", "formation", "gf", "ga", blank_to_double(F.col("poss")).alias("possession"))
    own = reduce(lambda a, b: a.join(b, TEAM, "left"), (pick(d, c) for d, c in ((keeper, names), (shooting, shot), (misc, card))), own)
    home = F.col("venue") == "Home"
    swap = lambda a, b: F.when(home, F.col(a)).otherwise(F.col(b))
    raw = [f"{s}_{c}" for s in ("home", "away") for c in ("np_xg", "ppda", "np_xg_diff")]
    xg = xg_schedule.select("match_id").where("match_id is not null").distinct().join(xg_stats.select("match_id", *(blank_to_double(F.col(c)).alias(c) for c in raw)), "match_id", "left")
    own = own.join(xg, "match_id", "left").withColumns(
        {"np_xg": swap("home_np_xg", "away_np_xg"), "np_xg_conceded": swap("away_np_xg", "home_np_xg"), "ppda": swap("home_ppda", "away_ppda"), "ppda_allowed": swap("away_ppda", "home_ppda"), "np_xg_diff_match": swap("home_np_xg_diff", "away_np_xg_diff")}
    )
    rated = {"att_rating": "season_att_rating", "def_rating": "season_def_rating", "dribbles_pg": "ws_dribbles_pg", "fouled_pg": "ws_fouled_pg", "shots_ot_pg": "ws_shots_ot_pg"}
    season = ["team_id", "season", "league_source"]
    own = own.join(ratings.select(*season, *(f"ws_{s}_{c}" for c in rated for s in ("home", "away"))), season, "left")
    own = own.withColumns({b: swap(f"ws_home_{a}", f"ws_away_{a}") for a, b in rated.items()})
    prices = ["odds_pinnacle", "odds_avg", "pinnacle_prob", "market_prob"]
    quoted = odds.where("pinnacle_prob_h is not null").select(*TEAM, *(f"{p}_{x}" for p in prices for x in "hda"))
    own = own.join(quoted, TEAM, "left")
    own = own.withColumns({f"{p}_{n}": c for p in prices for n, c in (("team", swap(f"{p}_h", f"{p}_a")), ("draw", F.col(f"{p}_d")), ("opp", swap(f"{p}_a", f"{p}_h")))})
    gone = [c for c in own.columns if c in raw or c.startswith(("ws_home_", "ws_away_")) or c.rsplit("_", 1)[-1] in "hda" and c.rsplit("_", 1)[0] in prices]
    lost = [(F.col("season") == s) & F.col("league_source").isin(*leagues) & (F.col("date") >= F.lit(d).cast("date")) for s, leagues, d in k.SUSPENDED]
    return own.drop(*gone).where(~reduce(lambda a, b: a | b, lost))


def win(result: str = "result_1n2", venue: str = "venue") -> Column:
    r, v = F.col(result), F.col(venue)
    return ((r == "H") & (v == "Home")) | ((r == "A") & (v == "Away"))


def lost(result: str = "result_1n2", venue: str = "venue") -> Column:
    r, v = F.col(result), F.col(venue)
    return ((r == "A") & (v == "Home")) | ((r == "H") & (v == "Away"))


def h2h_history(backbone: DataFrame) -> DataFrame:
    """Meetings of two teams so far, and the last ten."""
    keys, order = ["team_id", "opponent_id"], ["date", "match_id"]
    all_, ten = w.before(keys, order), w.previous(keys, order, 10)
    one = lambda p: F.when(p, 1).otherwise(0)
    results = {"played": F.lit(1), "wins": one(win()), "draws": one(F.col("result_1n2") == "D"), "losses": one(lost())}
    cols = [F.sum(c).over(all_).alias(f"h2h_{n}") for n, c in results.items()]
    for place in ("Home", "Away"):
        cols += [F.sum(F.when(F.col("venue") == place, c).otherwise(0)).over(all_).alias(f"h2h_{place.lower()}_{n}") for n, c in results.items()]
    cols += [F.sum(c).over(ten).alias(f"h2h_{n}_10") for n, c in results.items()]
    xg = F.col("np_xg") - F.col("np_xg_conceded")
    cols += [F.avg(F.col("gf").cast("double")).over(ten).alias("h2h_avg_gf_10"), F.avg(F.col("ga").cast("double")).over(ten).alias("h2h_avg_ga_10"), F.avg(xg).over(ten).alias("h2h_avg_xg_diff_10")]
    return backbone.select(*TEAM, "opponent_id", "date", "season", "league_source", "venue", "gf", "ga", "result_1n2", "np_xg", "np_xg_conceded", *cols)


def cells(condition: Column, prefix: str = "") -> list[Column]:
    """Shares of a group's rows that meet the condition in each of 25 cells; the upper bounds are outside."""
    x, y = F.col("x"), F.col("y")
    inside = lambda c, i: (c >= 20 * i) & (c < 20 * i + 20)
    return [F.avg(F.when(condition & inside(x, i) & inside(y, j), 1.0).otherwise(0.0)).alias(f"{prefix}pct_z{i + 1}_c{j + 1}") for i in range(5) for j in range(5)]


STATES = ("blank", "blank_late", "drawing", "drawing_late", "winning", "winning_late", "losing", "losing_late")
QUALS = {
    k.Q_SHOT_ASSIST: "is_shot_assist", k.Q_KEY_PASS: "is_key_pass", k.Q_LONG: "is_longball", k.Q_CROSS: "is_cross", k.Q_THROUGH: "is_throughball", k.Q_REGULAR: "is_regular_play", k.Q_INDIVIDUAL: "is_individual_play",
    k.Q_TO_GOAL: "is_leading_to_goal", k.Q_TO_ATTEMPT: "is_leading_to_attempt", k.Q_OFFENSIVE: "is_offensive_aerial", k.Q_DEFENSIVE: "is_defensive_aerial", 178: "__not_touch", 179: "__not_touch2",
}


def score_state() -> Column:
    late, a, b = F.col("expanded_minute") >= 75, F.col("team_score"), F.col("opp_score")
    base = F.when((a == 0) & (b == 0), "blank").when(a == b, "drawing").when(a > b, "winning").otherwise("losing")
    return F.when(late, F.concat(base, F.lit("_late"))).otherwise(base)


def player_match_stats(events: DataFrame, quals: DataFrame, index: DataFrame) -> DataFrame:
    """All player aggregates of a match in one pass over its events, with a row for each player.

    The 200 shares by state are means over all of the player's events, as the shares without a state are.
    """
    own = flagged(with_scores(events).where("player_id is not null"), quals, QUALS).withColumn("score_state", score_state())
    t, ok, shot = F.col("type_id"), F.col("outcome_id") == 1, F.coalesce(F.col("is_shot"), F.lit(False))
    n = lambda name, p: F.count_if(F.coalesce(p, F.lit(False))).alias(name)
    q = lambda c: F.col(c) == 1
    mean = lambda c: F.coalesce(F.avg(F.when(shot, F.col(c))), F.lit(0.0))
    shots = F.count_if(shot)
    value = F.when(shots > 0, shots / (1.0 + F.sqrt(F.pow(100.0 - mean("x"), 2) + F.pow(50.0 - mean("y"), 2)))).otherwise(0.0)
    forward = (t == k.PASS) & ok & (F.col("end_x") > F.col("x") + 10)
    defence = t.isin(7, 8, 49, 45, 12)
    touch = F.coalesce(F.col("is_touch"), F.lit(False))
    aerial = t == k.AERIAL
    card = lambda name, kind: n(name, (t == k.CARD) & (F.col("card_type") == kind))
    won = F.count_if(F.coalesce(aerial & ok, F.lit(False)))
    aggs = [
        F.count("*").alias("n_actions"), value.alias("xg_contribution"), n("n_shots", shot), n("n_shots_regular_play", shot & q("is_regular_play")), n("n_shots_individual_play", shot & q("is_individual_play")),
        F.sum("is_shot_assist").alias("n_shot_assists"), F.sum("is_key_pass").alias("n_key_passes"), n("n_longballs", (t == k.PASS) & q("is_longball")), n("n_crosses", (t == k.PASS) & q("is_cross")),
        n("n_throughballs", (t == k.PASS) & q("is_throughball")), n("n_progressive_passes", forward), n("n_tackles", t == k.TACKLE), n("n_tackles_won", (t == k.TACKLE) & ok), n("n_interceptions", t == k.INTERCEPTION),
        n("n_ball_recoveries", t == k.RECOVERY), n("n_challenges", t == k.CHALLENGE), n("n_clearances", t == k.CLEARANCE), F.avg(F.when(defence, F.col("x"))).alias("defensive_zone_x"),
        n("n_touches", touch & (F.col("__not_touch") + F.col("__not_touch2") == 0)), *cells(touch),
        n("n_aerial_duels", aerial), n("n_aerial_won", aerial & ok), (won / F.nullif(F.count_if(aerial), F.lit(0))).alias("aerial_win_rate"), n("n_aerial_offensive", aerial & q("is_offensive_aerial")), n("n_aerial_defensive", aerial & q("is_defensive_aerial")),
        n("n_errors_lead_to_goal", (t == k.ERROR) & q("is_leading_to_goal")), n("n_errors_lead_to_shot", (t == k.ERROR) & q("is_leading_to_attempt")),
        card("n_yellow_cards", "Yellow"), card("n_second_yellows", "SecondYellow"), card("n_red_cards", "Red"),
    ]
    for s in STATES:
        at = F.col("score_state") == s
        aggs += [n(f"n_actions_{s}", at), n(f"n_progressive_passes_{s}", at & forward), n(f"n_defensive_actions_{s}", at & defence), n(f"n_shots_{s}", at & shot), *cells(at & touch, f"{s}_")]
    base = own.groupBy(*PLAYER).agg(*aggs)
    made = events.where(F.col("related_player_id").isNotNull() & t.isin(*k.SHOTS)).groupBy("match_id", "team_id", F.col("related_player_id").alias("player_id"))
    made = made.agg(F.count_if(F.coalesce(is_goal(), F.lit(False))).alias("n_assists"), F.count("*").alias("n_chances_created"))
    facts = index.select("match_id", F.col("match_date").alias("date"), "season", "league_source", "scraped_at")
    return base.join(made, PLAYER, "left").fillna(0, ["n_assists", "n_chances_created"]).join(facts, "match_id")


def team_features(events: DataFrame, quals: DataFrame) -> DataFrame:
    """Thirty style ratios of each team's match."""
    t, x, y, ok = F.col("type_id"), F.col("x"), F.col("y"), F.col("outcome_id") == 1
    touch, shot = F.coalesce(F.col("is_touch"), F.lit(False)), F.coalesce(F.col("is_shot"), F.lit(False))
    lanes = {"left": y < 33.3, "center": (y >= 33.3) & (y <= 66.6), "right": y > 66.6}
    six, box = (x > 94) & y.between(36, 64), (x > 83) & y.between(21, 79)
    n = lambda p: F.count_if(F.coalesce(p, F.lit(False)))
    counts = {
        "touches": n(touch), "shots": n(shot), "passes": n(t == 1), "high_touch": n(touch & (x > 66)), "deep": n((t == 1) & ok & (F.col("end_x") > 83)), "high_loss": n((t == 1) & (F.col("outcome_id") == 0) & (x > 66)),
        "offence": n((x > 66) & t.isin(1, 3, 13, 15, 16)), **{f"lane_{a}": n(touch & (x > 33) & p) for a, p in lanes.items()}, "lanes": n(touch & (x > 33)), "z_def": n(touch & (x < 33.3)), "z_mid": n(touch & (x >= 33.3) & (x <= 66.6)),
        "z_att": n(touch & (x > 66.6)), "s_six": n(shot & six), "s_pen": n(shot & box & ~six), "s_oob": n(shot & ~box), "goals": n(is_goal()), "mid": n(x.between(33, 66) & t.isin(1, 7, 8) & ok),
        "d": n(t.isin(7, 8, 12) & x.isNotNull() & y.isNotNull()), "d_x": F.avg(F.when(t.isin(7, 8, 12) & y.isNotNull(), x)),
        "d_l": n(t.isin(7, 8, 12) & (y < 30) & x.isNotNull()), "d_l_ok": n(t.isin(7, 8, 12) & (y < 30) & ok & x.isNotNull()), "d_r": n(t.isin(7, 8, 12) & (y > 70) & x.isNotNull()), "d_r_ok": n(t.isin(7, 8, 12) & (y > 70) & ok & x.isNotNull()),
    }
    by = events.groupBy(*TEAM).agg(*(c.alias(f"_{a}") for a, c in counts.items()))
    qt = F.col("qual_type_id")
    rows = lambda p: F.count_distinct(F.when(p, F.col("row_num")))
    q = quals.groupBy(*TEAM).agg(
        n(shot & (qt == 26)).alias("_counter"), rows(qt.isin(5, 6) & (x > 50)).alias("_set"), rows(shot & (qt == 22)).alias("_open"), rows(shot & (qt == 23)).alias("_fast"), rows(shot & (qt == 9)).alias("_penalty"),
        rows((t == 1) & (qt == 2)).alias("_cross"), rows((t == 1) & (qt == 155)).alias("_through"), rows((t == 1) & (qt == 1)).alias("_long"),
    )
    own = by.join(q, TEAM, "left").fillna(0, [f"_{c}" for c in ("counter", "set", "open", "fast", "penalty", "cross", "through", "long")])
    other = by.select("match_id", F.col("team_id").alias("__o"), *(F.col(f"_{c}").alias(f"_o_{c}") for c in ("lane_left", "lane_center", "lane_right", "lanes")))
    faced = own.select(*TEAM).join(other, "match_id").where("team_id <> __o").groupBy(*TEAM).agg(*(F.sum(f"_o_{c}").alias(f"_o_{c}") for c in ("lane_left", "lane_center", "lane_right", "lanes")))
    own = own.join(faced, TEAM, "left").join(_momentum(events), TEAM, "left").join(_counter_shots(events), TEAM, "left")
    share = lambda a, b: F.when(F.col(f"_{b}") > 0, F.col(f"_{a}") / F.nullif(f"_{b}", F.lit(0)))
    enough = F.col("_d") >= 5
    names = {
        "field_tilt_actions": share("high_touch", "touches"), "high_turnover_rate": share("high_loss", "passes"), "deep_completion_rt": share("deep", "passes"), "momentum_delta": F.col("momentum_delta"), "counter_shot_rate": share("counter", "shots"),
        "set_piece_pressure": share("set", "offence"), **{f"attack_{a}_pct": share(f"lane_{a}", "lanes") for a in lanes}, **{f"zone_{a}_pct": share(f"z_{a}", "touches") for a in ("def", "mid", "att")},
        "shot_six_yard_pct": share("s_six", "shots"), "shot_penalty_pct": share("s_pen", "shots"), "shot_oob_pct": share("s_oob", "shots"), "shot_open_play_pct": share("open", "shots"), "shot_set_piece_pct": share("fast", "shots"),
        "shot_penalty_att_pct": share("penalty", "shots"), "conversion_rate": share("goals", "shots"), "cross_rate": share("cross", "passes"), "through_ball_rate": share("through", "passes"), "long_ball_rate": share("long", "passes"),
        "short_pass_rate": 1.0 - (share("cross", "passes") + share("through", "passes") + share("long", "passes")), **{f"def_exposed_{a}_pct": share(f"o_lane_{a}", "o_lanes") for a in lanes},
        "counter_attack_dna": F.col("counter_attack_dna"), "midfield_control_idx": F.col("_mid") / F.nullif(F.sum("_mid").over(Window.partitionBy("match_id")), F.lit(0)),
        "defensive_line_height": F.when(enough, F.col("_d_x")), "flank_exposure_asymm": F.when(enough & (F.col("_d_l") > 0) & (F.col("_d_r") > 0), share("d_l_ok", "d_l") - share("d_r_ok", "d_r")),
    }
    return own.select(*TEAM, *(c.alias(f"ws_{a}") for a, c in names.items()))


def _momentum(events: DataFrame, reach: int = 10) -> DataFrame:
    """Mean ratio of a team's actions in the minutes after to those before each goal it concedes, where it had some before."""
    teams = events.select(*TEAM).distinct()
    goals = events.where(is_goal()).select("match_id", F.col("team_id").alias("__s"), F.col("expanded_minute").alias("g")).distinct()
    conceded = goals.join(teams, "match_id").where("team_id <> __s").select(*TEAM, "g").distinct()
    minutes = events.groupBy(*TEAM, "expanded_minute").agg(F.count("*").alias("c"))
    m, g = F.col("expanded_minute"), F.col("g")
    near = conceded.join(minutes, TEAM).where(m.between(g - reach, g + reach))
    by = near.groupBy(*TEAM, "g").agg(F.sum(F.when(m < g, F.col("c")).otherwise(0)).alias("pre"), F.sum(F.when(m > g, F.col("c")).otherwise(0)).alias("post"))
    return by.groupBy(*TEAM).agg(F.avg(F.col("post") / F.nullif("pre", F.lit(0))).alias("momentum_delta"))


def _counter_shots(events: DataFrame, reach: int = 15) -> DataFrame:
    """Moments of shots at most ``reach`` seconds after a ball recovered by the team, as a share of its shots: a range window in seconds."""
    at = F.col("expanded_minute") * 60 + F.col("second")
    before = Window.partitionBy(*TEAM).orderBy("__at").rangeBetween(-reach, -1)
    won = F.when(F.col("type_id") == k.RECOVERY, 1).otherwise(0)
    own = events.withColumn("__at", at.cast("long")).withColumn("__won", F.sum(won).over(before))
    shots = own.where(F.col("type_id").isin(*k.SHOTS))
    return shots.groupBy(*TEAM).agg((F.count_distinct(F.when(F.col("__won") > 0, F.col("__at"))) / F.count("*")).alias("counter_attack_dna"))
