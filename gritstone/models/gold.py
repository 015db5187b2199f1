"""Feature tables: rolling form, style, squads, draw signals and the final assembly. No feature sees its own match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.functions.scalars import formation
from gritstone.models.events import is_goal
from gritstone.models.team import TEAM, win
from gritstone.operators import windows as w
from gritstone.operators.joins import asof_latest, days_before

SIZES = (3, 5, 10)
SEASON = ["team_id", "season", "league_source"]
#: Dates can tie, match ids can't.
ORDER = ["date", "match_id"]


def rolling_block(n: int) -> dict[str, Column]:
    """Form over the n matches before: all use two windows, one of them by venue."""
    g, v = w.previous(SEASON, ORDER, n), w.previous([*SEASON, "venue"], ORDER, n)
    m = lambda c, over=g: F.avg(F.col(c) if isinstance(c, str) else c).over(over)
    r = w.ratio
    quality = r(m("np_xg"), m("shots_total"))
    sterility = r(m("possession"), quality)
    points = F.when(win(), 3.0).when(F.col("result_1n2") == "D", 1.0).otherwise(0.0)
    red = F.when(F.col("red_cards") + F.col("second_yellow_cards") > 0, 1.0).otherwise(0.0)
    cols = {
        "xg_overperformance": r(m("gf"), m("np_xg")) - 1, "xg_conceded_overperformance": r(m("ga"), m("np_xg_conceded")) - 1, "avg_gf": m("gf"), "avg_ga": m("ga"), "np_xg_roll": m("np_xg"), "np_xg_roll_venue": m("np_xg", v),
        "np_xg_conceded_roll": m("np_xg_conceded"), "xg_net_roll": m(F.col("np_xg") - F.col("np_xg_conceded")), "shot_quality_ratio": quality, "shot_quality_ratio_venue": r(m("np_xg", v), m("shots_total", v)), "avg_shots": m("shots_total"),
        "avg_sot": m("shots_on_target"), "cs_rate": m("clean_sheet"), "shot_accuracy_roll": r(m("shots_on_target"), m("shots_total")), "save_rate_roll": r(m("saves"), m("shots_on_target_faced")), "roll_save_pct": m("save_pct"),
        "roll_sota": m("shots_on_target_faced"), "avg_saves": m("saves"), "poss_roll": m("possession"), "poss_roll_venue": m("possession", v), "ppda_roll": m("ppda"), "ppda_allowed_roll": m("ppda_allowed"), "ppda_ratio_roll": r(m("ppda"), m("ppda_allowed")),
        "defensive_actions_roll": m(F.col("tackles_won") + F.col("interceptions")), "fouls_per_tackle_roll": r(m("fouls_committed"), m("tackles_won")), "sterility_index": sterility, "shots_faced_per_goal_conceded": r(m("shots_on_target_faced"), m("ga")),
        "sterility_weighted": m("possession") / 50.0 * sterility, "press_resistance": r(m("possession"), m("ppda_allowed")), "shield_efficiency": r(m("save_pct"), 1 + m("np_xg_conceded")), "red_card_rate_roll": m(red),
        "win_rate_roll": m(F.when(win(), 1.0).otherwise(0.0)), "points_pg_roll": m(points),
    }
    return {f"{c}_{n}": e for c, e in cols.items()}


def features_rolling(backbone: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Form, rest, draw rates, formation and last season's ratings beside each team's match.

    The draw rates' frames are the two, five and nine matches before. Rest is null in a team's first match, and its flags are 0 then.
    """
    date = w.ordered(["team_id"], ORDER)
    season = w.ordered(SEASON, ORDER)
    rest = F.datediff("date", F.lag("date").over(date))
    own = backbone.withColumn("days_since_last_match", rest)
    drawn = F.when(F.col("result_1n2") == "D", 1.0).otherwise(0.0)
    home_win = F.when(F.col("venue") == "Home", F.when(F.col("result_1n2") == "H", 1.0).otherwise(0.0))
    last = lambda i: F.lag("formation", i).over(season)
    same = [F.when(last(i) == F.col("formation"), 1.0).otherwise(0.0) for i in range(1, 6)]
    lines = dict(zip(("form_n_defenders", "form_n_midfielders", "form_n_attackers"), formation(F.col("formation"))))
    cols = {
        "is_home": F.when(F.col("venue") == "Home", 1).otherwise(0), "is_return_from_break": F.when(F.col("days_since_last_match") > 20, 1).otherwise(0), "is_short_rest": F.when(F.col("days_since_last_match") < 4, 1).otherwise(0),
        **reduce(lambda a, b: a | b, (rolling_block(n) for n in sizes)), **{f"draw_rate_{n}": F.avg(drawn).over(w.previous(SEASON, ORDER, back)) for n, back in ((3, 2), (5, 5), (10, 9))},
        "home_win_rate_hist": F.avg(home_win).over(w.before(["team_id", "league_source"], ORDER)), **lines, "form_familiarity_5": sum(same[1:], same[0]) / 5.0,
        "form_change_flag": F.when(F.col("formation").isNull() | last(1).isNull(), None).when(F.col("formation") == last(1), 0).otherwise(1),
    }
    ratings = ["season_att_rating", "season_def_rating"]
    by = backbone.groupBy(*SEASON).agg(*(F.avg(c).alias(c) for c in ratings))
    prior = by.select(*SEASON, *(F.lag(c).over(w.ordered(["team_id", "league_source"], ["season"])).alias(c) for c in ratings))
    kept = ["date", *TEAM, "opponent_id", "venue", "season", "league_source", "comp_category", "result_1n2", "formation", "days_since_last_match"]
    quotes = [c for c in backbone.columns if c.startswith(("ws_", "odds_", "pinnacle_", "market_"))]
    return own.select(*kept, *(e.alias(n) for n, e in cols.items()), *quotes).join(prior, SEASON, "left")


def squads(stats: DataFrame) -> DataFrame:
    """Each team's match: form of its players over 180 days, regularity over 14 days and the share of its three busiest players."""
    who = ["player_id", "league_source"]
    past = days_before(who, F.col("date"), 180)
    recent = days_before(["player_id", "team_id", "league_source"], F.col("date"), 14)
    busy = w.ordered(TEAM, [F.desc("n_actions"), "player_id"])
    own = stats.where("player_id is not null").withColumns(
        {"__a": F.avg("n_actions").over(past), "__x": F.avg("xg_contribution").over(past), "__n": F.count("match_id").over(past), "__r": F.count("match_id").over(recent), "__k": F.row_number().over(busy)}
    )
    known = lambda c: F.avg(F.when(F.col("__n") >= 1, F.col(c)))
    return own.groupBy(*TEAM, "date", "season", "league_source").agg(
        known("__a").alias("squad_avg_form_5"), known("__x").alias("squad_xg_quality_5"), (F.count_if(F.col("__r") > 0) / F.nullif(F.count("*"), F.lit(0))).alias("squad_reg_rate"),
        (F.sum(F.when(F.col("__k") <= 3, F.col("n_actions"))) / F.nullif(F.sum("n_actions"), F.lit(0))).alias("squad_top3_share"),
    )


def features_whoscored(backbone: DataFrame, style: DataFrame, stats: DataFrame, index: DataFrame) -> DataFrame:
    """Style and squad of the team's latest match strictly before this one, in the same league and season."""
    ws = [c for c in style.columns if c.startswith("ws_")]
    season = ["team_id", "league_source", "season"]
    dated = style.join(index.select("match_id", F.col("match_date").alias("__d"), "season", "league_source"), "match_id")
    squad = squads(stats).withColumnsRenamed({"date": "__d", "squad_reg_rate": "squad_regularity"})
    own = backbone.select("date", "team_id", "league_source", "season", "match_id")
    out = asof_latest(own, dated, season, "date", "__d", ws, tie="match_id")
    extra = ["squad_avg_form_5", "squad_xg_quality_5", "squad_regularity", "squad_top3_share"]
    out = asof_latest(out, squad, season, "date", "__d", extra, tie="match_id")
    return out.withColumn("has_ws_events", F.when(F.col("ws_field_tilt_actions").isNotNull(), 1).otherwise(0))


def draw_behaviour(events: DataFrame, quals: DataFrame, index: DataFrame) -> DataFrame:
    """A row for each side of each match: late equalisers, goals conceded within ten minutes of a yellow card, and offence after a red one.

    A late equaliser is a goal from minute 70 on that makes the running score level; the score is a running count, not one of joined pairs.
    """
    team = ["match_id", "team_id"]
    goals = events.where(is_goal()).groupBy(*team, F.col("expanded_minute").alias("m")).agg(F.count("*").alias("c"))
    mine = F.sum("c").over(Window.partitionBy(*team).orderBy("m"))
    both = F.sum("c").over(Window.partitionBy("match_id").orderBy("m"))
    run = goals.withColumn("own", mine).withColumn("other", both - F.col("own"))
    late = run.groupBy(*team).agg(F.max(F.when((F.col("m") >= 70) & (F.col("own") == F.col("other")), 1).otherwise(0)).alias("had_late_equalizer"))
    cards = quals.where("type_name = 'Card'").select(*team, F.col("expanded_minute").alias("card"), F.col("qual_type_name").alias("kind"))
    scored = goals.select("match_id", F.col("team_id").alias("t2"), "m").distinct()
    yellow = cards.where("kind = 'Yellow'").join(scored, "match_id", "left")
    hit = (F.col("t2") != F.col("team_id")) & (F.col("m") > F.col("card")) & (F.col("m") <= F.col("card") + 10)
    yellow = yellow.groupBy(*team).agg(F.max(F.when(hit, 1).otherwise(0)).alias("conceded_after_yellow"), F.lit(1).alias("had_yellow_card"))
    touches = events.where(F.col("is_touch") & (F.col("x") > 50)).groupBy(*team, F.col("expanded_minute").alias("m")).agg(F.count("*").alias("c"))
    red = cards.where("kind in ('Red', 'SecondYellow')").select(*team, "card").distinct().join(touches, team).where(F.col("m").between(F.col("card") - 10, F.col("card") + 10))
    sides = lambda p: F.sum(F.when(p, F.col("c")).otherwise(0))
    red = red.groupBy(*team, "card").agg(sides(F.col("m") < F.col("card")).alias("b"), sides(F.col("m") > F.col("card")).alias("a"))
    red = red.groupBy(*team).agg(F.avg(F.when(F.col("b") > 0, F.col("a") / F.nullif("b", F.lit(0))).when(F.col("a") > 0, 1.0)).alias("red_card_resilience"))
    ids = index.where("match_id is not null").select("match_id", F.explode(F.array("team_id", "opponent_id")).alias("team_id"), F.col("match_date").alias("ws_date"), F.col("season").alias("ws_season"), "league_source")
    return ids.join(late, team, "left").join(yellow, team, "left").join(red, team, "left").fillna(0, ["had_late_equalizer"])


def league_draw_rates(backbone: DataFrame) -> DataFrame:
    """Mean of the draw rates of the league's earlier seasons."""
    by = backbone.groupBy("league_source", "season").agg(F.avg(F.when(F.col("result_1n2") == "D", 1.0).otherwise(0.0)).alias("r"))
    return by.select("league_source", "season", F.avg("r").over(w.before(["league_source"], ["season"])).alias("league_draw_rate"))


def features_draw(backbone: DataFrame, rolling: DataFrame, style: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Draw signals of each team's match against its opponent of the same match. Red card points are those of earlier matches of the season."""
    before = w.before(SEASON, ORDER)
    red = F.col("red_cards") > 0
    points = F.when(red & win(), 3.0).when(red & (F.col("result_1n2") == "D"), 1.0).otherwise(0.0)
    base = backbone.select(*TEAM, "opponent_id", "date", "league_source", "venue", "season", F.sum(points).over(before).alias("__pts"), F.sum(F.when(red, 1).otherwise(0)).over(before).alias("__reds"))
    rates = {"had_late_equalizer": "ws_late_equalizer_rate", "conceded_after_yellow": "ws_post_yellowcard_concede_rate", "red_card_resilience": "ws_post_redcard_resilience"}
    known = behaviour.groupBy("team_id", "league_source", "ws_date").agg(*(F.avg(a).alias(b) for a, b in rates.items()))
    base = asof_latest(base, known, ["team_id", "league_source"], "date", "ws_date", list(rates.values()))
    mine = [
        "avg_gf_5", "avg_ga_5", "np_xg_roll_5", "np_xg_roll_venue_5", "np_xg_conceded_roll_5", "shot_quality_ratio_5", "avg_shots_5", "avg_sot_5", "cs_rate_5", "save_rate_roll_5", "ppda_roll_5", "season_att_rating", "season_def_rating",
        "pinnacle_prob_draw", "pinnacle_prob_team", "sterility_index_5",
    ]
    own = base.join(rolling.select(*TEAM, *mine), TEAM, "left").join(style.select(*TEAM, "ws_momentum_delta", "ws_zone_att_pct"), TEAM, "left").join(league_draw_rates(backbone), ["league_source", "season"], "left")
    own = own.withColumn("comeback_rate", F.lit(None).cast("double"))
    theirs = [*mine, "ws_momentum_delta", "ws_zone_att_pct", "comeback_rate"]
    other = own.select("match_id", F.col("team_id").alias("opponent_id"), *(F.col(c).alias(f"o_{c}") for c in theirs))
    t = own.join(other, ["match_id", "opponent_id"], "left")
    c, r = F.col, w.ratio
    ster, oster, saves = c("sterility_index_5"), c("o_sterility_index_5"), c("save_rate_roll_5") + c("o_save_rate_roll_5")
    alike = lambda x: 1.0 - F.abs(c(x) - c(f"o_{x}"))
    over = lambda a, b: F.when(c(b) > 0, r(c(a), c(b)))
    third = lambda x: F.coalesce(c(x), F.lit(0.33))
    nothing = F.lit(None).cast("double")
    upset = (1.0 / F.nullif(c("pinnacle_prob_team"), F.lit(0.0))) * r(r(c("o_avg_gf_5"), c("o_np_xg_roll_5")), r(c("avg_gf_5"), c("np_xg_roll_5"))) * F.coalesce(c("o_comeback_rate"), F.lit(0.3))
    signals = {
        "f1_mutual_cancel_idx": F.when(saves > 0, ster * oster / (saves + 0.01)), "f2_defensive_mirror": alike("ws_zone_att_pct"), "f3_draw_market_dev": c("pinnacle_prob_draw") - c("league_draw_rate"), "f4_momentum_convergence": alike("ws_momentum_delta"),
        "f5_cs_mutual_rate": c("cs_rate_5") * c("o_cs_rate_5"), "f6_ht_draw_tendency": c("ws_late_equalizer_rate"), "f7_off_def_mismatch": c("season_att_rating") - c("o_season_def_rating"), "f7_def_off_mismatch": c("o_season_att_rating") - c("season_def_rating"),
        "f8_press_dominance_ratio": F.when((c("ppda_roll_5") > 0) & (c("o_ppda_roll_5") > 0), F.ln(r(c("o_ppda_roll_5"), c("ppda_roll_5")))), "f9_chance_quality_gap": c("shot_quality_ratio_5") - c("o_shot_quality_ratio_5"),
        "f10_venue_power_adj": c("np_xg_roll_venue_5") - c("np_xg_roll_5"), "f11_comeback_rate": c("comeback_rate"), "f12_red_card_resilience": over("__pts", "__reds"), "f13_late_goal_tendency": nothing, "f14_goal_timing_variance": nothing,
        "f15_xg_yield_ratio": over("avg_gf_5", "np_xg_roll_5"), "f16_def_yield_ratio": over("avg_ga_5", "np_xg_conceded_roll_5"), "f17_shots_to_goal_eff": over("avg_gf_5", "avg_shots_5"), "f18_sot_conversion": over("avg_gf_5", "avg_sot_5"),
        "f19_tactical_lock_idx": (ster + oster) * (1.0 / (F.abs(c("ppda_roll_5") - c("o_ppda_roll_5")) + 0.5)) * (1.0 - F.abs(third("ws_zone_att_pct") - third("o_ws_zone_att_pct"))),
        "f20_upset_composite": F.when((c("pinnacle_prob_team") > 0) & (c("np_xg_roll_5") > 0) & (c("o_np_xg_roll_5") > 0), upset),
    }
    return t.select("match_id", "date", "team_id", "league_source", "opponent_id", "venue", "season", *(e.alias(n) for n, e in signals.items()), *rates.values())


#: Differentials of each window: name, column, and whether the opponent's comes first.
DIFFERENCES = [
    ("xg_net", "xg_net_roll", False), ("sqr", "shot_quality_ratio", False), ("ppda", "ppda_roll", False), ("ppda_ratio", "ppda_ratio_roll", False), ("xg_opi", "xg_overperformance", False), ("save_rate", "save_rate_roll", False),
    ("defensive_actions", "defensive_actions_roll", False), ("keeper_form", "roll_save_pct", False), ("red_card_rate", "red_card_rate_roll", False), ("sterility", "sterility_index", True),
    ("shots_faced_per_goal_conceded", "shots_faced_per_goal_conceded", False), ("sterility_weighted", "sterility_weighted", False), ("press_resistance", "press_resistance", False), ("shield_efficiency", "shield_efficiency", False),
    ("win_rate", "win_rate_roll", False), ("points_pg", "points_pg_roll", False),
]
#: Those without a window take five matches.
GLOBAL = ("xg_net", "sqr", "ppda", "ppda_ratio", "xg_opi", "save_rate", "defensive_actions", "keeper_form", "red_card_rate", "sterility", "press_resistance", "shield_efficiency")


def features_final(rolling: DataFrame, style: DataFrame, draw: DataFrame, h2h: DataFrame, backbone: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Each team's match with its features, its opponent's and their differences. All joins are by match and team, so no row multiplies."""
    ws = [c for c in style.columns if c.startswith(("ws_", "squad_", "has_")) and c not in rolling.columns]
    own = rolling.join(style.select(*TEAM, *ws), TEAM, "left").join(draw.select(*TEAM, *(c for c in draw.columns if c.startswith("f") and c[1:2].isdigit())), TEAM, "left")
    plain = ["season_att_rating", "season_def_rating", "ws_dribbles_pg", "ws_fouled_pg", "ws_shots_ot_pg", "days_since_last_match", "odds_pinnacle_team", "pinnacle_prob_team", "market_prob_team", "draw_rate_5", "form_n_defenders", "form_n_midfielders", "form_n_attackers"]
    bases = sorted({c for _, c, _ in DIFFERENCES} | {"np_xg_roll", "np_xg_roll_venue", "np_xg_conceded_roll", "shot_accuracy_roll", "ppda_allowed_roll"})
    theirs = [*plain, *(f"{c}_{n}" for n in sizes for c in bases)]
    other = own.select("match_id", F.col("team_id").alias("opponent_id"), *(F.col(c).alias(f"opp_{c}") for c in theirs))
    t = own.join(other, ["match_id", "opponent_id"], "left")
    last = lambda c: F.col(f"h2h_{c}_10")
    met = h2h.select(
        *TEAM, w.ratio(last("wins"), last("played")).alias("h2h_win_rate"), w.ratio(last("draws"), last("played")).alias("h2h_draw_rate"), last("avg_gf").alias("h2h_goals_scored"), last("avg_ga").alias("h2h_goals_conceded"),
        last("avg_xg_diff").alias("h2h_xg_diff"), last("played").alias("h2h_n_matches"),
    )
    t = t.join(met, TEAM, "left").join(league_draw_rates(backbone), ["league_source", "season"], "left")
    c = F.col
    diff = lambda x, flip=False: c(f"opp_{x}") - c(x) if flip else c(x) - c(f"opp_{x}")
    cols = {f"{name}_diff_{n}": diff(f"{x}_{n}", flip) for n in sizes for name, x, flip in DIFFERENCES}
    cols |= {f"{name}_diff": diff(f"{x}_5", flip) for name, x, flip in DIFFERENCES if name in GLOBAL}
    att, dfn = w.ratio(c("season_att_rating"), c("opp_season_att_rating")), w.ratio(c("season_def_rating"), c("opp_season_def_rating"))
    cols |= {
        "tactical_advantage": c("season_att_rating") - c("opp_season_def_rating"), "ws_dribble_style_diff": diff("ws_dribbles_pg"), "ws_fouled_diff": diff("ws_fouled_pg"), "rest_days_diff": diff("days_since_last_match"),
        "draw_rate_diff": diff("draw_rate_5"), "draw_affinity": c("draw_rate_5") * c("opp_draw_rate_5"), "form_att_vs_def_gap": c("form_n_attackers").cast("double") - c("opp_form_n_defenders").cast("double"),
        "form_mid_dominance": diff("form_n_midfielders").cast("double"), "pinnacle_edge": c("pinnacle_prob_team") - c("pinnacle_prob_opp"), "market_edge": c("market_prob_team") - c("market_prob_opp"), "rating_ratio_att": att, "rating_ratio_def": dfn,
        "upset_risk_index": F.when(att.isNotNull() & dfn.isNotNull(), F.greatest(att, dfn) * c("is_home")),
    }
    return t.select(*t.columns, *(e.alias(n) for n, e in cols.items()))


def features_players(stats: DataFrame, centrality: DataFrame, xg: DataFrame, size: int = 5) -> DataFrame:
    """Each player's form over the matches before in the season, and how many there were."""
    player = ["match_id", "team_id", "player_id"]
    chance = xg.groupBy("match_id", F.col("chain_team_id").alias("team_id"), "player_id").agg(F.sum("xgchain").alias("xg_chain"))
    own = stats.join(centrality.select(*player, "pass_share", "betweenness_proxy", "creative_rate"), player, "left").join(chance, player, "left")
    centre = lambda axis: sum((F.coalesce(f"pct_z{i + 1}_c{j + 1}", F.lit(0.0)) * (20 * (j if axis else i) + 10) for i in range(5) for j in range(5)), F.lit(0.0))
    names = {
        "xg_chain": F.coalesce("xg_chain", F.lit(0.0)), "xg_contribution": F.col("xg_contribution"), "progressive_passes": F.col("n_progressive_passes"), "key_passes": F.col("n_key_passes"), "shots": F.col("n_shots"), "pass_share": F.col("pass_share"),
        "betweenness": F.col("betweenness_proxy"), "creative_rate": F.col("creative_rate"), "aerial_win_rate": F.col("aerial_win_rate"), "tackle_win_rate": w.ratio(F.col("n_tackles_won"), F.col("n_tackles")),
        "defensive_actions": F.col("n_tackles_won") + F.col("n_interceptions") + F.col("n_clearances") + F.col("n_ball_recoveries"), "clearances": F.col("n_clearances"), "zone_x": centre(0), "zone_y": centre(1), "touches": F.col("n_touches"),
    }
    at = w.previous(["player_id", "season"], ORDER, size)
    return own.select(*player, "date", "season", "league_source", *(F.avg(e).over(at).alias(f"avg_{n}_{size}") for n, e in names.items()), F.count("*").over(at).alias("n_matchs_window"))
