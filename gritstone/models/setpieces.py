"""Corners and free kicks: delivery, shot, clearance, danger and outcome, and their rolling rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritstone.functions.scalars import ladder
from gritstone.models import constants as k
from gritstone.models.events import EVENT, flagged
from gritstone.operators import windows as w

CHAIN = ["match_id", "chain_id"]


def _danger(own: DataFrame) -> DataFrame:
    """Of each chain's attackers: danger in all, its share before the last shot, and that shot."""
    shot = F.when(F.col("is_shot"), F.col("row_num"))
    rows = own.where("team_id = chain_team_id").withColumn("last_shot_row", F.max(shot).over(w.whole(CHAIN)))
    by = rows.groupBy(*CHAIN, "last_shot_row").agg(
        F.sum("action_value").alias("chain_danger_total"), F.sum(F.when(F.col("row_num") < F.col("last_shot_row"), F.col("action_value"))).alias("__before"),
        F.max_by(F.when(F.col("is_shot"), F.col("type_id")), F.when(F.col("is_shot"), F.col("row_num"))).alias("last_shot_type_id"),
    )
    momentum = F.when(F.col("last_shot_row").isNotNull(), F.col("__before") / F.nullif("chain_danger_total", F.lit(0.0)))
    return by.withColumn("chain_danger_momentum", momentum).drop("__before")


def _body_part(shots: DataFrame, quals: DataFrame, row: str) -> DataFrame:
    """chain and shot_body_part of the chain's shot at ``row``; of several the last by name."""
    part = ladder([(F.col("qual_type_id") == i, n) for i, n in k.BODY_PARTS.items()])
    q = quals.where(F.col("qual_type_id").isin(*k.BODY_PARTS)).select("match_id", F.col("row_num").alias(row), part.alias("part"))
    return shots.join(q, ["match_id", row]).groupBy(*CHAIN).agg(F.max("part").alias("shot_body_part"))


def _clearances(chains: DataFrame, own: DataFrame, quals: DataFrame) -> DataFrame:
    """The defenders' first clearance of each chain: by whom, how, and who had the ball next."""
    order = ["row_num"]
    after = chains.select(*EVENT, w.next_known(F.col("certain_possessor"), ["match_id"], order).alias("__next"), w.next_known(F.when(F.col("certain_possessor").isNotNull(), F.struct("x")), ["match_id"], order).alias("__x"))
    first = w.first_per(own.where((F.col("type_id") == k.CLEARANCE) & (F.col("team_id") != F.col("chain_team_id"))), CHAIN, order)
    parts = quals.where(F.col("qual_type_id").isin(k.Q_HEAD, k.Q_OTHER_PART)).groupBy(*EVENT).agg(F.bool_or(F.col("qual_type_id") == k.Q_HEAD).alias("is_headed_clearance"))
    both = first.join(after, EVENT, "left").join(parts, EVENT, "left")
    x = F.col("__x")["x"]
    quality = F.when(F.col("__next") == F.col("team_id"), "perfect").when(F.col("__next").isNotNull(), F.when(x >= 83, "failed").when(x >= 75, "poor").otherwise("good"))
    return both.select(*CHAIN, F.col("player_id").alias("clearance_player_id"), "is_headed_clearance", quality.alias("clearance_quality"))


def _outcome(shot: Column) -> list[tuple[Column, str]]:
    return [(shot == k.GOAL, "goal"), (shot == k.SAVED, "shot_saved"), (shot.isin(k.MISS, k.POST), "shot_off_target")]


def corner_profiles(chains: DataFrame, values: DataFrame, quals: DataFrame) -> DataFrame:
    """A row for each corner."""
    own = chains.where("chain_trigger = 'corner'").join(values.select(*EVENT, "action_value"), EVENT, "left")
    first = own.withColumn("corner_row_num", F.min("row_num").over(w.whole(CHAIN))).where("row_num = corner_row_num")
    taken = quals.where(F.col("qual_type_id") == k.Q_CORNER).select("match_id", "row_num", F.col("player_id").alias("corner_taker_id"), F.col("y").alias("__y"), F.col("end_x").alias("__ex"), F.col("end_y").alias("__ey")).distinct()
    delivery = first.select(*CHAIN, "row_num", "corner_row_num", F.col("chain_team_id").alias("team_id"), "expanded_minute").join(taken, EVENT).drop("row_num")
    counts = own.groupBy(*CHAIN).agg(F.count_if(F.col("type_id") == k.AERIAL).alias("n_aerial_duels"), F.max(F.when(F.col("type_id") == k.CLEARANCE, 1).otherwise(0)).alias("__cleared"))
    danger = _danger(own)
    shots = danger.where("last_shot_row is not null").select(*CHAIN, "last_shot_row")
    out = delivery.join(counts, CHAIN).join(danger, CHAIN, "left").join(_body_part(shots, quals, "last_shot_row"), CHAIN, "left").join(_clearances(chains, own, quals), CHAIN, "left")
    y, ex, ey = F.col("__y"), F.col("__ex"), F.col("__ey")
    near = ((y < 50) & (ey < 45)) | ((y >= 50) & (ey > 55))
    zone = ladder([(ex < 83, "short"), (ey.between(45, 55), "center"), (near, "near_post")], F.lit("far_post"))
    ended = ladder([*_outcome(F.col("last_shot_type_id")), (F.col("__cleared") == 1, "clearance")], F.lit("retained"))
    return out.select(
        "match_id", "team_id", "corner_taker_id", "corner_row_num", "expanded_minute", F.when(y < 50, "right").otherwise("left").alias("corner_side"), zone.alias("landing_zone"), "n_aerial_duels", "shot_body_part",
        "clearance_player_id", "clearance_quality", "is_headed_clearance", ended.alias("outcome"), "chain_danger_total", "chain_danger_momentum",
    )


KICKS = {k.Q_FREE_KICK: "__pass", k.Q_DIRECT: "__direct", k.Q_INDIRECT: "__indirect", k.Q_CROSS: "__cross"}


def freekick_profiles(chains: DataFrame, values: DataFrame, quals: DataFrame) -> DataFrame:
    """A row for each free kick: direct shots, and passes with what came of them; geometry in metres."""
    own = chains.where("chain_trigger = 'free_kick'").join(values.select(*EVENT, "action_value"), EVENT, "left")
    own = flagged(own, quals, KICKS)
    t = F.col("type_id")
    base = [*CHAIN, "chain_number", "chain_team_id", F.col("player_id").alias("freekick_taker_id"), "row_num", "event_id", "expanded_minute", "second", "type_id", "outcome_id", "x", "y"]
    direct = own.where(t.isin(*k.SHOTS) & (F.col("__direct") == 1)).select(*base, F.lit("direct").alias("fk_type"), F.lit(False).alias("is_offside"), F.lit("direct_shot").alias("fk_zone_type"), ladder(_outcome(t)).alias("outcome"))
    anchors = own.where(t.isin(k.PASS, k.OFFSIDE_PASS) & (F.col("__pass") == 1)).select(
        *base, F.when(F.col("__indirect") == 1, "indirect").otherwise("short_pass").alias("fk_type"), (t == k.OFFSIDE_PASS).alias("is_offside"),
        F.when(F.col("x") < 17, "own_box").when(F.col("__cross") == 1, "crossed").otherwise("too_far").alias("fk_zone_type"),
    )
    attack = chains.join(anchors.select(*CHAIN).distinct(), CHAIN, "left_semi").where("team_id = chain_team_id")
    late = [F.desc("expanded_minute"), F.desc("second"), F.desc("row_num")]
    shot = w.first_per(attack.where("is_shot"), CHAIN, late).select(*CHAIN, F.col("row_num").alias("__shot_row"), F.col("type_id").alias("__shot"))
    last = w.first_per(attack, CHAIN, late).select(*CHAIN, F.col("type_id").alias("__last"), F.col("outcome_id").alias("__ok"))
    calm = F.col("__shot").isNull() & (F.col("__ok") == 1)
    ended = ladder(
        [(F.col("is_offside"), "offside"), *_outcome(F.col("__shot")), (calm & (F.col("__last") == k.FOUL), "foul_won"), (calm & (F.col("__last") == k.CORNER), "corner_won"), (calm & F.col("__last").isin(k.PASS, k.TAKE_ON, k.TOUCH), "open_play")],
        F.lit("turnover"),
    )
    passed = anchors.join(shot, CHAIN, "left").join(last, CHAIN, "left").withColumn("outcome", ended).drop("__shot", "__shot_row", "__last", "__ok")
    crossed = F.col("fk_zone_type") == "crossed"
    extras = _body_part(shot.select(*CHAIN, "__shot_row"), quals, "__shot_row").join(_clearances(chains, own, quals), CHAIN, "full")
    more = ["shot_body_part", "clearance_player_id", "is_headed_clearance", "clearance_quality"]
    out = direct.unionByName(passed).join(_danger(own).drop("last_shot_row", "last_shot_type_id"), CHAIN, "left").join(extras, CHAIN, "left")
    out = out.withColumns({c: F.when(crossed, F.col(c)) for c in more})
    dx, y = 105 - F.col("x") * 1.05, F.col("y") * 0.68
    to = lambda post: F.sqrt(dx * dx + F.pow(post - y, 2))
    cos = (dx * dx + (30.34 - y) * (37.66 - y)) / F.nullif(to(30.34) * to(37.66), F.lit(0.0))
    return out.withColumns({"x_m": F.col("x") * 1.05, "y_m": y, "distance_to_goal": to(34.0), "angle": F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos)))})


_SHOT = ("goal", "shot_saved", "shot_off_target")


def _counts(df: DataFrame, team: str, total: str, more: list[Column]) -> DataFrame:
    p = lambda name, c: F.count_if(c).alias(name)
    outcome, head = F.col("outcome"), F.col("shot_body_part") == "head"
    return df.groupBy("match_id", F.col(team).alias("team_id")).agg(
        F.count("*").alias(total), p("n_dangerous", outcome.isin(*_SHOT)), p("n_goals", outcome == "goal"), F.sum("chain_danger_total").alias("sum_danger"), p("n_headed_shots", head), p("n_headed_goals", (outcome == "goal") & head),
        p("n_clearances", F.col("clearance_quality").isNotNull()), p("n_clearances_bad", F.col("clearance_quality").isin("poor", "failed")), p("n_clearances_headed", F.col("is_headed_clearance")),
        p("n_clearances_bodypart_known", F.col("is_headed_clearance").isNotNull()), *more,
    )


def _for_and_against(backbone: DataFrame, chains: DataFrame, own: DataFrame) -> DataFrame:
    """Both sides' counts beside each team's match: 0 where the match has events, null where it has none."""
    seen = chains.select("match_id").distinct().withColumn("__seen", F.lit(True))
    out = backbone.select("match_id", "team_id", "opponent_id", "date", "season", "league_source").join(seen, "match_id", "left")
    cols = [c for c in own.columns if c not in ("match_id", "team_id")]
    for side, key in (("for", "team_id"), ("against", "opponent_id")):
        part = own.select("match_id", F.col("team_id").alias(key), *(F.col(c).alias(f"{c}_{side}") for c in cols))
        out = out.join(part, ["match_id", key], "left")
        out = out.withColumns({f"{c}_{side}": F.when(F.col("__seen"), F.coalesce(f"{c}_{side}", F.lit(0))) for c in cols})
    return out.drop("__seen")


def _rates(base: DataFrame, sums: dict[str, str], ratios: dict[str, tuple[str, str]], sizes: tuple[int, ...]) -> DataFrame:
    """Rolling sums and ratios of sums over the matches before; all windows share one partitioning and sort."""
    keys, order = ["team_id", "season", "league_source"], ["date", "match_id"]
    cols = [F.sum(c).over(w.previous(keys, order, n)).alias(f"{name}_{n}") for n in sizes for name, c in sums.items()]
    cols += w.rolling_ratio({name: (F.col(a).cast("double"), F.col(b)) for name, (a, b) in ratios.items()}, keys, order, sizes)
    return base.select("match_id", "team_id", "date", "season", "league_source", *cols)


def _shared(name: str, total: str) -> dict[str, tuple[str, str]]:
    out = {}
    for s in ("for", "against"):
        out |= {
            f"{name}_danger_rate_{s}": (f"n_dangerous_{s}", f"{total}_{s}"), f"{name}_conversion_rate_{s}": (f"n_goals_{s}", f"n_dangerous_{s}"), f"{name}_danger_intensity_{s}": (f"sum_danger_{s}", f"{total}_{s}"),
            f"{name}_header_share_{s}": (f"n_headed_shots_{s}", f"n_dangerous_{s}"), f"{name}_header_goal_share_{s}": (f"n_headed_goals_{s}", f"n_goals_{s}"),
        }
    return out | {
        f"{name}_forced_bad_clearance_rate_for": ("n_clearances_bad_for", "n_clearances_for"), f"{name}_clearance_fail_rate_against": ("n_clearances_bad_against", "n_clearances_against"),
        f"{name}_headed_clearance_rate_against": ("n_clearances_headed_against", "n_clearances_bodypart_known_against"),
    }


def rolling_corners(backbone: DataFrame, chains: DataFrame, corners: DataFrame, sizes: tuple[int, ...] = (3, 5, 10)) -> DataFrame:
    own = _counts(corners, "team_id", "n_corners", [F.count_if(F.col("landing_zone") == "short").alias("n_short")])
    base = _for_and_against(backbone, chains, own)
    ratios = _shared("corner", "n_corners") | {f"corner_short_rate_{s}": (f"n_short_{s}", f"n_corners_{s}") for s in ("for", "against")}
    return _rates(base, {f"corners_{s}": f"n_corners_{s}" for s in ("for", "against")}, ratios, sizes)


def rolling_freekicks(backbone: DataFrame, chains: DataFrame, kicks: DataFrame, sizes: tuple[int, ...] = (3, 5, 10)) -> DataFrame:
    zone = F.col("fk_zone_type")
    direct = zone == "direct_shot"
    more = [F.count_if(direct).alias("n_direct"), F.sum(F.when(direct, F.col("distance_to_goal"))).alias("sum_direct_distance"), F.sum(F.when(direct, F.col("angle"))).alias("sum_direct_angle")]
    own = _counts(kicks.where(zone.isin("crossed", "direct_shot")), "chain_team_id", "n_freekicks", more)
    zones = kicks.groupBy("match_id", F.col("chain_team_id").alias("team_id")).agg(F.count("*").alias("n_total"), F.count_if(direct).alias("n_zone_direct"), F.count_if(zone == "crossed").alias("n_zone_crossed"))
    base = _for_and_against(backbone, chains, zones.join(own, ["match_id", "team_id"], "left"))
    ratios = _shared("freekick", "n_freekicks")
    for s in ("for", "against"):
        ratios |= {f"freekick_direct_{m}_avg_{s}": (f"sum_direct_{m}_{s}", f"n_direct_{s}") for m in ("distance", "angle")}
        ratios |= {f"freekick_zone_{z}_rate_{s}": (f"n_zone_{z}_{s}", f"n_total_{s}") for z in ("direct", "crossed")}
    return _rates(base, {f"freekicks_{s}": f"n_freekicks_{s}" for s in ("for", "against")}, ratios, sizes)
