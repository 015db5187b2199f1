"""Event models: qualifiers, running scores, values, possession chains and passes.

Joins by inequality on time are windows here: a match's events are dealt to tasks once and sorted once, and each model adds columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.functions.scalars import ladder
from gritstone.models import constants as k
from gritstone.operators import windows as w
from gritstone.operators.aggs import flags
from gritstone.sources.match_json import NAMED

ORDER = ["expanded_minute", "second", "row_num"]
EVENT = ["match_id", "row_num"]


def qualifiers(events: DataFrame) -> DataFrame:
    """A row for each qualifier of each event, with the event's own columns."""
    own = [c for c in events.columns if c != "qualifiers_json"]
    q = events.select(*own, F.explode(F.from_json("qualifiers_json", f"array<struct<type:{NAMED},value:string>>")).alias("q"))
    return q.select(*own, F.col("q.type.value").alias("qual_type_id"), F.col("q.type.displayName").alias("qual_type_name"), F.col("q.value").alias("qual_value"))


def event_flags(quals: DataFrame, names: dict[int, str]) -> DataFrame:
    """match_id, row_num and a 0/1 column for each qualifier; others are dropped before the pivot."""
    wide = quals.where(F.col("qual_type_id").isin(*names)).groupBy(*EVENT).agg(*flags("qual_type_id", list(names), "__"))
    return wide.withColumnsRenamed({f"__{i}": n for i, n in names.items()})


def flagged(df: DataFrame, quals: DataFrame, names: dict[int, str]) -> DataFrame:
    return df.join(event_flags(quals, names), EVENT, "left").fillna(0, list(names.values()))


def is_goal() -> Column:
    return (F.col("type_id") == k.GOAL) & (F.col("outcome_id") == 1) & F.col("is_shot")


def with_scores(events: DataFrame) -> DataFrame:
    """team_score and opp_score up to and with the event's minute: goals of one minute count for all its events."""
    goal = F.when(is_goal(), 1).otherwise(0)
    own = F.sum(goal).over(Window.partitionBy("match_id", "team_id").orderBy("expanded_minute"))
    both = F.sum(goal).over(Window.partitionBy("match_id").orderBy("expanded_minute"))
    return events.withColumn("team_score", own).withColumn("opp_score", both - F.col("team_score"))


FLAGS = {
    k.Q_TO_GOAL: "is_leading_to_goal", k.Q_GOAL_ASSIST: "is_intentional_goal_assist", k.Q_INTENTIONAL_ASSIST: "is_intentional_assist", k.Q_BIG_CHANCE: "is_big_chance_created", k.Q_KEY_PASS: "is_key_pass",
    k.Q_SHOT_ASSIST: "is_shot_assist", k.Q_TO_ATTEMPT: "is_leading_to_attempt", k.Q_DEFENSIVE: "has_defensive_qual", k.Q_OFFENSIVE: "has_offensive_qual", k.Q_OPPOSITE: "has_opposite_event",
}


def enriched(events: DataFrame, quals: DataFrame, index: DataFrame) -> DataFrame:
    """Events of players with match facts, qualifier flags and the running score."""
    facts = ["match_date", "season", "league_source", "scraped_at"]
    own = with_scores(events.drop(*facts)).where("player_id is not null")
    return flagged(own.join(index.select("match_id", *facts), "match_id"), quals, FLAGS)


def values(enriched: DataFrame) -> DataFrame:
    """Five axes and the composite value of each event, in one projection."""
    t, x, ok = F.col("type_id"), F.col("x"), F.col("outcome_id") == 1
    attack, defence, duel = t.isin(1, 3, 13, 14, 15, 16, 42), t.isin(7, 8, 12, 45, 49, 74), t.isin(44, 4, 50)
    defending, attacking = F.col("has_defensive_qual") == 1, F.col("has_offensive_qual") == 1
    flag = lambda c: F.col(c) == 1
    danger = ladder([(attack, x / 100.0), (defence, (100.0 - x) / 100.0), (duel & defending, (100.0 - x) / 100.0), (duel & attacking, x / 100.0)])
    chance = ladder(
        [
            (t == k.GOAL, 1.0), (flag("is_leading_to_goal"), 0.9), (flag("is_intentional_goal_assist"), 0.85), (flag("is_intentional_assist"), 0.8), (flag("is_big_chance_created"), 0.75), (flag("is_key_pass"), 0.65),
            (flag("is_shot_assist"), 0.55), (flag("is_leading_to_attempt"), 0.5), (t == k.SAVED, 0.4), (t.isin(13, 14), 0.1), ((t == 3) & ok, 0.3), (t == k.SKILL, 0.25), ((t == 3) & ~ok, 0.05),
        ],
        F.lit(0.0),
    )
    clean = t.isin(7, 8, 12, 49, 74)
    execution = ladder([(clean & ok, 1.0), (t == k.CHALLENGE, 0.6), (clean & ~ok, 0.3), (duel & defending & ok, 1.0), (duel & defending & ~ok, 0.3)])
    deep = F.when(x < 50, 0.2).otherwise(0.0)
    pressure = ladder([(t.isin(44, 4, 45, 50, 7), F.least(F.lit(1.0), 0.8 + deep)), (flag("has_opposite_event"), F.least(F.lit(1.0), 0.6 + deep))], deep)
    late, mine, theirs = F.col("expanded_minute") >= 75, F.col("team_score"), F.col("opp_score")
    context = ladder(
        [(late & (mine < theirs), 1.0), (late & (mine > theirs), 0.85), (late & (mine == theirs) & (mine > 0), 0.75), (late & (mine == 0) & (theirs == 0), 0.6), (mine < theirs, 0.7), ((mine == theirs) & (mine > 0), 0.5), (mine > theirs, 0.4)],
        F.lit(0.3),
    )
    axes = {"danger_position": danger, "chance_creation": chance, "def_execution_quality": execution, "pressure_context": pressure, "context_weight": context}
    out = enriched.withColumns(axes)
    weight = 0.5 + 0.3 * F.col("pressure_context") + 0.2 * F.col("context_weight")
    forward = F.sqrt(F.col("danger_position") * F.col("chance_creation")) * weight
    back = F.col("danger_position") * F.col("def_execution_quality") * weight
    return out.withColumn("action_value", ladder([(attack, forward), (defence, back), (duel & defending, back), (duel & attacking, forward)]))


RESTARTS = {k.Q_CORNER: "__corner", k.Q_GOAL_KICK: "__goal_kick", k.Q_THROW_IN: "__throw_in", k.Q_FREE_KICK: "__free_kick", k.Q_INDIRECT: "__indirect"}


def possession_chains(enriched: DataFrame, quals: DataFrame) -> DataFrame:
    """Events with their possession chain: gaps and islands over a match.

    A chain begins with a restart, after a clearance that its own team wins, after a won punch, after the last event of a foul that is
    won, and where another team than before surely has the ball. Aerial duels take the earlier chain of their two sides.
    """
    m = ["match_id"]
    lag = lambda c: F.lag(c).over(w.ordered(m, ORDER))
    own = flagged(enriched.where("player_id is not null").where(~F.col("type_id").isin(*k.ADMIN)), quals, RESTARTS)
    own = own.withColumn("certain_possessor", F.when(F.col("type_id").isin(*k.ACTIVE), F.col("team_id")))
    known_before = w.last_known(F.col("certain_possessor"), m, ORDER)
    moment = w.whole(["match_id", "expanded_minute", "second", "__foul"])
    foul = F.col("type_id") == k.FOUL
    own = own.withColumn("__foul", foul).withColumns(
        {
            "__clear": (F.col("type_id") == k.CLEARANCE) & (w.next_known(F.col("certain_possessor"), m, ORDER) == F.col("team_id")),
            "__punch": (F.col("type_id") == k.PUNCH) & (F.col("outcome_id") == 1),
            "__won": foul & (F.col("row_num") == F.max("row_num").over(moment)) & (F.max(F.when(F.col("outcome_id") == 1, 1).otherwise(0)).over(moment) == 1),
            "__known": known_before,
        }
    )
    restart = F.greatest(*RESTARTS.values()) == 1
    turned = F.col("certain_possessor").isNotNull() & ~F.col("certain_possessor").eqNullSafe(F.col("__known"))
    starts = F.coalesce(restart, F.lit(False)) | F.coalesce(lag("__clear"), F.lit(False)) | F.coalesce(lag("__punch"), F.lit(False)) | F.coalesce(lag("__won"), F.lit(False)) | turned
    own = own.withColumn("__starts", starts).withColumn("possession_group", w.island_id(F.col("__starts"), m, ORDER))
    group = ["match_id", "possession_group"]
    own = own.withColumn("chain_team_id", F.max("certain_possessor").over(w.until(group, ORDER)))
    first = w.whole(group)
    at_first = lambda c: F.min_by(c, "row_num").over(first)
    trigger = ladder(
        [
            (at_first("type_id").isin(k.TACKLE, k.INTERCEPTION, k.RECOVERY), "recovery"), (at_first("__corner") == 1, "corner"), (at_first("__goal_kick") == 1, "goal_kick"),
            (at_first("__throw_in") == 1, "throw_in"), (at_first("__free_kick") == 1, "free_kick"),
        ],
        F.lit("open_play"),
    )
    o = w.ordered(m, ORDER)
    rupture = F.when(F.row_number().over(o) == 1, 0).otherwise((~F.lead("chain_team_id").over(o).eqNullSafe(F.col("chain_team_id"))).cast("int"))
    own = own.withColumns({"chain_trigger": trigger, "is_rupture": rupture})
    own = own.join(_aerial_groups(own, quals), EVENT, "left").withColumn("chain_number", F.coalesce("__aerial", "possession_group"))
    out = own.withColumn("chain_id", F.concat("match_id", F.lit("_"), F.col("chain_number").cast("string")))
    return out.drop("__aerial", "__foul", "__clear", "__punch", "__won", "__known", "__starts", *RESTARTS.values(), "possession_group")


def _aerial_groups(events: DataFrame, quals: DataFrame) -> DataFrame:
    """match_id, row_num and the earlier group of each aerial duel: by the linked event of the other side, else by the same second."""
    aerial = events.where(F.col("type_id") == k.AERIAL).select("match_id", "row_num", "event_id", "team_id", "expanded_minute", "second", "possession_group")
    link = quals.where(F.col("qual_type_id") == k.Q_OPPOSITE).groupBy(F.col("match_id"), F.col("event_id")).agg(F.min(F.col("qual_value").try_cast("int")).alias("other"))
    side = events.select("match_id", F.col("event_id").alias("other"), F.col("team_id").alias("t2"), F.col("possession_group").alias("g2"))
    linked = aerial.join(link, ["match_id", "event_id"], "left")
    pairs = linked.where("other is not null").join(side, ["match_id", "other"]).where("t2 <> team_id").groupBy(*EVENT).agg(F.min("g2").alias("g2"))
    moment = aerial.select("match_id", "expanded_minute", "second", F.col("team_id").alias("t2"), F.col("possession_group").alias("g2"))
    orphans = linked.where("other is null").join(moment, ["match_id", "expanded_minute", "second"]).where("t2 <> team_id").groupBy(*EVENT).agg(F.min("g2").alias("g2"))
    best = pairs.unionByName(orphans)
    return aerial.join(best, EVENT, "left").select(*EVENT, F.least("possession_group", "g2").alias("__aerial"))


def passes(chains: DataFrame) -> DataFrame:
    """Successful passes with the next player of the same team in the chain."""
    own = chains.where("team_id = chain_team_id").withColumn("receiver_id", F.lead("player_id").over(w.ordered(["match_id", "chain_id"], ORDER)))
    own = own.where((F.col("type_id") == k.PASS) & (F.col("outcome_id") == 1) & (F.col("receiver_id") != F.col("player_id")))
    yes = lambda p: F.coalesce(p, F.lit(False))
    return own.select(
        "match_id", "chain_id", "chain_trigger", "team_id", F.col("player_id").alias("passer_id"), "receiver_id", "row_num", "expanded_minute", "second", "period", "x", "y", "end_x", "end_y", "is_key_pass", "is_shot_assist",
        "team_score", "opp_score", "season", "league_source",
        yes(F.col("end_x") > F.col("x") + 10).alias("is_progressive"), yes((F.col("is_key_pass") == 1) | (F.col("is_shot_assist") == 1)).alias("is_creative"), yes(F.col("x") < 50).alias("is_buildup"),
    )


def duels(enriched: DataFrame, quals: DataFrame) -> DataFrame:
    """Both sides of each duel in a row, the earlier event first."""
    link = quals.where(F.col("qual_type_id") == k.Q_OPPOSITE).select(*EVENT, F.col("qual_value").try_cast("long").alias("opposite"))
    own = enriched.where(F.col("type_id").isin(3, 4, 7, 44, 45, 50)).join(link, EVENT)
    side = lambda s, more=(): own.select("match_id", *more, *(F.col(c).alias(f"{n}_{s}") for c, n in (("event_id", "event_id"), ("team_id", "team_id"), ("player_id", "player_id"), ("outcome_id", "outcome"), ("row_num", "row"))))
    a = side("a", ("season", "league_source", "expanded_minute", "second", F.col("type_id").alias("duel_type_id"), F.col("type_name").alias("duel_type"), "x", "y", "opposite"))
    return a.join(side("b").withColumnRenamed("match_id", "m"), (F.col("match_id") == F.col("m")) & (F.col("opposite") == F.col("event_id_b")) & (F.col("team_id_a") != F.col("team_id_b")) & (F.col("row_a") < F.col("row_b"))).drop("m", "opposite", "row_a", "row_b")


def shot_placement(enriched: DataFrame, values: DataFrame) -> DataFrame:
    """A row for each shot; where it went is known for shots on target only."""
    shots = w.first_per(enriched.where(F.col("type_id").isin(*k.SHOTS)), EVENT, ["event_id"])
    own = shots.join(values.select(*EVENT, F.col("chance_creation").alias("pre_shot_xg_proxy")).dropDuplicates(EVENT), EVENT, "left")
    on = F.col("type_id").isin(k.SAVED, k.GOAL)
    y, z = F.col("goal_mouth_y"), F.col("goal_mouth_z")
    if_on = lambda c: F.when(on, c)
    col = F.when(y < 48.4, "left").when(y <= 51.6, "center").otherwise("right")
    row = F.when(z < 12.7, "low").when(z <= 25.3, "mid").otherwise("high")
    corner = lambda d: F.sqrt(F.pow(d / 9.6, 2) + F.pow(1 - z / 38.0, 2))
    return own.withColumns(
        {
            "is_goal": F.col("type_id") == k.GOAL, "is_on_target": on, "offset_center": if_on(F.abs(y - 50.0)), "height": if_on(z), "placement_col": if_on(col), "placement_row": if_on(row),
            "placement_zone": if_on(F.concat(row, F.lit("_"), col)), "corner_dist": if_on(F.least(corner(y - 45.2), corner(54.8 - y))),
        }
    )
