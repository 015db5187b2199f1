"""Pass networks, shot chains and zone transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.models import constants as k
from gritstone.models.events import EVENT, ORDER
from gritstone.operators import graph
from gritstone.operators import windows as w
from gritstone.operators.aggs import entropy

TEAM = ["match_id", "team_id"]


def pass_edges(passes: DataFrame) -> DataFrame:
    trigger = F.col("chain_trigger")
    other = trigger.isin("corner", "free_kick", "throw_in", "goal_kick")
    n = lambda name, p: F.count_if(p).alias(name)
    return passes.groupBy(*TEAM, "passer_id", "receiver_id", "season", "league_source").agg(
        F.count("*").alias("n_passes"), n("n_passes_counter_attack", trigger == "counter_attack"), n("n_passes_open_play", trigger == "open_play"), n("n_passes_recovery", trigger == "recovery"), n("n_passes_other", other),
        n("n_progressive", F.col("is_progressive")), n("n_creative", F.col("is_creative")), n("n_buildup", F.col("is_buildup")),
    )


def centrality(edges: DataFrame) -> DataFrame:
    """Degrees, shares and the centrality proxy of each passer."""
    out = edges.groupBy(*TEAM, F.col("passer_id").alias("player_id"), "season", "league_source").agg(
        F.count_distinct("receiver_id").alias("degree_out"), F.sum("n_passes").alias("weighted_degree_out"), F.sum("n_creative").alias("n_creative_out"), F.sum("n_progressive").alias("n_progressive_out")
    )
    into = edges.groupBy(*TEAM, F.col("receiver_id").alias("player_id")).agg(F.count_distinct("passer_id").alias("degree_in"), F.sum("n_passes").alias("weighted_degree_in"))
    own = out.join(into, [*TEAM, "player_id"], "left").fillna(0, ["degree_in", "weighted_degree_in"])
    team = Window.partitionBy(*TEAM)
    n = F.count("*").over(team)
    return own.withColumns(
        {
            "pass_share": F.round(F.col("weighted_degree_out") / F.nullif(F.sum("weighted_degree_out").over(team), F.lit(0)), 4),
            "creative_rate": F.round(F.col("n_creative_out") / F.nullif("weighted_degree_out", F.lit(0)), 4),
            "betweenness_proxy": F.round(F.col("degree_out") * F.col("degree_in") / F.nullif(n * (n - 1), F.lit(0)), 4),
        }
    )


def betweenness(edges: DataFrame) -> DataFrame:
    """Exact betweenness, the number of passes as distance."""
    return graph.betweenness(edges, TEAM, "passer_id", "receiver_id", "n_passes").withColumnRenamed("node", "player_id")


def team_network(centrality: DataFrame, passes: DataFrame) -> DataFrame:
    net = centrality.groupBy(*TEAM, "season", "league_source").agg(
        F.count("*").alias("n_players"), F.sum("degree_out").alias("n_edges"), F.round(F.max("pass_share"), 4).alias("top_creator_share"), F.round(F.avg("betweenness_proxy"), 4).alias("avg_betweenness"),
        F.round(entropy(F.col("pass_share")), 4).alias("network_entropy"),
    )
    net = net.withColumn("network_density", F.round(F.col("n_edges") / F.nullif(F.col("n_players") * (F.col("n_players") - 1), F.lit(0)), 4))
    exact = lambda c: F.col(c).cast("decimal(9,4)")  # noqa: E731  (a mean that doesn't depend on the order of rows)
    mean = lambda c, name, p=None: F.round(F.avg(exact(c) if p is None else F.when(p, exact(c))), 2).cast("double").alias(name)
    fwd = F.col("is_progressive")
    place = passes.groupBy(*TEAM).agg(mean("x", "centroid_x"), mean("y", "centroid_y"), mean("x", "centroid_x_progressive", fwd), mean("y", "centroid_y_progressive", fwd))
    return net.join(place, TEAM, "left")


def _placed(df: DataFrame) -> DataFrame:
    """The last place of each player among the rows of a chain, and its weight."""
    chain = ["match_id", "chain_id"]
    own = df.withColumn("position_in_chain", F.row_number().over(w.ordered(chain, ORDER))).withColumn("chain_length", F.count("*").over(w.whole(chain)))
    last = w.first_per(own, [*chain, "player_id"], [F.desc("position_in_chain")])
    return last.withColumn("position_weight", F.round(F.col("position_in_chain") / F.col("chain_length"), 4))


def chain_shots(chains: DataFrame, values: DataFrame) -> DataFrame:
    """The last shot of each chain by the team that has the ball."""
    shots = chains.where(F.col("is_shot") & (F.col("team_id") == F.col("chain_team_id")) & F.col("type_id").isin(*k.SHOTS))
    shots = shots.join(values.select(*EVENT, F.col("chance_creation").alias("xg_proxy")), EVENT)
    last = w.first_per(shots, ["match_id", "chain_id"], [F.desc("expanded_minute"), F.desc("second"), F.desc("row_num")])
    return last.select(
        "match_id", "chain_id", "chain_number", "chain_team_id", "season", "league_source", F.col("player_id").alias("shooter"), F.col("event_id").alias("shot_event_id"), F.col("expanded_minute").alias("shot_minute"),
        F.col("type_id").alias("shot_type_id"), "xg_proxy",
    )


def xg_chain(chains: DataFrame, values: DataFrame, quals: DataFrame) -> DataFrame:
    """Each participant's share in the chance that ended the chain; build-up leaves out the shooter and the assister."""
    shots = chain_shots(chains, values)
    key = ["match_id", "chain_id"]
    linked = quals.where(F.col("qual_type_id") == k.Q_ASSIST_EVENT).select("match_id", F.col("event_id").alias("shot_event_id"), F.col("qual_value").try_cast("long").alias("event_id"))
    assist = shots.select(*key, "shot_event_id").join(linked, ["match_id", "shot_event_id"]).join(chains.select(*key, "event_id", "player_id"), [*key, "event_id"])
    assist = assist.groupBy(*key).agg(F.max("player_id").alias("assister"))
    fast = quals.where(F.col("qual_type_id") == k.Q_FAST_BREAK).select(*EVENT).distinct()
    counter = chains.where("is_shot").join(fast, EVENT, "left_semi").select(*key).distinct().withColumn("is_counter_attack", F.lit(True))
    members = chains.where("team_id = chain_team_id").join(shots.select(*key), key, "left_semi")
    own = _placed(members).select(*key, "player_id", "position_in_chain", "chain_length", "position_weight")
    out = own.join(shots, key).join(assist, key, "left").join(counter, key, "left").fillna(False, ["is_counter_attack"])
    shooter, assister = F.col("player_id") == F.col("shooter"), F.coalesce(F.col("player_id") == F.col("assister"), F.lit(False))
    weighted = F.round(F.col("xg_proxy") * F.col("position_weight"), 4)
    build = lambda c: F.when(~shooter & ~assister, c)
    return out.withColumns(
        {"is_shooter": shooter, "is_assister": assister, "xgchain": F.col("xg_proxy"), "xgchain_weighted": weighted, "xgbuildup": build(F.col("xg_proxy")), "xgbuildup_weighted": build(weighted)}
    ).drop("shooter", "assister")


def threat_conceded(xg: DataFrame, chains: DataFrame, quals: DataFrame) -> DataFrame:
    """The mirror for defenders; a keeper only answers for a chance outside of penalties after an own error."""
    key = ["match_id", "chain_id"]
    shots = xg.select(*key, "chain_number", "chain_team_id", "xg_proxy", "season", "league_source", "shot_event_id").dropDuplicates(key)
    pens = quals.where(F.col("qual_type_id") == k.Q_PENALTY).select("match_id", F.col("event_id").alias("shot_event_id")).distinct().withColumn("is_penalty", F.lit(True))
    shots = shots.join(pens, ["match_id", "shot_event_id"], "left").fillna(False, ["is_penalty"])
    errors = quals.where(F.col("qual_type_id") == k.Q_TO_GOAL).select("match_id", "event_id").distinct().withColumn("__led", F.lit(True))
    own = chains.where("team_id <> chain_team_id").join(shots.select(*key), key, "left_semi").join(errors, ["match_id", "event_id"], "left")
    who = w.whole([*key, "player_id"])
    own = own.withColumn("is_keeper", F.bool_or(F.col("type_id").isin(k.SAVE, k.CLAIM, k.PUNCH, k.PICKUP)).over(who))
    own = own.withColumn("has_error_leading_to_goal", F.bool_or((F.col("type_id") == k.ERROR) & F.col("__led").isNotNull()).over(who))
    last = _placed(own).select(*key, "player_id", "team_id", "position_in_chain", "chain_length", "position_weight", "is_keeper", "has_error_leading_to_goal")
    weighted = F.round(F.col("xg_proxy") * F.col("position_weight"), 4)
    spared = F.col("is_keeper") & (F.col("is_penalty") | ~F.col("has_error_leading_to_goal"))
    return last.join(shots, key).withColumns({"threat_conceded": F.col("xg_proxy"), "threat_conceded_weighted": F.when(spared, 0.0).otherwise(weighted)})


def grid(x: Column, y: Column) -> Column:
    """Lane (A to C across) and band (1 the highest up the pitch to 5)."""
    lane = F.when(y < 33.3, "A").when(y < 66.6, "B").otherwise("C")
    band = F.when(x >= 80, "1").when(x >= 60, "2").when(x >= 40, "3").when(x >= 20, "4").otherwise("5")
    return F.concat(lane, band)


def formations_in_force(enriched: DataFrame, quals: DataFrame) -> DataFrame:
    """match_id, team_id, row_num and the formation last set before or at the event."""
    code = quals.where(F.col("qual_type_id") == k.Q_FORMATION).where(F.col("type_id").isin(34, 40))
    anchors = code.select(*TEAM, F.when(F.col("type_id") == 34, 1).otherwise(F.col("row_num")).alias("row_num"), F.col("qual_value").alias("formation"), F.lit(0).alias("e"))
    both = enriched.select(*TEAM, "row_num", F.lit(None).cast("string").alias("formation"), F.lit(1).alias("e")).unionByName(anchors)
    return both.withColumn("formation", w.carried(F.col("formation"), TEAM, ["row_num", "e", "formation"])).where("e = 1").drop("e")


def zone_transitions(passes: DataFrame, enriched: DataFrame, quals: DataFrame) -> DataFrame:
    """Counts of moves between zones by passes and take-ons, with their share and how many go forward."""
    cols = [*TEAM, "player_id", "row_num", "season", "league_source", "period", "team_score", "opp_score", "x", "y", "end_x", "end_y"]
    moved = passes.withColumnRenamed("passer_id", "player_id").select(*cols)
    o = w.ordered(["match_id", "player_id"], ["row_num"])
    runs = enriched.where((F.col("type_id") == k.TAKE_ON) & (F.col("outcome_id") == 1)).withColumns({"end_x": F.lead("x").over(o), "end_y": F.lead("y").over(o)})
    both = moved.unionByName(runs.where("end_x is not null and end_y is not null").select(*cols))
    both = both.join(formations_in_force(enriched, quals), [*TEAM, "row_num"], "left")
    state = F.when(F.col("team_score") > F.col("opp_score"), "winning").when(F.col("team_score") < F.col("opp_score"), "losing").otherwise("drawing")
    own = both.withColumns({"score_state": state, "zone_from": grid(F.col("x"), F.col("y")), "zone_to": grid(F.col("end_x"), F.col("end_y")), "__fwd": F.when(F.col("end_x") > F.col("x") + 10, 1).otherwise(0)})
    who = [*TEAM, "player_id", "period", "score_state", "formation"]
    n = own.groupBy(*who, "season", "league_source", "zone_from", "zone_to").agg(F.count("*").alias("n_transitions"), F.round(F.avg("__fwd"), 4).alias("progressive_rate"))
    return n.withColumn("pct_transitions", F.round(F.col("n_transitions") / F.sum("n_transitions").over(Window.partitionBy(*who)), 4))
