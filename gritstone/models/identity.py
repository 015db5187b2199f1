"""Canonical ids for provider tables: team names and provider ids to registry keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.functions.scalars import snake
from gritstone.models.constants import COUNTERS
from gritstone.sources.match_json import series_sum

MATCH_KEYS = ["match_date", "league_source", "season"]


def teams(mapping: DataFrame) -> DataFrame:
    """A row for each club name: the mapping has one for each alias."""
    return mapping.groupBy("club_name").agg(F.min("team_id").alias("team_id"))


def with_teams(df: DataFrame, mapping: DataFrame, home: str, away: str) -> DataFrame:
    """team_id and opponent_id by name. The mapping is a seed of clubs; Spark broadcasts it if it is small."""
    t = teams(mapping)
    a = t.select(F.col("club_name").alias(home), "team_id")
    b = t.select(F.col("club_name").alias(away), F.col("team_id").alias("opponent_id"))
    return df.join(a, home, "left").join(b, away, "left")


def team_match_facts(source: DataFrame, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """One category of team-match facts with ids; a neutral ground's teams may be either side of the registry's match."""
    own = with_teams(source, mapping, "team", "opponent").drop("team", "opponent", "raw_team", "raw_opponent")
    reg = registry.select("match_id", F.col("match_date").alias("date"), "league_source", "season", "home_team_id", "away_team_id")
    home, away = F.col("team_id") == F.col("home_team_id"), F.col("team_id") == F.col("away_team_id")
    role = ((F.col("venue") == "Home") & home) | ((F.col("venue") == "Away") & away) | ((F.col("venue") == "Neutral") & (home | away))
    keys = ["date", "league_source", "season"]
    a, b = own.alias("a"), reg.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    return a.join(b, [*on, role], "left").select("b.match_id", *(F.col(f"a.{c}") for c in own.columns))


def odds(source: DataFrame, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """Odds with ids, a row from either side's view: the match is found by both teams, so rows don't multiply."""
    own = with_teams(source, mapping, "home_team", "away_team").drop("home_team", "away_team")
    reg = registry.select("match_id", F.col("match_date").alias("date"), "league_source", "season", F.col("home_team_id").alias("team_id"), F.col("away_team_id").alias("opponent_id"))
    found = own.join(reg, ["date", "league_source", "season", "team_id", "opponent_id"], "left")
    swap = {"team_id": "opponent_id", "opponent_id": "team_id"}
    return found.unionByName(found.select(*(F.col(swap.get(c, c)).alias(c) for c in found.columns)))


def expected_goals_schedule(source: DataFrame, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    own = with_teams(source, mapping, "home_team", "away_team").drop("home_team", "away_team", "raw_home_team", "raw_away_team").withColumnRenamed("match_id", "us_match_id")
    reg = registry.select("match_id", "league_source", "season", F.col("home_team_id").alias("team_id"), F.col("away_team_id").alias("opponent_id"))
    return own.join(reg, ["league_source", "season", "team_id", "opponent_id"], "left")


def expected_goals_stats(source: DataFrame, schedule: DataFrame) -> DataFrame:
    return source.withColumnRenamed("match_id", "us_match_id").join(schedule.select("us_match_id", "match_id"), "us_match_id", "left")


def match_index(source: DataFrame, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """Provider match ids beside registry ids; team_id is the home side, opponent_id the away side."""
    own = with_teams(source.withColumnsRenamed({"home_team_id": "ws_home_team_id", "away_team_id": "ws_away_team_id"}), mapping, "home_team_name", "away_team_name")
    reg = registry.select("match_id", "match_date", "league_source", "season", F.col("home_team_id").alias("team_id"), F.col("away_team_id").alias("opponent_id"))
    return own.join(reg, ["match_date", "league_source", "season", "team_id", "opponent_id"], "left")


def translated(df: DataFrame, index: DataFrame) -> DataFrame:
    """Provider match and team ids to canonical ones; a team of neither side gets a null."""
    i = index.select("ws_match_id", "match_id", F.col("ws_home_team_id").alias("__h"), F.col("ws_away_team_id").alias("__a"), F.col("team_id").alias("__home"), F.col("opponent_id").alias("__away"))
    rest = [c for c in df.columns if c not in ("ws_match_id", "team_id", "match_id")]
    team = F.when(F.col("team_id") == F.col("__h"), F.col("__home")).when(F.col("team_id") == F.col("__a"), F.col("__away"))
    return df.drop("match_id").join(i, "ws_match_id", "left").select("match_id", team.alias("team_id"), *rest)


def team_season(source: DataFrame, mapping: DataFrame) -> DataFrame:
    return source.join(teams(mapping).withColumnRenamed("club_name", "team"), "team", "left")


def player_match(source: DataFrame, index: DataFrame) -> DataFrame:
    """Each counter is the sum of its minute series, 0 if it is missing."""
    stats = F.from_json("stats_json", "map<string,map<string,double>>")
    own = source.withColumn("__s", stats)
    return translated(own.select(*source.columns, *(series_sum(F.col("__s")[c]).alias(snake(c)) for c in COUNTERS)), index)


def players(matches: DataFrame, index: DataFrame, names: DataFrame) -> DataFrame:
    seasons = index.where("match_id is not null").select("match_id", "season").distinct()
    own = matches.where("match_id is not null and team_id is not null").join(seasons, "match_id").join(names.select("player_id", "player_name"), "player_id", "left")
    return own.groupBy("player_id", "season", "team_id").agg(F.max("player_name").alias("player_name"), F.max("height").alias("height"), F.max("weight").alias("weight"), F.count("*").alias("n_matchs"))


def lineup(formations: DataFrame, index: DataFrame) -> DataFrame:
    """A row for each starter of each formation period. Positions are looked up by the slot's number, so a hole moves nobody."""
    own = formations.select(
        "ws_match_id", "team_id", "formation_seq", "formation_id", "period", "start_minute", "end_minute", "captain_player_id",
        F.from_json("formation_positions", "array<struct<vertical:double,horizontal:double>>").alias("pos"),
        F.explode(F.arrays_zip(F.from_json("player_ids", "array<bigint>").alias("p"), F.from_json("formation_slots", "array<int>").alias("s"))).alias("z"),
    )
    own = own.select("*", F.col("z")["p"].alias("player_id"), F.col("z")["s"].alias("slot")).where("slot > 0")
    place = F.get("pos", F.col("slot") - 1)
    flat = own.select(
        "ws_match_id", "team_id", "formation_seq", "formation_id", "period", "start_minute", "end_minute", "player_id", "slot",
        place["vertical"].alias("grid_vertical"), place["horizontal"].alias("grid_horizontal"), (F.col("player_id") == F.col("captain_player_id")).alias("is_captain"),
    )
    return translated(flat, index)


def lineup_summary(lineup: DataFrame) -> DataFrame:
    """Positions weighted by minutes; of slots held equally long the smallest is the main one."""
    own = lineup.withColumn("dur", F.greatest(F.coalesce("end_minute", F.lit(90)) - F.coalesce("start_minute", F.lit(0)), F.lit(0)))
    mean = lambda c: (F.sum(F.col(c) * F.col("dur")) / F.nullif(F.sum("dur"), F.lit(0)))
    return own.groupBy("match_id", "team_id", "player_id").agg(
        mean("grid_vertical").alias("avg_vertical"), mean("grid_horizontal").alias("avg_horizontal"), F.max_by("slot", F.struct("dur", -F.col("slot"))).alias("primary_slot"),
        F.bool_or("is_captain").alias("is_captain"), F.count("*").alias("n_formation_periods"),
    )


def registry_key(date, home, away, league, season):
    return F.sha1(F.concat_ws("|", date.cast("string"), home.cast("string"), away.cast("string"), league, season))
