"""Nested match archives to flat relations: events, players, formations, teams, match facts and dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMED = "struct<value:int,displayName:string>"
EVENT = (
    f"struct<id:double,eventId:int,minute:int,second:double,expandedMinute:int,period:{NAMED},teamId:int,playerId:int,relatedPlayerId:int,relatedEventId:int,x:double,y:double,endX:double,endY:double,"
    f"type:{NAMED},outcomeType:{NAMED},cardType:{NAMED},isTouch:boolean,isShot:boolean,isGoal:boolean,goalMouthY:double,goalMouthZ:double,qualifiers:array<struct<type:{NAMED},value:string>>>"
)
PLAYER = "struct<playerId:int,shirtNo:int,name:string,position:string,isFirstEleven:boolean,isManOfTheMatch:boolean,height:int,weight:int,age:int,stats:map<string,map<string,double>>>"
FORMATION = "struct<formationId:int,formationName:string,period:int,startMinuteExpanded:int,endMinuteExpanded:int,captainPlayerId:int,playerIds:array<bigint>,formationSlots:array<int>,formationPositions:array<struct<vertical:double,horizontal:double>>>"
SIDE = f"struct<teamId:int,name:string,field:string,managerName:string,countryName:string,averageAge:double,stats:map<string,map<string,double>>,players:array<{PLAYER}>,formations:array<{FORMATION}>>"
MATCH = f"matchId string, events array<{EVENT}>, home {SIDE}, away {SIDE}, playerIdNameDictionary map<string,string>, referee struct<officialId:int,name:string>, venueName string, attendance int, weatherCode string, startTime string, htScore string, ftScore string, etScore string, pkScore string"


def events(matches: DataFrame) -> DataFrame:
    """One row for each event; ``row_num`` is its place in the array."""
    e = matches.select(F.col("matchId").alias("ws_match_id"), F.posexplode("events").alias("row_num", "e"))
    return e.select(
        "ws_match_id", "row_num", F.col("e.eventId").alias("event_id"), "e.minute", F.col("e.second").cast("int").alias("second"), F.col("e.expandedMinute").alias("expanded_minute"),
        F.col("e.period.value").alias("period"), F.col("e.teamId").alias("team_id"), F.col("e.playerId").alias("player_id"), F.col("e.relatedPlayerId").alias("related_player_id"), F.col("e.relatedEventId").alias("related_event_id"),
        "e.x", "e.y", F.col("e.endX").alias("end_x"), F.col("e.endY").alias("end_y"), F.col("e.type.value").alias("type_id"), F.col("e.type.displayName").alias("type_name"),
        F.col("e.outcomeType.value").alias("outcome_id"), F.col("e.outcomeType.displayName").alias("outcome_name"), F.col("e.cardType.displayName").alias("card_type"),
        F.coalesce("e.isTouch", F.lit(False)).alias("is_touch"), F.coalesce("e.isShot", F.lit(False)).alias("is_shot"), F.coalesce("e.isGoal", F.lit(False)).alias("is_goal"),
        F.col("e.goalMouthY").alias("goal_mouth_y"), F.col("e.goalMouthZ").alias("goal_mouth_z"), F.to_json("e.qualifiers").alias("qualifiers_json"),
    )


def sides(matches: DataFrame) -> DataFrame:
    """Two rows a match, home and away."""
    return matches.select(F.col("matchId").alias("ws_match_id"), F.explode(F.array("home", "away")).alias("s"))


def last_minute_value(series: Column) -> Column:
    """The value of the greatest minute of a series; minutes are text keys."""
    return F.try_element_at(series, F.array_max(F.transform(F.map_keys(series), lambda k: k.cast("int"))).cast("string"))


def series_sum(series: Column) -> Column:
    """Sum of a series' values, 0 if it is missing."""
    return F.coalesce(F.aggregate(F.map_values(series), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))), F.lit(0.0))


def player_match(matches: DataFrame) -> DataFrame:
    p = sides(matches).select("ws_match_id", F.col("s.teamId").alias("team_id"), F.explode("s.players").alias("p"))
    return p.select(
        "ws_match_id", "team_id", F.col("p.playerId").alias("player_id"), F.col("p.shirtNo").alias("shirt_no"), "p.position", F.col("p.isFirstEleven").alias("is_first_eleven"), F.col("p.isManOfTheMatch").alias("is_man_of_the_match"),
        "p.height", "p.weight", "p.age", last_minute_value(F.col("p.stats")["ratings"]).alias("rating"), F.to_json("p.stats").alias("stats_json"),
    )


def formations(matches: DataFrame) -> DataFrame:
    f = sides(matches).select("ws_match_id", F.col("s.teamId").alias("team_id"), F.posexplode("s.formations").alias("formation_seq", "f"))
    return f.select(
        "ws_match_id", "team_id", "formation_seq", F.col("f.formationId").alias("formation_id"), "f.period", F.col("f.startMinuteExpanded").alias("start_minute"), F.col("f.endMinuteExpanded").alias("end_minute"),
        F.col("f.captainPlayerId").alias("captain_player_id"), F.to_json("f.playerIds").alias("player_ids"), F.to_json("f.formationSlots").alias("formation_slots"), F.to_json("f.formationPositions").alias("formation_positions"),
    )


def team_match(matches: DataFrame) -> DataFrame:
    return sides(matches).select(
        "ws_match_id", F.col("s.teamId").alias("team_id"), "s.field", F.col("s.managerName").alias("manager_name"), F.col("s.countryName").alias("country_name"), F.col("s.averageAge").alias("average_age"), F.to_json("s.stats").alias("stats_json")
    )


def match_meta(matches: DataFrame) -> DataFrame:
    names = {"venueName": "venue_name", "attendance": "attendance", "weatherCode": "weather_code", "startTime": "kickoff_time", "htScore": "ht_score", "ftScore": "ft_score", "etScore": "et_score", "pkScore": "pk_score"}
    return matches.select(F.col("matchId").alias("ws_match_id"), F.col("referee.officialId").alias("referee_id"), F.col("referee.name").alias("referee_name"), *(F.col(a).alias(b) for a, b in names.items()))


def players_ref(matches: DataFrame, loaded: str = "ws_match_id") -> DataFrame:
    """player_id and player_name; of several names the one loaded last counts."""
    d = matches.select(F.col("matchId").alias("ws_match_id"), F.explode("playerIdNameDictionary").alias("id", "player_name"))
    return d.groupBy(F.col("id").cast("int").alias("player_id")).agg(F.max_by("player_name", F.struct(loaded, "player_name")).alias("player_name"))


def formations_ref(matches: DataFrame) -> DataFrame:
    f = sides(matches).select("ws_match_id", F.explode("s.formations").alias("f"))
    return f.groupBy(F.col("f.formationId").alias("formation_id")).agg(F.max_by("f.formationName", F.struct("ws_match_id", "f.formationName")).alias("formation_name"))


def qualifiers(events: DataFrame, keys: list[str]) -> DataFrame:
    """Entity-attribute-value rows of the qualifiers, by key: qualifier_id, qualifier_name, qualifier_value."""
    q = events.select(*keys, F.explode(F.from_json("qualifiers_json", f"array<struct<type:{NAMED},value:string>>")).alias("q"))
    return q.select(*keys, F.col("q.type.value").alias("qualifier_id"), F.col("q.type.displayName").alias("qualifier_name"), F.col("q.value").alias("qualifier_value"))
