"""SQL of the composed models on the match log, for DuckDB: each stage is a common table expression that later ones read."""

from __future__ import annotations

from gritstone.plans.match_log import QUALIFIERS, TYPES

_PICK = "[{}][({}) % {} + 1]"
_KIND = _PICK.format(", ".join(map(str, TYPES)), "event_id * 13", len(TYPES))
_QUAL = _PICK.format(", ".join(map(str, QUALIFIERS)), "event_id * 5", len(QUALIFIERS))
_M = "partition by match_id order by row_num"

STAGES = {
    "raw": f"""select *, 'm' || user_id as match_id, event_id % 2 + 1 as team_id, row_number() over w as row_num, {_KIND} as type_id, {_QUAL} as q, lead(event_id) over w as later, lag(event_id) over w as earlier
        from events window w as (partition by user_id order by ts, event_id)""",
    "ev": """select match_id, team_id, team_id * 100 + (event_id * 7) % 11 as player_id, event_id, row_num, row_num as expanded_minute, event_id % 60 as second, type_id, 't' || type_id as type_name, q, later, earlier,
        case when event_id % 3 = 0 then 0 else 1 end as outcome_id, type_id in (13, 14, 15, 16) as is_shot, event_id % 4 <> 0 as is_touch, (event_id * 31) % 1000 / 10.0::double as x, (event_id * 17) % 1000 / 10.0::double as y,
        (event_id * 37) % 1000 / 10.0::double as end_x, (event_id * 41) % 1000 / 10.0::double as end_y, case when type_id = 17 then 'Yellow' end as card_type, case when type_id in (15, 16) then team_id * 100 + (event_id * 3) % 11 end as related_player_id,
        45 + (event_id * 7) % 100 / 10.0::double as goal_mouth_y, (event_id * 11) % 380 / 10.0::double as goal_mouth_z, date '2020-01-01' + user_id::integer as match_date, 'L' || (user_id % 3) as league_source, '2020-2021' as season from raw""",
    "qu": """select *, q as qual_type_id, case q when 233 then later when 55 then earlier else event_id + 1 end as qual_value from ev
        union all select *, 233, later from ev where type_id in (4, 7, 44, 45, 50) and q <> 233""",
    "sc": f"""select *, sum(case when type_id = 16 and outcome_id = 1 then 1 else 0 end) over (partition by match_id, team_id order by row_num) as team_score,
        sum(case when type_id = 16 and outcome_id = 1 then 1 else 0 end) over ({_M}) as goals from ev""",
    "en": """select *, goals - team_score as opp_score, q = 233 or type_id in (4, 7, 44, 45, 50) as has_opposite_event from sc""",
    "ch0": """select *, case when type_id in (1, 2, 3, 8, 11, 13, 14, 15, 16, 42, 49, 50, 52, 54, 59, 61) then team_id end as cp from en where type_id not in (17, 18, 19, 30, 32, 34, 40)""",
    "ch1": f"""select *, last_value(cp ignore nulls) over ({_M} rows between unbounded preceding and 1 preceding) as known, first_value(cp ignore nulls) over ({_M} rows between 1 following and unbounded following) as coming from ch0""",
    "ch2": f"""select *, lag((type_id = 12 and coalesce(coming = team_id, false)) or (type_id = 41 and outcome_id = 1) or (type_id = 4 and outcome_id = 1)) over ({_M}) as after_end from ch1""",
    "ch3": f"""select *, sum(case when q in (5, 6, 107, 124, 241) or coalesce(after_end, false) or (cp is not null and cp is distinct from known) then 1 else 0 end) over ({_M}) as grp from ch2""",
    "ch4": """select *, max(cp) over (partition by match_id, grp order by row_num) as chain_team_id, first_value(type_id) over (partition by match_id, grp order by row_num) as type1, first_value(q) over (partition by match_id, grp order by row_num) as q1 from ch3""",
    "ch5": f"""select *, case when type1 in (7, 8, 49) then 'recovery' when q1 = 6 then 'corner' when q1 = 124 then 'goal_kick' when q1 = 107 then 'throw_in' when q1 = 5 then 'free_kick' else 'open_play' end as chain_trigger,
        case when row_number() over ({_M}) = 1 then 0 when lead(chain_team_id) over ({_M}) is distinct from chain_team_id then 1 else 0 end as is_rupture from ch4""",
    "ch": """select a.*, case when a.type_id = 44 then least(a.grp, b.grp) else a.grp end as chain_number, a.match_id || '_' || (case when a.type_id = 44 then least(a.grp, b.grp) else a.grp end) as chain_id
        from ch5 a left join ch5 b on a.match_id = b.match_id and a.later = b.event_id and a.team_id <> b.team_id""",
    "pa0": """select *, lead(player_id) over (partition by match_id, chain_id order by row_num) as receiver_id from ch where team_id = chain_team_id""",
    "pa": """select *, player_id as passer_id, end_x > x + 10 as is_progressive, q in (11113, 210) as is_creative, x < 50 as is_buildup from pa0 where type_id = 1 and outcome_id = 1 and receiver_id <> player_id""",
    "ed": """select match_id, team_id, passer_id, receiver_id, season, league_source, count(*) as n, count_if(is_progressive) as prog, count_if(is_creative) as crea from pa group by all""",
    "deg": """select match_id, team_id, passer_id as player_id, season, league_source, count(distinct receiver_id) as degree_out, sum(n)::bigint as weighted_degree_out, sum(crea)::bigint as n_creative_out, sum(prog)::bigint as n_progressive_out from ed group by all""",
    "deg_in": """select match_id, team_id, receiver_id as player_id, count(distinct passer_id) as i, sum(n)::bigint as wi from ed group by all""",
    "ce": """select a.*, coalesce(i, 0) as degree_in, coalesce(wi, 0) as weighted_degree_in, round(weighted_degree_out / nullif(sum(weighted_degree_out) over t, 0), 4) as pass_share, round(n_creative_out / nullif(weighted_degree_out, 0), 4) as creative_rate,
        round(degree_out * coalesce(i, 0) / nullif(count(*) over t * (count(*) over t - 1), 0), 4) as betweenness_proxy from deg a left join deg_in using (match_id, team_id, player_id) window t as (partition by match_id, team_id)""",
    "va": """select *, case when type_id = 16 then 1.0 when q = 170 then 0.9 when q = 11113 then 0.65 when q = 210 then 0.55 when type_id = 15 then 0.4 when type_id in (13, 14) then 0.1 when type_id = 3 and outcome_id = 1 then 0.3
        when type_id = 42 then 0.25 when type_id = 3 then 0.05 else 0.0 end::double as xg_proxy from en""",
    "ax": """select *, case when type_id in (1, 3, 13, 14, 15, 16, 42) then x / 100 when type_id in (7, 8, 12, 45, 49, 74) or (type_id in (44, 4, 50) and q = 285) then (100 - x) / 100 when type_id in (44, 4, 50) and q = 286 then x / 100 end as danger,
        case when type_id in (7, 8, 12, 49, 74) and outcome_id = 1 then 1.0 when type_id = 45 then 0.6 when type_id in (7, 8, 12, 49, 74) then 0.3 when type_id in (44, 4, 50) and q = 285 and outcome_id = 1 then 1.0 when type_id in (44, 4, 50) and q = 285 then 0.3 end::double as exec,
        0.5 + 0.3 * (case when type_id in (44, 4, 45, 50, 7) then least(1.0, 0.8 + deep) when has_opposite_event then least(1.0, 0.6 + deep) else deep end) + 0.2 * (case when row_num >= 75 and team_score < opp_score then 1.0 when row_num >= 75 and team_score > opp_score then 0.85
        when row_num >= 75 and team_score > 0 then 0.75 when row_num >= 75 then 0.6 when team_score < opp_score then 0.7 when team_score = opp_score and team_score > 0 then 0.5 when team_score > opp_score then 0.4 else 0.3 end::double) as weight
        from (select *, case when x < 50 then 0.2 else 0.0 end::double as deep from va)""",
    "av": """select match_id, row_num, case when type_id in (1, 3, 13, 14, 15, 16, 42) or (type_id in (44, 4, 50) and q = 286 and q <> 285) then sqrt(danger * xg_proxy) * weight
        when type_id in (7, 8, 12, 45, 49, 74) or (type_id in (44, 4, 50) and q = 285) then danger * exec * weight end as action_value from ax""",
    "ow": """select ch.*, av.action_value, first_value(case when cp is not null then x end ignore nulls) over (partition by match_id order by row_num rows between 1 following and unbounded following) as coming_x from ch left join av using (match_id, row_num)""",
    "da": """select match_id, chain_id, last_shot, sum(action_value) as chain_danger_total, case when last_shot is not null then sum(case when row_num < last_shot then action_value end) / nullif(sum(action_value), 0) end as chain_danger_momentum,
        max(case when row_num = last_shot then type_id end) as shot_type, max(case when row_num = last_shot then case q when 15 then 'head' when 20 then 'right_foot' when 72 then 'left_foot' when 21 then 'other' end end) as shot_body_part
        from (select *, max(case when is_shot then row_num end) over (partition by match_id, chain_id) as last_shot from ow where team_id = chain_team_id) group by 1, 2, 3""",
    "cl": """select match_id, chain_id, player_id as clearance_player_id, case when q in (15, 21) then q = 15 end as is_headed_clearance,
        case when coming = team_id then 'perfect' when coming is not null then case when coming_x >= 83 then 'failed' when coming_x >= 75 then 'poor' else 'good' end end as clearance_quality
        from ow where type_id = 12 and team_id <> chain_team_id qualify row_number() over (partition by match_id, chain_id order by row_num) = 1""",
    "co": """select f.match_id, f.chain_team_id as team_id, f.player_id as corner_taker_id, f.row_num as corner_row_num, f.expanded_minute, case when f.y < 50 then 'right' else 'left' end as corner_side,
        case when f.end_x < 83 then 'short' when f.end_y between 45 and 55 then 'center' when (f.y < 50 and f.end_y < 45) or (f.y >= 50 and f.end_y > 55) then 'near_post' else 'far_post' end as landing_zone, n_aerial_duels, shot_body_part,
        clearance_player_id, clearance_quality, is_headed_clearance, case when shot_type = 16 then 'goal' when shot_type = 15 then 'shot_saved' when shot_type in (13, 14) then 'shot_off_target' when cleared then 'clearance' else 'retained' end as outcome,
        chain_danger_total, chain_danger_momentum
        from (select * from ow where chain_trigger = 'corner' qualify row_number() over (partition by match_id, chain_id order by row_num) = 1) f
        join (select match_id, chain_id, count_if(type_id = 44) as n_aerial_duels, bool_or(type_id = 12) as cleared from ow group by 1, 2) n using (match_id, chain_id) left join da using (match_id, chain_id) left join cl using (match_id, chain_id)""",
    "fk": """select b.*, x * 1.05 as x_m, y * 0.68 as y_m, chain_danger_total, chain_danger_momentum, null as shot_body_part, null as clearance_player_id, null as is_headed_clearance, null as clearance_quality,
        sqrt(pow(105 - x * 1.05, 2) + pow(34 - y * 0.68, 2)) as distance_to_goal, acos(greatest(-1.0, least(1.0, (pow(105 - x * 1.05, 2) + (30.34 - y * 0.68) * (37.66 - y * 0.68)) / nullif(sqrt(pow(105 - x * 1.05, 2) + pow(30.34 - y * 0.68, 2))
        * sqrt(pow(105 - x * 1.05, 2) + pow(37.66 - y * 0.68, 2)), 0)))) as angle from (
        select match_id, chain_id, chain_number, chain_team_id, player_id as freekick_taker_id, row_num, event_id, expanded_minute, second, type_id, outcome_id, x, y, 'direct' as fk_type, false as is_offside, 'direct_shot' as fk_zone_type,
        case type_id when 16 then 'goal' when 15 then 'shot_saved' else 'shot_off_target' end as outcome from ow where chain_trigger = 'free_kick' and is_shot and q = 26
        union all select o.match_id, o.chain_id, chain_number, chain_team_id, player_id, row_num, event_id, expanded_minute, second, type_id, outcome_id, x, y, 'short_pass', type_id = 2, case when x < 17 then 'own_box' else 'too_far' end,
        case when type_id = 2 then 'offside' when shot = 16 then 'goal' when shot = 15 then 'shot_saved' when shot in (13, 14) then 'shot_off_target' when last_ok = 1 and last_type = 4 then 'foul_won' when last_ok = 1 and last_type = 6 then 'corner_won'
        when last_ok = 1 and last_type in (1, 3, 61) then 'open_play' else 'turnover' end from ow o
        left join (select match_id, chain_id, arg_max(type_id, row_num) filter (is_shot) as shot, arg_max(type_id, row_num) as last_type, arg_max(outcome_id, row_num) as last_ok from ch where team_id = chain_team_id group by 1, 2) l on l.match_id = o.match_id and l.chain_id = o.chain_id
        where chain_trigger = 'free_kick' and type_id in (1, 2) and q = 5) b left join da using (match_id, chain_id)""",
    "bb": """select distinct match_id, s.t as team_id, 3 - s.t as opponent_id, match_date as date, season, league_source from ev, (values (1), (2)) s(t)""",
    "sh": """select match_id, chain_id, chain_number, chain_team_id, season, league_source, player_id as shooter, event_id as shot_event_id, expanded_minute as shot_minute, type_id as shot_type_id, xg_proxy, earlier as assist_event, q as shot_q
        from ch join (select match_id, row_num, xg_proxy from va) using (match_id, row_num) where is_shot and team_id = chain_team_id qualify row_number() over (partition by match_id, chain_id order by row_num desc) = 1""",
    "xg": """select p.*, s.* exclude (match_id, chain_id, shooter, assist_event, shot_q), a.player_id as assister, p.player_id = shooter as is_shooter, coalesce(p.player_id = a.player_id, false) as is_assister, c.chain_id is not null as is_counter_attack,
        xg_proxy as xgchain, round(xg_proxy * position_weight, 4) as xgchain_weighted, case when not is_shooter and not is_assister then xg_proxy end as xgbuildup, case when not is_shooter and not is_assister then round(xg_proxy * position_weight, 4) end as xgbuildup_weighted
        from (select match_id, chain_id, player_id, pos as position_in_chain, len as chain_length, round(pos / len, 4) as position_weight from (select *, row_number() over (partition by match_id, chain_id order by row_num) as pos, count(*) over (partition by match_id, chain_id) as len
        from ch where team_id = chain_team_id) qualify row_number() over (partition by match_id, chain_id, player_id order by pos desc) = 1) p join sh s using (match_id, chain_id)
        left join ch a on a.match_id = s.match_id and a.chain_id = s.chain_id and a.event_id = s.assist_event and s.shot_q = 55
        left join (select distinct match_id, chain_id from ch where is_shot and q = 23) c on c.match_id = s.match_id and c.chain_id = s.chain_id""",
    "th": """select p.*, s.chain_number, s.chain_team_id, s.xg_proxy, s.season, s.league_source, s.shot_event_id, s.shot_q = 9 as is_penalty, s.xg_proxy as threat_conceded,
        case when is_keeper and (s.shot_q = 9 or not has_error_leading_to_goal) then 0.0 else round(s.xg_proxy * position_weight, 4) end as threat_conceded_weighted
        from (select match_id, chain_id, player_id, team_id, pos as position_in_chain, len as chain_length, round(pos / len, 4) as position_weight, bool_or(type_id in (10, 11, 41, 52)) over pl as is_keeper, bool_or(type_id = 51 and q = 170) over pl as has_error_leading_to_goal
        from (select *, row_number() over (partition by match_id, chain_id order by row_num) as pos, count(*) over (partition by match_id, chain_id) as len from ch join (select match_id, chain_id from sh) using (match_id, chain_id) where team_id <> chain_team_id)
        window pl as (partition by match_id, chain_id, player_id) qualify row_number() over (partition by match_id, chain_id, player_id order by pos desc) = 1) p join sh s using (match_id, chain_id)""",
}
_ORDER = list(STAGES)
#: What each stage reads.
_READS = {
    "ev": "raw", "qu": "ev", "sc": "ev", "en": "sc", "ch0": "en", "ch1": "ch0", "ch2": "ch1", "ch3": "ch2", "ch4": "ch3", "ch5": "ch4", "ch": "ch5", "pa0": "ch", "pa": "pa0", "ed": "pa", "deg": "ed", "deg_in": "ed", "ce": "deg deg_in", "va": "en",
    "sh": "ch va", "xg": "ch sh", "th": "ch sh", "ax": "va", "av": "ax", "ow": "ch av", "da": "ow", "cl": "ow", "co": "ow da cl", "fk": "ow da ch", "bb": "ev",
}


def on(stages: str, body: str) -> str:
    """The body after the named stages and all that they read."""
    need, todo = set(), stages.split()
    while todo:
        s = todo.pop()
        need.add(s)
        todo += _READS.get(s, "").split()
    return "with " + ",\n".join(f"{s} as materialized ({STAGES[s]})" for s in _ORDER if s in need) + "\n" + body


_TYPES = {"string": "varchar", "int": "integer", "bigint": "bigint", "double": "double", "boolean": "boolean", "date": "date"}


def typed(stages: str, columns: str, body: str) -> str:
    """As ``on``, with the columns (names and Spark's types) cast from the body's."""
    casts = ", ".join(f"{c}::{_TYPES[k]} as {c}" for c, k in (x.split() for x in columns.split(",")))
    return on(stages, f"select {casts} from ({body})")


def _r(e: str, places: int | None) -> str:
    return e if places is None else f"round({e}, {places})"


def cells(condition: str, prefix: str = "", places: int | None = 5) -> list[str]:
    return [
        _r(f"avg(case when {condition} and x >= {20 * i} and x < {20 * i + 20} and y >= {20 * j} and y < {20 * j + 20} then 1.0 else 0.0 end)", places) + f" as {prefix}pct_z{i + 1}_c{j + 1}" for i in range(5) for j in range(5)
    ]


_ACTIONS = {
    "n_shots": "is_shot", "n_shots_regular_play": "is_shot and q = 22", "n_shots_individual_play": "is_shot and q = 215", "n_shot_assists": "q = 210", "n_key_passes": "q = 11113", "n_longballs": "type_id = 1 and q = 1", "n_crosses": "type_id = 1 and q = 2",
    "n_throughballs": "type_id = 1 and q = 4", "n_progressive_passes": "type_id = 1 and outcome_id = 1 and end_x > x + 10", "n_tackles": "type_id = 7", "n_tackles_won": "type_id = 7 and outcome_id = 1", "n_interceptions": "type_id = 8",
    "n_ball_recoveries": "type_id = 49", "n_challenges": "type_id = 45", "n_clearances": "type_id = 12", "n_touches": "is_touch and q not in (178, 179)", "n_aerial_duels": "type_id = 44", "n_aerial_won": "type_id = 44 and outcome_id = 1",
    "n_aerial_offensive": "type_id = 44 and q = 286", "n_aerial_defensive": "type_id = 44 and q = 285", "n_errors_lead_to_goal": "type_id = 51 and q = 170", "n_errors_lead_to_shot": "type_id = 51 and q = 169",
    "n_yellow_cards": "card_type = 'Yellow'", "n_second_yellows": "card_type = 'SecondYellow'", "n_red_cards": "card_type = 'Red'",
}
_STATES = {"blank": "a = 0 and b = 0", "drawing": "a = b and a > 0", "winning": "a > b", "losing": "a < b"}


def _player_stats(places: int | None) -> str:
    cols = ["count(*) as n_actions"] + [f"count_if(coalesce({c}, false))::bigint as {n}" for n, c in _ACTIONS.items()] + cells("is_touch", "", places)
    shots = "coalesce(avg(case when is_shot then {} end), 0)"
    cols += [
        _r(f"case when count_if(is_shot) > 0 then count_if(is_shot) / (1 + sqrt(pow(100 - {shots.format('x')}, 2) + pow(50 - {shots.format('y')}, 2))) else 0.0 end", places) + " as xg_contribution",
        _r("avg(case when type_id in (7, 8, 12, 45, 49) then x end)", places) + " as defensive_zone_x", _r("count_if(type_id = 44 and outcome_id = 1) / nullif(count_if(type_id = 44), 0)", places) + " as aerial_win_rate",
    ]
    for s, c in _STATES.items():
        for late, name in (("not late", s), ("late", f"{s}_late")):
            at = f"({c}) and {late}"
            for n, p in (("actions", "true"), ("progressive_passes", _ACTIONS["n_progressive_passes"]), ("defensive_actions", "type_id in (7, 8, 12, 45, 49)"), ("shots", "is_shot")):
                cols.append(f"count_if({at} and {p})::bigint as n_{n}_{name}")
            cols += cells(f"{at} and is_touch", f"{name}_", places)
    return f"""select s.*, coalesce(n_assists, 0)::bigint as n_assists, coalesce(n_chances_created, 0) as n_chances_created from (select match_id, team_id::integer as team_id, player_id::integer as player_id, match_date as date, season, league_source, '2021-01-01T00:00:00' as scraped_at, {', '.join(cols)}
        from (select *, team_score as a, opp_score as b, expanded_minute >= 75 as late from en) group by match_id, team_id, player_id, match_date, season, league_source) s
        left join (select match_id, team_id, related_player_id::integer as player_id, count_if(type_id = 16 and outcome_id = 1) as n_assists, count(*) as n_chances_created from ev where related_player_id is not null and is_shot group by 1, 2, 3) using (match_id, team_id, player_id)"""


def player_match_stats() -> str:
    return on("en", _player_stats(5))


def features_players() -> str:
    centre = lambda axis: " + ".join(f"coalesce(pct_z{i + 1}_c{j + 1}, 0) * {20 * (j if axis else i) + 10}" for i in range(5) for j in range(5))
    names = {
        "xg_chain": "coalesce(xg_chain, 0)", "xg_contribution": "xg_contribution", "progressive_passes": "n_progressive_passes", "key_passes": "n_key_passes", "shots": "n_shots", "pass_share": "pass_share", "betweenness": "betweenness_proxy",
        "creative_rate": "creative_rate", "aerial_win_rate": "aerial_win_rate", "tackle_win_rate": "n_tackles_won / nullif(n_tackles, 0)", "defensive_actions": "n_tackles_won + n_interceptions + n_clearances + n_ball_recoveries",
        "clearances": "n_clearances", "zone_x": centre(0), "zone_y": centre(1), "touches": "n_touches",
    }
    cols = ", ".join(f"avg({e}) over w as avg_{n}_5" for n, e in names.items())
    body = f"""with st as ({_player_stats(None)}), ch_ as (select match_id, chain_team_id as team_id, player_id, sum(xgchain) as xg_chain from xg group by 1, 2, 3)
        select match_id, team_id, player_id, date, season, league_source, {cols}, count(*) over w as n_matchs_window from (select st.*, pass_share, betweenness_proxy, creative_rate, xg_chain from st
        left join ce using (match_id, team_id, player_id) left join ch_ using (match_id, team_id, player_id)) window w as (partition by player_id, season order by date, match_id rows between 5 preceding and 1 preceding)"""
    columns = "match_id string, team_id int, player_id int, date date, season string, league_source string, " + ", ".join(f"avg_{n}_5 double" for n in names) + ", n_matchs_window bigint"
    return rounded("en ce xg", columns, body, 6)


def features_whoscored() -> str:
    names, style = _team_style()
    squad = "squad_avg_form_5 squad_xg_quality_5 squad_regularity squad_top3_share".split()
    body = f"""with st as ({_player_stats(None)}), ws as (select s.*, date, season, league_source from ({style}) s join bb using (match_id, team_id)), sq as (
        select match_id, team_id, date, season, league_source, avg(case when n >= 1 then a end) as squad_avg_form_5, avg(case when n >= 1 then x_ end) as squad_xg_quality_5, count_if(r > 0) / count(*) as squad_regularity,
        sum(case when k <= 3 then n_actions end) / nullif(sum(n_actions), 0) as squad_top3_share from (select *, avg(n_actions) over p as a, avg(xg_contribution) over p as x_, count(*) over p as n, count(*) over r_ as r,
        row_number() over (partition by match_id, team_id order by n_actions desc, player_id) as k from st window p as (partition by player_id, league_source order by date range between interval 180 days preceding and interval 1 day preceding),
        r_ as (partition by player_id, team_id, league_source order by date range between interval 14 days preceding and interval 1 day preceding)) group by 1, 2, 3, 4, 5)
        select bb.match_id, bb.team_id, bb.date, bb.season, bb.league_source, {', '.join(f'ws.ws_{n}' for n in names)}, {', '.join(f'sq.{n}' for n in squad)}, case when ws.ws_field_tilt_actions is not null then 1 else 0 end as has_ws_events
        from bb asof left join ws on bb.team_id = ws.team_id and bb.league_source = ws.league_source and bb.season = ws.season and bb.date > ws.date
        asof left join sq on bb.team_id = sq.team_id and bb.league_source = sq.league_source and bb.season = sq.season and bb.date > sq.date"""
    columns = "match_id string, team_id int, date date, season string, league_source string, " + ", ".join(f"ws_{n} double" for n in names) + ", " + ", ".join(f"{n} double" for n in squad) + ", has_ws_events int"
    return rounded("en bb", columns, body)




def team_network() -> str:
    return typed(
        "ce pa",
        "match_id string, team_id int, season string, league_source string, n_players bigint, n_edges bigint, top_creator_share double, avg_betweenness double, network_entropy double, network_density double, "
        "centroid_x double, centroid_y double, centroid_x_progressive double, centroid_y_progressive double",
        f"""select * from (select match_id, team_id, season, league_source, count(*) as n_players, sum(degree_out) as n_edges, round(max(pass_share), 4) as top_creator_share, round(avg(betweenness_proxy), 4) as avg_betweenness,
        round(-sum(pass_share * ln(nullif(pass_share, 0))) / nullif(ln(nullif(count(*), 1)), 0), 4) as network_entropy, round(sum(degree_out) / nullif(count(*) * (count(*) - 1), 0), 4) as network_density from ce group by 1, 2, 3, 4)
        left join (select match_id, team_id, {', '.join(f"round((sum({c}::decimal(9, 4)) {w} / count(*) {w})::decimal(18, 6), 2) as centroid_{c}{n}" for n, w in (('', ''), ('_progressive', 'filter (is_progressive)')) for c in 'xy')}
        from pa group by 1, 2) using (match_id, team_id)""",
    )


def duels() -> str:
    return typed(
        "en",
        "match_id string, season string, league_source string, expanded_minute int, second int, duel_type_id int, duel_type string, x double, y double, event_id_a int, team_id_a int, player_id_a int, outcome_a int, event_id_b int, team_id_b int, player_id_b int, outcome_b int",
        """select a.match_id, a.season, a.league_source, a.expanded_minute, a.second, a.type_id as duel_type_id, a.type_name as duel_type, a.x, a.y, a.event_id as event_id_a, a.team_id as team_id_a, a.player_id as player_id_a, a.outcome_id as outcome_a,
        b.event_id as event_id_b, b.team_id as team_id_b, b.player_id as player_id_b, b.outcome_id as outcome_b from en a join en b on a.match_id = b.match_id and a.later = b.event_id and a.team_id <> b.team_id and a.row_num < b.row_num
        where a.type_id in (3, 4, 7, 44, 45, 50) and a.has_opposite_event and b.type_id in (3, 4, 7, 44, 45, 50) and b.has_opposite_event""",
    )


def zone_transitions() -> str:
    zone = "(case when {y} < 33.3 then 'A' when {y} < 66.6 then 'B' else 'C' end || case when {x} >= 80 then '1' when {x} >= 60 then '2' when {x} >= 40 then '3' when {x} >= 20 then '4' else '5' end)"
    return typed(
        "pa en",
        "match_id string, team_id int, player_id int, period int, score_state string, formation string, season string, league_source string, zone_from string, zone_to string, n_transitions bigint, progressive_rate double, pct_transitions double",
        f"""select *, round(n_transitions / sum(n_transitions) over (partition by match_id, team_id, player_id, score_state), 4) as pct_transitions from (
        select match_id, team_id, player_id, 1 as period, case when team_score > opp_score then 'winning' when team_score < opp_score then 'losing' else 'drawing' end as score_state, null as formation, season, league_source,
        {zone.format(x='x', y='y')} as zone_from, {zone.format(x='end_x', y='end_y')} as zone_to, count(*) as n_transitions, round(avg(case when end_x > x + 10 then 1 else 0 end), 4) as progressive_rate from (
        select match_id, team_id, player_id, season, league_source, team_score, opp_score, x, y, end_x, end_y from pa
        union all select match_id, team_id, player_id, season, league_source, team_score, opp_score, x, y, nx, ny from (select *, lead(x) over p as nx, lead(y) over p as ny from en where type_id = 3 and outcome_id = 1 window p as (partition by match_id, player_id order by row_num)) where nx is not null)
        group by all)""",
    )


def shot_placement() -> str:
    corner = "sqrt(pow(({}) / 9.6, 2) + pow(1 - goal_mouth_z / 38.0, 2))"
    return typed(
        "va",
        "match_id string, row_num int, placement_zone string, offset_center double, corner_dist double, pre_shot_xg_proxy double",
        f"""select match_id, row_num, case when on_ then case when goal_mouth_z < 12.7 then 'low' when goal_mouth_z <= 25.3 then 'mid' else 'high' end || '_' || case when goal_mouth_y < 48.4 then 'left' when goal_mouth_y <= 51.6 then 'center' else 'right' end end as placement_zone,
        case when on_ then round(abs(goal_mouth_y - 50), 5) end as offset_center, case when on_ then round(least({corner.format('goal_mouth_y - 45.2')}, {corner.format('54.8 - goal_mouth_y')}), 5) end as corner_dist, round(xg_proxy, 5) as pre_shot_xg_proxy
        from (select *, type_id in (15, 16) as on_ from va where is_shot)""",
    )


_CORNER = (
    "match_id string, team_id int, corner_taker_id int, corner_row_num int, expanded_minute int, corner_side string, landing_zone string, n_aerial_duels bigint, shot_body_part string, clearance_player_id int, clearance_quality string, is_headed_clearance boolean, "
    "outcome string, chain_danger_total double, chain_danger_momentum double"
)
_KICK = (
    "match_id string, chain_id string, chain_number bigint, chain_team_id int, freekick_taker_id int, row_num int, event_id int, expanded_minute int, second int, type_id int, outcome_id int, x double, y double, fk_type string, is_offside boolean, fk_zone_type string, "
    "outcome string, chain_danger_total double, chain_danger_momentum double, shot_body_part string, clearance_player_id int, is_headed_clearance boolean, clearance_quality string, x_m double, y_m double, distance_to_goal double, angle double"
)


def rounded(stages: str, columns: str, body: str, places: int = 5) -> str:
    """As ``typed``, with doubles rounded."""
    casts = ", ".join(f"round({c}::double, {places}) as {c}" if k == "double" else f"{c}::{_TYPES[k]} as {c}" for c, k in (x.split() for x in columns.split(",")))
    return on(stages, f"select {casts} from ({body})")


def corner_profiles() -> str:
    return rounded("co", _CORNER, "select * from co")


def freekick_profiles() -> str:
    return rounded("fk", _KICK, "select * from fk")


_COUNTS = """count_if(outcome in ('goal', 'shot_saved', 'shot_off_target')) as n_dangerous, count_if(outcome = 'goal') as n_goals, sum(chain_danger_total) as sum_danger, count_if(shot_body_part = 'head') as n_headed_shots,
    count_if(outcome = 'goal' and shot_body_part = 'head') as n_headed_goals, count(clearance_quality) as n_clearances, count_if(clearance_quality in ('poor', 'failed')) as n_clearances_bad, count_if(is_headed_clearance) as n_clearances_headed,
    count(is_headed_clearance) as n_clearances_bodypart_known"""
_COUNTED = "n_dangerous n_goals sum_danger n_headed_shots n_headed_goals n_clearances n_clearances_bad n_clearances_headed n_clearances_bodypart_known"


def _rolling(stage: str, counts: str, counted: str, sums: dict[str, str], ratios: dict[str, tuple[str, str]]) -> str:
    """Sums and ratios of sums over the 3, 5 and 10 matches before, of both sides' counts; 0 where the match has none."""
    cols = counted.split()
    sides = ", ".join(f"coalesce({a}.{c}, 0) as {c}_{side}" for a, side in (("f", "for"), ("g", "against")) for c in cols)
    frame = "over (partition by team_id, season, league_source order by date, match_id rows between {} preceding and 1 preceding)"
    out = {f"{name}_{n}": f"(sum({c}) {frame.format(n)})::bigint" for n in (3, 5, 10) for name, c in sums.items()}
    out |= {f"{name}_{n}": f"round((sum({a}) {frame.format(n)})::double / nullif(sum({b}) {frame.format(n)}, 0), 5)" for n in (3, 5, 10) for name, (a, b) in ratios.items()}
    body = f"select match_id, team_id::integer as team_id, date, season, league_source, {', '.join(f'{e} as {c}' for c, e in out.items())} from base"
    base = f"select bb.*, {sides} from bb left join cnt f on f.match_id = bb.match_id and f.team_id = bb.team_id left join cnt g on g.match_id = bb.match_id and g.team_id = bb.opponent_id"
    return on(f"{stage} bb", f"select * from (with cnt as ({counts}), base as ({base}) {body})")


def rolling_corners() -> str:
    from gritstone.models.setpieces import _shared

    ratios = _shared("corner", "n_corners") | {f"corner_short_rate_{s}": (f"n_short_{s}", f"n_corners_{s}") for s in ("for", "against")}
    counts = f"select match_id, team_id, count(*) as n_corners, {_COUNTS}, count_if(landing_zone = 'short') as n_short from co group by 1, 2"
    return _rolling("co", counts, f"n_corners {_COUNTED} n_short", {f"corners_{s}": f"n_corners_{s}" for s in ("for", "against")}, ratios)


def rolling_freekicks() -> str:
    from gritstone.models.setpieces import _shared

    ratios = _shared("freekick", "n_freekicks")
    for s in ("for", "against"):
        ratios |= {f"freekick_direct_{m}_avg_{s}": (f"sum_direct_{m}_{s}", f"n_direct_{s}") for m in ("distance", "angle")}
        ratios |= {f"freekick_zone_{z}_rate_{s}": (f"n_zone_{z}_{s}", f"n_total_{s}") for z in ("direct", "crossed")}
    own = f"select match_id, chain_team_id, count(*) as n_freekicks, {_COUNTS}, count(*) as n_direct, sum(distance_to_goal) as sum_direct_distance, sum(angle) as sum_direct_angle from fk where fk_zone_type in ('crossed', 'direct_shot') group by 1, 2"
    zones = "select match_id, chain_team_id, count(*) as n_total, count_if(fk_zone_type = 'direct_shot') as n_zone_direct, 0 as n_zone_crossed from fk group by 1, 2"
    counts = f"select *, chain_team_id as team_id from ({zones}) left join ({own}) using (match_id, chain_team_id)"
    return _rolling("fk", counts, f"n_total n_zone_direct n_zone_crossed n_freekicks {_COUNTED} n_direct sum_direct_distance sum_direct_angle", {f"freekicks_{s}": f"n_freekicks_{s}" for s in ("for", "against")}, ratios)


def _team_style() -> tuple[list[str], str]:
    """The names of the style ratios, and the SQL of all of them."""
    six, box = "x > 94 and y between 36 and 64", "x > 83 and y between 21 and 79"
    lanes = {"left": "y < 33.3", "center": "y >= 33.3 and y <= 66.6", "right": "y > 66.6"}
    back = "type_id in (7, 8, 12)"
    n = {
        "touches": "is_touch", "shots": "is_shot", "passes": "type_id = 1", "high_touch": "is_touch and x > 66", "deep": "type_id = 1 and outcome_id = 1 and end_x > 83", "high_loss": "type_id = 1 and outcome_id = 0 and x > 66",
        "offence": "x > 66 and type_id in (1, 3, 13, 15, 16)", **{f"lane_{a}": f"is_touch and x > 33 and {c}" for a, c in lanes.items()}, "lanes": "is_touch and x > 33", "z_def": "is_touch and x < 33.3",
        "z_mid": "is_touch and x >= 33.3 and x <= 66.6", "z_att": "is_touch and x > 66.6", "s_six": f"is_shot and {six}", "s_pen": f"is_shot and {box} and not ({six})", "s_oob": f"is_shot and not ({box})", "goals": "type_id = 16 and outcome_id = 1",
        "mid": "x between 33 and 66 and type_id in (1, 7, 8) and outcome_id = 1", "d": back, "d_l": f"{back} and y < 30", "d_l_ok": f"{back} and y < 30 and outcome_id = 1", "d_r": f"{back} and y > 70", "d_r_ok": f"{back} and y > 70 and outcome_id = 1",
        "counter": "is_shot and q = 26", "set_": "q in (5, 6) and x > 50", "open": "is_shot and q = 22", "fast": "is_shot and q = 23", "pen": "is_shot and q = 9", "crosses": "type_id = 1 and q = 2", "through": "type_id = 1 and q = 155", "longs": "type_id = 1 and q = 1",
    }
    share = lambda a, b: f"case when {b} > 0 then ({a}) / {b} end"
    out = {
        "field_tilt_actions": share("high_touch", "touches"), "high_turnover_rate": share("high_loss", "passes"), "deep_completion_rt": share("deep", "passes"), "momentum_delta": "momentum_delta", "counter_shot_rate": share("counter", "shots"),
        "set_piece_pressure": share("set_", "offence"), **{f"attack_{a}_pct": share(f"lane_{a}", "lanes") for a in lanes}, **{f"zone_{a}_pct": share(f"z_{a}", "touches") for a in ("def", "mid", "att")}, "shot_six_yard_pct": share("s_six", "shots"),
        "shot_penalty_pct": share("s_pen", "shots"), "shot_oob_pct": share("s_oob", "shots"), "shot_open_play_pct": share("open", "shots"), "shot_set_piece_pct": share("fast", "shots"), "shot_penalty_att_pct": share("pen", "shots"),
        "conversion_rate": share("goals", "shots"), "cross_rate": share("crosses", "passes"), "through_ball_rate": share("through", "passes"), "long_ball_rate": share("longs", "passes"), "short_pass_rate": share("passes - crosses - through - longs", "passes"),
        **{f"def_exposed_{a}_pct": share(f"o_{a}", "o_lanes") for a in lanes}, "counter_attack_dna": "counter_attack_dna", "midfield_control_idx": "mid / nullif(sum(mid) over (partition by match_id), 0)",
        "defensive_line_height": "case when d >= 5 then d_x end", "flank_exposure_asymm": "case when d >= 5 and d_l > 0 and d_r > 0 then d_l_ok / d_l - d_r_ok / d_r end",
    }
    body = f"""with b as (select match_id, team_id, {', '.join(f'count_if({c})::bigint as {a}' for a, c in n.items())}, avg(case when {back} then x end) as d_x from ev group by 1, 2),
        o as (select b.match_id, b.team_id, sum(x.lanes) as o_lanes, {', '.join(f'sum(x.lane_{a}) as o_{a}' for a in lanes)} from b join b x on x.match_id = b.match_id and x.team_id <> b.team_id group by 1, 2),
        m as (select match_id, team_id, avg(post / nullif(pre, 0)) as momentum_delta from (select e.match_id, e.team_id, g.row_num as g, count_if(e.row_num < g.row_num) as pre, count_if(e.row_num > g.row_num) as post from ev e
        join ev g on g.match_id = e.match_id and g.type_id = 16 and g.outcome_id = 1 and g.team_id <> e.team_id and e.row_num between g.row_num - 10 and g.row_num + 10 group by 1, 2, 3) group by 1, 2),
        c as (select match_id, team_id, count(distinct case when won > 0 then at_ end) / count(*) as counter_attack_dna from (select *, sum(case when type_id = 49 then 1 else 0 end) over (partition by match_id, team_id order by at_ range between 15 preceding and 1 preceding) as won
        from (select *, expanded_minute * 60 + second as at_ from ev)) where is_shot group by 1, 2)
        select match_id, team_id, {', '.join(f'{e} as ws_{a}' for a, e in out.items())} from b left join o using (match_id, team_id) left join m using (match_id, team_id) left join c using (match_id, team_id)"""
    return list(out), body


def team_features() -> str:
    names, body = _team_style()
    return rounded("ev", "match_id string, team_id int, " + ", ".join(f"ws_{a} double" for a in names), body)
