"""Raw tables of the models, derived from the given tables by plain arithmetic: one SQL text each, which both engines read."""

from __future__ import annotations


def _d(by: int, of: int, column: str = "event_id") -> str:
    return f"CAST(floor({column} / {by}) % {of} AS INTEGER)"


def _pick(number: str, values: list[str], rest: str = "NULL") -> str:
    return f"CASE {number} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + f" ELSE {rest} END"


RESULTS = ["Single", "Double", "Triple", "HomeRun", "StrikeOut", "Walk", "IntentionalWalk", "HitByPitch", "SacrificeFly", "SacrificeHit", "ReachedOnError", "FieldersChoice", "InPlayOut", "GroundRuleDouble", "InsideTheParkHomeRun", "Interference"]
ITEMS = ["Ball", "CalledStrike", "SwingingStrike", "Foul", "FoulTip", "InPlay", "StrikeUnknownType", "IntentionalBall", "AutomaticBall", "Unknown", "Pitchout", "PickoffFirst"]
PLAYS = ["StolenBase", "CaughtStealing", "PickedOff", "PickedOffCaughtStealing", "WildPitch", "PassedBall", "Balk", "OtherAdvance", "DefensiveIndifference", "AdvancedOnError"]


def _values(columns: str, rows: list[tuple]) -> str:
    text = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower()
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows) + f") AS t({columns})"


def _result_rows() -> list[tuple]:
    bases = {"Single": 1, "Double": 2, "GroundRuleDouble": 2, "Triple": 3, "HomeRun": 4, "InsideTheParkHomeRun": 4}
    no_at_bat = ("Walk", "IntentionalWalk", "HitByPitch", "SacrificeFly", "SacrificeHit", "Interference")
    on_base = (*bases, "Walk", "IntentionalWalk", "HitByPitch")
    outs = ("StrikeOut", "SacrificeFly", "SacrificeHit", "FieldersChoice", "InPlayOut")
    away = ("StrikeOut", "Walk", "IntentionalWalk", "HitByPitch", "HomeRun", "GroundRuleDouble", "Interference")
    return [(r, r not in no_at_bat, r not in ("SacrificeHit", "Interference"), r in on_base, r in outs, r in bases, r not in away, bases.get(r, 0)) for r in RESULTS]


def _item_rows() -> list[tuple]:
    swings, contact = ("SwingingStrike", "Foul", "FoulTip", "InPlay"), ("Foul", "FoulTip", "InPlay")
    balls = ("Ball", "IntentionalBall", "AutomaticBall", "Pitchout")
    return [(i, i != "PickoffFirst", i in (*swings, "CalledStrike", "StrikeUnknownType"), i == "InPlay", i == "FoulTip", i in swings, i in contact, "Ball" if i in balls else "Unknown" if i == "Unknown" else "Other" if i == "PickoffFirst" else "Strike") for i in ITEMS]


_SIDE = "CASE WHEN event_id % 2 = 0 THEN 'Away' ELSE 'Home' END"
_HOME, _AWAY = "CAST(user_id % 25 AS INTEGER)", "CAST((user_id + 7 + user_id % 2 * 3) % 25 AS INTEGER)"
_FIELDER = _d(13, 11)

RAW = {
    "raw_events": f"""SELECT event_id, ts, user_id, user_id * 1000 + dayofyear(ts) AS game_id, CAST(1915 + user_id % 6 AS INTEGER) AS season, {_SIDE} AS batting_side,
 CASE WHEN event_id % 2 = 0 THEN {_AWAY} ELSE {_HOME} END AS batting_team_id, CASE WHEN event_id % 2 = 0 THEN {_HOME} ELSE {_AWAY} END AS fielding_team_id,
 CAST(floor(hour(ts) / 2) + 1 AS INTEGER) AS inning, {_d(2, 3)} AS outs, {_d(3, 8)} AS base_state, CAST(floor(event_id / 5) % 40 AS BIGINT) AS batter_id, CAST(100 + floor(event_id / 7) % 12 AS BIGINT) AS pitcher_id,
 {_d(5, 9)} + 1 AS batter_lineup_position, {_pick(_d(11, 18), RESULTS)} AS plate_appearance_result, CAST(event_type = 'error' AS INTEGER) AS outs_on_play, CAST(event_type = 'purchase' AS INTEGER) AS runs_on_play,
 CASE WHEN {_FIELDER} = 10 THEN NULL ELSE {_FIELDER} END AS batted_to_fielder, {_pick(_d(17, 6), ["GroundBall", "Fly", "LineDrive", "PopUp", "Unknown"])} AS batted_trajectory, {_pick(_d(19, 5), ["Left", "Middle", "Right", "Unknown"])} AS batted_location_side,
 {_pick(_d(23, 5), ["Plate", "Infield", "Outfield", "Unknown"])} AS batted_location_depth, {_pick(_d(29, 4), ["Short", "Deep", "Unknown"])} AS batted_location_general, {_pick(_d(31, 9), ["L", "R"])} AS specified_batter_hand,
 {_pick(_d(37, 9), ["L"])} AS specified_pitcher_hand, CASE WHEN {_d(41, 5)} = 4 THEN NULL ELSE {_d(41, 5)} END AS count_balls, CASE WHEN {_d(43, 4)} = 3 THEN NULL ELSE {_d(43, 4)} END AS count_strikes,
 CASE WHEN event_id % 31 = 0 THEN event_id % 40 END AS strikeout_responsible_batter_id, CASE WHEN event_id % 29 = 0 THEN 100 + event_id % 12 END AS walk_responsible_pitcher_id,
 CAST(event_type = 'purchase' AS INTEGER) AS runs_batted_in, event_id % 37 = 0 AS no_play_flag FROM {{events}}""",
    "people": "SELECT p_partkey - 1 AS player_id, CASE p_partkey % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'L' ELSE 'R' END AS bats, CASE p_partkey % 7 WHEN 0 THEN 'B' WHEN 1 THEN 'L' WHEN 2 THEN NULL ELSE 'R' END AS throws FROM {part}",
    "seed_plate_appearance_result_types": _values("plate_appearance_result, is_at_bat, is_on_base_opportunity, is_on_base_success, is_batting_out, is_hit, is_in_play, total_bases", _result_rows()),
    "seed_pitch_types": _values("sequence_item, is_pitch, is_strike, is_in_play, can_be_strike_three, is_swing, is_contact, category", _item_rows()),
    "seed_double_play_flag_types": _values("flag, is_double_play, is_triple_play, is_ground_ball_double_play", [("GroundBallDoublePlay", True, False, True), ("LinedIntoDoublePlay", True, False, False), ("TriplePlay", False, True, False)]),
    "seed_game_types": _values("game_type, is_regular_season, is_postseason", [("RegularSeason", True, False), ("Postseason", False, True)]),
    "seed_scorer_lookup": _values("scorer, normalized_scorer", [("Abc ", "alpha"), ("zed", "omega")]),
    "seed_result_categories": _values("plate_appearance_result, result_category", [*((r, "Hit") for r in RESULTS[:3]), ("HomeRun", "HomeRun"), ("InsideTheParkHomeRun", "HomeRun"), ("GroundRuleDouble", "Hit"), ("StrikeOut", "StrikeOut"), ("Walk", "Walk"), ("IntentionalWalk", "Walk"), ("HitByPitch", "Walk"), ("SacrificeFly", "Out"), ("SacrificeHit", "Out"), ("ReachedOnError", "Error"), ("FieldersChoice", "Out"), ("InPlayOut", "InPlayOut")]),
    "seed_baserunning_play_types": _values("baserunning_play_type, priority, result_category_out, result_category_safe", [(n, k // 2, "Error" if k > 6 else "Out", "Steal" if k == 0 else "Error" if k > 6 else "Advance") for k, n in enumerate(PLAYS)]),
    "seed_scorer_numerical_ranges": _values("low, high, group_id", [(100, 149, 1), (150, 399, 2)]),
}
RAW["raw_event_baserunners"] = " UNION ALL ".join(
    f"""SELECT event_id AS event_key, game_id, '{who}' AS baserunner, CAST((floor(event_id / 5) + {r * 3}) % 40 AS BIGINT) AS runner_id,
 CASE WHEN (event_id + {r}) % 4 = 0 THEN NULL ELSE {_pick(f"CAST(least({r + 1} + (event_id + {r}) % 2, 4) AS INTEGER)", ["-", "First", "Second", "Third", "Home"])} END AS attempted_advance_to_base,
 {_pick(f"CAST((floor(event_id / 3) + {r * 5}) % 14 AS INTEGER)", PLAYS)} AS baserunning_play_type, (event_id + {r * 2}) % 5 = 0 AS is_out, CASE WHEN event_id % 7 = 0 THEN true WHEN event_id % 7 = 1 THEN NULL ELSE false END AS advanced_on_error_flag,
 (event_id + {r}) % 3 = 0 AS explicit_out_flag, CASE WHEN event_id % 6 = 0 THEN CAST(100 + floor(event_id / 14) % 12 AS BIGINT) END AS explicit_charged_pitcher_id,
 event_id, CAST(1 + (event_id + {r}) % 9 AS INTEGER) AS runner_lineup_position, CASE WHEN event_id % 5 > 0 AND event_id > {r} THEN event_id - {r} END AS charge_event_id, CASE WHEN event_id > {r + 1} THEN event_id - {r + 1} END AS reached_on_event_id, {_pick(f"CAST((event_id + {r}) % 6 AS INTEGER)", ["First", "Second", "Third", "Home"])} AS base_end,
 (event_id + {r}) % 6 = 3 AS run_scored_flag, (event_id + {r}) % 12 = 3 AS rbi_flag FROM ({RAW["raw_events"]}) e{r} WHERE {where}"""
    for r, (who, where) in enumerate((("Batter", "event_id % 3 <> 1"), ("First", "base_state % 2 = 1"), ("Second", "base_state IN (2, 3, 6, 7)"), ("Third", "base_state > 3")))
)
_KEYED = f"(SELECT event_id, game_id FROM ({RAW['raw_events']}) a) e"


def _up_to(n: int) -> str:
    return "(VALUES " + ", ".join(f"({k})" for k in range(1, n + 1)) + ") AS k(k)"


RAW["raw_event_fielding_plays"] = f"SELECT event_id AS event_key, game_id, k AS sequence_id, CAST((event_id * 7 + k * 3) % 10 AS INTEGER) AS fielding_position, {_pick('CAST((event_id + k) % 4 AS INTEGER)', ['Putout', 'Assist', 'Error', 'FieldersChoice'])} AS fielding_play FROM {_KEYED} CROSS JOIN {_up_to(4)} WHERE k <= event_id % 5"
RAW["raw_event_pitch_sequences"] = f"SELECT event_id AS event_key, k AS sequence_id, {_pick('CAST((event_id * 5 + k * 3) % 12 AS INTEGER)', ITEMS)} AS sequence_item, (event_id + k) % 4 = 0 AS runners_going_flag, (event_id + k) % 9 = 0 AS blocked_by_catcher_flag, CASE WHEN (event_id + k) % 11 = 0 THEN 'First' END AS catcher_pickoff_attempt_at_base FROM {_KEYED} CROSS JOIN {_up_to(6)} WHERE k <= event_id % 7"
RAW["raw_event_flags"] = f"SELECT event_id AS event_key, {_pick('CAST(event_id % 19 AS INTEGER)', ['GroundBallDoublePlay', 'LinedIntoDoublePlay', 'TriplePlay', 'SacrificeFly', 'Foul', 'SacrificeHit'])} AS flag FROM {{events}} WHERE event_id % 19 < 6"
RAW["raw_event_comments"] = "SELECT event_id AS event_key, CASE WHEN event_id % 41 = 0 THEN concat('Forfeit=', CASE event_id % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'V' ELSE 'T' END) WHEN event_id % 43 = 0 THEN concat('Suspend=20240105,', CASE WHEN event_id % 2 = 0 THEN 'PRK' ELSE '' END, ',', CAST(event_id % 8 AS VARCHAR(9)), ',', CAST(event_id % 5 AS VARCHAR(9)), ',', CAST(event_id % 54 AS VARCHAR(9))) WHEN event_id % 5 = 0 THEN 'plain' END AS comment FROM {events} UNION ALL SELECT event_id, 'plain' FROM {events} WHERE event_id % 5 = 0"
_BOX = "o_orderkey + 10000000"
RAW["raw_box_score_comments"] = f"SELECT {_BOX} AS game_id, CASE WHEN o_orderkey % 11 = 0 THEN 'Forfeit=V' WHEN o_orderkey % 13 = 0 THEN 'Suspend=19970203,,1,2,30' ELSE 'fine' END AS comment FROM {{orders}}"
_P = "CAST(100 + (game_id + {0}) % 12 AS BIGINT)"
def _conditions(n: str) -> str:
    """What else a game's record tells, by a number of the game."""
    text = lambda k, of: f"CASE WHEN {n} % {of} > 0 THEN concat('{k}', CAST({n} % {of} AS VARCHAR(9))) END"
    picks = {"time_of_day": (3, ["Day", "Night"]), "field_condition": (5, ["Dry", "Wet", "Damp", "Unknown"]), "precipitation": (4, ["None", "Rain", "Unknown"]), "wind_direction": (6, ["ToLF", "ToRF", "FromCF", "Unknown"]), "scoring_method": (4, ["Tape", "Park", "TV"]), "account_type": (3, ["PlayByPlay", "Deduced"])}
    cast = lambda x, kind: f"CAST({x} AS {kind})"
    out = {"start_time": f"CASE WHEN {n} % 4 > 0 THEN concat(CAST(12 + {n} % 9 AS VARCHAR(9)), ':', CAST(10 + {n} % 50 AS VARCHAR(9))) END"} | {c: _pick(cast(f"{n} % {of}", "INTEGER"), v) for c, (of, v) in picks.items()}
    out |= {"temperature_fahrenheit": f"CASE WHEN {n} % 7 > 0 THEN {cast(f'50 + {n} % 40', 'INTEGER')} END", "wind_speed_mph": f"CASE WHEN {n} % 8 > 0 THEN {cast(f'{n} % 25', 'INTEGER')} END", "game_winning_rbi": f"CASE WHEN {n} % 3 > 0 THEN {cast(f'{n} % 40', 'BIGINT')} END"}
    out |= {"protest_info": text("P", 31), "completion_info": text("C", 29), "inputter": text("i", 5), "translator": text("t", 6), "date_inputted": f"CASE WHEN {n} % 5 > 0 THEN CAST('1990-01-02' AS DATE) END", "date_edited": f"CASE WHEN {n} % 6 > 0 THEN CAST('1991-03-04' AS DATE) END"}
    out |= {f"umpire_{place}_id": f"CASE WHEN {n} % {k} > 0 THEN {cast(f'{n} % {k + 20}', 'BIGINT')} END" for k, place in enumerate(("home", "first", "second", "third", "left", "right"), 2)}
    return ", ".join(f"{e} AS {c}" for c, e in out.items())


RAW["raw_games"] = f"""SELECT *, {_conditions("game_id")}, CAST(game_id % 3 AS BIGINT) AS doubleheader_status, CASE WHEN game_id % 10 = 0 THEN 'Postseason' ELSE 'RegularSeason' END AS game_type, CASE WHEN game_id % 4 <> 0 THEN concat('P', CAST(game_id % 3 AS VARCHAR(9))) END AS park_id,
 (game_id % 5) * 1000 AS attendance, {_pick('CAST(game_id % 7 AS INTEGER)', ['abc', 'both', '123', ' ', 'Xy & Zed', 'teams'])} AS scorer, CASE WHEN game_id % 6 = 0 THEN '1920.EVR' WHEN game_id % 6 = 1 THEN '1920.EBR' ELSE '1950.EVA' END AS filename,
 CASE WHEN game_id % 3 = 0 THEN 'Sunny' END AS sky, game_id % 200 AS duration_minutes, {_P.format(0)} AS winning_pitcher_id, {_P.format(1)} AS losing_pitcher_id, CASE WHEN game_id % 2 = 0 THEN {_P.format(2)} END AS save_pitcher_id, CASE WHEN game_id % 2 = 0 THEN true END AS use_dh, CASE WHEN game_id % 23 = 0 THEN 'Home' ELSE 'Away' END AS bat_first_side
 FROM (SELECT game_id, min(CAST(ts AS DATE)) AS date, min(season) AS season, {_HOME} AS home_team_id, {_AWAY} AS away_team_id FROM ({RAW["raw_events"]}) e GROUP BY game_id, user_id) g"""
RAW["raw_box_games"] = f"""SELECT {_BOX} AS game_id, {_conditions("o_orderkey")}, CAST(o_orderdate AS DATE) AS date, CAST(1918 + o_orderkey % 9 AS INTEGER) AS season, CAST(o_orderkey % 25 AS INTEGER) AS home_team_id, CAST((o_orderkey + 3) % 25 AS INTEGER) AS away_team_id, CAST(0 AS BIGINT) AS doubleheader_status,
 'RegularSeason' AS game_type, CASE WHEN o_orderkey % 3 = 0 THEN concat('B', CAST(o_orderkey % 20 AS VARCHAR(9))) END AS park_id, o_custkey % 3 * 500 AS attendance, 'zed' AS scorer, '1930.EBN' AS filename, CAST(NULL AS VARCHAR(9)) AS sky, o_orderkey % 150 AS duration_minutes,
 CAST(100 + o_orderkey % 12 AS BIGINT) AS winning_pitcher_id, CAST(100 + (o_orderkey + 5) % 12 AS BIGINT) AS losing_pitcher_id, CAST(NULL AS BIGINT) AS save_pitcher_id, false AS use_dh, 'Away' AS bat_first_side FROM {{orders}} WHERE o_orderkey % 2 = 0"""
RAW["raw_gamelog"] = f"""SELECT {_BOX} AS game_id, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 2 AS VARCHAR(9)) AS double_header, CAST(o_orderkey % 25 AS INTEGER) AS home_team_id, CAST((o_orderkey + 3) % 25 AS INTEGER) AS away_team_id, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE concat('L', CAST(o_orderkey % 9 AS VARCHAR(9))) END AS park,
 o_custkey % 7 * 100 AS attendance, CASE WHEN o_orderkey % 17 = 0 THEN 'H' ELSE '' END AS forfeit, CASE WHEN o_orderkey % 20 = 1 THEN 'W' ELSE 'R' END AS kind, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(100 + o_orderkey % 12 AS BIGINT) END AS home_starting_pitcher_id,
 CAST(100 + (o_orderkey + 1) % 12 AS BIGINT) AS away_starting_pitcher_id, o_orderkey % 180 AS duration_minutes, o_orderkey % 11 AS home_runs_scored, o_custkey % 11 AS away_runs_scored, concat('01', CAST(o_orderkey % 10 AS VARCHAR(9)), '(12)0x') AS home_line_score, concat('2', CAST(o_custkey % 10 AS VARCHAR(9)), '000') AS away_line_score FROM {{orders}}"""
_ERA = "SELECT n_nationkey AS team_id, concat('F', CAST(n_nationkey AS VARCHAR(9))) AS franchise_id, CASE n_regionkey WHEN 0 THEN 'AL' WHEN 1 THEN 'NL' WHEN 2 THEN 'FL' ELSE 'XX' END AS league, {0} AS division, n_name AS location, {1} AS nickname, CAST({2} AS DATE) AS date_start, CAST({3} AS DATE) AS date_end FROM {{nation}}"
RAW["seed_franchises"] = _ERA.format("'East'", "'Old'", "'1900-01-01'", "'1997-12-31'") + " UNION ALL " + _ERA.format("'West'", "'New'", "'1998-01-01'", "NULL")
_SPAN = f"(SELECT game_id, min(event_id) AS lo, max(event_id) AS hi, CAST(floor((min(event_id) + max(event_id)) / 2) AS BIGINT) AS mid FROM ({RAW['raw_events']}) e GROUP BY game_id) g CROSS JOIN {{0}} CROSS JOIN (VALUES ('Home', 5), ('Away', 11)) AS s(side, n)"


def _appearances(place: str, most: int, player: str, extra: tuple[str, str] = ("", "")) -> str:
    span = _SPAN.replace("{0}", _up_to(most))
    sub = "(game_id + k + n) % 4 = 0 AND mid > lo"
    return f"SELECT game_id, side, CAST(k AS INTEGER) AS {place}, {player.format(0)} AS player_id, lo AS start_event_id, CASE WHEN {sub} THEN mid - 1 ELSE hi END AS end_event_id{extra[0]} FROM {span} UNION ALL SELECT game_id, side, CAST(k AS INTEGER), {player.format(3)}, mid, hi{extra[1]} FROM {span} WHERE {sub}"


_WHO = "CAST(CASE WHEN k = 1 THEN 100 + (game_id + n + {0}) % 12 ELSE (game_id * 3 + k * 7 + n + {0}) % 40 END AS BIGINT)"
RAW["raw_game_fielding_appearances"] = _appearances("fielding_position", 10, _WHO)
RAW["raw_game_lineup_appearances"] = _appearances("lineup_position", 9, "CAST((game_id * 3 + k * 7 + n + {0}) % 40 AS BIGINT)", (", 'Starter' AS entered_game_as", ", CASE game_id % 3 WHEN 0 THEN 'PinchHitter' WHEN 1 THEN 'PinchRunner' ELSE 'DefensiveSubstitution' END"))
_LINE = "l_orderkey + 10000000 AS game_id, CASE WHEN l_linenumber % 2 = 0 THEN 'Home' ELSE 'Away' END AS side"
_big = lambda e, n: f"CAST({e} AS BIGINT) AS {n}"
RAW["raw_box_batting"] = f"SELECT {_LINE}, {_big('l_partkey % 40', 'batter_id')}, l_linenumber AS lineup_position, CAST(1 + l_suppkey % 2 AS INTEGER) AS nth_player_at_position, {_big('l_quantity', 'at_bats')}, {_big('l_quantity % 9 + 6', 'hits')}, {_big('l_partkey % 3', 'doubles')}, {_big('l_suppkey % 2', 'triples')}, {_big('l_linenumber % 2', 'home_runs')}, CASE WHEN l_partkey % 5 > 0 THEN CAST(l_partkey % 4 AS BIGINT) END AS walks, CASE WHEN l_partkey % 7 > 2 THEN CAST(1 AS BIGINT) END AS hit_by_pitches, {_big('l_partkey % 6', 'runs')}, {_big('l_suppkey % 5', 'strikeouts')} FROM {{lineitem}}"
RAW["raw_box_pitching"] = f"SELECT {_LINE}, {_big('100 + l_partkey % 12', 'pitcher_id')}, l_linenumber AS nth_pitcher, {_big('l_quantity', 'outs_recorded')}, {_big('l_quantity + 5', 'batters_faced')}, {_big('l_partkey % 9', 'hits')}, {_big('l_partkey % 2', 'doubles')}, {_big('l_suppkey % 2', 'triples')}, {_big('l_linenumber % 2', 'home_runs')}, {_big('l_partkey % 5', 'runs')}, {_big('l_partkey % 4', 'earned_runs')}, {_big('l_suppkey % 4', 'walks')}, {_big('l_partkey % 8', 'strikeouts')} FROM {{lineitem}}"
RAW["raw_box_score_fielding_lines"] = f"""SELECT game_id, side, player_id AS fielder_id, fielding_position, 1 AS nth_position_played_by_player, CAST(20 + game_id % 8 AS BIGINT) AS outs_played, CASE WHEN (game_id + fielding_position) % 7 > 0 THEN CAST((game_id + fielding_position) % 4 AS BIGINT) END AS putouts, CAST(fielding_position % 3 AS BIGINT) AS assists, CAST(game_id % 2 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS double_plays, CAST(0 AS BIGINT) AS triple_plays, CAST(CASE WHEN fielding_position = 2 THEN 1 END AS BIGINT) AS passed_balls FROM ({RAW["raw_game_fielding_appearances"]}) a WHERE game_id % 3 = 0
 UNION ALL SELECT l_orderkey + 10000000, CASE WHEN l_linenumber % 2 = 0 THEN 'Home' ELSE 'Away' END, CAST(l_partkey % 40 AS BIGINT), CAST(l_partkey % 9 + 1 AS INTEGER), l_linenumber, CAST(l_quantity AS BIGINT), CAST(l_partkey % 6 AS BIGINT), CAST(l_suppkey % 4 AS BIGINT), CAST(l_linenumber % 2 AS BIGINT), CAST(l_partkey % 2 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT) FROM {{lineitem}}"""
_SIDES = f"({RAW['raw_games']}) g CROSS JOIN (VALUES ('Home', 5), ('Away', 11)) AS s(side, n)"
RAW["raw_box_score_team_fielding_lines"] = f"SELECT game_id, side, CAST(27 AS BIGINT) AS outs_played, CAST((game_id + n) % 5 AS BIGINT) AS putouts, CAST(n % 4 AS BIGINT) AS assists, CAST(1 AS BIGINT) AS errors, CASE WHEN game_id % 2 = 0 THEN CAST(1 AS BIGINT) END AS passed_balls FROM {_SIDES} WHERE game_id % 5 = 0"
_RUN = "side AS running_side, CAST(game_id % 40 AS BIGINT) AS runner_id, CAST(100 + game_id % 12 AS BIGINT) AS pitcher_id, CAST((game_id + 1) % 40 AS BIGINT) AS catcher_id, CAST(game_id % 9 + 1 AS INTEGER) AS inning"
RAW["raw_box_score_stolen_bases"] = f"SELECT game_id, season, {_RUN} FROM {_SIDES} WHERE (game_id + n) % 2 = 0"
RAW["raw_box_score_caught_stealing"] = f"SELECT game_id, season, {_RUN} FROM {_SIDES} WHERE (game_id + n) % 3 = 0"
RAW["raw_box_score_double_plays"] = f"SELECT game_id, side AS defense_side, concat('f', CAST(game_id % 9 AS VARCHAR(9))) AS fielders FROM {_SIDES} WHERE (game_id + n) % 4 = 0"
RAW["raw_box_score_triple_plays"] = f"SELECT game_id, side AS defense_side, concat('f', CAST(game_id % 7 AS VARCHAR(9))) AS fielders FROM {_SIDES} WHERE (game_id + n) % 25 = 0"
RAW["raw_box_score_pinch_hitting_lines"] = f"SELECT {_LINE}, CAST(l_partkey % 40 AS BIGINT) AS pinch_hitter_id, CASE WHEN l_suppkey % 7 > 0 THEN CAST(l_suppkey % 9 + 1 AS INTEGER) END AS inning, l_linenumber AS at_bats, l_partkey % 3 AS hits, l_suppkey % 2 AS hit_by_pitch, l_partkey % 4 AS rbi FROM {{lineitem}} WHERE l_partkey % 3 = 0"
RAW["raw_box_score_pinch_running_lines"] = f"SELECT {_LINE}, CAST(l_partkey % 40 AS BIGINT) AS pinch_runner_id, CAST(l_suppkey % 9 + 1 AS INTEGER) AS inning, l_partkey % 2 AS runs, l_suppkey % 3 AS stolen_bases, l_linenumber % 2 AS caught_stealing FROM {{lineitem}} WHERE l_partkey % 3 = 1"
RAW["raw_game_earned_runs"] = f"SELECT game_id, pitcher_id AS player_id, CAST(sum(runs_on_play) AS BIGINT) AS earned_runs FROM ({RAW['raw_events']}) e GROUP BY game_id, pitcher_id"
RAW["event_pitching_flags"] = f"SELECT event_id AS event_key, game_id, pitcher_id, event_id % 3 = 0 AS starting_pitcher_flag, CAST(event_id % 4 AS BIGINT) AS inherited_runners, CAST(event_id % 3 AS BIGINT) AS bequeathed_runners, event_id % 5 = 0 AS new_relief_pitcher_flag, event_id % 7 = 0 AS pitcher_finish_flag, event_id % 6 = 0 AS save_situation_start_flag, event_id % 11 = 0 AS hold_flag, event_id % 9 = 0 AS blown_save_flag, event_id % 13 = 0 AS save_flag FROM ({RAW['raw_events']}) e"
_REG = "CAST(1916 + l_suppkey % 12 AS INTEGER) AS season, concat('T', CAST(l_suppkey % 25 AS VARCHAR(9))) AS register_team, CAST({0} AS BIGINT) AS player_id, CAST(count(*) AS BIGINT) AS games"
_sum = lambda e, n: f"CAST(sum({e}) AS BIGINT) AS {n}"
RAW["raw_databank_batting"] = f"SELECT {_REG.format('l_partkey % 40')}, {_sum('l_quantity', 'hits')}, {_sum('l_partkey % 3', 'doubles')}, {_sum('l_suppkey % 2', 'triples')}, {_sum('l_linenumber % 2', 'home_runs')}, {_sum('l_partkey % 4', 'walks')}, {_sum('l_suppkey % 3', 'stolen_bases')}, {_sum('l_linenumber % 3', 'caught_stealing')} FROM {{lineitem}} GROUP BY 1, 2, 3"
RAW["raw_databank_pitching"] = f"SELECT {_REG.format('100 + l_partkey % 12')}, {_sum('l_linenumber % 2', 'wins')}, {_sum('l_suppkey % 2', 'losses')}, {_sum('l_partkey % 4', 'earned_runs')}, {_sum('l_quantity', 'outs_recorded')}, {_sum('l_partkey % 9', 'hits')}, {_sum('l_partkey % 8', 'strikeouts')}, {_sum('l_suppkey % 4', 'walks')} FROM {{lineitem}} GROUP BY 1, 2, 3"
RAW["raw_databank_fielding"] = f"SELECT CAST(1912 + l_suppkey % 20 AS INTEGER) AS season, CAST(l_suppkey % 25 AS INTEGER) AS team_id, CAST(l_partkey % 40 AS BIGINT) AS player_id, {_pick('CAST(l_partkey % 8 AS INTEGER)', ['P', 'C', '1B', '2B', '3B', 'SS', 'OF', 'DH'])} AS pos, CAST(count(*) AS BIGINT) AS games, {_sum('l_linenumber % 2', 'games_started')}, {_sum('l_quantity', 'outs_played')}, {_sum('l_partkey % 5', 'putouts')}, {_sum('l_partkey % 3', 'assists')}, {_sum('l_suppkey % 2', 'errors')}, {_sum('l_partkey % 2', 'double_plays')}, {_sum('l_linenumber % 2', 'passed_balls')}, {_sum('l_linenumber % 3', 'stolen_bases')}, {_sum('l_linenumber % 4', 'caught_stealing')} FROM {{lineitem}} GROUP BY 1, 2, 3, 4"
RAW["team_crosswalk"] = "SELECT concat('T', CAST(n_nationkey AS VARCHAR(9))) AS register_team, CAST(n_nationkey AS INTEGER) AS team_id FROM {nation}"
RAW["raw_rosters"] = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderkey % 25 AS INTEGER) AS team_id, o_custkey % 60 AS player_id, CASE o_orderkey % 3 WHEN 0 THEN '?' WHEN 1 THEN 'L' ELSE 'R' END AS bats, CASE o_custkey % 4 WHEN 0 THEN '?' ELSE 'R' END AS throws, o_orderkey AS line FROM {orders}"
#: What a person's record tells beside body and hands: places, spans of a career in four roles, the grave and changes.
BIO_TEXTS = ["last", "first", "nickname", *[f"birth_{x}" for x in ("city", "state", "country")], *[f"death_{x}" for x in ("city", "state", "country")], "cemetary", *[f"ceme_{x}" for x in ("city", "state", "country", "note")], "birth_name", "name_chg", "bat_chg", "hof"]
BIO_DATES = ["deathdate", *[f"{role}_{x}" for role, at in (("play", 0), ("mgr", 1), ("coach", 2), ("ump", 3)) for x in ("debut", "lastgame")]]


def _bio() -> str:
    texts = [f"CASE WHEN c_custkey % {k % 7 + 2} > 0 THEN concat('{n} ', CAST(c_custkey % {k + 5} AS VARCHAR(9))) END AS {n}" for k, n in enumerate(BIO_TEXTS)]
    dates = [f"CASE WHEN c_custkey % {k % 5 + 2} > 0 THEN CAST('19{10 + k}-0{k % 9 + 1}-11' AS DATE) END AS {n}" for k, n in enumerate(BIO_DATES)]
    return ", ".join(texts + dates)


RAW["raw_bio"] = "SELECT c_custkey AS player_id, CASE WHEN c_custkey % 6 = 0 THEN 'tall' ELSE concat(CAST(5 + c_custkey % 2 AS VARCHAR(9)), '-', CAST(c_custkey % 12 AS VARCHAR(9))) END AS height, CAST(150 + c_custkey % 90 AS VARCHAR(9)) AS weight, concat('18', CAST(70 + c_custkey % 30 AS VARCHAR(9)), '0', CAST(1 + c_custkey % 9 AS VARCHAR(9)), '15') AS born, CASE c_custkey % 3 WHEN 0 THEN '' ELSE 'R' END AS bats, CASE c_custkey % 4 WHEN 0 THEN '' ELSE 'L' END AS throws, " + _bio() + " FROM {customer}"

_day = lambda e: f"CAST({e} AS DATE)"
_text = lambda e, before="": f"concat('{before}', CAST({e} AS VARCHAR(20)))"
RAW["raw_box_score_hit_by_pitches"] = f"SELECT {_LINE.replace(' AS side', ' AS pitching_side')}, CAST(100 + l_partkey % 12 AS BIGINT) AS pitcher_id, CAST(l_suppkey % 40 AS BIGINT) AS batter_id FROM {{lineitem}} WHERE l_returnflag = 'R'"
RAW["raw_box_score_home_runs"] = f"SELECT {_LINE.replace(' AS side', ' AS batting_side')}, CAST(l_partkey % 40 AS BIGINT) AS batter_id, CAST(100 + l_suppkey % 12 AS BIGINT) AS pitcher_id, l_linenumber AS inning, l_partkey % 4 AS runners_on, l_suppkey % 3 AS outs FROM {{lineitem}} WHERE l_returnflag = 'A'"
RAW["raw_box_score_line_scores"] = f"SELECT {_LINE}, l_linenumber AS inning, l_partkey % 5 AS runs FROM {{lineitem}}"
RAW["raw_box_score_team_batting_lines"] = f"SELECT {_LINE}, {', '.join(f'CAST(sum({e}) AS INTEGER) AS {n}' for n, e in (('at_bats', 'l_quantity'), ('runs', 'l_partkey % 5'), ('hits', 'l_quantity % 9'), ('rbi', 'l_partkey % 4'), ('hit_by_pitch', 'l_suppkey % 2'), ('walks', 'l_partkey % 3'), ('strikeouts', 'l_suppkey % 5')))} FROM {{lineitem}} GROUP BY 1, 2"
RAW["raw_box_score_team_miscellaneous_lines"] = f"SELECT {_LINE}, CAST(sum(l_partkey % 3) AS BIGINT) AS left_on_base, CAST(sum(l_suppkey % 3) AS BIGINT) AS team_earned_runs, CAST(max(l_linenumber % 2) AS BIGINT) AS double_plays_turned, CAST(0 AS BIGINT) AS triple_plays_turned FROM {{lineitem}} GROUP BY 1, 2"
RAW["raw_event_audit"] = f"SELECT game_id, event_id, event_id AS event_key, {_text('season', 'f')} AS filename, event_id % 5000 AS line_number, {_text('batter_id', 'play,')} AS raw_play FROM ({RAW['raw_events']}) e"
RAW["raw_coaches"] = f"SELECT c_custkey AS id, 1950 + c_nationkey AS year, c_nationkey AS team, c_mktsegment AS role, {_day("'1950-04-01'")} AS start_date, CASE WHEN c_custkey % 4 > 0 THEN {_day("'1950-10-01'")} END AS end_date FROM {{customer}}"
RAW["raw_ejections"] = f"SELECT user_id * 1000 + dayofyear(ts) AS game_id, {_day('ts')} AS date, CAST(user_id % 3 AS VARCHAR(9)) AS double_header, CAST(event_id % 40 AS BIGINT) AS ejectee, {_text('event_id % 40', 'Name ')} AS ejectee_name, user_id % 25 AS team, CASE WHEN event_id % 3 = 0 THEN 'M' ELSE 'P' END AS job, event_id % 17 AS umpire, {_text('event_id % 17', 'Ump ')} AS umpire_name, hour(ts) AS inning, event_type AS reason FROM {{events}} WHERE event_type = 'error'"
RAW["raw_managers"] = f"SELECT s_suppkey AS id, s_name AS lastname, CAST(s_nationkey AS VARCHAR(9)) AS firstname, {_day("'1930-05-01'")} AS first_g, {_day("'1939-09-30'")} AS last_g FROM {{supplier}}"
RAW["raw_umpires"] = f"SELECT p_partkey AS id, p_brand AS lastname, p_type AS firstname, {_day("'1940-05-01'")} AS first_g, CASE WHEN p_size > 5 THEN {_day("'1949-09-30'")} END AS last_g FROM {{part}}"
RAW["raw_relatives"] = "SELECT o_custkey AS id1, o_orderpriority AS relation, o_orderkey AS id2 FROM {orders}"
RAW["raw_teams_master"] = "SELECT n_nationkey AS team, r_name AS league, n_name AS city, concat(n_name, 's') AS nickname, 1900 + n_nationkey AS first_year, CASE WHEN n_nationkey % 2 = 0 THEN 1960 END AS last_year FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"
RAW["raw_parks"] = f"SELECT {_text('s_suppkey', 'P')} AS park_id, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN s_name END AS aka, concat('C', CAST(s_nationkey AS VARCHAR(9))) AS city, CAST(s_nationkey AS VARCHAR(9)) AS state, {_day("'1920-04-01'")} AS start_date, CASE WHEN s_suppkey % 2 = 0 THEN {_day("'1960-10-01'")} END AS end_date, CASE WHEN s_nationkey > 9 THEN 'AL' ELSE 'NL' END AS league, CAST(s_acctbal AS VARCHAR(20)) AS notes FROM {{supplier}}"
RAW["raw_schedule"] = f"SELECT {_day('o_orderdate')} AS date, o_orderkey % 3 AS double_header, o_orderpriority AS day_of_week, o_orderkey % 25 AS visiting_team, 'AL' AS visiting_team_league, o_orderkey % 154 AS visiting_team_game_number, o_custkey % 25 AS home_team, 'NL' AS home_team_league, o_custkey % 154 AS home_team_game_number, CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'N' END AS day_night, CASE WHEN o_orderstatus = 'P' THEN 'rain' END AS postponement_indicator, CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey AS VARCHAR(20)) END AS makeup_dates, {_text('o_custkey % 30', 'P')} AS park_id FROM {{orders}}"
RAW["raw_databank_people"] = f"""SELECT {_text('c_custkey', 'd')} AS player_id, CASE WHEN c_custkey % 9 > 0 THEN c_custkey END AS retro_id, {_text('c_custkey', 'b')} AS bbref_id, 1870 + c_nationkey AS birth_year, c_custkey % 12 + 1 AS birth_month, c_custkey % 28 + 1 AS birth_day, c_name AS name_last, c_mktsegment AS name_first, 150 + c_custkey % 90 AS weight, 60 + c_custkey % 18 AS height, CASE WHEN c_custkey % 3 > 0 THEN 'R' END AS bats, {_day("'1900-05-01'")} AS debut, {", ".join(f"CASE WHEN c_custkey % {k + 2} > 0 THEN {_text(f'c_custkey % {k + 9}', n[0])} END AS {n}" for k, n in enumerate(("birth_country", "birth_state", "birth_city", "death_country", "death_state", "death_city", "name_given")))},
 CASE WHEN c_custkey % 2 > 0 THEN 1930 + c_nationkey END AS death_year, CASE WHEN c_custkey % 2 > 0 THEN c_custkey % 12 + 1 END AS death_month, CASE WHEN c_custkey % 2 > 0 THEN c_custkey % 27 + 1 END AS death_day, CASE WHEN c_custkey % 5 > 0 THEN 'L' END AS throws, {_day("'1912-09-30'")} AS final_game FROM {{customer}}"""
_OF = "concat('d', CAST(l_partkey % 60 AS VARCHAR(20))) AS player_id, CAST(1916 + l_suppkey % 12 AS INTEGER) AS year_id, concat('T', CAST(l_suppkey % 25 AS VARCHAR(9))) AS team_id"
RAW["raw_databank_fielding_games"] = f"SELECT {_OF}, CASE WHEN l_suppkey % 2 = 0 THEN 'AL' ELSE 'NL' END AS lg_id, l_linenumber % 2 + 1 AS stint, {_pick('CAST(floor(l_partkey / 60) % 8 AS INTEGER)', ['P', 'C', '1B', '2B', '3B', 'SS', 'OF', 'OF'])} AS pos, CAST(count(*) AS BIGINT) AS g, CASE WHEN l_suppkey % 5 > 0 THEN CAST(sum(l_quantity) AS BIGINT) END AS inn_outs FROM {{lineitem}} GROUP BY 1, 2, 3, 4, 5, 6, l_suppkey % 5"
RAW["raw_databank_fielding_of"] = f"SELECT {_OF}, l_linenumber % 2 + 1 AS stint, {_sum('l_partkey % 4', 'g_lf')}, {_sum('l_suppkey % 4', 'g_cf')}, {_sum('l_linenumber % 3', 'g_rf')} FROM {{lineitem}} GROUP BY 1, 2, 3, 4"
RAW["raw_databank_appearances"] = f"SELECT {_OF}, CASE WHEN l_suppkey % 3 = 0 THEN 'AL' ELSE 'FL' END AS lg_id, CAST(count(*) AS BIGINT) AS g_all, {_sum('l_partkey % 4', 'g_lf')}, {_sum('l_suppkey % 4', 'g_cf')}, {_sum('l_linenumber % 3', 'g_rf')} FROM {{lineitem}} GROUP BY 1, 2, 3, 4"

GIVEN = ("events", "orders", "lineitem", "customer", "part", "nation", "region", "supplier")
