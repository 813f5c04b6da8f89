"""Queries for the catalogue of models over raw tables derived from the given ones, with their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models import MODELS, Store
from ..models import stats as S
from ..models.analyses import BALL_FACTS, PITCH_FACTS
from ..models.events import PITCH_RULES
from ..models.expectancy import FACTORS
from ..models.learning import CATEGORIES, NUMBERS, OUTCOMES, PLAYERS, TARGETS, WEIGHTS
from ..models.metric_tables import GRAINS, KINDS
from ..models.rollups import _CREDITED, _JUDGED
from ..models.seasons import LINE_ISSUES, SPLIT_COUNTS, SPLITS
from ..models.staging import BIO, NAMED, PEOPLE
from ..models.states import BASES, POSITIONS
from ..operators import metrics as M
from ..operators import ml as ML
from ..sources.shared import new_dir, written
from .model_sources import GIVEN, RAW
from .probes_groups import sport_text
from .registry import probe


def b(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS BIGINT)"


def total(columns, fmt: str = "sum({0})") -> str:
    return ", ".join(f"CAST({fmt.format(c)} AS BIGINT) AS {c}" for c in columns)


def each(columns, fmt: str) -> str:
    return ", ".join(f"{fmt.format(c)} AS {c}" for c in columns)


def rate(over: str, under: str) -> str:
    return f"sum({over}) / nullif(sum({under}), 0)"


SQL: dict[str, str] = {}

# Staging

SQL["stg_events"] = "SELECT * EXCLUDE (ts), CAST(ts AS DATE) AS date, event_id AS event_key, CAST(bit_count(base_state) AS BIGINT) AS runners_count FROM raw_events"
SQL["stg_event_baserunners"] = """SELECT * REPLACE (coalesce(advanced_on_error_flag, false) AS advanced_on_error_flag), CASE baserunner WHEN 'First' THEN 1 WHEN 'Second' THEN 2 WHEN 'Third' THEN 4 ELSE 0 END AS baserunner_bit,
 CASE baserunner WHEN 'Batter' THEN 0 WHEN 'First' THEN 1 WHEN 'Second' THEN 2 ELSE 3 END AS number_base_from, CASE attempted_advance_to_base WHEN 'First' THEN 1 WHEN 'Second' THEN 2 WHEN 'Third' THEN 3 WHEN 'Home' THEN 4 END AS number_base_to, attempted_advance_to_base IS NOT NULL AS is_advance_attempt, event_key - event_id + reached_on_event_id AS reached_on_event_key, event_key - event_id + charge_event_id AS charge_event_key FROM raw_event_baserunners"""
SQL["stg_event_comments"] = "SELECT DISTINCT event_key, comment FROM raw_event_comments WHERE comment IS NOT NULL"
SQL["stg_rosters"] = "SELECT year, team_id, player_id, nullif(bats, '?') AS bats, nullif(throws, '?') AS throws FROM raw_rosters QUALIFY row_number() OVER (PARTITION BY year, team_id, player_id ORDER BY nullif(bats, '?') NULLS LAST, nullif(throws, '?') NULLS LAST, line) = 1"
SQL["stg_bio"] = "SELECT player_id, CAST(CASE WHEN height LIKE '%-%' THEN 12 * CAST(split_part(height, '-', 1) AS BIGINT) + CAST(split_part(height, '-', 2) AS BIGINT) END AS BIGINT) AS height_inches, CAST(weight AS BIGINT) AS weight_pounds, CAST(strptime(born, '%Y%m%d') AS DATE) AS birth_date, nullif(bats, '') AS bats, nullif(throws, '') AS throws, " + ", ".join(f"{old} AS {new}" for old, new in BIO.items()) + " FROM raw_bio"
_HITS = "hits - doubles - triples - home_runs AS singles, hits + doubles + 2 * triples + 3 * home_runs AS total_bases"
SQL["stg_box_score_batting_lines"] = f"SELECT *, {_HITS}, at_bats + coalesce(walks, 0) + coalesce(hit_by_pitches, 0) AS plate_appearances, hits + walks + coalesce(hit_by_pitches, 0) AS on_base_successes, at_bats + walks + coalesce(hit_by_pitches, 0) AS on_base_opportunities, at_bats - hits AS batting_outs FROM raw_box_batting"
SQL["stg_box_score_pitching_lines"] = f"SELECT *, {b('nth_pitcher = 1')} AS games_started, {b('nth_pitcher > 1')} AS games_relieved, {b('nth_pitcher = max(nth_pitcher) OVER (PARTITION BY game_id, side)')} AS games_finished, {_HITS}, hits + walks AS on_base_successes, batters_faced AS on_base_opportunities FROM raw_box_pitching"
SQL["stg_databank_batting"] = f"SELECT r.* EXCLUDE (register_team), team_id, {_HITS} FROM raw_databank_batting r JOIN team_crosswalk USING (register_team)"
SQL["stg_databank_pitching"] = "SELECT r.* EXCLUDE (register_team), team_id FROM raw_databank_pitching r JOIN team_crosswalk USING (register_team)"
SQL["stg_databank_fielding"] = "SELECT *, CASE pos WHEN 'P' THEN 1 WHEN 'C' THEN 2 WHEN '1B' THEN 3 WHEN '2B' THEN 4 WHEN '3B' THEN 5 WHEN 'SS' THEN 6 END AS fielding_position, CASE WHEN pos IN ('P', 'C', 'OF') THEN pos ELSE 'IF' END AS register_category FROM raw_databank_fielding"
SQL["stg_gamelog"] = "SELECT * EXCLUDE (double_header, forfeit, park, kind), CAST(double_header AS BIGINT) AS doubleheader_status, CAST(year(date) AS INTEGER) AS season, nullif(trim(forfeit), '') AS forfeit_info, nullif(trim(park), '') AS park_id, 'GameLog' AS source_type, CASE kind WHEN 'R' THEN 'RegularSeason' ELSE 'Postseason' END AS game_type, NULL::BOOLEAN AS use_dh FROM raw_gamelog"
SQL["stg_games"] = """SELECT * EXCLUDE (game_winning_rbi) REPLACE (coalesce(sky, 'Unknown') AS sky, CASE WHEN attendance > 0 OR year(date) = 2020 THEN attendance END AS attendance, coalesce(use_dh, false) AS use_dh, CASE WHEN regexp_full_match(filename, '\\d{4}AS\\.EVE') THEN 'AllStarGame' ELSE game_type END AS game_type), game_winning_rbi AS game_winning_rbi_player_id, game_id * 255 AS game_key FROM (
 SELECT *, 'PlayByPlay' AS source_type FROM raw_games UNION ALL BY NAME SELECT *, 'BoxScore' AS source_type FROM raw_box_games WHERE game_id NOT IN (SELECT game_id FROM raw_games))"""


def _named_sql(raw: str, columns: str) -> str:
    parts = [(p.split(":") + ["", ""])[:3] for p in columns.split()]
    return "SELECT " + ", ".join((f"CAST({old} AS BIGINT)" if kind else old) + f" AS {new or old}" for old, new, kind in parts) + f" FROM {raw}"


SQL |= {name: _named_sql(*spec) for name, spec in NAMED.items()}
SQL["stg_box_score_caught_stealing"] = "SELECT * EXCLUDE (season) FROM raw_box_score_caught_stealing WHERE season < 1919"
SQL["stg_box_score_pinch_hitting_lines"] = "SELECT * EXCLUDE (hit_by_pitch), hit_by_pitch AS hit_by_pitches FROM raw_box_score_pinch_hitting_lines WHERE inning IS NOT NULL"
SQL["stg_people"] = f"SELECT {', '.join(' AS '.join((p + ':' + p).split(':')[:2]) for p in PEOPLE.split())}, row_number() OVER (ORDER BY player_id) AS internal_id FROM raw_databank_people"
SQL["stg_databank_appearances"] = """WITH f AS (SELECT * FROM raw_databank_fielding_games), o AS (SELECT *, sum(g) OVER (PARTITION BY player_id, year_id, team_id) AS team_g FROM f WHERE pos = 'OF'),
 s AS (SELECT o.player_id, o.year_id, o.team_id, o.lg_id, stint, unnest([7, 8, 9]) AS fielding_position, unnest([CAST(round(g_lf * (g / team_g)) AS BIGINT), CAST(round(g_cf * (g / team_g)) AS BIGINT), CAST(round(g_rf * (g / team_g)) AS BIGINT)]) AS games_at_position FROM o JOIN raw_databank_appearances a USING (player_id, year_id, team_id)),
 p AS (SELECT player_id, year_id, team_id, lg_id, stint, CASE pos WHEN 'P' THEN 1 WHEN 'C' THEN 2 WHEN '1B' THEN 3 WHEN '2B' THEN 4 WHEN '3B' THEN 5 WHEN 'SS' THEN 6 END AS fielding_position, g AS games_at_position FROM f WHERE pos <> 'OF' UNION ALL SELECT * FROM s),
 t AS (SELECT player_id, year_id, team_id, stint, CAST(sum(inn_outs) AS BIGINT) AS n FROM f WHERE pos <> 'P' GROUP BY ALL HAVING sum(inn_outs) IS NOT NULL)
 SELECT w.player_id, databank_player_id, p.year_id AS season, p.stint, c.team_id, coalesce(a.lg_id, p.lg_id) AS league_id, fielding_position, games_at_position, g_all AS games_total, coalesce(n, 0) AS outs_played FROM p JOIN raw_databank_appearances a USING (player_id, year_id, team_id) LEFT JOIN t ON t.player_id = p.player_id AND t.year_id = p.year_id AND t.team_id = p.team_id AND t.stint = p.stint JOIN stg_people w ON w.databank_player_id = p.player_id LEFT JOIN team_crosswalk c ON c.register_team = p.team_id WHERE w.player_id IS NOT NULL AND games_at_position > 0"""

# Events

SQL["event_double_plays"] = "SELECT event_key, bool_or(is_double_play) AS is_double_play, bool_or(is_triple_play) AS is_triple_play, bool_or(is_ground_ball_double_play) AS is_ground_ball_double_play FROM stg_event_flags JOIN seed_double_play_flag_types USING (flag) GROUP BY 1"
_R = "plate_appearance_result"
_KINDS = {"strikeouts": "StrikeOut", "intentional_walks": "IntentionalWalk", "hit_by_pitches": "HitByPitch", "sacrifice_flies": "SacrificeFly", "sacrifice_hits": "SacrificeHit", "reached_on_errors": "ReachedOnError", "reached_on_interferences": "Interference", "ground_rule_doubles": "GroundRuleDouble", "inside_the_park_home_runs": "InsideTheParkHomeRun"}
SQL["event_batting_stats"] = f"""SELECT x.* EXCLUDE (outs), CAST(CASE WHEN outs + outs_on_play = 3 THEN left_on_base ELSE 0 END AS BIGINT) AS left_on_base_with_two_outs FROM (SELECT game_id, e.event_key, outs, CASE WHEN {_R} = 'StrikeOut' THEN coalesce(strikeout_responsible_batter_id, batter_id) ELSE batter_id END AS batter_id,
 CASE WHEN {_R} IN ('Walk', 'IntentionalWalk') THEN coalesce(walk_responsible_pitcher_id, pitcher_id) ELSE pitcher_id END AS pitcher_id, batting_team_id, fielding_team_id, CAST(1 AS BIGINT) AS plate_appearances,
 {b("is_at_bat AND e.event_key NOT IN (SELECT event_key FROM stg_event_flags WHERE flag IN ('SacrificeFly', 'SacrificeHit'))")} AS at_bats, {b("is_hit")} AS hits, {b("total_bases = 1")} AS singles, {b("total_bases = 2")} AS doubles, {b("total_bases = 3")} AS triples, {b("total_bases = 4")} AS home_runs, CAST(total_bases AS BIGINT) AS total_bases,
 {b("is_hit AND batted_to_fielder IN (1, 2, 3, 4, 5, 6)")} AS infield_hits, {", ".join(f"{b(f"{_R} = '{v}'")} AS {n}" for n, v in _KINDS.items())}, {b(f"{_R} LIKE '%Walk'")} AS walks, {b("is_on_base_opportunity")} AS on_base_opportunities, {b("is_on_base_success")} AS on_base_successes,
 CAST(coalesce(runs_batted_in, 0) AS BIGINT) AS runs_batted_in, {b("is_ground_ball_double_play")} AS grounded_into_double_plays, {b("is_double_play")} AS double_plays, {b("is_triple_play")} AS triple_plays, {b("is_batting_out")} + {b("is_ground_ball_double_play")} AS batting_outs, CAST(outs_on_play AS BIGINT) AS outs_on_play,
 CAST(CASE WHEN is_batting_out AND outs_on_play > 0 AND is_at_bat THEN runners_count - outs_on_play - runs_on_play + 1 ELSE 0 END AS BIGINT) AS left_on_base FROM stg_events e JOIN seed_plate_appearance_result_types USING ({_R}) LEFT JOIN event_double_plays d ON d.event_key = e.event_key) x"""
SQL["calc_batted_ball_type"] = f"""SELECT game_id, event_key, {_R}, t AS trajectory, CASE WHEN t = 'GroundBall' THEN 'GroundBall' WHEN t LIKE '%Bunt%' THEN 'Bunt' WHEN t IN ('Fly', 'LineDrive', 'PopUp') OR {_R} = 'HomeRun' THEN 'AirBall' ELSE 'Unknown' END AS trajectory_broad_classification,
 CASE WHEN f > 6 THEN CASE t WHEN 'GroundBall' THEN 'Infield' WHEN 'Unknown' THEN 'Unknown' ELSE 'Outfield' END WHEN f = 2 THEN 'Plate' WHEN f > 0 THEN 'Infield' ELSE coalesce(batted_location_depth, 'Unknown') END AS location_depth, coalesce(batted_location_side, 'Unknown') AS location_side, batted_location_general, f AS batted_to_fielder
 FROM (SELECT *, CASE WHEN batted_trajectory = 'Unknown' AND f BETWEEN 1 AND 6 AND outs_on_play > 0 THEN 'GroundBall' ELSE batted_trajectory END AS t FROM (SELECT *, CASE WHEN {_R} IN ('HomeRun', 'GroundRuleDouble') THEN NULL ELSE batted_to_fielder END AS f FROM stg_events WHERE batted_trajectory IS NOT NULL))"""
_TR = {"trajectory_fly_ball": "trajectory = 'Fly'", "trajectory_ground_ball": "trajectory = 'GroundBall'", "trajectory_line_drive": "trajectory = 'LineDrive'", "trajectory_pop_up": "trajectory = 'PopUp'", "trajectory_unknown": "trajectory = 'Unknown'", "trajectory_known": "trajectory <> 'Unknown'", "trajectory_broad_air_ball": "c = 'AirBall'", "trajectory_broad_ground_ball": "c = 'GroundBall'", "bunts": "c = 'Bunt'", "trajectory_broad_unknown": "c = 'Unknown'", "trajectory_broad_known": "c <> 'Unknown'"}
_TR |= {f"batted_distance_{x.lower()}": f"d = '{x}'" for x in ("Plate", "Infield", "Outfield", "Unknown")} | {"batted_distance_known": "d <> 'Unknown'"} | {f"batted_angle_{x.lower()}": f"a = '{x}'" for x in ("Left", "Right", "Middle", "Unknown")} | {"batted_angle_known": "a <> 'Unknown'"}
_TR |= {"fielded_by_battery": "f IN (1, 2)", "fielded_by_infielder": "f IN (3, 4, 5, 6)", "fielded_by_outfielder": "f > 6", "fielded_by_unknown": "f = 0", "fielded_by_known": "f IS NULL OR f <> 0", "batted_location_plate": "f = 2", "batted_location_unknown": "d = 'Unknown'", "batted_location_known": "d <> 'Unknown'"}
_TR |= {f"batted_location_{n}": f"d = '{d}' AND a = '{a}'" for d, names in (("Infield", {"Right": "right_infield", "Left": "left_infield", "Middle": "middle_infield"}), ("Outfield", {"Left": "left_field", "Middle": "center_field", "Right": "right_field"})) for a, n in names.items()}
_TR |= {"batted_balls_pulled": "batter_hand = 'R' AND a = 'Left' OR batter_hand = 'L' AND a = 'Right'", "batted_balls_opposite_field": "batter_hand = 'R' AND a = 'Right' OR batter_hand = 'L' AND a = 'Left'"}
SQL["event_batted_ball_stats"] = f"SELECT event_key, CAST(1 AS BIGINT) AS balls_batted, {b('f IS NOT NULL')} AS balls_in_play, {', '.join(f'{b(c)} AS {n}' for n, c in _TR.items())} FROM (SELECT *, trajectory_broad_classification AS c, location_depth AS d, location_side AS a, batted_to_fielder AS f FROM calc_batted_ball_type) JOIN event_states_batter_pitcher USING (event_key)"
_MIS = ", ".join(f"CAST(coalesce(bool_or(baserunning_play_type = '{k}'), false) AS BIGINT) AS {n}" for n, k in (("passed_balls", "PassedBall"), ("wild_pitches", "WildPitch"), ("balks", "Balk")))
SQL["misplays"] = f"SELECT event_key, {_MIS} FROM stg_event_baserunners GROUP BY 1"
SQL["event_pitch_sequence_stats"] = f"SELECT event_key, {', '.join(f'n.{n} AS {n}' for n in PITCH_RULES)}, {each(S.MISPLAYS, 'coalesce(m.{0}, 0)')} FROM (SELECT event_key, {', '.join(f'count(*) FILTER (WHERE {c}) AS {n}' for n, c in PITCH_RULES.items())} FROM stg_event_pitch_sequences JOIN seed_pitch_types USING (sequence_item) GROUP BY 1) n LEFT JOIN misplays m USING (event_key)"
_TO = {"second": "First", "third": "Second", "home": "Third"}
_RUN = {"runs": "ok AND number_base_to = 4", "outs_on_basepaths": "is_out", "times_reached_base": "ok AND baserunner = 'Batter'", "times_lead_runner": "CASE baserunner WHEN 'Batter' THEN false WHEN 'First' THEN base_state = 1 WHEN 'Second' THEN base_state < 4 ELSE true END", "times_force_on_runner": "forced", "times_next_base_empty": "empty"}
for _n, _c in (("stolen_base_opportunities", "(k = 'StolenBase' OR k LIKE '%CaughtStealing' OR empty AND baserunner <> 'Batter')"), ("stolen_bases", "k = 'StolenBase'"), ("caught_stealing", "k LIKE '%CaughtStealing'")):
    _RUN |= {_n: _c} | {f"{_n}_{t}": f"{_c} AND baserunner = '{r}'" for t, r in _TO.items()}
_RUN |= {"picked_off": "k LIKE 'PickedOff%' AND is_out"} | {f"picked_off_{r.lower()}": f"k LIKE 'PickedOff%' AND is_out AND baserunner = '{r}'" for r in _TO.values()} | {"picked_off_caught_stealing": "k = 'PickedOffCaughtStealing'"}
_RUN |= {f"advances_on_{n}": f"k = '{v}' AND ok" for n, v in (("wild_pitches", "WildPitch"), ("passed_balls", "PassedBall"), ("balks", "Balk"), ("unspecified_plays", "OtherAdvance"), ("defensive_indifference", "DefensiveIndifference"))} | {"advances_on_errors": "(k = 'AdvancedOnError' OR advanced_on_error_flag) AND ok"}
_RUN |= {"plate_appearances_while_on_base": f"{_R} IS NOT NULL AND baserunner <> 'Batter'", "balls_in_play_while_running": "ip", "balls_in_play_while_on_base": "ip AND baserunner <> 'Batter'", "extra_base_chances": "chance", "extra_base_advance_attempts": "h AND gained > tb", "extra_bases_taken": "chance AND h AND gained > tb AND ok", "outs_on_extra_base_advance_attempts": "far", "outs_avoided_on_errors": "explicit_out_flag AND NOT is_out", "unforced_outs_on_basepaths": "is_out AND (coalesce(far, false) OR NOT forced OR h)"}
_clean = "ok AND ip AND NOT advanced_on_error_flag"
SQL["event_baserunning_stats"] = f"""SELECT event_key, game_id, baserunner, runner_id, batting_team_id, fielding_team_id, pitcher_id AS current_pitcher_id, {", ".join(f"{b(c)} AS {n}" for n, c in _RUN.items())}, CAST(tb AS BIGINT) AS batter_total_bases_while_running, CAST(CASE WHEN baserunner <> 'Batter' THEN tb ELSE 0 END AS BIGINT) AS batter_total_bases_while_on_base,
 CAST(CASE WHEN ok THEN gained ELSE 0 END AS BIGINT) AS bases_advanced, CAST(CASE WHEN {_clean} THEN gained ELSE 0 END AS BIGINT) AS bases_advanced_on_balls_in_play, CAST(CASE WHEN {_clean} THEN gained - least(4 - number_base_from, tb) ELSE 0 END AS BIGINT) AS surplus_bases_advanced_on_balls_in_play
FROM (SELECT r.*, e.batting_team_id, e.fielding_team_id, e.base_state, e.pitcher_id, e.{_R}, number_base_to IS NOT NULL AND NOT is_out AS ok, number_base_to - number_base_from AS gained, coalesce(baserunning_play_type, 'None') AS k, coalesce(is_hit, false) AS h, coalesce(is_in_play, false) AS ip, coalesce(total_bases, 0) AS tb,
 is_out AND explicit_out_flag AND number_base_to - number_base_from > 1 AS far, CASE baserunner WHEN 'Batter' THEN base_state % 2 = 0 WHEN 'First' THEN base_state NOT IN (2, 3, 6, 7) WHEN 'Second' THEN base_state < 4 ELSE false END AS empty, CASE baserunner WHEN 'Second' THEN base_state % 2 = 1 WHEN 'Third' THEN base_state = 7 ELSE true END AS forced,
 CASE e.{_R} WHEN 'Single' THEN baserunner IN ('First', 'Second') WHEN 'Double' THEN baserunner = 'First' ELSE false END AS chance FROM stg_event_baserunners r JOIN stg_events e USING (event_key) LEFT JOIN seed_plate_appearance_result_types p ON p.{_R} = e.{_R} WHERE NOT e.no_play_flag)"""
_own = [*S.BATTING, *S.LEFT]
SQL["event_offense_stats"] = f"""WITH r AS (SELECT * FROM event_baserunning_stats WHERE baserunner = 'Batter') SELECT coalesce(h.game_id, r.game_id) AS game_id, event_key, coalesce(h.batting_team_id, r.batting_team_id) AS team_id, coalesce(h.batter_id, r.runner_id) AS player_id, 'Batter' AS baserunner,
 {each(_own, "coalesce(h.{0}, 0)")}, {each(S.BATTED, "coalesce(l.{0}, 0)")}, {each(S.RUNNING, "coalesce(r.{0}, 0)")}, {each(S.PITCHES, "coalesce(s.{0}, 0)")}, {each(S.MISPLAYS, "coalesce(m.{0}, 0)")}
 FROM (event_batting_stats h FULL JOIN r USING (event_key)) LEFT JOIN event_batted_ball_stats l ON l.event_key = h.event_key LEFT JOIN event_pitch_sequence_stats s ON s.event_key = h.event_key LEFT JOIN misplays m ON m.event_key = h.event_key
UNION ALL BY NAME SELECT game_id, event_key, batting_team_id AS team_id, runner_id AS player_id, baserunner, {", ".join(S.RUNNING)}, {each([c for c in S.OFFENSE if c not in S.RUNNING], "CAST(0 AS BIGINT)")} FROM event_baserunning_stats WHERE baserunner <> 'Batter'"""
SQL["event_run_assignment_stats"] = """SELECT game_id, event_key, team_id, pitcher_id, CAST(sum(r) AS BIGINT) AS runs, CAST(sum(q) AS BIGINT) AS bequeathed_runners_scored, CAST(sum(i) AS BIGINT) AS inherited_runners_scored FROM (
 SELECT game_id, event_key, fielding_team_id AS team_id, c AS pitcher_id, 1 AS r, CASE WHEN c = p THEN 0 ELSE 1 END AS q, 0 AS i FROM x UNION ALL SELECT game_id, event_key, fielding_team_id, p, 0, 0, 1 FROM x WHERE c <> p) GROUP BY 1, 2, 3, 4"""
SQL["event_run_assignment_stats"] = "WITH x AS (SELECT s.*, current_pitcher_id AS p, coalesce(explicit_charged_pitcher_id, current_pitcher_id) AS c FROM event_baserunning_stats s JOIN (SELECT event_key, baserunner, explicit_charged_pitcher_id FROM stg_event_baserunners) USING (event_key, baserunner) WHERE runs = 1) " + SQL["event_run_assignment_stats"]
_bat, _run = [c for c in _own if c in S.PITCHING], [c for c in S.RUNNING if c in S.PITCHING and c != "runs"]
_new = ["batters_faced", "outs_recorded", "inherited_runners_scored", "bequeathed_runners_scored", "team_unearned_runs"]
SQL["event_pitching_stats"] = f"""WITH r AS (SELECT event_key, min(game_id) AS game_id, min(current_pitcher_id) AS p, min(fielding_team_id) AS t, {total(_run)} FROM event_baserunning_stats GROUP BY 1),
w AS (SELECT event_key, coalesce(r.game_id, h.game_id) AS game_id, coalesce(r.p, h.pitcher_id) AS player_id, coalesce(r.t, h.fielding_team_id) AS team_id, {each(_bat, "h.{0}")}, {each(_run, "r.{0}")}, {each(S.BATTED, "l.{0}")}, {each(S.PITCHES, "s.{0}")}, {each(S.MISPLAYS, "m.{0}")}, h.plate_appearances AS batters_faced, coalesce(h.outs_on_play, r.outs_on_basepaths) AS outs_recorded
 FROM (event_batting_stats h FULL JOIN r USING (event_key)) LEFT JOIN event_batted_ball_stats l USING (event_key) LEFT JOIN event_pitch_sequence_stats s USING (event_key) LEFT JOIN misplays m USING (event_key)),
u AS (SELECT w.*, a.runs, a.inherited_runners_scored FROM w LEFT JOIN event_run_assignment_stats a ON a.event_key = w.event_key AND a.pitcher_id = w.player_id UNION ALL BY NAME SELECT game_id, event_key, team_id, pitcher_id AS player_id, runs, bequeathed_runners_scored FROM event_run_assignment_stats WHERE bequeathed_runners_scored > 0)
SELECT game_id, event_key, team_id, player_id, CAST(0 AS BIGINT) AS team_unearned_runs, {each([c for c in S.PITCHING if c != "team_unearned_runs"], "CAST(coalesce({0}, 0) AS BIGINT)")} FROM u"""
SQL["calc_fielding_play_agg"] = """WITH n AS (SELECT *, sum(CASE WHEN fielding_play IN ('Putout', 'Error') THEN 1 ELSE 0 END) OVER (PARTITION BY event_key ORDER BY sequence_id) AS n FROM stg_event_fielding_plays), c AS (SELECT *, lag(n, 1, 0) OVER (PARTITION BY event_key ORDER BY sequence_id) AS chain FROM n), h AS (SELECT *, bool_or(fielding_play = 'Assist') OVER (PARTITION BY event_key, chain) AS helped, batted_location_general IS NOT NULL AS batted FROM c JOIN (SELECT event_key, batted_location_general FROM stg_events) e USING (event_key))
SELECT game_id, event_key, fielding_position, count(*) FILTER (WHERE fielding_play = 'Putout') AS putouts, count(DISTINCT CASE WHEN fielding_play = 'Assist' THEN chain END) AS assists, count(*) FILTER (WHERE fielding_play = 'Error') AS errors, count(*) FILTER (WHERE fielding_play = 'FieldersChoice') AS fielders_choices,
 count(*) FILTER (WHERE fielding_play = 'Putout' AND helped) AS assisted_putouts, count(*) FILTER (WHERE sequence_id = 1 AND fielding_play <> 'Error' AND batted) AS plays_started, count(*) FILTER (WHERE chain = 0 AND fielding_play = 'Error') AS first_errors, count(*) FILTER (WHERE fielding_play = 'Putout' AND fielding_position = 0) AS unknown_putouts, CAST(max(CASE WHEN fielding_position = 0 THEN 1 ELSE 0 END) AS BIGINT) AS incomplete_events FROM h GROUP BY 1, 2, 3"""
_CH = ["putouts", "assists", "errors", "fielders_choices", "assisted_putouts", "unknown_putouts", "incomplete_events"]
_BR = ["stolen_bases", "caught_stealing", "pickoffs", "passed_balls"]
SQL["event_fielding_stats"] = f"""WITH f AS (SELECT event_key, {total(_CH)} FROM calc_fielding_play_agg GROUP BY 1), r AS (SELECT event_key, count(*) FILTER (WHERE baserunning_play_type = 'StolenBase') AS stolen_bases, count(*) FILTER (WHERE baserunning_play_type = 'CaughtStealing') AS caught_stealing, count(*) FILTER (WHERE starts_with(baserunning_play_type, 'PickedOff')) AS pickoffs, CAST(bool_or(baserunning_play_type = 'PassedBall') AS BIGINT) AS passed_balls FROM stg_event_baserunners WHERE baserunning_play_type IS NOT NULL GROUP BY 1)
SELECT e.event_key, season, game_id, fielding_team_id AS team_id, CAST(outs_on_play AS BIGINT) AS outs_played, {b(f"e.{_R} IS NOT NULL")} AS plate_appearances_in_field, batted_to_fielder, {each(_CH, "coalesce(f.{0}, 0)")}, {each(_BR, "coalesce(r.{0}, 0)")}, {b("is_double_play")} AS double_plays, {b("is_triple_play")} AS triple_plays, {b("is_ground_ball_double_play")} AS ground_ball_double_plays,
 {b(f"e.{_R} = 'ReachedOnError'")} AS reaching_errors, {b("is_in_play")} AS plate_appearances_in_field_with_ball_in_play, CASE WHEN is_in_play THEN coalesce(f.putouts, 0) ELSE 0 END AS in_play_putouts, CASE WHEN is_in_play THEN coalesce(f.assists, 0) ELSE 0 END AS in_play_assists
FROM stg_events e LEFT JOIN r ON r.event_key = e.event_key LEFT JOIN seed_plate_appearance_result_types p ON p.{_R} = e.{_R} LEFT JOIN event_double_plays d ON d.event_key = e.event_key LEFT JOIN f ON f.event_key = e.event_key WHERE NOT no_play_flag"""

# States

_score = lambda side, less: f"CAST(sum(CASE WHEN batting_side = '{side}' THEN runs_on_play ELSE 0 END) OVER (PARTITION BY game_id ORDER BY event_key ROWS UNBOUNDED PRECEDING){' - CASE WHEN batting_side = ' + repr(side) + ' THEN runs_on_play ELSE 0 END' if less else ''} AS BIGINT)"
SQL["event_score_states"] = "SELECT event_key, " + ", ".join(f"{_score(s.title(), x == 'start')} AS score_{s}_{x}" for s in ("home", "away") for x in ("start", "end")) + ", CAST(runs_on_play AS BIGINT) AS runs_on_play FROM stg_events"
_runners = ", ".join(f"r.{base} AS runner_{base}_id_start, lead(r.{base}) OVER w AS runner_{base}_id_end" for base in BASES)
SQL["base_runners"] = f"SELECT event_key, {', '.join(f'min(CASE WHEN baserunner_bit = {bit} THEN runner_id END) AS {base}' for base, bit in BASES.items())} FROM stg_event_baserunners GROUP BY 1"
SQL["event_base_out_states"] = f"""SELECT {_runners}, CAST(bit_count(lead(base_state) OVER w) AS BIGINT) AS runners_count_end, lag(e.event_key) OVER (PARTITION BY game_id ORDER BY e.event_key) IS NULL AS game_start_flag, e.event_key, game_id, inning AS inning_start, inning AS inning_end, CASE batting_side WHEN 'Away' THEN 'Top' ELSE 'Bottom' END AS frame_start, CASE batting_side WHEN 'Away' THEN 'Top' ELSE 'Bottom' END AS frame_end, outs AS outs_start, inning * 3 - 3 + outs AS inning_in_outs_start, outs_on_play, outs + outs_on_play AS outs_end, base_state AS base_state_start,
 lead(base_state) OVER w AS base_state_end, runners_count AS runners_count_start, base_state % 2 = 1 AND outs < 2 AS is_gidp_eligible, lag(e.event_key) OVER w IS NULL AS frame_start_flag, lead(e.event_key) OVER w IS NULL AS frame_end_flag, lead(e.event_key) OVER w IS NULL AND outs + outs_on_play <> 3 AS truncated_frame_flag, lead(e.event_key) OVER (PARTITION BY game_id ORDER BY e.event_key) IS NULL AS game_end_flag, e.runs_on_play, score_home_start, score_away_start, score_home_end, score_away_end
FROM stg_events e JOIN event_score_states s ON s.event_key = e.event_key LEFT JOIN base_runners r ON r.event_key = e.event_key WINDOW w AS (PARTITION BY game_id, inning, batting_side ORDER BY e.event_key)"""
SQL["event_states_batter_pitcher"] = """WITH f AS (SELECT event_key, max(fielding_position) AS p FROM stg_events e JOIN stg_game_fielding_appearances a ON a.game_id = e.game_id AND a.player_id = e.batter_id AND e.event_id BETWEEN a.start_event_id AND a.end_event_id GROUP BY 1),
h AS (SELECT e.*, bp.bats, pp.throws, CASE WHEN specified_batter_hand IS NOT NULL THEN specified_batter_hand WHEN bp.bats = 'B' AND pp.throws = 'L' THEN 'R' WHEN bp.bats = 'B' AND pp.throws = 'R' THEN 'L' ELSE nullif(bp.bats, 'B') END AS bh FROM stg_events e LEFT JOIN people bp ON bp.player_id = e.batter_id LEFT JOIN people pp ON pp.player_id = e.pitcher_id)
SELECT game_id, h.event_key, batting_side, CASE batting_side WHEN 'Home' THEN 'Away' ELSE 'Home' END AS fielding_side, batting_team_id, fielding_team_id, batter_id, pitcher_id, batter_lineup_position, p AS batter_fielding_position, bh AS batter_hand,
 CASE WHEN specified_pitcher_hand IS NOT NULL THEN specified_pitcher_hand WHEN throws = 'B' AND bh = 'L' THEN 'R' WHEN throws = 'B' AND bh = 'R' THEN 'L' ELSE nullif(throws, 'B') END AS pitcher_hand FROM h LEFT JOIN f ON f.event_key = h.event_key"""
_key = lambda *parts: "concat_ws('_', " + ", ".join(parts) + ")"
SQL["event_states_full"] = f"""WITH j AS (SELECT e.event_key, e.event_id, e.game_id, e.count_balls, e.count_strikes, g.season, g.home_league AS league, g.is_interleague, g.game_type, g.date, g.park_id, g.home_team_id, g.away_team_id, g.home_starting_pitcher_id, g.away_starting_pitcher_id, y.time_of_day, p.* EXCLUDE (game_id, event_key), s.* EXCLUDE (game_id, event_key), score_home_start - score_away_start AS home_margin_start, score_home_end - score_away_end AS home_margin_end
 FROM stg_events e JOIN game_start_info g ON g.game_id = e.game_id LEFT JOIN stg_games y ON y.game_id = e.game_id JOIN event_states_batter_pitcher p ON p.event_key = e.event_key JOIN event_base_out_states s ON s.event_key = e.event_key),
k AS (SELECT *, CASE batting_side WHEN 'Home' THEN home_margin_start ELSE -home_margin_start END AS batting_team_margin_start, CASE batting_side WHEN 'Home' THEN home_margin_end ELSE -home_margin_end END AS batting_team_margin_end, greatest(least(home_margin_start, 10), -10) AS truncated_home_margin_start, greatest(least(home_margin_end, 10), -10) AS truncated_home_margin_end,
 CASE batting_side WHEN 'Home' THEN away_starting_pitcher_id ELSE home_starting_pitcher_id END AS pitching_team_starting_pitcher_id, CASE WHEN league IN ('AL', 'NL', 'FL') THEN league ELSE 'Other' END AS league_group, greatest(season, 1914) AS season_group,
 CASE WHEN inning_start < 10 THEN CAST(inning_start AS VARCHAR) WHEN season >= 2020 AND game_type = 'RegularSeason' THEN '11' ELSE '10' END AS inning_group_start, CASE WHEN inning_start < 10 THEN CAST(inning_end AS VARCHAR) WHEN season >= 2020 AND game_type = 'RegularSeason' THEN '11' ELSE '10' END AS inning_group_end FROM j)
SELECT *, {_key("season_group", "league_group", "outs_start", "base_state_start")} AS run_expectancy_start_key, {_key("season_group", "league_group", "outs_end", "coalesce(base_state_end, 0)")} AS run_expectancy_end_key, {_key("inning_group_start", "frame_start", "truncated_home_margin_start", "outs_start", "base_state_start")} AS win_expectancy_start_key,
 {_key("inning_group_end", "frame_end", "truncated_home_margin_end", "outs_end % 3", "coalesce(base_state_end, 0)")} AS win_expectancy_end_key FROM k"""


def _personnel_sql(table: str, place: str, key: str, side: str, end: str) -> str:
    return f"""WITH s AS (SELECT game_id, side, start_event_id AS a, max(end_event_id) AS e FROM {table} GROUP BY 1, 2, 3), r AS (SELECT game_id, side, a, coalesce(lead(a) OVER (PARTITION BY game_id, side ORDER BY a) - 1, {end}) AS z FROM s),
x AS (SELECT p.*, r.a, r.z, (game_key + a) * CASE WHEN p.side = 'Home' THEN 1 ELSE -1 END AS k, CASE WHEN p.side = 'Home' THEN home_team_id ELSE away_team_id END AS t FROM {table} p JOIN stg_games USING (game_id) JOIN r ON r.game_id = p.game_id AND r.side = p.side AND a <= end_event_id AND z >= start_event_id)
SELECT game_id, t AS {side}_team_id, side AS {side}_side, k AS {key}, a AS start_event_id, z AS end_event_id, player_id, {place} FROM x QUALIFY row_number() OVER (PARTITION BY k, {place} ORDER BY x.end_event_id DESC, player_id, x.start_event_id) = 1"""


SQL["personnel_fielding_states"] = _personnel_sql("stg_game_fielding_appearances", "fielding_position", "personnel_fielding_key", "fielding", "e")
SQL["personnel_lineup_states"] = _personnel_sql("stg_game_lineup_appearances", "lineup_position", "personnel_lineup_key", "batting", "max(e) OVER (PARTITION BY game_id, side)")
SQL["event_personnel_lookup"] = """WITH l AS (SELECT DISTINCT game_id, batting_side, personnel_lineup_key, start_event_id, end_event_id FROM personnel_lineup_states), f AS (SELECT DISTINCT game_id, fielding_side, personnel_fielding_key, start_event_id, end_event_id FROM personnel_fielding_states)
SELECT e.game_id, event_id, event_key, personnel_lineup_key, personnel_fielding_key FROM stg_events e LEFT JOIN l ON l.game_id = e.game_id AND l.batting_side = e.batting_side AND event_id BETWEEN l.start_event_id AND l.end_event_id LEFT JOIN f ON f.game_id = e.game_id AND f.fielding_side <> e.batting_side AND event_id BETWEEN f.start_event_id AND f.end_event_id WHERE NOT no_play_flag"""
SQL["event_fielders_flat"] = f"SELECT game_id, event_id, event_key, personnel_fielding_key, {', '.join(f'{n}_id' for n in POSITIONS)} FROM event_personnel_lookup JOIN (SELECT personnel_fielding_key, {', '.join(f'max(player_id) FILTER (WHERE fielding_position = {k}) AS {n}_id' for k, n in enumerate(POSITIONS, 1))} FROM personnel_fielding_states GROUP BY 1) USING (personnel_fielding_key)"
_mine, _batt = "coalesce(c.putouts, 0) + coalesce(c.assists, 0) > 0", "s.fielding_position < 3"
_only = lambda c, when: f"CASE WHEN {when} THEN e.{c} ELSE 0 END AS {c}"
SQL["event_player_fielding_stats"] = f"""SELECT e.game_id, e.event_key, s.fielding_team_id AS team_id, s.player_id, s.fielding_position, e.outs_played, e.plate_appearances_in_field, e.plate_appearances_in_field_with_ball_in_play, {each(["putouts", "assists", "errors", "fielders_choices", "assisted_putouts"], "coalesce(c.{0}, 0)")}, e.plate_appearances_in_field_with_ball_in_play * coalesce(c.putouts, 0) AS in_play_putouts, e.plate_appearances_in_field_with_ball_in_play * coalesce(c.assists, 0) AS in_play_assists,
 {", ".join(_only(c, _mine) for c in ("double_plays", "triple_plays", "ground_ball_double_plays"))}, {", ".join(_only(c, _batt) for c in ("stolen_bases", "caught_stealing", "pickoffs"))}, {_only("passed_balls", "s.fielding_position = 2")}, {_only("reaching_errors", "c.errors > 0")}, {b("e.batted_to_fielder = s.fielding_position")} AS balls_hit_to, e.unknown_putouts AS unknown_putouts_while_fielding
FROM event_fielding_stats e JOIN event_personnel_lookup l ON l.event_key = e.event_key JOIN personnel_fielding_states s ON s.personnel_fielding_key = l.personnel_fielding_key LEFT JOIN calc_fielding_play_agg c ON c.event_key = e.event_key AND c.fielding_position = s.fielding_position"""

# Games

_told = lambda mark: f"ev AS (SELECT game_id, c.event_key, regexp_extract(comment, '{mark}(.*)', 1) AS info FROM stg_event_comments c JOIN stg_events USING (event_key) WHERE comment LIKE '%{mark}%'), bx AS (SELECT game_id, NULL::BIGINT AS event_key, regexp_extract(comment, '{mark}(.*)', 1) AS info FROM stg_box_score_comments WHERE comment LIKE '%{mark}%' AND game_id NOT IN (SELECT game_id FROM ev))"
SQL["game_forfeits"] = f"WITH {_told('Forfeit=')}, lg AS (SELECT game_id, NULL::BIGINT AS event_key, forfeit_info AS info FROM stg_gamelog WHERE forfeit_info IS NOT NULL AND game_id NOT IN (SELECT game_id FROM ev) AND game_id NOT IN (SELECT game_id FROM bx)) SELECT game_id, event_key AS event_key_at_forfeit, CASE info WHEN 'H' THEN 'Home' WHEN 'V' THEN 'Away' WHEN 'T' THEN 'Tie' END AS winning_side FROM (SELECT * FROM ev UNION ALL SELECT * FROM bx UNION ALL SELECT * FROM lg)"
SQL["game_suspensions"] = f"WITH {_told('Suspend=')} SELECT game_id, event_key AS event_key_at_suspension, CAST(strptime(string_split(info, ',')[1], '%Y%m%d') AS DATE) AS date_resumed, nullif(string_split(info, ',')[2], '') AS new_park_id, CAST(string_split(info, ',')[3] AS BIGINT) AS away_score_at_suspension, CAST(string_split(info, ',')[4] AS BIGINT) AS home_score_at_suspension, CAST(string_split(info, ',')[5] AS BIGINT) AS game_outs_recorded_at_suspension FROM (SELECT * FROM ev UNION ALL SELECT * FROM bx)"
SQL["starting_pitchers"] = "SELECT game_id, arg_min(player_id, (start_event_id, player_id)) FILTER (WHERE side = 'Home') AS home_pitcher_id, arg_min(player_id, (start_event_id, player_id)) FILTER (WHERE side = 'Away') AS away_pitcher_id FROM stg_game_fielding_appearances WHERE fielding_position = 1 GROUP BY 1"
_side = lambda s: ", ".join(f"{s[0]}.{c} AS {s}_{n}" for c, n in (("franchise_id", "franchise_id"), ("league", "league"), ("division", "division"))) + f", {s[0]}.location || ' ' || {s[0]}.nickname AS {s}_team_name"
_shared = "game_id, date, season, home_team_id, away_team_id, doubleheader_status, game_type, park_id, attendance, source_type, use_dh"
SQL["game_start_info"] = f"""WITH g AS (SELECT {_shared}, scorer, filename, sky, NULL::BIGINT AS home_starting_pitcher_id, NULL::BIGINT AS away_starting_pitcher_id FROM stg_games UNION ALL BY NAME SELECT {_shared}, home_starting_pitcher_id, away_starting_pitcher_id, 'Unknown' AS sky FROM stg_gamelog WHERE game_id NOT IN (SELECT game_id FROM stg_games))
SELECT g.* REPLACE (coalesce(g.home_starting_pitcher_id, home_pitcher_id) AS home_starting_pitcher_id, coalesce(g.away_starting_pitcher_id, away_pitcher_id) AS away_starting_pitcher_id, coalesce(g.park_id, m.park_id) AS park_id), is_regular_season, is_postseason, {_side("away")}, {_side("home")}, coalesce(a.league <> h.league, false) AS is_interleague,
 coalesce(g.season >= 1947 AND filename NOT LIKE '%.E_R', false) AS is_integrated, coalesce(filename LIKE '%.E_R', false) AS is_negro_leagues, NOT coalesce(g.season >= 1947 AND filename NOT LIKE '%.E_R', false) AND NOT coalesce(filename LIKE '%.E_R', false) AS is_segregated_white
FROM g LEFT JOIN seed_franchises a ON a.team_id = g.away_team_id AND g.date BETWEEN a.date_start AND coalesce(a.date_end, DATE '9999-12-31') LEFT JOIN seed_franchises h ON h.team_id = g.home_team_id AND g.date BETWEEN h.date_start AND coalesce(h.date_end, DATE '9999-12-31') LEFT JOIN starting_pitchers s ON s.game_id = g.game_id LEFT JOIN stg_gamelog m ON m.game_id = g.game_id LEFT JOIN seed_game_types t ON t.game_type = g.game_type"""
_line = lambda s: f"string_agg(CASE WHEN r > 9 THEN '(' || r || ')' ELSE CAST(r AS VARCHAR) END, '' ORDER BY inning) FILTER (WHERE batting_side = '{s.title()}') AS {s}_line_score, CAST(sum(r) FILTER (WHERE batting_side = '{s.title()}') AS BIGINT) AS {s}_runs_scored"
SQL["game_line_scores"] = f"SELECT game_id, {_line('home')}, {_line('away')}, CAST(sum(o) AS BIGINT) AS duration_outs FROM (SELECT game_id, batting_side, inning, sum(runs_on_play) AS r, sum(outs_on_play) AS o FROM stg_events GROUP BY 1, 2, 3) GROUP BY 1"
_by = lambda one, other: f"CASE w WHEN 'Home' THEN {one} WHEN 'Away' THEN {other} END"
SQL["game_results"] = f"""WITH k AS (SELECT g.game_id, date, duration_minutes, winning_pitcher_id, losing_pitcher_id, save_pitcher_id, l.* EXCLUDE (game_id) FROM stg_games g LEFT JOIN game_line_scores l USING (game_id)), u AS (SELECT * FROM k UNION ALL BY NAME SELECT game_id, date, duration_minutes, home_runs_scored, away_runs_scored, home_line_score, away_line_score FROM stg_gamelog WHERE game_id NOT IN (SELECT game_id FROM k)),
d AS (SELECT u.*, i.season, i.game_type, i.home_team_id, i.away_team_id, s.date_resumed, s.game_id IS NOT NULL AS suspended, f.game_id IS NOT NULL AS forfeited, CASE WHEN f.winning_side IN ('Home', 'Away') THEN f.winning_side WHEN home_runs_scored > away_runs_scored THEN 'Home' WHEN home_runs_scored < away_runs_scored THEN 'Away' END AS w FROM u JOIN game_start_info i USING (game_id) LEFT JOIN game_suspensions s USING (game_id) LEFT JOIN game_forfeits f USING (game_id))
SELECT game_id, season, game_type, coalesce(date_resumed, date) AS game_finish_date, home_team_id, away_team_id, {_by("home_team_id", "away_team_id")} AS winning_team_id, {_by("away_team_id", "home_team_id")} AS losing_team_id, {_by("home_runs_scored", "away_runs_scored")} AS winning_team_score, {_by("away_runs_scored", "home_runs_scored")} AS losing_team_score, w AS winning_side, {_by("'Away'", "'Home'")} AS losing_side,
 forfeited AS forfeit_flag, suspended AS suspension_flag, w IS NULL AS tie_flag, winning_pitcher_id, losing_pitcher_id, save_pitcher_id, home_runs_scored, away_runs_scored, home_line_score, away_line_score, duration_minutes, duration_outs, coalesce(duration_outs BETWEEN 51 AND 54, true) AS is_nine_inning_game, coalesce(duration_outs > 54, false) AS is_extra_inning_game, coalesce(duration_outs < 51, false) AS is_shortened_game FROM d"""
SQL["game_scorekeeping"] = r"""WITH a AS (SELECT season, game_id, date, away_team_id, home_team_id, lower(trim(unnest(string_split_regex(CASE WHEN scorer IS NULL OR trim(scorer) = '' THEN 'unknown' ELSE scorer END, '[/&,]|( -(-?) )')))) AS s FROM stg_games),
x AS (SELECT * EXCLUDE (s), unnest(CASE WHEN s IN ('teams', 'both teams', 'both') THEN [CAST(away_team_id AS VARCHAR), CAST(home_team_id AS VARCHAR)] ELSE [s] END) AS raw_scorer FROM a),
n AS (SELECT x.*, coalesce(k.normalized_scorer, CAST(r.group_id AS VARCHAR), raw_scorer) AS cleaned_scorer FROM x LEFT JOIN seed_scorer_lookup k ON raw_scorer = lower(trim(k.scorer)) LEFT JOIN seed_scorer_numerical_ranges r ON regexp_full_match(raw_scorer, '[0-9]+') AND raw_scorer BETWEEN CAST(r.low AS VARCHAR) AND CAST(r.high AS VARCHAR) WHERE trim(raw_scorer) <> ''),
o AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY game_id, cleaned_scorer ORDER BY raw_scorer) = 1), p AS (SELECT *, 1 / count(*) OVER (PARTITION BY game_id) AS game_share FROM o)
SELECT *, count(*) OVER (PARTITION BY cleaned_scorer) AS scorer_game_count_raw, sum(game_share) OVER (PARTITION BY cleaned_scorer) AS scorer_game_count_weighted, CASE WHEN round(sum(game_share) OVER (PARTITION BY cleaned_scorer, away_team_id), 6) >= round(sum(game_share) OVER (PARTITION BY cleaned_scorer, home_team_id), 6) THEN away_team_id ELSE home_team_id END AS scorer_more_common_team_id FROM p"""
_both = ["league", "division", "franchise_id", "starting_pitcher_id"]
_view = lambda a, o: f"'{a.title()}' AS team_side, {a}_team_id AS team_id, {o}_team_id AS opponent_id, {a}_team_name AS team_name, {o}_team_name AS opponent_name, " + ", ".join(f"{a}_{c} AS {c}, {o}_{c} AS opponent_{c}" for c in _both)
_common = "game_id, date, season, doubleheader_status, game_type, park_id, source_type, is_interleague"
SQL["team_game_start_info"] = f"""WITH v AS (SELECT {_common}, {_view("home", "away")} FROM game_start_info UNION ALL BY NAME SELECT {_common}, {_view("away", "home")} FROM game_start_info),
s AS (SELECT *, first_value(game_id) OVER (PARTITION BY season, team_id, game_type, opponent_id ORDER BY date, doubleheader_status, game_id) AS series_id FROM v)
SELECT *, CAST(row_number() OVER w AS INTEGER) AS season_game_number, CAST(row_number() OVER (PARTITION BY team_id, series_id ORDER BY date, doubleheader_status, game_id) AS INTEGER) AS series_game_number, CAST(date_diff('day', lag(date) OVER w, date) AS INTEGER) AS days_since_last_game FROM s WINDOW w AS (PARTITION BY season, team_id, game_type ORDER BY date, doubleheader_status, game_id)"""
SQL["box_score_games"] = "SELECT game_id, date, season, doubleheader_status, game_type, park_id, attendance, use_dh, away_team_id, home_team_id, NULL::VARCHAR AS field_condition, NULL::VARCHAR AS precipitation, NULL::VARCHAR AS wind_direction, NULL::INTEGER AS temperature_fahrenheit, NULL::INTEGER AS wind_speed_mph FROM game_start_info WHERE source_type = 'GameLog'"
_inn = lambda s: f"SELECT game_id, '{s.title()}' AS side, unnest(regexp_extract_all({s}_line_score, '\\([0-9]+\\)|[0-9]|x')) AS token, unnest(range(1, 1 + len(regexp_extract_all({s}_line_score, '\\([0-9]+\\)|[0-9]|x')))) AS inning FROM stg_gamelog WHERE game_id NOT IN (SELECT game_id FROM stg_games)"
SQL["box_score_line_scores"] = f"SELECT game_id, side, CAST(inning AS INTEGER) AS inning, CAST(trim(token, '()') AS INTEGER) AS runs FROM ({_inn('away')} UNION ALL {_inn('home')}) WHERE token <> 'x'"
SQL["box_score_pitching_lines"] = "SELECT *, 1 AS nth_pitcher, NULL::INTEGER AS outs_recorded, NULL::INTEGER AS batters_faced, NULL::INTEGER AS hits, NULL::INTEGER AS runs, NULL::INTEGER AS walks, NULL::INTEGER AS strikeouts FROM (SELECT game_id, away_starting_pitcher_id AS pitcher_id, 'Away' AS side FROM game_start_info WHERE source_type = 'GameLog' UNION ALL SELECT game_id, home_starting_pitcher_id, 'Home' FROM game_start_info WHERE source_type = 'GameLog') WHERE pitcher_id IS NOT NULL"

# Roll-ups

_team = "CASE WHEN side = 'Home' THEN home_team_id ELSE away_team_id END"
_lines = ["at_bats", "hits", "doubles", "triples", "home_runs", "walks", "hit_by_pitches", "runs", "strikeouts", "singles", "total_bases", "plate_appearances", "on_base_successes", "on_base_opportunities", "batting_outs"]
SQL["player_game_offense_stats"] = f"SELECT game_id, team_id, player_id, {total(S.OFFENSE)} FROM event_offense_stats GROUP BY 1, 2, 3 UNION ALL BY NAME SELECT game_id, {_team} AS team_id, batter_id AS player_id, {total(_lines)} FROM stg_box_score_batting_lines JOIN stg_games USING (game_id) WHERE source_type = 'BoxScore' GROUP BY 1, 2, 3"
SQL["team_game_offense_stats"] = f"SELECT * REPLACE (left_on_base_with_two_outs AS left_on_base) FROM (SELECT game_id, team_id, {total(S.OFFENSE)} FROM player_game_offense_stats GROUP BY 1, 2)"
_pl = ["outs_recorded", "batters_faced", "hits", "doubles", "triples", "home_runs", "runs", "earned_runs", "walks", "strikeouts", "singles", "total_bases", "on_base_successes", "on_base_opportunities", "games_started", "games_relieved", "games_finished"]
SQL["player_game_pitching_stats"] = f"""WITH e AS (SELECT game_id, player_id, min(team_id) AS team_id, {total(S.PITCHING)} FROM event_pitching_stats GROUP BY 1, 2),
f AS (SELECT game_id, pitcher_id AS player_id, CAST(bool_or(starting_pitcher_flag) AS BIGINT) AS games_started, CAST(sum(inherited_runners) AS BIGINT) AS inherited_runners, CAST(sum(bequeathed_runners) AS BIGINT) AS bequeathed_runners, CAST(bool_or(new_relief_pitcher_flag) AS BIGINT) AS games_relieved, CAST(bool_or(pitcher_finish_flag) AS BIGINT) AS games_finished, count(*) FILTER (WHERE save_situation_start_flag) AS save_situations_entered, count(*) FILTER (WHERE hold_flag) AS holds, count(*) FILTER (WHERE blown_save_flag) AS blown_saves, CAST(bool_or(save_flag) AS BIGINT) AS saves_by_rule FROM event_pitching_flags GROUP BY 1, 2),
u AS (SELECT e.*, f.* EXCLUDE (game_id, player_id) FROM e LEFT JOIN f ON e.game_id = f.game_id AND e.player_id = f.player_id UNION ALL BY NAME SELECT game_id, pitcher_id AS player_id, min({_team}) AS team_id, {total(_pl)} FROM stg_box_score_pitching_lines JOIN stg_games USING (game_id) WHERE source_type = 'BoxScore' GROUP BY 1, 2),
n AS (SELECT u.* REPLACE (coalesce(r.earned_runs, u.earned_runs) AS earned_runs), {b("u.player_id = winning_pitcher_id")} AS wins, {b("u.player_id = losing_pitcher_id")} AS losses, {b("u.player_id = save_pitcher_id")} AS saves, round(outs_recorded / 3, 4) AS innings_pitched FROM u LEFT JOIN stg_games g ON g.game_id = u.game_id LEFT JOIN stg_game_earned_runs r ON r.game_id = u.game_id AND r.player_id = u.player_id),
w AS (SELECT *, saves + blown_saves AS save_opportunities, {b("count(*) OVER t = 1")} AS complete_games, {b("sum(runs) OVER t = 0 AND sum(outs_recorded) OVER t = outs_recorded")} AS shutouts, {b("games_started = 1 AND outs_recorded >= 18 AND earned_runs <= 3")} AS quality_starts, {b("games_started = 1 AND wins + losses = 0")} AS no_decisions FROM n WINDOW t AS (PARTITION BY team_id, game_id)),
z AS (SELECT *, {b("games_started = 1 AND quality_starts = 0 AND wins = 1")} AS cheap_wins, {b("quality_starts = 1 AND losses = 1")} AS tough_losses, {b("complete_games = 1 AND hits = 0 AND outs_recorded >= 27")} AS no_hitters FROM w)
SELECT game_id, player_id, team_id, innings_pitched, {", ".join([*S.PITCHING, *S.APPEARANCE, *[c for c in S.AWARDS if c != "perfect_games"]])}, {b("no_hitters = 1 AND (times_reached_base = 0 OR outs_recorded >= batters_faced AND coalesce(walks, 0) + coalesce(hit_by_pitches, 0) = 0)")} AS perfect_games FROM z"""
_pg = [*S.PITCHING, *S.APPEARANCE, *S.AWARDS]
SQL["team_game_pitching_stats"] = f"SELECT * REPLACE (greatest(0, earned_runs - team_unearned_runs) AS earned_runs, left_on_base_with_two_outs AS left_on_base, {b('hits = 0 AND outs_recorded >= 27')} AS no_hitters, {b('perfect_games = 1 OR outs_recorded >= 27 AND times_reached_base = 0')} AS perfect_games), earned_runs AS individual_earned_runs, round(outs_recorded / 3, 4) AS innings_pitched FROM (SELECT game_id, team_id, {total(_pg)} FROM player_game_pitching_stats GROUP BY 1, 2)"
SQL["player_game_appearances"] = f"""WITH ev AS (SELECT game_id FROM stg_games WHERE source_type = 'PlayByPlay'),
o AS (SELECT game_id, player_id, side, lineup_position, entered_game_as, start_event_id AS place FROM stg_game_lineup_appearances UNION ALL SELECT game_id, batter_id, side, lineup_position, CASE WHEN nth_player_at_position = 1 THEN 'Starter' WHEN (game_id, side, batter_id) IN (SELECT (game_id, side, pinch_hitter_id) FROM stg_box_score_pinch_hitting_lines) THEN 'PinchHitter' WHEN (game_id, side, batter_id) IN (SELECT (game_id, side, pinch_runner_id) FROM stg_box_score_pinch_running_lines) THEN 'PinchRunner' ELSE 'DefensiveSubstitution' END, nth_player_at_position FROM stg_box_score_batting_lines WHERE game_id NOT IN (SELECT game_id FROM ev)),
f AS (SELECT game_id, player_id, fielding_position, start_event_id AS place FROM stg_game_fielding_appearances UNION ALL SELECT game_id, fielder_id, fielding_position, nth_position_played_by_player FROM stg_box_score_fielding_lines WHERE game_id NOT IN (SELECT game_id FROM ev)),
a AS (SELECT game_id, player_id, min(side) AS side, {", ".join(f"CAST(bool_or(entered_game_as = '{v}') AS BIGINT) AS {n}" for n, v in (("games_started", "Starter"), ("games_pinch_hit", "PinchHitter"), ("games_pinch_run", "PinchRunner"), ("games_defensive_sub", "DefensiveSubstitution")))}, arg_min(lineup_position, (place, lineup_position)) AS lineup_position FROM o WHERE lineup_position > 0 GROUP BY 1, 2),
g AS (SELECT game_id, player_id, arg_min(fielding_position, (place, fielding_position)) AS first_fielding_position, string_agg(CAST(fielding_position AS VARCHAR), ',' ORDER BY place, fielding_position) AS fielding_positions, CAST(bool_or(fielding_position = 1 AND place = 1) AND bool_or(fielding_position = 10 AND place = 1) AS BIGINT) AS games_ohtani_rule FROM f WHERE fielding_position BETWEEN 1 AND 10 GROUP BY 1, 2)
SELECT a.*, first_fielding_position, fielding_positions, coalesce(games_ohtani_rule, 0) AS games_ohtani_rule FROM a LEFT JOIN g USING (game_id, player_id)"""
_plain = [c for c in _CREDITED if c not in (*_JUDGED, "outs_played", "passed_balls")]
_bx = ["outs_played", *_JUDGED, "passed_balls"]
SQL["player_position_game_fielding_stats"] = f"""WITH x AS (SELECT game_id, fielder_id AS player_id, fielding_position, min({_team}) AS team_id, CAST(sum(outs_played) AS BIGINT) AS outs_played, {", ".join(f"CAST(CASE WHEN bool_or({c} IS NULL) THEN NULL ELSE sum({c}) END AS BIGINT) AS {c}" for c in _bx[1:])} FROM stg_box_score_fielding_lines JOIN stg_games USING (game_id) GROUP BY 1, 2, 3),
e AS (SELECT game_id, player_id, fielding_position, min(team_id) AS team_id, {total(_CREDITED)} FROM event_player_fielding_stats GROUP BY 1, 2, 3),
j AS (SELECT game_id, player_id, fielding_position, coalesce(e.team_id, x.team_id) AS team_id, coalesce(e.outs_played, x.outs_played) AS outs_played, {each(_JUDGED, "CASE WHEN x.team_id IS NULL OR e.unknown_putouts_while_fielding = 0 THEN e.{0} ELSE x.{0} END")}, coalesce(x.passed_balls, e.passed_balls) AS passed_balls, {each(_plain, "e.{0}")}, x.putouts - e.putouts AS surplus_box_putouts, x.assists - e.assists AS surplus_box_assists, x.errors - e.errors AS surplus_box_errors FROM x FULL JOIN e USING (game_id, player_id, fielding_position))
SELECT j.*, CAST(CASE WHEN first_fielding_position = fielding_position OR games_ohtani_rule = 1 AND fielding_position IN (1, 10) THEN games_started ELSE 0 END AS BIGINT) AS games_started FROM j LEFT JOIN player_game_appearances USING (game_id, player_id)"""
_tg = ["outs_played", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", "putouts", "assists", "errors", "stolen_bases", "caught_stealing", "pickoffs", "double_plays", "triple_plays", "ground_ball_double_plays", "reaching_errors", "unknown_putouts", "incomplete_events"]
_pc = ["putouts", "assists", "errors", "fielders_choices", "assisted_putouts", "in_play_putouts", "in_play_assists", "passed_balls"]
_flip = "CASE WHEN running_side = 'Away' THEN 'Home' ELSE 'Away' END"
SQL["team_game_fielding_stats"] = f"""WITH g AS (SELECT game_id, team_id, {total(_tg)} FROM event_fielding_stats GROUP BY 1, 2), p AS (SELECT game_id, team_id, {total(_pc)} FROM player_position_game_fielding_stats GROUP BY 1, 2), sb AS (SELECT game_id, {_flip} AS side, count(*) AS n FROM stg_box_score_stolen_bases GROUP BY 1, 2), cs AS (SELECT game_id, {_flip} AS side, count(*) AS n FROM stg_box_score_caught_stealing GROUP BY 1, 2), dp AS (SELECT game_id, defense_side AS side, count(*) AS n FROM stg_box_score_double_plays GROUP BY 1, 2), tp AS (SELECT game_id, defense_side AS side, count(*) AS n FROM stg_box_score_triple_plays GROUP BY 1, 2),
i AS (SELECT game_id, season, team_id, team_side AS side FROM team_game_start_info)
SELECT season, game_id, team_id, coalesce(t.outs_played, g.outs_played, p.putouts) AS outs_played, {each(["putouts", "assists", "errors"], "greatest(t.{0}, p.{0}, g.{0})")}, {each(_pc[3:7], "p.{0}")}, coalesce(t.passed_balls, p.passed_balls) AS passed_balls, coalesce(g.stolen_bases, sb.n, 0) AS stolen_bases, coalesce(g.caught_stealing, cs.n, 0) AS caught_stealing, coalesce(g.double_plays, dp.n, 0) AS double_plays, coalesce(g.triple_plays, tp.n, 0) AS triple_plays,
 {each(["pickoffs", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", "ground_ball_double_plays", "reaching_errors", "unknown_putouts", "incomplete_events"], "g.{0}")} FROM p JOIN i USING (game_id, team_id) LEFT JOIN g USING (game_id, team_id) LEFT JOIN stg_box_score_team_fielding_lines t USING (game_id, side) LEFT JOIN sb USING (game_id, side) LEFT JOIN cs USING (game_id, side) LEFT JOIN dp USING (game_id, side) LEFT JOIN tp USING (game_id, side)"""
_cat = "CASE WHEN fielding_position = 1 THEN 'P' WHEN fielding_position = 2 THEN 'C' WHEN fielding_position IN (3, 4, 5, 6) THEN 'IF' WHEN fielding_position IN (7, 8, 9) THEN 'OF' WHEN fielding_position = 10 THEN 'DH' END AS fielding_position_category"
_dbf = ["games", "games_started", "outs_played", "putouts", "assists", "errors", "double_plays", "passed_balls", "stolen_bases", "caught_stealing"]
SQL["player_position_team_season_fielding_stats"] = f"""SELECT *, {_cat} FROM (SELECT season, team_id, player_id, fielding_position, game_type, count(*) AS games, {total(["games_started", *_CREDITED])}, count(*) FILTER (WHERE fielding_position = 7) AS games_left_field, count(*) FILTER (WHERE fielding_position = 8) AS games_center_field, count(*) FILTER (WHERE fielding_position = 9) AS games_right_field FROM player_position_game_fielding_stats JOIN (SELECT game_id, season, game_type FROM stg_games) USING (game_id) GROUP BY 1, 2, 3, 4, 5
 UNION ALL BY NAME SELECT season, team_id, player_id, coalesce(fielding_position, 0) AS fielding_position, 'RegularSeason' AS game_type, {total(_dbf)} FROM stg_databank_fielding WHERE season NOT IN (SELECT season FROM stg_games) GROUP BY 1, 2, 3, 4)"""
_ts = ["outs_played", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", "putouts", "assists", "errors", "fielders_choices", "reaching_errors", "stolen_bases", "caught_stealing", "pickoffs", "passed_balls", "double_plays", "triple_plays", "ground_ball_double_plays"]
SQL["team_season_fielding_stats"] = f"SELECT i.season, team_id, game_type, count(*) AS games, {total(_ts)} FROM game_start_info i JOIN (SELECT * EXCLUDE (season) FROM team_game_fielding_stats) USING (game_id) GROUP BY 1, 2, 3 UNION ALL BY NAME SELECT season, team_id, 'RegularSeason' AS game_type, CAST(sum(putouts) AS BIGINT) AS outs_played, {total(['putouts', 'assists', 'errors', 'passed_balls', 'stolen_bases', 'caught_stealing'])} FROM player_position_team_season_fielding_stats WHERE season NOT IN (SELECT season FROM game_start_info) GROUP BY 1, 2"


def _season_sql(per_game: str, stats: list[str], register: str, told: list[str], early: tuple[str, ...] = ()) -> str:
    pick = lambda c: f"CASE WHEN q.season < 1920 THEN coalesce(r.{c}, q.{c}) WHEN q.game_type = 'RegularSeason' THEN coalesce(q.{c}, r.{c}) ELSE q.{c} END AS {c}" if c in early else f"CASE WHEN q.game_type = 'RegularSeason' THEN coalesce(q.{c}, r.{c}) ELSE q.{c} END AS {c}"
    return f"""WITH q AS (SELECT i.season, p.team_id, p.player_id, i.game_type, count(DISTINCT p.game_id) AS games, {total(stats, "sum(p.{0})")} FROM {per_game} p JOIN game_start_info i USING (game_id) GROUP BY 1, 2, 3, 4), r AS (SELECT season, team_id, player_id, 'RegularSeason' AS game_type, {total(["games", *told])} FROM {register} GROUP BY 1, 2, 3)
SELECT q.* REPLACE ({", ".join(pick(c) for c in told)}) FROM q LEFT JOIN r USING (season, team_id, player_id, game_type) UNION ALL BY NAME SELECT r.* FROM r ANTI JOIN q USING (season, team_id, player_id, game_type)"""


SQL["player_team_season_offense_stats"] = _season_sql("player_game_offense_stats", S.OFFENSE, "stg_databank_batting", ["hits", "doubles", "triples", "home_runs", "walks", "stolen_bases", "caught_stealing"], ("stolen_bases", "caught_stealing"))
SQL["player_team_season_pitching_stats"] = "SELECT *, round(outs_recorded / 3, 4) AS innings_pitched FROM (" + _season_sql("player_game_pitching_stats", _pg, "stg_databank_pitching", ["wins", "losses", "earned_runs", "outs_recorded", "hits", "strikeouts", "walks"]) + ")"

# Analyses

_k = lambda c: f"coalesce({c}, false)"
_air, _gr = "batted_trajectory IN ('Fly', 'LineDrive', 'PopUp')", "batted_trajectory = 'GroundBall'"
_has = {f"has_{n}_{k}": _k(f"{c} AND {f}") for n, f in (("general_location", "batted_location_general IS NOT NULL"), ("depth", "batted_location_depth <> 'Unknown'"), ("angle", "batted_location_side <> 'Unknown'")) for k, c in (("groundball", _gr), ("airball", _air))}
SQL["event_completeness_batted_balls"] = f"SELECT *, has_batted_to_fielder OR has_general_location AS has_any_location FROM (SELECT event_key, {_k('batted_trajectory <> ' + repr('Unknown'))} AS has_trajectory, {_k('batted_location_general <> ' + repr('Unknown'))} AS has_general_location, {_k('batted_location_depth <> ' + repr('Unknown'))} AS has_depth, {_k('batted_location_side <> ' + repr('Unknown'))} AS has_angle, coalesce(batted_to_fielder <> 0 OR NOT is_in_play AND coalesce(batted_location_general <> 'Unknown', false), false) AS has_batted_to_fielder, {', '.join(f'{c} AS {n}' for n, c in _has.items())} FROM stg_events JOIN seed_plate_appearance_result_types USING ({_R}))"
SQL["event_completeness_fielding_credit"] = f"SELECT e.event_key, {', '.join(f'coalesce(has_fielder_{n}, true) AS has_fielder_{n}' for n in ('putouts', 'assists', 'errors'))} FROM stg_events e LEFT JOIN (SELECT event_key, NOT bool_or(fielding_position = 0 AND fielding_play = 'Putout') AS has_fielder_putouts, NOT bool_or(fielding_position = 0 AND fielding_play IN ('Putout', 'Assist')) AS has_fielder_assists, NOT bool_or(fielding_position = 0 AND fielding_play = 'Error') AS has_fielder_errors FROM stg_event_fielding_plays GROUP BY 1) f USING (event_key) WHERE {_R} IS NOT NULL"
SQL["event_completeness_pitches"] = f"SELECT e.event_key, count_balls IS NOT NULL AS has_count_balls, count_strikes IS NOT NULL AS has_count_strikes, count_balls IS NOT NULL AND count_strikes IS NOT NULL AS has_count, p.event_key IS NOT NULL AS has_pitches, coalesce(a, false) AS has_pitch_results, coalesce(t, false) AS has_strike_types FROM stg_events e LEFT JOIN (SELECT event_key, bool_and(category <> 'Unknown') AS a, bool_and(category <> 'Unknown' AND sequence_item <> 'StrikeUnknownType') AS t FROM stg_event_pitch_sequences JOIN seed_pitch_types USING (sequence_item) WHERE is_pitch GROUP BY 1) p USING (event_key) WHERE {_R} IS NOT NULL OR p.event_key IS NOT NULL"
_cr = [f"has_fielder_{n}" for n in ("putouts", "assists", "errors")]
_and = lambda cs: ", ".join(f"bool_and({c}) AS {c}" for c in cs)
SQL["game_data_completeness"] = f"""WITH bb AS (SELECT game_id, {", ".join(f"bool_and({c}) AS {n}" for n, c in BALL_FACTS.items())} FROM calc_batted_ball_type LEFT JOIN seed_plate_appearance_result_types USING ({_R}) GROUP BY 1), fc AS (SELECT game_id, {_and(_cr)} FROM stg_events LEFT JOIN event_completeness_fielding_credit USING (event_key) GROUP BY 1), pt AS (SELECT game_id, {_and(PITCH_FACTS)} FROM stg_events LEFT JOIN event_completeness_pitches USING (event_key) GROUP BY 1)
SELECT game_id, season, date, home_league AS league, source_type = 'PlayByPlay' AS has_play_by_play, source_type = 'BoxScore' AS has_box_score, {each([*BALL_FACTS, *_cr, *PITCH_FACTS], "coalesce({0}, false)")} FROM game_start_info LEFT JOIN bb USING (game_id) LEFT JOIN fc USING (game_id) LEFT JOIN pt USING (game_id)"""
SQL["player_game_data_completeness"] = f"""WITH e AS (SELECT game_id, event_key, 'BATTING' AS player_type, batter_id AS player_id FROM stg_events UNION ALL SELECT game_id, event_key, 'PITCHING', pitcher_id FROM stg_events), bb AS (SELECT e.game_id, player_type, player_id, {", ".join(f"coalesce(bool_and({c}), true) AS {n}" for n, c in BALL_FACTS.items())} FROM e LEFT JOIN calc_batted_ball_type c ON c.event_key = e.event_key LEFT JOIN seed_plate_appearance_result_types t ON t.{_R} = c.{_R} GROUP BY 1, 2, 3),
pt AS (SELECT e.game_id, player_type, player_id, {", ".join(f"coalesce(bool_and({c}), false) AS {c}" for c in PITCH_FACTS)} FROM e LEFT JOIN event_completeness_pitches USING (event_key) GROUP BY 1, 2, 3) SELECT game_id, player_type, player_id, {", ".join([*BALL_FACTS, *PITCH_FACTS])}, season, date, home_league AS league FROM bb JOIN pt USING (game_id, player_type, player_id) LEFT JOIN game_start_info USING (game_id)"""
SQL["player_completeness"] = f"SELECT player_id, player_type, count(*) AS total_games, {', '.join(f'count(*) FILTER (WHERE {c}) AS {c[4:]}' for c in [*BALL_FACTS, *PITCH_FACTS])} FROM player_game_data_completeness GROUP BY 1, 2"
_INP = f"""SELECT b.event_key, e.season, e.outs, e.base_state, b.baserunner, runner_id, coalesce(e.batted_to_fielder, -1) AS batted_to_fielder, coalesce(trajectory_broad_classification, 'Unknown') AS trajectory, bases_advanced, unforced_outs_on_basepaths, p.is_batting_out, e.{_R} AS res, e.outs_on_play FROM event_baserunning_stats b JOIN stg_events e ON e.event_key = b.event_key JOIN seed_plate_appearance_result_types p ON p.{_R} = e.{_R} AND p.is_in_play LEFT JOIN calc_batted_ball_type c ON c.event_key = b.event_key"""


def _above(rows: str, state: str, who: str, season: str) -> str:
    return f"""WITH d AS ({rows}), a AS (SELECT {state}, avg(bases_advanced) AS mb, avg(unforced_outs_on_basepaths) AS mo FROM d GROUP BY ALL), x AS (SELECT d.*, bases_advanced - mb AS ob, unforced_outs_on_basepaths - mo AS oo FROM d JOIN a USING ({state})), y AS (SELECT *, ob - avg(ob) OVER (PARTITION BY {season}) AS eb, oo - avg(oo) OVER (PARTITION BY {season}) AS eo FROM x)
SELECT {who}, count(DISTINCT event_key) AS plate_appearances, sum(eb) AS bases_aa, sum(eo) AS outs_aa, sum(eb) * 0.2 - sum(eo) * 0.42 AS run_value FROM y GROUP BY 1"""


SQL["runner_advance_expectancy"] = "SELECT *, run_value / plate_appearances * 100 AS run_value_per_100 FROM (" + _above(f"SELECT *, CASE WHEN is_batting_out THEN 'InPlayOut' ELSE res END AS play FROM ({_INP}) WHERE res <> 'GroundRuleDouble'", "base_state, outs, baserunner, batted_to_fielder, play, trajectory", "runner_id", "season, base_state, outs, baserunner, batted_to_fielder, play") + ")"
_fst = "base_state, outs, baserunner, batted_to_fielder, o, trajectory"
SQL["fielder_advance_expectancy"] = "SELECT *, " + ", ".join(f"{c} / plate_appearances AS {c}_per_pa" for c in ("bases_aa", "outs_aa", "run_value")) + " FROM (" + _above(f"SELECT i.*, f.player_id AS fielder_id, CASE WHEN res = 'ReachedOnError' OR res = 'FieldersChoice' AND outs_on_play = 0 THEN false ELSE is_batting_out END AS o FROM ({_INP}) i LEFT JOIN event_player_fielding_stats f ON f.event_key = i.event_key AND f.fielding_position = i.batted_to_fielder", _fst, "fielder_id", "season, " + _fst) + ") WHERE plate_appearances > 20"
SQL["hits_located"] = "SELECT e.*, c.batted_location_general, c.location_side, c.location_depth, c.batted_to_fielder, c.trajectory, h.batter_hand, h.pitcher_hand FROM event_offense_stats e JOIN calc_batted_ball_type c ON c.event_key = e.event_key JOIN event_states_batter_pitcher h ON h.event_key = e.event_key"
_spray = lambda keys, where: f"SELECT batter_hand, {keys}, at_bats, h / at_bats AS avg, h / nullif(sum(h) OVER (PARTITION BY batter_hand), 0) AS hit_share, o / nullif(sum(o) OVER (PARTITION BY batter_hand), 0) AS out_share FROM (SELECT batter_hand, {keys}, count(*) AS at_bats, sum(hits) AS h, sum(1 - hits) AS o FROM hits_located WHERE {where} GROUP BY ALL)"
SQL["hit_vs_out_spray"] = _spray("batted_location_general, location_side, location_depth", "trajectory_known = 1 AND bunts = 0 AND balls_in_play = 1")
SQL["hit_vs_out_spray_air"] = _spray("batted_to_fielder", "trajectory_broad_air_ball = 1 AND bunts = 0 AND balls_in_play = 1 AND fielded_by_outfielder = 1")
SQL["fielder_location_shares"] = "SELECT batter_hand, season > 2010 AS is_shift_era, base_state, outs < 2 AS under_two_outs, batted_location_general, location_side, location_depth, h.batted_to_fielder, trajectory, count(*) AS at_bats, sum(hits) / count(*) AS batting_average FROM hits_located h JOIN (SELECT event_key, season, base_state, outs FROM stg_events) USING (event_key) WHERE h.batted_to_fielder > 0 AND batted_location_general <> 'Unknown' AND batter_hand IS NOT NULL AND trajectory_known = 1 AND sacrifice_hits = 0 GROUP BY ALL"
SQL["outfield_hits"] = "SELECT batter_hand, pitcher_hand, batted_to_fielder, total_bases, count(*) AS hits, sum(trajectory_ground_ball) / count(*) AS hit_gb_rate FROM hits_located h WHERE h.hits = 1 AND fielded_by_outfielder = 1 AND bunts = 0 GROUP BY 1, 2, 3, 4"
SQL["most_blown_save_rbi"] = "SELECT player_id, count(*) AS n FROM event_offense_stats WHERE runs_batted_in > 0 AND event_key IN (SELECT event_key FROM event_pitching_flags WHERE blown_save_flag) GROUP BY 1"
_r2 = lambda x: f"CASE WHEN var_pop({x}) > 0 AND var_pop(h) > 0 THEN pow(covar_pop(h, {x}), 2) / (var_pop(h) * var_pop({x})) END"
SQL["ground_ball_hits"] = f"SELECT {_r2('i')} AS r2_infield, {_r2('o')} AS r2_outfield FROM (SELECT player_id, sum(hits) / count(*) AS h, sum(hits * fielded_by_infielder) / count(*) AS i, sum(hits * fielded_by_outfielder) / count(*) AS o FROM event_pitching_stats WHERE at_bats = 1 AND trajectory_ground_ball = 1 AND fielded_by_known = 1 GROUP BY 1 HAVING count(*) > 5)"
_gb = {"k_rate": ("strikeouts", "batters_faced"), "bb_rate": ("walks", "batters_faced"), "bip_rate": ("balls_in_play", "batters_faced"), "gb_rate": ("trajectory_ground_ball", "trajectory_known"), "air_ball_rate": ("trajectory_broad_air_ball", "trajectory_known"), "ld_rate": ("trajectory_line_drive", "trajectory_broad_air_ball"), "pu_rate": ("trajectory_pop_up", "trajectory_broad_air_ball"), "hr_rate": ("home_runs", "trajectory_broad_air_ball"), "pulled_gb": ("trajectory_ground_ball * batted_balls_pulled", "trajectory_ground_ball"), "oppo_gb": ("trajectory_ground_ball * batted_balls_opposite_field", "trajectory_ground_ball"), "middle_gb": ("trajectory_ground_ball * batted_angle_middle", "trajectory_ground_ball"), "weak": ("trajectory_ground_ball * fielded_by_battery", "trajectory_ground_ball"), "infield": ("infield_hits", "trajectory_ground_ball")}
_co = lambda x: f"covar_pop({x}, g) / nullif(sqrt(var_pop(CASE WHEN g IS NOT NULL THEN {x} END) * var_pop(CASE WHEN {x} IS NOT NULL THEN g END)), 0) AS {x}_corr"
SQL["gb_babip_correlations"] = f"SELECT count(*) AS n, {', '.join(_co(x) for x in _gb)} FROM (SELECT player_id, {rate('trajectory_ground_ball * hits', 'trajectory_ground_ball')} AS g, {', '.join(f'{rate(*r)} AS {n}' for n, r in _gb.items())} FROM event_pitching_stats WHERE batters_faced = 1 AND bunts = 0 GROUP BY 1 HAVING sum(trajectory_ground_ball) > 5)"
SQL["assists_as_putouts_finder"] = """WITH g AS (SELECT event_key FROM calc_fielding_play_agg GROUP BY 1 HAVING count(*) FILTER (WHERE fielding_position = 3 AND assisted_putouts = 1) = 1 AND sum(assists) = 1 AND count(*) = 2),
e AS (SELECT e.game_id, s.team_id, count(*) FILTER (WHERE e.batted_to_fielder BETWEEN 1 AND 6 AND e.outs_on_play = 1 AND e.batted_trajectory = 'Unknown' AND f.event_key IS NULL AND s.putouts - s.assisted_putouts = 1 AND e.base_state % 2 = 0) AS no_force_unmarked_popups, count(g.event_key) AS infield_conventional_groundouts FROM stg_events e JOIN event_fielding_stats s ON s.event_key = e.event_key LEFT JOIN stg_event_flags f ON f.event_key = e.event_key LEFT JOIN g ON g.event_key = e.event_key WHERE coalesce(f.flag, 'Foul') = 'Foul' GROUP BY 1, 2)
SELECT e.*, greatest(2 * no_force_unmarked_popups - infield_conventional_groundouts, no_force_unmarked_popups) AS rating, scorer, park_id FROM e JOIN stg_games USING (game_id) WHERE no_force_unmarked_popups > 0"""
SQL["box_event_fielding_discrepancies"] = """WITH i AS (SELECT game_id, CAST(sum(unknown_putouts) AS BIGINT) AS u FROM event_fielding_stats WHERE unknown_putouts > 0 GROUP BY 1), t AS (SELECT game_id, team_id, CAST(sum(abs(CASE WHEN u IS NOT NULL THEN least(surplus_box_putouts, 0) ELSE surplus_box_putouts END)) AS BIGINT) AS putout_discrepancy, CAST(sum(abs(CASE WHEN u IS NOT NULL THEN least(surplus_box_assists, 0) ELSE surplus_box_assists END)) AS BIGINT) AS assist_discrepancy, CAST(sum(abs(surplus_box_errors)) AS BIGINT) AS error_discrepancy, coalesce(max(u), 0) AS unknown_putouts FROM player_position_game_fielding_stats LEFT JOIN i USING (game_id) GROUP BY 1, 2)
SELECT t.*, putout_discrepancy + assist_discrepancy + error_discrepancy AS total, scorer, park_id FROM t JOIN stg_games USING (game_id) WHERE putout_discrepancy + assist_discrepancy + error_discrepancy > 0"""
SQL["putout_innings_gaps"] = "SELECT game_id, team_id, p.outs_recorded AS ip_outs, f.putouts, e.n AS event_putouts, p.outs_recorded - f.putouts AS diff, p.outs_recorded - e.n AS event_based_diff FROM team_game_pitching_stats p JOIN team_game_fielding_stats f USING (game_id, team_id) LEFT JOIN (SELECT game_id, team_id, CAST(sum(putouts) AS BIGINT) AS n FROM event_fielding_stats GROUP BY 1, 2) e USING (game_id, team_id) WHERE p.outs_recorded <> f.putouts"
SQL["located"] = "SELECT s.*, e.season, e.batting_team_id, e.base_state, e.runs_on_play, k.cleaned_scorer AS scorer, k.game_share, k.scorer_more_common_team_id AS t, CAST(e.season // 10 * 10 AS INTEGER) AS decade FROM event_offense_stats s JOIN stg_events e ON e.event_key = s.event_key LEFT JOIN game_scorekeeping k ON k.game_id = s.game_id"
_mineh, _oth = "CASE WHEN t = batting_team_id THEN hits ELSE 0 END", "CASE WHEN t <> batting_team_id THEN hits ELSE 0 END"
_contact = {"trajectory_known_hit_rate": ("trajectory_broad_known * hits", "hits"), "trajectory_known_affiliated_team_hit_rate": (f"{_mineh} * trajectory_broad_known", _mineh), "trajectory_known_opposing_team_hit_rate": (f"{_oth} * trajectory_broad_known", _oth), "trajectory_known_single_rate": ("singles * trajectory_broad_known", "singles"), "trajectory_known_double_rate": ("doubles * trajectory_broad_known", "doubles"), "trajectory_known_triple_rate": ("triples * trajectory_broad_known", "triples"), "hit_ground_ball_rate": ("trajectory_ground_ball * hits * balls_in_play", "trajectory_broad_known * hits * balls_in_play"), "out_ground_ball_rate": ("trajectory_ground_ball * (1 - hits)", "trajectory_broad_known * (1 - hits)"), "air_hit_line_drive_rate": ("trajectory_line_drive * hits * balls_in_play", "trajectory_broad_air_ball * hits * balls_in_play"), "air_out_line_drive_rate": ("trajectory_line_drive * (1 - hits)", "trajectory_broad_air_ball * (1 - hits)"), "air_hit_popup_rate": ("trajectory_pop_up * hits", "trajectory_broad_air_ball * hits"), "air_out_popup_rate": ("trajectory_pop_up * (1 - hits)", "trajectory_broad_air_ball * (1 - hits)"), "home_run_line_drive_rate": ("home_runs * trajectory_line_drive", "home_runs")}
SQL["scorekeeper_tendencies_contact"] = f"SELECT scorer, decade, CAST(sum(hits) AS BIGINT) AS n, CAST(sum(trajectory_broad_known * hits) AS BIGINT) AS hits_trajectory_known, CAST(sum(trajectory_broad_unknown * hits) AS BIGINT) AS hits_trajectory_unknown, {', '.join(f'{rate(*r)} AS {n}' for n, r in _contact.items())} FROM located WHERE balls_batted = 1 GROUP BY 1, 2"
_lk = "batted_location_known * hits"
_loc = {"location_known_hit_rate": (_lk, "hits"), "hits_location_infield_rate": ("batted_distance_infield * hits", _lk), "hits_location_outfield_rate": ("batted_distance_outfield * hits", _lk), "location_known_single_rate": ("singles * batted_location_known", "singles"), "location_known_double_rate": ("doubles * batted_location_known", "doubles"), "location_known_triple_rate": ("triples * batted_location_known", "triples"), "location_known_run_scoring_play_rate": (f"CASE WHEN runs_on_play > 0 THEN {_lk} ELSE 0 END", "CASE WHEN runs_on_play > 0 THEN hits ELSE 0 END"), "location_known_runners_on_base_rate": (f"CASE WHEN base_state > 0 THEN {_lk} ELSE 0 END", "CASE WHEN base_state > 0 THEN hits ELSE 0 END"), "known_location_pulled_rate": (f"batted_balls_pulled * {_lk}", _lk), "known_location_opposite_field_rate": (f"batted_balls_opposite_field * {_lk}", _lk)}
_loc |= {f"known_location_share_{n}": (f"batted_location_{n} * hits", f"batted_distance_{d} * hits") for d, ns in (("infield", ("left_infield", "middle_infield", "right_infield")), ("outfield", ("left_field", "center_field", "right_field"))) for n in ns}
SQL["scorekeeper_tendencies_location"] = f"SELECT scorer, decade, sum(game_share) AS plays, CAST(sum({_lk}) AS BIGINT) AS hits_location_known, CAST(sum(batted_location_unknown * hits) AS BIGINT) AS hits_location_unknown, {', '.join(f'{rate(*r)} AS {n}' for n, r in _loc.items())} FROM located WHERE balls_in_play = 1 GROUP BY 1, 2 HAVING sum({_lk}) > 5"
_bt = {"location_rate": ("batted_location_known", "1"), "trajectory_rate": ("trajectory_broad_known", "1"), "ground_ball_rate": ("trajectory_ground_ball", "trajectory_broad_known"), "line_drive_rate": ("trajectory_line_drive", "trajectory_broad_air_ball")}
_btr = ", ".join(f"{rate(*r)} AS {n}" for n, r in _bt.items())
SQL["scorekeeper_tendencies_batter"] = f"WITH r AS (SELECT o.*, e.season FROM event_offense_stats o JOIN stg_events e ON e.event_key = o.event_key WHERE singles = 1 AND bunts = 0), t AS (SELECT season, team_id, {_btr} FROM r GROUP BY 1, 2), p AS (SELECT season, team_id, player_id, count(*) AS hits_in_play, {_btr} FROM r WHERE balls_in_play = 1 GROUP BY 1, 2, 3) SELECT p.*, {', '.join(f'p.{n} - t.{n} AS {n}_diff' for n in _bt)} FROM p JOIN t USING (season, team_id)"
SQL["unknown_play_no_box"] = "SELECT t.*, season, scorer, park_id FROM (SELECT game_id, CAST(sum(unknown_putouts) AS BIGINT) AS unknown_putouts FROM calc_fielding_play_agg WHERE game_id NOT IN (SELECT game_id FROM stg_box_score_fielding_lines) GROUP BY 1 HAVING sum(unknown_putouts) > 0) t JOIN stg_games USING (game_id)"
SQL["unknown_plays"] = """WITH t AS (SELECT f.game_id, f.team_id, sum(putouts) AS p, sum(unknown_putouts) AS u, CASE WHEN f.team_id = g.home_team_id THEN 'Home' ELSE 'Away' END AS side FROM event_fielding_stats f JOIN stg_games g USING (game_id) GROUP BY ALL), r AS (SELECT *, sum(p - u) OVER w / nullif(sum(p) OVER w, 0) AS rate FROM t WINDOW w AS (PARTITION BY team_id, side)),
a AS (SELECT game_id, CAST(sum(u) AS BIGINT) AS total_unknown_putouts, max(rate) FILTER (WHERE side = 'Home') AS coverage_rate_home, max(rate) FILTER (WHERE side = 'Away') AS coverage_rate_away FROM r GROUP BY 1 HAVING sum(u) > 0) SELECT a.*, season, scorer, park_id FROM a JOIN stg_games USING (game_id)"""


_above_names = ["bases_aa", "outs_aa", "run_value"]
#: Fractions of each model, which both sides round.
# Values of states, and factors

SQL["run_expectancy_matrix"] = """SELECT run_expectancy_start_key AS run_expectancy_key, any_value(league_group) AS league_group, any_value(season_group) AS season_group, any_value(outs_start) AS outs, any_value(base_state_start) AS base_state, round(avg(r), 2) AS avg_runs_scored, round(coalesce(var_samp(r), 2), 0) AS variance_runs_scored, count(*) AS sample_size
FROM (SELECT *, CAST(sum(runs_on_play) OVER w AS BIGINT) AS r FROM event_states_full WHERE game_type = 'RegularSeason' AND inning_start < 9 WINDOW w AS (PARTITION BY game_id, frame_start, inning_start ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) QUALIFY NOT bool_or(truncated_frame_flag) OVER w) GROUP BY 1"""
SQL["win_expectancy_matrix"] = """WITH s AS (SELECT win_expectancy_start_key AS k, inning_group_start AS inning, frame_start AS frame, truncated_home_margin_start AS m, outs_start AS outs, base_state_start AS base_state, CASE WHEN home_margin_start = 0 THEN 0 WHEN home_margin_start BETWEEN 1 AND 3 THEN 1 WHEN home_margin_start BETWEEN 4 AND 6 THEN 2 WHEN home_margin_start > 6 THEN 3 WHEN home_margin_start BETWEEN -3 AND -1 THEN -1 WHEN home_margin_start BETWEEN -6 AND -4 THEN -2 ELSE -3 END AS bucket, base_state_start > 0 AS runners,
 last(score_home_end > score_away_end) OVER w AS won FROM event_states_full WHERE game_id IN (SELECT game_id FROM stg_games WHERE bat_first_side = 'Away') WINDOW w AS (PARTITION BY game_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) QUALIFY last(score_home_end <> score_away_end) OVER w AND last(inning_start) OVER w >= 9),
 a AS (SELECT k AS win_expectancy_key, inning, frame, m AS truncated_home_margin, outs, base_state, bucket, runners, sum(CAST(won AS INTEGER)) AS w, count(*) AS n FROM s GROUP BY ALL)
 SELECT win_expectancy_key, inning, frame, truncated_home_margin, outs, base_state, round((w + 10 * sum(w) OVER b / sum(n) OVER b) / (n + 10), 3) AS home_win_rate FROM a WINDOW b AS (PARTITION BY inning, frame, bucket, runners)"""
SQL["event_transition_values"] = """SELECT *, CASE batting_side WHEN 'Home' THEN expected_home_win_change ELSE -expected_home_win_change END AS expected_batting_win_change FROM (SELECT event_key, inning_start, frame_start, truncated_home_margin_start, base_state_start, outs_start, inning_end, frame_end, truncated_home_margin_end, base_state_end, outs_end, run_expectancy_start_key, run_expectancy_end_key, win_expectancy_start_key, win_expectancy_end_key, s.season, league, game_type, batting_side, runs_on_play, game_end_flag, round(runs_on_play + coalesce(rb.avg_runs_scored, 0) - ra.avg_runs_scored, 3) AS expected_runs_change,
 round(CASE WHEN game_end_flag AND truncated_home_margin_end > 0 THEN 1 - wa.home_win_rate WHEN game_end_flag THEN 0 - wa.home_win_rate ELSE wb.home_win_rate - wa.home_win_rate END, 3) AS expected_home_win_change FROM event_states_full s
 LEFT JOIN run_expectancy_matrix ra ON ra.run_expectancy_key = run_expectancy_start_key LEFT JOIN run_expectancy_matrix rb ON rb.run_expectancy_key = run_expectancy_end_key LEFT JOIN win_expectancy_matrix wa ON wa.win_expectancy_key = win_expectancy_start_key LEFT JOIN win_expectancy_matrix wb ON wb.win_expectancy_key = win_expectancy_end_key
 WHERE game_type = 'RegularSeason' AND NOT (game_end_flag AND truncated_home_margin_end = 0))"""
SQL["leverage_index"] = """WITH t AS (SELECT win_expectancy_start_key, win_expectancy_end_key, count(*) AS n, avg(abs(expected_home_win_change)) AS w, avg(abs(expected_runs_change)) AS r FROM event_transition_values GROUP BY 1, 2), a AS (SELECT win_expectancy_start_key, CAST(sum(n) AS BIGINT) AS agg_sample_size, sum(w * n) / sum(n) AS w, sum(r * n) / sum(n) AS r FROM t GROUP BY 1)
 SELECT win_expectancy_start_key, round(round(w, 9), 3) AS win_leverage_unscaled, round(round(r, 9), 3) AS run_leverage_unscaled, round(round(w / (SELECT sum(w * agg_sample_size) / sum(agg_sample_size) FROM a), 9), 2) AS win_leverage_index, round(round(r / (SELECT sum(r * agg_sample_size) / sum(agg_sample_size) FROM a), 9), 2) AS run_leverage_index, agg_sample_size FROM a"""


def _factor_sql(stats: list[str], size: str, keep: str = "true", hands: bool = False, odds: bool = True) -> str:
    every, h = [size, *stats], ", batter_hand" if hands else ""
    mean = lambda s, x: f"sum({x}{s} / {x}{size} * e) / sum(e)"
    ratio = "round(round((a_{0} / nullif(1 - a_{0}, 0)) / nullif(b_{0} / nullif(1 - b_{0}, 0), 0), 9), 2)" if odds else "round(round(a_{0} / nullif(b_{0}, 0), 9), 2)"
    return f"""WITH u AS (SELECT park_id, season, home_league AS league FROM game_start_info WHERE game_type = 'RegularSeason' GROUP BY 1, 2, 3 HAVING count(*) > 25),
l AS (SELECT s.park_id, s.season, s.league, s.batter_id, s.pitcher_id, min(batter_hand) AS batter_hand, {each(every, "sum(o.{0})")} FROM event_states_full s JOIN event_offense_stats o USING (event_key) JOIN u ON u.season = s.season AND u.league = s.league AND u.park_id = s.park_id WHERE game_type = 'RegularSeason' AND NOT is_interleague AND {keep}{" AND batter_hand IN ('L', 'R')" if hands else ""} GROUP BY 1, 2, 3, 4, 5 HAVING sum(o.{size}) > 0),
y AS (SELECT l.park_id, u.season, l.league, CAST(batter_id AS VARCHAR) AS batter_id, CAST(pitcher_id AS VARCHAR) AS pitcher_id{h}, {each(every, "CAST(sum(l.{0}) AS DOUBLE)")} FROM l JOIN u ON u.park_id = l.park_id AND u.league = l.league AND l.season BETWEEN u.season - 2 AND u.season GROUP BY ALL),
v AS (SELECT season, league{h}, {each(stats, f"sum({{0}}) / sum({size})")} FROM y GROUP BY ALL), x AS (SELECT * FROM y UNION ALL BY NAME SELECT park_id, season, league, 'prior' AS batter_id, 'prior' AS pitcher_id{h}, 1000.0 AS {size}, {each(stats, "1000.0 * {0}")} FROM u JOIN v USING (season, league)),
j AS (SELECT a.*, b.park_id AS other, {', '.join(f'b.{s} AS o_{s}' for s in every)}, sqrt(least(a.{size}, b.{size})) AS w FROM x a JOIN x b ON a.season = b.season AND a.batter_id = b.batter_id AND a.pitcher_id = b.pitcher_id AND a.park_id <> b.park_id{" AND a.batter_hand = b.batter_hand" if hands else ""}),
k AS (SELECT *, sum(w) OVER (PARTITION BY park_id, other, season, league) AS t FROM j), n AS (SELECT *, w * max(t) OVER (PARTITION BY park_id, season, league) / t AS e FROM k),
g AS (SELECT park_id, season, league{h}, round(sum(w), 0) AS sqrt_sample_size, {', '.join(f"{mean(s, '')} AS a_{s}, {mean(s, 'o_')} AS b_{s}" for s in stats)} FROM n GROUP BY ALL) SELECT park_id, season, league{h}, sqrt_sample_size, {', '.join(f"{ratio.format(s)} AS {s}_factor" for s in stats)} FROM g"""


SQL |= {f"park_factors_{name}": _factor_sql(**variant) for name, variant in FACTORS.items()}

FRACTIONS = {
    "runner_advance_expectancy": [*_above_names, "run_value_per_100"], "fielder_advance_expectancy": [*_above_names, *[f"{c}_per_pa" for c in _above_names]], "hit_vs_out_spray": ["avg", "hit_share", "out_share"], "hit_vs_out_spray_air": ["avg", "hit_share", "out_share"],
    "fielder_location_shares": ["batting_average"], "outfield_hits": ["hit_gb_rate"], "ground_ball_hits": ["r2_infield", "r2_outfield"], "gb_babip_correlations": [f"{x}_corr" for x in _gb], "scorekeeper_tendencies_contact": [*_contact], "scorekeeper_tendencies_location": ["plays", *_loc],
    "scorekeeper_tendencies_batter": [*_bt, *[f"{x}_diff" for x in _bt]], "unknown_plays": ["coverage_rate_home", "coverage_rate_away"], "game_scorekeeping": ["game_share", "scorer_game_count_weighted"], **{n: ["innings_pitched"] for n in ("player_game_pitching_stats", "team_game_pitching_stats", "player_team_season_pitching_stats")},
}


# Metric tables. What plays tell is written out for outs, hits and all plays.

_VIEW = {"_outs": "(at_bats - hits)", "_hits": "hits", "": "1"}


def _told_sql() -> dict[str, str]:
    part = lambda a, b: f"(CAST(sum({a}) AS DOUBLE) / nullif(sum({b}), 0))"
    out = {}
    for v, w in _VIEW.items():
        out[f"known_trajectory_rate{v}"] = part(f"trajectory_known * balls_batted * {w}", f"balls_batted * {w}")
        out[f"known_trajectory_broad_rate{v}"] = part(f"trajectory_broad_known * balls_batted * {w}", f"balls_batted * {w}")
        for n, c in (("angle_left", "batted_angle_left"), ("angle_right", "batted_angle_right"), ("angle_middle", "batted_angle_middle"), ("pulled", "batted_balls_pulled"), ("opposite_field", "batted_balls_opposite_field")):
            out[f"{n}_rate{v}"] = part(f"{c} * {w}", f"batted_angle_known * {w}")
    out["known_angle_rate"] = part("batted_angle_known", "balls_batted")
    out["known_angle_rate_outs"] = part("batted_angle_known * (at_bats - hits)", "balls_batted * (at_bats - hits)")
    out["known_angle_rate_hits"] = part("batted_angle_known * hits", "hits")
    for f in ("trajectory", "trajectory_broad", "angle"):
        out[f"known_{f}_out_hit_ratio"] = f"({out[f'known_{f}_rate_outs']} / nullif({out[f'known_{f}_rate_hits']}, 0))"
    for n in ("air_ball", "ground_ball"):
        out[f"{n}_rate_outs"] = part(f"trajectory_broad_{n} * (at_bats - hits)", "trajectory_broad_known * (at_bats - hits)")
        out[f"{n}_hit_rate"] = part(f"trajectory_broad_{n} * hits", "trajectory_broad_known * hits")
    out["ground_air_out_ratio"] = f"({out['ground_ball_rate_outs']} / nullif({out['air_ball_rate_outs']}, 0))"
    out["ground_air_hit_ratio"] = f"({out['ground_ball_hit_rate']} / nullif({out['air_ball_hit_rate']}, 0))"
    out |= {f"{n}_rate": part(f"trajectory_{n}", "trajectory_known") for n in ("fly_ball", "line_drive", "pop_up")}
    out["ground_ball_rate"] = part("trajectory_ground_ball", "trajectory_broad_known")
    weighted = [("trajectory_broad_air_ball", "air_ball", "trajectory_broad"), ("trajectory_ground_ball", "ground_ball", "trajectory_broad")]
    weighted += [(f"trajectory_{n}", n, "trajectory") for n in ("fly_ball", "line_drive", "pop_up")] + [(f"batted_angle_{a}", f"angle_{a}", "angle") for a in ("left", "right", "middle")]
    weighted += [(f"batted_balls_{d}", d, "angle") for d in ("pulled", "opposite_field")]
    for c, n, f in weighted:
        h, o, r = f"CAST(sum({c} * hits) AS BIGINT)", f"CAST(sum({c} * (at_bats - hits)) AS BIGINT)", out[f"known_{f}_out_hit_ratio"]
        out |= {f"sum_{c}_hits": h, f"sum_{c}_outs": o, f"coverage_weighted_{n}_batting_average": f"({h} * {r} / nullif({h} * {r} + {o}, 0))"}
    out |= {f"stolen_base_attempt_rate_{x}": part(f"stolen_bases_{x} + caught_stealing_{x}", f"stolen_base_opportunities_{x}") for x in ("second", "third", "home")}
    out["unforced_out_rate"] = part("unforced_outs_on_basepaths", "times_reached_base")
    shares = {"strike": "strikes", "contact": "swings_with_contact", "swing": "swings_with_contact + strikes_swinging", "ball": "balls", "swing_and_miss": "strikes_swinging", "foul": "strikes_foul"}
    out |= {f"pitch_{n}_rate": part(c, "pitches") for n, c in shares.items()}
    return out | {"pitched_called_strike_rate": part("strikes_called", "pitches"), "pitch_data_coverage_rate": part("CAST(pitches > 0 AS BIGINT)", "plate_appearances")}


for _kind, (_season_table, _event_table, _counters) in KINDS.items():
    _basic = {"offense": M.basic_offense, "pitching": M.basic_pitching, "fielding": M.basic_fielding}[_kind]()
    _rates = sport_text(_basic)
    _told = {} if _kind == "fielding" else _told_sql()
    for _grain, _keys in GRAINS.items():
        _k, _name = ", ".join(_keys), f"metrics_{_grain}_{_kind}"
        SQL[f"{_name}_own"] = f"""SELECT {_k}, sum(games) AS games, {", ".join(f"CAST(sum({c}) AS INTEGER) AS {c}" for c in _counters)}, {", ".join(f"{_rates[m.name]} AS {m.name}" for m in _basic)} FROM (SELECT s.*, coalesce(f.league, 'N/A') AS league
 FROM {_season_table} s LEFT JOIN seed_franchises f ON s.team_id = f.team_id AND s.season >= year(f.date_start) AND s.season <= coalesce(year(f.date_end), 9999) WHERE s.game_type IN (SELECT game_type FROM seed_game_types WHERE is_regular_season)) GROUP BY ALL"""
        SQL[f"{_name}_told"] = f"""SELECT {_k}, count(DISTINCT game_id) AS event_games{"".join(f", {t} AS {n}" for n, t in _told.items())} FROM (SELECT e.*, g.season AS season, g.league AS league FROM {_event_table} e LEFT JOIN team_game_start_info g ON g.team_id = e.team_id AND g.game_id = e.game_id
 WHERE e.game_id IN (SELECT game_id FROM game_start_info WHERE is_regular_season)) GROUP BY {_k}"""
        SQL[_name] = f"SELECT o.* EXCLUDE (games), t.* EXCLUDE ({_k}, event_games), coalesce(event_games / games, 0) AS event_coverage_rate FROM {_name}_own o LEFT JOIN {_name}_told t ON {' AND '.join(f'o.{k} = t.{k}' for k in _keys)}"
        FRACTIONS[_name] = [*[m.name for m in _basic], *[n for n in _told if not n.startswith("sum_")], "event_coverage_rate"]


# Results, standings and parks

_WHO = "PARTITION BY season, team_id, game_type ORDER BY game_finish_date NULLS FIRST, season_game_number NULLS FIRST, game_id"
SQL["team_game_results_own"] = f"""SELECT r.season, game_id, game_finish_date, s.team_id, s.opponent_id, r.game_type, team_side, league, division, opponent_league, opponent_division, season_game_number, s.is_interleague, duration_outs, {b('winning_team_id = s.team_id')} AS wins, {b('losing_team_id = s.team_id')} AS losses,
 CASE WHEN team_side = 'Home' THEN home_runs_scored ELSE away_runs_scored END AS runs_scored, CASE WHEN team_side = 'Home' THEN away_runs_scored ELSE home_runs_scored END AS runs_allowed FROM team_game_start_info s JOIN game_results r USING (game_id)"""
SQL["team_game_results_runs"] = f"SELECT *, CAST(row_number() OVER ({_WHO}) AS INTEGER) AS k, wins > 0 AS won, losses > 0 AS lost, coalesce(lag(wins > 0) OVER ({_WHO}), false) AS won_before, coalesce(lag(losses > 0) OVER ({_WHO}), false) AS lost_before FROM team_game_results_own"
_ids = ", ".join(f"CASE WHEN {x} THEN max(CASE WHEN {x} AND NOT {x}_before THEN k END) OVER (PARTITION BY season, team_id, game_type ORDER BY k) END AS {n}_streak_id" for x, n in (("won", "win"), ("lost", "loss")))
SQL["team_game_results_ids"] = f"SELECT *, {_ids} FROM team_game_results_runs"
_split = ", ".join(f"CAST(CASE WHEN {rule} THEN {kind} ELSE 0 END AS BIGINT) AS {split}_{kind}" for split, rule in SPLITS.items() for kind in ("wins", "losses"))
SQL["team_game_results"] = f"SELECT * EXCLUDE (k, won, lost, won_before, lost_before), {_split}, {', '.join(f'CAST(CASE WHEN {n}_streak_id IS NULL THEN 0 ELSE k - {n}_streak_id + 1 END AS INTEGER) AS {n}_streak_length' for n in ('win', 'loss'))} FROM team_game_results_ids"
_SUMS = ["wins", "losses", "runs_scored", "runs_allowed", *SPLIT_COUNTS]
_LAST = ["win_streak_length", "loss_streak_length", "last_10_wins", "last_10_losses"]
SQL["standings_games"] = "SELECT *, sum(wins) OVER w AS last_10_wins, sum(losses) OVER w AS last_10_losses FROM team_game_results WHERE game_type = 'RegularSeason' AND game_finish_date IS NOT NULL WINDOW w AS (PARTITION BY season, team_id ORDER BY season_game_number RANGE BETWEEN 9 PRECEDING AND CURRENT ROW)"
SQL["standings_days"] = f"SELECT season, team_id, game_finish_date AS date, {', '.join(f'sum({c}) AS {c}' for c in _SUMS)}, {', '.join(f'arg_max({c}, (season_game_number, game_id)) AS {c}' for c in _LAST)} FROM standings_games GROUP BY ALL"
SQL["standings_spine"] = """SELECT t.*, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT season, team_id, min(league) AS league, min(division) AS division, min(team_name) AS team_name FROM team_game_start_info WHERE game_type = 'RegularSeason' GROUP BY ALL) t
 JOIN (SELECT season, greatest(min(game_finish_date) - 1, make_date(season, 1, 1)) AS a, least(max(game_finish_date) + 1, make_date(season, 12, 31)) AS z FROM standings_games GROUP BY 1) USING (season)"""
SQL["standings_table"] = f"SELECT s.*, {', '.join(f'coalesce(sum({c}) OVER w, 0) AS {c}' for c in _SUMS)}, {', '.join(f'coalesce(last_value({c} IGNORE NULLS) OVER w, 0) AS {c}' for c in _LAST)} FROM standings_spine s LEFT JOIN standings_days d USING (season, team_id, date) WINDOW w AS (PARTITION BY s.season, s.team_id ORDER BY s.date)"
SQL["standings"] = f"""SELECT season, date, league, division, team_id, team_name, {total(["wins", "losses"], "{0}")}, wins / nullif(wins + losses, 0) AS win_percentage, greatest(0.0, (max(wins - losses) OVER (PARTITION BY season, league, division, date) - (wins - losses)) / 2) AS games_behind,
 runs_scored ^ 1.85 / nullif(runs_scored ^ 1.85 + runs_allowed ^ 1.85, 0) AS pythagorean_win_percentage, (runs_scored - runs_allowed) / nullif(wins + losses, 0) AS average_run_differential, CAST(win_streak_length AS INTEGER) AS win_streak_length, CAST(loss_streak_length AS INTEGER) AS loss_streak_length, {total([*_SUMS[2:], *_LAST[2:]], "{0}")} FROM standings_table"""
SQL["park_teams"] = "SELECT s.park_id, s.season, s.league, s.team_id, s.opponent_id, sum(r.runs_scored + r.runs_allowed) AS runs, sum(coalesce(r.duration_outs / 3, 18.0)) AS innings FROM team_game_start_info s JOIN team_game_results r USING (game_id, team_id) WHERE s.game_type = 'RegularSeason' AND NOT s.is_interleague GROUP BY ALL"
SQL["park_levels"] = "SELECT season, league, sum(runs) / nullif(sum(innings), 0) / nullif((SELECT sum(runs) / nullif(sum(innings), 0) FROM park_teams), 0) AS level FROM park_teams GROUP BY ALL"
SQL["park_rates"] = "SELECT p.*, greatest(0.1, least(1.0, sum(runs) OVER w / nullif(level, 0) / nullif(sum(innings) OVER w, 0))) AS rate, sum(innings) OVER w AS size FROM park_teams p JOIN park_levels USING (season, league) WINDOW w AS (PARTITION BY park_id, p.league, team_id, opponent_id ORDER BY p.season ROWS 2 PRECEDING)"
SQL["calc_park_factors_basic"] = "SELECT park_id, season, league, sum(w) AS sqrt_sample_size, sum(rate * w) / nullif(sum(w), 0) AS avg_this_runs_per_inning, sum(other * w) / nullif(sum(w), 0) AS avg_other_runs_per_inning, sum(rate * w) / nullif(sum(other * w), 0) AS basic_park_factor FROM (SELECT a.*, b.rate AS other, sqrt(least(a.size, b.size)) AS w FROM park_rates a JOIN park_rates b USING (season, league, team_id, opponent_id) WHERE a.park_id <> b.park_id) GROUP BY ALL"
SQL["park_factors"] = "SELECT b.season, b.park_id, b.league, basic_park_factor, a.* EXCLUDE (season, park_id, league, sqrt_sample_size), coalesce(runs_factor, basic_park_factor) AS overall_park_factor FROM calc_park_factors_basic b LEFT JOIN park_factors_outs a ON a.season = b.season AND a.park_id = b.park_id AND a.league = b.league"
FRACTIONS |= {"standings": ["win_percentage", "pythagorean_win_percentage", "average_run_differential"], "calc_park_factors_basic": ["sqrt_sample_size", "avg_this_runs_per_inning", "avg_other_runs_per_inning", "basic_park_factor"], "park_factors": ["basic_park_factor", "overall_park_factor"]}

SQL["box_score_data_issues"] = " UNION ALL ".join(f"SELECT 'stg_box_score_{k}_lines' AS source_table, game_id, {'batter' if k == 'batting' else 'pitcher'}_id AS player_id, '{n}' AS issue_type, CAST({x} AS BIGINT) AS value_a, CAST({y} AS BIGINT) AS value_b FROM stg_box_score_{k}_lines WHERE {x} > {y}" for k, n, x, y in LINE_ISSUES)
SQL["team_game_data_issues"] = """SELECT game_id, team_id, 'starting_pitcher_no_appearance' AS issue_type, 'recorded SP ' || p || ' never appeared in events' AS notes FROM (SELECT game_id, home_team_id AS team_id, home_starting_pitcher_id AS p FROM game_start_info UNION ALL SELECT game_id, away_team_id, away_starting_pitcher_id FROM game_start_info) s
 WHERE p IS NOT NULL AND game_id IN (SELECT game_id FROM stg_games WHERE source_type = 'PlayByPlay') AND NOT EXISTS (SELECT 1 FROM event_pitching_stats e WHERE e.game_id = s.game_id AND e.team_id = s.team_id AND e.player_id = s.p)"""
SQL["season_team_coverage"] = "SELECT season, team_id, min(league) AS league, CASE WHEN bool_and(source_type = 'PlayByPlay') THEN 'PlayByPlay' WHEN bool_and(source_type IN ('PlayByPlay', 'BoxScore')) THEN 'BoxScore' ELSE 'GameLog' END AS least_granular_source_type FROM team_game_start_info WHERE game_id NOT IN (SELECT game_id FROM game_forfeits) AND (game_type <> 'Exhibition' OR league IS NULL) GROUP BY ALL"
SQL["weight_plays"] = """SELECT event_key, CASE WHEN result_category = 'InPlayOut' AND outs_on_play > 1 THEN 'DoublePlay' ELSE result_category END AS play, 'BATTING' AS play_category FROM stg_events JOIN seed_result_categories USING (plate_appearance_result) WHERE event_key NOT IN (SELECT event_key FROM stg_event_baserunners WHERE baserunning_play_type IS NOT NULL)
 UNION ALL SELECT event_key, min(CASE WHEN is_out THEN result_category_out ELSE result_category_safe END), 'BASERUNNING' FROM stg_event_baserunners JOIN seed_baserunning_play_types USING (baserunning_play_type) WHERE event_key NOT IN (SELECT event_key FROM stg_events WHERE plate_appearance_result IS NOT NULL) GROUP BY 1 HAVING count(*) = 1"""
SQL["weight_values"] = "SELECT season, league, play, play_category, expected_runs_change AS r, expected_batting_win_change AS w FROM weight_plays JOIN event_transition_values USING (event_key)"
SQL["weight_own"] = """SELECT v.*, a.r_all, a.w_all, false AS is_imputed FROM (SELECT season, league, play, min(play_category) AS play_category, avg(r) AS r_own, stddev_samp(r) AS r_dev, avg(w) AS w_own, stddev_samp(w) AS w_dev FROM weight_values GROUP BY ALL HAVING count(*) > 100) v
 JOIN (SELECT season, league, avg(r) AS r_all, avg(w) AS w_all FROM weight_values GROUP BY ALL) a ON v.season = a.season AND v.league IS NOT DISTINCT FROM a.league"""
SQL["weight_rest"] = """SELECT l.season, l.league, g.*, (SELECT avg(r) FROM weight_values) AS r_all, (SELECT avg(w) FROM weight_values) AS w_all, true AS is_imputed FROM (SELECT DISTINCT season, league FROM team_game_results WHERE league IS NOT NULL) l
 CROSS JOIN (SELECT play, min(play_category) AS play_category, avg(r) AS r_own, stddev_samp(r) AS r_dev, avg(w) AS w_own, stddev_samp(w) AS w_dev FROM weight_values GROUP BY 1) g WHERE NOT EXISTS (SELECT 1 FROM weight_own o WHERE o.season = l.season AND o.league = l.league AND o.play = g.play)"""
SQL["linear_weights"] = """SELECT season, coalesce(league, 'N/A') AS league, play, play_category, round(round(r_own - r_all, 9), 3) AS average_run_value, round(round(w_own - w_all, 9), 3) AS average_win_value, r_own - max(CASE WHEN play = 'InPlayOut' THEN r_own END) OVER (PARTITION BY season, league) AS relative_run_value,
 round(round(r_dev, 9), 3) AS std_dev_run_value, round(round(w_dev, 9), 3) AS std_dev_win_value, is_imputed FROM (SELECT * FROM weight_own UNION ALL BY NAME SELECT * FROM weight_rest)"""
SQL["share_rates"] = "SELECT fielding_position, sum(putouts - assisted_putouts) / nullif(sum(putouts), 0) AS rate FROM calc_fielding_play_agg WHERE event_key IN (SELECT event_key FROM stg_events WHERE plate_appearance_result = 'InPlayOut' AND batted_to_fielder > 0 AND outs_on_play = 1) GROUP BY 1"
SQL["share_teams"] = """SELECT *, greatest(sum(surplus_box_putouts) OVER w, 0) AS s_all, greatest(sum(CASE WHEN fielding_position > 6 THEN surplus_box_putouts END) OVER w, 0) AS s_of, greatest(sum(CASE WHEN fielding_position < 6 THEN surplus_box_assists END) OVER w, 0) AS s_as FROM player_position_game_fielding_stats
 WHERE (game_id, team_id) IN (SELECT (game_id, team_id) FROM team_game_fielding_stats WHERE unknown_putouts > 0) WINDOW w AS (PARTITION BY game_id, team_id)"""
SQL["share_parts"] = "SELECT t.*, greatest(s_all - s_of - s_as, 0) AS s_left, greatest(CASE WHEN fielding_position <= 6 AND greatest(s_all - s_of - s_as, 0) > 0 THEN surplus_box_putouts / greatest(s_all - s_of - s_as, 0) ELSE 0 END * rate, 0) AS part FROM share_teams t JOIN share_rates USING (fielding_position)"
SQL["share_plays"] = """SELECT *, greatest(CASE WHEN fielding_position > 6 THEN surplus_box_putouts ELSE coalesce(part / nullif(sum(part) OVER (PARTITION BY game_id, team_id), 0), 0) * s_left END, 0) AS p, greatest(CASE WHEN fielding_position > 6 THEN 0 ELSE surplus_box_assists END, 0) AS a FROM share_parts"""
SQL["unknown_fielding_play_shares"] = "SELECT game_id, team_id, fielding_position, player_id, CAST(p + a AS DOUBLE) AS estimated_unknown_plays, CAST(sum(p + a) OVER w AS DOUBLE) AS estimated_unknown_plays_team, (p + a) / sum(p + a) OVER w AS play_share, a / sum(p + a) OVER w AS play_share_subset_assists, p / sum(p + a) OVER w AS play_share_subset_putouts FROM share_plays WHERE p + a > 0 WINDOW w AS (PARTITION BY game_id, team_id)"
FRACTIONS |= {"linear_weights": ["relative_run_value"], "unknown_fielding_play_shares": ["estimated_unknown_plays", "estimated_unknown_plays_team", "play_share", "play_share_subset_assists", "play_share_subset_putouts"]}

# Learning from plays

SQL["outcome_plays"] = """SELECT e.event_key, e.game_id, greatest(1913, e.season) AS weigh_season, e.batting_side, sum(e.runs_on_play) OVER (PARTITION BY e.game_id, e.inning, e.batting_side ORDER BY e.event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS runs_following, c.result_category, t.is_in_play, bb.trajectory, bb.location_depth, bb.location_side
 FROM stg_events e LEFT JOIN seed_plate_appearance_result_types t USING (plate_appearance_result) LEFT JOIN seed_result_categories c USING (plate_appearance_result) LEFT JOIN calc_batted_ball_type bb USING (event_key)"""
SQL["outcome_runners"] = "SELECT event_key, arg_min(r, (priority, r)) AS ran FROM (SELECT event_key, priority, CASE WHEN is_out THEN result_category_out ELSE result_category_safe END AS r FROM stg_event_baserunners JOIN seed_baserunning_play_types USING (baserunning_play_type)) GROUP BY 1"
SQL["outcome_rows"] = f"""SELECT event_key, {b('result_category IS NOT NULL')} AS outcome_has_batting_bin, {b('is_in_play')} AS outcome_is_in_play_bin, coalesce(trajectory, 'Other') AS outcome_batted_trajectory_cat, coalesce(location_depth || '-' || location_side, 'Other') AS outcome_batted_location_cat, coalesce(result_category, 'Other') AS outcome_plate_appearance_cat,
 coalesce(ran, 'Other') AS outcome_baserunning_cat, CAST(runs_following AS DOUBLE) AS outcome_runs_following_num, {b('winning_side = batting_side')} AS outcome_is_win_bin, {b("trajectory <> 'Unknown'")} AS known_contact, {b("location_depth <> 'Unknown' AND location_side <> 'Unknown'")} AS known_location, {b('winning_side IS NOT NULL')} AS full_game, 1.0::DOUBLE / count(*) OVER (PARTITION BY weigh_season) AS factor
 FROM outcome_plays LEFT JOIN outcome_runners USING (event_key) JOIN game_results USING (game_id) WHERE result_category IS NOT NULL OR ran IS NOT NULL"""
_weighed = {n: f"factor * ({r.lstrip('_') if r.startswith('_') else r})" for n, r in WEIGHTS.items()}
SQL["ml_event_outcomes"] = f"SELECT event_key, {', '.join(f'outcome_{n}' for n in OUTCOMES)}, factor / nullif(avg(factor) OVER (), 0) AS generic_sample_weight, {', '.join(f'{x} / nullif(avg({x}) OVER (), 0) AS {n}_sample_weight' for n, x in _weighed.items())} FROM outcome_rows"
_runner = lambda base: f"coalesce(CAST(runner_{base}_id_start AS VARCHAR), 'N/A') AS runner_{base}_player"
SQL["ml_known"] = f"""SELECT e.event_key, CAST(e.season AS DOUBLE) AS season_num, CAST(dayofyear(e.date) AS DOUBLE) AS day_of_year_num, CAST(least(inning_start, 10) AS DOUBLE) AS inning_num, CAST(CASE WHEN frame_start = 'Top' THEN 0 ELSE 1 END AS DOUBLE) AS frame_num, CAST(CASE WHEN time_of_day = 'Night' THEN 1 ELSE 0 END AS DOUBLE) AS is_night_game_num,
 CAST(CASE WHEN batting_side = 'Home' THEN score_home_start ELSE score_away_start END AS DOUBLE) AS score_batting_team_num, CAST(CASE WHEN batting_side = 'Home' THEN score_away_start ELSE score_home_start END AS DOUBLE) AS score_fielding_team_num, e.park_id AS park_cat, e.game_type AS game_type_cat, coalesce(e.league, 'None') AS league_cat, CAST(base_state_start AS VARCHAR) AS base_state_cat, CAST(batter_id AS VARCHAR) AS batter_player,
 {', '.join(map(_runner, BASES))}, CAST(pitcher_id AS VARCHAR) AS pitcher_player, CASE WHEN ('0x' || substr(md5(CAST(e.game_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 98 THEN 'TRAIN' ELSE 'TEST' END AS meta_train_test_split FROM event_states_full e"""
SQL["ml_features"] = "SELECT o.*, k.* EXCLUDE (event_key) FROM ml_event_outcomes o LEFT JOIN ml_known k ON o.event_key = k.event_key"
FRACTIONS |= {n: ["generic_sample_weight", *[f"{w}_sample_weight" for w in WEIGHTS]] for n in ("ml_event_outcomes", "ml_features")}


def oracle(name: str) -> str:
    """A model's SQL behind everything it reads."""
    known = RAW | SQL
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in order:
            for word in sorted(set(re.findall(r"\w+", known[n])) & known.keys() - {n}):
                visit(word)
            order.append(n)

    visit(name)
    text = {n: RAW[n].format(**{g: g for g in GIVEN}) if n in RAW else SQL[n] for n in order}
    rounded = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in FRACTIONS.get(name, []))
    return "WITH " + ", ".join(f"{n} AS ({text[n]})" for n in order) + f" SELECT *{f' REPLACE ({rounded})' if rounded else ''} FROM {name}"


_stores: dict[tuple[str, str], Store] = {}


class _Raw(dict):
    """Raw tables, planned when asked for."""

    def __init__(self, t):
        super().__init__()
        self.spark, self.given = t.spark, {g: getattr(t, g) for g in GIVEN}

    def __missing__(self, name: str):
        self[name] = self.spark.sql(RAW[name], **{g: df for g, df in self.given.items() if "{" + g + "}" in RAW[name]})
        return self[name]

    def __contains__(self, name) -> bool:
        return dict.__contains__(self, name) or name in RAW


def _store(t) -> Store:
    """The written models of a folder, for as long as a session reads it."""
    key = t.spark.sparkContext.applicationId, t.sf_dir
    if key not in _stores:
        for old in [k for k in _stores if k[0] != key[0]]:
            del _stores[old]
        _stores[key] = Store(t.spark, new_dir(t.spark, "models"), _Raw(t))
    return _stores[key]


def _plain(df):
    return df.selectExpr(*[f"round(`{c}`, 6) AS `{c}`" if k == "double" else f"`{c}`" for c, k in df.dtypes])


for _name in MODELS:
    if _name in SQL:
        probe(f"mdl_{_name}", oracle(_name))(lambda t, n=_name: _plain(_store(t).plan(n)))


_scored: dict[tuple[str, str], DataFrame] = {}


def _predictions(t) -> DataFrame:
    """All eight predictions of every play, by models fitted on the games to learn from, stored, and read again. Made once for a folder."""
    key = t.spark.sparkContext.applicationId, t.sf_dir
    if key not in _scored:
        rows, sides = _store(t).ml_features, (NUMBERS, CATEGORIES, PLAYERS)
        train = rows.where("meta_train_test_split = 'TRAIN'")
        told = train.agg(F.hex(F.bit_xor(F.xxhash64("event_key")))).first()[0]
        folder, run_id = new_dir(t.spark, "fitted"), f"run-{told or 0}"
        ML.fit_targets(train, TARGETS, *sides, run_id).save(folder)
        fitted = ML.Fitted.load(t.spark, folder, run_id)
        _scored[key] = written(ML.score_targets(rows, fitted, "event_key", *sides).withColumn("model_run_id", F.lit(run_id)), "predictions")
    return _scored[key]


for _target in TARGETS:
    probe(f"predictions_{_target.name}")(lambda t, n=_target.name: _predictions(t).select("event_key", f"{n}.*", "model_run_id"))
