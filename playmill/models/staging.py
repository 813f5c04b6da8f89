"""Staging models: raw tables renamed, cast and given what follows from each row alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import windows as W
from .catalogue import MODELS, flag, model

E = F.expr


@model
def stg_events(m) -> DataFrame:
    """Plays with a season, the number of runners, and the sides in the game."""
    return m.raw_events.withColumns({"runners_count": F.bit_count("base_state").cast("long"), "date": F.to_date("ts"), "event_key": F.col("event_id")}).drop("ts")


@model
def stg_event_baserunners(m) -> DataFrame:
    """The batter and each runner of a play, the plays that put them on base and that they are charged to, a bit for the base they come from and numbers for both bases."""
    bit = E("CASE baserunner WHEN 'First' THEN 1 WHEN 'Second' THEN 2 WHEN 'Third' THEN 4 ELSE 0 END")
    number = E("CASE baserunner WHEN 'Batter' THEN 0 WHEN 'First' THEN 1 WHEN 'Second' THEN 2 ELSE 3 END")
    to = E("CASE attempted_advance_to_base WHEN 'First' THEN 1 WHEN 'Second' THEN 2 WHEN 'Third' THEN 3 WHEN 'Home' THEN 4 END")
    return m.raw_event_baserunners.withColumns({"baserunner_bit": bit, "number_base_from": number, "number_base_to": to, "advanced_on_error_flag": E("coalesce(advanced_on_error_flag, false)"), "explicit_out_flag": E("coalesce(explicit_out_flag, false)"),
        "is_advance_attempt": F.col("attempted_advance_to_base").isNotNull(), **{f"{n}_event_key": F.col("event_key") - F.col("event_id") + F.col(f"{n}_event_id") for n in ("reached_on", "charge")}})


@model
def stg_event_comments(m) -> DataFrame:
    """Distinct comments that say something."""
    return m.raw_event_comments.where("comment IS NOT NULL").distinct()


@model
def stg_rosters(m) -> DataFrame:
    """Rosters with sentinels as nulls, one row a player, team and year."""
    none = lambda c: F.nullif(F.col(c), F.lit("?"))
    clean = m.raw_rosters.withColumns({"bats": none("bats"), "throws": none("throws")})
    return W.dedupe(clean, ["year", "team_id", "player_id"], [F.col("bats").asc_nulls_last(), F.col("throws").asc_nulls_last(), "line"]).drop("line")


#: Other columns of a person's record and what they are called here.
BIO = {"last": "last_name", "first": "official_name", "nickname": "first_name", "deathdate": "death_date", "cemetary": "cemetery_name", "birth_name": "birth_name", "name_chg": "name_change_notes", "bat_chg": "batting_hand_change_notes", "hof": "hall_of_fame_status"}
BIO |= {f"{kind}_{x}": f"{kind}_{x}" for kind in ("birth", "death") for x in ("city", "state", "country")} | {f"ceme_{x}": f"cemetery_{x}" for x in ("city", "state", "country", "note")}
BIO |= {f"{role}_{end}": f"{name}_{'debut' if end == 'debut' else 'last_game'}_date" for role, name in (("play", "player"), ("mgr", "manager"), ("coach", "coach"), ("ump", "umpire")) for end in ("debut", "lastgame")}


@model
def stg_bio(m) -> DataFrame:
    """People with heights told as feet-inches turned to inches, and dates from texts."""
    feet, inches = (F.regexp_extract("height", r"^(\d+)-(\d+)$", k) for k in (1, 2))
    inch = F.when(feet != "", feet.cast("long") * 12 + inches.cast("long"))
    body = [inch.alias("height_inches"), F.col("weight").cast("long").alias("weight_pounds"), F.to_date("born", "yyyyMMdd").alias("birth_date"), *[F.nullif(h, F.lit("")).alias(h) for h in ("bats", "throws")]]
    return m.raw_bio.select("player_id", *body, *[F.col(old).alias(new) for old, new in BIO.items()])


@model
def stg_box_score_batting_lines(m) -> DataFrame:
    """Batting lines with what follows from them; a counter that needs an unknown one is unknown."""
    singles, bases = E("hits - doubles - triples - home_runs"), E("hits + doubles + 2 * triples + 3 * home_runs")
    return m.raw_box_batting.withColumns({
        "singles": singles, "total_bases": bases, "plate_appearances": E("at_bats + coalesce(walks, 0) + coalesce(hit_by_pitches, 0)"), "on_base_successes": E("hits + walks + coalesce(hit_by_pitches, 0)"),
        "on_base_opportunities": E("at_bats + walks + coalesce(hit_by_pitches, 0)"), "batting_outs": E("at_bats - hits"),
    })


@model
def stg_box_score_pitching_lines(m) -> DataFrame:
    """Pitching lines with starts, relief and the last pitcher of a side marked."""
    last = F.max("nth_pitcher").over(W.over(["game_id", "side"]))
    return m.raw_box_pitching.withColumns({
        "games_started": flag("nth_pitcher = 1"), "games_relieved": flag("nth_pitcher > 1"), "games_finished": flag(F.col("nth_pitcher") == last), "singles": E("hits - doubles - triples - home_runs"),
        "total_bases": E("hits + doubles + 2 * triples + 3 * home_runs"), "on_base_successes": E("hits + walks"), "on_base_opportunities": E("batters_faced"),
    })


@model
def stg_databank_batting(m) -> DataFrame:
    """Season batting by player and team with derived totals; team codes of the register become ours."""
    return m.raw_databank_batting.join(m.team_crosswalk, "register_team").drop("register_team").withColumns({"singles": E("hits - doubles - triples - home_runs"), "total_bases": E("hits + doubles + 2 * triples + 3 * home_runs")})


@model
def stg_databank_pitching(m) -> DataFrame:
    return m.raw_databank_pitching.join(m.team_crosswalk, "register_team").drop("register_team")


@model
def stg_databank_fielding(m) -> DataFrame:
    """Season fielding with numbered positions and their category; outfielders have no single position."""
    number = E("CASE pos WHEN 'P' THEN 1 WHEN 'C' THEN 2 WHEN '1B' THEN 3 WHEN '2B' THEN 4 WHEN '3B' THEN 5 WHEN 'SS' THEN 6 END")
    return m.raw_databank_fielding.withColumns({"fielding_position": number, "register_category": E("CASE WHEN pos IN ('P', 'C', 'OF') THEN pos ELSE 'IF' END")})


@model
def stg_gamelog(m) -> DataFrame:
    """The game log with ids made of their parts, codes spelt out, and blank texts as nulls."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return m.raw_gamelog.withColumns({"doubleheader_status": F.col("double_header").cast("long"), "season": F.year("date"), "forfeit_info": blank("forfeit"), "park_id": blank("park"), "source_type": F.lit("GameLog"), "game_type": E("CASE kind WHEN 'R' THEN 'RegularSeason' ELSE 'Postseason' END"), "use_dh": F.lit(None).cast("boolean")}).drop("double_header", "forfeit", "park", "kind")


_GAME_PLAYER = "game_id player_id side"
_PERSON = "id:person_id lastname:last_name firstname:first_name first_g:first_game_date last_g:last_game_date"
_STEAL = "game_id running_side runner_id pitcher_id catcher_id inning"
#: Models that name the columns of a raw table: old:new where the name changes, name::type where the type does.
NAMED = {
    "stg_coaches": ("raw_coaches", "id:person_id year team:team_id role start_date end_date"),
    "stg_ejections": ("raw_ejections", "game_id date:game_date double_header:doubleheader_status ejectee:ejectee_id ejectee_name team:team_id job:ejectee_role umpire:umpire_id umpire_name inning reason"),
    "stg_managers": ("raw_managers", _PERSON),
    "stg_umpires": ("raw_umpires", _PERSON),
    "stg_relatives": ("raw_relatives", "id1:person_id relation id2:related_person_id"),
    "stg_teams_master": ("raw_teams_master", "team:team_id league city nickname first_year last_year"),
    "stg_parks": ("raw_parks", "park_id name aka city state start_date end_date league notes"),
    "stg_schedule": ("raw_schedule", "date double_header day_of_week visiting_team visiting_team_league visiting_team_game_number home_team home_team_league home_team_game_number day_night postponement_indicator makeup_dates park_id"),
    "stg_databank_fielding_of": ("raw_databank_fielding_of", "player_id:databank_player_id year_id:season stint g_lf:games_left_field g_cf:games_center_field g_rf:games_right_field"),
    "stg_box_score_comments": ("raw_box_score_comments", "game_id comment"),
    "stg_box_score_double_plays": ("raw_box_score_double_plays", "game_id defense_side fielders"),
    "stg_box_score_triple_plays": ("raw_box_score_triple_plays", "game_id defense_side fielders"),
    "stg_box_score_stolen_bases": ("raw_box_score_stolen_bases", _STEAL),
    "stg_box_score_hit_by_pitches": ("raw_box_score_hit_by_pitches", "game_id pitching_side pitcher_id batter_id"),
    "stg_box_score_home_runs": ("raw_box_score_home_runs", "game_id batting_side batter_id pitcher_id inning runners_on outs"),
    "stg_box_score_line_scores": ("raw_box_score_line_scores", "game_id side:batting_side inning runs"),
    "stg_box_score_pinch_running_lines": ("raw_box_score_pinch_running_lines", "game_id pinch_runner_id inning side runs stolen_bases caught_stealing"),
    "stg_box_score_fielding_lines": ("raw_box_score_fielding_lines", "game_id side fielder_id fielding_position nth_position_played_by_player outs_played putouts assists errors double_plays triple_plays passed_balls"),
    "stg_box_score_team_batting_lines": ("raw_box_score_team_batting_lines", "game_id side at_bats::long runs::long hits::long rbi::long hit_by_pitch:hit_by_pitches:long walks::long strikeouts::long"),
    "stg_box_score_team_fielding_lines": ("raw_box_score_team_fielding_lines", "game_id side outs_played putouts assists errors passed_balls"),
    "stg_box_score_team_miscellaneous_lines": ("raw_box_score_team_miscellaneous_lines", "game_id side left_on_base team_earned_runs double_plays_turned triple_plays_turned"),
    "stg_event_audit": ("raw_event_audit", "game_id event_id filename line_number event_key raw_play"),
    "stg_event_fielding_plays": ("raw_event_fielding_plays", "game_id event_key sequence_id fielding_position fielding_play"),
    "stg_event_pitch_sequences": ("raw_event_pitch_sequences", "event_key sequence_id sequence_item runners_going_flag blocked_by_catcher_flag catcher_pickoff_attempt_at_base"),
    "stg_event_flags": ("raw_event_flags", "event_key flag"),
    "stg_game_earned_runs": ("raw_game_earned_runs", "game_id player_id earned_runs"),
    "stg_game_fielding_appearances": ("raw_game_fielding_appearances", f"{_GAME_PLAYER} fielding_position start_event_id end_event_id"),
    "stg_game_lineup_appearances": ("raw_game_lineup_appearances", f"{_GAME_PLAYER} lineup_position entered_game_as start_event_id end_event_id"),
}


def named(df: DataFrame, columns: str) -> DataFrame:
    """Columns by a list of old:new:type, of which the last two may be left out."""
    picked = []
    for part in columns.split():
        old, new, kind = (part.split(":") + ["", ""])[:3]
        picked.append((F.col(old).cast(kind) if kind else F.col(old)).alias(new or old))
    return df.select(*picked)


MODELS |= {name: lambda m, raw=raw, columns=columns: named(getattr(m, raw), columns) for name, (raw, columns) in NAMED.items()}


@model
def stg_box_score_caught_stealing(m) -> DataFrame:
    """Runners caught in seasons before 1919; later ones are told elsewhere."""
    return named(m.raw_box_score_caught_stealing.where("season < 1919"), _STEAL)


@model
def stg_box_score_pinch_hitting_lines(m) -> DataFrame:
    """Lines of pinch hitters whose inning is known."""
    return named(m.raw_box_score_pinch_hitting_lines.where("inning IS NOT NULL"), "game_id pinch_hitter_id inning side at_bats hits hit_by_pitch:hit_by_pitches rbi")


#: Columns of the register, old:new.
PEOPLE = "retro_id:player_id bbref_id:reference_player_id player_id:databank_player_id birth_year birth_month birth_day birth_country birth_state birth_city death_year death_month death_day death_country death_state death_city name_first:first_name name_last:last_name name_given:given_name weight:weight_pounds height:height_inches bats throws debut final_game"


@model
def stg_people(m) -> DataFrame:
    """People of the register with a number in order of their ids."""
    people = named(m.raw_databank_people, PEOPLE)
    return W.row_numbers(people, ["databank_player_id"], "internal_id")


@model
def stg_databank_appearances(m) -> DataFrame:
    """Games by player, season, stint and position; outfield games are split over a team's stints in proportion to each stint's own."""
    team = m.team_crosswalk.withColumnsRenamed({"register_team": "_team", "team_id": "_id"})
    on = ["player_id", "year_id", "team_id"]
    fielding = m.raw_databank_fielding_games
    placed = E("CASE pos WHEN 'P' THEN 1 WHEN 'C' THEN 2 WHEN '1B' THEN 3 WHEN '2B' THEN 4 WHEN '3B' THEN 5 WHEN 'SS' THEN 6 END")
    infield = fielding.where("pos <> 'OF'").select(*on, "lg_id", "stint", placed.alias("fielding_position"), F.col("g").alias("games_at_position"))
    outfield = fielding.where("pos = 'OF'").withColumn("_part", W.share(F.col("g").cast("double"), on))
    split = outfield.join(m.raw_databank_appearances.select(*on, "g_lf", "g_cf", "g_rf"), on).select(*on, "lg_id", "stint", *[F.round(F.col(c) * F.col("_part")).cast("long").alias(str(k)) for k, c in ((7, "g_lf"), (8, "g_cf"), (9, "g_rf"))])
    spread = split.unpivot([*on, "lg_id", "stint"], ["7", "8", "9"], "fielding_position", "games_at_position").withColumn("fielding_position", F.col("fielding_position").cast("int"))
    outs = fielding.where("pos <> 'P' AND inn_outs IS NOT NULL").groupBy(*on, "stint").agg(F.sum("inn_outs").alias("outs_played"))
    totals = m.raw_databank_appearances.select(*on, F.col("lg_id").alias("_league"), F.col("g_all").alias("games_total"))
    known = m.stg_people.where("player_id IS NOT NULL").select(F.col("player_id").alias("_player"), F.col("databank_player_id").alias("_databank"))
    rows = infield.unionByName(spread).where("games_at_position > 0").join(totals, on).join(outs, [*on, "stint"], "left")
    found = rows.join(known, F.col("player_id") == F.col("_databank")).join(team, F.col("team_id") == F.col("_team"), "left")
    return found.select(
        F.col("_player").alias("player_id"), F.col("_databank").alias("databank_player_id"), F.col("year_id").alias("season"), "stint", F.col("_id").alias("team_id"), F.coalesce("_league", "lg_id").alias("league_id"),
        "fielding_position", "games_at_position", "games_total", F.coalesce("outs_played", F.lit(0)).alias("outs_played"),
    )
