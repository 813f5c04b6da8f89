"""Game-level models: what is known before a game, its result, interruptions and scorekeepers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import sets as S
from ..operators import windows as W
from .catalogue import model

E = F.expr
KEY = "event_key"


def _told(m, mark: str) -> dict[str, DataFrame]:
    """What comments say after a mark, by play and by summary; a game's plays come first."""
    said = lambda df: df.where(F.col("comment").ilike(f"%{mark}%")).withColumn("info", F.regexp_extract("comment", f"{mark}(.*)", 1))
    events = said(m.stg_event_comments).join(m.stg_events.select("game_id", KEY), KEY).select("game_id", KEY, "info")
    box = said(m.stg_box_score_comments).select("game_id", F.lit(None).cast("long").alias(KEY), "info")
    return {"event": events, "box": J.without(box, events, ["game_id"])}


@model
def game_forfeits(m) -> DataFrame:
    """Forfeited games: from the comments of plays, else of summaries, else from the game log."""
    told = _told(m, "Forfeit=")
    log = m.stg_gamelog.where("forfeit_info IS NOT NULL").select("game_id", F.lit(None).cast("long").alias(KEY), F.col("forfeit_info").alias("info"))
    known = told["event"].union(told["box"])
    every = known.union(J.without(log, known, ["game_id"]))
    side = E("CASE info WHEN 'H' THEN 'Home' WHEN 'V' THEN 'Away' WHEN 'T' THEN 'Tie' END")
    return every.select("game_id", F.col(KEY).alias("event_key_at_forfeit"), side.alias("winning_side"))


@model
def game_suspensions(m) -> DataFrame:
    """Suspended games: date resumed, new park, scores and outs at the time."""
    told = _told(m, "Suspend=")
    part = lambda k: F.try_element_at(F.split("info", ","), F.lit(k))
    number = lambda k: F.nullif(part(k), F.lit("")).cast("long")
    return told["event"].union(told["box"]).select(
        "game_id", F.col(KEY).alias("event_key_at_suspension"), F.to_date(part(1), "yyyyMMdd").alias("date_resumed"), F.nullif(part(2), F.lit("")).alias("new_park_id"),
        number(3).alias("away_score_at_suspension"), number(4).alias("home_score_at_suspension"), number(5).alias("game_outs_recorded_at_suspension"),
    )


@model
def game_start_info(m) -> DataFrame:
    """What is known of each game beforehand: games with an account, then those of the log alone, with leagues of the day and starting pitchers."""
    log = J.without(m.stg_gamelog, m.stg_games, ["game_id"])
    shared = ["game_id", "date", "season", "home_team_id", "away_team_id", "doubleheader_status", "game_type", "park_id", "attendance", "source_type", "use_dh"]
    own = m.stg_games.select(*shared, "scorer", "filename", "sky", F.lit(None).cast("long").alias("home_starting_pitcher_id"), F.lit(None).cast("long").alias("away_starting_pitcher_id"))
    rest = log.select(*shared, "home_starting_pitcher_id", "away_starting_pitcher_id", F.lit("Unknown").alias("sky"))
    games = own.unionByName(rest, allowMissingColumns=True)
    for side in ("away", "home"):
        eras = m.seed_franchises.select(F.col("team_id").alias(f"{side}_team_id"), F.col("franchise_id").alias(f"{side}_franchise_id"), F.col("league").alias(f"{side}_league"), F.col("division").alias(f"{side}_division"), F.concat_ws(" ", "location", "nickname").alias(f"{side}_team_name"), "date_start", "date_end")
        games = J.effective_dated(games, eras, [f"{side}_team_id"], "date", how="left").drop("date_start", "date_end")
    starters = m.starting_pitchers.withColumnsRenamed({"home_pitcher_id": "_h", "away_pitcher_id": "_a"})
    parks = m.stg_gamelog.select("game_id", F.col("park_id").alias("_park"))
    joined = games.join(starters, "game_id", "left").join(parks, "game_id", "left").join(m.seed_game_types, "game_type", "left")
    negro = E("coalesce(filename LIKE '%.E_R', false)")
    integrated = E("coalesce(season >= 1947 AND filename NOT LIKE '%.E_R', false)")
    return joined.withColumns({
        "home_starting_pitcher_id": F.coalesce("home_starting_pitcher_id", "_h"), "away_starting_pitcher_id": F.coalesce("away_starting_pitcher_id", "_a"), "park_id": F.coalesce("park_id", "_park"),
        "is_interleague": E("coalesce(home_league <> away_league, false)"), "is_integrated": integrated, "is_negro_leagues": negro, "is_segregated_white": ~integrated & ~negro,
    }).drop("_h", "_a", "_park")


@model
def game_results(m) -> DataFrame:
    """Winner, loser, scores and length of each game; forfeits decide before runs do, and a resumed game ends later."""
    known = m.stg_games.select("game_id", "date", "duration_minutes", "winning_pitcher_id", "losing_pitcher_id", "save_pitcher_id").join(m.game_line_scores, "game_id", "left")
    log = J.without(m.stg_gamelog.select("game_id", "date", "duration_minutes", "home_runs_scored", "away_runs_scored", "home_line_score", "away_line_score"), known, ["game_id"])
    info = m.game_start_info.select("game_id", "season", "game_type", "home_team_id", "away_team_id")
    every = known.unionByName(log, allowMissingColumns=True).join(info, "game_id")
    every = every.join(m.game_suspensions.select("game_id", "date_resumed", F.lit(True).alias("suspended")), "game_id", "left").join(m.game_forfeits.select("game_id", F.col("winning_side").alias("forfeit_to"), F.lit(True).alias("forfeited")), "game_id", "left")
    side = F.when(E("forfeit_to IN ('Home', 'Away')"), F.col("forfeit_to")).when(E("home_runs_scored > away_runs_scored"), "Home").when(E("home_runs_scored < away_runs_scored"), "Away")
    decided = every.withColumn("winning_side", side)

    def by(winner: bool, home: str, away: str) -> Column:
        one, other = (home, away) if winner else (away, home)
        return F.when(E("winning_side = 'Home'"), F.col(one)).when(E("winning_side = 'Away'"), F.col(other))

    return decided.select(
        "game_id", "season", "game_type", F.coalesce("date_resumed", "date").alias("game_finish_date"), "home_team_id", "away_team_id", by(True, "home_team_id", "away_team_id").alias("winning_team_id"),
        by(False, "home_team_id", "away_team_id").alias("losing_team_id"), by(True, "home_runs_scored", "away_runs_scored").alias("winning_team_score"), by(False, "home_runs_scored", "away_runs_scored").alias("losing_team_score"),
        "winning_side", E("CASE winning_side WHEN 'Home' THEN 'Away' WHEN 'Away' THEN 'Home' END").alias("losing_side"), F.col("forfeited").isNotNull().alias("forfeit_flag"), F.col("suspended").isNotNull().alias("suspension_flag"),
        F.col("winning_side").isNull().alias("tie_flag"), "winning_pitcher_id", "losing_pitcher_id", "save_pitcher_id", "home_runs_scored", "away_runs_scored", "home_line_score", "away_line_score", "duration_minutes", "duration_outs",
        E("coalesce(duration_outs BETWEEN 51 AND 54, true)").alias("is_nine_inning_game"), E("coalesce(duration_outs > 54, false)").alias("is_extra_inning_game"), E("coalesce(duration_outs < 51, false)").alias("is_shortened_game"),
    )


@model
def game_scorekeeping(m) -> DataFrame:
    """The scorekeepers of each game under their standard names, with their share of it and the team they score for most."""
    base = m.stg_games.select("season", "game_id", "date", "away_team_id", "home_team_id", E("CASE WHEN scorer IS NULL OR trim(scorer) = '' THEN 'unknown' ELSE scorer END").alias("filled"))
    one = base.withColumn("scorer", F.explode(F.split("filled", r"[/&,]|( -(-?) )"))).withColumn("scorer", F.lower(F.trim("scorer"))).drop("filled")
    team = lambda c: F.lower(F.col(c).cast("string"))
    both = F.when(F.col("scorer").isin("teams", "both teams", "both"), F.array(team("away_team_id"), team("home_team_id"))).otherwise(F.array("scorer"))
    rows = one.withColumn("raw_scorer", F.explode(both)).drop("scorer").where("trim(raw_scorer) <> ''")
    names = m.seed_scorer_lookup.select(F.lower(F.trim("scorer")).alias("raw_scorer"), F.col("normalized_scorer").alias("_n"))
    ranges = m.seed_scorer_numerical_ranges.select(F.col("low").cast("string").alias("_low"), F.col("high").cast("string").alias("_high"), F.col("group_id").cast("string").alias("_g"))
    found = J.string_range(rows.join(names, "raw_scorer", "left"), ranges, "raw_scorer", "_low", "_high")
    named = W.dedupe(found.withColumn("cleaned_scorer", F.coalesce("_n", "_g", "raw_scorer")).drop("_n", "_g", "_low", "_high"), ["game_id", "cleaned_scorer"], ["raw_scorer"])
    shared = named.withColumn("game_share", 1 / F.count("*").over(W.over(["game_id"])))
    total = lambda *keys: F.sum("game_share").over(W.over(["cleaned_scorer", *keys]))
    return shared.withColumns({
        "scorer_game_count_raw": F.count("*").over(W.over(["cleaned_scorer"])), "scorer_game_count_weighted": total(),
        "scorer_more_common_team_id": F.when(F.round(total("away_team_id"), 6) >= F.round(total("home_team_id"), 6), F.col("away_team_id")).otherwise(F.col("home_team_id")),
    })


@model
def team_game_start_info(m) -> DataFrame:
    """Each game from both sides, numbered in the season and in the series against the opponent, with days of rest."""
    both = ["team_id", "league", "division", "team_name", "franchise_id", "starting_pitcher_id"]
    common = ["game_id", "date", "season", "doubleheader_status", "game_type", "park_id", "source_type", "is_interleague"]
    view = lambda own, other: {f"{own}_side": "team_side"} | {f"{own}_{c}": c for c in both} | {f"{other}_{c}": f"opponent_{'id' if c == 'team_id' else 'name' if c == 'team_name' else c}" for c in both}
    g = m.game_start_info.select(*common, *[f"{s}_{c}" for s in ("home", "away") for c in both], F.lit("Home").alias("home_side"), F.lit("Away").alias("away_side"))
    sides = S.two_perspectives(g, common, view("home", "away"), view("away", "home"))
    order = ["date", "doubleheader_status", "game_id"]
    series = ["season", "team_id", "game_type", "opponent_id"]
    started = sides.withColumn("series_id", F.first("game_id").over(W.over(series, order, (W.FIRST, W.NOW))))
    season = W.over(["season", "team_id", "game_type"], order)
    return started.withColumns({
        "season_game_number": F.row_number().over(season), "series_game_number": F.row_number().over(W.over(["team_id", "series_id"], order)), "days_since_last_game": F.datediff("date", F.lag("date").over(season)),
    })


@model
def game_line_scores(m) -> DataFrame:
    """Runs by inning of both sides as texts, with totals and the outs played."""
    from ..operators.aggregate import ordered_text

    by = m.stg_events.groupBy("game_id", "batting_side", "inning").agg(F.sum("runs_on_play").alias("r"), F.sum("outs_on_play").alias("o"))
    shown = F.when(F.col("r") > 9, F.concat(F.lit("("), F.col("r").cast("string"), F.lit(")"))).otherwise(F.col("r").cast("string"))
    per = by.groupBy("game_id", "batting_side").agg(ordered_text(shown, F.col("inning")).alias("line"), F.sum("r").alias("runs"), F.sum("o").alias("outs"))
    pick = lambda side, c: F.max(F.when(F.col("batting_side") == side, F.col(c)))
    return per.groupBy("game_id").agg(*[pick(s.title(), c).alias(n) for s in ("home", "away") for c, n in (("line", f"{s}_line_score"), ("runs", f"{s}_runs_scored"))], F.sum("outs").alias("duration_outs"))


@model
def box_score_games(m) -> DataFrame:
    """Games known from the log only, shaped as a summary account whose details are unknown."""
    lost = [F.lit(None).cast("string").alias(c) for c in ("field_condition", "precipitation", "wind_direction")] + [F.lit(None).cast("int").alias(c) for c in ("temperature_fahrenheit", "wind_speed_mph")]
    return m.game_start_info.where("source_type = 'GameLog'").select("game_id", "date", "season", "doubleheader_status", "game_type", "park_id", "attendance", "use_dh", "away_team_id", "home_team_id", *lost)


@model
def box_score_line_scores(m) -> DataFrame:
    """Inning by inning runs of games known from the log only, read from their line scores."""
    only = m.game_start_info.where("source_type = 'GameLog'").select("game_id")
    log = m.stg_gamelog.join(only, "game_id", "left_semi")
    parts = [S.line_score(log.select("game_id", F.lit(s.title()).alias("side"), F.col(f"{s}_line_score").alias("line_score")), "line_score").select("game_id", "side", F.col("ordinal").alias("inning"), F.col("value").alias("runs")) for s in ("away", "home")]
    return parts[0].unionByName(parts[1])


@model
def box_score_pitching_lines(m) -> DataFrame:
    """The starting pitchers of games known from the log only, as the first pitching line of each side."""
    g = m.game_start_info.where("source_type = 'GameLog'")
    parts = [g.select("game_id", F.col(f"{s}_starting_pitcher_id").alias("pitcher_id"), F.lit(s.title()).alias("side")) for s in ("away", "home")]
    return parts[0].unionByName(parts[1]).where("pitcher_id IS NOT NULL").select("*", F.lit(1).alias("nth_pitcher"), *[F.lit(None).cast("int").alias(c) for c in ("outs_recorded", "batters_faced", "hits", "runs", "walks", "strikeouts")])


@model
def stg_games(m) -> DataFrame:
    """Games of the play account, then those of the summary account that it lacks, with a key for each."""
    plays, box = m.raw_games.withColumn("source_type", F.lit("PlayByPlay")), m.raw_box_games.withColumn("source_type", F.lit("BoxScore"))
    every = plays.unionByName(J.without(box, plays, ["game_id"]), allowMissingColumns=True)
    crowd = F.when((F.col("attendance") > 0) | (F.year("date") == 2020), F.col("attendance"))
    star = F.when(F.col("filename").rlike(r"^\d{4}AS\.EVE$"), "AllStarGame").otherwise(F.col("game_type"))
    clean = {"sky": F.coalesce("sky", F.lit("Unknown")), "attendance": crowd, "use_dh": F.coalesce("use_dh", F.lit(False)), "game_key": F.col("game_id") * 255, "game_type": star}
    return every.withColumns(clean).withColumnRenamed("game_winning_rbi", "game_winning_rbi_player_id")


def starters_of(appearances: DataFrame) -> DataFrame:
    """The first pitcher of each side of a game."""
    first = appearances.where("fielding_position = 1")
    pick = lambda side: F.min(F.when(F.col("side") == side, F.struct("start_event_id", "player_id")))
    return first.groupBy("game_id").agg(pick("Home")["player_id"].alias("home_pitcher_id"), pick("Away")["player_id"].alias("away_pitcher_id"))


@model
def starting_pitchers(m) -> DataFrame:
    return starters_of(m.stg_game_fielding_appearances)
