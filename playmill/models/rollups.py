"""Roll-ups of event counters to player games, team games, player seasons and team seasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import project as P
from ..operators import windows as W
from . import stats as S
from .catalogue import flag, model, sums

E = F.expr


def by_game(df: DataFrame) -> DataFrame:
    """Rows moved to their games once; what is grouped or joined by game after that moves none."""
    return df.repartition("game_id")


@model(placed=True)
def player_game_offense_stats(m) -> DataFrame:
    """All offense counters of each player and game: from plays, and from summary lines of games without."""
    keys = ["game_id", "team_id", "player_id"]
    own = A.rollup_sum(by_game(m.event_offense_stats.select(*keys, *S.OFFENSE)), keys, S.OFFENSE)
    box = m.stg_box_score_batting_lines.join(m.stg_games.where("source_type = 'BoxScore'").select("game_id", "home_team_id", "away_team_id"), "game_id")
    team = F.when(F.col("side") == "Home", F.col("home_team_id")).otherwise(F.col("away_team_id"))
    told = [c for c in S.OFFENSE if c in box.columns]
    rest = box.withColumn("team_id", team).groupBy("game_id", "team_id", F.col("batter_id").alias("player_id")).agg(*sums(told))
    return own.unionByName(rest, allowMissingColumns=True)


@model(placed=True)
def team_game_offense_stats(m) -> DataFrame:
    """Offense counters of a team's game; left_on_base means those left at the end of an inning here."""
    return A.redefine(A.rollup_sum(m.player_game_offense_stats, ["game_id", "team_id"], S.OFFENSE), {"left_on_base": F.col("left_on_base_with_two_outs")})


@model(placed=True)
def player_game_pitching_stats(m) -> DataFrame:
    """All pitching counters of each pitcher and game, from plays with their flags or from summary lines, with decisions and what follows from them."""
    events = by_game(m.event_pitching_stats.select("game_id", "player_id", "team_id", *S.PITCHING)).groupBy("game_id", "player_id").agg(F.min("team_id").alias("team_id"), *sums(S.PITCHING))
    flags = by_game(m.event_pitching_flags).groupBy("game_id", F.col("pitcher_id").alias("player_id")).agg(
        F.max(flag("starting_pitcher_flag")).alias("games_started"), F.sum("inherited_runners").alias("inherited_runners"), F.sum("bequeathed_runners").alias("bequeathed_runners"), F.max(flag("new_relief_pitcher_flag")).alias("games_relieved"),
        F.max(flag("pitcher_finish_flag")).alias("games_finished"), F.count_if("save_situation_start_flag").alias("save_situations_entered"), F.count_if("hold_flag").alias("holds"), F.count_if("blown_save_flag").alias("blown_saves"), F.max(flag("save_flag")).alias("saves_by_rule"),
    )
    games = m.stg_games.select("game_id", "source_type", "home_team_id", "away_team_id", "winning_pitcher_id", "losing_pitcher_id", "save_pitcher_id")
    lines = m.stg_box_score_pitching_lines.join(games.where("source_type = 'BoxScore'"), "game_id").withColumn("team_id", F.when(F.col("side") == "Home", F.col("home_team_id")).otherwise(F.col("away_team_id")))
    told = [c for c in (*S.PITCHING, "earned_runs", "games_started", "games_relieved", "games_finished") if c in lines.columns]
    box = lines.groupBy("game_id", F.col("pitcher_id").alias("player_id")).agg(F.min("team_id").alias("team_id"), *sums(told))
    # A game's flags and earned runs come to its pitchers together, so that the wide rows stay with their game.
    told_flags = [n for n in flags.columns if n not in ("game_id", "player_id")]
    flags = flags.groupBy("game_id").agg(F.collect_list(F.struct("player_id", *told_flags)).alias("_flags"))
    earned = m.stg_game_earned_runs.groupBy("game_id").agg(F.collect_list(F.struct("player_id", F.col("earned_runs").alias("_earned"))).alias("_runs"))
    mine = lambda c: F.filter(c, lambda x: x["player_id"] == F.col("player_id"))
    flagged = events.join(flags, "game_id", "left").withColumn("_own", F.get(mine("_flags"), F.lit(0))).select("*", *[f"_own.{n}" for n in told_flags]).drop("_flags", "_own")
    every = flagged.unionByName(box, allowMissingColumns=True)
    joined = every.join(games.drop("source_type", "home_team_id", "away_team_id"), "game_id", "left").join(earned, "game_id", "left")
    joined = joined.select("*", F.explode_outer(mine("_runs")).alias("_own")).select("*", "_own._earned").drop("_runs", "_own")
    named = joined.withColumns({
        "wins": flag("player_id = winning_pitcher_id"), "losses": flag("player_id = losing_pitcher_id"), "saves": flag("player_id = save_pitcher_id"), "earned_runs": F.coalesce("_earned", "earned_runs").cast("long"),
        "innings_pitched": F.round(F.col("outs_recorded") / 3, 4),
    }).drop("winning_pitcher_id", "losing_pitcher_id", "save_pitcher_id", "_earned")
    team = W.over(["team_id", "game_id"])
    first = named.withColumns({
        "save_opportunities": F.col("saves") + F.col("blown_saves"), "complete_games": flag(F.count("*").over(team) == 1),
        "shutouts": flag((F.sum("runs").over(team) == 0) & (F.sum("outs_recorded").over(team) == F.col("outs_recorded"))), "quality_starts": flag("games_started = 1 AND outs_recorded >= 18 AND earned_runs <= 3"),
        "no_decisions": flag("games_started = 1 AND wins + losses = 0"),
    })
    then = first.withColumns({"cheap_wins": flag("games_started = 1 AND quality_starts = 0 AND wins = 1"), "tough_losses": flag("quality_starts = 1 AND losses = 1"), "no_hitters": flag("complete_games = 1 AND hits = 0 AND outs_recorded >= 27")})
    perfect = "no_hitters = 1 AND (times_reached_base = 0 OR outs_recorded >= batters_faced AND coalesce(walks, 0) + coalesce(hit_by_pitches, 0) = 0)"
    return then.withColumn("perfect_games", flag(perfect)).select("game_id", "player_id", "team_id", "innings_pitched", *S.PITCHING, *S.APPEARANCE, *S.AWARDS)


@model(placed=True)
def team_game_pitching_stats(m) -> DataFrame:
    """Pitching counters of a team's game; earned runs, feats and men left mean other things at this level."""
    total = A.rollup_sum(m.player_game_pitching_stats, ["game_id", "team_id"], [*S.PITCHING, *S.APPEARANCE, *S.AWARDS])
    return A.redefine(total, {
        "individual_earned_runs": F.col("earned_runs"), "earned_runs": F.greatest(F.lit(0), F.col("earned_runs") - F.col("team_unearned_runs")).cast("long"), "left_on_base": F.col("left_on_base_with_two_outs"),
        "no_hitters": flag("hits = 0 AND outs_recorded >= 27"), "perfect_games": flag("perfect_games = 1 OR outs_recorded >= 27 AND times_reached_base = 0"), "innings_pitched": F.round(F.col("outs_recorded") / 3, 4),
    })


@model(placed=True)
def player_game_appearances(m) -> DataFrame:
    """How each player came into a game, where they batted and which positions they fielded, in order."""
    events = m.stg_games.where("source_type = 'PlayByPlay'").select("game_id")
    lines = m.stg_box_score_batting_lines
    hit = m.stg_box_score_pinch_hitting_lines.select("game_id", "side", F.col("pinch_hitter_id").alias("batter_id"), F.lit(True).alias("hit")).distinct()
    run = m.stg_box_score_pinch_running_lines.select("game_id", "side", F.col("pinch_runner_id").alias("batter_id"), F.lit(True).alias("ran")).distinct()
    on = ["game_id", "side", "batter_id"]
    way = F.when(F.col("nth_player_at_position") == 1, "Starter").when(F.col("hit"), "PinchHitter").when(F.col("ran"), "PinchRunner").otherwise("DefensiveSubstitution")
    box = lines.join(hit, on, "left").join(run, on, "left").select("game_id", F.col("batter_id").alias("player_id"), "side", "lineup_position", way.alias("entered_game_as"), F.col("nth_player_at_position").alias("place"))
    bats = m.stg_game_lineup_appearances.select("game_id", "player_id", "side", "lineup_position", "entered_game_as", F.col("start_event_id").alias("place")).unionByName(J.without(box, events, ["game_id"]))
    ways = {"games_started": "Starter", "games_pinch_hit": "PinchHitter", "games_pinch_run": "PinchRunner", "games_defensive_sub": "DefensiveSubstitution"}
    boxed = m.stg_box_score_fielding_lines.select("game_id", F.col("fielder_id").alias("player_id"), "fielding_position", F.col("nth_position_played_by_player").alias("place"))
    fields = m.stg_game_fielding_appearances.select("game_id", "player_id", "fielding_position", F.col("start_event_id").alias("place")).unionByName(J.without(boxed, events, ["game_id"]))
    # Both move to their games and are grouped together; rows without a key are in neither's group.
    lost = F.col("game_id").isNull() | F.col("player_id").isNull()
    batting = bats.where("lineup_position > 0").select("game_id", "player_id", "side", "lineup_position", "entered_game_as", F.col("place").alias("bat_place"), F.lit(True).alias("_bats"), F.when(lost, F.lit(0)).alias("_apart"))
    fielding = fields.where("fielding_position BETWEEN 1 AND 10").withColumn("_apart", F.when(lost, F.lit(1)))
    start = lambda p: F.coalesce(F.max(flag(f"fielding_position = {p} AND place = 1")), F.lit(0))
    of = lambda c, *order: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order, c)))
    return by_game(batting.unionByName(fielding, allowMissingColumns=True)).groupBy("game_id", "player_id", "_apart").agg(
        F.min("side").alias("side"), *[F.max(flag(F.col("entered_game_as") == v)).alias(n) for n, v in ways.items()], of("lineup_position", "bat_place").alias("lineup_position"), of("fielding_position", "place").alias("first_fielding_position"),
        F.nullif(A.ordered_text(F.col("fielding_position"), F.col("place"), F.col("fielding_position"), sep=","), F.lit("")).alias("fielding_positions"), (start(1) * start(10)).alias("games_ohtani_rule"), F.max("_bats").alias("_bats"),
    ).where("_bats").drop("_apart", "_bats")


_CREDITED = ["outs_played", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", "putouts", "assists", "errors", "fielders_choices", "assisted_putouts", "in_play_putouts", "in_play_assists", "double_plays", "triple_plays", "ground_ball_double_plays", "stolen_bases", "caught_stealing", "passed_balls", "balls_hit_to", "reaching_errors", "pickoffs", "unknown_putouts_while_fielding"]
_JUDGED = ["putouts", "assists", "errors", "double_plays", "triple_plays"]


@model(placed=True)
def player_position_game_fielding_stats(m) -> DataFrame:
    """Fielding of each player, game and position from both accounts; the plays' figures count where no putout is unknown or no summary exists."""
    keys = ["game_id", "player_id", "fielding_position"]
    games = m.stg_games.select("game_id", "home_team_id", "away_team_id")
    lines = m.stg_box_score_fielding_lines.withColumnRenamed("fielder_id", "player_id").join(games, "game_id").withColumn("team_id", F.when(F.col("side") == "Home", F.col("home_team_id")).otherwise(F.col("away_team_id")))
    boxed = ["outs_played", *_JUDGED, "passed_balls"]
    # Both accounts move to their games and are summed together; rows without a key are in neither's group.
    lost = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    box = lines.select(*keys, F.col("team_id").alias("box_team"), F.lit(True).alias("boxed"), *[F.col(c).alias(f"box_{c}") for c in boxed])
    parts = [df.withColumn("_apart", F.when(lost, F.lit(n))) for n, df in enumerate((box, m.event_player_fielding_stats.select(*keys, "team_id", *_CREDITED)))]
    strict = lambda c: F.when(~F.bool_or(F.col("boxed").isNotNull() & F.col(c).isNull()), F.sum(c))
    both = by_game(parts[0].unionByName(parts[1], allowMissingColumns=True)).groupBy(*keys, "_apart").agg(
        F.min("box_team").alias("box_team"), F.max("boxed").alias("boxed"), *[(F.sum(c) if c == "box_outs_played" else strict(c)).alias(c) for c in (f"box_{c}" for c in boxed)], F.min("team_id").alias("team_id"), *sums(_CREDITED),
    ).drop("_apart")
    came = m.player_game_appearances.groupBy("game_id").agg(F.collect_list(F.struct("player_id", "first_fielding_position", "games_started", "games_ohtani_rule")).alias("_came"))
    own = F.get(F.filter("_came", lambda x: x["player_id"] == F.col("player_id")), F.lit(0))  # one row a player
    both = both.join(came, "game_id", "left").withColumn("_own", own).select("*", "_own.first_fielding_position", "_own.games_started", "_own.games_ohtani_rule").drop("_came", "_own")
    trusted = F.col("boxed").isNull() | F.coalesce(F.col("unknown_putouts_while_fielding") == 0, F.lit(False))
    start = F.when(E("first_fielding_position = fielding_position OR games_ohtani_rule = 1 AND fielding_position IN (1, 10)"), F.col("games_started")).otherwise(0)
    plain = [c for c in _CREDITED if c not in (*_JUDGED, "outs_played", "passed_balls")]
    return both.select(
        *keys, F.coalesce("team_id", "box_team").alias("team_id"), start.cast("long").alias("games_started"), F.coalesce("outs_played", "box_outs_played").alias("outs_played"), *[F.when(trusted, F.col(c)).otherwise(F.col(f"box_{c}")).alias(c) for c in _JUDGED],
        F.coalesce("box_passed_balls", "passed_balls").alias("passed_balls"), *plain, *[(F.col(f"box_{c}") - F.col(c)).alias(f"surplus_box_{c}") for c in ("putouts", "assists", "errors")],
    )


@model
def team_game_fielding_stats(m) -> DataFrame:
    """A team's fielding in a game from plays, players and team lines: the largest of putouts, assists and errors, the plays' running events before the summary's."""
    on, own = ["game_id", "team_id"], ["outs_played", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", "putouts", "assists", "errors", "stolen_bases", "caught_stealing", "pickoffs", "double_plays", "triple_plays", "ground_ball_double_plays", "reaching_errors", "unknown_putouts", "incomplete_events"]
    g = m.event_fielding_stats.groupBy(*on).agg(*[F.sum(c).alias(f"g_{c}") for c in own])
    p = m.player_position_game_fielding_stats.groupBy(*on).agg(F.sum("putouts").alias("p_outs_played"), *[F.sum(c).alias(f"p_{c}") for c in ("putouts", "assists", "errors", "fielders_choices", "assisted_putouts", "in_play_putouts", "in_play_assists", "passed_balls")])
    info = m.team_game_start_info.select("season", *on, F.col("team_side").alias("side"))
    t = m.stg_box_score_team_fielding_lines.select("game_id", "side", *[F.col(c).alias(f"t_{c}") for c in ("outs_played", "putouts", "assists", "errors", "passed_balls")])
    away = F.when(F.col("running_side") == "Away", "Home").otherwise("Away")
    counts = {"stolen_bases": m.stg_box_score_stolen_bases.withColumn("side", away), "caught_stealing": m.stg_box_score_caught_stealing.withColumn("side", away), "double_plays": m.stg_box_score_double_plays.withColumnRenamed("defense_side", "side"), "triple_plays": m.stg_box_score_triple_plays.withColumnRenamed("defense_side", "side")}
    parts = [t, *[df.groupBy("game_id", "side").agg(F.count("*").alias(f"b_{n}")) for n, df in counts.items()]]
    whole = J.left_chain(p.join(info, on).join(g, on, "left"), parts, ["game_id", "side"])
    first = lambda *cs: F.coalesce(*cs).cast("long")
    return whole.select(
        "season", *on, first("t_outs_played", "g_outs_played", "p_outs_played").alias("outs_played"), *[F.greatest(f"t_{c}", f"p_{c}", f"g_{c}").cast("long").alias(c) for c in ("putouts", "assists", "errors")],
        *[F.col(f"p_{c}").alias(c) for c in ("fielders_choices", "assisted_putouts", "in_play_putouts", "in_play_assists")], first("t_passed_balls", "p_passed_balls").alias("passed_balls"),
        *[first(f"g_{c}", f"b_{c}", F.lit(0)).alias(c) for c in counts], *[F.col(f"g_{c}").alias(c) for c in ("pickoffs", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", "ground_ball_double_plays", "reaching_errors", "unknown_putouts", "incomplete_events")],
    )


def _category(position) -> F.Column:
    return F.when(position == 1, "P").when(position == 2, "C").when(position.between(3, 6), "IF").when(position.between(7, 9), "OF").when(position == 10, "DH")


@model
def player_position_team_season_fielding_stats(m) -> DataFrame:
    """Fielding of each player, team, season and position: games with an account, then the season register for seasons without any."""
    keys = ["season", "team_id", "player_id", "fielding_position", "game_type"]
    games = m.stg_games.select("game_id", "season", "game_type")
    rows = m.player_position_game_fielding_stats.join(games, "game_id")
    spots = {"games_left_field": 7, "games_center_field": 8, "games_right_field": 9}
    own = rows.groupBy(*keys).agg(F.count("*").alias("games"), F.sum("games_started").alias("games_started"), *sums(_CREDITED), *[F.count_if(F.col("fielding_position") == k).alias(n) for n, k in spots.items()])
    register = J.without(m.stg_databank_fielding, games, ["season"])
    told = ["games", "games_started", "outs_played", "putouts", "assists", "errors", "double_plays", "passed_balls", "stolen_bases", "caught_stealing"]
    rest = register.groupBy("season", "team_id", "player_id", F.coalesce("fielding_position", F.lit(0)).alias("fielding_position"), F.lit("RegularSeason").alias("game_type")).agg(*sums(told))
    return own.unionByName(rest, allowMissingColumns=True).withColumn("fielding_position_category", _category(F.col("fielding_position")))


@model
def team_season_fielding_stats(m) -> DataFrame:
    """A team's fielding in a season: its games' sums, then players' sums for seasons without games."""
    info = m.game_start_info.select("game_id", "season", "game_type")
    stats = ["outs_played", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", "putouts", "assists", "errors", "fielders_choices", "reaching_errors", "stolen_bases", "caught_stealing", "pickoffs", "passed_balls", "double_plays", "triple_plays", "ground_ball_double_plays"]
    own = m.team_game_fielding_stats.drop("season").join(info, "game_id").groupBy("season", "team_id", "game_type").agg(F.count("*").alias("games"), *sums(stats))
    players = J.without(m.player_position_team_season_fielding_stats, info, ["season"])
    told = ["putouts", "assists", "errors", "passed_balls", "stolen_bases", "caught_stealing"]
    rest = players.groupBy("season", "team_id", F.lit("RegularSeason").alias("game_type")).agg(F.sum("putouts").alias("outs_played"), *sums(told))
    return own.unionByName(rest, allowMissingColumns=True)


def _season(m, per_game: DataFrame, stats: list[str], register: DataFrame, told: list[str]) -> DataFrame:
    """Sums by player, team, season and kind of game; regular seasons take from the register what is unknown, and those that only it has."""
    keys = ["season", "team_id", "player_id", "game_type"]
    rows = per_game.join(m.game_start_info.select("game_id", "season", "game_type"), "game_id")
    # Counting distinct games beside the sums would group the wide rows by game before they move; alone it takes the keys only.
    games = rows.select(*keys, "game_id").distinct().groupBy(*keys).agg(F.count("game_id").alias("games"))
    both = rows.groupBy(*keys).agg(*sums(stats)).unionByName(games, allowMissingColumns=True)
    own = both.groupBy(*keys).agg(F.max("games").alias("games"), *sums(stats))
    other = register.withColumn("game_type", F.lit("RegularSeason")).groupBy(*keys).agg(*sums(["games", *told]))
    filled = P.supplement(own, other, keys, told, F.col("game_type") == "RegularSeason")
    return filled.unionByName(J.without(other, own, keys), allowMissingColumns=True)


@model
def player_team_season_offense_stats(m) -> DataFrame:
    """Offense counters by player, team and season; two running counters of early seasons are the register's."""
    told = ["hits", "doubles", "triples", "home_runs", "walks", "stolen_bases", "caught_stealing"]
    keys = ["season", "team_id", "player_id", "game_type"]
    register = m.stg_databank_batting
    filled = _season(m, m.player_game_offense_stats, S.OFFENSE, register, told)
    other = register.withColumn("game_type", F.lit("RegularSeason")).groupBy(*keys).agg(*sums(told))
    return P.override(filled, other, keys, ["stolen_bases", "caught_stealing"], F.col("season") < 1920)


@model
def player_team_season_pitching_stats(m) -> DataFrame:
    """Pitching counters by player, team and season, with innings from outs."""
    told = ["wins", "losses", "earned_runs", "outs_recorded", "hits", "strikeouts", "walks"]
    return _season(m, m.player_game_pitching_stats, [*S.PITCHING, *S.APPEARANCE, *S.AWARDS], m.stg_databank_pitching, told).withColumn("innings_pitched", F.round(F.col("outs_recorded") / 3, 4))
