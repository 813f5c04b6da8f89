"""Results of teams by game, standings by day, and what a park does to runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import windows as W
from .catalogue import flag, model

REGULAR = "game_type = 'RegularSeason'"
#: What wins and losses are told apart by; a division by its first letter.
SPLITS = {"home": "team_side = 'Home'", "away": "team_side = 'Away'", "interleague": "is_interleague", "one_run": "abs(runs_scored - runs_allowed) = 1"} | {f"{name}": f"NOT is_interleague AND opponent_division LIKE '{name[0].upper()}%'" for name in ("east", "central", "west")}
SPLIT_COUNTS = [f"{split}_{kind}" for split in ("home", "away", "interleague", "east", "central", "west", "one_run") for kind in ("wins", "losses")]

#: Tells a team's results of one number apart: a game that was forfeited twice has two.
SAME_NUMBER = ["game_id", "team_side", "wins", "losses", "runs_scored", "runs_allowed"]


@model
def team_game_results(m) -> DataFrame:
    """Each team's result of each game, with its splits and the streaks that stood after it."""
    c, who, order = F.col, ["season", "team_id", "game_type"], ["game_finish_date", "season_game_number", *SAME_NUMBER]
    info = m.team_game_start_info.select("game_id", "team_id", "team_side", "league", "division", "opponent_league", "opponent_division", "season_game_number", "is_interleague", "opponent_id")
    won = m.game_results.select("game_id", "season", "game_type", "game_finish_date", "winning_team_id", "losing_team_id", "home_runs_scored", "away_runs_scored", "duration_outs")
    home = c("team_side") == "Home"
    games = info.join(won, "game_id").select(
        "season", "game_id", "game_finish_date", "team_id", "opponent_id", "game_type", "team_side", "league", "division", "opponent_league", "opponent_division", "season_game_number", "is_interleague", "duration_outs",
        flag(c("winning_team_id") == c("team_id")).alias("wins"), flag(c("losing_team_id") == c("team_id")).alias("losses"),
        F.when(home, c("home_runs_scored")).otherwise(c("away_runs_scored")).alias("runs_scored"), F.when(home, c("away_runs_scored")).otherwise(c("home_runs_scored")).alias("runs_allowed"),
    )
    told = games.withColumns({f"{split}_{kind}": F.when(F.expr(rule), c(kind)).otherwise(0).cast("long") for split, rule in SPLITS.items() for kind in ("wins", "losses")})
    told = told.withColumn("_k", F.row_number().over(W.over(who, order)))
    for kind, name in (("wins", "win"), ("losses", "loss")):
        told = W.streaks(told, who, ["_k"], c(kind) > 0, "_k").withColumnsRenamed({"streak_id": f"{name}_streak_id", "streak_length": f"{name}_streak_length"})
    return told.drop("_k")


@model
def standings(m) -> DataFrame:
    """The table of every division on every day of a season, from the day before its first game to the day after its last, as far as they are days of its year.

    A team's totals after a day with games stand until its next one; only days
    with games are summed, and the others are made from them.
    """
    c, who = F.col, ["season", "team_id"]
    games = m.team_game_results.where(f"{REGULAR} AND game_finish_date IS NOT NULL")
    bounds = games.groupBy("season").agg(F.date_sub(F.min("game_finish_date"), 1).alias("_start"), F.date_add(F.max("game_finish_date"), 1).alias("_end"))
    year = lambda month, day: F.make_date(c("season"), F.lit(month), F.lit(day))
    bounds = bounds.select("season", F.greatest("_start", year(1, 1)).alias("_start"), F.least("_end", year(12, 31)).alias("_end")).where("_start <= _end")
    teams = m.team_game_start_info.where(REGULAR).groupBy(*who).agg(*[F.min(n).alias(n) for n in ("league", "division", "team_name")]).join(bounds, "season")
    sums = ["wins", "losses", "runs_scored", "runs_allowed", *SPLIT_COUNTS]
    streaks, recent = ["win_streak_length", "loss_streak_length"], ["last_10_wins", "last_10_losses"]
    last_ten = W.over(who, ["season_game_number"], ranges=(-9, 0))
    numbered = games.withColumns({f"last_10_{k}": F.sum(k).over(last_ten) for k in ("wins", "losses")})
    last = F.max_by(F.struct(*streaks, *recent), F.struct("season_game_number", *SAME_NUMBER))
    daily = numbered.groupBy(*who, c("game_finish_date").alias("date")).agg(*[F.sum(F.coalesce(n, F.lit(0))).cast("long").alias(n) for n in sums], last.alias("_last")).select(*who, "date", *sums, "_last.*")
    first = teams.select(*who, c("_start").alias("date"), *[F.lit(0).cast(t).alias(n) for n, t in daily.dtypes if n not in (*who, "date")], F.lit(False).alias("_played"))
    # The first day can have games: then its row without any comes before the one with them, and stands for no day.
    line = W.over(who, ["date", "_played"])
    inside = daily.join(teams.select(*who, "_start", "_end"), who).where("date BETWEEN _start AND _end").drop("_start", "_end").withColumn("_played", F.lit(True))
    steps = inside.unionByName(first).withColumns({n: F.sum(n).over(line) for n in sums} | {"_next": F.lead("date").over(line)})
    until = F.coalesce(F.date_sub("_next", 1), c("_end"))
    grid = steps.join(teams, who).withColumn("_until", until).where("date <= _until").withColumn("date", F.explode(F.sequence("date", "_until")))
    played = c("wins") + c("losses")
    ahead = F.max(c("wins") - c("losses")).over(W.over(["season", "league", "division", "date"]))
    power = lambda n: F.pow(c(n).cast("double"), F.lit(1.85))
    return grid.select(
        "season", "date", "league", "division", "team_id", "team_name", "wins", "losses", F.try_divide(c("wins").cast("double"), played).alias("win_percentage"),
        F.greatest(F.lit(0.0), (ahead - (c("wins") - c("losses"))) / 2).alias("games_behind"), F.try_divide(power("runs_scored"), power("runs_scored") + power("runs_allowed")).alias("pythagorean_win_percentage"),
        F.try_divide((c("runs_scored") - c("runs_allowed")).cast("double"), played).alias("average_run_differential"), *streaks, "runs_scored", "runs_allowed", *SPLIT_COUNTS, *recent,
    )


@model
def calc_park_factors_basic(m) -> DataFrame:
    """Runs an inning in a park against those of the same two teams in other parks, over three seasons and set to the league's level."""
    c, who = F.col, ["park_id", "season", "league", "team_id", "opponent_id"]
    games = m.team_game_start_info.where(f"{REGULAR} AND NOT is_interleague").select("game_id", *who).join(m.team_game_results.select("game_id", "team_id", "runs_scored", "runs_allowed", "duration_outs"), ["game_id", "team_id"])
    sums = games.groupBy(*who).agg(F.sum(c("runs_scored") + c("runs_allowed")).alias("runs"), F.sum(F.coalesce(c("duration_outs") / 3, F.lit(18.0))).alias("innings"))
    league = sums.groupBy("season", "league").agg(F.try_divide(F.sum("runs").cast("double"), F.sum("innings")).alias("_league"))
    level = league.crossJoin(sums.agg(F.try_divide(F.sum("runs").cast("double"), F.sum("innings")).alias("_all"))).select("season", "league", F.try_divide(c("_league"), c("_all")).alias("_level"))  # one row
    three = W.over(["park_id", "league", "team_id", "opponent_id"], ["season"], (-2, 0))
    rates = sums.join(level, ["season", "league"]).withColumns({"_runs": F.try_divide(F.sum("runs").over(three).cast("double"), c("_level")), "size": F.sum("innings").over(three)})
    rates = rates.withColumn("rate", F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.try_divide(c("_runs"), c("size"))))).select(*who, "rate", "size")
    # The parks of two teams in a season are few.
    pairs = J.matched_pairs(rates, ["season", "league", "team_id", "opponent_id"], "park_id").withColumn("_w", F.sqrt(F.least("size", "other_size")))
    mean = lambda n: F.try_divide(F.sum(c(n) * c("_w")), F.sum("_w"))
    out = pairs.groupBy("park_id", "season", "league").agg(F.sum("_w").alias("sqrt_sample_size"), mean("rate").alias("avg_this_runs_per_inning"), mean("other_rate").alias("avg_other_runs_per_inning"))
    return out.withColumn("basic_park_factor", F.try_divide(c("avg_this_runs_per_inning"), c("avg_other_runs_per_inning")))


@model
def park_factors(m) -> DataFrame:
    """The basic factor of each park with its factors for single statistics, and an overall one: that of runs, or else the basic one."""
    keys = ["season", "park_id", "league"]
    advanced = m.park_factors_outs
    stats = [n for n in advanced.columns if n not in (*keys, "sqrt_sample_size", "sample_size")]
    both = m.calc_park_factors_basic.select(*keys, "basic_park_factor").join(advanced.select(*keys, *stats), keys, "left")
    return both.withColumn("overall_park_factor", F.coalesce("runs_factor", "basic_park_factor"))


@model
def season_team_coverage(m) -> DataFrame:
    """The coarsest source of any of a team's games of a season; forfeits and exhibitions within a league don't count."""
    games = J.without(m.team_game_start_info.where("game_type <> 'Exhibition' OR league IS NULL"), m.game_forfeits, ["game_id"])
    plays, box = F.col("source_type") == "PlayByPlay", F.col("source_type").isin("PlayByPlay", "BoxScore")
    tier = A.coverage_tier([("PlayByPlay", plays), ("BoxScore", box)], "GameLog")
    return games.groupBy("season", "team_id").agg(F.min("league").alias("league"), tier.alias("least_granular_source_type"))


#: Counters of box-score lines that can't exceed each other: table, player, name of the issue, the larger one and its bound.
LINE_ISSUES = [
    ("batting", "hits_gt_at_bats", "hits", "at_bats"), ("batting", "strikeouts_gt_plate_appearances", "strikeouts", "plate_appearances"), ("batting", "extra_base_hits_gt_hits", "coalesce(doubles, 0) + coalesce(triples, 0) + coalesce(home_runs, 0)", "hits"),
    ("pitching", "hits_gt_batters_faced", "hits", "batters_faced"), ("pitching", "home_runs_gt_hits", "home_runs", "hits"), ("pitching", "strikeouts_gt_batters_faced", "strikeouts", "batters_faced"), ("pitching", "earned_runs_gt_runs", "earned_runs", "runs"),
]


@model
def box_score_data_issues(m) -> DataFrame:
    """Lines of box scores whose counters contradict each other, a row for each contradiction; a table is read once for all of its rules."""
    parts = []
    for kind, player in (("batting", "batter_id"), ("pitching", "pitcher_id")):
        rules = [F.when(F.expr(f"({a}) > ({b})"), F.struct(F.lit(name).alias("issue_type"), F.expr(a).cast("long").alias("value_a"), F.expr(b).cast("long").alias("value_b"))) for k, name, a, b in LINE_ISSUES if k == kind]
        found = getattr(m, f"stg_box_score_{kind}_lines").select(F.lit(f"stg_box_score_{kind}_lines").alias("source_table"), "game_id", F.col(player).alias("player_id"), F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("_x"))
        parts.append(found.select("source_table", "game_id", "player_id", "_x.*"))
    return parts[0].unionByName(parts[1])


@model
def team_game_data_issues(m) -> DataFrame:
    """Listed starting pitchers of games told play by play who don't appear in any play."""
    games = m.game_start_info.join(m.stg_games.where("source_type = 'PlayByPlay'").select("game_id"), "game_id", "left_semi")
    side = lambda s: F.struct(F.col(f"{s}_team_id").alias("team_id"), F.col(f"{s}_starting_pitcher_id").alias("player_id"))
    listed = games.select("game_id", F.explode(F.array(side("home"), side("away"))).alias("_s")).select("game_id", "_s.*").where("player_id IS NOT NULL")
    absent = J.without(listed, m.event_pitching_stats, ["game_id", "team_id", "player_id"])
    return absent.select("game_id", "team_id", F.lit("starting_pitcher_no_appearance").alias("issue_type"), F.concat(F.lit("recorded SP "), F.col("player_id").cast("string"), F.lit(" never appeared in events")).alias("notes"))
