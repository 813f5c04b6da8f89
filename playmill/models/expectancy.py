"""Value models: what a state of the game is worth, what each play changed, and how parks change what happens in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import estimate
from ..operators import windows as W
from .catalogue import MODELS, model

E = F.expr
KEY = "event_key"
REGULAR = "game_type = 'RegularSeason'"


@model
def run_expectancy_matrix(m) -> DataFrame:
    """Runs to the end of the frame by era, league, outs and bases, over whole frames of the first eight innings."""
    frame = ["game_id", "frame_start", "inning_start"]
    plays = m.event_states_full.where(f"{REGULAR} AND inning_start < 9")
    whole = plays.withColumns({"runs_scored": W.rest_of_group(F.col("runs_on_play"), frame, ["event_id"]), "_cut": F.max("truncated_frame_flag").over(W.over(frame))}).where("NOT _cut")
    states = [F.col(a).alias(b) for a, b in (("run_expectancy_start_key", "run_expectancy_key"), ("league_group", "league_group"), ("season_group", "season_group"), ("outs_start", "outs"), ("base_state_start", "base_state"))]
    matrix = estimate.state_matrix(whole.select(*states, "runs_scored"), ["run_expectancy_key", "league_group", "season_group", "outs", "base_state"], F.col("runs_scored"))
    return matrix.select("run_expectancy_key", "league_group", "season_group", "outs", "base_state", F.round("mean", 2).alias("avg_runs_scored"), F.round(F.coalesce("variance", F.lit(2.0)), 0).alias("variance_runs_scored"), F.col("n").alias("sample_size"))


@model
def win_expectancy_matrix(m) -> DataFrame:
    """How often the home team wins from each state, shrunken to the rate of states like it.

    Games count that were not tied at the end, went nine innings, and in which
    the visitors batted first.
    """
    own = ["win_expectancy_key", "inning", "frame", "truncated_home_margin", "outs", "base_state"]
    like = ["inning", "frame", "_margin", "_runners"]
    first = m.stg_games.where("bat_first_side = 'Away'").select("game_id")
    at_end = lambda c: W.last_of_group(E(c), ["game_id"], ["event_id"])
    plays = m.event_states_full.join(first, "game_id", "left_semi").withColumns({"_won": at_end("home_margin_end > 0"), "_tied": at_end("home_margin_end = 0"), "_innings": at_end("inning_start")}).where("NOT _tied AND _innings >= 9")
    margin = E("CAST(sign(home_margin_start) * least(ceil(abs(home_margin_start) / 3), 3) AS INT)")
    named = {"win_expectancy_key": "win_expectancy_start_key", "inning": "inning_group_start", "frame": "frame_start", "truncated_home_margin": "truncated_home_margin_start", "outs": "outs_start", "base_state": "base_state_start"}
    states = plays.select(*[F.col(old).alias(new) for new, old in named.items()], margin.alias("_margin"), E("base_state_start > 0").alias("_runners"), "_won")
    return estimate.shrunken_rates(states, own, like, F.col("_won")).select(*own, F.round("rate", 3).alias("home_win_rate"))


@model
def event_transition_values(m) -> DataFrame:
    """The change in expected runs and in the home team's and the batting team's chances that each play made.

    A play that ends a game makes the chance 1 or 0; where it ends in a tie, the
    play is left out.
    """
    plays = m.event_states_full.where(f"{REGULAR} AND NOT (game_end_flag AND truncated_home_margin_end = 0)")
    runs = lambda x: m.run_expectancy_matrix.select(F.col("run_expectancy_key").alias(f"run_expectancy_{x}_key"), F.col("avg_runs_scored").alias(f"_runs_{x}"))
    wins = lambda x: m.win_expectancy_matrix.select(F.col("win_expectancy_key").alias(f"win_expectancy_{x}_key"), F.col("home_win_rate").alias(f"_wins_{x}"))
    for x in ("start", "end"):
        plays = plays.join(runs(x), f"run_expectancy_{x}_key", "left").join(wins(x), f"win_expectancy_{x}_key", "left")
    after = F.when(~F.col("game_end_flag"), F.col("_wins_end")).when(F.col("truncated_home_margin_end") > 0, 1.0).otherwise(0.0)
    change = F.round(after - F.col("_wins_start"), 3)
    states = [f"{c}_{x}" for x in ("start", "end") for c in ("inning", "frame", "truncated_home_margin", "base_state", "outs")]
    return plays.select(
        KEY, *states, "run_expectancy_start_key", "run_expectancy_end_key", "win_expectancy_start_key", "win_expectancy_end_key", "season", "league", "game_type", "batting_side", "runs_on_play", "game_end_flag",
        F.round(F.col("runs_on_play") + F.coalesce("_runs_end", F.lit(0.0)) - F.col("_runs_start"), 3).alias("expected_runs_change"), change.alias("expected_home_win_change"),
        F.when(F.col("batting_side") == "Home", change).otherwise(-change).alias("expected_batting_win_change"),
    )


@model
def leverage_index(m) -> DataFrame:
    """The mean change that plays from a state make, of chances and of runs, relative to that from all states."""
    start, end = "win_expectancy_start_key", "win_expectancy_end_key"
    plays = m.event_transition_values
    pairs = plays.groupBy(start, end).agg(F.count("*").alias("_n"), F.avg(F.abs("expected_home_win_change")).alias("_win"), F.avg(F.abs("expected_runs_change")).alias("_run"))
    kinds = ("win", "run")
    each = pairs.groupBy(start).agg(F.sum("_n").alias("agg_sample_size"), *[(F.sum(F.col(f"_{k}") * F.col("_n")) / F.sum("_n")).alias(f"_{k}") for k in kinds])
    total = each.agg(*[(F.sum(F.col(f"_{k}") * F.col("agg_sample_size")) / F.sum("agg_sample_size")).alias(f"_{k}_all") for k in kinds])
    wide = each.crossJoin(total)
    return wide.select(start, *[F.round(F.round(f"_{k}", 9), 3).alias(f"{k}_leverage_unscaled") for k in kinds], *[F.round(F.round(F.try_divide(F.col(f"_{k}"), F.col(f"_{k}_all")), 9), 2).alias(f"{k}_leverage_index") for k in kinds], "agg_sample_size")


@model
def linear_weights(m) -> DataFrame:
    """What each kind of play is worth in runs and in chances, by season and league; where fewer than 101 were made, by all plays of the kind.

    A batter's play counts if no runner made one at the same time, a runner's if
    it is the only one of a play without a batter's result.
    """
    c = F.col
    # Keys of all plays look small beside the files of their tables: told to, they merge where they lie and never go through the driver.
    ran = m.stg_event_baserunners.join(m.seed_baserunning_play_types, "baserunning_play_type")
    batted = m.stg_events.join(m.seed_result_categories, "plate_appearance_result").join(m.stg_event_baserunners.where("baserunning_play_type IS NOT NULL").select(KEY).hint("merge"), KEY, "left_anti")
    batted = batted.select(KEY, E("CASE WHEN result_category = 'InPlayOut' AND outs_on_play > 1 THEN 'DoublePlay' ELSE result_category END").alias("play"), F.lit("BATTING").alias("play_category"))
    alone = ran.join(m.stg_events.where("plate_appearance_result IS NOT NULL").select(KEY).hint("merge"), KEY, "left_anti").groupBy(KEY).agg(F.count("*").alias("_n"), F.min(E("CASE WHEN is_out THEN result_category_out ELSE result_category_safe END")).alias("play"))
    plays = batted.unionByName(alone.where("_n = 1").select(KEY, "play", F.lit("BASERUNNING").alias("play_category")))
    values = plays.join(m.event_transition_values.select(KEY, "season", "league", "expected_runs_change", "expected_batting_win_change").hint("merge"), KEY)
    both = {"run": "expected_runs_change", "win": "expected_batting_win_change"}
    mean = lambda: [F.avg(v).alias(f"_{k}_all") for k, v in both.items()]
    each = lambda: [f(v).alias(f"_{n}_{k}") for k, v in both.items() for n, f in (("own", F.avg), ("dev", F.stddev_samp))]
    own = values.groupBy("season", "league", "play").agg(F.min("play_category").alias("play_category"), F.count("*").alias("_n"), *each()).where("_n > 100").drop("_n")
    level = values.groupBy(c("season").alias("_season"), c("league").alias("_league")).agg(*mean())
    own = own.join(level, (c("season") == c("_season")) & c("league").eqNullSafe(c("_league"))).drop("_season", "_league")
    ever = values.groupBy("play").agg(F.min("play_category").alias("play_category"), *each()).crossJoin(values.agg(*mean()))  # kinds of play, and one row
    leagues = m.team_game_results.where("league IS NOT NULL").select("season", "league").distinct()
    rest = leagues.crossJoin(F.broadcast(ever)).join(own.select("season", "league", "play"), ["season", "league", "play"], "left_anti")
    every = own.withColumn("is_imputed", F.lit(False)).unionByName(rest.withColumn("is_imputed", F.lit(True)))
    base = F.max(F.when(c("play") == "InPlayOut", c("_own_run"))).over(W.over(["season", "league"]))
    short = lambda x: F.round(F.round(x, 9), 3)
    return every.select(
        "season", F.coalesce("league", F.lit("N/A")).alias("league"), "play", "play_category", *[short(c(f"_own_{k}") - c(f"_{k}_all")).alias(f"average_{k}_value") for k in both], (c("_own_run") - base).alias("relative_run_value"),
        *[short(c(f"_dev_{k}")).alias(f"std_dev_{k}_value") for k in both], "is_imputed",
    )


@model
def unknown_fielding_play_shares(m) -> DataFrame:
    """How the plays of a game whose fielder isn't known are spread over a team's players, from what the box score credits them with beyond the known plays.

    Outfielders by surplus putouts; infielders by surplus assists and by their
    part of the putouts that neither explains, weighed by how often a putout at
    the position is unassisted.
    """
    c, team = F.col, ["game_id", "team_id"]
    outs = m.stg_events.where("plate_appearance_result = 'InPlayOut' AND batted_to_fielder > 0 AND outs_on_play = 1").select(KEY)
    rates = m.calc_fielding_play_agg.join(outs, KEY, "left_semi").groupBy("fielding_position").agg(F.try_divide(F.sum(c("putouts") - c("assisted_putouts")).cast("double"), F.sum("putouts")).alias("_rate"))
    players = m.player_position_game_fielding_stats.join(m.team_game_fielding_stats.where("unknown_putouts > 0").select(*team).distinct(), team, "left_semi")
    total = lambda rule, n: F.greatest(F.sum(F.when(E(rule), c(n))).over(W.over(team)), F.lit(0))
    told = players.withColumns({"_all": total("true", "surplus_box_putouts"), "_outfield": total("fielding_position > 6", "surplus_box_putouts"), "_assists": total("fielding_position < 6", "surplus_box_assists")})
    told = told.withColumn("_left", F.greatest(c("_all") - c("_outfield") - c("_assists"), F.lit(0))).join(rates, "fielding_position")
    part = F.when((c("fielding_position") <= 6) & (c("_left") > 0), F.try_divide(c("surplus_box_putouts").cast("double"), c("_left"))).otherwise(0.0)
    told = told.withColumn("_part", F.greatest(part * c("_rate"), F.lit(0.0)))
    told = told.withColumn("_share", F.coalesce(F.try_divide(c("_part"), F.sum("_part").over(W.over(team))), F.lit(0.0)))
    outfield = c("fielding_position") > 6
    putouts = F.greatest(F.when(outfield, c("surplus_box_putouts").cast("double")).otherwise(c("_share") * c("_left")), F.lit(0.0))
    assists = F.greatest(F.when(outfield, 0.0).otherwise(c("surplus_box_assists").cast("double")), F.lit(0.0))
    known = told.withColumns({"_putouts": putouts, "_assist": assists}).withColumn("estimated_unknown_plays", c("_putouts") + c("_assist")).where("estimated_unknown_plays > 0")
    known = known.withColumn("estimated_unknown_plays_team", F.sum("estimated_unknown_plays").over(W.over(team)))
    of = lambda n, name: (c(n) / c("estimated_unknown_plays_team")).alias(name)
    return known.select(*team, "fielding_position", "player_id", "estimated_unknown_plays", "estimated_unknown_plays_team", of("estimated_unknown_plays", "play_share"), of("_assist", "play_share_subset_assists"), of("_putouts", "play_share_subset_putouts"))


# The statistics of each variant, what they are divided by, and the plays that count.
_HITS = ["singles", "doubles", "triples"]
_FIELDS = ["batted_location_left_field", "batted_location_center_field", "batted_location_right_field"]
_REACH = ["batted_distance_plate", "batted_distance_infield", "batted_distance_outfield", "fielded_by_battery", "fielded_by_infielder", "fielded_by_outfielder", "batted_angle_left", "batted_angle_right", "batted_angle_middle"]
FACTORS = {
    "in_play": {"stats": ["hits", *_HITS, "reached_on_errors", "batting_outs"], "size": "balls_in_play", "keep": "balls_in_play = 1"},
    "outs": {"stats": [*_HITS, "home_runs", "strikeouts", "reached_on_errors", "walks", "plate_appearances", "runs", "balls_in_play"], "size": "batting_outs", "odds": False},
    "plate_appearances": {"stats": [*_HITS, "home_runs", "strikeouts", "reached_on_errors", "walks", "batting_outs", "runs", "balls_in_play"], "size": "plate_appearances"},
    "trajectory_outs": {"stats": ["trajectory_broad_air_ball", "trajectory_ground_ball", "trajectory_fly_ball", "trajectory_line_drive", "trajectory_pop_up"], "size": "plate_appearances", "keep": "trajectory_known = 1 AND batting_outs > 0"},
    "hit_location": {"stats": [*_REACH, *_FIELDS], "size": "plate_appearances", "keep": "batted_location_known = 1 AND hits = 1", "hands": True},
    "out_location": {"stats": [*_REACH, "batted_location_plate", "batted_location_right_infield", "batted_location_middle_infield", "batted_location_left_infield", *_FIELDS], "size": "plate_appearances", "keep": "batted_location_known = 1 AND batting_outs > 0", "hands": True},
}


def park_factor(m, stats: list[str], size: str, keep: str = "true", hands: bool = False, odds: bool = True, least: int = 25) -> DataFrame:
    """How a park changes statistics of the same batters against the same pitchers, by season and league (and the batter's hand)."""
    parks = m.game_start_info.where(REGULAR).groupBy("park_id", "season", F.col("home_league").alias("league")).agg(F.count("*").alias("_n")).where(F.col("_n") > least).drop("_n")
    lines = m.event_offense_stats.where(keep).select(KEY, size, *stats)
    plays = m.event_states_full.where(f"{REGULAR} AND NOT is_interleague" + (" AND batter_hand IN ('L', 'R')" if hands else "")).select(KEY, "park_id", "season", "league", "batter_id", "pitcher_id", "batter_hand")
    met = ["park_id", "season", "league", "batter_id", "pitcher_id"]
    faced = plays.join(lines, KEY).join(parks, ["park_id", "season", "league"], "left_semi").groupBy(*met).agg(F.min("batter_hand").alias("batter_hand"), *[F.sum(c).alias(c) for c in (size, *stats)]).where(F.col(size) > 0)
    split = ["batter_hand"] if hands else []
    return estimate.paired_factors(faced.drop(*({"batter_hand"} - set(split))), parks, "park_id", "season", ["league"], ["batter_id", "pitcher_id"], split, stats, size, odds=odds)


MODELS |= {f"park_factors_{name}": lambda m, v=variant: park_factor(m, **v) for name, variant in FACTORS.items()}
