"""What plays led to, what was known before them, and predictions of one from the other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import windows as W
from .catalogue import flag, model

KEY = "event_key"
#: Weights beside the generic one, and the rows that count for each.
WEIGHTS = {"plate_appearance": "outcome_has_batting_bin", "in_play": "outcome_has_batting_bin", "trajectory": "_known_contact", "location": "_known_location", "baserunning_play": "1 - outcome_has_batting_bin", "win": "_full_game"}
OUTCOMES = ["has_batting_bin", "is_in_play_bin", "batted_trajectory_cat", "batted_location_cat", "plate_appearance_cat", "baserunning_cat", "runs_following_num", "is_win_bin"]


@dataclass(frozen=True)
class Target:
    """A column to predict, its weight and kind; of every, rows of weight 0 are left out of a fit too."""

    name: str
    weight: str
    kind: str
    weighed_only: bool = False

    @property
    def column(self) -> str:
        return f"outcome_{self.name}"


TARGETS = [
    Target("plate_appearance_cat", "plate_appearance_sample_weight", "multiclass"), Target("is_in_play_bin", "in_play_sample_weight", "binary"), Target("batted_trajectory_cat", "trajectory_sample_weight", "multiclass", True),
    Target("batted_location_cat", "location_sample_weight", "multiclass", True), Target("baserunning_cat", "baserunning_play_sample_weight", "multiclass"), Target("runs_following_num", "generic_sample_weight", "regression"),
    Target("is_win_bin", "win_sample_weight", "binary"), Target("has_batting_bin", "generic_sample_weight", "binary"),
]
NUMBERS = ["season_num", "day_of_year_num", "inning_num", "frame_num", "is_night_game_num", "score_batting_team_num", "score_fielding_team_num"]
CATEGORIES = ["park_cat", "game_type_cat", "league_cat", "base_state_cat"]
PLAYERS = ["batter_player", "runner_first_player", "runner_second_player", "runner_third_player", "pitcher_player"]


@model
def ml_event_outcomes(m) -> DataFrame:
    """Eight outcomes of each play that a batter or a runner took part in, and weights that give every season (those before 1913 together) the same say.

    Of the runners' results of a play the first by priority counts, ties by name.
    """
    c = F.col
    known = m.seed_plate_appearance_result_types.select("plate_appearance_result", "is_in_play").join(m.seed_result_categories, "plate_appearance_result", "left")
    balls = m.calc_batted_ball_type.select(KEY, "trajectory", "location_depth", "location_side")
    plays = m.stg_events.withColumn("_runs", W.rest_of_group(c("runs_on_play"), ["game_id", "inning", "batting_side"], ["event_id"])).join(known, "plate_appearance_result", "left").join(balls, KEY, "left")
    result = F.expr("CASE WHEN is_out THEN result_category_out ELSE result_category_safe END")
    ran = m.stg_event_baserunners.join(m.seed_baserunning_play_types, "baserunning_play_type").withColumn("_r", result).groupBy(KEY).agg(F.min_by("_r", F.struct("priority", "_r")).alias("_ran"))
    ended = m.game_results.select("game_id", "winning_side")
    rows = plays.join(ran, KEY, "left").join(ended, "game_id").where("result_category IS NOT NULL OR _ran IS NOT NULL")
    known_ball = lambda *names: flag(" AND ".join(f"{n} <> 'Unknown'" for n in names))
    told = rows.select(
        KEY, F.greatest(F.lit(1913), "season").alias("_season"), flag("result_category IS NOT NULL").alias("outcome_has_batting_bin"), flag("is_in_play").alias("outcome_is_in_play_bin"),
        *[F.coalesce(F.expr(x), F.lit("Other")).alias(f"outcome_{n}") for n, x in (("batted_trajectory_cat", "trajectory"), ("batted_location_cat", "location_depth || '-' || location_side"), ("plate_appearance_cat", "result_category"), ("baserunning_cat", "_ran"))],
        c("_runs").cast("double").alias("outcome_runs_following_num"), flag("winning_side = batting_side").alias("outcome_is_win_bin"), known_ball("trajectory").alias("_known_contact"),
        known_ball("location_depth", "location_side").alias("_known_location"), flag("winning_side IS NOT NULL").alias("_full_game"),
    )
    sizes = told.groupBy("_season").agg((1.0 / F.count("*")).alias("_factor"))
    weighed = told.join(sizes, "_season").withColumns({f"_{n}": c("_factor") * F.expr(rule) for n, rule in WEIGHTS.items()})
    means = weighed.agg(F.avg("_factor").alias("_m_factor"), *[F.avg(f"_{n}").alias(f"_m_{n}") for n in WEIGHTS])  # one row
    out = weighed.crossJoin(means)
    return out.select(KEY, *[f"outcome_{n}" for n in OUTCOMES], F.try_divide(c("_factor"), c("_m_factor")).alias("generic_sample_weight"), *[F.try_divide(c(f"_{n}"), c(f"_m_{n}")).alias(f"{n}_sample_weight") for n in WEIGHTS])


@model
def ml_features(m) -> DataFrame:
    """Outcomes with what was known before the play, and whether its game is to learn from (98 of 100, by a hash) or to test on."""
    c = F.col
    states = m.event_states_full
    number = lambda x: F.expr(x).cast("double")
    place = F.conv(F.substring(F.md5(c("game_id").cast("string")), 1, 8), 16, 10).cast("long") % 100
    known = states.select(
        KEY, number("season").alias("season_num"), number("dayofyear(date)").alias("day_of_year_num"), number("least(inning_start, 10)").alias("inning_num"), number("CASE WHEN frame_start = 'Top' THEN 0 ELSE 1 END").alias("frame_num"),
        number("CASE WHEN time_of_day = 'Night' THEN 1 ELSE 0 END").alias("is_night_game_num"), number("CASE WHEN batting_side = 'Home' THEN score_home_start ELSE score_away_start END").alias("score_batting_team_num"),
        number("CASE WHEN batting_side = 'Home' THEN score_away_start ELSE score_home_start END").alias("score_fielding_team_num"), c("park_id").alias("park_cat"), c("game_type").alias("game_type_cat"),
        F.coalesce("league", F.lit("None")).alias("league_cat"), c("base_state_start").cast("string").alias("base_state_cat"), c("batter_id").cast("string").alias("batter_player"),
        *[F.coalesce(c(f"runner_{b}_id_start").cast("string"), F.lit("N/A")).alias(f"runner_{b}_player") for b in ("first", "second", "third")], c("pitcher_id").cast("string").alias("pitcher_player"), F.when(place < 98, "TRAIN").otherwise("TEST").alias("meta_train_test_split"),
    )
    return m.ml_event_outcomes.join(known, KEY, "left")
