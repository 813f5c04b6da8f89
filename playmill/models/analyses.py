"""Analyses: completeness of the accounts, tendencies of scorekeepers, what runners and fielders gain, and where hits fall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import windows as W
from .catalogue import model

E = F.expr
KEY = "event_key"


def known(condition: str) -> Column:
    """Whether the condition is known to hold."""
    return F.coalesce(E(condition), F.lit(False))


def ratio(over: Column | str, under: Column | str) -> Column:
    of = lambda c: F.sum(E(c)) if isinstance(c, str) else c
    return F.try_divide(of(over).cast("double"), of(under).cast("double"))


@model
def event_completeness_batted_balls(m) -> DataFrame:
    """Which facts of each batted ball are recorded."""
    e = m.stg_events.join(m.seed_plate_appearance_result_types, "plate_appearance_result")
    told = {"has_trajectory": "batted_trajectory <> 'Unknown'", "has_general_location": "batted_location_general <> 'Unknown'", "has_depth": "batted_location_depth <> 'Unknown'", "has_angle": "batted_location_side <> 'Unknown'"}
    e = e.withColumns({n: known(c) for n, c in told.items()}).withColumn("has_batted_to_fielder", known("batted_to_fielder <> 0 OR (NOT is_in_play AND has_general_location)"))
    kinds = {"groundball": "batted_trajectory = 'GroundBall'", "airball": "batted_trajectory IN ('Fly', 'LineDrive', 'PopUp')"}
    facts = {"general_location": "batted_location_general IS NOT NULL", "depth": "batted_location_depth <> 'Unknown'", "angle": "batted_location_side <> 'Unknown'"}
    return e.select(KEY, *told, "has_batted_to_fielder", (F.col("has_batted_to_fielder") | F.col("has_general_location")).alias("has_any_location"), *[known(f"{c} AND {f}").alias(f"has_{n}_{k}") for n, f in facts.items() for k, c in kinds.items()])


@model
def event_completeness_fielding_credit(m) -> DataFrame:
    """Whether the fielders of each plate appearance's putouts, assists and errors are recorded."""
    lost = {"putouts": ["Putout"], "assists": ["Putout", "Assist"], "errors": ["Error"]}
    per = m.stg_event_fielding_plays.groupBy(KEY).agg(*[(~F.bool_or((F.col("fielding_position") == 0) & F.col("fielding_play").isin(v))).alias(f"has_fielder_{n}") for n, v in lost.items()])
    e = m.stg_events.where("plate_appearance_result IS NOT NULL").select(KEY)
    return e.join(per, KEY, "left").select(KEY, *[F.coalesce(f"has_fielder_{n}", F.lit(True)).alias(f"has_fielder_{n}") for n in lost])


@model
def event_completeness_pitches(m) -> DataFrame:
    """Whether each plate appearance's count and pitches are recorded."""
    p = m.stg_event_pitch_sequences.join(m.seed_pitch_types.where("is_pitch"), "sequence_item").groupBy(KEY).agg(
        F.bool_and(F.col("category") != "Unknown").alias("has_pitch_results"), F.bool_and((F.col("category") != "Unknown") & (F.col("sequence_item") != "StrikeUnknownType")).alias("has_strike_types"), F.lit(True).alias("has_pitches"),
    )
    e = m.stg_events.select(KEY, "plate_appearance_result", E("count_balls IS NOT NULL").alias("has_count_balls"), E("count_strikes IS NOT NULL").alias("has_count_strikes"), E("count_balls + count_strikes IS NOT NULL").alias("has_count"))
    return e.join(p, KEY, "left").where("plate_appearance_result IS NOT NULL OR has_pitches").drop("plate_appearance_result").fillna(False, ["has_pitches", "has_pitch_results", "has_strike_types"])


BALL_FACTS = {"has_trajectory": "trajectory <> 'Unknown'", "has_location": "location_side <> 'Unknown'", "has_batted_to_fielder": "batted_to_fielder <> 0 OR NOT is_in_play"}
PITCH_FACTS = ["has_count_balls", "has_count_strikes", "has_count", "has_pitches", "has_pitch_results", "has_strike_types"]


def _balls(m) -> DataFrame:
    return m.calc_batted_ball_type.join(m.seed_plate_appearance_result_types, "plate_appearance_result", "left")


@model
def game_data_completeness(m) -> DataFrame:
    """Which facts are recorded throughout a game."""
    e = m.stg_events.select("game_id", KEY)
    balls = _balls(m).groupBy("game_id").agg(*[F.bool_and(E(c)).alias(n) for n, c in BALL_FACTS.items()])
    every = lambda df, names: e.join(df, KEY, "left").groupBy("game_id").agg(*[F.bool_and(c).alias(c) for c in names])
    credit = [f"has_fielder_{n}" for n in ("putouts", "assists", "errors")]
    parts = [balls, every(m.event_completeness_fielding_credit, credit), every(m.event_completeness_pitches, PITCH_FACTS)]
    info = m.game_start_info.select("game_id", "season", "date", F.col("home_league").alias("league"), (F.col("source_type") == "PlayByPlay").alias("has_play_by_play"), (F.col("source_type") == "BoxScore").alias("has_box_score"))
    return J.left_chain(info, parts, ["game_id"]).fillna(False, [*BALL_FACTS, *credit, *PITCH_FACTS])


@model
def player_game_data_completeness(m) -> DataFrame:
    """Which facts are recorded throughout a player's plays in a game, as batter and as pitcher."""
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("player_type"), F.col(c).alias("player_id")) for k, c in (("BATTING", "batter_id"), ("PITCHING", "pitcher_id"))])).alias("x")
    e = m.stg_events.select("game_id", KEY, both).select("game_id", KEY, "x.*")
    keys = ["game_id", "player_type", "player_id"]
    balls = e.join(_balls(m).drop("game_id"), KEY, "left").groupBy(*keys).agg(*[F.coalesce(F.bool_and(E(c)), F.lit(True)).alias(n) for n, c in BALL_FACTS.items()])
    pitches = e.join(m.event_completeness_pitches, KEY, "left").groupBy(*keys).agg(*[F.coalesce(F.bool_and(c), F.lit(False)).alias(c) for c in PITCH_FACTS])
    info = m.game_start_info.select("game_id", "season", "date", F.col("home_league").alias("league"))
    return balls.join(pitches, keys, "full").join(info, "game_id", "left")


@model
def player_completeness(m) -> DataFrame:
    """In how many of a player's games each fact is recorded throughout."""
    facts = [*BALL_FACTS, *PITCH_FACTS]
    return m.player_game_data_completeness.groupBy("player_id", "player_type").agg(F.count("*").alias("total_games"), *[F.count_if(c).alias(c.removeprefix("has_")) for c in facts])


def _above_average(m, rows: DataFrame, state: list[str], who: str, season_state: list[str]) -> DataFrame:
    """What an actor gains over the mean of each state, seasons evened out, and its worth in runs."""
    gains = {"bases": "bases_advanced", "outs": "unforced_outs_on_basepaths"}
    mean = {n: F.avg(c).over(W.over(state)) for n, c in gains.items()}
    over = rows.withColumns({f"{n}_over": F.col(c) - mean[n] for n, c in gains.items()})
    even = over.withColumns({f"{n}_even": F.col(f"{n}_over") - F.avg(f"{n}_over").over(W.over(season_state)) for n in gains})
    leaders = even.groupBy(who).agg(F.count_distinct(KEY).alias("plate_appearances"), *[F.sum(f"{n}_even").alias(f"{n}_aa") for n in gains])
    return leaders.withColumn("run_value", F.col("bases_aa") * 0.2 - F.col("outs_aa") * 0.42)


def _in_play(m) -> DataFrame:
    e = m.stg_events.select(KEY, "season", "outs", "base_state", "batted_to_fielder", "outs_on_play", "plate_appearance_result")
    kind = m.calc_batted_ball_type.select(KEY, F.col("trajectory_broad_classification").alias("trajectory"))
    b = m.event_baserunning_stats.select(KEY, "baserunner", "runner_id", "bases_advanced", "unforced_outs_on_basepaths")
    return b.join(e, KEY).join(m.seed_plate_appearance_result_types.where("is_in_play"), "plate_appearance_result").join(kind, KEY, "left").fillna("Unknown", ["trajectory"]).fillna(-1, ["batted_to_fielder"])


@model
def runner_advance_expectancy(m) -> DataFrame:
    """Bases and outs of each runner beyond what others did in the same state and kind of play."""
    rows = _in_play(m).where("plate_appearance_result <> 'GroundRuleDouble'").withColumn("play", F.when(F.col("is_batting_out"), "InPlayOut").otherwise(F.col("plate_appearance_result")))
    state = ["base_state", "outs", "baserunner", "batted_to_fielder", "play", "trajectory"]
    out = _above_average(m, rows, state, "runner_id", ["season", *[c for c in state if c != "trajectory"]])
    return out.withColumn("run_value_per_100", F.col("run_value") / F.col("plate_appearances") * 100)


@model
def fielder_advance_expectancy(m) -> DataFrame:
    """Bases and outs of runners beyond the usual on balls hit to each fielder."""
    out = E("CASE WHEN plate_appearance_result = 'ReachedOnError' OR plate_appearance_result = 'FieldersChoice' AND outs_on_play = 0 THEN false ELSE is_batting_out END")
    who = m.event_player_fielding_stats.select(KEY, F.col("player_id").alias("fielder_id"), F.col("fielding_position").alias("batted_to_fielder"))
    rows = _in_play(m).withColumn("out", out).join(who, [KEY, "batted_to_fielder"], "left")
    state = ["base_state", "outs", "baserunner", "batted_to_fielder", "out", "trajectory"]
    leaders = _above_average(m, rows, state, "fielder_id", ["season", *state]).where("plate_appearances > 20")
    return leaders.withColumns({f"{c}_per_pa": F.col(c) / F.col("plate_appearances") for c in ("bases_aa", "outs_aa", "run_value")})


def _hits(m) -> DataFrame:
    """Offense rows with the batted ball's location and the hands."""
    ball = m.calc_batted_ball_type.select(KEY, "batted_location_general", "location_side", "location_depth", "batted_to_fielder", "trajectory")
    hands = m.event_states_batter_pitcher.select(KEY, "batter_hand", "pitcher_hand")
    return m.event_offense_stats.join(ball, KEY).join(hands, KEY)


def _spray(rows: DataFrame, keys: list[str]) -> DataFrame:
    t = rows.groupBy("batter_hand", *keys).agg(F.count("*").alias("at_bats"), F.sum("hits").alias("h"), F.sum(1 - F.col("hits")).alias("o"))
    by = ["batter_hand"]
    return t.select("batter_hand", *keys, "at_bats", (F.col("h") / F.col("at_bats")).alias("avg"), W.share(F.col("h"), by).alias("hit_share"), W.share(F.col("o"), by).alias("out_share"))


@model
def hit_vs_out_spray(m) -> DataFrame:
    """Where hits and outs fall, by the batter's hand."""
    return _spray(_hits(m).where("trajectory_known = 1 AND bunts = 0 AND balls_in_play = 1"), ["batted_location_general", "location_side", "location_depth"])


@model
def hit_vs_out_spray_air(m) -> DataFrame:
    """Who fields air balls that are hits and outs, by the batter's hand."""
    return _spray(_hits(m).where("trajectory_broad_air_ball = 1 AND bunts = 0 AND balls_in_play = 1 AND fielded_by_outfielder = 1"), ["batted_to_fielder"])


@model
def fielder_location_shares(m) -> DataFrame:
    """At bats and averages by hand, state, recorded location, trajectory and fielder."""
    states = m.stg_events.select(KEY, "season", "base_state", "outs")
    rows = _hits(m).join(states, KEY).where("batted_to_fielder > 0 AND batted_location_general <> 'Unknown' AND batter_hand IS NOT NULL AND trajectory_known = 1 AND sacrifice_hits = 0")
    keys = ["batter_hand", (F.col("season") > 2010).alias("is_shift_era"), "base_state", (F.col("outs") < 2).alias("under_two_outs"), "batted_location_general", "location_side", "location_depth", "batted_to_fielder", "trajectory"]
    return rows.groupBy(*keys).agg(F.count("*").alias("at_bats"), ratio("hits", F.count("*")).alias("batting_average"))


@model
def outfield_hits(m) -> DataFrame:
    """Hits to outfielders by hands, fielder and bases, and how many were on the ground."""
    rows = _hits(m).where("hits = 1 AND fielded_by_outfielder = 1 AND bunts = 0")
    return rows.groupBy("batter_hand", "pitcher_hand", "batted_to_fielder", "total_bases").agg(F.count("*").alias("hits"), ratio("trajectory_ground_ball", F.count("*")).alias("hit_gb_rate"))


@model
def most_blown_save_rbi(m) -> DataFrame:
    """Who batted in runs on plays that blew a save, and how often."""
    blown = m.event_pitching_flags.where("blown_save_flag")
    return J.among(m.event_offense_stats.where("runs_batted_in > 0"), blown, [KEY]).groupBy("player_id").agg(F.count("*").alias("n"))


@model
def ground_ball_hits(m) -> DataFrame:
    """How much of pitchers' ground-ball hit rates infield and outfield hits explain."""
    rows = m.event_pitching_stats.where("at_bats = 1 AND trajectory_ground_ball = 1 AND fielded_by_known = 1")
    t = rows.groupBy("player_id").agg(ratio("hits", F.count("*")).alias("hit"), ratio("hits * fielded_by_infielder", F.count("*")).alias("inf"), ratio("hits * fielded_by_outfielder", F.count("*")).alias("out"), F.count("*").alias("n")).where("n > 5")
    r2 = lambda x: F.when((F.var_pop(x) > 0) & (F.var_pop("hit") > 0), F.pow(F.covar_pop("hit", x), F.lit(2)) / (F.var_pop("hit") * F.var_pop(x)))
    return t.agg(r2("inf").alias("r2_infield"), r2("out").alias("r2_outfield"))


@model
def gb_babip_correlations(m) -> DataFrame:
    """What goes with pitchers' hit rate on ground balls."""
    rates = {
        "k_rate": ("strikeouts", "batters_faced"), "bb_rate": ("walks", "batters_faced"), "bip_rate": ("balls_in_play", "batters_faced"), "gb_rate": ("trajectory_ground_ball", "trajectory_known"), "air_ball_rate": ("trajectory_broad_air_ball", "trajectory_known"),
        "ld_rate": ("trajectory_line_drive", "trajectory_broad_air_ball"), "pu_rate": ("trajectory_pop_up", "trajectory_broad_air_ball"), "hr_rate": ("home_runs", "trajectory_broad_air_ball"), "pulled_gb": ("trajectory_ground_ball * batted_balls_pulled", "trajectory_ground_ball"),
        "oppo_gb": ("trajectory_ground_ball * batted_balls_opposite_field", "trajectory_ground_ball"), "middle_gb": ("trajectory_ground_ball * batted_angle_middle", "trajectory_ground_ball"), "weak": ("trajectory_ground_ball * fielded_by_battery", "trajectory_ground_ball"),
        "infield": ("infield_hits", "trajectory_ground_ball"),
    }
    rows = m.event_pitching_stats.where("batters_faced = 1 AND bunts = 0")
    t = rows.groupBy("player_id").agg(F.sum("trajectory_ground_ball").alias("gb"), ratio("trajectory_ground_ball * hits", "trajectory_ground_ball").alias("gb_hit_rate"), *[ratio(*r).alias(n) for n, r in rates.items()]).where("gb > 5")

    def corr(x: str) -> Column:
        both = F.col(x).isNotNull() & F.col("gb_hit_rate").isNotNull()
        a, b = F.when(both, F.col(x)), F.when(both, F.col("gb_hit_rate"))
        return F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a) * F.var_pop(b)))

    return t.agg(F.count("*").alias("n"), *[corr(x).alias(f"{x}_corr") for x in rates])


@model
def assists_as_putouts_finder(m) -> DataFrame:
    """Team games where unmarked pop-ups look like mistaken records of assists, against conventional ground outs."""
    plain = m.calc_fielding_play_agg.groupBy(KEY).agg(F.count_if(E("fielding_position = 3 AND assisted_putouts = 1")).alias("a"), F.sum("assists").alias("b"), F.count("*").alias("c")).where("a = 1 AND b = 1 AND c = 2").select(KEY, F.lit(True).alias("plain"))
    foul = m.stg_event_flags.select(KEY, "flag")
    e = m.stg_events.join(m.event_fielding_stats.select(KEY, "team_id", "putouts", "assisted_putouts"), KEY).join(foul, KEY, "left").join(plain, KEY, "left").where("coalesce(flag, 'Foul') = 'Foul'")
    pops = F.count_if(E("batted_to_fielder BETWEEN 1 AND 6 AND outs_on_play = 1 AND batted_trajectory = 'Unknown' AND flag IS NULL AND putouts - assisted_putouts = 1 AND base_state % 2 = 0"))
    counted = e.groupBy("game_id", "team_id").agg(pops.alias("no_force_unmarked_popups"), F.count_if(E("plain")).alias("infield_conventional_groundouts"))
    return counted.withColumn("rating", E("greatest(2 * no_force_unmarked_popups - infield_conventional_groundouts, no_force_unmarked_popups)")).where("no_force_unmarked_popups > 0").join(m.stg_games.select("game_id", "scorer", "park_id"), "game_id")


@model
def box_event_fielding_discrepancies(m) -> DataFrame:
    """How far summary and plays are apart in a team's fielding; missing credit counts one way only in games with unknown putouts."""
    lost = m.event_fielding_stats.where("unknown_putouts > 0").groupBy("game_id").agg(F.sum("unknown_putouts").alias("lost"))
    rows = m.player_position_game_fielding_stats.join(lost, "game_id", "left")
    off = lambda c: F.sum(F.abs(F.when(F.col("lost").isNotNull(), F.least(c, F.lit(0))).otherwise(F.col(c))))
    t = rows.groupBy("game_id", "team_id").agg(off("surplus_box_putouts").alias("putout_discrepancy"), off("surplus_box_assists").alias("assist_discrepancy"), F.sum(F.abs("surplus_box_errors")).alias("error_discrepancy"), F.coalesce(F.max("lost"), F.lit(0)).alias("unknown_putouts"))
    return t.withColumn("total", E("putout_discrepancy + assist_discrepancy + error_discrepancy")).where("total > 0").join(m.stg_games.select("game_id", "scorer", "park_id"), "game_id")


@model
def putout_innings_gaps(m) -> DataFrame:
    """Team games whose putouts don't add up to the outs pitched."""
    own = m.event_fielding_stats.groupBy("game_id", "team_id").agg(F.sum("putouts").alias("event_putouts"))
    f, p = m.team_game_fielding_stats.select("game_id", "team_id", "putouts"), m.team_game_pitching_stats.select("game_id", "team_id", F.col("outs_recorded").alias("ip_outs"))
    joined = p.join(f, ["game_id", "team_id"]).join(own, ["game_id", "team_id"], "left")
    return joined.withColumns({"diff": E("ip_outs - putouts"), "event_based_diff": E("ip_outs - event_putouts")}).where("diff <> 0")


def _located(m) -> DataFrame:
    """Scorekeepers, decades and hits of each batted ball."""
    k = m.game_scorekeeping.select("game_id", F.col("cleaned_scorer").alias("scorer"), "game_share", "scorer_more_common_team_id")
    e = m.stg_events.select(KEY, "season", "batting_team_id", "base_state", "runs_on_play", "batted_to_fielder", "batted_trajectory")
    return m.event_offense_stats.join(e, KEY).join(k, "game_id", "left").withColumn("decade", A.decade(F.col("season")))


@model
def scorekeeper_tendencies_contact(m) -> DataFrame:
    """How scorekeepers record the trajectory of hits and outs, by decade."""
    own, other = "CASE WHEN scorer_more_common_team_id = batting_team_id THEN hits ELSE 0 END", "CASE WHEN scorer_more_common_team_id <> batting_team_id THEN hits ELSE 0 END"
    rates = {
        "trajectory_known_hit_rate": ("trajectory_broad_known * hits", "hits"), "trajectory_known_affiliated_team_hit_rate": (f"{own} * trajectory_broad_known", own), "trajectory_known_opposing_team_hit_rate": (f"{other} * trajectory_broad_known", other),
        **{f"trajectory_known_{n}_rate": (f"{n}s * trajectory_broad_known", f"{n}s") for n in ("single", "double", "triple")}, "hit_ground_ball_rate": ("trajectory_ground_ball * hits * balls_in_play", "trajectory_broad_known * hits * balls_in_play"),
        "out_ground_ball_rate": ("trajectory_ground_ball * (1 - hits)", "trajectory_broad_known * (1 - hits)"), "air_hit_line_drive_rate": ("trajectory_line_drive * hits * balls_in_play", "trajectory_broad_air_ball * hits * balls_in_play"),
        "air_out_line_drive_rate": ("trajectory_line_drive * (1 - hits)", "trajectory_broad_air_ball * (1 - hits)"), "air_hit_popup_rate": ("trajectory_pop_up * hits", "trajectory_broad_air_ball * hits"), "air_out_popup_rate": ("trajectory_pop_up * (1 - hits)", "trajectory_broad_air_ball * (1 - hits)"),
        "home_run_line_drive_rate": ("home_runs * trajectory_line_drive", "home_runs"),
    }
    counts = {"n": "hits", "hits_trajectory_known": "trajectory_broad_known * hits", "hits_trajectory_unknown": "trajectory_broad_unknown * hits"}
    return _located(m).where("balls_batted = 1").groupBy("scorer", "decade").agg(*[F.sum(E(c)).alias(n) for n, c in counts.items()], *[ratio(*r).alias(n) for n, r in rates.items()])


@model
def scorekeeper_tendencies_location(m) -> DataFrame:
    """How scorekeepers record the location of hits, by decade."""
    place = {"infield": ("left_infield", "middle_infield", "right_infield"), "outfield": ("left_field", "center_field", "right_field")}
    rates = {
        "location_known_hit_rate": ("batted_location_known * hits", "hits"), **{f"hits_location_{d}_rate": (f"batted_distance_{d} * hits", "batted_location_known * hits") for d in place}, **{f"location_known_{n}_rate": (f"{n}s * batted_location_known", f"{n}s") for n in ("single", "double", "triple")},
        "location_known_run_scoring_play_rate": ("CASE WHEN runs_on_play >= 1 THEN batted_location_known * hits ELSE 0 END", "CASE WHEN runs_on_play >= 1 THEN hits ELSE 0 END"), "location_known_runners_on_base_rate": ("CASE WHEN base_state > 0 THEN batted_location_known * hits ELSE 0 END", "CASE WHEN base_state > 0 THEN hits ELSE 0 END"),
        **{f"known_location_share_{n}": (f"batted_location_{n} * hits", f"batted_distance_{d} * hits") for d, names in place.items() for n in names}, "known_location_pulled_rate": ("batted_balls_pulled * batted_location_known * hits", "batted_location_known * hits"),
        "known_location_opposite_field_rate": ("batted_balls_opposite_field * batted_location_known * hits", "batted_location_known * hits"),
    }
    counts = {"plays": "game_share", "hits_location_known": "batted_location_known * hits", "hits_location_unknown": "batted_location_unknown * hits"}
    return _located(m).where("balls_in_play = 1").groupBy("scorer", "decade").agg(*[F.sum(E(c)).alias(n) for n, c in counts.items()], *[ratio(*r).alias(n) for n, r in rates.items()]).where("hits_location_known > 5")


@model
def scorekeeper_tendencies_batter(m) -> DataFrame:
    """How completely each batter's singles are recorded, against all singles of the team and season."""
    rows = m.event_offense_stats.where("singles = 1 AND bunts = 0").join(m.stg_events.select(KEY, "season"), KEY)
    rates = {"location_rate": ("batted_location_known", F.count("*")), "trajectory_rate": ("trajectory_broad_known", F.count("*")), "ground_ball_rate": ("trajectory_ground_ball", "trajectory_broad_known"), "line_drive_rate": ("trajectory_line_drive", "trajectory_broad_air_ball")}
    team = rows.groupBy("season", "team_id").agg(*[ratio(*r).alias(f"all_{n}") for n, r in rates.items()])
    own = rows.where("balls_in_play = 1").groupBy("season", "team_id", "player_id").agg(F.count("*").alias("hits_in_play"), *[ratio(*r).alias(n) for n, r in rates.items()])
    return own.join(team, ["season", "team_id"]).select("season", "team_id", "player_id", "hits_in_play", *rates, *[(F.col(n) - F.col(f"all_{n}")).alias(f"{n}_diff") for n in rates])


@model
def unknown_play_no_box(m) -> DataFrame:
    """Games with unknown putouts and no summary to tell them."""
    t = J.without(m.calc_fielding_play_agg, m.stg_box_score_fielding_lines, ["game_id"]).groupBy("game_id").agg(F.sum("unknown_putouts").alias("unknown_putouts")).where("unknown_putouts > 0")
    return t.join(m.stg_games.select("game_id", "season", "scorer", "park_id"), "game_id")


@model
def unknown_plays(m) -> DataFrame:
    """Games with unknown putouts, and how well each side's putouts are covered over all its games."""
    t = m.event_fielding_stats.groupBy("game_id", "team_id").agg(F.sum("putouts").alias("p"), F.sum("unknown_putouts").alias("u")).join(m.team_game_start_info.select("game_id", "team_id", "team_side"), ["game_id", "team_id"])
    by = W.over(["team_id", "team_side"])
    rated = t.withColumn("rate", F.try_divide((F.sum("p").over(by) - F.sum("u").over(by)).cast("double"), F.sum("p").over(by).cast("double")))
    side = lambda s: F.max(F.when(F.col("team_side") == s, F.col("rate")))
    agg = rated.groupBy("game_id").agg(F.sum("u").alias("total_unknown_putouts"), side("Home").alias("coverage_rate_home"), side("Away").alias("coverage_rate_away")).where("total_unknown_putouts > 0")
    return agg.join(m.stg_games.select("game_id", "season", "scorer", "park_id"), "game_id")
