"""Event-level models: counters of batting, batted balls, pitches, running, pitching and fielding for each play."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import windows as W
from . import stats as S
from .catalogue import flag, flags, model, sums

E = F.expr
KEY = "event_key"


@model(placed=True)
def event_double_plays(m) -> DataFrame:
    """Kinds of double play that a play is flagged with; plays without such a flag have no row."""
    return m.stg_event_flags.join(m.seed_double_play_flag_types, "flag").groupBy(KEY).agg(*[F.bool_or(c).alias(c) for c in ("is_double_play", "is_triple_play", "is_ground_ball_double_play")])


@model(placed=True)
def event_batting_stats(m) -> DataFrame:
    """Counters of each plate appearance; strikeouts and walks go to whoever is responsible for them."""
    sacrifices = m.stg_event_flags.where("flag IN ('SacrificeFly', 'SacrificeHit')").select(KEY).distinct().withColumn("sacrificed", F.lit(True))
    pa = m.stg_events.join(m.seed_plate_appearance_result_types, "plate_appearance_result").join(m.event_double_plays, KEY, "left").join(sacrifices, KEY, "left")
    is_result = {
        "strikeouts": ["StrikeOut"], "walks": ["Walk", "IntentionalWalk"], "intentional_walks": ["IntentionalWalk"], "hit_by_pitches": ["HitByPitch"], "sacrifice_flies": ["SacrificeFly"],
        "sacrifice_hits": ["SacrificeHit"], "reached_on_errors": ["ReachedOnError"], "reached_on_interferences": ["Interference"], "ground_rule_doubles": ["GroundRuleDouble"],
        "inside_the_park_home_runs": ["InsideTheParkHomeRun"],
    }
    result, stranding = F.col("plate_appearance_result"), E("is_batting_out AND is_at_bat AND outs_on_play > 0")
    left = F.when(stranding, E("bit_count(base_state) - outs_on_play - runs_on_play + 1")).otherwise(0).cast("long")
    bases = {1: "singles", 2: "doubles", 3: "triples", 4: "home_runs"}
    return pa.select(
        "game_id", KEY, F.when(result == "StrikeOut", F.coalesce("strikeout_responsible_batter_id", "batter_id")).otherwise(F.col("batter_id")).alias("batter_id"),
        F.when(result.isin(is_result["walks"]), F.coalesce("walk_responsible_pitcher_id", "pitcher_id")).otherwise(F.col("pitcher_id")).alias("pitcher_id"), "batting_team_id", "fielding_team_id",
        F.lit(1).cast("long").alias("plate_appearances"), *flags(at_bats=E("is_at_bat AND sacrificed IS NULL"), hits=E("is_hit")), *[flag(F.col("total_bases") == n).alias(c) for n, c in bases.items()],
        F.col("total_bases").cast("long").alias("total_bases"), flag("is_hit AND batted_to_fielder BETWEEN 1 AND 6").alias("infield_hits"), *[flag(result.isin(v)).alias(c) for c, v in is_result.items()],
        *flags(on_base_opportunities="is_on_base_opportunity", on_base_successes="is_on_base_success"), F.coalesce("runs_batted_in", F.lit(0)).cast("long").alias("runs_batted_in"),
        *flags(grounded_into_double_plays="is_ground_ball_double_play", double_plays="is_double_play", triple_plays="is_triple_play"), (flag("is_batting_out") + flag("is_ground_ball_double_play")).alias("batting_outs"),
        F.col("outs_on_play").cast("long").alias("outs_on_play"), left.alias("left_on_base"), F.when(E("outs + outs_on_play = 3"), left).otherwise(0).cast("long").alias("left_on_base_with_two_outs"),
    )


@model(placed=True)
def calc_batted_ball_type(m) -> DataFrame:
    """Trajectory, depth and side of each batted ball with a recorded trajectory, inferred from fielders where they aren't recorded."""
    balls = m.stg_events.where("batted_trajectory IS NOT NULL")
    fielder = F.when(~F.col("plate_appearance_result").isin("HomeRun", "GroundRuleDouble") | F.col("plate_appearance_result").isNull(), F.col("batted_to_fielder"))
    typed = balls.withColumn("fielder", fielder).withColumn("trajectory", F.when(E("batted_trajectory = 'Unknown' AND fielder BETWEEN 1 AND 6 AND outs_on_play > 0"), "GroundBall").otherwise(F.col("batted_trajectory")))
    air = E("trajectory IN ('Fly', 'LineDrive', 'PopUp') OR plate_appearance_result = 'HomeRun'")
    broad = F.when(E("trajectory = 'GroundBall'"), "GroundBall").when(E("trajectory LIKE '%Bunt%'"), "Bunt").when(air, "AirBall").otherwise("Unknown")
    depth = (
        F.when(E("trajectory = 'GroundBall' AND fielder BETWEEN 7 AND 9"), "Infield").when(E("trajectory = 'Unknown' AND fielder BETWEEN 7 AND 9"), "Unknown")
        .when(E("fielder BETWEEN 7 AND 9"), "Outfield").when(E("fielder = 2"), "Plate").when(E("fielder BETWEEN 1 AND 6"), "Infield").otherwise(F.coalesce("batted_location_depth", F.lit("Unknown")))
    )
    return typed.select("game_id", KEY, "plate_appearance_result", "trajectory", broad.alias("trajectory_broad_classification"), depth.alias("location_depth"), F.coalesce("batted_location_side", F.lit("Unknown")).alias("location_side"), "batted_location_general", F.col("fielder").alias("batted_to_fielder"))


def indicators(column: str, values: dict[str, str], unknown: str, known: str, none: tuple[str, ...] = ("Unknown",)) -> list[Column]:
    """A 0/1 column for each value, one for those that can't be told, and its complement."""
    lost = F.coalesce(F.col(column), F.lit("Unknown")).isin(*none)
    return [*[flag(F.col(column) == v).alias(n) for n, v in values.items()], flag(lost).alias(unknown), (1 - flag(lost)).alias(known)]


@model(placed=True)
def event_batted_ball_stats(m) -> DataFrame:
    """0/1 columns of each batted ball: trajectory, distance, who fielded it, angle and location, and pulled or opposite by the batter's hand."""
    ball = m.calc_batted_ball_type.join(m.event_states_batter_pitcher.select(KEY, "batter_hand"), KEY)
    one = ball.select(
        KEY, "batter_hand", F.lit(1).cast("long").alias("balls_batted"), flag("batted_to_fielder IS NOT NULL").alias("balls_in_play"),
        *indicators("trajectory", {"trajectory_fly_ball": "Fly", "trajectory_ground_ball": "GroundBall", "trajectory_line_drive": "LineDrive", "trajectory_pop_up": "PopUp"}, "trajectory_unknown", "trajectory_known"),
        *indicators("trajectory_broad_classification", {"trajectory_broad_air_ball": "AirBall", "trajectory_broad_ground_ball": "GroundBall", "bunts": "Bunt"}, "trajectory_broad_unknown", "trajectory_broad_known"),
        *indicators("location_depth", {f"batted_distance_{x.lower()}": x for x in ("Plate", "Infield", "Outfield")}, "batted_distance_unknown", "batted_distance_known"),
        *indicators("location_side", {f"batted_angle_{x.lower()}": x for x in ("Left", "Right", "Middle")}, "batted_angle_unknown", "batted_angle_known", ("All", "Unknown")),
        *flags(fielded_by_battery="batted_to_fielder BETWEEN 1 AND 2", fielded_by_infielder="batted_to_fielder BETWEEN 3 AND 6", fielded_by_outfielder="batted_to_fielder BETWEEN 7 AND 9", fielded_by_unknown="batted_to_fielder = 0", batted_location_plate="batted_to_fielder = 2", batted_location_unknown="location_depth = 'Unknown'"),
    )
    spots = {"infield": {"right": "right_infield", "left": "left_infield", "middle": "middle_infield"}, "outfield": {"left": "left_field", "middle": "center_field", "right": "right_field"}}
    where = [(F.col(f"batted_distance_{d}") * F.col(f"batted_angle_{a}")).alias(f"batted_location_{n}") for d, names in spots.items() for a, n in names.items()]
    by_hand = lambda right, left: F.when(E("batter_hand = 'R'"), F.col(f"batted_angle_{right}")).when(E("batter_hand = 'L'"), F.col(f"batted_angle_{left}")).otherwise(0).cast("long")
    return one.select("*", *where, E("1 - fielded_by_unknown").alias("fielded_by_known"), E("1 - batted_location_unknown").alias("batted_location_known"), by_hand("left", "right").alias("batted_balls_pulled"), by_hand("right", "left").alias("batted_balls_opposite_field")).drop("batter_hand")


def misplays(runners: DataFrame) -> DataFrame:
    """Whether a play had a passed ball, a wild pitch or a balk."""
    kinds = dict(zip(S.MISPLAYS, ("PassedBall", "WildPitch", "Balk")))
    return runners.groupBy(KEY).agg(*[F.max(flag(F.col("baserunning_play_type") == k)).alias(n) for n, k in kinds.items()])


PITCH_RULES = {
    "pitches": "is_pitch", "swings": "is_swing", "swings_with_contact": "is_contact", "strikes": "is_strike", "strikes_called": "is_strike AND NOT is_swing", "strikes_swinging": "is_swing AND NOT is_contact",
    "strikes_foul": "is_swing AND is_contact AND NOT is_in_play AND NOT can_be_strike_three", "strikes_foul_tip": "sequence_item LIKE 'FoulTip%'", "strikes_in_play": "is_in_play",
    "strikes_unknown": "sequence_item = 'StrikeUnknownType'", "balls": "category = 'Ball'", "balls_called": "sequence_item = 'Ball'", "balls_intentional": "sequence_item = 'IntentionalBall'",
    "balls_automatic": "sequence_item = 'AutomaticBall'", "unknown_pitches": "category = 'Unknown'", "pitchouts": "sequence_item LIKE '%Pitchout'", "pitcher_pickoff_attempts": "sequence_item LIKE 'Pickoff%'",
    "catcher_pickoff_attempts": "catcher_pickoff_attempt_at_base IS NOT NULL", "pitches_blocked_by_catcher": "blocked_by_catcher_flag", "pitches_with_runners_going": "is_pitch AND runners_going_flag",
}


@model(placed=True)
def event_pitch_sequence_stats(m) -> DataFrame:
    """Counts of each play's pitches by kind, and its misplays."""
    items = m.stg_event_pitch_sequences.join(m.seed_pitch_types, "sequence_item")
    counted = items.groupBy(KEY).agg(*[F.count_if(E(c)).alias(n) for n, c in PITCH_RULES.items()])
    return counted.join(misplays(m.stg_event_baserunners), KEY, "left").fillna(0, S.MISPLAYS)


@model(placed=True)
def event_baserunning_stats(m) -> DataFrame:
    """Counters of the batter and of each runner on base at a play."""
    e = m.stg_events.where("NOT no_play_flag").select(KEY, "batting_team_id", "fielding_team_id", "base_state", F.col("pitcher_id").alias("current_pitcher_id"), "plate_appearance_result")
    b = m.stg_event_baserunners.join(e, KEY).join(m.seed_plate_appearance_result_types, "plate_appearance_result", "left")
    base = F.coalesce("number_base_from", F.lit(0))
    gained, ok = E("number_base_to - number_base_from"), E("number_base_to IS NOT NULL AND NOT is_out")
    state = F.col("base_state")
    empty = E("CASE baserunner WHEN 'Batter' THEN base_state & 1 = 0 WHEN 'First' THEN base_state & 2 = 0 WHEN 'Second' THEN base_state & 4 = 0 ELSE false END")
    lead = E("CASE baserunner WHEN 'Batter' THEN false WHEN 'First' THEN base_state = 1 WHEN 'Second' THEN base_state < 4 ELSE true END")
    forced = E("CASE baserunner WHEN 'Second' THEN base_state & 1 = 1 WHEN 'Third' THEN base_state = 7 ELSE true END")
    chance = E("CASE plate_appearance_result WHEN 'Single' THEN baserunner IN ('First', 'Second') WHEN 'Double' THEN baserunner = 'First' ELSE false END")
    kind = F.coalesce("baserunning_play_type", F.lit("None"))
    b = b.withColumns({"ok": ok, "gained": gained, "empty": empty, "lead": lead, "forced": forced, "chance": chance, "kind": kind, "hit": E("coalesce(is_hit, false)"), "in_play": E("coalesce(is_in_play, false)"), "tb": E("coalesce(total_bases, 0)"), "on": E("baserunner <> 'Batter'"), "state": state, "from_base": base})
    b = b.withColumns({"attempt": E("hit AND coalesce(gained > tb, false)"), "far_out": E("is_out AND explicit_out_flag AND coalesce(gained > 1, false)"), "stole": E("kind = 'StolenBase'"), "caught": E("kind LIKE '%CaughtStealing'"), "picked": E("kind LIKE 'PickedOff%' AND is_out")})
    b = b.withColumn("steal_chance", E("stole OR caught OR empty AND on"))
    steps = {"second": "First", "third": "Second", "home": "Third"}
    spread = lambda name, what: [flag(what).alias(name), *[flag(f"{what} AND baserunner = '{r}'").alias(f"{name}_{to}") for to, r in steps.items()]]
    advanced = {"wild_pitches": "WildPitch", "passed_balls": "PassedBall", "balks": "Balk", "unspecified_plays": "OtherAdvance", "defensive_indifference": "DefensiveIndifference"}
    number = lambda c, when: F.when(E(when), E(c)).otherwise(0).cast("long")
    clean = "ok AND in_play AND NOT advanced_on_error_flag"
    return b.select(
        KEY, "game_id", "baserunner", "runner_id", "batting_team_id", "fielding_team_id", "current_pitcher_id",
        *flags(runs="ok AND number_base_to = 4", outs_on_basepaths="is_out", times_reached_base="ok AND NOT on", times_lead_runner="lead", times_force_on_runner="forced", times_next_base_empty="empty"),
        *spread("stolen_base_opportunities", "steal_chance"), *spread("stolen_bases", "stole"), *spread("caught_stealing", "caught"),
        flag("picked").alias("picked_off"), *[flag(f"picked AND baserunner = '{r}'").alias(f"picked_off_{r.lower()}") for r in ("First", "Second", "Third")], flag("kind = 'PickedOffCaughtStealing'").alias("picked_off_caught_stealing"),
        *[flag(f"kind = '{k}' AND ok").alias(f"advances_on_{n}") for n, k in advanced.items()], flag("(kind = 'AdvancedOnError' OR advanced_on_error_flag) AND ok").alias("advances_on_errors"),
        *flags(plate_appearances_while_on_base="plate_appearance_result IS NOT NULL AND on", balls_in_play_while_running="in_play", balls_in_play_while_on_base="in_play AND on"),
        F.col("tb").cast("long").alias("batter_total_bases_while_running"), number("tb", "on").alias("batter_total_bases_while_on_base"), flag("chance").alias("extra_base_chances"), flag("attempt").alias("extra_base_advance_attempts"),
        flag("chance AND attempt AND ok").alias("extra_bases_taken"), number("gained", "ok").alias("bases_advanced"), number("gained", clean).alias("bases_advanced_on_balls_in_play"),
        number("gained - least(4 - number_base_from, tb)", clean).alias("surplus_bases_advanced_on_balls_in_play"), flag("far_out").alias("outs_on_extra_base_advance_attempts"),
        *flags(outs_avoided_on_errors="explicit_out_flag AND NOT is_out", unforced_outs_on_basepaths="is_out AND (far_out OR NOT forced OR hit)"),
    )


@model(placed=True)
def event_offense_stats(m) -> DataFrame:
    """All counters of each play by player: the batter's with the pitches and the ball batted, and a row for each runner."""
    running = m.event_baserunning_stats.drop("current_pitcher_id", "fielding_team_id")
    hit = m.event_batting_stats.select("game_id", KEY, F.col("batter_id").alias("player_id"), F.col("batting_team_id").alias("team_id"), *[c for c in (*S.BATTING, *S.LEFT)])
    own = hit.join(m.event_batted_ball_stats, KEY, "left").join(m.event_pitch_sequence_stats.drop(*S.MISPLAYS), KEY, "left").join(misplays(m.stg_event_baserunners), KEY, "left")
    batter = running.where("baserunner = 'Batter'").withColumnsRenamed({"game_id": "_game", "batting_team_id": "_team", "runner_id": "_runner"}).drop("baserunner")
    both = own.join(batter, KEY, "full").withColumns({"game_id": F.coalesce("game_id", "_game"), "team_id": F.coalesce("team_id", "_team"), "player_id": F.coalesce("player_id", "_runner"), "baserunner": F.lit("Batter")}).drop("_game", "_team", "_runner")
    others = running.where("baserunner <> 'Batter'").withColumnsRenamed({"batting_team_id": "team_id", "runner_id": "player_id"})
    every = both.unionByName(others, allowMissingColumns=True)
    return every.select("game_id", KEY, "team_id", "player_id", "baserunner", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in S.OFFENSE])


@model
def event_run_assignment_stats(m) -> DataFrame:
    """Runs of a play by pitcher: charged to whoever put the runner on, inherited by the current one."""
    scored = m.event_baserunning_stats.where("runs = 1").join(m.stg_event_baserunners.select(KEY, "baserunner", "explicit_charged_pitcher_id"), [KEY, "baserunner"])
    charged = F.coalesce("explicit_charged_pitcher_id", "current_pitcher_id")
    rows = scored.withColumn("charged", charged).withColumn("same", E("charged = current_pitcher_id"))
    part = lambda who, runs, left, got: F.struct(F.col(who).alias("pitcher_id"), F.lit(runs).alias("runs"), F.lit(left).alias("bequeathed_runners_scored"), F.lit(got).alias("inherited_runners_scored"))
    credits = F.when(F.col("same"), F.array(part("charged", 1, 0, 0))).otherwise(F.array(part("charged", 1, 1, 0), part("current_pitcher_id", 0, 0, 1)))
    flat = rows.select("game_id", KEY, F.col("fielding_team_id").alias("team_id"), F.explode(credits).alias("x")).select("game_id", KEY, "team_id", "x.*")
    return flat.groupBy("game_id", KEY, "team_id", "pitcher_id").agg(*sums(["runs", "bequeathed_runners_scored", "inherited_runners_scored"]))


@model(placed=True)
def event_pitching_stats(m) -> DataFrame:
    """All counters of each play by pitcher; runs charged to a pitcher who has left come as rows of their own."""
    own = [c for c in S.RUNNING if c in S.PITCHING and c != "runs"]
    run = m.event_baserunning_stats.groupBy(KEY).agg(F.any_value("game_id").alias("_game"), F.any_value("current_pitcher_id").alias("_pitcher"), F.any_value("fielding_team_id").alias("_team"), *sums(own))
    bat = [c for c in (*S.BATTING, *S.LEFT) if c in S.PITCHING]
    hit = m.event_batting_stats.select("game_id", KEY, "pitcher_id", "fielding_team_id", "outs_on_play", *bat)
    both = hit.join(run, KEY, "full").select(
        KEY, F.coalesce("_game", "game_id").alias("game_id"), F.coalesce("_pitcher", "pitcher_id").alias("player_id"), F.coalesce("_team", "fielding_team_id").alias("team_id"), *bat, *own,
        F.col("plate_appearances").alias("batters_faced"), F.coalesce("outs_on_play", "outs_on_basepaths").alias("outs_recorded"),
    )
    whole = both.join(m.event_batted_ball_stats, KEY, "left").join(m.event_pitch_sequence_stats.drop(*S.MISPLAYS), KEY, "left").join(misplays(m.stg_event_baserunners), KEY, "left")
    # The few pitchers of a play's runs come to it together, so that the wide rows stay where they are.
    runs = m.event_run_assignment_stats
    charged = runs.groupBy(KEY).agg(F.collect_list(F.struct("pitcher_id", "runs", "inherited_runners_scored")).alias("_runs"))
    own = F.get(F.filter("_runs", lambda x: x["pitcher_id"] == F.col("player_id")), F.lit(0))
    current = whole.join(charged, KEY, "left").withColumn("_own", own).select("*", "_own.runs", "_own.inherited_runners_scored").drop("_runs", "_own")
    departed = runs.where("bequeathed_runners_scored > 0").select("game_id", KEY, "team_id", F.col("pitcher_id").alias("player_id"), "runs", "bequeathed_runners_scored")
    every = current.unionByName(departed, allowMissingColumns=True).withColumn("team_unearned_runs", F.lit(0))
    return every.select("game_id", KEY, "team_id", "player_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in S.PITCHING])


@model(placed=True)
def calc_fielding_play_agg(m) -> DataFrame:
    """Per play and position: putouts, assists (chains assisted in), errors, choices, assisted putouts, batted balls first played, errors of the first chain, and what is unknown."""
    closing = F.col("fielding_play").isin("Putout", "Error")
    chained = W.chain_groups(m.stg_event_fielding_plays, [KEY], ["sequence_id"], closing).withColumn("helped", F.max(flag("fielding_play = 'Assist'")).over(W.over([KEY, "chain"])))
    chained = chained.join(m.stg_events.select(KEY, E("batted_location_general IS NOT NULL").alias("batted")), KEY)
    return chained.groupBy("game_id", KEY, "fielding_position").agg(
        F.count_if(E("fielding_play = 'Putout'")).alias("putouts"), F.count_distinct(E("CASE WHEN fielding_play = 'Assist' THEN chain END")).alias("assists"), F.count_if(E("fielding_play = 'Error'")).alias("errors"),
        F.count_if(E("fielding_play = 'FieldersChoice'")).alias("fielders_choices"), F.count_if(E("fielding_play = 'Putout' AND helped = 1")).alias("assisted_putouts"),
        F.count_if(E("sequence_id = 1 AND fielding_play <> 'Error' AND batted")).alias("plays_started"), F.count_if(E("chain = 0 AND fielding_play = 'Error'")).alias("first_errors"),
        F.count_if(E("fielding_play = 'Putout' AND fielding_position = 0")).alias("unknown_putouts"), F.max(flag("fielding_position = 0")).alias("incomplete_events"),
    )


@model(placed=True)
def event_fielding_stats(m) -> DataFrame:
    """Fielding counters of each play for the side in the field."""
    chains = ["putouts", "assists", "errors", "fielders_choices", "assisted_putouts", "unknown_putouts", "incomplete_events"]
    plays = m.calc_fielding_play_agg.groupBy(KEY).agg(*sums(chains))
    rules = {"stolen_bases": "= 'StolenBase'", "caught_stealing": "= 'CaughtStealing'", "pickoffs": "LIKE 'PickedOff%'"}
    running = m.stg_event_baserunners.where("baserunning_play_type IS NOT NULL").groupBy(KEY).agg(*[F.count_if(E(f"baserunning_play_type {c}")).alias(n) for n, c in rules.items()], F.max(flag("baserunning_play_type = 'PassedBall'")).alias("passed_balls"))
    e = m.stg_events.where("NOT no_play_flag").join(running, KEY, "left").join(m.seed_plate_appearance_result_types, "plate_appearance_result", "left").join(m.event_double_plays, KEY, "left").join(plays, KEY, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return e.select(
        KEY, "season", "game_id", F.col("fielding_team_id").alias("team_id"), F.col("outs_on_play").cast("long").alias("outs_played"), flag("plate_appearance_result IS NOT NULL").alias("plate_appearances_in_field"), "batted_to_fielder",
        *[zero(c).alias(c) for c in (*chains, *rules, "passed_balls")], *flags(double_plays="is_double_play", triple_plays="is_triple_play", ground_ball_double_plays="is_ground_ball_double_play", reaching_errors="plate_appearance_result = 'ReachedOnError'", plate_appearances_in_field_with_ball_in_play="is_in_play"),
        *[F.when(F.col("is_in_play"), zero(c)).otherwise(0).cast("long").alias(f"in_play_{c}") for c in ("putouts", "assists")],
    )
