"""State models: score, bases and outs, batter and pitcher, and who is on the field at each play."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import windows as W
from .catalogue import flag, model

E = F.expr
KEY = "event_key"


#: Bases with their bits in a state.
BASES = {"first": 1, "second": 2, "third": 4}


@model
def event_score_states(m) -> DataFrame:
    """Both sides' scores before and after each play."""
    out = {}
    for side in ("home", "away"):
        start, end = W.running_by_side(F.col("runs_on_play"), F.col("batting_side") == side.title(), ["game_id"], [KEY])
        out |= {f"score_{side}_start": start, f"score_{side}_end": end}
    return m.stg_events.select(KEY, *[c.cast("long").alias(n) for n, c in out.items()], F.col("runs_on_play").cast("long").alias("runs_on_play"))


@model
def event_base_out_states(m) -> DataFrame:
    """Bases, outs and innings before and after each play, with flags for the ends of frames."""
    frame = ["game_id", "inning", "batting_side"]
    w = W.over(frame, [KEY])
    game = W.over(["game_id"], [KEY])
    at = lambda bit: F.min(F.when(F.col("baserunner_bit") == bit, F.col("runner_id")))
    runners = m.stg_event_baserunners.groupBy(KEY).agg(*[at(bit).alias(f"_{base}") for base, bit in BASES.items()])
    e = m.stg_events.join(m.event_score_states.drop("runs_on_play"), KEY).join(runners, KEY, "left")
    return e.select(
        *[c for base in BASES for c in (F.col(f"_{base}").alias(f"runner_{base}_id_start"), F.lead(f"_{base}").over(w).alias(f"runner_{base}_id_end"))],
        F.bit_count(F.lead("base_state").over(w)).cast("long").alias("runners_count_end"), F.lag(KEY).over(game).isNull().alias("game_start_flag"),
        KEY, "game_id", F.col("inning").alias("inning_start"), F.col("inning").alias("inning_end"), F.when(F.col("batting_side") == "Away", "Top").otherwise("Bottom").alias("frame_start"), F.when(F.col("batting_side") == "Away", "Top").otherwise("Bottom").alias("frame_end"),
        F.col("outs").alias("outs_start"), (F.col("inning") * 3 - 3 + F.col("outs")).alias("inning_in_outs_start"), "outs_on_play", (F.col("outs") + F.col("outs_on_play")).alias("outs_end"), F.col("base_state").alias("base_state_start"),
        F.lead("base_state").over(w).alias("base_state_end"), F.bit_count("base_state").cast("long").alias("runners_count_start"), E("base_state & 1 = 1 AND outs < 2").alias("is_gidp_eligible"),
        F.lag(KEY).over(w).isNull().alias("frame_start_flag"), F.lead(KEY).over(w).isNull().alias("frame_end_flag"), (F.lead(KEY).over(w).isNull() & (F.col("outs") + F.col("outs_on_play") != 3)).alias("truncated_frame_flag"), F.lead(KEY).over(game).isNull().alias("game_end_flag"),
        "runs_on_play", "score_home_start", "score_away_start", "score_home_end", "score_away_end",
    )


def _hand(told: str, own: str, other: Column) -> Column:
    """The hand told; else that of a both-handed one against the other's, and that of the rest."""
    against = F.when(F.col(own) == "B", F.when(other == "L", "R").when(other == "R", "L")).otherwise(F.col(own))
    return F.coalesce(told, against)


@model
def event_states_batter_pitcher(m) -> DataFrame:
    """Batter and pitcher of each play with the hand each uses, and the batter's own fielding position then."""
    e = m.stg_events
    # The fielders of a game come to its plays together.
    fielders = m.stg_game_fielding_appearances.groupBy("game_id").agg(F.collect_list(F.struct("player_id", "start_event_id", "end_event_id", "fielding_position")).alias("_fielders"))
    mine = F.filter("_fielders", lambda x: (x["player_id"] == F.col("batter_id")) & F.col("event_id").between(x["start_event_id"], x["end_event_id"]))
    spot = e.select("game_id", KEY, "batter_id", "event_id").join(fielders, "game_id").select(KEY, F.array_max(F.transform(mine, lambda x: x["fielding_position"])).alias("batter_fielding_position"))
    people = m.people
    hands = e.join(people.select(F.col("player_id").alias("batter_id"), "bats"), "batter_id", "left").join(people.select(F.col("player_id").alias("pitcher_id"), "throws"), "pitcher_id", "left")
    batter = _hand("specified_batter_hand", "bats", F.col("throws"))
    with_batter = hands.withColumn("batter_hand", batter)
    return with_batter.withColumn("pitcher_hand", _hand("specified_pitcher_hand", "throws", F.col("batter_hand"))).join(spot, KEY, "left").select(
        "game_id", KEY, "batting_side", F.when(F.col("batting_side") == "Home", "Away").otherwise("Home").alias("fielding_side"), "batting_team_id", "fielding_team_id", "batter_id", "pitcher_id",
        "batter_lineup_position", "batter_fielding_position", "batter_hand", "pitcher_hand",
    )


@model(placed=True)
def event_states_full(m) -> DataFrame:
    """Each play with its game, players, bases, score and the keys under which state values are looked up."""
    e = m.stg_events.select(KEY, "event_id", "game_id", "count_balls", "count_strikes")
    g = m.game_start_info.select("game_id", "season", F.col("home_league").alias("league"), "is_interleague", "game_type", "date", "park_id", "home_team_id", "away_team_id", "home_starting_pitcher_id", "away_starting_pitcher_id")
    base = m.event_base_out_states.drop("game_id")
    g = g.join(m.stg_games.select("game_id", "time_of_day"), "game_id", "left")
    joined = e.join(g, "game_id").join(m.event_states_batter_pitcher.drop("game_id"), KEY).join(base, KEY)
    margin = {f"home_margin_{x}": F.col(f"score_home_{x}") - F.col(f"score_away_{x}") for x in ("start", "end")}
    with_margin = joined.withColumns(margin)
    sided = {f"batting_team_margin_{x}": F.when(F.col("batting_side") == "Home", F.col(f"home_margin_{x}")).otherwise(-F.col(f"home_margin_{x}")) for x in ("start", "end")}
    held = {f"truncated_home_margin_{x}": F.greatest(F.least(F.col(f"home_margin_{x}"), F.lit(10)), F.lit(-10)) for x in ("start", "end")}
    starter = F.when(F.col("batting_side") == "Home", F.col("away_starting_pitcher_id")).otherwise(F.col("home_starting_pitcher_id"))
    groups = {
        "pitching_team_starting_pitcher_id": starter, "league_group": F.when(F.col("league").isin("AL", "NL", "FL"), F.col("league")).otherwise("Other"), "season_group": F.greatest("season", F.lit(1914)),
        **{f"inning_group_{x}": F.when(F.col("inning_start") < 10, F.col(f"inning_{x}").cast("string")).when(E("season >= 2020 AND game_type = 'RegularSeason'"), "11").otherwise("10") for x in ("start", "end")},
    }
    full = with_margin.withColumns(sided | held | groups)
    text = lambda *parts: F.concat_ws("_", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts])
    end_state = F.coalesce("base_state_end", F.lit(0))
    return full.withColumns({
        "run_expectancy_start_key": text("season_group", "league_group", "outs_start", "base_state_start"), "run_expectancy_end_key": text("season_group", "league_group", "outs_end", end_state),
        "win_expectancy_start_key": text("inning_group_start", "frame_start", "truncated_home_margin_start", "outs_start", "base_state_start"),
        "win_expectancy_end_key": text("inning_group_end", "frame_end", "truncated_home_margin_end", F.col("outs_end") % 3, end_state),
    })


def _sets(m, appearances: DataFrame, end: str, place: str, key: str, side: str) -> DataFrame:
    """A row for each range of a side's unchanged personnel, with the players in force at each place.

    The ranges of a side begin where its appearances do, so that each appearance
    is held against the starts of its own game alone. Where two games come to the
    same key, each place has one player between them, as in the states.
    """
    c, on = F.col, ["game_id", "side"]
    last = F.max("end_event_id") if end == "side" else F.max(F.struct("start_event_id", "end_event_id"))["end_event_id"]
    who = F.struct(place, (-c("end_event_id")).alias("_end"), "player_id", c("start_event_id").alias("_start"))
    sides = appearances.where("game_id IS NOT NULL AND side IS NOT NULL").groupBy(*on).agg(F.array_sort(F.collect_set("start_event_id")).alias("_starts"), last.alias("_last"), F.array_sort(F.collect_list(who)).alias("_all"))
    ranges = sides.select(*on, "_starts", "_last", "_all", F.posexplode("_starts").alias("_k", "start_event_id"))
    ranges = ranges.withColumn("end_event_id", F.coalesce(F.try_element_at("_starts", c("_k") + 2) - 1, c("_last")))
    met = lambda x: (c("start_event_id") <= -x["_end"]) & (c("end_event_id") >= x["_start"])
    there = ranges.where(F.exists("_all", met)).withColumn("_all", F.filter("_all", met))
    # In order of the places, the one who stays longest first: of each place the first counts.
    first = F.filter("_all", lambda x, k: (k == 0) | ~x[place].eqNullSafe(F.get("_all", k - 1)[place]))
    games = m.stg_games.select("game_id", "game_key", "home_team_id", "away_team_id")
    home = c("side") == "Home"
    keyed = there.withColumn("_all", first).join(games, "game_id").select(
        "game_id", F.when(home, c("home_team_id")).otherwise(c("away_team_id")).alias(f"{side}_team_id"), c("side").alias(f"{side}_side"), ((c("game_key") + c("start_event_id")) * F.when(home, 1).otherwise(-1)).alias(key), "start_event_id", "end_event_id", "_all",
    )
    own = keyed.columns[:-1]
    counted = keyed.repartition(key).withColumn("_n", F.count("*").over(W.over([key])))
    shared = counted.where("_n > 1").select(*own, F.explode("_all").alias("_x")).select(*own, "_x.*")
    one = W.dedupe(shared, [key, place], ["_end", "player_id", "_start"]).groupBy(*own).agg(F.array_sort(F.collect_list(F.struct(place, "player_id"))).alias("players"))
    slim = F.transform("_all", lambda x: F.struct(x[place].alias(place), x["player_id"].alias("player_id")))
    return counted.where("_n = 1").select(*own, slim.alias("players")).unionByName(one)


@model(key="personnel_fielding_key", placed=True)
def personnel_fielding_sets(m) -> DataFrame:
    """The fielders of each range of plays without a change, as a list."""
    return _sets(m, m.stg_game_fielding_appearances, "own", "fielding_position", "personnel_fielding_key", "fielding")


@model(key="personnel_lineup_key", placed=True)
def personnel_lineup_sets(m) -> DataFrame:
    """The batters of each range of plays without a change, as a list."""
    return _sets(m, m.stg_game_lineup_appearances, "side", "lineup_position", "personnel_lineup_key", "batting")


def _listed(sets: DataFrame, place: str) -> DataFrame:
    return sets.select(*[c for c in sets.columns if c != "players"], F.explode("players").alias("_x")).select("*", "_x.player_id", f"_x.{place}").drop("players", "_x")


@model
def personnel_fielding_states(m) -> DataFrame:
    """Who fields where over each range of plays without a change."""
    return _listed(m.personnel_fielding_sets, "fielding_position")


@model
def personnel_lineup_states(m) -> DataFrame:
    """Who bats where over each range of plays without a change."""
    return _listed(m.personnel_lineup_sets, "lineup_position")


def _looked_up(m, sides: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Plays with the key of the range in force, for each side of the play; the ranges of a game come to its plays together."""
    c = F.col
    found = m.stg_events.where("NOT no_play_flag").select("game_id", "event_id", KEY, "batting_side", F.when(c("batting_side") == "Home", "Away").otherwise("Home").alias("fielding_side"))
    for side, (key, sets) in sides.items():
        ranges = sets.groupBy("game_id").agg(F.collect_list(F.struct(c(side).alias("_side"), "start_event_id", "end_event_id", key)).alias("_ranges"))
        met = F.filter("_ranges", lambda x: (x["_side"] == c(side)) & c("event_id").between(x["start_event_id"], x["end_event_id"]))  # noqa: B023
        found = found.join(ranges, "game_id", "left").withColumn(key, F.get(met, F.lit(0))[key]).drop("_ranges")
    return found.select("game_id", "event_id", KEY, *[key for key, _ in sides.values()])


@model
def event_personnel_lookup(m) -> DataFrame:
    """The lineup and the fielding state in force at each play."""
    return _looked_up(m, {"batting_side": ("personnel_lineup_key", m.personnel_lineup_sets), "fielding_side": ("personnel_fielding_key", m.personnel_fielding_sets)})


@model
def event_fielding_lookup(m) -> DataFrame:
    """The fielding state in force at each play, for those who need no lineup."""
    return _looked_up(m, {"fielding_side": ("personnel_fielding_key", m.personnel_fielding_sets)})


POSITIONS = ["pitcher", "catcher", "first_base", "second_base", "third_base", "shortstop", "left_field", "center_field", "right_field"]


@model
def event_fielders_flat(m) -> DataFrame:
    """Each play with its nine fielders in columns."""
    flat = _listed(m.personnel_fielding_sets, "fielding_position").groupBy("personnel_fielding_key").agg(*A.first_where(F.col("fielding_position"), list(range(1, 10)), F.col("player_id"), "p"))
    names = flat.withColumnsRenamed({f"p_{k}": f"{n}_id" for k, n in enumerate(POSITIONS, 1)})
    return m.event_fielding_lookup.join(names, "personnel_fielding_key")


@model(key="game_id", placed=True)
def event_player_fielding_stats(m) -> DataFrame:
    """A row for each play and fielder on the field, with what is credited to that position.

    Plays move with the lists of fielders and credits, which become rows where
    they lie by game: so do their sums by game then.
    """
    c, credited = F.col, ("putouts", "assists", "errors", "fielders_choices", "assisted_putouts")
    on = m.personnel_fielding_sets.select("personnel_fielding_key", c("fielding_team_id").alias("team_id"), "players")
    plays = m.event_fielding_stats.drop("team_id", *credited, "incomplete_events", "season", "in_play_putouts", "in_play_assists")
    credit = m.calc_fielding_play_agg.groupBy(KEY).agg(F.collect_list(F.struct("fielding_position", *credited)).alias("_credits"))
    met = plays.join(m.event_fielding_lookup.select(KEY, "personnel_fielding_key"), KEY).join(credit, KEY, "left").join(on, "personnel_fielding_key").drop("personnel_fielding_key").repartition("game_id")
    each = met.withColumn("_x", F.explode("players")).withColumns({"player_id": c("_x.player_id"), "fielding_position": c("_x.fielding_position")}).drop("players", "_x")
    own = F.get(F.filter("_credits", lambda x: x["fielding_position"] == c("fielding_position")), F.lit(0))  # a play has one a position
    rows = each.withColumn("_own", own).select("*", *[c(f"_own.{n}").alias(n) for n in credited]).drop("_own", "_credits")
    mine, battery = E("coalesce(putouts, 0) + coalesce(assists, 0) > 0"), E("fielding_position IN (1, 2)")
    only = lambda c, when: F.when(when, F.col(c)).otherwise(0).cast("long").alias(c)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("putouts", "assists", "errors", "fielders_choices", "assisted_putouts")]
    in_play = [F.when(E("plate_appearances_in_field_with_ball_in_play = 1"), F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(f"in_play_{c}") for c in ("putouts", "assists")]
    return rows.select(
        "game_id", KEY, "team_id", "player_id", "fielding_position", "outs_played", "plate_appearances_in_field", "plate_appearances_in_field_with_ball_in_play", *zero, *in_play,
        *[only(c, mine) for c in ("double_plays", "triple_plays", "ground_ball_double_plays")], *[only(c, battery) for c in ("stolen_bases", "caught_stealing", "pickoffs")], only("passed_balls", E("fielding_position = 2")),
        only("reaching_errors", E("coalesce(errors, 0) > 0")), flag("batted_to_fielder = fielding_position").alias("balls_hit_to"), F.col("unknown_putouts").alias("unknown_putouts_while_fielding"),
    )
