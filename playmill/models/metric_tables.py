"""Metric tables: counters and measures of regular seasons by career, by season and league, and by team."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as M
from . import stats as S
from .catalogue import MODELS

E = F.expr
KEY = "event_key"

#: What a row of each grain stands for.
GRAINS = {"player_career": ["player_id"], "player_season_league": ["player_id", "season", "league"], "team_season": ["team_id", "season"]}
#: The season account, the event account and the counters of each kind.
KINDS = {
    "offense": ("player_team_season_offense_stats", "event_offense_stats", S.OFFENSE),
    "pitching": ("player_team_season_pitching_stats", "event_pitching_stats", [*S.PITCHING, *S.APPEARANCE, *S.AWARDS]),
    "fielding": ("player_position_team_season_fielding_stats", "event_player_fielding_stats", [c for c in S.FIELDING if c in ("outs_played", "putouts", "assists", "errors", "fielders_choices", "double_plays", "triple_plays", "passed_balls")]),
}
#: A ball batted counts for all plays, for outs or for hits.
VIEWS = {"": "1", "_outs": "(at_bats - hits)", "_hits": "hits"}
SIDES = {**{f"angle_{a}": f"batted_angle_{a}" for a in ("left", "right", "middle")}, **{d: f"batted_balls_{d}" for d in ("pulled", "opposite_field")}}
#: Averages evened out for how often outs and hits are recorded: the counter and the account of recording.
WEIGHTED = {
    "air_ball": ("trajectory_broad_air_ball", "trajectory_broad"), "ground_ball": ("trajectory_ground_ball", "trajectory_broad"),
    **{n: (f"trajectory_{n}", "trajectory") for n in ("fly_ball", "line_drive", "pop_up")}, **{n: (c, "angle") for n, c in SIDES.items()},
}


def batted_ball(kind: str) -> list[M.Metric]:
    """Shares of trajectories, angles and directions, how often each is recorded, and averages with recording evened out."""
    share = lambda name, over, under, view="": M.ratio(name, kind, f"{over} * {VIEWS[view]}", f"{under} * {VIEWS[view]}", source="event")
    over = lambda name, a, b: M.Metric(name, kind, "event", derived=F.try_divide, uses=(a, b))
    known = []
    for fact in ("trajectory", "trajectory_broad"):
        known += [share(f"known_{fact}_rate{v}", f"{fact}_known * balls_batted", "balls_batted", v) for v in VIEWS]
    known += [share(f"known_angle_rate{v}", "batted_angle_known", "1" if v == "_hits" else "balls_batted", v) for v in VIEWS]
    known += [over(f"known_{fact}_out_hit_ratio", f"known_{fact}_rate_outs", f"known_{fact}_rate_hits") for fact in ("trajectory", "trajectory_broad", "angle")]
    ways = []
    for name, view in (("rate_outs", "_outs"), ("hit_rate", "_hits")):
        ways += [share(f"{b}_ball_{name}", f"trajectory_broad_{b}_ball", "trajectory_broad_known", view) for b in ("air", "ground")]
    ways += [over("ground_air_out_ratio", "ground_ball_rate_outs", "air_ball_rate_outs"), over("ground_air_hit_ratio", "ground_ball_hit_rate", "air_ball_hit_rate")]
    ways += [share(f"{n}_rate", f"trajectory_{n}", "trajectory_broad_known" if n == "ground_ball" else "trajectory_known") for n in ("fly_ball", "line_drive", "pop_up", "ground_ball")]
    ways += [share(f"{n}_rate{v}", c, "batted_angle_known", v) for n, c in SIDES.items() for v in VIEWS]
    even = []
    for name, (c, fact) in WEIGHTED.items():
        parts = [f"sum_{c}{v}" for v in ("_hits", "_outs")]
        even += [M.Metric(p, kind, "event", formula=lambda c=c, v=p[-5:]: F.sum(E(f"{c} * {VIEWS[v]}"))) for p in parts]
        even.append(M.coverage_weighted(f"coverage_weighted_{name}_batting_average", kind, *parts, f"known_{fact}_out_hit_ratio"))
    return [*known, *ways, *even]


def running(kind: str) -> list[M.Metric]:
    tries = [M.ratio(f"stolen_base_attempt_rate_{b}", kind, (f"stolen_bases_{b}", f"caught_stealing_{b}"), f"stolen_base_opportunities_{b}", source="event") for b in S.BASES]
    return [*tries, M.ratio("unforced_out_rate", kind, "unforced_outs_on_basepaths", "times_reached_base", source="event")]


def pitches(kind: str) -> list[M.Metric]:
    per_pitch = {
        "pitch_strike_rate": "strikes", "pitch_contact_rate": "swings_with_contact", "pitch_swing_rate": ("swings_with_contact", "strikes_swinging"), "pitch_ball_rate": "balls",
        "pitch_swing_and_miss_rate": "strikes_swinging", "pitch_foul_rate": "strikes_foul", "pitched_called_strike_rate": "strikes_called",
    }
    return [*[M.ratio(n, kind, c, "pitches", source="event") for n, c in per_pitch.items()], M.ratio("pitch_data_coverage_rate", kind, "if(pitches > 0, 1, 0)", "plate_appearances", source="event")]


def measures() -> M.Registry:
    """Every measure of the nine tables; fielding has none that only plays tell."""
    registry = M.Registry().add(*M.basic_offense("offense"), *M.basic_pitching("pitching"), *M.basic_fielding("fielding"))
    for kind in ("offense", "pitching"):
        registry.add(*batted_ball(kind), *running(kind), *pitches(kind))
    return registry


def metric_table(m, kind: str, keys: list[str]) -> DataFrame:
    """Counters and measures of the season account by keys, and beside them those that plays tell; rows without plays stay, with a coverage of 0."""
    season_table, event_table, counters = KINDS[kind]
    registry = measures()
    eras = m.seed_franchises.select(F.col("team_id").alias("_team"), F.col("league").alias("_league"), F.year("date_start").alias("_from"), F.coalesce(F.year("date_end"), F.lit(9999)).alias("_to"))
    regular = getattr(m, season_table).join(m.seed_game_types.where("is_regular_season").select("game_type"), "game_type", "left_semi")
    seasons = regular.join(eras, (F.col("team_id") == F.col("_team")) & F.col("season").between(F.col("_from"), F.col("_to")), "left").withColumn("league", F.coalesce("_league", F.lit("N/A")))
    own = registry.evaluate(seasons, keys, registry.of(kind, "season"), [F.sum("games").alias("games"), *[F.expr(f"CAST(sum(`{n}`) AS INT) AS `{n}`") for n in counters]])
    known = m.team_game_start_info.select("team_id", "game_id", *[k for k in ("season", "league") if k in keys])
    table, measured = getattr(m, event_table), registry.of(kind, "event")
    # The places of plays are looked up by keys alone and come back to the wide rows, which stay where they are.
    own_keys = [k for k in ("player_id", "team_id") if k in keys]
    of_game = list(dict.fromkeys(["game_id", "team_id", *own_keys]))
    regular_games = m.game_start_info.where("is_regular_season").select("game_id")
    looked_up = lambda df: df.join(regular_games, "game_id", "left_semi").join(known, ["team_id", "game_id"], "left")
    games = looked_up(table.select(*of_game).distinct()).select(*keys, "game_id").distinct().groupBy(*keys).agg(F.count("game_id").alias("_games"))
    told = own
    if measured:
        place = ["game_id", "team_id"]
        added = [k for k in keys if k not in table.columns]
        places = looked_up(table.select(KEY, *place).distinct()).groupBy(KEY).agg(F.collect_list(F.struct(*place, *added)).alias("_places"))
        same = F.filter("_places", lambda x: (x["game_id"] == F.col("game_id")) & x["team_id"].eqNullSafe(F.col("team_id")))
        events = table.join(places, KEY).withColumn("_place", F.explode(same))
        events = events.withColumns({k: F.col(f"_place.{k}") for k in added}) if added else events
        told = own.join(registry.evaluate(events, keys, measured), keys, "left")
    coverage = F.coalesce(F.try_divide(F.col("_games").cast("double"), F.col("games").cast("double")), F.lit(0.0))
    return told.join(games, keys, "left").withColumn("event_coverage_rate", coverage).drop("_games", "games")


for _kind in KINDS:
    for _grain, _keys in GRAINS.items():
        MODELS[f"metrics_{_grain}_{_kind}"] = lambda m, kind=_kind, keys=_keys: metric_table(m, kind, keys)
