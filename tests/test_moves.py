"""What models move: rows of plays and games that are wide move once, ranges of a game meet without being cut up."""

import os
import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from playmill.models import Store, states
from playmill.plans.probes_models import _Raw
from playmill.plans.registry import Tables


@pytest.fixture(scope="module")
def store(spark, small, tmp_path_factory):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    made = Store(spark, str(tmp_path_factory.mktemp("models")), _Raw(Tables(spark, small)))
    yield made
    made.close()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def moves(plan: str) -> list[str]:
    return [x for x in plan.splitlines() if re.search(r"\bExchange ", x)]


@pytest.mark.parametrize("name", ["personnel_fielding_states", "personnel_lineup_states", "event_personnel_lookup", "event_fielders_flat", "event_states_batter_pitcher"])
def test_ranges_of_a_game_are_not_cut_up(store, name):
    assert not re.search(r"shiftright|_level", planned(store.plan(name)))


def test_writing_leaves_no_shuffle_files(store, spark):
    _ = store.event_fielding_stats
    folder = spark.conf.get("spark.local.dir", None) or spark.sparkContext.getConf().get("spark.local.dir")
    before = {str(p) for p in Path(folder).rglob("shuffle_*")}
    _ = store.event_score_states
    assert {str(p) for p in Path(folder).rglob("shuffle_*")} <= before and os.listdir(folder)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize(("name", "most"), [("event_player_fielding_stats", 2), ("player_game_offense_stats", 1), ("team_game_offense_stats", 0), ("player_game_pitching_stats", 2), ("team_game_pitching_stats", 0), ("player_position_game_fielding_stats", 1)])
def test_rows_by_game_move_once(store, name, most):
    assert len(moves(planned(store.plan(name)))) <= most


def test_wide_rows_are_not_grouped_by_game_to_count_games(store):
    for name in ("player_team_season_offense_stats", "player_team_season_pitching_stats", "metrics_team_season_offense", "metrics_player_season_league_pitching"):
        for line in planned(store.plan(name)).splitlines():
            grouped = re.search(r"Aggregate\(keys=\[([^\]]*)\]", line)
            assert not (grouped and "game_id" in grouped[1] and "sum(" in line), name


def test_two_games_of_one_key_share_its_places(spark):
    """255 * 1 + 300 is 255 * 2 + 45: of each place the player who stays longest counts, whichever game's."""
    appearances = spark.createDataFrame([(1, "Home", 1, 10, 300, 310), (1, "Home", 2, 11, 300, 305), (1, "Home", 2, 12, 306, 310), (2, "Home", 1, 20, 45, 400), (2, "Home", 3, 21, 45, 50)], "game_id long, side string, fielding_position int, player_id long, start_event_id long, end_event_id long")
    games = spark.createDataFrame([(1, 255, 7, 8), (2, 510, 9, 8)], "game_id long, game_key long, home_team_id int, away_team_id int")
    m = SimpleNamespace(stg_game_fielding_appearances=appearances, stg_games=games)
    m.personnel_fielding_sets = states.personnel_fielding_sets(m)
    got = sorted(tuple(r) for r in states.personnel_fielding_states(m).select("personnel_fielding_key", "fielding_position", "game_id", "player_id", "start_event_id", "end_event_id").collect())
    assert got == [(555, 1, 2, 20, 45, 400), (555, 2, 1, 11, 300, 305), (555, 3, 2, 21, 45, 400), (561, 1, 1, 10, 306, 310), (561, 2, 1, 12, 306, 310)]
    assert m.personnel_fielding_sets.agg(F.sum(F.size("players"))).first()[0] == 5


def test_keys_of_all_plays_are_not_sent_to_the_driver(spark, store):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        plan = planned(store.plan("linear_weights"))
        assert "SortMergeJoin [event_key" in plan and not re.search(r"BroadcastHashJoin \[event_key", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
