"""Models as written tables: order, layout, and plans."""

import re
import time

import pytest
from pyspark.sql import functions as F

from playmill.models import MODELS, Catalogue, Store, build
from playmill.plans import probes
from playmill.plans.probes_models import _Raw
from playmill.plans.registry import Tables


@pytest.fixture(scope="module")
def store(spark, small, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("models")), _Raw(Tables(spark, small)))
    for name in ("event_offense_stats", "event_pitching_stats", "event_batting_stats"):
        getattr(made, name)
    yield made
    made.close()


def final(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_table_is_written_once_after_what_it_reads(store):
    assert len(store.order) == len(set(store.order)) > 10
    seen = []

    class Asked(Catalogue):
        def __getattr__(self, name):
            seen.append(name)
            return getattr(store, name)

    for k, name in enumerate(store.order):
        seen.clear()
        MODELS[name](Asked())
        assert {s for s in seen if s in MODELS} <= set(store.order[:k])


def test_joins_of_event_tables_move_no_rows(spark, store):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        a, b = store.event_offense_stats, store.event_pitching_stats
        met = a.select("event_key", F.col("runs").alias("x")).join(b.select("event_key", F.col("runs").alias("y")), "event_key")
        plan = final(met)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert met.count() > 0
        free = store.stg_events.select("event_key").join(a.select("event_key"), "event_key", "left_anti")
        assert "Exchange" not in final(free)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_written_models_hold_what_plans_give(store, spark, small):
    nested = Catalogue()
    nested._tables = _Raw(Tables(spark, small))
    for name in ("event_batting_stats",):
        own, other = getattr(store, name), getattr(nested, name)
        assert own.columns == other.columns and own.count() == other.count()
        assert own.exceptAll(other).isEmpty()


def test_plans_are_no_deeper_than_a_model(spark, small):
    """Any model is planned in under two seconds once what it reads is written."""
    for name in ("mdl_putout_innings_gaps", "mdl_game_forfeits", "mdl_metrics_player_career_offense", "mdl_event_transition_values", "mdl_team_game_pitching_stats", "mdl_park_factors_outs"):
        probes.QUERIES[name](spark, small)
        began = time.time()
        plan = final(probes.QUERIES[name](spark, small))
        assert time.time() - began < 2 and "InMemoryTableScan" not in plan, name
        assert len(re.findall(r"Join", plan)) < 60


def test_seasons_have_folders(spark, small, tmp_path):
    made = build(spark, _Raw(Tables(spark, small)), str(tmp_path), ["stg_games"], by_season=True, buckets=2)
    assert made.order[-1] == "stg_games" and list((tmp_path / "stg_games").glob("season=*/part-*"))
    plan = final(made.stg_games.where("season = 1995"))
    assert re.search(r"PartitionFilters: \[[^\]]*season", plan)
    made.close()
    assert not made.order


def test_models_that_read_each_other(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(MODELS, "one", lambda m: m.two)
    monkeypatch.setitem(MODELS, "two", lambda m: m.one)
    with pytest.raises(ValueError, match="one -> two -> one"):
        _ = Store(spark, str(tmp_path), {}).one
