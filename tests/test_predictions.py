"""Models of eight outcomes: stored, read again, and better than saying the most frequent."""

import pytest
from pyspark.sql import functions as F

from playmill.models.learning import CATEGORIES, NUMBERS, PLAYERS, TARGETS
from playmill.operators import ml as ML
from playmill.plans import probes
from playmill.plans.probes_models import _store
from playmill.plans.registry import Tables

SIDES = (NUMBERS, CATEGORIES, PLAYERS)


@pytest.fixture(scope="module")
def rows(spark, small):
    return _store(Tables(spark, small)).ml_features


@pytest.mark.parametrize("target", TARGETS, ids=lambda t: t.name)
def test_predictions_beat_the_majority(spark, small, rows, target):
    got = probes.QUERIES[f"predictions_{target.name}"](spark, small)
    assert got.count() == rows.count() == got.select("event_key").distinct().count() and got.select("model_run_id").distinct().count() == 1
    known = got.join(ML.select_target(rows, target.column, target.kind, target.weight, target.weighed_only).select("event_key", target.column, target.weight), "event_key")
    y, w = F.col(target.column), F.col(target.weight)
    if target.kind == "regression":
        r = known.agg((F.sum(w * (F.col("value") - y) ** 2) / F.sum(w)).alias("mse"), F.var_pop(y).alias("variance")).first()
        assert r["mse"] < r["variance"]
        return
    said = F.col("predicted" if target.kind == "binary" else "predicted_class").cast("string")
    chance = F.col("probability" if target.kind == "binary" else "predicted_class_proba")
    assert known.where((chance < 0) | (chance > 1) | chance.isNull()).count() == 0
    right = known.agg((F.sum(F.when(said == y.cast("string"), w)) / F.sum(w))).first()[0]
    total = known.agg(F.sum(w)).first()[0]
    most = known.groupBy(y).agg(F.sum(w).alias("n")).agg(F.max("n")).first()[0] / total
    assert right > most or most == 1.0, (right, most)


def test_loaded_models_score_as_fitted(spark, rows, tmp_path):
    few = rows.limit(300)
    fitted = ML.fit_targets(few, [TARGETS[0], TARGETS[1], TARGETS[5]], *SIDES, "r1", hashed=64, rounds=3)
    fitted.save(str(tmp_path))
    again = ML.Fitted.load(spark, str(tmp_path), "r1")
    a, b = (sorted(map(str, ML.score_targets(few, f, "event_key", *SIDES).collect())) for f in (fitted, again))
    assert a == b and len(a) == 300
    plan = ML.score_targets(rows, again, "event_key", *SIDES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan parquet") == 1
