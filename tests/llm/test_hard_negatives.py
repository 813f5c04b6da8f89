"""Hard-negative mining against SQL that scores all rows, and the heap's order and certificates."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from playmill.llm import hard_negatives as H
from playmill.llm import queries


@pytest.fixture(scope="module")
def odd(spark):
    """Clusters, ties, repeated rows, other dimensions, and rows that take no part."""
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 0.3, (12, 16))
    rows = []
    for i in range(600):
        c = int(rng.integers(12))
        v = middles[c] + rng.normal(0, 0.1, 16)
        rows.append((i, [float(np.float32(x)) for x in (np.round(v, 1) if i % 3 else v)], c % 5))
    rows += rows[:120]  # repeated rows, anchors among them
    rows += [(1000 + i, rows[100][1], i % 5) for i in range(200)]  # one very common vector
    rows += [(2000 + 50 * i, [0.5] * 3, i % 2) for i in range(10)] + [(3000, [], 1), (3001, [], 2), (-100, rows[5][1], 4), (-7, rows[6][1], 9)]
    rows += [(None, rows[0][1], 1), (5000, None, 1), (5100, rows[0][1], None), (5200, [float("nan")] * 16, 1), (5300, [float("inf")] + [0.0] * 15, 2), (5400, [None] + [0.0] * 15, 2), (5500, [0.0] * 16, 3)]
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, label int, row int, g string")


def same(spark, folder, got, where=""):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet{where}'")
    want = con.sql(queries.ORACLES["op12_hard_negatives"])
    rows = sorted(map(tuple, got.select(*want.columns).collect()))
    assert rows == sorted(want.fetchall()) and rows


@pytest.mark.parametrize("least, words", [(256, 64), (20, 5)])
def test_mining(spark, odd, tmp_path, monkeypatch, least, words):
    monkeypatch.setattr(H, "LEAST_ROWS", least)
    monkeypatch.setattr(H, "MOST_ROWS", 60 if least < 100 else H.MOST_ROWS)
    monkeypatch.setattr(H, "SAMPLE", 50 if least < 100 else H.SAMPLE)
    odd.write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = H.usable(odd, F.expr(queries.SHIFTED_LABEL))
    same(spark, tmp_path, H.mine(rows, F.col("vec_id") % 100 == 0, codewords_per_half=words), "/*.parquet")


def test_query(spark, small):
    same(spark, small, queries.QUERIES["op12_hard_negatives"](spark, small))


def test_nothing_to_mine(spark, odd):
    for df in (odd.where(F.lit(False)), odd.where("label IS NULL"), odd.where("vec_id = 0")):
        assert H.mine(H.usable(df, F.col("label")), F.col("vec_id") % 100 == 0).count() == 0


def test_heap_visits_all_cells_in_order():
    rng = np.random.default_rng(2)
    u, v = np.round(rng.normal(0, 1, 20), 1), np.round(rng.normal(0, 1, 13), 1)
    got = list(H.visits(u, v))
    assert len({g[:2] for g in got}) == 260 and all(abs(u[i] + v[j] - s) < 1e-12 for i, j, s in got)
    assert all(a[2] >= b[2] - 1e-12 for a, b in zip(got, got[1:]))
    assert list(H.visits(u[:0], v)) == []


def test_cells_left_out_hold_nothing(spark, odd):
    """Bounds hold for every row, and clustered rows need few cells."""
    rows = H.usable(odd.where("size(embedding) = 16 AND vec_id < 600"), F.col("label"))
    index, placed = H.build(rows)
    own = placed.toPandas()
    x = np.array(own["v"].tolist(), np.int64)
    seen = []
    for k in range(0, len(x), 60):
        (m1, m2), (o1, o2) = index.books[16].middles(x[k])
        scores, c1, c2 = x @ x[k], own["c1"].to_numpy(), own["c2"].to_numpy()
        assert (scores <= (m1 + o1)[c1] + (m2 + o2)[c2]).all() and (scores >= (m1 - o1)[c1] + (m2 - o2)[c2]).all()
        fifth = np.sort(scores)[-6]
        seen.append(((m1 + o1)[c1] + (m2 + o2)[c2] >= fifth).mean())
    assert np.mean(seen) < 0.6
