"""Benchmark decontamination against every window compared by its words."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from playmill.llm import decontamination as D
from playmill.llm import queries


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, length=10):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(length, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    met |= own
        spans = [i for i in sorted(hit) if i - 1 not in hit], [i + 1 for i in sorted(hit) if i + 1 not in hit]
        out.append((doc is None, doc or 0, len(w), len(hit), len(met), ",".join(sorted(met)), [*zip(*spans)]))
    return sorted(out)


def rows(df):
    out = []
    for r in df.collect():
        merged = []
        for s in r["spans"]:  # spans that only touch are one stretch of hit words
            if merged and merged[-1][1] == s["begin"]:
                merged[-1] = (merged[-1][0], s["end"])
            else:
                merged.append((s["begin"], s["end"]))
        out.append((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["items"], merged))
    return sorted(out)


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "日本", "O'Neil", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(40)
    items = [(i, text(rng.randrange(12, 40))) for i in range(15)] + [(20 + i, text(5) + " " + passage + " " + text(5)) for i in range(6)]
    items += [(30, "the the the the the the the the the the the the"), (31, "Short ITEM here"), (32, "w1"), (33, ""), (34, None), (None, text(14)), (3, text(11)), (35, items[0][1]), (36, "w2 w3 w4 w5")]
    docs = []
    for i in range(80):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1)
            parts += [" ".join(w[a : a + rng.randrange(5, 45)]).upper(), text(rng.randrange(0, 9))]
        docs.append((i, ", ".join(parts)))
    docs += [(100 + k, "same! " + passage) for k in range(9)] + [(None, passage), (200, None), (201, ""), (202, "..."), (203, "the " * 50), (204, "short-item-here"), (5, docs[5][1])]
    docs += [(205, text(4000) + " " + passage + " " + text(4000)), (206, "z" * 50_000)]
    kind = "d1 long, length int, text string, item string"
    return docs, items, spark.createDataFrame([(d, 1, 2, t, "x") for d, t in docs], "doc_id long, " + kind), spark.createDataFrame([(d, 1, 2, t, "x") for d, t in items], "item_id long, " + kind)


@pytest.mark.parametrize("length, stretch", [(10, 1 << 18), (10, 37), (3, 1 << 18), (1, 1 << 18)])
def test_decontamination(cases, length, stretch, monkeypatch):
    monkeypatch.setattr(D, "STRETCH", stretch)
    docs, items, docs_df, items_df = cases
    want = brute(docs, items, length)
    assert sum(w[3] > 0 for w in want) > 30
    assert rows(D.contaminated(docs_df, items_df, length)) == want


def test_full_table_loses_and_adds_nothing(cases, monkeypatch):
    """Whatever the table lets through, the joins decide."""
    docs, items, docs_df, items_df = cases
    monkeypatch.setattr(D, "bit_table", lambda prints: np.full(D.TABLE_BITS // 64, 2**64 - 1, np.uint64))
    assert rows(D.contaminated(docs_df, items_df)) == brute(docs, items)


def test_shared_spans_hold_a_fingerprint():
    """Any span of a window's length has its fingerprint on both sides, and few windows change it."""
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 10).astype(np.uint64)
    for _ in range(50):
        a, b = (np.concatenate([rng.integers(0, 2**63, 30).astype(np.uint64), shared, rng.integers(0, 2**63, 30).astype(np.uint64)]) for _ in range(2))
        assert D.fingerprints(a, 10)[30] == D.fingerprints(b, 10)[30]
    long = D.fingerprints(rng.integers(0, 2**63, 50_000).astype(np.uint64), 10)
    assert 0.25 < (np.diff(long.view(np.int64)) != 0).mean() < 0.32  # 2 of 7


def test_decontamination_of_nothing(cases):
    docs, items, docs_df, items_df = cases
    assert D.contaminated(docs_df.where(F.lit(False)), items_df).count() == 0
    assert rows(D.contaminated(docs_df, items_df.where(F.lit(False)))) == brute(docs, [])


@pytest.mark.parametrize("table", ["given", "odd"])
def test_decontamination_query(spark, small, cases, tmp_path, table):
    if table == "odd":
        cases[2].select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
        cases[3].select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
        small = str(tmp_path)
    con = duckdb.connect()
    for n in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{small}/{n}.parquet{'/*.parquet' if table == 'odd' else ''}'")
    want = con.sql(queries.ORACLES["op13_decontamination"])
    got = queries.QUERIES["op13_decontamination"](spark, small).select(*want.columns)
    key = lambda r: (r[0] is None, *[x or 0 for x in r[:4]], r[4])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)
