"""Range joins by dyadic intervals, numbering by fixed bounds, and days made from totals, where keys are hot or rows are odd."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from playmill.operators import joins as J
from playmill.operators import sets as S
from playmill.operators import windows as W


def test_a_hot_key_joins_to_what_matches(spark):
    """One key, 10^5 points and 10^5 ranges: no more rows meet than match."""
    n = 100_000
    points = spark.range(n).select(F.lit(1).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10 * n)).alias("p"))
    ranges = spark.range(n).select(F.lit(1).alias("k"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(10 * n)).alias("lo")).withColumn("hi", F.col("lo") + F.pmod(F.xxhash64("lo"), F.lit(30)))
    met = J.meeting(points, ranges, ["k"], "p", "lo", "hi").count()
    matches = J.interval_contains(points, ranges, ["k"], "p", "lo", "hi").count()
    assert met == matches and 100_000 < matches < 200_000
    long = ranges.limit(10).withColumn("hi", F.lit(10**15))
    assert J.meeting(points, long, ["k"], "p", "lo", "hi").count() == J.interval_contains(points, long, ["k"], "p", "lo", "hi").count()


@pytest.mark.parametrize("kind, unit", [("int", 1), ("int", 7), ("double", 1), ("date", 1), ("timestamp", 1), ("timestamp", 3_600_000_000)])
def test_contains_and_overlap(spark, kind, unit):
    rng = random.Random(unit)
    rows = lambda n, width: [(rng.choice("ab") if rng.random() < 0.95 else None, *sorted([a := rng.randrange(-40, 60), a + rng.randrange(-2, width)]), i) for i in range(n)]
    make = {"int": lambda c: F.col(c), "double": lambda c: F.col(c) / 4, "date": lambda c: F.date_add(F.lit("2001-02-03").cast("date"), F.col(c)), "timestamp": lambda c: F.timestamp_micros(F.col(c).cast("long") * 1_700_000_000)}[kind]
    typed = lambda df, cols: df.withColumns({c: make(c) for c in cols})
    one, other = rows(80, 12), [*rows(60, 30), ("a", None, 5, 99), ("a", 3, None, 98)]
    a = typed(spark.createDataFrame(one, "k string, p int, q int, i int"), "pq")
    b = typed(spark.createDataFrame(other, "k string, lo int, hi int, j int"), ("lo", "hi"))
    got = sorted((r["i"], r["j"]) for r in J.interval_contains(a, b, ["k"], "p", "lo", "hi", unit).collect())
    fine = [(k, lo, hi, j) for k, lo, hi, j in other if None not in (k, lo, hi)]
    assert got == sorted((i, j) for k, p, _, i in one for m, lo, hi, j in fine if k == m and lo <= p <= hi) and got
    both = J.interval_overlap(a, b, ["k"], ("p", "q"), ("lo", "hi"), unit)
    assert sorted((r["i"], r["j"]) for r in both.collect()) == sorted((i, j) for k, p, q, i in one for m, lo, hi, j in fine if k == m and p <= hi and q >= lo)


def test_ranges_without_points(spark):
    a, b = spark.createDataFrame([], "k int, p int"), spark.createDataFrame([(1, 2, 3)], "k int, lo int, hi int")
    assert J.interval_contains(a, b, ["k"], "p", "lo", "hi").count() == 0
    assert J.interval_contains(b.select("k", F.col("lo").alias("p")), b.limit(0), ["k"], "p", "lo", "hi").count() == 0


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("sample", [0, 3, 2000])
def test_numbers_are_the_same_whatever_the_partitions(spark, coalesce, sample):
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        rows = [(None if i % 50 == 7 else f"n{i * 7919 % 211}", i) for i in range(1000)]
        df = spark.createDataFrame(rows, "name string, id int")
        got = W.row_numbers(df.repartition(7), ["name", "id"], "k", sample).orderBy("k").collect()
        assert [(r["name"], r["id"]) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        assert [r["k"] for r in got] == list(range(1, 1001))
        plan = W.row_numbers(df, ["name", "id"], "k")._jdf.queryExecution().optimizedPlan().toString()
        assert "spark_partition_id" not in plan.lower()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)


def test_days_between_come_from_totals(spark):
    rows = [("a", date(2020, 1, 3), 2), ("a", date(2020, 1, 3), None), ("a", date(2020, 1, 7), 1), ("b", date(2020, 3, 1), 5)]
    df = spark.createDataFrame(rows, "k string, d date, n int")
    got = {(r["k"], r["d"]): r["n"] for r in S.spine_fill(df, ["k"], "d", ["n"], 2).collect()}
    want = {}
    for k, first, last in (("a", date(2020, 1, 3), date(2020, 1, 7)), ("b", date(2020, 3, 1), date(2020, 3, 1))):
        for i in range(-2, (last - first).days + 3):
            day = first + timedelta(i)
            want[k, day] = sum(n or 0 for kk, dd, n in rows if kk == k and dd <= day)
    assert got == want
    plan = S.spine_fill(df, ["k"], "d", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
