"""Play-by-play, team games, positions and dated spans derived from the given tables, in DataFrames and in the oracle's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AS_SPELLS = """SELECT o_custkey, spell, first, last FROM (
  SELECT o_custkey, o_orderkey AS spell, CAST(o_orderdate AS DATE) AS first,
         lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS last FROM orders
) WHERE last IS NULL OR last >= first"""

AS_PLAYS = """SELECT event_id AS play, user_id * 1000 + dayofyear(ts) AS game, event_id, event_id % 2 = 0 AS away, CAST(hour(ts) // 3 + 1 AS INTEGER) AS inning,
  CAST(event_id % 8 AS INTEGER) AS base_state, CAST(event_id % 3 AS INTEGER) AS outs, CAST(event_type = 'purchase' AS INTEGER) AS runs_on_play,
  CAST(event_type = 'error' AS INTEGER) AS outs_on_play, event_type AS result, event_id // 7 % 4 AS holder, user_id, value FROM events"""

AS_TEAM_GAMES = """SELECT o_orderkey AS game, CAST(c_nationkey AS INTEGER) AS team, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderkey % 25 AS INTEGER) AS opponent,
  CAST(o_orderdate AS DATE) AS day, o_totalprice > 250000 AS win, c_mktsegment AS league FROM orders JOIN customer ON o_custkey = c_custkey"""

AS_POSITIONS = """SELECT l_suppkey AS team, CAST(year(l_shipdate) AS INTEGER) AS season, l_partkey AS player, CAST(l_partkey % 9 + 1 AS INTEGER) AS position,
  count(*) AS games, CAST(sum(l_quantity) AS BIGINT) AS pa FROM lineitem GROUP BY 1, 2, 3, 4"""


def as_spells(t) -> DataFrame:
    """Per customer: an order's date until the day before the next one; empty spans are dropped."""
    day = F.to_date("o_orderdate")
    following = F.lead(day).over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    made = t.orders.select("o_custkey", F.col("o_orderkey").alias("spell"), day.alias("first"), F.date_sub(following, 1).alias("last"))
    return made.where("last IS NULL OR last >= first")


def as_plays(t) -> DataFrame:
    e = F.col("event_id")
    return t.events.select(
        e.alias("play"), (F.col("user_id") * 1000 + F.dayofyear("ts")).alias("game"), "event_id", (e % 2 == 0).alias("away"), (F.floor(F.hour("ts") / 3) + 1).cast("int").alias("inning"),
        (e % 8).cast("int").alias("base_state"), (e % 3).cast("int").alias("outs"), (F.col("event_type") == "purchase").cast("int").alias("runs_on_play"),
        (F.col("event_type") == "error").cast("int").alias("outs_on_play"), F.col("event_type").alias("result"), (F.floor(e / 7) % 4).alias("holder"), "user_id", "value",
    )


def as_team_games(t) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("game"), F.col("c_nationkey").cast("int").alias("team"), F.year("o_orderdate").alias("season"), (F.col("o_orderkey") % 25).cast("int").alias("opponent"),
        F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") > 250000).alias("win"), F.col("c_mktsegment").alias("league"),
    )


def as_positions(t) -> DataFrame:
    keys = [F.col("l_suppkey").alias("team"), F.year("l_shipdate").alias("season"), F.col("l_partkey").alias("player"), (F.col("l_partkey") % 9 + 1).cast("int").alias("position")]
    return t.lineitem.groupBy(*keys).agg(F.count("*").alias("games"), F.sum("l_quantity").cast("long").alias("pa"))
