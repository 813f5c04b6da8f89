"""Queries for the composed pipelines, through the adapters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import pipelines as PL
from .adapters import AS_PLAYS, AS_POSITIONS, AS_TEAM_GAMES, as_plays, as_positions, as_team_games
from .registry import probe

_P = f"p AS ({AS_PLAYS})"
_STATS = "count(*) AS plate_appearances, count(*) FILTER (WHERE result IN ('purchase', 'signup')) AS hits, count(*) FILTER (WHERE result = 'click') AS walks, count(*) FILTER (WHERE result = 'error') AS outs, CAST(sum(runs_on_play) AS BIGINT) AS runs"


@probe("pl_event_batting_stats", f"WITH {_P} SELECT play, game, holder, 1 AS plate_appearances, CAST(result IN ('purchase', 'signup') AS INTEGER) AS hits, CAST(result = 'click' AS INTEGER) AS walks, CAST(result = 'error' AS INTEGER) AS outs, CAST(result IN ('purchase', 'signup', 'click') AS INTEGER) AS on_base_successes, runs_on_play AS runs FROM p")
def pl_event_batting_stats(t):
    return PL.event_batting_stats(as_plays(t))


@probe(
    "pl_event_base_out_states",
    f"""WITH {_P} SELECT play, base_state, lead(base_state) OVER w AS base_state_end, CAST(bit_count(base_state) AS INTEGER) AS runners,
 CAST(sum(CASE WHEN away THEN runs_on_play ELSE 0 END) OVER (PARTITION BY game ORDER BY event_id ROWS UNBOUNDED PRECEDING) - CASE WHEN away THEN runs_on_play ELSE 0 END AS BIGINT) AS away_start,
 CAST(sum(CASE WHEN away THEN runs_on_play ELSE 0 END) OVER (PARTITION BY game ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS away_end,
 lag(play) OVER w IS NULL AS opens, lead(play) OVER w IS NULL AS ends, CAST(sum(runs_on_play) OVER (PARTITION BY game, inning, away ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest_of_half
FROM p WINDOW w AS (PARTITION BY game, inning, away ORDER BY event_id)""",
)
def pl_event_base_out_states(t):
    return PL.event_base_out_states(as_plays(t))


@probe(
    "pl_fielding_chains",
    f"""WITH {_P}, n AS (SELECT *, sum(CAST(result IN ('purchase', 'error') AS INTEGER)) OVER (PARTITION BY game ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n FROM p),
c AS (SELECT *, lag(n, 1, 0) OVER (PARTITION BY game ORDER BY event_id) AS chain FROM n), h AS (SELECT *, bool_or(result = 'click') OVER (PARTITION BY game, chain) AS helped FROM c)
SELECT game, holder, count(*) FILTER (WHERE result = 'purchase') AS putouts, count(DISTINCT CASE WHEN result = 'click' THEN chain END) AS assists, count(*) FILTER (WHERE result = 'error') AS errors, count(*) FILTER (WHERE result = 'purchase' AND helped) AS assisted_putouts FROM h GROUP BY 1, 2""",
)
def pl_fielding_chains(t):
    return PL.fielding_chains(as_plays(t))


@probe("pl_player_fan_out", f"WITH {_P}, f AS (SELECT unnest(range(4)) AS fielder) SELECT CAST(fielder AS INTEGER) AS fielder, count(*) AS plays, count(*) FILTER (WHERE holder = fielder) AS own_plays, CAST(sum(outs_on_play) FILTER (WHERE holder = fielder) AS BIGINT) AS own_outs, CAST(sum(outs_on_play) AS BIGINT) AS outs FROM p CROSS JOIN f GROUP BY 1")
def pl_player_fan_out(t):
    return PL.player_fan_out(as_plays(t))


@probe("pl_player_game_stats", f"WITH {_P}, s AS (SELECT * FROM p WHERE game % 3 <> 0), r AS (SELECT game, holder, count(*) AS plate_appearances FROM p WHERE game NOT IN (SELECT game FROM s) GROUP BY 1, 2) SELECT game, holder, {_STATS} FROM s GROUP BY 1, 2 UNION ALL SELECT game, holder, plate_appearances, NULL, NULL, NULL, NULL FROM r")
def pl_player_game_stats(t):
    plays = as_plays(t)
    return PL.player_game_stats(plays.where("game % 3 <> 0"), plays.groupBy("game", "holder").agg(F.count("*").alias("plate_appearances")))


@probe(
    "pl_player_season_stats",
    f"""WITH p AS ({AS_POSITIONS}), q AS (SELECT team, season, player, CASE WHEN player % 3 <> 0 THEN CAST(sum(games) AS BIGINT) END AS games, CAST(sum(pa) AS BIGINT) AS pa FROM p WHERE player % 4 <> 0 GROUP BY 1, 2, 3), o AS (SELECT team, season, player, CAST(sum(games) + 1 AS BIGINT) AS games, CAST(max(pa) AS BIGINT) AS pa FROM p WHERE player % 5 <> 0 GROUP BY 1, 2, 3)
SELECT q.team, q.season, q.player, CASE WHEN q.season < 1998 THEN coalesce(o.games, q.games) ELSE coalesce(q.games, o.games) END AS games, CASE WHEN q.season < 1998 THEN coalesce(o.pa, q.pa) ELSE coalesce(q.pa, o.pa) END AS pa FROM q LEFT JOIN o USING (team, season, player)
UNION ALL SELECT * FROM o WHERE (team, season, player) NOT IN (SELECT team, season, player FROM q)""",
)
def pl_player_season_stats(t):
    keys = ["team", "season", "player"]
    p = as_positions(t)
    q = p.where("player % 4 <> 0").groupBy(*keys).agg(F.sum("games").alias("games"), F.sum("pa").alias("pa")).withColumn("games", F.when(F.col("player") % 3 != 0, F.col("games")))
    o = p.where("player % 5 <> 0").groupBy(*keys).agg((F.sum("games") + 1).alias("games"), F.max("pa").alias("pa"))
    return PL.player_season_stats(q, o, keys, ["games", "pa"], "season", 1998)


@probe(
    "pl_team_game_results",
    f"""WITH g AS ({AS_TEAM_GAMES}), n AS (SELECT *, row_number() OVER w AS k, lag(win) OVER w AS was FROM g WINDOW w AS (PARTITION BY team, season ORDER BY day, game)),
f AS (SELECT *, CASE WHEN win THEN last_value(CASE WHEN win AND NOT coalesce(was, false) THEN k END IGNORE NULLS) OVER (PARTITION BY team, season ORDER BY k ROWS UNBOUNDED PRECEDING) END AS sid FROM n)
SELECT game, team, season, CAST(k AS INTEGER) AS number, CAST(sum(CAST(win AS INTEGER)) OVER w AS BIGINT) AS wins, CAST(sum(CAST(NOT win AS INTEGER)) OVER w AS BIGINT) AS losses, CAST(CASE WHEN win THEN row_number() OVER (PARTITION BY team, season, sid ORDER BY k) ELSE 0 END AS INTEGER) AS streak_length,
 CAST(date_diff('day', lag(day) OVER (PARTITION BY team, season ORDER BY k), day) AS INTEGER) AS rest, CAST(sum(CAST(win AS INTEGER)) OVER (PARTITION BY team, season ORDER BY k ROWS 9 PRECEDING) AS BIGINT) AS last_10 FROM f WINDOW w AS (PARTITION BY team, season ORDER BY k ROWS UNBOUNDED PRECEDING)""",
)
def pl_team_game_results(t):
    return PL.team_game_results(as_team_games(t))


@probe(
    "pl_people",
    """WITH a AS (SELECT o_custkey AS id, o_orderpriority AS name FROM orders WHERE o_custkey % 2 = 0), b AS (SELECT c_custkey AS id, c_mktsegment AS name FROM customer WHERE c_custkey % 3 = 0),
m AS (SELECT id, name FROM (SELECT id, name, count(*) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, name) = 1)
SELECT id, CAST(id IN (SELECT id FROM a) AS INTEGER) AS in_0, CAST(id IN (SELECT id FROM b) AS INTEGER) AS in_1, name FROM m""",
)
def pl_people(t):
    a = t.orders.where("o_custkey % 2 = 0").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"))
    b = t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"))
    return PL.people([a, b], "id", "name")


@probe(
    "pl_line_scores",
    f"""WITH {_P}, b AS (SELECT game, away, inning, sum(runs_on_play) AS r FROM p GROUP BY 1, 2, 3), g AS (SELECT DISTINCT game, away, i FROM b, (SELECT unnest(range(1, 9)) AS i))
SELECT g.game, g.away, string_agg(CASE WHEN r IS NULL THEN 'x' WHEN r > 9 THEN '(' || r || ')' ELSE CAST(r AS VARCHAR) END, '' ORDER BY i) AS line_score FROM g LEFT JOIN b ON g.game = b.game AND g.away = b.away AND g.i = b.inning GROUP BY 1, 2""",
)
def pl_line_scores(t):
    return PL.line_scores(as_plays(t))


@probe(
    "pl_starting_lineups",
    "WITH a AS (SELECT l_orderkey AS game, l_linenumber AS slot, l_partkey AS player FROM lineitem), o AS (SELECT * FROM a QUALIFY count(*) OVER (PARTITION BY game, slot) = 1) SELECT game, CAST(count(*) AS INTEGER) AS n, max(CASE WHEN slot = 1 THEN player END) AS first FROM o GROUP BY 1",
)
def pl_starting_lineups(t):
    a = t.lineitem.select(F.col("l_orderkey").alias("game"), F.col("l_linenumber").alias("slot"), F.col("l_partkey").alias("player"))
    return PL.starting_lineups(a).select("game", F.size("lineup").alias("n"), F.try_element_at("lineup", F.lit(1)).alias("first"))


@probe("pl_count_rates", f"WITH {_P}, b AS (SELECT outs, base_state, count(*) AS n, avg(CAST(result = 'purchase' AS INTEGER)) AS rate FROM p GROUP BY 1, 2) SELECT outs, base_state, n, round(rate, 6) AS rate, round(n / sum(n) OVER (PARTITION BY outs), 6) AS share, round(n / sum(n) OVER (), 6) AS of_all FROM b")
def pl_count_rates(t):
    return PL.count_rates(as_plays(t)).select("outs", "base_state", "n", *[F.round(c, 6).alias(c) for c in ("rate", "share", "of_all")])


@probe("pl_leaders", f"WITH p AS ({AS_POSITIONS}), s AS (SELECT season, player, CAST(sum(pa) AS BIGINT) AS hits FROM p GROUP BY 1, 2) SELECT season, player, hits, CAST(row_number() OVER (PARTITION BY season ORDER BY hits DESC, player) AS INTEGER) AS rank FROM s QUALIFY rank <= 5")
def pl_leaders(t):
    return PL.leaders(as_positions(t).groupBy("season", "player").agg(F.sum("pa").alias("hits")), 5)
