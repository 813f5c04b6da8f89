"""Queries for machine-learning data jobs and lineup reconstruction."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import lineups as L
from ..operators import ml as ML
from ..operators import project as P
from ..sources.shared import written
from .adapters import AS_PLAYS, AS_POSITIONS, as_plays, as_positions
from .registry import probe

# Machine-learning data jobs


@probe("ml_outcomes", "SELECT event_id, CAST(value > 50 AS INTEGER) AS is_large, CASE WHEN event_type = 'error' THEN 'error' WHEN value > 50 THEN 'large' WHEN event_type = 'purchase' THEN 'sale' ELSE 'Other' END AS outcome FROM events")
def ml_outcomes(t):
    k, v = F.col("event_type"), F.col("value")
    out = ML.outcomes(t.events, {"is_large": P.flag(v > 50)}, [("error", k == "error"), ("large", v > 50), ("sale", k == "purchase")])
    return out.select("event_id", "is_large", "outcome")


@probe("ml_weights", "WITH c AS (SELECT event_type, count(*) AS n FROM events WHERE value > 5 GROUP BY 1), w AS (SELECT event_id, CASE WHEN value > 5 THEN 1.0 / n ELSE 0 END AS w FROM events LEFT JOIN c USING (event_type)) SELECT event_id, round(w / (SELECT avg(w) FROM w), 5) AS weight FROM w")
def ml_weights(t):
    return ML.inverse_weights(t.events, "event_type", F.col("value") > 5).select("event_id", F.round("weight", 5).alias("weight"))


@probe("ml_features", "SELECT event_id, CAST(dayofyear(ts) AS DOUBLE) AS day_num, least(value, 40.0) AS value_num, coalesce(nullif(event_type, 'view'), 'N/A') AS kind FROM events")
def ml_features(t):
    out = ML.features(t.events.withColumn("kind", F.nullif(F.col("event_type"), F.lit("view"))), {"day_num": F.dayofyear("ts"), "value_num": F.col("value")}, {"value_num": 40.0}, ["kind"])
    return out.select("event_id", "day_num", "value_num", "kind")


@probe("ml_split", "SELECT event_id, CASE WHEN user_id % 100 < 2 THEN 'test' ELSE 'train' END AS split FROM events")
def ml_split(t):
    return ML.split(t.events, "user_id", 2, F.col("user_id")).select("event_id", "split")


@probe("ml_target_select", "SELECT event_id FROM events WHERE event_type <> 'view' AND value - 10 > 0")
def ml_target_select(t):
    rows = t.events.withColumns({"target": F.nullif(F.col("event_type"), F.lit("view")), "w": F.col("value") - 10})
    return ML.select_target(rows, "target", "binary", "w").select("event_id")


@probe("ml_vocab", "SELECT p_brand AS value, CAST(row_number() OVER (ORDER BY p_brand) AS INTEGER) AS code FROM (SELECT DISTINCT p_brand FROM part)")
def ml_vocab(t):
    return ML.vocabulary(t.part, "p_brand")


@probe("ml_numeric_stats", "SELECT 'value' AS \"column\", round(avg(value), 5) AS mean, round(greatest(var_pop(value), 1e-6), 4) AS variance FROM events UNION ALL SELECT 'user_id', round(avg(user_id), 5), round(greatest(var_pop(user_id), 1e-6), 4) FROM events")
def ml_numeric_stats(t):
    return ML.numeric_stats(t.events, ["value", "user_id"]).select("column", F.round("mean", 5).alias("mean"), F.round("variance", 4).alias("variance"))


@probe("ml_encode", "WITH v AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS INTEGER) AS code FROM (SELECT DISTINCT event_type FROM events WHERE user_id % 2 = 0 AND event_type <> 'view')) SELECT event_id, coalesce(code, 0) AS kind_code, CASE WHEN value > 10 THEN value ELSE 0 END AS x FROM events LEFT JOIN v USING (event_type)")
def ml_encode(t):
    df = t.events.select("event_id", "user_id", F.col("event_type").alias("kind"), F.when(F.col("value") > 10, F.col("value")).alias("x"))
    words = ML.vocabulary(df.where("user_id % 2 = 0 AND kind <> 'view'"), "kind")
    return ML.encode(df, {"kind": words}, ["x"]).select("event_id", "kind_code", "x")


def _model(t, kind):
    df = t.events.select("event_id", "user_id", "value", F.dayofweek("ts").alias("dow"), F.hour("ts").cast("double").alias("hour"), F.col("event_type").alias("kind"))
    df = ML.encode(df, {"dow": ML.vocabulary(df, "dow")}, ["hour"])
    label = {"binary": P.flag(F.col("kind") == "view").cast("double"), "regression": F.col("value")}.get(kind)
    df = ML.class_index(df, "kind", ML.vocabulary(df, "kind")) if label is None else df.withColumn("label", label)
    df = ML.split(df, "event_id", 20, F.col("event_id"))
    model = ML.fit(df.where("split = 'train'"), ["dow_code"], ["hour"], kind)
    return ML.score(model, df.where("split = 'test'"), ["event_id", "label"], kind, "run")


@probe("ml_fit")
def ml_fit(t):
    return _model(t, "multiclass")


@probe("ml_score")
def ml_score(t):
    return _model(t, "binary").drop("label")


@probe("ml_eval")
def ml_eval(t):
    return ML.evaluate(_model(t, "regression"), "regression")


# Lineups


@probe("lu_position_games", "WITH p AS (SELECT o_custkey % 50 AS player, sum(o_orderkey % 7) AS g, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS a, count(*) FILTER (WHERE o_orderkey % 3 = 1) AS b FROM orders GROUP BY 1) SELECT player, 'a' AS position, round(g * a / (a + b), 5) AS games FROM p WHERE g * a > 0 UNION ALL SELECT player, 'b', round(g * b / (a + b), 5) FROM p WHERE g * b > 0")
def lu_position_games(t):
    p = t.orders.groupBy((F.col("o_custkey") % 50).alias("player")).agg(F.sum(F.col("o_orderkey") % 7).cast("double").alias("g"), F.count_if(F.col("o_orderkey") % 3 == 0).cast("double").alias("a"), F.count_if(F.col("o_orderkey") % 3 == 1).cast("double").alias("b"))
    return L.position_games(p, "g", ["a", "b"]).select("player", "position", F.round("games", 5).alias("games"))


_POS = f"p AS ({AS_POSITIONS})"


@probe("lu_candidates", f"WITH {_POS}, b AS (SELECT season, team, player, CAST(sum(pa) AS BIGINT) AS total FROM p WHERE position > 2 GROUP BY 1, 2, 3) SELECT p.season, p.team, p.player, p.position, p.games, total FROM p LEFT JOIN b USING (season, team, player) WHERE (p.season, p.team) IN (SELECT season, team FROM p WHERE pa > 90)")
def lu_candidates(t):
    p = as_positions(t)
    batting = p.where("position > 2").groupBy("season", "team", "player").agg(F.sum("pa").alias("total"))
    return L.candidates(p.drop("pa"), batting, p.where("pa > 90")).select("season", "team", "player", "position", "games", "total")


_MODAL = f"""{_POS}, q AS (SELECT season, team, player, CAST(sum(games) AS BIGINT) AS games, CAST(sum(pa) AS BIGINT) AS pa, arg_min(position, (-games, position)) AS position FROM p GROUP BY 1, 2, 3),
m AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY season, team ORDER BY games DESC, pa DESC, player) <= 9)"""


@probe("lu_modal", f"WITH {_MODAL} SELECT season, team, player, position, games, pa, CAST(row_number() OVER (PARTITION BY season, team ORDER BY position = 1, pa / games DESC, pa DESC, player) AS INTEGER) AS slot FROM m")
def lu_modal(t):
    return L.modal(as_positions(t)).select("season", "team", "player", "position", "games", "pa", "slot")


@probe("lu_order_by_rate", f"WITH {_MODAL} SELECT season, team, player, CAST(row_number() OVER (PARTITION BY season, team ORDER BY position = 1, pa / games DESC, pa DESC, player) AS INTEGER) AS slot FROM m")
def lu_order_by_rate(t):
    return L.order_by_rate(L.modal(as_positions(t)).drop("slot")).select("season", "team", "player", "slot")


@probe("lu_modal_repair")
def lu_modal_repair(t):
    p = as_positions(t)
    return L.modal_repair(L.modal(p), p)


def _lineups(t):
    """Repaired lineups, worked out once for all that read them."""
    return written(lu_modal_repair(t), "lineups")


_TARGETS = f"""{_POS}, b AS (SELECT *, games AS g, CAST(player % 5 + 1 AS INTEGER) AS batted, 4 AS sides FROM p), c AS (SELECT *, g * least(1.0, batted / sum(g) OVER (PARTITION BY season, team, player)) AS a FROM b),
x AS (SELECT *, a * least(1.0, sides / sum(a) OVER (PARTITION BY season, team, position)) AS target FROM c)"""


def _targets(t):
    p = as_positions(t).withColumns({"batted": (F.col("player") % 5 + 1).cast("int"), "sides": F.lit(4)})
    return L.rescale(p)


@probe("lu_rescale", f"WITH {_TARGETS} SELECT season, team, player, position, round(target, 5) AS target FROM x")
def lu_rescale(t):
    return _targets(t).select("season", "team", "player", "position", F.round("target", 5).alias("target"))


_STINTS = """s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey % 50 AS player, CAST(o_orderkey % 3 AS INTEGER) AS stint, count(*) AS games FROM orders GROUP BY 1, 2, 3),
d AS (SELECT season, day, CAST(row_number() OVER (PARTITION BY season ORDER BY day) AS INTEGER) AS i, CAST(count(*) OVER (PARTITION BY season) AS INTEGER) AS n FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderdate AS DATE) AS day FROM orders)),
c AS (SELECT s.*, n, least(n, CAST(floor((sum(games) OVER w - games) / sum(games) OVER v * n) AS INTEGER) + 1) AS a, greatest(1, CAST(floor(sum(games) OVER w / sum(games) OVER v * n) AS INTEGER)) AS b FROM s JOIN (SELECT DISTINCT season, n FROM d) USING (season) WINDOW w AS (PARTITION BY season, player ORDER BY stint), v AS (PARTITION BY season, player)),
w AS (SELECT c.season, c.player, c.stint, x.day AS from_date, greatest(x.day, y.day) AS to_date FROM c JOIN d x ON c.season = x.season AND c.a = x.i JOIN d y ON c.season = y.season AND c.b = y.i)"""


def _stints(t):
    o = t.orders.select(F.year("o_orderdate").alias("season"), (F.col("o_custkey") % 50).alias("player"), (F.col("o_orderkey") % 3).cast("int").alias("stint"), F.to_date("o_orderdate").alias("day"))
    return L.stint_windows(o.groupBy("season", "player", "stint").agg(F.count("*").alias("games")), o.select("season", "day"))


@probe("lu_stint_windows", f"WITH {_STINTS} SELECT * FROM w")
def lu_stint_windows(t):
    return _stints(t)


_TEAM = "CAST((o_custkey % 50 + {0} * 7) % 25 AS INTEGER)"
_MOVED = f"""ss AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey % 50 AS player, CAST(o_orderkey % 3 AS INTEGER) AS stint, {_TEAM.format("(o_orderkey % 3)")} AS team, count(*) AS games FROM orders GROUP BY 1, 2, 3, 4),
sd AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season, {_TEAM.format("(o_orderkey % 3)")} AS team, CAST(o_orderdate AS DATE) AS day FROM orders),
mv AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey % 50 AS player, CAST(o_orderdate AS DATE) AS day, o_orderkey AS seq, {_TEAM.format("(o_orderkey // 8 % 2)")} AS old, {_TEAM.format("(o_orderkey // 8 % 2 + 1)")} AS new FROM orders WHERE o_orderstatus = 'F'),
d AS (SELECT season, day, CAST(row_number() OVER (PARTITION BY season ORDER BY day) AS INTEGER) AS i, CAST(count(*) OVER (PARTITION BY season) AS INTEGER) AS n FROM (SELECT DISTINCT season, day FROM sd)),
c AS (SELECT ss.*, n, row_number() OVER w AS k, count(*) OVER v AS stints, lead(team) OVER w AS next_team, least(n, CAST(floor((sum(games) OVER w - games) / sum(games) OVER v * n) AS INTEGER) + 1) AS a, greatest(1, CAST(floor(sum(games) OVER w / sum(games) OVER v * n) AS INTEGER)) AS b FROM ss JOIN (SELECT DISTINCT season, n FROM d) USING (season) WINDOW w AS (PARTITION BY season, player ORDER BY stint), v AS (PARTITION BY season, player)),
m1 AS (SELECT c.season, c.player, min((day, seq)) AS at FROM c JOIN mv ON k = 1 AND c.season = mv.season AND c.player = mv.player AND team = old AND next_team = new GROUP BY ALL),
m2 AS (SELECT c.season, c.player, min((day, seq)) AS at FROM c JOIN m1 USING (season, player) JOIN mv ON k = 2 AND c.season = mv.season AND c.player = mv.player AND team = old AND next_team = new AND (day, seq) > m1.at GROUP BY ALL),
t AS (SELECT c.*, CASE k WHEN 2 THEN m1.at[1] WHEN 3 THEN m2.at[1] END AS since, CASE k WHEN stints THEN NULL WHEN 1 THEN m1.at[1] WHEN 2 THEN m2.at[1] END AS till, CASE stints WHEN 2 THEN m1.at IS NOT NULL WHEN 3 THEN m2.at IS NOT NULL ELSE false END AS told FROM c LEFT JOIN m1 USING (season, player) LEFT JOIN m2 USING (season, player)),
x1 AS (SELECT t.*, CASE WHEN since IS NULL THEN 1 ELSE (SELECT min(i) FROM d WHERE d.season = t.season AND d.day >= since) END AS ta, CASE WHEN till IS NULL THEN n ELSE (SELECT max(i) FROM d WHERE d.season = t.season AND d.day <= till) END AS tb FROM t),
near AS (SELECT t.season, t.player, t.stint, games, i, count(*) FILTER (WHERE i BETWEEN a AND b) OVER (PARTITION BY t.season, t.player, t.stint) AS inside, row_number() OVER (PARTITION BY t.season, t.player, t.stint ORDER BY abs(i - (a + b) // 2), i) AS place FROM t JOIN sd ON sd.season = t.season AND sd.team = t.team JOIN d ON d.season = sd.season AND d.day = sd.day WHERE NOT told AND stints > 1),
grown AS (SELECT season, player, stint, min(i) AS lo, max(i) AS hi FROM near WHERE inside < games AND place <= games GROUP BY ALL),
f AS (SELECT x1.season, x1.player, x1.stint, x1.team, CASE WHEN told THEN ta ELSE least(a, lo) END AS first, CASE WHEN told THEN greatest(ta, tb) ELSE greatest(b, hi) END AS last FROM x1 LEFT JOIN grown USING (season, player, stint))
SELECT f.season, f.player, f.stint, f.team, p.day AS from_date, greatest(p.day, q.day) AS to_date FROM f JOIN d p ON p.season = f.season AND p.i = first JOIN d q ON q.season = f.season AND q.i = last"""


@probe("lu_transferred_windows", f"WITH {_MOVED}")
def lu_transferred_windows(t):
    team = lambda k: ((F.col("o_custkey") % 50 + k * 7) % 25).cast("int")
    o = t.orders.select(F.year("o_orderdate").alias("season"), (F.col("o_custkey") % 50).alias("player"), (F.col("o_orderkey") % 3).cast("int").alias("stint"), team(F.col("o_orderkey") % 3).alias("team"), F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_custkey", "o_orderstatus")
    k = F.floor(F.col("o_orderkey") / 8) % 2
    moves = o.where("o_orderstatus = 'F'").select("season", "player", "day", F.col("o_orderkey").alias("seq"), team(k).alias("old"), team(k + 1).alias("new"))
    return L.transferred_windows(o.groupBy("season", "player", "stint", "team").agg(F.count("*").alias("games")), o.select("season", "team", "day"), moves)


_SIDES = "g AS (SELECT o_orderkey AS game, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderkey % 3 AS INTEGER) AS team, CAST(o_orderdate AS DATE) AS day, o_custkey % 50 AS pitcher FROM orders)"


@probe("lu_eligibility", f"WITH {_STINTS}, {_SIDES} SELECT game, season, team, player FROM g JOIN (SELECT season, stint AS team, player, from_date, to_date FROM w) USING (season, team) WHERE day BETWEEN from_date AND to_date AND player <> pitcher")
def lu_eligibility(t):
    sides = t.orders.select(F.col("o_orderkey").alias("game"), F.year("o_orderdate").alias("season"), (F.col("o_orderkey") % 3).cast("int").alias("team"), F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 50).alias("pitcher"))
    return L.eligibility(_stints(t).withColumnRenamed("stint", "team"), sides).select("game", "season", "team", "player")


def _sides(t):
    """Four games a team and season, three of them with a pitcher listed, who may be down elsewhere."""
    teams = as_positions(t).groupBy("season", "team").agg(F.min_by("player", F.struct(-F.col("games"), "player")).alias("pitcher"))
    game = F.explode(F.sequence(F.lit(1), F.lit(4)))
    return teams.withColumn("n", game).select((F.col("season") * 1000000 + F.col("team") * 10 + F.col("n")).alias("game"), "season", "team", F.when(F.col("n") > 1, F.col("pitcher")).alias("pitcher"))


def _assigned(t):
    targets = _targets(t).select("season", "team", "player", "position", "target")
    eligible = _sides(t).select("game", "season", "team").join(targets, ["season", "team"])
    outs = as_positions(t).groupBy("season", "team", "player").agg((27 * F.sum("games")).alias("outs"))
    return L.assign(eligible, _lineups(t), outs)


@probe("lu_assign")
def lu_assign(t):
    return _assigned(t)


@probe("lu_pitcher_slot")
def lu_pitcher_slot(t):
    return L.pitcher_slot(written(_assigned(t), "assigned"), _sides(t), as_positions(t))


@probe("lu_assign_report")
def lu_assign_report(t):
    """How far what was assigned is from the targets of the teams that have a lineup."""
    made = written(_assigned(t), "assigned")
    return L.report(_targets(t).join(made.select("season", "team").distinct(), ["season", "team"], "left_semi"), made)


_HALVES = f"""{_TARGETS}, a AS (SELECT season, team, player, position FROM p WHERE games > 1 UNION ALL SELECT season, team, player, position FROM p WHERE player % 2 = 0),
u AS (SELECT season, team, player, position, sum(target) AS actual FROM x GROUP BY ALL), r AS (SELECT season, team, player, position, count(*) AS realised FROM a GROUP BY ALL),
f AS (SELECT season, team, player, position, coalesce(actual, 0) AS actual, coalesce(realised, 0) AS realised FROM u FULL JOIN r USING (season, team, player, position))"""


@probe("lu_report", f"WITH {_HALVES} SELECT season, team, player, position, realised, round(realised - actual, 5) AS error, round(abs(realised - actual) / greatest(actual, 1.0), 5) AS pct_error FROM f")
def lu_report(t):
    p = as_positions(t)
    made = p.where("games > 1").select("season", "team", "player", "position").unionAll(p.where("player % 2 = 0").select("season", "team", "player", "position"))
    return L.report(_targets(t), made).select("season", "team", "player", "position", "realised", F.round("error", 5).alias("error"), F.round("pct_error", 5).alias("pct_error"))


@probe(
    "lu_backtest",
    f"""WITH {_POS}, g AS (SELECT 1 AS game, season, team, player, min(position) AS guessed FROM p WHERE player % 3 <> 0 GROUP BY ALL), r AS (SELECT 1 AS game, season, team, player, CAST(min(position) % 8 + min(player) % 2 AS INTEGER) AS real FROM p WHERE player % 4 <> 0 GROUP BY ALL)
SELECT season, count(*) FILTER (WHERE real IS NOT NULL AND guessed IS NULL) AS wrong_starters, count(*) FILTER (WHERE guessed <> real) AS wrong_positions, round(1 - count(*) FILTER (WHERE guessed IS NOT NULL AND real IS NOT NULL) / nullif(count(*) FILTER (WHERE real IS NOT NULL), 0), 6) AS set_miss_rate FROM g FULL JOIN r USING (game, season, team, player) GROUP BY 1""",
)
def lu_backtest(t):
    p = as_positions(t).groupBy(F.lit(1).alias("game"), "season", "team", "player").agg(F.min("position").alias("position"))
    truth = p.where("player % 4 <> 0").withColumn("position", (F.col("position") % 8 + F.col("player") % 2).cast("int"))
    out = L.backtest(p.where("player % 3 <> 0"), truth, ["season"])
    return out.select("season", "wrong_starters", "wrong_positions", F.round("set_miss_rate", 6).alias("set_miss_rate"))


_GROUPS = {1: "P", 2: "C", 3: "IF", 4: "IF", 5: "IF", 6: "IF", 7: "OF", 8: "OF", 9: "OF", 0: "DH"}
_NAMED = " ".join(f"WHEN {k} THEN '{v}'" for k, v in _GROUPS.items())


@probe(
    "lu_backtest_levels",
    f"""WITH {_POS}, g AS (SELECT season * 100 + games AS game, season, team, player, min(position) AS guessed FROM p WHERE player % 3 <> 0 GROUP BY ALL), r AS (SELECT season * 100 + games AS game, season, team, player, CAST(min(position) % 8 + min(player) % 2 AS INTEGER) AS real FROM p WHERE player % 4 <> 0 GROUP BY ALL),
b AS (SELECT * FROM g FULL JOIN r USING (game, season, team, player) WHERE coalesce(guessed, 0) <> 1 AND coalesce(real, 0) <> 1),
s AS (SELECT season, team, player, guessed AS position, 1 AS guessed, 0 AS real FROM b WHERE guessed IS NOT NULL UNION ALL SELECT season, team, player, real, 0, 1 FROM b WHERE real IS NOT NULL),
n AS (SELECT *, CASE position {_NAMED} END AS position_group FROM s),
l AS (SELECT season, team, sum(guessed) AS guessed, sum(real) AS real, CASE WHEN grouping(position) = 0 THEN 'position' WHEN grouping(position_group) = 0 THEN 'group' ELSE 'player' END AS level FROM n GROUP BY GROUPING SETS ((season, team, player), (season, team, player, position_group), (season, team, player, position))),
z AS (SELECT season, team, count(DISTINCT game) AS games FROM r GROUP BY ALL),
e AS (SELECT level, CAST(CASE WHEN season < 1992 THEN 0 WHEN season >= 2000 THEN 5 ELSE floor((season - 1992) / 2) + 1 END AS INTEGER) AS era, CAST(games >= 2 AS INTEGER) + CAST(games >= 4 AS INTEGER) AS size, guessed, real FROM l JOIN z USING (season, team))
SELECT level, era, size, CAST(sum(least(guessed, real)) AS BIGINT) AS matched, CAST(sum(real) AS BIGINT) AS real, round(1 - sum(least(guessed, real)) / nullif(sum(real), 0), 6) AS set_miss_rate FROM e GROUP BY 1, 2, 3""",
)
def lu_backtest_levels(t):
    p = as_positions(t).groupBy((F.col("season") * 100 + F.col("games")).alias("game"), "season", "team", "player").agg(F.min("position").alias("position"))
    truth = p.where("player % 4 <> 0").withColumn("position", (F.col("position") % 8 + F.col("player") % 2).cast("int"))
    out = L.backtest_levels(p.where("player % 3 <> 0"), truth, (1992, 2000, 4), [2, 4], _GROUPS)
    return out.withColumn("set_miss_rate", F.round("set_miss_rate", 6))


_STINT_ROWS = """(SELECT *, CAST(sum(games) OVER (PARTITION BY season, team, player) + player % 3 AS BIGINT) AS total FROM (
SELECT CAST(year(l_shipdate) AS INTEGER) AS season, l_suppkey % 10 AS team, l_partkey % 30 AS player, CAST(l_linenumber % 2 + 1 AS INTEGER) AS stint, CAST((l_partkey // 30 + l_linenumber) % 9 + 1 AS INTEGER) AS position, count(*) AS games, l_partkey % 30 % 7 + 3 AS batted, l_suppkey % 10 + 4 AS sides FROM lineitem GROUP BY ALL))"""


@probe(
    "lu_rescale_stints",
    f"""WITH a AS (SELECT *, sum(games) OVER s AS fielded, max(batted) OVER s AS b, max(total) OVER s AS whole FROM {_STINT_ROWS} WINDOW s AS (PARTITION BY season, team, player, stint)),
c AS (SELECT *, CASE WHEN fielded > b THEN games * b / fielded ELSE games END AS g, CASE WHEN fielded > b THEN b ELSE whole END AS own FROM a WHERE games > 0),
d AS (SELECT *, max(own) OVER p * sum(g) OVER s / sum(g) OVER p AS stint_total, sum(g) OVER q AS made FROM c WINDOW s AS (PARTITION BY season, team, player, stint), p AS (PARTITION BY season, team, player), q AS (PARTITION BY season, team, position))
SELECT season, team, player, stint, position, round(stint_total, 5) AS stint_total, round(CASE WHEN made > sides THEN g * sides / made ELSE g END, 5) AS target FROM d""",
)
def lu_rescale_stints(t):
    player = F.col("l_partkey") % 30
    keys = [F.year("l_shipdate").alias("season"), (F.col("l_suppkey") % 10).alias("team"), player.alias("player"), (F.col("l_linenumber") % 2 + 1).cast("int").alias("stint"), ((F.floor(F.col("l_partkey") / 30) + F.col("l_linenumber")) % 9 + 1).cast("int").alias("position")]
    rows = t.lineitem.groupBy(*keys).agg(F.count("*").alias("games"))
    whole = F.sum("games").over(Window.partitionBy("season", "team", "player"))
    out = L.rescale_stints(rows.withColumns({"batted": F.col("player") % 7 + 3, "total": whole + F.col("player") % 3, "sides": F.col("team") + 4}))
    return out.select("season", "team", "player", "stint", "position", F.round("stint_total", 5).alias("stint_total"), F.round("target", 5).alias("target"))


@probe("lu_lines", f"WITH {_MODAL} SELECT season, team, player, position, NULL::INTEGER AS hits, NULL::INTEGER AS runs FROM m")
def lu_lines(t):
    return L.lines(L.modal(as_positions(t)).select("season", "team", "player", "position"), ["hits", "runs"])


@probe(
    "agg_credit_split",
    f"""WITH p AS (SELECT *, CASE WHEN play % 5 = 0 THEN play % 4 ELSE holder END AS charged FROM ({AS_PLAYS})),
u AS (SELECT play, charged AS h, runs_on_play AS r, CASE WHEN charged <> holder THEN runs_on_play ELSE 0 END AS b, 0 AS i FROM p UNION ALL SELECT play, holder, 0, 0, runs_on_play FROM p WHERE charged <> holder)
SELECT play, h AS holder, CAST(sum(r) AS BIGINT) AS runs, CAST(sum(b) AS BIGINT) AS bequeathed, CAST(sum(i) AS BIGINT) AS inherited FROM u GROUP BY 1, 2""",
)
def agg_credit_split(t):
    charged = F.when(F.col("play") % 5 == 0, F.col("play") % 4).otherwise(F.col("holder"))
    return L.credit_split(as_plays(t), "play", "holder", charged, "runs_on_play")
