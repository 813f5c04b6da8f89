"""Queries for windows and estimators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import estimate as E
from ..operators import project as P
from ..operators import sets as S
from ..operators import windows as W
from .adapters import AS_PLAYS, AS_TEAM_GAMES, as_plays, as_team_games
from .registry import probe

U, O = ["user_id"], ["event_id"]
_DAY = "PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id"


def _days(t):
    return t.events.withColumn("day", F.to_date("ts"))


@probe("win_rest_of_group", f"SELECT event_id, count(*) FILTER (WHERE event_type = 'purchase') OVER ({_DAY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_over FROM events")
def win_rest_of_group(t):
    return _days(t).select("event_id", W.rest_of_group(P.flag(F.col("event_type") == "purchase"), [*U, "day"], O).alias("left_over"))


@probe("win_running_filtered", "SELECT event_id, CAST(coalesce(sum(k) FILTER (WHERE away) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS away_start, CAST(coalesce(sum(k) FILTER (WHERE away) OVER (w ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS away_end FROM (SELECT *, event_id % 5 AS k, event_id % 2 = 0 AS away FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def win_running_filtered(t):
    start, end = W.running_by_side(F.col("event_id") % 5, F.col("event_id") % 2 == 0, U, O)
    return t.events.select("event_id", start.alias("away_start"), end.alias("away_end"))


@probe("win_lag_lead", f"SELECT event_id, lag(event_type) OVER w AS before, lead(value) OVER w AS after, lag(event_id) OVER ({_DAY}) IS NULL AS first_of_day, lead(event_id) OVER ({_DAY}) IS NULL AS last_of_day FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def win_lag_lead(t):
    w, d = W.over(U, O), W.over([*U, "day"], O)
    return _days(t).select("event_id", F.lag("event_type").over(w).alias("before"), F.lead("value").over(w).alias("after"), F.lag("event_id").over(d).isNull().alias("first_of_day"), F.lead("event_id").over(d).isNull().alias("last_of_day"))


@probe("win_last_of_group", f"SELECT event_id, last_value(event_type) OVER ({_DAY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS outcome FROM events")
def win_last_of_group(t):
    return _days(t).select("event_id", W.last_of_group(F.col("event_type"), [*U, "day"], O).alias("outcome"))


_FFILL = "SELECT event_id, last_value(k IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS now, last_value(k IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT *, CASE WHEN event_type = 'signup' THEN event_id END AS k FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"


@probe("win_ffill", _FFILL)
def win_ffill(t):
    k = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return t.events.select("event_id", W.forward_fill(k, U, O).alias("now"), W.previous_known(k, U, O).alias("before"))


@probe("win_first_baseline", "WITH m AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, event_type, n - max(CASE WHEN event_type = 'view' THEN n END) OVER (PARTITION BY user_id) AS over_view FROM m")
def win_first_baseline(t):
    m = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return m.select("user_id", "event_type", (F.col("n") - F.max(F.when(F.col("event_type") == "view", F.col("n"))).over(W.over(U))).alias("over_view"))


@probe("win_ordinal", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS ordinal, date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), CAST(o_orderdate AS DATE)) AS rest FROM orders")
def win_ordinal(t):
    day = F.to_date("o_orderdate")
    rest = F.datediff(day, F.lag(day).over(W.over(["o_custkey"], ["o_orderdate", "o_orderkey"])))
    return t.orders.select("o_orderkey", F.count("*").over(W.over(["o_custkey"], ["o_orderdate"])).alias("ordinal"), rest.cast("long").alias("rest"))


_ISLANDS = """WITH c AS (SELECT event_id, user_id, event_type, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND lag(event_id) OVER w IS NOT NULL THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM c)
SELECT event_id, CAST(island AS BIGINT) AS island, CAST(row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) AS INTEGER) AS length FROM i"""


@probe("win_islands", _ISLANDS)
def win_islands(t):
    return W.islands(t.events, U, O, F.col("event_type")).select("event_id", "island", "length")


_STREAKS = f"""WITH g AS ({AS_TEAM_GAMES}), n AS (SELECT *, row_number() OVER (PARTITION BY team, season ORDER BY day, game) AS k, lag(win) OVER (PARTITION BY team, season ORDER BY day, game) AS was FROM g),
f AS (SELECT *, CASE WHEN win THEN last_value(CASE WHEN win AND NOT coalesce(was, false) THEN k END IGNORE NULLS) OVER (PARTITION BY team, season ORDER BY day, game ROWS UNBOUNDED PRECEDING) END AS streak_id FROM n)
SELECT game, CAST(streak_id AS INTEGER) AS streak_id, CAST(CASE WHEN win THEN row_number() OVER (PARTITION BY team, season, streak_id ORDER BY day, game) ELSE 0 END AS INTEGER) AS streak_length FROM f"""


@probe("win_streaks", _STREAKS)
def win_streaks(t):
    g = as_team_games(t).withColumn("k", F.row_number().over(W.over(["team", "season"], ["day", "game"])))
    return W.streaks(g, ["team", "season"], ["day", "game"], F.col("win"), "k").select("game", "streak_id", "streak_length")


_YEARLY = "y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS n FROM orders GROUP BY 1, 2)"


def _yearly(t):
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(F.count("*").alias("n"))


@probe("win_trailing_rows", f"WITH {_YEARLY} SELECT o_custkey, season, CAST(sum(n) OVER (PARTITION BY o_custkey ORDER BY season ROWS 2 PRECEDING) AS BIGINT) AS n3 FROM y")
def win_trailing_rows(t):
    return _yearly(t).select("o_custkey", "season", F.sum("n").over(W.over(["o_custkey"], ["season"], (-2, 0))).alias("n3"))


@probe("win_trailing_range", f"WITH {_YEARLY} SELECT o_custkey, season, CAST(sum(n) OVER (PARTITION BY o_custkey ORDER BY season RANGE 2 PRECEDING) AS BIGINT) AS n3 FROM y")
def win_trailing_range(t):
    return _yearly(t).select("o_custkey", "season", F.sum("n").over(W.over(["o_custkey"], ["season"], ranges=(-2, 0))).alias("n3"))


@probe("win_last_n", f"WITH g AS ({AS_TEAM_GAMES}), n AS (SELECT *, row_number() OVER (PARTITION BY team, season ORDER BY day, game) AS k FROM g) SELECT game, CAST(sum(CAST(win AS INTEGER)) OVER (PARTITION BY team, season ORDER BY k RANGE 9 PRECEDING) AS BIGINT) AS last_10 FROM n")
def win_last_n(t):
    g = as_team_games(t).withColumn("k", F.row_number().over(W.over(["team", "season"], ["day", "game"])))
    return g.select("game", F.sum(F.col("win").cast("int")).over(W.over(["team", "season"], ["k"], ranges=(-9, 0))).alias("last_10"))


@probe("win_next_start", "WITH r AS (SELECT user_id, event_id - event_id % 3 AS s, max(event_id + 10) AS e FROM events GROUP BY 1, 2) SELECT user_id, s, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY s) - 1, e) AS e FROM r")
def win_next_start(t):
    r = t.events.select("user_id", (F.col("event_id") - F.col("event_id") % 3).alias("s"), (F.col("event_id") + 10).alias("e"))
    return W.next_start(r, U, "s", "e")


@probe("win_share", "WITH g AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_returnflag, l_linestatus, round(n / sum(n) OVER (PARTITION BY l_returnflag), 6) AS share, round(n / sum(n) OVER (), 6) AS of_all FROM g")
def win_share(t):
    g = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return W.grand_share(g, "n", "of_all").select("l_returnflag", "l_linestatus", F.round(W.share(F.col("n"), ["l_returnflag"]), 6).alias("share"), F.round("of_all", 6).alias("of_all"))


@probe("win_multi_grain", "SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS narrow, count(*) OVER (PARTITION BY l_suppkey) AS broad FROM lineitem")
def win_multi_grain(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.count("*").over(W.over(["l_suppkey", "l_returnflag"])).alias("narrow"), F.count("*").over(W.over(["l_suppkey"])).alias("broad"))


@probe("win_baseline_residual", "WITH r AS (SELECT event_id, event_type, user_id, value - avg(value) OVER (PARTITION BY user_id) AS r FROM events) SELECT event_id, round(r - avg(r) OVER (PARTITION BY event_type), 4) AS residual FROM r")
def win_baseline_residual(t):
    r = t.events.withColumn("r", F.col("value") - F.avg("value").over(W.over(U)))
    return r.select("event_id", F.round(F.col("r") - F.avg("r").over(W.over(["event_type"])), 4).alias("residual"))


@probe("win_rownum_dedupe", "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) = 1")
def win_rownum_dedupe(t):
    return W.dedupe(t.events, ["user_id", "event_type"], [F.desc("value"), "event_id"]).select("user_id", "event_type", "event_id")


@probe("win_drop_ambiguous", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1")
def win_drop_ambiguous(t):
    return W.drop_ambiguous(t.lineitem, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


@probe("win_min_support", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) > 5")
def win_min_support(t):
    return W.min_support(t.lineitem, ["l_orderkey"], 5).select("l_orderkey", "l_linenumber", "l_partkey")


@probe("win_rownum_key", "SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS k FROM customer")
def win_rownum_key(t):
    return W.row_numbers(t.customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"], "k").select("c_custkey", "k")


@probe("win_is_last", "SELECT conv_id, turn, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last FROM conversations")
def win_is_last(t):
    return t.conversations.select("conv_id", "turn", (F.col("turn") == F.max("turn").over(W.over(["conv_id"]))).alias("is_last"))


_RECORD = f"r AS (SELECT team, season, league, count(*) FILTER (WHERE win) AS w, count(*) FILTER (WHERE NOT win) AS l FROM ({AS_TEAM_GAMES}) GROUP BY 1, 2, 3)"


def _record(t):
    return as_team_games(t).groupBy("team", "season", "league").agg(F.count_if("win").alias("w"), F.count_if(~F.col("win")).alias("l"))


@probe("win_leader_gap", f"WITH {_RECORD} SELECT team, season, league, first_value(team) OVER (PARTITION BY season, league ORDER BY w - l DESC, team) AS leader, greatest(0.0, (max(w - l) OVER (PARTITION BY season, league) - (w - l)) / 2) AS games_behind FROM r")
def win_leader_gap(t):
    return W.leader_gap(_record(t), ["season", "league"], "w", "l", "team").select("team", "season", "league", "leader", "games_behind")


@probe("win_chain_groups", "WITH n AS (SELECT event_id, user_id, event_type, sum(CAST(event_type = 'purchase' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n FROM events) SELECT event_id, CAST(lag(n, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS chain FROM n")
def win_chain_groups(t):
    return W.chain_groups(t.events, U, O, F.col("event_type") == "purchase").select("event_id", "chain")


_SPELL_ROWS = "s AS (SELECT event_id, user_id AS g, event_id // 7 % 4 AS holder, 0 AS starter, CAST(event_id % 11 - 7 AS INTEGER) AS m0, CAST((event_id * 3) % 11 - 7 AS INTEGER) AS m1, CAST(event_id % 28 AS INTEGER) AS outs, CAST(event_id % 4 AS INTEGER) AS runners FROM events)"
_SPELLS = f"""WITH {_SPELL_ROWS}, a AS (SELECT *, lag(holder) OVER w AS p, lead(holder) OVER w AS x, lead(runners) OVER w AS xr FROM s WINDOW w AS (PARTITION BY g ORDER BY event_id)),
b AS (SELECT *, p IS NULL OR p <> holder AS entered, x IS NOT NULL AND x <> holder AS exited, x IS NULL AS finished FROM a),
c AS (SELECT *, entered AND holder <> starter AND NOT (coalesce(p = starter, false) AND outs < 15) AND m0 < 0 AS relief FROM b),
d AS (SELECT *, relief AND m0 >= -3 AND (outs <= 24 OR outs % 3 = 0) OR relief AND m0 >= -5 AND m0 + runners + 2 >= 0 AS sit, CASE WHEN relief THEN outs <= 18 END AS lng FROM c),
e AS (SELECT *, last_value(CASE WHEN entered THEN sit END IGNORE NULLS) OVER v AS s1, last_value(CASE WHEN entered THEN lng END IGNORE NULLS) OVER v AS l1, last_value(CASE WHEN entered THEN sit OR coalesce(lng, false) END IGNORE NULLS) OVER v AS e1 FROM d WINDOW v AS (PARTITION BY g, holder ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, lag(s1) OVER v AS s2, lag(l1) OVER v AS l2, lag(e1) OVER v AS e2, lag(m1) OVER v AS pm FROM e WINDOW v AS (PARTITION BY g, holder ORDER BY event_id))
SELECT event_id, CASE WHEN entered THEN runners ELSE 0 END AS inherited, CASE WHEN exited THEN xr ELSE 0 END AS left_over, coalesce(s2 AND exited AND m1 < 0, false) AS hold, coalesce(e2 AND finished AND m1 < 0, false) AS save,
  coalesce(e2 AND m1 >= 0 AND NOT coalesce(pm >= 0, false), false) AS blown, coalesce(l2 AND NOT s2 AND m1 >= 0 AND NOT coalesce(pm >= 0, false), false) AS blown_long FROM f"""


@probe("win_spell_state", _SPELLS)
def win_spell_state(t):
    e = F.col("event_id")
    rows = t.events.select("event_id", F.col("user_id").alias("g"), (F.floor(e / 7) % 4).alias("holder"), F.lit(0).alias("starter"), (e % 11 - 7).cast("int").alias("m0"), ((e * 3) % 11 - 7).cast("int").alias("m1"), (e % 28).cast("int").alias("outs"), (e % 4).cast("int").alias("runners"))
    out = W.spells(rows, ["g"], "event_id", "holder", "starter", "m0", "m1", "outs", "runners")
    return out.select("event_id", "inherited", "left_over", "hold", "save", "blown", "blown_long")


@probe("win_mean_one", "WITH w AS (SELECT event_id, 1.0 / count(*) OVER (PARTITION BY event_type) AS w FROM events) SELECT event_id, round(w / (SELECT avg(w) FROM w), 6) AS weight FROM w")
def win_mean_one(t):
    w = t.events.withColumn("w", 1.0 / F.count("*").over(W.over(["event_type"])))
    return W.mean_one(w, "w", "weight").select("event_id", F.round("weight", 6).alias("weight"))


# Estimators

_REST = f"p AS (SELECT *, sum(runs_on_play) OVER (PARTITION BY game, inning ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, count(*) OVER (PARTITION BY game, inning) AS n FROM ({AS_PLAYS}))"


def _rest(t):
    p = as_plays(t)
    return p.withColumns({"rest": W.rest_of_group(F.col("runs_on_play"), ["game", "inning"], O), "n": F.count("*").over(W.over(["game", "inning"]))})


@probe("est_run_matrix", f"WITH {_REST} SELECT base_state, outs, round(avg(rest), 6) AS mean, round(var_samp(rest), 6) AS variance, count(*) AS n FROM p WHERE n > 1 GROUP BY 1, 2")
def est_run_matrix(t):
    return E.state_matrix(_rest(t), ["base_state", "outs"], F.col("rest"), F.col("n") > 1).select("base_state", "outs", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"), "n")


_WINS = f"o AS (SELECT *, last_value(away) OVER (PARTITION BY game ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS won, CAST(base_state > 0 AS INTEGER) AS any_on FROM ({AS_PLAYS}))"


@probe("est_win_matrix", f"WITH {_WINS}, f AS (SELECT inning, outs, base_state, any_on, sum(CAST(won AS INTEGER)) AS s, count(*) AS n FROM o GROUP BY ALL), b AS (SELECT inning, any_on, sum(s) / sum(n) AS r FROM f GROUP BY ALL) SELECT inning, outs, base_state, any_on, n, round((s + r * 10) / (n + 10), 6) AS rate FROM f JOIN b USING (inning, any_on)")
def est_win_matrix(t):
    o = as_plays(t).withColumns({"won": W.last_of_group(F.col("away"), ["game"], O), "any_on": P.flag(F.col("base_state") > 0)})
    out = E.shrunken_rates(o, ["inning", "outs", "base_state"], ["inning", "any_on"], F.col("won"))
    return out.select("inning", "outs", "base_state", "any_on", "n", F.round("rate", 6).alias("rate"))


_TRANS = f"""{_REST}, m AS (SELECT base_state, avg(rest) AS v FROM p GROUP BY 1), x AS (SELECT event_id, base_state AS s0, lead(base_state) OVER (PARTITION BY game, inning ORDER BY event_id) AS s1, runs_on_play FROM p),
c AS (SELECT event_id, s0, s1, runs_on_play + coalesce(b.v, 0) - a.v AS change FROM x LEFT JOIN m a ON s0 = a.base_state LEFT JOIN m b ON s1 = b.base_state)"""


def _changes(t):
    p = _rest(t)
    m = E.state_matrix(p, ["base_state"], F.col("rest"))
    x = p.select("event_id", F.col("base_state").alias("s0"), F.lead("base_state").over(W.over(["game", "inning"], O)).alias("s1"), "runs_on_play")
    return E.transition_values(x, m, "base_state", "s0", "s1", F.col("runs_on_play"))


@probe("est_transition_value", f"WITH {_TRANS} SELECT event_id, round(change, 6) AS change FROM c")
def est_transition_value(t):
    return _changes(t).select("event_id", F.round("change", 6).alias("change"))


@probe("est_leverage", f"WITH {_TRANS}, q AS (SELECT s0, s1, avg(abs(change)) AS m, count(*) AS k FROM c GROUP BY 1, 2), s AS (SELECT s0, sum(m * k) / sum(k) AS swing, CAST(sum(k) AS BIGINT) AS n FROM q GROUP BY 1) SELECT s0, round(swing, 6) AS swing, n, round(swing / (SELECT sum(swing * n) / sum(n) FROM s), 6) AS leverage FROM s")
def est_leverage(t):
    return E.leverage(_changes(t), "s0", "s1", F.col("change")).select("s0", F.round("swing", 6).alias("swing"), "n", F.round("leverage", 6).alias("leverage"))


@probe(
    "est_linear_weights",
    """WITH e AS (SELECT CAST(day(ts) // 8 AS INTEGER) AS week, event_type AS play, value FROM events), o AS (SELECT week, play, avg(value) AS v FROM e GROUP BY 1, 2 HAVING count(*) > 100), a AS (SELECT play, avg(value) AS v FROM e GROUP BY 1), m AS (SELECT week, avg(value) AS v FROM e GROUP BY 1),
g AS (SELECT m.week, a.play, o.v IS NULL AS imputed, coalesce(o.v, a.v) - m.v AS weight FROM m CROSS JOIN a LEFT JOIN o ON o.week = m.week AND o.play = a.play)
SELECT week, play, imputed, round(weight, 5) AS weight, round(weight - max(CASE WHEN play = 'view' THEN weight END) OVER (PARTITION BY week), 5) AS relative FROM g""",
)
def est_linear_weights(t):
    e = t.events.select(F.floor(F.dayofmonth("ts") / 8).cast("int").alias("week"), F.col("event_type").alias("play"), "value")
    return E.linear_weights(e, "week", "play", "value", 100, "view").select("week", "play", "imputed", F.round("weight", 5).alias("weight"), F.round("relative", 5).alias("relative"))


@probe("est_unknown_shares", "WITH r AS (SELECT l_suppkey AS unit, l_linenumber AS role, count(*) - 10.0 AS surplus, (l_linenumber + 1) / 10.0 AS rate FROM lineitem GROUP BY 1, 2), e AS (SELECT *, greatest(0.0, surplus) * rate AS e FROM r) SELECT unit, role, round(e / nullif(sum(e) OVER (PARTITION BY unit), 0), 6) AS share FROM e QUALIFY e > 0")
def est_unknown_shares(t):
    r = t.lineitem.groupBy(F.col("l_suppkey").alias("unit"), F.col("l_linenumber").alias("role")).agg((F.count("*") - 10.0).alias("surplus")).withColumn("rate", (F.col("role") + 1) / 10.0)
    return E.unknown_shares(r, "unit", "role", "surplus", "rate").select("unit", "role", F.round("share", 6).alias("share"))


_UNITS = "u AS (SELECT l_suppkey % 5 AS team, CAST(year(l_shipdate) AS INTEGER) AS season, l_partkey % 4 AS unit, count(*) FILTER (WHERE l_returnflag = 'R') AS v, count(*) AS s FROM lineitem GROUP BY 1, 2, 3)"


def _units(t):
    return t.lineitem.groupBy((F.col("l_suppkey") % 5).alias("team"), F.year("l_shipdate").alias("season"), (F.col("l_partkey") % 4).alias("unit")).agg(F.count_if(F.col("l_returnflag") == "R").alias("v"), F.count("*").alias("s"))


_BASIC = f"""{_UNITS}, r AS (SELECT team, season, unit, sum(v) OVER w AS v, sum(s) OVER w AS s FROM u WINDOW w AS (PARTITION BY team, unit ORDER BY season ROWS 2 PRECEDING)), q AS (SELECT *, greatest(0.1, least(1.0, v / s)) AS rate FROM r),
basic AS (SELECT a.unit, a.season, sum(a.rate * sqrt(least(a.s, b.s))) / sum(b.rate * sqrt(least(a.s, b.s))) AS factor FROM q a JOIN q b ON a.team = b.team AND a.season = b.season AND a.unit <> b.unit GROUP BY 1, 2)"""


@probe("est_factor_basic", f"WITH {_BASIC} SELECT unit, season, round(factor, 5) AS factor FROM basic")
def est_factor_basic(t):
    return E.factor_basic(_units(t), ["team"], "unit", "season", "v", "s").select("unit", "season", F.round("factor", 5).alias("factor"))


def _variant_sql(odds: bool) -> str:
    a, b = "sum(a.v / a.s * w) / sum(w)", "sum(bv / bs * w) / sum(w)"
    ratio = "round((a / (1 - a)) / (b / (1 - b)), 2)" if odds else "round(a / b, 2)"
    return f"""WITH {_UNITS}, ok AS (SELECT unit, season FROM u GROUP BY 1, 2 HAVING sum(s) > 25),
o AS (SELECT CAST(team AS VARCHAR) AS team, season, unit, CAST(sum(v) OVER w AS DOUBLE) AS v, CAST(sum(s) OVER w AS DOUBLE) AS s FROM u JOIN ok USING (unit, season) WINDOW w AS (PARTITION BY team, unit ORDER BY season RANGE 2 PRECEDING)),
m AS (SELECT season, sum(v) / sum(s) AS r FROM u GROUP BY 1), e AS (SELECT * FROM o UNION ALL SELECT 'prior', season, unit, r * 1000.0, 1000.0 FROM ok JOIN m USING (season)),
p AS (SELECT a.unit, a.season, a.v, a.s, b.unit AS other, b.v AS bv, b.s AS bs, least(a.s, b.s) AS w0 FROM e a JOIN e b ON a.team = b.team AND a.season = b.season AND a.unit <> b.unit),
k AS (SELECT *, sum(w0) OVER (PARTITION BY unit, season, other) AS own FROM p), n AS (SELECT *, w0 * max(own) OVER (PARTITION BY unit, season) / own AS w FROM k),
f AS (SELECT unit, season, {a.replace("a.v", "v").replace("a.s", "s")} AS a, {b} AS b FROM n a GROUP BY 1, 2)
SELECT unit, season, {ratio} AS v_factor FROM f"""


@probe("est_factor_advanced", _variant_sql(True))
def est_factor_advanced(t):
    return E.factor_variant(_units(t), ["team"], "unit", "season", ["v"], "s")


@probe("est_factor_variant", _variant_sql(False))
def est_factor_variant(t):
    return E.factor_variant(_units(t), ["team"], "unit", "season", ["v"], "s", odds=False)


@probe("est_factor_merge", f"WITH {_BASIC}, advanced AS ({_variant_sql(True)}) SELECT unit, season, coalesce(CASE WHEN unit % 2 = 0 THEN v_factor END, round(factor, 5)) AS factor FROM basic LEFT JOIN advanced USING (unit, season)")
def est_factor_merge(t):
    """The advanced factor of the units that have one here (the even ones), and the basic one of the rest."""
    basic = E.factor_basic(_units(t), ["team"], "unit", "season", "v", "s").select("unit", "season", F.round("factor", 5).alias("factor"))
    advanced = E.factor_variant(_units(t), ["team"], "unit", "season", ["v"], "s").where("unit % 2 = 0").select("unit", "season", F.col("v_factor").alias("factor"))
    return E.factor_merge(advanced, basic, ["unit", "season"], "factor")


@probe("est_share_chain", "WITH a AS (SELECT user_id, day(ts) AS place, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT day(ts) AS place, count(*) AS m, count(*) FILTER (WHERE event_type = 'error') AS h FROM events GROUP BY 1) SELECT user_id, round(sum(n / m * h / (SELECT sum(h) FROM p)), 6) AS blame FROM a JOIN p USING (place) GROUP BY 1")
def est_share_chain(t):
    return E.share_chain(t.events.withColumn("place", F.dayofmonth("ts")), "user_id", "place", F.col("event_type") == "error").select("user_id", F.round("blame", 6).alias("blame"))


@probe("est_pythagorean", "SELECT c_custkey, round(pow(abs(c_acctbal), 1.85) / (pow(abs(c_acctbal), 1.85) + pow(4000.0, 1.85)), 6) AS expected FROM customer")
def est_pythagorean(t):
    return t.customer.select("c_custkey", F.round(E.pythagorean(F.abs("c_acctbal"), F.lit(4000.0)), 6).alias("expected"))


@probe(
    "est_standings",
    f"""WITH g AS ({AS_TEAM_GAMES}), s AS (SELECT season, team, league, CAST(unnest(generate_series(min(day) - 1, max(day) + 1, INTERVAL 1 DAY)) AS DATE) AS day FROM g GROUP BY 1, 2, 3),
d AS (SELECT season, team, league, day, sum(CAST(win AS INTEGER)) AS w, sum(CAST(NOT win AS INTEGER)) AS l FROM g GROUP BY 1, 2, 3, 4),
c AS (SELECT s.season, s.team, s.league, s.day, CAST(sum(coalesce(w, 0)) OVER o AS BIGINT) AS w, CAST(sum(coalesce(l, 0)) OVER o AS BIGINT) AS l FROM s LEFT JOIN d USING (season, team, league, day) WINDOW o AS (PARTITION BY s.season, s.team, s.league ORDER BY s.day)),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY season, team, league ORDER BY day, game) AS INTEGER) AS k, lag(win) OVER (PARTITION BY season, team, league ORDER BY day, game) AS was FROM g),
i AS (SELECT *, sum(CASE WHEN was IS NULL OR was <> win THEN 1 ELSE 0 END) OVER (PARTITION BY season, team, league ORDER BY k) AS run FROM n),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY season, team, league, run ORDER BY k) AS INTEGER) * CASE WHEN win THEN 1 ELSE -1 END AS streak, CAST(sum(CAST(win AS INTEGER)) OVER (PARTITION BY season, team, league ORDER BY k ROWS 9 PRECEDING) AS BIGINT) AS last_10 FROM i),
f AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY season, team, league, day ORDER BY k DESC) = 1),
t AS (SELECT c.*, last_value(f.streak IGNORE NULLS) OVER v AS streak, last_value(f.last_10 IGNORE NULLS) OVER v AS last_10 FROM c LEFT JOIN f USING (season, team, league, day) WINDOW v AS (PARTITION BY c.season, c.team, c.league ORDER BY c.day ROWS UNBOUNDED PRECEDING))
SELECT season, team, league, day, w, l, streak, last_10, first_value(team) OVER (PARTITION BY season, league, day ORDER BY w - l DESC, team) AS leader, greatest(0.0, (max(w - l) OVER (PARTITION BY season, league, day) - (w - l)) / 2) AS games_behind FROM t""",
)
def est_standings(t):
    keys = ["season", "team", "league"]
    return E.standings(as_team_games(t), keys, ["season", "league"], "day", "game", "win", "team")
