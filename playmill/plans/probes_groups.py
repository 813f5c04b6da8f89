"""Queries for aggregations, set operations, measures and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import metrics as M
from ..operators import project as P
from ..operators import quality as Q
from ..operators import sets as S
from .registry import probe

# Aggregations


@probe("agg_sum_list", "SELECT l_suppkey, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice, round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax FROM lineitem GROUP BY 1")
def agg_sum_list(t):
    stats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return A.rollup_sum(t.lineitem, ["l_suppkey"], stats).select("l_suppkey", *[F.round(c, 2).alias(c) for c in stats])


@probe("agg_list_derivation", "SELECT l_returnflag, round(sum(l_tax), 2) AS l_tax, round(sum(l_quantity), 2) AS l_quantity FROM lineitem GROUP BY 1")
def agg_list_derivation(t):
    stats = A.derive_stats(["l_quantity", "l_extendedprice"], ["l_tax"], ["l_extendedprice"])
    return A.rollup_sum(t.lineitem, ["l_returnflag"], stats).select("l_returnflag", *[F.round(c, 2).alias(c) for c in stats])


@probe("agg_redefine_up", "SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS n, CAST(sum(o_totalprice) > 2000000 AS INTEGER) AS large FROM orders GROUP BY 1")
def agg_redefine_up(t):
    df = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"), F.count("*").alias("n"), F.lit(0).alias("large"))
    return A.redefine(df, {"total": F.round("s", 2), "large": P.flag(F.col("s") > 2000000)}).drop("s")


TYPES = ["click", "error", "purchase", "signup", "view"]


@probe("agg_filter_counts", "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{v}') AS n_{v}" for v in TYPES) + ", count(*) FILTER (WHERE value > 50) AS n_large FROM events GROUP BY 1")
def agg_filter_counts(t):
    return t.events.groupBy("user_id").agg(*A.filter_counts({f"n_{v}": F.col("event_type") == v for v in TYPES} | {"n_large": F.col("value") > 50}))


@probe("agg_bool", "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned, bool_and(l_quantity > 10) AS all_large, count(*) FILTER (WHERE l_tax = 0) AS untaxed FROM lineitem GROUP BY 1")
def agg_bool(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"), F.bool_and(F.col("l_quantity") > 10).alias("all_large"), F.count_if(F.col("l_tax") == 0).alias("untaxed"))


@probe("agg_any_value", "SELECT c_custkey, any_value(c_name) AS c_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def agg_any_value(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey").agg(F.any_value("c_name").alias("c_name"), F.count("*").alias("n"))


@probe("agg_min_ids", "SELECT l_orderkey, min(l_partkey) AS part, min(l_suppkey) AS supplier FROM lineitem GROUP BY 1")
def agg_min_ids(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supplier"))


@probe("agg_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts FROM lineitem GROUP BY 1")
def agg_distinct(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("returned_parts"))


@probe("agg_dedupe", "SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id FROM events ORDER BY user_id, event_type, value DESC, event_id")
def agg_dedupe(t):
    return S.topk_group(t.events, ["user_id", "event_type"], [F.desc("value"), "event_id"], 1).select("user_id", "event_type", "event_id")


@probe("agg_pivot_first", "SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{v}' THEN event_id END) AS last_{v}" for v in TYPES) + " FROM events GROUP BY 1")
def agg_pivot_first(t):
    return t.events.groupBy("user_id").agg(*A.first_where(F.col("event_type"), TYPES, F.col("event_id"), "last"))


@probe("agg_ordered_list", "SELECT conv_id, list(role ORDER BY turn) AS roles FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) GROUP BY 1")
def agg_ordered_list(t):
    return t.conversations.select("conv_id", "turn", "role").distinct().groupBy("conv_id").agg(A.ordered_list(F.col("role"), F.col("turn"), F.col("role")).alias("roles"))


@probe("agg_ordered_string", "SELECT user_id, CAST(ts AS DATE) AS day, string_agg(CASE WHEN event_id % 20 > 9 THEN '(' || event_id % 20 || ')' ELSE CAST(event_id % 20 AS VARCHAR) END, '' ORDER BY event_id) AS score FROM events GROUP BY 1, 2")
def agg_ordered_string(t):
    m = F.col("event_id") % 20
    cell = F.when(m > 9, F.concat(F.lit("("), m.cast("string"), F.lit(")"))).otherwise(m.cast("string"))
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(A.ordered_text(cell, F.col("event_id")).alias("score"))


@probe("agg_map_build", "SELECT conv_id, CAST(cardinality(m) AS BIGINT) AS n, m[1] AS second FROM (SELECT conv_id, map(list(turn ORDER BY turn), list(role ORDER BY turn)) AS m FROM (SELECT conv_id, turn, min(role) AS role FROM conversations GROUP BY 1, 2) GROUP BY 1)")
def agg_map_build(t):
    one = t.conversations.groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    m = one.groupBy("conv_id").agg(A.ordered_map(F.col("turn"), F.col("role")).alias("m"))
    return m.select("conv_id", F.size("m").cast("long").alias("n"), F.try_element_at("m", F.lit(1).cast("long")).alias("second"))


@probe("agg_min_by", "SELECT user_id, arg_min(event_type, (value, event_id)) AS kind FROM events GROUP BY 1")
def agg_min_by(t):
    return t.events.groupBy("user_id").agg(F.min_by("event_type", F.struct("value", "event_id")).alias("kind"))


@probe("agg_mode", "SELECT user_id, event_type FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1")
def agg_mode(t):
    return A.mode(t.events, ["user_id"], "event_type")


@probe("agg_null_poison", "SELECT c_nationkey, CASE WHEN NOT bool_or(c_acctbal < -900) THEN round(sum(c_acctbal), 2) END AS total FROM customer GROUP BY 1")
def agg_null_poison(t):
    return t.customer.groupBy("c_nationkey").agg(F.round(A.strict_sum(F.when(F.col("c_acctbal") >= -900, F.col("c_acctbal"))), 2).alias("total"))


@probe("agg_stats", "SELECT l_suppkey, round(var_samp(l_quantity), 5) AS vs, round(stddev_samp(l_quantity), 5) AS sd, round(var_pop(l_discount), 7) AS vp, round(avg(l_tax), 6) AS a, round(corr(l_quantity, l_extendedprice), 5) AS c, round(regr_r2(l_extendedprice, l_quantity), 5) AS r2 FROM lineitem GROUP BY 1 HAVING count(*) > 2")
def agg_stats(t):
    q, x = F.col("l_quantity"), F.col("l_extendedprice")
    out = t.lineitem.groupBy("l_suppkey").agg(F.round(F.var_samp(q), 5).alias("vs"), F.round(F.stddev_samp(q), 5).alias("sd"), F.round(F.var_pop("l_discount"), 7).alias("vp"), F.round(F.avg("l_tax"), 6).alias("a"), F.round(F.corr(q, x), 5).alias("c"), F.round(F.regr_r2(x, q), 5).alias("r2"), F.count("*").alias("n"))
    return out.where("n > 2").drop("n")


@probe("agg_weighted_mean", "SELECT l_suppkey, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 4) AS price FROM lineitem GROUP BY 1")
def agg_weighted_mean(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(A.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")), 4).alias("price"))


@probe("agg_rate_table", "SELECT CAST(year(l_shipdate) AS INTEGER) AS y, round(count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity > 25) / nullif(count(*) FILTER (WHERE l_quantity > 25), 0), 6) AS large_returned, round(count(*) FILTER (WHERE l_returnflag = 'R' AND l_tax = 0) / nullif(count(*) FILTER (WHERE l_tax = 0), 0), 6) AS untaxed_returned FROM lineitem GROUP BY 1")
def agg_rate_table(t):
    r, big, free = P.flag(F.col("l_returnflag") == "R"), P.flag(F.col("l_quantity") > 25), P.flag(F.col("l_tax") == 0)
    return t.lineitem.groupBy(F.year("l_shipdate").alias("y")).agg(F.round(A.rate(r, big), 6).alias("large_returned"), F.round(A.rate(r, free), 6).alias("untaxed_returned"))


@probe("agg_coverage_tier", "SELECT o_custkey, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'finished' WHEN bool_and(o_orderstatus <> 'P') THEN 'known' ELSE 'mixed' END AS tier FROM orders GROUP BY 1")
def agg_coverage_tier(t):
    s = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(A.coverage_tier([("finished", s == "F"), ("known", s != "P")], "mixed").alias("tier"))


@probe("agg_single_member", "SELECT CAST(o_orderdate AS DATE) AS day, o_custkey % 20 AS g, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2 HAVING count(*) = 1")
def agg_single_member(t):
    return A.single_member(t.orders.withColumns({"day": F.to_date("o_orderdate"), "g": F.col("o_custkey") % 20}), ["day", "g"], ["o_orderkey"])


@probe("agg_decade_bucket", "SELECT CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade, count(*) AS n FROM orders GROUP BY 1")
def agg_decade_bucket(t):
    return t.orders.groupBy(A.decade(F.year("o_orderdate")).alias("decade")).agg(F.count("*").alias("n"))


@probe("agg_union_accounts", "SELECT k, round(sum(total), 2) AS total, CAST(sum(n) AS BIGINT) AS n FROM (SELECT o_custkey AS k, o_totalprice AS total, NULL AS n FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_custkey, l_extendedprice, 1 FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey % 2 = 1) GROUP BY 1")
def agg_union_accounts(t):
    even = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("total"))
    odd = t.orders.where("o_orderkey % 2 = 1").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("k"), F.col("l_extendedprice").alias("total"), F.lit(1).alias("n"))
    return A.union_accounts([even, odd], ["k"], ["total", "n"]).select("k", F.round("total", 2).alias("total"), "n")


@probe("agg_derived_awards", "SELECT o_orderkey, CAST(n = 1 AS INTEGER) AS complete, CAST(o_totalprice = m AS INTEGER) AS best FROM (SELECT *, count(*) OVER w AS n, max(o_totalprice) OVER w AS m FROM orders WINDOW w AS (PARTITION BY o_custkey, year(o_orderdate)))")
def agg_derived_awards(t):
    per = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("m"))
    joined = t.orders.withColumn("y", F.year("o_orderdate")).join(per, ["o_custkey", "y"])
    return joined.select("o_orderkey", P.flag(F.col("n") == 1).alias("complete"), P.flag(F.col("o_totalprice") == F.col("m")).alias("best"))


# Set operations and table functions


@probe("srt_order", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS b FROM customer ORDER BY b DESC NULLS LAST, c_custkey")
def srt_order(t):
    return S.ordered(t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("b")), F.col("b").desc_nulls_last(), F.col("c_custkey"))


@probe("srt_topk_group", "SELECT p_brand, p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rank FROM part QUALIFY rank <= 3")
def srt_topk_group(t):
    return S.topk_group(t.part, ["p_brand"], [F.desc("p_retailprice"), "p_partkey"], 3).select("p_brand", "p_partkey", "rank")


@probe("srt_topk_global", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def srt_topk_global(t):
    return S.topk(t.customer.select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), "c_custkey"], 10)


@probe("srt_shuffle", "SELECT event_id FROM events")
def srt_shuffle(t):
    return S.shuffled(t.events.select("event_id"), ["event_id"])


@probe("set_union_all", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def set_union_all(t):
    o = t.orders.select("o_orderkey", "o_totalprice")
    return t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice").union(o.where("o_totalprice > 100000"))


@probe("set_union_by_name", "SELECT o_orderkey AS k, o_totalprice AS total, NULL::DOUBLE AS quantity FROM orders UNION ALL SELECT l_orderkey, NULL, l_quantity FROM lineitem")
def set_union_by_name(t):
    return t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("total")).unionByName(t.lineitem.select(F.col("l_quantity").alias("quantity"), F.col("l_orderkey").alias("k")), allowMissingColumns=True)


@probe("set_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@probe("set_two_perspectives", "SELECT l_orderkey, l_linenumber, l_suppkey AS own, l_partkey AS opponent, 'supplier' AS side FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'part' FROM lineitem")
def set_two_perspectives(t):
    li = t.lineitem.withColumns({"s": F.lit("supplier"), "p": F.lit("part")})
    return S.two_perspectives(li, ["l_orderkey", "l_linenumber"], {"l_suppkey": "own", "l_partkey": "opponent", "s": "side"}, {"l_partkey": "own", "l_suppkey": "opponent", "p": "side"})


@probe("tf_split_explode", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word <> '' GROUP BY 1")
def tf_split_explode(t):
    return S.split_rows(t.part, "p_name", " ", "word").groupBy("word").agg(F.count("*").alias("n"))


@probe("tf_tokens_ordinal", "SELECT event_id, o AS ordinal, m[o] AS token FROM (SELECT event_id, m, unnest(range(1, len(m) + 1)) AS o FROM (SELECT event_id, regexp_extract_all(event_id || '-' || user_id || 'x' || event_id % 13, '[0-9]+') AS m FROM events))")
def tf_tokens_ordinal(t):
    text = F.concat(F.col("event_id").cast("string"), F.lit("-"), F.col("user_id").cast("string"), F.lit("x"), (F.col("event_id") % 13).cast("string"))
    return S.tokens(t.events.select("event_id", text.alias("s")), "s", "[0-9]+").select("event_id", F.col("ordinal").cast("long").alias("ordinal"), "token")


@probe("tf_series", "SELECT o_custkey, CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM orders GROUP BY 1")
def tf_series(t):
    return S.day_spine(t.orders.withColumn("day", F.to_date("o_orderdate")), ["o_custkey"], "day")


@probe("tf_unpivot", "SELECT l_orderkey, l_linenumber, l_partkey, name, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME name VALUE value)")
def tf_unpivot(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    df = t.lineitem.select(*keys, "l_quantity", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"), "l_tax")
    return S.unpivot(df, keys, ["l_quantity", "l_discount", "l_tax"], "name", "value")


@probe(
    "tf_spine_fill",
    """WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice > 150000 AS INTEGER) AS wins FROM orders),
s AS (SELECT o_custkey, CAST(unnest(generate_series(min(day) - 1, max(day) + 1, INTERVAL 1 DAY)) AS DATE) AS day FROM o GROUP BY 1)
SELECT s.o_custkey, s.day, CAST(sum(coalesce(wins, 0)) OVER (PARTITION BY s.o_custkey ORDER BY s.day) AS BIGINT) AS wins FROM s LEFT JOIN (SELECT o_custkey, day, sum(wins) AS wins FROM o GROUP BY 1, 2) d USING (o_custkey, day)""",
)
def tf_spine_fill(t):
    o = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), P.flag(F.col("o_totalprice") > 150000).alias("wins"))
    return S.spine_fill(o, ["o_custkey"], "day", ["wins"], 1)


# Measures

_REG = (
    M.Registry()
    .add(
        M.Metric("revenue", "sales", formula=lambda: F.round(F.sum("o_totalprice"), 2)),
        M.Metric("orders", "sales", formula=lambda: F.count("*")),
        M.ratio("finished_rate", "sales", "finished", "one"),
        M.ratio("urgent_rate", "sales", "urgent", "one"),
        M.Metric("gap", "sales", derived=lambda a, b: a - b, uses=("finished_rate", "urgent_rate")),
        M.ratio("return_rate", "sales", "returned", "line", source="event"),
        M.ratio("mean_discount", "sales", "cents", "line", 0.01, source="event"),
    )
)
#: Measures of the orders, the lines, and both: an account each, asked for together.
_ASKED = M.Registry().add(*_REG.metrics.values(), M.Metric("lines", "sales", "event", formula=lambda: F.count("*")), M.Metric("lines_an_order", "sales", derived=lambda a, b: F.try_divide(a.cast("double"), b), uses=("lines", "orders")), M.Metric("spread", "sales", derived=lambda a, b: a - b, uses=("lines_an_order", "gap")))


def _sales(t):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("unit"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("year"), "o_totalprice", P.flag(F.col("o_orderstatus") == "F").alias("finished"), P.flag(F.col("o_orderpriority").like("1%")).alias("urgent"), F.lit(1).alias("one"))
    li = t.lineitem.where("l_orderkey % 4 <> 0").select(F.col("l_orderkey").alias("unit"), F.rint(F.col("l_discount") * 100).cast("long").alias("cents"), P.flag(F.col("l_returnflag") == "R").alias("returned"), F.lit(1).alias("line"))
    return o, li.join(o.select("unit", "segment", "nation", "year"), "unit")


_SALES = """o AS (SELECT o_orderkey AS unit, c_mktsegment AS segment, c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice, CAST(o_orderstatus = 'F' AS INTEGER) AS finished, CAST(o_orderpriority LIKE '1%' AS INTEGER) AS urgent FROM orders JOIN customer ON o_custkey = c_custkey),
l AS (SELECT o.*, l_discount, CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem JOIN o ON l_orderkey = unit WHERE l_orderkey % 4 <> 0)"""


def _table_sql(keys: str) -> str:
    return f"""WITH {_SALES}, a AS (SELECT {keys}, round(sum(o_totalprice), 2) AS revenue, count(*) AS orders, round(avg(finished), 6) AS finished_rate, round(avg(urgent), 6) AS urgent_rate, round(avg(finished) - avg(urgent), 6) AS gap, count(DISTINCT unit) AS u FROM o GROUP BY ALL),
b AS (SELECT {keys}, round(avg(returned), 6) AS return_rate, round(CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) * 0.01 / count(*), 5) AS mean_discount, count(DISTINCT unit) AS v FROM l GROUP BY ALL)
SELECT * EXCLUDE (u, v), round(coalesce(v / u, 0), 6) AS coverage_rate FROM a LEFT JOIN b USING ({keys})"""


def _table(t, keys):
    out = M.metric_table(_REG, "sales", keys, *_sales(t), "unit")
    return out.select(*[F.round(c, 5 if c == "mean_discount" else 6).alias(c) if k == "double" and c != "revenue" else c for c, k in out.dtypes])


for _name, _keys in (("met_table", ["segment", "year"]), ("met_grains_career", ["segment"]), ("met_grains_season", ["nation", "year"]), ("met_grains_team", ["segment", "nation", "year"])):
    probe(_name, _table_sql(", ".join(_keys)))(lambda t, keys=_keys: _table(t, keys))


@probe("met_evaluate", f"WITH {_SALES} SELECT segment, round(avg(finished), 6) AS finished_rate, round(avg(urgent), 6) AS urgent_rate, round(avg(finished) - avg(urgent), 6) AS gap FROM o GROUP BY 1")
def met_evaluate(t):
    out = _REG.evaluate(_sales(t)[0], ["segment"], [m for m in _REG.of("sales", "season") if m.name in ("finished_rate", "urgent_rate", "gap")])
    return out.select("segment", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@probe("met_ratio_safe", "SELECT l_suppkey, l_linenumber, round(sum(l_discount) / nullif(sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END), 0), 6) AS r FROM lineitem GROUP BY 1, 2")
def met_ratio_safe(t):
    m = M.ratio("r", "x", "l_discount", "free")
    return t.lineitem.withColumn("free", P.flag(F.col("l_tax") == 0)).groupBy("l_suppkey", "l_linenumber").agg(F.round(m.column(), 6).alias("r"))


_FORMS = {"revenue": "sum", "orders": "sum", "finished_rate": "ratio", "urgent_rate": "ratio", "gap": "derived"}
_VALUED = f"v AS (SELECT segment, year, round(sum(o_totalprice), 2) AS revenue, CAST(count(*) AS DOUBLE) AS orders, round(avg(finished), 6) AS finished_rate, round(avg(urgent), 6) AS urgent_rate, round(avg(finished) - avg(urgent), 6) AS gap FROM o GROUP BY 1, 2), w AS (" + " UNION ALL ".join(f"SELECT segment, year, '{n}' AS name, '{f}' AS form, {n} AS value FROM v" for n, f in _FORMS.items()) + ")"


def _valued(t):
    """Every measure of the season account by segment and year, a row each, with its form."""
    metrics = _REG.of("sales", "season")
    out = _REG.evaluate(_sales(t)[0], ["segment", "year"], metrics)
    wide = out.select("segment", "year", *[F.round(F.col(m.name).cast("double"), 2 if m.name == "revenue" else 6).alias(m.name) for m in metrics])
    return S.unpivot(wide, ["segment", "year"], [m.name for m in metrics], "name", "value").join(_REG.classify(t.spark).select("name", "form"), "name")


@probe("met_registry", f"WITH {_SALES}, {_VALUED} SELECT segment, year, name, form, value FROM w")
def met_registry(t):
    return _valued(t).select("segment", "year", "name", "form", "value")


@probe("met_classify", f"WITH {_SALES}, {_VALUED} SELECT form, count(DISTINCT name) AS measures, count(value) AS valued, CAST(count(*) FILTER (WHERE value > 0) AS BIGINT) AS positive FROM w GROUP BY 1")
def met_classify(t):
    return _valued(t).groupBy("form").agg(F.count_distinct("name").alias("measures"), F.count("value").alias("valued"), F.count_if(F.col("value") > 0).alias("positive"))


@probe("met_query", f"WITH {_SALES} SELECT nation, round(avg(finished) - avg(urgent), 6) AS gap, count(*) AS orders FROM o WHERE year >= 1997 GROUP BY 1")
def met_query(t):
    return M.query(_REG, _sales(t)[0], "sales", ["nation"], ["gap", "orders"], F.col("year") >= 1997).select("nation", F.round("gap", 6).alias("gap"), "orders")


# The measures of the sport, over counters derived from lines by plain arithmetic.

_COUNTERS = {
    "at_bats": "l_quantity", "hits": "l_quantity % 13", "home_runs": "l_linenumber % 2", "strikeouts": "l_partkey % 5", "walks": "l_partkey % 3", "total_bases": "l_quantity % 13 + l_linenumber",
    "on_base_successes": "l_quantity % 13 + l_partkey % 3", "on_base_opportunities": "l_quantity + l_partkey % 3", "plate_appearances": "l_quantity + l_partkey % 4", "sacrifice_flies": "l_suppkey % 2",
    "stolen_bases": "l_suppkey % 3", "caught_stealing": "l_suppkey % 2", "outs_recorded": "l_quantity", "earned_runs": "l_partkey % 4", "runs": "l_partkey % 5", "batters_faced": "l_quantity + 3",
    "putouts": "l_partkey % 7", "assists": "l_partkey % 6", "errors": "l_partkey % 2", "outs_played": "l_quantity",
}


def _sport(t):
    return t.lineitem.select(F.col("l_suppkey").alias("team"), *[F.expr(e).cast("long").alias(n) for n, e in _COUNTERS.items()])


def sport_text(metrics) -> dict[str, str]:
    """Each measure written out as sums over the counters."""
    total = lambda names: " + ".join(("-" if n[0] == "-" else "") + f"sum({n.lstrip('-')})" for n in names).replace("+ -", "- ")
    text = {m.name: f"(({total(m.numerator)}) * {m.scale} / nullif({total(m.denominator)}, 0))" for m in metrics if m.form == "ratio"}
    text |= {"innings_played": "(sum(outs_played) / 3.0)", "on_base_plus_slugging": f"({text.get('on_base_percentage')} + {text.get('slugging_percentage')})", "isolated_power": f"({text.get('slugging_percentage')} - {text.get('batting_average')})"}
    return text | {"on_base_plus_slugging_against": f"({text.get('on_base_percentage_against')} + {text.get('slugging_percentage_against')})"}


def _sport_sql(metrics) -> str:
    text = sport_text(metrics)
    counters = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in _COUNTERS.items())
    return f"WITH c AS (SELECT l_suppkey AS team, {counters} FROM lineitem) SELECT team, " + ", ".join(f"round({text[m.name]}, 6) AS {m.name}" for m in metrics) + " FROM c GROUP BY 1"


for _kind, _make in (("offense", M.basic_offense), ("pitching", M.basic_pitching), ("fielding", M.basic_fielding)):

    def _sport_query(t, kind=_kind, make=_make):
        registry = M.Registry().add(*make(kind))
        out = registry.evaluate(_sport(t), ["team"], registry.of(kind))
        return out.select("team", *[F.round(c, 6).alias(c) for c in out.columns[1:]])

    probe(f"met_basic_{_kind}", _sport_sql(_make(_kind)))(_sport_query)


def _flags(t):
    kinds = {v: P.flag(F.col("event_type") == v) for v in TYPES}
    hit, known = P.flag(F.col("value") > 50), P.flag(F.col("event_type") != "view")
    both = {f"{v}_hits": c * hit for v, c in kinds.items()} | {f"{v}_outs": c * (1 - hit) for v, c in kinds.items()}
    return t.events.select("user_id", *[c.alias(n) for n, c in (kinds | both).items()], known.alias("known"), F.lit(1).alias("total"), (known * hit).alias("known_hits"), (known * (1 - hit)).alias("known_outs"))


_BB = ["click", "error"]


@probe("met_batted_ball", "SELECT user_id, " + ", ".join(f"round(count(*) FILTER (WHERE event_type = '{v}') / nullif(count(*) FILTER (WHERE event_type <> 'view'), 0), 6) AS {v}_rate, round(count(*) FILTER (WHERE event_type = '{v}' AND NOT value > 50) / nullif(count(*) FILTER (WHERE event_type = '{v}' AND value > 50), 0), 6) AS {v}_out_hit_ratio" for v in _BB) + ", round(count(*) FILTER (WHERE event_type <> 'view') / count(*), 6) AS known_rate FROM events GROUP BY 1")
def met_batted_ball(t):
    registry = M.Registry().add(*M.category_shares("bb", _BB, "total", "known", "outs", "hits"))
    out = registry.evaluate(_flags(t), ["user_id"], registry.of("bb"))
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@probe(
    "met_coverage_weighted",
    """WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'click' AND value > 50) / nullif(count(*) FILTER (WHERE event_type <> 'view' AND value > 50), 0) AS h, count(*) FILTER (WHERE event_type = 'click' AND NOT value > 50) / nullif(count(*) FILTER (WHERE event_type <> 'view' AND NOT value > 50), 0) AS o,
 count(*) FILTER (WHERE event_type <> 'view' AND value > 50) / nullif(count(*) FILTER (WHERE event_type <> 'view' AND NOT value > 50), 0) AS r FROM events GROUP BY 1) SELECT user_id, round(h * r / nullif(h * r + o, 0), 6) AS click_average FROM c""",
)
def met_coverage_weighted(t):
    registry = M.Registry().add(M.ratio("h", "cw", "click_hits", "known_hits"), M.ratio("o", "cw", "click_outs", "known_outs"), M.ratio("r", "cw", "known_hits", "known_outs"), M.coverage_weighted("click_average", "cw", "h", "o", "r"))
    return registry.evaluate(_flags(t), ["user_id"], registry.of("cw")).select("user_id", F.round("click_average", 6).alias("click_average"))


_RUN = {"second_attempts": "l_partkey % 3", "second_opportunities": "l_partkey % 3 + 2", "third_attempts": "l_partkey % 2", "third_opportunities": "l_partkey % 2 + 1", "home_attempts": "l_suppkey % 2", "home_opportunities": "l_suppkey % 2 + l_linenumber", "unforced_outs": "l_linenumber % 2", "times_on_base": "l_linenumber"}
_PITCH = {n: f"l_partkey % {k}" for k, n in enumerate(("strikes", "swings", "contacts", "called_strikes", "balls_in_play", "first_pitch_strikes", "whiffs"), 2)} | {"pitches": "l_quantity", "plate_appearances_with_pitches": "l_linenumber % 3", "plate_appearances": "l_linenumber"}


def _counted(name, counters, metrics):
    columns = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in counters.items())
    sql = f"WITH c AS (SELECT l_suppkey AS team, {columns} FROM lineitem) SELECT team, " + ", ".join(f"round(sum({m.numerator[0]}) / nullif(sum({m.denominator[0]}), 0), 6) AS {m.name}" for m in metrics) + " FROM c GROUP BY 1"

    @probe(name, sql)
    def run(t):
        df = t.lineitem.select(F.col("l_suppkey").alias("team"), *[F.expr(e).cast("long").alias(n) for n, e in counters.items()])
        out = M.Registry().evaluate(df, ["team"], metrics)
        return out.select("team", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


_counted("met_baserunning", _RUN, M.baserunning())
_counted("met_pitch_sequence", _PITCH, M.pitch_sequence())


# Data quality


@probe("dq_not_null", "SELECT event_id FROM events WHERE user_id % 2 = 0 AND nullif(event_type, 'error') IS NULL")
def dq_not_null(t):
    return Q.not_null(t.events.withColumn("kind", F.nullif(F.col("event_type"), F.lit("error"))), "kind", F.col("user_id") % 2 == 0).select("event_id")


@probe("dq_unique_values", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) > 1")
def dq_unique_values(t):
    return Q.unique(t.orders, ["o_custkey"], F.col("o_orderstatus") == "F")


@probe("dq_unique_grain", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_grain(t):
    return Q.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@probe("dq_accepted_values", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')")
def dq_accepted_values(t):
    return Q.accepted_values(t.events, "event_type", ["click", "view", "purchase"]).select("event_id", "event_type")


@probe("dq_not_null_proportion", "SELECT round(avg(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END), 6) AS share FROM customer HAVING share < 0.95")
def dq_not_null_proportion(t):
    return Q.not_null_proportion(t.customer.withColumn("b", P.null_if_outside(F.col("c_acctbal"), low=0.0000001)), "b", 0.95).select(F.round("share", 6).alias("share"))


@probe("dq_relationships", "SELECT l_orderkey AS k, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0)")
def dq_relationships(t):
    return Q.relationships(t.lineitem.select(F.col("l_orderkey").alias("k"), "l_linenumber"), "k", t.orders.where("o_orderkey % 10 <> 0"), "o_orderkey")


@probe("dq_bounded_range", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag <> 'N' AND (l_quantity <= 2 OR l_quantity >= l_partkey)")
def dq_bounded_range(t):
    return Q.bounded(t.lineitem, "l_quantity", 2, F.col("l_partkey"), False, F.col("l_returnflag") != "N").select("l_orderkey", "l_linenumber", "l_partkey")


@probe("dq_bounded_excluding_issues", "SELECT o_orderkey FROM orders WHERE (o_totalprice < 5000 OR o_totalprice > 400000) AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '5%')")
def dq_bounded_excluding_issues(t):
    return Q.bounded(t.orders, "o_totalprice", 5000.0, 400000.0, issues=t.orders.where("o_orderpriority LIKE '5%'"), keys=["o_orderkey"]).select("o_orderkey")


@probe("dq_sum_consistency", "SELECT round(a, 2) AS a, round(b, 2) AS b FROM (SELECT sum(o_totalprice) AS a FROM orders), (SELECT sum(l_extendedprice) AS b FROM lineitem) WHERE abs(a - b) > 1.0")
def dq_sum_consistency(t):
    return Q.sum_consistency(t.orders, F.col("o_totalprice"), t.lineitem, F.col("l_extendedprice"), 1.0).select(F.round("a", 2).alias("a"), F.round("b", 2).alias("b"))


@probe("dq_valid_season", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) NOT BETWEEN 1996 AND 2000")
def dq_valid_season(t):
    return Q.valid_season(t.orders.select("o_orderkey", F.year("o_orderdate").alias("y")), "y", 1996, 2000)


@probe("dq_one_starter", "SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber = 1) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1 HAVING count(*) FILTER (WHERE l_linenumber = 1) <> 1")
def dq_one_starter(t):
    return Q.one_per_group(t.lineitem, ["l_orderkey"], F.col("l_linenumber") == 1, t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey")))


_RULES = {"free": "l_discount = 0 AND l_tax = 0", "large": "l_quantity > 48", "cheap": "l_extendedprice < 2000", "late": "l_linenumber > 6", "returned_open": "l_returnflag = 'R' AND l_linestatus = 'O'", "odd": "l_partkey = l_suppkey", "many": "l_quantity > 45 AND l_discount > 0.08"}


@probe("dq_issue_table", " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, l_partkey, '{n}' AS issue FROM lineitem WHERE {c}" for n, c in _RULES.items()))
def dq_issue_table(t):
    return Q.issue_table(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey"], {n: F.expr(c) for n, c in _RULES.items()})


@probe("dq_missing_link", "SELECT DISTINCT o_orderkey, l_partkey FROM (SELECT o_orderkey, o_custkey AS l_partkey FROM orders) o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_partkey = o.l_partkey)")
def dq_missing_link(t):
    return Q.missing_link(t.orders.select("o_orderkey", F.col("o_custkey").alias("l_partkey")), ["o_orderkey", "l_partkey"], t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey"))


@probe("dq_suite", "SELECT 'unique' AS \"check\", 'o_orderkey' AS \"column\", CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'accepted_values', 'o_orderstatus', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT 'bounded', 'o_totalprice', count(*) FROM orders WHERE o_totalprice > 300000")
def dq_suite(t):
    return Q.suite({("unique", "o_orderkey"): Q.unique(t.orders, ["o_orderkey"]), ("accepted_values", "o_orderstatus"): Q.accepted_values(t.orders, "o_orderstatus", ["F", "O"]), ("bounded", "o_totalprice"): Q.bounded(t.orders, "o_totalprice", high=300000.0)})


def _asked(t, dimensions, measures, where=None):
    orders, lines = _sales(t)
    # The lines know their order only; all else is looked up.
    accounts = {"season": orders, "event": lines.select("unit", "cents", "returned", "line")}
    nations = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("country"), F.col("n_regionkey").alias("area"))
    regions = t.region.select(F.col("r_regionkey").alias("area"), F.col("r_name").alias("region"))
    lookups = [(orders.select("unit", "nation", "year", "segment"), ["unit"]), (nations, ["nation"]), (regions, ["area"])]
    out = M.ask(_ASKED, "sales", accounts, lookups, dimensions, measures, where)
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else c for c, k in out.dtypes])


_ASKED_SQL = f"""WITH {_SALES}, p AS (SELECT o.*, n_name AS country, r_name AS region FROM o JOIN nation ON nation = n_nationkey JOIN region ON n_regionkey = r_regionkey), q AS (SELECT l.*, n_name AS country, r_name AS region FROM l JOIN nation ON nation = n_nationkey JOIN region ON n_regionkey = r_regionkey),
a AS (SELECT {{0}}, avg(finished) - avg(urgent) AS gap, count(*) AS orders FROM p {{1}} GROUP BY ALL), b AS (SELECT {{0}}, avg(returned) AS return_rate, count(*) AS lines FROM q {{1}} GROUP BY ALL)
SELECT {{0}}, {{2}} FROM a FULL JOIN b USING ({{0}})"""


@probe("met_query_joined", _ASKED_SQL.format("region, year", "", "round(gap, 6) AS gap, round(return_rate, 6) AS return_rate, round(lines / orders - gap, 6) AS spread"))
def met_query_joined(t):
    return _asked(t, ["region", "year"], ["gap", "return_rate", "spread"])


@probe("met_query_one_account", _ASKED_SQL.format("country, segment, year", "WHERE year > 1994", "round(return_rate, 6) AS return_rate, lines").replace("a FULL JOIN b", "b LEFT JOIN a"))
def met_query_one_account(t):
    return _asked(t, ["country", "segment", "year"], ["return_rate", "lines"], F.col("year") > 1994)
