"""Queries for sources, projections and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import project as P
from ..sources import sinks, tables
from ..sources.shared import new_dir
from .adapters import AS_SPELLS, as_spells
from .registry import probe

NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _out(t, name):
    return new_dir(t.spark, name)


# Sources and sinks


@probe("src_registry", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in NAMES))
def src_registry(t):
    found = tables.load_sources(t.spark, {n: f"{n}.parquet" for n in NAMES}, t.sf_dir)
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, df in found.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


@probe("src_cast_manifest", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS BIGINT) AS o_totalprice FROM orders")
def src_cast_manifest(t):
    return tables.apply_types(t.orders.select("o_orderkey", "o_orderdate", F.rint("o_totalprice").alias("o_totalprice")), {"o_orderdate": "date", "o_totalprice": "long"})


@probe("src_enum_domain", "SELECT c_nationkey AS value FROM customer WHERE c_nationkey IS NOT NULL UNION SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL")
def src_enum_domain(t):
    return tables.enum_domain([(t.customer, "c_nationkey"), (t.supplier, "s_nationkey")])


@probe("src_enum_violations", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL)")
def src_enum_violations(t):
    domain = tables.enum_domain([(t.supplier, "s_nationkey")])
    return tables.enum_violations(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", domain)


@probe("src_seed_csv", "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 3 = 1 THEN 'NA' ELSE n_name END AS label FROM nation")
def src_seed_csv(t):
    path = _out(t, "seed")
    cell = F.when(F.col("n_nationkey") % 3 == 0, F.lit(" ")).when(F.col("n_nationkey") % 3 == 1, "NA").otherwise(F.col("n_name"))
    t.nation.select("n_nationkey", cell.alias("label")).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.read_seed(t.spark, path, "n_nationkey int, label string")


@probe(
    "src_transactions",
    """SELECT strftime(ts, '%Y%m%d') AS primary_date, printf('%08d', user_id) AS player_id, event_type AS txn_type,
       CAST(event_id % 5 AS VARCHAR) AS from_team, CAST(user_id % 5 AS VARCHAR) AS to_team
FROM events WHERE event_type IN ('click', 'signup') AND event_id % 5 <> user_id % 5""",
)
def src_transactions(t):
    path = _out(t, "transfers")
    text = lambda c: c.cast("string")
    made = t.events.select(F.date_format("ts", "yyyyMMdd").alias("primary_date"), F.lpad(text(F.col("user_id")), 8, "0").alias("player_id"), F.col("event_type").alias("txn_type"), text(F.col("event_id") % 5).alias("from_team"), text(F.col("user_id") % 5).alias("to_team"))
    made.write.csv(path)
    return tables.load_transfers(t.spark, path, "primary_date string, player_id string, txn_type string, from_team string, to_team string", ["click", "signup"])


@probe("src_semistruct", "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(event_id % 7 AS VARCHAR) AS a, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS b FROM events")
def src_semistruct(t):
    note = F.concat(F.lit("x=1;note="), (F.col("event_id") % 7).cast("string"), F.lit(", "), F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(""), F.lit(";y=2"))
    df = tables.parse_tagged(t.events.withColumn("note", note), "note", "note", ["a", "b"])
    return df.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "a", "b")


_COUNTS = "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1"


@probe("snk_full_refresh", _COUNTS)
def snk_full_refresh(t):
    return sinks.full_refresh(t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")), _out(t, "refresh"))


@probe("snk_view", _COUNTS)
def snk_view(t):
    return sinks.as_view(t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")), "segments_view")


@probe("snk_publish", _COUNTS)
def snk_publish(t):
    return sinks.publish(t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")), _out(t, "publish"), 1)


@probe("snk_export_tuned", _COUNTS)
def snk_export_tuned(t):
    return sinks.export_tuned(t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")), _out(t, "export"), "gzip", 16 << 20)


@probe("snk_required_guard", "SELECT count(*) AS n FROM nation")
def snk_required_guard(t):
    sinks.as_view(t.nation, "required_nation")
    sinks.require_tables(t.spark, ["required_nation"])
    return t.nation.agg(F.count("*").alias("n"))


# Projections and predicates


@probe("prj_stage", "SELECT c_custkey AS customer_id, upper(c_name) AS name, CAST(c_nationkey AS BIGINT) AS nation_id, c_acctbal < 0 AS in_debt FROM customer")
def prj_stage(t):
    return P.stage(t.customer, {"customer_id": "c_custkey", "name": "upper(c_name)", "nation_id": "cast(c_nationkey as long)", "in_debt": F.col("c_acctbal") < 0})


@probe("prj_exclude_replace", "SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def prj_exclude_replace(t):
    return P.exclude_replace(t.orders, ["o_orderdate"], {"o_orderstatus": F.lower("o_orderstatus")})


@probe("prj_alias_chain", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross, l_extendedprice * (1 - l_discount) * (1 + l_tax) > 1000 * l_quantity AS dear FROM lineitem")
def prj_alias_chain(t):
    return t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice * (1 - l_discount) AS net0", "net0 * (1 + l_tax) AS gross0", "gross0 > 1000 * l_quantity AS dear", "round(net0, 4) AS net", "round(gross0, 6) AS gross").drop("net0", "gross0")


TYPES = ["click", "error", "purchase", "signup", "view"]


@probe("prj_zero_fill", "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{v}') AS \"{v}\"" for v in TYPES) + " FROM events GROUP BY 1")
def prj_zero_fill(t):
    return P.zero_fill(t.events.groupBy("user_id").pivot("event_type", TYPES).count(), TYPES)


@probe("prj_flag_counter", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_returnflag = 'R' AS INTEGER) AS returned, CAST(l_quantity > 25 AS INTEGER) AS large, CAST(l_returnflag = 'R' AND l_quantity > 25 AS INTEGER) AS large_returned FROM lineitem")
def prj_flag_counter(t):
    returned, large = P.flag(F.col("l_returnflag") == "R"), P.flag(F.col("l_quantity") > 25)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", returned.alias("returned"), large.alias("large"), (returned * large).alias("large_returned"))


@probe("prj_indicators", "SELECT event_id, " + ", ".join(f"CAST(event_type = '{v}' AS INTEGER) AS is_{v}" for v in TYPES[:3]) + ", CAST(event_type <> 'view' AS INTEGER) AS is_known, CAST(event_type = 'view' AS INTEGER) AS is_unknown FROM events")
def prj_indicators(t):
    return t.events.select("event_id", *P.indicators("event_type", TYPES[:3], "is", "view"))


@probe("prj_case_lookup", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' ELSE 'other' END AS status FROM orders")
def prj_case_lookup(t):
    return t.orders.select("o_orderkey", P.lookup(F.col("o_orderstatus"), {"O": "open", "F": "finished"}, "other").alias("status"))


_ACCOUNTS = "orders o FULL JOIN (SELECT l_orderkey, count(*) AS n, round(sum(l_extendedprice), 2) AS s FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey"


def _accounts(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("s"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "full")


@probe("prj_precedence", f"SELECT coalesce(o_orderkey, l_orderkey) AS k, coalesce(s, o_totalprice) AS total FROM {_ACCOUNTS}")
def prj_precedence(t):
    return _accounts(t).select(P.by_precedence([F.col("o_orderkey"), F.col("l_orderkey")]).alias("k"), P.by_precedence([F.col("s"), F.col("o_totalprice")]).alias("total"))


@probe("prj_greatest_merge", f"SELECT coalesce(o_orderkey, l_orderkey) AS k, greatest(s, o_totalprice) AS total FROM {_ACCOUNTS}")
def prj_greatest_merge(t):
    return _accounts(t).select(F.coalesce("o_orderkey", "l_orderkey").alias("k"), P.largest_account([F.col("s"), F.col("o_totalprice")]).alias("total"))


_LINE_SUMS = "(SELECT l_orderkey AS o_orderkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1)"


def _base(t):
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("total"))
    return base, t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


_BASE_SQL = "SELECT o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS total FROM orders"


@probe("prj_supplement", f"SELECT b.o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN coalesce(b.total, l.total) ELSE b.total END AS total FROM ({_BASE_SQL}) b LEFT JOIN {_LINE_SUMS} l USING (o_orderkey)")
def prj_supplement(t):
    return P.supplement(*_base(t), ["o_orderkey"], ["total"], F.col("o_orderstatus") == "F")


@probe("prj_override", f"SELECT b.o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderpriority LIKE '1%' THEN coalesce(l.total, b.total) ELSE b.total END AS total FROM ({_BASE_SQL}) b LEFT JOIN {_LINE_SUMS} l USING (o_orderkey)")
def prj_override(t):
    return P.override(*_base(t), ["o_orderkey"], ["total"], F.col("o_orderpriority").like("1%"))


@probe("prj_quality_pick", f"SELECT coalesce(o_orderkey, l_orderkey) AS k, CASE WHEN n >= 3 THEN s ELSE o_totalprice END AS total FROM {_ACCOUNTS}")
def prj_quality_pick(t):
    return _accounts(t).select(F.coalesce("o_orderkey", "l_orderkey").alias("k"), P.pick_by_quality(F.col("n") >= 3, F.col("s"), F.col("o_totalprice")).alias("total"))


@probe("prj_null_rules", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def prj_null_rules(t):
    return t.customer.select("c_custkey", P.null_if_outside(F.col("c_acctbal"), low=0).alias("balance"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))


@probe("prj_key_pack", "SELECT l_orderkey * 255 + l_linenumber AS k, l_orderkey AS g, l_linenumber AS i, (l_orderkey * 255 + l_linenumber) * CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END AS signed FROM lineitem")
def prj_key_pack(t):
    key = P.pack_key(F.col("l_orderkey"), F.col("l_linenumber"))
    g, i = P.unpack_key(key)
    return t.lineitem.select(key.alias("k"), g.alias("g"), i.alias("i"), P.signed_key(key, F.col("l_returnflag") == "R").alias("signed"))


@probe("prj_state_key", "SELECT event_id, concat_ws('_', day(ts), CASE WHEN event_type <> 'view' THEN event_type END, event_id % 3) AS state FROM events")
def prj_state_key(t):
    return t.events.select("event_id", P.state_key([F.dayofmonth("ts"), F.when(F.col("event_type") != "view", F.col("event_type")), F.col("event_id") % 3]).alias("state"))


@probe("prj_clamp_bucket", "SELECT c_custkey, greatest(-500.0, least(c_acctbal, 5000.0)) AS held, CASE WHEN c_acctbal < 0 THEN 'below' WHEN c_acctbal < 5000 THEN 'middle' ELSE 'above' END AS bucket FROM customer")
def prj_clamp_bucket(t):
    b = F.col("c_acctbal")
    return t.customer.select("c_custkey", P.clamp(b, -500.0, 5000.0).alias("held"), F.when(b < 0, "below").when(b < 5000, "middle").otherwise("above").alias("bucket"))


@probe(
    "prj_infer_category",
    """WITH r AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 'Unknown' ELSE event_type END AS recorded,
  CASE WHEN value > 50 THEN 'large' WHEN value > 10 THEN 'small' ELSE 'Unknown' END AS guess FROM events)
SELECT event_id, CASE WHEN recorded = 'Unknown' THEN guess ELSE recorded END AS kind, coalesce(recorded = 'Unknown' AND guess <> 'Unknown', false) AS deduced FROM r""",
)
def prj_infer_category(t):
    m, v = F.col("event_id") % 4, F.col("value")
    recorded = F.when(m == 1, "Unknown").when(m > 1, F.col("event_type"))
    kind, deduced = P.infer(recorded, F.when(v > 50, "large").when(v > 10, "small").otherwise("Unknown"))
    return t.events.select("event_id", kind.alias("kind"), deduced.alias("deduced"))


@probe("prj_bitmask", "SELECT event_id, CAST(event_id % 8 & 1 AS INTEGER) AS first, CAST((event_id % 8 >> 1) & 1 AS INTEGER) AS second, CAST(bit_count(event_id % 8) AS INTEGER) AS n, (event_id % 8 & 1) = 1 AND (event_id % 8 & 2) = 0 AS next_open FROM events")
def prj_bitmask(t):
    s = (F.col("event_id") % 8).cast("int")
    return t.events.select("event_id", P.bit(s, 0).alias("first"), P.bit(s, 1).alias("second"), F.bit_count(s).cast("int").alias("n"), ((P.bit(s, 0) == 1) & (P.bit(s, 1) == 0)).alias("next_open"))


@probe(
    "prj_platoon",
    """WITH h AS (SELECT o_orderkey, CASE o_custkey % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'L' ELSE 'R' END AS own, CASE o_orderkey % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'L' ELSE 'R' END AS opp FROM orders)
SELECT o_orderkey, CASE WHEN own <> 'B' THEN own WHEN opp = 'R' THEN 'L' WHEN opp = 'L' THEN 'R' END AS bats, CASE WHEN opp <> 'B' THEN opp WHEN own = 'R' THEN 'L' WHEN own = 'L' THEN 'R' END AS throws FROM h""",
)
def prj_platoon(t):
    code = lambda c: P.lookup(F.col(c) % 3, {0: "B", 1: "L"}, "R")
    own, opp = code("o_custkey"), code("o_orderkey")
    return t.orders.select("o_orderkey", P.resolve_both(own, opp).alias("bats"), P.resolve_both(opp, own).alias("throws"))


@probe("flt_predicates", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity BETWEEN 5 AND 40 AND l_discount NOT BETWEEN 0.02 AND 0.04 AND l_returnflag IN ('A', 'R') AND l_linenumber NOT IN (2, 3) AND p_type LIKE '%E%' AND p_name NOT LIKE 'a%' AND p_brand ILIKE 'brand%' AND l_shipdate IS NOT NULL")
def flt_predicates(t):
    li = t.lineitem.where(F.col("l_quantity").between(5, 40) & ~F.col("l_discount").between(0.02, 0.04) & F.col("l_returnflag").isin("A", "R") & ~F.col("l_linenumber").isin(2, 3) & F.col("l_shipdate").isNotNull())
    part = t.part.where(F.col("p_type").like("%E%") & ~F.col("p_name").like("a%") & F.col("p_brand").ilike("brand%"))
    return li.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_partkey")


@probe("flt_regex", "SELECT p_partkey, p_name FROM part WHERE regexp_full_match(p_name, '[a-m][a-z]+ [a-z]+')")
def flt_regex(t):
    return t.part.where(F.col("p_name").rlike("^[a-m][a-z]+ [a-z]+$")).select("p_partkey", "p_name")


@probe("flt_having", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 HAVING count(*) > 10 AND total > 1000")
def flt_having(t):
    return P.having(t.orders, ["o_custkey"], [F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")], "n > 10 AND total > 1000")


@probe("flt_qualify", "SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3")
def flt_qualify(t):
    rank = F.row_number().over(P.window(["user_id"], [F.desc("value"), "event_id"]))
    return P.qualify(t.events, rank, "_q <= 3").select("event_id", "user_id")


# Joins


@probe("join_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t):
    return J.inner(t.orders.withColumnRenamed("o_custkey", "c_custkey"), t.customer, ["c_custkey"]).select("o_orderkey", "c_name")


@probe("join_left_lookup", "SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON c_nationkey = n_nationkey")
def join_left_lookup(t):
    return J.left_lookup(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation.where("n_nationkey < 20"), ["n_nationkey"]).select("c_custkey", "n_name")


@probe("join_full_outer", "SELECT k, total, n FROM (SELECT o_orderkey AS k, o_totalprice AS total FROM orders WHERE o_orderkey % 2 = 0) FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) USING (k)")
def join_full_outer(t):
    o = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("total"))
    return J.full_outer([o, t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))], ["k"])


@probe(
    "join_full_multi",
    """SELECT k, c, o, e FROM (SELECT c_custkey AS k, c_mktsegment AS c FROM customer) FULL JOIN (SELECT o_custkey AS k, count(*) AS o FROM orders WHERE o_orderkey % 7 = 0 GROUP BY 1) USING (k)
FULL JOIN (SELECT user_id + 100 AS k, count(*) AS e FROM events GROUP BY 1) USING (k)""",
)
def join_full_multi(t):
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("c"))
    o = t.orders.where("o_orderkey % 7 = 0").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("o"))
    return J.full_outer([c, o, t.events.groupBy((F.col("user_id") + 100).alias("k")).agg(F.count("*").alias("e"))], ["k"])


@probe(
    "join_multi_key_broadcast_chain",
    """SELECT o_orderkey AS k, n, q, d, r FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) a ON o_orderkey = a.l_orderkey
LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1) b ON o_orderkey = b.l_orderkey
LEFT JOIN (SELECT l_orderkey, max(l_discount) AS d FROM lineitem GROUP BY 1) c ON o_orderkey = c.l_orderkey
LEFT JOIN (SELECT l_orderkey, count(*) AS r FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) e ON o_orderkey = e.l_orderkey""",
)
def join_multi_key_broadcast_chain(t):
    by = lambda df, a: df.groupBy(F.col("l_orderkey").alias("k")).agg(a)
    parts = [by(t.lineitem, F.count("*").alias("n")), by(t.lineitem, F.sum("l_quantity").cast("long").alias("q")), by(t.lineitem, F.max("l_discount").alias("d")), by(t.lineitem.where("l_returnflag = 'R'"), F.count("*").alias("r"))]
    return J.left_chain(t.orders.select(F.col("o_orderkey").alias("k")), parts, ["k"])


@probe("join_cross", "SELECT r_name, c_mktsegment FROM region, (SELECT DISTINCT c_mktsegment FROM customer)")
def join_cross(t):
    return J.cross_small(t.customer.select("c_mktsegment").distinct(), t.region.select("r_name"))


@probe(
    "join_effective_dated",
    f"""WITH s AS ({AS_SPELLS}) SELECT e.o_orderkey, s.spell FROM orders e JOIN s ON e.o_custkey = s.o_custkey AND CAST(e.o_orderdate AS DATE) BETWEEN s.first AND coalesce(s.last, DATE '9999-12-31')""",
)
def join_effective_dated(t):
    spells = as_spells(t).withColumnsRenamed({"first": "date_start", "last": "date_end"})
    dated = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return J.effective_dated(dated, spells, ["o_custkey"], "day").select("o_orderkey", "spell")


_RANGES = "(SELECT user_id, event_id AS low, event_id + 40 AS high FROM events WHERE event_type = 'signup')"


@probe("join_interval_contains", f"SELECT e.event_id, r.low FROM events e JOIN {_RANGES} r ON e.user_id = r.user_id AND e.event_id BETWEEN r.low AND r.high")
def join_interval_contains(t):
    ranges = t.events.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("low"), (F.col("event_id") + 40).alias("high"))
    return J.interval_contains(t.events.select("user_id", "event_id"), ranges, ["user_id"], "event_id", "low", "high").select("event_id", "low")


@probe("join_interval_overlap", f"WITH s AS ({AS_SPELLS}) SELECT a.o_custkey, a.spell AS one, b.spell AS other FROM s a JOIN s b ON a.o_custkey = b.o_custkey AND a.first <= coalesce(b.last, DATE '9999-12-31') + 30 AND coalesce(a.last, DATE '9999-12-31') >= b.first AND a.spell < b.spell")
def join_interval_overlap(t):
    far = F.lit("9999-12-31").cast("date")
    s = as_spells(t).select("o_custkey", "spell", "first", F.coalesce("last", far).alias("last"))
    other = s.select("o_custkey", F.col("spell").alias("other"), F.col("first").alias("first2"), F.date_add("last", F.when(F.col("last") == far, 0).otherwise(30)).alias("last2"))
    return J.interval_overlap(s, other, ["o_custkey"], ("first", "last"), ("first2", "last2")).where("spell < other").select("o_custkey", F.col("spell").alias("one"), "other")


@probe("join_interval_max", f"SELECT e.event_id, e.event_type, m.low FROM events e LEFT JOIN (SELECT e.event_id, max(r.low) AS low FROM events e JOIN {_RANGES} r ON e.user_id = r.user_id AND e.event_id BETWEEN r.low AND r.high GROUP BY 1) m USING (event_id)")
def join_interval_max(t):
    ranges = t.events.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("low"), (F.col("event_id") + 40).alias("high"))
    return J.interval_max(t.events.select("user_id", "event_id", "event_type"), ranges, ["user_id"], "event_id", "low", "high", ["event_id"]).select("event_id", "event_type", "low")


@probe("join_trailing_years", "WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2) SELECT a.o_custkey, a.season, round(sum(b.total), 2) AS total FROM y a JOIN y b ON a.o_custkey = b.o_custkey AND b.season BETWEEN a.season - 2 AND a.season GROUP BY 1, 2")
def join_trailing_years(t):
    y = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return J.trailing(y, ["o_custkey"], "season", 2).groupBy("o_custkey", "season").agg(F.round(F.sum("total"), 2).alias("total"))


_RATES = "SELECT l_suppkey % 5 AS team, CAST(year(l_shipdate) AS INTEGER) AS season, l_partkey % 4 AS unit, count(*) AS n FROM lineitem GROUP BY 1, 2, 3"


def _rates(t):
    return t.lineitem.groupBy((F.col("l_suppkey") % 5).alias("team"), F.year("l_shipdate").alias("season"), (F.col("l_partkey") % 4).alias("unit")).agg(F.count("*").alias("n"))


@probe("join_matched_pairs", f"WITH r AS ({_RATES}) SELECT a.team, a.season, a.unit, b.unit AS other_unit, a.n, b.n AS other_n FROM r a JOIN r b ON a.team = b.team AND a.season = b.season AND a.unit <> b.unit")
def join_matched_pairs(t):
    return J.matched_pairs(_rates(t), ["team", "season"], "unit")


@probe("join_role_pairs", "SELECT b.user_id, b.event_id AS buy, s.event_id AS sign FROM events b JOIN events s ON b.user_id = s.user_id AND CAST(b.ts AS DATE) = CAST(s.ts AS DATE) WHERE b.event_type = 'purchase' AND s.event_type = 'signup'")
def join_role_pairs(t):
    e = t.events.withColumn("day", F.to_date("ts"))
    return J.role_pairs(e, ["user_id", "day"], F.col("event_type") == "purchase", F.col("event_type") == "signup", {"event_id": ("buy", "sign")}).select("user_id", "buy", "sign")


@probe("join_opponent", "WITH g AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2) SELECT a.l_orderkey, a.l_returnflag, a.n, b.n AS opponent_n FROM g a JOIN g b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag <> b.l_returnflag")
def join_opponent(t):
    g = t.lineitem.where("l_returnflag IN ('A', 'R')").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n"))
    return J.opponent(g, ["l_orderkey"], "l_returnflag", ["n"])


@probe(
    "join_state_lookup",
    """WITH m AS (SELECT event_type, round(avg(value), 6) AS v FROM events GROUP BY 1), s AS (SELECT event_id, event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events)
SELECT event_id, round(y.v - x.v, 5) AS change FROM s LEFT JOIN m x ON s.a = x.event_type LEFT JOIN m y ON s.b = y.event_type""",
)
def join_state_lookup(t):
    m = t.events.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("v"))
    s = t.events.select("event_id", F.col("event_type").alias("a"), F.lead("event_type").over(P.window(["user_id"], ["event_id"])).alias("b"))
    return J.state_lookup(s, m, "event_type", "v", {"a": "va", "b": "vb"}).select("event_id", F.round(F.col("vb") - F.col("va"), 5).alias("change"))


@probe("join_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_anti(t):
    return J.without(t.orders.select("o_orderkey"), t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@probe("join_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def join_semi(t):
    return J.among(t.customer.select("c_custkey"), t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@probe(
    "join_source_fallback",
    """WITH f AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), o AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), p AS (SELECT c_custkey AS o_custkey, CAST(0 AS BIGINT) AS n FROM customer)
SELECT *, 'f' AS source FROM f UNION ALL SELECT *, 'o' FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM f) UNION ALL SELECT *, 'p' FROM p WHERE o_custkey NOT IN (SELECT o_custkey FROM f) AND o_custkey NOT IN (SELECT o_custkey FROM o)""",
)
def join_source_fallback(t):
    by = lambda s: t.orders.where(F.col("o_orderstatus") == s).groupBy("o_custkey").agg(F.count("*").alias("n"))
    none = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.lit(0).cast("long").alias("n"))
    return J.fallback({"f": by("F"), "o": by("O"), "p": none}, ["o_custkey"])


@probe(
    "join_string_range",
    """WITH r AS (SELECT n_nationkey AS g, CAST(10 + n_nationkey AS VARCHAR) AS low, CAST(11 + n_nationkey AS VARCHAR) AS high FROM nation WHERE n_nationkey % 2 = 0)
SELECT p_partkey, g FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'x' || p_size ELSE CAST(p_size AS VARCHAR) END AS code FROM part) LEFT JOIN r ON regexp_full_match(code, '[0-9]+') AND code BETWEEN low AND high""",
)
def join_string_range(t):
    ranges = t.nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("g"), (F.col("n_nationkey") + 10).cast("string").alias("low"), (F.col("n_nationkey") + 11).cast("string").alias("high"))
    size = F.col("p_size").cast("string")
    codes = t.part.select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("x"), size)).otherwise(size).alias("code"))
    return J.string_range(codes, ranges, "code", "low", "high").select("p_partkey", "g")


@probe(
    "join_alias_resolution",
    """WITH exact AS (SELECT DISTINCT source AS name, upper(source) AS std FROM documents WHERE doc_id % 2 = 0 AND source IN ('src1', 'src2', 'src3')), pair AS (SELECT DISTINCT source AS name, lang, source || '-' || lang AS std FROM documents WHERE lang IN ('de', 'fr'))
SELECT doc_id, coalesce(p.std, e.std, d.source) AS std FROM documents d LEFT JOIN pair p ON d.source = p.name AND d.lang = p.lang LEFT JOIN exact e ON d.source = e.name""",
)
def join_alias_resolution(t):
    docs = t.documents.select("doc_id", F.col("source").alias("name"), "lang")
    exact = docs.where("doc_id % 2 = 0 AND name IN ('src1', 'src2', 'src3')").select("name", F.upper("name").alias("std")).distinct()
    pair = docs.where("lang IN ('de', 'fr')").select("name", "lang", F.concat_ws("-", "name", "lang").alias("std")).distinct()
    return J.resolve_alias(docs, [(pair, ["name", "lang"]), (exact, ["name"])], "std", F.col("name")).select("doc_id", "std")


@probe(
    "join_boundary_match",
    """WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events),
m AS (SELECT user_id, event_type AS b, max(CAST(ts AS DATE)) AS day FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2)
SELECT e.event_id, max(m.day) AS moved FROM e LEFT JOIN m ON e.user_id = m.user_id AND e.b = m.b AND m.day <= e.day WHERE e.b IS NOT NULL GROUP BY 1""",
)
def join_boundary_match(t):
    steps = J.boundaries(t.events.select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type"), ["user_id"], ["event_id"], "event_type").where("to_value IS NOT NULL")
    moves = t.events.where("event_type IN ('purchase', 'signup')").groupBy("user_id", F.col("event_type").alias("to_value")).agg(F.max(F.to_date("ts")).alias("moved"))
    return J.as_of(steps.select("event_id", "user_id", "to_value", "day"), moves, ["user_id", "to_value"], "day", "moved", ["event_id"]).select("event_id", "moved")


