"""Queries for scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from .registry import probe


@probe(
    "fn_string",
    """SELECT p_partkey, substring(p_name, 2, 3) AS a, left(p_name, 2) AS b, lower(p_brand) AS c, trim(p_name, 'aeiou') AS d, length(p_name) AS e, replace(p_name, 'a', '_') AS f,
 split_part(p_name, ' ', 2) AS g, regexp_extract(p_brand, '([0-9]+)', 1) AS h, regexp_full_match(p_name, '[a-z ]+') AS i, concat_ws('-', p_brand, p_type) AS j FROM part""",
)
def fn_string(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", F.substring(n, 2, 3).alias("a"), F.left(n, F.lit(2)).alias("b"), F.lower("p_brand").alias("c"), X.strip(n, "aeiou").alias("d"), F.length(n).cast("long").alias("e"), F.replace(n, F.lit("a"), F.lit("_")).alias("f"), F.split_part(n, F.lit(" "), F.lit(2)).alias("g"), F.regexp_extract("p_brand", "([0-9]+)", 1).alias("h"), X.full_match(n, "[a-z ]+").alias("i"), F.concat_ws("-", "p_brand", "p_type").alias("j"))


@probe("fn_date", "SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS day, strftime(o_orderdate, '%Y-%m') AS month, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(dayofyear(o_orderdate) AS INTEGER) AS doy, CAST(o_orderdate AS DATE) + 3 AS later, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days FROM orders")
def fn_date(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", X.day_of(F.date_format(d, "yyyyMMdd")).alias("day"), F.date_format(d, "yyyy-MM").alias("month"), F.year(d).alias("y"), F.dayofyear(d).alias("doy"), F.date_add(F.to_date(d), 3).alias("later"), F.datediff(F.to_date(d), F.lit("1995-01-01").cast("date")).alias("days"))


@probe("fn_math", "SELECT event_id, round(sqrt(value), 5) AS a, round(pow(value, 1.5), 4) AS b, (event_id - 500) // 7 AS c, event_id % 7 AS d, greatest(user_id, event_id % 50) AS e, abs(event_id - 500) AS f, CAST(bit_count(event_id) AS INTEGER) AS g, (event_id >> 2) & 3 AS h FROM events")
def fn_math(t):
    e, v = F.col("event_id"), F.col("value")
    return t.events.select("event_id", F.round(F.sqrt(v), 5).alias("a"), F.round(F.pow(v, F.lit(1.5)), 4).alias("b"), X.whole_div(e - 500, 7).alias("c"), (e % 7).alias("d"), F.greatest("user_id", e % 50).alias("e"), F.abs(e - 500).alias("f"), F.bit_count(e).cast("int").alias("g"), F.shiftright(e, 2).bitwiseAND(3).alias("h"))


@probe("fn_null", "SELECT event_id, coalesce(nullif(event_type, 'view'), 'seen') AS a, nullif(event_id % 3, 0) IS NULL AS b FROM events")
def fn_null(t):
    return t.events.select("event_id", F.coalesce(F.nullif(F.col("event_type"), F.lit("view")), F.lit("seen")).alias("a"), F.nullif(F.col("event_id") % 3, F.lit(0)).isNull().alias("b"))


@probe("fn_array_map", "SELECT p_partkey, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[-1] AS last, string_split(p_name, ' ')[9] AS none, map([1, 2], [p_brand, p_type])[2] AS kind FROM part")
def fn_array_map(t):
    words = F.split("p_name", " ")
    m = F.map_from_arrays(F.array(F.lit(1), F.lit(2)), F.array("p_brand", "p_type"))
    return t.part.select("p_partkey", X.entry(words, 1).alias("first"), X.entry(words, -1).alias("last"), X.entry(words, 9).alias("none"), F.element_at(m, 2).alias("kind"))


@probe("fn_hash", "SELECT count(*) AS n FROM events")
def fn_hash(t):
    return t.events.where(X.bucket_of_hash([F.col("event_id")], 10).between(0, 9)).agg(F.count("*").alias("n"))
