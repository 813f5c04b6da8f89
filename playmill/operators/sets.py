"""Sorts, limits, set operations and table functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def topk_group(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def topk(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def shuffled(df: DataFrame, keys: list[str]) -> DataFrame:
    """A reproducible random order."""
    return df.orderBy(F.xxhash64(*keys), *keys)


def two_perspectives(df: DataFrame, shared: list[str], one: dict[str, str], other: dict[str, str]) -> DataFrame:
    """A row for each member of a pair, in one pass over the pairs. one and other map columns to the same new names."""
    sides = F.array(*[F.struct(*[F.col(c).alias(n) for c, n in side.items()]) for side in (one, other)])
    return df.select(*shared, F.explode(sides).alias("_side")).select(*shared, "_side.*")


def split_rows(df: DataFrame, column: str, pattern: str, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.split(column, pattern))).where(F.col(name) != "")


def tokens(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Adds ordinal (from 1) and token for each match of a pattern; rows without one go."""
    return df.select("*", F.posexplode(F.regexp_extract_all(column, F.lit(pattern), F.lit(0))).alias("ordinal", "token")).withColumn("ordinal", F.col("ordinal") + 1)


def line_score(df: DataFrame, column: str) -> DataFrame:
    """Innings of a line score such as 010(10)20x: ordinal and value, none for the x of an inning not played."""
    found = tokens(df, column, r"\([0-9]+\)|[0-9]|[xX]")
    return found.where(~F.lower("token").isin("x")).withColumn("value", F.regexp_extract("token", r"[0-9]+", 0).cast("int")).drop("token")


def day_spine(df: DataFrame, keys: list[str], date: str, pad: int = 0) -> DataFrame:
    """Every day from the first to the last of each group."""
    span = df.groupBy(*keys).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    return span.select(*keys, F.explode(F.sequence(F.date_sub("_a", pad), F.date_add("_b", pad))).alias(date))


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Columns to rows; nulls are left out."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def spine_fill(df: DataFrame, keys: list[str], date: str, stats: list[str], pad: int = 0) -> DataFrame:
    """Totals to date of each stat on every day from the first of a group to its last, and pad days around.

    Days are made from the totals: a day that has rows stands for the days up to
    the next such day. Only days with rows are shuffled and sorted.
    """
    order = Window.partitionBy(*keys).orderBy(date)
    daily = df.groupBy(*keys, date).agg(*[F.sum(c).alias(c) for c in stats])
    to_date = daily.select(*keys, date, *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(order).alias(c) for c in stats], F.lead(date).over(order).alias("_next"), F.lag(date).over(order).isNull().alias("_first"))
    return expanded(to_date, keys, date, stats, pad)


def expanded(steps: DataFrame, keys: list[str], date: str, values: list[str], pad: int = 0) -> DataFrame:
    """Each row of steps on every day before _next, or pad days on where that is null; the pad days before _first with 0 in place of the values."""
    days = F.transform(F.sequence(F.col(date), F.coalesce(F.date_sub("_next", 1), F.date_add(date, pad))), lambda d: F.struct(d.alias("day"), F.lit(True).alias("on")))
    if pad:
        ahead = F.transform(F.sequence(F.date_sub(date, pad), F.date_sub(date, 1)), lambda d: F.struct(d.alias("day"), F.lit(False).alias("on")))
        days = F.when(F.col("_first"), F.concat(ahead, days)).otherwise(days)
    spread = steps.select(*keys, *values, F.explode(days).alias("_d"))
    zero = lambda c: F.when(F.col("_d.on"), F.col(c)).otherwise(F.lit(0)).alias(c)
    return spread.select(*keys, F.col("_d.day").alias(date), *[zero(c) for c in values])
