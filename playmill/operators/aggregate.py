"""Aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_sum(df: DataFrame, keys: list[str], stats: list[str]) -> DataFrame:
    """Sums of a shared list of stats, in one pass."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in stats])


def derive_stats(base: list[str], extra: list[str] = (), without: list[str] = ()) -> list[str]:
    """A list of stats made from another; order is kept and nothing comes twice."""
    return [c for c in dict.fromkeys([*extra, *base]) if c not in without]


def redefine(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Columns that mean something else at the coarser grain."""
    return df.withColumns(columns)


def filter_counts(conditions: dict[str, Column]) -> list[Column]:
    """Many conditional counts for one pass."""
    return [F.count_if(c).alias(n) for n, c in conditions.items()]


def first_where(role: Column, roles: list, value: Column, prefix: str) -> list[Column]:
    """A column for each role with its value."""
    return [F.max(F.when(role == r, value)).alias(f"{prefix}_{r}") for r in roles]


def ordered_list(value: Column, *order: Column) -> Column:
    """Values in order of the keys, rather than of arrival; null values are left out."""
    keys = [o.alias(f"k{i}") for i, o in enumerate(order)]
    packed = F.collect_list(F.when(value.isNotNull(), F.struct(*keys, value.alias("v"))))
    return F.transform(F.array_sort(packed), lambda x: x["v"])


def ordered_text(value: Column, *order: Column, sep: str = "") -> Column:
    return F.array_join(ordered_list(value.cast("string"), *order), sep)


def ordered_map(key: Column, value: Column) -> Column:
    """A map in order of its keys, which must not come twice."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("v")))))


def mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value, the smallest of equals."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def strict_sum(value: Column) -> Column:
    """Null if any value is null."""
    return F.when(~F.bool_or(value.isNull()), F.sum(value))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def rate(over: Column, under: Column) -> Column:
    """Of the rows with one flag, the share that has the other too."""
    return F.try_divide(F.sum(over * under), F.sum(under))


def coverage_tier(tiers: list[tuple[str, Column]], default: str) -> Column:
    """The first tier whose condition holds for all rows of the group."""
    return reduce(lambda w, t: w.when(F.bool_and(t[1]), t[0]), tiers[1:], F.when(F.bool_and(tiers[0][1]), tiers[0][0])).otherwise(default)


def single_member(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Groups of exactly one row, with its values."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.min(c).alias(c) for c in values]).where("_n = 1").drop("_n")


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def union_accounts(parts: list[DataFrame], keys: list[str], stats: list[str]) -> DataFrame:
    """Accounts of different grain and columns put together, then summed."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rollup_sum(every, keys, stats)
