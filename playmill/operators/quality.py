"""Data-quality checks; each returns the rows that violate it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _where(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.where(condition)


def not_null(df: DataFrame, column: str, condition: Column | None = None) -> DataFrame:
    return _where(df, condition).where(F.col(column).isNull())


def unique(df: DataFrame, columns: list[str], condition: Column | None = None) -> DataFrame:
    """Keys that come more than once, with their number."""
    return _where(df, condition).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def not_null_proportion(df: DataFrame, column: str, least: float) -> DataFrame:
    """One row with the share of non-null values if it is below the least."""
    return df.agg(F.avg(F.col(column).isNotNull().cast("int")).alias("share")).where(F.col("share") < least)


def relationships(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Values missing from the target; nulls may be, and an empty target tells nothing."""
    has_rows = target.agg((F.count("*") > 0).alias("_any"))
    missing = df.where(F.col(column).isNotNull()).join(target.select(F.col(target_column).alias(column)), column, "left_anti")
    return missing.crossJoin(has_rows).where("_any").drop("_any")


def bounded(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True, condition: Column | None = None, issues: DataFrame | None = None, keys: list[str] = ()) -> DataFrame:
    """Values outside bounds, which may be columns; rows whose keys are among known issues are left out."""
    c, out = F.col(column), F.lit(False)
    bound = lambda b: b if isinstance(b, Column) else F.lit(b)
    if low is not None:
        out = out | (c < bound(low) if inclusive else c <= bound(low))
    if high is not None:
        out = out | (c > bound(high) if inclusive else c >= bound(high))
    found = _where(df, condition).where(out)
    return found.join(issues.select(*keys), list(keys), "left_anti") if issues is not None else found


def sum_consistency(one: DataFrame, a: Column, other: DataFrame, b: Column, tolerance: float) -> DataFrame:
    """One row with both totals if they differ by more than the tolerance."""
    both = one.agg(F.sum(a).alias("a")).crossJoin(other.agg(F.sum(b).alias("b")))
    return both.where(F.abs(F.col("a") - F.col("b")) > tolerance)


def valid_season(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    return df.where(~F.col(column).between(first, last))


def one_per_group(df: DataFrame, keys: list[str], condition: Column, issues: DataFrame | None = None) -> DataFrame:
    """Groups without exactly one row that meets the condition, known issues left out."""
    found = df.groupBy(*keys).agg(F.count_if(condition).alias("n")).where("n <> 1")
    return found.join(issues.select(*keys), keys, "left_anti") if issues is not None else found


def issue_table(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row breaks, in one pass."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("issue"))


def missing_link(df: DataFrame, keys: list[str], observed: DataFrame) -> DataFrame:
    """Recorded keys that are never observed downstream, though their first key is."""
    seen = observed.select(keys[0]).distinct()
    return df.join(seen, keys[0], "left_semi").join(observed.select(*keys), keys, "left_anti")


def suite(checks: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """check, column and number of violations of each check."""
    each = [df.agg(F.count("*").alias("violations")).select(F.lit(k).alias("check"), F.lit(c).alias("column"), "violations") for (k, c), df in checks.items()]
    return reduce(DataFrame.union, each)
