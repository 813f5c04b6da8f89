"""Projections and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stage(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """New names from old columns or expressions, nothing else."""
    return df.select(*[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in columns.items()])


def exclude_replace(df: DataFrame, exclude: list[str] = [], replace: dict[str, Column] = {}) -> DataFrame:  # noqa: B006
    """All columns but some, some of them with another value in the same place."""
    return df.select(*[replace[c].alias(c) if c in replace else F.col(c) for c in df.columns if c not in exclude])


def zero_fill(df: DataFrame, stats: list[str]) -> DataFrame:
    """0 for null in a list of columns, in one projection."""
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in stats else F.col(c) for c in df.columns])


def flag(condition: Column) -> Column:
    """1 or 0; a condition that is null counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def indicators(column: str, values: list, prefix: str, unknown: str | None = None) -> list[Column]:
    """An indicator for each value, and with ``unknown`` one for known and one for unknown values."""
    c = F.col(column)
    out = [F.when(c == v, 1).otherwise(0).alias(f"{prefix}_{v}") for v in values]
    if unknown is not None:
        is_known = c.isNotNull() & (c != unknown)
        out += [F.when(is_known, 1).otherwise(0).alias(f"{prefix}_known"), F.when(is_known, 0).otherwise(1).alias(f"{prefix}_unknown")]
    return out


def lookup(column: Column, labels: dict, default=None) -> Column:
    """A code's label."""
    chain = reduce(lambda w, kv: w.when(column == kv[0], kv[1]), list(labels.items())[1:], F.when(column == next(iter(labels)), next(iter(labels.values()))))
    return chain.otherwise(default)


def by_precedence(columns: list[Column]) -> Column:
    """The first account that has a value."""
    return F.coalesce(*columns)


def largest_account(columns: list[Column]) -> Column:
    """The largest of several accounts of a fact; nulls don't count."""
    return F.greatest(*columns)


def supplement(df: DataFrame, other: DataFrame, keys: list[str], stats: list[str], gate: Column) -> DataFrame:
    """Fills nulls of ``stats`` from ``other`` on rows that pass the gate."""
    renamed = other.select(*keys, *[F.col(c).alias(f"_{c}") for c in stats])
    joined = df.join(renamed, keys, "left")
    return joined.select(*[F.when(gate, F.coalesce(F.col(c), F.col(f"_{c}"))).otherwise(F.col(c)).alias(c) if c in stats else F.col(c) for c in df.columns])


def override(df: DataFrame, other: DataFrame, keys: list[str], stats: list[str], scope: Column) -> DataFrame:
    """Replaces ``stats`` by those of a trusted table inside a scope, where it has them."""
    renamed = other.select(*keys, *[F.col(c).alias(f"_{c}") for c in stats])
    joined = df.join(renamed, keys, "left")
    return joined.select(*[F.when(scope, F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in stats else F.col(c) for c in df.columns])


def pick_by_quality(good: Column, one: Column, other: Column) -> Column:
    """One account where its quality flag holds, else the other."""
    return F.when(good, one).otherwise(other)


def null_if_outside(column: Column, low=None, high=None) -> Column:
    """Null for impossible values."""
    fits = F.lit(True)
    if low is not None:
        fits = fits & (column >= low)
    if high is not None:
        fits = fits & (column <= high)
    return F.when(fits, column)


def pack_key(group: Column, item: Column, size: int = 255) -> Column:
    """Two numbers in one; item is from 0 to size - 1."""
    return group.cast("long") * size + item


def unpack_key(key: Column, size: int = 255) -> tuple[Column, Column]:
    return F.floor(key / size).cast("long"), F.pmod(key, F.lit(size)).cast("int")


def signed_key(key: Column, side: Column) -> Column:
    return key * F.when(side, 1).otherwise(-1)


def state_key(columns: list[Column]) -> Column:
    """Members of a state in one text; null members are left out."""
    return F.concat_ws("_", *columns)


def clamp(column: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(column, F.lit(high)))


def infer(recorded: Column, inferred: Column, unknown: str = "Unknown") -> tuple[Column, Column]:
    """The recorded value, or the inferred one where it is unknown; and whether it was deduced. Null stays null."""
    open_ = recorded == unknown
    return F.when(open_, inferred).otherwise(recorded), F.coalesce(open_ & (inferred != unknown), F.lit(False))


def bit(state: Column, place: int) -> Column:
    return F.shiftright(state, place).bitwiseAND(1)


def resolve_both(own: Column, opponent: Column, both: str = "B") -> Column:
    """A hand of "both" becomes the opposite of the opponent's; unknown if that is "both" too."""
    return F.when(own != both, own).when(opponent == "R", "L").when(opponent == "L", "R")


def having(df: DataFrame, keys: list[str], aggregates: list[Column], condition: str) -> DataFrame:
    return df.groupBy(*keys).agg(*aggregates).where(condition)


def qualify(df: DataFrame, value: Column, condition: str) -> DataFrame:
    """Filters on a window value, named ``_q`` in the condition."""
    return df.withColumn("_q", value).where(condition).drop("_q")


def window(keys: list[str], order: list) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)
