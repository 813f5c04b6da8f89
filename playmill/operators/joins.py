"""Joins. Equality keys give the hash; ranges are met by the dyadic intervals that make them up. Small sides are left to the size threshold of the session."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inner(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other, keys, "inner")


def left_lookup(df: DataFrame, dimension: DataFrame, keys: list[str]) -> DataFrame:
    """Adds a dimension's columns; rows without a match keep nulls."""
    return df.join(dimension, keys, "left")


def full_outer(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """A chain of full joins on merged keys: the key is the first that is known."""
    return reduce(lambda a, b: a.join(b, keys, "full"), parts)


def left_chain(df: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left joins of several aggregates on one key; all of them share its partitioning."""
    return reduce(lambda a, b: a.join(b, keys, "left"), parts, df)


def cross_small(df: DataFrame, few: DataFrame) -> DataFrame:
    """Every row with each row of a table of a few rows, such as one-row totals."""
    return df.crossJoin(few)


def effective_dated(df: DataFrame, history: DataFrame, keys: list[str], date: str, start: str = "date_start", end: str = "date_end", how: str = "inner") -> DataFrame:
    """The history row in force on the date; an open end is the far future."""
    far = F.to_date(F.lit("9999-12-31"))
    h = history.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in history.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys]) & F.col(date).between(F.col(start), F.coalesce(end, far))
    return df.join(h, on, how).drop(*[f"_{k}" for k in keys])


def _number(c: Column, kind: str, unit: int) -> Column:
    """A whole number that grows with the value: days, microseconds, or the floor, in steps of unit."""
    n = F.unix_date(c) if kind == "date" else F.unix_micros(c.cast("timestamp")) if kind.startswith("timestamp") else F.floor(c)
    return F.floor(n.cast("long") / unit).cast("long") if unit > 1 else n.cast("long")


def _dyadic(low: Column, high: Column) -> Column:
    """The (level, node) whose disjoint dyadic intervals [node * 2^level, (node + 1) * 2^level) make up low to high: two a level at most."""
    top = F.ceil(F.log2((high - low + 2).cast("double"))).cast("int")

    def nodes(level: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        a, b = F.call_function("shiftright", low + step - 1, level), F.call_function("shiftright", high + 1, level)
        odd = a.bitwiseAND(F.lit(1).cast("long"))
        node = lambda n: F.struct(level.alias("level"), n.alias("node"))
        left = F.when((a < b) & (odd == 1), node(a))
        right = F.when((a + odd < b) & (b.bitwiseAND(F.lit(1).cast("long")) == 1), node(b - 1))
        return F.array(left, right)

    every = F.flatten(F.transform(F.sequence(F.lit(0), top), nodes))
    return F.when(low <= high, F.filter(every, lambda x: x.isNotNull()))


def meeting(points: DataFrame, ranges: DataFrame, keys: list[str], point: str, low: str, high: str, unit: int = 1) -> DataFrame:
    """Rows of points with those of ranges (keys renamed to _key) of which one dyadic interval holds the point: once each, and with unit 1 only those that hold it.

    A point comes once for each level that ranges use; ranges are cut to the
    reach of the points first, so that an open end costs no levels. What meets
    in a key is what matches, however many rows the key has.
    """
    at, lo, hi = (_number(F.col(c), dict(df.dtypes)[c], unit) for c, df in ((point, points), (low, ranges), (high, ranges)))
    reach = points.agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    cut = ranges.withColumnsRenamed({k: f"_{k}" for k in keys}).crossJoin(F.broadcast(reach))  # one row
    cut = cut.withColumn("_bin", F.explode(_dyadic(F.greatest(lo, "_first"), F.least(hi, "_last")))).select("*", F.col("_bin.level").alias("_level"), F.col("_bin.node").alias("_node")).drop("_bin", "_first", "_last")
    levels = cut.agg(F.collect_set("_level").alias("_levels"))  # 64 at most
    spread = points.crossJoin(F.broadcast(levels)).withColumn("_own_level", F.explode("_levels")).drop("_levels")
    spread = spread.withColumn("_own_node", F.call_function("shiftright", at, F.col("_own_level")))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys], (F.col("_own_level") == F.col("_level")) & (F.col("_own_node") == F.col("_node")))
    return spread.join(cut, on).drop("_own_level", "_own_node", "_level", "_node")


def interval_contains(df: DataFrame, ranges: DataFrame, keys: list[str], point: str, low: str, high: str, unit: int = 1) -> DataFrame:
    """Each point with the ranges of its key that hold it; nulls are in none. unit: steps in which numbers are told apart before the exact comparison, such as 60_000_000 for timestamps of minutes."""
    met = meeting(df, ranges, keys, point, low, high, unit)
    return met.where(F.col(point).between(F.col(low), F.col(high))).drop(*[f"_{k}" for k in keys])


def interval_overlap(df: DataFrame, other: DataFrame, keys: list[str], own: tuple[str, str], theirs: tuple[str, str], unit: int = 1) -> DataFrame:
    """Pairs of ranges of a key that overlap: the later of the two begins within the earlier. Ranges that end before they begin overlap none."""
    later = meeting(other, df, keys, theirs[0], *own, unit).where(F.col(theirs[0]).between(*map(F.col, own)) & (F.col(theirs[0]) <= F.col(theirs[1])))
    earlier = meeting(df, other, keys, own[0], *theirs, unit).where((F.col(own[0]) > F.col(theirs[0])) & (F.col(own[0]) <= F.col(theirs[1])) & (F.col(own[0]) <= F.col(own[1])))
    columns = [*df.columns, *(c for c in other.columns if c not in keys)]
    return later.select(*columns).unionByName(earlier.select(*columns))


def interval_max(df: DataFrame, ranges: DataFrame, keys: list[str], point: str, low: str, high: str, row_key: list[str]) -> DataFrame:
    """Wide rows with the latest range start that holds them: the range join sees the keys only."""
    narrow = interval_contains(df.select(*keys, *row_key) if point in row_key else df.select(*keys, *row_key, point), ranges, keys, point, low, high)
    return df.join(narrow.groupBy(*row_key).agg(F.max(low).alias(low)), row_key, "left")


def trailing(df: DataFrame, keys: list[str], season: str, back: int) -> DataFrame:
    """Each (keys, season) with the rows of the seasons up to ``back`` before. The few offsets are spread out, so it stays an equality join."""
    steps = F.explode(F.array(*[F.lit(k) for k in range(back + 1)]))
    wanted = df.select(*keys, season).distinct().withColumn("_back", steps).withColumn("_from", F.col(season) - F.col("_back"))
    return wanted.drop("_back").join(df.withColumnRenamed(season, "_from"), [*keys, "_from"]).drop("_from")


def matched_pairs(df: DataFrame, keys: list[str], unit: str) -> DataFrame:
    """Rows of one unit with those of every other unit of the same keys; the other's columns are called other_*. All pairs of a key come out, so the key has to bound them: filter units by support first."""
    rest = [c for c in df.columns if c not in keys]
    return df.join(df.withColumnsRenamed({c: f"other_{c}" for c in rest}), keys).where(F.col(unit) != F.col(f"other_{unit}"))


def role_pairs(df: DataFrame, keys: list[str], one: Column, other: Column, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """One table in two roles, each cut down before the join. All pairs of a key come out, so the key has to bound them."""
    a = df.where(one).select(*keys, *[F.col(c).alias(names[0]) for c, names in columns.items()])
    b = df.where(other).select(*keys, *[F.col(c).alias(names[1]) for c, names in columns.items()])
    return a.join(b, keys)


def opponent(df: DataFrame, keys: list[str], member: str, stats: list[str]) -> DataFrame:
    """Each member of a pair with the stats of the other."""
    o = df.select(*keys, F.col(member).alias("_member"), *[F.col(c).alias(f"opponent_{c}") for c in stats])
    return df.join(o, keys).where(F.col(member) != F.col("_member")).drop("_member")


def state_lookup(df: DataFrame, matrix: DataFrame, key: str, value: str, columns: dict[str, str]) -> DataFrame:
    """A matrix looked up once for each of several state columns."""
    for state, name in columns.items():
        df = df.join(matrix.select(F.col(key).alias(state), F.col(value).alias(name)), state, "left")
    return df


def without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with no match; null keys of the other side match nothing."""
    return df.join(other.select(*keys).dropna(), keys, "left_anti")


def among(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys), keys, "left_semi")


def fallback(parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """The first source that has a key gives its row; ``source`` names it."""
    (name, out), *rest = parts.items()
    out = out.withColumn("source", F.lit(name))
    for name, df in rest:
        out = out.unionByName(df.join(out.select(*keys), keys, "left_anti").withColumn("source", F.lit(name)))
    return out


def string_range(df: DataFrame, ranges: DataFrame, code: str, low: str, high: str) -> DataFrame:
    """Text ranges that hold a code, for codes of digits only. Both sides meet on the first digit, so that no table needs to be sent everywhere."""
    digit = lambda c: F.substring(c, 1, 1).cast("int")
    spread = ranges.where(F.col(low).rlike("^[0-9]") & F.col(high).rlike("^[0-9]")).withColumn("_digit", F.explode(F.sequence(digit(low), digit(high))))
    told = F.when(F.col(code).rlike("^[0-9]+$"), digit(code))
    on = (F.col("_own") == F.col("_digit")) & F.col(code).between(F.col(low), F.col(high))
    return df.withColumn("_own", told).join(spread, on, "left").drop("_own", "_digit")


def resolve_alias(df: DataFrame, tables: list[tuple[DataFrame, list[str]]], value: str, default: Column) -> DataFrame:
    """Lookups tried in order: the first that has the row's keys gives its standard form."""
    names = []
    for k, (table, keys) in enumerate(tables):
        df = df.join(table.withColumnRenamed(value, f"_{value}{k}"), keys, "left")
        names.append(f"_{value}{k}")
    return df.withColumn(value, F.coalesce(*names, default)).drop(*names)


def boundaries(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds from_value and to_value of each step of an ordered chain."""
    return df.withColumn("from_value", F.col(value)).withColumn("to_value", F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)))


def as_of(df: DataFrame, moves: DataFrame, keys: list[str], date: str, moved: str, row_key: list[str]) -> DataFrame:
    """Each row with the latest dated move of its key that isn't after it: both tables in one order of dates, the last move carried on."""
    rows = df.select(*keys, *row_key, F.col(date).alias("_at"), F.lit(None).cast(dict(moves.dtypes)[moved]).alias("_moved"), F.lit(1).alias("_row"))
    steps = moves.select(*keys, F.col(moved).alias("_at"), F.col(moved).alias("_moved"), F.lit(0).alias("_row"))
    w = Window.partitionBy(*keys).orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0)
    line = rows.unionByName(steps, allowMissingColumns=True).withColumn(moved, F.last("_moved", ignorenulls=True).over(w))
    return df.join(line.where("_row = 1").select(*row_key, moved), row_key, "left")
