"""Window operators over ordered groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST, LAST, NOW = Window.unboundedPreceding, Window.unboundedFollowing, Window.currentRow


def over(keys: list, order: list = (), rows: tuple | None = None, ranges: tuple | None = None):
    w = Window.partitionBy(*keys)
    w = w.orderBy(*order) if order else w
    return w.rowsBetween(*rows) if rows else w.rangeBetween(*ranges) if ranges else w


def rest_of_group(value: Column, keys: list, order: list) -> Column:
    return F.sum(value).over(over(keys, order, (NOW, LAST)))


def running_by_side(value: Column, side: Column, keys: list, order: list) -> tuple[Column, Column]:
    """A side's total before and after each row."""
    own = F.when(side, value).otherwise(0)
    end = F.sum(own).over(over(keys, order, (FIRST, NOW)))
    return end - own, end


def last_of_group(value: Column, keys: list, order: list) -> Column:
    """The group's outcome on each of its rows."""
    return F.last(value).over(over(keys, order, (NOW, LAST)))


def forward_fill(value: Column, keys: list, order: list) -> Column:
    return F.last(value, ignorenulls=True).over(over(keys, order, (FIRST, NOW)))


def previous_known(value: Column, keys: list, order: list) -> Column:
    return F.last(value, ignorenulls=True).over(over(keys, order, (FIRST, -1)))


def islands(df: DataFrame, keys: list, order: list, state: Column, island: str = "island", length: str = "length") -> DataFrame:
    """Numbers the runs of equal state in each group, and each row's place in its run."""
    changed = F.when(state.eqNullSafe(F.lag(state).over(over(keys, order))), 0).otherwise(1)
    marked = df.withColumn("_new", changed).withColumn(island, F.sum("_new").over(over(keys, order, (FIRST, NOW))))
    return marked.withColumn(length, F.row_number().over(over([*keys, island], order))).drop("_new")


def streaks(df: DataFrame, keys: list, order: list, win: Column, number: str) -> DataFrame:
    """streak_id (the row number where the run of wins began, null otherwise) and streak_length (0 otherwise)."""
    starts = F.when(win & ~F.coalesce(F.lag(win).over(over(keys, order)), F.lit(False)), F.col(number))
    filled = df.withColumn("_start", starts).withColumn("streak_id", F.when(win, forward_fill(F.col("_start"), keys, order)))
    return filled.withColumn("streak_length", F.when(win, F.row_number().over(over([*keys, "streak_id"], order))).otherwise(0)).drop("_start")


def next_start(df: DataFrame, keys: list, start: str, end: str) -> DataFrame:
    """Distinct ranges whose end is one before the next larger start, or their own last end."""
    ahead = F.min(start).over(over(keys, [start], ranges=(1, LAST)))
    return df.groupBy(*keys, start).agg(F.max(end).alias(end)).withColumn(end, F.coalesce(ahead - 1, F.col(end)))


def share(value: Column, keys: list) -> Column:
    return F.try_divide(value, F.sum(value).over(over(keys)))


def grand_share(df: DataFrame, value: str, name: str) -> DataFrame:
    """Each row's share of the total of all rows, by a one-row total rather than a window without keys."""
    return df.crossJoin(df.agg(F.sum(value).alias("_total"))).withColumn(name, F.try_divide(F.col(value), F.col("_total"))).drop("_total")


def chain_groups(df: DataFrame, keys: list, order: list, closes: Column, name: str = "chain") -> DataFrame:
    """Numbers the chains that rows matching ``closes`` end; such a row belongs to the chain it ends."""
    counted = df.withColumn("_n", F.sum(closes.cast("int")).over(over(keys, order, (FIRST, NOW))))
    return counted.withColumn(name, F.lag("_n", 1, 0).over(over(keys, order))).drop("_n")


def dedupe(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key; order has to break ties in full."""
    return df.withColumn("_n", F.row_number().over(over(keys, order))).where("_n = 1").drop("_n")


def drop_ambiguous(df: DataFrame, keys: list) -> DataFrame:
    return df.withColumn("_n", F.count("*").over(over(keys))).where("_n = 1").drop("_n")


def min_support(df: DataFrame, keys: list, more_than: int) -> DataFrame:
    return df.withColumn("_n", F.count("*").over(over(keys))).where(F.col("_n") > more_than).drop("_n")


def row_numbers(df: DataFrame, order: list[str], name: str, sample: int = 2000) -> DataFrame:
    """Numbers from 1 in the order of columns (nulls first), without gathering the table.

    A bounded sample, the rows of smallest hash, gives bounds once; a row's
    range is told by comparing it with these, so it is the same wherever and
    however often it is worked out. Ranges are counted, and rows numbered inside
    theirs. Rows equal in all columns of the order share a range, and any order.
    """
    at = lambda: F.struct(*order)
    few = df.select(*order).distinct().orderBy(F.xxhash64(*order), *order).limit(sample).orderBy(*order).collect()
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = [few[k] for k in sorted({len(few) * i // n for i in range(1, n)} - {0})]
    spark, kinds = df.sparkSession, df.select(*order).schema
    edges = spark.createDataFrame(bounds, kinds).coalesce(1).agg(F.array_sort(F.collect_list(at())).alias("_edges"))  # one row
    ranged = df.crossJoin(F.broadcast(edges)).withColumn("_p", F.size(F.filter("_edges", lambda e: e <= at()))).drop("_edges")
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    # A row for each range: as many as the session has shuffle partitions.
    before = F.broadcast(sizes.select(F.col("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(FIRST, -1)), F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_i", inside).join(before, "_p").withColumn(name, F.col("_before") + F.col("_i")).drop("_p", "_i", "_before")


def leader_gap(df: DataFrame, keys: list, wins: str, losses: str, entity: str) -> DataFrame:
    """Adds leader and games_behind from the largest margin of each snapshot (ties to the smaller entity)."""
    margin = F.col(wins) - F.col(losses)
    best = df.groupBy(*keys).agg(F.max(margin).alias("_best"), F.min_by(entity, F.struct(-margin, F.col(entity))).alias("leader"))
    return df.join(best, keys).withColumn("games_behind", F.greatest(F.lit(0.0), (F.col("_best") - margin) / 2)).drop("_best")


def mean_one(df: DataFrame, weight: str, name: str) -> DataFrame:
    """Weights divided by their mean over all rows."""
    return df.crossJoin(df.agg(F.avg(weight).alias("_mean"))).withColumn(name, F.try_divide(F.col(weight), F.col("_mean"))).drop("_mean")


def spells(df: DataFrame, group: list, order: str, holder: str, starter: str, margin_start: str, margin_end: str, outs: str, runners: str) -> DataFrame:
    """Save situations of holders who take turns in a group; all flags are false where they can't be told.

    Entry and exit come from the neighbours in the group; what a holder was
    eligible for on entry is carried through all of its rows in the group and
    looked at one row later.
    """
    w, spell = over(group, [order]), [*group, holder]
    before, after = F.lag(holder).over(w), F.lead(holder).over(w)
    c = F.col
    df = df.withColumns({"_prev": before, "_next": after, "_next_runners": F.lead(runners).over(w)})
    df = df.withColumns({"entered": c("_prev").isNull() | (c("_prev") != c(holder)), "exited": c("_next").isNotNull() & (c("_next") != c(holder)), "finished": c("_next").isNull()})
    is_starter = F.coalesce(c(holder) == c(starter), F.lit(False))
    starter_left = c("entered") & F.coalesce(c("_prev") == c(starter), F.lit(False))
    relief = c("entered") & ~is_starter & ~(starter_left & (c(outs) < 15)) & (c(margin_start) < 0)
    close = relief & (c(margin_start) >= -3) & ((c(outs) <= 24) | (c(outs) % 3 == 0))
    tying = relief & (c(margin_start) >= -5) & (c(margin_start) + c(runners) + 2 >= 0)
    long = F.when(relief, c(outs) <= 18)
    df = df.withColumns({"_situation": F.when(c("entered"), close | tying), "_long": F.when(c("entered"), long), "_eligible": F.when(c("entered"), close | tying | F.coalesce(long, F.lit(False)))})
    for name in ("_situation", "_long", "_eligible"):
        df = df.withColumn(name, forward_fill(c(name), spell, [order]))
    v = over(spell, [order])
    df = df.withColumns({name: F.lag(name).over(v) for name in ("_situation", "_long", "_eligible")} | {"_margin": F.lag(margin_end).over(v)})
    breach = (c(margin_end) >= 0) & ~F.coalesce(c("_margin") >= 0, F.lit(False))
    flags = {
        "inherited": F.when(c("entered"), c(runners)).otherwise(0), "left_over": F.when(c("exited"), c("_next_runners")).otherwise(0),
        "hold": c("_situation") & c("exited") & (c(margin_end) < 0), "save": c("_eligible") & c("finished") & (c(margin_end) < 0),
        "blown": c("_eligible") & breach, "blown_long": c("_long") & ~c("_situation") & breach,
    }
    out = df.withColumns({n: f if n in ("inherited", "left_over") else F.coalesce(f, F.lit(False)) for n, f in flags.items()})
    return out.drop("_prev", "_next", "_next_runners", "_situation", "_long", "_eligible", "_margin")
