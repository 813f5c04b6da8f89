"""State values, shrunken rates and adjustment factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import matched_pairs
from .sets import expanded
from .windows import FIRST, NOW, islands, leader_gap, over


def state_matrix(df: DataFrame, states: list[str], outcome: Column, keep: Column | None = None) -> DataFrame:
    """Mean, variance and number of an outcome by state, over groups that are whole."""
    rows = df if keep is None else df.where(keep)
    return rows.groupBy(*states).agg(F.avg(outcome).alias("mean"), F.var_samp(outcome).alias("variance"), F.count("*").alias("n"))


def shrunken_rates(df: DataFrame, narrow: list[str], broad: list[str], success: Column, prior: float = 10.0) -> DataFrame:
    """(successes + prior * broad rate) / (n + prior) for each narrow state; broad columns are among the narrow ones or follow from them."""
    keys = list(dict.fromkeys([*narrow, *broad]))
    fine = df.groupBy(*keys).agg(F.sum(success.cast("int")).alias("_s"), F.count("*").alias("n"))
    coarse = fine.groupBy(*broad).agg((F.sum("_s") / F.sum("n")).alias("_rate"))
    return fine.join(coarse, broad).withColumn("rate", (F.col("_s") + F.col("_rate") * prior) / (F.col("n") + prior)).drop("_s", "_rate")


def transition_values(df: DataFrame, matrix: DataFrame, state: str, start: str, end: str, reward: Column, value: str = "mean") -> DataFrame:
    """value(end) + reward - value(start); an end that isn't in the matrix is worth nothing."""
    look = lambda name, c: matrix.select(F.col(state).alias(name), F.col(value).alias(c))
    joined = df.join(look(start, "_a"), start, "left").join(look(end, "_b"), end, "left")
    return joined.withColumn("change", reward + F.coalesce("_b", F.lit(0.0)) - F.col("_a")).drop("_a", "_b")


def leverage(df: DataFrame, start: str, end: str, change: Column) -> DataFrame:
    """Mean absolute change from each start state, over its pairs, relative to that of all."""
    pairs = df.groupBy(start, end).agg(F.avg(F.abs(change)).alias("_m"), F.count("*").alias("_n"))
    each = pairs.groupBy(start).agg((F.sum(F.col("_m") * F.col("_n")) / F.sum("_n")).alias("swing"), F.sum("_n").alias("n"))
    total = each.agg((F.sum(F.col("swing") * F.col("n")) / F.sum("n")).alias("_all"))
    return each.crossJoin(total).withColumn("leverage", F.try_divide(F.col("swing"), F.col("_all"))).drop("_all")


def linear_weights(df: DataFrame, period: str, play: str, value: str, support: int, baseline: str) -> DataFrame:
    """Mean value of each play by period where it has more than ``support`` rows, else over all periods; less the period's mean; and relative to a baseline play."""
    own = df.groupBy(period, play).agg(F.avg(value).alias("_own"), F.count("*").alias("n")).where(F.col("n") > support)
    ever = df.groupBy(play).agg(F.avg(value).alias("_ever"))
    mean = df.groupBy(period).agg(F.avg(value).alias("_mean"))
    grid = mean.crossJoin(ever).join(own, [period, play], "left")
    valued = grid.withColumns({"imputed": F.col("_own").isNull(), "weight": F.coalesce("_own", "_ever") - F.col("_mean")})
    base = F.max(F.when(F.col(play) == baseline, F.col("weight"))).over(over([period]))
    return valued.withColumn("relative", F.col("weight") - base).select(period, play, "imputed", "weight", "relative")


def unknown_shares(df: DataFrame, unit: str, role: str, surplus: str, rate: str) -> DataFrame:
    """Spreads each unit's unexplained credit over roles: surplus (never below 0) times the role's rate, as a share of the unit's sum; positive rows only."""
    estimate = F.greatest(F.lit(0.0), F.col(surplus)) * F.col(rate)
    shared = df.withColumn("_e", estimate).withColumn("share", F.try_divide(F.col("_e"), F.sum("_e").over(over([unit]))))
    return shared.where("_e > 0").drop("_e")


def factor_basic(df: DataFrame, keys: list[str], unit: str, season: str, value: str, size: str) -> DataFrame:
    """How much more of a value a unit gives than the others meet with the same members.

    df has a row for each unit, season and keys. Values by size over three
    seasons' rows, held to 0.1 to 1 of the largest; weights are the square root
    of the smaller size.
    """
    w = over([*keys, unit], [season], (-2, 0))
    rates = df.withColumns({"_v": F.sum(value).over(w), "_s": F.sum(size).over(w)}).withColumn("rate", F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.try_divide(F.col("_v"), F.col("_s")))))
    pairs = matched_pairs(rates.where("rate IS NOT NULL").select(*keys, season, unit, "rate", F.col("_s").alias("size")), [*keys, season], unit)
    weight = F.sqrt(F.least(F.col("size"), F.col("other_size")).cast("double"))
    return pairs.groupBy(unit, season).agg((F.sum(F.col("rate") * weight) / F.sum(F.col("other_rate") * weight)).alias("factor"))


def factor_variant(df: DataFrame, keys: list[str], unit: str, season: str, stats: list[str], size: str, back: int = 2, prior: float = 1000.0, least: int = 25, odds: bool = True) -> DataFrame:
    """Factors for several stats at once, with a trailing range of seasons and a prior.

    Units with more than ``least`` rows count. To each unit and season comes a
    row of ``prior`` rows at the overall mean, which is paired with the other
    units' priors; each opposing unit weighs the same. odds: ratios of odds, not
    of rates.
    """
    w = over([*keys, unit], [season], ranges=(-back, 0))
    enough = df.groupBy(unit, season).agg(F.sum(size).alias("_n")).where(F.col("_n") > least).select(unit, season)
    own = df.join(enough, [unit, season]).select(*[F.col(k).cast("string").alias(k) for k in keys], unit, season, F.sum(size).over(w).cast("double").alias(size), *[F.sum(c).over(w).cast("double").alias(c) for c in stats])
    mean = df.groupBy(season).agg(*[(F.sum(c) / F.sum(size)).alias(c) for c in stats])
    priors = enough.join(mean, season).select(*[F.lit("prior").alias(k) for k in keys], unit, season, F.lit(prior).alias(size), *[(F.col(c) * prior).alias(c) for c in stats])
    pairs = matched_pairs(own.unionByName(priors), [*keys, season], unit).withColumn("_w", F.least(F.col(size), F.col(f"other_{size}")))
    total = pairs.withColumn("_own", F.sum("_w").over(over([unit, season, f"other_{unit}"])))
    even = total.withColumn("_w", F.col("_w") * F.max("_own").over(over([unit, season])) / F.col("_own"))

    def mean_rate(stat: str, n: str) -> Column:
        return F.sum(F.col(stat) / F.col(n) * F.col("_w")) / F.sum("_w")

    def ratio(stat: str) -> Column:
        a, b = mean_rate(stat, size), mean_rate(f"other_{stat}", f"other_{size}")
        return F.round(F.try_divide(F.try_divide(a, 1 - a), F.try_divide(b, 1 - b)) if odds else F.try_divide(a, b), 2)

    return even.groupBy(unit, season).agg(*[ratio(c).alias(f"{c}_factor") for c in stats])


def paired_factors(df: DataFrame, units: DataFrame, unit: str, season: str, group: list[str], members: list[str], split: list[str], stats: list[str], size: str, back: int = 2, prior: float = 1000.0, odds: bool = True) -> DataFrame:
    """Factors of units by season and group, from the same members in other units, for several statistics.

    df has counts by unit, season, group, members (and split); units lists the
    unit, season and group that get a factor, each from its ``back`` seasons
    before and its own. To each comes a row of ``prior`` at its season's mean,
    which meets the other units' priors. Each opposing unit weighs the same.
    The rows of the same members in a season come together in one row: as many as
    there are units.
    """
    c, of = F.col, [unit, season, *group]
    later = F.explode(F.sequence(c(season), c(season) + back))
    ranged = df.withColumn(season, later).join(units, of, "left_semi").groupBy(*of, *[c(k).cast("string").alias(k) for k in members], *split).agg(*[F.sum(k).cast("double").alias(k) for k in (size, *stats)])
    mean = ranged.groupBy(season, *group, *split).agg(*[(F.sum(k) / F.sum(size)).alias(k) for k in stats])
    priors = units.join(mean, [season, *group]).select(*of, *[F.lit("prior").alias(k) for k in members], *split, F.lit(prior).alias(size), *[(c(k) * prior).alias(k) for k in stats])
    rows = ranged.unionByName(priors)
    met = rows.groupBy(season, *members, *split).agg(F.collect_list(F.struct(unit, *group, size, *stats)).alias("_units"))
    own = met.select(season, *split, F.explode("_units").alias("_own"), "_units").select(season, *split, "_own.*", F.explode("_units").alias("_o"))
    pairs = own.where(c(unit) != c(f"_o.{unit}")).select(*of, *split, size, *stats, c(f"_o.{unit}").alias("_other"), *[c(f"_o.{k}").alias(f"_{k}") for k in (size, *stats)]).withColumn("_w", F.sqrt(F.least(c(size), c(f"_{size}"))))
    total = pairs.withColumn("_sum", F.sum("_w").over(over([*of, "_other"])))
    even = total.withColumn("_even", c("_w") * F.max("_sum").over(over(of)) / c("_sum"))

    def ratio(stat: str) -> Column:
        a, b = (F.sum(c(x + stat) / c(x + size) * c("_even")) / F.sum("_even") for x in ("", "_"))
        both = [F.try_divide(r, 1 - r) if odds else r for r in (a, b)]
        return F.round(F.round(F.try_divide(*both), 9), 2).alias(f"{stat}_factor")

    return even.groupBy(*of, *split).agg(F.round(F.sum("_w"), 0).alias("sqrt_sample_size"), *[ratio(k) for k in stats])


def factor_merge(advanced: DataFrame, basic: DataFrame, keys: list[str], factor: str) -> DataFrame:
    """The advanced factor where there is one, else the basic one."""
    return basic.join(advanced.withColumnRenamed(factor, "_a"), keys, "left").withColumn(factor, F.coalesce("_a", factor)).drop("_a")


def share_chain(df: DataFrame, actor: str, place: str, outcome: Column) -> DataFrame:
    """An actor's part in an outcome: its share of each place's rows times the place's share of the outcome, over places."""
    by_actor = df.groupBy(actor, place).agg(F.count("*").alias("_n"))
    by_place = df.groupBy(place).agg(F.count("*").alias("_all"), F.count_if(outcome).alias("_hits"))
    total = by_place.agg(F.sum("_hits").alias("_total"))
    joined = by_actor.join(by_place, place).crossJoin(total)
    return joined.groupBy(actor).agg(F.sum(F.col("_n") / F.col("_all") * F.col("_hits") / F.col("_total")).alias("blame"))


def pythagorean(scored: Column, allowed: Column, power: float = 1.85) -> Column:
    return F.try_divide(F.pow(scored, F.lit(power)), F.pow(scored, F.lit(power)) + F.pow(allowed, F.lit(power)))


def standings(games: DataFrame, keys: list[str], table: list[str], day: str, game: str, win: str, team: str) -> DataFrame:
    """The table on every day of a season: wins and losses to date (w, l), the current streak (below 0 for losses), wins of the last ten, leader and games behind.

    keys tell a team's season, and table which teams are ranked together. A
    day of several games shows how things stood after the last one.
    """
    c = F.col
    numbered = games.withColumns({"_k": F.row_number().over(over(keys, [day, game]))} | {n: F.sum(F.when(c(win) == v, 1).otherwise(0)).over(over(keys, [day, game], (FIRST, NOW))) for n, v in (("w", True), ("l", False))})
    runs = islands(numbered, keys, ["_k"], c(win))
    after = runs.withColumns({"streak": F.when(c(win), c("length")).otherwise(-c("length")), "last_10": F.sum(c(win).cast("int")).over(over(keys, ["_k"], (-9, 0)))})
    values = ["w", "l", "streak", "last_10"]
    last = after.groupBy(*keys, day).agg(F.max_by(F.struct(*values), "_k").alias("_s")).select(*keys, day, "_s.*")
    steps = last.withColumns({"_next": F.lead(day).over(over(keys, [day])), "_first": F.lag(day).over(over(keys, [day])).isNull()})
    grid = expanded(steps, keys, day, values, 1)
    # Before the first game there is no streak.
    played = (c("w") + c("l")) > 0
    return leader_gap(grid.withColumns({n: F.when(played, c(n)) for n in ("streak", "last_10")}), [*table, day], "w", "l", team)
