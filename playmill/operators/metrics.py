"""A registry of measures: sums, ratios of sums, and measures derived from measures."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    """One of: formula (an aggregate), numerator and denominator (stats, or expressions over a row, or lists of these, whose sums are divided, times scale), or derived (of other measures)."""

    name: str
    kind: str
    source: str = "season"
    formula: Callable[[], Column] | None = None
    numerator: tuple[str, ...] | None = None
    denominator: tuple[str, ...] | None = None
    scale: float = 1.0
    derived: Callable[..., Column] | None = None
    uses: tuple[str, ...] = ()

    def __post_init__(self):
        forms = [self.formula is not None, self.numerator is not None and self.denominator is not None, self.derived is not None]
        if sum(forms) != 1:
            raise ValueError(f"{self.name}: exactly one form is needed")

    @property
    def form(self) -> str:
        return "sum" if self.formula else "ratio" if self.numerator else "derived"

    def column(self) -> Column:
        if self.formula:
            return self.formula()
        # One text an expression: tables have hundreds of measures, and each call to the planner costs.
        total = lambda names: "CAST(" + " ".join(f"- sum({n[1:]})" if n[0] == "-" else f"+ sum({n})" for n in names).lstrip("+ ") + " AS DOUBLE)"
        return F.expr(f"try_divide({total(self.numerator)} * {float(self.scale)!r}D, {total(self.denominator)})")


@dataclass
class Registry:
    metrics: dict[tuple[str, str], Metric] = field(default_factory=dict)

    def add(self, *metrics: Metric) -> Registry:
        for m in metrics:
            if (m.kind, m.name) in self.metrics:
                raise ValueError(f"{m.kind}/{m.name} is there already")
            self.metrics[m.kind, m.name] = m
        return self

    def of(self, kind: str, source: str | None = None) -> list[Metric]:
        return [m for (k, _), m in self.metrics.items() if k == kind and source in (None, m.source)]

    def evaluate(self, df: DataFrame, keys: list[str], metrics: list[Metric], extra: list[Column] = ()) -> DataFrame:
        """Base measures in one aggregation, derived ones after what they use; columns in the order of ``metrics``."""
        by_name = {m.name: m for m in metrics}
        done, doing = {m.name for m in metrics if m.form != "derived"}, set()
        steps: list[Metric] = []

        def visit(m: Metric) -> None:
            if m.name in done:
                return
            if m.name in doing:
                raise ValueError(f"{m.name} depends on itself")
            doing.add(m.name)
            for u in m.uses:
                if u not in by_name:
                    raise ValueError(f"{m.name} uses {u}, which isn't known")
                visit(by_name[u])
            done.add(m.name)
            steps.append(m)

        for m in metrics:
            visit(m)
        base = [*extra, *[m.column().alias(m.name) for m in metrics if m.form != "derived"]]
        out = df.groupBy(*keys).agg(*base) if base else df.select(*keys).distinct()
        while steps:  # those that use nothing that is still to come go together
            waiting = {m.name for m in steps}
            now = [m for m in steps if not waiting & set(m.uses)]
            out = out.withColumns({m.name: m.derived(*[F.col(u) for u in m.uses]) for m in now})
            steps = [m for m in steps if m not in now]
        kept = [c for c in out.columns if c not in by_name]
        return out.select(*kept, *[m.name for m in metrics])

    def classify(self, spark: SparkSession) -> DataFrame:
        """kind, name and form of every measure."""
        return spark.createDataFrame([(k, n, m.form) for (k, n), m in self.metrics.items()], "kind string, name string, form string")


def ratio(name: str, kind: str, over: str | tuple, under: str | tuple, scale: float = 1.0, source: str = "season") -> Metric:
    as_tuple = lambda x: (x,) if isinstance(x, str) else tuple(x)
    return Metric(name, kind, source, numerator=as_tuple(over), denominator=as_tuple(under), scale=scale)


def basic_offense(kind: str = "offense") -> list[Metric]:
    """Rates of batting totals."""
    bb_k = ("at_bats", "-strikeouts", "-home_runs", "sacrifice_flies")
    return [
        ratio("batting_average", kind, "hits", "at_bats"),
        ratio("on_base_percentage", kind, "on_base_successes", "on_base_opportunities"),
        ratio("slugging_percentage", kind, "total_bases", "at_bats"),
        Metric("on_base_plus_slugging", kind, derived=lambda a, b: a + b, uses=("on_base_percentage", "slugging_percentage")),
        Metric("isolated_power", kind, derived=lambda s, a: s - a, uses=("slugging_percentage", "batting_average")),
        ratio("secondary_average", kind, ("total_bases", "-hits", "walks", "stolen_bases", "-caught_stealing"), "at_bats"),
        ratio("batting_average_on_balls_in_play", kind, ("hits", "-home_runs"), bb_k),
        *[ratio(f"{n}_rate", kind, s, "plate_appearances") for n, s in (("home_run", "home_runs"), ("walk", "walks"), ("strikeout", "strikeouts"))],
        ratio("stolen_base_percentage", kind, "stolen_bases", ("stolen_bases", "caught_stealing")),
    ]


def basic_pitching(kind: str = "pitching") -> list[Metric]:
    """Rates of pitching totals; per nine innings means per 27 outs."""
    nine = [("earned_run_average", "earned_runs"), ("run_average", "runs"), ("walks_per_9", "walks"), ("strikeouts_per_9", "strikeouts"), ("home_runs_per_9", "home_runs"), ("hits_per_9", "hits")]
    return [
        *[ratio(n, kind, s, "outs_recorded", 27.0) for n, s in nine],
        ratio("whip", kind, ("walks", "hits"), "outs_recorded", 3.0),
        ratio("strikeout_to_walk_ratio", kind, "strikeouts", "walks"),
        *[ratio(f"{n}_rate", kind, s, "batters_faced") for n, s in (("walk", "walks"), ("strikeout", "strikeouts"), ("home_run", "home_runs"))],
        ratio("batting_average_against", kind, "hits", "at_bats"),
        ratio("on_base_percentage_against", kind, "on_base_successes", "on_base_opportunities"),
        ratio("slugging_percentage_against", kind, "total_bases", "at_bats"),
        Metric("on_base_plus_slugging_against", kind, derived=lambda a, b: a + b, uses=("on_base_percentage_against", "slugging_percentage_against")),
        ratio("batting_average_on_balls_in_play_against", kind, ("hits", "-home_runs"), ("at_bats", "-strikeouts", "-home_runs", "sacrifice_flies")),
    ]


def basic_fielding(kind: str = "fielding") -> list[Metric]:
    return [
        ratio("fielding_percentage", kind, ("putouts", "assists"), ("putouts", "assists", "errors")),
        ratio("range_factor", kind, ("putouts", "assists"), "outs_played", 27.0),
        Metric("innings_played", kind, formula=lambda: F.sum("outs_played") / F.lit(3.0)),
    ]


def category_shares(kind: str, names: list[str], total: str, known: str, out: str, hit: str, source: str = "event") -> list[Metric]:
    """For each category: its share of the rows of known category, its hits to outs, and how often it is known at all."""
    rows = [m for n in names for m in (ratio(f"{n}_rate", kind, n, known, source=source), ratio(f"{n}_out_hit_ratio", kind, f"{n}_{out}", f"{n}_{hit}", source=source))]
    return [*rows, ratio("known_rate", kind, known, total, source=source)]


def coverage_weighted(name: str, kind: str, hit_rate: str, out_rate: str, out_hit_ratio: str) -> Metric:
    """h R / (h R + o): what share of a category's rows are hits once recording rates are evened out."""
    return Metric(name, kind, "event", derived=lambda h, o, r: F.try_divide(h * r, h * r + o), uses=(hit_rate, out_rate, out_hit_ratio))


def baserunning(kind: str = "baserunning") -> list[Metric]:
    return [*[ratio(f"{b}_attempt_rate", kind, f"{b}_attempts", f"{b}_opportunities", source="event") for b in ("second", "third", "home")], ratio("unforced_out_rate", kind, "unforced_outs", "times_on_base", source="event")]


def pitch_sequence(kind: str = "pitching") -> list[Metric]:
    pairs = {"strike": "strikes", "swing": "swings", "contact": "contacts", "called_strike": "called_strikes", "in_play": "balls_in_play", "first_pitch_strike": "first_pitch_strikes", "whiff": "whiffs"}
    return [*[ratio(f"{n}_rate", kind, s, "pitches", source="event") for n, s in pairs.items()], ratio("pitch_data_coverage", kind, "plate_appearances_with_pitches", "plate_appearances", source="event")]


def metric_table(registry: Registry, kind: str, keys: list[str], seasons: DataFrame, events: DataFrame, unit: str) -> DataFrame:
    """Measures of the season account with those of the event account beside; keys without events stay.

    coverage_rate is the share of the season account's units that the events have, 0 without any.
    """
    left = registry.evaluate(seasons, keys, registry.of(kind, "season"), [F.count_distinct(unit).alias("_units")])
    right = registry.evaluate(events, keys, registry.of(kind, "event"), [F.count_distinct(unit).alias("_event_units")])
    joined = left.join(right, keys, "left")
    coverage = F.coalesce(F.try_divide(F.col("_event_units").cast("double"), F.col("_units").cast("double")), F.lit(0.0))
    return joined.withColumn("coverage_rate", coverage).drop("_units", "_event_units")


def query(registry: Registry, df: DataFrame, kind: str, dimensions: list[str], measures: list[str], where: Column | None = None) -> DataFrame:
    """Any measures by any dimensions over rows that pass a filter."""
    wanted = {m.name: m for m in registry.of(kind)}
    names = list(dict.fromkeys(n for m in measures for n in (*wanted[m].uses, m)))
    return registry.evaluate(df if where is None else df.where(where), dimensions, [wanted[n] for n in names]).select(*dimensions, *measures)


def ask(registry: Registry, kind: str, accounts: dict[str, DataFrame], lookups: list[tuple[DataFrame, list[str]]], dimensions: list[str], measures: list[str], where: Column | None = None) -> DataFrame:
    """Measures of several accounts by any dimensions, those of lookups included.

    Measures are closed over what they use; each base measure is worked out in
    its own account (its ``source``), and an account takes part only if one is
    asked of it. A dimension that an account lacks comes from the first lookup
    (a table and the keys that tell its rows) that has it. Accounts meet on the
    dimensions, nulls with nulls, and measures derived from several accounts
    come last. where is a condition on the dimensions and the accounts' columns
    that all of them have.
    """
    known, order = {m.name: m for m in registry.of(kind)}, []

    def close(name: str, path: tuple[str, ...] = ()) -> None:
        if name in path:
            raise ValueError(" uses ".join([*path, name]))
        if name not in known:
            raise ValueError(f"{kind} has no measure {name}")
        for used in known[name].uses:
            close(used, (*path, name))
        if name not in order:
            order.append(name)

    def reach(df: DataFrame, wanted: str) -> DataFrame:
        if wanted in df.columns:
            return df
        for table, keys in lookups:
            if wanted in table.columns:
                for key in keys:
                    df = reach(df, key)
                new = [c for c in table.columns if c not in keys and c not in df.columns]
                return df.join(table.select(*keys, *new), keys, "left")
        raise ValueError(f"no table has {wanted}")

    for m in measures:
        close(m)
    parts = []
    for source, df in accounts.items():
        own = [known[n] for n in order if known[n].form != "derived" and known[n].source == source]
        if own:
            for d in dimensions:
                df = reach(df, d)
            parts.append(registry.evaluate(df if where is None else df.where(where), dimensions, own))
    if not parts:
        raise ValueError("no measure is asked for")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    base = [n for n in order if known[n].form != "derived"]
    out = every.groupBy(*dimensions).agg(*[F.max(n).alias(n) for n in base]) if len(parts) > 1 else every
    for n in order:
        if known[n].form == "derived":
            out = out.withColumn(n, known[n].derived(*[F.col(u) for u in known[n].uses]))
    return out.select(*dimensions, *measures)
