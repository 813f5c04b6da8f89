"""Models by name. A model is a function of the catalogue, from which it takes its inputs by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODELS: dict[str, Callable[[Catalogue], DataFrame]] = {}


class Catalogue:
    """Tables by name: those given, and models made from them when first asked for. All are lazy plans."""

    def __init__(self, **tables: DataFrame):
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or not (name in self._tables or name in MODELS):
            raise AttributeError(name)
        if name not in self._tables:
            self._tables[name] = MODELS[name](self)
        return self._tables[name]


def model(f: Callable[[Catalogue], DataFrame] | None = None, *, key: str | None = None, placed: bool = False):
    """Registers a model. key: what its table is bucketed by, if not by play or game; placed: its rows come out by the key already, and aren't moved again to be written."""
    if f is None:
        return lambda f: model(f, key=key, placed=placed)
    if f.__name__ in MODELS:
        raise ValueError(f"two models named {f.__name__}")
    f.key, f.placed = key, placed
    MODELS[f.__name__] = f
    return f


def flag(condition: Column | str) -> Column:
    """1 where the condition holds, else 0 (also where it can't be told)."""
    c = F.expr(condition) if isinstance(condition, str) else condition
    return F.when(c, 1).otherwise(0).cast("long")


def flags(**conditions: str | Column) -> list[Column]:
    return [flag(c).alias(n) for n, c in conditions.items()]


def sums(stats: list[str]) -> list[Column]:
    return [F.expr(f"sum(`{c}`) AS `{c}`") for c in stats]
