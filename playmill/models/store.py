"""Models as written tables.

A ``Store`` is a catalogue that writes a model when another first asks for it,
from the written tables that the model reads itself. So no plan is deeper than
one model, each table is worked out once, and a lost executor costs a task of
one model. Tables with an event key are bucketed by it, those with a game (and
no event) by the game, both sorted, so that joins of event tables with each
other, and of game tables with each other, move no rows. With ``by_season``
tables that have a season are also kept in a folder for each.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .catalogue import MODELS, Catalogue

#: What tables are bucketed by: the first of these that they have.
KEYS = ("event_key", "game_id")
SEASON = "season"


#: With it a query's shuffle files go when it ends, instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession):
    """What is written meanwhile leaves no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


class Store(Catalogue):
    """Tables by name: those given, and models, written under ``folder`` and read again."""

    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, DataFrame], buckets: int | None = None, by_season: bool = False):
        super().__init__()
        self._tables = tables
        self._spark, self._folder, self._by_season = spark, folder.rstrip("/"), by_season
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._prefix, self._open = "m" + uuid.uuid4().hex[:12], []
        #: Models in the order in which they were written: each after all that it reads.
        self.order: list[str] = []

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in self._tables or name not in MODELS:
            return super().__getattr__(name)
        if name in self._open:
            raise ValueError("models read each other: " + " -> ".join([*self._open[self._open.index(name) :], name]))
        self._open.append(name)
        try:
            self._tables[name] = self._written(name, MODELS[name](self))
        finally:
            self._open.pop()
        self.order.append(name)
        return self._tables[name]

    def plan(self, name: str) -> DataFrame:
        """A model from written tables; itself it is read if it is written, and else not written."""
        return getattr(self, name) if name in self._tables or name not in MODELS else MODELS[name](self)

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        key = getattr(MODELS[name], "key", None) or next((k for k in KEYS if k in df.columns), None)
        if key and not getattr(MODELS[name], "placed", False):
            df = df.repartition(self._buckets, key)
        out = df.write.format("parquet").option("path", f"{self._folder}/{name}").mode("overwrite")
        if key:
            out = out.bucketBy(self._buckets, key).sortBy(key)
        if self._by_season and SEASON in df.columns:
            out = out.partitionBy(SEASON)
        table = f"{self._prefix}_{name}"
        with freed(self._spark):
            out.saveAsTable(table)
        return self._spark.table(table).select(*[f"`{c}`" for c in df.columns])

    def close(self) -> None:
        """Takes the tables out of the session; their files stay."""
        for name in self.order:
            self._spark.sql(f"DROP TABLE IF EXISTS {self._prefix}_{name}")
            self._tables.pop(name, None)
        self.order.clear()


def build(spark: SparkSession, tables: dict[str, DataFrame], folder: str, names: list[str] | None = None, **layout) -> Store:
    """Writes the models of these names (all, if none are told) and what they read, each once."""
    store = Store(spark, folder, tables, **layout)
    for name in names or [n for n in MODELS if n not in tables]:
        getattr(store, name)
    return store
