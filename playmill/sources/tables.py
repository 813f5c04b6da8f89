"""Reading registered sources, typing them, and closed value domains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_sources(spark: SparkSession, registry: dict[str, str], root: str) -> dict[str, DataFrame]:
    """Every registered source (name -> path under root), read lazily and made a view of its name."""
    found = {}
    for name, path in registry.items():
        found[name] = spark.read.parquet(f"{root}/{path}")
        found[name].createOrReplaceTempView(name.replace(".", "_"))
    return found


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts the named columns and leaves the others."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def enum_domain(parts: list[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct non-null values of several columns, as ``value``."""
    each = [df.select(F.col(c).alias("value")) for df, c in parts]
    return reduce(DataFrame.union, each).where("value IS NOT NULL").distinct()


def enum_violations(df: DataFrame, column: str, domain: DataFrame) -> DataFrame:
    """Rows whose value is not null and outside the domain."""
    return df.where(F.col(column).isNotNull()).join(domain.select(F.col("value").alias(column)), column, "left_anti")


def read_seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A headed CSV of declared types; empty and blank cells are null, the text NA is a value."""
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    raw = spark.read.option("header", True).option("nullValue", "").schema(text).csv(path)
    return raw.select(*[F.when(F.trim(f.name) != "", F.col(f.name)).cast(f.dataType).alias(f.name) for f in wanted])


def load_transfers(spark: SparkSession, path: str, schema: str, kinds: list[str]) -> DataFrame:
    """Transfer records with a full date and an eight-character id, of the given kinds, between two different teams."""
    df = spark.read.schema(schema).csv(path)
    return df.where(transfer_filter(kinds))


def transfer_filter(kinds: list[str], date: str = "primary_date", player: str = "player_id", kind: str = "txn_type", old: str = "from_team", new: str = "to_team") -> Column:
    full = F.col(date).rlike("^[0-9]{8}$") & ~F.col(date).rlike("(0000|00)$")
    return full & (F.length(player) == 8) & F.col(kind).isin(kinds) & (F.col(old) != F.col(new))


def parse_tagged(df: DataFrame, column: str, tag: str, names: list[str]) -> DataFrame:
    """Adds the comma-separated payload of ``tag=...`` in a free-text column as columns of the given names."""
    payload = F.nullif(F.regexp_extract(column, rf"{tag}=([^;]*)", 1), F.lit(""))
    return df.withColumns({n: F.nullif(F.trim(F.split_part(payload, F.lit(","), F.lit(i + 1))), F.lit("")) for i, n in enumerate(names)})
