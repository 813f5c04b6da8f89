"""Writing tables: full rebuilds, views, versioned publishing, tuned files, and a guard before publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Rebuilds the table at path entirely and reads it again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A model that is never stored: a view of the plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish(df: DataFrame, root: str, version: int, keep: int = 5) -> DataFrame:
    """Writes ``root/v=<version>`` with zstd and deletes all but the last ``keep`` versions."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/v={version}")
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(base)]
    for old in sorted(int(n[2:]) for n in names if n[:2] == "v=" and n[2:].isdigit())[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/v={old}"), True)
    return spark.read.parquet(f"{root}/v={version}")


def export_tuned(df: DataFrame, path: str, codec: str = "zstd", block_bytes: int = 128 << 20) -> DataFrame:
    """A table's own codec and row-group size."""
    df.write.mode("overwrite").option("compression", codec).option("parquet.block.size", block_bytes).parquet(path)
    return df.sparkSession.read.parquet(path)


def require_tables(spark: SparkSession, names: list[str]) -> None:
    """Raises if a table is missing or empty."""
    bad = [n for n in names if not spark.catalog.tableExists(n) or spark.table(n).isEmpty()]
    if bad:
        raise ValueError(f"missing or empty: {', '.join(bad)}")
