"""What the text operators share.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; ``bytes.split()``
splits on exactly these six bytes, so it is used on the UTF-8 form of a text.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time; a longer text is worked on alone.
SLICE_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about SLICE_BYTES of text at most."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(sizes.tolist()):
            if total + n > SLICE_BYTES and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(sizes) > start:
            yield batch.slice(start)


def let_go() -> None:
    """Gives memory that a task no longer needs back to the system, as workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def map_texts(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over bounded slices of the binary column ``text``."""

    def run(batches):
        try:
            yield from work(slices(batches))
        finally:
            let_go()

    return df.mapInArrow(run, schema)


def list_column(values, offsets, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see; in a local session without one, as in tests, a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df under the shared folder and reads it again."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def parallelism(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
