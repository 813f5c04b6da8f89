"""Labelled documents: all of them, or a bounded, reproducible sample and a fit on it."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let_go, map_texts, text_bytes

#: Bytes of features of a class that a fit takes at most.
MOST_BYTES = 96 << 20
#: Bits that tell in the map which ids have no label, so that few texts without one are shuffled.
MARKS = 1 << 24


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(divisor))


def known_labels(labels: DataFrame, label: str, allowed: Column) -> DataFrame:
    """doc_id and label (0 or 1, the larger of several) of the allowed rows that have both."""
    return labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & allowed).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def possible(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The rows whose doc_id may be known: all that are, and those whose hash has the mark of another. The marks have a fixed size, MARKS bits."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKS)) + 1  # noqa: E731  from 1, as the bitmap functions number
    marks = known.select(place("doc_id").alias("place")).groupBy(F.bitmap_bucket_number("place").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits"))
    at = F.bitmap_bit_position(place("doc_id"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = docs.withColumn("_bucket", F.bitmap_bucket_number(place("doc_id"))).join(F.broadcast(marks), "_bucket")
    return marked.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*docs.columns)


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text (bytes) and label of every document with a known label; rows of one id are one document, that with the smallest text."""
    met = docs.select("doc_id", text_bytes("text").alias("text")).join(known, "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text (bytes) and label of up to per_class labelled documents of each class, chosen by a hash of the id, and how many labels each class has.

    Labels are counted over all rows; only ids are sorted, and the sampled ids
    (at most 2 * per_class) are what is broadcast. Rows of one id are one
    document, that with the smallest text.
    """
    known = known_labels(labels, label, allowed)
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))
    return labelled(docs, chosen), sizes


def fitted(sample: DataFrame, features: Callable, fields: str, fit: Callable[[pa.Table], object]):
    """What fit makes of the sample's features, or None of an empty one.

    features maps batches (doc_id, label, text) to batches of doc_id, label,
    n_bytes and ``fields``, in the tasks that hold the texts. Of each class rows
    are taken in order of a hash of the id until MOST_BYTES are reached. One
    task fits on what is left, in order of the id; only the model comes to the
    driver, and a lost task fits the same again.
    """
    kind = dict(sample.dtypes)["doc_id"]
    made = map_texts(sample, features, f"doc_id {kind}, label int, n_bytes long, {fields}")
    total = F.sum("n_bytes").over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    bounded = made.where(F.col("n_bytes") <= MOST_BYTES).withColumn("total", total).where(F.col("total") <= MOST_BYTES).drop("total", "n_bytes")

    def work(table: pa.Table) -> pa.Table:
        model = pickle.dumps(fit(table.sort_by("doc_id").combine_chunks()))
        del table
        let_go()
        return pa.table({"model": pa.array([model], pa.binary())})

    found = bounded.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(work, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None
