"""Mixing sources to target weights.

The words of each source, its documents in order of a hash of the id (or of the
whole row), are packed end to end into blocks of ``block_words`` words (in a source of under 256 such blocks, of
a 256th of its words, so that any target can be met closely). Output shards draw how many blocks they
take from each source; the draws are multinomial, conditioned on each source's
total, so that the mix meets its targets. The slots of a source number its
blocks through a pseudorandom permutation, a new one for each pass over the
source, and slots and blocks are joined by number.

The draw is a tree: the blocks of a source are halved over halves of the shards,
each half's binomial share drawn from a generator seeded by its place. A task
works out a range of a source's slots, going down only where the range is, so
tasks need nothing from each other and a lost one redraws the same.

Defined cases: a null text has no words, and a document without words takes
none; a null source is a source of its own and comes last; rows of equal id and
text are told apart only by their order, which doesn't matter; an empty table
gives empty results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, parallelism, text_bytes, written

#: Documents in a bucket of the running sum, on average, and buckets in a group of them.
BUCKET, BUCKETS = 2048, 4096
#: Slots that a row of the draw stands for, and such rows in a task, about.
RANGE, RANGES = 65_536, 16


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (3, 1, 2)  # of the sources in order, repeating
    share: float = 1.5  # the mix's size as a multiple of all words
    most: float = 2.0  # no source, and no document, more often than this
    block_words: int = 64
    shard_blocks: int = 65_536  # of an output shard, on average
    seed: int = 5


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", order: Column | None = None) -> DataFrame:
    """doc_id, source, place (a long that orders the documents; a hash of the id unless told) and size, the number of words, of every document."""

    def work(batches):
        for batch in batches:
            sizes = pa.array([len(x.split()) for x in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), batch.column("place"), sizes], ["doc_id", "source", "place", "size"])

    kind = dict(docs.dtypes)[id_col]
    place = F.xxhash64(F.col(id_col).cast("string")) if order is None else order
    return map_texts(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), place.alias("place"), text_bytes(text_col).alias("text")), work, f"doc_id {kind}, source string, place long, size long")


def targets(sizes: dict[int, int], s: Settings) -> dict[int, float]:
    """Target of each source, by its rank: the mix shared by weight, sources at their most set aside until none is above."""
    weight = {k: s.weights[k % len(s.weights)] for k in sizes}
    left, open_, out = s.share * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weight[k] for k in open_)
        over = {k for k in open_ if left * weight[k] / total > s.most * sizes[k]}
        if not over:
            out |= {k: left * weight[k] / total for k in open_}
            break
        out |= {k: s.most * sizes[k] for k in over}
        left -= sum(s.most * sizes[k] for k in over)
        open_ -= over
    return out


def _source_table(counts: DataFrame, s: Settings) -> DataFrame:
    """A row for each source: rank, source_size, n_docs, target and its blocks.

    Sources are few beside documents: the table is grouped before, and the
    shares of all sources depend on each other, so they are settled together.
    """
    per = counts.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    ranked = per.withColumn("rank", F.row_number().over(order) - 1)

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        goal = targets(dict(zip(frame["rank"].tolist(), frame["source_size"].tolist())), s)
        frame["target"] = [float(goal[k]) for k in frame["rank"].tolist()]
        return frame.drop(columns="one")

    schema = "source string, source_size long, n_docs long, rank int, target double"
    settled = ranked.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(settle, schema)
    settled = settled.withColumn("block_words", F.greatest(F.lit(1), F.least(F.lit(s.block_words), F.floor(F.col("source_size") / 256))).cast("int"))
    blocks = F.ceil(F.col("source_size") / F.col("block_words"))
    # The last block may be short; a source at its most takes all of its blocks that often.
    wanted = F.round(F.col("target") / F.col("source_size") * blocks)
    return settled.withColumns({
        "n_blocks": blocks.cast("long"),
        "n_slots": F.when(F.col("source_size") > 0, F.least(wanted, F.floor(F.lit(s.most)) * blocks)).otherwise(0).cast("long"),
    })


@dataclass
class Plan:
    """sources: a row a source. docs: a row a document with its first word's place in the source. slots: a row an output slot."""

    sources: DataFrame
    docs: DataFrame
    slots: DataFrame


def plan(docs: DataFrame, settings: Settings = Settings(), **columns) -> Plan:
    """Draws the mix. Sizes of documents, without texts, and the table of sources are written and read again."""
    s = settings
    counts = written(word_counts(docs, **columns), "mix-sizes")
    sources = written(_source_table(counts, s), "mix-sources")
    small = sources.select("source", "rank", "n_docs", "block_words")
    placed = counts.join(small, counts.source.eqNullSafe(small.source)).drop(small.source)
    # A running sum by levels: within buckets of about BUCKET documents, over BUCKETS of them, and over those of a source.
    bucket = F.pmod("place", F.ceil(F.col("n_docs") / BUCKET))
    placed = placed.withColumns({"bucket": bucket, "many": F.floor(bucket / BUCKETS)})
    before = lambda keys, order: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = lambda value, keys, order: F.coalesce(F.sum(value).over(before(keys, order)), F.lit(0))
    buckets = placed.groupBy("rank", "many", "bucket").agg(F.sum("size").alias("inside"))
    groups = buckets.groupBy("rank", "many").agg(F.sum("inside").alias("inside"))
    groups = groups.select("rank", "many", running("inside", ["rank"], ["many"]).alias("far"))
    starts = buckets.withColumn("near", running("inside", ["rank", "many"], ["bucket"])).join(groups, ["rank", "many"]).select("rank", "bucket", (F.col("near") + F.col("far")).alias("base"))
    within = placed.withColumn("start", running("size", ["rank", "bucket"], ["place", "size", "doc_id"]))
    placed = within.join(starts, ["rank", "bucket"]).select("doc_id", "rank", "size", "block_words", (F.col("base") + F.col("start")).alias("start"))
    return Plan(sources, written(placed, "mix-places"), _slots(sources, s))


def _slots(sources: DataFrame, s: Settings) -> DataFrame:
    """rank, shard, place in the shard's share of the source, pass over the source, block."""
    n_slots, n_ranges = sources.agg(F.coalesce(F.sum("n_slots"), F.lit(0)), F.coalesce(F.sum(F.ceil(F.col("n_slots") / RANGE)), F.lit(0))).first()
    n_shards = max(1, -(-n_slots // s.shard_blocks))
    numbers = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_slots") / RANGE) - 1)).alias("number")
    ranges = sources.where("n_slots > 0").select("rank", "n_blocks", "n_slots", numbers)

    def work(frames):
        for frame in frames:
            for r in frame.itertuples():
                rank, n_blocks, total = int(r.rank), int(r.n_blocks), int(r.n_slots)
                first, last = int(r.number) * RANGE, min(total, (int(r.number) + 1) * RANGE)
                drawn = draw(total, n_shards, (s.seed, rank), first, last)
                each = [min(last, a + n) - max(first, a) for _, a, n in drawn]
                shard, start = (np.repeat([d[k] for d in drawn], each) for k in (0, 1))
                slot = np.arange(first, last)
                turn = slot // n_blocks
                yield pd.DataFrame({"rank": rank, "shard": shard, "place": slot - start, "turn": turn, "block": permuted(slot % n_blocks, turn, n_blocks, (s.seed, rank))})

    tasks = max(1, min(int(n_ranges), max(parallelism(sources), int(n_ranges) // RANGES)))
    return ranges.repartition(tasks, "rank", "number").mapInPandas(work, "rank int, shard long, place long, turn long, block long")


def draw(total: int, shards: int, seed: tuple[int, ...], first: int, last: int) -> list[tuple[int, int, int]]:
    """(shard, how much the shards before it drew, what it drew) of those shards that drew slots from first to last (exclusive).

    A multinomial draw of equal chances, the same whatever range is asked for.
    """
    out, todo = [], [(0, shards, 0, total)]
    while todo:
        low, high, start, count = todo.pop()
        if start >= last or start + count <= first or not count:
            continue
        if high - low == 1:
            out.append((low, start, count))
            continue
        middle = (low + high) // 2
        left = int(np.random.default_rng([*seed, low, high]).binomial(count, (middle - low) / (high - low)))
        todo += [(middle, high, start + left, count - left), (low, middle, start, left)]
    return out


def permuted(index: np.ndarray, turn: np.ndarray, size: int, seed: tuple[int, ...]) -> np.ndarray:
    """A permutation of range(size), another for each turn: four Feistel rounds, walked until inside the range."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    key = turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(sum((x + 1) * 0x100000001B3**k for k, x in enumerate(seed)) & (2**64 - 1))

    def once(x: np.ndarray, key: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            z = (right + key + np.uint64(r + 1)) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((z >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64), key)
    while (over := out >= np.uint64(size)).any():
        out[over] = once(out[over], key[over])
    return out.astype(np.int64)


def _pieces(p: Plan) -> DataFrame:
    """A row for each block that a document has words in: which words (first, n_words). rank and start tell the document."""
    n = F.col("block_words")
    block = F.explode(F.sequence(F.floor(F.col("start") / n), F.floor((F.col("start") + F.col("size") - 1) / n))).alias("block")
    cut = p.docs.where("size > 0").select("*", block)
    low = F.greatest(F.col("start"), F.col("block") * n)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * n)
    return cut.select("rank", "block", "start", (low - F.col("start")).alias("first"), (high - low).alias("n_words"))


def taken_words(p: Plan) -> DataFrame:
    """doc_id, rank, size and taken: the words that the mix takes of each document, repeats counted."""
    picks = p.slots.groupBy("rank", "block").agg(F.count("*").alias("times"))
    # The planner can't tell how many slots the draw makes, so it is told not to broadcast what comes of them.
    taken = _pieces(p).join(picks.hint("merge"), ["rank", "block"]).groupBy("rank", "start").agg(F.sum(F.col("n_words") * F.col("times")).alias("taken"))
    with_words = p.docs.where("size > 0").join(taken.hint("merge"), ["rank", "start"], "left")
    return with_words.select("doc_id", "rank", "size", F.coalesce("taken", F.lit(0)).alias("taken")).union(p.docs.where("size <= 0").select("doc_id", "rank", "size", F.lit(0)))


def mixture(p: Plan) -> DataFrame:
    """Every output slot with what fills it: shard, rank, place, turn, and the document's start, first and n_words."""
    return p.slots.hint("merge").join(_pieces(p), ["rank", "block"])


def mixed_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The mix as documents: each document once for each pass that takes words of it, its text the words taken, in order.

    A text taken whole stays as it is; of one taken in part the words are joined
    by spaces. n_chars follows the text. Rows are told apart by a number of
    their own, but their order in the mix goes by a hash of all they hold, so
    that runs over the same rows agree. Columns keep whatever names they have.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = written(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("number")), "mix-docs")
    p = plan(numbered.select("number", "row.text", "row.source", F.xxhash64("row").alias("hash")), settings, id_col="number", order=F.col("hash"))
    spans = F.array_sort(F.collect_list(F.struct("first", "n_words"))).alias("spans")
    passes = mixture(p).groupBy("rank", "start", "turn").agg(spans, F.sum("n_words").alias("n"))
    sized = p.docs.where("size > 0").select(F.col("doc_id").alias("number"), "rank", "start", "size")
    keyed = numbered.hint("merge").join(passes.hint("merge").join(sized, ["rank", "start"]).select("number", "spans", "n", "size"), "number")
    old = F.col("row.text")
    words = F.regexp_extract_all(old, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = F.flatten(F.transform("spans", lambda x: F.slice(words, (x["first"] + 1).cast("int"), x["n_words"].cast("int"))))
    text = F.when(F.col("n") < F.col("size"), F.array_join(chosen, " ")).otherwise(old)
    mixed = keyed.select("row", text.alias("text"))
    own = {"text": F.col("text"), "n_chars": F.length("text")}
    return mixed.select(*[own.get(c, F.col(f"row.`{c}`")).cast(kind).alias(c) for c, kind in docs.dtypes])
