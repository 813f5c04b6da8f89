"""Mines hard negatives with an inverted multi-index.

Vectors are cut into two halves, each half has a codebook (k-means on a bounded
sample), and a pair of codewords is a cell. A codeword's radius is the greatest
distance of a half from it over all rows, so over a half an inner product with
a query is at most q.c + |q| * radius, and over a cell the sum of two such
bounds. Cells are visited in the order of these sums by a heap over the two
sorted lists of half bounds (a cell is pushed when both its predecessors are
out). A search for positives stops when the next bound is below the k-th score;
one for negatives when that holds for each of the anchor's score windows, full
ones by their last score and others by their lower end; cells whose lower bound
lies above all windows are passed over. So results are exact.

Cells are dealt into groups of about equal size, large cells over several; an
anchor is sent only to groups that have a cell whose bound reaches what the
sample (bounded, and sent to all tasks) shows it to need already. What tasks
find is ranked once more for each anchor.

Defined cases: components become floor(scale * x); rows with a null id or label,
a null vector or a null or non-finite component take no part; equal rows are
rows of their own (each is another's candidate); other rows of an anchor's id
are candidates too; vectors of another dimension aren't compared; ties go to the
smaller id; an anchor without positives, or a window without rows, gives no
rows; a negative positive score has an empty window; scores must fit a long; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parallelism, written
from .topk_search import by_dimension

#: Rows that the codebooks are learnt from, and codewords of a half.
SAMPLE, CODEWORDS, PASSES = 4096, 64, 8
#: Rows of the cells that are scored at a time, about.
RUN_ROWS = 512
#: Candidates of a group, at least and at most.
LEAST_ROWS, MOST_ROWS = 256, 50_000


def usable(vectors: DataFrame, label: Column, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """row (a number of its own), vec_id, label and v array<long> of the rows that take part."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    part = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & fine).select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("v"))
    return written(part.where("label IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "vectors")


def codewords(x: np.ndarray, k: int = CODEWORDS, passes: int = PASSES) -> np.ndarray:
    """k-means from evenly spread distinct rows; fewer words where there are fewer rows."""
    distinct = np.unique(x, axis=0)
    words = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)] if len(distinct) else np.zeros((1, x.shape[1]))
    for _ in range(passes):
        near = nearest(x, words)[0]
        counts = np.bincount(near, minlength=len(words))
        total = np.zeros(words.shape)
        np.add.at(total, near, x)
        words = np.where(counts[:, None] > 0, total / np.maximum(counts, 1)[:, None], words)
    return words


def nearest(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest word of each row, and the distance from it."""
    near = np.argmin((words**2).sum(1) - 2 * (x @ words.T), axis=1)
    return near, np.sqrt(((x - words[near]) ** 2).sum(1))


def visits(bounds1: np.ndarray, bounds2: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Pairs of places in the two lists, by falling sums of their bounds."""
    order1, order2 = np.argsort(-bounds1, kind="stable").tolist(), np.argsort(-bounds2, kind="stable").tolist()
    u, v = bounds1[order1].tolist(), bounds2[order2].tolist()
    heap, out = [(-(u[0] + v[0]), 0, 0)] if u and v else [], set()
    while heap:
        s, i, j = heapq.heappop(heap)
        out.add((i, j))
        yield order1[i], order2[j], -s
        if i + 1 < len(u) and (j == 0 or (i + 1, j - 1) in out):
            heapq.heappush(heap, (-(u[i + 1] + v[j]), i + 1, j))
        if j + 1 < len(v) and (i == 0 or (i - 1, j + 1) in out):
            heapq.heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))


@dataclass
class Books:
    """Codebooks of a dimension, with the radius of each word."""

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = x.shape[-1] // 2
        return x[..., :h], x[..., h:]

    def middles(self, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of each half: inner products of q with the words, and how far a row's may be from them (with slack for rounding)."""
        mid, off = [], []
        for part, words, radii in zip(self.halves(q.astype(np.float64)), self.words, self.radii):
            mid.append(words @ part)
            norm = float(np.linalg.norm(part))
            off.append(norm * radii + 1e-9 * (1 + norm * (radii + np.linalg.norm(words, axis=1))))
        return mid, off


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    if most < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


@dataclass
class Index:
    """What all tasks get: the codebooks, where cells lie, and the sample. Its size depends on the sample and the codebooks alone."""

    books: dict[int, Books]
    groups: dict[int, dict[tuple[int, int], tuple[int, int]]]  # dimension: cell: its first group and how many it is dealt over
    sample: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # dimension: rows, labels, vectors
    n_groups: int

    def reached(self, dim: int, q: np.ndarray, least: float) -> list[int]:
        """Groups that have a cell whose bound is ``least`` or more."""
        (m1, m2), (o1, o2) = self.books[dim].middles(q)
        own, found = self.groups[dim], set()
        for i, j, bound in visits(m1 + o1, m2 + o2):
            if bound < least:
                break
            if (i, j) in own:
                first, n = own[i, j]
                found.update(range(first, first + n))
        return sorted(found)


def build(rows: DataFrame, codewords_per_half: int = CODEWORDS) -> tuple[Index, DataFrame]:
    """The index, and the rows with g, the group they are in, and their cell (c1, c2)."""
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(SAMPLE).toPandas()
    sizes = sample["v"].map(len).to_numpy() if len(sample) else np.zeros(0, int)
    books, kept = {}, {}
    for dim in np.unique(sizes).tolist():
        own = sample[sizes == dim]
        x = np.array(own["v"].tolist(), np.int64).reshape(len(own), dim)
        kept[dim] = own["row"].to_numpy(np.int64), own["label"].to_numpy(np.int64), x
        h = dim // 2
        books[dim] = tuple(codewords(p.astype(np.float64), codewords_per_half) for p in (x[:, :h], x[:, h:]))
    sent = spark.sparkContext.broadcast(books)

    def assign(batches):
        for batch in batches:
            n = batch.num_rows
            dims, cells, far = np.zeros(n, np.int32), np.zeros((2, n), np.int32), np.zeros((2, n))
            for dim, at, x in by_dimension(batch):
                words = sent.value.get(dim) or tuple(np.zeros((1, k)) for k in (dim // 2, dim - dim // 2))
                dims[at] = dim
                for k, part in enumerate((x[:, : dim // 2], x[:, dim // 2 :])):
                    cells[k, at], far[k, at] = nearest(part.astype(np.float64), words[k])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "vec_id", "label", "v")), *map(pa.array, (dims, *cells, *far))], ["row", "vec_id", "label", "v", "dim", "c1", "c2", "far1", "far2"])

    placed = written(rows.select("row", "vec_id", "label", "v").mapInArrow(assign, "row long, vec_id long, label long, v array<long>, dim int, c1 int, c2 int, far1 double, far2 double"), "cells")
    cells = placed.groupBy("dim", "c1", "c2").agg(F.count("*").alias("n"), F.max("far1").alias("r1"), F.max("far2").alias("r2")).orderBy("dim", "c1", "c2").collect()
    total = sum(r["n"] for r in cells)
    most = max(LEAST_ROWS, min(MOST_ROWS, -(-total // parallelism(rows))))
    index, group, filled, salts = Index({}, {}, kept, 0), 0, 0, []
    for r in cells:
        dim = r["dim"]
        if dim not in index.books:
            words = books.get(dim) or tuple(np.zeros((1, k)) for k in (dim // 2, dim - dim // 2))
            index.books[dim], index.groups[dim] = Books(words, tuple(np.zeros(len(w)) for w in words)), {}
            group, filled = group + (filled > 0), 0
        for k in (0, 1):
            radii = index.books[dim].radii[k]
            radii[r[f"c{k + 1}"]] = max(radii[r[f"c{k + 1}"]], r[f"r{k + 1}"])
        n = -(-r["n"] // most)
        if filled and (n > 1 or filled + r["n"] > most):
            group, filled = group + 1, 0
        index.groups[dim][r["c1"], r["c2"]] = group, n
        salts.append((dim, r["c1"], r["c2"], group, n))
        filled += r["n"]
        if n > 1:
            group, filled = group + n, 0
    index.n_groups = group + (filled > 0)
    where = spark.createDataFrame(salts, "dim int, c1 int, c2 int, first int, n int")
    g = (F.col("first") + F.pmod(F.xxhash64("row"), F.col("n"))).cast("int").alias("g")
    return index, placed.join(F.broadcast(where), ["dim", "c1", "c2"]).select(g, "row", "vec_id", "label", "v", "c1", "c2")  # a row for each cell: as many as the codebooks make


class Group:
    """Candidates of a group and dimension, by cell."""

    def __init__(self, table: pa.RecordBatch, rows: np.ndarray, x: np.ndarray, books: Books):
        c1, c2, self.row, self.ids, self.label = (table.column(c).to_numpy()[rows] for c in ("c1", "c2", "row", "vec_id", "label"))
        order = np.lexsort((self.label, c2, c1))
        self.row, self.ids, self.label, self.x = self.row[order], self.ids[order], self.label[order], x[order]
        c1, c2 = c1[order], c2[order]
        self.own1, self.own2, self.books = np.unique(c1), np.unique(c2), books
        starts = np.flatnonzero(np.append(True, (np.diff(c1) != 0) | (np.diff(c2) != 0)))
        self.cells = {(a, b): slice(s, e) for a, b, s, e in zip(c1[starts].tolist(), c2[starts].tolist(), starts.tolist(), np.append(starts[1:], len(c1)).tolist())}

    def runs(self, q: np.ndarray, top: float = np.inf) -> Iterator[tuple[np.ndarray, float]]:
        """Rows of cells in the order of their upper bounds, a run of cells at a time, with the first of the bounds; cells whose lower bound is above top are passed over."""
        (m1, m2), (o1, o2) = self.books.middles(q)
        u, v = self.own1, self.own2
        low1, low2, own1, own2 = (m1 - o1)[u].tolist(), (m2 - o2)[v].tolist(), u.tolist(), v.tolist()
        starts, stops, rows, first = [], [], 0, 0.0
        for i, j, bound in visits((m1 + o1)[u], (m2 + o2)[v]):
            cell = self.cells.get((own1[i], own2[j]))
            if cell is None or low1[i] + low2[j] > top:
                continue
            if not starts:
                first = bound
            starts.append(cell.start)
            stops.append(cell.stop)
            rows += cell.stop - cell.start
            if rows >= RUN_ROWS:
                yield _ranges(starts, stops), first
                starts, stops, rows = [], [], 0
        if starts:
            yield _ranges(starts, stops), first

    def positives(self, row: int, label: int, q: np.ndarray, least: float, k: int) -> tuple[np.ndarray, ...]:
        """row, id and score of the k best other rows of the label, as far as they reach ``least``."""
        best = _none()
        for at, bound in self.runs(q):
            if bound < (max(least, best[2][-1]) if len(best[2]) == k else least):
                break
            at = at[(self.label[at] == label) & (self.row[at] != row)]
            best = self._better(best, at, products(self.x[at], q), k)
        return best

    def negatives(self, label: int, q: np.ndarray, windows: list[tuple[int, int, float]], k: int) -> list[tuple[np.ndarray, ...]]:
        """For each window (low, high, score to reach): row, id and score of the k best rows of other labels in it."""
        best = [_none() for _ in windows]
        need = lambda w, b: max(w[0], w[2], b[2][-1] if len(b[2]) == k else w[0])
        for at, bound in self.runs(q, max(high for _, high, _ in windows)):
            if all(bound < need(w, b) for w, b in zip(windows, best)):
                break
            at = at[self.label[at] != label]
            scores = products(self.x[at], q)
            for n, w in enumerate(windows):
                fine = (scores >= need(w, best[n])) & (scores <= w[1])
                if fine.any():
                    best[n] = self._better(best[n], at[fine], scores[fine], k)
        return best

    def _better(self, best, at: np.ndarray, scores: np.ndarray, k: int):
        rows, ids, got = np.append(best[0], self.row[at]), np.append(best[1], self.ids[at]), np.append(best[2], scores)
        order = np.lexsort((rows, ids, -got))[:k]
        return rows[order], ids[order], got[order]


def _ranges(starts: list[int], stops: list[int]) -> np.ndarray:
    sizes = np.subtract(stops, starts)
    ends = np.cumsum(sizes)
    return np.repeat(np.subtract(starts, ends - sizes), sizes) + np.arange(ends[-1])


def _none() -> tuple[np.ndarray, ...]:
    return tuple(np.zeros(0, np.int64) for _ in range(3))


ASKED = "row long, label long, v array<long>, low array<long>, high array<long>, least array<double>"


def _routed(anchors: DataFrame, sent, k: int) -> DataFrame:
    """Anchors, one for each group that they reach, with the score that each of their windows has to reach."""

    def work(batches):
        index = sent.value
        for batch in batches:
            row, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
            lows, highs = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            g, again, leasts = [], [], []
            for dim, at, x in by_dimension(batch):
                rows, labels, vectors = index.sample.get(dim, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
                for i, q in zip(at.tolist(), x):
                    scores, least = products(vectors, q), []
                    if lows[i] is None:
                        own = np.sort(scores[(labels == label[i]) & (rows != row[i])])
                        least.append(float(own[-k]) if len(own) >= k else -np.inf)
                    else:
                        for low, high in zip(lows[i], highs[i]):
                            own = np.sort(scores[(labels != label[i]) & (scores >= low) & (scores <= high)])
                            least.append(float(max(low, own[-k])) if len(own) >= k else float(low))
                    to = index.reached(dim, q, min(least))
                    g += to
                    again += [i] * len(to)
                    leasts += [least] * len(to)
            taken = pa.array(again, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), *(batch.column(c).take(taken) for c in ("row", "label", "v", "low", "high")), pa.array(leasts, pa.list_(pa.float64()))], ["g", "row", "label", "v", "low", "high", "least"])

    return anchors.select("row", "label", "v", "low", "high").mapInArrow(work, "g int, " + ASKED)


def _searched(placed: DataFrame, asked: DataFrame, sent, k: int) -> DataFrame:
    """anchor, window, row, vec_id and score: what each group finds for each anchor sent to it. Candidates come first in a group, and anchors go past them."""
    columns = [F.col("g"), F.lit(0).alias("asks"), *(F.col(c) for c in ("row", "vec_id", "label", "v", "c1", "c2"))]
    for c in ("low", "high", "least"):
        columns.append(F.lit(None).cast(dict(asked.dtypes)[c]).alias(c))
    questions = asked.select("g", F.lit(1).alias("asks"), "row", F.lit(0).cast("long").alias("vec_id"), "label", "v", F.lit(0).alias("c1"), F.lit(0).alias("c2"), "low", "high", "least")
    n_groups = sent.value.n_groups

    def answers(part: pa.RecordBatch, held: dict[int, Group]):
        row, label = part.column("row").to_numpy(), part.column("label").to_numpy()
        lows, highs, leasts = (part.column(c).to_pylist() for c in ("low", "high", "least"))
        out = []
        for dim, at, x in by_dimension(part):
            if dim not in held:
                continue
            for i, q in zip(at.tolist(), x):
                if lows[i] is None:
                    found = [held[dim].positives(row[i], label[i], q, leasts[i][0], k)]
                else:
                    found = held[dim].negatives(label[i], q, [*zip(lows[i], highs[i], leasts[i])], k)
                out += [(row[i], n, *f) for n, f in enumerate(found) if len(f[0])]
        if out:
            sizes = [len(o[2]) for o in out]
            columns = [np.repeat([o[c] for o in out], sizes) for c in (0, 1)] + [np.concatenate([o[c] for o in out]) for c in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "window", "row", "vec_id", "score"])

    def work(batches):
        now, parts, held = None, [], {}
        for batch in batches:
            group, asks = batch.column("g").to_numpy(), batch.column("asks").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(group) != 0) | (np.diff(asks) != 0)) + 1, [batch.num_rows]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if group[a] != now:
                    now, parts, held = group[a], [], {}
                if not asks[a]:
                    parts.append(batch.slice(a, b - a))
                    continue
                if parts:
                    table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    held, parts = {dim: Group(table, rows, x, sent.value.books[dim]) for dim, rows, x in by_dimension(table)}, []
                yield from answers(batch.slice(a, b - a), held)

    stream = placed.select(*columns).unionByName(questions).repartition(max(1, n_groups), "g").sortWithinPartitions("g", "asks")
    return stream.mapInArrow(work, "anchor long, window long, row long, vec_id long, score long")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, asks: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, codewords_per_half: int = CODEWORDS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows as usable() returns them; asks is a condition on vec_id that tells the
    anchors. A negative's score is low to high hundredths of its positive's.
    """
    index, placed = build(rows, codewords_per_half)
    sent = rows.sparkSession.sparkContext.broadcast(index)
    anchors = rows.where(asks)
    none = F.lit(None).cast("array<long>")
    found = _searched(placed, _routed(anchors.withColumns({"low": none, "high": none}), sent, n_positives), sent, n_positives)
    positives = written(_ranked(found, ["anchor"], n_positives).select("anchor", F.col("row").alias("positive_row"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    p = F.col("positive_score")
    # Equal positive scores share a window.
    windows = positives.select("anchor", p.alias("positive_score"), F.expr(f"-((-{low} * positive_score - pmod(-{low} * positive_score, 100)) DIV 100)").alias("low"), F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) DIV 100").alias("high"))
    windows = windows.where("low <= high").distinct().groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("positive_score", "low", "high"))).alias("w"))
    open_ = written(anchors.join(windows.withColumnRenamed("anchor", "row"), "row").select("row", "vec_id", "label", "v", "w"), "windows")
    asked = _routed(open_.select("row", "label", "v", F.col("w.low").alias("low"), F.col("w.high").alias("high")), sent, n_negatives)
    negatives = _ranked(_searched(placed, asked, sent, n_negatives), ["anchor", "window"], n_negatives)
    named = open_.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("w").alias("window", "w")).select("anchor", "anchor_id", F.col("window").cast("long").alias("window"), "w.positive_score")
    out = named.join(negatives, ["anchor", "window"]).join(positives, ["anchor", "positive_score"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def oracle(label: str, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> str:
    """The op12 query's rows in DuckDB SQL; label is an expression."""
    return f"""
WITH fine AS (
  SELECT row_number() OVER () AS own, vec_id, {label} AS label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.own, a.vec_id AS anchor_id, c.own AS other, c.vec_id, a.label = c.label AS same, coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM fine a JOIN fine c ON c.own <> a.own AND len(c.v) = len(a.v) WHERE a.vec_id % {every} = 0
), positives AS (
  SELECT own, anchor_id, other AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) <= {n_positives}
), ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.own, p.positive ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.own = p.own AND NOT s.same AND {low} * positive_score <= 100 * s.score AND 100 * s.score <= {high} * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {n_negatives}
"""
