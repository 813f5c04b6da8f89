"""Exact search for the highest inner products, pruned by segment statistics.

A vector cut into segments has a mean and a deviation in each. Over a segment
the inner product is at most (length * mean * mean + deviation * deviation), so
the statistics bound the score from above (and the distance from below). Bounds
are taken with few segments first and with more for what is left; only vectors
whose bound reaches the query's k-th best score so far are scored exactly.

Candidates are dealt into groups once, and stay there; queries go round all
groups. A task holds a group's candidates with their statistics, takes queries
a batch at a time, and passes on k rows a query.

Defined cases: components become floor(scale * x); vectors that are null, or
hold a null or non-finite component, or whose id is null take no part; of equal
rows each is a candidate of the others (and a query, if it asks); other rows of
a query's id are candidates too; vectors of another dimension aren't compared;
ties go to the smaller id; scores must fit a long; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parallelism

CHUNK = 4096
#: Distinct rows of a candidate group, on average.
GROUP_ROWS = 100_000


def quantised(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v array<long> and times, how many rows are equal, of the vectors that take part."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & fine).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("times"))


class Segments:
    """Means (times length) and deviations of rows of vectors, for coarser to finer cuts."""

    def __init__(self, vectors: np.ndarray):
        dim, levels, n = vectors.shape[1], [], 4
        while n <= dim // 2:
            levels.append(n)
            n *= 2
        x, self.levels = vectors.astype(np.float64), []
        for n in levels:
            starts = np.array([dim * k // n for k in range(n)])
            sizes = np.diff(np.append(starts, dim))
            mean = np.add.reduceat(x, starts, axis=1) / sizes
            spread = np.add.reduceat((x - np.repeat(mean, sizes, axis=1)) ** 2, starts, axis=1)
            self.levels.append((mean, np.sqrt(spread), sizes))


def _slack(q: np.ndarray, x: np.ndarray) -> float:
    """More than what rounding takes from a bound."""
    return 1e-9 * (1 + float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1]))


class Group:
    """Candidates of one dimension in chunks, with their statistics."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, times: np.ndarray):
        order = np.argsort(ids, kind="stable")
        cuts = [order[a : a + CHUNK] for a in range(0, len(ids), CHUNK)]
        self.chunks = [(ids[c], vectors[c], times[c], Segments(vectors[c])) for c in cuts]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (ids, scores) of its k best, in order; the query itself is left out once."""
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        of_queries = Segments(queries)
        for ids, x, times, stats in self.chunks:
            slack, coarse = _slack(queries, x), None
            if stats.levels:
                (qm, qd, sizes), (xm, xd, _) = of_queries.levels[0], stats.levels[0]
                coarse = (qm * sizes) @ xm.T + qd @ xd.T + slack
            low, high = np.searchsorted(ids, query_ids), np.searchsorted(ids, query_ids, "right")
            for i, q in enumerate(queries):
                got_ids, got = best[i]
                own = [j for j in range(low[i], high[i]) if np.array_equal(x[j], q)]
                left = np.delete(np.arange(len(ids)), [j for j in own if times[j] < 2])

                def scored(rows, q=q, own=own):
                    often = np.minimum(times[rows] - np.isin(rows, own), k) if own else np.minimum(times[rows], k)
                    return _kept(np.append(got_ids, np.repeat(ids[rows], often)), np.append(got, np.repeat(x[rows] @ q, often)), k)

                if coarse is not None and len(left) > k:
                    bound = coarse[i]
                    if len(got) < k:  # some exact scores, to begin with
                        first = left[np.argpartition(-bound[left], k - 1)[:k]]
                        got_ids, got = scored(first)
                        left = np.setdiff1d(left, first, assume_unique=True)
                    left = left[bound[left] >= got[-1]]
                    for (qm, qd, sizes), (xm, xd, _) in zip(of_queries.levels[1:], stats.levels[1:]):
                        if not len(left):
                            break
                        left = left[xm[left] @ (qm[i] * sizes) + xd[left] @ qd[i] + slack >= got[-1]]
                best[i] = scored(left) if len(left) else (got_ids, got)
        return best


def _kept(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def by_dimension(batch: pa.RecordBatch):
    """Rows of each dimension: which rows they are, and their vectors as a matrix."""
    lists = batch.column("v")
    sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, flat[starts[rows][:, None] + np.arange(dim)].reshape(len(rows), dim)


def top_k(vectors: DataFrame, asks: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each row that asks with every other row.

    vectors as quantised() returns them; asks is a condition on vec_id.
    """
    n = vectors.count()
    groups = max(1, -(-n // GROUP_ROWS), min(parallelism(vectors), -(-n // CHUNK)))
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    ask = F.md5(F.col("v").cast("string"))  # tells queries of equal id apart
    candidates = vectors.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("asks"), "vec_id", "v", "times", F.lit("").alias("ask"))
    queries = vectors.where(asks).select(every.alias("g"), F.lit(1).alias("asks"), "vec_id", "v", "times", ask.alias("ask"))

    def work(batches):
        now, parts, held = None, [], {}
        for batch in batches:
            group, asking = batch.column("g").to_numpy(), batch.column("asks").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(group) != 0) | (np.diff(asking) != 0)) + 1, [batch.num_rows]])
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if group[a] != now:
                    now, parts, held = group[a], [], {}
                if not asking[a]:
                    parts.append(part)
                    continue
                if parts:
                    table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    ids, times = table.column("vec_id").to_numpy(), table.column("times").to_numpy()
                    held, parts = {dim: Group(ids[rows], x, times[rows]) for dim, rows, x in by_dimension(table)}, []
                for dim, rows, q in by_dimension(part):
                    if dim in held:
                        found = held[dim].search(part.column("vec_id").to_numpy()[rows], q, k)
                        again = np.repeat(rows, [len(i) for i, _ in found])
                        names = ("vec_id", "times", "ask")
                        columns = [part.column(c).take(pa.array(again)) for c in names] + [pa.array(np.concatenate([f[c] for f in found])) for c in (0, 1)]
                        yield pa.RecordBatch.from_arrays(columns, ["query_id", "times", "ask", "vec_id", "score"])

    stream = candidates.unionByName(queries).repartition(groups, "g").sortWithinPartitions("g", "asks")
    made = stream.mapInArrow(work, "query_id long, times long, ask string, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "vec_id"))
    best = made.withColumn("rank", rank).where(F.col("rank") <= k)
    one = F.explode(F.sequence(F.lit(1), F.col("times")))  # equal rows ask the same
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", one.alias("n")).drop("n")


def oracle(k: int = 5, every: int = 50, scale: int = 256) -> str:
    """The op8 query's rows in DuckDB SQL."""
    return f"""
WITH fine AS (
  SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.own, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM fine q JOIN fine c ON c.own <> q.own AND len(c.v) = len(q.v) WHERE q.vec_id % {every} = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
