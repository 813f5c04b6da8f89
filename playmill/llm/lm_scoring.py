"""Language-model scoring over a subword lattice.

The pieces of an existing vocabulary are a unigram model: a text is a sequence
of pieces and an end. Its probability is the sum over all segmentations, worked
out by the forward recursion in log space. Texts are taken as their words, each
with one space before it, so no piece crosses words and a word's sum is worked
out once wherever it occurs. Every byte is a piece too, so any text can be
segmented. The vocabulary's own scores, read as ranks, give the first weights
(inverse to the rank); expectation maximisation over the counted words of the
training rows then re-weights them, after which a piece's first weight acts no
more but through where the passes began. Without training rows it is all there is.

Next to it stands a plain model, add-one counts of words. Counts of the most
frequent words (a number set beforehand) are sent to the tasks; the rest are
joined.

Defined cases: a null text counts as empty; an empty text is the end alone;
rows of equal id are scored one by one; with no training rows the first weights
stay and the plain counts are zero; words of any length are scored whole, long
ones in time and memory that grow with their length; other columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, parallelism, text_bytes, written

#: Bytes above which a word is gone through arc by arc, and isn't among those sent to all tasks.
LONG = 2048


@dataclass(frozen=True)
class Settings:
    passes: int = 2  # of expectation maximisation
    least: float = 0.01  # added to each piece's expected count
    head: int = 150_000  # most frequent words sent to the tasks
    kept: int = 200_000  # other words a worker keeps
    flush: int = 300_000  # distinct words a task counts before it passes them on


def _log_sum(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -math.inf else x + math.log1p(math.exp(y - x))


class Lattice:
    """Pieces with log weights, ready for lookups over many words at once."""

    PRIME = np.uint64(0x100000001B3)

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        self.longest = max(by_length)
        self.tables = {}
        for n, own in by_length.items():
            hashes = np.zeros(len(own), np.uint64)
            flat = np.frombuffer(b"".join(pieces[i] for i in own), np.uint8).reshape(len(own), n).astype(np.uint64)
            for k in range(n):
                hashes = self._next(hashes, flat[:, k])
            order = np.argsort(hashes)
            seen = np.zeros(1 << 18, bool)
            seen[hashes >> np.uint64(46)] = True
            self.tables[n] = hashes[order], np.array(own)[order], seen

    def _next(self, hashes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        x = (hashes ^ (byte + np.uint64(1))) * self.PRIME
        return (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)

    def arcs(self, words: np.ndarray) -> list[np.ndarray]:
        """words: (n, length) bytes. For each piece length from 1: (n, length - piece length + 1) piece numbers, -1 where none matches."""
        n, length = words.shape
        flat = words.astype(np.uint64)
        hashes, out = np.zeros(words.shape, np.uint64), []
        for k in range(1, min(length, self.longest) + 1):
            hashes = self._next(hashes[:, : length - k + 1], flat[:, k - 1 :])
            found = np.full(hashes.shape, -1, np.int32)
            if k in self.tables:
                keys, ids, seen = self.tables[k]
                maybe = np.nonzero(seen[hashes >> np.uint64(46)])
                wanted = hashes[maybe]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                found[maybe] = np.where(keys[at] == wanted, ids[at], -1)
            out.append(found)
        return out

    @staticmethod
    def forward(scores: list[np.ndarray], length: int) -> np.ndarray:
        """alpha (n, length + 1): log sum over the segmentations of each prefix."""
        n = scores[0].shape[0]
        alpha = np.full((n, length + 1), -np.inf)
        alpha[:, 0] = 0
        for p in range(1, length + 1):
            most = min(p, len(scores))
            terms = np.stack([alpha[:, p - k] + scores[k - 1][:, p - k] for k in range(1, most + 1)])
            top = terms.max(0)
            alpha[:, p] = top + np.log(np.exp(terms - top).sum(0))
        return alpha

    def _scores(self, words: np.ndarray, weights: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        arcs = self.arcs(words)
        padded = np.append(weights, -np.inf)
        return arcs, [padded[a] for a in arcs]

    def grouped(self, words: list[bytes], most: int = 1 << 16):
        """Numbers of words of one length, at most so many bytes at a time, and their bytes as a matrix; a space comes first. Long words are left out."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= LONG]
        for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
            n = int(lengths[part[0]]) + 1
            step = max(1, most // n)
            for a in range(0, len(part), step):
                own = part[a : a + step]
                yield own, np.frombuffer(b"".join(b" " + words[i] for i in own.tolist()), np.uint8).reshape(len(own), n)

    def _long_arcs(self, word: bytes, weights: np.ndarray, back: bool = False):
        """Start, length, piece and weight of each arc of a long word, some thousand starts at a time, in order of the start; blocks come last first if back."""
        padded, size = np.frombuffer(word, np.uint8), 1 << 14
        blocks = range(0, len(word), size)
        for a in reversed(blocks) if back else blocks:
            own = min(size, len(word) - a)
            arcs = self.arcs(padded[None, a : a + own + self.longest - 1])
            found = [(n, np.flatnonzero(f[0, :own] >= 0)) for n, f in enumerate(arcs, 1)]
            k, at, piece = (np.concatenate(x) for x in zip(*((np.full(len(hit), n), hit, arcs[n - 1][0, hit]) for n, hit in found)))
            order = np.lexsort((k, at))
            k, at, piece = k[order], at[order], piece[order]
            yield a + at, k, piece, weights[piece]

    def _long_forward(self, word: bytes, weights: np.ndarray) -> array:
        """Log sum over the segmentations of each prefix, arc by arc; a number for each byte is held, and arcs of one block."""
        alpha = array("d", [-math.inf]) * (len(word) + 1)
        alpha[0] = 0.0
        for at, k, _, score in self._long_arcs(word, weights):
            for s, n, w in zip(at.tolist(), k.tolist(), score.tolist()):
                alpha[s + n] = _log_sum(alpha[s + n], alpha[s] + w)
        return alpha

    def _long_expected(self, word: bytes, count: float, weights: np.ndarray) -> np.ndarray:
        alpha, beta = self._long_forward(word, weights), array("d", [-math.inf]) * (len(word) + 1)
        beta[-1], out = 0.0, np.zeros(len(self.pieces))
        before, after = np.frombuffer(alpha), np.frombuffer(beta)
        for at, k, piece, score in self._long_arcs(word, weights, back=True):
            for s, n, w in zip(at[::-1].tolist(), k[::-1].tolist(), score[::-1].tolist()):
                beta[s] = _log_sum(beta[s], beta[s + n] + w)
            out += np.bincount(piece, np.exp(before[at] + score + after[at + k] - alpha[-1]) * count, minlength=len(out))
        return out

    def log_probabilities(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability, with the space before it, over all segmentations."""
        out = np.zeros(len(words))
        for i in [i for i, w in enumerate(words) if len(w) > LONG]:
            out[i] = self._long_forward(b" " + words[i], weights)[-1]
        for own, matrix in self.grouped(words):
            _, scores = self._scores(matrix, weights)
            out[own] = self.forward(scores, matrix.shape[1])[:, -1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected number of each piece in the words, each taken as often as counted."""
        out = np.zeros(len(self.pieces))
        for i in [i for i, w in enumerate(words) if len(w) > LONG]:
            out += self._long_expected(b" " + words[i], float(counts[i]), weights)
        for own, matrix in self.grouped(words):
            length = matrix.shape[1]
            arcs, scores = self._scores(matrix, weights)
            alpha = self.forward(scores, length)
            # Backwards, the same recursion over the mirrored lattice.
            beta = self.forward([s[:, ::-1] for s in scores], length)[:, ::-1]
            for k, (a, s) in enumerate(zip(arcs, scores), 1):
                hit = a >= 0
                if hit.any():
                    share = np.exp(alpha[:, : length - k + 1] + s + beta[:, k:] - alpha[:, -1:]) * counts[own][:, None]
                    out += np.bincount(a[hit], share[hit], minlength=len(out))
        return out


def vocabulary(model_path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes with a space for the word mark, every single byte among them, and first log weights."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(model_path, "rb") as f:
        proto.ParseFromString(f.read())
    best: dict[bytes, float] = {bytes([b]): -1e6 for b in range(256)}
    for p in proto.pieces:
        text = p.piece.replace("▁", " ").encode()
        if p.type == pb.ModelProto.SentencePiece.NORMAL and not text.rstrip(b" ").count(b" ", 1) and text not in (b"",):
            best[text] = max(best.get(text, -1e7), p.score)
    order = sorted(best, key=lambda x: (-best[x], x))
    weights = 1 / (np.arange(len(order)) + 10.0)
    return order, np.log(weights / weights.sum())


def word_counts(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """word (binary, A-Z lower-cased) and n; tasks add up before the shuffle."""
    most = settings.flush

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def work(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(text.lower().split())
            if len(counts) > most:
                yield batch_of(counts)
                counts = Counter()
        yield batch_of(counts)

    partial = map_texts(docs.select(text_bytes(text_col).alias("text")), work, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def reweighted(words: DataFrame, n_docs: int, lattice: Lattice, weights: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights after the passes, and the log weight of the end. What comes back is a number for each piece."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)
    end = float(np.log(0.5))
    for _ in range(settings.passes):
        now = weights

        def work(batches, now=now):
            own = shared.value
            total = np.zeros(len(own.pieces))
            for batch in batches:
                total += own.expected(batch.column("word").to_pylist(), batch.column("n").to_numpy(), now)
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], ["piece", "n"])

        sums = words.mapInArrow(work, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        expected = np.full(len(weights), settings.least)
        np.add.at(expected, sums["piece"].to_numpy(np.int64), sums["n"].to_numpy())
        total = expected.sum() + n_docs + settings.least
        weights, end = np.log(expected / total), float(np.log((n_docs + settings.least) / total))
    return weights, end


def score(docs: DataFrame, learnt: Column, model_path: str, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (both log10) of every row; learnt marks the training rows."""
    s, spark = settings, docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    training = docs.where(learnt)
    counts = written(word_counts(training, text_col, s), "lm-words")
    n_docs = training.count()
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = n + n_docs, v + (n_docs > 0)
    pieces, weights = vocabulary(model_path)
    lattice = Lattice(pieces)
    end = float(np.log(0.5))
    if not n_docs:  # pieces and the end share the mass
        weights = weights + np.log(0.5)
    else:
        weights, end = reweighted(counts, n_docs, lattice, weights, s)
    own = spark.sparkContext.broadcast((lattice, weights))

    def scored(batches):
        lattice, weights = own.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lattice.log_probabilities(batch.column("word").to_pylist(), weights))], ["word", "n", "log"])

    # Frequent words are scored once for all tasks; LONG bounds their bytes.
    head = counts.where(F.octet_length("word") <= LONG).orderBy(F.desc("n"), "word").limit(s.head)
    head = head.repartition(parallelism(docs), "word").mapInArrow(scored, "word binary, n long, log double").toArrow()
    shared = spark.sparkContext.broadcast((lattice, weights, *(head.column(c).to_pylist() for c in ("word", "n", "log"))))

    def work(batches):
        lattice, weights, head_words, head_counts, head_logs = shared.value
        first = {w: i for i, w in enumerate(head_words)}
        n_head, head_logs, head_counts = len(first), np.array(head_logs, np.float64), np.array(head_counts, np.float64)
        index, logs, rest = dict(first), head_logs, []
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        plain = np.log10(head_counts + 1)
        for batch in batches:
            split = [x.lower().split() for x in batch.column("text").to_pylist()]
            new = list(set(chain.from_iterable(split)) - index.keys())
            if len(rest) + len(new) > s.kept and rest:
                index, logs, rest = dict(first), head_logs, []
                new = list(set(chain.from_iterable(split)) - index.keys())
            index.update(zip(new, range(len(index), len(index) + len(new))))
            rest += new
            logs = np.concatenate([logs, lattice.log_probabilities(new, weights)])
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            at = np.fromiter(map(index.__getitem__, chain.from_iterable(split)), np.int64, sizes.sum())
            owner = np.repeat(np.arange(len(split)), sizes)
            common = at < n_head
            per = lambda values, pick=slice(None): np.bincount(owner[pick], values, minlength=len(split))
            rows = row + np.arange(len(split))
            row += len(split)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), batch.column("id"), pa.array(sizes + 1), pa.array(per(None, common).astype(np.int64)), pa.array(per(plain[at[common]], common), pa.float64()), pa.array((per(logs[at]) + end) / np.log(10), pa.float64()), pa.nulls(len(split), pa.binary())],
                names,
            )
            seldom = ~common
            if seldom.any():
                both, times = np.unique(owner[seldom] * len(index) + at[seldom], return_counts=True)
                own, which = both // len(index), both % len(index) - n_head
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[own]), pa.nulls(len(both), batch.column("id").type), pa.array(times.astype(np.int64)), pa.nulls(len(both), pa.int64()), pa.nulls(len(both), pa.float64()), pa.nulls(len(both), pa.float64()), pa.array([rest[i] for i in which.tolist()], pa.binary())],
                    names,
                )

    names = ["row", "id", "n", "known", "plain", "score", "word"]
    schema = f"row long, id {kind}, n long, known long, plain double, score double, word binary"
    made = written(map_texts(docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), work, schema), "lm-rows")
    found = made.where("word is not null").select("row", "n", "word").join(counts.select("word", F.col("n").alias("c")), "word")
    seldom = found.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_plain"), F.sum("n").alias("more_known"))
    whole = made.where("word is null").drop("word").join(seldom, "row", "left")
    base = F.col("plain") + F.coalesce("more_plain", F.lit(0.0)) + float(np.log10(n_docs + 1)) - F.col("n") * float(np.log10(n + v + 1))
    known = F.col("known") + F.coalesce("more_known", F.lit(0)) + int(n_docs > 0)
    return whole.select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), known.alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
