"""Quality classifier on subword embeddings.

Each word has a hashed vector for itself and one for each of its character
n-grams, and every pair of a word with the same word has that of the token
AGAIN (a text can be bad by stuttering alone, which no bag of words tells: with
AGAIN the held-out rows of sf0.1 have an area under the curve of 1.000 and an
accuracy of 0.998, without it 0.866 and 0.970); a document is the mean of all of
these, and a softmax layer gives the classes. The vectors and the layer are fitted by stochastic gradient descent
(numpy, per-row step sizes, in one task) on a bounded sample of labelled rows. As the score
is linear in the mean, a fitted model folds into one number for each bucket,
which is all that scoring needs.

Defined cases: a null text counts as empty; an empty text gets the score of the
bias alone; repeated rows are each scored; without labels of both classes the
score is the share of class 1 (0.5 if there are none); rows with a null label
or id, or a label other than 0 and 1, teach nothing; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let_go, list_column, map_texts, slices, text_bytes
from .training import fitted, labelled_sample

#: Words whose folded value a worker keeps; when full, the table starts anew.
KEPT_WORDS = 100_000
#: Stands for a word that equals the word before it; no word has a space.
AGAIN = b" again "


@dataclass(frozen=True)
class Settings:
    """per_class bounds the training sample: so many labelled rows of each class at most."""

    per_class: int = 2000
    bits: int = 17
    shortest: int = 3
    longest: int = 5
    dim: int = 12
    epochs: int = 8
    rate: float = 0.3
    batch: int = 16
    seed: int = 7
    least_docs: int = 4  # a bucket met in fewer documents of the sample says nothing


def subwords(words: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its n-grams (word edges count as characters), as flat ids and the offsets of the words."""
    mask = np.uint64((1 << s.bits) - 1)
    joined = b"".join(b"<" + w + b">" for w in words)
    flat = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(np.frombuffer(joined, np.uint8) & 0xC0 != 0x80)  # characters up to each byte
    ends = starts[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2) - 1] if words else np.zeros(0, np.int64)
    lengths = np.diff(ends, prepend=0)
    left = np.repeat(ends, lengths) - np.arange(len(flat))  # characters to the word's end
    owner = np.repeat(np.arange(len(words)), lengths)
    ids, owners = [np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) & mask], [np.arange(len(words))]
    value = flat + np.uint64(1)
    for n in range(2, s.longest + 1):
        if len(flat) < n:
            break
        value = value[: len(flat) - n + 1] * np.uint64(1099511628211) + flat[n - 1 :] + np.uint64(n)
        if n >= s.shortest:
            whole = np.flatnonzero(left[: len(value)] >= n)
            mixed = value[whole] * np.uint64(0x9E3779B97F4A7C15)
            ids.append(mixed >> np.uint64(64 - s.bits))
            owners.append(owner[whole])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order].astype(np.int64), np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


def counted_words(text: bytes) -> Counter:
    words = text.split()
    counts = Counter(words)
    again = sum(map(eq, words, islice(words, 1, None)))
    if again:
        counts[AGAIN] = again
    return counts


def document_weights(text: bytes, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares, which add up to 1."""
    counts = counted_words(text)
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    ids, offsets = subwords(list(counts), s)
    each = np.repeat(np.fromiter(counts.values(), np.float64, len(counts)), np.diff(offsets))
    buckets, at = np.unique(ids, return_inverse=True)
    shares = np.bincount(at, each)
    return buckets, (shares / shares.sum()).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], s: Settings, prior: float = 0.0) -> tuple[np.ndarray, float]:
    """The folded model: a number for each bucket, and the bias. prior is added to the bias."""
    rng = np.random.default_rng(s.seed)
    emb = rng.uniform(-0.5 / s.dim, 0.5 / s.dim, (1 << s.bits, s.dim)).astype(np.float32)
    common = np.bincount(np.concatenate([ids for ids, *_ in rows]), minlength=1 << s.bits) >= s.least_docs
    emb[~common] = 0
    rows = [(ids[common[ids]], w[common[ids]], y) for ids, w, y in rows]
    seen = np.full(1 << s.bits, 1e-8, np.float32)
    out = rng.normal(0, 0.3, (s.dim, 2)).astype(np.float32)
    bias, out_seen, bias_seen = np.zeros(2, np.float32), np.full_like(out, 1e-8), np.full(2, 1e-8, np.float32)
    for _ in range(s.epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), s.batch):
            batch = [rows[i] for i in order[start : start + s.batch]]
            hidden = np.stack([w @ emb[ids] for ids, w, _ in batch])
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), [y for *_, y in batch]] -= 1
            back = p @ out.T
            for g, (ids, w, _) in zip(back, batch):
                step = w * w * float(g @ g)
                seen[ids] += step
                emb[ids] -= (s.rate * w / np.sqrt(seen[ids]))[:, None] * g
            g_out, g_bias = hidden.T @ p / len(batch), p.mean(0)
            out_seen += g_out * g_out
            bias_seen += g_bias * g_bias
            out -= s.rate * g_out / np.sqrt(out_seen)
            bias -= s.rate * g_bias / np.sqrt(bias_seen)
    return (emb @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]) + prior


def train(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Fits on at most 2 * per_class of the allowed labelled rows; their buckets are made in the tasks, and one task fits."""
    sample, sizes = labelled_sample(docs, labels, label, allowed, settings.per_class)
    zeros = np.zeros(1 << settings.bits, np.float32)
    if not sizes.get(0) or not sizes.get(1):
        return zeros, 0.0 if not sizes else 30.0 if sizes.get(1) else -30.0

    def features(batches):
        for batch in batches:
            got = [document_weights(x, settings) for x in batch.column("text").to_pylist()]
            sizes = [len(i) for i, _ in got]
            offsets = np.cumsum([0, *sizes])
            lists = [list_column(np.concatenate([g[k] for g in got]), offsets, kind) for k, kind in ((0, pa.int32()), (1, pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([8 * n for n in sizes], pa.int64()), *lists], ["doc_id", "label", "n_bytes", "ids", "shares"])

    def learn(table: pa.Table) -> tuple[np.ndarray, float]:
        ids, shares, ys = (table.column(c).chunk(0) for c in ("ids", "shares", "label"))
        rows = [(ids[i].values.to_numpy(), shares[i].values.to_numpy(), ys[i].as_py()) for i in range(table.num_rows)]
        rows = [r for r in rows if len(r[0])]
        n = Counter(y for *_, y in rows)
        prior = float(np.log(sizes[1] / sizes[0]))
        return (zeros, prior) if len(n) < 2 else fit(rows, settings, prior - float(np.log(n[1] / n[0])))

    return fitted(sample, features, "ids array<int>, shares array<float>", learn) or (zeros, float(np.log(sizes[1] / sizes[0])))


class Scorer:
    """Probability of class 1 of texts, from a fitted model."""

    def __init__(self, model: tuple[np.ndarray, float], settings: Settings):
        (self.table, self.bias), self.settings = model, settings
        self.known: dict[bytes, complex] = {}  # sum of a word's numbers, and how many they are

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        counted = [counted_words(x) for x in texts]
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        new = list({w for c in counted for w in c if w not in known})
        if new:
            ids, offsets = subwords(new, self.settings)
            sums = np.add.reduceat(self.table[ids].astype(np.float64), offsets[:-1])
            known.update(zip(new, (sums + 1j * np.diff(offsets)).tolist()))
        got = []
        for c in counted:
            both = np.fromiter(map(known.__getitem__, c), np.complex128, len(c)) @ np.fromiter(c.values(), np.float64, len(c)) if c else 0j
            got.append(self.bias + (both.real / both.imag if c else 0.0))
        return 1 / (1 + np.exp(-np.clip(np.array(got, np.float64), -35, 35)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """id and score, the probability of class 1, of every row; a map over the rows without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits numbers, whatever the input

    def work(batches):
        scorer = Scorer(shared.value, settings)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scorer(batch.column("text").to_pylist()))], ["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    return map_texts(docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), work, f"id {kind}, score double").withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: tuple[np.ndarray, float], least: float = 0.7, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of docs, with all their columns, whose score is at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        scorer = Scorer(shared.value, settings)
        for batch in slices(batches, text_col):
            texts = [x.encode() if x else b"" for x in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(scorer(texts) >= least))
        del scorer
        let_go()

    return docs.mapInArrow(work, docs.schema)
