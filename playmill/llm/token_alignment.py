"""Aligns the tokens of two vocabularies over the bytes of each text, and counts which meet.

A is a byte-level vocabulary, B one of pieces with byte fallback; both encode
the same bytes, a space and the text. Where tokens of both end the text is cut
into groups; a token of A and one of B are linked where their byte ranges
overlap, which is once for each stretch between two neighbouring ends of
either. Neither vocabulary has a token that goes across a space between
something that isn't a space and something that isn't white space, so texts are
cut there and a worker aligns each distinct stretch once.

``counted`` gathers each task's pairs of ids, builds a minimal perfect hash of
the distinct ones (levels of bits, shard by shard, in the tasks that hold the
shards), turns what tasks have counted into dense vectors indexed by it, and
sums these in a tree, block by block. The keys are kept in the order of the
hash, so that a key that it doesn't hold is told from one that it does.
``aligned`` aligns the documents again and looks the counts up. Tasks hold
``most_pairs`` of the hash, its keys and counts at a time: more pairs than that
are looked up in as many rounds over the documents as it takes.

Defined cases: a null or empty text has no tokens, and all its numbers are 0;
so does a text that one of the vocabularies doesn't give back byte by byte (one
that holds the word mark itself); strings of special tokens are plain text;
rows of equal id are rows of their own; null ids are kept; very long texts and
stretches are aligned whole; ties for the highest count are all best; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, text_bytes, written
from .sp_codec import MARK, Codec

#: Distinct stretches that a worker keeps; when there are more, it starts anew.
KEPT = 400_000
#: Characters of stretches that are encoded in one call, about.
CHUNK = 1 << 16
#: Bytes of stretches above which they aren't kept for the next slice.
KEPT_BYTES = 16 << 20
#: Keys of a shard of the hash, about, and counts of a block of a vector.
SHARD_KEYS = BLOCK = 1 << 16
#: Vectors that are summed at a time.
FAN_IN = 16
#: A pair is a long: the id of A times this, and the id of B.
WIDTH = 1 << 24
_ODD = re.compile(r" \s")


def stretches(text: str) -> list[str]:
    """A space and the text, cut where no token goes across; each without the space that it begins with."""
    parts = text.split(" ")
    if not (parts[0] and parts[-1]) or _ODD.search(text):
        out = parts[:1]
        for before, part in zip(parts, parts[1:]):
            if before and part and not part[0].isspace():
                out.append(part)
            else:
                out[-1] += " " + part
        return out
    return parts


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _by_rank(path: str, tokens: list[bytes | None]):
    """A faster encoder of the same tokens, if the vocabulary's merges come in the order of their ids and it cuts words by the byte-level pattern; else None."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model, cut = made["model"], made.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not made.get("normalizer") and not model.get("dropout")
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if not plain or any(x >= y for x, y in zip(merged, merged[1:])):
        return None
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens) if t is not None}, special_tokens={}).encode_ordinary


def _chunks(units: list[str]) -> Iterator[tuple[list[int], str]]:
    """Places of stretches, and the text that they make up: several where none begins with white space or ends with a space, else each alone."""
    own, size = [], 0
    for i, u in enumerate(units):
        if not u or u[-1] == " " or u[0].isspace():
            yield [i], " " + u
            continue
        own.append(i)
        size += len(u)
        if size > CHUNK:
            yield own, "".join([" " + units[k] for k in own])
            own, size = [], 0
    if own:
        yield own, "".join([" " + units[k] for k in own])


class Aligner:
    """What a worker knows of the stretches met so far, each by its number."""

    def __init__(self, path_a: str, path_b: str, kept: int = KEPT):
        self.kept = kept
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        a, codec = Tokenizer.from_file(path_a), Codec(path_b)
        a.encode_special_tokens = True
        if not codec.by_word or codec.squeeze or codec.map.units is not None or not codec.dummy:
            raise ValueError("the second vocabulary must keep every byte, fall back to bytes and have no piece across words")
        self.b = codec.model
        alphabet, n = byte_alphabet(), a.get_vocab_size()
        special = set(a.get_added_tokens_decoder())
        tokens = [None if i in special else a.id_to_token(i) for i in range(n)]
        tokens = [None if t is None else bytes(map(alphabet.__getitem__, t)) for t in tokens]
        self.slow, self.fast = lambda text: a.encode(text, add_special_tokens=False).ids, _by_rank(path_a, tokens)
        self.bytes_a = [t or b"" for t in tokens]
        plain = codec.plain
        pieces = [plain.id_to_piece(i) for i in range(plain.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if plain.is_byte(i) else b"" if plain.is_control(i) or plain.is_unknown(i) else p.encode().replace(MARK, b" ") for i, p in enumerate(pieces)]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # How an id is written: within its group, and at the end of its part of it.
        self.written = [b"%d%s" % (i, end) for m, ends in ((n, (b",", b"|")), (len(pieces), (b",", b";"))) for i in range(m) for end in ends]
        self.width = np.array(list(map(len, self.written)), np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.spelled: list[bytes] = []
        #: Rows: tokens of A, of B, groups, links, and 1 if the bytes aren't given back.
        self.numbers = np.zeros((5, 0), np.int64)
        self.links, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def full(self) -> bool:
        return len(self.known) > self.kept or self.held > KEPT_BYTES

    def read(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the texts' stretches, laid end to end, and how many each text has."""
        cut: list[str] = []
        sizes = []
        for t in texts:
            before = len(cut)
            if t:
                cut += stretches(t)
            sizes.append(len(cut) - before)
        known = self.known
        number, new = list(map(known.get, cut)), []
        for i in [i for i, k in enumerate(number) if k is None]:
            number[i] = known.setdefault(cut[i], len(known))
            if number[i] == len(self.spelled) + len(new):
                new.append(cut[i])
        if new:
            self._learn(new)
        return np.array(number, np.int64), np.array(sizes, np.int64)

    def _encoded(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of A and B of a text that begins with a space, or None if one of them doesn't give its bytes back."""
        # Letters and digits of scripts beyond these may be told apart anew by a later version of either library.
        fast = self.fast and (text.isascii() or max(text) < "\u0250")
        a, b = (self.fast if fast else self.slow)(text), self.b.encode(text.replace(" ", MARK.decode()), num_threads=1)
        source = text.encode()
        same = b"".join(map(self.bytes_a.__getitem__, a)) == source == b"".join(map(self.bytes_b.__getitem__, b))
        return (a, b) if same else None

    def _learn(self, new: list[str]) -> None:
        flat_a, flat_b, order, bad = [], [], [], []
        for own, text in _chunks(new):
            found = self._encoded(text)
            if found is None and len(own) > 1:
                found = [], []
                for k in own:
                    one = self._encoded(" " + new[k])
                    (order if one else bad).append(k)
                    for x, y in zip(found, one or ((), ())):
                        x += y
            else:
                (order if found else bad).extend(own)
            flat_a += found[0] if found else ()
            flat_b += found[1] if found else ()
        flat_a, flat_b, order = np.array(flat_a, np.int64), np.array(flat_b, np.int64), np.array(order, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[flat_a]), np.cumsum(self.sizes_b[flat_b])
        whole = np.cumsum([1 + len(new[k].encode()) for k in order.tolist()], dtype=np.int64)
        both = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        ends = np.sort(np.concatenate([ends_a, np.setdiff1d(ends_b, both, assume_unique=True)]))
        links = flat_a[np.searchsorted(ends_a, ends)] * WIDTH + flat_b[np.searchsorted(ends_b, ends)]
        numbers = np.zeros((5, len(new)), np.int64)
        numbers[4, bad] = 1
        for row, marks in enumerate((ends_a, ends_b, both, ends)):
            numbers[row, order] = np.diff(np.searchsorted(marks, whole, "right"), prepend=0)
        starts = np.full(len(new), len(self.links))
        starts[order] = len(self.links) + np.cumsum(numbers[3, order]) - numbers[3, order]
        self.starts = np.concatenate([self.starts, starts])
        self.links = np.concatenate([self.links, links])
        self.numbers = np.concatenate([self.numbers, numbers], axis=1)
        # Tokens by group, those of A first; each with what is written after it.
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        code_a, code_b = (2 * flat + (ends == both[group]) for flat, ends, group in ((flat_a, ends_a, group_a), (flat_b, ends_b, group_b)))
        codes = np.concatenate([code_a, code_b + 2 * len(self.bytes_a)])[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
        text = b"".join(map(self.written.__getitem__, codes.tolist()))
        tokens = np.cumsum(numbers[0, order] + numbers[1, order])
        stops = np.append(0, np.cumsum(self.width[codes]))[tokens].tolist()
        spelled = [b""] * len(new)
        for k, start, stop in zip(order.tolist(), [0, *stops], stops):
            spelled[k] = text[start : stop - 1]
        self.spelled += spelled
        self.held += sum(map(len, new))

    def pairs(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of stretches that come so many times, and how often each is linked."""
        own = np.flatnonzero((times > 0) & (self.numbers[3] > 0))
        sizes = self.numbers[3, own]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[own] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return summed(self.links[at], np.repeat(times[own], sizes))


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers for each seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """A minimal perfect hash of distinct keys.

    A level has a bit for each of its slots, set where one key alone falls; the
    keys that fall together go on to the next level. A key's index is the
    number of bits set before its own.
    """

    keys: np.ndarray
    levels: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        made, left, before = cls(np.zeros(len(keys), np.int64)), keys.astype(np.int64), 0
        while len(left):
            size = max(64, 2 * len(left))
            slot = cls._slots(left, len(made.levels), size)
            often = np.bincount(slot, minlength=-(-size // 64) * 64)
            words = np.packbits((often == 1).reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel()
            counts = np.bitwise_count(words).astype(np.int64)
            made.levels.append((size, words, before + np.cumsum(counts) - counts))
            before += int(counts.sum())
            left = left[often[slot] > 1]
        made.keys[made._place(keys)] = keys
        return made

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (((_mixed(keys, level + 1) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, words, before) in enumerate(self.levels):
            slot = self._slots(keys[left], level, size)
            word, bit = words[slot >> 6], (slot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            at = left[hit]
            out[at] = before[slot[hit] >> 6] + np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            left = left[~hit]
        return out

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, or -1 if it isn't one of them."""
        keys = keys.astype(np.int64)
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        out = self._place(keys)
        return np.where((out >= 0) & (self.keys[out] == keys), out, -1)


class Part:
    """Some shards of the hash, one after the other."""

    def __init__(self, shards: dict[int, PerfectHash], n_shards: int):
        self.shards, self.n_shards, self.size, self.offsets = shards, n_shards, 0, {}
        for k, h in shards.items():
            self.offsets[k] = self.size
            self.size += len(h.keys)

    def index(self, keys: np.ndarray) -> np.ndarray:
        shard, out = shard_of(keys, self.n_shards), np.full(len(keys), -1, np.int64)
        order = np.argsort(shard, kind="stable")
        names, starts = np.unique(shard[order], return_index=True)
        for k, own in zip(names.tolist(), np.split(order, starts[1:])):
            if k in self.shards:
                at = self.shards[k].index(keys[own])
                out[own] = np.where(at < 0, -1, at + self.offsets[k])
        return out

    def keys(self) -> np.ndarray:
        return np.concatenate([h.keys for h in self.shards.values()] or [np.zeros(0, np.int64)])


def shard_of(keys: np.ndarray, n_shards: int) -> np.ndarray:
    return (_mixed(keys, 0) % np.uint64(n_shards)).astype(np.int64)


_BUILT: dict[tuple, Aligner] = {}


def _aligner(path_a: str, path_b: str, kept: int) -> Aligner:
    """A worker's own, with what it knows from earlier tasks."""
    key = (path_a, path_b, kept)
    if key not in _BUILT:
        _BUILT[key] = Aligner(*key)
    return _BUILT[key]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [x.decode() for x in batch.column("text").to_pylist()]


def local_counts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", kept: int = KEPT) -> DataFrame:
    """key and n: the pairs of ids that a task has met, and how many links each has there."""

    def work(batches):
        aligner = _aligner(path_a, path_b, kept)
        times, parts, waiting = np.zeros(len(aligner.known), np.int64), [], 0

        def put_off():
            nonlocal times, waiting
            own = aligner.pairs(times)
            parts.append(own)
            waiting, times = waiting + len(own[0]), np.zeros(len(aligner.known), np.int64)

        def ready():
            keys, n = summed(*(np.concatenate(x) for x in zip(*parts)))
            parts.clear()
            for a in range(0, len(keys), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + BLOCK]), pa.array(n[a : a + BLOCK])], ["key", "n"])

        for batch in batches:
            number, sizes = aligner.read(_texts(batch))
            bad = np.zeros(len(sizes), bool)
            full = np.flatnonzero(sizes)
            if len(full):
                bad[full] = np.add.reduceat(aligner.numbers[4][number], (np.cumsum(sizes) - sizes)[full]) > 0
            now = np.bincount(number[~np.repeat(bad, sizes)], minlength=len(aligner.known))
            now[: len(times)] += times
            times = now
            if aligner.full:
                put_off()
                aligner.forget()
                times = np.zeros(0, np.int64)
                if waiting > 1 << 21:
                    yield from ready()
                    waiting = 0
        put_off()
        yield from ready()

    return map_texts(docs.select(text_bytes(text_col).alias("text")), work, "key long, n long")


@dataclass
class Counts:
    """The hash as written rows (shard, n, hash), the sums as written rows (part, block, counts), the shards of each part, and the highest count of each id of B."""

    hashes: DataFrame
    sums: DataFrame
    parts: list[list[int]]
    n_shards: int
    best: dict[int, int]

    def part(self, k: int) -> Part:
        rows = self.hashes.where(F.col("shard").isin(self.parts[k])).collect()
        return Part({r["shard"]: pickle.loads(r["hash"]) for r in sorted(rows, key=lambda r: r["shard"])}, self.n_shards)

    def vector(self, k: int) -> np.ndarray:
        rows = self.sums.where(F.col("part") == k).collect()
        return np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in sorted(rows, key=lambda r: r["block"]))])


def counted(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", most_pairs: int = 1 << 22, kept: int = KEPT) -> Counts:
    """How many links hold each pair of ids over all documents."""
    spark = docs.sparkSession
    local = written(local_counts(docs, path_a, path_b, text_col, kept), "pairs-local")
    distinct = written(local.select("key").distinct(), "pairs-distinct")
    n, rows = distinct.count(), local.count()
    n_shards = max(1, -(-n // SHARD_KEYS))

    def named(batches):
        for b in batches:
            shard = shard_of(b.column("key").to_numpy(), n_shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), b.column("key")], ["shard", "key"])

    def build(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("key").to_numpy())
        return pa.table({"shard": table.column("shard")[:1].combine_chunks(), "n": pa.array([len(keys)], pa.int64()), "hash": pa.array([pickle.dumps(PerfectHash.build(keys))], pa.binary())})

    hashes = written(distinct.mapInArrow(named, "shard int, key long").groupBy("shard").applyInArrow(build, "shard int, n long, hash binary"), "pairs-hash")
    parts, size = [[]], 0
    for r in hashes.select("shard", "n").orderBy("shard").collect():
        if size and size + r["n"] > most_pairs:
            parts.append([])
            size = 0
        parts[-1].append(r["shard"])
        size += r["n"]
    found = Counts(hashes, None, parts, n_shards, {})
    sums = None
    for k in range(len(parts)):
        part = found.part(k)
        sent = spark.sparkContext.broadcast(part)
        # A vector takes as many rows as it has places, or more: then it is no larger than they are.
        n_tasks = max(1, min(1 << 12, rows // max(1, part.size)))
        one = _tree_sum(local.coalesce(n_tasks).mapInArrow(_dense(sent), "block int, task int, counts binary"), n_tasks)
        one = one.select(F.lit(k).alias("part"), "block", "counts")
        sums = one if sums is None else sums.unionByName(one)
    found.sums = written(sums, "pairs-sums")
    for k in range(len(parts)):
        _best(found.part(k).keys(), found.vector(k), found.best)
    return found


def _best(keys: np.ndarray, counts: np.ndarray, best: dict[int, int]) -> None:
    """The highest count of each id of B: as many numbers as B has ids."""
    own = keys % WIDTH
    order = np.argsort(own, kind="stable")
    ids, starts = np.unique(own[order], return_index=True)
    for b, most in zip(ids.tolist(), np.maximum.reduceat(counts[order], starts).tolist() if len(ids) else []):
        best[b] = max(most, best.get(b, 0))


def _dense(sent):
    """Turns counted pairs into a vector of counts a task, cut into blocks; those without a count are left out, save the last."""

    def work(batches):
        part = sent.value
        vector = np.zeros(part.size, np.int64)
        for b in batches:
            at, n = part.index(b.column("key").to_numpy()), b.column("n").to_numpy()
            np.add.at(vector, at[at >= 0], n[at >= 0])
        task = TaskContext.get().partitionId()
        for k, a in enumerate(range(0, part.size, BLOCK)):
            cut = vector[a : a + BLOCK]
            if cut.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([task], pa.int32()), pa.array([cut.tobytes()], pa.binary())], ["block", "task", "counts"])

    return work


def _tree_sum(vectors: DataFrame, n_tasks: int) -> DataFrame:
    """block and counts: FAN_IN vectors of a block are added at a time, until there is one."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("counts"))
        return pa.table({"block": table.column("block")[:1].combine_chunks(), "task": table.column("task")[:1].combine_chunks(), "counts": pa.array([total.tobytes()], pa.binary())})

    while True:
        n_tasks = -(-n_tasks // FAN_IN)
        halved = vectors.withColumn("task", F.expr(f"CAST(task DIV {FAN_IN} AS INT)"))
        vectors = halved.groupBy("block", "task").applyInArrow(add, "block int, task int, counts binary")
        if n_tasks <= 1:
            return vectors.select("block", "counts")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", most_pairs: int = 1 << 22, spelled: bool = False, kept: int = KEPT) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row; with spelled also groups, the ids of each group as text.

    The paths are files that each executor has, as the libraries' own data files are.
    """
    counts = counted(docs, path_a, path_b, text_col, most_pairs, kept)
    kind = dict(docs.dtypes)[id_col]
    none = F.lit(0).cast("long")
    now = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), none.alias("n_best"), none.alias("count_sum"))
    best = docs.sparkSession.sparkContext.broadcast(counts.best)
    final = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + ", groups string" * spelled
    for k in range(len(counts.parts)):
        last = k == len(counts.parts) - 1
        sent = docs.sparkSession.sparkContext.broadcast((counts.part(k), counts.vector(k)))
        work = _looked_up(path_a, path_b, kept, sent, best, last, spelled)
        now = map_texts(now, work, f"id {kind}, {final}" if last else f"id {kind}, text binary, n_best long, count_sum long")
    return now.withColumnRenamed("id", id_col)


def _looked_up(path_a: str, path_b: str, kept: int, sent, best, last: bool, spelled: bool):
    def work(batches):
        aligner, (part, counts) = _aligner(path_a, path_b, kept), sent.value
        most = np.zeros(max(best.value, default=0) + 1, np.int64)
        most[list(best.value)] = list(best.value.values())
        own, seen = np.zeros((2, 0), np.int64), 0
        for batch in batches:
            if aligner.full:
                aligner.forget()
                own, seen = np.zeros((2, 0), np.int64), 0
            number, sizes = aligner.read(_texts(batch))
            if len(own[0]) < len(aligner.known):  # counts of the links of what is new here
                new = slice(own.shape[1], None)
                links = aligner.links[seen:]
                seen = len(aligner.links)
                at = part.index(links)
                count = np.where(at < 0, 0, counts[at] if len(counts) else 0)
                running = np.zeros((2, len(links) + 1), np.int64)
                running[0, 1:] = np.cumsum((at >= 0) & (count == most[np.minimum(links % WIDTH, len(most) - 1)]))
                running[1, 1:] = np.cumsum(count)
                begins = aligner.starts[new] - (seen - len(links))
                own = np.concatenate([own, running[:, begins + aligner.numbers[3, new]] - running[:, begins]], axis=1)
            full = np.flatnonzero(sizes)
            each = np.zeros((7, len(sizes)), np.int64)
            if len(full):
                starts = (np.cumsum(sizes) - sizes)[full]
                each[:, full] = np.add.reduceat(np.concatenate([aligner.numbers, own])[:, number], starts, axis=1)
            each[:, each[4] > 0] = 0
            n_best, count_sum = (each[5 + k] + batch.column(c).to_numpy() for k, c in enumerate(("n_best", "count_sum")))
            if not last:
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array(n_best), pa.array(count_sum)], ["id", "text", "n_best", "count_sum"])
                continue
            flat, stops = number.tolist(), np.cumsum(sizes).tolist()
            groups = [b";".join(map(aligner.spelled.__getitem__, flat[b - n : b])) if n_a else b"" for b, n, n_a in zip(stops, sizes.tolist(), each[0].tolist())]
            digests = pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string())
            columns = [batch.column("id"), *map(pa.array, each[:4]), pa.array(n_best), pa.array(count_sum), digests]
            names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            if spelled:
                columns.append(pa.array([g.decode() for g in groups], pa.string()))
                names.append("groups")
            yield pa.RecordBatch.from_arrays(columns, names)

    return work
