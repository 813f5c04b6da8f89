"""Removal of byte strings that also occur in an earlier document.

Rule: a byte goes if a string of ``length`` bytes over it also starts in a
document with a smaller id. Two places with an equal string of that length also
have the same anchor in it (the smallest hash among its ``ANCHOR``-byte
strings), so only places around anchors met in more than one document are
looked at again, with the bytes around them.

A bucket of anchors is an enhanced suffix array: the distinct strings from each
anchor on are sorted, with the common prefixes of neighbours. A scan with a
stack walks the tree of its intervals from the leaves up; each interval holds
all occurrences that agree so far, not just neighbours. What lies before their
anchors tells the left extensions apart: a second scan splits an interval where
these begin to differ, and a group whose members could all go on alike to the
right is left to the interval below. What is left are the maximal repeats over
the anchor with all their occurrences, as far as the bytes around it reach, and
the smallest id of each is what its other members are held against. Each string
of ``length`` bytes with several occurrences lies in the maximal repeat with
just these occurrences, so none is missed.

Documents are dealt into blocks by a hash. What a block asks, it asks once for
all of its equal places, and gets answers in the order it asked in: a string
that a third of all documents hold costs a row a block. Three passes run over
the same shuffled blocks: anchors, the bytes around shared anchors, and the
removal.

Defined cases: a null text counts as empty; a text shorter than ``length``
stays; strings are judged on the input; rows of equal id are not earlier than
one another; a null id is later than all others; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_column, parallelism, text_bytes

#: Bytes of an anchor; at most the length of the strings.
ANCHOR = 20
#: Bytes of text in a block and in the text behind a bucket, on average.
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
#: Bytes around anchors are most of what is sent.
CODEC = "zstd"
LATEST = np.iinfo(np.int64).max

_TABLE = np.random.default_rng(3).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def string_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place, by doubling."""
    have, width, power = _TABLE[text], 1, _STEP
    out, done = None, 0  # hash of the first ``done`` bytes from each place
    while True:
        if size & width:
            if out is None:
                out = have
            else:
                n = len(text) - done - width + 1
                out = out[:n] * power + have[done : done + n]
            done += width
        if 2 * width > size:
            break
        n = len(text) - 2 * width + 1
        have = have[:n] * power + have[width : width + n]
        power = np.uint64(int(power) ** 2 & (2**64 - 1))
        width *= 2
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of anchors and their hashes: every string of ``length`` bytes holds one, chosen by its bytes alone."""
    if len(text) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = min(ANCHOR, length)
    window = length - size + 1
    hashes = string_hashes(np.frombuffer(text, np.uint8), size)
    # The choice goes by other bits than the buckets do: the smallest would all be in the first buckets.
    order = (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
    least = _sliding(order, window, np.minimum)
    none = np.zeros(window - 1, np.uint32)
    # The largest of the minima of the windows around a place equals its own value if it is a minimum of one.
    places = np.flatnonzero(_sliding(np.concatenate([none, least, none]), window, np.maximum) == order)
    return places, hashes[places]


class Block:
    """The documents of a block in a fixed order, with their anchors."""

    def __init__(self, ids: list, texts: list[bytes], length: int):
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids, self.texts, self.length = [ids[i] for i in order], [texts[i] for i in order], length
        self.ranks = np.array([LATEST if i is None else i for i in self.ids], np.int64)
        found = [anchors(x, length) for x in self.texts]
        self.owner = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
        self.places = np.concatenate([p for p, _ in found] or [np.zeros(0, np.int64)])
        self.hashes = np.concatenate([h for _, h in found] or [np.zeros(0, np.uint64)]) & ~np.uint64(0xFFFF)

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in order, whether more than one id has them, and each anchor's number among them."""
        distinct, number = np.unique(self.hashes, return_inverse=True)
        low, high = np.full(len(distinct), LATEST), np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(low, number, self.ranks[self.owner])
        np.maximum.at(high, number, self.ranks[self.owner])
        return distinct, low != high, number

    def surroundings(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes around the anchors marked shared: distinct ones in order of the anchor with their smallest and
        largest id, the anchors' hashes, and the number of each marked anchor."""
        before = self.length - min(ANCHOR, self.length)
        width = 2 * self.length - min(ANCHOR, self.length)
        which = np.flatnonzero(shared)
        table = np.zeros((len(which), 12 + width), np.uint8)
        table[:, :8] = self.hashes[which].astype(">u8").view(np.uint8).reshape(-1, 8)
        spread = np.arange(width)
        cuts = np.searchsorted(self.owner[which], np.arange(len(self.texts) + 1))
        for d in np.unique(self.owner[which]).tolist():
            a, b = cuts[d], cuts[d + 1]
            text = np.frombuffer(self.texts[d], np.uint8)
            start = self.places[which[a:b]] - before
            at = start[:, None] + spread
            inside = (at >= 0) & (at < len(text))
            table[a:b, 12:] = np.where(inside, text[np.clip(at, 0, len(text) - 1)], 0)
            edges = np.stack([np.maximum(0, -start), np.minimum(width, len(text) - start)], 1)
            table[a:b, 8:12] = edges.astype(">u2").view(np.uint8)
        rows = np.ascontiguousarray(table).view(np.dtype((np.void, table.shape[1]))).ravel()
        order = np.argsort(rows, kind="stable")
        first = np.append(True, rows[order[1:]] != rows[order[:-1]])[: len(order)]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(first) - 1
        distinct = table[order[first]]
        low, high = np.full(len(distinct), LATEST), np.full(len(distinct), np.iinfo(np.int64).min)
        ranks = self.ranks[self.owner[which]]
        np.minimum.at(low, number, ranks)
        np.maximum.at(high, number, ranks)
        return distinct[:, 8:], low, high, self.hashes[which][order[first]], number


def bucket_edges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in hashes in order; one more entry ends the last."""
    bucket = (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1).astype(np.uint64))


def shared_anchors(asked: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For each block's anchors in a bucket whether another block, or another of its own documents, has it."""
    every = np.concatenate([a for a, _ in asked])
    flags = np.concatenate([f for _, f in asked])
    _, number, counts = np.unique(every, return_inverse=True, return_counts=True)
    several = (counts > 1)[number] | flags
    return np.split(several, np.cumsum([len(a) for a, _ in asked])[:-1])


class Array:
    """The distinct surroundings of a bucket's anchors in order of the strings from the anchor on.

    around: two numbers of two bytes (first and end of the bytes that exist) and the bytes, for each row.
    """

    def __init__(self, around: np.ndarray, low: np.ndarray, high: np.ndarray, length: int):
        anchor, n = min(ANCHOR, length), len(around)
        self.length, self.anchor, self.before = length, anchor, length - anchor
        edges = np.ascontiguousarray(around[:, :4]).view(">u2").astype(np.int64)
        has_left, has_right = self.before - edges[:, 0], edges[:, 1] - self.before
        # Where bytes end counts as smaller than any byte: the filling is zero, and equal strings go by what they have.
        left = np.concatenate([around[:, 4 : 4 + self.before][:, ::-1], has_left[:, None].astype(np.uint8)], 1)
        keys = np.concatenate([around[:, 4 + self.before :], has_right[:, None].astype(np.uint8), left], 1)
        rows = keys.view(np.dtype((np.void, keys.shape[1]))).ravel()
        order = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.append(True, rows[order[1:]] != rows[order[:-1]])[:n])
        self.number = np.empty(n, np.int64)  # each row's place among the distinct ones
        self.number[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
        self.low, self.high = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
        pick = order[first]
        self.left, self.has_left, self.has_right = left[pick], has_left[pick], has_right[pick]
        right = keys[pick, :length]
        differ = right[1:] != right[:-1]
        prefix = np.where(differ.any(1), differ.argmax(1), length)
        self.prefix = np.append(0, np.minimum(prefix, np.minimum(self.has_right[1:], self.has_right[:-1])))


def intervals(prefix: list[int], start: int, end: int, least: int):
    """Yields (depth, begins of children) of the intervals of entries start to end with a depth of least or more, those inside first.

    prefix: the common prefix of each entry with the one before; the one at start is not looked at. The last begin is the end.
    """
    stack: list[tuple[int, list[int]]] = []
    for i in range(start + 1, end + 1):
        depth = prefix[i] if i < end else -1
        begin = i - 1
        while stack and stack[-1][0] > depth:
            above, begins = stack.pop()
            yield above, begins + [i]
            begin = begins[0]
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][1].append(i)
            else:
                stack.append((depth, [begin, i]))


def maximal_repeats(array: Array):
    """Yields (bytes before the anchor, bytes from it on, members) of each repeat of several distinct surroundings that
    is longer to neither side for all its members, if it is at least ``length`` bytes long; members are places in the array."""
    width, prefix = array.before, array.prefix.tolist()
    meets = array.prefix >= array.anchor
    ends = np.flatnonzero(np.diff(np.concatenate([[0], meets, [0]]).astype(np.int8))).reshape(-1, 2)
    for a, b in ends.tolist():
        a -= 1
        left = [int.from_bytes(x.tobytes(), "big") for x in array.left[a:b]]
        has = array.has_left[a:b].tolist()
        for depth, begins in intervals(prefix, a, b, array.anchor):
            reach = array.length - depth  # bytes before the anchor that a whole string needs
            if reach > width:
                continue
            order = sorted(range(begins[0] - a, begins[-1] - a), key=left.__getitem__)
            shared = [0]
            for one, other in zip(order, order[1:]):
                bits = ((left[one] ^ left[other]) >> 8).bit_length()
                shared.append(min(width - (bits + 7) // 8, has[one], has[other]))
            for back, parts in intervals(shared, 0, len(order), max(reach, 0)):
                members = order[parts[0] : parts[-1]]
                if bisect_right(begins, min(members) + a) != bisect_right(begins, max(members) + a):
                    yield back, depth, [m + a for m in members]


def least_ids(array: Array):
    """Yields, for each place in order that a string of ``length`` bytes over the anchors can start at, the smallest id
    that each of the array's entries shares its string with (LATEST where it has none, or none below its own ids)."""
    low, high = array.low.tolist(), array.high.tolist()
    members, sizes, begins, ends, ids = [], [], [], [], []  # one size, begin, end and id a group
    for back, ahead, group in maximal_repeats(array):
        least = min([low[m] for m in group])
        group = [m for m in group if high[m] > least]
        if group:
            members += group
            sizes.append(len(group))
            begins.append(array.before - back)
            ends.append(array.before + ahead - array.length)
            ids.append(least)
    # An entry alone is a repeat as long as its bytes go.
    own = np.flatnonzero(array.high > array.low)
    sizes = np.array(sizes, np.int64)
    member = np.append(np.array(members, np.int64), own)
    begin = np.append(np.repeat(np.array(begins, np.int64), sizes), array.before - array.has_left[own])
    end = np.append(np.repeat(np.array(ends, np.int64), sizes), array.before + array.has_right[own] - array.length)
    least = np.append(np.repeat(np.array(ids, np.int64), sizes), array.low[own])
    for place in range(array.before + 1):
        out = np.full(len(low), LATEST)
        over = np.flatnonzero((begin <= place) & (place <= end))
        np.minimum.at(out, member[over], least[over])
        yield out


def runs(minima, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many entries each row has, and their place numbers and ids: an entry holds until the row's next one.

    Minima that no id of the row is above count as LATEST, which is also what holds before a row's first entry.
    """
    now, rows, places, ids = np.full(len(high), LATEST), [], [], []
    for place, least in enumerate(minima):
        told = np.where(least < high, least, LATEST)
        new = np.flatnonzero(told != now)
        rows.append(new)
        places.append(np.full(len(new), place, np.uint8))
        ids.append(told[new])
        now = told
    rows, places, ids = np.concatenate(rows), np.concatenate(places), np.concatenate(ids)
    order = np.argsort(rows, kind="stable")
    return np.bincount(rows, minlength=len(high)), places[order], ids[order]


def removed(block: Block, shared: np.ndarray, number: np.ndarray, answers: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """For each document (k, 2) begins and ends of what goes."""
    counts, windows, ids = answers
    before, n_windows = block.length - min(ANCHOR, block.length), block.length - min(ANCHOR, block.length) + 1
    ends = np.cumsum(counts)
    last = np.append(windows[1:], 0).astype(np.int64)[: len(windows)]
    last[ends[counts > 0] - 1] = n_windows  # a run goes on to the next, a row's last one to the end
    which = np.flatnonzero(shared)
    repeat = counts[number]
    owner, place = np.repeat(block.owner[which], repeat), np.repeat(block.places[which], repeat)
    entry = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat) + np.repeat((ends - counts)[number], repeat)
    goes = ids[entry] < block.ranks[owner]
    owner, place, entry = owner[goes], place[goes], entry[goes]
    begin = place - before + windows[entry].astype(np.int64)
    end = place - before + last[entry] - 1 + block.length
    cuts = np.searchsorted(owner, np.arange(len(block.texts) + 1))
    out = []
    for a, b, text in zip(cuts, cuts[1:], block.texts):
        if a == b:
            out.append(np.zeros((0, 2), np.int64))
            continue
        edge = np.zeros(len(text) + 1, np.int32)
        np.add.at(edge, begin[a:b], 1)
        np.add.at(edge, end[a:b], -1)
        flips = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(edge) > 0, [0]]).astype(np.int8)))
        out.append(flips.reshape(-1, 2))
    return out


def dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (long), n_bytes, begins and ends (array<int>) of what is removed, and kept (binary), for every row."""
    if not 1 <= length <= 200:
        raise ValueError("length must be from 1 to 200 bytes")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = parallelism(docs)
    n_blocks, buckets = max(tasks, -(-total // BLOCK_BYTES)), max(tasks, -(-total // BUCKET_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)).cast("int")).repartition(tasks, "block")

    def block_of(table: pa.Table) -> Block:
        return Block(table.column("id").to_pylist(), table.column("text").to_pylist(), length)

    def ask(key, table):
        distinct, flags, _ = block_of(table).asked()
        edges = bucket_edges(distinct, buckets)
        low = (distinct >> np.uint64(16)).view(np.int64)
        parts = [(k, np.ascontiguousarray(low[a:b]), flags[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        # Six bytes say as much of a hash as is used.
        packed = [p.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for _, p, _ in parts]
        return pa.table({"block": pa.array([key[0].as_py()] * len(parts), pa.int32()), "bucket": pa.array([k for k, *_ in parts], pa.int32()), "anchors": pa.array(packed, pa.binary()), "flags": pa.array([np.packbits(f).tobytes() for *_, f in parts], pa.binary())})

    asked = dealt.groupBy("block").applyInArrow(ask, "block int, bucket int, anchors binary, flags binary")

    def tell(key, table):
        got = []
        for a, f in zip(table.column("anchors").to_pylist(), table.column("flags").to_pylist()):
            n = len(a) // 6
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :6] = np.frombuffer(a, np.uint8).reshape(-1, 6)
            got.append((wide.view(np.int64).ravel(), np.unpackbits(np.frombuffer(f, np.uint8), count=n).astype(bool)))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "shared": pa.array([np.packbits(s).tobytes() for s in shared_anchors(got)], pa.binary())})

    told = asked.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(tell, "block int, bucket int, shared binary")

    def known(table: pa.Table, answers: pa.Table) -> tuple[Block, np.ndarray]:
        block = block_of(table)
        distinct, _, number = block.asked()
        edges = bucket_edges(distinct, buckets)
        shared = np.zeros(len(distinct), bool)
        for k, bits in zip(answers.column("bucket").to_pylist(), answers.column("shared").to_pylist()):
            if bits is not None:
                shared[edges[k] : edges[k + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=edges[k + 1] - edges[k])
        return block, shared[number]

    def show(key, table, answers):
        parts, at = [], pa.int32()
        if table.num_rows:
            block, shared = known(table, answers)
            around, low, high, hashes, _ = block.surroundings(shared)
            edges = bucket_edges(hashes, buckets)
            parts = [(k, pa.compress(around[a:b].tobytes(), CODEC, asbytes=True), low[a:b], high[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        return pa.table({"block": pa.array([key[0].as_py()] * len(parts), at), "bucket": pa.array([k for k, *_ in parts], at), "around": pa.array([p[1] for p in parts], pa.binary()), "low": pa.array([p[2] for p in parts], pa.list_(pa.int64())), "high": pa.array([p[3] for p in parts], pa.list_(pa.int64()))})

    shown = dealt.groupBy("block").cogroup(told.repartition(tasks, "block").groupBy("block")).applyInArrow(show, "block int, bucket int, around binary, low array<long>, high array<long>")

    def compare(key, table):
        table = table.combine_chunks()
        width = 4 + 2 * length - min(ANCHOR, length)
        sizes = table.column("low").combine_chunks().value_lengths().to_pylist()
        each = [np.frombuffer(pa.decompress(x, k * width, CODEC, asbytes=True), np.uint8).reshape(-1, width) for x, k in zip(table.column("around").to_pylist(), sizes)]
        low, high = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("low", "high"))
        array = Array(np.concatenate(each), low, high, length)
        sizes, windows, ids = runs((least[array.number] for least in least_ids(array)), high)
        cuts = np.cumsum([0, *map(len, each)])
        flat = np.append(0, np.cumsum(sizes))[cuts]
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"),
            "counts": pa.array([sizes[a:b].astype(np.uint8).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            "windows": pa.array([windows[a:b].tobytes() for a, b in zip(flat, flat[1:])], pa.binary()),
            "ids": pa.array([ids[a:b] for a, b in zip(flat, flat[1:])], pa.list_(pa.int64())),
        })

    compared = shown.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(compare, "block int, bucket int, counts binary, windows binary, ids array<long>")
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("shared", "binary"), ("counts", "binary"), ("windows", "binary"), ("ids", "array<long>"))}
    both = told.select("block", "bucket", "shared", *[none[c] for c in ("counts", "windows", "ids")]).union(compared.select("block", "bucket", none["shared"], "counts", "windows", "ids"))

    def cut(key, table, answers):
        if not table.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in out_schema}, schema=out_schema)
        block, shared = known(table, answers)
        *_, number = block.surroundings(shared)
        order = sorted((k, i) for i, (k, c) in enumerate(zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist())) if c is not None)
        pick = [i for _, i in order]
        joined = lambda c, kind: np.frombuffer(b"".join(x for x in (answers.column(c)[i].as_py() for i in pick)), kind)
        ids = np.concatenate([np.asarray(answers.column("ids")[i].as_py(), np.int64) for i in pick] or [np.zeros(0, np.int64)])
        spans = removed(block, shared, number, (joined("counts", np.uint8).astype(np.int64), joined("windows", np.uint8), ids))
        kept = []
        for text, s in zip(block.texts, spans):
            edges = [0, *s.ravel().tolist(), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        offsets, flat = np.cumsum([0, *map(len, spans)]), np.concatenate([*spans, np.zeros((0, 2), np.int64)])
        columns = [pa.array(block.ids, pa.int64()), pa.array(list(map(len, block.texts)), pa.int64()), *(list_column(flat[:, k].astype(np.int32), offsets, pa.int32()) for k in (0, 1)), pa.array(kept, pa.binary())]
        return pa.Table.from_arrays(columns, names=out_schema.names)

    out_schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("kept", pa.binary())])
    return dealt.groupBy("block").cogroup(both.repartition(tasks, "block").groupBy("block")).applyInArrow(cut, "doc_id long, n_bytes long, begins array<int>, ends array<int>, kept binary")
