"""SimHash near-duplicates through sharded BK-trees.

A text's fingerprint has a bit for each bit of the 64-bit hashes of its word
shingles: 1 if it is set in over half of them. Fingerprints within ``radius``
bits are linked. Cut into more blocks than the radius, two such fingerprints
agree in some set of blocks, so they meet in the shard named by a few bits of
these. Each shard of some two thousand fingerprints has a BK-tree (children
keyed by their Hamming distance to the parent) that is searched for each of its
fingerprints, following only edges whose key is within the radius of the
distance. How many bits name a shard follows from the number of fingerprints; a
shard that is large all the same is dealt into parts, and trees of parts are
searched for each part. Trees stay with their shard: all of them together grow
with the table, so they are no data to broadcast, and fingerprints of other
shards have nothing to find in them.

Defined cases: a null or wordless text has fingerprint zero and is linked like
any other; a text of fewer words than a shingle is one shingle; equal
fingerprints are one node, so copies are never paired; rows of equal id are one
document to the component's id; a null id is in a component but never names it,
unless all ids in it are null (then the component is null); other columns are
ignored.

``keep_one`` is the filter on likeness of whole texts, for which the radius has
to be wide: there shards hold the texts that share one of a few smallest
shingle hashes, the trees are searched with a wide radius, and what is found is
held against a min-hash signature with slack. Texts that pass meet again with
their distinct shingle hashes, and only a counted likeness makes a link.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, parallelism, text_bytes, written
from .components import components

BITS = 64
#: Fingerprints of a shard's part at most, about; a task holds two parts at a time.
PART = 4096
#: Distinct fingerprints that a shard holds, about, if they are random.
SHARD = 2048


def shingle_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle of a text, in order; only A-Z are lower-cased."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, seed)] if words else [], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(words) - shingle + 1]
    return np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist())], np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint, as a signed long, of every row."""

    def work(batches):
        for batch in batches:
            each = [shingle_hashes(x, shingle, seed) for x in batch.column("text").to_pylist()]
            prints = majority(np.concatenate(each), np.array(list(map(len, each))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], ["id", "fingerprint"])

    kind = dict(docs.dtypes)[id_col]
    return map_texts(docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), work, f"id {kind}, fingerprint long").withColumnRenamed("id", id_col)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each group of hashes, laid end to end, the bits set in over half of them."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(sizes) - sizes)[full]
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * counts > sizes[full][:, None], axis=1).view(">u8").ravel()
    return out


def blocks(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """The bits to agree on, each a list of (shift, width), so that shards of n random fingerprints hold about SHARD. Two that differ in radius bits at most agree in one of them."""
    bits = max(1, (n // SHARD).bit_length())
    for more in range(1, 6):
        count = radius + more
        edges = [BITS * k // count for k in range(count + 1)]
        if bits <= BITS * more // count or more == 5:
            break
    widths = [bits * (k + 1) // more - bits * k // more for k in range(more)]
    return [[(edges[k], min(w, edges[k + 1] - edges[k])) for k, w in zip(chosen, widths)] for chosen in combinations(range(count), more)]


class BKTree:
    """Values by Hamming distance. Edges are keyed by the child's distance to its parent."""

    def __init__(self, values: list[int]):
        self.values, self.children = values, [{} for _ in values]
        for i in range(1, len(values)):
            at, value = 0, values[i]
            while True:
                d = (values[at] ^ value).bit_count()
                child = self.children[at].get(d)
                if child is None:
                    self.children[at][d] = i
                    break
                at = child

    def near(self, queries: np.ndarray, radius: int):
        """Yields a node's number and the queries' numbers within radius of it; queries walk down together."""
        values = np.array(self.values, np.uint64)
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, own = todo.pop()
            d = np.bitwise_count(queries[own] ^ values[node])
            hit = own[d <= radius]
            if len(hit):
                yield node, hit
            for key, child in self.children[node].items():
                go = own[(d >= key - radius) & (d <= key + radius)] if key > radius else own[d <= key + radius]
                if len(go):
                    todo.append((child, go))


class _Sets:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def tree_links(trees: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join whatever is within radius of a tree's value, no more than values are."""
    sets, asked = _Sets(), np.array(queries, np.uint64)
    for node, hit in BKTree(trees).near(asked, radius):
        for q in asked[hit].tolist():
            sets.join(trees[node], q)
    return [(x, sets.find(x)) for x in list(sets.up) if sets.find(x) != x]


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b), enough to connect all of the distinct fingerprints that are within radius of one another."""
    n = prints.count()
    tables = blocks(n, radius)
    keys = []
    for k, chosen in enumerate(tables):
        shard = F.lit(k).cast("long")
        for shift, width in chosen:
            part = F.shiftrightunsigned("fingerprint", shift) if shift else F.col("fingerprint")
            shard = F.xxhash64(shard, part.bitwiseAND((1 << width) - 1))
        keys.append(shard)
    rows = prints.select("fingerprint", F.explode(F.array(*keys)).alias("shard"))
    order = ["shard", "tree", "ask"]
    pairs = _dealt(rows, F.xxhash64("fingerprint"))

    def group(table: pa.RecordBatch, mine: np.ndarray, asks: np.ndarray) -> list[tuple[int, int]]:
        values = table.column("fingerprint").to_numpy().view(np.uint64)
        return tree_links(values[mine].tolist(), values[asks].tolist(), radius)

    work = _streamed(group, lambda found: _link_batch(found))
    return pairs.repartition(parallelism(prints), *order).sortWithinPartitions(*order, "part").mapInArrow(work, "a long, b long").distinct()


def _dealt(rows: DataFrame, by: Column) -> DataFrame:
    """rows with tree, ask and part: a shard above PART rows is dealt into parts, and each pair of parts meets once."""
    large = written(rows.groupBy("shard").count().where(F.col("count") > PART).select("shard", F.ceil(F.col("count") / PART).alias("parts")), "large-shards")
    dealt = rows.join(large, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(by, F.col("parts"))
    both = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("tree"), F.greatest("part", o).alias("ask")))
    return dealt.withColumn("part", part).withColumn("pair", F.explode(both)).select("*", "pair.tree", "pair.ask").drop("pair", "parts")


def _streamed(group, out):
    """A map over batches sorted by (shard, tree, ask): calls group(rows, tree rows, asking rows) for each; a group may run over batches."""

    def scan(table: pa.RecordBatch, last: bool):
        shard, tree, ask, part = (table.column(c).to_numpy() for c in ("shard", "tree", "ask", "part"))
        n = len(shard)
        cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(tree) != 0) | (np.diff(ask) != 0)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.append(cuts, n)
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        found: list = []
        several = ends - starts > 1
        for a, b in zip(starts[several].tolist(), ends[several].tolist()):
            every = np.arange(b - a)
            mine = every[part[a:b] == tree[a]]
            asks = every if tree[a] == ask[a] else every[part[a:b] != tree[a]]
            if len(mine) and len(asks):
                found += group(table.slice(a, b - a), mine, asks)
        return (None if last else table.slice(int(cuts[-1]) if len(cuts) else 0)), found

    def work(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rest, found = scan(batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0], False)
            if found:
                yield out(found)
        if rest is not None:
            _, found = scan(rest, True)
            if found:
                yield out(found)

    return work


def _link_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(found, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (long) and component_id, the smallest id reachable over links, of every row."""
    marked = written(fingerprints(docs, shingle, seed, id_col, text_col).withColumnRenamed(id_col, "doc_id"), "fingerprints")
    nodes = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fingerprint"), radius))
    rooted = nodes.join(roots, nodes.fingerprint == roots.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(named, "root").select("fingerprint", "component_id")
    return marked.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")



#: Defaults: smallest shingle hashes that name a text's shards; values of its signature.
SHARDS, SIGNATURE = 4, 128
#: Default of what a signature may fall short of the likeness asked for; over three standard errors at 0.8.
SLACK = 0.12


def signature(hashes: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """A byte from each of ``size`` min-hashes."""
    factors = np.random.default_rng(13).integers(0, 2**31, size).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    least = ((hashes >> np.uint64(32)).astype(np.uint32)[:, None] * factors).min(0)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def alike(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Likeness (shared part of the united shingles) told from signatures, chance matches of bytes taken off."""
    return ((others == one).mean(1) - 1 / 256) / (1 - 1 / 256)


def likely(prints: np.ndarray, signs: np.ndarray, mine: np.ndarray, asks: np.ndarray, radius: int, least: float, slack: float = SLACK) -> np.ndarray:
    """Rows that have another within the radius whose signature is alike but for slack."""
    flag = np.zeros(len(prints), bool)
    for node, hit in BKTree(prints[mine].tolist()).near(prints[asks], radius):
        row = mine[node]
        rows = asks[hit]
        rows = rows[(rows != row) & ~(flag[rows] & flag[row])]
        rows = rows[alike(signs[row], signs[rows]) >= least - slack]
        if len(rows):
            flag[row] = flag[rows] = True
    return np.flatnonzero(flag)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Shared part of the united shingles, counted; both are sorted and distinct."""
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return shared / (len(one) + len(other) - shared)


def likeness_links(prints: np.ndarray, signs: np.ndarray, shingles: list[np.ndarray], mine: np.ndarray, asks: np.ndarray, radius: int, least: float, slack: float = SLACK) -> list[tuple[int, int]]:
    """Pairs of rows that join all that are alike as counted, no more than rows are; only counted links spare a later count."""
    label, found = np.arange(len(prints)), []
    sizes = np.array(list(map(len, shingles)))
    for node, hit in BKTree(prints[mine].tolist()).near(prints[asks], radius):
        row = mine[node]
        rows = asks[hit]
        rows = rows[label[rows] != label[row]]
        rows = rows[np.minimum(sizes[rows], sizes[row]) / np.maximum(sizes[rows], sizes[row]) >= least]
        if len(rows):
            for other in rows[alike(signs[row], signs[rows]) >= least - slack].tolist():
                if label[other] != label[row] and likeness(shingles[row], shingles[other]) >= least:
                    found.append((int(row), other))
                    label[label == label[other]] = label[row]
    return found


def _key(text_col: str) -> Column:
    return F.unhex(F.md5(text_bytes(text_col)))


def alike_groups(docs: DataFrame, shingle: int = 5, least: float = 0.8, radius: int = 18, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", shards: int | None = SHARDS, signature_size: int = SIGNATURE, slack: float = SLACK) -> DataFrame:
    """key (md5 of the text) and root, the same for all texts of a group, for every text that isn't its group's root.

    Every link is a counted likeness. Candidates share one of a text's ``shards``
    smallest shingle hashes, lie within the radius, and have signatures that are
    alike but for slack; shards=None (all hashes), radius=64 and slack=1 leave
    nothing to chance, at the cost of a row for each shingle of each text.
    """

    def mark(batches):
        for batch in batches:
            each = [shingle_hashes(x, shingle, seed) for x in batch.column("text").to_pylist()]
            prints = majority(np.concatenate(each), np.array(list(map(len, each))))
            least_hashes = [np.unique(h)[:shards].view(np.int64) for h in each]
            signs = [signature(h, signature_size).tobytes() if len(h) else bytes(signature_size) for h in each]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(prints.view(np.int64)), pa.array(least_hashes, pa.list_(pa.int64())), pa.array(signs, pa.binary())], ["key", "fingerprint", "shards", "signature"])

    def count(batches):
        for batch in batches:
            each = [np.unique(shingle_hashes(x, shingle, seed)).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(each, pa.binary())], ["key", "shingles"])

    keyed = docs.select(_key(text_col).alias("key"), text_bytes(text_col).alias("text"))
    texts = map_texts(keyed, mark, "key binary, fingerprint long, shards array<long>, signature binary")
    nodes = written(texts.dropDuplicates(["key"]), "alike-nodes")
    rows = nodes.select("key", F.explode("shards").alias("shard"))
    shared = written(rows.groupBy("shard").count().where("count > 1").select("shard"), "alike-shards")
    met = rows.join(shared, "shard").join(nodes.select("key", "fingerprint", "signature"), "key")
    order = ["shard", "tree", "ask"]
    place = ["shard", "tree", "ask", "part", "key"]

    def dealt(rows: DataFrame, group, out, schema: str) -> DataFrame:
        return rows.repartition(parallelism(docs), *order).sortWithinPartitions(*order, "part").mapInArrow(_streamed(group, out), schema)

    def marks(table: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8)
        return table.column("fingerprint").to_numpy().view(np.uint64), signs.reshape(table.num_rows, -1)

    def search(table: pa.RecordBatch, mine: np.ndarray, asks: np.ndarray) -> list[pa.RecordBatch]:
        rows = likely(*marks(table), mine, asks, radius, least, slack)
        return [table.select(place).take(pa.array(rows))] if len(rows) else []

    def met_again(found):
        return pa.Table.from_batches(found).combine_chunks().to_batches()[0]

    def group(table: pa.RecordBatch, mine: np.ndarray, asks: np.ndarray) -> list[tuple[bytes, bytes]]:
        keys = table.column("key").to_pylist()
        shingles = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        return [(keys[a], keys[b]) for a, b in likeness_links(*marks(table), shingles, mine, asks, radius, least, slack)]

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], ["a", "b"])

    close = written(dealt(_dealt(met, F.xxhash64("key")), search, met_again, "shard long, tree long, ask long, part long, key binary"), "alike-met")
    again = keyed.join(close.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    counted = written(map_texts(again, count, "key binary, shingles binary"), "alike-shingles")
    whole = close.join(counted, "key").join(nodes.select("key", "fingerprint", "signature"), "key")
    pairs = dealt(whole, group, out, "a binary, b binary")
    return components(pairs.distinct()).select(F.col("node").alias("key"), "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of each group of alike texts, that with the smallest id (nulls last, then the text's hash); all other rows as they are."""
    groups = alike_groups(docs, id_col=id_col, text_col=text_col, **settings)
    rows = docs.select(F.col(id_col).alias("id"), _key(text_col).alias("key"))
    first = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "key")).alias("first")
    firsts = written(rows.groupBy("key").agg(first), "alike-firsts")
    rooted = firsts.join(groups, "key", "left").select("first", F.coalesce("root", "key").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.id").alias("_kept_id"), F.col("first.key").alias("_kept_key"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("_id"), _key(text_col).alias("_key"))
    joined = whole.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_key") == F.col("_kept_key")))
    only = F.row_number().over(Window.partitionBy("_id", "_key").orderBy("_key"))
    return joined.withColumn("n", only).where("n = 1").select("row.*")
