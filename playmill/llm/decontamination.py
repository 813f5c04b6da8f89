"""Finds passages of benchmark items in documents by winnowing.

A window is ``length`` words in a row; an item of fewer words is one window as
a whole. Of the word grams of half a window's length that lie in a window the
least hash is the window's fingerprint, so every shared window holds the same
fingerprint in document and item: no shared span of a window's length or more
is missed. Documents keep those fingerprints that a bit table of fixed size,
made of all of the items' fingerprints, doesn't rule out. They are joined with
the items' fingerprints, and each hit is extended: of the windows around it,
those stay that an item has too (told by 128 bits of hash). Windows that touch
or overlap make up the shared span. A window is met once however many items
hold it; windows of the same items are one class, and texts of equal words and
sets of equal classes are settled once, so that no document is paired with each
item of a common passage before the list that it is asked for.

Defined cases: a null or wordless text has no words, hits nothing and is hit by
nothing; only A-Z are lower-cased; rows of an item's id are one item, with the
windows of all its rows; a null item id is written as the empty text; rows of
equal document id are rows of their own, null ids are kept; repeated words and
rows count like any other; very long texts are hashed in stretches; an empty
table of items hits nothing, an empty table of documents gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, text_bytes, written

#: Words that are windows taken at a time.
STRETCH = 1 << 18
#: Distinct words, and bytes of them, whose hashes a worker keeps; when there are more, it starts anew.
KEPT_WORDS, KEPT_BYTES = 400_000, 16 << 20
#: Bits of the table that rules fingerprints out; the same whatever the number of items.
TABLE_BITS = 1 << 26
#: Everything but letters, digits and what is beyond ASCII parts words.
FOLDED = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256))


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _factors(seed: int, n: int = 64) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class Words:
    """Two hashes of each word that a worker has met."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.hashes, self.held = np.zeros((2, 0), np.uint64), 0

    def numbers(self, text: bytes) -> np.ndarray:
        """Numbers of a folded text's words, in order; a long text is cut at spaces."""
        parts, start = [], 0
        while start < len(text):
            stop = text.find(b" ", start + (1 << 20))
            stop = len(text) if stop < 0 else stop
            parts.append(self._numbers(text[start:stop].split()))
            start = stop
        return np.concatenate([np.zeros(0, np.int64), *parts])

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_128_intdigest

        known = self.known
        out, new = list(map(known.get, words)), []
        for i in [i for i, k in enumerate(out) if k is None]:
            out[i] = known.setdefault(words[i], len(known))
            if out[i] == self.hashes.shape[1] + len(new):
                new.append(words[i])
        if new:
            digests = b"".join(xxh3_128_intdigest(w).to_bytes(16, "little") for w in new)
            self.hashes = np.concatenate([self.hashes, np.frombuffer(digests, "<u8").reshape(-1, 2).T], axis=1)
            self.held += sum(map(len, new))
        return np.array(out, np.int64)

    @property
    def full(self) -> bool:
        return len(self.known) > KEPT_WORDS or self.held > KEPT_BYTES


def _combined(hashes: np.ndarray, length: int, factors: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """A hash of the ``length`` words from each place on, or from the places ``at``."""
    total = np.uint64(0)
    for k in range(length):
        total = total + (hashes[at + k] if at is not None else hashes[k : len(hashes) - length + 1 + k]) * factors[k]
    return _mixed(total)


def fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """Of each window, the least hash of the grams in it."""
    gram = (length + 1) // 2
    grams = _combined(hashes, gram, _factors(gram))
    n = len(hashes) - length + 1
    least = grams[:n]
    for k in range(1, length - gram + 1):
        least = np.minimum(least, grams[k : n + k])
    return least


def windows(hashes: np.ndarray, length: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of the windows that begin at ``at``; hashes has two rows."""
    return tuple(_combined(hashes[k], length, _factors(1000 + 100 * k + length), at) for k in (0, 1))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def item_windows(items: DataFrame, length: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (text), length, print, w1 and w2 of each distinct window of the items."""

    def work(batches):
        words = Words()
        for batch in batches:
            if words.full:
                words = Words()
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                number = words.numbers(text.translate(FOLDED))
                n = min(length, len(number))
                for a in range(0, len(number) - n + 1 if n else 0, STRETCH):
                    h = words.hashes[:, number[a : a + STRETCH + n - 1]]
                    prints = fingerprints(h[0], n)
                    w1, w2 = windows(h, n, np.arange(len(prints)))
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(prints), pa.string()), pa.array(np.full(len(prints), n, np.int32)), _signed(prints), _signed(w1), _signed(w2)], ["item", "length", "print", "w1", "w2"])

    given = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), text_bytes(text_col).alias("text"))
    return map_texts(given, work, "item string, length int, print long, w1 long, w2 long").distinct()


def _places(prints: np.ndarray) -> np.ndarray:
    """The three bits of the table that a fingerprint sets."""
    return np.stack([(prints >> np.uint64(s)) & np.uint64(TABLE_BITS - 1) for s in (0, 19, 38)])


def bit_table(prints: DataFrame) -> np.ndarray:
    """The table as 64-bit numbers: TABLE_BITS / 64 of them at most leave the tasks."""
    low = F.lit(TABLE_BITS - 1).cast("long")
    bit = F.explode(F.array(*[F.shiftrightunsigned("print", s).bitwiseAND(low) for s in (0, 19, 38)])).alias("bit")
    words = prints.select(bit).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
    rows = words.toPandas()
    out = np.zeros(TABLE_BITS // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _ruled_in(table: np.ndarray, prints: np.ndarray) -> np.ndarray:
    one = np.uint64(1)
    fine = np.ones(len(prints), bool)
    for place in _places(prints):
        fine &= (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & one == one
    return fine


HITS = "array<struct<length: int, print: long, windows: array<struct<at: int, w1: long, w2: long>>>>"


def marked(docs: DataFrame, lengths: list[int], sent, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, hits (fingerprints that may be an item's, each with the windows that it stands for) and, where there are any, d1 and d2, 128 bits of hash of all words."""

    def work(batches):
        from xxhash import xxh3_128_intdigest

        words, table = Words(), sent.value
        for batch in batches:
            if words.full:
                words = Words()
            folded = [x.translate(FOLDED) for x in batch.column("text").to_pylist()]
            each = [words.numbers(x) for x in folded]
            sizes = np.array(list(map(len, each)), np.int64)
            number, ends = np.concatenate(each), np.cumsum(sizes)
            begins = ends - sizes
            owner = np.repeat(np.arange(len(sizes)), sizes)
            found = []
            for length in lengths:
                for a in range(0, len(number) - length + 1, STRETCH):
                    h = words.hashes[:, number[a : a + STRETCH + length - 1]]
                    prints = fingerprints(h[0], length)
                    at = np.flatnonzero(_ruled_in(table, prints))
                    at = at[a + at + length <= ends[owner[a + at]]]
                    if len(at):
                        doc = owner[a + at]
                        found.append((doc, np.full(len(at), length), a + at - begins[doc], prints[at], *windows(h, length, at)))
            rows = [np.concatenate(x) for x in zip(*found)] or [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 3
            order = np.lexsort((rows[2], rows[1], rows[0]))
            doc, length, at, prints, w1, w2 = (x[order] for x in rows)
            new = np.append(True, (np.diff(doc) != 0) | (np.diff(length) != 0) | (prints[1:] != prints[:-1]) | (np.diff(at) != 1))[: len(doc)]
            first = np.flatnonzero(new)
            inner = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), _signed(w1), _signed(w2)], ["at", "w1", "w2"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), inner)
            hits = pa.StructArray.from_arrays([pa.array(length[first].astype(np.int32)), _signed(prints[first]), lists], ["length", "print", "windows"])
            per = np.bincount(doc[first], minlength=len(sizes)) if len(first) else np.zeros(len(sizes), np.int64)
            hits = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per)).astype(np.int32)), hits)
            digests = [xxh3_128_intdigest(b" ".join(x.split())) if n else None for x, n in zip(folded, per.tolist())]
            half = lambda shift: pa.array([None if d is None else ((d >> shift) & (2**64 - 1)) - (1 << 63) for d in digests], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes), half(0), half(64), hits], ["id", "n_words", "d1", "d2", "hits"])

    kind = dict(docs.dtypes)[id_col]
    return map_texts(docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), work, f"id {kind}, n_words long, d1 long, d2 long, hits {HITS}")


def contaminated(docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """id, n_words, n_hit, spans (first and last word, exclusive, of the shared spans), n_items and items, their ids comma-joined, of every row."""
    if not 1 <= length <= 60:
        raise ValueError("a window has 1 to 60 words")
    owned = written(item_windows(items, length, item_id, item_text), "bench-windows")
    # The items of a window, as 128 bits: windows of the same items are one class.
    known = owned.groupBy("length", "w1", "w2", "print").agg(F.bit_xor(F.xxhash64("item", F.lit(1))).alias("c1"), F.bit_xor(F.xxhash64("item", F.lit(2))).alias("c2"))
    known = written(known, "bench-classes")
    of_class = known.groupBy("c1", "c2").agg(F.min(F.struct("length", "w1", "w2")).alias("w")).select("c1", "c2", "w.*")
    of_class = of_class.join(owned, ["length", "w1", "w2"]).select("c1", "c2", "item")
    prints = known.select("length", "print").distinct()
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())
    sent = docs.sparkSession.sparkContext.broadcast(bit_table(prints))
    rows = written(marked(docs, lengths, sent, id_col, text_col), "marked")

    once = rows.where(F.col("d1").isNotNull()).select("d1", "d2", "hits").dropDuplicates(["d1", "d2"])
    hit = once.select("d1", "d2", F.explode("hits").alias("hit")).select("d1", "d2", "hit.*").join(prints, ["length", "print"])
    grown = hit.select("d1", "d2", "length", F.explode("windows").alias("w")).select("d1", "d2", "length", "w.*").join(known.drop("print"), ["length", "w1", "w2"])
    begin, end = F.col("at").cast("long"), (F.col("at") + F.col("length")).cast("long")
    grown = written(grown.select("d1", "d2", begin.alias("begin"), end.alias("end"), "c1", "c2"), "grown-hits")
    classes = grown.groupBy("d1", "d2").agg(F.array_sort(F.collect_set(F.struct("c1", "c2"))).alias("classes"))
    per = classes.select("d1", "d2", "classes", F.sha2(F.to_json("classes"), 256).alias("set")).join(_spans(grown), ["d1", "d2"])
    per = written(per, "hit-texts")

    sets = per.dropDuplicates(["set"]).select("set", F.explode("classes").alias("c")).select("set", "c.*")
    listed = sets.join(of_class, ["c1", "c2"]).select("set", "item").distinct().groupBy("set")
    listed = listed.agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    settled = per.join(listed, "set").select("d1", "d2", "spans", "n_items", "items")

    none = F.lit(0).cast("long")
    empty = F.array().cast("array<struct<begin: long, end: long>>")
    clean = rows.where(F.col("d1").isNull()).select("id", "n_words", none.alias("n_hit"), empty.alias("spans"), none.alias("n_items"), F.lit("").alias("items"))
    met = rows.where(F.col("d1").isNotNull()).select("id", "n_words", "d1", "d2").join(settled, ["d1", "d2"], "left")
    n_hit = F.aggregate(F.coalesce("spans", empty), none, lambda total, s: total + s["end"] - s["begin"])
    met = met.select("id", "n_words", n_hit.alias("n_hit"), F.coalesce("spans", empty).alias("spans"), F.coalesce("n_items", none).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"))
    return clean.unionByName(met).withColumnRenamed("id", id_col)


def _spans(grown: DataFrame) -> DataFrame:
    """d1, d2 and spans: windows that touch or overlap are one span."""
    before = Window.partitionBy("d1", "d2").orderBy("begin", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    apart = grown.select("d1", "d2", "begin", "end").withColumn("new", F.when(F.col("begin") <= reach, 0).otherwise(1))
    each = apart.withColumn("k", F.sum("new").over(before)).groupBy("d1", "d2", "k").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return each.groupBy("d1", "d2").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def oracle(length: int = 10) -> str:
    """The op13 query's rows in DuckDB SQL: every window of every length compared by its words."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS own, doc_id, {words} AS w FROM documents
), items AS (SELECT item_id, {words} AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, n, list_aggregate(w[i + 1:i + n], 'string_agg', ' ') AS win
  FROM (SELECT item_id, w, least(len(w), {length}) AS n, unnest(range(len(w) - least(len(w), {length}) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM wins
), places AS (
  SELECT own, n, i, list_aggregate(w[i + 1:i + n], 'string_agg', ' ') AS win
  FROM (SELECT own, n, w, unnest(range(len(w) - n + 1)) AS i FROM docs, lengths WHERE len(w) >= n)
), met AS (SELECT p.own, p.n, p.i, x.item_id FROM places p JOIN wins x ON p.n = x.n AND p.win = x.win
), hit AS (SELECT own, count(DISTINCT i + k) AS n_hit FROM (SELECT own, i, unnest(range(n)) AS k FROM (SELECT DISTINCT own, n, i FROM met)) GROUP BY own
), listed AS (
  SELECT own, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT own, coalesce(item_id::VARCHAR, '') AS item FROM met) GROUP BY own
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (own) LEFT JOIN listed USING (own)
"""
