"""Line deduplication by winnowing; DataFrame functions only.

The lines of a text that have a word are hashed, and in each window of
``window`` of them the smallest hash (the last of equals) is a fingerprint: any
run of so many equal lines in two places holds the same fingerprint in both.
Places are joined by fingerprint, and a window whose lines occurred before, in
the order of document and line, is a repeat (lines are told by 96 bits of
hash, so that 10^11 windows have no chance match). A run that goes on past a
window in both places has its further lines in windows of its own, which are
found the same way: the union of adjoining repeats is the match extended both
ways as far as it holds, against whichever earlier place holds it. That is the
later run, which is deleted. Places are never paired with each other, as pairs
would grow with the square of a common passage's copies.

A text of fewer lines than a window is a window as a whole. Lines without a
word are neither compared nor deleted. With ``least_words``, shorter runs of
lines that have so many words together are windows too, so that a long passage
counts as a repeat however few its lines are.

Defined cases: a null text stays null; an empty one stays empty; a line
repeated within a text counts as later there too; rows of equal id and text are
one document, cut alike; null ids come last in the order; very long texts and
lines are hashed whole; all columns of the input are kept as they are, whatever
their names, save the text (and, if told, its length).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WORD = r"[^\x20\x09-\x0D]"


def _with(value: Column, body) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(line: Column, least: int | None) -> Column:
    """Words of a line, or 0 if they don't matter."""
    return F.lit(0) if least is None else F.regexp_count(line, F.lit(WORD + "+"))


def _windows(lines: Column, window: int, least_words: int | None) -> Column:
    """For each window of the lines with words: its fingerprint (hash, -place), its first place, its own hash, and its lines' numbers in the text."""
    marked = F.transform(lines, lambda x, i: F.struct(F.when(x.rlike(WORD), F.xxhash64(x)).alias("h"), F.hash(x).alias("g"), i.alias("line"), _words(x, least_words).alias("words")))
    real = F.filter(marked, lambda x: x["h"].isNotNull())

    def made(rows: Column) -> Column:
        placed = F.transform(rows, lambda r, i: F.struct(r["h"].alias("h"), (-i).alias("back")))
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(rows) - window))
        one = lambda own, part, i: F.struct(F.array_min(part).alias("least"), i.alias("at"), F.struct(F.xxhash64(own["h"], F.lit(7)).alias("h"), F.hash(own["g"]).alias("g")).alias("own"), own["line"].alias("lines"))
        cut = lambda p, at, n: F.transform(at, lambda i: _with(F.slice(rows, i + 1, n), lambda own: one(own, F.slice(p, i + 1, n), i)))

        def long(n: int) -> Column:
            at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(rows) - n))
            words = lambda i: F.aggregate(F.slice(rows, i + 1, n), F.lit(0), lambda total, r: total + r["words"])
            return F.filter(at, lambda i: (F.size(rows) > n) & (words(i) >= least_words))

        shorter = [] if least_words is None else range(1, window)
        windows = _with(placed, lambda p: F.concat(cut(p, starts, window), *(cut(p, long(n), n) for n in shorter)))
        return F.when(F.size(rows) > 0, windows).otherwise(F.slice(windows, 1, 0))

    return _with(real, made)


def repeats(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text", least_words: int | None = None) -> DataFrame:
    """doc (absent, id, hash of the text) and gone, the numbers of its lines (from 0) in repeated windows."""
    text = F.col(text_col)
    key = F.struct(F.col(id_col).isNull().alias("absent"), F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    cut = docs.where(text.isNotNull()).select(key.alias("doc"), F.posexplode(_windows(F.split(text, "\n"), window, least_words)).alias("k", "w"))
    rows = cut.select("doc", F.col("w.least.h").alias("print"), F.col("w.least.back").alias("back"), F.col("w.own").alias("own"), F.col("w.lines").alias("lines"))
    rows = written(rows, "line-windows")
    # A fingerprint's windows in a text follow one another and share its place; it is in two places if these differ.
    place = F.xxhash64("doc", "back")
    shared = written(rows.groupBy("print").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("print"), "line-prints")
    at = F.element_at("lines", 1).alias("at")
    found = rows.join(shared, "print").select("doc", at, "own", "lines")
    firsts = written(found.groupBy("own").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").select("own", "first"), "line-firsts")
    later = found.join(firsts, "own").where(F.struct("doc", "at") > F.col("first"))
    return later.select("doc", F.explode("lines").alias("line")).groupBy("doc").agg(F.collect_set("line").alias("gone"))


def dedup(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, least_words: int | None = None) -> DataFrame:
    """docs without the later of repeated runs of lines; length_col, if given, follows the new text. ``measured`` counts lines."""
    done = _cut(docs, window, id_col, text_col, least_words)
    new = F.col("text")
    columns = [new.alias(c) if c == text_col else F.when(F.col("n_removed") > 0, F.length(new)).otherwise(F.col(f"row.`{c}`")).cast(t).alias(c) if c == length_col else F.col(f"row.`{c}`").alias(c) for c, t in docs.dtypes]
    return done.select(*columns)


def measured(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text", least_words: int | None = None) -> DataFrame:
    """id, the text that stays, and how many of its n_lines lines were removed."""
    return _cut(docs, window, id_col, text_col, least_words).select(F.col(f"row.`{id_col}`").alias("doc_id"), "text", "n_lines", "n_removed")


def _cut(docs: DataFrame, window: int, id_col: str, text_col: str, least_words: int | None) -> DataFrame:
    found = repeats(docs, window, id_col, text_col, least_words).select(F.col("doc.id").alias("id"), F.col("doc.hash").alias("hash"), "gone")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text, own = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`")
    joined = whole.withColumns({"_id": own, "_hash": F.xxhash64(text)}).join(found, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("hash")), "left")
    lines = F.split(text, "\n")
    # What lies between the lines that go, so that the work stays in proportion to the lines.
    kept = _with(F.concat(F.array(F.lit(-1)), F.array_sort("gone"), F.array(F.size(lines))), lambda cut: F.flatten(F.transform(F.sequence(F.lit(1), F.size(cut) - 1), lambda k: F.slice(lines, cut[k - 1] + 2, cut[k] - cut[k - 1] - 1))))
    n = F.when(text.isNull(), 0).otherwise(F.size(lines))
    return joined.select(
        "row",
        F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text"),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def oracle(window: int = 3) -> str:
    """The op4 query's rows in DuckDB SQL: every window compared with every other by grouping."""
    joined = " || chr(10) || ".join(["line", *(f"coalesce(lead(line, {k}) OVER o, '')" for k in range(1, window))])
    inside = " OR ".join(f"r.i = f.i + {k}" for k in range(window))
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln
  FROM documents WHERE text IS NOT NULL
), real AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS m
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), wins AS (
  SELECT doc_id, i, md5({joined} || chr(10) || least(m, {window})) AS own, m FROM real WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), flagged AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY own ORDER BY doc_id, i) AS k FROM wins WHERE i <= greatest(m - {window}, 0)) WHERE k > 1
), gone AS (SELECT DISTINCT r.doc_id, r.ln FROM real r JOIN flagged f ON r.doc_id = f.doc_id AND ({inside})
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.ln) FILTER (WHERE g.ln IS NULL) AS text, count(*) AS n_lines, count(g.ln) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.ln = g.ln GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
