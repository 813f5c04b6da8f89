"""Quality rules on repetition.

A suffix array over the words of each text, with the longest common prefix of
neighbours, gives for every word position the longest repeat starting there:
the deepest prefix interval that holds the suffix. Repeats of at least
``least_repeat`` words are joined into covered spans; a text is rejected when
these cover too large a share of its words or the longest one is too long.
The arrays of many texts are built together: a text's number is the first
symbol of order, so that no repeat crosses texts. Short base rules come before.

Defined cases: a null text has no words and is rejected by the base rule (as is
an empty one); ties in the suffix order cannot occur, as suffixes differ in
length; repeated rows are each judged; null ids are kept; other columns are
ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, text_bytes

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: Words of the fixed window of the base rule.
WINDOW = 8
#: Share of words in long repeats that a text may have. All of these words lie in the base rule's windows too, so a
#: limit of its 0.3 would decide nothing; of 3302 labelled good texts of sf0.1 that pass it, none has more than 0.158.
MOST_COVERED = 0.2


def suffix_order(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of several sequences laid end to end, and each entry's common prefix with the entry before.

    Ranks by prefix doubling; only suffixes that are still tied are sorted again.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stop = np.append(np.flatnonzero(np.diff(owner)) + 1, n)
    end = np.repeat(stop, np.diff(stop, prepend=0))
    key = owner.astype(np.int64) * (int(symbols.max()) + 2) + symbols
    order = np.argsort(key, kind="stable")
    first = np.append(True, np.diff(key[order]) != 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    pending = np.flatnonzero(~(first & np.append(first[1:], True)))
    step = 1
    while len(pending):
        at = order[pending]
        after = at + step
        second = np.where(after < end[at], rank[np.minimum(after, n - 1)] + 1, 0)
        group = rank[at]
        again = np.lexsort((second, group))
        at, second, group = at[again], second[again], group[again]
        order[pending] = at
        new = np.append(True, (np.diff(group) != 0) | (np.diff(second) != 0))
        place = np.maximum.accumulate(np.where(new, pending, 0))
        rank[at] = place
        pending = pending[~(new & np.append(new[1:], True))]
        step *= 2
    return order, _common_prefixes(symbols, owner, order, rank)


def _common_prefixes(symbols: np.ndarray, owner: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, by doubling steps over hashes of runs."""
    n = len(symbols)
    marked = owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + symbols.astype(np.uint64) + np.uint64(1)
    levels = [_mix(marked)]
    width = 1
    pairs = np.flatnonzero(owner[order[1:]] == owner[order[:-1]]) + 1
    a, b = order[pairs - 1].copy(), order[pairs].copy()
    live = symbols[a] == symbols[b]
    pairs, a, b = pairs[live], a[live], b[live]
    found = np.zeros(n, np.int64)
    if not len(pairs):
        return found
    # Levels up to the longest run that any pair still shares.
    stop = np.append(np.flatnonzero(np.diff(owner)) + 1, n)
    end = np.repeat(stop, np.diff(stop, prepend=0))
    left, right = a, b
    while len(left):
        if 2 * width > n:
            break
        last = levels[-1]
        levels.append(_mix(last[: len(last) - width] * np.uint64(0xC2B2AE3D27D4EB4F) + last[width:]))
        width *= 2
        fits = np.maximum(left, right) + width <= np.maximum(end[left], end[right])
        fits &= np.maximum(left + width - end[left], right + width - end[right]) <= 0
        left, right = left[fits], right[fits]
        same = levels[-1][left] == levels[-1][right]
        left, right = left[same], right[same]
    length = np.zeros(len(pairs), np.int64)
    for level in reversed(range(len(levels))):
        width = 1 << level
        hashes = levels[level]
        x, y = a + length, b + length
        fits = (x + width <= end[a]) & (y + width <= end[b])
        x, y = np.where(fits, x, 0), np.where(fits, y, 0)
        length += np.where(fits & (hashes[x] == hashes[y]), width, 0)
    found[pairs] = length
    return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def longest_repeats(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run from there that occurs again in its own sequence."""
    order, lcp = suffix_order(symbols, owner)
    out = np.zeros(len(symbols), np.int64)
    out[order] = np.maximum(lcp, np.append(lcp[1:], 0)) if len(lcp) else lcp
    return out


def covered(lengths: np.ndarray, least: int, size: int | None = None) -> np.ndarray:
    """Positions inside a repeat of at least ``least``; with size, inside a window of that size only."""
    starts = np.flatnonzero(lengths >= least)
    edge = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + (lengths[starts] if size is None else size), -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    lines = [x for x in lines if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_repeat: int = 12) -> DataFrame:
    """id and the figures of each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest_repeat (in words)."""

    def work(batches):
        names = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            split = [x.split() for x in texts]
            offsets = np.cumsum([0, *map(len, split)])
            number = {w: i for i, w in enumerate(set(chain.from_iterable(split)))}
            symbols = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, offsets[-1])
            owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
            lengths = longest_repeats(symbols, owner)
            per_text = lambda flags: np.add.reduceat(np.append(flags, 0), offsets[:-1]) * (np.diff(offsets) > 0)
            windows = covered(lengths, WINDOW, WINDOW)
            spans = covered(lengths, least_repeat)
            longest = np.maximum.reduceat(np.append(lengths, 0), offsets[:-1]) * (np.diff(offsets) > 0)
            columns = [
                np.diff(offsets),
                [_code_points(x) for x in texts],
                [len(x) - len(x.translate(None, SYMBOLS)) for x in texts],
                [repeated_lines(x) for x in texts],
                per_text(windows.astype(np.int64)),
                per_text(spans.astype(np.int64)),
                longest,
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, pa.int64()) for c in columns)], names)

    kind = dict(df.dtypes)[id_col]
    schema = f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, longest_repeat long"
    return map_texts(df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), work, schema).withColumnRenamed("id", id_col)


def _code_points(text: bytes) -> int:
    """Characters in words."""
    return len(text.translate(None, SPACES).decode())


def judge(figures: DataFrame, most_covered: float = MOST_COVERED, longest: int = 100, least_words: int = 20) -> DataFrame:
    """figures with base_failed and kept. Rejected are texts that fail the base rules, whose repeats of
    the measured length cover more than most_covered of the words, or whose longest repeat has over
    ``longest`` words."""
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fine = (F.col("n_covered") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return figures.withColumns({"base_failed": failed, "kept": ~failed & fine})
