"""Scalar helpers whose semantics aren't one built-in function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_match(column: Column, pattern: str) -> Column:
    """The whole text matches; a find is not enough."""
    return column.rlike(f"^(?:{pattern})$")


def strip(column: Column, characters: str) -> Column:
    """Without the given characters at both ends."""
    return F.trim(column, F.lit(characters))


def day_of(text: Column, pattern: str = "yyyyMMdd") -> Column:
    """A date out of text; null for text that isn't one."""
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def whole_div(a: Column, b: int) -> Column:
    """Integer division, rounding towards zero."""
    q = F.abs(a) - F.pmod(F.abs(a), F.lit(b))
    return F.when(a < 0, -q / b).otherwise(q / b).cast("long")


def entry(column: Column, place: int) -> Column:
    """Entry of an array counted from 1, from the end if negative; null where there is none."""
    return F.try_element_at(column, F.lit(place))


def bucket_of_hash(columns: list[Column], buckets: int) -> Column:
    """A stable bucket from 0; the same rows fall in the same one on every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets))
