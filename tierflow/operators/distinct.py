"""Exact distinct counts of whole numbers as bitmaps.

A number stands for one bit of a 64-bit word: its word is the number divided by 64, its place the rest. Words of one number
merge by OR, before the shuffle and after it, and a word's distinct numbers are its bits. So what is shuffled is a word for
up to 64 values, where a plain distinct count moves every value, and several counts side by side do not repeat the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word(value: Column) -> Column:
    """Which word a whole number falls into; negative numbers have negative words."""
    return F.shiftright(value.cast("long"), 6)


def bit(value: Column) -> Column:
    """The number's place in its word as a word with one bit."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), value.cast("long").bitwiseAND(F.lit(63).cast("long")).cast("int"))


def distinct_counts(df: DataFrame, keys: Sequence[str], column: str, name: str, sums: Sequence[str] = ()) -> DataFrame:
    """One row per key: how many different numbers `column` holds, exactly, and the sums of other columns.

    Words are merged per key and word first, so a key with very many numbers is counted by many tasks; the second step adds
    a count per word. Missing numbers are not counted.
    """
    words = df.groupBy(*keys, word(F.col(column)).alias("_word")).agg(
        F.bit_or(bit(F.col(column))).alias("_bits"), *[F.sum(extra).alias(extra) for extra in sums]
    )
    counted = F.coalesce(F.sum(F.bit_count("_bits").cast("long")), F.lit(0)).alias(name)
    return words.groupBy(*keys).agg(counted, *[F.sum(extra).alias(extra) for extra in sums])


def distinct_between(value: Column, first: int, last: int) -> Column:
    """Aggregate: how many different whole numbers from `first` to `last` occur; others and missing ones do not count.

    A word per 64 numbers of the band is held per group, so the band should be narrow (days of a course).
    """
    inside = F.when(value.between(first, last), value.cast("long") - F.lit(first).cast("long"))
    words = [F.bit_or(F.when(word(inside) == k, bit(inside))) for k in range((last - first) // 64 + 1)]
    total = F.lit(0).cast("long")
    for bits in words:
        total = total + F.coalesce(F.bit_count(bits).cast("long"), F.lit(0).cast("long"))
    return total
