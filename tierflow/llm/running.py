"""Running sums and maxima over an array of a row, and cuts of a long text, as expressions whose time grows with the row.

An array that grows inside `aggregate` is copied in every step, and a substring is searched from the text's start, so both
take square time on a row with very many places. Here arrays are cut into blocks: totals of the blocks first (by blocks of
blocks), then the elements of each block; and texts are cut into chunks, of which a cut reads those it touches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierflow.llm.common import bind

BLOCK = 64
# Levels of blocks above the elements: with three, 64^4 elements before a step grows.
LEVELS = 3
CHUNK = 2048


def _blocks(values: Column) -> Column:
    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))


def _before(values: Column, start: Column, join: Callable[[Column, Column], Column], levels: int) -> Column:
    """For each element `start` joined with all elements before it; `values` is not empty, and 0 joined with x is x."""

    def within(block: Column, first: Column) -> Column:
        return F.transform(block, lambda _, i: F.aggregate(F.slice(block, F.lit(1), i), first, join))

    if levels == 0:
        return within(values, start)

    def by_blocks(blocks: Column) -> Column:
        wholes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0).cast("bigint"), join))
        firsts = bind(wholes, lambda totals: _before(totals, start, join, levels - 1))
        return bind(firsts, lambda starts: F.flatten(F.transform(blocks, lambda block, b: within(block, F.get(starts, b)))))

    return bind(_blocks(values), by_blocks)


def add(a: Column, b: Column) -> Column:
    return a + b


def greatest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _empty() -> Column:
    return F.expr("cast(array() as array<bigint>)")


def sums_before(values: Column) -> Column:
    """For each element of an array of longs the sum of those before it, from 0."""
    return bind(values, lambda v: F.when(F.size(v) > 0, _before(v, F.lit(0).cast("bigint"), add, LEVELS)).otherwise(_empty()))


def greatest_before(values: Column) -> Column:
    """For each element of an array of longs the greatest of those before it, 0 for the first; no element is negative."""
    return bind(values, lambda v: F.when(F.size(v) > 0, _before(v, F.lit(0).cast("bigint"), greatest, LEVELS)).otherwise(_empty()))


def chunks(text: Column) -> Column:
    """The text in pieces of CHUNK characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from `start` to before `end` of a text in chunks."""
    first = F.floor(start / CHUNK).cast("int")
    held = F.array_join(F.slice(pieces, first + 1, F.floor(end / CHUNK).cast("int") - first + 1), "")
    return F.when(end > start, held.substr((start - first * CHUNK + 1).cast("int"), (end - start).cast("int"))).otherwise("")
