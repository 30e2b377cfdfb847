"""Joins that cannot change the row count of the left side by accident."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key's rows are dealt over this many salts before they meet the figures of their key.
SALTS = 16
NESTED = (T.MapType, T.ArrayType, T.StructType)


def _salt(df: DataFrame) -> Column:
    """A number below SALTS from the row's own values, the same in every attempt of a task."""
    plain = [field.name for field in df.schema if not isinstance(field.dataType, NESTED)]
    return F.pmod(F.xxhash64(*plain), F.lit(SALTS)).cast("int")


def _for_every_salt(per_key: DataFrame) -> DataFrame:
    return per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def join_per_key(df: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left join of a table with figures aggregated from itself, one row per key.

    Rows are dealt by key and salt, and the figures, a narrow row per key, are repeated for every salt. So the rows of a
    hot key meet in several tasks, whatever its size, rows without a key spread as well, and both sides of the join are
    exchanges of their own, which adaptive execution may split further.
    """
    figures = _for_every_salt(per_key)
    added = [name for name in per_key.columns if name != key]
    return df.withColumn("_salt", _salt(df)).join(figures, [key, "_salt"], "left").select(*df.columns, *added)


def not_by_estimate(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the tables: it is shuffled, never broadcast.

    Spark's estimate before a run is the size of compressed files, scaled by the columns read. Millions of keys pass for a
    small table that way, and the driver has to hold them, several such tables at once in a plan of many branches.
    """
    return side.hint("shuffle_merge")


def join_figures(df: DataFrame, figures: Sequence[Column], key: str, spread: Sequence[str] = ()) -> DataFrame:
    """Left join of a table with figures of its own rows per key; rows without a key get none.

    Rows are dealt by key and salt, and a figure is repeated only for the salts its key's rows have: a hot key meets in
    several tasks, and the repeated figures are never more than the rows. The figures are grouped once more after they were
    repeated, so the optimizer sees one row per key and salt, and drops the whole join from the plan of a reader that uses
    no figure. The rows of a key are dealt by the columns in `spread` (unless named, all but nested and floating ones, which
    a second reading might give otherwise), so a reader of the figures needs no further column. Rows that agree in those
    columns share a salt.
    """
    fixed = [f.name for f in df.schema if not isinstance(f.dataType, (*NESTED, T.FloatType, T.DoubleType))]
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*(spread or fixed)), F.lit(SALTS)).cast("int"))
    used = F.bit_or(F.expr("shiftleft(1, _salt)")).alias("_used")
    per_key = dealt.filter(F.col(key).isNotNull()).groupBy(key).agg(*figures, used)
    added = [name for name in per_key.columns if name not in (key, "_used")]
    salts = F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), s -> getbit(_used, s) = 1)")).alias("_salt")
    per_salt = per_key.select(key, *added, salts).groupBy(key, "_salt").agg(*[F.max(name).alias(name) for name in added])
    return dealt.join(not_by_estimate(per_salt), [key, "_salt"], "left").select(*df.columns, *added)


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows whose key, missing values included, is among `keys`; the rows of a key spread over several tasks."""
    left, right = df.withColumn("_salt", _salt(df)).alias("l"), _for_every_salt(keys.select(*on)).alias("r")
    same = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in on]
    return left.join(right, reduce(Column.__and__, same, F.col("l._salt") == F.col("r._salt")), "left_semi").drop("_salt")


def gate(df: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep the rows whose key exists in `allowed`; repeats there cannot multiply a row.

    Adaptive execution splits a hot key of `df` when `allowed` is read from a table, as in a build by layers.
    """
    return df.join(allowed.select(*on), list(on), "left_semi")


def one_per_key(lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """A lookup brought to its key: of repeated keys the row with the greatest other columns stays.

    The columns are compared in their order, missing values as the smallest. The rule makes the choice repeatable; that
    keys repeat at all is for the checks to report.
    """
    rest = [name for name in lookup.columns if name not in on]
    if not rest:
        return lookup.select(*on).distinct()
    return lookup.groupBy(*on).agg(F.max(F.struct(*rest)).alias("_row")).select(*on, "_row.*")


def enrich(df: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add the lookup's columns; rows without a match keep NULLs.

    The lookup has one row per key: an aggregate over the key, or `one_per_key`. No broadcast hint: Spark broadcasts the
    lookup when its measured size allows it and shuffles otherwise.
    """
    return df.join(lookup, list(on), "left")


def orphan_counts(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row (total, fail): rows of the child, and those whose key the parent lacks.

    The child is counted per key before the join, so a key that holds a third of the rows joins as one row.
    A missing key never matches and counts as an orphan.
    """
    per_key = child.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(*on).distinct().withColumn("_known", F.lit(True))
    # Both sides are dealt by the key already.
    marked = per_key.join(not_by_estimate(known), list(on), "left")
    return marked.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_rows"))), F.lit(0)).alias("fail"),
    )


def orphan_rows(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """The child rows whose key the parent lacks. Rows without a key are among them and skip the join."""
    keyless = reduce(Column.__or__, [F.col(name).isNull() for name in on])
    lost = child.filter(~keyless).join(parent.select(*on), list(on), "left_anti")
    return child.filter(keyless).unionByName(lost)
