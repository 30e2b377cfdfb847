"""Shared shapes of reports: shares of a total, factor breakdowns, top-k groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.cleaning import percent


def over_groups(grouped: DataFrame, aggregate: Column) -> Column:
    """A figure over all rows of an already grouped report, as a one-row subquery: the groups stay where they are."""
    return grouped.agg(aggregate.alias("_figure")).scalar()


def share_of_total(grouped: DataFrame, count: str, name: str, digits: int) -> DataFrame:
    """Add each group's percentage of all counted rows.

    The total is taken over the grouped rows; the subquery reuses their exchange.
    """
    return grouped.withColumn(name, percent(F.col(count), over_groups(grouped, F.sum(count)), digits))


def explode_factors(
    df: DataFrame,
    factors: Mapping[str, Column],
    keep: Sequence[str],
    factor: str = "risk_factor",
    value: str = "factor_value",
) -> DataFrame:
    """One row per factor of each input row, so that one aggregation covers all breakdowns in one scan."""
    pairs = [
        F.struct(F.lit(name).alias(factor), column.cast("string").alias(value)) for name, column in factors.items()
    ]
    return df.select(*keep, F.inline(F.array(*pairs)))


def top_groups(df: DataFrame, group: str, measure: str, k: int) -> DataFrame:
    """The k groups with the largest sum; equal sums go to the smaller name."""
    totals = df.groupBy(group).agg(F.sum(measure).alias("_total"))
    return totals.orderBy(F.desc_nulls_last("_total"), F.asc_nulls_last(group)).limit(k).select(group)


def top_or_other(df: DataFrame, group: str, measure: str, k: int, name: str, other: str = "Other") -> DataFrame:
    """Keep the names of the k largest groups and fold the rest into one.

    The joined side has at most k rows by construction, which bounds its broadcast.
    """
    top = top_groups(df, group, measure, k).select(F.col(group).alias("_top"))
    marked = df.join(F.broadcast(top), F.col(group) == F.col("_top"), "left")
    return marked.withColumn(name, F.coalesce("_top", F.lit(other))).drop("_top")


def weighted_average(value: str, weight: str) -> Column:
    """Sum of value x weight over the sum of weights; no weight gives NULL."""
    v, w = F.col(value).cast("double"), F.col(weight).cast("double")
    return F.sum(v * w) / F.nullif(F.sum(w), F.lit(0.0))


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows of the order; end the order in a unique column."""
    return df.orderBy(*order).limit(k)
