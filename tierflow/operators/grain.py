"""Bring a table to its grain: collapse repeats, keep the latest row, prove that nothing fans out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.joins import join_figures


def collapse_sum(df: DataFrame, keys: Sequence[str], measure: str, count_name: str = "original_record_count") -> DataFrame:
    """One row per key: the measure summed, the number of merged rows kept.

    Partial sums are taken before the shuffle, so a key with a large share of the rows stays cheap.
    """
    return df.groupBy(*keys).agg(F.sum(measure).alias(measure), F.count(F.lit(1)).alias(count_name))


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest `order` columns.

    `max_by` keeps one candidate per key and task, where a ranking window would pull a whole key into one task.
    """
    newest = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def earliest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest `order` columns."""
    oldest = F.min_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*keys).agg(oldest.alias("_row")).select(*keys, "_row.*")


def with_distinct_per_entity(df: DataFrame, entity: str, column: str, name: str, spread: Sequence[str] = ()) -> DataFrame:
    """Add how many different values of `column` the row's entity shows; without an entity the count is missing.

    `spread` names columns that differ between the rows of an entity; they deal a hot one over several tasks.
    """
    return join_figures(df, [F.count_distinct(column).alias(name)], entity, spread)


def collapse_proof(source: DataFrame, collapsed: DataFrame, entity: str, changed: Column | str) -> DataFrame:
    """One row: entities before, rows after, distinct keys, duplicate keys, rows marked as changed."""
    mark = F.expr(changed) if isinstance(changed, str) else changed
    before = source.agg(F.count_distinct(entity).alias("n")).scalar()
    rows = F.count(F.lit(1))
    return collapsed.agg(
        before.alias("students_in_clean"),
        rows.alias("rows_in_dim"),
        F.count_distinct(entity).alias("distinct_keys"),
        (rows - F.count_distinct(entity)).alias("duplicate_keys"),
        F.count_if(mark).alias("students_marked_as_changed"),
    )


def fanout_probe(df: DataFrame, entity: str, attributes: Sequence[str], changed: Column | str) -> DataFrame:
    """One row: what DISTINCT over the attributes returns, how many entities there are, how many changed."""
    mark = F.expr(changed) if isinstance(changed, str) else changed
    return df.agg(
        F.count_distinct(F.struct(entity, *attributes)).alias("naive_distinct_rows"),
        F.count_distinct(entity).alias("actual_students"),
        F.count_distinct(F.when(mark, F.col(entity))).alias("students_who_changed"),
    )


def version_summary(
    versions: Mapping[str, DataFrame],
    measures: Mapping[str, Column],
    label: str = "version",
) -> DataFrame:
    """The same aggregates over several versions of a table, one row each."""
    rows = None
    for name, df in versions.items():
        one = df.agg(*[value.alias(alias) for alias, value in measures.items()])
        one = one.select(F.lit(name).alias(label), *measures)
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise ValueError("no versions to summarise")
    return rows
