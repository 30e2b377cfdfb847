"""Column profiles of whole tables in one scan and one wide shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.cleaning import percent

PROFILE_COLUMNS = (
    "table_name",
    "column_name",
    "data_type",
    "total_rows",
    "null_count",
    "null_percentage",
    "distinct_count",
    "distinct_percentage",
    "min_value",
    "max_value",
    "most_common_value",
)


def _typed_order(types: Iterable[T.DataType]) -> list[Column]:
    """One sort column per type that does not sort as text: the value read back as that type, exactly."""
    ordered = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    named = {kind.simpleString(): kind for kind in types if isinstance(kind, ordered)}
    return [
        F.when(F.col("data_type") == name, F.col("value").try_cast(kind)).alias(f"_as_{k}")
        for k, (name, kind) in enumerate(sorted(named.items(), key=lambda item: item[0]))
    ]


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, data_type, value, n): how often each value of each column occurs, as text.

    Every row is unpivoted to (column, value) and counted per pair. The count is taken before the shuffle, so a value that
    fills most of a column costs one row per task.
    """
    types = {field.name: field.dataType for field in df.schema}
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(types[name].simpleString()).alias("data_type"),
            F.col(name).cast("string").alias("value"),
        )
        for name in (columns or df.columns)
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column_name", "data_type", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def profile_of_counts(counts: DataFrame, types: Iterable[T.DataType], table: str) -> DataFrame:
    """One row per column from the counts of its values: nulls, distinct values, smallest, largest, most common.

    Min and max follow the order of the column's own type; the most common value is the smallest of those that tie.
    """
    present = F.col("value").isNotNull()
    order = F.struct(*_typed_order(types), "value")
    figures = counts.groupBy("column_name", "data_type").agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count_if(present).alias("distinct_count"),
        F.min_by("value", F.when(present, order)).alias("min_value"),
        F.max_by("value", F.when(present, order)).alias("max_value"),
        F.min_by("value", F.when(present, F.struct(-F.col("n"), order))).alias("most_common_value"),
    )
    total = F.col("total_rows")
    return figures.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "data_type",
        total,
        "null_count",
        percent(F.col("null_count"), total, 2).alias("null_percentage"),
        "distinct_count",
        percent(F.col("distinct_count"), total, 2).alias("distinct_percentage"),
        "min_value",
        "max_value",
        "most_common_value",
    )


def profile_columns(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: nulls, distinct values, smallest, largest and most common value, from one pass."""
    names = list(columns or df.columns)
    types = {field.name: field.dataType for field in df.schema}
    return profile_of_counts(value_counts(df, names), [types[name] for name in names], table)


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of several tables; all columns are profiled, without naming them."""
    return reduce(DataFrame.unionByName, [profile_columns(df, name) for name, df in tables.items()])


def profile_columns_approx(df: DataFrame, table: str, error: float = 0.02) -> DataFrame:
    """Nulls and estimated distinct counts in one pass without a wide shuffle, for near-unique columns.

    An explicit choice for a quick look: the distinct counts are estimates and the most common value is left out.
    """
    rows = F.count(F.lit(1))
    figures = [rows.alias("total_rows")]
    cells = []
    for i, field in enumerate(df.schema):
        figures += [
            F.count(field.name).alias(f"p{i}"),
            F.approx_count_distinct(field.name, error).alias(f"d{i}"),
            F.min(field.name).cast("string").alias(f"a{i}"),
            F.max(field.name).cast("string").alias(f"z{i}"),
        ]
        cells.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("total_rows"),
                (F.col("total_rows") - F.col(f"p{i}")).alias("null_count"),
                F.col(f"d{i}").alias("distinct_count"),
                F.col(f"a{i}").alias("min_value"),
                F.col(f"z{i}").alias("max_value"),
            )
        )
    return df.agg(*figures).select(F.lit(table).alias("table_name"), F.inline(F.array(*cells)))
