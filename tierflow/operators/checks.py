"""Data-quality checks as data, run in a handful of passes per table instead of one scan per check."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.cleaning import percent
from tierflow.operators.joins import keep_keys, orphan_counts, orphan_rows

# The shape of the results table.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("executed_at", T.TimestampType()),
        T.StructField("layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("check_id", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("dq_dimension", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("expectation", T.StringType()),
        T.StructField("threshold", T.DecimalType(5, 2)),
        T.StructField("severity", T.StringType()),
        T.StructField("total_count", T.LongType()),
        T.StructField("fail_count", T.LongType()),
        T.StructField("fail_pct", T.DecimalType(9, 4)),
        T.StructField("status", T.StringType()),
        T.StructField("business_question", T.StringType()),
        T.StructField("owner", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FailWhen:
    """Rows for which a SQL condition is true fail; an unknown condition does not."""

    condition: str
    on: str = "clean"


@dataclass(frozen=True)
class Repeats:
    """Rows beyond the first of each key fail. Missing values count as values, so they are no duplicates."""

    columns: tuple[str, ...]
    on: str = "clean"


@dataclass(frozen=True)
class Collapses:
    """Distinct rows over the entity and its attributes, beyond one per entity, fail."""

    entity: str
    attributes: tuple[str, ...]


@dataclass(frozen=True)
class Spread:
    """Rows of an entity that shows more than `limit` different values of a column fail."""

    entity: str
    column: str
    limit: int


@dataclass(frozen=True)
class Orphans:
    """Rows whose key the parent table lacks fail."""

    parent: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class SameCount:
    """The row counts of raw and clean may not differ."""


@dataclass(frozen=True)
class SameSum:
    """A measure may not change between raw and clean; both sides are SQL expressions."""

    raw: str
    clean: str


@dataclass(frozen=True)
class CountBetween:
    """The row count must lie in a band."""

    low: int
    high: int


Rule = FailWhen | Repeats | Collapses | Spread | Orphans | SameCount | SameSum | CountBetween


@dataclass(frozen=True)
class Check:
    check_id: str
    check_name: str
    check_type: str
    dq_dimension: str
    column_name: str
    expectation: str
    rule: Rule
    threshold: float = 0.0
    severity: str = "FAIL"
    business_question: str = ""


@dataclass(frozen=True)
class CheckedTable:
    """A table with everything its checks read."""

    name: str
    clean: DataFrame
    checks: Sequence[Check]
    raw: DataFrame | None = None
    parents: Mapping[str, DataFrame] = field(default_factory=dict)
    layer: str = "clean"
    owner: str = "data quality"


def counted_parts(df: DataFrame, table: str, counts: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One pass over `df`: an aggregate row, turned into one (table, check, total, fail) row per check.

    The counts are SQL texts, which keeps a plan of many checks cheap to build.
    """
    figures = [f"{sql} AS {name}{i}" for i, (_, *both) in enumerate(counts) for name, sql in zip("tf", both, strict=True)]
    rows = ", ".join(
        f"named_struct('table_name', '{table}', 'check_id', '{check_id}', "
        f"'total', CAST(t{i} AS BIGINT), 'fail', CAST(f{i} AS BIGINT))"
        for i, (check_id, _, _) in enumerate(counts)
    )
    return df.selectExpr(*figures).selectExpr(f"inline(array({rows}))")


def _listed(columns: Iterable[str]) -> str:
    return ", ".join(f"`{column}`" for column in columns)


def row_counts(rule: Rule) -> dict[str, tuple[str, str]]:
    """SQL of (total, fail) per side for the rules whose numbers add up over parts of a table; no side for the others.

    A raw-to-clean difference is the sum of a positive and a negative part.
    """
    if isinstance(rule, FailWhen):
        return {rule.on: ("count(1)", f"count_if({rule.condition})")}
    if isinstance(rule, SameCount):
        return {"raw": ("count(1)", "count(1)"), "clean": ("0", "-count(1)")}
    if isinstance(rule, SameSum):
        return {"raw": ("count(1)", f"coalesce(sum({rule.raw}), 0)"), "clean": ("0", f"-coalesce(sum({rule.clean}), 0)")}
    return {}


def _tally(table: CheckedTable) -> list[DataFrame]:
    """The parts a table's checks add up from.

    Row conditions on the clean table share one pass, row conditions on the raw table another, and the distinct
    counts of each side a third, so that Spark's row expansion for distinct counts stays off the wide pass.
    The two parts of a raw-to-clean difference are each taken in a pass that runs anyway.
    """
    simple: dict[str, list[tuple[str, str, str]]] = {"clean": [], "raw": []}
    distinct: dict[str, list[tuple[str, str, str]]] = {"clean": [], "raw": []}
    parts: list[DataFrame] = []
    for check in table.checks:
        rule, cid = check.rule, check.check_id
        for side, counts in row_counts(rule).items():
            simple[side].append((cid, *counts))
        if isinstance(rule, Repeats):
            keys = f"count(DISTINCT struct({_listed(rule.columns)}))"
            distinct[rule.on].append((cid, "count(1)", f"count(1) - {keys}"))
        elif isinstance(rule, Collapses):
            entities = f"count(DISTINCT `{rule.entity}`)"
            versions = f"count(DISTINCT struct({_listed((rule.entity, *rule.attributes))}))"
            distinct["clean"].append((cid, entities, f"{versions} - {entities}"))
        elif isinstance(rule, Spread):
            per_entity = table.clean.groupBy(rule.entity).agg(
                F.count(F.lit(1)).alias("n"), F.count_distinct(rule.column).alias("seen")
            )
            over = f"coalesce(sum(CASE WHEN seen > {rule.limit} THEN n END), 0)"
            parts.append(counted_parts(per_entity, table.name, [(cid, "coalesce(sum(n), 0)", over)]))
        elif isinstance(rule, Orphans):
            found = orphan_counts(table.clean, table.parents[rule.parent], rule.columns)
            parts.append(found.selectExpr(f"'{table.name}' AS table_name", f"'{cid}' AS check_id", "total", "fail"))
        elif isinstance(rule, CountBetween):
            outside = f"CASE WHEN count(1) BETWEEN {rule.low} AND {rule.high} THEN 0 ELSE 1 END"
            simple["clean"].append((cid, "count(1)", outside))
    for side, df in (("clean", table.clean), ("raw", table.raw)):
        for counts in (simple[side], distinct[side]):
            if counts and df is None:
                raise ValueError(f"{table.name}: the checks read the {side} table, which is missing")
            if counts:
                parts.append(counted_parts(df, table.name, counts))
    return parts


DESCRIPTION = ("layer", "table_name", "check_id", "check_name", "check_type", "dq_dimension", "column_name",
               "expectation", "threshold", "severity", "business_question", "owner")


def _catalogue(spark: SparkSession, tables: Iterable[CheckedTable]) -> DataFrame:
    """The descriptions of the checks as rows; as many as the code lists, whatever the data."""
    rows = [
        {**vars(check), "threshold": Decimal(str(check.threshold)), "layer": t.layer, "table_name": t.name, "owner": t.owner}
        for t in tables
        for check in t.checks
    ]
    fields = [(name, pa.decimal128(5, 2) if name == "threshold" else pa.string()) for name in DESCRIPTION]
    kept = [{name: row[name] for name in DESCRIPTION} for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(kept, schema=pa.schema(fields)))


def status_of(total: Column, fail: Column, threshold: Column, severity: Column) -> Column:
    """PASS without failures, the check's severity above its threshold, WARN in between.

    The unrounded share decides. An empty table with a failure has no share and gives WARN.
    """
    share = fail.cast("double") * 100.0 / F.nullif(total.cast("double"), F.lit(0.0))
    return F.when(fail == 0, "PASS").when(share > threshold.cast("double"), severity).otherwise("WARN")


def run_checks(tables: Sequence[CheckedTable]) -> DataFrame:
    """All checks of all tables, one result row each."""
    parts = [part for table in tables for part in _tally(table)]
    return results_of(tables[0].clean.sparkSession, reduce(DataFrame.unionByName, parts), tables)


def results_of(spark: SparkSession, parts: DataFrame, tables: Sequence[CheckedTable]) -> DataFrame:
    """The results table from (table, check, total, fail) parts, which are added up."""
    tallied = parts.groupBy("table_name", "check_id").agg(
        F.sum("total").alias("total_count"), F.abs(F.sum("fail")).alias("fail_count")
    )
    total, fail = F.col("total_count"), F.col("fail_count")
    share = percent(fail, total, 4)
    described = tallied.join(F.broadcast(_catalogue(spark, tables)), ["table_name", "check_id"])
    return described.select(
        F.current_timestamp().alias("executed_at"),
        "layer",
        "table_name",
        "check_id",
        "check_name",
        "check_type",
        "dq_dimension",
        "column_name",
        "expectation",
        "threshold",
        "severity",
        total,
        fail,
        share.cast("decimal(9,4)").alias("fail_pct"),
        status_of(total, fail, F.col("threshold"), F.col("severity")).alias("status"),
        "business_question",
        "owner",
    )


def failing_rows(table: CheckedTable, check_id: str) -> DataFrame:
    """The rows behind a check's number: the same rule as a filter."""
    check = next(check for check in table.checks if check.check_id == check_id)
    rule = check.rule
    if isinstance(rule, FailWhen):
        return (table.clean if rule.on == "clean" else table.raw).filter(F.expr(rule.condition))
    if isinstance(rule, Orphans):
        return orphan_rows(table.clean, table.parents[rule.parent], rule.columns)
    if isinstance(rule, Repeats):
        side = table.clean if rule.on == "clean" else table.raw
        repeated = side.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
        return keep_keys(side, repeated, rule.columns)
    if isinstance(rule, Spread):
        seen = table.clean.groupBy(rule.entity).agg(F.count_distinct(rule.column).alias("_seen"))
        wide = seen.filter(F.col("_seen") > rule.limit)
        return keep_keys(table.clean, wide, (rule.entity,))
    raise ValueError(f"{check_id} compares whole tables and has no rows of its own")


# The shape of the results table of the mart checks.
MART_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("test_timestamp", T.TimestampType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("test_type", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("grain_columns", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("failed_rows", T.LongType()),
        T.StructField("test_result", T.StringType()),
    ]
)


def _mart_row(counted: DataFrame, table: str, kind: str, column: str | None, grain: str | None) -> DataFrame:
    return counted.select(
        F.current_timestamp().alias("test_timestamp"),
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("test_type"),
        F.lit(column).cast("string").alias("column_name"),
        F.lit(grain).cast("string").alias("grain_columns"),
        "total_rows",
        "failed_rows",
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL").alias("test_result"),
    )


def not_null_test(df: DataFrame, table: str, column: str) -> DataFrame:
    """One result row: rows in which the column is missing."""
    rows = F.count(F.lit(1))
    counted = df.agg(rows.alias("total_rows"), (rows - F.count(column)).alias("failed_rows"))
    return _mart_row(counted, table, "NOT_NULL", column, None)


def unique_test(df: DataFrame, table: str, grain: Sequence[str], tasks: int | None = None) -> DataFrame:
    """One result row: keys (not rows) that occur more than once.

    Nearly all keys are different, so a task holds about as many as it has rows. With `tasks`, rows are dealt to so many
    parts by their key first; a number that follows the rows keeps a task's memory the same at any size.
    """
    dealt = df.select(*grain).repartition(tasks, *grain) if tasks else df
    per_key = dealt.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count_if(F.col("n") > 1).alias("failed_rows")
    )
    return _mart_row(counted, table, "UNIQUENESS", None, ",".join(grain))
