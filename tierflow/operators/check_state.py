"""Checks that follow a growing table: each part of it is scanned once, and the state of all parts gives the results.

The state of a part holds two kinds of rows. Row conditions, raw-to-clean differences and row counts leave (total, fail)
numbers, which add up. Rules about keys (repeats, versions of an entity, spread, orphans) leave an index of the part's keys
with their rows: keys of two parts meet there, so a repeat across parts is found, and orphans are looked up in the parents
as they are when the results are asked for. The state is one published table scoped by part, so that a part is there with
all of its rows or not at all; adding it again replaces it.

Keys are kept as JSON text, which tells every value and a missing one apart. The index is as large as the parts' distinct
keys; counts per key are taken before the shuffle, so a hot key is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.checks import (
    CheckedTable,
    Collapses,
    CountBetween,
    Orphans,
    Repeats,
    Spread,
    counted_parts,
    results_of,
    row_counts,
)
from tierflow.operators.joins import not_by_estimate
from tierflow.sources.snapshots import delete_scopes, publish_scopes, read_snapshot

PART = "part"
# The kinds of state rows.
TALLY, REPEATS, COLLAPSES, SPREAD, ORPHANS = "tally", "repeats", "collapses", "spread", "orphans"


def _json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _complete(columns: Sequence[str]) -> Column:
    """The key as text; missing when any part of it is."""
    return F.when(reduce(Column.__and__, [F.col(name).isNotNull() for name in columns]), _json(columns))


def _keys(table: CheckedTable) -> list[DataFrame]:
    """(check, kind, entity, value, bound, n) of every rule about keys."""
    found = []
    for check in table.checks:
        rule, side, value, bound = check.rule, table.clean, F.lit(None).cast("string"), 0
        if isinstance(rule, Repeats):
            kind, entity, side = REPEATS, _json(rule.columns), table.clean if rule.on == "clean" else table.raw
        elif isinstance(rule, Collapses):
            kind, entity, value = COLLAPSES, _complete([rule.entity]), _json(rule.attributes)
        elif isinstance(rule, Spread):
            kind, entity, value, bound = SPREAD, _complete([rule.entity]), _complete([rule.column]), rule.limit
        elif isinstance(rule, Orphans):
            kind, entity = ORPHANS, _complete(rule.columns)
        else:
            continue
        marks = F.lit(check.check_id).alias("check_id"), F.lit(kind).alias("kind"), F.lit(bound).alias("bound")
        rows = side.select(entity.alias("entity"), value.alias("value")).groupBy("entity", "value").agg(F.count(F.lit(1)).alias("n"))
        found.append(rows.select(*marks, "entity", "value", "n"))
    return found


def _tallies(table: CheckedTable) -> list[DataFrame]:
    """(table, check, total, fail) of the rules whose numbers add up; rules about keys are named with zeros."""
    counts: dict[str, list[tuple[str, str, str]]] = {"clean": [], "raw": []}
    for check in table.checks:
        added = row_counts(check.rule)
        if isinstance(check.rule, CountBetween):
            added = {"clean": ("count(1)", "0 * count(1)")}
        for side, both in (added or {"clean": ("0 * count(1)", "0 * count(1)")}).items():
            counts[side].append((check.check_id, *both))
    sides = {"clean": table.clean, "raw": table.raw}
    return [counted_parts(sides[side], table.name, listed) for side, listed in counts.items() if listed]


def add_part(table: CheckedTable, part: str, state: str) -> None:
    """Scan one part of a table (its clean and raw rows) and publish its state; the part's earlier state is replaced."""
    scope = f"{table.name}/{part}"
    empty = {"kind": TALLY, "bound": 0, "entity": None, "value": None, "n": 0}
    types = {"kind": "string", "bound": "int", "entity": "string", "value": "string", "n": "long"}
    tallies = reduce(DataFrame.unionByName, _tallies(table)).withColumns({k: F.lit(v).cast(types[k]) for k, v in empty.items()})
    keys = [
        rows.withColumns({"table_name": F.lit(table.name), "total": F.lit(0).cast("long"), "fail": F.lit(0).cast("long")})
        for rows in _keys(table)
    ]
    rows = reduce(DataFrame.unionByName, keys, tallies).withColumn(PART, F.lit(scope))
    publish_scopes(rows, state, PART, [scope])


def remove_part(spark: SparkSession, table: str, part: str, state: str) -> None:
    """Take a part out of the results."""
    delete_scopes(spark, state, [f"{table}/{part}"])


def _parent_keys(tables: Sequence[CheckedTable]) -> DataFrame | None:
    """The complete keys that the parents of all orphan rules hold."""
    found = [
        table.parents[check.rule.parent]
        .select(F.lit(table.name).alias("table_name"), F.lit(check.check_id).alias("check_id"), _complete(check.rule.columns).alias("entity"))
        .where("entity IS NOT NULL")
        .distinct()
        for table in tables
        for check in table.checks
        if isinstance(check.rule, Orphans)
    ]
    return reduce(DataFrame.unionByName, found) if found else None


def stored_results(spark: SparkSession, state: str, tables: Sequence[CheckedTable]) -> DataFrame:
    """The results table over all parts, without reading a row of the checked tables; their checks and parents are used."""
    rows = read_snapshot(spark, state).where(F.col("table_name").isin([table.name for table in tables]))
    tallies = rows.where(F.col("kind") == TALLY).select("table_name", "check_id", "total", "fail")
    check = ["table_name", "check_id"]
    pairs = rows.where(F.col("kind") != TALLY).groupBy(*check, "kind", "bound", "entity", "value").agg(F.sum("n").alias("n"))
    # Missing values of a spread column are no value; a pair of an entity is one of its versions.
    entities = pairs.groupBy(*check, "kind", "bound", "entity").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("versions"), F.count("value").alias("seen")
    )
    parents = _parent_keys(tables)
    if parents is None:
        known = entities.withColumn("_known", F.lit(None).cast("boolean"))
    else:
        known = entities.join(not_by_estimate(parents.withColumn("_known", F.lit(True))), [*check, "entity"], "left")
    kind, n = F.col("kind"), F.col("n")
    lost = (kind == ORPHANS) & F.col("_known").isNull()
    wide = (kind == SPREAD) & (F.col("seen") > F.col("bound"))
    named = F.col("entity").isNotNull().cast("long")
    total = F.when(kind == COLLAPSES, named).otherwise(n)
    fail = F.when(kind == REPEATS, n - 1).when(kind == COLLAPSES, F.col("versions") - named).when(lost | wide, n).otherwise(0)
    counted = known.groupBy(*check).agg(F.sum(total).alias("total"), F.sum(fail).alias("fail"))
    parts = tallies.unionByName(counted)
    bands = [(table.name, check) for table in tables for check in table.checks if isinstance(check.rule, CountBetween)]
    if bands:
        summed = parts.groupBy("table_name", "check_id").agg(F.sum("total").alias("total"), F.sum("fail").alias("fail"))
        outside = F.lit(None).cast("long")
        for name, band in bands:
            here = (F.col("table_name") == name) & (F.col("check_id") == band.check_id)
            outside = F.when(here, (~F.col("total").between(band.rule.low, band.rule.high)).cast("long")).otherwise(outside)
        parts = summed.withColumn("fail", F.coalesce(outside, "fail"))
    return results_of(spark, parts, tables)
