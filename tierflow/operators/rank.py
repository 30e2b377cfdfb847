"""Exact positions and tiles inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import stable


def with_positions(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    position: str = "position",
    size: str = "group_rows",
) -> DataFrame:
    """Row number inside each group and the group's row count, ascending by `order`, missing values last.

    `order` must end in a unique column; rows that agree in all of it share their places in any order. A window would sort a whole group in one task. Here the rows are
    range-partitioned over (groups, order), so a large group spreads over many tasks; each row takes its slot
    within its partition, and the partitions in front of it add an offset. Only the per-partition counts
    pass through a window: one row per partition and group. Adaptive execution joins them by broadcast when their
    measured size allows it.

    One job runs at once: the numbered rows are written to the shared folder, all columns of `df` with them. Pass the
    keys and the order only, and join wider rows to the result.
    """
    keys = [*groups, *[F.col(name).asc_nulls_last() for name in order]]
    slotted = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    fixed = stable(slotted).withColumn("_part", F.shiftright("_slot", 33))
    parts = fixed.groupBy(*groups, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first")
    )
    ahead = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(name).alias(f"_at_{name}") for name in groups],
        F.col("_part").alias("_at_part"),
        "_first",
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead"),
        F.sum("_rows").over(Window.partitionBy(*groups)).alias(size),
    )
    same = F.col("_part") == F.col("_at_part")
    for name in groups:
        same = same & F.col(name).eqNullSafe(F.col(f"_at_{name}"))
    placed = fixed.join(offsets, same)
    return placed.select(
        *df.columns,
        (F.col("_slot") - F.col("_first") + F.col("_ahead") + 1).alias(position),
        size,
    )


def with_tiles(df: DataFrame, groups: Sequence[str], order: Sequence[str], tiles: int, name: str) -> DataFrame:
    """Equal-count tiles 1..n per group; the first tiles take the surplus rows, as NTILE does; missing values come last.

    Positions are taken first, so the rows are written once while the plan is built. `with_tiles_by_edges` writes nothing.
    """
    placed = with_positions(df, groups, order, "_position", "_total")
    small = F.floor(F.col("_total") / tiles)
    surplus = F.col("_total") % tiles
    in_large = surplus * (small + 1)
    tile = F.when(
        F.col("_position") <= in_large,
        F.ceil(F.col("_position") / (small + 1)),
    ).otherwise(surplus + F.ceil((F.col("_position") - in_large) / F.nullif(small, F.lit(0))))
    return placed.select(*df.columns, tile.cast("int").alias(name))


# Numbers fall into ranges of equal width on a logarithmic scale, so many per factor of e.
RANGES = 64


def _range(value: Column, kind: T.DataType) -> Column:
    """A whole number that never falls as the value rises, with some ten thousand different results at most."""
    if isinstance(kind, T.StringType):
        return F.ascii(value).cast("long")
    if isinstance(kind, T.BooleanType):
        return value.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_date(value.cast("date")).cast("long")
    if not isinstance(kind, T.NumericType):
        return F.lit(0).cast("long")
    number = value.cast("double")
    scaled = F.signum(number) * F.floor(F.log1p(F.abs(number)) * RANGES)
    return F.when(F.isnan(number), F.lit(1 << 40)).otherwise(scaled).cast("long")


def _equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Missing values are equal to each other."""
    return reduce(Column.__and__, [a.eqNullSafe(b) for a, b in pairs], F.lit(True))


def _holding(counts: DataFrame, edges: DataFrame, by: Sequence[str], order: Sequence[Column], kept: Sequence[str]) -> DataFrame:
    """For each edge the row of `counts` that holds its place, within the rows that agree in `by`, ascending by `order`.

    `counts` has n rows each; an edge is at the place `_need`, from 1, and comes back with the place inside that row.
    """
    ahead = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    carried = [name for name in edges.columns if name not in ("_need", *kept)]
    found = placed.alias("c").join(
        edges.alias("e"),
        _equal([(F.col(f"c.{name}"), F.col(f"e.{name}")) for name in by])
        & (F.col("_ahead") < F.col("_need"))
        & (F.col("_need") <= F.col("_ahead") + F.col("_n")),
    )
    return found.select(
        *[F.col(f"e.{name}") for name in carried],
        *[F.col(f"c.{name}") for name in kept],
        (F.col("_need") - F.col("_ahead")).alias("_need"),
        "_n",
    )


def _tile_edges(df: DataFrame, groups: Sequence[str], order: Sequence[str], tiles: int) -> DataFrame:
    """Per group and edge the key of the last row of a tile: one row per group and tile but the last.

    Columns: the groups as _g0.., the key as _k0.., `_need`, the edge's place among the rows of that key, and `_n`, how
    many rows have the key. The place of each edge is found in the counts of ranges of the first column, then among the
    values of that range alone, then among the rows that tie with that value, by the other columns.
    """
    at = [f"_g{i}" for i in range(len(groups))]
    keys = [f"_k{i}" for i in range(len(order))]
    kinds = {field.name: field.dataType for field in df.schema}
    rows = df.select(*[F.col(g).alias(a) for g, a in zip(groups, at, strict=True)], *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)])
    n = F.count(F.lit(1)).alias("_n")

    def ranged(counts: DataFrame, column: int) -> DataFrame:
        key = F.col(keys[column])
        return counts.withColumn("_missing", key.isNull()).withColumn("_range", F.coalesce(_range(key, kinds[order[column]]), F.lit(0)))

    def narrowed(counts: DataFrame, edges: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
        """The edges with their values of `columns`: by ranges of the first, then inside the range."""
        wide = ranged(counts, keys.index(columns[0]))
        sums = wide.groupBy(*by, "_missing", "_range").agg(F.sum("_n").alias("_n"))
        inside = _holding(sums, edges, by, [F.col("_missing"), F.col("_range")], ["_missing", "_range"]).drop("_n")
        values = [F.col(name).asc_nulls_last() for name in columns]
        return _holding(wide, inside, [*by, "_missing", "_range"], values, columns).drop("_missing", "_range")

    # One exchange of narrow rows, a row per key; everything below reads its counts.
    counted = rows.groupBy(*at, *keys).agg(n)
    first = counted.groupBy(*at, keys[0]).agg(F.sum("_n").alias("_n"))
    small, surplus = F.floor(F.col("_total") / tiles), F.col("_total") % tiles
    edge = F.explode(F.sequence(F.lit(1), F.lit(tiles - 1))).alias("_edge")
    edges = first.groupBy(*at).agg(F.sum("_n").alias("_total")).select("*", edge)
    need = (F.col("_edge") * small + F.least(F.col("_edge"), surplus)).cast("long")
    edges = narrowed(first, edges.select(*at, "_edge", need.alias("_need")), at, [keys[0]])
    if len(order) == 1:
        return edges
    tied = counted.alias("r").join(
        edges.select(*at, keys[0]).distinct().alias("e"),
        _equal([(F.col(f"r.{name}"), F.col(f"e.{name}")) for name in [*at, keys[0]]]),
        "left_semi",
    )
    return narrowed(tied, edges.drop("_n"), [*at, keys[0]], keys[1:])


def with_tiles_by_edges(df: DataFrame, groups: Sequence[str], order: Sequence[str], tiles: int, name: str) -> DataFrame:
    """The tiles of `with_tiles` for tables that should be neither sorted nor written whole.

    No rows are sorted or written, and nothing runs before the result does. The keys of the tiles' last rows are exact
    order statistics: histograms of the order key, refined only where an edge falls. A group's rows are only counted; what
    meets in one task is a row per range of values, or per value of one range. Every row then compares its key with its
    group's edges, at most tiles - 1 of them, which join by group.

    `order` should end in a unique column. Rows that agree in all of it are dealt to the tiles on both sides of an edge as
    NTILE deals them, in any order; only such rows, and only those at an edge, are numbered in one task per key. The plan
    reads `df` for its keys and for its rows; what both need below an exchange Spark computes once. It has a dozen small
    exchanges, so on small tables `with_tiles` is faster.
    """
    if tiles < 2:
        return df.withColumn(name, F.lit(1))
    found = _tile_edges(df, groups, order, tiles)
    at = [f"_g{i}" for i in range(len(groups))]

    def key(columns: Sequence[str]) -> Column:
        # The flag in front puts missing values last.
        return F.struct(*[part for k, c in enumerate(columns) for part in (F.col(c).isNull().alias(f"m{k}"), F.col(c).alias(f"v{k}"))])

    keys = [f"_k{i}" for i in range(len(order))]
    edge = F.struct(key(keys).alias("key"), F.col("_need").alias("rows"), (F.col("_need") < F.col("_n")).alias("split"))
    per_group = found.groupBy(*at).agg(F.collect_list(edge).alias("_edges"))
    if groups:
        same = _equal([(F.col(g), F.col(a)) for g, a in zip(groups, at, strict=True)])
    else:
        same = F.lit(True)
    marked = df.join(per_group, same, "left").withColumn("_key", key(order))
    below = F.size(F.filter("_edges", lambda e: e["key"] < F.col("_key")))
    split = F.exists("_edges", lambda e: e["split"] & (e["key"] == F.col("_key")))
    alone = marked.where(~split).withColumn(name, (below + 1).cast("int"))
    # Rows of one key on both sides of an edge: so many of them stay below it.
    twins = marked.where(split).withColumn("_seat", F.row_number().over(Window.partitionBy(*groups, *order).orderBy(F.lit(0))))
    past = F.size(F.filter("_edges", lambda e: (e["key"] == F.col("_key")) & (e["rows"] < F.col("_seat"))))
    dealt = twins.withColumn(name, (below + past + 1).cast("int"))
    return alone.select(*df.columns, name).unionAll(dealt.select(*df.columns, name))
