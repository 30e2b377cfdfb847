"""Life of a layer table: create, replace, append, replace one slice, describe, drop, read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layers, in build order.
LAYERS = ("raw", "clean", "mart", "bi_visualization", "validation", "dq_visualization")


# Rows of a bucket, which one task sorts, joins and groups.
BUCKET_ROWS = 250_000


def create_layers(spark: SparkSession, layers: Sequence[str] = LAYERS, location: str | None = None) -> None:
    """One database per layer; `location` puts them below a shared folder."""
    for layer in layers:
        place = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{place}")


def list_layers(spark: SparkSession) -> list[str]:
    return sorted(database.name for database in spark.catalog.listDatabases())


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Create the catalog table from the query, or replace what is there.

    The old files go before the new ones are complete; `snapshots.publish` replaces a folder's table at one stroke.
    """
    df.write.mode("overwrite").format("parquet").partitionBy(*partition_by).saveAsTable(name)


def create_if_absent(df: DataFrame, name: str) -> None:
    """Create the table from the query; one that exists keeps its rows."""
    df.write.mode("ignore").format("parquet").saveAsTable(name)


def append_rows(df: DataFrame, name: str) -> None:
    """Add rows to a table, matched to its columns by name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("append").insertInto(name)


def create_empty(spark: SparkSession, name: str, schema: T.StructType, comment: str = "") -> None:
    """A fresh table with a fixed shape and no rows."""
    drop_table(spark, name)
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    if comment:
        comment_table(spark, name, comment)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{text}'")


def write_slice(df: DataFrame, path: str, scope: str = "table_name") -> None:
    """Replace only the scopes present in `df`; the rows of every other scope stay as they are.

    A scope without new rows keeps its old ones; `snapshots.publish_scopes` also empties scopes.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(scope)
        .parquet(path)
    )


def in_key_order(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in key order for writing: ranges over the tasks and a sort inside each, with no single-task sort."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_ordered(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None) -> None:
    """Files in key order."""
    in_key_order(df, keys, partitions).write.mode("overwrite").parquet(path)


def bucket_number(rows: int, at_least: int = 8) -> int:
    """How many buckets a table of so many rows gets: a bucket is one task's, so their number follows the rows."""
    return max(at_least, -(-rows // BUCKET_ROWS))


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Create or replace a catalog table whose files are dealt by `keys`, one file per bucket, sorted by them.

    Tables with the same keys and number of buckets join and group by them (and by more columns) without moving a row.
    Rows that share a key share a bucket, so the keys should be fine enough that no bucket is much larger than the others.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def list_tables(spark: SparkSession, layers: Sequence[str]) -> DataFrame:
    """Layer, table and comment of every table in the named layers, from the catalog."""
    found = []
    for layer in layers:
        for table in spark.sql(f"SHOW TABLES IN {layer}").where("NOT isTemporary").collect():
            told = spark.sql(f"DESCRIBE TABLE EXTENDED {layer}.{table['tableName']}").where("col_name = 'Comment'").first()
            found.append((layer, table["tableName"], told["data_type"] if told else None))
    return spark.createDataFrame(found, "layer string, table_name string, comment string")


def table_columns(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Catalog listing: one row per column of the named tables."""
    rows = [
        (name, field.name, field.dataType.simpleString(), position)
        for name in names
        for position, field in enumerate(spark.table(name).schema, start=1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, position int")


def constant_rows(spark: SparkSession, column: str, values: Sequence[str]) -> DataFrame:
    """A relation of constants, such as the tables a run is expected to report."""
    items = F.array(*[F.lit(value) for value in values])
    return spark.range(1).select(F.explode(items).alias(column))


def day_spine(spark: SparkSession, first: int = -30, last: int = 300, name: str = "date") -> DataFrame:
    """One row per day offset from `first` to `last`."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias(name))


def day_spine_of(df: DataFrame, day: Column, name: str = "date") -> DataFrame:
    """One row per day offset between the first and the last day of a table."""
    bounds = df.agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return bounds.select(F.explode(F.sequence("_first", "_last")).alias(name))


def read_back(df: DataFrame, *order: Column | str) -> DataFrame:
    """The whole table, sorted for reading."""
    return df.orderBy(*order)
