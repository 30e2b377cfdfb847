"""Files into the raw layer: every column a string, nothing guessed, nothing lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
LINEAGE = ("_source_file", "_source_modified_at", "_ingested_at")


def string_schema(columns: Sequence[str]) -> T.StructType:
    """All columns STRING, so that a bad value reaches the checks instead of turning NULL at the scan."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_csv_strings(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], header: bool = True
) -> DataFrame:
    """CSV as strings, plus the rescued text of misshapen lines and the file lineage.

    Whole lines are parsed whatever is selected, so only this raw read uses CSV; later layers read Parquet.
    """
    schema = string_schema([*columns, RESCUED])
    lines = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUED)
        # A pruned read skips the fields that show a line to be misshapen.
        .option("columnPruning", False)
        .csv(path)
    )
    return lines.select(
        *columns,
        RESCUED,
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_modified_at"),
        F.current_timestamp().alias("_ingested_at"),
    )


def read_csv_typed(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """CSV with a header and a DDL schema, typed at read time (values that do not fit become NULL)."""
    return spark.read.schema(ddl).option("header", True).csv(path)


def rescued_rows(raw: DataFrame) -> DataFrame:
    """The lines that did not fit the column list; the contract is that there are none.

    To count them, read the written raw table: Spark refuses a count straight from the files.
    """
    return raw.filter(F.col(RESCUED).isNotNull())
