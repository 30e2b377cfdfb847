"""Profiles that follow a folder of files: what arrives is read once, what was read before is not read again.

The state of a folder is the count of every value of every column, kept per group of files in a published table
(`sources/snapshots.py`). Counts of two groups add up, so the profile of the folder is exact: nulls, distinct values,
smallest, largest and most common value come from the merged counts. An update lists the files with their times and sizes,
and counts only those that the state does not know. A file that changed or went takes its group with it; the group's other
files are counted again.

The list of files is a table as well. The driver handles names, times and sizes of files, as any reading of a folder does,
and the names of groups. States are as large as the columns have different values.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.profile import profile_of_counts, value_counts
from tierflow.sources.snapshots import delete_scopes, live_scopes, publish, publish_scopes, read_snapshot

GROUP = "file_group"
_FILES = "path string, modified timestamp, length long"


def listed_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Path, time and size of the files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def _known(spark: SparkSession, place: str) -> DataFrame:
    try:
        return read_snapshot(spark, place)
    except FileNotFoundError:
        return spark.createDataFrame([], f"{_FILES}, {GROUP} string")


def update_profile(spark: SparkSession, folder: str, state: str, columns: Sequence[str] | None = None, pattern: str = "*.parquet") -> list[str]:
    """Bring the state below `state` up to the files of `folder`; returns the files that were read.

    New counts are published first, then the list of files, which decides what readers see, and last go the counts that
    the list no longer names. An update that is killed in between leaves the profile as it was or as it shall be, and the
    next one removes what is left over.
    """
    known, same = _known(spark, f"{state}/files"), ["path", "modified", "length"]
    # Names, times and sizes are taken once: a file that arrives from here on is for the next update.
    now = spark.createDataFrame(listed_files(spark, folder, pattern).collect(), _FILES)
    stale = [row[0] for row in known.join(now, same, "left_anti").select(GROUP).distinct().collect()]
    kept = known.where(~F.col(GROUP).isin(stale)) if stale else known
    fresh = sorted(row[0] for row in now.join(kept, same, "left_anti").select("path").collect())
    if stale or fresh:
        group = uuid.uuid4().hex
        if fresh:
            counts = value_counts(spark.read.parquet(*fresh), columns).withColumn(GROUP, F.lit(group))
            publish_scopes(counts, f"{state}/counts", GROUP)
        publish(kept.unionByName(now.join(kept, same, "left_anti").withColumn(GROUP, F.lit(group))), f"{state}/files")
    listed = {row[0] for row in _known(spark, f"{state}/files").select(GROUP).distinct().collect()}
    left_over = [found for found in live_scopes(spark, f"{state}/counts") if found not in listed]
    if left_over:
        delete_scopes(spark, f"{state}/counts", left_over)
    return fresh


def _types(counts: DataFrame) -> list[T.DataType]:
    """The types that the state names: one per column at most."""
    return [T.StructType.fromDDL(f"x {row[0]}")["x"].dataType for row in counts.select("data_type").distinct().collect()]


def stored_profile(spark: SparkSession, state: str, table: str) -> DataFrame:
    """The profile of the folder as of the last update, from the merged counts alone."""
    live = read_snapshot(spark, f"{state}/files").select(GROUP).distinct()
    counts = read_snapshot(spark, f"{state}/counts").join(live, GROUP, "left_semi")
    merged = counts.groupBy("column_name", "data_type", "value").agg(F.sum("n").alias("n"))
    return profile_of_counts(merged, _types(counts), table)
