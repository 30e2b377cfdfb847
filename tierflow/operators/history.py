"""Results of check runs, kept in the order of the runs and read newest first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.sources.snapshots import append, read_snapshot

RUN = "run_id"
# What tells one test of a run from another.
TEST = ("table_name", "test_type", "column_name", "grain_columns")


def append_run(results: DataFrame, path: str) -> int:
    """Add the results of a run under the number after the last one; earlier runs stay as they are.

    The rows of a run are published together. Two runs that start at the same time may get the same number.
    """
    spark = results.sparkSession
    try:
        last = read_snapshot(spark, path).agg(F.max(RUN)).first()[0] or 0
    except FileNotFoundError:
        last = 0
    append(results.withColumn(RUN, F.lit(last + 1).cast("long")), path)
    return last + 1


def newest_first(spark: SparkSession, path: str, test: Sequence[str] = TEST, failed: str = "failed_rows") -> DataFrame:
    """All runs, the newest first, each test with its number of the run before and how it changed.

    A test that was not part of the run before is compared with its own last run; the first one is new. The windows hold
    one row per run of a test.
    """
    before = Window.partitionBy(*test).orderBy(RUN)
    earlier = F.lag(failed).over(before)
    change = (
        F.when(earlier.isNull(), "new")
        .when(F.col(failed) > earlier, "worse")
        .when(F.col(failed) < earlier, "better")
        .otherwise("same")
    )
    runs = read_snapshot(spark, path).withColumn(f"previous_{failed}", earlier).withColumn("change", change)
    return runs.orderBy(F.desc(RUN), *test)
