"""Row-level flags: kept beside the value, so nothing has to be deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits and labels of the interaction flags.
HIGH_CLICKS = 1000
EXTREME_CLICKS = 5000
FIRST_NORMAL_DAY = -20
LAST_NORMAL_DAY = 250


def click_flag(clicks: Column, high: float = HIGH_CLICKS, extreme: float = EXTREME_CLICKS) -> Column:
    """The extreme limit is tested first, or its label could never appear."""
    return (
        F.when(clicks > extreme, "extreme_click_outlier")
        .when(clicks > high, "high_click_outlier")
        .otherwise("normal")
    )


def day_flag(day: Column, first: int = FIRST_NORMAL_DAY, last: int = LAST_NORMAL_DAY) -> Column:
    return (
        F.when(day < first, "pre_course_access")
        .when(day > last, "late_course_access")
        .when(day < 0, "pre_start_normal")
        .otherwise("normal")
    )


def review_flag(
    clicks: Column,
    day: Column,
    high: float = HIGH_CLICKS,
    first: int = FIRST_NORMAL_DAY,
    last: int = LAST_NORMAL_DAY,
) -> Column:
    unusual = (clicks > high) | (day < first) | (day > last)
    return F.when(unusual, "review_needed").otherwise("clean")


def is_true(condition: Column) -> Column:
    """A condition as a plain flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def with_row_status(
    df: DataFrame,
    flags: Sequence[tuple[str, str]],
    keys: Sequence[str],
    prefix: str = "WARN: ",
) -> DataFrame:
    """Add `dq_flags` (texts of the conditions that hold) and `dq_status`.

    `flags` pairs a text with a SQL condition. REJECT means a key column is missing, WARN that a flag fired.
    """
    fired = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(prefix + text)) for text, rule in flags]))
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    return df.withColumn("dq_flags", fired).withColumn(
        "dq_status",
        F.when(keyless, "REJECT").when(F.size("dq_flags") > 0, "WARN").otherwise("PASS"),
    )
