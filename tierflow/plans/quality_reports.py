"""Reports over check results and over the row status of a clean table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.cleaning import half_up, percent, share_when
from tierflow.operators.summarise import over_groups, share_of_total, top_k
from tierflow.sources.tables import constant_rows


def _rows() -> Column:
    return F.count(F.lit(1))


def _with_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def _outcome_counts() -> list[Column]:
    return [
        _with_status("PASS").alias("passed"),
        _with_status("WARN").alias("warned"),
        _with_status("FAIL").alias("failed"),
        share_when(F.col("status") == "PASS", 1).alias("pass_rate_pct"),
    ]


def health(results: DataFrame) -> DataFrame:
    """One row for the top of the page, with the verdict in words."""
    verdict = (
        F.when(_with_status("FAIL") > 0, "DO NOT SHIP")
        .when(_with_status("WARN") > 0, "USABLE, READ THE FLAGS")
        .otherwise("HEALTHY")
    )
    return results.agg(
        _rows().alias("checks_run"),
        *_outcome_counts(),
        F.count_distinct("table_name").alias("tables_reporting"),
        verdict.alias("overall_health"),
        F.max("executed_at").alias("last_checked"),
    )


def coverage(results: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Every expected table, also the ones that never reported."""
    actual = results.groupBy("table_name").agg(
        _rows().alias("checks_run"),
        _with_status("FAIL").alias("failed"),
        _with_status("WARN").alias("warned"),
        F.max("owner").alias("owner"),
        F.max("executed_at").alias("last_checked"),
    )
    listed = constant_rows(results.sparkSession, "table_name", expected)
    state = F.when(F.col("checks_run").isNull(), "NEVER RUN").otherwise("reported")
    return (
        listed.join(actual, "table_name", "left")
        .withColumn("coverage", state)
        .fillna(0, ["checks_run", "failed", "warned"])
        .orderBy(F.desc("coverage"), F.desc("failed"), "table_name")
    )


def _pass_rate(results: DataFrame, column: str) -> DataFrame:
    grouped = results.groupBy(column).agg(_rows().alias("checks"), *_outcome_counts())
    return grouped.orderBy(F.desc("failed"), F.desc("warned"), column)


def by_type(results: DataFrame) -> DataFrame:
    return _pass_rate(results, "check_type")


def by_dimension(results: DataFrame) -> DataFrame:
    return _pass_rate(results, "dq_dimension")


def by_type_and_status(results: DataFrame) -> DataFrame:
    return results.groupBy("check_type", "status").agg(_rows().alias("checks")).orderBy("check_type", "status")


def by_table(results: DataFrame) -> DataFrame:
    grouped = results.groupBy("layer", "table_name").agg(
        _rows().alias("checks"),
        _with_status("FAIL").alias("critical_failures"),
        _with_status("WARN").alias("warnings"),
        F.max("executed_at").alias("last_checked"),
    )
    return grouped.orderBy(F.desc("critical_failures"), F.desc("warnings"), "layer", "table_name")


def critical(results: DataFrame) -> DataFrame:
    """Checks with status FAIL, worst first."""
    shown = ("table_name", "check_id", "check_name", "check_type", "column_name", "expectation", "fail_count",
             "total_count", "fail_pct", "threshold", "business_question", "owner", "executed_at")
    failed = results.filter(F.col("status") == "FAIL").select(*shown)
    return failed.orderBy(F.desc("fail_pct"), "table_name", "check_id")


def headroom(results: DataFrame) -> DataFrame:
    """Everything that flagged, with the distance between what was allowed and what happened."""
    room = half_up(F.col("threshold") - F.col("fail_pct"), 4).alias("headroom_pct")
    return (
        results.filter(F.col("fail_count") > 0)
        .select(
            "table_name",
            "check_id",
            "check_name",
            "dq_dimension",
            "fail_count",
            "total_count",
            "fail_pct",
            "threshold",
            "severity",
            "status",
            room,
            "business_question",
            "owner",
        )
        .orderBy(F.desc("status"), F.desc("fail_pct"), "table_name", "check_id")
    )


def full_results(results: DataFrame) -> DataFrame:
    return results.orderBy("table_name", "check_id")


def row_status(df: DataFrame, entity: str = "id_student") -> DataFrame:
    grouped = df.groupBy("dq_status").agg(
        _rows().alias("rows_in_table"), F.count_distinct(entity).alias("students")
    )
    return share_of_total(grouped, "rows_in_table", "pct", 2).orderBy("dq_status")


def flags_fired(df: DataFrame, entity: str = "id_student", prefix: str = "WARN: ") -> DataFrame:
    """Rows and entities behind every flag.

    A row without flags stays as one row, so the rows of the table are counted in the same pass.
    """
    fired = df.select(entity, F.posexplode_outer("dq_flags").alias("at", "flag"))
    counted = fired.groupBy("flag").agg(
        _rows().alias("rows_flagged"),
        F.count_distinct(entity).alias("students_affected"),
        F.count_if(F.coalesce("at", F.lit(0)) == 0).alias("_first"),
    )
    return (
        counted.withColumn("pct_of_table", percent(F.col("rows_flagged"), over_groups(counted, F.sum("_first")), 2))
        .filter(F.col("flag").isNotNull())
        .select(
            F.replace("flag", F.lit(prefix), F.lit("")).alias("flag"),
            "rows_flagged",
            "pct_of_table",
            "students_affected",
        )
        .orderBy(F.desc("rows_flagged"), "flag")
    )


def failing_sample(
    df: DataFrame, columns: Sequence[str], then_by: str, key: str, k: int = 200
) -> DataFrame:
    """The k rows with the most flags."""
    flagged = df.filter(F.col("dq_status") != "PASS").select(*columns, "dq_status", "dq_flags")
    return top_k(flagged, k, F.desc(F.size("dq_flags")), F.desc_nulls_last(then_by), key)


def flag_grid(df: DataFrame, rows: str = "code_module", columns: str = "code_presentation") -> DataFrame:
    """Flagged share per cell of two columns, without rejected rows."""
    warned = F.col("dq_status") == "WARN"
    return (
        df.filter(F.col("dq_status") != "REJECT")
        .groupBy(rows, columns)
        .agg(
            _rows().alias("enrolments"),
            F.count_if(warned).alias("rows_flagged"),
            share_when(warned, 1).alias("pct_flagged"),
        )
        .orderBy(rows, columns)
    )
