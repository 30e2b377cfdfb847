"""The business reports over the clean and mart tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions import cleaning as c
from tierflow.functions.cleaning import share_when
from tierflow.operators.distinct import distinct_between, distinct_counts
from tierflow.operators.joins import enrich
from tierflow.operators.rank import with_tiles
from tierflow.operators.scoring import Rule, with_score
from tierflow.operators.summarise import (
    explode_factors,
    over_groups,
    share_of_total,
    top_k,
    top_or_other,
    weighted_average,
)
from tierflow.plans.course_mart import CALENDAR
from tierflow.plans.course_tables import ENROLMENT, INTERACTION, PRESENTATION, usable

def _rows() -> Column:
    return F.count(F.lit(1))


def _rounded_avg(column: str, digits: int) -> Column:
    """Average of doubles; sums of doubles are inexact, so the last places go before the rounding."""
    return c.half_up(F.avg(F.col(column).cast("double")), digits)


def _whole_avg(column: str, digits: int) -> Column:
    """Average of whole numbers, rounded exactly."""
    return c.rounded_quotient(F.sum(column), F.count(column), digits)


def _withdrawn() -> Column:
    return F.col("final_result") == "Withdrawn"


# --- engagement, withdrawal, activity, risk factors ---------------------------------------------------------


def engagement_per_enrolment(interactions: DataFrame) -> DataFrame:
    """Clicks, days, activities and sites of each enrolment, from one pass without repeated rows.

    The days of the calendar are bits of a few words. Activities and sites are sets per enrolment, merged before the
    shuffle: a course has some hundred sites, with numbers too far apart for words. Distinct counts side by side would
    repeat every row of the fact once per count.
    """
    return interactions.groupBy(*ENROLMENT).agg(
        F.sum("sum_click").alias("total_clicks"),
        distinct_between(F.col("date"), *CALENDAR).alias("active_days"),
        F.size(F.collect_set("activity_type")).cast("long").alias("distinct_activity_types"),
        F.size(F.collect_set("id_site")).cast("long").alias("unique_resources_accessed"),
    )


def performance_per_enrolment(submissions: DataFrame) -> DataFrame:
    return (
        submissions.filter(F.col("is_banked") == F.lit(False))
        .groupBy(*ENROLMENT)
        .agg(
            weighted_average("score", "weight").alias("weighted_avg_score"),
            F.avg(F.col("score").cast("double")).alias("simple_avg_score"),
            _rows().alias("assessments_taken"),
            F.count_if(F.col("submission_delay") > 0).alias("late_submissions"),
            F.avg("submission_delay").alias("avg_submission_delay"),
        )
    )


def engagement_vs_performance(enrolment: DataFrame, interactions: DataFrame, submissions: DataFrame) -> DataFrame:
    """Engagement quartile within each presentation against outcome and score.

    The facts are summed per enrolment before they meet the roster, so every enrolment counts once and those
    without clicks stay. The correlation of a quartile comes from the same aggregation as the averages.
    """
    roster = enrolment.filter(F.col("final_result").isNotNull()).select(*ENROLMENT, "final_result", "is_withdrawn")
    engaged = enrich(roster, engagement_per_enrolment(interactions), ENROLMENT)
    measured = enrich(engaged, performance_per_enrolment(submissions), ENROLMENT).fillna(
        0,
        [
            "total_clicks",
            "active_days",
            "distinct_activity_types",
            "unique_resources_accessed",
            "assessments_taken",
            "late_submissions",
        ],
    )
    # Rows without a student share their clicks; with the outcome as the last column such rows differ in nothing.
    order = ("total_clicks", "id_student", "final_result")
    tiled = with_tiles(measured, PRESENTATION, order, 4, "engagement_quartile")
    quartile, result = F.col("engagement_quartile"), F.col("final_result")
    grouped = tiled.groupingSets([[quartile, result], [quartile]], quartile, result).agg(
        F.grouping(result).alias("_quartile_row"),
        _rows().alias("student_count"),
        _whole_avg("total_clicks", 0).alias("avg_total_clicks"),
        _whole_avg("active_days", 1).alias("avg_active_days"),
        _whole_avg("distinct_activity_types", 1).alias("avg_activity_types"),
        _whole_avg("unique_resources_accessed", 0).alias("avg_resources_accessed"),
        _rounded_avg("weighted_avg_score", 1).alias("avg_weighted_score"),
        _rounded_avg("simple_avg_score", 1).alias("avg_simple_score"),
        _whole_avg("assessments_taken", 1).alias("avg_assessments_taken"),
        _whole_avg("late_submissions", 2).alias("avg_late_submissions"),
        _rounded_avg("avg_submission_delay", 1).alias("avg_days_late"),
        share_when(F.col("is_withdrawn"), 1).alias("withdrawal_rate_pct"),
        F.corr(F.col("total_clicks").cast("double"), "weighted_avg_score").alias("_corr"),
    )
    # At most four quartiles times the outcomes reach this window.
    in_quartile = Window.partitionBy("engagement_quartile")
    correlation = F.max(F.when(F.col("_quartile_row") == 1, F.col("_corr"))).over(in_quartile)
    return (
        grouped.withColumn("clicks_vs_score_corr_in_quartile", F.round(correlation, 3))
        .filter(F.col("_quartile_row") == 0)
        .drop("_quartile_row", "_corr")
        .orderBy("engagement_quartile", "final_result")
    )


def withdrawal_bins(enrolment: DataFrame, day: str = "date_unregistration", width: int = 90) -> DataFrame:
    """How many enrolments were withdrawn in each bin of days."""
    start = c.floor_bin(day, width)
    binned = enrolment.filter(
        F.col("final_result").isNotNull() & F.col("is_withdrawn") & F.col(day).isNotNull()
    ).select(start.alias("bin_start"))
    end = F.col("bin_start") + (width - 1)
    return (
        binned.groupBy("bin_start")
        .agg(_rows().alias("withdrawal_count"))
        .select(
            "bin_start",
            end.alias("bin_end"),
            F.concat(F.col("bin_start").cast("string"), F.lit(" to "), end.cast("string")).alias("day_bin_label"),
            "withdrawal_count",
        )
        .orderBy("bin_start")
    )


def activity_trend(interactions: DataFrame, date: DataFrame, enrolment: DataFrame, k: int = 2) -> DataFrame:
    """Active students and clicks per phase, week, outcome and activity, the smaller activities as Other."""
    outcome = enrolment.filter(F.col("final_result").isNotNull()).select(*ENROLMENT, "final_result")
    # Clicks of one student, day and activity are summed first: the ranking of the activities and the trend then
    # share one pass over the facts, and the joins see the smaller table.
    daily = interactions.groupBy(*ENROLMENT, "date", "activity_type").agg(F.sum("sum_click").alias("sum_click"))
    grouped = top_or_other(daily, "activity_type", "sum_click", k, "activity_type_grouped")
    # The enrolment first: facts stored by enrolment meet it where they are.
    placed = grouped.join(outcome, list(ENROLMENT)).join(date, "date")
    cell = ("course_phase", "relative_week", "final_result", "activity_type_grouped")
    trend = distinct_counts(placed, cell, "id_student", "active_students", ["sum_click"]).withColumnRenamed("sum_click", "total_clicks")
    per_student = c.rounded_quotient(F.col("total_clicks"), F.col("active_students"), 1)
    return trend.withColumn("avg_clicks_per_active_student", per_student).orderBy(
        "relative_week", "activity_type_grouped", "final_result"
    )


# The outcomes that count as at risk, and the factors with their names in the report.
AT_RISK = ("Fail", "Withdrawn")
RISK_FACTORS = {
    "Age Band": "age_band",
    "Highest Education": "highest_education",
    "IMD Band": "imd_band",
    "Disability": "disability",
    "Previous Attempts": "num_of_prev_attempts",
}

# The name under which the whole cohort is counted.
COHORT = "(cohort)"


def risk_category(rate: Column, baseline: Column) -> Column:
    """Percentage points above or below the baseline."""
    above = rate - baseline
    return (
        F.when(above >= 10, "HIGH RISK")
        .when(above >= 5, "ELEVATED RISK")
        .when(above <= -5, "LOW RISK")
        .otherwise("AVERAGE RISK")
    )


def risk_factors(
    enrolments: DataFrame,
    factors: dict[str, str] | None = None,
    at_risk: tuple[str, ...] = AT_RISK,
    result: str = "final_result",
    student: str = "id_student",
    minimum: int = 100,
    denominator: str = "enrolments",
) -> DataFrame:
    """At-risk share per factor value against the share of the whole cohort.

    `enrolments` carries outcome and factors in one row. With `denominator="students"` the rates divide by
    distinct students instead of enrolments.
    """
    whole = F.count_distinct(student) if denominator == "students" else _rows()
    known = enrolments.filter(F.col(result).isNotNull()).withColumn(
        "_risk", F.col(result).isin(*at_risk).cast("int")
    )
    named = {
        name: F.coalesce(F.col(column).cast("string"), F.lit("Unknown"))
        for name, column in (factors or RISK_FACTORS).items()
    }
    # The cohort itself is one more factor, so its rate comes out of the same pass.
    counted = (
        explode_factors(known, {**named, COHORT: F.lit("")}, [student, "_risk"])
        .groupBy("risk_factor", "factor_value")
        .agg(whole.alias("total_students"), F.sum("_risk").alias("at_risk_count"))
    )
    rate = F.col("at_risk_count").cast("double") * 100.0 / F.nullif(F.col("total_students"), F.lit(0))
    shown = c.percent(F.col("at_risk_count"), F.col("total_students"), 1)
    cohort_rate = F.max(F.when(F.col("risk_factor") == COHORT, shown))
    return (
        counted.withColumn("baseline_risk_pct", over_groups(counted, cohort_rate))
        .filter((F.col("risk_factor") != COHORT) & (F.col("total_students") >= minimum))
        .select(
            "risk_factor",
            "factor_value",
            "total_students",
            "at_risk_count",
            shown.alias("risk_rate_pct"),
            "baseline_risk_pct",
            c.half_up(rate - F.col("baseline_risk_pct"), 1).alias("risk_delta_vs_baseline"),
            risk_category(rate, F.col("baseline_risk_pct")).alias("risk_category"),
        )
        .orderBy("risk_factor", F.desc("risk_rate_pct"), "factor_value")
    )


# --- day-zero risk score ------------------------------------------------------------------------------------

# The rubric, its reasons and its bands.
RISK_RULES = (
    Rule("studied_credits > 240", 3, "credit load over 240"),
    Rule("studied_credits > 120 AND studied_credits <= 240", 2, "credit load 121 to 240"),
    Rule("studied_credits > 60 AND studied_credits <= 120", 1, "credit load 61 to 120"),
    Rule("num_of_prev_attempts >= 3", 2, "three or more previous attempts"),
    Rule("num_of_prev_attempts BETWEEN 1 AND 2", 1, "one or two previous attempts"),
    Rule("imd_decile_low <= 20", 1, "most deprived two bands"),
    Rule("highest_education IN ('No Formal quals', 'Lower Than A Level')", 1, "below A level on entry"),
    Rule("disability = 'Y'", 1, "disability declared"),
)
RISK_BANDS = ((2, "2. medium"), (4, "3. high"))
LOWEST_RISK_BAND = "1. low"


def risk_score(student_info: DataFrame) -> DataFrame:
    """Score, band and reasons per enrolment, from what is known on day zero; the outcome is only carried along."""
    scored = with_score(usable(student_info), RISK_RULES, RISK_BANDS, LOWEST_RISK_BAND)
    return scored.select(
        "enrolment_key",
        *ENROLMENT,
        "risk_score",
        "risk_band",
        "risk_reasons",
        "studied_credits",
        "num_of_prev_attempts",
        "imd_band",
        "highest_education",
        "disability",
        "final_result",
    )


def risk_backtest(scored: DataFrame) -> DataFrame:
    """Does the score separate the cohort: outcomes per band."""
    per_band = scored.groupBy("risk_band").agg(
        _rows().alias("enrolments"),
        _whole_avg("risk_score", 2).alias("avg_risk_score"),
        share_when(_withdrawn(), 2).alias("pct_withdrawn"),
        share_when(F.col("final_result") == "Distinction", 2).alias("pct_distinction"),
    )
    return share_of_total(per_band, "enrolments", "pct_of_cohort", 1).orderBy("risk_band")


# --- dashboard tiles ----------------------------------------------------------------------------------------


def trust_header(student_info: DataFrame) -> DataFrame:
    rejected = F.count_if(F.col("dq_status") == "REJECT")
    return student_info.agg(
        _rows().alias("rows_in_clean"),
        F.count_distinct("id_student").alias("students"),
        share_when(F.col("dq_status") == "PASS", 1).alias("pct_pass"),
        share_when(F.col("dq_status") == "WARN", 1).alias("pct_warn"),
        rejected.alias("rows_rejected"),
        (_rows() - rejected).alias("rows_usable_by_mart"),
    )


def withdrawal_by_credit_load(student_info: DataFrame) -> DataFrame:
    return (
        usable(student_info)
        .groupBy("credit_load_band")
        .agg(
            _rows().alias("enrolments"),
            share_when(_withdrawn(), 2).alias("pct_withdrawn"),
            _whole_avg("studied_credits", 1).alias("avg_credits"),
        )
        .orderBy("credit_load_band")
    )


def withdrawal_by_band(student_info: DataFrame) -> DataFrame:
    """Deprivation bands in order, the unknown one last."""
    return (
        usable(student_info)
        .groupBy(
            F.coalesce("imd_band", F.lit("not known")).alias("imd_band_label"),
            F.coalesce("imd_decile_low", F.lit(999)).alias("sort_order"),
            F.col("imd_band_is_missing").alias("is_flagged"),
        )
        .agg(_rows().alias("enrolments"), share_when(_withdrawn(), 2).alias("pct_withdrawn"))
        .orderBy("sort_order", "imd_band_label")
    )


def flagged_vs_reported(student_info: DataFrame) -> DataFrame:
    cohort = F.when(F.col("imd_band_is_missing"), "imd_band missing (flagged)").otherwise("imd_band reported")
    # The outcomes and the names of their shares.
    outcomes = {
        "pct_withdrawn": "Withdrawn",
        "pct_fail": "Fail",
        "pct_pass": "Pass",
        "pct_distinction": "Distinction",
    }
    shares = [share_when(F.col("final_result") == value, 2).alias(name) for name, value in outcomes.items()]
    grouped = usable(student_info).groupBy(cohort.alias("cohort"))
    return grouped.agg(_rows().alias("enrolments"), *shares).orderBy("cohort")


def slice_rates(
    student_info: DataFrame, slices: tuple[str, ...] = ("gender", "age_band", "highest_education", "disability")
) -> DataFrame:
    """Withdrawal share of every value of several columns, in one pass."""
    columns = {name: F.col(name) for name in slices}
    return (
        explode_factors(usable(student_info), columns, ["final_result"], "slice", "value")
        .groupBy("slice", "value")
        .agg(_rows().alias("enrolments"), share_when(_withdrawn(), 2).alias("pct_withdrawn"))
        .orderBy("slice", F.desc("pct_withdrawn"), "value")
    )


def outcome_by_attempts(student_info: DataFrame) -> DataFrame:
    attempts = F.when(F.col("num_of_prev_attempts") >= 3, "3 or more (flagged)").otherwise(
        F.col("num_of_prev_attempts").cast("string")
    )
    return (
        usable(student_info)
        .groupBy(attempts.alias("prev_attempts"), "final_result")
        .agg(_rows().alias("enrolments"))
        .orderBy("prev_attempts", "final_result")
    )


def outcome_share(student_info: DataFrame) -> DataFrame:
    grouped = usable(student_info).groupBy("final_result").agg(_rows().alias("enrolments"))
    return share_of_total(grouped, "enrolments", "pct", 2).orderBy(F.desc("enrolments"), "final_result")


def coverage_grid(student_info: DataFrame) -> DataFrame:
    return (
        usable(student_info)
        .groupBy(*PRESENTATION)
        .agg(
            _rows().alias("enrolments"),
            F.count_distinct("id_student").alias("students"),
            share_when(F.col("dq_status") == "WARN", 1).alias("pct_flagged"),
        )
        .orderBy(*PRESENTATION)
    )


# --- interaction profiles -----------------------------------------------------------------------------------


def interaction_profile(student_vle: DataFrame) -> DataFrame:
    """The shape of the interaction table in one row."""
    return student_vle.agg(
        _rows().alias("rows"),
        F.count_distinct("id_student").alias("students"),
        F.count_distinct("id_site").alias("sites"),
        F.count_distinct(*PRESENTATION).alias("module_presentations"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.min("sum_click").alias("min_clicks"),
        F.max("sum_click").alias("max_clicks"),
        F.count_if(F.col("date") < 0).alias("pre_course_interactions"),
    )


def raw_vs_clean(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows, combinations, students and clicks before and after the repeats were merged.

    Each table is grouped by combination, then by student, so no row is repeated for a second distinct count.
    """

    def figures(df: DataFrame, name: str) -> DataFrame:
        clicks = F.sum("sum_click").alias("sum_click")
        combinations = df.groupBy(*INTERACTION).agg(_rows().alias("n"), clicks)
        students = combinations.groupBy("id_student").agg(F.sum("n").alias("n"), _rows().alias("combinations"), clicks)
        return students.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum("combinations"), F.lit(0)).alias("unique_combinations"),
            F.count("id_student").alias("unique_students"),
            F.sum("sum_click").alias("total_clicks"),
        ).withColumn("table_name", F.lit(name))

    return figures(raw, "Raw Table").unionByName(figures(clean, "Clean Table"))


def version_measures() -> dict[str, Column]:
    return {
        "total_records": _rows(),
        "unique_students": F.count_distinct("id_student"),
        "unique_sites": F.count_distinct("id_site"),
        "total_clicks": F.sum("sum_click"),
        "avg_clicks": F.avg("sum_click"),
        "min_date": F.min("date"),
        "max_date": F.max("date"),
    }


def flag_distribution(flagged: DataFrame) -> DataFrame:
    return (
        flagged.groupBy("quality_flag", "click_outlier_flag", "date_outlier_flag")
        .agg(
            _rows().alias("record_count"),
            F.count_distinct("id_student").alias("student_count"),
            F.min("sum_click").alias("min_clicks"),
            F.max("sum_click").alias("max_clicks"),
            F.avg("sum_click").alias("avg_clicks"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
        .orderBy(F.desc("record_count"), "quality_flag", "click_outlier_flag", "date_outlier_flag")
    )


def outlier_topk(flagged: DataFrame, k: int = 50, threshold: int = 1000) -> DataFrame:
    """The rows with the most clicks; equal clicks follow the key."""
    unusual = flagged.filter(F.col("sum_click") > threshold).select(
        *INTERACTION, "sum_click", "original_record_count", "click_outlier_flag", "date_outlier_flag"
    )
    return top_k(unusual, k, F.desc("sum_click"), *INTERACTION)


# The days the interpretation report shows.
SHOWN_DAYS = (-25, -20, -10, 0, 1, 30, 100, 200, 250, 269)


def relative_day_labels(student_vle: DataFrame, days: tuple[int, ...] = SHOWN_DAYS) -> DataFrame:
    return (
        student_vle.filter(F.col("date").isin(*days))
        .groupBy(F.col("date").alias("relative_day"))
        .agg(
            _rows().alias("total_interactions"),
            F.count_distinct("id_student").alias("unique_students"),
            F.avg("sum_click").alias("avg_clicks_per_interaction"),
        )
        .withColumn("interpretation", c.relative_day_text("relative_day"))
        .orderBy("relative_day")
    )
