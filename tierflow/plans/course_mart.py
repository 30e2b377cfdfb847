"""The star schema: one row per student, per enrolment, per course and day, and facts that cannot fan out."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions import cleaning as c
from tierflow.functions.flags import is_true
from tierflow.operators.grain import latest_row
from tierflow.operators.joins import enrich, gate, not_by_estimate, one_per_key
from tierflow.plans.course_tables import ENROLMENT, PRESENTATION, usable
from tierflow.sources.tables import day_spine

DEMOGRAPHICS = ("gender", "region", "highest_education", "imd_band", "imd_decile_low", "age_band", "disability")


def dim_course(courses: DataFrame) -> DataFrame:
    return courses.select("code_module").distinct()


def dim_module_presentation(courses: DataFrame, course: DataFrame) -> DataFrame:
    """Presentations with the key of their course."""
    parents = course.select("code_module", F.col("code_module").alias("code_presentation_module"))
    return (
        courses.join(parents, "code_module")
        .select("code_module", "code_presentation_module", "code_presentation", "module_presentation_length")
        .distinct()
    )


def course_phase(day: Column) -> Column:
    """The phases of a course by day."""
    return (
        F.when(day < 0, "Pre-Course")
        .when(day <= 30, "Early Course")
        .when(day <= 180, "Mid Course")
        .otherwise("Late / Assessment Phase")
    )


def with_calendar(days: DataFrame) -> DataFrame:
    """Week and phase of each day; week 0 starts on day 0."""
    day = F.col("date")
    return days.select("date", F.floor(day / F.lit(7.0)).cast("int").alias("relative_week"), course_phase(day).alias("course_phase"))


# First and last day of the calendar, which also bounds the facts.
CALENDAR = (-30, 300)


def dim_date(spark: SparkSession, first: int = CALENDAR[0], last: int = CALENDAR[1]) -> DataFrame:
    return with_calendar(day_spine(spark, first, last))


def dim_enrolment(student_info: DataFrame, registration: DataFrame) -> DataFrame:
    """One row per enrolment with its outcome and registration days, keyed by all three key columns."""
    dates = registration.select(*ENROLMENT, "date_registration", "date_unregistration")
    return enrich(student_info.select(*ENROLMENT, "final_result"), not_by_estimate(one_per_key(dates, ENROLMENT)), ENROLMENT).withColumn(
        "is_withdrawn", is_true(F.lower(F.trim("final_result")) == "withdrawn")
    )


def dim_student(student_info: DataFrame) -> DataFrame:
    """One row per student: the demographics of the latest presentation, and a mark where the age band changed."""
    columns = (*DEMOGRAPHICS, *PRESENTATION, "age_bands_seen_for_student")
    newest = latest_row(usable(student_info), ["id_student"], ("code_presentation", "code_module", "enrolment_key"), columns)
    return newest.select(
        c.row_key("id_student").alias("student_key"),
        "id_student",
        *DEMOGRAPHICS,
        F.col("code_module").alias("demographics_from_module"),
        F.col("code_presentation").alias("demographics_from_presentation"),
        (F.col("age_bands_seen_for_student") > 1).alias("age_band_changed_over_time"),
    )


def dim_demographics(student_info: DataFrame, student: DataFrame) -> DataFrame:
    """Enrolment demographics of known students; the gate cannot multiply them."""
    kept = (*ENROLMENT, "gender", "region", "highest_education", "imd_band", "age_band")
    rest = ("num_of_prev_attempts", "studied_credits", "disability")
    return gate(student_info.select(*kept, *rest), not_by_estimate(student), ["id_student"])


def fact_vle_interactions(
    student_vle: DataFrame, vle: DataFrame, student: DataFrame, presentation: DataFrame, date: DataFrame
) -> DataFrame:
    """Interactions with their activity type, gated on known student, presentation and day."""
    site = ("id_site", *PRESENTATION)
    known = gate(student_vle, date, ["date"])
    known = gate(known, presentation, PRESENTATION)
    known = gate(known, not_by_estimate(student), ["id_student"])
    typed = enrich(known, one_per_key(vle.select(*site, "activity_type"), site), site)
    return typed.select(
        "id_student", "code_module", "code_presentation", "date", "id_site", "activity_type", "sum_click"
    )


def fact_assessments(
    student_assessment: DataFrame, assessments: DataFrame, student: DataFrame, presentation: DataFrame, date: DataFrame
) -> DataFrame:
    """Submissions with their assessment, gated like the interactions; undated assessments fall out at the day gate.

    A repeated assessment is brought to one row before the gates, so a submission can meet one row at most.
    """
    details = assessments.select("id_assessment", *PRESENTATION, "assessment_type", "date", "weight")
    dated = gate(one_per_key(details, ["id_assessment"]), date, ["date"])
    dated = gate(dated, presentation, PRESENTATION)
    known = gate(student_assessment.drop("_cleaned_at"), not_by_estimate(student), ["id_student"])
    return known.join(dated, "id_assessment").select(
        "id_student",
        "code_module",
        "code_presentation",
        "date",
        "id_assessment",
        "assessment_type",
        c.try_decimal("weight").alias("weight"),
        c.try_decimal("score").alias("score"),
        "date_submitted",
        (F.col("date_submitted") - F.col("date")).alias("submission_delay"),
        F.col("is_banked").cast("boolean").alias("is_banked"),
    )


class Mart:
    """The mart tables over the clean ones, each planned when it is first asked for."""

    def __init__(self, clean: Mapping[str, DataFrame]):
        self.clean = clean

    @cached_property
    def dim_course(self) -> DataFrame:
        return dim_course(self.clean["courses"])

    @cached_property
    def dim_module_presentation(self) -> DataFrame:
        return dim_module_presentation(self.clean["courses"], self.dim_course)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(next(iter(self.clean.values())).sparkSession)

    @cached_property
    def dim_student(self) -> DataFrame:
        return dim_student(self.clean["student_info"])

    @cached_property
    def dim_enrolment(self) -> DataFrame:
        return dim_enrolment(self.clean["student_info"], self.clean["student_registration"])

    @cached_property
    def dim_demographics(self) -> DataFrame:
        return dim_demographics(self.clean["student_info"], self.dim_student)

    @cached_property
    def fact_vle_interactions(self) -> DataFrame:
        return fact_vle_interactions(
            self.clean["student_vle"], self.clean["vle"], self.dim_student, self.dim_module_presentation, self.dim_date
        )

    @cached_property
    def fact_assessments(self) -> DataFrame:
        return fact_assessments(
            self.clean["student_assessment"],
            self.clean["assessments"],
            self.dim_student,
            self.dim_module_presentation,
            self.dim_date,
        )


# The mart tables, dimensions first.
MART_TABLES = (
    "dim_course",
    "dim_module_presentation",
    "dim_date",
    "dim_student",
    "dim_enrolment",
    "dim_demographics",
    "fact_vle_interactions",
    "fact_assessments",
)
