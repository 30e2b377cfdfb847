"""The seven course tables: raw columns, and the cleaning of each. Rows in equal rows out, except for clicks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions import cleaning as c
from tierflow.functions import flags
from tierflow.operators.grain import collapse_sum, with_distinct_per_entity

# The columns of the source files.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "assessments": ("code_module", "code_presentation", "id_assessment", "assessment_type", "date", "weight"),
    "courses": ("code_module", "code_presentation", "module_presentation_length"),
    "student_assessment": ("id_assessment", "id_student", "date_submitted", "is_banked", "score"),
    "student_info": (
        "code_module",
        "code_presentation",
        "id_student",
        "gender",
        "region",
        "highest_education",
        "imd_band",
        "age_band",
        "num_of_prev_attempts",
        "studied_credits",
        "disability",
        "final_result",
    ),
    "student_registration": (
        "code_module",
        "code_presentation",
        "id_student",
        "date_registration",
        "date_unregistration",
    ),
    "student_vle": ("code_module", "code_presentation", "id_student", "id_site", "date", "sum_click"),
    "vle": ("id_site", "code_module", "code_presentation", "activity_type", "week_from", "week_to"),
}

# The source files by table.
RAW_FILES: dict[str, str] = {
    "assessments": "assessments.csv",
    "courses": "courses.csv",
    "student_assessment": "studentAssessment.csv",
    "student_info": "studentInfo.csv",
    "student_registration": "studentRegistration.csv",
    "student_vle": "studentVle.csv",
    "vle": "vle.csv",
}

ENROLMENT = ("code_module", "code_presentation", "id_student")
PRESENTATION = ("code_module", "code_presentation")
INTERACTION = ("code_module", "code_presentation", "id_student", "id_site", "date")

# Labels of the assessment types, by their upper-case form.
ASSESSMENT_TYPES = {"TMA": "TMA", "CMA": "CMA", "EXAM": "Exam"}

# Credit bands, largest first.
CREDIT_BANDS = ((240, "over 240 (flagged outlier)"), (120, "121-240"), (60, "61-120"))
SMALLEST_CREDIT_BAND = "60 or less"

# Row flags of student_info: the text shown and the condition.
STUDENT_FLAGS = (
    ("imd_band not known", "imd_band IS NULL"),
    ("imd_band label repaired", r"imd_band_raw RLIKE '^[0-9]+-[0-9]+$'"),
    ("studied_credits above 240", "studied_credits > 240"),
    ("more than two previous attempts", "num_of_prev_attempts > 2"),
    ("age_band changed over time", "age_bands_seen_for_student > 1"),
)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_cleaned_at", F.current_timestamp())


def clean_assessments(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            c.code("code_module").alias("code_module"),
            c.code("code_presentation").alias("code_presentation"),
            c.safe_cast("id_assessment", "int").alias("id_assessment"),
            c.canonical_label("assessment_type", ASSESSMENT_TYPES).alias("assessment_type"),
            c.safe_cast("date", "int").alias("date"),
            c.safe_cast("weight", "double").alias("weight"),
        )
    )


def clean_courses(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            c.code("code_module").alias("code_module"),
            c.code("code_presentation").alias("code_presentation"),
            c.safe_cast("module_presentation_length", "int").alias("module_presentation_length"),
        )
    )


def clean_student_assessment(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            c.safe_cast("id_assessment", "int").alias("id_assessment"),
            c.safe_cast("id_student", "int").alias("id_student"),
            c.safe_cast("date_submitted", "int").alias("date_submitted"),
            c.safe_cast("is_banked", "int").alias("is_banked"),
            c.safe_cast("score", "double").alias("score"),
        )
    )


def clean_student_info(raw: DataFrame) -> DataFrame:
    """Typed student enrolments with the derived columns and the row status that checks and reports read."""
    typed = raw.select(
        c.code("code_module").alias("code_module"),
        c.code("code_presentation").alias("code_presentation"),
        c.safe_cast("id_student", "int").alias("id_student"),
        c.code("gender").alias("gender"),
        c.clean_null("region").alias("region"),
        c.clean_null("highest_education").alias("highest_education"),
        c.repair_label("imd_band").alias("imd_band"),
        F.trim("imd_band").alias("imd_band_raw"),
        c.clean_null("age_band").alias("age_band"),
        c.safe_cast("num_of_prev_attempts", "int").alias("num_of_prev_attempts"),
        c.safe_cast("studied_credits", "int").alias("studied_credits"),
        c.code("disability").alias("disability"),
        c.clean_null("final_result").alias("final_result"),
    )
    counted = with_distinct_per_entity(typed, "id_student", "age_band", "age_bands_seen_for_student", spread=PRESENTATION)
    derived = counted.select(
        c.row_key(*ENROLMENT).alias("enrolment_key"),
        *typed.columns,
        F.col("imd_band").isNull().alias("imd_band_is_missing"),
        c.lower_bound("imd_band").alias("imd_decile_low"),
        "age_bands_seen_for_student",
        c.bucketize("studied_credits", CREDIT_BANDS, SMALLEST_CREDIT_BAND).alias("credit_load_band"),
        (F.col("final_result") == "Withdrawn").alias("is_withdrawn"),
    )
    return _stamped(flags.with_row_status(derived, STUDENT_FLAGS, ENROLMENT))


def usable(student_info: DataFrame) -> DataFrame:
    """The rows whose status is not REJECT, which means: the key is complete."""
    return student_info.dropna(subset=list(ENROLMENT))


def clean_student_registration(raw: DataFrame) -> DataFrame:
    """Codes of another length are kept; the format checks count them."""
    return _stamped(
        raw.select(
            c.code("code_module").alias("code_module"),
            c.code("code_presentation").alias("code_presentation"),
            c.safe_cast("id_student", "int").alias("id_student"),
            c.safe_cast("date_registration", "int").alias("date_registration"),
            c.safe_cast("date_unregistration", "int").alias("date_unregistration"),
        )
    )


def type_student_vle(raw: DataFrame) -> DataFrame:
    """Interactions with clean keys, still at the grain of the file."""
    return raw.select(
        c.code("code_module").alias("code_module"),
        c.code("code_presentation").alias("code_presentation"),
        c.safe_cast("id_student", "int").alias("id_student"),
        c.safe_cast("id_site", "int").alias("id_site"),
        c.safe_cast("date", "int").alias("date"),
        c.safe_cast("sum_click", "int").alias("sum_click"),
    )


def merge_student_vle(typed: DataFrame) -> DataFrame:
    """One row per student, site, presentation and day."""
    return collapse_sum(typed, INTERACTION, "sum_click")


def clean_student_vle(raw: DataFrame) -> DataFrame:
    """One row per student, site, presentation and day. Keys are cleaned before they are grouped."""
    return _stamped(merge_student_vle(type_student_vle(raw)))


def flag_student_vle(clean: DataFrame) -> DataFrame:
    clicks, day = F.col("sum_click"), F.col("date")
    return clean.withColumns(
        {
            "click_outlier_flag": flags.click_flag(clicks),
            "date_outlier_flag": flags.day_flag(day),
            "quality_flag": flags.review_flag(clicks, day),
        }
    )


def final_student_vle(clean: DataFrame, drop_extreme: bool = False) -> DataFrame:
    """Boolean flags instead of labels; all rows are kept unless the extreme ones are asked to go."""
    rows = clean.filter(F.col("sum_click") <= flags.EXTREME_CLICKS) if drop_extreme else clean
    return rows.select(
        *INTERACTION,
        "sum_click",
        "original_record_count",
        flags.is_true(F.col("date") < flags.FIRST_NORMAL_DAY).alias("is_pre_course_access"),
        flags.is_true(F.col("date") > flags.LAST_NORMAL_DAY).alias("is_late_access"),
        flags.is_true(F.col("sum_click") > flags.HIGH_CLICKS).alias("is_high_click_outlier"),
    )


def clean_vle(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            c.safe_cast("id_site", "int").alias("id_site"),
            c.code("code_module").alias("code_module"),
            c.code("code_presentation").alias("code_presentation"),
            c.lower_code("activity_type").alias("activity_type"),
            c.safe_cast("week_from", "int").alias("week_from"),
            c.safe_cast("week_to", "int").alias("week_to"),
        )
    )


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "assessments": clean_assessments,
    "courses": clean_courses,
    "student_assessment": clean_student_assessment,
    "student_info": clean_student_info,
    "student_registration": clean_student_registration,
    "student_vle": clean_student_vle,
    "vle": clean_vle,
}


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Each clean table reads only its own raw table."""
    return {name: CLEANERS[name](df) for name, df in raw.items()}
