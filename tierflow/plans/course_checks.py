"""The 104 checks of the clean course tables and the checks of the mart, as data."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from tierflow.operators.checks import (
    Check,
    CheckedTable,
    Collapses,
    CountBetween,
    FailWhen,
    Orphans,
    Repeats,
    SameCount,
    SameSum,
    Spread,
    not_null_test,
    unique_test,
)
from tierflow.plans.course_tables import ENROLMENT, INTERACTION, PRESENTATION, RAW_COLUMNS

# The questions a check protects.
Q1 = "Q1 engagement vs performance"
Q2 = "Q2 withdrawal patterns"
Q3 = "Q3 activity through the course"

# Accepted codes.
MODULES = ("AAA", "BBB", "CCC", "DDD", "EEE", "FFF", "GGG")
PRESENTATION_FORMAT = "^[0-9]{4}[BJ]$"


def _listed(columns: tuple[str, ...]) -> str:
    return ", ".join(columns)


def _quoted(values: tuple) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def missing(cid, name, columns, question, severity="FAIL", threshold=0.0, blank=False):
    """Any of the columns is missing (or, with `blank`, empty)."""
    terms = [f"{col} IS NULL" for col in columns] + [f"{col} = ''" for col in columns if blank]
    return Check(
        cid, name, "NULL", "Completeness", _listed(columns),
        f"{' and '.join(columns)} present in at least {100 - threshold:g} % of rows",
        FailWhen(" OR ".join(terms)), threshold, severity, question,
    )


def accepted(cid, name, column, values, question, severity="FAIL", missing_fails=False):
    """A value outside the list; a missing one counts only where asked."""
    rule = f"{column} NOT IN ({_quoted(values)})"
    if missing_fails:
        rule = f"{column} IS NULL OR {rule}"
    return Check(
        cid, name, "ACCEPTED VALUES", "Validity", column, f"{column} is one of {_quoted(values)}",
        FailWhen(rule), 0.0, severity, question,
    )


def formatted(cid, name, severity="FAIL"):
    """The presentation code is a year and a half."""
    return Check(
        cid, name, "ACCEPTED VALUES", "Validity", "code_presentation",
        f"code_presentation matches {PRESENTATION_FORMAT}",
        FailWhen(f"NOT code_presentation RLIKE '{PRESENTATION_FORMAT}'"), 0.0, severity, Q3,
    )


def ranged(cid, name, columns, bad, question, severity="FAIL", threshold=0.0, dimension="Validity"):
    return Check(
        cid, name, "RANGE", dimension, _listed(columns), f"no row has {bad}",
        FailWhen(bad), threshold, severity, question,
    )


def castable(cid, name, columns, question):
    """Present raw text that does not read as its type. `columns` maps a name to (type, sentinels)."""
    terms = []
    for column, (kind, sentinels) in columns.items():
        text = f"trim({column})"
        terms.append(f"({text} NOT IN ({_quoted(sentinels)}) AND try_cast({text} AS {kind}) IS NULL)")
    return Check(
        cid, name, "SCHEMA", "Validity", _listed(tuple(columns)),
        "present raw values read as " + ", ".join(f"{name} {kind}" for name, (kind, _) in columns.items()),
        FailWhen(" OR ".join(terms), on="raw"), 0.0, "FAIL", question,
    )


def unique(cid, name, columns, question, label=None, threshold=0.0, on="clean"):
    return Check(
        cid, name, "UNIQUE", "Uniqueness", label or _listed(columns), f"one row per {_listed(columns)}",
        Repeats(columns, on), threshold, "FAIL", question,
    )


def has_parent(cid, name, parent, columns, question):
    return Check(
        cid, name, "REFERENTIAL INTEGRITY", "Referential integrity", _listed(columns),
        f"{_listed(columns)} exists in {parent}", Orphans(parent, columns), 0.0, "FAIL", question,
    )


def same_count(cid, question):
    return Check(
        cid, "clean_row_count_equals_raw", "VOLUME", "Completeness", "table",
        "as many clean rows as raw rows", SameCount(), 0.0, "FAIL", question,
    )


# What the type checks read as missing.
BLANK = ("",)
UNKNOWN = ("", "?")

# Numbers, names, kinds, limits and severities of the checks.
CHECKS: dict[str, tuple[Check, ...]] = {
    "assessments": (
        missing("ASM_01", "id_assessment_not_null", ("id_assessment",), Q1),
        unique("ASM_02", "id_assessment_unique", ("id_assessment",), Q1),
        missing("ASM_03", "assessment_type_not_null", ("assessment_type",), Q1),
        accepted("ASM_04", "assessment_type_accepted_values", "assessment_type", ("TMA", "CMA", "Exam"), Q1),
        accepted("ASM_05", "code_module_accepted_values", "code_module", MODULES, Q3),
        formatted("ASM_06", "code_presentation_format", "WARN"),
        ranged("ASM_07", "weight_in_range", ("weight",), "weight NOT BETWEEN 0 AND 100", Q1),
        missing("ASM_08", "weight_missing", ("weight",), Q1, "WARN"),
        ranged("ASM_09", "date_positive", ("date",), "date <= 0", Q3),
        Check(
            "ASM_10", "date_null_only_for_exam", "NULL", "Consistency", "date, assessment_type",
            "only an exam may have no date", FailWhen("date IS NULL AND assessment_type <> 'Exam'"),
            0.0, "FAIL", Q3,
        ),
        castable(
            "ASM_11", "numeric_columns_cast_cleanly",
            {"id_assessment": ("INT", BLANK), "date": ("INT", UNKNOWN), "weight": ("DOUBLE", UNKNOWN)}, Q1,
        ),
        unique("ASM_12", "no_duplicate_full_rows", RAW_COLUMNS["assessments"], Q1, "all source columns"),
        has_parent("ASM_13", "module_presentation_exists_in_courses", "courses", PRESENTATION, Q3),
        same_count("ASM_14", Q1),
    ),
    "courses": (
        missing("CRS_01", "code_module_not_null", ("code_module",), Q3, blank=True),
        missing("CRS_02", "code_presentation_not_null", ("code_presentation",), Q3, blank=True),
        missing("CRS_03", "module_presentation_length_not_null", ("module_presentation_length",), Q3),
        ranged(
            "CRS_04", "module_presentation_length_positive", ("module_presentation_length",),
            "module_presentation_length <= 0", Q3,
        ),
        ranged(
            "CRS_05", "module_presentation_length_near_255", ("module_presentation_length",),
            "module_presentation_length NOT BETWEEN 230 AND 270", Q3, "WARN", dimension="Accuracy",
        ),
        accepted("CRS_06", "code_module_accepted_values", "code_module", MODULES, Q3),
        formatted("CRS_07", "code_presentation_format"),
        unique("CRS_08", "composite_key_unique", PRESENTATION, Q3),
        castable(
            "CRS_09", "module_presentation_length_casts_cleanly",
            {"module_presentation_length": ("INT", BLANK)}, Q3,
        ),
        same_count("CRS_10", Q3),
    ),
    "student_assessment": (
        missing("SAS_01", "id_student_not_null", ("id_student",), Q1),
        missing("SAS_02", "id_assessment_not_null", ("id_assessment",), Q1),
        missing("SAS_03", "date_submitted_not_null", ("date_submitted",), Q3),
        unique("SAS_04", "grain_unique", ("id_student", "id_assessment"), Q1),
        ranged("SAS_05", "score_within_range", ("score",), "score < 0 OR score > 100", Q1),
        accepted("SAS_06", "is_banked_accepted_values", "is_banked", (0, 1), Q1, missing_fails=True),
        missing("SAS_07", "score_missing", ("score",), Q1, "WARN"),
        castable(
            "SAS_08", "numeric_columns_cast_cleanly",
            {
                "id_student": ("INT", BLANK),
                "id_assessment": ("INT", BLANK),
                "date_submitted": ("INT", BLANK),
                "score": ("DOUBLE", UNKNOWN),
            },
            Q1,
        ),
        unique("SAS_09", "no_duplicate_full_rows", RAW_COLUMNS["student_assessment"], Q1, "all source columns"),
        has_parent("SAS_10", "id_assessment_exists_in_assessments", "assessments", ("id_assessment",), Q1),
        same_count("SAS_11", Q1),
    ),
    "student_info": (
        missing("INF_01", "imd_band_is_known", ("imd_band",), Q2, "WARN", 5.0),
        missing("INF_02", "region_not_null", ("region",), Q2, "WARN"),
        missing("INF_03", "final_result_not_null", ("final_result",), Q1),
        missing("INF_04", "id_student_not_null", ("id_student",), Q3),
        missing("INF_05", "module_presentation_not_null", PRESENTATION, Q3),
        accepted(
            "INF_06", "final_result_accepted_values", "final_result",
            ("Pass", "Fail", "Withdrawn", "Distinction"), Q1,
        ),
        accepted("INF_07", "gender_accepted_values", "gender", ("M", "F"), Q2),
        accepted("INF_08", "age_band_accepted_values", "age_band", ("0-35", "35-55", "55<="), Q2),
        accepted("INF_09", "disability_accepted_values", "disability", ("Y", "N"), Q2),
        Check(
            "INF_10", "imd_band_label_format", "ACCEPTED VALUES", "Consistency", "imd_band_raw",
            "the raw band carries its percent sign", FailWhen("imd_band_raw RLIKE '^[0-9]+-[0-9]+$'"),
            15.0, "WARN", Q2,
        ),
        Check(
            "INF_11", "imd_band_sentinel_removed", "ACCEPTED VALUES", "Consistency", "imd_band",
            "no sentinel is left in the clean band", FailWhen("imd_band = '?'"), 0.0, "FAIL", Q2,
        ),
        ranged("INF_12", "studied_credits_positive", ("studied_credits",), "studied_credits <= 0", Q2),
        ranged(
            "INF_13", "num_of_prev_attempts_not_negative", ("num_of_prev_attempts",),
            "num_of_prev_attempts < 0", Q2,
        ),
        ranged(
            "INF_14", "studied_credits_within_p99", ("studied_credits",), "studied_credits > 240",
            Q2, "WARN", 1.0, "Accuracy",
        ),
        ranged(
            "INF_15", "num_of_prev_attempts_within_tail", ("num_of_prev_attempts",),
            "num_of_prev_attempts > 2", Q2, "WARN", 1.0, "Accuracy",
        ),
        castable("INF_16", "id_student_casts_to_int", {"id_student": ("INT", UNKNOWN)}, Q3),
        castable(
            "INF_17", "numeric_columns_cast_cleanly",
            {"studied_credits": ("INT", UNKNOWN), "num_of_prev_attempts": ("INT", UNKNOWN)}, Q2,
        ),
        unique("INF_18", "composite_key_unique", ENROLMENT, Q3),
        unique("INF_19", "enrolment_key_unique", ("enrolment_key",), Q3),
        unique("INF_20", "no_duplicate_full_rows", RAW_COLUMNS["student_info"], Q3, "all source columns"),
        Check(
            "INF_21", "age_band_stable_per_student", "UNIQUE", "Consistency", "age_band",
            "a student keeps one age band", FailWhen("age_bands_seen_for_student > 1"), 1.0, "WARN", Q2,
        ),
        Check(
            "INF_22", "one_row_per_student_after_collapse", "UNIQUE", "Uniqueness", "id_student",
            "a student shows one set of demographics",
            Collapses("id_student", ("gender", "region", "highest_education", "imd_band", "age_band", "disability")),
            1.0, "WARN", Q3,
        ),
        has_parent("INF_23", "module_presentation_exists_in_courses", "courses", PRESENTATION, Q3),
        same_count("INF_24", Q3),
        Check(
            "INF_25", "row_count_within_expected_band", "VOLUME", "Completeness", "table",
            "30000 to 35000 rows", CountBetween(30000, 35000), 0.0, "FAIL", Q3,
        ),
    ),
    "student_registration": (
        missing("REG_01", "id_student_not_null", ("id_student",), Q3),
        missing("REG_02", "module_presentation_not_null", PRESENTATION, Q3),
        missing(
            "REG_03", "date_registration_missingness_within_bound", ("date_registration",), Q2, "WARN", 0.2
        ),
        Check(
            "REG_04", "date_unregistration_expected_null_rate", "NULL", "Completeness", "date_unregistration",
            "at most 35 % of enrolments are unregistered", FailWhen("date_unregistration IS NOT NULL"),
            35.0, "WARN", Q2,
        ),
        formatted("REG_05", "code_presentation_accepted_format"),
        accepted("REG_06", "code_module_accepted_values", "code_module", MODULES, Q3),
        ranged(
            "REG_07", "date_registration_within_valid_bounds", ("date_registration",),
            "date_registration NOT BETWEEN -365 AND 120", Q2, "WARN", 0.5, "Accuracy",
        ),
        ranged(
            "REG_08", "temporal_sequence_valid", ("date_registration", "date_unregistration"),
            "date_unregistration < date_registration", Q2,
        ),
        castable("REG_09", "id_student_casts_to_int", {"id_student": ("INT", UNKNOWN)}, Q3),
        castable(
            "REG_10", "registration_dates_cast_cleanly",
            {"date_registration": ("INT", UNKNOWN), "date_unregistration": ("INT", UNKNOWN)}, Q2,
        ),
        unique("REG_11", "composite_key_unique", ENROLMENT, Q3),
        unique("REG_12", "no_duplicate_full_rows", RAW_COLUMNS["student_registration"], Q3, "all source columns"),
        Check(
            "REG_13", "registration_date_stable_per_enrolment", "UNIQUE", "Consistency", "date_registration",
            "a student has at most three registration days", Spread("id_student", "date_registration", 3),
            2.0, "WARN", Q2,
        ),
        has_parent("REG_14", "module_presentation_exists_in_courses", "courses", PRESENTATION, Q3),
        same_count("REG_15", Q3),
    ),
    "student_vle": (
        missing("SVL_01", "code_module_not_null", ("code_module",), Q1),
        missing("SVL_02", "code_presentation_not_null", ("code_presentation",), Q3),
        missing("SVL_03", "id_student_not_null", ("id_student",), Q1),
        missing("SVL_04", "id_site_not_null", ("id_site",), Q3),
        missing("SVL_05", "date_not_null", ("date",), Q3),
        missing("SVL_06", "sum_click_not_null", ("sum_click",), Q1),
        ranged("SVL_07", "sum_click_not_negative", ("sum_click",), "sum_click < 0", Q1),
        ranged(
            "SVL_08", "sum_click_greater_than_zero", ("sum_click",), "sum_click = 0", Q1, "WARN", dimension="Accuracy"
        ),
        accepted("SVL_09", "code_module_accepted_values", "code_module", MODULES, Q3),
        formatted("SVL_10", "code_presentation_format"),
        unique(
            "SVL_11", "source_grain_duplicate_rate",
            ("id_student", "id_site", "code_module", "code_presentation", "date"), Q3, threshold=30.0, on="raw",
        ),
        castable(
            "SVL_12", "numeric_columns_cast_cleanly",
            {name: ("INT", UNKNOWN) for name in ("id_student", "id_site", "date", "sum_click")}, Q1,
        ),
        has_parent("SVL_13", "id_site_exists_in_vle", "vle", ("id_site",), Q3),
        has_parent("SVL_14", "module_presentation_exists_in_courses", "courses", PRESENTATION, Q3),
        Check(
            "SVL_15", "clean_row_count_equals_raw", "VOLUME", "Completeness", "table",
            "merging repeats keeps every click", SameSum("try_cast(trim(sum_click) AS INT)", "sum_click"),
            0.0, "FAIL", Q3,
        ),
    ),
    "vle": (
        missing("VLE_01", "id_site_not_null", ("id_site",), Q3),
        missing("VLE_02", "code_module_not_null", ("code_module",), Q3, blank=True),
        missing("VLE_03", "code_presentation_not_null", ("code_presentation",), Q3, blank=True),
        missing("VLE_04", "activity_type_not_null", ("activity_type",), Q1, blank=True),
        unique("VLE_05", "id_site_unique", ("id_site",), Q3),
        ranged("VLE_06", "week_from_not_negative", ("week_from",), "week_from < 0", Q3),
        ranged("VLE_07", "week_to_not_negative", ("week_to",), "week_to < 0", Q3),
        ranged("VLE_08", "week_from_not_after_week_to", ("week_from", "week_to"), "week_from > week_to", Q3),
        missing("VLE_09", "week_range_known", ("week_from", "week_to"), Q3, "WARN", 85.0),
        accepted("VLE_10", "code_module_accepted_values", "code_module", MODULES, Q3),
        formatted("VLE_11", "code_presentation_format"),
        castable(
            "VLE_12", "numeric_columns_cast_cleanly",
            {name: ("INT", UNKNOWN) for name in ("id_site", "week_from", "week_to")}, Q3,
        ),
        has_parent("VLE_13", "module_presentation_exists_in_courses", "courses", PRESENTATION, Q3),
        same_count("VLE_14", Q3),
    ),
}


def tables_read(name: str) -> list[str]:
    """The table itself and the parents its checks look keys up in."""
    return [name, *sorted({check.rule.parent for check in CHECKS[name] if isinstance(check.rule, Orphans)})]


def checked(
    name: str,
    clean: Mapping[str, DataFrame],
    raw: Mapping[str, DataFrame],
    owner: str = "data quality",
) -> CheckedTable:
    """A course table with its raw form, its parents and its checks."""
    parents = {parent: clean[parent] for parent in tables_read(name)[1:]}
    return CheckedTable(name, clean[name], CHECKS[name], raw[name], parents, owner=owner)


def mart_tests(
    submissions: DataFrame, interactions: DataFrame, interaction_grain: tuple[str, ...] = INTERACTION, tasks: int | None = None
) -> DataFrame:
    """Present students and unique grain in both facts; `tasks` is the number of parts that keys are counted in."""
    tests = [
        not_null_test(submissions, "fact_assessments", "id_student"),
        not_null_test(interactions, "fact_vle_interactions", "id_student"),
        unique_test(submissions, "fact_assessments", ("id_student", "id_assessment"), tasks),
        unique_test(interactions, "fact_vle_interactions", interaction_grain, tasks),
    ]
    return reduce(DataFrame.unionByName, tests)
