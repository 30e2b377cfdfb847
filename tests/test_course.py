"""The course build on small files: layers, gates, grain and reports."""

import pytest
from pyspark.sql import functions as F

from tests.course_data import added, changed, clean_course, frames
from tierflow.operators.checks import not_null_test
from tierflow.plans import course_mart as m
from tierflow.plans import course_reports as r
from tierflow.plans import course_tables as t
from tierflow.plans import quality_reports as q
from tierflow.plans.course import CourseStore, ValidationFailed, build
from tierflow.plans.course_checks import CHECKS, mart_tests
from tierflow.sources.tables import write_bucketed


def write_files(folder, tables):
    folder.mkdir(exist_ok=True)
    for name, rows in tables.items():
        lines = [",".join(t.RAW_COLUMNS[name]), *(",".join(row) for row in rows)]
        (folder / t.RAW_FILES[name]).write_text("\n".join(lines) + "\n")
    return str(folder)


def mart_of(spark, tables):
    return m.Mart(t.clean_all(frames(spark, tables)))


def test_build_from_files(spark, tmp_path, rows):
    source = write_files(tmp_path / "in", clean_course())
    with pytest.raises(ValidationFailed, match="failed checks"):
        # Six rows are outside the expected volume, so the mart is not built.
        build(spark, source, str(tmp_path / "gated"))
    layers = build(spark, source, str(tmp_path / "out"), allow_failures=True)
    results = layers["validation"]["staging"]
    assert results.count() == 104
    assert rows(results.filter("status = 'FAIL'"), "check_id") == [("INF_25",)]
    assert rows(layers["raw"]["courses"], "_rescued_data") == [(None,)] * 3
    assert {"_source_file", "_source_modified_at", "_ingested_at"} <= set(layers["raw"]["vle"].columns)
    assert all("_cleaned_at" in df.columns for df in layers["clean"].values())
    assert layers["mart"]["fact_vle_interactions"].count() == 6
    tests = layers["validation"]["mart"]
    assert rows(tests, "test_type", "test_result") == [("NOT_NULL", "PASS")] * 2 + [("UNIQUENESS", "PASS")] * 2
    # A second run of one table replaces only its rows.
    store = CourseStore(spark, str(tmp_path / "out"))
    again = store.validate(layers["clean"], layers["raw"], ("courses",))
    assert again.count() == 104
    assert store.validate_mart(layers["mart"]).count() == 8
    stamps = dict(rows(again.groupBy("table_name").agg(F.max("executed_at"))))
    assert max(stamps, key=stamps.get) == "courses"


def test_files_with_faults(spark, tmp_path, rows):
    tables = changed(clean_course(), "assessments", 0, date="12.5", weight=" 12.5 ")
    tables = changed(tables, "courses", 0, code_module=" aaa ")
    source = write_files(tmp_path / "in", tables)
    with open(tmp_path / "in" / "vle.csv", "a") as vle:
        vle.write("104,AAA,2013B,url,1,2,surplus\n105,AAA\n")
    store = CourseStore(spark, str(tmp_path / "out"))
    raw = store.ingest(source)
    assert rows(raw["vle"].filter("_rescued_data is not null"), "id_site") == [("104",), ("105",)]
    assert rows(store.misshapen(raw)) == [("vle", 2)]
    with pytest.raises(ValidationFailed, match="did not fit"):
        build(spark, source, str(tmp_path / "gated"))
    clean = store.clean(raw)
    assert clean["vle"].count() == raw["vle"].count() == 6
    assert rows(clean["assessments"].filter("id_assessment = 10"), "date", "weight") == [(None, 12.5)]
    assert rows(clean["courses"].filter("code_presentation = '2013B'"), "code_module") == [("AAA",)]


def test_rows_in_equal_rows_out(spark):
    tables = clean_course()
    clean = t.clean_all(frames(spark, tables))
    for name in t.RAW_COLUMNS:
        assert clean[name].count() == len(tables[name]) - (1 if name == "student_vle" else 0)


def test_merging_keys_are_cleaned_first(spark, rows):
    tables = added(clean_course(), "student_vle", (" aaa ", "2013j", " 1", "101", "-3", "10"))
    merged = t.clean_all(frames(spark, tables))["student_vle"].filter("id_site = 101 and id_student = 1")
    assert rows(merged, "code_module", "sum_click", "original_record_count") == [("AAA", 15, 3)]


def test_interaction_flags_and_extreme_rows(spark, rows):
    tables = clean_course()
    limits = [("0", "1000"), ("250", "1001"), ("251", "5000"), ("-20", "5001"), ("-21", "?")]
    tables["student_vle"] = [("AAA", "2013B", "1", "100", day, clicks) for day, clicks in limits]
    clean = t.clean_all(frames(spark, tables))["student_vle"]
    assert rows(t.final_student_vle(clean), "date", "is_pre_course_access", "is_late_access", "is_high_click_outlier") == [
        (-20, False, False, True), (-21, True, False, False), (0, False, False, False),
        (250, False, False, True), (251, False, True, True),
    ]
    assert rows(t.final_student_vle(clean, drop_extreme=True), "date") == [(0,), (250,), (251,)]
    assert rows(r.outlier_topk(t.flag_student_vle(clean), 2), "date", "sum_click") == [(-20, 5001), (251, 5000)]


def test_calendar(spark):
    days = {row["date"]: (row["relative_week"], row["course_phase"]) for row in m.dim_date(spark).collect()}
    assert len(days) == 331
    assert days[-30] == (-5, "Pre-Course") and days[-1] == (-1, "Pre-Course") and days[0] == (0, "Early Course")
    assert days[30][1] == "Early Course" and days[31][1] == "Mid Course" and days[180][1] == "Mid Course"
    assert days[181][1] == days[300][1] == "Late / Assessment Phase" and days[7][0] == 1


def test_student_dimension_has_one_row_per_student(spark, rows):
    tables = changed(clean_course(), "student_info", 2, age_band="35-55")
    mart = mart_of(spark, tables)
    got = rows(mart.dim_student, "id_student", "age_band", "demographics_from_presentation", "age_band_changed_over_time")
    assert got == [(1, "35-55", "2014J", True), (2, "35-55", "2014J", False), (3, "55<=", "2014J", False)]
    assert mart.dim_demographics.count() == 6
    assert mart.dim_enrolment.count() == 6


def test_facts_do_not_fan_out(spark):
    """A student in three presentations: joining the enrolments on the student alone would triple the clicks."""
    tables = clean_course()
    mart = mart_of(spark, tables)
    facts = mart.fact_vle_interactions
    assert facts.count() == 6 == mart.clean["student_vle"].count()
    clicks = facts.agg(F.sum("sum_click")).first()[0]
    assert clicks == sum(int(row[5]) for row in tables["student_vle"])
    naive = facts.join(mart.dim_enrolment.select("id_student"), "id_student")
    assert naive.count() > 2 * facts.count()
    assert mart.fact_assessments.count() == 5
    assert {row["test_result"] for row in mart_tests(mart.fact_assessments, facts).collect()} == {"PASS"}
    fanned = mart_tests(mart.fact_assessments, naive).filter("test_type = 'UNIQUENESS' and test_result = 'FAIL'")
    assert [row["table_name"] for row in fanned.collect()] == ["fact_vle_interactions"]


def test_gates(spark, rows):
    tables = clean_course()
    for row in (
        ("BBB", "2014J", "99", "102", "0", "1"),  # unknown student
        ("CCC", "2014J", "1", "102", "0", "1"),  # unknown presentation
        ("BBB", "2014J", "1", "102", "-31", "1"),  # before the calendar
        ("BBB", "2014J", "1", "102", "301", "1"),  # after it
        ("BBB", "2014J", "1", "777", "1", "1"),  # unknown site: kept, without an activity
    ):
        tables = added(tables, "student_vle", row)
    facts = mart_of(spark, tables).fact_vle_interactions
    assert facts.count() == 7
    assert rows(facts.filter("activity_type is null"), "id_site") == [(777,)]


def test_submissions(spark, rows):
    tables = changed(clean_course(), "student_assessment", 0, score="1000")
    facts = mart_of(spark, tables).fact_assessments
    got = rows(facts, "id_assessment", "id_student", "score", "submission_delay", "is_banked")
    assert [(a, s, None if v is None else float(v), d, b) for a, s, v, d, b in got] == [
        (10, 1, None, -1, False), (11, 1, 80.0, 6, False), (11, 2, 55.0, 0, True),
        (13, 1, 90.0, 0, False), (13, 3, 65.5, -1, False),
    ]
    # The undated exam is gone: its submission has no day.
    assert not_null_test(facts, "fact_assessments", "date").first()["failed_rows"] == 0


def test_engagement_keeps_students_without_clicks(spark):
    tables = added(
        clean_course(),
        "student_info",
        ("BBB", "2014J", "4", "M", "Wales", "HE Qualification", "0-10%", "0-35", "0", "60", "N", "Withdrawn"),
    )
    mart = mart_of(spark, tables)
    got = r.engagement_vs_performance(mart.dim_enrolment, mart.fact_vle_interactions, mart.fact_assessments).collect()
    assert sum(row["student_count"] for row in got) == 7
    first = {row["final_result"]: row for row in got if row["engagement_quartile"] == 1}
    # Students 3 and 4 of BBB 2014J have no clicks; 3 comes first by number, 4 takes the second quartile.
    assert first["Pass"]["avg_total_clicks"] == 2.0 and "Withdrawn" in first
    second = {row["final_result"]: row for row in got if row["engagement_quartile"] == 2}
    assert second["Withdrawn"]["avg_total_clicks"] == 0.0 and second["Withdrawn"]["withdrawal_rate_pct"] == 100.0


def test_withdrawal_bins(spark, rows):
    df = spark.createDataFrame(
        [("Withdrawn", True, -1), ("Withdrawn", True, 0), ("Withdrawn", True, 89), ("Pass", False, 3), ("Withdrawn", True, None)],
        "final_result string, is_withdrawn boolean, date_unregistration int",
    )
    assert rows(r.withdrawal_bins(df)) == [(-90, -1, "-90 to -1", 1), (0, 89, "0 to 89", 2)]


def test_activity_trend_ties_and_other(spark, rows):
    mart = mart_of(spark, clean_course())
    got = rows(r.activity_trend(mart.fact_vle_interactions, mart.dim_date, mart.dim_enrolment))
    # forumng 12 clicks, quiz 9; resource (7) and homepage (4) are folded.
    assert {row[3] for row in got} == {"forumng", "quiz", "Other"}
    assert ("Early Course", 0, "Pass", "Other", 1, 4, 4.0) in got
    assert ("Pre-Course", -1, "Withdrawn", "forumng", 1, 5, 5.0) in got


def test_risk_factors(spark):
    data = [(i, "Withdrawn" if i % 4 == 0 else "Pass", "Y" if i < 100 else "N", None) for i in range(300)]
    df = spark.createDataFrame(data, "id_student int, final_result string, disability string, age_band string")
    factors = {"Disability": "disability", "Age Band": "age_band"}
    got = {(x["risk_factor"], x["factor_value"]): x for x in r.risk_factors(df, factors).collect()}
    assert got["Age Band", "Unknown"]["total_students"] == 300 and got["Disability", "Y"]["baseline_risk_pct"] == 25.0
    # Two enrolments of one student: the rate per student passes 100 %, the rate per enrolment cannot.
    twice = df.union(df).withColumn("final_result", F.lit("Fail"))
    per_student = r.risk_factors(twice, factors, denominator="students").collect()
    assert {x["risk_rate_pct"] for x in per_student} == {200.0}
    assert {x["risk_rate_pct"] for x in r.risk_factors(twice, factors).collect()} == {100.0}
    assert r.risk_factors(df, factors, minimum=101).filter("factor_value = 'Y'").isEmpty()


@pytest.mark.parametrize(
    ("rate", "label"),
    [(30.0, "HIGH RISK"), (29.9, "ELEVATED RISK"), (25.0, "ELEVATED RISK"), (24.9, "AVERAGE RISK"),
     (15.1, "AVERAGE RISK"), (15.0, "LOW RISK")],
)
def test_risk_category(spark, rate, label):
    assert spark.range(1).select(r.risk_category(F.lit(rate), F.lit(20.0))).first()[0] == label


def test_risk_score_and_backtest(spark):
    clean = t.clean_all(frames(spark, clean_course()))
    scored = r.risk_score(clean["student_info"])
    got = {(x["code_presentation"], x["id_student"]): x for x in scored.collect()}
    worst = got["2013J", 2]
    assert (worst["risk_score"], worst["risk_band"]) == (5, "3. high")
    assert worst["risk_reasons"] == [
        "credit load 121 to 240", "most deprived two bands", "below A level on entry", "disability declared",
    ]
    assert got["2013B", 1]["risk_score"] == 1
    bands = {x["risk_band"]: x for x in r.risk_backtest(scored).collect()}
    assert bands["3. high"]["enrolments"] == 2 and bands["3. high"]["pct_of_cohort"] == 33.3


def test_missing_credits_count_as_the_smallest_band(spark, rows):
    tables = changed(clean_course(), "student_info", 0, studied_credits="?")
    info = t.clean_all(frames(spark, tables))["student_info"]
    assert rows(info.filter("studied_credits is null"), "credit_load_band") == [("60 or less",)]


def test_rejected_rows_stay_but_are_not_reported(spark):
    tables = changed(clean_course(), "student_info", 0, id_student="?")
    info = t.clean_all(frames(spark, tables))["student_info"]
    header = r.trust_header(info).first()
    assert (header["rows_in_clean"], header["rows_rejected"], header["rows_usable_by_mart"]) == (6, 1, 5)
    assert sum(x["enrolments"] for x in r.outcome_share(info).collect()) == 5
    assert {x["dq_status"]: x["rows_in_table"] for x in q.row_status(info).collect()}["REJECT"] == 1


RESULTS = [
    ("clean", "a", "A1", "NULL", "Completeness", 0.0, 10, 0, 0.0, "PASS"),
    ("clean", "a", "A2", "RANGE", "Validity", 5.0, 10, 1, 10.0, "FAIL"),
    ("clean", "b", "B1", "RANGE", "Validity", 20.0, 10, 1, 10.0, "WARN"),
]


def results(spark, rows=RESULTS):
    names = "layer string, table_name string, check_id string, check_type string, dq_dimension string, threshold double, total_count long, fail_count long, fail_pct double, status string"
    df = spark.createDataFrame(rows, names)
    text = {c: F.lit("x") for c in ("check_name", "column_name", "expectation", "severity", "business_question", "owner")}
    return df.withColumns({**text, "executed_at": F.current_timestamp()})


@pytest.mark.parametrize(
    ("kept", "verdict"),
    [(3, "DO NOT SHIP"), (1, "HEALTHY"), (0, "HEALTHY")],
)
def test_health(spark, kept, verdict):
    row = q.health(results(spark, RESULTS[:kept])).first()
    assert row["overall_health"] == verdict and row["checks_run"] == kept


def test_health_with_warnings_only(spark):
    row = q.health(results(spark, [RESULTS[0], RESULTS[2]])).first()
    assert (row["overall_health"], row["pass_rate_pct"], row["tables_reporting"]) == ("USABLE, READ THE FLAGS", 50.0, 2)


def test_coverage_lists_tables_that_never_ran(spark, rows):
    got = rows(q.coverage(results(spark), ["a", "b", "c"]), "table_name", "checks_run", "failed", "coverage")
    assert got == [("a", 2, 1, "reported"), ("b", 1, 0, "reported"), ("c", 0, 0, "NEVER RUN")]


def test_result_reports(spark, rows):
    df = results(spark)
    assert [x["check_type"] for x in q.by_type(df).collect()] == ["RANGE", "NULL"]
    assert rows(q.by_dimension(df), "dq_dimension", "checks", "failed") == [("Completeness", 1, 0), ("Validity", 2, 1)]
    assert rows(q.by_type_and_status(df)) == [("NULL", "PASS", 1), ("RANGE", "FAIL", 1), ("RANGE", "WARN", 1)]
    assert rows(q.by_table(df), "table_name", "critical_failures", "warnings") == [("a", 1, 0), ("b", 0, 1)]
    assert rows(q.critical(df), "check_id") == [("A2",)]
    assert [(x["check_id"], x["headroom_pct"]) for x in q.headroom(df).collect()] == [("B1", 10.0), ("A2", -5.0)]
    assert [x["check_id"] for x in q.full_results(df).collect()] == ["A1", "A2", "B1"]


def test_flag_reports(spark, rows):
    tables = changed(clean_course(), "student_info", 5, imd_band="90-100", studied_credits="300")
    info = t.clean_all(frames(spark, tables))["student_info"]
    assert rows(q.flags_fired(info), "flag", "rows_flagged", "pct_of_table") == [
        ("imd_band label repaired", 1, 16.67), ("studied_credits above 240", 1, 16.67),
    ]
    sample = q.failing_sample(info, ["id_student", "studied_credits", "enrolment_key"], "studied_credits", "enrolment_key")
    assert rows(sample, "id_student", "dq_status") == [(3, "WARN")]
    assert rows(q.flag_grid(info), "code_presentation", "rows_flagged", "pct_flagged") == [
        ("2013B", 0, 0.0), ("2013J", 0, 0.0), ("2014J", 1, 33.3),
    ]


def test_checks_cover_all_tables():
    assert set(CHECKS) == set(t.RAW_COLUMNS) == set(t.RAW_FILES)


def test_bucketed_facts_meet_their_enrolments_without_an_exchange(spark, tmp_path, rows):
    mart = mart_of(spark, clean_course())
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/bucketed'")
    try:
        write_bucketed(mart.fact_vle_interactions, "bucketed.facts", t.ENROLMENT, 4)
        write_bucketed(mart.dim_enrolment, "bucketed.enrolments", t.ENROLMENT, 4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        facts, enrolments = spark.table("bucketed.facts"), spark.table("bucketed.enrolments")
        met = r.engagement_per_enrolment(facts).join(enrolments, list(t.ENROLMENT))
        assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
        trend = r.activity_trend(facts, mart.dim_date, enrolments)
        # Only the days and the cells of the report are dealt anew.
        assert "hashpartitioning(code_module" not in trend._jdf.queryExecution().executedPlan().toString()
        assert rows(trend) == rows(r.activity_trend(mart.fact_vle_interactions, mart.dim_date, mart.dim_enrolment))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_interactions_are_dealt_to_tasks_by_their_rows(spark, monkeypatch):
    """Raw against clean and the mart's unique tests hold a task's share of the keys, whatever the size of the table."""
    from suite import course_queries
    from tierflow.sources import tables

    folder = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    monkeypatch.setattr(tables, "BUCKET_ROWS", 500)
    tasks = -(-lines // 500)
    for name in ("raw_vs_clean", "dq_mart"):
        plan = getattr(course_queries, name)(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        assert "id_site#" in plan and f", {tasks}" in plan and "RepartitionByExpression" in plan, name
    assert "Expand" not in course_queries.raw_vs_clean(spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_raw_vs_clean_counts_missing_values(spark):
    from tierflow.plans.course_reports import raw_vs_clean
    from tierflow.plans.course_tables import merge_student_vle

    rows = [("AAA", "2013J", 1, 5, 0, 3), ("AAA", "2013J", 1, 5, 0, 4), ("AAA", "2013J", None, 5, 0, None), (None, None, 2, None, 1, 1)]
    raw = spark.createDataFrame(rows, "code_module string, code_presentation string, id_student int, id_site int, date int, sum_click int")
    found = {r.table_name: tuple(r)[:4] for r in raw_vs_clean(raw, merge_student_vle(raw)).collect()}
    assert found == {"Raw Table": (4, 3, 2, 8), "Clean Table": (3, 3, 2, 8)}
    empty = raw_vs_clean(raw.limit(0), raw.limit(0)).first()
    assert tuple(empty)[:4] == (0, 0, 0, None)
