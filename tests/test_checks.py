"""Each of the 104 checks passes on clean data and fires on the fault it is there for."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.course_data import added, changed, clean_course, frames
from tierflow.operators.checks import (
    RESULT_SCHEMA,
    Check,
    CheckedTable,
    FailWhen,
    Orphans,
    Repeats,
    failing_rows,
    run_checks,
    status_of,
    unique_test,
)
from tierflow.plans.course_checks import CHECKS, checked, tables_read
from tierflow.plans.course_tables import CLEANERS, clean_all

# Checks that see something on the clean set: unregistered students, open-ended resources, few rows, repeats.
SEEN_ON_CLEAN = {"REG_04": 1, "VLE_09": 1, "INF_25": 1, "SVL_11": 1}


def run(spark, tables, name):
    raw = frames(spark, {table: tables[table] for table in tables_read(name)})
    return {r["check_id"]: r for r in run_checks([checked(name, clean_all(raw), raw)]).collect()}


def test_there_are_104_checks_of_known_kinds():
    listed = [check for checks in CHECKS.values() for check in checks]
    kinds = {}
    for check in listed:
        kinds[check.check_type] = kinds.get(check.check_type, 0) + 1
    assert len(listed) == len({check.check_id for check in listed}) == 104
    assert kinds == {
        "NULL": 31, "ACCEPTED VALUES": 18, "RANGE": 16, "UNIQUE": 15, "SCHEMA": 9, "VOLUME": 8, "REFERENTIAL INTEGRITY": 7,
    }
    dimensions = {}
    for check in listed:
        dimensions[check.dq_dimension] = dimensions.get(check.dq_dimension, 0) + 1
    assert dimensions == {
        "Completeness": 38, "Validity": 36, "Uniqueness": 13, "Referential integrity": 7, "Consistency": 5, "Accuracy": 5,
    }
    assert sum(check.severity == "WARN" for check in listed) == 17


@pytest.mark.parametrize("name", list(CHECKS))
def test_clean_data(spark, name):
    got = run(spark, clean_course(), name)
    assert {cid: r["fail_count"] for cid, r in got.items() if r["fail_count"]} == {
        cid: n for cid, n in SEEN_ON_CLEAN.items() if cid in got
    }
    assert len(got) == len(CHECKS[name])


INFO_ROW = clean_course()["student_info"][0]

# Per table: rows that differ from the clean set, and the checks that must count them (with how many).
FAULTS = {
    "assessments": [
        (lambda t: changed(t, "assessments", 0, id_assessment="?"), {"ASM_01": 1, "ASM_11": 1}),
        (lambda t: added(t, "assessments", ("AAA", "2013B", "10", "TMA", "20", "10")), {"ASM_02": 1}),
        (lambda t: changed(t, "assessments", 0, assessment_type=""), {"ASM_03": 1}),
        (lambda t: changed(t, "assessments", 0, assessment_type="Quiz"), {"ASM_04": 1}),
        (lambda t: changed(t, "assessments", 0, code_module="HHH"), {"ASM_05": 1, "ASM_13": 1}),
        (lambda t: changed(t, "assessments", 0, code_presentation="2013BX"), {"ASM_06": 1, "ASM_13": 1}),
        (lambda t: changed(t, "assessments", 0, weight="100.5"), {"ASM_07": 1}),
        (lambda t: changed(t, "assessments", 0, weight="?"), {"ASM_08": 1}),
        (lambda t: changed(t, "assessments", 0, date="0"), {"ASM_09": 1}),
        (lambda t: changed(t, "assessments", 0, date="?"), {"ASM_10": 1}),
        (lambda t: changed(t, "assessments", 0, date="12.5"), {"ASM_10": 1, "ASM_11": 1}),
        (lambda t: added(t, "assessments", t["assessments"][4]), {"ASM_02": 1, "ASM_12": 1}),
    ],
    "courses": [
        (lambda t: changed(t, "courses", 0, code_module=" "), {"CRS_01": 1}),
        (lambda t: changed(t, "courses", 0, code_presentation="?"), {"CRS_02": 1}),
        (lambda t: changed(t, "courses", 0, module_presentation_length=""), {"CRS_03": 1}),
        (lambda t: changed(t, "courses", 0, module_presentation_length="0"), {"CRS_04": 1, "CRS_05": 1}),
        (lambda t: changed(t, "courses", 0, module_presentation_length="271"), {"CRS_05": 1}),
        (lambda t: changed(t, "courses", 0, code_module="HHH"), {"CRS_06": 1}),
        (lambda t: changed(t, "courses", 0, code_presentation="2013"), {"CRS_07": 1}),
        (lambda t: added(t, "courses", (" aaa", "2013b", "260")), {"CRS_08": 1}),
        (lambda t: changed(t, "courses", 0, module_presentation_length="1e3"), {"CRS_03": 1, "CRS_09": 1}),
    ],
    "student_assessment": [
        (lambda t: changed(t, "student_assessment", 0, id_student=""), {"SAS_01": 1}),
        (lambda t: changed(t, "student_assessment", 0, id_assessment=""), {"SAS_02": 1, "SAS_10": 1}),
        (lambda t: changed(t, "student_assessment", 0, date_submitted=""), {"SAS_03": 1}),
        (lambda t: added(t, "student_assessment", ("10", "1", "19", "0", "70")), {"SAS_04": 1}),
        (lambda t: changed(t, "student_assessment", 0, score="-1"), {"SAS_05": 1}),
        (lambda t: changed(t, "student_assessment", 0, is_banked="2"), {"SAS_06": 1}),
        (lambda t: changed(t, "student_assessment", 0, is_banked="?"), {"SAS_06": 1}),
        (lambda t: changed(t, "student_assessment", 0, score="?"), {"SAS_07": 1}),
        (lambda t: changed(t, "student_assessment", 0, date_submitted="?"), {"SAS_03": 1, "SAS_08": 1}),
        (lambda t: added(t, "student_assessment", ("10", "1", "18", "0", "70")), {"SAS_04": 1, "SAS_09": 1}),
        (lambda t: changed(t, "student_assessment", 0, id_assessment="99"), {"SAS_10": 1}),
    ],
    "student_info": [
        (lambda t: changed(t, "student_info", 0, imd_band="?"), {"INF_01": 1, "INF_22": 1}),
        (lambda t: changed(t, "student_info", 0, region=""), {"INF_02": 1, "INF_22": 1}),
        (lambda t: changed(t, "student_info", 0, final_result="?"), {"INF_03": 1}),
        (lambda t: changed(t, "student_info", 0, id_student="?"), {"INF_04": 1, "INF_22": 1}),
        (lambda t: changed(t, "student_info", 0, code_module="?"), {"INF_05": 1, "INF_23": 1}),
        (lambda t: changed(t, "student_info", 0, final_result="Passed"), {"INF_06": 1}),
        (lambda t: changed(t, "student_info", 5, gender="X"), {"INF_07": 1}),
        (lambda t: changed(t, "student_info", 5, age_band="55+"), {"INF_08": 1}),
        (lambda t: changed(t, "student_info", 5, disability="U"), {"INF_09": 1}),
        (lambda t: changed(t, "student_info", 5, imd_band="90-100"), {"INF_10": 1}),
        (lambda t: changed(t, "student_info", 0, studied_credits="0"), {"INF_12": 1}),
        (lambda t: changed(t, "student_info", 0, num_of_prev_attempts="-1"), {"INF_13": 1}),
        (lambda t: changed(t, "student_info", 0, studied_credits="241"), {"INF_14": 1}),
        (lambda t: changed(t, "student_info", 0, num_of_prev_attempts="3"), {"INF_15": 1}),
        (lambda t: changed(t, "student_info", 0, id_student="1a"), {"INF_04": 1, "INF_16": 1, "INF_22": 1}),
        (lambda t: changed(t, "student_info", 0, studied_credits="many"), {"INF_17": 1}),
        (
            lambda t: added(t, "student_info", (*INFO_ROW[:8], "4", *INFO_ROW[9:])),
            {"INF_15": 1, "INF_18": 1, "INF_19": 1},
        ),
        (lambda t: added(t, "student_info", INFO_ROW), {"INF_18": 1, "INF_19": 1, "INF_20": 1}),
        (lambda t: changed(t, "student_info", 0, age_band="35-55"), {"INF_21": 3, "INF_22": 1}),
        (lambda t: changed(t, "student_info", 0, code_module="CCC"), {"INF_23": 1}),
    ],
    "student_registration": [
        (lambda t: changed(t, "student_registration", 0, id_student="?"), {"REG_01": 1}),
        (lambda t: changed(t, "student_registration", 0, code_presentation=""), {"REG_02": 1, "REG_14": 1}),
        (lambda t: changed(t, "student_registration", 0, date_registration="?"), {"REG_03": 1}),
        (lambda t: changed(t, "student_registration", 0, date_unregistration="9"), {"REG_04": 2}),
        (lambda t: changed(t, "student_registration", 0, code_presentation="2013BX"), {"REG_05": 1, "REG_14": 1}),
        (lambda t: changed(t, "student_registration", 0, code_module="HH"), {"REG_06": 1, "REG_14": 1}),
        (lambda t: changed(t, "student_registration", 0, date_registration="-366"), {"REG_07": 1}),
        (lambda t: changed(t, "student_registration", 0, date_registration="121"), {"REG_07": 1}),
        (lambda t: changed(t, "student_registration", 1, date_unregistration="-21"), {"REG_08": 1}),
        (lambda t: changed(t, "student_registration", 0, id_student="x"), {"REG_01": 1, "REG_09": 1}),
        (lambda t: changed(t, "student_registration", 0, date_registration="x"), {"REG_03": 1, "REG_10": 1}),
        (lambda t: added(t, "student_registration", ("AAA", "2013B", "1", "-19", "?")), {"REG_11": 1}),
        (
            lambda t: added(t, "student_registration", t["student_registration"][0]),
            {"REG_11": 1, "REG_12": 1},
        ),
        (
            lambda t: {
                **t,
                "student_registration": [
                    (m, p, "1", str(-i), "?") for i, (m, p, *_) in enumerate(t["student_registration"][:4])
                ],
            },
            {"REG_11": 1, "REG_13": 4, "REG_04": 0},
        ),
        (lambda t: changed(t, "student_registration", 0, code_module="CCC"), {"REG_14": 1}),
    ],
    "student_vle": [
        (lambda t: changed(t, "student_vle", 0, code_module="?"), {"SVL_01": 1, "SVL_14": 1}),
        (lambda t: changed(t, "student_vle", 0, code_presentation=""), {"SVL_02": 1, "SVL_14": 1}),
        (lambda t: changed(t, "student_vle", 0, id_student="?"), {"SVL_03": 1}),
        (lambda t: changed(t, "student_vle", 0, id_site="?"), {"SVL_04": 1, "SVL_13": 1}),
        (lambda t: changed(t, "student_vle", 0, date="?"), {"SVL_05": 1}),
        (lambda t: changed(t, "student_vle", 0, sum_click="?"), {"SVL_06": 1}),
        (lambda t: changed(t, "student_vle", 0, sum_click="-1"), {"SVL_07": 1}),
        (lambda t: changed(t, "student_vle", 0, sum_click="0"), {"SVL_08": 1}),
        (lambda t: changed(t, "student_vle", 0, code_module="HHH"), {"SVL_09": 1, "SVL_14": 1}),
        (lambda t: changed(t, "student_vle", 0, code_presentation="13B"), {"SVL_10": 1, "SVL_14": 1}),
        (lambda t: changed(t, "student_vle", 0, sum_click="4.5"), {"SVL_06": 1, "SVL_12": 1}),
        (lambda t: changed(t, "student_vle", 0, id_site="999"), {"SVL_13": 1}),
        (lambda t: changed(t, "student_vle", 0, code_presentation="2014J"), {"SVL_14": 1}),
    ],
    "vle": [
        (lambda t: changed(t, "vle", 0, id_site="?"), {"VLE_01": 1}),
        (lambda t: changed(t, "vle", 0, code_module=""), {"VLE_02": 1, "VLE_13": 1}),
        (lambda t: changed(t, "vle", 0, code_presentation="?"), {"VLE_03": 1, "VLE_13": 1}),
        (lambda t: changed(t, "vle", 0, activity_type=" "), {"VLE_04": 1}),
        (lambda t: changed(t, "vle", 1, id_site="100"), {"VLE_05": 1}),
        (lambda t: changed(t, "vle", 1, week_from="-1"), {"VLE_06": 1}),
        (lambda t: changed(t, "vle", 1, week_to="-1"), {"VLE_07": 1, "VLE_08": 1}),
        (lambda t: changed(t, "vle", 1, week_from="3"), {"VLE_08": 1}),
        (lambda t: changed(t, "vle", 1, week_to="?"), {"VLE_09": 2}),
        (lambda t: changed(t, "vle", 0, code_module="HHH"), {"VLE_10": 1, "VLE_13": 1}),
        (lambda t: changed(t, "vle", 0, code_presentation="2013"), {"VLE_11": 1, "VLE_13": 1}),
        (lambda t: changed(t, "vle", 1, week_from="x"), {"VLE_09": 2, "VLE_12": 1}),
        (lambda t: changed(t, "vle", 0, code_presentation="2013J"), {}),
    ],
}

# Checks no fault in the raw files can fire: they guard the cleaning itself (tested below).
GUARDS = {"ASM_14", "CRS_10", "SAS_11", "INF_11", "INF_24", "REG_15", "SVL_15", "VLE_14", "INF_25", "SVL_11"}


def test_every_check_has_a_fault():
    fired = {cid for faults in FAULTS.values() for _, expected in faults for cid in expected}
    assert {check.check_id for checks in CHECKS.values() for check in checks} == fired | GUARDS


@pytest.mark.parametrize("name", list(FAULTS))
def test_faults_fire_exactly_their_checks(spark, name):
    quiet = {cid: n for cid, n in SEEN_ON_CLEAN.items() if cid[:3] == CHECKS[name][0].check_id[:3]}

    def counted(fault):
        got = run(spark, fault(clean_course()), name)
        return {cid: r["fail_count"] for cid, r in got.items() if r["fail_count"]}

    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(counted, [fault for fault, _ in FAULTS[name]]))
    expected = [{cid: n for cid, n in {**quiet, **fires}.items() if n} for _, fires in FAULTS[name]]
    assert found == expected


def test_interaction_guards(spark):
    """Repeats are counted on the raw rows; the merge keeps every click, and a merge that does not is caught."""
    tables = clean_course()
    got = run(spark, tables, "student_vle")
    assert (got["SVL_11"]["total_count"], got["SVL_11"]["fail_count"], got["SVL_11"]["status"]) == (7, 1, "WARN")
    assert got["SVL_15"]["status"] == "PASS"
    raw = frames(spark, tables)
    clean = clean_all(raw)
    lossy = {**clean, "student_vle": clean["student_vle"].filter("sum_click < 9")}
    broken = {r["check_id"]: r for r in run_checks([checked("student_vle", lossy, raw)]).collect()}
    assert (broken["SVL_15"]["fail_count"], broken["SVL_15"]["status"]) == (9, "FAIL")


def test_volume_and_sentinel_guards(spark):
    raw = frames(spark, clean_course())
    clean = clean_all(raw)
    info = clean["student_info"]
    broken = {
        **{name: df.limit(1) for name, df in clean.items()},
        "student_info": info.withColumn("imd_band", F.lit("?")).limit(4),
    }
    names = [name for name in CHECKS if name != "student_vle"]
    got = {r["check_id"]: r["fail_count"] for r in run_checks([checked(n, broken, raw) for n in names]).collect()}
    expected = {"ASM_14": 4, "CRS_10": 2, "SAS_11": 5, "INF_24": 2, "REG_15": 5, "VLE_14": 3, "INF_11": 4, "INF_25": 1}
    assert {cid: got[cid] for cid in expected} == expected


def test_uniqueness_treats_missing_values_as_values(spark):
    rows = [("AAA", None, None), ("AAA", None, None), ("AAA", "2013J", None)]
    df = spark.createDataFrame(rows, "m string, p string, d string")
    table = CheckedTable("t", df, [Check("U", "u", "UNIQUE", "", "", "", Repeats(("m", "p", "d")))])
    assert run_checks([table]).first()["fail_count"] == 1
    # The key form that drops rows with a missing part would report three.
    assert df.agg(F.count(F.lit(1)) - F.count_distinct("m", "p", "d")).first()[0] == 3


def test_status_rule(spark):
    cases = [
        (10, 0, 0.0, "FAIL", "PASS"),
        (10, 1, 0.0, "FAIL", "FAIL"),
        (10, 1, 10.0, "FAIL", "WARN"),
        (10, 2, 10.0, "FAIL", "FAIL"),
        (10, 2, 10.0, "WARN", "WARN"),
        (0, 1, 0.0, "FAIL", "WARN"),
        (0, 0, 0.0, "FAIL", "PASS"),
        (100000, 201, 0.2, "FAIL", "FAIL"),
        (100000, 200, 0.2, "FAIL", "WARN"),
    ]
    df = spark.createDataFrame(cases, "t long, f long, thr double, sev string, want string")
    got = df.select(status_of(F.col("t"), F.col("f"), F.col("thr"), F.col("sev")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_empty_table(spark):
    tables = {name: [] for name in clean_course()}
    got = run(spark, tables, "student_info")
    assert got["INF_01"]["total_count"] == 0 and got["INF_01"]["fail_pct"] is None
    assert {cid for cid, r in got.items() if r["status"] != "PASS"} == {"INF_25"}
    assert got["INF_25"]["status"] == "WARN"


def test_result_shape(spark):
    raw = frames(spark, clean_course())
    results = run_checks([checked("courses", clean_all(raw), raw, owner="someone")])
    assert [(f.name, f.dataType) for f in results.schema] == [(f.name, f.dataType) for f in RESULT_SCHEMA]
    assert {r["owner"] for r in results.collect()} == {"someone"}


def test_scans_do_not_grow_with_the_checks(spark, tmp_path):
    """25 checks of one table: two scans of the clean table and one of the raw one, beside the parent lookup."""
    raw = frames(spark, clean_course())
    stored = {}
    for layer, tables in (("raw", raw), ("clean", clean_all(raw))):
        for name in ("student_info", "courses"):
            path = str(tmp_path / layer / name)
            tables[name].write.parquet(path)
            stored[layer, name] = spark.read.parquet(path)
    table = CheckedTable(
        "student_info", stored["clean", "student_info"], CHECKS["student_info"], stored["raw", "student_info"],
        {"courses": stored["clean", "courses"]},
    )
    scans = run_checks([table])._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans == 5


def test_rows_behind_a_check(spark):
    tables = added(clean_course(), "student_info", INFO_ROW)
    tables = changed(tables, "student_info", 5, code_module="CCC", studied_credits="lots")
    raw = frames(spark, tables)
    table = checked("student_info", clean_all(raw), raw)
    assert failing_rows(table, "INF_23").count() == 1
    assert failing_rows(table, "INF_17").count() == 1
    assert failing_rows(table, "INF_20").count() == 2
    registration = [(m, p, "1", str(-i), "?") for i, (m, p, *_) in enumerate(tables["student_registration"][:4])]
    raw = frames(spark, {**tables, "student_registration": registration})
    assert failing_rows(checked("student_registration", clean_all(raw), raw), "REG_13").count() == 4
    with pytest.raises(ValueError):
        failing_rows(table, "INF_24")


def test_checks_need_the_tables_they_read(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        run_checks([CheckedTable("t", df, [Check("A", "a", "", "", "", "", FailWhen("id = 0", on="raw"))])])
    with pytest.raises(KeyError):
        run_checks([CheckedTable("t", df, [Check("A", "a", "", "", "", "", Orphans("p", ("id",)))])])


def test_unique_test_counts_keys_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    row = unique_test(df, "t", ("k",)).first()
    assert (row["total_rows"], row["failed_rows"], row["test_result"]) == (4, 1, "FAIL")


def test_all_cleaners_are_checked():
    assert set(CHECKS) == set(CLEANERS)


def test_clean_tables_are_made_from_the_stored_raw_ones(spark, monkeypatch):
    """Each raw table is derived once, not a second time below the clean one."""
    from suite import course_queries

    derived = []

    def counted(spark, folder, names):
        derived.extend(names)
        return raw_course(spark, folder, names)

    raw_course = course_queries.raw_course
    monkeypatch.setattr(course_queries, "raw_course", counted)
    for kept in (course_queries._plan, course_queries._stored_path):
        kept.cache_clear()
    course_queries._stored_layers(spark, "/root/testdata/sf0.001", ["student_registration"])
    assert sorted(derived) == ["courses", "student_registration"]
