"""Checks over parts of a table give what a run over the whole table gives."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.course_data import added, changed, clean_course, frames
from tierflow.operators.check_state import add_part, remove_part, stored_results
from tierflow.operators.checks import Check, CheckedTable, Collapses, CountBetween, Orphans, Repeats, Spread, run_checks
from tierflow.operators.history import append_run, newest_first
from tierflow.plans.course_checks import CHECKS, checked, tables_read
from tierflow.plans.course_tables import clean_all

# A column that tells the parts of a table apart.
SPLIT = {"student_assessment": "id_student"}


def faulty():
    """Faults that only show when parts meet: repeats, versions, spread, orphans, missing keys."""
    tables = clean_course()
    tables = added(tables, "student_info", ("AAA", "2013J", "1", "F", "Wales", "HE Qualification", "20-30%", "35-55", "0", "60", "N", "Pass"))
    tables = added(tables, "student_info", ("BBB", "2014J", "?", "F", "?", "HE Qualification", "?", "35-55", "0", "60", "N", "Pass"))
    tables = added(tables, "student_info", ("CCC", "2014J", "?", "F", "?", "HE Qualification", "?", "35-55", "0", "x", "N", "Pass"))
    for day in ("-1", "-2", "-3", "-4"):
        tables = added(tables, "student_registration", ("AAA", "2013B" if day < "-2" else "2013J", "1", day, "?"))
    tables = added(tables, "student_vle", ("AAA", "2013B", "9", "999", "5", "x"))
    tables = added(tables, "vle", ("100", "AAA", "2013J", "homepage", "?", "?"))
    tables = added(tables, "courses", ("AAA", "2013B", "269"))
    return changed(tables, "assessments", 0, code_presentation="?")


def results(df):
    return {(r["table_name"], r["check_id"]): (r["total_count"], r["fail_count"], r["status"], r["expectation"], r["fail_pct"]) for r in df.collect()}


def halves(table):
    """The table in two parts, by one column."""
    column = SPLIT.get(table.name, "code_presentation")
    first = F.coalesce(F.pmod(F.crc32(F.trim(F.col(column).cast("string")).cast("binary")), F.lit(2)) == 0, F.lit(False))
    return [replace(table, clean=table.clean.where(side), raw=table.raw.where(side)) for side in (first, ~first)]


@pytest.mark.parametrize("name", list(CHECKS))
def test_parts_give_the_whole(spark, tmp_path, name):
    tables = faulty()
    raw = frames(spark, {table: tables[table] for table in tables_read(name)})
    # The cleaned table is written: some of its columns look at all rows.
    clean = {}
    for table, df in clean_all(raw).items():
        df.write.parquet(str(tmp_path / table))
        clean[table] = spark.read.parquet(str(tmp_path / table))
    whole, state = checked(name, clean, raw), str(tmp_path / "state")
    for part, rows in zip("ab", halves(whole), strict=True):
        add_part(rows, part, state)
    assert results(stored_results(spark, state, [whole])) == results(run_checks([whole]))


def test_an_added_part_is_read_alone(spark, tmp_path):
    paths = [str(tmp_path / name) for name in "abc"]
    for path, data in zip(paths, ([(1, "x", 1), (2, "y", 1)], [(1, "x", 2), (None, "z", 2)], [(3, None, 3), (3, None, 3)]), strict=True):
        spark.createDataFrame(data, "k int, v string, p int").coalesce(1).write.parquet(path)
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    rules = {"R": Repeats(("k", "v")), "C": Collapses("k", ("p",)), "S": Spread("k", "p", 1), "O": Orphans("parent", ("k",)), "N": CountBetween(5, 9)}
    checks = [Check(cid, cid, "", "", "", "", rule) for cid, rule in rules.items()]

    def table(*read):
        return CheckedTable("t", spark.read.parquet(*read), checks, parents={"parent": parent})

    state = str(tmp_path / "state")
    for path in paths[:2]:
        add_part(table(path), path[-1], state)
    assert results(stored_results(spark, state, [table(paths[0])])) == results(run_checks([table(*paths[:2])]))
    add_part(table(paths[2]), "c", state)
    stored = stored_results(spark, state, [table(paths[0])])
    assert all("/state/" in file for file in stored.inputFiles())
    assert results(stored) == results(run_checks([table(*paths)]))
    add_part(table(paths[2]), "c", state)  # a part that is added again counts once
    assert results(stored_results(spark, state, [table(paths[0])])) == results(run_checks([table(*paths)]))
    remove_part(spark, "t", "a", state)
    assert results(stored_results(spark, state, [table(paths[0])])) == results(run_checks([table(*paths[1:])]))


def test_parents_are_those_of_the_moment(spark, tmp_path):
    child, state = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"), str(tmp_path / "state")
    checks = [Check("O", "O", "", "", "", "", Orphans("parent", ("k",)))]
    for keys, lost in [([(1,)], 3), ([(1,), (2,)], 1), ([], 4)]:
        table = CheckedTable("t", child, checks, parents={"parent": spark.createDataFrame(keys, "k int")})
        if keys == [(1,)]:
            add_part(table, "only", state)
        assert [(r["total_count"], r["fail_count"]) for r in stored_results(spark, state, [table]).collect()] == [(4, lost)]


def test_runs_are_read_newest_first_with_their_change(spark, tmp_path, rows):
    path, shape = str(tmp_path / "runs"), "table_name string, test_type string, column_name string, grain_columns string, failed_rows long"
    for failed in ([("t", "A", None, None, 0), ("t", "B", "c", None, 5)], [("t", "A", None, None, 3)], [("t", "A", None, None, 3), ("t", "B", "c", None, 1)]):
        number = append_run(spark.createDataFrame(failed, shape), path)
    assert number == 3
    got = [tuple(r) for r in newest_first(spark, path).select("run_id", "test_type", "previous_failed_rows", "change").collect()]
    assert got == [(3, "A", 3, "same"), (3, "B", 5, "better"), (2, "A", 0, "worse"), (1, "A", None, "new"), (1, "B", None, "new")]
