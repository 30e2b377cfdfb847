"""Small course tables: a clean set, in which every check that can pass does, and helpers to break it."""

from __future__ import annotations

import pyarrow as pa

from tierflow.plans.course_tables import RAW_COLUMNS

PRESENTATIONS = ("2013B", "2013J", "2014J")

# One student in three presentations, one in two, one without clicks.
INFO = [
    ("AAA", "2013B", "1", "M", "Wales", "HE Qualification", "20-30%", "0-35", "0", "60", "N", "Pass"),
    ("AAA", "2013J", "1", "M", "Wales", "HE Qualification", "20-30%", "0-35", "1", "60", "N", "Withdrawn"),
    ("BBB", "2014J", "1", "M", "Wales", "HE Qualification", "20-30%", "0-35", "0", "120", "N", "Distinction"),
    ("AAA", "2013J", "2", "F", "Scotland", "No Formal quals", "0-10%", "35-55", "0", "240", "Y", "Fail"),
    ("BBB", "2014J", "2", "F", "Scotland", "No Formal quals", "0-10%", "35-55", "2", "30", "Y", "Pass"),
    ("BBB", "2014J", "3", "F", "Ireland", "A Level or Equivalent", "90-100%", "55<=", "0", "60", "N", "Pass"),
]


def clean_course() -> dict[str, list[tuple]]:
    """Rows of the seven raw tables, all as text."""
    return {
        "courses": [("AAA", "2013B", "268"), ("AAA", "2013J", "269"), ("BBB", "2014J", "262")],
        "assessments": [
            ("AAA", "2013B", "10", "TMA", "19", "10"),
            ("AAA", "2013J", "11", "TMA", "19", "10"),
            ("AAA", "2013J", "12", "CMA", "54", "0"),
            ("BBB", "2014J", "13", "TMA", "40", "50"),
            ("BBB", "2014J", "14", "Exam", "?", "100"),
        ],
        "student_assessment": [
            ("10", "1", "18", "0", "70"),
            ("11", "1", "25", "0", "80"),
            ("11", "2", "19", "1", "55"),
            ("13", "1", "40", "0", "90"),
            ("13", "3", "39", "0", "65.5"),
            ("14", "3", "230", "0", "61"),
        ],
        "student_info": list(INFO),
        "student_registration": [
            (module, presentation, student, "-20", "50" if result == "Withdrawn" else "?")
            for module, presentation, student, *_, result in INFO
        ],
        "vle": [
            ("100", "AAA", "2013B", "homepage", "?", "?"),
            ("101", "AAA", "2013J", "forumng", "1", "2"),
            ("102", "BBB", "2014J", "resource", "3", "3"),
            ("103", "BBB", "2014J", "quiz", "0", "5"),
        ],
        "student_vle": [
            ("AAA", "2013B", "1", "100", "5", "4"),
            ("AAA", "2013J", "1", "101", "-3", "2"),
            ("AAA", "2013J", "1", "101", "-3", "3"),
            ("AAA", "2013J", "2", "101", "31", "7"),
            ("BBB", "2014J", "1", "102", "0", "1"),
            ("BBB", "2014J", "1", "103", "181", "9"),
            ("BBB", "2014J", "2", "102", "30", "6"),
        ],
    }


def frames(spark, tables):
    """The rows as raw tables."""
    made = {}
    for name, rows in tables.items():
        schema = pa.schema([(column, pa.string()) for column in RAW_COLUMNS[name]])
        cells = [dict(zip(RAW_COLUMNS[name], row, strict=True)) for row in rows]
        made[name] = spark.createDataFrame(pa.Table.from_pylist(cells, schema=schema))
    return made


def changed(tables, table, row, **values):
    """The tables with some fields of one row replaced."""
    columns = RAW_COLUMNS[table]
    record = dict(zip(columns, tables[table][row], strict=True)) | values
    edited = list(tables[table])
    edited[row] = tuple(record[column] for column in columns)
    return {**tables, table: edited}


def added(tables, table, row):
    return {**tables, table: [*tables[table], row]}
