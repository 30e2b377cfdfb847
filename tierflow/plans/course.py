"""The course build from files to reports: ingest, clean, validate, model, validate again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.checks import run_checks
from tierflow.operators.history import append_run, newest_first
from tierflow.plans.course_checks import CHECKS, checked, mart_tests
from tierflow.plans.course_mart import MART_TABLES, Mart
from tierflow.plans.course_tables import CLEANERS, INTERACTION, RAW_COLUMNS, RAW_FILES
from tierflow.sources.files import read_csv_strings, rescued_rows
from tierflow.sources.snapshots import publish, publish_scopes, read_snapshot
from tierflow.sources.tables import in_key_order


class ValidationFailed(RuntimeError):
    """Misshapen lines or a check with status FAIL; the mart is not built on such data."""


class CourseStore:
    """The layers of one build below a shared folder, as published tables: a build that is killed leaves every table whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return read_snapshot(self.spark, self.path(layer, table))

    def write(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        publish(df, self.path(layer, table))
        return self.read(layer, table)

    def ingest(self, folder: str) -> dict[str, DataFrame]:
        """The seven files as strings with lineage."""
        raw = {}
        for table, file in RAW_FILES.items():
            lines = read_csv_strings(self.spark, f"{folder.rstrip('/')}/{file}", RAW_COLUMNS[table])
            raw[table] = self.write("raw", table, lines)
        return raw

    def misshapen(self, raw: dict[str, DataFrame]) -> DataFrame:
        """Tables with lines that did not fit their columns, and how many; the contract is that there are none."""
        counts = [
            rescued_rows(df).agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("lines"))
            for table, df in raw.items()
        ]
        return reduce(DataFrame.unionByName, counts).filter(F.col("lines") > 0)

    def clean(self, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Clean tables; the interactions are written in key order, so later scans skip files."""
        clean = {}
        for table, df in raw.items():
            cleaned = CLEANERS[table](df)
            clean[table] = self.write("clean", table, in_key_order(cleaned, INTERACTION) if table == "student_vle" else cleaned)
        return clean

    def validate(
        self, clean: dict[str, DataFrame], raw: dict[str, DataFrame], tables: tuple[str, ...] = tuple(CHECKS)
    ) -> DataFrame:
        """Run the checks of the named tables and replace their rows in the results, also by none."""
        results = run_checks([checked(table, clean, raw) for table in tables])
        publish_scopes(results, self.path("validation", "staging"), "table_name", tables)
        return self.read("validation", "staging")

    def mart(self, clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Dimensions first, so that the facts are gated on the written tables."""
        mart = Mart(clean)
        for table in MART_TABLES:
            setattr(mart, table, self.write("mart", table, getattr(mart, table)))
        return {table: getattr(mart, table) for table in MART_TABLES}

    def validate_mart(self, mart: dict[str, DataFrame]) -> DataFrame:
        """Append the outcome of the mart tests to their history; newest first, with the change against the run before."""
        path = self.path("validation", "data_quality_results")
        append_run(mart_tests(mart["fact_assessments"], mart["fact_vle_interactions"]), path)
        return newest_first(self.spark, path)


def build(spark: SparkSession, source: str, root: str, allow_failures: bool = False) -> dict[str, dict[str, DataFrame]]:
    """Files in `source` to a checked star schema below `root`."""
    store = CourseStore(spark, root)
    raw = store.ingest(source)
    if not allow_failures and not store.misshapen(raw).isEmpty():
        raise ValidationFailed("the raw layer holds lines that did not fit their columns; read _rescued_data")
    clean = store.clean(raw)
    results = store.validate(clean, raw)
    failed = results.filter(F.col("status") == "FAIL")
    if not allow_failures and not failed.isEmpty():
        raise ValidationFailed("the clean layer has failed checks; read validation/staging before building the mart")
    mart = store.mart(clean)
    return {"raw": raw, "clean": clean, "mart": mart, "validation": {"staging": results, "mart": store.validate_mart(mart)}}
