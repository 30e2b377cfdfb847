"""The seven raw course tables derived from order data, for trying the course plans at any scale.

An order stands for an enrolment, its lines for interactions and submissions. All columns are strings, with the
faults real files have: sentinels, padded codes, unreadable numbers, repeats, orphans and values out of range.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.joins import not_by_estimate
from tierflow.plans.course_tables import RAW_COLUMNS

# Fixed values of the stand-in data.
MODULE_LETTERS = "ABCDEFG"
EDUCATION = (
    "No Formal quals",
    "Lower Than A Level",
    "A Level or Equivalent",
    "HE Qualification",
    "Post Graduate Qualification",
)
AGE_BANDS = ("0-35", "35-55", "55<=")
BANDS = {
    "1-URGENT": "0-10%",
    "2-HIGH": "10-20",
    "3-MEDIUM": "20-30%",
    "4-NOT SPECIFIED": "?",
    "5-LOW": "90-100%",
}
ACTIVITIES = ("Resource", "OUcontent", "forumng", "URL", "quiz", " homepage ")
SITE_SLOTS = 64


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _module(number: Column) -> Column:
    return F.repeat(F.substring(F.lit(MODULE_LETTERS), (number + 1).cast("int"), F.lit(1)), 3)


def _presentation(number: Column) -> Column:
    """Two presentations a year, counted from the first half of 1995."""
    year = (1995 + F.floor(number / 2)).cast("string")
    return F.concat(year, F.when(number % 2 == 1, "J").otherwise("B"))


def _strings(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(name).cast("string").alias(name) for name in RAW_COLUMNS[table]])


def _enrolments(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    key, year, month = F.col("o_orderkey"), F.year("o_orderdate"), F.month("o_orderdate")
    number = (year - 1995) * 2 + (month > 6).cast("int")
    return orders.select(
        key,
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
        (key % 7).alias("module_no"),
        number.alias("presentation_no"),
        _module(key % 7).alias("module"),
        _presentation(number).alias("presentation"),
        F.expr("o_orderkey div 3 + 1").alias("student"),
    )


def _student_info(enrolments: DataFrame) -> DataFrame:
    key, customer, student = F.col("o_orderkey"), F.col("o_custkey"), F.col("student")
    module, status = F.col("module"), F.col("o_orderstatus")
    bands = F.create_map(*[F.lit(part) for pair in BANDS.items() for part in pair])
    return enrolments.select(
        F.when(key % 11 == 0, F.concat(F.lit(" "), F.lower(module), F.lit(" "))).otherwise(module).alias("code_module"),
        F.col("presentation").alias("code_presentation"),
        F.when(key % 503 == 0, "?").otherwise(student.cast("string")).alias("id_student"),
        F.when(key % 13 == 0, "f").when(student % 2 == 0, "M").otherwise("F").alias("gender"),
        F.when(student % 97 == 0, "").otherwise(F.concat(F.lit("Region "), (student % 13).cast("string"))).alias("region"),
        _pick(EDUCATION, student % 5).alias("highest_education"),
        F.element_at(bands, F.col("o_orderpriority")).alias("imd_band"),
        F.when(key % 101 == 0, "35-55").otherwise(_pick(AGE_BANDS, student % 3)).alias("age_band"),
        F.when(customer % 17 == 0, 3 + customer % 4).when(customer % 5 == 0, 1).otherwise(0).alias("num_of_prev_attempts"),
        F.when(key % 211 == 0, "abc")
        .otherwise((30 * (1 + F.floor(F.col("o_totalprice") / 60000))).cast("string"))
        .alias("studied_credits"),
        F.when(customer % 9 == 0, "Y").otherwise("N").alias("disability"),
        F.when((status == "F") & (key % 2 == 0), "Withdrawn")
        .when(status == "F", "Fail")
        .when(status == "O", "Pass")
        .otherwise("Distinction")
        .alias("final_result"),
    )


def _student_registration(enrolments: DataFrame) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    withdrawn = (F.col("o_orderstatus") == "F") & (key % 2 == 0)
    # Every 251st enrolment is registered twice, the second time on the day before the course.
    twice = enrolments.withColumn("again", F.explode(F.when(key % 251 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return twice.select(
        F.when(key % 1009 == 0, "HHH").otherwise(F.col("module")).alias("code_module"),
        F.when(key % 997 == 0, F.concat("presentation", F.lit("X")))
        .otherwise(F.col("presentation"))
        .alias("code_presentation"),
        F.col("student").alias("id_student"),
        F.when(F.col("again") == 1, "-1").when(key % 499 == 0, "?").otherwise((-(customer % 370)).cast("string")).alias("date_registration"),
        F.when(withdrawn, (customer % 300 - 40).cast("string")).otherwise("?").alias("date_unregistration"),
    )


def _cells(enrolments: DataFrame) -> DataFrame:
    """Modules and presentations that occur; the numbers are made distinct before the texts are formed."""
    numbers = enrolments.select("module_no", "presentation_no").distinct()
    return numbers.select(
        "*", _module(F.col("module_no")).alias("module"), _presentation(F.col("presentation_no")).alias("presentation")
    )


def _courses(enrolments: DataFrame) -> DataFrame:
    taught = ~((F.col("module") == "GGG") & (F.col("presentation") == "1995B"))
    length = 230 + (F.col("presentation_no") * 3 + F.col("module_no") * 7) % 45
    return _cells(enrolments).filter(taught).select(
        F.col("module").alias("code_module"),
        F.col("presentation").alias("code_presentation"),
        length.alias("module_presentation_length"),
    )


def _assessment_id(number: Column) -> Column:
    return F.col("presentation_no") * 1000 + F.col("module_no") * 100 + number


def _assessments(enrolments: DataFrame) -> DataFrame:
    k, module_no, presentation_no = F.col("k"), F.col("module_no"), F.col("presentation_no")
    numbered = _cells(enrolments).select("*", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    undated = ((k == 5) & (presentation_no % 2 == 0)) | ((module_no == 1) & (k == 4) & (presentation_no == 3))
    kind = (
        F.when(k == 5, "Exam")
        .when((k <= 2) & (module_no == 3), " tma ")
        .when(k <= 2, "TMA")
        .when((module_no == 6) & (k == 4), "Quiz")
        .otherwise("CMA")
    )
    weight = (
        F.when(k == 5, "100")
        .when((module_no == 2) & (k == 1), "?")
        .when((module_no == 5) & (k == 2), "150")
        .when(k == 0, "10")
        .when(k == 1, "12.5")
        .when(k == 2, "20")
        .otherwise("0")
    )
    return numbered.select(
        F.col("module").alias("code_module"),
        F.col("presentation").alias("code_presentation"),
        _assessment_id(k).alias("id_assessment"),
        kind.alias("assessment_type"),
        F.when(undated, "?").when(k == 5, "240").otherwise((20 + 40 * k).cast("string")).alias("date"),
        weight.alias("weight"),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")


def _student_assessment(enrolments: DataFrame, lines: DataFrame) -> DataFrame:
    keyed = enrolments.select("o_orderkey", "module_no", "presentation_no", "student")
    per_number = lines.groupBy("l_orderkey", (F.col("l_linenumber") % 6).alias("k")).agg(
        F.max("l_discount").alias("discount"),
        F.max("l_suppkey").alias("last_supplier"),
        F.min("l_suppkey").alias("first_supplier"),
        F.min("l_partkey").alias("part"),
    )
    taken = per_number.join(not_by_estimate(keyed), F.col("l_orderkey") == F.col("o_orderkey"))
    k = F.col("k")
    orphan = F.when((k == 0) & (F.col("o_orderkey") % 1013 == 0), 500000).otherwise(0)
    score = (F.round(F.col("discount") * 100).cast("bigint") * 10 + F.col("last_supplier") % 10).cast("string")
    return taken.select(
        (_assessment_id(k) + orphan).alias("id_assessment"),
        F.col("student").alias("id_student"),
        (20 + 40 * k + F.col("first_supplier") % 15 - 9).alias("date_submitted"),
        F.when(F.col("part") % 23 == 0, 1).otherwise(0).alias("is_banked"),
        F.when(F.col("part") % 40 == 0, "?").otherwise(score).alias("score"),
    )


def _site(slot: Column) -> Column:
    return slot * 1000 + F.col("module_no") * 100 + F.col("presentation_no")


def _visits(enrolments: DataFrame, lines: DataFrame) -> DataFrame:
    keyed = enrolments.select("o_orderkey", "module_no", "presentation_no", "module", "presentation", "student")
    slot = (F.col("l_linenumber") * 9 + F.col("l_orderkey")) % SITE_SLOTS
    return lines.join(not_by_estimate(keyed), F.col("l_orderkey") == F.col("o_orderkey")).select("*", _site(slot).alias("site"))


def _student_vle(visits: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    clicks = (
        F.when(F.col("l_partkey") % 503 == 0, "x")
        .when(quantity == 13, "0")
        .when((quantity == 50) & (F.col("l_linenumber") == 7), (quantity * 150).cast("string"))
        .when(quantity == 49, (quantity * 30).cast("string"))
        .otherwise(quantity.cast("string"))
    )
    return visits.select(
        F.col("module").alias("code_module"),
        F.col("presentation").alias("code_presentation"),
        F.col("student").alias("id_student"),
        F.col("site").alias("id_site"),
        ((F.col("l_orderkey") * 13 + F.col("l_linenumber") * 29) % 345 - 35).alias("date"),
        clicks.alias("sum_click"),
    )


def _vle(enrolments: DataFrame) -> DataFrame:
    """The sites of every presentation but for the last slot, whose visits are orphans."""
    slot = F.col("slot")
    slots = F.explode(F.sequence(F.lit(0), F.lit(SITE_SLOTS - 2))).alias("slot")
    sites = _cells(enrolments).select("*", slots).withColumn("site", _site(slot))
    dated = slot % 5 == 0
    return sites.select(
        F.col("site").alias("id_site"),
        F.col("module").alias("code_module"),
        F.col("presentation").alias("code_presentation"),
        _pick(ACTIVITIES, slot % 6).alias("activity_type"),
        F.when(dated, (slot % 30).cast("string")).otherwise("?").alias("week_from"),
        F.when(dated & (slot == 25), (slot % 30 - 1).cast("string"))
        .when(dated, (slot % 30 + 2).cast("string"))
        .otherwise("?")
        .alias("week_to"),
    )


def raw_course(spark: SparkSession, folder: str, tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The named raw tables (all seven by default)."""
    enrolments = _enrolments(spark, folder)
    lines = _lines(spark, folder)
    builders = {
        "assessments": lambda: _assessments(enrolments),
        "courses": lambda: _courses(enrolments),
        "student_assessment": lambda: _student_assessment(enrolments, lines),
        "student_info": lambda: _student_info(enrolments),
        "student_registration": lambda: _student_registration(enrolments),
        "student_vle": lambda: _student_vle(_visits(enrolments, lines)),
        "vle": lambda: _vle(enrolments),
    }
    return {name: _strings(builders[name](), name) for name in (builders if tables is None else tables)}
