import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import session
from tierflow.sources import files, tables


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1,?\n12.5,x\n3,4,extra\n5\n")
    return str(path)


def test_csv_is_read_as_text_with_lineage(spark, csv, rows):
    raw = files.read_csv_strings(spark, csv, ["a", "b"])
    assert {f.dataType for f in raw.schema if f.name in ("a", "b")} == {T.StringType()}
    assert rows(raw, "a", "b", "_rescued_data") == [
        ("1", "?", None), ("12.5", "x", None), ("3", "4", "3,4,extra"), ("5", None, "5"),
    ]
    lineage = raw.select(*files.LINEAGE).first()
    assert lineage[0].endswith("in.csv") and lineage[1] is not None and lineage[2] is not None


def test_misshapen_lines_are_found_whatever_is_selected(spark, csv, rows):
    bad = files.rescued_rows(files.read_csv_strings(spark, csv, ["a", "b"]))
    assert rows(bad, "a", "_rescued_data") == [("3", "3,4,extra"), ("5", "5")]


def test_typed_read_loses_what_does_not_fit(spark, csv, rows):
    typed = files.read_csv_typed(spark, csv, "a int, b int")
    assert rows(typed.filter("a is null"), "b") == [(None,)]


def test_table_life_cycle(spark, rows):
    tables.create_layers(spark, ("clean_t",))
    assert "clean_t" in tables.list_layers(spark)
    first = spark.createDataFrame([(1, "x")], "id int, v string")
    second = spark.createDataFrame([("y", 2)], "v string, id int")
    tables.replace_table(first, "clean_t.t")
    tables.create_if_absent(second.select("id", "v"), "clean_t.t")
    assert rows(spark.table("clean_t.t")) == [(1, "x")]
    tables.append_rows(second, "clean_t.t")
    assert rows(tables.read_back(spark.table("clean_t.t"), "id")) == [(1, "x"), (2, "y")]
    tables.comment_table(spark, "clean_t.t", "it's one row per id")
    described = spark.sql("DESCRIBE TABLE EXTENDED clean_t.t").filter("col_name = 'Comment'").first()
    assert described["data_type"] == "it's one row per id"
    assert rows(tables.table_columns(spark, ["clean_t.t"]), "column_name", "data_type") == [("id", "int"), ("v", "string")]
    tables.create_empty(spark, "clean_t.t", T.StructType([T.StructField("n", T.LongType())]), "empty")
    assert spark.table("clean_t.t").count() == 0 and spark.table("clean_t.t").columns == ["n"]
    tables.drop_table(spark, "clean_t.t")
    assert not spark.catalog.tableExists("clean_t.t")
    spark.sql("DROP DATABASE clean_t CASCADE")


def test_only_the_written_scope_is_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "results")
    tables.write_slice(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "table_name string, v int"), path)
    tables.write_slice(spark.createDataFrame([("a", 9)], "table_name string, v int"), path)
    assert rows(spark.read.parquet(path), "table_name", "v") == [("a", 9), ("b", 3)]


def test_files_are_written_in_key_order(spark, tmp_path):
    path = str(tmp_path / "ordered")
    tables.write_ordered(spark.range(1000).withColumn("k", F.col("id") * 37 % 1000), path, ["k"], 4)
    back = spark.read.parquet(path).withColumn("f", F.input_file_name())
    ranges = sorted(tuple(r) for r in back.groupBy("f").agg(F.min("k"), F.max("k")).drop("f").collect())
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_day_spines(spark, rows):
    days = [d for (d,) in rows(tables.day_spine(spark))]
    assert sorted(days) == list(range(-30, 301))
    df = spark.createDataFrame([(4,), (1,)], "d int")
    assert rows(tables.day_spine_of(df, F.col("d"))) == [(1,), (2,), (3,), (4,)]
    assert rows(tables.constant_rows(spark, "t", ["b", "a"])) == [("a",), ("b",)]


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.scratch_path(spark, "x").startswith(named)
    assert session.stable(spark.range(3)).count() == 3


def test_buckets_follow_the_rows():
    rows = tables.BUCKET_ROWS
    assert [tables.bucket_number(n) for n in (0, rows, 8 * rows, 8 * rows + 1, 860 * rows)] == [8, 8, 8, 9, 860]
