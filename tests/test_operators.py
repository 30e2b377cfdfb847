import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.operators import distinct, grain, joins, rank, summarise
from tierflow.operators.profile import profile_columns, profile_columns_approx
from tierflow.operators.scoring import Rule, with_score


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_collapse_sum_keeps_null_keys_and_counts(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 4), (None, None)], "k int, v int")
    assert rows(grain.collapse_sum(df, ["k"], "v")) == [(1, 5, 2), (None, 4, 2)]


def test_latest_and_earliest_row(spark, rows):
    df = spark.createDataFrame(
        [(1, "2013B", "AAA", "x"), (1, "2014J", "AAA", "y"), (1, "2014J", "BBB", "z"), (2, "2013B", "AAA", None)],
        "id int, p string, m string, v string",
    )
    assert rows(grain.latest_row(df, ["id"], ["p", "m"], ["v"])) == [(1, "z"), (2, None)]
    assert rows(grain.earliest_row(df, ["id"], ["p", "m"], ["v"])) == [(1, "x"), (2, None)]
    assert "Window" not in plan(grain.latest_row(df, ["id"], ["p", "m"], ["v"]))


def test_distinct_per_entity_keeps_rows(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "a"), (None, "c")], "id int, v string")
    out = grain.with_distinct_per_entity(df, "id", "v", "seen")
    assert rows(out, "id", "v", "seen") == [(1, "a", 2), (1, "b", 2), (1, None, 2), (2, "a", 1), (None, "c", None)]


def test_figures_of_a_hot_and_a_missing_key_meet_in_several_tasks(spark):
    """One key and the rows without a key hold a third of all rows each."""
    data = [(1, i % 5, i) for i in range(1000)] + [(None, 0, i) for i in range(1000)] + [(i, 0, i) for i in range(2, 1000)]
    df = spark.createDataFrame(data, "id int, v int, i int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = grain.with_distinct_per_entity(df, "id", "v", "seen").withColumn("task", F.spark_partition_id())
        # The figure is read, or the join would not be in the plan at all.
        tasks = placed.groupBy("id").agg(F.count_distinct("task").alias("tasks"), F.max("seen").alias("seen"))
        spread = {r["id"]: r["tasks"] for r in tasks.collect()}
        assert spread[1] > 2 and spread[None] > 2
        assert placed.count() == len(data) and placed.filter("id = 1").select("seen").distinct().collect()[0][0] == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_per_key_join_has_one_plan(spark, tmp_path):
    """The table is read twice: once for its figures, once for its rows."""
    spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert plan(grain.with_distinct_per_entity(table, "k", "v", "seen")).count("FileScan") == 2


def test_a_reader_without_the_figure_does_not_join(spark, tmp_path, rows):
    data = [(k % 7, str(k % 3), k) for k in range(100)] + [(None, "x", 1), (3, None, 2)]
    spark.createDataFrame(data, "k int, v string, w int").write.parquet(str(tmp_path / "t"))
    table = grain.with_distinct_per_entity(spark.read.parquet(str(tmp_path / "t")), "k", "v", "seen", spread=["w"])
    unread = plan(table.groupBy("w").count())
    assert "Join" not in unread and "_salt" not in unread and unread.count("FileScan") == 1
    assert "v#" not in plan(table.select("k", "seen")).split("FileScan")[1].split("Batched")[0]
    assert rows(table.where("w = 2"), "k", "seen") == [(2, 3), (3, 3)]


def test_growing_sides_are_not_broadcast_by_an_estimate(spark):
    """All of these tables look small to the planner, as compressed files do."""
    df = spark.range(10).selectExpr("id AS k", "id % 3 AS v")
    found = [joins.orphan_counts(df, df, ["k"]), grain.with_distinct_per_entity(df, "k", "v", "seen"), joins.gate(df, joins.not_by_estimate(df), ["k"])]
    assert [plan(out).count("BroadcastHashJoin") for out in found] == [0, 0, 0]


def test_figures_are_repeated_for_the_salts_of_their_rows_only(spark, rows):
    df = spark.createDataFrame([(k, k % 3, i) for k in range(200) for i in range(2)] + [(None, 1, 0)], "k int, v int, w int")
    out = grain.with_distinct_per_entity(df, "k", "v", "seen", spread=["w"])
    assert rows(out.groupBy("seen").count()) == [(1, 400), (None, 1)]
    assert "_used" in plan(out)  # salts come from the key's rows, not from a list of all


def test_lookups_come_to_their_key(spark, rows):
    lookup = spark.createDataFrame([(1, None, "z"), (1, 5, "a"), (1, 5, "b"), (2, None, None), (None, 3, "c")], "k int, d int, t string")
    assert rows(joins.one_per_key(lookup, ["k"])) == [(1, 5, "b"), (2, None, None), (None, 3, "c")]
    facts = spark.createDataFrame([(1,), (2,), (9,)], "k int")
    assert joins.enrich(facts, joins.one_per_key(lookup, ["k"]), ["k"]).count() == 3


def test_keep_keys_matches_missing_values(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, v string")
    assert rows(joins.keep_keys(df, spark.createDataFrame([(1,), (None,)], "k int"), ["k"])) == [(1, "a"), (1, "b"), (None, "c")]


def test_profile_orders_by_type(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (-9007199254740993L, -9007199254740992.13BD, DATE'0999-01-01', true, 9.5D, TIMESTAMP'2020-01-01 00:00:00', '10'),
        (-9007199254740992L, -9007199254740992.11BD, DATE'2020-01-01', false, 10.5D, TIMESTAMP'2020-01-01 00:00:00.5', '9') AS t(a, b, c, d, e, f, g)""")
    got = {r.column_name: (r.min_value, r.max_value) for r in profile_columns(df, "t").collect()}
    assert got == {
        "a": ("-9007199254740993", "-9007199254740992"),
        "b": ("-9007199254740992.13", "-9007199254740992.11"),
        "c": ("0999-01-01", "2020-01-01"),
        "d": ("false", "true"),
        "e": ("9.5", "10.5"),
        "f": ("2020-01-01 00:00:00", "2020-01-01 00:00:00.5"),
        "g": ("10", "9"),
    }


def test_fanout_and_collapse_proof(spark, rows):
    df = spark.createDataFrame([(1, "M", 2), (1, "F", 2), (2, "M", 1), (2, "M", 1)], "id int, g string, seen int")
    assert rows(grain.fanout_probe(df, "id", ["g"], "seen > 1")) == [(3, 2, 1)]
    one = grain.latest_row(df, ["id"], ["g"], ["g", "seen"])
    assert rows(grain.collapse_proof(df, one, "id", "seen > 1")) == [(2, 2, 2, 0, 1)]


def test_version_summary(spark, rows):
    df = spark.range(3)
    out = grain.version_summary({"all": df, "some": df.filter("id > 0")}, {"n": F.count(F.lit(1)), "m": F.min("id")})
    assert rows(out) == [("all", 3, 0), ("some", 2, 1)]


def test_gate_cannot_multiply_rows(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    twice = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert [tuple(r) for r in joins.gate(facts, twice, ["id"]).collect()] == [(1, "a")]


def test_hot_key_of_a_gate_is_split(spark, tmp_path):
    """A third of the rows on one key: the join of two tables reads that key in several tasks."""
    facts = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.uuid().alias("v"))
    facts.repartition(8).write.parquet(str(tmp_path / "facts"))
    spark.range(0, 30000).select(F.col("id").alias("k")).write.parquet(str(tmp_path / "keys"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        kept = joins.gate(spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "keys")), ["k"])
        assert len(kept.collect()) == 30000
        assert "skew=true" in plan(kept)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_enrich_keeps_unmatched(spark, rows):
    facts = spark.createDataFrame([(1,), (2,)], "id int")
    lookup = spark.createDataFrame([(1, "a")], "id int, v string")
    assert rows(joins.enrich(facts, lookup, ["id"])) == [(1, "a"), (2, None)]


def test_orphans_count_missing_keys_and_collapse_hot_keys(spark, rows):
    child = spark.createDataFrame([(1,)] * 5 + [(2,), (None,)], "id int")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    assert rows(joins.orphan_counts(child, parent, ["id"])) == [(7, 6)]
    assert rows(joins.orphan_rows(child, parent, ["id"])) == [(1,)] * 5 + [(None,)]
    assert rows(joins.orphan_counts(child.limit(0), parent, ["id"])) == [(0, 0)]


def ntile(sizes, tiles):
    """Expected tile per position of a group of the given size."""
    small, surplus = divmod(sizes, tiles)
    out = []
    for tile in range(1, tiles + 1):
        out += [tile] * (small + (1 if tile <= surplus else 0))
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 8, 101])
def test_tiles_match_ntile(spark, size):
    df = spark.range(size).select(F.lit("g").alias("g"), F.col("id").alias("v"))
    got = [r[0] for r in rank.with_tiles(df, ["g"], ["v"], 4, "t").orderBy("v").select("t").collect()]
    assert got == ntile(size, 4)


def in_order(value):
    return (value is None, value)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, -2.5, 0.0, 0.0, 1.0, 1e9, float("inf")]), st.sampled_from([None, 1, 2, 700])),
        min_size=1,
        max_size=60,
    ),
    st.integers(1, 5),
)
def test_tiles_with_missing_and_repeated_keys_match_ntile(spark, data, tiles):
    """Every key gets the tiles that NTILE deals to its rows, whichever of its rows gets which."""
    df = spark.createDataFrame([(g, v, k) for g, v, k in data], "g string, v double, k int").repartition(3)
    want = []
    for group in {g for g, _, _ in data}:
        members = sorted([row for row in data if row[0] == group], key=lambda r: [in_order(x) for x in r])
        want += [(*row, tile) for row, tile in zip(members, ntile(len(members), tiles), strict=True)]
    for tiled in (rank.with_tiles, rank.with_tiles_by_edges):
        got = [tuple(r) for r in tiled(df, ["g"], ["v", "k"], tiles, "t").collect()]
        assert sorted(got, key=lambda r: [in_order(x) for x in r]) == sorted(want, key=lambda r: [in_order(x) for x in r])


def test_tiles_of_texts_days_flags_and_no_groups(spark, rows):
    data = [("b", "2020-01-02", True, 1), ("a", "1900-05-01", None, 2), ("é", None, False, 3), (None, "2020-01-01", True, 4), ("", "2020-01-01", True, 5)]
    df = spark.createDataFrame(data, "t string, d string, f boolean, i int").withColumn("d", F.col("d").cast("date"))
    assert rows(rank.with_tiles_by_edges(df, [], ["t", "i"], 3, "x"), "i", "x") == [(1, 2), (2, 1), (3, 2), (4, 3), (5, 1)]
    assert rows(rank.with_tiles_by_edges(df, [], ["d", "i"], 5, "x"), "i", "x") == [(1, 4), (2, 1), (3, 5), (4, 2), (5, 3)]
    assert rows(rank.with_tiles_by_edges(df, [], ["f", "i"], 5, "x"), "i", "x") == [(1, 2), (2, 5), (3, 1), (4, 3), (5, 4)]
    assert rank.with_tiles_by_edges(df.limit(0), ["f"], ["i"], 4, "x").collect() == []


def test_tiles_run_nothing_before_they_are_read(spark):
    tracker, group = spark.sparkContext.statusTracker(), "tiles"
    spark.sparkContext.setJobGroup(group, group)
    try:
        tiled = rank.with_tiles_by_edges(spark.range(100).withColumn("g", F.col("id") % 3), ["g"], ["id"], 4, "t")
        assert not tracker.getJobIdsForGroup(group)
        assert tiled.count() == 100 and tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_bitmap_counts_equal_plain_ones(spark, rows):
    data = [(k % 3, (k * 37) % 90 - 20, 1) for k in range(400)] + [(0, None, 1), (7, None, 1), (None, 2**40, 1), (None, -(2**40), 1)]
    df = spark.createDataFrame(data, "g int, v long, n int").repartition(4)
    plain = df.groupBy("g").agg(F.count_distinct("v").alias("d"), F.sum("n").alias("n"))
    assert rows(distinct.distinct_counts(df, ["g"], "v", "d", ["n"])) == rows(plain)
    inside = df.groupBy("g").agg(distinct.distinct_between(F.col("v"), -20, 50).alias("d"))
    assert rows(inside) == rows(df.groupBy("g").agg(F.count_distinct(F.when(F.col("v").between(-20, 50), F.col("v"))).alias("d")))
    assert "Expand" not in plan(distinct.distinct_counts(df, ["g"], "v", "d", ["n"]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 3)), min_size=1, max_size=40))
def test_positions_match_a_sort(spark, pairs):
    data = [(g, v, i) for i, (g, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "g string, v int, i int").repartition(3)
    got = {r["i"]: (r["position"], r["group_rows"]) for r in rank.with_positions(df, ["g"], ["v", "i"]).collect()}
    for group in {g for g, _, _ in data}:
        members = sorted((v, i) for g, v, i in data if g == group)
        for place, (_, i) in enumerate(members, start=1):
            assert got[i] == (place, len(members))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_positions_spread_a_hot_group_over_partitions(spark, threshold):
    """One group with most of the rows still gets exact positions from several partitions."""
    rng = random.Random(3)
    data = [("hot", rng.random(), i) for i in range(5000)] + [("cold", rng.random(), 5000 + i) for i in range(50)]
    df = spark.createDataFrame(data, "g string, v double, i int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        placed = rank.with_positions(df, ["g"], ["v", "i"])
        got = {r["i"]: r["position"] for r in placed.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for group in ("hot", "cold"):
        members = sorted((v, i) for g, v, i in data if g == group)
        assert [got[i] for _, i in members] == list(range(1, len(members) + 1))


def test_share_of_total_and_top_groups(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "g string, n int")
    shared = summarise.share_of_total(df, "n", "pct", 1)
    assert rows(shared) == [("a", 1, 25.0), ("b", 2, 50.0), ("c", 1, 25.0)]
    assert "CartesianProduct" not in plan(shared) and "NestedLoop" not in plan(shared)
    # a and c tie for the second place: the smaller name wins.
    assert rows(summarise.top_groups(df, "g", "n", 2)) == [("a",), ("b",)]
    assert rows(summarise.top_or_other(df, "g", "n", 2, "t"), "g", "t") == [("a", "a"), ("b", "b"), ("c", "Other")]


def test_unknown_group_is_folded_into_other(spark, rows):
    df = spark.createDataFrame([(None, 9), ("a", 1), ("b", 2)], "g string, n int")
    assert rows(summarise.top_or_other(df, "g", "n", 2, "t"), "g", "t") == [("a", "Other"), ("b", "b"), (None, "Other")]


def test_weighted_average_counts_the_weight_of_a_missing_value(spark, rows):
    df = spark.createDataFrame([(1, 80.0, 10.0), (1, None, 10.0), (2, 50.0, 0.0)], "k int, v double, w double")
    assert rows(df.groupBy("k").agg(summarise.weighted_average("v", "w"))) == [(1, 40.0), (2, None)]


def test_factors_in_one_pass(spark, rows):
    df = spark.createDataFrame([(1, "x", None), (2, "x", "y")], "i int, a string, b string")
    long = summarise.explode_factors(df, {"A": F.col("a"), "B": F.col("b")}, ["i"])
    assert rows(long) == [(1, "A", "x"), (1, "B", None), (2, "A", "x"), (2, "B", "y")]
    assert plan(long.groupBy("risk_factor").count()).count("Scan") == 1


def test_score_with_reasons(spark, rows):
    rules = (Rule("v > 10", 3, "large"), Rule("w = 'y'", 1, "marked"))
    df = spark.createDataFrame([(11, "y"), (11, None), (None, "n")], "v int, w string")
    scored = with_score(df, rules, ((4, "high"), (2, "medium")), "low")
    assert rows(scored, "risk_score", "risk_band", "risk_reasons") == [
        (0, "low", []), (3, "medium", ["large"]), (4, "high", ["large", "marked"]),
    ]


def test_profile_figures(spark):
    df = spark.createDataFrame(
        [(9, "b", None), (10, "a", None), (10, "b", None), (None, "a", None)], "n int, s string, e string"
    )
    got = {r["column_name"]: r for r in profile_columns(df, "t").collect()}
    n, s, e = got["n"], got["s"], got["e"]
    assert (n["total_rows"], n["null_count"], n["distinct_count"], n["null_percentage"]) == (4, 1, 2, 25.0)
    # Numeric order, not text order, and the more frequent value.
    assert (n["min_value"], n["max_value"], n["most_common_value"]) == ("9", "10", "10")
    # A tie goes to the smaller value.
    assert (s["min_value"], s["max_value"], s["most_common_value"], s["distinct_percentage"]) == ("a", "b", "a", 50.0)
    assert (e["null_count"], e["distinct_count"], e["min_value"], e["most_common_value"]) == (4, 0, None, None)
    assert plan(profile_columns(df, "t")).count("Scan") == 1


def test_profile_approx(spark):
    df = spark.range(1000).withColumn("s", F.when(F.col("id") > 9, "x"))
    got = {r["column_name"]: r for r in profile_columns_approx(df, "t").collect()}
    assert abs(got["id"]["distinct_count"] - 1000) < 100 and got["s"]["null_count"] == 10
