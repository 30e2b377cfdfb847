"""Queries that apply single operators to the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.registry import ORACLES, query, read
from tierflow.functions import cleaning as c
from tierflow.functions import flags
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
    run_checks,
    unique_test,
)
from tierflow.operators.grain import (
    collapse_sum,
    earliest_row,
    fanout_probe,
    latest_row,
    version_summary,
    with_distinct_per_entity,
)
from tierflow.operators.joins import enrich, gate, orphan_rows
from tierflow.operators.profile import profile_columns, profile_tables
from tierflow.operators.profile_state import stored_profile, update_profile
from tierflow.operators.rank import with_positions, with_tiles, with_tiles_by_edges
from tierflow.operators.scoring import Rule, with_score
from tierflow.operators.summarise import (
    explode_factors,
    share_of_total,
    top_groups,
    top_k,
    top_or_other,
    weighted_average,
)
from tierflow.plans.course_mart import with_calendar
from tierflow.plans.course_reports import risk_factors, withdrawal_bins
from tierflow.session import scratch_path
from tierflow.sources.files import read_csv_strings, read_csv_typed, rescued_rows
from tierflow.sources.snapshots import delete_scopes, publish, publish_scopes, read_snapshot
from tierflow.sources.tables import (
    append_rows,
    comment_table,
    create_empty,
    create_if_absent,
    create_layers,
    day_spine_of,
    list_layers,
    list_tables,
    read_back,
    replace_table,
    table_columns,
    write_ordered,
    write_slice,
)

# --- column cleaners ----------------------------------------------------------------------------------------


@query(
    "clean_codes",
    """SELECT c_custkey, upper(c_mktsegment) AS segment_code, lower(c_mktsegment) AS segment_lower,
              nullif(upper(substr(c_name, 10)), '000000000') AS number_code
       FROM customer""",
)
def clean_codes(spark, folder):
    padded = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    number = F.substring("c_name", 10, 20)
    return read(spark, folder, "customer").select(
        "c_custkey",
        c.code(padded).alias("segment_code"),
        c.lower_code(padded).alias("segment_lower"),
        c.code(number, ("", "000000000")).alias("number_code"),
    )


@query(
    "clean_sentinel_band",
    """SELECT o_orderkey, nullif(substr(o_orderpriority, 3), 'NOT SPECIFIED') AS band,
              substr(o_orderpriority, 3) AS band_raw, o_orderpriority = '4-NOT SPECIFIED' AS band_is_missing
       FROM orders""",
)
def clean_sentinel_band(spark, folder):
    text = F.substring("o_orderpriority", 3, 40)
    band = c.clean_null(text, ("", "not specified"))
    return read(spark, folder, "orders").select(
        "o_orderkey", band.alias("band"), F.trim(text).alias("band_raw"), band.isNull().alias("band_is_missing")
    )


@query(
    "clean_label_repair",
    """WITH banded AS (SELECT p_partkey, p_size // 10 * 10 AS low, p_size % 2 = 0 AS signed FROM part)
       SELECT p_partkey, CAST(low AS VARCHAR) || '-' || CAST(low + 10 AS VARCHAR)
              || CASE WHEN signed THEN '%' ELSE '' END AS label_raw,
              CAST(low AS VARCHAR) || '-' || CAST(low + 10 AS VARCHAR) || '%' AS label, CAST(low AS INTEGER) AS label_low
       FROM banded""",
)
def clean_label_repair(spark, folder):
    low = c.floor_bin("p_size", 10)
    sign = F.when(F.col("p_size") % 2 == 0, "%").otherwise("")
    label = F.concat(low.cast("string"), F.lit("-"), (low + 10).cast("string"), sign)
    return (
        read(spark, folder, "part")
        .select("p_partkey", label.alias("label_raw"))
        .withColumn("label", c.repair_label("label_raw"))
        .withColumn("label_low", c.lower_bound("label"))
    )


@query(
    "clean_bad_cast",
    """SELECT p_partkey, CAST(substr(p_brand, 7) AS INTEGER) AS brand_number, CAST(NULL AS INTEGER) AS type_number,
              p_size + 0.5::DOUBLE AS size_double, CAST(NULL AS INTEGER) AS size_int, true AS type_failed
       FROM part""",
)
def clean_bad_cast(spark, folder):
    half = F.concat(F.col("p_size").cast("string"), F.lit(".5"))
    return read(spark, folder, "part").select(
        "p_partkey",
        c.safe_cast(F.substring("p_brand", 7, 9), "int").alias("brand_number"),
        c.safe_cast("p_type", "int").alias("type_number"),
        c.safe_cast(half, "double").alias("size_double"),
        c.safe_cast(half, "int").alias("size_int"),
        c.cast_failed("p_type", "int").alias("type_failed"),
    )


@query(
    "clean_length_guard",
    """SELECT p_partkey, CASE WHEN length(p_type) = 5 THEN p_type END AS type_5, length(p_type) <> 5 AS wrong_length
       FROM part""",
)
def clean_length_guard(spark, folder):
    return read(spark, folder, "part").select(
        "p_partkey", c.fixed_length("p_type", 5).alias("type_5"), c.wrong_length("p_type", 5).alias("wrong_length")
    )


@query(
    "clean_category_map",
    """SELECT p_partkey,
              CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'PROMO' THEN 'Promo' ELSE p_type END AS kept,
              CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'PROMO' THEN 'Promo' END AS known_only
       FROM part""",
)
def clean_category_map(spark, folder):
    labels = {"ECONOMY": "Economy", "PROMO": "Promo"}
    return read(spark, folder, "part").select(
        "p_partkey",
        c.canonical_label("p_type", labels).alias("kept"),
        c.canonical_label(F.lower("p_type"), labels, keep_unknown=False).alias("known_only"),
    )


@query(
    "clean_decimal_guard",
    """SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS price, o_totalprice >= 99999.995 AS too_large
       FROM orders""",
)
def clean_decimal_guard(spark, folder):
    price = c.try_decimal("o_totalprice", 7, 2)
    return read(spark, folder, "orders").select("o_orderkey", price.alias("price"), price.isNull().alias("too_large"))


@query(
    "enrolment_key",
    """SELECT o_orderkey, md5(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderpriority,
              CAST(o_orderkey AS VARCHAR))) AS enrolment_key, md5(CAST(o_custkey AS VARCHAR)) AS student_key,
              o_orderstatus = 'F' AS is_withdrawn
       FROM orders""",
)
def enrolment_key(spark, folder):
    return read(spark, folder, "orders").select(
        "o_orderkey",
        c.row_key("o_custkey", "o_orderpriority", "o_orderkey").alias("enrolment_key"),
        c.row_key("o_custkey").alias("student_key"),
        flags.is_true(F.col("o_orderstatus") == "F").alias("is_withdrawn"),
    )


@query(
    "bucket_load",
    """SELECT CASE WHEN o_totalprice > 400000 THEN 'over 400000' WHEN o_totalprice > 200000 THEN '200000-400000'
                   WHEN o_totalprice > 100000 THEN '100000-200000' ELSE '100000 or less' END AS load_band,
              count(*) AS orders, round(min(o_totalprice), 2) AS smallest, round(max(o_totalprice), 2) AS largest
       FROM orders GROUP BY 1""",
)
def bucket_load(spark, folder):
    edges = ((400000, "over 400000"), (200000, "200000-400000"), (100000, "100000-200000"))
    band = c.bucketize("o_totalprice", edges, "100000 or less").alias("load_band")
    return (
        read(spark, folder, "orders")
        .groupBy(band)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(F.min("o_totalprice"), 2).alias("smallest"),
            F.round(F.max("o_totalprice"), 2).alias("largest"),
        )
    )


@query(
    "entity_distinct_back",
    """SELECT o_orderkey, o_custkey, o_orderpriority, seen AS priorities_seen
       FROM orders JOIN (SELECT o_custkey AS ck, count(DISTINCT o_orderpriority) AS seen FROM orders GROUP BY 1)
         ON ck = o_custkey""",
)
def entity_distinct_back(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return with_distinct_per_entity(orders, "o_custkey", "o_orderpriority", "priorities_seen")


# --- grain --------------------------------------------------------------------------------------------------


@query(
    "dedupe_aggregate",
    """SELECT l_orderkey, l_linenumber, sum(l_quantity) AS l_quantity, count(*) AS original_record_count
       FROM lineitem GROUP BY 1, 2""",
)
def dedupe_aggregate(spark, folder):
    return collapse_sum(read(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity")


@query(
    "dim_latest_row",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def dim_latest_row(spark, folder):
    kept = ("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return latest_row(read(spark, folder, "orders"), ["o_custkey"], ("o_orderdate", "o_orderkey"), kept)


@query(
    "dim_earliest_row",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def dim_earliest_row(spark, folder):
    kept = ("o_orderdate", "o_orderkey", "o_orderstatus")
    return earliest_row(read(spark, folder, "orders"), ["o_custkey"], ("o_orderdate", "o_orderkey"), kept)


@query(
    "dim_parent",
    """SELECT DISTINCT n_nationkey, n_name, r_regionkey AS parent_regionkey, r_name
       FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def dim_parent(spark, folder):
    parents = read(spark, folder, "region").withColumnRenamed("r_regionkey", "parent_regionkey")
    nations = read(spark, folder, "nation").withColumn("parent_regionkey", F.col("n_regionkey"))
    return nations.join(parents, "parent_regionkey").select("n_nationkey", "n_name", "parent_regionkey", "r_name").distinct()


@query(
    "fanout_probe_orders",
    """SELECT (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders)) AS naive_distinct_rows,
              count(DISTINCT o_custkey) AS actual_students,
              count(DISTINCT CASE WHEN o_totalprice > 400000 THEN o_custkey END) AS students_who_changed
       FROM orders""",
)
def fanout_probe_orders(spark, folder):
    orders = read(spark, folder, "orders")
    return fanout_probe(orders, "o_custkey", ("o_orderstatus", "o_orderpriority"), "o_totalprice > 400000")


DAYS = "CAST(date_diff('day', DATE '2024-01-08', CAST(ts AS DATE)) AS INTEGER)"


@query(
    "dim_date",
    f"""WITH bounds AS (SELECT min({DAYS}) AS lo, max({DAYS}) AS hi FROM events),
             days AS (SELECT unnest(range(lo, hi + 1)) AS d FROM bounds)
        SELECT CAST(d AS INTEGER) AS date, CAST(floor(d / 7.0) AS INTEGER) AS relative_week,
               CASE WHEN d < 0 THEN 'Pre-Course' WHEN d <= 30 THEN 'Early Course' WHEN d <= 180 THEN 'Mid Course'
                    ELSE 'Late / Assessment Phase' END AS course_phase FROM days""",
)
def dim_date(spark, folder):
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-08").cast("date"))
    return with_calendar(day_spine_of(read(spark, folder, "events"), day))


@query(
    "version_summary",
    """WITH merged AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
            final AS (SELECT * FROM merged WHERE q <= 100)
       SELECT 'Raw' AS version, count(*) AS total_records, count(DISTINCT l_orderkey) AS orders,
              CAST(sum(l_quantity) AS BIGINT) AS quantity, max(l_quantity) AS largest FROM lineitem
       UNION ALL SELECT 'Deduplicated', count(*), count(DISTINCT l_orderkey), CAST(sum(q) AS BIGINT), max(q) FROM merged
       UNION ALL SELECT 'Final Clean', count(*), count(DISTINCT l_orderkey), CAST(sum(q) AS BIGINT), max(q) FROM final""",
)
def version_summary_lines(spark, folder):
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    merged = collapse_sum(lines, ["l_orderkey", "l_linenumber"], "l_quantity")
    versions = {"Raw": lines, "Deduplicated": merged, "Final Clean": merged.filter("l_quantity <= 100")}
    measures = {
        "total_records": F.count(F.lit(1)),
        "orders": F.count_distinct("l_orderkey"),
        "quantity": F.sum("l_quantity").cast("bigint"),
        "largest": F.max("l_quantity"),
    }
    return version_summary(versions, measures)


# --- joins --------------------------------------------------------------------------------------------------


@query(
    "gate_semi",
    """SELECT event_id, user_id, event_type FROM events
       WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def gate_semi(spark, folder):
    known = read(spark, folder, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return gate(read(spark, folder, "events").select("event_id", "user_id", "event_type"), known, ["user_id"])


@query(
    "left_enrich",
    """SELECT c_custkey, c_nationkey, n_name, r_name FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20 LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def left_enrich(spark, folder):
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read(spark, folder, "nation").filter("n_nationkey < 20")
    nations = nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("r_regionkey"))
    with_nation = enrich(customers, nations, ["c_nationkey"])
    return enrich(with_nation, read(spark, folder, "region"), ["r_regionkey"]).drop("r_regionkey")


@query(
    "orphan_documents",
    """SELECT doc_id, lang, source, n_chars FROM documents d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def orphan_documents(spark, folder):
    documents = read(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return orphan_rows(documents, read(spark, folder, "labels"), ["doc_id"])


@query(
    "fact_submissions",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_type AS activity_type, o_custkey,
              CAST(l_quantity AS DECIMAL(5,2)) AS score,
              CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS submission_delay
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey AND p_size > 5
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def fact_submissions(spark, folder):
    known = read(spark, folder, "customer").filter("c_mktsegment <> 'BUILDING'")
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderdate"
    )
    parts = read(spark, folder, "part").filter("p_size > 5")
    parts = parts.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("activity_type"))
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    facts = enrich(lines.join(gate(orders, known, ["c_custkey"]), "l_orderkey"), parts, ["l_partkey"])
    return facts.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "activity_type",
        F.col("c_custkey").alias("o_custkey"),
        c.try_decimal("l_quantity").alias("score"),
        F.date_diff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("submission_delay"),
    )


# --- positions, tiles, groups -------------------------------------------------------------------------------


@query(
    "positions_in_group",
    """SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS position,
              count(*) OVER (PARTITION BY event_type) AS group_rows FROM events""",
)
def positions_in_group(spark, folder):
    events = read(spark, folder, "events").select("event_type", "event_id", "value")
    return with_positions(events, ["event_type"], ["value", "event_id"])


@query(
    "tiles_in_group",
    """WITH tiled AS (SELECT o_orderstatus, o_totalprice,
              CAST(ntile(4) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS quartile FROM orders)
       SELECT o_orderstatus, quartile, count(*) AS orders, min(o_totalprice) AS lowest, max(o_totalprice) AS highest
       FROM tiled GROUP BY 1, 2""",
)
def tiles_in_group(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")
    tiled = with_tiles(orders, ["o_orderstatus"], ["o_totalprice", "o_orderkey"], 4, "quartile")
    return tiled.groupBy("o_orderstatus", "quartile").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest")
    )


@query("tiles_by_edges", ORACLES["tiles_in_group"])
def tiles_by_edges(spark, folder):
    """The same tiles from the keys of their last rows: the orders are counted, not sorted or written."""
    orders = read(spark, folder, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")
    tiled = with_tiles_by_edges(orders, ["o_orderstatus"], ["o_totalprice", "o_orderkey"], 4, "quartile")
    return tiled.groupBy("o_orderstatus", "quartile").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest")
    )


@query(
    "group_correlation",
    """SELECT l_returnflag, l_linestatus, round(corr(l_quantity, l_extendedprice), 3) AS quantity_price_corr,
              round(corr(l_quantity, l_discount), 3) AS quantity_discount_corr FROM lineitem GROUP BY 1, 2""",
)
def group_correlation(spark, folder):
    return (
        read(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.corr("l_quantity", "l_extendedprice"), 3).alias("quantity_price_corr"),
            F.round(F.corr("l_quantity", "l_discount"), 3).alias("quantity_discount_corr"),
        )
    )


@query(
    "weighted_average",
    """SELECT l_returnflag, round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 6) AS weighted_discount,
              round(avg(l_discount), 6) AS plain_discount FROM lineitem GROUP BY 1""",
)
def weighted_average_lines(spark, folder):
    return (
        read(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.round(weighted_average("l_discount", "l_quantity"), 6).alias("weighted_discount"),
            F.round(F.avg("l_discount"), 6).alias("plain_discount"),
        )
    )


@query(
    "share_of_total",
    """SELECT o_orderstatus, count(*) AS orders, (count(*) * 20000 + sum(count(*)) OVER ()) // (2 * sum(count(*)) OVER ()) / 100 AS pct
       FROM orders GROUP BY 1""",
)
def share_of_total_orders(spark, folder):
    grouped = read(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return share_of_total(grouped, "orders", "pct", 2)


@query(
    "factor_breakdown",
    """WITH known AS (SELECT o_orderstatus, o_orderpriority, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT 'priority' AS risk_factor, o_orderpriority AS factor_value, count(*) AS orders,
              count_if(o_orderstatus = 'F')::BIGINT AS failed FROM known GROUP BY 2
       UNION ALL SELECT 'segment', c_mktsegment, count(*), count_if(o_orderstatus = 'F')::BIGINT FROM known GROUP BY 2""",
)
def factor_breakdown(spark, folder):
    segments = read(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    known = read(spark, folder, "orders").join(segments, "o_custkey")
    factors = {"priority": F.col("o_orderpriority"), "segment": F.col("c_mktsegment")}
    return (
        explode_factors(known, factors, ["o_orderstatus"])
        .groupBy("risk_factor", "factor_value")
        .agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("failed"))
    )


@query(
    "top_groups",
    """SELECT p_brand FROM part GROUP BY 1 ORDER BY sum(p_retailprice) DESC, p_brand LIMIT 3""",
)
def top_groups_brands(spark, folder):
    return top_groups(read(spark, folder, "part"), "p_brand", "p_retailprice", 3)


@query(
    "top_or_other",
    """WITH best AS (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 2)
       SELECT CASE WHEN event_type IN (SELECT event_type FROM best) THEN event_type ELSE 'Other' END AS event_group,
              count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY 1""",
)
def top_or_other_events(spark, folder):
    events = read(spark, folder, "events").select("event_type", "user_id", F.lit(1).alias("one"))
    return (
        top_or_other(events, "event_type", "one", 2, "event_group")
        .groupBy("event_group")
        .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))
    )


@query(
    "outlier_topk_lines",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity > 45
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 50""",
)
def outlier_topk_lines(spark, folder):
    unusual = read(spark, folder, "lineitem").filter("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return top_k(unusual, 50, F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")


@query(
    "relative_days",
    f"""WITH d AS (SELECT {DAYS} AS relative_day, value, user_id FROM events)
        SELECT relative_day, CASE WHEN relative_day < 0 THEN CAST(abs(relative_day) AS VARCHAR) || ' days BEFORE course start'
                WHEN relative_day = 0 THEN 'Course START day'
                ELSE CAST(relative_day AS VARCHAR) || ' days AFTER course start' END AS interpretation,
               count(*) AS total_interactions, count(DISTINCT user_id) AS unique_students FROM d GROUP BY 1""",
)
def relative_days(spark, folder):
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-08").cast("date"))
    return (
        read(spark, folder, "events")
        .groupBy(day.alias("relative_day"))
        .agg(F.count(F.lit(1)).alias("total_interactions"), F.count_distinct("user_id").alias("unique_students"))
        .withColumn("interpretation", c.relative_day_text("relative_day"))
    )


@query(
    "interaction_flags",
    f"""WITH daily AS (SELECT user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS site, {DAYS} AS day,
                              CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS clicks FROM events GROUP BY ALL)
        SELECT CASE WHEN clicks > 300 THEN 'extreme_click_outlier' WHEN clicks > 100 THEN 'high_click_outlier' ELSE 'normal' END AS click_flag,
               CASE WHEN day < -5 THEN 'pre_course_access' WHEN day > 20 THEN 'late_course_access'
                    WHEN day < 0 THEN 'pre_start_normal' ELSE 'normal' END AS day_flag,
               CASE WHEN clicks > 100 OR day < -5 OR day > 20 THEN 'review_needed' ELSE 'clean' END AS quality_flag,
               count(*) AS rows, CAST(sum(clicks) AS BIGINT) AS clicks FROM daily GROUP BY 1, 2, 3""",
)
def interaction_flags(spark, folder):
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-08").cast("date"))
    visits = read(spark, folder, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("site"),
        day.alias("day"),
        F.floor("value").alias("clicks"),
    )
    daily = collapse_sum(visits, ["user_id", "site", "day"], "clicks")
    clicks, on = F.col("clicks"), F.col("day")
    return daily.groupBy(
        flags.click_flag(clicks, 100, 300).alias("click_flag"),
        flags.day_flag(on, -5, 20).alias("day_flag"),
        flags.review_flag(clicks, on, 100, -5, 20).alias("quality_flag"),
    ).agg(F.count(F.lit(1)).alias("rows"), F.sum("clicks").alias("clicks"))


@query(
    "delay_bins",
    """WITH late AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d
                     FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F')
       SELECT CAST(floor(d / 90.0) * 90 AS INTEGER) AS bin_start, CAST(floor(d / 90.0) * 90 + 89 AS INTEGER) AS bin_end,
              CAST(CAST(floor(d / 90.0) * 90 AS INTEGER) AS VARCHAR) || ' to ' ||
              CAST(CAST(floor(d / 90.0) * 90 + 89 AS INTEGER) AS VARCHAR) AS day_bin_label, count(*) AS withdrawal_count
       FROM late GROUP BY ALL""",
)
def delay_bins(spark, folder):
    orders = read(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderstatus")
    joined = read(spark, folder, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey")
    delays = joined.select(
        F.date_diff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("delay"),
        F.col("o_orderstatus").alias("final_result"),
        (F.col("o_orderstatus") == "F").alias("is_withdrawn"),
    )
    return withdrawal_bins(delays, "delay")


@query(
    "order_risk_factors",
    """WITH known AS (SELECT o_custkey, o_orderstatus = 'F' AS risk, o_orderpriority AS v1, c_mktsegment AS v2
                      FROM orders JOIN customer ON o_custkey = c_custkey),
            base AS (SELECT (count_if(risk) * 2000 + count(DISTINCT o_custkey)) // (2 * count(DISTINCT o_custkey)) / 10 AS b FROM known),
            f AS (SELECT 'Priority' AS risk_factor, v1 AS factor_value, count(DISTINCT o_custkey) AS total_students,
                         count_if(risk)::BIGINT AS at_risk_count FROM known GROUP BY 2
                  UNION ALL SELECT 'Segment', v2, count(DISTINCT o_custkey), count_if(risk)::BIGINT FROM known GROUP BY 2),
            r AS (SELECT *, at_risk_count * 100.0::DOUBLE / total_students AS rate FROM f, base WHERE total_students >= 100)
       SELECT risk_factor, factor_value, total_students, at_risk_count, (at_risk_count * 2000 + total_students) // (2 * total_students) / 10 AS risk_rate_pct,
              b AS baseline_risk_pct, round((rate - b)::DECIMAL(38, 10), 1)::DOUBLE AS risk_delta_vs_baseline,
              CASE WHEN rate - b >= 10 THEN 'HIGH RISK' WHEN rate - b >= 5 THEN 'ELEVATED RISK'
                   WHEN rate - b <= -5 THEN 'LOW RISK' ELSE 'AVERAGE RISK' END AS risk_category FROM r""",
)
def order_risk_factors(spark, folder):
    """The variant whose rates divide by distinct students."""
    segments = read(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    known = read(spark, folder, "orders").join(segments, "o_custkey")
    return risk_factors(
        known,
        {"Priority": "o_orderpriority", "Segment": "c_mktsegment"},
        ("F",),
        "o_orderstatus",
        "o_custkey",
        denominator="students",
    )


@query(
    "order_score",
    """WITH s AS (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 3 ELSE 0 END
                   + CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 0 END AS risk_score,
                   o_totalprice > 400000 AS a, o_orderpriority = '1-URGENT' AS b FROM orders)
       SELECT o_orderkey, CAST(risk_score AS INTEGER) AS risk_score,
              CASE WHEN risk_score >= 4 THEN 'high' WHEN risk_score >= 2 THEN 'medium' ELSE 'low' END AS risk_band,
              concat_ws('; ', CASE WHEN a THEN 'large order' END, CASE WHEN b THEN 'urgent' END) AS reasons FROM s""",
)
def order_score(spark, folder):
    rules = (Rule("o_totalprice > 400000", 3, "large order"), Rule("o_orderpriority = '1-URGENT'", 2, "urgent"))
    scored = with_score(read(spark, folder, "orders"), rules, ((2, "medium"), (4, "high")), "low")
    return scored.select("o_orderkey", "risk_score", "risk_band", F.concat_ws("; ", "risk_reasons").alias("reasons"))


# --- checks -------------------------------------------------------------------------------------------------

RESULT = ("check_id", "total_count", "fail_count", "fail_pct", "status")


def _check_rows(table):
    return run_checks([table]).select(
        "check_id", "total_count", "fail_count", F.col("fail_pct").cast("double").alias("fail_pct"), "status"
    )


def _check(cid, rule, threshold=0.0, severity="FAIL"):
    return Check(cid, cid.lower(), "", "", "", "", rule, threshold, severity)


def _expected(*rows: tuple[str, str, str, float, str]) -> str:
    """SQL for (id, source, fail expression, threshold, severity); the total is the row count of the source."""
    parts = [
        f"SELECT '{cid}' AS check_id, count(*) AS total_count, CAST({fail} AS BIGINT) AS fail_count, "
        f"{threshold}::DOUBLE AS thr, '{severity}' AS sev FROM {source}"
        for cid, source, fail, threshold, severity in rows
    ]
    return (
        f"WITH c AS ({' UNION ALL '.join(parts)}) SELECT check_id, total_count, fail_count, "
        "(fail_count * 2000000 + nullif(total_count, 0)) // (2 * nullif(total_count, 0)) / 10000 AS fail_pct, CASE WHEN fail_count = 0 THEN 'PASS' "
        "WHEN fail_count * 100.0::DOUBLE / total_count > thr THEN sev ELSE 'WARN' END AS status FROM c"
    )


@query(
    "dq_null",
    _expected(
        ("N1", "orders", "count_if(o_custkey IS NULL)", 0, "FAIL"),
        ("N2", "orders", "count_if(o_orderpriority = '4-NOT SPECIFIED')", 15, "FAIL"),
        ("N3", "orders", "count_if(o_orderpriority = '4-NOT SPECIFIED')", 50, "FAIL"),
        ("N4", "orders", "count_if(o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus <> 'P')", 0, "WARN"),
    ),
)
def dq_null(spark, folder):
    orders = read(spark, folder, "orders")
    banded = orders.withColumn("band", c.clean_null(F.substring("o_orderpriority", 3, 40), ("not specified",)))
    checks = [
        _check("N1", FailWhen("o_custkey IS NULL")),
        _check("N2", FailWhen("band IS NULL"), 15),
        _check("N3", FailWhen("band IS NULL"), 50),
        _check("N4", FailWhen("band IS NULL AND o_orderstatus <> 'P'"), 0, "WARN"),
    ]
    return _check_rows(CheckedTable("orders", banded, checks))


@query(
    "dq_accepted",
    _expected(
        ("A1", "orders", "count_if(o_orderstatus NOT IN ('F','O'))", 0, "FAIL"),
        ("A2", "orders", "count_if(NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$'))", 25, "FAIL"),
    ),
)
def dq_accepted(spark, folder):
    checks = [
        _check("A1", FailWhen("o_orderstatus NOT IN ('F', 'O')")),
        _check("A2", FailWhen("NOT o_orderpriority RLIKE '^[1-5]-[A-Z]+$'"), 25),
    ]
    return _check_rows(CheckedTable("orders", read(spark, folder, "orders"), checks))


@query(
    "dq_range",
    _expected(
        ("R1", "lineitem", "count_if(l_quantity < 1 OR l_quantity > 50)", 0, "FAIL"),
        ("R2", "lineitem", "count_if(l_extendedprice > 90000)", 1, "WARN"),
        ("R3", "lineitem", "count_if(l_discount > l_tax)", 99, "FAIL"),
    ),
)
def dq_range(spark, folder):
    checks = [
        _check("R1", FailWhen("l_quantity NOT BETWEEN 1 AND 50")),
        _check("R2", FailWhen("l_extendedprice > 90000"), 1, "WARN"),
        _check("R3", FailWhen("l_discount > l_tax"), 99),
    ]
    return _check_rows(CheckedTable("lineitem", read(spark, folder, "lineitem"), checks))


@query(
    "dq_schema",
    _expected(
        ("S1", "part", "count_if(TRY_CAST(substr(p_brand, 7) AS INTEGER) IS NULL)", 0, "FAIL"),
        ("S2", "part", "count(*)", 0, "FAIL"),
    ),
)
def dq_schema(spark, folder):
    part = read(spark, folder, "part").select(F.substring("p_brand", 7, 9).alias("brand_number"), "p_type")
    checks = [
        _check("S1", FailWhen("trim(brand_number) <> '' AND try_cast(trim(brand_number) AS INT) IS NULL", "raw")),
        _check("S2", FailWhen("trim(p_type) <> '' AND try_cast(trim(p_type) AS INT) IS NULL", "raw")),
    ]
    return _check_rows(CheckedTable("part", part, checks, raw=part))


@query(
    "dq_unique_key",
    _expected(
        ("U1", "orders", "count(*) - count(DISTINCT o_orderkey)", 0, "FAIL"),
        ("U2", "lineitem", "count(*) - count(DISTINCT (l_orderkey, l_linenumber))", 30, "FAIL"),
    ),
)
def dq_unique_key(spark, folder):
    orders = CheckedTable("orders", read(spark, folder, "orders"), [_check("U1", Repeats(("o_orderkey",)))])
    lines = CheckedTable(
        "lineitem", read(spark, folder, "lineitem"), [_check("U2", Repeats(("l_orderkey", "l_linenumber")), 30)]
    )
    return _check_rows(orders).unionByName(_check_rows(lines))


@query(
    "dq_unique_nullsafe",
    _expected(
        ("U3", "orders", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, "
         "nullif(o_orderpriority, '4-NOT SPECIFIED') FROM orders))", 0, "FAIL"),
        ("U4", "orders", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders))", 0, "FAIL"),
    ),
)
def dq_unique_nullsafe(spark, folder):
    orders = read(spark, folder, "orders")
    band = orders.withColumn("band", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    checks = [_check("U3", Repeats(("o_custkey", "band"))), _check("U4", Repeats(tuple(orders.columns)))]
    return _check_rows(CheckedTable("orders", band, checks))


@query(
    "dq_collapse",
    """SELECT 'K1' AS check_id, count(DISTINCT o_custkey) AS total_count,
              (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)) - count(DISTINCT o_custkey) AS fail_count,
              (((SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)) - count(DISTINCT o_custkey)) * 2000000
                + count(DISTINCT o_custkey)) // (2 * count(DISTINCT o_custkey)) / 10000 AS fail_pct, 'WARN' AS status FROM orders
       UNION ALL
       SELECT 'K2', count(*), count_if(seen > 4)::BIGINT, (count_if(seen > 4) * 2000000 + count(*)) // (2 * count(*)) / 10000, 'WARN'
       FROM orders JOIN (SELECT o_custkey AS ck, count(DISTINCT o_orderpriority) AS seen FROM orders GROUP BY 1) ON ck = o_custkey""",
)
def dq_collapse(spark, folder):
    checks = [
        _check("K1", Collapses("o_custkey", ("o_orderstatus",)), 1, "WARN"),
        _check("K2", Spread("o_custkey", "o_orderpriority", 4), 2, "WARN"),
    ]
    return _check_rows(CheckedTable("orders", read(spark, folder, "orders"), checks))


@query(
    "dq_referential",
    _expected(
        ("F1", "documents d", "count_if(NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))", 50, "WARN"),
        ("F2", "documents d", "count_if(NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id = d.doc_id))", 99, "FAIL"),
    ),
)
def dq_referential(spark, folder):
    pages = read(spark, folder, "pages").withColumnRenamed("page_id", "doc_id")
    parents = {"labels": read(spark, folder, "labels"), "pages": pages}
    checks = [
        _check("F1", Orphans("labels", ("doc_id",)), 50, "WARN"),
        _check("F2", Orphans("pages", ("doc_id",)), 99),
    ]
    return _check_rows(CheckedTable("documents", read(spark, folder, "documents"), checks, parents=parents))


MERGED = "(SELECT l_orderkey, l_linenumber, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)"


@query(
    "dq_volume",
    _expected(
        ("V1", "lineitem", f"abs(count(*) - (SELECT count(*) FROM {MERGED}))", 0, "FAIL"),
        ("V2", MERGED, "CASE WHEN count(*) BETWEEN 100 AND 1000 THEN 0 ELSE 1 END", 0, "FAIL"),
    ),
)
def dq_volume(spark, folder):
    raw = read(spark, folder, "lineitem")
    merged = collapse_sum(raw, ["l_orderkey", "l_linenumber"], "l_quantity")
    checks = [_check("V1", SameCount()), _check("V2", CountBetween(100, 1000))]
    return _check_rows(CheckedTable("lineitem", merged, checks, raw))


@query(
    "dq_measure_preserved",
    _expected(
        ("M1", "lineitem", "0", 0, "FAIL"),
        ("M2", "lineitem", f"abs(CAST(sum(l_quantity) AS BIGINT) - (SELECT CAST(sum(q) AS BIGINT) FROM {MERGED} WHERE q <= 60))", 50, "FAIL"),
    ),
)
def dq_measure_preserved(spark, folder):
    raw = read(spark, folder, "lineitem")
    merged = collapse_sum(raw, ["l_orderkey", "l_linenumber"], "l_quantity")
    quantity = "CAST(l_quantity AS BIGINT)"
    below = f"CASE WHEN l_quantity <= 60 THEN {quantity} END"
    checks = [_check("M1", SameSum(quantity, quantity)), _check("M2", SameSum(quantity, below), 50)]
    return _check_rows(CheckedTable("lineitem", merged, checks, raw))


@query(
    "dq_mart_not_null",
    """SELECT 'lineitem' AS table_name, 'NOT_NULL' AS test_type, 'l_orderkey' AS column_name, CAST(NULL AS VARCHAR) AS grain_columns,
              count(*) AS total_rows, count(*) - count(l_orderkey) AS failed_rows, 'PASS' AS test_result FROM lineitem
       UNION ALL SELECT 'orders', 'NOT_NULL', 'band', NULL, count(*), count_if(o_orderpriority = '4-NOT SPECIFIED')::BIGINT, 'FAIL' FROM orders""",
)
def dq_mart_not_null(spark, folder):
    orders = read(spark, folder, "orders").select(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("band"))
    lines = not_null_test(read(spark, folder, "lineitem"), "lineitem", "l_orderkey")
    return lines.unionByName(not_null_test(orders, "orders", "band")).drop("test_timestamp")


@query(
    "dq_mart_unique",
    """SELECT 'lineitem' AS table_name, 'UNIQUENESS' AS test_type, CAST(NULL AS VARCHAR) AS column_name,
              'l_orderkey,l_linenumber' AS grain_columns, CAST(sum(n) AS BIGINT) AS total_rows,
              count_if(n > 1)::BIGINT AS failed_rows, 'FAIL' AS test_result
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
       UNION ALL SELECT 'orders', 'UNIQUENESS', NULL, 'o_orderkey', count(*), 0, 'PASS' FROM orders""",
)
def dq_mart_unique(spark, folder):
    lines = unique_test(read(spark, folder, "lineitem"), "lineitem", ("l_orderkey", "l_linenumber"))
    return lines.unionByName(unique_test(read(spark, folder, "orders"), "orders", ("o_orderkey",))).drop("test_timestamp")


# --- profiles -----------------------------------------------------------------------------------------------


def _profile_sql(table: str, columns: dict[str, tuple[str, str]]) -> str:
    rows = []
    for name, (kind, text) in columns.items():
        value = f"CAST({text} AS VARCHAR)"
        rows.append(
            f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, count(*) AS total_rows, "
            f"count(*) - count({name}) AS null_count, ((count(*) - count({name})) * 20000 + count(*)) // (2 * count(*)) / 100 AS null_percentage, "
            f"count(DISTINCT {name}) AS distinct_count, (count(DISTINCT {name}) * 20000 + count(*)) // (2 * count(*)) / 100 AS distinct_percentage, "
            f"CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value, "
            f"(SELECT {value} FROM {table} WHERE {name} IS NOT NULL GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1) AS most_common_value "
            f"FROM {table}"
        )
    return " UNION ALL ".join(rows)


def _same(columns: dict[str, str]) -> dict[str, tuple[str, str]]:
    return {name: (kind, name) for name, kind in columns.items()}


CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
NATION = {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"}
CONVERSATION = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}


@query("profile_columns", _profile_sql("customer", _same(CUSTOMER)) + " UNION ALL " + _profile_sql("nation", _same(NATION)))
def profile_customer(spark, folder):
    return profile_tables({name: read(spark, folder, name) for name in ("customer", "nation")})


@query("profile_lines", _profile_sql("lineitem", _same({
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz"})))
def profile_lines(spark, folder):
    return profile_columns(read(spark, folder, "lineitem"), "lineitem")


@query("profile_incremental", _profile_sql("customer", _same(CUSTOMER)))
def profile_incremental(spark, folder):
    """Files arrive twice; the second update reads the second ones only, and the merged counts give the profile."""
    customers, place, state = read(spark, folder, "customer"), scratch_path(spark, "arrivals"), scratch_path(spark, "profile")
    customers.filter("c_custkey % 3 = 0").write.parquet(place)
    update_profile(spark, place, state)
    customers.filter("c_custkey % 3 <> 0").write.mode("append").parquet(place)
    update_profile(spark, place, state)
    return stored_profile(spark, state, "customer")


@query("profile_text", _profile_sql("conversations", _same(CONVERSATION)))
def profile_text(spark, folder):
    return profile_columns(read(spark, folder, "conversations"), "conversations")


@query(
    "profile_fact",
    f"""SELECT count(*) AS rows, count(DISTINCT user_id) AS students, count(DISTINCT event_type) AS types,
               min({DAYS}) AS first_day, max({DAYS}) AS last_day, min(value) AS min_value, max(value) AS max_value,
               count_if({DAYS} < 0)::BIGINT AS pre_course_interactions FROM events""",
)
def profile_fact(spark, folder):
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-08").cast("date"))
    return read(spark, folder, "events").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("user_id").alias("students"),
        F.count_distinct("event_type").alias("types"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count_if(day < 0).alias("pre_course_interactions"),
    )


@query(
    "catalog_columns",
    """SELECT table_name, column_name, data_type, ordinal_position::INTEGER AS position
       FROM (SELECT table_name, column_name, ordinal_position,
                    CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS data_type
             FROM information_schema.columns WHERE table_name IN ('customer', 'nation')) WHERE table_name IS NOT NULL""",
)
def catalog_columns(spark, folder):
    for name in ("customer", "nation"):
        read(spark, folder, name).createOrReplaceTempView(name)
    return table_columns(spark, ("customer", "nation"))


# --- files and tables ---------------------------------------------------------------------------------------


@query(
    "ingest_csv_strings",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, true AS has_lineage, false AS was_rescued FROM customer""",
)
def ingest_csv_strings(spark, folder):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    path = scratch_path(spark, "csv")
    read(spark, folder, "customer").select(*columns).write.option("header", True).csv(path)
    raw = read_csv_strings(spark, path, columns)
    lineage = F.col("_source_file").isNotNull() & F.col("_source_modified_at").isNotNull() & F.col("_ingested_at").isNotNull()
    return raw.select(*columns, lineage.alias("has_lineage"), F.col("_rescued_data").isNotNull().alias("was_rescued"))


@query("typed_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS INTEGER) AS c_name_as_number FROM customer")
def typed_csv_scan(spark, folder):
    """Types at the scan: numbers come back as numbers, and a text read as a number is lost as NULL."""
    path = scratch_path(spark, "typed")
    columns = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    read(spark, folder, "customer").select(*columns, F.col("c_name").alias("c_name_as_number")).write.option("header", True).csv(path)
    return read_csv_typed(
        spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string, c_name_as_number int"
    )


@query(
    "rescued_lines",
    """SELECT p_name, p_name || ',' || CAST(p_partkey AS VARCHAR) || ',extra' AS rescued FROM part WHERE p_size = 1""",
)
def rescued_lines(spark, folder):
    line = F.concat_ws(",", "p_name", F.col("p_partkey").cast("string"))
    text = F.when(F.col("p_size") == 1, F.concat(line, F.lit(",extra"))).otherwise(line)
    path = scratch_path(spark, "lines")
    read(spark, folder, "part").select(text.alias("value")).write.text(path)
    columns = ["p_name", "p_partkey"]
    raw = read_csv_strings(spark, path, columns, header=False)
    return rescued_rows(raw).select("p_name", F.col("_rescued_data").alias("rescued"))


@query(
    "scoped_replace",
    """SELECT o_orderstatus AS table_name, count(*) AS rows,
              CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END) AS BIGINT) AS versions FROM orders GROUP BY 1""",
)
def scoped_replace(spark, folder):
    """A first write of all scopes, a second of one: only that one changes."""
    path = scratch_path(spark, "slices")
    rows = read(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("table_name"))
    write_slice(rows.withColumn("version", F.lit(1)), path)
    write_slice(rows.filter("table_name = 'F'").withColumn("version", F.lit(2)), path)
    back = spark.read.parquet(path)
    return back.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("version").alias("versions"))


@query(
    "atomic_replace",
    """SELECT 'after a write that failed' AS seen, o_orderstatus AS part, count(*) AS rows FROM orders GROUP BY 2
       UNION ALL SELECT 'by a reader from before the replace', o_orderstatus, count(*) FROM orders GROUP BY 2
       UNION ALL SELECT 'after the replace', o_orderstatus, count(*) FROM orders WHERE o_orderstatus <> 'F' GROUP BY 2""",
)
def atomic_replace(spark, folder):
    """A write that fails half way leaves the published rows; a replace shows at once, but not to earlier readers."""
    path = scratch_path(spark, "published")
    orders = read(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("part"))
    publish(orders, path)
    stopped = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("stopped"))).otherwise(F.col("o_orderkey"))
    try:
        publish(orders.withColumn("o_orderkey", stopped.cast("long")), path)
    except Exception as error:  # noqa: BLE001 - whichever class the session wraps it in
        if "stopped" not in str(error):
            raise
    before = read_snapshot(spark, path)
    publish(orders.filter("part <> 'F'"), path)
    seen = {
        "after a write that failed": read_snapshot(spark, path, 1),
        "by a reader from before the replace": before,
        "after the replace": read_snapshot(spark, path),
    }
    return reduce(
        DataFrame.unionByName,
        [df.groupBy(F.lit(name).alias("seen"), "part").agg(F.count(F.lit(1)).alias("rows")) for name, df in seen.items()],
    )


@query(
    "scoped_delete",
    """SELECT o_orderpriority AS table_name, count(*) AS rows,
              CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END) AS BIGINT) AS versions
       FROM orders WHERE o_orderpriority NOT IN ('2-HIGH', '5-LOW') AND (o_orderpriority <> '1-URGENT' OR o_orderkey % 2 = 0)
       GROUP BY 1""",
)
def scoped_delete(spark, folder):
    """One scope gets other rows, one is named and gets none, one is deleted; the others stay."""
    path = scratch_path(spark, "scopes")
    rows = read(spark, folder, "orders").select("o_orderkey", F.col("o_orderpriority").alias("table_name"))
    publish_scopes(rows.withColumn("version", F.lit(1)), path, "table_name")
    second = rows.filter("table_name = '1-URGENT' AND o_orderkey % 2 = 0").withColumn("version", F.lit(2))
    publish_scopes(second, path, "table_name", ["1-URGENT", "2-HIGH"])
    delete_scopes(spark, path, ["5-LOW"])
    back = read_snapshot(spark, path)
    return back.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("version").alias("versions"))


@query(
    "ordered_write",
    """SELECT count(*) AS rows, 0 AS overlapping_files FROM lineitem""",
)
def ordered_write(spark, folder):
    """Key ranges of the written files do not overlap, beyond a key shared by two neighbours."""
    path = scratch_path(spark, "ordered")
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    write_ordered(lines, path, ("l_orderkey", "l_linenumber"))
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    files = back.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")
    )
    # One row per written file reaches this window.
    before = F.lag("high").over(Window.orderBy("low", "high"))
    return files.withColumn("crosses", F.coalesce((before > F.col("low")).cast("int"), F.lit(0))).agg(
        F.sum("n").alias("rows"), F.sum("crosses").cast("int").alias("overlapping_files")
    )


@query(
    "table_life_cycle",
    """SELECT o_orderstatus AS part, count(*) AS rows, 'kept' AS second_create FROM orders GROUP BY 1
       UNION ALL SELECT 'all', count(*), 'kept' FROM orders""",
)
def table_life_cycle(spark, folder):
    """A layer below the shared folder: an empty results table, a replaced table, a second create that keeps it."""
    path = scratch_path(spark, "layer")
    layer = path.rsplit("/", 1)[1].replace("-", "_")
    create_layers(spark, (layer,), path)
    schema = T.StructType(
        [
            T.StructField("part", T.StringType()),
            T.StructField("rows", T.LongType()),
            T.StructField("second_create", T.StringType()),
        ]
    )
    create_empty(spark, f"{layer}.log", schema, "row counts by part")
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    replace_table(orders, f"{layer}.orders")
    create_if_absent(orders.filter("o_orderkey < 0"), f"{layer}.orders")
    kept = spark.table(f"{layer}.orders").withColumn("second_create", F.lit("kept"))
    rows = F.count(F.lit(1)).alias("rows")
    append_rows(kept.groupBy(F.col("o_orderstatus").alias("part"), "second_create").agg(rows), f"{layer}.log")
    append_rows(kept.groupBy(F.lit("all").alias("part"), "second_create").agg(rows), f"{layer}.log")
    return read_back(spark.table(f"{layer}.log"), "part")


@query(
    "layer_listing",
    """SELECT 'raw' AS layer, 'orders' AS table_name, 'as delivered' AS comment, count(*) AS rows FROM orders
       UNION ALL SELECT 'clean', 'orders', 'it''s one row per order', count(*) FROM orders WHERE o_totalprice > 0
       UNION ALL SELECT 'mart', 'status', 'orders by status', count(DISTINCT o_orderstatus) FROM orders""",
)
def layer_listing(spark, folder):
    """Three layers with commented tables, as the catalog lists them, with the rows that the tables hold."""
    place = scratch_path(spark, "layers")
    prefix = place.rsplit("/", 1)[1].replace("-", "_")
    layers = [f"{prefix}_{name}" for name in ("raw", "clean", "mart")]
    create_layers(spark, layers, place)
    orders = read(spark, folder, "orders")
    tables = {
        f"{layers[0]}.orders": (orders, "as delivered"),
        f"{layers[1]}.orders": (orders.filter("o_totalprice > 0"), "it's one row per order"),
        f"{layers[2]}.status": (orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), "orders by status"),
    }
    for name, (df, comment) in tables.items():
        replace_table(df, name)
        comment_table(spark, name, comment)
    listed = list_tables(spark, [layer for layer in list_layers(spark) if layer in layers])
    counts = [
        spark.table(name).agg(F.lit(name.split(".")[0]).alias("layer"), F.lit(name.split(".")[1]).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name in tables
    ]
    met = listed.join(reduce(DataFrame.unionByName, counts), ["layer", "table_name"])
    return met.withColumn("layer", F.substring_index("layer", "_", -1))
