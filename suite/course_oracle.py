"""DuckDB SQL for the course queries: the stand-in tables, their cleaning and the mart as common table expressions."""

from __future__ import annotations


def present(column: str) -> str:
    return f"nullif(nullif(nullif(CASE WHEN lower(trim({column})) = 'null' THEN '' ELSE trim({column}) END, ''), '?'), '')"


def whole(column: str) -> str:
    text = present(column)
    return f"CASE WHEN regexp_matches({text}, '^[+-]?[0-9]+$') THEN try_cast({text} AS INTEGER) END"


def real(column: str) -> str:
    return f"try_cast({present(column)} AS DOUBLE)"


def unreadable(column: str, kind: str, sentinels: tuple[str, ...]) -> str:
    text = f"trim({column})"
    known = ", ".join(f"'{s}'" for s in sentinels)
    if kind == "INT":
        bad = f"(NOT regexp_matches({text}, '^[+-]?[0-9]+$') OR try_cast({text} AS INTEGER) IS NULL)"
    else:
        bad = f"try_cast({text} AS DOUBLE) IS NULL"
    return f"({text} NOT IN ({known}) AND {bad})"


RAW = """
e AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS tp,
         o_orderkey % 7 AS m,
         (year(o_orderdate) - 1995) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS p,
         repeat(substr('ABCDEFG', CAST(o_orderkey % 7 + 1 AS BIGINT), 1), 3) AS module,
         CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN month(o_orderdate) > 6 THEN 'J' ELSE 'B' END AS pres,
         o_orderkey // 3 + 1 AS sid
  FROM orders),
cells AS (SELECT DISTINCT m, p, module, pres FROM e),
r_student_info AS (
  SELECT CASE WHEN k % 11 = 0 THEN ' ' || lower(module) || ' ' ELSE module END AS code_module,
         pres AS code_presentation, CASE WHEN k % 503 = 0 THEN '?' ELSE CAST(sid AS VARCHAR) END AS id_student,
         CASE WHEN k % 13 = 0 THEN 'f' WHEN sid % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CASE WHEN sid % 97 = 0 THEN '' ELSE 'Region ' || CAST(sid % 13 AS VARCHAR) END AS region,
         list_extract(['No Formal quals', 'Lower Than A Level', 'A Level or Equivalent', 'HE Qualification',
                       'Post Graduate Qualification'], CAST(sid % 5 + 1 AS BIGINT)) AS highest_education,
         CASE pr WHEN '1-URGENT' THEN '0-10%' WHEN '2-HIGH' THEN '10-20' WHEN '3-MEDIUM' THEN '20-30%'
                 WHEN '4-NOT SPECIFIED' THEN '?' WHEN '5-LOW' THEN '90-100%' END AS imd_band,
         CASE WHEN k % 101 = 0 THEN '35-55'
              ELSE list_extract(['0-35', '35-55', '55<='], CAST(sid % 3 + 1 AS BIGINT)) END AS age_band,
         CAST(CASE WHEN c % 17 = 0 THEN 3 + c % 4 WHEN c % 5 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS num_of_prev_attempts,
         CASE WHEN k % 211 = 0 THEN 'abc'
              ELSE CAST(30 * (1 + CAST(floor(tp / 60000) AS BIGINT)) AS VARCHAR) END AS studied_credits,
         CASE WHEN c % 9 = 0 THEN 'Y' ELSE 'N' END AS disability,
         CASE WHEN st = 'F' AND k % 2 = 0 THEN 'Withdrawn' WHEN st = 'F' THEN 'Fail'
              WHEN st = 'O' THEN 'Pass' ELSE 'Distinction' END AS final_result
  FROM e),
r_student_registration AS (
  SELECT CASE WHEN k % 1009 = 0 THEN 'HHH' ELSE module END AS code_module,
         CASE WHEN k % 997 = 0 THEN pres || 'X' ELSE pres END AS code_presentation,
         CAST(sid AS VARCHAR) AS id_student,
         CASE WHEN again = 1 THEN '-1' WHEN k % 499 = 0 THEN '?' ELSE CAST(-(c % 370) AS VARCHAR) END AS date_registration,
         CASE WHEN st = 'F' AND k % 2 = 0 THEN CAST(c % 300 - 40 AS VARCHAR) ELSE '?' END AS date_unregistration
  FROM (SELECT *, 0 AS again FROM e UNION ALL SELECT *, 1 FROM e WHERE k % 251 = 0)),
r_courses AS (
  SELECT module AS code_module, pres AS code_presentation,
         CAST(230 + (p * 3 + m * 7) % 45 AS VARCHAR) AS module_presentation_length
  FROM cells WHERE NOT (module = 'GGG' AND pres = '1995B')),
r_assessments AS (
  SELECT module AS code_module, pres AS code_presentation, CAST(p * 1000 + m * 100 + n AS VARCHAR) AS id_assessment,
         CASE WHEN n = 5 THEN 'Exam' WHEN n <= 2 AND m = 3 THEN ' tma ' WHEN n <= 2 THEN 'TMA'
              WHEN m = 6 AND n = 4 THEN 'Quiz' ELSE 'CMA' END AS assessment_type,
         CASE WHEN (n = 5 AND p % 2 = 0) OR (m = 1 AND n = 4 AND p = 3) THEN '?' WHEN n = 5 THEN '240'
              ELSE CAST(20 + 40 * n AS VARCHAR) END AS date,
         CASE WHEN n = 5 THEN '100' WHEN m = 2 AND n = 1 THEN '?' WHEN m = 5 AND n = 2 THEN '150'
              WHEN n = 0 THEN '10' WHEN n = 1 THEN '12.5' WHEN n = 2 THEN '20' ELSE '0' END AS weight
  FROM cells, range(0, 6) AS numbers(n)),
r_student_assessment AS (
  SELECT CAST(p * 1000 + m * 100 + n + CASE WHEN n = 0 AND k % 1013 = 0 THEN 500000 ELSE 0 END AS VARCHAR) AS id_assessment,
         CAST(sid AS VARCHAR) AS id_student,
         CAST(20 + 40 * n + s0 % 15 - 9 AS VARCHAR) AS date_submitted,
         CASE WHEN part % 23 = 0 THEN '1' ELSE '0' END AS is_banked,
         CASE WHEN part % 40 = 0 THEN '?' ELSE CAST(CAST(round(d * 100) AS BIGINT) * 10 + s1 % 10 AS VARCHAR) END AS score
  FROM (SELECT l_orderkey, l_linenumber % 6 AS n, max(l_discount) AS d, max(l_suppkey) AS s1, min(l_suppkey) AS s0,
               min(l_partkey) AS part FROM lineitem GROUP BY ALL) t JOIN e ON e.k = t.l_orderkey),
visits AS (
  SELECT l.*, e.m, e.p, e.module, e.pres, e.sid,
         (l_linenumber * 9 + l_orderkey) % 64 * 1000 + e.m * 100 + e.p AS site
  FROM lineitem l JOIN e ON e.k = l.l_orderkey),
r_student_vle AS (
  SELECT module AS code_module, pres AS code_presentation, CAST(sid AS VARCHAR) AS id_student,
         CAST(site AS VARCHAR) AS id_site,
         CAST((l_orderkey * 13 + l_linenumber * 29) % 345 - 35 AS VARCHAR) AS date,
         CASE WHEN l_partkey % 503 = 0 THEN 'x' WHEN l_quantity = 13 THEN '0'
              WHEN l_quantity = 50 AND l_linenumber = 7 THEN '7500' WHEN l_quantity = 49 THEN '1470'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS sum_click
  FROM visits),
r_vle AS (
  SELECT CAST(slot * 1000 + m * 100 + p AS VARCHAR) AS id_site, module AS code_module, pres AS code_presentation,
         list_extract(['Resource', 'OUcontent', 'forumng', 'URL', 'quiz', ' homepage '], CAST(slot % 6 + 1 AS BIGINT)) AS activity_type,
         CASE WHEN slot % 5 = 0 THEN CAST(slot % 30 AS VARCHAR) ELSE '?' END AS week_from,
         CASE WHEN slot = 25 THEN '24' WHEN slot % 5 = 0 THEN CAST(slot % 30 + 2 AS VARCHAR) ELSE '?' END AS week_to
  FROM cells, range(0, 63) AS slots(slot))"""


def _codes() -> str:
    return f"upper({present('code_module')}) AS code_module, upper({present('code_presentation')}) AS code_presentation"


CLEAN = f"""
s_assessments AS (
  SELECT {_codes()}, {whole('id_assessment')} AS id_assessment,
         CASE WHEN upper(trim(assessment_type)) IN ('TMA', 'CMA') THEN upper(trim(assessment_type))
              WHEN upper(trim(assessment_type)) = 'EXAM' THEN 'Exam' ELSE {present('assessment_type')} END AS assessment_type,
         {whole('date')} AS date, {real('weight')} AS weight FROM r_assessments),
s_courses AS (
  SELECT {_codes()}, {whole('module_presentation_length')} AS module_presentation_length FROM r_courses),
s_student_assessment AS (
  SELECT {whole('id_assessment')} AS id_assessment, {whole('id_student')} AS id_student,
         {whole('date_submitted')} AS date_submitted, {whole('is_banked')} AS is_banked, {real('score')} AS score
  FROM r_student_assessment),
t_student_info AS (
  SELECT {_codes()}, {whole('id_student')} AS id_student, upper({present('gender')}) AS gender,
         {present('region')} AS region, {present('highest_education')} AS highest_education,
         CASE WHEN regexp_matches({present('imd_band')}, '^[0-9]+-[0-9]+$') THEN {present('imd_band')} || '%'
              ELSE {present('imd_band')} END AS imd_band,
         trim(imd_band) AS imd_band_raw, {present('age_band')} AS age_band,
         {whole('num_of_prev_attempts')} AS num_of_prev_attempts, {whole('studied_credits')} AS studied_credits,
         upper({present('disability')}) AS disability, {present('final_result')} AS final_result
  FROM r_student_info),
f_student_info AS (
  SELECT md5(concat_ws('|', code_module, code_presentation, CAST(id_student AS VARCHAR))) AS enrolment_key, t.*,
         imd_band IS NULL AS imd_band_is_missing,
         try_cast(split_part(imd_band, '-', 1) AS INTEGER) AS imd_decile_low,
         a.seen AS age_bands_seen_for_student,
         CASE WHEN studied_credits > 240 THEN 'over 240 (flagged outlier)' WHEN studied_credits > 120 THEN '121-240'
              WHEN studied_credits > 60 THEN '61-120' ELSE '60 or less' END AS credit_load_band,
         final_result = 'Withdrawn' AS is_withdrawn
  FROM t_student_info t
  LEFT JOIN (SELECT id_student AS i, count(DISTINCT age_band) AS seen FROM t_student_info GROUP BY 1) a ON a.i = t.id_student),
g_student_info AS (
  SELECT *, list_filter([
           CASE WHEN imd_band IS NULL THEN 'WARN: imd_band not known' END,
           CASE WHEN regexp_matches(imd_band_raw, '^[0-9]+-[0-9]+$') THEN 'WARN: imd_band label repaired' END,
           CASE WHEN studied_credits > 240 THEN 'WARN: studied_credits above 240' END,
           CASE WHEN num_of_prev_attempts > 2 THEN 'WARN: more than two previous attempts' END,
           CASE WHEN age_bands_seen_for_student > 1 THEN 'WARN: age_band changed over time' END],
           lambda x: x IS NOT NULL) AS dq_flags
  FROM f_student_info),
s_student_info AS (
  SELECT *, CASE WHEN code_module IS NULL OR code_presentation IS NULL OR id_student IS NULL THEN 'REJECT'
                 WHEN len(dq_flags) > 0 THEN 'WARN' ELSE 'PASS' END AS dq_status
  FROM g_student_info),
s_student_registration AS (
  SELECT {_codes()}, {whole('id_student')} AS id_student, {whole('date_registration')} AS date_registration,
         {whole('date_unregistration')} AS date_unregistration FROM r_student_registration),
t_student_vle AS (
  SELECT {_codes()}, {whole('id_student')} AS id_student, {whole('id_site')} AS id_site, {whole('date')} AS date,
         {whole('sum_click')} AS sum_click FROM r_student_vle),
s_student_vle AS (
  SELECT code_module, code_presentation, id_student, id_site, date, CAST(sum(sum_click) AS BIGINT) AS sum_click,
         count(*) AS original_record_count FROM t_student_vle GROUP BY ALL),
s_vle AS (
  SELECT {whole('id_site')} AS id_site, {_codes()}, lower({present('activity_type')}) AS activity_type,
         {whole('week_from')} AS week_from, {whole('week_to')} AS week_to FROM r_vle)"""

MART = """
dim_presentation AS (
  SELECT DISTINCT code_module, code_module AS code_presentation_module, code_presentation, module_presentation_length
  FROM s_courses WHERE code_module IS NOT NULL),
dim_date AS (
  SELECT CAST(d AS INTEGER) AS date, CAST(floor(d / 7.0) AS INTEGER) AS relative_week,
         CASE WHEN d < 0 THEN 'Pre-Course' WHEN d <= 30 THEN 'Early Course' WHEN d <= 180 THEN 'Mid Course'
              ELSE 'Late / Assessment Phase' END AS course_phase
  FROM range(-30, 301) AS days(d)),
dim_enrolment AS (
  SELECT i.code_module, i.code_presentation, i.id_student, i.final_result, r.date_registration, r.date_unregistration,
         coalesce(lower(i.final_result) = 'withdrawn', false) AS is_withdrawn
  FROM s_student_info i LEFT JOIN (SELECT * FROM s_student_registration
    QUALIFY row_number() OVER (PARTITION BY code_module, code_presentation, id_student
      ORDER BY date_registration DESC NULLS LAST, date_unregistration DESC NULLS LAST) = 1) r
    USING (code_module, code_presentation, id_student)),
dim_student AS (
  SELECT md5(CAST(id_student AS VARCHAR)) AS student_key, id_student, gender, region, highest_education, imd_band,
         imd_decile_low, age_band, disability, code_module AS demographics_from_module,
         code_presentation AS demographics_from_presentation, age_bands_seen_for_student > 1 AS age_band_changed_over_time
  FROM s_student_info WHERE dq_status <> 'REJECT'
  QUALIFY row_number() OVER (PARTITION BY id_student ORDER BY code_presentation DESC, code_module DESC) = 1),
fact_vle AS (
  SELECT v.id_student, v.code_module, v.code_presentation, v.date, v.id_site, w.activity_type, v.sum_click
  FROM s_student_vle v
  LEFT JOIN s_vle w ON w.id_site = v.id_site AND w.code_module = v.code_module AND w.code_presentation = v.code_presentation
  WHERE v.date BETWEEN -30 AND 300 AND v.id_student IN (SELECT id_student FROM dim_student)
    AND (v.code_module, v.code_presentation) IN (SELECT (code_module, code_presentation) FROM dim_presentation)),
fact_sub AS (
  SELECT x.id_student, a.code_module, a.code_presentation, a.date, x.id_assessment, a.assessment_type,
         try_cast(a.weight AS DECIMAL(5,2)) AS weight, try_cast(x.score AS DECIMAL(5,2)) AS score, x.date_submitted,
         x.date_submitted - a.date AS submission_delay, CAST(x.is_banked AS BOOLEAN) AS is_banked
  FROM s_student_assessment x JOIN s_assessments a USING (id_assessment)
  WHERE a.date BETWEEN -30 AND 300 AND x.id_student IN (SELECT id_student FROM dim_student)
    AND (a.code_module, a.code_presentation) IN (SELECT (code_module, code_presentation) FROM dim_presentation))"""


def raw(sql: str) -> str:
    return f"WITH {RAW} {sql}"


def clean(sql: str) -> str:
    return f"WITH {RAW}, {CLEAN} {sql}"


def mart(sql: str) -> str:
    return f"WITH {RAW}, {CLEAN}, {MART} {sql}"
