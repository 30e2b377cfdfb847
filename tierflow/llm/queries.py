"""The queries of this subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tierflow.llm import collocations, fingerprints, hard_negatives, licenses, logbilinear, ngram_join, packing, pieces, quality, secrets, toxicity, url_models, warc
from tierflow.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@_query("op2_secret_ownership")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """The source stands for the owner; what it holds in one language for a repository."""
    return secrets.report(documents(spark, folder), F.concat_ws("/", "source", "lang"), F.col("source"))


@_query("op3_toxicity_chain")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder)
    return toxicity.score(rows, toxicity.trained_chain(rows, documents(spark, folder, "labels")))


@_query("op4_quality_cascade")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder))


@_query("op7_best_two_fit")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(documents(spark, folder))


@_query("op9_ngram_prefix_tree")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_documents(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


@_query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


@_query("op10_weighted_sampling")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, folder))


@_query("op6_signature_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@_query("op5_boundary_chain")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(documents(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op8_log_bilinear")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return logbilinear.score_documents(documents(spark, folder))


@_query("op1_piece_lattice")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.segment(documents(spark, folder))


@_query(
    "op13_secondary_sort",
    """
    WITH taken AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM taken a JOIN taken b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other_id AS negative_id,
      positive_score, score AS negative_score
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
      AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY rank <= 3
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose id is divisible by 50 are anchors; the label of those divisible by 7 moves on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.usable_vectors(documents(spark, folder, "embeddings"), label), F.col("id") % 50 == 0)


# The rules of the contract.
URL_RULES = (
    url_models.Rule("org", "/", "allow"),
    url_models.Rule("example.org", "/es/", "block"),
    url_models.Rule("example.org", "/en/1", "block"),
    url_models.Rule("com", "/fr/", "allow"),
    url_models.Rule("com", "/de/", "block"),
)


@_query("op12_url_ratio")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return url_models.judge(documents(spark, folder, "pages"), URL_RULES)


@_query(
    "op11_son_collocations",
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    sizes AS (SELECT lang, w, unnest(range(1, 6)) AS k FROM words),
    starts AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sizes WHERE len(w) >= k),
    counts AS (
      SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, any_value(k) AS k, count(*) AS f
      FROM starts GROUP BY ALL HAVING count(*) >= 100),
    candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2),
    lengths AS (SELECT *, unnest(range(2, k)) AS m FROM candidates WHERE k >= 3),
    inner_starts AS (SELECT *, unnest(range(1, k - m + 2)) AS s FROM lengths),
    hidden AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer FROM inner_starts GROUP BY ALL),
    seen AS (
      SELECT c.* FROM candidates c LEFT JOIN hidden h USING (lang, phrase)
      WHERE h.longer IS NULL OR 100 * h.longer < 100 * c.a),
    cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM seen),
    cut_scores AS (
      SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, t.n,
        CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.cut], ' ')
      JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ') JOIN totals t ON t.lang = c.lang),
    least AS (SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM least QUALIFY rank <= 2000
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))
