"""Thin queries over whole tables, one for each operator, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.centroids import cluster
from skein.llm.common import table
from skein.llm.decontaminate import find_contained
from skein.llm.jaccard import link_documents
from skein.llm.lines import dedup_lines
from skein.llm.mixing import score_language
from skein.llm.negatives import mine
from skein.llm.neighbours import nearest
from skein.llm.packing import pack_documents
from skein.llm.private import find_private
from skein.llm.quality import score_quality
from skein.llm.substrings import dedup_substrings
from skein.llm.suffixes import dedup_suffixes
from skein.llm.toxicity import score_toxicity


def _sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", _sha256("kept").alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_language_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_suffixes(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", _sha256("kept").alias("kept_sha256"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", _sha256("kept").alias("kept_sha256"))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", _sha256("base").alias("base_sha256"), "spans", _sha256("redacted").alias("redacted_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_nearest_neighbours, op2_line_dedup, op3_packing, op4_language_score, op5_suffix_dedup, op6_jaccard_join, op7_decontamination, op8_substring_dedup, op9_private_data, op10_toxicity, op11_quality, op12_centroids, op13_hard_negatives)}


_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = r"""
WITH line AS (
  SELECT doc_id, i, l, translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), owner AS (SELECT k, min(doc_id) AS owner FROM line WHERE length(k) >= 10 GROUP BY k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE owner < doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE owner IS NULL OR owner >= doc_id), '')) AS kept_sha256
FROM line LEFT JOIN owner USING (k) GROUP BY doc_id
"""

CONTAINED = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_LOW)} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(_LOW)} AS w FROM benchmark),
short AS (SELECT DISTINCT len(w) AS k FROM b WHERE len(w) BETWEEN 1 AND 4),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM b WHERE len(w) > 0),
bn AS (SELECT item_id, count(*)::BIGINT AS n_item FROM bs GROUP BY item_id),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) >= 5
  UNION SELECT doc_id, array_to_string(w[i:i + k - 1], ' ') FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, short WHERE len(w) >= k)),
c AS (SELECT doc_id, item_id, count(*)::BIGINT AS n_shared FROM ds JOIN bs USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM c JOIN bn USING (item_id) WHERE n_shared * 100 >= n_item * 80
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN rep USING (k), range(0, 35) AS r(j)),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_FAR = "list_sum(list_transform(list_zip(m, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _clusters() -> str:
    """Five rounds and the last assignment, each a table of its own."""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS m FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, m) - 1 AS k, m AS c FROM v QUALIFY k < 40)"""]
    for i in range(6):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, min((d, k)) AS best FROM (SELECT r, k, {_FAR}::BIGINT AS d FROM v, c{i}) GROUP BY r)")
        if i < 5:
            steps.append(f"""s{i} AS (SELECT best[2] AS k, j, sum(m[j]) AS s, count(*) AS n FROM a{i} JOIN v USING (r), range(1, 65) AS g(j) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(f, c) AS c FROM c{i} LEFT JOIN (SELECT k, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY j) AS f FROM s{i} GROUP BY k) USING (k))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, best[2]::INT AS cluster, best[1] AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia, (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a5 JOIN v USING (r) JOIN c5 ON k = best[2]"""


NEGATIVES = f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS m FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
s AS MATERIALIZED (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.m, b.m), lambda p: p[1] * p[2]))::BIGINT AS score FROM e a JOIN e b ON a.r <> b.r AND len(a.m) = len(b.m) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor, positive ORDER BY s.score DESC, s.vec_id NULLS LAST) QUALIFY row_number() OVER w <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": LINES, "op7_decontamination": CONTAINED, "op8_substring_dedup": SUBSTRINGS, "op12_centroids": _clusters(), "op13_hard_negatives": NEGATIVES}
