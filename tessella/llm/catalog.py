"""The queries of this package over the driver's tables, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, chunks, decontam, hosts, html, jaccard, langid, licenses, mixing, pii
from .common import table


def op1_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "n_copies")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages")).drop("bad_low")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repaired(table(spark, sf_dir, "conversations"))


def op10_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.compare_with_edits(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_cube_mixing, op2_ngram_jaccard, op3_pii, op4_language_id, op5_main_text, op6_license_scan, op7_host_reputation, op8_decontamination, op9_chat_repair, op10_chunk_fingerprints)
    return {f.__name__: f for f in own}


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)
), reached AS (
  SELECT x AS doc_id, x AS other FROM links UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_jaccard": JACCARD_SQL, "op7_host_reputation": hosts.SQL}
