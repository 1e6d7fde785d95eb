"""One registered query for each operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import (decontamination, html_text, jaccard_join, licences, merkle_manifest, packing, periodic_runs, quality_classifier, quality_rules, secrets,
                           stream_dedup, token_counts, token_ids)
from meterflow.llm.common import table
from meterflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@_query
def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_report(licences.scan_licences(table(spark, sf_dir, "documents")))


@_query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.text_report(html_text.extract_text(table(spark, sf_dir, "pages")))


@_query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


@_query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(secrets.scan_secrets(table(spark, sf_dir, "documents")))


@_query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.contamination_report(found)


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


@_query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    without_breaks = [F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in merkle_manifest.FIELDS]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, merkle_manifest.leaf_digest(without_breaks))
    rows = merkle_manifest.merkle_manifest(docs, also={"tampered": tampered})
    rows = rows.withColumn("folded_root", merkle_manifest.folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


# The checksum is bit by bit; a level of a tree holds one digest a node; a path has one row a level of each leaf.
ORACLES["op12_merkle_manifest"] = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384::BIGINT))) AS flipped
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN flipped & 1 = 1 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS tampered,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS nodes
  FROM leaves),
tree AS (
  SELECT source, 0 AS level, place, nodes, leaf AS digest FROM hashed
  UNION ALL
  SELECT source, level + 1, place // 3, (nodes + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM tree WHERE nodes > 1
  GROUP BY source, level, place // 3, nodes),
subroots AS (
  SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS nodes
  FROM tree WHERE nodes = 1),
top AS (
  SELECT 0 AS level, place, nodes, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (nodes + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM top WHERE nodes > 1 GROUP BY level, place // 3, nodes),
summit AS (SELECT level AS height, digest AS root FROM top WHERE nodes = 1),
nodes AS (
  SELECT source, level, place, digest, string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS behind
  FROM tree WHERE nodes > 1 WINDOW r AS (PARTITION BY source, level, place // 3 ORDER BY place)),
top_nodes AS (
  SELECT level, place, string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS behind
  FROM top WHERE nodes > 1 WINDOW r AS (PARTITION BY level, place // 3 ORDER BY place)),
path AS (
  SELECT h.doc_id, h.leaf, h.place AS leaf_place, h.source, s.subroot, m.root, s.height + m.height AS height, s.height AS turn, 0 AS level, h.place, s.place AS top_place,
    coalesce(h.tampered, h.leaf) AS folded, '' AS proof
  FROM hashed h JOIN subroots s ON h.source IS NOT DISTINCT FROM s.source CROSS JOIN summit m
  UNION ALL
  SELECT p.doc_id, p.leaf, p.leaf_place, p.source, p.subroot, p.root, p.height, p.turn, p.level + 1, CASE WHEN p.level + 1 = p.turn THEN p.top_place ELSE p.place // 3 END, p.top_place,
    sha256(coalesce(n.before, t.before, '') || p.folded || coalesce(n.behind, t.behind, '')),
    p.proof || coalesce(n.before, t.before, '') || coalesce(n.behind, t.behind, '')
  FROM (SELECT * REPLACE (CASE WHEN turn = 0 AND level = 0 THEN top_place ELSE place END AS place) FROM path WHERE level < height) p
  LEFT JOIN nodes n ON p.level < p.turn AND n.source IS NOT DISTINCT FROM p.source AND n.level = p.level AND n.place = p.place
  LEFT JOIN top_nodes t ON p.level >= p.turn AND t.level = p.level - p.turn AND t.place = p.place)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM path WHERE level = height
"""


@_query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_dedup.exact_copies(spark, f"{sf_dir}/documents.parquet", scratch_path(spark, "exact-dedup"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op13_exact_dedup"] = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
  first_value(doc_id) OVER g = doc_id AS kept, sha256(normal) AS text_sha256
FROM normal WINDOW g AS (PARTITION BY normal ORDER BY points DESC, doc_id)
"""
