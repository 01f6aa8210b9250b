"""Registered queries of the subpackage, with the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from teampulse.llm import bpe, exact, html, iforest, licenses, lm, minhash, packing, phrases, resample, simhash, suffix, toxicity
from teampulse.llm.frames import hex64, table


def op1_quality_rules(spark, sf_dir):
    out = iforest.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), *iforest.COUNTS, "base_failed", "kept", "anomaly")


def op2_lm_scoring(spark, sf_dir):
    return lm.cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_license_scan(spark, sf_dir):
    return licenses.license_spans(table(spark, sf_dir, "documents"))


def op4_minhash_fingerprints(spark, sf_dir):
    return minhash.edit_probe(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark, sf_dir):
    return suffix.deduplicated(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark, sf_dir):
    return bpe.encoded(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark, sf_dir):
    return html.extracted(table(spark, sf_dir, "pages"))


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_simhash_neardup(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), hex64("fp").alias("fingerprint"), "component_id")


def op11_exact_dedup(spark, sf_dir):
    out = exact.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op12_importance_resampling(spark, sf_dir):
    out = resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumnRenamed("id", "doc_id")


def op13_phrase_mining(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (pipeline, op1_quality_rules, op2_lm_scoring, op3_license_scan, op4_minhash_fingerprints, op5_suffix_array_dedup, op6_byte_bpe, op7_html_extraction, op8_toxicity,
                                   op9_packing, op10_simhash_neardup, op11_exact_dedup,
                                   op12_importance_resampling, op13_phrase_mining)}


#: Each 100-byte string of a text with its place; those that are not the first of their kind cover what goes.
OP5_SQL = """
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, s, b[s + 1 : s + 100] AS bytes FROM (SELECT doc_id, b, unnest(range(0, n - 99)) AS s FROM d) u),
again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, s) AS nth FROM windows) w
  WHERE nth > 1),
runs AS (
  SELECT doc_id, s, sum(begins) OVER (PARTITION BY doc_id ORDER BY s) AS run
  FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS begins
        FROM again) a),
spans AS (SELECT doc_id, min(s) AS lo, max(s) + 100 AS hi FROM runs GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS z FROM spans
  UNION ALL SELECT doc_id, max(hi), any_value(n) FROM spans JOIN d USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(hex(b[a + 1 : z]), '' ORDER BY a) AS digits FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(r.n_removed, 0) AS n_removed, coalesce(r.n_spans, 0) AS n_spans,
       sha256(coalesce(unhex(k.digits), d.b)) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""

#: Equal texts by a window over the text itself.
OP11_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


def oracle_sql() -> dict:
    """SQL for operators 5 and 11. The others hash by XXH64, fit models, tokenise or read HTML: tests/llm holds them against
    brute force."""
    return {"op5_suffix_array_dedup": OP5_SQL, "op11_exact_dedup": OP11_SQL}
