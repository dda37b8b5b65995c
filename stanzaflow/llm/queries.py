"""The subpackage's queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, exact, langid, mixing, pii, piece, quality, simhash, suffix, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark, sf_dir):
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op2_suffix(spark, sf_dir):
    return suffix.dedup(_table(spark, sf_dir, "documents"))


def op3_langid(spark, sf_dir):
    return langid.predict(_table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark, sf_dir):
    return piece.digests(_table(spark, sf_dir, "documents"))


def op5_pii(spark, sf_dir):
    return pii.spans(_table(spark, sf_dir, "documents"))


def op6_ann(spark, sf_dir):
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op7_urlfilter(spark, sf_dir):
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op8_quality(spark, sf_dir):
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_mixing(spark, sf_dir):
    return mixing.mix_plan(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark, sf_dir):
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_simhash": op1_simhash,
        "op2_suffix": op2_suffix,
        "op3_langid": op3_langid,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_pii": op5_pii,
        "op6_ann": op6_ann,
        "op7_urlfilter": op7_urlfilter,
        "op8_quality": op8_quality,
        "op9_mixing": op9_mixing,
        "op10_exact_dedup": op10_exact_dedup,
        "pipeline": _pipeline,
    }


_OP9 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat('mix:', coalesce(doc_id::VARCHAR, ''))) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(place % 3 + 1)::INT] AS weight,
         source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total
  FROM sources),
filled AS (
  SELECT *,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed),
marked AS (SELECT *, (total - before) * weight > cap * weights AS capped FROM filled),
shared AS (
  SELECT *, total - min(before) FILTER (WHERE NOT capped) OVER () AS rest,
         max(weights) FILTER (WHERE NOT capped) OVER () AS open
  FROM marked),
aimed AS (
  SELECT source, source_size, CASE WHEN capped THEN cap ELSE rest * weight / open END AS target FROM shared),
placed AS (
  SELECT d.doc_id, d.size, a.source_size, a.target, floor(a.target)::BIGINT AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id) - d.size AS before
  FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source),
cut AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM cut
"""

_OP10 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def oracle_sql() -> dict:
    return {"op9_mixing": _OP9, "op10_exact_dedup": _OP10}
