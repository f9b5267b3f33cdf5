"""The queries of this subpackage and, where SQL can express one, its SQL."""
from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, bucket_digest, class_lm, decontaminate, html_text, line_crf, pii, simhash, token_counts, url_filter


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.round_trip(_read(spark, sf_dir, "documents"), ranks, tokenizers.PATTERN))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op3_bucket_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_digest.digest_pairs(_read(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_pii(_read(spark, sf_dir, "documents")))


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(_read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return line_crf.score(docs, line_crf.train(docs, _read(spark, sf_dir, "labels")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"), tokenizers.PATTERN)


QUERIES = {q.__name__: q for q in (op1_bpe, op2_html_text, op3_bucket_digest, op4_url_filter, op5_pii, op6_class_lm, op7_simhash, op8_line_crf, op9_decontaminate, op10_token_counts)}

# The URL rules by plain SQL.  Links between pages would need recursion; the SQL
# finds canonical or refresh links of the tables and carries blocks along them.
_URL_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, html,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) AS query
  FROM (SELECT page_id, html, coalesce(rest, '') AS rest FROM parts)
), judged AS (
  SELECT *, CASE WHEN host = '' THEN NULL ELSE host || path || query END AS node,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split
), links AS (
  SELECT node, translate(regexp_extract(target, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
               || regexp_extract(target, '://[^/?#]*([^#]*)', 1) AS other
  FROM (SELECT node, regexp_extract(html, '<link[^>]*rel="canonical"[^>]*href="([^"]*://[^"]*)"', 1) AS target FROM judged)
  WHERE target <> '' AND node IS NOT NULL
), steps AS (SELECT node AS a, other AS b FROM links UNION SELECT other, node FROM links),
reached AS (
  SELECT a AS start, a AS node FROM steps
  UNION SELECT r.start, s.b FROM reached r JOIN steps s ON s.a = r.node
), tainted AS (
  SELECT DISTINCT r.start FROM reached r WHERE
    NOT ((regexp_matches(r.node, '^([^/]*[.])?example[.]net/en/')) OR (regexp_matches(r.node, '^([^/]*[.])?org/fr/')))
    AND (regexp_matches(r.node, '^([^/?]*[.])?net/') OR regexp_matches(r.node, '^([^/]*[.])?example[.]com/de/'))
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN node IN (SELECT start FROM tainted) THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

ORACLES: dict[str, str] = {"op4_url_filter": _URL_SQL}
