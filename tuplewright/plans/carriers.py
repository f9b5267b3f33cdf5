"""Relation-annotated rows made from the test tables, by SQL that Spark and other engines read alike."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAIRS = """
SELECT origin_id, pos, 'E' || CAST(pos AS STRING) AS pair_id,
  '[PRD' || CAST(pos AS STRING) || '] ' || p_name || ' [/PRD' || CAST(pos AS STRING) || ']' AS subject,
  '[LOC' || CAST(pos AS STRING) || ']' || n_name || '[/LOC' || CAST(pos AS STRING) || ']' AS object,
  CASE l_partkey % 14 WHEN 0 THEN NULL WHEN 1 THEN 'No Relationship' WHEN 2 THEN ' NO_RELATION ' WHEN 3 THEN 'used_by'
    WHEN 4 THEN 'same_entity' WHEN 5 THEN 'Effect' WHEN 6 THEN 'Ingredients' WHEN 7 THEN 'Scent' WHEN 8 THEN 'child_of'
    WHEN 9 THEN 'has_part' WHEN 10 THEN '' WHEN 11 THEN ' used_by ' WHEN 12 THEN 'located_in' ELSE 'brand_of' END AS relation,
  l_partkey % 13 <> 0 AS has_meta,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_suppkey % 5 = 0 THEN 'BEE' WHEN l_suppkey % 5 = 1 THEN 'ner' WHEN l_suppkey % 29 = 3 THEN NULL ELSE 'NER' END AS subj_source,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 'BEE' ELSE 'NER' END AS obj_source,
  CASE WHEN l_partkey % 13 = 0 OR l_partkey % 17 = 1 THEN NULL ELSE p_brand END AS subj_group,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE n_name END AS obj_group
FROM (
  SELECT CAST(l_orderkey AS STRING) AS origin_id, l_partkey, l_suppkey, p_name, p_brand, n_name,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INT) AS pos
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
) numbered
"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part", "supplier", "nation")}
    return spark.sql(PAIRS, **tables)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs as nested documents, their metadata without what a pair lacks; the text holds all mentions."""
    row = F.struct("pos", "pair_id", "subject", "object", "relation", "has_meta", "subj_source", "subj_group", "obj_source", "obj_group")
    packed = pairs(spark, sf_dir).groupBy("origin_id").agg(F.array_sort(F.collect_list(row)).alias("p"))

    def side(p, s, mention):
        return F.struct(p[f"{s}_source"].alias("source_type"), p[f"{s}_group"].alias("entity_group"), p[mention].alias("word"))

    return packed.select(
        F.col("origin_id").alias("id"),
        F.array_join(F.transform("p", lambda p: F.concat(p["subject"], F.lit(" in "), p["object"])), ". ").alias("text"),
        F.transform("p", lambda p: F.struct(p["pair_id"].alias("pair_id"), p["subject"].alias("subject"), p["object"].alias("object"), p["relation"].alias("relation"))).alias("candidate_pairs"),
        F.transform(F.filter("p", lambda p: p["has_meta"]), lambda p: F.struct(p["pair_id"].alias("pair_id"), side(p, "subj", "subject").alias("subject"), side(p, "obj", "object").alias("object"))).alias("meta_info"),
    )


def pairs_sql() -> str:
    return re.sub(r"\{(\w+)\}", r"\1", PAIRS)
