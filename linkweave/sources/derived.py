"""Pipeline inputs derived from the part table, the same statements in Spark and any other SQL engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _raw(prefix: str, r41: int, r37: int, r5: int, shift: int, where: str) -> str:
    return f"""
SELECT concat('{prefix}', CAST(p_partkey AS STRING)) AS entity_id,
 CASE WHEN p_partkey % 41 = {r41} THEN NULL ELSE concat(
   CASE WHEN p_partkey % 5 = {r5} THEN upper(p_name) ELSE p_name END, ' ', lower(p_type), ' ', CAST(p_partkey % 211 AS STRING),
   CASE (p_partkey + {shift}) % 9 WHEN 0 THEN ' Pvt. Ltd.' WHEN 1 THEN ', Inc.' WHEN 2 THEN ' Corporation' WHEN 3 THEN ' L.L.C.'
     WHEN 4 THEN ' & Company' WHEN 5 THEN ' dba Ring House' WHEN 6 THEN '/Group' WHEN 7 THEN ' Private Limited.' ELSE '' END) END AS business_name,
 CASE WHEN p_partkey % 37 = {r37} THEN NULL ELSE concat(
   CASE WHEN p_partkey % 6 = 0 THEN '' ELSE concat(CAST(p_partkey % 89 AS STRING), ' ') END, replace(p_brand, '#', ' '),
   CASE (p_partkey + {shift}) % 4 WHEN 0 THEN ' St.' WHEN 1 THEN ' Rd' WHEN 2 THEN ' N Ave' ELSE ' Blvd.' END,
   CASE WHEN p_partkey % 7 = 0 THEN ', Near Central Market Square' ELSE '' END,
   CASE WHEN p_partkey % 4 = 1 THEN concat(' ', CAST(400000 + p_partkey % 500 AS STRING)) ELSE '' END) END AS business_address,
 CASE p_partkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'india' WHEN 2 THEN ' India ' ELSE CASE WHEN p_partkey % 8 = 3 THEN 'France' ELSE 'US' END END AS country,
 p_partkey AS ordinal
FROM {{part}} WHERE {where}"""


SQL = {
    "raw_source1": _raw("S1-", 0, 0, 0, 0, "p_partkey % 2 = 0 OR p_partkey % 4 = 1 OR p_partkey % 8 = 3"),
    "raw_source2": _raw("S2-", 1, 1, 1, 0, "p_partkey % 3 <> 0"),
    "raw_source3": _raw("S3-", 2, 2, 2, 1, "p_partkey % 3 <> 1"),
    "ground_truth": """
SELECT concat('S1-', CAST(p_partkey AS STRING)) AS source1_entity_id,
 CASE WHEN p_partkey % 50 = 7 THEN NULL WHEN p_partkey % 50 = 8 THEN '   ' WHEN p_partkey % 50 = 9 THEN concat('S2-', CAST(p_partkey AS STRING), ',,S3-1')
  WHEN p_partkey % 50 = 10 THEN concat('X-', CAST(p_partkey AS STRING)) WHEN p_partkey % 3 = 0 THEN concat('S3-', CAST(p_partkey AS STRING))
  WHEN p_partkey % 3 = 1 THEN concat('S2-', CAST(p_partkey AS STRING))
  ELSE concat('S2-', CAST(p_partkey AS STRING), CASE WHEN p_partkey % 11 = 0 THEN ', ' ELSE ',' END, 'S3-', CAST(p_partkey AS STRING)) END AS matched_entity_ids
FROM {part}""",
    "candidates": """
SELECT concat('S1-', CAST(p_partkey AS STRING)) AS source1_entity_id,
 CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN concat('S2-', CAST(p_partkey AS STRING), ',S2-', CAST(p_partkey AS STRING), ',bad,S3-', CAST(p_partkey+1 AS STRING))
  ELSE concat('S2-', CAST(p_partkey AS STRING), ',S3-', CAST(p_partkey AS STRING), ',S2-', CAST(p_partkey + 3 AS STRING)) END AS candidate_entity_ids
FROM {part}""",
}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(SQL[name], part=spark.read.parquet(f"{sf_dir}/part.parquet"))
