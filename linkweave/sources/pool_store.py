"""Stored pools: Parquet tables with a manifest that tells what they were built from."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave import config as cfg
from linkweave.config import CandidateGenerationError, PoolSpec, PoolValidationError
from linkweave.operators import pool as P
from linkweave.sources.tsv import read_tsv, write_report

TABLES = ("pool", "address_keys", "name_anchor")


def file_fingerprint(spark: SparkSession, path: str) -> dict[str, str]:
    """Rows (lines but each file's header), bytes and a digest of a file or folder: the sum of the lines' hashes, so that files of any size are read in parallel."""
    lines = spark.read.text(path)
    per_line = lines.select(F.xxhash64("value").cast("decimal(38,0)").alias("h"), F.octet_length("value").cast("long").alias("b"), F.input_file_name().alias("f"))
    row = per_line.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h"), F.sum("b").alias("b"), F.count_distinct("f").alias("f")).first()
    return {"rows": str(row["n"] - row["f"]), "bytes": str(row["b"] or 0), "digest": str(row["h"] or 0)}


def expected_manifest(spark: SparkSession, spec: PoolSpec) -> dict[str, str]:
    out = {"schema_version": cfg.POOL_SCHEMA_VERSION, "mode": cfg.normalize_mode(spec.mode)}
    for key, source in (("source2", spec.source2), ("source3", spec.source3)):
        out |= {f"{key}_name": source.source_name, f"{key}_path": source.path}
        out |= {f"{key}_{k}": v for k, v in file_fingerprint(spark, source.path).items()}
    return out


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def read_manifest(spark: SparkSession, path: str) -> dict[str, str]:
    return json.loads(spark.read.text(f"{path}/manifest.json", wholetext=True).first()[0])


def write_pool(spark: SparkSession, pool: DataFrame, path: str, manifest: dict[str, str]) -> None:
    """Pool, address keys and anchors beside the target, checked, then put in its place."""
    building = f"{path}.building"
    pool.write.mode("overwrite").parquet(f"{building}/pool")
    stored = spark.read.parquet(f"{building}/pool")
    P.check_pool(stored)
    P.address_key_index(stored).write.mode("overwrite").parquet(f"{building}/address_keys")
    P.name_anchor_index(stored).write.mode("overwrite").parquet(f"{building}/name_anchor")
    write_report(spark, manifest, f"{building}/manifest.json")
    source, fs = _path(spark, building)
    target, _ = _path(spark, path)
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise CandidateGenerationError(f"{building} can't be moved to {path}")


def validate_pool(spark: SparkSession, path: str, spec: PoolSpec) -> None:
    """Raises with all differences between the stored manifest and what spec asks for."""
    if not exists(spark, f"{path}/manifest.json"):
        raise PoolValidationError(f"{path} has no manifest")
    have, want = read_manifest(spark, path), expected_manifest(spark, spec)
    wrong = [f"{k}: {have.get(k)!r} instead of {v!r}" for k, v in want.items() if have.get(k) != v]
    wrong += [f"table {t} is missing" for t in TABLES if not exists(spark, f"{path}/{t}")]
    if wrong:
        raise PoolValidationError("; ".join(wrong))


def open_pool(spark: SparkSession, path: str, spec: PoolSpec | None = None) -> DataFrame:
    if spec is not None:
        validate_pool(spark, path, spec)
    pool = spark.read.parquet(f"{path}/pool")
    P.check_columns(pool, P.POOL_COLUMNS)
    return pool


def ensure_pool(spark: SparkSession, path: str, spec: PoolSpec, build: bool = False, rebuild: bool = False) -> DataFrame:
    """The stored pool if it is the right one; else it is built where build or rebuild allows that."""
    if not rebuild and exists(spark, path):
        return open_pool(spark, path, spec)
    if not (build or rebuild):
        raise PoolValidationError(f"there is no pool at {path}")
    cleaned = {s.source_name: read_tsv(spark, s.path) for s in (spec.source2, spec.source3)}
    write_pool(spark, P.build_pool(cleaned), path, expected_manifest(spark, spec))
    return open_pool(spark, path, spec)
