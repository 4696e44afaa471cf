"""Tab-separated files, id lists and JSON reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave import config as cfg
from linkweave.functions.text import null_tokens

_FORMAT = {"sep": "\t", "header": True, "quote": '"', "escape": '"'}


def read_tsv(spark: SparkSession, path: str, null_values: tuple[str, ...] = (), multi_line: bool = False) -> DataFrame:
    """All columns as strings; null_values apply to whole values, quoted or not. Without them an empty field is ''.

    multi_line allows quoted line ends but keeps each file in one task, so large inputs should be many files.
    """
    df = spark.read.options(**_FORMAT, inferSchema=False, multiLine=multi_line, nullValue="\u0001", emptyValue="").csv(path)
    if null_values:
        return df.select(*(null_tokens(F.coalesce(F.col(f"`{c}`"), F.lit("")), null_values).alias(c) for c in df.columns))
    return df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, cfg.NULLS_RAW)


def read_split_input(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, cfg.NULLS_SPLIT)


def read_label_input(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, cfg.NULLS_LABEL)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Source-1 rows for candidate generation: nothing is null."""
    return read_tsv(spark, path)


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Scan order of a file just read; must come before anything that shuffles. Ordinals of several files have gaps."""
    return df.withColumn(name, F.monotonically_increasing_id())


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lines without their line ends; '' is left out, other white space is kept."""
    return spark.read.text(path).select(F.rtrim(F.col("value"), F.lit("\r\n")).alias("source1_entity_id")).where("source1_entity_id <> ''").distinct()


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    """Nulls and '' both as an empty field; an empty table still has a header. Task commits make it all or nothing."""
    writer = df.write.mode(mode).options(**_FORMAT, emptyValue="", nullValue="")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_id_list(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(F.col("source1_entity_id").cast("string")).write.mode(mode).text(path)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A report dictionary as one JSON file, on any file system that Spark can write to."""
    text = json.dumps(report, indent=2, ensure_ascii=False, default=str)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
