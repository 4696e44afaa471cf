"""Ground truth: classification, strata, reproducible split, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave import config as cfg
from linkweave.functions.text import strip
from linkweave.operators.cleaning import normalize_country


def source1_ids(s1: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Distinct stripped ids with the normalised country of their first row. Null and blank ids are left out; ties in the ordinal take the smaller country."""
    rows = s1.select(strip(F.col("entity_id")).alias("entity_id"), normalize_country(F.col("country")).alias("country_norm"), F.col(ordinal).alias("_o"))
    return (
        rows.where(F.col("entity_id") != "")
        .groupBy("entity_id")
        .agg(F.min(F.struct("_o", "country_norm"))["country_norm"].alias("country_norm"), F.count(F.lit(1)).alias("n_rows"))
    )


def duplicate_rows(s1: DataFrame, ordinal: str = "ordinal", chunk_size: int = cfg.CHUNK_SIZE) -> DataFrame:
    """Rows whose id occurred in an earlier chunk."""
    rows = s1.select(strip(F.col("entity_id")).alias("id"), F.floor(F.col(ordinal) / chunk_size).alias("chunk")).where(F.col("id") != "")
    per = rows.groupBy("id", "chunk").agg(F.count(F.lit(1)).alias("n")).groupBy("id")
    return per.agg((F.sum("n") - F.min(F.struct("chunk", "n"))["n"]).alias("late")).agg(F.coalesce(F.sum("late"), F.lit(0)).alias("duplicate_rows"))


def _row_type(ids: Column) -> Column:
    tokens = F.transform(F.split(ids, ",", -1), strip)
    singleton = ids.isNull() | (strip(ids) == "")
    valid = F.forall(tokens, lambda t: F.regexp_like(t, F.lit(cfg.MATCHED_ID_PATTERN)))
    return F.when(singleton, "singleton").when(valid, "matched").otherwise("malformed")


def classify(gt: DataFrame, ids: DataFrame) -> DataFrame:
    """gt plus row_type, missing_from_source1 and parsed_ids. Its ids are not stripped, those of ids are."""
    marked = gt.join(ids.select(F.col("entity_id").alias("source1_entity_id"), F.lit(True).alias("_known")), "source1_entity_id", "left")
    parsed = F.array_join(F.transform(F.split("matched_entity_ids", ",", -1), strip), ",")
    kind = _row_type(F.col("matched_entity_ids"))
    return marked.select(
        *gt.columns,
        kind.alias("row_type"),
        F.col("_known").isNull().alias("missing_from_source1"),
        F.when(kind == "matched", parsed).otherwise("").alias("parsed_ids"),
    )


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("row_type", "missing_from_source1").agg(F.count(F.lit(1)).alias("n"))


def class_examples(classified: DataFrame, n: int = 10) -> DataFrame:
    """(row_type, missing_from_source1, source1_entity_id): the n smallest ids of each class, a feature of the report. Only n ids of a class and partition meet."""
    rank = F.row_number().over(Window.partitionBy("row_type", "missing_from_source1").orderBy("source1_entity_id"))
    ids = classified.select("row_type", "missing_from_source1", "source1_entity_id").distinct()
    return ids.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def strata(classified: DataFrame, ids: DataFrame) -> DataFrame:
    """Splittable rows with country_norm and stratum."""
    rows = classified.where(F.col("row_type").isin("singleton", "matched") & ~F.col("missing_from_source1"))
    looked_up = rows.join(ids.select(F.col("entity_id").alias("source1_entity_id"), "country_norm"), "source1_entity_id", "left")
    country = F.coalesce("country_norm", F.lit("__unknown__"))
    return looked_up.withColumns({"country_norm": country, "stratum": F.concat(strip(F.lower(country)), F.lit("::"), F.col("row_type"))})


def stratum_sizes(stratified: DataFrame, fraction: float = cfg.VAL_FRACTION, min_size: int = cfg.MIN_STRATUM_SIZE) -> DataFrame:
    """Rows, validation rows (half to even) and whether all rows fall back to train, of each stratum."""
    n = stratified.groupBy("stratum").agg(F.count(F.lit(1)).alias("total"))
    wanted = F.rint(F.col("total") * F.lit(fraction)).cast("long")
    fallback = (F.col("total") < min_size) | (wanted == 0)
    n_val = F.when(fallback, F.lit(0)).otherwise(wanted).cast("long")
    return n.select("stratum", "total", n_val.alias("n_val"), (F.col("total") - n_val).alias("n_train"), fallback.alias("fallback"))


def stratified_split(stratified: DataFrame, fraction: float = cfg.VAL_FRACTION, seed: int = cfg.SEED, min_size: int = cfg.MIN_STRATUM_SIZE) -> DataFrame:
    """stratified plus split; within a stratum the rows with the smallest seeded digests are validation.

    One stratum may hold most rows, so no window runs over it: sizes come from a pre-aggregation, and the cut within a stratum is found
    on counts by digest prefix, so that only the rows of one prefix are ranked.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source1_entity_id", F.lit("")), F.lit(":"), F.coalesce("matched_entity_ids", F.lit(""))))
    keyed = stratified.withColumn("_d", digest).withColumn("_p", F.substring("_d", 1, 3))
    per_prefix = keyed.groupBy("stratum", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("stratum").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        per_prefix.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(stratum_sizes(stratified, fraction, min_size).select("stratum", "n_val"), "stratum")
        .select("stratum", "_p", (F.col("n_val") - F.col("_before")).alias("_left"), "_n")
    )
    within = Window.partitionBy("stratum", "_p").orderBy("_d", "source1_entity_id", F.coalesce("matched_entity_ids", F.lit("")))
    ranked = keyed.join(cuts, ["stratum", "_p"]).withColumn("_r", F.row_number().over(within))
    return ranked.withColumn("split", F.when(F.col("_r") <= F.col("_left"), "val").otherwise("train")).drop("_d", "_p", "_left", "_n", "_r")


def split_summary(split: DataFrame) -> DataFrame:
    """Rows by split, country and row type."""
    return split.groupBy("split", "country_norm", "row_type").agg(F.count(F.lit(1)).alias("n"))


def subset(gt: DataFrame, ids: DataFrame) -> DataFrame:
    """The two original columns of all rows of gt whose id is listed, malformed rows included."""
    return gt.join(ids.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi").select("source1_entity_id", "matched_entity_ids")
