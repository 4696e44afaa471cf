"""Candidate validation, labels, pair features and blocking recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.functions.similarity import pair_ratio
from linkweave.functions.text import casefold, strip

VALID_PREFIX = "^S[23]-"


def check_split_overlap(train: DataFrame, val: DataFrame) -> None:
    n = train.select("source1_entity_id").join(val.select("source1_entity_id"), "source1_entity_id", "left_semi").count()
    if n:
        raise ValueError(f"{n} source-1 ids are in both splits")


def split_frame(train: DataFrame, val: DataFrame) -> DataFrame:
    """Distinct (source1_entity_id, split)."""
    return train.select("source1_entity_id", F.lit("train").alias("split")).unionByName(val.select("source1_entity_id", F.lit("val").alias("split"))).distinct()


def true_pairs(gt: DataFrame, strip_tokens: bool = False) -> DataFrame:
    """Distinct (source1_entity_id, candidate_entity_id) of the listed matches; blank tokens are left out. Tokens keep their white space unless strip_tokens."""
    token = F.explode(F.split("matched_entity_ids", ",", -1)).alias("candidate_entity_id")
    rows = gt.where(F.col("matched_entity_ids").isNotNull()).select("source1_entity_id", token).where(strip(F.col("candidate_entity_id")) != "")
    if strip_tokens:
        rows = rows.withColumn("candidate_entity_id", strip(F.col("candidate_entity_id")))
    return rows.distinct()


def blank_tokens(gt: DataFrame) -> DataFrame:
    """One row: how many blank tokens the lists of matches hold; a list that is blank as a whole holds none."""
    tokens = F.filter(F.split("matched_entity_ids", ",", -1), lambda t: strip(t) == "")
    return gt.where(strip(F.col("matched_entity_ids")) != "").agg(F.coalesce(F.sum(F.size(tokens)), F.lit(0)).cast("long").alias("blank_tokens"))


def candidate_tokens(candidates: DataFrame, splits: DataFrame) -> DataFrame:
    """(source1_entity_id, split, candidate_entity_id) of all tokens of rows that belong to a split."""
    rows = candidates.join(splits, "source1_entity_id").where(F.coalesce("candidate_entity_ids", F.lit("")) != "")
    return rows.select("source1_entity_id", "split", F.explode(F.split("candidate_entity_ids", ",", -1)).alias("candidate_entity_id"))


def validate_candidates(candidates: DataFrame, splits: DataFrame) -> DataFrame:
    """One row of counts: malformed and repeated tokens, orphan rows and their tokens, rows kept, ids without candidates."""
    known = splits.select("source1_entity_id", F.lit(1).alias("_known")).distinct()
    rows = candidates.join(known, "source1_entity_id", "left").withColumn("_l", F.coalesce("candidate_entity_ids", F.lit("")))
    tokens = F.filter(F.split("_l", ",", -1), lambda t: t != "")
    counted = rows.agg(
        F.count_if(F.col("_known").isNull()).alias("orphan_rows"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.size(tokens))), F.lit(0)).cast("long").alias("orphan_pairs"),
        F.count("_known").alias("rows_after_orphan_filter"),
        F.count_distinct(F.when(F.col("_known").isNotNull() & (F.col("_l") == ""), F.col("source1_entity_id"))).alias("zero_candidate_ids"),
    )
    per_pair = candidate_tokens(candidates, splits).groupBy("source1_entity_id", "candidate_entity_id").agg(F.count(F.lit(1)).alias("n"))
    bad = per_pair.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(~F.regexp_like("candidate_entity_id", F.lit(VALID_PREFIX)), F.col("n"))), F.lit(0)).alias("malformed"),
    )
    return counted.crossJoin(F.broadcast(bad))  # one row each


def label_pairs(candidates: DataFrame, splits: DataFrame, truth: DataFrame) -> DataFrame:
    """Distinct well-prefixed pairs with split, source and label."""
    pairs = candidate_tokens(candidates, splits).where(F.regexp_like("candidate_entity_id", F.lit(VALID_PREFIX))).distinct()
    marked = pairs.join(truth.withColumn("_true", F.lit(1)), ["source1_entity_id", "candidate_entity_id"], "left")
    return marked.select(
        "source1_entity_id", "candidate_entity_id", "split",
        F.substring("candidate_entity_id", 1, 2).alias("source"), F.coalesce("_true", F.lit(0)).cast("int").alias("label"),
    )


def first_by_id(df: DataFrame, order: Column, columns: list[str]) -> DataFrame:
    """The first row of each entity_id by order; partial aggregation happens before the shuffle."""
    return df.groupBy("entity_id").agg(F.min_by(F.struct(*columns), order).alias("r")).select("entity_id", "r.*")


def pair_features(labeled: DataFrame, s1: DataFrame, pool: DataFrame, country_match: str = "casefold") -> DataFrame:
    """labeled plus name_similarity, address_similarity, country_match and whether either record is missing.

    s1: entity_id (unique), business_name_norm, business_address_norm, country_norm. country_match 'reference' compares as written, where
    source 1 has title case and the pool does not; 'casefold' compares regardless of case.
    """
    left = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("business_name_norm").alias("_n1"), F.col("business_address_norm").alias("_a1"), F.col("country_norm").alias("_c1"), F.lit(1).alias("_f1"))
    right = pool.select(F.col("entity_id").alias("candidate_entity_id"), F.col("name").alias("_n2"), F.col("address").alias("_a2"), F.col("country").alias("_c2"), F.lit(1).alias("_f2"))
    rows = labeled.join(left, "source1_entity_id", "left").join(right, "candidate_entity_id", "left")
    c1, c2 = F.coalesce("_c1", F.lit("")), F.coalesce("_c2", F.lit(""))
    if country_match == "casefold":
        c1, c2 = casefold(c1), casefold(c2)
    elif country_match != "reference":
        raise ValueError("country_match must be 'casefold' or 'reference'")
    return rows.select(
        *labeled.columns,
        pair_ratio(F.col("_n1"), F.col("_n2")).alias("name_similarity"),
        pair_ratio(F.col("_a1"), F.col("_a2")).alias("address_similarity"),
        ((c1 != "") & (c2 != "") & (c1 == c2)).cast("int").alias("country_match"),
        F.col("_f1").isNull().alias("missing_source1"),
        F.col("_f2").isNull().alias("missing_candidate"),
    )


def class_balance(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def blocking_recall(truth: DataFrame, labeled: DataFrame, splits: DataFrame) -> DataFrame:
    """Per split: true pairs, those among the candidates, their share (1 without true pairs), missed pairs, ids with a missed pair."""
    seen = labeled.where("label = 1").select("source1_entity_id", "candidate_entity_id", F.lit(1).alias("_seen"))
    rows = truth.join(splits, "source1_entity_id").join(seen, ["source1_entity_id", "candidate_entity_id"], "left")
    per_id = rows.groupBy("split", "source1_entity_id").agg(F.count(F.lit(1)).alias("n"), F.count("_seen").alias("k"))
    out = per_id.groupBy("split").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count_if(F.col("n") > F.col("k")).alias("ids"))
    all_splits = splits.select("split").distinct().join(out, "split", "left")
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("k", F.lit(0))
    recall = F.when(n == 0, F.lit(1.0)).otherwise(k.cast("double") / F.greatest(n, F.lit(1)).cast("double"))
    return all_splits.select(
        "split", n.alias("true_pairs"), k.alias("observed_pairs"), recall.alias("recall"), (n - k).alias("missed_pairs"), F.coalesce("ids", F.lit(0)).alias("ids_with_missed")
    )


def missed_pairs(truth: DataFrame, labeled: DataFrame, splits: DataFrame) -> DataFrame:
    seen = labeled.where("label = 1").select("source1_entity_id", "candidate_entity_id")
    return truth.join(splits, "source1_entity_id").join(seen, ["source1_entity_id", "candidate_entity_id"], "left_anti").select("split", "source1_entity_id", "candidate_entity_id")


def zero_candidates(candidates: DataFrame, truth: DataFrame, splits: DataFrame) -> DataFrame:
    """Ids without candidates by split and by whether the ground truth has matches for them, with the smallest 20 as a sample."""
    empty = candidates.where(F.coalesce("candidate_entity_ids", F.lit("")) == "").join(splits, "source1_entity_id").select("source1_entity_id", "split").distinct()
    matched = truth.select("source1_entity_id", F.lit(1).alias("_m")).distinct()
    rows = empty.join(matched, "source1_entity_id", "left").withColumn("kind", F.when(F.col("_m").isNotNull(), "matched").otherwise("singleton"))
    rank = F.row_number().over(Window.partitionBy("split", "kind").orderBy("source1_entity_id"))  # limited before the shuffle
    first = rows.withColumn("_r", rank).where(F.col("_r") <= 20).groupBy("split", "kind")
    samples = first.agg(F.array_join(F.array_sort(F.collect_list("source1_entity_id")), ",").alias("sample_ids"))
    return rows.groupBy("split", "kind").agg(F.count(F.lit(1)).alias("n")).join(samples, ["split", "kind"])


def missing_records(features: DataFrame) -> DataFrame:
    return features.agg(F.count_if(F.col("missing_source1")).alias("missing_source1_records"), F.count_if(F.col("missing_candidate")).alias("missing_candidate_records"))


def split_pairs(labeled: DataFrame, split: str) -> DataFrame:
    return labeled.where(F.col("split") == split)
