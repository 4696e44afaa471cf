"""Queries over the derived pipeline inputs and the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.config import CandidateConfig
from linkweave.functions import keys
from linkweave.functions.similarity import pair_ratio, ratio_udf, token_set_ratio_udf
from linkweave.functions.text import clean_scalar
from linkweave.operators import blocking as B
from linkweave.operators import cleaning as C
from linkweave.operators import ground_truth as G
from linkweave.operators import labeling as L
from linkweave.operators import packed
from linkweave.operators import pool as P
from linkweave.plans.lineage import Scratch
from linkweave.sources.derived import derived

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CONFIG = CandidateConfig()


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def cleaned(spark: SparkSession, d: str, n: int) -> DataFrame:
    """A cleaned source. Its rows are spread first: cleaning is a hundred patterns a row, and the file of a small table is one partition."""
    return C.clean_records(derived(spark, d, f"raw_source{n}").repartition(4 * spark.sparkContext.defaultParallelism, "ordinal"))


def pool(spark: SparkSession, d: str) -> DataFrame:
    return P.build_pool({"S2": cleaned(spark, d, 2), "S3": cleaned(spark, d, 3)})


def lookups(spark: SparkSession, d: str) -> DataFrame:
    return B.query_rows(cleaned(spark, d, 1))


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return G.classify(derived(spark, d, "ground_truth"), G.source1_ids(derived(spark, d, "raw_source1")))


def _strata(spark: SparkSession, d: str) -> DataFrame:
    ids = G.source1_ids(derived(spark, d, "raw_source1"))
    return G.strata(G.classify(derived(spark, d, "ground_truth"), ids), ids)


def _split(spark: SparkSession, d: str) -> DataFrame:
    return G.stratified_split(_strata(spark, d))


def _splits(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).select("source1_entity_id", "split").distinct()


def _truth(spark: SparkSession, d: str) -> DataFrame:
    return L.true_pairs(derived(spark, d, "ground_truth"))


def _labeled(spark: SparkSession, d: str) -> DataFrame:
    return L.label_pairs(derived(spark, d, "candidates"), _splits(spark, d), _truth(spark, d))


def _features(spark: SparkSession, d: str) -> DataFrame:
    s1 = L.first_by_id(cleaned(spark, d, 1), F.col("ordinal"), ["business_name_norm", "business_address_norm", "country_norm"])
    return L.pair_features(_labeled(spark, d), s1, pool(spark, d))


# cleaning


@query
def q_clean_country(spark, d):
    return cleaned(spark, d, 1).select("entity_id", "country", "country_norm")


@query
def q_clean_name_norm(spark, d):
    return cleaned(spark, d, 1).select("entity_id", "business_name_norm")


@query
def q_name_core(spark, d):
    return cleaned(spark, d, 1).select("entity_id", "business_name_core")


@query
def q_name_alt(spark, d):
    return cleaned(spark, d, 1).select("entity_id", "business_name_alt")


@query
def q_address_norm(spark, d):
    return cleaned(spark, d, 1).select("entity_id", "business_address_norm")


@query
def q_landmark(spark, d):
    return cleaned(spark, d, 1).select("entity_id", "business_address_landmark")


@query
def q_quality_counts(spark, d):
    return C.quality_counts(cleaned(spark, d, 1))


@query
def q_quality_country_dist(spark, d):
    return C.country_distribution(derived(spark, d, "raw_source1"))


@query
def q_quality_dup_ids(spark, d):
    rows = spark.read.parquet(f"{d}/records.parquet").select("entity_id", F.col("row_ordinal").alias("ordinal"))
    return C.duplicate_ids(rows, F.col("ordinal"), 500)


# ground truth and split


@query
def q_source1_ids(spark, d):
    rows = spark.read.parquet(f"{d}/records.parquet").select("entity_id", F.col("country_norm").alias("country"), F.col("row_ordinal").alias("ordinal"))
    return G.source1_ids(rows)


@query
def q_source1_duplicate_rows(spark, d):
    rows = spark.read.parquet(f"{d}/records.parquet").select("entity_id", F.col("row_ordinal").alias("ordinal"))
    return G.duplicate_rows(rows, chunk_size=500)


@query
def q_gt_classify(spark, d):
    return _classified(spark, d)


@query
def q_gt_missing(spark, d):
    return _classified(spark, d).where("missing_from_source1").select("source1_entity_id")


@query
def q_gt_class_counts(spark, d):
    return G.class_counts(_classified(spark, d))


@query
def q_strata_counts(spark, d):
    return G.stratum_sizes(_strata(spark, d))


@query
def q_strata_counts_small(spark, d):
    return G.stratum_sizes(_strata(spark, d), min_size=11)


@query
def q_split_assign(spark, d):
    return _split(spark, d).select("source1_entity_id", "stratum", "split")


@query
def q_split_summary(spark, d):
    return G.split_summary(_split(spark, d))


@query
def q_gt_subset(spark, d):
    return G.subset(derived(spark, d, "ground_truth"), _splits(spark, d).where("split = 'val'"))


# pool and blocking


@query
def q_pool(spark, d):
    return pool(spark, d)


@query
def q_pool_errors(spark, d):
    return P.pool_errors(pool(spark, d))


@query
def q_pool_rows_by_source(spark, d):
    return P.rows_by_source(pool(spark, d))


@query
def q_exact_name(spark, d):
    return B.exact_name(lookups(spark, d), pool(spark, d), CONFIG)


@query
def q_exact_name_alt(spark, d):
    return B.exact_name_alt(lookups(spark, d), pool(spark, d), CONFIG)


@query
def q_exact_address(spark, d):
    return B.exact_address(lookups(spark, d), pool(spark, d), CONFIG)


@query
def q_address_keys_index(spark, d):
    return P.address_key_index(pool(spark, d))


@query
def q_address_keys_query(spark, d):
    return lookups(spark, d).select("row_id", F.explode(keys.address_keys_query(F.col("address"))).alias("key"))


@query
def q_address_key_freq(spark, d):
    return P.key_frequencies(P.address_key_index(pool(spark, d)))


@query
def q_address_key_candidates(spark, d):
    return B.address_key(lookups(spark, d), pool(spark, d), CandidateConfig(address_key_max_frequency=10))


@query
def q_name_anchor(spark, d):
    return P.name_anchor_index(pool(spark, d))


@query
def q_prefix_block(spark, d):
    return B.prefix_block(lookups(spark, d), pool(spark, d), CandidateConfig(fuzzy_block_limit=50))


@query
def q_anchor_block(spark, d):
    return B.anchor_block(lookups(spark, d), pool(spark, d), CandidateConfig(fuzzy_block_limit=50))


def _pair_names(spark, d):
    return _labeled(spark, d).select("source1_entity_id", "candidate_entity_id").join(
        cleaned(spark, d, 1).select(F.col("entity_id").alias("source1_entity_id"), clean_scalar(F.col("business_name_norm")).alias("a")), "source1_entity_id"
    ).join(pool(spark, d).select(F.col("entity_id").alias("candidate_entity_id"), F.col("name").alias("b")), "candidate_entity_id")


@query
def q_ratio(spark, d):
    return _pair_names(spark, d).select("source1_entity_id", "candidate_entity_id", F.round(ratio_udf("a", "b"), 6).alias("score"))


@query
def q_token_set_ratio(spark, d):
    return _pair_names(spark, d).select("source1_entity_id", "candidate_entity_id", F.round(token_set_ratio_udf("a", "b"), 6).alias("score"))


@query
def q_fuzzy_candidates(spark, d):
    scratch = Scratch(spark, "fuzzy")
    return B.fuzzy_name(scratch.write(lookups(spark, d)), scratch.write(pool(spark, d)), CONFIG).withColumn("score", F.round("score", 6))


_NO_FUZZY = CandidateConfig(enabled_strategies=("exact_name", "exact_name_alt", "exact_address", "address_key"), max_candidates=20)


@query
def q_merge(spark, d):
    return B.generate_candidates(cleaned(spark, d, 1), pool(spark, d), _NO_FUZZY).select("row_id", "entity_id", "strategy", "rank")


def _lists(spark, d, config):
    s1 = Scratch(spark, "cleaned").write(cleaned(spark, d, 1))
    return B.candidate_lists(s1, B.generate_candidates(s1, pool(spark, d), config))


@query
def q_candidate_lists(spark, d):
    return _lists(spark, d, CONFIG)


@query
def q_candidate_lists_exact(spark, d):
    return _lists(spark, d, _NO_FUZZY)


@query
def q_generation_report(spark, d):
    return B.generation_report(_lists(spark, d, _NO_FUZZY), 20)


@query
def q_smoke_selector(spark, d):
    return B.select_rows(derived(spark, d, "raw_source1"), 50, "france", 12).select("slot", "entity_id", "country")


# labelling


@query
def q_gt_class_examples(spark, d):
    return G.class_examples(_classified(spark, d))


@query
def q_gt_blank_tokens(spark, d):
    return L.blank_tokens(derived(spark, d, "ground_truth"))


@query
def q_candidate_validation(spark, d):
    return L.validate_candidates(derived(spark, d, "candidates"), _splits(spark, d))


@query
def q_true_pairs(spark, d):
    return _truth(spark, d)


@query
def q_labeled_pairs(spark, d):
    return _labeled(spark, d)


@query
def q_pair_features(spark, d):
    f = _features(spark, d)
    return f.withColumns({c: F.round(c, 6) for c in ("name_similarity", "address_similarity")})


@query
def q_class_balance(spark, d):
    return L.class_balance(_labeled(spark, d))


@query
def q_blocking_recall(spark, d):
    return L.blocking_recall(_truth(spark, d), _labeled(spark, d), _splits(spark, d)).withColumn("recall", F.round("recall", 9))


@query
def q_missed_pairs(spark, d):
    return L.missed_pairs(_truth(spark, d), _labeled(spark, d), _splits(spark, d))


@query
def q_zero_candidates(spark, d):
    return L.zero_candidates(derived(spark, d, "candidates"), _truth(spark, d), _splits(spark, d))


@query
def q_missing_records(spark, d):
    return L.missing_records(_features(spark, d))


@query
def q_record_pair_similarity(spark, d):
    """Name similarity of all judged pairs over the given records and pool."""
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    plain = packed.id_plain_form
    pairs = read("train_pairs").select(plain(F.col("source1_entity_id")).alias("s"), plain(F.col("candidate_entity_id")).alias("c")).distinct()
    first = L.first_by_id(read("records"), F.col("row_ordinal"), ["business_name_norm"])
    rows = pairs.join(first.select(F.col("entity_id").alias("s"), F.col("business_name_norm").alias("a")), "s").join(
        read("pool").select(F.col("entity_id").alias("c"), F.col("name").alias("b")), "c"
    )
    return rows.select("s", "c", F.round(pair_ratio(F.col("a"), F.col("b")), 6).alias("name_similarity"))


# several values in one field


def p2_found(spark, d):
    tables = (("candidate_pairs", "candidate_entity_ids"), ("train_matches", "matched_entity_ids"))
    parts = [
        packed.split_packed(spark.read.parquet(f"{d}/{t}.parquet"), field, ["row_ordinal"], "entity_id").select(F.lit(t).alias("src_table"), "row_ordinal", "pos_no", "entity_id")
        for t, field in tables
    ]
    return parts[0].unionByName(parts[1])


QUERIES["p2_found"] = p2_found
