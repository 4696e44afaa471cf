"""Command line: clean, split, candidates and label, each on files."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from linkweave import config as cfg
from linkweave.config import CandidateConfig, PoolSource, PoolSpec
from linkweave.operators import blocking as B
from linkweave.operators import cleaning as C
from linkweave.operators import ground_truth as G
from linkweave.operators import labeling as L
from linkweave.sources import pool_store, tsv

log = logging.getLogger("linkweave")


def clean(spark: SparkSession, a: argparse.Namespace) -> None:
    """A missing input is reported and skipped."""
    for label, path in (s.split("=", 1) for s in a.source):
        if not pool_store.exists(spark, path):
            log.warning("%s: %s is missing", label, path)
            continue
        raw = tsv.with_ordinal(tsv.read_raw(spark, path))
        if a.limit is not None:
            raw = raw.orderBy("ordinal").limit(a.limit)
        tsv.write_tsv(C.clean_records(raw).drop("ordinal"), f"{a.output}/cleaned_{label}", "overwrite")
        tsv.write_report(spark, C.quality_report(raw, label, F.col("ordinal"), a.chunk_size), f"{a.output}/{label}_quality_report.json")


def split(spark: SparkSession, a: argparse.Namespace) -> None:
    if cfg.normalize_mode(a.mode) == "test":
        raise SystemExit("the test mode has no ground truth to split")
    s1 = tsv.with_ordinal(tsv.read_split_input(spark, a.source1))
    gt = tsv.read_split_input(spark, a.ground_truth)
    ids = G.source1_ids(s1)
    classified = G.classify(gt, ids)
    strata = G.strata(classified, ids)
    done = G.stratified_split(strata, a.val_fraction, a.seed, a.min_stratum_size)
    for name in ("train", "val"):
        part = done.where(F.col("split") == name).select("source1_entity_id").distinct()
        tsv.write_id_list(part, f"{a.output}/{name}_ids", "overwrite")
        tsv.write_tsv(G.subset(gt, part), f"{a.output}/{name}_ground_truth", "overwrite")
    report = {
        "duplicate_rows": G.duplicate_rows(s1, chunk_size=a.chunk_size).first()[0],
        "classes": [r.asDict() for r in G.class_counts(classified).toLocalIterator()],
        "class_examples": [r.asDict() for r in G.class_examples(classified).toLocalIterator()],
        "strata": [r.asDict() for r in G.stratum_sizes(strata, a.val_fraction, a.min_stratum_size).toLocalIterator()],
        "splits": [r.asDict() for r in G.split_summary(done).toLocalIterator()],
    }
    tsv.write_report(spark, report, f"{a.output}/split_summary.json")


def candidates(spark: SparkSession, a: argparse.Namespace) -> None:
    off = {s for s in cfg.STRATEGIES if getattr(a, f"disable_{s}")}
    config = CandidateConfig(
        tuple(s for s in cfg.STRATEGIES if s not in off), None if a.max_candidates == 0 else a.max_candidates, a.exact_limit, a.address_key_max_frequency,
        a.fuzzy_prefix_length, a.fuzzy_block_limit, a.fuzzy_top_k, a.fuzzy_threshold, a.name_anchor_min_length,
    )
    if a.smoke_test and a.limit is None:
        raise SystemExit("--smoke-test needs --limit")
    country = a.ensure_country or ("France" if a.smoke_test and cfg.normalize_mode(a.mode) == "test" else None)
    spec = PoolSpec(cfg.normalize_mode(a.mode), PoolSource("S2", a.source2), PoolSource("S3", a.source3))
    pool = pool_store.ensure_pool(spark, a.pool, spec, a.build_pool, a.rebuild_pool)
    s1 = tsv.with_ordinal(tsv.read_queries(spark, a.source1))
    if a.limit is not None:
        s1 = B.select_rows(s1.withColumn("country", F.col("country_norm")), a.limit, country, a.ensure_country_count if country else 0).drop("ordinal").withColumnRenamed("slot", "ordinal")
    B.check_queries(s1)
    lists = B.candidate_lists(s1, B.generate_candidates(s1, pool, config))
    tsv.write_tsv(lists.select("source1_entity_id", "candidate_entity_ids"), a.output, "overwrite" if a.overwrite else "errorifexists")
    written = tsv.read_queries(spark, a.output).withColumn("n_candidates", F.when(F.col("candidate_entity_ids") == "", 0).otherwise(F.size(F.split("candidate_entity_ids", ","))))
    tsv.write_report(spark, B.generation_report(written, config.max_candidates).first().asDict(), f"{a.output}.report.json")


def label(spark: SparkSession, a: argparse.Namespace) -> None:
    train, val = (tsv.read_id_list(spark, f"{a.split_dir}/{n}_ids") for n in ("train", "val"))
    L.check_split_overlap(train, val)
    splits = L.split_frame(train, val)
    gt = tsv.read_label_input(spark, f"{a.split_dir}/train_ground_truth").unionByName(tsv.read_label_input(spark, f"{a.split_dir}/val_ground_truth"))
    found = tsv.read_label_input(spark, a.candidates)
    truth = L.true_pairs(gt)
    labeled = L.label_pairs(found, splits, truth)
    s1 = L.first_by_id(tsv.with_ordinal(tsv.read_label_input(spark, a.source1)), F.col("ordinal"), ["business_name_norm", "business_address_norm", "country_norm"])
    features = L.pair_features(labeled, s1, pool_store.open_pool(spark, a.pool), a.country_match)
    columns = ["source1_entity_id", "candidate_entity_id", "source", "name_similarity", "address_similarity", "country_match", "label"]
    tsv.write_tsv(features.select(*columns, "split"), f"{a.output}/pairs", "overwrite", ("split",))
    report = {
        "validation": L.validate_candidates(found, splits).first().asDict(),
        "blank_tokens": L.blank_tokens(gt).first()[0],
        "class_balance": [r.asDict() for r in L.class_balance(labeled).toLocalIterator()],
        "blocking_recall": [r.asDict() for r in L.blocking_recall(truth, labeled, splits).toLocalIterator()],
        "zero_candidates": [r.asDict() for r in L.zero_candidates(found, truth, splits).toLocalIterator()],
        "missing_records": L.missing_records(features).first().asDict(),
    }
    tsv.write_report(spark, report, f"{a.output}/report.json")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linkweave", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--source", action="append", required=True, metavar="LABEL=PATH")
    c.add_argument("--output", required=True)
    c.add_argument("--limit", type=int)
    c.add_argument("--chunk-size", type=int, default=cfg.CHUNK_SIZE)
    s = sub.add_parser("split")
    for name in ("--source1", "--ground-truth", "--output"):
        s.add_argument(name, required=True)
    s.add_argument("--mode", default="train")
    s.add_argument("--val-fraction", type=float, default=cfg.VAL_FRACTION)
    s.add_argument("--seed", type=int, default=cfg.SEED)
    s.add_argument("--min-stratum-size", type=int, default=cfg.MIN_STRATUM_SIZE)
    s.add_argument("--chunk-size", type=int, default=cfg.CHUNK_SIZE)
    g = sub.add_parser("candidates")
    for name in ("--source1", "--source2", "--source3", "--pool", "--output"):
        g.add_argument(name, required=True)
    g.add_argument("--mode", default="train")
    g.add_argument("--limit", type=int)
    g.add_argument("--ensure-country")
    g.add_argument("--ensure-country-count", type=int, default=1)
    for name in ("--smoke-test", "--build-pool", "--rebuild-pool", "--overwrite", *(f"--disable-{x.replace('_', '-')}" for x in cfg.STRATEGIES)):
        g.add_argument(name, action="store_true")
    for name in ("max_candidates", "exact_limit", "address_key_max_frequency", "fuzzy_prefix_length", "fuzzy_block_limit", "fuzzy_top_k", "fuzzy_threshold", "name_anchor_min_length"):
        default = getattr(CandidateConfig, name)
        g.add_argument(f"--{name.replace('_', '-')}", type=type(default), default=default)
    b = sub.add_parser("label")
    for name in ("--candidates", "--split-dir", "--source1", "--pool", "--output"):
        b.add_argument(name, required=True)
    b.add_argument("--country-match", choices=("casefold", "reference"), default="casefold")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 after an error of the data, 130 after an interrupt."""
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    try:
        {"clean": clean, "split": split, "candidates": candidates, "label": label}[a.command](spark or SparkSession.builder.appName("linkweave").getOrCreate(), a)
    except KeyboardInterrupt:
        return 130
    except (cfg.PoolValidationError, cfg.CandidateGenerationError, ValueError) as e:
        log.error("%s", e)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
