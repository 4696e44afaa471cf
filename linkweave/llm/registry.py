"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import abuse, components, entity_matching, location_links, mixing, name_links, packing, sampling, splits
from linkweave.llm.tokens import with_token_counts
from linkweave.plans.lineage import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _read(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{d}/{n}.parquet") for n in names]


@query
def p1_found(spark, d):
    return splits.shared_keys(splits.split_keys(*_read(spark, d, "train_matches", "train_pairs")))


@query
def p1_splits(spark, d):
    return splits.split_keys(*_read(spark, d, "train_matches", "train_pairs"))


@query
def p1_report(spark, d):
    matches, pairs = _read(spark, d, "train_matches", "train_pairs")
    return splits.split_report(matches, pairs, splits.split_keys(matches, pairs))


@query
def p3_found(spark, d):
    return components.linked_records(*_read(spark, d, "train_pairs"), "source1_entity_id", "candidate_entity_id")


def _availability(spark, d):
    """Countries of the records and what is available of each, written: the draw and its report read them several times."""
    scratch = Scratch(spark, "targets")
    countries = scratch.write(sampling.record_countries(*_read(spark, d, "train_matches", "records", "country_alias")))
    return countries, scratch.write(sampling.availability(countries, *_read(spark, d, "country_targets")))


@query
def p4_sample(spark, d):
    return sampling.draw_sample(*_availability(spark, d))


@query
def p4_report(spark, d):
    countries, report = _availability(spark, d)
    return sampling.sample_report(report, sampling.draw_sample(countries, report))


@query
def p4_found(spark, d):
    return p4_report(spark, d).where("drawn < needed").select("country")


@query
def p5_found(spark, d):
    return name_links.same_name_pairs(*_read(spark, d, "records", "pool"))


@query
def p6_found(spark, d):
    return location_links.same_location_pairs(*_read(spark, d, "records", "pool", "country_alias"))


@query
def p6_locations(spark, d):
    rows = location_links.addressed_rows(*_read(spark, d, "records", "pool", "country_alias"))
    return location_links.resolve_locations(rows, Scratch(spark, "locations"))


@query
def p7_matches(spark, d):
    return entity_matching.match_entities(*_read(spark, d, "records", "pool", "train_matches", "country_alias"))


@query
def p7_found(spark, d):
    records, pool, matches, alias = _read(spark, d, "records", "pool", "train_matches", "country_alias")
    pairs = entity_matching.match_pairs(records, pool, alias).select(F.col("s").alias("source1_entity_id"), F.col("c").alias("candidate_entity_id"))  # no confidence is asked for
    return entity_matching.unmatched_records(pairs, matches)


def _sizes(spark, d):
    """Token counts, written once: both packing and mixing read them several times."""
    return Scratch(spark, "sizes").write(with_token_counts(*_read(spark, d, "documents")))


@query
def p8_containers(spark, d):
    return packing.fill_containers(_sizes(spark, d))


@query
def p8_report(spark, d):
    return packing.packing_report(packing.fill_containers(_sizes(spark, d)))


@query
def p8_invariants(spark, d):
    return packing.packing_faults(_sizes(spark, d))


@query
def p9_mixture(spark, d):
    return mixing.mix_sources(_sizes(spark, d), *_read(spark, d, "source_weights"))[0]


@query
def p9_report(spark, d):
    return mixing.mixture_report(*mixing.mix_sources(_sizes(spark, d), *_read(spark, d, "source_weights")))


def _scores(spark, d):
    return abuse.score_documents(*_read(spark, d, "documents", "doc_labels"))


@query
def p10_found(spark, d):
    return _scores(spark, d).where("is_case").select("doc_id")


@query
def p10_scores(spark, d):
    return _scores(spark, d)


@query
def p10_rates(spark, d):
    return abuse.source_rates(_scores(spark, d))


_ID = r"""CASE WHEN regexp_full_match(trim(lower({0}), ' ' || chr(9) || chr(10) || chr(13) || chr(160)), 's[123][-_ –]+[0-9]+(\.0*)?')
 THEN 'S' || regexp_extract(lower({0}), 's([123])', 1) || '-' || regexp_extract(lower({0}), 's[123][-_ –]+0*([0-9]+)', 1) END"""

ORACLE["p3_found"] = f"""WITH RECURSIVE e AS (SELECT DISTINCT {_ID.format('source1_entity_id')} AS a, {_ID.format('candidate_entity_id')} AS b FROM train_pairs WHERE label = 1),
 n AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
 r(id, g) AS (SELECT a, a FROM n UNION SELECT n.b, r.g FROM r JOIN n ON r.id = n.a WHERE r.g < n.b)
 SELECT id AS record_id, min(g) AS group_id FROM r GROUP BY 1"""
_P4 = f"""WITH ids AS (SELECT DISTINCT {_ID.format('source1_entity_id')} AS id FROM train_matches), f AS (SELECT entity_id, country_norm FROM records QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY row_ordinal) = 1),
 c AS (SELECT coalesce(a.country, '__unknown__') AS country FROM ids LEFT JOIN f ON ids.id = f.entity_id LEFT JOIN country_alias a ON lower(trim(f.country_norm)) = a.alias_name WHERE ids.id IS NOT NULL),
 t AS (SELECT t.country, (SELECT count(*) FROM c WHERE c.country = t.country) AS available, (SELECT count(*) FROM c) // 5 AS sample_size, t.min_rows, t.target_pct FROM country_targets t),
 n AS (SELECT country, available, sample_size, greatest(min_rows, ceil(target_pct * sample_size / 100.0))::BIGINT AS needed FROM t)"""
ORACLE["p4_found"] = f"{_P4} SELECT country FROM n WHERE available < needed"
ORACLE["p4_report"] = f"""{_P4} SELECT country, available, sample_size, needed, greatest(needed - available, 0) AS gap, least(needed, available) AS drawn,
 least(needed, available)::DOUBLE / sum(least(needed, available)) OVER () AS share FROM n"""
ORACLE["p8_invariants"] = "SELECT count(*) AS documents, 0::BIGINT AS lost, 0::BIGINT AS changed, 0::BIGINT AS divided, 0::BIGINT AS overfull FROM documents"
