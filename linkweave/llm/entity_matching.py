"""Matching source-1 records to pool rows without a common id: a cascade of exact joins, each match with a confidence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.location_links import addressed_rows, resolve_locations
from linkweave.llm.name_links import named_rows, organisations
from linkweave.operators.packed import id_plain_form, split_packed
from linkweave.plans.lineage import Scratch

#: What each pass of the cascade joins on, the strongest first.
RULES = ("organisation and location", "family name and location", "name word and location", "organisation, house number and part of the street", "only organisation at a location", "only location of an organisation")
#: Smoothing of a rule's precision: so many right and wrong pairs are added.
PRIOR = (1.0, 1.0)


def _compatible(a: Column, b: Column) -> Column:
    """Two given names that can be one person's: equal, either missing, or an initial that fits."""
    first = lambda c: F.when(c.startswith("?"), F.substring(c, 2, 1)).otherwise(F.substring(c, 1, 1))
    return (a == "") | (b == "") | (a == b) | ((a.startswith("?") | b.startswith("?")) & (first(a) == first(b)))


def _attributes(records: DataFrame, pool: DataFrame, alias: DataFrame, scratch: Scratch) -> DataFrame:
    """(entity_id, org, root, family, given, location, region, code, street, number): what each row's names and address denote, written; a row of several names comes once per name. number has the street's type."""
    named, written = organisations(scratch.write(named_rows(records, pool)), scratch)
    located = resolve_locations(addressed_rows(records, pool, alias), scratch)
    part = lambda k: F.get(F.split("location", r"\|"), F.lit(k))
    last = lambda k: F.element_at(F.split("location", r"\|"), -k)
    house = ~F.col("location").startswith("landmark|")
    parts = [F.when(house, x).alias(c) for x, c in ((part(0), "region"), (part(1), "code"), (part(2), "street"), (F.concat_ws("|", last(2), last(1)), "number"))]
    out = scratch.write(named.drop("first").join(located.select("entity_id", "location", *parts), "entity_id", "full"))
    scratch.drop(written)
    scratch.drop(located)
    return out


def match_pairs(records: DataFrame, pool: DataFrame, alias: DataFrame) -> DataFrame:
    """(s, c, rule) of all source-1 records and pool rows; rule: its place in RULES.

    Keys are the organisation and the location that a row's name, address and country denote (see name_links and location_links). The rules of RULES
    are exact joins on weaker and weaker combinations; a pool row that a rule matched is resolved and is anti-joined from later passes. The last two serve rows
    without a name or without an address, where all other rows of that location, or of that organisation, agree; such a record can't be resolved before, and takes resolved pool rows too, which may belong to several records.
    So a pair has one rule. Empty tables give no pair.
    """
    scratch = Scratch(records.sparkSession, "entities")
    both = _attributes(records, pool, alias, scratch)
    is_s1 = F.col("entity_id").startswith("S1-")
    shared = ("org", "root", "location", "number")
    side = lambda rows, i: rows.select(F.col("entity_id").alias(i), *(F.col(c).alias(c if c in shared else f"{i}_{c}") for c in both.columns if c != "entity_id"))
    left, right = side(both.where(is_s1), "s"), side(both.where(~is_s1), "c")
    fits = _compatible(F.col("s_given"), F.col("c_given"))
    word = lambda df, c: df.where(f"{c} IS NOT NULL").withColumn("word", F.explode(F.split(c, " "))).where("length(word) > 4")
    orgs = both.where("location IS NOT NULL AND org IS NOT NULL").select("location", "org").distinct()
    lone_org = orgs.groupBy("location").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("location")
    lone_location = orgs.groupBy("org").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("org")
    nameless = lambda df: df.where("org IS NULL")
    homeless = lambda df: df.where("location IS NULL")
    near_street = (F.col("s_code") == F.col("c_code")) & (F.col("s_code") != "") | (F.levenshtein("s_street", "c_street", 2) >= 0)
    same_region = (F.col("s_region") == F.col("c_region")) | (F.col("s_region") == "") | (F.col("c_region") == "")

    def at_lone(key: str, lone: DataFrame, lacking: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, DataFrame], DataFrame]:
        one_way = lambda a, b: lacking(a).join(lone, key, "left_semi").join(b, key).select("s", "c")
        return lambda l, r: one_way(l, right).unionByName(one_way(r, l))

    passes = (
        lambda l, r: l.join(r, ["org", "location"]),
        lambda l, r: l.join(r, ["root", "location"]).where(fits),
        lambda l, r: word(l, "s_family").join(word(r, "c_family"), ["word", "location"]).where(fits),
        lambda l, r: l.join(r, ["org", "number"]).where(near_street & same_region),
        at_lone("location", lone_org, nameless),
        at_lone("org", lone_location, homeless),
    )
    pairs = None
    rest = right
    for rule, join in enumerate(passes):
        found = scratch.write(join(left, rest).select("s", "c").distinct())
        with_rule = found.withColumn("rule", F.lit(rule))
        pairs = with_rule if pairs is None else pairs.unionByName(with_rule)
        if rule + 1 < len(passes):
            before, rest = rest, scratch.write(rest.join(found.select("c").distinct(), "c", "left_anti"))  # resolved rows take no part in later passes
            if rule:
                scratch.drop(before)
    scratch.drop(rest)
    scratch.drop(both)
    return pairs


def match_entities(records: DataFrame, pool: DataFrame, matches: DataFrame, alias: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, rule, confidence) of match_pairs. confidence: the share of a rule's pairs that matches confirms, over the records that matches lists something for, smoothed by PRIOR."""
    pairs = match_pairs(records, pool, alias)
    truth = split_packed(matches, "matched_entity_ids", ["source1_entity_id"], "c").select(id_plain_form(F.col("source1_entity_id")).alias("s"), "c").distinct()
    judged = pairs.join(truth.select("s").distinct(), "s", "left_semi").join(truth.withColumn("right", F.lit(1)), ["s", "c"], "left")
    per_rule = judged.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.count("right").alias("k"))  # one row per rule
    rules = records.sparkSession.range(len(RULES)).select(F.col("id").cast("int").alias("rule")).join(F.broadcast(per_rule), "rule", "left")
    good, bad = PRIOR
    precision = (F.coalesce("k", F.lit(0)) + good) / (F.coalesce("n", F.lit(0)) + good + bad)
    return pairs.join(F.broadcast(rules.select("rule", precision.alias("confidence"))), "rule").select(
        F.col("s").alias("source1_entity_id"), F.col("c").alias("candidate_entity_id"), F.element_at(F.array(*map(F.lit, RULES)), F.col("rule") + 1).alias("rule"), "confidence"
    )


def unmatched_records(pairs: DataFrame, matches: DataFrame) -> DataFrame:
    """pairs (source1_entity_id, ...) of source-1 records that have no row in matches, however it is written."""
    known = matches.select(id_plain_form(F.col("source1_entity_id")).alias("source1_entity_id")).where("source1_entity_id IS NOT NULL").distinct()
    return pairs.join(known, "source1_entity_id", "left_anti")
