"""Five retrieval strategies, their merge into candidate lists, and the bounded row selector."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave import config as cfg
from linkweave.config import CandidateConfig
from linkweave.functions.keys import address_keys_query
from linkweave.functions.similarity import Texts, best_scores
from linkweave.functions.text import clean_scalar, strip
from linkweave.operators import pool as P
from linkweave.plans.lineage import Scratch

QUERY_COLUMNS = ("entity_id", "country_norm", "business_name_norm", "business_name_core", "business_name_alt", "business_address_norm")


def query_rows(s1: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Source-1 rows as lookups: row_id, country, name, core, alt, address. Rows without a country match nothing and are left out."""
    P.check_columns(s1, QUERY_COLUMNS)
    names = ("country", "name", "core", "alt", "address")
    rows = s1.select(F.col(ordinal).alias("row_id"), *(clean_scalar(F.col(c)).alias(to) for c, to in zip(QUERY_COLUMNS[1:], names)))
    return rows.where(F.col("country") != "")


def _lookup(queries: DataFrame, pool: DataFrame, value: str, column: str, limit: int) -> DataFrame:
    index = P.capped(pool.where(F.col(column) != "").select("country", F.col(column).alias(value), "entity_id"), ["country", value], limit)
    return queries.where(F.col(value) != "").join(index, ["country", value]).select("row_id", "entity_id")


def exact_name(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    return _lookup(queries, pool, "name", "name", config.exact_limit)


def exact_name_alt(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    """Equal core or equal trade name; a trade name is never held against a name."""
    core = _lookup(queries, pool, "core", "name_core", config.exact_limit)
    return core.unionByName(_lookup(queries, pool, "alt", "name_alt", config.exact_limit)).distinct()


def exact_address(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    return _lookup(queries, pool, "address", "address", config.exact_limit)


def address_key(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    """Rows that share a key held by few enough pool rows; frequent keys are cut on the pool side, before the join."""
    index = P.address_key_index(pool)
    rare = P.key_frequencies(index).where(F.col("frequency") <= config.address_key_max_frequency).select("country", "key")
    keys = queries.select("row_id", "country", F.explode(address_keys_query(F.col("address"))).alias("key"))
    return keys.join(index.join(rare, ["country", "key"], "left_semi"), ["country", "key"]).select("row_id", "entity_id").distinct()


def _prefix_keys(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> tuple[DataFrame, DataFrame]:
    """(country, length, prefix, row_id) of the lookups and (country, length, prefix, entity_id) of the pool."""
    longest = config.fuzzy_prefix_length
    lengths = tuple(range(min(3, longest), longest + 1))
    length = F.least(F.lit(longest), F.length("name"))
    keyed = queries.where(F.length("name") >= 3).select("country", length.alias("length"), F.left("name", length).alias("prefix"), "row_id")
    return keyed, P.prefix_index(pool, lengths, config.fuzzy_block_limit)


def _anchor_keys(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> tuple[DataFrame, DataFrame]:
    """(country, anchor, row_id) of the lookups and (country, anchor, entity_id) of the pool."""
    anchor = P.anchor_of_query(F.col("core"), F.col("name"), config.name_anchor_min_length)
    keyed = queries.where(F.length("name") >= 3).select("country", anchor.alias("anchor"), "row_id").where("anchor IS NOT NULL")
    return keyed, P.capped(P.name_anchor_index(pool), ["country", "anchor"], config.fuzzy_block_limit)


def prefix_block(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    keyed, index = _prefix_keys(queries, pool, config)
    return keyed.join(index, ["country", "length", "prefix"]).select("row_id", "entity_id")


def anchor_block(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    keyed, index = _anchor_keys(queries, pool, config)
    return keyed.join(index, ["country", "anchor"]).select("row_id", "entity_id")


#: Lookups of a block that meet one copy of its pool rows, lookups of a bucket of blocks, and pairs scored at once.
SLICE = 1_000
BUCKET = 2_000
AT_ONCE = 100_000


def _score_bucket(lookups: pa.Table, index: pa.Table, least: float) -> pa.Table:
    """(_first, entity_id, score) of the pairs of both sides that share a block and score least or more."""
    columns = [t.column(c).to_pylist() for t, cs in ((lookups, ("name", "core")), (index, ("c_name", "c_core", "c_alt"))) for c in cs]
    number: dict[str, int] = {}
    name, core, c_name, c_core, c_alt = (np.array([number.setdefault(x, len(number)) for x in c], dtype=np.int64) for c in columns)
    texts = Texts(list(number))
    blocks: dict[str, int] = {}
    ours, theirs = (np.array([blocks.setdefault(b, len(blocks)) for b in t.column("block").to_pylist()], dtype=np.int64) for t in (lookups, index))
    order = np.argsort(theirs, kind="stable")
    held = np.bincount(theirs, minlength=len(blocks))
    start = np.cumsum(held) - held
    n = held[ours]
    ends = np.cumsum(n)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(ours):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, side="right")))
        left = np.repeat(np.arange(at, to), n[at:to])
        within = np.arange(len(left)) - np.repeat(np.cumsum(n[at:to]) - n[at:to], n[at:to])
        right = order[start[ours[left]] + within]
        score = best_scores(texts, name[left], core[left], c_name[right], c_core[right], c_alt[right], least)
        kept = score >= least
        found.append((left[kept], right[kept], score[kept]))
        at = to
    left, right, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)
    return pa.table({"_first": lookups.column("_first").take(pa.array(left)), "entity_id": index.column("entity_id").take(pa.array(right)), "score": pa.array(score)})


def fuzzy_scores(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    """row_id, entity_id, score of all pairs in a shared block that score fuzzy_threshold or more. Equal lookups are scored once.

    No pair is shuffled before it is scored: lookups and pool rows of a block meet in its bucket. A block of many lookups is cut into slices of about SLICE, each with a copy of the block's pool rows, at most
    fuzzy_block_limit. A bucket holds about BUCKET lookups of each strategy and their blocks.
    """
    text = ["country", "name", "core"]
    distinct = queries.where(F.length("name") >= 3).groupBy(*text).agg(F.min("row_id").alias("row_id"))
    block = lambda df, kind: df.select(F.concat_ws("\x1f", F.lit(kind), *df.columns[:-1]).alias("block"), df.columns[-1])
    sides = [(block(l, k), block(r, k)) for k, (l, r) in (("prefix", _prefix_keys(distinct, pool, config)), ("anchor", _anchor_keys(distinct, pool, config)))]
    keyed, index = (a.unionByName(b) for a, b in zip(*sides))
    slices = keyed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("_s"))
    number = max(4 * queries.sparkSession.sparkContext.defaultParallelism, -(-queries.count() // BUCKET))
    sliced = lambda df: df.withColumn("block", F.concat_ws("\x1f", "block", "_k")).withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(number)).cast("int"))
    ours = sliced(keyed.join(slices, "block").withColumn("_k", F.pmod(F.xxhash64("row_id"), F.col("_s"))))
    ours = ours.join(distinct.select("row_id", "name", "core"), "row_id").select("bucket", "block", F.col("row_id").alias("_first"), "name", "core")
    theirs = sliced(index.join(slices, "block").withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_s") - 1))))
    theirs = theirs.join(pool.select("entity_id", F.col("name").alias("c_name"), F.col("name_core").alias("c_core"), F.col("name_alt").alias("c_alt")), "entity_id")
    theirs = theirs.select("bucket", "block", "entity_id", "c_name", "c_core", "c_alt")
    least = config.fuzzy_threshold
    schema = T.StructType([T.StructField("_first", distinct.schema["row_id"].dataType), T.StructField("entity_id", T.StringType()), T.StructField("score", T.DoubleType())])
    in_buckets = lambda df: df.repartition(number, "bucket").groupBy("bucket")  # with their number given, small partitions are not put together
    scored = in_buckets(ours).cogroup(in_buckets(theirs)).applyInArrow(lambda a, b: _score_bucket(a, b, least), schema)
    scored = scored.repartition("_first").distinct()  # a pair can be in two blocks
    rows = queries.where(F.length("name") >= 3).select(*text, "row_id").join(distinct.withColumnRenamed("row_id", "_first"), text)
    return rows.select("row_id", "_first").join(scored, "_first").select("row_id", "entity_id", "score")


def fuzzy_name(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    """Best-scored pairs of each row with pos, from 1, by descending score and then id."""
    best = Window.partitionBy("row_id").orderBy(F.desc("score"), "entity_id")
    ranked = fuzzy_scores(queries, pool, config).withColumn("pos", F.row_number().over(best))
    return ranked.where(F.col("pos") <= config.fuzzy_top_k).select("row_id", "entity_id", "score", "pos")


_BY_NAME: dict[str, Callable[[DataFrame, DataFrame, CandidateConfig], DataFrame]] = {
    cfg.EXACT_NAME: exact_name,
    cfg.EXACT_NAME_ALT: exact_name_alt,
    cfg.EXACT_ADDRESS: exact_address,
    cfg.ADDRESS_KEY: address_key,
    cfg.FUZZY_NAME: fuzzy_name,
}


def strategy_rows(queries: DataFrame, pool: DataFrame, config: CandidateConfig) -> DataFrame:
    """(row_id, entity_id, strategy, pos) of every enabled strategy; strategy is its rank."""
    parts = []
    for rank, name in enumerate(cfg.STRATEGIES):
        if name in config.enabled_strategies:
            found = _BY_NAME[name](queries, pool, config)
            pos = F.col("pos") if name == cfg.FUZZY_NAME else F.lit(0)
            parts.append(found.select("row_id", "entity_id", F.lit(rank).alias("strategy"), pos.cast("int").alias("pos")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merge(rows: DataFrame, max_candidates: int | None) -> DataFrame:
    """Each candidate of a row once, under its first strategy; rank from 1 by strategy, fuzzy position, id."""
    first = rows.groupBy("row_id", "entity_id").agg(F.min(F.struct("strategy", "pos")).alias("f")).select("row_id", "entity_id", "f.*")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("row_id").orderBy("strategy", "pos", "entity_id")))
    return ranked if max_candidates is None else ranked.where(F.col("rank") <= max_candidates)


def generate_candidates(s1: DataFrame, pool: DataFrame, config: CandidateConfig, ordinal: str = "ordinal") -> DataFrame:
    """(row_id, entity_id, strategy, pos, rank) of all source-1 rows. Equal rows keep their own candidates; blank ids are an error of check_queries.

    Lookups and pool are cleaned once and written: every strategy reads both.
    """
    scratch = Scratch(s1.sparkSession, "candidates")
    queries = scratch.write(query_rows(s1, ordinal))
    index = scratch.write(pool.select("entity_id", "country", "name", "name_core", "name_alt", "address"))
    return merge(strategy_rows(queries, index, config), config.max_candidates)


def check_queries(s1: DataFrame) -> None:
    n = s1.where(F.col("entity_id").isNull() | (strip(F.col("entity_id")) == "")).count()
    if n:
        raise cfg.CandidateGenerationError(f"{n} source-1 rows have no id")


def candidate_lists(s1: DataFrame, candidates: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One row per source-1 row: its id, the candidates in rank order and their number; rows without any have ''."""
    lists = candidates.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("rank", "entity_id"))).alias("l"))
    ids = F.coalesce(F.transform("l", lambda x: x["entity_id"]), F.array().cast("array<string>"))
    joined = s1.select(F.col(ordinal).alias("row_id"), F.col("entity_id").alias("source1_entity_id")).join(lists, "row_id", "left")
    return joined.select("row_id", "source1_entity_id", F.array_join(ids, ",").alias("candidate_entity_ids"), F.size(ids).alias("n_candidates"))


def generation_report(lists: DataFrame, max_candidates: int | None) -> DataFrame:
    n = F.col("n_candidates")
    return lists.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(n > 0).alias("nonempty"),
        F.count_if(n == 0).alias("empty"),
        F.coalesce(F.sum(n), F.lit(0)).alias("total_candidates"),
        F.coalesce(F.max(n), F.lit(0)).alias("max_candidates_in_row"),
        F.count_if(n == F.lit(max_candidates if max_candidates is not None else -1)).alias("rows_at_cap"),
    )


def select_rows(s1: DataFrame, limit: int | None, ensure_country: str | None = None, ensure_count: int = 0, ordinal: str = "ordinal") -> DataFrame:
    """The first limit rows by ordinal, plus slot. With ensure_country, later rows of that country take the places of the first other rows until ensure_count of it are in.

    Only the limit rows and ensure_count later ones are ever ranked in one place. ordinal must be unique.
    """
    if limit is None:
        return s1.withColumn("slot", F.col(ordinal))
    head = s1.orderBy(ordinal).limit(limit)
    head = head.withColumn("slot", F.row_number().over(Window.orderBy(ordinal)))
    if not ensure_country or ensure_count <= 0:
        return head
    is_target = F.lower(strip(F.coalesce("country", F.lit("")))) == ensure_country.strip().lower()
    head = head.withColumn("_target", is_target)
    bounds = head.agg(F.max(ordinal).alias("_last"), F.count_if("_target").alias("_have"))
    later = s1.join(F.broadcast(bounds), F.col(ordinal) > F.col("_last")).where(is_target).orderBy(ordinal).limit(ensure_count)
    later = later.withColumn("_k", F.row_number().over(Window.orderBy(ordinal))).where(F.col("_k") <= F.lit(ensure_count) - F.col("_have"))
    places = head.where("NOT _target").withColumn("_k", F.row_number().over(Window.orderBy("slot"))).select("_k", "slot")
    coming = later.join(F.broadcast(places), "_k")
    kept = head.join(F.broadcast(coming.select("slot")), "slot", "left_anti")
    return kept.select(*s1.columns, "slot").unionByName(coming.select(*s1.columns, "slot"))
