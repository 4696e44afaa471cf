"""Cleaning of raw business records and the quality report about them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave import config as cfg
from linkweave.functions.text import NOISE, blank_to_null, collapse, first_match, longest_first, null_tokens, rewrite_words, strip, title

RAW_COLUMNS = ("entity_id", "business_name", "business_address", "country")


def with_raw_columns(df: DataFrame, null_values: tuple[str, ...] = cfg.NULLS_RAW) -> DataFrame:
    """The four expected columns with null tokens as null, missing ones added; other columns pass through."""
    out = {c: null_tokens(F.col(c), null_values) if c in df.columns else F.lit(None).cast("string") for c in RAW_COLUMNS}
    return df.withColumns(out)


def normalize_country(c: Column) -> Column:
    return title(strip(F.coalesce(c, F.lit(""))))


def normalize_name(c: Column, ampersand: bool = True) -> Column:
    """Lower case, bracket noise as spaces, & as and, legal forms in one spelling."""
    c = F.regexp_replace(F.lower(strip(F.coalesce(c, F.lit("")))), NOISE, " ")
    if ampersand:
        c = F.regexp_replace(c, r"(?U)\s*&\s*", " and ")
    for word, to in longest_first(cfg.LEGAL_FORMS):
        c = F.regexp_replace(c, rf"(?iU)\b{re.escape(word)}(?![a-z0-9])", to) if word != to else c
    return collapse(c)


def name_core(norm: Column) -> Column:
    """norm without the legal forms at its end; norm itself where nothing else is left."""
    forms = "|".join(cfg.LEGAL_TOKENS)
    core = strip(F.regexp_replace(norm, rf"(?iU)\s+(?:{forms})(?:\s+(?:{forms}))*\s*$", ""))
    return F.when(F.length(core) > 0, core).otherwise(norm)


def trade_name(raw: Column) -> Column:
    """The name after the first trade-name phrase in rule order; a blank hit of an earlier phrase hides later ones."""
    hits = [F.when(F.regexp_like(raw, F.lit(p)), F.regexp_extract(raw, p, 1)) for p in cfg.TRADE_NAME_PATTERNS]
    return blank_to_null(strip(F.coalesce(*hits)))


def normalize_address(address: Column, country_norm: Column) -> Column:
    base = F.lower(strip(F.coalesce(address, F.lit(""))))
    country = F.lower(F.coalesce(country_norm, F.lit("")))
    own = base
    for key in ("india", "us"):
        own = F.when(country == key, rewrite_words(base, cfg.ADDRESS_WORDS[key])).otherwise(own)
    return collapse(F.regexp_replace(rewrite_words(own, cfg.ADDRESS_WORDS["generic"]), NOISE, " "))


def landmark(address: Column) -> Column:
    return first_match(address, cfg.LANDMARK_PATTERN)


def clean_records(df: DataFrame) -> DataFrame:
    """df plus six derived columns. Empty input gives an empty result; nulls become '' but for trade name and landmark, which stay null; columns of the derived names are replaced."""
    raw = with_raw_columns(df)
    out = raw.withColumns({"country_norm": normalize_country(F.col("country")), "business_name_norm": normalize_name(F.col("business_name"))})
    return out.withColumns(
        {
            "business_name_core": name_core(F.col("business_name_norm")),
            "business_name_alt": trade_name(F.col("business_name")),
            "business_address_norm": normalize_address(F.col("business_address"), F.col("country_norm")),
            "business_address_landmark": landmark(F.col("business_address")),
        }
    )


def quality_counts(cleaned: DataFrame) -> DataFrame:
    """One row of counts. business_name_alt and business_address_landmark must have been derived."""
    n = lambda cond: F.count_if(cond)
    blank_id = F.col("entity_id").isNull() | (strip(F.col("entity_id")) == "")
    return cleaned.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(n(F.col(c).isNull()).alias(f"null_{c}") for c in RAW_COLUMNS),
        n(blank_id).alias("null_entity_id_count"),
        n(F.regexp_like("business_name", F.lit(cfg.LEGAL_WORD_PATTERN))).alias("suffix_pattern_matches"),
        n(F.col("business_name_alt").isNotNull()).alias("dba_pattern_matches"),
        n(F.col("business_address_landmark").isNotNull()).alias("landmark_pattern_matches"),
    )


def country_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("country", F.lit("__null__")).alias("country")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_ids(df: DataFrame, ordinal: Column, chunk_size: int = cfg.CHUNK_SIZE) -> DataFrame:
    """Per chunk of rows, ids seen in an earlier chunk, summed; and the count of ids that occur more than once at all."""
    seen = df.where(F.col("entity_id").isNotNull()).select(strip(F.col("entity_id")).alias("id"), F.floor(ordinal / F.lit(chunk_size)).alias("chunk"))
    per_id = seen.groupBy("id", "chunk").agg(F.count(F.lit(1)).alias("n")).groupBy("id").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("n"))
    return per_id.agg(
        F.coalesce(F.sum(F.col("chunks") - 1), F.lit(0)).alias("duplicate_entity_id_count"),
        F.count_if(F.col("n") > 1).alias("repeated_ids"),
    )


def quality_report(raw: DataFrame, label: str, ordinal: Column, chunk_size: int = cfg.CHUNK_SIZE) -> dict:
    """The report of one source as a dictionary; the driver gets one row and one per country."""
    cleaned = clean_records(raw)
    c = quality_counts(cleaned).first().asDict()
    return {
        "source": label,
        "total_rows": c["total_rows"],
        "null_counts_original_cols": {k: c[f"null_{k}"] for k in RAW_COLUMNS},
        "null_entity_id_count": c["null_entity_id_count"],
        "duplicate_entity_id_count": duplicate_ids(cleaned, ordinal, chunk_size).first()[0],
        "country_distribution": {r["country"]: r["n"] for r in country_distribution(cleaned).toLocalIterator()},
        **{k: c[k] for k in ("suffix_pattern_matches", "dba_pattern_matches", "landmark_pattern_matches")},
    }
