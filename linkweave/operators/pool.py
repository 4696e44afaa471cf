"""The candidate pool and its inverted indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave import config as cfg
from linkweave.functions.keys import address_keys_index, name_anchor
from linkweave.functions.text import clean_scalar, null_tokens

POOL_COLUMNS = ("entity_id", "source", "country", "name", "name_core", "name_alt", "address", "landmark")
CLEANED_COLUMNS = (
    "entity_id", "country_norm", "business_name_norm", "business_name_core",
    "business_name_alt", "business_address_norm", "business_address_landmark",
)


def check_columns(df: DataFrame, required: tuple[str, ...]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"columns are missing: {missing}")


def build_pool(cleaned: dict[str, DataFrame], null_values: tuple[str, ...] = cfg.NULLS_POOL) -> DataFrame:
    """Cleaned sources by name ('S2', 'S3') as one table of eight strings, none null."""
    parts = []
    for source, df in cleaned.items():
        check_columns(df, CLEANED_COLUMNS)
        value = lambda c: clean_scalar(null_tokens(F.col(c), null_values))
        parts.append(
            df.select(
                F.coalesce(F.trim("entity_id"), F.lit("")).alias("entity_id"),
                F.lit(source).alias("source"),
                *(value(c).alias(to) for c, to in zip(CLEANED_COLUMNS[1:], POOL_COLUMNS[2:])),
            )
        )
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def pool_errors(pool: DataFrame) -> DataFrame:
    """One row: how many ids are blank, and how many occur more than once."""
    per_id = pool.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum(F.when(F.trim("entity_id") == "", F.col("n"))), F.lit(0)).alias("blank_ids"),
        F.count_if((F.trim("entity_id") != "") & (F.col("n") > 1)).alias("duplicate_ids"),
    )


def check_pool(pool: DataFrame) -> None:
    blank, repeated = pool_errors(pool).first()
    if blank or repeated:
        raise cfg.CandidateGenerationError(f"the pool has {blank} rows without an id and {repeated} ids that occur twice or more")


def address_key_index(pool: DataFrame) -> DataFrame:
    """Distinct (country, key, entity_id)."""
    return pool.select("country", F.explode(address_keys_index(F.col("address"))).alias("key"), "entity_id").distinct()


def name_anchor_index(pool: DataFrame, min_length: int = cfg.INDEX_ANCHOR_MIN_LENGTH) -> DataFrame:
    """(country, anchor, entity_id) of rows that have a token long enough; the core name is used, else the name."""
    base = F.when(F.col("name_core") != "", F.col("name_core")).otherwise(F.col("name"))
    return pool.select("country", name_anchor(base, min_length).alias("anchor"), "entity_id").where("anchor IS NOT NULL").distinct()


def capped(index: DataFrame, key: list[str], limit: int) -> DataFrame:
    """The first rows of each key by entity_id: exact for lookups with ORDER BY entity_id LIMIT, and it bounds the fan-out of the join that follows."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("entity_id"))
    return index.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def key_frequencies(index: DataFrame) -> DataFrame:
    return index.groupBy("country", "key").agg(F.count(F.lit(1)).alias("frequency"))


def rows_by_source(pool: DataFrame) -> DataFrame:
    return pool.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def prefix_index(pool: DataFrame, lengths: tuple[int, ...], limit: int) -> DataFrame:
    """(country, length, prefix, entity_id), so that a prefix range becomes an equality."""
    name = F.col("name")
    pieces = F.filter(F.array(*(F.struct(F.lit(n).alias("length"), F.left(name, F.lit(n)).alias("prefix")) for n in lengths)), lambda s: F.length(s["prefix"]) == s["length"])
    rows = pool.select("country", F.explode(pieces).alias("p"), "entity_id").select("country", "p.length", "p.prefix", "entity_id")
    return capped(rows, ["country", "length", "prefix"], limit)


def anchor_of_query(core: Column, name: Column, min_length: int) -> Column:
    return name_anchor(F.when(core != "", core).otherwise(name), min_length)
