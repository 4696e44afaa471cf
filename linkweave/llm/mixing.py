"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of a source's weight that moves over the course: sources with repeats come later, others earlier.
DRIFT = 0.3
#: Parts per source in which running totals are taken.
PARTS = 256


def mixture_plan(totals: DataFrame, weights: DataFrame, budget: int | None = None) -> pd.DataFrame:
    """Per weighted source: tokens available, target share, tokens wanted, tokens used, passes, and whether the repeats ran out.

    The budget is the corpus's tokens unless given. Each source is to give its share of it; one that can't in max_repeats passes gives all it has, that often, and is
    marked as limited, while the others keep their tokens, so their shares keep their proportions. Sources without weight, unknown or null ones are not used.
    totals and weights: one row per source.
    """
    t = weights.join(totals, "source", "left").toPandas()  # one row per weighted source
    t["tokens"] = t["tokens"].fillna(0).astype("int64")
    t["target_weight"] = t["target_weight"].fillna(0.0).astype(float)
    t["max_repeats"] = t["max_repeats"].fillna(1).astype("int64")
    t = t.sort_values("source").reset_index(drop=True)
    share = t["target_weight"] / max(t["target_weight"].sum(), 1e-12)
    most = t["tokens"] * t["max_repeats"]
    wanted_total = int(t["tokens"].sum()) if budget is None else budget
    t["target_share"] = share
    t["wanted_tokens"] = (share * wanted_total).round().astype("int64")
    t["use_tokens"] = t["wanted_tokens"].clip(upper=most)
    t["passes"] = [u / n if n else 0.0 for u, n in zip(t["use_tokens"], t["tokens"])]
    t["limited"] = most < t["wanted_tokens"]
    return t


def position(u: Column, drift: Column) -> Column:
    """Inverse of the cumulative demand D(x) = x + drift x (x - 1), the integral of the weight schedule 1 + drift (2 x - 1) from 0 to x, for u in [0, 1]; drift may be 0."""
    b = 1.0 - drift
    return 2.0 * u / (b + F.sqrt(b * b + 4.0 * drift * u))


def mix_sources(sizes: DataFrame, weights: DataFrame, budget: int | None = None, drift: float = DRIFT, seed: int = 42) -> tuple[DataFrame, pd.DataFrame]:
    """The mixture as rows (position, source, doc_id, repeat_no, n_tokens), range-sorted by position in (0, 1), and its plan.

    Within a pass a source's documents follow in hashed order; running token totals give each one its place u in the source's demand, and the inverse of the
    cumulative demand turns u into the training position. Running totals are two-level, over PARTS ranges of the hash and within them, so no task holds a whole source.
    sizes: doc_id, source, n_tokens. Documents of 0 tokens or with null ids are left out. No document is used more than max_repeats times.
    """
    spark = sizes.sparkSession
    rows = sizes.where("n_tokens > 0 AND doc_id IS NOT NULL AND source IS NOT NULL")
    plan = mixture_plan(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), weights, budget)
    table = spark.createDataFrame(
        [(s, int(n), int(u), int(min(r, math.ceil(p))), drift if r > 1 else -drift) for s, n, u, r, p in zip(plan["source"], plan["tokens"], plan["use_tokens"], plan["max_repeats"], plan["passes"])],
        "source string, tokens long, use_tokens long, copies int, drift double",
    )
    used = rows.join(F.broadcast(table.where("copies > 0")), "source")  # one row per weighted source
    copies = used.select("source", "doc_id", "n_tokens", "tokens", "use_tokens", "drift", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("repeat_no"))
    h = F.xxhash64("doc_id", "repeat_no", F.lit(seed))
    keyed = copies.withColumn("h", h).withColumn("part", F.floor((F.col("h") / F.lit(2.0**63) + 1) * (PARTS // 2)))
    part_sums = keyed.groupBy("source", "repeat_no", "part").agg(F.sum("n_tokens").alias("s"))
    before = F.coalesce(F.sum("s").over(Window.partitionBy("source", "repeat_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = part_sums.withColumn("before", before).drop("s")  # at most PARTS rows per source and pass
    within = Window.partitionBy("source", "repeat_no", "part").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = keyed.withColumn("run", F.sum("n_tokens").over(within)).join(F.broadcast(offsets), ["source", "repeat_no", "part"])
    end = (F.col("repeat_no") - 1).cast("long") * F.col("tokens") + F.col("before") + F.col("run")
    placed = run.withColumn("middle", end - F.col("n_tokens") / 2).where(F.col("middle") <= F.col("use_tokens"))

    u = F.greatest(F.least(F.col("middle") / F.col("use_tokens"), F.lit(1.0)), F.lit(0.0))
    mixed = placed.select(position(u, F.col("drift")).alias("position"), "source", "doc_id", "repeat_no", "n_tokens")
    return mixed.repartitionByRange("position").sortWithinPartitions("position", "source", "doc_id", "repeat_no"), plan


def mixture_report(mixed: DataFrame, plan: pd.DataFrame) -> DataFrame:
    """Per weighted source: target and actual share of tokens, tokens available and used, documents, most uses of one document, and whether repeats ran out."""
    spark = mixed.sparkSession
    table = spark.createDataFrame(
        [(s, float(a), int(n), int(m), bool(x)) for s, a, n, m, x in zip(plan["source"], plan["target_share"], plan["tokens"], plan["max_repeats"], plan["limited"])],
        "source string, target_share double, tokens_available long, max_repeats int, limited boolean",
    )
    per = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens_used"), F.count(F.lit(1)).alias("uses"), F.max("repeat_no").alias("most_uses"))
    joined = table.join(per, "source", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("tokens_used", "uses", "most_uses")})
    total = F.sum("tokens_used").over(Window.partitionBy(F.lit(1)))  # one row per source
    return joined.withColumn("actual_share", F.try_divide(F.col("tokens_used").cast("double"), total.cast("double")))
