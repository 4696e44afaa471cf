"""Samples whose category shares meet targets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweave.functions.text import strip
from linkweave.operators.packed import id_plain_form
from linkweave.plans.lineage import Scratch

UNKNOWN = "__unknown__"
#: Records per task of the pivotal method, on average.
BLOCK = 5_000


def record_countries(matches: DataFrame, records: DataFrame, alias: DataFrame) -> DataFrame:
    """(entity_id, country) of each distinct source-1 record of matches.

    The country is that of the record's first row by row_ordinal, looked up regardless of case and surrounding white space; null, unlisted and
    missing ones are UNKNOWN. An alias listed twice takes the smaller country. Values that denote no record are left out.
    """
    ids = matches.select(id_plain_form(F.col("source1_entity_id")).alias("entity_id")).where("entity_id IS NOT NULL").distinct()
    first = records.groupBy("entity_id").agg(F.min_by(F.struct("country_norm"), "row_ordinal")["country_norm"].alias("written"))
    key = lambda c: F.lower(strip(c))
    names = alias.groupBy(key(F.col("alias_name")).alias("_key")).agg(F.min("country").alias("country"))
    rows = ids.join(first, "entity_id", "left").withColumn("_key", key(F.col("written")))
    return rows.join(names, "_key", "left").select("entity_id", F.coalesce("country", F.lit(UNKNOWN)).alias("country"))


def availability(countries: DataFrame, targets: DataFrame, divisor: int = 5) -> DataFrame:
    """Per target country: available records, records needed in a sample of every divisor-th record, and the gap.

    Needed is the larger of min_rows and target_pct per cent of the sample size, rounded up. Without records every need is min_rows.
    """
    per = countries.groupBy("country").agg(F.count(F.lit(1)).alias("available"))
    size = per.agg(F.coalesce(F.floor(F.sum("available") / divisor), F.lit(0)).alias("sample_size"))
    rows = targets.join(per, "country", "left").join(F.broadcast(size), F.lit(True))
    share = F.col("target_pct").cast("long") * F.col("sample_size")
    needed = F.greatest(F.col("min_rows").cast("long"), F.floor((share + 99) / 100))
    have = F.coalesce("available", F.lit(0))
    return rows.select("country", have.alias("available"), "sample_size", needed.alias("needed"), F.greatest(needed - have, F.lit(0)).alias("gap"))


def calibrate(available: np.ndarray, wanted: np.ndarray, tolerance: float = 1e-9, rounds: int = 100) -> np.ndarray:
    """Inclusion probability of each category: Newton steps on the dual of the exponential tilting problem.

    Every record starts with the overall rate q and gets min(1, q exp(l_c)); the dual's gradient in l_c is n_c p_c - t_c and its Hessian is
    diagonal, with n_c p_c where p_c is below 1. Categories without records get 0; a target at or above the records gives 1.
    """
    n, t = available.astype(float), np.minimum(wanted.astype(float), available.astype(float))
    if t.sum() <= 0:
        return np.zeros_like(n)
    q, lam = t.sum() / n.sum(), np.zeros_like(n)
    active = (n > 0) & (t > 0)
    for _ in range(rounds):
        raw = q * np.exp(np.clip(lam, -700, 700))
        gradient = np.where(active, n * raw - t, 0.0)
        if np.abs(gradient).max(initial=0.0) <= tolerance * max(1.0, t.max()):
            break
        lam -= np.clip(gradient / np.maximum(n * raw, 1e-12), -5, 5)
    return np.where(active, np.minimum(1.0, q * np.exp(lam)), 0.0)


def _pivotal(p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Sequential pivotal method: two units fight until one has 0 or 1. At most one unit keeps a probability in between."""
    p = p.copy()
    eps, held = 1e-9, -1
    for i in range(len(p)):
        if p[i] <= eps or p[i] >= 1 - eps:
            p[i] = round(p[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = p[held], p[i]
        s = a + b
        if s < 1:
            if rng.random() * s < b:
                p[held], p[i] = 0.0, s
            else:
                p[held], p[i] = s, 0.0
        else:
            if rng.random() * (2 - s) < 1 - b:
                p[held], p[i] = 1.0, s - 1
            else:
                p[held], p[i] = s - 1, 1.0
        if eps < p[i] < 1 - eps:
            held = i
        elif not eps < p[held] < 1 - eps:
            held = -1
    return p


def draw_sample(countries: DataFrame, report: DataFrame, seed: int = 42) -> DataFrame:
    """(entity_id, country, inclusion_probability) of the drawn records.

    report: of availability; one row per target category, so it is small by contract. Each category gets min(available, needed) records.
    The pivotal method runs in blocks of bounded size; each leaves at most one undecided record, and those are decided in further
    rounds of blocks until one block per category is left; each round is written. Categories that are no target are not drawn.
    """
    spark = countries.sparkSession
    scratch = Scratch(spark, "sample")
    cats = report.toPandas()
    p = calibrate(cats["available"].to_numpy(), np.minimum(cats["needed"], cats["available"]).to_numpy())
    blocks = np.maximum(1, np.ceil(cats["available"] / BLOCK)).astype(int)
    info = spark.createDataFrame([(c, float(x), int(b)) for c, x, b in zip(cats["country"], p, blocks)], "country string, inclusion_probability double, blocks int")
    rows = countries.join(F.broadcast(info), "country").where("inclusion_probability > 0")
    rows = rows.select("entity_id", "country", "inclusion_probability", "blocks", F.col("inclusion_probability").alias("p"))
    schema = rows.schema
    largest = int(blocks.max()) if len(blocks) else 1
    drawn = None
    while True:
        block = F.pmod(F.xxhash64("entity_id", F.lit(seed)), F.col("blocks"))

        def decide(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
            df = df.drop(columns="_b").sort_values("entity_id").reset_index(drop=True)
            digest = int(pd.util.hash_array(np.array([f"{key[0]}|{key[1]}|{seed}"], dtype=object))[0])
            order = np.random.default_rng(digest).permutation(len(df))
            out = df["p"].to_numpy(copy=True)
            out[order] = _pivotal(out[order], np.random.default_rng(digest + 1))
            return df.assign(p=out)

        decided = scratch.write(rows.withColumn("_b", block).groupBy("country", "_b").applyInPandas(decide, schema))
        if largest == 1:  # what is left undecided is a rounding error of a whole total
            last = decided.where("p >= 0.5")
            out = last if drawn is None else drawn.unionByName(last)
            return out.select("entity_id", "country", "inclusion_probability")
        sure = decided.where("p >= 1")
        drawn = sure if drawn is None else drawn.unionByName(sure)
        rows = decided.where("p > 0 AND p < 1").withColumn("blocks", F.ceil(F.col("blocks") / BLOCK).cast("int"))
        largest = -(-largest // BLOCK)


def sample_report(report: DataFrame, drawn: DataFrame) -> DataFrame:
    """report plus how many records were drawn and their share of the sample."""
    n = drawn.groupBy("country").agg(F.count(F.lit(1)).alias("drawn"))
    joined = report.join(n, "country", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    total = F.sum("drawn").over(Window.partitionBy(F.lit(1)))  # one row per category
    return joined.withColumn("share", F.try_divide(F.col("drawn").cast("double"), total.cast("double")))
