"""Train, validation and test splits that keep related records together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.components import plain_id_components
from linkweave.operators.packed import id_plain_form, split_packed
from linkweave.plans.lineage import Scratch

SPLITS = ("train", "validation", "test")
FRACTIONS = (0.70, 0.15, 0.15)
#: A component with more than this share of all rows is placed on its own, before the others; there are at most 1 / HEAVY_SHARE of them.
HEAVY_SHARE = 1 / 1000
#: Components per block of the parallel search, on average.
BLOCK = 20_000
CHAINS = 4


def key_groups(matches: DataFrame, pairs: DataFrame) -> DataFrame:
    """(written, plain, group_id): each distinct written source-1 value with the record it denotes and its group.

    Values that denote one record, and records that matches lists a common well-formed id for, directly or through further
    ones, share a group; group_id is its smallest plain-form id. A value that denotes no record is a group of its own, under
    itself. Nulls have no group. Either table may be empty; other columns are not read.
    """
    scratch = Scratch(matches.sparkSession, "splits")
    written = matches.select("source1_entity_id").unionByName(pairs.select("source1_entity_id")).where("source1_entity_id IS NOT NULL").distinct()
    keyed = written.select(F.col("source1_entity_id").alias("written"), id_plain_form(F.col("source1_entity_id")).alias("plain"))
    listed = split_packed(matches, "matched_entity_ids", ["source1_entity_id"], "value")
    links = listed.where(F.regexp_like("value", F.lit(r"^S[23]-[0-9]+$"))).select(id_plain_form(F.col("source1_entity_id")).alias("a"), F.col("value").alias("b"))
    groups = plain_id_components(links.where("a IS NOT NULL")).where("id LIKE 'S1-%'")
    # S1- sorts before S2- and S3-, so the smallest id of a group is a source-1 id
    joined = keyed.join(groups.select(F.col("id").alias("plain"), F.col("group_id").alias("_g")), "plain", "left")
    return scratch.write(joined.select("written", "plain", F.coalesce("_g", "plain", "written").alias("group_id")))


def shared_keys(keys: DataFrame) -> DataFrame:
    """(source1_entity_id, group_id) of the written values that share their split with another written value; keys: of split_keys, whose groups are what the search placed."""
    keys = Scratch(keys.sparkSession, "placed").write(keys)
    several = keys.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(several.select("group_id"), "group_id", "left_semi").select("source1_entity_id", "group_id")


def component_sizes(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """(group_id, rows, positives) over the rows of pairs; groups that occur only in matches have 0 rows. Hot keys are counted before the shuffle."""
    per_key = pairs.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1).alias("positives"))
    joined = groups.join(per_key.withColumnRenamed("source1_entity_id", "written"), "written", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return joined.groupBy("group_id").agg(total("rows"), total("positives"))


def anneal(size: np.ndarray, pos: np.ndarray, start: np.ndarray, want: np.ndarray, seed: int, steps: int) -> tuple[np.ndarray, float]:
    """Best assignment found from start: each step moves one component or exchanges two, and is kept by the annealing rule.

    want: rows and positives wanted of each split, shape (splits, 2). The cost is the summed squared deviation in units of the wanted totals.
    """
    rng = np.random.default_rng(seed)
    w = np.stack([size, pos], 1).astype(float)
    at = start.copy()
    k = len(want)
    have = np.zeros_like(want)
    np.add.at(have, at, w)
    scale = np.maximum(want.sum(0), 1.0)
    dev = (have - want) / scale
    cost = float((dev**2).sum())
    best, best_cost = at.copy(), cost
    unit = w / scale
    n = len(size)
    if n == 0 or k < 2:
        return best, best_cost
    temperature = max(cost, 1e-12)
    cool = (1e-8) ** (1.0 / max(steps, 1))
    picks, others, coins, dice, targets = (rng.integers(n, size=steps), rng.integers(n, size=steps), rng.random(steps), rng.random(steps), rng.integers(1, k, size=steps))
    for t in range(steps):
        i, j = picks[t], others[t]
        a = at[i]
        if coins[t] < 0.5:
            b, change = (a + targets[t]) % k, unit[i]
        else:
            b = at[j]
            if a == b:
                temperature *= cool
                continue
            change = unit[i] - unit[j]
        da, db = dev[a] - change, dev[b] + change
        delta = float((da**2).sum() + (db**2).sum() - (dev[a] ** 2).sum() - (dev[b] ** 2).sum())
        if delta <= 0 or dice[t] < np.exp(-delta / temperature):
            dev[a], dev[b] = da, db
            at[i] = b
            if coins[t] >= 0.5:
                at[j] = a
            cost += delta
            if cost < 0.9 * best_cost:  # copied only where it pays
                best, best_cost = at.copy(), cost
        temperature *= cool
    return (at, cost) if cost < best_cost else (best, best_cost)


def _start(ids: pd.Series, fractions: tuple[float, ...], seed: int) -> np.ndarray:
    """Hashed assignment: by the id alone."""
    u = pd.util.hash_array(ids.to_numpy(dtype=object), hash_key=f"{seed:016d}").astype(np.float64) / 2.0**64
    return np.minimum(np.searchsorted(np.cumsum(fractions), u, side="right"), len(fractions) - 1)


def assign_components(sizes: DataFrame, fractions: tuple[float, ...] = FRACTIONS, seed: int = 42, steps: int = 20_000) -> DataFrame:
    """sizes plus split, an index into fractions.

    Heavy components, at most 1 / HEAVY_SHARE of them, are placed first, in CHAINS parallel annealing runs of which the best is kept.
    What they leave of the targets is shared among blocks of the other components by the blocks' totals; each block starts from
    the hashed assignment and is annealed on its own, all blocks in parallel. A block is a bounded number of components.
    A component can't be divided, so one that is larger than its split leaves a deviation that the others reduce as far as they can.
    """
    spark = sizes.sparkSession
    total = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("positives"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(1, int(total[0] * HEAVY_SHARE))
    want = np.outer(np.array(fractions), np.array([total[0], total[1]], dtype=float))
    heavy = sizes.where(F.col("rows") > least)
    heavy_rows = heavy.toPandas().sort_values("group_id").reset_index(drop=True)  # at most 1 / HEAVY_SHARE rows
    placed = heavy_rows.assign(split=_start(heavy_rows["group_id"], fractions, seed).astype("int64"))
    if len(heavy_rows):
        s, p, first = heavy_rows["rows"].to_numpy(), heavy_rows["positives"].to_numpy(), placed["split"].to_numpy()
        # the heavy ones should leave every split room in proportion: they get their own share of each target
        own = np.outer(np.array(fractions), np.array([s.sum(), p.sum()], dtype=float))

        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for chains in it:
                for c in chains["id"]:
                    found, cost = anneal(s, p, first, own, seed * 1000 + int(c), steps)
                    yield pd.DataFrame({"cost": [cost], "chain": [int(c)], "at": [found.tolist()]})

        chains = spark.range(0, CHAINS, 1, CHAINS).mapInPandas(run, "cost double, chain long, at array<long>")
        placed["split"] = np.array(chains.orderBy("cost", "chain").first()["at"], dtype="int64")
    left = want.copy()
    for at, r, p in zip(placed["split"], placed["rows"], placed["positives"]):
        left[at] -= (r, p)
    left = np.maximum(left, 0.0)
    shares = left / np.maximum(left.sum(0), 1e-9)
    rest = sizes.where(F.col("rows") <= least)
    n_blocks = max(1, -(-int(total[2]) // BLOCK))

    def block(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("group_id").reset_index(drop=True)
        s, p = df["rows"].to_numpy(), df["positives"].to_numpy()
        goal = shares * np.array([s.sum(), p.sum()], dtype=float)
        free = tuple(shares[:, 0]) if shares[:, 0].sum() > 0 else fractions
        best = None
        for c in range(2):
            found = anneal(s, p, _start(df["group_id"], free, seed + c), goal, seed + c, steps)
            best = found if best is None or found[1] < best[1] else best
        at = best[0]
        only_matches = s == 0  # no rows to balance: by their hash, in the given proportions
        at[only_matches] = _start(df["group_id"], fractions, seed)[only_matches]
        return df.assign(split=at.astype("int64"))

    schema = "group_id string, rows long, positives long, split long"
    cast = lambda df: df.select("group_id", F.col("rows").cast("long").alias("rows"), F.col("positives").cast("long").alias("positives"))
    blocks = cast(rest).withColumn("_b", F.pmod(F.xxhash64("group_id", F.lit(seed)), F.lit(n_blocks)))
    annealed = blocks.groupBy("_b").applyInPandas(lambda df: block(df.drop(columns="_b")), schema)
    placed = placed.astype({"rows": "int64", "positives": "int64", "split": "int64"})
    return annealed.unionByName(spark.createDataFrame(placed[["group_id", "rows", "positives", "split"]], schema)) if len(placed) else annealed


def split_keys(matches: DataFrame, pairs: DataFrame, fractions: tuple[float, ...] = FRACTIONS, names: tuple[str, ...] = SPLITS, seed: int = 42) -> DataFrame:
    """(source1_entity_id, group_id, split) of every distinct written value of both tables; nulls get no split by key."""
    groups = key_groups(matches, pairs)
    placed = assign_components(component_sizes(groups, pairs), fractions, seed)
    name = F.element_at(F.array(*map(F.lit, names)), (F.col("split") + 1).cast("int"))
    return groups.join(placed.select("group_id", name.alias("split")), "group_id").select(F.col("written").alias("source1_entity_id"), "group_id", "split")


def split_rows(df: DataFrame, keys: DataFrame, null_split: str = SPLITS[0]) -> DataFrame:
    """df plus split. The keys are one row per value, so a hot value is joined without moving its rows into one task where keys are small or AQE splits it; rows with a null value get null_split."""
    out = df.join(keys.select("source1_entity_id", F.col("split").alias("_split")), "source1_entity_id", "left")
    return out.select(*df.columns, F.coalesce("_split", F.lit(null_split)).alias("split"))


def split_report(matches: DataFrame, pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """Per split: rows of either table, share of the pairs' rows, and share of positives among them."""
    kinds = pairs.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("pair_rows"), F.count_if(F.col("label") == 1).alias("positives"), F.lit(0).cast("long").alias("match_rows"))
    more = matches.groupBy("source1_entity_id").agg(F.lit(0).cast("long").alias("pair_rows"), F.lit(0).cast("long").alias("positives"), F.count(F.lit(1)).alias("match_rows"))
    per = split_rows(kinds.unionByName(more), keys).groupBy("split").agg(*(F.sum(c).alias(c) for c in ("match_rows", "pair_rows", "positives")))
    all_rows = per.agg(F.sum("pair_rows").alias("_t"))
    return per.join(F.broadcast(all_rows), F.lit(True)).select(
        "split", "match_rows", "pair_rows", F.try_divide(F.col("pair_rows").cast("double"), F.col("_t").cast("double")).alias("share"),
        F.try_divide(F.col("positives").cast("double"), F.col("pair_rows").cast("double")).alias("positive_share"),
    )
