"""Filling containers of fixed capacity by minimum bin slack."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.plans.lineage import Scratch

CAPACITY = 2_048
#: Items per block that one task packs, on average.
BLOCK = 20_000
#: Containers of a block with more unused space than this share are opened again and their items packed together with other blocks' leftovers.
LOOSE = 1 / 64

_SCHEMA = "piece_id long, doc_id long, piece_no int, start_token long, n_tokens int, container_id long"
_OUT = ("doc_id", "piece_no", "start_token", "n_tokens", "container_id")


def fullest(lengths: list[int], available: Counter, capacity: int) -> list[int]:
    """Lengths of available items that together fill capacity best, the longest item always among them.

    Bitset subset-sum: bit s of a row says that s can be reached with the lengths so far; a row per item used keeps the way back. lengths: those available,
    rising. Only as many items are looked at as it takes to fill the capacity exactly, or all that fit.
    """
    longest = lengths[-1]
    room = capacity - longest
    rows, used = [1], []
    full, goal = (1 << (room + 1)) - 1, 1 << room
    reach = 1
    for k in range(bisect_right(lengths, room) - 1, -1, -1):
        n = lengths[k]
        for _ in range(min(available[n] - (n == longest), room // n)):
            more = (reach | reach << n) & full
            if more == reach:
                break
            reach = more
            rows.append(reach)
            used.append(n)
            if reach & goal:
                break
        if reach & goal:
            break
    at = reach.bit_length() - 1
    out = [longest]
    for i in range(len(used), 0, -1):
        if not rows[i - 1] >> at & 1:
            out.append(used[i - 1])
            at -= used[i - 1]
    return out


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Positions of the items of each container. No item may be longer than capacity; items of length 0 go into the first container."""
    by_length: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        by_length.setdefault(lengths[i], []).append(i)
    empty = by_length.pop(0, [])
    available = Counter({n: len(ix) for n, ix in by_length.items()})
    order = sorted(by_length)
    out = []
    while order:
        chosen = fullest(order, available, capacity)
        out.append([by_length[n].pop() for n in chosen])
        for n in chosen:
            available[n] -= 1
        for n in {n for n in chosen if not available[n]}:
            del order[bisect_left(order, n)]
    if empty:
        out = out or [[]]
        out[0] += empty[::-1]
    return out


def to_pieces(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece_no, start_token, n_tokens): one piece per document, or for longer ones as many full pieces as go in and the rest. Documents with a null id keep it."""
    n = F.coalesce(F.col("n_tokens"), F.lit(0))
    last = F.greatest(F.ceil(n / capacity) - 1, F.lit(0)).cast("int")
    rows = sizes.select("doc_id", n.alias("_n"), F.explode(F.sequence(F.lit(0), last)).alias("piece_no"))
    start = F.col("piece_no").cast("long") * capacity
    return rows.select("doc_id", "piece_no", start.alias("start_token"), F.least(F.lit(capacity), F.col("_n") - start).cast("int").alias("n_tokens"))


def _pack_block(df: pd.DataFrame, capacity: int, salt: int) -> pd.DataFrame:
    df = df.sort_values(["n_tokens", "doc_id", "piece_no"]).reset_index(drop=True)
    ids = [0] * len(df)
    for members in pack(df["n_tokens"].tolist(), capacity):
        own = 4 * min(int(df["piece_id"].iloc[i]) for i in members) + salt  # of a piece in it, so no other container has it
        for i in members:
            ids[i] = own
    return df.assign(container_id=ids)[["piece_id", *_OUT]]


def fill_containers(sizes: DataFrame, capacity: int = CAPACITY, seed: int = 42) -> DataFrame:
    """(doc_id, piece_no, start_token, n_tokens, container_id): every document in a container of at most capacity tokens, none divided that fits into one.

    Blocks of about BLOCK pieces, by hash, are packed in parallel. Containers that a block could not fill (mostly its last) are opened and packed again together,
    in blocks of their own, so few loose containers are left however many blocks there are. Full pieces of long documents are containers as they are.
    A container's id is that of a piece in it, of which every row of the written table has its own, so ids never meet, whatever the documents' ids are.
    sizes: doc_id, n_tokens. Null and zero sizes take no space; rows with a null or repeated doc_id are documents of their own. An empty table gives an empty one.
    """
    scratch = Scratch(sizes.sparkSession, "packing")
    pieces = scratch.write(to_pieces(sizes, capacity).withColumn("piece_id", F.monotonically_increasing_id()))
    full = pieces.where(F.col("n_tokens") == capacity).withColumn("container_id", F.col("piece_id") * 4 + 2)
    rest = pieces.where(F.col("n_tokens") < capacity)

    def packed(df: DataFrame, n: int, salt: int) -> DataFrame:
        blocks = max(1, -(-n // BLOCK))
        keyed = df.withColumn("_b", F.pmod(F.xxhash64("piece_id", F.lit(seed + salt)), F.lit(blocks)))
        return keyed.groupBy("_b").applyInPandas(lambda x: _pack_block(x, capacity, salt), _SCHEMA)

    first = scratch.write(packed(rest, rest.count(), 0))
    fill = first.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    loose = fill.where(F.col("used") < int(capacity * (1 - LOOSE))).select("container_id")
    opened = scratch.write(first.join(loose, "container_id", "left_semi").drop("container_id"))
    again = packed(opened, opened.count(), 1)
    kept = first.join(loose, "container_id", "left_anti")
    return full.select(*_OUT).unionByName(kept.select(*_OUT)).unionByName(again.select(*_OUT))


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: documents, pieces, containers, tokens, and the share of the containers' space that is used."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    docs = packed.agg(F.count_if(F.col("piece_no") == 0).alias("documents"))
    out = per.agg(F.coalesce(F.sum("pieces"), F.lit(0)).alias("pieces"), F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("tokens"), F.max("used").alias("fullest"))
    share = F.try_divide(F.col("tokens").cast("double"), F.col("containers") * F.lit(float(capacity)))
    return docs.join(F.broadcast(out), F.lit(True)).withColumn("fill", share)


def packing_faults(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row that checks a packing against its sizes: documents, and how many of them are lost, changed in length, or divided though they fit; and containers above capacity. doc_id must be unique."""
    scratch = Scratch(sizes.sparkSession, "faults")
    packed = scratch.write(fill_containers(sizes, capacity))
    whole = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("packed"), F.count(F.lit(1)).alias("pieces"))
    n = F.coalesce("n_tokens", F.lit(0))
    each = sizes.select("doc_id", n.alias("n")).join(whole, "doc_id", "left")
    faults = each.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("pieces").isNull()).alias("lost"), F.count_if(F.col("packed") != F.col("n")).alias("changed"),
        F.count_if((F.col("pieces") > 1) & (F.col("n") <= capacity)).alias("divided"),
    )
    over = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used")).agg(F.count_if(F.col("used") > capacity).alias("overfull"))
    return faults.join(F.broadcast(over), F.lit(True))
