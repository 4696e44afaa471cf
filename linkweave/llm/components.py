"""Connected components of pairwise links by hash-to-min."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.operators.packed import id_code, id_of_code, id_plain_form
from linkweave.plans.lineage import Scratch

#: A vertex is hot if it holds more than this share of all rows; there are then at most 1 / HOT_SHARE hot vertices.
HOT_SHARE = 1 / 500
#: Clusters that are done are set aside once less than this share of the vertices is unsettled.
FEW = 1 / 20


def _with_minimum(cluster: DataFrame, minima: DataFrame, least: int, most: int) -> DataFrame:
    """Each (v, u) with the minimum m of v's cluster. most: rows of the largest cluster.

    Rows of hot vertices, those with more than least rows, stay where they are and get theirs from a broadcast of at most 1 / HOT_SHARE rows, so the join never
    brings a hot vertex's cluster into one task.
    """
    if most <= least:
        return cluster.join(minima.select("v", "m"), "v")
    hot = F.col("n") > least
    hot_rows = minima.where(hot).select("v", "m").collect()  # at most 1 / HOT_SHARE rows
    few = cluster.sparkSession.createDataFrame(hot_rows, minima.select("v", "m").schema)
    marked = cluster.join(F.broadcast(few.withColumnRenamed("m", "_hot")), "v", "left")
    cold = marked.where("_hot IS NULL").drop("_hot").join(minima.where(~hot).select("v", "m"), "v")
    return cold.unionByName(marked.where("_hot IS NOT NULL").withColumnRenamed("_hot", "m"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(id, group_id): every id of an edge with the smallest id it is linked to, directly or through others.

    Edges with a null end are ignored; an edge from an id to itself makes it a group of its own; repeated edges count once.
    Without edges the result is empty. Ids compare as their type does (strings by code point).
    """
    links = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    row = lambda v, u: F.struct(F.col(v).alias("v"), F.col(u).alias("u"))
    ends = links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return _settled(ends.select(F.explode(F.array(row("x", "x"), row("x", "y"), row("y", "x"))).alias("r")).select("r.*").distinct(), max_rounds)


def components_of_groups(groups: DataFrame, ids: str, max_rounds: int = 60) -> DataFrame:
    """connected_components where all ids of an array are linked to each other: a round less than from edges, as an array's minimum is known without a shuffle. Arrays without nulls; an empty one is ignored."""
    linked = groups.select(F.array_min(ids).alias("x"), F.explode(ids).alias("y"))
    row = lambda v, u: F.struct(F.col(v).alias("v"), F.col(u).alias("u"))
    return _settled(linked.select(F.explode(F.array(row("x", "y"), row("y", "x"))).alias("r")).select("r.*").distinct(), max_rounds)


def _open_minima(cluster: DataFrame, minima: DataFrame, open_: Column) -> DataFrame:
    """(m): the minima of all unsettled vertices and of the vertices in their clusters.

    No row of cluster leads from a vertex with one of these minima to one with another: of two vertices in a row of each other, with different minima, the one with the smaller minimum holds the other's too or is
    held by an unsettled one. cluster has with each row its reverse.
    """
    few = minima.where(open_).select("v", "m")
    near = cluster.join(few.select("v"), "v", "left_semi").select(F.col("u").alias("v")).distinct().join(minima.select("v", "m"), "v")
    return near.select("m").unionByName(few.select("m")).distinct()


def _settled(start: DataFrame, max_rounds: int) -> DataFrame:
    """(id, group_id) of the clusters (v, u) by hash-to-min. start: with each row its reverse, and of its two ends the smaller one holds itself.

    A vertex holds a cluster as rows (v, u). In each round it sends the whole cluster to the cluster's minimum and that minimum to all others. It is stable once every vertex but the minima
    holds nothing but its minimum: sending changes nothing then. A round is one aggregation, one join and one distinct over rows; no set is ever gathered, and minima are aggregated before
    they are shuffled. Rounds grow with the logarithm of the longest chain. Each round is written to the shared folder.
    """
    scratch = Scratch(start.sparkSession, "components")
    cluster = scratch.write(start)
    settled = None
    for _ in range(max_rounds):
        minima = scratch.write(cluster.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")))
        zero = F.lit(0)
        open_ = (F.col("m") < F.col("v")) & (F.col("n") > 1)
        total, most, held, unsettled = minima.agg(*(F.coalesce(x, zero) for x in (F.sum("n"), F.max("n"), F.count(F.lit(1)))), F.count_if(open_)).first()
        if not unsettled:
            scratch.drop(cluster)
            done = minima.select(F.col("v").alias("id"), F.col("m").alias("group_id"))
            return done if settled is None else settled.unionByName(done)
        if unsettled < held * FEW:  # the clusters that are done take no part any more
            labels = scratch.write(_open_minima(cluster, minima, open_))
            done = scratch.write(minima.join(labels, "m", "left_anti").select(F.col("v").alias("id"), F.col("m").alias("group_id")))
            settled = done if settled is None else settled.unionByName(done)
            minima, all_ = scratch.write(minima.join(labels, "m", "left_semi").select("v", "m", "n")), minima
            for old in (all_, labels):
                scratch.drop(old)
        sent = _with_minimum(cluster, minima, max(10_000, int(total * HOT_SHARE)), most)
        after = scratch.write(sent.select(F.explode(F.array(F.struct(F.col("m").alias("v"), "u"), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("r")).select("r.*").distinct())
        scratch.drop(cluster)
        scratch.drop(minima)
        cluster = after
    raise RuntimeError(f"not stable after {max_rounds} rounds")


def plain_id_components(links: DataFrame) -> DataFrame:
    """connected_components of links (a, b) between plain-form ids, on longs that sort alike; on the strings if some id has more than 16 digits."""
    scratch = Scratch(links.sparkSession, "links")
    coded = scratch.write(links.where("a IS NOT NULL AND b IS NOT NULL").select(id_code(F.col("a")).alias("a"), id_code(F.col("b")).alias("b")))
    if coded.where("a IS NULL OR b IS NULL").limit(1).count():
        return connected_components(links)
    return connected_components(coded).select(id_of_code(F.col("id")).alias("id"), id_of_code(F.col("group_id")).alias("group_id"))


def linked_records(pairs: DataFrame, left: str, right: str, label: str = "label") -> DataFrame:
    """(record_id, group_id) in plain form of all records in a pair with label 1.

    An id that denotes no record in any notation makes no link. Pairs with label 0 or null are ignored, also where another row of the pair has label 1.
    """
    edges = pairs.where(F.col(label) == 1).select(id_plain_form(F.col(left)).alias("a"), id_plain_form(F.col(right)).alias("b"))
    return plain_id_components(edges).select(F.col("id").alias("record_id"), "group_id")
