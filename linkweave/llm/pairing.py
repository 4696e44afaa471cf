"""All pairs within groups, where a query asks for pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweave.plans.lineage import Scratch

#: Members that are gathered in one row.
SMALL = 64
#: Rows of gathered members of a large group that one task pairs with the whole group.
SLICE = 16


def pairs_within(members: DataFrame, group: str, member: str, a: str, b: str) -> DataFrame:
    """(a, b) with a < b for all two different members of a group; members: distinct (group, member), neither null.

    The result is as large as the groups' squares by its definition. Members are put in order once, and gathered SMALL at a time: a small group is one row, which has its pairs. The rows of a larger one also meet each
    other: each SLICE of them meets a copy of those after it in a task of its own, so one hot group is spread over many tasks and never gathered.
    """
    scratch = Scratch(members.sparkSession, "pairs")
    keyed = members.select(F.xxhash64(group).alias("_h"), F.col(group).alias("_g"), F.col(member).alias("m"))  # numbers sort faster than texts that begin alike
    place = F.row_number().over(Window.partitionBy("_h", "_g").orderBy("m"))
    part = keyed.withColumn("_part", F.floor((place - 1) / SMALL).cast("int")).groupBy("_h", "_g", "_part").agg(F.sort_array(F.collect_list("m")).alias("m"))  # at most SMALL of them
    parts = scratch.write(part.withColumn("_n", F.size("m")).where("_n > 1 OR _part > 0"))
    firsts = parts.where("_n > 1").select("m", F.posexplode("m").alias("_i", a))
    inner = firsts.select(a, F.explode(F.slice("m", F.col("_i") + 2, F.size("m"))).alias(b))  # generated code, unlike lambdas
    left = parts.where(F.col("_n") == SMALL).select("_g", F.floor(F.col("_part") / SLICE).cast("int").alias("_k"), F.col("_part").alias("_p"), F.col("m").alias("_x"))
    right = parts.where("_part > 0").select("_g", F.explode(F.sequence(F.lit(0), F.floor(F.col("_part") / SLICE).cast("int"))).alias("_k"), "_part", F.col("m").alias("_y"))
    across = left.join(right, ["_g", "_k"]).where("_p < _part").select(F.explode("_x").alias(a), "_y").select(a, F.explode("_y").alias(b))
    return inner.unionByName(across)
