"""Cutting lineage with written tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Written tables after which the driver's garbage is collected.
GC_EVERY = 3


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Only a local master may go without: it gets a temporary folder."""
    set_by_context = spark.sparkContext._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or (set_by_context.get() if set_by_context.isDefined() else None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="linkweave-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Written tables of one run; drop() removes those that nothing needs any more.

    Tables read back are never broadcast unless a broadcast is asked for: Spark would judge their size by the compressed files, which says little about what explode or aggregates make of them.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame, codec: str = "snappy") -> DataFrame:
        """df written as Parquet and read back: its lineage ends here, and losing an executor loses nothing of it. The tables live for a few steps, so the codec is one that costs little time."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path).hint("merge")
        out._scratch = path
        if self.n % GC_EVERY == 0:  # shuffle files of finished steps stay on disk until the driver's garbage is collected
            self.spark.sparkContext._jvm.System.gc()
        return out

    def drop(self, df: DataFrame) -> None:
        """df must come from write, and whatever reads it must have been written."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
