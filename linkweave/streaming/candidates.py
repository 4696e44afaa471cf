"""Candidates for source-1 rows that arrive as a stream, against a stored pool."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkweave.config import CandidateConfig
from linkweave.operators.blocking import candidate_lists, generate_candidates


def stream_candidates(s1: DataFrame, pool: DataFrame, config: CandidateConfig, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Writes one row per arriving source-1 row to Parquet at path, one folder per micro-batch, so a repeated batch replaces its own output.

    s1: streaming, cleaned, with the columns of QUERY_COLUMNS. pool: static.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("ordinal", F.monotonically_increasing_id()).persist()  # one numbering for both uses
        try:
            lists = candidate_lists(rows, generate_candidates(rows, pool, config))
            lists.select("source1_entity_id", "candidate_entity_ids", "n_candidates").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            rows.unpersist()

    return s1.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
