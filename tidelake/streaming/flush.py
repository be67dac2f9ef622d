"""Chunks of landed bronze rows flow into the lake as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelake.schemas import BRONZE_SCHEMAS
from tidelake.sources.atomic import add_commit_manifests, upsert_atomic


def chunk_flush(
    spark: SparkSession,
    landing: str,
    root: str,
    dataset_type: str,
    checkpoint: str,
    files_per_batch: int = 100,
) -> None:
    """Upsert all files that landed since the last call, batch by batch, then stop.

    Each batch is one commit of the lake, keyed by checkpoint and number, and is described below ``_manifests``. The streaming
    checkpoint records finished batches; a batch that is run again finds its key in the commit log and adds nothing, so a
    restart neither skips nor repeats data, and readers never meet half a batch.
    """

    def flush(batch: DataFrame, number: int) -> None:
        upsert_atomic(spark, batch, root, dataset_type, key=f"{checkpoint}#{number}")
        add_commit_manifests(spark, root, dataset_type)

    query = (
        spark.readStream.schema(BRONZE_SCHEMAS[dataset_type])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .writeStream.foreachBatch(flush)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
