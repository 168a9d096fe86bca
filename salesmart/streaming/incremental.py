"""The incremental load as a Structured Streaming query.

Raw record files land in a folder (one or more per month). The file source picks up only
files it has not seen (tracked in the checkpoint), and each micro-batch goes through the same
load as a batch run (``plans.workflow.load_records``): rejects and skipped rows kept by run,
first row of each new key into both layers, every record accounted for. A micro-batch is a run of
its own, of any month, named by its number, so one that is replayed after a failure replaces its
reports and inserts nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from salesmart.plans.workflow import load_records
from salesmart.sources.layers import read_layer
from salesmart.sources.raw import read_landing


def start_incremental_stream(spark: SparkSession, landing_path: str, base: str, checkpoint_path: str,
                             max_files_per_trigger: int | None = None,
                             available_now: bool = True) -> StreamingQuery:
    """Start the stream into the layers under ``base``; with ``available_now`` it processes what has
    landed and stops."""
    landing = read_landing(spark, landing_path, stream_files=max_files_per_trigger, stream=True)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_records(batch.sparkSession, batch, base, f"batch-{batch_id}", None, f"{base.rstrip('/')}/scratch")

    writer = landing.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_incremental_stream(spark: SparkSession, landing_path: str, base: str,
                           checkpoint_path: str, **kw) -> DataFrame:
    """Run the stream to completion over the landed files and return the integration layer."""
    query = start_incremental_stream(spark, landing_path, base, checkpoint_path, **kw)
    query.awaitTermination()
    return read_layer(spark, f"{base.rstrip('/')}/int/sales")
