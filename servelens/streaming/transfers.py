"""Monthly transfer files as a stream (C1 as Structured Streaming).

The transfer matrix is the sum of ``return_volume`` over monthly files.  When
files arrive one month at a time, the same aggregation runs incrementally:
the file source picks up new files, the keyed sums live in the state store
(one entry per six-key group, bounded by the key space, not by the rows), and
each micro-batch replaces the snapshot of the full matrix.  Checkpoints go to
the given folder, which on a cluster must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from servelens import constants as K
from servelens.plans.constraints import transfer_matrix
from servelens.sinks.writers import write_snapshot
from servelens.sources.tables import TRANSFER_FILE_SCHEMA, rename_headers


def transfer_stream(spark: SparkSession, folder: str, fmt: str = "csv", schema=TRANSFER_FILE_SCHEMA) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    return rename_headers(reader.format(fmt).load(folder), K.TRANSFER_HEADERS)


def run_transfer_matrix(spark: SparkSession, folder: str, out_path: str, checkpoint: str, fmt: str = "csv",
                        available_now: bool = True):
    """Start the incremental transfer matrix; returns the streaming query.

    ``available_now`` processes every file present and stops (batch-like
    scheduling with streaming state); otherwise it keeps watching the folder.
    """
    agg = transfer_matrix(transfer_stream(spark, folder, fmt))

    def replace_snapshot(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(batch, out_path)

    w = agg.writeStream.outputMode("complete").foreachBatch(replace_snapshot).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
