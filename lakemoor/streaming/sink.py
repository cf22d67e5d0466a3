"""A Structured Streaming sink into datasets, exactly once."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lakemoor.sources.write import write_dataset


def stream_to_dataset(df: DataFrame, target: str | Path, *, checkpoint: str, query_name: str, available_now: bool = False, **how) -> StreamingQuery:
    """Start a query that appends each micro-batch as one version.

    The manifest records the batch number under ``query_name``, so a batch that is replayed after a
    failure between its commit and the checkpoint's is not written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_dataset(batch, target, mode="append", batch=(query_name, number), **how)

    writer = df.writeStream.foreachBatch(write).queryName(query_name).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
