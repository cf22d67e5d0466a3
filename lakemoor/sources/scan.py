"""The lazy, snapshot-pinned scan."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemoor.errors import EngineError, translating
from lakemoor.session import apply_storage_options, resolve_uri
from lakemoor.sources.manifest import FOLDER, Store


def scan_dataset(spark: SparkSession, source: str | Path, *, storage_options: dict[str, str] | None = None, version: int | None = None, ordered: bool = False) -> DataFrame:
    """A DataFrame over one version of a dataset, the newest at the time of the call.

    The schema and the list of files come from the manifest, so planning reads no data and later
    commits do not show. Projections, filters and limits are Spark's to push down: name columns and
    conditions on the result. Without ``ordered`` the order of rows is undefined; with it rows come
    as they were written. A plain Parquet file or folder is read as a dataset of one version.
    """
    apply_storage_options(spark, storage_options)
    uri = resolve_uri(source)
    with translating():
        store = Store(spark, uri)
        manifest = store.load(version)
        if manifest is None:
            if version is not None or store.exists(FOLDER) or not store.exists():
                raise FileNotFoundError(f"no dataset{'' if version is None else f' version {version}'} at {uri}")
            return spark.read.parquet(uri)
        if not manifest.files:
            return spark.createDataFrame([], manifest.schema)
        try:
            df = spark.read.schema(manifest.schema).parquet(*[f"{uri}/{p}" for p, _ in manifest.files])
        except Exception as e:
            raise EngineError(f"data files of {uri} cannot be read: {e}") from e
    if ordered:  # folders are named by version, files by task
        df = df.orderBy(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return df


def pull(df: DataFrame, *, batch_size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of a query as Arrow batches, one partition at a time, so the caller holds one at most.

    Batches are made and serialised by the tasks. ``batch_size`` is the most rows of a batch; 0 or
    None leaves it to the engine.
    """

    def packed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size or max(batch.num_rows, 1)):
                part = batch.slice(at, batch_size or None)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as stream:
                    stream.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["batch"])

    with translating():
        for row in df.mapInArrow(packed, "batch binary").toLocalIterator(prefetchPartitions=True):
            with pa.ipc.open_stream(row.batch) as stream:
                yield from stream


def versions(spark: SparkSession, source: str | Path) -> list[int]:
    """The versions of a dataset."""
    return Store(spark, resolve_uri(source)).versions()
