"""Rewriting a dataset's small files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakemoor.session import resolve_uri
from lakemoor.sources.manifest import Store
from lakemoor.sources.scan import scan_dataset
from lakemoor.sources.write import write_dataset


def compact(spark: SparkSession, target: str | Path, *, file_bytes: int = 512 << 20) -> None:
    """Write the newest version anew in files of about ``file_bytes``, as a version of its own; values, nulls and blob marks stay.

    Rows are dealt by their place, so files are even without a shuffle by any key. The version that
    was read is the one that is replaced: a commit in between wins and leaves the dataset as that
    writer left it (CommitConflictError).
    """
    manifest = Store(spark, resolve_uri(target)).load()
    if manifest is None:
        raise FileNotFoundError(f"no dataset at {target}")
    n = max(1, -(-sum(size for _, size in manifest.files) // file_bytes))
    df = scan_dataset(spark, target, version=manifest.version)
    if n < len(manifest.files):
        df = df.repartitionByRange(n, F.col("_metadata.file_path"), F.col("_metadata.row_index")) if n > 1 else df.coalesce(1)
    write_dataset(df, target, mode="overwrite", data_storage_version=manifest.storage_version, blob_columns=[f.name for f in manifest.schema if f.metadata.get("blob")], expected_version=manifest.version)
