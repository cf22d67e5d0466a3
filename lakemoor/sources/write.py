"""Writing datasets: one path for frames and queries of any size, as Spark streams each task's rows to its files."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemoor.errors import CommitConflictError, EngineError, translating
from lakemoor.session import apply_storage_options, resolve_uri
from lakemoor.sources.manifest import FOLDER, Manifest, Store
from lakemoor.types import check_names, column
from lakemoor.versions import WITHOUT_STRUCT_NULLS, resolve

MODES = ("error", "append", "overwrite")


def _check(df: DataFrame, mode: str, limits: dict[str, int | None], version: str | None, blobs: list[str]) -> str:
    if mode not in MODES:
        raise ValueError("`mode` must be one of: 'error', 'append', 'overwrite'")
    resolved = resolve(version, blobs)
    for name, value in limits.items():
        if value is not None and (not isinstance(value, int) or isinstance(value, bool) or value < 1):
            raise ValueError(f"`{name}` must be a positive integer")
    check_names(df.schema)
    for name in blobs:
        if name not in df.columns:
            raise ValueError(f"blob column {name!r} is not in the frame")
        if not isinstance(df.schema[name].dataType, T.BinaryType):
            raise ValueError(f"blob column {name!r} has to be binary, not {df.schema[name].dataType.simpleString()}")
    return resolved


def _filled(c: Column, t: T.DataType) -> Column:
    """Structs without nulls of their own: a null one holds zeros and empty strings instead."""
    if isinstance(t, T.ArrayType) and _has_struct(t.elementType):
        return F.transform(c, lambda x: _filled(x, t.elementType))
    if not isinstance(t, T.StructType):
        return c
    inner = F.struct(*[_filled(c.getField(f.name), f.dataType).alias(f.name) for f in t])
    return F.when(c.isNull(), F.struct(*[_filler(f.dataType).alias(f.name) for f in t])).otherwise(inner)


def _has_struct(t: T.DataType) -> bool:
    return isinstance(t, T.StructType) or isinstance(t, T.ArrayType) and _has_struct(t.elementType)


def _filler(t: T.DataType) -> Column:
    if isinstance(t, T.StructType):
        return F.struct(*[_filler(f.dataType).alias(f.name) for f in t])
    if isinstance(t, T.StringType):
        return F.lit("")
    if isinstance(t, T.BooleanType):
        return F.lit(False)
    if isinstance(t, T.NumericType):
        return F.lit(0).cast(t)
    return F.lit(None).cast(t)


def _nullable(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_nullable(t.keyType), _nullable(t.valueType), True)
    return t


def _plain(t: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in t]


def _write_files(store: Store, df: DataFrame, folder: str, most_rows: int | None) -> list[tuple[str, int]]:
    writer = df.write if most_rows is None else df.write.option("maxRecordsPerFile", most_rows)
    writer.parquet(f"{store.uri}/{folder}")
    return [(f"{folder}/{n}", size) for n, size in store.names(folder) if n.startswith("part-")]


def _write_divided(store: Store, schema: T.StructType, files: list[tuple[str, int]], folder: str, most_rows: int | None, most_bytes: int) -> list[tuple[str, int]]:
    """The rows of some files anew, in their order, in files of so many rows that the file with the largest rows would be within the limit."""
    rows = store.spark.read.schema(schema).parquet(*[f"{store.uri}/{p}" for p, _ in files])
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    each = rows.groupBy(file.alias("f")).agg((F.max("_metadata.file_size") / F.count("*")).alias("bytes"))
    fit = max(1, int(most_bytes / each.agg(F.max("bytes")).first()[0]))
    tasks = max(1, -(-sum(size for _, size in files) // max(most_bytes, 64 << 20)))
    ordered = rows.repartitionByRange(tasks, file, place).sortWithinPartitions(file, place) if tasks > 1 else rows.coalesce(1).sortWithinPartitions(file, place)
    return _write_files(store, ordered.select(*[column(n) for n in schema.names]), folder, fit if most_rows is None else min(fit, most_rows))


def write_dataset(
    df: DataFrame,
    target: str | Path,
    *,
    mode: str = "error",
    storage_options: dict[str, str] | None = None,
    max_rows_per_file: int | None = None,
    max_bytes_per_file: int | None = None,
    data_storage_version: str | None = None,
    blob_columns: list[str] | None = None,
    batch: tuple[str, int] | None = None,
    expected_version: int | None = None,
) -> None:
    """Write ``df`` as a new version of the dataset at ``target``.

    mode: "error" if the dataset must not exist, "append", or "overwrite" (older versions stay
    readable). Columns of an append are paired by name. ``max_rows_per_file`` bounds each file; the
    number of files is exact if one task writes (``df.coalesce(1)``). ``max_bytes_per_file`` is soft:
    files that turn out larger are divided by the bytes of a row that they show.
    ``data_storage_version`` counts for a new dataset or an overwrite. ``blob_columns`` are marked in
    the schema. expected_version: the version that this write builds on (0: none yet); if another
    one is the newest by the time of the commit, CommitConflictError and no change. batch: (streaming query, batch number) that this
    write stands for; a batch that the dataset holds already is not written again.
    """
    blobs = list(blob_columns or [])
    if expected_version is not None and (not isinstance(expected_version, int) or expected_version < 0):
        raise ValueError("`expected_version` must be a version or 0")
    storage = _check(df, mode, {"max_rows_per_file": max_rows_per_file, "max_bytes_per_file": max_bytes_per_file}, data_storage_version, blobs)
    spark = df.sparkSession
    apply_storage_options(spark, storage_options)
    uri = resolve_uri(target)
    with translating():
        store = Store(spark, uri)
        old = store.load()
        if expected_version is not None and expected_version != (0 if old is None else old.version):
            raise CommitConflictError(f"the newest version of {uri} is {0 if old is None else old.version}, not {expected_version}")
        if mode == "error" and (old is not None or store.names()):
            raise FileExistsError(f"a dataset exists at {uri}")
        if old is not None and batch is not None and old.batches.get(batch[0], -1) >= batch[1]:
            return
        append = mode == "append" and old is not None
        schema = T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata | ({"blob": True} if f.name in blobs else {})) for f in df.schema])
        if append:
            storage = old.storage_version
            if sorted(_plain(schema)) != sorted(_plain(old.schema)):
                raise ValueError(f"the schema {schema.simpleString()} does not match the dataset's {old.schema.simpleString()}")
            schema = old.schema
        columns = [column(f.name) for f in schema]
        if storage == WITHOUT_STRUCT_NULLS:
            columns = [_filled(c, f.dataType).alias(f.name) if _has_struct(f.dataType) else c for c, f in zip(columns, schema, strict=True)]
        version = 1 if old is None else old.version + 1
        folder = f"data/{version:010d}-{uuid.uuid4().hex}"
        new = not store.exists()
        try:
            files = _write_files(store, df.select(*columns), folder, max_rows_per_file)
            if max_bytes_per_file is not None and any(size > max_bytes_per_file for _, size in files):
                folder, whole = f"{folder}-divided", folder
                try:
                    files = _write_divided(store, schema, files, folder, max_rows_per_file, max_bytes_per_file)
                finally:
                    store.remove(whole)
            batches = dict(old.batches) if old is not None else {}
            store.commit(Manifest(version, storage, schema, ([*old.files, *files] if append else files), "append" if append else mode, batches | ({batch[0]: batch[1]} if batch else {})))
        except BaseException:
            store.remove(folder)
            if new and not store.versions():
                store.remove("data")
                store.remove(FOLDER)
                if not store.fs.listStatus(store.path()) if store.exists() else False:
                    store.remove()
            raise


def sink_dataset(df: DataFrame, target: str | Path, *, chunk_size: int | None = None, **how) -> None:
    """Write the result of a query; like :func:`write_dataset`, whose arguments it takes.

    A failure in the query's own functions is an EngineError with their message, and nothing is
    committed. ``chunk_size``, a number of rows to hand over at once, is only validated: Spark
    hands rows over one by one. For streaming queries see :func:`lakemoor.streaming.sink.stream_to_dataset`.
    """
    if chunk_size is not None and (not isinstance(chunk_size, int) or chunk_size < 1):
        raise ValueError("`chunk_size` must be a positive integer")
    if df.isStreaming:
        raise EngineError("a streaming query is written with stream_to_dataset()")
    write_dataset(df, target, **how)
