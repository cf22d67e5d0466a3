"""Shared folders, intermediate tables and small helpers of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the cluster names in ``spark.checkpoint.dir``. Where that is unset, one machine
    (tests) uses a folder of this process, removed at its end; on a cluster nothing else would be
    seen by all, so that is an error.
    """
    global _own_dir
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="lakemoor-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return f"file://{_own_dir}"


#: Paths of the tables that are still there, with their file systems.
_tables: dict[str, tuple] = {}


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here.

    A lost executor costs nothing that was written, as the files are not its own. The table goes
    with :func:`discard`, or else when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lakemoor-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lakemoor_path = path
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    _tables[path] = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialise` that nothing reads any more."""
    for t in tables:
        _delete(t._lakemoor_path)


def _delete(path: str) -> None:
    store, at = _tables.pop(path)
    store.delete(at, True)


@atexit.register
def _delete_all() -> None:
    for path in list(_tables):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001 (the JVM may be gone; then only disk space is lost)
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package, wherever the driver got it from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="lakemoor-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/lakemoor_code.zip", "w") as z:
        for p in sorted((root / "lakemoor").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(f"{folder}/lakemoor_code.zip")
    _shipped.add(app)


def map_arrow(df: DataFrame, f, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(f, schema)
