"""The versioned dataset: immutable Parquet files and one manifest for each version.

``<uri>/_manifests/<n>.json`` names schema, storage version and files of version n. A version is
committed by moving a finished manifest to its name, or by a conditional write in object stores;
both fail if another writer was first.
Nothing that a manifest names is ever changed or deleted, so a reader keeps its snapshot.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from lakemoor.errors import CommitConflictError, EngineError

FOLDER = "_manifests"
#: Schemes whose rename() is a copy; a version is committed there by a conditional write.
OBJECT_STORES = ("s3a", "s3", "gs")


@dataclass
class Manifest:
    version: int
    storage_version: str
    schema: T.StructType
    #: Path within the dataset and bytes, in the order of writing.
    files: list[tuple[str, int]]
    operation: str
    #: Streaming query -> its last batch that is part of this version.
    batches: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "storage_version": self.storage_version, "schema": self.schema.jsonValue(), "files": self.files, "operation": self.operation, "batches": self.batches})

    @staticmethod
    def from_json(text: str) -> Manifest:
        try:
            x = json.loads(text)
            return Manifest(x["version"], x["storage_version"], T.StructType.fromJson(x["schema"]), [(p, n) for p, n in x["files"]], x["operation"], x.get("batches", {}))
        except (ValueError, KeyError, TypeError) as e:
            raise EngineError(f"a manifest cannot be read: {e}") from e


class Store:
    """A dataset's folder, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, uri: str) -> None:
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.uri = uri
        self.fs = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.uri, *parts]))

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.path(*parts))

    def names(self, *parts: str) -> list[tuple[str, int]]:
        """Names and bytes of the files in a folder."""
        if not self.exists(*parts):
            return []
        return sorted((s.getPath().getName(), s.getLen()) for s in self.fs.listStatus(self.path(*parts)) if s.isFile())

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n, _ in self.names(FOLDER) if n.endswith(".json") and n[:-5].isdigit())

    def load(self, version: int | None = None) -> Manifest | None:
        """The manifest of a version, by default the newest; None if there is none."""
        known = self.versions()
        if not known or version is not None and version not in known:
            return None
        stream = self.fs.open(self.path(FOLDER, f"{known[-1] if version is None else version}.json"))
        try:
            return Manifest.from_json(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, manifest: Manifest) -> None:
        """Publish a version, or CommitConflictError if it exists by now."""
        final, content = self.path(FOLDER, f"{manifest.version}.json"), bytearray(manifest.to_json().encode())
        if self.fs.getUri().getScheme() in OBJECT_STORES:
            made = self._create(final, content)
        else:
            draft = self.path(FOLDER, f".{uuid.uuid4().hex}.draft")
            self._write(self.fs.create(draft, False), content)
            try:
                made = self._move(draft, final)
            finally:
                self.fs.delete(draft, False)
        if not made:
            raise CommitConflictError(f"version {manifest.version} of {self.uri} was committed by another writer")

    @staticmethod
    def _write(out, content: bytearray) -> None:
        try:
            out.write(content)
        finally:
            out.close()

    def _create(self, final, content: bytearray) -> bool:
        """Write an object that must not exist, in one request: it shows when it is whole, and of two writers the store lets one through (conditional writes)."""
        builder = self.fs.createFile(final).overwrite(False).recursive()
        builder.opt("fs.option.create.conditional.overwrite", "true")
        try:
            self._write(builder.build(), content)
        except Py4JJavaError as e:
            if self._taken(e):
                return False
            raise
        return True

    @staticmethod
    def _taken(e: Py4JJavaError) -> bool:
        text = f"{e.java_exception.getClass().getName()} {e.java_exception.getMessage()}"
        return "FileAlreadyExists" in text or "412" in text or "Precondition" in text

    def _move(self, draft, final) -> bool:
        """Move unless the target exists, in one step of the file system."""
        if self.fs.getUri().getScheme() == "file":  # a hard link fails if the name is taken; rename() would replace
            files, uri = self.jvm.java.nio.file.Files, self.fs.makeQualified
            try:
                files.createLink(self.jvm.java.nio.file.Paths.get(uri(final).toUri()), self.jvm.java.nio.file.Paths.get(uri(draft).toUri()))
            except Py4JJavaError as e:
                if self._taken(e):
                    return False
                raise
            return True
        return self.fs.rename(draft, final)  # false if the target exists: the contract of file systems with an atomic rename (HDFS, ABFS)

    def remove(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)
