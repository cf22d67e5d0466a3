"""Session settings that the engine's semantics rest on, scratch space, and cloud credentials."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.caseSensitive": "true",  # column names are compared exactly
    "spark.sql.timeType.enabled": "true",  # times of day are a type
    "spark.sql.session.timeZone": "UTC",
}

#: Storage option -> Hadoop settings. {account} is the storage account.
OPTIONS = {
    "aws_access_key_id": ["fs.s3a.access.key"],
    "aws_secret_access_key": ["fs.s3a.secret.key"],
    "aws_session_token": ["fs.s3a.session.token"],
    "aws_endpoint": ["fs.s3a.endpoint"],
    "aws_region": ["fs.s3a.endpoint.region"],
    "azure_storage_account_key": ["fs.azure.account.key.{account}.dfs.core.windows.net", "fs.azure.account.key.{account}.blob.core.windows.net"],
    "azure_endpoint": ["fs.azure.endpoint"],
    "google_service_account": ["fs.gs.auth.service.account.json.keyfile"],
}
SCHEMES = {"s3://": "s3a://", "az://": "abfss://", "gs://": "gs://"}

_own_dir: str | None = None


def build(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings."""
    builder = SparkSession.builder.config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def apply_storage_options(spark: SparkSession, options: dict[str, str] | None) -> None:
    """Hand credentials to the Hadoop file systems; ValueError for an unknown key."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    options = options or {}
    account = options.get("azure_storage_account_name", "")
    for key, value in options.items():
        if key in ("azure_storage_account_name", "azure_allow_http"):
            continue
        if key == "aws_allow_http":
            conf.set("fs.s3a.connection.ssl.enabled", str(value.lower() != "true").lower())
        elif key.startswith("fs."):
            conf.set(key, value)
        elif key in OPTIONS:
            for name in OPTIONS[key]:
                conf.set(name.format(account=account), value)
        else:
            raise ValueError(f"unknown storage option {key!r}; known are {', '.join(sorted(OPTIONS))} and Hadoop's fs.* settings")


def resolve_uri(source: object) -> str:
    """A path or URI as Hadoop reads it."""
    uri = str(source).rstrip("/")
    for scheme, own in SCHEMES.items():
        if uri.startswith(scheme):
            return own + uri[len(scheme) :]
    return uri


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir), or, on one machine, in a folder of this process if none is set."""
    global _own_dir
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _own_dir is None:
            _own_dir = tempfile.mkdtemp(prefix="lakemoor-scratch-")
            atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
        named = _own_dir
    return f"{named.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
