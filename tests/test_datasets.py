import datetime as dt
import threading
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemoor import CommitConflictError, EngineError, compact, pull, scan_dataset, sink_dataset, versions, write_dataset
from lakemoor.plans.pushdown import explain_pushdown
from lakemoor.sources.manifest import Manifest, Store
from lakemoor.types import from_arrow, storable
from lakemoor.versions import resolve


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, val string")


def test_modes(spark, tmp_path, frame):
    path = tmp_path / "d"
    write_dataset(frame, path)
    with pytest.raises(FileExistsError):
        write_dataset(frame, path)
    pinned = scan_dataset(spark, path)
    write_dataset(frame.select("val", "id"), str(path), mode="append")
    assert rows(scan_dataset(spark, path)) == sorted(rows(frame) * 2, key=repr)
    write_dataset(frame.limit(1), path, mode="overwrite")
    assert scan_dataset(spark, path).count() == 1
    assert rows(pinned) == rows(frame)
    assert rows(scan_dataset(spark, path, version=2)) == sorted(rows(frame) * 2, key=repr)
    assert versions(spark, path) == [1, 2, 3]
    for mode in ("append", "overwrite"):
        write_dataset(frame, tmp_path / mode, mode=mode)
        assert rows(scan_dataset(spark, tmp_path / mode)) == rows(frame)


def test_append_needs_the_same_columns(spark, tmp_path, frame):
    write_dataset(frame, tmp_path / "d")
    for other in (frame.select("id"), frame.withColumn("id", F.col("id").cast("int")), frame.withColumn("more", F.lit(1))):
        with pytest.raises(ValueError):
            write_dataset(other, tmp_path / "d", mode="append")
    assert versions(spark, tmp_path / "d") == [1]


@pytest.mark.parametrize(
    ("how", "message"),
    [
        ({"mode": "ignore"}, "`mode` must be one of"),
        ({"blob_columns": ["nope"]}, "not in the frame"),
        ({"blob_columns": ["id"]}, "has to be binary"),
        ({"data_storage_version": "9.9"}, "Unknown storage version"),
        ({"max_rows_per_file": 0}, "positive"),
        ({"storage_options": {"nope": "1"}}, "storage option"),
    ],
)
def test_wrong_arguments(tmp_path, frame, how, message):
    with pytest.raises(ValueError, match=message) as e:
        write_dataset(frame, tmp_path / "d", **how)
    assert not isinstance(e.value, EngineError)
    assert not (tmp_path / "d").exists()


def test_names(spark, tmp_path, frame):
    with pytest.raises(ValueError, match="'a.b'"):
        write_dataset(frame.withColumnRenamed("id", "a.b"), tmp_path / "d")
    for i, name in enumerate(("with space", "back`tick", "d-e", "Ünï")):
        write_dataset(frame.withColumnRenamed("id", name), tmp_path / f"e{i}")
        assert scan_dataset(spark, tmp_path / f"e{i}").columns == [name, "val"]


def test_missing_and_lost(spark, tmp_path, frame):
    with pytest.raises(FileNotFoundError):
        scan_dataset(spark, tmp_path / "none")
    write_dataset(frame, tmp_path / "d")
    with pytest.raises(FileNotFoundError):
        scan_dataset(spark, tmp_path / "d", version=7)
    (tmp_path / "d" / "data").rename(tmp_path / "away")
    with pytest.raises(EngineError):
        scan_dataset(spark, tmp_path / "d")
    (tmp_path / "d" / "_manifests" / "2.json").write_text("{")
    with pytest.raises(EngineError):
        scan_dataset(spark, tmp_path / "d")


def test_failing_query_commits_nothing(spark, tmp_path, frame):
    broken = frame.select(F.udf(lambda v: 1 // 0, "long")("id").alias("id"))
    with pytest.raises(RuntimeError, match="ZeroDivisionError") as e:
        sink_dataset(broken, tmp_path / "d", chunk_size=2)
    assert not isinstance(e.value, ValueError)
    with pytest.raises(FileNotFoundError):
        scan_dataset(spark, tmp_path / "d")
    write_dataset(frame, tmp_path / "e")
    with pytest.raises(RuntimeError):
        sink_dataset(broken, tmp_path / "e", mode="overwrite")
    assert rows(scan_dataset(spark, tmp_path / "e")) == rows(frame)


def test_conflicts(spark, tmp_path, frame):
    write_dataset(frame, tmp_path / "d")
    store = Store(spark, str(tmp_path / "d"))
    old = store.load()
    new = Manifest(2, old.storage_version, old.schema, old.files, "append")
    results = []

    def commit():
        try:
            store.commit(new)
            results.append("ok")
        except CommitConflictError:
            results.append("conflict")

    threads = [threading.Thread(target=commit) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(results) == ["conflict"] * 5 + ["ok"]
    assert issubclass(CommitConflictError, EngineError) and issubclass(EngineError, RuntimeError)
    assert [n for n, _ in store.names("_manifests")] == ["1.json", "2.json"]


def test_file_limits(spark, tmp_path):
    write_dataset(spark.range(10).coalesce(1), tmp_path / "d", max_rows_per_file=2)
    assert len(Store(spark, str(tmp_path / "d")).load().files) == 5
    write_dataset(spark.range(5).coalesce(1), tmp_path / "e", max_rows_per_file=2)
    assert len(Store(spark, str(tmp_path / "e")).load().files) == 3
    blobs = spark.range(1000).select("id", F.expr("unhex(concat_ws('', transform(sequence(1, if(id < 500, 8, 16)), k -> sha2(concat(id, '-', k), 512))))").alias("file")).coalesce(1)
    write_dataset(blobs, tmp_path / "f", max_bytes_per_file=100_000)
    files = Store(spark, str(tmp_path / "f")).load().files
    assert 8 <= len(files) <= 20 and max(n for _, n in files) <= 150_000
    assert [r.id for r in scan_dataset(spark, tmp_path / "f", ordered=True).collect()] == list(range(1000))
    assert len(list((tmp_path / "f" / "data").iterdir())) == 1  # the undivided files are gone
    write_dataset(blobs, tmp_path / "g", max_bytes_per_file=10**9)
    assert len(Store(spark, str(tmp_path / "g")).load().files) == 1
    write_dataset(blobs, tmp_path / "g", mode="overwrite", max_bytes_per_file=10**6, max_rows_per_file=10)
    assert len(Store(spark, str(tmp_path / "g")).load().files) == 100
    compact(spark, tmp_path / "f")
    assert len(Store(spark, str(tmp_path / "f")).load().files) == 1
    assert scan_dataset(spark, tmp_path / "f").count() == 1000


def test_compaction_yields_to_a_commit_in_between(spark, tmp_path, frame, monkeypatch):
    from lakemoor.operators import compaction

    write_dataset(frame, tmp_path / "d")
    write_dataset(frame, tmp_path / "d", mode="append")
    scan = compaction.scan_dataset

    def interrupted(*a, **k):
        df = scan(*a, **k)
        write_dataset(frame.limit(2), tmp_path / "d", mode="append")
        return df

    monkeypatch.setattr(compaction, "scan_dataset", interrupted)
    with pytest.raises(CommitConflictError):
        compact(spark, tmp_path / "d")
    assert scan_dataset(spark, tmp_path / "d").count() == 8 and versions(spark, tmp_path / "d") == [1, 2, 3]


def test_expected_version(spark, tmp_path, frame):
    write_dataset(frame, tmp_path / "d", expected_version=0)
    for mode in ("append", "overwrite"):
        for wrong in (0, 7):
            with pytest.raises(CommitConflictError):
                write_dataset(frame, tmp_path / "d", mode=mode, expected_version=wrong)
    write_dataset(frame, tmp_path / "d", mode="append", expected_version=1)
    assert scan_dataset(spark, tmp_path / "d").count() == 6
    with pytest.raises(ValueError, match="expected_version"):
        write_dataset(frame, tmp_path / "d", mode="append", expected_version=-1)


def test_conditional_writes(spark, tmp_path):
    """What object stores get, on a local file system."""
    store = Store(spark, str(tmp_path / "d"))
    assert store._create(store.path("_manifests", "1.json"), bytearray(b"one")) and not store._create(store.path("_manifests", "1.json"), bytearray(b"two"))
    assert (tmp_path / "d" / "_manifests" / "1.json").read_text() == "one"


def test_storage_options(spark):
    from lakemoor.session import apply_storage_options, resolve_uri

    apply_storage_options(spark, {"aws_access_key_id": "k", "aws_allow_http": "true", "azure_storage_account_name": "a", "azure_storage_account_key": "z", "fs.s3a.path.style.access": "true"})
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert [conf.get(x) for x in ("fs.s3a.access.key", "fs.s3a.connection.ssl.enabled", "fs.azure.account.key.a.blob.core.windows.net", "fs.s3a.path.style.access")] == ["k", "false", "z", "true"]
    assert [resolve_uri(u) for u in ("s3://b/d/", "az://c/d", "gs://b/d", "/tmp/d")] == ["s3a://b/d", "abfss://c/d", "gs://b/d", "/tmp/d"]


def test_empty_and_zero_rows(spark, tmp_path, frame):
    write_dataset(frame.limit(0), tmp_path / "d")
    got = scan_dataset(spark, tmp_path / "d")
    assert got.count() == 0 and got.columns == ["id", "val"]
    write_dataset(frame, tmp_path / "d", mode="append")
    assert scan_dataset(spark, tmp_path / "d").limit(0).collect() == []


def test_order(spark, tmp_path):
    for lo in (0, 100, 200):
        write_dataset(spark.range(lo, lo + 50).coalesce(1), tmp_path / "d", mode="append", max_rows_per_file=20)
    got = [r.id for r in scan_dataset(spark, tmp_path / "d", ordered=True).collect()]
    assert got == [*range(50), *range(100, 150), *range(200, 250)]


def test_nested_nulls(spark, tmp_path):
    schema = "id long, st struct<x:long,name:string>, los array<struct<x:long,name:string>>, lol array<array<long>>"
    data = [(1, (1, "p"), [(1, "a"), (2, "b")], [[1, 2], [3]]), (2, None, [], [[]]), (3, (None, None), None, None), (4, (2, None), [None, (4, None)], [None]), (5, (3, "q"), [(None, "e")], [[None]])]
    df = spark.createDataFrame(data, schema)
    write_dataset(df, tmp_path / "d")
    got = scan_dataset(spark, tmp_path / "d")
    assert rows(got) == rows(df)
    assert [r.id for r in got.filter("st is null").collect()] == [2]
    assert sorted(r.id for r in got.filter("st.x is null").collect()) == [2, 3]
    write_dataset(df.select("id", "st"), tmp_path / "old", data_storage_version="2.0")
    old = {r.id: r.st for r in scan_dataset(spark, tmp_path / "old").collect()}
    assert tuple(old[2]) == (0, "") and tuple(old[3]) == (None, None)


def test_blobs(spark, tmp_path):
    df = spark.createDataFrame([(1, b"a" * 500), (2, None), (3, b"cc")], "id long, blob binary")
    write_dataset(df, tmp_path / "d", blob_columns=["blob"])
    write_dataset(df, tmp_path / "d", mode="append")
    got = scan_dataset(spark, tmp_path / "d")
    assert got.schema["blob"].metadata == {"blob": True}
    assert got.filter("blob is null").count() == 2
    compact(spark, tmp_path / "d")
    again = scan_dataset(spark, tmp_path / "d")
    assert rows(again) == rows(got) and again.schema["blob"].metadata == {"blob": True}
    assert all("blob" not in r.read_schema for r in explain_pushdown(again.filter("id > 1").select("id")))
    write_dataset(df, tmp_path / "plain")
    assert scan_dataset(spark, tmp_path / "plain").schema["blob"].metadata == {}


def test_versions():
    assert [resolve(v, []) for v in (None, "stable", "2.0", "2.1", "2.2", "2.3")] == ["2.2", "2.1", "2.0", "2.1", "2.2", "2.3"]
    for v in ("0.1", "2.0", "2.1", "stable"):
        with pytest.raises(ValueError, match="blob_columns needs data storage"):
            resolve(v, ["b"])
    for v in ("2.2", "2.3", "next", None):
        resolve(v, ["b"])


def test_pushdown(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "abc", (1, "p"))], "i long, f double, s string, st struct<x:int,name:string>")
    write_dataset(df, tmp_path / "d")
    scan = scan_dataset(spark, tmp_path / "d")
    pushed = lambda c: set(explain_pushdown(scan.filter(c).select("i"))[0].pushed)
    assert pushed(F.col("i") > 3) == {"IsNotNull(i)", "GreaterThan(i,3)"}
    assert "LessThanOrEqual(i,3)" in pushed(~(F.col("i") > 3))
    assert "StringStartsWith(s,ab)" in pushed(F.col("s").startswith("ab"))
    assert "GreaterThan(st.x,4)" in pushed(F.col("st.x") > 4)
    assert pushed((F.col("i") > 3) & F.col("s").rlike("a")) >= {"GreaterThan(i,3)"}
    assert not any("Or(" in p for p in pushed((F.col("i") > 3) | F.col("s").rlike("a")))
    report = explain_pushdown(scan.filter("st.x > 4").select("st.x"))[0]
    assert report.read_schema == "struct<st:struct<x:int>>" and report.residual


def test_planning_reads_nothing(spark, tmp_path, frame):
    write_dataset(frame, tmp_path / "d")
    df = scan_dataset(spark, tmp_path / "d").filter("id > 1")
    (tmp_path / "d" / "data").rename(tmp_path / "away")
    assert df.columns == ["id", "val"]
    assert explain_pushdown(df)
    (tmp_path / "away").rename(tmp_path / "d" / "data")
    assert df.count() == 2


def test_arrow_types(spark, tmp_path):
    d, s = dt.date(2024, 1, 1), dt.timedelta(seconds=1)
    table = pa.table(
        {
            "u8": pa.array([1, 255], pa.uint8()),
            "u64": pa.array([1, 2**64 - 1], pa.uint64()),
            "f32": pa.array([1.5, -2.5], pa.float32()),
            "date64": pa.array([d, None], pa.date64()),
            "time": pa.array([dt.time(1, 2, 3), None], pa.time32("s")),
            "ts_ns": pa.array([dt.datetime(2024, 1, 1), None], pa.timestamp("ns")),
            "ts_tz": pa.array([dt.datetime(2024, 1, 1), None], pa.timestamp("us", tz="UTC")),
            "dur": pa.array([s, None], pa.duration("ms")),
            "fixed": pa.array([b"abc", None], pa.binary(3)),
            "large": pa.array(["x", None], pa.large_string()),
            "dec": pa.array([Decimal("1.23"), None], pa.decimal128(10, 2)),
            "fsl": pa.array([[1, 2], [3, 4]], pa.list_(pa.int32(), 2)),
            "dict": pa.array(["k", None]).dictionary_encode(),
            "st": pa.array([{"x": 1, "l": [1]}, None], pa.struct([("x", pa.uint16()), ("l", pa.large_list(pa.int8()))])),
        }
    )
    df = from_arrow(spark, table)
    write_dataset(df, tmp_path / "d")
    got = scan_dataset(spark, tmp_path / "d")
    assert got.dtypes == df.dtypes and rows(got) == rows(df)
    assert dict(df.dtypes)["u8"] == "smallint" and dict(df.dtypes)["u64"] == "decimal(20,0)"
    assert storable(pa.float16()) == pa.float32()
    with pytest.raises(NotImplementedError):
        storable(pa.decimal256(50, 2))


def test_streaming_batches_are_written_once(spark, tmp_path):
    from lakemoor.streaming.sink import stream_to_dataset

    spark.range(10).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    run = lambda where: stream_to_dataset(source, tmp_path / "out", checkpoint=str(where), query_name="q", available_now=True).awaitTermination()
    run(tmp_path / "c1")
    assert scan_dataset(spark, tmp_path / "out").count() == 10
    run(tmp_path / "c2")  # the same batch number again, as after a lost checkpoint
    assert scan_dataset(spark, tmp_path / "out").count() == 10


def test_scan_of_plain_parquet(spark):
    df = scan_dataset(spark, "/root/testdata/sf0.001/orders.parquet")
    assert df.count() == 1500


def test_pull(spark, tmp_path):
    write_dataset(spark.range(25).select("id", F.struct(F.col("id").alias("x")).alias("st")).coalesce(1), tmp_path / "d")
    df = scan_dataset(spark, tmp_path / "d")
    batches = list(pull(df, batch_size=10))
    assert [b.num_rows for b in batches] == [10, 10, 5]
    assert [r["st"]["x"] for b in batches for r in b.to_pylist()] == list(range(25))
    assert sum(b.num_rows for b in pull(df, batch_size=0)) == 25
