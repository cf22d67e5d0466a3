"""Registered queries over the engine's own operators, and the SQL that checks them.

The tables hold no nulls, so columns with nulls, NaN, structs and lists are derived (``orders_x``,
``part_x``, ``events_x``), by the same rules in Spark and in SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemoor.functions import predicates as P
from lakemoor.operators.compaction import compact
from lakemoor.plans.pushdown import explain_pushdown
from lakemoor.session import resolve_uri, scratch
from lakemoor.sources.manifest import Manifest, Store
from lakemoor.sources.scan import pull, scan_dataset
from lakemoor.sources.write import sink_dataset, write_dataset

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_dataset(spark, f"{sf_dir}/{name}.parquet")


def orders_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with a nullable integer k and a nullable struct st<x, name> whose x is nullable too."""
    nullif = lambda c, n: F.nullif(F.col(c) % n, F.lit(0))
    st = F.when(F.col("o_orderkey") % 5 != 0, F.struct(nullif("o_custkey", 11).alias("x"), F.col("o_orderstatus").alias("name")))
    return scan(spark, sf_dir, "orders").withColumns({"k": nullif("o_custkey", 7), "st": st})


def part_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with a list lst: null, empty, holding a null, or the words of the name."""
    r = F.col("p_partkey") % 9
    empty, null = F.array().cast("array<string>"), F.array(F.lit(None).cast("string"))
    lst = F.when(r == 0, F.lit(None)).when(r == 1, empty).when(r == 2, null).otherwise(F.split("p_name", " "))
    return scan(spark, sf_dir, "part").withColumns({"lst": lst, "nums": F.when(r != 0, F.array(r, F.nullif(F.col("p_partkey") % 3, F.lit(0))))})


def events_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a double f that is NaN, null, -0.0 and infinite at times."""
    r = F.col("event_id") % 10
    f = F.when(r == 0, F.lit(float("nan"))).when(r == 1, F.lit(None)).when(r == 2, F.lit(-0.0)).when(r == 3, F.lit(float("inf"))).otherwise(F.col("value"))
    return scan(spark, sf_dir, "events").withColumn("f", f)


ORDERS_SQL = "(SELECT *, nullif(o_custkey % 7, 0) AS k, CASE WHEN o_orderkey % 5 <> 0 THEN {'x': nullif(o_custkey % 11, 0), 'name': o_orderstatus} END AS st FROM orders)"
PART_SQL = (
    "(SELECT *, CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN CAST([] AS VARCHAR[]) WHEN 2 THEN CAST([NULL] AS VARCHAR[]) ELSE string_split(p_name, ' ') END AS lst, "
    "CASE WHEN p_partkey % 9 <> 0 THEN [p_partkey % 9, nullif(p_partkey % 3, 0)] END AS nums FROM part)"
)
EVENTS_SQL = "(SELECT *, CASE event_id % 10 WHEN 0 THEN CAST('nan' AS DOUBLE) WHEN 1 THEN NULL WHEN 2 THEN -0.0::DOUBLE WHEN 3 THEN CAST('inf' AS DOUBLE) ELSE value END AS f FROM events)"

#: Table -> how it is made, its SQL, and the columns that its queries return.
SOURCES = {
    "orders": (orders_x, ORDERS_SQL, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]),
    "part": (part_x, PART_SQL, ["p_partkey", "p_name", "p_type"]),
    "events": (events_x, EVENTS_SQL, ["event_id", "user_id"]),
    "lineitem": (lambda s, d: scan(s, d, "lineitem"), "lineitem", ["l_orderkey", "l_partkey", "l_linenumber"]),
    "conversations": (lambda s, d: scan(s, d, "conversations"), "conversations", ["conv_id", "turn", "role"]),
}


def where(key: str, table: str, condition: Column | Callable[[], Column], sql: str) -> None:
    """Register a filter query; condition is made lazily, as columns need a session."""
    make, source, columns = SOURCES[table]
    QUERIES[key] = lambda spark, sf_dir: make(spark, sf_dir).filter(condition()).select(*columns)
    ORACLES[key] = f"SELECT {', '.join(columns)} FROM {source} WHERE {sql}"


def query(key: str, sql: str | None = None):
    def register(f):
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return register


C = F.col


# Comparisons, literals of every type, boolean combinations.
for _name, _op, _f in (("eq", "=", lambda: C("o_custkey") == 700), ("ne", "<>", lambda: C("o_custkey") != 700), ("lt", "<", lambda: C("o_custkey") < 700), ("le", "<=", lambda: C("o_custkey") <= 700), ("gt", ">", lambda: C("o_custkey") > 700), ("ge", ">=", lambda: C("o_custkey") >= 700)):
    where(f"filter_{_name}", "orders", _f, f"o_custkey {_op} 700")
where("filter_float", "orders", lambda: C("o_totalprice") > 250000.5, "o_totalprice > 250000.5")
where("filter_string_eq", "orders", lambda: C("o_orderpriority") == "1-URGENT", "o_orderpriority = '1-URGENT'")
where("filter_string_gt", "orders", lambda: C("o_orderpriority") > "3", "o_orderpriority > '3'")
where("filter_bool", "orders", lambda: (C("o_custkey") % 3 == 0) == F.lit(True), "(o_custkey % 3 = 0) = true")
where("filter_bare_bool", "orders", lambda: C("o_custkey") % 3 == 0, "o_custkey % 3 = 0")
where("filter_timestamp", "orders", lambda: C("o_orderdate") > F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"), "o_orderdate > timestamp '1998-01-01 00:00:00'")
where("filter_timestamp_far", "orders", lambda: C("o_orderdate") < F.expr("timestamp_ntz'2500-01-01 00:00:00.000001'"), "o_orderdate < timestamp '2500-01-01 00:00:00.000001'")
where("filter_date", "orders", lambda: C("o_orderdate").cast("date") == dt.date(1998, 10, 3), "CAST(o_orderdate AS date) = date '1998-10-03'")
where("filter_and", "orders", lambda: (C("o_custkey") > 700) & (C("o_totalprice") < 100000), "o_custkey > 700 AND o_totalprice < 100000")
where("filter_or", "orders", lambda: (C("o_custkey") == 1) | (C("o_custkey") == 5), "o_custkey = 1 OR o_custkey = 5")
where("filter_and_partial", "orders", lambda: (C("o_custkey") > 700) & P.contains_regex(C("o_orderpriority"), "^[12]"), "o_custkey > 700 AND regexp_matches(o_orderpriority, '^[12]')")
where("filter_or_partial", "orders", lambda: (C("o_custkey") > 1400) | P.contains_regex(C("o_orderpriority"), "LOW"), "o_custkey > 1400 OR regexp_matches(o_orderpriority, 'LOW')")
where("filter_not", "orders", lambda: ~(C("o_custkey") > 700), "NOT (o_custkey > 700)")
where("filter_not_nullable", "orders", lambda: ~(C("k") > 2), "NOT (k > 2)")
# Nulls.
where("filter_is_null", "orders", lambda: C("k").isNull(), "k IS NULL")
where("filter_is_not_null", "orders", lambda: C("k").isNotNull(), "k IS NOT NULL")
where("filter_cmp_nullable", "orders", lambda: C("k") != 5, "k <> 5")
where("filter_eq_missing", "orders", lambda: P.eq_missing(C("k"), F.lit(None)), "k IS NOT DISTINCT FROM NULL")
where("filter_ne_missing", "orders", lambda: P.ne_missing(C("k"), F.lit(3)), "k IS DISTINCT FROM 3")
where("filter_null_combinations", "orders", lambda: C("k").isNull() | C("st").isNull(), "k IS NULL OR st IS NULL")
# Membership and ranges.
where("is_in_int", "orders", lambda: P.is_in(C("o_custkey"), [1, 5, 9]), "o_custkey IN (1, 5, 9)")
where("is_in_string", "orders", lambda: P.is_in(C("o_orderpriority"), ["5-LOW", "2-HIGH"]), "o_orderpriority IN ('5-LOW', '2-HIGH')")
where("is_in_narrow", "part", lambda: P.is_in(C("p_size"), [1, 2, 3]), "p_size IN (1, 2, 3)")
where("is_in_nulls_equal", "orders", lambda: P.is_in(C("k"), [1, None], nulls_equal=True), "k IN (1) OR k IS NULL")
where("is_in_not", "orders", lambda: ~P.is_in(C("k"), [1, 2]), "NOT (k IN (1, 2))")
where("is_in_empty", "orders", lambda: ~P.is_in(C("k"), []), "k IS NOT NULL")
for _closed, _lo, _hi in (("both", ">=", "<="), ("left", ">=", "<"), ("right", ">", "<="), ("none", ">", "<")):
    where(f"is_between_{_closed}", "orders", lambda closed=_closed: P.is_between(C("o_custkey"), 200, 800, closed), f"o_custkey {_lo} 200 AND o_custkey {_hi} 800")
# Strings.
where("str_contains_regex", "orders", lambda: P.contains_regex(C("o_orderpriority"), "S.E"), "regexp_matches(o_orderpriority, 'S.E')")
where("str_contains_regex_end", "orders", lambda: P.contains_regex(C("o_orderpriority"), "(W|H)$"), "regexp_matches(o_orderpriority, '(W|H)$')")
where("str_contains_literal", "part", lambda: P.contains_regex(C("p_name"), "red", literal=True), "contains(p_name, 'red')")
where("str_contains_literal_dot", "part", lambda: P.contains_regex(C("p_name"), "r.d", literal=True), "contains(p_name, 'r.d')")
where("str_starts_with", "part", lambda: P.starts_with(C("p_name"), "re"), "starts_with(p_name, 're')")
where("str_ends_with", "part", lambda: P.ends_with(C("p_name"), "ring"), "ends_with(p_name, 'ring')")
where("str_to_lowercase", "part", lambda: P.to_lowercase(C("p_type")) == "economy", "lower(p_type) = 'economy'")
where("str_to_uppercase", "part", lambda: P.to_uppercase(C("p_name")) == "RED WIDGET", "upper(p_name) = 'RED WIDGET'")
where("str_len_chars", "conversations", lambda: P.len_chars(C("text")) > 60, "length(text) > 60")
# Structs and lists.
where("struct_field_cmp", "orders", lambda: P.field(C("st"), "x") > 4, "st.x > 4")
where("struct_field_str", "orders", lambda: P.field(C("st"), "name") == "F", "st.name = 'F'")
where("struct_field_starts_with", "orders", lambda: P.starts_with(P.field(C("st"), "name"), "O"), "starts_with(st.name, 'O')")
where("struct_is_null", "orders", lambda: C("st").isNull(), "st IS NULL")
where("struct_field_isnull", "orders", lambda: P.field(C("st"), "x").isNull(), "st.x IS NULL")
where("struct_field_notnull", "orders", lambda: P.field(C("st"), "x").isNotNull(), "st.x IS NOT NULL")
where("struct_field_mixed", "orders", lambda: (P.field(C("st"), "x") > 4) & (C("o_orderkey") > 100), "st.x > 4 AND o_orderkey > 100")
where("list_len_gt", "part", lambda: P.list_len(C("lst")) > 1, "len(lst) > 1")
where("list_len_zero", "part", lambda: P.list_len(C("lst")) == 0, "len(lst) = 0")
where("list_is_null", "part", lambda: C("lst").isNull(), "lst IS NULL")
where("list_contains", "part", lambda: P.list_contains(C("lst"), "red"), "list_contains(lst, 'red')")
where("list_not_contains", "part", lambda: ~P.list_contains(C("lst"), "red"), "NOT list_contains(lst, 'red')")
where("list_contains_int", "part", lambda: P.list_contains(C("nums"), 2), "list_contains(nums, 2)")
where("list_eval_any", "part", lambda: F.exists(C("lst"), lambda e: e.startswith("s")), "len(list_filter(lst, lambda e: e LIKE 's%')) > 0")
where("list_get", "part", lambda: P.list_get(F.split("p_name", " "), 0) == "red", "string_split(p_name, ' ')[1] = 'red'")
# Floats.
where("float_nan_eq", "events", lambda: C("f") == float("nan"), "f = 'nan'::DOUBLE")
where("float_nan_ne", "events", lambda: C("f") != float("nan"), "f <> 'nan'::DOUBLE")
where("float_nan_gt", "events", lambda: C("f") > float("nan"), "f > 'nan'::DOUBLE")
where("float_nan_between", "events", lambda: P.is_between(C("f"), 400.0, float("nan")), "f >= 400.0 AND f <= 'nan'::DOUBLE")
where("float_gt_with_nan", "events", lambda: C("f") > 200, "f > 200")
where("float_zero", "events", lambda: C("f") == 0.0, "f = 0.0")
where("float_neg_zero", "events", lambda: C("f") == F.lit(-0.0), "f = -0.0")
where("float_inf", "events", lambda: C("f") >= float("inf"), "f >= 'inf'::DOUBLE")
where("float_is_finite", "events", lambda: P.is_finite(C("f")), "isfinite(f)")
where("float_is_not_finite", "events", lambda: ~P.is_finite(C("f")), "NOT isfinite(f)")
# Expressions whose dialects differ.
where("str_contains_regex_posix", "part", lambda: P.contains_regex(C("p_name"), "^[[:lower:]]+ [^[:upper:][:digit:]]+$"), "regexp_matches(p_name, '^[[:lower:]]+ [^[:upper:][:digit:]]+$')")
where("str_contains_regex_flags", "part", lambda: P.contains_regex(C("p_name"), "(?:(?i)RED)|(?m)ring$"), "regexp_matches(p_name, '(?:(?i)RED)|(?m)ring$')")
# Literals with a zone.
where("filter_timestamp_zoned", "orders", lambda: C("o_orderdate").cast("timestamp") > F.lit(dt.datetime(1998, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))), "o_orderdate > timestamp '1998-01-01 00:00:00'")
# Operands that stay above the scan.
where("col_vs_col", "lineitem", lambda: C("l_partkey") > C("l_orderkey"), "l_partkey > l_orderkey")
where("computed_operand", "lineitem", lambda: C("l_suppkey") > C("l_linenumber") + 90, "l_suppkey > l_linenumber + 90")
where("cast_operand", "orders", lambda: C("o_custkey").cast("string") == "55", "CAST(o_custkey AS VARCHAR) = '55'")

# Projections, limits, slices, other frame operations.
query("scan_all", "SELECT * FROM nation")(lambda s, d: scan(s, d, "nation"))
query("scan_project", "SELECT o_totalprice, o_orderkey FROM orders")(lambda s, d: scan(s, d, "orders").select("o_totalprice", "o_orderkey"))
query("head_n", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10")(lambda s, d: scan(s, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(10))
query("head_ordered_scan", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 7")(lambda s, d: scan(s, d, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(7))
query("filter_head", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey > 700 ORDER BY o_orderkey LIMIT 2")(lambda s, d: scan(s, d, "orders").filter("o_custkey > 700").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(2))
query("head_zero", "SELECT o_orderkey FROM orders LIMIT 0")(lambda s, d: scan(s, d, "orders").select("o_orderkey").limit(0))
query("slice", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5 OFFSET 20")(lambda s, d: scan(s, d, "orders").select("o_orderkey").orderBy("o_orderkey").offset(20).limit(5))
query("filter_unselected", "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000")(lambda s, d: scan(s, d, "orders").filter("o_totalprice > 300000").select("o_orderkey"))
query("count_rows", "SELECT count(*) AS n FROM lineitem")(lambda s, d: scan(s, d, "lineitem").agg(F.count("*").alias("n")))
query("concat_vertical", "SELECT * FROM region UNION ALL SELECT * FROM region")(lambda s, d: scan(s, d, "region").unionByName(scan(s, d, "region")))
query("with_columns", "SELECT o_orderkey, o_totalprice * 2 AS twice, o_custkey % 10 AS bucket, 'order-' || CAST(o_orderkey AS VARCHAR) AS name FROM orders")(
    lambda s, d: scan(s, d, "orders").select("o_orderkey", (C("o_totalprice") * 2).alias("twice"), (C("o_custkey") % 10).alias("bucket"), F.format_string("order-%d", "o_orderkey").alias("name"))
)
query("int_range", "SELECT i, i % 4 AS grp FROM range(1000) t(i)")(lambda s, d: s.range(1000).select(C("id").alias("i"), (C("id") % 4).alias("grp")))
query("drop_columns", "SELECT n_nationkey, n_regionkey FROM nation")(lambda s, d: scan(s, d, "nation").drop("n_name"))
query("drop_nulls", f"SELECT o_orderkey, k FROM {ORDERS_SQL} WHERE k IS NOT NULL")(lambda s, d: orders_x(s, d).select("o_orderkey", "k").dropna(subset=["k"]))
query("null_count", f"SELECT count(*) - count(k) AS nulls FROM {ORDERS_SQL}")(lambda s, d: orders_x(s, d).agg((F.count("*") - F.count("k")).alias("nulls")))
query("sql_over_scan", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")(lambda s, d: s.sql("SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderstatus", orders=scan(s, d, "orders")))
query("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")(lambda s, d: scan(s, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k")))


# Datasets: every query writes to a path of its own in the shared scratch space.
def _written(df: DataFrame, tag: str, **how) -> str:
    path = scratch(df.sparkSession, tag)
    write_dataset(df, path, **how)
    return path


REGION_SQL = "SELECT * FROM region"


@query("write_read", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey > 700 AND o_totalprice < 100000")
def write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(scan(spark, sf_dir, "orders"), "write-read")
    return scan_dataset(spark, path).filter((C("o_custkey") > 700) & (C("o_totalprice") < 100000)).select("o_orderkey", "o_custkey", "o_totalprice")


@query("write_append", f"{REGION_SQL} UNION ALL {REGION_SQL}")
def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "region")
    path = _written(df, "append")
    write_dataset(df.select(*reversed(df.columns)), path, mode="append")
    return scan_dataset(spark, path)


@query("write_overwrite", REGION_SQL)
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(scan(spark, sf_dir, "nation"), "overwrite")
    write_dataset(scan(spark, sf_dir, "region"), path, mode="overwrite")
    return scan_dataset(spark, path)


@query("snapshot_pinned", REGION_SQL)
def snapshot_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "region")
    path = _written(df, "pinned")
    pinned = scan_dataset(spark, path)
    write_dataset(df, path, mode="append")
    write_dataset(df.limit(1), path, mode="overwrite")
    return pinned


@query("version_read", REGION_SQL)
def version_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "region")
    path = _written(df, "version")
    write_dataset(df, path, mode="append")
    return scan_dataset(spark, path, version=1)


@query("sink_query", "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 250000.5")
def sink_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sink")
    sink_dataset(scan(spark, sf_dir, "orders").filter("o_totalprice > 250000.5").select("o_orderkey", "o_custkey"), path, chunk_size=1000)
    return scan_dataset(spark, path)


@query("scan_to_sink", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey < 700")
def scan_to_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(scan(spark, sf_dir, "orders"), "self")
    sink_dataset(scan_dataset(spark, path).filter("o_custkey < 700").select("o_orderkey", "o_custkey"), path, mode="overwrite")
    return scan_dataset(spark, path)


@query("empty_keeps_schema", "SELECT * FROM orders LIMIT 0")
def empty_keeps_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_dataset(spark, _written(scan(spark, sf_dir, "orders").limit(0), "empty"))


@query("blob_roundtrip", "SELECT doc_id, sha256(encode(text)) AS sha, octet_length(encode(text)) AS n FROM documents")
def blob_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents").select("doc_id", C("text").cast("binary").alias("blob"))
    got = scan_dataset(spark, _written(docs, "blob", blob_columns=["blob"]))
    return got.select("doc_id", F.sha2("blob", 256).alias("sha"), F.octet_length("blob").cast("bigint").alias("n"))


@query("blob_projection", "SELECT doc_id FROM documents WHERE doc_id > 50")
def blob_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents").select("doc_id", C("text").cast("binary").alias("blob"))
    return scan_dataset(spark, _written(docs, "blob", blob_columns=["blob"])).filter("doc_id > 50").select("doc_id")


@query("nested_roundtrip", f"SELECT o_orderkey, st IS NULL AS none, st.x AS x, st.name AS name FROM {ORDERS_SQL}")
def nested_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan_dataset(spark, _written(orders_x(spark, sf_dir).select("o_orderkey", "st"), "nested"))
    return got.select("o_orderkey", C("st").isNull().alias("none"), "st.x", "st.name")


@query("list_roundtrip", f"SELECT p_partkey, lst IS NULL AS none, len(lst) AS n, len(list_filter(lst, lambda e: e IS NULL)) AS nulls FROM {PART_SQL}")
def list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan_dataset(spark, _written(part_x(spark, sf_dir).select("p_partkey", "lst"), "lists"))
    return got.select("p_partkey", C("lst").isNull().alias("none"), P.list_len(C("lst")).alias("n"), F.array_size(F.filter("lst", lambda e: e.isNull())).cast("bigint").alias("nulls"))


@query("struct_filler_2_0", f"SELECT o_orderkey, coalesce(st.x, CASE WHEN st IS NULL THEN 0 END) AS x, coalesce(st.name, '') AS name FROM {ORDERS_SQL}")
def struct_filler(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(orders_x(spark, sf_dir).select("o_orderkey", "st"), "filler", data_storage_version="2.0")
    return scan_dataset(spark, path).select("o_orderkey", "st.x", "st.name")


@query("ordered_scan", "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer")
def ordered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    df = scan(spark, sf_dir, "customer").select("c_custkey").orderBy("c_custkey")
    cut = df.agg(F.max("c_custkey")).first()[0] // 2
    path = _written(df.filter(C("c_custkey") <= cut), "ordered")
    write_dataset(df.filter(C("c_custkey") > cut), path, mode="append")
    rows = scan_dataset(spark, path).withColumns({"file": C("_metadata.file_path"), "row": C("_metadata.row_index")})
    first = rows.groupBy("file").agg(F.count("*").alias("c")).withColumn("before", F.sum("c").over(Window.orderBy("file")) - C("c"))
    return rows.join(F.broadcast(first), "file").select("c_custkey", (C("before") + C("row")).alias("place"))


@query("compaction", f"{REGION_SQL} UNION ALL {REGION_SQL} UNION ALL {REGION_SQL}")
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "region")
    path = _written(df, "compact")
    for _ in range(2):
        write_dataset(df, path, mode="append")
    compact(spark, path)
    return scan_dataset(spark, path)


@query("max_rows_per_file", "SELECT 5 AS files, 10 AS n")
def max_rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark.range(10).coalesce(1), "files", max_rows_per_file=2)
    return scan_dataset(spark, path).withColumn("file", C("_metadata.file_path")).agg(F.count_distinct("file").cast("int").alias("files"), F.count("*").cast("int").alias("n"))


@query("streaming_sink", "SELECT r_regionkey, r_name FROM region")
def streaming_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemoor.streaming.sink import stream_to_dataset

    folder = scratch(spark, "stream")
    scan(spark, sf_dir, "region").write.parquet(f"{folder}/in")
    source = spark.readStream.schema("r_regionkey int, r_name string").parquet(f"{folder}/in")
    stream_to_dataset(source, f"{folder}/out", checkpoint=f"{folder}/checkpoint", query_name="regions", available_now=True).awaitTermination()
    return scan_dataset(spark, f"{folder}/out")


@query("pushdown_report", "SELECT 'IsNotNull(o_custkey), GreaterThan(o_custkey,700)' AS pushed, 'struct<o_orderkey:bigint,o_custkey:bigint>' AS read_schema")
def pushdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = explain_pushdown(scan(spark, sf_dir, "orders").filter("o_custkey > 700").select("o_orderkey"))
    return spark.createDataFrame([(", ".join(r.pushed), r.read_schema) for r in reports], "pushed string, read_schema string")


@query("head_bare", "SELECT 10 AS n, true AS known")
def head_bare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit without an order: which rows is open, how many and that they are the table's is not."""
    got = scan(spark, sf_dir, "orders").select("o_orderkey").limit(10)
    known = got.join(scan(spark, sf_dir, "orders").select("o_orderkey").distinct(), "o_orderkey", "left_semi")
    return got.agg(F.count("*").cast("int").alias("n")).crossJoin(F.broadcast(known.agg((F.count("*") == 10).alias("known"))))


@query("pull_batches", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey < 700")
def pull_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as a caller pulls them: Arrow batches of a given size at most."""
    batches = list(pull(scan(spark, sf_dir, "orders").filter("o_custkey < 700").select("o_orderkey", "o_custkey"), batch_size=500))
    if max(b.num_rows for b in batches) > 500:
        raise AssertionError("a batch is too large")
    return spark.createDataFrame(pa.Table.from_batches(batches))


@query("dotted_and_spaced_names", "SELECT n_nationkey AS \"a key\", n_name AS \"b-c\" FROM nation WHERE n_nationkey > 3")
def dotted_and_spaced_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "nation").select(C("n_nationkey").alias("a key"), C("n_name").alias("b-c"))
    return scan_dataset(spark, _written(df, "names")).filter(C("`a key`") > 3)


@query("path_or_text", f"{REGION_SQL} UNION ALL {REGION_SQL}")
def path_or_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(scan(spark, sf_dir, "region"), "path")
    return scan_dataset(spark, path).unionByName(scan_dataset(spark, path.rstrip("/") + "/"))


@query("max_bytes_per_file", "SELECT true AS several, true AS within, count(*) AS n FROM documents")
def max_bytes_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A soft limit: several files, each of at most twice the limit, and no row lost."""
    df = scan(spark, sf_dir, "documents").select("doc_id", "text").coalesce(1)
    whole = _written(df, "bytes")
    size = scan_dataset(spark, whole).agg(F.max("_metadata.file_size")).first()[0]
    path = _written(df, "bytes", max_bytes_per_file=size // 4)
    files = scan_dataset(spark, path).groupBy(C("_metadata.file_path").alias("file")).agg(F.max("_metadata.file_size").alias("size"), F.count("*").alias("n"))
    return files.agg((F.count("*") > 1).alias("several"), (F.max("size") <= size // 2).alias("within"), F.sum("n").alias("n"))


def _outcome(act: Callable[[], object]) -> str:
    try:
        act()
    except Exception as e:  # noqa: BLE001 (the kind of error is what is asked for)
        return type(e).__name__
    return "none"


def _outcomes(spark: SparkSession, acts: dict[str, Callable[[], object]]) -> DataFrame:
    return spark.createDataFrame([(name, _outcome(act)) for name, act in acts.items()], "case string, raised string")


def _expected(**raised: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in raised.items()) + ') AS t("case", raised)'


@query("errors_of_writes", _expected(exists="FileExistsError", mode="ValueError", version="ValueError", blob_version="ValueError", blob_name="ValueError", blob_type="ValueError", name="ValueError", limit="ValueError", chunk="ValueError", schema="ValueError", option="ValueError", stale="CommitConflictError", ignored_version="none"))
def errors_of_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "region")
    path = _written(df, "errors")
    new = lambda **how: write_dataset(df, scratch(spark, "errors"), **how)
    return _outcomes(
        spark,
        {
            "exists": lambda: write_dataset(df, path),
            "mode": lambda: new(mode="ignore"),
            "version": lambda: new(data_storage_version="9.9"),
            "blob_version": lambda: new(data_storage_version="2.1", blob_columns=["r_name"]),
            "blob_name": lambda: new(blob_columns=["nope"]),
            "blob_type": lambda: new(blob_columns=["r_name"]),
            "name": lambda: write_dataset(df.withColumnRenamed("r_name", "r.name"), scratch(spark, "errors")),
            "limit": lambda: new(max_rows_per_file=0),
            "chunk": lambda: sink_dataset(df, scratch(spark, "errors"), chunk_size=0),
            "schema": lambda: write_dataset(df.select("r_name"), path, mode="append"),
            "option": lambda: new(storage_options={"nope": "1"}),
            "stale": lambda: write_dataset(df, path, mode="overwrite", expected_version=7),
            "ignored_version": lambda: write_dataset(df, path, mode="append", data_storage_version="2.0"),
        },
    )


@query("errors_of_scans", _expected(missing="FileNotFoundError", version="FileNotFoundError", corrupt="EngineError", failing_query="EngineError", nothing_committed="FileNotFoundError", host="AnalysisException"))
def errors_of_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "region")
    path, corrupt, failed = _written(df, "errors"), _written(df, "errors"), scratch(spark, "errors")
    store = Store(spark, corrupt)
    store._write(store.fs.create(store.path("_manifests", "2.json"), False), bytearray(b"{"))
    broken = df.select(F.udf(lambda v: 1 // 0, "long")("r_regionkey").alias("r"))
    return _outcomes(
        spark,
        {
            "missing": lambda: scan_dataset(spark, scratch(spark, "errors")),
            "version": lambda: scan_dataset(spark, path, version=5),
            "corrupt": lambda: scan_dataset(spark, corrupt),
            "failing_query": lambda: sink_dataset(broken, failed),
            "nothing_committed": lambda: scan_dataset(spark, failed),
            "host": lambda: scan_dataset(spark, path).select("nope"),
        },
    )


@query("commit_conflict", "SELECT 1 AS won, 3 AS lost, 2 AS versions")
def commit_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four writers that all build on version 1: one commits."""
    path = _written(scan(spark, sf_dir, "region"), "conflict")
    store = Store(spark, path)
    old = store.load()
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: _outcome(lambda: store.commit(Manifest(2, old.storage_version, old.schema, old.files, "append"))), range(4)))
    return spark.createDataFrame([(got.count("none"), got.count("CommitConflictError"), len(store.versions()))], "won int, lost int, versions int")


@query("planning_reads_nothing", "SELECT 'id' AS names, 1 AS scans")
def planning_reads_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and pushdown of a scan whose data files are gone by then."""
    path = _written(scan(spark, sf_dir, "region").select(C("r_regionkey").alias("id")), "planning")
    df = scan_dataset(spark, path).filter("id > 1")
    Store(spark, path).remove("data")
    return spark.createDataFrame([(",".join(df.columns), len(explain_pushdown(df)))], "names string, scans int")


@query("storage_versions", "SELECT * FROM (VALUES ('2.0', '2.0'), ('2.1', '2.1'), ('2.2', '2.2'), ('2.3', '2.3'), ('default', '2.2'), ('stable', '2.1')) AS t(asked, stored)")
def storage_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(spark, sf_dir, "region")
    asked = ["2.0", "2.1", "2.2", "2.3", "default", "stable"]
    stored = [Store(spark, _written(df, "versions", data_storage_version=None if v == "default" else v)).load().storage_version for v in asked]
    return spark.createDataFrame(list(zip(asked, stored, strict=True)), "asked string, stored string")


@query("storage_options", "SELECT * FROM (VALUES ('az://c/d', 'abfss://c/d'), ('gs://b/d', 'gs://b/d'), ('s3://b/d', 's3a://b/d')) AS t(uri, read)")
def storage_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(u, resolve_uri(u)) for u in ("az://c/d", "gs://b/d", "s3://b/d")], "uri string, read string")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, filter and project, with the conditions in the Parquet scan."""
    return scan(spark, sf_dir, "orders").filter((C("o_custkey") > 70) & (C("o_totalprice") < 100000)).select("o_orderkey", "o_custkey", "o_totalprice")
