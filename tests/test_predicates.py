"""Conditions against DuckDB, over rows in memory and over a written dataset.

The rows stand for a warehouse: every column takes its special values at places of its own, so that
nulls, NaN, empty and odd texts meet in many combinations.
"""

import datetime as dt
import math

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemoor import scan_dataset, write_dataset
from lakemoor.functions import predicates as P
from lakemoor.types import from_arrow

ROWS = 24


def spread(regular, special):
    """regular(i) for each row, but for the places that ``special`` names."""
    return [special[i] if i in special else regular(i) for i in range(ROWS)]


def pallet(i):
    return {"row": i // 3, "shelf": "ABCDE"[i % 5]}


TABLE = pa.table(
    {
        "sku": pa.array(range(100, 100 + ROWS), pa.int32()),
        "stock": pa.array(spread(lambda i: (i * i) % 37 - 6, {4: None, 13: None, 20: 2**62}), pa.int64()),
        "weight": pa.array(spread(lambda i: 12.25 - 1.75 * i, {2: math.nan, 5: None, 9: math.inf, 11: -math.inf, 16: -0.0, 17: 0.0, 22: math.nan}), pa.float64(), from_pandas=False),
        "fragile": pa.array(spread(lambda i: i % 3 == 1, {6: None, 19: None})),
        "label": pa.array(spread(lambda i: f"bin-{i * 17 % 50:02d}", {1: "", 3: None, 7: "Köln", 8: "50% off", 10: "BIN-34", 12: "two\nlines", 14: "tab\there", 15: "q'uote", 18: None, 21: "x_y"})),
        "arrived": pa.array(spread(lambda i: dt.date(2019, 12, 20) + dt.timedelta(days=3 * i), {0: None, 23: dt.date(1969, 7, 20)})),
        "seen": pa.array(spread(lambda i: dt.datetime(2020, 2, 28, 23, 59, 50) + dt.timedelta(seconds=i, microseconds=i), {9: None, 10: dt.datetime(2500, 1, 1, 0, 0, 0, 1)}), pa.timestamp("us")),
        "pallet": pa.array(spread(pallet, {2: None, 8: {"row": None, "shelf": "B"}, 9: {"row": 1, "shelf": None}, 15: None}), pa.struct([("row", pa.int32()), ("shelf", pa.string())])),
        "counts": pa.array(spread(lambda i: list(range(i % 4)), {3: None, 6: [None], 10: [30, None, 31], 14: []}), pa.list_(pa.int32())),
    }
)
C = F.col
NAN = float("nan")
CASES = {
    # comparisons and logic
    "stock >= 20": lambda: C("stock") >= 20,
    "stock <> 3": lambda: C("stock") != 3,
    "stock = 4611686018427387904": lambda: C("stock") == 2**62,
    "weight < -7.0": lambda: C("weight") < -7.0,
    "weight = 0.0": lambda: C("weight") == 0.0,
    "weight > 'inf'::DOUBLE": lambda: C("weight") > math.inf,
    "weight <= '-inf'::DOUBLE": lambda: C("weight") <= -math.inf,
    "weight <> 'nan'::DOUBLE": lambda: C("weight") != NAN,
    "weight BETWEEN 9.0 AND 'nan'::DOUBLE": lambda: P.is_between(C("weight"), 9.0, NAN),
    "fragile": lambda: C("fragile"),
    "fragile = false OR stock < 0": lambda: (C("fragile") == F.lit(False)) | (C("stock") < 0),
    "NOT (fragile AND stock > 10)": lambda: ~(C("fragile") & (C("stock") > 10)),
    "NOT (stock BETWEEN 0 AND 9 OR weight > 1.5)": lambda: ~(P.is_between(C("stock"), 0, 9) | (C("weight") > 1.5)),
    "stock > sku": lambda: C("stock") > C("sku"),
    "stock + 90 > sku": lambda: (C("stock") % 1000) + 90 > C("sku") - 0 * C("stock"),
    # nulls
    "pallet IS NULL AND counts IS NOT NULL": lambda: C("pallet").isNull() & C("counts").isNotNull(),
    "NOT (label IS NULL OR arrived IS NULL)": lambda: ~(C("label").isNull() | C("arrived").isNull()),
    "stock IS DISTINCT FROM 30": lambda: P.ne_missing(C("stock"), F.lit(30)),
    "label IS NOT DISTINCT FROM NULL": lambda: P.eq_missing(C("label"), F.lit(None)),
    # membership and ranges
    "stock IN (-6, -5, 3, 30)": lambda: P.is_in(C("stock"), [-6, -5, 3, 30]),
    "label NOT IN ('', 'Köln')": lambda: ~P.is_in(C("label"), ["", "Köln"]),
    "coalesce(label IN ('x_y'), true)": lambda: P.is_in(C("label"), [None, "x_y"], nulls_equal=True),
    "NOT coalesce(stock IN (10, 19), false)": lambda: ~P.is_in(C("stock"), [10, 19], nulls_equal=True),
    "sku > 103 AND sku <= 109": lambda: P.is_between(C("sku"), 103, 109, "right"),
    "arrived >= date '2020-01-01' AND arrived < date '2020-02-01'": lambda: P.is_between(C("arrived"), dt.date(2020, 1, 1), dt.date(2020, 2, 1), "left"),
    "seen > timestamp '2020-02-29 00:00:00' OR seen IS NULL": lambda: (C("seen") > F.lit(dt.datetime(2020, 2, 29)).cast("timestamp_ntz")) | C("seen").isNull(),
    "seen = timestamp '2500-01-01 00:00:00.000001'": lambda: C("seen") == F.expr("timestamp_ntz'2500-01-01 00:00:00.000001'"),
    # numbers
    "isfinite(weight)": lambda: P.is_finite(C("weight")),
    "NOT isfinite(weight)": lambda: ~P.is_finite(C("weight")),
    "isfinite(weight) IS NULL": lambda: P.is_finite(C("weight")).isNull(),
    # texts
    "label > 'bin-4'": lambda: C("label") > "bin-4",
    "label = 'q''uote'": lambda: C("label") == "q'uote",
    "contains(label, '%')": lambda: P.contains_regex(C("label"), "%", literal=True),
    "NOT contains(label, 'n-')": lambda: ~P.contains_regex(C("label"), "n-", literal=True),
    "starts_with(lower(label), 'bin')": lambda: P.starts_with(P.to_lowercase(C("label")), "bin"),
    "ends_with(upper(label), 'E')": lambda: P.ends_with(P.to_uppercase(C("label")), "E"),
    "length(label) < 5": lambda: P.len_chars(C("label")) < 5,
    # structs and lists
    "pallet.shelf = 'B'": lambda: P.field(C("pallet"), "shelf") == "B",
    "pallet.row IS NULL": lambda: P.field(C("pallet"), "row").isNull(),
    "NOT (pallet.row > 3)": lambda: ~(P.field(C("pallet"), "row") > 3),
    "length(pallet.shelf) = 1 AND pallet.row = 1": lambda: (P.len_chars(P.field(C("pallet"), "shelf")) == 1) & (P.field(C("pallet"), "row") == 1),
    "len(counts) = 3": lambda: P.list_len(C("counts")) == 3,
    "list_contains(counts, 2)": lambda: P.list_contains(C("counts"), 2),
    "NOT list_contains(counts, 0)": lambda: ~P.list_contains(C("counts"), 0),
}
#: Expressions that DuckDB's linear-time engine reads like ours, on ASCII.
PATTERNS = [
    "n-[0-4]", "^$", "^.{4}$", "(?i)^bin", "e$", r"\d\d$", r"^two\nlines$", "^two.lines$", "(?s)^two.lines$", "(?m)^lines$", "(?m)two$", "(?:(?m)two$)", "[[:digit:]]+$", "^[[:alpha:]]+-", "^[^[:upper:]]*$", "[[:space:]]", "[[:punct:]]",
    r"^\w+-\w+$", "[]'_]", "[^a-z0-9-]", r"\x{25}", r"(?P<kind>bin)-(?:1|2)", "(a|b|q)+?", r"\Ax", r"e\z", "x{0,2}_", r"[\d%]", r"\bo", r"\S\s\S", "[[:^digit:]][[:digit:]]", r"\pL\p{Nd}?$",
]


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    df = from_arrow(spark, TABLE)
    path = tmp_path_factory.mktemp("warehouse") / "d"
    write_dataset(df, path, max_rows_per_file=7)
    return df, scan_dataset(spark, path)


def skus(sql):
    warehouse = TABLE  # noqa: F841 (read by DuckDB)
    return sorted(r[0] for r in duckdb.sql(f"SELECT sku FROM warehouse WHERE {sql}").fetchall())


@pytest.mark.parametrize("sql", CASES)
def test_conditions(frames, sql):
    want = skus(sql if sql != "stock + 90 > sku" else "stock % 1000 + 90 > sku")
    for df in frames:
        assert sorted(r.sku for r in df.filter(CASES[sql]()).collect()) == want


@pytest.mark.parametrize("pattern", PATTERNS)
def test_expressions(frames, pattern):
    quoted = pattern.replace("'", "''")
    want = skus(f"regexp_matches(label, '{quoted}')")
    assert want or pattern in ("^two.lines$",)
    for df in frames:
        assert sorted(r.sku for r in df.filter(P.contains_regex(C("label"), pattern)).collect()) == want


@pytest.mark.parametrize(
    ("pattern", "hits", "misses"),
    [
        ("g$", ["ing"], ["ing\n", "gi"]),
        (r"^\w\w$", ["éß", "a_"], ["é", "a-"]),
        ("^a.b$", ["a\rb", "a\x85b"], ["a\nb"]),
        (r"^\d$", ["٣", "5"], ["x"]),
        ("^[[:digit:]]$", ["5"], ["٣", ":", "d"]),
        (r"^[\w--\d]+$", ["ab_"], ["ab1"]),
        ("^[a-z--[aeiou]--y]+$", ["bcd"], ["bad", "bay"]),
        ("^[a-m&&[^c]]+$", ["abd"], ["abc", "xyz"]),
        ("^[^a-z--c]+$", ["c", "C1"], ["a", "cb"]),
        ("(?:(?m)x$)|^q", ["x\nb", "qx1"], ["ax1", "b\nq"]),
        ("(?m)^$", ["a\n", ""], ["a"]),
        ("(?i)straße(?-i)X", ["STRAßEX"], ["STRAßEx"]),
        (r"^\v$", ["\x0b"], ["\n", "v"]),
        (r"\p{Greek}\P{L}", ["α1"], ["αβ", "a1"]),
        (r"\u{1F600}|\x41", ["😀", "A"], ["B"]),
        ("a{,2}", ["a{,2}"], ["aa"]),
    ],
)
def test_dialect(spark, pattern, hits, misses):
    df = spark.createDataFrame([(t,) for t in hits + misses], "t string")
    assert sorted(r.t for r in df.filter(P.contains_regex(C("t"), pattern)).collect()) == sorted(hits)


@pytest.mark.parametrize("pattern", ["x(?!y)", "(?<=x)y", r"(x)y\1", r"(?P<n>x)\k<n>", "(?>x)", "x++", "x*{2}", "(?x)x", "(?U)x", "(?R)x", "(?-u)x", "[x~~y]", "[[:nope:]]", r"\p{Nope}", r"\Qx\E", r"\h", r"x\Z", "(x", "x)", "[x", "x\\", "[x--]"])
def test_refused(pattern):
    with pytest.raises(ValueError, match="not supported"):
        P.java_pattern(pattern)


def test_wrong_bounds():
    with pytest.raises(ValueError, match="closed"):
        P.is_between(C("x"), 1, 2, "open")


def test_zoned_literals(spark):
    at = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=5)))
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 1, 7, tzinfo=dt.timezone.utc)), (2, dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc))], "i int, t timestamp")
    assert [r.i for r in df.filter(C("t") == F.lit(at)).collect()] == [1]
