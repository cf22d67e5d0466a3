import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_data import EXTRA, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = prose(1, 40000)
    base = prose(2, 120)
    rows = [
        (1, None), (2, ""), (3, " "), (4, "\t\n "), (5, "a b"), (6, "a  b"), (7, "a b"), (8, base), (8, base), (9, base + "\n"), (10, base.replace(" ", "\n")),
        (None, "a b"), (None, None), (None, "only null id"), (None, "only null id"), (11, long), (12, long), (13, long + " tail"), (14, "MIT"), (15, "!!!"), (16, "???"), (17, "!!!"),
        (18, "é" * 3000), (19, "x" * 5000), (20, "<|endoftext|> a <|endoftext|>"), (21, "under the MIT license, CC-BY-NC"), (22, "one two three"), (23, "One, two; three!"), (24, "\x00 \x1c\x85 z"),
    ]
    rows += [(100 + i, base) for i in range(40)]
    return rows


@pytest.fixture
def frame(spark):
    def make(rows, extra=True, parts=5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        if extra:
            from pyspark.sql import functions as F

            for field in EXTRA.split(", "):
                name, kind = field.split(" ")
                df = df.withColumn(name, F.lit("7").cast(kind))
        return df

    return make
