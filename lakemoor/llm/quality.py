"""Quality by ordinal cumulative-link regression.

Ratings are ordered grades 0..K-1 (K is what the ratings hold; with two grades the model is the
logistic one). All grades share one weight vector w over hashed features of the whole text; ordered
thresholds theta give P(grade <= k) = sigmoid(theta_k - w.x), from these the expected grade and the
tail probability P(grade >= cut), by which rows are selected.

Features, hashed into ``WIDTH`` places: words, and four-byte windows of character classes (upper,
lower, digit, white space, line end, each punctuation mark, the rest), each as the square root of
its share, so a text's length does not count. The fit sees at most ``SAMPLE`` rated rows, those
with the smallest id hash.

Defined cases: a null text counts as empty (no features: the thresholds alone decide); without
ratings, or with one grade only, expected_grade is 0 and every row is selected; null ratings and
ratings of null ids are ignored; of repeated ratings the larger holds; other columns are ignored
(score) or kept (filter).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemoor.llm import textkernel as K
from lakemoor.llm.linear import cumulative_link, sigmoid
from lakemoor.llm.shared import map_arrow
from lakemoor.llm.toxicity import _sample, filter_rows, held_out

SAMPLE, WIDTH = 8_000, 2048
_U = np.uint64


def _classes() -> np.ndarray:
    out = np.full(256, 5, dtype=np.uint64)
    for b in range(128):
        c = chr(b)
        out[b] = 1 if c.isupper() else 2 if c.islower() else 3 if c.isdigit() else 4 if c == "\n" else 0 if c.isspace() else b
    return out


CLASS = _classes()


def hashed(column: pa.Array, width: int = WIDTH) -> np.ndarray:
    """The feature rows (float32) of a column of texts."""
    buf, offs = K.column_bytes(column)
    n = len(column)
    half = width // 2
    out = np.zeros((n, width), dtype=np.float32)
    h, _, _, first = K.words(buf, offs)
    for row in range(n):
        at = (h[first[row] : first[row + 1]] >> _U(40)).astype(np.int64) % half
        if len(at):
            out[row, :half] = np.bincount(at, minlength=half) / len(at)
        c = CLASS[buf[offs[row] : offs[row + 1]]]
        if len(c) >= 4:
            grams = ((c[:-3] * _U(131) + c[1:-2]) * _U(131) + c[2:-1]) * _U(131) + c[3:]
            at = ((grams * _U(0x9E3779B97F4A7C15)) >> _U(40)).astype(np.int64) % half
            out[row, half:] = np.bincount(at, minlength=half) / len(at)
    return np.sqrt(out)


class QualityModel:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray) -> None:
        self.weights, self.thresholds = weights.astype(np.float32), thresholds

    def above(self, column: pa.Array) -> np.ndarray:
        """P(grade > k) for each row and k."""
        if not len(self.thresholds):
            return np.zeros((len(column), 0))
        return sigmoid((hashed(column, len(self.weights)) @ self.weights)[:, None].astype(np.float64) - self.thresholds[None, :])


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", rating: str = "quality", sample_rows: int = SAMPLE, hold: bool = True, width: int = WIDTH) -> QualityModel:
    sample = _sample(docs, ratings, rating, id_col, text_col, sample_rows, hold)

    def sparse(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                x = hashed(part.column("text"), width)
                rows, cols = np.nonzero(x)
                ends = pa.array(np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(cols.astype(np.int16))), pa.ListArray.from_arrays(ends, pa.array(x[rows, cols])), part.column("label")], names=["cols", "vals", "label"])

    got = map_arrow(sample.select("text", F.col("label").cast("int").alias("label")), sparse, "cols array<short>, vals array<float>, label int").toArrow()
    grades, y = np.unique(got.column("label").to_numpy(), return_inverse=True)
    if len(grades) < 2:
        return QualityModel(np.zeros(width), np.zeros(0))
    x = np.zeros((len(y), width), dtype=np.float32)
    at = 0
    for batch in got.to_batches():
        cols, vals = batch.column("cols"), batch.column("vals")
        x[at + np.repeat(np.arange(len(cols)), np.diff(cols.offsets.to_numpy())), cols.flatten().to_numpy()] = vals.flatten().to_numpy()
        at += len(cols)
    weights, thresholds = cumulative_link(x, y, len(grades), 1e-5)
    return QualityModel(weights, thresholds)


def score(docs: DataFrame, model: QualityModel, cut: int = 1, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, expected_grade, tail_prob (of a grade of at least ``cut``) and selected (tail_prob >= ``least``)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                p = model.above(part.column("text"))
                tail = p[:, min(cut, p.shape[1]) - 1] if p.shape[1] else np.ones(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(p.sum(axis=1)), pa.array(tail), pa.array(tail >= least)], names=["id", "expected_grade", "tail_prob", "selected"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_arrow(rows, run, "id long, expected_grade double, tail_prob double, selected boolean").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, ratings: DataFrame, cut: int = 1, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The selected rows with all their columns."""
    model = fit(docs, ratings, id_col, text_col, **how)

    def keep(column: pa.Array) -> np.ndarray:
        p = model.above(column)
        return p[:, min(cut, p.shape[1]) - 1] >= least if p.shape[1] else np.ones(len(column), dtype=bool)

    return filter_rows(docs, text_col, keep)


__all__ = ["QualityModel", "fit", "held_out", "keep_good", "score"]
