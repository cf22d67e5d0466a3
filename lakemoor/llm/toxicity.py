"""Toxicity by weak supervision.

1. Voters. Lexicon voters are words and word beginnings (4 and 5 bytes) that labelled training rows
   set apart (counted distributedly over the sample), and a fixed word list for each language;
   pattern voters look at how a text is written. A voter votes "toxic" or stays silent.
2. The label model is generative: given the hidden label, voter j votes with a probability of its
   own. Expectation-maximisation estimates these, that is the voters' accuracies; the given label
   takes part as one more voter, whose errors both ways are estimated like the others' (from
   ``TRUST``, with a prior of some rows). Correlations are estimated anew in every round from what
   voters have in common beyond the present posterior: a voter's evidence is divided by one plus
   the sum of its correlations, so near-copies of a voter do not count twice.
3. A logistic classifier is trained on the posterior labels, over the presence of the selected
   words and beginnings and the patterns. It alone scores texts, whole, in one pass without shuffle.

The classifier sees a bounded sample, ``SAMPLE`` labelled rows with the smallest id hash. Rows with
crc32(id) mod 5 = 0 are held out: their labels are never read.

Defined cases: a null or empty text gets the score of a text without any feature; without labelled
rows every score is 0 (nothing is called toxic); null labels and labels of null ids are ignored; of
repeated labels the larger holds; repeated rows get equal scores; other columns are ignored (score)
or kept (filter).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemoor.llm import textkernel as K
from lakemoor.llm.linear import logistic, sigmoid
from lakemoor.llm.shared import map_arrow

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 12_000
#: Selected features, and those of them that vote in the label model, at most.
FEATURES, VOTERS = 1024, 120
#: Insulting and abusive words, a list for each language.
LEXICON = {
    "en": "idiot idiots stupid moron morons loser losers clown trash garbage disgusting pathetic scum filthy worthless dumb imbecile jerk freak retard bastard bitch asshole crap damn shut hate kill",
    "de": "idiot idioten dumm dummkopf trottel arschloch scheiße abschaum widerlich erbärmlich versager schwachkopf drecksau hurensohn mistkerl hasse",
    "fr": "idiot idiote imbécile crétin connard connasse salaud ordure pathétique dégoûtant abruti merde minable raclure débile haine",
    "es": "idiota estúpido imbécil tonto basura asqueroso patético escoria inútil cabrón mierda gilipollas payaso desgraciado odio",
}
PATTERNS = 10
#: The given label's accuracy to start from, and the rows that this prior weighs.
TRUST, PRIOR_ROWS = 0.9, 20


def held_out(id_col: str):
    """Whether crc32(id as text) mod 5 is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lexicon_hashes(text: str) -> np.ndarray:
    h, _, _, _ = K.words(*K.column_bytes(pa.array([text.encode()], pa.binary())))
    return np.unique(h)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and beginnings with their rows (not distinct), and the pattern votes of each row."""
    buf, offs = K.column_bytes(column)
    h, s, e, first = K.words(buf, offs)
    rows = np.repeat(np.arange(len(column)), np.diff(first))
    parts, at = [h], [rows]
    for n in (4, 5):
        long = e - s > n
        begin = np.zeros(int(long.sum()), dtype=np.uint64)
        for j in range(n):
            begin = begin * np.uint64(257) + K.LOWER[buf[s[long] + j]]
        parts.append(K.mix(begin + np.uint64(n << 56)))
        at.append(rows[long])
    size = np.maximum(np.diff(offs), 1)
    per = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offs]) / size
    upper, bang = per((buf >= 65) & (buf <= 90)), per(buf == 33)
    marks, digits, question, high = per((buf == 36) | (buf == 42) | (buf == 35)), per((buf >= 48) & (buf <= 57)), per(buf == 63), per(buf >= 128)
    again = np.zeros(len(buf), dtype=bool)
    again[2:] = (buf[2:] == buf[1:-1]) & (buf[1:-1] == buf[:-2]) & (buf[2:] > 32)  # three alike in a row, within a text or across two
    words, some = np.diff(first), np.diff(offs) > 0
    short, mean = (words < 30) & some, np.bincount(rows, weights=e - s, minlength=len(column)) / np.maximum(words, 1)
    votes = np.stack([upper > 0.4, bang > 0.01, marks > 0.02, short, (upper > 0.15) & (upper <= 0.4), (bang > 0) & (bang <= 0.01), question > 0.01, per(again) > 0.01, (digits > 0.2) | (high > 0.5), (mean > 0) & (mean < 3.2)], axis=1)
    return np.concatenate(parts), np.concatenate(at), votes


def _sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, rows: int, hold: bool) -> DataFrame:
    """(id, text, label) of at most ``rows`` labelled ids, one row each (of repeated ids the least text); the label side of the join is bounded by ``rows``."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    if hold:
        known = known.filter(~held_out(id_col))
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).join(F.broadcast(known), "id")
    return found.groupBy("id", "label").agg(F.min("text").alias("text"))


def select_features(sample: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The features that tell the labels apart best, by hash in order, with their z-scores."""

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                f, r, _ = features(part.column("text"))
                f, r, _ = K.counted(f, r)
                y = part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
                names, where = np.unique(f, return_inverse=True)
                ones = np.bincount(where, weights=y[r], minlength=len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(ones), pa.array(np.bincount(where, minlength=len(names)) - ones)], names=["f", "n1", "n0"])

    totals = sample.groupBy("label").count().collect()
    t1 = sum(r["count"] for r in totals if r["label"] == 1)
    t0 = sum(r["count"] for r in totals if r["label"] != 1)
    if not t1 or not t0:
        return np.zeros(0, np.uint64), np.zeros(0)
    counts = map_arrow(sample.select("text", F.col("label").cast("int").alias("label")), count, "f long, n1 long, n0 long").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    p1, p0, p = F.col("n1") / t1, F.col("n0") / t0, (F.col("n1") + F.col("n0")) / (t1 + t0)
    z = (p1 - p0) / F.sqrt(p * (1 - p) * (1 / t1 + 1 / t0) + 1e-12)
    best = counts.filter(F.col("n1") + F.col("n0") >= 2).select("f", z.alias("z")).orderBy(F.desc("z"), "f").limit(most).collect()
    f = np.array([r["f"] for r in best], dtype=np.int64).view(np.uint64)
    order = np.argsort(f)
    return f[order], np.array([r["z"] for r in best])[order]


def hits(column: pa.Array, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, place in chosen) pairs, and the pattern votes."""
    f, r, votes = features(column)
    at = np.searchsorted(chosen, f)
    found = np.zeros(len(f), dtype=bool)
    if len(chosen):
        at = np.minimum(at, len(chosen) - 1)
        found = chosen[at] == f
    pairs = np.unique(r[found] * max(len(chosen), 1) + at[found])
    return pairs // max(len(chosen), 1), pairs % max(len(chosen), 1), votes


class LabelModel:
    """Voters that are independent given the label, but for estimated correlations.

    votes: (rows, voters) booleans; labels: 0 or 1, the votes of one more voter, ``given`` (how often
    it says 1 where that is so, and where not).
    """

    def __init__(self, votes: np.ndarray, labels: np.ndarray, trust: float = TRUST, rounds: int = 50, tolerance: float = 1e-4) -> None:
        v, n = votes.astype(np.float64), max(len(votes), 1)
        said = labels == 1
        self.given = (trust, 1 - trust)
        post = np.where(said, *self.given)
        for _ in range(rounds):
            total = post.sum()
            self.prior = np.clip(total / n, 1e-3, 1 - 1e-3)
            self.on = np.clip((post @ v + 0.5) / (total + 1), 1e-4, 1 - 1e-4)
            self.off = np.clip(((1 - post) @ v + 0.5) / (n - total + 1), 1e-4, 1 - 1e-4)
            self.given = ((post[said].sum() + PRIOR_ROWS * trust) / (total + PRIOR_ROWS), ((1 - post)[said].sum() + PRIOR_ROWS * (1 - trust)) / (n - total + PRIOR_ROWS))
            mean = np.outer(post, self.on) + np.outer(1 - post, self.off)
            rest = (v - mean) / np.sqrt(np.maximum(mean * (1 - mean), 1e-6))
            self.correlation = np.clip(rest.T @ rest / n, 0, 1)
            np.fill_diagonal(self.correlation, 0)
            discount = 1 / (1 + np.where(self.correlation > 0.1, self.correlation, 0).sum(axis=1))
            self.evidence = discount * np.log(self.on * (1 - self.off) / (self.off * (1 - self.on)))
            silent = discount * np.log((1 - self.on) / (1 - self.off))
            self.offset = np.log(self.prior / (1 - self.prior)) + silent.sum()
            one, zero = np.clip(self.given, 1e-3, 1 - 1e-3)
            new = sigmoid(v @ self.evidence + self.offset + np.where(said, np.log(one / zero), np.log((1 - one) / (1 - zero))))
            moved = np.abs(new - post).max(initial=0.0)
            post = new
            if moved < tolerance:
                break
        self.posterior = post


class ToxicityModel:
    """What scoring needs: selected features by hash, their weights, the patterns' and lexicons' weights, the intercept."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray, extra: np.ndarray, intercept: float) -> None:
        self.chosen, self.weights, self.extra, self.intercept = chosen, weights, extra, intercept
        lists = [lexicon_hashes(t) for t in LEXICON.values()]
        self.lexicon = np.unique(np.concatenate(lists))
        self.listed = np.stack([np.isin(self.lexicon, x) for x in lists], axis=1)  # (word, list)

    def design(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, at, votes = hits(column, self.chosen)
        lex_rows, words, _ = hits(column, self.lexicon)
        listed = np.zeros((len(column), self.listed.shape[1]), dtype=bool)
        np.logical_or.at(listed, lex_rows, self.listed[words])
        return rows, at, np.column_stack([votes, listed]).astype(np.float64)

    def score(self, column: pa.Array) -> np.ndarray:
        rows, at, extra = self.design(column)
        z = np.bincount(rows, weights=self.weights[at], minlength=len(column)) if len(rows) else np.zeros(len(column))
        return sigmoid(z + extra @ self.extra + self.intercept)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", sample_rows: int = SAMPLE, hold: bool = True) -> ToxicityModel:
    sample = _sample(docs, labels, label, id_col, text_col, sample_rows, hold)
    chosen, z = select_features(sample, FEATURES)
    model = ToxicityModel(chosen, np.zeros(len(chosen)), np.zeros(PATTERNS + len(LEXICON)), -35.0)
    if not len(chosen):
        return model

    def sparse(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                rows, cols, extra = model.design(part.column("text"))
                ends = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(cols.astype(np.int32))), pa.array(extra.tolist(), pa.list_(pa.float64())), part.column("label")], names=["cols", "extra", "label"])

    got = map_arrow(sample.select("text", F.col("label").cast("int").alias("label")), sparse, "cols array<int>, extra array<double>, label int").toArrow()
    y = got.column("label").to_numpy()
    lists = got.column("cols").combine_chunks()
    x = np.zeros((len(y), len(chosen)), dtype=np.float32)
    lengths = np.diff(lists.offsets.to_numpy())
    x[np.repeat(np.arange(len(y)), lengths), lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]] = 1
    extra = np.array(got.column("extra").to_pylist(), dtype=np.float32).reshape(len(y), PATTERNS + len(LEXICON))
    voters = np.argsort(-z, kind="stable")[:VOTERS]
    posterior = LabelModel(np.column_stack([x[:, voters], extra]) > 0, y).posterior
    keep = x.sum(axis=0) > 0
    full = np.column_stack([x[:, keep], extra])
    p = logistic(full, posterior.astype(np.float32), 2e-4)
    model.weights[keep] = p[: int(keep.sum())]
    model.extra, model.intercept = p[int(keep.sum()) : -1], float(p[-1])
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1) and predicted (1 from 0.5 on)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                s = model.score(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_arrow(rows, run, "id long, score double, predicted int").withColumnRenamed("id", id_col)


def filter_rows(df: DataFrame, text_col: str, keep) -> DataFrame:
    """The rows of ``df`` for whose texts ``keep`` (binary column -> booleans) holds, with all their columns."""
    kind = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                yield pa.RecordBatch.from_arrays([part.column("row")], names=["row"]).filter(pa.array(keep(part.column("text"))))

    rows = df.select(F.col(text_col).cast("binary").alias("text"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("row"))
    out = map_arrow(rows, run, T.StructType([T.StructField("row", kind)]))
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(df.columns)])


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    model = fit(docs, labels, id_col, text_col, **how)
    return filter_rows(docs, text_col, lambda column: model.score(column) < 0.5)
