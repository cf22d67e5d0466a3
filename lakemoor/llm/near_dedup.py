"""Near-duplicate classes by ProbMinHash, banding and verification.

Two texts are linked if the probability Jaccard similarity of their five-word shingles, weighted
by count, is at least 0.8; a class is a connected component of the links. (Where every shingle
counts once this is the plain Jaccard similarity of the shingle sets.)

1. Texts with the same words in the same order share a 128-bit fingerprint and are one node: a
   group of copies, however large, goes on as one row (grouped with partial aggregation).
2. ProbMinHash: each shingle is a Poisson process whose rate is its weight; arrivals fall into one
   of 100 registers, and the first arrival in a register names its shingle. A shingle whose arrival
   is later than every register's ends there. Two nodes agree in a register with the probability
   Jaccard similarity as probability.
3. 20 bands of 5 registers. In each bucket every node is tied to the most central one, that with
   the most company over all its buckets (of near copies of one text, the text itself); the pairs,
   distinct over bands, are verified exactly on whole texts. At similarity 0.8 a pair shares some
   bucket with probability 0.9997.
4. Links become components. In a bucket that still holds several components every node outside the
   largest one is compared with all nodes of the other components. So a group of near copies costs
   one pair a member, and every pair that shares a bucket is either compared or in one component
   already: no link within a bucket stays unseen, as no estimate rules a pair out, only bounds do.

Defined cases: null text counts as empty; texts of one to four words have one shingle of all of
them; texts without words are linked only if their bytes are equal; a null doc_id is larger than
any other (class_id is null only if all ids of the class are); repeated rows are copies of each
other; an empty table gives an empty result; other columns are ignored (classes) or kept (filter).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemoor.llm import textkernel as K
from lakemoor.llm.components import components
from lakemoor.llm.shared import discard, map_arrow, materialise

SHINGLE, BANDS, ROWS, LEAST = 5, 20, 5, 0.8
#: Members of a bucket that meet in one task, at most about twice as many.
CHUNK = 500


def prob_minhash(elements: np.ndarray, weights: np.ndarray, rows: np.ndarray, n: int, m: int) -> np.ndarray:
    """The signatures, (n, m), of n weighted sets; a register without arrival stays 0 (empty sets only)."""
    first = np.full(n * m, np.inf)
    names = np.zeros(n * m, dtype=np.uint64)
    e, w, d = elements, weights.astype(np.float64), rows.astype(np.int64)
    t = np.zeros(len(e))
    step = 0
    while len(e):
        u = K.mix(e + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        t = t - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
        at = d * m + ((K.mix(u ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(first, at, t)
        won = first[at] == t
        names[at[won]] = e[won]
        on = t < first.reshape(n, m).max(axis=1)[d]
        e, w, d, t = e[on], w[on], d[on], t[on]
        step += 1
    return names.reshape(n, m)


def fingerprints(buf: np.ndarray, offs: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """128 bits of each row's words in order; of its bytes if it has no word."""
    out = []
    for i in range(len(offs) - 1):
        a, b = first[i], first[i + 1]
        out.append(hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else hashlib.blake2b(buf[offs[i] : offs[i + 1]].tobytes(), digest_size=16, person=b"no words").digest())
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands): a hash of the registers of each band and of its number."""
    return K.mix((sig.reshape(-1, bands, rows) * K.streams(rows, 23)).sum(axis=2, dtype=np.uint64) + K.streams(bands, 29)).view(np.int64)


def signatures(df: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE) -> DataFrame:
    """Per row: id, fp and the keys of its bands (none for a text without words)."""
    m = bands * rows

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                buf, offs = K.column_bytes(part.column("text"))
                hashes, _, _, first = K.words(buf, offs)
                e, r, c = K.counted(*K.shingles(hashes, first, k))
                sig = prob_minhash(e, c, r, part.num_rows, m)
                keys = band_keys(sig, bands, rows)
                some = np.diff(first) > 0
                ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fingerprints(buf, offs, hashes, first), pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].ravel()))], names=["id", "fp", "keys"])

    rows_ = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_arrow(rows_, run, "id long, fp binary, keys array<long>")


def with_fingerprint(df: DataFrame, text_col: str, once: bool = False) -> DataFrame:
    """(fp, row): the whole row as a struct beside its fingerprint; once: of rows of a partition with equal fingerprints about one, so that copies do not meet in one task."""
    from pyspark.sql import types as T

    kind = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)])

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                buf, offs = K.column_bytes(part.column("text"))
                hashes, _, _, first = K.words(buf, offs)
                fps = fingerprints(buf, offs, hashes, first)
                out = pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), part.column("row")], names=["fp", "row"])
                if once:
                    if len(seen) > 500_000:
                        seen.clear()
                    new = [fp not in seen and not seen.add(fp) for fp in fps]
                    out = out.filter(pa.array(new))
                yield out

    rows = df.select(F.col(text_col).cast("binary").alias("text"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("row"))
    return map_arrow(rows, run, T.StructType([T.StructField("fp", T.BinaryType()), T.StructField("row", kind)]))


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two weighted sets (ordered distinct elements, weights)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    w, v = a[1][i].astype(np.float64), b[1][j].astype(np.float64)
    only_w, only_v = a[1].sum() - w.sum(), b[1].sum() - v.sum()
    order = np.argsort(w / v, kind="stable")
    w, v = w[order], v[order]
    ratio = w / v
    below = np.searchsorted(ratio, ratio, side="right")  # those with a smaller or equal ratio count by v, the others by w
    sum_v, sum_w = np.concatenate([[0], np.cumsum(v)]), np.concatenate([[0], np.cumsum(w)])
    return float((1 / ((only_w + sum_w[-1] - sum_w[below]) / w + (only_v + sum_v[below]) / v)).sum())


def profiles(elements: np.ndarray, rows: np.ndarray, weights: np.ndarray, n: int, places: int = 256) -> np.ndarray:
    """(n, places): the share of each set's weight in each hash place. The overlap of two profiles (the sum of the smaller shares) is never below their similarity."""
    out = np.bincount(rows * places + (elements >> np.uint64(40)).astype(np.int64) % places, weights=weights, minlength=n * places).reshape(n, places)
    return (out / np.maximum(out.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def verified(pairs: DataFrame, texts: DataFrame, least: float, k: int) -> DataFrame:
    """The pairs (a, b) of fingerprints whose texts' similarity is at least ``least``. texts: (fp, text), one row a fingerprint."""
    both = pairs.join(texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                sets = []
                for name in ("text_a", "text_b"):
                    column = part.column(name).dictionary_encode()  # a hot text is hashed once a batch
                    buf, offs = K.column_bytes(column.dictionary)
                    hashes, _, _, first = K.words(buf, offs)
                    e, r, c = K.counted(*K.shingles(hashes, first, k))
                    ends = np.searchsorted(r, np.arange(len(column.dictionary) + 1))
                    sets.append([(e[ends[i] : ends[i + 1]], c[ends[i] : ends[i + 1]]) for i in column.indices.to_pylist()])
                sim = [probability_jaccard(x, y) for x, y in zip(*sets, strict=True)]
                keep = pa.array([s >= least - 1e-9 for s in sim])
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(sim)], names=["a", "b", "similarity"]).filter(keep)

    return map_arrow(both.select("a", "b", "text_a", "text_b"), run, "a binary, b binary, similarity double")


def links_within(members: DataFrame, least: float, k: int, bands: int, rows: int) -> DataFrame:
    """The links between components of one bucket: (key, fp, text, root: its component, large: whether that is the bucket's largest, inside, outside: nodes in it and in the others) -> (a, b).

    All nodes of the bucket have to be there. Those outside the largest component meet each other and
    those inside; both are cut into chunks, and a task sees one pair of chunks at a time. It leaves a
    pair to the first band that it shares (where both are members, too) and verifies the others
    exactly, but for those whose :func:`profiles` rule a link out and for pairs of components that it
    has linked, so that nothing but links leaves it and no link is missed.
    """
    n_out, n_in = F.ceil(F.col("outside") / CHUNK).cast("int"), F.ceil(F.col("inside") / CHUNK).cast("int")
    h = F.xxhash64("fp")
    own = F.when(F.col("large"), n_out + F.pmod(h, n_in)).otherwise(F.pmod(h, n_out)).cast("int")
    met = F.when(F.col("large"), n_out).otherwise(n_out + n_in)
    dealt = members.withColumn("x", own).withColumn("y", F.explode(F.sequence(F.lit(0), met - 1)))
    dealt = dealt.select("key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "root", "fp", "text")
    m = bands * rows

    def compare(key: int, i: int, j: int, x: list[int], roots: list[bytes], fps: list[bytes], texts: list[bytes]):
        if len(set(roots)) == 1:
            return
        order = sorted(range(len(fps)), key=lambda n: fps[n])
        x, roots, fps, texts = ([v[n] for n in order] for v in (x, roots, fps, texts))
        buf, offs = K.column_bytes(pa.array(texts, pa.binary()))
        hashes, _, _, first = K.words(buf, offs)
        e, r, c = K.counted(*K.shingles(hashes, first, k))
        sig = prob_minhash(e, c, r, len(fps), m)
        keys = band_keys(sig, bands, rows)
        band = int(np.flatnonzero((keys == key).all(axis=0))[0])
        ends = np.searchsorted(r, np.arange(len(fps) + 1))
        shares = profiles(e, r, c, len(fps))
        side, part = np.array(x), np.unique(np.array([r.hex() for r in roots]), return_inverse=True)[1]
        for n in range(len(fps) - 1):
            rest = np.arange(n + 1, len(fps))
            if i != j:  # pairs within a chunk are another task's
                rest = rest[side[rest] != side[n]]
            rest = rest[part[rest] != part[n]]
            rest = rest[~(keys[rest, :band] == keys[n, :band]).any(axis=1)]
            rest = rest[np.minimum(shares[rest], shares[n]).sum(axis=1) >= least - 1e-4]
            for o in rest:
                if part[o] != part[n] and probability_jaccard((e[ends[n] : ends[n + 1]], c[ends[n] : ends[n + 1]]), (e[ends[o] : ends[o + 1]], c[ends[o] : ends[o + 1]])) >= least - 1e-9:
                    part[part == part[o]] = part[n]
                    yield fps[n], fps[o]

    def run(batches):
        def groups():
            now, group = None, ([], [], [], [])
            for batch in batches:
                for ky, i, j, x, root, fp, text in zip(*(batch.column(n).to_pylist() for n in ("key", "i", "j", "x", "root", "fp", "text")), strict=True):
                    if (ky, i, j) != now:
                        if now:
                            yield *now, *group
                        now, group = (ky, i, j), ([], [], [], [])
                    for to, v in zip(group, (x, root, fp, text), strict=True):
                        to.append(v)
            if now:
                yield *now, *group

        for g in groups():
            found = list(compare(*g))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in zip(*found, strict=True)], names=["a", "b"])

    place = ["key", "i", "j"]
    return map_arrow(dealt.repartition(*place).sortWithinPartitions(*place), run, "a binary, b binary")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Two tables: each row's (id, fp), and per fingerprint (fp, class: least fingerprint of its class, n: rows, least: smallest id and how many rows have it)."""
    spark = df.sparkSession
    signed = materialise(signatures(df, id_col, text_col, bands, rows, k), "signatures")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    nodes = materialise(signed.groupBy("fp").agg(F.count("*").alias("n"), F.min(order).alias("least"), F.first("keys").alias("keys")), "nodes")
    buckets = nodes.select("fp", F.explode("keys").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    shared = materialise(buckets.join(sizes, "key"), "buckets")  # nodes with company
    central = shared.groupBy("fp").agg(F.sum("c").alias("w"))
    weighted = shared.join(central, "fp").select("fp", "key", F.struct("w", "fp").alias("by"))
    tops = weighted.groupBy("key").agg(F.max("by").alias("top"))
    pairs = weighted.join(tops, "key").select("fp", F.col("top.fp").alias("top")).filter("fp <> top")
    pairs = materialise(pairs.select(F.least("fp", "top").alias("a"), F.greatest("fp", "top").alias("b")).distinct(), "pairs")
    if pairs.isEmpty():
        roots = spark.createDataFrame([], "node binary, root binary")
    else:
        whole = with_fingerprint(df.select(F.col(text_col).cast("binary").alias("t")), "t", once=True).select("fp", F.col("row.c0").alias("text"))
        texts = materialise(whole.join(central, "fp", "left_semi").groupBy("fp").agg(F.first("text").alias("text")), "texts")
        links = materialise(verified(pairs, texts, least, k).select("a", "b"), "links")
        roots = components(links)
        named = materialise(shared.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root")), "named")
        each = named.groupBy("key", "root").agg(F.count("*").alias("c"))
        open_ = each.groupBy("key").agg(F.count("*").alias("several"), F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("most")).filter("several > 1")
        open_ = open_.select("key", F.col("most.root").alias("largest"), F.col("most.c").alias("inside"), (F.col("all") - F.col("most.c")).alias("outside"))
        members = named.join(open_, "key").withColumn("large", F.expr("root = largest")).join(texts, "fp")
        more = materialise(links_within(members, least, k, bands, rows), "links")
        if not more.isEmpty():
            roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(more))
        discard(texts, links, more, named)
    discard(shared, pairs)
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("class"), "n", "least")
    return signed.select("id", "fp"), named


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per row of ``df``: id, class_id (smallest id of its class) and class_size (rows in it)."""
    ids, named = classes(df, id_col, text_col, **how)
    named = materialise(named, "classes")
    whole = named.groupBy("class").agg(F.min("least").alias("least"), F.sum("n").alias("class_size"))
    by_fp = named.select("fp", "class").join(whole, "class").select("fp", F.col("least.id").alias("class_id"), "class_size")
    return ids.join(by_fp, "fp").select(F.col("id").alias(id_col), "class_id", "class_size")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df``, with all their columns, of which exactly one of each class is left: the one with the smallest id."""
    ids, named = classes(df, id_col, text_col, **how)
    named = materialise(named, "classes")
    best = named.groupBy("class").agg(F.min(F.struct("least", "fp")).alias("best"))
    top = best.select(F.col("best.fp").alias("fp"), F.col("best.least.id").alias("keep_id"))
    lost = named.select("fp").join(top, "fp", "left_anti")
    firsts = ids.join(top, "fp").filter(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("fp").count().filter("count > 1")
    again = materialise(firsts.select("fp", F.lit(True).alias("again")), "again")
    several = named.filter("n > 1").select("fp").join(top, "fp").join(again, "fp", "left")
    at = df.columns.index(id_col)
    rows = with_fingerprint(df, text_col).join(lost, "fp", "left_anti")
    rows = rows.join(several, "fp", "left").filter(F.col("keep_id").isNull() & F.col("again").isNull() | F.col(f"row.c{at}").cast("long").eqNullSafe(F.col("keep_id")))
    kept = rows.filter("again is null").select("row")
    if not again.isEmpty():  # several rows with the smallest id of their class
        kept = kept.unionByName(rows.filter("again").groupBy("fp").agg(F.first("row").alias("row")).select("row"))
    return kept.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(df.columns)])
