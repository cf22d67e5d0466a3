"""Approximate nearest neighbours by a hash-prefix forest.

A tree is a sorted array of long hash strings, one for each vector: ``BITS`` signs of its
projections. A query descends each tree to its longest matching prefix, and then the trees ascend
together: one after the other takes in what shares one bit less, round by round. What was taken in
is compared exactly.

The first ``HEAD`` bits of a tree tell which of two pivots is nearer, for random pairs of ``PIVOTS``
means, so that prefixes follow the large structure of the data; the others are signs of random
projections about the mean. Means are fitted on at most ``SAMPLE`` vectors, those with the smallest
id hash. Every vector is indexed.

The first tree also deals out the vectors: its prefixes, as long as it takes for a prefix to hold
about ``SHARD`` rows of the sample's estimate, are the leaves (variable-length; a table of at most
``SAMPLE`` entries). A leaf that holds more rows after all, such as one dense cluster, is dealt to
several shards. A task takes up a shard's vectors, builds their forest and answers the queries as
they stream in. A query goes to the leaves across whose boundaries its neighbours may lie: by the
root of the sum of squares of its distances from the hyperplanes in between.

How far to go, across boundaries and up the trees, is measured on the data, at their whole size:
``PROBES`` vectors of the sample are compared with all rows in one pass (their best of each task
are merged), and both bounds are set so that ``WITHIN`` of their true neighbours would be found by
each. So the share of rows looked at falls as neighbours get nearer in larger or clustered tables,
and rises where prefixes cannot tell neighbours apart. It is given for each query (``looked``).

Of equal vectors only the k + 1 smallest ids can be among k nearest; each batch and each shard keeps
these alone, so a hot vector is no load.

Defined cases: vectors that are null, zero, or hold null or non-finite components, or have another
length than most of the sample, take no part, neither as query nor as candidate; ties go to the
smaller id; a query that has gathered too few goes on to further leaves and up to the roots, so it
gets ``k`` rows or all there are; rows with a null id take no part; of repeated rows each is a
candidate, and a query that is repeated is answered once; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemoor.llm.shared import map_arrow, materialise

TREES, BITS, HEAD, PIVOTS = 16, 48, 20, 24
SAMPLE, SHARD, BLOCK = 4096, 8192, 1024
PROBES, WITHIN = 192, 0.975


def directions(sample: np.ndarray, trees: int = TREES, bits: int = BITS, head: int = HEAD, pivots: int = PIVOTS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(trees, bits, d) directions and the (trees, bits) values at which their signs turn."""
    d = sample.shape[1]
    rng = np.random.default_rng(seed)
    means = sample[rng.permutation(len(sample))[:pivots]].copy()
    for _ in range(12):
        near = ((means**2).sum(axis=1) - 2 * sample @ means.T).argmin(axis=1)
        for i in range(len(means)):
            if (near == i).any():
                means[i] = sample[near == i].mean(axis=0)
    means = np.unique(means, axis=0)
    out = rng.standard_normal((trees, bits, d))
    turn = out @ sample.mean(axis=0)
    if len(means) > 1:
        for t in range(trees):
            for i in range(min(head, bits)):
                a, b = means[rng.permutation(len(means))[:2]]
                out[t, i], turn[t, i] = a - b, (a @ a - b @ b) / 2
    return out, turn


class Forest:
    """Sorted hash strings of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, dirs: np.ndarray, turn: np.ndarray) -> None:
        self.ids, self.vectors, self.dirs, self.turn = ids, vectors, dirs, turn
        codes = self.codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(trees, n): hash strings as numbers, the first bit the highest."""
        signs = np.einsum("nd,tbd->tnb", vectors, self.dirs, optimize=True) > self.turn[:, None, :]
        return signs @ (np.uint64(1) << np.arange(self.dirs.shape[1] - 1, -1, -1, dtype=np.uint64))

    def search(self, queries: np.ndarray, effort: int, least: int):
        """For each query the places of its candidates: those of at most this effort, but at least ``least`` or all."""
        trees, bits = self.dirs.shape[:2]
        n = self.sorted.shape[1]
        least = min(least, n)
        codes = self.codes(queries)

        def ranges(t: int, depth: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            rest = np.uint64(bits - depth)
            low = (code >> rest) << rest
            return np.searchsorted(self.sorted[t], low, side="left"), np.searchsorted(self.sorted[t], low + (np.uint64(1) << rest) - np.uint64(1), side="right")

        found = [ranges(t, depth, codes[t]) for t, depth in enumerate(depths(effort, trees, bits))]
        for q in range(codes.shape[1]):
            mask = np.zeros(n, dtype=bool)
            for t in range(trees):
                mask[self.order[t, found[t][0][q] : found[t][1][q]]] = True
            more = effort
            while mask.sum() < least:
                more += trees
                for t, depth in enumerate(depths(more, trees, bits)):
                    lo, hi = ranges(t, depth, codes[t, q : q + 1])
                    mask[self.order[t, lo[0] : hi[0]]] = True
            yield np.flatnonzero(mask)


def depths(effort: int, trees: int, bits: int) -> list[int]:
    """How many first bits each tree still asks to agree: tree t takes in what shares ``depth`` bits at the effort (bits - depth) * trees + t."""
    return [min(bits, max(0, bits - (effort - t) // trees)) if effort >= t else bits for t in range(trees)]


def efforts(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """The least effort at which vectors with the codes a and b, (trees, n), meet."""
    trees = len(a)
    differ = a ^ b
    length = np.zeros(a.shape, dtype=np.int64)  # of what follows the common prefix
    for k in range(bits):
        length[(differ >> np.uint64(k)) > 0] = k + 1
    return (length * trees + np.arange(trees)[:, None]).min(axis=0)


class Leaves:
    """The first tree's prefixes by which vectors are dealt out."""

    def __init__(self, sample: np.ndarray, dirs: np.ndarray, turn: np.ndarray, rows: int) -> None:
        norm = np.maximum(np.linalg.norm(dirs[0], axis=1), 1e-300)
        self.dirs, self.turn = dirs[0, :HEAD] / norm[:HEAD, None], turn[0, :HEAD] / norm[:HEAD]
        signs = self.margins(sample) > 0
        self.prefixes: list[tuple[bool, ...]] = []
        branches: list[list[int]] = []  # what follows a 0 and a 1: a further branch, or -1 - leaf
        stack = [((), np.arange(len(sample)), None)]
        while stack:
            prefix, held, above = stack.pop()
            depth = len(prefix)
            if len(held) * rows <= SHARD * len(sample) or len(held) < 2 or depth == len(self.turn):
                here = -1 - len(self.prefixes)
                self.prefixes.append(prefix)
            else:
                here = len(branches)
                branches.append([0, 0])
                one = signs[held, depth]
                stack += [((*prefix, False), held[~one], here), ((*prefix, True), held[one], here)]
            if above is not None:
                branches[above][int(prefix[-1])] = here
        self.branches = np.array(branches, dtype=np.int64).reshape(-1, 2)

    def own(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.full(len(vectors), 0 if len(self.branches) else -1, dtype=np.int64)
        signs = (self.margins(vectors) > 0).astype(np.int64)
        for depth in range(signs.shape[1]):
            on = at >= 0
            if not on.any():
                break
            at[on] = self.branches[at[on], signs[on, depth]]
        return (-1 - at).astype(np.int32)

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.dirs.T - self.turn

    def costs(self, vectors: np.ndarray) -> np.ndarray:
        """(n, leaves): how far the hyperplanes between a vector and a leaf are; 0 for its own leaf alone."""
        m = self.margins(vectors)
        to_one, to_zero = np.where(m > 0, 0.0, np.maximum(m**2, 1e-300)), np.where(m > 0, m**2, 0.0)
        out = np.zeros((len(vectors), len(self.prefixes)))
        for i, prefix in enumerate(self.prefixes):
            for bit, one in enumerate(prefix):
                out[:, i] += to_one[:, bit] if one else to_zero[:, bit]
        return np.sqrt(out)


def distinct(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among k nearest: of equal vectors those with the k + 1 smallest ids."""
    order = np.lexsort((ids,))
    rows = np.ascontiguousarray(vectors[order] + 0.0).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
    _, which = np.unique(rows, return_inverse=True)
    by = np.argsort(which, kind="stable")
    start = np.searchsorted(which[by], which[by], side="left")
    return np.sort(order[by[np.arange(len(by)) - start <= k]])


def valid(column: str):
    x = F.col(column)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & whole & F.exists(x, lambda v: v != 0)


def nearest(df: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", within: float = WITHIN) -> DataFrame:
    """For each row whose id is divisible by ``every``, its ``k`` nearest other rows: query_id, rank, vec_id, score (Euclidean distance), looked (rows compared with the query)."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & valid("v"))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, looked long")
    lengths = [len(r["v"]) for r in sample]
    d = max(set(lengths), key=lengths.count)
    picked = [r for r in sample if len(r["v"]) == d]
    ids, vectors = np.array([r["id"] for r in picked]), np.array([r["v"] for r in picked])
    dirs, turn = directions(vectors)
    rows = rows.filter(F.size("v") == d)
    leaves = Leaves(vectors, dirs, turn, rows.count())

    def deal(batches):
        for batch in batches:
            own, matrix = batch.column("id").to_numpy(), batch.column("v").flatten().to_numpy().reshape(-1, d)
            if len(own):
                places = distinct(own, matrix, k)
                kept = batch.take(pa.array(places))
                leaf = leaves.own(matrix[places])
                yield pa.RecordBatch.from_arrays([pa.array(leaf), kept.column("id"), kept.column("v")], names=["leaf", "id", "v"])

    dealt = materialise(map_arrow(rows, deal, "leaf int, id long, v array<double>"), "vectors")
    shards = np.zeros(len(leaves.prefixes), dtype=np.int64)
    held = shards.copy()
    for r in dealt.groupBy("leaf").count().collect():
        held[r["leaf"]], shards[r["leaf"]] = r["count"], -(-r["count"] // SHARD)
    far, effort = measured(dealt, ids[:PROBES], vectors[:PROBES], leaves, dirs, turn, k, within)

    def ask(batches):
        for batch in batches:
            own, matrix = batch.column("id").to_numpy(), batch.column("v").flatten().to_numpy().reshape(-1, d)
            for at in range(0, len(own), BLOCK):
                cost = leaves.costs(matrix[at : at + BLOCK])
                order = np.argsort(cost, axis=1, kind="stable")
                before = np.cumsum(held[order], axis=1) - held[order]
                go = (np.take_along_axis(cost, order, axis=1) <= far) | (before < k + 1)
                row, place = np.nonzero(go & (held[order] > 0))
                leaf = order[row, place]
                again = shards[leaf]
                row, leaf = np.repeat(row, again), np.repeat(leaf, again)
                salt = np.arange(len(row)) - np.repeat(np.cumsum(again) - again, again)
                for lo in range(0, len(row), 4096):
                    part = batch.take(pa.array(at + row[lo : lo + 4096]))
                    yield pa.RecordBatch.from_arrays([pa.array(leaf[lo : lo + 4096].astype(np.int32)), pa.array(salt[lo : lo + 4096].astype(np.int32)), part.column("id"), part.column("v")], names=["leaf", "salt", "id", "v"])

    queries = map_arrow(rows.filter(F.col("id") % every == 0).dropDuplicates(["id"]), ask, "leaf int, salt int, id long, v array<double>")
    salts = F.element_at(F.array(*[F.lit(int(x)) for x in np.maximum(shards, 1)]), F.col("leaf") + 1)
    data = dealt.withColumn("salt", F.pmod(F.xxhash64("id", "v"), salts).cast("int"))
    both = data.select("leaf", "salt", F.lit(0).alias("kind"), "id", "v").unionByName(queries.withColumn("kind", F.lit(1)))

    def answer(batches):
        shard, ids, vectors, forest = None, [], [], None
        for batch in batches:
            at = np.stack([batch.column(c).to_numpy() for c in ("leaf", "salt", "kind")])
            cuts = [0, *(np.flatnonzero((np.diff(at) != 0).any(axis=0)) + 1), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if tuple(at[:2, lo]) != shard:
                    shard, ids, vectors, forest = tuple(at[:2, lo]), [], [], None
                part = batch.slice(lo, hi - lo)
                own, matrix = part.column("id").to_numpy(), part.column("v").flatten().to_numpy().reshape(-1, d)
                if at[2, lo] == 0:
                    ids.append(own)
                    vectors.append(matrix)
                    continue
                if forest is None and ids:
                    all_ids, all_vectors = np.concatenate(ids), np.concatenate(vectors)
                    places = distinct(all_ids, all_vectors, k)
                    forest = Forest(all_ids[places], all_vectors[places], dirs, turn)
                for k0 in range(0, len(own) if forest else 0, BLOCK):
                    yield found_in(forest, own[k0 : k0 + BLOCK], matrix[k0 : k0 + BLOCK])

    def found_in(forest: Forest, q_ids: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        out = []
        for i, places in enumerate(forest.search(q, effort, k + 1)):
            places = places[forest.ids[places] != q_ids[i]]
            score = np.sqrt(((forest.vectors[places] - q[i]) ** 2).sum(axis=1))
            best = np.lexsort((forest.ids[places], score))[:k]
            looked = np.zeros(len(best), dtype=np.int64)
            looked[:1] = len(places)
            out.append((np.full(len(best), q_ids[i]), forest.ids[places][best], score[best], looked))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score", "looked"])

    found = map_arrow(both.repartition("leaf", "salt").sortWithinPartitions("leaf", "salt", "kind"), answer, "query_id long, vec_id long, score double, looked long")
    by = Window.partitionBy("query_id")
    ranked = found.withColumns({"rank": F.row_number().over(by.orderBy("score", "vec_id")), "looked": F.sum("looked").over(by)})
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "looked")


def measured(dealt: DataFrame, ids: np.ndarray, probes: np.ndarray, leaves: Leaves, dirs: np.ndarray, turn: np.ndarray, k: int, within: float) -> tuple[float, int]:
    """How far across boundaries, and up to which effort, ``within`` of the probes' true neighbours among all rows are found."""
    d, bits = probes.shape[1], dirs.shape[1]
    codes = Forest(ids, probes, dirs, turn).codes(probes)
    cost = leaves.costs(probes)
    names = ["probe", "id", "score", "cost", "effort"]

    def best_of(batches):
        top: list[np.ndarray] = [np.zeros((0, 4))] * len(probes)
        forest = Forest(ids[:1], probes[:1], dirs, turn)
        for batch in batches:
            own, matrix, leaf = batch.column("id").to_numpy(), batch.column("v").flatten().to_numpy().reshape(-1, d), batch.column("leaf").to_numpy()
            if not len(own):
                continue
            squares = (matrix**2).sum(axis=1)[:, None] - 2 * matrix @ probes.T
            for p in range(len(probes)):
                few = np.argpartition(squares[:, p], min(k + 1, len(own)) - 1)[: k + 1]
                few = few[own[few] != ids[p]]
                meet = efforts(forest.codes(matrix[few]), np.repeat(codes[:, p : p + 1], len(few), axis=1), bits)
                new = np.column_stack([own[few].astype(np.float64), ((matrix[few] - probes[p]) ** 2).sum(axis=1), cost[p, leaf[few]], meet])
                both = np.concatenate([top[p], new])
                top[p] = both[np.argsort(both[:, 1], kind="stable")[:k]]
        every = np.concatenate([np.column_stack([np.full(len(t), p), t]) for p, t in enumerate(top)])
        yield pa.RecordBatch.from_arrays([pa.array(every[:, 0].astype(np.int32)), *(pa.array(every[:, j].copy()) for j in range(1, 5))], names=names)

    best = map_arrow(dealt, best_of, "probe int, id double, score double, cost double, effort double")
    place = F.row_number().over(Window.partitionBy("probe").orderBy("score", "id"))
    found = best.withColumn("place", place).filter(F.col("place") <= k).select("cost", "effort").collect()
    if not found:
        return float("inf"), bits * len(dirs) + len(dirs)
    rank = min(len(found) - 1, int(within * len(found)))
    return sorted(r["cost"] for r in found)[rank], int(sorted(r["effort"] for r in found)[rank])
