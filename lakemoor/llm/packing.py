"""Packing documents into sequences by cutting-stock column generation.

1. Documents are tokenized once. Each is cut into full sequences and one remainder; the pieces, not
   the texts, go to a table in the shared folder.
2. The driver sees only the histogram of piece lengths (at most ``limit`` numbers, whatever the
   corpus). The linear program "fewest sequences that hold all pieces" is solved by column
   generation: a column is a pattern, that is how many pieces of each length share a sequence. The
   patterns of best-fit decreasing enter first. Then each round prices with duals smoothed towards
   the best known: dynamic programming over the capacity (an unbounded knapsack with the duals as
   values) finds the best pattern, and with it the best that holds a piece of each length; those of
   negative reduced cost enter by revised simplex steps. Each round gives a lower bound (Farley's),
   and the search ends when the solution is within ``GAP`` of it, or one sequence, or when no pattern
   improves; ``Plan`` reports the bound. ``ROUNDS`` bounds the driver's time on histograms that
   converge slowly.
3. Patterns are used as often as the rounded-down solution says; the rest, fewer than one sequence a
   pattern, is packed best-fit decreasing. If rounding costs more sequences than it saves, the
   integral solution that the program started from stays. So no plan has more sequences than
   best-fit decreasing.
4. Pieces are ranked within their length, salted so that no length meets in one task: a count for
   each (length, salt) gives the offset, a window within it the rank. Length and rank give the
   sequence by a look-up in the pattern table, and a window over the few pieces of a sequence the
   offsets there.

Defined cases: a null text counts as empty and gives the one closing id; a null or repeated doc_id
is packed like any other row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemoor.llm.bpe import texts_of, tokenizer, vocabulary
from lakemoor.llm.shared import map_arrow, materialise, shuffle_partitions

LIMIT, GAP, ROUNDS, STEPS = 2048, 2e-4, 250, 8_000
#: Simplex steps between two times that the inverse of the basis is updated as a whole.
ETAS = 64

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@dataclass
class Plan:
    """Patterns (length -> pieces) with how often each is used; the linear program's value and a bound that no packing is below."""

    used: list[tuple[dict[int, int], int]]
    value: float
    bound: float

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.used)


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each capacity up to the given one the best total price of pieces that fit, each size as often as wanted, and the size (its place; -1: none) taken last."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    upto = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = upto[c]
        best[c] = best[c - 1]
        if k:
            gain = best[c - sizes[:k]] + prices[:k]
            i = gain.argmax()
            if gain[i] > best[c] + 1e-12:
                best[c], took[c] = gain[i], i
    return best, took


def pattern(took: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[int, int]:
    """The pieces (place of the size -> how many) behind a capacity's best price."""
    out: dict[int, int] = {}
    while capacity > 0:
        i = int(took[capacity])
        if i < 0:
            capacity -= 1
        else:
            out[i] = out.get(i, 0) + 1
            capacity -= int(sizes[i])
    return out


def best_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing of a histogram: patterns (place of the size -> pieces) and how often each comes about. Sequences that are alike are filled at once."""
    by_room: dict[int, list[tuple[dict[int, int], int]]] = {}
    done: list[tuple[dict[int, int], int]] = []

    def put(counts: dict[int, int], n: int, room: int) -> None:
        if n:
            (by_room.setdefault(room, []) if room else done).append((counts, n))

    for i in range(len(sizes) - 1, -1, -1):
        size, left = int(sizes[i]), int(demand[i])
        for room in sorted(r for r in by_room if r >= size):
            if not left:
                break
            each = room // size
            for counts, n in by_room.pop(room):
                full = min(n, left // each)
                left -= full * each
                put(counts | {i: each}, full, room - each * size)
                if full < n and left:  # the last of these is not filled up
                    put(counts | {i: left}, 1, room - left * size)
                    full, left = full + 1, 0
                put(counts, n - full, room)
        each = capacity // size
        put({i: each}, left // each, capacity - each * size)
        if left % each:
            put({i: left % each}, 1, capacity - left % each * size)
    return done + [x for group in by_room.values() for x in group]


class Basis:
    """A basis of the program: columns, their use x, and the inverse as a whole one behind a list of simplex steps (product form)."""

    def __init__(self, sizes: np.ndarray, demand: np.ndarray, capacity: int) -> None:
        each = capacity // sizes
        self.columns: list[dict[int, int]] = [{i: int(c)} for i, c in enumerate(each)]
        self.demand = demand.astype(np.float64)
        self.inverse = np.diag(1.0 / each)
        self.steps: list[tuple[int, np.ndarray]] = []
        self.x = self.demand / each
        self.duals = 1.0 / each

    def worth(self, column: dict[int, int]) -> float:
        return sum(self.duals[i] * c for i, c in column.items())

    def enter(self, column: dict[int, int]) -> bool:
        """Bring a column into the basis; False if its reduced cost is not negative or the step is too small to be sound."""
        gain = self.worth(column) - 1
        if gain <= 1e-9:
            return False
        step = self.inverse[:, list(column)] @ np.array(list(column.values()), dtype=np.float64)
        for r, eta in self.steps:
            at = step[r]
            if at:
                step += at * eta
        up = step > 1e-7
        if not up.any():
            return False
        ratio = np.full(len(step), np.inf)
        ratio[up] = self.x[up] / step[up]
        least = ratio.min()
        ties = np.flatnonzero(ratio <= least * (1 + 1e-9) + 1e-9)
        r = int(ties[step[ties].argmax()])
        row = self._row(r) / step[r]
        eta = -step / step[r]
        eta[r] = 1 / step[r] - 1
        self.x = np.maximum(self.x - ratio[r] * step, 0)
        self.x[r] = ratio[r]
        self.duals = self.duals - gain * row
        self.columns[r] = dict(column)
        self.steps.append((r, eta))
        if len(self.steps) >= ETAS:
            self._fold()
        return True

    def _row(self, r: int) -> np.ndarray:
        weights = {r: 1.0}
        for at, eta in reversed(self.steps):
            total = sum(w * eta[i] for i, w in weights.items())
            if total:
                weights[at] = weights.get(at, 0.0) + total
        return np.array(list(weights.values())) @ self.inverse[list(weights)]

    def _fold(self) -> None:
        """Multiply the steps into the inverse, and compute x and the duals anew from it."""
        places = sorted({r for r, _ in self.steps})
        change = np.zeros((len(self.x), len(places)))
        for k, p in enumerate(places):
            column = np.zeros(len(self.x))
            column[p] = 1
            for r, eta in self.steps:
                if column[r]:
                    column += column[r] * eta
            column[p] -= 1
            change[:, k] = column
        self.inverse += change @ self.inverse[places]
        self.steps = []
        self.x = np.maximum(self.inverse @ self.demand, 0)
        self.duals = self.inverse.sum(axis=0)


class Pool:
    """All columns found so far, to be priced at once."""

    def __init__(self) -> None:
        self.columns: list[dict[int, int]] = []
        self.known: set[tuple] = set()
        self.places, self.counts, self.first = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, columns: list[dict[int, int]]) -> None:
        new = [c for c in columns if (key := tuple(sorted(c.items()))) not in self.known and not self.known.add(key)]
        ends = len(self.places) + np.cumsum([0, *(len(c) for c in new)])[:-1]
        self.first = np.concatenate([self.first, ends]).astype(np.int64)
        self.places = np.concatenate([self.places, np.array([i for c in new for i in c], dtype=np.int64)])
        self.counts = np.concatenate([self.counts, np.array([n for c in new for n in c.values()], dtype=np.int64)])
        self.columns += new

    def best(self, duals: np.ndarray, most: int) -> list[dict[int, int]]:
        """The columns of the most negative reduced cost."""
        if not self.columns:
            return []
        worth = np.add.reduceat(duals[self.places] * self.counts, self.first)
        some = np.flatnonzero(worth > 1 + 1e-7)
        return [self.columns[i] for i in some[np.argsort(-worth[some], kind="stable")[:most]]]


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, start: list[dict[int, int]], known: float = np.inf, gap: float = GAP, rounds: int = ROUNDS) -> tuple[list[tuple[dict[int, int], float]], float]:
    """The patterns of the best basis with how often each is used, and a lower bound of the program. known: sequences of a packing at hand."""
    basis, pool = Basis(sizes, demand, capacity), Pool()
    pool.add(start)
    centre = sizes / capacity  # duals at which no pattern is worth more than one sequence
    bound = float(centre @ demand)
    steps, smooth = 0, True
    for _ in range(rounds):
        while steps < STEPS and (entered := sum(basis.enter(column) for column in pool.best(basis.duals, 96))):
            steps += entered
        value = min(basis.x.sum(), known)
        if steps >= STEPS or value - bound <= max(gap * bound, 0.999):
            break
        prices = np.maximum(0.7 * centre + 0.3 * basis.duals if smooth else basis.duals, 0)
        best, took = knapsack(sizes, prices, capacity)
        farley = float(prices @ demand) / max(best[capacity], 1.0)
        if farley > bound:
            bound, centre = farley, prices / max(best[capacity], 1.0)
        found = [pattern(took, sizes, capacity)]
        with_one = best[capacity - sizes] + prices
        for i in np.argsort(-with_one, kind="stable")[:400]:
            rest = pattern(took, sizes, int(capacity - sizes[i]))
            rest[int(i)] = rest.get(int(i), 0) + 1
            found.append(rest)
        pool.add(found)
        if smooth and not pool.best(basis.duals, 1):
            smooth = False  # misprice: the smoothed duals' patterns do not improve
        elif not smooth:
            if not pool.best(basis.duals, 1):
                break
            smooth = True
    return [(c, float(x)) for c, x in zip(basis.columns, basis.x, strict=True)], bound


def plan(histogram: dict[int, int], capacity: int, gap: float = GAP, rounds: int = ROUNDS) -> Plan:
    """Patterns that together hold each piece of the histogram once."""
    sizes = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    if not len(sizes):
        return Plan([], 0.0, 0.0)
    first = best_fit(sizes, left, capacity)
    solution, bound = column_generation(sizes, left, capacity, [c for c, _ in first], sum(n for _, n in first), gap, rounds)
    used: list[tuple[dict[int, int], int]] = []
    for counts, x in sorted(solution, key=lambda u: -u[1]):
        n = min([int(x + 1e-6), *(int(left[i]) // c for i, c in counts.items())])
        if n > 0:
            for i, c in counts.items():
                left[i] -= n * c
            used.append((counts, n))
    some = left > 0
    places = np.flatnonzero(some)
    used += [({int(places[i]): c for i, c in counts.items()}, n) for counts, n in best_fit(sizes[some], left[some], capacity)]
    if sum(n for _, n in used) > sum(n for _, n in first):
        used = first
    return Plan([({int(sizes[i]): c for i, c in counts.items()}, n) for counts, n in used], sum(x for _, x in solution), bound)


def slots(used: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By class: the first rank of each pattern's share, the pattern's first sequence, and its pieces of the class in a sequence."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    at: dict[int, int] = {}
    base = 0
    for counts, n in used:
        for size, c in counts.items():
            out.setdefault(size, []).append((at.get(size, 0), base, c))
            at[size] = at.get(size, 0) + n * c
        base += n
    return {size: tuple(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) for size, rows in out.items()}


def token_pieces(df: DataFrame, id_col: str, text_col: str, name: str, limit: int, closing: int) -> DataFrame:
    def run(batches):
        t = tokenizer(vocabulary(name), "tiktoken")
        end = closing.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("id").to_pylist(), texts_of(batch.column("text")), strict=True):
                ids = t.encode_bytes(text) + end
                n = len(ids) // 4
                for start in range(0, n, limit):
                    part = ids[4 * start : 4 * (start + limit)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
            for at in range(0, len(rows), 10000):
                cols = zip(*rows[at : at + 10000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, PIECES, strict=True)], schema=PIECES)

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_arrow(rows, run, PIECES_DDL)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k.json", limit: int = LIMIT, closing: int = 1) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = df.sparkSession
    salts = shuffle_partitions(spark)
    pieces = materialise(token_pieces(df, id_col, text_col, name, limit, closing), "pieces")
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    by_salt = pieces.groupBy("length", "salt").count()
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(histogram, limit).used)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_salt.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start"))
    ranked = pieces.withColumn("place", place - 1).join(offsets, ["length", "salt"]).select(*PIECES.names, (F.col("before") + F.col("place")).alias("rank"))

    def look_up(batches):
        for batch in batches:
            size, rank = batch.column("length").to_numpy(zero_copy_only=False), batch.column("rank").to_numpy(zero_copy_only=False)
            seq = np.zeros(len(rank), dtype=np.int64)
            for c in np.unique(size):
                here = size == c
                first, base, per = table[int(c)]
                i = np.searchsorted(first, rank[here], side="right") - 1
                seq[here] = base[i] + (rank[here] - first[i]) // per[i]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in PIECES.names), pa.array(seq)], names=[*PIECES.names, "sequence_id"])

    placed = map_arrow(ranked, look_up, f"{PIECES_DDL}, sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(offset, F.lit(0)).cast("long")).withColumnRenamed("doc_id", id_col)
