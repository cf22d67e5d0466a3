"""Chat formatting with minimum-cost repair of roles.

Legal conversations are the paths of an automaton: an optional system turn, then user and assistant
in turn, the assistant last. For each turn a dynamic program chooses whether it stays (0), merges
with the turn before (1, with another role 1 + relabel), follows an inserted empty turn (2), or
gets another role (3; 1 if its role is none of the three); an unanswered end gets inserted turns. Of
equal costs the action that comes first in this order is taken, then the earlier state.

A turn is a 4 x 4 matrix in the (min, +) algebra, so a conversation can be cut anywhere: turns are
range-partitioned by conversation, turn and content, each task multiplies up the matrices of the
pieces of conversations it holds, one small row for each piece goes on, and of these the best states
at the cuts are found. With these known, each piece is repaired on its own. A conversation that
holds a third of all turns is thus cut into many pieces, and no task gets more than its range.

The rendering of a turn closes the turn before, opens its own (after inserted ones) and holds its
whole text; the last one closes the conversation. Concatenated by ``place`` they are the dialogue.
A text cannot open or close turns: in a marker of its own a backslash stands after ``<`` (one more
where some stand already), so :func:`unescaped` gives the text back.

Defined cases: a null conv_id is one conversation; null turns come first; equal turns are ordered by
a hash of role and text, so that long texts are no sort keys; null text counts as empty; roles are compared in lower case without outer blanks;
repeated rows are turns of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemoor.llm.shared import map_arrow, materialise, shuffle_partitions

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ["", "system", "user", "assistant"]
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, INSERT, RELABEL, UNKNOWN = 1, 2, 3, 1
FAR = 1 << 40
#: Actions by preference.
ACTIONS = ["keep", "merge", "insert", "relabel", "merge+relabel", "insert+relabel"]


def turn_options(role: int) -> list[list[tuple[int, int, int]]]:
    """For each pair of states (before, after) the best (cost, action, inserted role) of a turn with this role (0: none of the three)."""
    best = [[(FAR, len(ACTIONS), 0)] * 4 for _ in range(4)]
    label = lambda to: 0 if to == role else UNKNOWN if role == 0 else RELABEL

    def offer(a: int, b: int, cost: int, action: str, inserted: int = 0) -> None:
        best[a][b] = min(best[a][b], (cost, ACTIONS.index(action), inserted))

    for a in range(4):
        for b in NEXT[a]:
            offer(a, b, label(b), "relabel" if label(b) else "keep")
            for c in NEXT[b]:
                offer(a, c, INSERT + label(c), "insert+relabel" if label(c) else "insert", b)
        if a != START:
            offer(a, a, MERGE + label(a), "merge+relabel" if label(a) else "merge")
    return best


OPTIONS = [turn_options(r) for r in range(4)]
COSTS = [np.array([[o[0] for o in row] for row in table], dtype=np.int64) for table in OPTIONS]
#: Cost of ending in a state, and what is inserted for it.
ENDS = [(FAR, []), (2 * INSERT, [USER, ASSISTANT]), (INSERT, [ASSISTANT]), (0, [])]


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES[1:] else 0


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def cuts(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """The best states before and after each piece of one conversation."""
    cost = np.array([0, FAR, FAR, FAR], dtype=np.int64)
    came = []
    for m in matrices:
        total = cost[:, None] + m
        came.append(total.argmin(axis=0))
        cost = np.minimum(total.min(axis=0), FAR)
    state = int(np.argmin(cost + np.array([e[0] for e in ENDS])))
    out = []
    for before in reversed(came):
        out.append((int(before[state]), state))
        state = int(before[state])
    return out[::-1]


def repair(roles: list[int], first: int, last: int) -> list[tuple[int, int, int]]:
    """For each turn (state after it, action, inserted role) of the cheapest way from state ``first`` to ``last``."""
    cost = [FAR] * 4
    cost[first] = 0
    came = []
    for r in roles:
        step, now = [], []
        for b in range(4):
            c, a = min((cost[a] + OPTIONS[r][a][b][0], a) for a in range(4))
            now.append(min(c, FAR))
            step.append(a)
        came.append(step)
        cost = now
    state, out = last, []
    for r, step in zip(reversed(roles), reversed(came), strict=True):
        before = step[state]
        _, action, inserted = OPTIONS[r][before][state]
        out.append((state, action, inserted))
        state = before
    return out[::-1]


def opened(role: int) -> str:
    return f"<|im_start|>{ROLES[role]}\n"


CLOSE = "<|im_end|>\n"


MARKER = re.compile(r"<(\\*)\|im_(start|end)\|>")


def escaped(text: str) -> str:
    return MARKER.sub(r"<\1\\|im_\2|>", text) if "|im_" in text else text


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|im_(start|end)\|>", r"<\1|im_\2|>", text)


def rendered(text: str, before: int, state: int, action: int, inserted: int, last: bool) -> str:
    if ACTIONS[action].startswith("merge"):
        out = f"\n\n{text}"
    else:
        out = (CLOSE if before != START else "") + (opened(inserted) + CLOSE if inserted else "") + opened(state) + text
    if last:
        out += CLOSE + "".join(opened(r) + CLOSE for r in ENDS[state][1])
    return out


ROW = "none boolean, conv long, turn long, role string, text string, pid int, pos long, matrix array<long>"
NAMES = ["none", "conv", "turn", "role", "text", "pid", "pos", "matrix"]


def _pieces(batches):
    """Rows with their place, and after each piece of a conversation its matrix."""
    key, matrix, pos = None, None, 0

    def summary(pid: int):
        cols = [[key[0]], [key[1]], [None], [None], [None], [pid], [-1], [matrix.ravel().tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, TYPES, strict=True)], names=NAMES)

    pid = 0
    for batch in batches:
        keys = list(zip(batch.column("none").to_pylist(), batch.column("conv").to_pylist(), strict=True))
        roles = [role_code(r) for r in batch.column("role").to_pylist()]
        if keys:
            pid = batch.column("pid")[0].as_py()
        done = []
        for k, r in zip(keys, roles, strict=True):
            if k != key:
                if key is not None:
                    done.append(summary(pid))
                key, matrix = k, COSTS[r]
            else:
                matrix = product(matrix, COSTS[r])
        yield from done
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in NAMES[:6]), pa.array(np.arange(pos, pos + n)), pa.nulls(n, TYPES[-1])], names=NAMES)
        pos += n
    if key is not None:
        yield summary(pid)


TYPES = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64())]


def _states(batches):
    for batch in batches:
        out = []
        for none, conv, pieces in zip(*(batch.column(c).to_pylist() for c in ("none", "conv", "pieces")), strict=True):
            pieces.sort(key=lambda p: p["pid"])
            found = cuts([np.array(p["matrix"], dtype=np.int64).reshape(4, 4) for p in pieces])
            out += [(none, conv, p["pid"], a, b, i == len(pieces) - 1) for i, (p, (a, b)) in enumerate(zip(pieces, found, strict=True))]
        cols = zip(*out, strict=True) if out else [[]] * 6
        kinds = (pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["none", "conv", "pid", "first", "last", "final"])


def _repaired(batches):
    names = ["none", "conv", "turn", "role", "text", "pid", "pos", "first", "last", "final"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]

    def piece(rows: list[tuple]):
        none, conv, _, _, _, pid, _, state, last, final = rows[0]
        out = []
        steps = repair([role_code(r[3]) for r in rows], state, last)
        for i, (r, (after, action, inserted)) in enumerate(zip(rows, steps, strict=True)):
            text = rendered(escaped(r[4] or ""), state, after, action, inserted, final and i == len(rows) - 1)
            out.append((None if none else conv, r[2], r[3], ROLES[after], ACTIONS[action], text, pid << 40 | r[6]))
            state = after
        for k in range(0, len(out), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 2000], strict=True), kinds, strict=True)], names=["conv_id", "turn", "role", "new_role", "action", "rendered", "place"])

    rows: list[tuple] = []
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if rows and (r[0], r[1], r[5]) != (rows[0][0], rows[0][1], rows[0][5]):
                yield from piece(rows)
                rows = []
            rows.append(r)
    if rows:
        yield from piece(rows)


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per turn: conv_id, turn, role, new_role, action, rendered, place (the order within the conversation)."""
    conv = F.col(conv_col).cast("long")
    rows = df.select(conv.isNull().alias("none"), F.coalesce(conv, F.lit(0)).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    order = ["none", "conv", "turn", "content", "tie"]
    ranged = rows.withColumns({"content": F.xxhash64("role", "text"), "tie": F.monotonically_increasing_id()}).repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    ranged = ranged.select(*NAMES[:5], F.spark_partition_id().alias("pid"))
    placed = materialise(map_arrow(ranged, _pieces, ROW), "turns")
    pieces = placed.filter("pos < 0").groupBy("none", "conv").agg(F.collect_list(F.struct("pid", "matrix")).alias("pieces"))
    states = map_arrow(pieces, _states, "none boolean, conv long, pid int, first int, last int, final boolean")
    key = ["none", "conv", "pid"]
    joined = placed.filter("pos >= 0").drop("matrix").join(states, key).repartition(*key).sortWithinPartitions(*key, "pos")
    return map_arrow(joined.select("none", "conv", "turn", "role", "text", "pid", "pos", "first", "last", "final"), _repaired, "conv_id long, turn long, role string, new_role string, action string, rendered string, place long")
