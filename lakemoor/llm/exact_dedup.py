"""Exact deduplication by Grace hashing.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` becomes one space.

1. Each input partition collapses its own copies in an open-addressing table that compares
   complete contents (a pre-aggregation: of a group of copies, one row per partition goes on).
2. The remaining rows are dealt out by content hash. A task streams its rows into the same kind of
   table; when the distinct contents outgrow the memory budget, table and rest go to spill files,
   one per hash bucket, and each bucket is treated alike, recursively, with the next hash bits.
   Of a class the table keeps a short entry for each input partition that holds it, or, where only
   the rows that stay are asked for, the best row alone. Rows that only wait for their verdict pass
   by through a file.
3. The verdict on a class returns to its rows under the key (partition, epoch, content), which
   holds no more rows than an input partition does, whatever the size of the group.

Defined cases: a null text counts as empty; a null id is larger than every id (``keep_id`` is null
only if all ids of the class are); of rows with the same smallest id exactly one is kept; an
empty table gives an empty result; further columns are ignored (annotate) or kept (filter).
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemoor.llm.shared import map_arrow

#: Bytes of distinct content that a task holds in memory at once.
BUDGET = 64 << 20
FANOUT = 16
MASK = (1 << 64) - 1


def normalise(text: bytes | None) -> bytes:
    """Each run of the six ASCII white-space bytes becomes one space; the ends are not trimmed."""
    if not text:
        return b""
    words = text.split()
    if not words:
        return b" "
    return b" " * text[:1].isspace() + b" ".join(words) + b" " * text[-1:].isspace()


class OpenTable:
    """Open addressing with linear probing; keys are complete contents, values are lists."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.values: list[list] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> int:
        """The entry of this content, made if need be."""
        mask = len(self.slots) - 1
        at = h & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return i
            at = (at + 1) & mask
        self.slots[at] = i = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.values.append([])
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return i

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for i, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def grace(records: Iterator[tuple[int, bytes, tuple]], folder: str, budget: int = BUDGET, level: int = 0, best=None, size=lambda meta: 150) -> Iterator[tuple[bytes, list[tuple]]]:
    """Classes of equal content: (content, metas). records: (hash, content, meta); best: of two metas the one to keep, instead of all; size: bytes of a meta."""
    table = OpenTable()
    for h, content, meta in records:
        metas = table.values[table.find(h, content)]
        if best and metas:
            table.bytes -= size(metas[0])
            metas[0] = best(metas[0], meta)
        else:
            metas.append(meta)
        table.bytes += size(metas[-1])
        if table.bytes > budget and len(table.contents) > 1 and level < 16:
            break
    else:
        yield from zip(table.contents, table.values, strict=True)
        return
    paths = [os.path.join(folder, f"{level}-{os.urandom(8).hex()}") for _ in range(FANOUT)]
    files = [open(p, "wb") for p in paths]
    try:
        for h, content, metas in zip(table.hashes, table.contents, table.values, strict=True):
            for meta in metas:
                pickle.dump((h, content, meta), files[(h >> (60 - 4 * (level % 15))) & (FANOUT - 1)], protocol=5)
        del table
        for h, content, meta in records:
            pickle.dump((h, content, meta), files[(h >> (60 - 4 * (level % 15))) & (FANOUT - 1)], protocol=5)
    finally:
        for f in files:
            f.close()
    for p in paths:
        yield from grace(_spilled(p), folder, budget, level + 1, best, size)
        os.remove(p)


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _order(doc_id: int | None) -> tuple:
    return (doc_id is None, doc_id or 0)


def _signed(x: int) -> int:
    x &= MASK
    return x - (1 << 64) if x >> 63 else x


def _member_key(sha: bytes, pid: int, epoch: int) -> int:
    return _signed((int.from_bytes(sha[8:16], "little") ^ (pid * 0x9E3779B97F4A7C15) ^ (epoch * 0xC2B2AE3D27D4EB4F)) * 0xD6E8FEB86659FD93)


LOCAL = pa.schema([("route", pa.int64()), ("pid", pa.int32()), ("epoch", pa.int32()), ("sha", pa.binary()), ("id", pa.int64()), ("n", pa.int64()), ("text", pa.binary()), ("payload", pa.binary())])
LOCAL_DDL = "route long, pid int, epoch int, sha binary, id long, n long, text binary, payload binary"
CLASSES = pa.schema([("mkey", pa.int64()), ("pid", pa.int32()), ("epoch", pa.int32()), ("sha", pa.binary()), ("id", pa.int64()), ("rep", pa.bool_()), ("keep_id", pa.int64()), ("size", pa.int64()), ("kept", pa.bool_())])
CLASSES_DDL = "mkey long, pid int, epoch int, sha binary, id long, rep boolean, keep_id long, size long, kept boolean"


def _collapse(members: bool, budget: int):
    """Stage 1. members: also pass on a short row for each copy that is not its partition's first."""

    def run(batches):
        table, tops, epoch, pid = OpenTable(), [], 0, 0
        out: list[tuple] = []

        def flush():
            for content, sha, (doc_id, n, payload) in zip(table.contents, [m[0] for m in table.values], tops, strict=True):
                out.append((_signed(int.from_bytes(sha[:8], "little")), pid, epoch, sha, doc_id, n, None if payload is not None else content, payload))

        for batch in batches:
            cols = batch.to_pydict()
            payloads = cols.get("row") or [None] * batch.num_rows
            for pid, doc_id, text, row in zip(cols["pid"], cols["id"], cols["text"], payloads, strict=True):  # noqa: B007
                content = normalise(text)
                sha = hashlib.sha256(content).digest()
                i = table.find(int.from_bytes(sha[:8], "little"), content)
                payload = pickle.dumps(row, protocol=5) if row is not None else None
                if i == len(tops):
                    table.values[i].append(sha)
                    table.bytes += len(payload or b"")
                    tops.append((doc_id, 1, payload))
                else:
                    old, n, old_payload = tops[i]
                    if _order(doc_id) < _order(old):
                        doc_id, old, payload, old_payload = old, doc_id, old_payload, payload
                    tops[i] = (old, n + 1, old_payload)
                    if members:
                        out.append((_member_key(sha, pid, epoch), pid, epoch, sha, doc_id, 0, None, None))
                if table.bytes > budget:
                    flush()
                    table, tops, epoch = OpenTable(), [], epoch + 1
                if len(out) >= 2000:
                    yield _rows(out, LOCAL)
                    out = []
        flush()
        for k in range(0, len(out), 2000):
            yield _rows(out[k : k + 2000], LOCAL)

    return run


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _merge(text_at: str | None, budget: int, out_type: pa.DataType | None):
    """Stage 2. text_at: place of the text in a payload row; out_type: give the rows that stay instead of classes."""

    def run(batches):
        def records(pass_by):
            for batch in batches:
                cols = batch.to_pydict()
                short = []
                for pid, epoch, sha, doc_id, n, text, payload in zip(*(cols[c] for c in LOCAL.names[1:]), strict=True):
                    if not n:
                        short.append((_member_key(sha, pid, epoch), pid, epoch, sha, doc_id, False, None, None, False))
                    elif payload is None:
                        yield int.from_bytes(sha[:8], "little"), text, (pid, epoch, doc_id, n, sha, None)
                    else:
                        yield int.from_bytes(sha[:8], "little"), _text_of(payload, text_at), (pid, epoch, doc_id, n, sha, payload)
                if short:
                    pass_by.write_batch(_rows(short, CLASSES))

        rank = lambda m: (_order(m[2]), m[0], m[1])
        alone = None if out_type is None else lambda a, b: min(a, b, key=rank)
        with tempfile.TemporaryDirectory() as folder:
            out: list = []
            waiting = os.path.join(folder, "waiting")
            with pa.OSFile(waiting, "wb") as sink, pa.ipc.new_stream(sink, CLASSES) as pass_by:
                for _, metas in grace(records(pass_by), folder, budget, best=alone, size=lambda m: 150 + len(m[5] or b"")):
                    first = min(metas, key=rank)
                    if out_type is not None:
                        out.append(pickle.loads(first[5]))
                    else:
                        size = sum(m[3] for m in metas)
                        for m in metas:
                            out.append((_member_key(m[4], m[0], m[1]), m[0], m[1], m[4], m[2], True, first[2], size, m is first))
                            if len(out) >= 1000:
                                yield _rows(out, CLASSES)
                                out = []
                    if len(out) >= 1000:
                        yield _rows(out, CLASSES) if out_type is None else _payloads(out, out_type)
                        out = []
            if out:
                yield _rows(out, CLASSES) if out_type is None else _payloads(out, out_type)
            if out_type is None:
                with pa.OSFile(waiting, "rb") as source:
                    yield from pa.ipc.open_stream(source)

    return run


def _text_of(payload: bytes, at: str) -> bytes:
    text = pickle.loads(payload)[at]
    return normalise(None if text is None else text.encode() if isinstance(text, str) else text)


def _payloads(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, kind)], names=["row"])


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256 (see the module)."""
    rows = df.select(F.spark_partition_id().alias("pid"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    dealt = map_arrow(rows, _collapse(True, budget), LOCAL_DDL).repartition("route")
    classes = dealt.mapInArrow(_merge(None, budget, None), CLASSES_DDL)
    w = Window.partitionBy("mkey", "pid", "epoch", "sha")
    verdict = F.first(F.when(F.col("rep"), F.struct("keep_id", "size")), ignorenulls=True).over(w)
    return classes.withColumn("verdict", verdict).select(
        F.col("id").alias(id_col), F.col("verdict.keep_id").alias("keep_id"), F.col("verdict.size").alias("group_size"), "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """The rows of ``df`` that :func:`exact_dedup` keeps, with all their columns."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)])
    names = df.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    rows = df.select(F.spark_partition_id().alias("pid"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"), row.alias("row"))
    dealt = map_arrow(rows, _collapse(False, budget), LOCAL_DDL).repartition("route")
    kept = dealt.mapInArrow(_merge(f"c{names.index(text_col)}", budget, to_arrow_type(kind)), T.StructType([T.StructField("row", kind)]))
    return kept.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
