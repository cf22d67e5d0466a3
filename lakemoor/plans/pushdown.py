"""What of a query reaches the scan."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ScanReport:
    """Of one file scan: filters handed to Parquet, partition filters, the columns read, and the conditions Spark evaluates above it."""

    pushed: tuple[str, ...]
    partition: str
    read_schema: str
    residual: tuple[str, ...]


def explain_pushdown(df: DataFrame) -> list[ScanReport]:
    """A report for each file scan of the query, by its physical plan; nothing is executed."""
    out: list[ScanReport] = []

    def walk(node, above: tuple[str, ...]) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "FilterExec":
            above = (*above, node.condition().toString())
        if kind == "FileSourceScanExec":
            meta = node.metadata()
            text = lambda k: meta.get(k).get() if meta.contains(k) else ""
            listed = text("PushedFilters").strip("[]")
            parts = [p for p in re.split(r", (?=[A-Z]\w*\()", listed) if p]
            out.append(ScanReport(tuple(parts), text("PartitionFilters"), text("ReadSchema"), above))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), above)

    walk(df._jdf.queryExecution().sparkPlan(), ())
    return out
