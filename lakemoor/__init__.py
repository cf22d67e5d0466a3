"""lakemoor: a Spark-native engine over versioned columnar datasets."""

from lakemoor.errors import CommitConflictError, EngineError
from lakemoor.operators.compaction import compact
from lakemoor.plans.pushdown import explain_pushdown
from lakemoor.sources.scan import pull, scan_dataset, versions
from lakemoor.sources.write import sink_dataset, write_dataset

__all__ = ["CommitConflictError", "EngineError", "compact", "explain_pushdown", "pull", "scan_dataset", "sink_dataset", "versions", "write_dataset"]
