"""refinery: layered (Bronze / Silver / Gold) data pipelines on plain Spark.

Everything is a DataFrame plan: JSON Lines landing files are read into raw
tables, merged to one current row per key, versioned as parquet snapshots
with a row-level change feed, and Gold aggregates are maintained
incrementally by recomputing only the groups that the feed touched.
"""

from refinery.contracts import Contract, check, conform
from refinery.session import build_session, work_dir
from refinery.sources.tables import IngestTable, PartitionedTable, VersionedTable

__all__ = ["Contract", "IngestTable", "PartitionedTable", "VersionedTable", "build_session", "check",
           "conform", "work_dir"]
