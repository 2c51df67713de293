"""tallyload: governed file ingestion as Spark DataFrame operators.

Command files announce delimited data files; a registry says how each event
type is stored; data files are loaded with typed casts and per-row rejects
into period-partitioned tables; every attempt is recorded in an append-only
ledger that the monitoring operators aggregate.
"""

from tallyload.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
