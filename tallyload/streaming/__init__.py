"""Structured Streaming: F1 stream_commands, F2 stream_load (+F3 registry
refresh per batch), F4 stream_ledger_poll, F5 recover."""

from tallyload.streaming.stream import (
    LEDGER_POLL_BATCH_BASE,
    orphaned_tasks,
    recover,
    retry_waiting,
    stream_commands,
    stream_ledger_poll,
    stream_load,
)

__all__ = [
    "LEDGER_POLL_BATCH_BASE", "orphaned_tasks", "recover", "retry_waiting", "stream_commands", "stream_ledger_poll", "stream_load",
]
