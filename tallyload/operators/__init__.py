"""DataFrame operators."""

from tallyload.operators.commands import (
    classify_commands,
    command_parse,
    command_rejects,
    last_command_per_file,
)
from tallyload.operators.conform import conform, load_fanout, reject_limit, split_rejects
from tallyload.operators.ledger import (
    assign_task_ids,
    compact_ledger,
    decode_states,
    latest_state,
    ledger_append,
    ledger_latest,
    ledger_rows,
    ledger_scan,
    load_metrics,
    read_ledger,
    replay_guard,
    state_summary,
)
from tallyload.operators.registry import (
    commands_unregistered,
    effective_registry,
    registry_active,
    registry_diff,
    registry_resolve,
    registry_validate,
    snapshot_registry,
    tables_needed_now,
)
from tallyload.operators.sizing import bounded_broadcast
from tallyload.operators.targets import (
    append_load,
    apply_retention,
    existing_tables,
    files_releasable,
    period_tables_missing,
    period_view,
    queue_depth,
    read_target,
    reject_sink,
    retention_plan,
)

__all__ = [
    "append_load", "apply_retention", "assign_task_ids", "compact_ledger", "existing_tables", "bounded_broadcast", "classify_commands",
    "command_parse", "command_rejects", "commands_unregistered", "effective_registry", "conform", "decode_states",
    "files_releasable", "last_command_per_file", "latest_state", "ledger_append", "ledger_latest", "ledger_rows",
    "ledger_scan", "load_fanout", "load_metrics", "period_tables_missing", "period_view", "queue_depth", "read_ledger", "read_target",
    "registry_active", "registry_diff", "registry_resolve", "registry_validate", "reject_limit", "reject_sink", "replay_guard",
    "retention_plan", "snapshot_registry", "split_rejects", "state_summary", "tables_needed_now",
]
