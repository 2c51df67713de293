"""The driver contract: entry / queries / oracle_sql."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare

SF = "/root/testdata/sf0.001"
FAST = [
    "registry_active", "registry_resolve", "commands_unregistered", "registry_diff", "dest_table_name",
    "command_parse", "command_rejects", "last_command_per_file", "recovery_set", "queue_depth", "task_ids",
    "load_metrics", "state_summary", "ledger_status", "files_releasable", "ledger_latest", "replay_guard",
    "period_tables_missing", "retention_plan", "file_extension", "tables_needed_now", "registry_validate",
    "ledger_scan_columns", "registry_refresh", "conform_rules", "content_times", "load_fanout",
    # through real loads
    "ledger_compacted", "stream_ledger_poll", "load_orders", "split_rejects", "reject_limit_files", "ledger_after_load",
    "recover_orphans", "load_multiline", "load_continued", "stream_load_orders", "load_orders_rows", "same_batch_twice",
    "replay_after_crash", "recover_after_write", "ledger_poll_replay", "late_registration", "mixed_bad_files", "file_inventory_years",
    "read_before_redo", "two_runs_one_id", "two_poll_streams", "reject_raw_lines", "existing_tables_listed",
    "ledger_incremental", "guard_by_keys", "load_times", "load_metrics_spread", "registry_change_in_stream",
]


def test_contract_keys():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    own = {k for k in q if not k.startswith("op") and k != "pipeline"}
    assert own - set(sql) == {"file_inventory"}  # file_inventory_years is its twin with SQL
    assert all(callable(f) for f in q.values())


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["dest_table", "n", "cents"]
    assert df.count() == 7


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    result = compare(spark, SF, [name])[name]
    assert result[0] == "ok", result
