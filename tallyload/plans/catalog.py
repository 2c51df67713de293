"""Registered checks: each SURVEY §2 operator as a Spark query over the driver
tables, with the equivalent DuckDB SQL where one exists.

The Spark side always goes through the library's operators; the SQL side
computes the same answer straight from the source tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.functions.naming import file_extension
from tallyload.operators import (
    assign_task_ids,
    compact_ledger,
    command_parse,
    command_rejects,
    commands_unregistered,
    decode_states,
    files_releasable,
    last_command_per_file,
    ledger_latest,
    ledger_scan,
    load_metrics,
    period_tables_missing,
    queue_depth,
    read_target,
    registry_active,
    registry_diff,
    registry_resolve,
    registry_validate,
    replay_guard,
    retention_plan,
    state_summary,
    tables_needed_now,
)
from tallyload.operators.ledger import ledger_append, ledger_rows, read_ledger
from tallyload.plans import scenario as S
from tallyload.plans.batch import Layout, run_batch
from tallyload.plans.checks import EXTRA_ON_PREFIX, EXTRA_QUERIES, EXTRA_SQL
from tallyload.session import scratch_dir
from tallyload.sources.commands import command_scan
from tallyload.sources.datafiles import file_inventory
from tallyload.sources.profiles import PROFILES

Query = Callable[[SparkSession, str], DataFrame]


def _parsed(spark, d, malformed=False):
    return command_parse(S.events_command_lines(spark, d, malformed), fraction="decimal")


def _latest(spark, d):
    return ledger_latest(S.events_ledger(spark, d))


def _id():
    return F.col("source_id").cast("bigint").alias("id")


def q_registry_active(spark, d):
    return registry_active(S.events_registry(spark, d)).select(
        F.col("event_type").alias("eventtype"), "base", "cycle", "split_mode"
    )


def q_registry_resolve(spark, d):
    r = registry_resolve(_parsed(spark, d), S.events_registry(spark, d))
    return r.select(_id(), F.col("event_type").alias("eventtype"), "base")


def q_commands_unregistered(spark, d):
    r = commands_unregistered(_parsed(spark, d), S.events_registry(spark, d))
    return r.select(_id(), F.col("event_type").alias("eventtype"))


def q_registry_diff(spark, d):
    r = registry_diff(S.events_registry(spark, d), S.known_registry(spark, d))
    return r.select(F.col("event_type").alias("eventtype"), "change")


def q_dest_table_name(spark, d):
    return registry_resolve(_parsed(spark, d), S.events_registry(spark, d)).select(_id(), "dest_table")


def q_command_parse(spark, d):
    return _parsed(spark, d, malformed=True).groupBy(F.col("event_type").alias("eventtype")).agg(
        F.count(F.lit(1)).alias("n"), F.min("content_ts").alias("first_ts"), F.max("content_ts").alias("last_ts")
    )


def q_command_rejects(spark, d):
    r = command_rejects(S.events_command_lines(spark, d, malformed=True), fraction="decimal")
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_last_command_per_file(spark, d):
    return last_command_per_file(_parsed(spark, d)).select(F.col("data_path").alias("path"), _id())


def q_recovery_set(spark, d):
    return ledger_scan(_latest(spark, d), 1, ["task_id", "event_type", "data_path"]).select(
        F.col("task_id").alias("id"), F.col("event_type").alias("eventtype"), F.col("data_path").alias("path")
    )


def q_queue_depth(spark, d):
    waiting = _latest(spark, d).filter(F.col("state") == 0).drop("dest_table")
    return queue_depth(registry_resolve(waiting, S.events_registry(spark, d))).select(
        "dest_table", "tasks", "oldest", "bytes"
    )


def q_task_ids(spark, d):
    latest = _latest(spark, d)
    pending = latest.filter(F.col("state") == 0).select(F.col("task_id").alias("src"), "content_ts")
    start = latest.filter(F.col("state") == 3).agg(F.max("task_id"))
    return assign_task_ids(pending, ["content_ts", "src"], start).select("src", "task_id")


def q_load_metrics(spark, d):
    m = load_metrics(_latest(spark, d).filter(F.col("state") == 3), by=["event_type"])
    return m.select(F.col("event_type").alias("eventtype"), "loads", "bytes", "secs", "max_secs")


def q_state_summary(spark, d):
    s = state_summary(_latest(spark, d), by=["event_type"])
    return s.select(F.col("event_type").alias("eventtype"), "state", "state_name", "tasks")


def q_ledger_status(spark, d):
    return decode_states(_latest(spark, d)).select(F.col("task_id").alias("id"), "state_name", "state_info")


def q_files_releasable(spark, d):
    return files_releasable(_latest(spark, d)).select(F.col("data_path").alias("path"), "refs")


def q_ledger_latest(spark, d):
    per_file = ledger_latest(_latest(spark, d), key="data_path", order=["content_ts", "task_id"])
    return per_file.select(F.col("data_path").alias("path"), "state", F.col("task_id").alias("id"))


def q_replay_guard(spark, d):
    latest = _latest(spark, d)
    open_ = latest.filter(F.col("state").isin(0, 1))
    done = latest.filter(F.col("state") == 3)
    return replay_guard(open_, done, "data_path", order_col="task_id").select(F.col("task_id").alias("id"))


def q_period_tables_missing(spark, d):
    reg = S.events_registry(spark, d)
    latest = _latest(spark, d).drop("dest_table")
    needed = registry_resolve(latest, reg)
    existing = registry_resolve(
        latest.filter((F.col("state") == 3) & (F.col("content_ts") < F.lit("2024-01-20 00:00:00").cast("timestamp"))),
        reg,
    )
    return period_tables_missing(needed, existing)


def q_retention_plan(spark, d):
    return retention_plan(_latest(spark, d), success_policy="delete", failure_policy="none")


def q_file_extension(spark, d):
    return S.table(spark, d, "pages").select("page_id", file_extension("url").alias("extension"))


def q_tables_needed_now(spark, d):
    last = S.table(spark, d, "events").agg(F.max("ts")).first()[0]  # one scalar: "now" = last event
    return tables_needed_now(S.events_registry(spark, d), now=last).select(
        F.col("event_type").alias("eventtype"), "dest_table"
    )


def q_registry_validate(spark, d):
    return registry_validate(S.events_registry(spark, d)).select(F.col("event_type").alias("eventtype"), "valid")


def q_ledger_compacted(spark, d):
    """E4 + E6 through real writes: the event ledger written as three batches
    (one per transition), compacted up to batch 1, read back."""
    root = scratch_dir(spark, "ledger") + "/ledger"
    log = S.events_ledger(spark, d).withColumn("batch_id", F.col("step").cast("bigint"))
    ledger_append(log, root)
    compact_ledger(spark, root, 1)
    latest = ledger_latest(read_ledger(spark, root))
    return latest.select(F.col("task_id").alias("id"), "state")


def q_stream_ledger_poll(spark, d):
    """NEW rows put in the ledger by another system are claimed and loaded."""
    from tallyload.streaming import stream_ledger_poll

    root = scratch_dir(spark, "orders-poll")
    cmd_root = S.stage_orders(spark, d, root)
    layout = Layout(f"{root}/warehouse")
    cmds = command_parse(command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False))
    new = cmds.withColumn("task_id", F.col("task_key")).withColumn(
        "dest_table", F.concat(F.lit("orders_"), F.date_format("content_ts", "yyyy"))
    )
    ledger_append(ledger_rows(new, -1, 0, state=0), layout.ledger)
    q = stream_ledger_poll(spark, layout, lambda: S.orders_registry(spark), f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    return _orders_totals(read_target(spark, layout.target("orders")))


def _load_orders_root(spark, d, corrupt=False, profile="quoted"):
    root = scratch_dir(spark, "orders")
    cmd_root = S.stage_orders(spark, d, root, corrupt=corrupt)
    layout = Layout(f"{root}/warehouse")
    lines = command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False)
    run_batch(spark, lines, S.orders_registry(spark), layout, batch_id=0, profile=profile)
    return layout


def _orders_totals(targets: DataFrame) -> DataFrame:
    return targets.groupBy("dest_table").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("bigint").alias("cents")
    )


def q_load_orders(spark, d):
    layout = _load_orders_root(spark, d)
    return _orders_totals(read_target(spark, layout.target("orders")))


def q_split_rejects(spark, d):
    layout = _load_orders_root(spark, d, corrupt=True, profile="external")
    good = read_target(spark, layout.target("orders")).groupBy(F.col("period").cast("int").alias("y")).agg(
        F.count(F.lit(1)).alias("good")
    )
    bad = spark.read.parquet(layout.rejects).groupBy(
        F.substring_index("dest_table", "_", -1).cast("int").alias("y")
    ).agg(F.count(F.lit(1)).alias("bad"))
    j = good.join(bad, "y", "full_outer")
    return j.select("y", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))


# reject limit of the D6 check: with one file per year some years stay
# within it and some do not
ORDERS_REJECT_LIMIT = 22


def q_reject_limit_files(spark, d):
    """D6 end to end: a file over the reject limit is ERROR and loads nothing."""
    root = scratch_dir(spark, "orders-limit")
    cmd_root = S.stage_orders(spark, d, root, corrupt=True, one_file_per_year=True)
    layout = Layout(f"{root}/warehouse")
    lines = command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False)
    run_batch(spark, lines, S.orders_registry(spark), layout, batch_id=0,
              profile=PROFILES["external"].with_limit(ORDERS_REJECT_LIMIT))
    year = F.substring_index("dest_table", "_", -1).cast("int").alias("y")
    states = ledger_latest(read_ledger(spark, layout.ledger)).select(year, "state")
    loaded = read_target(spark, layout.target("orders"), S.ORDER_COLUMNS).groupBy(year).agg(
        F.count(F.lit(1)).alias("loaded"))
    rejected = spark.read.parquet(layout.rejects).groupBy(year).agg(F.count(F.lit(1)).alias("rejected"))
    j = states.join(loaded, "y", "left").join(rejected, "y", "left")
    return j.select("y", F.coalesce("loaded", F.lit(0)).alias("loaded"),
                    F.coalesce("rejected", F.lit(0)).alias("rejected"), "state")


def q_ledger_after_load(spark, d):
    """E4 + E5: the ledger's final row for every loaded file (one per year)."""
    root = scratch_dir(spark, "orders-ledger")
    cmd_root = S.stage_orders(spark, d, root, one_file_per_year=True)
    layout = Layout(f"{root}/warehouse")
    lines = command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False)
    run_batch(spark, lines, S.orders_registry(spark), layout, batch_id=0)
    latest = decode_states(ledger_latest(read_ledger(spark, layout.ledger)))
    return latest.select("dest_table", "state", "state_name", "state_info")


def q_recover_orphans(spark, d):
    """tasks claimed by a batch that crashed are redone by ``recover``."""
    from tallyload.streaming import recover

    root = scratch_dir(spark, "orders-recover")
    cmd_root = S.stage_orders(spark, d, root)
    layout = Layout(f"{root}/warehouse")
    cmds = command_parse(command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False))
    claimed = cmds.withColumn("task_id", F.col("task_key"))
    ledger_append(ledger_rows(claimed, 0, 1, state=1), layout.ledger)  # claimed, then the crash
    recover(spark, layout, S.orders_registry(spark))
    return _orders_totals(read_target(spark, layout.target("orders")))


def _load_documents(spark, d, profile):
    root = scratch_dir(spark, "documents")
    cmd_root = S.stage_documents(spark, d, root)
    layout = Layout(f"{root}/warehouse")
    lines = command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False)
    run_batch(spark, lines, S.documents_registry(spark), layout, batch_id=0, profile=profile)
    return read_target(spark, layout.target("documents"))


def q_load_multiline(spark, d):
    return _load_documents(spark, d, "multiline").select("doc_id", F.md5("text").alias("h"))


def q_load_continued(spark, d):
    return _load_documents(spark, d, "continued").select("doc_id", F.md5("text").alias("h"))


def q_stream_load_orders(spark, d):
    from tallyload.streaming import stream_commands, stream_load

    root = scratch_dir(spark, "orders-stream")
    cmd_root = S.stage_orders(spark, d, root)
    layout = Layout(f"{root}/warehouse")
    lines = stream_commands(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, max_files_per_trigger=2)
    q = stream_load(lines, lambda: S.orders_registry(spark), layout, f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    return _orders_totals(read_target(spark, layout.target("orders")))


def q_file_inventory(spark, d):
    root = scratch_dir(spark, "inventory")
    cmd_root = S.stage_orders(spark, d, root)
    parsed = command_parse(command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False))
    announced = parsed.select("data_path").unionByName(
        parsed.select(F.concat("data_path", F.lit(".missing")).alias("data_path"))
    )
    return file_inventory(announced, "data_path").select(
        "path", "file_exists", (F.col("data_size") > 0).alias("non_empty")
    )


QUERIES: dict[str, Query] = {
    "registry_active": q_registry_active,
    "registry_resolve": q_registry_resolve,
    "commands_unregistered": q_commands_unregistered,
    "registry_diff": q_registry_diff,
    "dest_table_name": q_dest_table_name,
    "command_parse": q_command_parse,
    "command_rejects": q_command_rejects,
    "last_command_per_file": q_last_command_per_file,
    "recovery_set": q_recovery_set,
    "queue_depth": q_queue_depth,
    "task_ids": q_task_ids,
    "load_metrics": q_load_metrics,
    "state_summary": q_state_summary,
    "ledger_status": q_ledger_status,
    "files_releasable": q_files_releasable,
    "ledger_latest": q_ledger_latest,
    "replay_guard": q_replay_guard,
    "period_tables_missing": q_period_tables_missing,
    "retention_plan": q_retention_plan,
    "file_extension": q_file_extension,
    "load_orders": q_load_orders,
    "split_rejects": q_split_rejects,
    "load_multiline": q_load_multiline,
    "load_continued": q_load_continued,
    "stream_load_orders": q_stream_load_orders,
    "file_inventory": q_file_inventory,
    "tables_needed_now": q_tables_needed_now,
    "registry_validate": q_registry_validate,
    "ledger_compacted": q_ledger_compacted,
    "stream_ledger_poll": q_stream_ledger_poll,
    "reject_limit_files": q_reject_limit_files,
    "recover_orphans": q_recover_orphans,
    "ledger_after_load": q_ledger_after_load,
}

# ---------------------------------------------------------------- oracle SQL

_PREFIX = """with cfg as (select event_type, cast(dense_rank() over (order by event_type) as int) as eventtype
             from (select distinct event_type from events) d),
reg as (select eventtype, event_type as base,
               case when eventtype % 3 = 0 then '0' when eventtype % 3 = 1 then '60' else '' end as cycle,
               cast(eventtype % 5 as int) as partgranularity,
               case when eventtype = 2 then 0 else 1 end as state from cfg),
cmd as (select e.event_id as id, c.eventtype, e.ts as content_ts,
               concat('/in/', e.event_type, '/', cast(e.user_id as varchar), '.csv') as path,
               e.value, cast(e.event_id % 4 as int) as state
        from events e join cfg c on e.event_type = c.event_type)
"""

_DEST = """concat(r.base, case when r.cycle in ('','0') then '' else '_' || r.cycle end,
  case r.partgranularity when 1 then '_' || strftime(k.content_ts,'%Y%m%d')
                         when 2 then '_' || strftime(k.content_ts,'%Y%m')
                         when 3 then '_' || strftime(k.content_ts,'%Y') else '' end)"""

_SPLIT = "case partgranularity when 1 then 'DAY' when 2 then 'MONTH' when 3 then 'YEAR' else 'NONE' end"
_STATE_NAME = "case state when 0 then 'NEW' when 1 then 'OPERATING' when 2 then 'ERROR' else 'SUCCESSFUL' end"
_STATE_INFO = (
    "case state when 0 then 'new task' when 1 then 'task operation in progress' "
    "when 2 then 'task exec error' else 'task exec sussessful' end"
)
_CENTS = "cast(sum(cast(round({x}*100) as bigint)) as bigint)"

_ON_PREFIX = {
    "registry_active": f"select eventtype, base, cycle, {_SPLIT} as split_mode from reg where state = 1",
    "registry_resolve": "select k.id, k.eventtype, r.base from cmd k join reg r on k.eventtype = r.eventtype and r.state = 1",
    "commands_unregistered": "select k.id, k.eventtype from cmd k where not exists "
    "(select 1 from reg r where r.eventtype = k.eventtype and r.state = 1)",
    "registry_diff": "select coalesce(n.eventtype, o.eventtype) as eventtype, case when o.eventtype is null then 'new' "
    "when n.eventtype is null then 'disabled' when o.cycle is distinct from n.cycle or o.split is distinct from n.split "
    "then 'changed' else 'unchanged' end as change from "
    f"(select eventtype, cycle, {_SPLIT} as split from reg where state = 1) n full outer join "
    "(select eventtype, cycle, case when eventtype = 3 then 'DAY' else "
    f"{_SPLIT} end as split from reg where eventtype <> 5) o on n.eventtype = o.eventtype",
    "dest_table_name": f"select k.id, {_DEST} as dest_table from cmd k join reg r on k.eventtype = r.eventtype where r.state = 1",
    "command_parse": "select c.eventtype, count(*) as n, min(e.ts) as first_ts, max(e.ts) as last_ts "
    "from events e join cfg c on e.event_type = c.event_type where e.event_id % 11 not in (0, 1, 2) group by c.eventtype",
    "command_rejects": "select case e.event_id % 11 when 0 then 'bad_field_count' when 1 then 'bad_event_type' "
    "else 'bad_timestamp' end as reason, count(*) as n from events e where e.event_id % 11 in (0, 1, 2) group by 1",
    "last_command_per_file": "select path, id from (select path, id, row_number() over "
    "(partition by path order by id desc) rn from cmd) x where rn = 1",
    "recovery_set": "select id, eventtype, path from cmd where state = 1",
    "queue_depth": f"select {_DEST} as dest_table, count(*) as tasks, min(k.content_ts) as oldest, "
    f"{_CENTS.format(x='k.value')} as bytes from cmd k join reg r on k.eventtype = r.eventtype "
    "where r.state = 1 and k.state = 0 group by 1",
    "task_ids": "select k.id as src, row_number() over (order by k.content_ts, k.id) + "
    "(select coalesce(max(id), 0) from cmd where state = 3) as task_id from cmd k where k.state = 0",
    "load_metrics": f"select eventtype, count(*) as loads, {_CENTS.format(x='value')} as bytes, "
    "cast(sum(id % 7) as bigint) as secs, cast(max(id % 7) as bigint) as max_secs from cmd where state = 3 group by eventtype",
    "state_summary": f"select eventtype, state, {_STATE_NAME} as state_name, count(*) as tasks from cmd group by eventtype, state",
    "ledger_status": f"select id, {_STATE_NAME} as state_name, {_STATE_INFO} as state_info from cmd",
    "files_releasable": "select path, count(*) as refs from cmd group by path "
    "having sum(case when state in (2, 3) then 0 else 1 end) = 0",
    "ledger_latest": "select path, state, id from (select path, state, id, row_number() over "
    "(partition by path order by content_ts desc, id desc) as rn from cmd) x where rn = 1",
    "replay_guard": "select k.id from cmd k where k.state in (0, 1) and not exists "
    "(select 1 from cmd d where d.path = k.path and d.state = 3 and d.id > k.id)",
    "period_tables_missing": f"select distinct {_DEST} as dest_table from cmd k join reg r on k.eventtype = r.eventtype "
    f"where r.state = 1 except select distinct {_DEST} as dest_table from cmd k join reg r on k.eventtype = r.eventtype "
    "where r.state = 1 and k.state = 3 and k.content_ts < timestamp '2024-01-20 00:00:00'",
    "tables_needed_now": "select r.eventtype, "
    + _DEST.replace("k.content_ts", "(select max(ts) from events)")
    + " as dest_table from reg r where r.state = 1",
    "registry_validate": "select eventtype, true as valid from reg where state = 1",
    "ledger_compacted": "select id, state from cmd",
    "retention_plan": "select path, case when sum(case when state in (0, 1) then 1 else 0 end) = 0 "
    "and sum(case when state = 3 then 0 else 1 end) = 0 then 'delete' else 'keep' end as action, "
    "case when sum(case when state in (0, 1) then 1 else 0 end) > 0 then 'in_use' "
    "when sum(case when state = 3 then 0 else 1 end) = 0 then 'released' else 'policy_keep' end as reason "
    "from cmd group by path",
}

_ORDERS_TOTALS = (
    "select concat('orders_', strftime(o_orderdate, '%Y')) as dest_table, count(*) as n, "
    f"{_CENTS.format(x='o_totalprice')} as cents from orders group by 1"
)

QUERIES.update(EXTRA_QUERIES)
ORACLE_SQL: dict[str, str] = {k: _PREFIX + v for k, v in (_ON_PREFIX | EXTRA_ON_PREFIX).items()} | EXTRA_SQL
ORACLE_SQL.update(
    {
        "file_extension": r"select page_id, regexp_extract(url, '\.([^.]+)$', 1) as extension from pages",
        "load_orders": _ORDERS_TOTALS,
        "stream_load_orders": _ORDERS_TOTALS,
        "stream_ledger_poll": _ORDERS_TOTALS,
        "recover_orphans": _ORDERS_TOTALS,
        "ledger_after_load": "select concat('orders_', strftime(o_orderdate, '%Y')) as dest_table, 3 as state, "
        "'SUCCESSFUL' as state_name, concat('loaded ', cast(count(*) as varchar), ' rows, 0 rejected') as state_info "
        "from orders group by 1",
        "reject_limit_files": "with b as (select cast(year(o_orderdate) as int) as y, "
        "count(*) filter (where o_orderkey % 97 <> 0) as good, count(*) filter (where o_orderkey % 97 = 0) as bad "
        f"from orders group by 1) select y, case when bad <= {ORDERS_REJECT_LIMIT} then good else 0 end as loaded, "
        f"bad as rejected, case when bad <= {ORDERS_REJECT_LIMIT} then 3 else 2 end as state from b",
        "split_rejects": "select cast(year(o_orderdate) as int) as y, count(*) filter (where o_orderkey % 97 <> 0) "
        "as good, count(*) filter (where o_orderkey % 97 = 0) as bad from orders group by 1",
        "load_multiline": "select doc_id, md5(text) as h from documents",
        # a line that ends in the quote character ends the record: such a text is cut there, and its pieces are rejects
        "load_continued": "select doc_id, md5(replace(text, chr(10), '')) as h from documents "
        r"where not regexp_matches(text, '\" *\n')",
    }
)
