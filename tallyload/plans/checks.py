"""More registered checks: whole rows through the loader, crashes and repairs, and the rules of single operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.functions.ddl import CORRUPT_COLUMN, declared_schema
from tallyload.functions.naming import normalize_path
from tallyload.functions.timestamps import content_timestamp
from tallyload.operators import command_parse, existing_tables, ledger_latest, ledger_scan, load_metrics, read_target
from tallyload.operators.conform import conform, load_fanout
from tallyload.operators.ledger import (
    claim_step,
    compact_ledger,
    delete_path,
    final_step,
    latest_of,
    latest_snapshot,
    ledger_append,
    ledger_rows,
    read_ledger,
    snapshot_rows,
)
from tallyload.operators.registry import effective_registry
from tallyload.plans import scenario as S
from tallyload.plans.batch import Layout, run_batch
from tallyload.session import scratch_dir
from tallyload.sources.commands import command_scan
from tallyload.sources.datafiles import file_inventory

ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _stage(spark: SparkSession, d: str, name: str, **kw):
    root = scratch_dir(spark, name)
    return root, S.stage_orders(spark, d, root, **kw), Layout(f"{root}/warehouse")


def _lines(spark: SparkSession, cmd_root: str) -> DataFrame:
    return command_scan(spark, cmd_root, name_regex=S.STAGED_COMMAND_REGEX, positions=False)


def _rows(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_target(spark, layout.target("orders"), S.ORDER_COLUMNS).select(*ORDER_FIELDS, "dest_table")


def _tasks(spark: SparkSession, cmd_root: str) -> DataFrame:
    return command_parse(_lines(spark, cmd_root)).withColumn("task_id", F.col("task_key"))


def _by_month(spark: SparkSession) -> DataFrame:
    """The orders registry after its split was changed from years to months."""
    return S.registry_rows(spark, [(S.ORDERS_EVENT_TYPE, "orders", S.ORDER_COLUMNS, "", 2, 1)])


def q_load_orders_rows(spark, d):
    """Every row and column of the load."""
    _, cmds, layout = _stage(spark, d, "orders-rows")
    run_batch(spark, _lines(spark, cmds), S.orders_registry(spark), layout, 0)
    return _rows(spark, layout)


def q_same_batch_twice(spark, d):
    """A batch id used for some of the command files, then for all."""
    _, cmds, layout = _stage(spark, d, "orders-twice", one_file_per_year=True)
    lines = _lines(spark, cmds)
    first = lines.filter(F.pmod(F.xxhash64("cmd_file", "raw"), F.lit(2)) == 0)
    run_batch(spark, first, S.orders_registry(spark), layout, 42)
    run_batch(spark, lines, S.orders_registry(spark), layout, 42)
    return _rows(spark, layout)


def _crash(spark, d, name):
    """A load that stops after its targets are written, before its final ledger rows."""
    _, cmds, layout = _stage(spark, d, name)
    run_batch(spark, _lines(spark, cmds), S.orders_registry(spark), layout, 5)
    delete_path(spark, f"{layout.ledger}/batch_id=5/step={final_step(0)}")
    return cmds, layout


def q_replay_after_crash(spark, d):
    """The crashed batch runs again, with another split."""
    cmds, layout = _crash(spark, d, "orders-replay")
    run_batch(spark, _lines(spark, cmds), _by_month(spark), layout, 5, guard_scope="batch")
    return _rows(spark, layout)


def q_recover_after_write(spark, d):
    """the crashed batch's tasks are redone from the ledger."""
    from tallyload.streaming import recover

    _, layout = _crash(spark, d, "orders-redo")
    recover(spark, layout, S.orders_registry(spark))
    return _rows(spark, layout)


def q_ledger_poll_replay(spark, d):
    """a poll batch that claimed its tasks and crashed is replayed."""
    from tallyload.streaming import LEDGER_POLL_BATCH_BASE, stream_ledger_poll

    root, cmds, layout = _stage(spark, d, "orders-poll-replay")
    tasks = _tasks(spark, cmds)
    ledger_append(ledger_rows(tasks, -1, 0, state=0), layout.ledger)
    ledger_append(ledger_rows(tasks, LEDGER_POLL_BATCH_BASE, claim_step(0), state=1), layout.ledger)
    stream_ledger_poll(spark, layout, lambda: S.orders_registry(spark), f"{root}/checkpoint", available_now=True).awaitTermination()
    return _rows(spark, layout)


def q_read_before_redo(spark, d):
    """Readers between a crash and its redo see none of the attempt's rows; afterwards they see all."""
    from tallyload.operators.attempts import Files, control_root

    cmds, layout = _crash(spark, d, "orders-before-redo")
    Files(spark, control_root(layout.root)).delete("commits/b5.a0")  # the crash came before the commit, too
    seen = _rows(spark, layout).withColumn("after_redo", F.lit(False))
    seen = seen.checkpoint(eager=True)  # read now, not after the redo
    run_batch(spark, _lines(spark, cmds), S.orders_registry(spark), layout, 5)
    return seen.unionByName(_rows(spark, layout).withColumn("after_redo", F.lit(True)))


def _at_once(*jobs) -> None:
    """Run jobs at the same time; the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(j) for j in jobs]:
            done.result()


def q_two_runs_one_id(spark, d):
    """E5: two runs of one batch id at the same time load every file once."""
    _, cmds, layout = _stage(spark, d, "orders-two-runs")
    run = lambda: run_batch(spark, _lines(spark, cmds), S.orders_registry(spark), layout, 9)
    _at_once(run, run)
    return _rows(spark, layout)


def q_two_poll_streams(spark, d):
    """two poll streams on one ledger at the same time load every announced file once."""
    from tallyload.streaming import stream_ledger_poll

    root, cmds, layout = _stage(spark, d, "orders-two-polls")
    ledger_append(ledger_rows(_tasks(spark, cmds), -1, 0, state=0), layout.ledger)
    poll = lambda i: stream_ledger_poll(spark, layout, lambda: S.orders_registry(spark), f"{root}/checkpoint{i}",
                                        available_now=True).awaitTermination()
    _at_once(lambda: poll(0), lambda: poll(1))
    return _rows(spark, layout)


def q_reject_raw_lines(spark, d):
    """The text of a reject is the line of the data file, with its quotes and blanks, whatever rule it broke."""
    root = scratch_dir(spark, "orders-raw")
    o = S.table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    long = F.when(F.col("o_orderkey") % 3 == 0, F.lit('too ""long"" ')).otherwise(F.col("o_orderstatus"))
    line = F.concat(key, F.lit(',"'), long, F.lit('",'), F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 7 == 0, F.lit(' ," more  ')).otherwise(F.lit(" ")))
    o.select(line).write.text(f"{root}/data")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{root}/data").select(
        F.concat(F.lit(f"src,{S.ORDERS_EVENT_TYPE},"), normalize_path(F.col("path"), decode=True), F.lit(",2000-01-01 00:00:00.0,t,60")).alias("raw"))
    S.write_commands(files, f"{root}/cmds")
    layout = Layout(f"{root}/warehouse")
    registry = S.registry_rows(spark, [(S.ORDERS_EVENT_TYPE, "orders", "k bigint, s varchar(3), p string", "", 3, 1)])
    run_batch(spark, _lines(spark, f"{root}/cmds"), registry, layout, 0)
    return spark.read.parquet(layout.rejects).select("raw", "reason")


def q_existing_tables_listed(spark, d):
    """C4: the tables of a load, from folder names and commits alone."""
    _, cmds, layout = _stage(spark, d, "orders-listed")
    run_batch(spark, _lines(spark, cmds), _by_month(spark), layout, 0)
    return existing_tables(spark, layout.target("orders"))


def _ledger_in_batches(spark, d, name):
    """The events' ledger, one batch for each transition, compacted after every batch."""
    root = scratch_dir(spark, name) + "/ledger"
    log = S.events_ledger(spark, d).withColumn("batch_id", F.col("step").cast("bigint"))
    for step in range(3):
        ledger_append(log.filter(F.col("step") == step), root)
        compact_ledger(spark, root)
    return root


def q_ledger_incremental(spark, d):
    """The newest row of every task, merged batch by batch into the buckets that changed."""
    root = _ledger_in_batches(spark, d, "ledger-incremental")
    latest = snapshot_rows(spark, latest_snapshot(spark, root))
    return latest.select(F.col("task_id").alias("id"), F.col("event_type").alias("eventtype"), "state", F.col("data_path").alias("path"), "exec_end")


def q_guard_by_keys(spark, d):
    """Of the tasks of event types 1 to 3, those that the ledger shows as finished, by a lookup of their keys."""
    root = _ledger_in_batches(spark, d, "ledger-guard")
    keys = S.events_ledger(spark, d).filter("event_type <= 3 AND step = 0").select("task_key")
    return latest_of(spark, root, keys).filter(F.col("state") >= 2).select(F.col("task_key").alias("id"), "state")


def q_load_times(spark, d):
    """D3: every file of a load has times of its own, within those of the batch."""
    _, cmds, layout = _stage(spark, d, "orders-times", one_file_per_year=True)
    run_batch(spark, _lines(spark, cmds), S.orders_registry(spark), layout, 0)
    latest = ledger_latest(read_ledger(spark, layout.ledger))
    starts = latest.agg(F.count_distinct("exec_start", "exec_end")).first()[0]  # one scalar
    return latest.select("dest_table", ((F.col("gen_time") <= F.col("exec_start")) & (F.col("exec_start") <= F.col("exec_end"))).alias("in_order"),
                         F.lit(starts > 1).alias("own_times"))


def q_load_metrics_spread(spark, d):
    """D3: mean and 95th percentile of the seconds of a load, by event type."""
    latest = ledger_latest(S.events_ledger(spark, d)).filter(F.col("state") == 3)
    return load_metrics(latest, by=["event_type"]).select(F.col("event_type").alias("eventtype"), "avg_secs", "p95_secs")


def q_registry_change_in_stream(spark, d):
    """the registry changes while a stream runs; each batch goes by the version of its time."""
    from tallyload.streaming import stream_commands, stream_load

    root, cmds, layout = _stage(spark, d, "orders-registry", one_file_per_year=True)
    spark.read.text(cmds).repartitionByRange(3, "value").write.text(f"{root}/spread")
    versions = [_by_month(spark), S.orders_registry(spark)]
    lines = stream_commands(spark, f"{root}/spread", name_regex=S.STAGED_COMMAND_REGEX, max_files_per_trigger=1)
    stream_load(lines, lambda: versions.pop() if len(versions) > 1 else versions[0], layout, f"{root}/checkpoint",
                available_now=True).awaitTermination()
    rows = _rows(spark, layout)
    kinds = rows.agg(F.count_distinct(F.length("dest_table"))).first()[0]  # one scalar: tables by year, and by month
    return rows.select(*ORDER_FIELDS, F.lit(kinds == 2).alias("both_versions"))


def q_late_registration(spark, d):
    """Commands come before their type is registered, and load afterwards."""
    from tallyload.streaming import retry_waiting

    _, cmds, layout = _stage(spark, d, "orders-late")
    run_batch(spark, _lines(spark, cmds), S.documents_registry(spark), layout, 0)
    retry_waiting(spark, layout, S.orders_registry(spark), 1)
    return _rows(spark, layout)


def q_mixed_bad_files(spark, d):
    """One corrupt file among good ones: its task ends in ERROR with a message, the others load."""
    root, cmds, layout = _stage(spark, d, "orders-mixed", one_file_per_year=True)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/data/broken[1].csv.gz")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 1, 2, 3]))  # a gzip header without its data
    out.close()
    more = spark.createDataFrame([(f"src,{S.ORDERS_EVENT_TYPE},{root}/data/broken[1].csv.gz,2000-01-01 00:00:00.0,t,60",)], "raw string")
    more.write.text(f"{root}/more")
    lines = _lines(spark, cmds).unionByName(_lines(spark, f"{root}/more"))
    run_batch(spark, lines, S.orders_registry(spark), layout, 0)
    latest = ledger_latest(read_ledger(spark, layout.ledger))
    tasks = latest.groupBy(F.concat(F.lit("state "), F.col("state").cast("string")).alias("what")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.length("state_info") > 0).alias("told"))
    loaded = _rows(spark, layout).groupBy(F.col("dest_table").alias("what")).agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("told"))
    return tasks.unionByName(loaded)


def q_file_inventory_years(spark, d):
    """One existing and one missing file of each order year."""
    _, cmds, _ = _stage(spark, d, "orders-inventory", one_file_per_year=True)
    paths = command_parse(_lines(spark, cmds)).select("data_path")
    twins = paths.select(F.concat("data_path", F.lit(".missing")).alias("data_path"))
    found = file_inventory(paths.unionByName(twins), "data_path")
    return found.select(F.regexp_extract("path", "order_year=([0-9]+)", 1).cast("int").alias("order_year"), "file_exists",
                        (F.col("data_size") > 0).alias("non_empty"))


def q_conform_rules(spark, d):
    """The rules ``not null`` and ``varchar(n)``, in declaration order."""
    schema = declared_schema("o_orderkey bigint not null, o_orderstatus varchar(1) iq unique (255) not null, o_orderpriority varchar(8) null")
    o = S.table(spark, d, "orders")
    rows = o.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority",
                    F.lit(None).cast("string").alias(CORRUPT_COLUMN))
    return conform(rows, schema).select("o_orderkey", F.col("_reason").alias("reason"))


def q_content_times(spark, d):
    """Fractions as a count of milliseconds, and 12 read as midnight."""
    ev = S.table(spark, d, "events").select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t"))
    return ev.select("event_id", content_timestamp("t").alias("as_millis"),
                     content_timestamp("t", twelve_as_midnight=True, fraction="decimal").alias("noon_as_midnight"))


def q_ledger_scan_columns(spark, d):
    """A2: the ten columns of a scan of successful tasks."""
    return ledger_scan(ledger_latest(S.events_ledger(spark, d)), 3)


def q_load_fanout(spark, d):
    """A file that several tasks name loads once for each."""
    o = S.table(spark, d, "orders")
    path = F.concat(F.lit("/in/"), F.year("o_orderdate").cast("string"), F.lit(".csv"))
    tasks = o.select(path.alias("data_path")).distinct().withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = o.select("o_orderkey", normalize_path(path).alias("_file"))
    return load_fanout(rows, tasks, ["copy"]).select("o_orderkey", "copy")


def q_registry_refresh(spark, d):
    """after a refresh, rows that can be read count; where one cannot, the version in use stays."""
    fresh = S.events_registry(spark, d).withColumn(
        "columns", F.when(F.col("event_type") == 3, F.lit("broken notatype")).otherwise(F.col("columns")))
    got = effective_registry(fresh, S.known_registry(spark, d))
    return got.filter("state = 1").select(F.col("event_type").alias("eventtype"), "partgranularity",
                                          F.col("columns").contains("notatype").alias("broken"))


EXTRA_QUERIES = {name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")}

_FIELDS = ", ".join(ORDER_FIELDS)
_ORDERS = f"select {_FIELDS}, concat('orders_', strftime(o_orderdate, '%Y')) as dest_table from orders"

#: On the prefix of the catalogue's SQL (cfg, reg, cmd).
EXTRA_ON_PREFIX = {
    "load_metrics_spread": "select eventtype, avg(id % 7) as avg_secs, quantile_disc(id % 7, 0.95) as p95_secs from cmd where state = 3 group by eventtype",
    "ledger_incremental": "select k.id, k.eventtype, k.state, k.path, case when k.state >= 2 then k.content_ts + "
    "to_seconds(k.id % 60 + k.id % 7) end as exec_end from cmd k",
    "guard_by_keys": "select id, state from cmd where state >= 2 and eventtype <= 3",
    "ledger_scan_columns": "select k.id as task_id, k.eventtype as event_type, k.content_ts, k.path as data_path, "
    "cast(round(k.value * 100) as bigint) as data_size, 3 as state, k.content_ts as gen_time, "
    "k.content_ts + to_seconds(k.id % 60) as exec_start, k.content_ts + to_seconds(k.id % 60 + k.id % 7) as exec_end, "
    "cast(null as varchar) as dest_table from cmd k where k.state = 3",
    "registry_refresh": "select eventtype, cast(case when eventtype = 3 then 1 else partgranularity end as int) as partgranularity, "
    "false as broken from reg where state = 1",
}

EXTRA_SQL = {
    "load_orders_rows": _ORDERS,
    "same_batch_twice": _ORDERS,
    "recover_after_write": _ORDERS,
    "ledger_poll_replay": _ORDERS,
    "late_registration": _ORDERS,
    "load_times": "select distinct concat('orders_', strftime(o_orderdate, '%Y')) as dest_table, true as in_order, true as own_times from orders",
    "registry_change_in_stream": f"select {_FIELDS}, true as both_versions from orders",
    "read_before_redo": f"select {_FIELDS}, dest_table, true as after_redo from ({_ORDERS}) o",
    "two_runs_one_id": _ORDERS,
    "two_poll_streams": _ORDERS,
    "reject_raw_lines": """with l as (select o_orderkey, concat(o_orderkey, ',"', case when o_orderkey % 3 = 0 then 'too ""long"" '
  else o_orderstatus end, '",', o_orderpriority, case when o_orderkey % 7 = 0 then ' ," more  ' else ' ' end) as raw from orders)
select raw, case when o_orderkey % 7 = 0 then 'malformed' else 'too_long:s' end as reason from l where o_orderkey % 7 = 0 or o_orderkey % 3 = 0""",
    "existing_tables_listed": "select distinct concat('orders_', strftime(o_orderdate, '%Y'), '01') as dest_table from orders",
    "replay_after_crash": f"select {_FIELDS}, concat('orders_', strftime(o_orderdate, '%Y'), '01') as dest_table from orders",
    "mixed_bad_files": "select 'state 3' as what, count(distinct year(o_orderdate)) as n, true as told from orders union all "
    "select 'state 2', 1, true union all "
    "select concat('orders_', strftime(o_orderdate, '%Y')), count(*), true from orders group by 1",
    "file_inventory_years": "select distinct cast(year(o_orderdate) as int) as order_year, x as file_exists, x as non_empty "
    "from orders, (values (true), (false)) v(x)",
    "conform_rules": "select o_orderkey, case when o_orderkey % 5 = 0 then 'null:o_orderstatus' "
    "when length(o_orderpriority) > 8 then 'too_long:o_orderpriority' end as reason from orders",
    "content_times": "select event_id, date_trunc('second', ts) + to_milliseconds(microsecond(ts) % 1000000) as as_millis, "
    "case when hour(ts) = 12 then ts - interval 12 hours else ts end as noon_as_midnight from events",
    "load_fanout": "select o_orderkey, copy from orders, (values (1), (2)) v(copy)",
}
