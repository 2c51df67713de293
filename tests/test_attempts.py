"""Attempts of a batch id, recovery, waiting tasks, compaction and file failures."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from files import write
from tallyload.functions.ddl import declared_schema
from tallyload.functions.timestamps import content_timestamp
from tallyload.operators import ledger_latest, read_ledger, read_target
from tallyload.operators.commands import classify_commands
from tallyload.operators.ledger import claim_step, compact_ledger, ledger_append, ledger_rows
from tallyload.operators.targets import append_load, existing_tables
from tallyload.plans.batch import Layout, run_batch
from tallyload.sources.commands import command_scan
from tallyload.streaming import LEDGER_POLL_BATCH_BASE, orphaned_tasks, recover, retry_waiting, stream_ledger_poll

SCHEMA = "event_type int, base string, columns string, cycle string, partgranularity int, state int"


def registry(spark, columns="id int, period string", split=2, event_type=1):
    return spark.createDataFrame([(event_type, "t", columns, "", split, 1)], SCHEMA)


def command(tmp, name, path, event_type=1):
    write(f"{tmp}/cmds/{name}.cmd", f"s,{event_type},{path},2024-01-05 10:00:00.0,t,60\n")


def rows(spark, layout):
    return sorted((r["id"], r["ld_period"]) for r in read_target(spark, layout.target("t")).collect())


def states(spark, layout):
    return {os.path.basename(r["data_path"]): (r["state"], r["state_info"]) for r in ledger_latest(read_ledger(spark, layout.ledger)).collect()}


def test_an_id_used_again_adds_rows_and_a_column_may_be_called_period(spark, tmp):
    layout, reg = Layout(f"{tmp}/wh"), registry(spark)
    command(tmp, "1", write(f"{tmp}/data/a.csv", "1,x\n2,y\n"))
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 42)
    command(tmp, "2", write(f"{tmp}/data/b.csv", "3,x\n4,y\n"))
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 42)
    assert rows(spark, layout) == [(i, "202401") for i in (1, 2, 3, 4)]
    assert sorted(r["period"] for r in read_target(spark, layout.target("t")).collect()) == ["x", "x", "y", "y"]
    assert {k: v[0] for k, v in states(spark, layout).items()} == {"a.csv": 3, "b.csv": 3}
    assert [r["dest_table"] for r in existing_tables(spark, layout.target("t")).collect()] == ["t_202401"]


def crash_after_write(spark, tmp, layout, reg, batch_id):
    """Claims and target rows of an attempt that never wrote its final rows."""
    cmds = classify_commands(command_scan(spark, f"{tmp}/cmds")).withColumn("task_id", F.col("task_key"))
    ledger_append(ledger_rows(cmds, batch_id, claim_step(0), state=1), layout.ledger)
    left = spark.createDataFrame([(1, "x"), (2, "y")], "id int, period string").select(
        "*", F.lit(1).cast("long").alias("ld_task_key"), F.lit("t_2023").alias("ld_dest_table"), F.lit("2023").alias("ld_period"),
        F.lit(batch_id).cast("long").alias("ld_batch_id"), F.lit(0).alias("ld_attempt"))
    append_load(left, layout.target("t"))


def test_replay_and_recover_after_a_crash_load_once(spark, tmp):
    command(tmp, "1", write(f"{tmp}/data/a.csv", "1,x\n2,y\n"))
    for i, redo in enumerate(("replay", "recover")):
        layout, reg = Layout(f"{tmp}/wh{i}"), registry(spark)  # the split is not the crashed attempt's
        crash_after_write(spark, tmp, layout, reg, 5)
        assert orphaned_tasks(spark, layout).count() == 1
        if redo == "replay":
            run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 5, guard_scope="batch")
        else:
            recover(spark, layout, reg)
        assert rows(spark, layout) == [(1, "202401"), (2, "202401")]
        assert orphaned_tasks(spark, layout).count() == 0


def test_poll_batch_replayed_after_its_claim_loads(spark, tmp):
    layout, reg = Layout(f"{tmp}/wh"), registry(spark)
    path = write(f"{tmp}/data/a.csv", "1,x\n2,y\n")
    tasks = spark.createDataFrame([(9, 9, 1, path)], "task_key long, task_id long, event_type int, data_path string").withColumn(
        "content_ts", F.lit("2024-01-05 10:00:00").cast("timestamp"))
    ledger_append(ledger_rows(tasks, -1, 0, state=0), layout.ledger)
    # the first micro-batch claimed the task and crashed
    ledger_append(ledger_rows(tasks, LEDGER_POLL_BATCH_BASE, claim_step(0), state=1), layout.ledger)
    stream_ledger_poll(spark, layout, lambda: reg, f"{tmp}/ckpt", available_now=True).awaitTermination()
    assert rows(spark, layout) == [(1, "202401"), (2, "202401")]
    assert states(spark, layout)["a.csv"][0] == 3


def test_unregistered_tasks_wait_and_load_once_registered(spark, tmp):
    layout = Layout(f"{tmp}/wh")
    command(tmp, "1", write(f"{tmp}/data/a.csv", "1,x\n"))
    command(tmp, "2", write(f"{tmp}/data/b.csv", "2,x\n"), event_type=2)
    other = registry(spark, event_type=7)
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), other, layout, 0)
    assert {v[0] for v in states(spark, layout).values()} == {0}
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), registry(spark), layout, 1)
    assert rows(spark, layout) == [(1, "202401")]
    retry_waiting(spark, layout, registry(spark, event_type=2), 2)
    assert rows(spark, layout) == [(1, "202401"), (2, "202401")]
    retry_waiting(spark, layout, registry(spark, event_type=2), 3)
    assert rows(spark, layout) == [(1, "202401"), (2, "202401")]


def test_a_broken_file_fails_alone_and_odd_names_load(spark, tmp):
    layout, reg = Layout(f"{tmp}/wh"), registry(spark)
    command(tmp, "1", write(f"{tmp}/data/a[1].csv", "1,x\n"))
    command(tmp, "2", write(f"{tmp}/data/a1.csv", "2,x\n"))
    command(tmp, "3", write(f"{tmp}/data/_hidden.csv", "3,x\n"))
    broken = f"{tmp}/data/broken.csv.gz"
    with open(broken, "wb") as f:
        f.write(gzip.compress(b"4,x\n" * 5000)[:40])
    command(tmp, "4", broken)
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 0)
    assert rows(spark, layout) == [(1, "202401"), (2, "202401")]
    got = states(spark, layout)
    assert got["a[1].csv"][0] == got["a1.csv"][0] == 3
    assert got["_hidden.csv"] == (2, "data file has a hidden name (leading _ or .)")
    assert got["broken.csv.gz"][0] == 2 and len(got["broken.csv.gz"][1]) > 20


def test_task_keys_do_not_depend_on_splits(spark, tmp):
    lines = "".join(f"s,1,/d/{i % 500}.csv,2024-01-05 10:00:00.0,t,60\n" for i in range(4000))
    write(f"{tmp}/cmds/1.cmd", lines)

    def keys(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            return sorted(r["task_key"] for r in classify_commands(command_scan(spark, f"{tmp}/cmds")).collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    small, large = keys("16k"), keys("128m")
    assert small == large and len(set(small)) == 4000


@pytest.mark.parametrize("retire", [False, True])
def test_compaction_keeps_rows_of_any_batch_id(spark, tmp, retire):
    root = f"{tmp}/ledger"
    tasks = spark.createDataFrame([(k, 1) for k in range(6)], "task_key long, event_type int")
    one = lambda k: tasks.filter(F.col("task_key") == k)
    ledger_append(ledger_rows(one(0), 3, 1, state=1), root)
    ledger_append(ledger_rows(one(1), LEDGER_POLL_BATCH_BASE, 1, state=1), root)
    compact_ledger(spark, root, retire=retire)
    ledger_append(ledger_rows(one(2), 4, 1, state=1), root)
    ledger_append(ledger_rows(one(3), -1, 0, state=0), root)
    ledger_append(ledger_rows(one(0), 3, 2, state=3), root)
    compact_ledger(spark, root, retire=retire)
    ledger_append(ledger_rows(one(4), -1, 0, state=0), root)
    got = {r["task_key"]: r["state"] for r in ledger_latest(read_ledger(spark, root)).collect()}
    assert got == {0: 3, 1: 1, 2: 1, 3: 0, 4: 0}
    assert {r["task_key"] for r in read_ledger(spark, root, -1).collect()} == {3, 4}
    assert [r["state"] for r in ledger_latest(read_ledger(spark, root, 3)).collect()] == [3]


def test_content_times_keep_the_announced_hour_across_clock_changes(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2024-03-31 23:30:00.0", "2024-10-27 12:15:00.0", "2024-02-30 25:00:00.5", "2024-01-01 00:00:00." + "0" * 13]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r["x"] for r in df.select(content_timestamp("t").cast("string").alias("x")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-31 23:30:00", "2024-10-27 12:15:00", "2024-03-02 01:00:00.005", "2024-01-01 00:00:00"]


def test_column_lists_keep_names_and_drop_constraint_text():
    s = declared_schema("number int, tinyint tinyint, a varchar2(20) iq unique (255) null, b number(10, 2) not null, c datetime default 0")
    assert [(f.name, f.dataType.simpleString()) for f in s.read.fields] == [
        ("number", "int"), ("tinyint", "smallint"), ("a", "string"), ("b", "decimal(10,2)"), ("c", "timestamp")]
    assert [(r.column, r.kind, r.limit) for r in s.rules] == [("a", "max_length", 20), ("b", "not_null", None)]
