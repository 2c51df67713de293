"""Attempts, claims and commits: who loads what, and what readers see."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from files import write
from tallyload.operators import ledger_latest, read_target
from tallyload.operators.attempts import Attempt, committed_attempts, committed_names
from tallyload.operators.ledger import final_step, ledger_append, ledger_rows, settled_ledger
from tallyload.operators.targets import attempt_load, existing_tables
from tallyload.plans.batch import Layout, run_batch
from tallyload.sources.commands import command_scan
from tallyload.sources.profiles import PROFILES
from tallyload.streaming import recover, stream_ledger_poll

SCHEMA = "event_type int, base string, columns string, cycle string, partgranularity int, state int"
COLUMNS = "id int, name varchar(3)"


def registry(spark):
    return spark.createDataFrame([(1, "t", COLUMNS, "", 2, 1)], SCHEMA)


def commands(tmp, n, text=lambda i: f"{i},x\n"):
    for i in range(n):
        path = write(f"{tmp}/data/{i}.csv", text(i))
        write(f"{tmp}/cmds/{i}.cmd", f"s,1,{path},2024-{i % 12 + 1:02d}-05 10:00:00.0,t,60\n")


def ids(spark, layout):
    return sorted(r["id"] for r in read_target(spark, layout.target("t"), COLUMNS).collect())


def together(*jobs):
    errors = []

    def guarded(job):
        try:
            job()
        except BaseException as e:  # shown by the test
            errors.append(e)

    threads = [threading.Thread(target=guarded, args=(j,)) for j in jobs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert errors == []


def test_numbers_claims_and_commits_are_exclusive(spark, tmp):
    a, b = Attempt(spark, tmp, 5), Attempt(spark, tmp, 5)
    c = Attempt(spark, tmp, 6)
    assert [x.number for x in (a, b, c)] == [0, 1, 0]
    assert a.rivals() == (0, []) and a.claim(1)
    assert not b.claim(1)
    assert b.rivals() == (1, [(5, 0)]) and b.claim(2)
    a.commit()
    a.close()
    assert c.rivals() == (2, [(5, 0), (5, 1)])  # one that committed since c began, one that runs
    b.close()  # ends without a commit: its claims hold no longer
    assert c.rivals() == (2, [(5, 0)])
    assert committed_names(spark, tmp) == {(5, 0)}
    assert [tuple(r) for r in committed_attempts(spark, tmp).collect()] == [(5, 0)]
    c.close()
    d = Attempt(spark, tmp, 5)
    assert d.number == 2 and d.rivals() == (2, [])  # what ended before it began is in the ledger
    d.close()


def test_a_stale_lease_is_taken_over_and_cannot_commit(spark, tmp):
    ledger = f"{tmp}/ledger"
    old = Attempt(spark, tmp, 1, lease=0.4)
    old._stop.set()  # as if the driver had stalled
    tasks = spark.createDataFrame([(9, 1)], "task_key long, event_type int")
    ledger_append(ledger_rows(tasks, 1, 1, state=1), ledger)
    old.claim(1)
    running = Attempt(spark, tmp, 1)
    assert running.crashed() == []  # its lease is fresh for whoever grants 300 seconds
    time.sleep(0.6)
    new = Attempt(spark, tmp, 1, lease=0.4)
    assert new.crashed() == [0]
    with pytest.raises(RuntimeError):
        old.commit()
    own = Attempt(spark, tmp, 1, owner="me")
    ledger_append(ledger_rows(tasks, 1, 2 * own.number + 1, state=1), ledger)
    assert own.number in Attempt(spark, tmp, 1, owner="me").crashed()  # the same owner needs no waiting
    new.close()
    running.close()


def test_two_runs_of_one_id_load_once(spark, tmp):
    commands(tmp, 8)
    layout, reg = Layout(f"{tmp}/wh"), registry(spark)
    run = lambda: run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 3)
    together(run, run)
    assert ids(spark, layout) == list(range(8))
    run()
    assert ids(spark, layout) == list(range(8))
    assert {r["state"] for r in ledger_latest(settled_ledger(spark, layout.ledger)).collect()} == {3}


def test_two_poll_streams_load_once(spark, tmp):
    commands(tmp, 6)
    layout, reg = Layout(f"{tmp}/wh"), registry(spark)
    tasks = spark.createDataFrame([(i, i, 1, f"{tmp}/data/{i}.csv") for i in range(6)],
                                  "task_key long, task_id long, event_type int, data_path string").withColumn(
        "content_ts", F.lit("2024-01-05 10:00:00").cast("timestamp"))
    ledger_append(ledger_rows(tasks, -1, 0, state=0), layout.ledger)
    together(*[lambda i=i: stream_ledger_poll(spark, layout, lambda: reg, f"{tmp}/ckpt{i}", available_now=True).awaitTermination()
               for i in range(2)])
    assert ids(spark, layout) == list(range(6))


def test_readers_see_nothing_of_an_attempt_until_it_commits(spark, tmp):
    commands(tmp, 2)
    layout, reg = Layout(f"{tmp}/wh"), registry(spark)
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 0)
    # a second attempt wrote rows and final ledger rows, and stopped before its commit
    crashed = Attempt(spark, layout.root, 0)
    crashed._stop.set()
    rows = spark.createDataFrame([(77, "no", 5, "t_202405", "202405")], "id int, name string, ld_task_key long, ld_dest_table string, ld_period string")
    attempt_load(rows, layout.target("t"), 0, crashed.number)
    tasks = spark.createDataFrame([(5, 1, f"{tmp}/data/1.csv")], "task_key long, event_type int, data_path string").withColumn(
        "content_ts", F.lit("2024-05-05 10:00:00").cast("timestamp"))
    ledger_append(ledger_rows(tasks, 0, 2 * crashed.number + 1, state=1), layout.ledger)
    assert crashed.claim(crashed.rivals()[0] + 1)
    ledger_append(ledger_rows(tasks, 0, final_step(crashed.number), state=3), layout.ledger)
    assert ids(spark, layout) == [0, 1]
    assert sorted(r["dest_table"] for r in existing_tables(spark, layout.target("t")).collect()) == ["t_202401", "t_202402"]
    assert {r["task_key"]: r["state"] for r in ledger_latest(settled_ledger(spark, layout.ledger)).collect()}[5] == 1
    recover(spark, layout, reg)
    assert ids(spark, layout) == [0, 1]  # it may still run
    os.utime(f"{layout.root}/control/open/b0.a{crashed.number}", (1, 1))
    recover(spark, layout, reg)
    assert ids(spark, layout) == [0, 1, 1]


def test_refused_files_leave_no_rows_and_raw_lines_are_those_of_the_file(spark, tmp):
    texts = {0: "0,x\n1,abcd\n", 1: '2,x\n"bad" , "a,b\n  3 ,"long, ""er"\n\n4,y\n', 2: "5,z\n"}
    commands(tmp, 3, lambda i: texts[i])
    layout = Layout(f"{tmp}/wh")
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), registry(spark), layout, 0, profile=PROFILES["external"].with_limit(1))
    assert ids(spark, layout) == [0, 5]
    assert sorted(r["dest_table"] for r in existing_tables(spark, layout.target("t")).collect()) == ["t_202401", "t_202403"]
    raw = sorted((os.path.basename(r["data_path"]), r["raw"]) for r in spark.read.parquet(layout.rejects).collect())
    assert raw == [("0.csv", "1,abcd"), ("1.csv", '  3 ,"long, ""er"'), ("1.csv", '"bad" , "a,b')]
    states = {os.path.basename(r["data_path"]): (r["state"], r["state_info"]) for r in ledger_latest(settled_ledger(spark, layout.ledger)).collect()}
    assert states["1.csv"] == (2, "reject limit 1 exceeded: 2 rejected") and states["0.csv"] == (3, "loaded 1 rows, 1 rejected")
