"""The ledger's snapshot: merged bucket by bucket, and looked up by key."""

import os

from pyspark.sql import functions as F

import tallyload.operators.ledger as L
from tallyload.operators import ledger_latest, read_ledger
from tallyload.operators.ledger import compact_ledger, latest_of, latest_snapshot, ledger_append, ledger_rows, snapshot_rows


def append(spark, root, keys, batch, step, state):
    tasks = spark.createDataFrame([(k, 1) for k in keys], "task_key long, event_type int")
    ledger_append(ledger_rows(tasks, batch, step, state=state), root)


def states(df):
    return {r["task_key"]: r["state"] for r in df.collect()}


def generations(root):
    data = f"{root}_snapshots/data"
    return {b: sorted(g for g in os.listdir(f"{data}/{b}") if g.startswith("gen=")) for b in os.listdir(data) if b.startswith("key_bucket=")}


def test_only_changed_buckets_are_written_again(spark, tmp, monkeypatch):
    monkeypatch.setattr(L, "_BUCKET_ROWS", 50)
    monkeypatch.setattr(L, "_BUCKET_MOST", 200)
    root = f"{tmp}/ledger"
    append(spark, root, range(1000), 0, 1, 1)
    compact_ledger(spark, root)
    first = generations(root)
    assert len(first) >= 16 and {tuple(g) for g in first.values()} == {("gen=0",)}
    append(spark, root, [3, 4], 1, 2, 3)
    compact_ledger(spark, root)
    changed = [b for b, g in generations(root).items() if "gen=1" in g]
    assert 1 <= len(changed) <= 2  # not the buckets of other tasks
    want = {k: 3 if k in (3, 4) else 1 for k in range(1000)}
    assert states(snapshot_rows(spark, latest_snapshot(spark, root))) == want
    assert states(ledger_latest(read_ledger(spark, root))) == want
    # growth deals the buckets anew; retiring leaves the files in use
    append(spark, root, range(1000, 8000), 2, 1, 1)
    compact_ledger(spark, root, retire=True)
    append(spark, root, [5, 7999], 3, 2, 2)
    compact_ledger(spark, root, retire=True)
    want |= {k: 1 for k in range(1000, 8000)} | {5: 2, 7999: 2}
    assert states(ledger_latest(read_ledger(spark, root))) == want
    assert len(generations(root)) >= 128


def bytes_read(spark, df):
    """Files that a query's scans select, by their plan after it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_lookups_prune_buckets_and_see_the_tail(spark, tmp, monkeypatch):
    monkeypatch.setattr(L, "_BUCKET_ROWS", 50)
    monkeypatch.setattr(L, "_BUCKET_MOST", 200)
    root = f"{tmp}/ledger"
    keys = spark.createDataFrame([(7,), (8,), (99999,)], "task_key long")
    assert latest_of(spark, root, keys).collect() == []  # no ledger yet
    append(spark, root, range(2000), 0, 1, 1)
    assert states(latest_of(spark, root, keys)) == {7: 1, 8: 1}
    compact_ledger(spark, root)
    append(spark, root, [8], 1, 2, 3)
    found = latest_of(spark, root, keys)
    assert states(found) == {7: 1, 8: 3}
    assert "dynamicpruning" in bytes_read(spark, found)
    assert states(latest_of(spark, root, keys.limit(0))) == {}
    # duplicates among the keys and repeated transitions change nothing
    append(spark, root, [8], 1, 2, 3)
    assert states(latest_of(spark, root, keys.union(keys))) == {7: 1, 8: 3}
