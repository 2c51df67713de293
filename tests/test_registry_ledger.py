import datetime as dt

from pyspark.sql import functions as F

from tallyload.functions.states import STATE_DEFAULT_INFO
from tallyload.operators import (
    assign_task_ids,
    commands_unregistered,
    decode_states,
    files_releasable,
    ledger_latest,
    registry_diff,
    registry_resolve,
    retention_plan,
)
from tallyload.operators.registry import REGISTRY_SCHEMA

REG = [
    (1, "click", "a int", "60", 1, 1),
    (2, "error", "a int", "", 2, 0),
    (3, "purchase", "a int", "0", 3, 1),
    (4, "signup", "a int", "60", 4, 1),
    (5, "view", "a int", None, 0, 1),
]


def test_fixture2_dest_table_name(spark):
    reg = spark.createDataFrame(REG, REGISTRY_SCHEMA)
    cmds = spark.createDataFrame([(i, dt.datetime(2024, 1, 5, 3, 0)) for i in range(1, 6)], "event_type int, content_ts timestamp")
    got = {r["event_type"]: r["dest_table"] for r in registry_resolve(cmds, reg).collect()}
    assert got == {1: "click_60_20240105", 3: "purchase_2024", 4: "signup_60", 5: "view"}
    assert [r["event_type"] for r in commands_unregistered(cmds, reg).collect()] == [2]


def test_registry_diff_null_safe(spark):
    fresh = spark.createDataFrame(REG, REGISTRY_SCHEMA)
    known = spark.createDataFrame(
        [(1, "click", "a int", "60", 1, 1), (2, "error", "a int", "", 2, 1), (3, "purchase", "a int", "0", 1, 1),
         (5, "view", "a int", None, 4, 1)],
        REGISTRY_SCHEMA,
    )
    got = {r["event_type"]: r["change"] for r in registry_diff(fresh, known).collect()}
    # 5: NULL cycle equal on both sides; split code 4 and 0 both mean NONE
    assert got == {1: "unchanged", 2: "disabled", 3: "changed", 4: "new", 5: "unchanged"}


def test_fixture3_ledger(spark):
    rows = [
        (1, 0, None, 0), (1, 1, None, 1), (1, 3, "done", 2),  # three versions -> newest
        (2, 9, None, 0),  # unknown state -> ERROR
        (3, 0, None, 0),
    ]
    log = spark.createDataFrame(rows, "task_key long, state int, state_info string, version long")
    latest = {r["task_key"]: r for r in decode_states(ledger_latest(log)).collect()}
    assert latest[1]["state"] == 3 and latest[1]["state_info"] == "done"
    assert latest[2]["state"] == 2 and latest[2]["state_name"] == "ERROR"
    assert latest[2]["state_info"] == STATE_DEFAULT_INFO[2]
    assert latest[3]["state_info"] == STATE_DEFAULT_INFO[0]


def test_task_ids_match_global_row_number(spark):
    import random

    rnd = random.Random(5)
    data = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 50))) for i in range(3000)]
    df = spark.createDataFrame(data, "src long, content_ts timestamp").repartition(13)
    got = {r["src"]: r["task_id"] for r in assign_task_ids(df, ["content_ts", "src"], 100).collect()}
    expect = {src: 100 + k + 1 for k, (src, _) in enumerate(sorted(data, key=lambda x: (x[1], x[0])))}
    assert got == expect
    empty_start = spark.createDataFrame([(None,)], "m long")
    got1 = assign_task_ids(df.limit(1), ["src"], empty_start).collect()
    assert got1[0]["task_id"] == 1  # empty ledger: first id is 1


def test_fixture6_releasable_and_retention(spark):
    rows = [("a", 3), ("b", 3), ("b", 1), ("c", 2), ("c", 3), ("d", 0), ("p.pipe4cep", 3)]
    latest = spark.createDataFrame(rows, "data_path string, state int")
    assert sorted(r["data_path"] for r in files_releasable(latest).collect()) == ["a", "c", "p.pipe4cep"]
    plan = lambda s, f: {r["path"]: (r["action"], r["reason"]) for r in retention_plan(latest, s, f).collect()}
    none = plan("none", "none")
    assert none["a"] == ("keep", "policy_keep") and none["p.pipe4cep"] == ("delete", "pipe")
    succ = plan("delete", "none")
    assert succ["a"] == ("delete", "released") and succ["c"] == ("keep", "policy_keep")
    assert succ["b"] == ("keep", "in_use") and succ["d"] == ("keep", "in_use")
    both = plan("delete", "delete")
    assert both["c"] == ("delete", "released")


def test_compaction_keeps_latest(spark, tmp_path):
    from tallyload.operators.ledger import compact_ledger, ledger_append, ledger_rows, read_ledger

    root = str(tmp_path / "ledger")
    tasks = spark.createDataFrame([(k, 1, f"/d/{k}.csv") for k in range(20)], "task_key long, event_type int, data_path string")
    for b in range(3):
        ledger_append(ledger_rows(tasks.filter(F.col("task_key") % 3 >= b), b, 1, state=b + 1), root)
    before = sorted((r["task_key"], r["state"], r["version"]) for r in ledger_latest(read_ledger(spark, root)).collect())
    compact_ledger(spark, root, 1)
    after_df = read_ledger(spark, root)
    after = sorted((r["task_key"], r["state"], r["version"]) for r in ledger_latest(after_df).collect())
    assert before == after and after_df.count() < 20 + 14 + 7


def test_tables_needed_now(spark):
    reg = spark.createDataFrame(REG, REGISTRY_SCHEMA)
    from tallyload.operators import tables_needed_now

    got = {r["event_type"]: r["dest_table"] for r in tables_needed_now(reg, dt.datetime(2024, 3, 9, 12)).collect()}
    assert got == {1: "click_60_20240309", 3: "purchase_2024", 4: "signup_60", 5: "view"}


def test_apply_retention_only_when_confirmed(spark, tmp_path):
    from tallyload.operators import apply_retention

    a, b = tmp_path / "a.csv", tmp_path / "b.pipe4cep"
    a.write_text("1\n")
    b.write_text("2\n")
    latest = spark.createDataFrame([(str(a), 3), (str(b), 2)], "data_path string, state int")
    plan = retention_plan(latest, "delete", "none")
    dry = apply_retention(plan).collect()
    assert {r["removed"] for r in dry} == {False} and a.exists() and b.exists()
    done = {r["path"]: r["removed"] for r in apply_retention(plan, confirm=True).collect()}
    assert done == {str(a): True, str(b): True} and not a.exists() and not b.exists()


def test_effective_registry_keeps_old_version(spark):
    from tallyload.operators import effective_registry

    known = spark.createDataFrame([(1, "click", "a int", "60", 1, 1), (3, "p", "a int", "0", 3, 1)], REGISTRY_SCHEMA)
    fresh = spark.createDataFrame(
        [(1, "click", "a int, b nosuchtype", "60", 1, 1), (3, "p", "a int, b int", "0", 3, 1), (4, "s", "x int", "", 0, 1)],
        REGISTRY_SCHEMA,
    )
    got = {r["event_type"]: r["columns"] for r in effective_registry(fresh, known).collect()}
    assert got == {1: "a int", 3: "a int, b int", 4: "x int"}
