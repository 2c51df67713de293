import os

from pyspark.sql import functions as F

from files import write
from tallyload.operators import ledger_latest, read_ledger, read_target
from tallyload.operators.ledger import ledger_append, ledger_rows
from tallyload.plans import scenario as S
from tallyload.plans.batch import Layout, run_batch
from tallyload.sources.commands import command_scan
from tallyload.streaming import orphaned_tasks, recover, stream_commands, stream_ledger_poll, stream_load

REG = [(1, "people", "id int not null, name varchar(5), ts timestamp", "60", 2, 1), (2, "off", "a int", "", 0, 0)]


def setup_files(tmp):
    a = write(f"{tmp}/data/a.csv", "1,ann,2024-01-01 00:00:00\n2,bob,2024-01-02 00:00:00\nx,bad,zz\n")
    b = write(f"{tmp}/data/b.csv", "3,cy,2024-02-01 00:00:00\n4,toolongname,2024-02-01 00:00:00\n")
    write(f"{tmp}/cmds/1.cmd", f"s,1,{a},2024-01-05 10:00:00.0,t,60\ns,1,{b},2024-02-05 10:00:00.0,t,60\n")
    write(f"{tmp}/cmds/2.cmd", f"s,1,{tmp}/data/missing.csv,2024-01-05 10:00:00.0,t,60\ns,2,{a},2024-01-05 10:00:00.0,t,60\n"
          "s,1,/x.csv,never,t,60\n")
    return a, b


def latest_states(spark, layout):
    latest = ledger_latest(read_ledger(spark, layout.ledger))
    return {(os.path.basename(r["data_path"]), r["event_type"]): (r["state"], r["state_info"]) for r in latest.collect()}


def test_round_trip_and_rerun(spark, tmp):
    setup_files(tmp)
    layout = Layout(f"{tmp}/wh")
    reg = spark.createDataFrame(REG, "event_type int, base string, columns string, cycle string, partgranularity int, state int")
    for _ in range(2):  # the same batch twice leaves one copy
        run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, batch_id=7)
    t = read_target(spark, layout.target("people_60"))
    got = sorted((r["id"], r["dest_table"], r["period"]) for r in t.collect())
    assert got == [(1, "people_60_202401", "202401"), (2, "people_60_202401", "202401"), (3, "people_60_202402", "202402")]
    rejects = sorted(r["reason"] for r in spark.read.parquet(layout.rejects).collect())
    assert rejects == ["malformed", "too_long:name"]
    states = latest_states(spark, layout)
    assert states[("a.csv", 1)] == (3, "loaded 2 rows, 1 rejected")
    assert states[("missing.csv", 1)] == (2, "data file missing")
    assert states[("a.csv", 2)] == (0, "unregistered event type")  # waits for its type
    bad_cmds = spark.read.parquet(layout.command_rejects).collect()
    assert [r["reason"] for r in bad_cmds] == ["bad_timestamp"]
    # one latest row per task, every command in exactly one outcome
    assert len(states) == 4 and len(read_ledger(spark, layout.ledger).select("task_key").distinct().collect()) == 4


def test_reject_limit_fails_whole_file(spark, tmp):
    setup_files(tmp)
    layout = Layout(f"{tmp}/wh")
    reg = spark.createDataFrame(REG, "event_type int, base string, columns string, cycle string, partgranularity int, state int")
    from tallyload.sources.profiles import PROFILES

    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 0, profile=PROFILES["external"].with_limit(0))
    t = read_target(spark, layout.target("people_60"), REG[0][2]).collect()
    assert t == []  # both files have one reject, over a limit of 0
    states = latest_states(spark, layout)
    assert states[("a.csv", 1)][0] == 2 and "reject limit" in states[("a.csv", 1)][1]


def test_keep_last(spark, tmp):
    setup_files(tmp)
    layout = Layout(f"{tmp}/wh")
    reg = spark.createDataFrame(REG, "event_type int, base string, columns string, cycle string, partgranularity int, state int")
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 0, keep="last")
    states = latest_states(spark, layout)
    assert set(states) == {("b.csv", 1), ("a.csv", 2)}


def test_stream_restart_reads_only_new_files(spark, tmp):
    a, b = setup_files(tmp)
    layout = Layout(f"{tmp}/wh")
    reg = spark.createDataFrame(REG, "event_type int, base string, columns string, cycle string, partgranularity int, state int")

    def run():
        lines = stream_commands(spark, f"{tmp}/cmds", max_files_per_trigger=1)
        stream_load(lines, lambda: reg, layout, f"{tmp}/ckpt", available_now=True, compact_every=1).awaitTermination()

    run()
    n1 = read_target(spark, layout.target("people_60")).count()
    run()  # nothing new: no change
    assert read_target(spark, layout.target("people_60")).count() == n1 == 3
    write(f"{tmp}/cmds/3.cmd", f"s,1,{a},2024-03-05 10:00:00.0,t,60\n")
    run()
    t = read_target(spark, layout.target("people_60"))
    assert t.count() == 5 and t.filter(F.col("period") == "202403").count() == 2


def test_ledger_poll_and_recover(spark, tmp):
    a, b = setup_files(tmp)
    layout = Layout(f"{tmp}/wh")
    reg = spark.createDataFrame(REG, "event_type int, base string, columns string, cycle string, partgranularity int, state int")
    tasks = spark.createDataFrame(
        [(101, 1, a, "people_60_manual"), (102, 1, b, "people_60_manual")],
        "task_key long, event_type int, data_path string, dest_table string",
    ).withColumn("content_ts", F.lit("2024-04-01 00:00:00").cast("timestamp")).withColumn("task_id", F.col("task_key"))
    ledger_append(ledger_rows(tasks, -1, 0, state=0), layout.ledger)  # another system adds NEW rows
    q = stream_ledger_poll(spark, layout, lambda: reg, f"{tmp}/ckpt", available_now=True)
    q.awaitTermination()
    t = read_target(spark, layout.target("people_60"))
    assert sorted(r["dest_table"] for r in t.collect()) == ["people_60_manual"] * 3  # name kept from the ledger row
    states = {r["task_key"]: r["state"] for r in ledger_latest(read_ledger(spark, layout.ledger)).collect()}
    assert states == {101: 3, 102: 3}
    # a crash after the claim: OPERATING rows are redone by recover()
    crashed = tasks.withColumn("task_key", F.col("task_key") + 100)
    ledger_append(ledger_rows(crashed, -2, 1, state=1), layout.ledger)
    assert orphaned_tasks(spark, layout).count() == 2
    recover(spark, layout, reg)
    assert orphaned_tasks(spark, layout).count() == 0


def test_bad_registry_row_and_sequence_ids(spark, tmp):
    setup_files(tmp)
    layout = Layout(f"{tmp}/wh")
    bad = [(1, "people", "id int not null, name varchar(5), ts timestamp, oops notatype", "60", 2, 1)]
    reg = spark.createDataFrame(bad, "event_type int, base string, columns string, cycle string, partgranularity int, state int")
    from tallyload.operators import registry_validate

    v = registry_validate(reg).collect()
    assert v[0]["valid"] is False and v[0]["error"]
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 0, task_ids="sequence")
    latest = ledger_latest(read_ledger(spark, layout.ledger)).collect()
    by_file = {os.path.basename(r["data_path"]): r for r in latest if r["event_type"] == 1}
    assert by_file["a.csv"]["state"] == 2 and by_file["a.csv"]["state_info"].startswith("invalid registry columns")
    assert sorted(r["task_id"] for r in latest) == [1, 2, 3, 4]


def test_fanout_one_file_two_families(spark, tmp):
    a = write(f"{tmp}/data/a.csv", "1,ann,2024-01-01 00:00:00\n2,bob,2024-01-02 00:00:00\n")
    write(f"{tmp}/cmds/x.cmd", f"s,1,{a},2024-01-05 10:00:00.0,t,60\ns,3,{a},2024-01-05 10:00:00.0,t,60\n")
    reg = spark.createDataFrame(
        [(1, "people", "id int, name string, ts timestamp", "60", 2, 1),
         (3, "names", "id int, name string, ts timestamp", "0", 3, 1)],
        "event_type int, base string, columns string, cycle string, partgranularity int, state int",
    )
    layout = Layout(f"{tmp}/wh")
    run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 0)
    p = read_target(spark, layout.target("people_60")).collect()
    n = read_target(spark, layout.target("names")).collect()
    assert sorted(r["name"] for r in p) == ["ann", "bob"] and {r["dest_table"] for r in p} == {"people_60_202401"}
    assert sorted(r["name"] for r in n) == ["ann", "bob"] and {r["dest_table"] for r in n} == {"names_2024"}
    from tallyload.operators import existing_tables, period_view

    period_view(spark, layout.target("names"), "names", "names_2024")
    assert spark.sql("select count(*) as c from names_2024").first()["c"] == 2
    assert [r["dest_table"] for r in existing_tables(spark, layout.target("names")).collect()] == ["names_2024"]


def test_orders_round_trip_rows(spark, tmp):
    """Driver table -> CSV files + commands -> batch loader -> same rows as the source."""
    sf = "/root/testdata/sf0.001"
    cmd_root = S.stage_orders(spark, sf, tmp)
    layout = Layout(f"{tmp}/wh")
    run_batch(spark, command_scan(spark, cmd_root, S.STAGED_COMMAND_REGEX, positions=False), S.orders_registry(spark),
              layout, 0)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    got = read_target(spark, layout.target("orders")).select(*cols)
    src = spark.read.parquet(f"{sf}/orders.parquet").select(*cols).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )
    assert got.count() == src.count()
    assert got.exceptAll(src).count() == 0 and src.exceptAll(got).count() == 0


def test_file_inventory_forms(spark, tmp):
    from tallyload.sources.datafiles import file_inventory

    a = write(f"{tmp}/d/a b.csv", "12345")
    os.makedirs(f"{tmp}/d/dir", exist_ok=True)
    df = spark.createDataFrame([(a,), (f"file:{a}",), (f"{tmp}/d/none.csv",), (f"{tmp}/d/dir",)], "data_path string")
    got = {r["path"]: (r["data_size"], r["file_exists"]) for r in file_inventory(df).collect()}
    assert got[a] == (5, True) and got[f"file:{a}"] == (5, True)
    assert got[f"{tmp}/d/none.csv"] == (0, False) and got[f"{tmp}/d/dir"] == (0, False)


def test_two_families_and_shared_family_keep_all_rejects(spark, tmp):
    a = write(f"{tmp}/data/a.csv", "1,ann,2024-01-01 00:00:00\nx,bad,zz\n")
    b = write(f"{tmp}/data/b.csv", "2,bob\ny,bad\n")
    c = write(f"{tmp}/data/c.csv", "3,cy,2024-01-01 00:00:00\nz,bad,zz\n")
    write(f"{tmp}/cmds/x.cmd", f"s,1,{a},2024-01-05 10:00:00.0,t,60\ns,2,{b},2024-01-05 10:00:00.0,t,60\n"
          f"s,3,{c},2024-01-05 10:00:00.0,t,60\n")
    reg = spark.createDataFrame(
        [(1, "people", "id int, name string, ts timestamp", "60", 2, 1),
         (2, "pets", "id int, name string", "", 0, 1),
         (3, "people", "id int, name string, ts timestamp", "60", 2, 1)],  # same family as type 1
        "event_type int, base string, columns string, cycle string, partgranularity int, state int",
    )
    layout = Layout(f"{tmp}/wh")
    for _ in range(2):
        run_batch(spark, command_scan(spark, f"{tmp}/cmds"), reg, layout, 0)
    rejects = spark.read.parquet(layout.rejects).collect()
    assert sorted(r["raw"] for r in rejects) == ["x,bad,zz", "y,bad", "z,bad,zz"]
    people = read_target(spark, layout.target("people_60")).collect()
    assert sorted(r["name"] for r in people) == ["ann", "cy"]
    assert [r["name"] for r in read_target(spark, layout.target("pets")).collect()] == ["bob"]


def test_stream_clean_source_archive(spark, tmp):
    """the source's own clean-up moves processed command files (best effort)."""
    a, b = setup_files(tmp)
    layout = Layout(f"{tmp}/wh")
    reg = spark.createDataFrame(REG, "event_type int, base string, columns string, cycle string, partgranularity int, state int")
    lines = stream_commands(spark, f"{tmp}/cmds", max_files_per_trigger=1, clean_source="archive",
                            archive_dir=f"{tmp}/archive")
    stream_load(lines, lambda: reg, layout, f"{tmp}/ckpt", available_now=True).awaitTermination()
    assert read_target(spark, layout.target("people_60")).count() == 3
    archived = [os.path.join(d, f) for d, _, fs in os.walk(f"{tmp}/archive") for f in fs if f.endswith(".cmd")]
    left = [f for f in os.listdir(f"{tmp}/cmds") if f.endswith(".cmd")]
    assert len(archived) + len(left) == 2  # every file is either still there or archived, never lost


def test_glued_layouts_need_utf8(spark, tmp):
    from tallyload.functions.ddl import declared_schema
    from tallyload.sources.datafiles import data_scan
    from tallyload.sources.profiles import PROFILES

    p = write(f"{tmp}/d.csv", '"1","a"\n')
    import pytest

    with pytest.raises(ValueError):
        data_scan(spark, [p], declared_schema("id int, t string"), PROFILES["continued"].__class__(
            "x", layout="continued", encoding="GBK"))
