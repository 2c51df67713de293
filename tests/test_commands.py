import datetime as dt

from pyspark.sql import functions as F

from files import write
from tallyload.functions.timestamps import content_timestamp
from tallyload.operators.commands import classify_commands, command_parse, command_rejects, last_command_per_file
from tallyload.sources.commands import command_scan

LINES = [
    ("1,7,/in/a.csv,2024-01-05 13:45:00.0,t,60", None),
    ('"1","7","/in/a.csv","2024-01-05 03:45:00.123","t","60"', None),
    ("1,7,/in/a.csv,2024-01-05 12:30:00.0,t,60", None),
    ("1,7,/in/a.csv,2024-01-05 03:45:00.0,t,", "bad_field_count"),
    ("1,7,/in/a.csv,2024-01-05 03:45:00.0,t,60,", None),
    ("1,7,/in/a.csv", "bad_field_count"),
    ("1,x7,/in/a.csv,2024-01-05 03:45:00.0,t,60", "bad_event_type"),
    ("1, 7,/in/a.csv,2024-01-05 03:45:00.0,t,60", "bad_event_type"),
    ("1,7,/in/a.csv,yesterday,t,60", "bad_timestamp"),
    ("1,+7,/in/a.csv,2024-01-05 03:45:00.0,t,60", None),
    ("1,99999999999,/in/a.csv,2024-01-05 03:45:00.0,t,60", "bad_event_type"),
    ("", "bad_field_count"),
    (",,,", "bad_field_count"),
]


def lines_df(spark, raws):
    return spark.createDataFrame([("f.cmd", i, r) for i, r in enumerate(raws)], "cmd_file string, line_pos long, raw string")


def test_fixture1_reasons(spark):
    got = classify_commands(lines_df(spark, [r for r, _ in LINES])).orderBy("line_pos").collect()
    assert [r["reason"] for r in got] == [e for _, e in LINES]


def test_fixture1_values(spark):
    got = {r["line_pos"]: r for r in command_parse(lines_df(spark, [r for r, _ in LINES])).collect()}
    assert got[0]["content_ts"] == dt.datetime(2024, 1, 5, 13, 45)
    assert got[1]["content_ts"] == dt.datetime(2024, 1, 5, 3, 45, 0, 123000)
    assert got[2]["content_ts"] == dt.datetime(2024, 1, 5, 12, 30)
    assert got[0]["event_type"] == 7 and got[0]["data_path"] == "/in/a.csv" and got[0]["source_id"] == "1"
    assert got[9]["event_type"] == 7


def test_twelve_as_midnight_and_fraction_modes(spark):
    df = spark.createDataFrame([("2024-01-05 12:30:00.5",), ("2024-01-05 03:45:00.179575",), ("2024-01-05 03:45:00",)], "s string")
    r = df.select(
        content_timestamp("s", twelve_as_midnight=True).alias("a"),
        content_timestamp("s").alias("m"),
        content_timestamp("s", fraction="decimal").alias("d"),
    ).collect()
    assert r[0]["a"] == dt.datetime(2024, 1, 5, 0, 30, 0, 5000)
    assert r[0]["m"] == dt.datetime(2024, 1, 5, 12, 30, 0, 5000)  # .5 read as 5 ms
    assert r[0]["d"] == dt.datetime(2024, 1, 5, 12, 30, 0, 500000)
    assert r[1]["m"] == dt.datetime(2024, 1, 5, 3, 47, 59, 575000)  # 179575 ms
    assert r[1]["d"] == dt.datetime(2024, 1, 5, 3, 45, 0, 179575)
    assert r[2]["m"] is None  # the fraction is part of the format


def test_split_model_property(spark):
    """B1 against a tiny Python model of split-and-count."""
    import random

    rnd = random.Random(7)
    raws = []
    for _ in range(300):
        n = rnd.randint(0, 8)
        fields = [rnd.choice(["", "1", "7", "a", '"q"']) for _ in range(n)]
        raws.append(",".join(fields))

    def model(r):
        parts = r.replace('"', "").split(",")
        while parts and parts[-1] == "":
            parts.pop()
        return len(parts) if r.replace('"', "") != "" else 1

    got = classify_commands(lines_df(spark, raws)).orderBy("line_pos").collect()
    for raw, row in zip(raws, got):
        assert (row["reason"] == "bad_field_count") == (model(raw) != 6), raw


def test_every_line_in_one_outcome(spark):
    raws = [r for r, _ in LINES]
    good = command_parse(lines_df(spark, raws)).count()
    bad = command_rejects(lines_df(spark, raws)).count()
    assert good + bad == len(raws)


def test_scan_name_regex_and_keep_last(spark, tmp):
    write(f"{tmp}/a.cmd", "1,7,/in/a.csv,2024-01-05 13:45:00.0,t,60\n1,7,/in/b.csv,2024-01-05 13:45:00.0,t,60\n")
    write(f"{tmp}/x.tmp", "1,7,/in/x.csv,2024-01-05 13:45:00.0,t,60\n")
    write(f"{tmp}/x.cmd.bak", "1,7,/in/x.csv,2024-01-05 13:45:00.0,t,60\n")
    write(f"{tmp}/sub/x.cmd", "1,7,/in/s.csv,2024-01-05 13:45:00.0,t,60\n")
    write(f"{tmp}/empty.cmd", "")
    lines = command_scan(spark, tmp)
    cmds = command_parse(lines)
    assert sorted(r["data_path"] for r in cmds.collect()) == ["/in/a.csv", "/in/b.csv", "/in/s.csv"]
    last = last_command_per_file(cmds)
    assert sorted(r["data_path"] for r in last.collect()) == ["/in/b.csv", "/in/s.csv"]


def test_line_positions_survive_small_splits(spark, tmp):
    n = 2000
    write(f"{tmp}/big.cmd", "".join(f"{i},7,/in/{i}.csv,2024-01-05 13:45:00.0,t,60\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = command_scan(spark, tmp)
        assert spark.read.text(tmp).rdd.getNumPartitions() > 5
        rows = lines.orderBy("line_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(r["raw"].split(",")[0]) for r in rows] == list(range(n))
    assert len({r["line_pos"] for r in rows}) == n
    last = last_command_per_file(command_parse(lines)).collect()
    assert last[0]["source_id"] == str(n - 1)


def test_lenient_rollover(spark):
    rows = [("2024-02-30 10:00:00.0",), ("2024-13-01 00:00:00.0",), ("2024-01-05 25:00:00.0",),
            ("2024-1-5 3:4:5.6",), ("2024-00-10 00:00:00.0",), ("2024-01-05 03:45:00.0 trailing",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r["t"] for r in df.select(content_timestamp("s").alias("t")).collect()]
    assert got == [
        dt.datetime(2024, 3, 1, 10), dt.datetime(2025, 1, 1), dt.datetime(2024, 1, 6, 1),
        dt.datetime(2024, 1, 5, 3, 4, 5, 6000), dt.datetime(2023, 12, 10), dt.datetime(2024, 1, 5, 3, 45),
    ]
