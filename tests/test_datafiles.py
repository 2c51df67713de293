import datetime as dt

from pyspark.sql import functions as F

from files import write
from tallyload.functions.ddl import declared_schema
from tallyload.operators.conform import conform, reject_limit, split_rejects
from tallyload.sources.datafiles import data_scan
from tallyload.sources.profiles import PROFILES

FIXTURE5 = (
    '1,"a,b",2024-01-01 00:00:00\n'
    '2,"say ""hi""",2024-01-02 00:00:00\n'
    "x,bad,zz\n"
    "4,short\n"
    '5,b\\"c,2024-01-01 00:00:00,extra\n'
    "6,,2024-01-01 00:00:00\n"
    '3,"multi\nline",2024-01-03 00:00:00\n'
)


def load(spark, path, profile, schema=None):
    schema = schema or declared_schema("id int, name string, ts timestamp")
    rows = conform(data_scan(spark, [path], schema, PROFILES[profile]), schema)
    good, bad = split_rejects(rows, schema)
    return {r["id"]: r["name"] for r in good.collect()}, bad.collect()


def test_fixture5_quoted(spark, tmp):
    p = write(f"{tmp}/d.csv", FIXTURE5)
    good, bad = load(spark, p, "quoted")
    assert good == {1: "a,b", 2: 'say "hi"', 6: None}
    assert len(bad) == 5  # x, short, extra column, and the two halves of the multi-line row


def test_fixture5_multiline(spark, tmp):
    p = write(f"{tmp}/d.csv", FIXTURE5)
    good, bad = load(spark, p, "multiline")
    assert good == {1: "a,b", 2: 'say "hi"', 6: None, 3: "multi\nline"}
    assert sorted(r["reason"] for r in bad) == ["malformed"] * 3


def test_continued_glues_until_quote(spark, tmp):
    p = write(f"{tmp}/c.csv", '"1","multi\nline","2024-01-03 00:00:00"\n"2","one","2024-01-04 00:00:00"\n')
    good, bad = load(spark, p, "continued")
    assert good == {1: "multiline", 2: "one"} and bad == []


def test_records_across_many_splits(spark, tmp):
    """Multi-line records must come out whole when a file is cut into many splits."""
    import random

    rnd = random.Random(3)
    texts = {}
    body = []
    for i in range(400):
        t = "\n".join("w" * rnd.randint(1, 40) + ('""' if rnd.random() < 0.2 else "") for _ in range(rnd.randint(1, 6)))
        texts[i] = t.replace('""', '"')
        body.append(f'"{i}","{t}","2024-01-03 00:00:00"\n')
    p = write(f"{tmp}/m.csv", "".join(body))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        assert spark.read.text(p).rdd.getNumPartitions() > 10
        good, bad = load(spark, p, "multiline")
        good_c, bad_c = load(spark, p, "continued")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert bad == [] and good == texts
    # continued: brute-force model of the rule (glue until a line's last
    # non-blank character is a quote), each record then read as CSV
    import csv
    import io

    records, cur = [], []
    for line in "".join(body).split("\n")[:-1]:
        cur.append(line)
        if line.rstrip().endswith('"'):
            records.append("".join(cur))
            cur = []
    if cur:
        records.append("".join(cur))
    expect_good, expect_bad = {}, 0
    for rec in records:
        try:
            fields = next(csv.reader(io.StringIO(rec), doublequote=True, strict=True), [])
        except csv.Error:
            fields = []
        if len(fields) == 3 and fields[0].isdigit() and rec.endswith('"2024-01-03 00:00:00"'):
            expect_good[int(fields[0])] = fields[1]
        else:
            expect_bad += 1
    assert good_c == expect_good and len(bad_c) == expect_bad
    assert expect_bad > 0 and len(expect_good) > 100


def test_rules_not_null_and_length(spark, tmp):
    schema = declared_schema("id int not null, code varchar(3), ts datetime")
    p = write(f"{tmp}/r.csv", "1,abc,2024-01-01 00:00:00\n,abc,2024-01-01 00:00:00\n2,abcd,2024-01-01 00:00:00\n")
    rows = conform(data_scan(spark, [p], schema, PROFILES["quoted"]), schema)
    got = sorted(((r["id"] or 0), r["_reason"] or "") for r in rows.collect())
    assert got == [(0, "null:id"), (1, ""), (2, "too_long:code")]


def test_reject_limit(spark, tmp):
    p2 = write(f"{tmp}/two.csv", "1,a,2024-01-01 00:00:00\nx,b,c\ny,b,c\n")
    p3 = write(f"{tmp}/three.csv", "1,a,2024-01-01 00:00:00\nx,b,c\ny,b,c\nz,b,c\n")
    schema = declared_schema("id int, name string, ts timestamp")
    rows = conform(data_scan(spark, [p2, p3], schema, PROFILES["external"].with_limit(2)), schema).cache()
    stats = {r["_file"].rsplit("/", 1)[1]: (r["rejects"], r["admitted"]) for r in reject_limit(rows, 2).collect()}
    assert stats == {"two.csv": (2, True), "three.csv": (3, False)}


def test_fixture4_thirteen_columns(spark):
    s = declared_schema(
        "btime timestamp not null, hh int not null, mi int not null, imsi string(64) not null, tmsi string(64), "
        "msisdn string(26), lac int not null, ci int not null, areaid int not null, vipgroupid int not null, "
        "calltype bigint not null, failedcount int, totalcallcount int"
    )
    assert len(s.names) == 13 and s.names[3] == "imsi"
    assert ("imsi", "max_length", 64) in [(r.column, r.kind, r.limit) for r in s.rules]
    assert sum(r.kind == "not_null" for r in s.rules) == 9


def test_records_without_broadcast(spark, tmp, monkeypatch):
    """The split table over the broadcast bound: order restored per partition."""
    import tallyload.sources.datafiles as D

    monkeypatch.setattr(D, "DEFAULT_MAX_BROADCAST_ROWS", 0)
    body = "".join(f'"{i}","a\nb{i}","2024-01-03 00:00:00"\n' for i in range(300))
    p = write(f"{tmp}/m.csv", body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        good, bad = load(spark, p, "multiline")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert bad == [] and good == {i: f"a\nb{i}" for i in range(300)}
