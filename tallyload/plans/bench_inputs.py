
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.plans import scenario as S

LINEITEM_EVENT_TYPE = 3
LINEITEM_COLUMNS = (
    "l_orderkey bigint not null, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag varchar(1), l_linestatus varchar(1), "
    "l_shipdate timestamp"
)


def lineitem_registry(spark: SparkSession) -> DataFrame:
    return S.registry_rows(spark, [(LINEITEM_EVENT_TYPE, "lineitem", LINEITEM_COLUMNS, "", 2, 1)])


def stage_lineitem_monthly(spark: SparkSession, sf_dir: str, root: str, malformed_pct: int = 0) -> str:
    """``lineitem`` as one CSV file per ship month plus one command per file."""
    li = S.table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey").cast("string")
    if malformed_pct:
        bad = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(100)) < malformed_pct
        key = F.when(bad, F.concat(F.lit("x"), key)).otherwise(key)
    month = F.date_format("l_shipdate", "yyyy-MM")
    out = li.select(
        key.alias("l_orderkey"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", month.alias("ship_month"),
    )
    data_root = f"{root}/data/lineitem"
    out.repartition("ship_month").write.mode("overwrite").partitionBy("ship_month").option("escape", '"').csv(data_root)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(data_root).drop("content")
    ts = F.concat(F.col("ship_month"), F.lit("-01 00:00:00.0"))
    raw = F.concat_ws(",", F.lit("src"), F.lit(str(LINEITEM_EVENT_TYPE)),
                      S.normalize_path(F.col("path"), decode=True), ts, F.lit("t"), F.lit("60"))
    cmd_root = f"{root}/cmds/lineitem"
    S.write_commands(files.select(raw.alias("raw")), cmd_root)
    return cmd_root


def stage_event_commands(spark: SparkSession, sf_dir: str, root: str, n_files: int = 100) -> str:
    """``events`` as command lines in ``n_files`` command files."""
    lines = S.events_command_lines(spark, sf_dir)
    cmd_root = f"{root}/cmds/events"
    lines.select("raw").repartition(n_files).write.mode("overwrite").text(cmd_root)
    return cmd_root


def stage_orders_many(spark: SparkSession, sf_dir: str, root: str, n_files: int = 100) -> str:
    """``orders`` in ``n_files`` CSV files, one command file for each."""
    o = S.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority",
    )
    data_root = f"{root}/data/orders_many"
    o.repartition(n_files).write.mode("overwrite").option("escape", '"').csv(data_root)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(data_root).drop("content")
    raw = F.concat_ws(",", F.lit("src"), F.lit(str(S.ORDERS_EVENT_TYPE)),
                      S.normalize_path(F.col("path"), decode=True), F.lit("2024-01-01 00:00:00.0"), F.lit("t"),
                      F.lit("60"))
    cmd_root = f"{root}/cmds/orders_many"
    files.select(raw.alias("raw")).repartition(n_files).write.mode("overwrite").text(cmd_root)
    return cmd_root
