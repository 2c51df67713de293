"""Inputs derived by Spark from the driver tables, for the checks and the bench.

* ``events`` -> a registry (one row per event type), command lines (one per
  event, announcing ``/in/<type>/<user>.csv``) and a ledger log in which each
  event is a task that went through up to three transitions
  (NEW -> OPERATING -> ERROR/SUCCESSFUL; the final state is ``event_id % 4``).
* ``orders`` / ``documents`` -> real CSV data files plus command files, written
  below the shared scratch folder and loaded back through the batch loader.

Everything grows with the source tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyload.functions.naming import normalize_path
from tallyload.operators.registry import REGISTRY_SCHEMA
from tallyload.operators.sizing import bounded_broadcast

EVENT_COLUMNS = "event_id bigint not null, ts timestamp, user_id bigint, value double, props string"
ORDER_COLUMNS = (
    "o_orderkey bigint not null, o_custkey bigint, o_orderstatus varchar(1), o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority varchar(20)"
)
DOCUMENT_COLUMNS = "doc_id bigint not null, text string, lang string, source string, n_chars bigint"
ORDERS_EVENT_TYPE, DOCUMENTS_EVENT_TYPE = 1, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_type`` name -> ``eventtype`` number (dense rank of the name).

    The ranking window runs over the distinct names only (a registry-sized set).
    """
    names = table(spark, sf_dir, "events").select("event_type").distinct()
    return names.select(
        "event_type", F.dense_rank().over(Window.orderBy("event_type")).cast("int").alias("eventtype")
    )


def events_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = event_types(spark, sf_dir)
    e = F.col("eventtype")
    return cfg.select(
        e.alias("event_type"),
        F.col("event_type").alias("base"),
        F.lit(EVENT_COLUMNS).alias("columns"),
        F.when(e % 3 == 0, "0").when(e % 3 == 1, "60").otherwise("").alias("cycle"),
        (e % 5).cast("int").alias("partgranularity"),
        F.when(e == 2, 0).otherwise(1).cast("int").alias("state"),
    )


def known_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configurations 'in use' before a refresh: type 5 not yet known,
    type 3 with a different split."""
    reg = events_registry(spark, sf_dir)
    return reg.filter(F.col("event_type") != 5).withColumn(
        "partgranularity", F.when(F.col("event_type") == 3, F.lit(1)).otherwise(F.col("partgranularity"))
    )


def _events_with_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.join(bounded_broadcast(event_types(spark, sf_dir)), "event_type")


def data_path_of(ev_type, user_id):
    return F.concat(F.lit("/in/"), ev_type, F.lit("/"), user_id.cast("string"), F.lit(".csv"))


def events_command_lines(spark: SparkSession, sf_dir: str, malformed: bool = False) -> DataFrame:
    """One command line per event: ``cmd_file, line_pos, raw``.

    Each user's data file has its own command file; ``line_pos`` is the event
    id.  With ``malformed``, events with ``event_id % 11`` of 0, 1, 2 get a
    missing field, a non-numeric type and an unreadable time respectively.
    """
    ev = _events_with_types(spark, sf_dir)
    path = data_path_of(F.col("event_type"), F.col("user_id"))
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    kind = F.col("event_id") % 11 if malformed else F.lit(-1)
    et = F.when(kind == 1, F.concat(F.lit("x"), F.col("eventtype").cast("string"))).otherwise(
        F.col("eventtype").cast("string")
    )
    ts = F.when(kind == 2, F.lit("yesterday")).otherwise(ts)
    last = F.when(kind == 0, F.lit("")).otherwise(F.lit("60"))
    raw = F.concat_ws(",", F.col("event_id").cast("string"), et, path, ts, F.lit("t"), last)
    return ev.select(
        F.concat(F.lit("/cmd/"), F.col("event_type"), F.lit("/"), F.col("user_id").cast("string"),
                 F.lit(".cmd")).alias("cmd_file"),
        F.col("event_id").alias("line_pos"),
        raw.alias("raw"),
    )


def events_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger log: every event is a task with 1 to 3 transition rows."""
    from tallyload.operators.ledger import LEDGER_COLUMNS

    ev = _events_with_types(spark, sf_dir)
    final = (F.col("event_id") % 4).cast("int")
    steps = ev.withColumn("_final", final).withColumn("step", F.explode(F.sequence(F.lit(0), F.least("_final", F.lit(2)))))
    start = F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 60).cast("int"))
    end = start + F.make_dt_interval(secs=(F.col("event_id") % 7).cast("int"))
    return steps.select(
        F.col("event_id").alias("task_key"),
        F.col("event_id").alias("task_id"),
        F.col("eventtype").alias("event_type"),
        F.col("ts").alias("content_ts"),
        data_path_of(F.col("event_type"), F.col("user_id")).alias("data_path"),
        F.round(F.col("value") * 100).cast("bigint").alias("data_size"),
        F.when(F.col("step") == 2, F.col("_final")).otherwise(F.col("step")).cast("int").alias("state"),
        F.lit(None).cast("string").alias("state_info"),
        F.col("ts").alias("gen_time"),
        F.when(F.col("step") > 0, start).alias("exec_start"),
        F.when(F.col("step") == 2, end).alias("exec_end"),
        F.lit(None).cast("string").alias("dest_table"),
        F.lit(None).cast("string").alias("cmd_file"),
        F.col("step").cast("bigint").alias("version"),
        F.lit(0).cast("bigint").alias("batch_id"),
        F.col("step").cast("int").alias("step"),
    ).select(*LEDGER_COLUMNS)


def registry_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A registry from literal configuration rows (event_type, base, columns, cycle, partgranularity, state)."""
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def write_commands(commands: DataFrame, cmd_root: str) -> None:
    """Write command lines (column ``raw``) as text files below ``cmd_root``."""
    commands.select("raw").write.mode("overwrite").text(cmd_root)


# Spark's text writer names its files part-*.txt
STAGED_COMMAND_REGEX = r"part-.*\.txt"


def _announce(spark: SparkSession, data_root: str, event_type: int, ts_expr) -> DataFrame:
    """One command line per CSV file written below ``data_root`` (listing only, no content read)."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(data_root)
        .drop("content")
    )
    path = normalize_path(F.col("path"), decode=True)
    raw = F.concat_ws(",", F.lit("src"), F.lit(str(event_type)), path, ts_expr, F.lit("t"), F.lit("60"))
    return files.select(raw.alias("raw"))


def stage_orders(spark: SparkSession, sf_dir: str, root: str, corrupt: bool = False,
                 one_file_per_year: bool = False) -> str:
    """``orders`` as CSV files by order year plus command files; returns the command folder.

    With ``corrupt``, orders whose key is a multiple of 97 get an ``x`` in
    front of the key, so they fail the declared ``bigint``.  With
    ``one_file_per_year`` each year is a single file (per-file rules then
    act per year).
    """
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    if corrupt:
        key = F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("x"), key)).otherwise(key)
    out = o.select(
        key.alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.year("o_orderdate").alias("order_year"),
    )
    data_root = f"{root}/data/orders"
    if one_file_per_year:
        out = out.repartition("order_year")
    out.write.mode("overwrite").partitionBy("order_year").option("escape", '"').csv(data_root)
    ts = F.concat(F.col("order_year").cast("string"), F.lit("-01-01 00:00:00.0"))
    cmd_root = f"{root}/cmds/orders"
    write_commands(_announce(spark, data_root, ORDERS_EVENT_TYPE, ts), cmd_root)
    return cmd_root


def stage_documents(spark: SparkSession, sf_dir: str, root: str) -> str:
    """``documents`` as fully quoted CSV (texts keep their line breaks) plus commands."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    data_root = f"{root}/data/documents"
    d.write.mode("overwrite").option("quoteAll", "true").option("escape", '"').csv(data_root)
    cmd_root = f"{root}/cmds/documents"
    write_commands(_announce(spark, data_root, DOCUMENTS_EVENT_TYPE, F.lit("2024-01-01 00:00:00.0")), cmd_root)
    return cmd_root


def orders_registry(spark: SparkSession) -> DataFrame:
    return registry_rows(spark, [(ORDERS_EVENT_TYPE, "orders", ORDER_COLUMNS, "", 3, 1)])


def documents_registry(spark: SparkSession) -> DataFrame:
    return registry_rows(spark, [(DOCUMENTS_EVENT_TYPE, "documents", DOCUMENT_COLUMNS, "0", 0, 1)])
