"""The ledger: an append-only log of task transitions.

Rows are never updated and files never overwritten: a transition appends a
newer ``version`` of the task (E4 E5) and the current state is the newest
version per task (E6).  Every run of a batch id is an attempt with steps of its
own (a claim, then the final rows), so running an id again adds rows, and
``version = batch_id * 2**16 + step`` orders attempts.  The log is partitioned
by ``batch_id, step``.

Also here: A2 ledger_scan, D2 assign_task_ids, D3 load_metrics, D4
state_summary, C5 replay_guard.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyload.functions.states import FINISHED, state_code, state_name, state_text
from tallyload.operators.attempts import Files, claim_step, committed_names, final_step, settled  # noqa: F401  (steps are part of the ledger)
from tallyload.operators.sizing import bounded_broadcast

LEDGER_SCHEMA = (
    "task_key bigint, task_id bigint, event_type int, content_ts timestamp, data_path string, "
    "data_size bigint, state int, state_info string, gen_time timestamp, exec_start timestamp, "
    "exec_end timestamp, dest_table string, cmd_file string, version bigint, batch_id bigint, step int"
)
LEDGER_COLUMNS = [c.strip().split(" ")[0] for c in LEDGER_SCHEMA.split(",")]
# the ten columns a ledger scan hands back (A2)
SCAN_COLUMNS = [
    "task_id", "event_type", "content_ts", "data_path", "data_size", "state",
    "gen_time", "exec_start", "exec_end", "dest_table",
]
STEPS_PER_BATCH = 1 << 16
# rows of a snapshot's bucket when buckets are dealt, and when they are dealt anew
_BUCKET_ROWS, _BUCKET_MOST = 1 << 14, 1 << 16
_BUCKET_SCHEMA = "key_bucket int, gen int, n bigint, buckets int"


def ledger_rows(tasks: DataFrame, batch_id: int, step: int, **values) -> DataFrame:
    """E5: transition rows for ``tasks`` with columns overridden by ``values``.

    Missing ledger columns are NULL; ``version``, ``batch_id`` and ``step`` are set.
    """
    cols = []
    for c, dtype in (x.strip().split(" ") for x in LEDGER_SCHEMA.split(",")):
        if c in values:
            v = values[c]
            v = v if hasattr(v, "alias") else F.lit(v)
            cols.append(v.cast(dtype).alias(c))
        elif c == "version":
            cols.append(F.lit(batch_id * STEPS_PER_BATCH + step).cast("bigint").alias(c))
        elif c == "batch_id":
            cols.append(F.lit(batch_id).cast("bigint").alias(c))
        elif c == "step":
            cols.append(F.lit(step).cast("int").alias(c))
        elif c in tasks.columns:
            cols.append(F.col(c).cast(dtype).alias(c))
        else:
            cols.append(F.lit(None).cast(dtype).alias(c))
    return tasks.select(*cols)


def ledger_append(rows: DataFrame, ledger_root: str) -> None:
    """Append transition rows; earlier rows stay whatever their batch and step."""
    rows.select(*LEDGER_COLUMNS).write.mode("append").partitionBy("batch_id", "step").parquet(ledger_root)


def ledger_write(rows: DataFrame, ledger_root: str, batch_id: int, step: int) -> None:
    """E4 for the rows of one step, into that step's own folder, so that runs at the same time do not meet."""
    plain = [c for c in LEDGER_COLUMNS if c not in ("batch_id", "step")]
    rows.select(*plain).write.mode("append").parquet(f"{ledger_root}/batch_id={batch_id}/step={step}")


def read_ledger(spark: SparkSession, ledger_root: str, batch_id: int | None = None) -> DataFrame:
    """The ledger log, or its rows of one batch id.

    When a compaction snapshot exists: the snapshot and the log files it does
    not hold.  The rows of one batch are read from that batch's folder, so the
    read does not grow with history.
    """
    log = _read_log(spark, ledger_root, batch_id)
    snap = latest_snapshot(spark, ledger_root)
    if snap is None:
        return log
    rows = snapshot_rows(spark, snap).select(*LEDGER_COLUMNS)
    if batch_id is not None:
        rows = rows.filter(F.col("batch_id") == batch_id)
    return rows.unionByName(_tail(spark, log, snap).select(*LEDGER_COLUMNS))


def _read_log(spark: SparkSession, ledger_root: str, batch_id: int | None = None) -> DataFrame:
    path = ledger_root if batch_id is None else f"{ledger_root.rstrip('/')}/batch_id={batch_id}"
    if not Files(spark, path).exists():  # no ledger written yet
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", ledger_root).parquet(path)


def settled_ledger(spark: SparkSession, ledger_root: str, batch_id: int | None = None) -> DataFrame:
    """``read_ledger`` without final rows of attempts that have not committed."""
    return settled(spark, read_ledger(spark, ledger_root, batch_id), ledger_root.rstrip("/").rsplit("/", 1)[0])


def _snapshot_root(ledger_root: str) -> str:
    return ledger_root.rstrip("/") + "_snapshots"


def latest_snapshot(spark: SparkSession, ledger_root: str) -> str | None:
    """Folder of the newest complete snapshot, or None.

    Lists the snapshot folders through Hadoop's FileSystem on the driver
    (folder names and markers only), so it works on any cluster file system.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(_snapshot_root(ledger_root))
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return None
    numbers = [int(st.getPath().getName()[2:]) for st in fs.listStatus(root)
               if st.getPath().getName().startswith("n=")
               and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "files/_SUCCESS"))]
    return f"{_snapshot_root(ledger_root)}/n={max(numbers)}" if numbers else None


def _tail(spark: SparkSession, log: DataFrame, snap: str) -> DataFrame:
    """Rows of the log files that a snapshot does not hold."""
    held = spark.read.schema("file string").parquet(f"{snap}/files")
    return log.withColumn("_f", F.input_file_name()).join(held, F.col("_f") == F.col("file"), "left_anti").drop("_f")


def _data_root(snap: str) -> str:
    return snap.rsplit("/", 1)[0] + "/data"


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("task_key"), F.lit(buckets)).cast("int").alias("key_bucket")


def _buckets(spark: SparkSession, snap: str) -> DataFrame:
    return spark.read.schema(_BUCKET_SCHEMA).parquet(f"{snap}/buckets")


def snapshot_rows(spark: SparkSession, snap: str) -> DataFrame:
    """The newest row of every task that a snapshot holds, with its ``key_bucket``.

    The snapshot's list of buckets is joined to the partition columns, so
    folders of older generations are pruned.
    """
    root = _data_root(snap)
    if not Files(spark, root).exists():
        return spark.createDataFrame([], f"{LEDGER_SCHEMA}, key_bucket int")
    data = spark.read.schema(f"{LEDGER_SCHEMA}, key_bucket int, gen int").parquet(root)
    valid = bounded_broadcast(_buckets(spark, snap).select("key_bucket", "gen").where("gen >= 0"))
    return data.join(valid, ["key_bucket", "gen"], "left_semi").drop("gen")


def compact_ledger(spark: SparkSession, ledger_root: str, upto_batch: int | None = None, retire: bool = False) -> str:
    """Write the newest row of every task as a snapshot of exact log files; returns its folder.

    The snapshot names the files it holds (all, or those of batch ids up to
    ``upto_batch``); files added later, whatever their batch id, are still read
    from the log.  Its rows lie in buckets of the task key, one file each, in
    key order.  Only buckets of tasks that changed since the last snapshot are
    read, merged and written again, as a new generation; the others are taken
    over by name.  When buckets have grown beyond ``_BUCKET_MOST`` rows all are
    dealt anew into more.  ``retire`` deletes the named files, older snapshots
    and bucket files that are no longer used, which keeps listings short.
    Nobody may be reading an older snapshot while it retires, and only one
    compaction may run at a time.
    """
    known = latest_snapshot(spark, ledger_root)
    log = _read_log(spark, ledger_root)
    files = log.inputFiles()
    log = log.withColumn("_f", F.input_file_name())
    # final rows of attempts that have not committed stay in the log: they may commit, or be cleared
    root = ledger_root.rstrip("/").rsplit("/", 1)[0]
    commits = committed_names(spark, root)
    if commits is not None:
        log = settled(spark, log, root)

        def ended(f):
            batch, step = (int(x) for x in re.search(r"/batch_id=(-?\d+)/step=(\d+)/", f).groups())
            return step == 0 or step % 2 or (batch, step // 2 - 1) in commits
        files = [f for f in files if ended(f)]
    if upto_batch is not None:
        log = log.filter(F.col("batch_id") <= upto_batch)
        files = [f for f in files if int(re.search(r"/batch_id=(-?\d+)/", f)[1]) <= upto_batch]
    number = int(known.rsplit("=", 1)[1]) + 1 if known else 0
    path = f"{_snapshot_root(ledger_root)}/n={number}"
    held = spark.createDataFrame([(f,) for f in files], "file string")
    delta = log.join(held.withColumnRenamed("file", "_held"), F.col("_f") == F.col("_held"), "left_semi")
    if known:
        old = spark.read.schema("file string").parquet(f"{known}/files")
        delta = delta.join(old, F.col("_f") == F.col("file"), "left_anti")
        held = held.unionByName(old).distinct()
    delta = ledger_latest(delta.select(*LEDGER_COLUMNS)).checkpoint(eager=True)  # read by the choice of buckets and by the merge
    before = _buckets(spark, known).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("buckets").alias("b")).first() if known else (0, None)
    most, buckets = before[0] + delta.count(), before[1] or 1
    rewrite = most > buckets * _BUCKET_MOST
    while most > buckets * _BUCKET_ROWS and rewrite:
        buckets *= 2
    rows = delta.select("*", _bucket(buckets))
    if known:
        earlier = snapshot_rows(spark, known)
        if rewrite:
            earlier = earlier.select(*LEDGER_COLUMNS, _bucket(buckets))
        else:
            changed = bounded_broadcast(rows.select("key_bucket").distinct()).where("key_bucket >= 0")
            earlier = earlier.join(changed, "key_bucket", "left_semi")
        rows = ledger_latest(rows.unionByName(earlier))
    data = _data_root(path)
    rows.select(*LEDGER_COLUMNS, "key_bucket", F.lit(number).alias("gen")).repartition("key_bucket").sortWithinPartitions(
        "key_bucket", "task_key").write.mode("append").option("parquet.bloom.filter.enabled#task_key", "true").option(
        "parquet.bloom.filter.expected.ndv#task_key", str(_BUCKET_MOST)).partitionBy("key_bucket", "gen").parquet(data)
    now = spark.createDataFrame([], _BUCKET_SCHEMA)
    if Files(spark, data).exists():
        written = spark.read.schema("task_key bigint, key_bucket int, gen int").parquet(data).where(F.col("gen") == number)
        now = written.groupBy("key_bucket", "gen").agg(F.count(F.lit(1)).alias("n")).withColumn("buckets", F.lit(buckets))
    if known and not rewrite:
        kept = _buckets(spark, known)
        now = now.unionByName(kept.join(now.select("key_bucket"), "key_bucket", "left_anti").select(*now.columns))
    now.coalesce(1).write.mode("overwrite").parquet(f"{path}/buckets")  # a row a bucket
    held.write.mode("overwrite").parquet(f"{path}/files")  # its marker completes the snapshot
    if retire:
        for f in files:
            delete_path(spark, f)
        if known:
            for r in _buckets(spark, known).join(_buckets(spark, path), ["key_bucket", "gen"], "left_anti").toLocalIterator():
                delete_path(spark, f"{data}/key_bucket={r['key_bucket']}/gen={r['gen']}")
        for n in range(number):
            delete_path(spark, f"{_snapshot_root(ledger_root)}/n={n}")
    return path


def latest_of(spark: SparkSession, ledger_root: str, keys: DataFrame) -> DataFrame:
    """``task_key, state, batch_id`` of the newest settled row of each task of ``keys`` that the ledger knows.

    ``keys`` (a batch's tasks) is handed to the snapshot, where only buckets of
    these keys are read, and to the log files written since: what is read
    depends on the batch and on how often the ledger is compacted, not on
    history.
    """
    snap = latest_snapshot(spark, ledger_root)
    log = _read_log(spark, ledger_root)
    columns = ["task_key", "state", "batch_id", "version"]
    wanted = keys.select("task_key").distinct()
    if snap is not None:
        log = _tail(spark, log, snap)
    found = settled(spark, log, ledger_root.rstrip("/").rsplit("/", 1)[0]).join(bounded_broadcast(wanted), "task_key", "left_semi").select(*columns)
    if snap is not None:
        buckets = _buckets(spark, snap).agg(F.max("buckets")).first()[0] or 1
        at = bounded_broadcast(wanted.select("task_key", _bucket(buckets))).where("key_bucket >= 0")
        found = found.unionByName(snapshot_rows(spark, snap).join(at, ["key_bucket", "task_key"], "left_semi").select(*columns))
    newest = found.groupBy("task_key").agg(F.max_by(F.struct("state", "batch_id"), "version").alias("r"))
    return newest.select("task_key", "r.state", "r.batch_id")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library's own tables, on any file system Hadoop knows."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)) if "://" in path or path.startswith("file:") else jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ledger_latest(ledger: DataFrame, key="task_key", order="version") -> DataFrame:
    """The newest row per key (``max_by`` is combined map-side, so a key
    with many versions does not gather in one task)."""
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    cols = ledger.columns
    by = F.struct(*orders) if len(orders) > 1 else F.col(orders[0])
    return ledger.groupBy(*keys).agg(F.max_by(F.struct(*cols), by).alias("_r")).select("_r.*")


def latest_state(ledger: DataFrame, key: str = "task_key", order: str = "version") -> DataFrame:
    """Current state per key only: ``max_by(state, version)`` reads three
    columns and hash-aggregates (the full-row ``ledger_latest`` cannot)."""
    return ledger.groupBy(key).agg(F.max_by("state", order).alias("state"))


def ledger_scan(latest: DataFrame, state: int, columns: list[str] | None = None) -> DataFrame:
    """A2: current tasks in ``state``."""
    return latest.filter(F.col("state") == state).select(*(columns or SCAN_COLUMNS))


def assign_task_ids(pending: DataFrame, order_cols: list[str], start_after, id_col: str = "task_id") -> DataFrame:
    """Number ``pending`` 1, 2, ... in ``order_cols`` order, after ``start_after``.

    ``start_after`` is an int or a one-row, one-column DataFrame (e.g.
    ``max(id)``), read as a single scalar; NULL counts as 0.  No single-task
    global window: rows are range-sorted, each partition counts its rows, the
    (one row per partition) counts are prefix-summed, and each row adds its
    partition's offset to its index inside the partition.  The sorted rows
    are checkpointed so both passes see the same partitioning.
    """
    sorted_df = pending.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    sorted_df = sorted_df.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    counts = sorted_df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if isinstance(start_after, DataFrame):
        start_after = start_after.first()[0]  # one scalar, e.g. max(id)
    offsets = offsets.withColumn("_base", F.lit(int(start_after or 0)).cast("bigint"))
    local = F.col("_mid") - F.shiftleft(part, 33)
    out = sorted_df.withColumn("_part", part).join(offsets, "_part")  # a row per partition: AQE decides
    new_id = (F.col("_base") + F.col("_off") + local + 1).alias(id_col)
    keep = [c for c in pending.columns if c != id_col]
    return out.select(*keep, new_id)


def load_metrics(ledger_latest_df: DataFrame, by=("dest_table",)) -> DataFrame:
    """D3: loads, bytes and seconds (sum, max, mean, approximate p95) per group."""
    secs = F.unix_timestamp("exec_end") - F.unix_timestamp("exec_start")
    return ledger_latest_df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("loads"),
        F.sum("data_size").cast("bigint").alias("bytes"),
        F.sum(secs).cast("bigint").alias("secs"),
        F.max(secs).cast("bigint").alias("max_secs"),
        F.avg(secs).alias("avg_secs"),
        F.percentile_approx(secs, 0.95).cast("bigint").alias("p95_secs"),
    )


def state_summary(latest: DataFrame, by=("event_type",)) -> DataFrame:
    """D4 + B6: tasks per group and state, with the state's name."""
    s = state_code("state")
    return (
        latest.groupBy(*by, s.alias("state"))
        .agg(F.count(F.lit(1)).alias("tasks"))
        .withColumn("state_name", state_name("state"))
    )


def decode_states(df: DataFrame) -> DataFrame:
    """Normalised state code, name and message (default text when NULL)."""
    return df.withColumn("state_info", state_text("state", "state_info")).withColumn(
        "state_name", state_name("state")
    ).withColumn("state", state_code("state"))


def replay_guard(candidates: DataFrame, done: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """Leave out candidates that are already done.

    Without ``order_col``: drop candidates whose key is in ``done``.  With it:
    drop a candidate only when ``done`` has the same key with a larger order
    value (a later finished load of the same file).  ``done`` is reduced to
    one row per key before the join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order_col is None:
        return candidates.join(done.select(*keys).distinct(), keys, "left_anti")
    last = done.groupBy(*keys).agg(F.max(order_col).alias("_done_max"))
    j = candidates.join(last, keys, "left")
    return j.filter(F.col("_done_max").isNull() | (F.col("_done_max") <= F.col(order_col))).drop("_done_max")


def finished(col="state"):
    return F.col(col).isin(*FINISHED)
