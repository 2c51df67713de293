"""Continuous intake.

F1: the command folder is a file stream; each new file is read once (the
    source's own log remembers it), optionally cleaned up by the source.
F2: each micro-batch runs :func:`run_batch` under the stream's batch id.  A
    batch replayed after a crash withdraws the crashed attempt, whose rows
    nobody has seen, and skips tasks that a committed attempt finished.
F3: the registry is read again inside every micro-batch.
F4: NEW rows that other systems append to the ledger are claimed
    (OPERATING is written before loading) and loaded.
F5: tasks left OPERATING by a crash are found in the ledger and redone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyload.functions.states import FINISHED, NEW, OPERATING, WAITING
from tallyload.operators.ledger import LEDGER_SCHEMA, compact_ledger, latest_of, ledger_latest, replay_guard, settled_ledger
from tallyload.operators.registry import effective_registry, registry_active, snapshot_registry
from tallyload.plans.batch import Layout, load_tasks, open_attempt, run_batch

# Batch id ranges: command stream from 0, ledger-poll stream from 2**40.  A
# redo is a further attempt of the claim's own batch id.
LEDGER_POLL_BATCH_BASE = 1 << 40


def _maybe_compact(spark: SparkSession, layout: Layout, epoch: int, every: int | None) -> None:
    """Compact the ledger every ``every`` batches, so reads of it take a snapshot plus recent log files."""
    if every and epoch > 0 and epoch % every == 0:
        compact_ledger(spark, layout.ledger)


def stream_commands(
    spark: SparkSession,
    root: str,
    name_regex: str | None = r".*\.cmd",
    glob_filter: str | None = None,
    max_files_per_trigger: int | None = None,
    clean_source: str = "off",
    archive_dir: str | None = None,
) -> DataFrame:
    """a streaming DataFrame of command lines (``cmd_file, _bs, raw``)."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source != "off":
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    df = r.load(root)
    if name_regex:
        df = df.filter(F.col("_metadata.file_name").rlike(f"^(?:{name_regex})$"))
    return df.select(
        F.col("_metadata.file_path").alias("cmd_file"),
        F.col("_metadata.file_block_start").alias("_bs"),
        F.col("value").alias("raw"),
    )


def _trigger(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def stream_load(
    lines: DataFrame,
    registry_loader: Callable[[], DataFrame],
    layout: Layout,
    checkpoint: str,
    profile="quoted",
    keep: str = "all",
    parse_options: dict | None = None,
    available_now: bool = False,
    processing_time: str | None = "200 milliseconds",
    batch_base: int = 0,
    compact_every: int | None = None,
) -> StreamingQuery:
    """F2 + F3: load every micro-batch of command lines.

    The guard of each batch only reads its own ledger partitions; with
    ``compact_every`` the ledger is also snapshotted every so many batches
    for the monitoring reads.
    """

    in_use = {"registry": None}

    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        lines = batch.select("cmd_file", "_bs", F.monotonically_increasing_id().alias("_mid"), "raw")
        # the registry is read again for every batch; a row that no longer
        # parses keeps the version in use
        registry = snapshot_registry(effective_registry(registry_loader(), in_use["registry"]))
        in_use["registry"] = registry
        run_batch(spark, lines, registry, layout,
                  batch_base + epoch, profile=profile, keep=keep, parse_options=parse_options,
                  guard_scope="batch", owner=checkpoint)
        _maybe_compact(spark, layout, epoch, compact_every)

    w = lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, processing_time).start()


def stream_ledger_poll(
    spark: SparkSession,
    layout: Layout,
    registry_loader: Callable[[], DataFrame],
    checkpoint: str,
    profile="quoted",
    available_now: bool = False,
    processing_time: str | None = "10 seconds",
    compact_every: int | None = None,
) -> StreamingQuery:
    """claim and load NEW tasks appended to the ledger by other writers.

    Several such queries may run on one ledger: of each task's claims one
    holds.  The guard (a NEW row may be claimed in any earlier batch) reads the
    snapshot's buckets of the polled keys and the log since the snapshot, so
    with ``compact_every`` a poll costs the same however long the history is.
    """
    new_rows = (
        spark.readStream.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "false")
        .parquet(layout.ledger)
        # tasks that wait for their type to be registered are left to retry_waiting
        .filter((F.col("state") == NEW) & ~F.col("state_info").eqNullSafe(F.lit(WAITING)))
    )

    def claim_and_load(batch: DataFrame, epoch: int) -> None:
        s = batch.sparkSession
        tasks = ledger_latest(batch.select("task_key", "task_id", "event_type", "content_ts", "data_path",
                                           "dest_table", "version"))
        with open_attempt(s, layout, LEDGER_POLL_BATCH_BASE + epoch, checkpoint) as attempt:
            # finished, or claimed by another batch; claims of this batch are a crashed attempt's, or a rival's
            newest = latest_of(s, layout.ledger, tasks)
            done = newest.filter(F.col("state").isin(*FINISHED) | (
                (F.col("state") == OPERATING) & (F.col("batch_id") != attempt.batch_id)))
            tasks = replay_guard(tasks.drop("version"), done.select("task_key"), "task_key").checkpoint(eager=True)
            load_tasks(s, tasks, registry_loader(), layout, attempt.batch_id, profile=profile, attempt=attempt)
        _maybe_compact(s, layout, epoch, compact_every)

    w = new_rows.writeStream.foreachBatch(claim_and_load).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, processing_time).start()


def orphaned_tasks(spark: SparkSession, layout: Layout) -> DataFrame:
    """Tasks whose newest ledger row is OPERATING (claimed, never finished)."""
    return ledger_latest(settled_ledger(spark, layout.ledger)).filter(F.col("state") == OPERATING)


def recover(spark: SparkSession, layout: Layout, registry: DataFrame, profile="quoted") -> list:
    """redo orphaned tasks, each under the batch id that claimed it.

    The crashed attempt is withdrawn and its rows in targets and rejects are
    cleared first, so nothing is loaded twice; tasks of attempts that still run
    are left to them.  Meant for tasks whose own batch will not be replayed
    (batch runs, ledger-born tasks); a stream replays its open batch itself from
    its checkpoint.
    """
    tasks = orphaned_tasks(spark, layout).select(
        "task_key", "task_id", "event_type", "content_ts", "data_path", "dest_table", "cmd_file", "batch_id"
    ).checkpoint(eager=True)
    crashed = sorted(r["batch_id"] for r in tasks.select("batch_id").distinct().collect())  # one row a crashed batch
    return [load_tasks(spark, tasks.filter(F.col("batch_id") == b).drop("batch_id"), registry, layout, b, profile=profile)
            for b in crashed]


def retry_waiting(spark: SparkSession, layout: Layout, registry: DataFrame, batch_id: int, profile="quoted"):
    """Load the tasks that waited for their event type, now that ``registry`` has it."""
    waiting = ledger_latest(settled_ledger(spark, layout.ledger)).filter(
        (F.col("state") == NEW) & F.col("state_info").eqNullSafe(F.lit(WAITING)))
    known = registry_active(registry).select("event_type").distinct()
    tasks = waiting.join(known, "event_type", "left_semi").select(
        "task_key", "task_id", "event_type", "content_ts", "data_path", "dest_table", "cmd_file").checkpoint(eager=True)
    return load_tasks(spark, tasks, registry, layout, batch_id, profile=profile)
