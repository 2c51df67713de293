"""run_batch: command lines -> loaded targets, rejects and ledger rows.

    A1/F1 lines -> B1 B2 (B3) -> C1 C2 (B5 names) -> C5 replay guard
      -> E5 claim (OPERATING) -> A7 sizes -> per family: A4..A6 scan, B8 B9,
      C6 fan-out -> E1/E2 targets, E3 rejects, D6 admission -> E4 final rows
      -> commit

One Spark job set per registry family (a handful per batch; each needs its
own schema), never one per file.  Order on finish: data, rejects, ledger,
commit.

Every run under a batch id is an attempt of its own (``operators.attempts``):
it claims its tasks against all running rivals, writes into folders of the
attempt, ends with the tasks' final ledger rows and commits.  Earlier attempts
are never overwritten, so an id can be used again for further commands.  Readers
see committed attempts only.  An attempt that never committed is withdrawn and
cleared by the next run of its batch id, and its tasks, still OPERATING, run
again.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
import os
import sys
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.functions.ddl import declared_schema
from tallyload.functions.naming import UNSPLIT_PERIOD, normalize_path, period_of
from tallyload.functions.states import ERROR, FINISHED, NEW, OPERATING, SUCCESSFUL, WAITING
from tallyload.operators.attempts import Attempt, Files, claim_step, final_step
from tallyload.operators.commands import classify_commands, last_command_per_file, PARSED_COLUMNS
from tallyload.operators.conform import conform, load_fanout, raw_text
from tallyload.operators.ledger import (
    assign_task_ids,
    latest_of,
    latest_state,
    ledger_rows,
    ledger_write,
    read_ledger,
    replay_guard,
    settled_ledger,
)
from tallyload.operators.registry import commands_unregistered, registry_resolve
from tallyload.operators.sizing import bounded_broadcast
from tallyload.operators.targets import (
    REJECTED,
    TIME_COLUMN,
    attempt_folder,
    attempt_load,
    clear_attempt,
    drop_periods,
    refuse_tasks,
    reject_sink,
)
from tallyload.sources.datafiles import data_scan, file_inventory
from tallyload.sources.profiles import PROFILES, LoadProfile

_TRACE = os.environ.get("TALLYLOAD_TRACE") == "1"


class _Clock:
    """Step timings on stderr when TALLYLOAD_TRACE=1."""

    def __init__(self):
        self.t = time.perf_counter()

    def lap(self, what: str) -> None:
        if _TRACE:
            now = time.perf_counter()
            print(f"[tallyload] {what}: {now - self.t:.2f}s", file=sys.stderr, flush=True)
            self.t = now


@dataclass(frozen=True)
class Layout:
    """Where a deployment keeps its tables (a shared file system on a cluster)."""

    root: str

    @property
    def targets(self) -> str:
        return f"{self.root}/targets"

    def target(self, family: str) -> str:
        return f"{self.targets}/{family}"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def command_rejects(self) -> str:
        return f"{self.root}/command_rejects"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"


@dataclass
class BatchResult:
    batch_id: int
    families: list[str] = field(default_factory=list)
    layout: Layout | None = None

    def ledger(self, spark: SparkSession) -> DataFrame:
        return read_ledger(spark, self.layout.ledger).filter(F.col("batch_id") == self.batch_id)


def _profile_for(profile, event_type: int, family: str) -> LoadProfile:
    if isinstance(profile, LoadProfile):
        return profile
    if isinstance(profile, str):
        return PROFILES[profile]
    if isinstance(profile, dict):
        p = profile.get(event_type, profile.get(family, "quoted"))
        return PROFILES[p] if isinstance(p, str) else p
    raise TypeError("profile must be a LoadProfile, a profile name or a dict")


def _few(df: DataFrame) -> DataFrame:
    """Ledger rows (one per task) built from unions of small frames: no more
    write tasks than the cluster has cores."""
    return df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_batch(
    spark: SparkSession,
    lines: DataFrame,
    registry: DataFrame,
    layout: Layout,
    batch_id: int,
    profile="quoted",
    keep: str = "all",
    parse_options: dict | None = None,
    guard_scope: str = "all",
    task_ids: str = "key",
    parallel_families: int = 4,
    owner: str | None = None,
) -> BatchResult:
    """Load one batch of command lines (``cmd_file, line_pos, raw``, or the
    unnumbered ``cmd_file, _bs, _mid, raw`` of ``command_scan(positions=False)``).

    ``guard_scope``: ``"all"`` skips tasks finished in any earlier batch (reads
    the snapshot's buckets of this batch's keys and the log since); ``"batch"`` only looks at this batch id's ledger
    folder -- enough for a stream, whose source hands
    each command file to exactly one batch, and it does not grow with history.

    ``task_ids``: ``"key"`` uses the task key as id; ``"sequence"`` numbers the
    batch's tasks after the ledger's largest id in arrival order (file, line)
    -- the reference's numbering; the key stays the identity on replays.

    ``parallel_families``: how many target families load at the same time.

    ``owner``: who runs this, e.g. a stream's checkpoint.  A run takes over its
    owner's earlier attempts at once; other owners' attempts only after their
    lease went stale.  Runs of different owners share a batch id safely.
    """
    if guard_scope not in ("all", "batch"):
        raise ValueError("guard_scope must be 'all' or 'batch'")
    if keep not in ("all", "last"):
        raise ValueError("keep must be 'all' or 'last'")
    if task_ids not in ("key", "sequence"):
        raise ValueError("task_ids must be 'key' or 'sequence'")
    with open_attempt(spark, layout, batch_id, owner) as attempt:
        return _run(spark, lines, registry, layout, attempt, profile, keep, parse_options, guard_scope, task_ids, parallel_families)


def _run(spark, lines, registry, layout, attempt, profile, keep, parse_options, guard_scope, task_ids, parallel_families) -> BatchResult:
    gen_time, batch_id = _now(), attempt.batch_id
    clock = _Clock()
    classified = classify_commands(lines, **(parse_options or {})).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    bad_cmds = classified.filter(F.col("reason").isNotNull()).select(
        "task_key", "cmd_file", "line_pos", "raw", "reason", F.lit(batch_id).cast("bigint").alias("batch_id")
    )
    if bad_cmds.limit(1).count():  # read from the cached lines; nothing to write otherwise
        known = _written(spark, f"{layout.command_rejects}/batch_id={batch_id}")
        if known is not None:  # lines that an earlier run of this id has recorded
            bad_cmds = bad_cmds.join(known.select("task_key"), "task_key", "left_anti")
        reject_sink(bad_cmds, layout.command_rejects, batch_id=batch_id)
    clock.lap("parse + command rejects")
    cmds = classified.filter(F.col("reason").isNull()).select(*PARSED_COLUMNS)
    if keep == "last":
        cmds = last_command_per_file(cmds)
    # read after the attempt was opened: what others claim from here on is seen when this attempt claims
    if guard_scope == "all":
        done = latest_of(spark, layout.ledger, cmds)
    else:
        done = latest_state(settled_ledger(spark, layout.ledger, batch_id))
    done = done.filter(F.col("state").isin(*FINISHED)).select("task_key")
    # materialised reliably: what is claimed below must not change with the ledger
    cmds = replay_guard(cmds, done, "task_key").checkpoint(eager=True)
    if task_ids == "sequence":
        top = read_ledger(spark, layout.ledger).agg(F.max("task_id"))
        cmds = assign_task_ids(cmds, ["cmd_file", "line_pos"], top)
    classified.unpersist()
    clock.lap("replay guard")
    return load_tasks(spark, cmds, registry, layout, batch_id, profile, gen_time, parallel_families, attempt)


def open_attempt(spark: SparkSession, layout: Layout, batch_id: int, owner: str | None = None) -> Attempt:
    """A new attempt of a batch id; what crashed ones left is withdrawn and cleared first."""
    attempt = Attempt(spark, layout.root, batch_id, owner)
    try:
        for number in attempt.crashed():
            Files(spark, layout.ledger).delete(f"batch_id={batch_id}/step={final_step(number)}")
            clear_attempt(spark, layout.targets, layout.rejects, batch_id, number)
    except BaseException:
        attempt.close()
        raise
    return attempt


def load_tasks(
    spark: SparkSession,
    cmds: DataFrame,
    registry: DataFrame,
    layout: Layout,
    batch_id: int,
    profile="quoted",
    gen_time: dt.datetime | None = None,
    parallel_families: int = 4,
    attempt: Attempt | None = None,
) -> BatchResult:
    """Claim, load and record tasks (``task_key, event_type, data_path, content_ts``, ...).

    A ``dest_table`` already on a task (ledger-born tasks) is kept as given.
    ``attempt`` is one that was opened before ``cmds`` was compared with the
    ledger; without it one is opened here.  Tasks that a running rival has
    claimed, or that one finished meanwhile, are left to it.
    """
    if attempt is None:
        with open_attempt(spark, layout, batch_id) as own:
            return load_tasks(spark, cmds, registry, layout, batch_id, profile, gen_time, parallel_families, own)
    gen_time = gen_time or _now()
    clock = _Clock()
    claim_no, final_no = claim_step(attempt.number), final_step(attempt.number)
    given_dest = "dest_table" in cmds.columns
    if given_dest:
        cmds = cmds.withColumnRenamed("dest_table", "_given_dest")
    registry = bounded_broadcast(registry)  # checked once for the whole batch
    while True:
        last, rivals = attempt.rivals()
        for b, number in rivals:
            claimed = spark.read.schema("task_key bigint").parquet(f"{layout.ledger}/batch_id={b}/step={claim_step(number)}")
            cmds = cmds.join(claimed.select("task_key"), "task_key", "left_anti")
        resolved = registry_resolve(cmds, registry, checked=True).withColumn(
            "period", F.coalesce(period_of("split_mode", "content_ts"), F.lit(UNSPLIT_PERIOD))
        )
        if given_dest:
            resolved = resolved.withColumn("dest_table", F.coalesce("_given_dest", "dest_table")).drop("_given_dest")
        inv = file_inventory(resolved, "data_path").withColumnRenamed("path", "data_path")
        tasks = resolved.join(inv, "data_path", "left")
        if "task_id" not in tasks.columns:
            tasks = tasks.withColumn("task_id", F.col("task_key"))
        tasks = tasks.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        claim = ledger_rows(tasks, batch_id, claim_no, state=OPERATING, gen_time=gen_time, exec_start=gen_time)
        ledger_write(_few(claim), layout.ledger, batch_id, claim_no)
        if attempt.claim(last + 1):
            break
        # a rival claimed in between: these rows never held
        Files(spark, layout.ledger).delete(f"batch_id={batch_id}/step={claim_no}")
        tasks.unpersist()
    unregistered = commands_unregistered(cmds, registry, checked=True)
    if given_dest:
        unregistered = unregistered.withColumnRenamed("_given_dest", "dest_table")
    if "task_id" not in unregistered.columns:
        unregistered = unregistered.withColumn("task_id", F.col("task_key"))
    clock.lap("resolve + inventory + claim")

    def failed(rows: DataFrame, info, start: dt.datetime | None = None) -> DataFrame:
        return ledger_rows(rows, batch_id, final_no, state=ERROR, state_info=info, gen_time=gen_time,
                           exec_start=start or gen_time, exec_end=_now())

    # the reader passes over names that begin with "_" or ".", so such a file would load no rows unnoticed
    hidden = F.regexp_extract("data_path", "([^/]*)$", 1).rlike("^[_.]")
    finals = [
        # not taken yet: a later run or retry_waiting loads it once its type is registered
        ledger_rows(unregistered, batch_id, final_no, state=NEW, state_info=WAITING, gen_time=gen_time),
        failed(tasks.filter(~F.col("file_exists") & ~hidden), "data file missing"),
        failed(tasks.filter(hidden), "data file has a hidden name (leading _ or .)"),
    ]
    present = tasks.filter(F.col("file_exists") & ~hidden)
    # one row per (family, file) of this batch: the families and each one's file list
    files = present.groupBy("family", "columns", "event_type", "data_path").count().collect()
    families = sorted({(r["family"], r["columns"], r["event_type"]) for r in files}, key=lambda x: (x[0], x[2]))
    clock.lap("families")
    members: dict[str, list[tuple[str, int]]] = {}
    for family, columns, event_type in families:
        members.setdefault(family, []).append((columns, event_type))

    emptied: list[tuple[str, list[str]]] = []  # periods of refused files alone

    # one target write and at most one reject write per family, whatever the
    # number of event types feeding it
    def load_family(family: str, types: list[tuple[str, int]]) -> list[DataFrame]:
        out, parts, start = [], [], _now()
        for columns, event_type in types:
            prof = _profile_for(profile, event_type, family)
            fam_tasks = present.filter((F.col("family") == family) & (F.col("event_type") == event_type))
            try:
                schema = declared_schema(columns)
            except Exception as e:  # a bad registry row fails its tasks, not the batch
                out.append(failed(fam_tasks, f"invalid registry columns: {e}".strip(), start))
                continue
            paths = sorted(r["data_path"] for r in files if (r["family"], r["event_type"]) == (family, event_type))
            parts.append((prof, schema, fam_tasks, paths))
        if parts:
            try:
                out += write_family(family, parts, start)
            except Exception as first:
                # find the files that cannot be read, fail their tasks, load the others
                broken = [_unreadable(spark, paths, schema, prof) for prof, schema, _, paths in parts]
                if not any(broken):
                    out += [failed(t, str(first), start) for _, _, t, _ in parts]
                else:
                    rest = []
                    for (prof, schema, t, paths), bad in zip(parts, broken):
                        if bad:
                            errors = spark.createDataFrame(sorted(bad.items()), "data_path string, _error string")
                            out.append(failed(t.join(errors, "data_path"), F.col("_error"), start))
                            t = t.join(errors.select("data_path"), "data_path", "left_anti")
                        if len(bad) < len(paths):
                            rest.append((prof, schema, t, [p for p in paths if p not in bad]))
                    if rest:
                        try:
                            out += write_family(family, rest, start)
                        except Exception as e:
                            out += [failed(t, str(e), start) for _, _, t, _ in rest]
        return out

    def write_family(family: str, parts: list, start: dt.datetime) -> list[DataFrame]:
        target, folder = layout.target(family), attempt_folder(batch_id, attempt.number)
        # one pass: good rows go to their periods, rejects with their text to a period of their own
        written = None
        for prof, schema, fam_tasks, paths in parts:
            rows = conform(data_scan(spark, paths, schema, prof), schema)
            bad = F.col("_reason").isNotNull()
            rows = rows.select(
                *[F.col(f"`{n}`") for n in schema.names], F.col("_file"), F.when(bad, F.col("_file")).alias("ld_file"),
                F.when(bad, raw_text(rows, schema)).alias("ld_raw"), F.col("_reason").alias("ld_reason"),
                # the clock of the task that loads the row
                F.java_method(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("bigint").alias(TIME_COLUMN))
            task_cols = [F.col("task_key").alias("ld_task_key"), F.col("dest_table").alias("ld_dest_table"), F.col("period").alias("ld_period")]
            rows = load_fanout(rows, fam_tasks, task_cols).drop("_file").withColumn(
                "ld_period", F.when(F.col("ld_reason").isNull(), F.col("ld_period")).otherwise(F.lit(REJECTED)))
            written = rows if written is None else written.unionByName(rows, allowMissingColumns=True)
        attempt_load(written, target, batch_id, attempt.number)
        clock.lap(f"{family}: targets")
        periods = [n.split("=", 1)[1] for n in Files(spark, target).names(folder) if n.startswith("ld_period=")]
        rejects = None
        if REJECTED in periods:
            waiting = spark.read.parquet(f"{target}/{folder}/ld_period={REJECTED}")
            reject_sink(waiting.select(
                F.col("ld_task_key").alias("task_key"), F.col("ld_file").alias("data_path"), F.col("ld_dest_table").alias("dest_table"),
                F.col("ld_raw").alias("raw"), F.col("ld_reason").alias("reason")), layout.rejects,
                batch_id=batch_id, attempt=attempt.number, family=family)
            drop_periods(spark, target, batch_id, attempt.number, [REJECTED])
            rejects = spark.read.parquet(f"{layout.rejects}/batch_id={batch_id}/attempt={attempt.number}/family={family}")
        clock.lap(f"{family}: rejects")
        # what was written, counted by task from two columns
        loaded = spark.read.parquet(f"{target}/{folder}") if set(periods) - {REJECTED} else None
        end, out, limited = _now(), [], []
        for prof, _, fam_tasks, _ in parts:
            done = _with_count(_with_times(fam_tasks, loaded), rejects, "task_key", "_rejects")
            limit = F.lit(prof.reject_limit if rejects is not None else None).cast("bigint")
            admitted = F.coalesce(F.col("_rejects") <= limit, F.lit(True))
            info = F.when(admitted, F.format_string("loaded %d rows, %d rejected", F.col("_rows"), F.col("_rejects"))
                          ).otherwise(F.format_string("reject limit %d exceeded: %d rejected", limit, F.col("_rejects")))
            # a file's own times; the family's for files of which no row was loaded
            out.append(ledger_rows(done, batch_id, final_no, state=F.when(admitted, F.lit(SUCCESSFUL)).otherwise(F.lit(ERROR)),
                                   state_info=info, gen_time=gen_time, exec_start=F.coalesce("_began", F.lit(start)),
                                   exec_end=F.coalesce("_ended", F.lit(end))))
            if prof.reject_limit is not None and rejects is not None:
                limited.append(done.where(~admitted).select("task_key"))
        if limited:
            refused = limited[0]
            for r in limited[1:]:
                refused = refused.unionByName(r)
            refused = refused.checkpoint(eager=True)
            if refused.limit(1).count():
                refuse_tasks(refused, target, batch_id, attempt.number)
                if loaded is not None:
                    left = loaded.join(refused, F.col("ld_task_key") == F.col("task_key"), "left_anti").select("ld_period").distinct()
                    kept = {str(r["ld_period"]) for r in left.collect()}  # a row a period of this batch
                    emptied.append((target, sorted(set(periods) - {REJECTED} - kept)))
        return out

    # different families load in parallel (separate targets), each one's event
    # types in one write
    ordered = sorted(members.items())
    with ThreadPoolExecutor(max_workers=max(1, min(len(ordered), parallel_families))) as pool:
        for fam_rows in pool.map(lambda kv: load_family(*kv), ordered):
            finals.extend(fam_rows)
    done_families = [f for f, _ in ordered]
    final = finals[0]
    for f in finals[1:]:
        final = final.unionByName(f)
    ledger_write(_few(final), layout.ledger, batch_id, final_no)
    clock.lap("final ledger rows")
    for target, periods in emptied:  # only now: the final rows counted what they hold
        drop_periods(spark, target, batch_id, attempt.number, periods)
    attempt.commit()  # from here on readers see the rows, and the ledger's final rows count
    tasks.unpersist()
    return BatchResult(batch_id, done_families, layout)


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    """A folder of written rows, or None where there is none."""
    return spark.read.parquet(path) if Files(spark, path).exists() else None


def _with_times(tasks: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Tasks with their number of loaded rows and the times of the first and the last."""
    if loaded is None:
        none = F.lit(None).cast("timestamp")
        return tasks.withColumn("_rows", F.lit(0).cast("bigint")).withColumn("_began", none).withColumn("_ended", none)
    n = loaded.groupBy(F.col("ld_task_key").alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.timestamp_millis(F.min(TIME_COLUMN)).alias("_began"), F.timestamp_millis(F.max(TIME_COLUMN)).alias("_ended"))
    return tasks.join(n, F.col("task_key") == F.col("_k"), "left").withColumn("_rows", F.coalesce("_n", F.lit(0))).drop("_k", "_n")


def _with_count(tasks: DataFrame, written: DataFrame | None, key: str, name: str) -> DataFrame:
    """Tasks with the number of written rows of each."""
    if written is None:
        return tasks.withColumn(name, F.lit(0).cast("bigint"))
    n = written.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return tasks.join(n, F.col("task_key") == F.col("_k"), "left").withColumn(name, F.coalesce("_n", F.lit(0))).drop("_k", "_n")


def _unreadable(spark: SparkSession, paths: list[str], schema, prof) -> dict[str, str]:
    """Files that cannot be read, with the error, found by halving; only used after a failed write."""
    try:
        data_scan(spark, paths, schema, prof).write.format("noop").mode("overwrite").save()
        return {}
    except Exception as e:
        if len(paths) == 1:
            return {paths[0]: str(e)}
    half = len(paths) // 2
    return _unreadable(spark, paths[:half], schema, prof) | _unreadable(spark, paths[half:], schema, prof)
