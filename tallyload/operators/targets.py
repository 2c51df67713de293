"""Targets and files: E1 append_load, E2 period_route, E3 reject_sink,
D1 queue_depth, D5 files_releasable, C4 period_tables_missing, E7 retention_plan.

A target is one table per family (``base[_cycle]``) partitioned by batch id,
attempt and period; ``dest_table`` (``base[_cycle][_period]``) stays a column.
The loader's own columns are stored with the prefix ``ld_``, so a data column
may be called ``period`` or ``batch_id``.  Every attempt of a batch writes
folders of its own, and nothing written earlier is ever overwritten.  Readers
see the attempts that committed (``operators.attempts``): the list of commits,
made from file names alone, is joined to the partition columns, so other
attempts' folders are pruned.  What an attempt left that did not finish is
cleared (``clear_attempt``) before the batch runs again.

An attempt writes its rejects in the same pass, into the period ``REJECTED`` of
its target; they move on to the rejects before the attempt commits.  Tasks over
the reject limit are named in the target's ``_refused`` folder, and their rows
are left out by every reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.functions.naming import UNSPLIT_PERIOD, file_extension
from tallyload.functions.states import ERROR, FINISHED, SUCCESSFUL
from tallyload.operators.attempts import Files, committed_attempts
from tallyload.operators.sizing import bounded_broadcast

# Extension of pipe inputs, always removed once read; policies.
PIPE_EXTENSION = "pipe4cep"
POLICIES = ("none", "delete")


#: The loader's columns of a target, as stored; ``read_target`` drops the prefix where no data column has that name.
LOADER_COLUMNS = "ld_task_key bigint, ld_dest_table string, ld_batch_id bigint, ld_attempt int, ld_period string"


def _loader_names() -> list[str]:
    return [c.strip().split(" ")[0] for c in LOADER_COLUMNS.split(",")]


#: Where an attempt's rejects wait, and what they carry; in good rows these columns are null.
REJECTED = "__rejected__"
REJECT_COLUMNS = ["ld_file", "ld_raw", "ld_reason"]
#: When a row was loaded, in milliseconds; the load times of its file come from it.
TIME_COLUMN = "ld_time"
_REFUSED_SCHEMA = "task_key bigint, batch_id bigint, attempt int"


def append_load(rows: DataFrame, target_path: str) -> None:
    """E1 + E2: append one attempt's rows to a family's target.

    ``rows`` carries the ``ld_`` columns.  No repartition: every data file
    belongs to a single period, so each task writes one file per split it read,
    and the only sort is the writer's local one.
    """
    rows.write.mode("append").partitionBy("ld_batch_id", "ld_attempt", "ld_period").parquet(target_path)


def attempt_load(rows: DataFrame, target_path: str, batch_id: int, attempt: int) -> None:
    """``append_load`` of one attempt, into the attempt's own folder, so that runs at the same time do not meet."""
    rows.write.mode("append").partitionBy("ld_period").parquet(f"{target_path}/{attempt_folder(batch_id, attempt)}")


def attempt_folder(batch_id: int, attempt: int) -> str:
    return f"ld_batch_id={batch_id}/ld_attempt={attempt}"


def drop_periods(spark, target_path: str, batch_id: int, attempt: int, periods: list[str]) -> None:
    """Remove periods of an attempt that has not committed, and folders that are empty then."""
    files, folder = Files(spark, target_path), attempt_folder(batch_id, attempt)
    for period in periods:
        files.delete(f"{folder}/ld_period={period}")
    for empty in (folder, folder.split("/")[0]):
        if files.exists(empty) and not files.names(empty):
            files.delete(empty)


def refuse_tasks(tasks: DataFrame, target_path: str, batch_id: int, attempt: int) -> None:
    """Rows of these tasks (``task_key``) will never be read; to be called before the attempt commits."""
    tasks.select("task_key").write.mode("append").parquet(f"{target_path}/_refused/batch_id={batch_id}/attempt={attempt}")


def clear_attempt(spark, targets_root: str, rejects_path: str, batch_id: int, attempt: int) -> None:
    """Remove what an attempt that did not finish wrote to any family's target and to the rejects.

    Deletes one folder per family, through Hadoop's FileSystem.
    """
    targets, rejects = Files(spark, targets_root), Files(spark, rejects_path)
    for family in targets.names(""):
        targets.delete(f"{family}/{attempt_folder(batch_id, attempt)}")
        targets.delete(f"{family}/_refused/batch_id={batch_id}/attempt={attempt}")
        if not targets.names(f"{family}/ld_batch_id={batch_id}"):
            targets.delete(f"{family}/ld_batch_id={batch_id}")
    rejects.delete(f"batch_id={batch_id}/attempt={attempt}")


def _root_of(target_path: str) -> str:
    """The deployment's root: a target is ``<root>/targets/<family>``."""
    return target_path.rstrip("/").rsplit("/", 2)[0]


def _has_rows(files: Files) -> bool:
    return any(n.startswith("ld_batch_id=") for n in files.names(""))


def committed_rows(spark, target_path: str) -> DataFrame:
    """A target as stored, without attempts that have not committed, their rejects, and refused tasks."""
    files = Files(spark, target_path)
    df = spark.read.parquet(target_path)
    df = df.where(F.col("ld_period").cast("string") != REJECTED).drop(*REJECT_COLUMNS, TIME_COLUMN)
    commits = committed_attempts(spark, _root_of(target_path))
    if commits is not None:
        commits = bounded_broadcast(commits.select(F.col("batch_id").alias("_b"), F.col("attempt").alias("_a")).where("_a >= 0"))
        df = df.join(commits, (F.col("ld_batch_id") == F.col("_b")) & (F.col("ld_attempt") == F.col("_a")), "left_semi")
    if files.names("_refused"):
        refused = bounded_broadcast(spark.read.schema(_REFUSED_SCHEMA).parquet(f"{target_path}/_refused"))
        df = df.join(refused, (F.col("ld_batch_id") == F.col("batch_id")) & (F.col("ld_attempt") == F.col("attempt"))
                     & (F.col("ld_task_key") == refused["task_key"]), "left_anti")
    return df


def read_target(spark, target_path: str, columns: str | None = None) -> DataFrame:
    """A family's target: its data columns, then ``task_key, dest_table, batch_id, attempt, period``
    (a loader column keeps its ``ld_`` prefix where the data has a column of that name).

    Rows of committed attempts only.  A target that has no rows yet (nothing
    written, or every file rejected) reads as an empty frame with the declared
    ``columns``, when given.
    """
    if columns is not None and not _has_rows(Files(spark, target_path)):
        from pyspark.sql import types as T

        from tallyload.functions.ddl import declared_schema

        fields = declared_schema(columns).read.fields
        extra = spark.createDataFrame([], LOADER_COLUMNS).schema.fields
        df = spark.createDataFrame([], T.StructType(list(fields) + list(extra)))
    else:
        df = committed_rows(spark, target_path)
    # partition discovery would read the period 202401 back as a number
    df = df.withColumn("ld_period", F.col("ld_period").cast("string"))
    own = _loader_names()
    data = [c for c in df.columns if c not in own]
    plain = {c: c[3:] if c[3:] not in data else c for c in own}
    return df.select(*[F.col(f"`{c}`") for c in data], *[F.col(c).alias(plain[c]) for c in own])


def existing_tables(spark, target_path: str) -> DataFrame:
    """Target table names present in a family's target: ``family`` or ``family_period``.

    Taken from a listing of the committed attempts' folders; no data file is
    opened.  Tables that a ledger row named itself are not told apart by
    folder; take those from the ledger's ``dest_table``.
    """
    if not _has_rows(Files(spark, target_path)):
        return spark.createDataFrame([], "dest_table string")
    family = target_path.rstrip("/").rsplit("/", 1)[-1]
    pattern = r"/ld_batch_id=(-?\d+)/ld_attempt=(\d+)/ld_period=([^/]+)/[^/]+$"
    part = lambda i: F.regexp_extract("path", pattern, i)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(target_path)
    folders = listed.select("path").where(F.col("path").rlike(pattern)).select(
        part(1).cast("bigint").alias("batch_id"), part(2).cast("int").alias("attempt"), F.try_url_decode(part(3)).alias("p")).distinct()
    commits = committed_attempts(spark, _root_of(target_path))
    if commits is not None:
        folders = folders.join(bounded_broadcast(commits), ["batch_id", "attempt"], "left_semi")
    return folders.where(F.col("p") != REJECTED).select(F.when(F.col("p") == UNSPLIT_PERIOD, F.lit(family)).otherwise(
        F.concat(F.lit(family + "_"), F.col("p"))).alias("dest_table")).distinct()


def period_view(spark, target_path: str, family: str, dest_table: str, view_name: str | None = None) -> DataFrame:
    """E2 on demand: one period table of a family as a (temporary) view.

    The period is the part of ``dest_table`` after ``family_``, so the read
    is pruned to that partition.
    """
    prefix = family + "_"
    period = dest_table[len(prefix):] if dest_table.startswith(prefix) else "all"
    df = read_target(spark, target_path)
    own = lambda c: F.col(c if f"ld_{c}" not in df.columns else f"ld_{c}")
    df = df.filter((own("period") == period) & (own("dest_table") == dest_table))
    df.createOrReplaceTempView(view_name or dest_table)
    return df


def reject_sink(bad_rows: DataFrame, path: str, **partition) -> None:
    """Append rejected rows (file, raw text, reason, task) to the folder of a partition (batch, attempt, family)."""
    folder = "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in partition.items()]])
    bad_rows.drop(*partition).write.mode("append").parquet(folder)


def queue_depth(tasks: DataFrame) -> DataFrame:
    """Waiting tasks, oldest content time and bytes per target table."""
    aggs = [F.count(F.lit(1)).alias("tasks"), F.min("content_ts").alias("oldest")]
    if "data_size" in tasks.columns:
        aggs.append(F.sum("data_size").cast("bigint").alias("bytes"))
    return tasks.groupBy("dest_table").agg(*aggs)


def files_releasable(latest: DataFrame, path_col: str = "data_path") -> DataFrame:
    """Data files whose every task is finished, with the task count."""
    return (
        latest.groupBy(path_col)
        .agg(F.count(F.lit(1)).alias("refs"), F.count_if(~F.col("state").isin(*FINISHED)).alias("_open"))
        .filter(F.col("_open") == 0)
        .drop("_open")
    )


def period_tables_missing(needed: DataFrame, existing: DataFrame, col: str = "dest_table") -> DataFrame:
    """C4: target tables needed but not present (EXCEPT DISTINCT)."""
    return needed.select(col).subtract(existing.select(col))


def retention_plan(latest: DataFrame, success_policy: str = "none", failure_policy: str = "none",
                   path_col: str = "data_path") -> DataFrame:
    """What to do with each data file once its tasks are done.

    A pipe input goes as soon as a task has finished with it.  Any other file
    goes only when every task naming it has finished and, for each, the
    policy of its outcome (success or failure) is ``delete``.
    Returns ``path, action (delete|keep), reason``.
    """
    for p in (success_policy, failure_policy):
        if p not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}, not {p!r}")
    releases = (
        (F.col("state") == SUCCESSFUL) & F.lit(success_policy == "delete")
    ) | ((F.col("state") == ERROR) & F.lit(failure_policy == "delete"))
    per_file = latest.groupBy(F.col(path_col).alias("path")).agg(
        F.count_if(~F.col("state").isin(*FINISHED)).alias("_open"),
        F.count_if(F.col("state").isin(*FINISHED)).alias("_done"),
        F.count_if(~releases).alias("_held"),
    )
    pipe = file_extension("path") == PIPE_EXTENSION
    action = F.when(pipe & (F.col("_done") > 0), "delete").when(
        (F.col("_open") == 0) & (F.col("_held") == 0), "delete"
    ).otherwise("keep")
    reason = (
        F.when(pipe & (F.col("_done") > 0), "pipe")
        .when(F.col("_open") > 0, "in_use")
        .when(F.col("_held") == 0, "released")
        .otherwise("policy_keep")
    )
    return per_file.select("path", action.alias("action"), reason.alias("reason"))


def apply_retention(plan: DataFrame, confirm: bool = False) -> DataFrame:
    """Remove the files a plan marks ``delete``; off unless ``confirm``.

    Runs on the executors, once, when called; returns ``path, removed, error``
    of what was done.  A path without a scheme means the session's default file
    system, as for the loader.  Paths on file systems that ``pyarrow`` does not
    know are not removed and say so in ``error``.
    """
    from tallyload.sources.datafiles import default_filesystem

    todo = plan.filter(F.col("action") == "delete").select("path")
    if not confirm:
        return todo.select("path", F.lit(False).alias("removed"), F.lit("not confirmed").alias("error"))
    default_fs = default_filesystem(plan.sparkSession).rstrip("/")

    def remove(batches):
        import pyarrow.fs as pafs

        for pdf in batches:
            removed, errors = [], []
            for p in pdf["path"]:
                try:
                    if "://" not in p and not p.startswith("file:") and not default_fs.startswith("file:"):
                        p = default_fs + "/" + p.lstrip("/")
                    if p.startswith("file:") or "://" not in p:
                        fs, rel = pafs.LocalFileSystem(), "/" + p.removeprefix("file:").lstrip("/")
                    else:
                        scheme, rest = p.split("://", 1)
                        fs, rel = pafs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + "://" + rest)
                    fs.delete_file(rel)
                    removed.append(True)
                    errors.append(None)
                except Exception as e:  # reported, never raised
                    removed.append(False)
                    errors.append(str(e))
            yield pdf.assign(removed=removed, error=errors)

    # checkpointed, so that looking at the outcome again deletes nothing again
    return todo.mapInPandas(remove, "path string, removed boolean, error string").checkpoint(eager=True)
