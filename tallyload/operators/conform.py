"""B8 conform, B9 split_rejects, D6 reject_limit, C6 load_fanout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.functions.ddl import CORRUPT_COLUMN, RAW_COLUMN, DeclaredSchema
from tallyload.functions.naming import normalize_path
from tallyload.operators.sizing import bounded_broadcast

# Reject reasons for rows.
MALFORMED = "malformed"


def conform(rows: DataFrame, schema: DeclaredSchema) -> DataFrame:
    """Add ``_reason``: NULL for a good row, else why the row is rejected.

    A row is malformed when the reader could not fit it to the declared
    fields (bad cast, too few or too many fields); then ``not null`` and
    ``varchar(n)`` rules apply in declaration order.
    """
    reason = F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(MALFORMED))
    for r in schema.rules:
        c = F.col(f"`{r.column}`")
        if r.kind == "not_null":
            reason = reason.when(c.isNull(), F.lit(f"null:{r.column}"))
        elif r.kind == "max_length":
            reason = reason.when(F.length(c) > r.limit, F.lit(f"too_long:{r.column}"))
    return rows.withColumn("_reason", reason)


def raw_text(conformed: DataFrame, schema: DeclaredSchema):
    """The record as it was read: the scan's ``RAW_COLUMN``, else the corrupt record, else the fields written again."""
    if RAW_COLUMN in conformed.columns:
        return F.col(RAW_COLUMN)
    return F.coalesce(F.col(CORRUPT_COLUMN), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in schema.names])))


def split_rejects(conformed: DataFrame, schema: DeclaredSchema) -> tuple[DataFrame, DataFrame]:
    """(good rows with declared columns + extras, reject rows ``_file, raw, reason`` + extras)."""
    extras = [c for c in conformed.columns if c not in set(schema.names) | {CORRUPT_COLUMN, RAW_COLUMN, "_reason"}]
    good = conformed.filter(F.col("_reason").isNull()).select(*[F.col(f"`{n}`") for n in schema.names], *extras)
    bad = conformed.filter(F.col("_reason").isNotNull()).select(
        *extras, raw_text(conformed, schema).alias("raw"), F.col("_reason").alias("reason")
    )
    return good, bad


def reject_limit(conformed: DataFrame, limit: int | None, file_col: str = "_file") -> DataFrame:
    """Per file: ``rows``, ``rejects`` and ``admitted`` (rejects within the limit).

    For rows of ``data_scan``, which parses whole records whatever columns are
    used afterwards.  The loader itself counts the rejects that it has written.
    """
    stats = conformed.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_reason").isNotNull()).alias("rejects"))
    admitted = F.lit(True) if limit is None else (F.col("rejects") <= F.lit(limit))
    return stats.withColumn("admitted", admitted)


def load_fanout(rows: DataFrame, tasks: DataFrame, task_cols: list[str], path_col: str = "data_path") -> DataFrame:
    """Give each task that names a file the rows of that file.

    ``tasks`` is one micro-batch's task list (one row per task), broadcast
    when its size is within bounds; the data side is never shuffled then.
    """
    from tallyload.sources.datafiles import default_filesystem

    t = tasks.select(normalize_path(F.col(path_col), default_fs=default_filesystem(rows.sparkSession)).alias("_file"), *task_cols)
    return rows.join(bounded_broadcast(t), "_file", "inner")
