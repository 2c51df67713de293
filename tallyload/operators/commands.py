"""B1 command_parse, B2 command_rejects, B3 last_command_per_file.

A command line is ``source,event_type,data_path,content_ts,stamp,cycle``.
Quote characters are dropped first, trailing empty fields are not counted,
and exactly ``n_fields`` fields must remain.  ``event_type`` must be a plain
integer (sign allowed, no blanks); ``content_ts`` is read by B4.
"""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyload.functions.timestamps import content_timestamp
from tallyload.operators.sizing import MAX_BROADCAST_BYTES

# Command layout (field count, delimiter) and reject reasons.
COMMAND_FIELDS = 6
COMMAND_DELIMITER = ","
BAD_FIELD_COUNT = "bad_field_count"
BAD_EVENT_TYPE = "bad_event_type"
BAD_TIMESTAMP = "bad_timestamp"

PARSED_COLUMNS = [
    "task_key", "cmd_file", "line_pos", "raw", "source_id", "event_type", "data_path", "content_ts",
]


def classify_commands(
    lines: DataFrame,
    delimiter: str = COMMAND_DELIMITER,
    n_fields: int = COMMAND_FIELDS,
    twelve_as_midnight: bool = False,
    fraction: str = "millis",
) -> DataFrame:
    """All lines with parsed fields and ``reason`` (NULL when the line is good).

    ``lines`` has ``cmd_file, line_pos, raw``, or ``cmd_file, _bs, _mid, raw``
    straight from a scan: then every line is parsed in its scan task and
    ``line_pos`` is added last (it needs a per-split window).
    """
    d = re.escape(delimiter)
    text = F.regexp_replace(F.translate(F.col("raw"), '"', ""), f"(?:{d})+$", "")
    fields = F.split(text, d)
    field = lambda i: F.try_element_at(F.col("_f"), F.lit(i + 1))
    ev_text = field(1)
    event_type = F.when(ev_text.rlike(r"^[+-]?[0-9]+$"), ev_text.try_cast("int"))
    df = lines.withColumn("_f", fields).select(
        "*",
        F.size("_f").alias("_n"),
        field(0).alias("source_id"),
        event_type.alias("event_type"),
        field(2).alias("data_path"),
        content_timestamp(field(3), twelve_as_midnight, fraction).alias("content_ts"),
    )
    reason = (
        F.when(F.col("_n") != n_fields, F.lit(BAD_FIELD_COUNT))
        .when(F.col("event_type").isNull(), F.lit(BAD_EVENT_TYPE))
        .when(F.col("content_ts").isNull(), F.lit(BAD_TIMESTAMP))
    )
    df = df.withColumn("reason", reason).drop("_f", "_n")
    # A filter on ``reason`` would otherwise be pushed below this projection
    # with the whole parse inlined into it, computing it twice; a predicate on
    # a generator's output stays above the generator, so it is computed once.
    df = df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
    seen = lines.select(F.xxhash64("cmd_file", "raw").alias("_line"))
    if "line_pos" not in df.columns:
        from tallyload.sources.commands import with_line_positions

        df = with_line_positions(df)
    return _numbered(df, seen)


def _numbered(df: DataFrame, seen: DataFrame) -> DataFrame:
    """Add ``task_key``: a task is a line of a file and, among equal lines of it, a number.

    So the keys are the same whatever splits the file was read in.  Only lines
    that may occur more than once in their file are brought together to be
    numbered; ``seen`` has a hash of every line, and hashes alone are counted.
    All other lines stay where they were read.
    """
    key = F.xxhash64("cmd_file", "raw", "_nth")
    again = seen.groupBy("_line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_line").persist(StorageLevel.MEMORY_AND_DISK)
    size = again.count()  # kept for the joins below
    first = df.withColumn("_nth", F.lit(1))
    if not size:
        again.unpersist()
        return first.withColumn("task_key", key).drop("_nth")
    again = F.broadcast(again) if size <= MAX_BROADCAST_BYTES // 16 else again
    on = F.xxhash64("cmd_file", "raw") == F.col("_line")
    nth = F.row_number().over(Window.partitionBy("cmd_file", "raw").orderBy("line_pos"))
    repeated = df.join(again, on, "left_semi").withColumn("_nth", nth)
    return first.join(again, on, "left_anti").unionByName(repeated).withColumn("task_key", key).drop("_nth")


def command_parse(lines: DataFrame, **kw) -> DataFrame:
    """Good command lines: ``task_key, cmd_file, line_pos, raw, source_id, event_type, data_path, content_ts``."""
    c = classify_commands(lines, **kw)
    return c.filter(F.col("reason").isNull()).select(*PARSED_COLUMNS)


def command_rejects(lines: DataFrame, **kw) -> DataFrame:
    """Bad command lines with their reason: ``cmd_file, line_pos, raw, reason``."""
    c = classify_commands(lines, **kw)
    return c.filter(F.col("reason").isNotNull()).select("cmd_file", "line_pos", "raw", "reason")


def last_command_per_file(cmds: DataFrame, file_col: str = "cmd_file", order_col: str = "line_pos") -> DataFrame:
    """Only the last good line of each command file (the reference behaviour).

    ``max_by`` is a partial aggregate, so a huge command file is reduced on
    the map side before the shuffle.
    """
    cols = cmds.columns
    return cmds.groupBy(file_col).agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("_r")).select("_r.*")
