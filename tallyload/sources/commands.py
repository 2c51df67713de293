"""A1 command_scan: every line of every command file below a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.operators.sizing import bounded_broadcast


def with_line_positions(lines: DataFrame, file_col: str = "cmd_file") -> DataFrame:
    """Add ``line_pos``: a position that orders the lines of one file.

    ``lines`` must come straight from a text scan with ``_bs`` (the split's
    byte offset) and ``_mid`` (``monotonically_increasing_id`` taken at the
    scan, so consecutive within a split).  ``line_pos = split offset + line
    number inside the split`` is unique and increasing within a file (a line
    takes at least one byte), equals the 0-based line number when the file is
    one split, and does not depend on how splits are packed into tasks.

    The lines themselves are not shuffled: the first row id of every split
    (one row per split, reduced map-side) is joined back, broadcast when the
    number of splits is within the broadcast bound.  Both sides read the same
    files with the same split planning, so the row ids agree.
    """
    firsts = lines.groupBy(file_col, "_bs").agg(F.min("_mid").alias("_first"))
    firsts = bounded_broadcast(firsts)
    return (
        lines.join(firsts, [file_col, "_bs"])
        .withColumn("line_pos", F.col("_bs") + F.col("_mid") - F.col("_first"))
        .drop("_bs", "_mid", "_first")
    )


def command_scan(
    spark: SparkSession,
    root: str,
    name_regex: str = r".*\.cmd",
    glob_filter: str | None = None,
    positions: bool = True,
) -> DataFrame:
    """Lines of the command files under ``root`` (recursive).

    A file is taken when its base name matches ``name_regex`` as a whole.
    ``glob_filter`` (a glob, e.g. ``*.cmd``) can prune the listing first.
    Returns ``cmd_file, line_pos, raw``; with ``positions=False`` the raw
    ``_bs, _mid`` pair instead, so that per-line work can run in the scan
    tasks and lines are numbered afterwards (``classify_commands`` does so).
    """
    reader = spark.read.format("text").option("recursiveFileLookup", "true")
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    df = reader.load(root)
    return scan_lines(df, name_regex, positions)


def scan_lines(text_df: DataFrame, name_regex: str | None = r".*\.cmd", positions: bool = True) -> DataFrame:
    """Shape a text-source DataFrame (batch or micro-batch) into command lines."""
    df = text_df
    if name_regex:
        df = df.filter(F.col("_metadata.file_name").rlike(f"^(?:{name_regex})$"))
    df = df.select(
        F.col("_metadata.file_path").alias("cmd_file"),
        F.col("_metadata.file_block_start").alias("_bs"),
        F.monotonically_increasing_id().alias("_mid"),
        F.col("value").alias("raw"),
    )
    if not positions:
        return df
    return with_line_positions(df).select("cmd_file", "line_pos", "raw")
