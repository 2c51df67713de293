"""Data-file scans by profile (A4 A5 A6, ``multiline``) and A7 file_inventory.

Every scan returns the declared columns (typed, nullable), ``_corrupt_record``
(the raw record when it did not fit the declaration), ``_file`` (the file path
in the same plain form as an announced path) and ``_raw`` (the record as it
stands in the file; not for encodings other than UTF-8).

``lines`` profiles read lines, which splits files freely, and parse them with
``from_csv``; other encodings go through Spark's CSV reader.  The ``continued`` and ``multiline`` layouts must glue physical lines into records
without reading any file in one task and without shuffling the text.  Each
line gets its effect on the "inside a quoted field" state (identity, flip or
constant; regexes on the JVM side).  A split is read by one task in file
order, so a map-side pass summarises every split for both start states; a
window over that per-split table fixes each split's real start state and first
record number; a second map-side pass then emits whole records, and only the
pieces of records crossing a split boundary are grouped by key.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyload.functions.ddl import CORRUPT_COLUMN, RAW_COLUMN, DeclaredSchema
from tallyload.functions.naming import normalize_path
from tallyload.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS
from tallyload.sources.profiles import LoadProfile

# The map-side functions below run in Python workers; shipping this module's
# functions by value means executors need no copy of the package installed.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # older cloudpickle: the package must then be on the executors
    pass


def exact_path(path: str) -> str:
    """A path as Spark's readers take it literally: characters of glob patterns are escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def data_scan(spark: SparkSession, paths: list[str], schema: DeclaredSchema, profile: LoadProfile) -> DataFrame:
    if not paths:
        fields = list(schema.read_with_corrupt().fields) + [T.StructField(c, T.StringType(), True) for c in ("_file", RAW_COLUMN)]
        return spark.createDataFrame([], T.StructType(fields))
    utf8 = profile.encoding.replace("-", "").upper() == "UTF8"
    if profile.layout == "lines" and not utf8:
        # only the CSV reader knows other encodings; it keeps the text of malformed records alone
        df = (
            spark.read.schema(schema.read_with_corrupt())
            .options(**profile.csv_options())
            .csv([exact_path(p) for p in paths])
        )
        return df.select(*[F.col(f"`{n}`") for n in schema.names], CORRUPT_COLUMN,
                         normalize_path(F.col("_metadata.file_path"), True, default_filesystem(spark)).alias("_file"))
    if profile.layout == "lines":
        # like the CSV reader, passes over lines of blanks
        records = spark.read.format("text").load([exact_path(p) for p in paths]).where(F.col("value").rlike(r"[^\x00-\x20]")).select(
            F.col("value").alias("_record"), normalize_path(F.col("_metadata.file_path"), True, default_filesystem(spark)).alias("_file"))
    elif profile.layout in ("continued", "multiline"):
        if not utf8:
            raise ValueError(f"layout {profile.layout!r} reads UTF-8 text only, not {profile.encoding}")
        records = assemble_records(spark, paths, profile)
    else:
        raise ValueError(f"unknown layout {profile.layout!r}")
    opts = profile.csv_options()
    for k in ("header", "encoding"):
        opts.pop(k)
    parsed = F.from_csv(F.col("_record"), _ddl(schema.read_with_corrupt()), opts)
    return records.select(parsed.alias("_r"), "_file", F.col("_record").alias(RAW_COLUMN)).select(
        *[F.col(f"_r.`{n}`").alias(n) for n in schema.names], F.col(f"_r.{CORRUPT_COLUMN}"), "_file", RAW_COLUMN
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _line_maps(profile: LoadProfile):
    """Per-line quote-state map as two flags: does the line end inside a
    quoted field when it starts outside (``_eo``) / inside (``_ei``)?"""
    q, d = re.escape(profile.quote), re.escape(profile.delimiter)
    if profile.layout == "continued":
        # every line is a constant map: the record goes on unless the last
        # non-blank character is the quote
        goes_on = ~F.rtrim(F.col("value")).endswith(profile.quote)
        return goes_on, goes_on
    body = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"  # inside quotes: plain runs and doubled quotes
    field = f"(?:{q}{body}{q}[^{d}]*+|[^{q}{d}][^{d}]*+|)"
    open_tail = f"{q}{body}$"
    v = F.col("value")
    has_quote = v.contains(profile.quote)  # a line without one keeps the state as it is
    ends_in_from_out = has_quote & v.rlike(f"^(?:{field}{d})*+{open_tail}")
    ends_in_from_in = ~has_quote | v.rlike(f"^{body}$") | v.rlike(
        f"^{body}{q}[^{d}]*+(?:{d}{field})*+{d}{open_tail}"
    )
    return ends_in_from_out, ends_in_from_in


def _start_states(df: DataFrame, part: list[str], order: str) -> DataFrame:
    """Quote state at the start of each row for either start state of its group.

    ``_eo``/``_ei`` give each row's map on {0 outside, 1 inside}: identity,
    flip, or constant.  The state before row k is fixed by the last constant
    row before it plus the parity of flips since then; without one it is the
    group's start state plus the parity of all earlier flips.  Adds
    ``_s0``/``_s1`` (group starts outside / inside).
    """
    w = Window.partitionBy(*part).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    const = F.col("_eo") == F.col("_ei")
    flip = (F.col("_eo") & ~F.col("_ei")).cast("int")
    df = df.withColumn("_fb", F.coalesce(F.sum(flip).over(before), F.lit(0)))
    df = df.withColumn(
        "_lc", F.max(F.when(const, F.struct(F.col(order), F.col("_eo").cast("int").alias("v"),
                                            F.col("_fb").alias("f")))).over(before)
    )
    fixed = (F.col("_lc.v") + F.col("_fb") - F.col("_lc.f")) % 2
    return df.withColumn("_s0", F.when(F.col("_lc").isNull(), F.col("_fb") % 2).otherwise(fixed)).withColumn(
        "_s1", F.when(F.col("_lc").isNull(), (F.col("_fb") + 1) % 2).otherwise(fixed)
    ).drop("_fb", "_lc")


def _states_before(start: int, eo, ei):
    """numpy form of ``_start_states`` for one run of lines in file order:
    the quote state before each line when the run is entered in ``start``."""
    import numpy as np

    n = len(eo)
    const = eo == ei
    flip = (eo & ~ei).astype(np.int64)
    flips_upto = np.cumsum(flip)
    flips_before = flips_upto - flip
    last_const_upto = np.maximum.accumulate(np.where(const, np.arange(n), -1))
    last_const = np.empty(n, dtype=np.int64)
    last_const[0] = -1
    last_const[1:] = last_const_upto[:-1]
    has = last_const >= 0
    lc = np.where(has, last_const, 0)
    fixed = (eo[lc].astype(np.int64) + flips_before - flips_upto[lc]) & 1
    free = (start + flips_before) & 1
    return np.where(has, fixed, free)


def _runs(pdf):
    """(start, stop) of each run of rows from one split, in the batch's order."""
    import numpy as np

    f, b = pdf["_file"].to_numpy(), pdf["_bs"].to_numpy()
    starts = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (b[1:] != b[:-1])])
    return zip(starts, np.r_[starts[1:], len(pdf)])


def _split_summaries(batches):
    """Pass 1 (map side): per split, the end state and the number of record
    ends for either start state.  A split is read by one task, in order."""
    import numpy as np
    import pandas as pd

    rows, cur, last_mid = [], None, None
    for pdf in batches:
        if pdf.empty:
            continue
        mids = pdf["_mid"].to_numpy()
        eo, ei = pdf["_eo"].to_numpy(dtype=bool), pdf["_ei"].to_numpy(dtype=bool)
        for a, z in _runs(pdf):
            key = (pdf["_file"].iat[a], int(pdf["_bs"].iat[a]))
            if cur is None or (cur[0], cur[1]) != key:
                if cur is not None:
                    rows.append(cur)
                cur, last_mid = [key[0], key[1], 0, 1, 0, 0], None
            if (last_mid is not None and mids[a] <= last_mid) or np.any(np.diff(mids[a:z]) <= 0):
                raise RuntimeError("lines of a split did not arrive in file order")
            last_mid = mids[z - 1]
            for v in (0, 1):
                st = _states_before(cur[2 + v], eo[a:z], ei[a:z])
                inside_after = np.where(st == 0, eo[a:z], ei[a:z])
                cur[4 + v] += int((~inside_after).sum())
                cur[2 + v] = int(inside_after[-1])
    if cur is not None:
        rows.append(cur)
    yield pd.DataFrame(rows, columns=["_file", "_bs", "_end0", "_end1", "_n0", "_n1"])


def _record_pieces(joiner: str):
    """Pass 2 (map side): glue lines into records inside each split.

    A record that starts and ends in the split comes out whole; the piece
    before the split's first record end (when the record began earlier) and
    the piece after its last one are emitted as parts to be joined by key.
    """

    def pieces(batches):
        import numpy as np
        import pandas as pd

        out = {k: [] for k in ("_file", "_rec", "_bs", "_mid", "_text", "_whole")}
        cur, last_mid = None, None  # cur: [file, bs, state, rec, parts, first_mid, starts_record]

        def emit(c, whole):
            out["_file"].append(c[0])
            out["_rec"].append(c[3])
            out["_bs"].append(c[1])
            out["_mid"].append(c[5])
            out["_text"].append(joiner.join(c[4]))
            out["_whole"].append(whole)

        for pdf in batches:
            if pdf.empty:
                continue
            mids = pdf["_mid"].to_numpy()
            eo, ei = pdf["_eo"].to_numpy(dtype=bool), pdf["_ei"].to_numpy(dtype=bool)
            values = pdf["value"].tolist()
            for a, z in _runs(pdf):
                key = (pdf["_file"].iat[a], int(pdf["_bs"].iat[a]))
                if cur is None or (cur[0], cur[1]) != key:
                    if cur is not None and cur[4]:
                        emit(cur, False)  # open at the split's end
                    cur = [key[0], key[1], int(pdf["_p"].iat[a]), int(pdf["_off"].iat[a]), [], None,
                           bool(pdf["_fresh"].iat[a])]
                    last_mid = None
                if (last_mid is not None and mids[a] <= last_mid) or np.any(np.diff(mids[a:z]) <= 0):
                    raise RuntimeError("lines of a split did not arrive in file order")
                last_mid = mids[z - 1]
                st = _states_before(cur[2], eo[a:z], ei[a:z])
                inside_after = np.where(st == 0, eo[a:z], ei[a:z])
                prev = a
                for t in np.flatnonzero(~inside_after) + a:
                    if not cur[4]:
                        cur[5] = int(mids[prev])
                    cur[4].extend(values[prev:t + 1])
                    emit(cur, cur[6])
                    cur[3] += 1
                    cur[4], cur[6] = [], True
                    prev = t + 1
                if prev < z:
                    if not cur[4]:
                        cur[5] = int(mids[prev])
                    cur[4].extend(values[prev:z])
                cur[2] = int(inside_after[-1])
            # only the open record is carried over to the next batch of lines
            if out["_file"]:
                yield pd.DataFrame(out)
                for column in out:
                    out[column] = []
        if cur is not None and cur[4]:
            emit(cur, False)
        if out["_file"]:
            yield pd.DataFrame(out)

    return pieces


def assemble_records(spark: SparkSession, paths: list[str], profile: LoadProfile) -> DataFrame:
    """Glue physical lines into logical records: ``_file, _rec, _record``.

    A record ends at a line that ends outside quotes (``multiline``) or that
    ends in the quote character (``continued``).  Two map-side passes over
    the scan and one window over the per-split table; only the pieces of
    records that cross a split boundary are shuffled.
    """
    lines = spark.read.format("text").load([exact_path(p) for p in paths]).select(
        normalize_path(F.col("_metadata.file_path"), True, default_filesystem(spark)).alias("_file"),
        F.col("_metadata.file_block_start").alias("_bs"),
        F.monotonically_increasing_id().alias("_mid"),
        F.col("value"),
    )
    eo, ei = _line_maps(profile)
    lines = lines.withColumn("_eo", eo).withColumn("_ei", ei)
    # pass 1: one row per split (tiny), then the file-order walk over splits
    splits = lines.select("_file", "_bs", "_mid", "_eo", "_ei").mapInPandas(
        _split_summaries, "_file string, _bs bigint, _end0 int, _end1 int, _n0 bigint, _n1 bigint"
    )
    splits = splits.select(
        "_file", "_bs", (F.col("_end0") == 1).alias("_eo"), (F.col("_end1") == 1).alias("_ei"), "_n0", "_n1"
    )
    splits = _start_states(splits, ["_file"], "_bs").withColumn("_p", F.col("_s0"))  # files start outside
    earlier = Window.partitionBy("_file").orderBy("_bs").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy("_file").orderBy("_bs")
    splits = splits.withColumn("_n", F.when(F.col("_p") == 0, F.col("_n0")).otherwise(F.col("_n1")))
    splits = splits.withColumn("_endp", F.when(F.col("_p") == 0, F.col("_eo")).otherwise(F.col("_ei")))
    splits = splits.select(
        "_file", "_bs", "_p",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
        # does a record start at this split's first line?
        F.coalesce(~F.lag("_endp").over(in_order), F.lit(True)).alias("_fresh"),
    )
    # one row per split, materialised once (pass 1 is not re-run by the size
    # check and the join below): a hash of the split's place and its start, 25
    # bytes, so that the table of a 100 TB load takes some 20 MB
    place = F.xxhash64("_file", "_bs")
    splits = splits.select(place.alias("_split"), "_p", "_off", "_fresh").checkpoint(eager=True)
    sizes = splits.agg(F.count(F.lit(1)), F.count_distinct("_split")).first()
    if sizes[0] != sizes[1]:
        raise RuntimeError("two splits share a hash; read the files in two batches")
    # pass 2: the scan joined to its split's start.  A broadcast join keeps the
    # scan's order and moves no text; only petabytes in one batch need the other
    lines = lines.withColumn("_split", place)
    if sizes[0] <= DEFAULT_MAX_BROADCAST_ROWS:
        placed = lines.join(F.broadcast(splits), "_split")
    else:
        placed = lines.join(splits, "_split").sortWithinPartitions("_file", "_bs", "_mid")
    joiner = "" if profile.layout == "continued" else "\n"
    pieces = placed.select("_file", "_bs", "_mid", "value", "_eo", "_ei", "_p", "_off", "_fresh").mapInPandas(
        _record_pieces(joiner), "_file string, _rec bigint, _bs bigint, _mid bigint, _text string, _whole boolean"
    )
    whole = pieces.filter("_whole").select("_file", "_rec", F.col("_text").alias("_record"))
    parts = pieces.filter(~F.col("_whole")).groupBy("_file", "_rec").agg(
        F.sort_array(F.collect_list(F.struct("_bs", "_mid", "_text"))).alias("_parts")
    )
    joined = parts.select(
        "_file", "_rec", F.array_join(F.transform("_parts", lambda x: x["_text"]), joiner).alias("_record")
    )
    return whole.unionByName(joined).filter(F.col("_record") != "")


def default_filesystem(spark: SparkSession) -> str:
    """The file system a path without a scheme means to Spark (``fs.defaultFS``)."""
    try:
        fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    except Exception:  # no JVM handle (e.g. a remote session): local files
        fs = None
    return fs or "file:///"


def file_inventory(paths: DataFrame, path_col: str = "data_path") -> DataFrame:
    """``path, data_size, file_exists`` for each distinct announced path.

    Spark's ``binaryFile`` source lists the announced files' folders and what
    is below them, on any file system that Spark reads; no content is read.  A
    missing path, anything that is not a regular file and a name that Spark's
    readers pass over (leading ``_`` or ``.``) has size 0.  A path without a
    scheme is looked up on the session's default file system, as Spark would.
    """
    from tallyload.operators.attempts import Files

    spark = paths.sparkSession
    default_fs = default_filesystem(spark)
    distinct = paths.select(F.col(path_col).alias("path")).distinct()
    folder = F.regexp_replace(normalize_path(F.col("path"), default_fs=default_fs), "/[^/]*$", "")
    roots: list[str] = []
    for r in sorted(r[0] for r in distinct.where(F.col("path").contains("/")).select(folder.alias("f")).distinct().toLocalIterator()):  # a row a folder
        covered = roots and roots[-1] and (r + "/").startswith(roots[-1] + "/")
        if not covered and _listable(spark, r):
            roots.append(r)
    # of a file system's own root, which holds everything, only the files in it
    listed = spark.createDataFrame(Files(spark, "/").lengths() if "" in roots else [], "path string, length bigint")
    folders = [exact_path(r) for r in roots if r]
    if folders:
        listed = listed.unionByName(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders).select("path", "length"))
    listed = listed.select(normalize_path(F.col("path"), default_fs=default_fs).alias("_found"), F.col("length").alias("_length"))
    return distinct.join(listed, normalize_path(F.col("path"), default_fs=default_fs) == F.col("_found"), "left").select(
        "path", F.coalesce("_length", F.lit(0)).alias("data_size"), F.col("_found").isNotNull().alias("file_exists"))


def _listable(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, on a file system that this session knows."""
    from py4j.protocol import Py4JJavaError

    from tallyload.operators.attempts import Files

    try:
        return Files(spark, folder).exists()
    except Py4JJavaError as e:
        if "No FileSystem for scheme" in str(e):
            return False
        raise
