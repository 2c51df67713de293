"""B5 dest_table_name, split-mode decoding, B7 file_extension, path matching."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Registry ``partgranularity`` codes and the period text of each
# split mode.  Any other code means NONE.
SPLIT_CODES = {0: "NONE", 1: "DAY", 2: "MONTH", 3: "YEAR"}
PERIOD_FORMATS = {"DAY": "yyyyMMdd", "MONTH": "yyyyMM", "YEAR": "yyyy"}
# Period value used for the partition column when a family is not split.
UNSPLIT_PERIOD = "all"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_mode(code) -> Column:
    """Registry code -> DAY / MONTH / YEAR / NONE (unknown codes are NONE)."""
    code = _col(code)
    expr = None
    for k, name in SPLIT_CODES.items():
        expr = F.when(code == k, F.lit(name)) if expr is None else expr.when(code == k, F.lit(name))
    return expr.otherwise(F.lit("NONE"))


def period_of(mode, ts) -> Column:
    """Period text of a content timestamp for a split mode; NULL for NONE."""
    mode, ts = _col(mode), _col(ts)
    expr = None
    for name, fmt in PERIOD_FORMATS.items():
        branch = F.date_format(ts, fmt)
        expr = F.when(mode == name, branch) if expr is None else expr.when(mode == name, branch)
    return expr


def _cycle_part(cycle) -> Column:
    cycle = _col(cycle)
    return F.when(cycle.isNull() | cycle.isin("", "0"), F.lit(None).cast("string")).otherwise(cycle)


def family_name(base, cycle) -> Column:
    """``base[_cycle]``: one physical target per family, partitioned by period."""
    return F.concat_ws("_", _col(base), _cycle_part(cycle))


def dest_table_name(base, cycle, mode, ts) -> Column:
    """``base[_cycle][_period]`` with the period taken from the file's content time."""
    return F.concat_ws("_", _col(base), _cycle_part(cycle), period_of(mode, ts))


def file_extension(path, default: str = "") -> Column:
    """Text after the last dot; a missing or trailing dot gives ``default``."""
    path = _col(path)
    ext = F.regexp_extract(path, r"\.([^.]+)$", 1)
    return F.when(ext == "", F.lit(default)).otherwise(ext)


def normalize_path(path, decode: bool = False, default_fs: str = "") -> Column:
    """Comparable form of a file path.

    ``_metadata.file_path`` is a URI (``file:/x/a%20b.csv``); an announced path
    is usually plain (``/x/a b.csv``).  The local scheme is dropped on both;
    ``decode=True`` (for URI inputs) turns ``%XX`` escapes back into characters
    while leaving ``+`` alone.  A path without a scheme means the session's
    default file system, so that one's name (``default_fs``) is dropped, too.
    """
    p = F.regexp_replace(_col(path), r"^file:(//)?(?=/)", "")
    if default_fs and not default_fs.startswith("file:"):
        p = F.regexp_replace(p, "^" + re.escape(default_fs.rstrip("/")) + "(?=/)", "")
    if decode:
        p = F.coalesce(F.try_url_decode(F.regexp_replace(p, r"\+", "%2B")), p)
    return p
