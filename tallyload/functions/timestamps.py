"""B4 content_timestamp: the announced content time of a data file.

The command format is ``yyyy-MM-dd hh:mm:ss.S`` read leniently: one or two
digits per field, out-of-range fields rolling over into the next unit (Feb 30
is Mar 1, hour 25 is 01:00 next day), hours 13-23 as such (optionally 12 read
as 00, the 12-hour quirk), a mandatory fraction after the seconds, and any
trailing text ignored.
``fraction="millis"`` reads the fraction digits as a count of milliseconds
(``.5`` is 5 ms, ``.179575`` is 179.575 s), which is how the writer of that
pattern produces it; ``fraction="decimal"`` reads it as a decimal fraction of
a second, up to microseconds.  Anything unreadable is NULL (a reject upstream).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PATTERN = r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})\.(\d+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_timestamp(c, twelve_as_midnight: bool = False, fraction: str = "millis") -> Column:
    s = _col(c)
    part = lambda i: F.regexp_extract(s, _PATTERN, i).try_cast("int")
    hour = part(4)
    if twelve_as_midnight:
        hour = F.when(hour == 12, F.lit(0)).otherwise(hour)
    # lenient: fields roll over (Feb 30 -> Mar 1, month 13 -> January next year,
    # hour 24 -> next day).  The rollover is done on a time without zone, and the
    # result is read as a local time of the session, so a day whose clock
    # changes keeps the announced hour.
    day = F.date_add(F.add_months(F.make_date(part(1), F.lit(1), F.lit(1)), part(2) - 1), part(3) - 1)
    secs = hour.cast("bigint") * 3600 + part(5).cast("bigint") * 60 + part(6).cast("bigint")
    base_micros = F.unix_date(day).cast("bigint") * 86_400_000_000 + secs * 1_000_000
    frac = F.regexp_extract(s, _PATTERN, 7)
    if fraction == "millis":
        # a count that overflows 64 bits of microseconds is unreadable, whatever its length
        extra = F.try_multiply(frac.try_cast("bigint"), F.lit(1000).cast("bigint"))
    elif fraction == "decimal":
        extra = F.rpad(F.substring(frac, 1, 6), 6, "0").cast("bigint")
    else:
        raise ValueError(f"fraction must be 'millis' or 'decimal', not {fraction!r}")
    ok = s.rlike(_PATTERN) & (part(1) >= 1)  # year 0000 does not exist
    micros = base_micros + extra
    date = F.date_from_unix_date(F.floor(micros / F.lit(86_400_000_000)).cast("int"))
    of_day = F.pmod(micros, F.lit(86_400_000_000))
    local = F.make_timestamp(
        F.year(date), F.month(date), F.dayofmonth(date), F.floor(of_day / 3_600_000_000).cast("int"),
        (F.floor(of_day / 60_000_000) % 60).cast("int"), ((of_day % 60_000_000) / F.lit(1_000_000)).cast("decimal(16,6)"))
    return F.when(ok, local)
