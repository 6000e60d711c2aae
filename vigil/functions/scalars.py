"""Scalar helpers used by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.schemas import CLOSE_OFFSET_SECONDS, FEEDS, FILE_DATE_FORMAT, FILE_DATE_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: dt.datetime | str) -> Column:
    """A ``timestamp_ntz`` literal (Python datetimes would become zoned timestamps)."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value: dt.date | str) -> Column:
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def full_name(last: Column | str, first: Column | str, middle: Column | str) -> Column:
    """Last, first and middle name joined by single spaces; null when any part is
    null (string concatenation semantics, deliberately not ``concat_ws``)."""
    return F.concat(_col(last), F.lit(" "), _col(first), F.lit(" "), _col(middle))


def parse_amount(amount: Column | str) -> Column:
    """Amount text with a decimal comma as a double; unparsable text gives null."""
    return F.replace(_col(amount), F.lit(","), F.lit(".")).try_cast("double")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Exact minutes from ``start`` to ``end`` as a double."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return micros.cast("double") / F.lit(60_000_000.0)


def within_minutes(start: Column | str, end: Column | str, minutes: int) -> Column:
    """``end - start < minutes`` on exact timestamps (strict)."""
    return _col(end) < _col(start) + F.make_dt_interval(mins=F.lit(int(minutes)))


def close_time(as_of: Column) -> Column:
    """End of a version closed by a load at ``as_of``."""
    return as_of - F.make_dt_interval(secs=F.lit(CLOSE_OFFSET_SECONDS))


def batch_date_of(file_name: Column | str, in_path: bool = False) -> Column:
    """Batch date from a feed file name: the first 8 digits read as DDMMYYYY.

    Names without 8 digits, or with digits that are no date, give null. With
    ``in_path=True`` the argument is a full path and the date is taken from
    its first ``<feed>_DDMMYYYY`` part (directories may hold other digits)."""
    pattern = ("(?:" + "|".join(FEEDS) + ")_" + FILE_DATE_PATTERN) if in_path else FILE_DATE_PATTERN
    digits = F.regexp_extract(_col(file_name), pattern, 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), FILE_DATE_FORMAT)


def feed_of(file_name: Column | str) -> Column:
    """Feed kind of a file name (its prefix before ``_DDMMYYYY``), or null."""
    pattern = r"^(" + "|".join(FEEDS) + r")_\d{8}"
    kind = F.regexp_extract(_col(file_name), pattern, 1)
    return F.nullif(kind, F.lit(""))
