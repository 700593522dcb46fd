"""Timestamp Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The date and time texts that lenient SQL casts accept. A date has
# all three parts with one separator (-, /, backslash or space); a time has at
# least hours and minutes; a zone is accepted and dropped.
_USUAL = r"^\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)?$"
_DATE = r"^\s*(\d{1,6})([-/\\ ])(\d{1,2})\2(\d{1,2})"
_ZONE = r"\s*(?:Z|UTC|[+-]\d{2}(?::\d{2})?)"
_ACCEPTED = _DATE + rf"(?:(?: +|T)\d{{1,2}}:(?:\d{{1,2}})?(?::(?:\d{{1,2}}(?:\.\d*)?)?)?(?:{_ZONE})?\s*)?$"
_AFTER_TIME = rf"(:(?:\d{{1,2}}(?:\.\d+)?)?)\.?(?:{_ZONE})?\s*$"
_NO_DIGITS = r":(?=:|$)"
_MIDNIGHT = r"^(\S+) 24:00(?::00(?:\.0+)?)?$"


def to_timestamp_ntz(c: Column | str) -> Column:
    """Text -> TIMESTAMP without time zone, NULL when unparsable.

    ISO text goes straight to Spark's cast. Other accepted forms are rewritten
    first: separators to dashes, no zone, hour 24 to the next day, ``epoch``.
    Everything else is NULL, also the partial dates (``2024-01``) that Spark's
    own cast would take.
    """
    col = _col(c)
    year = F.regexp_extract(col, _DATE, 1)
    year = F.when(F.length(year) < 4, F.lpad(year, 4, "0")).otherwise(year)
    rest = F.regexp_replace(F.regexp_replace(col, _DATE + "(?: +|T)?", "-$3-$4 "), _AFTER_TIME, "$1")
    plain = F.when(col.rlike(_ACCEPTED), F.concat(year, F.regexp_replace(F.rtrim(rest), _NO_DIGITS, ":00")))
    next_day = F.date_add(F.regexp_extract(plain, _MIDNIGHT, 1).try_cast("date"), 1).cast("timestamp_ntz")
    epoch = F.when(F.lower(F.trim(col)) == F.lit("epoch"), F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.coalesce(F.when(col.rlike(_USUAL), col).try_cast("timestamp_ntz"), plain.try_cast("timestamp_ntz"), next_day, epoch)


def hour_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of hour boundaries crossed from ``start`` to ``end`` (N3).

    This is ``DATE_DIFF('hour', a, b)`` of SQL engines: 00:59 -> 01:01 is 1,
    whereas Spark's ``timestampdiff(HOUR, ...)`` counts whole hours (0). Built
    from calendar fields of the wall-clock value, so it does not depend on the
    session time zone. Returns BIGINT.
    """
    a, b = _col(start), _col(end)
    days = F.datediff(b.cast("date"), a.cast("date")).cast("bigint")
    return days * F.lit(24) + (F.hour(b) - F.hour(a)).cast("bigint")
