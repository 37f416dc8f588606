"""Dates of a run and text-to-timestamp coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"

# Whatever stands behind the time of day is a zone: Z, an offset, or a name such as Europe/London.
_ZONED = r"[0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]*)?)?\s*[^\s0-9:.]"


def run_day(run_date: Column, days_back: int = 0) -> Column:
    """The day a run asks for, as ``yyyy-MM-dd`` text."""
    return F.date_format(F.date_sub(run_date.cast("date"), days_back), DATE_FORMAT)


def to_instant(text: Column, source_tz: str | None = None) -> Column:
    """Timestamp from text, NULL if it is none.

    Text without an offset or the name of a zone is local time in ``source_tz``, or in the session
    zone if that is unset.
    """
    plain = text.try_cast("timestamp")
    if source_tz is None:
        return plain
    has_zone = text.rlike(_ZONED)
    local = F.convert_timezone(
        F.lit(source_tz), F.current_timezone(), text.try_cast("timestamp_ntz")
    )
    return F.when(has_zone, plain).otherwise(local.cast("timestamp"))
