"""Mixed-format dates, times of day and rules that depend on today's date.

Raw dates come as ``yyyy-MM-dd`` or ``yyyy/M/d`` (optionally with a clock time) or ``d/M/yyyy``;
anything else is null. Only text of an accepted shape is cast, as Spark's own cast also takes bare
years and ignores what follows a space. The common plain ISO date is tried first, as it is the
cheapest; day-first text is turned round to ISO, and slashes after a year become dashes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted formats and status labels.
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
ISO_DATE_TIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
DAY_FIRST, TO_ISO = r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1"
YEAR_FIRST, DASHED = r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"
CLOCK = r"^\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?$"
SCHEDULED, CLOSED, ACTIVE = "PROGRAMADA", "CERRADA", "ACTIVA"
STATE_ACTIVE, STATE_CLOSED = "Activa", "Cerrada"
CAMPAIGN_STATES = (STATE_ACTIVE, STATE_CLOSED, "En preparación", "Pausada")

AsOf = dt.date | str | None


def _mixed(col: Column, kind: str) -> Column:
    text = F.trim(col.cast("string"))
    iso = F.regexp_replace(F.regexp_replace(text, DAY_FIRST, TO_ISO), YEAR_FIRST, DASHED)
    other = F.regexp_extract(iso, ISO_DATE_TIME, 0).try_cast("timestamp_ntz").cast(kind)
    return F.when(text.rlike(ISO_DATE), text.try_cast(kind)).otherwise(other)


def mixed_timestamp(col: Column) -> Column:
    return _mixed(col, "timestamp_ntz")


def mixed_date(col: Column) -> Column:
    return _mixed(col, "date")


def date_shape(col: Column) -> Column:
    """Which accepted format a raw date uses: iso, day_first, blank or other."""
    text = F.trim(col.cast("string"))
    return (
        F.when(text.isNull() | (text == ""), "blank")
        .when(mixed_timestamp(col).isNull(), "other")
        .when(text.rlike(DAY_FIRST), "day_first")
        .otherwise("iso")
    )


def time_of_day(col: Column) -> Column:
    """``HH:mm:ss`` text, or null when the clock time is invalid. Spark's TIME type
    is off by default, so the value stays a sortable string."""
    clock = F.nullif(F.regexp_extract(F.trim(col.cast("string")), CLOCK, 0), F.lit(""))
    return F.date_format(F.concat(F.lit("1970-01-01 "), clock).try_cast("timestamp_ntz"), "HH:mm:ss")


def today(as_of: AsOf = None) -> Column:
    """The reference day of all date rules: ``as_of``, or the session's current date."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def lifecycle_status(start: Column, end: Column, as_of: AsOf = None) -> Column:
    """Scheduled before the start, closed after the end, active on and between both days."""
    day = today(as_of)
    known = start.isNotNull() & end.isNotNull()
    return F.when(known, F.when(day < start, SCHEDULED).when(day > end, CLOSED).otherwise(ACTIVE))


def active_on(start: Column, end: Column, as_of: AsOf = None) -> Column:
    """Whether the interval covers the day; unknown (null) follows SQL logic."""
    day = today(as_of)
    return (day >= start) & (day <= end)


def effective_state(state: Column, end: Column, as_of: AsOf = None) -> Column:
    """The recorded state, or one derived from the end date where it is blank."""
    derived = F.when(end < today(as_of), STATE_CLOSED).when(end.isNotNull(), STATE_ACTIVE)
    return F.coalesce(state, derived)
