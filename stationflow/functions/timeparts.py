"""Calendar parts of a wall-clock timestamp, and text forms of it.

Three weekday numberings meet in this domain: 0=Monday (features),
0=Sunday (rollups and lookups) and Spark's own 1=Sunday.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def ntz(value: str | Column) -> Column:
    """A wall-clock timestamp literal or column."""
    column = F.lit(value) if isinstance(value, str) else value
    return column.cast("timestamp_ntz")


def hour_floor(ts: Column) -> Column:
    """The start of the hour; stays clear of time zones, which `date_trunc` does not."""
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def month_floor(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def dow_monday0(ts: Column) -> Column:
    return F.weekday(ts)


def dow_sunday0(ts: Column) -> Column:
    return F.dayofweek(ts) - 1


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle, so that its ends meet."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def weekday_only(ts: Column, weekdays: str = "tue_sat") -> Column:
    """Weekday filter. The default keeps Tuesday to Saturday, the numbering the
    published averages were made with; `mon_fri` keeps Monday to Friday."""
    spans = {"tue_sat": (3, 7), "mon_fri": (2, 6)}
    return F.dayofweek(ts).between(*spans[weekdays])


def hour_label(hour: Column) -> Column:
    """12-hour clock label, e.g. `5:00 PM`."""
    twelve = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    return F.concat(twelve.cast("string"), F.lit(":00 "), F.when(hour < 12, "AM").otherwise("PM"))
