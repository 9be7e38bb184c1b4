"""Date and time expressions (D-1 ... D-16).

All functions take and return ``Column`` objects.  Timestamps are wall-clock
UTC values (``timestamp_ntz``) so nothing depends on the session time zone.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudlens.sources.tables import epoch_us

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MISSING_SECONDS = -999   # fixed value: "no timestamp" sentinel of the seconds-since-midnight feature


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_dates(c, formats=("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy",
                            "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")) -> Column:
    """D-1: day-first parse, formats tried in order, unparseable -> NULL."""
    c = _c(c).cast("string")
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def sec_since_midnight(c) -> Column:
    """D-3: h*3600 + m*60 + s (whole seconds); NULL -> -999."""
    c = _c(c)
    v = F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("int")
    return F.coalesce(v.cast("int"), F.lit(MISSING_SECONDS))


def is_weekend(c) -> Column:
    """D-4: Saturday/Sunday -> 1, else 0 (NULL -> 0)."""
    return F.coalesce((F.weekday(_c(c)) >= 5).cast("int"), F.lit(0))


def weekday_flags(c, prefix: str = "local") -> dict[str, Column]:
    """D-5: seven 0/1 columns ``{prefix}_is_Monday`` ... ``_is_Sunday``."""
    wd = F.weekday(_c(c))
    return {f"{prefix}_is_{name}": F.coalesce((wd == i).cast("int"), F.lit(0))
            for i, name in enumerate(WEEKDAYS)}


def day_and_month(c, name: str = "transaction_date") -> dict[str, Column]:
    """D-6: day of month and month."""
    return {f"{name}_day": F.dayofmonth(_c(c)), f"{name}_month": F.month(_c(c))}


def is_night(c) -> Column:
    """D-7: hour <= 6 -> 1."""
    return F.coalesce((F.hour(_c(c)) <= 6).cast("int"), F.lit(0))


def time_parts(c) -> dict[str, Column]:
    """D-8: hour, day of month, day of week (Mon=0), month."""
    c = _c(c)
    return {"transaction_hour": F.hour(c), "transaction_day": F.dayofmonth(c),
            "transaction_dayofweek": F.weekday(c), "transaction_month": F.month(c)}


def days_since(c, as_of: str) -> Column:
    """D-9: whole days from ``c`` to the ``as_of`` date (a parameter, so results reproduce)."""
    return F.datediff(F.lit(as_of).cast("date"), F.to_date(_c(c)))


def merchant_age_years(ts, established) -> Column:
    """D-10: floor(floor(seconds(ts - established) / 86400) / 365)."""
    secs = F.floor((epoch_us(ts) - epoch_us(established)) / 1_000_000)
    return F.floor(F.floor(secs / 86400) / 365).cast("int")


def is_shopping_season(c) -> Column:
    """D-11: Nov 24-30, all of December, Jan 1-5 -> 1."""
    c = _c(c)
    m, d = F.month(c), F.dayofmonth(c)
    cond = ((m == 11) & (d >= 24)) | (m == 12) | ((m == 1) & (d <= 5))
    return F.coalesce(cond.cast("int"), F.lit(0))


def elapsed(c, start: str) -> dict[str, Column]:
    """D-12: ``day_no`` (1-based day index) and ``date_in_sec`` since ``start``."""
    c = _c(c)
    s = F.lit(start).cast("timestamp_ntz")
    return {"day_no": (F.datediff(F.to_date(c), F.to_date(s)) + 1).cast("int"),
            "date_in_sec": F.floor((epoch_us(c) - epoch_us(s)) / 1_000_000).cast("bigint")}


def seconds_to_ts(seconds, origin: str) -> Column:
    """D-13: origin + n seconds."""
    return (F.lit(origin).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(seconds).cast("decimal(18,6)")))


def shift_to_weekend(c) -> Column:
    """D-14: Mon-Fri move to that week's Saturday, time of day kept; weekends unchanged."""
    c = _c(c)
    wd = F.weekday(c)
    return F.when(wd < 5, c + F.make_dt_interval(5 - wd)).otherwise(c)


def strip_tz(c) -> Column:
    """D-16: drop the zone, keep the wall clock."""
    return _c(c).cast("timestamp_ntz")


def local_time(ts, tz) -> Column:
    """D-2: UTC wall clock -> wall clock in zone ``tz`` (NTZ); NULL zone -> NULL."""
    return F.convert_timezone(F.lit("UTC"), _c(tz), _c(ts).cast("timestamp_ntz"))
