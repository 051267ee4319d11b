"""Time columns: parts, hour groups, local wall-clock text, feed slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = "2015-01-01 00:00:00"
FEED_MINUTES = 5


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds to timestamp, cut to the second."""
    return F.timestamp_seconds(_div(ms.cast("bigint"), 1000))


def iso_dow(ts: Column) -> Column:
    """Day of week, Monday = 1."""
    return F.weekday(ts) + F.lit(1)


def parts(ts: Column) -> list[Column]:
    """year, month, day, hour, dow of a timestamp."""
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        iso_dow(ts).alias("dow"),
    ]


def ymd(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """Date from three integer columns."""
    return F.make_date(F.col(year), F.col(month), F.col(day))


def slot(ts: Column, minutes: int = FEED_MINUTES, reference: str = REFERENCE) -> Column:
    """Minute of day at which the feed slot of ``ts`` starts.

    Whole minutes since ``reference`` are divided by ``minutes`` towards zero.
    """
    ref = F.lit(reference).cast("timestamp")
    since = _div(F.timestamp_diff("MINUTE", ref, ts), minutes) * F.lit(minutes)
    start = F.timestamp_add("MINUTE", since.cast("int"), ref)
    return F.hour(start) * F.lit(60) + F.minute(start)


def hour_chunk(hour: Column) -> Column:
    """Fixed groups of the hour-group index."""
    return (
        F.when(hour.between(5, 9), "5-9")
        .when(hour.between(10, 15), "10-15")
        .when(hour.between(16, 21), "16-21")
        .otherwise("rest")
    )


def local_chunk(ts: Column, tz: Column, cuts: Sequence[int] = (5, 10, 16, 22)) -> Column:
    """Half-open groups of the local hour, labelled by their first and last hour."""
    hour = F.hour(F.from_utc_timestamp(ts, tz))
    label = None
    for low, high in zip(cuts, cuts[1:]):
        test = (hour >= low) & (hour < high)
        name = f"from {low}h to {high}h"
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise("rest")


def workday(dow: Column) -> Column:
    """Monday to Friday."""
    return (dow > 0) & (dow <= 5)


def daytime(ts: Column) -> Column:
    """Hours 7 to 19."""
    return (F.hour(ts) > 6) & (F.hour(ts) < 20)


def local_stamp(ts: Column, tz: Column) -> Column:
    """Local wall-clock text, null without a timezone."""
    return F.when(tz.isNotNull(), F.date_format(F.from_utc_timestamp(ts, tz), "yyyy-MM-dd HH:mm:ss"))


def hour_stamp(
    year: str = "year", month: str = "month", day: str = "day", hour: str = "hour"
) -> Column:
    """Timestamp of a whole hour from integer columns."""
    zero = F.lit(0)
    return F.make_timestamp(F.col(year), F.col(month), F.col(day), F.col(hour), zero, zero)


def week_label(first: Column, last: Column) -> Column:
    """``d/m to d/m`` of the first and last day."""
    return F.concat_ws(" to ", F.date_format(first, "d/M"), F.date_format(last, "d/M"))


def monday_week(date: Column) -> Column:
    """Week of year whose weeks start on Monday; days before the first Monday are week 0."""
    return _div(F.dayofyear(date) + F.lit(6) - F.weekday(date), 7)
