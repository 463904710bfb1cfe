"""Time measures as the reports define them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(moment: dt.datetime) -> Column:
    """A zone-less moment, whatever the zones of the session and the driver."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole elapsed seconds over 60."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(60)


def hundredths_of_seconds(moment: Column) -> Column:
    """Whole hundredths of a second since 1970, whatever the session's time zone."""
    since = (moment - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return F.floor(since.cast("decimal(20,6)") * 100).cast("bigint")


def lifetime_class(minutes: Column) -> Column:
    """Purchase class of a lease length; NULL outside the sold lengths."""
    # 5-25 min, 25 min-3 h, 3-6 h, 6-12 h, 12-24 h.
    return (
        F.when(minutes < 5, None)
        .when(minutes < 25, 1)
        .when(minutes < 180, 2)
        .when(minutes < 360, 3)
        .when(minutes < 720, 4)
        .when(minutes <= 1440, 5)
    )
