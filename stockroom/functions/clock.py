"""Explicit ``as_of`` literals (operators never read a clock)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock time, like MySQL DATETIME).

    ``F.lit(datetime)`` would give a session-zoned TIMESTAMP instead.
    """
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
