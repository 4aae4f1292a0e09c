"""Epoch-second helpers, written as zone-free arithmetic.

The model keeps timestamps as int epoch seconds. Converting a
``TIMESTAMP_NTZ`` through ``unix_timestamp`` would read it in the session
zone; the arithmetic below gives UTC semantics whatever the session says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("date")


def ntz_epoch_seconds(c: Column | str) -> Column:
    """Whole epoch seconds (floored) of a TIMESTAMP_NTZ column, as int."""
    c = F.col(c) if isinstance(c, str) else c
    days = F.datediff(c.cast("date"), _epoch()).cast("long")
    secs = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return secs.cast("int")


def epoch_to_yearmonth(c: Column | str) -> Column:
    """Epoch seconds -> ``yyyyMM`` as int, in UTC (1577836799 -> 201912)."""
    c = F.col(c) if isinstance(c, str) else c
    day = F.date_add(_epoch(), F.floor(c / 86400).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")
