"""Surrogate keys and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date of records without a change time, and the open end of a validity interval.
DEFAULT_DATE = dt.date(2000, 1, 1)
OPEN_END = dt.date(9999, 12, 31)

_LARGEST_LONG = 2**63 - 1


def surrogate_key(c: Column) -> Column:
    """Non-negative 63-bit key that depends on the natural key alone; NULL stays NULL.

    Because it is a function of the natural key, a child row can compute its parent's key without
    a join. The sign bit is masked: negating the smallest long would fail.
    """
    return F.when(c.isNotNull(), F.xxhash64(c).bitwiseAND(F.lit(_LARGEST_LONG)))


def epoch_timestamp(c: Column) -> Column:
    """Epoch seconds, as text or number, to a timestamp; NULL for anything else."""
    text = c.cast("string")
    whole = F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))
    return whole.cast("timestamp")


def event_date(timestamp: Column) -> Column:
    return F.coalesce(F.to_date(timestamp), F.lit(DEFAULT_DATE))


def date_key(c: Column) -> Column:
    """yyyymmdd as an int; NULL when the year is too large to fit."""
    return (F.year(c).cast("bigint") * 10000 + F.month(c) * 100 + F.dayofmonth(c)).try_cast("int")
