"""Date helpers: text dates parsed once, date differences against a fixed ``as_of``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.columns import as_col

# Fixed value: the repayment-date text format of the loan feeds.
LOAN_DATE_FORMAT = "MM/dd/yyyy HH:mm:ss"


def parse_date(text, fmt: str = LOAN_DATE_FORMAT) -> Column:
    """Text → date; text that does not match the format becomes null (no ANSI error)."""
    return F.try_to_timestamp(as_col(text), F.lit(fmt)).cast("date")


def as_of_literal(as_of) -> Column:
    """A fixed reference date as a literal, so results do not drift with the wall clock."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of)


def days_until(due, as_of) -> Column:
    """Whole days from ``as_of`` to ``due`` (negative when ``due`` is earlier)."""
    return F.datediff(as_col(due), as_of_literal(as_of))


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 of a timestamp, computed without a time-zone shift for
    TIMESTAMP_NTZ columns."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), as_col(ts).cast("timestamp_ntz"))
