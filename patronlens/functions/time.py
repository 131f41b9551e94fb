"""Ages in calendar days relative to an explicit reporting date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(as_of: dt.date | None) -> Column:
    """The reporting date as a column; today when none is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def age_in_days(moment: str | Column, as_of: dt.date | None) -> Column:
    """Calendar days from ``moment`` to ``as_of``: 23:59 yesterday is one day old."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return F.datediff(day_of(as_of), F.to_date(moment))


def not_after(moment: str | Column, as_of: dt.date | None) -> Column:
    """Rows known on ``as_of``: dated up to the end of that day, or undated.

    Written as a comparison of the bare column with a constant, so that it reaches the Parquet scan.
    """
    moment = F.col(moment) if isinstance(moment, str) else moment
    next_midnight = F.date_add(day_of(as_of), 1).cast("timestamp_ntz")
    return moment.isNull() | (moment < next_midnight)
