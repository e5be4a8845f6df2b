"""Typed conversions of string columns.

All conversions are ``try_cast`` based: bad text becomes NULL and the record
contract turns that NULL into a reject row, instead of aborting the job as a
failed ``toLong``/``toDouble`` would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
WHOLE_DATE = "^[0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    return _col(c).try_cast("double")


def to_long(c) -> Column:
    return _col(c).try_cast("bigint")


def to_int(c) -> Column:
    return _col(c).try_cast("int")


def admit_day_millis(c) -> Column:
    """Timestamp text -> start of its day (UTC) in epoch milliseconds.

    The time of day is dropped: two admissions on one calendar day share a
    visit.  ``unix_date`` keeps this independent of the session time zone.
    Unparsable dates (month 13, ...) and partial ones (``2101``, ``2101-3``,
    which a plain cast would complete) give NULL.
    """
    d = F.when(_col(c).rlike(WHOLE_DATE), _col(c).try_cast("date"))
    return F.unix_date(d).cast("bigint") * F.lit(DAY_MS).cast("bigint")


def derive_label(c) -> Column:
    """Death date missing -> 0 (alive), anything else -> 1."""
    return F.when(_col(c).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("int")
