"""Column functions that type, conform and compare raw values.

Parsing never raises: text that does not fit the target becomes NULL, and
`lost_by_parsing` marks those cells so that a profile can count them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def to_int(c: str | Column) -> Column:
    return _col(c).try_cast("int")


def to_boolean(c: str | Column) -> Column:
    """True/False in any case; blank and other text stay unknown (NULL)."""
    return _col(c).try_cast("boolean")


def to_date(c: str | Column) -> Column:
    return _col(c).try_cast("date")


def to_timestamp(c: str | Column) -> Column:
    return F.try_to_timestamp(_col(c))


def to_money(c: str | Column) -> Column:
    """Text to decimal(10,2), half up."""
    return _col(c).try_cast("decimal(10,2)")


def as_money(c: str | Column) -> Column:
    """A typed amount as decimal(10,2), half up. One too large raises: lost as NULL, it would leave every sum."""
    return _col(c).cast("decimal(10,2)")


def lost_by_parsing(raw: str | Column, parsed: Column) -> Column:
    """True where text was present but could not be parsed."""
    return _col(raw).isNotNull() & parsed.isNull()


def conform_title(c: str | Column) -> Column:
    return F.initcap(F.trim(_col(c)))


def conform_upper(c: str | Column) -> Column:
    return F.upper(F.trim(_col(c)))


def to_microseconds(c: str | Column) -> Column:
    """Timestamp at Spark's fixed six-digit precision."""
    return _col(c).cast("timestamp")


def line_value(quantity: str | Column, unit_price: str | Column) -> Column:
    """quantity * price, multiplied at full precision and rounded once. One too large raises."""
    return (_col(quantity) * _col(unit_price)).cast("decimal(12,2)")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed from start to end, negative when end is earlier.

    00:00:50 to 00:01:10 is one boundary although only 20 seconds pass.
    """
    truncated = [F.date_trunc("minute", _col(c)) for c in (start, end)]
    return F.timestamp_diff("MINUTE", *truncated).cast("int")


def money_differs(a: str | Column, b: str | Column) -> Column:
    """NULL-propagating comparison of two amounts at two decimals."""
    return F.round(_col(a), 2) != F.round(_col(b), 2)


def is_true(c: Column) -> Column:
    """Three-state predicate to two states: unknown counts as false."""
    return F.coalesce(c, F.lit(False))
