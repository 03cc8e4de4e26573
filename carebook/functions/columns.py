"""Column expressions shared by the jobs.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them calls Python per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_MINUTE = 60_000_000

# Amounts have at most two decimals. Each is read as this exact type (half-up
# rounding of the double) and summed in whole cents as a long. An amount that is
# not finite, or not below a million millions, has no value here: it is left out
# of sums, and the quality report counts it.
MONEY = "decimal(14,2)"
MONEY_BELOW = 1e12


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """An amount as an exact decimal, ready to be summed."""
    return col_(c).try_cast(MONEY)


def cents(c: str | Column) -> Column:
    """An amount in whole cents, exactly ``money(c) * 100`` as a long."""
    return (money(c) * 100).cast("long")


def exact_sum(c: str | Column) -> Column:
    """Exact sum of amounts, reported as double.

    Summing long cents is exact (overflow raises under ANSI mode) and stays on
    Spark's fast integer path; a ``decimal(12,2)`` sum widens to
    ``decimal(22,2)``, which Spark aggregates with big-decimal objects. The
    double is the same value a decimal sum cast to double gives.
    """
    return F.sum(cents(c)) / 100


def is_finite(c: str | Column) -> Column:
    """Whether a double is neither NaN nor infinite (null for null)."""
    c = col_(c)
    return ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))) & c.isNotNull()


def day_of(c: str | Column) -> Column:
    """Calendar day of a TIMESTAMP_NTZ (time-zone free)."""
    return F.to_date(col_(c))


def ntz(value: str | dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal, so comparisons with NTZ columns need no cast
    of the column and reach the parquet scan as pushed filters."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def json_attr(c: str | Column, key: str) -> Column:
    """One attribute of the JSON ``props`` string (null when absent or malformed)."""
    return F.get_json_object(col_(c), f"$.{key}")


def ntz_micros(c: str | Column) -> Column:
    """Microseconds from 1970-01-01 00:00 to a TIMESTAMP_NTZ's wall clock.

    Built from the date and time fields, so no time zone is involved (a cast
    to TIMESTAMP would read the wall clock in the session time zone).
    """
    c = col_(c)
    return (
        F.unix_date(F.to_date(c)).cast("long") * MICROS_PER_DAY
        + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
        + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    )


def time_bucket(c: str | Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide slot holding a TIMESTAMP_NTZ (slot 0
    starts at 1970-01-01 00:00; a width of 86400 numbers calendar days)."""
    width = F.lit(int(seconds) * 1_000_000)
    micros = ntz_micros(c)
    # The numerator is an exact multiple of the width, so the division is exact.
    return ((micros - F.pmod(micros, width)) / width).cast("long")


def ntz_to_instant(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP, reading the wall clock as UTC.

    Streaming watermarks need TIMESTAMP. A plain cast would read the wall clock
    in the session time zone (shifting day windows and DST-gap times).
    """
    return F.timestamp_micros(ntz_micros(c))


def instant_day(c: str | Column) -> Column:
    """UTC calendar day of a TIMESTAMP (inverse of ``ntz_to_instant`` on days)."""
    return F.date_from_unix_date(F.floor(F.unix_micros(col_(c)) / MICROS_PER_DAY).cast("int"))


def instant_to_ntz(c: str | Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding its UTC wall clock (inverse of ``ntz_to_instant``)."""
    micros = F.unix_micros(col_(c))
    days = F.floor(micros / MICROS_PER_DAY)
    d = F.date_from_unix_date(days.cast("int"))
    rem = micros - days * MICROS_PER_DAY
    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d),
        (rem / MICROS_PER_HOUR).cast("int"),
        ((rem % MICROS_PER_HOUR) / MICROS_PER_MINUTE).cast("int"),
        ((rem % MICROS_PER_MINUTE) / F.lit(1_000_000)).cast("decimal(8,6)"),
    )
