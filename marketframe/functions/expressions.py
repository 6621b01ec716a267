"""Scalar expressions; all are built-in column expressions, evaluated inside generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MS_PER_DAY = 86_400_000

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def epoch_ms_to_date(ms: Column) -> Column:
    """UTC calendar date of an epoch in milliseconds.

    Whole-day arithmetic on integers: independent of the session time zone, and right before 1970.
    """
    ms = ms.cast("bigint")
    midnight = ms - F.pmod(ms, F.lit(MS_PER_DAY))
    return F.date_from_unix_date((midnight / F.lit(MS_PER_DAY)).try_cast("int"))


def month_of(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "MM")


def strip_text(text: Column) -> Column:
    """Missing text becomes empty; surrounding white space of any kind goes."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))


def pct_change(value: Column, previous: Column) -> Column:
    """Change from ``previous`` in percent, two places; NULL when there is no base to divide by."""
    return F.round((value - previous) / F.nullif(previous, F.lit(0)) * 100, 2)


def store_cast(value: Column, target: T.DecimalType, name: str = "value") -> Column:
    """Round half away from zero to ``target``; a value that does not fit is an error.

    The check does not lean on the session's ANSI setting. NaN has no decimal form and becomes NULL.
    """
    stored = value.try_cast(target)
    number = value.cast("double")
    absent = value.isNull() | F.isnan(number) | stored.isNotNull()
    overflow = F.concat(F.lit(f"numeric overflow in {name}: "), value.cast("string"))
    return F.when(absent, stored).otherwise(F.raise_error(overflow).cast(target))


def stable_key(*columns: str) -> Column:
    """Surrogate key from the natural key: the same on every retry, unlike a sequence."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
