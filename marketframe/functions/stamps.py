"""Run clocks as arguments, so that a run can be retried or backdated with the same result."""

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: date | str | None = None) -> date:
    """``value`` as a date; today in UTC when absent."""
    if value is None:
        return datetime.now(timezone.utc).date()
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def as_timestamp(value: datetime | str | None = None) -> datetime:
    """``value`` as a zone-less UTC datetime; now when absent."""
    if value is None:
        value = datetime.now(timezone.utc)
    elif isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def date_literal(value: date | str | None = None) -> Column:
    return F.lit(as_date(value))


def timestamp_literal(value: datetime | str | None = None) -> Column:
    # Through text: a datetime literal would pass through the session and the machine time zone.
    return F.lit(as_timestamp(value).isoformat(sep=" ")).cast("timestamp_ntz")
