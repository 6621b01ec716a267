from marketframe.functions.expressions import (
    epoch_ms_to_date,
    month_of,
    pct_change,
    stable_key,
    store_cast,
    strip_text,
)
from marketframe.functions.stamps import as_date, as_timestamp, date_literal, timestamp_literal

__all__ = [
    "as_date",
    "as_timestamp",
    "date_literal",
    "epoch_ms_to_date",
    "month_of",
    "pct_change",
    "stable_key",
    "store_cast",
    "strip_text",
    "timestamp_literal",
]
