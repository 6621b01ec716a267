"""Landed shape to curated shape: projections, types, stamps, selection."""

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import schemas
from marketframe.functions import (
    as_date,
    date_literal,
    epoch_ms_to_date,
    strip_text,
    timestamp_literal,
)


def clean_coins(raw: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    return raw.select(
        F.col("id").alias("coin_id"),
        "symbol",
        "name",
        timestamp_literal(run_ts).alias("loaded_at"),
    )


def clean_snapshot(
    raw: DataFrame, as_of: date | str | None = None, run_ts: datetime | str | None = None
) -> DataFrame:
    """One day's market snapshot. Numbers that arrive as unusable text become NULL for the gate.

    ``as_of="price_date"`` takes the day from that column, for snapshots of several days.
    """
    return raw.select(
        F.col("id").alias("coin_id"),
        F.col("current_price").try_cast("double").alias("price_usd"),
        F.col("market_cap").try_cast("double").alias("market_cap_usd"),
        F.col("total_volume").try_cast("double").alias("volume_24h_usd"),
        F.col(as_of) if as_of == "price_date" else date_literal(as_of).alias("price_date"),
        timestamp_literal(run_ts).alias("processed_at"),
    )


def clean_history(points: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Flattened history points, dated. ``timestamp_ms`` stays: the gate picks the latest by it."""
    return points.select(
        "coin_id",
        epoch_ms_to_date(F.col("timestamp_ms")).alias("price_date"),
        F.col("price_usd").try_cast("double").alias("price_usd"),
        timestamp_literal(run_ts).alias("processed_at"),
        "timestamp_ms",
    )


def pad_history(history: DataFrame) -> DataFrame:
    """History in the common fact shape: it carries prices only."""
    return history.select(
        *schemas.FACT_KEYS,
        "price_usd",
        F.lit(None).cast("double").alias("market_cap_usd"),
        F.lit(None).cast("double").alias("volume_24h_usd"),
        "processed_at",
    )


def clean_descriptions(descriptions: DataFrame) -> DataFrame:
    """Stripped, non-empty texts, one per coin; should a coin come twice, the greater text stays."""
    stripped = descriptions.select("coin_id", strip_text(F.col("description")).alias("description"))
    kept = stripped.filter(F.col("coin_id").isNotNull() & (F.length("description") > 0))
    return kept.groupBy("coin_id").agg(F.max("description").alias("description"))


def select_backfill(
    history: DataFrame,
    coin_ids: Sequence[str] | DataFrame | str | None = None,
    days: int | None = None,
    as_of: date | str | None = None,
) -> DataFrame:
    """The coins and the last ``days`` days to backfill: everything, unless a selection is named.

    ``coin_ids`` is a list, a DataFrame with a ``coin_id`` column for selections of any size, or
    None (or ``"all"``) for all coins; ``days=None`` keeps the whole span. Rows without a date fall
    out only where a span is given.
    """
    if isinstance(coin_ids, DataFrame):
        selected = history.join(coin_ids.select("coin_id"), "coin_id", "left_semi")
    elif coin_ids is None or coin_ids == "all":
        selected = history
    else:
        selected = history.filter(F.col("coin_id").isin(*coin_ids))
    if days is None:
        return selected.select(*history.columns)
    start = as_date(as_of) - timedelta(days=days)
    return selected.filter(F.col("price_date") > F.lit(start)).select(*history.columns)


def ensure_column(df: DataFrame, name: str, kind: str = "string") -> DataFrame:
    """Add a NULL column unless there is one: an additive migration that can be repeated."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def default_now(df: DataFrame, name: str, run_ts: datetime | str | None = None) -> DataFrame:
    """Stamp a column that is absent. A NULL that is present stays NULL, as with a table default."""
    return df if name in df.columns else df.withColumn(name, timestamp_literal(run_ts))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when there is nothing to work on."""
    if df.isEmpty():
        raise ValueError(f"no data found in {what}")
    return df
