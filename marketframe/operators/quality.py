"""The quality gate: null check, then one row per key, then range check, with its report.

All of it comes from a single aggregation by key. ``gate_keys`` gives one row per key, holding the
surviving row and the counters of everything the key lost on the way; valid rows are a filter on
it and the report is a sum over it. Written once, it serves both without a second pass.
"""

import logging
from collections.abc import Sequence
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas
from marketframe.functions import as_timestamp, timestamp_literal
from marketframe.operators.latest import latest_per_key, newest_first

logger = logging.getLogger(__name__)

ROWS = "gate_rows"
COMPLETE = "gate_complete"
NULLS = "gate_null_"
VALID = "valid"
TIMESTAMP = "timestamp_ms"


def _all_present(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def _positive(price: Column, kind: T.DataType) -> Column:
    positive = price > 0
    # NaN compares greater than every number.
    return positive & ~F.isnan(price) if isinstance(kind, (T.DoubleType, T.FloatType)) else positive


def _survivor_order(df: DataFrame, price: str) -> list[str]:
    return [name for name in (TIMESTAMP, price) if name in df.columns]


def null_filter(df: DataFrame, critical: Sequence[str] = schemas.CRITICAL_COLUMNS) -> DataFrame:
    # dropna() would take NaN as well, which is for the range check to count.
    return df.filter(_all_present(critical))


def range_filter(df: DataFrame, price: str = "price_usd") -> DataFrame:
    return df.filter(_positive(F.col(price), df.schema[price].dataType))


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count of every column, one pass, one row."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])


def gate_keys(
    df: DataFrame,
    keys: Sequence[str] = schemas.FACT_KEYS,
    critical: Sequence[str] = schemas.CRITICAL_COLUMNS,
    order: Sequence[str] | None = None,
    price: str = "price_usd",
    profile: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the survivor's columns, the counters, and whether it passes the range check.

    The survivor is the latest by ``order`` (by default ``timestamp_ms`` where there is one, then
    the price), ties by the other columns. A survivor with a bad price loses its whole key, also
    where another copy was good: the order of the checks is part of the result. NULLs are counted
    in the columns of ``profile``, by default all but ``timestamp_ms``.
    """
    order = _survivor_order(df, price) if order is None else order
    if profile is None:
        profile = [name for name in df.columns if name != TIMESTAMP]
    rest = [name for name in df.columns if name not in keys]
    complete = _all_present(critical)
    gated = df.groupBy(*keys).agg(
        F.max(F.when(complete, newest_first(order, rest))).alias("best"),
        F.count(F.lit(1)).alias(ROWS),
        F.count_if(complete).alias(COMPLETE),
        *[F.count(name).alias(NULLS + name) for name in profile if name not in keys],
    )

    def nulls(name: str) -> Column:
        if name in keys:
            return F.when(F.col(name).isNull(), F.col(ROWS)).otherwise(0)
        return F.col(ROWS) - F.col(NULLS + name)

    passes = _positive(F.col("best")[price], df.schema[price].dataType)
    return gated.select(
        *[name if name in keys else F.col("best")[name].alias(name) for name in df.columns],
        ROWS,
        COMPLETE,
        *[nulls(name).alias(NULLS + name) for name in profile],
        F.coalesce(passes, F.lit(False)).alias(VALID),
    )


def rejected_rows(
    df: DataFrame,
    keys: Sequence[str] = schemas.FACT_KEYS,
    critical: Sequence[str] = schemas.CRITICAL_COLUMNS,
    order: Sequence[str] | None = None,
    price: str = "price_usd",
) -> DataFrame:
    """Every row that the gate drops, with its ``reject_reason``: null, duplicate or range.

    Equal rows are counted before the join with the survivors, one row per key; a key with many
    rows is a skewed join that adaptive execution splits. Of rows equal to the survivor one is the
    survivor and the others are duplicates.
    """
    order = _survivor_order(df, price) if order is None else order
    rest = [name for name in df.columns if name not in keys]
    complete = _all_present(critical)
    unusable = df.filter(~complete).select("*", F.lit("null").alias("reject_reason"))
    whole = df.filter(complete)
    best = whole.groupBy(*keys).agg(F.max(newest_first(order, rest)).alias("best"))
    rows = whole.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    joined = rows.join(best, [*keys])
    survivor = newest_first(order, rest).eqNullSafe(F.col("best"))
    good = _positive(F.col(price), df.schema[price].dataType)
    extra = (F.col("copies") - F.when(survivor, 1).otherwise(0)).cast("int")
    reasons = F.concat(
        F.array_repeat(F.lit("duplicate"), extra),
        F.when(survivor & ~good, F.array(F.lit("range"))).otherwise(F.array().cast("array<string>")),
    )
    dropped = joined.select(*df.columns, F.explode(reasons).alias("reject_reason"))
    return unusable.unionByName(dropped)


def valid_rows(gated: DataFrame) -> DataFrame:
    """The rows that passed, in the columns of the gate's input."""
    counters = [n for n in gated.columns if n in (ROWS, COMPLETE, VALID) or n.startswith(NULLS)]
    return gated.filter(VALID).drop(*counters)


def _profiled(columns: Sequence[str]) -> list[str]:
    return [name.removeprefix(NULLS) for name in columns if name.startswith(NULLS)]


def report_counts(gated: DataFrame) -> list[Column]:
    """The sums over ``gate_keys`` that a report rests on; they can ride along with its write."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return [
        total(ROWS).alias("total_raw"),
        total(COMPLETE).alias("complete"),
        F.count_if(F.col(COMPLETE) > 0).alias("distinct_keys"),
        F.count_if(VALID).alias("total_valid"),
        *[total(NULLS + name).alias(NULLS + name) for name in _profiled(gated.columns)],
    ]


def quality_report(
    gated: DataFrame,
    threshold: float = schemas.PASS_MARK,
    run_time: datetime | str | None = None,
) -> DataFrame:
    """One row of counts by cause, NULLs by column, score in percent and pass mark.

    The score is rounded before it is compared, so 79.996 % passes a mark of 80.
    """
    sums = gated.agg(*report_counts(gated))
    score = F.round(F.col("total_valid") / F.col("total_raw") * 100, 2)
    names = _profiled(gated.columns)
    null_counts = [part for name in names for part in (F.lit(name), F.col(NULLS + name))]
    report = sums.select(
        timestamp_literal(as_timestamp(run_time)).alias("run_time"),
        "total_raw",
        "total_valid",
        (F.col("total_raw") - F.col("total_valid")).alias("total_dropped"),
        (F.col("total_raw") - F.col("complete")).alias("rows_dropped_null"),
        (F.col("complete") - F.col("distinct_keys")).alias("rows_dropped_dup"),
        (F.col("distinct_keys") - F.col("total_valid")).alias("rows_dropped_range"),
        F.create_map(*null_counts).alias("null_counts"),
        F.when(F.col("total_raw") > 0, score).otherwise(0.0).alias("quality_score_pct"),
    )
    return report.withColumn("passed", F.col("quality_score_pct") >= threshold)


def report_of(
    counts: dict[str, int],
    threshold: float = schemas.PASS_MARK,
    run_time: datetime | str | None = None,
) -> dict:
    """The report as a dictionary, from the values of ``report_counts``."""
    raw, valid = counts["total_raw"], counts["total_valid"]
    share = Decimal(repr(valid / raw * 100)) if raw else Decimal(0)
    score = float(share.quantize(Decimal("0.01"), ROUND_HALF_UP))
    return {
        "run_time": as_timestamp(run_time),
        "total_raw": raw,
        "total_valid": valid,
        "total_dropped": raw - valid,
        "rows_dropped_null": raw - counts["complete"],
        "rows_dropped_dup": counts["complete"] - counts["distinct_keys"],
        "rows_dropped_range": counts["distinct_keys"] - valid,
        "null_counts": {name: counts[NULLS + name] for name in _profiled(list(counts))},
        "quality_score_pct": score,
        "passed": score >= threshold,
    }


def gate_rows(
    df: DataFrame,
    keys: Sequence[str] = schemas.FACT_KEYS,
    critical: Sequence[str] = schemas.CRITICAL_COLUMNS,
    order: Sequence[str] | None = None,
    price: str = "price_usd",
) -> DataFrame:
    """The valid rows alone: without counters, incomplete rows can go in the scan already."""
    order = _survivor_order(df, price) if order is None else order
    return range_filter(latest_per_key(null_filter(df, critical), keys, order), price)


def quality_gate(
    df: DataFrame,
    keys: Sequence[str] = schemas.FACT_KEYS,
    critical: Sequence[str] = schemas.CRITICAL_COLUMNS,
    order: Sequence[str] | None = None,
    price: str = "price_usd",
    threshold: float = schemas.PASS_MARK,
) -> tuple[DataFrame, DataFrame]:
    """Valid rows and report, both lazy and each with its own plan.

    To use both, write ``gate_keys`` once and take ``valid_rows`` and ``quality_report`` of that.
    """
    report = quality_report(gate_keys(df, keys, critical, order, price), threshold)
    return gate_rows(df, keys, critical, order, price), report


def report_dict(report: DataFrame) -> dict:
    """The one-row report as a dictionary."""
    return report.first().asDict()


def enforce_quality(report: dict, on_fail: str = "warn") -> dict:
    """A score below the mark is a warning by default and stops the run only under ``raise``."""
    if on_fail not in ("warn", "raise"):
        raise ValueError(f"on_fail must be 'warn' or 'raise': {on_fail!r}")
    if not report["passed"]:
        message = (
            f"quality score {report['quality_score_pct']}% is below the mark "
            f"({report['total_valid']} of {report['total_raw']} rows valid)"
        )
        if on_fail == "raise":
            raise ValueError(message)
        logger.warning(message)
    return report
