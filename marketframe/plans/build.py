"""Transform stage: landed frames to curated files, with the quality report."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketframe import schemas
from marketframe.operators import (
    clean_coins,
    clean_history,
    clean_snapshot,
    enforce_quality,
    gate_keys,
    report_counts,
    report_of,
    select_backfill,
    valid_rows,
)
from marketframe.operators.quality import VALID
from marketframe.sources import write_curated


def _observed(df: DataFrame, *counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counts that ride along with the action on it.

    They are taken in the stage of that action, where a repeated task counts once.
    """
    observation = Observation()
    return df.observe(observation, *counts), observation


def build_dimension(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    run_ts: datetime | str | None = None,
    fmt: str = "parquet",
) -> str:
    """Curated dimension at ``out``; raises when the list is empty."""
    cleaned, seen = _observed(clean_coins(raw, run_ts), F.count(F.lit(1)).alias("coins"))
    write_curated(cleaned, out, fmt)
    if not seen.get["coins"]:
        raise ValueError(f"no data found in {out}")
    return out


def _gate(
    spark: SparkSession, cleaned: DataFrame, out: str, columns: list[str], fmt: str, on_fail: str
) -> dict:
    """Run the gate once and write it, split by ``valid``; the report's counts ride along."""
    gated_path = out if fmt == "parquet" else f"{out}/gate"
    gated = gate_keys(cleaned)
    counted, seen = _observed(gated, *report_counts(gated))
    counted.write.mode("overwrite").partitionBy(VALID).parquet(gated_path)
    report = enforce_quality(report_of(seen.get), on_fail)
    if fmt != "parquet":
        written = spark.read.schema(gated.schema).parquet(gated_path)
        write_curated(valid_rows(written).select(*columns), f"{out}/rows", fmt)
    return {"output_dir": out, "quality_report": report}


def build_snapshot(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    as_of: date | str | None = None,
    run_ts: datetime | str | None = None,
    fmt: str = "parquet",
    on_fail: str = "warn",
) -> dict:
    """Curated snapshot at ``out``; raises when no row survives the gate."""
    cleaned = clean_snapshot(raw, as_of, run_ts)
    result = _gate(spark, cleaned, out, schemas.CURATED_SNAPSHOT.names, fmt, on_fail)
    if not result["quality_report"]["total_valid"]:
        raise ValueError("no data found in market snapshot")
    return result


def build_history(
    spark: SparkSession,
    points: DataFrame,
    out: str,
    run_ts: datetime | str | None = None,
    selection: dict | None = None,
    fmt: str = "parquet",
    on_fail: str = "warn",
) -> dict:
    """Curated history at ``out``; raises when there was no point at all to flatten.

    ``selection`` holds arguments of ``select_backfill``; without it everything landed is taken.
    The report's ``total_unselected`` counts the points that a selection leaves out.
    """
    landed = cleaned = clean_history(points, run_ts)
    named = selection is not None and any(selection.get(k) is not None for k in ("coin_ids", "days"))
    if named:
        cleaned = select_backfill(cleaned, **selection)
    result = _gate(spark, cleaned, out, schemas.CURATED_HISTORY.names, fmt, on_fail)
    report = result["quality_report"]
    # Counted apart: a count taken before the gate's shuffle would count repeated tasks twice.
    report["total_unselected"] = landed.count() - report["total_raw"] if named else 0
    if not report["total_raw"]:
        raise ValueError("no data found in price history")
    return result
