"""Whole jobs: read what landed, transform, load, with one run-log row per stage.

The extraction stage finds the landed files. They are parsed while they are transformed, so that a
malformed document is a failure of the transformation.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketframe import schemas
from marketframe.functions import as_date, as_timestamp
from marketframe.operators import clean_descriptions, register_views
from marketframe.plans.build import build_dimension, build_history, build_snapshot
from marketframe.plans.load import load_descriptions, load_dimension, load_history, load_snapshot
from marketframe.sources import (
    Lake,
    RunLog,
    read_coin_list,
    read_curated,
    read_description_document,
    read_descriptions,
    read_health,
    read_history,
    read_history_document,
    read_malformed,
    read_market,
    read_runs,
    read_valid,
    write_curated,
)


@dataclass(frozen=True)
class Landing:
    """Where raw JSON landed. ``multi_line=False`` for JSON lines, the form for large landings."""

    coins: str | None = None
    market: str | None = None
    history: str | None = None
    descriptions: str | None = None
    multi_line: bool = True
    mode: str = "FAILFAST"  # PERMISSIVE sets malformed history and description texts aside
    # Whole documents of history and descriptions are read in ranges of so many bytes.
    range_bytes: int | None = None

    def read_points(self, spark: SparkSession) -> DataFrame:
        if self.range_bytes is not None:
            return read_history_document(spark, self.history, self.range_bytes)
        return read_history(spark, self.history, self.multi_line, self.mode)

    def read_texts(self, spark: SparkSession) -> DataFrame:
        if self.range_bytes is not None:
            return read_description_document(spark, self.descriptions, self.range_bytes)
        return read_descriptions(spark, self.descriptions, self.multi_line, self.mode)


@dataclass(frozen=True)
class RunResult:
    run_id: str
    quality_report: dict


@dataclass(frozen=True)
class _Run:
    """Clocks, names and log of one run."""

    spark: SparkSession
    lake: Lake
    job: str
    run_id: str
    as_of: date
    run_ts: datetime

    @classmethod
    def start(
        cls,
        spark: SparkSession,
        lake: Lake,
        job: str,
        as_of: date | str | None = None,
        run_ts: datetime | str | None = None,
        run_id: str | None = None,
    ) -> "_Run":
        run_id = run_id or uuid.uuid4().hex
        return cls(spark, lake, job, run_id, as_date(as_of), as_timestamp(run_ts))

    @property
    def log(self) -> RunLog:
        return RunLog(self.spark, self.lake.run_log, self.run_id)

    def path(self, name: str) -> str:
        return self.lake.curated(self.job, self.run_id, name)

    def orphans(self, mode: str) -> str | None:
        """Where orphans are set aside; None where they fail the load."""
        if mode not in ("fail", "quarantine"):
            raise ValueError(f"orphans must be 'fail' or 'quarantine': {mode!r}")
        return self.path("orphans") if mode == "quarantine" else None

    def keep_malformed(self, landing: Landing, path: str, schema: T.DataType) -> int:
        """Write the documents that a permissive read passed over; returns their number."""
        if landing.mode == "FAILFAST":
            return 0
        found = read_malformed(self.spark, path, schema, landing.multi_line)
        found.write.mode("overwrite").parquet(self.path("malformed"))
        return self.spark.read.schema(found.schema).parquet(self.path("malformed")).count()


def _load_dimension(run: _Run, path: str) -> None:
    load_dimension(read_curated(run.spark, path, schemas.CURATED_DIM), run.lake)


def run_daily(
    spark: SparkSession,
    landing: Landing,
    lake: Lake,
    as_of: date | str | None = None,
    run_ts: datetime | str | None = None,
    run_id: str | None = None,
    on_fail: str = "warn",
    orphans: str = "fail",
) -> RunResult:
    """Coin list and market snapshot of ``as_of`` into the lake.

    ``orphans="quarantine"`` sets prices of unknown coins aside in the run's curated folder.
    """
    run = _Run.start(spark, lake, "daily", as_of, run_ts, run_id)
    with run.log.stage("extraction"):
        coins = read_coin_list(spark, landing.coins, landing.multi_line)
        market = read_market(spark, landing.market, landing.multi_line)
    with run.log.stage("transformation") as stage:
        dim_path = build_dimension(spark, coins, run.path("dim_coins"), run.run_ts)
        built = build_snapshot(
            spark, market, run.path("market_snapshot"), run.as_of, run.run_ts, on_fail=on_fail
        )
        stage.rows_processed = built["quality_report"]["total_valid"]
    with run.log.stage("loading"):
        _load_dimension(run, dim_path)
        snapshot = read_valid(spark, built["output_dir"], schemas.CURATED_SNAPSHOT)
        load_snapshot(snapshot, lake, unique=True, quarantine=run.orphans(orphans))
    _follow(spark, lake)
    return RunResult(run.run_id, built["quality_report"])


def run_backfill(
    spark: SparkSession,
    landing: Landing,
    lake: Lake,
    coin_ids: Sequence[str] | DataFrame | str | None = None,
    days: int | None = None,
    as_of: date | str | None = None,
    run_ts: datetime | str | None = None,
    run_id: str | None = None,
    on_fail: str = "warn",
    null_policy: str = "replace",
    orphans: str = "fail",
) -> RunResult:
    """Coin list first, then the price history: all that landed, or the coins and days named.

    The report counts what a selection leaves out (``total_unselected``) and the texts that a
    permissive landing could not parse (``malformed_documents``); these are kept, in ``malformed``
    of the run's curated folder. ``orphans`` as in ``run_daily``.
    """
    run = _Run.start(spark, lake, "backfill", as_of, run_ts, run_id)
    with run.log.stage("extraction"):
        coins = read_coin_list(spark, landing.coins, landing.multi_line)
        points = landing.read_points(spark)
    with run.log.stage("transformation") as stage:
        dim_path = build_dimension(spark, coins, run.path("dim_coins"), run.run_ts)
        selection = {"coin_ids": coin_ids, "days": days, "as_of": run.as_of}
        built = build_history(
            spark, points, run.path("price_history"), run.run_ts, selection, on_fail=on_fail
        )
        malformed = run.keep_malformed(landing, landing.history, schemas.HISTORY)
        built["quality_report"]["malformed_documents"] = malformed
        stage.rows_processed = built["quality_report"]["total_valid"]
    with run.log.stage("loading"):
        _load_dimension(run, dim_path)
        history = read_valid(spark, built["output_dir"], schemas.CURATED_HISTORY)
        load_history(history, lake, null_policy, True, run.orphans(orphans))
    _follow(spark, lake)
    return RunResult(run.run_id, built["quality_report"])


def run_all(
    spark: SparkSession,
    landing: Landing,
    lake: Lake,
    as_of: date | str | None = None,
    run_ts: datetime | str | None = None,
    **backfill_options: object,
) -> tuple[RunResult, RunResult]:
    """Daily snapshot, then backfill, from one landing."""
    daily = run_daily(spark, landing, lake, as_of, run_ts)
    backfill = run_backfill(spark, landing, lake, as_of=as_of, run_ts=run_ts, **backfill_options)
    return daily, backfill


def enrich_descriptions(
    spark: SparkSession, landing: Landing, lake: Lake, run_id: str | None = None
) -> dict[str, int]:
    """On demand, outside the scheduled jobs: landed descriptions onto existing coins."""
    run = _Run.start(spark, lake, "descriptions", run_id=run_id)
    landed = landing.read_texts(spark)
    cleaned = clean_descriptions(landed)
    path = write_curated(cleaned, run.path("texts"))
    counts = load_descriptions(read_curated(spark, path, cleaned.schema), lake, cleaned=True)
    if landing.mode != "FAILFAST":
        counts["malformed_documents"] = run.keep_malformed(
            landing, landing.descriptions, schemas.DESCRIPTIONS
        )
    _follow(spark, lake)
    return counts


# Sessions whose views are open, by the lake they show.
_OPEN: dict[str, list[tuple[SparkSession, date | str | None]]] = {}


def open_views(spark: SparkSession, lake: Lake, as_of: date | str | None = None) -> None:
    """The lake's tables and monitoring views as SQL views of this session.

    They show the tables as they were when opened. Jobs of this process renew them when they end; after a
    job elsewhere they have to be opened again.
    """
    run_log = read_runs(spark, lake.run_log)
    months = lake.read_coverage(spark) if lake.keep_coverage else None
    health = read_health(spark, lake.run_log)
    register_views(
        spark, lake.read_dim(spark), lake.read_fact(spark), run_log, as_of, months, health
    )
    others = [x for x in _OPEN.get(lake.root, []) if x[0] is not spark]
    _OPEN[lake.root] = [*others, (spark, as_of)]


def _follow(spark: SparkSession, lake: Lake) -> None:
    """Renew the views that sessions of this application hold on the lake."""
    context = spark.sparkContext.applicationId
    for session, as_of in _OPEN.get(lake.root, []):
        if session.sparkContext._jsc is not None and session.sparkContext.applicationId == context:
            open_views(session, lake, as_of)
