"""Loads of only what has landed since the last run.

A file stream over the landing folder remembers in its checkpoint which files it has taken. Each call takes
what is new (``availableNow``) and ends. A batch goes through the same build and load as a whole
run, under a run id made from the stream and the batch: a batch that was cut off after its load repeats with
the same id and files, merges the same keys again, and replaces its own curated files and log rows, so that
nothing is lost or counted twice.
"""

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas
from marketframe.functions import as_date, as_timestamp
from marketframe.plans.build import build_dimension, build_history, build_snapshot
from marketframe.plans.jobs import Landing
from marketframe.plans.load import load_dimension, load_history, load_snapshot
from marketframe.sources import (
    Lake,
    RunLog,
    flatten_history,
    read_coin_list,
    read_curated,
    read_valid,
)


def _follow(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    multi_line: bool,
    files_at_once: int | None,
    take: Callable[[DataFrame, int], None],
) -> list[int]:
    """Hand the texts of new files to ``take``, batch by batch; returns the batches' numbers."""
    reader = spark.readStream.format("text").option("wholetext", multi_line)
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    texts = reader.load(folder).select("value", F.to_date("_metadata.file_modification_time").alias("landed"))
    taken: list[int] = []

    def batch(texts: DataFrame, number: int) -> None:
        take(texts, number)
        taken.append(number)

    stream = texts.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
    return taken


def _load_coins(spark: SparkSession, landing: Landing, lake: Lake, out: str, run_ts: datetime) -> None:
    coins = read_coin_list(spark, landing.coins, landing.multi_line)
    path = build_dimension(spark, coins, out, run_ts)
    load_dimension(read_curated(spark, path, schemas.CURATED_DIM), lake)


def follow_history(
    spark: SparkSession,
    landing: Landing,
    lake: Lake,
    checkpoint: str,
    run_ts: datetime | str | None = None,
    null_policy: str = "replace",
    files_at_once: int | None = None,
    stream: str = "history",
) -> dict[int, dict]:
    """Load the history files that are new in the folder ``landing.history``; reports by batch.

    Files should land in the order of their points: of a coin and day that comes in two batches the later
    batch counts, of one that comes twice in a batch the later point. The coin list is read anew for every batch.
    """
    reports: dict[int, dict] = {}
    stamp = as_timestamp(run_ts)

    def take(texts: DataFrame, number: int) -> None:
        run = f"{stream}-{number}"
        log = RunLog(spark, lake.run_log, run, repeatable=True)
        path = lambda name: lake.curated("follow", run, name)
        with log.stage("extraction"):
            points = flatten_history(texts, mode=landing.mode)
        with log.stage("transformation") as stage:
            built = build_history(spark, points, path("price_history"), stamp)
            stage.rows_processed = built["quality_report"]["total_valid"]
        with log.stage("loading"):
            _load_coins(spark, landing, lake, path("dim_coins"), stamp)
            rows = read_valid(spark, built["output_dir"], schemas.CURATED_HISTORY)
            load_history(rows, lake, null_policy, True)
        reports[number] = built["quality_report"]

    _follow(spark, landing.history, checkpoint, landing.multi_line, files_at_once, take)
    return reports


def follow_market(
    spark: SparkSession,
    landing: Landing,
    lake: Lake,
    checkpoint: str,
    as_of: date | str | None = None,
    run_ts: datetime | str | None = None,
    files_at_once: int | None = None,
    stream: str = "market",
) -> dict[int, dict]:
    """Load the market snapshots that are new in the folder ``landing.market``; reports by batch.

    A snapshot is of the day ``as_of``, or of the day on which its file landed.
    """
    reports: dict[int, dict] = {}
    stamp = as_timestamp(run_ts)
    day = F.col("landed") if as_of is None else F.lit(as_date(as_of))

    def take(texts: DataFrame, number: int) -> None:
        run = f"{stream}-{number}"
        log = RunLog(spark, lake.run_log, run, repeatable=True)
        path = lambda name: lake.curated("follow", run, name)
        with log.stage("extraction"):
            kind = T.ArrayType(schemas.MARKET) if landing.multi_line else schemas.MARKET
            parsed = F.from_json("value", kind, {"mode": landing.mode})
            rows = F.explode(parsed) if landing.multi_line else parsed
            market = texts.select(rows.alias("row"), day.alias("price_date")).select("row.*", "price_date")
        with log.stage("transformation") as stage:
            built = build_snapshot(spark, market, path("market_snapshot"), "price_date", stamp)
            stage.rows_processed = built["quality_report"]["total_valid"]
        with log.stage("loading"):
            _load_coins(spark, landing, lake, path("dim_coins"), stamp)
            load_snapshot(read_valid(spark, built["output_dir"], schemas.CURATED_SNAPSHOT), lake, unique=True)
        reports[number] = built["quality_report"]

    _follow(spark, landing.market, checkpoint, landing.multi_line, files_at_once, take)
    return reports
