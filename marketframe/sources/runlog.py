"""The run log: the recorder that wraps each stage of a job, and the files it leaves.

Every run appends to a folder of its own. Runs of a closed period are put together into one table by
``compact_runs``, with their health by month beside it, so that the number of files that a reader lists
is that of the open runs and of the months. A run counts from the table as soon as it is in it; its own
folder is then only waiting to be removed, and is passed over.
"""

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas
from marketframe.functions import as_date, as_timestamp, month_of, timestamp_literal
from marketframe.sources.folders import exists, remove
from marketframe.sources.lease import lease

logger = logging.getLogger(__name__)

RUN, MONTH = "run", "month"
CLOSED = T.StructType([*schemas.RUN_LOG.fields, T.StructField(RUN, T.StringType())])
HEALTH = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("total_runs", T.LongType()),
        T.StructField("last_run", T.TimestampNTZType()),
        T.StructField("total_rows_processed", T.LongType()),
    ]
)


def append_runs(rows: DataFrame, path: str, namespace: str, repeat_of: str | None = None) -> None:
    """Append log rows. Two jobs appending at once need two namespaces (such as their run ids).

    ``repeat_of`` names rows that a repeated run writes again: they replace those of the same name.
    """
    names, folder = schemas.RUN_LOG.names, f"{path}/{RUN}={namespace}"
    if repeat_of is None:
        rows.select(*names).write.mode("append").parquet(folder)
    else:
        rows.select(*names).write.mode("overwrite").parquet(f"{folder}/{repeat_of}")


def _read(spark: SparkSession, path: str, schema: T.StructType, **options: object) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**options).parquet(path)


def _open_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows in the folders of runs, with the run's name."""
    rows = _read(spark, path, schemas.RUN_LOG, recursiveFileLookup=True)
    name = F.regexp_extract(F.input_file_name(), f"/{RUN}=([^/]+)/", 1)
    return rows.withColumn(RUN, F.url_decode(name))


def _closed(path: str) -> tuple[str, str]:
    return f"{path}_closed/rows", f"{path}_closed/health"


def _closed_rows(spark: SparkSession, path: str) -> DataFrame:
    full = T.StructType([*CLOSED.fields, T.StructField(MONTH, T.DateType())])
    return _read(spark, _closed(path)[0], full)


def _waiting(spark: SparkSession, path: str) -> DataFrame:
    """Open rows of runs that are not in the closed table yet."""
    closed = _closed_rows(spark, path).select(RUN).distinct()
    return _open_rows(spark, path).join(closed, RUN, "left_anti").select(*CLOSED.names)


def _has_closed(spark: SparkSession, path: str) -> bool:
    return exists(spark, _closed(path)[1])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the log; a log not written yet reads as empty."""
    if not _has_closed(spark, path):
        return _read(spark, path, schemas.RUN_LOG, recursiveFileLookup=True)
    names = schemas.RUN_LOG.names
    return _closed_rows(spark, path).select(*names).unionByName(_waiting(spark, path).select(*names))


def _health(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, "stage", "status").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.max("run_date").alias("last_run"),
        F.sum("rows_processed").alias("total_rows_processed"),
    )


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """Runs, last run and rows by stage and status: closed months as summed, and the open runs."""
    if not _has_closed(spark, path):
        both = _health(_read(spark, path, schemas.RUN_LOG, recursiveFileLookup=True))
    else:
        full = T.StructType([*HEALTH.fields, T.StructField(MONTH, T.DateType())])
        closed = _read(spark, _closed(path)[1], full).drop(MONTH)
        both = closed.unionByName(_health(_waiting(spark, path)))
    health = both.groupBy("stage", "status").agg(
        F.sum("total_runs").alias("total_runs"),
        F.max("last_run").alias("last_run"),
        F.sum("total_rows_processed").alias("total_rows_processed"),
    )
    return health.orderBy("stage", "status")


def compact_runs(spark: SparkSession, path: str, before: date | str, wait: float = 900.0) -> int:
    """Close the runs whose rows are all from before a day; returns how many there were.

    Touched months of the table and of the health are written anew. Only then do the runs' own folders go;
    those that an earlier call left behind go as well.
    """
    rows_path, health_path = _closed(path)
    with lease(spark, f"{path}_closed", "compaction", wait):
        limit = F.lit(as_date(before)).cast("timestamp_ntz")
        open_rows = _open_rows(spark, path)
        ended = open_rows.groupBy(RUN).agg(F.max("run_date").alias("last")).filter(F.col("last") < limit)
        # One name for each open run: what the files bound already.
        names = sorted(r[0] for r in ended.select(RUN).collect())
        if not names:
            return 0
        known = _closed_rows(spark, path)
        ready = open_rows.join(ended.select(RUN), RUN, "left_semi")
        fresh = ready.join(known.select(RUN).distinct(), RUN, "left_anti")
        month = month_of(F.col("run_date").cast("date")).alias(MONTH)
        # Of all runs to close, also of those that an interrupted call has moved but not summed.
        months = [r[0] for r in ready.select(month).distinct().collect()]
        fresh = fresh.select("*", month).select(*known.columns)
        merged = known.filter(F.col(MONTH).isin(*months)).unionByName(fresh)
        _replace(merged.hint("rebalance", MONTH), rows_path)
        touched = _closed_rows(spark, path).filter(F.col(MONTH).isin(*months))
        _replace(_health(touched, MONTH).coalesce(1), health_path)
        for name in names:
            remove(spark, f"{path}/{RUN}={name}")
        return len(names)


def _replace(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").partitionBy(MONTH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


@dataclass
class StageRun:
    """What a stage reports about itself while it runs."""

    rows_processed: int | None = None


@dataclass
class RunLog:
    """One row per stage: success or failure, and the rows processed where a stage counts them.

    ``repeatable``: a run that is repeated under its id replaces the rows it wrote before.
    """

    spark: SparkSession
    path: str
    run_id: str
    clock: Callable[[], datetime] = field(default=as_timestamp)
    repeatable: bool = False

    def append(
        self,
        stage: str,
        status: str,
        rows_processed: int | None = None,
        error_message: str | None = None,
    ) -> None:
        """A stage or status outside its domain raises; a failing write is only reported."""
        if stage not in schemas.STAGES:
            raise ValueError(f"stage must be one of {schemas.STAGES}: {stage!r}")
        if status not in schemas.STATUSES:
            raise ValueError(f"status must be one of {schemas.STATUSES}: {status!r}")
        values = {
            "run_date": timestamp_literal(self.clock()),
            "stage": F.lit(stage),
            "status": F.lit(status),
            "rows_processed": F.lit(rows_processed),
            "error_message": F.lit(error_message),
        }
        row = [values[f.name].cast(f.dataType).alias(f.name) for f in schemas.RUN_LOG]
        try:
            one = self.spark.range(0, 1, numPartitions=1).select(*row)
            append_runs(one, self.path, self.run_id, stage if self.repeatable else None)
        except Exception:
            logger.exception("run log row not written: stage=%s status=%s", stage, status)

    @contextmanager
    def stage(self, name: str) -> Iterator[StageRun]:
        run = StageRun()
        try:
            yield run
        except Exception as error:
            self.append(name, "failed", error_message=str(error))
            raise
        self.append(name, "success", rows_processed=run.rows_processed)
