"""Whole-document landings read by byte ranges, through the data source of ``ranges``."""

import json
import sys
from itertools import groupby

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from marketframe.sources import ranges

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _read(spark: SparkSession, path: str, kind: str, range_bytes: int) -> DataFrame:
    cloudpickle.register_pickle_by_value(sys.modules[ranges.__name__])
    spark.dataSource.register(ranges.DocumentRanges)
    spark.conf.set(PUSHDOWN, "true")
    source = spark.read.format(ranges.DocumentRanges.name())
    source = source.option("kind", kind).option("range_bytes", str(range_bytes))
    # One small row per range: the only thing that comes to the driver.
    found = sorted(map(tuple, source.load(path).collect()))
    states = []
    for file, rows in groupby(found, key=lambda r: r[0]):
        described = []
        for _, start, stop, text in rows:
            mark = json.loads(text)
            place = {"path": file, "start": start, "stop": stop, "size": mark["size"]}
            described.append({"range": place, "marks": mark["marks"]})
        states += ranges.place_ranges(described)
    return source.option("states", json.dumps(states)).load(path)


def read_history_document(
    spark: SparkSession, path: str, range_bytes: int = ranges.RANGE_BYTES
) -> DataFrame:
    """Points of history documents of any size, a file or a folder of them; a task per range.

    Rows are those of ``read_history``; a document that is not JSON of the expected form fails. The
    coins of a filter on ``coin_id`` (``=``, ``IN``) are the only ones whose points are parsed.
    A file that holds nothing gives no rows. The folder must be one that executors reach by pyarrow's file
    systems (local, HDFS, S3, GCS).
    """
    return _read(spark, path, "history", range_bytes)


def read_description_document(
    spark: SparkSession, path: str, range_bytes: int = ranges.RANGE_BYTES
) -> DataFrame:
    """Texts of description documents of any size, as ``read_descriptions`` gives them."""
    return _read(spark, path, "descriptions", range_bytes)
