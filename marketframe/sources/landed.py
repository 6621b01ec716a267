"""Readers of landed JSON.

``multi_line=True`` reads one document per file, as an API client saves it. Such a file is one
task, so large landings should be JSON lines (``multi_line=False``) or one file per coin.
A malformed document fails the read unless ``mode`` says otherwise; ``read_malformed`` gives the
documents that a permissive read passes over.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas
from marketframe.functions import strip_text


def _read_objects(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, mode: str
) -> DataFrame:
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode)
    return reader.json(path)


def read_coin_list(
    spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    return _read_objects(spark, path, schemas.COIN_LIST, multi_line, mode)


def read_market(
    spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    return _read_objects(spark, path, schemas.MARKET, multi_line, mode)


def read_coin_details(
    spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """Coin detail objects to the English description of each coin, stripped, empty if absent."""
    details = _read_objects(spark, path, schemas.COIN_DETAILS, multi_line, mode)
    return details.select(
        F.col("id").alias("coin_id"), strip_text(F.col("description.en")).alias("description")
    )


def _parse(document: str | Column, schema: T.DataType, mode: str) -> Column:
    document = F.col(document) if isinstance(document, str) else document
    return F.from_json(document, schema, {"mode": mode})


def flatten_history(
    documents: DataFrame, column: str = "value", mode: str = "FAILFAST"
) -> DataFrame:
    """Text documents ``{coin: {"prices": [[ms, price], …]}}`` to one row per point.

    A coin without prices gives no rows; a short or unusable pair gives NULLs for the gate to drop.
    """
    coins = documents.select(
        F.explode(_parse(column, schemas.HISTORY, mode)).alias("coin_id", "series")
    )
    points = coins.select("coin_id", F.explode("series.prices").alias("point"))
    return points.select(
        "coin_id",
        F.get("point", F.lit(0)).try_cast("bigint").alias("timestamp_ms"),
        F.get("point", F.lit(1)).alias("price_usd"),
    )


def flatten_descriptions(
    documents: DataFrame, column: str = "value", mode: str = "FAILFAST"
) -> DataFrame:
    """Text documents ``{coin: text}`` to one row per coin."""
    return documents.select(
        F.explode(_parse(column, schemas.DESCRIPTIONS, mode)).alias("coin_id", "description")
    )


def malformed_documents(documents: DataFrame, schema: T.DataType, column: str = "value") -> DataFrame:
    """The text documents that do not parse; under ``mode="PERMISSIVE"`` they give no rows."""
    unread = _parse(column, schema, "PERMISSIVE").isNull()
    return documents.filter(F.col(column).isNotNull() & unread)


def read_malformed(spark: SparkSession, path: str, schema: T.DataType, multi_line: bool = True) -> DataFrame:
    """Documents at ``path`` that a permissive read of history or descriptions passes over."""
    return malformed_documents(spark.read.text(path, wholetext=multi_line), schema)


def read_history(
    spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    return flatten_history(spark.read.text(path, wholetext=multi_line), mode=mode)


def read_descriptions(
    spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    return flatten_descriptions(spark.read.text(path, wholetext=multi_line), mode=mode)
