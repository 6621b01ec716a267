"""The durable tables: partitioned parquet, changed a few partitions at a time.

A merge reads the partitions that its batch touches and writes them anew by Spark's dynamic partition
overwrite: files go to a staging folder and take the partitions' places when all tasks have
succeeded, so that a failed merge leaves the table as it was. One writer at a time holds the table.
"""

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas
from marketframe.sources.folders import exists
from marketframe.sources.lease import lease

PATIENCE = 900.0


@dataclass(frozen=True)
class Lake:
    """Paths below one root folder, and how its tables are kept.

    ``patience``: seconds that a writer waits for another one. ``keep_coverage``: loads also keep, for every
    coin and month, the set of days that have a price.
    """

    root: str
    patience: float = PATIENCE
    keep_coverage: bool = False

    @property
    def dim(self) -> str:
        return f"{self.root}/dim_coins"

    @property
    def fact(self) -> str:
        return f"{self.root}/fact_coin_prices"

    @property
    def coverage(self) -> str:
        return f"{self.root}/coin_months"

    @property
    def run_log(self) -> str:
        return f"{self.root}/pipeline_run_log"

    def curated(self, job: str, run_id: str, name: str) -> str:
        """A folder of this run only, so that concurrent jobs never overwrite each other."""
        return f"{self.root}/curated/job={job}/run={run_id}/{name}"

    def read_dim(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.dim, schemas.DIM, schemas.DIM_PARTITION, T.IntegerType())

    def read_fact(self, spark: SparkSession) -> DataFrame:
        """Prices with their month; a filter on either reaches the scan."""
        return self.read_fact_days(spark).drop(schemas.FACT_DAY)

    def read_fact_days(self, spark: SparkSession) -> DataFrame:
        """Prices with both partition columns, month and day."""
        stored = T.StructType([*schemas.FACT.fields, T.StructField(schemas.FACT_PARTITION, T.DateType())])
        return read_table(spark, self.fact, stored, schemas.FACT_DAY, T.DateType())

    def read_coverage(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.coverage, schemas.COVERAGE, schemas.FACT_PARTITION, T.DateType())


def bucket_of(coin_id: Column) -> Column:
    return F.pmod(F.hash(coin_id), F.lit(schemas.DIM_BUCKETS))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, partition: str, kind: T.DataType
) -> DataFrame:
    """A table with its (innermost) partition column last; one not written yet is empty."""
    full = T.StructType([*schema.fields, T.StructField(partition, kind)])
    if exists(spark, path):
        return spark.read.schema(full).parquet(path)
    empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in full]
    return spark.range(1).select(*empty).limit(0)


def merge_partitions(
    read: Callable[[], DataFrame],
    source: DataFrame,
    path: str,
    partition: str | Sequence[str],
    touched: Sequence[object],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    wait: float = PATIENCE,
    owner: str | None = None,
) -> None:
    """Merge ``source`` into the table at ``path``, rewriting only the partitions in ``touched``.

    ``read`` gives the table as it is once the lease is held; ``touched`` lists the values of the (last)
    partition column in ``source``, and is bounded by the calendar or the number of buckets, not by rows. ``merge`` must
    keep a row in each of these partitions. Raises ``TableBusyError`` if another writer does
    not finish within ``wait`` seconds.
    """
    spark = source.sparkSession
    columns = [partition] if isinstance(partition, str) else list(partition)
    with lease(spark, path, owner or uuid.uuid4().hex, wait):
        target = read().filter(F.col(columns[-1]).isin(*touched))
        writer = merge(target, source).write.mode("overwrite").partitionBy(*columns)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
