"""Keys of a batch that the stored table holds already, or lacks a parent for, before anything is loaded."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import schemas
from marketframe.session import scratch_dir

# Join the table by a shuffle, and let a Bloom filter of the batch's keys thin it out before: Spark builds
# that filter at run time where the batch is at most the creation side's threshold.
_PRUNED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def clash_join(batch: DataFrame, stored: DataFrame, keys: Sequence[str] = schemas.FACT_KEYS) -> DataFrame:
    """The stored rows' keys that the batch holds too, one row for each stored row.

    The batch's filters let Spark see that it is selective, which its run-time filter asks for.
    """
    wanted = batch
    for key in keys:
        wanted = wanted.filter(F.col(key).isNotNull())
    wanted = wanted.filter(F.length(F.col(keys[0])) >= 0).select(*keys)
    return stored.select(*keys).join(wanted, list(keys), "left_semi")


def stored_clashes(
    batch: DataFrame, stored: DataFrame, keys: Sequence[str] = schemas.FACT_KEYS, spread: bool = True
) -> DataFrame:
    """Keys of ``batch`` that ``stored`` holds, with the number of stored rows.

    Both should be read from files. ``spread`` shuffles the stored table, thinned out by a Bloom filter of the
    batch's keys; without it Spark may broadcast a small batch instead. The result is written
    below the scratch folder.
    """
    spark = batch.sparkSession
    path = f"{scratch_dir(spark, 'clashes')}/rows"
    with settings(spark, _PRUNED if spread else {}):
        found = clash_join(batch, stored, keys)
        found.groupBy(*keys).agg(F.count(F.lit(1)).alias("stored_rows")).write.parquet(path)
    return spark.read.parquet(path)
