"""Load stage: curated frames into the durable tables, constraints first.

Each loader looks at its input more than once, so hand it a frame read from files.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import schemas
from marketframe.functions import month_of
from marketframe.operators import (
    assert_rules,
    clean_descriptions,
    coin_months,
    description_update_counts,
    dim_rules,
    fact_rules,
    merge_coverage,
    pad_history,
    split_orphans,
    to_fact,
    update_descriptions,
    upsert_dim,
    upsert_fact,
)
from marketframe.sources import Lake, merge_partitions
from marketframe.sources.lake import bucket_of


def _by_bucket(merged: DataFrame) -> DataFrame:
    """One file for a bucket, or several of the advised size, instead of one from every task."""
    return merged.hint("rebalance", schemas.DIM_PARTITION)


def load_dimension(curated: DataFrame, lake: Lake) -> None:
    bucket = bucket_of(F.col("coin_id"))
    touched = assert_rules(curated, dim_rules(), "dim_coins", bucket)
    merge_partitions(
        lambda: lake.read_dim(curated.sparkSession),
        curated.withColumn(schemas.DIM_PARTITION, bucket),
        lake.dim,
        schemas.DIM_PARTITION,
        touched,
        lambda target, source: _by_bucket(upsert_dim(target, source)),
        lake.patience,
    )


def _load_fact(
    curated: DataFrame, lake: Lake, null_policy: str, unique: bool, quarantine: str | None
) -> None:
    spark, day = curated.sparkSession, F.col("price_date")
    if quarantine is not None:
        known, orphans = split_orphans(curated, lake.read_dim(spark))
        orphans.write.mode("overwrite").parquet(quarantine)
        curated = known
    # Rules, orphans and touched days come from one pass over the batch.
    known = lake.read_dim(spark).select("coin_id", F.lit(True).alias("known"))
    orphan = F.col("coin_id").isNotNull() & F.col("known").isNull()
    rules = {**fact_rules(), "coin_id is not in dim_coins": orphan}
    if quarantine is None:
        checked = curated.join(known, "coin_id", "left")
    else:
        checked = curated.withColumn("known", F.lit(True))
    touched = assert_rules(checked, rules, "fact_coin_prices", day, F.col("coin_id"))
    rows = to_fact(curated, unique).withColumn(schemas.FACT_PARTITION, month_of(day))
    # One file for a day of the batch, or several of the advised size; the table's rows stay in place.
    rows = rows.withColumn(schemas.FACT_DAY, day).hint("rebalance", schemas.FACT_DAY)
    merge_partitions(
        lambda: lake.read_fact_days(spark),
        rows,
        lake.fact,
        [schemas.FACT_PARTITION, schemas.FACT_DAY],
        touched,
        lambda target, source: upsert_fact(target, source, null_policy),
        lake.patience,
    )
    if lake.keep_coverage:
        merge_partitions(
            lambda: lake.read_coverage(spark),
            coin_months(curated),
            lake.coverage,
            schemas.FACT_PARTITION,
            sorted({d.replace(day=1) for d in touched}),
            merge_coverage,
            lake.patience,
        )


def load_snapshot(
    curated: DataFrame,
    lake: Lake,
    null_policy: str = "replace",
    unique: bool = False,
    quarantine: str | None = None,
) -> None:
    """Load the snapshot. ``unique`` as in ``to_fact``. A coin that is not in the dimension fails
    the load, or its rows go to the folder ``quarantine`` where one is named."""
    _load_fact(curated, lake, null_policy, unique, quarantine)


def load_history(
    curated: DataFrame,
    lake: Lake,
    null_policy: str = "replace",
    unique: bool = False,
    quarantine: str | None = None,
) -> None:
    """Load price history; under ``replace`` it erases market cap and volume it meets."""
    _load_fact(pad_history(curated), lake, null_policy, unique, quarantine)


def load_descriptions(
    descriptions: DataFrame, lake: Lake, cleaned: bool = False
) -> dict[str, int]:
    """Set descriptions of existing coins; returns how many were attempted and how many matched.

    ``cleaned`` says that the texts come out of ``clean_descriptions``.
    """
    bucket = bucket_of(F.col("coin_id"))
    touched = assert_rules(descriptions, {}, "descriptions", bucket)
    texts = descriptions if cleaned else clean_descriptions(descriptions)
    dim = lake.read_dim(descriptions.sparkSession)
    counts = description_update_counts(dim, texts).first().asDict()
    merge_partitions(
        lambda: lake.read_dim(descriptions.sparkSession),
        texts,
        lake.dim,
        schemas.DIM_PARTITION,
        touched,
        lambda target, source: _by_bucket(update_descriptions(target, source)),
        lake.patience,
    )
    return counts
