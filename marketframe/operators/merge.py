"""Keyed merges as joins: insert-or-update for both tables, update-only for descriptions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import schemas
from marketframe.functions import store_cast
from marketframe.operators.latest import latest_per_key


def to_fact(curated: DataFrame, unique: bool = False) -> DataFrame:
    """Curated prices as fact rows: latest per key, stored as decimals.

    ``unique=True`` says that keys are unique already (gate output), which saves a shuffle.
    """
    latest = curated if unique else latest_per_key(curated, schemas.FACT_KEYS, ["processed_at"])
    return latest.select(
        *schemas.FACT_KEYS,
        store_cast(F.col("price_usd"), schemas.PRICE_TYPE, "price_usd").alias("price_usd"),
        *[
            store_cast(F.col(name), schemas.AMOUNT_TYPE, name).alias(name)
            for name in ("market_cap_usd", "volume_24h_usd")
        ],
        "processed_at",
    )


def upsert_fact(target: DataFrame, source: DataFrame, null_policy: str = "replace") -> DataFrame:
    """``target`` with ``source`` inserted or replacing by ``(coin_id, price_date)``.

    ``replace`` takes all measures from the source, NULLs too: a backfill erases market cap and
    volume. ``keep`` lets a NULL leave the old value. Keys of ``source`` must be unique.

    The anti join sends only keys from the source side. Spark broadcasts them when their size is
    known to be small: then rows of the table are filtered where they are read. A large batch
    shuffles the touched partitions once.
    """
    source = source.select(*target.columns)
    if null_policy == "replace":
        untouched = target.join(source.select(*schemas.FACT_KEYS), schemas.FACT_KEYS, "left_anti")
        return untouched.select(*target.columns).unionByName(source)
    if null_policy != "keep":
        raise ValueError(f"null_policy must be 'replace' or 'keep': {null_policy!r}")
    joined = target.alias("old").join(source.alias("new"), schemas.FACT_KEYS, "full_outer")
    return joined.select(
        *[
            name if name in schemas.FACT_KEYS
            else F.coalesce(f"new.{name}", f"old.{name}").alias(name)
            for name in target.columns
        ]
    )


def upsert_dim(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` with ``source`` inserted or updated by ``coin_id``.

    Columns the source lacks, such as ``description``, keep their value. A coin that comes twice
    in one batch is an error, found while the rows are grouped for the join.
    """
    updated = [name for name in source.columns if name != "coin_id"]
    grouped = source.groupBy("coin_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max(F.struct(*updated)).alias("new"),
    )
    message = F.concat(F.lit("duplicate coin_id in dimension batch: "), F.col("coin_id"))
    single = grouped.filter(
        F.when(F.col("copies") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    )
    joined = target.join(single.select("coin_id", "new"), "coin_id", "full_outer")
    matched = F.col("new").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col("new")[name]).otherwise(F.col(name)).alias(name)
            if name in updated else name
            for name in target.columns
        ]
    )


def update_descriptions(dim: DataFrame, descriptions: DataFrame) -> DataFrame:
    """``dim`` with new descriptions where the coin exists; ids not in ``dim`` are ignored."""
    fresh = descriptions.select("coin_id", F.col("description").alias("fresh"))
    joined = dim.join(fresh, "coin_id", "left")
    return joined.select(
        *[
            F.coalesce("fresh", "description").alias(name) if name == "description" else name
            for name in dim.columns
        ]
    )


def description_update_counts(dim: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Updates attempted and updates that met a coin."""
    known = dim.select("coin_id", F.lit(True).alias("known"))
    joined = descriptions.select("coin_id").join(known, "coin_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count("known").alias("matched"),
    )
