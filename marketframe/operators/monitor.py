"""Monitoring views over the loaded tables.

Windows here run over one coin's days or months. Keys are unique in the price table, so such a
group is bounded by the calendar, however many rows the raw input had.
"""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe import schemas
from marketframe.functions import as_date, month_of, pct_change
from marketframe.operators.clean import ensure_column


def price_anomalies(
    fact: DataFrame, as_of: date | str | None = None, days: int = schemas.LOOKBACK_DAYS
) -> DataFrame:
    """Price, previous price and change in percent for each row of the last ``days`` days.

    The look-back is applied before the window: the first row of a coin in the slice has no
    previous price. Previous means the previous row, also across missing days. Later dates stay in.
    """
    start = as_date(as_of) - timedelta(days=days)
    recent = fact.filter(F.col("price_date") >= F.lit(start))
    if schemas.FACT_PARTITION in fact.columns:
        recent = recent.filter(F.col(schemas.FACT_PARTITION) >= F.lit(start.replace(day=1)))
    by_day = Window.partitionBy("coin_id").orderBy("price_date")
    followed = recent.select(
        "coin_id",
        "price_date",
        "price_usd",
        F.lag("price_usd").over(by_day).alias("previous_price"),
    )
    change = pct_change(F.col("price_usd"), F.col("previous_price"))
    return followed.withColumn("pct_change", change)


BLOCK_DAYS = 1024


def price_changes(fact: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Price, previous price and change in percent for every row of the whole table.

    A coin's days are cut into blocks by the calendar, and a window runs over one block. The last row of each
    block is carried to the first row of the coin's next one, by a window over a coin's blocks: as many as the
    calendar has, however many rows a coin holds.
    """
    block = F.floor(F.unix_date("price_date") / F.lit(block_days)).alias("block")
    rows = fact.select("coin_id", "price_date", "price_usd", block)
    by_day = Window.partitionBy("coin_id", "block").orderBy("price_date")
    near = rows.select(
        "*",
        F.lag("price_usd").over(by_day).alias("near"),
        (F.row_number().over(by_day) == 1).alias("opens"),
    )
    last = rows.groupBy("coin_id", "block").agg(
        F.max(F.struct("price_date", "price_usd"))["price_usd"].alias("last")
    )
    by_block = Window.partitionBy("coin_id").orderBy("block")
    carried = last.select(
        F.col("coin_id").alias("from_coin"),
        F.col("block").alias("from_block"),
        F.lag("last").over(by_block).alias("carried"),
    )
    met = F.col("opens") & F.col("coin_id").eqNullSafe(F.col("from_coin"))
    joined = near.join(carried, met & (F.col("block") == F.col("from_block")), "left")
    followed = joined.select(
        "coin_id",
        "price_date",
        "price_usd",
        F.when(F.col("opens"), F.col("carried")).otherwise(F.col("near")).alias("previous_price"),
    )
    change = pct_change(F.col("price_usd"), F.col("previous_price"))
    return followed.withColumn("pct_change", change)


def large_moves(anomalies: DataFrame, threshold: float = 20) -> DataFrame:
    """Changes beyond ``threshold`` percent either way, newest first."""
    large = anomalies.filter(F.abs("pct_change") > threshold)
    return large.orderBy(F.desc("price_date"), "coin_id")


def date_series(fact: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Every date from the first one in the table to ``as_of``; none if that is earlier."""
    last = F.lit(as_date(as_of))
    first = fact.agg(F.min("price_date").alias("first")).filter(F.col("first") <= last)
    days = F.sequence("first", F.greatest("first", last))
    return first.select(F.explode(days).alias("expected_date"))


def coin_months(fact: DataFrame) -> DataFrame:
    """Per coin and month the days with a price, as a bit set, and the first of them.

    Days shrink to sets before any shuffle, so that a thirtieth of the rows travels.
    """
    day = F.col("price_date")
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)
    grouped = fact.groupBy("coin_id", month_of(day).alias(schemas.FACT_PARTITION))
    return grouped.agg(F.bit_or(bit).alias("present"), F.min(day).alias("earliest"))


def merge_coverage(target: DataFrame, source: DataFrame) -> DataFrame:
    """Sets of the same coin and month become one."""
    both = target.unionByName(source.select(*target.columns))
    return both.groupBy("coin_id", schemas.FACT_PARTITION).agg(
        F.bit_or("present").alias("present"), F.min("earliest").alias("earliest")
    )


def missing_dates(
    dim: DataFrame, fact: DataFrame, as_of: date | str | None = None
) -> DataFrame:
    """Dates without a price, for each coin of ``dim`` that has any price.

    The span runs from the first date of the whole table to ``as_of``, the same for all coins.
    """
    return missing_from_coverage(dim, coin_months(fact), as_of)


def missing_from_coverage(
    dim: DataFrame, months: DataFrame, as_of: date | str | None = None
) -> DataFrame:
    """``missing_dates`` from the sets of days per coin and month.

    A coin's window holds months. Absent days come from incomplete months and from gaps between
    months; complete months are never expanded.
    """
    last = F.lit(as_date(as_of))
    months = months.withColumnRenamed(schemas.FACT_PARTITION, "month")
    # Both columns are asked for, so that the subquery is the same aggregation and reuses its exchange.
    first = months.agg(F.min(F.struct("earliest", "present"))["earliest"]).scalar()
    month = F.col("month")
    by_month = Window.partitionBy("coin_id").orderBy("month")
    before = F.when(F.lag(month).over(by_month).isNull(), first)
    after = F.coalesce(F.date_sub(F.lead(month).over(by_month), 1), last)
    none = F.lit(0).alias("present")

    def span(start: Column, stop: Column, present: Column) -> Column:
        return F.struct(start.alias("start"), F.least(stop, last).alias("stop"), present)

    spans = months.select(
        "coin_id",
        F.array(
            span(before, F.date_sub(month, 1), none),
            span(F.greatest(month, first), F.last_day(month), F.col("present")),
            span(F.date_add(F.last_day(month), 1), after, none),
        ).alias("spans"),
    ).select("coin_id", F.inline_outer("spans"))
    incomplete = F.bit_count("present") < F.dayofmonth(F.last_day("start"))
    gaps = spans.filter((F.col("start") <= F.col("stop")) & incomplete)
    known = gaps.join(dim.select("coin_id"), "coin_id", "left_semi")
    # sequence() counts down or fails on a reversed span; greatest() keeps it safe on any plan.
    days = F.explode(F.sequence("start", F.greatest("start", "stop")))
    expanded = known.select("coin_id", "present", days.alias("expected_date"))
    absent = F.getbit("present", F.dayofmonth("expected_date") - 1) == 0
    return expanded.filter(absent).select("coin_id", "expected_date")


def recent_gaps(missing: DataFrame, limit: int = 20) -> DataFrame:
    """The latest missing dates; coin id breaks ties."""
    return missing.orderBy(F.desc("expected_date"), "coin_id").limit(limit)


def pipeline_health(run_log: DataFrame) -> DataFrame:
    """Runs, last run and rows processed by stage and status."""
    health = run_log.groupBy("stage", "status").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.max("run_date").alias("last_run"),
        F.sum("rows_processed").alias("total_rows_processed"),
    )
    return health.orderBy("stage", "status")


def register_views(
    spark: SparkSession,
    dim: DataFrame,
    fact: DataFrame,
    run_log: DataFrame,
    as_of: date | str | None = None,
    months: DataFrame | None = None,
    health: DataFrame | None = None,
) -> None:
    """Tables and monitoring views under their SQL names, for ``spark.sql``.

    ``months``: kept sets of days, from which missing dates are read instead of from the prices.
    ``health``: the log's health as kept for closed periods, instead of from all its rows.
    """
    months = coin_months(fact) if months is None else months
    views = {
        "dim_coins": ensure_column(dim, "description").select(*schemas.DIM.names),
        "fact_coin_prices": fact.select(*schemas.FACT.names),
        "pipeline_run_log": run_log,
        "v_price_anomalies": price_anomalies(fact, as_of),
        "v_missing_dates": missing_from_coverage(dim, months, as_of),
        "v_pipeline_health": pipeline_health(run_log) if health is None else health,
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
