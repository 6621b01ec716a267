"""One query per operator, each over whole tables.

Decimals leave as doubles (or text where every digit counts), so that two engines can be compared.
"""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import fixtures as fx
from bindings.fixtures import AS_OF, RUN_TS
from marketframe import Lake, scratch_dir
from marketframe import operators as op
from marketframe.functions import epoch_ms_to_date, stable_key, store_cast
from marketframe.plans import (
    Landing,
    enrich_descriptions,
    follow_history,
    load_dimension,
    load_snapshot,
    open_views,
    run_backfill,
    run_daily,
    stored_clashes,
)
from marketframe.schemas import (
    AMOUNT_TYPE,
    CURATED_DIM,
    CURATED_SNAPSHOT,
    FACT_KEYS,
    HISTORY,
    PRICE_TYPE,
)
from marketframe.sources import (
    append_runs,
    compact_runs,
    flatten_descriptions,
    flatten_history,
    malformed_documents,
    read_coin_details,
    read_curated,
    read_description_document,
    read_generations,
    read_health,
    read_history_document,
    read_market,
    read_runs,
    write_curated,
)

MISSING_AS_OF = "2024-02-01"
LATER = "2024-02-10"


def _comparable(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema.fields
        ]
    )


def dim_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_coins(fx.coins(spark, sf_dir), RUN_TS)


def snapshot_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap = F.col("market_cap")
    as_text = F.when(cap > 100_000, "n/a").otherwise(cap.cast("string"))
    raw = fx.market(spark, sf_dir).withColumn("market_cap", as_text)
    return op.clean_snapshot(raw, AS_OF, RUN_TS)


def history_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_history(fx.history_documents(spark, sf_dir))


def history_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_history(flatten_history(fx.history_documents(spark, sf_dir)), RUN_TS)


def history_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.pad_history(fx.px(spark, sf_dir)))


def description_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_descriptions(fx.description_documents(spark, sf_dir))


def description_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coin detail objects, landed as JSON lines and read back."""
    path, texts = f"{scratch_dir(spark, 'details')}/landed", fx.descriptions(spark, sf_dir)
    languages = F.struct(F.lit("x").alias("de"), F.col("description").alias("en"))
    details = texts.select(F.col("coin_id").alias("id"), languages.alias("description"))
    details.write.json(path)
    return read_coin_details(spark, path, multi_line=False)


def epoch_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    return events.select("event_id", epoch_ms_to_date(fx.epoch_ms(F.col("ts"))).alias("price_date"))


def null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.null_filter(fx.px_raw(spark, sf_dir)))


def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.range_filter(fx.px_raw(spark, sf_dir)))


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.null_profile(fx.px_raw(spark, sf_dir))


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = op.quality_gate(fx.px_raw(spark, sf_dir), order=["processed_at"])
    return _comparable(valid)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.px_raw(spark, sf_dir)
    _, report = op.quality_gate(raw, order=["processed_at"])
    by_column = [F.col("null_counts")[name].alias(f"null_{name}") for name in raw.columns]
    return report.select("*", *by_column).drop("run_time", "null_counts")


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.latest_per_key(fx.px_raw(spark, sf_dir), FACT_KEYS, ["processed_at"]))


def price_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.price_anomalies(fx.px(spark, sf_dir), AS_OF))


def large_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.large_moves(op.price_anomalies(fx.px(spark, sf_dir), AS_OF)))


def date_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.date_series(fx.px(spark, sf_dir), MISSING_AS_OF)


def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.missing_dates(fx.dim(spark, sf_dir), fx.px(spark, sf_dir), MISSING_AS_OF)


def recent_gaps_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.recent_gaps(missing_dates(spark, sf_dir))


def pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.pipeline_health(fx.run_log(spark, sf_dir))


def _views(spark: SparkSession, sf_dir: str) -> None:
    dim, px, log = fx.dim(spark, sf_dir), fx.px(spark, sf_dir), fx.run_log(spark, sf_dir)
    op.register_views(spark, dim.withColumn("loaded_at", F.lit(None)), px, log, AS_OF)


def view_large_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir)
    sql = "SELECT * FROM v_price_anomalies WHERE ABS(pct_change) > 20 ORDER BY price_date DESC"
    return _comparable(spark.sql(sql))


def view_missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir)
    return spark.sql("SELECT * FROM v_missing_dates")


def view_pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir)
    return spark.sql("SELECT * FROM v_pipeline_health")


def _fact_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prices up to 19 January as the table; from 16 January, changed and without cap, as batch."""
    px, day = fx.px(spark, sf_dir), F.col("price_date")
    batch = px.filter(day >= "2024-01-16").select(
        *FACT_KEYS,
        (F.col("price_usd") + 1).cast("double").alias("price_usd"),
        F.lit(None).cast("double").alias("market_cap_usd"),
        F.col("volume_24h_usd").cast("double").alias("volume_24h_usd"),
        "processed_at",
    )
    return px.filter(day < "2024-01-20"), op.to_fact(batch, unique=True)


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.upsert_fact(*_fact_batches(spark, sf_dir)))


def fact_upsert_keep_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.upsert_fact(*_fact_batches(spark, sf_dir), null_policy="keep"))


def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, symbol = fx.dim(spark, sf_dir), F.col("symbol")
    target = dim.filter(symbol != "MACHINERY")
    named = dim.withColumn("name", F.upper("name"))
    batch = named.filter(symbol != "BUILDING").select("coin_id", "symbol", "name")
    return op.upsert_dim(target, batch)


def description_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = op.clean_descriptions(fx.descriptions(spark, sf_dir))
    return op.update_descriptions(fx.dim(spark, sf_dir), texts)


def description_update_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = op.clean_descriptions(fx.descriptions(spark, sf_dir))
    return op.description_update_counts(fx.dim(spark, sf_dir), texts)


def _partial_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.dim(spark, sf_dir).filter(F.col("symbol") != "BUILDING")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.orphan_rows(fx.px(spark, sf_dir), _partial_dim(spark, sf_dir)))


def fk_orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.orphan_counts(fx.px(spark, sf_dir), _partial_dim(spark, sf_dir))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.duplicate_keys(fx.px_raw(spark, sf_dir), FACT_KEYS)


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.violations(fx.dirty_log(spark, sf_dir), op.run_log_rules())


def store_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        store_cast(value, PRICE_TYPE).cast("string").alias("price"),
        store_cast(value, AMOUNT_TYPE).cast("string").alias("amount"),
    )


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.px(spark, sf_dir).select(*FACT_KEYS, stable_key(*FACT_KEYS).alias("id"))


def column_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are absent get their default; the NULLs already in ``description`` stay."""
    stamped = op.default_now(fx.dim(spark, sf_dir), "loaded_at", RUN_TS)
    return op.ensure_column(op.default_now(stamped, "description", RUN_TS), "note")


def backfill_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = fx.dim(spark, sf_dir).filter(F.col("symbol") == "BUILDING")
    return _comparable(op.select_backfill(fx.px(spark, sf_dir), wanted, days=14, as_of=AS_OF))


def _landing(spark: SparkSession, sf_dir: str, root: str, history: bool) -> Landing:
    landing = Landing(
        coins=f"{root}/coins",
        market=f"{root}/market",
        history=f"{root}/history",
        multi_line=False,
    )
    fx.coins(spark, sf_dir).write.json(landing.coins)
    fx.market(spark, sf_dir).write.json(landing.market)
    if history:
        fx.history_documents(spark, sf_dir).write.text(landing.history)
    return landing


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the price table after one daily run on an empty lake."""
    root = f"{scratch_dir(spark, 'daily')}/run"
    landing, lake = _landing(spark, sf_dir, f"{root}/landing", False), Lake(f"{root}/lake")
    run_daily(spark, landing, lake, AS_OF, RUN_TS)
    return _comparable(lake.read_fact(spark))


def backfill_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the price table after a daily run of 15 January and then a backfill over it."""
    root = f"{scratch_dir(spark, 'backfill')}/run"
    landing, lake = _landing(spark, sf_dir, f"{root}/landing", True), Lake(f"{root}/lake")
    run_daily(spark, landing, lake, "2024-01-15", "2024-01-15 06:00:00")
    run_backfill(spark, landing, lake, coin_ids="all", as_of=AS_OF, run_ts=RUN_TS)
    return _comparable(lake.read_fact(spark))


def curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = fx.dim(spark, sf_dir)
    return read_curated(spark, write_curated(dim, scratch_dir(spark, "curated")), dim.schema)


def curated_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks, quotes, padding, empty and NULL texts through CSV."""
    text, number = F.col("description"), F.length("description") % 7
    texts = fx.descriptions(spark, sf_dir).withColumn(
        "description",
        F.when(number == 0, None).when(number == 1, "").otherwise(F.concat(F.lit('"\\'), text)),
    )
    path = write_curated(texts, scratch_dir(spark, "csv"), "csv")
    return read_curated(spark, path, texts.schema, "csv")


def run_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as read back after two appends from two runs."""
    log, path = fx.run_log(spark, sf_dir), f"{scratch_dir(spark, 'runlog')}/log"
    append_runs(log.filter(F.col("status") == "success"), path, "one")
    append_runs(log.filter(F.col("status") == "failed"), path, "two")
    return read_runs(spark, path)


def price_anomalies_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later day, so that the look-back leaves rows out."""
    return _comparable(op.price_anomalies(fx.px(spark, sf_dir), LATER))


def market_text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed snapshot with numbers as text, some unusable, through its reader."""
    path, text = f"{scratch_dir(spark, 'market')}/landed", F.col("market_cap").cast("string")
    usable = F.col("market_cap") <= 100_000
    raw = fx.market(spark, sf_dir).withColumn("market_cap", F.when(usable, text).otherwise("n/a"))
    raw.write.json(path)
    return op.clean_snapshot(read_market(spark, path, multi_line=False), AS_OF, RUN_TS)


def history_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh document cut short: rows of the others, and how many were set aside.

    The sum is exact at any size: a bigint, as in the SQL, as long as one holds it (some 5 million
    points of these years), and a decimal beyond.
    """
    event, value = F.col("event_id"), F.col("value")
    whole = fx.history_documents(spark, sf_dir, "event_id")
    cut = F.when(event % 7 == 0, F.substring(value, 1, 12)).otherwise(value)
    documents = whole.select(cut.alias("value"))
    rows = flatten_history(documents, mode="PERMISSIVE").groupBy().agg(
        F.count(F.lit(1)).alias("points"), F.sum(F.col("timestamp_ms").cast("decimal(20,0)")).alias("sum_ms")
    )
    aside = malformed_documents(documents, HISTORY).groupBy().agg(F.count(F.lit(1)).alias("malformed"))
    found, path = rows.withColumn("malformed", aside.scalar()), f"{scratch_dir(spark, 'malformed')}/sums"
    found.write.parquet(path)
    sums, held = spark.read.schema(found.schema).parquet(path), F.col("sum_ms").try_cast("bigint")
    beyond = sums.filter(F.col("sum_ms").isNotNull() & held.isNull())
    return sums.withColumn("sum_ms", held) if beyond.isEmpty() else sums


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.rejected_rows(fx.px_raw(spark, sf_dir), order=["processed_at"]))


def orphan_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is loaded and what is set aside, told apart by the reason."""
    known, orphans = op.split_orphans(fx.px(spark, sf_dir), _partial_dim(spark, sf_dir))
    return _comparable(known.withColumn("reject_reason", F.lit("")).unionByName(orphans))


def _dirty_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.length("name") % 5
    return fx.dim(spark, sf_dir).select(
        F.when(F.col("symbol") == "BUILDING", None).otherwise(F.col("coin_id")).alias("coin_id"),
        F.when(F.col("symbol") == "MACHINERY", F.repeat("symbol", 12)).otherwise(F.col("symbol")).alias("symbol"),
        F.when(F.col("symbol") == "FURNITURE", None).otherwise(F.repeat("name", 20 * key)).alias("name"),
        F.lit(RUN_TS).cast("timestamp_ntz").alias("loaded_at"),
    )


def dim_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.violations(_dirty_dim(spark, sf_dir), op.dim_rules()).drop("loaded_at")


def fact_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.violations(fx.px_raw(spark, sf_dir), op.fact_rules()))


def _daily_lake(spark: SparkSession, sf_dir: str, purpose: str) -> tuple[str, Landing, Lake]:
    root = f"{scratch_dir(spark, purpose)}/run"
    landing, lake = _landing(spark, sf_dir, f"{root}/landing", True), Lake(f"{root}/lake")
    run_daily(spark, landing, lake, AS_OF, RUN_TS)
    return root, landing, lake


def daily_job_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension that a daily run leaves."""
    return _daily_lake(spark, sf_dir, "dimension")[2].read_dim(spark).drop("coin_bucket")


def backfill_job_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill without a selection, two years after the data: all that landed is stored."""
    root = f"{scratch_dir(spark, 'defaults')}/run"
    landing, lake = _landing(spark, sf_dir, f"{root}/landing", True), Lake(f"{root}/lake")
    run_backfill(spark, landing, lake, as_of="2026-01-31", run_ts=RUN_TS)
    return _comparable(lake.read_fact(spark)).drop("price_month")


def enrich_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after a daily run and landed descriptions."""
    root, landing, lake = _daily_lake(spark, sf_dir, "enrich")
    fx.description_documents(spark, sf_dir).write.text(f"{root}/landing/descriptions")
    enrich_descriptions(spark, replace(landing, descriptions=f"{root}/landing/descriptions"), lake)
    return lake.read_dim(spark).select("coin_id", "description")


def job_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a daily run writes into the log, without its clock."""
    return read_runs(spark, _daily_lake(spark, sf_dir, "log")[2].run_log).drop("run_date")


def views_after_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views opened before a backfill, asked after it."""
    _, landing, lake = _daily_lake(spark, sf_dir, "views")
    open_views(spark, lake, AS_OF)
    run_backfill(spark, landing, lake, as_of=AS_OF, run_ts=RUN_TS)
    prices = spark.table("fact_coin_prices").groupBy().agg(F.count(F.lit(1)).alias("prices"))
    runs = spark.table("v_pipeline_health").groupBy().agg(F.sum("total_runs").alias("runs"))
    return prices.withColumn("runs", runs.scalar())


def history_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All history as one file of many lines, read in byte ranges."""
    path = fx.write_one_document(
        fx.history_documents(spark, sf_dir), f"{scratch_dir(spark, 'document')}/landed"
    )
    return read_history_document(spark, path, range_bytes=1 << 18)


def history_document_coin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some coins of that file; their names reach the reader."""
    return history_document(spark, sf_dir).filter(F.col("coin_id").isin("coin_1", "coin_22", "none"))


def description_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_one_document(
        fx.description_documents(spark, sf_dir), f"{scratch_dir(spark, 'texts')}/landed"
    )
    return read_description_document(spark, path, range_bytes=1 << 18)


def missing_dates_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing dates from the sets of days that two loads have kept."""
    root, run_ts = f"{scratch_dir(spark, 'coverage')}/run", F.lit(RUN_TS).cast("timestamp_ntz")
    lake, px = Lake(f"{root}/lake", keep_coverage=True), f"{root}/px"
    dim = fx.dim(spark, sf_dir).select("coin_id", "symbol", "name", run_ts.alias("loaded_at"))
    load_dimension(read_curated(spark, write_curated(dim, f"{root}/dim"), CURATED_DIM), lake)
    doubles = ["price_usd", "market_cap_usd", "volume_24h_usd"]
    rows = fx.px(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in doubles})
    stored = read_curated(spark, write_curated(rows, px), CURATED_SNAPSHOT)
    load_snapshot(stored.filter("price_date >= '2024-01-12'"), lake, unique=True)
    load_snapshot(stored.filter("price_date < '2024-01-20'"), lake, unique=True)
    return op.missing_from_coverage(lake.read_dim(spark), lake.read_coverage(spark), MISSING_AS_OF)


def incremental_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings taken in turn, and a call between them and after them that finds nothing new."""
    root = f"{scratch_dir(spark, 'follow')}/run"
    landing, lake = Landing(f"{root}/coins", history=f"{root}/history", multi_line=False), Lake(f"{root}/lake")
    fx.coins(spark, sf_dir).write.json(landing.coins)
    documents = fx.history_documents(spark, sf_dir, "ts")
    for part in ("ts < '2024-01-16'", "ts >= '2024-01-16'"):
        documents.filter(part).select("value").write.mode("append").text(landing.history)
        for _ in range(2):
            follow_history(spark, landing, lake, f"{root}/checkpoint", RUN_TS)
    return _comparable(lake.read_fact(spark)).drop("price_month")


def price_changes_long_coin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(op.price_changes(fx.long_prices(spark, sf_dir)))


def price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table's changes, in blocks of a week."""
    return _comparable(op.price_changes(fx.px(spark, sf_dir), block_days=7))


def stored_key_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the second batch that the stored prices hold."""
    root, day = f"{scratch_dir(spark, 'stored')}/run", F.col("price_date")
    prices = fx.px(spark, sf_dir)
    for name, rows in (("table", day < "2024-01-20"), ("batch", day >= "2024-01-16")):
        prices.filter(rows).write.parquet(f"{root}/{name}")
    batch, stored = (spark.read.schema(prices.schema).parquet(f"{root}/{n}") for n in ("batch", "table"))
    return stored_clashes(batch, stored)


def _compacted_log(spark: SparkSession, sf_dir: str) -> str:
    log, path = fx.run_log(spark, sf_dir), f"{scratch_dir(spark, 'compact')}/log"
    for number, last in enumerate(("2024-01-08", "2024-01-15", "2024-01-22", "2024-03-01")):
        first = ("2000-01-01", "2024-01-08", "2024-01-15", "2024-01-22")[number]
        append_runs(log.filter((F.col("run_date") >= first) & (F.col("run_date") < last)), path, str(number))
        compact_runs(spark, path, "2024-01-15")
    return path


def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_runs(spark, _compacted_log(spark, sf_dir))


def compacted_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_health(spark, _compacted_log(spark, sf_dir))


def widened_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two generations: the older with narrower numbers and without the last column."""
    events, root = fx.table(spark, sf_dir, "events"), f"{scratch_dir(spark, 'generations')}/run"
    kinds = {"user_id": ("int", "bigint"), "value": ("float", "double"), "cents": ("decimal(12,2)", "decimal(20,4)")}
    cents = events.withColumn("cents", F.col("value").cast("decimal(12,2)"))
    for number, old in enumerate((F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1)):
        columns = [F.col(name).cast(pair[number]).alias(name) for name, pair in kinds.items()]
        columns += [F.col("event_type").alias("kind")] * number
        cents.filter(old).select("event_id", *columns).write.parquet(f"{root}/{number}")
    schema = f"event_id bigint, {', '.join(f'{n} {pair[1]}' for n, pair in kinds.items())}, kind string"
    wanted = T.StructType.fromDDL(schema)
    return _comparable(read_generations(spark, [f"{root}/0", f"{root}/1"], wanted))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        dim_projection,
        snapshot_projection,
        history_flatten,
        history_clean,
        history_padding,
        description_flatten,
        description_details,
        epoch_to_date,
        null_filter,
        range_filter,
        null_profile,
        quality_gate,
        quality_report,
        latest_per_key,
        price_anomalies,
        large_moves,
        date_series,
        missing_dates,
        recent_gaps_top20,
        pipeline_health,
        view_large_moves,
        view_missing_dates,
        view_pipeline_health,
        fact_upsert,
        fact_upsert_keep_nulls,
        dim_upsert,
        description_update,
        description_update_counts,
        fk_orphans,
        fk_orphan_counts,
        duplicate_keys,
        constraint_violations,
        store_casts,
        surrogate_keys,
        column_defaults,
        backfill_selection,
        daily_job,
        backfill_job,
        curated_roundtrip,
        curated_csv_roundtrip,
        run_log_append,
        price_anomalies_lookback,
        market_text_numbers,
        history_malformed,
        rejected_rows,
        orphan_quarantine,
        dim_violations,
        fact_violations,
        daily_job_dimension,
        backfill_job_defaults,
        enrich_job,
        job_run_log,
        views_after_second_run,
        history_document,
        history_document_coin,
        description_document,
        missing_dates_kept,
        incremental_backfill,
        price_changes,
        price_changes_long_coin,
        stored_key_clashes,
        compacted_log,
        compacted_health,
        widened_generations,
    )
}
