"""What the physical plans of the queries must and must not hold."""

import pytest
from paths import TESTDATA

import __spark_entry__ as suite
from bindings.queries import QUERIES

# Results of jobs and of written tables: what is planned here is only their read.
EAGER = ("views_after_second_run", "incremental_backfill", "missing_dates_kept", "history_document",
         "history_document_coin", "description_document", "stored_key_clashes")
LAZY = [name for name in QUERIES if "_job" not in name and name not in EAGER]


@pytest.fixture
def planned(spark, plan):
    return lambda name: plan(suite.queries()[name](spark, TESTDATA))


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_of_all_rows_and_no_python(planned, name):
    text = planned(name)
    for node in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in text


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("dim_projection", 0),
        ("history_clean", 0),
        ("constraint_violations", 0),
        ("store_casts", 0),
        ("quality_gate", 1),
        ("latest_per_key", 1),
        ("duplicate_keys", 1),
        ("price_anomalies", 2),     # gate by coin and day, then window by coin
        ("dim_upsert", 2),          # one per side
    ],
)
def test_number_of_hash_shuffles(planned, name, shuffles):
    assert planned(name).count("Exchange hashpartitioning") == shuffles


def test_look_back_and_columns_reach_the_scan(planned):
    text = planned("price_anomalies")
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00" in text
    columns = "ts:timestamp_ntz,user_id:bigint,value:double,props:string"
    assert f"ReadSchema: struct<{columns}>" in text
    assert "props" not in planned("pipeline_health")


def test_top_k_does_not_sort_everything(planned):
    assert "TakeOrderedAndProject" in planned("recent_gaps_top20")


def test_missing_dates_aggregate_the_prices_once(spark):
    """The first date of the table comes from the same exchange as the months."""
    df = suite.queries()["missing_dates"](spark, TESTDATA)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_missing_dates_of_kept_sets_read_no_prices(spark):
    files = suite.queries()["missing_dates_kept"](spark, TESTDATA).inputFiles()
    assert files and not any("fact_coin_prices" in f for f in files)


def test_a_daily_batch_moves_no_stored_price(spark, tmp_path, monkeypatch):
    """The merge of a day reads that day's files only and shuffles none of them."""
    from marketframe import schemas
    from marketframe.plans import load
    from marketframe.sources import lake as lakes

    plans = []

    def merge_partitions(read, source, path, partition, touched, merge, wait):
        target = read()
        name = partition if isinstance(partition, str) else partition[-1]
        target = target.filter(target[name].isin(*touched))
        plans.append(merge(target, source)._jdf.queryExecution().executedPlan().toString())
        lakes.merge_partitions(read, source, path, partition, touched, merge, wait)

    lake = lakes.Lake(str(tmp_path))
    stamp = "timestamp_ntz'2024-01-01 00:00:00'"
    coins = spark.sql(f"select 'c' || id as coin_id, 's' as symbol, 'n' as name, {stamp} as loaded_at from range(20)")
    load.load_dimension(coins, lake)
    rows = spark.sql(
        f"select 'c' || (id % 20) as coin_id, id * 1.5d as price_usd, 1d as market_cap_usd, 1d as volume_24h_usd, "
        f"date_add(date'2024-01-01', cast(id / 20 as int)) as price_date, {stamp} as processed_at from range(20, 400)"
    ).select(*schemas.CURATED_SNAPSHOT.names)
    load.load_snapshot(rows, lake, unique=True)
    monkeypatch.setattr(load, "merge_partitions", merge_partitions)
    load.load_snapshot(rows.filter("price_date = '2024-01-05'"), lake, unique=True)
    scan = next(line for line in plans[-1].splitlines() if "FileScan" in line and "price_day" in line)
    assert "price_day" in scan.split("PartitionFilters")[1]
    target = plans[-1][: plans[-1].index("FileScan")]
    assert "Exchange hashpartitioning" not in target and "BroadcastHashJoin" in target
    assert lake.read_fact(spark).count() == 380
