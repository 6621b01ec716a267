"""Whole queries over tables where one coin and day holds half of all rows and rows repeat."""

import duckdb
import pytest
from compare import differences, open_tables
from paths import TESTDATA

import __spark_entry__ as suite

QUERIES = (
    "quality_gate",
    "quality_report",
    "latest_per_key",
    "duplicate_keys",
    "price_anomalies",
    "missing_dates",
    "fk_orphan_counts",
    "fact_upsert",
    "pipeline_health",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    events = f"'{TESTDATA}/events.parquet'"
    with duckdb.connect() as connection:
        connection.execute(f"""
            copy (select * from {events}
                  union all select * from {events} where event_id % 5 = 3
                  union all
                  select event_id + 1000000, timestamp '2024-01-10' + interval (event_id % 500) second,
                         1, event_type, value, props from {events}, range(2))
            to '{folder}/events.parquet' (format parquet)""")
        for name in ("customer", "documents"):
            connection.execute(
                f"copy (from '{TESTDATA}/{name}.parquet') to '{folder}/{name}.parquet'"
            )
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables(spark, skewed, name):
    tables = open_tables(skewed, ("events", "customer", "documents"))
    result = suite.queries()[name](spark, skewed)
    assert differences(result, tables, suite.oracle_sql()[name]) == []
