"""Kept sets of days, the compacted log, older generations of files, clashes with stored keys."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import Lake, operators as op, schemas
from marketframe.plans import load_dimension, load_snapshot, open_views, stored_clashes
from marketframe.plans.clashes import _PRUNED, clash_join, settings
from marketframe.sources import (
    TypeChangeError,
    append_runs,
    compact_runs,
    read_generations,
    read_health,
    read_runs,
    runlog,
)
from marketframe.sources.widen import widens

STAMP = datetime(2024, 5, 1)


def test_coverage_follows_the_loads(spark, tmp_path, prices):
    lake = Lake(str(tmp_path), keep_coverage=True)
    coins = spark.createDataFrame([(c, c, c, STAMP) for c in "abc"], schemas.CURATED_DIM)
    load_dimension(coins, lake)
    for rows in ([("a", "2024-01-30", 1.0), ("b", "2024-03-02", 1.0)],
                 [("a", "2024-01-31", 1.0), ("a", "2024-03-01", 2.0)],
                 [("a", "2024-01-30", 3.0)]):
        load_snapshot(prices(rows), lake)
    kept = {(r.coin_id, r.price_month): (r.present, r.earliest) for r in lake.read_coverage(spark).collect()}
    assert kept == {
        ("a", date(2024, 1, 1)): (3 << 29, date(2024, 1, 30)),
        ("a", date(2024, 3, 1)): (1, date(2024, 3, 1)),
        ("b", date(2024, 3, 1)): (2, date(2024, 3, 2)),
    }
    dim = lake.read_dim(spark)
    gaps = op.missing_from_coverage(dim, lake.read_coverage(spark), "2024-03-04")
    again = op.missing_dates(dim, lake.read_fact(spark), "2024-03-04")
    assert sorted(gaps.collect()) == sorted(again.collect()) and gaps.count() > 60
    open_views(spark, lake, "2024-03-04")
    files = spark.sql("select * from v_missing_dates").inputFiles()
    assert {f.split(str(tmp_path))[1].split("/")[1] for f in files} == {"coin_months", "dim_coins"}
    assert spark.sql("select * from v_missing_dates").count() == gaps.count()


def test_changes_of_a_long_coin_are_those_of_a_window(spark):
    rows = [("hot", date.fromordinal(600_000 + 2 * i), Decimal(i % 7)) for i in range(4000)]
    rows += [(f"c{i % 900}", date(2024, 1, 1 + i // 900), Decimal(i)) for i in range(1800)]
    rows += [(None, date(2024, 1, d), None if d == 2 else Decimal(d)) for d in (1, 2, 3)]
    fact = spark.createDataFrame(rows, "coin_id string, price_date date, price_usd decimal(20,8)")
    whole = op.price_anomalies(fact, "1500-01-01")
    for days in (1, 7, 1024, 4_000_000):
        assert sorted(op.price_changes(fact, days).collect(), key=str) == sorted(whole.collect(), key=str)


def test_no_window_holds_a_whole_long_coin(spark, plan):
    fact = spark.createDataFrame([], "coin_id string, price_date date, price_usd decimal(20,8)")
    windows = [line for line in plan(op.price_changes(fact)).splitlines() if "Window [" in line]
    assert sum("lag(price_usd" in line and ", block#" in line for line in windows) == 1
    assert sum("lag(last" in line for line in windows) == 1


def log_rows(spark, days):
    rows = [(datetime(2024, *d), s, "success", n, None) for d, s, n in days]
    return spark.createDataFrame(rows, schemas.RUN_LOG)


def test_compaction_keeps_rows_and_health(spark, tmp_path):
    path = str(tmp_path / "log")
    days = [((1, 5), "loading", 1), ((1, 30), "loading", None), ((2, 2), "extraction", 4), ((3, 1), "loading", 8)]
    for number, day in enumerate(days * 3):
        append_runs(log_rows(spark, [day]), path, f"run {number % 12}")
    rows = sorted(read_runs(spark, path).collect(), key=str)
    health = read_health(spark, path).collect()
    assert compact_runs(spark, path, "2024-02-02") == 6
    assert compact_runs(spark, path, "2024-02-02") == 0
    assert len([p for p in (tmp_path / "log").iterdir() if p.name.startswith("run=")]) == 6
    assert sorted(read_runs(spark, path).collect(), key=str) == rows
    assert read_health(spark, path).collect() == health == op.pipeline_health(read_runs(spark, path)).collect()
    append_runs(log_rows(spark, [((1, 7), "loading", 100)]), path, "late")
    assert compact_runs(spark, path, "2024-03-01") == 4
    found = {(r.stage, r.status): (r.total_runs, r.total_rows_processed) for r in read_health(spark, path).collect()}
    assert found[("loading", "success")] == (10, 127)
    assert len(list((tmp_path / "log_closed" / "rows").rglob("*.parquet"))) == 2  # one for each month


def test_an_interrupted_compaction_counts_nothing_twice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for number in range(3):
        append_runs(log_rows(spark, [((1, 5 + number), "loading", 1)]), path, str(number))
    rows = sorted(read_runs(spark, path).collect(), key=str)
    health = read_health(spark, path).collect()

    def fail(*arguments):
        raise RuntimeError("gone")

    for name in ("remove", "_health"):
        with monkeypatch.context() as patch:
            patch.setattr(runlog, name, fail)
            with pytest.raises(RuntimeError):
                compact_runs(spark, path, "2024-02-01")
        assert sorted(read_runs(spark, path).collect(), key=str) == rows
    assert compact_runs(spark, path, "2024-02-01") == 3
    assert read_health(spark, path).collect() == health


def test_older_generations_read_as_the_wide_types(spark, tmp_path):
    old, new = str(tmp_path / "1"), str(tmp_path / "2")
    spark.sql("select 1 as n, cast(0.5 as float) as x, date'2024-01-01' as d, 1.25 as p").write.parquet(old)
    spark.sql("select 5000000000 as n, 0.1d as x, timestamp_ntz'2024-01-02 03:00:00' as d, "
              "cast(7 as decimal(20,8)) as p, 'new' as extra").write.parquet(new)
    schema = T.StructType.fromDDL("n bigint, x double, d timestamp_ntz, p decimal(20,8), extra string")
    found = sorted(map(tuple, read_generations(spark, [old, new], schema).collect()))
    assert found == [
        (1, 0.5, datetime(2024, 1, 1), Decimal("1.25"), None),
        (5_000_000_000, 0.1, datetime(2024, 1, 2, 3), Decimal(7), "new"),
    ]


@pytest.mark.parametrize("stored, wanted", [("bigint", "int"), ("double", "float"), ("bigint", "double"),
                                            ("decimal(12,4)", "decimal(12,2)"), ("string", "int")])
def test_other_changes_are_refused(spark, tmp_path, stored, wanted):
    spark.sql(f"select cast(1 as {stored}) as n").write.parquet(str(tmp_path / "t"))
    with pytest.raises(TypeChangeError, match=f"n is .*widen"):
        read_generations(spark, [str(tmp_path / "t")], T.StructType.fromDDL(f"n {wanted}"))


def test_whole_numbers_widen_where_all_fit():
    assert widens(T.IntegerType(), T.DecimalType(12, 2)) and not widens(T.IntegerType(), T.DecimalType(11, 2))
    assert widens(T.IntegerType(), T.DoubleType()) and not widens(T.LongType(), T.DoubleType())
    assert widens(T.ShortType(), T.LongType()) and not widens(T.LongType(), T.ShortType())


def test_clashes_are_found_behind_a_bloom_filter(spark, tmp_path, prices, plan):
    stored = prices([("a", f"2024-01-{d:02d}", 1.0) for d in range(1, 29)] + [("b", "2024-01-05", 1.0)])
    batch = prices([("a", "2024-01-05", 2.0), ("b", "2024-02-01", 2.0), (None, "2024-01-05", 1.0), ("b", None, 1.0)])
    stored.write.parquet(str(tmp_path / "s"))
    batch.write.parquet(str(tmp_path / "b"))
    stored, batch = (spark.read.parquet(str(tmp_path / n)) for n in "sb")
    for spread in (True, False):
        found = [tuple(r) for r in stored_clashes(batch, stored, spread=spread).collect()]
        assert found == [("a", date(2024, 1, 5), 1)]
    with settings(spark, _PRUNED):
        text = plan(clash_join(batch, stored))
    assert "might_contain" in text and "bloom_filter_agg" in text
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_counts_survive_a_failed_task(spark, tmp_path):
    """A count that rides along with a write is right also when a task of it ran twice."""
    from marketframe.plans.build import _observed

    marker = str(tmp_path / "marker")

    @F.udf("long")
    def once(value):
        import os
        if value == 3 and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("lost")
        return value

    counted, seen = _observed(spark.range(0, 40, numPartitions=4).select(once("id").alias("id")), F.count("id").alias("n"))
    try:
        counted.write.parquet(str(tmp_path / "out"))
    except Exception:  # a local master does not repeat tasks: the whole write is repeated
        counted, seen = _observed(spark.range(0, 40, numPartitions=4).select(once("id").alias("id")), F.count("id").alias("n"))
        counted.write.mode("overwrite").parquet(str(tmp_path / "out"))
    assert seen.get == {"n": 40}
