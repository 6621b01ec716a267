import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from marketframe.operators import (
    enforce_quality,
    gate_keys,
    latest_per_key,
    null_filter,
    null_profile,
    quality_gate,
    quality_report,
    range_filter,
    report_dict,
    valid_rows,
)

DAY = "2024-01-01"


def gate(df, **options):
    valid, report = quality_gate(df, **options)
    return valid.collect(), report_dict(report)


def counts(report):
    names = ("total_raw", "total_valid", "total_dropped")
    causes = ("rows_dropped_null", "rows_dropped_dup", "rows_dropped_range")
    return tuple(report[name] for name in names + causes)


def test_each_cause_is_counted_once(prices):
    raw = prices([
        ("a", DAY, 1.0), ("a", DAY, 2.0),          # duplicate
        (None, DAY, 1.0), ("b", None, 1.0), ("c", DAY, None),
        ("d", DAY, 0.0), ("e", DAY, -1.0), ("f", DAY, float("nan")),
        ("g", DAY, 4e-9),
    ])
    rows, report = gate(raw)
    assert {row.coin_id for row in rows} == {"a", "g"}
    assert counts(report) == (9, 2, 7, 3, 1, 3)
    assert report["null_counts"]["coin_id"] == 1
    assert report["null_counts"]["price_date"] == 1
    assert report["null_counts"]["price_usd"] == 1
    assert report["null_counts"]["market_cap_usd"] == 9
    assert report["quality_score_pct"] == 22.22 and report["passed"] is False


def test_bad_survivor_loses_its_key(spark):
    raw = spark.createDataFrame(
        [("a", date(2024, 1, 1), 5.0, 1), ("a", date(2024, 1, 1), -1.0, 2)],
        "coin_id string, price_date date, price_usd double, timestamp_ms bigint",
    )
    rows, report = gate(raw)
    assert rows == [] and counts(report) == (2, 0, 2, 0, 1, 1)
    assert "timestamp_ms" not in report["null_counts"]


def test_nan_survivor_loses_its_key_to_the_range_check(spark):
    raw = spark.createDataFrame(
        [("a", date(2024, 1, 1), 5.0, 1), ("a", date(2024, 1, 1), float("nan"), 2)],
        "coin_id string, price_date date, price_usd double, timestamp_ms bigint",
    )
    rows, report = gate(raw)
    assert rows == [] and counts(report) == (2, 0, 2, 0, 1, 1)


def test_latest_timestamp_wins_then_price(spark):
    raw = spark.createDataFrame(
        [("a", date(2024, 1, 1), 9.0, 1), ("a", date(2024, 1, 1), 2.0, 5),
         ("a", date(2024, 1, 1), 3.0, 5)],
        "coin_id string, price_date date, price_usd double, timestamp_ms bigint",
    )
    rows, _ = gate(raw)
    assert [row.price_usd for row in rows] == [3.0]


def test_empty_input(prices):
    rows, report = gate(prices([]))
    assert rows == [] and counts(report) == (0, 0, 0, 0, 0, 0)
    assert report["quality_score_pct"] == 0.0 and report["passed"] is False
    assert report["null_counts"]["coin_id"] == 0


@pytest.mark.parametrize(
    "valid, raw, passed", [(7999, 10000, False), (19999, 25000, True), (8000, 10000, True)]
)
def test_score_is_rounded_before_it_is_compared(spark, valid, raw, passed):
    # 79.99 %, 79.996 %, 80.00 %
    frame = spark.range(raw).select(
        F.col("id").cast("string").alias("coin_id"),
        F.lit(date(2024, 1, 1)).alias("price_date"),
        F.when(F.col("id") < valid, 1.0).alias("price_usd"),
    )
    assert report_dict(quality_gate(frame)[1])["passed"] is passed


def test_enforcement(caplog):
    bad = {"passed": False, "quality_score_pct": 1.0, "total_valid": 1, "total_raw": 100}
    assert enforce_quality(bad) is bad
    assert "below the mark" in caplog.text
    with pytest.raises(ValueError, match="below the mark"):
        enforce_quality(bad, "raise")
    with pytest.raises(ValueError, match="on_fail"):
        enforce_quality(bad, "stop")
    assert enforce_quality({"passed": True}, "raise")


def test_filters_and_profile(prices):
    raw = prices([("a", DAY, 1.0), ("b", DAY, None), (None, None, -2.0), ("c", DAY, float("nan"))])
    assert {r.coin_id for r in null_filter(raw).collect()} == {"a", "c"}
    assert {r.coin_id for r in range_filter(raw).collect()} == {"a"}
    assert null_profile(raw).first().asDict()["price_usd"] == 1


def _brute_force(rows):
    complete = [r for r in rows if None not in r[:3]]
    groups = defaultdict(list)
    for row in complete:
        groups[row[:2]].append(row)
    best = {key: max(group, key=lambda r: (r[3], r[2])) for key, group in groups.items()}
    good = sorted(r for r in best.values() if r[2] > 0)
    nulls, keys = len(rows) - len(complete), len(groups)
    return good, (len(rows), len(good), len(rows) - len(good), nulls,
                  len(complete) - keys, keys - len(good))


@pytest.mark.parametrize("partitions", [1, 7])
def test_hot_key_against_brute_force(spark, partitions):
    """One key holds a third of all rows; the result does not depend on the partitioning."""
    rng = random.Random(3)
    rows = []
    for number in range(6000):
        hot = number % 3 == 0
        coin = "hot" if hot else rng.choice(["a", "b", "c", None])
        day = date(2024, 1, 1 if hot else rng.randint(1, 28))
        price = rng.choice([None, -1.0, 0.0, 1.5, 2.5, 1e-9])
        rows.append((coin, day, price, rng.randint(1, 5000)))
    rng.shuffle(rows)
    frame = spark.createDataFrame(
        rows, "coin_id string, price_date date, price_usd double, timestamp_ms bigint"
    ).repartition(partitions)
    found, report = gate(frame)
    expected, expected_counts = _brute_force(rows)
    assert sorted(map(tuple, found)) == expected
    assert counts(report) == expected_counts
    assert counts(report)[0] == sum(counts(report)[i] for i in (1, 3, 4, 5))


def test_report_and_rows_of_one_written_gate(spark, prices, tmp_path):
    raw = prices([("a", DAY, 1.0), ("a", DAY, 2.0), ("b", DAY, 0.0)])
    gate_keys(raw).write.parquet(str(tmp_path / "gate"))
    written = spark.read.parquet(str(tmp_path / "gate"))
    assert [r.coin_id for r in valid_rows(written).collect()] == ["a"]
    assert valid_rows(written).columns == raw.columns
    assert counts(report_dict(quality_report(written))) == (3, 1, 2, 0, 1, 1)


def test_gate_pre_aggregates_and_uses_no_window(prices, plan):
    text = plan(gate_keys(prices([("a", DAY, 1.0)])))
    assert "partial_max" in text and "Window" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_latest_per_key_ties_and_nulls(spark):
    frame = spark.createDataFrame(
        [("k", 1, "x"), ("k", 2, "y"), ("k", 2, "z"), (None, 1, "n"), ("m", None, "null"),
         ("m", 9, "nine")],
        "k string, at int, v string",
    )
    found = {(r.k, r.v) for r in latest_per_key(frame, ["k"], ["at"]).collect()}
    # A descending order puts NULL first.
    assert found == {("k", "z"), (None, "n"), ("m", "null")}
    assert latest_per_key(frame, ["k"], ["at"]).columns == ["k", "at", "v"]
