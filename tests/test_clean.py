from datetime import date, datetime

import pytest

from marketframe.operators import (
    clean_coins,
    clean_history,
    clean_snapshot,
    default_now,
    ensure_column,
    pad_history,
    require_rows,
    select_backfill,
)

RUN = "2024-01-31 06:00:00"


def test_coins(spark):
    raw = spark.createDataFrame([("a", "A", "Aa")], "id string, symbol string, name string")
    assert tuple(clean_coins(raw, RUN).first()) == ("a", "A", "Aa", datetime(2024, 1, 31, 6))


def test_snapshot_accepts_text_numbers(spark):
    raw = spark.createDataFrame(
        [("a", "1.5", "7", "x")],
        "id string, current_price string, market_cap string, total_volume string",
    )
    assert tuple(clean_snapshot(raw, "2024-01-31", RUN).first()) == (
        "a", 1.5, 7.0, None, date(2024, 1, 31), datetime(2024, 1, 31, 6),
    )


def test_history(spark):
    points = spark.createDataFrame(
        [("a", 1706745599999, 1.0), ("a", None, 2.0)],
        "coin_id string, timestamp_ms bigint, price_usd double",
    )
    rows = clean_history(points, RUN).collect()
    assert [r.price_date for r in rows] == [date(2024, 1, 31), None]
    assert pad_history(clean_history(points, RUN)).columns == [
        "coin_id", "price_date", "price_usd", "market_cap_usd", "volume_24h_usd", "processed_at",
    ]


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        [("bitcoin", date(2024, 1, 31)), ("bitcoin", date(2023, 1, 31)),
         ("bitcoin", date(2023, 2, 1)), ("other", date(2024, 1, 1)), ("solana", None)],
        "coin_id string, price_date date",
    )


def test_default_selection_is_everything(history):
    assert select_backfill(history, as_of="2024-01-31").count() == 5


def test_selection_by_days(history):
    rows = select_backfill(history, ["bitcoin"], 365, "2024-01-31").collect()
    assert {str(r.price_date) for r in rows} == {"2024-01-31", "2023-02-01"}


def test_selection_by_list_frame_and_all(spark, history):
    wanted = spark.createDataFrame([("other",), ("other",)], "coin_id string")
    for coins in (["other"], wanted):
        rows = select_backfill(history, coins, as_of="2024-01-31").collect()
        assert [r.coin_id for r in rows] == ["other"]
    assert select_backfill(history, "all", days=None).count() == 5


def test_additive_migration_can_be_repeated(spark):
    frame = spark.createDataFrame([("a",)], "coin_id string")
    once = ensure_column(frame, "description")
    assert once.first().description is None
    assert ensure_column(once, "description") is once


def test_default_fills_only_an_absent_column(spark):
    frame = spark.createDataFrame([("a", None)], "coin_id string, loaded_at timestamp_ntz")
    assert default_now(frame, "loaded_at", RUN).first().loaded_at is None
    assert default_now(frame.drop("loaded_at"), "loaded_at", RUN).first().loaded_at == datetime(
        2024, 1, 31, 6
    )


def test_empty_guard(spark):
    frame = spark.range(1)
    assert require_rows(frame, "x") is frame
    with pytest.raises(ValueError, match="no data found in x"):
        require_rows(frame.limit(0), "x")
