from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketframe.functions import (
    as_date,
    as_timestamp,
    epoch_ms_to_date,
    pct_change,
    stable_key,
    store_cast,
    strip_text,
    timestamp_literal,
)
from marketframe.schemas import AMOUNT_TYPE, PRICE_TYPE

FEW = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [row[0] for row in frame.select(expression(F.col("x"))).collect()]


def test_epoch_edges(spark):
    last_ms = 1706745599999
    values = [last_ms, last_ms + 1, 0, -1, None]
    assert column(spark, values, "bigint", epoch_ms_to_date) == [
        date(2024, 1, 31), date(2024, 2, 1), date(1970, 1, 1), date(1969, 12, 31), None,
    ]


@FEW
@given(st.lists(st.integers(-10**13, 10**14), min_size=1, max_size=50))
def test_epoch_is_the_utc_date(spark, values):
    expected = [
        date.fromordinal(date(1970, 1, 1).toordinal() + value // 86_400_000) for value in values
    ]
    assert column(spark, values, "bigint", epoch_ms_to_date) == expected


@FEW
@given(st.lists(st.text(max_size=12), min_size=1, max_size=50))
def test_strip_is_pythons(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    assert column(spark, values, "string", strip_text) == [v.strip() for v in values]


def test_strip_of_wide_spaces_and_missing(spark):
    assert column(spark, ["　\xa0\x1f a b \n", None, " \t"], "string", strip_text) == [
        "a b", "", "",
    ]


@pytest.mark.parametrize(
    "value, previous, expected",
    [
        ("30.78", "28.80", "6.88"),
        ("1", "0", None),
        ("1", None, None),
        ("5", "10", "-50.00"),
        ("100000000000", "0.00000001", "999999999999999999900.00"),
    ],
)
def test_pct_change(spark, value, previous, expected):
    frame = spark.createDataFrame(
        [(Decimal(value), previous and Decimal(previous))], "a decimal(20,8), b decimal(20,8)"
    )
    found = frame.select(pct_change(F.col("a"), F.col("b"))).first()[0]
    assert found == (expected and Decimal(expected))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_store_cast(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cast = lambda c: store_cast(c, PRICE_TYPE)
        assert column(spark, [4e-9, 0.000000005, None, float("nan")], "double", cast) == [
            Decimal("0E-8"), Decimal("1E-8"), None, None,
        ]
        amounts = column(spark, [2.675, -2.675], "double", lambda c: store_cast(c, AMOUNT_TYPE))
        assert amounts == [Decimal("2.68"), Decimal("-2.68")]
        for value in (1e12, float("inf")):
            with pytest.raises(Exception, match="numeric overflow in value"):
                column(spark, [value], "double", cast)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_stable_key(spark):
    import hashlib

    frame = spark.createDataFrame([("a", date(2024, 1, 2))], "coin_id string, price_date date")
    found = frame.select(stable_key("coin_id", "price_date")).first()[0]
    assert found == hashlib.md5(b"a|2024-01-02").hexdigest()


def test_clocks():
    moment = datetime(2024, 1, 1, 3, tzinfo=timezone.utc)
    assert as_timestamp(moment) == datetime(2024, 1, 1, 3)
    assert as_timestamp("2024-01-01T03:00:00+07:00") == datetime(2023, 12, 31, 20)
    assert as_date("2024-01-31") == as_date(datetime(2024, 1, 31, 5)) == date(2024, 1, 31)
    assert as_date() == datetime.now(timezone.utc).date()
    assert as_timestamp().tzinfo is None


def test_timestamp_literal_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        found = spark.range(1).select(timestamp_literal("2024-01-31 06:00:00")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == datetime(2024, 1, 31, 6)
