import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from marketframe import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def prices(spark):
    """Rows of (coin, day, price[, cap, volume, stamp]) in the fact's shape, prices as doubles."""
    from datetime import date, datetime

    def build(rows):
        full = [
            (coin, day and date.fromisoformat(day), price, *rest, *default[len(rest):])
            for coin, day, price, *rest in rows
            for default in [[None, None, datetime(2024, 1, 1)]]
        ]
        return spark.createDataFrame(
            full,
            "coin_id string, price_date date, price_usd double, market_cap_usd double, "
            "volume_24h_usd double, processed_at timestamp_ntz",
        )

    return build


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
