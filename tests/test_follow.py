"""Loads of what is new in a growing folder."""

import json

import pytest

from marketframe import Lake
from marketframe.plans import Landing, follow, follow_history, follow_market, run_backfill
from marketframe.sources import read_runs

DAY = 86_400_000
JAN1 = 1704067200000
RUN_TS = "2024-02-01 06:00:00"
COINS = [{"id": c, "symbol": c, "name": c.upper()} for c in ("a", "b")]


def history(first, last):
    return {c: {"prices": [[JAN1 + d * DAY, d + 1.5] for d in range(first, last)]} for c in ("a", "b")}


@pytest.fixture
def place(tmp_path):
    (tmp_path / "history").mkdir()
    (tmp_path / "market").mkdir()
    (tmp_path / "coins.json").write_text(json.dumps(COINS))
    landing = Landing(str(tmp_path / "coins.json"), str(tmp_path / "market"), str(tmp_path / "history"))
    return tmp_path, landing, Lake(str(tmp_path / "lake")), str(tmp_path / "checkpoint")


def rows(spark, lake):
    return sorted(map(tuple, lake.read_fact(spark).collect()))


def land(tmp_path, name, content, folder="history"):
    (tmp_path / folder / name).write_text(json.dumps(content))


def test_in_turn_equals_at_once(spark, place):
    tmp_path, landing, lake, checkpoint = place
    land(tmp_path, "1.json", history(0, 5))
    assert list(follow_history(spark, landing, lake, checkpoint, RUN_TS)) == [0]
    assert follow_history(spark, landing, lake, checkpoint, RUN_TS) == {}
    land(tmp_path, "2.json", history(4, 9))
    land(tmp_path, "3.json", {"a": {"prices": [[JAN1 + 20 * DAY, 7]]}})
    reports = follow_history(spark, landing, lake, checkpoint, RUN_TS, files_at_once=1)
    assert sorted(r["total_raw"] for r in reports.values()) == [1, 10]
    whole = Lake(str(tmp_path / "whole"))
    run_backfill(spark, landing, whole, as_of="2024-02-01", run_ts=RUN_TS)
    assert rows(spark, lake) == rows(spark, whole) and len(rows(spark, lake)) == 19
    log = read_runs(spark, lake.run_log).collect()
    assert len(log) == 9 and {r.status for r in log} == {"success"}


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_killed_batch_repeats_without_loss(spark, place, monkeypatch, when):
    tmp_path, landing, lake, checkpoint = place
    land(tmp_path, "1.json", history(0, 3))
    follow_history(spark, landing, lake, checkpoint, RUN_TS)
    land(tmp_path, "2.json", history(3, 6))
    load = follow.load_history

    def killed(*arguments):
        if when == "after":
            load(*arguments)
        raise RuntimeError("killed")

    monkeypatch.setattr(follow, "load_history", killed)
    with pytest.raises(Exception, match="killed"):
        follow_history(spark, landing, lake, checkpoint, RUN_TS)
    assert len(rows(spark, lake)) == (12 if when == "after" else 6)
    monkeypatch.setattr(follow, "load_history", load)
    assert list(follow_history(spark, landing, lake, checkpoint, RUN_TS)) == [1]
    assert len(rows(spark, lake)) == 12
    log = read_runs(spark, lake.run_log).collect()
    assert len(log) == 6 and {r.status for r in log} == {"success"}


def test_a_malformed_file_stops_until_it_is_mended(spark, place):
    tmp_path, landing, lake, checkpoint = place
    (tmp_path / "history" / "1.json").write_text('{"a": ')
    with pytest.raises(Exception):
        follow_history(spark, landing, lake, checkpoint, RUN_TS)
    land(tmp_path, "1.json", history(0, 2))
    follow_history(spark, landing, lake, checkpoint, RUN_TS)
    assert len(rows(spark, lake)) == 4


def test_snapshots_as_they_land(spark, place):
    tmp_path, landing, lake, checkpoint = place
    market = [{"id": c, "current_price": 2.5, "market_cap": 1, "total_volume": 1} for c in ("a", "b")]
    land(tmp_path, "1.json", market, "market")
    follow_market(spark, landing, lake, checkpoint, "2024-01-30", RUN_TS)
    land(tmp_path, "2.json", market[:1], "market")
    follow_market(spark, landing, lake, checkpoint, "2024-01-31", RUN_TS)
    found = sorted((r.coin_id, str(r.price_date)) for r in lake.read_fact(spark).collect())
    assert found == [("a", "2024-01-30"), ("a", "2024-01-31"), ("b", "2024-01-30")]
    land(tmp_path, "3.json", market, "market")
    follow_market(spark, landing, lake, checkpoint, None, RUN_TS)
    assert len(rows(spark, lake)) == 5  # of the day the file landed
