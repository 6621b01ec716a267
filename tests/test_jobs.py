import json
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest

from marketframe import Lake, schemas
from marketframe.operators import ConstraintError
from marketframe.plans import (
    Landing,
    build_dimension,
    build_history,
    build_snapshot,
    enrich_descriptions,
    load_dimension,
    load_history,
    load_snapshot,
    open_views,
    run_all,
    run_backfill,
    run_daily,
)
from marketframe.sources import (
    read_coin_list,
    read_curated,
    read_history,
    read_market,
    read_runs,
    read_valid,
)

JAN30, JAN31 = 1706572800000, 1706659200000
COINS = [{"id": "bitcoin", "symbol": "btc", "name": "Bitcoin"},
         {"id": "solana", "symbol": "sol", "name": "Solana"}]
MARKET = [{"id": "bitcoin", "current_price": 1.5, "market_cap": 10, "total_volume": 5},
          {"id": "solana", "current_price": 0, "market_cap": 1, "total_volume": 1}]
HISTORY = {"bitcoin": {"prices": [[JAN30, 1], [JAN31, 2], [JAN31 + 5, 2.5]]},
           "solana": {"prices": [[JAN30, 7.25]]}, "ethereum": {}}
RUN = {"as_of": "2024-01-31", "run_ts": "2024-01-31 06:00:00"}


@pytest.fixture
def landing(tmp_path):
    def land(coins=COINS, market=MARKET, history=HISTORY, descriptions=None):
        paths = {}
        for name, content in (("coins", coins), ("market", market), ("history", history),
                              ("descriptions", descriptions or {})):
            path = tmp_path / f"{name}.json"
            path.write_text(json.dumps(content, indent=2))
            paths[name] = str(path)
        return Landing(**paths)

    return land


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def state(spark, lake):
    return sorted(
        (r.coin_id, str(r.price_date), r.price_usd, r.market_cap_usd)
        for r in lake.read_fact(spark).collect()
    )


def stages(spark, lake):
    return sorted(
        (r.stage, r.status, r.rows_processed) for r in read_runs(spark, lake.run_log).collect()
    )


def test_daily_then_backfill_then_again(spark, landing, lake):
    files = landing()
    daily = run_daily(spark, files, lake, **RUN)
    assert daily.quality_report["total_valid"] == 1
    assert state(spark, lake) == [("bitcoin", "2024-01-31", Decimal("1.5"), Decimal("10"))]
    assert stages(spark, lake) == [
        ("extraction", "success", None), ("loading", "success", None),
        ("transformation", "success", 1),
    ]
    after = [
        ("bitcoin", "2024-01-30", Decimal("1"), None),
        ("bitcoin", "2024-01-31", Decimal("2.5"), None),
        ("solana", "2024-01-30", Decimal("7.25"), None),
    ]
    for _ in range(2):
        run_backfill(spark, files, lake, **RUN)
        assert state(spark, lake) == after
    assert lake.read_dim(spark).count() == 2
    open_views(spark, lake, "2024-02-01")
    assert spark.sql("select * from v_missing_dates").count() == 3
    assert spark.sql("select max(total_runs) from v_pipeline_health").first()[0] == 3


def test_backfill_keeping_cap_and_volume(spark, landing, lake):
    files = landing()
    run_all(spark, files, lake, coin_ids=["bitcoin"], null_policy="keep", **RUN)
    assert ("bitcoin", "2024-01-31", Decimal("2.5"), Decimal("10")) in state(spark, lake)
    assert len(state(spark, lake)) == 2


def test_orphan_fails_the_load_and_is_logged(spark, landing, lake):
    files = landing(coins=COINS[:1])
    with pytest.raises(ConstraintError, match="solana"):
        run_backfill(spark, files, lake, **RUN)
    assert state(spark, lake) == []
    assert ("loading", "failed", None) in stages(spark, lake)
    failed = read_runs(spark, lake.run_log).filter("status = 'failed'").first()
    assert "solana" in failed.error_message


def test_duplicate_coin_fails_the_load(spark, landing, lake):
    with pytest.raises(Exception, match="duplicate coin_id"):
        run_daily(spark, landing(coins=COINS + COINS[:1]), lake, **RUN)
    assert ("loading", "failed", None) in stages(spark, lake)
    assert lake.read_dim(spark).collect() == []


@pytest.mark.parametrize("empty", [{"coins": []}, {"market": []}, {"market": MARKET[1:]}])
def test_nothing_to_load_stops_a_daily_run(spark, landing, lake, empty):
    with pytest.raises(ValueError, match="no data found"):
        run_daily(spark, landing(**empty), lake, **RUN)
    assert stages(spark, lake) == [
        ("extraction", "success", None), ("transformation", "failed", None),
    ]


def test_history_stops_only_when_nothing_was_flattened(spark, landing, lake):
    with pytest.raises(ValueError, match="no data found"):
        run_backfill(spark, landing(history={"bitcoin": {}}), lake, **RUN)
    bad = {"bitcoin": {"prices": [[JAN31, -1]]}}
    result = run_backfill(spark, landing(history=bad), lake, **RUN)
    assert result.quality_report["total_valid"] == 0
    assert state(spark, lake) == []


def test_low_score_warns_or_raises(spark, landing, lake):
    files = landing()
    assert run_daily(spark, files, lake, **RUN).quality_report["passed"] is False
    with pytest.raises(ValueError, match="below the mark"):
        run_daily(spark, files, lake, on_fail="raise", **RUN)


def test_missing_landing_is_an_extraction_failure(spark, landing, lake, tmp_path):
    files = Landing(coins=str(tmp_path / "no.json"), market=landing().market)
    with pytest.raises(Exception):
        run_daily(spark, files, lake, **RUN)
    assert stages(spark, lake) == [("extraction", "failed", None)]


def test_descriptions_survive_dimension_loads(spark, landing, lake):
    files = landing(descriptions={"bitcoin": " First \n", "solana": " ", "unknown": "x"})
    run_daily(spark, files, lake, **RUN)
    assert enrich_descriptions(spark, files, lake) == {"attempted": 2, "matched": 1}
    run_daily(spark, files, lake, **RUN)
    found = {r.coin_id: r.description for r in lake.read_dim(spark).collect()}
    assert found == {"bitcoin": "First", "solana": None}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_stages_one_by_one(spark, landing, lake, tmp_path, fmt):
    files, ts = landing(), "2024-01-31 06:00:00"
    out = lambda name: str(tmp_path / "curated" / name)
    dim = build_dimension(spark, read_coin_list(spark, files.coins), out("dim"), ts, fmt)
    snapshot = build_snapshot(
        spark, read_market(spark, files.market), out("snap"), "2024-01-31", ts, fmt
    )
    history = build_history(spark, read_history(spark, files.history), out("hist"), ts, fmt=fmt)
    assert history["quality_report"]["rows_dropped_dup"] == 1
    load_dimension(read_curated(spark, dim, schemas.CURATED_DIM, fmt), lake)
    load_snapshot(read_valid(spark, snapshot["output_dir"], schemas.CURATED_SNAPSHOT, fmt), lake)
    load_history(read_valid(spark, history["output_dir"], schemas.CURATED_HISTORY, fmt), lake)
    assert len(state(spark, lake)) == 3


def test_gate_and_report_take_two_actions(spark, landing, tmp_path):
    raw = read_market(spark, landing().market)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gate", "gate")
    build_snapshot(spark, raw, str(tmp_path / "out"), "2024-01-31")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Adaptive execution starts one job per shuffle: two for the write, two for the report.
    assert len(tracker.getJobIdsForGroup("gate")) <= 4


def test_reads_prune_months(spark, landing, lake, plan):
    from marketframe.operators import price_anomalies

    run_backfill(spark, landing(), lake, **RUN)
    text = plan(price_anomalies(lake.read_fact(spark), "2024-03-15"))
    assert "PartitionFilters: [isnotnull(price_month" in text
    assert "GreaterThanOrEqual(price_date,2024-02-14)" in text
    assert "market_cap_usd" not in text


def test_failed_merge_leaves_the_table_as_it_was(spark, landing, lake):
    run_backfill(spark, landing(), lake, **RUN)
    before = state(spark, lake)
    huge = [{"id": "bitcoin", "current_price": 1e12, "market_cap": 1, "total_volume": 1}]
    with pytest.raises(Exception, match="numeric overflow in price_usd"):
        run_daily(spark, landing(market=huge), lake, **RUN)
    assert state(spark, lake) == before
    assert ("loading", "failed", None) in stages(spark, lake)


def test_same_run_id_can_be_repeated(spark, landing, lake):
    files = landing()
    for _ in range(2):
        result = run_daily(spark, files, lake, run_id="r1", **RUN)
    assert result.run_id == "r1"
    assert len(state(spark, lake)) == 1


def test_backfill_takes_all_that_landed(spark, landing, lake):
    old = {"doge": {"prices": [[JAN31 - 400 * 86_400_000, 3]]}}
    coins = [*COINS, {"id": "doge", "symbol": "d", "name": "Doge"}]
    files = landing(coins=coins, history={**HISTORY, **old})
    report = run_backfill(spark, files, lake, **RUN).quality_report
    assert (report["total_raw"], report["total_unselected"]) == (5, 0)
    assert ("doge", "2022-12-27", Decimal("3"), None) in state(spark, lake)


def test_a_selection_counts_what_it_leaves_out(spark, landing, lake):
    report = run_backfill(spark, landing(), lake, coin_ids=["solana"], **RUN).quality_report
    assert (report["total_raw"], report["total_unselected"]) == (1, 3)


def test_two_jobs_at_once_both_count(spark, landing, tmp_path):
    files = landing(market=[{**MARKET[0], "current_price": 9}])
    for trial in range(3):
        lake = Lake(str(tmp_path / f"lake{trial}"))
        run_daily(spark, files, lake, "2024-01-29", "2024-01-29 06:00:00")
        with ThreadPoolExecutor(2) as pool:
            jobs = [pool.submit(run_daily, spark, files, lake, "2024-01-28", "2024-01-28 06:00:00"),
                    pool.submit(run_backfill, spark, files, lake, **RUN)]
            for job in jobs:
                job.result()
        days = [(coin, day) for coin, day, _, _ in state(spark, lake)]
        assert days == [("bitcoin", "2024-01-28"), ("bitcoin", "2024-01-29"),
                        ("bitcoin", "2024-01-30"), ("bitcoin", "2024-01-31"),
                        ("solana", "2024-01-30")]


def test_views_follow_the_jobs(spark, landing, lake):
    open_views(spark, lake, "2024-01-31")
    assert spark.sql("select * from v_pipeline_health").collect() == []
    run_daily(spark, landing(), lake, **RUN)
    assert spark.sql("select count(*) from fact_coin_prices").first()[0] == 1
    run_backfill(spark, landing(), lake, **RUN)
    assert spark.sql("select count(*) from fact_coin_prices").first()[0] == 3
    assert spark.sql("select sum(total_runs) from v_pipeline_health").first()[0] == 6


def test_orphans_can_be_set_aside(spark, landing, lake):
    files = landing(coins=COINS[:1])
    run_backfill(spark, files, lake, orphans="quarantine", run_id="q", **RUN)
    assert {coin for coin, *_ in state(spark, lake)} == {"bitcoin"}
    aside = spark.read.parquet(lake.curated("backfill", "q", "orphans")).collect()
    assert [(r.coin_id, r.reject_reason) for r in aside] == [("solana", "coin_id not in parent")]
    with pytest.raises(ValueError, match="orphans"):
        run_backfill(spark, files, lake, orphans="drop", **RUN)


def test_malformed_documents_are_counted(spark, landing, lake, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text(json.dumps(HISTORY) + "\n{broken\n")
    coins = tmp_path / "coin_lines.json"
    coins.write_text("\n".join(map(json.dumps, COINS)))
    files = Landing(coins=str(coins), history=str(path), multi_line=False, mode="PERMISSIVE")
    report = run_backfill(spark, files, lake, run_id="m", **RUN).quality_report
    assert report["malformed_documents"] == 1
    kept = spark.read.parquet(lake.curated("backfill", "m", "malformed")).collect()
    assert [r.value for r in kept] == ["{broken"]


def test_a_small_batch_leaves_the_table_unshuffled(spark, landing, lake, plan):
    from marketframe.operators import upsert_fact

    run_backfill(spark, landing(), lake, **RUN)
    table = lake.read_fact(spark)
    text = plan(upsert_fact(table, table.filter("price_date = date '2024-01-30'")))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
