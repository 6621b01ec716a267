from marketframe.plans.build import build_dimension, build_history, build_snapshot
from marketframe.plans.clashes import stored_clashes
from marketframe.plans.follow import follow_history, follow_market
from marketframe.plans.jobs import (
    Landing,
    RunResult,
    enrich_descriptions,
    open_views,
    run_all,
    run_backfill,
    run_daily,
)
from marketframe.plans.load import load_descriptions, load_dimension, load_history, load_snapshot

__all__ = [
    "Landing",
    "RunResult",
    "build_dimension",
    "build_history",
    "build_snapshot",
    "enrich_descriptions",
    "follow_history",
    "follow_market",
    "load_descriptions",
    "load_dimension",
    "load_history",
    "load_snapshot",
    "open_views",
    "run_all",
    "run_backfill",
    "run_daily",
    "stored_clashes",
]
