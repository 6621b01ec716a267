from marketframe.operators.clean import (
    clean_coins,
    clean_descriptions,
    clean_history,
    clean_snapshot,
    default_now,
    ensure_column,
    pad_history,
    require_rows,
    select_backfill,
)
from marketframe.operators.constraints import (
    ConstraintError,
    assert_no_orphans,
    assert_rules,
    assert_unique,
    dim_rules,
    duplicate_keys,
    fact_rules,
    orphan_counts,
    orphan_rows,
    split_orphans,
    run_log_rules,
    violations,
)
from marketframe.operators.latest import latest_per_key
from marketframe.operators.merge import (
    description_update_counts,
    to_fact,
    update_descriptions,
    upsert_dim,
    upsert_fact,
)
from marketframe.operators.monitor import (
    coin_months,
    date_series,
    large_moves,
    merge_coverage,
    missing_dates,
    missing_from_coverage,
    pipeline_health,
    price_anomalies,
    price_changes,
    recent_gaps,
    register_views,
)
from marketframe.operators.quality import (
    enforce_quality,
    gate_keys,
    gate_rows,
    null_filter,
    null_profile,
    quality_gate,
    quality_report,
    rejected_rows,
    range_filter,
    report_counts,
    report_dict,
    report_of,
    valid_rows,
)

__all__ = [
    "ConstraintError",
    "assert_no_orphans",
    "assert_rules",
    "assert_unique",
    "clean_coins",
    "clean_descriptions",
    "clean_history",
    "clean_snapshot",
    "coin_months",
    "date_series",
    "default_now",
    "description_update_counts",
    "dim_rules",
    "duplicate_keys",
    "enforce_quality",
    "ensure_column",
    "fact_rules",
    "gate_keys",
    "gate_rows",
    "large_moves",
    "latest_per_key",
    "merge_coverage",
    "missing_dates",
    "missing_from_coverage",
    "null_filter",
    "null_profile",
    "orphan_counts",
    "orphan_rows",
    "pad_history",
    "pipeline_health",
    "price_anomalies",
    "price_changes",
    "quality_gate",
    "quality_report",
    "range_filter",
    "recent_gaps",
    "register_views",
    "report_counts",
    "report_dict",
    "report_of",
    "require_rows",
    "run_log_rules",
    "rejected_rows",
    "select_backfill",
    "split_orphans",
    "to_fact",
    "update_descriptions",
    "upsert_dim",
    "upsert_fact",
    "valid_rows",
    "violations",
]
