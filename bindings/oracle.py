"""Independent SQL for every query, for DuckDB over the same tables."""

# White space that stripping takes off, spelled out here: what Python's str.strip() removes.
WHITESPACE = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))

_SHARED = {
    "px_raw": """
        select case when k = 7 then null
                    else concat('coin_', cast(user_id as varchar)) end as coin_id,
               cast(ts as date) as price_date,
               case when k = 9 then null
                    else cast(cast(value as decimal(20,8)) - cast(1 as decimal(20,8))
                              as decimal(20,8)) end as price_usd,
               cast(cast(value as decimal(20,8)) * 1000 as decimal(20,2)) as market_cap_usd,
               cast(cast(value as decimal(20,8)) * 10 as decimal(20,2)) as volume_24h_usd,
               ts as processed_at
        from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events) e""",
    "px": """
        select coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, processed_at
        from (select *, row_number() over (partition by coin_id, price_date
                                           order by processed_at desc, price_usd desc,
                                                    market_cap_usd desc) as rn
              from px_raw
              where coin_id is not null and price_date is not null and price_usd is not null) d
        where rn = 1 and price_usd > 0""",
    "dim": """
        select concat('coin_', cast(c_custkey as varchar)) as coin_id, c_mktsegment as symbol,
               c_name as name,
               case when c_custkey % 3 = 0 then concat('old ', c_name) end as description
        from customer""",
    "run_log": """
        select ts as run_date,
               case when event_type in ('view', 'click') then 'extraction'
                    when event_type = 'purchase' then 'transformation' else 'loading' end as stage,
               case when value > 100 then 'failed' else 'success' end as status,
               case when event_type = 'purchase' and value <= 100
                    then cast(floor(value) as bigint) end as rows_processed,
               case when value > 100 then concat('error ', cast(event_id as varchar)) end
                   as error_message
        from events""",
    "dirty_log": """
        select run_date,
               case when minute(run_date) = 0 then null when minute(run_date) = 1 then 'quality'
                    when minute(run_date) = 2 then repeat(stage, 6) else stage end as stage,
               case when minute(run_date) = 2 then 'done' when minute(run_date) = 3 then null
                    else status end as status
        from run_log""",
    "points": """
        select concat('coin_', cast(user_id as varchar)) as coin_id,
               epoch_us(ts) // 1000 as timestamp_ms, value as price_usd
        from events
        union all
        select concat('coin_', cast(user_id as varchar)), epoch_us(ts) // 1000 + 1, value * 2
        from events""",
    "texts": """
        select concat('coin_', cast(doc_id * 2 as varchar)) as coin_id,
               case when doc_id % 5 = 0 then '   '
                    else concat(chr(9), chr(160), ' ', text, ' ', chr(10)) end as description
        from documents""",
    "clean_texts": f"""
        select coin_id, max(d) as description
        from (select coin_id, trim(description, '{WHITESPACE}') as d from texts) t
        where length(d) > 0 group by coin_id""",
    "anomalies": """
        select coin_id, price_date, cast(price_usd as double) as price_usd,
               cast(previous as double) as previous_price,
               case when b <> 0
                    then sign(a - b) * ((2 * 10000 * abs(a - b) + b) // (2 * b)) / 100.0
               end as pct_change
        from (select *, cast(price_usd * 100000000 as hugeint) as a,
                     cast(previous * 100000000 as hugeint) as b
              from (select *, lag(price_usd) over (partition by coin_id order by price_date)
                                  as previous
                    from px where price_date >= date '2024-01-31' - interval 30 day) w) v""",
    "batch": """
        select coin_id, price_date, cast(price_usd + 1 as decimal(20,8)) as price_usd,
               cast(null as decimal(20,2)) as market_cap_usd, volume_24h_usd, processed_at
        from px where price_date >= date '2024-01-16'""",
    "changes": """
        select coin_id, price_date, cast(price_usd as double) as price_usd,
               cast(previous as double) as previous_price,
               case when b <> 0
                    then sign(a - b) * ((2 * 10000 * abs(a - b) + b) // (2 * b)) / 100.0
               end as pct_change
        from (select *, cast(price_usd * 100000000 as hugeint) as a,
                     cast(previous * 100000000 as hugeint) as b
              from (select coin_id, price_date, price_usd,
                           lag(price_usd) over (partition by coin_id order by price_date) as previous
                    from {prices}) w) v""",
    "long_prices": """
        select case when o_orderkey % 2 = 0 then 'hot'
                    else concat('coin_', cast(o_custkey as varchar)) end as coin_id,
               cast(date '1600-01-01' + cast(o_orderkey % 3000000 as int) as date) as price_date,
               cast(o_totalprice as decimal(20,8)) as price_usd
        from orders""",
    "target": "select * from px where price_date < date '2024-01-20'",
    "gaps": """
        select coin_id, expected_date
        from (select distinct coin_id from px where coin_id in (select coin_id from dim)) c,
             (select cast(day as date) as expected_date
              from range((select min(price_date) from px), date '{last}' + 1, interval 1 day)
                   t(day)) days
        except
        select coin_id, price_date from px""",
    "health": """
        select stage, status, count(*) as total_runs, max(run_date) as last_run,
               cast(sum(rows_processed) as bigint) as total_rows_processed
        from run_log group by stage, status""",
}

_USES = {
    "px": ["px_raw"],
    "dirty_log": ["run_log"],
    "clean_texts": ["texts"],
    "anomalies": ["px"],
    "batch": ["px"],
    "target": ["px"],
    "gaps": ["dim", "px"],
    "health": ["run_log"],
}


def _with(names: list[str], body: str, **values: str) -> str:
    """``body`` with the shared views it needs in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _USES.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    views = ", ".join(f"{name} as ({_SHARED[name].format(**values)})" for name in ordered)
    return f"with {views} {body}" if views else body


_DOUBLES = """cast(price_usd as double) as price_usd,
    cast(market_cap_usd as double) as market_cap_usd,
    cast(volume_24h_usd as double) as volume_24h_usd, processed_at"""
_PRICES = f"coin_id, price_date, {_DOUBLES}"
_RUN = "timestamp '2024-01-31 06:00:00'"
_GAP_DAY = "2024-02-01"

_DAILY = """
    select coin_id, max(price_usd) as price_usd,
           arg_max(market_cap_usd, price_usd) as market_cap_usd,
           arg_max(volume_24h_usd, price_usd) as volume_24h_usd
    from px_raw where coin_id is not null and price_usd is not null
    group by coin_id having max(price_usd) > 0"""

_NULL_COUNTS = ", ".join(
    f"count(*) filter (where {name} is null) as {{prefix}}{name}"
    for name in (
        "coin_id", "price_date", "price_usd", "market_cap_usd", "volume_24h_usd", "processed_at"
    )
)

ORACLES: dict[str, str] = {
    "dim_projection": _with(
        ["dim"], f"select coin_id, symbol, name, {_RUN} as loaded_at from dim"
    ),
    "snapshot_projection": _with(
        ["px_raw"],
        f"""select coin_id, cast(price_usd as double) as price_usd,
                   case when market_cap_usd <= 100000 then cast(market_cap_usd as double) end
                       as market_cap_usd,
                   cast(volume_24h_usd as double) as volume_24h_usd,
                   date '2024-01-31' as price_date, {_RUN} as processed_at from px_raw""",
    ),
    "history_flatten": _with(["points"], "select * from points"),
    "history_clean": _with(
        ["points"],
        f"""select coin_id, cast(make_timestamp(timestamp_ms * 1000) as date) as price_date,
                   price_usd, {_RUN} as processed_at, timestamp_ms from points""",
    ),
    "history_padding": _with(
        ["px"],
        """select coin_id, price_date, cast(price_usd as double) as price_usd,
                  cast(null as double) as market_cap_usd, cast(null as double) as volume_24h_usd,
                  processed_at from px""",
    ),
    "description_flatten": _with(["texts"], "select * from texts"),
    "description_details": _with(
        ["texts"], f"select coin_id, trim(description, '{WHITESPACE}') as description from texts"
    ),
    "epoch_to_date": "select event_id, cast(ts as date) as price_date from events",
    "null_filter": _with(
        ["px_raw"],
        f"""select {_PRICES} from px_raw
            where coin_id is not null and price_date is not null and price_usd is not null""",
    ),
    "range_filter": _with(["px_raw"], f"select {_PRICES} from px_raw where price_usd > 0"),
    "null_profile": _with(["px_raw"], f"select {_NULL_COUNTS.format(prefix='')} from px_raw"),
    "quality_gate": _with(["px"], f"select {_PRICES} from px"),
    "quality_report": _with(
        ["px"],
        f"""select total_raw, total_valid, total_raw - total_valid as total_dropped,
                   total_raw - complete as rows_dropped_null,
                   complete - keys as rows_dropped_dup, keys - total_valid as rows_dropped_range,
                   round(100.0 * total_valid / total_raw, 2) as quality_score_pct,
                   round(100.0 * total_valid / total_raw, 2) >= 80 as passed,
                   c.* exclude (total_raw, complete, keys)
            from (select count(*) as total_raw,
                         count(*) filter (where coin_id is not null and price_date is not null
                                          and price_usd is not null) as complete,
                         count(distinct (coin_id, price_date))
                             filter (where coin_id is not null and price_date is not null
                                     and price_usd is not null) as keys,
                         {_NULL_COUNTS.format(prefix='null_')}
                  from px_raw) c,
                 (select count(*) as total_valid from px) v""",
    ),
    "latest_per_key": _with(
        ["px_raw"],
        f"""select {_PRICES}
            from (select *, row_number() over (partition by coin_id, price_date
                                               order by processed_at desc nulls first,
                                                        price_usd desc nulls last,
                                                        market_cap_usd desc) as rn
                  from px_raw) r where rn = 1""",
    ),
    "price_anomalies": _with(["anomalies"], "select * from anomalies"),
    "large_moves": _with(["anomalies"], "select * from anomalies where abs(pct_change) > 20"),
    "date_series": _with(
        ["px"],
        f"""select cast(unnest(generate_series((select min(price_date) from px),
                        date '{_GAP_DAY}', interval 1 day)) as date) as expected_date""",
    ),
    "missing_dates": _with(["gaps"], "select * from gaps", last=_GAP_DAY),
    "recent_gaps_top20": _with(
        ["gaps"],
        "select * from gaps order by expected_date desc, coin_id limit 20",
        last=_GAP_DAY,
    ),
    "pipeline_health": _with(["health"], "select * from health"),
    "view_large_moves": _with(["anomalies"], "select * from anomalies where abs(pct_change) > 20"),
    "view_missing_dates": _with(["gaps"], "select * from gaps", last="2024-01-31"),
    "view_pipeline_health": _with(["health"], "select * from health"),
    "fact_upsert": _with(
        ["target", "batch"],
        f"""select {_PRICES}
            from (select t.* from target t left join batch b using (coin_id, price_date)
                  where b.coin_id is null
                  union all select * from batch) u""",
    ),
    "fact_upsert_keep_nulls": _with(
        ["target", "batch"],
        f"""select {_PRICES}
            from (select coalesce(b.coin_id, t.coin_id) as coin_id,
                         coalesce(b.price_date, t.price_date) as price_date,
                         coalesce(b.price_usd, t.price_usd) as price_usd,
                         coalesce(b.market_cap_usd, t.market_cap_usd) as market_cap_usd,
                         coalesce(b.volume_24h_usd, t.volume_24h_usd) as volume_24h_usd,
                         coalesce(b.processed_at, t.processed_at) as processed_at
                  from target t full join batch b
                  on t.coin_id = b.coin_id and t.price_date = b.price_date) u""",
    ),
    "dim_upsert": _with(
        ["dim"],
        """select coin_id, symbol,
                  case when symbol <> 'BUILDING' then upper(name) else name end as name,
                  case when symbol <> 'MACHINERY' then description end as description
           from dim""",
    ),
    "description_update": _with(
        ["dim", "clean_texts"],
        """select d.coin_id, d.symbol, d.name,
                  coalesce(t.description, d.description) as description
           from dim d left join clean_texts t on t.coin_id = d.coin_id""",
    ),
    "description_update_counts": _with(
        ["dim", "clean_texts"],
        """select count(*) as attempted, count(d.coin_id) as matched
           from clean_texts t left join dim d on t.coin_id = d.coin_id""",
    ),
    "fk_orphans": _with(
        ["px", "dim"],
        f"""select {_PRICES} from px
            where coin_id not in (select coin_id from dim where symbol <> 'BUILDING')""",
    ),
    "fk_orphan_counts": _with(
        ["px", "dim"],
        """select coin_id, count(*) as orphan_rows from px
           where coin_id not in (select coin_id from dim where symbol <> 'BUILDING')
           group by coin_id""",
    ),
    "duplicate_keys": _with(
        ["px_raw"],
        """select coin_id, price_date, count(*) as copies from px_raw
           group by coin_id, price_date having count(*) > 1""",
    ),
    "constraint_violations": _with(
        ["dirty_log"],
        """select 'stage is null' as rule, * from dirty_log where stage is null
           union all select 'status is null', * from dirty_log where status is null
           union all select 'stage is too long', * from dirty_log where length(stage) > 50
           union all select 'status is too long', * from dirty_log where length(status) > 20
           union all select 'stage is not in its domain', * from dirty_log
               where stage not in ('extraction', 'transformation', 'loading')
           union all select 'status is not in its domain', * from dirty_log
               where status not in ('running', 'success', 'failed')""",
    ),
    "store_casts": """
        select event_id, cast(cast(value as decimal(20,8)) as varchar) as price,
               cast(cast(value as decimal(20,2)) as varchar) as amount from events""",
    "surrogate_keys": _with(
        ["px"],
        """select coin_id, price_date,
                  md5(concat(coin_id, '|', cast(price_date as varchar))) as id from px""",
    ),
    "column_defaults": _with(
        ["dim"], f"select *, {_RUN} as loaded_at, cast(null as varchar) as note from dim"
    ),
    "backfill_selection": _with(
        ["px", "dim"],
        f"""select {_PRICES} from px
            where coin_id in (select coin_id from dim where symbol = 'BUILDING')
              and price_date > date '2024-01-31' - interval 14 day""",
    ),
    "daily_job": _with(
        ["px_raw"],
        f"""select coin_id, date '2024-01-31' as price_date, {_DOUBLES},
                   date '2024-01-01' as price_month
            from (select *, {_RUN} as processed_at from ({_DAILY}) d) r""",
    ),
    "backfill_job": _with(
        ["px_raw", "points"],
        f""", history as (
                select coin_id, price_date, cast(price_usd as decimal(20,8)) as price_usd,
                       cast(null as decimal(20,2)) as market_cap_usd,
                       cast(null as decimal(20,2)) as volume_24h_usd, {_RUN} as processed_at
                from (select *, row_number() over (partition by coin_id, price_date
                                                   order by timestamp_ms desc, price_usd desc) as rn
                      from (select *, cast(make_timestamp(timestamp_ms * 1000) as date)
                                          as price_date from points) p) r
                where rn = 1 and price_usd > 0),
            daily as (
                select coin_id, date '2024-01-15' as price_date, price_usd, market_cap_usd,
                       volume_24h_usd, timestamp '2024-01-15 06:00:00' as processed_at
                from ({_DAILY}) d)
            select {_PRICES}, date '2024-01-01' as price_month
            from (select * from history
                  union all
                  select * from daily d where not exists (
                      select 1 from history h
                      where h.coin_id = d.coin_id and h.price_date = d.price_date)) u""",
    ),
    "curated_roundtrip": _with(["dim"], "select * from dim"),
    "curated_csv_roundtrip": _with(
        ["texts"],
        """select coin_id,
                  case when length(description) % 7 = 0 then null
                       when length(description) % 7 = 1 then ''
                       else concat('"', chr(92), description) end as description
           from texts""",
    ),
    "run_log_append": _with(["run_log"], "select * from run_log"),
    "price_anomalies_lookback": _with(
        ["anomalies"], "select * from anomalies"
    ).replace("date '2024-01-31' - interval 30 day", "date '2024-02-10' - interval 30 day"),
    "market_text_numbers": _with(
        ["px_raw"],
        f"""select coin_id, cast(price_usd as double) as price_usd,
                   case when market_cap_usd <= 100000 then cast(market_cap_usd as double) end
                       as market_cap_usd,
                   cast(volume_24h_usd as double) as volume_24h_usd,
                   date '2024-01-31' as price_date, {_RUN} as processed_at from px_raw""",
    ),
    "history_malformed": """
        select cast(2 * count(*) filter (where event_id % 7 <> 0) as bigint) as points,
               cast(sum(case when event_id % 7 <> 0 then 2 * (epoch_us(ts) // 1000) + 1 end)
                    as bigint) as sum_ms,
               count(*) filter (where event_id % 7 = 0) as malformed
        from events""",
    "rejected_rows": _with(
        ["px_raw"],
        f"""select {_PRICES}, case when not usable then 'null' when rn > 1 then 'duplicate'
                                   else 'range' end as reject_reason
            from (select *, coin_id is not null and price_date is not null
                            and price_usd is not null as usable,
                         row_number() over (partition by coin_id, price_date,
                                                coin_id is not null and price_date is not null
                                                and price_usd is not null
                                            order by processed_at desc, price_usd desc,
                                                     market_cap_usd desc) as rn
                  from px_raw) r
            where not usable or rn > 1 or price_usd <= 0""",
    ),
    "orphan_quarantine": _with(
        ["px", "dim"],
        f"""select {_PRICES},
                   case when coin_id in (select coin_id from dim where symbol <> 'BUILDING')
                        then '' else 'coin_id not in parent' end as reject_reason from px""",
    ),
    "dim_violations": _with(
        ["dim"],
        """, dirty as (
               select case when symbol <> 'BUILDING' then coin_id end as coin_id,
                      case when symbol = 'MACHINERY' then repeat(symbol, 12) else symbol end
                          as symbol,
                      case when symbol <> 'FURNITURE'
                           then repeat(name, cast(20 * (length(name) % 5) as int)) end as name
               from dim)
           select 'coin_id is null' as rule, * from dirty where coin_id is null
           union all select 'symbol is null', * from dirty where symbol is null
           union all select 'name is null', * from dirty where name is null
           union all select 'coin_id is too long', * from dirty where length(coin_id) > 100
           union all select 'symbol is too long', * from dirty where length(symbol) > 100
           union all select 'name is too long', * from dirty where length(name) > 300""",
    ),
    "fact_violations": _with(
        ["px_raw"],
        f"""select 'coin_id is null' as rule, {_PRICES} from px_raw where coin_id is null
            union all select 'price_date is null', {_PRICES} from px_raw where price_date is null
            union all select 'coin_id is too long', {_PRICES} from px_raw
                where length(coin_id) > 100""",
    ),
    "daily_job_dimension": _with(
        ["dim"],
        f"""select coin_id, symbol, name, {_RUN} as loaded_at,
                   cast(null as varchar) as description from dim""",
    ),
    "backfill_job_defaults": _with(
        ["points"],
        f"""select {_PRICES}
            from (select coin_id, price_date, cast(price_usd as decimal(20,8)) as price_usd,
                         cast(null as decimal(20,2)) as market_cap_usd,
                         cast(null as decimal(20,2)) as volume_24h_usd, {_RUN} as processed_at
                  from (select *, row_number() over (partition by coin_id, price_date
                                                     order by timestamp_ms desc,
                                                              price_usd desc) as rn
                        from (select *, cast(make_timestamp(timestamp_ms * 1000) as date)
                                            as price_date from points) p) r
                  where rn = 1 and price_usd > 0) h""",
    ),
    "enrich_job": _with(
        ["dim", "clean_texts"],
        """select d.coin_id, t.description
           from dim d left join clean_texts t on t.coin_id = d.coin_id""",
    ),
    "job_run_log": _with(
        ["px_raw"],
        f"""select * from (values ('extraction', 1), ('transformation', 2), ('loading', 3))
                          s(stage, k),
                 lateral (select 'success' as status,
                                 case when k = 2 then (select count(*) from ({_DAILY}) d) end
                                     as rows_processed,
                                 cast(null as varchar) as error_message) v""",
    ).replace("select * from (values", "select stage, status, rows_processed, error_message from (values"),
    "views_after_second_run": _with(
        ["px_raw", "points"],
        f"""select (select count(*) from (
                       select coin_id, cast(make_timestamp(timestamp_ms * 1000) as date) as day
                       from (select *, row_number() over (
                                 partition by coin_id, cast(make_timestamp(timestamp_ms * 1000) as date)
                                 order by timestamp_ms desc, price_usd desc) as rn from points) p
                       where rn = 1 and price_usd > 0
                       union
                       select coin_id, date '2024-01-31' from ({_DAILY}) d) u) as prices,
                   cast(6 as bigint) as runs""",
    ),
    "history_document": _with(["points"], "select * from points"),
    "history_document_coin": _with(
        ["points"], "select * from points where coin_id in ('coin_1', 'coin_22', 'none')"
    ),
    "description_document": _with(["texts"], "select * from texts"),
    "missing_dates_kept": _with(["gaps"], "select * from gaps", last=_GAP_DAY),
    "price_changes": _with(["px", "changes"], "select * from changes", prices="px"),
    "price_changes_long_coin": _with(
        ["long_prices", "changes"], "select * from changes", prices="long_prices"
    ),
    "stored_key_clashes": _with(
        ["px"],
        """select coin_id, price_date, cast(1 as bigint) as stored_rows from px
           where price_date >= date '2024-01-16' and price_date < date '2024-01-20'""",
    ),
    "compacted_log": _with(["run_log"], "select * from run_log"),
    "compacted_health": _with(["health"], "select * from health"),
    "widened_generations": """
        select event_id, user_id,
               case when event_id % 2 = 0 then cast(cast(value as float) as double) else value end as value,
               cast(cast(cast(value as decimal(12,2)) as decimal(20,4)) as double) as cents,
               case when event_id % 2 = 1 then event_type end as kind
        from events""",
}
ORACLES["incremental_backfill"] = ORACLES["backfill_job_defaults"]
