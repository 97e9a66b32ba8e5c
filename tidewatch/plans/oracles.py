"""The same queries as ANSI SQL, for comparison by another engine."""

from __future__ import annotations

from tidewatch.plans.catalog import LATE_EVENTS, PANE_SECONDS, STEPS, TABLE_RULES, TRAVEL_SECONDS
from tidewatch.sources.cities import CITIES

_AMOUNT = f"cast({TABLE_RULES.amount_limit} as double)"
_KM = f"cast({TABLE_RULES.distance_limit_km} as double)"
_SIZE = f"interval '{TABLE_RULES.rapid_window_seconds} seconds'"
_SLIDE = f"interval '{TABLE_RULES.rapid_slide_seconds} seconds'"
_PANES = TABLE_RULES.rapid_window_seconds // TABLE_RULES.rapid_slide_seconds
_EPOCH = "timestamp '1970-01-01 00:00:00'"

_CITIES = ", ".join(
    f"({i}, '{name}', cast({lat} as double), cast({lon} as double))"
    for i, (name, lat, lon) in enumerate(CITIES)
)

_TXNS = f"""
cities(city_idx, city, city_latitude, city_longitude) as (values {_CITIES}),
keyed as (
  select *, cast(json_extract_string(props, '$.k') as int) as k from events
),
txns as (
  select cast(e.event_id as varchar) as transaction_id,
         cast(e.user_id as varchar) as user_id,
         round(e.value, 2) as amount,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') as "timestamp",
         c.city as city,
         c.city_latitude + cast(e.event_id % 21 - 10 as double) / cast(100 as double) as latitude,
         c.city_longitude + cast(e.event_id % 17 - 8 as double) / cast(100 as double) as longitude,
         e.event_type as transaction_type,
         concat('merchant_', e.k) as merchant,
         e.event_type = 'error' as is_seed_fraud,
         e.ts as event_time,
         e.k as k
  from keyed e
  join cities c on c.city_idx = case when e.k >= 90 then e.k % 14 else e.user_id % 14 end
)"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    term = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    missing = " or ".join(f"{c} is null" for c in (lat1, lon1, lat2, lon2))
    return (
        f"case when {missing} then cast(0 as double) else cast(12742 as double) * "
        f"asin(least(cast(1 as double), sqrt({term}))) end"
    )


_HISTORY = f"""
{_TXNS},
located as (
  select *,
         lag(latitude) over (partition by user_id order by event_time, transaction_id) as prev_lat,
         lag(longitude) over (partition by user_id order by event_time, transaction_id) as prev_lon
  from txns
),
measured as (
  select *, {_haversine('prev_lat', 'prev_lon', 'latitude', 'longitude')} as km from located
)"""

_WINDOWS = f"""
windows as (
  select user_id, window_start, window_start + {_SIZE} as window_end, count(*) as txn_count
  from (
    select user_id,
           unnest([{", ".join(
               f"time_bucket({_SLIDE}, event_time, {_EPOCH}) - {i} * {_SLIDE}"
               for i in range(_PANES)
           )}]) as window_start
    from txns
  )
  group by user_id, window_start
),
hot as (select * from windows where txn_count > {TABLE_RULES.rapid_limit})"""

# The same where some rows come in the last of five steps: they count only in windows
# that were open when the step before began: a batch drops rows by the mark of the last one.
_LATE_WINDOWS = f"""
stepped as (
  select *, floor((epoch_us(event_time) - min(epoch_us(event_time)) over ()) * 5
    / (max(epoch_us(event_time)) over () - min(epoch_us(event_time)) over () + 1)) as step,
    cast(transaction_id as bigint) % 50 = 7 as is_late
  from txns
),
mark as (
  select max(event_time) - interval '10 minutes' as passed
  from stepped where step < 3 and not is_late
),
placed as (
  select user_id, step, is_late,
         unnest([{", ".join(
             f"time_bucket({_SLIDE}, event_time, {_EPOCH}) - {i} * {_SLIDE}"
             for i in range(_PANES)
         )}]) as window_start
  from stepped
),
kept as (
  select user_id, window_start, window_start + {_SIZE} as window_end
  from placed, mark
  where step = 4 or not is_late or window_start + {_SIZE} > passed
)"""

_PASSED = "(select max(event_time) from txns) - interval '10 minutes'"


#: Arrival in steps; late is what comes when the watermark has passed its pane.
_ARRIVED = f"""
{_TXNS},
spanned as (
  select *, cast(transaction_id as bigint) as event_id, epoch_us(event_time) as micros,
         epoch_us(min(event_time) over ()) as first, epoch_us(max(event_time) over ()) as last
  from txns
),
dealt as (
  select *, case when {LATE_EVENTS} then {STEPS - 1} else
    cast(floor(cast((micros + (event_id * 7919 % {TRAVEL_SECONDS}) * 1000000::bigint - first) * {STEPS} as double)
      / cast(last - first + 1 + {TRAVEL_SECONDS * 1_000_000} as double)) as int) end as step
  from spanned
),
marked as (
  select *, step = {STEPS - 1} and (micros // {PANE_SECONDS * 1_000_000} + 1) * {PANE_SECONDS * 1_000_000}
    <= (select max(micros) from dealt where step < {STEPS - 1}) - 86400000000 as late
  from dealt
),
ordered as (
  select *,
         case when not late then lag(latitude) over own end as prev_lat,
         case when not late then lag(longitude) over own end as prev_lon
  from marked window own as (partition by user_id, late order by event_time, transaction_id)
),
measured as (
  select *, {_haversine("prev_lat", "prev_lon", "latitude", "longitude")} as km from ordered
)"""


def _rapid(windows: str) -> str:
    return f"""
exists (
  select 1 from {windows} h
  where h.user_id = t.user_id
    and t.event_time >= h.window_start and t.event_time < h.window_end
)"""


def _scored(rapid: bool, windows: str = "hot") -> str:
    """``scored``: with two or with all three rules; ``windows`` names the bursts that count."""
    flags = {
        "high_value": "fraud_high_value",
        **({"rapid_fire": "fraud_rapid_fire"} if rapid else {}),
        "location_anomaly": "fraud_location_anomaly",
    }
    names = ", ".join(f"case when {flag} then '{rule}' end" for rule, flag in flags.items())
    rapid_flag = f"{_rapid(windows)} as fraud_rapid_fire," if rapid else ""
    return f"""
{_HISTORY},
{_WINDOWS},
flagged as (
  select t.*, t.amount > {_AMOUNT} as fraud_high_value, {rapid_flag}
         t.km > {_KM} as fraud_location_anomaly
  from measured t
),
scored as (
  select *, {" or ".join(flags.values())} as is_fraud,
         nullif(concat_ws('+', {names}), '') as fraud_reason,
         round(km, 6) as distance_km
  from flagged
)"""


_TWO, _THREE = _scored(rapid=False), _scored(rapid=True)
_CLOSED = _scored(True, f"(select * from hot where window_end <= {_PASSED})")

# One defect per merchant number, as in the damaged messages.
_FIELDS_LOST = "k in (7, 17)"
_DAMAGED = f"""
{_TXNS},
damaged as (
  select case when k = 77 then event_time - interval '1 day' else event_time end as kafka_ts,
         case when {_FIELDS_LOST} or k = 67 then null else transaction_id end as transaction_id,
         case when {_FIELDS_LOST} or k = 47 then null else user_id end as user_id,
         case when {_FIELDS_LOST} or k = 27 then null
              when k = 57 then cast('nan' as double) else amount end as amount,
         case when {_FIELDS_LOST} then null
              when k = 37 then 'yesterday' else "timestamp" end as "timestamp",
         case when {_FIELDS_LOST} or k = 37 then null else event_time end as event_time,
         k
  from txns
)"""

_MESSAGE = """
'{"transaction_id":"' || transaction_id || '","user_id":"' || user_id
|| '","amount":' || cast(round(amount, 2) as varchar)
|| ',"timestamp":"' || "timestamp" || '","city":"' || city
|| '","latitude":' || cast(round(latitude, 6) as varchar)
|| ',"longitude":' || cast(round(longitude, 6) as varchar)
|| ',"transaction_type":"' || transaction_type || '","merchant":"' || merchant
|| '","is_seed_fraud":' || cast(is_seed_fraud as varchar) || '}'"""

_FIELDS = """transaction_id, user_id, amount, "timestamp", city, latitude, longitude,
  transaction_type, merchant, is_seed_fraud"""


def _select(ctes: str, body: str) -> str:
    return f"with {ctes.strip()}\n{body}"


ORACLES: dict[str, str] = {
    "src_stream": _select(_TXNS, f"select {_FIELDS}, event_time as kafka_ts from txns"),
    "src_record_project": "select props as json_str, ts as kafka_ts from events",
    "src_parquet_dir": "select event_id, ts, user_id, event_type, value, props from events",
    "src_load_results": _select(
        _THREE,
        """select transaction_id, amount, fraud_rapid_fire, is_fraud, cast(0 as bigint) as batch_id,
  case when is_fraud then 'fraud_alerts' else 'transactions' end as table_name from scored""",
    ),
    "dim_city_lookup": _select(
        _TXNS,
        """select t.transaction_id, t.city, c.city_latitude, c.city_longitude
from txns t join cities c on c.city = t.city""",
    ),
    "parse_transactions": _select(
        _TXNS, f"select {_FIELDS}, event_time as kafka_ts, event_time from txns"
    ),
    "parse_event_time": _select(_DAMAGED, 'select kafka_ts, "timestamp", event_time from damaged'),
    "sink_json_value": _select(_TXNS, f"select {_MESSAGE} as value from txns"),
    "rule_high_value": _select(
        _TXNS,
        f"select transaction_id, user_id, amount, amount > {_AMOUNT} as fraud_high_value from txns",
    ),
    "rapid_fire_windows": _select(
        f"{_TXNS},{_WINDOWS}", "select user_id, window_start, window_end, txn_count from hot"
    ),
    "rapid_fire_user_flag": _select(
        f"{_TXNS},{_WINDOWS}",
        """select transaction_id, user_id,
  user_id in (select user_id from hot) as fraud_rapid_fire from txns""",
    ),
    "rule_rapid_fire": _select(
        f"{_TXNS},{_WINDOWS}",
        f"""select t.transaction_id, t.user_id, t.event_time, {_rapid("hot")} as fraud_rapid_fire
from txns t""",
    ),
    "prev_location": _select(
        _HISTORY, "select transaction_id, user_id, event_time, prev_lat, prev_lon from located"
    ),
    "haversine_distance": _select(
        _TXNS,
        f"""select t.transaction_id, round({_haversine(
            'c.city_latitude', 'c.city_longitude', 't.latitude', 't.longitude'
        )}, 6) as distance_km
from txns t join cities c on c.city = t.city""",
    ),
    "rule_location": _select(
        _HISTORY,
        f"""select transaction_id, user_id, round(km, 6) as distance_km,
  km > {_KM} as fraud_location_anomaly from measured""",
    ),
    "fill_flags": _select(
        _DAMAGED,
        f"""select kafka_ts, amount,
  coalesce(amount > {_AMOUNT}, false) as fraud_high_value from damaged""",
    ),
    "combine_flags": _select(
        _TWO,
        """select transaction_id, is_fraud,
  fraud_high_value and fraud_location_anomaly as both_rules, not is_fraud as clean from scored""",
    ),
    "label_reason": _select(_TWO, "select transaction_id, fraud_reason from scored"),
    "score_transactions": _select(
        _THREE,
        """select transaction_id, user_id, amount, event_time, fraud_high_value, fraud_rapid_fire,
  distance_km, fraud_location_anomaly, is_fraud, fraud_reason from scored""",
    ),
    "route_clean": _select(
        _THREE, "select transaction_id, user_id, amount, is_fraud from scored where not is_fraud"
    ),
    "route_alerts": _select(
        _THREE,
        "select transaction_id, user_id, amount, is_fraud, fraud_reason from scored where is_fraud",
    ),
    "route_rejects": _select(
        _DAMAGED,
        f"""select kafka_ts, transaction_id, user_id,
  case when {_FIELDS_LOST} then 'malformed_message'
       when k = 67 then 'missing_transaction_id'
       when k = 47 then 'missing_user_id'
       when k in (27, 57) then 'invalid_amount'
       when k = 77 then 'future_event_time'
       else 'invalid_event_time' end as reject_reason
from damaged where {_FIELDS_LOST} or k in (27, 37, 47, 57, 67, 77)""",
    ),
    "union_results": _select(
        _TWO,
        """select transaction_id, amount, cast(is_fraud as boolean) as is_fraud,
  cast(null as varchar) as fraud_reason from scored where not is_fraud
union all
select transaction_id, amount, cast(null as boolean), fraud_reason from scored where is_fraud""",
    ),
    "sink_clean_parquet": _select(
        _TWO,
        """select transaction_id, user_id, amount, event_time, is_fraud
from scored where not is_fraud""",
    ),
    "sink_alert_parquet": _select(
        _TWO,
        """select transaction_id, user_id, amount, event_time, distance_km, is_fraud, fraud_reason
from scored where is_fraud""",
    ),
    "sink_alert_csv": _select(
        _TWO,
        f"""select {_FIELDS}, date_trunc('millisecond', event_time) as kafka_ts,
  date_trunc('millisecond', event_time) as event_time, fraud_high_value,
  cast(null as boolean) as fraud_rapid_fire, fraud_location_anomaly, is_fraud, fraud_reason from scored where is_fraud""",
    ),
    "batch_metrics": _select(
        _TWO,
        """select count(*) as total, count(*) filter (where is_fraud) as alerts,
  cast(count(*) filter (where is_fraud) as double)
    / cast(greatest(count(*), 1) as double) * 100 as alert_rate from scored""",
    ),
    "stream_foreach_batch": _select(
        _TWO,
        """select transaction_id, user_id, amount, event_time as kafka_ts, event_time,
  fraud_high_value, distance_km, fraud_location_anomaly, is_fraud, fraud_reason from scored""",
    ),
    "stream_recovery": _select(
        _TWO,
        """select is_fraud, fraud_reason, count(*) as rows,
  count(distinct transaction_id) as transactions from scored group by is_fraud, fraud_reason""",
    ),
    "stream_location": _select(
        _HISTORY,
        f"""select transaction_id, user_id, prev_lat, prev_lon, false as out_of_order,
  round(km, 6) as distance_km, km > {_KM} as fraud_location_anomaly from measured""",
    ),
    "stream_location_late": _select(
        _ARRIVED,
        f"""select transaction_id, user_id, prev_lat, prev_lon, late as out_of_order, late,
  round(km, 6) as distance_km, km > {_KM} as fraud_location_anomaly from measured""",
    ),
    "stream_after_backfill": _select(
        _TWO,
        """select transaction_id, user_id, amount, event_time as kafka_ts, event_time,
  fraud_high_value, distance_km, fraud_location_anomaly, is_fraud, fraud_reason from scored""",
    ),
    "stream_rapid_fire": _select(
        f"{_TXNS},{_LATE_WINDOWS}",
        f"""select user_id, window_start, window_end, count(*) as txn_count from kept
where window_end <= {_PASSED}
group by user_id, window_start, window_end having count(*) > {TABLE_RULES.rapid_limit}""",
    ),
    "stream_rapid_fire_rows": _select(
        _CLOSED,
        """select transaction_id, user_id, fraud_high_value, fraud_rapid_fire,
  fraud_location_anomaly, is_fraud, fraud_reason from scored""",
    ),
    "stream_corrections": _select(
        _CLOSED,
        """select transaction_id, user_id, fraud_high_value, fraud_rapid_fire,
  fraud_location_anomaly, is_fraud, fraud_reason from scored""",
    ),
    "stream_batch_records": _select(
        f"""{_TWO},
span as (
  select min(epoch_us(ts)) as first, max(epoch_us(ts)) - min(epoch_us(ts)) + 1 as length from events
),
stepped as (
  select *, cast(floor((epoch_us(event_time) - first) * {STEPS} / length) as bigint) as batch_id
  from scored, span
)""",
        """select batch_id, count(*) as total, count(*) filter (where is_fraud) as alerts,
  cast(0 as bigint) as rejects,
  round(cast(count(*) filter (where is_fraud) as double) / cast(count(*) as double) * 100, 6) as alert_rate,
  count(*) as rows from stepped group by batch_id""",
    ),
    "stream_offset_audit": f"""with span as (
  select min(epoch_us(ts)) as first, max(epoch_us(ts)) - min(epoch_us(ts)) + 1 as length from events
),
steps as (
  select cast(floor((epoch_us(ts) - first) * {STEPS} / length) as bigint) as batch_id from events, span
)
select b.batch_id, case when b.batch_id = 0 then 'start' else 'progress' end as verdict,
  cast(0 as bigint) as missing_batches, false as replays,
  (select count(*) from steps s where s.batch_id = b.batch_id) as rows
from range({STEPS}) b(batch_id)""",
    "rapid_fire_burst_rows": _select(
        f"{_TXNS},{_WINDOWS}",
        """select t.transaction_id, t.user_id, t.event_time, h.window_start, h.window_end, h.txn_count
from txns t join hot h
  on h.user_id = t.user_id and t.event_time >= h.window_start and t.event_time < h.window_end""",
    ),
    "report_kpis": _select(
        _TWO,
        """select count(*) as total, count(*) filter (where is_fraud) as alerts,
  round(cast(count(*) filter (where is_fraud) as double)
    / cast(greatest(count(*), 1) as double) * 100, 6) as alert_rate,
  round(avg(amount) filter (where is_fraud), 6) as avg_alert_amount from scored""",
    ),
    "report_latest_alerts": _select(
        _THREE,
        """select transaction_id, user_id, amount, city, fraud_reason, "timestamp",
  contains(fraud_reason, 'high_value') as is_high_value
from scored where is_fraud order by event_time desc, transaction_id limit 20""",
    ),
    "report_reason_counts": _select(
        _THREE,
        """select fraud_reason as reason, count(*) as alerts from scored
where is_fraud group by fraud_reason order by alerts desc, reason""",
    ),
    "report_volume_by_minute": _select(
        _THREE,
        """select date_trunc('minute', event_time) as minute, is_fraud, count(*) as rows
from scored group by 1, 2 order by 1, 2""",
    ),
    "report_geo_grid": _select(
        _THREE,
        """select cast(floor(latitude) as double) as south, cast(floor(longitude) as double) as west,
  count(*) as alerts, round(sum(amount), 2) as amount from scored where is_fraud group by 1, 2""",
    ),
    "stream_partial_reports": _select(
        _TWO,
        """select 'kpis' as report, 'total' as of, cast(count(*) as double) as figure from scored
union all
select 'kpis', 'alerts', cast(count(*) filter (where is_fraud) as double) from scored
union all
select 'kpis', 'alert_rate', round(cast(count(*) filter (where is_fraud) as double)
  / cast(greatest(count(*), 1) as double) * 100, 6) from scored
union all
select 'kpis', 'avg_alert_amount', round(avg(amount) filter (where is_fraud), 6) from scored
union all
select 'reason_counts', fraud_reason, cast(count(*) as double) from scored where is_fraud group by 2
union all
select 'volume_by_minute', concat(strftime(event_time, '%Y-%m-%d %H:%M'), ' ', cast(is_fraud as varchar)),
  cast(count(*) as double) from scored group by 2
union all
select 'geo_grid', concat(cast(floor(latitude) as int), ' ', cast(floor(longitude) as int)),
  cast(count(*) as double) from scored where is_fraud group by 2
union all
select * from (select 'latest_alerts', transaction_id, round(amount, 6) from scored where is_fraud
  order by event_time desc, transaction_id limit 20)""",
    ),
    "report_geo_points": _select(
        _THREE,
        """select latitude, longitude, amount, city, user_id, fraud_reason from scored
where is_fraud""",
    ),
}
