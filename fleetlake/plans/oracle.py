"""Plain SQL that must give the same rows as the registered queries (run by DuckDB)."""

from __future__ import annotations


def r(expr: str, digits: int) -> str:
    """Round half up on the decimal value, as the queries do."""
    return f"cast(round(cast({expr} as decimal(28,6)), {digits}) as double)"


READINGS = """
k as (
  select event_id as eid, event_id + copy * 1000000000000000 as event_id, copy, cast(ts as timestamp) ts0, event_type, value, sv,
         concat(case when sv < 10 then '0' else '' end, cast(sv as varchar)) as number,
         cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
         extract(day from ts) as dd, extract(hour from ts) as hh
  from (select *, unnest(case when event_id % 61 = 0 then [0, 1] else [0] end) as copy,
               case when user_id % 10 <> 9 then (user_id // 2) % 10 + 1 else 100 + user_id end as sv
        from events)),
r0 as (
  select event_id,
    case when eid % 503 = 0 then null
         when eid % 7 = 0 or copy = 1 then concat('  SERVER', number, ' ')
         else concat('server', number) end as server_id,
    concat('Web-App-', number) as hostname,
    case when eid % 499 = 0 then ts0 - interval 1826 days
         when eid % 491 = 0 then ts0 + interval 27394 days
         else ts0 end as "timestamp",
    case when eid % 97 = 0 then null
         when eid % 89 = 0 then 105e0 + k
         when sv = 1 and dd = 11 and hh < 6 then 95e0 + k / 2e1
         else 10e0 + k * 5e-1 end as cpu_usage_percent,
    case when eid % 101 = 0 then null
         when sv = 3 and dd = 11 then 50e0 + hh * 2e0
         else 40e0 + (eid * 37 % 1000) / 1e2 end as memory_usage_percent,
    case when eid % 103 = 0 then null
         when sv = 5 and dd between 11 and 12 then 45e0 + ((dd - 11) * 24 + hh) * 1e0
         else 48e0 + eid % 5 end as disk_usage_percent,
    value * 1e1 as disk_io_read,
    case when eid % 271 = 0 then -1e0 - value else value end as disk_io_write,
    case when sv = 7 and dd = 11 and hh < 3 then 5e6 + value else 3e5 + value * 1e3 end as network_rx_bytes,
    case when sv = 7 and dd = 11 and hh < 3 then 3e6 + value else 2e5 + value * 6e2 end as network_tx_bytes,
    cast(case when eid % 277 = 0 then -1
              when sv = 8 and dd = 11 and hh < 6 then 20 + k % 40
              when event_type = 'error' then k % 3 else 0 end as bigint) as application_error_count,
    case when sv = 10 and dd = 11 and hh < 9 then 9e2 + k else 1e2 + k * 4e-1 end as response_time_ms,
    cast(case when dd = 11 and ((sv = 1 and hh < 6) or sv = 3 or sv = 5 or (sv = 7 and hh < 3)
                           or (sv = 8 and hh < 6) or (sv = 10 and hh < 9))
           or (dd = 12 and sv = 5) then 1 else 0 end as int) as is_injected_anomaly
  from k),
readings as (
  select *,
    case when cpu_usage_percent > 90 or memory_usage_percent > 90 or disk_usage_percent > 90 then 'CRITICAL'
         when cpu_usage_percent > 75 or memory_usage_percent > 75 or application_error_count > 10 then 'WARNING'
         else 'OK' end as status,
    cast("timestamp" as date) as dt
  from r0),
canon as (
  select * replace (trim(lower(server_id), ' ') as server_id, trim(lower(hostname), ' ') as hostname)
  from readings)"""

RULES = {
    "missing_required_field": "server_id is null or \"timestamp\" is null",
    "invalid_timestamp": "\"timestamp\" is null or \"timestamp\" < timestamp '2020-01-01 00:00:00' or \"timestamp\" > timestamp '2024-02-01 00:00:00'",
    "cpu_out_of_range": "cpu_usage_percent is null or cpu_usage_percent < 0 or cpu_usage_percent > 100",
    "memory_out_of_range": "memory_usage_percent is null or memory_usage_percent < 0 or memory_usage_percent > 100",
    "disk_out_of_range": "disk_usage_percent is null or disk_usage_percent < 0 or disk_usage_percent > 100",
    "negative_io_or_network": "disk_io_read < 0 or disk_io_write < 0 or network_rx_bytes < 0 or network_tx_bytes < 0",
    "negative_errors_or_latency": "application_error_count < 0 or response_time_ms < 0",
}

_REASON = "case " + " ".join(
    f"when {rule} then '{name}'" for name, rule in reversed(list(RULES.items()))
) + " end"

SILVER = f"""{READINGS},
uniq as (
  select * exclude (rn) from (
    select *, row_number() over (partition by server_id, "timestamp" order by event_id) rn from canon)
  where rn = 1),
classified as (select *, {_REASON} as _reject_reason from uniq),
v as (select * exclude (_reject_reason) from classified where _reject_reason is null),
rejects as (select * from classified where _reject_reason is not null)"""

_SHORT = {"cpu": "cpu_usage_percent", "memory": "memory_usage_percent", "disk": "disk_usage_percent"}
_COMMON = ", ".join(
    [
        f"avg({c}) as avg_{m}_percent, max({c}) as peak_{m}_percent"
        for m, c in _SHORT.items()
    ]
    + [
        "avg(network_rx_bytes) as avg_network_rx_bytes",
        "avg(network_tx_bytes) as avg_network_tx_bytes",
        "avg(application_error_count) as avg_errors_per_interval",
        "avg(response_time_ms) as avg_response_time_ms",
    ]
)
_COMMON_NAMES = [f"{a}_{m}_percent" for m in _SHORT for a in ("avg", "peak")] + [
    "avg_network_rx_bytes",
    "avg_network_tx_bytes",
    "avg_errors_per_interval",
    "avg_response_time_ms",
]
_RULE = "status in ('WARNING', 'CRITICAL')"
_PENALTY = """greatest(0e0, peak_cpu_percent - 8e1) + greatest(0e0, peak_memory_percent - 8e1)
  + greatest(0e0, peak_disk_percent - 9e1) * 15e-1 + avg_errors_per_interval * 5e0 + anomaly_count * 2e0"""
_HEALTH = r(f"greatest(0e0, least(1e2, 1e2 - ({_PENALTY})))", 1)


def gold(source: str, name: str = "summary") -> str:
    """CTEs for the server summary of one set of readings."""
    p = name
    return f"""{p}_base as (
  select server_id, hostname, {_COMMON}, max(response_time_ms) as peak_response_time_ms,
         count(*) filter ({_RULE}) as anomaly_count, count(*) as total_readings
  from {source} group by server_id, hostname),
{p}_mid as (
  select make_timestamp(min(epoch_us("timestamp"))
         + cast(round_even((max(epoch_us("timestamp")) - min(epoch_us("timestamp"))) / 2e0, 0) as bigint)) as mid
  from {source}),
{p}_halves as (
  select server_id, avg(disk_usage_percent) filter ("timestamp" < mid) as h1,
         avg(disk_usage_percent) filter ("timestamp" >= mid) as h2
  from {source}, {p}_mid group by server_id),
{p} as (
  select server_id, hostname, {", ".join(f"{r(c, 2)} as {c}" for c in _COMMON_NAMES + ["peak_response_time_ms"])},
         anomaly_count, total_readings, {r("avg_errors_per_interval * 12e0", 2)} as errors_per_hour,
         {r("h2 - h1", 2)} as disk_trend_percent_change, {_HEALTH} as health_score
  from {p}_base left join {p}_halves using (server_id))"""


SUMMARY = f"{SILVER},\n{gold('v')}"
BAND = "case when health_score < 60 then 'Critical' when health_score < 85 then 'Warning' else 'Healthy' end"
SEVERITY = "case when health_score < 60 then 'CRITICAL' when health_score < 85 then 'WARNING' end"

META = """meta as (
  select concat('server', number) as server_id, concat('192.168.', cast(sv // 200 as varchar), '.', cast(sv % 200 + 1 as varchar)) as ip_address,
         case when sv % 3 = 0 then 'staging' else 'live' end as environment,
         case when sv % 2 = 0 then 'Debian 12' else 'Alma 9' end as operating_system,
         concat('service-', cast(sv % 5 as varchar)) as application
  from (select distinct sv, number from k) where {known})"""

VIEW = f"""{SUMMARY},
{META.format(known='true')},
health as (
  select s.* exclude (hostname), s.hostname, m.environment, m.application, {BAND} as status
  from summary s left join meta m using (server_id))"""

_DAILY_COLUMNS = ", ".join(f"{r(c, 2)} as {c}" for c in _COMMON_NAMES)


def daily(source: str) -> str:
    return f"""select server_id, dt, {_DAILY_COLUMNS}, anomaly_count
  from (select server_id, dt, {_COMMON}, count(*) filter ({_RULE}) as anomaly_count
        from {source} group by server_id, dt)"""


SLOPES = f"""{SILVER},
numbered as (select *, row_number() over (partition by server_id order by "timestamp") rn from v),
featured as (
  select *, ln(1e0 + application_error_count) as error_count_log,
    case when rn < 288 then 0e0 else {r("regr_slope(memory_usage_percent, rn) over w * 288e0", 4)} end as mem_slope_24h,
    case when rn < 288 then 0e0 else {r("regr_slope(disk_usage_percent, rn) over w * 288e0", 4)} end as disk_slope_24h
  from numbered
  window w as (partition by server_id order by "timestamp" rows between 287 preceding and current row))"""

FEATURES = [
    "cpu_usage_percent",
    "memory_usage_percent",
    "disk_usage_percent",
    "network_rx_bytes",
    "network_tx_bytes",
    "error_count_log",
    "response_time_ms",
    "mem_slope_24h",
    "disk_slope_24h",
]


def scalers(source: str, features: list[str]) -> str:
    casts = ", ".join(f"cast({f} as double) as {f}" for f in features)
    return f"""long as (
  unpivot (select server_id, {casts} from {source}) on {", ".join(features)} into name feature value x),
medians as (select server_id, feature, quantile_cont(x, 0.5) as median, stddev_samp(x) + 1e-9 as std
            from long group by server_id, feature),
mads as (select server_id, feature, quantile_cont(abs(x - median), 0.5) as mad
         from long join medians using (server_id, feature) group by server_id, feature),
scalers as (select server_id, feature, median, case when mad > 1e-6 then mad else std end as scale
            from medians join mads using (server_id, feature)),
wide as (
  select server_id, {", ".join(f"max(median) filter (feature = '{f}') as median_{f}, max(scale) filter (feature = '{f}') as scale_{f}" for f in features)}
  from scalers group by server_id)"""


_Z = ", ".join(f"6745e-4 * ({f} - median_{f}) / scale_{f} as z_{f}" for f in FEATURES)
SCALED = f"""{SLOPES},
{scalers("featured", FEATURES)},
z as (select f.*, {_Z} from featured f join wide using (server_id))"""

_LARGEST = "greatest(" + ", ".join(f"abs(z_{f})" for f in FEATURES) + ")"


def _by_dominant(value: dict[str, str]) -> str:
    return "case " + " ".join(
        f"when abs(z_{f}) = {_LARGEST} then {value[f]}" for f in FEATURES
    ) + " end"


_LABEL = {f: f"'{f}'" for f in FEATURES} | {
    "error_count_log": "'application_error_count'",
    "mem_slope_24h": "'memory_usage_percent (trend)'",
    "disk_slope_24h": "'disk_usage_percent (trend)'",
}
_RAW = {f: f"cast({f} as double)" for f in FEATURES} | {
    "error_count_log": "cast(application_error_count as double)",
    "mem_slope_24h": "memory_usage_percent",
    "disk_slope_24h": "disk_usage_percent",
}
SCORED = f"""{SCALED},
s0 as (select *, {r(_LARGEST, 6)} as score from z),
cut as (select quantile_cont(score, 0.95) as cut from s0),
scored as (
  select * exclude (cut), {r("score - cut", 6)} as anomaly_score, cast(case when score - cut > 0 then 1 else 0 end as int) as is_anomaly,
         case when score - cut > 0 then 'ANOMALY' else 'NORMAL' end as result,
         {_by_dominant({f: f"'{f}'" for f in FEATURES})} as dominant_feature,
         {_by_dominant(_LABEL)} as metric, {_by_dominant(_RAW)} as value
  from s0, cut)"""

EVENTS = f"""{SCORED},
gaps as (
  select *, "timestamp" - lag("timestamp") over (partition by server_id order by "timestamp") as gap
  from scored where is_anomaly = 1),
runs as (
  select *, sum(case when gap is null or gap > interval '30 minutes' then 1 else 0 end)
            over (partition by server_id order by "timestamp") as run
  from gaps),
ranked as (select *, row_number() over (partition by server_id, run order by anomaly_score desc, "timestamp") as place from runs),
incidents as (
  select server_id, min("timestamp") as "timestamp",
         max("timestamp") filter (place = 1) as peak_timestamp,
         max(metric) filter (place = 1) as metric,
         {r("max(value) filter (place = 1)", 4)} as value,
         {r("max(anomaly_score)", 4)} as peak_score,
         count(*) as readings,
         cast(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 6e7) + 5 as int) as duration_minutes,
         'ml_isolation_forest' as detection_method
  from ranked group by server_id, run),
finished as (
  select *, case when row_number() over (order by peak_score desc, server_id, "timestamp")
                      <= greatest(1, (count(*) over ()) // 3) then 'CRITICAL' else 'WARNING' end as severity,
         concat('Isolation Forest flagged ', metric, ' on ', server_id, ': ', cast(readings as varchar),
                ' flagged readings spanning ~', cast(duration_minutes as varchar), ' minutes (peak reading ',
                strftime(peak_timestamp, '%Y-%m-%d %H:%M'), ' UTC, anomaly score ',
                cast(cast(cast(peak_score as decimal(18,6)) as decimal(18,3)) as varchar), ').') as description
  from incidents)"""

HALF_FLAGGED = f"""{SILVER},
hf as (select *, cast(case when response_time_ms > 130 or application_error_count > 1 then 1 else 0 end as int) as is_anomaly from v)"""


def _evaluation(flag: str) -> str:
    return f"""select tp, fp, fn, tn, unscored, {r("coalesce(tp / nullif(cast(tp + fp as double), 0), 0)", 3)} as precision,
  {r("coalesce(tp / nullif(cast(tp + fn as double), 0), 0)", 3)} as recall,
  {r("coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0)", 3)} as f1
from (select count(*) filter (({flag}) and is_injected_anomaly = 1) as tp, count(*) filter (({flag}) and is_injected_anomaly <> 1) as fp,
             count(*) filter (not ({flag}) and is_injected_anomaly = 1) as fn,
             count(*) filter (not ({flag}) and is_injected_anomaly <> 1) as tn,
             count(*) filter (({flag}) is null) as unscored"""


NETWORK_Z = f"""{SILVER},
nm as (select quantile_cont(network_rx_bytes, 0.5) as med from v),
nd as (select quantile_cont(abs(network_rx_bytes - med), 0.5) as mad from v, nm),
nz as (select v.*, 6745e-4 * (network_rx_bytes - med) / nullif(mad, 0) as z from v, nm, nd)"""

RUNS = f"""{SILVER},
early as (select server_id, dt, avg_cpu_percent, anomaly_count, 'early' as run
          from ({daily("(select * from v where \"timestamp\" < timestamp '2024-01-16 00:00:00')")})),
late as (select server_id, dt, avg_cpu_percent, anomaly_count, 'late' as run
         from ({daily("(select * from v where \"timestamp\" >= timestamp '2024-01-11 00:00:00')")}))"""


def _step(previous: str, summary: str, now: str, name: str) -> str:
    now = f"timestamp '{now} 00:00:00'"
    return f"""{name}_both as (
  select coalesce(o.server_id, s.server_id) as server_id, o.severity as old, o.triggered_at,
         {SEVERITY.replace("health_score", "s.health_score")} as new, s.server_id is not null as judged
  from (select * from {previous} where not resolved) o full join {summary} s on o.server_id = s.server_id),
{name} as (
  select * from {previous} where resolved
  union all
  select server_id, 'health_score', old, triggered_at, judged and new is distinct from old,
         case when judged and new is distinct from old then {now} end
  from {name}_both where old is not null
  union all
  select server_id, 'health_score', new, {now}, false, null
  from {name}_both where judged and new is not null and new is distinct from old)"""


ALERT_STEPS = f"""{SILVER},
p1 as (select * from v where "timestamp" < timestamp '2024-01-11 00:00:00'),
p2 as (select * from v where "timestamp" < timestamp '2024-01-16 00:00:00'),
p3 as (select * from v where "timestamp" >= timestamp '2024-01-13 00:00:00'),
{gold("p1", "s1")},
{gold("p2", "s2")},
{gold("p3", "s3")},
{gold("v", "s4")},
al0 as (select '' as server_id, '' as metric, '' as severity, timestamp '2024-01-01' as triggered_at,
               false as resolved, cast(null as timestamp) as resolved_at where false),
{_step("al0", "s1", "2024-01-11", "al1")},
{_step("al1", "s2", "2024-01-16", "al2")},
{_step("al2", "s3", "2024-01-31", "al3")},
{_step("al3", "s4", "2024-02-01", "al4")}"""

_TRAFFIC = "avg(network_rx_bytes) as avg_rx, max(network_rx_bytes) as peak_rx, avg(network_tx_bytes) as avg_tx, max(network_tx_bytes) as peak_tx"
_NORMAL = "(select *, hour(\"timestamp\") as hour from v where is_injected_anomaly <> 1)"

# name -> (CTEs, final select)
_PARTS: dict[str, tuple[str, str]] = {
    "s01_csv_scan": (READINGS, f"""select status, is_injected_anomaly, count(*) as n, count(server_id) as with_server,
        {r("sum(cpu_usage_percent)", 2)} as cpu_total, max("timestamp") as last_timestamp
        from readings group by status, is_injected_anomaly"""),
    "s02_utc_day": (READINGS, 'select event_id, "timestamp", dt from readings'),
    "s03_land": (SILVER, "select server_id, dt, count(*) as n, max(cpu_usage_percent) as peak_cpu from v group by server_id, dt"),
    "s05_scan_landing": (READINGS, 'select event_id, server_id, dt, "timestamp", network_rx_bytes from readings'),
    "s06_bronze_lineage": (READINGS, "select dt, count(*) as n, count(*) as n_lineage_matches, count(*) as n_ingested from readings group by dt"),
    "s07_write_table": (SILVER, f"select server_id, dt, avg_cpu_percent, anomaly_count from ({daily('v')})"),
    "s08_managed_table": (SILVER, "select server_id, hostname, count(*) as total_readings from v group by server_id, hostname"),
    "s09_read_table": (SILVER, "select event_id, server_id, _reject_reason from rejects"),
    "s10_scores_and_events": (EVENTS, """select server_id, a.readings, a.flagged, b.incidents, b.readings_in_incidents
        from (select server_id, count(*) as readings, cast(sum(is_anomaly) as bigint) as flagged from scored group by server_id) a
        left join (select server_id, count(*) as incidents, cast(sum(readings) as bigint) as readings_in_incidents
                   from incidents group by server_id) b using (server_id)"""),
    "s12_serving_anomalies": (EVENTS, 'select server_id, "timestamp", metric, value, severity, detection_method, description from finished'),
    "s14_conform": (SUMMARY, "select server_id, cast(anomaly_count as int) as anomaly_count, cast(total_readings as int) as total_readings, "
        + ", ".join(
            f"cast(try_cast({c} as decimal({t})) as varchar) as {c}"
            for t, cols in {
                "5,2": [f"{a}_{m}_percent" for m in _SHORT for a in ("avg", "peak")],
                "14,2": ["avg_network_rx_bytes", "avg_network_tx_bytes"],
                "6,2": ["avg_errors_per_interval", "errors_per_hour", "disk_trend_percent_change"],
                "8,2": ["avg_response_time_ms", "peak_response_time_ms"],
                "5,1": ["health_score"],
            }.items()
            for c in cols
        ) + " from summary"),
    "s14_overflow_report": (SILVER, """select 'network_rx_bytes' as column_name, count(*) filter (network_rx_bytes is not null and try_cast(network_rx_bytes as decimal(9,2)) is null) as lost_values from v
        union all select 'disk_io_read', count(*) filter (disk_io_read is not null and try_cast(disk_io_read as decimal(4,2)) is null) from v
        union all select 'response_time_ms', count(*) filter (response_time_ms is not null and try_cast(response_time_ms as decimal(5,2)) is null) from v"""),
    "p01_enforce_types": (READINGS, """select event_id, status, "timestamp", cpu_usage_percent, memory_usage_percent, disk_usage_percent,
        disk_io_read, disk_io_write, network_rx_bytes, network_tx_bytes, application_error_count,
        case when application_error_count > 0 then null else response_time_ms end as response_time_ms from readings"""),
    "p02_standardise": (READINGS, "select server_id, hostname, count(*) as n from canon group by server_id, hostname"),
    "p03_validity_rules": (READINGS, "select event_id, " + ", ".join(f"coalesce({c}, false) as {n}" for n, c in RULES.items()) + " from canon"),
    "p04_reject_reason": (SILVER, "select event_id, _reject_reason from rejects"),
    "p04_all_reasons": (READINGS, "select event_id, concat_ws(',', " + ", ".join(f"case when {c} then '{n}' end" for n, c in RULES.items()) + ") as reasons from canon"),
    "p05_valid_rows": (SILVER, "select * from v"),
    "p05_reject_rows": (SILVER, "select * from rejects"),
    "p06_status": (READINGS, "select event_id, status from readings"),
    "p07_rule_flag": (SILVER, f"select event_id, {_RULE} as is_rule_anomaly from v"),
    "p08_health_band": (SUMMARY, f"select server_id, health_score, {BAND} as band from summary"),
    "p09_alerts": (SUMMARY, f"""select server_id, 'health_score' as metric, {SEVERITY} as severity,
        concat(server_id, ' health_score is ', cast(cast(health_score as decimal(5,1)) as varchar), ' (anomaly_count=', cast(anomaly_count as varchar), ')') as message,
        timestamp '2024-02-01 00:00:00' as triggered_at, false as resolved from summary where health_score < 85"""),
    "p10_round_cols": (READINGS, f"""select event_id, {r("disk_io_read * 5e-2", 1)} as io, {r("response_time_ms", 1)} as response_time_ms,
        {r("network_tx_bytes", 1)} as network_tx_bytes from readings"""),
    "p11_round_scores": (SCORED, f"""select "timestamp", server_id, {r("anomaly_score", 2)} as anomaly_score,
        {", ".join(f"{r(f, 2)} as {f}" for f in FEATURES[:7])} from scored order by scored.anomaly_score desc, server_id, "timestamp" limit 10"""),
    "p12_filter_servers": (VIEW, "select server_id, hostname, environment, application, status from health where server_id in ('server03', 'server05', 'server08')"),
    "p13_filter_severity": (EVENTS, "select server_id, \"timestamp\", severity from finished where severity in ('CRITICAL')"),
    "p14_unresolved": (ALERT_STEPS, "select server_id, severity, triggered_at from al4 where not resolved"),
    "p15_units": (SILVER, f"""select server_id, {r("avg(network_rx_bytes) / 1e6", 2)} as avg_rx_mb, {r("avg(network_tx_bytes) / 1e6", 2)} as avg_tx_mb,
        {r("avg(application_error_count) * 12e0", 2)} as errors_per_hour from v group by server_id, hostname"""),
    "p16_label_result": (HALF_FLAGGED, "select event_id, is_anomaly, case when is_anomaly = 1 then 'ANOMALY' else 'NORMAL' end as result from hf"),
    "p17_around": (SILVER, """select event_id, server_id, "timestamp", network_rx_bytes
        from v, (select min("timestamp") as lo, max("timestamp") as hi from v where network_rx_bytes > 2e6)
        where "timestamp" between lo - interval '6 hours' and hi + interval '6 hours'"""),
    "p18_health_table": (VIEW, """select server_id as "Server", status as "Status", health_score as "Health Score", avg_cpu_percent as "Avg CPU %",
        peak_cpu_percent as "Peak CPU %", avg_memory_percent as "Avg Mem %", peak_memory_percent as "Peak Mem %", avg_disk_percent as "Avg Disk %",
        peak_disk_percent as "Peak Disk %", errors_per_hour as "Errors/hr", avg_response_time_ms as "Avg Resp (ms)", anomaly_count as "Rule Anomalies",
        disk_trend_percent_change as "Disk Trend (pp)" from health order by health_score, server_id"""),
    "p19_description": (EVENTS, 'select server_id, "timestamp", description from finished'),
    "p20_normal_only": (SILVER, "select event_id, server_id from v where is_injected_anomaly <> 1"),
    "d01_dedup": (SILVER, 'select event_id, server_id, "timestamp" from uniq'),
    "d02_duplicate_count": (READINGS, 'select cast(sum(n - 1) as bigint) as duplicate_rows from (select count(*) as n from canon group by server_id, "timestamp")'),
    "j01_disk_halves": (SUMMARY, f"select server_id, {r('h1', 3)} as disk_first_half_avg, {r('h2', 3)} as disk_second_half_avg from summary_halves"),
    "j02_health_view": (VIEW, "select * from health"),
    "j03_metadata": (f"{SILVER},\n{META.format(known='sv % 4 <> 0')}", """select server_id, hostname, ip_address, environment, operating_system, application
        from (select distinct server_id, hostname from v) left join meta using (server_id)"""),
    "j04_attach_scalers": (f"{SILVER},\n{scalers('v', ['cpu_usage_percent', 'response_time_ms'])}",
        """select event_id, median_cpu_usage_percent, scale_cpu_usage_percent, median_response_time_ms, scale_response_time_ms
        from v join wide using (server_id)"""),
    "j05_peak_reading": (SILVER, """select server_id, "timestamp" as peak_timestamp, response_time_ms as peak_latency, event_id, cpu_usage_percent as cpu_at_peak
        from (select *, row_number() over (partition by server_id order by response_time_ms desc, "timestamp") rn from v) where rn = 1"""),
    "j06_per_server_counts": (SILVER, f"""select server_id, count(*) filter ({_RULE}) as rule_flagged, count(*) filter (response_time_ms > 500) as slow,
        count(*) filter (application_error_count > 10) as bursts from v group by server_id"""),
    "j07_insert_absent": (RUNS, """select * from early union all
        select * from late where not exists (select 1 from early e where e.server_id = late.server_id and e.dt = late.dt)"""),
    "j08_upsert": (RUNS, """select *, timestamp '2024-02-01 00:00:00' as updated_at from late union all
        select *, timestamp '2024-01-16 00:00:00' from early where not exists (select 1 from late l where l.server_id = early.server_id and l.dt = early.dt)"""),
    "j09_orphans": (f"{READINGS},\n{META.format(known='sv % 4 <> 0')}", """select event_id, server_id, "timestamp" from canon
        where not exists (select 1 from meta m where m.server_id = canon.server_id)"""),
    "j10_server_detail": (f"""{EVENTS},
{gold('v')},
{META.format(known='true')}""", f"""select h.server_id, {BAND} as status, health_score, avg_cpu_percent, peak_cpu_percent, avg_memory_percent, peak_memory_percent,
        avg_disk_percent, peak_disk_percent, {r("avg_network_rx_bytes / 1e6", 2)} as avg_rx_mb, {r("avg_network_tx_bytes / 1e6", 2)} as avg_tx_mb,
        errors_per_hour, avg_response_time_ms, peak_response_time_ms, f."timestamp", f.metric, f.severity, f.value, f.description
        from summary h left join finished f using (server_id) where h.server_id = 'server03'"""),
    "a01_server_base": (SUMMARY, f"""select server_id, hostname, {", ".join(f"{r(c, 3)} as {c}" for c in _COMMON_NAMES + ["peak_response_time_ms"])},
        anomaly_count, total_readings from summary_base"""),
    "a02_disk_trend": (SUMMARY, f"select server_id, {r('h2 - h1', 2)} as disk_trend_percent_change from summary_halves"),
    "a03_health_score": (SUMMARY, "select server_id, hostname, health_score from summary"),
    "a04_server_summary": (SUMMARY, "select * from summary"),
    "a05_daily_metrics": (SILVER, f"{daily('v')} order by server_id, dt"),
    "a06_reject_breakdown": (SILVER, "select _reject_reason, count(*) as n from rejects group by _reject_reason order by n desc, _reject_reason"),
    "a07_pipeline_counts": (SILVER, f"""select valid_rows, rejected_rows, servers, bronze_rows, {r("100 * valid_rows / cast(bronze_rows as double)", 1)} as pass_rate_percent
        from (select count(*) as valid_rows, count(distinct server_id) as servers from v),
             (select count(*) as rejected_rows from rejects), (select count(*) as bronze_rows from readings)"""),
    "a08_cpu_profile": (SILVER, f"""select server_id, {r("avg(cpu_usage_percent)", 2)} as avg_cpu, {r("quantile_cont(cpu_usage_percent, 0.5)", 2)} as median_cpu,
        {r("quantile_cont(cpu_usage_percent, 0.99)", 2)} as p99_cpu, {r("max(cpu_usage_percent)", 2)} as peak_cpu from v group by server_id order by avg_cpu desc, server_id"""),
    "a09_cpu_spread": (SILVER, f"""select {r("max(m) - min(m)", 2)} as spread from (select {r("avg(cpu_usage_percent)", 2)} as m from v group by server_id)"""),
    "a10_error_profile": (SILVER, f"""select server_id, cast(sum(application_error_count) as bigint) as total_errors, {r("avg(application_error_count) * 12e0", 2)} as errors_per_hour,
        max(application_error_count) as worst_interval from v group by server_id order by total_errors desc, server_id"""),
    "a11_error_outlier": (SILVER, f"""select server_id, total_errors, fleet_median, {r("total_errors / nullif(fleet_median, 0)", 2)} as times_median
        from (select server_id, cast(sum(application_error_count) as bigint) as total_errors, median(sum(application_error_count)) over () as fleet_median
              from v group by server_id) order by total_errors desc, server_id limit 1"""),
    "a12_week_slope": (SILVER, f"""select server_id, {r("regr_slope(memory_usage_percent, d)", 3)} as mem_week_slope, {r("regr_slope(disk_usage_percent, d)", 3)} as disk_week_slope
        from (select *, (epoch_us("timestamp") - min(epoch_us("timestamp")) over (partition by server_id)) / 864e8 as d from v) group by server_id"""),
    "a13_trend_report": (f"""{SLOPES},
worst as (
  select server_id, max(m) as m, max(d) as d from (
    select server_id, rn, regr_slope(memory_usage_percent, rn) over w * 288e0 as m, regr_slope(disk_usage_percent, rn) over w * 288e0 as d from numbered
    window w as (partition by server_id order by "timestamp" rows between 287 preceding and current row)) where rn >= 288 group by server_id),
week as (
  select server_id, regr_slope(memory_usage_percent, t) as m, regr_slope(disk_usage_percent, t) as d, max(memory_usage_percent) as mp, max(disk_usage_percent) as dp
  from (select *, (epoch_us("timestamp") - min(epoch_us("timestamp")) over (partition by server_id)) / 864e8 as t from v) group by server_id)""",
        f"""select server_id, {r("week.m", 3)} as mem_week_slope, {r("worst.m", 2)} as mem_worst_24h_slope, {r("mp", 1)} as mem_peak,
        {r("week.d", 3)} as disk_week_slope, {r("worst.d", 2)} as disk_worst_24h_slope, {r("dp", 1)} as disk_peak
        from week left join worst using (server_id) order by mem_worst_24h_slope desc nulls last, server_id"""),
    "a14_network_profile": (SILVER, f"""select server_id, {", ".join(f"{r(c, 0)} as {c}" for c in ("avg_rx", "peak_rx", "avg_tx", "peak_tx"))}, {r("peak_rx / nullif(avg_rx, 0)", 1)} as peak_to_avg_rx
        from (select server_id, {_TRAFFIC} from v group by server_id)"""),
    "a15_fleet_robust_z": (NETWORK_Z, f"select server_id, {r('max(z)', 1)} as max_robust_z, count(*) filter (z > 6) as intervals_above_cut from nz group by server_id"),
    "a15_z_p999": (NETWORK_Z, f"select {r('quantile_cont(z, 0.999)', 1)} as p999_robust_z from nz"),
    "a16_surge_interval": (NETWORK_Z, f"""select server_id, {r("max(network_rx_bytes) / avg(network_rx_bytes)", 1)} as peak_to_avg_rx, min("timestamp") filter (z > 6) as surge_start,
        max("timestamp") filter (z > 6) as surge_end, count(*) filter (z > 6) as intervals, 5 * count(*) filter (z > 6) as minutes
        from nz group by server_id order by peak_to_avg_rx desc, server_id limit 1"""),
    "a17_correlation_fleet": (SILVER, f"select {r('corr(cpu_usage_percent, response_time_ms)', 3)} as pearson_r from v"),
    "a17_correlation_by_server": (SILVER, f"select server_id, {r('corr(cpu_usage_percent, response_time_ms)', 3)} as pearson_r from v group by server_id"),
    "a18_cpu_experiment": (SILVER, f"""select server_id, {r("avg(response_time_ms) filter (cpu_usage_percent > 90)", 1)} as mean_above, {r("avg(response_time_ms) filter (cpu_usage_percent <= 90)", 1)} as mean_otherwise
        from v group by server_id order by max(cpu_usage_percent) desc, server_id limit 1"""),
    "a18_latency_experiment": (SILVER, f"""select server_id, {r("avg(cpu_usage_percent) filter (response_time_ms > 500)", 1)} as mean_above, {r("avg(cpu_usage_percent) filter (response_time_ms <= 500)", 1)} as mean_otherwise
        from v group by server_id order by max(response_time_ms) desc, server_id limit 1"""),
    "a19_rule_vs_truth": (SILVER, f"""select *, {r("100 * caught / nullif(cast(injected_truth as double), 0)", 1)} as recall_pct from (
        select server_id, count(*) filter ({_RULE}) as rule_flagged, count(*) filter (is_injected_anomaly = 1) as injected_truth,
        count(*) filter ({_RULE} and is_injected_anomaly = 1) as caught, count(*) filter ({_RULE} and is_injected_anomaly <> 1) as false_positives
        from v group by server_id) order by injected_truth desc, server_id"""),
    "a20_rule_totals": (SILVER, f"""select tp, fp, fn, {r("tp / nullif(cast(tp + fp as double), 0)", 3)} as precision, {r("tp / nullif(cast(tp + fn as double), 0)", 3)} as recall from (
        select count(*) filter ({_RULE} and is_injected_anomaly = 1) as tp, count(*) filter ({_RULE} and is_injected_anomaly <> 1) as fp,
        count(*) filter (not ({_RULE}) and is_injected_anomaly = 1) as fn from v)"""),
    "a21_status_counts": (SILVER, "select status, count(*) as n from v group by status order by n desc, status"),
    "a22_hourly_profile": (SILVER, f"""select cast(hour as int) as hour, {", ".join(f"{r(f'avg({c})', 2)} as {c}" for c in ("cpu_usage_percent", "network_rx_bytes", "response_time_ms", "application_error_count"))}
        from {_NORMAL} group by hour order by hour"""),
    "a23_hour_extremes": (SILVER, f"""select cast(first(hour order by cpu desc, hour) as int) as peak_hour, {r("max(cpu)", 1)} as peak_cpu, cast(first(hour order by cpu, hour) as int) as trough_hour,
        {r("min(cpu)", 1)} as trough_cpu, {r("max(cpu) / min(cpu)", 2)} as swing from (select hour, avg(cpu_usage_percent) as cpu from {_NORMAL} group by hour)"""),
    "a24_business_hours": (SILVER, f"""select {r("b", 1)} as business_cpu, {r("o", 1)} as off_hours_cpu, {r("b / o", 2)} as ratio from (
        select avg(cpu_usage_percent) filter (hour between 9 and 18) as b, avg(cpu_usage_percent) filter (not hour between 9 and 18) as o from {_NORMAL})"""),
    "a25_weekday_profile": (SILVER, f"select dayname(\"timestamp\") as weekday, {r('avg(cpu_usage_percent)', 2)} as avg_cpu from {_NORMAL} group by 1 order by 1"),
    "a25_weekday_spread": (SILVER, f"select {r('max(m) - min(m)', 2)} as spread from (select avg(cpu_usage_percent) as m from {_NORMAL} group by dayname(\"timestamp\"))"),
    "a26_server_hour_matrix": (SILVER, "select server_id, " + ", ".join(f"{r(f'avg(cpu_usage_percent) filter (hour = {h})', 2)} as h{h:02d}" for h in range(24)) + f" from {_NORMAL} group by server_id order by server_id"),
    "a27_completeness": (SILVER, """select actual_rows, servers, servers * 288 * 30 as expected_rows, servers * 288 * 30 - actual_rows as missing_rows
        from (select count(*) as actual_rows, count(distinct server_id) as servers from v)"""),
    "a28_null_counts": (READINGS, " union all ".join(
        f"select '{c}' as column_name, count(*) filter (\"{c}\" is null) as missing from readings"
        for c in ("server_id", "hostname", "timestamp", "cpu_usage_percent", "memory_usage_percent", "disk_usage_percent", "disk_io_read", "disk_io_write",
                  "network_rx_bytes", "network_tx_bytes", "application_error_count", "response_time_ms", "is_injected_anomaly", "status", "dt"))),
    "a29_gap_histogram": (SILVER, """select g / 1e6 as gap_seconds, count(*) as n from (
        select epoch_us("timestamp") - lag(epoch_us("timestamp")) over (partition by server_id order by "timestamp") as g from v) where g is not null group by g"""),
    "a30_time_bounds": (SILVER, 'select min("timestamp") as first_timestamp, max("timestamp") as last_timestamp from v'),
    "a31_evaluate_detector": (HALF_FLAGGED, f"{_evaluation('is_anomaly = 1')} from hf)"),
    "a32_evaluate_rules": (SILVER, f"{_evaluation(_RULE)} from v)"),
    "a33_evaluate_by_server": (SCORED, f"""select *, {r("100 * model_tp / nullif(cast(injected_truth as double), 0)", 1)} as model_recall_pct from (
        select server_id, count(*) filter (is_injected_anomaly = 1) as injected_truth, count(*) filter (is_anomaly = 1) as model_flagged,
        count(*) filter (is_anomaly = 1 and is_injected_anomaly = 1) as model_tp, count(*) filter ({_RULE}) as rule_flagged
        from scored group by server_id) order by server_id"""),
    "a34_false_positives_by_hour": (HALF_FLAGGED, """select cast(hour("timestamp" + interval '8 hours') as int) as hour, count(*) as n from hf
        where is_anomaly = 1 and is_injected_anomaly <> 1 group by 1 order by 1"""),
    "a35_flag_rate": (SCORED, f"select count(*) filter (is_anomaly = 1) as flagged, count(*) as readings, {r('100 * avg(is_anomaly)', 2)} as flagged_percent from scored"),
    "a36_fleet_kpis": (f"""{EVENTS},
{gold('v')}""", """select count(*) as servers, count(*) filter (health_score >= 85) as healthy, count(*) filter (health_score < 60) as critical_servers,
        count(distinct server_id) filter (health_score < 85) as servers_with_alerts, count(*) filter (health_score < 85) as alerts,
        (select count(*) from finished) as detected_anomalies from summary"""),
    "a37_fleet_utilisation": (SUMMARY, " union all ".join(
        f"select '{c}' as metric, server_id, {c} as value, {r(f'avg({c}) over ()', 1)} as fleet_avg from summary"
        for c in ("avg_cpu_percent", "avg_memory_percent", "avg_disk_percent", "avg_response_time_ms"))),
    "a38_severity_counts": (EVENTS, "select severity, count(*) as n from finished group by severity"),
    "a39_incidents_per_server": (EVENTS, "select server_id, count(*) as n from finished group by server_id"),
    "a40_truth_counts": (SILVER, "select server_id, count(*) filter (is_injected_anomaly = 1) as injected_truth from v group by server_id"),
    "w01_gaps": (SILVER, """select event_id, server_id, "timestamp",
        epoch_us("timestamp") - lag(epoch_us("timestamp")) over (partition by server_id order by "timestamp") as gap_micros from v"""),
    "w02_sessions": (SILVER, """select event_id, server_id, "timestamp", cast(sum(case when g is null or g > interval '30 minutes' then 1 else 0 end)
        over (partition by server_id order by "timestamp") as bigint) as session
        from (select *, "timestamp" - lag("timestamp") over (partition by server_id order by "timestamp") as g from v)"""),
    "w03_rolling_slopes": (SLOPES, "select event_id, mem_slope_24h, disk_slope_24h from featured"),
    "w04_worst_slopes": (f"""{SLOPES},
full_windows as (
  select server_id, rn, regr_slope(memory_usage_percent, rn) over w * 288e0 as m, regr_slope(disk_usage_percent, rn) over w * 288e0 as d from numbered
  window w as (partition by server_id order by "timestamp" rows between 287 preceding and current row))""",
        f"""select server_id, {r("max(m) filter (rn >= 288)", 3)} as mem_slope_24h, {r("max(d) filter (rn >= 288)", 3)} as disk_slope_24h from full_windows group by server_id"""),
    "w05_severity": (SILVER, """select *, case when row_number() over (order by peak_score desc, server_id, "timestamp") <= greatest(1, (count(*) over ()) // 3)
        then 'CRITICAL' else 'WARNING' end as severity
        from (select server_id, cast(dt as timestamp) as "timestamp", max(response_time_ms) as peak_score from v group by server_id, dt)"""),
    "w06_dedup_rank": (SILVER, 'select event_id, server_id, cast(row_number() over (partition by server_id, "timestamp" order by event_id) as int) as copy_rank from canon'),
    "t01_top_by_anomalies": (SUMMARY, "select server_id, hostname, anomaly_count from summary order by anomaly_count desc, server_id, hostname limit 20"),
    "t02_top_scores": (SCORED, 'select "timestamp", server_id, anomaly_score from scored order by anomaly_score desc, server_id, "timestamp" limit 10'),
    "t03_first_results": (HALF_FLAGGED, """select "timestamp", server_id, case when is_anomaly = 1 then 'ANOMALY' else 'NORMAL' end as result
        from hf order by "timestamp", server_id limit 10"""),
    "t04_latest": (EVENTS, 'select "timestamp", server_id, metric from finished order by "timestamp" desc, server_id'),
    "t05_worst_health": (SUMMARY, "select server_id, health_score from summary order by health_score, server_id"),
    "t06_worst_server": (SUMMARY, "select server_id, peak_cpu_percent, total_readings from summary_base order by peak_cpu_percent desc, server_id limit 1"),
    "t07_series_order": (SILVER, 'select server_id, "timestamp", event_id from v order by server_id, "timestamp"'),
    "t08_sample_rows": (SILVER, """select event_id, cpu_usage_percent, response_time_ms from v
        order by md5(concat('42|', server_id, '|', epoch_us("timestamp"))), server_id, "timestamp" limit 4000"""),
    "u01_concat": (SILVER, "select event_id, server_id from v union all select event_id, server_id from rejects"),
    "u02_reload": (RUNS, "select * from early union all select * from late"),
    "m01_features": (SLOPES, f"""select event_id, {", ".join(f for f in FEATURES if f != "error_count_log")}, {r("error_count_log", 6)} as error_count_log from featured"""),
    "m02_scalers": (SCALED, f"select server_id, feature, {r('median', 5)} as median, {r('scale', 5)} as scale from scalers"),
    "m03_z_scores": (SCALED, "select event_id, " + ", ".join(f"{r(f'z_{f}', 4)} as z_{f}" for f in FEATURES) + " from z"),
    "m06_flags": (SCORED, "select event_id, score, anomaly_score, is_anomaly, result from scored"),
    "m07_incidents": (EVENTS, 'select server_id, "timestamp", peak_timestamp, metric, value, peak_score, readings, duration_minutes, detection_method from incidents'),
    "m08_dominant_feature": (SCORED, f"select event_id, dominant_feature, metric, {r('value', 4)} as value from scored where is_anomaly = 1"),
    "m09_finished_events": (EVENTS, "select * from finished"),
    "m10_winsorised": (SCALED, "select event_id, " + ", ".join(f"{r(f'greatest(-8e0, least(8e0, z_{f}))', 4)} as z_{f}" for f in FEATURES) + " from z"),
    "m11_hour_features": (SILVER, f"""select event_id, {r('sin(hour("timestamp") * 2e0 * pi() / 24e0)', 5)} as hour_sin,
        {r('cos(hour("timestamp") * 2e0 * pi() / 24e0)', 5)} as hour_cos from v"""),
    "x01_stream_bronze": (READINGS, "select dt, count(*) as n, count(*) as with_lineage from readings group by dt"),
    "x02_stream_silver": (SILVER, """select event_id, server_id, "timestamp", coalesce(_reject_reason, '') as reason from classified"""),
    "x03_stream_events": (EVENTS, 'select server_id, "timestamp", peak_timestamp, metric, value, peak_score, readings, duration_minutes, detection_method from incidents'),
    "x04_step_alerts": (ALERT_STEPS, "select * from al4"),
}


# The same rows by another way of getting there.
_PARTS |= {
    name: _PARTS[other]
    for name, other in {
        "s07_compact": "u02_reload",
        "u02_two_writers": "u02_reload",
        "j08_upsert_buckets": "j08_upsert",
        "w02_sessions_continued": "w02_sessions",
        "m07_incidents_continued": "m07_incidents",
        "x02_compact_silver": "x02_stream_silver",
        "x02_stream_gold": "a05_daily_metrics",
        "x02_stream_summary": "a04_server_summary",
        "x04_stream_alerts": "x04_step_alerts",
        "s11_model_scalers": "m02_scalers",
    }.items()
}
_PARTS |= {
    "w03_slopes_continued": (SLOPES, """select event_id, mem_slope_24h, disk_slope_24h from featured
        where "timestamp" >= timestamp '2024-01-24 00:00:00'"""),
    "p17_around_incidents": (EVENTS, """select i.lo as "incident_timestamp", event_id, s.server_id, s."timestamp", score
        from scored s join (select server_id, min("timestamp") as lo, max("timestamp") as hi from ranked group by server_id, run) i
        on s.server_id = i.server_id and s."timestamp" between lo - interval '60 minutes' and hi + interval '60 minutes'"""),
    "p05_split_tables": (SILVER, "select event_id, server_id, dt, coalesce(_reject_reason, '') as reason from classified"),
    "m02_scalers_sketch": (SCALED, """select server_id, feature, count(x) as readings, true as median_within, true as mad_within
        from long group by server_id, feature having count(x) > 0"""),
}


def sql() -> dict[str, str]:
    """The complete statements."""
    return {n: f"with {ctes}\n{final}" if ctes else final for n, (ctes, final) in _PARTS.items()}
