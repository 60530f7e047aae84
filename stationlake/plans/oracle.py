"""DuckDB oracle SQL for every registered query.

Each statement rebuilds the same inputs from the driver's tables (FIXTURES.md §3 adapter) and
states the reference's semantics in plain SQL: computed floats rounded with
``cast(round(cast(x as decimal(38,10)), n) as double)``, float literals written with ``E0``.
"""

from __future__ import annotations

from stationlake.schemas import (
    MEASURES, PARAMETER_LABELS, QUALITY_RULES, RATING_FLOOR, RATING_LEVELS, RATING_MARK_DEFAULT, RATING_MARKS,
)

MEASURE_LIST = ", ".join(MEASURES)
RAW_LIST = f"timestamp, station_id, location, latitude, longitude, {MEASURE_LIST}, ingestion_time"
TIE_BREAK = ", ".join(f"{c} desc nulls last" for c in
                      ["timestamp", "ingestion_time", "location", "latitude", "longitude", *MEASURES])


def rnd(x: str, n: int) -> str:
    return f"cast(round(cast({x} as decimal(38,10)), {n}) as double)"


# FIXTURES.md §3 adapter (DuckDB spelling of k).
BASE_CTE = """
b as (
  select user_id as station_id, ts as timestamp, k, event_type, value,
    concat('Station ', cast(user_id as varchar(20))) as location,
    60.0E0 + user_id % 10 as latitude, 20.0E0 + user_id % 11 as longitude,
    case when k % 10 = 0 then null when k = 51 then -60.0E0 else value / 4 - 30 end as temperature,
    case when k % 7 = 0 then null else k * 1.1E0 - 3 end as humidity,
    case when event_type = 'signup' then null when k = 33 then -1.0E0 else value / 6 end as wind_speed,
    k * 3.6E0 as wind_direction,
    case when event_type = 'error' then null else 880.0E0 + k * 2.4E0 end as pressure,
    case when event_type = 'view' then value / 100 end as precipitation,
    cast(k % 9 as double) as cloud_cover, 500.0E0 * k as visibility
  from (select *, cast(json_extract(props, '$.k') as int) as k from events) e
)"""

RAW_CTE = BASE_CTE + f""",
p as (
  select *, timestamp + interval 1 minute as ingestion_time from b
  union all select *, timestamp + interval 11 minute as ingestion_time from b where k % 5 = 0
  union all select *, timestamp + interval 1 minute as ingestion_time from b where k % 13 = 0
),
raw as (select {RAW_LIST} from p)"""

_FLAGS = ",\n    ".join(
    f"case when {m} is null then 'MISSING' when {m} < {lo}E0 or {m} > {hi}E0 then 'OUTLIER' "
    f"else 'VALID' end as {m}_quality" for m, lo, hi in QUALITY_RULES)
_SCORE = " + ".join(f"cast({m} is not null as int)" for m, _, _ in QUALITY_RULES) 
FLAGS_SQL = f"{_FLAGS},\n    ({_SCORE}) / 4.0E0 as data_completeness_score"

def curated_ctes(source: str = "raw") -> str:
    """distinct → hourly pick → flags, reading the CTE named ``source``."""
    return f""",
dedup as (select distinct {RAW_LIST} from {source}),
hourly as (
  select {RAW_LIST} from (
    select *, row_number() over (partition by station_id, date_trunc('hour', timestamp) order by {TIE_BREAK}) as rn
    from dedup) x
  where rn = 1
),
daily as (select *,
    {FLAGS_SQL}
  from hourly)"""


DAILY_CTE = RAW_CTE + curated_ctes()

SUMMARY_SELECT = f"""
  select station_id, location, latitude, longitude, cast(timestamp as date) as observation_date,
    count(temperature) as temperature_count,
    {rnd('avg(temperature)', 2)} as avg_temperature,
    {rnd('min(temperature)', 2)} as min_temperature,
    {rnd('max(temperature)', 2)} as max_temperature,
    {rnd('stddev_samp(temperature)', 2)} as stddev_temperature,
    count(humidity) as humidity_count,
    {rnd('avg(humidity)', 2)} as avg_humidity,
    {rnd('min(humidity)', 2)} as min_humidity,
    {rnd('max(humidity)', 2)} as max_humidity,
    count(wind_speed) as wind_count,
    {rnd('avg(wind_speed)', 2)} as avg_wind_speed,
    {rnd('max(wind_speed)', 2)} as max_wind_speed,
    {rnd('avg(pressure)', 2)} as avg_pressure,
    {rnd('min(pressure)', 2)} as min_pressure,
    {rnd('max(pressure)', 2)} as max_pressure,
    {rnd('sum(coalesce(precipitation, 0.0E0))', 2)} as total_precipitation,
    count(*) as total_observations,
    {rnd('avg(data_completeness_score)', 3)} as avg_completeness_score,
    count(case when temperature_quality = 'OUTLIER' then 1 end) as temperature_outliers,
    count(case when humidity_quality = 'OUTLIER' then 1 end) as humidity_outliers
  from daily
  group by station_id, location, latitude, longitude, cast(timestamp as date)"""

SUMMARY_CTE = DAILY_CTE + f""",
summary as ({SUMMARY_SELECT})"""


def _rating(col: str) -> str:
    whens = " ".join(f"when {col} >= {t}E0 then '{label}'" for t, label in RATING_LEVELS)
    return f"case {whens} else '{RATING_FLOOR}' end"


def _mark(col: str) -> str:
    whens = " ".join(f"when '{label}' then '{mark}'" for label, mark in RATING_MARKS.items())
    return f"case {col} {whens} else '{RATING_MARK_DEFAULT}' end"


_Q = [m for m, _, _ in QUALITY_RULES]
REPORT_CTE = DAILY_CTE + """,
qm as (
  select cast(timestamp as date) as report_date,
    count(distinct station_id) as active_stations,
    count(*) as total_observations,
    """ + ",\n    ".join(
    [f"count(case when {m} is null then 1 end) as missing_{m}" for m in _Q]
    + [f"count(case when {m}_quality = 'OUTLIER' then 1 end) as outlier_{m}" for m in _Q]
    + [f"{rnd(f'count(case when {m}_quality = ' + chr(39) + 'VALID' + chr(39) + ' then 1 end) * 100.0E0 / count(*)', 2)} as {m}_valid_pct" for m in _Q]
    + [f"{rnd('avg(data_completeness_score)', 3)} as avg_completeness_score"]) + f"""
  from daily
  group by cast(timestamp as date)
),
report as (select *, {_rating('avg_completeness_score')} as overall_quality_rating from qm)"""

DAILY_OUT = f"{RAW_LIST}, " + ", ".join(f"{m}_quality" for m in _Q) + ", data_completeness_score"



LATEST_CTE = f""",
latest as (
  select station_id, location, latitude, longitude, temperature, humidity, wind_speed, pressure, timestamp,
    cast(timestamp as date) as observation_date
  from (select *, row_number() over (partition by station_id, cast(timestamp as date) order by {TIE_BREAK}) as rn
        from raw) x
  where rn = 1
)"""

HIST_COLS = ("station_id, timestamp, temperature, humidity, wind_speed, wind_direction, pressure, precipitation, "
             "cloud_cover, visibility, data_completeness_score")
HISTORY_CTE = f""",
hist_old as (
  select {HIST_COLS}, cast(cast(timestamp as date) as timestamp) + interval 25 hour as processing_time,
    cast(timestamp as date) as observation_date
  from daily
),
hist_new as (
  select {HIST_COLS}, timestamp '2024-02-01 01:00:00' as processing_time, cast(timestamp as date) as observation_date
  from daily where cast(timestamp as date) between date '2024-01-16' and date '2024-01-30'
)"""

_HIST_ORDER = ", ".join(f"{c} desc nulls last" for c in ["processing_time", "timestamp", *MEASURES, "data_completeness_score"])

TREND_CTE = HISTORY_CTE + """,
trend as (
  select station_id, timestamp, temperature, humidity, wind_speed, pressure, data_completeness_score
  from hist_old where timestamp between timestamp '2024-01-11 12:00:00' and timestamp '2024-01-25 12:00:00'
)"""

CATALOG_CTE = """,
cat as (
  select cast(s_suppkey * 2 as bigint) as station_id, s_name as station_name,
    case when s_nationkey % 5 = 1 then '2019' when s_nationkey % 5 = 2 then '2020'
         when s_nationkey % 5 = 3 then 'x' end as finish,
    cast(s_suppkey as bigint) as catalog_order
  from supplier
  union all
  select cast(n_nationkey * 2 as bigint), n_name, null, 1000000000000 + n_nationkey from nation
),
active as (select * from cat where finish is null or trim(finish) = '' or try_cast(finish as double) >= 2020),
lookup as (
  select station_id, station_name from (
    select *, row_number() over (partition by station_id order by catalog_order) as rn from active) x
  where rn = 1
)"""


def _top10(value: str, direction: str) -> str:
    return (f"with {SUMMARY_CTE}\nselect observation_date, rank, station_id, location, {value} from (\n"
            f"  select *, cast(row_number() over (partition by observation_date order by {value} {direction} nulls last,"
            f" station_id, location, latitude, longitude) as integer) as rank from summary) x\nwhere rank <= 10")


_LABELS = list(PARAMETER_LABELS.items())


def _long(prefix: str, value: str) -> str:
    parts = "\nunion all ".join(f"select report_date, '{label}' as parameter, {prefix}_{m} as {value} from report"
                                 for m, label in _LABELS)
    return f"with {REPORT_CTE}\n{parts}"


def _range(start: str, end: str) -> str:
    return f"cast(timestamp as date) between date '{start}' and date '{end}'"


# earliest delivery first, then every other column (Spark orders structs field by field, nulls first)
FIRST_ORDER = ", ".join(f"{c} asc nulls first" for c in
                        ["ingestion_time", "timestamp", "location", "latitude", "longitude", *MEASURES])
RAWK_CTE = RAW_CTE + f""",
rawk as (select {RAW_LIST}, k from p)"""

_REJECTED = "7, 17, 27, 37, 47, 57, 61, 62, 63, 64"
_ACCEPT = ("case when k = 77 then date_trunc('second', timestamp) else timestamp end as timestamp, station_id, "
           "location, latitude, longitude, case when k = 67 then null else temperature end as temperature, humidity, "
           "wind_speed, wind_direction, pressure, precipitation, cloud_cover, visibility, ingestion_time")


def _payload_line(back_minutes: int, latest_only: bool = False) -> str:
    short = {m: f"case when k = 8 then null else {m} end as {m}" for m in ("precipitation", "cloud_cover", "visibility")}
    vals = ", ".join(short.get(m, m) for m in MEASURES)
    # k = 11: no line at all unless only the newest is read; k = 9 loses its second line, k = 12 its last
    bad = "3, 4" + ("" if latest_only else ", 11") + {0: ", 12", 10: ", 9"}.get(back_minutes, "")
    return (f"select station_id, latitude, longitude, date_trunc('second', timestamp) - interval {back_minutes} minute "
            f"as timestamp, {vals} from b where k not in ({bad})")


def _text(x: str, unit: str) -> str:
    return f"printf('%.1f{unit}', {rnd(x, 1)})"


def _outcomes(name: str) -> str:
    return (f"select c.p as {name}, (select count(*) from lookup) as polled, count(distinct s.station_id) as succeeded, "
            f"(select count(*) from lookup) - count(distinct s.station_id) as failed from calendar c left join "
            f"(select * from seen where station_id in (select station_id from lookup)) s on c.p = s.p group by c.p")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["observations_distinct"] = f"with {RAW_CTE}\nselect distinct {RAW_LIST} from raw"
    q["latest_per_station_hour"] = f"with {DAILY_CTE}\nselect {RAW_LIST} from hourly"
    q["quality_flags"] = (f"with {RAW_CTE}\nselect station_id, timestamp, ingestion_time,\n    {FLAGS_SQL}\n"
                          f"from raw")
    q["daily_observations"] = f"with {DAILY_CTE}\nselect {DAILY_OUT} from daily"
    q["daily_observations_day"] = (f"with {DAILY_CTE}\nselect {DAILY_OUT} from daily "
                                   f"where cast(timestamp as date) = date '2024-01-15'")
    q["daily_summary"] = f"with {SUMMARY_CTE}\nselect * from summary"
    q["quality_report"] = f"with {REPORT_CTE}\nselect * from report"
    q["quality_rating_by_station_day"] = (
        f"with {SUMMARY_CTE}\nselect station_id, location, latitude, longitude, observation_date, "
        f"avg_completeness_score, {_rating('avg_completeness_score')} as quality_rating from summary")
    q["latest_by_station"] = f"with {RAW_CTE}{LATEST_CTE}\nselect * from latest"
    q["overview_kpis"] = (
        f"with {RAW_CTE}{LATEST_CTE}\nselect observation_date, count(*) as active_stations, "
        f"{rnd('avg(temperature)', 2)} as avg_temperature, {rnd('avg(humidity)', 2)} as avg_humidity, "
        f"{rnd('max(wind_speed)', 2)} as max_wind_speed from latest group by observation_date")
    q["map_points"] = (
        f"with {RAW_CTE}{LATEST_CTE}\nselect observation_date, station_id, location, latitude, longitude, "
        f"temperature, humidity, wind_speed, pressure, coalesce(wind_speed, 0.0E0) as wind_speed_display, "
        f"greatest(coalesce(wind_speed, 0.0E0), 1.0E0) as marker_size from latest")
    q["hottest_10"] = _top10("max_temperature", "desc")
    q["coldest_10"] = _top10("min_temperature", "asc")
    q["daily_kpis"] = (
        f"with {SUMMARY_CTE}\nselect observation_date, count(*) as stations_reporting, "
        f"cast(sum(total_observations) as bigint) as total_observations, "
        f"{rnd('avg(avg_completeness_score)', 4)} as avg_data_quality from summary group by observation_date")
    q["station_trend_14d"] = f"with {DAILY_CTE}{TREND_CTE}\nselect * from trend"
    q["trend_kpis"] = (
        f"with {DAILY_CTE}{TREND_CTE}\nselect station_id, {rnd('avg(temperature)', 2)} as avg_temperature, "
        f"{rnd('min(temperature)', 2)} as min_temperature, {rnd('max(temperature)', 2)} as max_temperature, "
        f"{rnd('avg(humidity)', 2)} as avg_humidity, count(*) as data_points from trend group by station_id")
    q["trend_series_long"] = (
        f"with {DAILY_CTE}{TREND_CTE}\nselect station_id, timestamp, 'temperature' as series, temperature as value "
        f"from trend\nunion all select station_id, timestamp, 'humidity', humidity from trend")
    q["missing_long"] = _long("missing", "missing_count")
    q["outlier_long"] = _long("outlier", "outlier_count")
    q["rating_view"] = (
        f"with {REPORT_CTE}\nselect report_date, overall_quality_rating, {_mark('overall_quality_rating')} "
        f"as rating_mark, active_stations, total_observations, temperature_valid_pct, humidity_valid_pct, "
        f"wind_speed_valid_pct, pressure_valid_pct from report")
    q["history_union_distinct"] = (f"with {DAILY_CTE}{HISTORY_CTE}\n"
                                   f"select * from hist_old union select * from hist_new")
    q["history_upsert"] = (
        f"with {DAILY_CTE}{HISTORY_CTE},\nu as (select * from hist_old union all select * from hist_new)\n"
        f"select * exclude (rn) from (select *, row_number() over (partition by station_id, "
        f"date_trunc('hour', timestamp) order by {_HIST_ORDER}) as rn from u) x where rn = 1")
    q["station_daily_range"] = (
        f"with {DAILY_CTE}\nselect station_id, cast(timestamp as date) as observation_date, "
        f"{rnd('min(temperature)', 2)} as min_temperature, {rnd('avg(temperature)', 2)} as avg_temperature, "
        f"{rnd('max(temperature)', 2)} as max_temperature from daily where {_range('2024-01-05', '2024-01-25')} "
        f"group by station_id, cast(timestamp as date)")
    q["temp_humidity_corr"] = (
        f"with {DAILY_CTE}\nselect station_id, count(case when temperature is not null and humidity is not null "
        f"then 1 end) as pairs, {rnd('corr(temperature, humidity)', 4)} as temp_humidity_corr "
        f"from daily group by station_id")
    q["station_comparison"] = (
        f"with {DAILY_CTE}\nselect station_id, location, {rnd('avg(temperature)', 2)} as avg_temperature, "
        f"{rnd('avg(humidity)', 2)} as avg_humidity, {rnd('avg(wind_speed)', 2)} as avg_wind_speed "
        f"from daily group by station_id, location")
    q["temperature_trend"] = (
        f"with {DAILY_CTE}\nselect cast(timestamp as date) as observation_date, "
        f"{rnd('avg(temperature)', 2)} as avg_temperature, count(distinct station_id) as stations "
        f"from daily group by cast(timestamp as date)")
    q["station_completeness"] = (
        f"with {DAILY_CTE}\nselect station_id, count(*) as observations, "
        f"{rnd('avg(data_completeness_score)', 4)} as avg_completeness_score from daily group by station_id")
    q["geo_distribution"] = (
        f"with {DAILY_CTE}\nselect station_id, location, latitude, longitude, "
        f"{rnd('avg(temperature)', 2)} as avg_temperature, {rnd('avg(wind_speed)', 2)} as avg_wind_speed, "
        f"count(*) as observations from daily group by station_id, location, latitude, longitude")
    q["station_name_lookup"] = (
        f"with {RAW_CTE}{CATALOG_CTE}\nselect r.station_id, r.timestamp, r.ingestion_time, l.station_name as location "
        f"from raw r left join lookup l on r.station_id = l.station_id")
    q["catalog_csv_lookup"] = f"with {RAW_CTE}{CATALOG_CTE}\nselect station_id, station_name from lookup"
    q["silent_stations"] = (
        f"with {RAW_CTE}{CATALOG_CTE}\nselect station_id, station_name from lookup "
        f"where station_id not in (select station_id from raw)")
    q["poll_outcome_counts"] = (
        f"with {RAW_CTE}{CATALOG_CTE},\nseen as (select cast(timestamp as date) as p, station_id from raw),\n"
        f"calendar as (select cast(unnest(generate_series((select min(p) from seen), (select max(p) from seen), interval 1 day)) as date) as p)\n"
        + _outcomes("observation_date"))
    q["poll_cycle_outcomes"] = (
        f"with {RAW_CTE}{CATALOG_CTE},\nseen as (select time_bucket(interval 10 minute, ingestion_time) as p, station_id from raw),\n"
        f"calendar as (select unnest(generate_series((select min(p) from seen), (select max(p) from seen), interval 10 minute)) as p)\n"
        + _outcomes("cycle_start"))
    q["cleanse_accept"] = f"with {RAWK_CTE}\nselect {_ACCEPT} from rawk where k not in ({_REJECTED})"
    q["cleanse_reject_counts"] = (
        f"with {RAWK_CTE}\nselect reject_reason, count(*) as rejected from (select case k when 7 then "
        f"'missing_required' when 17 then 'blank_timestamp' when 27 then 'bad_timestamp' when 37 then "
        f"'bad_station_id' when 63 then 'bad_station_id' when 47 then 'bad_ingestion_time' when 64 then "
        f"'blank_ingestion_time' when 57 then 'malformed_json' when 61 then 'malformed_json' "
        f"when 62 then 'malformed_json' end as reject_reason "
        f"from rawk) x where reject_reason is not null group by reject_reason")
    q["json_roundtrip"] = f"with {RAW_CTE}\nselect {RAW_LIST} from raw"
    q["payload_decode"] = (f"with {BASE_CTE}\n{_payload_line(20)}\nunion all {_payload_line(10)}\n"
                           f"union all {_payload_line(0)}")
    q["payload_latest"] = f"with {BASE_CTE}\n{_payload_line(0, True)}"
    q["daily_observations_exact"] = q["daily_observations"]
    q["producer_records"] = (
        f"with {BASE_CTE}{CATALOG_CTE},\npl as ({_payload_line(0, True)})\n"
        f"select pl.station_id, {', '.join('pl.' + c for c in ['latitude', 'longitude', 'timestamp', *MEASURES])}, "
        f"l.station_name as location from pl left join lookup l on pl.station_id = l.station_id")
    q["payload_reject_counts"] = (
        f"with {BASE_CTE}\nselect case k when 3 then 'missing_values' when 4 then 'malformed_xml' when 9 then 'empty_values' "
        f"when 11 then 'line_count_mismatch' else 'bad_position' end as reject_reason, "
        f"count(*) as rejected from b where k in (3, 4, 9, 11, 12) group by 1")
    acc = f"with {RAWK_CTE},\nacc as (select {_ACCEPT} from rawk where k not in ({_REJECTED}))"
    q["stream_landed_rows"] = f"{acc}\nselect {RAW_LIST} from acc"
    q["stream_quarantine_counts"] = q["cleanse_reject_counts"]
    q["stream_hourly_latest"] = (
        f"{acc},\nh as (select {RAW_LIST} from (select *, row_number() over (partition by station_id, "
        f"date_trunc('hour', timestamp) order by {TIE_BREAK}) as rn from acc) x where rn = 1)\nselect * from h")
    q["stream_curated"] = (
        f"{acc},\nh as (select {RAW_LIST} from (select *, row_number() over (partition by station_id, "
        f"date_trunc('hour', timestamp) order by {TIE_BREAK}) as rn from acc) x where rn = 1)\n"
        f"select {RAW_LIST},\n    {FLAGS_SQL}\nfrom h")
    q["stream_curated_day"] = f"select * from ({q['stream_curated']}) where cast(timestamp as date) = date '2024-01-15'"
    q["stream_dedup"] = (
        f"{acc}\nselect {RAW_LIST} from (select *, row_number() over (partition by station_id, timestamp "
        f"order by {FIRST_ORDER}) as rn from acc) x where rn = 1")
    q["stream_quality_flags"] = (f"{acc}\nselect station_id, timestamp, ingestion_time,\n    {FLAGS_SQL}\n"
                                 f"from acc")
    q["stream_two_sources"] = q["stream_landed_rows"]
    q["stream_extra_fields"] = (f"with {RAWK_CTE}\nselect station_id, timestamp, ingestion_time, 'extra_field' as field, "
                                f"'1' as text from rawk where k = 87")
    q["stream_typed_fields"] = (f"with {RAWK_CTE}\nselect station_id, timestamp, ingestion_time, extra_field from (select {_ACCEPT}, "
                                f"case when k = 87 then cast(1 as bigint) end as extra_field from rawk where k not in ({_REJECTED}))")
    q["stream_failed_batches"] = (
        f"with {RAWK_CTE}\nselect 'failures' as what, cast(2 as bigint) as n union all select 'ended with an error', 2 "
        f"union all select 'runs', 3 union all select 'batches committed more than once', 0 "
        f"union all select 'input rows of the batches', count(*) from rawk "
        f"union all select 'rows landed', count(*) from rawk where k not in ({_REJECTED})")
    iso = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"
    records = f"{BASE_CTE}{CATALOG_CTE},\npl as ({_payload_line(0, True)})"
    q["producer_messages"] = (
        f"with {records}\nselect cast(pl.station_id as varchar) as key, cast(pl.station_id as varchar) as fmisid, "
        f"{iso.format('pl.timestamp')} as timestamp_text, '2024-02-01T00:00:00.000000' as ingestion_text, "
        f"l.station_name as location from pl left join lookup l on pl.station_id = l.station_id")
    q["payload_landed_rows"] = (
        f"with {records}\nselect pl.timestamp, pl.station_id, l.station_name as location, "
        f"{', '.join('pl.' + c for c in ['latitude', 'longitude', *MEASURES])}, timestamp '2024-02-01 00:00:00' as ingestion_time "
        f"from pl left join lookup l on pl.station_id = l.station_id")
    q["publish_landed_once"] = q["payload_landed_rows"]
    q["stream_payload_rows"] = q["payload_decode"]
    q["stream_payload_landed"] = q["payload_landed_rows"]
    q["stream_payload_reject_counts"] = q["payload_reject_counts"]
    q["stream_payload_messages"] = q["producer_messages"]
    q["stored_daily_summary"] = q["daily_summary"]
    q["stored_compacted_rows"] = f"with {RAW_CTE}\nselect {RAW_LIST} from raw"
    q["stored_read_day"] = q["daily_observations_day"]
    q["stored_missing_counts"] = (f"with {RAW_CTE}\nselect 'no table' as what, cast(0 as bigint) as n union all select 'no day', 0 "
                                  f"union all select 'table', count(*) from raw")
    q["stored_trend_from_partials"] = (
        f"with {DAILY_CTE}\nselect station_id, {rnd('avg(temperature)', 2)} as avg_temperature, "
        f"{rnd('min(temperature)', 2)} as min_temperature, {rnd('max(temperature)', 2)} as max_temperature, "
        f"{rnd('avg(humidity)', 2)} as avg_humidity, count(*) as data_points from daily "
        f"where timestamp between timestamp '2024-01-11 12:00:00' and timestamp '2024-01-25 12:00:00' group by station_id")
    q["stored_statistics_from_partials"] = (
        f"with {DAILY_CTE}\nselect station_id, count(*) as observations, {rnd('avg(temperature)', 2)} as avg_temperature, "
        f"{rnd('stddev_samp(temperature)', 4)} as stddev_temperature, {rnd('avg(wind_speed)', 2)} as avg_wind_speed, "
        f"{rnd('avg(data_completeness_score)', 4)} as avg_completeness_score, "
        f"count(case when temperature is not null and humidity is not null then 1 end) as pairs, "
        f"{rnd('corr(temperature, humidity)', 4)} as temp_humidity_corr from daily group by station_id")
    q["stored_temperature_trend_from_partials"] = q["temperature_trend"]
    of_day = "where cast(timestamp as date) = date '2024-01-15'"
    q["stored_empty_day"] = (
        f"with {DAILY_CTE},\ncounts as (select 'daily' as what, count(*) as n from daily {of_day} union all select 'history', count(*) from daily {of_day} "
        f"union all select 'summary', count(distinct station_id) from daily {of_day} union all select 'report', 1)\n"
        f"select date '2024-01-15' as observation_date, what, n as written, n as stored from counts union all "
        f"select date '2024-03-01', what, 0, 0 from counts")
    q["stored_station_history"] = (
        f"with {DAILY_CTE}\nselect station_id, timestamp, temperature, humidity, wind_speed, pressure, data_completeness_score "
        f"from daily where station_id = 5 and timestamp between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-31 00:00:00'")
    q["stored_order_checks"] = (
        f"with {DAILY_CTE}{LATEST_CTE}\nselect 'daily_observations' as what, count(*) as n, cast(0 as bigint) as inversions from daily "
        f"union all select 'station_history', count(*), 0 from daily union all select 'latest_table', count(*), 0 from latest")
    q["stored_quality_report"] = q["quality_report"]
    rerun = "cast(timestamp as date) between date '2024-01-16' and date '2024-01-30'"
    first = f"select {HIST_COLS}, timestamp '2024-01-31 01:00:00' as processing_time, cast(timestamp as date) as observation_date from daily"
    second = (f"select {HIST_COLS}, timestamp '2024-02-01 01:00:00' as processing_time, "
              f"cast(timestamp as date) as observation_date from daily where {rerun}")
    q["stored_history_upsert_rerun"] = (
        f"with {DAILY_CTE}\nselect {HIST_COLS}, case when {rerun} then timestamp '2024-02-01 01:00:00' "
        f"else timestamp '2024-01-31 01:00:00' end as processing_time, cast(timestamp as date) as observation_date "
        f"from daily")
    timely = RAWK_CTE + """,
timely as (select * from rawk where k <> 71)""" + curated_ctes("timely")
    q["stored_history_late_row"] = (
        f"select {HIST_COLS}, timestamp '2024-01-31 01:00:00' as processing_time, cast(timestamp as date) as observation_date "
        f"from (with {timely} select * from daily) where not ({rerun})\nunion all\n"
        f"select {HIST_COLS}, timestamp '2024-02-01 01:00:00', cast(timestamp as date) "
        f"from (with {DAILY_CTE} select * from daily) where {rerun}")
    per_day = lambda stopped, what, late: (
        f"select '{stopped}' as stopped, '{what}' as what, cast(timestamp as date) as observation_date, count(*) as n, "
        f"count(distinct station_id) as stations, {late} as processing_time from daily group by all")
    new = f"case when {rerun} then timestamp '2024-02-01 01:00:00' else timestamp '2024-01-31 01:00:00' end"
    q["stored_interrupted_backfill"] = f"with {DAILY_CTE}\n" + "\nunion all\n".join([
        per_day("history written", "daily_observations", new), per_day("history written", "station_history", "timestamp '2024-01-31 01:00:00'"),
        per_day("end", "daily_observations", new), per_day("end", "station_history", new)])
    q["stored_history_union_rerun"] = f"with {DAILY_CTE}\n{first}\nunion\n{second}"
    q["trend_display"] = (
        f"with {DAILY_CTE}{TREND_CTE}\nselect station_id, {_text('avg(temperature)', '°C')} as avg_temperature_text, "
        f"{_text('min(temperature)', '°C')} || ' to ' || {_text('max(temperature)', '°C')} as temperature_range_text, "
        f"{_text('avg(humidity)', '%%')} as avg_humidity_text, format('{{:,}}', count(*)) as data_points_text "
        f"from trend group by station_id")
    q["quality_display"] = (
        f"with {REPORT_CTE}\nselect report_date, {_mark('overall_quality_rating')} || ' ' || overall_quality_rating as rating_text, "
        f"cast(active_stations as varchar) as active_stations_text, format('{{:,}}', total_observations) as total_observations_text, "
        + ", ".join(f"{_text(f'{m}_valid_pct', '%%')} as {m}_valid_text" for m in PARAMETER_LABELS) + " from report")
    q["temp_humidity_pairs"] = (f"with {DAILY_CTE}\nselect station_id, timestamp, temperature, humidity from daily "
                                f"where temperature is not null and humidity is not null")
    q["wind_trend"] = (
        f"with {DAILY_CTE}\nselect cast(timestamp as date) as observation_date, {rnd('avg(wind_speed)', 2)} as avg_wind_speed, "
        f"{rnd('max(wind_speed)', 2)} as max_wind_speed, count(wind_speed) as observations from daily group by cast(timestamp as date)")
    q["latest_table"] = (f"with {RAW_CTE}{LATEST_CTE}\nselect observation_date, station_id, location, temperature, "
                         f"humidity, wind_speed, pressure, timestamp from latest order by timestamp desc, station_id")
    ov = (f"select observation_date, count(*) as active_stations, avg(temperature) as avg_temperature, "
          f"avg(humidity) as avg_humidity, max(wind_speed) as max_wind_speed from latest group by observation_date")
    q["overview_display"] = (
        f"with {RAW_CTE}{LATEST_CTE},\nov as ({ov})\nselect observation_date, strftime(observation_date, '%Y%m%d') "
        f"as date_suffix, cast(active_stations as varchar) as active_stations_text, "
        f"printf('%.1f°C', {rnd('avg_temperature', 1)}) as avg_temperature_text, "
        f"printf('%.1f%%', {rnd('avg_humidity', 1)}) as avg_humidity_text, "
        f"printf('%.1f m/s', {rnd('max_wind_speed', 1)}) as max_wind_speed_text from ov")
    dk = (f"select observation_date, count(*) as stations_reporting, cast(sum(total_observations) as bigint) "
          f"as total_observations, {rnd('avg(avg_completeness_score)', 4)} as avg_data_quality "
          f"from summary group by observation_date")
    q["daily_display"] = (
        f"with {SUMMARY_CTE},\ndk as ({dk})\nselect observation_date, strftime(observation_date, '%Y%m%d') "
        f"as date_suffix, cast(stations_reporting as varchar) as stations_reporting_text, "
        f"format('{{:,}}', total_observations) as total_observations_text, "
        f"printf('%.2f%%', {rnd('avg_data_quality * 100', 2)}) as avg_data_quality_text from dk")
    hot = RAW_CTE + f""",
raw_hot as (select {RAW_LIST.replace('station_id,', 'case when station_id % 3 = 0 then 0 else station_id end as station_id,', 1)}
  from raw)""" + curated_ctes("raw_hot")
    q["daily_summary_hot_station"] = f"with {hot},\nsummary as ({SUMMARY_SELECT})\nselect * from summary"
    return q
