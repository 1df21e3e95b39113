"""DuckDB SQL that computes each registered query from the same tables, independently of Spark.

Thresholds are stated again here, as text, so that a slip in the library's rule data shows up.
"""

from __future__ import annotations

import re

from checks.params import AS_OF, DAY, ENTRY_TTL_SECONDS, RECENT_ROWS, TTL_SECONDS
from checks.views import (
    COMPASS,
    DAILY_COUNT,
    DAY_INDEX,
    FLAT_VIEWS,
    HOURLY_COUNT,
    SEED,
    TEXTS,
)

# Upper limits and labels, and the label beyond them.
LADDERS = {
    "temp": ((0, "freezing"), (10, "cold"), (20, "cool"), (30, "warm"), "hot"),
    "wind": ((5, "light"), (15, "moderate"), (25, "strong"), "very_strong"),
    "pop": ((0.1, "low"), (0.5, "medium"), "high"),
    "Temp": ((0, "Freezing"), (10, "Cold"), (20, "Cool"), (30, "Warm"), "Hot"),
    "Wind": ((5, "Calm"), (15, "Moderate"), (25, "Strong"), "Very Strong"),
    "Pop": ((10, "Low"), (50, "Medium"), "High"),
}


def ladder(x: str, name: str) -> str:
    *steps, last = LADDERS[name]
    arms = " ".join(f"when {x} < {limit} then '{label}'" for limit, label in steps)
    return f"case {arms} else '{last}' end"


def rnd(x: str, n: int) -> str:
    return f"cast(round(cast({x} as decimal(28,12)), {n}) as double)"


def six(x: str) -> str:
    return f"cast(cast({x} as decimal(18,6)) as double)"


def clean(columns: str) -> str:
    """Plausibility rules for a comma-separated column list."""
    rules = {
        "humidity": (0, 100), "pressure": (800, 1200), "wind_deg": (0, 360), "pop": (0, 1),
    }
    out = []
    for c in columns.split(", "):
        if c == "wind_speed":
            out.append("if(wind_speed >= 0, wind_speed, null) as wind_speed")
        elif c.startswith("temp") or c == "feels_like":
            out.append(f"if({c} between -50 and 50, {c}, null) as {c}")
        elif c in rules:
            low, high = rules[c]
            out.append(f"if({c} between {low} and {high}, {c}, null) as {c}")
        else:
            out.append(c)
    return ", ".join(out)


CURRENT = (
    "location_id, timestamp, temp, feels_like, humidity, pressure, wind_speed, wind_deg, "
    "description, icon"
)
HOURLY = CURRENT + ", pop"
DAILY = (
    "location_id, date, temp_min, temp_max, temp_day, temp_night, humidity, pressure, "
    "wind_speed, wind_deg, description, icon, pop"
)
DOW = "cast(extract(dow from {}) as int) as day_of_week"

# Named sub-queries; each may use the ones above it.
PARTS = {name: re.sub(r"\{(\w+)\}", r"\1", text) for name, text in FLAT_VIEWS.items()}
PARTS |= {
    "clean_current": f"select {clean(CURRENT)} from raw_current",
    "clean_hourly": f"select {clean(HOURLY)} from raw_hourly",
    "clean_daily": f"select {clean(DAILY)} from raw_daily",
    "stg_current": f"""select *, {ladder("temp", "temp")} as temp_category,
        {ladder("wind_speed", "wind")} as wind_category
      from clean_current where timestamp is not null""",
    "stg_hourly": f"""select *, {ladder("temp", "temp")} as temp_category,
        {ladder("wind_speed", "wind")} as wind_category,
        {ladder("pop", "pop")} as precipitation_probability,
        cast(extract(hour from timestamp) as int) as hour_of_day, {DOW.format("timestamp")}
      from clean_hourly where timestamp is not null""",
    "stg_daily": f"""select *, {ladder("temp_avg", "temp")} as temp_category,
        {ladder("wind_speed", "wind")} as wind_category,
        {ladder("pop", "pop")} as precipitation_probability,
        {DOW.format("date")}, cast(extract(month from date) as int) as month,
        list_element(['winter', 'spring', 'summer', 'fall'],
          cast(extract(month from date) % 12 // 3 + 1 as int)) as season
      from (select *, (temp_max + temp_min) / 2 as temp_avg, temp_max - temp_min as temp_range
            from clean_daily where date is not null)""",
    "cur_day": """select location_id, cast(timestamp as date) as date,
        avg(temp) as avg_temp, min(temp) as min_temp, max(temp) as max_temp,
        avg(feels_like) as avg_feels_like, avg(humidity) as avg_humidity,
        avg(pressure) as avg_pressure, avg(wind_speed) as avg_wind_speed,
        count(*) as readings_count,
        mode() within group (order by description) as most_common_description,
        mode() within group (order by temp_category) as most_common_temp_category,
        mode() within group (order by wind_category) as most_common_wind_category
      from stg_current group by all""",
    "hour_day": """select location_id, cast(timestamp as date) as date,
        avg(temp) as avg_temp_hourly, min(temp) as min_temp_hourly, max(temp) as max_temp_hourly,
        avg(humidity) as avg_humidity_hourly, avg(wind_speed) as avg_wind_speed_hourly,
        avg(pop) as avg_precipitation_probability, count(*) as hourly_readings_count,
        avg(temp) filter (hour_of_day between 6 and 18) as avg_daytime_temp,
        avg(temp) filter (hour_of_day not between 6 and 18) as avg_nighttime_temp
      from stg_hourly group by all""",
    "fc_day": """select location_id, date, temp_min as forecast_temp_min,
        temp_max as forecast_temp_max, temp_day as forecast_temp_day,
        temp_night as forecast_temp_night, humidity as forecast_humidity,
        wind_speed as forecast_wind_speed, pop as forecast_precipitation_probability,
        description as forecast_description, temp_category as forecast_temp_category,
        wind_category as forecast_wind_category, season
      from stg_daily""",
    "two_way": "select * from cur_day full join hour_day using (location_id, date)",
    "days": """select *, coalesce(avg_temp, avg_temp_hourly) as final_avg_temp,
        coalesce(min_temp, min_temp_hourly, forecast_temp_min) as final_min_temp,
        coalesce(max_temp, max_temp_hourly, forecast_temp_max) as final_max_temp,
        abs(avg_temp - avg_temp_hourly) as temp_variance_current_vs_hourly,
        avg_daytime_temp - avg_nighttime_temp as day_night_temp_difference
      from two_way full join fc_day using (location_id, date)""",
    "known": "select * from days where final_avg_temp is not null",
    "rolled": """select location_id, date, final_avg_temp,
        avg(final_avg_temp) over week as t7, avg(final_avg_temp) over month as t30,
        avg(avg_humidity) over week as h7, avg(avg_wind_speed) over week as w7,
        stddev_samp(final_avg_temp) over week as vol,
        final_max_temp - final_min_temp as temp_span,
        case sign(final_avg_temp - lag(final_avg_temp) over run)
          when 1 then 'increasing' when -1 then 'decreasing' else 'stable' end as trend
      from known
      window run as (partition by location_id order by date nulls last),
        week as (partition by location_id order by date nulls last
                 rows between 6 preceding and current row),
        month as (partition by location_id order by date nulls last
                  rows between 29 preceding and current row)""",
    "ranked": """select location_id, date, season,
        avg(final_avg_temp) over s as season_avg,
        final_avg_temp - avg(final_avg_temp) over s as deviation,
        cast(rank() over (s order by final_avg_temp desc nulls last) as int) as season_rank
      from known window s as (partition by location_id, season)""",
    "patterned": """select location_id, date,
        case when avg_precipitation_probability is null then 'unknown' else
          case when final_avg_temp < 0 then 'cold_' when final_avg_temp <= 15 then 'cool_'
               when final_avg_temp <= 25 then 'mild_' else 'warm_' end
          || if(avg_precipitation_probability > 0.5, 'wet', 'dry') end as weather_pattern,
        case when final_avg_temp > 30 then 'heat_wave' when final_avg_temp < -10 then 'cold_snap'
             when avg_wind_speed > 20 then 'high_winds'
             when avg_precipitation_probability > 0.8 then 'heavy_precipitation_expected'
             else 'normal' end as extreme_weather_indicator
      from known""",
    "summary": f"""select *, {ladder("avg_wind_speed_mps", "Wind")} as business_wind_category,
        {ladder("precipitation_probability_percent", "Pop")} as business_precipitation_risk
      from (select location_id, date,
        {rnd("final_avg_temp", 1)} as avg_temperature_celsius,
        {rnd("final_min_temp", 1)} as min_temperature_celsius,
        {rnd("final_max_temp", 1)} as max_temperature_celsius,
        {rnd("avg_feels_like", 1)} as feels_like_temperature_celsius,
        {rnd("day_night_temp_difference", 1)} as day_night_temp_difference_celsius,
        {rnd("avg_humidity", 0)} as avg_humidity_percent,
        {rnd("avg_pressure", 0)} as avg_pressure_hpa,
        {rnd("avg_wind_speed", 1)} as avg_wind_speed_mps,
        {rnd("avg_wind_speed * cast(2.237 as double)", 1)} as avg_wind_speed_mph,
        {rnd("avg_precipitation_probability * 100", 1)} as precipitation_probability_percent,
        {rnd("forecast_precipitation_probability * 100", 1)}
          as forecast_precipitation_probability_percent,
        most_common_description as primary_weather_condition,
        forecast_description as forecast_weather_condition,
        most_common_temp_category as temperature_category,
        most_common_wind_category as wind_category,
        forecast_temp_category as forecast_temperature_category, forecast_wind_category, season,
        cast(extract(month from date) as int) as month_number,
        cast(extract(year from date) as int) as year,
        readings_count as current_weather_readings,
        hourly_readings_count as hourly_forecast_readings,
        {rnd("temp_variance_current_vs_hourly", 2)} as temperature_variance_current_vs_forecast,
        {ladder("final_avg_temp", "Temp")} as business_temperature_category
      from days where date is not null)""",
    # One pass: every window stays within the days of one site whose average is known.
    "windowed": """select *,
        avg(final_avg_temp) over week as t7, avg(final_avg_temp) over month as t30,
        avg(avg_humidity) over week as h7, avg(avg_wind_speed) over week as w7,
        stddev_samp(final_avg_temp) over week as vol,
        sign(final_avg_temp - lag(final_avg_temp) over run) as turn,
        avg(final_avg_temp) over s as season_avg,
        rank() over (s order by final_avg_temp desc nulls last) as season_rank
      from (select *, final_avg_temp is not null as is_known from days)
      window run as (partition by location_id, is_known order by date nulls last),
        week as (partition by location_id, is_known order by date nulls last
                 rows between 6 preceding and current row),
        month as (partition by location_id, is_known order by date nulls last
                  rows between 29 preceding and current row),
        s as (partition by location_id, season, is_known)""",
    "trends": f"""select location_id, date,
        {rnd("final_avg_temp", 1)} as avg_temperature_celsius,
        {rnd("final_min_temp", 1)} as min_temperature_celsius,
        {rnd("final_max_temp", 1)} as max_temperature_celsius,
        {rnd("avg_humidity", 0)} as avg_humidity_percent,
        {rnd("avg_wind_speed", 1)} as avg_wind_speed_mps,
        {rnd("avg_precipitation_probability * 100", 1)} as precipitation_probability_percent,
        {rnd("if(is_known, t7, null)", 1)} as temperature_7day_moving_avg,
        {rnd("if(is_known, t30, null)", 1)} as temperature_30day_moving_avg,
        {rnd("if(is_known, h7, null)", 0)} as humidity_7day_moving_avg,
        {rnd("if(is_known, w7, null)", 1)} as wind_7day_moving_avg,
        {rnd("if(is_known, final_max_temp - final_min_temp, null)", 1)} as daily_temperature_range,
        case when not is_known then null when turn > 0 then 'increasing'
             when turn < 0 then 'decreasing' else 'stable' end as temp_trend_direction,
        {rnd("if(is_known, vol, null)", 2)} as temperature_7day_volatility, season,
        {rnd("if(is_known, season_avg, null)", 1)} as seasonal_average_temperature,
        {rnd("final_avg_temp - season_avg", 1)} as temperature_deviation_from_seasonal_avg,
        cast(if(is_known, season_rank, null) as int) as temp_rank_in_season,
        case when not is_known then null when avg_precipitation_probability is null then 'unknown'
             else case when final_avg_temp < 0 then 'cold_' when final_avg_temp <= 15 then 'cool_'
                       when final_avg_temp <= 25 then 'mild_' else 'warm_' end
               || if(avg_precipitation_probability > 0.5, 'wet', 'dry') end as weather_pattern,
        case when not is_known then null when final_avg_temp > 30 then 'heat_wave'
             when final_avg_temp < -10 then 'cold_snap' when avg_wind_speed > 20 then 'high_winds'
             when avg_precipitation_probability > 0.8 then 'heavy_precipitation_expected'
             else 'normal' end as extreme_weather_indicator,
        case when is_known and final_avg_temp - season_avg > 5 then 'unusually_warm'
             when is_known and final_avg_temp - season_avg < -5 then 'unusually_cold'
             else 'seasonal_normal' end as temperature_anomaly,
        case when is_known and vol > 10 then 'high_variability'
             when is_known and vol > 5 then 'moderate_variability'
             else 'low_variability' end as temperature_stability
      from windowed where date is not null""",
    "polls": """select location_id, date, temp_min, temp_max + p.n * 0.25 as temp_max, pop,
        cast(p.n as int) as poll_no
      from raw_daily, unnest([1, 2, 3]) as p(n)""",
    # Seed of each customer's documents, and their forecast periods as rows.
    "grid": f"select cast(c_custkey as int) as doc_id, {SEED} as k from customer",
    "hour_period": f"""select doc_id, k, i, k + i as s, (k * 7 + i * 3) % 120 - 10 as number,
        list_element({COMPASS}, cast((k + 5 * i) % 16 + 1 as int)) as compass,
        list_element({TEXTS}, cast((k + 3 * i) % 7 + 1 as int)) as words
      from (select doc_id, k, unnest(range(1, {HOURLY_COUNT} + 1)) as i from grid)""",
    "day_period": f"""select doc_id, k, i, k + i as s, (k * 7 + i * 3) % 120 - 10 as number,
        list_element({COMPASS}, cast((k + 5 * i) % 16 + 1 as int)) as compass,
        list_element({TEXTS}, cast((k + 3 * i) % 7 + 1 as int)) as words,
        date '2024-01-01' + {DAY_INDEX} as date, s % 6 in (0, 2, 4) as is_day
      from (select doc_id, k, unnest(range(1, {DAILY_COUNT} + 1)) as i from grid)
      where s % 23 not in (0, 1)""",
}


def _icon(text: str) -> str:
    """Icon of the texts used in the generated documents."""
    return f"""case {text} when 'Partly Cloudy' then '02d' when 'Overcast' then '04d'
      when 'Rain Showers' then '09d' when 'Snow Showers' then '09d' when 'Light Rain' then '09d'
      when 'Rain' then '10d' when 'Thunderstorms' then '11d' when 'Snow' then '13d'
      when 'Heavy Snow' then '13d' when 'Patchy Fog' then '50d' else '01d' end"""


# Meaning of a period's members (both forecast kinds); s is k + i.
CELSIUS = """case when s % 17 in (0, 2) then null when i % 4 = 1 then cast(number as double)
  else cast(number - 32 as double) * 5.0 / 9.0 end"""
WIND = """case (k + 2 * i) % 11 when 0 then 0.0 when 1 then null when 2 then null when 3 then null
  when 4 then null else s % 30 * cast(0.44704 as double) end"""
DEGREES = """case s % 13 when 0 then 0 when 1 then null when 2 then null when 3 then 0
  else cast(trunc((list_position({}, compass) - 1) * 22.5) as int) end""".format(COMPASS)
WORDS = "case s % 19 when 0 then 'Unknown' when 1 then null else words end"
POP = """case when s % 9 in (0, 1, 2, 4, 5) then 0.0 else s % 101 / 100.0 end"""

PARTS |= {
    "typed_period": f"""select doc_id, date, i, is_day, {CELSIUS} as t, {WIND} as w,
        {DEGREES} as deg, {WORDS} as txt, cast({POP} as double) as pop, s % 17 = 1 as broken
      from day_period""",
    # The first period of a date that has a wind number; nights up to it may set the direction.
    "first_wind": """select doc_id, date, min(i) filter (w is not null and not broken) as first_i,
        max(i) filter (is_day and not broken) as last_day
      from typed_period group by all""",
    "folded": """select doc_id, date,
        arg_max(t, i) filter (is_day and t is not null and not broken) as temp_day,
        arg_max(t, i) filter (not is_day and t is not null and not broken) as temp_night,
        coalesce(arg_max(w, i) filter (is_day and w is not null and not broken),
                 arg_min(w, i) filter (w is not null and not broken)) as wind_speed,
        arg_max(deg, i) filter (deg is not null and not broken
          and (is_day or i <= coalesce(first_i, i))) as wind_deg,
        coalesce(max(txt) filter (i = last_day),
          arg_min(txt, i) filter (not is_day and not broken and txt is not null
            and i > coalesce(last_day, 0))) as description,
        greatest(0.0, coalesce(max(pop) filter (not broken), 0.0)) as pop,
        bool_or(not broken) as used
      from typed_period join first_wind using (doc_id, date)
      group by doc_id, date""",
    "obs": f"""select event_id, v,
        case event_id % 11 when 0 then 'Unknown' when 1 then null when 2 then 'Rain Showers'
          when 3 then 'Mostly Sunny' when 4 then 'Overcast' when 5 then 'Heavy Snow'
          else 'Fair' end as description,
        case when event_id % 40 in (0, 1) then ts
          else date_trunc('second', ts) + interval '5' hour end as timestamp,
        case when event_id % 50 <= 3 then null
          when event_type = 'view' then cast(v - 32 as double) * 5.0 / 9.0
          when event_type = 'purchase' then v - cast(273.15 as double)
          else cast(v as double) end as temp
      from (select *, cast(floor(value) as int) as v from events)""",
    "station_list": """select doc_id, k, i, k % 50 <> 49 as listed,
        if((k + i) % 4 in (0, 1), null, concat('S', k, '-', i)) as id
      from (select doc_id, k, unnest(range(1, k % 6 + 1)) as i from grid)""",
}


# Parts that others use more than once.
MATERIALIZED = {"days", "known", "rolled", "ranked", "patterned"}


def _uses(name: str, text: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None


def query(text: str) -> str:
    """Prefix a query with the named parts it needs, directly or not."""
    needed: list[str] = []
    pending = text
    for name in reversed(list(PARTS)):
        if _uses(name, pending):
            needed.insert(0, name)
            pending += "\n" + PARTS[name]
    if not needed:
        return text
    kind = {n: "materialized " if n in MATERIALIZED else "" for n in needed}
    return "with " + ",\n".join(f"{n} as {kind[n]}({PARTS[n]})" for n in needed) + "\n" + text


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, count(*) as records from {part}"
        for name, part in tables.items()
    )


NOW = f"timestamp '{AS_OF:%Y-%m-%d %H:%M:%S}'"
TODAY = f"date '{DAY:%Y-%m-%d}'"
AGE = f"{NOW} - interval '{TTL_SECONDS}' second"

_COMBINED_READING = """cast(case when i % 10 = 7 then null else i % 20 + 0.25 end as double) as wind_speed,
  cast((k * i) % 360 as int) as wind_deg, 'light rain' as description, '10d' as icon"""
_COMBINED_POP = "cast(case i % 3 when 0 then 0 when 1 then 0.25 else 0.5 end as double) as pop"
_READABLE = "k % 10 not in (1, 2, 3, 5)"


def _metric_rows(part: str, name: str, metrics: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, '{m}' as metric, cast({x} as double) as value from {part}"
        for m, x in metrics.items()
    )


TESTED = (
    ("current_weather", "raw_current", "timestamp"),
    ("hourly_weather", "raw_hourly", "timestamp"),
    ("daily_weather", "raw_daily", "date"),
)


def _dq(name: str, part: str, column: str) -> str:
    return f"""select '{name}' as table_name, '{column}' as column_name, n as failing_rows,
      case when n > 100 then 'error' when n > 10 then 'warn' else 'pass' end as status
      from (select count(*) filter ({column} is null) as n from {part})"""


def _broken_reason(kind: str) -> str:
    """Fault of the k-th broken body for a document kind."""
    common = "when 0 then 'unreadable' when 1 then 'not_an_object' when 2 then 'properties_missing'"
    arms = {
        "points": """when 3 then 'forecast_missing' when 4 then 'forecast_missing'
          when 5 then 'forecast_missing' when 6 then 'forecastHourly_missing'""",
        "current": """when 3 then 'temperature_missing' when 4 then 'temperature_missing'
          when 6 then 'temperature_missing'""",
        "hourly": """when 3 then 'periods_missing' when 4 then 'periods_missing'
          when 5 then 'periods_not_a_list'""",
    }["hourly" if kind == "daily" else kind]
    return f"case k % 8 {common} {arms} end"


def sql() -> dict[str, str]:
    q = {
        # documents
        "ingest_observation": f"""select event_id, timestamp, {six("temp")} as temp,
            {six('''case event_id % 3 when 0 then v + 2.0
              when 1 then cast(v - 35 as double) * 5.0 / 9.0 else temp end''')} as feels_like,
            case when event_id % 7 = 0 then null else v % 100 end as humidity,
            case when event_id % 2 = 0 then cast(trunc((100000 + 7 * v) / 100.0) as int)
              else 900 + v % 200 end as pressure,
            {six('''case event_id % 4 when 0 then v % 90 / cast(3.6 as double)
              when 1 then v % 90 * cast(0.44704 as double)
              else cast(v % 90 as double) end''')} as wind_speed,
            v % 360 as wind_deg, description, {_icon("description")} as icon
          from obs where event_id % 50 <> 0""",
        "feels_like": f"""select event_id,
            {six('''case event_id % 3 when 0 then v + 2.0
              when 1 then cast(v - 35 as double) * 5.0 / 9.0 else temp end''')} as feels_like
          from obs where event_id % 50 <> 0""",
        "parse_time": """select event_id, case when event_id % 40 in (0, 1) then null
            else date_trunc('second', ts) + interval '5' hour end as utc_time,
            case when event_id % 40 in (0, 1) then null else cast(ts as date) end as local_date
          from events""",
        "ingest_hourly": f"""select doc_id,
            timestamp '2024-01-01 05:00:00' + interval '1' hour * cast(i as int) as timestamp,
            {six(CELSIUS)} as temp, {six(CELSIUS)} as feels_like,
            case i % 5 when 0 then null when 2 then null else cast(s % 100 as int) end as humidity,
            cast(null as int) as pressure, {six(WIND)} as wind_speed, {DEGREES} as wind_deg,
            {WORDS} as description, {_icon(WORDS)} as icon, {six(POP)} as pop
          from hour_period where s % 37 not in (0, 1) and s % 17 <> 1""",
        "day_night_fold": f"""select doc_id, date, {six("temp_day")} as temp_day,
            {six("temp_night")} as temp_night, {six("wind_speed")} as wind_speed, wind_deg,
            description, if(used, {_icon("description")}, null) as icon, pop
          from folded""",
        "ingest_daily": f"""select doc_id, date,
            {six("coalesce(temp_night, temp_day - 5)")} as temp_min,
            {six("coalesce(temp_day, temp_night + 5)")} as temp_max,
            {six("coalesce(temp_day, temp_night + 5)")} as temp_day,
            {six("coalesce(temp_night, temp_day - 5)")} as temp_night,
            cast(null as int) as humidity, cast(null as int) as pressure,
            {six("wind_speed")} as wind_speed, wind_deg, description,
            if(used, {_icon("description")}, null) as icon, pop
          from folded""",
        "points_directory": """select doc_id, concat('https://example.org/grid/', k, '/forecast')
            as forecast_url, concat('https://example.org/grid/', k, '/hourly') as hourly_url,
            concat('https://example.org/grid/', k, '/stations') as stations_url
          from grid where k % 20 <> 19 and k % 10 > 3""",
        "first_station": """select doc_id, id as station_id from station_list
          where listed and i = 1 and id is not null""",
        "first_usable_station": """select doc_id, arg_min(id, i) as station_id
          from station_list where listed and id is not null group by doc_id""",
        "ingest_combined_current": f"""select doc_id,
            make_timestamp((cast(1704067200 as bigint) + k * 3600) * 1000000) as timestamp,
            cast(k % 60 - 20 as double) as temp, cast(k % 60 - 22 as double) as feels_like,
            cast(k % 100 as int) as humidity, cast(950 + k % 100 as int) as pressure,
            cast(0.25 as double) as wind_speed, 0 as wind_deg, 'light rain' as description,
            '10d' as icon
          from grid where k % 10 <> 0 and {_READABLE}""",
        "ingest_combined_hourly": f"""select doc_id,
            make_timestamp((cast(1704067200 as bigint) + k * 3600 + i * 1800) * 1000000) as timestamp,
            cast((k + i) % 60 - 20 as double) as temp, cast(k % 60 - 22 as double) as feels_like,
            cast((k + i) % 100 as int) as humidity, cast(950 + (k + i) % 100 as int) as pressure,
            {_COMBINED_READING}, {_COMBINED_POP}
          from grid, range(1, 53) as h(i) where k % 10 <> 6 and {_READABLE}""",
        "ingest_combined_daily": f"""select doc_id,
            cast(make_timestamp((cast(1704067200 as bigint) + k * 3600 + i * 1800) * 1000000) as date) as date,
            cast((k + i) % 30 - 10 as double) as temp_min, cast((k + i) % 30 as double) as temp_max,
            cast((k + i) % 30 - 2 as double) as temp_day, cast(null as double) as temp_night,
            cast((k + i) % 100 as int) as humidity, cast(950 + (k + i) % 100 as int) as pressure,
            {_COMBINED_READING}, {_COMBINED_POP}
          from grid, range(1, 10) as d(i) where k % 10 <> 4 and {_READABLE}""",
        "validate_combined": """select doc_id, reason, reason is null as is_valid
          from (select doc_id, case k % 10 when 0 then 'current_missing' when 4 then 'daily_missing'
            when 6 then 'hourly_missing' when 1 then 'current.temp_missing' end as reason
            from grid)""",
        "validate_documents": " union all ".join(
            f"""select doc_id, '{kind}' as kind, {_broken_reason(kind)} as reason,
              {_broken_reason(kind)} is null as is_valid from grid"""
            for kind in ("points", "current", "hourly", "daily")
        ),
        # cleaning and staging
        "clean_current": "select * from clean_current",
        "clean_hourly": "select * from clean_hourly",
        "clean_daily": "select * from clean_daily",
        "stg_current_weather": "select * from stg_current",
        "stg_hourly_weather": "select * from stg_hourly",
        "stg_daily_weather": "select * from stg_daily",
        "calendar_parts": f"""select location_id, timestamp,
            cast(extract(hour from timestamp) as int) as hour_of_day, {DOW.format("timestamp")},
            cast(extract(month from timestamp) as int) as month,
            cast(extract(year from timestamp) as int) as year
          from raw_hourly where timestamp is not null""",
        "describe_row": """select location_id, timestamp,
            concat(coalesce(cast(temp as varchar), 'N/A'), '°C, ',
              coalesce(description, 'Unknown'), ', Humidity: ',
              coalesce(cast(humidity as varchar), 'N/A'), '%, Wind: ',
              coalesce(cast(wind_speed as varchar), 'N/A'), ' m/s') as report
          from clean_current""",
        # models
        "current_daily_summary": "select * from cur_day",
        "daily_mode": """select location_id, cast(timestamp as date) as date,
            mode() within group (order by description) as description
          from stg_current group by all""",
        "hourly_daily_summary": "select * from hour_day",
        "day_night_profile": """select location_id, date, avg_daytime_temp, avg_nighttime_temp
          from hour_day""",
        "daily_reconcile_2way": "select * from two_way",
        "int_weather_summary": "select * from days",
        "source_gap": "select location_id, date, temp_variance_current_vs_hourly from days",
        "day_night_gap": "select location_id, date, day_night_temp_difference from days",
        "weather_summary": "select * from summary",
        "weather_trends": "select * from trends",
        # One row per station and date: the joins give what one pass gives.
        "weather_trends_by_joins": "select * from trends",
        "weather_alerts": """select * from trends where extreme_weather_indicator <> 'normal'""",
        # windows
        "moving_avg_7": f"""select location_id, date, {rnd("t7", 4)} as temp_7day_moving_avg,
            {rnd("h7", 4)} as humidity_7day_moving_avg, {rnd("w7", 4)} as wind_7day_moving_avg
          from rolled""",
        "moving_avg_30": f"""select location_id, date, {rnd("t30", 4)} as temp_30day_moving_avg
          from rolled""",
        "rolling_volatility": f"""select location_id, date, {rnd("vol", 4)} as temp_7day_volatility
          from rolled""",
        "trend_direction": """select location_id, date, trend as temp_trend_direction
          from rolled""",
        "site_moving_avg": f"""select location_id, date, {rnd("avg(final_avg_temp) over w", 4)}
            as temp_7row_moving_avg
          from known window w as (order by date nulls last, location_id
                                  rows between 6 preceding and current row)""",
        "site_seasonal_rank": f"""select *,
            cast(rank() over (partition by season order by final_avg_temp desc) as int) as temp_rank_in_season
          from (select location_id, date, season, {rnd("final_avg_temp", 4)} as final_avg_temp from known)""",
        "seasonal_avg": f"""select location_id, date, season,
            {rnd("season_avg", 4)} as seasonal_avg_temp from ranked""",
        "seasonal_deviation": f"""select location_id, date, season,
            {rnd("deviation", 4)} as temp_deviation_from_seasonal_avg from ranked""",
        "seasonal_rank": """select location_id, date, season,
            season_rank as temp_rank_in_season from ranked""",
        "weather_pattern": "select location_id, date, weather_pattern from patterned",
        "extreme_indicator": "select location_id, date, extreme_weather_indicator from patterned",
        # scalar functions
        "convert_temperature": f"""select event_id, {six('''case temp_unit
            when 'wmoUnit:degF' then (value - 32) * 5.0 / 9.0
            when 'wmoUnit:K' then value - cast(273.15 as double) else value end''')} as celsius
          from quantity""",
        "convert_pressure": """select event_id, cast(trunc(case pressure_unit
            when 'wmoUnit:hPa' then value else value / 100 end) as int) as hpa from quantity""",
        "convert_wind": f"""select event_id, {six('''case wind_unit
            when 'wmoUnit:km_h-1' then value / cast(3.6 as double)
            when 'wmoUnit:mi_h-1' then value * cast(0.44704 as double) else value end''')} as mps
          from quantity""",
        "wind_text_to_mps": f"""select l_orderkey, l_linenumber, l_partkey, wind_text,
            {six('''if(wind_text = 'calm', null, temperature * cast(0.44704 as double))''')} as mps
          from period""",
        "compass_to_degrees": """select l_orderkey, l_linenumber, l_partkey, wind_direction,
            case wind_direction when 'NW' then 315 when 'S' then 180 when 'XX' then 0 end as degrees
          from period""",
        "icon_code": f"""select location_id, timestamp, description,
            {_icon("description")} as icon from raw_current""",
        "pop_fraction": f"""select l_orderkey, l_linenumber, l_partkey,
            {six("coalesce(pop_percent, 0) / 100.0")} as pop from period""",
        "json_props": r"""select event_id, cast(regexp_extract(props, '"k": (\d+)', 1) as int) as k,
            -1 as absent from events""",
        # latest rows
        "latest_observation": f"""select {CURRENT} from raw_current
          order by timestamp desc nulls last, location_id desc nulls last, temp desc nulls last,
            feels_like desc nulls last, humidity desc nulls last, pressure desc nulls last,
            wind_speed desc nulls last, wind_deg desc nulls last, description desc nulls last
          limit 1""",
        "latest_per_location": f"""select {CURRENT} from raw_current
          qualify row_number() over (partition by location_id order by
            timestamp desc nulls last, temp desc nulls last, feels_like desc nulls last,
            humidity desc nulls last, pressure desc nulls last, wind_speed desc nulls last,
            wind_deg desc nulls last, description desc nulls last) = 1""",
        "adhoc_recent": f"""select location_id, timestamp, temp, description
          from raw_current where timestamp is not null
          order by timestamp desc, location_id, temp nulls last, description
          limit {RECENT_ROWS}""",
        "latest_per_key": """select location_id, date, temp_min,
            max(temp_max) filter (poll_no = 3) as temp_max, pop, 3 as poll_no
          from polls group by location_id, date, temp_min, pop""",
        "unexpired_entries": f"""select user_id, ts, event_id, value from events
          where ts >= {AGE}
          qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
        "entry_at": f"""with entry as (
            select user_id, ts, max(event_id) as event_id from events
            where event_type = 'purchase' group by user_id, ts)
          select e.event_id, e.user_id, e.ts, if(fresh, c.event_id, null) as entry_id,
            if(fresh, c.ts, null) as cached_at
          from (select *, true as one from events) e
          asof left join entry c on e.user_id = c.user_id and e.ts >= c.ts,
          lateral (select e.ts - c.ts <= interval '{ENTRY_TTL_SECONDS}' second as fresh) f""",
        "freshness_stats": f"""select count(*) as total_entries,
            count(*) filter (newest < {AGE}) as expired_entries,
            count(*) filter (newest >= {AGE}) as valid_entries,
            {TTL_SECONDS} as cache_ttl_seconds
          from (select user_id, max(ts) as newest from events group by user_id)""",
        # coverage
        "coverage_filter": """select station_id, lat, lon from station
          where (lat between 24.5 and 49.4 and lon between -125 and -66.9)
             or (lat between 51.2 and 71.4 and lon between -179.1 and -129.9)
             or (lat between 18.9 and 28.4 and lon between -178.3 and -154.8)
             or (lat between 17.8 and 18.6 and lon between -67.3 and -65.2)""",
        "coordinate_sanity": """select station_id, lat, lon,
            coalesce(lat between -90 and 90 and lon between -180 and 180, false) as is_valid
          from station_report""",
        "coverage_region": """select station_id, lat, lon, region from station
          join (values ('continental', 24.5, 49.4, -125.0, -66.9),
                       ('alaska', 51.2, 71.4, -179.1, -129.9),
                       ('hawaii', 18.9, 28.4, -178.3, -154.8),
                       ('puerto_rico', 17.8, 18.6, -67.3, -65.2)) r(region, s, n, w, e)
            on lat between s and n and lon between w and e""",
        "coverage_join": """select sensor_id, lat, lon, region_id, nation_id
          from sensor join (
            select region_id, nation_id, south, north, west, if(west > east, 180, east) as east from region_box
            union all
            select region_id, nation_id, south, north, -180, east from region_box where west > east) r
            on lat between south and north and lon between west and east""",
        # statistics and quality
        "table_stats": """with t as (
            select 'current_weather' as table_name, count(*) as records,
              max(timestamp) as latest_update from raw_current
            union all select 'hourly_weather', count(*), max(timestamp) from raw_hourly
            union all select 'daily_weather', count(*), cast(max(date) as timestamp) from raw_daily)
          select * from t union all
          select 'total', cast(sum(records) as bigint), max(latest_update) from t""",
        "warehouse_summary": f"""with t as (
            select 'raw' as layer, * from ({_counts({
                "current_weather": "raw_current", "hourly_weather": "raw_hourly",
                "daily_weather": "raw_daily"})})
            union all select 'analytics' as layer, * from ({_counts({
                "weather_summary": "summary", "weather_trends": "trends"})}))
          select * from t union all
          select layer, 'total', cast(sum(records) as bigint) from t group by layer""",
        "counts_as_of": f"""with t as (
            select 'current_records' as metric, count(*) as records from raw_current
            union all select 'hourly_records_today', count(*) from raw_hourly
              where cast(timestamp as date) = {TODAY}
            union all select 'daily_forecast_records', count(*) from raw_daily
              where date >= {TODAY})
          select * from t union all select 'total_records', cast(sum(records) as bigint) from t""",
        "profile_report": " union all ".join(
            [
                _metric_rows("raw_current", "current_weather", {
                    "record_count": "count(*)", "avg_temp": "avg(temp)", "min_temp": "min(temp)",
                    "max_temp": "max(temp)", "avg_humidity": "avg(humidity)",
                    "avg_pressure": "avg(pressure)", "avg_wind_speed": "avg(wind_speed)"}),
                _metric_rows("raw_hourly", "hourly_weather", {
                    "record_count": "count(*)",
                    "unique_days": "count(distinct cast(timestamp as date))",
                    "avg_temp": "avg(temp)", "avg_precipitation_prob": "avg(pop)"}),
                _metric_rows("raw_daily", "daily_weather", {
                    "record_count": "count(*)", "avg_temp_max": "avg(temp_max)",
                    "avg_temp_min": "avg(temp_min)", "avg_precipitation_prob": "avg(pop)"}),
            ]
        ),
        "quality_current": """select count(*) as total_records, count(temp) as temp_count,
            count(humidity) as humidity_count, count(pressure) as pressure_count,
            count(wind_speed) as wind_speed_count,
            count(*) filter (description <> '') as description_count,
            avg(temp) as avg_temp, avg(humidity) as avg_humidity, avg(pressure) as avg_pressure
          from raw_current""",
        "quality_hourly": """select count(*) as total_records,
            count(distinct cast(timestamp as date)) as unique_days,
            min(timestamp) as earliest_time, max(timestamp) as latest_time,
            avg(temp) as avg_temp, count(pop) as pop_count
          from raw_hourly""",
        "quality_daily": """select count(*) as total_records, min(date) as earliest_date,
            max(date) as latest_date, avg(temp_max) as avg_temp_max, avg(temp_min) as avg_temp_min,
            count(*) filter (temp_max is not null and temp_min is not null) as complete_pairs,
            count(*) filter (temp_max >= temp_min) as ordered_pairs,
            count(*) filter (temp_max > temp_min) as strictly_ordered_pairs
          from raw_daily""",
        "quality_verdict": """with c as (select count(*) as current_rows,
              count(temp) / count(*) > 0.8 as temp_complete,
              coalesce(avg(temp), 0) between -40 and 45 as temp_reasonable,
              coalesce(avg(humidity), 0) between 0 and 100 as humidity_valid,
              coalesce(avg(pressure), 0) between 900 and 1100 as pressure_valid from raw_current),
            h as (select count(*) as hourly_rows, count(*) >= 12 as hourly_enough,
              coalesce(avg(pop), 0) between 0 and 1 as pop_valid from raw_hourly),
            d as (select count(*) as daily_rows, count(*) >= 3 as daily_enough,
              count(*) filter (temp_max >= temp_min) = count(*) as temp_order_valid
              from raw_daily where temp_max is not null and temp_min is not null)
          select *, temp_complete and temp_reasonable and humidity_valid and hourly_enough
            and pop_valid and daily_enough and temp_order_valid as quality_passed
          from c, h, d""",
        "dq_not_null": " union all ".join(
            f"""select '{name}' as table_name, '{column}' as column_name, location_id, wind_deg,
              description from {part} where {column} is null"""
            for name, part, column in TESTED
        ),
        "dq_severity": " union all ".join(
            _dq(name, part, column) for name, part, column in TESTED
        ),
        "dq_failures": " union all by name ".join(
            f"""select *, '{name}' as table_name, '{column}' as column_name
              from {part} where {column} is null"""
            for name, part, column in TESTED
        ),
    }
    return {name: _with(text) for name, text in q.items()}


def _with(text: str) -> str:
    """Add the needed parts, also in front of a query that brings its own WITH."""
    body = query(text)
    return re.sub(r"\)\n\s*with (?=\w+ as (?:materialized )?\()", "),\n", body, count=1)
