"""Weather-shaped inputs derived from the generated tables.

The flat views are SQL texts that Spark and DuckDB both run; they keep every row of their source
table. The document frames are JSON built row by row in Spark (no grouping, no collecting); the
oracle never parses that JSON but works from the same source columns.

Numbers are multiples of 1/4, 1/8 or 1/64, so sums are exact in any order. A location is a block of
20 suppliers or 300 customers: the number of locations grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_LOCATION = "cast((l_suppkey - l_suppkey % 20) / 20 as int)"
ORDER_LOCATION = "cast((o_custkey - o_custkey % 300) / 300 as int)"


def _moved(column: str, days: str, by: int) -> str:
    """Move some days of the month on, so that the feeds have different gaps in the calendar."""
    return (
        f"case when extract(day from {column}) in ({days}) "
        f"then {column} + interval '{by}' day else {column} end"
    )


def _readings(base: int, days: str, by: int) -> str:
    """Columns shared by the observation and the hourly view."""
    warmth = "6 * abs(7 - extract(month from l_shipdate))"
    return f"""
  {LINE_LOCATION} as location_id,
  case when l_orderkey % 97 = 0 then null
       else {_moved("l_shipdate", days, by)} + interval '1' hour * cast(l_partkey % 24 as int)
  end as timestamp,
  case when l_orderkey % 41 = 0 then null
       else cast(l_quantity * 0.75 + {base} - {warmth} as double) end as temp,
  cast(l_quantity * 0.75 + 12 - {warmth} as double) as feels_like,
  cast(l_partkey % 110 as int) as humidity,
  cast(780 + l_partkey % 440 as int) as pressure,
  cast((l_orderkey % 120) * 0.25 - 1 as double) as wind_speed,
  cast(l_orderkey % 400 as int) as wind_deg"""


# Both line views hold every line, once as an observation and once as an hourly forecast.
FLAT_VIEWS = {
    "raw_current": f"""
select {_readings(14, "1, 2, 3", 3)},
  case when l_linestatus = 'O' then 'Mostly Sunny' when l_linenumber % 3 = 0 then 'Light Rain'
       when l_linenumber % 3 = 1 then 'Partly Cloudy' else 'Snow Showers' end as description,
  '01d' as icon
from {{lineitem}}""",
    "raw_hourly": f"""
select {_readings(13, "2, 3, 4, 5", 4)},
  case when l_linenumber % 2 = 0 then 'Clear' else 'Cloudy' end as description,
  '01d' as icon,
  cast(l_orderkey % 72 as double) / 64 as pop
from {{lineitem}}""",
    "raw_daily": f"""
select location_id, date,
  cast(min(o_custkey % 60) * 0.5 - 20 as double) as temp_min,
  cast(max(o_custkey % 70) * 0.75 as double) as temp_max,
  cast(max(o_custkey % 66) * 0.75 as double) as temp_day,
  cast(min(o_custkey % 50) * 0.5 - 18 as double) as temp_night,
  cast(max(o_orderkey % 110) as int) as humidity,
  cast(780 + min(o_orderkey % 440) as int) as pressure,
  cast(min(o_orderkey % 120) * 0.25 - 1 as double) as wind_speed,
  cast(max(o_orderkey % 400) as int) as wind_deg,
  case min(cast(substr(o_orderpriority, 1, 1) as int)) when 1 then '1-URGENT' when 2 then '2-HIGH'
    when 3 then '3-MEDIUM' when 4 then '4-NOT SPECIFIED' else '5-LOW' end as description,
  '01d' as icon,
  cast(min(o_orderkey % 72) as double) / 64 as pop
from (select *, {ORDER_LOCATION} as location_id,
        case when o_orderkey % 53 = 0 then null
             else cast({_moved("o_orderdate", "2, 13", 1)} as date) end as date
      from {{orders}}) o
group by location_id, date""",
    "quantity": """
select event_id, cast(floor(value) as double) as value,
  case event_type when 'click' then 'wmoUnit:degC' when 'view' then 'wmoUnit:degF'
    when 'purchase' then 'wmoUnit:K' when 'error' then 'bad:unit' else null end as temp_unit,
  case event_type when 'click' then 'wmoUnit:Pa' when 'view' then 'wmoUnit:hPa'
    when 'error' then 'bad:unit' else null end as pressure_unit,
  case event_type when 'click' then 'wmoUnit:km_h-1' when 'view' then 'wmoUnit:mi_h-1'
    when 'purchase' then 'wmoUnit:m_s-1' when 'error' then 'bad:unit' else null end as wind_unit
from {events}""",
    "station": """
select s_suppkey as station_id,
  cast(15 + cast((s_suppkey * 37) % 480 as double) / 8 as double) as lat,
  cast(-180 + cast((s_suppkey * 53) % 960 as double) / 8 as double) as lon
from {supplier}""",
    # Sensors at eighths of a degree, one for each event, and boxes of all sizes, one for each customer;
    # every 50th crosses the 180th meridian, every 41st has an unknown edge.
    "sensor": """
select event_id as sensor_id,
  case when event_id % 29 = 0 then null
       else cast(cast((event_id * 37) % 1441 as double) / 8 - 90 as double) end as lat,
  cast(cast((event_id * 53) % 2881 as double) / 8 - 180 as double) as lon
from {events}""",
    "region_box": """
select c_custkey as region_id, c_nationkey as nation_id,
  case when c_custkey % 41 = 0 then null else south end as south,
  south + tall as north, west,
  case when west + wide > 180 then west + wide - 360 else west + wide end as east
from (select c_custkey, c_nationkey,
        cast(cast((c_custkey * 31) % 700 as double) / 4 - 90 as double) as south,
        case when c_custkey % 50 = 0 then cast(179 as double)
             else cast(cast((c_custkey * 59) % 1430 as double) / 4 - 180 as double) end as west,
        cast(case when c_custkey % 500 = 7 then 90 when c_custkey % 20 = 3 then 4 else 0.375 end as double) as tall,
        cast(case when c_custkey % 500 = 7 then 200 when c_custkey % 20 = 3 then 3 else 1.5 end as double) as wide
      from {customer}) c""",
    "station_report": """
select s_suppkey as station_id,
  case when s_suppkey % 11 = 0 then null
       else cast(cast((s_suppkey * 37) % 1520 as double) / 8 - 95 as double) end as lat,
  case when s_suppkey % 13 = 0 then null
       else cast(cast((s_suppkey * 53) % 2960 as double) / 8 - 185 as double) end as lon
from {supplier}""",
    "period": """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity as int) as temperature,
  case when l_linenumber % 4 = 0 then 'C' else 'F' end as temperature_unit,
  case when l_orderkey % 11 = 0 then 'calm'
       else concat(cast(cast(l_quantity as int) as varchar(8)), ' to 60 mph') end as wind_text,
  case when l_orderkey % 5 = 0 then 'NW' when l_orderkey % 5 = 1 then 'S'
       when l_orderkey % 5 = 2 then 'XX' when l_orderkey % 5 = 3 then '' else null
  end as wind_direction,
  case when l_orderkey % 4 = 0 then 'Rain Showers' when l_orderkey % 4 = 1 then 'Mostly Sunny'
       when l_orderkey % 4 = 2 then 'Patchy Fog' else 'Snow' end as short_forecast,
  case when l_orderkey % 13 = 0 then null else cast(l_partkey % 101 as int) end as pop_percent
from {lineitem}""",
}

SOURCES = ("customer", "events", "lineitem", "orders", "supplier")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = FLAT_VIEWS[name]
    frames = {t: table(spark, sf_dir, t) for t in SOURCES if f"{{{t}}}" in text}
    return spark.sql(text, **frames)


def raw_views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(view(spark, sf_dir, n) for n in ("raw_current", "raw_hourly", "raw_daily"))


def daily_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily feed polled three times; a later poll is a quarter degree warmer."""
    polls = view(spark, sf_dir, "raw_daily").withColumn(
        "poll_no", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    )
    return polls.select(
        "location_id", "date", "temp_min",
        (F.col("temp_max") + F.col("poll_no") * 0.25).alias("temp_max"), "pop", "poll_no",
    )


# ---------------------------------------------------------------------------------------------
# Documents. Every member is a SQL text giving its JSON, or NULL to leave the member out.


def _object(members: dict[str, str]) -> str:
    parts = ", ".join(f"concat('\"{name}\":', {json})" for name, json in members.items())
    return f"concat('{{', concat_ws(',', {parts}), '}}')"


def _quoted(text: str) -> str:
    return f"concat('\"', {text}, '\"')"


def _pick(index: str, values: list[str], otherwise: str | None = None) -> str:
    """CASE over small index values."""
    arms = " ".join(f"when {n} then {v}" for n, v in enumerate(values))
    return f"case {index} {arms} else {otherwise or 'null'} end"


OBSERVATION = _object(
    {
        "properties": _object(
            {
                "temperature": """case event_id % 50 when 0 then null when 1 then 'null'
                  when 2 then '"not a quantity"' when 3 then '{"value":"bad"}'
                  else concat('{"value":', v, case event_type
                    when 'click' then ',"unitCode":"wmoUnit:degC"}'
                    when 'view' then ',"unitCode":"wmoUnit:degF"}'
                    when 'purchase' then ',"unitCode":"wmoUnit:K"}'
                    when 'error' then ',"unitCode":"bad:unit"}' else '}' end) end""",
                "heatIndex": """case event_id % 3
                  when 0 then concat('{"value":', v + 2, '}') when 2 then '{"value":null}' end""",
                "windChill": """case when event_id % 3 <> 2
                  then concat('{"value":', v - 3, ',"unitCode":"wmoUnit:degF"}') end""",
                "relativeHumidity": """case when event_id % 7 = 0 then '{"value":null}'
                  else concat('{"value":', v % 100, '.75}') end""",
                "barometricPressure": """case when event_id % 2 = 0
                  then concat('{"value":', 100000 + 7 * v, ',"unitCode":"wmoUnit:Pa"}')
                  else concat('{"value":', 900 + v % 200, ',"unitCode":"wmoUnit:hPa"}') end""",
                "windSpeed": """concat('{"value":', v % 90, ',"unitCode":"', case event_id % 4
                  when 0 then 'wmoUnit:km_h-1' when 1 then 'wmoUnit:mi_h-1'
                  when 2 then 'wmoUnit:m_s-1' else 'bad:unit' end, '"}')""",
                "windDirection": "concat('{\"value\":', v % 360, '}')",
                "textDescription": """case event_id % 11 when 0 then null when 1 then 'null'
                  when 2 then '"Rain Showers"' when 3 then '"Mostly Sunny"'
                  when 4 then '"Overcast"' when 5 then '"Heavy Snow"' else '"Fair"' end""",
                "timestamp": """case event_id % 40 when 0 then null when 1 then '"not a time"'
                  else concat('"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '-05:00"') end""",
            }
        )
    }
)

# Content of a customer's documents follows from its key, nation and balance.
SEED = "cast(c_custkey + 7 * c_nationkey + abs(floor(c_acctbal)) as int)"

# Hourly periods of the customer with seed k, number i of n.
HOURLY_COUNT = "40 + k % 20"
COMPASS = [
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
]
TEXTS = ["Sunny", "Partly Cloudy", "Rain Showers", "Rain", "Thunderstorms", "Snow", "Patchy Fog"]

_WEATHER_MEMBERS = {
    "temperature": """case (k + i) % 17 when 0 then 'null' when 1 then '"warm"' when 2 then null
      else cast((k * 7 + i * 3) % 120 - 10 as string) end""",
    "temperatureUnit": "case i % 4 when 0 then null when 1 then '\"C\"' else '\"F\"' end",
    "windSpeed": """case (k + 2 * i) % 11 when 0 then null when 1 then 'null' when 2 then '"calm"'
      when 3 then '""' when 4 then '7'
      else concat('"', (k + i) % 30, ' to ', (k + i) % 30 + 5, ' mph"') end""",
    "windDirection": f"""case (k + i) % 13 when 0 then null when 1 then 'null' when 2 then '""'
      when 3 then '"XX"' else {_quoted(_pick("(k + 5 * i) % 16", [f"'{c}'" for c in COMPASS]))} end""",
    "shortForecast": f"""case (k + i) % 19 when 0 then null when 1 then 'null'
      else {_quoted(_pick("(k + 3 * i) % 7", [f"'{t}'" for t in TEXTS]))} end""",
    "probabilityOfPrecipitation": """case (k + i) % 9 when 0 then null when 1 then 'null'
      when 2 then '{"value":null}' when 3 then cast((k + i) % 101 as string) when 4 then '"n/a"'
      when 5 then '{}' else concat('{"value":', (k + i) % 101, '}') end""",
}

HOURLY_PERIOD = _object(
    {
        "startTime": """case (k + i) % 37 when 0 then null when 1 then '"soon"'
          else concat('"', date_format(timestamp_ntz '2024-01-01 00:00:00'
            + make_dt_interval(0, i), "yyyy-MM-dd'T'HH:mm:ss"), '-05:00"') end""",
        **_WEATHER_MEMBERS,
        "relativeHumidity": """case i % 5 when 0 then null when 1 then cast((k + i) % 100 as string)
          when 2 then '{"value":null}' else concat('{"value":', (k + i) % 100, '.5}') end""",
    }
)

# Day/night periods: three per date, evening times that fall on the next day in UTC.
DAILY_COUNT = "16 + k % 10"
DAY_INDEX = "cast(floor((i - 1 + k % 2) / 3) as int)"
DAILY_PERIOD = _object(
    {
        "startTime": f"""case (k + i) % 23 when 0 then null when 1 then '"soon"'
          else concat('"', date_add(date '2024-01-01', {DAY_INDEX}), 'T20:00:00-05:00"') end""",
        "isDaytime": """case (k + i) % 6 when 0 then null when 1 then 'null'
          when 2 then 'true' when 4 then 'true' else 'false' end""",
        **_WEATHER_MEMBERS,
    }
)


def _reading(i: str, temp: str) -> dict[str, str]:
    return {
        "dt": f"cast(1704067200 + cast(k as bigint) * 3600 + {i} * 1800 as string)",
        **{"temp": temp},
        "feels_like": "cast(k % 60 - 22 as string)",
        "humidity": f"cast((k + {i}) % 100 as string)",
        "pressure": f"cast(950 + (k + {i}) % 100 as string)",
        "wind_speed": f"case {i} % 10 when 7 then 'null' else concat({i} % 20, '.25') end",
        "wind_deg": f"cast((k * {i}) % 360 as string)",
        "weather": """'[{"description":"light rain","icon":"10d"},{"description":"mist"}]'""",
        "pop": f"case {i} % 3 when 0 then null when 1 then '0.25' else '0.5' end",
    }


def _list(count: str, item: str) -> str:
    return f"concat('[', array_join(transform(sequence(1, {count}), i -> {item}), ','), ']')"


# Seed k, by k % 10: 0 has no current section, 1 an incomplete one, 2 lacks a temperature in
# hour 3, 3 lacks one in hour 50, 4 has no daily section, 5 lacks the temperatures
# of day 2, 6 has no hourly section.
_HOUR_TEMP = """case when (k % 10 = 2 and i = 3) or (k % 10 = 3 and i = 50) then null
  else cast((k + i) % 60 - 20 as string) end"""
_DAY_TEMP = """case when k % 10 = 5 and i = 2 then null else concat('{"min":', (k + i) % 30 - 10,
  ',"max":', (k + i) % 30, ',"day":', (k + i) % 30 - 2, ',"night":null}') end"""
COMBINED = _object(
    {
        "current": f"case when k % 10 = 0 then null else "
        f"{_object(_reading('0', 'case when k % 10 = 1 then null else cast(k % 60 - 20 as string) end'))} end",
        "hourly": f"case when k % 10 = 6 then null else {_list('52', _object(_reading('i', _HOUR_TEMP)))} end",
        "daily": f"case when k % 10 = 4 then null else {_list('9', _object(_reading('i', _DAY_TEMP)))} end",
    }
)

# Grid points and station lists of the customer with seed k.
POINTS = _object(
    {
        "properties": "case when k % 20 = 19 then null else "
        + _object(
            {
                "forecast": """case k % 10 when 0 then null
                  else concat('"https://example.org/grid/', k, '/forecast"') end""",
                "forecastHourly": """case k % 10 when 1 then '""' when 2 then null
                  else concat('"https://example.org/grid/', k, '/hourly"') end""",
                "observationStations": """case k % 10 when 3 then 'null'
                  else concat('"https://example.org/grid/', k, '/stations"') end""",
            }
        )
        + " end",
    }
)
STATIONS = _object(
    {
        "features": """case when k % 50 = 49 then null when k % 6 = 0 then '[]' else """
        + _list(
            "k % 6",
            """concat('{"properties":{', case (k + i) % 4 when 0 then '' when 1
              then '"stationIdentifier":null' else concat('"stationIdentifier":"S', k, '-', i, '"')
              end, '}}')""",
        )
        + " end",
    }
)

# Bodies that are no forecast at all, to exercise the shape checks.
BROKEN = """case k % 8 when 0 then 'no json {' when 1 then '[1, 2]' when 2 then '{}'
  when 3 then '{"properties":null}' when 4 then '{"properties":{}}'
  when 5 then '{"properties":{"periods":"none","temperature":null}}'
  when 6 then '{"properties":{"periods":[],"forecast":"f"}}'
  else '{"properties":{"periods":[{}],"forecast":"f","forecastHourly":"h","temperature":{}}}' end"""


def observation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation document per event; it arrives at the event's own time."""
    return (
        _spread(table(spark, sf_dir, "events"), "event_id")
        .withColumn("v", F.expr("cast(floor(value) as int)"))
        .select("event_id", F.expr(OBSERVATION).alias("body"), F.col("ts").alias("ingested_at"))
    )


def _spread(keys: DataFrame, column: str) -> DataFrame:
    """Spread rows over all cores before documents are built: the text is far larger than its
    source row, which the adaptive optimizer cannot know."""
    return keys.repartition(keys.sparkSession.sparkContext.defaultParallelism, column)


def _per_customer(spark: SparkSession, sf_dir: str, body: str) -> DataFrame:
    key = F.col("c_custkey").cast("int").alias("doc_id")
    keys = _spread(table(spark, sf_dir, "customer").select(key, F.expr(SEED).alias("k")), "doc_id")
    return keys.select("doc_id", F.expr(body).alias("body"))


def hourly_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(spark, sf_dir, _forecast(_list(HOURLY_COUNT, HOURLY_PERIOD)))


def daily_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(spark, sf_dir, _forecast(_list(DAILY_COUNT, DAILY_PERIOD)))


def _forecast(periods: str) -> str:
    return _object({"properties": _object({"periods": periods})})


def combined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(spark, sf_dir, COMBINED)


def points_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(spark, sf_dir, POINTS)


def stations_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(spark, sf_dir, STATIONS)


def broken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(spark, sf_dir, BROKEN)
