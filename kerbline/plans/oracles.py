"""The same queries as SQL over the given tables, written independently of the operators."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Fixed values.
WEATHER = [
    "Clear", "Clouds", "Drizzle", "Fog", "Haze", "Mist",
    "Rain", "Smoke", "Snow", "Squall", "Thunderstorm",
]
SEEN = ["Clear", "Clouds", "Drizzle", "Haze", "Mist", "Rain", "Snow", "Squall"]
ADVERSE = "('Thunderstorm','Snow','Squall','Fog','Mist','Haze','Smoke')"
RAW = ["holiday", "temp", "rain_1h", "snow_1h", "clouds_all", "weather_main", "weather_description", "date_time", "traffic_volume"]
NUMERIC = {"temp": "DOUBLE", "rain_1h": "DOUBLE", "snow_1h": "DOUBLE", "clouds_all": "INTEGER", "traffic_volume": "BIGINT"}
KEY = "event_id, weather_main"


def r(expression: str, name: str, digits: int = 6) -> str:
    rounded = f"round({expression}, {digits})"
    return f"CASE WHEN {rounded} = 0 THEN 0.0 ELSE {rounded} END AS {name}"


def h(keys: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5({keys} || '|{seed}'), 1, 13) AS BIGINT)"


ROW_HASH = h("CAST(event_id AS VARCHAR) || '|' || weather_main")

CTE_RAW = """
ev AS (
  SELECT event_id, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         TIMESTAMP '2012-10-02 00:00:00' + to_hours(CAST((event_id * 5) % 43824 AS INTEGER)) AS dt
  FROM events),
ev2 AS (SELECT *, hour(dt) AS h, month(dt) AS m, day(dt) AS d, isodow(dt) - 1 AS wd FROM ev),
ev3 AS (
  SELECT *, CASE WHEN event_id % 1000 = 3 THEN 'Squall' WHEN event_type = 'click' THEN 'Clear'
    WHEN event_type = 'view' THEN 'Clouds' WHEN event_type = 'purchase' THEN 'Rain'
    WHEN event_type = 'error' THEN 'Mist' WHEN m IN (12, 1, 2) THEN 'Snow' ELSE 'Drizzle' END AS w
  FROM ev2),
ev4 AS (
  SELECT *, 'one' AS kind FROM ev3
  UNION ALL SELECT *, 'copy' FROM ev3 WHERE event_id % 500 = 1
  UNION ALL SELECT *, 'haze' FROM ev3 WHERE event_id % 9 = 4),
traffic_raw AS (
  SELECT event_id,
    CASE WHEN m = 1 AND d = 1 THEN 'New Years Day' WHEN m = 9 AND d <= 7 AND wd = 0 THEN ' Labor Day '
         WHEN m = 7 AND d = 4 THEN 'Independence Day' END AS holiday,
    CASE WHEN event_id % 997 = 5 THEN 0.0 ELSE CAST(255 + (user_id * 7 + m * 3) % 50 AS DOUBLE) END::DOUBLE AS temp,
    CASE WHEN event_id % 4001 = 7 THEN 9831.3 WHEN w = 'Rain' THEN k / 20.0 ELSE 0.0 END::DOUBLE AS rain_1h,
    CASE WHEN w = 'Snow' THEN k / 200.0 ELSE 0.0 END::DOUBLE AS snow_1h,
    k AS clouds_all,
    CASE WHEN kind = 'haze' THEN 'Haze' WHEN event_id % 11 = 0 THEN upper(w)
         WHEN event_id % 13 = 0 THEN ' ' || w ELSE w END AS weather_main,
    CASE WHEN kind = 'haze' THEN 'haze' WHEN w = 'Clear' AND event_id % 7 = 0 THEN 'Sky is Clear'
         WHEN w = 'Clear' THEN 'sky is clear' ELSE 'light ' || lower(w) END AS weather_description,
    dt AS date_time,
    CAST(least(7280, floor(CASE
      WHEN wd < 5 AND h IN (7, 8, 9, 15, 16, 17, 18) THEN 4500 WHEN wd < 5 AND h BETWEEN 6 AND 20 THEN 3200
      WHEN wd < 5 THEN 500 WHEN h BETWEEN 10 AND 18 THEN 3300 ELSE 700 END + value * 8)) AS BIGINT) AS traffic_volume
  FROM ev4)"""

CTE_TEXT = """,
traffic_text AS (
  SELECT event_id,
    CASE WHEN event_id % 19 = 0 THEN '' WHEN event_id % 23 = 0 THEN 'None' ELSE holiday END AS holiday,
    CASE WHEN event_id % 83 = 5 THEN 'n/a' ELSE CAST(temp AS VARCHAR) END AS temp,
    CASE WHEN event_id % 89 = 7 THEN 'trace' ELSE CAST(rain_1h AS VARCHAR) END AS rain_1h,
    CASE WHEN event_id % 73 <> 1 THEN CAST(snow_1h AS VARCHAR) END AS snow_1h,
    CASE WHEN event_id % 79 = 2 THEN 'unknown' ELSE CAST(clouds_all AS VARCHAR) END AS clouds_all,
    weather_main, weather_description,
    CASE WHEN event_id % 101 = 9 THEN 'not a date' ELSE strftime(date_time, '%Y-%m-%d %H:%M:%S') END AS date_time,
    CASE WHEN event_id % 97 = 11 THEN 'err' ELSE CAST(traffic_volume AS VARCHAR) END AS traffic_volume
  FROM traffic_raw),
typed AS (
  SELECT event_id, holiday, weather_main, weather_description, TRY_CAST(date_time AS TIMESTAMP) AS date_time,
    TRY_CAST(temp AS DOUBLE) AS temp, TRY_CAST(rain_1h AS DOUBLE) AS rain_1h, TRY_CAST(snow_1h AS DOUBLE) AS snow_1h,
    TRY_CAST(clouds_all AS INTEGER) AS clouds_all, TRY_CAST(traffic_volume AS BIGINT) AS traffic_volume
  FROM traffic_text)"""

FILLED = "CASE WHEN holiday IS NULL OR trim(holiday) IN ('', 'None') THEN 'No Holiday' ELSE holiday END"
TITLE = (
    "array_to_string(list_transform(regexp_extract_all(trim(weather_main), '[\\p{L}]+|[^\\p{L}]+'), "
    "lambda part: upper(part[1]) || lower(part[2:])), '')"
)

CTE_CLEAN = f""",
standard AS (
  SELECT DISTINCT event_id, trim({FILLED}) AS holiday, temp, rain_1h, snow_1h, clouds_all,
    {TITLE} AS weather_main, lower(trim(weather_description)) AS weather_description, date_time, traffic_volume
  FROM traffic_raw),
month_medians AS (
  SELECT month(date_time) AS mm, median(temp) FILTER (WHERE temp > 0) AS mt,
    median(rain_1h) FILTER (WHERE rain_1h <= 9000) AS mr FROM standard GROUP BY 1),
all_medians AS (
  SELECT median(temp) FILTER (WHERE temp > 0) AS gt, median(rain_1h) FILTER (WHERE rain_1h <= 9000) AS gr FROM standard),
traffic AS (
  SELECT event_id, holiday, CASE WHEN temp <= 0 THEN coalesce(mt, gt) ELSE temp END AS temp,
    CASE WHEN rain_1h > 9000 THEN coalesce(mr, gr) ELSE rain_1h END AS rain_1h,
    snow_1h, clouds_all, weather_main, weather_description, date_time, traffic_volume
  FROM standard LEFT JOIN month_medians ON month(date_time) = mm CROSS JOIN all_medians)"""

CTE_FEATURES = f""",
edges AS (
  SELECT quantile_cont(traffic_volume, 0.25) AS q1, quantile_cont(traffic_volume, 0.5) AS q2,
    quantile_cont(traffic_volume, 0.75) AS q3, avg(temp) AS mean_temp, stddev_pop(temp) AS scale_temp,
    avg(traffic_volume) AS mean_volume, stddev_pop(traffic_volume) AS scale_volume FROM traffic),
features AS (
  SELECT t.*, CAST(hour(date_time) AS INTEGER) AS hour, CAST(isodow(date_time) - 1 AS INTEGER) AS day_of_week,
    CAST(month(date_time) AS INTEGER) AS month, CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN holiday <> 'No Holiday' THEN 1 ELSE 0 END AS is_holiday,
    CASE WHEN rain_1h > 0 THEN 1 ELSE 0 END AS is_rainy, CASE WHEN snow_1h > 0 THEN 1 ELSE 0 END AS is_snowy,
    CASE WHEN hour(date_time) IN (7, 8, 9, 15, 16, 17, 18) THEN 1 ELSE 0 END AS is_peak_hour,
    CASE WHEN traffic_volume <= q1 THEN 'Low' WHEN traffic_volume <= q2 THEN 'Medium'
         WHEN traffic_volume <= q3 THEN 'High' ELSE 'Severe' END AS congestion_quartile,
    (temp - mean_temp) / scale_temp AS temp_scaled, (traffic_volume - mean_volume) / scale_volume AS traffic_volume_scaled,
    CASE WHEN weather_main IN {ADVERSE} THEN 1 ELSE 0 END AS adverse_weather,
    CASE WHEN isodow(date_time) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
    CASE WHEN rain_1h > 0 THEN 1 ELSE 0 END AS rain_occurrence,
    weather_main AS weather
  FROM traffic t CROSS JOIN edges),
risk AS (
  SELECT *, CASE WHEN congestion_quartile IN ('High', 'Severe') AND adverse_weather = 1 THEN 1 ELSE 0 END AS risk_label
  FROM features)"""


def on_raw(body: str, ctes: str = "") -> str:
    return f"WITH {CTE_RAW}{ctes}\n{body}"


def on_text(body: str, ctes: str = "") -> str:
    return f"WITH {CTE_RAW}{CTE_TEXT}{ctes}\n{body}"


def on_traffic(body: str, ctes: str = "") -> str:
    return f"WITH {CTE_RAW}{CTE_CLEAN}{ctes}\n{body}"


def on_features(body: str, ctes: str = "") -> str:
    return f"WITH {CTE_RAW}{CTE_CLEAN}{CTE_FEATURES}{ctes}\n{body}"


def cyclical(value: str, period: int, name: str) -> str:
    angle = f"2 * pi() * ({value}) / {period}"
    return f"{r(f'sin({angle})', f'{name}_sin')}, {r(f'cos({angle})', f'{name}_cos')}"


ORDERED = "ORDER BY date_time, event_id, weather_main"

# Sources and sinks
ORACLES["csv_scan_raw"] = on_text(f"SELECT event_id::VARCHAR AS event_id, nullif(holiday, '') AS holiday, {', '.join(RAW[1:])} FROM traffic_text")
_broken = "CASE WHEN event_id % 17 = 0 THEN weather_description || chr(10) || 'seen \"twice\", twice' ELSE weather_description END AS weather_description"
ORACLES["csv_records"] = on_text(
    f"SELECT event_id::VARCHAR AS event_id, nullif(holiday, '') AS holiday, {', '.join(_broken if c == 'weather_description' else c for c in RAW[1:])} FROM traffic_text"
)
ORACLES["feature_scan"] = on_features(
    f"SELECT date_time, traffic_volume, {r('temp', 'temp')}, {r('rain_1h', 'rain_1h')}, clouds_all, hour FROM features"
)
ORACLES["table_scan"] = on_traffic(
    "SELECT weather_main, count(*) AS records, CAST(sum(traffic_volume) AS BIGINT) AS total_volume FROM traffic GROUP BY 1"
)
ORACLES["table_sink"] = on_traffic(
    f"SELECT {KEY}, CAST(year(date_time) AS INTEGER) AS year, date_time, traffic_volume FROM traffic"
)
PATTERN_HOUR = (
    "SELECT day_type AS Day_Type, hour, avg(traffic_volume) AS Average_Traffic, "
    "median(traffic_volume) AS Median_Traffic, count(*) AS Observations FROM features GROUP BY 1, 2"
)
PATTERN_WEATHER = (
    "SELECT day_type AS Day_Type, weather AS Weather, hour, avg(traffic_volume) AS Average_Traffic, "
    "median(traffic_volume) AS Median_Traffic, count(*) AS Observations FROM features GROUP BY 1, 2, 3"
)
PATTERN_OUT = f"{r('Average_Traffic', 'Average_Traffic')}, {r('Median_Traffic', 'Median_Traffic')}, Observations"
ORACLES["pattern_hour"] = on_features(f"SELECT Day_Type, hour, {PATTERN_OUT} FROM ({PATTERN_HOUR})")
ORACLES["report_sink"] = ORACLES["pattern_hour"]

# Schema and quality
ORACLES["schema_check"] = on_raw(
    "SELECT count(*) AS rows, 'missing' AS \"check\", 'station' AS \"column\", 'error' AS level FROM traffic_raw "
    "UNION ALL SELECT count(*), 'unexpected', 'event_id', 'warning' FROM traffic_raw"
)
_types = dict(zip(RAW, ["string", "double", "double", "double", "int", "string", "string", "timestamp_ntz", "bigint"]))
ORACLES["table_profile"] = on_raw(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{_types[c]}' AS type, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS row_count FROM traffic_raw"
        for i, c in enumerate(RAW)
    )
)
ORACLES["table_head"] = on_traffic(f"SELECT * FROM traffic {ORDERED} LIMIT 5")
ORACLES["duplicate_count"] = on_raw(
    f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS exact_duplicate_rows FROM "
    f"(SELECT count(*) AS n FROM traffic_raw GROUP BY {', '.join(RAW)} HAVING count(*) > 1)"
)
ORACLES["year_coverage"] = on_raw(
    "SELECT CAST(year(date_time) AS INTEGER) AS year, count(*) AS recorded_hours, min(date_time) AS first_record, "
    "max(date_time) AS last_record FROM traffic_raw GROUP BY 1"
)
ORACLES["date_validity"] = on_text(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE date_time IS NULL) AS invalid_dates, "
    "count(date_time) AS kept_rows FROM typed"
)
ORACLES["numeric_validity"] = on_text(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS invalid_values, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing_values FROM traffic_text"
        for c, t in NUMERIC.items()
    )
)
ORACLES["null_gate"] = on_text(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM typed"
        for c in ["traffic_volume", "temp", "rain_1h", "clouds_all"]
    )
)
ORACLES["one_hot_check"] = on_traffic(
    f"SELECT count(*) AS rows, count(*) FILTER (WHERE weather_main NOT IN {tuple(WEATHER)}) AS invalid_rows FROM traffic"
)
_before = "FROM traffic_text"
_valid = "TRY_CAST(date_time AS TIMESTAMP) IS NOT NULL"
_std = {"holiday": f"trim({FILLED})", "weather_main": TITLE, "weather_description": "lower(trim(weather_description))"}
_prior = {"holiday": FILLED, "weather_main": "weather_main", "weather_description": "weather_description"}
ORACLES["cleaning_audit"] = on_text(
    "SELECT 'fill_missing' AS step, 'holiday' AS \"column\", "
    f"count(*) FILTER (WHERE holiday IS NULL OR trim(holiday) IN ('', 'None')) AS rows_changed {_before} "
    + "".join(
        f"UNION ALL SELECT 'standardise', '{c}', count(*) FILTER (WHERE {_prior[c]} <> {_std[c]}) {_before} "
        for c in _std
    )
    + f"UNION ALL SELECT 'drop_invalid_date', 'date_time', count(*) FILTER (WHERE NOT ({_valid})) {_before} "
    + "".join(
        f"UNION ALL SELECT 'invalid_number', '{c}', count(*) FILTER (WHERE {_valid} AND {c} IS NOT NULL "
        f"AND TRY_CAST({c} AS {t}) IS NULL) {_before} "
        for c, t in NUMERIC.items()
    )
    + "UNION ALL SELECT 'drop_incomplete', 'all', count(*) FROM dated WHERE temp IS NULL OR rain_1h IS NULL OR traffic_volume IS NULL "
    "UNION ALL SELECT 'drop_duplicates', 'all', (SELECT count(*) FROM kept) - (SELECT count(*) FROM once) "
    "UNION ALL SELECT 'impute', 'temp', count(*) FROM once WHERE temp <= 0 "
    "UNION ALL SELECT 'impute', 'rain_1h', count(*) FROM once WHERE rain_1h > 9000",
    f""",
dated AS (SELECT event_id, trim({FILLED}) AS holiday, {TITLE} AS weather_main, lower(trim(weather_description)) AS weather_description,
  date_time, temp, rain_1h, snow_1h, clouds_all, traffic_volume FROM typed WHERE date_time IS NOT NULL),
kept AS (SELECT * FROM dated WHERE temp IS NOT NULL AND rain_1h IS NOT NULL AND traffic_volume IS NOT NULL),
once AS (SELECT DISTINCT * FROM kept)""",
)
ORACLES["range_quarantine"] = on_text(
    f"""SELECT event_id, weather_description, reasons, reasons = '' AS is_valid FROM (
  SELECT event_id, weather_description, concat_ws('; ',
    CASE WHEN date_time IS NULL THEN 'date_time missing' END,
    CASE WHEN temp IS NULL OR temp < 200 OR temp > 350 THEN 'temp outside 200..350' END,
    CASE WHEN coalesce(rain_1h, 0) < 0 THEN 'rain_1h below 0' END,
    CASE WHEN coalesce(snow_1h, 0) < 0 THEN 'snow_1h below 0' END,
    CASE WHEN clouds_all IS NULL OR clouds_all < 0 OR clouds_all > 100 THEN 'clouds_all outside 0..100' END,
    CASE WHEN weather_main IS NULL OR weather_main NOT IN {tuple(WEATHER)} THEN 'weather_main unknown' END) AS reasons
  FROM typed)"""
)
_fillable = ["temp", "rain_1h", "snow_1h", "clouds_all"]
ORACLES["median_fill"] = on_text(
    "SELECT event_id, weather_description, "
    + ", ".join(r(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM typed))", c) for c in _fillable)
    + " FROM typed"
)

# Cleaning
ORACLES["fill_missing_category"] = on_text(f"SELECT event_id, weather_main, {FILLED} AS holiday FROM traffic_text")
ORACLES["standardise_text"] = on_raw(
    f"SELECT event_id, trim({FILLED}) AS holiday, {TITLE} AS weather_main, "
    "lower(trim(weather_description)) AS weather_description FROM traffic_raw"
)
ORACLES["parse_timestamp"] = on_text("SELECT event_id, weather_main, date_time FROM typed")
_numbers = f"{r('temp', 'temp')}, {r('rain_1h', 'rain_1h')}, {r('snow_1h', 'snow_1h')}, clouds_all, traffic_volume"
ORACLES["parse_numeric"] = on_text(f"SELECT event_id, weather_main, {_numbers} FROM typed")
ORACLES["drop_incomplete"] = on_text(
    f"SELECT event_id, weather_main, {_numbers} FROM typed "
    "WHERE temp IS NOT NULL AND rain_1h IS NOT NULL AND traffic_volume IS NOT NULL"
)
ORACLES["drop_exact_duplicates"] = on_raw(
    f"SELECT DISTINCT event_id, holiday, {r('temp', 'temp')}, {r('rain_1h', 'rain_1h')}, {r('snow_1h', 'snow_1h')}, "
    "clouds_all, weather_main, weather_description, date_time, traffic_volume FROM traffic_raw"
)
ORACLES["impute_by_group_median"] = f"""
WITH mm AS (SELECT month(o_orderdate) AS m, median(o_totalprice) AS p FROM orders
            WHERE o_orderpriority <> '1-URGENT' GROUP BY 1),
g AS (SELECT median(o_totalprice) AS p FROM orders WHERE o_orderpriority <> '1-URGENT')
SELECT o_orderkey, {r("CASE WHEN o_orderpriority = '1-URGENT' THEN coalesce(mm.p, g.p) ELSE o_totalprice END", 'o_totalprice', 4)}
FROM orders LEFT JOIN mm ON month(o_orderdate) = m CROSS JOIN g"""
ORACLES["outlier_rules"] = on_traffic(f"SELECT {KEY}, {r('temp', 'temp')}, {r('rain_1h', 'rain_1h')} FROM traffic")
ORACLES["clean_traffic"] = on_traffic(
    f"SELECT event_id, holiday, {r('temp', 'temp')}, {r('rain_1h', 'rain_1h')}, {r('snow_1h', 'snow_1h')}, clouds_all, "
    "weather_main, weather_description, date_time, traffic_volume FROM traffic"
)

# Scalar features
ORACLES["calendar_parts"] = on_traffic(
    f"SELECT {KEY}, CAST(hour(date_time) AS INTEGER) AS hour, CAST(isodow(date_time) - 1 AS INTEGER) AS day_of_week, "
    "CAST(month(date_time) AS INTEGER) AS month, CAST(year(date_time) AS INTEGER) AS year FROM traffic"
)
ORACLES["weekend_flag"] = on_features(f"SELECT {KEY}, is_weekend FROM features")
_hour, _month, _day = (
    cyclical("hour(date_time)", 24, "hour"),
    cyclical("month(date_time) - 1", 12, "month"),
    cyclical("isodow(date_time) - 1", 7, "day_of_week"),
)
ORACLES["cyclical_encode"] = on_traffic(f"SELECT {KEY}, {_hour}, {_month}, {_day} FROM traffic")
ORACLES["indicator_flags"] = on_features(f"SELECT {KEY}, is_holiday, is_rainy, is_snowy, is_peak_hour FROM features")
ORACLES["quartile_category"] = on_features(f"SELECT {KEY}, traffic_volume, congestion_quartile FROM features")
ORACLES["zscore"] = on_features(
    f"SELECT {KEY}, {r('temp', 'temp')}, traffic_volume, {r('temp_scaled', 'temp_scaled')}, "
    f"{r('traffic_volume_scaled', 'traffic_volume_scaled')} FROM features"
)


def flags(categories: list[str]) -> str:
    return ", ".join(f"CASE WHEN weather_main = '{c}' THEN 1 ELSE 0 END AS weather_main_{c}" for c in categories)


ORACLES["one_hot_encode"] = on_traffic(f"SELECT event_id, traffic_volume, {flags(SEEN)} FROM traffic")
ORACLES["one_hot_decode"] = on_traffic("SELECT event_id, traffic_volume, weather_main AS weather FROM traffic")
ORACLES["feature_table"] = on_features(
    f"SELECT event_id, holiday, {r('temp', 'temp')}, {r('rain_1h', 'rain_1h')}, {r('snow_1h', 'snow_1h')}, clouds_all, "
    f"weather_description, date_time, traffic_volume, hour, day_of_week, month, is_weekend, {_hour}, {_month}, "
    f"is_holiday, is_rainy, is_snowy, is_peak_hour, congestion_quartile, {r('temp_scaled', 'temp_scaled')}, "
    f"{r('traffic_volume_scaled', 'traffic_volume_scaled')}, {flags(WEATHER)} FROM features"
)
BAND = "CASE WHEN hour < 6 THEN 'Night' WHEN hour < 12 THEN 'Morning' WHEN hour < 18 THEN 'Afternoon' ELSE 'Evening' END"
ORACLES["time_of_day_band"] = on_features(f"SELECT {KEY}, {BAND} AS time_period FROM features")
ORACLES["label_map"] = on_features(f"SELECT {KEY}, day_type FROM features")
ORACLES["adverse_weather_flag"] = on_features(f"SELECT {KEY}, adverse_weather FROM features")
ORACLES["proxy_risk_label"] = on_features(f"SELECT {KEY}, risk_label FROM risk")
ORACLES["window_text"] = on_features(
    f"SELECT {KEY}, printf('%02d:00 to %02d:00', hour, (hour + 1) % 24) AS travel_window, "
    "printf('%02d:00', hour) AS recommended_time FROM features"
)
ORACLES["shift_transform"] = on_traffic(
    f"SELECT {KEY}, {r('greatest(traffic_volume * 1.35::DOUBLE + 500, 0)', 'traffic_volume')}, {r('temp + 12', 'temp')}, "
    f"least(greatest(clouds_all + 30, 0), 100) AS clouds_all, {r('greatest(rain_1h + 1, 0)', 'rain_1h')} FROM traffic"
)

# Filters
ORACLES["year_range_filter"] = on_traffic(
    f"SELECT {KEY}, date_time, traffic_volume FROM traffic WHERE year(date_time) BETWEEN 2013 AND 2015"
)
ORACLES["category_in_filter"] = on_traffic(
    f"SELECT {KEY}, holiday, date_time FROM traffic WHERE holiday IN ('New Years Day', 'Labor Day')"
)
ORACLES["date_lookup_filter"] = on_traffic(
    f"SELECT {KEY}, date_time, traffic_volume FROM traffic WHERE CAST(date_time AS DATE) = DATE '2013-02-11'"
)
ORACLES["hour_window_filter"] = on_features(
    f"SELECT Day_Type, hour, {PATTERN_OUT} FROM ({PATTERN_HOUR}) WHERE hour >= 6 AND hour < 22"
)
ORACLES["pattern_weather_hour"] = on_features(f"SELECT Day_Type, Weather, hour, {PATTERN_OUT} FROM ({PATTERN_WEATHER})")
ORACLES["min_evidence_filter"] = on_features(
    f"SELECT Day_Type, Weather, hour, {PATTERN_OUT} FROM ({PATTERN_WEATHER}) WHERE Observations >= 30"
)

# Aggregations
ANNUAL = (
    "SELECT CAST(year(date_time) AS INTEGER) AS year, count(*) AS recorded_hours, "
    "CAST(sum(traffic_volume) AS BIGINT) AS total_traffic_volume, avg(traffic_volume) AS average_hourly_volume "
    "FROM traffic WHERE year(date_time) BETWEEN 2012 AND 2017 GROUP BY 1"
)
ORACLES["annual_totals"] = on_traffic(
    f"SELECT year, recorded_hours, total_traffic_volume, {r('average_hourly_volume', 'average_hourly_volume')} FROM ({ANNUAL})"
)
ORACLES["yoy_change"] = on_traffic(
    f"""SELECT * FROM (WITH a AS ({ANNUAL}), pairs AS (SELECT b.year AS later, max(c.year) AS earlier FROM a b JOIN a c ON c.year < b.year GROUP BY 1)
SELECT a.year, a.recorded_hours, a.total_traffic_volume, {r('a.average_hourly_volume', 'average_hourly_volume', 2)},
  a.total_traffic_volume - p.total_traffic_volume AS absolute_change,
  round((a.total_traffic_volume - p.total_traffic_volume) * 100.0::DOUBLE / p.total_traffic_volume, 2) AS percentage_change
FROM a LEFT JOIN pairs ON later = a.year LEFT JOIN a p ON p.year = earlier)"""
)
ORACLES["holiday_comparison"] = on_traffic(
    """SELECT * FROM (WITH seen AS (
  SELECT date_time, holiday, temp AS kelvin, traffic_volume AS volume FROM traffic
  WHERE date_time >= '2015-01-01' AND date_time < '2018-01-01' AND (holiday = 'Labor Day' OR holiday = 'New Years Day')
  GROUP BY ALL)
SELECT holiday, CAST(date_part('year', date_time) AS INTEGER) AS year, count(*) AS unique_observations,
  round(avg(volume), 2) AS average_traffic_volume, round(avg(kelvin), 2) AS average_temperature_kelvin,
  round(avg(kelvin - 273.15::DOUBLE), 2) AS average_temperature_celsius
FROM seen GROUP BY ALL)"""
)
HOURLY = "SELECT hour, is_weekend, avg(traffic_volume) AS v FROM features GROUP BY 1, 2"
ORACLES["hourly_by_daytype"] = on_features(f"SELECT hour, is_weekend, {r('v', 'average_traffic_volume')} FROM ({HOURLY})")
ORACLES["hourly_pivot"] = on_features(
    f"SELECT hour, {r('avg(traffic_volume) FILTER (WHERE is_weekend = 0)', 'weekday')}, "
    f"{r('avg(traffic_volume) FILTER (WHERE is_weekend = 1)', 'weekend')} FROM features GROUP BY hour"
)
PEAKS = f""",
hourly AS ({HOURLY}),
peaks AS (SELECT
  (SELECT hour FROM hourly WHERE is_weekend = 0 AND hour BETWEEN 5 AND 11 ORDER BY v DESC, hour LIMIT 1) AS mh,
  (SELECT max(v) FROM hourly WHERE is_weekend = 0 AND hour BETWEEN 5 AND 11) AS mv,
  (SELECT hour FROM hourly WHERE is_weekend = 0 AND hour BETWEEN 12 AND 20 ORDER BY v DESC, hour LIMIT 1) AS eh,
  (SELECT max(v) FROM hourly WHERE is_weekend = 0 AND hour BETWEEN 12 AND 20) AS evv,
  (SELECT avg(v) FROM hourly WHERE is_weekend = 1 AND hour BETWEEN 12 AND 16) AS wv)"""
ORACLES["hourly_peaks"] = on_features(
    f"SELECT mh AS weekday_morning_hour, {r('mv', 'weekday_morning_value')}, eh AS weekday_evening_hour, "
    f"{r('evv', 'weekday_evening_value')}, {r('wv', 'weekend_plateau_value')}, round_even(mv, -1) AS morning_display, "
    "round_even(evv, -1) AS evening_display, round_even(wv / 50, 0) * 50 AS weekend_display FROM peaks",
    PEAKS,
)
EXTREMES = """,
means AS (SELECT weather, avg(traffic_volume) AS mean, count(*) AS n FROM features GROUP BY 1),
extremes AS (SELECT (SELECT weather FROM means ORDER BY mean DESC, weather LIMIT 1) AS highest,
  (SELECT weather FROM means ORDER BY mean, weather LIMIT 1) AS lowest,
  (SELECT max(mean) - min(mean) FROM means) AS difference,
  (SELECT n FROM means ORDER BY mean, weather LIMIT 1) AS lowest_count)"""
ORACLES["weather_summary"] = on_features(
    f"SELECT highest, lowest, {r('difference', 'difference')}, lowest_count FROM extremes", EXTREMES
)
ORACLES["order_by"] = on_features(
    f"SELECT weather, {r('mean', 'mean')}, n AS count FROM means ORDER BY mean, weather", EXTREMES
)
ORACLES["date_hourly_summary"] = on_features(
    """SELECT hour, average_traffic_volume, busiest_hour, hour = busiest_hour AS is_busiest FROM (
  SELECT *, first_value(hour) OVER (ORDER BY average_traffic_volume DESC, hour) AS busiest_hour FROM (
    SELECT hour, CAST(round_even(avg(traffic_volume), 0) AS BIGINT) AS average_traffic_volume FROM features
    WHERE CAST(date_time AS DATE) = DATE '2013-02-11' GROUP BY hour))"""
)
ORACLES["daytype_summary"] = on_features(
    """SELECT *, max(CASE WHEN day_type = 'Weekday' THEN mean END) OVER () - max(CASE WHEN day_type = 'Weekend' THEN mean END) OVER ()
  AS weekday_minus_weekend FROM (
  SELECT day_type, CAST(round_even(avg(traffic_volume), 0) AS BIGINT) AS mean,
    CAST(round_even(median(traffic_volume), 0) AS BIGINT) AS median, count(*) AS count FROM features GROUP BY 1)"""
)
GIVEN = """,
given AS (SELECT *, CAST(CASE WHEN rain_1h >= 3 THEN 8 WHEN snow_1h >= 0.4 THEN 9 ELSE
  CASE congestion_quartile WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END + adverse_weather * 4 END AS INTEGER) AS cluster
  FROM features),
profiles AS (SELECT cluster, count(*) AS records, avg(hour) AS average_hour, avg(traffic_volume) AS average_traffic,
  avg(temp) AS average_temperature, avg(rain_1h) AS average_rainfall, avg(snow_1h) AS average_snowfall,
  avg(clouds_all) AS average_cloud_cover, avg(adverse_weather) AS adverse_weather_rate, avg(is_weekend) AS weekend_rate,
  100.0::DOUBLE * count(*) / (SELECT count(*) FROM given) AS record_percentage FROM given GROUP BY cluster)"""
_profile = [
    "average_hour", "average_traffic", "average_temperature", "average_rainfall", "average_snowfall",
    "average_cloud_cover", "adverse_weather_rate", "weekend_rate", "record_percentage",
]
ORACLES["cluster_profiles"] = on_features(
    f"SELECT cluster, records, {', '.join(r(c, c) for c in _profile)} FROM profiles", GIVEN
)
ORACLES["cluster_naming"] = on_features(
    """SELECT cluster, records, CASE WHEN average_rainfall >= 2 THEN 'Rare heavy-rain traffic'
  WHEN average_snowfall >= 0.1 THEN 'Rare cold-and-snow traffic'
  WHEN adverse_weather_rate >= 0.5 THEN 'Adverse-weather moderate-demand traffic'
  WHEN average_traffic >= (SELECT avg(traffic_volume) FROM features) THEN 'High-demand normal-weather traffic'
  ELSE 'Low-demand normal-weather traffic' END AS cluster_name FROM profiles""",
    GIVEN,
)
ORACLES["label_balance"] = on_features(
    f"SELECT risk_label, count(*) AS records, {r('100.0::DOUBLE * count(*) / (SELECT count(*) FROM risk)', 'percentage', 2)} "
    "FROM risk GROUP BY 1"
)
KPI = (
    "count(*) AS records, CAST(sum(traffic_volume) AS BIGINT) AS total_volume, "
    f"{r('avg(traffic_volume)', 'average_volume')}, max(traffic_volume) AS peak_volume"
)
ORACLES["kpi_cards"] = on_features(
    f"SELECT {KPI} FROM features WHERE is_peak_hour = 1 AND weather IN ('Clear', 'Clouds')"
)
ORACLES["daily_trend"] = on_traffic(
    f"SELECT CAST(date_time AS DATE) AS day, CAST(sum(traffic_volume) AS BIGINT) AS total_volume, "
    f"{r('avg(traffic_volume)', 'average_volume')} FROM traffic GROUP BY 1"
)
ORACLES["temperature_profile"] = on_traffic(
    f"SELECT floor(temp / 5) * 5.0 AS temp_bin, {r('avg(traffic_volume)', 'average_volume')}, count(*) AS records "
    "FROM traffic GROUP BY 1"
)
ORACLES["describe_measure"] = on_traffic(
    "SELECT "
    + ", ".join(
        r(e, n, 4)
        for n, e in {
            "mean": "avg(traffic_volume)", "std_sample": "stddev_samp(traffic_volume)",
            "std_population": "stddev_pop(traffic_volume)", "var_sample": "var_samp(traffic_volume)",
            "var_population": "var_pop(traffic_volume)", "median": "median(traffic_volume)",
        }.items()
    )
    + ", max(traffic_volume) - min(traffic_volume) AS value_range FROM traffic"
)
ORACLES["pearson_corr"] = on_traffic(f"SELECT {r('corr(temp, traffic_volume)', 'correlation')} FROM traffic")
_jam, _clear, _warm = "traffic_volume > 5500", "weather = 'Clear'", "temp > 292"
PROBABILITIES = f""",
p AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE {_jam})::DOUBLE AS jam, count(*) FILTER (WHERE {_clear})::DOUBLE AS clear,
  count(*) FILTER (WHERE {_jam} AND {_clear})::DOUBLE AS both_, count(*) FILTER (WHERE {_jam} AND {_warm})::DOUBLE AS jam_warm,
  count(*) FILTER (WHERE {_clear} AND NOT {_jam})::DOUBLE AS clear_free,
  count(*) FILTER (WHERE weather = 'Clouds' AND {_jam})::DOUBLE AS cloud_jam,
  count(*) FILTER (WHERE weather = 'Clouds' AND NOT {_jam})::DOUBLE AS cloud_free FROM features)"""
ORACLES["event_probabilities"] = on_features(
    "SELECT " + ", ".join([
        r("jam / n", "p_congestion"), r("clear / n", "p_clear"), r("both_ / n", "p_congestion_and_clear"),
        r("both_ / nullif(jam, 0)", "p_clear_given_congestion"), r("jam_warm / nullif(jam, 0)", "p_warm_given_congestion"),
    ]) + " FROM p",
    PROBABILITIES,
)
ORACLES["independence_check"] = on_features(
    f"SELECT {r('both_ / n', 'p_joint')}, {r('(jam / n) * (clear / n)', 'p_product')}, "
    f"{r('both_ / n - (jam / n) * (clear / n)', 'difference')} FROM p",
    PROBABILITIES,
)
_o1, _o2 = "both_ / nullif(clear_free, 0)", "cloud_jam / nullif(cloud_free, 0)"
ORACLES["odds_ratio"] = on_features(
    f"SELECT {r(_o1, 'odds_first')}, {r(_o2, 'odds_second')}, {r(f'({_o1}) / nullif({_o2}, 0)', 'odds_ratio')} FROM p",
    PROBABILITIES,
)
ORACLES["skewness_adjusted"] = on_traffic(f"SELECT {r('skewness(traffic_volume)', 'skewness')} FROM traffic")
HISTOGRAM = """,
span AS (SELECT min(traffic_volume)::DOUBLE AS lo, max(traffic_volume)::DOUBLE AS hi FROM traffic),
placed AS (SELECT least(CAST(floor((traffic_volume - lo) * 35 / (hi - lo)) AS INTEGER) + 1, 35) AS bin, count(*) AS n
  FROM traffic CROSS JOIN span GROUP BY 1),
bins AS (SELECT CAST(b AS INTEGER) AS bin, lo + (b - 1) * (hi - lo) / 35 AS left_edge, lo + b * (hi - lo) / 35 AS right_edge,
  coalesce(n, 0) AS records FROM span CROSS JOIN range(1, 36) AS g(b) LEFT JOIN placed ON placed.bin = b),
mode AS (SELECT bin, left_edge, right_edge, (SELECT median(traffic_volume) FROM traffic) AS median FROM bins
  ORDER BY CASE WHEN left_edge > (SELECT median(traffic_volume) FROM traffic) THEN records ELSE 0 END DESC, bin LIMIT 1)"""
ORACLES["histogram"] = on_traffic(
    f"SELECT bin, {r('left_edge', 'left_edge')}, {r('right_edge', 'right_edge')}, records FROM bins", HISTOGRAM
)
ORACLES["histogram_mode_above_median"] = on_traffic(
    f"SELECT bin, {r('left_edge', 'mode_low')}, {r('right_edge', 'mode_high')}, {r('median', 'median')} FROM mode", HISTOGRAM
)


def whole(value: str) -> str:
    return f"format('{{:,}}', CAST(round_even({value}, 0) AS BIGINT))"


ORACLES["narrative_text"] = on_features(
    f"""SELECT 1 AS line_no, printf('Weekday traffic peaks around %02d:00 (~%s) and again at %02d:00 (~%s); '
  || 'weekend traffic holds a plateau of about %s from midday to late afternoon.',
  mh, {whole('round_even(mv, -1)')}, eh, {whole('round_even(evv, -1)')}, {whole('round_even(wv / 50, 0) * 50')}) AS line FROM peaks
UNION ALL SELECT 2, 'Beside the low-traffic readings, volumes concentrate between ' || {whole('left_edge')} || ' and ' || {whole('right_edge')}
  || '; the mean is ' || {whole('(SELECT avg(traffic_volume) FROM traffic)')} || ', the median ' || {whole('median')}
  || ' and the skewness ' || printf('%.3f', (SELECT round_even(skewness(traffic_volume), 3) FROM traffic)) || '.' FROM mode
UNION ALL SELECT 3, highest || ' has the highest average traffic and ' || lowest || ' the lowest, a difference of about '
  || {whole('difference')} || ' vehicles; the lowest rests on ' || lowest_count || ' records.' FROM extremes""",
    PEAKS + HISTOGRAM + EXTREMES,
)
ORACLES["cutoff_summary"] = on_features(
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, {r(e, 'value')} FROM edges"
        for n, e in {
            "q1": "q1", "q2": "q2", "q3": "q3", "mean_temp": "mean_temp", "scale_temp": "scale_temp",
            "mean_traffic_volume": "mean_volume", "scale_traffic_volume": "scale_volume",
        }.items()
    )
)

# Windows, order, sets
ORACLES["top_n_per_group"] = on_features(
    f"SELECT hour, is_weekend, {r('v', 'average_traffic_volume')}, CAST(rank AS INTEGER) AS rank FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY is_weekend ORDER BY v, hour) AS rank FROM ({HOURLY})) WHERE rank <= 3"
)
ORACLES["quiet_hours"] = on_features(
    f"""SELECT CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type, CAST(rank AS INTEGER) AS rank,
  printf('%02d:00', hour) AS recommended_time, CAST(round_even(v, 0) AS BIGINT) AS average_traffic_volume FROM (
  SELECT *, row_number() OVER (PARTITION BY is_weekend ORDER BY v, hour) AS rank FROM ({HOURLY})) WHERE rank <= 3"""
)
RUNS = """
WITH runs AS (SELECT o_orderkey AS run_id, 'run_' || o_orderkey AS run_name, 'v' || substr(o_orderpriority, 1, 1) AS solution_version,
  CASE WHEN o_custkey % 10 <> 0 THEN 'model_' || o_custkey END AS model_version, o_orderstatus AS candidate_status,
  'orders_v1' AS data_version, o_orderpriority AS model_type, 'chronological' AS split_method, o_totalprice AS mae,
  o_totalprice / 1000000 AS r2, 'FINISHED' AS status, CAST(o_orderdate AS TIMESTAMP) AS start_time FROM orders),
newest AS (SELECT * FROM runs WHERE model_version IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY start_time DESC, run_id DESC) = 1)
"""
ORACLES["latest_per_key"] = RUNS + "SELECT model_version AS key, run_id, run_name, start_time FROM newest"
ORACLES["experiment_runs"] = RUNS + (
    "SELECT run_id, run_name, status, start_time, solution_version, model_version, candidate_status, data_version, "
    f"model_type, split_method, {r('mae', 'mae', 9)}, {r('r2', 'r2', 9)} FROM runs"
)
ORACLES["run_comparison"] = RUNS + (
    "SELECT solution_version AS Solution_Version, model_version AS Model_Version, candidate_status AS Candidate_Status, "
    "data_version AS Data_Version, run_name AS Run, round_even(mae, 4) AS MAE, round_even(r2, 4) AS R2, "
    "model_type AS Model_Type, split_method AS Split_Method, status AS Status FROM newest ORDER BY 1, 2"
)
ORACLES["share_of_total"] = on_traffic(
    f"SELECT weather_main, count(*) AS records, {r('100.0::DOUBLE * count(*) / (SELECT count(*) FROM traffic)', 'record_percentage')} "
    "FROM traffic GROUP BY 1"
)
ORACLES["top_k_measure"] = on_features(
    "SELECT strftime(date_time, '%Y-%m-%d %H:%M') AS date_time, traffic_volume, congestion_quartile FROM ("
    "SELECT * FROM features ORDER BY traffic_volume DESC, date_time, event_id, weather_main LIMIT 20)"
)
ORACLES["bottom_k_windows"] = on_features(
    f"SELECT Day_Type, hour, {PATTERN_OUT} FROM (SELECT * FROM ({PATTERN_HOUR}) WHERE Day_Type = 'Weekday' "
    "ORDER BY Average_Traffic, hour LIMIT 5)"
)
ORACLES["distinct_rows"] = on_traffic(f"SELECT DISTINCT date_time, holiday, {r('temp', 'temp')}, traffic_volume FROM traffic")
ORACLES["union_results"] = on_features(
    f"SELECT {KPI}, 'Weekday' AS day_type, 0 AS position FROM features WHERE is_weekend = 0 "
    f"UNION ALL SELECT {KPI}, 'Weekend', 1 FROM features WHERE is_weekend = 1"
)

# Splits and samples
SPAN = 16**13
ORACLES["random_split"] = on_traffic(f"SELECT {KEY}, {ROW_HASH} < {int(0.8 * SPAN)} AS is_train FROM traffic")
ORACLES["stratified_split"] = on_features(
    f"""SELECT {KEY}, risk_label, row_number() OVER (PARTITION BY risk_label ORDER BY {ROW_HASH}, event_id, weather_main)
  <= floor(0.8 * count(*) OVER (PARTITION BY risk_label)) AS is_train FROM risk"""
)
ORACLES["chronological_split"] = on_traffic(
    f"SELECT date_time, {KEY}, row_number() OVER ({ORDERED}) <= floor(0.8 * count(*) OVER ()) AS is_train FROM traffic"
)
ORACLES["fixed_size_sample"] = on_traffic(
    f"SELECT {KEY}, traffic_volume FROM traffic ORDER BY {ROW_HASH}, event_id, weather_main LIMIT 5000"
)

# Evaluation
SCORES = """
WITH scored AS (SELECT l.doc_id, l.quality, d.n_chars / (SELECT max(n_chars)::DOUBLE FROM documents) AS score
  FROM labels l JOIN documents d USING (doc_id)),
judged AS (SELECT *, CASE WHEN score >= 0.05 THEN 1 ELSE 0 END AS predicted FROM scored),
confusion AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality = 1 AND predicted = 1)::DOUBLE AS tp,
  count(*) FILTER (WHERE quality <> 1 AND predicted = 1)::DOUBLE AS fp,
  count(*) FILTER (WHERE quality = 1 AND predicted <> 1)::DOUBLE AS fn,
  count(*) FILTER (WHERE quality <> 1 AND predicted <> 1)::DOUBLE AS tn FROM judged)
"""
ORACLES["classification_metrics"] = SCORES + (
    f"SELECT n AS rows, {r('coalesce((tp + tn) / nullif(n, 0), 0)', 'accuracy')}, "
    f"{r('coalesce(tp / nullif(tp + fp, 0), 0)', 'precision')}, {r('coalesce(tp / nullif(tp + fn, 0), 0)', 'recall')}, "
    f"{r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)', 'f1')} FROM confusion"
)
ORACLES["roc_auc"] = SCORES + (
    "SELECT " + r(
        "sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*)", "roc_auc"
    ) + " FROM (SELECT score FROM scored WHERE quality = 1) p CROSS JOIN (SELECT score FROM scored WHERE quality <> 1) n"
)
ORACLES["roc_curve"] = SCORES + f"""
SELECT 'Infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT {r('t.score', 'threshold', 9)},
  {r('(SELECT count(*) FROM scored s WHERE s.score >= t.score AND quality <> 1)::DOUBLE / (SELECT count(*) FROM scored WHERE quality <> 1)', 'fpr', 9)},
  {r('(SELECT count(*) FROM scored s WHERE s.score >= t.score AND quality = 1)::DOUBLE / (SELECT count(*) FROM scored WHERE quality = 1)', 'tpr', 9)}
FROM (SELECT DISTINCT score FROM scored) t"""
PREDICTED = """,
predicted AS (SELECT *, CAST(year(date_time) AS INTEGER) AS year, avg(traffic_volume) OVER (PARTITION BY is_weekend, hour) AS by_hour,
  avg(traffic_volume) OVER (PARTITION BY is_weekend) AS by_day, avg(traffic_volume) OVER () AS overall FROM features)"""


def errors(prediction: str) -> str:
    error = f"(traffic_volume - {prediction})"
    return (
        f"count(*) AS rows, {r(f'avg(abs({error}))', 'mae')}, "
        f"{r(f'1 - sum({error} * {error}) / (var_pop(traffic_volume) * count(*))', 'r2')}, {r(f'avg(-{error})', 'bias')}"
    )


ORACLES["regression_metrics"] = on_features(f"SELECT {errors('by_hour')} FROM predicted", PREDICTED)
ORACLES["model_leaderboard"] = on_features(
    "SELECT *, model = first_value(model) OVER (ORDER BY mae, model) AS is_best FROM ("
    + " UNION ALL ".join(f"SELECT '{m}' AS model, {errors(m)} FROM predicted" for m in ["by_hour", "by_day", "overall"])
    + ")",
    PREDICTED,
)
ORACLES["subgroup_errors"] = on_features(
    " UNION ALL ".join(
        f"SELECT '{s}' AS slice, CAST({s} AS VARCHAR) AS value, count(*) AS rows, "
        f"{r('avg(abs(traffic_volume - by_hour))', 'mae')}, {r('avg(by_hour - traffic_volume)', 'bias')} FROM predicted GROUP BY {s}"
        for s in ["is_weekend", "is_peak_hour", "weather", "is_holiday", "year", "congestion_quartile"]
    ),
    PREDICTED,
)

# Clusters
ORACLES["silhouette"] = f"""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
cells AS (SELECT label, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v),
sums AS (SELECT label, list(x ORDER BY i) AS s FROM (SELECT label, i, sum(x) AS x FROM cells GROUP BY 1, 2) GROUP BY 1),
norms AS (SELECT label, count(*) AS n, sum(list_dot_product(e, e)) AS q FROM v GROUP BY 1),
total AS (SELECT vec_id, v.label, c.label AS other, n, n * list_dot_product(e, e) + q - 2 * list_dot_product(e, c.s) AS t
  FROM v CROSS JOIN (SELECT * FROM sums JOIN norms USING (label)) c),
each AS (SELECT vec_id, max(CASE WHEN label = other THEN t / greatest(n - 1, 1) END) AS a, max(CASE WHEN label = other THEN n END) AS n,
  min(CASE WHEN label <> other THEN t / n END) AS b FROM total GROUP BY 1)
SELECT {r('avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END)', 'silhouette')}, count(*) AS rows FROM each"""

# Rules
ITEMS = f""",
tx AS MATERIALIZED (SELECT 'Time=' || {BAND} AS t, 'Day=' || day_type AS d, 'Weather=' || weather AS w, 'Congestion=' || congestion_quartile AS c FROM features),
cubed AS MATERIALIZED (SELECT c, d, t, w, (c IS NOT NULL)::INTEGER + 2 * (d IS NOT NULL)::INTEGER + 4 * (t IS NOT NULL)::INTEGER
    + 8 * (w IS NOT NULL)::INTEGER AS mask, count(*) AS records, count(*) / (SELECT count(*) FROM tx)::DOUBLE AS support
  FROM tx GROUP BY CUBE (c, d, t, w)),
itemsets AS MATERIALIZED (SELECT *, concat_ws(', ', c, d, t, w) AS itemset FROM cubed WHERE mask > 0 AND support >= 0.02),
splits AS MATERIALIZED (SELECT a.itemset AS antecedents, q.itemset AS consequents, a.support AS sa, q.support AS sc, j.support AS s,
    a.mask AS am, q.mask AS cm
  FROM itemsets j
  JOIN itemsets a ON (a.mask & j.mask) = a.mask AND a.mask < j.mask AND (a.c IS NULL OR a.c = j.c) AND (a.d IS NULL OR a.d = j.d)
    AND (a.t IS NULL OR a.t = j.t) AND (a.w IS NULL OR a.w = j.w)
  JOIN itemsets q ON q.mask = j.mask - a.mask AND (q.c IS NULL OR q.c = j.c) AND (q.d IS NULL OR q.d = j.d)
    AND (q.t IS NULL OR q.t = j.t) AND (q.w IS NULL OR q.w = j.w)),
measured AS (SELECT *, s / sa AS conf, s / sa / sc AS lift, s - sa * sc AS lev, greatest(s * (1 - sa), sa * (sc - s)) AS spread FROM splits),
rules AS (SELECT * FROM measured WHERE lift >= 1)"""
ORACLES["basket_build"] = on_features(
    "SELECT concat_ws(', ', c, d, t, w) AS basket, count(*) AS records FROM tx GROUP BY 1", ITEMS
)
ORACLES["frequent_itemsets"] = on_features(
    f"SELECT itemset, bit_count(mask)::INTEGER AS size, records, {r('support', 'support')} FROM itemsets", ITEMS
)
ORACLES["association_rules"] = on_features(
    "SELECT antecedents, consequents, " + ", ".join([
        r("sa", "antecedent_support"), r("sc", "consequent_support"), r("s", "support"), r("conf", "confidence"),
        r("lift", "lift"), "1.0::DOUBLE AS representativity", r("lev", "leverage"),
        r("CASE WHEN conf >= 1 THEN 'Infinity'::DOUBLE ELSE (1 - sc) / (1 - conf) END", "conviction"),
        r("CASE WHEN spread = 0 THEN 0 ELSE lev / spread END", "zhangs_metric"), r("s / (sa + sc - s)", "jaccard"),
        r("CASE WHEN sc >= 1 THEN 0 ELSE (conf - sc) / (1 - sc) END", "certainty"), r("(conf + s / sc) / 2", "kulczynski"),
    ]) + " FROM rules",
    ITEMS,
)
_three = f"{r('s', 'support')}, {r('conf', 'confidence')}, {r('lift', 'lift')}"
ORACLES["rule_filter"] = on_features(f"SELECT antecedents, consequents, {_three} FROM rules WHERE cm = 1", ITEMS)
ORACLES["congestion_rules"] = on_features(
    f"SELECT antecedents AS Antecedent, consequents AS Consequent, {_three} FROM (SELECT * FROM rules WHERE cm = 1 "
    "ORDER BY lift DESC, conf DESC, s DESC, antecedents, consequents LIMIT 10)",
    ITEMS,
)

# Recommendations
RECOMMEND = f""",
by_weather AS (SELECT * FROM ({PATTERN_WEATHER}) WHERE Observations >= 30),
by_day AS ({PATTERN_HOUR}),
specific AS (SELECT q.*, p.hour, Average_Traffic, Median_Traffic, Observations,
  row_number() OVER (PARTITION BY Scenario ORDER BY Average_Traffic, p.hour) AS rank, count(*) OVER (PARTITION BY Scenario) AS n
  FROM requests q JOIN by_weather p ON q.day_type = p.Day_Type AND q.weather = p.Weather AND p.hour >= 6 AND p.hour < 22),
general AS (SELECT q.*, p.hour, Average_Traffic, Median_Traffic, Observations,
  row_number() OVER (PARTITION BY Scenario ORDER BY Average_Traffic, p.hour) AS rank
  FROM requests q JOIN by_day p ON q.day_type = p.Day_Type AND p.hour >= 6 AND p.hour < 22
  WHERE Scenario NOT IN (SELECT Scenario FROM specific WHERE n >= 3)),
answers AS (
  SELECT Scenario, day_type, weather, hour, Average_Traffic, Median_Traffic, Observations,
    'Day type and weather-specific historical pattern' AS basis FROM specific WHERE n >= 3 AND rank <= 3
  UNION ALL SELECT Scenario, day_type, weather, hour, Average_Traffic, Median_Traffic, Observations,
    'Day-type historical pattern; weather-specific sample was insufficient' FROM general WHERE rank <= 3)"""
ANSWERS = """SELECT Scenario, day_type AS Selected_Day_Type, weather AS Selected_Weather,
  printf('%02d:00 to %02d:00', hour, (hour + 1) % 24) AS Travel_Window, round_even(Average_Traffic, 1) AS Average_Traffic,
  round_even(Median_Traffic, 1) AS Median_Traffic, Observations, basis AS Evidence_Basis,
  printf('Consider travelling between %02d:00 to %02d:00. Historical average traffic was approximately %d vehicles per hour.',
    hour, (hour + 1) % 24, CAST(round_even(Average_Traffic, 0) AS BIGINT)) AS Recommendation FROM answers"""
ORACLES["recommend_windows"] = on_features(
    ANSWERS, ",\nrequests AS (SELECT DISTINCT day_type || ' ' || weather AS Scenario, day_type, weather FROM features)" + RECOMMEND
)
ORACLES["recommend_scenarios"] = on_features(
    ANSWERS,
    """,
requests AS (SELECT * FROM (VALUES ('Weekday travel during rain', 'Weekday', 'Rain'),
  ('Weekend travel in clear weather', 'Weekend', 'Clear'), ('Weekday travel during squall conditions', 'Weekday', 'Squall'))
  AS q(Scenario, day_type, weather))""" + RECOMMEND,
)
ORACLES["recommend_unknown"] = ORACLES["recommend_scenarios"].replace(
    "Recommendation FROM answers", "Recommendation, true AS Answered FROM answers"
) + """
UNION ALL SELECT 'Weekend travel in a tornado', 'Weekend', 'Tornado', NULL, NULL, NULL, NULL,
  'No historical observation of this weather', NULL, false"""

# Drift
ORACLES["occurrence_recode"] = on_features(f"SELECT {KEY}, rain_occurrence FROM features")
_monitored = ["traffic_volume", "temp", "rain_occurrence", "clouds_all", "hour"]
_names = ", ".join(f"'{m}'" for m in _monitored)
_values = ", ".join(f"{m}::DOUBLE" for m in _monitored)


def long(table: str, extra: str = "") -> str:
    return f"SELECT {extra}unnest([{_names}]) AS feature, unnest([{_values}]) AS v FROM {table}"


REFERENCE = f""",
ranked AS (SELECT *, row_number() OVER ({ORDERED}) AS rn FROM features),
reference AS (SELECT * FROM ranked WHERE rn <= floor(0.8 * (SELECT count(*) FROM features))),
ref_long AS ({long('reference')}),
quantiles AS (SELECT feature, unnest(quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e FROM ref_long GROUP BY 1),
distinct_edges AS (SELECT DISTINCT feature, e FROM quantiles),
sized AS (SELECT feature, count(*) AS n, min(e) AS lo, max(e) AS hi FROM distinct_edges GROUP BY 1),
bin_edges AS (
  SELECT feature, e AS edge, row_number() OVER (PARTITION BY feature ORDER BY e) AS position, n AS edges FROM distinct_edges JOIN sized USING (feature) WHERE n >= 3
  UNION ALL SELECT feature, CASE WHEN lo = hi THEN lo - 0.5 + i / 10.0::DOUBLE ELSE lo + (hi - lo) * i / 10.0::DOUBLE END, i + 1, 11
  FROM sized CROSS JOIN range(0, 11) AS g(i) WHERE n < 3)"""
BINNED = """,
inner_edges AS (SELECT feature, edge FROM bin_edges WHERE position > 1 AND position < edges),
ref_values AS (SELECT feature, v, count(*) AS n FROM ref_long GROUP BY 1, 2),
cur_values AS (SELECT grp, feature, v, count(*) AS n FROM cur_long GROUP BY 1, 2, 3),
ref_binned AS (SELECT feature, v, n, 1 + (SELECT count(*) FROM inner_edges i WHERE i.feature = r.feature AND i.edge <= r.v) AS bin FROM ref_values r),
cur_binned AS (SELECT grp, feature, v, n, 1 + (SELECT count(*) FROM inner_edges i WHERE i.feature = c.feature AND i.edge <= c.v) AS bin FROM cur_values c),
ref_share AS (SELECT feature, bin, sum(n)::DOUBLE / sum(sum(n)) OVER (PARTITION BY feature) AS p FROM ref_binned GROUP BY 1, 2),
cur_share AS (SELECT grp, feature, bin, sum(n)::DOUBLE / sum(sum(n)) OVER (PARTITION BY grp, feature) AS p FROM cur_binned GROUP BY 1, 2, 3),
ref_mean AS (SELECT feature, avg(v) AS reference_mean FROM ref_long GROUP BY 1),
cur_mean AS (SELECT grp, feature, avg(v) AS current_mean, count(*) AS current_rows FROM cur_long GROUP BY 1, 2),
every_bin AS (SELECT grp, m.feature, position AS bin FROM cur_mean m JOIN bin_edges b ON m.feature = b.feature AND position < edges),
indexes AS (SELECT e.grp, e.feature, sum((coalesce(c.p, 0.0001::DOUBLE) - coalesce(r.p, 0.0001::DOUBLE))
    * ln(coalesce(c.p, 0.0001::DOUBLE) / coalesce(r.p, 0.0001::DOUBLE))) AS psi
  FROM every_bin e LEFT JOIN ref_share r ON r.feature = e.feature AND r.bin = e.bin
  LEFT JOIN cur_share c ON c.grp = e.grp AND c.feature = e.feature AND c.bin = e.bin GROUP BY 1, 2),
scores AS (SELECT i.grp, i.feature, reference_mean, current_mean, current_rows, psi FROM indexes i
  JOIN ref_mean USING (feature) JOIN cur_mean c ON c.grp = i.grp AND c.feature = i.feature)"""
ORACLES["psi_bin_edges"] = on_features(
    f"SELECT feature, CAST(position - 1 AS INTEGER) AS position, {r('edge', 'edge')} FROM bin_edges", REFERENCE
)
SHIFT = (
    "greatest(traffic_volume * 1.35::DOUBLE + 500, 0) AS traffic_volume, temp + 12 AS temp, "
    "least(greatest(clouds_all + 30, 0), 100) AS clouds_all, greatest(rain_1h + 1, 0) AS rain_1h"
)
MOVED = f""",
moved AS (SELECT is_weekend AS grp, hour, 1 AS rain_occurrence, {SHIFT} FROM features WHERE year(date_time) BETWEEN 2015 AND 2017),
cur_long AS ({long('moved', 'grp, ')})"""
ORACLES["psi"] = on_features(
    f"SELECT grp AS is_weekend, feature, {r('reference_mean', 'reference_mean')}, {r('current_mean', 'current_mean')}, "
    f"current_rows, {r('psi', 'psi')} FROM scores",
    REFERENCE + MOVED + BINNED,
)
ORACLES["sketched_reference"] = on_features("SELECT grp AS is_weekend, feature, true AS within_bound FROM scores", REFERENCE + MOVED + BINNED)
SAMPLED = f""",
sample_rows AS (SELECT * FROM reference),
scenario_rows AS (
  SELECT 'Normal simulated sample' AS grp, {KEY}, traffic_volume::DOUBLE AS traffic_volume, temp, clouds_all, rain_1h, hour,
    rain_occurrence FROM sample_rows
  UNION ALL SELECT 'Shifted alert-test sample', {KEY}, traffic_volume, temp, clouds_all, rain_1h, hour,
    CASE WHEN rain_1h > 0 THEN 1 ELSE 0 END FROM (SELECT event_id, weather_main, hour, {SHIFT} FROM sample_rows)),
cur_long AS ({long('scenario_rows', 'grp, ')})"""
JUDGED = """,
judged AS (SELECT grp AS Scenario, feature AS Feature, round_even(reference_mean, 4) AS Reference_Mean,
  round_even(current_mean, 4) AS Current_Mean, round_even(psi, 4) AS PSI,
  CASE WHEN psi < 0.10 THEN 'No material drift' WHEN psi < 0.20 THEN 'Moderate change' ELSE 'Material drift' END AS Drift_Level,
  CASE WHEN psi >= 0.20 THEN 'ALERT' ELSE 'PASS' END AS Feature_Status, 0.2::DOUBLE AS Threshold FROM scores),
report AS (SELECT *, CASE WHEN max((Feature_Status = 'ALERT')::INTEGER) OVER (PARTITION BY Scenario) = 1
  THEN 'ALERT / Requires investigation' ELSE 'PASS / Normal' END AS Overall_Status FROM judged)"""
ORACLES["drift_scenarios"] = on_features(
    f"SELECT grp AS Scenario, {KEY}, {r('traffic_volume', 'traffic_volume')}, {r('temp', 'temp')}, clouds_all, "
    f"{r('rain_1h', 'rain_1h')}, hour, rain_occurrence FROM scenario_rows",
    REFERENCE + SAMPLED,
)
ORACLES["drift_report"] = on_features("SELECT * FROM report", REFERENCE + SAMPLED + BINNED + JUDGED)
ORACLES["any_alert_broadcast"] = on_features(
    "SELECT Scenario, Feature, Feature_Status, Overall_Status FROM report", REFERENCE + SAMPLED + BINNED + JUDGED
)
_position = "list_position(['traffic_volume', 'temp', 'rain_occurrence', 'clouds_all', 'hour'], Feature)"
_block = "CASE WHEN Scenario LIKE 'Normal%' THEN 0 ELSE 7 END"
ORACLES["text_summary_sink"] = on_features(
    f"""SELECT CAST({_block} + 1 AS INTEGER) AS line_no, Scenario || ': ' || max(Overall_Status) AS line FROM report GROUP BY Scenario
UNION ALL SELECT CAST({_block} + 1 + {_position} AS INTEGER),
  printf('  %s: PSI=%.4f, %s, %s', Feature, PSI, Drift_Level, Feature_Status) FROM report
UNION ALL SELECT DISTINCT CAST({_block} + 7 AS INTEGER), '' FROM report""",
    REFERENCE + SAMPLED + BINNED + JUDGED,
)
WINDOWED = f""",
watched AS (SELECT date_trunc('day', date_time) AS grp, traffic_volume, temp, clouds_all, CAST(hour(date_time) AS INTEGER) AS hour,
  CASE WHEN rain_1h > 0 THEN 1 ELSE 0 END AS rain_occurrence FROM traffic_raw),
cur_long AS ({long('watched', 'grp, ')})"""
WINDOW_OUT = (
    "SELECT grp AS window_start, grp + INTERVAL 1 DAY AS window_end, feature, current_rows AS records, "
    f"{r('current_mean', 'current_mean')}, {r('psi', 'psi')}, "
    "CASE WHEN psi < 0.10 THEN 'No material drift' WHEN psi < 0.20 THEN 'Moderate change' ELSE 'Material drift' END AS drift_level, "
    "CASE WHEN psi >= 0.20 THEN 'ALERT' ELSE 'PASS' END AS feature_status FROM scores"
)
ORACLES["drift_windows"] = on_features(WINDOW_OUT, REFERENCE + WINDOWED + BINNED)
# The watermark, one hour behind the newest row, has passed the end of a closed window.
ORACLES["drift_stream"] = on_features(
    f"{WINDOW_OUT} WHERE grp + INTERVAL 1 DAY <= (SELECT max(date_time) FROM traffic_raw) - INTERVAL 1 HOUR",
    REFERENCE + WINDOWED + BINNED,
)

# Scoring
ORACLES["score_features"] = on_raw(
    "SELECT event_id, " + ", ".join(
        [r("temp", "temp"), r("rain_1h", "rain_1h"), r("snow_1h", "snow_1h"), "clouds_all::DOUBLE AS clouds_all",
         "CASE WHEN holiday IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0 END AS is_holiday",
         "CASE WHEN isodow(date_time) >= 6 THEN 1.0::DOUBLE ELSE 0.0 END AS is_weekend", _hour, _day, _month]
        + [f"CASE WHEN {TITLE} = '{c}' THEN 1.0::DOUBLE ELSE 0.0 END AS weather_main_{c}" for c in WEATHER]
    ) + f" FROM traffic_raw WHERE temp BETWEEN 200 AND 350 AND clouds_all BETWEEN 0 AND 100 AND {TITLE} IN {tuple(WEATHER)}"
)

# Requests out of contract, with all reasons; the rest are predicted.
REASONS = f"""
refusals AS (SELECT event_id, {TITLE} AS weather_main, concat_ws('; ', CASE WHEN date_time IS NULL THEN 'date_time missing' END,
  CASE WHEN temp IS NULL OR temp < 200 OR temp > 350 THEN 'temp outside 200..350' END,
  CASE WHEN rain_1h < 0 THEN 'rain_1h below 0' END, CASE WHEN snow_1h < 0 THEN 'snow_1h below 0' END,
  CASE WHEN clouds_all IS NULL OR clouds_all NOT BETWEEN 0 AND 100 THEN 'clouds_all outside 0..100' END,
  CASE WHEN coalesce({TITLE} NOT IN {tuple(WEATHER)}, true) THEN 'weather_main unknown' END) AS reasons FROM traffic_raw)"""
ORACLES["quarantine_table"] = on_raw("SELECT * FROM refusals WHERE reasons <> ''", "," + REASONS)
ORACLES["quarantine_stream"] = ORACLES["quarantine_table"]
ORACLES["score_accounting"] = on_raw(
    "SELECT count(*) FILTER (reasons = '') AS predicted, count(*) FILTER (reasons <> '') AS refused FROM refusals", "," + REASONS
)
ORACLES["drift_late_rows"] = on_raw(
    "SELECT date_trunc('day', date_time) AS window_start, count(*) AS records FROM traffic_raw GROUP BY 1 "
    "HAVING window_start + INTERVAL 25 HOUR <= (SELECT max(date_time) FROM traffic_raw)"
)

# Facts of fitted models that hold for every fit
IN_TIME = f"""
halves AS (SELECT *, row_number() OVER ({ORDERED}) <= floor(0.8 * count(*) OVER ()) AS is_train FROM traffic)"""
ORACLES["tree_shapley_rows"] = on_traffic(f"SELECT {KEY}, true AS adds_up FROM halves WHERE NOT is_train", "," + IN_TIME)
ORACLES["network_check"] = on_traffic(
    f"""SELECT count(*) AS rows, {r('avg(abs(traffic_volume - guess))', 'hourly_mae', 4)}, true AS stopped_early
FROM halves JOIN (SELECT hour(date_time) AS h, avg(traffic_volume) AS guess FROM halves WHERE is_train GROUP BY 1) ON h = hour(date_time)
WHERE NOT is_train""",
    "," + IN_TIME,
)
