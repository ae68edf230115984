"""Reference SQL for every registered query, runnable by DuckDB on the raw
test tables (adapters prepended as CTEs).

The formulations are independent of the Spark operators: they follow the
reporting SQL / pandas rules literally (``COUNT(DISTINCT)``, correlations over
the materialised joined rows, ...), pre-aggregating only where the intended
result requires it (SURVEY §1.4.1). Numeric contract (SURVEY §7.4): averages
are ``round(sum/count, 6)``, decimals and sums leave as DOUBLE, small ints as
BIGINT, correlations/z-scores/percentiles are rounded to 6 places.
"""

from __future__ import annotations

from voltgrid.sources.testdata import ADAPTER_SQL
from voltgrid.sources.uneven import UNEVEN_SQL

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

S, P, U, W, T, A, L = ("charging_stations", "charging_points", "usage_data", "weather_data",
                       "traffic_data", "anomaly_detection", "data_collection_log")
ALL = (S, P, U, W, T, A, L)


def M(c: str) -> str:
    """Average, contract form."""
    return f"round(CAST(SUM({c}) AS DOUBLE) / COUNT({c}), 6)"


def D(c: str) -> str:
    """Exact sum leaving as double."""
    return f"CAST(SUM({c}) AS DOUBLE)"


def CORR(x: str, y: str) -> str:
    """pandas ``Series.corr`` with NaN → 0 (constant or empty input)."""
    c = f"corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))"
    # "+ 0.0" turns a rounded negative zero into +0.0 (Spark's round never yields -0.0)
    return f"(round(coalesce(CASE WHEN isnan({c}) THEN 0 ELSE {c} END, 0), 6) + 0.0)"


def q(body: str, *ctes: tuple[str, str], adapters: dict[str, str] = ADAPTER_SQL) -> str:
    """All adapters plus extra named CTEs ahead of ``body``. Unused CTEs cost
    nothing in DuckDB (they are inlined only where referenced)."""
    parts = [f"{n} AS ({adapters[n]})" for n in ALL]
    parts += [f"{n} AS ({b})" for n, b in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# =============================================================== views V01–V13

USAGE_BY_STATION = f"""
  SELECT station_id, COUNT(DISTINCT id) AS n, {D('energy_consumed_kwh')} AS energy,
         {M('duration_minutes')} AS avg_d, {M('cost')} AS avg_c, {D('cost')} AS revenue,
         COUNT(DISTINCT CAST(session_start AS DATE)) AS days, MAX(session_start) AS last_s,
         MIN(session_start) AS first_s
  FROM usage_data GROUP BY station_id"""

POINTS_BY_STATION = f"""
  SELECT station_id, COUNT(DISTINCT id) AS n, {M('power_kw')} AS avg_p,
         CAST(MAX(power_kw) AS DOUBLE) AS max_p, {D('power_kw')} AS total_p
  FROM charging_points GROUP BY station_id"""

V01_BODY = f"""
SELECT cs.id AS station_id, cs.name AS station_name, CAST(cs.latitude AS DOUBLE) AS latitude,
       CAST(cs.longitude AS DOUBLE) AS longitude, cs.city, cs.state, cs.country, cs.operator,
       cs.network, cs.status, cs.access_type,
       COALESCE(p.n, 0) AS total_charging_points, p.avg_p AS avg_power_kw, p.max_p AS max_power_kw,
       COALESCE(u.n, 0) AS total_sessions, u.energy AS total_energy_kwh,
       u.avg_d AS avg_session_duration_minutes, u.avg_c AS avg_session_cost,
       COALESCE(w.n, 0) AS weather_records_count, COALESCE(t.n, 0) AS traffic_records_count,
       COALESCE(a.n, 0) AS anomaly_count, u.last_s AS last_session_date, cs.created_at, cs.updated_at
FROM charging_stations cs
LEFT JOIN ({POINTS_BY_STATION}) p ON cs.id = p.station_id
LEFT JOIN ({USAGE_BY_STATION}) u ON cs.id = u.station_id
LEFT JOIN (SELECT station_id, COUNT(DISTINCT id) AS n FROM weather_data GROUP BY station_id) w
       ON cs.id = w.station_id
LEFT JOIN (SELECT station_id, COUNT(DISTINCT id) AS n FROM traffic_data GROUP BY station_id) t
       ON cs.id = t.station_id
LEFT JOIN (SELECT station_id, COUNT(DISTINCT id) AS n FROM anomaly_detection
           WHERE is_resolved = FALSE GROUP BY station_id) a ON cs.id = a.station_id"""

V12_BODY = """
SELECT station_id, station_name, latitude, longitude, city, state, country, operator, network, status,
       access_type, total_charging_points, COALESCE(avg_power_kw, 0) AS avg_power_kw,
       COALESCE(max_power_kw, 0) AS max_power_kw, total_sessions,
       COALESCE(total_energy_kwh, 0) AS total_energy_kwh,
       COALESCE(avg_session_duration_minutes, 0) AS avg_session_duration_minutes,
       COALESCE(avg_session_cost, 0) AS avg_session_cost, weather_records_count,
       traffic_records_count, anomaly_count, last_session_date, created_at, updated_at
FROM v01"""

V02_BODY = f"""
SELECT ud.station_id, cs.name AS station_name, cs.city, cs.state,
       CAST(CAST(ud.session_start AS DATE) AS TIMESTAMP) AS session_date,
       CAST(EXTRACT(HOUR FROM ud.session_start) AS BIGINT) AS hour_of_day,
       CAST(EXTRACT(DOW FROM ud.session_start) AS BIGINT) AS day_of_week,
       EXTRACT(DOW FROM ud.session_start) IN (0, 6) AS is_weekend,
       COUNT(*) AS session_count, {D('ud.energy_consumed_kwh')} AS total_energy_kwh,
       {M('ud.energy_consumed_kwh')} AS avg_energy_kwh, {M('ud.duration_minutes')} AS avg_duration_minutes,
       {D('ud.cost')} AS total_cost, {M('ud.cost')} AS avg_cost
FROM usage_data ud JOIN charging_stations cs ON ud.station_id = cs.id
GROUP BY ud.station_id, cs.name, cs.city, cs.state, CAST(ud.session_start AS DATE),
         EXTRACT(HOUR FROM ud.session_start), EXTRACT(DOW FROM ud.session_start)"""

V13_BODY = f"""
SELECT g.*, cs.name, cs.city, cs.state FROM (
  SELECT station_id, CAST(CAST(session_start AS DATE) AS TIMESTAMP) AS session_date,
         CAST(EXTRACT(HOUR FROM session_start) AS BIGINT) AS hour_of_day,
         CAST(isodow(session_start) - 1 AS BIGINT) AS day_of_week,
         isodow(session_start) >= 6 AS is_weekend,
         COUNT(id) AS session_count, {D('energy_consumed_kwh')} AS total_energy,
         {M('energy_consumed_kwh')} AS avg_energy, {M('duration_minutes')} AS avg_duration,
         {D('cost')} AS total_cost, {M('cost')} AS avg_cost
  FROM usage_data WHERE station_id IS NOT NULL AND session_start IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5) g
LEFT JOIN charging_stations cs ON g.station_id = cs.id"""

V08_BODY = f"""
SELECT ud.station_id, cs.name AS station_name, cs.city, cs.state,
       CAST(EXTRACT(HOUR FROM ud.session_start) AS BIGINT) AS hour_of_day,
       CAST(EXTRACT(DOW FROM ud.session_start) AS BIGINT) AS day_of_week,
       CASE EXTRACT(DOW FROM ud.session_start) WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday'
            WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday'
            WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' END AS day_name,
       COUNT(*) AS session_count, {D('ud.energy_consumed_kwh')} AS total_energy_kwh,
       {M('ud.duration_minutes')} AS avg_duration_minutes
FROM usage_data ud JOIN charging_stations cs ON ud.station_id = cs.id
GROUP BY ud.station_id, cs.name, cs.city, cs.state, EXTRACT(HOUR FROM ud.session_start),
         EXTRACT(DOW FROM ud.session_start)"""

_NUM = {"temperature_celsius", "humidity_percent", "pressure_hpa", "wind_speed_ms", "precipitation_mm",
        "uv_index", "traffic_density", "average_speed_kmh", "distance_to_station_km"}


def _obs_corr(table: str, a: str, cols: list[str], prefix: str, date_name: str) -> str:
    out = ", ".join(f"CAST({a}.{c} AS DOUBLE) AS {c}" if c in _NUM else f"{a}.{c}" for c in cols)
    grp = ", ".join(f"{a}.{c}" for c in cols)
    return f"""
SELECT {a}.station_id, cs.name AS station_name, {a}."timestamp",
       CAST(CAST({a}."timestamp" AS DATE) AS TIMESTAMP) AS {date_name},
       CAST(EXTRACT(HOUR FROM {a}."timestamp") AS BIGINT) AS hour_of_day, {out},
       COUNT(ud.id) AS sessions_during_{prefix},
       {D('ud.energy_consumed_kwh')} AS energy_during_{prefix},
       {M('ud.duration_minutes')} AS avg_duration_during_{prefix}
FROM {table} {a}
JOIN charging_stations cs ON {a}.station_id = cs.id
LEFT JOIN usage_data ud ON {a}.station_id = ud.station_id
     AND date_trunc('hour', ud.session_start) = date_trunc('hour', {a}."timestamp")
GROUP BY {a}.station_id, cs.name, {a}."timestamp", {grp}"""


V03_BODY = _obs_corr("weather_data", "wd", ["temperature_celsius", "humidity_percent", "pressure_hpa",
                                            "wind_speed_ms", "precipitation_mm", "weather_condition",
                                            "uv_index"], "weather", "weather_date")
V04_BODY = _obs_corr("traffic_data", "td", ["traffic_density", "average_speed_kmh", "congestion_level",
                                            "road_type", "distance_to_station_km"], "traffic", "traffic_date")

V06_BODY = f"""
SELECT ad.station_id, cs.name AS station_name, cs.city, cs.state, ad.anomaly_type,
       CAST(ad.severity_score AS DOUBLE) AS severity_score, ad.detected_at,
       CAST(CAST(ad.detected_at AS DATE) AS TIMESTAMP) AS anomaly_date, ad.description, ad.is_resolved, ad.resolved_at,
       round(CAST(date_diff('microsecond', ad.detected_at, COALESCE(ad.resolved_at, {AS_OF})) AS DOUBLE)
             / 86400000000.0, 6) AS days_open
FROM anomaly_detection ad JOIN charging_stations cs ON ad.station_id = cs.id"""

V07_BODY = f"""
SELECT cs.id AS station_id, cs.name AS station_name, cs.city, cs.state, cs.operator,
       COALESCE(u.n, 0) AS total_sessions, u.energy AS total_energy_kwh, u.avg_d AS avg_duration_minutes,
       u.avg_c AS avg_cost, u.revenue AS total_revenue, COALESCE(u.days, 0) AS active_days,
       u.last_s AS last_session, u.first_s AS first_session,
       COALESCE(p.n, 0) AS charging_points_count, p.avg_p AS avg_power_kw,
       COALESCE(a.n, 0) AS open_anomalies
FROM charging_stations cs
LEFT JOIN ({USAGE_BY_STATION}) u ON cs.id = u.station_id
LEFT JOIN ({POINTS_BY_STATION}) p ON cs.id = p.station_id
LEFT JOIN (SELECT station_id, COUNT(DISTINCT CASE WHEN is_resolved = FALSE THEN id END) AS n
           FROM anomaly_detection GROUP BY station_id) a ON cs.id = a.station_id"""

V09_BODY = f"""
SELECT cs.id AS station_id, cs.name AS station_name, CAST(cs.latitude AS DOUBLE) AS latitude,
       CAST(cs.longitude AS DOUBLE) AS longitude, cs.city, cs.state, cs.country, cs.operator, cs.status,
       COALESCE(u.n, 0) AS total_sessions, u.energy AS total_energy_kwh, u.avg_c AS avg_cost,
       COALESCE(p.n, 0) AS charging_points_count
FROM charging_stations cs
LEFT JOIN ({USAGE_BY_STATION}) u ON cs.id = u.station_id
LEFT JOIN ({POINTS_BY_STATION}) p ON cs.id = p.station_id"""

V10_BODY = """
SELECT id, data_source, collection_type, CAST(records_collected AS BIGINT) AS records_collected, status,
       error_message, started_at, completed_at, CAST(CAST(started_at AS DATE) AS TIMESTAMP) AS collection_date,
       CAST(date_diff('microsecond', started_at, completed_at) AS DOUBLE) / 1e6 AS duration_seconds,
       CASE WHEN status = 'success' THEN TRUE ELSE FALSE END AS is_successful
FROM data_collection_log"""

V11_BODY = f"""
SELECT s.id AS station_id, s.name, s.city, s.state,
       COALESCE(w.n, 0) AS weather_records, COALESCE(t.n, 0) AS traffic_records,
       COALESCE(a.n, 0) AS anomaly_count,
       NULLIF(w.avg_t, 0) AS avg_temperature, NULLIF(t.avg_d, 0) AS avg_traffic_density
FROM charging_stations s
LEFT JOIN (SELECT station_id, COUNT(DISTINCT id) AS n, {M('temperature_celsius')} AS avg_t
           FROM weather_data GROUP BY station_id) w ON s.id = w.station_id
LEFT JOIN (SELECT station_id, COUNT(DISTINCT id) AS n, {M('traffic_density')} AS avg_d
           FROM traffic_data GROUP BY station_id) t ON s.id = t.station_id
LEFT JOIN (SELECT station_id, COUNT(DISTINCT id) AS n FROM anomaly_detection GROUP BY station_id) a
       ON s.id = a.station_id"""

ORACLE: dict[str, str] = {
    "v01_station_overview": q(V01_BODY),
    "v02_usage_patterns": q(V02_BODY),
    "v03_weather_correlation": q(V03_BODY),
    "v04_traffic_correlation": q(V04_BODY),
    "v06_anomaly_summary": q(V06_BODY),
    "v07_station_performance": q(V07_BODY),
    "v08_hourly_heatmap": q(V08_BODY),
    "v09_geographic_distribution": q(V09_BODY),
    "v10_collection_status": q(V10_BODY),
    "v11_station_statistics": q(V11_BODY),
    "v12_station_overview_filled": q(V12_BODY, ("v01", V01_BODY)),
    "v13_usage_patterns_weekday": q(V13_BODY),
}

# ============================================================ patterns P01–P09

_U_OK = "FROM usage_data WHERE station_id IS NOT NULL AND session_start IS NOT NULL"

P01_BODY = f"""
SELECT station_id, hour, session_count FROM (
  SELECT station_id, CAST(EXTRACT(HOUR FROM session_start) AS BIGINT) AS hour, COUNT(*) AS session_count
  {_U_OK} GROUP BY 1, 2) h
WHERE session_count >= 1.5 * (SELECT AVG(h2.session_count) FROM (
        SELECT station_id, EXTRACT(HOUR FROM session_start) AS hour, COUNT(*) AS session_count
        {_U_OK} GROUP BY 1, 2) h2 WHERE h2.station_id = h.station_id)"""

P01N_H = """SELECT CAST(EXTRACT(HOUR FROM session_start) AS BIGINT) AS hour, COUNT(*) AS session_count
           FROM usage_data WHERE session_start IS NOT NULL GROUP BY 1"""
P01N_BODY = "SELECT hour, session_count FROM h WHERE session_count >= 1.5 * (SELECT AVG(session_count) FROM h)"

_WK = "COALESCE(isodow(session_start) >= 6, FALSE)"
P02_BODY = f"""
SELECT station_id,
       COUNT(*) FILTER (WHERE NOT {_WK}) AS weekday_sessions,
       COUNT(*) FILTER (WHERE {_WK}) AS weekend_sessions,
       COALESCE(CAST(SUM(CASE WHEN NOT {_WK} THEN energy_consumed_kwh END) AS DOUBLE), 0) AS weekday_energy_kwh,
       COALESCE(CAST(SUM(CASE WHEN {_WK} THEN energy_consumed_kwh END) AS DOUBLE), 0) AS weekend_energy_kwh,
       CASE WHEN COUNT(*) FILTER (WHERE {_WK}) > COUNT(*) FILTER (WHERE NOT {_WK})
            THEN 'weekend_heavy' ELSE 'weekday_heavy' END AS pattern
FROM usage_data WHERE station_id IS NOT NULL GROUP BY station_id"""

_DAILY_Z = f"""
  SELECT station_id, date, session_count,
         CASE WHEN sd > 0 THEN (session_count - mu) / sd END AS z
  FROM (SELECT station_id, date, session_count,
               AVG(session_count) OVER (PARTITION BY station_id) AS mu,
               STDDEV_SAMP(session_count) OVER (PARTITION BY station_id) AS sd
        FROM (SELECT station_id, CAST(session_start AS DATE) AS date, COUNT(*) AS session_count
              {_U_OK} GROUP BY 1, 2))"""

P03_BODY = f"""SELECT station_id, CAST(date AS TIMESTAMP) AS date, session_count, round(z, 6) AS z_score
FROM ({_DAILY_Z}) WHERE z > 2"""
P04_BODY = f"""SELECT station_id, CAST(date AS TIMESTAMP) AS date, session_count, round(z, 6) AS z_score
FROM ({_DAILY_Z}) WHERE z < -1.5"""

P05_BODY = f"""
SELECT station_id, {M('duration_minutes')} AS avg_duration_minutes,
       round(median(CAST(duration_minutes AS DOUBLE)), 6) AS median_duration_minutes,
       CAST(MIN(duration_minutes) AS DOUBLE) AS min_duration_minutes,
       CAST(MAX(duration_minutes) AS DOUBLE) AS max_duration_minutes,
       round(stddev_samp(CAST(duration_minutes AS DOUBLE)), 6) AS std_duration_minutes,
       CASE WHEN COUNT(duration_minutes) > 0
            THEN printf('Average session duration: %.1f minutes', round({M('duration_minutes')}, 1))
            ELSE 'No valid duration data' END AS description
FROM usage_data WHERE station_id IS NOT NULL GROUP BY station_id"""

P05N_BODY = P05_BODY.replace("SELECT station_id, ", "SELECT ", 1).replace(
    "WHERE station_id IS NOT NULL GROUP BY station_id", "")

P06_BODY = f"""
SELECT station_id,
       CASE WHEN month(session_start) IN (12, 1, 2) THEN 'Winter'
            WHEN month(session_start) IN (3, 4, 5) THEN 'Spring'
            WHEN month(session_start) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
       COUNT(id) AS session_count, COALESCE({D('energy_consumed_kwh')}, 0) AS total_energy_kwh
{_U_OK} GROUP BY 1, 2"""


def _p09(level: str) -> str:
    return f"""
SELECT '{level}' AS location_type, s.{level} AS location, COUNT(u.id) AS session_count,
       COALESCE({D('u.energy_consumed_kwh')}, 0) AS total_energy_kwh
FROM usage_data u LEFT JOIN charging_stations s ON u.station_id = s.id
WHERE s.{level} IS NOT NULL GROUP BY s.{level}"""


_PEAK_TEXT = f"""
  SELECT g.station_id, 'Peak usage occurs during hours: [' ||
         COALESCE(string_agg(CAST(p.hour AS VARCHAR), ', ' ORDER BY p.hour), '') || ']' AS description
  FROM (SELECT DISTINCT station_id FROM usage_data WHERE station_id IS NOT NULL) g
  LEFT JOIN ({P01_BODY}) p ON g.station_id = p.station_id GROUP BY g.station_id"""

P07_BODY = f"""
SELECT station_id, 'peak_hours' AS pattern_type, description, 0.85 AS confidence FROM ({_PEAK_TEXT})
UNION ALL
SELECT station_id, 'day_of_week', 'Weekday vs Weekend pattern: ' ||
       printf('{{''weekday_sessions'': %d, ''weekend_sessions'': %d, ''weekday_energy_kwh'': %s, ''weekend_energy_kwh'': %s, ''pattern'': ''%s''}}',
              weekday_sessions, weekend_sessions, CAST(weekday_energy_kwh AS VARCHAR),
              CAST(weekend_energy_kwh AS VARCHAR), pattern), 0.80
FROM ({P02_BODY})
UNION ALL
SELECT station_id, 'usage_spikes', printf('Detected %d usage spikes', COUNT(*)), 0.75
FROM ({P03_BODY}) GROUP BY station_id
UNION ALL
SELECT station_id, 'low_usage_periods', printf('Identified %d low usage periods', COUNT(*)), 0.70
FROM ({P04_BODY}) GROUP BY station_id
UNION ALL
SELECT station_id, 'session_duration', description, 0.75 FROM ({P05_BODY})"""

ORACLE.update({
    "p01_peak_hours": q(P01_BODY),
    "p01_peak_hours_network": q(P01N_BODY, ("h", P01N_H)),
    "p02_weekday_weekend": q(P02_BODY),
    "p03_usage_spikes": q(P03_BODY),
    "p04_low_usage_periods": q(P04_BODY),
    "p05_session_duration_stats": q(P05_BODY),
    "p05_session_duration_stats_network": q(P05N_BODY),
    "p06_seasonal_trends": q(P06_BODY),
    "p07_usage_pattern_summary": q(P07_BODY),
    "p09_location_patterns_state": q(_p09("state")),
    "p09_location_patterns_city": q(_p09("city")),
})

# ========================================================= correlations R01–R08

HU = f"""SELECT station_id, date_trunc('hour', session_start) AS hour, COUNT(id) AS session_count,
          CAST(SUM(energy_consumed_kwh) AS DOUBLE) AS total_energy
   {_U_OK} GROUP BY 1, 2"""

_WJ = """FROM weather_data w JOIN hu h ON w.station_id = h.station_id
                                    AND date_trunc('hour', w."timestamp") = h.hour"""
_TJ = """FROM traffic_data t JOIN hu h ON t.station_id = h.station_id
                                    AND date_trunc('hour', t."timestamp") = h.hour"""
_CJ = """FROM weather_data w
JOIN traffic_data t ON w.station_id = t.station_id
                   AND date_trunc('hour', w."timestamp") = date_trunc('hour', t."timestamp")
JOIN hu h ON w.station_id = h.station_id AND date_trunc('hour', w."timestamp") = h.hour"""


def _r02(by: str) -> str:
    sel, grp = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {sel}{CORR('w.temperature_celsius', 'h.session_count')} AS temperature_vs_sessions,
       {CORR('w.precipitation_mm', 'h.session_count')} AS precipitation_vs_sessions,
       COUNT(*) AS data_points {_WJ}{grp}"""


def _r04(by: str) -> str:
    sel, grp = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {sel}{CORR('t.traffic_density', 'h.session_count')} AS traffic_density_vs_sessions,
       {CORR('t.average_speed_kmh', 'h.session_count')} AS average_speed_vs_sessions,
       COUNT(*) AS data_points {_TJ}{grp}"""


def _r06(by: str) -> str:
    sel, grp = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {sel}{CORR('w.temperature_celsius', 'h.session_count')} AS temperature,
       {CORR('w.precipitation_mm', 'h.session_count')} AS precipitation,
       {CORR('t.traffic_density', 'h.session_count')} AS traffic_density,
       {CORR('t.average_speed_kmh', 'h.session_count')} AS average_speed,
       COUNT(*) AS data_points {_CJ}{grp}"""


def _impact_sql(j: str, col: str, by: str) -> str:
    part = f"PARTITION BY {by} " if by else ""
    sel = f"{by}, " if by else ""
    return f"""SELECT * FROM (
  SELECT {sel}{col}, mean_sessions,
         ROW_NUMBER() OVER ({part}ORDER BY mean_sessions DESC, {col}) AS rank
  FROM (SELECT {sel.replace(by, 'h.' + by) if by else ''}{col}, round(AVG(h.session_count), 6) AS mean_sessions
        {j} WHERE {col} IS NOT NULL GROUP BY {sel.replace(by, 'h.' + by) if by else ''}{col}))
WHERE rank <= 3"""


def _sent(label: str, c: str, src: str, section: str, by: str = "") -> str:
    return (f"SELECT {by}'{section}' AS section, printf('{label} shows %s correlation (%.2f) with session count', "
            f"CASE WHEN {c} > 0 THEN 'positive' ELSE 'negative' END, {c}) AS insight FROM {src} "
            f"WHERE abs({c}) > 0.3")


def _top(src: str, col: str, section: str, prefix: str, by: str = "") -> str:
    group = "GROUP BY station_id " if by else ""
    return (f"SELECT {by}'{section}', '{prefix}{{' || string_agg(printf('''%s'': %s', {col}, "
            f"CAST(mean_sessions AS VARCHAR)), ', ' ORDER BY rank) || '}}' FROM {src} {group}HAVING COUNT(*) > 0")


def _r07(by: str = "") -> str:
    """``by``: empty, or the selected key and a comma."""
    strong = ", ".join(f"CASE WHEN abs({c}) > 0.5 THEN '''{c}'': ' || CAST({c} AS VARCHAR) END"
                       for c in ("temperature", "precipitation", "traffic_density", "average_speed"))
    return "\nUNION ALL\n".join([
        _sent("Temperature", "temperature_vs_sessions", "wr", "weather_correlation", by),
        _sent("Precipitation", "precipitation_vs_sessions", "wr", "weather_correlation", by),
        _top("ci", "weather_condition", "weather_correlation", "Weather conditions with highest usage: ", by),
        _sent("Traffic density", "traffic_density_vs_sessions", "tr", "traffic_correlation", by),
        _top("gi", "congestion_level", "traffic_correlation", "Congestion levels with highest usage: ", by),
        f"""SELECT {by}'combined_correlation', 'Strong correlations found: {{' || concat_ws(', ', {strong}) || '}}' FROM cr
       WHERE abs(temperature) > 0.5 OR abs(precipitation) > 0.5 OR abs(traffic_density) > 0.5
          OR abs(average_speed) > 0.5"""])


R07_BODY = _r07()


def _long(src: str, section: str, metrics: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{section}' AS section, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {src}" for m in metrics)


R08_BODY = "\nUNION ALL\n".join([
    _long("wr", "weather_correlation", ["temperature_vs_sessions", "precipitation_vs_sessions", "data_points"]),
    _long("tr", "traffic_correlation", ["traffic_density_vs_sessions", "average_speed_vs_sessions", "data_points"]),
    _long("cr", "combined_correlation", ["temperature", "precipitation", "traffic_density", "average_speed",
                                         "data_points"]),
    "SELECT 'summary', 'weather_data_points', CAST(data_points AS DOUBLE) FROM wr",
    "SELECT 'summary', 'traffic_data_points', CAST(data_points AS DOUBLE) FROM tr",
    "SELECT 'summary', 'combined_data_points', CAST(data_points AS DOUBLE) FROM cr",
])

_CORR_CTES = (("hu", HU), ("wr", _r02("")), ("tr", _r04("")), ("cr", _r06("")),
              ("ci", _impact_sql(_WJ, "weather_condition", "")),
              ("gi", _impact_sql(_TJ, "congestion_level", "")))
_CORR_CTES_BY = (("hu", HU), ("wr", _r02("h.station_id")), ("tr", _r04("h.station_id")), ("cr", _r06("h.station_id")),
                 ("ci", _impact_sql(_WJ, "weather_condition", "station_id")),
                 ("gi", _impact_sql(_TJ, "congestion_level", "station_id")))

ORACLE.update({
    "r01_hourly_usage": q("SELECT * FROM hu", ("hu", HU)),
    "r02_weather_usage_correlation": q(_r02(""), ("hu", HU)),
    "r02_weather_usage_correlation_by_station": q(_r02("h.station_id"), ("hu", HU)),
    "r03_condition_impact": q(_impact_sql(_WJ, "weather_condition", ""), ("hu", HU)),
    "r03_condition_impact_by_station": q(_impact_sql(_WJ, "weather_condition", "station_id"), ("hu", HU)),
    "r04_traffic_usage_correlation": q(_r04(""), ("hu", HU)),
    "r04_traffic_usage_correlation_by_station": q(_r04("h.station_id"), ("hu", HU)),
    "r05_congestion_impact": q(_impact_sql(_TJ, "congestion_level", ""), ("hu", HU)),
    "r06_combined_correlation": q(_r06(""), ("hu", HU)),
    "r06_combined_correlation_by_station": q(_r06("h.station_id"), ("hu", HU)),
    "r07_correlation_insights": q(R07_BODY, *_CORR_CTES),
    "r07_correlation_insights_by_station": q(_r07("station_id, "), *_CORR_CTES_BY),
    "r08_correlation_report": q(R08_BODY, *_CORR_CTES),
})

# ============================================================ insights B01–B18

def HALF(num: str, den: str, places: int) -> str:
    """Half-up decimal text of num/den from integer arithmetic."""
    scale = 10 ** places
    qv = f"CAST(floor((2 * ({num}) * {scale} + ({den})) / (2 * ({den}))) AS BIGINT)"
    return f"(CAST({qv} // {scale} AS VARCHAR) || '.' || lpad(CAST({qv} % {scale} AS VARCHAR), {places}, '0'))"


ST = ("st", """SELECT station_id, COUNT(*) AS sessions, COALESCE(SUM(cost), 0) AS revenue
               FROM usage_data WHERE station_id IS NOT NULL GROUP BY station_id""")
PP = ("pp", """SELECT station_id, COUNT(*) AS points FROM charging_points
               WHERE station_id IS NOT NULL GROUP BY station_id""")

B01_BODY = """
SELECT s.n AS total_stations, p.n AS total_charging_points, u.n AS total_sessions,
       COALESCE(round(CAST(p.n AS DOUBLE) / NULLIF(s.n, 0), 6), 0) AS avg_points_per_station
FROM (SELECT COUNT(*) AS n FROM charging_stations) s, (SELECT COUNT(*) AS n FROM charging_points) p,
     (SELECT COUNT(*) AS n FROM usage_data) u"""


def _b02(dim: str) -> str:
    return f"SELECT {dim}, COUNT(*) AS station_count FROM charging_stations WHERE {dim} IS NOT NULL GROUP BY {dim}"


B03_BODY = f"""
SELECT COUNT(*) AS total_sessions, COALESCE({D('energy_consumed_kwh')}, 0) AS total_energy_kwh,
       round(COALESCE({D('energy_consumed_kwh')}, 0) / CAST(COUNT(*) AS DOUBLE), 6) AS avg_energy_per_session_kwh,
       {M('duration_minutes')} AS avg_duration_minutes, COALESCE({D('cost')}, 0) AS total_revenue,
       round(COALESCE({D('cost')}, 0) / CAST(COUNT(*) AS DOUBLE), 6) AS avg_cost_per_session,
       COUNT(DISTINCT station_id) AS active_stations,
       COALESCE(round(CAST(COUNT(DISTINCT station_id) AS DOUBLE) * 100.0
                      / CAST(NULLIF((SELECT COUNT(*) FROM charging_stations), 0) AS DOUBLE), 6), 0)
           AS utilization_rate_percent
FROM usage_data HAVING COUNT(*) > 0"""


def _low_list(value: str, type_: str, text: str) -> str:
    return f"""
SELECT '{type_}' AS type, 'medium' AS priority, printf('{text}', COUNT(*) OVER ()) AS recommendation,
       COUNT(*) OVER () AS n_stations, station_id
FROM st WHERE CAST({value} AS DOUBLE) < (SELECT quantile_cont(CAST({value} AS DOUBLE), 0.25) FROM st)"""


B04_BODY = _low_list("sessions", "underutilized_stations", "%d stations have low usage. Consider marketing or relocation.")
B06_BODY = _low_list("revenue", "pricing_optimization", "%d stations have low revenue. Review pricing strategy.")

B05_BODY = """
SELECT 'capacity_expansion' AS type, 'high' AS priority,
       printf('Station %s has high demand but only %d charging points. Consider expansion.',
              hi.station_id, COALESCE(pp.points, 0)) AS recommendation,
       hi.station_id, COALESCE(pp.points, 0) AS points
FROM (SELECT station_id FROM st WHERE sessions > (SELECT quantile_cont(sessions, 0.75) FROM st)) hi
LEFT JOIN pp ON hi.station_id = pp.station_id
WHERE COALESCE(pp.points, 0) < 4 AND (SELECT COUNT(*) FROM charging_points) > 0"""

B07_BODY = """
SELECT state, station_count FROM (SELECT state, COUNT(*) AS station_count FROM charging_stations
                                  WHERE state IS NOT NULL GROUP BY state) g
WHERE station_count < (SELECT quantile_cont(station_count, 0.25) FROM (
        SELECT COUNT(*) AS station_count FROM charging_stations WHERE state IS NOT NULL GROUP BY state))"""

B08_BODY = f"""
SELECT type, priority, recommendation, station_id, CAST(NULL AS VARCHAR) AS state FROM ({B04_BODY})
UNION ALL
SELECT type, priority, recommendation, station_id, NULL FROM ({B05_BODY})
UNION ALL
SELECT type, priority, recommendation, station_id, NULL FROM ({B06_BODY})
UNION ALL
SELECT 'geographic_expansion', 'low',
       'Consider expanding to states with low coverage: ['''|| state || ''']', NULL, state FROM ({B07_BODY})
UNION ALL
SELECT 'data_collection', 'high', 'Collect more usage data to generate insights', NULL, NULL
WHERE (SELECT COUNT(*) FROM usage_data) = 0"""

B09_BODY = f"""SELECT COALESCE({D('cost')}, 0) AS total_revenue, {M('cost')} AS avg_revenue_per_session
FROM usage_data HAVING COUNT(*) > 0"""

B10_BODY = f"""
SELECT station_id, revenue, rank FROM (
  SELECT station_id, COALESCE({D('cost')}, 0) AS revenue,
         ROW_NUMBER() OVER (ORDER BY COALESCE(SUM(cost), 0) DESC, station_id) AS rank
  FROM usage_data WHERE station_id IS NOT NULL GROUP BY station_id) WHERE rank <= 10"""

DAILY = ("daily", f"""SELECT CAST(session_start AS DATE) AS date, COALESCE({D('cost')}, 0) AS revenue
           FROM usage_data WHERE session_start IS NOT NULL GROUP BY 1""")
B11D_BODY = "SELECT CAST(date AS TIMESTAMP) AS date, revenue FROM daily"
B11T_BODY = """
SELECT COUNT(*) AS days, arg_min(revenue, date) AS first_revenue, arg_max(revenue, date) AS last_revenue,
       CASE WHEN COUNT(*) > 1 AND arg_max(revenue, date) > arg_min(revenue, date) THEN 'increasing'
            ELSE 'stable' END AS trend
FROM daily HAVING COUNT(*) > 0"""

B12_BODY = f"""
SELECT COUNT(*) AS total_charging_points,
       (SELECT round(AVG(points), 6) FROM pp) AS avg_points_per_station,
       COALESCE({D('power_kw')}, 0) AS total_power_capacity_kw, {M('power_kw')} AS avg_power_per_point_kw
FROM charging_points HAVING COUNT(*) > 0"""

B13_BODY = """
SELECT pp.station_id, COALESCE(st.sessions, 0) AS sessions, pp.points,
       round(COALESCE(st.sessions, 0) / pp.points, 6) AS utilization_ratio
FROM pp LEFT JOIN st ON pp.station_id = st.station_id"""

B15_BODY = f"""
SELECT station_id, COUNT(*) AS total_sessions, COALESCE({D('energy_consumed_kwh')}, 0) AS total_energy_kwh,
       {M('duration_minutes')} AS avg_duration_minutes, COALESCE({D('cost')}, 0) AS total_revenue
FROM usage_data WHERE station_id IS NOT NULL GROUP BY station_id"""

B16_BODY = f"""
SELECT station_id, COUNT(*) AS total_points, COALESCE({D('power_kw')}, 0) AS total_power_kw,
       {M('power_kw')} AS avg_power_kw
FROM charging_points WHERE station_id IS NOT NULL GROUP BY station_id"""

B17_S = ("s17", """
SELECT cs.id AS station_id, COALESCE(u.sessions, 0) AS sessions, pp.points, u.cost_sum, u.cost_n
FROM charging_stations cs
LEFT JOIN (SELECT station_id, COUNT(*) AS sessions, SUM(cost) AS cost_sum, COUNT(cost) AS cost_n
           FROM usage_data GROUP BY station_id) u ON cs.id = u.station_id
LEFT JOIN pp ON cs.id = pp.station_id""")

B17_BODY = f"""
SELECT station_id, 'data_collection' AS type, 'high' AS priority,
       'Collect more usage data to generate insights' AS recommendation FROM s17 WHERE sessions = 0
UNION ALL
SELECT station_id, 'capacity', 'high',
       'High utilization (' || {HALF('sessions', 'points', 1)} || ' sessions/point). Consider adding more charging points.'
FROM s17 WHERE sessions > 0 AND points > 0 AND sessions > 50 * points
UNION ALL
SELECT station_id, 'pricing', 'medium',
       'Low average revenue per session ($' || {HALF('CAST(cost_sum * 100 AS BIGINT)', 'cost_n * 100', 2)}
       || '). Review pricing strategy.'
FROM s17 WHERE sessions > 0 AND cost_n > 0 AND cost_sum < 10 * cost_n"""

B18_BODY = f"""
SELECT s.id AS station_id, s.name, s.city, s.state, s.operator,
       COALESCE(us.total_sessions, 0) AS total_sessions, us.total_energy_kwh, us.avg_duration_minutes,
       us.total_revenue, COALESCE(cap.total_points, 0) AS total_points, cap.total_power_kw, cap.avg_power_kw, r.recommendation_types
FROM charging_stations s
LEFT JOIN ({B15_BODY}) us ON s.id = us.station_id
LEFT JOIN ({B16_BODY}) cap ON s.id = cap.station_id
LEFT JOIN (SELECT station_id, string_agg(type, ',' ORDER BY type) AS recommendation_types
           FROM ({B17_BODY}) GROUP BY station_id) r ON s.id = r.station_id"""

ORACLE.update({
    "b01_network_overview": q(B01_BODY),
    "b02_stations_by_state": q(_b02("state")),
    "b02_stations_by_city": q(_b02("city")),
    "b02_stations_by_operator": q(_b02("operator")),
    "b03_performance_metrics": q(B03_BODY),
    "b04_underutilized_stations": q(B04_BODY, ST),
    "b05_capacity_expansion": q(B05_BODY, ST, PP),
    "b06_pricing_optimization": q(B06_BODY, ST),
    "b07_geographic_gaps": q(B07_BODY),
    "b08_network_recommendations": q(B08_BODY, ST, PP),
    "b09_revenue_summary": q(B09_BODY),
    "b10_top_revenue_stations": q(B10_BODY),
    "b11_daily_revenue": q(B11D_BODY, DAILY),
    "b11_revenue_trend": q(B11T_BODY, DAILY),
    "b12_capacity_summary": q(B12_BODY, PP),
    "b13_station_utilization": q(B13_BODY, ST, PP),
    "b15_station_usage_stats": q(B15_BODY),
    "b16_station_capacity": q(B16_BODY),
    "b17_station_recommendations": q(B17_BODY, PP, B17_S),
    "b18_station_insights": q(B18_BODY, PP, B17_S),
})

# ============================================ cleaning, sinks, derived, features

def _truthy(c: str, text: bool = True) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')" if text else f"({c} IS NOT NULL AND CAST({c} AS DOUBLE) <> 0)"


def _txt(c: str, default: str = "") -> str:
    return f"COALESCE(trim({c}), '{default}')"


def _rng(c: str, lo, hi) -> str:
    return f"CASE WHEN TRY_CAST({c} AS DOUBLE) BETWEEN {lo} AND {hi} THEN CAST({c} AS DOUBLE) END"


C01_BODY = f"""
SELECT trim(CAST(id AS VARCHAR)) AS id, {_txt('name')} AS name,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       {_txt('address')} AS address, {_txt('city')} AS city, {_txt('state')} AS state,
       {_txt('country')} AS country, {_txt('operator')} AS operator, {_txt('network')} AS network,
       {_txt('status', 'Unknown')} AS status, {_txt('access_type')} AS access_type,
       {_txt('pricing_info')} AS pricing_info, {_txt('amenities')} AS amenities,
       {AS_OF} AS created_at, {AS_OF} AS updated_at
FROM charging_stations
WHERE {_truthy('id')} AND {_truthy('latitude', False)} AND {_truthy('longitude', False)}
  AND CAST(latitude AS DOUBLE) BETWEEN -90 AND 90 AND CAST(longitude AS DOUBLE) BETWEEN -180 AND 180"""

C02_BODY = f"""
SELECT id, trim(station_id) AS station_id, "timestamp",
       {_rng('temperature_celsius', -50, 60)} AS temperature_celsius,
       {_rng('precipitation_mm', 0, 1000)} AS precipitation_mm,
       {_txt('weather_condition')} AS weather_condition, {AS_OF} AS created_at
FROM weather_data WHERE "timestamp" IS NOT NULL AND {_truthy('station_id')}"""

C03_BODY = f"""
SELECT id, trim(station_id) AS station_id, "timestamp",
       {_rng('traffic_density', 0, 1000)} AS traffic_density,
       {_rng('average_speed_kmh', 0, 200)} AS average_speed_kmh,
       {_txt('congestion_level', 'unknown')} AS congestion_level,
       {_txt('road_type', 'highway')} AS road_type, {AS_OF} AS created_at
FROM traffic_data WHERE "timestamp" IS NOT NULL AND {_truthy('station_id')}"""

C05_BODY = "SELECT id, name FROM charging_stations ORDER BY id LIMIT 50"

C06_BODY = f"""
SELECT 'weather' AS dataset, r.n AS raw_records, c.n AS clean_records, r.n - c.n AS rejected_records,
       printf('Cleaned %d out of %d weather records', c.n, r.n) AS message
FROM (SELECT COUNT(*) AS n FROM weather_data) r, (SELECT COUNT(*) AS n FROM ({C02_BODY})) c"""

K01_BODY = """
SELECT id, station_id, session_start, CAST(energy_consumed_kwh AS DOUBLE) AS energy_consumed_kwh,
       CAST(duration_minutes AS BIGINT) AS duration_minutes, CAST(cost AS DOUBLE) AS cost, user_type
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY session_start DESC, id DESC) AS rn
      FROM usage_data) WHERE rn = 1"""

K12P_BODY = """
SELECT p.id, p.station_id, p.connector_type, CAST(p.power_kw AS DOUBLE) AS power_kw FROM charging_points p
WHERE NOT EXISTS (SELECT 1 FROM charging_stations s WHERE s.id = p.station_id)"""

K12U_BODY = """
SELECT u.id, u.station_id, u.session_start FROM usage_data u
WHERE NOT EXISTS (SELECT 1 FROM charging_stations s WHERE s.id = u.station_id)"""

ENERGY = ("energy", f"""
SELECT c.station_id, c.date, COALESCE(SUM(c.e), 0) AS total_energy_kwh,
       COALESCE(SUM(CASE WHEN pk.hour IS NOT NULL THEN c.e END), 0) AS peak_hour_energy,
       COALESCE(SUM(c.e), 0) - COALESCE(SUM(CASE WHEN pk.hour IS NOT NULL THEN c.e END), 0) AS off_peak_energy,
       CAST(SUM(c.n) AS BIGINT) AS session_count,
       CAST(round(CAST(SUM(c.d) AS DOUBLE) / SUM(c.dn)) AS BIGINT) AS avg_session_duration
FROM (SELECT station_id, CAST(session_start AS DATE) AS date, EXTRACT(HOUR FROM session_start) AS hour,
             SUM(energy_consumed_kwh) AS e, COUNT(*) AS n, SUM(duration_minutes) AS d,
             COUNT(duration_minutes) AS dn
      {_U_OK} GROUP BY 1, 2, 3) c
LEFT JOIN ({P01_BODY}) pk ON c.station_id = pk.station_id AND c.hour = pk.hour
GROUP BY c.station_id, c.date""")

D01_BODY = """
SELECT station_id, CAST(date AS TIMESTAMP) AS date, CAST(total_energy_kwh AS DOUBLE) AS total_energy_kwh,
       CAST(peak_hour_energy AS DOUBLE) AS peak_hour_energy, CAST(off_peak_energy AS DOUBLE) AS off_peak_energy,
       session_count, avg_session_duration
FROM energy"""

V05_BODY = """
SELECT ec.station_id, cs.name AS station_name, cs.city, cs.state, CAST(ec.date AS TIMESTAMP) AS date,
       CAST(EXTRACT(DOW FROM ec.date) AS BIGINT) AS day_of_week, EXTRACT(DOW FROM ec.date) IN (0, 6) AS is_weekend,
       CAST(ec.total_energy_kwh AS DOUBLE) AS total_energy_kwh, CAST(ec.peak_hour_energy AS DOUBLE) AS peak_hour_energy,
       CAST(ec.off_peak_energy AS DOUBLE) AS off_peak_energy, ec.session_count, ec.avg_session_duration,
       round(CAST(ec.total_energy_kwh AS DOUBLE) / CAST(NULLIF(ec.session_count, 0) AS DOUBLE), 6) AS energy_per_session
FROM energy ec JOIN charging_stations cs ON ec.station_id = cs.id"""

D02_BODY = """
SELECT data_source AS service, CASE WHEN data_source = '1-URGENT' THEN 'month' ELSE 'day' END AS period,
       CASE WHEN data_source = '1-URGENT' THEN date_trunc('month', started_at)
            ELSE date_trunc('day', started_at) END AS period_start,
       COUNT(*) AS calls, CAST(1000 AS BIGINT) AS quota_limit, 1000 - COUNT(*) AS remaining,
       COUNT(*) < 1000 AS can_use
FROM data_collection_log WHERE data_source IS NOT NULL AND started_at IS NOT NULL GROUP BY 1, 2, 3"""

D04_BODY = """
SELECT data_source, COUNT(*) AS runs, COUNT(*) FILTER (WHERE status = 'success') AS successful_runs,
       round(COUNT(*) FILTER (WHERE status = 'success') / COUNT(*), 6) AS success_rate,
       CAST(COALESCE(SUM(records_collected), 0) AS BIGINT) AS records_collected, MAX(started_at) AS last_run
FROM data_collection_log GROUP BY data_source"""

_HAV = ("2 * 6371.0 * asin(least(sqrt(pow(sin((radians(CAST(latitude AS DOUBLE)) - radians(0.0)) / 2), 2) + "
        "cos(radians(0.0)) * cos(radians(CAST(latitude AS DOUBLE))) * "
        "pow(sin((radians(CAST(longitude AS DOUBLE)) - radians(0.0)) / 2), 2)), 1.0))")
D05_BODY = f"""
SELECT id, name, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       round({_HAV}, 6) AS distance_km
FROM charging_stations WHERE round({_HAV}, 6) <= 5000"""

_W_SIDE = """SELECT station_id, COUNT(*) AS w_rows,
       COUNT(*) FILTER (WHERE COALESCE(regexp_matches(weather_condition, '(?i)storm|rain|snow'), FALSE)) AS w_srs,
       bool_or(COALESCE(regexp_matches(weather_condition, '(?i)storm|thunder'), FALSE)) AS w_storm,
       SUM(CAST(temperature_celsius AS DOUBLE)) AS w_temp_sum, COUNT(temperature_celsius) AS w_temp_n,
       SUM(temperature_celsius) AS w_temp_exact
FROM weather_data GROUP BY station_id"""
_T_SIDE = """SELECT station_id, COUNT(*) AS t_rows, SUM(CAST(traffic_density AS DOUBLE)) AS t_dsum,
       COUNT(traffic_density) AS t_dn, bool_or(COALESCE(congestion_level = 'severe', FALSE)) AS t_sev,
       bool_or(COALESCE(congestion_level = 'moderate', FALSE)) AS t_mod
FROM traffic_data GROUP BY station_id"""
_WAIT = """CASE WHEN COALESCE(t.t_rows, 0) = 0 THEN 0.0 WHEN t.t_sev THEN 45.0 WHEN t.t_mod THEN 20.0 ELSE 5.0 END"""
_CAL = f"""{AS_OF} AS date, CAST(0 AS BIGINT) AS hour_of_day, CAST(3 AS BIGINT) AS day_of_week,
       FALSE AS is_weekend, FALSE AS is_holiday"""

F01_BODY = f"""
SELECT s.id AS station_id, {_CAL},
       CAST(CAST(CASE WHEN COALESCE(w.w_rows, 0) > 0 THEN w.w_srs * 30.0 ELSE 0 END AS DECIMAL(8,2)) AS DOUBLE)
           AS avg_downtime_minutes,
       CAST(CAST(CASE WHEN COALESCE(w.w_rows, 0) > 0 AND COALESCE(t.t_rows, 0) > 0
                      THEN (w.w_temp_sum / w.w_temp_n) / greatest(t.t_dsum / t.t_dn, 1.0) ELSE 0 END
                 AS DECIMAL(10,3)) AS DOUBLE) AS energy_consumption_per_traffic,
       COALESCE(w.w_storm, FALSE) AS usage_spike_during_storm,
       CAST(COALESCE(w.w_rows, 0) AS BIGINT) AS peak_usage_hours,
       CAST(CAST({_WAIT} AS DECIMAL(8,2)) AS DOUBLE) AS avg_wait_time_minutes,
       CAST(COALESCE(w.w_rows, 0) AS BIGINT) AS total_sessions,
       CAST(CAST(COALESCE(w.w_temp_exact * 0.1, 0) AS DECIMAL(10,3)) AS DOUBLE) AS total_energy_kwh,
       {AS_OF} AS created_at
FROM charging_stations s
LEFT JOIN ({_W_SIDE}) w ON s.id = w.station_id
LEFT JOIN ({_T_SIDE}) t ON s.id = t.station_id
WHERE s.id IS NOT NULL AND s.id <> ''"""

F02_BODY = f"""
SELECT s.id AS station_id, {_CAL},
       CAST(CAST(CASE WHEN COALESCE(w.w_rows, 0) > 0 THEN w.w_srs * 30.0 ELSE 0 END AS DECIMAL(8,2)) AS DOUBLE)
           AS avg_downtime_minutes,
       CAST(CAST(CASE WHEN COALESCE(t.t_rows, 0) > 0
                      THEN COALESCE(tot.e_avg / greatest(t.t_dsum / t.t_dn, 1.0), 0) ELSE 0 END
                 AS DECIMAL(10,3)) AS DOUBLE) AS energy_consumption_per_traffic,
       COALESCE(st.mean_storm > st.mean_hour, FALSE) AS usage_spike_during_storm,
       CAST(COALESCE(bh.h, 0) AS BIGINT) AS peak_usage_hours,
       CAST(CAST({_WAIT} AS DECIMAL(8,2)) AS DOUBLE) AS avg_wait_time_minutes,
       CAST(COALESCE(tot.n, 0) AS BIGINT) AS total_sessions,
       CAST(COALESCE(tot.e, 0) AS DOUBLE) AS total_energy_kwh,
       {AS_OF} AS created_at
FROM charging_stations s
LEFT JOIN (SELECT station_id, COUNT(*) AS n, SUM(energy_consumed_kwh) AS e,
                  AVG(CAST(energy_consumed_kwh AS DOUBLE)) AS e_avg
           {_U_OK} GROUP BY station_id) tot ON s.id = tot.station_id
LEFT JOIN (SELECT station_id, h FROM (
             SELECT station_id, h, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY n DESC, h) AS rn
             FROM (SELECT station_id, EXTRACT(HOUR FROM session_start) AS h, COUNT(*) AS n
                   {_U_OK} GROUP BY 1, 2)) WHERE rn = 1) bh ON s.id = bh.station_id
LEFT JOIN (SELECT c.station_id, AVG(c.n) AS mean_hour,
                  AVG(CASE WHEN sh.station_id IS NOT NULL THEN c.n END) AS mean_storm
           FROM (SELECT station_id, date_trunc('hour', session_start) AS hour, COUNT(*) AS n
                 {_U_OK} GROUP BY 1, 2) c
           LEFT JOIN (SELECT DISTINCT station_id, date_trunc('hour', "timestamp") AS hour FROM weather_data
                      WHERE regexp_matches(weather_condition, '(?i)storm|thunder')) sh
                  ON c.station_id = sh.station_id AND c.hour = sh.hour
           GROUP BY c.station_id) st ON s.id = st.station_id
LEFT JOIN ({_W_SIDE}) w ON s.id = w.station_id
LEFT JOIN ({_T_SIDE}) t ON s.id = t.station_id
WHERE s.id IS NOT NULL"""

_FEATS = ["avg_downtime_minutes", "energy_consumption_per_traffic", "avg_wait_time_minutes", "total_sessions",
          "total_energy_kwh"]
_ZS = ", ".join(f"abs(CASE WHEN st.s{i} > 0 THEN (x.x{i} - st.m{i}) / st.s{i} ELSE 0 END)" for i in range(5))
A02_CTES = (
    ("x", f"""SELECT station_id, {", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS x{i}" for i, c in enumerate(_FEATS))}
           FROM ({F02_BODY})"""),
    ("st", f"""SELECT {", ".join(f"AVG(x{i}) AS m{i}, STDDEV_SAMP(x{i}) AS s{i}" for i in range(5))} FROM x"""),
    ("z", f"SELECT x.station_id, greatest({_ZS}) AS score FROM x, st"))
A02_BODY = f"""
SELECT station_id, 'usage_pattern' AS anomaly_type, CAST(CAST(score AS DECIMAL(5,3)) AS DOUBLE) AS severity_score,
       {AS_OF} AS detected_at, printf('Unusual usage pattern detected with score: %.3f', score) AS description,
       FALSE AS is_resolved, {AS_OF} AS created_at
FROM z WHERE score > 2"""

ORACLE.update({
    "c01_clean_stations": q(C01_BODY),
    "c02_clean_weather": q(C02_BODY),
    "c03_clean_traffic": q(C03_BODY),
    "c05_limit_stations": q(C05_BODY),
    "c06_reject_report": q(C06_BODY),
    "k01_latest_session_per_station": q(K01_BODY),
    "k12_orphan_points": q(K12P_BODY),
    "k12_orphan_sessions": q(K12U_BODY),
    "d01_energy_consumption": q(D01_BODY, ENERGY),
    "v05_energy_trends": q(V05_BODY, ENERGY),
    "d02_quota_usage": q(D02_BODY),
    "d04_collection_success_rate": q(D04_BODY),
    "d05_stations_within": q(D05_BODY),
    "f01_engineer_features": q(F01_BODY),
    "f02_usage_features": q(F02_BODY),
    "a02_zscore_anomalies": q(A02_BODY, *A02_CTES),
})

# ============================================== landing-zone documents S01–S09

S01_BODY = """
SELECT id, COALESCE(name, '') AS name, COALESCE(CAST(latitude AS DOUBLE), 0) AS latitude,
       COALESCE(CAST(longitude AS DOUBLE), 0) AS longitude, COALESCE(address, '') AS address,
       COALESCE(city, '') AS city, COALESCE(state, '') AS state, COALESCE(country, '') AS country,
       COALESCE(operator, '') AS operator, '' AS network, 'Unknown' AS status, '' AS access_type,
       '' AS pricing_info,
       concat_ws(', ', CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 'Access Key Required' END,
                       CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'Membership Required' END,
                       CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'Pay at Location' END) AS amenities
FROM charging_stations"""

S02_BODY = """
SELECT id || '_' || CAST(length(connector_type) AS VARCHAR) AS id, station_id, connector_type,
       COALESCE(CAST(power_kw AS DOUBLE), 0) AS power_kw, 0.0 AS voltage, 0.0 AS amperage, 'Unknown' AS status
FROM charging_points"""

S05_BODY = """
SELECT station_id, date_trunc('second', "timestamp") AS "timestamp",
       COALESCE(CAST(temperature_celsius AS DOUBLE), 0) AS temperature_celsius, 0.0 AS humidity_percent,
       0.0 AS pressure_hpa, 0.0 AS wind_speed_ms, 0.0 AS wind_direction_degrees,
       COALESCE(NULLIF(CAST(precipitation_mm AS DOUBLE), 0), 0) AS precipitation_mm,
       COALESCE(weather_condition, '') AS weather_condition, '' AS weather_description,
       CAST(NULL AS DOUBLE) AS visibility_km, 0.0 AS uv_index, 0.0 AS cloudiness_percent
FROM weather_data"""

_SP, _JF = "CAST(average_speed_kmh AS DOUBLE)", "CAST(traffic_density AS DOUBLE)"
S09_ITEMS = ("items", f"""
SELECT station_id, "timestamp", {_SP} AS sp1, {_JF} AS jf1, {_SP} + 25 AS sp2, {_JF} / 2 AS jf2,
       COALESCE({_SP} > 0 AND {_JF} > 0, FALSE) AS v1, COALESCE({_SP} + 25 > 0 AND {_JF} / 2 > 0, FALSE) AS v2
FROM traffic_data""")
S09_BODY = """
SELECT station_id, "timestamp", traffic_density, average_speed_kmh,
       CASE WHEN sev > n * 0.5 THEN 'severe' WHEN modr > n * 0.3 THEN 'moderate' ELSE 'light' END
           AS congestion_level,
       'highway' AS road_type, 0.0 AS distance_to_station_km, CAST(0 AS BIGINT) AS incident_count
FROM (SELECT station_id, "timestamp", CAST(v1 AS INTEGER) + CAST(v2 AS INTEGER) AS n,
             (CASE WHEN v1 THEN jf1 ELSE 0 END + CASE WHEN v2 THEN jf2 ELSE 0 END)
                 / (CAST(v1 AS INTEGER) + CAST(v2 AS INTEGER)) AS traffic_density,
             (CASE WHEN v1 THEN sp1 ELSE 0 END + CASE WHEN v2 THEN sp2 ELSE 0 END)
                 / (CAST(v1 AS INTEGER) + CAST(v2 AS INTEGER)) AS average_speed_kmh,
             CAST(v1 AND sp1 < 20 AS INTEGER) + CAST(v2 AND sp2 < 20 AS INTEGER) AS sev,
             CAST(v1 AND sp1 >= 20 AND sp1 < 40 AS INTEGER) + CAST(v2 AND sp2 >= 20 AND sp2 < 40 AS INTEGER) AS modr
      FROM items WHERE v1 OR v2)"""

ORACLE.update({
    "s01_parse_station_documents": q(S01_BODY),
    "s02_explode_point_documents": q(S02_BODY),
    "s05_parse_weather_documents": q(S05_BODY),
    "s09_parse_traffic_flow_documents": q(S09_BODY, S09_ITEMS),
})

S08_BODY = """
SELECT w.id, w.station_id, w."timestamp", CAST(w.temperature_celsius AS DOUBLE) AS temperature_celsius
FROM weather_data w JOIN charging_stations s ON w.station_id = s.id
WHERE COALESCE(CAST(s.latitude AS DOUBLE), 0) <> 0 AND COALESCE(CAST(s.longitude AS DOUBLE), 0) <> 0"""

S13_BODY = """
SELECT id, name, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
FROM charging_stations
WHERE CAST(latitude AS DOUBLE) BETWEEN 45.0 - 2000.0 / 111.0 AND 45.0 + 2000.0 / 111.0
  AND CAST(longitude AS DOUBLE) BETWEEN 10.0 - 2000.0 / (111.0 * abs(45.0) / 90.0)
                                    AND 10.0 + 2000.0 / (111.0 * abs(45.0) / 90.0)"""

ORACLE.update({
    "s08_attach_station": q(S08_BODY),
    "s13_stations_in_bbox": q(S13_BODY),
})

# network-wide forms (by = []) of the pattern operators
P02N_BODY = f"""
SELECT COUNT(*) FILTER (WHERE NOT {_WK}) AS weekday_sessions,
       COUNT(*) FILTER (WHERE {_WK}) AS weekend_sessions,
       COALESCE(CAST(SUM(CASE WHEN NOT {_WK} THEN energy_consumed_kwh END) AS DOUBLE), 0) AS weekday_energy_kwh,
       COALESCE(CAST(SUM(CASE WHEN {_WK} THEN energy_consumed_kwh END) AS DOUBLE), 0) AS weekend_energy_kwh,
       CASE WHEN COUNT(*) FILTER (WHERE {_WK}) > COUNT(*) FILTER (WHERE NOT {_WK})
            THEN 'weekend_heavy' ELSE 'weekday_heavy' END AS pattern
FROM usage_data"""

_DAILY_ZN = """
  SELECT date, session_count, CASE WHEN sd > 0 THEN (session_count - mu) / sd END AS z
  FROM (SELECT date, session_count, AVG(session_count) OVER () AS mu, STDDEV_SAMP(session_count) OVER () AS sd
        FROM (SELECT CAST(session_start AS DATE) AS date, COUNT(*) AS session_count
              FROM usage_data WHERE session_start IS NOT NULL GROUP BY 1))"""

P04N_BODY = f"""SELECT CAST(date AS TIMESTAMP) AS date, session_count, round(z, 6) AS z_score
FROM ({_DAILY_ZN}) WHERE z < -1.5"""

P06N_BODY = f"""
SELECT CASE WHEN month(session_start) IN (12, 1, 2) THEN 'Winter'
            WHEN month(session_start) IN (3, 4, 5) THEN 'Spring'
            WHEN month(session_start) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
       COUNT(id) AS session_count, COALESCE({D('energy_consumed_kwh')}, 0) AS total_energy_kwh
FROM usage_data WHERE session_start IS NOT NULL GROUP BY 1"""

ORACLE.update({
    "p02_weekday_weekend_network": q(P02N_BODY),
    "p04_low_usage_periods_network": q(P04N_BODY),
    "p06_seasonal_trends_network": q(P06N_BODY),
})


def _long_by(src: str, section: str, metrics: list[str], summary: str) -> str:
    parts = [f"SELECT station_id, '{section}' AS section, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {src}"
             for m in metrics]
    parts.append(f"SELECT station_id, 'summary', '{summary}', CAST(data_points AS DOUBLE) FROM {src}")
    return "\nUNION ALL\n".join(parts)


R08S_BODY = "\nUNION ALL\n".join([
    _long_by("wrs", "weather_correlation", ["temperature_vs_sessions", "precipitation_vs_sessions", "data_points"],
             "weather_data_points"),
    _long_by("trs", "traffic_correlation", ["traffic_density_vs_sessions", "average_speed_vs_sessions",
                                            "data_points"], "traffic_data_points"),
    _long_by("crs", "combined_correlation", ["temperature", "precipitation", "traffic_density", "average_speed",
                                             "data_points"], "combined_data_points"),
])

ORACLE["r08_correlation_report_by_station"] = q(
    R08S_BODY, ("hu", HU), ("wrs", _r02("h.station_id")), ("trs", _r04("h.station_id")), ("crs", _r06("h.station_id")))

ORACLE["r05_congestion_impact_by_station"] = q(_impact_sql(_TJ, "congestion_level", "station_id"), ("hu", HU))


# ============================================== row rules of the sinks, forms for one station

P07N_BODY = f"""
SELECT CAST(NULL AS VARCHAR) AS station_id, 'peak_hours' AS pattern_type, 'Peak usage occurs during hours: [' ||
       COALESCE((SELECT string_agg(CAST(hour AS VARCHAR), ', ' ORDER BY hour) FROM ({P01N_BODY})), '') || ']' AS description,
       0.85 AS confidence
UNION ALL
SELECT NULL, 'day_of_week', 'Weekday vs Weekend pattern: ' ||
       printf('{{''weekday_sessions'': %d, ''weekend_sessions'': %d, ''weekday_energy_kwh'': %s, ''weekend_energy_kwh'': %s, ''pattern'': ''%s''}}',
              weekday_sessions, weekend_sessions, CAST(weekday_energy_kwh AS VARCHAR),
              CAST(weekend_energy_kwh AS VARCHAR), pattern), 0.80
FROM ({P02N_BODY})
UNION ALL
SELECT NULL, 'usage_spikes', printf('Detected %d usage spikes', COUNT(*)), 0.75 FROM ({_DAILY_ZN}) WHERE z > 2 HAVING COUNT(*) > 0
UNION ALL
SELECT NULL, 'low_usage_periods', printf('Identified %d low usage periods', COUNT(*)), 0.70 FROM ({_DAILY_ZN}) WHERE z < -1.5
HAVING COUNT(*) > 0
UNION ALL
SELECT NULL, 'session_duration', description, 0.75 FROM ({P05N_BODY})"""

ORACLE.update({
    "k01_upsert_stations": q("""SELECT id, CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN name || '*' ELSE name END AS name, city
FROM charging_stations"""),
    "k03_weather_row_rules": q("SELECT id, CAST(trunc(precipitation_mm) AS DOUBLE) AS humidity_percent FROM weather_data"),
    "k06_anomaly_row_rules": q("SELECT id, COALESCE(is_resolved, FALSE) AS is_resolved FROM anomaly_detection"),
    "k12_cascade_sessions": q("""SELECT id, station_id FROM usage_data
WHERE station_id NOT IN (SELECT id FROM charging_stations WHERE CAST(id AS BIGINT) % 7 = 0) OR station_id IS NULL"""),
    "p03_usage_spikes_network": q(f"""SELECT CAST(date AS TIMESTAMP) AS date, session_count, round(z, 6) AS z_score
FROM ({_DAILY_ZN}) WHERE z > 2"""),
    "p07_usage_pattern_summary_network": q(P07N_BODY, ("h", P01N_H)),
    "p08_sessions_by_day_name": q("SELECT dayname(session_start) AS day, COUNT(*) AS session_count FROM usage_data GROUP BY 1"),
    "v11_station_statistics_one": q(f"SELECT * FROM ({V11_BODY}) WHERE station_id = '3'"),
    "s12_union_flow_incidents": q("""SELECT station_id, "timestamp", congestion_level,
  CASE WHEN congestion_level <> 'severe' THEN CAST(average_speed_kmh AS DOUBLE) END AS average_speed_kmh,
  CASE WHEN congestion_level = 'severe' THEN 'incident' ELSE 'flow' END AS record_kind
FROM traffic_data WHERE congestion_level IS NOT NULL"""),
})

# a forest scores every station and flags those strictly below the interpolated quantile of the scores
ORACLE["a01_forest_summary"] = q("""SELECT COUNT(*) AS stations, COUNT(*) AS scored,
  CAST(ceil(0.1 * (COUNT(*) - 1)) AS BIGINT) AS flagged FROM charging_stations WHERE id IS NOT NULL""")


# ============================================== rules that the plain tables never set off

def u(body: str, *ctes: tuple[str, str]) -> str:
    return q(body, *ctes, adapters=UNEVEN_SQL)


def _json(*fields: tuple[str, str]) -> str:
    """A JSON object from (name, SQL text of the value); NULL values are left out."""
    return "'{' || concat_ws(',', " + ", ".join(f"""'"{n}":' || {v}""" for n, v in fields) + ") || '}'"


def _quoted(c: str) -> str:
    return f"""'"' || {c} || '"'"""


def _text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


_DAY = _json(("date", _quoted("CAST(CAST(date AS DATE) AS VARCHAR)")), ("session_count", _text("session_count")),
             ("z_score", _text("z_score")))


def _days(name: str, body: str) -> str:
    return f"""SELECT station_id, '{{"{name}":[' || string_agg({_DAY}, ',' ORDER BY date) || ']}}' AS details
FROM ({body}) GROUP BY station_id"""


def _details(summary: str, peak: str, split: str, spikes: str, low: str, durations: str) -> str:
    """The rows of a pattern summary with the details of each type."""
    parts = (
        ("peak_hours", f"""SELECT station_id, '{{"peak_hours":[' || coalesce(string_agg({_text('hour')}, ',' ORDER BY hour), '')
           || ']}}' AS details FROM ({peak}) GROUP BY station_id"""),
        ("day_of_week", "SELECT station_id, " + _json(
            *[(c, _text(c)) for c in ("weekday_sessions", "weekend_sessions", "weekday_energy_kwh", "weekend_energy_kwh")],
            ("pattern", _quoted("pattern"))) + f" AS details FROM ({split})"),
        ("usage_spikes", _days("spikes", spikes)), ("low_usage_periods", _days("low_periods", low)),
        ("session_duration", "SELECT station_id, " + _json(*[(c, _text(c)) for c in (
            "avg_duration_minutes", "median_duration_minutes", "min_duration_minutes", "max_duration_minutes",
            "std_duration_minutes")]) + f" AS details FROM ({durations})"))
    all_ = "\nUNION ALL\n".join(f"SELECT station_id, '{t}' AS pattern_type, details FROM ({b})" for t, b in parts)
    return f"""SELECT s.*, d.details FROM ({summary}) s JOIN ({all_}) d
ON s.station_id IS NOT DISTINCT FROM d.station_id AND s.pattern_type = d.pattern_type"""


_NONE = "CAST(NULL AS VARCHAR) AS station_id, "
P07D_BODY = _details(
    P07_BODY, f"""SELECT g.station_id, p.hour FROM (SELECT DISTINCT station_id FROM usage_data WHERE station_id IS NOT NULL) g
  LEFT JOIN ({P01_BODY}) p ON g.station_id = p.station_id""", P02_BODY, P03_BODY, P04_BODY, P05_BODY)
P03N_BODY = P04N_BODY.replace("z < -1.5", "z > 2")
P07DN_BODY = _details(
    P07N_BODY, f"SELECT {_NONE}p.hour FROM (SELECT 1) LEFT JOIN ({P01N_BODY}) p ON true",
    *[f"SELECT {_NONE}* FROM ({b})" for b in (P02N_BODY, P03N_BODY, P04N_BODY, P05N_BODY)])

S02C_BODY = """
SELECT CAST(CAST(id AS BIGINT) * 10 + j AS VARCHAR) || '_' || CAST(length(connector_type) + j AS VARCHAR) AS id,
       station_id, connector_type, COALESCE(CAST(power_kw AS DOUBLE) + j, 0) AS power_kw,
       CASE WHEN j % 2 = 0 THEN 230.0 ELSE 0.0 END AS voltage, 0.0 AS amperage,
       CASE WHEN j = 1 THEN 'Operational' ELSE 'Unknown' END AS status, TIMESTAMP '2024-02-01 00:00:00' AS last_updated
FROM (SELECT *, unnest(range(1 + CAST(id AS BIGINT) % 4)) AS j FROM charging_points)"""


def _weather_sql(source: str) -> str:
    return f"""
SELECT station_id, date_trunc('second', "timestamp") + j * INTERVAL 1 HOUR AS "timestamp",
       COALESCE(CAST(temperature_celsius AS DOUBLE) + j, 0) AS temperature_celsius,
       CAST(id % 100 AS DOUBLE) AS humidity_percent, CAST(1000 + id % 50 AS DOUBLE) AS pressure_hpa,
       CAST(id % 30 AS DOUBLE) AS wind_speed_ms, CAST(id % 360 AS DOUBLE) AS wind_direction_degrees,
       COALESCE(CAST(precipitation_mm AS DOUBLE), 0) AS precipitation_mm,
       COALESCE(weather_condition, '') AS weather_condition,
       COALESCE(lower(weather_condition), '') AS weather_description,
       CASE WHEN id % 20 > 0 THEN CAST(id % 20 * 500 AS DOUBLE) / 1000 END AS visibility_km,
       CAST(id % 12 AS DOUBLE) AS uv_index, CAST(id % 101 AS DOUBLE) AS cloudiness_percent
FROM ({source})"""


_ITEMS3 = ((_SP, _JF), (f"({_SP} / 2)", f"({_JF} / 2)"), (f"({_SP} + 25)", _JF))
_VALID3 = [f"COALESCE({s} > 0 AND {j} > 0, FALSE)" for s, j in _ITEMS3]
_ADDED = lambda terms: " + ".join(f"CASE WHEN {v} THEN {x} ELSE 0 END" for v, x in zip(_VALID3, terms))
S09C_BODY = f"""
SELECT station_id, "timestamp", jsum / n AS traffic_density, ssum / n AS average_speed_kmh,
       CASE WHEN sev > n * 0.5 THEN 'severe' WHEN modr > n * 0.3 THEN 'moderate' ELSE 'light' END AS congestion_level,
       'highway' AS road_type, 0.0 AS distance_to_station_km, CAST(0 AS BIGINT) AS incident_count
FROM (SELECT station_id, "timestamp", {_ADDED(["1"] * 3)} AS n, {_ADDED([j for _, j in _ITEMS3])} AS jsum,
             {_ADDED([s for s, _ in _ITEMS3])} AS ssum,
             {_ADDED([f"CAST({s} < 20 AS INTEGER)" for s, _ in _ITEMS3])} AS sev,
             {_ADDED([f"CAST({s} >= 20 AND {s} < 40 AS INTEGER)" for s, _ in _ITEMS3])} AS modr FROM traffic_data)
WHERE n > 0"""

S11_BODY = """
SELECT station_id, "timestamp", COALESCE(congestion_level, '') AS incident_type,
       CASE WHEN j <> 1 THEN 'incident ' || id || '-' || j ELSE '' END AS description,
       CASE WHEN j <> 0 THEN CAST(j AS VARCHAR) ELSE '' END AS severity,
       '{"LATITUDE":' || CAST(id % 90 + CAST(0.5 AS DOUBLE) AS VARCHAR) || ',"LONGITUDE":'
         || CAST(j + CAST(0.25 AS DOUBLE) AS VARCHAR) || '}' AS location
FROM (SELECT *, unnest(range(id % 3)) AS j FROM traffic_data)"""

K02_BODY = """
SELECT id, station_id, connector_type, CAST(power_kw + CASE WHEN k = 1 THEN 0 ELSE 1 END AS DOUBLE) AS power_kw,
       CASE WHEN k = 0 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS last_updated,
       CASE WHEN k = 1 THEN 'first' ELSE 'second' END AS _query
FROM (SELECT *, CAST(id AS BIGINT) % 3 AS k FROM charging_points)"""

D02S_BODY = """
SELECT service, period, period_start, calls, quota_limit, quota_limit - calls AS remaining, calls < quota_limit AS can_use
FROM (SELECT service, period, date_trunc(period, started_at) AS period_start, COUNT(*) AS calls,
             CAST(1000 AS BIGINT) AS quota_limit
      FROM (SELECT started_at, CASE data_source WHEN '1-URGENT' THEN 'openchargemap' WHEN '2-HIGH' THEN 'openweather'
                     WHEN '3-MEDIUM' THEN 'here_maps' ELSE data_source END AS service,
                   CASE WHEN data_source = '3-MEDIUM' THEN 'month' ELSE 'day' END AS period
            FROM data_collection_log WHERE data_source IS NOT NULL AND started_at IS NOT NULL) GROUP BY 1, 2, 3)"""

ORACLE.update({
    "b04_underutilized_stations_uneven": u(B04_BODY, ST),
    "b05_capacity_expansion_uneven": u(B05_BODY, ST, PP),
    "b08_network_recommendations_uneven": u(B08_BODY, ST, PP),
    "b17_station_recommendations_uneven": u(B17_BODY, PP, B17_S),
    "b18_station_insights_uneven": u(B18_BODY, PP, B17_S),
    "p01_peak_hours_network_uneven": u(P01N_BODY, ("h", P01N_H)),
    "p03_usage_spikes_network_uneven": u(P03N_BODY),
    "p07_usage_pattern_details": q(P07D_BODY),
    "p07_usage_pattern_details_uneven": u(P07D_BODY),
    "p07_usage_pattern_details_network_uneven": u(P07DN_BODY, ("h", P01N_H)),
    "d01_energy_consumption_uneven": u(D01_BODY, ENERGY),
    "f02_usage_features_uneven": u(F02_BODY),
    "s02_explode_connections": q(S02C_BODY),
    "s05_parse_full_weather_documents": q(_weather_sql("SELECT *, 0 AS j FROM weather_data")),
    "s07_explode_forecasts": q(_weather_sql("SELECT *, unnest(range(8)) AS j FROM weather_data")),
    "s09_parse_congested_flow": q(S09C_BODY),
    "s11_parse_incidents": q(S11_BODY),
    "k02_upsert_points": q(K02_BODY),
    "d02_quota_usage_services": q(D02S_BODY),
    "d03_lookup_weather": q("""SELECT id, station_id, "timestamp", CAST(temperature_celsius AS DOUBLE) AS temperature_celsius,
  CAST(precipitation_mm AS DOUBLE) AS precipitation_mm, weather_condition FROM weather_data WHERE station_id = '7'"""),
    "d03_lookup_traffic": q("""SELECT id, station_id, "timestamp", CAST(traffic_density AS DOUBLE) AS traffic_density,
  CAST(average_speed_kmh AS DOUBLE) AS average_speed_kmh, congestion_level FROM traffic_data WHERE station_id = '7'"""),
    "d03_lookup_anomalies": q("""SELECT id, station_id, anomaly_type, CAST(severity_score AS DOUBLE) AS severity_score,
  detected_at, is_resolved FROM anomaly_detection WHERE station_id = '7'"""),
    "d03_lookup_station": q("""SELECT id, name, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  city, state, country, operator FROM charging_stations WHERE id = '7'"""),
})
