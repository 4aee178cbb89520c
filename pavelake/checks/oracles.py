"""SQL for DuckDB that gives, from ``events`` alone, what each registered query must give."""

from __future__ import annotations

from pavelake.sources.bindings import TRUNCATED

_PAYLOAD = """
payload AS (
  SELECT event_id, ts AS sent_at,
    'V' || user_id AS vehicle_id,
    CASE WHEN event_id % 97 <> 0 THEN 'R' || (user_id % 5 + 1) || '00' END AS road_id,
    CASE user_id % 5 WHEN 0 THEN 'CBD' WHEN 1 THEN 'AIRPORT' WHEN 2 THEN 'TECHPARK'
                     WHEN 3 THEN 'SUBURB' ELSE 'TRAINSTATION' END AS city_zone,
    CASE WHEN event_id % 53 = 0 THEN 'FAST' WHEN event_id % 59 = 0 THEN NULL
         WHEN event_id % 61 = 0 THEN '-40' ELSE CAST(value AS VARCHAR) END AS speed,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 AS INTEGER) AS congestion_level,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 11 AS INTEGER) AS traffic_volume,
    CASE WHEN event_type = 'error' THEN 1 WHEN event_id % 71 = 0 THEN 2 ELSE 0 END AS incident_flag,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'HAIL' WHEN event_type = 'view' THEN 'RAIN'
         WHEN event_type = 'purchase' THEN 'FOG' WHEN event_type = 'signup' THEN 'STORM'
         WHEN event_type IN ('click', 'error') THEN 'CLEAR' END AS weather,
    CASE WHEN event_id % 89 = 0 THEN 'not-a-time'
         WHEN event_id % 83 = 0 THEN '2099-01-01T00:00:00+00:00'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS event_time
  FROM events)"""

_TEXT = """'{' || concat_ws(',',
    '"vehicle_id":"' || vehicle_id || '"', '"road_id":"' || road_id || '"',
    '"city_zone":"' || city_zone || '"', '"speed":"' || speed || '"',
    '"congestion_level":' || congestion_level, '"traffic_volume":' || traffic_volume,
    '"incident_flag":' || incident_flag, '"weather":"' || weather || '"',
    '"event_time":"' || event_time || '"') || '}'"""

_MESSAGES = f"""
messages AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN '{TRUNCATED}' ELSE {_TEXT} END AS raw_json,
    sent_at AS kafka_timestamp
  FROM payload)"""

_TWICE = f"""
messages AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN '{TRUNCATED}' ELSE {_TEXT} END AS raw_json,
    sent_at + to_minutes(d.delay) AS kafka_timestamp
  FROM payload JOIN (VALUES (0), (1)) AS d(delay) ON d.delay = 0 OR event_id % 20 = 0)"""

_CHANGED = f"""
messages AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN '{TRUNCATED}'
              WHEN event_id % 31 = 0 THEN left(u, -1) || ',"unit":{{"speed":"kmh"}}}}' ELSE u END AS raw_json, sent_at AS kafka_timestamp
  FROM (SELECT *, CASE WHEN event_id % 58 = 0 THEN left(t, -1) || ',"lane":' || (event_id % 4) || '}}'
                       WHEN event_id % 29 = 0 THEN left(t, -1) || ',"lane":"left"}}' ELSE t END AS u
    FROM (SELECT *, '{{' || concat_ws(',',
      '"vehicle_id":"' || vehicle_id || '"', '"road_id":"' || road_id || '"',
      '"city_zone":"' || city_zone || '"', '"speed":"' || speed || '"',
      '"congestion_level":' || CASE WHEN event_id % 43 = 0 THEN '"' || congestion_level || '"' ELSE congestion_level::VARCHAR END,
      '"traffic_volume":' || traffic_volume || CASE WHEN event_id % 47 = 0 THEN '.5' ELSE '' END,
      '"incident_flag":' || incident_flag, '"weather":"' || weather || '"',
      '"event_time":"' || event_time || '"') || '}}' AS t FROM payload)))"""

# The raw table takes an integer for what it is only if the payload says so; the second one takes whatever holds a number.
_STRICT = """
bronze AS (
  SELECT raw_json, kafka_timestamp,
    j ->> '$.vehicle_id' AS vehicle_id, j ->> '$.road_id' AS road_id, j ->> '$.city_zone' AS city_zone, j ->> '$.speed' AS speed,
    CASE WHEN json_type(j, '$.congestion_level') IN ('UBIGINT', 'BIGINT') THEN CAST(j ->> '$.congestion_level' AS INTEGER) END AS congestion_level,
    CASE WHEN json_type(j, '$.traffic_volume') IN ('UBIGINT', 'BIGINT') THEN CAST(j ->> '$.traffic_volume' AS INTEGER) END AS traffic_volume,
    CAST(j ->> '$.incident_flag' AS INTEGER) AS incident_flag, j ->> '$.weather' AS weather, j ->> '$.event_time' AS event_time
  FROM (SELECT *, CASE WHEN json_valid(raw_json) THEN CAST(raw_json AS JSON) END AS j FROM messages))"""
_FILLED = """
bronze AS (
  SELECT * REPLACE (CAST(trunc(CAST(j ->> '$.congestion_level' AS DOUBLE)) AS INTEGER) AS congestion_level,
                    CAST(trunc(CAST(j ->> '$.traffic_volume' AS DOUBLE)) AS INTEGER) AS traffic_volume)
  FROM (SELECT *, CASE WHEN json_valid(raw_json) THEN CAST(raw_json AS JSON) END AS j FROM strict_bronze))"""

_BRONZE = """
bronze AS (
  SELECT raw_json, kafka_timestamp,
    j ->> '$.vehicle_id' AS vehicle_id, j ->> '$.road_id' AS road_id, j ->> '$.city_zone' AS city_zone,
    j ->> '$.speed' AS speed,
    CAST(j ->> '$.congestion_level' AS INTEGER) AS congestion_level,
    CAST(j ->> '$.traffic_volume' AS INTEGER) AS traffic_volume,
    CAST(j ->> '$.incident_flag' AS INTEGER) AS incident_flag,
    j ->> '$.weather' AS weather, j ->> '$.event_time' AS event_time
  FROM (SELECT *, CASE WHEN json_valid(raw_json) THEN CAST(raw_json AS JSON) END AS j FROM messages))"""

_TYPED = """
typed AS (
  SELECT *, CAST(trunc(try_cast(speed AS DOUBLE)) AS INTEGER) AS speed_int,
    traffic_volume AS traffic_volume_int, incident_flag AS incident_flag_int,
    congestion_level AS congestion_level_int, try_cast(event_time AS TIMESTAMP) AS event_ts
  FROM bronze)"""

_FLAGGED = """
flagged AS (
  SELECT *,
    CAST(coalesce(raw_json IS NOT NULL AND coalesce(vehicle_id, road_id, city_zone, event_time) IS NOT NULL,
                  false) AS INTEGER) AS parse_ok,
    CAST(vehicle_id IS NOT NULL AND road_id IS NOT NULL AND city_zone IS NOT NULL AND event_time IS NOT NULL
         AS INTEGER) AS required_fields_ok,
    CAST(coalesce(speed_int BETWEEN 0 AND 160, false) AS INTEGER) AS speed_valid,
    CAST(coalesce(traffic_volume_int BETWEEN 0 AND 1000, false) AS INTEGER) AS traffic_volume_valid,
    CAST(coalesce(incident_flag_int IN (0, 1), false) AS INTEGER) AS incident_flag_valid,
    CAST(coalesce(congestion_level_int BETWEEN 1 AND 5, false) AS INTEGER) AS congestion_level_valid,
    CAST(coalesce(weather IN ('CLEAR', 'RAIN', 'FOG', 'STORM'), false) AS INTEGER) AS weather_valid,
    CAST(road_id IS NOT NULL AND city_zone IS NOT NULL AS INTEGER) AS location_valid,
    CAST(coalesce(event_ts <= TIMESTAMP '2030-01-01 00:10:00', false) AS INTEGER) AS time_valid
  FROM typed)"""

_VALIDATED = """
validated AS (
  SELECT *, CASE WHEN invalid_reason = '' THEN 'OK' ELSE 'REJECTED' END AS dq_flag
  FROM (SELECT *, concat_ws('|',
      CASE WHEN parse_ok = 0 THEN 'PARSE_FAILURE' END,
      CASE WHEN required_fields_ok = 0 THEN 'MISSING_REQUIRED_FIELDS' END,
      CASE WHEN speed_valid = 0 THEN 'INVALID_SPEED' END,
      CASE WHEN traffic_volume_valid = 0 THEN 'INVALID_TRAFFIC_VOLUME' END,
      CASE WHEN incident_flag_valid = 0 THEN 'INVALID_INCIDENT_FLAG' END,
      CASE WHEN congestion_level_valid = 0 THEN 'INVALID_CONGESTION_LEVEL' END,
      CASE WHEN weather_valid = 0 THEN 'INVALID_WEATHER' END,
      CASE WHEN location_valid = 0 THEN 'INVALID_LOCATION' END,
      CASE WHEN time_valid = 0 THEN 'INVALID_EVENT_TIME' END) AS invalid_reason
    FROM flagged))"""

_UNIQUE = """
clean AS (
  SELECT * EXCLUDE (arrival) FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_id, event_ts
                                 ORDER BY kafka_timestamp, raw_json) AS arrival
    FROM validated WHERE dq_flag = 'OK')
  WHERE arrival = 1)"""

_CLEAN = """
clean AS (SELECT * FROM validated WHERE dq_flag = 'OK')"""

_SILVER = """
silver AS (
  SELECT *, CAST(hour(event_ts) AS INTEGER) AS hour,
    CASE WHEN hour(event_ts) BETWEEN 8 AND 11 OR hour(event_ts) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS peak_flag,
    CASE WHEN speed_int < 30 THEN 'LOW' WHEN speed_int < 70 THEN 'MEDIUM' ELSE 'HIGH' END AS speed_band,
    CASE WHEN traffic_volume_int < 80 THEN 'LOW' WHEN traffic_volume_int < 140 THEN 'MEDIUM'
         ELSE 'HIGH' END AS traffic_band
  FROM clean)"""

_FACT = """
fact AS (
  SELECT vehicle_id, road_id, city_zone, weather, event_ts, hour, peak_flag, speed_int, speed_band,
    traffic_volume_int, traffic_band, congestion_level_int, incident_flag_int, CAST(event_ts AS DATE) AS event_date
  FROM silver)"""

_DIMS = """
dim_zone AS (
  SELECT city_zone,
    CASE WHEN city_zone = 'CBD' THEN 'Commercial' WHEN city_zone = 'TECHPARK' THEN 'IT Hub'
         WHEN city_zone IN ('AIRPORT', 'TRAINSTATION') THEN 'Transit Hub' ELSE 'Residential' END AS zone_type,
    CASE WHEN city_zone IN ('CBD', 'AIRPORT', 'TRAINSTATION') THEN 'HIGH' WHEN city_zone = 'TECHPARK' THEN 'MEDIUM'
         ELSE 'LOW' END AS traffic_risk
  FROM (SELECT DISTINCT city_zone FROM silver)),
dim_road AS (
  SELECT road_id, CASE WHEN road_id IN ('R100', 'R200') THEN 'Highway' ELSE 'City Road' END AS road_type,
    CASE WHEN road_id IN ('R100', 'R200') THEN 100 ELSE 60 END AS speed_limit
  FROM (SELECT DISTINCT road_id FROM silver)),
dim_weather AS (
  SELECT weather, CASE weather WHEN 'CLEAR' THEN 'LOW' WHEN 'RAIN' THEN 'MEDIUM' WHEN 'FOG' THEN 'HIGH'
    WHEN 'STORM' THEN 'HIGH' ELSE 'UNKNOWN' END AS weather_severity
  FROM (SELECT DISTINCT weather FROM silver))"""

_HOURLY = """
zone_hourly AS (
  SELECT date_trunc('hour', event_ts) AS window_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
    city_zone, weather, peak_flag, count(*) AS event_count, avg(speed_int) AS avg_speed,
    avg(traffic_volume_int) AS avg_traffic_volume, avg(congestion_level_int) AS avg_congestion_level,
    CAST(sum(incident_flag_int) AS BIGINT) AS incident_count, min(speed_int) AS min_speed, max(speed_int) AS max_speed
  FROM silver GROUP BY ALL),
road_hourly AS (
  SELECT date_trunc('hour', event_ts) AS window_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
    road_id, weather, count(*) AS event_count, avg(speed_int) AS avg_speed,
    avg(traffic_volume_int) AS avg_traffic_volume, avg(congestion_level_int) AS avg_congestion_level,
    CAST(sum(incident_flag_int) AS BIGINT) AS incident_count
  FROM silver GROUP BY ALL)"""

_TRAIN = """
train AS (
  SELECT vehicle_id, event_ts, hour, peak_flag, traffic_volume_int, congestion_level_int, incident_flag_int,
    road_id, city_zone, weather, traffic_band, speed_int
  FROM fact
  WHERE hour IS NOT NULL AND peak_flag IS NOT NULL AND traffic_volume_int IS NOT NULL
    AND congestion_level_int IS NOT NULL AND incident_flag_int IS NOT NULL AND road_id IS NOT NULL
    AND city_zone IS NOT NULL AND weather IS NOT NULL AND traffic_band IS NOT NULL AND speed_int IS NOT NULL)"""

# A stand-in for a model, so that errors and metrics can be checked to the last digit.
_GUESS = "70 - 10 * congestion_level_int + traffic_volume_int / 8.0::DOUBLE"
_BUCKET = ("CAST(CAST('0x' || substr(md5(vehicle_id || '|' || CAST(epoch_us(event_ts) AS VARCHAR)), 1, 8) AS BIGINT)"
           " % 10 AS INTEGER)")

_STEPS = {
    "payload": _PAYLOAD,
    "messages": _MESSAGES,
    "bronze": _BRONZE,
    "typed": _TYPED,
    "flagged": _FLAGGED,
    "validated": _VALIDATED,
    "clean": _CLEAN,
    "silver": _SILVER,
    "fact": _FACT,
    "dims": _DIMS,
    "hourly": _HOURLY,
    "train": _TRAIN,
}


def _sql(select: str, upto: str, *, twice: bool = False, without: tuple[str, ...] = ()) -> str:
    names = list(_STEPS)
    steps = {name: text for name, text in _STEPS.items() if name not in without}
    if twice:
        steps |= {"messages": _TWICE, "clean": _UNIQUE}
    chain = [steps[name] for name in names[: names.index(upto) + 1] if name in steps]
    return "WITH " + ",".join(chain) + "\n" + select


_MODEL_COLUMNS = ("vehicle_id, event_ts, hour, peak_flag, traffic_volume_int, congestion_level_int, "
                  "incident_flag_int, road_id, city_zone, weather, traffic_band, speed_int")

_CLOSED = """
  WHERE window_end <= (SELECT date_trunc('millisecond', max(event_ts)) FROM silver) - INTERVAL 15 MINUTE"""


def _one_hot(column: str) -> str:
    return (f"(SELECT string_agg(CASE WHEN c.v = t.{column} THEN '1' ELSE '0' END, ',' ORDER BY c.v)"
            f" FROM (SELECT DISTINCT {column} AS v FROM train) c)")


_SILVER_WITHOUT_ARRIVAL = "SELECT * EXCLUDE (kafka_timestamp) FROM silver"


_RAW_GAPS = ("REPLACE (CAST(congestion_level AS DOUBLE) AS congestion_level, CAST(traffic_volume AS DOUBLE) AS "
             "traffic_volume, CAST(incident_flag AS DOUBLE) AS incident_flag)")
_TYPED_GAPS = _RAW_GAPS[:-1] + "".join(
    f", CAST({name} AS DOUBLE) AS {name}"
    for name in ("congestion_level_int", "traffic_volume_int", "incident_flag_int", "speed_int")) + ")"
_MIDNIGHT = "REPLACE (CAST(event_date AS TIMESTAMP) AS event_date)"


_NUMERIC = ("hour", "peak_flag", "traffic_volume_int", "congestion_level_int", "incident_flag_int")


def _recovered() -> str:
    """Both judgements beside each other, for rows of which the second raw table holds more."""
    def judged(prefix: str) -> str:
        text = ",".join((_TYPED, _FLAGGED, _VALIDATED))
        for name in ("validated", "flagged", "typed", "bronze"):
            text = text.replace(f"{name} AS (", f"{prefix}_{name} AS (").replace(f"FROM {name}", f"FROM {prefix}_{name}")
        return text

    gained = ("concat_ws(',', CASE WHEN s.congestion_level IS NULL AND f.congestion_level IS NOT NULL THEN 'congestion_level' END, "
              "CASE WHEN s.traffic_volume IS NULL AND f.traffic_volume IS NOT NULL THEN 'traffic_volume' END)")
    chain = ",".join((_PAYLOAD, _CHANGED, _STRICT.replace("bronze AS (", "strict_bronze AS (", 1),
                      _FILLED.replace("bronze AS (", "filled_bronze AS (", 1), judged("strict"), judged("filled")))
    return f"""WITH {chain}
    SELECT s.raw_json, s.kafka_timestamp, s.invalid_reason AS former_reason, {gained} AS recovered,
      f.congestion_level::DOUBLE AS congestion_level, f.traffic_volume::DOUBLE AS traffic_volume, f.invalid_reason, f.dq_flag = 'OK' AS passes
    FROM strict_validated s JOIN filled_validated f USING (raw_json, kafka_timestamp)
    WHERE s.dq_flag = 'REJECTED' AND {gained} <> ''"""


def _drift() -> str:
    """Keys and kinds of all payload objects, against the declared ones."""
    return f"""WITH {_PAYLOAD},{_CHANGED},
    keys AS (SELECT kafka_timestamp, j, unnest(json_keys(j)) AS key FROM (
      SELECT kafka_timestamp, CAST(raw_json AS JSON) AS j FROM messages WHERE json_valid(raw_json))),
    kinds AS (SELECT kafka_timestamp, key, CASE json_type(j, '$.' || key) WHEN 'OBJECT' THEN 'object' WHEN 'VARCHAR' THEN 'text'
        WHEN 'DOUBLE' THEN 'fraction' ELSE 'whole' END AS kind,
      CASE WHEN key IN ('congestion_level', 'traffic_volume', 'incident_flag') THEN 'whole'
           WHEN key IN ('vehicle_id', 'road_id', 'city_zone', 'speed', 'weather', 'event_time') THEN 'text' END AS expected FROM keys)
    SELECT key, kind, expected, count(*) AS row_count, min(kafka_timestamp) AS first_arrival, max(kafka_timestamp) AS last_arrival
    FROM kinds WHERE kind IS DISTINCT FROM expected GROUP BY ALL"""


def _one_split(*also: str) -> str:
    """Least squared error of any single split of a number over the training rows, which every model must beat."""
    rows = f"(SELECT * FROM train WHERE {_BUCKET} < 8)"
    values = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS x, speed_int::DOUBLE AS y FROM {rows}" for c in _NUMERIC)
    columns = "".join(f", {c}" for c in also)
    return (
        f"SELECT all_n AS row_count, round(min(all_ss - s * s / n - CASE WHEN all_n > n THEN (all_s - s) * (all_s - s) / (all_n - n) "
        f"ELSE 0 END), 3) AS one_split_sse, true AS beats_one_split{columns} FROM ("
        "SELECT feature, sum(n) OVER w AS n, sum(s) OVER w AS s FROM ("
        f"SELECT feature, x, count(*) AS n, sum(y) AS s FROM ({values}) GROUP BY feature, x) "
        "WINDOW w AS (PARTITION BY feature ORDER BY x)), "
        f"(SELECT count(*) AS all_n, sum(speed_int::DOUBLE) AS all_s, sum(speed_int::DOUBLE * speed_int) AS all_ss FROM {rows}) "
        "GROUP BY all_n")


def _boosting_step() -> str:
    """The mean, moved by a twentieth towards the means of the two sides of the best split of a number or a category."""
    rows = f"(SELECT * FROM train WHERE {_BUCKET} < 8)"
    numbers = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS x, speed_int::DOUBLE AS y FROM {rows}" for c in _NUMERIC)
    categories = " UNION ALL ".join(
        f"SELECT count(*)::HUGEINT AS n, sum(speed_int::DOUBLE) AS s FROM {rows} GROUP BY {c}" for c in ("road_id", "city_zone", "weather", "traffic_band"))
    return (
        "SELECT round(m + 0.05 * (unnest([s / n, (all_s - s) / (all_n - n)]) - m), 6) AS prediction, unnest([n, all_n - n])::BIGINT AS row_count FROM ("
        "SELECT *, all_s / all_n AS m, row_number() OVER (ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC) AS place FROM ("
        "SELECT sum(n) OVER w AS n, sum(s) OVER w AS s FROM ("
        f"SELECT feature, x, count(*) AS n, sum(y) AS s FROM ({numbers}) GROUP BY feature, x) "
        f"WINDOW w AS (PARTITION BY feature ORDER BY x) UNION ALL {categories}), "
        f"(SELECT count(*) AS all_n, sum(speed_int::DOUBLE) AS all_s FROM {rows}) WHERE n < all_n) WHERE place = 1")


def oracles() -> dict[str, str]:
    profile = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST(cid AS INTEGER) AS position, column_name, n AS row_count "
        f"FROM (SELECT count(*) AS n FROM {source}) CROSS JOIN (VALUES {columns}) AS c(cid, column_name)"
        for table, source, columns in (
            ("dim_road", "dim_road", "(0, 'road_id'), (1, 'road_type'), (2, 'speed_limit')"),
            ("dim_weather", "dim_weather", "(0, 'weather'), (1, 'weather_severity')"),
            ("dim_zone", "dim_zone", "(0, 'city_zone'), (1, 'zone_type'), (2, 'traffic_risk')"),
            ("fact", "fact", ", ".join(f"({i}, '{c}')" for i, c in enumerate((
                "vehicle_id", "road_id", "city_zone", "weather", "event_ts", "hour", "peak_flag", "speed_int",
                "speed_band", "traffic_volume_int", "traffic_band", "congestion_level_int", "incident_flag_int",
                "event_date", "ingested_at")))),
        )
    )
    zone_rows = "SELECT * FROM zone_hourly"
    road_rows = "SELECT * FROM road_hourly"
    fact_rows = f"SELECT * {_MIDNIGHT} FROM fact"
    speed_by = "SELECT {0}, avg(speed_int) AS avg_speed, count(*) AS row_count FROM fact GROUP BY {0}"
    return {
        "bronze_parse": _sql(f"SELECT * {_RAW_GAPS} FROM bronze", "bronze"),
        "bronze_stream": _sql(f"SELECT * {_RAW_GAPS} FROM bronze", "bronze"),
        "encode_roundtrip": _sql(
            "SELECT vehicle_id, road_id, city_zone, speed, congestion_level, traffic_volume, incident_flag, "
            "weather, event_time, sent_at AS kafka_timestamp FROM payload", "payload"),
        "publish_stream": _sql("SELECT vehicle_id, road_id, city_zone, weather, event_ts, speed_int FROM fact", "fact"),
        "silver_typed": _sql(f"SELECT * {_TYPED_GAPS} FROM typed", "typed"),
        "dq_flags": _sql(f"SELECT * {_TYPED_GAPS} FROM flagged", "flagged"),
        "dq_reasons": _sql("SELECT raw_json, kafka_timestamp, invalid_reason, dq_flag, "
                           "CAST(CASE WHEN invalid_reason = '' THEN 0 "
                           "ELSE len(string_split(invalid_reason, '|')) END AS INTEGER) AS reason_count "
                           "FROM validated", "validated"),
        "silver_clean": _sql("SELECT * FROM clean", "clean"),
        "silver_rejected": _sql(f"SELECT * {_TYPED_GAPS} FROM validated WHERE dq_flag = 'REJECTED'",
            "validated"),
        "rejected_stream": _sql(f"SELECT * {_TYPED_GAPS} FROM validated WHERE dq_flag = 'REJECTED'",
            "validated"),
        "silver_rejected_split": _sql("SELECT raw_json, kafka_timestamp, vehicle_id, event_ts, invalid_reason, "
                                      "dq_flag FROM validated", "validated"),
        "silver_dedup": _sql("SELECT * FROM clean", "clean", twice=True),
        "silver_features": _sql("SELECT * FROM silver", "silver"),
        "silver_stream": _sql(_SILVER_WITHOUT_ARRIVAL, "silver", twice=True),
        "gold_fact": _sql(fact_rows, "fact"),
        "fact_batch": _sql("SELECT CAST(event_date AS TIMESTAMP) AS event_date, city_zone, count(*) AS row_count, "
                           "CAST(sum(speed_int) AS BIGINT) AS speed_sum FROM fact GROUP BY ALL", "fact"),
        "gold_fact_stream": _sql(fact_rows, "fact"),
        "dim_zone": _sql("SELECT * FROM dim_zone", "dims"),
        "dim_road": _sql("SELECT * FROM dim_road", "dims"),
        "dim_weather": _sql("SELECT * FROM dim_weather", "dims"),
        "dim_zone_stream": _sql("SELECT * FROM dim_zone", "dims"),
        "dim_road_stream": _sql("SELECT * FROM dim_road", "dims"),
        "dim_weather_stream": _sql("SELECT * FROM dim_weather", "dims"),
        "zone_hourly": _sql(zone_rows, "hourly"),
        "road_hourly": _sql(road_rows, "hourly"),
        "zone_hourly_stream": _sql(zone_rows, "hourly"),
        "road_hourly_stream": _sql(road_rows, "hourly"),
        "zone_hourly_complete": _sql(zone_rows, "hourly"),
        "zone_hourly_final": _sql(zone_rows + _CLOSED, "hourly"),
        "dedup_window_chain": _sql(zone_rows + _CLOSED, "hourly", twice=True),
        "late_drop_audit": _sql(
            """SELECT l.vehicle_id, l.event_ts, l.city_zone, l.weather, l.speed_int, 'LATE_EVENT' AS invalid_reason
               FROM clean l WHERE epoch_us(l.event_ts) % 7 = 0 AND l.event_ts <= (
                 SELECT date_trunc('millisecond', max(event_ts)) FROM clean
                 WHERE epoch_us(event_ts) % 7 <> 0) - INTERVAL 15 MINUTE""",
            "clean"),
        "late_rows_routed": _sql(
            """SELECT l.vehicle_id, l.event_ts, l.city_zone, l.weather, l.speed_int, 'LATE_EVENT' AS invalid_reason
               FROM clean l WHERE epoch_us(l.event_ts) % 7 = 0 AND l.event_ts <= (
                 SELECT date_trunc('millisecond', max(event_ts)) FROM clean
                 WHERE epoch_us(event_ts) % 7 BETWEEN 1 AND 5) - INTERVAL 15 MINUTE""",
            "clean"),
        "rejected_recovered": _recovered(),
        "bronze_drift": _drift(),
        "rejected_summary": _sql("SELECT invalid_reason, count(*) AS row_count FROM validated "
                                 "WHERE dq_flag = 'REJECTED' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", "validated"),
        "profile_tables": _sql(profile, "dims"),
        "speed_by_congestion": _sql(speed_by.format("congestion_level_int"), "fact"),
        "speed_by_zone": _sql(speed_by.format("city_zone"), "fact"),
        "incidents_by_zone": _sql("SELECT city_zone, CAST(sum(incident_flag_int) AS BIGINT) AS incident_count "
                                  "FROM fact GROUP BY 1", "fact"),
        "top_zone_windows": _sql(
            "SELECT window_start, window_end, city_zone, weather, event_count, avg_congestion_level, avg_speed "
            "FROM zone_hourly ORDER BY avg_congestion_level DESC, event_count DESC, window_start, city_zone, "
            "weather, peak_flag LIMIT 10", "hourly"),
        "top_road_windows": _sql(
            "SELECT window_start, window_end, road_id, weather, event_count, avg_traffic_volume, avg_speed "
            "FROM road_hourly ORDER BY avg_traffic_volume DESC, event_count DESC, window_start, road_id, weather "
            "LIMIT 10", "hourly"),
        "dash_zone_risk": _sql(
            "SELECT city_zone, zone_type, traffic_risk, avg(congestion_level_int) AS avg_congestion_level, "
            "CAST(sum(incident_flag_int) AS BIGINT) AS incident_count, count(*) AS row_count "
            "FROM fact JOIN dim_zone USING (city_zone) GROUP BY ALL", "dims"),
        "dash_speed_drop": _sql(
            "SELECT *, avg_speed - lag(avg_speed) OVER (ORDER BY congestion_level_int) AS speed_change FROM ("
            + speed_by.format("congestion_level_int") + ")", "fact"),
        "dash_weather_impact": _sql(
            "SELECT weather_severity, count(*) AS row_count, avg(speed_int) AS avg_speed, "
            "avg(traffic_volume_int) AS avg_traffic_volume, avg(incident_flag_int) AS incident_rate "
            "FROM fact JOIN dim_weather USING (weather) GROUP BY 1", "dims"),
        "dash_slow_zones": _sql(
            "SELECT city_zone, count(*) FILTER (avg_speed < 30) AS slow_windows, count(*) AS windows, "
            "count(*) FILTER (avg_speed < 30) / count(*) AS slow_share FROM ("
            "SELECT city_zone, date_trunc('hour', event_ts) AS w, avg(speed_int) AS avg_speed FROM fact GROUP BY ALL"
            ") GROUP BY 1", "fact"),
        "record_key": _sql("SELECT vehicle_id, event_ts, vehicle_id || '|' || "
                           "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS record_key FROM fact", "fact"),
        "ml_training_set": _sql(f"SELECT {_MODEL_COLUMNS} FROM train", "train"),
        "ml_split": _sql(f"SELECT vehicle_id, event_ts, {_BUCKET} AS bucket, {_BUCKET} < 8 AS is_train FROM train",
                         "train"),
        "ml_features": _sql(
            "SELECT vehicle_id, event_ts, concat_ws(',', "
            + ", ".join(_one_hot(c) for c in ("road_id", "city_zone", "weather", "traffic_band"))
            + ", hour, peak_flag, traffic_volume_int, congestion_level_int, incident_flag_int) AS features, "
              "CAST(speed_int AS DOUBLE) AS label FROM train t", "train"),
        "prediction_error": _sql(
            "SELECT vehicle_id, event_ts, speed_int, predicted_speed, "
            "round_even((speed_int - predicted_speed) * 100, 0) / 100 AS prediction_error FROM ("
            f"SELECT *, round_even(({_GUESS}) * 100, 0) / 100 AS predicted_speed FROM fact)", "fact"),
        "regression_metrics": _sql(
            "SELECT is_train, count(*)::DOUBLE AS row_weight, "
            "round_even(1e6 * (1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*))), 0) / 1e6 AS r2, "
            "round_even(1e6 * sqrt(sum((y - p) * (y - p)) / count(*)), 0) / 1e6 AS rmse, "
            "round_even(1e6 * sum(abs(y - p)) / count(*), 0) / 1e6 AS mae FROM ("
            f"SELECT {_BUCKET} < 8 AS is_train, CAST(speed_int AS DOUBLE) AS y, {_GUESS} AS p FROM train) GROUP BY 1",
            "train"),
        "ml_linear_fit": _sql(
            " UNION ALL ".join(
                [f"SELECT '{c}' AS feature, {c} AS level, count(*) AS row_count, 0.0::DOUBLE AS mean_error "
                 f"FROM train WHERE {_BUCKET} < 8 GROUP BY {c}"
                 for c in ("road_id", "city_zone", "weather", "traffic_band")]
                + [f"SELECT '{c}', 'number', count(*), 0.0::DOUBLE FROM train WHERE {_BUCKET} < 8" for c in _NUMERIC]), "train"),
        "ml_decision_tree_fit": _sql(_one_split("0.0::DOUBLE AS worst_leaf_error"), "train"),
        "ml_random_forest_fit": _sql(_one_split(), "train"),
        "ml_gbt_fit": _sql(_one_split("0.0::DOUBLE AS mean_error"), "train"),
        "ml_boosting_step": _sql(_boosting_step(), "train"),
        "ml_runs_verified": _sql(
            "SELECT model_name, test_rows, label_sum, true AS metrics_fit FROM (VALUES ('Linear Regression'), ('Decision Tree'), "
            "('Random Forest'), ('Gradient Boosting')) AS m(model_name), (SELECT count(*) AS test_rows, sum(speed_int)::BIGINT AS label_sum "
            f"FROM train WHERE {_BUCKET} >= 8)", "train"),
        "score_new_rows": _sql(
            "SELECT vehicle_id, road_id, city_zone, weather, event_ts, traffic_volume_int, congestion_level_int, "
            f"speed_int, true AS error_fits FROM fact WHERE {_BUCKET.replace('% 10', '% 2')} = 1", "fact"),
        "unscored_rows": _sql(f"SELECT * {_MIDNIGHT} FROM fact WHERE {_BUCKET} >= 8", "fact"),
    }
