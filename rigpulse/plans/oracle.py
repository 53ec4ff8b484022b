"""SQL twins of the catalog's queries, over the same tables, for checking results."""

from __future__ import annotations

_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# Shared table expressions: name -> (needed expressions, body).
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": (
        (),
        """
        SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS equipment_id,
               ts AS recorded_at,
               80 + 0.2 * value AS engine_temp_c,
               1200 + value AS engine_rpm,
               420 - 1.5 * value AS oil_pressure_kpa,
               3.5 + 0.06 * value AS vibration_mm_s,
               k AS fuel_level_pct,
               40 + 0.9 * k AS fuel_burn_rate,
               CASE WHEN user_id % 3 = 0 THEN 180 + 0.2 * value END AS payload_tonnes,
               CASE WHEN user_id % 3 = 1 THEN 90 + 0.5 * value END AS drill_rpm,
               CASE WHEN user_id % 3 = 2 THEN 300 + value END AS dig_force_kn,
               0.5 * k AS speed_kmh,
               -22.3 + 0.001 * k AS latitude,
               118.5 + 0.001 * k AS longitude,
               CASE WHEN event_type IN ('view', 'click') THEN 'operating'
                    WHEN event_type = 'signup' THEN 'idle'
                    WHEN event_type = 'purchase' THEN 'maintenance'
                    WHEN event_type = 'error' THEN 'fault' END AS status,
               CAST((event_id * 7 + user_id) % 600 AS DOUBLE) AS hours_since_service,
               CASE WHEN event_type = 'error'
                    THEN 'F' || CAST(100 + user_id % 900 AS VARCHAR) END AS fault_code
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
        """,
    ),
    "equipment": (
        (),
        """
        SELECT c_custkey::VARCHAR AS equipment_id, c_nationkey::VARCHAR AS site_id,
               CASE c_custkey % 3 WHEN 0 THEN 'haul_truck' WHEN 1 THEN 'drill_rig'
                    ELSE 'excavator' END AS equipment_type,
               c_mktsegment AS model,
               CAST(CASE WHEN c_custkey % 3 = 0 THEN 250 ELSE 500 END AS DOUBLE)
                   AS service_interval_hrs,
               c_custkey % 10 <> 9 AS active
        FROM customer
        """,
    ),
    "sites": (
        (),
        """
        SELECT n_nationkey::VARCHAR AS site_id, n_name AS site_name, r_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey
        """,
    ),
    "sensor_events": (
        ("readings", "equipment"),
        """
        SELECT r.* EXCLUDE (recorded_at), r.recorded_at AS "timestamp",
               e.equipment_type, e.site_id
        FROM readings r JOIN equipment e USING (equipment_id)
        """,
    ),
    "metric_values": (
        ("readings",),
        """
        SELECT event_id, equipment_id, recorded_at,
               unnest(['engine_temp_c', 'vibration_mm_s', 'oil_pressure_kpa', 'fuel_level_pct',
                       'hours_since_service']) AS metric,
               unnest([engine_temp_c, vibration_mm_s, oil_pressure_kpa, fuel_level_pct,
                       hours_since_service]) AS val
        FROM readings
        """,
    ),
    "flag_rules": (
        (),
        """
        SELECT * FROM (VALUES
            (1, 'HIGH_ENGINE_TEMP', 'engine_temp_c', 1, 105.0::DOUBLE),
            (2, 'WARN_ENGINE_TEMP', 'engine_temp_c', 1, 100.0),
            (3, 'HIGH_VIBRATION', 'vibration_mm_s', 1, 15.0),
            (4, 'WARN_VIBRATION', 'vibration_mm_s', 1, 10.0),
            (5, 'CRITICAL_LOW_OIL', 'oil_pressure_kpa', -1, 150.0),
            (6, 'WARN_LOW_OIL', 'oil_pressure_kpa', -1, 200.0),
            (7, 'CRITICAL_LOW_FUEL', 'fuel_level_pct', -1, 5.0),
            (8, 'WARN_LOW_FUEL', 'fuel_level_pct', -1, 15.0),
            (9, 'SERVICE_DUE', 'hours_since_service', 1, 250.0)
        ) AS t(slot, flag, metric, sign, lim)
        """,
    ),
    "raised": (
        ("metric_values", "flag_rules"),
        """
        SELECT v.event_id, v.equipment_id, v.recorded_at, r.slot, r.flag, v.metric, v.val, r.lim
        FROM metric_values v JOIN flag_rules r USING (metric)
        WHERE (r.sign = 1 AND v.val > r.lim) OR (r.sign = -1 AND v.val < r.lim)
        """,
    ),
    "flag_alerts": (
        ("raised", "equipment"),
        """
        SELECT sha256('flag#' || event_id || '#' || flag) AS alert_id,
               equipment_id, site_id, recorded_at AS triggered_at, flag AS alert_type,
               CASE WHEN flag LIKE 'CRITICAL%' OR flag LIKE 'HIGH%' THEN 'CRITICAL'
                    ELSE 'WARNING' END AS severity,
               metric, val AS value, lim AS threshold,
               equipment_id || ': ' || flag AS message
        FROM raised JOIN equipment USING (equipment_id)
        """,
    ),
    "alerts": (
        ("readings", "equipment"),
        """
        SELECT sha256('limit#' || event_id || '#' || alert_type) AS alert_id,
               equipment_id, site_id, recorded_at AS triggered_at, alert_type, severity,
               metric, val AS value, CAST(lim AS DOUBLE) AS threshold,
               severity || ': ' || equipment_id || ' ' || metric || '=' || val::VARCHAR
                   || ' (threshold=' || lim::VARCHAR || ')' AS message,
               CASE WHEN event_id::BIGINT % 4 = 0
                    THEN recorded_at + INTERVAL 2 HOUR END AS resolved_at
        FROM (
            SELECT event_id, equipment_id, recorded_at, 'HIGH_ENGINE_TEMP' AS alert_type,
                   'engine_temp_c' AS metric, engine_temp_c AS val,
                   CASE WHEN engine_temp_c > 110 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
                   CASE WHEN engine_temp_c > 110 THEN 110 ELSE 100 END AS lim
            FROM readings WHERE engine_temp_c > 100
            UNION ALL
            SELECT event_id, equipment_id, recorded_at, 'HIGH_VIBRATION', 'vibration_mm_s',
                   vibration_mm_s, CASE WHEN vibration_mm_s > 15 THEN 'CRITICAL' ELSE 'WARNING' END,
                   CASE WHEN vibration_mm_s > 15 THEN 15 ELSE 10 END
            FROM readings WHERE vibration_mm_s > 10
            UNION ALL
            SELECT event_id, equipment_id, recorded_at, 'LOW_FUEL', 'fuel_level_pct',
                   fuel_level_pct, CASE WHEN fuel_level_pct < 5 THEN 'CRITICAL' ELSE 'WARNING' END,
                   CASE WHEN fuel_level_pct < 5 THEN 5 ELSE 15 END
            FROM readings WHERE fuel_level_pct < 15
            UNION ALL
            SELECT event_id, equipment_id, recorded_at, 'LOW_OIL_PRESSURE', 'oil_pressure_kpa',
                   oil_pressure_kpa,
                   CASE WHEN oil_pressure_kpa < 150 THEN 'CRITICAL' ELSE 'WARNING' END,
                   CASE WHEN oil_pressure_kpa < 150 THEN 150 ELSE 200 END
            FROM readings WHERE oil_pressure_kpa < 200
        ) JOIN equipment USING (equipment_id)
        """,
    ),
    "newest": (
        ("readings",),
        """
        SELECT * FROM readings
        QUALIFY row_number() OVER (
            PARTITION BY equipment_id ORDER BY recorded_at DESC, event_id DESC) = 1
        """,
    ),
    "latest": (
        ("newest", "equipment"),
        """
        SELECT equipment_id, equipment_type, model, site_id, recorded_at, engine_temp_c,
               engine_rpm, oil_pressure_kpa, vibration_mm_s, fuel_level_pct, speed_kmh, status,
               fault_code, hours_since_service
        FROM newest JOIN equipment USING (equipment_id)
        """,
    ),
    "kpis": (
        ("readings", "equipment", "alerts"),
        """
        SELECT m.equipment_id, e.site_id, m.kpi_date, avg_engine_temp_c, max_engine_temp_c,
               avg_vibration_mm_s, max_vibration_mm_s, total_fuel_litres, operating_hours,
               idle_hours, fault_hours, round(operating_hours / 24 * 100, 2) AS uptime_pct,
               coalesce(alert_count, 0) AS alert_count,
               coalesce(critical_alert_count, 0) AS critical_alert_count,
               total_payload_tonnes, avg_drill_rpm
        FROM (
            SELECT equipment_id, CAST(recorded_at AS DATE) AS kpi_date,
                   avg(engine_temp_c) AS avg_engine_temp_c, max(engine_temp_c) AS max_engine_temp_c,
                   avg(vibration_mm_s) AS avg_vibration_mm_s,
                   max(vibration_mm_s) AS max_vibration_mm_s,
                   sum(fuel_burn_rate) AS total_fuel_litres,
                   count(*) FILTER (WHERE status = 'operating') / 360.0::DOUBLE AS operating_hours,
                   count(*) FILTER (WHERE status = 'idle') / 360.0::DOUBLE AS idle_hours,
                   count(*) FILTER (WHERE status = 'fault') / 360.0::DOUBLE AS fault_hours,
                   sum(payload_tonnes) AS total_payload_tonnes, avg(drill_rpm) AS avg_drill_rpm
            FROM readings GROUP BY ALL
        ) m
        LEFT JOIN (
            SELECT equipment_id, CAST(triggered_at AS DATE) AS kpi_date, count(*) AS alert_count,
                   count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alert_count
            FROM alerts GROUP BY ALL
        ) a ON a.equipment_id = m.equipment_id AND a.kpi_date = m.kpi_date
        LEFT JOIN equipment e ON e.equipment_id = m.equipment_id
        """,
    ),
    "kpi_rows": (
        ("kpis",),
        """
        SELECT * REPLACE (
            round(avg_engine_temp_c, 6) AS avg_engine_temp_c,
            round(max_engine_temp_c, 6) AS max_engine_temp_c,
            round(avg_vibration_mm_s, 6) AS avg_vibration_mm_s,
            round(max_vibration_mm_s, 6) AS max_vibration_mm_s,
            round(total_fuel_litres, 6) AS total_fuel_litres,
            round(operating_hours, 6) AS operating_hours, round(idle_hours, 6) AS idle_hours,
            round(fault_hours, 6) AS fault_hours,
            round(total_payload_tonnes, 6) AS total_payload_tonnes,
            round(avg_drill_rpm, 6) AS avg_drill_rpm)
        FROM kpis
        """,
    ),
    "health": (
        ("latest", "equipment", "sites"),
        """
        SELECT e.site_id, s.site_name, e.equipment_type, count(*) AS total_machines,
               count(*) FILTER (WHERE l.status = 'operating') AS operating,
               count(*) FILTER (WHERE l.status = 'fault') AS in_fault,
               count(*) FILTER (WHERE l.status = 'maintenance') AS in_maintenance,
               count(*) FILTER (WHERE l.status = 'idle') AS idle,
               round(avg(l.fuel_level_pct), 1) AS avg_fuel_pct,
               round(avg(l.engine_temp_c), 1) AS avg_engine_temp,
               round(avg(l.vibration_mm_s), 2) AS avg_vibration
        FROM equipment e JOIN sites s USING (site_id)
        LEFT JOIN latest l ON l.equipment_id = e.equipment_id
        WHERE e.active GROUP BY e.site_id, s.site_name, e.equipment_type
        """,
    ),
    "open_rows": (
        ("alerts", "sites"),
        f"""
        SELECT alert_id, equipment_id, a.site_id, site_name, triggered_at, alert_type, severity,
               metric, round(value, 6) AS value, threshold, message,
               (epoch_us({_AS_OF}) - epoch_us(triggered_at)) / 3600000000.0::DOUBLE AS hours_open
        FROM alerts a JOIN sites s ON a.site_id = s.site_id WHERE resolved_at IS NULL
        """,
    ),
    "services": (
        ("newest", "equipment", "sites"),
        """
        SELECT e.equipment_id, e.site_id, equipment_type, model, service_interval_hrs,
               n.hours_since_service, site_name,
               CASE WHEN n.hours_since_service >= service_interval_hrs THEN 'OVERDUE'
                    WHEN n.hours_since_service >= service_interval_hrs * 0.92::DOUBLE THEN 'DUE_SOON'
                    ELSE 'OK' END AS service_status
        FROM equipment e JOIN sites s USING (site_id)
        LEFT JOIN newest n ON n.equipment_id = e.equipment_id
        WHERE active
        """,
    ),
    "logs": (
        (),
        f"""
        SELECT sha256('log#' || o_orderkey::VARCHAR) AS log_id, o_orderkey,
               o_custkey::VARCHAR AS equipment_id,
               CAST(CAST({_AS_OF} AS DATE) - CAST(o_orderkey % 30 AS INTEGER) AS DATE)
                   AS service_date,
               o_orderpriority AS service_type, o_totalprice AS cost_aud
        FROM orders
        """,
    ),
    "service_alert_rows": (
        ("services",),
        f"""
        SELECT sha256('service#' || equipment_id || '#SERVICE_DUE#2024-01-31') AS alert_id,
               equipment_id, site_id, {_AS_OF} AS triggered_at, 'SERVICE_DUE' AS alert_type,
               CASE service_status WHEN 'OVERDUE' THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
               'hours_since_service' AS metric, hours_since_service AS value,
               service_interval_hrs AS threshold,
               CASE service_status WHEN 'OVERDUE' THEN 'CRITICAL' ELSE 'WARNING' END || ': '
                   || equipment_id || ' (' || model || ') at ' || site_name || ' — '
                   || round_even(hours_since_service, 0)::BIGINT || 'h since last service (interval: '
                   || round_even(service_interval_hrs, 0)::BIGINT || 'h)' AS message
        FROM services WHERE service_status <> 'OK'
        """,
    ),
    "placed": (
        ("sensor_events", "flagged"),
        """
        SELECT s.*, f.has_anomaly,
               date_trunc('minute', s."timestamp") - to_minutes(b.back) AS window_start
        FROM sensor_events s JOIN flagged f USING (event_id), range(0, 5) AS b(back)
        """,
    ),
    "flagged": (
        ("readings", "raised"),
        """
        SELECT r.event_id,
               array_to_string([coalesce(max(flag) FILTER (WHERE slot = 1), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 2), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 3), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 4), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 5), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 6), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 7), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 8), ''),
                   coalesce(max(flag) FILTER (WHERE slot = 9), '')], ',') AS anomaly_flags,
               count(slot) > 0 AS has_anomaly,
               count(*) FILTER (WHERE flag LIKE 'CRITICAL%' OR flag LIKE 'HIGH%') > 0
                   AS is_critical
        FROM readings r LEFT JOIN raised x ON x.event_id = r.event_id
        GROUP BY r.event_id
        """,
    ),
    # Alerts of flags, devices and the service job in one table.
    "every": (
        ("flag_alerts", "alerts", "service_alert_rows"),
        """
        SELECT alert_id, equipment_id, site_id, triggered_at, severity FROM flag_alerts
        UNION ALL SELECT alert_id, equipment_id, site_id, triggered_at, severity FROM alerts
        UNION ALL SELECT alert_id, equipment_id, site_id, triggered_at, severity
        FROM service_alert_rows
        """,
    ),
    "order_history": ((), "SELECT o_orderkey, o_orderdate AS recorded_at FROM orders"),
    "routed": (
        ("order_history",),
        """
        SELECT *, CASE WHEN year(recorded_at) IN (1996, 1997)
                       THEN strftime(recorded_at, 'sensor_readings_%Y_%m')
                       ELSE 'sensor_readings_default' END AS partition_name
        FROM order_history
        """,
    ),
}


def _with(body: str, *tables: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _TABLES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        visit(name)
    parts = ", ".join(f"{name} AS ({_TABLES[name][1].strip()})" for name in ordered)
    return f"WITH {parts} {body.strip()}" if parts else body.strip()


_MEASURES = """
    round(avg(engine_temp_c), 6) AS avg_engine_temp, round(max(engine_temp_c), 6) AS max_engine_temp,
    round(avg(vibration_mm_s), 6) AS avg_vibration, round(max(vibration_mm_s), 6) AS max_vibration,
    round(avg(fuel_level_pct), 6) AS avg_fuel_level, round(min(fuel_level_pct), 6) AS min_fuel_level,
    round(avg(oil_pressure_kpa), 6) AS avg_oil_pressure, round(avg(engine_rpm), 6) AS avg_rpm,
    round(avg(speed_kmh), 6) AS avg_speed, round(sum(fuel_burn_rate), 6) AS total_fuel_burn,
    count(*) AS reading_count,
    CAST(sum(CASE WHEN has_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count
"""

_EVENT_COLUMNS = """
    event_id, equipment_id, equipment_type, site_id, "timestamp",
    round(engine_temp_c, 6) AS engine_temp_c, round(engine_rpm, 6) AS engine_rpm,
    round(oil_pressure_kpa, 6) AS oil_pressure_kpa, round(vibration_mm_s, 6) AS vibration_mm_s,
    fuel_level_pct, round(fuel_burn_rate, 6) AS fuel_burn_rate,
    round(payload_tonnes, 6) AS payload_tonnes, round(drill_rpm, 6) AS drill_rpm,
    round(dig_force_kn, 6) AS dig_force_kn, round(latitude, 6) AS latitude,
    round(longitude, 6) AS longitude, speed_kmh, status, hours_since_service, fault_code
"""

_LATEST_ROUNDED = """
    SELECT * REPLACE (round(engine_temp_c, 6) AS engine_temp_c, round(engine_rpm, 6) AS engine_rpm,
        round(oil_pressure_kpa, 6) AS oil_pressure_kpa, round(vibration_mm_s, 6) AS vibration_mm_s)
    FROM latest
"""

_ALERT_SELECT = """
    SELECT alert_id, equipment_id, site_id, triggered_at, alert_type, severity, metric,
           round(value, 6) AS value, threshold, message FROM
"""

_PRIORITY = """
    ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'WARNING' THEN 2 END NULLS LAST,
             triggered_at DESC, alert_id
"""

_WINDOWS = f"""
    SELECT equipment_id, site_id, equipment_type, {_MEASURES},
           window_start, window_start + INTERVAL 5 MINUTE AS window_end
    FROM placed GROUP BY equipment_id, site_id, equipment_type, window_start
"""

_INGEST = f"""
    SELECT (SELECT count(*) FROM readings) AS total_readings,
           (SELECT count(*) FROM readings WHERE recorded_at >= {_AS_OF} - INTERVAL 1 HOUR)
               AS readings_last_hour,
           (SELECT count(*) FROM readings WHERE recorded_at >= {_AS_OF} - INTERVAL 5 MINUTE)
               AS readings_last_5min,
           (SELECT count(*) FROM alerts WHERE resolved_at IS NULL) AS open_alerts,
           (SELECT count(*) FROM alerts WHERE resolved_at IS NULL AND severity = 'CRITICAL')
               AS critical_alerts,
           (SELECT count(*) FROM latest WHERE status = 'fault') AS equipment_in_fault,
           (SELECT max(recorded_at) FROM readings) AS last_reading_at
"""


def _decimal(column: str, precision: int, scale: int) -> str:
    """A double in a stored decimal: noise beyond six more digits dropped, then half up."""
    text = f"CAST(round({column}, {scale + 6}) AS VARCHAR)"
    return f"CAST(CAST({text} AS DECIMAL({precision},{scale})) AS DOUBLE) AS {column}"


def _scaled(column: str, precision: int, scale: int) -> str:
    """The same decimal as text with all its places."""
    text = f"CAST(round({column}, {scale + 6}) AS VARCHAR)"
    return f"CAST(CAST({text} AS DECIMAL({precision},{scale})) AS VARCHAR) AS {column}"


def _plan(table: str, cutoff: str) -> str:
    return f"""
        SELECT strftime(month, 'sensor_readings_%Y_%m') AS partition_name, month, "rows",
               month + INTERVAL 1 MONTH <= {cutoff} AS expired
        FROM (SELECT CAST(date_trunc('month', recorded_at) AS DATE) AS month, count(*) AS "rows"
              FROM {table} GROUP BY ALL)
    """


_ORDERS_CUTOFF = "TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 90 DAY"


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    q["json_decode"] = _with(
        f'SELECT {_EVENT_COLUMNS}, "timestamp" AS kafka_timestamp FROM sensor_events',
        "sensor_events",
    )
    q["malformed_split"] = _with(
        """SELECT event_id, CASE status WHEN 'fault' THEN 'malformed' WHEN 'idle' THEN 'missing_field'
                  WHEN 'maintenance' THEN 'malformed' ELSE 'valid' END AS outcome FROM readings""",
        "readings",
    )
    q["topic_routing"] = _with(
        """SELECT equipment_id, count(*) AS "rows", 'sensor-events' AS topic
           FROM readings GROUP BY ALL
           UNION ALL SELECT equipment_id, count(*), 'equipment-alerts' FROM alerts GROUP BY ALL""",
        "readings",
        "alerts",
    )
    q["archive_round_trip"] = _with(
        """SELECT event_id, equipment_id, "timestamp", has_anomaly,
                  CAST(year("timestamp") AS INTEGER) AS year,
                  CAST(month("timestamp") AS INTEGER) AS month,
                  CAST(day("timestamp") AS INTEGER) AS day, site_id
           FROM sensor_events JOIN flagged USING (event_id)
           WHERE "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-13'""",
        "sensor_events",
        "flagged",
    )
    stored = {
        "engine_temp_c": (6, 2),
        "engine_rpm": (8, 1),
        "oil_pressure_kpa": (8, 1),
        "vibration_mm_s": (8, 3),
        "fuel_level_pct": (5, 2),
        "fuel_burn_rate": (8, 2),
        "payload_tonnes": (8, 1),
        "drill_rpm": (8, 1),
        "dig_force_kn": (8, 1),
        "speed_kmh": (6, 1),
        "latitude": (9, 6),
        "longitude": (9, 6),
        "hours_since_service": (10, 2),
    }
    decimals = ", ".join(_decimal(c, p, s) for c, (p, s) in stored.items())
    q["stored_readings"] = _with(
        f"SELECT event_id, equipment_id, recorded_at, {decimals}, status, fault_code FROM readings",
        "readings",
    )
    texts = ", ".join(_scaled(c, p, s) for c, (p, s) in stored.items())
    q["stored_readings_scaled"] = _with(
        f"SELECT event_id, equipment_id, recorded_at, {texts}, status, fault_code FROM readings",
        "readings",
    )
    q["stored_alerts_scaled"] = _with(
        f"""SELECT alert_id, equipment_id, site_id, triggered_at, alert_type, severity, metric,
                   {_scaled("value", 12, 3)}, {_scaled("threshold", 12, 3)}, message,
                   FALSE AS acknowledged FROM flag_alerts""",
        "flag_alerts",
    )
    q["kpi_upsert"] = _with("SELECT * FROM kpi_rows", "kpi_rows")
    kpi_types = {
        "avg_engine_temp_c": (6, 2),
        "max_engine_temp_c": (6, 2),
        "avg_vibration_mm_s": (8, 3),
        "max_vibration_mm_s": (8, 3),
        "total_fuel_litres": (10, 2),
        "operating_hours": (6, 2),
        "idle_hours": (6, 2),
        "fault_hours": (6, 2),
        "uptime_pct": (5, 2),
        "total_payload_tonnes": (12, 2),
        "avg_drill_rpm": (8, 1),
    }
    decimals = ", ".join(_decimal(c, p, s) for c, (p, s) in kpi_types.items())
    q["stored_kpi"] = _with(
        f"""SELECT equipment_id, site_id, kpi_date, {decimals},
                   CAST(alert_count AS INTEGER) AS alert_count,
                   CAST(critical_alert_count AS INTEGER) AS critical_alert_count FROM kpis""",
        "kpis",
    )
    texts = ", ".join(_scaled(c, p, s) for c, (p, s) in kpi_types.items())
    q["stored_kpi_scaled"] = _with(
        f"""SELECT equipment_id, site_id, kpi_date, {texts},
                   CAST(alert_count AS INTEGER) AS alert_count,
                   CAST(critical_alert_count AS INTEGER) AS critical_alert_count FROM kpis""",
        "kpis",
    )
    q["insert_if_absent"] = _with(
        "SELECT event_id, equipment_id, recorded_at FROM readings", "readings"
    )
    q["kpi_snapshot_upsert"] = _with(
        """SELECT equipment_id, kpi_date,
                  alert_count + CASE WHEN kpi_date = DATE '2024-01-10' THEN 1 ELSE 0 END
                      AS alert_count
           FROM kpis""",
        "kpis",
    )

    q["reading_projection"] = _with(
        """SELECT recorded_at, equipment_id, round(engine_temp_c, 6) AS engine_temp_c,
                  round(oil_pressure_kpa, 6) AS oil_pressure_kpa, fuel_level_pct, status
           FROM readings""",
        "readings",
    )
    q["day_readings"] = _with(
        """SELECT event_id, equipment_id, recorded_at, round(engine_temp_c, 6) AS engine_temp_c
           FROM readings WHERE CAST(recorded_at AS DATE) = DATE '2024-01-10'""",
        "readings",
    )
    q["recent_readings"] = _with(
        f"""SELECT event_id, equipment_id, recorded_at, status FROM readings
            WHERE recorded_at >= {_AS_OF} - INTERVAL 48 HOUR""",
        "readings",
    )
    q["active_equipment"] = _with("SELECT * FROM equipment WHERE active", "equipment")
    q["archive_dates"] = _with(
        """SELECT CAST(year(recorded_at) AS INTEGER) AS year,
                  CAST(month(recorded_at) AS INTEGER) AS month,
                  CAST(day(recorded_at) AS INTEGER) AS day, count(*) AS "rows"
           FROM readings GROUP BY ALL""",
        "readings",
    )

    q["alert_counts_by_day"] = _with(
        """SELECT equipment_id, CAST(triggered_at AS DATE) AS kpi_date, count(*) AS alert_count,
                  count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alert_count
           FROM alerts GROUP BY ALL""",
        "alerts",
    )
    q["reading_totals"] = _with(
        f"""SELECT count(*) AS total_readings,
                   count(*) FILTER (WHERE recorded_at >= {_AS_OF} - INTERVAL 1 HOUR)
                       AS readings_last_hour,
                   count(*) FILTER (WHERE recorded_at >= {_AS_OF} - INTERVAL 5 MINUTE)
                       AS readings_last_5min,
                   max(recorded_at) AS last_reading_at FROM readings""",
        "readings",
    )
    q["kpi_summary"] = _with(
        """SELECT count(*) AS kpi_rows, round(avg(uptime_pct), 6) AS avg_uptime,
                  round(avg(alert_count), 6) AS avg_alerts FROM kpis""",
        "kpis",
    )
    q["fuel_integrated"] = _with(
        """SELECT equipment_id, CAST(recorded_at AS DATE) AS kpi_date,
                  round(sum(fuel_burn_rate) / 360, 6) AS fuel_litres_integrated
           FROM readings GROUP BY ALL""",
        "readings",
    )

    q["equipment_latest"] = _with(_LATEST_ROUNDED, "latest")
    q["equipment_latest_filtered"] = _with(
        _LATEST_ROUNDED + " WHERE site_id = '3' AND status = 'operating'", "latest"
    )
    q["latest_service_hours"] = _with(
        "SELECT equipment_id, hours_since_service FROM newest", "newest"
    )
    q["equipment_history"] = _with(
        f"""SELECT recorded_at, round(engine_temp_c, 6) AS engine_temp_c,
                   round(vibration_mm_s, 6) AS vibration_mm_s, fuel_level_pct,
                   round(oil_pressure_kpa, 6) AS oil_pressure_kpa,
                   round(engine_rpm, 6) AS engine_rpm, status
            FROM readings
            WHERE equipment_id = '7' AND recorded_at >= {_AS_OF} - INTERVAL 168 HOUR""",
        "readings",
    )
    q["status_feed"] = _with(
        """SELECT equipment_id, site_id, status, recorded_at AS "timestamp"
           FROM (SELECT *, row_number() OVER (
                     PARTITION BY equipment_id ORDER BY recorded_at, event_id) AS ordinal
                 FROM readings) JOIN equipment USING (equipment_id)
           WHERE ordinal % 10 = 0""",
        "readings",
        "equipment",
    )

    q["anomaly_enrichment"] = _with("SELECT * FROM flagged", "flagged")
    q["site_lookup"] = _with(
        """SELECT event_id, e.site_id, site_name, state
           FROM sensor_events e LEFT JOIN sites s ON s.site_id = e.site_id""",
        "sensor_events",
        "sites",
    )
    q["flag_alerts"] = _with(_ALERT_SELECT + "flag_alerts", "flag_alerts")
    q["limit_alerts"] = _with(_ALERT_SELECT + "alerts", "alerts")
    q["alert_union"] = _with(
        f"""{_ALERT_SELECT} flag_alerts UNION ALL {_ALERT_SELECT} alerts
            UNION ALL {_ALERT_SELECT} service_alert_rows""",
        "flag_alerts",
        "alerts",
        "service_alert_rows",
    )
    q["open_alerts"] = _with("SELECT * FROM open_rows", "open_rows")
    q["open_alerts_top"] = _with(f"SELECT * FROM open_rows {_PRIORITY} LIMIT 100", "open_rows")
    q["open_alerts_filtered"] = _with(
        f"SELECT * FROM open_rows WHERE severity = 'WARNING' AND site_id = '3' {_PRIORITY} LIMIT 100",
        "open_rows",
    )
    q["alert_stats"] = _with(
        f"""SELECT site_id, severity, count(*) AS count,
                   CAST(CASE severity WHEN 'WARNING' THEN 1 ELSE 2 END AS BIGINT) AS severity_rank
            FROM alerts WHERE triggered_at >= {_AS_OF} - INTERVAL 72 HOUR
            GROUP BY site_id, severity""",
        "alerts",
    )
    q["resolve_alerts"] = _with(
        f"""SELECT alert_id, severity,
                   CASE WHEN severity = 'CRITICAL' THEN coalesce(resolved_at, {_AS_OF})
                        ELSE resolved_at END AS resolved_at FROM alerts""",
        "alerts",
    )

    q["daily_kpi"] = _with(
        "SELECT * FROM kpi_rows WHERE kpi_date = DATE '2024-01-10'", "kpi_rows"
    )
    q["kpi_history"] = _with(
        "SELECT * FROM kpi_rows WHERE kpi_date >= DATE '2024-01-24'", "kpi_rows"
    )
    q["kpi_history_filtered"] = _with(
        "SELECT * FROM kpi_rows WHERE kpi_date >= DATE '2024-01-01' AND equipment_id = '7'",
        "kpi_rows",
    )
    q["kpi_history_response"] = _with(
        """SELECT equipment_id, site_id, kpi_date, avg_engine_temp_c, max_engine_temp_c,
                  avg_vibration_mm_s, total_fuel_litres, operating_hours, uptime_pct, alert_count,
                  critical_alert_count
           FROM kpi_rows WHERE kpi_date >= DATE '2024-01-28'""",
        "kpi_rows",
    )
    q["kpi_history_site"] = _with(
        "SELECT * FROM kpi_rows WHERE kpi_date >= DATE '2024-01-17' AND site_id = '3'", "kpi_rows"
    )

    q["sliding_stats"] = _with(_WINDOWS, "placed")
    q["sliding_stats_single_pass"] = q["sliding_stats"]
    q["tumbling_stats"] = _with(
        f"""SELECT equipment_id, site_id, equipment_type, {_MEASURES},
                   time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start,
                   time_bucket(INTERVAL 5 MINUTE, "timestamp") + INTERVAL 5 MINUTE AS window_end
            FROM sensor_events JOIN flagged USING (event_id)
            GROUP BY equipment_id, site_id, equipment_type,
                     time_bucket(INTERVAL 5 MINUTE, "timestamp")""",
        "sensor_events",
        "flagged",
    )

    q["fleet_health"] = _with("SELECT * EXCLUDE (idle) FROM health", "health")
    q["fleet_health_with_idle"] = _with("SELECT * FROM health", "health")
    q["ingest_stats"] = _with(_INGEST, "alerts", "latest")
    q["ingest_health"] = _with(
        f"""SELECT (SELECT count(*) FROM readings) AS total_readings,
                   (SELECT count(*) FROM alerts WHERE resolved_at IS NULL) AS open_alerts,
                   (SELECT count(*) FROM alerts WHERE triggered_at >= {_AS_OF} - INTERVAL 1 HOUR)
                       AS alerts_last_hour,
                   recent_rows, recent_rows >= 10 AS healthy
            FROM (SELECT count(*) AS recent_rows FROM readings
                  WHERE recorded_at >= {_AS_OF} - INTERVAL 5 MINUTE)""",
        "alerts",
    )
    q["ingest_recency"] = _with(
        """SELECT recent_rows, recent_rows >= 10 AS healthy
           FROM (SELECT count(*) AS recent_rows FROM readings
                 WHERE recorded_at >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 5 MINUTE)""",
        "readings",
    )
    q["dashboard_stats"] = _with(
        f"""SELECT readings_last_hour, critical_alerts,
                   CASE WHEN critical_alerts >= 5 THEN 'red' WHEN critical_alerts >= 1
                        THEN 'orange' ELSE 'green' END AS critical_alerts_colour,
                   equipment_in_fault
            FROM ({_INGEST})""",
        "alerts",
        "latest",
    )
    q["temperature_series"] = _with(
        """SELECT recorded_at AS time, equipment_id, round(engine_temp_c, 6) AS value,
                  CASE WHEN engine_temp_c >= 105 THEN 'red' WHEN engine_temp_c >= 100
                       THEN 'orange' ELSE 'green' END AS colour
           FROM readings WHERE recorded_at BETWEEN TIMESTAMP '2024-01-20 00:00:00'
                                               AND TIMESTAMP '2024-01-22 12:00:00'""",
        "readings",
    )
    q["alert_panel"] = _with(
        f"""SELECT equipment_id, site_name, alert_type, severity, metric, value, message,
                   triggered_at FROM open_rows {_PRIORITY} LIMIT 50""",
        "open_rows",
    )
    q["fleet_panel"] = _with(
        """SELECT site_name, equipment_type, total_machines, operating, in_fault, in_maintenance,
                  avg_fuel_pct, avg_engine_temp FROM health""",
        "health",
    )

    q["service_status_list"] = _with("SELECT * FROM services", "services")
    q["service_counts"] = _with(
        """SELECT count(*) AS total_equipment,
                  count(*) FILTER (WHERE service_status IN ('DUE_SOON', 'OVERDUE')) AS due_count,
                  count(*) FILTER (WHERE service_status = 'OVERDUE') AS overdue_count
           FROM services""",
        "services",
    )
    q["service_alerts"] = _with("SELECT * FROM service_alert_rows", "service_alert_rows")
    q["service_logs"] = _with(
        """SELECT sha256('log#' || equipment_id || '#2024-01-31') AS log_id, equipment_id,
                  DATE '2024-01-31' AS service_date, 'preventive' AS service_type,
                  hours_since_service AS hours_at_service,
                  hours_since_service + service_interval_hrs AS next_service_due,
                  'Auto-generated by Airflow maintenance_scheduler DAG' AS notes
           FROM services s WHERE service_status = 'OVERDUE' AND NOT EXISTS (
               SELECT 1 FROM logs l WHERE l.equipment_id = s.equipment_id
               AND l.service_date = DATE '2024-01-31')""",
        "services",
        "logs",
    )
    q["service_report"] = _with(
        """SELECT equipment_id, service_status, hours_since_service,
                  '[' || service_status || '] ' || equipment_id || ' — '
                      || round_even(hours_since_service, 0)::BIGINT || 'h / '
                      || round_even(service_interval_hrs, 0)::BIGINT || 'h — ' || site_name AS line
           FROM services WHERE service_status <> 'OK'""",
        "services",
    )
    q["parts_replaced"] = _with(
        """SELECT log_id, equipment_id, service_date, parts_replaced
           FROM logs LEFT JOIN (
               SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_partkey::VARCHAR)), ',')
                          AS parts_replaced
               FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
        "logs",
    )

    q["source_gate"] = _with(
        """SELECT row_count, equipment_count, row_count >= 100 AS passed
           FROM (SELECT count(*) AS row_count, count(DISTINCT equipment_id) AS equipment_count
                 FROM readings WHERE CAST(recorded_at AS DATE) = DATE '2024-01-10')""",
        "readings",
    )
    q["output_gate"] = _with(
        """SELECT count(*) AS kpi_rows, round(coalesce(avg(uptime_pct), 0), 6) AS avg_uptime,
                  round(coalesce(avg(alert_count), 0), 6) AS avg_alerts, count(*) > 0 AS passed
           FROM kpis WHERE kpi_date = DATE '2024-01-10'""",
        "kpis",
    )
    q["duplicate_keys"] = _with(
        """SELECT equipment_id, service_date, count(*) AS occurrences
           FROM logs GROUP BY ALL HAVING count(*) > 1""",
        "logs",
    )
    q["orphan_logs"] = _with(
        """SELECT equipment_id, count(*) AS "rows" FROM logs
           WHERE equipment_id NOT IN (SELECT equipment_id FROM equipment WHERE active)
           GROUP BY ALL""",
        "logs",
        "equipment",
    )
    checks = {
        "readings": {
            "not_null:equipment_id": "equipment_id IS NULL",
            "not_null:recorded_at": "recorded_at IS NULL",
            "max_length:equipment_id": "length(equipment_id) > 20",
            "max_length:fault_code": "length(fault_code) > 20",
            "domain:status": "status NOT IN ('operating', 'idle', 'maintenance', 'fault')",
        },
        "sites": {
            "not_null:site_id": "site_id IS NULL",
            "not_null:site_name": "site_name IS NULL",
            "not_null:state": "state IS NULL",
            **{f"not_null:{c}": "TRUE" for c in ("latitude", "longitude", "timezone", "active", "created_at")},
            "max_length:timezone": "FALSE",
            "max_length:site_id": "length(site_id) > 30",
            "max_length:site_name": "length(site_name) > 100",
            "max_length:state": "length(state) > 3",
        },
        "logs": {
            "not_null:equipment_id": "equipment_id IS NULL",
            "not_null:service_date": "service_date IS NULL",
            "not_null:service_type": "service_type IS NULL",
            "not_null:created_at": "TRUE",
            "max_length:equipment_id": "length(equipment_id) > 20",
            "max_length:technician": "FALSE",
            "domain:service_type": (
                "service_type NOT IN ('routine', 'corrective', 'preventive', 'emergency')"
            ),
        },
    }
    checked = {"readings": "sensor_readings", "sites": "sites", "logs": "maintenance_logs"}
    q["column_checks"] = _with(
        " UNION ALL ".join(
            f"""SELECT '{rule}' AS rule, count(*) FILTER (WHERE {bad}) AS violations,
                       '{checked[table]}' AS checked FROM {table}"""
            for table, rules in checks.items()
            for rule, bad in rules.items()
        ),
        "readings",
        "sites",
        "logs",
    )
    derived = {
        "equipment": (
            ("equipment_id", "site_id", "equipment_type", "service_interval_hrs", "active"),
            {
                "not_null:created_at": "TRUE",
                "not_null:updated_at": "TRUE",
                "max_length:equipment_id": "length(equipment_id) > 20",
                "max_length:site_id": "length(site_id) > 30",
                "max_length:model": "length(model) > 100",
                "max_length:manufacturer": "FALSE",
                "max_length:serial_number": "FALSE",
                "domain:equipment_type": (
                    "equipment_type NOT IN ('haul_truck', 'drill_rig', 'excavator')"
                ),
            },
        ),
        "alerts": (
            ("alert_id", "equipment_id", "site_id", "triggered_at", "alert_type", "severity",
             "metric", "value", "threshold", "message"),
            {
                "not_null:acknowledged": "FALSE",
                "max_length:equipment_id": "length(equipment_id) > 20",
                "max_length:site_id": "length(site_id) > 30",
                "max_length:alert_type": "length(alert_type) > 50",
                "max_length:metric": "length(metric) > 50",
                "max_length:acknowledged_by": "FALSE",
                "domain:severity": "severity NOT IN ('WARNING', 'CRITICAL')",
            },
        ),
        "kpis": (
            ("equipment_id", "site_id", "kpi_date"),
            {
                "max_length:equipment_id": "length(equipment_id) > 20",
                "max_length:site_id": "length(site_id) > 30",
            },
        ),
    }
    q["column_checks_derived"] = _with(
        " UNION ALL ".join(
            f"""SELECT '{rule}' AS rule, count(*) FILTER (WHERE {bad}) AS violations,
                       '{"daily_kpi" if table == "kpis" else table}' AS checked FROM {table}"""
            for table, (filled, rules) in derived.items()
            for rule, bad in ({f"not_null:{c}": f"{c} IS NULL" for c in filled} | rules).items()
        ),
        "equipment",
        "alerts",
        "kpis",
    )

    q["month_routing"] = _with(
        'SELECT partition_name, count(*) AS "rows" FROM routed GROUP BY ALL', "routed"
    )
    q["expired_partitions"] = _with(
        f"""SELECT DISTINCT partition_name, CAST(date_trunc('month', recorded_at) AS DATE) AS month
            FROM routed WHERE partition_name NOT LIKE '%default%'
            AND date_trunc('month', recorded_at) < {_ORDERS_CUTOFF}""",
        "routed",
    )
    q["retention_plan"] = _with(
        _plan("readings", "TIMESTAMP '2024-06-30 00:00:00' - INTERVAL 90 DAY"), "readings"
    )
    q["retention_plan_long_history"] = _with(
        _plan("order_history", _ORDERS_CUTOFF), "order_history"
    )
    q["retention_apply"] = q["retention_rerun"] = _with(
        f"""SELECT o_orderkey, recorded_at,
                   strftime(recorded_at, 'sensor_readings_%Y_%m') AS partition_name,
                   CASE WHEN date_trunc('month', recorded_at) + INTERVAL 1 MONTH > {_ORDERS_CUTOFF}
                        THEN 'kept' ELSE 'archived' END AS side
            FROM order_history""",
        "order_history",
    )

    q["stream_sliding_stats"] = q["sliding_stats"]
    q["stream_live_alerts"] = _with(
        """SELECT alert_id, equipment_id, site_id, triggered_at, alert_type, severity, metric,
                  CAST(CAST(CAST(round(value, 9) AS VARCHAR) AS DECIMAL(12,3)) AS DOUBLE) AS value,
                  threshold, message FROM flag_alerts""",
        "flag_alerts",
    )
    q["stream_latest"] = _with(
        "SELECT equipment_id, event_id, recorded_at, status FROM newest", "newest"
    )
    q["fleet_status_standing"] = _with(
        """SELECT site_id, site_name, equipment_type, total_machines, operating, in_fault,
                  in_maintenance, idle FROM health""",
        "health",
    )
    q["latest_standing"] = _with(
        "SELECT equipment_id, equipment_type, site_id, recorded_at, status FROM latest", "latest"
    )
    q["stream_dedupe"] = _with(
        'SELECT event_id, equipment_id, "timestamp" FROM sensor_events', "sensor_events"
    )
    q["stream_live_deduped"] = _with(
        """SELECT 'readings' AS output, event_id AS id, equipment_id FROM sensor_events
           UNION ALL SELECT 'archive', event_id, equipment_id FROM sensor_events
           UNION ALL SELECT 'alerts', alert_id, equipment_id FROM flag_alerts""",
        "sensor_events",
        "flag_alerts",
    )
    q["alerts_all_producers"] = _with(
        """SELECT 'open' AS part, equipment_id, alert_id AS item, severity, CAST(1 AS BIGINT) AS alerts
           FROM every JOIN sites USING (site_id)
           UNION ALL
           SELECT 'kpi', k.equipment_id, '2024-01-10', CAST(count(*) FILTER (
                      WHERE e.severity = 'CRITICAL') AS VARCHAR), count(e.alert_id)
           FROM kpis k LEFT JOIN every e
               ON e.equipment_id = k.equipment_id AND CAST(e.triggered_at AS DATE) = k.kpi_date
           WHERE k.kpi_date = DATE '2024-01-10' GROUP BY k.equipment_id""",
        "every",
        "sites",
        "kpis",
    )
    q["resolve_written"] = _with(
        """SELECT alert_id, severity, triggered_at,
                  CASE WHEN severity = 'CRITICAL' AND day(triggered_at) <= 3
                       THEN TIMESTAMP '2024-01-30 00:00:00' END AS resolved_at
           FROM flag_alerts""",
        "flag_alerts",
    )
    q["ingest_stats_standing"] = _with(
        f"""SELECT (SELECT count(*) FROM readings) AS total_readings,
                   (SELECT count(*) FROM readings WHERE recorded_at >= {_AS_OF} - INTERVAL 1 HOUR)
                       AS readings_last_hour,
                   (SELECT count(*) FROM readings WHERE recorded_at >= {_AS_OF} - INTERVAL 5 MINUTE)
                       AS readings_last_5min,
                   (SELECT count(*) FROM flag_alerts WHERE day(triggered_at) > 3) AS open_alerts,
                   (SELECT count(*) FROM flag_alerts WHERE day(triggered_at) > 3
                        AND severity = 'CRITICAL') AS critical_alerts,
                   (SELECT count(*) FROM latest WHERE status = 'fault') AS equipment_in_fault,
                   (SELECT max(recorded_at) FROM readings) AS last_reading_at""",
        "flag_alerts",
        "latest",
    )
    q["stream_corrected_stats"] = q["sliding_stats"]
    q["stream_late_rows"] = _with(
        """SELECT event_id, equipment_id, "timestamp", has_anomaly
           FROM (SELECT *, least(third + CAST(event_id::BIGINT % 7 = 0 AS INTEGER), 2) AS file
                 FROM (SELECT s.*, f.has_anomaly,
                              CAST(least(floor((day("timestamp") - 1) / 10), 2) AS INTEGER) AS third
                       FROM sensor_events s JOIN flagged f USING (event_id))) e
           WHERE "timestamp" < (
               SELECT max("timestamp") FROM sensor_events x
               WHERE least(CAST(least(floor((day(x."timestamp") - 1) / 10), 2) AS INTEGER)
                           + CAST(x.event_id::BIGINT % 7 = 0 AS INTEGER), 2) < e.file
           ) - INTERVAL 10 MINUTE""",
        "sensor_events",
        "flagged",
    )
    q["stream_progress"] = _with(
        """SELECT name AS query, n AS input_rows, CASE name WHEN 'live' THEN n END AS accepted,
                  CASE name WHEN 'live' THEN CAST(0 AS BIGINT) END AS refused
           FROM (SELECT count(*) AS n FROM sensor_events),
                (VALUES ('live'), ('latest'), ('archive'), ('windows')) AS t(name)""",
        "sensor_events",
    )
    q["compacted_round_trip"] = _with(
        """SELECT 'readings' AS output, event_id AS id, equipment_id FROM sensor_events
           UNION ALL SELECT 'alerts', alert_id, equipment_id FROM flag_alerts""",
        "sensor_events",
        "flag_alerts",
    )
    q["stream_site_lookup"] = q["site_lookup"]
    q["stream_all_tables"] = _with(
        """SELECT equipment_id, count(*) AS "rows", 'readings' AS output
           FROM sensor_events GROUP BY ALL
           UNION ALL SELECT equipment_id, count(*), 'alerts' FROM flag_alerts GROUP BY ALL
           UNION ALL SELECT equipment_id, count(*), 'archive' FROM sensor_events GROUP BY ALL
           UNION ALL SELECT equipment_id, count(DISTINCT window_start), 'windows'
           FROM placed GROUP BY ALL""",
        "sensor_events",
        "flag_alerts",
        "placed",
    )
    return q
