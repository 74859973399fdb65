"""DuckDB oracle: the same adapter mapping and models, written as plain SQL.

DuckDB turns decimal division and AVG(decimal) into DOUBLE, so every rounded rate is
computed with integer half-up division instead (``hu``), which is what exact decimal
arithmetic gives in Spark. Each query is the needed CTE chain plus a final SELECT; the
chain is resolved from the CTE names the final SELECT mentions.
"""

from __future__ import annotations

import re

# --- Fixed values (same lists as the Spark adapter) -----------------------------------
MACHINE_TYPES = "['CNC_MILL', 'LATHE', 'WELDING_ROBOT', 'ASSEMBLY_BOT', 'INJECTION_MOLD', 'QUALITY_SCANNER']"
PRODUCTION_LINES = "['LINE_A', 'LINE_B', 'LINE_C']"
SHIFT_LABELS = "['MORNING', 'AFTERNOON', 'NIGHT']"
DEFECT_TYPES = "['DIMENSIONAL_ERROR', 'SURFACE_SCRATCH', 'WELD_DEFECT', 'ASSEMBLY_GAP', 'MATERIAL_FLAW']"
REASON_CODES = "['UNPLANNED_BREAKDOWN', 'MATERIAL_JAM', 'TOOLING_FAILURE', 'POWER_FLUCTUATION', 'OPERATOR_ERROR']"
CONFIDENCE_LEVELS = "['HIGH', 'MEDIUM', 'LOW']"
# ---------------------------------------------------------------------------------------


def hu(num: str, den: str, s: int) -> str:
    """round_half_up(num * 10^s / den) as an integer, den > 0, any sign of num."""
    f = 10 ** s
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN {n} >= 0 THEN (2 * {n} * {f} + {d}) // (2 * {d}) "
            f"ELSE -((2 * (-{n}) * {f} + {d}) // (2 * {d})) END)")


def units(int_expr: str, s: int, p: int) -> str:
    """An integer count of 10^-s units as DECIMAL(p, s)."""
    if s == 0:
        return f"CAST({int_expr} AS DECIMAL({p},0))"
    return f"CAST(CAST({int_expr} AS DECIMAL(18,0)) * 0.{'0' * (s - 1)}1 AS DECIMAL({p},{s}))"


def as_int(dec_expr: str, s: int) -> str:
    """Exact integer value of a decimal at scale s."""
    return f"CAST(({dec_expr}) * {10 ** s} AS HUGEINT)"


def avg_dec(col: str, s: int, out_p: int, out_s: int) -> str:
    """Spark's AVG(decimal(p,s)) -> decimal(p+4, s+4) half-up, then cast to (out_p, out_s)."""
    return (f"CASE WHEN count({col}) = 0 THEN NULL ELSE CAST("
            f"{units(hu(as_int(f'sum({col})', s), f'count({col})', 4), s + 4, 38)} AS DECIMAL({out_p},{out_s})) END")


HOURS_US = 3_600_000_000

CTES: dict[str, str] = {}
RECURSIVE: set[str] = set()


def cte(name: str, body: str) -> None:
    CTES[name] = body


# --- adapter ---------------------------------------------------------------------------
cte("n_m", "SELECT count(*) AS n FROM supplier")
cte("n_v", "SELECT count(*) AS n FROM embeddings")
cte("stg_machines", f"""
SELECT CAST(s_suppkey AS INTEGER) AS machine_id, trim(s_name) AS machine_name,
       upper(trim({MACHINE_TYPES}[s_nationkey % 6 + 1])) AS machine_type,
       upper(trim({PRODUCTION_LINES}[s_nationkey % 3 + 1])) AS production_line,
       CAST(100 + (s_suppkey % 5) * 50 AS INTEGER) AS theoretical_rate_per_hr,
       DATE '2020-01-01' AS install_date
FROM supplier""")
cte("orders_raw", """
SELECT o_orderkey AS order_id, CAST(o_custkey % (SELECT n FROM n_m) AS INTEGER) AS machine_id,
       CAST(o_orderkey % 3 AS INTEGER) AS shift,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o_orderkey % 30 AS INTEGER))
         + to_hours(CAST(6 + 8 * (o_orderkey % 3) AS INTEGER)) AS shift_start
FROM orders""")
cte("stg_orders", f"""
SELECT order_id, machine_id,
       'SKU-' || lpad(CAST(machine_id * 100 + order_id % 5 + 1 AS VARCHAR), 4, '0') AS product_sku,
       {SHIFT_LABELS}[shift + 1] AS shift_label,
       shift_start, shift_start + INTERVAL 4 HOUR AS shift_end,
       CAST(shift_start AS DATE) AS shift_date,
       {units(hu(f"epoch_us(shift_start + INTERVAL 4 HOUR) - epoch_us(shift_start)", HOURS_US, 2), 2, 5)}
         AS shift_duration_hrs,
       CAST((100 + (machine_id % 5) * 50) * 4 AS INTEGER) AS planned_qty,
       CAST(((4 * (100 + (machine_id % 5) * 50)) * (70 + order_id % 29)) // 100 AS INTEGER) AS actual_qty
FROM orders_raw""")
cte("stg_defects", f"""
SELECT l_orderkey * 10 + l_linenumber AS defect_id, l_orderkey AS order_id,
       {DEFECT_TYPES}[l_partkey % 5 + 1] AS defect_type,
       CAST(trunc(l_quantity) AS INTEGER) AS qty_defective
FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'""")
cte("ev", """
SELECT event_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(user_id % (SELECT n FROM n_m) AS INTEGER) AS machine_id
FROM events""")
cte("stg_sensor", """
SELECT machine_id, ts,
       date_trunc('hour', ts) AS ts_hour, CAST(ts AS DATE) AS reading_date,
       CAST(20 + CAST(value AS DECIMAL(10,2)) * 0.1 AS DECIMAL(5,2)) AS temperature_c,
       CAST(k * 0.1 AS DECIMAL(6,3)) AS vibration_mm_s,
       CAST(CAST(value AS DECIMAL(10,2)) AS DECIMAL(7,3)) AS power_kw
FROM ev WHERE event_type <> 'error'""")
cte("dt_raw", f"""
SELECT event_id, machine_id, ts AS started_at,
       ts + to_microseconds(CAST(floor(value * 600) AS BIGINT) * 1000000) AS ended_at,
       {REASON_CODES}[k % 5 + 1] AS reason_code
FROM ev WHERE event_type = 'error'""")
cte("stg_downtime", f"""
SELECT event_id, machine_id, started_at, ended_at, CAST(started_at AS DATE) AS event_date,
       {units(hu("epoch_us(ended_at) - epoch_us(started_at)", HOURS_US, 4), 4, 8)} AS duration_hrs,
       upper(trim(reason_code)) AS reason_code
FROM dt_raw""")
cte("recs_raw", f"""
SELECT event_id AS rec_id, machine_id, 'Machine ' || CAST(machine_id AS VARCHAR) AS machine_name,
       ts AS generated_at,
       CAST(CAST(value AS DECIMAL(10,2)) * 0.01 AS DECIMAL(6,3)) AS anomaly_score,
       'Pattern ' || CAST(k AS VARCHAR) AS root_cause,
       'Inspect component ' || CAST(k % 7 AS VARCHAR) AS recommended_action,
       CASE WHEN k = 0 THEN NULL ELSE CAST(CAST(value AS DECIMAL(10,2)) AS DECIMAL(6,1)) END
         AS estimated_hours_to_failure,
       {CONFIDENCE_LEVELS}[k % 3 + 1] AS confidence,
       '[' || CAST(k AS VARCHAR) || ']' AS similar_pattern_ids
FROM ev WHERE event_type = 'signup'""")

# --- OEE ----------------------------------------------------------------------------------
cte("od", """
SELECT machine_id, shift_date, sum(shift_duration_hrs) AS planned_time_hrs,
       CAST(sum(actual_qty) AS BIGINT) AS total_actual_qty, CAST(sum(planned_qty) AS BIGINT) AS total_planned_qty
FROM stg_orders GROUP BY machine_id, shift_date""")
cte("ddt", """
SELECT machine_id, event_date AS shift_date, sum(duration_hrs) AS downtime_hrs
FROM stg_downtime GROUP BY machine_id, event_date""")
cte("ddf", """
SELECT o.machine_id, o.shift_date, CAST(sum(d.qty_defective) AS BIGINT) AS total_defects
FROM stg_defects d JOIN stg_orders o ON d.order_id = o.order_id GROUP BY o.machine_id, o.shift_date""")
_AV_NUM = as_int("planned_time_hrs - downtime_hrs", 4)
_AV_DEN = as_int("planned_time_hrs", 4)
cte("int_availability", f"""
SELECT machine_id, shift_date, planned_time_hrs, downtime_hrs,
       greatest(0, planned_time_hrs - downtime_hrs) AS available_time_hrs,
       CASE WHEN planned_time_hrs = 0 THEN NULL
            WHEN {_AV_NUM} <= 0 THEN CAST(0 AS DECIMAL(5,4))
            ELSE {units(hu(_AV_NUM, _AV_DEN, 4), 4, 5)} END AS availability_rate
FROM (SELECT od.machine_id, od.shift_date, od.planned_time_hrs, coalesce(ddt.downtime_hrs, 0) AS downtime_hrs
      FROM od LEFT JOIN ddt ON od.machine_id = ddt.machine_id AND od.shift_date = ddt.shift_date)""")
_PF_DEN = f"theoretical_rate_per_hr * {as_int('available_time_hrs', 4)}"
cte("int_performance", f"""
SELECT machine_id, shift_date, total_actual_qty, total_planned_qty, theoretical_rate_per_hr, available_time_hrs,
       CAST(theoretical_rate_per_hr * available_time_hrs AS DECIMAL(10,2)) AS theoretical_output,
       CASE WHEN {_PF_DEN} = 0 THEN NULL
            ELSE {units(f"least(10000, {hu('total_actual_qty * 10000', _PF_DEN, 4)})", 4, 5)} END AS performance_rate
FROM (SELECT od.machine_id, od.shift_date, od.total_actual_qty, od.total_planned_qty, m.theoretical_rate_per_hr,
             a.available_time_hrs
      FROM od JOIN stg_machines m ON od.machine_id = m.machine_id
      JOIN int_availability a ON od.machine_id = a.machine_id AND od.shift_date = a.shift_date)""")
cte("int_quality", f"""
SELECT machine_id, shift_date, total_units, total_defects, total_units - total_defects AS good_units,
       CASE WHEN total_units = 0 THEN NULL
            ELSE {units(hu('total_units - total_defects', 'total_units', 4), 4, 5)} END AS quality_rate
FROM (SELECT od.machine_id, od.shift_date, od.total_actual_qty AS total_units,
             CAST(coalesce(ddf.total_defects, 0) AS BIGINT) AS total_defects
      FROM od LEFT JOIN ddf ON od.machine_id = ddf.machine_id AND od.shift_date = ddf.shift_date)""")
cte("oee_daily", """
SELECT m.machine_id, m.machine_name, m.production_line, m.machine_type, m.theoretical_rate_per_hr,
       a.shift_date, a.planned_time_hrs, a.downtime_hrs, a.available_time_hrs, a.availability_rate,
       p.total_actual_qty, p.theoretical_output, p.performance_rate,
       q.total_units, q.good_units, q.total_defects, q.quality_rate,
       CAST(a.availability_rate * p.performance_rate * q.quality_rate AS DECIMAL(5,4)) AS oee
FROM stg_machines m
JOIN int_availability a ON m.machine_id = a.machine_id
JOIN int_performance p ON m.machine_id = p.machine_id AND a.shift_date = p.shift_date
JOIN int_quality q ON m.machine_id = q.machine_id AND a.shift_date = q.shift_date""")

# --- health -----------------------------------------------------------------------------
cte("machine_health", f"""
SELECT machine_id, reading_date, count(*) AS reading_count,
       {avg_dec('temperature_c', 2, 6, 2)} AS avg_temp_c,
       CAST(max(temperature_c) AS DECIMAL(6,2)) AS max_temp_c,
       {avg_dec('vibration_mm_s', 3, 7, 3)} AS avg_vibration_mm_s,
       CAST(max(vibration_mm_s) AS DECIMAL(7,3)) AS max_vibration_mm_s,
       {avg_dec('power_kw', 3, 8, 3)} AS avg_power_kw,
       CAST(max(power_kw) AS DECIMAL(8,3)) AS max_power_kw,
       CASE WHEN max(temperature_c) * count(temperature_c) > CAST(sum(temperature_c) AS DECIMAL(18,2)) * 1.15 THEN TRUE
            WHEN max(vibration_mm_s) * count(vibration_mm_s) > CAST(sum(vibration_mm_s) AS DECIMAL(18,3)) * 1.50 THEN TRUE
            ELSE FALSE END AS anomaly_flag
FROM stg_sensor GROUP BY machine_id, reading_date""")

# --- weekly -----------------------------------------------------------------------------
cte("production_summary", f"""
SELECT machine_id, machine_name, production_line, machine_type,
       CAST(date_trunc('week', shift_date) AS DATE) AS week_start,
       count(shift_date) AS days_in_week,
       {avg_dec('oee', 4, 5, 4)} AS avg_oee,
       CAST(min(oee) AS DECIMAL(5,4)) AS min_oee, CAST(max(oee) AS DECIMAL(5,4)) AS max_oee,
       CAST(sum(total_units) AS BIGINT) AS total_units_produced,
       CAST(sum(good_units) AS BIGINT) AS total_good_units,
       CAST(sum(total_defects) AS BIGINT) AS total_defects,
       CAST(sum(downtime_hrs) AS DECIMAL(18,4)) AS total_downtime_hrs,
       {avg_dec('availability_rate', 4, 5, 4)} AS avg_availability,
       {avg_dec('performance_rate', 4, 5, 4)} AS avg_performance,
       {avg_dec('quality_rate', 4, 5, 4)} AS avg_quality
FROM oee_daily
GROUP BY machine_id, machine_name, production_line, machine_type, CAST(date_trunc('week', shift_date) AS DATE)""")


# --- trend / health window / queue ------------------------------------------------------
_S1, _S0 = as_int("s1", 4), as_int("s0", 4)
cte("oee_trend", f"""
SELECT machine_id, max_date, s1, n1, s0, n0,
       CASE WHEN n1 = 0 THEN NULL ELSE {hu(_S1, 'n1', 4)} END AS last8,
       CASE WHEN n0 = 0 THEN NULL ELSE {hu(_S0, 'n0', 4)} END AS prior8,
       (n1 > 0 AND n0 > 0 AND {_S1} * n0 < {_S0} * n1 - 300 * n0 * n1) AS declining
FROM (SELECT o.machine_id, d.max_date,
             sum(CASE WHEN o.shift_date >= d.max_date - 7 THEN o.oee END) AS s1,
             count(CASE WHEN o.shift_date >= d.max_date - 7 THEN o.oee END) AS n1,
             sum(CASE WHEN o.shift_date >= d.max_date - 14 AND o.shift_date < d.max_date - 7 THEN o.oee END) AS s0,
             count(CASE WHEN o.shift_date >= d.max_date - 14 AND o.shift_date < d.max_date - 7 THEN o.oee END) AS n0
      FROM oee_daily o JOIN (SELECT machine_id, max(shift_date) AS max_date FROM oee_daily GROUP BY machine_id) d
        ON o.machine_id = d.machine_id
      GROUP BY o.machine_id, d.max_date)""")
cte("trend_report", f"""
SELECT machine_id, max_date,
       CAST({units('last8', 8, 38)} AS DECIMAL(5,4)) AS oee_last_7d,
       CAST({units('prior8', 8, 38)} AS DECIMAL(5,4)) AS oee_prior_7d,
       CAST({units('last8 - prior8', 8, 38)} AS DECIMAL(6,4)) AS oee_trend_delta,
       declining
FROM oee_trend""")


def _avg_units(col: str, s: int) -> str:
    """integer count of 10^-(s+4) units of AVG(col) with Spark's half-up rounding"""
    return f"CASE WHEN count({col}) = 0 THEN NULL ELSE {hu(as_int(f'sum({col})', s), f'count({col})', 4)} END"


cte("recent_health", f"""
SELECT machine_id, max(reading_date) AS reading_date, bool_or(anomaly_flag) AS anomaly_flag,
       {_avg_units('avg_temp_c', 2)} AS at6, max(max_temp_c) AS max_temp_c,
       {_avg_units('avg_vibration_mm_s', 3)} AS av7, max(max_vibration_mm_s) AS max_vibration_mm_s,
       {_avg_units('avg_power_kw', 3)} AS ap7, max(max_power_kw) AS max_power_kw
FROM machine_health WHERE reading_date >= (SELECT max(reading_date) FROM machine_health) - 7
GROUP BY machine_id""")
cte("latest_health", f"""
SELECT machine_id, reading_date, anomaly_flag,
       CAST({units('at6', 6, 38)} AS DECIMAL(6,2)) AS avg_temp_c, CAST(max_temp_c AS DECIMAL(6,2)) AS max_temp_c,
       CAST({units('av7', 7, 38)} AS DECIMAL(7,3)) AS avg_vibration_mm_s,
       CAST(max_vibration_mm_s AS DECIMAL(7,3)) AS max_vibration_mm_s
FROM recent_health""")
_RT = f"CASE WHEN at6 > 0 THEN {hu(f'abs({as_int('max_temp_c', 6)} - at6)', 'at6', 6)} ELSE 0 END"
_RV = f"CASE WHEN av7 > 0 THEN {hu(f'abs({as_int('max_vibration_mm_s', 7)} - av7)', 'av7', 6)} ELSE 0 END"
cte("at_risk", f"""
SELECT h.machine_id, m.machine_name, m.machine_type, m.production_line, h.reading_date, h.anomaly_flag,
       {units('h.at6', 6, 38)} AS avg_temp_c, h.max_temp_c,
       {units('h.av7', 7, 38)} AS avg_vibration_mm_s, h.max_vibration_mm_s,
       {units('h.ap7', 7, 38)} AS avg_power_kw, h.max_power_kw,
       coalesce({units('t.last8', 8, 38)}, 0) AS oee_last_7d,
       coalesce({units('t.prior8', 8, 38)}, 0) AS oee_prior_7d,
       {units(f'greatest({_RT}, {_RV})', 6, 10)} AS anomaly_score
FROM recent_health h JOIN stg_machines m ON h.machine_id = m.machine_id
LEFT JOIN oee_trend t ON h.machine_id = t.machine_id
WHERE h.anomaly_flag OR coalesce(t.declining, FALSE)""")
cte("latest_rec", """
SELECT * FROM recs_raw
QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY generated_at DESC, rec_id DESC) = 1""")
cte("maintenance_queue", """
SELECT m.machine_id, m.machine_name, m.production_line, m.machine_type, h.reading_date, h.anomaly_flag,
       h.avg_temp_c, h.max_temp_c, h.avg_vibration_mm_s, h.max_vibration_mm_s,
       t.oee_last_7d, t.oee_prior_7d, t.oee_trend_delta,
       r.anomaly_score, r.root_cause, r.recommended_action, r.estimated_hours_to_failure, r.confidence,
       r.similar_pattern_ids, r.generated_at AS ai_generated_at,
       CASE WHEN r.estimated_hours_to_failure <= 8 THEN 'CRITICAL'
            WHEN r.estimated_hours_to_failure <= 24 THEN 'HIGH'
            WHEN r.estimated_hours_to_failure <= 72 THEN 'MEDIUM'
            ELSE 'LOW' END AS urgency_tier
FROM stg_machines m
JOIN latest_health h ON m.machine_id = h.machine_id
JOIN trend_report t ON m.machine_id = t.machine_id
LEFT JOIN latest_rec r ON m.machine_id = r.machine_id
WHERE h.anomaly_flag = TRUE OR t.declining""")
cte("queue_ranked", """
SELECT *, CASE urgency_tier WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS tier_rank
FROM maintenance_queue""")

# --- responses --------------------------------------------------------------------------
_RC = """'"root_cause": "Bearing wear pattern ' || CAST(k AS VARCHAR) || '"'"""
_ACT = """'"recommended_action": "Replace spindle bearing"'"""
_CONF = f"""'"confidence": "' || {CONFIDENCE_LEVELS}[k % 3 + 1] || '"'"""
_HRS = "CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)"
_NUM = f"""'"estimated_hours_to_failure": ' || {_HRS}"""
cte("responses", f"""
SELECT event_id AS response_id, machine_id,
       CASE WHEN k % 10 = 0 THEN '{{' || {_RC}
            WHEN k % 10 = 1 THEN '{{' || {_RC} || ', ' || {_ACT} || ', ' || {_CONF} || '}}'
            WHEN k % 10 = 2 THEN '{{' || {_RC} || ', ' || {_ACT} || ', ' || '"estimated_hours_to_failure": "' || {_HRS} || '"' || ', ' || {_CONF} || '}}'
            WHEN k % 10 = 3 THEN '{{' || {_RC} || ', ' || {_ACT} || ', ' || {_NUM} || ', ' || '"confidence": "CERTAIN"}}'
            ELSE '{{' || {_RC} || ', ' || {_ACT} || ', ' || {_NUM} || ', ' || {_CONF} || '}}' END AS response
FROM ev WHERE event_type = 'click'""")
_RAW_H = "CASE WHEN json_valid(response) THEN json_extract_string(response, '$.estimated_hours_to_failure') END"
cte("validated", f"""
SELECT response_id, machine_id, response, ok AS is_valid,
       CASE WHEN ok THEN json_extract_string(response, '$.root_cause') END AS root_cause,
       CASE WHEN ok THEN json_extract_string(response, '$.recommended_action') END AS recommended_action,
       CASE WHEN ok THEN least(greatest(TRY_CAST({_RAW_H} AS DOUBLE), 1.0), 720.0) END AS estimated_hours_to_failure,
       CASE WHEN ok THEN (CASE WHEN json_extract_string(response, '$.confidence') IN ('HIGH', 'MEDIUM', 'LOW')
                               THEN json_extract_string(response, '$.confidence') ELSE 'MEDIUM' END) END AS confidence
FROM (SELECT *, coalesce(CASE WHEN json_valid(response) THEN
                   list_has_all(json_keys(response), ['root_cause', 'recommended_action', 'estimated_hours_to_failure', 'confidence'])
                   AND TRY_CAST(json_extract_string(response, '$.estimated_hours_to_failure') AS DOUBLE) IS NOT NULL END, FALSE) AS ok
      FROM responses)""")

# --- retrieval ------------------------------------------------------------------------------


def fixed(x: str, d: int) -> str:
    return f"CAST(CAST(coalesce({x}, 0) AS DECIMAL(24,{d})) AS VARCHAR)"


def pct1(x: str) -> str:
    return f"{fixed(f'coalesce({x}, 0) * 100', 1)} || '%'"


def label(x: str) -> str:
    return f"upper(trim(coalesce({x}, 'UNKNOWN')))"


cte("failure_history", f"""
SELECT d.event_id, d.started_at, d.machine_id, m.machine_type, CAST(d.started_at AS DATE) AS event_date, d.reason_code,
       h.avg_temp_c, h.max_temp_c, h.avg_vibration_mm_s, h.max_vibration_mm_s, h.avg_power_kw, h.max_power_kw,
       coalesce(o.oee, CAST(0.70 AS DECIMAL(5,4))) AS oee,
       {units(hu("epoch_us(d.ended_at) - epoch_us(d.started_at)", HOURS_US, 3), 3, 8)} AS downtime_hrs
FROM dt_raw d JOIN stg_machines m ON d.machine_id = m.machine_id
LEFT JOIN machine_health h ON d.machine_id = h.machine_id AND CAST(d.started_at AS DATE) = h.reading_date
LEFT JOIN oee_daily o ON d.machine_id = o.machine_id AND CAST(d.started_at AS DATE) = o.shift_date
WHERE h.avg_temp_c IS NOT NULL""")
FAILURE_DESCRIPTION = (
    f"'Machine type: ' || {label('machine_type')} || chr(10) || "
    f"'Failure type: ' || {label('reason_code')} || chr(10) || "
    f"'Date: ' || coalesce(substr(CAST(event_date AS VARCHAR), 1, 10), 'unknown') || chr(10) || "
    f"'Sensor readings on failure day:' || chr(10) || "
    f"'  Temperature: max ' || {fixed('max_temp_c', 1)} || '°C, average ' || {fixed('avg_temp_c', 1)} || '°C' || chr(10) || "
    f"'  Vibration: max ' || {fixed('max_vibration_mm_s', 3)} || ' mm/s, average ' || {fixed('avg_vibration_mm_s', 3)} || ' mm/s' || chr(10) || "
    f"'  Power: max ' || {fixed('max_power_kw', 2)} || ' kW, average ' || {fixed('avg_power_kw', 2)} || ' kW' || chr(10) || "
    f"'OEE: ' || {pct1('oee')} || chr(10) || "
    f"'Downtime: ' || {fixed('downtime_hrs', 1)} || ' hours'")
MACHINE_DESCRIPTION = (
    f"'Machine type: ' || {label('machine_type')} || chr(10) || "
    f"'Current anomaly detected' || chr(10) || "
    f"'Sensor readings (recent 7-day window):' || chr(10) || "
    f"'  Temperature: max ' || {fixed('max_temp_c', 1)} || '°C, average ' || {fixed('avg_temp_c', 1)} || '°C' || chr(10) || "
    f"'  Vibration: max ' || {fixed('max_vibration_mm_s', 3)} || ' mm/s, average ' || {fixed('avg_vibration_mm_s', 3)} || ' mm/s' || chr(10) || "
    f"'  Power: max ' || {fixed('max_power_kw', 2)} || ' kW, average ' || {fixed('avg_power_kw', 2)} || ' kW' || chr(10) || "
    f"'7-day OEE: ' || {pct1('oee_last_7d')}")
cte("numbered_history", "SELECT *, row_number() OVER (ORDER BY started_at, machine_id, event_id) AS pattern_id FROM failure_history")
cte("pattern_store", f"""
SELECT CAST(h.pattern_id AS BIGINT) AS pattern_id, h.machine_id, {label('h.machine_type')} AS machine_type, h.event_date,
       {label('h.reason_code')} AS reason_code, coalesce(h.downtime_hrs, CAST(0 AS DECIMAL(8,3))) AS downtime_hrs,
       {FAILURE_DESCRIPTION.replace('machine_type', 'h.machine_type').replace('reason_code', 'h.reason_code')} AS description,
       CAST(e.embedding AS DOUBLE[]) AS embedding
FROM numbered_history h JOIN embeddings e ON e.vec_id = h.pattern_id % (SELECT n FROM n_v)""")
cte("query_vectors", """
SELECT a.machine_id, CAST(e.embedding AS DOUBLE[]) AS embedding
FROM at_risk a JOIN embeddings e ON e.vec_id = a.machine_id % (SELECT n FROM n_v)""")
cte("similar_top", """
SELECT machine_id, CAST(row_number() OVER (PARTITION BY machine_id ORDER BY round(sim, 9) DESC, pattern_id) AS INTEGER) AS rank,
       pattern_id, machine_type, event_date, reason_code, downtime_hrs, sim AS similarity
FROM (SELECT q.machine_id, p.pattern_id, p.machine_type, p.event_date, p.reason_code, p.downtime_hrs,
             CASE WHEN list_dot_product(q.embedding, q.embedding) = 0 OR list_dot_product(p.embedding, p.embedding) = 0
                  THEN 0.0 ELSE list_cosine_similarity(q.embedding, p.embedding) END AS sim
      FROM query_vectors q CROSS JOIN pattern_store p)
QUALIFY rank <= 3""")
cte("fallback", """
SELECT a.machine_id, a.machine_name,
       'Pattern matches historical ' || lower(replace(coalesce(s.reason_code, 'UNKNOWN'), '_', ' ')) || ' events.' AS root_cause,
       'Schedule immediate inspection of mechanical components.' AS recommended_action,
       least(greatest(CASE WHEN s.downtime_hrs IS NULL THEN 24.0 ELSE CAST(s.downtime_hrs AS DOUBLE) * 2 END, 1.0), 720.0)
         AS estimated_hours_to_failure,
       'LOW' AS confidence
FROM at_risk a LEFT JOIN similar_top s ON a.machine_id = s.machine_id AND s.rank = 1""")
cte("latest_resp", "SELECT * FROM validated QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY response_id DESC) = 1")
cte("pid_list", """
SELECT machine_id, '[' || string_agg(CAST(pattern_id AS VARCHAR), ',' ORDER BY rank) || ']' AS similar_pattern_ids
FROM similar_top GROUP BY machine_id""")


def new_recs_sql(ts: str) -> str:
    def pick(c: str) -> str:
        return f"CASE WHEN coalesce(r.is_valid, FALSE) THEN r.{c} ELSE f.{c} END"
    return f"""
SELECT a.machine_id, substr(coalesce(a.machine_name, ''), 1, 100) AS machine_name, TIMESTAMP '{ts}' AS generated_at,
       CAST(CAST(a.anomaly_score AS DECIMAL(10,4)) AS DECIMAL(6,3)) AS anomaly_score,
       substr({pick('root_cause')}, 1, 1000) AS root_cause,
       substr({pick('recommended_action')}, 1, 1000) AS recommended_action,
       CAST({pick('estimated_hours_to_failure')} AS DECIMAL(6,1)) AS estimated_hours_to_failure,
       {pick('confidence')} AS confidence,
       coalesce(p.similar_pattern_ids, '[]') AS similar_pattern_ids
FROM at_risk a JOIN fallback f ON a.machine_id = f.machine_id
LEFT JOIN latest_resp r ON a.machine_id = r.machine_id
LEFT JOIN pid_list p ON a.machine_id = p.machine_id"""


cte("new_recs", new_recs_sql("2024-01-31 00:00:00"))
cte("new_recs_0130", new_recs_sql("2024-01-30 00:00:00"))
cte("upserted", """
SELECT * FROM recs_raw r
WHERE NOT EXISTS (SELECT 1 FROM new_recs_0130 n
                  WHERE n.machine_id = r.machine_id AND CAST(n.generated_at AS DATE) = CAST(r.generated_at AS DATE))
UNION ALL
SELECT (SELECT coalesce(max(rec_id), 0) FROM recs_raw) + row_number() OVER (ORDER BY machine_id) AS rec_id,
       machine_id, machine_name, generated_at, anomaly_score, root_cause, recommended_action,
       estimated_hours_to_failure, confidence, similar_pattern_ids
FROM new_recs_0130""")


# --- events & signals -----------------------------------------------------------------------


def cooldown(name: str, src: str, key: str, ts: str, ident: str, seconds: int) -> None:
    """ident: comma-separated tie-break columns after ts."""
    """Greedy cooldown as a recursive walk over each key's events in (ts, id) order."""
    T = seconds * 1_000_000
    cte(f"{name}_ordered", f"""
SELECT *, epoch_us({ts}) AS _t, row_number() OVER (PARTITION BY {key} ORDER BY {ts}, {ident}) AS _rn FROM {src}""")
    cte(f"{name}_walk", f"""
SELECT {key} AS _k, _rn, _t AS _last, TRUE AS _kept FROM {name}_ordered WHERE _rn = 1
UNION ALL
SELECT o.{key}, o._rn, CASE WHEN o._t > w._last + {T} THEN o._t ELSE w._last END, o._t > w._last + {T}
FROM {name}_walk w JOIN {name}_ordered o ON o.{key} = w._k AND o._rn = w._rn + 1""")
    RECURSIVE.add(f"{name}_walk")
    cte(name, f"""
SELECT o.* EXCLUDE (_t, _rn) FROM {name}_walk w JOIN {name}_ordered o ON o.{key} = w._k AND o._rn = w._rn
WHERE w._kept""")


cooldown("cooldown_kept", "dt_raw", "machine_id", "started_at", "event_id", 7200)
cte("sig", """
SELECT l_orderkey * 10 + l_linenumber AS UDI, 'P' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS "Product ID",
       CAST(l_suppkey % (SELECT n FROM n_m) AS INTEGER) AS machine_id,
       l_shipdate + to_minutes(CAST((l_orderkey % 288) * 5 AS INTEGER)) AS ts,
       300.0 + l_quantity / 10 AS temp_k, 1000.0 + l_extendedprice % 2000 AS rpm, l_quantity AS torque,
       CAST(l_returnflag = 'R' AS INTEGER) AS failure,
       CAST(l_returnflag = 'R' AND l_partkey % 7 = 0 AS INTEGER) AS TWF,
       CAST(l_returnflag = 'R' AND l_partkey % 7 = 1 AS INTEGER) AS HDF,
       CAST(l_returnflag = 'R' AND l_partkey % 7 = 2 AS INTEGER) AS PWF,
       CAST(l_returnflag = 'R' AND l_partkey % 7 = 3 AS INTEGER) AS OSF,
       CAST(l_returnflag = 'R' AND l_partkey % 7 = 4 AS INTEGER) AS RNF,
       l_linenumber
FROM lineitem""")
REASON_CASE = ("CASE WHEN TWF = 1 THEN 'TOOLING_FAILURE' WHEN HDF = 1 THEN 'MATERIAL_JAM' "
               "WHEN PWF = 1 THEN 'POWER_FLUCTUATION' WHEN OSF = 1 THEN 'OPERATOR_ERROR' "
               "WHEN RNF = 1 THEN 'UNPLANNED_BREAKDOWN' ELSE 'UNPLANNED_BREAKDOWN' END")
cte("sig_fail", "SELECT * FROM sig WHERE failure = 1")
cooldown("sig_kept", "sig_fail", "machine_id", "ts", 'UDI, "Product ID"', 7200)
cte("derived_downtime", f"""
SELECT (SELECT coalesce(max(event_id), 0) FROM dt_raw) + row_number() OVER (ORDER BY ts, machine_id, UDI, "Product ID") AS event_id,
       machine_id, ts AS started_at, ts + to_minutes(CAST(15 + (UDI * 7 + machine_id) % 166 AS INTEGER)) AS ended_at,
       {REASON_CASE} AS reason_code
FROM sig_kept""")
cte("sig_clean", """
SELECT UDI, temp_k AS "Process temperature [K]", rpm AS "Rotational speed [rpm]", torque AS "Torque [Nm]",
       failure AS "Machine failure", TWF, HDF, PWF, OSF, RNF
FROM sig WHERE l_linenumber <> 7""")
cte("sig_features", f"""
SELECT UDI, "Process temperature [K]" - 273.15 AS process_temp_c, "Rotational speed [rpm]" AS rpm,
       "Torque [Nm]" * "Rotational speed [rpm]" * pi() / 30.0 / 1000.0 AS power_kw,
       coalesce("Machine failure", 0) = 1 AS failure, {REASON_CASE} AS failure_reason
FROM sig_clean""")
cte("sig_stats", """
SELECT count(*) AS rows, avg(process_temp_c) AS temp_mean, stddev_samp(process_temp_c) AS temp_std,
       avg(rpm) AS rpm_mean, stddev_samp(rpm) AS rpm_std, avg(power_kw) AS pwr_mean, stddev_samp(power_kw) AS pwr_std,
       CAST(count_if(failure) AS BIGINT) AS failures, avg(CAST(failure AS INTEGER)) AS failure_rate
FROM sig_features""")
cte("sig_all_features", """
SELECT UDI, machine_id, temp_k - 273.15 AS process_temp_c, rpm, torque * rpm * pi() / 30.0 / 1000.0 AS power_kw
FROM sig""")
cte("baselines", """
SELECT * FROM (VALUES (1, 68.0, 1.20, 18.5, 3.0, 0.15, 1.5), (2, 70.5, 1.35, 19.2, 3.0, 0.15, 1.5),
  (3, 55.0, 0.85, 12.0, 2.5, 0.10, 1.0), (4, 56.5, 0.90, 12.8, 2.5, 0.10, 1.0), (5, 82.0, 2.10, 35.0, 5.0, 0.25, 3.0),
  (6, 81.5, 2.05, 34.5, 5.0, 0.25, 3.0), (7, 60.0, 1.00, 22.0, 3.0, 0.12, 2.0), (8, 75.0, 0.60, 45.0, 4.0, 0.08, 4.0),
  (9, 74.5, 0.65, 44.8, 4.0, 0.08, 4.0), (10, 40.0, 0.20, 8.5, 2.0, 0.05, 0.8))
  AS t(baseline_id, temp, vib, pwr, temp_std, vib_std, pwr_std)""")


def zs(raw: str, m: str, sd: str, tm: str, ts: str) -> str:
    st = "st.{c}"
    return (f"(CAST({tm} AS DOUBLE) + CASE WHEN {st.format(c=sd)} > 0 THEN ({raw} - {st.format(c=m)}) / {st.format(c=sd)} "
            f"ELSE 0.0 END * CAST({ts} AS DOUBLE))")


cte("zscaled", f"""
SELECT f.UDI, f.machine_id,
       greatest(20.0, round({zs('f.process_temp_c', 'temp_mean', 'temp_std', 'b.temp', 'b.temp_std')}, 2)) AS temperature_c,
       greatest(0.0, round(abs({zs('f.rpm', 'rpm_mean', 'rpm_std', 'b.vib', 'b.vib_std')}), 3)) AS vibration_mm_s,
       greatest(0.0, round(abs({zs('f.power_kw', 'pwr_mean', 'pwr_std', 'b.pwr', 'b.pwr_std')}), 3)) AS power_kw
FROM sig_all_features f JOIN baselines b ON (f.machine_id % 10 + 10) % 10 + 1 = b.baseline_id,
     (SELECT avg(process_temp_c) AS temp_mean, stddev_samp(process_temp_c) AS temp_std, avg(rpm) AS rpm_mean,
             stddev_samp(rpm) AS rpm_std, avg(power_kw) AS pwr_mean, stddev_samp(power_kw) AS pwr_std
      FROM sig_all_features) st""")
cte("coverage", """
SELECT m.machine_id, d.shift_date, s.shift_label
FROM stg_machines m
CROSS JOIN (SELECT CAST(unnest(range(CAST(min(shift_date) AS TIMESTAMP), CAST(max(shift_date) AS TIMESTAMP) + INTERVAL 1 DAY,
                                     INTERVAL 1 DAY)) AS DATE) AS shift_date FROM stg_orders) d
CROSS JOIN (SELECT unnest(['MORNING', 'AFTERNOON', 'NIGHT']) AS shift_label) s
WHERE NOT EXISTS (SELECT 1 FROM stg_orders o
                  WHERE o.machine_id = m.machine_id AND o.shift_date = d.shift_date AND o.shift_label = s.shift_label)""")

# --- reports -------------------------------------------------------------------------------------
cte("summary7", f"""
SELECT machine_name, machine_type, production_line,
       {_avg_units('oee', 4)} AS o8, {_avg_units('availability_rate', 4)} AS a8,
       {_avg_units('performance_rate', 4)} AS p8, {_avg_units('quality_rate', 4)} AS q8
FROM oee_daily WHERE shift_date >= (SELECT max(shift_date) FROM oee_daily) - 7
GROUP BY machine_name, machine_type, production_line""")
cte("named", """
SELECT h.machine_id, o.machine_name, o.machine_type, h.reading_date, h.avg_temp_c, h.max_temp_c,
       h.avg_vibration_mm_s, h.max_vibration_mm_s, h.avg_power_kw, h.max_power_kw, h.anomaly_flag
FROM machine_health h JOIN (SELECT DISTINCT machine_id, machine_name, machine_type FROM oee_daily) o
  ON h.machine_id = o.machine_id""")


def u8(x: str) -> str:
    return f"CAST({units(x, 8, 38)} AS DOUBLE)"


def u12(x: str) -> str:
    return f"CAST({units(x, 12, 38)} AS DOUBLE)"


def avg_of_units(col: str) -> str:
    """Spark AVG over decimal(9,8) values held as integer units: result scale 12."""
    return f"CASE WHEN count({col}) = 0 THEN NULL ELSE {hu(f'sum({col})', f'count({col})', 4)} END"


cte("weekly_fleet", f"""
SELECT week_start, {_avg_units('avg_oee', 4)} AS w8 FROM production_summary GROUP BY week_start""")



def _deps(text: str, seen: list[str], visiting: set[str] | None = None) -> None:
    visiting = set() if visiting is None else visiting
    for name in CTES:
        if name in seen or name in visiting:
            continue
        if re.search(rf"\b{re.escape(name)}\b", text):
            visiting.add(name)
            _deps(CTES[name], seen, visiting)
            if name not in seen:
                seen.append(name)


def with_ctes(final: str) -> str:
    order: list[str] = []
    _deps(final, order)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    kw = "WITH RECURSIVE" if RECURSIVE & set(order) else "WITH"
    return f"{kw} {body}\n{final}"


QUERIES: dict[str, str] = {}


def q(name: str, final: str) -> None:
    QUERIES[name] = with_ctes(final)


def dbl(*cols: str) -> str:
    """Decimal outputs are compared as DOUBLE on both sides."""
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


q("stg_machines", "SELECT * FROM stg_machines")
q("stg_orders", f"SELECT * EXCLUDE (shift_duration_hrs), {dbl('shift_duration_hrs')} FROM stg_orders")
q("stg_defects", "SELECT * FROM stg_defects")
q("stg_sensor", f"SELECT machine_id, ts, ts_hour, reading_date, {dbl('temperature_c', 'vibration_mm_s', 'power_kw')} FROM stg_sensor")
q("stg_downtime", f"SELECT * EXCLUDE (duration_hrs), {dbl('duration_hrs')} FROM stg_downtime")
q("availability", f"SELECT machine_id, shift_date, {dbl('planned_time_hrs', 'downtime_hrs', 'available_time_hrs', 'availability_rate')} FROM int_availability")
q("performance", f"SELECT machine_id, shift_date, total_actual_qty, total_planned_qty, theoretical_rate_per_hr, {dbl('available_time_hrs', 'theoretical_output', 'performance_rate')} FROM int_performance")
q("quality", f"SELECT machine_id, shift_date, total_units, total_defects, good_units, {dbl('quality_rate')} FROM int_quality")
q("oee_daily", f"""SELECT machine_id, machine_name, production_line, machine_type, theoretical_rate_per_hr, shift_date,
 {dbl('planned_time_hrs', 'downtime_hrs', 'available_time_hrs', 'availability_rate')}, total_actual_qty,
 {dbl('theoretical_output', 'performance_rate')}, total_units, good_units, total_defects, {dbl('quality_rate', 'oee')}
FROM oee_daily""")
q("machine_health", f"""SELECT machine_id, reading_date, reading_count,
 {dbl('avg_temp_c', 'max_temp_c', 'avg_vibration_mm_s', 'max_vibration_mm_s', 'avg_power_kw', 'max_power_kw')}, anomaly_flag
FROM machine_health""")
q("production_summary", f"""SELECT machine_id, machine_name, production_line, machine_type, week_start, days_in_week,
 {dbl('avg_oee', 'min_oee', 'max_oee')}, total_units_produced, total_good_units, total_defects,
 {dbl('total_downtime_hrs', 'avg_availability', 'avg_performance', 'avg_quality')}
FROM production_summary""")

q("oee_trend_7d", f"SELECT machine_id, max_date, {dbl('oee_last_7d', 'oee_prior_7d', 'oee_trend_delta')} FROM trend_report")
q("latest_health", f"SELECT machine_id, reading_date, anomaly_flag, {dbl('avg_temp_c', 'max_temp_c', 'avg_vibration_mm_s', 'max_vibration_mm_s')} FROM latest_health")
q("at_risk_machines", f"""SELECT machine_id, machine_name, machine_type, production_line, reading_date, anomaly_flag,
 {dbl('avg_temp_c', 'max_temp_c', 'avg_vibration_mm_s', 'max_vibration_mm_s', 'avg_power_kw', 'max_power_kw', 'oee_last_7d', 'oee_prior_7d', 'anomaly_score')}
FROM at_risk""")
q("maintenance_queue", f"""SELECT machine_id, machine_name, production_line, machine_type, reading_date, anomaly_flag,
 {dbl('avg_temp_c', 'max_temp_c', 'avg_vibration_mm_s', 'max_vibration_mm_s', 'oee_last_7d', 'oee_prior_7d', 'oee_trend_delta', 'anomaly_score')},
 root_cause, recommended_action, {dbl('estimated_hours_to_failure')}, confidence, similar_pattern_ids, ai_generated_at, urgency_tier
FROM maintenance_queue""")
q("latest_recommendation", f"""SELECT rec_id, machine_id, machine_name, generated_at, {dbl('anomaly_score')}, root_cause,
 recommended_action, {dbl('estimated_hours_to_failure')}, confidence, similar_pattern_ids FROM latest_rec""")
q("urgency_tiers", f"""SELECT rec_id, machine_id, {dbl('estimated_hours_to_failure')},
 CASE WHEN estimated_hours_to_failure <= 8 THEN 'CRITICAL' WHEN estimated_hours_to_failure <= 24 THEN 'HIGH'
      WHEN estimated_hours_to_failure <= 72 THEN 'MEDIUM' ELSE 'LOW' END AS urgency_tier FROM recs_raw""")
q("urgency_breakdown", "SELECT urgency_tier, count(*) AS machines, min(tier_rank) AS tier_rank FROM queue_ranked GROUP BY urgency_tier")
q("queue_headline", f"""SELECT
 (SELECT machine_name FROM queue_ranked ORDER BY tier_rank, estimated_hours_to_failure ASC NULLS LAST, machine_id LIMIT 1) AS top_machine,
 (SELECT urgency_tier FROM queue_ranked ORDER BY tier_rank, estimated_hours_to_failure ASC NULLS LAST, machine_id LIMIT 1) AS top_tier,
 (SELECT CAST(estimated_hours_to_failure AS DOUBLE) FROM queue_ranked ORDER BY tier_rank, estimated_hours_to_failure ASC NULLS LAST, machine_id LIMIT 1) AS top_hours,
 (SELECT count(*) FROM queue_ranked WHERE urgency_tier = 'CRITICAL') AS n_critical,
 (SELECT count(*) FROM queue_ranked WHERE urgency_tier = 'HIGH') AS n_high,
 (SELECT count(*) FROM queue_ranked WHERE estimated_hours_to_failure <= 24) AS n_within_24h,
 (SELECT CAST(min(estimated_hours_to_failure) AS DOUBLE) FROM queue_ranked) AS shortest_hours,
 (SELECT machine_name FROM queue_ranked WHERE estimated_hours_to_failure IS NOT NULL
   ORDER BY estimated_hours_to_failure, tier_rank, machine_id LIMIT 1) AS shortest_machine,
 (SELECT count(*) FROM queue_ranked) AS machines""")
q("validate_responses", "SELECT response_id, machine_id, is_valid, root_cause, recommended_action, estimated_hours_to_failure, confidence FROM validated")
q("safe_cast", f"SELECT response_id, {_RAW_H} AS raw_hours, coalesce(TRY_CAST({_RAW_H} AS DOUBLE), 0.0) AS hours FROM responses")

q("failure_history", f"""SELECT event_id, started_at, machine_id, machine_type, event_date, reason_code,
 {dbl('avg_temp_c', 'max_temp_c', 'avg_vibration_mm_s', 'max_vibration_mm_s', 'avg_power_kw', 'max_power_kw', 'oee', 'downtime_hrs')}
FROM failure_history""")
q("failure_descriptions", f"SELECT event_id, {FAILURE_DESCRIPTION} AS description FROM failure_history")
q("assign_ids", "SELECT event_id, CAST(pattern_id AS BIGINT) AS pattern_id FROM numbered_history")
q("failure_patterns", f"""SELECT pattern_id, machine_id, machine_type, event_date, reason_code, {dbl('downtime_hrs')},
 description, CAST(len(embedding) AS INTEGER) AS embedding_dims FROM pattern_store""")
q("similar_failures", f"""SELECT machine_id, rank, pattern_id, machine_type, event_date, reason_code, {dbl('downtime_hrs')},
 round(similarity, 6) AS similarity FROM similar_top""")
QUERIES["similar_failures_indexed"] = QUERIES["similar_failures"]
q("grown_pattern_ids", """SELECT event_id, CAST(row_number() OVER (ORDER BY event_id % 5 = 0, started_at, machine_id, event_id) AS BIGINT)
 AS pattern_id FROM failure_history""")
q("pattern_preview", f"""SELECT pattern_id, machine_type, event_date, reason_code, {dbl('downtime_hrs')},
 substr(description, 1, 120) AS description_preview FROM pattern_store ORDER BY event_date DESC, pattern_id DESC LIMIT 10""")
q("embedding_dims", """SELECT pattern_id,
 CAST(length(array_to_string(list_transform(embedding, lambda x: printf('%.8f', x)), ',')) AS INTEGER) AS embedding_chars,
 CAST(len(embedding) AS INTEGER) AS embedding_dims FROM pattern_store""")
q("vector_parse", """SELECT vec_id, CAST(len(parsed) AS INTEGER) AS dims,
 list_max(list_transform(list_zip(parsed, emb), lambda x: abs(x[1] - x[2]))) < 1e-8 AS round_trip_ok,
 round(CASE WHEN list_dot_product(parsed, parsed) = 0 OR list_dot_product(emb, emb) = 0 THEN 0.0
            ELSE list_cosine_similarity(parsed, emb) END, 6) AS self_cosine
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS emb,
             list_transform(string_split(array_to_string(list_transform(CAST(embedding AS DOUBLE[]), lambda x: printf('%.8f', x)), ','), ','),
                            lambda x: CAST(x AS DOUBLE)) AS parsed
      FROM embeddings)""")
q("failures_by_reason", f"""SELECT reason_code, count(*) AS occurrences,
 CAST({units(hu(_avg_units('downtime_hrs', 3), 1000000, 0), 1, 10)} AS DOUBLE) AS avg_downtime_hrs
FROM pattern_store GROUP BY reason_code""")
def _card(value: str, shown: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '—' ELSE {shown} END"


q("queue_cards", f"""SELECT machine_id, machine_name, coalesce(urgency_tier, 'LOW') AS tier,
 {_card('estimated_hours_to_failure', fixed('estimated_hours_to_failure', 0) + " || ' h'")} AS hours_label,
 {_card('oee_trend_delta', "CASE WHEN oee_trend_delta < 0 THEN '▼ ' ELSE '▲ ' END || " + pct1('abs(oee_trend_delta)'))} AS trend_label,
 coalesce(machine_type, '—') AS type_label, {_card('oee_last_7d', pct1('oee_last_7d'))} AS oee_label,
 {_card('avg_temp_c', fixed('avg_temp_c', 1) + " || ' °C'")} AS temp_label,
 {_card('avg_vibration_mm_s', fixed('avg_vibration_mm_s', 3) + " || ' mm/s'")} AS vibration_label,
 coalesce(root_cause, '—') AS root_cause, coalesce(recommended_action, '—') AS recommended_action
FROM maintenance_queue""")
cte("matches", f"""SELECT machine_id, string_agg(
   format('  {{}}. {{}} on {{}} ({{}}, {{}}h downtime, {{}}% alike)', rank, reason_code, event_date, machine_type,
          {fixed('downtime_hrs', 1)}, {fixed('similarity * 100', 0)}) || chr(10), '' ORDER BY rank) AS lines
FROM similar_top GROUP BY machine_id""")
q("prompts", f"""SELECT a.machine_id, a.machine_name, concat(
 'You assist the maintenance team of a production site. Study the machine below. ',
 'Answer with one JSON object and nothing before or after it.', chr(10), chr(10),
 format('Machine: {{}} ({{}}, {{}})', machine_name, machine_type, production_line), chr(10),
 'Anomaly score: ', {fixed('anomaly_score', 3)}, chr(10),
 'OEE of the last 7 days: ', {pct1('oee_last_7d')}, ' (7 days before: ', {pct1('oee_prior_7d')}, ')', chr(10),
 format('Temperature, peak: {{}}°C (mean: {{}}°C)', {fixed('max_temp_c', 1)}, {fixed('avg_temp_c', 1)}), chr(10),
 format('Vibration, peak: {{}} mm/s (mean: {{}} mm/s)', {fixed('max_vibration_mm_s', 3)}, {fixed('avg_vibration_mm_s', 3)}), chr(10),
 format('Power, peak: {{}} kW (mean: {{}} kW)', {fixed('max_power_kw', 2)}, {fixed('avg_power_kw', 2)}), chr(10), chr(10),
 'Closest past failures, nearest first:', chr(10), coalesce(lines, '  none on record'), chr(10), chr(10),
 'Fill in these four keys:', chr(10), '{{"root_cause": "<what the readings point to, in a sentence>",', chr(10),
 ' "recommended_action": "<one concrete step for the next shift>",', chr(10),
 ' "estimated_hours_to_failure": <number, 1 to 720>,', chr(10), ' "confidence": "<HIGH, MEDIUM or LOW>"}}', chr(10),
 'Weigh how close the past failures are and how far the readings are from normal.', chr(10)) AS prompt
FROM at_risk a LEFT JOIN matches s ON a.machine_id = s.machine_id""")
q("machine_descriptions", f"SELECT machine_id, {MACHINE_DESCRIPTION} AS description FROM at_risk")
q("fallback_recommendations", "SELECT * FROM fallback")
q("recommendations", f"""SELECT machine_id, machine_name, generated_at, {dbl('anomaly_score')}, root_cause, recommended_action,
 {dbl('estimated_hours_to_failure')}, confidence, similar_pattern_ids FROM new_recs""")
q("upsert_recommendations", f"""SELECT rec_id, machine_id, machine_name, generated_at, {dbl('anomaly_score')}, root_cause,
 recommended_action, {dbl('estimated_hours_to_failure')}, confidence, similar_pattern_ids FROM upserted""")

q("cooldown_events", "SELECT event_id, machine_id, started_at, ended_at, reason_code FROM cooldown_kept")
q("derive_downtime", "SELECT * FROM derived_downtime")
q("csv_clean", "SELECT * FROM sig_clean")
q("csv_rejected", "SELECT UDI, 'Rotational speed [rpm]' AS reason FROM sig WHERE l_linenumber = 7")
q("signal_features", "SELECT * FROM sig_features")
q("signal_stats", """SELECT rows, round(temp_mean, 9) AS temp_mean, round(temp_std, 9) AS temp_std,
 round(rpm_mean, 9) AS rpm_mean, round(rpm_std, 9) AS rpm_std, round(pwr_mean, 9) AS pwr_mean,
 round(pwr_std, 9) AS pwr_std, failures, round(failure_rate, 9) AS failure_rate FROM sig_stats""")
q("zscale_signals", "SELECT * FROM zscaled")
q("failure_reason", f"SELECT UDI, {REASON_CASE} AS reason_code FROM sig WHERE failure = 1")
q("coverage_gaps", "SELECT * FROM coverage")
q("oee_summary_7d", f"""SELECT machine_name, machine_type, production_line, {u8('o8')} AS avg_oee, {u8('a8')} AS avg_availability,
 {u8('p8')} AS avg_performance, {u8('q8')} AS avg_quality FROM summary7""")
q("oee_bands", f"""SELECT machine_name, {u8('o8')} AS avg_oee,
 CASE WHEN o8 IS NULL THEN 'NONE' WHEN o8 >= 85000000 THEN 'WORLD_CLASS' WHEN o8 >= 60000000 THEN 'ACCEPTABLE' ELSE 'AT_RISK' END AS band
FROM summary7""")
q("fleet_kpis", f"""SELECT {u12(avg_of_units('o8'))} AS fleet_avg_oee, CAST(count_if(o8 >= 85000000) AS BIGINT) AS n_world_class,
 CAST(count_if(o8 < 60000000) AS BIGINT) AS n_at_risk, count(*) AS n_machines FROM summary7""")
q("fleet_trend", f"""SELECT {u8('r8')} AS recent_oee, {u8('p8')} AS prior_oee,
 CASE WHEN r8 IS NOT NULL AND p8 IS NOT NULL AND p8 > 0 THEN CASE WHEN r8 >= p8 THEN 'improved' ELSE 'declined' END END AS direction,
 CASE WHEN r8 IS NOT NULL AND p8 IS NOT NULL AND p8 > 0 THEN {u8('abs(r8 - p8)')} END AS abs_delta
FROM (SELECT {_avg_units('CASE WHEN shift_date >= (SELECT max(shift_date) FROM oee_daily) - 7 THEN oee END', 4)} AS r8,
             {_avg_units('CASE WHEN shift_date >= (SELECT max(shift_date) FROM oee_daily) - 14 AND shift_date < (SELECT max(shift_date) FROM oee_daily) - 7 THEN oee END', 4)} AS p8
      FROM oee_daily)""")
q("weakest_component", f"""SELECT component, {u12('v')} AS rate FROM (
   SELECT 'Availability' AS component, 1 AS ord, (SELECT {avg_of_units('a8')} FROM summary7) AS v
   UNION ALL SELECT 'Performance', 2, (SELECT {avg_of_units('p8')} FROM summary7)
   UNION ALL SELECT 'Quality', 3, (SELECT {avg_of_units('q8')} FROM summary7))
 WHERE v IS NOT NULL ORDER BY v, ord LIMIT 1""")
q("lowest_performer", f"""SELECT
 (SELECT machine_name FROM summary7 WHERE o8 IS NOT NULL ORDER BY o8, machine_name LIMIT 1) AS machine_name,
 {u8('min(o8)')} AS avg_oee, {u8('85000000 - min(o8)')} AS gap_to_target,
 CAST(count_if(o8 < 85000000) AS BIGINT) AS n_below_target, count(*) AS n_machines FROM summary7""")
q("oee_pct_by_machine", f"""SELECT machine_id,
 CAST({units(hu(_avg_units('oee', 4), 100000, 0), 1, 10)} AS DOUBLE) AS avg_oee_pct,
 CAST({units(hu(as_int('min(oee)', 4), 10, 0), 1, 10)} AS DOUBLE) AS min_oee_pct,
 CAST({units(hu(as_int('max(oee)', 4), 10, 0), 1, 10)} AS DOUBLE) AS max_oee_pct
FROM oee_daily GROUP BY machine_id""")
q("anomaly_days_by_machine", """SELECT machine_id, CAST(sum(CASE WHEN anomaly_flag THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_days,
 count(*) AS total_days FROM machine_health GROUP BY machine_id""")
q("health_with_names", f"""SELECT machine_id, machine_name, machine_type, reading_date,
 {dbl('avg_temp_c', 'max_temp_c', 'avg_vibration_mm_s', 'max_vibration_mm_s', 'avg_power_kw', 'max_power_kw')}, anomaly_flag FROM named""")
q("latest_health_status", """SELECT CAST(count_if(last_flag) AS BIGINT) AS n_active_anomaly, count(*) AS n_machines, max(last_date) AS latest_reading_date
FROM (SELECT machine_name, max(reading_date) OVER (PARTITION BY machine_name) AS last_date, anomaly_flag AS last_flag
      FROM named WHERE anomaly_flag IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY machine_name ORDER BY reading_date DESC, machine_id DESC) = 1)""")
q("most_anomalous", """SELECT machine_name, anomaly_days, (SELECT count(DISTINCT reading_date) FROM named) AS total_days FROM
 (SELECT machine_name, CAST(sum(CAST(anomaly_flag AS INTEGER)) AS BIGINT) AS anomaly_days FROM named GROUP BY machine_name
  ORDER BY anomaly_days DESC, machine_name LIMIT 1)""")
_AT6 = hu(as_int('sum(avg_temp_c)', 2), 'count(avg_temp_c)', 4)
_AV7 = hu(as_int('sum(avg_vibration_mm_s)', 3), 'count(avg_vibration_mm_s)', 4)
q("anomaly_driver", f"""SELECT machine_name, anomaly_days, CAST(peak_temp_c AS DOUBLE) AS peak_temp_c,
 CAST({units('at6', 6, 38)} AS DOUBLE) AS avg_temp_c, CAST(peak_vibration_mm_s AS DOUBLE) AS peak_vibration_mm_s,
 CAST({units('av7', 7, 38)} AS DOUBLE) AS avg_vibration_mm_s,
 CASE WHEN {as_int('peak_temp_c', 2)} * av7 > {as_int('peak_vibration_mm_s', 3)} * at6 THEN 'temperature' ELSE 'vibration' END AS primary_driver
FROM (SELECT machine_name, CAST(count_if(anomaly_flag) AS BIGINT) AS anomaly_days, max(max_temp_c) AS peak_temp_c, {_AT6} AS at6,
             max(max_vibration_mm_s) AS peak_vibration_mm_s, {_AV7} AS av7
      FROM named GROUP BY machine_name) WHERE anomaly_days > 0""")
q("anomaly_days", f"SELECT machine_name, reading_date, {dbl('max_temp_c', 'max_vibration_mm_s', 'max_power_kw')} FROM named WHERE anomaly_flag")
q("oee_components_long", f"""SELECT machine_name, 'Availability' AS component, {u8('a8')} AS rate FROM summary7
 UNION ALL SELECT machine_name, 'Performance', {u8('p8')} FROM summary7
 UNION ALL SELECT machine_name, 'Quality', {u8('q8')} FROM summary7""")
q("downtime_share", f"""SELECT machine_name, CAST(machine_hrs AS DOUBLE) AS machine_hrs, CAST(total_hrs AS DOUBLE) AS total_hrs,
 CAST({units(hu(as_int('machine_hrs', 4), as_int('total_hrs', 4), 6), 6, 10)} AS DOUBLE) AS share
FROM (SELECT (SELECT machine_name FROM (SELECT machine_name, sum(total_downtime_hrs) AS h FROM production_summary GROUP BY machine_name)
              ORDER BY h DESC, machine_name LIMIT 1) AS machine_name,
             max(h) AS machine_hrs, sum(h) AS total_hrs
      FROM (SELECT machine_name, sum(total_downtime_hrs) AS h FROM production_summary GROUP BY machine_name))
WHERE total_hrs > 0""")
q("latest_week_kpis", """SELECT max(week_start) AS week_start, CAST(sum(total_units_produced) AS BIGINT) AS units_produced,
 CAST(sum(total_good_units) AS BIGINT) AS good_units, CAST(sum(total_defects) AS BIGINT) AS defects,
 CAST(sum(total_downtime_hrs) AS DOUBLE) AS downtime_hrs
FROM production_summary WHERE week_start = (SELECT max(week_start) FROM production_summary)""")
q("latest_week_detail", f"""SELECT machine_name, machine_type, total_units_produced, total_good_units, total_defects,
 {dbl('total_downtime_hrs', 'avg_oee')},
 CAST(CASE WHEN total_units_produced = 0 THEN 0 ELSE {units(hu('total_defects', 'total_units_produced', 6), 6, 10)} END AS DOUBLE) AS defect_rate
FROM production_summary WHERE week_start = (SELECT max(week_start) FROM production_summary)""")
q("week_over_week", f"""SELECT week_start AS latest_week, {u8('w8')} AS latest_oee, {u8('p8')} AS prior_oee, {u8('w8 - p8')} AS delta,
 CASE WHEN w8 - p8 >= 0 THEN 'up' ELSE 'down' END AS direction,
 (SELECT CAST(count_if(avg_oee < 0.85) AS BIGINT) FROM production_summary WHERE week_start = (SELECT max(week_start) FROM production_summary)) AS n_below_target
FROM (SELECT week_start, w8, lag(w8) OVER (ORDER BY week_start) AS p8 FROM weekly_fleet)
WHERE week_start = (SELECT max(week_start) FROM production_summary) AND p8 IS NOT NULL""")
q("weekly_downtime", f"SELECT week_start, machine_name, {dbl('total_downtime_hrs')} FROM production_summary")
q("oee_trend_series", f"SELECT machine_name, shift_date, {dbl('oee', 'availability_rate', 'performance_rate', 'quality_rate')} FROM oee_daily")
q("oee_trend_selected", f"""SELECT machine_name, shift_date, {dbl('oee')} FROM oee_daily
WHERE machine_name IN (SELECT machine_name FROM (SELECT DISTINCT machine_name FROM oee_daily) ORDER BY machine_name LIMIT 4)""")
q("anomaly_pivot", """SELECT machine_name, count(*) AS n_days, CAST(count_if(a = 1) AS BIGINT) AS n_anomaly_days,
 string_agg(CAST(reading_date AS VARCHAR) || '=' || coalesce(CAST(a AS VARCHAR), ''), ' ' ORDER BY reading_date) AS days
FROM (SELECT machine_name, reading_date, max(CAST(anomaly_flag AS INTEGER)) AS a FROM named GROUP BY ALL) GROUP BY machine_name""")
q("latest_readings", f"""SELECT machine_id, ts, {dbl('temperature_c', 'vibration_mm_s', 'power_kw')} FROM stg_sensor
 ORDER BY ts DESC, machine_id LIMIT 10""")
q("latest_downtime", f"""SELECT machine_id, reason_code, started_at, ended_at, CAST(duration_hrs AS DOUBLE) AS downtime_hrs
 FROM stg_downtime ORDER BY started_at DESC, machine_id DESC LIMIT 10""")
q("worst_recent_weeks", f"""SELECT machine_id, week_start, CAST({units(hu(as_int('avg_oee', 4), 10, 0), 1, 10)} AS DOUBLE) AS avg_oee_pct,
 {dbl('total_downtime_hrs')} FROM production_summary
 ORDER BY week_start DESC, avg_oee_pct ASC NULLS LAST, machine_id LIMIT 20""")
q("dq_not_null", "SELECT machine_id, shift_date FROM oee_daily WHERE oee IS NULL")
q("dq_unique", "SELECT defect_id, count(*) AS n FROM stg_defects WHERE defect_id IS NOT NULL GROUP BY defect_id HAVING count(*) > 1")
q("dq_accepted_range", f"""SELECT rec_id, {dbl('estimated_hours_to_failure')} FROM recs_raw
 WHERE NOT (estimated_hours_to_failure >= 1 AND estimated_hours_to_failure <= 720)""")
q("dq_accepted_values", """SELECT response_id, confidence FROM (SELECT response_id,
   CASE WHEN json_valid(response) THEN json_extract_string(response, '$.confidence') END AS confidence FROM responses)
 WHERE confidence NOT IN ('HIGH', 'MEDIUM', 'LOW')""")
q("dq_unique_combo", "SELECT order_id, defect_type, count(*) AS n FROM stg_defects GROUP BY order_id, defect_type HAVING count(*) > 1")
q("dq_oee_bounds", f"""SELECT machine_id, shift_date, {dbl('availability_rate', 'performance_rate', 'quality_rate', 'oee')} FROM oee_daily
 WHERE oee < 0 OR oee > 1 OR availability_rate < 0 OR availability_rate > 1 OR performance_rate < 0 OR performance_rate > 1
    OR quality_rate < 0 OR quality_rate > 1 OR oee IS NULL""")
q("dq_foreign_key", """SELECT 'orders.machine_id' AS check_name, order_id AS key FROM stg_orders o
   WHERE NOT EXISTS (SELECT 1 FROM stg_machines m WHERE m.machine_id = o.machine_id)
 UNION ALL SELECT 'defects.order_id', defect_id FROM stg_defects d
   WHERE NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = d.order_id)
 UNION ALL SELECT 'defects.qty_defective>0', defect_id FROM stg_defects WHERE qty_defective <= 0""")
q("table_counts", """SELECT 'sensor_readings' AS table_name, count(*) AS rows FROM stg_sensor
 UNION ALL SELECT 'downtime_events', count(*) FROM dt_raw
 UNION ALL SELECT 'machines', count(*) FROM stg_machines
 UNION ALL SELECT 'mart_oee_daily', count(*) FROM oee_daily
 UNION ALL SELECT 'mart_machine_health', count(*) FROM machine_health
 UNION ALL SELECT 'mart_production_summary', count(*) FROM production_summary
 UNION ALL SELECT 'failure_patterns', count(*) FROM pattern_store
 UNION ALL SELECT 'maintenance_recommendations', count(*) FROM recs_raw
 UNION ALL SELECT 'mart_maintenance_queue', count(*) FROM maintenance_queue""")
QUERIES["incremental_oee"] = QUERIES["oee_daily"]
QUERIES["incremental_health"] = QUERIES["machine_health"]
QUERIES["overwrite_reload"] = QUERIES["stg_sensor"]


def _dq_report_sql() -> str:
    from plantmetrics.operators.dq import dq_rules
    table_cte = {"oee_daily": "oee_daily", "machine_health": "machine_health",
                 "production_summary": "production_summary", "maintenance_recommendations": "recs_raw",
                 "defects": "stg_defects"}
    parts = []
    for r in dq_rules():
        t = table_cte[r.name]
        for c in r.not_null:
            parts.append(f"SELECT '{r.name}' AS table_name, 'not_null({c})' AS rule, CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM {t}")
        for c, (lo, hi) in r.ranges.items():
            parts.append(f"SELECT '{r.name}', 'accepted_range({c},{lo},{hi})', CAST(count_if(NOT ({c} >= {lo} AND {c} <= {hi})) AS BIGINT) FROM {t}")
        for c, vals in r.values.items():
            lst = ", ".join(f"'{v}'" for v in vals)
            parts.append(f"SELECT '{r.name}', 'accepted_values({c})', CAST(count_if({c} NOT IN ({lst})) AS BIGINT) FROM {t}")
        for c in r.unique:
            parts.append(f"SELECT '{r.name}', 'unique({c})', CAST(count(*) AS BIGINT) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        for cols in r.unique_combos:
            cl = ", ".join(cols)
            parts.append(f"SELECT '{r.name}', 'unique_combination({','.join(cols)})', CAST(count(*) AS BIGINT) FROM (SELECT {cl} FROM {t} GROUP BY {cl} HAVING count(*) > 1)")
    return "\nUNION ALL ".join(parts)


try:
    q("dq_report", _dq_report_sql())
except ImportError:  # pragma: no cover - the registry needs pyspark
    pass

q("scan_sensor_readings", f"SELECT machine_id, ts, {dbl('temperature_c', 'vibration_mm_s', 'power_kw')} FROM stg_sensor")
q("scan_machines", "SELECT * FROM stg_machines")
q("sku_format", "SELECT product_sku, count(*) AS orders FROM stg_orders GROUP BY product_sku")
q("clamp_null_safe", """SELECT CAST(count_if(planned_time_hrs > 0 AND downtime_hrs > planned_time_hrs) AS BIGINT) AS availability_clamped_at_0,
 CAST(count_if(availability_rate IS NULL) AS BIGINT) AS availability_null, CAST(count_if(performance_rate IS NULL) AS BIGINT) AS performance_null,
 CAST(count_if(performance_rate = 1) AS BIGINT) AS performance_at_1, CAST(count_if(quality_rate < 0) AS BIGINT) AS quality_negative, count(*) AS rows
FROM oee_daily""")
q("worst_machine", """SELECT machine_name, CAST(h AS DOUBLE) AS downtime_hrs FROM
 (SELECT machine_name, sum(total_downtime_hrs) AS h FROM production_summary GROUP BY machine_name)
 ORDER BY h DESC, machine_name LIMIT 1""")
QUERIES["stream_health"] = QUERIES["machine_health"]
QUERIES["stream_cooldown"] = QUERIES["cooldown_events"]
QUERIES["maintenance_queue_strict"] = (QUERIES["maintenance_queue"]
                                       .replace("* 1.15 THEN TRUE", "* 1.8 THEN TRUE")
                                       .replace("* 1.50 THEN TRUE", "* 2.2 THEN TRUE"))
