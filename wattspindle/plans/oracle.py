"""The same queries as plain SQL over the star-schema tables, for checking.

``_select`` builds the outer select: ``@name`` rounds, ``#name`` renders a date.
``half_up`` marks commercial rounding; it expands to a decimal cast and round.
"""

from __future__ import annotations

from wattspindle.constants import FALLBACK_PRICE, FALLBACK_SOURCE

ORACLE_SQL: dict[str, str] = {}

# Common table expressions, in dependency order --------------------------------

_CTES = {
    "telemetry": """
        SELECT ts AS timestamp, 'M0' || (user_id % 4 + 1) AS machine_id, event_type AS operation,
               value AS rms_x, value * 0.5 AS rms_y, value * 0.25 AS rms_z,
               CAST(value > 150 AS INTEGER) AS label,
               'M0' || (user_id % 4 + 1) || '_' || event_type || '_'
                   || lpad(CAST(event_id AS VARCHAR), 12, '0') AS filename,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS sample_count, event_id
        FROM events""",
    "bronze": """
        SELECT time_bucket(INTERVAL '15 minutes', timestamp) AS timestamp_15min, machine_id, operation,
               avg(rms_x) AS avg_rms_x, avg(rms_y) AS avg_rms_y, avg(rms_z) AS avg_rms_z,
               max(label) AS has_anomaly, CAST(sum(sample_count) AS BIGINT) AS total_samples,
               min(filename) AS sample_file
        FROM telemetry GROUP BY 1, 2, 3""",
    "quotes": """
        SELECT ts AS timestamp, value AS price_eur_mwh,
               CASE WHEN event_type IN ('purchase', 'view') THEN 'DE' WHEN event_type = 'click' THEN 'FR'
                    ELSE 'IT' END AS country_code,
               CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 0 THEN 'MOCK'
                    ELSE 'EXCHANGE' END AS source
        FROM events""",
    "hours": """
        SELECT date_trunc('hour', timestamp) AS timestamp, country_code,
               coalesce(avg(price_eur_mwh) FILTER (WHERE source <> 'MOCK'), avg(price_eur_mwh)) AS price_eur_mwh,
               min(source) AS source
        FROM quotes GROUP BY 1, 2""",
    "hourly": "SELECT * FROM hours WHERE country_code = 'DE'",
    "index_months": """
        SELECT date_trunc('month', o_orderdate) AS month, avg(o_totalprice) AS idx
        FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1""",
    "priced": """
        SELECT b.*, h.price_eur_mwh AS matched_price
        FROM bronze b LEFT JOIN hourly h ON b.timestamp_15min = h.timestamp""",
    "mean_priced": """
        SELECT *, coalesce(matched_price, (SELECT avg(matched_price) FROM priced)) AS price_eur_mwh
        FROM priced""",
    "slots": """
        SELECT country_code, unnest(generate_series(min(timestamp), max(timestamp) + INTERVAL '45 minutes',
               INTERVAL '15 minutes')) AS timestamp FROM hours GROUP BY 1""",
    "spine": """
        SELECT country_code, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL '1 hour')) AS timestamp
        FROM hours GROUP BY 1""",
    "ffill": """
        SELECT s.timestamp, s.country_code, h.price_eur_mwh
        FROM slots s ASOF LEFT JOIN hours h
          ON s.country_code = h.country_code AND s.timestamp >= h.timestamp""",
    "silver": """
        SELECT m.timestamp_15min, machine_id, operation, avg_rms_x AS vibration_rms_x,
               avg_rms_y AS vibration_rms_y, avg_rms_z AS vibration_rms_z,
               has_anomaly = 1 AS has_anomaly, price_eur_mwh AS energy_price_eur_mwh,
               i.idx AS industrial_production_index,
               (avg_rms_x + avg_rms_y + avg_rms_z) / 6 AS estimated_power_kwh,
               (avg_rms_x + avg_rms_y + avg_rms_z) / 6 * price_eur_mwh / 1000 AS energy_cost_eur,
               CAST(has_anomaly AS DOUBLE) AS anomaly_risk_score
        FROM mean_priced m LEFT JOIN index_months i
          ON date_trunc('month', m.timestamp_15min) = i.month + INTERVAL '28 years'""",
    "daily": """
        SELECT *, half_up(100.0::DOUBLE * anomaly_count / total_measurements, 2) AS anomaly_rate_pct,
               half_up(sqrt(avg_vibration_x ** 2 + avg_vibration_y ** 2 + avg_vibration_z ** 2), 3)
                   AS vibration_magnitude
        FROM (SELECT CAST(timestamp_15min AS DATE) AS measurement_date, machine_id, operation,
                     count(*) AS total_measurements,
                     count(*) FILTER (WHERE has_anomaly) AS anomaly_count,
                     avg(vibration_rms_x) AS avg_vibration_x, avg(vibration_rms_y) AS avg_vibration_y,
                     avg(vibration_rms_z) AS avg_vibration_z, max(vibration_rms_x) AS max_vibration_x,
                     max(vibration_rms_y) AS max_vibration_y, max(vibration_rms_z) AS max_vibration_z,
                     avg(energy_price_eur_mwh) AS avg_energy_price,
                     min(energy_price_eur_mwh) AS min_energy_price,
                     max(energy_price_eur_mwh) AS max_energy_price,
                     sum(energy_cost_eur) AS daily_energy_cost,
                     avg(estimated_power_kwh) AS avg_power_consumption,
                     avg(industrial_production_index) AS avg_industrial_index,
                     avg(anomaly_risk_score) AS avg_anomaly_risk
              FROM silver GROUP BY 1, 2, 3)""",
    "cuts": """
        SELECT quantile_cont(vibration_magnitude, 0.5) AS p50,
               quantile_cont(vibration_magnitude, 0.75) AS p75 FROM daily""",
    "facts": """
        SELECT daily.*,
               CASE WHEN anomaly_rate_pct > 20 THEN 'CRITICAL' WHEN anomaly_rate_pct > 10 THEN 'HIGH_RISK'
                    WHEN anomaly_rate_pct > 5 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS machine_health_status,
               CASE WHEN vibration_magnitude >= p75 THEN 'UNSTABLE'
                    WHEN vibration_magnitude >= p50 THEN 'MODERATE' ELSE 'STABLE' END AS vibration_stability,
               half_up(daily_energy_cost / nullif(avg_power_consumption / 1000, 0), 2) AS cost_per_kwh
        FROM daily, cuts""",
    "summary": """
        SELECT *, CASE WHEN overall_anomaly_rate >= 40 THEN 'CRITICAL'
                       WHEN overall_anomaly_rate >= 25 THEN 'HIGH_RISK'
                       WHEN overall_anomaly_rate >= 10 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_level
        FROM (SELECT machine_id, operation, min(measurement_date) AS first_measurement,
                     max(measurement_date) AS last_measurement,
                     count(DISTINCT measurement_date) AS days_with_data,
                     CAST(sum(total_measurements) AS BIGINT) AS total_measurements,
                     CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies,
                     half_up(100.0::DOUBLE * sum(anomaly_count) / sum(total_measurements), 2) AS overall_anomaly_rate,
                     avg(avg_vibration_x) AS overall_avg_vibration_x,
                     avg(avg_vibration_y) AS overall_avg_vibration_y,
                     avg(avg_vibration_z) AS overall_avg_vibration_z,
                     max(max_vibration_x) AS peak_vibration_x, max(max_vibration_y) AS peak_vibration_y,
                     max(max_vibration_z) AS peak_vibration_z,
                     avg(vibration_magnitude) AS avg_vibration_magnitude,
                     avg(avg_energy_price) AS avg_energy_price_overall,
                     sum(daily_energy_cost) AS total_energy_cost,
                     avg(avg_power_consumption) AS avg_power_consumption_overall,
                     avg(avg_industrial_index) AS avg_industrial_index_overall
              FROM facts GROUP BY 1, 2)""",
    "inventory": """
        SELECT machine_id, operation, count(*) AS total_files, CAST(sum(label) AS BIGINT) AS anomalies,
               count(*) - CAST(sum(label) AS BIGINT) AS normal,
               CAST(sum(sample_count) AS BIGINT) AS total_samples
        FROM telemetry GROUP BY 1, 2""",
    "signals": """
        SELECT CAST(vec_id AS VARCHAR) AS run_id, 'M0' || (vec_id % 3 + 1) AS machine_id,
               'OP' || lpad(CAST(label AS VARCHAR), 2, '0') AS operation,
               TIMESTAMP '2020-01-01' + to_months(CAST(vec_id % 12 AS INTEGER)) AS base_ts,
               CAST(vec_id % 20 = 0 AS INTEGER) AS label, embedding[1:22] AS accel_x,
               embedding[23:43] AS accel_y, embedding[44:64] AS accel_z,
               'M0' || (vec_id % 3 + 1) || '_OP' || lpad(CAST(label AS VARCHAR), 2, '0') || '_' || vec_id
                   AS filename
        FROM embeddings""",
    "able": """
        SELECT operation,
               'M0' || (least(CAST(run_id AS BIGINT) % 4, CAST(substr(operation, 3) AS BIGINT) % 4) + 1) AS machine_id
        FROM signals""",
    "blocks": """
        SELECT run_id, machine_id, operation, label, filename, CAST(i AS INTEGER) AS chunk_index,
               i = 2 AS is_last_chunk,
               base_ts + to_microseconds(CAST(i * 8 * 500 AS BIGINT)) AS chunk_ts,
               CAST(len(accel_x[i * 8 + 1 : i * 8 + 8]) AS INTEGER) AS sample_count,
               accel_x[i * 8 + 1 : i * 8 + 8] AS x, accel_y[i * 8 + 1 : i * 8 + 8] AS y,
               accel_z[i * 8 + 1 : i * 8 + 8] AS z
        FROM signals, (SELECT unnest(range(3)) AS i)""",
    "block_features": """
        SELECT run_id, machine_id, operation, label, filename, chunk_index, is_last_chunk, chunk_ts,
               sample_count, {rms_x} AS rms_x, {rms_y} AS rms_y, {rms_z} AS rms_z,
               time_bucket(INTERVAL '15 minutes', chunk_ts) AS timestamp_15min
        FROM blocks""",
    "run_paths": """
        SELECT event_id, form, 'M0' || (user_id % 4 + 1) AS machine,
               strftime(ts, '%b') AS mon, strftime(ts, '%Y') AS yr, date_trunc('month', ts) AS first_day,
               'OP' || lpad(CAST(user_id % 15 AS VARCHAR), 2, '0') AS op,
               lpad(CAST(event_id AS VARCHAR), 9, '0') AS run, value > 150 AS is_bad
        FROM (SELECT *, event_id % 4 AS form FROM events)""",
    "messages": """
        SELECT *, 'run_' || event_id AS filename, 'M0' || (user_id % 4 + 1) AS machine,
               event_id % 17 = 0 AS cut, event_id % 10 <> 0 OR event_id % 20 = 0 AS has_body,
               CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS sent,
               CASE WHEN event_id % 11 <> 0 THEN CAST(value > 150 AS INTEGER) END AS label
        FROM events""",
    "bodies": "SELECT * FROM messages WHERE NOT cut AND has_body",
}


def _rms(column: str) -> str:
    squares = f"list_transform({column}, lambda v: v::DOUBLE * v::DOUBLE)"
    return f"sqrt(list_sum({squares}) / len({column}))"


_CTES["block_features"] = _CTES["block_features"].format(**{f"rms_{a}": _rms(a) for a in "xyz"})


def _needed(body: str) -> list[str]:
    """Names of the expressions that ``body`` uses, directly or through others."""
    wanted: set[str] = set()
    text = [body]
    while text:
        words = set(text.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in words & _CTES.keys() - wanted:
            wanted.add(name)
            text.append(_CTES[name])
    return [name for name in _CTES if name in wanted]


def _with(body: str) -> str:
    names = _needed(body)
    if not names:
        return body
    return "WITH " + ", ".join(f"{n} AS ({_CTES[n]})" for n in names) + "\n" + body


def _select(columns: str, source: str, digits: int = 6) -> str:
    def item(column: str) -> str:
        if column[0] == "@":
            return f"half_up({column[1:]}, {digits}) AS {column[1:]}"
        if column[0] == "#":
            return f"strftime({column[1:]}, '%Y-%m-%d') AS {column[1:]}"
        return column

    return f"SELECT {', '.join(item(c) for c in columns.split())} FROM {source}"


def _expand_rounding(sql: str) -> str:
    """``half_up(x, n)`` to SQL, innermost call first."""
    call = "half_up("
    while (start := sql.rfind(call)) >= 0:
        depth, end = 1, start + len(call)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        value, digits = sql[start + len(call) : end - 1].rsplit(",", 1)
        rounded = f"CAST(round(CAST({value} AS DECIMAL(38, 10)), {digits.strip()}) AS DOUBLE)"
        sql = sql[:start] + rounded + sql[end:]
    return sql


def _add(name: str, body: str) -> None:
    ORACLE_SQL[name] = _expand_rounding(_with(body))


_KEY = "timestamp_15min machine_id operation"
_DAY = "#measurement_date machine_id operation"
_DAILY_COLUMNS = (
    f"{_DAY} total_measurements anomaly_count @anomaly_rate_pct @avg_vibration_x @avg_vibration_y "
    "@avg_vibration_z @max_vibration_x @max_vibration_y @max_vibration_z @vibration_magnitude "
    "@avg_energy_price @min_energy_price @max_energy_price @daily_energy_cost "
    "@avg_power_consumption @avg_industrial_index @avg_anomaly_risk"
)
_SILVER_COLUMNS = (
    f"{_KEY} @vibration_rms_x @vibration_rms_y @vibration_rms_z has_anomaly @energy_price_eur_mwh "
    "@industrial_production_index @estimated_power_kwh @energy_cost_eur @anomaly_risk_score"
)
_REPORT_COLUMNS = (
    "machine_id operation days_with_data total_measurements total_anomalies @overall_anomaly_rate "
    "@overall_avg_vibration_x @overall_avg_vibration_y @overall_avg_vibration_z @peak_vibration_x "
    "@peak_vibration_y @peak_vibration_z @avg_vibration_magnitude @avg_energy_price_overall "
    "@total_energy_cost @avg_power_consumption_overall @avg_industrial_index_overall risk_level"
)
_WINDOW_COLUMNS = (
    "window_start window_end machine_id operation @avg_rms_x @avg_rms_y @avg_rms_z max_rms_x "
    "max_rms_y max_rms_z has_anomaly n_records"
)


def _windows(source: str, start: str = "time_bucket(INTERVAL '15 minutes', timestamp)") -> str:
    return f"""
        (SELECT {start} AS window_start, {start} + INTERVAL '15 minutes' AS window_end, machine_id,
                operation, avg(rms_x) AS avg_rms_x, avg(rms_y) AS avg_rms_y, avg(rms_z) AS avg_rms_z,
                max(rms_x) AS max_rms_x, max(rms_y) AS max_rms_y, max(rms_z) AS max_rms_z,
                max(label) AS has_anomaly, count(*) AS n_records
         FROM {source} GROUP BY 1, 2, 3, 4)"""


# Windows and prices -----------------------------------------------------------

_add("telemetry_window_15min", _select(_WINDOW_COLUMNS, _windows("telemetry")))
_add(
    "telemetry_window_rollup",
    _select(f"{_KEY} @avg_rms_x @avg_rms_y @avg_rms_z has_anomaly total_samples sample_file", "bronze"),
)
_add(
    "price_hourly_resample",
    "SELECT timestamp, half_up(price_eur_mwh, 4) AS price_eur_mwh, source, country_code FROM hours",
)
_add(
    "price_first_per_window",
    """SELECT time_bucket(INTERVAL '15 minutes', timestamp) AS timestamp,
              time_bucket(INTERVAL '15 minutes', timestamp) + INTERVAL '15 minutes' AS window_end,
              arg_min(half_up(price_eur_mwh, 2), timestamp) AS price_eur_mwh, country_code,
              arg_min(source, timestamp) AS source
       FROM quotes GROUP BY 1, 2, country_code""",
)
_add(
    "price_spine_fallback",
    f"""SELECT s.timestamp, s.country_code,
               half_up(coalesce(h.price_eur_mwh, {FALLBACK_PRICE}), 4) AS price_eur_mwh,
               coalesce(h.source, '{FALLBACK_SOURCE}') AS source
        FROM spine s LEFT JOIN hours h ON s.timestamp = h.timestamp AND s.country_code = h.country_code""",
)
_add(
    "price_spine_gaps",
    """SELECT s.timestamp, s.country_code, half_up(h.price_eur_mwh, 4) AS price_eur_mwh, h.source
       FROM spine s LEFT JOIN hours h ON s.timestamp = h.timestamp AND s.country_code = h.country_code""",
)
_add(
    "price_forward_fill_15min",
    "SELECT timestamp, country_code, half_up(price_eur_mwh, 4) AS price_eur_mwh FROM ffill",
)
_add(
    "price_bucket_distinct",
    """SELECT DISTINCT time_bucket(INTERVAL '15 minutes', timestamp) AS timestamp_15min,
              price_eur_mwh FROM quotes""",
)
_add(
    "price_batches_union",
    """SELECT ts AS timestamp, value AS price_eur_mwh, upper(event_type) AS source, 'DE' AS country_code
       FROM events""",
)
_add(
    "price_describe",
    """SELECT count(*) AS n, half_up(avg(price_eur_mwh), 4) AS mean, half_up(stddev_samp(price_eur_mwh), 4) AS std,
              half_up(min(price_eur_mwh), 4) AS min, half_up(max(price_eur_mwh), 4) AS max,
              half_up(quantile_cont(price_eur_mwh, 0.25), 4) AS p25,
              half_up(quantile_cont(price_eur_mwh, 0.5), 4) AS p50,
              half_up(quantile_cont(price_eur_mwh, 0.75), 4) AS p75
       FROM hours""",
)

# Harmonised facts and marts ---------------------------------------------------

_add("harmonize_mean_fill", _select(f"{_KEY} @avg_rms_x @price_eur_mwh", "mean_priced"))
_add(
    "harmonize_ffill",
    _select(
        f"{_KEY} @avg_rms_x @price_eur_mwh",
        "(SELECT b.*, h.price_eur_mwh FROM bronze b ASOF LEFT JOIN hourly h ON b.timestamp_15min >= h.timestamp)",
    ),
)
_add(
    "harmonize_windows",
    _select(
        f"{_WINDOW_COLUMNS} @price_eur_mwh",
        f"{_windows('telemetry')} w ASOF LEFT JOIN hourly h ON w.window_start >= h.timestamp",
    ),
)
_add(
    "monthly_index_join",
    """SELECT l_shipdate AS timestamp_15min, 'M0' || (l_suppkey % 3 + 1) AS machine_id,
              l_returnflag || l_linestatus AS operation, l_quantity AS avg_rms_x,
              l_discount * 100 AS avg_rms_y, l_tax * 100 AS avg_rms_z,
              CAST(l_quantity > 45 AS INTEGER) AS has_anomaly,
              half_up(i.idx, 2) AS industrial_production_index
       FROM lineitem LEFT JOIN index_months i ON date_trunc('month', l_shipdate) = i.month""",
)
_add("silver_enriched", _select(_SILVER_COLUMNS, "silver", 4))
_add(
    "stage_range_filter",
    _select(_SILVER_COLUMNS, "silver", 4)
    + " WHERE timestamp_15min BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'",
)
_add("machine_daily_metrics", _select(_DAILY_COLUMNS, "daily", 4))
_add(
    "machine_daily_fact",
    _select(f"{_DAILY_COLUMNS} machine_health_status vibration_stability @cost_per_kwh", "facts", 4),
)
_add(
    "machine_summary",
    _select(f"{_REPORT_COLUMNS} #first_measurement #last_measurement", "summary", 4),
)

# Reports ----------------------------------------------------------------------

_add("summary_report", _select(_REPORT_COLUMNS, "summary", 4))
_add(
    "daily_drilldown",
    _select(
        f"{_DAY} total_measurements anomaly_count @anomaly_rate_pct @avg_vibration_x @avg_vibration_y "
        "@avg_vibration_z @max_vibration_x @max_vibration_y @max_vibration_z @vibration_magnitude "
        "@avg_energy_price @daily_energy_cost @avg_power_consumption @avg_industrial_index "
        "machine_health_status vibration_stability @cost_per_kwh",
        "facts",
        4,
    )
    + " WHERE machine_id = 'M01' AND operation = 'click'",
)
_add(
    "daily_table",
    _select(
        f"{_DAY} @anomaly_rate_pct @vibration_magnitude @daily_energy_cost @avg_power_consumption "
        "machine_health_status",
        "facts",
        2,
    ),
)
_add(
    "daily_trend",
    _select(
        f"{_DAY} @anomaly_rate_pct @vibration_magnitude @rate_change @trailing_magnitude",
        """(SELECT *, anomaly_rate_pct - lag(anomaly_rate_pct) OVER w AS rate_change,
                   avg(vibration_magnitude) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
                       AS trailing_magnitude
            FROM daily WINDOW w AS (PARTITION BY machine_id, operation ORDER BY measurement_date))""",
        4,
    ),
)
_add(
    "health_distribution",
    """SELECT machine_id, operation, machine_health_status, count(*) AS days,
              half_up(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY machine_id, operation), 2)
                  AS share_pct
       FROM facts GROUP BY 1, 2, 3""",
)
_add(
    "stability_mode",
    """SELECT machine_id, operation, vibration_stability AS dominant_stability,
              half_up(100.0::DOUBLE * n / total, 2) AS share_pct
       FROM (SELECT *, sum(n) OVER (PARTITION BY machine_id, operation) AS total,
                    row_number() OVER (PARTITION BY machine_id, operation
                                       ORDER BY n DESC, vibration_stability) AS place
             FROM (SELECT machine_id, operation, vibration_stability, count(*) AS n
                   FROM facts GROUP BY 1, 2, 3))
       WHERE place = 1""",
)
_add(
    "fleet_kpis",
    """SELECT count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_count,
              count(*) FILTER (WHERE risk_level = 'HIGH_RISK') AS high_risk_count,
              half_up(avg(overall_anomaly_rate), 4) AS avg_anomaly_rate,
              half_up(avg(avg_vibration_magnitude), 4) AS avg_vibration,
              half_up(sum(total_energy_cost), 4) AS total_cost
       FROM summary""",
)
_add(
    "machine_kpis",
    _select(
        "machine_id operation days_with_data total_anomalies total_measurements @overall_anomaly_rate "
        "@avg_vibration_magnitude @total_energy_cost @avg_power_consumption_overall "
        "@avg_industrial_index_overall @cost_per_kwh",
        """(SELECT *, total_energy_cost / nullif(avg_power_consumption_overall * days_with_data, 0)
                AS cost_per_kwh FROM summary)""",
        4,
    ),
)
_add(
    "risk_recommendations",
    """SELECT machine_id, operation, risk_level, action_code, within_days
       FROM summary LEFT JOIN (VALUES ('CRITICAL', 'A1', 1), ('HIGH_RISK', 'A2', 10), ('MEDIUM_RISK', 'A3', 45),
                                      ('LOW_RISK', 'A4', NULL)) a(risk_level, action_code, within_days)
         USING (risk_level)""",
)
_add(
    "daily_vs_average",
    _select(
        f"{_DAY} @anomaly_rate_pct @overall_anomaly_rate @rate_deviation @vibration_magnitude "
        "@avg_vibration_magnitude @magnitude_deviation",
        """(SELECT facts.measurement_date, machine_id, operation, anomaly_rate_pct, overall_anomaly_rate,
                   anomaly_rate_pct - overall_anomaly_rate AS rate_deviation, vibration_magnitude,
                   avg_vibration_magnitude,
                   vibration_magnitude - avg_vibration_magnitude AS magnitude_deviation
            FROM facts JOIN summary USING (machine_id, operation))""",
        4,
    ),
)
_add(
    "cost_vibration_scatter",
    _select(
        f"{_DAY} @vibration_magnitude @daily_energy_cost @anomaly_rate_pct @avg_power_consumption "
        "machine_health_status vibration_stability",
        "facts",
        4,
    ),
)
_add(
    "cost_vibration_corr",
    """SELECT machine_id, operation,
              CASE WHEN stddev_pop(vibration_magnitude) * stddev_pop(daily_energy_cost) > 0
                   THEN half_up(corr(vibration_magnitude, daily_energy_cost), 6) END AS magnitude_cost_corr,
              CASE WHEN stddev_pop(anomaly_rate_pct) * stddev_pop(daily_energy_cost) > 0
                   THEN half_up(corr(anomaly_rate_pct, daily_energy_cost), 6) END AS rate_cost_corr
       FROM facts GROUP BY 1, 2""",
)
_add("selector_machines", "SELECT DISTINCT machine_id FROM summary")
_add("selector_operations", "SELECT DISTINCT operation FROM summary WHERE machine_id = 'M02'")
_add("dataset_inventory", "SELECT * FROM inventory")
_add(
    "inventory_pivot",
    """SELECT operation,
              CAST(coalesce(sum(total_files) FILTER (WHERE machine_id = 'M01'), 0) AS BIGINT) AS "M01",
              CAST(coalesce(sum(total_files) FILTER (WHERE machine_id = 'M02'), 0) AS BIGINT) AS "M02",
              CAST(coalesce(sum(total_files) FILTER (WHERE machine_id = 'M03'), 0) AS BIGINT) AS "M03",
              CAST(coalesce(sum(total_files) FILTER (WHERE machine_id = 'M04'), 0) AS BIGINT) AS "M04"
       FROM inventory GROUP BY 1""",
)
_add(
    "inventory_totals",
    """SELECT CAST(sum(total_files) AS BIGINT) AS total_files, CAST(sum(anomalies) AS BIGINT) AS anomalies,
              CAST(sum(total_samples) AS BIGINT) AS total_samples
       FROM inventory""",
)
_add(
    "coverage_matrix",
    """SELECT m.machine_id, o.operation, coalesce(n, 0) AS total_files, n IS NOT NULL AS has_data
       FROM (SELECT DISTINCT machine_id FROM able) m
       CROSS JOIN (SELECT DISTINCT operation FROM able) o
       LEFT JOIN (SELECT machine_id, operation, count(*) AS n FROM able GROUP BY 1, 2) c
         ON m.machine_id = c.machine_id AND o.operation = c.operation""",
)

# Data quality -----------------------------------------------------------------

_NULL_SOURCES = {
    "timestamp_15min": "timestamp_15min",
    "machine_id": "machine_id",
    "operation": "operation",
    "vibration_rms_x": "vibration_rms_x",
    "energy_price_eur_mwh": "matched_price",
    "industrial_production_index": "industrial_production_index",
}
_add(
    "quality_nulls",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count(*) - count({source}) AS null_count,
                   half_up(100.0::DOUBLE * (count(*) - count({source})) / count(*), 2) AS null_pct,
                   CASE WHEN count(*) = count({source}) THEN 'PASS' ELSE 'FAIL' END AS status
            FROM (SELECT s.*, p.matched_price
                  FROM silver s JOIN priced p USING (timestamp_15min, machine_id, operation))"""
        for name, source in _NULL_SOURCES.items()
    ),
)
_add(
    "quality_coverage",
    """SELECT count(*) AS total_records, count(*) - count(matched_price) AS missing_records,
              half_up(100.0::DOUBLE * (count(*) - count(matched_price)) / count(*), 2) AS missing_pct
       FROM priced""",
)
_add(
    "quality_range",
    """SELECT min(ts) AS min_ts, max(ts) AS max_ts,
              count(*) FILTER (WHERE year(ts) = 1970) AS epoch_rows,
              CASE WHEN count(*) FILTER (WHERE year(ts) = 1970) = 0 THEN 'PASS' ELSE 'FAIL' END AS epoch_status,
              CASE WHEN year(min(ts)) BETWEEN 2019 AND 2021 THEN 'PASS' ELSE 'FAIL' END AS range_status
       FROM events""",
)
_add(
    "run_summary",
    """SELECT count(*) AS total_records, count(DISTINCT machine_id) AS machines,
              count(DISTINCT operation) AS operations, min(timestamp_15min) AS min_ts,
              max(timestamp_15min) AS max_ts
       FROM bronze""",
)
# The columns of the test tables.
_VALIDATED = {
    "benchmark": "item_id text",
    "conversations": "conv_id turn role text",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "events": "event_id ts user_id event_type value props",
    "labels": "doc_id quality toxic",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
    "l_tax l_returnflag l_linestatus l_shipdate",
    "nation": "n_nationkey n_name n_regionkey",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "pages": "page_id url html",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "region": "r_regionkey r_name",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
}
_add(
    "layer_validation",
    " UNION ALL ".join(
        [
            f"""SELECT '{table}' AS dataset, count(*) AS records, {len(columns.split())} AS column_count,
                       {' + '.join(f'count(*) - count({c})' for c in columns.split())} AS null_values,
                       CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'WARN' END AS status FROM {table}"""
            for table, columns in _VALIDATED.items()
        ]
        + ["SELECT 'absent', 0, 0, 0, 'FAIL'"]
    ),
)
_add(
    "dataset_presence",
    " UNION ALL ".join(
        [
            f"SELECT '{t}' AS dataset, count(*) AS n_rows, TRUE AS present, TRUE AS has_bytes FROM {t}"
            for t in _VALIDATED
        ]
        + ["SELECT 'absent', 0, FALSE, FALSE"]
    ),
)
_add(
    "file_listing",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, count(*) AS n_rows FROM {t}" for t in sorted(_VALIDATED)[:5]
    ),
)
_add(
    "stage_rows",
    """SELECT 'telemetry' AS stage, count(*) AS n_rows FROM telemetry
       UNION ALL SELECT 'quotes', count(*) FROM quotes
       UNION ALL SELECT 'prices', count(*) FROM hours
       UNION ALL SELECT 'index', count(DISTINCT (o_custkey % 3, date_trunc('month', o_orderdate))) FROM orders
       UNION ALL SELECT 'silver', count(*) FROM bronze
       UNION ALL SELECT 'daily', count(*) FROM daily""",
)
_add("staged_load_time", "SELECT count(*) AS n_rows, count(*) AS n_stamped FROM bronze")
_add("mart_table", _select(f"{_REPORT_COLUMNS} #first_measurement #last_measurement", "summary", 4))

# Signals, names, messages, documents ------------------------------------------

_add(
    "signal_chunk_rms",
    _select(
        "run_id machine_id operation label filename chunk_index is_last_chunk chunk_ts sample_count "
        "@rms_x @rms_y @rms_z timestamp_15min",
        "block_features",
    ),
)
_add(
    "signal_window_rollup",
    """SELECT timestamp_15min, machine_id, operation, half_up(avg(rms_x), 6) AS avg_rms_x,
              half_up(avg(rms_y), 6) AS avg_rms_y, half_up(avg(rms_z), 6) AS avg_rms_z,
              max(label) AS has_anomaly, CAST(sum(sample_count) AS BIGINT) AS total_samples,
              min(filename) AS sample_file
       FROM block_features GROUP BY 1, 2, 3""",
)


def _deviation(column: str) -> str:
    doubled = f"list_transform({column}, lambda v: v::DOUBLE)"
    return f"list_stddev_pop({doubled})"


_add(
    "signal_features",
    "SELECT run_id, machine_id, operation, label, filename, "
    + ", ".join(f"half_up({_rms(f'accel_{a}')}, 6) AS rms_{a}" for a in "xyz")
    + ", "
    + ", ".join(f"half_up({_deviation(f'accel_{a}')}, 6) AS std_{a}" for a in "xyz")
    + ", half_up(greatest("
    + ", ".join(f"list_max(list_transform(accel_{a}, lambda v: abs(v::DOUBLE)))" for a in "xyz")
    + "), 6) AS peak_accel, CAST(len(accel_x) AS INTEGER) AS n_samples FROM signals",
)
_add(
    "signal_samples",
    """SELECT run_id, machine_id, operation, label, CAST(i AS INTEGER) AS sample_index,
              base_ts + to_microseconds(CAST(i * 500 AS BIGINT)) AS timestamp,
              accel_x[i + 1]::DOUBLE AS accel_x, accel_y[i + 1]::DOUBLE AS accel_y,
              accel_z[i + 1]::DOUBLE AS accel_z
       FROM signals, (SELECT unnest(range(22)) AS i)""",
)
_add(
    "signal_head",
    """SELECT run_id, CAST(len(accel_x) AS INTEGER) AS n_samples, accel_x[1]::DOUBLE AS head_0,
              accel_x[2]::DOUBLE AS head_1, accel_x[3]::DOUBLE AS head_2
       FROM signals""",
)
_add(
    "chunk_ordinals",
    """SELECT conv_id AS run_id, turn AS chunk_index, count(*) OVER w AS n_chunks,
              turn = max(turn) OVER w AS is_last_chunk
       FROM conversations WINDOW w AS (PARTITION BY conv_id)""",
)
_add(
    "filename_parse",
    """SELECT event_id, CASE WHEN form < 3 THEN machine END AS machine_id,
              CASE WHEN form < 3 THEN mon END AS month_name, CASE WHEN form < 3 THEN yr END AS year,
              CASE WHEN form < 3 THEN op END AS operation,
              CASE WHEN form IN (0, 2) THEN run END AS run_id,
              CASE WHEN form < 3 THEN strftime(first_day, '%Y-%m-%d') END AS base_date,
              CAST(is_bad AS INTEGER) AS label
       FROM run_paths""",
)
_add(
    "message_parse",
    """SELECT sent AS timestamp, filename, event_type AS operation, CAST(user_id AS VARCHAR) AS run_id,
              3 AS n_samples
       FROM bodies""",
)
_add(
    "message_describe",
    """SELECT filename, CASE WHEN event_id % 7 = 0 THEN 'N/A' ELSE CAST(event_id % 5 AS VARCHAR) END AS chunk,
              CASE WHEN event_id % 13 = 0 THEN 'Unknown' ELSE machine END AS machine_id,
              coalesce(label, 0) AS label,
              CASE WHEN label = 1 THEN 'Anomaly' ELSE 'Normal' END AS label_name, 3 AS n_samples,
              half_up(value::FLOAT::DOUBLE, 6) AS head_0
       FROM bodies""",
)
_add(
    "message_counts",
    "SELECT count(*) AS seen, count(*) FILTER (WHERE NOT cut AND has_body) AS processed FROM messages",
)
_READINGS = """
    (SELECT *, event_id % 23 = 0 AS bad_time, event_id % 23 <> 0 AND event_id % 41 = 0 AS no_time,
            event_id % 13 = 0 AS no_machine, event_id % 29 = 0 AS bad_value, event_id % 31 = 0 AS bad_label,
            CASE WHEN event_id % 7 <> 0 THEN 0 END AS given_label
     FROM events)"""
_add(
    "ingest_rejects",
    f"""SELECT column_name, reason, count(*) AS n_rows,
               CAST(sum(given_label) FILTER (WHERE reason = 'accepted') AS BIGINT) AS labels
        FROM (SELECT given_label, unnest([
                  CASE WHEN bad_time THEN {{'column_name': 'timestamp', 'reason': 'unparsable'}} END,
                  CASE WHEN no_time THEN {{'column_name': 'timestamp', 'reason': 'missing'}} END,
                  CASE WHEN no_machine THEN {{'column_name': 'machine_id', 'reason': 'missing'}} END,
                  CASE WHEN bad_value THEN {{'column_name': 'rms_x', 'reason': 'unparsable'}} END,
                  CASE WHEN bad_label THEN {{'column_name': 'label', 'reason': 'unparsable'}} END,
                  CASE WHEN NOT (bad_time OR no_time OR no_machine OR bad_value OR bad_label)
                       THEN {{'column_name': '', 'reason': 'accepted'}} END], recursive := true)
              FROM {_READINGS})
        WHERE reason IS NOT NULL GROUP BY ALL""",
)
_add(
    "ingest_accepted",
    f"""SELECT ts AS timestamp, 'M0' || (user_id % 4 + 1) AS machine_id, event_type AS operation, value AS rms_x,
               given_label AS label
        FROM {_READINGS} WHERE NOT (bad_time OR no_time OR no_machine OR bad_value OR bad_label)""",
)
_add(
    "message_drift",
    """SELECT place, field, kind, count(*) AS n_messages
       FROM (SELECT unnest([
                 CASE WHEN event_id % 4 = 0 THEN {'place': 'message', 'field': 'site', 'kind': 'STRING'} END,
                 CASE WHEN event_id % 4 = 1 THEN {'place': 'message', 'field': 'replay', 'kind': 'BOOLEAN'} END,
                 CASE WHEN event_id % 3 = 0 THEN {'place': body, 'field': 'shift', 'kind': 'BIGINT'} END,
                 CASE WHEN event_id % 5 = 0 THEN {'place': body, 'field': 'spindle', 'kind': 'OBJECT'} END],
                 recursive := true)
             FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'payload' ELSE 'data' END AS body
                   FROM events WHERE event_id % 19 <> 0))
       WHERE place IS NOT NULL GROUP BY ALL""",
)
_add(
    "message_first",
    """SELECT filename, CASE WHEN label = 1 THEN 'Anomaly' ELSE 'Normal' END AS label_name
       FROM bodies ORDER BY filename LIMIT 5""",
)
_add(
    "message_encode",
    """SELECT chunk_ts AS timestamp, filename, chunk_index, is_last_chunk, machine_id, label,
              sample_count AS n_samples
       FROM blocks""",
)
_add(
    "price_xml_parse",
    "SELECT timestamp, half_up(price_eur_mwh, 4) AS price_eur_mwh FROM hours",
)
_add(
    "index_xml_parse",
    """SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS date, 'DE' AS country_code,
              half_up(avg(o_totalprice), 2) AS industrial_production_index, 'STATISTICS' AS source,
              'Index (2015=100)' AS unit
       FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1""",
)
_add(
    "market_zones",
    """SELECT CASE o_custkey % 3 WHEN 0 THEN 'DE-LU' WHEN 1 THEN 'FR' ELSE 'IT' END AS market_area,
              CASE o_custkey % 3 WHEN 0 THEN '10Y1001A1001A82H' WHEN 1 THEN '10YFR-RTE------C'
                                 ELSE 'IT' END AS zone_code,
              count(*) AS n_orders
       FROM orders GROUP BY 1, 2""",
)
_add(
    "local_time_shift",
    """SELECT l_orderkey, l_linenumber,
              ((l_shipdate + to_hours(l_linenumber)) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS local_ts
       FROM lineitem""",
)
_add("nanos_to_micros", "SELECT event_id, ts AS ts_micros FROM events")
_add(
    "month_batches",
    """SELECT strftime(m, '%Y-%m-%d') AS month_start, strftime(last_day(m), '%Y-%m-%d') AS month_end
       FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate),
                                           INTERVAL '1 month')) AS m, min(o_orderdate) AS first
             FROM orders)
       WHERE m >= first""",
)

# Streams ----------------------------------------------------------------------

_CLOSED = "WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"

_add("stream_window_append", _select(_WINDOW_COLUMNS, _windows("telemetry")) + " " + _CLOSED)
_add("stream_window_update", _select(_WINDOW_COLUMNS, _windows("telemetry")))
_SLID = """(SELECT t.*, time_bucket(INTERVAL '5 minutes', timestamp) - to_minutes(5 * k) AS start
            FROM telemetry t, (SELECT unnest(range(3)) AS k))"""
_add("stream_sliding", _select(_WINDOW_COLUMNS, _windows(_SLID, "start")) + " " + _CLOSED)
_add(
    "stream_window_alerts",
    _select(_WINDOW_COLUMNS, _windows("telemetry")) + f" {_CLOSED} AND has_anomaly = 1",
)
_add(
    "stream_alerts",
    """SELECT DISTINCT time_bucket(INTERVAL '15 minutes', timestamp) AS window_start, machine_id, operation,
              TRUE AS anomalous, FALSE AS outside
       FROM telemetry WHERE label = 1""",
)
_TRENDS = f"""
    (SELECT *, running_sum / n_windows AS running_mean, walk - least(0, min(walk) OVER w) AS shift_sum,
            (n_windows * sum_ty - sum_t * running_sum) / nullif(n_windows * sum_tt - sum_t * sum_t, 0) AS slope_per_hour
     FROM (SELECT *, sum(step) OVER w AS walk
           FROM (SELECT *, row_number() OVER w AS n_windows, sum(magnitude) OVER w AS running_sum, sum(t) OVER w AS sum_t,
                        sum(t * t) OVER w AS sum_tt, sum(t * magnitude) OVER w AS sum_ty,
                        coalesce(magnitude - avg(magnitude) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                                 - 0.5, 0) AS step
                 FROM (SELECT *, epoch(window_start - min(window_start) OVER (PARTITION BY machine_id, operation, part))
                              / 3600 AS t
                       FROM (SELECT *, count(*) FILTER (WHERE gap > INTERVAL '24 hours') OVER u AS part
                             FROM (SELECT window_start, machine_id, operation,
                                          sqrt(avg_rms_x ** 2 + avg_rms_y ** 2 + avg_rms_z ** 2) AS magnitude,
                                          window_start - lag(window_start) OVER u AS gap
                                   FROM {_windows("telemetry")} {_CLOSED}
                                   WINDOW u AS (PARTITION BY machine_id, operation ORDER BY window_start))
                             WINDOW u AS (PARTITION BY machine_id, operation ORDER BY window_start)))
                 WINDOW w AS (PARTITION BY machine_id, operation, part ORDER BY window_start))
           WINDOW w AS (PARTITION BY machine_id, operation, part ORDER BY window_start))
     WINDOW w AS (PARTITION BY machine_id, operation, part ORDER BY window_start))"""
_add(
    "stream_trend",
    _select("window_start machine_id operation @magnitude n_windows @running_mean @slope_per_hour @shift_sum", _TRENDS, 4)
    .replace(" FROM", ", shift_sum > 500 AS shifted FROM", 1),
)
_MESSAGE_FEATURES = """
    (SELECT ts AS timestamp, CASE WHEN event_id % 13 <> 0 THEN machine END AS machine_id,
            event_type AS operation, label,
            sqrt((f * f + f * f + f * f / 4) / 3) AS rms_x, sqrt((f * f / 4 + f * f / 16) / 2) AS rms_y,
            f AS rms_z
     FROM (SELECT *, value::FLOAT::DOUBLE AS f FROM bodies) WHERE sent IS NOT NULL)"""
_add(
    "stream_message_windows",
    _select(_WINDOW_COLUMNS.replace(" max_", " @max_"), _windows(_MESSAGE_FEATURES)).replace(
        " has_anomaly,", " coalesce(has_anomaly, 0) AS has_anomaly,", 1
    ),
)
ORACLE_SQL["stream_log_windows"] = ORACLE_SQL["stream_message_windows"]
_add(
    "stream_driver",
    _select(_WINDOW_COLUMNS.replace(" max_", " @max_"), _windows(_MESSAGE_FEATURES)).replace(
        " has_anomaly,", " coalesce(has_anomaly, 0) AS has_anomaly,", 1
    )
    + " WHERE window_end <= (SELECT max(sent) FROM bodies) - INTERVAL '10 minutes'",
)
_add("stream_console", "SELECT count(*) AS rows_taken, TRUE AS ended FROM events")
_add(
    "stream_late_data",
    _select(_WINDOW_COLUMNS, _windows("(SELECT * FROM telemetry WHERE event_id % 50 <> 0)"))
    + " WHERE window_end <= (SELECT max(ts) FROM events WHERE event_id % 50 <> 0) - INTERVAL '10 minutes'",
)

# Sinks ------------------------------------------------------------------------

_add(
    "sink_roundtrip",
    """SELECT sink, n_rows, total_samples, first_window, machines, TRUE AS same_rows
       FROM (SELECT count(*) AS n_rows, CAST(sum(total_samples) AS BIGINT) AS total_samples,
                    min(timestamp_15min) AS first_window, count(DISTINCT machine_id) AS machines
             FROM bronze)
       CROSS JOIN (SELECT unnest(['by_machine', 'flat', 'by_unit', 'replaced', 'overwritten', 'compact',
                                  'csv']) AS sink)""",
)
