"""The registered queries once more, as SQL over the same driver tables.

``_TABLES`` derives the domain tables; every query is that common part plus
its own statement.  Rounding goes through the shortest decimal text of a
double, so that ties round half away from zero in every engine.
"""

from __future__ import annotations

from delayloom import rules, schemas
from delayloom.verification.fixtures import COMPLETE_DAYS, FOCUS_BUS_ROUTE, FOCUS_ROUTE, PARTIAL_DAY_NOTES


def _r(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def _mean(seconds: str, where: str = "") -> str:
    extra = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(SUM({seconds}){extra} AS DOUBLE) / NULLIF(COUNT({seconds}){extra}, 0) / 60"


#: A record's delay counts by its minutes: the seconds column may be null or fractional.
_SECONDS = "CAST(ROUND(delay_minutes * 60, 6) AS DECIMAL(18, 6))"


def _six(value: str, where: str = "") -> str:
    extra = f" FILTER (WHERE {where})" if where else ""
    return (
        f"CAST(SUM(CAST({value} AS DECIMAL(18, 6))){extra} AS DOUBLE) / NULLIF(COUNT({value}){extra}, 0)"
    )


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return _r(f"CAST({part} AS DOUBLE) * 100.0 / NULLIF({whole}, 0)", digits)


def _list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _case(column: str, table: dict, default: str = "NULL") -> str:
    branches = " ".join(f"WHEN {column} = {key!r} THEN '{value}'" for key, value in table.items())
    return f"CASE {branches} ELSE {default} END"


_RISK_RANK = "CASE {0} WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Severe' THEN 4 ELSE 5 END"
_ACTION = _case("{0}", rules.ACTION_BY_RISK)
_BAND = _case("{0}", rules.CONFIDENCE_BY_RISK)
_SPECIAL = "COALESCE(is_special_route, starts_with(upper(route_id), 'S'))"
_PLAIN = f"NOT {_SPECIAL}"
_CORRIDOR_OR_ROUTE = "COALESCE(NULLIF(route_corridor_name, ''), NULLIF(route_display_name, ''), route_id)"
_CORRIDOR = f"regexp_replace({_CORRIDOR_OR_ROUTE}, '^[A-Z0-9]+ - ', '')"
_TIMING = "CASE WHEN {0} < -1 THEN 'Early-running' WHEN {0} > 1 THEN 'Late-running' ELSE 'Near on-time' END"
_RAIN = "CASE WHEN COALESCE(rain, 0) > 0 THEN 'Rain detected' ELSE 'No rain detected' END"
_SERVICE = "COALESCE(NULLIF(service_type, ''), '{0}')"
_ID = "{0} || '-20' || ({0} % 5)"

_TABLES = f"""
WITH obs AS (
    SELECT * EXCLUDE (exact), exact / 60 AS delay_minutes, CASE WHEN event_id % 83 <> 0 THEN exact END AS delay_seconds FROM (
        SELECT event_id, user_id, ts AS collection_time_utc, 'E' || event_id AS entity_id,
            'T' || user_id || '-' || (event_id % 40) AS trip_id,
            CASE WHEN user_id % 11 = 0 THEN 'S' || user_id ELSE {_ID.format('user_id')} END AS route_id,
            event_id % 2 AS direction_id,
            strftime(ts, '%H:00:00') AS start_time,
            CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS start_date,
            CAST(floor(epoch(ts)) AS BIGINT) AS feed_time,
            CAST((CAST(round(value * 100) AS BIGINT) * 7) % 3600 - 1200
                + CASE WHEN event_id % 97 = 0 THEN 9000 ELSE 0 END
                + CASE WHEN event_id % 89 = 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS exact,
            event_id % 100 = 0 AS is_deleted,
            strftime(ts, '%Y-%m-%d') AS collection_date,
            'gtfs_realtime_' || strftime(ts, '%Y-%m-%d') || '.csv' AS source_file
        FROM events)
),
file_stats AS (
    SELECT collection_date, source_file, COUNT(*) AS raw_csv_rows,
        COUNT(*) FILTER (WHERE is_deleted) AS duplicate_header_rows
    FROM obs GROUP BY ALL
),
manifest AS (
    SELECT d.collection_date,
        CASE WHEN d.collection_date IN ({_list(COMPLETE_DAYS)}) THEN 'likely_complete'
             ELSE 'partial_or_interrupted' END AS collection_day_status,
        {_case('d.collection_date', PARTIAL_DAY_NOTES, "''")} AS collection_note,
        d.collection_date IN ({_list(COMPLETE_DAYS)}) AS is_model_baseline_day,
        d.collection_date NOT IN ({_list(COMPLETE_DAYS)}) AS is_partial_day,
        {_r('CAST(epoch_us(last_t) - epoch_us(first_t) AS DOUBLE) / 3600000000', 2)} AS collection_coverage_hours,
        raw_csv_rows, cleaned_rows, duplicate_header_rows, unique_routes, unique_trips,
        first_t, last_t, delay_outliers_abs_gt_120, source_file
    FROM (
        SELECT collection_date, COUNT(*) AS cleaned_rows, COUNT(DISTINCT route_id) AS unique_routes,
            COUNT(DISTINCT trip_id) AS unique_trips, MIN(collection_time_utc) AS first_t,
            MAX(collection_time_utc) AS last_t,
            COUNT(*) FILTER (WHERE abs(delay_minutes) > 120) AS delay_outliers_abs_gt_120
        FROM obs GROUP BY collection_date) d
    LEFT JOIN file_stats USING (collection_date)
),
routes AS (
    SELECT {_ID.format('c_custkey')} AS route_id, 'AG' || c_nationkey AS agency_id,
        CAST(c_custkey AS VARCHAR) AS route_short_name, c_name AS route_long_name,
        2 + c_nationkey % 4 AS route_type
    FROM customer
),
metadata AS (
    SELECT *, {_case('route_type', rules.SERVICE_TYPE_BY_ROUTE_TYPE, "'Unknown / unmatched route'")} AS service_type,
        CASE WHEN trim(route_short_name) <> '' AND trim(route_long_name) <> ''
                  AND trim(route_short_name) <> trim(route_long_name)
             THEN trim(route_short_name) || ' - ' || trim(route_long_name)
             WHEN trim(route_long_name) <> '' THEN trim(route_long_name)
             WHEN trim(route_short_name) <> '' THEN trim(route_short_name)
             ELSE trim(route_id) END AS route_display_name
    FROM routes
),
trips AS (
    SELECT {_ID.format('o_custkey')} AS route_id, 'O' || o_orderkey AS trip_id,
        CAST(o_orderkey % 2 AS VARCHAR) AS direction_id,
        CASE WHEN starts_with(o_orderpriority, '4') THEN '  '
             WHEN o_orderstatus = 'F' THEN o_orderpriority || ' to ' || o_orderstatus
             WHEN o_orderstatus = 'P' THEN o_orderpriority
             ELSE o_orderpriority || ' To ' || o_orderstatus END AS trip_headsign,
        'SH' || (o_orderkey // 4) AS shape_id
    FROM orders
),
signs AS (
    SELECT route_id, replace(trim(trip_headsign), ' to ', ' To ') AS sign, MIN(trip_id) AS seen
    FROM trips WHERE trim(trip_headsign) <> '' GROUP BY route_id, trim(trip_headsign)
),
ends AS (
    SELECT route_id, seen, 0 AS side,
        trim(CASE WHEN contains(sign, ' To ') THEN left(sign, strpos(sign, ' To ') - 1) ELSE sign END) AS endpoint
    FROM signs
    UNION ALL
    SELECT route_id, seen, 1, trim(substr(sign, strpos(sign, ' To ') + 4)) FROM signs WHERE contains(sign, ' To ')
),
first_ends AS (
    SELECT route_id, endpoint, ROW_NUMBER() OVER (PARTITION BY route_id ORDER BY seen, side, endpoint) AS place
    FROM (
        SELECT route_id, endpoint, seen, side,
            ROW_NUMBER() OVER (PARTITION BY route_id, endpoint ORDER BY seen, side) AS again
        FROM ends WHERE endpoint <> '') WHERE again = 1
),
pairs AS (
    SELECT route_id, string_agg(endpoint, ' / ' ORDER BY place) AS corridor
    FROM first_ends WHERE place <= 2 GROUP BY route_id
),
corridors AS (
    SELECT t.route_id,
        CASE WHEN COALESCE(p.corridor, COALESCE(r.route_short_name, t.route_id)) <> COALESCE(r.route_short_name, t.route_id)
             THEN COALESCE(r.route_short_name, t.route_id) || ' - ' || p.corridor
             ELSE COALESCE(r.route_short_name, t.route_id) END AS route_corridor_name
    FROM (SELECT DISTINCT route_id FROM trips) t
    LEFT JOIN routes r USING (route_id) LEFT JOIN pairs p USING (route_id)
),
corridor_lookup AS (
    SELECT r.route_id, COALESCE(c.route_corridor_name, r.route_short_name, r.route_id) AS route_corridor_name
    FROM routes r LEFT JOIN corridors c USING (route_id)
),
weather AS (
    SELECT weather_hour, CAST(lo AS DOUBLE) / 4 AS temperature_2m,
        CAST(greatest(hi - 60, 0) AS DOUBLE) / 20 AS precipitation, CAST(greatest(hi - 70, 0) AS DOUBLE) / 10 AS rain,
        50 + CAST(hi AS DOUBLE) / 4 AS relative_humidity_2m, CAST(hi AS DOUBLE) / 2 AS wind_speed_10m
    FROM (
        SELECT date_trunc('hour', ts) AS weather_hour, MAX(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS hi,
            MIN(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS lo
        FROM events WHERE event_type = 'error' GROUP BY 1)
),
storage AS (
    SELECT o.*, m.collection_day_status, m.collection_coverage_hours, m.is_partial_day, m.is_model_baseline_day,
        r.agency_id, r.route_short_name, r.route_long_name, r.route_type,
        COALESCE(r.service_type, 'Unknown / unmatched route') AS service_type,
        COALESCE(r.route_display_name, o.route_id) AS route_display_name,
        starts_with(upper(o.route_id), 'S') AS is_special_route
    FROM obs o LEFT JOIN manifest m USING (collection_date) LEFT JOIN metadata r USING (route_id)
),
decisions AS (
    SELECT s.*,
        COALESCE(c.route_corridor_name, s.route_display_name, s.route_short_name, s.route_id) AS route_corridor_name,
        CAST(hour(s.collection_time_utc) AS INTEGER) AS trip_hour,
        CAST(isodow(s.collection_time_utc) - 1 AS INTEGER) AS weekday,
        CAST(day(s.collection_time_utc) AS INTEGER) AS day_of_month,
        w.temperature_2m, w.precipitation, w.rain, w.relative_humidity_2m, w.wind_speed_10m,
        s.delay_risk0 AS delay_risk, {_ACTION.format('s.delay_risk0')} AS recommended_action
    FROM (
        SELECT *, CASE WHEN abs(delay_minutes) <= 5 THEN 'Low' WHEN abs(delay_minutes) <= 15 THEN 'Medium'
                       WHEN abs(delay_minutes) <= 25 THEN 'High' ELSE 'Severe' END AS delay_risk0
        FROM storage WHERE delay_minutes BETWEEN -60 AND 120) s
    LEFT JOIN corridor_lookup c USING (route_id)
    LEFT JOIN weather w ON w.weather_hour = date_trunc('hour', s.collection_time_utc)
),
ai AS (
    SELECT *, {_ACTION.format('ai_delay_risk')} AS ai_recommended_action, {_BAND.format('ai_delay_risk')} AS ai_confidence_band
    FROM (
        SELECT *, CASE WHEN predicted_actionable_probability < 0.5 THEN 'Low'
                       WHEN predicted_actionable_probability < 0.7 THEN 'Medium'
                       WHEN predicted_actionable_probability < 0.85 THEN 'High' ELSE 'Severe' END AS ai_delay_risk
        FROM (
            SELECT *, CAST(delay_risk <> 'Low' AS INTEGER) AS actual_actionable_delay_risk,
                CAST((event_id * 37 + user_id * 13) % 1001 AS DOUBLE) / 1000 AS predicted_actionable_probability,
                CAST(CAST((event_id * 37 + user_id * 13) % 1001 AS DOUBLE) / 1000 >= 0.5 AS INTEGER)
                    AS predicted_actionable_delay_risk,
                {_r('delay_minutes / 2', 6)} AS predicted_delay_minutes
            FROM decisions))
),
dates AS (
    SELECT collection_date,
        ROW_NUMBER() OVER (ORDER BY collection_date DESC) <= greatest(1, round_even(COUNT(*) OVER () * 0.2, 0)) AS is_test
    FROM (SELECT DISTINCT collection_date FROM ai)
),
route_daily AS (
    SELECT collection_date, collection_day_status, is_model_baseline_day, route_id, service_type, route_display_name,
        is_special_route, COUNT(*) AS records, COUNT(DISTINCT trip_id) AS unique_trips,
        {_mean(_SECONDS)} AS avg_delay_minutes, MAX(delay_minutes) AS max_delay_minutes
    FROM storage GROUP BY ALL
),
importance AS (
    SELECT CASE WHEN p_partkey % 2 = 0 THEN 'GBT classifier' ELSE 'GBT regressor' END AS source,
        CASE WHEN p_size % 2 = 0 THEN 'mean_abs_shap' ELSE 'feature_importance' END AS explainability_type,
        CASE p_size % 7 WHEN 0 THEN 'route_id_' || p_partkey WHEN 1 THEN 'route_type_' || (p_size % 4)
            WHEN 2 THEN ([{_list(schemas.NUMERIC_FEATURES)}])[p_partkey % 8 + 1]
            WHEN 3 THEN 'direction_id_' || (p_size % 2) WHEN 4 THEN 'service_type_Train / Rail' ELSE p_name END AS feature,
        {_r('p_retailprice / 1000', 6)} AS importance, p_brand AS notes
    FROM part
),
scenario_trips AS (
    SELECT CASE l_returnflag WHEN 'A' THEN 'Baseline Operations' WHEN 'N' THEN 'Disruption Scenario'
                             WHEN 'R' THEN 'Intervention Scenario' END AS scenario_name,
        l_quantity * 10 + loss AS duration_sec, CAST(loss AS DOUBLE) AS time_loss_sec,
        CAST(l_suppkey % 30 AS DOUBLE) AS waiting_time_sec
    FROM (SELECT *, l_linenumber * CASE l_returnflag WHEN 'N' THEN 9 WHEN 'R' THEN 5 ELSE 2 END AS loss FROM lineitem)
),
scenario_metrics AS (
    SELECT scenario_name, COUNT(*) AS completed_trips, {_r('AVG(duration_sec)', 2)} AS avg_duration_sec,
        MAX(duration_sec) AS max_duration_sec, {_r('AVG(time_loss_sec)', 2)} AS avg_time_loss_sec,
        MAX(time_loss_sec) AS max_time_loss_sec, {_r('AVG(waiting_time_sec)', 2)} AS avg_waiting_time_sec
    FROM scenario_trips GROUP BY scenario_name
),
last_steps AS (
    SELECT scenario_name, summary_steps, CAST(k AS DOUBLE) AS last_time_sec, k * 3 AS loaded, k * 2 AS inserted,
        k AS ended, k AS arrived, k % 17 AS halting, CAST(k % 100 AS DOUBLE) / 4 AS mean_travel_time_sec,
        CAST(k % 60 AS DOUBLE) / 4 AS mean_speed
    FROM (
        SELECT CASE o_orderstatus WHEN 'O' THEN 'Baseline Operations' WHEN 'F' THEN 'Disruption Scenario'
                                  WHEN 'P' THEN 'Intervention Scenario' END AS scenario_name,
            COUNT(*) AS summary_steps, MAX(o_orderkey) AS k
        FROM orders GROUP BY 1)
),
comparison AS (SELECT * FROM scenario_metrics LEFT JOIN last_steps USING (scenario_name)),
cases AS (
    SELECT *, delay_seconds AS actual_arrival_delay_min, trip_hour * 3 + weekday AS traffic_congestion_index
    FROM decisions
    WHERE recommended_action IN ('Adjust service headway', 'Deploy standby bus', 'Deploy standby bus or supervisor review')
),
with_mode AS (
    SELECT *, CASE route_type WHEN 2 THEN 'Train' WHEN 3 THEN 'Bus' WHEN 4 THEN 'Ferry' ELSE 'Other' END AS transport_mode
    FROM obs LEFT JOIN routes USING (route_id)
)
"""


def _shares(select: str, frm: str, group: str, name: str = "share_pct", digits: int = 2) -> str:
    """Counts per group and their share of all counts."""
    return f"""SELECT *, {_pct('records', 'SUM(records) OVER ()', digits)} AS {name}
        FROM (SELECT {select}, COUNT(*) AS records FROM {frm} GROUP BY {group})"""


def _decision_summary(where: str) -> str:
    return _shares("ai_delay_risk AS delay_risk, ai_recommended_action AS recommended_action", f"ai WHERE {where}", "1, 2")


def _mode(keys: str, value: str, source: str, name: str) -> str:
    """Modal value per key; ties to the smaller value."""
    return f"""SELECT {keys}, {value} AS {name} FROM (
        SELECT {keys}, {value}, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY COUNT(*) DESC, {value}) AS place
        FROM {source} GROUP BY {keys}, {value}) WHERE place = 1"""


def _short(action: str) -> str:
    return f"CASE WHEN {action} = 'No operational action required' THEN 'No action required' ELSE {action} END"


_MODAL_ACTION = f"""(SELECT {_short('ai_recommended_action')} FROM (
    SELECT ai_recommended_action, COUNT(*) AS n FROM ai WHERE {_PLAIN} GROUP BY 1) ORDER BY n DESC, ai_recommended_action LIMIT 1)"""


def _top_routes(where: str, limit: int) -> str:
    keys = "service_type, route_display_name, route_corridor_name, route_id, is_special_route"
    base = f"""(SELECT CASE WHEN {_SPECIAL} THEN 'School/Special Services'
            ELSE {_SERVICE.format('School/Special Services')} END AS service_type,
        COALESCE(NULLIF(route_display_name, ''), route_short_name, route_id) AS route_display_name,
        {_CORRIDOR} AS route_corridor_name, route_id, {_SPECIAL} AS is_special_route,
        predicted_actionable_delay_risk, predicted_delay_minutes, predicted_actionable_probability, ai_recommended_action
        FROM ai WHERE {where})"""
    return f"""SELECT g.*, m.recommended_action FROM (
        SELECT {keys}, COUNT(*) AS records, CAST(SUM(predicted_actionable_delay_risk) AS BIGINT) AS actionable_records,
            {_r(_six('predicted_delay_minutes'), 3)} AS avg_delay_minutes,
            {_r('MAX(predicted_delay_minutes)', 3)} AS max_delay_minutes,
            {_r(_six('predicted_actionable_probability'), 3)} AS avg_prediction_probability
        FROM {base} GROUP BY {keys}) g
    JOIN ({_mode(keys, 'ai_recommended_action', base, 'recommended_action')}) m USING ({keys})
    ORDER BY actionable_records DESC, avg_delay_minutes DESC, {keys} LIMIT {limit}"""


_OBSERVED = f"""COUNT(*) AS records, {_r(_mean(_SECONDS), 3)} AS avg_observed_delay,
    {_r('CAST(MAX(' + _SECONDS + ') AS DOUBLE) / 60', 3)} AS max_observed_delay,
    COUNT(*) FILTER (WHERE delay_risk IN ('High', 'Severe')) AS high_severe_cases"""
_WEIGHTED = (
    "CAST(SUM(CAST(avg_delay_minutes * records AS DECIMAL(28, 9))) AS DOUBLE)"
    " / NULLIF(SUM(records) FILTER (WHERE avg_delay_minutes IS NOT NULL), 0)"
)
_PLAIN_SUMMARY = "NOT (is_special_route OR starts_with(upper(route_id), 'S'))"
_TRIP_SUMMARY = f"""COUNT(*) AS records, COUNT(DISTINCT trip_id) AS unique_trips,
    {_r(_mean(_SECONDS), 3)} AS avg_delay_minutes,
    {_r('CAST(MAX(' + _SECONDS + ') AS DOUBLE) / 60', 3)} AS max_delay_minutes"""
_EXAMPLES = f"""{_r('delay_minutes', 3)} AS observed_delay, {_r('predicted_delay_minutes', 3)} AS predicted_delay,
    {_r('predicted_actionable_probability', 3)} AS ai_probability, ai_delay_risk, ai_recommended_action"""
_EXAMPLE_ORDER = "ai_probability DESC, route_id, collection_date, observed_delay, predicted_delay, corridor_name"
_NAMED = "route_id, route_short_name, route_long_name, service_type, route_display_name, route_corridor_name, is_special_route"
_ROUTE_DELAY_RISK = f"""SELECT {_SERVICE.format('Unknown / unmatched route')} AS service_type,
    COALESCE(NULLIF(route_display_name, ''), NULLIF(route_short_name, ''), route_id) AS route_display_name,
    COALESCE(NULLIF(route_corridor_name, ''), NULLIF(route_long_name, ''), NULLIF(route_display_name, ''), route_id)
        AS route_corridor_name,
    route_id, {_SPECIAL} AS is_special_route, delay_risk, recommended_action, {_TRIP_SUMMARY}
    FROM decisions WHERE route_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7"""
_ADVERSE = "COALESCE(precipitation, 0) > 0 OR COALESCE(rain, 0) > 0"
_WEATHER_DELAY_RISK = f"""SELECT {_SERVICE.format('Unknown / unmatched route')} AS service_type,
    CASE WHEN {_ADVERSE} OR COALESCE(wind_speed_10m, 0) >= 30 THEN 'Adverse weather context'
         ELSE 'Normal / no adverse weather flag' END AS weather_context,
    CASE WHEN {_ADVERSE} THEN 'Rain / precipitation' WHEN COALESCE(wind_speed_10m, 0) >= 30 THEN 'High wind'
         ELSE 'No adverse weather flag' END AS weather_rule,
    delay_risk, recommended_action, {_TRIP_SUMMARY}, {_r(_six('precipitation'), 3)} AS avg_precipitation,
    {_r(_six('rain'), 3)} AS avg_rain, {_r(_six('wind_speed_10m'), 3)} AS avg_wind_speed_10m
    FROM decisions GROUP BY 1, 2, 3, 4, 5"""
_CATEGORY = """CASE WHEN starts_with(feature, 'route_id_') THEN 'Route pattern'
    WHEN starts_with(feature, 'route_type_') THEN 'Service type / mode'
    WHEN feature IN ('trip_hour', 'weekday', 'day_of_month') THEN 'Time pattern'
    WHEN feature IN ('temperature_2m', 'precipitation', 'rain', 'relative_humidity_2m', 'wind_speed_10m')
    THEN 'Weather context' ELSE 'Operational / encoded model feature' END"""
_LOOKUP = f"""SELECT source, explainability_type, feature, importance, {_CATEGORY} AS operator_category,
    {_case(_CATEGORY, rules.FEATURE_CATEGORY_TEXT)} AS operator_explanation, notes FROM importance"""


def _contains(text: str, *terms: str) -> str:
    return " OR ".join(f"contains(lower({text}), '{term}')" for term in terms)


def _feature_class(text: str) -> str:
    return f"""CASE WHEN {_contains(text, 'route', 'low-frequency')} THEN 'Route'
        WHEN {_contains(text, 'service', 'train', 'rail')} THEN 'Service'
        WHEN {_contains(text, 'hour', 'weekday', 'day', 'month')} THEN 'Time'
        WHEN {_contains(text, 'rain', 'wind', 'temperature', 'humidity', 'weather', 'precip')} THEN 'Weather'
        WHEN {_contains(text, 'direction')} THEN 'Direction' ELSE 'Other' END"""


def _feature_text(column: str) -> str:
    text = column
    for old, new in rules.FEATURE_TEXT_REPLACEMENTS:
        text = f"replace({text}, '{old}', '{new}')"
    return f"trim({text})"


def _bin(value: str) -> str:
    return f"CAST(floor(greatest(least({value}, 30.0), -30.0) / 2) * 2 + 1 AS BIGINT)"


def _null_rows(columns, frm: str, name: str = "column_name", value: str = "null_count", condition: str = "{0} IS NULL") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {name}, COUNT(*) FILTER (WHERE {condition.format(c)}) AS {value} FROM {frm}" for c in columns
    )


def _blank(column: str) -> str:
    text = column in ("delay_risk", "recommended_action", "route_corridor_name", "service_type", "route_display_name",
                      "collection_day_status")
    return f"{column} IS NULL OR trim({column}) = ''" if text else f"{column} IS NULL"


_BLANKS = [f"SELECT '{c}' AS check_name, COUNT(*) FILTER (WHERE {_blank(c)}) AS records FROM decisions"
           for c in schemas.DASHBOARD_REQUIRED]
_BLANK_ROWS = " UNION ALL ".join(
    [*_BLANKS, "SELECT 'special_route_rows', COUNT(*) FILTER (WHERE is_special_route) FROM decisions"]
)
_DESCRIBE = ", ".join(
    [
        "COUNT({0}) AS count",
        f"{_r('CAST(SUM({0}) AS DOUBLE) / COUNT({0})', 6)} AS mean",
        f"{_r('stddev_samp({0})', 6)} AS std",
        f"{_r('CAST(MIN({0}) AS DOUBLE)', 6)} AS min",
        f"{_r('quantile_cont({0}, 0.25)', 6)} AS q25",
        f"{_r('quantile_cont({0}, 0.5)', 6)} AS median",
        f"{_r('quantile_cont({0}, 0.75)', 6)} AS q75",
        f"{_r('CAST(MAX({0}) AS DOUBLE)', 6)} AS max",
    ]
)


def _class_metrics(frm: str) -> str:
    """Long classification metrics of one source."""
    return f"""SELECT unnest(['accuracy', 'precision', 'recall', 'f1', 'macro_f1', 'weighted_f1', 'true_negative_low',
            'false_positive_actionable', 'false_negative_actionable', 'true_positive_actionable']) AS metric,
        unnest([{_r('(tp + tn) / n', 6)}, {_r('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END', 6)},
            {_r('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END', 6)}, {_r('f1', 6)}, {_r('(f0 + f1) / 2', 6)},
            {_r('(f0 * (tn + fp) + f1 * (fn + tp)) / n', 6)}, tn, fp, fn, tp]) AS value
    FROM (SELECT *, tn + fp + fn + tp AS n, 2 * tp / (2 * tp + fp + fn) AS f1, 2 * tn / (2 * tn + fp + fn) AS f0 FROM (
        SELECT CAST(COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS DOUBLE) AS tn,
            CAST(COUNT(*) FILTER (WHERE y = 0 AND p = 1) AS DOUBLE) AS fp,
            CAST(COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS DOUBLE) AS fn,
            CAST(COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS DOUBLE) AS tp
        FROM (SELECT actual_actionable_delay_risk AS y, predicted_actionable_delay_risk AS p FROM {frm})))"""


_ERROR = "(delay_minutes - predicted_delay_minutes)"


def _delay_metrics(frm: str) -> str:
    return f"""SELECT unnest(['mae', 'mse', 'rmse', 'r2']) AS metric, unnest([{_r('mae', 6)}, {_r('mse', 6)},
            {_r('sqrt(mse)', 6)}, {_r('1 - mse / spread', 6)}]) AS value
        FROM (SELECT AVG(abs({_ERROR})) AS mae, AVG({_ERROR} * {_ERROR}) AS mse, var_pop(delay_minutes) AS spread FROM {frm})"""


_TEST = "ai JOIN dates USING (collection_date) WHERE is_test"
_TRAIN = "ai JOIN dates USING (collection_date) WHERE NOT is_test"


def _metric(rows: str, metric: str) -> str:
    return f"(SELECT value FROM ({rows}) WHERE metric = '{metric}')"


def _hourly(frm: str) -> str:
    """Gap-free hourly means: linear between known hours, nearest at the ends."""
    return f"""(
    SELECT hour, COALESCE(v, v0 + (v1 - v0) * (epoch(hour) - epoch(t0)) / NULLIF(epoch(t1) - epoch(t0), 0), v0, v1) AS mean_delay
    FROM (
        SELECT hour, v,
            last_value(CASE WHEN v IS NOT NULL THEN hour END IGNORE NULLS) OVER past AS t0, last_value(v IGNORE NULLS) OVER past AS v0,
            first_value(CASE WHEN v IS NOT NULL THEN hour END IGNORE NULLS) OVER future AS t1, first_value(v IGNORE NULLS) OVER future AS v1
        FROM (
            SELECT unnest(generate_series(MIN(h), MAX(h), INTERVAL 1 HOUR)) AS hour FROM (SELECT date_trunc('hour', collection_time_utc) AS h FROM {frm})) g
        LEFT JOIN (SELECT date_trunc('hour', collection_time_utc) AS h, {_mean(_SECONDS)} AS v FROM {frm} GROUP BY 1) m ON m.h = g.hour
        WINDOW past AS (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            future AS (ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))"""


_FULL_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
_HOUR_TEXT = _FULL_TIME.format("hour") + " AS hour"
_RECORD = f"""{_FULL_TIME.format('collection_time_utc')} AS collection_time_utc, entity_id, trip_id, route_id, direction_id,
    start_time, start_date, feed_time AS "timestamp", delay_seconds, is_deleted, {_r('delay_minutes', 6)} AS delay_minutes, collection_date"""


def _strata(wanted: str, strata: str) -> str:
    return f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY {strata} ORDER BY md5(entity_id || '|42'), entity_id) <= wanted AS taken
        FROM (SELECT *, {wanted} AS wanted FROM (
            SELECT *, COUNT(*) OVER (PARTITION BY {strata}) AS size, COUNT(*) OVER () AS everything FROM decisions))"""


_CLEAN_RAW = """(SELECT *,
    CASE WHEN event_id % 251 = 0 THEN NULL WHEN event_id % 113 = 0 THEN NULL ELSE collection_time_utc END AS t,
    CASE WHEN event_id % 127 = 0 THEN NULL WHEN event_id % 131 = 0 THEN NULL ELSE delay_minutes END AS m FROM obs)"""

_EVIDENCE = f"""MIN(service_type) AS service_type, MIN(route_display_name) AS route_display_name,
    MIN(route_corridor_name) AS route_corridor_name, COUNT(*) AS records, COUNT(DISTINCT trip_id) AS unique_trips,
    {_r(_mean(_SECONDS), 2)} AS avg_delay_min, {_r(_mean(f'abs({_SECONDS})'), 2)} AS {{0}},
    {_r('CAST(MAX(' + _SECONDS + ') AS DOUBLE) / 60', 2)} AS max_delay_min,
    COUNT(*) FILTER (WHERE delay_risk = 'Severe') AS severe_records, COUNT(*) FILTER (WHERE delay_risk = 'High') AS high_records,
    COUNT(*) FILTER (WHERE recommended_action = 'Deploy standby bus or supervisor review') AS standby_records,
    MIN(collection_date) AS {{1}}, MAX(collection_date) AS {{2}}"""

_WET = "(COALESCE(rain, 0) > 0 OR COALESCE(wind_speed_10m, 0) >= 30)"
_FOCUS = f"ai WHERE {_PLAIN} AND route_id = '{FOCUS_ROUTE}'"


def _weather_routes() -> str:
    keys = "route_id, service_type, corridor_name"
    base = f"""(SELECT * REPLACE ({_SERVICE.format('School/Special or unmatched services')} AS service_type),
        {_CORRIDOR} AS corridor_name, {_WET} AS wet FROM ai WHERE {_PLAIN})"""
    wet = "wet"
    return f"""SELECT g.*, COALESCE(m.action, 'Unavailable') AS common_ai_action FROM (
        SELECT {keys}, COUNT(*) FILTER (WHERE wet) AS weather_context_records,
            {_r(_mean(_SECONDS, wet), 2)} AS avg_observed_delay, {_r(_mean(_SECONDS, 'NOT wet'), 2)} AS avg_dry_delay,
            {_r(_mean(_SECONDS, wet) + ' - ' + _mean(_SECONDS, 'NOT wet'), 2)} AS weather_delay_delta,
            {_r(_six('predicted_delay_minutes', wet), 2)} AS avg_predicted_delay,
            {_r('(' + _six('predicted_actionable_probability', wet) + ') * 100', 2)} AS avg_ai_probability_pct,
            {_r('MAX(rain) FILTER (WHERE wet)', 2)} AS max_rain, {_r('MAX(wind_speed_10m) FILTER (WHERE wet)', 2)} AS max_wind_speed
        FROM {base} GROUP BY {keys} HAVING COUNT(*) FILTER (WHERE wet) >= 50) g
    LEFT JOIN ({_mode(keys, 'ai_recommended_action', base + ' WHERE wet', 'action')}) m USING ({keys})
    ORDER BY weather_delay_delta DESC NULLS LAST, weather_context_records DESC, {keys} LIMIT 10"""


_BODIES = {
    "decision_summary": _decision_summary(_PLAIN),
    "decision_summary_bus_morning": _decision_summary(f"{_PLAIN} AND service_type = 'Bus' AND trip_hour = 8"),
    "decision_summary_one_day": _decision_summary(f"{_PLAIN} AND collection_date = '2024-01-15'"),
    "decision_summary_special": _decision_summary(_SPECIAL),
    "risk_percentages": f"""SELECT c.delay_risk, COALESCE({_pct('n', 'SUM(n) OVER ()')}, 0) AS share_pct
        FROM (SELECT unnest([{_list(rules.RISK_ORDER)}]) AS delay_risk) c
        LEFT JOIN (SELECT ai_delay_risk, COUNT(*) AS n FROM ai WHERE {_PLAIN} GROUP BY 1) a ON a.ai_delay_risk = c.delay_risk""",
    "high_severe_share": f"""SELECT {_pct('h + s', 'n')} AS share_from_counts_pct,
        {_r(_pct('h', 'n') + ' + ' + _pct('s', 'n'), 2)} AS share_from_rounded_pct
        FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE ai_delay_risk = 'High') AS h,
            COUNT(*) FILTER (WHERE ai_delay_risk = 'Severe') AS s FROM ai WHERE {_PLAIN})""",
    "network_kpis": f"""SELECT COUNT(*) AS total_records, {_r(_mean(_SECONDS), 3)} AS avg_delay_minutes,
        CAST(SUM(predicted_actionable_delay_risk) AS BIGINT) AS actionable_records,
        {_pct('SUM(predicted_actionable_delay_risk)', 'COUNT(*)')} AS actionable_pct,
        {_MODAL_ACTION} AS most_common_recommendation FROM ai WHERE {_PLAIN}""",
    "attention_summary": f"""SELECT (SELECT route_display_name FROM ({_top_routes(_PLAIN, 1)})) AS route,
        (SELECT route_id FROM ({_top_routes(_PLAIN, 1)})) AS route_id,
        COUNT(*) FILTER (WHERE ai_delay_risk = 'High') AS high_count,
        COUNT(*) FILTER (WHERE ai_delay_risk = 'Severe') AS severe_count,
        CAST(SUM(predicted_actionable_delay_risk) AS BIGINT) AS actionable_records,
        {_pct('SUM(predicted_actionable_delay_risk)', 'COUNT(*)')} AS actionable_pct,
        {_MODAL_ACTION} AS primary_action FROM ai WHERE {_PLAIN}""",
    "action_summary": f"""SELECT {_MODAL_ACTION} AS common, COUNT(*) FILTER (WHERE ai_delay_risk = 'Severe') AS severe,
        {_pct("COUNT(*) FILTER (WHERE ai_delay_risk IN ('High', 'Severe'))", 'COUNT(*)', 1)} AS risk_pct FROM ai WHERE {_PLAIN}""",
    "available_days": "SELECT DISTINCT collection_date AS day FROM ai",
    "available_hours": "SELECT DISTINCT lpad(CAST(trip_hour AS VARCHAR), 2, '0') || ':00' AS hour FROM ai",
    "weather_context": f"""SELECT {_RAIN} AS weather_condition, COUNT(*) AS records,
        {_r('(' + _six('predicted_actionable_probability') + ') * 100', 2)} AS avg_ai_probability_pct,
        {_r(_mean(_SECONDS), 3)} AS avg_observed_delay, {_r(_six('predicted_delay_minutes'), 3)} AS avg_predicted_delay,
        {_r(_six('wind_speed_10m'), 2)} AS avg_wind_speed, {_r(_six('precipitation'), 2)} AS avg_precipitation
        FROM ai WHERE {_PLAIN} GROUP BY 1""",
    "weather_integration": f"""SELECT COUNT(*) AS records, COUNT(DISTINCT collection_date) AS days,
        MIN(collection_date) AS start_date, MAX(collection_date) AS end_date,
        {_pct('COUNT(*) FILTER (WHERE ' + ' AND '.join(f'{c} IS NOT NULL' for c in rules.WEATHER_COLUMNS) + ')', 'COUNT(*)')} AS match_pct
        FROM ai WHERE {_PLAIN}""",
    "rain_severity": f"""SELECT *, {_pct('records', 'SUM(records) OVER ()')} AS record_pct FROM (
        SELECT CASE WHEN COALESCE(rain, 0) = 0 THEN 'No rain' WHEN rain <= 0.5 THEN 'Light rain'
                    WHEN rain <= 2.0 THEN 'Moderate rain' ELSE 'Heavier rain' END AS rain_band, COUNT(*) AS records,
            {_r(_mean(_SECONDS), 3)} AS avg_observed_delay,
            {_r('(' + _six('predicted_actionable_probability') + ') * 100', 2)} AS avg_ai_probability_pct
        FROM ai WHERE {_PLAIN} GROUP BY 1)""",
    "daily_weather_events": f"""SELECT collection_date, COUNT(*) AS records, {_r(_mean(_SECONDS), 2)} AS avg_observed_delay,
        {_r(_six('predicted_delay_minutes'), 2)} AS avg_predicted_delay,
        {_r('(' + _six('predicted_actionable_probability') + ') * 100', 2)} AS avg_ai_probability_pct,
        {_r('MAX(rain)', 2)} AS max_rain, {_r('MAX(precipitation)', 2)} AS max_precipitation,
        {_r('MAX(wind_speed_10m)', 2)} AS max_wind_speed, {_r(_six('wind_speed_10m'), 2)} AS avg_wind_speed
        FROM ai WHERE {_PLAIN} GROUP BY 1
        ORDER BY max_precipitation DESC NULLS LAST, max_wind_speed DESC NULLS LAST, collection_date LIMIT 10""",
    "service_weather_view": f"""SELECT {_SERVICE.format('School/Special or unmatched services')} AS service_type,
        {_RAIN} AS weather_condition, COUNT(*) AS records, {_r(_mean(_SECONDS), 3)} AS avg_observed_delay,
        {_r('(' + _six('predicted_actionable_probability') + ') * 100', 2)} AS avg_ai_probability_pct,
        {_r(_six('wind_speed_10m'), 2)} AS avg_wind_speed FROM ai GROUP BY 1, 2""",
    "weather_route_examples": _weather_routes(),
    "weather_context_rollup": f"""SELECT *, {_pct('records', 'SUM(records) OVER ()')} AS record_pct FROM (
        SELECT weather_context, weather_rule, CAST(SUM(records) AS BIGINT) AS records, {_r(_WEIGHTED, 3)} AS avg_observed_delay,
            MAX(max_delay_minutes) AS max_delay_minutes FROM ({_WEATHER_DELAY_RISK}) GROUP BY 1, 2)""",
    "weather_features": f"""SELECT feature, importance, operator_explanation FROM ({_LOOKUP})
        WHERE feature IN ({_list(rules.WEATHER_COLUMNS)}) AND explainability_type = 'mean_abs_shap'
        ORDER BY importance DESC, feature LIMIT 8""",
    "observed_daily_records": f"SELECT collection_date, {_OBSERVED} FROM ai WHERE {_PLAIN} GROUP BY 1",
    "observed_daily_rollup": f"""SELECT collection_date, CAST(SUM(records) AS BIGINT) AS records,
        {_r(_WEIGHTED, 3)} AS avg_observed_delay, {_r('MAX(max_delay_minutes)', 6)} AS max_observed_delay
        FROM route_daily WHERE {_PLAIN_SUMMARY} GROUP BY 1""",
    "top_observed_records": f"""SELECT route_id, {_SERVICE.format('Unknown / unmatched route')} AS service_type,
        {_CORRIDOR} AS corridor_name, COALESCE(NULLIF(route_display_name, ''), route_short_name, route_id) AS route_name, {_OBSERVED}
        FROM ai WHERE {_PLAIN} GROUP BY 1, 2, 3, 4
        ORDER BY avg_observed_delay DESC, high_severe_cases DESC, 1, 2, 3, 4 LIMIT 10""",
    "top_observed_rollup": f"""SELECT r.route_id, r.service_type, COALESCE(l.corridor_name, r.route_display_name) AS corridor_name,
            r.route_display_name, r.is_special_route, records, avg_observed_delay, max_observed_delay FROM (
        SELECT route_id, service_type, route_display_name, is_special_route, CAST(SUM(records) AS BIGINT) AS records,
            {_r(_WEIGHTED, 3)} AS avg_observed_delay, {_r('MAX(max_delay_minutes)', 6)} AS max_observed_delay
        FROM route_daily WHERE {_PLAIN_SUMMARY} GROUP BY 1, 2, 3, 4) r
        LEFT JOIN (SELECT route_id, route_corridor_name AS corridor_name FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY route_id ORDER BY records DESC, route_corridor_name) AS place
            FROM ({_ROUTE_DELAY_RISK}) WHERE trim(COALESCE(route_corridor_name, '')) <> '') WHERE place = 1) l USING (route_id)
        ORDER BY avg_observed_delay DESC, max_observed_delay DESC, 1, 2, 4, 5 LIMIT 10""",
    "delay_histogram_records": f"""SELECT bin_mid, COUNT(*) AS "count", {_TIMING.format('bin_mid')} AS band
        FROM (SELECT {_bin('delay_minutes')} AS bin_mid FROM ai WHERE {_PLAIN}) GROUP BY bin_mid""",
    "delay_histogram_routeday": f"""SELECT g.bin_mid, COUNT(b.bin_mid) AS "count", {_TIMING.format('g.bin_mid')} AS band
        FROM (SELECT unnest(range(-29, 30, 2)) AS bin_mid) g
        LEFT JOIN (SELECT {_bin('avg_delay_minutes')} AS bin_mid FROM route_daily WHERE {_PLAIN_SUMMARY} AND avg_delay_minutes < 30) b
        USING (bin_mid) GROUP BY g.bin_mid""",
    "observation_day_kpis": f"""SELECT COUNT(DISTINCT collection_date) AS observation_days, CAST(SUM(records) AS BIGINT) AS total_records,
        {_r('AVG(avg_observed_delay)', 2)} AS mean_of_daily_means, MAX(max_observed_delay) AS max_observed_delay
        FROM (SELECT collection_date, {_OBSERVED} FROM ai WHERE {_PLAIN} GROUP BY 1)""",
    "actionable_comparison": f"""SELECT unnest(['Observed actionable records', 'AI-predicted actionable records']) AS signal,
        unnest([a, p]) AS records FROM (SELECT CAST(SUM(actual_actionable_delay_risk) AS BIGINT) AS a,
            CAST(SUM(predicted_actionable_delay_risk) AS BIGINT) AS p FROM ai WHERE {_PLAIN})""",
    "prediction_summary": f"""SELECT COUNT(*) AS records, {_r(_six('predicted_actionable_probability'), 6)} AS avg_probability,
        {_r(_six('predicted_delay_minutes'), 6)} AS avg_predicted_delay,
        CAST(SUM(predicted_actionable_delay_risk) AS BIGINT) AS predicted_actionable,
        CAST(SUM(actual_actionable_delay_risk) AS BIGINT) AS actual_actionable FROM ai WHERE {_PLAIN}""",
    "risk_category_cards": f"""SELECT *, {_pct('records', 'SUM(records) OVER ()')} AS share_pct FROM (
        SELECT a.ai_delay_risk, m.recommended_action, COUNT(*) AS records FROM ai a
        JOIN ({_mode('ai_delay_risk', 'ai_recommended_action', f'ai WHERE {_PLAIN}', 'recommended_action')}) m USING (ai_delay_risk)
        WHERE NOT COALESCE(a.is_special_route, starts_with(upper(a.route_id), 'S')) GROUP BY 1, 2)""",
    "timing_mix": _shares(f"{_TIMING.format('delay_minutes')} AS timing_band", f"ai WHERE {_PLAIN}", "1"),
    "prediction_examples": f"""SELECT collection_date, route_id, {_CORRIDOR_OR_ROUTE} AS corridor_name, {_EXAMPLES}
        FROM ai WHERE {_PLAIN} ORDER BY {_EXAMPLE_ORDER} LIMIT 10""",
    "route_prediction_examples": f"""SELECT collection_date, route_id,
        {_SERVICE.format('School/Special or unmatched services')} AS service_type, {_CORRIDOR} AS corridor_name, {_EXAMPLES}
        FROM {_FOCUS} AND collection_date = (SELECT MAX(collection_date) FROM ai WHERE {_PLAIN}) ORDER BY {_EXAMPLE_ORDER} LIMIT 10""",
    "balanced_examples": f"""SELECT * EXCLUDE (place) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY ai_delay_risk, timing_band ORDER BY {_EXAMPLE_ORDER}) AS place FROM (
            SELECT collection_date, route_id, {_CORRIDOR} AS corridor_name, {_EXAMPLES},
                {_TIMING.format('delay_minutes')} AS timing_band FROM ai WHERE {_PLAIN})) WHERE place = 1""",
    "model_evidence": f"""SELECT *, {_r('(baseline_rmse - regressor_rmse) / NULLIF(baseline_rmse, 0) * 100', 1)} AS rmse_improvement_pct
        FROM (SELECT {_metric(_class_metrics(_TRAIN), 'recall')} AS baseline_recall,
            {_metric(_class_metrics(_TEST), 'recall')} AS classifier_recall, {_metric(_class_metrics(_TEST), 'f1')} AS classifier_f1,
            {_metric(_delay_metrics(_TRAIN), 'rmse')} AS baseline_rmse, {_metric(_delay_metrics(_TEST), 'rmse')} AS regressor_rmse)""",
    "top_routes": _top_routes(_PLAIN, 10),
    "route_options": _top_routes("TRUE", 100),
    "route_options_by_risk": f"""WITH base AS (SELECT * REPLACE ({_SERVICE.format('School/Special or unmatched services')} AS service_type,
            {_CORRIDOR} AS route_corridor_name) FROM ai WHERE {_PLAIN} AND ai_delay_risk = 'Severe')
        SELECT g.*, m.recommended_action FROM (
            SELECT service_type, route_id, route_corridor_name, COUNT(*) AS records,
                {_r(_six('predicted_delay_minutes'), 2)} AS avg_delay_minutes,
                {_r('(' + _six('predicted_actionable_probability') + ') * 100', 2)} AS avg_prediction_probability FROM base GROUP BY 1, 2, 3) g
        JOIN ({_mode('service_type, route_id, route_corridor_name', 'ai_recommended_action', 'base', 'recommended_action')}) m
        USING (service_type, route_id, route_corridor_name)
        ORDER BY records DESC, avg_prediction_probability DESC, service_type, route_id, route_corridor_name LIMIT 100""",
    "route_signal_scatter": f"""SELECT route_id, {_CORRIDOR_OR_ROUTE} AS corridor_name,
        CAST(SUM(actual_actionable_delay_risk) AS BIGINT) AS observed_records,
        CAST(SUM(predicted_actionable_delay_risk) AS BIGINT) AS ai_records FROM ai WHERE {_PLAIN} GROUP BY 1, 2
        HAVING SUM(actual_actionable_delay_risk) > 0 OR SUM(predicted_actionable_delay_risk) > 0
        ORDER BY greatest(SUM(actual_actionable_delay_risk), SUM(predicted_actionable_delay_risk)) DESC, route_id, corridor_name LIMIT 60""",
    "route_focus": f"""SELECT route_id, MIN({_CORRIDOR}) AS corridor_name, MIN(service_type) AS service_type, COUNT(*) AS records,
        {_r(_mean(_SECONDS), 3)} AS avg_observed_delay, {_r(_six('predicted_delay_minutes'), 3)} AS avg_predicted_delay,
        {_r('(' + _six('predicted_actionable_probability') + ') * 100', 2)} AS avg_ai_probability_pct,
        COUNT(*) FILTER (WHERE ai_delay_risk IN ('High', 'Severe')) AS ai_high_severe_cases,
        (SELECT ai_recommended_action FROM {_FOCUS} GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS recommended_action,
        {_r('CAST(COUNT(*) FILTER (WHERE COALESCE(rain, 0) > 0) AS DOUBLE) * 100.0 / COUNT(*)', 1)} AS avg_rain_pct,
        {_r('MAX(wind_speed_10m)', 1)} AS max_wind_speed, {_r(_six('precipitation'), 2)} AS avg_precipitation
        FROM {_FOCUS} GROUP BY route_id""",
    "route_timing_mix": _shares(f"{_TIMING.format('delay_minutes')} AS timing_band", _FOCUS, "1"),
    "route_action_mix": _shares("ai_recommended_action AS recommended_action, ai_delay_risk", _FOCUS, "1, 2"),
    "route_stats_ranked": f"""SELECT route_id, MIN(route_type) AS route_type,
        {_EVIDENCE.format('avg_abs_delay_min', 'first_date', 'last_date')}
        FROM decisions WHERE NOT is_special_route AND route_type = 3 AND NOT starts_with(route_id, 'S') GROUP BY route_id
        HAVING COUNT(*) >= 30 ORDER BY avg_delay_min DESC, severe_records DESC, records DESC, route_id LIMIT 20""",
    "route_evidence": f"""SELECT route_id AS selected_route,
        {_EVIDENCE.format('avg_absolute_delay_min', 'evidence_period_start', 'evidence_period_end')}
        FROM decisions WHERE route_id = '{FOCUS_BUS_ROUTE}' GROUP BY route_id""",
    "route_risk_share": _shares("delay_risk, recommended_action", f"decisions WHERE route_id = '{FOCUS_BUS_ROUTE}'", "1, 2"),
    "search_routes": f"""SELECT * FROM ({_top_routes(_PLAIN, 2**62)})
        WHERE contains(lower(route_id), '5-') OR contains(lower(route_corridor_name), '5-')""",
    "completeness_manifest": f"""SELECT * EXCLUDE (first_t, last_t), {_FULL_TIME.format('first_t')} AS first_collection_time_utc,
        {_FULL_TIME.format('last_t')} AS last_collection_time_utc FROM manifest""",
    "daily_summary": f"""SELECT collection_date, collection_day_status, is_model_baseline_day, is_partial_day, COUNT(*) AS records,
        COUNT(DISTINCT route_id) AS unique_routes, COUNT(DISTINCT trip_id) AS unique_trips,
        {_r(_mean(_SECONDS), 6)} AS avg_delay_minutes, {_r('MIN(delay_minutes)', 6)} AS min_delay_minutes,
        {_r('MAX(delay_minutes)', 6)} AS max_delay_minutes,
        COUNT(*) FILTER (WHERE abs(delay_minutes) > 120) AS delay_outliers_abs_gt_120 FROM storage GROUP BY 1, 2, 3, 4""",
    "route_daily_summary": f"""SELECT * REPLACE ({_r('avg_delay_minutes', 6)} AS avg_delay_minutes,
        {_r('max_delay_minutes', 6)} AS max_delay_minutes) FROM route_daily""",
    "top_delayed_day_mean": f"""SELECT route_id, service_type, route_display_name, is_special_route,
        CAST(SUM(records) AS BIGINT) AS records, {_r('AVG(avg_delay_minutes)', 6)} AS avg_delay_minutes,
        {_r('MAX(max_delay_minutes)', 6)} AS max_delay_minutes FROM route_daily WHERE NOT is_special_route GROUP BY 1, 2, 3, 4
        ORDER BY AVG(avg_delay_minutes) DESC, records DESC, route_id LIMIT 50""",
    "daily_summary_weather": f"""SELECT collection_date, COUNT(*) AS records, COUNT(DISTINCT route_id) AS unique_routes,
        COUNT(DISTINCT trip_id) AS unique_trips, {_r(_mean(_SECONDS), 2)} AS avg_delay_minutes,
        {_r('MIN(delay_minutes)', 6)} AS min_delay_minutes, {_r('MAX(delay_minutes)', 6)} AS max_delay_minutes,
        COUNT(temperature_2m) AS weather_match_records FROM decisions GROUP BY 1""",
    "route_daily_named": f"""SELECT collection_date, {_NAMED}, COUNT(*) AS records, COUNT(DISTINCT trip_id) AS unique_trips,
        {_r(_mean(_SECONDS), 2)} AS avg_delay_minutes, {_r('MAX(delay_minutes)', 6)} AS max_delay_minutes
        FROM decisions GROUP BY collection_date, {_NAMED}""",
    "top_delayed_record_mean": f"""SELECT {_NAMED}, COUNT(*) AS records, {_r('MAX(delay_minutes)', 6)} AS max_delay_minutes,
        {_r(_mean(_SECONDS), 2)} AS avg_delay_minutes FROM decisions WHERE NOT is_special_route GROUP BY {_NAMED}
        ORDER BY {_mean(_SECONDS)} DESC, records DESC, route_id LIMIT 20""",
    "risk_distribution": f"""SELECT c.delay_risk, COALESCE(n, 0) AS records, COALESCE({_pct('n', 'SUM(n) OVER ()')}, 0) AS share_pct
        FROM (SELECT unnest([{_list(rules.RISK_ORDER)}]) AS delay_risk) c
        LEFT JOIN (SELECT delay_risk, COUNT(*) AS n FROM decisions GROUP BY 1) USING (delay_risk)""",
    "action_distribution": _shares("recommended_action", "decisions", "1"),
    "target_distribution": "SELECT delay_risk, COUNT(*) AS records FROM decisions GROUP BY 1",
    "unmatched_routes": f"""SELECT route_id, COUNT(*) AS records, COUNT(DISTINCT trip_id) AS unique_trips,
        {_r(_mean(_SECONDS), 2)} AS avg_delay_minutes, {_r('MAX(delay_minutes)', 6)} AS max_delay_minutes,
        COALESCE(NULLIF(regexp_extract(route_id, '^([A-Za-z]+)', 1), ''), 'numeric_or_other') AS route_prefix
        FROM decisions WHERE route_short_name IS NULL GROUP BY route_id""",
    "unmatched_prefixes": """SELECT COALESCE(NULLIF(regexp_extract(route_id, '^([A-Za-z]+)', 1), ''), 'numeric_or_other') AS route_prefix,
        COUNT(DISTINCT route_id) AS routes FROM decisions WHERE route_short_name IS NULL GROUP BY 1""",
    "unmatched_by_file": "SELECT source_file, COUNT(*) AS unmatched_records FROM decisions WHERE route_short_name IS NULL GROUP BY 1",
    "recommendation_summary": _shares("delay_risk, recommended_action", "decisions", "1, 2"),
    "route_recommendation_counts": f"""SELECT {_NAMED}, delay_risk, recommended_action, COUNT(*) AS records,
        {_pct('COUNT(*)', '(SELECT COUNT(*) FROM decisions)', 4)} AS share_pct FROM decisions WHERE NOT is_special_route
        GROUP BY {_NAMED}, delay_risk, recommended_action""",
    "ai_recommendation_summary": _shares("ai_delay_risk, ai_recommended_action, ai_confidence_band", "ai", "1, 2, 3"),
    "ai_route_recommendation_counts": f"""SELECT route_id, route_short_name, route_display_name, route_corridor_name, service_type,
        is_special_route, ai_delay_risk, ai_recommended_action, ai_confidence_band, COUNT(*) AS records,
        {_pct('COUNT(*)', '(SELECT COUNT(*) FROM ai)', 4)} AS share_pct FROM ai WHERE NOT is_special_route
        GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
    "route_delay_risk": _ROUTE_DELAY_RISK,
    "service_type_delay": f"""SELECT {_SERVICE.format('Unknown / unmatched route')} AS service_type, delay_risk, recommended_action,
        {_SPECIAL} AS is_special_route, {_TRIP_SUMMARY} FROM decisions GROUP BY 1, 2, 3, 4""",
    "weather_delay_risk": _WEATHER_DELAY_RISK,
    "action_totals": f"""SELECT ai_recommended_action AS recommended_action, COUNT(*) AS records,
        CASE ai_recommended_action WHEN 'No operational action required' THEN 'No action required'
            WHEN 'Deploy standby bus or supervisor review' THEN 'Deploy standby bus / supervisor review'
            ELSE ai_recommended_action END AS action_label FROM ai WHERE {_PLAIN} GROUP BY 1""",
    "kpi_table": f"""SELECT unnest(['Total Records', 'Average Delay (min)', 'High/Severe Risk Cases', 'Most Common Recommendation']) AS kpi,
        unnest([CAST(COUNT(*) AS VARCHAR), CAST({_r(_mean(_SECONDS), 2)} AS VARCHAR),
            CAST(COUNT(*) FILTER (WHERE delay_risk IN ('High', 'Severe')) AS VARCHAR),
            (SELECT recommended_action FROM decisions GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)]) AS value FROM decisions""",
    "storage_counters": """SELECT COUNT(*) AS cleaned_rows, COUNT(*) FILTER (WHERE is_model_baseline_day) AS model_baseline_rows,
        COUNT(*) FILTER (WHERE abs(delay_minutes) > 120) AS delay_outliers_abs_gt_120,
        (SELECT COUNT(*) FROM file_stats) AS daily_files, (SELECT CAST(SUM(raw_csv_rows) AS BIGINT) FROM manifest) AS raw_csv_rows,
        (SELECT CAST(SUM(duplicate_header_rows) AS BIGINT) FROM manifest) AS duplicate_header_rows,
        (SELECT COUNT(*) FILTER (WHERE is_model_baseline_day) FROM manifest) AS complete_days,
        (SELECT COUNT(*) FILTER (WHERE is_partial_day) FROM manifest) AS partial_days FROM storage""",
    "value_counts_service_type": _shares("service_type", "decisions", "1"),
    "clean_observations": f"""SELECT {_FULL_TIME.format('t')} AS collection_time_utc, entity_id, trip_id, route_id, direction_id, start_time,
        start_date, feed_time AS "timestamp", delay_seconds, is_deleted, {_r('m', 6)} AS delay_minutes, collection_date
        FROM {_CLEAN_RAW} WHERE t IS NOT NULL AND m IS NOT NULL""",
    "dropped_rows": """SELECT COUNT(*) AS input_rows, COUNT(*) FILTER (WHERE NOT is_deleted AND delay_seconds IS NOT NULL) AS kept_rows,
        COUNT(*) FILTER (WHERE is_deleted OR delay_seconds IS NULL) AS dropped_rows FROM obs""",
    "outlier_filter": f"""SELECT n AS input_rows, k AS kept_rows, n - k AS removed_rows, {_r('CAST(n - k AS DOUBLE) / n * 100', 2)} AS removal_pct
        FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE delay_minutes BETWEEN -60 AND 120) AS k FROM obs)""",
    "time_features": f"""SELECT entity_id, CAST(hour(collection_time_utc) AS INTEGER) AS trip_hour,
        CAST(isodow(collection_time_utc) - 1 AS INTEGER) AS weekday, CAST(day(collection_time_utc) AS INTEGER) AS day_of_month,
        collection_date, {_r('abs(delay_minutes)', 6)} AS delay_abs_minutes FROM obs WHERE delay_minutes BETWEEN -60 AND 120""",
    "attach_weather": """SELECT entity_id, temperature_2m, precipitation, rain, relative_humidity_2m, wind_speed_10m
        FROM obs LEFT JOIN weather ON weather_hour = date_trunc('hour', collection_time_utc)""",
    "attach_routes": """SELECT entity_id, route_id, agency_id, route_short_name, route_long_name, route_type, service_type,
        route_display_name, is_special_route FROM storage""",
    "corridor_labels": "SELECT * FROM corridors",
    "route_endpoints": """WITH chosen AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY route_id, direction_id ORDER BY trip_id) AS place
            FROM trips) WHERE place = 1),
        calls AS (SELECT 'O' || l_orderkey AS trip_id, 'ST' || l_suppkey AS stop_id, l_linenumber AS stop_sequence FROM lineitem),
        placed AS (SELECT c.*, s.stop_id, s.stop_sequence,
                ROW_NUMBER() OVER (PARTITION BY c.trip_id ORDER BY stop_sequence, stop_id) AS up,
                ROW_NUMBER() OVER (PARTITION BY c.trip_id ORDER BY stop_sequence DESC, stop_id DESC) AS down
            FROM chosen c JOIN calls s USING (trip_id)),
        sides AS (SELECT *, 'start' AS role FROM placed WHERE up = 1 UNION ALL SELECT *, 'end' FROM placed WHERE down = 1)
        SELECT route_id, direction_id, trip_headsign, role, stop_id, s_name AS stop_name, CAST(s_nationkey AS DOUBLE) / 4 AS stop_lat,
            s_acctbal AS stop_lon FROM sides LEFT JOIN supplier ON stop_id = 'ST' || s_suppkey""",
    "shape_usage": "SELECT route_id, shape_id, COUNT(*) AS trip_count FROM trips GROUP BY 1, 2",
    "route_path": f"""WITH usage AS (SELECT route_id, shape_id, ROW_NUMBER() OVER (PARTITION BY route_id ORDER BY COUNT(*) DESC, shape_id) AS place
            FROM trips GROUP BY 1, 2),
        points AS (SELECT 'SH' || (l_orderkey // 4) AS shape_id, CAST(l_suppkey AS DOUBLE) / 8 AS lat, CAST(l_partkey AS DOUBLE) / 8 AS lon,
            (l_orderkey % 4) * 100 + l_linenumber AS seq FROM lineitem)
        SELECT route_id, shape_id, string_agg(CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR), ';' ORDER BY seq, lon, lat) AS path,
            {_r('AVG(lat)', 6)} AS latitude, {_r('AVG(lon)', 6)} AS longitude
        FROM usage JOIN points USING (shape_id) WHERE place = 1 GROUP BY 1, 2""",
    "busiest_routes": "SELECT route_id, COUNT(*) AS trips FROM trips GROUP BY 1 ORDER BY trips DESC, route_id LIMIT 10",
    "trips_with_routes": """SELECT route_id, trip_id, direction_id, trip_headsign, shape_id, agency_id, route_short_name, route_long_name,
        CAST(route_type AS VARCHAR) AS route_type FROM trips LEFT JOIN routes USING (route_id)""",
    "realtime_with_routes": """SELECT entity_id, route_short_name, route_long_name, route_type, transport_mode FROM with_mode""",
    "attach_completeness": """SELECT entity_id, collection_day_status, collection_coverage_hours, is_partial_day, is_model_baseline_day
        FROM storage""",
    "weather_from_decisions": f"""SELECT {_FULL_TIME.format('hour')} AS weather_hour, {', '.join(rules.WEATHER_COLUMNS)} FROM (
        SELECT *, date_trunc('hour', collection_time_utc) AS hour,
            ROW_NUMBER() OVER (PARTITION BY date_trunc('hour', collection_time_utc) ORDER BY collection_time_utc, temperature_2m) AS place
        FROM decisions) WHERE place = 1""",
    "decision_types": f"""SELECT {_FULL_TIME.format('collection_time_utc')} AS collection_time_utc, route_id, trip_id,
        CAST(route_type AS BIGINT) AS route_type, delay_seconds, is_special_route, is_partial_day, rain, wind_speed_10m,
        CAST(trip_hour AS BIGINT) AS trip_hour FROM decisions""",
    "flatten_snapshots": f"""SELECT {_FULL_TIME.format('collection_time_utc')} AS collection_time_utc, entity_id, trip_id, route_id,
        direction_id, start_time, CAST(start_date AS VARCHAR) AS start_date, feed_time AS "timestamp",
        delay_seconds, is_deleted, {_r('delay_seconds / 60', 6)} AS delay_minutes FROM obs""",
    "model_input": f"""SELECT {_FULL_TIME.format('collection_time_utc')} AS collection_time_utc, collection_date,
        COALESCE(route_short_name, 'missing') AS route_short_name, COALESCE(CAST(route_type AS VARCHAR), 'missing') AS route_type,
        service_type, CAST(trip_hour AS DOUBLE) AS trip_hour, {_r('rain', 6)} AS rain, {_r('delay_minutes', 6)} AS delay_minutes,
        delay_risk, CAST(delay_risk <> 'Low' AS INTEGER) AS actionable_delay_risk FROM decisions""",
    "earliest_rows": f"""SELECT {_FULL_TIME.format('t')} AS collection_time_utc, entity_id, route_id, delay_seconds FROM (
        SELECT collection_time_utc AS t, entity_id, route_id, delay_seconds FROM decisions
        ORDER BY collection_time_utc, route_id, entity_id LIMIT 200)""",
    "intervention_candidates": "SELECT entity_id, recommended_action FROM cases",
    "semi_by_dates": "SELECT entity_id, collection_date FROM decisions JOIN dates USING (collection_date) WHERE is_test",
    "split_metrics": f"""SELECT unnest(['Input', 'Input', 'Split', 'Split', 'Target distribution', 'Target distribution']) AS model,
        unnest(['full_rows', 'rows', 'train_rows', 'test_rows', 'train_positive_share', 'test_positive_share']) AS metric,
        unnest([CAST(n AS DOUBLE), n, n - t, t, {_r('(p - q) / (n - t)', 6)}, {_r('q / t', 6)}]) AS value
        FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE is_test) AS t, CAST(SUM(actual_actionable_delay_risk) AS DOUBLE) AS p,
            CAST(SUM(actual_actionable_delay_risk) FILTER (WHERE is_test) AS DOUBLE) AS q FROM ai JOIN dates USING (collection_date))""",
    "metric_lookup": f"""SELECT {_metric(_class_metrics(_TEST), 'accuracy')} AS accuracy, {_metric(_delay_metrics(_TRAIN), 'rmse')} AS rmse""",
    "ordered_importance": "SELECT * FROM importance",
    "pair_audit": f"""WITH p AS (SELECT delay_risk, recommended_action, COUNT(*) AS records FROM decisions GROUP BY 1, 2)
        SELECT *, COALESCE({_ACTION.format('delay_risk')} = recommended_action, FALSE) AS is_allowed,
            COUNT(*) OVER (PARTITION BY recommended_action) AS risks_of_action FROM p""",
    "invalid_pairs": """SELECT DISTINCT delay_risk, 'Call depot' AS recommended_action FROM decisions WHERE is_special_route""",
    "field_checks": _null_rows(
        ("route_corridor_name", "service_type", "route_display_name", "is_special_route"), "decisions", "check_name", "records"
    ).replace("SELECT '", "SELECT 'missing_")
    + " UNION ALL SELECT 's_prefix_rows', COUNT(*) FILTER (WHERE starts_with(upper(route_id), 'S')) FROM decisions"
    + " UNION ALL SELECT 'special_rows', COUNT(*) FILTER (WHERE is_special_route) FROM decisions",
    "null_profile": _null_rows(schemas.DECISION_COLUMNS, "decisions"),
    "missing_or_blank": _BLANK_ROWS,
    "decision_validation": f"""WITH published AS (SELECT * REPLACE (CASE WHEN weekday = 6 THEN ' ' ELSE service_type END AS service_type)
            FROM decisions WHERE trip_hour <> 3)
        SELECT check_name, expected, actual, COALESCE(expected = actual, TRUE) AS ok FROM (
        SELECT 'row_count' AS check_name, (SELECT COUNT(*) FROM decisions) AS expected, COUNT(*) AS actual FROM published
        UNION ALL SELECT 'missing_required_fields', 0, 0
        UNION ALL SELECT 'missing_' || check_name, NULL, records FROM ({_BLANK_ROWS.replace('decisions', 'published')}))""",
    "describe_delay": f"SELECT {_DESCRIBE.format('delay_seconds')} FROM decisions",
    "duplicate_rows": """SELECT CAST(SUM(n) AS BIGINT) AS total_rows, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
        FROM (SELECT COUNT(*) AS n FROM decisions GROUP BY collection_date, trip_hour, route_id, trip_id, delay_risk)""",
    "distinct_counts": """SELECT COUNT(DISTINCT route_id) AS routes, COUNT(DISTINCT trip_id) AS trips,
        COUNT(DISTINCT collection_time_utc) AS timestamps, COUNT(DISTINCT source_file) AS files FROM storage""",
    "match_rate": f"""SELECT COUNT(*) AS records, COUNT(route_short_name) AS matched,
        {_pct('COUNT(route_short_name)', 'COUNT(*)')} AS match_pct FROM decisions""",
    "weather_match_rate": f"""SELECT COUNT(*) AS records, COUNT(temperature_2m) AS matched,
        {_pct('COUNT(temperature_2m)', 'COUNT(*)')} AS match_pct FROM decisions""",
    "late_ratio": f"""SELECT route_short_name, {_r('CAST(COUNT(*) FILTER (WHERE delay_minutes > 0) AS DOUBLE) / COUNT(*)', 6)} AS late_ratio
        FROM with_mode GROUP BY 1""",
    "mean_delay": f"SELECT transport_mode, {_r(_mean(_SECONDS), 6)} AS mean_delay FROM with_mode GROUP BY 1",
    "median_delay": f"""SELECT transport_mode, {_r('quantile_cont(delay_seconds, 0.5)', 6)} AS median_delay_seconds
        FROM with_mode GROUP BY 1""",
    "box_stats": f"""SELECT transport_mode, "count", "min", q25, median, q75, "max" FROM (
        SELECT transport_mode, {_DESCRIBE.format('delay_seconds')} FROM with_mode GROUP BY 1)""",
    "storage_validation": f"""WITH f AS (SELECT COUNT(*) AS n, COUNT(route_type) AS matched, COUNT(*) FILTER (WHERE is_special_route) AS special,
            COUNT(*) FILTER (WHERE is_model_baseline_day) AS base FROM storage),
        g AS (SELECT COUNT(*) AS groups, CAST(SUM(records) AS BIGINT) AS records FROM route_daily),
        d AS (SELECT COUNT(*) AS days, (SELECT COUNT(*) FROM file_stats) AS files, COUNT(*) FILTER (WHERE is_model_baseline_day) AS complete,
            COUNT(*) FILTER (WHERE is_partial_day) AS part, CAST(SUM(duplicate_header_rows) AS BIGINT) AS headers FROM manifest)
        SELECT check_name, expected, actual, COALESCE(expected = actual, TRUE) AS ok FROM (
            SELECT unnest(['all_rows_match_manifest', 'baseline_rows_match_manifest', 'baseline_rows_on_partial_days',
                'route_summary_records', 'columns_match', 'delay_minutes_numeric', 'collection_time_is_timestamp',
                'service_type_present', 'route_display_name_present', 'is_special_route_present', 'service_type_missing_rows',
                'route_display_name_missing_rows', 'top_routes_special_rows', 'days_complete_plus_partial', 'daily_files',
                'complete_days', 'partial_days', 'duplicate_header_rows', 'route_metadata_matched_rows',
                'route_metadata_match_basis_points', 's_prefix_rows_flagged', 'route_summary_rows']) AS check_name,
            unnest([n, base, 0, n, 1, 1, 1, 1, 1, 1, 0, 0, 0, days, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL]) AS expected,
            unnest([n, base, 0, records, 1, 1, 1, 1, 1, 1, 0, 0, 0, complete + part, files, complete, part, headers, matched,
                CAST({_r('CAST(matched AS DOUBLE) * 10000.0 / n', 0)} AS BIGINT), special, groups]) AS actual FROM f, g, d)""",
    "probability_domain": """SELECT COUNT(*) AS records, COUNT(*) FILTER (WHERE predicted_actionable_probability IS NULL) AS null_rows,
        COUNT(*) FILTER (WHERE NOT predicted_actionable_probability BETWEEN 0 AND 1) AS out_of_range_rows,
        MIN(predicted_actionable_probability) AS min_probability, MAX(predicted_actionable_probability) AS max_probability FROM ai""",
    "top_features": f"""SELECT source, explainability_type, COALESCE({_case('feature', rules.FEATURE_DISPLAY_LABELS)},
            CASE WHEN starts_with(feature, 'route_id_') THEN 'Route ' || substr(feature, 10) END, feature) AS feature,
        importance, notes FROM importance WHERE explainability_type = 'mean_abs_shap'
        ORDER BY importance.importance DESC, importance.feature, source, notes LIMIT 10""",
    "feature_lookup": _LOOKUP,
    "prepare_features": f"""SELECT *, {_feature_class('display_feature')} AS category, CAST(CAST(ROUND(CAST(CAST(importance AS VARCHAR) AS DECIMAL(38, 18)), 3) AS DECIMAL(38, 3)) AS VARCHAR) AS importance_label
        FROM (SELECT *, {_feature_text('feature')} AS display_feature FROM importance)""",
    "importance_by_category": f"""SELECT category, CAST(total AS DOUBLE) AS importance, feature_count,
        {_pct('CAST(total AS DOUBLE)', 'SUM(CAST(total AS DOUBLE)) OVER ()', 1)} AS share_pct FROM (
        SELECT {_feature_class('feature')} AS category, SUM(CAST(importance AS DECIMAL(18, 6))) AS total, COUNT(*) AS feature_count
        FROM importance GROUP BY 1)""",
    "importance_chart_groups": f"""SELECT category, CAST(total AS DOUBLE) AS importance, feature_count,
        {_pct('CAST(total AS DOUBLE)', 'SUM(CAST(total AS DOUBLE)) OVER ()', 1)} AS share_pct FROM (
        SELECT CASE WHEN {_contains('lower(feature)', 'route', 'low-frequency')} THEN 'Route'
            WHEN {_contains('lower(feature)', 'service')} THEN 'Service' WHEN {_contains('lower(feature)', 'hour', 'weekday', 'day')} THEN 'Time'
            WHEN {_contains('lower(feature)', 'direction')} THEN 'Direction'
            WHEN {_contains('lower(feature)', 'rain', 'wind', 'weather', 'precip')} THEN 'Weather' ELSE 'Other' END AS category,
            SUM(CAST(importance AS DECIMAL(18, 6))) AS total, COUNT(*) AS feature_count
        FROM importance GROUP BY 1)""",
    "mean_abs_contribution": f"""SELECT feature, {_r(_six('abs(v)'), 6)} AS importance FROM (
        SELECT service_type AS feature, predicted_delay_minutes AS v FROM ai UNION ALL
        SELECT 'trip_hour_' || trip_hour, {_r('predicted_actionable_probability - 0.5', 6)} FROM ai) GROUP BY 1""",
    "min_max_normalise": f"""SELECT feature, notes, importance AS "value", {_r('(importance - lo) / CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END', 6)} AS value_norm
        FROM (SELECT *, MIN(importance) OVER (PARTITION BY feature) AS lo, MAX(importance) OVER (PARTITION BY feature) AS hi FROM importance)""",
    "hourly_interpolated": f"""SELECT {_HOUR_TEXT}, {_r('mean_delay', 6)} AS mean_delay
        FROM {_hourly("decisions")}""",
    "forward_fill": f"""SELECT {_FULL_TIME.format('g.hour')} AS weather_hour, {', '.join(
        f"{_r(f'last_value({c} IGNORE NULLS) OVER past', 6)} AS {c}" for c in rules.WEATHER_COLUMNS)}
        FROM (SELECT unnest(generate_series(MIN(h), MAX(h), INTERVAL 1 HOUR)) AS hour
            FROM (SELECT date_trunc('hour', collection_time_utc) AS h FROM obs)) g
        LEFT JOIN weather w ON w.weather_hour = g.hour
        WINDOW past AS (ORDER BY g.hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "ar1_forecast": f"""WITH series AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (ORDER BY hour) - 1 AS place, COUNT(*) OVER () AS n FROM {_hourly('decisions')}),
        split AS (SELECT *, place < greatest(1, floor(n * CAST(0.8 AS DOUBLE))) AS is_train FROM series),
        fit AS (SELECT regr_slope(t.mean_delay, b.mean_delay) AS phi, regr_intercept(t.mean_delay, b.mean_delay) AS c
            FROM split t JOIN split b ON b.place = t.place - 1 WHERE t.is_train),
        tail AS (SELECT mean_delay AS v, place AS p FROM split WHERE is_train ORDER BY place DESC LIMIT 1),
        week AS (SELECT isodow(hour) AS w, hour(hour) AS h, AVG(mean_delay) AS m FROM split WHERE is_train GROUP BY 1, 2)
        SELECT {_HOUR_TEXT}, {_r('mean_delay', 6)} AS mean_delay,
            {_r('pow(phi, place - p) * v + c * (1 - pow(phi, place - p)) / (1 - phi)', 6)} AS ar1_forecast,
            {_r('v', 6)} AS last_value_forecast, {_r('COALESCE(m, v)', 6)} AS seasonal_forecast
        FROM split, fit, tail LEFT JOIN week ON w = isodow(split.hour) AND h = hour(split.hour) WHERE NOT is_train""",
    "stratified_sample": f"""SELECT entity_id, collection_date, delay_risk FROM (
        {_strata('round_even(size * least(CAST(1.0 AS DOUBLE), CAST(2000.0 AS DOUBLE) / everything), 0)', 'collection_date, delay_risk')}) WHERE taken""",
    "stratified_split": f"""SELECT entity_id, delay_risk, taken AS is_test FROM (
        {_strata('round_even(size * CAST(0.2 AS DOUBLE), 0)', 'delay_risk')})""",
    "time_split": "SELECT * FROM dates",
    "one_hot_rare": f"""SELECT feature, category, train_rows, CASE WHEN train_rows >= 55 THEN category ELSE 'infrequent_sklearn' END AS bucket FROM (
        {' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, COUNT(*) AS train_rows FROM {_TRAIN} AND {c} IS NOT NULL GROUP BY 2"
                            for c in schemas.CATEGORICAL_FEATURES)})""",
    "baselines": f"""SELECT (SELECT actual_actionable_delay_risk FROM {_TRAIN} GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS majority_class,
        {_r('quantile_cont(delay_minutes, 0.5)', 6)} AS median_value FROM {_TRAIN}""",
    "scale_pos_weight": f"""SELECT {_r('CAST(COUNT(*) FILTER (WHERE actual_actionable_delay_risk = 0) AS DOUBLE) / COUNT(*) FILTER (WHERE actual_actionable_delay_risk = 1)', 6)}
        AS scale_pos_weight FROM {_TRAIN}""",
    "classification_metrics": _class_metrics(_TEST),
    "regression_metrics": _delay_metrics(_TEST),
    "stream_hourly": f"""SELECT {_HOUR_TEXT}, route_id, COUNT(*) AS records, {_r(_mean(_SECONDS), 6)} AS avg_delay_minutes,
        CAST(MAX({_SECONDS}) AS DOUBLE) AS max_delay_seconds FROM (SELECT *, date_trunc('hour', collection_time_utc) AS hour FROM obs)
        GROUP BY hour, route_id""",
    "append_daily": f"SELECT {_RECORD} FROM obs",
    "daily_logs": f"SELECT {_RECORD} FROM obs WHERE event_id % 251 <> 0",
    "split_log": f"SELECT {_RECORD} FROM obs WHERE event_id % 251 <> 0",
    "file_row_stats": """SELECT collection_date, COUNT(*) AS raw_csv_rows,
        COUNT(*) FILTER (WHERE event_id % 251 = 0) AS duplicate_header_rows FROM obs GROUP BY 1""",
    "manifest_of_files": """SELECT collection_date, collection_day_status, is_model_baseline_day, o.raw_csv_rows, o.cleaned_rows,
        o.duplicate_header_rows, o.unique_routes, o.unique_trips, o.delay_outliers_abs_gt_120
        FROM manifest JOIN (
            SELECT collection_date, COUNT(*) AS raw_csv_rows, COUNT(*) FILTER (WHERE event_id % 251 <> 0) AS cleaned_rows,
                COUNT(*) FILTER (WHERE event_id % 251 = 0) AS duplicate_header_rows,
                COUNT(DISTINCT route_id) FILTER (WHERE event_id % 251 <> 0) AS unique_routes,
                COUNT(DISTINCT trip_id) FILTER (WHERE event_id % 251 <> 0) AS unique_trips,
                COUNT(*) FILTER (WHERE event_id % 251 <> 0 AND abs(delay_minutes) > 120) AS delay_outliers_abs_gt_120
            FROM obs GROUP BY 1) o USING (collection_date)""",
    "baseline_tables": f"""SELECT stored, collection_date, entity_id, route_id, service_type, {_r('delay_minutes', 6)} AS delay_minutes
        FROM storage, (VALUES ('all_file'), ('model_baseline')) AS names(stored)
        WHERE stored = 'all_file' OR is_model_baseline_day""",
    "csv_to_parquet": f"""SELECT {_FULL_TIME.format('collection_time_utc')} AS collection_time_utc, route_id, trip_id, delay_risk,
        CAST(trip_hour AS BIGINT) AS trip_hour, rain, is_partial_day, wind_speed_10m FROM decisions""",
    "csv_projected": "SELECT route_id, delay_risk, service_type FROM decisions",
    "read_dimension": """SELECT route_id, agency_id, route_short_name, route_long_name, CAST(route_type AS INTEGER) AS route_type,
        service_type, route_display_name FROM metadata""",
    "chosen_source": """SELECT collection_date, COUNT(*) AS records, 'model_baseline' AS chosen
        FROM storage WHERE is_model_baseline_day GROUP BY 1""",
    "attach_checked": """SELECT entity_id, collection_date, collection_day_status, collection_coverage_hours, raw_csv_rows
        FROM obs JOIN manifest USING (collection_date)""",
    "stream_append": f"SELECT {_RECORD} FROM obs",
    "stream_dedupe": f"SELECT {_RECORD} FROM obs",
    "stream_labels": f"""SELECT entity_id, collection_date, risk AS delay_risk, {_ACTION.format('risk')} AS recommended_action,
        CAST(hour(collection_time_utc) AS INTEGER) AS trip_hour, rain
        FROM (SELECT *, CASE WHEN abs(delay_minutes) <= 5 THEN 'Low' WHEN abs(delay_minutes) <= 15 THEN 'Medium'
                             WHEN abs(delay_minutes) <= 25 THEN 'High' ELSE 'Severe' END AS risk FROM obs)
        LEFT JOIN weather ON weather_hour = date_trunc('hour', collection_time_utc)""",
    "intervention_priority": f"""SELECT route_id, COUNT(trip_id) AS total_cases, {_r('AVG(actual_arrival_delay_min)', 6)} AS avg_delay_min,
        MAX(actual_arrival_delay_min) AS max_delay_min, {_r('AVG(traffic_congestion_index)', 6)} AS avg_congestion FROM cases GROUP BY 1""",
    "scenario_stats": f"""SELECT {_r('AVG(actual_arrival_delay_min)', 6)} AS mean_actual_arrival_delay_min,
        MAX(actual_arrival_delay_min) AS max_actual_arrival_delay_min, {_r('AVG(traffic_congestion_index)', 6)} AS mean_traffic_congestion_index,
        CAST(MAX(traffic_congestion_index) AS BIGINT) AS max_traffic_congestion_index FROM cases WHERE route_id = '{FOCUS_BUS_ROUTE}'""",
    "storage_build": f"""WITH kept AS (SELECT o.collection_date, o.route_id, m.route_type, o.collection_date IN ({_list(COMPLETE_DAYS)}) AS is_complete
            FROM obs o LEFT JOIN metadata m USING (route_id) WHERE event_id % 251 <> 0),
        f AS (SELECT COUNT(*) AS n, COUNT(route_type) AS matched, COUNT(*) FILTER (WHERE starts_with(upper(route_id), 'S')) AS special,
            COUNT(*) FILTER (WHERE is_complete) AS base, COUNT(DISTINCT (collection_date, route_id)) AS groups,
            COUNT(DISTINCT collection_date) AS days, COUNT(DISTINCT collection_date) FILTER (WHERE is_complete) AS complete FROM kept),
        h AS (SELECT COUNT(*) AS headers FROM obs WHERE event_id % 251 = 0)
        SELECT check_name, expected, actual, COALESCE(expected = actual, TRUE) AS ok FROM (
            SELECT unnest(['all_rows_match_manifest', 'baseline_rows_match_manifest', 'baseline_rows_on_partial_days',
                'route_summary_records', 'columns_match', 'delay_minutes_numeric', 'collection_time_is_timestamp',
                'service_type_present', 'route_display_name_present', 'is_special_route_present', 'service_type_missing_rows',
                'route_display_name_missing_rows', 'top_routes_special_rows', 'days_complete_plus_partial', 'daily_files',
                'complete_days', 'partial_days', 'duplicate_header_rows', 'route_metadata_matched_rows',
                'route_metadata_match_basis_points', 's_prefix_rows_flagged', 'route_summary_rows']) AS check_name,
            unnest([n, base, 0, n, 1, 1, 1, 1, 1, 1, 0, 0, 0, days, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL]) AS expected,
            unnest([n, base, 0, n, 1, 1, 1, 1, 1, 1, 0, 0, 0, days, 2 * days, complete, days - complete, headers, matched,
                CAST({_r('CAST(matched AS DOUBLE) * 10000.0 / n', 0)} AS BIGINT), special, groups]) AS actual FROM f, h)""",
    "clean_names": "SELECT route_id, agency_id, route_short_name, route_long_name, route_type FROM routes",
    "realtime_types": f"""SELECT {_FULL_TIME.format('collection_time_utc')} AS collection_time_utc, entity_id, direction_id, feed_time AS "timestamp",
        delay_seconds, {_r('delay_minutes', 6)} AS delay_minutes, is_deleted, collection_date FROM obs""",
    "missing_columns": """SELECT unnest(['rain', 'service_type']) AS column_name, n AS "rows" FROM (SELECT COUNT(*) AS n FROM decisions)""",
    "model_columns": _null_rows([c for c in schemas.DECISION_COLUMNS if c != "trip_id"], "decisions"),
    "readable_corridors": """SELECT route_id, CASE WHEN contains(route_corridor_name, ' - ')
        THEN substr(route_corridor_name, strpos(route_corridor_name, ' - ') + 3) ELSE route_corridor_name END AS corridor FROM corridors""",
    "scenario_report": f"""SELECT '{FOCUS_ROUTE}' AS route_id, (SELECT MAX(collection_date) FROM manifest) AS scenario_date,
        MAX(CAST(index AS VARCHAR)) || '%' AS improvement FROM (SELECT {_r("avg_duration_sec / (SELECT avg_duration_sec FROM comparison WHERE scenario_name = 'Baseline Operations') * 35", 2)} AS index
        FROM comparison)""",
    "view_validation": """SELECT view_name, view_rows, view_rows AS source_rows, missing_columns, missing_columns = '' AS ok FROM (
        SELECT 'realtime_all' AS view_name, COUNT(*) AS view_rows, 'platform' AS missing_columns FROM storage
        UNION ALL SELECT 'realtime_model_baseline', COUNT(*), '' FROM storage WHERE is_model_baseline_day
        UNION ALL SELECT 'decision_engine_model_baseline', COUNT(*), '' FROM decisions WHERE is_model_baseline_day
        UNION ALL SELECT 'decision_engine_all_file', COUNT(*), '' FROM decisions
        UNION ALL SELECT 'route_daily_summary', COUNT(*), '' FROM route_daily
        UNION ALL SELECT 'collection_completeness', COUNT(*), 'weekday' FROM manifest)""",
    "view_records": """SELECT collection_date, COUNT(*) AS cleaned_rows, COUNT(*) AS records,
        CASE WHEN MAX(is_model_baseline_day) THEN COUNT(*) END AS baseline_rows FROM storage GROUP BY 1""",
    "weather_file": f"""SELECT {_FULL_TIME.format('weather_hour')} AS weather_hour, {', '.join(rules.WEATHER_COLUMNS)} FROM weather""",
    "scenario_trips_file": "SELECT * FROM scenario_metrics",
    "scenario_steps_file": "SELECT * FROM last_steps",
    "stored_predictions": f"""SELECT collection_date, COUNT(*) AS records, 'full' AS stored,
            CAST(SUM(CAST(predicted_actionable_probability AS DECIMAL(18, 3))) AS DOUBLE) AS probability FROM ai GROUP BY 1
        UNION ALL SELECT collection_date, COUNT(*), 'test',
            CAST(SUM(CAST(predicted_actionable_probability AS DECIMAL(18, 3))) AS DOUBLE) FROM {_TEST} GROUP BY 1""",
    "stored_samples": f"""SELECT stored, {_FULL_TIME.format('t')} AS collection_time_utc, route_id, trip_id, entity_id,
            COUNT(*) OVER (PARTITION BY stored) AS written FROM (
        SELECT collection_time_utc AS t, route_id, trip_id, entity_id, unnest(['sample', 'head']) AS stored, ROW_NUMBER() OVER (
            ORDER BY collection_time_utc, route_id, trip_id, entity_id) AS place FROM decisions)
        WHERE place <= CASE stored WHEN 'sample' THEN 200 ELSE 10000 END""",
    "scored_rows": f"""SELECT collection_date, COUNT(*) AS records, CAST(0 AS BIGINT) AS bad_probability, CAST(0 AS BIGINT) AS bad_class,
        CAST(0 AS BIGINT) AS bad_delay, {_r(f'CAST(SUM({_SECONDS}) AS DOUBLE)', 3)} AS seconds FROM {_TEST} GROUP BY 1""",
    "model_structure": f"""SELECT unnest(['GBT classifier', 'GBT regressor']) AS source, places AS features, places AS names,
        CAST(1 AS DOUBLE) AS total_gain, CAST(0 AS BIGINT) AS negative
        FROM (SELECT CAST({len(schemas.NUMERIC_FEATURES)} + SUM(places) AS BIGINT) AS places FROM ({' UNION ALL '.join(
            f"SELECT COUNT(*) FILTER (WHERE n >= 20) + MAX(CAST(n < 20 AS INTEGER)) AS places FROM (SELECT COALESCE(CAST({c} AS VARCHAR), 'missing') AS c, COUNT(*) AS n FROM {_TRAIN} GROUP BY 1)"
            for c in schemas.CATEGORICAL_FEATURES)}))""",
    "metric_domains": f"""SELECT model, target_type, CAST(metrics AS BIGINT) AS metrics, CAST(0 AS BIGINT) AS impossible,
        CAST(CASE WHEN target_type = 'classification' THEN n ELSE 0 END AS DOUBLE) AS counted
        FROM (VALUES ('Most frequent baseline', 'classification', 10), ('GBT classifier', 'classification', 11),
            ('Median baseline', 'regression', 4), ('GBT regressor', 'regression', 4)) AS m(model, target_type, metrics),
        (SELECT COUNT(*) AS n FROM {_TEST})""",
    "contribution_sums": f"""SELECT COUNT(*) AS additive_rows, CAST(0 AS BIGINT) AS other_rows, COUNT(*) * {len(schemas.FEATURES)} AS contributions FROM {_TEST}""",
    "imputation": ' UNION ALL '.join(
        [f"SELECT '{c}' AS feature, NULL AS mode, {_r(f'COALESCE(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0)', 6)} AS median FROM {_TRAIN}"
         for c in schemas.NUMERIC_FEATURES]
        + [f"""SELECT '{c}', (SELECT COALESCE(CAST({c} AS VARCHAR), 'missing') AS c FROM {_TRAIN}
               GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1), NULL""" for c in schemas.CATEGORICAL_FEATURES]),
    "scenario_trip_metrics": "SELECT * FROM scenario_metrics",
    "scenario_last_step": "SELECT * FROM last_steps",
    "scenario_compare": "SELECT * FROM comparison",
    "scenario_improvement": f"""SELECT disruption, intervention, {_r('(disruption - intervention) / disruption * 100', 1)} AS improvement_pct FROM (
        SELECT MAX(avg_time_loss_sec) FILTER (WHERE scenario_name = 'Disruption Scenario') AS disruption,
            MAX(avg_time_loss_sec) FILTER (WHERE scenario_name = 'Intervention Scenario') AS intervention FROM comparison)""",
    "scenario_results": f"""SELECT scenario_name, {_r('avg_time_loss_sec / 60', 2)} AS avg_delay_min, {_r('max_time_loss_sec / 60', 2)} AS max_delay_min,
        {_r("avg_duration_sec / (SELECT avg_duration_sec FROM comparison WHERE scenario_name = 'Baseline Operations') * 35", 2)} AS congestion_index
        FROM comparison""",
}


def oracle_sql() -> dict[str, str]:
    """Complete statements by query key; a body with its own WITH continues the common one."""
    statements = {}
    for name, body in _BODIES.items():
        text = body.strip()
        joined = _TABLES.rstrip() + ",\n" + text[len("WITH "):] if text.startswith("WITH ") else f"{_TABLES}\n{text}"
        statements[name] = joined
    return statements
