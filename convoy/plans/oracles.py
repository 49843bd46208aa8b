"""The queries of ``catalog`` as SQL over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

BASE = """
e AS (
  SELECT event_id AS seq, ts, epoch_us(ts) AS us, CAST(user_id AS VARCHAR) AS asset_id, user_id,
         event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

REGISTRY = """
registry AS (
  SELECT asset_id, seq, ts, us, 'edge-' || (k % 3) AS edge_id, 'region-' || (k % 2) AS region_id
  FROM e WHERE kind = 'signup'
),
newest AS (
  SELECT asset_id, arg_max(edge_id, (ts, seq)) AS edge_id, arg_max(region_id, (ts, seq)) AS region_id
  FROM registry GROUP BY asset_id
)"""

CM = """
cm AS (
  SELECT asset_id, seq, ts, us, CASE WHEN k % 7 = 0 THEN '' ELSE 'edge-' || (k % 3) END AS edge_id,
         k % 5 AS overall_status, (k // 5) % 5 AS lifecycle
  FROM e WHERE kind = 'view'
),
cm_resolved AS (
  SELECT cm.*, registry.region_id
  FROM cm ASOF JOIN registry ON cm.asset_id = registry.asset_id AND cm.ts >= registry.ts
)"""

LOGISTICS = """
logistics AS (
  SELECT asset_id, seq, ts, us, 'edge-' || (k % 3) AS edge_id, k % 5 AS severity, 'f' || (k % 13) AS factor_id
  FROM e WHERE kind = 'error'
),
logistics_resolved AS (
  SELECT logistics.*, registry.region_id
  FROM logistics ASOF JOIN registry ON logistics.asset_id = registry.asset_id AND logistics.ts >= registry.ts
)"""

SUSTAINMENT = """
sustainment AS (
  SELECT e.asset_id, e.seq, e.ts, e.us, newest.edge_id, newest.region_id,
         ['track', 'engine', 'barrel', 'suspension'][k % 4 + 1] AS component_id,
         CASE WHEN k % 10 < 8 THEN '%' ELSE 'h' END AS unit, value AS rul
  FROM e JOIN newest ON e.asset_id = newest.asset_id WHERE kind = 'purchase'
)"""

CONTRIBUTIONS = """
contributions AS (
  SELECT region_id, asset_id, 'logistics_status' AS payload_type, ts, us, seq, severity, factor_id,
         0 AS overall_status, 0 AS lifecycle, edge_id FROM logistics_resolved
  UNION ALL
  SELECT region_id, asset_id, 'asset_cm_state_json', ts, us, seq, 0, NULL, overall_status, lifecycle, edge_id
  FROM cm_resolved
  UNION ALL
  SELECT region_id, asset_id, 'derived_sustainment', ts, us, seq, 0, NULL, 0, 0, edge_id FROM sustainment
)"""

ASSETS = """
assets AS (
  SELECT region_id, asset_id,
    coalesce(arg_max(severity, (ts, seq)) FILTER (payload_type = 'logistics_status'), 0) AS logistics_severity,
    arg_max(factor_id, (ts, seq)) FILTER (payload_type = 'logistics_status') AS factor_id,
    coalesce(arg_max(overall_status, (ts, seq)) FILTER (payload_type = 'asset_cm_state_json'), 0) AS cm_overall_status,
    coalesce(arg_max(lifecycle, (ts, seq)) FILTER (payload_type = 'asset_cm_state_json'), 0) AS cm_lifecycle,
    coalesce(arg_max(edge_id, (ts, seq)) FILTER (payload_type <> 'asset_cm_state_json' OR edge_id <> ''), '')
      AS last_source_edge_id,
    max(us) AS updated_us
  FROM contributions GROUP BY region_id, asset_id
),
buckets AS (
  SELECT region_id, asset_id, greatest(
    CASE WHEN logistics_severity BETWEEN 2 AND 4 THEN logistics_severity - 1 ELSE 0 END,
    CASE WHEN cm_lifecycle = 4 THEN 3
         WHEN cm_overall_status IN (2, 3, 4) OR cm_lifecycle = 3 THEN 1 ELSE 0 END) AS bucket_rank
  FROM assets
)"""

WEAR_LATEST = """
wear AS (
  SELECT region_id, asset_id, component_id, arg_max(unit, (ts, seq)) AS unit, arg_max(rul, (ts, seq)) AS rul
  FROM sustainment GROUP BY region_id, asset_id, component_id
)"""

REGIONAL = (BASE, REGISTRY, CM, LOGISTICS, SUSTAINMENT, CONTRIBUTIONS, ASSETS, WEAR_LATEST)

READINGS = """
readings AS (
  SELECT user_id AS device, kind, seq, ts, us, us // 86400000000 * 86400000000 AS window_us, value AS reading
  FROM e WHERE kind <> 'error'
)"""

RUNNING_MEAN = """
means AS (
  SELECT *, avg(reading) OVER w AS mean, count(*) OVER w AS n FROM readings
  WINDOW w AS (PARTITION BY device, window_us ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)
)"""

OFFLINE = """
offline AS (
  SELECT l.user_id AS device, l.seq, l.us AS lost_us, l.us + 43200000000 AS detected_us
  FROM e l WHERE l.kind = 'error' AND NOT EXISTS (
    SELECT 1 FROM e r WHERE r.kind = 'signup' AND r.asset_id = l.asset_id
      AND r.us > l.us AND r.us <= l.us + 43200000000)
)"""

SEGMENTS = """
kin AS (
  SELECT asset_id, seq, ts, us, kind, k, value AS x, k AS y, seq % 100 AS z,
         CASE WHEN kind <> 'error' THEN k - 50 END AS pitch, value % 45 AS roll
  FROM e
),
steps AS (
  SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(z) OVER w AS pz,
    last_value(pitch IGNORE NULLS) OVER (PARTITION BY asset_id ORDER BY ts, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pp,
    lag(roll) OVER w AS pr
  FROM kin WINDOW w AS (PARTITION BY asset_id ORDER BY ts, seq)
),
segments AS (
  SELECT *, coalesce(sqrt((x - px) * (x - px) + (y - py) * (y - py) + (z - pz) * (z - pz)), 0) AS metres FROM steps
),
usage AS (
  SELECT asset_id, seq, us, k,
    sum(metres) OVER w AS distance_m,
    sum(coalesce(((abs(pp) + abs(pitch)) / 2 + (abs(pr) + abs(roll)) / 2) * metres / 1000.0, 0)) OVER w AS terrain,
    (us - min(us) OVER w) / 3.6e9 AS hours,
    count(*) FILTER (kind = 'purchase') OVER w AS rounds
  FROM segments WINDOW w AS (PARTITION BY asset_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)
),
measures AS (
  SELECT asset_id, seq, 'track' AS component, distance_m / 1000.0 AS measure, 'km' AS measure_unit, 6.0::DOUBLE AS total FROM usage
  UNION ALL SELECT asset_id, seq, 'engine', hours, 'h', 700.0 FROM usage
  UNION ALL SELECT asset_id, seq, 'barrel', rounds, '1', 20.0 FROM usage
  UNION ALL SELECT asset_id, seq, 'suspension', terrain, 'deg.km', 300.0 FROM usage
),
wear_rows AS (
  SELECT asset_id, seq, component, round(measure, 6) AS measure, measure_unit,
    round(100.0 * (1.0 - least(1.0, measure / total)), 6) AS rul_pct,
    CASE WHEN measure / total >= 1.0 THEN 'CRITICAL' WHEN measure / total >= 0.9 THEN 'SERVICE_DUE'
         WHEN measure / total >= 0.5 THEN 'DEGRADED' ELSE 'NOMINAL' END AS status
  FROM measures WHERE measure > 0
)"""

ALERTS = """
alert_events AS (
  SELECT CAST(seq // 2 AS VARCHAR) AS id, ts, us, seq,
    CASE kind WHEN 'view' THEN 'fleet.sensor.temperature' WHEN 'error' THEN 'fleet.tactical.DeviceOfflineAlert'
      ELSE 'fleet.tactical.ThresholdExceeded' END AS type,
    CASE WHEN k = 99 THEN '' ELSE asset_id END AS source,
    CASE WHEN k % 10 = 0 THEN '' ELSE ['LOW', 'MEDIUM', 'HIGH'][k % 3 + 1] END AS stated
  FROM e
),
tactical AS (
  SELECT *, CASE WHEN type = 'fleet.tactical.ThresholdExceeded' THEN stated ELSE 'UNKNOWN' END AS severity
  FROM alert_events WHERE type LIKE 'fleet.tactical.%' AND source <> ''
),
projected AS (
  SELECT * FROM tactical QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts, seq) = 1
)"""

TICKS = """
samples AS (
  SELECT asset_id, seq, us, 'fluid:fuel_remaining' AS signal, value FROM e WHERE kind = 'view'
  UNION ALL
  SELECT asset_id, seq, us, 'ammo:slot' || (k % 2), k FROM e WHERE kind = 'click' AND k % 10 < 8
  UNION ALL
  SELECT asset_id, seq, us, 'wear_hours:' || ['track', 'engine', 'barrel', 'suspension'][k % 4 + 1], k
  FROM e WHERE kind = 'purchase' AND k % 10 < 9
  UNION ALL
  SELECT asset_id, seq, us, 'wear_rul:' || ['track', 'engine', 'barrel', 'suspension'][k % 4 + 1], value
  FROM e WHERE kind = 'purchase'
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY ts, seq) AS n_events FROM e
),
ticks AS (SELECT asset_id, seq, us, kind, k FROM numbered WHERE n_events % 5 = 0),
known AS (SELECT asset_id, signal, min((us, seq)) AS since FROM samples GROUP BY asset_id, signal),
requests AS (
  SELECT t.asset_id, t.seq, t.us, k.signal,
    CASE WHEN k.signal LIKE 'wear_%' THEN 1209600000000 ELSE 604800000000 END AS width
  FROM ticks t JOIN known k ON t.asset_id = k.asset_id AND k.since <= (t.us, t.seq)
),
tick_trends AS (
  SELECT r.asset_id, r.signal, r.seq, r.us, count(s.value) AS n,
    coalesce(regr_slope(s.value, (s.us - r.us) / 3.6e9), 0) AS slope,
    CASE WHEN var_pop(s.value) > 0 THEN coalesce(regr_r2(s.value, (s.us - r.us) / 3.6e9), 0) ELSE 0 END AS r2,
    arg_max(s.value, (s.us, s.seq)) AS latest, min(s.us) AS window_start_us, max(s.us) AS latest_us
  FROM requests r LEFT JOIN samples s
    ON r.asset_id = s.asset_id AND r.signal = s.signal AND s.us BETWEEN r.us - r.width AND r.us
  GROUP BY r.asset_id, r.signal, r.seq, r.us
)"""

WEAR_PAIRS = """
pairs AS (
  SELECT asset_id, seq, split_part(signal, ':', 2) AS component_key,
    max(CASE WHEN signal LIKE 'wear_hours:%' AND n >= 2 THEN slope END) AS hours_slope,
    max(CASE WHEN signal LIKE 'wear_rul:%' AND n >= 2 THEN slope END) AS rul_slope,
    max(CASE WHEN signal LIKE 'wear_rul:%' AND n >= 2 THEN latest END) AS rul_latest
  FROM tick_trends WHERE signal LIKE 'wear_%'
  GROUP BY asset_id, seq, split_part(signal, ':', 2)
  HAVING count(*) = 2 AND max(n) >= 2
)"""

THERMAL = """
thermal AS (
  SELECT *, value + 300 - (300 + k / 2.0) AS delta_k,
    value + 300 - coalesce(lag(value + 300) OVER (PARTITION BY asset_id ORDER BY ts, seq), value + 300) AS rate_k
  FROM e
),
anomalies AS (SELECT * FROM thermal WHERE delta_k > 80 AND rate_k > 2)"""


def _add(name: str, parts: tuple[str, ...] | str, select: str) -> None:
    parts = (parts,) if isinstance(parts, str) else parts
    ORACLES[name] = "WITH" + ",".join(parts) + "\n" + select.strip()


# ---------------------------------------------------------------- sources

_add("cloud_event_source", BASE, """
SELECT seq, CAST(seq AS VARCHAR) AS id, asset_id AS source, kind AS type, round(value, 6) AS reading
FROM e WHERE k % 10 NOT IN (0, 1)""")
_add("registry_source", (BASE, REGISTRY), """
SELECT seq, asset_id, CASE WHEN seq % 5 = 0 THEN '' ELSE edge_id END AS edge_id, region_id
FROM registry WHERE seq % 11 <> 0 AND seq % 7 <> 0""")
_add("cm_state_source", (BASE, REGISTRY, CM), """
SELECT seq, asset_id, '' AS region_id, edge_id,
  CAST(CASE WHEN seq % 5 = 0 THEN 0 ELSE overall_status END AS BIGINT) AS overall_status,
  CAST(CASE WHEN seq % 7 = 0 THEN 0 ELSE lifecycle END AS BIGINT) AS lifecycle
FROM cm""")
_add("logistics_source", (BASE, REGISTRY, LOGISTICS), """
SELECT seq, asset_id, CAST(severity AS BIGINT) AS overall_severity, factor_id,
  CAST(severity AS BIGINT) AS factor_severity, edge_id FROM logistics""")
_add("edge_sources", BASE, """
SELECT seq, 'edge-' || (seq % 3) AS source_edge_id, 'region-' || ((seq % 3) % 2) AS region_id, asset_id
FROM e WHERE kind = 'purchase'""")
_add("source_drops", (BASE, REGISTRY), """
SELECT 'registry' AS source, CASE WHEN seq % 13 = 0 THEN 'malformed' WHEN seq % 11 = 0 THEN 'blank_asset'
  WHEN seq % 7 = 0 THEN 'blank_region' ELSE 'used' END AS reason, count(*) AS n FROM registry GROUP BY 2
UNION ALL
SELECT 'cloud_events', CASE WHEN k % 10 = 0 THEN 'malformed' WHEN k % 10 = 1 THEN 'malformed_data'
  WHEN k % 17 = 0 THEN 'blank_device' ELSE 'used' END AS reason, count(*) FROM e GROUP BY 2""")
_add("quarantine", (BASE, REGISTRY, """
texts AS (
  SELECT seq, '{"asset_id":"' || CASE WHEN seq % 11 = 0 THEN '' ELSE asset_id END || '","edge_id":"' || edge_id || '","region_id":"'
    || CASE WHEN seq % 7 = 0 THEN '' ELSE region_id END || '"}' AS t FROM registry
)"""), """
SELECT 'registry' AS source, CASE WHEN seq % 13 = 0 THEN 'malformed' WHEN seq % 11 = 0 THEN 'blank_asset' ELSE 'blank_region' END AS reason,
  CASE WHEN seq % 13 = 0 THEN least(15, length(t)) ELSE length(t) END AS characters
FROM texts WHERE seq % 13 = 0 OR seq % 11 = 0 OR seq % 7 = 0""")
_add("unresolved_events", (BASE, REGISTRY, CM), """
SELECT 'used' AS reason, count(*) AS n FROM cm_resolved
UNION ALL
SELECT 'unknown_asset', (SELECT count(*) FROM cm) - (SELECT count(*) FROM cm_resolved)""")
_add("latest_state", BASE, """
SELECT asset_id, seq, us, kind, round(value, 6) AS value
FROM e QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY ts DESC, seq DESC) = 1""")

# ---------------------------------------------------------------- projections

_add("event_view", BASE, """
SELECT asset_id, seq, us, round(value + 300, 6) AS component_temp, round(300 + k / 2.0, 6)::DOUBLE AS ambient_temp,
  round(value, 6) AS ground_speed, CASE WHEN kind = 'view' THEN round(value, 6) END AS fuel_remaining,
  CASE WHEN kind = 'signup' THEN CAST(k AS DOUBLE) END AS bus_voltage
FROM e""")
_add("unit_normalize", (BASE, """
u AS (
  SELECT seq, CASE WHEN k % 10 >= 8 THEN 0.0::DOUBLE ELSE value END AS v, k % 5 AS i FROM e
),
kelvins AS (
  SELECT seq, i, CASE i WHEN 0 THEN v WHEN 1 THEN v + 273.15 WHEN 2 THEN (v + 459.67) * 5.0 / 9.0 END::DOUBLE AS kelvin FROM u
)"""), """
SELECT seq, round(kelvin, 6) AS kelvin, round(kelvin * 9.0 / 5.0 - 459.67, 6)::DOUBLE AS deg_f,
  CAST(i IN (0, 1, 2) AS BIGINT) AS known FROM kelvins""")
_add("speed_and_volume_units", BASE, """
SELECT seq,
  round(CASE k % 3 WHEN 0 THEN value * 1852.0::DOUBLE / 3600.0 WHEN 1 THEN value / 3.6::DOUBLE END, 6) AS metres_per_second,
  round(CASE k % 3 WHEN 2 THEN value * 3.785411784::DOUBLE ELSE value END, 6) AS litres
FROM e""")
_add("position_frames", BASE, """
SELECT seq, CASE k % 4 WHEN 0 THEN 'ecef' WHEN 1 THEN 'wgs84' WHEN 2 THEN 'local_enu' END AS frame,
  CASE WHEN k % 4 < 3 THEN round(value, 6) END AS c1, CASE WHEN k % 4 < 3 THEN CAST(k AS DOUBLE) END AS c2,
  CASE WHEN k % 4 < 3 THEN CAST(seq % 100 AS DOUBLE) END AS c3
FROM e""")
_add("attitude_and_vectors", BASE, """
SELECT seq, CAST(NULL AS DOUBLE) AS yaw, CAST(k - 50 AS DOUBLE) AS pitch,
  CASE WHEN k % 2 = 0 THEN round(value, 6) END AS roll,
  CASE WHEN k % 3 <> 0 THEN round(value, 6) END AS vx, CASE WHEN k % 3 <> 0 THEN CAST(k AS DOUBLE) END AS vy,
  CASE WHEN k % 3 <> 0 THEN 0.0::DOUBLE END AS vz
FROM e""")
_add("kinematics", (BASE, SEGMENTS), """
SELECT asset_id, seq, us, round(x, 6) AS x_m, CAST(y AS DOUBLE) AS y_m, CAST(z AS DOUBLE) AS z_m,
  CAST(pitch AS DOUBLE) AS pitch_deg, round(roll, 6) AS roll_deg FROM kin""")
_add("signals", (BASE, TICKS), """
SELECT asset_id, seq, signal, round(value, 6)::DOUBLE AS value,
  CASE WHEN signal LIKE 'fluid:%' THEN 'L' WHEN signal LIKE 'ammo:%' THEN 'count'
       WHEN signal LIKE 'wear_hours:%' THEN 'h' ELSE '%' END AS unit
FROM samples""")
_add("route_by_config", BASE, """
SELECT user_id AS device, seq, kind AS type, CAST(86400 AS BIGINT) AS window_seconds,
  85.0::DOUBLE AS critical_threshold FROM e WHERE kind <> 'error'""")
_add("extract_reading", BASE, """
SELECT seq, CASE k % 5 WHEN 3 THEN 12.5::DOUBLE ELSE round(value, 6) END AS reading
FROM e WHERE seq % 7 <> 0 AND (k % 5 IN (1, 3) OR (k % 5 = 0 AND value <> 0))
UNION ALL
SELECT seq, CASE k % 5 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 4.0::DOUBLE END FROM e WHERE seq % 7 = 0 AND k % 5 IN (0, 1, 3)""")
_add("route_region", (BASE, REGISTRY, CM), """
SELECT asset_id, seq, region_id FROM cm_resolved WHERE region_id = 'region-1'""")
_add("guard_region", BASE, """
SELECT asset_id, seq, 'region-1' AS region_id FROM e WHERE kind = 'purchase' AND seq % 3 IN (0, 1)""")
_add("payload_dispatch", REGIONAL, """
SELECT region_id, asset_id, payload_type, seq, CAST(severity AS BIGINT) AS severity,
  CAST(CASE WHEN severity > 1 THEN 1 ELSE 0 END AS BIGINT) AS n_factors,
  CAST(overall_status AS BIGINT) AS overall_status, CAST(lifecycle AS BIGINT) AS lifecycle, edge_id
FROM contributions""")
_add("tactical_filter", (BASE, ALERTS), "SELECT id, seq, type, source, severity, us FROM tactical")
_add("severity_from_payload", (BASE, ALERTS), """
SELECT type, CASE WHEN stated = '' THEN 'UNKNOWN' ELSE stated END AS severity, count(*) AS n
FROM tactical GROUP BY 1, 2""")
_CRITICAL = """
critical AS (
  SELECT seq, us, CASE WHEN k < 95 THEN asset_id ELSE 'device-00' END AS device_id
  FROM e WHERE kind = 'error' AND k >= 90
)"""
_add("critical_actions", (BASE, _CRITICAL), """
SELECT sha256('radar_state|' || device_id || '|' || seq) AS id, device_id, 'DEGRADED' AS radar_status,
  CAST(85 AS BIGINT) AS transmit_power, us FROM critical""")
_add("work_orders", (BASE, _CRITICAL), """
SELECT sha256('work_order|' || device_id || '|' || seq) AS id, device_id, 'Coolant Pressure Drop' AS issue,
  'Throttled radar power to 85%' AS action_taken, 'CRITICAL' AS priority, us FROM critical""")

# ---------------------------------------------------------------- joins

_add("registry_latest", (BASE, REGISTRY), "SELECT * FROM newest")
_add("resolve_region", (BASE, REGISTRY, CM), "SELECT asset_id, seq, us, region_id FROM cm_resolved")
_add("resolve_region_with_hold", (BASE, REGISTRY, CM), """
SELECT a.asset_id, a.seq, coalesce(a.r, b.r, c.r) AS region_id FROM
  (SELECT cm.asset_id, cm.seq, r.region_id AS r FROM cm ASOF LEFT JOIN registry r
     ON cm.asset_id = r.asset_id AND cm.us >= r.us) a
  JOIN (SELECT cm.seq, r.region_id AS r FROM cm ASOF LEFT JOIN registry r
     ON cm.asset_id = r.asset_id AND cm.us + 21600000000 >= r.us) b ON a.seq = b.seq
  JOIN (SELECT cm.seq, r.region_id AS r FROM cm ASOF LEFT JOIN registry r
     ON cm.asset_id = r.asset_id AND cm.us + 43200000000 >= r.us) c ON a.seq = c.seq
WHERE coalesce(a.r, b.r, c.r) IS NOT NULL""")
_add("offline_alerts", (BASE, OFFLINE), """
SELECT *, 'OFFLINE' AS status, CAST(43200 AS BIGINT) AS timeout_seconds, 'CRITICAL' AS severity FROM offline""")
_add("pair_wear_trends", (BASE, TICKS, WEAR_PAIRS), """
SELECT asset_id, seq, component_key, round(hours_slope, 6) AS hours_slope, round(rul_slope, 6) AS rul_slope,
  round(rul_latest, 6) AS rul_latest FROM pairs""")
_add("enrich_consumables", (BASE, TICKS), """
SELECT t.asset_id, t.seq, split_part(signal, ':', 2) AS slot_key, round(t.slope, 6) AS slope,
  CASE WHEN has THEN CASE WHEN k % 10 < 8 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END END AS capacity,
  CASE WHEN has THEN 'nsn-' || (k % 3) END AS nsn
FROM (
  SELECT t.*, i.k, i.kind = 'click' AND 'ammo:slot' || (i.k % 2) = t.signal AS has
  FROM tick_trends t JOIN ticks i ON t.seq = i.seq
) t WHERE signal LIKE 'ammo:%' AND n >= 2""")
_add("merge_assets", REGIONAL, """
SELECT a.region_id, a.asset_id, CAST(a.logistics_severity AS BIGINT) AS logistics_severity,
  CAST(a.cm_overall_status AS BIGINT) AS cm_overall_status, CAST(a.cm_lifecycle AS BIGINT) AS cm_lifecycle,
  count(w.component_id) AS n_components, round(max(w.rul) FILTER (w.component_id = 'engine'), 6) AS engine_rul,
  a.last_source_edge_id
FROM assets a LEFT JOIN wear w ON a.region_id = w.region_id AND a.asset_id = w.asset_id
GROUP BY ALL""")
_add("insert_ignore", (BASE, ALERTS), """
SELECT id, source AS device_id, severity FROM projected
WHERE id NOT IN (SELECT id FROM alert_events WHERE seq % 6 = 0)""")

# ---------------------------------------------------------------- aggregations

_add("tumbling_alerts", (BASE, READINGS, RUNNING_MEAN), """
SELECT device, seq, window_us, n, round(mean, 6) AS mean FROM means WHERE mean > 85""")
_add("tumbling_alerts_per_type", (BASE, READINGS, """
means AS (
  SELECT *, avg(reading) OVER w AS mean, count(*) OVER w AS n FROM readings
  WINDOW w AS (PARTITION BY device, kind, window_us ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)
)"""), "SELECT device, kind AS type, seq, n, round(mean, 6) AS mean FROM means WHERE mean > 85")
_add("tumbling_mean", (BASE, READINGS), """
SELECT device, window_us, round(avg(reading), 6) AS mean, count(*) AS n FROM readings GROUP BY device, window_us""")
_add("odometer", (BASE, SEGMENTS), "SELECT asset_id, seq, round(distance_m, 6) AS distance_m FROM usage")
_add("terrain_integral", (BASE, SEGMENTS), "SELECT asset_id, seq, round(terrain, 6) AS terrain_deg_km FROM usage")
_add("observed_hours", (BASE, SEGMENTS), "SELECT asset_id, seq, round(hours, 6) AS observed_hours FROM usage")
_add("rounds_fired", (BASE, SEGMENTS), "SELECT asset_id, seq, rounds AS rounds_fired FROM usage")
_add("latest_by_asset", REGIONAL, """
SELECT region_id, asset_id, CAST(logistics_severity AS BIGINT) AS logistics_severity,
  CAST(cm_overall_status AS BIGINT) AS cm_overall_status, CAST(cm_lifecycle AS BIGINT) AS cm_lifecycle,
  CAST(CASE WHEN logistics_severity > 1 THEN 1 ELSE 0 END AS BIGINT) AS n_factors, last_source_edge_id, updated_us
FROM assets""")
_add("wear_latest", REGIONAL, "SELECT region_id, asset_id, component_id, unit, round(rul, 6) AS rul FROM wear")
_add("severity_buckets", REGIONAL, """
SELECT region_id, asset_id, CAST(bucket_rank AS BIGINT) AS bucket_rank,
  ['nominal', 'degraded', 'critical', 'non_operational'][bucket_rank + 1] AS bucket FROM buckets""")
_SUMMARY = """
summary AS (
  SELECT region_id, count(*) FILTER (bucket_rank = 0) AS nominal, count(*) FILTER (bucket_rank = 1) AS degraded,
    count(*) FILTER (bucket_rank = 2) AS critical, count(*) FILTER (bucket_rank = 3) AS non_operational,
    count(*) AS asset_count
  FROM buckets GROUP BY region_id
)"""
_add("fleet_summary", (*REGIONAL, _SUMMARY), "SELECT * FROM summary")
_FACTORS = """
factors AS (
  SELECT region_id, factor_id, count(*) AS count FROM assets WHERE logistics_severity > 1 GROUP BY region_id, factor_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY count DESC, factor_id) AS rank FROM factors
)"""
_add("top_factors", (*REGIONAL, _FACTORS), "SELECT region_id, factor_id, count, rank FROM ranked WHERE rank <= 10")
_add("factor_breakdown", (*REGIONAL, _FACTORS), """
SELECT r.region_id, r.factor_id, ['DEGRADED', 'CRITICAL', 'NON_OPERATIONAL'][a.logistics_severity - 1] AS severity,
  count(*) AS n
FROM ranked r JOIN assets a ON r.region_id = a.region_id AND r.factor_id = a.factor_id
WHERE rank <= 5 AND a.logistics_severity > 1 GROUP BY 1, 2, 3""")
_add("wear_trends", REGIONAL, """
SELECT region_id, component_id, unit, round(avg(rul), 6) AS mean_rul_remaining, count(*) AS asset_count
FROM wear GROUP BY region_id, component_id, unit""")
_add("wear_trends_ordered", REGIONAL, """
SELECT region_id, row_number() OVER (PARTITION BY region_id ORDER BY component_id, unit) - 1 AS place, component_id, unit,
  round(avg(rul), 6) AS mean_rul_remaining, count(*) AS asset_count
FROM wear GROUP BY region_id, component_id, unit""")
_add("stamped_rollup", (*REGIONAL, _SUMMARY), """
SELECT region_id, asset_count, epoch_us(TIMESTAMP '2024-02-01 00:00:00') AS observed_us,
  'regional-aggregator' AS producer_id, 'U' AS classification FROM summary""")

# ---------------------------------------------------------------- windows

_TREND = """
trend AS (
  SELECT asset_id, kind AS signal, seq, count(*) OVER w AS n,
    coalesce(regr_slope(value, h) OVER w, 0) AS slope,
    CASE WHEN var_pop(value) OVER w > 0 THEN coalesce(regr_r2(value, h) OVER w, 0) ELSE 0 END AS r2,
    value AS latest, min(us) OVER w AS window_start_us, us AS latest_us
  FROM (SELECT *, (us - epoch_us(TIMESTAMP '2024-01-01')) / 3.6e9 AS h FROM e)
  WINDOW w AS (PARTITION BY asset_id, kind ORDER BY us RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW)
)"""
_TREND_SELECT = """
SELECT asset_id, signal, seq, n, round(slope, 6) AS slope, round(r2, 6) AS r2, round(latest, 6) AS latest,
  window_start_us, latest_us FROM trend WHERE n >= 2"""
_add("rolling_trend", (BASE, _TREND), _TREND_SELECT)
_add("capped_trend", (BASE, """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY asset_id, kind ORDER BY ts, seq) AS i FROM e
),
trend AS (
  SELECT t.asset_id, t.kind AS signal, t.seq, count(*) AS n,
    coalesce(regr_slope(s.value, (s.us - t.us) / 3.6e9), 0) AS slope,
    CASE WHEN var_pop(s.value) > 0 THEN coalesce(regr_r2(s.value, (s.us - t.us) / 3.6e9), 0) ELSE 0 END AS r2,
    arg_max(s.value, s.i) AS latest, min(s.us) AS window_start_us, max(s.us) AS latest_us
  FROM numbered t JOIN numbered s ON t.asset_id = s.asset_id AND t.kind = s.kind
    AND s.i BETWEEN t.i - 3 AND t.i AND s.us >= t.us - 604800000000
  GROUP BY t.asset_id, t.kind, t.seq
)"""), _TREND_SELECT)
_add("emit_ticks", (BASE, TICKS), "SELECT asset_id, seq, n_events FROM numbered WHERE n_events % 5 = 0")
_add("tick_trends", (BASE, TICKS), """
SELECT asset_id, signal, seq, n, round(slope, 6) AS slope, round(r2, 6) AS r2, round(latest, 6)::DOUBLE AS latest,
  window_start_us, latest_us FROM tick_trends WHERE n >= 2""")
_add("windowed_telemetry", (BASE, TICKS, WEAR_PAIRS, """
per_tick AS (
  SELECT asset_id, seq, us,
    max(slope) FILTER (signal LIKE 'fluid:%' AND n >= 2) AS fuel_slope,
    max(r2) FILTER (signal LIKE 'fluid:%' AND n >= 2) AS fuel_r2,
    count(*) FILTER (signal LIKE 'ammo:%' AND n >= 2) AS n_consumables,
    coalesce(sum(n) FILTER (signal LIKE 'fluid:%' AND n >= 2), 0) AS sample_count,
    coalesce(min(window_start_us) FILTER (signal LIKE 'fluid:%' AND n >= 2), us) AS start_us
  FROM tick_trends GROUP BY asset_id, seq, us
)"""), """
SELECT p.asset_id, p.seq, p.us, 'v' || (t.k % 3) AS platform_variant, round(fuel_slope, 6) AS fuel_slope,
  round(fuel_r2, 6) AS fuel_r2, CASE WHEN fuel_slope IS NOT NULL THEN 'L/h' END AS fuel_slope_unit,
  n_consumables, (SELECT count(*) FROM pairs w WHERE w.asset_id = p.asset_id AND w.seq = p.seq) AS n_wear,
  CAST(CASE WHEN t.kind = 'error' THEN 1 ELSE 0 END AS BIGINT) AS n_faults,
  CAST(sample_count AS BIGINT) AS sample_count, start_us, p.us - start_us AS duration_us
FROM per_tick p JOIN ticks t ON p.seq = t.seq""")
ORACLES["telemetry_source"] = f"""SELECT * FROM ({ORACLES["event_view"]}) WHERE seq % 10 <> 0"""
ORACLES["windowed_consumables"] = ORACLES["enrich_consumables"]
ORACLES["windowed_wear"] = ORACLES["pair_wear_trends"]
ORACLES["window_envelopes"] = f"""
SELECT 'edge-1' AS source_edge_id, 'region-1' AS region_id, asset_id, seq, us, 'asset_telemetry_windows' AS payload_type,
  platform_variant, 'edge-windows' AS producer_id, n_consumables, sample_count FROM ({ORACLES["windowed_telemetry"]})"""
_add("ewma", BASE, """
SELECT asset_id, seq, round(list_reduce(
  list(value) OVER (PARTITION BY asset_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING),
  lambda a, x: 0.2::DOUBLE * x + 0.8::DOUBLE * a), 6) AS ewma FROM e""")
_add("ewma_spike", BASE, """
SELECT asset_id, seq, round(log10(list_reduce(
  list((value + 1) * CASE WHEN seq % 500 = 0 THEN 1e20::DOUBLE ELSE 1.0::DOUBLE END)
    OVER (PARTITION BY asset_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING),
  lambda a, x: 0.2::DOUBLE * x + 0.8::DOUBLE * a)), 6) AS log_ewma FROM e""")
_add("connection_states", BASE, """
SELECT seq, CASE kind WHEN 'signup' THEN 'restored' ELSE 'lost' END AS state FROM e WHERE kind IN ('error', 'signup', 'view')""")
_add("sample_delta", BASE, """
SELECT asset_id, seq, round(value - coalesce(nullif(lag(value) OVER (PARTITION BY asset_id ORDER BY ts, seq), 0), value), 6)
  AS rate FROM e""")

# ---------------------------------------------------------------- detection and wear

_add("thermal_runaway", (BASE, THERMAL), """
SELECT asset_id, seq, 'thermal.runaway.v1' AS rule_id, 'critical' AS severity, us, round(delta_k, 6) AS delta_k,
  round(rate_k, 6) AS rate_k FROM anomalies""")
_add("thermal_drift", (BASE, """
averages AS (
  SELECT asset_id, seq, us, value + 300 AS v, list_reduce(
    list(value + 300) OVER (PARTITION BY asset_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING),
    lambda a, x: 0.2::DOUBLE * x + 0.8::DOUBLE * a) AS ewma_k FROM e
)"""), """
SELECT asset_id, seq, 'thermal.drift.v1' AS rule_id, 'warning' AS severity, us, round(v - ewma_k, 6) AS drift_k
FROM averages WHERE v - ewma_k > 40""")
_add("usage_state", (BASE, """
steps AS (
  SELECT asset_id, seq, ts, us, kind, k, value, seq % 100 AS z,
    sqrt(pow(value - lag(value) OVER w, 2) + pow(k - lag(k) OVER w, 2) + pow(seq % 100 - lag(seq % 100) OVER w, 2)) AS metres
  FROM e WINDOW w AS (PARTITION BY asset_id ORDER BY ts, seq)
)"""), """
SELECT asset_id, round(sum(metres), 6) AS distance_m, round(arg_max(value, (ts, seq)), 6) AS x,
  CAST(arg_max(k, (ts, seq)) AS DOUBLE) AS y, CAST(arg_max(z, (ts, seq)) AS DOUBLE) AS z,
  round(arg_max(value % 45, (ts, seq)), 6) AS roll, min(us) AS first_us, max(us) AS last_us,
  count(*) FILTER (WHERE kind = 'purchase') AS rounds
FROM steps GROUP BY asset_id""")
_add("anomaly_events", (BASE, THERMAL), """
SELECT '1.0' AS specversion, 'fleet/edge/edge-01/' || asset_id AS source, 'fleet.anomaly.thermal.runaway.v1' AS type,
  asset_id AS subject, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time, 'application/json' AS datacontenttype,
  'critical' AS severity, round(delta_k, 6) AS delta_k, 'edge-01' AS edge_id FROM anomalies""")
_add("alert_projection", (BASE, ALERTS), """
SELECT id, source AS device_id, type AS event_type, severity, us FROM projected""")
_add("alert_table", (BASE, READINGS, RUNNING_MEAN, OFFLINE), """
SELECT CAST(device AS VARCHAR) AS device_id, 'fleet.tactical.ThresholdExceeded' AS event_type, 'HIGH' AS severity,
  count(*) AS n, max(us) AS last_us FROM means WHERE mean > 85 GROUP BY device
UNION ALL
SELECT CAST(device AS VARCHAR), 'fleet.tactical.DeviceOfflineAlert', 'UNKNOWN', count(*), max(detected_us)
FROM offline GROUP BY device""")
_add("wear_status", (BASE, SEGMENTS), """
SELECT asset_id, component, measure, measure_unit, rul_pct, status FROM wear_rows
QUALIFY row_number() OVER (PARTITION BY asset_id, component ORDER BY seq DESC) = 1""")
_add("wear_running", (BASE, SEGMENTS), """
SELECT asset_id, seq, component, measure, measure_unit, rul_pct, status FROM wear_rows""")
_add("derived_events", (BASE, SEGMENTS), """
SELECT asset_id, seq, 'v' || (k % 3) AS platform_variant,
  CASE WHEN k % 4 = 0 THEN 'edge-01' ELSE 'edge-' || (k % 3) END AS edge_id,
  CASE WHEN k % 4 = 0 THEN 'region-01' ELSE 'region-' || (k % 2) END AS region_id, us,
  CAST((distance_m > 0)::INT + (hours > 0)::INT + (terrain > 0)::INT AS BIGINT) AS n_components,
  CASE WHEN distance_m > 0 THEN round(100.0 * (1.0 - least(1.0, distance_m / 1000.0 / 6.0)), 6) END AS track_rul,
  'DERIVED' AS origin
FROM usage""")

# ---------------------------------------------------------------- set operations

_add("fan_in_union", REGIONAL, """
SELECT region_id, edge_id AS source_edge_id, asset_id, payload_type, seq, us FROM contributions""")
