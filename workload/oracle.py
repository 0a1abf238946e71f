"""SQL that computes the expected result of every query straight from the tables."""

from __future__ import annotations

AS_OF_US = 1706659200000000
HALF = 500000 * 1000000000000

# Events with their arrival position.
E = """e AS (
  SELECT *, event_id AS e, user_id AS u, epoch_us(ts) AS us, 'asset-' || user_id AS asset,
         ((event_id * 7919) % 1000003) * 1000000000000 + event_id AS off
  FROM events)"""

# Customers with position and arrival position.
C = """c AS (
  SELECT *, c_custkey AS k, c_name AS asset_id,
         CASE WHEN c_custkey % 10 <> 9
              THEN CAST((c_custkey * 37) % 1801 AS DOUBLE) / 10e0 - 90e0 END AS lat,
         CAST((c_custkey * 91) % 3601 AS DOUBLE) / 10e0 - 180e0 AS lon,
         ((c_custkey * 7919) % 1000003) * 1000000000000 + c_custkey AS off
  FROM customer)"""

SITES = """sites AS (
  SELECT s_suppkey AS ordinal, 'edge-' || s_suppkey AS edge_id,
         'region-' || (s_suppkey % 5) AS region_id,
         CAST((s_suppkey * 53) % 1201 AS DOUBLE) * 0.137e0 - 82.3e0 AS lat,
         CAST((s_suppkey * 71) % 2503 AS DOUBLE) * 0.1393e0 - 174.7e0 AS lon,
         s_name AS label
  FROM supplier)"""


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (
        f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(12742.0176e0 * atan2(sqrt({h}), sqrt(greatest(1 - {h}, 0))))"


def latest(partition: str, where: str = "true", source: str = "e") -> str:
    return (
        f"l AS (SELECT * FROM {source} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY off DESC) = 1)"
    )


ORACLE: dict[str, str] = {}

BROKEN = """CASE WHEN e % 13 = 5 THEN 'message without a value'
     WHEN e % 10 = 3 THEN 'value is not JSON text'
     WHEN e % 11 = 4 THEN 'JSON value is a list, expected object'
     WHEN e % 17 = 2 OR e % 19 = 7 THEN 'value is not JSON text'
     ELSE 'ok' END"""

ORACLE["decode_json_events"] = f"""
WITH {E}, d AS (SELECT {BROKEN} AS outcome, e FROM e)
SELECT outcome, count(*) AS messages,
       CAST(sum(CASE WHEN outcome = 'ok' THEN e END) AS BIGINT) AS sum_id
FROM d GROUP BY outcome"""

ORACLE["decode_cloudevents"] = f"""
WITH {E}, d AS (
  SELECT concat_ws(', ', CASE WHEN e % 3 = 0 THEN 'id' END, CASE WHEN e % 5 = 0 THEN 'source' END,
                   CASE WHEN e % 7 = 0 THEN 'type' END) AS missing FROM e)
SELECT CASE WHEN missing = '' THEN 'ok'
            ELSE 'CloudEvent missing required attribute(s): ' || missing END AS outcome,
       count(*) AS messages
FROM d GROUP BY 1"""

MIXED = f"""{E}, x AS (
  SELECT e, off, 'asset-logistics-status' AS topic,
    CASE WHEN e % 31 IN (3, 5, 13) THEN 'DecodeError'
         WHEN e % 31 = 7 THEN 'handler_exception'
         WHEN e % 31 = 9 THEN 'write_error'
         WHEN e % 31 = 11 THEN 'skipped'
         WHEN e % 97 = 13 THEN 'handler_exception' ELSE 'written' END AS outcome,
    CASE WHEN e % 31 = 3 THEN 'message without a value'
         WHEN e % 31 = 5 THEN 'value is not JSON text'
         WHEN e % 31 = 7 THEN 'status is not an object'
         WHEN e % 31 = 13 THEN 'message key is not UTF-8'
         WHEN e % 31 = 9 THEN 'status.status_revision is out of range'
         WHEN e % 31 <> 11 AND e % 97 = 13 THEN 'status.status_revision is not a whole number'
    END AS detail
  FROM e)"""

ORACLE["quarantine_summary"] = f"""
WITH {MIXED}
SELECT topic, outcome AS reason, detail, count(*) AS messages FROM x
WHERE detail IS NOT NULL GROUP BY ALL"""

ORACLE["quarantine_signatures"] = f"""
WITH {MIXED}
SELECT topic, left(detail, 80) AS signature, count(*) AS messages, min(off) AS first_offset
FROM x WHERE detail IS NOT NULL GROUP BY ALL"""

ORACLE["outcome_counters"] = f"""
WITH {MIXED}, c AS (
  SELECT 'messages_consumed' AS metric, topic AS label FROM x
  UNION ALL SELECT 'rows_written', 'asset_logistics_status' FROM x WHERE outcome = 'written'
  UNION ALL SELECT 'decode_errors', topic || ':' || outcome FROM x
            WHERE outcome IN ('DecodeError', 'handler_exception')
  UNION ALL SELECT 'write_errors', 'write:asset_logistics_status' FROM x WHERE outcome = 'write_error')
SELECT metric, label, count(*) AS value FROM c GROUP BY ALL"""

ORACLE["coalesce_latest"] = f"""
WITH {E}, {latest("user_id")} SELECT user_id, event_id, event_type, value FROM l"""

ORACLE["coalesce_message_key"] = f"""
WITH {E}, k AS (SELECT *, CASE WHEN u % 4 = 3 THEN '(none)' ELSE asset END AS message_key FROM e),
{latest("message_key", source="k")}
SELECT message_key,
       CASE WHEN {BROKEN} <> 'ok' THEN 'DecodeError'
            WHEN message_key = '(none)' THEN 'skipped' ELSE 'written' END AS outcome,
       event_id
FROM l"""

ORACLE["upsert_two_batches"] = f"""
WITH {E}, {latest("user_id")}
SELECT user_id, event_id, event_type, value,
       CASE WHEN user_id IN (SELECT user_id FROM e WHERE off < {HALF})
            THEN 'note-' || user_id END AS owner_note
FROM l"""

ORACLE["upsert_composite_key"] = f"""
WITH {E}, {latest("user_id, event_type")} SELECT user_id, event_type, event_id, value FROM l"""

ORACLE["append_ignore"] = """
SELECT event_id AS id, user_id, CASE WHEN event_id % 3 <> 0 THEN value ELSE value + 1000 END AS value
FROM events"""

TIMED = "t AS (SELECT event_id, CASE WHEN event_id % 50 <> 7 THEN epoch_us(ts) END AS time FROM events)"
CUT_US = AS_OF_US - 240 * 3600000000

ORACLE["prune_retention"] = f"""
WITH {TIMED} SELECT event_id, time FROM t WHERE time IS NULL OR time >= {CUT_US}"""

ORACLE["prune_counts"] = f"""
WITH {TIMED}
SELECT count(*) FILTER (WHERE time IS NULL OR time >= {CUT_US}) AS kept,
       count(*) FILTER (WHERE time < {CUT_US}) AS pruned FROM t"""

ORACLE["prune_ttl_policy"] = """
WITH s AS (
  SELECT c_custkey AS c, CASE WHEN c_custkey % 3 = 0 THEN 'append' ELSE 'upsert' END AS mode,
         CASE WHEN c_custkey % 2 = 0 THEN 24 END AS retention,
         CASE WHEN c_custkey % 5 = 0 THEN 0 WHEN c_custkey % 5 < 4 THEN 24 END AS ttl,
         CASE WHEN c_custkey % 7 = 1 THEN 6 WHEN c_custkey % 7 = 2 THEN 0 END AS override
  FROM customer)
SELECT c AS setting_id, mode,
       CAST(nullif(CASE WHEN mode = 'append' THEN retention
                        WHEN override IS NULL THEN ttl
                        WHEN override > 0 THEN override END, 0) AS BIGINT) AS hours
FROM s"""

ORACLE["proj_cm_state"] = f"""
WITH {E}, {latest("u")}
SELECT asset AS asset_id,
  CASE WHEN e % 3 = 1 THEN 'edge-01' ELSE 'edge-' || (u % 5) END AS edge_id,
  CASE WHEN e % 4 = 1 THEN 'region-01' ELSE 'region-7' END AS region_id,
  'base-' || (e % 7) AS baseline_id,
  CASE WHEN e % 9 = 2 THEN 'LIFECYCLE_UNSPECIFIED' WHEN e % 4 = 2 THEN 'LIFECYCLE_ACTIVE'
       ELSE CAST(e % 4 AS VARCHAR) END AS lifecycle,
  CASE WHEN e % 2 = 0 THEN 'CONFIG_STATUS_DEGRADED' ELSE 'CONFIG_STATUS_UNSPECIFIED' END AS overall_status,
  CASE WHEN e % 5 = 2 THEN NULL WHEN e % 2 = 0 THEN 'CONFIG_STATUS_NOT_MISSION_CAPABLE'
       ELSE '9' END AS last_alerted_status,
  CASE WHEN e % 6 <> 3 THEN us END AS as_of,
  CASE WHEN e % 6 <> 4 THEN us END AS last_observed_at,
  CASE WHEN e % 4 = 3 THEN 0 ELSE e % 3 + 1 END AS n_installed,
  CASE WHEN e % 4 <> 3 THEN 'slot-1' END AS first_slot,
  CAST(0 AS BIGINT) AS n_mods, CAST(0 AS BIGINT) AS n_discrepancies,
  {AS_OF_US} AS updated_at
FROM l"""

ORACLE["proj_logistics_status"] = f"""
WITH {E}, {latest("u", "e % 97 <> 13")}
SELECT asset AS asset_id,
  CASE WHEN e % 4 = 3 THEN 'edge-' || (u % 5) ELSE 'edge-unspecified' END AS edge_id,
  CASE WHEN e % 4 = 3 THEN 'region-7' ELSE 'region-unspecified' END AS region_id,
  'variant-' || (e % 3) AS platform_variant,
  CASE WHEN e % 5 = 0 THEN 'LOGISTICS_SEVERITY_UNSPECIFIED' ELSE 'SEVERITY_' || (e % 4) END AS overall_severity,
  'SEVERITY_' || (e % 3) AS previous_severity,
  CASE WHEN e % 7 = 0 THEN 0 ELSE e % 4 + 1 END AS n_factors,
  CAST(trunc(value) AS BIGINT) AS projected_mission_capable_remaining_seconds,
  CASE WHEN e % 3 <> 0 THEN e % 1000 END AS projected_time_to_next_constraint_seconds,
  'base-' || (e % 7) AS cm_baseline_id,
  CASE WHEN e % 2 = 0 THEN e % 1000 ELSE 0 END AS status_revision,
  us AS computed_at, CAST(NULL AS BIGINT) AS latest_telemetry_sample_time,
  (e % 3 <> 0 AND e % 2 = 0) AS is_transition, (e % 5 = 0) AS is_initial,
  {AS_OF_US} AS updated_at
FROM l"""

NEAREST = f"""n AS (
  SELECT c.k, s.*, {km("c.lat", "c.lon", "s.lat", "s.lon")} AS km
  FROM c, sites s WHERE c.lat IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY c.k ORDER BY km, s.ordinal) = 1)"""

ORACLE["proj_telemetry_latest"] = f"""
WITH {C}, {SITES}, {NEAREST}, p AS (
  SELECT c.*, (k % 7 <> 0 AND k % 6 = 0) AS own,
         ((k % 2 = 0 AND k % 3 <> 2) OR (k % 2 = 1 AND k % 3 <> 0)) AS located FROM c)
SELECT p.asset_id,
  CASE WHEN own THEN 'edge-own' WHEN located THEN coalesce(n.edge_id, 'edge-unspecified')
       ELSE 'edge-unspecified' END AS edge_id,
  CASE WHEN own THEN 'region-own' WHEN located THEN coalesce(n.region_id, 'region-unspecified')
       ELSE 'region-unspecified' END AS region_id,
  c_mktsegment AS platform_variant, 'call-' || (p.k % 100) AS callsign,
  'FORCE_FRIENDLY' AS force_id, CASE WHEN own THEN 'edge-own' END AS stamped_edge,
  CASE WHEN p.k % 7 <> 0 THEN 1705312800000000 END AS last_sample_at,
  CASE WHEN p.k % 4 <> 1 THEN p.k % 50 ELSE 0 END AS schema_revision,
  CASE WHEN p.k % 5 <> 3 THEN 'POWER_' || (p.k % 3) END AS power_state,
  CASE WHEN p.k % 5 <> 3 AND p.k % 4 = 0 THEN 'MODE_A' END AS functional_mode,
  CASE WHEN p.k % 5 <> 3 THEN 'HEALTH_OK' END AS health_state,
  CASE WHEN p.k % 5 <> 3 THEN p.k % 2 = 0 END AS actively_receiving,
  CASE WHEN p.k % 5 = 0 THEN true END AS actively_transmitting,
  true AS no_sustainment, {AS_OF_US} AS updated_at
FROM p LEFT JOIN n ON p.k = n.k"""

EVENT_COLUMNS = """'evt-' || e AS id,
  CASE WHEN e % 4 = 1 THEN 'edge-01' ELSE 'edge-' || (u % 5) END AS edge_id,
  CASE WHEN e % 5 = 1 THEN 'region-01' ELSE 'region-' || (u % 3) END AS region_id"""
EVENT_SEVERITY = """CASE WHEN e % 6 = 0 THEN 'top' WHEN e % 6 < 5 THEN 'level-' || (e % 3) END AS severity"""
EVENT_TIME = "CASE WHEN e % 29 <> 11 THEN us END"
EVENT_KEPT = f"(e % 29 = 11 OR us >= {CUT_US})"

ORACLE["proj_tactical_events"] = f"""
WITH {E}
SELECT {EVENT_COLUMNS}, '/sensors' AS source, event_type AS type, asset AS subject,
  {EVENT_SEVERITY}, {EVENT_TIME} AS time, value AS data_value, {AS_OF_US} AS ingested_at
FROM e"""

ORACLE["event_log_slice"] = f"""
WITH {E}
SELECT {EVENT_COLUMNS}, '/sensors' AS source, event_type AS type, asset AS subject,
  {EVENT_SEVERITY}, {EVENT_TIME} AS time
FROM e WHERE {EVENT_KEPT}"""

ORACLE["stream_append_ignore"] = f"""
WITH {E}
SELECT {EVENT_COLUMNS}, asset AS subject, {EVENT_SEVERITY}, {EVENT_TIME} AS time
FROM e WHERE {EVENT_KEPT}"""

WINDOW_ORIGIN = """CASE WHEN e % 6 = 0 OR e % 4 = 1 THEN 'edge-01' ELSE 'edge-' || (u % 5) END AS edge_id,
  CASE WHEN e % 6 = 0 OR e % 4 = 2 THEN 'region-01' ELSE 'region-7' END AS region_id"""
WINDOW_NUMBERS = """CASE WHEN e % 7 = 0 THEN NULL WHEN e % 3 <> 0 THEN e % 600 ELSE 60 END AS window_duration_seconds,
  CASE WHEN e % 7 <> 0 AND e % 5 <> 0 THEN e % 90 END AS sample_count"""

ORACLE["proj_telemetry_windows"] = f"""
WITH {E}, {latest("u")}
SELECT asset AS asset_id, {WINDOW_ORIGIN}, 'variant-' || (e % 3) AS platform_variant,
  value AS oil_slope, CAST(0 AS BIGINT) AS n_consumable,
  CASE WHEN e % 2 = 0 THEN e % 3 + 1 ELSE 0 END AS n_wear,
  {WINDOW_NUMBERS}, us AS computed_at, {AS_OF_US} AS updated_at
FROM l"""

ORACLE["stream_upsert"] = f"""
WITH {E}, {latest("u")}
SELECT asset AS asset_id, {WINDOW_ORIGIN}, 'variant-' || (e % 3) AS platform_variant,
  {WINDOW_NUMBERS}, us AS computed_at
FROM l"""

REGIONAL = """customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

ORACLE["proj_region_fleet_summary"] = f"""
SELECT r_name AS region_id, count(*) FILTER (WHERE c_acctbal >= 5000) AS nominal,
  count(*) FILTER (WHERE c_acctbal >= 2500 AND c_acctbal < 5000) AS degraded,
  count(*) FILTER (WHERE c_acctbal >= 0 AND c_acctbal < 2500) AS critical,
  count(*) FILTER (WHERE c_acctbal < 0) AS non_operational, count(*) AS asset_count,
  1705708800000000 AS observed_at, {AS_OF_US} AS updated_at
FROM {REGIONAL} GROUP BY r_name"""

REGION_LATEST = f"""{C}, g AS (SELECT c.*, r_name FROM c JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey), {latest("r_name", source="g")}"""

ORACLE["proj_region_top_factors"] = f"""
WITH {REGION_LATEST}
SELECT r_name AS region_id, k % 4 AS n_factors,
  CASE WHEN k % 4 <> 0 THEN c_mktsegment || '-1' END AS first_factor,
  CASE WHEN k % 4 <> 0 THEN k END AS first_count,
  1705708800000000 + (k % 60) * 1000000 AS observed_at, {AS_OF_US} AS updated_at
FROM l"""

ORACLE["proj_region_wear_trends"] = f"""
WITH {REGION_LATEST}
SELECT r_name AS region_id, k % 4 AS n_components,
  CASE WHEN k % 4 <> 0 THEN c_mktsegment || '-1' END AS first_component,
  1705708800000000 + (k % 60) * 1000000 AS observed_at, {AS_OF_US} AS updated_at
FROM l"""

ORDERS_LATEST = """o AS (
  SELECT *, o_orderkey AS o, o_custkey AS cust, 'launcher-' || o_custkey AS asset_id,
         ((o_orderkey * 7919) % 1000003) * 1000000000000 + o_orderkey AS off FROM orders),
l AS (SELECT *, CASE WHEN o % 5 = 2 THEN 0 ELSE o % 3 + 1 END AS n FROM o
      QUALIFY row_number() OVER (PARTITION BY cust ORDER BY off DESC) = 1)"""

OWN_PAIR = "(o % 6 <> 5 AND o % 4 <> 1 AND o % 3 <> 1)"

ORACLE["proj_capability_state"] = f"""
WITH {ORDERS_LATEST}
SELECT asset_id, n AS n_capabilities, CASE WHEN n > 0 THEN o + 1 END AS first_rounds,
  CAST(o % 9 AS VARCHAR) AS schema_version, o_orderstatus AS mode,
  epoch_us(date_trunc('day', o_orderdate)) + 34200000000 AS observed_at, {AS_OF_US} AS updated_at,
  CASE WHEN {OWN_PAIR} THEN 'edge-' || (cust % 5)
       WHEN starts_with(asset_id, 'launcher-12') THEN 'edge-twelve'
       WHEN starts_with(asset_id, 'launcher-1') THEN 'edge-one' ELSE 'edge-unspecified' END AS edge_id,
  CASE WHEN {OWN_PAIR} THEN 'region-7' WHEN starts_with(asset_id, 'launcher-1') THEN 'region-one'
       ELSE 'region-unspecified' END AS region_id
FROM l"""

ORACLE["explode_capabilities"] = f"""
WITH {ORDERS_LATEST}
SELECT asset_id, i - 1 AS position, 'store-' || i AS store, o + i AS rounds
FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM l)"""

LINES_LATEST = """t AS (
  SELECT *, l_orderkey AS o, (l_partkey * 1000003 + l_suppkey) * 10 + l_linenumber AS off FROM lineitem),
l AS (SELECT *, CASE WHEN o % 7 = 0 THEN 0 ELSE l_linenumber % 3 + 1 END AS n FROM t
      QUALIFY row_number() OVER (PARTITION BY o ORDER BY off DESC) = 1)"""

ORACLE["proj_element_telemetry"] = f"""
WITH {LINES_LATEST}
SELECT 'array-' || o AS asset_id, CASE WHEN o % 3 <> 0 THEN l_returnflag ELSE '' END AS platform_variant,
  'profile-a' AS profile_name, CAST(n AS BIGINT) AS n_elements,
  CASE WHEN n > 0 THEN 'el-' || l_linenumber || '-1' END AS first_element,
  CASE WHEN o % 5 <> 0 THEN 'ON' END AS power_state,
  CASE WHEN o % 4 = 0 THEN {AS_OF_US} ELSE epoch_us(l_shipdate) END AS observed_at,
  {AS_OF_US} AS updated_at, 'edge-unspecified' AS edge_id, 'region-unspecified' AS region_id
FROM l"""

ORACLE["explode_elements"] = f"""
WITH {LINES_LATEST}
SELECT 'array-' || o AS asset_id, i - 1 AS position, 'el-' || l_linenumber || '-' || i AS element_id,
  i AS layer_depth, l_linestatus AS layer_name, CASE WHEN i % 2 = 0 THEN 'OK' ELSE 'WARN' END AS health,
  l_quantity AS temp_c, l_discount AS load_pct, l_suppkey % 2 = 0 AS tx_active,
  CAST(NULL AS BOOLEAN) AS rx_active
FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM l)"""

ORACLE["proj_inventory"] = f"""
WITH t AS (
  SELECT *, p_partkey AS p, 'depot-' || (p_partkey % 50) AS asset_id,
         ((p_partkey * 7919) % 1000003) * 1000000000000 + p_partkey AS off
  FROM part WHERE p_partkey % 11 <> 0),
l AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY asset_id, p_brand ORDER BY off DESC) = 1)
SELECT asset_id || ':' || p_brand AS id, p_brand AS name, asset_id, p_brand AS layer_name,
  CAST(CASE WHEN p % 5 IN (2, 3) THEN 0 ELSE p_size END AS BIGINT) AS available_count,
  p % 9 AS allocated_count, {AS_OF_US} AS updated_at
FROM l"""

NO_PREFIX = "CAST(NULL AS VARCHAR) AS prefix"
NO_SITE = "CAST(NULL AS VARCHAR) AS fob_label, CAST(NULL AS DOUBLE) AS distance_km"

ORACLE["join_nearest_site"] = ORACLE["join_nearest_site_blocked"] = f"""
WITH {C}, {SITES}, {NEAREST}
SELECT c.asset_id, n.edge_id, n.region_id, CASE WHEN n.k IS NOT NULL THEN 'nearest_fob' END AS method,
  n.label AS fob_label, round(n.km, 2) AS distance_km, {NO_PREFIX}
FROM c LEFT JOIN n ON c.k = n.k"""

ORACLE["great_circle"] = f"""
WITH {C} SELECT asset_id, round({km("lat", "lon", "35.25e0", "-97.5e0")}, 3) AS km FROM c"""


def prefix_match(source: str) -> str:
    return f"""
WITH {C}, {source},
m AS (SELECT c.asset_id, d.* FROM c LEFT JOIN d ON starts_with(c.asset_id, d.prefix)
      QUALIFY row_number() OVER (PARTITION BY c.asset_id ORDER BY length(d.prefix) DESC NULLS LAST) = 1)
SELECT asset_id, edge_id, region_id,
  CASE WHEN prefix IS NOT NULL THEN 'asset_id_prefix' END AS method, {NO_SITE}, prefix
FROM m"""


ORACLE["join_longest_prefix"] = prefix_match("""d AS (SELECT * FROM (VALUES
  ('', 'edge-any', 'region-any'), ('Customer#0000000', 'edge-a', 'region-a'),
  ('Customer#00000001', 'edge-b', 'region-b'), ('Customer#000000012', 'edge-c', 'region-c'))
  AS v(prefix, edge_id, region_id))""")

ORACLE["join_longest_prefix_table"] = ORACLE["join_longest_prefix_blocked"] = prefix_match("""
n AS (SELECT s_suppkey AS s, 'Customer#' || lpad(CAST(s_suppkey * 7 AS VARCHAR), 9, '0') AS name
      FROM supplier),
q AS (SELECT DISTINCT CASE WHEN s % 3 = 0 THEN left(name, 15) WHEN s % 3 = 1 THEN left(name, 17)
      ELSE name END AS prefix FROM n),
d AS (SELECT prefix, 'edge-' || prefix AS edge_id, 'region-' || length(prefix) AS region_id FROM q)""")

ORACLE["join_static"] = f"""
WITH {C}, d AS (SELECT 'Customer#' || lpad(CAST(s_suppkey * 11 AS VARCHAR), 9, '0') AS asset_id,
  'edge-' || s_suppkey AS edge_id, 'region-' || (s_suppkey % 5) AS region_id FROM supplier)
SELECT c.asset_id, d.edge_id, d.region_id,
  CASE WHEN d.asset_id IS NOT NULL THEN 'static_map' END AS method, {NO_SITE}, {NO_PREFIX}
FROM c LEFT JOIN d ON c.asset_id = d.asset_id"""

ORACLE["join_static_config"] = f"""
WITH {C}
SELECT asset_id, CASE WHEN m THEN 'edge-' || (k // 3) END AS edge_id,
  CASE WHEN m THEN 'region-' || (k // 3 % 5) END AS region_id,
  CASE WHEN m THEN 'static_map' END AS method, {NO_SITE}, {NO_PREFIX}
FROM (SELECT *, k % 3 = 0 AND k < 1200 AS m FROM c)"""

ORACLE["join_chain_tables"] = f"""
WITH x AS ({ORACLE["join_static"]}), y AS ({ORACLE["join_longest_prefix_table"]})
SELECT asset_id, CASE WHEN x.method IS NULL THEN y.edge_id ELSE x.edge_id END AS edge_id,
  CASE WHEN x.method IS NULL THEN y.region_id ELSE x.region_id END AS region_id,
  coalesce(x.method, y.method) AS method, x.fob_label, x.distance_km,
  CASE WHEN x.method IS NULL THEN y.prefix END AS prefix
FROM x JOIN y USING (asset_id)"""

ORACLE["join_chain_fallback"] = f"""
WITH {C}, sites AS (SELECT * FROM (VALUES (0, 'f1', 'r1', 47.25e0, -12.5e0, 'north'),
    (1, 'f2', 'r2', 5.75e0, 118.5e0, 'east'), (2, 'f3', 'r3', -36.5e0, 61.25e0, ''))
    AS v(ordinal, edge_id, region_id, lat, lon, label)), {NEAREST},
x AS (SELECT c.asset_id, n.edge_id AS ne, n.region_id AS nr, n.label, n.km,
  CASE WHEN c.asset_id = 'Customer#000000003' THEN 'static_map'
       WHEN starts_with(c.asset_id, 'Customer#00000000') THEN 'asset_id_prefix'
       WHEN n.k IS NOT NULL THEN 'nearest_fob' ELSE 'fallback' END AS method,
  CASE WHEN starts_with(c.asset_id, 'Customer#000000007') THEN 'Customer#000000007'
       ELSE 'Customer#00000000' END AS hit
  FROM c LEFT JOIN n ON c.k = n.k)
SELECT asset_id,
  CASE method WHEN 'static_map' THEN 'edge-s' WHEN 'nearest_fob' THEN ne WHEN 'fallback' THEN 'edge-last'
       ELSE CASE WHEN hit = 'Customer#000000007' THEN 'edge-q' ELSE 'edge-p' END END AS edge_id,
  CASE method WHEN 'static_map' THEN 'region-s' WHEN 'nearest_fob' THEN nr WHEN 'fallback' THEN 'region-last'
       ELSE CASE WHEN hit = 'Customer#000000007' THEN 'region-q' ELSE 'region-p' END END AS region_id,
  method, CASE WHEN method = 'nearest_fob' THEN label END AS fob_label,
  CASE WHEN method = 'nearest_fob' THEN round(km, 2) END AS distance_km,
  CASE WHEN method = 'asset_id_prefix' THEN hit END AS prefix
FROM x"""

ORIGINS = """o AS (SELECT event_id, 'asset-' || user_id AS asset,
  CASE WHEN event_id % 4 > 1 THEN 'edge-' || (user_id % 5) END AS edge,
  CASE WHEN event_id % 3 = 2 THEN 'region-7' END AS region FROM events)"""

ORACLE["provenance_fieldwise"] = f"""
WITH {ORIGINS}
SELECT event_id, coalesce(edge, 'edge-01') AS edge_id, coalesce(region, 'region-01') AS region_id,
  (edge IS NULL OR region IS NULL) AS fallback FROM o"""

ORACLE["provenance_pair"] = f"""
WITH {ORIGINS}
SELECT event_id,
  CASE WHEN edge IS NOT NULL AND region IS NOT NULL THEN edge
       WHEN starts_with(asset, 'asset-1') THEN 'edge-one' ELSE 'edge-unspecified' END AS edge_id,
  CASE WHEN edge IS NOT NULL AND region IS NOT NULL THEN region
       WHEN starts_with(asset, 'asset-1') THEN 'region-one' ELSE 'region-unspecified' END AS region_id
FROM o"""

ORACLE["enum_names"] = """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'NAMED' WHEN event_id % 5 = 1 THEN 'NONE'
  WHEN event_id % 4 = 1 THEN 'ONE' WHEN event_id % 4 = 2 THEN 'TWO'
  ELSE CAST(event_id % 4 AS VARCHAR) END AS name FROM events"""

ORACLE["scalar_times"] = f"""
WITH {E}
SELECT event_id,
  CASE WHEN e % 6 = 0 THEN us WHEN e % 6 = 1 THEN us // 86400000000 * 86400000000
       WHEN e % 6 = 2 THEN us // 1000000 * 1000000 - 19800000000
       WHEN e % 6 = 4 THEN us // 1000000 * 1000000 END AS instant_us,
  CASE WHEN e % 5 <> 0 THEN us END AS ns_us,
  CASE WHEN e % 5 <> 0 THEN us ELSE -us END AS ns_any_us,
  e % 7200 AS seconds
FROM e"""

ORACLE["link_state"] = """
SELECT event_id, (event_id % 3 = 0 OR event_id % 4 = 0) AS severed FROM events"""

OFFSETS = """p AS (SELECT event_type AS topic, user_id % 4 AS part, min(event_id) AS lo,
  max(event_id) + 1 AS hi, count(*) AS n FROM events GROUP BY ALL),
o AS (SELECT topic, greatest(0, hi - CASE WHEN part = 3 THEN lo ELSE lo + n END) AS lag FROM p)"""

ORACLE["consumer_lag"] = f"""
WITH {OFFSETS} SELECT topic, CAST(sum(lag) AS BIGINT) AS lag FROM o GROUP BY topic"""

ORACLE["edge_buffer_status"] = f"""
WITH {OFFSETS}, t AS (SELECT CAST(sum(lag) AS BIGINT) AS lag FROM o WHERE topic IN ('click', 'error'))
SELECT case_name, 'edge' AS id, CASE WHEN case_name = 'case-2' THEN -1 ELSE lag END AS bridge_group_lag,
  false AS hq_link_severed, case_name = 'case-1' AS probe_healthy, {AS_OF_US} AS updated_at
FROM t, (VALUES ('case-1'), ('case-2'), ('case-3')) AS v(case_name)"""


def throttle(ticks: str, key: str, window: int, keep: int | None = None) -> str:
    """Follow each report to the next one at least a window later; counts older than ``keep`` are forgotten."""
    left_out = "b.before - a.before - 1"
    if keep is not None:
        left_out = f"CASE WHEN b.second - a.second > {keep} THEN 0 ELSE {left_out} END"
    same = " AND ".join(f"a.{k} = b.{k}" for k in key.split(", "))
    columns = ", ".join(f"b.{k}" for k in key.split(", "))
    return f"""
WITH RECURSIVE {ticks},
d AS (SELECT *, CAST(sum(n) OVER (PARTITION BY {key} ORDER BY second) - n AS BIGINT) AS before,
             second + {window} AS until FROM t),
j AS (SELECT a.*, b.second AS following FROM d a ASOF LEFT JOIN d b ON {same} AND a.until <= b.second),
r AS (
  (SELECT *, CAST(0 AS BIGINT) AS suppressed FROM j
   QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY second) = 1)
  UNION ALL
  SELECT b.*, {left_out} AS suppressed
  FROM r a JOIN j b ON {same} AND a.following = b.second)
SELECT {key}, second, suppressed FROM r"""


ORACLE["fallback_throttle"] = throttle(
    "t AS (SELECT event_type, user_id, epoch_us(ts) // 1000000 AS second, count(*) AS n "
    "FROM events GROUP BY ALL)",
    "event_type, user_id", 21600,
)

ORACLE["projected_fallbacks"] = throttle(
    f"{E}, t AS (SELECT 'tactical-events' AS topic, asset AS subject, "
    f"CASE WHEN e % 29 = 11 THEN {AS_OF_US} ELSE us END // 1000000 AS second, "
    "count(*) AS n FROM e WHERE e % 4 = 1 OR e % 5 = 1 GROUP BY ALL)",
    "topic, subject", 86400,
)

ORACLE["first_present"] = """
SELECT event_id, CASE WHEN event_id % 3 = 1 THEN '0' WHEN event_id % 2 = 0 THEN '' ELSE 'c-' || event_id END AS found FROM events"""

ORACLE["blobs_as_text"] = f"""
WITH {E}, {latest("u")}, p AS ({ORACLE["proj_telemetry_latest"]})
SELECT asset AS asset_id, CASE WHEN e % 4 = 3 THEN '[]' ELSE '[' || array_to_string(list_transform(range(1, e % 3 + 2),
  lambda i: '{{"ci_id":' || e || ',"slot_id":"slot-' || i || '"}}'), ',') || ']' END AS blob FROM l
UNION ALL SELECT asset_id, CASE WHEN NOT no_sustainment THEN 'some' END FROM p"""

ORACLE["proj_configured_fields"] = ORACLE["proj_cm_state"]

OTHER = "CASE WHEN e % 6 = 1 THEN 'other' ELSE asset END"
ORACLE["proj_configured_handler"] = f"""
WITH {E}, {latest(OTHER, "e % 97 <> 13")}
SELECT {OTHER} AS asset_id, CASE WHEN e % 2 = 0 THEN e % 1000 ELSE 0 END AS status_revision, {AS_OF_US} AS updated_at FROM l"""

ORACLE["stream_fallbacks"] = throttle(
    f"{E}, t AS (SELECT 'asset-cm-state' AS topic, CASE WHEN e % 3 = 1 THEN 'edge-01' ELSE 'edge-' || (u % 5) END AS edge_id, "
    "asset AS row_key, (e * 7919) % 1000003 AS second, count(*) AS n FROM e WHERE e % 3 = 1 OR e % 4 = 1 GROUP BY ALL)",
    "topic, edge_id, row_key", 21600, 86400,
)

ORACLE["stream_lag"] = f"""
WITH {E}, p AS (
  SELECT u % 4 AS partition, min(off) AS lo, max(off) + 1 AS hi,
    coalesce(max(off) FILTER (WHERE off < {HALF} AND u % 4 < 3) + 1, -1001) AS committed FROM e GROUP BY 1),
l AS (SELECT *, greatest(0, hi - CASE WHEN committed >= 0 THEN committed ELSE lo END) AS lag FROM p)
SELECT 'asset-cm-state' AS topic, CAST(partition AS INTEGER) AS partition, committed, lag,
  CAST(sum(lag) OVER () AS BIGINT) AS topic_lag FROM l"""

ORACLE["stream_metrics"] = f"""
WITH {E}
SELECT 'messages_consumed' AS metric, 'asset-logistics-status' AS label, count(*) AS value FROM e
UNION ALL SELECT 'rows_written', 'asset_logistics_status', 
       count(DISTINCT (((e * 7919) % 1000003) * 4 // 1000003, u)) FROM e WHERE e % 97 <> 13
UNION ALL SELECT 'decode_errors', 'asset-logistics-status:handler_exception', count(*)
          FROM e WHERE e % 97 = 13"""

ORACLE["maintain_tables"] = f"""
WITH {E}, {latest("u", "u % 3 <> 0")}
SELECT asset AS asset_id, 'base-' || (e % 7) AS baseline_id, {AS_OF_US} AS updated_at FROM l"""

ORACLE["pruned_rows"] = f"""
WITH {E}
SELECT 'rows_pruned' AS metric, 'asset_cm_state' AS label, count(DISTINCT u) AS value FROM e WHERE u % 3 = 0"""

ORACLE["changelog_compaction"] = f"""
WITH {E}, {latest("u")}
SELECT asset AS asset_id,
  CASE WHEN e % 3 = 1 THEN 'edge-01' ELSE 'edge-' || (u % 5) END AS edge_id,
  CASE WHEN e % 4 = 1 THEN 'region-01' ELSE 'region-7' END AS region_id,
  'base-' || (e % 7) AS baseline_id,
  CASE WHEN e % 9 = 2 THEN 'LIFECYCLE_UNSPECIFIED' WHEN e % 4 = 2 THEN 'LIFECYCLE_ACTIVE'
       ELSE CAST(e % 4 AS VARCHAR) END AS lifecycle,
  CASE WHEN e % 2 = 0 THEN 'CONFIG_STATUS_DEGRADED' ELSE 'CONFIG_STATUS_UNSPECIFIED' END AS overall_status,
  CASE WHEN e % 6 <> 3 THEN us END AS as_of
FROM l"""

ORACLE["upkeep_beside_stream"] = f"""
WITH {E}, {latest("u")}
SELECT asset AS asset_id, 'base-' || (e % 7) AS baseline_id, {AS_OF_US} AS updated_at FROM l"""

ORACLE["leveled_runs"] = f"""
WITH {E}, {latest("u")}
SELECT asset AS asset_id, 'base-' || (e % 7) AS baseline_id, CASE WHEN e % 6 <> 3 THEN us END AS as_of, TRUE AS few_runs FROM l"""

ORACLE["event_log_upkeep"] = f"""
WITH {E}
SELECT {EVENT_COLUMNS}, asset AS subject, {EVENT_SEVERITY}, {EVENT_TIME} AS time,
  (SELECT count(*) FROM e WHERE NOT ({EVENT_KEPT})) AS pruned
FROM e WHERE {EVENT_KEPT}"""
