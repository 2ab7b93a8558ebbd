"""The same queries as plain SQL, for checking against another engine.

Only the formulas of the derived flows are shared with the Spark side; all other
logic is written out again here.
"""

from __future__ import annotations

from netsift.operators.lookups import DESCRIPTIONS, OTHER_DESCRIPTION
from netsift.operators.report import TEXTS
from netsift.plans.flows import BATCH_ROWS, feature_sql, label_sql, port_sql, source_sql
from netsift.schema import FEATURES

F = ", ".join(FEATURES)

_FLOWS = f"""
base AS (SELECT event_id AS k, ts AS t, user_id AS u FROM events),
labelled AS (SELECT *, {label_sql()} AS lbl FROM base),
flows AS (
  SELECT k AS flow_id, k // {BATCH_ROWS} AS batch_id, t AS "timestamp",
    {source_sql()} AS src_ip, '203.0.113.' || (1 + k % 254) AS dst_ip,
    {port_sql("src")} AS src_port, {port_sql("dst")} AS dst_port,
    CASE WHEN k % 487 = 0 THEN NULL WHEN k % 3 = 0 THEN 'TCP' WHEN k % 3 = 1 THEN 'UDP' ELSE 'ICMP' END AS protocol,
    CAST(lbl AS DOUBLE) AS true_label,
    {", ".join(f"{feature_sql(c)} AS {c}" for c in FEATURES)}
  FROM labelled)"""


def _zeroed(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0::DOUBLE ELSE {c} END AS {c}"


_ID = 'flow_id, batch_id, "timestamp", src_ip, dst_ip, src_port, dst_port, protocol, true_label'

_DETECTOR = """CASE WHEN flow_bytes_per_sec > 100000 OR flow_packets_per_sec > 10000 OR syn_flag_count > 100
       OR fin_flag_count > 100 OR rst_flag_count > 50 OR (fwd_iat_mean IS NULL AND flow_duration > 0)
       OR total_fwd_packets > 5000 OR total_backward_packets > 5000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction"""

_SCORED = f"""{_FLOWS},
cleaned AS (SELECT {_ID}, {", ".join(_zeroed(c) for c in FEATURES)} FROM flows),
predicted AS (SELECT *, {_DETECTOR} FROM cleaned),
scored AS (SELECT *, CASE WHEN prediction = 0 THEN 'BENIGN'
    WHEN flow_bytes_per_sec > 500000 AND flow_packets_per_sec > 50000 THEN 'DDoS'
    WHEN total_fwd_packets > 5000 AND flow_bytes_per_sec > 200000 THEN 'DoS Hulk'
    WHEN syn_flag_count > 200 AND flow_duration < 1000 THEN 'PortScan'
    WHEN fin_flag_count > 100 OR rst_flag_count > 50 THEN 'Brute Force'
    WHEN total_backward_packets > 5000 AND packet_length_mean < 100 THEN 'Bot'
    WHEN total_fwd_packets > 3000 AND fwd_psh_flags > 50 THEN 'Web Attack - XSS'
    ELSE 'Infiltration' END AS attack_type,
    CASE WHEN prediction = 1 THEN 'high' ELSE 'low' END AS severity FROM predicted),
alerts AS (SELECT flow_id, batch_id, "timestamp", attack_type, src_ip, dst_ip, src_port, dst_port, protocol,
    severity, prediction, true_label FROM scored),
attacks AS (SELECT * FROM alerts WHERE attack_type NOT IN ('BENIGN', 'Normal')),
clock AS (SELECT max("timestamp") AS now FROM alerts)"""

_BATCHES = f"""{_SCORED},
counts AS (SELECT batch_id, max("timestamp") AS "timestamp", count(*) AS total,
    count(*) FILTER (WHERE prediction = 1 AND true_label = 1) AS tp,
    count(*) FILTER (WHERE prediction = 0 AND true_label = 0) AS tn,
    count(*) FILTER (WHERE prediction = 1 AND true_label = 0) AS fp,
    count(*) FILTER (WHERE prediction = 0 AND true_label = 1) AS fn,
    count(*) FILTER (WHERE prediction = 0) AS normal_count,
    count(*) FILTER (WHERE prediction = 1) AS attack_count
  FROM scored GROUP BY batch_id),
ratios AS (SELECT *, (tp + tn) / total AS accuracy,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0::DOUBLE END AS "precision",
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0::DOUBLE END AS recall FROM counts),
metrics AS (SELECT batch_id, "timestamp", total AS total_samples, tp AS true_positives, tn AS true_negatives,
    fp AS false_positives, fn AS false_negatives, accuracy, "precision", recall,
    CASE WHEN "precision" + recall > 0 THEN 2.0::DOUBLE * "precision" * recall / ("precision" + recall)
         ELSE 0.0::DOUBLE END AS f1_score FROM ratios),
stats AS (SELECT batch_id, "timestamp", total AS total_packets, normal_count, attack_count,
    normal_count / total * 100 AS normal_percentage, attack_count / total * 100 AS attack_percentage FROM counts),
day_stats AS (SELECT * FROM stats WHERE "timestamp" >= (SELECT now FROM clock) - INTERVAL 24 HOUR)"""


def _octet(i: int) -> str:
    return f"CAST(split_part(address, '.', {i}) AS BIGINT)"


_HASH = f"CASE WHEN address = '' OR address IS NULL THEN NULL ELSE (({_octet(1)} * 31 + {_octet(2)}) * 31 + {_octet(3)}) * 31 + {_octet(4)} END"
_LAT = "coalesce(33.5731::DOUBLE + (h % 7000) / 1000.0::DOUBLE, 33.5731::DOUBLE)"
_LON = "coalesce(-7.5898::DOUBLE + ((h // 7000) % 7000) / 1000.0::DOUBLE, -7.5898::DOUBLE)"

_GEO = f"""{_SCORED},
located AS (SELECT *, {_HASH} AS h FROM (SELECT *, CASE WHEN src_ip = '' THEN '0.0.0.0' ELSE src_ip END AS address
    FROM alerts WHERE src_ip IS NOT NULL)),
geo AS (SELECT flow_id, batch_id, address AS src_ip, attack_type, severity, "timestamp",
    {_LAT} AS latitude, {_LON} AS longitude, 'hash' AS geo_source FROM located)"""

_RANGES = f"""{_FLOWS},
hashed AS (SELECT flow_id, src_ip, {_HASH} AS h,
    CASE WHEN address = '' OR address IS NULL THEN NULL ELSE
      (({_octet(1)} * 256 + {_octet(2)}) * 256 + {_octet(3)}) * 256 + {_octet(4)} END AS num
  FROM (SELECT *, src_ip AS address FROM flows)),
places AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 3323068416 ELSE 2886729728 END + (s_suppkey // 2) * 16 AS ip_from,
    30.0::DOUBLE + (s_suppkey % 1000) / 100.0::DOUBLE AS lat, -10.0::DOUBLE + (s_suppkey % 700) / 100.0::DOUBLE AS lon FROM supplier)"""

_RANGE_SQL = f"""WITH {_RANGES}
SELECT flow_id, src_ip, coalesce(lat, {_LAT}) AS latitude, coalesce(lon, {_LON}) AS longitude,
  CASE WHEN lat IS NOT NULL THEN 'range' WHEN h IS NOT NULL THEN 'hash' ELSE 'default' END AS geo_source
FROM hashed LEFT JOIN places ON num BETWEEN ip_from AND ip_from + 7"""

_FACTS = f"""{_BATCHES},
kinds AS (SELECT attack_type, count(*) AS cnt FROM attacks GROUP BY attack_type),
top AS (SELECT * FROM kinds ORDER BY cnt DESC, attack_type LIMIT 1),
points AS (SELECT *, row_number() OVER (ORDER BY "timestamp" DESC, batch_id DESC) AS n FROM day_stats),
recent_mean AS (SELECT sum(attack_percentage) / 5 AS m FROM points WHERE n <= 5),
series AS (SELECT
    (SELECT max(n) FROM points) AS points,
    coalesce((SELECT attack_percentage FROM points WHERE n = 1)
      > (SELECT attack_percentage FROM points WHERE n = least(5, (SELECT max(n) FROM points))), false) AS up,
    CASE WHEN (SELECT max(n) FROM points) > 5 THEN
      floor(sqrt((SELECT sum((attack_percentage - (SELECT m FROM recent_mean)) ** 2) FROM points WHERE n <= 10) / 10) * 100 + 0.5) / 100
      ELSE 0.0::DOUBLE END AS volatility),
ips AS (SELECT src_ip, count(*) AS cnt, row_number() OVER (ORDER BY count(*) DESC, src_ip NULLS LAST) AS place
    FROM attacks GROUP BY src_ip),
facts AS (SELECT series.*, top.attack_type AS top_type, top.cnt AS top_count,
    (SELECT coalesce(avg(attack_percentage), 0) FROM day_stats) AS attack_pct,
    (SELECT count(*) FROM alerts WHERE "timestamp" >= (SELECT now FROM clock) - INTERVAL 24 HOUR) AS total_24h,
    (SELECT count(*) FROM alerts WHERE attack_type = 'BENIGN') AS benign,
    (SELECT CAST(sum(cnt) AS BIGINT) FROM kinds) AS attack_total, (SELECT count(*) FROM kinds) AS kinds
  FROM series, top)"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, *values: str) -> str:
    """Concatenation of a ``%s`` template with SQL text values."""
    pieces = template.replace("%%", "\0").split("%s")
    parts = [_literal(pieces[0].replace("\0", "%"))]
    for value, piece in zip(values, pieces[1:]):
        parts += [value, _literal(piece.replace("\0", "%"))]
    return " || ".join(parts)


_PCT = "printf('%.1f', round(attack_pct, 1))"
_LISTING = 'flow_id, "timestamp", attack_type, src_ip, dst_ip, src_port, dst_port, protocol, severity, prediction'
_NEWEST = '"timestamp" DESC, flow_id DESC'
_SINCE_DAY = '"timestamp" >= (SELECT now FROM clock) - INTERVAL 24 HOUR'
_RISK = "CASE WHEN attack_pct > 35 THEN 'Critical' WHEN attack_pct > 25 THEN 'High' WHEN attack_pct > 15 THEN 'Medium' ELSE 'Low' END AS risk_level"
_KINDS = "SELECT attack_type, count(*) AS cnt FROM attacks GROUP BY attack_type"
_DESCRIPTION = "CASE attack_type " + " ".join(
    f"WHEN {_literal(k)} THEN {_literal(v)}" for k, v in DESCRIPTIONS.items()
) + f" ELSE {_literal(OTHER_DESCRIPTION)} END"

_FILES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _flows(select: str) -> str:
    return f"WITH {_FLOWS} {select}"


def _alerts(select: str) -> str:
    return f"WITH {_SCORED} {select}"


def _batches(select: str) -> str:
    return f"WITH {_BATCHES} {select}"


def _geo(select: str) -> str:
    return f"WITH {_GEO} {select}"


def _report(select: str) -> str:
    return f"WITH {_FACTS} {select}"


def _mapped(rule, columns=FEATURES) -> str:
    return ", ".join(rule(c) if c in columns else c for c in FEATURES)


_RATES = ("flow_bytes_per_sec", "flow_packets_per_sec")
_OTHERS = tuple(c for c in FEATURES if c not in _RATES)


def _fill(c: str) -> str:
    return f"coalesce({c}, 0.0::DOUBLE) AS {c}"


def _fill_rate(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = 'Infinity'::DOUBLE THEN 0.0::DOUBLE ELSE {c} END AS {c}"


def _finite(c: str) -> str:
    return f"CASE WHEN isnan({c}) OR isinf({c}) THEN 0.0::DOUBLE ELSE {c} END AS {c}"


_WIRE_TIME = "strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%fZ') AS \"timestamp\""
_WIRE_COLUMNS = f"src_ip, dst_ip, src_port, dst_port, protocol, {_WIRE_TIME}, {F}, true_label"
_MINUTE = "date_trunc('minute', \"timestamp\")::TIMESTAMP"
_HOUR = "date_trunc('hour', \"timestamp\")::TIMESTAMP"
_CLASS_FEATURES = (
    "flow_bytes_per_sec", "flow_packets_per_sec", "syn_flag_count",
    "flow_duration", "total_fwd_packets", "total_backward_packets",
)
_CHECKED = ("flow_bytes_per_sec", "syn_flag_count", "flow_duration", "total_fwd_packets", "true_label")
_TIMELINE = f"SELECT {_MINUTE} AS minute, attack_type, count(*) AS cnt FROM attacks WHERE {_SINCE_DAY} GROUP BY 1, 2"
_TYPES = {
    "ddos": "DDoS", "dos_hulk": "DoS Hulk", "portscan": "PortScan", "brute_force": "Brute Force",
    "bot": "Bot", "web_attack_xss": "Web Attack - XSS", "infiltration": "Infiltration",
}
_HOURLY = ("dos_hulk", "infiltration", "portscan", "brute_force")


def _bucket(seconds: int) -> str:
    return (
        f"SELECT make_timestamp(epoch_us(\"timestamp\") - epoch_us(\"timestamp\") % {seconds * 1_000_000}) AS bucket, "
        "count(*) AS cnt FROM alerts GROUP BY 1"
    )


def _risk_case(levels) -> str:
    return "CASE " + " ".join(f"WHEN cnt > {n} THEN '{name}'" for n, name in levels) + " ELSE 'Info' END AS risk"


_RECOMMEND = f"""SELECT ord, priority, text FROM (
  SELECT 1 AS ord, 'high' AS priority, {_filled(TEXTS["dominant"], "top_type")} AS text FROM facts WHERE top_count > 100000
  UNION ALL SELECT 2, 'high', {_filled(TEXTS["share"], _PCT)} FROM facts WHERE attack_pct > 30
  UNION ALL SELECT 3, 'medium', {_literal(TEXTS["trend"])} FROM facts WHERE up
  UNION ALL SELECT 4, 'medium', {_filled(TEXTS["volatility"], "CAST(volatility AS VARCHAR)")} FROM facts WHERE volatility > 5
  UNION ALL SELECT 5, 'low', {_literal(TEXTS["benign"])} FROM facts WHERE benign > 0 AND benign > attack_total * 2)"""

_SUMMARY = "SELECT " + _filled(
    TEXTS["summary"],
    "format('{:,}', total_24h)", _PCT, "CAST(kinds AS VARCHAR)", "top_type", "format('{:,}', top_count)",
    "(SELECT string_agg(src_ip || ' (' || cnt || ' packets)', ', ' ORDER BY place) FROM ips WHERE place <= 3)",
) + " AS summary FROM facts"

_VOL = "CAST(volatility AS VARCHAR)"
_WHOLE = "printf('%.0f', round(attack_pct, 0))"
_NARRATIVE = f"""SELECT CASE WHEN up THEN {_filled(TEXTS["rising"], "CAST(least(points, 5) AS VARCHAR)", _VOL)}
  WHEN volatility < 3 THEN {_filled(TEXTS["steady"], _VOL)} ELSE {_filled(TEXTS["varying"], _VOL)} END AS trend_text,
  CASE WHEN volatility > 5 THEN {_filled(TEXTS["burst"], _WHOLE)} ELSE {_filled(TEXTS["sustained"], _WHOLE)} END AS pattern_text
  FROM facts"""

_DASHBOARD = f"""{_BATCHES},
recent AS (SELECT count(*) FILTER (WHERE "timestamp" >= now - INTERVAL 1 HOUR) AS h1, count(*) AS h24,
    count(*) FILTER (WHERE "timestamp" >= now - INTERVAL 1 HOUR AND severity = 'high') AS hs
  FROM alerts, clock WHERE {_SINCE_DAY}),
newest AS (SELECT * FROM stats ORDER BY "timestamp" DESC, batch_id DESC LIMIT 1)
SELECT section, name, "at", round(value, 6) AS value FROM (
  SELECT 'counts' AS section, 'alerts_last_hour' AS name, NULL::TIMESTAMP AS "at", CAST(h1 AS DOUBLE) AS value FROM recent
  UNION ALL SELECT 'counts', 'alerts_last_24h', NULL, h24 FROM recent
  UNION ALL SELECT 'counts', 'high_severity', NULL, hs FROM recent
  UNION ALL SELECT 'attack_distribution', attack_type, NULL, cnt FROM ({_KINDS})
  UNION ALL SELECT 'top_ips', src_ip, NULL, cnt FROM (SELECT src_ip, count(*) AS cnt FROM attacks GROUP BY src_ip ORDER BY cnt DESC, src_ip NULLS LAST LIMIT 10)
  UNION ALL SELECT 'latest', 'total_packets', "timestamp", total_packets FROM newest
  UNION ALL SELECT 'latest', 'normal_percentage', "timestamp", normal_percentage FROM newest
  UNION ALL SELECT 'latest', 'attack_percentage', "timestamp", attack_percentage FROM newest
  UNION ALL SELECT 'traffic_timeline', CAST(batch_id AS VARCHAR), "timestamp", attack_percentage FROM day_stats
  UNION ALL SELECT 'mean', 'avg_attack_percentage_24h', NULL, coalesce(avg(attack_percentage), 0) FROM day_stats
  UNION ALL SELECT 'attack_summaries', attack_type, max("timestamp"), count(*) FROM alerts GROUP BY attack_type)"""


def _top(table: str, key: str, limit: int | None = None) -> str:
    tail = f" LIMIT {limit}" if limit else ""
    return f"SELECT {key}, count(*) AS cnt FROM {table} GROUP BY {key} ORDER BY cnt DESC, {key} NULLS LAST{tail}"


def _decimal_percent(c: str) -> str:
    return f'CAST(round(CAST("{c}" AS DECIMAL(18,15)) * 100, 1) AS DOUBLE) AS "{c}"'


_HOUR_TEXT = "strftime(date_trunc('hour', \"timestamp\")::TIMESTAMP, '%Y-%m-%dT%H:%M:%S.%fZ')"
_ROLLUPS = f"""SELECT 'attack_distribution' AS rollup, attack_type AS name, count(*) AS cnt FROM attacks GROUP BY attack_type
UNION ALL SELECT 'top_ips', coalesce(src_ip, ''), cnt FROM ({_top("attacks", "src_ip", 50)})
UNION ALL SELECT 'attack_hourly', {_HOUR_TEXT} || '|' || attack_type AS name, count(*) FROM attacks GROUP BY name
UNION ALL SELECT 'protocol_stats', protocol, count(*) FROM attacks WHERE protocol IS NOT NULL GROUP BY protocol
UNION ALL SELECT 'severity_timeline', {_HOUR_TEXT} || '|' || severity AS name, count(*) FROM attacks GROUP BY name"""
_TABLE_COUNTS = (
    "SELECT (SELECT count(*) FROM alerts) AS alerts, (SELECT count(*) FROM geo) AS attacks_geo, "
    "(SELECT count(*) FROM alerts) AS total_packets"
)


# The topic has six files of as many offsets, each a batch of the stream.
_FILE = "k // ((SELECT max(event_id) FROM events) // 6 + 1)"


def _by_stream(sql: str) -> str:
    """The same over the batches of the stream."""
    return sql.replace(f"k // {BATCH_ROWS} AS batch_id", f"{_FILE} AS batch_id")


_DAMAGED = f"""{_FLOWS},
planted AS (SELECT *, CASE WHEN flow_id % 97 = 5 THEN 'malformed' WHEN flow_id % 89 = 7 THEN 'future'
  WHEN flow_id % 83 = 3 THEN 'past' ELSE 'alert' END AS kind FROM flows)"""

_MIDDLE = f"""SELECT {_LISTING} FROM (
  SELECT *, row_number() OVER (ORDER BY {_NEWEST}) - 1 AS place FROM alerts), (SELECT count(*) // 50 // 2 * 50 AS first FROM alerts)
WHERE place >= first AND place < first + 50"""

# Innermost range: the one that starts last, of these the one that ends first.
_INNER = "row_number() OVER (PARTITION BY flow_id ORDER BY low DESC, high, lat, lon) AS place"

_NESTED_SQL = f"""WITH {_RANGES},
near AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 3323068416 ELSE 2886729728 END + (s_suppkey // 2) * 16 AS base FROM supplier),
every AS (
  SELECT ip_from AS low, ip_from + 7 AS high, lat, lon FROM places
  UNION ALL SELECT base, base + 99, (50 + k % 30)::DOUBLE, 60 FROM near WHERE k % 5 = 0
  UNION ALL SELECT base + 4, base + 43, (-20 - k % 30)::DOUBLE, -60 FROM near WHERE k % 7 = 0
  UNION ALL SELECT b + n_nationkey * 256, b + n_nationkey * 256 + 255, (80 - n_nationkey)::DOUBLE, (10 + n_nationkey)::DOUBLE
    FROM nation, (VALUES (3323068416), (2886729728)) AS v(b)
),
found AS (SELECT flow_id, lat, lon, {_INNER} FROM hashed JOIN every ON num BETWEEN low AND high)
SELECT a.flow_id, a.src_ip, coalesce(f.lat, {_LAT}) AS latitude, coalesce(f.lon, {_LON}) AS longitude,
  CASE WHEN f.lat IS NOT NULL THEN 'range' WHEN h IS NOT NULL THEN 'hash' ELSE 'default' END AS geo_source
FROM hashed a LEFT JOIN (SELECT * FROM found WHERE place = 1) f ON f.flow_id = a.flow_id"""

_IPV6_SQL = f"""WITH addresses AS (
  SELECT event_id AS flow_id, event_id % 5000 // 256 AS x, event_id % 5000 % 256 AS y, event_id % 7 + 1 AS z FROM events),
every AS (
  SELECT s_suppkey % 20 * 65536 + s_suppkey % 252 AS low, s_suppkey % 20 * 65536 + s_suppkey % 252 + 3 AS high,
    (s_suppkey % 90)::DOUBLE AS lat, (s_suppkey % 170)::DOUBLE AS lon FROM supplier
  UNION ALL SELECT s_suppkey * 65536, s_suppkey * 65536 + 65535, (s_suppkey + 100)::DOUBLE, 7 FROM supplier
    WHERE s_suppkey < 20 AND s_suppkey % 3 <> 0
  UNION ALL SELECT -1, 4294967296, 1, 2
),
found AS (SELECT flow_id, x, y, z, lat, lon, {_INNER} FROM addresses JOIN every ON x * 65536 + y BETWEEN low AND high)
SELECT flow_id, CASE WHEN flow_id % 3 = 0 THEN format('2001:0DB8:{{:04x}}:{{:x}}:0:0:0:{{:x}}', x, y, z)
  ELSE format('2001:db8:{{:x}}:{{:x}}::{{:x}}', x, y, z) END AS src_ip, lat AS latitude, lon AS longitude, 'range' AS geo_source
FROM found WHERE place = 1"""


ORACLE: dict[str, str] = {
    "raw_value_cast": "SELECT props AS raw_value FROM events",
    "parquet_audit": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file, 'OK' AS status, count(*) AS row_count FROM {t}" for t in _FILES
    ),
    "parse_flows": _flows(f"SELECT flow_id, {_WIRE_COLUMNS} FROM flows"),
    "rename_fields": _flows(
        f'SELECT flow_id, src_ip, dst_ip, src_port, dst_port, protocol, "timestamp", {F}, true_label FROM flows'
    ),
    "normalize_columns": _flows(f"SELECT flow_id, {F}, true_label FROM flows"),
    "unpack_features": _flows(f"SELECT flow_id, {F}, true_label FROM flows"),
    "add_missing_features": _flows(
        "SELECT flow_id, "
        + _mapped(lambda c: f"0.0::DOUBLE AS {c}", ("active_mean", "idle_mean", "flow_duration")) + " FROM flows"
    ),
    "fill_nulls": _flows(f"SELECT flow_id, {_mapped(_fill, _OTHERS)} FROM flows"),
    "fill_rates": _flows(f"SELECT flow_id, {_mapped(_fill_rate, _RATES)} FROM flows"),
    "clean_stream": _flows(
        "SELECT flow_id, " + _mapped(lambda c: _fill_rate(c) if c in _RATES else _fill(c)) + " FROM flows"
    ),
    "clean_nonfinite": _flows(f"SELECT flow_id, {_mapped(_finite)} FROM flows"),
    "clean_all": _flows(f"SELECT flow_id, {_mapped(_zeroed)} FROM flows"),
    "drop_incomplete": _flows(
        f"SELECT flow_id, {F} FROM flows WHERE "
        + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURES)
    ),
    "label_text": _flows(
        "SELECT flow_id, CASE WHEN true_label = 1 THEN 'Attack' ELSE 'Normal' END AS label "
        "FROM flows WHERE true_label IS NOT NULL"
    ),
    "training_rows": _alerts(f"SELECT flow_id, {F}, true_label FROM scored WHERE true_label IS NOT NULL"),
    "rule_detector": _flows(f"SELECT flow_id, {_DETECTOR} FROM flows"),
    "attack_type": _alerts("SELECT flow_id, prediction, attack_type FROM scored"),
    "alerts": _alerts("SELECT * FROM alerts"),
    "severity": _alerts("SELECT flow_id, severity FROM alerts"),
    "severity_label": _alerts(
        "SELECT flow_id, severity, CASE severity WHEN 'high' THEN 'HAUTE' WHEN 'medium' THEN 'MOYENNE' "
        "WHEN 'low' THEN 'FAIBLE' ELSE severity END AS severity_label FROM alerts"
    ),
    "attack_descriptions": _alerts(f"SELECT attack_type, cnt, {_DESCRIPTION} AS description FROM ({_KINDS})"),
    "geo_hash": f"WITH {_RANGES} SELECT flow_id, src_ip, {_LAT} AS latitude, {_LON} AS longitude, "
    "CASE WHEN h IS NULL THEN 'default' ELSE 'hash' END AS geo_source FROM hashed",
    "geo_range_join": _RANGE_SQL,
    "geo_range_join_shuffled": _RANGE_SQL,
    "geo_defaults": _geo('SELECT flow_id, src_ip, attack_type, severity, "timestamp" FROM geo'),
    "geo_point": _geo("SELECT flow_id, longitude AS lon, latitude AS lat, 4326 AS srid FROM geo"),
    "attacks_geo": _geo("SELECT * FROM geo"),
    "geo_map": _geo(
        "SELECT flow_id, latitude, longitude, src_ip, attack_type, severity FROM geo "
        f"WHERE attack_type NOT IN ('BENIGN', 'Normal', 'Attack') ORDER BY {_NEWEST} LIMIT 1000"
    ),
    "geo_bbox": _geo(
        "SELECT min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, "
        "max(longitude) AS max_lon, count(*) AS points "
        f"FROM (SELECT * FROM geo ORDER BY {_NEWEST} LIMIT 500) WHERE latitude <> 0 AND longitude <> 0"
    ),
    "geo_recent": _geo(f"SELECT * FROM geo ORDER BY {_NEWEST} LIMIT 500"),
    "geo_since": _geo(f"SELECT * FROM geo WHERE {_SINCE_DAY} ORDER BY {_NEWEST}"),
    "geo_count_by_type": _geo("SELECT count(*) AS cnt FROM geo WHERE attack_type = 'PortScan'"),
    "confusion_matrix": _batches(
        "SELECT batch_id, total AS total_samples, tp AS true_positives, tn AS true_negatives, "
        "fp AS false_positives, fn AS false_negatives FROM counts"
    ),
    "model_metrics": _batches("SELECT * FROM metrics"),
    "metrics_timeline": _batches('SELECT * FROM metrics ORDER BY "timestamp", batch_id'),
    "metrics_percent": _batches(
        'SELECT batch_id, "timestamp", '
        + ", ".join(_decimal_percent(c) for c in ("accuracy", "precision", "recall", "f1_score"))
        + ' FROM metrics ORDER BY "timestamp", batch_id'
    ),
    "retrain_annotations": _batches(
        "SELECT \"timestamp\", 'Training batch: ' || batch_id AS text FROM metrics WHERE accuracy > 0.999"
    ),
    "traffic_stats": _batches("SELECT * FROM stats"),
    "traffic_totals": _batches(
        "SELECT "
        + ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in ("total_packets", "normal_count", "attack_count"))
        + " FROM stats"
    ),
    "traffic_means": _batches(
        "SELECT round(coalesce(avg(normal_percentage), 0), 6) AS normal_percentage, "
        "round(coalesce(avg(attack_percentage), 0), 6) AS attack_percentage, "
        "round(sum(attack_count)::DOUBLE / sum(total_packets)::DOUBLE * 100, 6) AS weighted_attack_percentage FROM stats"
    ),
    "avg_attack_pct": _batches(
        "SELECT round(coalesce(avg(attack_percentage), 0), 6) AS avg_attack_percentage FROM day_stats"
    ),
    "hourly_volume": _batches(
        f"SELECT {_HOUR} AS hour, avg(total_packets) AS avg_packets, max(total_packets) AS max_packets, "
        "min(total_packets) AS min_packets FROM stats GROUP BY 1"
    ),
    "latest_stats": _batches('SELECT * FROM stats ORDER BY "timestamp" DESC, batch_id DESC LIMIT 1'),
    "traffic_timeline": _batches('SELECT * FROM day_stats ORDER BY "timestamp", batch_id'),
    "traffic_timeline_all": _batches('SELECT * FROM stats ORDER BY "timestamp", batch_id'),
    "series_reduce": _batches(
        'SELECT round(sum(attack_percentage), 6) AS "sum", max(attack_percentage) AS "max", '
        'round(avg(attack_percentage), 6) AS mean, min(attack_percentage) AS "min", '
        '(SELECT attack_percentage FROM stats ORDER BY "timestamp" DESC, batch_id DESC LIMIT 1) AS "last" FROM stats'
    ),
    "attack_summary": _alerts(
        'SELECT attack_type, count(*) AS "count", max("timestamp") AS last_seen, avg(prediction) AS avg_confidence '
        "FROM scored GROUP BY attack_type"
    ),
    "attack_summary_by_batch": _alerts(
        'SELECT batch_id, attack_type, count(*) AS "count", max("timestamp") AS last_seen, '
        "avg(prediction) AS avg_confidence FROM scored GROUP BY batch_id, attack_type"
    ),
    "rollup_attack_distribution": _alerts(_top("attacks", "attack_type")),
    "rollup_top_ips": _alerts(_top("attacks", "src_ip", 50)),
    "rollup_attack_hourly": _alerts(f"SELECT {_HOUR} AS hour, attack_type, count(*) AS cnt FROM attacks GROUP BY 1, 2"),
    "rollup_protocol": _alerts(_top("(SELECT * FROM attacks WHERE protocol IS NOT NULL)", "protocol")),
    "rollup_severity_timeline": _alerts(
        f"SELECT {_HOUR} AS hour, severity, count(*) AS cnt FROM attacks WHERE severity IS NOT NULL GROUP BY 1, 2"
    ),
    "top_types_all": _alerts(_top("alerts", "attack_type", 10)),
    "top_ips_all": _alerts(_top("alerts", "src_ip", 10)),
    "top_types": _alerts(_top("attacks", "attack_type", 10)),
    "top_ips": _alerts(_top("attacks", "src_ip", 10)),
    "attack_breakdown": _alerts(
        _top("(SELECT * FROM alerts WHERE attack_type NOT IN ('BENIGN', 'Normal', 'Attack'))", "attack_type", 10)
    ),
    "severity_distribution": _alerts(_top("attacks", "severity")),
    "alert_rate": _alerts(f"SELECT {_MINUTE} AS minute, count(*) AS cnt FROM alerts GROUP BY 1"),
    "alert_count": _alerts("SELECT count(*) AS cnt FROM alerts"),
    "unique_attackers": _alerts("SELECT count(DISTINCT src_ip) AS cnt FROM attacks"),
    "attack_types": _alerts("SELECT DISTINCT attack_type FROM attacks ORDER BY attack_type"),
    "recent_alerts": _alerts(
        'SELECT flow_id, "timestamp", attack_type, src_ip, dst_ip, protocol, severity '
        f"FROM alerts ORDER BY {_NEWEST} LIMIT 25"
    ),
    "attack_timeline": _alerts(_TIMELINE),
    "timeline_pivot": _alerts(
        "SELECT minute, "
        + ", ".join(f"CAST(coalesce(sum(cnt) FILTER (WHERE attack_type = '{t}'), 0) AS BIGINT) AS {n}" for n, t in _TYPES.items())
        + f" FROM ({_TIMELINE}) GROUP BY minute ORDER BY minute DESC LIMIT 60"
    ),
    "hourly_pivot": _alerts(
        f"SELECT {_HOUR} AS hour, "
        + ", ".join(f"nullif(count(*) FILTER (WHERE attack_type = '{_TYPES[n]}'), 0) AS {n}" for n in _HOURLY)
        + " FROM attacks WHERE attack_type IN ('DoS Hulk', 'Infiltration', 'PortScan', 'Brute Force') GROUP BY 1"
    ),
    "rate_by_interval": _alerts(_bucket(600)),
    "rate_by_interval_3h": _alerts(_bucket(10_800)),
    "recent_counts": _alerts(
        'SELECT count(*) FILTER (WHERE "timestamp" >= now - INTERVAL 1 HOUR) AS alerts_last_hour, '
        "count(*) AS alerts_last_24h, "
        "count(*) FILTER (WHERE \"timestamp\" >= now - INTERVAL 1 HOUR AND severity = 'high') AS high_severity "
        f"FROM alerts, clock WHERE {_SINCE_DAY}"
    ),
    "count_by_type": _alerts("SELECT count(*) AS cnt FROM alerts WHERE attack_type = 'DoS Hulk'"),
    "alert_page": _alerts(f"SELECT {_LISTING} FROM alerts ORDER BY {_NEWEST} LIMIT 50 OFFSET 100"),
    "alert_page_after": _alerts(f"SELECT {_LISTING} FROM alerts ORDER BY {_NEWEST} LIMIT 50 OFFSET 100"),
    "page_info": _alerts(
        "SELECT count(*) AS total_elements, (count(*) + 49) // 50 AS total_pages, 2::BIGINT AS number, 50::BIGINT AS size FROM alerts"
    ),
    "alerts_by_type": _alerts(f"SELECT {_LISTING} FROM alerts WHERE attack_type = 'PortScan' ORDER BY {_NEWEST}"),
    "alerts_by_severity": _alerts(f"SELECT {_LISTING} FROM alerts WHERE severity = 'high' ORDER BY {_NEWEST}"),
    "alerts_selected_types": _alerts(
        f"SELECT {_LISTING} FROM alerts WHERE attack_type IN ('Bot', 'DDoS') ORDER BY {_NEWEST}"
    ),
    "risk_level": _report(f"SELECT {_RISK} FROM facts"),
    "type_risk": _alerts(
        "SELECT attack_type, cnt, "
        + _risk_case(((200000, "Critical"), (100000, "High"), (50000, "Medium"), (10000, "Low"))) + f" FROM ({_KINDS})"
    ),
    "type_risk_scaled": _alerts(
        "SELECT attack_type, cnt, "
        + _risk_case(((1000, "Critical"), (500, "High"), (300, "Medium"), (30, "Low"))) + f" FROM ({_KINDS})"
    ),
    "rate_band": _batches(
        "SELECT batch_id, attack_percentage, CASE WHEN attack_percentage >= 30 THEN 'red' "
        "WHEN attack_percentage >= 15 THEN 'amber' ELSE 'green' END AS band FROM stats"
    ),
    "alert_rate_band": _alerts(
        "SELECT minute, cnt, CASE WHEN cnt >= 1000 THEN 'red' WHEN cnt >= 500 THEN 'amber' ELSE 'green' END AS band "
        f"FROM (SELECT {_MINUTE} AS minute, count(*) AS cnt FROM alerts GROUP BY 1)"
    ),
    "recommendations": _report(_RECOMMEND),
    "alert_rate_per_point": _report(
        "SELECT CAST(floor(total_24h / greatest(points, 1) + 0.5) AS BIGINT) AS alert_rate FROM facts"
    ),
    "attack_trend": _report("SELECT CASE WHEN up THEN 'increasing' ELSE 'stable' END AS trend FROM facts"),
    "attack_volatility": _report("SELECT volatility FROM facts"),
    "summary_text": _report(_SUMMARY),
    "narrative": _report(_NARRATIVE),
    "threat_report": _report(
        f"SELECT {_RISK}, round(attack_pct, 6) AS attack_pct, total_24h, attack_total, benign, points, "
        "kinds AS attack_types, top_type, top_count, volatility, "
        "CASE WHEN up THEN 'increasing' ELSE 'stable' END AS trend FROM facts"
    ),
    "attack_composition": _alerts(
        f"SELECT attack_type, cnt, round(cnt / (sum(cnt) OVER ())::DOUBLE * 100, 1) AS percentage FROM ({_KINDS}) "
        "ORDER BY cnt DESC, attack_type LIMIT 8"
    ),
    "ip_threat_score": _alerts(
        "SELECT src_ip, cnt, place, CASE WHEN place <= 3 THEN 'HIGH' WHEN place <= 6 THEN 'MEDIUM' ELSE 'LOW' END AS threat "
        "FROM (SELECT src_ip, count(*) AS cnt, row_number() OVER (ORDER BY count(*) DESC, src_ip NULLS LAST) AS place "
        "FROM attacks GROUP BY src_ip) WHERE place <= 10"
    ),
    "label_distribution": _flows("SELECT true_label, count(*) AS cnt FROM flows GROUP BY true_label"),
    "null_counts": _flows(
        "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _CHECKED) + " FROM flows"
    ),
    "nonnull_counts": _flows("SELECT " + ", ".join(f"count({c}) AS {c}" for c in _CHECKED) + ", count(*) AS total FROM flows"),
    "missing_addresses": _flows(
        "SELECT count(*) FILTER (WHERE src_ip IS NULL OR src_ip = '') AS missing_src_ip, "
        "count(*) FILTER (WHERE dst_ip IS NULL OR dst_ip = '') AS missing_dst_ip FROM flows"
    ),
    "feature_profile": _alerts(
        "SELECT "
        + ", ".join(
            f"min({c}) AS min_{c}, max({c}) AS max_{c}, round(avg({c}), 4) AS avg_{c}"
            for c in ("flow_bytes_per_sec", "syn_flag_count")
        ) + " FROM scored"
    ),
    "class_profile": _alerts(
        "SELECT true_label, "
        + ", ".join(f"round(avg({c}), 3) AS avg_{c}, round(stddev_samp({c}), 3) AS std_{c}" for c in _CLASS_FEATURES)
        + " FROM scored WHERE true_label IS NOT NULL GROUP BY true_label"
    ),
    "dashboard": f"WITH {_DASHBOARD}",
    # Queries that write or stream first; their results equal those of plain queries.
    "csv_scan": _flows(f"SELECT flow_id, {F}, true_label FROM flows"),
    "csv_scan_inferred": _flows(f"SELECT flow_id, {F}, true_label FROM flows"),
    "training_scan": _alerts(f"SELECT {F}, true_label FROM scored WHERE true_label IS NOT NULL"),
    "table_read": "SELECT event_id, ts, user_id, event_type FROM events",
    "stream_source": _flows(f"SELECT {_WIRE_COLUMNS} FROM flows"),
    "raw_bridge": _flows(f"SELECT true AS stamped, {_WIRE_COLUMNS} FROM flows"),
    "fanout": _alerts(
        'SELECT "timestamp", attack_type, src_ip, dst_ip, src_port, dst_port, protocol, severity, prediction, true_label FROM alerts'
    ),
    "fanout_totals": _alerts(
        "SELECT count(*) AS total_packets, count(*) FILTER (WHERE prediction = 0) AS normal_count, "
        "count(*) FILTER (WHERE prediction = 1) AS attack_count FROM alerts"
    ),
    "geo_feed": _geo('SELECT src_ip, attack_type, severity, "timestamp", latitude, longitude, geo_source FROM geo'),
    "stream_alert_page": _alerts(f"SELECT {_LISTING} FROM alerts ORDER BY {_NEWEST} LIMIT 50 OFFSET 100"),
    "stream_recent_alerts": _alerts(
        'SELECT flow_id, "timestamp", attack_type, src_ip, dst_ip, protocol, severity '
        f"FROM alerts ORDER BY {_NEWEST} LIMIT 25"
    ),
    "stream_alerts_by_type": _alerts(f"SELECT {_LISTING} FROM alerts WHERE attack_type = 'PortScan' ORDER BY {_NEWEST}"),
    "stream_geo_recent": _geo(f"SELECT * EXCLUDE (batch_id) FROM geo ORDER BY {_NEWEST} LIMIT 500"),
    "stream_geo_since": _geo(f"SELECT * EXCLUDE (batch_id) FROM geo WHERE {_SINCE_DAY} ORDER BY {_NEWEST}"),
    "stream_geo_points": _geo("SELECT flow_id, longitude AS lon, latitude AS lat, 4326::INTEGER AS srid FROM geo"),
    "refresh_rollups": _alerts(_ROLLUPS),
    "dashboard_stored": _by_stream(f"WITH {_DASHBOARD}"),
    "dashboard_stored_traffic": _by_stream(
        f"SELECT * FROM (WITH {_DASHBOARD}) WHERE section IN ('latest', 'traffic_timeline', 'mean')"
    ),
    "fanout_metrics_totals": _batches(
        "SELECT sum(total_samples)::BIGINT AS total_samples, sum(true_positives)::BIGINT AS true_positives, "
        "sum(true_negatives)::BIGINT AS true_negatives, sum(false_positives)::BIGINT AS false_positives, "
        "sum(false_negatives)::BIGINT AS false_negatives FROM metrics"
    ),
    "fanout_summary_totals": _alerts(
        'SELECT attack_type, count(*) AS count, max("timestamp") AS last_seen FROM alerts GROUP BY attack_type'
    ),
    "refresh_incremental": _alerts(_ROLLUPS),
    "stream_progress": f"WITH {_DAMAGED} SELECT count(*) AS rows, count(*) FILTER (WHERE kind = 'malformed') AS malformed, "
    "count(*) FILTER (WHERE kind = 'malformed' OR src_ip IS NULL) AS missing_src_ip, "
    "count(*) FILTER (WHERE kind <> 'alert') AS rejected, count(*) AS input_rows FROM planted",
    "fanout_rejects": f"WITH {_DAMAGED} SELECT kind, count(*) AS cnt FROM planted GROUP BY kind",
    "alert_page_deep": _alerts(_MIDDLE),
    "stream_alert_page_deep": _alerts(_MIDDLE),
    "attackers_by_range": _alerts(
        "SELECT date_trunc('day', \"timestamp\")::TIMESTAMP AS day, count(DISTINCT src_ip) AS cnt, true AS within_error "
        "FROM attacks GROUP BY 1"
    ),
    "top_ips_stream": _alerts(_top("attacks", "src_ip", 50)),
    "top_ips_stream_verified": _alerts(_top("attacks", "src_ip", 50)),
    "class_quantiles_stored": _alerts(
        "SELECT DISTINCT true_label, name, share::DOUBLE AS share, true AS within_error FROM scored, "
        f"(VALUES {', '.join(f'({c!r})' for c in _CLASS_FEATURES)}) AS c(name), (VALUES (0.25), (0.5), (0.75)) AS q(share) "
        "WHERE true_label IS NOT NULL"
    ),
    "geo_range_nested": _NESTED_SQL,
    "geo_range_nested_shuffled": _NESTED_SQL,
    "geo_range_ipv6": _IPV6_SQL,
    "geo_range_ipv6_shuffled": _IPV6_SQL,
    "recovery_without_checkpoint": _geo(_TABLE_COUNTS),
    "geo_feed_stream": _geo("SELECT * EXCLUDE (batch_id) FROM geo"),
    "idempotent_replay": _geo(_TABLE_COUNTS),
    "recovery": _geo(_TABLE_COUNTS),
    "hot_reload": _flows(
        "SELECT 0::BIGINT AS batch_id, count(*) AS cnt, 0::BIGINT AS scored_by_forest FROM flows "
        "UNION ALL SELECT 1, count(*), count(*) FROM flows"
    ),
    "stream_timeline": _alerts(
        f"SELECT {_MINUTE} AS minute, attack_type, count(*) AS cnt FROM attacks GROUP BY 1, 2"
    ),
    "stream_timeline_late": _alerts(
        f"SELECT {_MINUTE} AS minute, attack_type, count(*) AS cnt FROM attacks GROUP BY 1, 2"
    ),
    "train_gate": "SELECT * FROM (VALUES ('met', NULL), ('missed', 'not enough rows'), ('unlabelled', 'no label column')) AS t(gate, skipped)",
}
ORACLE |= {f"stream_{name}": ORACLE[name] for name in ("geo_map", "geo_bbox")}

# Trainings and streams: what must hold whatever the model or the cut of the batches (eight files, one per batch).
_TRAINED = _flows(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE true_label = 1) AS attacks, "
    "NULL::VARCHAR AS skipped, true AS accurate FROM flows"
)
ORACLE |= {
    "train_forest": _TRAINED,
    "retrain": _TRAINED,
    "train_csv": _TRAINED,
    "score": _flows('SELECT true_label, count(*) AS cnt, true AS "right" FROM flows GROUP BY true_label'),
    "approx_attackers": _alerts("SELECT count(DISTINCT src_ip) AS cnt, true AS within_error FROM attacks"),
    "nonnull_sample": _flows(
        f"SELECT {_ID}, {F} FROM flows WHERE flow_bytes_per_sec IS NOT NULL ORDER BY flow_id LIMIT 5"
    ),
    "pack_features": _flows(
        "SELECT flow_id, (1 + " + " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in FEATURES)
        + f")::BIGINT AS fields, {F}, true_label FROM flows"
    ),
    "training_sink": _by_stream(
        _batches("SELECT count(DISTINCT batch_id) AS batches, 0::BIGINT AS wrong FROM alerts WHERE batch_id % 5 = 0")
    ),
    "progress": _by_stream(_alerts(
        "SELECT stage, count(DISTINCT batch_id) AS batches, count(*) AS batch_rows FROM alerts, (VALUES "
        "('score'), ('alerts'), ('attacks_geo'), ('attack_ips'), ('attack_cube'), ('attack_summary'), ('model_metrics'), "
        "('traffic_stats'), ('alert_minutes'), ('attackers'), ('frequent_ips'), ('profiles'), ('training')) AS s(stage) "
        "WHERE stage <> 'training' OR batch_id % 5 = 0 GROUP BY stage"
    )),
}
ORACLE["class_profile_stored"] = ORACLE["class_profile"]
