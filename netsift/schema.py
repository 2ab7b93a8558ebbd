"""Column names, wire names and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The 39 model features, in vector order.
FEATURES = (
    "flow_duration", "total_fwd_packets", "total_backward_packets",
    "fwd_packet_length_max", "fwd_packet_length_min", "fwd_packet_length_mean",
    "bwd_packet_length_max", "bwd_packet_length_min", "bwd_packet_length_mean",
    "flow_bytes_per_sec", "flow_packets_per_sec",
    "fwd_iat_total", "fwd_iat_mean", "bwd_iat_total", "bwd_iat_mean",
    "fwd_psh_flags", "bwd_psh_flags", "fwd_urg_flags", "bwd_urg_flags",
    "fin_flag_count", "syn_flag_count", "rst_flag_count", "psh_flag_count", "ack_flag_count", "urg_flag_count",
    "packet_length_mean", "packet_length_std", "packet_length_variance",
    "avg_packet_size", "avg_fwd_segment_size", "avg_bwd_segment_size",
    "subflow_fwd_packets", "subflow_fwd_bytes", "subflow_bwd_packets", "subflow_bwd_bytes",
    "init_win_bytes_forward", "init_win_bytes_backward", "active_mean", "idle_mean",
)

# Features whose +Infinity is cleaned together with NULL on the streaming path.
RATE_FEATURES = ("flow_bytes_per_sec", "flow_packets_per_sec")

IDENTITY = ("src_ip", "dst_ip", "src_port", "dst_port", "protocol", "timestamp")
LABEL = "true_label"


def camel_case(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


# JSON field name -> column name; only the label breaks the camelCase rule.
WIRE_TO_COLUMN = {**{camel_case(c): c for c in IDENTITY + FEATURES}, "label": LABEL}
COLUMN_TO_WIRE = {column: wire for wire, column in WIRE_TO_COLUMN.items()}

INT_COLUMNS = ("src_port", "dst_port")
DOUBLE_COLUMNS = FEATURES + (LABEL,)

# Every wire field is read as text first, then cast leniently.
WIRE_SCHEMA = T.StructType([T.StructField(w, T.StringType()) for w in WIRE_TO_COLUMN])

# The same with numbers as numbers, and the text of a record that holds anything else in a number's place.
UNREAD = "_unread"
NUMBER_SCHEMA = T.StructType(
    [T.StructField(w, T.DoubleType() if c in INT_COLUMNS + DOUBLE_COLUMNS else T.StringType()) for w, c in WIRE_TO_COLUMN.items()]
    + [T.StructField(UNREAD, T.StringType())]
)

FEATURE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in FEATURES])
PACKED_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in DOUBLE_COLUMNS])

# Attack classes produced by the cascade, and the names that mean "no attack".
BENIGN = "BENIGN"
BENIGN_NAMES = (BENIGN, "Normal")
GENERIC_NAMES = BENIGN_NAMES + ("Attack",)
ATTACK_TYPES = ("DDoS", "DoS Hulk", "PortScan", "Brute Force", "Bot", "Web Attack - XSS", "Infiltration")
# The four classes that the hourly panel draws as separate series.
HOURLY_SERIES = ("DoS Hulk", "Infiltration", "PortScan", "Brute Force")

# Columns of the paged alert listing.
LISTING = (
    "flow_id", "timestamp", "attack_type", "src_ip", "dst_ip",
    "src_port", "dst_port", "protocol", "severity", "prediction",
)
