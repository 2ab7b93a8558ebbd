"""Rule-based detection, attack classes and the alert projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.operators.parse import packed_features
from netsift.schema import BENIGN

# A flow is an attack when any of these features exceeds its limit.
ATTACK_LIMITS = {
    "flow_bytes_per_sec": 100_000,
    "flow_packets_per_sec": 10_000,
    "syn_flag_count": 100,
    "fin_flag_count": 100,
    "rst_flag_count": 50,
    "total_fwd_packets": 5_000,
    "total_backward_packets": 5_000,
}

# Class rules in order of precedence; the first that holds names the class.
CLASS_RULES = (
    ("DDoS", "flow_bytes_per_sec > 500000 AND flow_packets_per_sec > 50000"),
    ("DoS Hulk", "total_fwd_packets > 5000 AND flow_bytes_per_sec > 200000"),
    ("PortScan", "syn_flag_count > 200 AND flow_duration < 1000"),
    ("Brute Force", "fin_flag_count > 100 OR rst_flag_count > 50"),
    ("Bot", "total_backward_packets > 5000 AND packet_length_mean < 100"),
    ("Web Attack - XSS", "total_fwd_packets > 3000 AND fwd_psh_flags > 50"),
)
OTHER_CLASS = "Infiltration"


def rule_detector(df: DataFrame) -> DataFrame:
    """Add ``prediction``: 1.0 for flows over a limit, 0.0 otherwise."""
    hit = F.col("fwd_iat_mean").isNull() & (F.col("flow_duration") > 0)
    for feature, limit in ATTACK_LIMITS.items():
        hit = hit | (F.col(feature) > limit)
    return df.withColumn("prediction", F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0)))


def attack_type() -> Column:
    """The class of a flow, given its prediction."""
    expr = F.when(F.col("prediction") == 0.0, BENIGN)
    for name, rule in CLASS_RULES:
        expr = expr.when(F.expr(rule), name)
    return expr.otherwise(OTHER_CLASS)


def classify(df: DataFrame) -> DataFrame:
    """Add ``attack_type`` to flows that carry a prediction."""
    return df.withColumn("attack_type", attack_type())


def detect(df: DataFrame) -> DataFrame:
    """Rule detector and classes in one go."""
    return classify(rule_detector(df))


def severity() -> Column:
    """high for prediction 1.0, low for everything else, also for no prediction."""
    return F.when(F.col("prediction") == 1.0, "high").otherwise("low")


def to_alerts(df: DataFrame, *keep: str) -> DataFrame:
    """The alert projection of classified flows, after the columns in ``keep``."""
    return df.select(
        *keep,
        "timestamp", "attack_type", "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
        severity().alias("severity"),
        "prediction", "true_label",
        packed_features().alias("raw_features"),
    )
