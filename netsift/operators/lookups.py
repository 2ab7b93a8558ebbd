"""Small fixed lookup tables, joined as literals."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What each attack class means.
DESCRIPTIONS = {
    "DoS Hulk": "High-volume HTTP flood tool. Targets web servers with randomized requests.",
    "PortScan": "Reconnaissance activity. May precede targeted exploitation.",
    "Brute Force": "Credential stuffing or password guessing against exposed services.",
    "Infiltration": "Multi-stage compromise — initial foothold with lateral movement potential.",
    "Attack": "Generic attack classification — further analysis recommended.",
    "DDoS": "Distributed denial of service — volumetric or protocol attack.",
    "Bot": "Automated botnet traffic — possible C2 communication or scanning.",
    "Web Attack - XSS": "Cross-site scripting attempt — targets web application users.",
}
OTHER_DESCRIPTION = "CICIDS2017 classified threat — monitor for escalation."

# Display names of the severities.
SEVERITY_LABELS = {"high": "HAUTE", "medium": "MOYENNE", "low": "FAIBLE"}


def lookup(key: Column, table: dict[str, str], default: Column) -> Column:
    """Map value of a key, or the default. The map is a literal, so there is nothing to shuffle."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(entries, key), default)


def with_description(df: DataFrame) -> DataFrame:
    """Add ``description`` of the attack type."""
    return df.withColumn("description", lookup(F.col("attack_type"), DESCRIPTIONS, F.lit(OTHER_DESCRIPTION)))


def with_severity_label(df: DataFrame) -> DataFrame:
    """Add ``severity_label``; an unknown severity is shown as it is."""
    return df.withColumn("severity_label", lookup(F.col("severity"), SEVERITY_LABELS, F.col("severity")))
