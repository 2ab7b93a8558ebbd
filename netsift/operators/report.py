"""Rule-based threat report.

:func:`report_facts` reduces the tables to one row of bounded size; everything
else is a projection of that row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.config import DEFAULTS, ReportSettings
from netsift.functions.numbers import band, ratio
from netsift.functions.times import minutes_before
from netsift.operators.rollups import ranked, top_attack_ips
from netsift.schema import BENIGN, BENIGN_NAMES
from netsift.sinks.tables import since as since_moment

DAY = 1_440
TREND_POINTS = 5
SPREAD_POINTS = 10

# Report texts.
TEXTS = {
    "dominant": "%s attacks exceed 100K events — deploy dedicated rate-limiting and WAF rules.",
    "share": "Attack ratio at %s%% — consider network segmentation and zero-trust policies.",
    "trend": "Attack percentage trending upward in last 5 batches — immediate threat hunting recommended.",
    "volatility": "Traffic volatility at %s%% — suggests scanning or DDoS behavior pattern.",
    "benign": "High benign-to-attack ratio — fine-tune detection thresholds to reduce false positives.",
    "summary": (
        "Over the last 24 hours, the IDS processed **%s** events with an average attack ratio of **%s%%**. "
        "%s distinct CICIDS2017 attack types were detected, with **%s** being the most prevalent (%s events). "
        "The top source IPs are %s."
    ),
}
# Own wording of the trend and the pattern.
TEXTS |= {
    "rising": "Attacks take a growing part of the traffic, seen over %s points; the index of volatility stands at %s%%.",
    "steady": "Attacks keep their part of the traffic, and at a volatility of %s%% hardly move.",
    "varying": "Attacks keep their part of the traffic, but at a volatility of %s%% they come and go.",
    "burst": "About %s%% of the flows are attacks, and they arrive in waves.",
    "sustained": "About %s%% of the flows are attacks, and they arrive evenly.",
}


def report_facts(alerts: DataFrame, stats: DataFrame, as_of: Column | datetime) -> DataFrame:
    """One row: class counts, top addresses, and the last points of the attack-percentage series.

    The lists are for display and hold at most ten classes, addresses and
    points; totals and the number of classes cover all of them.
    """
    since = minutes_before(as_of, DAY)
    classes = alerts.groupBy("attack_type").agg(
        F.count("*").alias("cnt"), F.count_if(F.col("timestamp") >= since).alias("recent")
    )
    attack = ~F.col("attack_type").isin(*BENIGN_NAMES)
    top_types = ranked(classes.filter(attack).select("attack_type", "cnt"), "attack_type", 10)
    recent = since_moment(stats, since)
    last_points = (
        recent.select("timestamp", "batch_id", "attack_percentage")
        .orderBy(F.desc("timestamp"), F.desc("batch_id"))
        .limit(SPREAD_POINTS)
    )

    def listed(df: DataFrame, *fields: Column | str) -> Column:
        return df.agg(F.array_sort(F.collect_list(F.struct(*fields)))).scalar()

    attacked = F.when(attack, F.col("cnt"))
    totals = classes.agg(
        F.coalesce(F.sum("recent"), F.lit(0)).alias("total_24h"),
        F.coalesce(F.sum(F.when(F.col("attack_type") == BENIGN, F.col("cnt"))), F.lit(0)).alias("benign"),
        F.coalesce(F.sum(attacked), F.lit(0)).alias("attack_total"),
        F.count(attacked).alias("attack_types"),
    )
    rank = (-F.col("cnt")).alias("rank")
    ips = top_attack_ips(alerts, 10)
    return (
        recent.agg(F.count("*").alias("points"), F.coalesce(F.avg("attack_percentage"), F.lit(0.0)).alias("attack_pct"))
        .withColumns(
            {
                "types": listed(top_types, rank, "attack_type"),
                "ips": listed(ips, rank, "src_ip"),
                "series": listed(last_points, "timestamp", "batch_id", "attack_percentage"),
            }
        )
        .withColumn("_totals", totals.select(F.struct("*")).scalar())
        .select("*", "_totals.*")
        .drop("_totals")
        .transform(_derive)
    )


def _derive(facts: DataFrame) -> DataFrame:
    values = F.transform("series", lambda p: p["attack_percentage"])
    last = F.slice(values, F.greatest(F.size(values) - TREND_POINTS + 1, F.lit(1)), TREND_POINTS)

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda a, v: a + v)

    with_values = facts.withColumns({"_values": values, "_last": last}).withColumn(
        "_mean", total(F.col("_last")) / TREND_POINTS
    )
    squares = F.transform("_values", lambda v: F.pow(v - F.col("_mean"), F.lit(2.0)))
    spread = F.floor(F.sqrt(total(squares) / SPREAD_POINTS) * 100 + 0.5) / 100
    return with_values.withColumns(
        {
            "trend_up": (F.size("_last") > 1) & (F.get("_last", F.size("_last") - 1) > F.get("_last", F.lit(0))),
            "volatility": F.when(F.col("points") > TREND_POINTS, spread).otherwise(0.0),
            "top_type": F.get("types", F.lit(0))["attack_type"],
            "top_count": F.coalesce(-F.get("types", F.lit(0))["rank"], F.lit(0)),
        }
    ).drop("_values", "_last", "_mean")


def risk_level(value: Column, report: ReportSettings = DEFAULTS.report) -> Column:
    return band(value, report.risk_levels, "Low")


def type_risk(count: Column, thresholds=DEFAULTS.report.type_risk) -> Column:
    return band(count, thresholds, "Info")


def rate_band(value: Column, bands: tuple) -> Column:
    """green/amber/red; a band starts at its threshold."""
    amber, red = bands
    return F.when(value >= red, "red").when(value >= amber, "amber").otherwise("green")


def _one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", F.round(value, 1))


def recommendations(facts: DataFrame, report: ReportSettings = DEFAULTS.report) -> DataFrame:
    """The recommendations that apply, in fixed order: ``ord, priority, text``."""
    pct, volatility = F.col("attack_pct"), F.col("volatility")
    rules = [
        (F.col("top_count") > report.dominant_type, "high", F.format_string(TEXTS["dominant"], "top_type")),
        (pct > report.attack_share, "high", F.format_string(TEXTS["share"], _one_decimal(pct))),
        (F.col("trend_up"), "medium", F.lit(TEXTS["trend"])),
        (volatility > report.volatility, "medium", F.format_string(TEXTS["volatility"], volatility)),
        (
            (F.col("benign") > 0) & (F.col("benign") > F.col("attack_total") * report.benign_ratio),
            "low",
            F.lit(TEXTS["benign"]),
        ),
    ]
    found = [
        F.when(rule, F.struct(F.lit(i).alias("ord"), F.lit(priority).alias("priority"), text.alias("text")))
        for i, (rule, priority, text) in enumerate(rules, 1)
    ]
    return facts.select(F.explode(F.array_compact(F.array(*found))).alias("r")).select("r.*")


def alert_rate_per_point(facts: DataFrame) -> DataFrame:
    """Alerts of the last day per statistics row, rounded half up."""
    rate = F.floor(F.col("total_24h") / F.greatest("points", F.lit(1)) + 0.5).cast("bigint")
    return facts.select(rate.alias("alert_rate"))


def _trend() -> Column:
    return F.when(F.col("trend_up"), "increasing").otherwise("stable").alias("trend")


def attack_trend(facts: DataFrame) -> DataFrame:
    return facts.select(_trend())


def attack_volatility(facts: DataFrame) -> DataFrame:
    return facts.select("volatility")


def summary_text(facts: DataFrame) -> DataFrame:
    """The summary sentence."""
    first_three = F.transform(
        F.slice("ips", 1, 3), lambda p: F.format_string("%s (%s packets)", p["src_ip"], -p["rank"])
    )
    text = F.format_string(
        TEXTS["summary"],
        F.format_number("total_24h", 0),
        _one_decimal(F.col("attack_pct")),
        F.col("attack_types").cast("int"),
        F.coalesce("top_type", F.lit("unknown")),
        F.format_number("top_count", 0),
        F.array_join(first_three, ", "),
    )
    return facts.select(text.alias("summary"))


def narrative(facts: DataFrame) -> DataFrame:
    """Trend and volatility in words."""
    volatility, points = F.col("volatility"), F.least("points", F.lit(TREND_POINTS))
    whole_pct = F.format_string("%.0f", F.round("attack_pct", 0))
    trend = (
        F.when(F.col("trend_up"), F.format_string(TEXTS["rising"], points, volatility))
        .when(volatility < 3, F.format_string(TEXTS["steady"], volatility))
        .otherwise(F.format_string(TEXTS["varying"], volatility))
    )
    pattern = F.when(volatility > 5, F.format_string(TEXTS["burst"], whole_pct)).otherwise(
        F.format_string(TEXTS["sustained"], whole_pct)
    )
    return facts.select(trend.alias("trend_text"), pattern.alias("pattern_text"))


def attack_composition(distribution: DataFrame, top: int = 8) -> DataFrame:
    """The largest classes with their share of all attacks, in percent with one decimal."""
    whole = distribution.agg(F.sum("cnt")).scalar()
    return ranked(distribution, "attack_type", top).select(
        "attack_type", "cnt", F.round(ratio(F.col("cnt"), whole) * 100, 1).alias("percentage")
    )


def ip_threat_score(counts: DataFrame) -> DataFrame:
    """Ranks 1 to 10 of the addresses by count: 1-3 HIGH, 4-6 MEDIUM, the others LOW."""
    ten = ranked(counts, "src_ip", 10)
    # At most ten rows reach this window, so its single partition is harmless.
    place = F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc_nulls_last("src_ip")))
    return ten.withColumn("place", place.cast("bigint")).withColumn(
        "threat", F.when(F.col("place") <= 3, "HIGH").when(F.col("place") <= 6, "MEDIUM").otherwise("LOW")
    )


def threat_report(facts: DataFrame, report: ReportSettings = DEFAULTS.report) -> DataFrame:
    """The scalar part of the report as one row."""
    return facts.select(
        risk_level(F.col("attack_pct"), report).alias("risk_level"),
        "attack_pct", "total_24h", "attack_total", "benign", "points",
        "attack_types", "top_type", "top_count", "volatility",
        _trend(),
    )
