"""Named queries over the given tables: ``name -> f(spark, folder) -> DataFrame``.

``as_of`` is the newest event time of the table, so results do not depend on the
wall clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.config import DEFAULTS
from netsift.operators import clean, detect, geo, lookups, metrics, pages, parse, quality, report, rollups, serve
from netsift.plans import dashboard, flows as base, tables
from netsift.plans.tables import model_metrics, stats
from netsift.schema import COLUMN_TO_WIRE, DOUBLE_COLUMNS, FEATURES, LABEL
from netsift.functions.times import minutes_before
from netsift.sources.audit import parquet_audit
from netsift.sources.streams import payload_text
from netsift.sources.tables import normalize_columns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIMELINE_MINUTES = 1_440
DAY = 1_440
PAGE, PAGE_SIZE = 2, 50
# Report thresholds in proportion to the small check tables.
SCALED_TYPE_RISK = ((1_000, "Critical"), (500, "High"), (300, "Medium"), (30, "Low"))
FEATURE_ROWS = ("flow_id", *FEATURES)


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_")] = function
    return function


def register(name: str, function: Query) -> None:
    QUERIES[name] = function


def as_of(spark: SparkSession, folder: str) -> Column:
    return serve.latest_moment(tables.alerts(spark, folder))


def day_ago(spark: SparkSession, folder: str) -> Column:
    return minutes_before(as_of(spark, folder), DAY)


def geo_rows(spark: SparkSession, folder: str) -> DataFrame:
    return geo.attacks_geo(tables.alerts(spark, folder), "flow_id", "batch_id")


def facts(spark: SparkSession, folder: str) -> DataFrame:
    return report.report_facts(tables.alerts(spark, folder), stats(spark, folder), as_of(spark, folder))


def on(table: Query, function: Callable[..., DataFrame], *args, **options) -> Query:
    """A query that applies ``function`` to one table."""
    return lambda spark, folder: function(table(spark, folder), *args, **options)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round means and deviations, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Sources and wire format

@query
def raw_value_cast(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    return payload_text(events.select(F.encode("props", "UTF-8").alias("value")))


@query
def parquet_audit_(spark, folder):
    found = parquet_audit(spark, folder)
    return found.withColumn("file", F.element_at(F.split("file", "/"), -1))


def encoded(spark, folder):
    return parse.encode_flows(tables.flow_table(spark, folder), "flow_id")


register("encode_flow_json", encoded)


@query
def parse_flows(spark, folder):
    """Stored wire records back to columns."""
    records = spark.read.parquet(tables.topic(spark, folder))
    return parse.parse_flows(records.select(F.col("offset").alias("flow_id"), F.col("value").alias("raw_value")), "flow_id")


@query
def rename_fields(spark, folder):
    flows = tables.flow_table(spark, folder)
    wire = flows.select("flow_id", *[F.col(c).alias(w) for c, w in COLUMN_TO_WIRE.items()])
    return parse.rename_fields(wire)


@query
def normalize_columns_(spark, folder):
    """All features under column titles as found in training files."""
    odd = {
        "flow_id": "Flow ID", "flow_bytes_per_sec": " Flow Bytes/s", "flow_packets_per_sec": " Flow Packets/s",
        "avg_packet_size": "Average Packet Size\r", "init_win_bytes_forward": "Init_Win_bytes_forward",
    }
    titles = {c: odd.get(c, " " + c.replace("_", " ").title()) for c in ("flow_id", *FEATURES, LABEL)}
    flows = tables.flow_table(spark, folder).select(*titles)
    return normalize_columns(flows.toDF(*titles.values()))


@query
def pack_features(spark, folder):
    """The packed text: how many of its fields are set, and each as JSON paths read it."""
    packed = tables.flow_table(spark, folder).select("flow_id", parse.packed_features().alias("raw_features"))
    names = F.size(F.json_object_keys("raw_features")).cast("bigint").alias("fields")
    fields = packed.select("flow_id", names, F.json_tuple("raw_features", *DOUBLE_COLUMNS).alias(*DOUBLE_COLUMNS))
    return fields.withColumns({c: F.col(c).cast("double") for c in DOUBLE_COLUMNS})


@query
def unpack_features(spark, folder):
    packed = tables.flow_table(spark, folder).select("flow_id", parse.packed_features().alias("raw_features"))
    return parse.unpack_features(packed, "flow_id")


# Cleaning

@query
def add_missing_features(spark, folder):
    flows = tables.flow_table(spark, folder).select(*FEATURE_ROWS).drop("active_mean", "idle_mean", "flow_duration")
    return clean.add_missing_features(flows).select(*FEATURE_ROWS)


for _name in ("fill_nulls", "fill_rates", "clean_stream", "clean_nonfinite", "clean_all", "drop_incomplete"):
    register(
        _name,
        lambda spark, folder, f=getattr(clean, _name): f(tables.flow_table(spark, folder).select(*FEATURE_ROWS)),
    )


@query
def label_text(spark, folder):
    return clean.label_text(tables.flow_table(spark, folder).select("flow_id", LABEL))


@query
def training_rows(spark, folder):
    return clean.training_rows(tables.scored(spark, folder), "flow_id")


# Detection

@query
def rule_detector(spark, folder):
    return detect.rule_detector(tables.flow_table(spark, folder)).select("flow_id", "prediction")


@query
def attack_type(spark, folder):
    return tables.scored(spark, folder).select("flow_id", "prediction", "attack_type")


@query
def alerts(spark, folder):
    return base.alerts(spark, folder).drop("raw_features")


@query
def severity(spark, folder):
    return base.alerts(spark, folder).select("flow_id", "severity")


@query
def severity_label(spark, folder):
    return lookups.with_severity_label(base.alerts(spark, folder).select("flow_id", "severity"))


@query
def attack_descriptions(spark, folder):
    return lookups.with_description(rollups.attack_distribution(tables.alerts(spark, folder)))


@query
def alert_page_deep(spark, folder):
    """The page in the middle of the listing, out of the minutes that it lies in."""
    directory = tables.minutes(spark, folder)
    rows = directory.agg(F.sum("cnt")).first()[0]
    return pages.alert_page_deep(tables.alerts(spark, folder), directory, rows // PAGE_SIZE // 2, PAGE_SIZE)


# Locations

@query
def geo_hash(spark, folder):
    return geo.geo_hash(tables.alerts(spark, folder).select("flow_id", "src_ip"))


@query
def geo_range_join(spark, folder):
    return geo.geo_range_join(
        tables.alerts(spark, folder).select("flow_id", "src_ip"), base.geo_ranges(spark, folder)
    )


def _nested(spark, folder, **options):
    rows = tables.alerts(spark, folder).select("flow_id", "src_ip")
    return geo.geo_range_join(rows, base.nested_ranges(spark, folder), **options)


@query
def geo_range_nested(spark, folder):
    """Locations out of nested and crossing ranges: the innermost counts."""
    return _nested(spark, folder)


@query
def geo_range_nested_shuffled(spark, folder):
    """The same as it runs when the ranges are too many to broadcast."""
    return _nested(spark, folder, small=False)


@query
def geo_range_ipv6(spark, folder):
    """Locations of IPv6 addresses out of nested ranges."""
    return geo.geo_range_join(base.ipv6_addresses(spark, folder), base.ipv6_ranges(spark, folder))


@query
def geo_range_ipv6_shuffled(spark, folder):
    return geo.geo_range_join(base.ipv6_addresses(spark, folder), base.ipv6_ranges(spark, folder), small=False)


@query
def geo_range_join_shuffled(spark, folder):
    """The same join as it runs when the ranges are too many to broadcast."""
    return geo.geo_range_join(
        tables.alerts(spark, folder).select("flow_id", "src_ip"), base.geo_ranges(spark, folder), small=False
    )


@query
def geo_defaults(spark, folder):
    columns = ("flow_id", "src_ip", "attack_type", "severity", "timestamp")
    return geo.geo_defaults(tables.alerts(spark, folder)).select(*columns)


@query
def geo_point(spark, folder):
    return geo.geo_point(geo_rows(spark, folder)).select("flow_id", "geom.lon", "geom.lat", "geom.srid")


register("attacks_geo", geo_rows)
register("geo_map", on(geo_rows, geo.geo_map))
register("geo_bbox", on(geo_rows, geo.geo_bbox))
register("geo_recent", on(geo_rows, serve.geo_recent))


@query
def geo_since(spark, folder):
    return serve.geo_since(geo_rows(spark, folder), day_ago(spark, folder))


@query
def geo_count_by_type(spark, folder):
    return serve.count_by_type(geo_rows(spark, folder), "PortScan")


# Metrics

@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(tables.alerts(spark, folder), "batch_id")


register("model_metrics", model_metrics)
register("metrics_timeline", on(model_metrics, metrics.metrics_timeline))
register("metrics_percent", on(model_metrics, metrics.metrics_percent))
register("retrain_annotations", on(model_metrics, metrics.retrain_annotations, 0.999))
register("traffic_stats", stats)
register("traffic_totals", on(stats, metrics.traffic_totals))
register("hourly_volume", on(stats, metrics.hourly_volume))
register("latest_stats", on(stats, metrics.latest_stats))
register("traffic_timeline_all", on(stats, metrics.traffic_timeline))
register("attack_summary", on(tables.alerts, metrics.attack_summary))
register("attack_summary_by_batch", on(tables.alerts, metrics.attack_summary, "batch_id"))


@query
def traffic_means(spark, folder):
    means = metrics.traffic_means(stats(spark, folder))
    return rounded(means, 6, *means.columns)


@query
def avg_attack_pct(spark, folder):
    mean = metrics.avg_attack_pct(stats(spark, folder), day_ago(spark, folder))
    return rounded(mean, 6, "avg_attack_percentage")


@query
def traffic_timeline(spark, folder):
    return metrics.traffic_timeline(stats(spark, folder), day_ago(spark, folder))


@query
def series_reduce(spark, folder):
    reduced = metrics.series_reduce(stats(spark, folder), "attack_percentage")
    return rounded(reduced, 6, "sum", "mean")


# Rollups and counts

for _name, _function in {
    "rollup_attack_distribution": rollups.attack_distribution,
    "rollup_top_ips": rollups.top_attack_ips,
    "rollup_attack_hourly": rollups.attack_hourly,
    "rollup_protocol": rollups.protocol_stats,
    "rollup_severity_timeline": rollups.severity_timeline,
    "top_types_all": rollups.top_types_all,
    "top_ips_all": rollups.top_ips_all,
    "attack_breakdown": rollups.attack_breakdown,
    "severity_distribution": rollups.severity_distribution,
    "alert_rate": rollups.alert_rate,
    "alert_count": serve.alert_count,
    "unique_attackers": serve.unique_attackers,
    "attack_types": serve.attack_types,
    "recent_alerts": serve.recent_alerts,
}.items():
    register(_name, on(tables.alerts, _function))


@query
def top_types(spark, folder):
    return rollups.ranked(rollups.attack_distribution(tables.alerts(spark, folder)), "attack_type", 10)


@query
def top_ips(spark, folder):
    return rollups.ranked(rollups.top_attack_ips(tables.alerts(spark, folder)), "src_ip", 10)


@query
def attack_timeline(spark, folder):
    return rollups.attack_timeline(tables.alerts(spark, folder), as_of(spark, folder), TIMELINE_MINUTES)


@query
def timeline_pivot(spark, folder):
    return rollups.timeline_pivot(attack_timeline(spark, folder))


@query
def hourly_pivot(spark, folder):
    return rollups.hourly_pivot(rollups.attack_hourly(tables.alerts(spark, folder)))


register("rate_by_interval", on(tables.alerts, rollups.rate_by_interval, 600))
register("rate_by_interval_3h", on(tables.alerts, rollups.rate_by_interval, 10_800))


@query
def approx_attackers(spark, folder):
    """The exact number, and whether the approximate one lies within three standard errors of it."""
    rows = tables.alerts(spark, folder)
    about = serve.approx_attackers(rows).scalar()
    off = F.abs(about - F.col("cnt")) <= 3 * 0.02 * F.col("cnt")
    return serve.unique_attackers(rows).withColumn("within_error", off)


@query
def recent_counts(spark, folder):
    return serve.recent_counts(tables.alerts(spark, folder), as_of(spark, folder))


register("count_by_type", on(tables.alerts, serve.count_by_type, "DoS Hulk"))

# Listings

register("alert_page", on(tables.alerts, serve.alert_page, PAGE, PAGE_SIZE))
register("page_info", on(tables.alerts, serve.page_info, PAGE, PAGE_SIZE))
register("alerts_by_type", on(tables.alerts, serve.alerts_where, "attack_type", "PortScan"))
register("alerts_by_severity", on(tables.alerts, serve.alerts_where, "severity", "high"))
register("alerts_selected_types", on(tables.alerts, serve.alerts_selected_types, ("Bot", "DDoS")))


@query
def alert_page_after(spark, folder):
    """The page after the last row of page 1, found by key instead of by offset."""
    rows = tables.alerts(spark, folder)
    last = serve.alert_page(rows, PAGE - 1, PAGE_SIZE).orderBy("timestamp", "flow_id").first()
    return serve.alert_page_after(rows, last["timestamp"], last["flow_id"], PAGE_SIZE)


# Report

@query
def risk_level(spark, folder):
    return facts(spark, folder).select(report.risk_level(F.col("attack_pct")).alias("risk_level"))


@query
def type_risk(spark, folder):
    counts = rollups.attack_distribution(tables.alerts(spark, folder))
    return counts.select("attack_type", "cnt", report.type_risk(F.col("cnt")).alias("risk"))


@query
def type_risk_scaled(spark, folder):
    counts = rollups.attack_distribution(tables.alerts(spark, folder))
    return counts.select("attack_type", "cnt", report.type_risk(F.col("cnt"), SCALED_TYPE_RISK).alias("risk"))


@query
def rate_band(spark, folder):
    bands = DEFAULTS.report.attack_bands
    return stats(spark, folder).select(
        "batch_id", "attack_percentage", report.rate_band(F.col("attack_percentage"), bands).alias("band")
    )


@query
def alert_rate_band(spark, folder):
    bands = DEFAULTS.report.alert_bands
    rate = rollups.alert_rate(tables.alerts(spark, folder))
    return rate.select("minute", "cnt", report.rate_band(F.col("cnt"), bands).alias("band"))


register("recommendations", on(facts, report.recommendations))
register("alert_rate_per_point", on(facts, report.alert_rate_per_point))
register("attack_trend", on(facts, report.attack_trend))
register("attack_volatility", on(facts, report.attack_volatility))
register("summary_text", on(facts, report.summary_text))
register("narrative", on(facts, report.narrative))


@query
def threat_report(spark, folder):
    return rounded(report.threat_report(facts(spark, folder)), 6, "attack_pct")


@query
def attack_composition(spark, folder):
    return report.attack_composition(rollups.attack_distribution(tables.alerts(spark, folder)))


@query
def ip_threat_score(spark, folder):
    return report.ip_threat_score(rollups.top_attack_ips(tables.alerts(spark, folder)))


# Data quality

register("label_distribution", on(tables.flow_table, quality.label_distribution))
register("null_counts", on(tables.flow_table, quality.null_counts))
register("nonnull_counts", on(tables.flow_table, quality.nonnull_counts))
register("missing_addresses", on(tables.flow_table, quality.missing_addresses))
register("nonnull_sample", on(tables.flow_table, quality.nonnull_sample))


@query
def feature_profile(spark, folder):
    profile = quality.feature_profile(tables.scored(spark, folder))
    return rounded(profile, 4, *[c for c in profile.columns if c.startswith("avg_")])


@query
def class_profile(spark, folder):
    profile = quality.class_profile(tables.scored(spark, folder))
    return rounded(profile, 3, *[c for c in profile.columns if c != LABEL])


# Dashboard

@query
def dashboard_(spark, folder):
    sections = dashboard.sections(
        tables.alerts(spark, folder), stats(spark, folder), metrics.attack_summary(tables.alerts(spark, folder)),
        as_of(spark, folder),
    )
    return rounded(dashboard.stacked(sections), 6, "value")


@query
def dashboard_object(spark, folder):
    return dashboard.nested(
        dashboard.sections(
            tables.alerts(spark, folder), stats(spark, folder), metrics.attack_summary(tables.alerts(spark, folder)),
            as_of(spark, folder),
        )
    )
