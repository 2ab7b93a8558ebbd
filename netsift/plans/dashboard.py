"""The dashboard: every figure of the overview page."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.times import minutes_before
from netsift.operators import metrics, rollups, serve

DAY = 1_440


def sections(
    alerts: DataFrame,
    stats: DataFrame,
    summary: DataFrame,
    as_of: Column | datetime,
    distribution: DataFrame | None = None,
    ips: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """One DataFrame per section.

    ``distribution`` and ``ips`` take refreshed rollup tables; without them the
    first follows from the summary and the second is counted from the alerts.
    """
    since = minutes_before(as_of, DAY)
    if distribution is None:
        distribution = rollups.attacks(summary).select("attack_type", F.col("count").alias("cnt"))
    ips = rollups.top_attack_ips(alerts) if ips is None else ips
    return {
        "counts": serve.recent_counts(alerts, as_of),
        "attack_distribution": rollups.ranked(distribution, "attack_type", 10),
        "top_ips": rollups.ranked(ips, "src_ip", 10),
        "latest": metrics.latest_stats(stats),
        "traffic_timeline": metrics.traffic_timeline(stats, since),
        "mean": metrics.avg_attack_pct(stats, since),
        "attack_summaries": summary.orderBy(F.desc("count"), "attack_type"),
    }


def stacked(parts: dict[str, DataFrame]) -> DataFrame:
    """All sections in one table ``section, name, at, value``, one row per figure.

    The timeline has a row per batch, so unlike :func:`nested` this form also
    holds when a day has any number of batches.
    """
    none = F.lit(None)

    def rows(section: str, df: DataFrame, name: Column, value: Column | str, at: Column | str = none) -> DataFrame:
        at = F.col(at) if isinstance(at, str) else at
        value = F.col(value) if isinstance(value, str) else value
        return df.select(
            F.lit(section).alias("section"), name.cast("string").alias("name"),
            at.cast("timestamp_ntz").alias("at"), value.cast("double").alias("value"),
        )

    def unpivoted(section: str, df: DataFrame, columns, at: Column | str = none) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("double").alias("v")) for c in columns]))
        kept = [at] if isinstance(at, str) else []
        return rows(section, df.select(*kept, pairs.alias("p")), F.col("p.n"), F.col("p.v"), at)

    shares = ("total_packets", "normal_percentage", "attack_percentage")
    tables = [
        unpivoted("counts", parts["counts"], ("alerts_last_hour", "alerts_last_24h", "high_severity")),
        rows("attack_distribution", parts["attack_distribution"], F.col("attack_type"), "cnt"),
        rows("top_ips", parts["top_ips"], F.col("src_ip"), "cnt"),
        unpivoted("latest", parts["latest"], shares, "timestamp"),
        rows("traffic_timeline", parts["traffic_timeline"], F.col("batch_id"), "attack_percentage", "timestamp"),
        rows("mean", parts["mean"], F.lit("avg_attack_percentage_24h"), "avg_attack_percentage"),
        rows("attack_summaries", parts["attack_summaries"], F.col("attack_type"), "count", "last_seen"),
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def nested(parts: dict[str, DataFrame]) -> DataFrame:
    """One row with the bounded sections: scalars, and lists of at most ten entries.

    The timeline, whose length depends on the batch rate, stays a table of its own.
    """

    def one(section: str) -> Column:
        df = parts[section]
        return df.select(F.struct("*")).scalar()

    def listed(section: str, key: str, count: str, *more: str) -> Column:
        entry = F.struct((-F.col(count)).alias("rank"), F.col(key), *more)
        return parts[section].agg(F.array_sort(F.collect_list(entry))).scalar()

    def renamed(column: str, **fields: str) -> Column:
        """The list with its entries' fields renamed and the count made positive again."""
        return F.transform(
            column,
            lambda e: F.struct(
                *[(-e[old] if old == "rank" else e[old]).alias(new) for old, new in fields.items()]
            ),
        )

    gathered = parts["counts"].select(
        "alerts_last_hour",
        "alerts_last_24h",
        F.col("high_severity").alias("high_severity_last_hour"),
        listed("attack_distribution", "attack_type", "cnt").alias("attack_distribution"),
        listed("top_ips", "src_ip", "cnt").alias("top_ips"),
        one("latest").alias("latest_stats"),
        parts["mean"].scalar().alias("avg_attack_percentage_24h"),
        listed("attack_summaries", "attack_type", "count", "avg_confidence", "last_seen").alias("attack_summaries"),
    )
    return gathered.withColumns(
        {
            "attack_distribution": renamed("attack_distribution", attack_type="type", rank="count"),
            "top_ips": renamed("top_ips", src_ip="ip", rank="count"),
            "attack_summaries": renamed(
                "attack_summaries", attack_type="attackType", rank="count",
                avg_confidence="avgConfidence", last_seen="lastSeen",
            ),
        }
    )
