"""Per-batch quality metrics and traffic statistics.

Everything that describes one batch comes out of a single aggregation, so a
micro-batch is read once for its metrics, its statistics and its row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.numbers import percent_1, ratio
from netsift.functions.times import trunc
from netsift.schema import LABEL
from netsift.sinks.tables import since as since_moment

METRICS = (
    "batch_id", "timestamp", "total_samples", "true_positives", "true_negatives", "false_positives",
    "false_negatives", "accuracy", "precision", "recall", "f1_score",
)
STATS = (
    "batch_id", "timestamp", "total_packets", "normal_count", "attack_count",
    "normal_percentage", "attack_percentage",
)


def _cell(prediction: float, label: float) -> Column:
    return F.count_if((F.col("prediction") == prediction) & (F.col(LABEL) == label))


def batch_counts(scored: DataFrame, *keys: str) -> DataFrame:
    """Row, class and confusion counts per ``keys`` (one row without keys)."""
    return scored.groupBy(*keys).agg(
        F.max("timestamp").alias("timestamp"),
        F.count("*").alias("total_samples"),
        _cell(1.0, 1.0).alias("true_positives"),
        _cell(0.0, 0.0).alias("true_negatives"),
        _cell(1.0, 0.0).alias("false_positives"),
        _cell(0.0, 1.0).alias("false_negatives"),
        F.count_if(F.col("prediction") == 0.0).alias("normal_count"),
        F.count_if(F.col("prediction") == 1.0).alias("attack_count"),
    )


def confusion_matrix(scored: DataFrame, *keys: str) -> DataFrame:
    """Confusion counts per ``keys``; unlabelled rows count only in ``total_samples``."""
    return batch_counts(scored, *keys).select(
        *keys, "total_samples", "true_positives", "true_negatives", "false_positives", "false_negatives"
    )


def with_scores(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts, 0.0 where undefined."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return counts.withColumns(
        {
            "accuracy": ratio(tp + F.col("true_negatives"), F.col("total_samples")),
            "precision": precision,
            "recall": recall,
            "f1_score": ratio(F.lit(2.0) * precision * recall, precision + recall),
        }
    )


def with_shares(counts: DataFrame) -> DataFrame:
    """Traffic statistics from batch counts."""
    total = F.col("total_samples")
    return counts.withColumns(
        {
            "total_packets": total,
            "normal_percentage": ratio(F.col("normal_count"), total) * 100,
            "attack_percentage": ratio(F.col("attack_count"), total) * 100,
        }
    )


def model_metrics(scored: DataFrame) -> DataFrame:
    """One metrics row per ``batch_id``."""
    return with_scores(batch_counts(scored, "batch_id")).select(*METRICS)


def traffic_stats(scored: DataFrame) -> DataFrame:
    """One statistics row per ``batch_id``."""
    return with_shares(batch_counts(scored, "batch_id")).select(*STATS)


def attack_summary(scored: DataFrame, *keys: str, probability: bool = False) -> DataFrame:
    """Per attack type: rows, last sighting and mean prediction, and on request the mean forest probability."""
    extra = [F.avg("attack_probability").alias("avg_probability")] if probability else []
    return scored.groupBy(*keys, "attack_type").agg(
        F.count("*").alias("count"),
        F.max("timestamp").alias("last_seen"),
        F.avg("prediction").alias("avg_confidence"),
        *extra,
    )


def metrics_percent(metrics: DataFrame) -> DataFrame:
    """The four scores as percentages with one decimal, oldest first."""
    scores = [percent_1(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1_score")]
    return metrics.orderBy("timestamp", "batch_id").select("batch_id", "timestamp", *scores)


def retrain_annotations(metrics: DataFrame, above: float = 0.95) -> DataFrame:
    """Chart annotations for the batches scored better than ``above``, oldest first."""
    return (
        metrics.filter(F.col("accuracy") > above)
        .orderBy("timestamp", "batch_id")
        .select("timestamp", F.concat(F.lit("Training batch: "), F.col("batch_id")).alias("text"))
    )


def traffic_totals(stats: DataFrame) -> DataFrame:
    """Grand totals over all batches, 0 when there are none."""
    columns = ("total_packets", "normal_count", "attack_count")
    return stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def traffic_means(stats: DataFrame) -> DataFrame:
    """Means of the batch percentages, each batch counting the same, and the mean weighted by batch size."""

    def mean(column: str) -> Column:
        return F.coalesce(F.avg(column), F.lit(0.0)).alias(column)

    weighted = ratio(F.sum("attack_count"), F.sum("total_packets")) * 100
    return stats.agg(
        mean("normal_percentage"), mean("attack_percentage"), weighted.alias("weighted_attack_percentage")
    )


def avg_attack_pct(stats: DataFrame, since: Column) -> DataFrame:
    """Mean attack percentage of the batches since a moment, 0.0 when there are none."""
    return since_moment(stats, since).agg(
        F.coalesce(F.avg("attack_percentage"), F.lit(0.0)).alias("avg_attack_percentage")
    )


def hourly_volume(stats: DataFrame) -> DataFrame:
    """Mean, largest and smallest batch per hour."""
    return (
        stats.groupBy(trunc("hour", F.col("timestamp")).alias("hour"))
        .agg(
            F.avg("total_packets").alias("avg_packets"),
            F.max("total_packets").alias("max_packets"),
            F.min("total_packets").alias("min_packets"),
        )
        .orderBy("hour")
    )


def series_reduce(stats: DataFrame, column: str) -> DataFrame:
    """Legend values of one series: sum, max, mean, last (newest non-NULL) and min."""
    value = F.col(column)
    return stats.filter(value.isNotNull()).agg(
        F.sum(value).alias("sum"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.max_by(value, F.struct("timestamp", "batch_id")).alias("last"),
        F.min(value).alias("min"),
    )


def latest_stats(stats: DataFrame) -> DataFrame:
    """The newest statistics row."""
    return stats.orderBy(F.desc("timestamp"), F.desc("batch_id")).limit(1)


def traffic_timeline(stats: DataFrame, since: Column | None = None) -> DataFrame:
    """Statistics rows, oldest first, from a moment on or in full."""
    rows = stats if since is None else since_moment(stats, since)
    return rows.orderBy("timestamp", "batch_id")


def metrics_timeline(metrics: DataFrame) -> DataFrame:
    """Metrics rows, oldest first."""
    return metrics.orderBy("timestamp", "batch_id")
