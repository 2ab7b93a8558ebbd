"""Summaries of a batch that can be merged: distinct counts, frequent addresses, moments and quantiles.

Each is small whatever the batch, is stored per batch, and answers for any set of
batches without reading the alerts again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.functions.times import trunc
from netsift.operators.quality import CLASS_PROFILED
from netsift.operators.rollups import TOP_IPS, attack_ips, attacks, ranked, top_attack_ips
from netsift.schema import LABEL

#: Size of the distinct-count sketches (2**12 registers) and the relative error that they keep, three standard errors.
DISTINCT_BITS, DISTINCT_ERROR = 12, 0.05
#: Addresses that a batch keeps, out of which the most frequent ones are found.
FREQUENT = 1_000
#: Batches that a query names one by one; more are joined.
NAMED = 1_000
#: Size of the quantile sketches and their error in rank.
QUANTILE_K, QUANTILE_ERROR = 400, 0.01


# Distinct attackers

def attackers_by_hour(alerts: DataFrame, *keys: str) -> DataFrame:
    """A sketch of the attacking addresses of each hour."""
    hour = trunc("hour", F.col("timestamp")).alias("hour")
    return attacks(alerts).groupBy(*keys, hour).agg(F.hll_sketch_agg("src_ip", DISTINCT_BITS).alias("sketch"))


def distinct_attackers(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """Estimated number of different attackers over all sketches of each key."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("cnt"))


def attackers_in_range(sketches: DataFrame, start: Column, end: Column) -> DataFrame:
    """Estimated number of different attackers from one full hour up to another."""
    return distinct_attackers(sketches.filter((F.col("hour") >= start) & (F.col("hour") < end)))


# Frequent addresses

def frequent_ips(alerts: DataFrame, *keys: str, keep: int = FREQUENT) -> DataFrame:
    """The ``keep`` most frequent attackers of each batch (``keys``) with their counts: src_ip, cnt, kept.

    One further row that is not ``kept`` has the largest count that was left out;
    it is missing where nothing was.
    """
    order = (F.desc("cnt"), F.asc_nulls_last("src_ip"))
    counts = attack_ips(alerts, *keys)
    if not keys:
        # The best rows of each task first, so that no task orders all addresses.
        counts = counts.orderBy(*order).limit(keep + 1)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    some = counts.withColumn("_place", place).filter(F.col("_place") <= keep + 1)
    kept = F.col("_place") <= keep
    return some.select(*keys, F.when(kept, F.col("src_ip")).alias("src_ip"), "cnt", kept.alias("kept"))


def frequent_bounds(summaries: DataFrame) -> DataFrame:
    """Least and greatest possible count of each kept address over all batches: src_ip, low, high."""
    lost = summaries.filter("NOT kept").groupBy("batch_id").agg(F.max("cnt").alias("most"))
    total = lost.agg(F.coalesce(F.sum("most"), F.lit(0))).scalar()
    known = summaries.filter("kept").join(F.broadcast(lost), "batch_id", "left")
    return known.groupBy("src_ip").agg(
        F.sum("cnt").alias("low"), (F.sum("cnt") + total - F.sum(F.coalesce("most", F.lit(0)))).alias("high")
    )


def top_ips_of(summaries: DataFrame, alerts: DataFrame, limit: int = TOP_IPS) -> DataFrame:
    """The most frequent attackers over all batches, with exact counts, as :func:`top_attack_ips` gives them.

    Only addresses whose greatest possible count reaches the ``limit``-th least one
    are candidates. Their counts are exact in batches that left nothing out; in the
    others the alerts of the candidates are counted, and only those batches are read.
    Where an address that no batch kept could be among the first, all are counted.
    """
    lossy = summaries.filter("NOT kept").groupBy("batch_id").agg(F.max("cnt").alias("most"))
    unseen = lossy.agg(F.sum("most")).first()[0]
    if unseen is None:
        counts = summaries.groupBy("src_ip").agg(F.sum("cnt").alias("cnt"))
        return ranked(counts, "src_ip", limit)
    bounds = frequent_bounds(summaries)
    first = bounds.orderBy(F.desc("low")).limit(limit).agg(F.min("low").alias("least"), F.count("*").alias("n")).first()
    if first["n"] < limit or first["least"] <= unseen:
        return top_attack_ips(alerts, limit)
    wanted = bounds.filter(F.col("high") >= first["least"]).select(F.col("src_ip").alias("_ip"))
    named = [r["batch_id"] for r in lossy.select("batch_id").limit(NAMED + 1).collect()]
    if len(named) <= NAMED:
        # Named one by one, so that no folder of another batch is opened.
        inside = F.col("batch_id").isin(named)
        whole, again = summaries.filter(~inside), attacks(alerts).filter(inside)
    else:
        batches = F.broadcast(lossy.select("batch_id"))
        whole, again = (df.join(batches, "batch_id", how) for df, how in ((summaries, "left_anti"), (attacks(alerts), "left_semi")))
    whole, again = whole.select("src_ip", "cnt"), again.select("src_ip", F.lit(1).alias("cnt"))
    match = F.col("src_ip").eqNullSafe(F.col("_ip"))
    counts = whole.unionByName(again).join(wanted, match, "left_semi").groupBy("src_ip").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    return ranked(counts, "src_ip", limit)


# Profiles

def profile_parts(scored: DataFrame, *keys: str, columns: Iterable[str] = CLASS_PROFILED) -> DataFrame:
    """Mergeable profile of each column per label: n, mean, squared deviations, least, greatest, quantile sketch."""
    columns = list(columns)

    def parts(c: str) -> Column:
        return F.struct(
            F.lit(c).alias("name"), F.count(c).alias("n"), F.avg(c).alias("mean"), (F.var_pop(c) * F.count(c)).alias("squares"),
            F.min(c).alias("least"), F.max(c).alias("greatest"), F.kll_sketch_agg_double(c, QUANTILE_K).alias("sketch"),
        ).alias(c)

    wide = scored.filter(F.col(LABEL).isNotNull()).groupBy(*keys, LABEL).agg(*[parts(c) for c in columns])
    return wide.select(*keys, LABEL, F.explode(F.array(*columns)).alias("p")).select(*keys, LABEL, "p.*").filter("n > 0")


def class_profile_of(parts: DataFrame, columns: Iterable[str] = CLASS_PROFILED) -> DataFrame:
    """Mean and sample standard deviation of each column per label, out of the profiles of batches."""
    means = parts.groupBy(LABEL, "name").agg(
        F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("whole")
    )
    # Deviations from the batch's own mean, and of that mean from the whole one.
    moved = F.col("squares") + F.col("n") * (F.col("mean") - F.col("whole")) * (F.col("mean") - F.col("whole"))
    merged = parts.join(F.broadcast(means), [LABEL, "name"]).groupBy(LABEL, "name", "total", "whole").agg(F.sum(moved).alias("squares"))
    std = F.when(F.col("total") > 1, F.sqrt(F.col("squares") / (F.col("total") - 1)))
    wide = []
    for c in columns:
        mine = F.col("name") == c
        wide += [F.max(F.when(mine, F.col("whole"))).alias(f"avg_{c}"), F.max(F.when(mine, std)).alias(f"std_{c}")]
    return merged.groupBy(LABEL).agg(*wide)


def quantiles_of(parts: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Quantiles of each column per label, out of the profiles of batches: true_label, name, n, share, value."""
    merged = parts.groupBy(LABEL, "name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    each = F.explode(F.array(*[
        F.struct(F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(s)).alias("value")) for s in shares
    ]))
    return merged.select(LABEL, "name", "n", each.alias("q")).select(LABEL, "name", "n", "q.*")


def ranks_of(quantiles: DataFrame, rows: DataFrame, columns: Iterable[str] = CLASS_PROFILED) -> DataFrame:
    """Rows below and up to each of :func:`quantiles_of`'s values: its columns, below, upto.

    The values of a label are put side by side, so each row is compared with them
    as it is, not copied for each column and share.
    """
    columns = list(columns)
    shares = [r["share"] for r in quantiles.select("share").distinct().orderBy("share").collect()]
    cells = [(c, s, f"_{n}_{m}") for n, c in enumerate(columns) for m, s in enumerate(shares)]
    if not cells:
        return quantiles.limit(0).withColumns({c: F.lit(0).cast("bigint") for c in ("below", "upto")})
    limits = quantiles.groupBy(LABEL).agg(*[
        F.max(F.when((F.col("name") == c) & (F.col("share") == s), F.col("value"))).alias(at) for c, s, at in cells
    ])
    counts = rows.select(LABEL, *columns).join(F.broadcast(limits), LABEL).groupBy(LABEL).agg(*[
        F.struct(
            F.lit(c).alias("name"), F.lit(s).alias("share"),
            F.count_if(F.col(c) < F.col(at)).alias("below"), F.count_if(F.col(c) <= F.col(at)).alias("upto"),
        ).alias(at)
        for c, s, at in cells
    ])
    each = counts.select(LABEL, F.explode(F.array(*[at for _, _, at in cells])).alias("r")).select(LABEL, "r.*")
    return each.join(F.broadcast(quantiles), [LABEL, "name", "share"])
