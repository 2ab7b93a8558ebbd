"""Rollups that are kept up by merging new batches into stored counts.

The state holds the counts of all *sealed* batches: those before the newest one,
which alone can still be replayed by its stream. A refresh adds the batches that
were sealed since the last refresh to the state, and the newest batch to the
published rollups only. So a replayed batch never counts twice, and a refresh
reads the state and the new batch folders, not the history.

A sealed batch is written again only if somebody restores an old checkpoint or
writes by hand. The ledger shows that, and the state is then built anew from all
stored counts.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators.rollups import rollups_from
from netsift.sinks.tables import exists, read_table
from netsift.sinks.versions import Versions
from netsift.streaming.ledger import attempts

#: Tables of counts that are merged, with their keys.
MERGED = {"attack_cube": ("hour", "attack_type", "protocol", "severity"), "attack_ips": ("src_ip",)}
MARK = "sealed bigint, newest bigint, attempt bigint, state string"
#: Folders of new batches that are named one by one; of more, the table is listed and pruned.
FOLDERS = 1_000


@dataclass(frozen=True)
class Mark:
    """Up to where a refresh went: last batch in the state, newest batch, its last attempt, folder of the state."""

    sealed: int
    newest: int
    attempt: int
    state: str


def last_mark(spark: SparkSession, root: str) -> Mark | None:
    """The mark of the newest refresh; None if there is none or if it was a full one."""
    latest = Versions(spark, f"{root}/rollups").latest()
    if latest is None or not exists(spark, f"{latest['location']}/mark"):
        return None
    return Mark(**spark.read.schema(MARK).parquet(f"{latest['location']}/mark").first().asDict())


def batch_counts(spark: SparkSession, root: str, table: str, batches: list[int]) -> DataFrame | None:
    """Counts of the named batches, out of their folders only; None if they have none."""
    path = f"{root}/{table}"
    if not batches:
        return None
    if len(batches) > FOLDERS:
        return read_table(spark, path).filter(F.col("batch_id").between(min(batches), max(batches)))
    folders = [f"{path}/batch_id={b}" for b in batches]
    return spark.read.option("basePath", path).parquet(*folders)


def merged(parts: list[DataFrame | None], keys: tuple[str, ...]) -> DataFrame:
    """One row of ``cnt`` for each key, out of partial counts."""
    rows = [p.select(*keys, "cnt") for p in parts if p is not None]
    total = rows[0]
    for part in rows[1:]:
        total = total.unionByName(part)
    return total.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


def refresh_incremental(spark: SparkSession, root: str) -> str | None:
    """Bring the five rollups up to date and publish them together; None before the first batch.

    They equal those of a full refresh at the same time. Without a new attempt since
    the last refresh, its version stays.
    """
    versions, mark = Versions(spark, f"{root}/rollups"), last_mark(spark, root)
    log = attempts(spark, root, mark.attempt if mark else None).filter("rows > 0")
    # The last attempt at a batch counts.
    latest = log.groupBy("batch_id").agg(F.max_by("rows", "attempt").alias("rows"), F.max("attempt").alias("attempt"))
    bounds = latest.agg(F.min("batch_id").alias("low"), F.max("batch_id").alias("high"), F.max("attempt").alias("attempt")).first()
    if bounds["high"] is None:
        return versions.latest()["location"] if mark else None
    rebuild = mark is None or bounds["low"] <= mark.sealed
    newest = max(bounds["high"], mark.newest) if mark else bounds["high"]
    version, location = versions.new_location()
    state = f"{location}/state"
    if rebuild:
        old = {t: None for t in MERGED}
        added = {t: read_table(spark, f"{root}/{t}").filter(F.col("batch_id") < newest) for t in MERGED}
        grown = True
    else:
        # Batches since the last refresh, and the one that was the newest then.
        new = {r["batch_id"] for r in latest.select("batch_id").collect()} | {mark.newest}
        sealed = sorted(b for b in new if mark.sealed < b < newest)
        old = {t: spark.read.parquet(f"{mark.state}/{t}") for t in MERGED}
        added = {t: batch_counts(spark, root, t, sealed) for t in MERGED}
        grown = bool(sealed)
    if grown:
        _write_all(spark, {t: merged([old[t], added[t]], keys) for t, keys in MERGED.items()}, state)
    else:
        state = mark.state
    whole = {
        t: merged([spark.read.parquet(f"{state}/{t}"), batch_counts(spark, root, t, [newest])], keys)
        for t, keys in MERGED.items()
    }
    _write_all(spark, rollups_from(whole["attack_cube"], whole["attack_ips"]), location)
    row = spark.createDataFrame([(newest - 1, newest, bounds["attempt"], state)], MARK)
    row.coalesce(1).write.mode("overwrite").parquet(f"{location}/mark")
    versions.publish(version, location)
    return location


def _write_all(spark: SparkSession, tables: dict[str, DataFrame], location: str) -> None:
    def write(name: str) -> None:
        tables[name].hint("rebalance").write.mode("overwrite").parquet(f"{location}/{name}")

    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), tables))
