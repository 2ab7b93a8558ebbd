"""Tables in shared storage, and connected components of links."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.session import scratch_dir


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python in batches of at most ``BATCH_BYTES``, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def numbered_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row; a column that has the name and type already is taken as it is.

    An alias would hide from the planner that two uses of these rows are the same.
    """

    def named(column: str, name: str, kind: str) -> Column:
        same = column == name and dict(docs.dtypes)[column] == kind
        return docs[column] if same else docs[column].cast(kind).alias(name)

    return docs.select(named(id_column, "doc_id", "bigint"), named(text_column, "text", "string"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_hashes(rows: DataFrame, size: int, *columns: str) -> DataFrame:
    """At most ``size`` of the rows, those with the smallest hashes of columns that are unique together.

    The rows are counted, and only those below a hash that about ``size`` rows lie
    below are put in order, so that neither a task nor the driver gets more.
    """
    total = rows.count()
    near = rows.withColumn("_hash", F.xxhash64(*columns))
    if total > size:
        share = (size + 6 * math.sqrt(size) + 6) / total
        near = near.filter(F.col("_hash") < math.floor(-(2.0**63) + min(share, 1.0) * (2.0**64 - 2.0**12)))
    return near.orderBy("_hash", *columns).limit(size).drop("_hash")


def components(links: DataFrame) -> DataFrame:
    """Smallest node that is reachable from each node: ``node, component`` for all nodes of ``links (a, b)``.

    Each round every node moves to its least neighbour or itself, by id in the
    first round and by a hash of id and round afterwards, and the links are
    contracted; a constant share of the nodes vanishes in each round on average.
    A round is two joins on the links that are left, whose hot keys adaptive
    execution splits. Self-links keep a node in the result.
    """
    edges = stored(links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    place = nodes.select("node", F.col("node").alias("root"))
    edges = edges.filter("a <> b")
    number = 0
    while not edges.isEmpty():
        rank = F.col("to") if number == 0 else F.xxhash64("to", F.lit(number))
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a"))
        both = both.select("node", F.struct(rank.alias("rank"), "to").alias("to"))
        own = F.struct((F.col("node") if number == 0 else F.xxhash64("node", F.lit(number))).alias("rank"), F.col("node").alias("to"))
        step = stored(
            both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least(own, F.col("to"))["to"].alias("to")),
            "step",
        )
        place = stored(
            place.join(step.select(F.col("node").alias("root"), F.col("to").alias("next")), "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")
            ),
            "place",
        )
        left, right = (step.select(F.col("node").alias(c), F.col("to").alias(f"{c}2")) for c in "ab")
        moved = edges.join(left, "a").join(right, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        edges = stored(
            moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        number += 1
    # All nodes of a root form a component; its smallest node names it.
    names = place.groupBy("root").agg(F.min("node").alias("component"))
    return place.join(names, "root").select("node", "component")
