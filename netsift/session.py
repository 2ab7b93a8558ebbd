"""Session setup and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "netsift", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording the Python call site of every expression costs seconds per micro-batch.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Whole-stage code only where its methods are short enough for the JVM to compile them.

    A projection of some fifty computed columns is longer than that and would be
    interpreted; without whole-stage code Spark cuts it into short methods.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors can reach.

    It lies below ``spark.checkpoint.dir``. Only a local session may go without
    that setting; it then gets a temporary folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="netsift-")
        warnings.warn(f"spark.checkpoint.dir is not set; this local session uses {base}", stacklevel=2)
    return f"{base.rstrip('/')}/netsift/{purpose}-{uuid.uuid4().hex}"
