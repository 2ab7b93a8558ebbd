"""Health of parquet files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = b"PAR1"
#: Bytes of a file besides its columns and its footer: both marks and the length of the footer.
FRAME = 12
#: Largest file whose whole content a task holds; of a larger one only the ends are read.
WHOLE = 65_536


def _bare(path):
    """A path without its scheme's slashes, so that ``file:/`` and ``file:///`` compare equal."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def _sound() -> Column:
    """Whether the ends of a whole ``content`` are those of a parquet file."""
    digits = F.hex(F.reverse(F.substring("content", -8, 4)))
    return (
        (F.substring("content", 1, 4) == F.lit(MARK)) & (F.substring("content", -4, 4) == F.lit(MARK))
        & (F.conv(digits, 16, 10).cast("bigint") <= F.octet_length("content") - FRAME)
    )


def _sound_ends(spark: SparkSession, path: str, length: int) -> bool:
    """The same of a file of ``length`` bytes, of which only the ends are read, by the file system that Spark uses."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    opened = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(place)
    try:
        first = opened.readInt()
        opened.seek(length - 8)
        footer, last = opened.readInt(), opened.readInt()
    finally:
        opened.close()
    size = int.from_bytes(footer.to_bytes(4, "big", signed=True), "little")
    return first == last == int.from_bytes(MARK, "big") and size <= length - FRAME


def parquet_audit(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per parquet file below ``folder``: ``file, status (OK/BAD), row_count``.

    Row counts come from the file footers, as no column is read. Files that
    cannot be opened are skipped by that scan. A file without rows yields no row
    either; it differs by its closing bytes: the length of a footer that fits
    into the file, and the format's mark.
    """
    common = {"recursiveFileLookup": "true", "pathGlobFilter": pattern}
    listed = spark.read.format("binaryFile").options(**common).load(folder)
    counted = (
        spark.read.options(**common, ignoreCorruptFiles="true")
        .schema("no_such_column int")
        .parquet(folder)
        # By the path as it is, which a row costs little; it is changed once for a file.
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("rows"))
        .groupBy(_bare(F.col("path")).alias("file"))
        .agg(F.sum("rows").alias("row_count"))
    )
    seen = listed.select(_bare(F.col("path")).alias("file"), "path", "length").join(counted, "file", "left")
    silent = seen.filter("row_count is null")
    # A scan of contents reads every file whole, so it is kept to small ones: the filter of the length decides what it opens.
    # A file without rows is little but a footer; the few larger ones of which no row was seen are opened here.
    small = listed.filter((F.col("length") >= FRAME) & (F.col("length") <= WHOLE))
    ends = small.select(_bare(F.col("path")).alias("file"), _sound().alias("sound")).join(silent.select("file"), "file", "left_semi")
    large = silent.filter(F.col("length") > WHOLE).select("file", "path", "length").collect()
    if large:
        with ThreadPoolExecutor(16) as pool:
            sound = pool.map(lambda r: _sound_ends(spark, r["path"], r["length"]), large)
            rows = [(r["file"], s) for r, s in zip(large, sound)]
        ends = ends.union(spark.createDataFrame(rows, "file string, sound boolean"))
    empty = ends.filter("sound").select("file", F.lit(0).cast("bigint").alias("none"))
    found = seen.join(empty, "file", "left").withColumn("row_count", F.coalesce("row_count", "none"))
    return found.select(
        "file", F.when(F.col("row_count").isNull(), "BAD").otherwise("OK").alias("status"), "row_count"
    )
