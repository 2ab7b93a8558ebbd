"""Locations of source addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.config import DEFAULTS, GeoSettings
from netsift.functions.ip import with_ip_hash, with_ip_key
from netsift.operators.ranges import RangeIndex, lookup_sorted
from netsift.schema import GENERIC_NAMES
from netsift.session import scratch_dir

# Fixed value: modulus and scale of the derived offsets (7 degrees in thousandths).
SPREAD = 7_000
SRID = 4326
NO_ADDRESS = "0.0.0.0"


def _reflect(value: Column, limit: int) -> Column:
    return (
        F.when(value > limit, F.lit(2.0 * limit) - value)
        .when(value < -limit, F.lit(-2.0 * limit) - value)
        .otherwise(value)
    )


def hashed_location(hash_: Column, geo: GeoSettings = DEFAULTS.geo) -> tuple[Column, Column]:
    """Latitude and longitude derived from an address hash; the origin where it is NULL."""
    spread = F.lit(SPREAD).cast("bigint")
    lat = F.lit(geo.latitude) + (hash_ % spread) / F.lit(1000.0)
    lon = F.lit(geo.longitude) + (F.call_function("div", hash_, spread) % spread) / F.lit(1000.0)
    return (
        F.coalesce(_reflect(lat, 90), F.lit(geo.latitude)),
        F.coalesce(_reflect(lon, 180), F.lit(geo.longitude)),
    )


def geo_hash(df: DataFrame, column: str = "src_ip", geo: GeoSettings = DEFAULTS.geo) -> DataFrame:
    """Add ``latitude``, ``longitude`` and ``geo_source`` (hash/default) from the address alone."""
    hashed = with_ip_hash(df, column, "_hash")
    lat, lon = hashed_location(F.col("_hash"), geo)
    source = F.when(F.col("_hash").isNull(), "default").otherwise("hash")
    return hashed.withColumns({"latitude": lat, "longitude": lon, "geo_source": source}).drop("_hash")


def geo_defaults(alerts: DataFrame) -> DataFrame:
    """Alerts fit for locating: no NULL address, and defaults for what else is missing."""
    return alerts.filter(F.col("src_ip").isNotNull()).withColumns(
        {
            "src_ip": F.when(F.col("src_ip") == "", NO_ADDRESS).otherwise(F.col("src_ip")),
            "attack_type": F.coalesce("attack_type", F.lit("Unknown")),
            "severity": F.coalesce("severity", F.lit("medium")),
        }
    )


def geo_point(df: DataFrame) -> DataFrame:
    """Add ``geom`` (lon, lat, srid) and its text form ``geom_ewkt``."""
    point = F.struct(
        F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), F.lit(SRID).alias("srid")
    )
    text = F.format_string(f"SRID={SRID};POINT(%s %s)", F.col("longitude"), F.col("latitude"))
    return df.withColumns({"geom": point, "geom_ewkt": text})


def _lookup_large(df: DataFrame, index: RangeIndex, column: str, geo: GeoSettings) -> DataFrame:
    """Range join for range tables too large for every task.

    Only distinct addresses meet the ranges, so no address can grow hot there. On
    the way back to the rows, the addresses that hold more than 1/hot_fraction of
    all rows are broadcast; there are fewer than hot_fraction of them. All others
    are shuffled. Rows that need no shuffled match get keys that are spread over
    all partitions.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "addresses")
    known = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ip")).agg(F.count("*").alias("_rows"))
    with_ip_key(known, "_ip", "_key").write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.sum("_rows")).scalar()
    hot = F.col("_rows") * geo.hot_fraction > total
    located = lookup_sorted(counts, index.pieces(), "_key", index.rows + counts.count())

    def renamed(part: DataFrame, mark: str) -> DataFrame:
        return part.select(*[F.col(c).alias(f"{mark}{c}") for c in ("_ip", "_lat", "_lon")])

    frequent = F.broadcast(renamed(located.filter(hot), "_hot"))
    rare = renamed(located.filter(~hot & F.col("_lat").isNotNull()), "_rare")
    settled = F.col(column).isNull() | F.col("_hot_ip").isNotNull()
    spread = F.concat(F.lit("~"), F.xxhash64(*df.columns).cast("string"))
    first = df.join(frequent, F.col(column) == F.col("_hot_ip"), "left").withColumn(
        "_join", F.when(settled, spread).otherwise(F.col(column))
    )
    return first.join(rare, F.col("_join") == F.col("_rare_ip"), "left").select(
        *df.columns,
        F.coalesce("_hot_lat", "_rare_lat").alias("_lat"),
        F.coalesce("_hot_lon", "_rare_lon").alias("_lon"),
    )


def geo_range_join(
    df: DataFrame,
    ranges: DataFrame | RangeIndex,
    column: str = "src_ip",
    geo: GeoSettings = DEFAULTS.geo,
    small: bool | None = None,
) -> DataFrame:
    """Add ``latitude``, ``longitude`` and ``geo_source`` (range/hash/default).

    ``ranges`` holds ``ip_from, ip_to`` (inclusive: IPv4 as BIGINT, or literals of
    either version), ``latitude`` and ``longitude``. Where ranges overlap, the one
    that starts last counts, of these the one that ends first: of nested ranges
    the innermost. Addresses in no range get the derived location.

    A :class:`RangeIndex` may be given to cut the ranges only once. As long as its
    pieces are at most ``broadcast_rows``, which is always checked, the rows are
    never shuffled; ``small=False`` takes the way for larger ones, which gives the
    same rows.
    """
    if not isinstance(ranges, RangeIndex):
        ranges = RangeIndex.build(ranges, 0 if small is False else geo.broadcast_rows)
    if ranges.table is not None:
        found = ranges.located(with_ip_key(df, column, "_key"), "_key").drop("_key")
    else:
        found = _lookup_large(df, ranges, column, geo)
    hashed = with_ip_hash(found, column, "_hash")
    lat, lon = hashed_location(F.col("_hash"), geo)
    source = (
        F.when(F.col("_lat").isNotNull(), "range").when(F.col("_hash").isNotNull(), "hash").otherwise("default")
    )
    return hashed.withColumns(
        {"latitude": F.coalesce("_lat", lat), "longitude": F.coalesce("_lon", lon), "geo_source": source}
    ).drop("_hash", "_lat", "_lon")


def attacks_geo(
    alerts: DataFrame, *keep: str, ranges: DataFrame | RangeIndex | None = None, geo: GeoSettings = DEFAULTS.geo
) -> DataFrame:
    """Located alerts, after the columns in ``keep``."""
    ready = geo_defaults(alerts).select(*keep, "src_ip", "attack_type", "severity", "timestamp")
    return geo_hash(ready, geo=geo) if ranges is None else geo_range_join(ready, ranges, geo=geo)


def _plotted(geo_rows: DataFrame) -> DataFrame:
    return geo_rows.filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~F.col("attack_type").isin(*GENERIC_NAMES)
    )


def geo_map(geo_rows: DataFrame, limit: int = 1_000) -> DataFrame:
    """The newest attack locations."""
    newest = _plotted(geo_rows).orderBy(F.desc("timestamp"), F.desc("flow_id")).limit(limit)
    return newest.select("flow_id", "latitude", "longitude", "src_ip", "attack_type", "severity")


def geo_bbox(geo_rows: DataFrame, limit: int = 500) -> DataFrame:
    """Bounding box of the newest locations that have non-zero coordinates."""
    newest = geo_rows.orderBy(F.desc("timestamp"), F.desc("flow_id")).limit(limit)
    drawn = newest.filter((F.col("latitude") != 0) & (F.col("longitude") != 0))
    return drawn.agg(
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
        F.count("*").alias("points"),
    )
