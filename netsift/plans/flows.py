"""Flow records derived from the ``events`` table.

Every value is a fixed integer function of the row's key, so that any engine
computes the same flows from the same table. The formulas are arithmetic on
BIGINT reduced modulo a prime, which cannot overflow at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators.clean import clean_all
from netsift.operators.detect import ATTACK_LIMITS, detect, to_alerts
from netsift.schema import FEATURES

PRIME = 10_007
BATCH_ROWS = 100

ATTACK_SHARE = 0.35

# Scale of a feature: attack flows lie between SPAN times the scale. It sits near the limits of the detector and of
# the class rules, so that every class occurs; features without a limit take a scale from their place in the order.
SPAN = (0.6, 2.2)
SCALES = {c: 40 * (2 + n % 11) for n, c in enumerate(FEATURES)} | {
    "flow_bytes_per_sec": 400_000, "flow_packets_per_sec": 40_000, "total_fwd_packets": 4_000,
    "total_backward_packets": 2_500, "syn_flag_count": 150, "fin_flag_count": 50, "rst_flag_count": 25,
    "packet_length_mean": 90, "fwd_psh_flags": 25,
}
# Attacks are short, normal flows long: (lowest, width).
DURATION = {1: (0, 1_500), 0: (2_000, 40_000)}

# Rows on both sides of the limits: {key % EDGE: values}. Normal flows exactly at one limit are none, flows just above
# it are false alarms, and attack flows far below all limits are missed.
EDGE = 89
NORMAL_EDGES = {n: {c: limit} for n, (c, limit) in enumerate(ATTACK_LIMITS.items())}
NORMAL_EDGES |= {n + 10: {c: limit + 1} for n, (c, limit) in enumerate(ATTACK_LIMITS.items())}
_AT_LIMITS = {
    "flow_packets_per_sec": 50_000, "total_fwd_packets": 5_000, "total_backward_packets": 5_000,
    "syn_flag_count": 200, "fin_flag_count": 100, "rst_flag_count": 50, "fwd_psh_flags": 50,
}
ATTACK_EDGES = {
    1: _AT_LIMITS | {"total_backward_packets": 5_001, "packet_length_mean": 99},
    2: _AT_LIMITS | {"total_fwd_packets": 3_001, "fwd_psh_flags": 51},
    3: _AT_LIMITS | {"flow_bytes_per_sec": 500_001, "flow_packets_per_sec": 50_001},
    4: _AT_LIMITS,
    5: {c: limit // 2 for c, limit in ATTACK_LIMITS.items()},
}


def _unit(key: str, k: int) -> str:
    product = f"(({key} + {7 * k + 3}) % {PRIME}) * (({key} + {13 * k + 5}) % {PRIME})"
    return f"cast(({product} + {101 * k + 17} * ({key} % {PRIME})) % {PRIME} as double) / {PRIME}"


def _range(name: str, attack: int) -> tuple[int, int]:
    """Lowest value and width of a feature's range."""
    if name == "flow_duration":
        return DURATION[attack]
    if attack:
        return int(SPAN[0] * SCALES[name]), int((SPAN[1] - SPAN[0]) * SCALES[name])
    return 0, int(0.8 * min(SCALES[name], ATTACK_LIMITS.get(name, SCALES[name])) * SPAN[0])


def _draw(name: str, attack: int, unit: str) -> str:
    low, width = _range(name, attack)
    part = f"({unit}) * {width}"
    whole = name.endswith(("_count", "_flags"))
    return f"cast({low} as double) + " + (f"floor({part})" if whole else part)


def feature_sql(name: str, key: str = "k") -> str:
    """A feature as SQL over the key and the attack flag ``lbl``, readable by any engine."""
    unit = _unit(key, FEATURES.index(name) + 1)
    cases = []
    if name == "flow_bytes_per_sec":
        cases += [f"when {key} % 499 = 0 then cast('Infinity' as double)", f"when {key} % 251 = 0 then null"]
    if name in ("syn_flag_count", "fwd_iat_mean"):
        cases.append(f"when {key} % 251 = 1 then null")
    cases += [
        f"when lbl = {label} and {key} % {EDGE} = {n} then cast({values[name]} as double)"
        for label, edges in ((1, ATTACK_EDGES), (0, NORMAL_EDGES)) for n, values in edges.items() if name in values
    ]
    cases.append(f"when lbl = 1 then {_draw(name, 1, unit)}")
    return f"case {' '.join(cases)} else {_draw(name, 0, unit)} end"


def label_sql(key: str = "k") -> str:
    return f"case when {_unit(key, 0)} < {ATTACK_SHARE} then 1 else 0 end"


def source_sql(key: str = "k", user: str = "u") -> str:
    """Source address as SQL; some are missing or empty."""
    attack = f"concat('172.16.', {user} % 3, '.', 20 + {user} % 50)"
    normal = f"concat('198.18.', {user} % 4, '.', 1 + {user} % 200)"
    return (
        f"case when {key} % 997 = 0 then null when {key} % 991 = 0 then ''"
        f" when lbl = 1 then {attack} else {normal} end"
    )


def port_sql(side: str, key: str = "k") -> str:
    """Source or destination port as SQL."""
    if side == "src":
        return f"cast(1024 + ({key} * 37) % 60000 as int)"
    services = " ".join(f"when {key} % 4 = {n} then {port}" for n, port in enumerate((22, 53, 443)))
    return f"cast(case when lbl = 1 then ({key} * 13) % 1024 {services} else 8080 end as int)"


def _identity() -> dict[str, Column]:
    k = F.col("k")
    return {
        "flow_id": k,
        "batch_id": F.expr(f"k div {BATCH_ROWS}"),
        "timestamp": F.col("t"),
        "src_ip": F.expr(source_sql()),
        "dst_ip": F.concat(F.lit("203.0.113."), 1 + k % 254),
        "src_port": F.expr(port_sql("src")),
        "dst_port": F.expr(port_sql("dst")),
        "protocol": F.when(k % 487 == 0, None).when(k % 3 == 0, "TCP").when(k % 3 == 1, "UDP").otherwise("ICMP"),
        "true_label": F.col("lbl").cast("double"),
    }


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Key, time and user of each event, out of which a flow follows."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(F.col("event_id").alias("k"), F.col("ts").alias("t"), F.col("user_id").alias("u"))


def flows_of(keyed: DataFrame, *keep: str) -> DataFrame:
    """Flow records out of :func:`keyed` rows, before the columns in ``keep``.

    A flow is some thirty times as wide as its event, so what has to be dealt over tasks is dealt before this.
    """
    labelled = keyed.withColumn("lbl", F.expr(label_sql()))
    features = [F.expr(feature_sql(c)).alias(c) for c in FEATURES]
    return labelled.select(*[e.alias(c) for c, e in _identity().items()], *features, *keep)


def flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flow records, one per event."""
    return flows_of(keyed(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned and classified flows."""
    return detect(clean_all(flows(spark, folder)))


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The alert projection of all flows, with their ids."""
    return to_alerts(scored(spark, folder), "flow_id", "batch_id")


def geo_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Address ranges of eight, one per supplier, in two blocks with gaps between the ranges."""
    k = F.col("s_suppkey")
    start = F.when(k % 2 == 0, F.lit(3323068416)).otherwise(F.lit(2886729728)) + F.expr("s_suppkey div 2") * 16
    return spark.read.parquet(f"{folder}/supplier.parquet").select(
        start.cast("bigint").alias("ip_from"),
        (start + 7).cast("bigint").alias("ip_to"),
        (F.lit(30.0) + (k % 1000) / F.lit(100.0)).alias("latitude"),
        (F.lit(-10.0) + (k % 700) / F.lit(100.0)).alias("longitude"),
    )


def nested_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The supplier ranges within wider ones (of some suppliers) within blocks of one per nation, and some that cross."""
    inner = geo_ranges(spark, folder)
    k = F.col("s_suppkey")
    base = F.when(k % 2 == 0, F.lit(3323068416)).otherwise(F.lit(2886729728))
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")

    def spread(rows: DataFrame, start: Column, length: int, latitude: Column, longitude: Column) -> DataFrame:
        lat, lon = latitude.cast("double").alias("latitude"), longitude.cast("double").alias("longitude")
        return rows.select(start.cast("bigint").alias("ip_from"), (start + length - 1).cast("bigint").alias("ip_to"), lat, lon)

    middle = spread(suppliers.filter(k % 5 == 0), base + F.expr("s_suppkey div 2") * 16, 100, F.lit(50) + k % 30, F.lit(60))
    crossing = spread(suppliers.filter(k % 7 == 0), base + F.expr("s_suppkey div 2") * 16 + 4, 40, F.lit(-20) - k % 30, F.lit(-60))
    n = F.col("n_nationkey")
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    outer = [
        spread(nations, F.lit(block) + n * 256, 256, F.lit(80) - n, F.lit(10) + n) for block in (3323068416, 2886729728)
    ]
    result = inner
    for part in (middle, crossing, *outer):
        result = result.unionByName(part)
    return result


def ipv6_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """An IPv6 address for each event, in short and long spellings."""
    k = F.col("event_id")
    parts = [F.lower(F.hex(x)) for x in (F.expr("(event_id % 5000) div 256"), F.expr("event_id % 5000 % 256"), k % 7 + 1)]
    short = F.concat(F.lit("2001:db8:"), parts[0], F.lit(":"), parts[1], F.lit("::"), parts[2])
    long = F.concat(F.lit("2001:0DB8:"), F.lpad(parts[0], 4, "0"), F.lit(":"), parts[1], F.lit(":0:0:0:"), parts[2])
    return spark.read.parquet(f"{folder}/events.parquet").select(
        k.alias("flow_id"), F.when(k % 3 == 0, long).otherwise(short).alias("src_ip")
    )


def ipv6_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """IPv6 ranges as literals: one for all, some of 48 bits within it, and four subnets of 64 bits per supplier."""
    k = F.col("s_suppkey")
    rest = F.lit(":ffff:ffff:ffff:ffff")
    x, y, z = (F.lower(F.hex(c)) for c in (k % 20, k % 252, k % 252 + 3))
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    inner = suppliers.select(
        F.concat(F.lit("2001:db8:"), x, F.lit(":"), y, F.lit("::")).alias("ip_from"),
        F.concat(F.lit("2001:db8:"), x, F.lit(":"), z, rest).alias("ip_to"),
        (k % 90).cast("double").alias("latitude"), (k % 170).cast("double").alias("longitude"),
    )
    nets = suppliers.filter((k < 20) & (k % 3 != 0)).select(
        F.concat(F.lit("2001:db8:"), x, F.lit("::")), F.concat(F.lit("2001:db8:"), x, F.lit(":ffff"), rest),
        (k + 100).cast("double"), F.lit(7.0),
    )
    every = suppliers.filter(k == 0).select(F.lit("2001:db8::"), F.concat(F.lit("2001:db8:ffff:ffff"), rest), F.lit(1.0), F.lit(2.0))
    return inner.union(nets).union(every)
