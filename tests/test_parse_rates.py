"""Records are parsed as numbers, quantiles checked without copies of rows, by methods short enough to be compiled."""

from pyspark.sql import functions as F

from netsift.functions.numbers import as_double, as_int
from netsift.operators import parse, sketches
from netsift.operators.quality import CLASS_PROFILED
from netsift.schema import DOUBLE_COLUMNS, INT_COLUMNS, LABEL, WIRE_SCHEMA, WIRE_TO_COLUMN
from netsift.streaming import fanout as stream

ODD = [
    '{"flowDuration":-0,"totalFwdPackets":-0.0,"srcPort":"12.7","label":"1"}', '{"flowDuration":"x","idleMean":2}',
    '{"flowDuration":"INF","srcPort":1e12,"label":-0 }', '{"flowDuration":1e400,"srcPort":99.9,"idleMean":12345678901234567890123}',
    '{"flow', '[{"flowDuration":3,"srcIp":5}]', "null", "", "  ", '{"idleMean":" 7 ","activeMean":"1d","srcPort":"007"}',
    '{"flowDuration":true,"srcIp":{"a":1},"idleMean":[1],"timestamp":7}', '{"flowDuration":1,"flowDuration":"z"}',
    '{"flowDuration":NaN,"idleMean":-Infinity,"activeMean":"nan","bwdIatMean":"","label":null}', "5", "{}", None,
    '{"srcPort":2147483648,"dstPort":-1.5,"flowDuration":0.1e-5}', '{"flowDuration":5} {"flowDuration":6}',
    '{"flowDuration":7.25,"srcPort":80,"protocol":"TCP","label":1.0}',
]


def by_text(raw):
    """Every value as text first."""
    def typed(c, text):
        return as_int(text) if c in INT_COLUMNS else as_double(text) if c in DOUBLE_COLUMNS else text

    record = raw.select("flow_id", F.from_json("raw_value", WIRE_SCHEMA).alias("r"))
    return record.select("flow_id", *[typed(c, F.col(f"r.{w}")).alias(c) for w, c in WIRE_TO_COLUMN.items()])


def test_numbers_read_as_such_are_those_of_their_text(spark):
    raw = spark.createDataFrame(list(enumerate(ODD)), "flow_id bigint, raw_value string")
    got, want = (sorted(str(r) for r in df.collect()) for df in (parse.parse_flows(raw, "flow_id"), by_text(raw)))
    assert got == want


def test_values_are_not_read_as_text_where_they_are_numbers(spark):
    raw = spark.createDataFrame([(0, "{}")], "flow_id bigint, raw_value string")
    plan = parse.parse_flows(raw, "flow_id")._jdf.queryExecution().analyzed().toString()
    assert "StructField(flowDuration,DoubleType,true)" in plan


def test_ranks_are_counted_without_copies_of_rows(spark):
    rows = [(float(n % 2), *[float((n * (7 + i)) % 50) for i in range(len(CLASS_PROFILED))]) for n in range(400)]
    wide = spark.createDataFrame(rows, f"{LABEL} double, {', '.join(f'{c} double' for c in CLASS_PROFILED)}")
    found = sketches.quantiles_of(sketches.profile_parts(wide))
    ranks = sketches.ranks_of(found, wide)
    plan = ranks._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    got = ranks.collect()
    assert len(got) == 2 * 3 * len(CLASS_PROFILED)
    for r in got:
        mine = [row[1 + CLASS_PROFILED.index(r["name"])] for row in rows if row[0] == r[LABEL]]
        assert (r["below"], r["upto"], r["n"]) == (sum(x < r["value"] for x in mine), sum(x <= r["value"] for x in mine), len(mine))
    assert sketches.ranks_of(found.limit(0), wide).count() == 0


def test_batches_are_written_by_compiled_methods(spark, flows, tmp_path, monkeypatch):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    write = stream.write_batch
    monkeypatch.setattr(stream, "write_batch", lambda df, *a, **k: (seen.append(df.sparkSession.conf.get(name)), write(df, *a, **k)))
    stream.FanOut(spark, str(tmp_path))(flows.limit(50).withColumn("ingest_time", F.col("timestamp")), 0)
    assert seen and set(seen) == {"8000"}
    assert spark.conf.get(name) == before
