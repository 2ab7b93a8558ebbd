"""Kept-up rollups, rejects, progress, corrections, the feed, and starts without a checkpoint."""

import datetime
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from netsift.operators import quality, rollups, sketches
from netsift.operators.parse import encode_flows
from netsift.schema import FEATURES, LABEL
from netsift.sinks.tables import read_table, write_batch
from netsift.streaming import fanout as stream
from netsift.streaming import feed, incremental, late, ledger
from netsift.streaming.progress import ProgressLog


@pytest.fixture(scope="module")
def parts(spark, folder):
    from netsift.plans.tables import stored_flows

    flows = stored_flows(spark, folder).filter("flow_id < 400")
    return [flows.filter(F.col("flow_id") % 4 == n).persist() for n in range(4)]


class Counts(stream.FanOut):
    """Writes the tables that rollups are made of, and no others."""

    def _tables(self, scored, one, batch_id):
        tables = super()._tables(scored, one, batch_id)
        return {t: tables[t] for t in incremental.MERGED}


def published(spark, root):
    return {n: sorted(map(str, stream.read_rollup(spark, root, n).collect())) for n in rollups.ROLLUP_KEYS}


def both(spark, root):
    """Rollups of an incremental refresh and of a full one (published elsewhere) at the same time."""
    incremental.refresh_incremental(spark, root)
    tables = (read_table(spark, f"{root}/{t}") for t in incremental.MERGED)
    full = {n: sorted(map(str, df.collect())) for n, df in rollups.rollups_from(*tables).items()}
    return published(spark, root), full


def test_incremental_refreshes_equal_full_ones(spark, parts, tmp_path):
    root = str(tmp_path)
    assert incremental.refresh_incremental(spark, root) is None
    fan = Counts(spark, root)
    fan(parts[0], 0)
    fan(parts[1].limit(10), 1)
    got, full = both(spark, root)
    assert got == full
    # The newest batch is replayed with other rows, then another follows.
    fan(parts[1], 1)
    got, full = both(spark, root)
    assert got == full and incremental.last_mark(spark, root).sealed == 0
    fan(parts[2], 2)
    fan(parts[3], 3)
    got, full = both(spark, root)
    assert got == full and incremental.last_mark(spark, root).sealed == 2


def test_refresh_without_news_keeps_the_version(spark, parts, tmp_path):
    root = str(tmp_path)
    fan = Counts(spark, root)
    fan(parts[0], 0)
    first = incremental.refresh_incremental(spark, root)
    assert incremental.refresh_incremental(spark, root) == first


def test_refresh_reads_new_folders_only(spark, parts, tmp_path):
    root = str(tmp_path)
    fan = Counts(spark, root)
    for n in range(3):
        fan(parts[n], n)
    incremental.refresh_incremental(spark, root)
    counts = incremental.batch_counts(spark, root, "attack_cube", [2])
    assert all("batch_id=2" in f for f in counts.inputFiles())
    expected = rollups.rollups_from(*(read_table(spark, f"{root}/{t}") for t in incremental.MERGED))["attack_distribution"]
    before = {r["attack_type"]: r["cnt"] for r in expected.collect()}
    for table in incremental.MERGED:
        for n in (0, 1):
            for part in (tmp_path / table / f"batch_id={n}").glob("part-*"):
                part.write_bytes(b"unreadable")
    fan(parts[3], 3)
    incremental.refresh_incremental(spark, root)
    more = {r["attack_type"]: r["cnt"] for r in spark.read.parquet(f"{root}/attack_cube/batch_id=3").groupBy("attack_type").agg(F.sum("cnt").alias("cnt")).collect()}
    got = {r["attack_type"]: r["cnt"] for r in stream.read_rollup(spark, root, "attack_distribution").collect()}
    assert got == {k: before.get(k, 0) + more.get(k, 0) for k in before.keys() | more.keys()}


def test_replay_of_a_sealed_batch_rebuilds(spark, parts, tmp_path):
    root = str(tmp_path)
    fan = Counts(spark, root)
    for n in range(3):
        fan(parts[n], n)
    incremental.refresh_incremental(spark, root)
    fan(parts[0].limit(5), 0)
    got, full = both(spark, root)
    assert got == full
    # After a full refresh the state is built anew as well.
    stream.refresh_rollups(spark, root)
    fan(parts[3], 3)
    got, full = both(spark, root)
    assert got == full


def test_many_folders_are_pruned(spark, parts, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "FOLDERS", 1)
    root = str(tmp_path)
    fan = Counts(spark, root)
    fan(parts[0], 0)
    incremental.refresh_incremental(spark, root)
    for n in (1, 2, 3):
        fan(parts[n], n)
    got, full = both(spark, root)
    assert got == full


def test_ledger(spark, tmp_path):
    root = str(tmp_path)
    assert ledger.last_complete(spark, root) == -1 and ledger.first_batch(spark, root, "a") == 0
    for batch in (0, 1, 1):
        ledger.record(spark, root, batch, 10)
    assert ledger.attempts(spark, root).count() == 3 and ledger.last_complete(spark, root) == 1
    seen = ledger.attempts(spark, root).agg(F.max("attempt")).first()[0]
    ledger.record(spark, root, 0, 5)
    assert [(r["batch_id"], r["rows"]) for r in ledger.attempts(spark, root, seen).collect()] == [(0, 5)]
    assert ledger.first_batch(spark, root, "b") == 2
    ledger.record(spark, root, 2, 1)
    assert [ledger.first_batch(spark, root, q) for q in "ab"] == [0, 2]


def test_offsets_of_a_topic(spark, tmp_path):
    root = str(tmp_path)
    assert ledger.starting_offsets(spark, root, "t") is None
    ids = [(0 << 48) + 7, (0 << 48) + 3, (10 << 48) + 0, (2 << 48) + 99]
    for batch, rows in ((0, ids), (1, [(2 << 48) + 500])):
        write_batch(spark.createDataFrame([(i,) for i in rows], "flow_id bigint"), f"{root}/alerts", batch, dated=False)
    write_batch(spark.createDataFrame([(8,)], "flow_id bigint"), f"{root}/rejects", 0, dated=False)
    ledger.record(spark, root, 0, 4)
    # The second batch was never completed.
    assert json.loads(ledger.starting_offsets(spark, root, "t")) == {"t": {"0": 9, "2": 100, "10": 1}}


def lines(spark, parts):
    texts = [r["value"] for r in encode_flows(parts[0].limit(6)).orderBy("value").collect()]
    moment = lambda t, m: json.dumps(json.loads(t) | {"timestamp": m})
    return [
        (1, texts[0]), (2, texts[1]), (3, texts[2][:40]), (4, "no json"), (5, "{}"), (6, None),
        (7, moment(texts[3], "2999-01-01T00:00:00Z")), (8, moment(texts[4], "1970-01-01T00:00:00Z")),
        (9, moment(texts[5], "no time")),
    ]


def judged(spark, parts):
    return stream.flows_from(spark.createDataFrame(lines(spark, parts), "flow_id bigint, raw_value string"))


def test_rejects_and_their_reasons(spark, parts):
    rows = {r["flow_id"]: (r["reject_reason"], r["raw_value"]) for r in judged(spark, parts).collect()}
    reasons = {i: r[0] for i, r in rows.items()}
    assert reasons == {1: None, 2: None, 3: "malformed", 4: "malformed", 5: "malformed", 6: "malformed", 7: "future", 8: "past", 9: None}
    assert rows[4][1] == "no json" and rows[1][1] is None


def test_rejects_are_stored_apart(spark, parts, tmp_path):
    root = str(tmp_path)
    fan = stream.FanOut(spark, root)
    fan(judged(spark, parts), 0)
    assert {r["flow_id"] for r in read_table(spark, f"{root}/alerts").collect()} == {1, 2, 9}
    rejects = read_table(spark, f"{root}/rejects")
    assert {r["flow_id"]: r["reject_reason"] for r in rejects.collect()} == {
        3: "malformed", 4: "malformed", 5: "malformed", 6: "malformed", 7: "future", 8: "past",
    }
    # No folder far off, and the statistics count flows only.
    assert not list(tmp_path.glob("alerts/*/event_date=2999*"))
    assert read_table(spark, f"{root}/traffic_stats").first()["total_packets"] == 3
    # A batch of rejects alone is complete and has no alerts; a retry without rejects leaves none behind.
    fan(judged(spark, parts).filter("reject_reason IS NOT NULL"), 1)
    assert ledger.last_complete(spark, root) == 1 and read_table(spark, f"{root}/alerts").filter("batch_id = 1").isEmpty()
    fan(judged(spark, parts).filter("reject_reason IS NULL"), 0)
    assert read_table(spark, f"{root}/rejects").filter("batch_id = 0").isEmpty()


def test_summaries_of_a_batch(spark, parts, tmp_path):
    root = str(tmp_path)
    fan = stream.FanOut(spark, root)
    for n in range(2):
        fan(parts[n], n)
    alerts = read_table(spark, f"{root}/alerts")
    assert read_table(spark, f"{root}/alert_minutes").agg(F.sum("cnt")).first()[0] == alerts.count() == 200
    exact = rollups.attacks(alerts).agg(F.countDistinct("src_ip")).first()[0]
    got = sketches.distinct_attackers(read_table(spark, f"{root}/attackers")).first()["cnt"]
    assert abs(got - exact) <= max(1, sketches.DISTINCT_ERROR * exact)
    profile = sketches.class_profile_of(read_table(spark, f"{root}/profiles"))
    assert profile.columns == quality.class_profile(parts[0].select(*FEATURES, LABEL)).columns and profile.count() == 2


TIMED = "timestamp timestamp_ntz, attack_type string"
START = datetime.datetime(2024, 1, 1)


def timed(spark, *minutes):
    return spark.createDataFrame([(START + datetime.timedelta(minutes=m), k) for m, k in minutes], TIMED)


def test_late_rows_are_kept_beside_the_windows(spark, tmp_path):
    root = str(tmp_path)
    write = late.LateTimeline(spark, root, lateness=600)
    write(timed(spark, (0, "Bot"), (1, "Bot"), (100, "Bot"), (3, "BENIGN")), 0)
    write(timed(spark, (0, "Bot"), (89, "Bot"), (89.5, "DDoS"), (90, "Bot"), (120, "Bot")), 1)

    def counts(corrected):
        rows = late.read_windows(spark, root, corrected).collect()
        return {((r["minute"] - START).seconds // 60, r["attack_type"]): r["cnt"] for r in rows}

    # Minute 89 ends at the watermark (100 - 10) and is closed; minute 90 is open.
    on_time = {(0, "Bot"): 1, (1, "Bot"): 1, (100, "Bot"): 1, (90, "Bot"): 1, (120, "Bot"): 1}
    whole = on_time | {(0, "Bot"): 2, (89, "Bot"): 1, (89, "DDoS"): 1}
    assert counts(False) == on_time and counts(True) == whole
    # A replay, also after a restart, finds the watermark of the batches before it.
    for again in (write, late.LateTimeline(spark, root, lateness=600)):
        again(timed(spark, (0, "Bot"), (89, "Bot"), (89.5, "DDoS"), (90, "Bot"), (120, "Bot")), 1)
        assert counts(False) == on_time and counts(True) == whole
    write(timed(spark), 2)
    write(timed(spark, (100, "Bot")), 3)
    assert counts(True) == whole | {(100, "Bot"): 2} and counts(False) == on_time


def test_feed_gives_each_location_once(spark, parts, tmp_path):
    root = str(tmp_path)
    fan = stream.FanOut(spark, root)

    def hand_on():
        feed.start_geo_feed(feed.read_geo_feed(spark, root), f"{root}/handed", f"{root}/checkpoint", once=True).awaitTermination()
        return sorted(r["flow_id"] for r in read_table(spark, f"{root}/handed").collect())

    fan(parts[0], 0)
    fan(parts[1].limit(20), 1)
    assert len(hand_on()) == read_table(spark, f"{root}/attacks_geo").count()
    fan(parts[1], 1)
    fan(parts[2], 2)
    got = hand_on()
    assert got == sorted(r["flow_id"] for r in read_table(spark, f"{root}/attacks_geo").collect()) == sorted(set(got))


def event(batch, rows=5, query="q", name="flows"):
    seen = {name: {"rows": rows, "malformed": 1, "missing_src_ip": 2, "rejected": 1}}
    progress = SimpleNamespace(id=query, batchId=batch, observedMetrics=seen, numInputRows=rows, batchDuration=7)
    return SimpleNamespace(progress=progress)


def test_progress_log_keeps_one_row_for_each_batch(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "log"))
    for e in (event(0), event(1), event(1, rows=6), event(0, query="later"), event(2, rows=0), event(3, name="others")):
        log.onQueryProgress(e)
    log.onQueryTerminated(None)
    log.close()
    rows = read_table(spark, str(tmp_path / "log")).collect()
    assert sorted((r["query"], r["batch_id"], r["rows"], r["rejected"]) for r in rows) == [
        ("later", 0, 5, 1), ("q", 0, 5, 1), ("q", 1, 6, 1),
    ]


def test_progress_log_tells_of_failures(spark, tmp_path):
    (tmp_path / "log").write_text("no folder")
    log = ProgressLog(spark, str(tmp_path / "log"))
    log.onQueryProgress(event(0))
    with pytest.raises(TimeoutError):
        log.close(timeout=0.1)
    log.onQueryTerminated(None)
    with pytest.raises(Exception, match="log"):
        log.close()


@pytest.mark.parametrize("limit", [10, 3])
def test_unseen_records_are_told_apart_without_moving_them(spark, tmp_path, limit):
    """Bit sets while they are few (six here), a join of single ids where there are more."""
    root = str(tmp_path)
    stored = [0, 1, 5, 63, 64, 130, -1, -64, 2**40 + 7, 2**63 - 1, None]
    write_batch(spark.createDataFrame([(i,) for i in stored], "flow_id bigint"), f"{root}/alerts", 0, dated=False)
    write_batch(spark.createDataFrame([(2,)], "flow_id bigint"), f"{root}/rejects", 0, dated=False)
    write_batch(spark.createDataFrame([(3,)], "flow_id bigint"), f"{root}/alerts", 1, dated=False)
    ledger.record(spark, root, 0, 11)
    ids = [0, 1, 2, 3, 3, 4, 5, 62, 63, 64, 65, 130, 194, -1, -2, -64, -65, 2**40 + 7, 2**40 + 6, 2**63 - 1, -(2**63), None, None]
    raw = spark.createDataFrame([(i, f"text {n}") for n, i in enumerate(ids)], "flow_id bigint, raw_value string")
    rest = ledger.unseen(raw, root, limit)
    assert rest.columns == raw.columns
    found = sorted(tuple(r) for r in rest.select(F.coalesce("flow_id", F.lit(-99)), "raw_value").collect())
    complete = {*stored, 2} - {None}
    assert found == sorted((-99 if i is None else i, f"text {n}") for n, i in enumerate(ids) if i not in complete)
    plan = rest._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftAnti" in plan) == (limit == 3)
