"""Streaming jobs (S3, K1-K5, ST1-ST11): batch/stream twins, late data,
restart from checkpoint, replay."""

import datetime as dt
import json

from pyspark.sql import functions as F

from core_helpers import SF001, envelope_rows
from kpipulse.plans import pipeline as P
from kpipulse.streaming import jobs as J
from kpipulse.streaming import runs as R


def kv(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_twins_equal_batch(spark):
    paths = R.run_stream_pipeline(spark, SF001)
    kpi_stream = J.read_kpi(spark, paths.kpi)
    kpi_batch = P.gold(spark, SF001, "1 minute")
    r = lambda df: kv(df.select("window_start", "metric", F.round("value", 6).alias("v")), "window_start", "metric", "v")
    assert r(kpi_stream) == r(kpi_batch)
    silver = R.read_table(spark, paths.silver)
    assert silver.count() == 901
    assert R.read_table(spark, paths.quarantine).count() == 105
    assert R.read_table(spark, paths.bronze).count() == 1020


def _event(eid, when, etype="click"):
    return json.dumps(
        {
            "event_id": eid,
            "event_version": 1,
            "event_type": etype,
            "event_time": when.strftime("%Y-%m-%dT%H:%M:%S.000Z"),
            "ingest_time": when.strftime("%Y-%m-%dT%H:%M:%S.000Z"),
            "user_id": "user_0001",
            "session_id": "s1",
            "product_id": "sku_00001",
            "source": "test",
        }
    )


def test_dedupe_late_data_and_restart(spark):
    paths = R.new_paths(spark, "late")
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    # batch 1: two events and an in-batch duplicate
    envelope_rows(spark, [_event("a", t0), _event("b", t0 + dt.timedelta(minutes=1)), _event("a", t0)]).write.mode("append").parquet(paths.topic)
    R.run_stream_pipeline(spark, SF001, paths, land=False, watermark="15 minutes")
    assert kv(R.read_table(spark, paths.silver).select("event_id"), "event_id") == [("a",), ("b",)]
    # batch 2 (restart from the same checkpoints): a far-later event moves the
    # watermark; a re-sent "b" within the watermark is suppressed
    later = t0 + dt.timedelta(hours=2)
    envelope_rows(spark, [_event("c", later), _event("b", t0 + dt.timedelta(minutes=1))], start_offset=10).write.mode("append").parquet(paths.topic)
    R.run_stream_pipeline(spark, SF001, paths, land=False, watermark="15 minutes")
    assert kv(R.read_table(spark, paths.silver).select("event_id"), "event_id") == [("a",), ("b",), ("c",)]
    # batch 3: an event older than the watermark is dropped by the stateful operators
    envelope_rows(spark, [_event("d", t0)], start_offset=20).write.mode("append").parquet(paths.topic)
    R.run_stream_pipeline(spark, SF001, paths, land=False, watermark="15 minutes")
    ids = kv(R.read_table(spark, paths.silver).select("event_id"), "event_id")
    assert ("d",) not in ids
    # bronze saw every message exactly once across the three restarts
    assert R.read_table(spark, paths.bronze).count() == 6
    # gold: the KPI table holds the late-but-in-time windows, newest version per window
    kpi = J.read_kpi(spark, paths.kpi)
    totals = {r.window_start: r.value for r in kpi.filter("metric = 'events_total'").collect()}
    assert totals[t0] == 1.0 and totals[t0 + dt.timedelta(minutes=1)] == 1.0


def test_gold_sink_replay_is_idempotent(spark):
    from kpipulse.operators.tables import read_versioned, write_versioned_batch

    paths = R.new_paths(spark, "replay")
    kpi = P.gold(spark, SF001, "1 hour")
    write_versioned_batch(kpi, paths.kpi, 1, 0)
    before = kv(read_versioned(spark, paths.kpi), "window_start", "metric", "value")
    write_versioned_batch(kpi, paths.kpi, 1, 0)  # the same batch id again
    assert kv(read_versioned(spark, paths.kpi), "window_start", "metric", "value") == before


def test_run_id_survives_restart(spark):
    paths = R.new_paths(spark, "runid")
    ck = paths.ckpt("gold")
    r1 = J.run_id(spark, ck, paths.kpi)
    import os

    os.makedirs(ck, exist_ok=True)
    assert J.run_id(spark, ck, paths.kpi) == r1


def test_streaming_detector_equals_batch_and_is_replay_safe(spark):
    from dataclasses import replace

    from kpipulse.contract import DetectorParams
    from kpipulse.operators import detect as D
    from kpipulse.streaming.detector import detector_query

    p = DetectorParams(lookback_s=48 * 3600, rolling=5, cooldown_s=6 * 3600, ignore_recent_s=0, warn_z=2.0)
    paths = R.run_stream_pipeline(spark, SF001, stages=("bronze", "silver", "gold", "detect"), width="1 hour", detector=p)
    got = kv(R.read_table(spark, paths.alerts).select("alert_id", "severity"), "alert_id", "severity")
    want = kv(D.detect(P.gold(spark, SF001, "1 hour"), p).select("alert_id", "severity"), "alert_id", "severity")
    assert got == want and len(got) > 0
    # a new checkpoint over the same KPI versions replays every batch: no new rows
    q = detector_query(spark, paths.kpi, paths.alerts, paths.ckpt("detector-2"), replace(p))
    q.awaitTermination()
    again = R.read_table(spark, paths.alerts)
    assert again.count() == len(got)
    assert again.groupBy("alert_id").count().filter("count > 1").count() == 0


def test_rate_limited_topic_equals_batch(spark):
    """maxFilesPerTrigger splits the topic into several Bronze micro-batches;
    the end result still equals the batch KPIs (late drops across batches are
    covered by the restart test)."""
    paths = R.new_paths(spark, "ratelim")
    R.land_topic(spark, SF001, paths.topic, files=3)
    R.run_stream_pipeline(spark, SF001, paths, land=False, max_files_per_trigger=1, stages=("bronze",))
    R.run_stream_pipeline(spark, SF001, paths, land=False, max_files_per_trigger=40, stages=("silver",), watermark="40 days")
    silver = J.parquet_stream(spark, paths.silver, J.SILVER_READ_SCHEMA, max_files_per_trigger=60)
    # a watermark longer than the data: no batch is late, so the result is exact
    q = J.gold_query(silver, paths.kpi, paths.ckpt("gold"), watermark="40 days")
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 3
    got = J.read_kpi(spark, paths.kpi)
    want = P.gold(spark, SF001, "1 minute")
    r = lambda df: kv(df.select("window_start", "metric", F.round("value", 6).alias("v")), "window_start", "metric", "v")
    assert r(got) == r(want)
    assert R.read_table(spark, paths.bronze).count() == 1020


def test_detector_scores_each_window_once(spark):
    """Re-emitted and late windows are not polled again, after a restart
    neither; a replayed batch runs its polls again and inserts nothing."""
    from kpipulse.contract import DetectorParams
    from kpipulse.operators.tables import write_versioned_batch
    from kpipulse.streaming import detector as SD

    p = DetectorParams(lookback_s=48 * 3600, rolling=5, cooldown_s=3600, ignore_recent_s=0, warn_z=1.5, metrics=("revenue",))
    paths = R.new_paths(spark, "once")
    t0 = dt.datetime(2024, 1, 1)
    at = lambda h: t0 + dt.timedelta(hours=h)
    frame = lambda hs, jump=0.0: spark.createDataFrame(
        [(at(h), m, 100.0 + (h * 7) % 5 + (500.0 if h == 20 else 0.0) + jump) for h in hs for m in ("revenue", "events_click")],
        "window_start timestamp, metric string, value double",
    )

    def step(k, rows):
        write_versioned_batch(rows, paths.kpi, 1, k)
        SD.detector_query(spark, paths.kpi, paths.alerts, paths.ckpt("detector"), p).awaitTermination()
        return kv(SD.read_alerts(spark, paths.alerts), "window_start") if k else None

    step(0, frame(range(20)))
    first = step(1, frame(range(20, 23)))
    assert (at(20),) in first
    # windows sent again, one of them now far off: none is scored again
    assert step(2, frame(range(5, 19), jump=900.0)) == first
    polls = paths.ckpt("detector") + ".polls"
    assert SD.polled_before(spark, polls, 9) == at(22) and SD.polled_before(spark, polls, 1) == at(19)
    assert SD.polled_before(spark, polls, 0) is None


def test_late_rows_of_a_batched_run_are_counted(spark):
    """Many micro-batches: what differs from the batch result is exactly the
    rows that the watermark dropped as late."""
    paths = R.new_paths(spark, "drops")
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    for i, evs in enumerate([[_event("a", t0)], [_event("b", t0 + dt.timedelta(hours=3))], [_event("c", t0 + dt.timedelta(hours=3))], [_event("late", t0)]]):
        envelope_rows(spark, evs, start_offset=10 * i).coalesce(1).write.mode("append").parquet(paths.topic)
        R.run_stream_pipeline(spark, SF001, paths, stages=("bronze",), land=False)
    bronze = J.parquet_stream(spark, paths.bronze, J.BRONZE_READ_SCHEMA, max_files_per_trigger=1)
    qs, qq = J.silver_queries(bronze, paths.silver, paths.quarantine, paths.ckpt("s"), paths.ckpt("q"), watermark="15 minutes", by_hour=False)
    qs.awaitTermination()
    qq.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for pr in qs.recentProgress for op in pr["stateOperators"])
    kept = kv(R.read_table(spark, paths.silver).select("event_id"), "event_id")
    assert kept == [("a",), ("b",), ("c",)] and dropped == 1
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == R.ROCKSDB


def test_dedupe_modes_state_lifetime(spark):
    """exact: a repeat of an old id is suppressed forever (state never shrinks);
    within_watermark: the id's state is evicted once the watermark passes, so
    a much later repeat is emitted again."""
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    later = t0 + dt.timedelta(hours=3)
    got = {}
    for mode in ("exact", "within_watermark"):
        paths = R.new_paths(spark, f"mode-{mode}")
        batches = [[_event("a", t0)], [_event("z", later)], [_event("a", later)]]
        for i, evs in enumerate(batches):
            envelope_rows(spark, evs, start_offset=10 * i).write.mode("append").parquet(paths.topic)
            R.run_stream_pipeline(spark, SF001, paths, stages=("bronze", "silver"), land=False, watermark="15 minutes", dedupe=mode)
        got[mode] = kv(R.read_table(spark, paths.silver).select("event_id"), "event_id")
    assert got["exact"] == [("a",), ("z",)]
    assert got["within_watermark"] == [("a",), ("a",), ("z",)]


def test_running_pipeline_with_processing_time_triggers(spark):
    """All stages run concurrently on processing-time triggers; draining them
    in stage order gives the batch KPIs."""
    paths = R.new_paths(spark, "running")
    R.land_topic(spark, SF001, paths.topic)
    env = J.envelope_file_source(spark, paths.topic)
    queries = R.start_pipeline(spark, env, paths, trigger="1 second")
    try:
        for q in queries:
            q.processAllAvailable()
        got = J.read_kpi(spark, paths.kpi)
        want = P.gold(spark, SF001, "1 minute")
        r = lambda df: kv(df.select("window_start", "metric", F.round("value", 6).alias("v")), "window_start", "metric", "v")
        assert r(got) == r(want)
        assert all(q.isActive for q in queries)
    finally:
        for q in queries:
            q.stop()
    R.await_any(spark, 1)


def test_written_files_are_counted(spark):
    """The number asked for, of about as many rows: copies go apart, and few
    rows leave empty files."""
    root = R.new_paths(spark, "written").root
    same = spark.range(1000).selectExpr("1 AS a", "CAST(NULL AS STRING) AS b")
    for rows, files in ((same, 4), (same.limit(1), 3), (same.limit(0), 2)):
        R.write_files(rows, f"{root}/t", files)
    assert len([f for f in R.FS.child_files(spark, f"{root}/t") if f.endswith(".parquet")]) == 9
    sizes = [r["count"] for r in spark.read.parquet(f"{root}/t").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1001 and max(sizes) < 400


def test_parts_of_many_files(spark, monkeypatch):
    """A part of the topic or of Bronze is as many files as its rows need,
    none of them large, and one micro-batch all the same."""
    from kpipulse.plans import queries as Q

    names = ("stream_bronze_raw", "stream_late_rows", "stream_dq_counts")
    rows = lambda name: sorted(map(str, getattr(Q, name)(spark, SF001).collect()))
    want = {name: rows(name) for name in names}
    monkeypatch.setattr(R, "ROWS_PER_FILE", 50)
    seen, new_paths = [], R.new_paths
    monkeypatch.setattr(R, "new_paths", lambda *a: seen.append(new_paths(*a)) or seen[-1])
    assert {name: rows(name) for name in names} == want
    for p, at, parts, queries in zip(seen, ("topic", "bronze", "bronze"), (3, 4, 4), (["bronze"], ["s", "q"], ["s", "q"]), strict=True):
        files = spark.read.parquet(getattr(p, at)).groupBy(F.input_file_name()).count().collect()
        assert len(files) > 2 * parts and max(r["count"] for r in files) < 120
        for q in queries:
            batches = spark.read.json(f"{p.ckpt(q)}/sources/0/*").select("path", "batchId").where("path IS NOT NULL")
            assert batches.select("batchId").distinct().count() == parts
