"""The streaming cooldown in keyed state: restarts, replays, seeds, eviction,
against the in-order loop."""

import datetime as dt
import random

import pandas as pd
from detector_oracle import cooldown_loop

from kpipulse.contract import DetectorParams
from kpipulse.operators import detect as D
from kpipulse.sources import files as FS
from kpipulse.streaming import detector as SD
from kpipulse.streaming import runs as R
from kpipulse.streaming.cooldown import CANDIDATE_SCHEMA

T0 = dt.datetime(2024, 1, 1)
P = DetectorParams(cooldown_s=4 * 3600, ignore_recent_s=0)


def at(h):
    return T0 + dt.timedelta(hours=h)


def row(metric, h, severity):
    return (metric, at(h), 10.0, 1.0, 0.0, 1.0, 6.0, severity)


def _land(spark, paths, batch, rows):
    frame = spark.createDataFrame(rows, CANDIDATE_SCHEMA)
    frame.repartition(3).write.mode("overwrite").parquet(f"{paths.candidates}/batch={batch}")


def _step(spark, paths):
    q = SD.alerts_query(spark, paths.candidates, paths.alerts, paths.ckpt("alerts"), P)
    q.awaitTermination()
    assert q.exception() is None
    return q


def _stored(spark, paths):
    if not FS.exists(spark, paths.alerts):
        return []
    return sorted((r.metric, r.window_start) for r in SD.read_alerts(spark, paths.alerts).collect())


def test_restarts_replays_and_seeds_equal_the_loop(spark):
    """Five batches, a restart for each; one is replayed with new file names;
    stored alerts are the first clocks of two metrics."""
    R.configure(spark)
    rng = random.Random(4)
    paths = R.new_paths(spark, "keyed")
    old = spark.createDataFrame([row("a", 3, "warning"), row("b", 9, "critical"), row("b", 1, "warning")], CANDIDATE_SCHEMA)
    SD.write_alerts(D.alerts_from(old, P), paths.alerts)
    other = D.alerts_from(old, DetectorParams(rule_name="other", cooldown_s=0)).selectExpr("*").replace("a", "c", "metric")
    SD.write_alerts(other.filter("metric = 'c'"), paths.alerts)
    before = _stored(spark, paths)
    every = []
    for b in range(5):
        rows = [
            row(m, h, rng.choice(["warning", "warning", "warning", "critical"]))
            for h in range(4 + 12 * b, 16 + 12 * b)
            for m in "abc"
            if rng.random() < 0.5 and not (m == "c" and b in (2, 3))
        ]
        every += rows
        _land(spark, paths, b, rows)
        _step(spark, paths)
        if b == 2:
            _land(spark, paths, b, rows)
            _step(spark, paths)
    names = [c.split()[0] for c in CANDIDATE_SCHEMA.split(", ")]
    seeds = {"a": pd.Timestamp(at(3)), "b": pd.Timestamp(at(9))}
    want = [(r.metric, r.window_start.to_pydatetime()) for r in cooldown_loop(pd.DataFrame(every, columns=names), P, seeds).itertuples()]
    got = _stored(spark, paths)
    assert sorted(before + want) == got and 10 < len(want) < len(every)


def test_state_is_evicted_after_the_cooldown(spark):
    R.configure(spark)
    paths = R.new_paths(spark, "evict")
    _land(spark, paths, 0, [row("a", 0, "warning"), row("b", 0, "warning")])
    _step(spark, paths)
    # the clocks of a and b run out when c's windows come
    _land(spark, paths, 1, [row("c", 20, "warning")])
    q = _step(spark, paths)
    # of three clocks one is left when the empty batch after it has fired timers
    rows = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    assert rows[-1] == 1 and max(rows) == 3
    _land(spark, paths, 2, [row("a", 21, "warning"), row("a", 22, "warning")])
    _step(spark, paths)
    assert _stored(spark, paths) == [("a", at(0)), ("a", at(21)), ("b", at(0)), ("c", at(20))]


def test_candidates_are_written_once_per_batch(spark, tmp_path):
    """The detector's two queries give the batch alerts; a new candidates
    checkpoint replays every batch and adds no alert."""
    from core_helpers import SF001
    from kpipulse.plans import pipeline as PL

    p = DetectorParams(lookback_s=48 * 3600, rolling=5, cooldown_s=6 * 3600, ignore_recent_s=0, warn_z=2.0)
    paths = R.run_stream_pipeline(spark, SF001, stages=("bronze", "silver", "gold", "detect_keyed"), width="1 hour", detector=p)
    ids = lambda df: sorted((r.alert_id, r.severity) for r in df.select("alert_id", "severity").collect())
    got = ids(SD.read_alerts(spark, paths.alerts))
    assert got == ids(D.detect(PL.gold(spark, SF001, "1 hour"), p)) and got
    SD.candidates_query(spark, paths.kpi, paths.candidates, paths.ckpt("candidates-2"), p).awaitTermination()
    SD.alerts_query(spark, paths.candidates, paths.alerts, paths.ckpt("alerts"), p).awaitTermination()
    assert ids(SD.read_alerts(spark, paths.alerts)) == got
