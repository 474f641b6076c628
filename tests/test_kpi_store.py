"""The compacting KPI store: manifest, merges, replay, readers, file counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpipulse.operators.kpi_store import KpiStore
from kpipulse.sources.log import CommitLog
from kpipulse.streaming import detector as SD
from kpipulse.streaming import runs as R

TS = "window_start timestamp, metric string, value double"
T0 = dt.datetime(2024, 1, 1)


def at(h):
    return T0 + dt.timedelta(hours=h)


def frame(spark, hours, value, metrics=("a", "b")):
    return spark.createDataFrame([(at(h), m, float(value)) for h in hours for m in metrics], TS).coalesce(1)


def content(df):
    return sorted((r.window_start, r.metric, r.value) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield KpiStore(spark, str(tmp_path / "kpi"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_merge_keeps_the_newest_version_of_each_window(spark, store):
    store.commit(frame(spark, range(0, 30), 1), 1, 0)
    store.commit(frame(spark, [5, 26], 2, ("a",)), 1, 1)
    want = content(store.read())
    assert (at(5), "a", 2.0) in want and (at(5), "b", 1.0) not in want
    store.compact()
    assert content(store.read()) == want
    # a later version over merged rows replaces whole windows again
    store.commit(frame(spark, [5, 40], 3, ("b",)), 1, 2)
    got = content(store.read())
    assert [x for x in got if x[0] == at(5)] == [(at(5), "b", 3.0)] and (at(40), "b", 3.0) in got
    store.compact()
    assert content(store.read()) == got
    store.compact()  # nothing to merge
    assert content(store.read()) == got and store.days() == ["2024-01-01", "2024-01-02"]


def test_replay_changes_nothing_before_and_after_a_merge(spark, store):
    assert store.commit(frame(spark, [1, 2], 1), 1, 0)
    assert store.commit(frame(spark, [2, 3], 2), 1, 1)
    want = content(store.read())
    assert not store.commit(frame(spark, [2, 3], 2), 1, 1)
    store.compact()
    assert not store.commit(frame(spark, [1, 2], 1), 1, 0) and not store.commit(frame(spark, [2, 3], 2), 1, 1)
    assert content(store.read()) == want
    # a new run supersedes, an old one that wakes up does not
    assert store.commit(frame(spark, [2], 9), 2, 0) and not store.commit(frame(spark, [2], 7), 1, 5)
    assert (at(2), "a", 9.0) in content(store.read())
    # an empty batch is committed and adds nothing
    assert store.commit(frame(spark, [2], 9).filter("false"), 2, 1)
    assert (at(2), "a", 9.0) in content(store.read()) and store.snapshot()[1].newest == (2, 1)


def test_a_planned_reader_outlives_merges(spark, store):
    store.commit(frame(spark, range(20), 1), 1, 0)
    store.commit(frame(spark, range(5), 2), 1, 1)
    planned = store.read()
    want = content(planned)
    store.compact()
    store.commit(frame(spark, range(20), 3), 1, 2)
    merged = store.read()
    store.compact()
    assert content(planned) == want
    last = content(merged)
    assert {v for _, _, v in last} == {3.0}
    # past the retention the replaced folders go, the table stays
    store.compact(retain_s=0)
    assert content(store.read()) == last and not store.snapshot()[1].replaced
    assert spark.conf.get("spark.sql.files.ignoreMissingFiles") == "false"


def test_a_crash_between_write_and_commit_is_harmless(spark, store, monkeypatch):
    store.commit(frame(spark, [1, 2], 1), 1, 0)
    want = content(store.read())

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(store.log, "append", fail)
    for step in (lambda: store.commit(frame(spark, [2], 5), 1, 1), store.compact):
        with pytest.raises(OSError):
            step()
        assert content(store.read()) == want
    monkeypatch.undo()
    assert store.commit(frame(spark, [2], 5), 1, 1)
    store.compact()
    assert (at(2), "b", 5.0) in content(store.read())


def test_files_opened_stay_bounded_over_many_batches(spark, store):
    """40 batches that move along ten days: a read of the last two days opens
    as many files in the end as early on, and the manifest stays small."""
    counts, sizes = [], []
    for b in range(40):
        store.commit(frame(spark, [6 * b, 6 * b + 6], b), 1, b, compact_every=4, retain_s=0)
        day = at(6 * b)
        counts.append(len(store.read(day - dt.timedelta(days=1), day).inputFiles()))
        sizes.append(len(store.snapshot()[1].versions) + len(store.snapshot()[1].replaced))
    assert max(counts[20:]) <= max(counts[:20]) <= 3 + 2 * 4
    assert max(sizes) <= 20
    every = content(store.read())
    newest = lambda t: float(min(39, (t - T0) // dt.timedelta(hours=6)))
    assert len(every) == 41 * 2 and all(v == newest(t) for t, _, v in every)
    assert len(store.read().inputFiles()) <= 11 + 2 * 4
    # the folders of merged versions are gone
    from kpipulse.sources import files as FS

    assert len(FS.child_dirs(spark, f"{store.path}/run=1")) <= 2 * 4


def test_date_bounds_prune_the_manifest(spark, store):
    store.commit(frame(spark, range(0, 96, 6), 1), 1, 0)
    store.compact()
    store.commit(frame(spark, [50], 2), 1, 1)
    part = store.read(at(48), at(71))
    assert {r.window_start.day for r in part.collect()} == {3} and len(part.inputFiles()) == 2
    assert store.read(at(999)).count() == 0
    assert content(store.read()) == sorted(content(part) + [x for x in content(store.read()) if x[0].day != 3])


def test_streams_see_versions_once_and_no_merged_file(spark, store):
    """A stream over the table: each committed row once, however often the
    table has been merged in between."""
    out, ck = store.path + "-seen", store.path + "-ck"

    def step():
        q = SD.version_stream(spark, store.path).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
        q.trigger(availableNow=True).start().awaitTermination()

    for b in range(4):
        store.commit(frame(spark, [b, b + 1], b), 1, b)
        step()
        if b % 2:
            store.compact()
            step()
    seen = spark.read.parquet(out)
    assert seen.count() == 16 and seen.groupBy("batch").count().filter("count != 4").count() == 0
    assert seen.filter(F.col("value") != F.col("batch")).count() == 0


def test_commit_log_reads_do_not_grow(spark, tmp_path, monkeypatch):
    from kpipulse.sources import files as FS

    log = CommitLog(spark, str(tmp_path / "log"), keep=5)
    assert log.last() is None
    reads = []
    real = FS.read_text
    monkeypatch.setattr(FS, "read_text", lambda *a: reads.append(a[1]) or real(*a))
    per = []
    for n in range(1, 40):
        log.append(n, {"n": n})
        reads.clear()
        assert log.last() == (n, {"n": n})
        per.append(len(reads))
    assert set(per) == {2} and log.get(39) and log.get(30) is None
    with pytest.raises(Exception):
        log.append(39, {"n": 0})
    # a hint that a crash left behind, or none
    FS.write_text(spark, f"{log.path}/_last", "37")
    assert log.last() == (39, {"n": 39})
    FS.write_text(spark, f"{log.path}/_last", "")
    assert log.last() == (39, {"n": 39})


def test_detector_reads_are_constant_per_batch(spark, tmp_path, monkeypatch):
    """The detector's log: one record read per batch, whatever came before."""
    from kpipulse.sources import files as FS

    log = CommitLog(spark, str(tmp_path / "polls"))
    for b in range(60):
        log.append(b + 1, {"batch": b, "newest": b * 3_600_000_000})
    reads = []
    real = FS.read_text
    monkeypatch.setattr(FS, "read_text", lambda *a: reads.append(a[1]) or real(*a))
    assert SD._record_before(log, 60)["batch"] == 59 and len(reads) == 2
    reads.clear()
    assert SD._record_before(log, 59)["batch"] == 58 and len(reads) == 3  # a replay


def test_gold_stream_with_merges_equals_batch(spark):
    from core_helpers import SF001

    from kpipulse.plans import pipeline as P
    from kpipulse.streaming import jobs as J

    paths = R.new_paths(spark, "merging")
    R.land_topic(spark, SF001, paths.topic, files=3)
    R.run_stream_pipeline(spark, SF001, paths, land=False, stages=("bronze", "silver"))
    silver = J.parquet_stream(spark, paths.silver, J.SILVER_READ_SCHEMA, max_files_per_trigger=60)
    J.gold_query(silver, paths.kpi, paths.ckpt("gold"), width="1 hour", watermark="40 days", compact_every=2, retain_s=0).awaitTermination()
    store = KpiStore(spark, paths.kpi)
    assert store.snapshot()[1].base > 0
    r = lambda df: sorted((x.window_start, x.metric, round(x.value, 6)) for x in df.collect())
    assert r(J.read_kpi(spark, paths.kpi)) == r(P.gold(spark, SF001, "1 hour"))
