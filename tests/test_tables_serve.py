"""Writers (K5-K8) and serving reads."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from core_helpers import SF001
from kpipulse.operators import serve as S
from kpipulse.operators import tables as T
from kpipulse.plans import pipeline as P

TS = "window_start timestamp, metric string, value double"


def t(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_replace_windows_replaces_all_metrics_and_is_idempotent(spark):
    table = spark.createDataFrame([(t(1), "a", 1.0), (t(1), "b", 2.0), (t(2), "a", 3.0)], TS)
    batch = spark.createDataFrame([(t(1), "a", 10.0)], TS)
    once = T.replace_windows(table, batch)
    # metric b of window 1 disappears: the whole window is replaced
    assert rows(once, "window_start", "metric", "value") == [(t(1), "a", 10.0), (t(2), "a", 3.0)]
    twice = T.replace_windows(once, batch)
    assert rows(twice, "window_start", "metric", "value") == rows(once, "window_start", "metric", "value")


def test_insert_if_absent_keeps_existing_and_is_idempotent(spark):
    schema = "alert_id string, metric string, value double"
    table = spark.createDataFrame([("x", "m", 1.0)], schema)
    new = spark.createDataFrame([("x", "m", 9.0), ("y", "m", 2.0), ("y", "m", 2.0)], schema)
    once = T.insert_if_absent(table, new)
    assert rows(once, "alert_id", "value") == [("x", 1.0), ("y", 2.0)]
    assert rows(T.insert_if_absent(once, new), "alert_id", "value") == rows(once, "alert_id", "value")
    assert T.duplicate_keys(once, ["alert_id"]).count() == 0


def test_key_checks(spark):
    df = spark.createDataFrame([(t(1), "a", 1.0), (t(1), "a", 2.0), (None, "b", 1.0)], TS)
    assert T.duplicate_keys(df, ["window_start", "metric"]).count() == 1
    assert T.null_keys(df, ["window_start", "metric"]).count() == 1


def test_versioned_reader_keeps_newest_batch_per_window(spark, tmp_path):
    path = str(tmp_path / "kpi")
    b0 = spark.createDataFrame([(t(1), "a", 1.0), (t(1), "b", 1.0), (t(2), "a", 5.0)], TS)
    b1 = spark.createDataFrame([(t(1), "a", 7.0)], TS)
    T.write_versioned_batch(b0, path, 1, 0)
    T.write_versioned_batch(b1, path, 1, 1)
    T.write_versioned_batch(b1, path, 1, 1)  # replayed batch overwrites its folder
    got = rows(T.read_versioned(spark, path), "window_start", "metric", "value")
    assert got == [(t(1), "a", 7.0), (t(2), "a", 5.0)]


def test_kpi_table_layout_roundtrip(spark, tmp_path):
    kpi = P.gold(spark, SF001, "1 hour")
    path = str(tmp_path / "kpi_table")
    T.write_kpi_table(kpi, path)
    back = spark.read.parquet(path)
    assert "window_date" in back.columns and back.count() == kpi.count()
    s = S.kpi_series(back, "events_total", to_ts="2024-01-03T00:00:00Z", from_ts="2024-01-02T00:00:00Z")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "window_date" in plan


@pytest.fixture(scope="module")
def small_kpi(spark):
    data = [(t(h), m, float(h * 10 + i)) for h in range(6) for i, m in enumerate(["revenue", "events_total"])]
    return spark.createDataFrame(data, TS)


def test_kpi_series_keeps_oldest_points(small_kpi):
    s = S.kpi_series(small_kpi, "revenue", to_ts="2024-01-01T05:00:00Z", from_ts="2024-01-01T01:00:00Z", limit=2)
    assert [r.window_start for r in s.collect()] == [t(1), t(2)]
    # default range: the hour before ``to``
    d = S.kpi_series(small_kpi, "revenue", as_of=t(5))
    assert [r.window_start for r in d.collect()] == [t(4), t(5)]


def test_kpi_latest_nulls_for_absent_metric(small_kpi):
    got = {r.metric: (r.window_start, r.value) for r in S.kpi_latest(small_kpi, ["revenue", "nothing"]).collect()}
    assert got == {"revenue": (t(5), 50.0), "nothing": (None, None)}
    with pytest.raises(ValueError):
        S.kpi_latest(small_kpi, [" "])


def test_trailing_is_relative_to_newest_row(small_kpi):
    got = S.trailing(small_kpi.filter("metric = 'revenue'"), 120)
    assert sorted(r.window_start for r in got.collect()) == [t(3), t(4), t(5)]


def test_alert_reads(spark):
    schema = "alert_id string, window_start timestamp, metric string, severity string, value double, baseline double, score double"
    data = [(f"r:{m}:{h}", t(h), m, "critical" if h % 2 else "warning", 1.0, 0.5, 3.5) for h in range(5) for m in ("a", "b")]
    alerts = spark.createDataFrame(data, schema)
    got = S.alerts_query(alerts, to_ts=t(4), from_ts=t(1), severity="warning", limit=10)
    assert [(r.window_start, r.metric) for r in got.collect()] == [(t(4), "a"), (t(4), "b"), (t(2), "a"), (t(2), "b")]
    assert [r.alert_id for r in S.alerts_latest(alerts, 3).collect()] == ["r:a:4", "r:b:4", "r:a:3"]
    assert S.alert_sample(alerts, 20).columns == ["window_start", "metric", "severity", "value", "baseline", "score"]
    assert S.severity_filter(alerts, "all").count() == 10


def test_parse_bound():
    assert S.parse_bound("2026-01-08T10:00:00Z") == dt.datetime(2026, 1, 8, 10)
    assert S.parse_bound("2026-01-08T12:00:00+02:00") == dt.datetime(2026, 1, 8, 10)
    assert S.parse_bound("2026-01-08T10:00:00") == dt.datetime(2026, 1, 8, 10)


def test_pushdown_and_pruning_in_gold_plan(spark):
    kpi = P.gold(spark, SF001, "1 minute")
    plan = kpi._jdf.queryExecution().executedPlan().toString()
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l]
    assert scan, plan
    # Silver reads the stored Bronze table: the raw payload is pruned away and
    # the validity predicate is evaluated at the scan
    assert "raw_json" not in scan[0] and "DataFilters" in scan[0]
    # dedupe and KPIs are cut down before their shuffles
    assert "row_number(), 1, Partial" in plan and "partial_sum" in plan


def test_empty_kpi_table_reads_as_empty(spark, tmp_path):
    kpi = T.read_versioned(spark, str(tmp_path / "kpi"))
    assert kpi.count() == 0 and {"window_start", "metric", "value"} <= set(kpi.columns)


def test_reader_planned_before_later_versions_loses_no_row(spark, tmp_path):
    """Versions are never deleted by the writer: a reader that has listed the
    table keeps its view while new versions arrive."""
    path = str(tmp_path / "kpi")
    T.write_versioned_batch(spark.createDataFrame([(t(h), "a", 1.0) for h in range(20)], TS), path, 1, 0)
    planned = T.read_versioned(spark, path)
    planned.explain()
    for k in range(1, 4):
        T.write_versioned_batch(spark.createDataFrame([(t(h), "a", 1.0 + k) for h in range(10)], TS), path, 1, k)
    assert planned.count() == 20
    assert rows(T.read_versioned(spark, path), "value").count((4.0,)) == 10
    assert spark.conf.get("spark.sql.files.ignoreMissingFiles") == "false"


def test_kpi_files_are_sorted(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "kpi")
    data = [(t(h) + dt.timedelta(days=d), m, 1.0) for h in range(9, -1, -1) for d in (1, 0) for m in ("b", "a", "c")]
    T.write_kpi_table(spark.createDataFrame(data, TS).repartition(5), path)
    files = glob.glob(f"{path}/window_date=*/*.parquet")
    assert len(files) == 2
    for f in files:
        got = [(r["metric"], r["window_start"]) for r in pq.ParquetFile(f).read().to_pylist()]
        assert got == sorted(got) and len(got) == 30


def test_created_at_default(spark):
    """K8: created_at is filled at write time when missing, kept when set."""
    a = spark.createDataFrame([("x", None), ("y", t(1))], "alert_id string, created_at timestamp")
    got = {r.alert_id: r.created_at for r in T.with_created_at(a).collect()}
    assert got["y"] == t(1) and got["x"] is not None
    b = T.with_created_at(spark.createDataFrame([("z",)], "alert_id string"))
    assert b.collect()[0].created_at is not None


def test_newest_reads_open_the_newest_dates_only(spark, tmp_path):
    """Latest values and newest alerts: exact, from as few dates as hold them;
    an absent metric makes the read go through all dates and stays null."""
    path = str(tmp_path / "kpi")
    data = [(t(5) + dt.timedelta(days=d), m, float(d)) for d in range(40) for m in ("a", "b", "c") if m != "c" or d < 37]
    T.write_kpi_table(spark.createDataFrame(data, TS), path)
    kpi = spark.read.parquet(path)
    days = S.partition_days(kpi)
    assert len(days) == 40 and days[0] == "2024-02-09"

    def dates(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"window_date#\d+ >= (\d{4}-\d\d-\d\d)", plan)[:1]

    two = S.kpi_latest(kpi, ["a", "b"])
    assert dates(two) == ["2024-02-09"] and {(r.metric, r.value) for r in two.collect()} == {("a", 39.0), ("b", 39.0)}
    three = S.kpi_latest(kpi, ["a", "c"])
    assert dates(three) == ["2024-02-06"] and {(r.metric, r.value) for r in three.collect()} == {("a", 39.0), ("c", 36.0)}
    absent = S.kpi_latest(kpi, ["a", "zz"])
    assert dates(absent) == [] and {(r.metric, r.value) for r in absent.collect()} == {("a", 39.0), ("zz", None)}
    some = S.kpi_sample(kpi, 5)
    assert dates(some) == ["2024-02-06"]
    assert [tuple(r) for r in some.collect()] == [tuple(r) for r in kpi.drop("window_date").orderBy(F.desc("window_start"), "metric").limit(5).collect()]
    assert dates(S.kpi_sample(kpi, 10_000)) == [] and S.kpi_sample(kpi, 10_000).count() == len(data)
    # a table that is not partitioned is read as a whole
    assert S.kpi_sample(spark.createDataFrame(data, TS), 5).count() == 5


def test_checked_append_refuses_what_breaks_the_key(spark, tmp_path):
    """K7: a repeated key in the batch or the touched dates, or a null, and the
    table stays as it is; other dates are not read."""
    path = str(tmp_path / "alerts")
    schema = "alert_id string, window_start timestamp, metric string"
    put = lambda rows: T.checked_append(spark.createDataFrame(rows, schema), path, ["alert_id"], ("window_start", "metric"), _append_dated)
    assert put([("x", t(1), "a"), ("y", t(2), "a")]) == 2
    for bad in ([("x", t(3), "b")], [("z", t(3), "a"), ("z", t(4), "a")], [("q", t(5), None)], [(None, t(5), "a")]):
        with pytest.raises(T.ConstraintError):
            put(bad)
        assert rows(spark.read.parquet(path), "alert_id") == [("x",), ("y",)]
    assert put([]) == 0 and put([("z", t(3), "b")]) == 1
    assert rows(spark.read.parquet(path), "alert_id") == [("x",), ("y",), ("z",)]
    assert not (tmp_path / "alerts.staged").exists()


def _append_dated(df, path):
    df.withColumn("window_date", F.to_date("window_start")).write.mode("append").partitionBy("window_date").parquet(path)


def test_kpi_store_refuses_a_bad_batch(spark, tmp_path):
    from kpipulse.operators.kpi_store import KpiStore

    store = KpiStore(spark, str(tmp_path / "kpi"))
    store.commit(spark.createDataFrame([(t(1), "a", 1.0)], TS), 1, 0)
    for bad in ([(t(2), "a", 1.0), (t(2), "a", 2.0)], [(t(2), "a", None)], [(t(2), None, 1.0)]):
        with pytest.raises(T.ConstraintError):
            store.commit(spark.createDataFrame(bad, TS), 1, 1)
        assert rows(store.read(), "window_start", "metric", "value") == [(t(1), "a", 1.0)]
    assert store.commit(spark.createDataFrame([(t(2), "a", 3.0)], TS), 1, 1) and store.read().count() == 2


def test_rollup_reads_no_events(spark):
    from kpipulse.operators import kpis as K

    wide = P.materialize(P.gold_wide(spark, SF001, "1 minute"))
    up = K.unpivot_kpis(K.rollup_kpis(wide, "1 hour"))
    r = lambda df: sorted((x.window_start, x.metric, round(x.value, 6)) for x in df.collect())
    assert r(up) == r(P.gold(spark, SF001, "1 hour"))
    plan = up._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan and "partial_sum" in plan
