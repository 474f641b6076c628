"""Detector (W1-W12, F6, F7) against its definitions evaluated point by point."""

from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from core_helpers import SF01
from detector_oracle import cooldown_loop, simulate
from kpipulse.contract import DetectorParams
from kpipulse.operators import detect as D
from kpipulse.plans import pipeline as P

P_HOUR = DetectorParams(lookback_s=120 * 3600, rolling=5, alpha=0.2, cooldown_s=6 * 3600, ignore_recent_s=0)


@pytest.fixture(scope="module")
def kpi(spark):
    return P.materialize(P.gold(spark, SF01, "1 hour"))


@pytest.fixture(scope="module")
def kpi_pd(kpi):
    pdf = kpi.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "value").toPandas()
    return pdf


def spark_scores(kpi, p):
    s = D.score_all(kpi, p).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "value", "baseline", "mu", "sigma", "z"
    )
    return s.toPandas().sort_values(["metric", "window_start"]).reset_index(drop=True)


def merged(a, b):
    a = a.sort_values(["metric", "window_start"]).reset_index(drop=True)
    b = b.sort_values(["metric", "window_start"]).reset_index(drop=True)
    assert len(a) == len(b)
    assert (a.metric.values == b.metric.values).all()
    assert (pd.to_datetime(a.window_start).values == pd.to_datetime(b.window_start).values).all()
    return a, b


def max_diff(a, b, col):
    x, y = a[col].astype(float), b[col].astype(float)
    both = x.notna() & y.notna()
    assert (x.isna() == y.isna()).all(), col
    return float((x[both] - y[both]).abs().max())


def test_scores_match_poll_loop(kpi, kpi_pd):
    got = spark_scores(kpi, P_HOUR)
    want = simulate(kpi_pd, P_HOUR)
    a, b = merged(got, want)
    for col in ("value", "baseline", "mu", "sigma", "z"):
        assert max_diff(a, b, col) < 1e-9, col


def test_rate_guard_and_rates(kpi, kpi_pd):
    p = replace(P_HOUR, metrics=("purchase_conversion", "add_to_cart_rate", "checkout_rate"), min_denom_clicks=3, min_denom_add_to_cart=3)
    a, b = merged(spark_scores(kpi, p), simulate(kpi_pd, p))
    assert max_diff(a, b, "z") < 1e-9
    # default denominators (50 / 30) never pass on this sparse data
    assert D.score_all(kpi, replace(p, min_denom_clicks=50, min_denom_add_to_cart=30)).count() == 0


@pytest.mark.parametrize(
    "control",
    [dict(alpha=0.21), dict(rolling=6)],
)
def test_negative_controls_move_the_result(kpi, kpi_pd, control):
    base = spark_scores(kpi, P_HOUR)
    other = simulate(kpi_pd, replace(P_HOUR, **control))
    m = base.merge(other, on=["metric", "window_start"], suffixes=("", "_o"))
    assert len(m) > 0
    assert (m.z - m.z_o).abs().max() > 1e-3


def test_cooldown_matches_loop(kpi):
    c = D.candidates(D.score_all(kpi, P_HOUR), P_HOUR)
    cands = c.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "severity").toPandas()
    assert len(cands) > 20
    kept = D.apply_cooldown(c, P_HOUR).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric").toPandas()
    want = cooldown_loop(cands, P_HOUR)
    assert sorted(map(tuple, kept[["metric", "window_start"]].astype(str).values)) == sorted(
        map(tuple, want[["metric", "window_start"]].astype(str).values)
    )
    assert len(kept) < len(cands)


WHERE = {
    "before": lambda t: t.min() - pd.Timedelta(hours=1),
    "between": lambda t: t.sort_values().iloc[len(t) // 2] + pd.Timedelta(hours=1),
    "at": lambda t: t.sort_values().iloc[len(t) // 2],
    "after": lambda t: t.max() + pd.Timedelta(hours=1),
}


@pytest.mark.parametrize("where", list(WHERE))
def test_cooldown_seeded(spark, kpi, where):
    c = D.candidates(D.score_all(kpi, P_HOUR), P_HOUR)
    cands = c.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "severity").toPandas()
    seeds = {m: WHERE[where](pd.to_datetime(g.window_start)) for m, g in cands.groupby("metric")}
    seed_df = spark.createDataFrame(
        [(m, t.to_pydatetime()) for m, t in seeds.items()], "metric string, last_window_start timestamp_ntz"
    )
    kept = D.apply_cooldown(c, P_HOUR, seed_df).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric").toPandas()
    want = cooldown_loop(cands, P_HOUR, seeds)
    assert sorted(map(tuple, kept[["metric", "window_start"]].astype(str).values)) == sorted(
        map(tuple, want[["metric", "window_start"]].astype(str).values)
    )


def test_stored_alerts_suppress_an_old_warning(spark):
    """Stored alerts at 10:00 and 10:30 and a warning for 10:05: dropped; so
    is one at 10:35, and one at 10:40 passes; criticals always pass."""
    import datetime as dt

    t = lambda m: dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=m)
    p = replace(P_HOUR, cooldown_s=600)
    stored = spark.createDataFrame([(t(0), "revenue", "r"), (t(30), "revenue", "r")], "window_start timestamp, metric string, rule_name string")
    rows = [(t(5), "warning"), (t(6), "critical"), (t(35), "warning"), (t(40), "warning"), (t(45), "warning"), (t(46), "critical")]
    cands = spark.createDataFrame([(w, "revenue", s) for w, s in rows], "window_start timestamp, metric string, severity string")
    kept = D.apply_cooldown(cands, p, D.last_alert_per_metric(stored))
    assert sorted(r.window_start for r in kept.collect()) == [t(6), t(40), t(46)]


@pytest.mark.parametrize("ignore_s", [0, 3600])
def test_score_as_of_is_one_poll(kpi, kpi_pd, ignore_s):
    p = replace(P_HOUR, ignore_recent_s=ignore_s)
    as_of = pd.Timestamp("2024-01-20 12:30:00")
    got = D.score_as_of(kpi, F.lit(str(as_of)).cast("timestamp"), p).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "z"
    ).toPandas()
    # reference poll: data in [end - lookback, end], end = as_of - ignore; the
    # newest window there is the poll
    end = as_of - pd.Timedelta(seconds=ignore_s)
    ws = pd.to_datetime(kpi_pd.window_start)
    sub = kpi_pd[(ws >= end - pd.Timedelta(hours=120)) & (ws <= end)]
    u = pd.to_datetime(sub.window_start).max()
    want = simulate(sub, p, polls=[u])
    a, b = merged(got, want[["window_start", "metric", "z"]])
    assert len(a) > 0
    assert max_diff(a, b, "z") < 1e-9


def test_alerts_assembly(kpi):
    a = D.detect(kpi, P_HOUR).cache()
    rows = a.collect()
    assert rows
    r = rows[0]
    assert r.alert_id == f"ewma_zscore_v1:{r.metric}:{r.window_start.strftime('%Y-%m-%dT%H:%M:%S')}"
    import json

    d = json.loads(r.details)
    assert d["method"] == "ewma+zscore(residual)" and d["rolling_window"] == 5
    assert '"ignore_recent_minutes":0,"cooldown_minutes":360}' in r.details
    assert a.groupBy("alert_id").count().filter("count > 1").count() == 0
    assert {x.severity for x in rows} <= {"warning", "critical"}


def test_cooldown_long_chains_match_loop(spark, kpi):
    # a low warn threshold gives long chains
    p = replace(P_HOUR, warn_z=1.0, cooldown_s=12 * 3600)
    c = D.candidates(D.score_all(kpi, p), p)
    cands = c.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "severity").toPandas()
    kept = D.apply_cooldown(c, p).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric").toPandas()
    want = cooldown_loop(cands, p)
    assert sorted(map(tuple, kept[["metric", "window_start"]].astype(str).values)) == sorted(
        map(tuple, want[["metric", "window_start"]].astype(str).values)
    )


def test_cooldown_carry_across_super_buckets(kpi, monkeypatch):
    # tiny super-buckets: the chain-start carry crosses both levels
    monkeypatch.setattr(D, "SUPER", 2)
    p = replace(P_HOUR, warn_z=1.0, cooldown_s=3 * 3600)
    c = D.candidates(D.score_all(kpi, p), p)
    cands = c.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "severity").toPandas()
    kept = D.apply_cooldown(c, p).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric"
    ).toPandas()
    want = cooldown_loop(cands, p)
    assert sorted(map(tuple, kept[["metric", "window_start"]].astype(str).values)) == sorted(
        map(tuple, want[["metric", "window_start"]].astype(str).values)
    )


@pytest.mark.parametrize("alpha", [0.02, 0.2, 0.97, 1.0])
def test_scan_equals_the_fold(spark, alpha):
    """The affine scan against the recurrence folded over each history: gaps,
    missing points, jumps of scale, histories over many scan blocks."""
    import datetime as dt
    import random

    rng = random.Random(int(alpha * 100))
    rows = []
    for m in ("revenue", "events_total", "events_click", "events_add_to_cart"):
        for k in range(700):
            if rng.random() < 0.85 and not 300 < k < 330:
                scale = 1e9 if 100 < k < 110 else 1.0
                value = 5.0 if m == "events_total" and k < 90 else rng.random() * scale
                rows.append((dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k), m, value))
    kpi = spark.createDataFrame(rows, "window_start timestamp, metric string, value double")
    p = DetectorParams(metrics=("revenue", "events_total"), lookback_s=180 * 60, rolling=7, alpha=alpha, ignore_recent_s=0)
    src, lb = D.loaded(kpi, p), p.lookback_s * 1_000_000
    markers = D.poll_frame(src, p).withColumn("metric", F.explode(F.array(*[F.lit(m) for m in p.metrics])))
    pts = src.filter(F.col("metric").isin(*p.metrics)).select("metric", D._epoch().alias("ep"), F.col("value").alias("x"))
    cols = ["metric", "t_ep", "u_ep", "n_points", "value", "baseline", "residual", "mu", "sigma", "z"]
    a, b = (f(pts, markers, lb, p).select(*cols).toPandas().sort_values(cols[:2]).reset_index(drop=True) for f in (D._score_by_scan, D._score_by_fold))
    assert len(a) == len(b) > 800 and (a[cols[:4]] == b[cols[:4]]).all().all()
    for col in cols[4:]:
        x, y = a[col], b[col]
        assert (x.isna() == y.isna()).all(), col
        # to 1e-9 of the largest value in the history (z: before division)
        big = b["value"].abs().rolling(200, min_periods=1).max().clip(lower=1.0)
        off = (x - y).abs() * (b["sigma"] if col == "z" else 1.0)
        assert (off.fillna(0) <= 1e-9 * big).all(), col
    assert a["z"].isna().sum() > 0 or alpha == 1.0


def test_rows_carry_few_points(kpi):
    """What a row carries does not follow the lookback: no history is
    collected, only the last residuals."""
    wide = replace(P_HOUR, lookback_s=20 * P_HOUR.lookback_s)
    for p in (P_HOUR, wide):
        plan = D.score_all(kpi, p)._jdf.queryExecution().executedPlan().toString()
        assert "RangeFrame" not in plan and "collect_list" in plan
        assert f"specifiedwindowframe(RowFrame, -{p.rolling}, currentrow$())" in plan
