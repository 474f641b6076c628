"""The detector by its definitions, one scored point at a time (tests only).

For each poll ``u`` and metric the definition is evaluated directly on sorted
``(time, value)`` points: the baseline by its recurrence, mu and sigma by
sums over the residuals before the scored point, the gates as conditions.
The cooldown asks, for each candidate in time order, whether the stated rule
lets it pass. Small inputs only.
"""

from __future__ import annotations

import math

import pandas as pd

CLICKS, CARTS = "events_click", "events_add_to_cart"
NEEDS = {"purchase_conversion": CLICKS, "add_to_cart_rate": CLICKS, "checkout_rate": CARTS}


def _points(kpi, p):
    """``{metric: {time: value}}`` of the metrics the detector loads."""
    out = {m: {} for m in (*p.metrics, CLICKS, CARTS, "events_checkout")}
    for when, metric, value in zip(kpi["window_start"], kpi["metric"], kpi["value"]):
        if metric in out and not pd.isna(value):
            out[metric][pd.Timestamp(when)] = float(value)
    return out


def _score(xs, p):
    """baseline, residual, mu, sigma, z of the last of the values ``xs``."""
    y, residuals = xs[0], []
    for k, x in enumerate(xs):
        if k:
            y = y + p.alpha * (x - y)
        residuals.append(x - y)
    past = residuals[-1 - p.rolling : -1]
    mu = sum(past) / p.rolling
    sigma = math.sqrt(sum((r - mu) ** 2 for r in past) / p.rolling)
    tiny = 0.0 if p.exact_zero else p.sigma_eps * max(1.0, abs(y))
    return y, mu, sigma, None if sigma <= tiny else (residuals[-1] - mu) / sigma


def simulate(kpi, p, polls=None):
    """Scores of every poll: metric, window_start, value, baseline, mu, sigma, z."""
    points = _points(kpi, p)
    times = sorted({t for series in points.values() for t in series})
    span = pd.Timedelta(seconds=p.lookback_s)
    enough = p.rolling + 2
    rows = []
    for u in map(pd.Timestamp, times if polls is None else polls):
        seen = [t for t in times if u - span <= t <= u]
        if len(seen) < enough or seen[-1] != u:
            continue
        scored = seen[-2]
        for metric in p.metrics:
            series = [(t, points[metric][t]) for t in seen[:-1] if t in points[metric]]
            if len(series) < enough or series[-1][0] != scored:
                continue
            if metric in NEEDS:
                floor = p.min_denom_clicks if NEEDS[metric] == CLICKS else p.min_denom_add_to_cart
                if points[NEEDS[metric]].get(scored, -1.0) < floor:
                    continue
            baseline, mu, sigma, z = _score([x for _, x in series], p)
            rows.append((metric, scored, series[-1][1], baseline, mu, sigma, z))
    return pd.DataFrame(rows, columns=["metric", "window_start", "value", "baseline", "mu", "sigma", "z"])


def cooldown_loop(cands, p, seeds=None):
    """Candidates that pass: every critical, and a warning if the clock of its
    metric (last alert emitted, at first the stored one) is a cooldown old."""
    wait = pd.Timedelta(seconds=p.cooldown_s)
    emitted = []
    for metric, rows in cands.groupby("metric"):
        stored = (seeds or {}).get(metric)
        clock = stored
        for row in rows.sort_values("window_start").itertuples(index=False):
            at = pd.Timestamp(row.window_start)
            quiet = all(c is None or at - c >= wait for c in (clock, stored))
            if row.severity == "critical" or quiet:
                emitted.append(row)
                clock = at
    return pd.DataFrame(emitted, columns=list(cands.columns))
