"""Detector: EWMA baseline + rolling z-score of residuals, severity, cooldown.

Semantics of one poll ``u`` (the newest window the poll sees):

* history: loaded metrics in ``[u - lookback, u]``; at least ``rolling + 2``
  distinct windows ("wide rows") are needed;
* the scored window ``t`` is the second newest (``u`` may still be filling);
* per metric: its points in ``[u - lookback, t]`` (nulls dropped), at least
  ``rolling + 2`` of them, the last one at ``t``; rate metrics need enough
  clicks / carts at ``t``;
* baseline ``y``: unadjusted EWMA, ``y0 = x0``, ``y = (1-a) y + a x`` (kept
  as is when ``x == y``); residual ``r = x - y``;
* ``mu``/``sigma``: mean and population std of the ``rolling`` residuals
  before ``t``; ``z = (r_t - mu) / sigma``, null when sigma is zero;
* candidate when ``|z| >= warn``; ``critical`` when ``|z| >= crit``.

``score_all`` scores every closed window (each distinct window ``u`` acts as
one poll). To keep a long history of few metrics from landing in one task, rows
are bucketed by ``floor(epoch / lookback)`` and points copied into their own
and the next bucket; a frame no longer than the lookback then lies inside one
``(metric, bucket)`` partition.

The baseline is an affine prefix scan, not a fold over each row's history. Any
two solutions of the recurrence differ by a power of ``1 - a``, so with one
solution ``g`` per partition (a running sum of points scaled by their place)
the baseline that starts at point ``s`` is ``g_i + (1-a)^(i-s) (x_s - g_s)``:
each poll's new start is exact, and a row costs ``rolling + 1`` points whatever
the lookback. ``exact_zero`` divides by any sigma that is not zero to the bit,
so it keeps the recurrence itself (``fold_scores``). No Python on either way.

Cooldown (``apply_cooldown``): a warning within ``cooldown`` of the last
emitted alert of the same metric is dropped; criticals always pass; every
emitted alert resets the clock. Warnings less than ``cooldown`` after the
newest stored alert, or before it, are dropped first. The rest is cut into
chains (a new chain starts at a critical, or after a gap of at least
``cooldown`` since the previous candidate); a chain's first member is always
emitted, so chains are independent, and each is folded in order. A chain holds
at most one candidate per window and ends with the first quiet cooldown: a
whole year of unbroken one-minute warnings of one metric is half a million
small rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contract import DETAILS_METHOD, GUARD_METRICS, SEVERITY_CRITICAL, SEVERITY_WARNING, DetectorParams
from ..functions.columns import alert_id as alert_id_col


def _point() -> Column:
    return F.struct(F.col("ep").alias("ep"), F.col("x").alias("x"))


def _epoch(c: str = "window_start") -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _replicate(df: DataFrame, width_us: int) -> DataFrame:
    """Copy each row into its own bucket and the next; ``own`` marks the original."""
    b = F.floor(F.col("ep") / F.lit(width_us)).cast("long")
    return df.withColumn("_b", b).withColumn("pb", F.explode(F.array(b, b + 1))).withColumn("own", F.col("pb") == F.col("_b"))


def loaded(kpi: DataFrame, p: DetectorParams) -> DataFrame:
    """KPI rows the detector reads: its metrics plus the rate-guard metrics."""
    names = list(dict.fromkeys(list(p.metrics) + list(GUARD_METRICS)))
    return kpi.filter(F.col("metric").isin(*names) & F.col("value").isNotNull()).select(
        "window_start", "metric", F.col("value").cast("double").alias("value")
    )


def poll_frame(kpi_loaded: DataFrame, p: DetectorParams) -> DataFrame:
    """One row per distinct window ``u`` whose poll sees enough wide rows: the
    scored window ``t`` before it and the guard denominators at ``t``."""
    lb = p.lookback_s * 1_000_000
    wins = kpi_loaded.groupBy("window_start").agg(
        F.max(F.when(F.col("metric") == "events_click", F.col("value"))).alias("clicks"),
        F.max(F.when(F.col("metric") == "events_add_to_cart", F.col("value"))).alias("carts"),
    )
    wins = _replicate(wins.withColumn("ep", _epoch()), lb)
    before = Window.partitionBy("pb").orderBy("ep")
    out = wins.select(
        "ep",
        "own",
        F.lag("ep").over(before).alias("t_ep"),
        F.lag("clicks").over(before).alias("clicks_t"),
        F.lag("carts").over(before).alias("carts_t"),
        F.lag("ep", p.rolling + 1).over(before).alias("enough"),
    )
    oldest = F.col("ep") - lb
    return out.filter(F.col("own") & (F.col("t_ep") >= oldest) & (F.col("enough") >= oldest)).drop("own", "enough")


def _guard(p: DetectorParams) -> Column:
    m = F.col("metric")
    clicks_ok = F.coalesce(F.col("clicks_t") >= F.lit(p.min_denom_clicks), F.lit(False))
    carts_ok = F.coalesce(F.col("carts_t") >= F.lit(p.min_denom_add_to_cart), F.lit(False))
    return (
        F.when(m.isin("purchase_conversion", "add_to_cart_rate"), clicks_ok)
        .when(m == "checkout_rate", carts_ok)
        .otherwise(F.lit(True))
    )


def fold_scores(points: Column, p: DetectorParams) -> Column:
    """Ordered ``array<struct<ep, x>>`` -> ``struct(baseline, value, residual,
    mu, sigma, z)`` in one ``aggregate`` (merge: EWMA and the last
    ``rolling + 1`` residuals; finish: mu, sigma, z). One expression, so the
    fold runs once per row however many fields are read from it."""
    w, a = p.rolling, p.alpha
    keep = 1.0 - a

    def step(acc, pt):
        x = pt["x"]
        y = (
            F.when(acc["y"].isNull(), x)
            .when(x == acc["y"], acc["y"])
            .otherwise(F.lit(keep) * acc["y"] + F.lit(a) * x)
        )
        r = F.concat(acc["r"], F.array(x - y))
        r = F.when(F.size(r) > w + 1, F.slice(r, 2, w + 1)).otherwise(r)
        return F.struct(y.alias("y"), x.alias("x"), r.alias("r"))

    def finish(acc):
        hist = F.slice(acc["r"], 1, w)
        mu = F.aggregate(hist, F.lit(0.0), lambda s, v: s + v) / F.lit(float(w))
        ss = F.aggregate(hist, F.lit(0.0), lambda s, v: s + (v - mu) * (v - mu))
        sigma = F.sqrt(ss / F.lit(float(w)))
        res = F.element_at(acc["r"], -1)
        if p.exact_zero:
            zero = (sigma == 0.0) | F.isnan(sigma)
        else:
            zero = (sigma <= F.lit(p.sigma_eps) * F.greatest(F.lit(1.0), F.abs(acc["y"]))) | F.isnan(sigma)
        z = F.when(zero, F.lit(None).cast("double")).otherwise((res - mu) / sigma)
        return F.struct(
            acc["y"].alias("baseline"),
            acc["x"].alias("value"),
            res.alias("residual"),
            mu.alias("mu"),
            sigma.alias("sigma"),
            z.alias("z"),
        )

    init = F.struct(
        F.lit(None).cast("double").alias("y"),
        F.lit(None).cast("double").alias("x"),
        F.array().cast("array<double>").alias("r"),
    )
    return F.aggregate(points, init, step, finish)


_SCORE_FIELDS = ("value", "baseline", "residual", "mu", "sigma", "z")


def _z_scores(residuals: Column, baseline: Column, p: DetectorParams) -> list[Column]:
    """``mu, sigma, z`` from the last ``rolling + 1`` residuals."""
    hist = F.slice(residuals, 1, p.rolling)
    w = F.lit(float(p.rolling))
    mu = F.aggregate(hist, F.lit(0.0), lambda s, v: s + v) / w
    sigma = F.sqrt(F.aggregate(hist, F.lit(0.0), lambda s, v: s + (v - mu) * (v - mu)) / w)
    zero = (F.col("sigma") <= F.lit(p.sigma_eps) * F.greatest(F.lit(1.0), F.abs(baseline))) | F.isnan("sigma")
    z = F.when(zero, F.lit(None).cast("double")).otherwise((F.element_at(residuals, -1) - F.col("mu")) / F.col("sigma"))
    return [mu, sigma, z]


SCALE = 340.0  # exp(-SCALE) vanishes beside any double that it is added to


def _scan(points: DataFrame, p: DetectorParams) -> DataFrame:
    """Points with their place ``n`` in ``(metric, pb, kind)`` and ``g``, a
    solution of the recurrence over the partition.

    Within a block of places, ``g`` is a running sum of points scaled by
    ``(1-a)^-j``; blocks are as long as the scale stays in range. What the
    block before adds to the next one is its end; what lies before that is
    scaled by less than ``exp(-SCALE)``."""
    keep = 1.0 - p.alpha
    if keep <= 0.0:
        return points.withColumn("n", F.row_number().over(Window.partitionBy("metric", "pb", "kind").orderBy("ep"))).withColumn("g", F.col("x"))
    size = (1 << 31) - 1 if keep >= 1.0 else max(1, int(SCALE / -math.log(keep)))
    parts = Window.partitionBy("metric", "pb", "kind").orderBy("ep")
    power = lambda e: F.pow(F.lit(keep), e)
    placed = points.withColumn("n", F.row_number().over(parts)).withColumn("j", (F.col("n") - 1) % size).withColumn("block", F.floor((F.col("n") - 1) / size))
    within = Window.partitionBy("metric", "pb", "kind", "block").orderBy("ep").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("l", power(F.col("j")) * F.sum(F.lit(p.alpha) * F.col("x") * power(-F.col("j"))).over(within))
    ends = F.last(F.when(F.col("j") == size - 1, F.col("l")), ignorenulls=True).over(parts.rowsBetween(Window.unboundedPreceding, -1))
    return local.withColumn("g", F.col("l") + power(F.col("j") + 1) * F.coalesce(ends, F.lit(0.0))).drop("j", "block", "l")


def score_all(kpi: DataFrame, p: DetectorParams = DetectorParams(), polls: DataFrame | None = None) -> DataFrame:
    """Scores of every closed window per detector metric.

    Output: ``metric, window_start (scored t), value, baseline, residual, mu,
    sigma, z, n_points, clicks_t, carts_t, poll_window (u)`` for every (metric, t) that passes
    the history, presence and rate gates; ``z`` is null when sigma is zero.

    ``polls`` (a frame with ``poll_window``) restricts scoring to those polls:
    the other markers are dropped before the windows.
    """
    lb = p.lookback_s * 1_000_000
    src = loaded(kpi, p)
    frame_polls = poll_frame(src, p)
    if polls is not None:
        wanted = polls.select(F.unix_micros(F.col("poll_window").cast("timestamp")).alias("ep")).distinct()
        frame_polls = frame_polls.join(wanted, "ep", "left_semi")
    markers = frame_polls.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in p.metrics]))).filter(_guard(p))
    pts = src.filter(F.col("metric").isin(*p.metrics)).select("metric", _epoch().alias("ep"), F.col("value").alias("x"))
    score = _score_by_fold if p.exact_zero else _score_by_scan
    return score(pts, markers, lb, p).select(
        "metric",
        F.timestamp_micros(F.col("t_ep")).alias("window_start"),
        *_SCORE_FIELDS,
        F.col("n_points").cast("long").alias("n_points"),
        "clicks_t",
        "carts_t",
        F.timestamp_micros(F.col("u_ep")).alias("poll_window"),
    )


def _score_by_scan(pts: DataFrame, markers: DataFrame, lb: int, p: DetectorParams) -> DataFrame:
    """One shuffle by ``(metric, bucket)``. A poll is a row at its history's
    start, in the bucket of its newest window: the nearest point from there on
    starts the baseline, and the point at ``t`` brings the last residuals."""
    keep = 1.0 - p.alpha
    points = _replicate(pts, lb).select("metric", "pb", "ep", "x", F.lit(1).alias("kind"))
    starts = markers.select(
        "metric",
        F.floor(F.col("ep") / lb).cast("long").alias("pb"),
        (F.col("ep") - lb).alias("ep"),
        F.lit(0).alias("kind"),
        F.col("ep").alias("u_ep"),
        "t_ep",
        "clicks_t",
        "carts_t",
    )
    rows = _scan(points.unionByName(starts, allowMissingColumns=True), p)
    point = F.struct("n", "x", "g")
    is_point = F.col("kind") == 1
    last_ones = Window.partitionBy("metric", "pb", "kind").orderBy("ep").rowsBetween(-p.rolling, 0)
    rows = rows.withColumn("last", F.when(is_point, F.collect_list(point).over(last_ones)))
    from_here = Window.partitionBy("metric", "pb").orderBy(F.desc("ep"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("s", F.last(F.when(is_point, point), ignorenulls=True).over(from_here))
    at_t = Window.partitionBy("metric", "pb", "meet").orderBy("kind").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("meet", F.when(is_point, F.col("ep")).otherwise(F.col("t_ep")))
    rows = rows.withColumn("hist", F.last("last", ignorenulls=True).over(at_t))
    scored = rows.filter(~is_point & F.col("hist").isNotNull() & F.col("s").isNotNull()).select(
        "metric", "u_ep", "t_ep", "clicks_t", "carts_t", "s", "hist", (F.element_at("hist", -1)["n"] - F.col("s.n") + 1).alias("n_points")
    )
    scored = scored.filter(F.col("n_points") >= p.rolling + 2)
    first = F.col("s.x") - F.col("s.g")
    baseline = lambda h: h["g"] + F.pow(F.lit(keep), h["n"] - F.col("s.n")) * first
    out = scored.withColumn("r", F.transform("hist", lambda h: h["x"] - baseline(h)))
    newest = F.element_at("hist", -1)
    out = out.select("*", newest["x"].alias("value"), baseline(newest).alias("baseline"), F.element_at("r", -1).alias("residual"))
    for name, column in zip(("mu", "sigma", "z"), _z_scores(F.col("r"), F.col("baseline"), p)):
        out = out.withColumn(name, column)
    return out


def _score_by_fold(pts: DataFrame, markers: DataFrame, lb: int, p: DetectorParams) -> DataFrame:
    """The recurrence itself, folded over each poll's history."""
    rows = _replicate(
        pts.withColumn("kind", F.lit(0)).unionByName(markers.withColumn("kind", F.lit(1)), allowMissingColumns=True), lb
    )
    frame = Window.partitionBy("metric", "pb").orderBy("ep").rangeBetween(-lb, -1)
    rows = rows.withColumn("pts", F.collect_list(F.when(F.col("kind") == 0, _point())).over(frame))
    scored = rows.filter((F.col("kind") == 1) & F.col("own")).select(
        "metric", F.col("ep").alias("u_ep"), "t_ep", "clicks_t", "carts_t", F.array_sort("pts").alias("pts")
    )
    enough = (F.size("pts") >= p.rolling + 2) & (F.element_at(F.col("pts"), -1)["ep"] == F.col("t_ep"))
    scored = scored.filter(enough).withColumn("n_points", F.size("pts")).withColumn("_s", fold_scores(F.col("pts"), p))
    return scored.select("*", *[F.col(f"_s.{c}").alias(c) for c in _SCORE_FIELDS])


def score_as_of(kpi: DataFrame, as_of, p: DetectorParams = DetectorParams()) -> DataFrame:
    """One poll at wall-clock ``as_of`` (a timestamp literal or Column).

    Loads ``[end - lookback, end]`` with ``end = as_of - ignore_recent`` and
    scores the second-newest window in it. Same frames as ``score_all`` over
    the range-filtered history (the filter reaches the scan); the poll is the
    one whose newest window is the newest in range.
    """
    as_of = F.lit(as_of) if not isinstance(as_of, Column) else as_of
    end = as_of.cast("timestamp") - F.make_interval(secs=F.lit(float(p.ignore_recent_s)))
    start = end - F.make_interval(secs=F.lit(float(p.lookback_s)))
    src = loaded(kpi, p).filter((F.col("window_start") >= start) & (F.col("window_start") <= end))
    # this poll's newest window; only its marker rows are scored
    newest = src.agg(F.max("window_start").alias("poll_window"))
    return score_all(src, p, polls=newest)


def candidates(scores: DataFrame, p: DetectorParams = DetectorParams()) -> DataFrame:
    """Scores with ``|z| >= warn`` and their severity."""
    absz = F.abs(F.col("z"))
    return scores.filter(absz >= F.lit(p.warn_z)).withColumn(
        "severity",
        F.when(absz >= F.lit(p.crit_z), F.lit(SEVERITY_CRITICAL)).otherwise(F.lit(SEVERITY_WARNING)),
    )


def last_alert_per_metric(alerts: DataFrame, rule_name: str | None = None) -> DataFrame:
    """Newest alerted window per metric (for one rule when given)."""
    src = alerts if rule_name is None else alerts.filter(F.col("rule_name") == F.lit(rule_name))
    return src.groupBy("metric").agg(F.max("window_start").alias("last_window_start"))


SUPER = 4096


def _chains(cands: DataFrame, p: DetectorParams) -> DataFrame:
    """Candidates with their chain id.

    A chain starts at a critical, or a candidate with no other within the
    cooldown before it; its id is the start's epoch, found as a prefix max
    inside cooldown-wide buckets, carried across buckets by a prefix max over
    one summary row per (metric, bucket).
    """
    c_us = p.cooldown_s * 1_000_000
    base = cands.select("metric", _epoch().alias("ep"), "severity", F.struct(*cands.columns).alias("row"))
    rep = _replicate(base, c_us)
    w_prev = Window.partitionBy("metric", "pb").orderBy("ep").rangeBetween(-c_us, -1)
    starts = (
        rep.withColumn("prev_ep", F.max("ep").over(w_prev))
        .filter("own")
        .withColumn("is_start", (F.col("severity") == SEVERITY_CRITICAL) | F.col("prev_ep").isNull())
        .select("metric", "ep", "severity", "row", "is_start", F.col("_b").alias("bk"))
    )
    w_in = Window.partitionBy("metric", "bk").orderBy("ep").rowsBetween(Window.unboundedPreceding, 0)
    local = starts.withColumn("local_start", F.max(F.when(F.col("is_start"), F.col("ep"))).over(w_in))
    summ = starts.groupBy("metric", "bk").agg(F.max(F.when(F.col("is_start"), F.col("ep"))).alias("bk_start"))
    # carry = latest start in any earlier bucket: a prefix max inside groups
    # of SUPER buckets, then over one row per group, so no window holds more
    # than SUPER rows or span / (cooldown * SUPER) rows
    summ = summ.withColumn("sb", F.floor(F.col("bk") / F.lit(SUPER)).cast("long"))
    w_sb = Window.partitionBy("metric", "sb").orderBy("bk").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("carry_in", F.max("bk_start").over(w_sb))
    sup = summ.groupBy("metric", "sb").agg(F.max("bk_start").alias("sb_start"))
    w_s = Window.partitionBy("metric").orderBy("sb").rowsBetween(Window.unboundedPreceding, -1)
    sup = sup.withColumn("sb_carry", F.max("sb_start").over(w_s)).select("metric", "sb", "sb_carry")
    summ = summ.join(sup, ["metric", "sb"]).select("metric", "bk", F.coalesce("carry_in", "sb_carry").alias("carry"))
    chained = local.join(summ, ["metric", "bk"])
    return chained.select("metric", "ep", "severity", "row", F.coalesce("local_start", "carry").alias("chain"))


def _fold_chains(chained: DataFrame, c_us: int, row_type: str) -> DataFrame:
    """Emitted rows: each chain folded in time order."""
    grouped = chained.groupBy("metric", "chain").agg(
        F.array_sort(F.collect_list(F.struct("ep", "severity", "row"))).alias("items")
    )

    def step(acc, it):
        emit = (it["severity"] == SEVERITY_CRITICAL) | acc["last"].isNull() | (it["ep"] - acc["last"] >= F.lit(c_us))
        last = F.when(emit, it["ep"]).otherwise(acc["last"])
        out = F.when(emit, F.concat(acc["out"], F.array(it["row"]))).otherwise(acc["out"])
        return F.struct(last.alias("last"), out.alias("out"))

    init = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast(f"array<{row_type}>").alias("out"))
    return grouped.select(F.explode(F.aggregate("items", init, step)["out"]).alias("r"))


def apply_cooldown(cands: DataFrame, p: DetectorParams = DetectorParams(), seeds: DataFrame | None = None) -> DataFrame:
    """Keep the candidates an in-order walk with cooldown would emit.

    ``seeds`` (``metric, last_window_start``), e.g. from
    ``last_alert_per_metric``, are the newest stored alerts: a warning passes
    only a cooldown or more after its metric's seed. One plan for every size;
    each candidate row travels as a struct, so no join back is needed.
    """
    c_us = p.cooldown_s * 1_000_000
    if c_us <= 0:
        return cands
    cols = cands.columns
    if seeds is not None:
        newest = seeds.select("metric", F.unix_micros(F.col("last_window_start").cast("timestamp")).alias("_seed"))
        late = F.coalesce(_epoch() - F.col("_seed") >= F.lit(c_us), F.lit(True))
        cands = cands.join(newest, "metric", "left").filter((F.col("severity") == SEVERITY_CRITICAL) | late).select(*cols)
    row_type = cands.select(F.struct(*cols).alias("row")).schema["row"].dataType.simpleString()
    kept = _fold_chains(_chains(cands, p), c_us, row_type)
    return kept.select(*[F.col(f"r.{c}").alias(c) for c in cols])


def _minutes(seconds: int) -> Column:
    """Minutes for the details: a whole number where there is one."""
    return F.lit(seconds // 60) if seconds % 60 == 0 else F.lit(seconds / 60.0)


def alerts_from(kept: DataFrame, p: DetectorParams = DetectorParams()) -> DataFrame:
    """Alert rows: id, created_at, window, metric, value, baseline, score,
    severity, rule, details JSON (method, parameters, mu, sigma)."""
    details = F.to_json(
        F.struct(
            F.lit(DETAILS_METHOD).alias("method"),
            F.lit(p.alpha).alias("ewma_alpha"),
            F.lit(p.rolling).alias("rolling_window"),
            F.lit(p.warn_z).alias("warn_z"),
            F.lit(p.crit_z).alias("crit_z"),
            F.col("mu").alias("mu"),
            F.col("sigma").alias("sigma"),
            _minutes(p.ignore_recent_s).alias("ignore_recent_minutes"),
            _minutes(p.cooldown_s).alias("cooldown_minutes"),
        )
    )
    return kept.select(
        alert_id_col(p.rule_name, "metric", "window_start").alias("alert_id"),
        F.current_timestamp().alias("created_at"),
        "window_start",
        "metric",
        "value",
        "baseline",
        F.col("z").alias("score"),
        "severity",
        F.lit(p.rule_name).alias("rule_name"),
        details.alias("details"),
    )


def detect(kpi: DataFrame, p: DetectorParams = DetectorParams(), existing_alerts: DataFrame | None = None) -> DataFrame:
    """KPI table -> new alert rows for every closed window (score_all ->
    threshold -> cooldown seeded from existing alerts -> assembly)."""
    seeds = None if existing_alerts is None else last_alert_per_metric(existing_alerts, p.rule_name)
    return alerts_from(apply_cooldown(candidates(score_all(kpi, p), p), p, seeds), p)
