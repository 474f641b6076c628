"""Serving reads over the KPI and alert tables.

Every read is a DataFrame -> DataFrame function with its bounds as arguments
(no wall clock inside). Range predicates are plain column comparisons, so
they reach the parquet scan as pushed filters; when the table carries a
``window_date`` partition column a derived date predicate prunes partitions.
Limits are top-k reads (``orderBy().limit()`` plans as
``TakeOrderedAndProject``: per-task top-k, then a merge of k rows per task).

Reads of the newest rows go backwards through the date partitions: the newest
date first, then four times as many, until they hold what is asked for
(``newest_days``); older dates' files are not opened. Rows are ordered by time
first, so the result is that of the whole table.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_of

DEFAULT_LATEST = ("revenue", "events_purchase", "purchase_conversion", "events_total")


def parse_bound(s: str | datetime | None) -> datetime | None:
    """ISO text (``Z``, offset or none) -> naive UTC datetime. Zone-less text
    is taken as UTC."""
    if s is None or isinstance(s, datetime):
        if isinstance(s, datetime) and s.tzinfo is not None:
            return s.astimezone(timezone.utc).replace(tzinfo=None)
        return s
    txt = s.strip()
    if txt.endswith("Z"):
        txt = txt[:-1] + "+00:00"
    dt = datetime.fromisoformat(txt)
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc).replace(tzinfo=None)
    return dt


def _lit_ts(dt: datetime) -> Column:
    return F.lit(dt.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def _range(df: DataFrame, lo: datetime, hi: datetime, col: str = "window_start") -> list[Column]:
    preds = [F.col(col) >= _lit_ts(lo), F.col(col) <= _lit_ts(hi)]
    if "window_date" in df.columns:
        preds += [F.col("window_date") >= F.lit(lo.date()), F.col("window_date") <= F.lit(hi.date())]
    return preds


def kpi_series(
    kpi: DataFrame,
    metric: str,
    to_ts=None,
    from_ts=None,
    limit: int = 500,
    default_minutes: int = 60,
    as_of=None,
) -> DataFrame:
    """Points of one metric in ``[from, to]``, oldest first, at most ``limit``
    (the oldest ``limit`` points are kept). ``to`` defaults to ``as_of``;
    ``from`` to ``to - default_minutes``."""
    hi = parse_bound(to_ts) or parse_bound(as_of)
    if hi is None:
        raise ValueError("kpi_series needs to_ts or as_of")
    lo = parse_bound(from_ts) or hi - timedelta(minutes=default_minutes)
    preds = [F.col("metric") == F.lit(metric)] + _range(kpi, lo, hi)
    return kpi.filter(all_of(preds)).select("window_start", "value").orderBy("window_start").limit(limit)


def kpi_history(kpi: DataFrame, metrics, lo, hi) -> DataFrame:
    """Detector history read: listed metrics, inclusive range, ascending."""
    lo, hi = parse_bound(lo), parse_bound(hi)
    preds = [F.col("metric").isin(*metrics)] + _range(kpi, lo, hi)
    return kpi.filter(all_of(preds)).select("window_start", "metric", "value").orderBy("window_start")


def partition_days(df: DataFrame) -> list[str]:
    """The ``window_date`` partitions that a stored table's files lie in, newest
    first (from the file listing; no job)."""
    if "window_date" not in df.columns:
        return []
    found = (re.search(r"/window_date=(\d{4}-\d\d-\d\d)/", f) for f in df.inputFiles())
    return sorted({m[1] for m in found if m}, reverse=True)


def newest_days(df: DataFrame, enough: Callable[[DataFrame], bool]) -> DataFrame:
    """``df`` from the latest date on whose rows, with all newer ones, are
    ``enough``: one date is tried, then four, sixteen and so on. The whole of
    ``df`` where it is not partitioned by date or no dates are enough."""
    days = partition_days(df)
    take = 1
    while take < len(days):
        part = df.filter(F.col("window_date") >= F.lit(days[take - 1]).cast("date"))
        if enough(part):
            return part
        take *= 4
    return df


def _holds(rows: int) -> Callable[[DataFrame], bool]:
    return lambda part: part.limit(rows).count() == rows


def kpi_latest(kpi: DataFrame, metrics=DEFAULT_LATEST) -> DataFrame:
    """Latest point of each requested metric; null ``window_start``/``value``
    for a metric with no rows. One aggregate for all metrics (partial
    ``max_by`` per task, then one row per metric) over the newest dates that
    hold them all, broadcast onto the request list; both sides are
    argument-sized."""
    metrics = list(dict.fromkeys(m.strip() for m in metrics if m and m.strip()))
    if not metrics:
        raise ValueError("metrics is empty")
    asked = kpi.filter(F.col("metric").isin(*metrics))
    recent = newest_days(asked, lambda part: part.select("metric").distinct().count() == len(metrics))
    latest = recent.groupBy("metric").agg(
        F.max("window_start").alias("window_start"),
        F.max_by("value", "window_start").alias("value"),
    )
    wanted = kpi.sparkSession.range(1).select(F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric"))
    # the aggregate has at most one row per requested metric: broadcast it
    return wanted.join(F.broadcast(latest), "metric", "left").select("metric", "window_start", "value")


def alerts_query(
    alerts: DataFrame,
    to_ts=None,
    from_ts=None,
    metric: str | None = None,
    severity: str | None = None,
    limit: int = 200,
    default_minutes: int = 180,
    as_of=None,
) -> DataFrame:
    """Alerts in ``[from, to]`` with optional metric / severity, newest first
    (ties broken by metric, alert id so the cut is stable)."""
    hi = parse_bound(to_ts) or parse_bound(as_of)
    if hi is None:
        raise ValueError("alerts_query needs to_ts or as_of")
    lo = parse_bound(from_ts) or hi - timedelta(minutes=default_minutes)
    preds = _range(alerts, lo, hi)
    if metric:
        preds.append(F.col("metric") == F.lit(metric))
    if severity and severity != "all":
        preds.append(F.col("severity") == F.lit(severity))
    return alerts.filter(all_of(preds)).orderBy(F.desc("window_start"), "metric", "alert_id").limit(limit)


def alerts_latest(alerts: DataFrame, limit: int = 50) -> DataFrame:
    recent = newest_days(alerts, _holds(limit))
    return recent.orderBy(F.desc("window_start"), "metric", "alert_id").limit(limit)


def kpi_sample(kpi: DataFrame, limit: int = 30) -> DataFrame:
    recent = newest_days(kpi, _holds(limit))
    return recent.select("window_start", "metric", "value").orderBy(F.desc("window_start"), "metric").limit(limit)


def alert_sample(alerts: DataFrame, limit: int = 20) -> DataFrame:
    cols = ("window_start", "metric", "severity", "value", "baseline", "score")
    recent = newest_days(alerts, _holds(limit))
    return recent.orderBy(F.desc("window_start"), "metric", "alert_id").select(*cols).limit(limit)


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """One-row count (partial counts per task, one final row)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def trailing(df: DataFrame, minutes: float, ts_col: str = "window_start") -> DataFrame:
    """Rows at most ``minutes`` before the newest row (not before now).

    The newest timestamp is a scalar subquery (one partial max per task);
    the comparison then runs as a plain filter.
    """
    newest = df.select(F.max(ts_col)).scalar()
    cutoff = newest - F.make_interval(secs=F.lit(float(minutes) * 60.0))
    return df.filter(F.col(ts_col) >= cutoff)


def severity_filter(alerts: DataFrame, severity: str = "all") -> DataFrame:
    return alerts if severity in (None, "", "all") else alerts.filter(F.col("severity") == F.lit(severity))


def to_iso_z_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Optional output formatting: timestamps as ISO text with ``Z``."""
    from ..functions.columns import to_iso_z

    return df.select(*[to_iso_z(c).alias(c) if c in cols else F.col(c) for c in df.columns])
