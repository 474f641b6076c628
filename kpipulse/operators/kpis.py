"""Gold: ten business KPIs per tumbling event-time window.

``kpis_wide`` is one hash aggregate keyed by the window: Spark computes partial
sums per task before the shuffle, so even a window holding a third of all rows
sends one row per task. Ratios are computed after the aggregate from the same
window's counts (guarded: 0.0 when the denominator is 0). ``kpis_long``
unpivots to ``(window_start, metric, value)`` with ``stack`` (a narrow
generate; it also runs in streaming update mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import EVENT_TYPES, KPI_METRICS
from ..functions.columns import guarded_ratio

# The KPIs as data. Counts: one per event type and one of all; sums: a value
# per event; ratios: name, numerator, denominator (of the columns before).
COUNTS = {"events_total": None} | {f"events_{kind}": kind for kind in EVENT_TYPES}
SUMS = {"revenue": ("purchase", lambda: F.col("price") * F.col("quantity").cast("double"))}
RATIOS = (
    ("aov", "revenue", "events_purchase"),
    ("add_to_cart_rate", "events_add_to_cart", "events_click"),
    ("checkout_rate", "events_checkout", "events_add_to_cart"),
    ("purchase_conversion", "events_purchase", "events_click"),
)


def additive() -> dict[str, Column]:
    """The additive aggregates of a window, by name."""
    of = lambda kind: F.lit(True) if kind is None else F.coalesce(F.col("event_type") == kind, F.lit(False))
    counts = {name: F.count_if(of(kind)) for name, kind in COUNTS.items()}
    return counts | {name: F.sum(F.when(of(kind), value()).otherwise(0.0)) for name, (kind, value) in SUMS.items()}


def with_ratios(counts: DataFrame) -> DataFrame:
    wide = counts.withColumns({name: guarded_ratio(top, bottom) for name, top, bottom in RATIOS})
    return wide.select("window_start", *KPI_METRICS)


def kpis_wide(df: DataFrame, width: str = "1 minute", ts_col: str = "event_time_ts") -> DataFrame:
    """One row per non-empty window: ``window_start`` + the ten KPIs."""
    return with_ratios(window_aggregate(df, ts_col, width, additive()))


ADDITIVE = (*COUNTS, *SUMS)


def rollup_kpis(wide: DataFrame, width: str) -> DataFrame:
    """KPIs of wider windows from those of finer ones (which lie in one wider
    window each): counts and sums add up, ratios are computed after, so no
    event is read again."""
    return with_ratios(window_aggregate(wide, "window_start", width, {name: F.sum(name) for name in ADDITIVE}))


def unpivot_kpis(wide: DataFrame) -> DataFrame:
    """Wide KPI rows -> long ``(window_start, metric, value double)``."""
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in KPI_METRICS)
    return wide.selectExpr("window_start", f"stack({len(KPI_METRICS)}, {pairs}) AS (metric, value)")


def kpis_long(df: DataFrame, width: str = "1 minute", ts_col: str = "event_time_ts") -> DataFrame:
    return unpivot_kpis(kpis_wide(df, width, ts_col))


def pivot_kpis(kpi: DataFrame, metrics: tuple[str, ...] | list[str] = KPI_METRICS) -> DataFrame:
    """Long -> wide per window for the listed metrics (null where absent).

    A pivot with a fixed value list: one hash aggregate keyed by window, no
    extra pass to discover the metric names.
    """
    return kpi.groupBy("window_start").pivot("metric", list(metrics)).agg(F.first("value"))


def window_aggregate(df: DataFrame, ts_col: str, width: str, aggs: dict, keys: tuple[str, ...] = ()) -> DataFrame:
    """Any additive aggregates per tumbling window of ``ts_col`` (and optional
    extra keys): the KPI machinery for tables of any schema. One hash
    aggregate with partial results before the shuffle."""
    w = F.window(F.col(ts_col).cast("timestamp"), width)
    out = (
        df.filter(F.col(ts_col).isNotNull())
        .groupBy(w.alias("w"), *keys)
        .agg(*[c.alias(name) for name, c in aggs.items()])
    )
    return out.select(F.col("w.start").alias("window_start"), *keys, *aggs.keys())
