"""DuckDB SQL for the correctness oracle.

Each stage is a CTE over the driver's ``events`` view, written independently
of the Spark code (string JSON extraction, ``try_strptime``, ``QUALIFY``,
``time_bucket``, ``list_reduce``) so the two engines check each other. Only the
fixture derivation is shared text (``sources.fixture``), so both sides start
from the same messages.
"""

from __future__ import annotations

from ..contract import EVENT_TYPES, KPI_METRICS
from ..sources.fixture import contract_sql

_TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)


def _j(field: str) -> str:
    return f"json_extract_string(raw_json, '$.{field}')"


def _ts(expr: str) -> str:
    return f"coalesce(try_strptime({expr}, '%Y-%m-%dT%H:%M:%S.%gZ'), try_strptime({expr}, '%Y-%m-%dT%H:%M:%SZ'))"


def stage_ctes() -> str:
    """CTEs: contract, bronze, validated, silver_valid, quarantine_rows, silver."""
    return f"""
contract AS ({contract_sql("duckdb")}),
bronze AS (
  SELECT kafka_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, raw_json,
    {_j("event_id")} AS event_id,
    TRY_CAST({_j("event_version")} AS INTEGER) AS event_version,
    {_j("event_type")} AS event_type,
    {_j("event_time")} AS event_time,
    {_j("ingest_time")} AS ingest_time,
    {_j("user_id")} AS user_id,
    {_j("session_id")} AS session_id,
    {_j("product_id")} AS product_id,
    TRY_CAST({_j("quantity")} AS INTEGER) AS quantity,
    TRY_CAST({_j("price")} AS DOUBLE) AS price,
    {_j("currency")} AS currency,
    {_j("order_id")} AS order_id,
    {_j("source")} AS source
  FROM contract
),
timed AS (
  SELECT *, {_ts("event_time")} AS event_time_ts, {_ts("ingest_time")} AS ingest_time_ts FROM bronze
),
validated AS (
  SELECT *,
    concat_ws(',',
      CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
      CASE WHEN event_type IS NULL OR event_type NOT IN ({_TYPES}) THEN 'invalid_event_type' END,
      CASE WHEN user_id IS NULL THEN 'missing_user_id' END,
      CASE WHEN session_id IS NULL THEN 'missing_session_id' END,
      CASE WHEN ingest_time_ts IS NULL THEN 'bad_ingest_time' END,
      CASE WHEN event_time_ts IS NULL THEN 'bad_event_time' END,
      CASE WHEN event_type IN ('click', 'add_to_cart') AND product_id IS NULL
           THEN 'product_id_required_for_click_or_cart' END,
      CASE WHEN event_type = 'add_to_cart' AND NOT (quantity IS NOT NULL AND quantity >= 1
                AND price IS NOT NULL AND price >= 0 AND currency IS NOT NULL)
           THEN 'add_to_cart_requires_qty_price_currency' END,
      CASE WHEN event_type = 'purchase' AND NOT (order_id IS NOT NULL AND quantity IS NOT NULL
                AND quantity >= 1 AND price IS NOT NULL AND price >= 0 AND currency IS NOT NULL)
           THEN 'purchase_requires_order_qty_price_currency' END
    ) AS validation_errors
  FROM timed
),
silver_valid AS (
  SELECT * EXCLUDE (validation_errors),
    CAST(event_time_ts AS DATE) AS event_date, CAST(hour(event_time_ts) AS INTEGER) AS event_hour
  FROM validated WHERE validation_errors = ''
),
quarantine_rows AS (
  SELECT raw_json, validation_errors, kafka_topic, kafka_partition, kafka_offset, kafka_key,
    event_id, event_type, user_id, session_id, event_time_ts, ingest_time_ts,
    CAST(ingest_time_ts AS DATE) AS ingest_date, CAST(hour(ingest_time_ts) AS INTEGER) AS ingest_hour
  FROM validated WHERE validation_errors <> ''
),
silver AS (
  SELECT * FROM silver_valid
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) = 1
)"""


def kpi_wide_cte(name: str, source: str, width: str) -> str:
    """Ten KPIs per ``time_bucket`` window of ``width`` (e.g. ``1 minute``)."""
    return f"""
{name}_c AS (
  SELECT time_bucket(INTERVAL '{width}', event_time_ts) AS window_start,
    CAST(count(*) AS BIGINT) AS events_total,
    CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS events_click,
    CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS events_add_to_cart,
    CAST(sum(CASE WHEN event_type = 'checkout' THEN 1 ELSE 0 END) AS BIGINT) AS events_checkout,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS events_purchase,
    sum(CASE WHEN event_type = 'purchase' THEN price * CAST(quantity AS DOUBLE) ELSE 0.0 END) AS revenue
  FROM {source} WHERE event_time_ts IS NOT NULL
  GROUP BY 1
),
{name} AS (
  SELECT *,
    CASE WHEN events_purchase > 0 THEN revenue / CAST(events_purchase AS DOUBLE) ELSE 0.0 END AS aov,
    CASE WHEN events_click > 0 THEN CAST(events_add_to_cart AS DOUBLE) / CAST(events_click AS DOUBLE) ELSE 0.0 END AS add_to_cart_rate,
    CASE WHEN events_add_to_cart > 0 THEN CAST(events_checkout AS DOUBLE) / CAST(events_add_to_cart AS DOUBLE) ELSE 0.0 END AS checkout_rate,
    CASE WHEN events_click > 0 THEN CAST(events_purchase AS DOUBLE) / CAST(events_click AS DOUBLE) ELSE 0.0 END AS purchase_conversion
  FROM {name}_c
)"""


def kpi_long_cte(name: str, wide: str) -> str:
    cols = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in KPI_METRICS)
    names = ", ".join(KPI_METRICS)
    return f"""
{name} AS (
  SELECT window_start, metric, value FROM (SELECT window_start, {cols} FROM {wide})
  UNPIVOT (value FOR metric IN ({names}))
)"""


def with_ctes(*ctes: str) -> str:
    body = ",".join(c.strip("\n") for c in ctes)
    return ("WITH RECURSIVE " if "d_walk AS" in body else "WITH ") + body


def detector_ctes(kpi: str, p, as_of: str | None = None, pfx: str = "", seeds: str | None = None) -> str:
    """CTEs over a long KPI relation ``kpi``: scores, cands, alerts_rows.

    Written the straightforward way: a window-ordered poll list, a range join
    of each poll to its metric history, ``list_reduce`` folds, and a recursive
    walk for the cooldown. ``seeds`` is a query ``metric, window_start`` of
    the newest stored alerts: a warning passes a cooldown or more after its
    metric's seed only.
    """
    lb = p.lookback_s * 1_000_000
    w = p.rolling
    names = list(dict.fromkeys(list(p.metrics) + ["events_click", "events_add_to_cart", "events_checkout"]))
    in_names = ", ".join(f"'{m}'" for m in names)
    metric_list = ", ".join(f"'{m}'" for m in p.metrics)
    keep, a = repr(1.0 - p.alpha), repr(p.alpha)
    y_new = (
        f"CASE WHEN acc.y IS NULL THEN pt.x WHEN pt.x = acc.y THEN acc.y "
        f"ELSE CAST({keep} AS DOUBLE) * acc.y + CAST({a} AS DOUBLE) * pt.x END"
    )
    r_new = f"list_append(acc.r, pt.x - ({y_new}))"
    if p.exact_zero:
        zero = "sigma = 0 OR isnan(sigma)"
    else:
        zero = f"sigma <= CAST({p.sigma_eps!r} AS DOUBLE) * greatest(1.0, abs(baseline)) OR isnan(sigma)"
    rng = ""
    if as_of is not None:
        end = f"(TIMESTAMP '{as_of}' - to_seconds({p.ignore_recent_s}))"
        rng = f" AND window_start >= {end} - to_seconds({p.lookback_s}) AND window_start <= {end}"
    c_us = p.cooldown_s * 1_000_000
    open_cands = f"{pfx}cands"
    if seeds is not None:
        open_cands = f"""(SELECT c.* FROM {pfx}cands c LEFT JOIN ({seeds}) s ON s.metric = c.metric
    WHERE c.severity = 'critical' OR s.metric IS NULL OR epoch_us(c.window_start) - epoch_us(s.window_start) >= {c_us})"""
    return f"""
{pfx}d_loaded AS (
  SELECT window_start, metric, CAST(value AS DOUBLE) AS value, epoch_us(window_start) AS ep
  FROM {kpi} WHERE metric IN ({in_names}) AND value IS NOT NULL{rng}
),
{pfx}d_wins AS (
  SELECT ep, max(CASE WHEN metric = 'events_click' THEN value END) AS clicks,
    max(CASE WHEN metric = 'events_add_to_cart' THEN value END) AS carts
  FROM {pfx}d_loaded GROUP BY ep
),
{pfx}d_polls AS (
  SELECT ep AS u_ep,
    count(*) OVER (ORDER BY ep RANGE BETWEEN {lb} PRECEDING AND CURRENT ROW) AS n_wide,
    lag(ep) OVER (ORDER BY ep) AS t_ep, lag(clicks) OVER (ORDER BY ep) AS clicks_t,
    lag(carts) OVER (ORDER BY ep) AS carts_t
  FROM {pfx}d_wins
),
{pfx}d_marks AS (
  SELECT m.metric, q.* FROM {pfx}d_polls q, (SELECT unnest([{metric_list}]) AS metric) m
  WHERE q.t_ep IS NOT NULL AND q.t_ep >= q.u_ep - {lb} AND q.n_wide >= {w + 2}
    {f"AND q.u_ep = (SELECT max(ep) FROM {pfx}d_wins)" if as_of is not None else ""}
    AND CASE WHEN m.metric IN ('purchase_conversion', 'add_to_cart_rate') THEN coalesce(q.clicks_t >= {p.min_denom_clicks}, false)
             WHEN m.metric = 'checkout_rate' THEN coalesce(q.carts_t >= {p.min_denom_add_to_cart}, false)
             ELSE true END
),
{pfx}d_series AS (
  SELECT k.metric, k.t_ep, k.n_wide, k.clicks_t, k.carts_t,
    list({{'ep': l.ep, 'x': l.value}} ORDER BY l.ep) AS pts
  FROM {pfx}d_marks k JOIN {pfx}d_loaded l ON l.metric = k.metric AND l.ep >= k.u_ep - {lb} AND l.ep < k.u_ep
  GROUP BY k.metric, k.t_ep, k.n_wide, k.clicks_t, k.carts_t
  HAVING count(*) >= {w + 2} AND max(l.ep) = k.t_ep
),
{pfx}d_fold AS (
  SELECT metric, t_ep, n_wide, clicks_t, carts_t, len(pts) AS n_points,
    list_reduce(pts, lambda acc, pt: {{
      'y': {y_new},
      'x': pt.x,
      'r': CASE WHEN len({r_new}) > {w + 1} THEN ({r_new})[2:] ELSE {r_new} END
    }}, {{'y': NULL::DOUBLE, 'x': NULL::DOUBLE, 'r': []::DOUBLE[]}}) AS f
  FROM {pfx}d_series
),
{pfx}d_mu AS (
  SELECT *, f.y AS baseline, f.x AS value, f.r[-1] AS residual, f.r[1:{w}] AS hist,
    list_reduce(f.r[1:{w}], lambda s, v: s + v, 0.0::DOUBLE) / {float(w)!r} AS mu
  FROM {pfx}d_fold
),
{pfx}d_sig AS (
  SELECT *, sqrt(list_reduce(list_transform(hist, lambda v: (v - mu) * (v - mu)), lambda s, v: s + v, 0.0::DOUBLE) / {float(w)!r}) AS sigma
  FROM {pfx}d_mu
),
{pfx}scores AS (
  SELECT metric, make_timestamp(t_ep) AS window_start, value, baseline, residual, mu, sigma,
    CASE WHEN {zero} THEN NULL ELSE (residual - mu) / sigma END AS z, n_points, clicks_t, carts_t
  FROM {pfx}d_sig
),
{pfx}cands AS (
  SELECT *, CASE WHEN abs(z) >= {p.crit_z!r} THEN 'critical' ELSE 'warning' END AS severity
  FROM {pfx}scores WHERE z IS NOT NULL AND abs(z) >= {p.warn_z!r}
),
{pfx}d_c AS (
  SELECT *, epoch_us(window_start) AS ep, row_number() OVER (PARTITION BY metric ORDER BY window_start) AS rn FROM {open_cands}
),
{pfx}d_walk AS (
  SELECT metric, rn, ep, true AS emitted, ep AS last_ep FROM {pfx}d_c WHERE rn = 1
  UNION ALL
  SELECT c.metric, c.rn, c.ep,
    (c.severity = 'critical' OR c.ep - w.last_ep >= {c_us}) AS emitted,
    CASE WHEN c.severity = 'critical' OR c.ep - w.last_ep >= {c_us} THEN c.ep ELSE w.last_ep END AS last_ep
  FROM {pfx}d_walk w JOIN {pfx}d_c c ON c.metric = w.metric AND c.rn = w.rn + 1
),
{pfx}kept AS (
  SELECT c.* FROM {pfx}d_c c JOIN {pfx}d_walk w ON w.metric = c.metric AND w.rn = c.rn WHERE w.emitted
),
{pfx}alerts_rows AS (
  SELECT '{p.rule_name}:' || metric || ':' || strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS alert_id,
    window_start, metric, value, baseline, z AS score, severity, '{p.rule_name}' AS rule_name, mu, sigma
  FROM {pfx}kept
)"""
