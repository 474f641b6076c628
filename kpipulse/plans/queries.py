"""Registered queries: Spark builders and their DuckDB oracle SQL.

Each Spark builder takes ``(spark, sf_dir)`` and reads the driver tables under
``sf_dir`` (the whole tables; no id subsets or row caps). Output timestamps are
cast to ``TIMESTAMP_NTZ`` and doubles that come from sums are rounded to 6
places on both sides, so the two engines compare equal regardless of
summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import DETAILS_METHOD, EVENT_FIELDS
from ..operators import kpis as K
from ..operators import validate as V
from ..streaming.detector import write_alerts
from . import oracle as O
from . import pipeline as P

QueryFn = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def finish(df: DataFrame, round_cols: tuple[str, ...] = ()) -> DataFrame:
    """Zone-less timestamps and 6-place rounding for the listed columns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "timestamp":
            c = c.cast("timestamp_ntz")
        if f.name in round_cols:
            c = F.round(c, 6)
        out.append(c.alias(f.name))
    return df.select(*out)


_BRONZE_COLS = ("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "raw_json") + EVENT_FIELDS
_SILVER_COLS = EVENT_FIELDS + (
    "raw_json",
    "kafka_topic",
    "kafka_offset",
    "kafka_partition",
    "kafka_key",
    "kafka_timestamp",
    "event_time_ts",
    "ingest_time_ts",
    "event_date",
    "event_hour",
)
_QUARANTINE_COLS = tuple(c for c in V.C.QUARANTINE_COLUMNS if c != "processing_time")
_WIDE_COLS = ("window_start",) + K.KPI_METRICS
_RATIO_COLS = ("revenue", "aov", "add_to_cart_rate", "checkout_rate", "purchase_conversion", "value")


def _sel(cols) -> str:
    return ", ".join(cols)


def _rnd(cols, rcols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in rcols else c for c in cols)


# ---------------------------------------------------------------- bronze ----
@register(
    "bronze_parse",
    O.with_ctes(O.stage_ctes())
    + f"""
SELECT {_sel(_BRONZE_COLS)}, ingest_time_ts, CAST(ingest_time_ts AS DATE) AS ingest_date,
  CAST(hour(ingest_time_ts) AS INTEGER) AS ingest_hour
FROM timed""",
)
def bronze_parse(spark, sf_dir):
    b = P.bronze(spark, sf_dir)
    return finish(b.select(*_BRONZE_COLS, "ingest_time_ts", "ingest_date", "ingest_hour"))


@register(
    "ts_fallback",
    O.with_ctes(O.stage_ctes())
    + """
SELECT kafka_offset, event_time, event_time_ts, ingest_time, ingest_time_ts FROM timed""",
)
def ts_fallback(spark, sf_dir):
    v = V.with_times(P.bronze(spark, sf_dir))
    return finish(v.select("kafka_offset", "event_time", "event_time_ts", "ingest_time", "ingest_time_ts"))


# ---------------------------------------------------------------- silver ----
@register(
    "dq_errors",
    O.with_ctes(O.stage_ctes())
    + """
SELECT error_code, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT unnest(string_split(validation_errors, ',')) AS error_code FROM validated WHERE validation_errors <> '')
GROUP BY error_code""",
)
def dq_errors(spark, sf_dir):
    return V.error_counts(P.validated(spark, sf_dir))


@register(
    "dq_validity",
    O.with_ctes(O.stage_ctes())
    + """
SELECT kafka_offset, validation_errors, validation_errors = '' AS is_valid FROM validated""",
)
def dq_validity(spark, sf_dir):
    return P.validated(spark, sf_dir).select("kafka_offset", "validation_errors", "is_valid")


@register(
    "silver_valid",
    O.with_ctes(O.stage_ctes()) + f"\nSELECT {_sel(_SILVER_COLS)} FROM silver_valid",
)
def silver_valid(spark, sf_dir):
    return finish(V.valid_rows(P.validated(spark, sf_dir)).select(*_SILVER_COLS))


@register(
    "quarantine",
    O.with_ctes(O.stage_ctes()) + f"\nSELECT {_sel(_QUARANTINE_COLS)} FROM quarantine_rows",
)
def quarantine(spark, sf_dir):
    return finish(P.quarantined(spark, sf_dir).select(*_QUARANTINE_COLS))


@register(
    "silver_dedupe",
    O.with_ctes(O.stage_ctes()) + f"\nSELECT {_sel(_SILVER_COLS)} FROM silver",
)
def silver_dedupe(spark, sf_dir):
    return finish(P.silver(spark, sf_dir).select(*_SILVER_COLS))


# ------------------------------------------------------------------ gold ----
@register(
    "kpi_minute_wide",
    O.with_ctes(O.stage_ctes(), O.kpi_wide_cte("kw", "silver", "1 minute"))
    + f"\nSELECT {_rnd(_WIDE_COLS, _RATIO_COLS)} FROM kw",
)
def kpi_minute_wide(spark, sf_dir):
    return finish(P.gold_wide(spark, sf_dir, "1 minute"), _RATIO_COLS)


@register(
    "kpi_minute_long",
    O.with_ctes(O.stage_ctes(), O.kpi_wide_cte("kw", "silver", "1 minute"), O.kpi_long_cte("kl", "kw"))
    + "\nSELECT window_start, metric, round(value, 6) AS value FROM kl",
)
def kpi_minute_long(spark, sf_dir):
    return finish(P.gold(spark, sf_dir, "1 minute"), ("value",))


@register(
    "kpi_hour_long",
    O.with_ctes(O.stage_ctes(), O.kpi_wide_cte("kw", "silver", "1 hour"), O.kpi_long_cte("kl", "kw"))
    + "\nSELECT window_start, metric, round(value, 6) AS value FROM kl",
)
def kpi_hour_long(spark, sf_dir):
    return finish(P.gold(spark, sf_dir, "1 hour"), ("value",))


@register("kpi_hour_rollup", SQL["kpi_hour_long"])
def kpi_hour_rollup(spark, sf_dir):
    """A1 at two widths: the hour from the stored one-minute KPIs."""
    wide = K.pivot_kpis(_minute_kpi(spark, sf_dir))
    return finish(K.unpivot_kpis(K.rollup_kpis(wide, "1 hour")), ("value",))


# -------------------------------------------------------------- detector ----
# Driver events are sparse (about 14 per hour at sf0.01), so the detector runs
# on 1-hour windows: lookback 120 windows, 5 residuals, 6-hour cooldown.
from ..contract import DetectorParams  # noqa: E402
from ..operators import detect as D  # noqa: E402

DET = DetectorParams(lookback_s=120 * 3600, rolling=5, alpha=0.2, warn_z=3.0, crit_z=5.0, cooldown_s=6 * 3600, ignore_recent_s=0)
# Lower denominators so the rate metrics are scored on sparse data.
DET_RATES = DetectorParams(
    metrics=("purchase_conversion", "add_to_cart_rate", "checkout_rate"),
    lookback_s=120 * 3600,
    rolling=5,
    cooldown_s=6 * 3600,
    ignore_recent_s=0,
    min_denom_clicks=3,
    min_denom_add_to_cart=3,
)
AS_OF = "2024-01-20 12:30:00"
_SCORE_COLS = ("value", "baseline", "residual", "mu", "sigma", "z", "score")


def _hour_kpi_ctes() -> tuple[str, ...]:
    return (O.stage_ctes(), O.kpi_wide_cte("kw", "silver", "1 hour"), O.kpi_long_cte("kl", "kw"))


def _det_sql(p: DetectorParams, select: str, as_of: str | None = None) -> str:
    return O.with_ctes(*_hour_kpi_ctes(), O.detector_ctes("kl", p, as_of)) + "\n" + select


def _hour_kpi(spark, sf_dir):
    # the stored hourly KPI table: the detector reads it from several branches
    return P.table(spark, sf_dir, "kpi_hour", lambda: P.gold(spark, sf_dir, "1 hour"), T.write_kpi_table)


@register(
    "ewma_baseline",
    _det_sql(DET, "SELECT metric, window_start, round(value, 6) AS value, round(baseline, 6) AS baseline, n_points FROM scores"),
)
def ewma_baseline(spark, sf_dir):
    s = D.score_all(_hour_kpi(spark, sf_dir), DET)
    return finish(s.select("metric", "window_start", "value", "baseline", "n_points"), _SCORE_COLS)


@register(
    "residual_zscore",
    _det_sql(
        DET,
        "SELECT metric, window_start, round(residual, 6) AS residual, round(mu, 6) AS mu, "
        "round(sigma, 6) AS sigma, round(z, 6) AS z FROM scores",
    ),
)
def residual_zscore(spark, sf_dir):
    s = D.score_all(_hour_kpi(spark, sf_dir), DET)
    return finish(s.select("metric", "window_start", "residual", "mu", "sigma", "z"), _SCORE_COLS)


@register(
    "rate_guard",
    _det_sql(
        DET_RATES,
        "SELECT metric, window_start, clicks_t, carts_t, round(value, 6) AS value, round(z, 6) AS z FROM scores",
    ),
)
def rate_guard(spark, sf_dir):
    s = D.score_all(_hour_kpi(spark, sf_dir), DET_RATES)
    return finish(s.select("metric", "window_start", "clicks_t", "carts_t", "value", "z"), _SCORE_COLS)


@register(
    "anomaly_candidates",
    _det_sql(DET, "SELECT metric, window_start, round(z, 6) AS score, severity FROM cands"),
)
def anomaly_candidates(spark, sf_dir):
    c = D.candidates(D.score_all(_hour_kpi(spark, sf_dir), DET), DET)
    return finish(c.select("metric", "window_start", F.col("z").alias("score"), "severity"), _SCORE_COLS)


_ALERT_OUT = ("alert_id", "window_start", "metric", "value", "baseline", "score", "severity", "rule_name")


@register(
    "anomaly_alerts",
    _det_sql(
        DET,
        "SELECT alert_id, window_start, metric, round(value, 6) AS value, round(baseline, 6) AS baseline, "
        "round(score, 6) AS score, severity, rule_name FROM alerts_rows",
    ),
)
def anomaly_alerts(spark, sf_dir):
    a = D.detect(_hour_kpi(spark, sf_dir), DET)
    return finish(a.select(*_ALERT_OUT), _SCORE_COLS)


@register(
    "alert_details",
    _det_sql(
        DET,
        f"SELECT alert_id, true AS has_created_at, '{DETAILS_METHOD}' AS method, '{DET.alpha}' AS ewma_alpha, "
        f"'{DET.rolling}' AS rolling_window, '{DET.warn_z}' AS warn_z, '{DET.crit_z}' AS crit_z, round(mu, 6) AS mu, "
        f"round(sigma, 6) AS sigma, '{DET.ignore_recent_s // 60}' AS ignore_recent_minutes, "
        f"'{DET.cooldown_s // 60}' AS cooldown_minutes FROM alerts_rows",
    ),
)
def alert_details(spark, sf_dir):
    """The details text field by field, and a write time on each row."""
    a = D.detect(_hour_kpi(spark, sf_dir), DET)
    field = lambda name: F.get_json_object("details", f"$.{name}")
    texts = ("method", "ewma_alpha", "rolling_window", "warn_z", "crit_z", "ignore_recent_minutes", "cooldown_minutes")
    return a.select(
        "alert_id",
        F.col("created_at").isNotNull().alias("has_created_at"),
        *[field(n).alias(n) for n in texts],
        *[F.round(field(n).cast("double"), 6).alias(n) for n in ("mu", "sigma")],
    )


# stored alerts before, between, at and after the candidates, by metric
_SEED_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, " + shift + f" AS window_start FROM cands WHERE metric = '{m}' HAVING count(*) > 0"
    for m, shift in zip(
        DET.metrics,
        (
            "min(window_start) - INTERVAL 1 HOUR",
            "quantile_disc(window_start, 0.5) + INTERVAL 1 HOUR",
            "quantile_disc(window_start, 0.5)",
            "max(window_start) + INTERVAL 1 DAY",
            "quantile_disc(window_start, 0.5) - INTERVAL 1 HOUR",
        ),
    )
)


@register(
    "alerts_seeded",
    O.with_ctes(*_hour_kpi_ctes(), O.detector_ctes("kl", DET, seeds=_SEED_SQL))
    + "\nSELECT alert_id, window_start, metric, severity FROM alerts_rows",
)
def alerts_seeded(spark, sf_dir):
    """The cooldown after a restart, seeded from stored alerts."""
    c = D.candidates(D.score_all(_hour_kpi(spark, sf_dir), DET), DET)
    middle = F.element_at(F.array_sort(F.collect_list("window_start")), F.ceil(F.count("*") * 0.5).cast("int"))
    hours = lambda n: F.expr(f"INTERVAL '{n}' HOUR")
    marks = c.groupBy("metric").agg(F.min("window_start").alias("lo"), middle.alias("mid"), F.max("window_start").alias("hi"))
    shifts = (F.col("lo") - hours(1), F.col("mid") + hours(1), F.col("mid"), F.col("hi") + hours(24), F.col("mid") - hours(1))
    seed = F.lit(None).cast("timestamp")
    for m, shift in zip(DET.metrics, shifts):
        seed = F.when(F.col("metric") == m, shift).otherwise(seed)
    seeds = marks.select("metric", seed.alias("last_window_start"))
    kept = D.alerts_from(D.apply_cooldown(c, DET, seeds), DET)
    return finish(kept.select("alert_id", "window_start", "metric", "severity"))


@register(
    "detect_as_of",
    _det_sql(
        DET,
        "SELECT metric, window_start, round(value, 6) AS value, round(baseline, 6) AS baseline, "
        "round(z, 6) AS z, n_points FROM scores",
        AS_OF,
    ),
)
def detect_as_of(spark, sf_dir):
    s = D.score_as_of(_hour_kpi(spark, sf_dir), F.lit(AS_OF).cast("timestamp"), DET)
    return finish(s.select("metric", "window_start", "value", "baseline", "z", "n_points"), _SCORE_COLS)


# --------------------------------------------------------------- serving ----
from ..operators import serve as S  # noqa: E402
from ..operators import tables as T  # noqa: E402

SERIES_FROM, SERIES_TO = "2024-01-10T00:00:00Z", "2024-01-20T00:00:00Z"
ALERTS_FROM, ALERTS_TO = "2024-01-05T00:00:00Z", "2024-01-25T00:00:00Z"
CUTOFF = "2024-01-16 00:00:00"  # ingest time splitting "already loaded" from "late batch"


def _minute_sql(select: str) -> str:
    return (
        O.with_ctes(O.stage_ctes(), O.kpi_wide_cte("kw", "silver", "1 minute"), O.kpi_long_cte("kl", "kw"))
        + "\n"
        + select
    )


def _minute_kpi(spark, sf_dir):
    # serving reads query the stored 1-minute KPI table, as the API reads Gold
    return P.table(spark, sf_dir, "kpi_minute", lambda: P.gold(spark, sf_dir, "1 minute"), T.write_kpi_table)


@register(
    "kpi_series",
    _minute_sql(
        "SELECT window_start, round(value, 6) AS value FROM kl WHERE metric = 'events_total' "
        "AND window_start >= TIMESTAMP '2024-01-10 00:00:00' AND window_start <= TIMESTAMP '2024-01-20 00:00:00' "
        "ORDER BY window_start LIMIT 500"
    ),
)
def kpi_series(spark, sf_dir):
    s = S.kpi_series(_minute_kpi(spark, sf_dir), "events_total", to_ts=SERIES_TO, from_ts=SERIES_FROM, limit=500)
    return finish(s, ("value",))


_LATEST_LIST = ", ".join(f"'{m}'" for m in S.DEFAULT_LATEST)


@register(
    "kpi_latest",
    _minute_sql(
        f"SELECT m.metric, l.window_start, round(l.value, 6) AS value FROM (SELECT unnest([{_LATEST_LIST}]) AS metric) m "
        "LEFT JOIN (SELECT metric AS lm, max(window_start) AS window_start, arg_max(value, window_start) AS value "
        "FROM kl GROUP BY metric) l ON l.lm = m.metric"
    ),
)
def kpi_latest(spark, sf_dir):
    return finish(S.kpi_latest(_minute_kpi(spark, sf_dir)).select("metric", "window_start", "value"), ("value",))


@register(
    "kpi_sample",
    _minute_sql("SELECT window_start, metric, round(value, 6) AS value FROM kl ORDER BY window_start DESC, metric LIMIT 30"),
)
def kpi_sample(spark, sf_dir):
    return finish(S.kpi_sample(_minute_kpi(spark, sf_dir), 30), ("value",))


@register("kpi_count", _minute_sql("SELECT CAST(count(*) AS BIGINT) AS n_rows FROM kl"))
def kpi_count(spark, sf_dir):
    return S.row_count(_minute_kpi(spark, sf_dir))


_PIVOT_SEL = ", ".join(f"round(max(CASE WHEN metric = '{m}' THEN value END), 6) AS {m}" for m in K.KPI_METRICS)


@register(
    "kpi_pivot",
    O.with_ctes(*_hour_kpi_ctes()) + f"\nSELECT window_start, {_PIVOT_SEL} FROM kl GROUP BY window_start",
)
def kpi_pivot(spark, sf_dir):
    return finish(K.pivot_kpis(_hour_kpi(spark, sf_dir)), K.KPI_METRICS)


@register(
    "kpi_trailing",
    _minute_sql(
        "SELECT window_start, round(value, 6) AS value FROM kl WHERE metric = 'revenue' AND window_start >= "
        "(SELECT max(window_start) FROM kl WHERE metric = 'revenue') - INTERVAL 360 MINUTE"
    ),
)
def kpi_trailing(spark, sf_dir):
    rev = _minute_kpi(spark, sf_dir).filter(F.col("metric") == "revenue").select("window_start", "value")
    return finish(S.trailing(rev, 360), ("value",))


def _partial_silver_sql() -> tuple[str, ...]:
    return (
        O.stage_ctes(),
        f"silver_early AS (SELECT * FROM silver WHERE ingest_time_ts < TIMESTAMP '{CUTOFF}')",
        O.kpi_wide_cte("kw", "silver", "1 hour"),
        O.kpi_long_cte("kl", "kw"),
        O.kpi_wide_cte("kpw", "silver_early", "1 hour"),
        O.kpi_long_cte("kp", "kpw"),
    )


@register(
    "kpi_replace_windows",
    O.with_ctes(*_partial_silver_sql())
    + f"""
, touched AS (
  SELECT DISTINCT time_bucket(INTERVAL '1 hour', event_time_ts) AS window_start
  FROM silver WHERE ingest_time_ts >= TIMESTAMP '{CUTOFF}'
), batch AS (SELECT * FROM kl WHERE window_start IN (SELECT window_start FROM touched))
SELECT window_start, metric, round(value, 6) AS value FROM kp WHERE window_start NOT IN (SELECT window_start FROM batch)
UNION ALL
SELECT window_start, metric, round(value, 6) AS value FROM batch""",
)
def kpi_replace_windows(spark, sf_dir):
    silver = P.silver(spark, sf_dir, cols=P.KPI_INPUT)
    cutoff = F.lit(CUTOFF).cast("timestamp")
    table = K.kpis_long(silver.filter(F.col("ingest_time_ts") < cutoff), "1 hour")
    touched = silver.filter(F.col("ingest_time_ts") >= cutoff).select(
        F.window("event_time_ts", "1 hour").start.alias("window_start")
    )
    batch = K.kpis_long(silver, "1 hour").join(touched.distinct(), "window_start", "left_semi")
    return finish(T.replace_windows(table, batch), ("value",))


def _alerts(spark, sf_dir) -> DataFrame:
    """The stored alert table, partitioned by date: alert reads scan it."""
    stored = P.table(spark, sf_dir, "alerts_hour", lambda: D.detect(_hour_kpi(spark, sf_dir), DET), write_alerts)
    return stored.select(*_ALERT_OUT, "window_date")


_ALERT_SQL_COLS = (
    "alert_id, window_start, metric, round(value, 6) AS value, round(baseline, 6) AS baseline, "
    "round(score, 6) AS score, severity, rule_name"
)


@register(
    "alert_insert_if_absent",
    O.with_ctes(*_partial_silver_sql(), O.detector_ctes("kp", DET, pfx="e_"), O.detector_ctes("kl", DET, pfx="n_"))
    + f"""
SELECT {_ALERT_SQL_COLS} FROM e_alerts_rows
UNION ALL
SELECT {_ALERT_SQL_COLS} FROM n_alerts_rows WHERE alert_id NOT IN (SELECT alert_id FROM e_alerts_rows)""",
)
def alert_insert_if_absent(spark, sf_dir):
    silver = P.silver(spark, sf_dir, cols=P.KPI_INPUT)
    early = silver.filter(F.col("ingest_time_ts") < F.lit(CUTOFF).cast("timestamp"))
    existing = D.detect(P.materialize(K.kpis_long(early, "1 hour")), DET).select(*_ALERT_OUT)
    new = D.detect(P.materialize(K.kpis_long(silver, "1 hour")), DET).select(*_ALERT_OUT)
    return finish(T.insert_if_absent(existing, new, "alert_id"), _SCORE_COLS)


@register(
    "alerts_filtered",
    _det_sql(
        DET,
        f"SELECT {_ALERT_SQL_COLS} FROM alerts_rows WHERE severity = 'warning' "
        "AND window_start >= TIMESTAMP '2024-01-05 00:00:00' AND window_start <= TIMESTAMP '2024-01-25 00:00:00' "
        "ORDER BY window_start DESC, metric, alert_id LIMIT 200",
    ),
)
def alerts_filtered(spark, sf_dir):
    a = S.alerts_query(_alerts(spark, sf_dir), to_ts=ALERTS_TO, from_ts=ALERTS_FROM, severity="warning", limit=200)
    return finish(a.drop("window_date"), _SCORE_COLS)


@register(
    "alerts_latest",
    _det_sql(DET, f"SELECT {_ALERT_SQL_COLS} FROM alerts_rows ORDER BY window_start DESC, metric, alert_id LIMIT 50"),
)
def alerts_latest(spark, sf_dir):
    return finish(S.alerts_latest(_alerts(spark, sf_dir), 50).drop("window_date"), _SCORE_COLS)


@register(
    "alert_sample",
    _det_sql(
        DET,
        "SELECT window_start, metric, severity, round(value, 6) AS value, round(baseline, 6) AS baseline, "
        "round(score, 6) AS score FROM alerts_rows ORDER BY window_start DESC, metric, alert_id LIMIT 20",
    ),
)
def alert_sample(spark, sf_dir):
    return finish(S.alert_sample(_alerts(spark, sf_dir), 20), _SCORE_COLS)


@register(
    "last_alert_per_metric",
    _det_sql(DET, "SELECT metric, max(window_start) AS last_window_start FROM alerts_rows GROUP BY metric"),
)
def last_alert_per_metric(spark, sf_dir):
    return finish(D.last_alert_per_metric(_alerts(spark, sf_dir), DET.rule_name))


# ------------------------------------------------------------- streaming ----
# Each streaming query lands the topic derived from ``events`` in a fresh
# folder, runs the streaming stages with availableNow triggers and returns the
# sink read back. The oracle is the batch SQL of the same stage.
from ..streaming import runs as R  # noqa: E402

# Silver rows from a stream: which of two copies of an event id survives one
# micro-batch is not specified, so lineage columns that differ between
# copies (ingest time, offset, raw text) are left out of the comparison.
_STREAM_SILVER_COLS = tuple(c for c in _SILVER_COLS if c not in ("ingest_time", "raw_json", "kafka_offset", "ingest_time_ts"))


@register("stream_bronze", SQL["bronze_parse"])
def stream_bronze(spark, sf_dir):
    p = R.run_stream_pipeline(spark, sf_dir, stages=("bronze",))
    b = R.read_table(spark, p.bronze)
    return finish(b.select(*_BRONZE_COLS, "ingest_time_ts", "ingest_date", "ingest_hour"))


@register("stream_quarantine", SQL["quarantine"])
def stream_quarantine(spark, sf_dir):
    p = R.run_stream_pipeline(spark, sf_dir, stages=("bronze", "silver"))
    return finish(R.read_table(spark, p.quarantine).select(*_QUARANTINE_COLS))


@register(
    "stream_silver",
    O.with_ctes(O.stage_ctes()) + f"\nSELECT {_sel(_STREAM_SILVER_COLS)} FROM silver",
)
def stream_silver(spark, sf_dir):
    p = R.run_stream_pipeline(spark, sf_dir, stages=("bronze", "silver"))
    return finish(R.read_table(spark, p.silver).select(*_STREAM_SILVER_COLS))


@register("stream_kpi", SQL["kpi_minute_long"])
def stream_kpi(spark, sf_dir):
    p = R.run_stream_pipeline(spark, sf_dir)
    return finish(R.J.read_kpi(spark, p.kpi), ("value",))


@register("stream_bronze_raw", SQL["bronze_parse"])
def stream_bronze_raw(spark, sf_dir):
    """S2, P7, ST8: broker rows with binary key and value, a third of the
    topic's files per micro-batch."""
    p = R.new_paths(spark)
    each = R.files_for(-(-R.contract_events(spark, sf_dir).count() // 3))
    R.land_topic(spark, sf_dir, p.topic, files=3 * each, raw=True)
    R.run_stream_pipeline(spark, sf_dir, p, stages=("bronze",), land=False, raw=True, max_files_per_trigger=each)
    return finish(R.read_table(spark, p.bronze).select(*_BRONZE_COLS, "ingest_time_ts", "ingest_date", "ingest_hour"))


@register("stream_kpi_compacted", SQL["kpi_minute_long"])
def stream_kpi_compacted(spark, sf_dir):
    """K5: Gold in several rate-limited micro-batches, each a version of the
    KPI table; every two versions are merged. The watermark is longer than the
    data, so that no batch finds late rows."""
    p = R.run_stream_pipeline(spark, sf_dir, stages=("bronze", "silver"))
    files = len(R.read_table(spark, p.silver).inputFiles())
    silver = R.J.parquet_stream(spark, p.silver, R.J.SILVER_READ_SCHEMA, max_files_per_trigger=max(1, files // 4))
    R._finish(R.J.gold_query(silver, p.kpi, p.ckpt("gold"), watermark="400 days", compact_every=2))
    return finish(R.J.read_kpi(spark, p.kpi), ("value",))


# tables that later plans can read instead of building them (``P.prepare``)
PREPARED = {
    "bronze": (P.bronze, None),
    "kpi_minute": (lambda spark, sf_dir: P.gold(spark, sf_dir, "1 minute"), T.write_kpi_table),
    "kpi_hour": (lambda spark, sf_dir: P.gold(spark, sf_dir, "1 hour"), T.write_kpi_table),
    "alerts_hour": (lambda spark, sf_dir: D.detect(_hour_kpi(spark, sf_dir), DET), write_alerts),
}


_RESENT = 1_000_000_000  # the fixture's offsets of second deliveries start here


def _bronze_parts(spark, sf_dir, path: str, n: int) -> int:
    """The Bronze rows in delivery order: first deliveries in ``n`` parts, then
    all second ones in one. Each part is as many files as the largest needs;
    returns that number, which a micro-batch has to read to get one part."""
    bronze = P.stored_bronze(spark, sf_dir)
    last = bronze.filter(F.col("kafka_offset") < _RESENT).agg(F.max("kafka_offset")).scalar()
    part = F.when(F.col("kafka_offset") < _RESENT, F.floor(F.col("kafka_offset") * n / (last + 1))).otherwise(n)
    dealt = bronze.withColumn("part", part)
    files = R.files_for(dealt.groupBy("part").count().agg(F.max("count")).first()[0] or 0)
    for k in range(n + 1):
        R.write_files(dealt.filter(F.col("part") == k).drop("part"), path, files)
    return files


_LATE_PARTS, _LATE_DELAY = 3, "36 hours"


@register(
    "stream_late_rows",
    O.with_ctes(O.stage_ctes())
    + f"""
, parts AS (
  SELECT event_time_ts, CASE WHEN kafka_offset < {_RESENT} THEN kafka_offset * {_LATE_PARTS}
    // ((SELECT max(kafka_offset) FROM timed WHERE kafka_offset < {_RESENT}) + 1) ELSE {_LATE_PARTS} END AS part FROM silver_valid
), marks AS (
  SELECT part, max(max(date_trunc('milliseconds', event_time_ts))) OVER (ORDER BY part) - INTERVAL '{_LATE_DELAY}' AS mark
  FROM parts GROUP BY part
)
SELECT CAST(p.part AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_late
FROM parts p JOIN marks m ON m.part = p.part - 2 AND p.event_time_ts <= m.mark GROUP BY p.part""",
)
def stream_late_rows(spark, sf_dir):
    """ST1, ST9: the rows that each micro-batch of Silver dropped as late, from
    the progress table. A batch's late rows are those at or before the
    watermark that the batch before it started with."""
    from ..streaming.progress import ProgressLog, read_progress

    R.configure(spark)
    p = R.new_paths(spark)
    files = _bronze_parts(spark, sf_dir, p.bronze, _LATE_PARTS)
    bronze = R.J.parquet_stream(spark, p.bronze, R.J.BRONZE_READ_SCHEMA, max_files_per_trigger=files)
    with ProgressLog(spark, f"{p.root}/progress"):
        good, bad = R.J.silver_queries(bronze, p.silver, p.quarantine, p.ckpt("s"), p.ckpt("q"), watermark=_LATE_DELAY, by_hour=False)
        R._finish(good, bad)
    return read_progress(spark, f"{p.root}/progress", good.id).filter("n_late > 0").select("batch_id", "n_late")


@register("stream_dq_counts", SQL["dq_errors"])
def stream_dq_counts(spark, sf_dir):
    """Rule counts observed by the quarantine stream, summed over
    its micro-batches; Bronze is not read for them."""
    from ..streaming.progress import ProgressLog, read_progress, rule_counts

    R.configure(spark)
    p = R.new_paths(spark)
    files = _bronze_parts(spark, sf_dir, p.bronze, 3)
    bronze = R.J.parquet_stream(spark, p.bronze, R.J.BRONZE_READ_SCHEMA, max_files_per_trigger=files)
    with ProgressLog(spark, f"{p.root}/progress"):
        good, bad = R.J.silver_queries(bronze, p.silver, p.quarantine, p.ckpt("s"), p.ckpt("q"), by_hour=False)
        R._finish(good, bad)
    return rule_counts(read_progress(spark, f"{p.root}/progress", bad.id))


@register("stream_alerts", SQL["anomaly_alerts"])
def stream_alerts(spark, sf_dir):
    """Bronze -> Silver -> hourly Gold -> detector, all as streaming queries."""
    p = R.run_stream_pipeline(spark, sf_dir, stages=("bronze", "silver", "gold", "detect"), width="1 hour", detector=DET)
    return finish(R.read_table(spark, p.alerts).select(*_ALERT_OUT), _SCORE_COLS)


@register("stream_alerts_batches", SQL["anomaly_alerts"])
def stream_alerts_batches(spark, sf_dir):
    """The hourly KPIs in four micro-batches. The open window of a batch comes
    half filled and is sent again in full by the next one, and each batch
    sends the first windows of all over: each window is scored once, on the
    rows that its closing batch has left."""
    from ..streaming.detector import detector_query, read_alerts

    kpi = _hour_kpi(spark, sf_dir).select("window_start", "metric", "value")
    p = R.new_paths(spark)
    days = ["2024-01-08", "2024-01-16", "2024-01-24", "2100-01-01"]
    for batch, (lo, hi) in enumerate(zip(["1970-01-01", *days], days)):
        ts = F.col("window_start")
        open_window = kpi.filter(ts < hi).agg(F.max("window_start")).scalar() if batch < len(days) - 1 else F.lit(None).cast("timestamp")
        value = F.when(ts == open_window, F.col("value") / 2).otherwise(F.col("value"))
        again = kpi.filter(ts < "2024-01-02").unionByName(kpi.filter((ts >= F.to_timestamp(F.lit(lo)) - F.expr("INTERVAL '1' HOUR")) & (ts < hi)))
        T.write_versioned_batch(again.distinct().withColumn("value", value), p.kpi, 1, batch)
        R._finish(detector_query(spark, p.kpi, p.alerts, p.ckpt("detector"), DET))
    return finish(read_alerts(spark, p.alerts).select(*_ALERT_OUT), _SCORE_COLS)


@register("stream_alerts_keyed", SQL["anomaly_alerts"])
def stream_alerts_keyed(spark, sf_dir):
    """The hourly KPIs in four micro-batches, candidates as a stream
    and the cooldown in keyed state, restarted for every batch."""
    from ..streaming.detector import alerts_query, candidates_query, read_alerts

    R.configure(spark)
    kpi = _hour_kpi(spark, sf_dir).select("window_start", "metric", "value")
    p = R.new_paths(spark)
    days = ["2024-01-08", "2024-01-16", "2024-01-24", "2100-01-01"]
    for batch, (lo, hi) in enumerate(zip(["1970-01-01", *days], days)):
        ts = F.col("window_start")
        again = F.to_timestamp(F.lit(lo)) - F.expr("INTERVAL '1' HOUR")
        T.write_versioned_batch(kpi.filter((ts >= again) & (ts < hi)), p.kpi, 1, batch)
        R._finish(candidates_query(spark, p.kpi, p.candidates, p.ckpt("candidates"), DET))
        R._finish(alerts_query(spark, p.candidates, p.alerts, p.ckpt("alerts"), DET))
    return finish(read_alerts(spark, p.alerts).select(*_ALERT_OUT), _SCORE_COLS)


# ------------------------------------------------- other table schemas ----
# The rules, dedupe and window operators are schema-agnostic; these run them
# over the whole ``lineitem`` table.
from ..operators.dedupe import dedupe as _dedupe  # noqa: E402
from ..operators.validate import Rule  # noqa: E402

_LI_COLS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def lineitem_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("bad_quantity", lambda: ~F.coalesce(c("l_quantity") >= 1, F.lit(False))),
        Rule("bad_discount", lambda: ~F.coalesce(c("l_discount").between(0.0, 0.1), F.lit(False))),
        Rule("bad_returnflag", lambda: ~F.coalesce(c("l_returnflag").isin("A", "N", "R"), F.lit(False))),
        Rule("bad_linestatus", lambda: ~F.coalesce(c("l_linestatus").isin("F", "O"), F.lit(False))),
        # a return (A or R) needs a shipped, finished line
        Rule(
            "return_requires_finished_line",
            lambda: F.coalesce(c("l_returnflag").isin("A", "R"), F.lit(False)) & ~F.coalesce(c("l_linestatus") == "F", F.lit(False)),
        ),
    ]


@register(
    "lineitem_dq",
    """
SELECT error_code, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT unnest(string_split(e, ',')) AS error_code FROM (
    SELECT concat_ws(',',
      CASE WHEN NOT coalesce(l_quantity >= 1, false) THEN 'bad_quantity' END,
      CASE WHEN NOT coalesce(l_discount BETWEEN 0.0 AND 0.1, false) THEN 'bad_discount' END,
      CASE WHEN NOT coalesce(l_returnflag IN ('A', 'N', 'R'), false) THEN 'bad_returnflag' END,
      CASE WHEN NOT coalesce(l_linestatus IN ('F', 'O'), false) THEN 'bad_linestatus' END,
      CASE WHEN coalesce(l_returnflag IN ('A', 'R'), false) AND NOT coalesce(l_linestatus = 'F', false)
           THEN 'return_requires_finished_line' END) AS e
    FROM lineitem) WHERE e <> '')
GROUP BY error_code""",
)
def lineitem_dq(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return V.error_counts(V.validate(li, lineitem_rules(), parse_times=False))


@register(
    "lineitem_dedupe",
    f"""
SELECT {", ".join(_LI_COLS)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)
def lineitem_dedupe(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*_LI_COLS)
    return finish(_dedupe(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


@register(
    "lineitem_daily",
    """
SELECT time_bucket(INTERVAL '1 day', l_shipdate) AS window_start, l_returnflag,
  CAST(count(*) AS BIGINT) AS n_lines, round(sum(l_quantity), 6) AS sum_qty,
  round(sum(l_extendedprice * (1 - l_discount)), 6) AS revenue
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2""",
)
def lineitem_daily(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    out = K.window_aggregate(
        li,
        "l_shipdate",
        "1 day",
        {
            "n_lines": F.count(F.lit(1)),
            "sum_qty": F.sum("l_quantity"),
            "revenue": F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        },
        keys=("l_returnflag",),
    )
    return finish(out, ("sum_qty", "revenue"))


# ------------------------------------------------------------ reads, cont. ----
_HIST_METRICS = DET.metrics + ("events_click", "events_add_to_cart", "events_checkout")
_HIST_LIST = ", ".join(f"'{m}'" for m in _HIST_METRICS)


@register(
    "kpi_history",
    O.with_ctes(*_hour_kpi_ctes())
    + f"""
SELECT window_start, metric, round(value, 6) AS value FROM kl
WHERE metric IN ({_HIST_LIST}) AND window_start >= TIMESTAMP '2024-01-10 00:00:00'
  AND window_start <= TIMESTAMP '2024-01-15 00:00:00'""",
)
def kpi_history(spark, sf_dir):
    h = S.kpi_history(_hour_kpi(spark, sf_dir), _HIST_METRICS, "2024-01-10T00:00:00Z", "2024-01-15T00:00:00Z")
    return finish(h, ("value",))


@register(
    "kpi_series_iso",
    _minute_sql(
        "SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') AS ts, round(value, 6) AS value FROM kl "
        "WHERE metric = 'revenue' AND window_start >= TIMESTAMP '2024-01-10 00:00:00' "
        "AND window_start <= TIMESTAMP '2024-01-20 00:00:00' ORDER BY window_start LIMIT 500"
    ),
)
def kpi_series_iso(spark, sf_dir):
    s = S.kpi_series(_minute_kpi(spark, sf_dir), "revenue", to_ts=SERIES_TO, from_ts=SERIES_FROM, limit=500)
    return finish(S.to_iso_z_columns(s, "window_start").withColumnRenamed("window_start", "ts"), ("value",))


@register(
    "kpi_constraints",
    O.with_ctes(*_hour_kpi_ctes())
    + """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(DISTINCT (window_start, metric)) AS BIGINT) AS n_keys,
  CAST(count(*) FILTER (WHERE window_start IS NULL OR metric IS NULL OR value IS NULL) AS BIGINT) AS n_null_values
FROM kl""",
)
def kpi_constraints(spark, sf_dir):
    """K7: primary key (window_start, metric) and NOT NULL on the KPI table."""
    return T.constraint_report(_hour_kpi(spark, sf_dir), ["window_start", "metric"], ["window_start", "metric", "value"])


@register(
    "alert_constraints",
    _det_sql(
        DET,
        "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT alert_id) AS BIGINT) AS n_keys, CAST(count(*) FILTER "
        "(WHERE alert_id IS NULL OR window_start IS NULL OR metric IS NULL OR severity IS NULL) AS BIGINT) AS n_null_values FROM alerts_rows",
    ),
)
def alert_constraints(spark, sf_dir):
    """K7: primary key and NOT NULL of the alert table, checked as it is
    written: the alerts of each write pass through the checked append."""
    path = P.scratch(spark, "checked-alerts")
    alerts = D.detect(_hour_kpi(spark, sf_dir), DET)
    for half in (F.col("window_start") < CUTOFF, F.col("window_start") >= CUTOFF):
        T.checked_append(alerts.filter(half), path, ["alert_id"], ("window_start", "metric", "severity"), write_alerts)
    return T.constraint_report(spark.read.parquet(path), ["alert_id"], ["alert_id", "window_start", "metric", "severity"])


@register(
    "orders_daily",
    """
SELECT time_bucket(INTERVAL '1 day', o_orderdate) AS window_start, o_orderstatus,
  CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 6) AS total_price
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2""",
)
def orders_daily(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    out = K.window_aggregate(
        o,
        "o_orderdate",
        "1 day",
        {"n_orders": F.count(F.lit(1)), "total_price": F.sum("o_totalprice")},
        keys=("o_orderstatus",),
    )
    return finish(out, ("total_price",))
