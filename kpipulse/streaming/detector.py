"""Streaming detector: new KPI versions -> alerts, insert-if-absent.

A Structured Streaming query over the versioned KPI folder written by
``jobs.gold_query``. Each micro-batch holds the KPI rows of newly written
versions; the ``foreachBatch`` callback

1. takes the windows of the batch that are newer than any window polled
   before as the polls to run (each such window ``u`` is "the newest window a
   poll sees", so its predecessor gets scored); re-emitted and late windows
   are not polled again, so each window is scored once,
2. reads the current KPI rows in ``[min(u) - lookback, max(u)]`` (the dates
   are chosen in the table's manifest and a range filter reaches the scan: the
   read is bounded by the batch span plus one lookback, not by the table),
3. scores those polls with ``score_all``, applies the threshold and the
   cooldown seeded from the newest stored alert per metric,
4. appends only alert ids that are not in the table yet (the read is bounded
   by date, from one cooldown before the batch's history range onward), one
   file per alert date,
5. records the newest window polled in a commit log, of which a batch reads
   the newest record (a replayed one the record before its own); a replayed
   batch looks at earlier batches only, so it runs the same polls again and
   inserts nothing twice.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import DetectorParams
from ..operators import detect as D
from ..operators.kpi_store import VERSION_SCHEMA, KpiStore
from ..sources import files as FS
from ..sources.log import CommitLog
from .cooldown import CANDIDATE_SCHEMA, keyed_cooldown
from .jobs import _trigger


def candidate_batch(new_kpi: DataFrame, kpi: DataFrame, p: DetectorParams, polled: datetime | None = None) -> DataFrame:
    """Candidates of the polls whose newest window is in ``new_kpi`` and after
    ``polled`` (the newest window polled before); ``kpi`` is the current KPI
    table."""
    polls, lo, hi = _polls(new_kpi, p, polled)
    wanted = (F.col("window_start") >= lo) & (F.col("window_start") <= hi)
    if "window_date" in kpi.columns:
        wanted &= (F.col("window_date") >= F.to_date(lo)) & (F.col("window_date") <= F.to_date(hi))
    return D.candidates(D.score_all(kpi.filter(wanted), p, polls=polls), p)


def _polls(new_kpi: DataFrame, p: DetectorParams, polled: datetime | None):
    """The polls of a batch, and the range of windows that they look at."""
    polls = new_kpi.select(F.col("window_start").alias("poll_window")).distinct()
    if polled is not None:
        polls = polls.filter(F.col("poll_window") > F.lit(polled))
    lo = polls.select(F.min("poll_window")).scalar() - F.make_interval(secs=F.lit(float(p.lookback_s)))
    return polls, lo, polls.select(F.max("poll_window")).scalar()


def detect_batch(
    spark: SparkSession,
    new_kpi: DataFrame,
    kpi: DataFrame,
    alerts: DataFrame | None,
    p: DetectorParams,
    polled: datetime | None = None,
) -> DataFrame:
    """Alert rows to insert for the polls whose newest window is in
    ``new_kpi`` and after ``polled`` (the newest window polled before).

    ``kpi`` is the current KPI table, ``alerts`` the stored alerts (or None).
    """
    found = candidate_batch(new_kpi, kpi, p, polled)
    if alerts is None:
        return D.alerts_from(D.apply_cooldown(found, p), p)
    # the newest alert of a metric decides; one more than a cooldown before the
    # first scored window suppresses nothing, so older dates are not read
    lo = _polls(new_kpi, p, polled)[1]
    since = lo - F.make_interval(secs=F.lit(float(p.cooldown_s)))
    recent = alerts.filter(F.col("window_start") >= since)
    if "window_date" in alerts.columns:
        recent = recent.filter(F.col("window_date") >= F.to_date(since))
    fresh = D.alerts_from(D.apply_cooldown(found, p, D.last_alert_per_metric(recent, p.rule_name)), p)
    return fresh.join(recent.select("alert_id"), "alert_id", "left_anti")


def write_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Alert rows partitioned by date, one file per date and write."""
    dated = alerts.withColumn("window_date", F.to_date("window_start"))
    rows = dated.repartition("window_date").sortWithinPartitions("window_date", F.desc("window_start"), "metric")
    rows.write.mode(mode).partitionBy("window_date").parquet(path)


def _time(micros: int | None) -> datetime | None:
    """Epoch microseconds as PySpark hands timestamps to Python."""
    return None if micros is None else datetime.fromtimestamp(micros // 1_000_000) + timedelta(microseconds=micros % 1_000_000)


def _record_before(log: CommitLog, batch_id: int) -> dict | None:
    """The newest record of a batch before ``batch_id``: the last one, or for
    a replayed batch the one before its own."""
    n, body = log.last() or (0, None)
    while body is not None and body["batch"] >= batch_id:
        n -= 1
        body = log.get(n)
    return body


def polled_before(spark: SparkSession, path: str, batch_id: int) -> datetime | None:
    """Newest window polled by the batches before ``batch_id``."""
    body = _record_before(CommitLog(spark, path), batch_id)
    return None if body is None else _time(body["newest"])


def _poll_sink(spark: SparkSession, kpi_path: str, checkpoint: str, p: DetectorParams, step):
    """A ``foreachBatch`` function that runs ``step(new, kpi, polled,
    batch_id)`` on batches with windows newer than any polled before, and
    records the newest window polled."""
    store, log = KpiStore(spark, kpi_path), CommitLog(spark, checkpoint.rstrip("/") + ".polls")

    def sink(batch: DataFrame, batch_id: int) -> None:
        micros = F.unix_micros("window_start")
        ends = batch.agg(F.min(micros).alias("oldest"), F.max(micros).alias("newest")).first()
        if ends["newest"] is None:
            return
        before = _record_before(log, batch_id)
        polled = None if before is None else before["newest"]
        if polled is None or ends["newest"] > polled:
            kpi = store.read(*_dates(max(ends["oldest"], polled or ends["oldest"]), ends["newest"], p))
            step(batch.select("window_start", "metric", "value"), kpi, _time(polled), batch_id)
        last = log.last()
        if last is None or last[1]["batch"] < batch_id:
            log.append(1 if last is None else last[0] + 1, {"batch": batch_id, "newest": max(ends["newest"], polled or 0)})

    return sink


def detector_query(
    spark: SparkSession,
    kpi_path: str,
    alerts_path: str,
    checkpoint: str,
    p: DetectorParams = DetectorParams(),
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """One query, the cooldown seeded from the alert table in every batch."""

    def step(new: DataFrame, kpi: DataFrame, polled: datetime | None, batch_id: int) -> None:
        alerts = read_alerts(spark, alerts_path) if FS.exists(spark, alerts_path) else None
        write_alerts(detect_batch(spark, new, kpi, alerts, p, polled), alerts_path)

    versions = version_stream(spark, kpi_path, max_files_per_trigger)
    w = versions.writeStream.foreachBatch(_poll_sink(spark, kpi_path, checkpoint, p, step)).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def candidates_query(
    spark: SparkSession,
    kpi_path: str,
    candidates_path: str,
    checkpoint: str,
    p: DetectorParams = DetectorParams(),
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """New KPI versions -> candidates, one folder per micro-batch."""

    def step(new: DataFrame, kpi: DataFrame, polled: datetime | None, batch_id: int) -> None:
        names = [f.split()[0] for f in CANDIDATE_SCHEMA.split(", ")]
        found = candidate_batch(new, kpi, p, polled).select(*names)
        found.coalesce(1).write.mode("overwrite").parquet(f"{candidates_path}/batch={batch_id}")

    versions = version_stream(spark, kpi_path, max_files_per_trigger)
    w = versions.writeStream.foreachBatch(_poll_sink(spark, kpi_path, checkpoint, p, step)).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def alerts_query(
    spark: SparkSession,
    candidates_path: str,
    alerts_path: str,
    checkpoint: str,
    p: DetectorParams = DetectorParams(),
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Candidates -> cooldown in keyed state -> alert table, insert-if-absent.
    The alerts stored when the checkpoint is new are the initial clocks; after
    that only ids of the dates that a batch inserts to are looked up."""
    stored = read_alerts(spark, alerts_path) if FS.exists(spark, alerts_path) else spark.createDataFrame([], ALERT_SCHEMA)
    seeds = D.last_alert_per_metric(stored.select("metric", "window_start", "rule_name"), p.rule_name)
    if FS.exists(spark, f"{checkpoint}/offsets"):
        seeds = seeds.filter("false")  # the state store has the clocks
    FS.mkdirs(spark, candidates_path)
    r = spark.readStream.format("parquet").schema(CANDIDATE_SCHEMA + ", batch int").option("basePath", candidates_path)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    candidates = r.load(candidates_path).drop("batch")

    def sink(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # the state must be stepped once
        try:
            insert_alerts(spark, kept, alerts_path)
        finally:
            kept.unpersist()

    alerts = D.alerts_from(keyed_cooldown(candidates, p, seeds), p)
    w = alerts.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def insert_alerts(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Append the alerts whose id is not stored yet (K6); reads the ids of the
    dates that ``new`` spans."""
    day = F.to_date("window_start")
    ends = new.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    if ends["lo"] is None:
        return
    if FS.exists(spark, path):
        there = read_alerts(spark, path).filter(F.col("window_date").between(ends["lo"], ends["hi"]))
        new = new.join(there.select("alert_id"), "alert_id", "left_anti")
    write_alerts(new, path)


def version_stream(spark: SparkSession, kpi_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The versions of the KPI table as a stream (merged files are hidden)."""
    r = spark.readStream.format("parquet").schema(VERSION_SCHEMA).option("basePath", kpi_path)
    r = r.option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(kpi_path)


def _dates(oldest: int, newest: int, p: DetectorParams) -> tuple[datetime, datetime]:
    """First and last date that polls of windows between two times read."""
    at = lambda micros: datetime.fromtimestamp(micros // 1_000_000, timezone.utc)
    return at(oldest) - timedelta(seconds=p.lookback_s), at(newest)


ALERT_SCHEMA = (
    "alert_id string, created_at timestamp, window_start timestamp, metric string, value double, baseline double, "
    "score double, severity string, rule_name string, details string, window_date date"
)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALERT_SCHEMA).option("basePath", path).parquet(path)
