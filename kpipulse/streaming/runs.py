"""End-to-end streaming run over a file-landed topic.

``land_topic`` writes the broker envelope rows derived from the driver's
``events`` table into a folder (the stand-in for the topic: the Kafka
connector is not on this classpath). ``run_stream_pipeline`` then runs Bronze,
Silver + Quarantine and Gold as Structured Streaming queries with
``availableNow`` triggers, each with its own checkpoint, and returns the
output folders. All folders live under a fresh child of the session's
checkpoint folder.
"""

from __future__ import annotations

from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import files as FS
from ..sources.fixture import contract_events
from . import jobs as J


@dataclass
class StreamPaths:
    root: str
    topic: str
    bronze: str
    silver: str
    quarantine: str
    kpi: str

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def candidates(self) -> str:
        return f"{self.root}/candidates"

    def ckpt(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def new_paths(spark: SparkSession, name: str = "stream") -> StreamPaths:
    root = scratch_dir(spark, name)
    return StreamPaths(root, f"{root}/topic", f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", f"{root}/kpi")


ROWS_PER_FILE = 250_000


def files_for(rows: int) -> int:
    """How many files ``rows`` make, at most ``ROWS_PER_FILE`` in each: a task
    writes one file, so what it holds does not follow the size of the table."""
    return max(1, -(-rows // ROWS_PER_FILE))


def write_files(df: DataFrame, path: str, files: int) -> None:
    """Append ``df`` to ``path`` as exactly ``files`` files of about as many
    rows (empty ones if rows are few), so that a stream that reads so many per
    micro-batch gets one call's rows at a time. Rows are dealt by their number:
    copies go apart, and nothing is sorted as before a round-robin."""
    spark = df.sparkSession
    count = lambda: sum(f.endswith(".parquet") for f in FS.child_files(spark, path))
    before = count()
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartition(files, "_row").drop("_row")
    dealt.write.mode("append").parquet(path)
    for _ in range(before + files - count()):
        spark.createDataFrame([], df.schema).write.mode("append").parquet(path)


def land_topic(spark: SparkSession, sf_dir: str, path: str, files: int | None = None, raw: bool = False) -> None:
    """The events as topic rows: the six-column envelope, or with ``raw`` the
    columns a broker gives (binary key and value)."""
    df = contract_events(spark, sf_dir)
    if raw:
        df = df.selectExpr(
            "CAST(kafka_key AS BINARY) AS key",
            "CAST(raw_json AS BINARY) AS value",
            "kafka_topic AS topic",
            "kafka_partition AS partition",
            "kafka_offset AS offset",
            "kafka_timestamp AS timestamp",
        )
    if files:
        write_files(df, path, files)
    else:
        df.write.mode("append").parquet(path)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> None:
    """Settings the streaming stages need: UTC event times, and the dedupe
    state in RocksDB rather than on the heap, of which a micro-batch stores
    its changes only."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


STATE_BYTES = 16 << 20


def state_partitions(spark: SparkSession, path: str, least: int = 4) -> int:
    """Shuffle width for the stateful stages of a run over the files in
    ``path``: one partition per ``STATE_BYTES`` stored, at least ``least``, at
    most the session's. Every partition commits a state store and writes a
    file per date folder, so a small backlog should not be spread thin."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, max(least, -(-FS.size(spark, path) // STATE_BYTES))))


SPLIT_BYTES = 8 << 20


@contextmanager
def _set(spark: SparkSession, key: str, value: str):
    """The setting that queries started inside get (a query keeps that of its
    first start)."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _shuffle_width(spark: SparkSession, width: int):
    return _set(spark, "spark.sql.shuffle.partitions", str(width))


def _finish(*queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def run_stream_pipeline(
    spark: SparkSession,
    sf_dir: str,
    paths: StreamPaths | None = None,
    stages: tuple[str, ...] = ("bronze", "silver", "gold"),
    width: str = "1 minute",
    watermark: str = "1 hour",
    dedupe: str = "within_watermark",
    max_files_per_trigger: int | None = None,
    land: bool = True,
    by_hour: bool = False,
    detector=None,
    raw: bool = False,
    compact_every: int | None = 40,
) -> StreamPaths:
    """Run the streaming stages over the landed topic (availableNow).

    ``max_files_per_trigger`` rate-limits every stage's file source (ST8), so
    a backlog is worked off in many micro-batches. ``by_hour=False`` keeps the
    hour as a column, which suits backfills of sparse data. ``raw``: the topic
    holds broker rows with binary key and value. Stage ``detect`` is the
    one-query detector, ``detect_keyed`` candidates and a keyed cooldown."""
    configure(spark)
    paths = paths or new_paths(spark)
    if land:
        land_topic(spark, sf_dir, paths.topic, raw=raw)
    # a sink sorts what a task read by partition folder: small splits, whatever a micro-batch holds
    splits = _set(spark, "spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES)) if raw else nullcontext()
    with _shuffle_width(spark, state_partitions(spark, paths.topic)), splits:
        _run_stages(spark, paths, stages, width, watermark, dedupe, max_files_per_trigger, by_hour, detector, raw, compact_every)
    return paths


def _run_stages(spark, paths, stages, width, watermark, dedupe, max_files_per_trigger, by_hour, detector, raw, compact_every) -> None:
    if "bronze" in stages:
        env = J.envelope_file_source(spark, paths.topic, max_files_per_trigger, raw)
        _finish(J.bronze_query(env, paths.bronze, paths.ckpt("bronze"), by_hour=by_hour))
    if "silver" in stages:
        bronze = J.parquet_stream(spark, paths.bronze, J.BRONZE_READ_SCHEMA, max_files_per_trigger)
        _finish(
            *J.silver_queries(
                bronze,
                paths.silver,
                paths.quarantine,
                paths.ckpt("silver"),
                paths.ckpt("quarantine"),
                watermark=watermark,
                dedupe=dedupe,
                by_hour=by_hour,
            )
        )
    if "gold" in stages:
        silver = J.parquet_stream(spark, paths.silver, J.SILVER_READ_SCHEMA, max_files_per_trigger)
        _finish(J.gold_query(silver, paths.kpi, paths.ckpt("gold"), width=width, watermark=watermark, compact_every=compact_every))
    if "detect" in stages:
        from .detector import detector_query

        _finish(detector_query(spark, paths.kpi, paths.alerts, paths.ckpt("detector"), detector, max_files_per_trigger=max_files_per_trigger))
    if "detect_keyed" in stages:
        from .detector import alerts_query, candidates_query

        _finish(candidates_query(spark, paths.kpi, paths.candidates, paths.ckpt("candidates"), detector, max_files_per_trigger=max_files_per_trigger))
        _finish(alerts_query(spark, paths.candidates, paths.alerts, paths.ckpt("alerts"), detector))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def start_pipeline(
    spark: SparkSession,
    envelope: DataFrame,
    paths: StreamPaths,
    trigger: str = "15 seconds",
    width: str = "1 minute",
    watermark: str = "1 hour",
    dedupe: str = "within_watermark",
    detector=None,
    max_files_per_trigger: int | None = 50,
    by_hour: bool = True,
) -> list:
    """The deployment form: every stage as a concurrently running query with a
    processing-time trigger, each reading the folder the previous stage
    writes. ``envelope`` is the topic stream (``jobs.kafka_source`` on a
    cluster). Returns the started queries in stage order; ``await_any``
    blocks until one of them ends. ``max_files_per_trigger`` bounds what a
    micro-batch of Silver, Gold and the detector reads."""
    configure(spark)
    for folder in (paths.bronze, paths.silver, paths.kpi):
        FS.mkdirs(spark, folder)
    queries = [J.bronze_query(envelope, paths.bronze, paths.ckpt("bronze"), trigger=trigger, by_hour=by_hour)]
    bronze = J.parquet_stream(spark, paths.bronze, J.BRONZE_READ_SCHEMA, max_files_per_trigger)
    queries += list(
        J.silver_queries(
            bronze, paths.silver, paths.quarantine, paths.ckpt("silver"), paths.ckpt("quarantine"),
            watermark=watermark, dedupe=dedupe, trigger=trigger, by_hour=by_hour,
        )
    )
    silver = J.parquet_stream(spark, paths.silver, J.SILVER_READ_SCHEMA, max_files_per_trigger)
    queries.append(
        J.gold_query(silver, paths.kpi, paths.ckpt("gold"), width=width, watermark=watermark, trigger=trigger)
    )
    if detector is not None:
        from .detector import alerts_query, candidates_query

        how = {"trigger": trigger, "max_files_per_trigger": max_files_per_trigger}
        queries.append(candidates_query(spark, paths.kpi, paths.candidates, paths.ckpt("candidates"), detector, **how))
        queries.append(alerts_query(spark, paths.candidates, paths.alerts, paths.ckpt("alerts"), detector, **how))
    return queries


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any active streaming query ends (or the timeout passes)."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout_s)
