"""Structured Streaming jobs: Bronze, Silver + Quarantine, Gold.

Each job wires the same DataFrame operators the batch plans use into a
``readStream`` -> ``writeStream`` query with its own checkpoint:

* ``bronze_query``: topic -> typed rows, parquet partitioned by ingest date /
  hour, append.
* ``silver_queries``: Bronze files -> rules -> two queries: valid rows with
  watermark + dedupe by ``event_id`` (append, partitioned by event date /
  hour) and invalid rows with reasons (append, partitioned by ingest date /
  hour). Each has its own checkpoint; only Silver holds state.
* ``gold_query``: Silver files -> watermark -> windowed KPIs in update mode ->
  ``foreachBatch`` that commits the batch as a version of the KPI table
  (``kpi_store``) and merges versions now and then; readers keep the newest
  version per window.

Dedupe modes: ``within_watermark`` (default; state is evicted once the
watermark passes, so it runs forever) or ``exact`` (``dropDuplicates`` with
the event time outside the key: repeats are suppressed forever, state grows
without bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from ..contract import ENVELOPE_SCHEMA, EVENT_SCHEMA
from ..operators.bronze import lineage_projection, to_bronze
from ..operators.kpis import kpis_long
from ..operators.kpi_store import RETAIN_S, KpiStore
from ..operators.tables import read_versioned
from ..operators.validate import default_rules, quarantine, valid_rows, validate
from ..sources import files as FS
from .progress import observe_rules

# Bronze columns Silver reads (explicit schema, no inference).
BRONZE_READ_SCHEMA = StructType(
    list(EVENT_SCHEMA.fields)
    + [
        StructField("raw_json", StringType(), True),
        StructField("kafka_topic", StringType(), True),
        StructField("kafka_offset", ENVELOPE_SCHEMA["kafka_offset"].dataType, True),
        StructField("kafka_partition", IntegerType(), True),
        StructField("kafka_key", StringType(), True),
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("ingest_date", DateType(), True),
        StructField("ingest_hour", IntegerType(), True),
    ]
)

# Silver columns Gold reads.
SILVER_READ_SCHEMA = StructType(
    [
        StructField("event_time_ts", TimestampType(), True),
        StructField("event_type", StringType(), True),
        StructField("price", DoubleType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("event_date", DateType(), True),
        StructField("event_hour", IntegerType(), True),
    ]
)


def kafka_source(spark: SparkSession, brokers: str, topic: str, starting_offsets: str = "earliest", fail_on_data_loss: bool = True) -> DataFrame:
    """Broker topic as a stream (needs the Kafka connector on the classpath).
    ``fail_on_data_loss=False`` goes on when the broker has dropped offsets."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )
    return lineage_projection(raw)


RAW_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def envelope_file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, raw: bool = False) -> DataFrame:
    """Envelope rows landed as parquet files; with ``raw`` the rows a broker
    gives, which go through the same lineage projection as a topic."""
    r = spark.readStream.schema(RAW_SCHEMA if raw else ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return lineage_projection(r.parquet(path)) if raw else r.parquet(path)


def parquet_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Partitioned parquet folder as a stream, explicit schema and base path.
    Files removed between listing and reading (retention) are skipped here, on
    the stream source only."""
    r = spark.readStream.format("parquet").schema(schema).option("basePath", path).option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def folders(date: str, hour: str, by_hour: bool) -> list[str]:
    """Partition folders of a sink. Hour folders suit dense live streams,
    whose micro-batches span an hour or two; sparse backfills span hundreds,
    and keep the hour as a column instead. Either way a task writes what it
    has: the width of the write is that of the input (or of the dedupe
    shuffle), with no further shuffle and no fixed number of writers."""
    return [date, hour] if by_hour else [date]


def bronze_query(envelope: DataFrame, out_path: str, checkpoint: str, trigger: str | None = None, by_hour: bool = True) -> StreamingQuery:
    """Bronze sink: narrow, no shuffle."""
    w = (
        to_bronze(envelope)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*folders("ingest_date", "ingest_hour", by_hour))
    )
    return _trigger(w, trigger).start()


def silver_frames(bronze: DataFrame, watermark: str = "1 hour", dedupe: str = "within_watermark", null_type: str = "invalid"):
    """(silver, quarantine) streaming DataFrames from a Bronze stream. The
    quarantine query, which reads every row, observes the rule counts."""
    rules = default_rules(null_type)
    v = validate(bronze, rules)
    bad = quarantine(observe_rules(v, rules))
    good = valid_rows(v).withWatermark("event_time_ts", watermark)
    if dedupe == "within_watermark":
        good = good.dropDuplicatesWithinWatermark(["event_id"])
    elif dedupe == "exact":
        good = good.dropDuplicates(["event_id"])
    elif dedupe != "none":
        raise ValueError("dedupe must be within_watermark, exact or none")
    return good, bad


def silver_queries(
    bronze: DataFrame,
    silver_path: str,
    quarantine_path: str,
    silver_ckpt: str,
    quarantine_ckpt: str,
    watermark: str = "1 hour",
    dedupe: str = "within_watermark",
    trigger: str | None = None,
    by_hour: bool = True,
) -> tuple[StreamingQuery, StreamingQuery]:
    good, bad = silver_frames(bronze, watermark, dedupe)
    qq = _trigger(
        bad.writeStream.format("parquet")
        .outputMode("append")
        .option("path", quarantine_path)
        .option("checkpointLocation", quarantine_ckpt)
        .partitionBy(*folders("ingest_date", "ingest_hour", by_hour)),
        trigger,
    ).start()
    qs = _trigger(
        good.writeStream.format("parquet")
        .outputMode("append")
        .option("path", silver_path)
        .option("checkpointLocation", silver_ckpt)
        .partitionBy(*folders("event_date", "event_hour", by_hour)),
        trigger,
    ).start()
    return qs, qq


def run_id(spark: SparkSession, checkpoint: str, kpi_path: str) -> int:
    """Version number of this checkpoint's lineage of KPI batches.

    Kept in ``<checkpoint>.run`` (any Hadoop file system). A restart of the
    same checkpoint reuses it, so a replayed batch is known; a new checkpoint
    takes one more than the newest run committed to ``kpi_path``, so its
    batches supersede the old ones.
    """
    marker = checkpoint.rstrip("/") + ".run"
    txt = FS.read_text(spark, marker)
    if txt is not None and FS.exists(spark, checkpoint):
        return int(txt.strip())
    run = max(0, KpiStore(spark, kpi_path).snapshot()[1].newest[0]) + 1
    FS.write_text(spark, marker, str(run))
    return run


def gold_frame(silver: DataFrame, width: str = "1 minute", watermark: str = "1 hour") -> DataFrame:
    df = silver.filter(F.col("event_time_ts").isNotNull()).withWatermark("event_time_ts", watermark)
    return kpis_long(df, width)


def gold_query(
    silver: DataFrame,
    kpi_path: str,
    checkpoint: str,
    width: str = "1 minute",
    watermark: str = "1 hour",
    trigger: str | None = None,
    compact_every: int | None = 40,
    retain_s: float = RETAIN_S,
) -> StreamingQuery:
    """Windowed KPIs in update mode; each micro-batch is a version of the KPI
    table, and ``compact_every`` versions are merged into a file per date."""
    store = KpiStore(silver.sparkSession, kpi_path)
    run = run_id(silver.sparkSession, checkpoint, kpi_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.commit(batch, run, batch_id, compact_every, retain_s)

    w = gold_frame(silver, width, watermark).writeStream.outputMode("update").foreachBatch(sink).option(
        "checkpointLocation", checkpoint
    )
    return _trigger(w, trigger).start()


def read_kpi(spark: SparkSession, kpi_path: str) -> DataFrame:
    return read_versioned(spark, kpi_path).drop("window_date")
