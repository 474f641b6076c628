"""Bronze: broker envelope -> typed event rows with lineage.

All steps are narrow projections; the plan is one whole-stage-codegen span
over the scan, so it runs per partition at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import EVENT_FIELDS, EVENT_SCHEMA
from ..functions.columns import parse_event_ts


def lineage_projection(raw: DataFrame) -> DataFrame:
    """Raw broker rows (``key, value`` binary, ``topic, partition, offset,
    timestamp``) -> the six-column envelope."""
    return raw.selectExpr(
        "CAST(key AS STRING) AS kafka_key",
        "CAST(value AS STRING) AS raw_json",
        "topic AS kafka_topic",
        "partition AS kafka_partition",
        "offset AS kafka_offset",
        "timestamp AS kafka_timestamp",
    )


def parse_events(envelope: DataFrame) -> DataFrame:
    """Permissive JSON parse with the fixed event schema, flattened.

    Unparsable JSON gives all-null fields and the row is kept; a field of the
    wrong type is null while the others survive.
    """
    parsed = envelope.withColumn("json", F.from_json(F.col("raw_json"), EVENT_SCHEMA))
    return parsed.select(
        "kafka_key",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "raw_json",
        *[F.col(f"json.{f}").alias(f) for f in EVENT_FIELDS],
    )


def to_bronze(envelope: DataFrame) -> DataFrame:
    """Bronze table rows: parsed payload plus ingest time, its date / hour
    partition columns and the batch processing time."""
    flat = parse_events(envelope)
    return (
        flat.withColumn("ingest_time_ts", parse_event_ts("ingest_time"))
        .withColumn("ingest_date", F.to_date("ingest_time_ts"))
        .withColumn("ingest_hour", F.hour("ingest_time_ts"))
        .withColumn("processing_time", F.current_timestamp())
    )
