"""``contract_events``: the driver's ``events`` table as a contract-v1 topic.

The derivation is one SQL text with dialect slots, rendered once for Spark and
once for DuckDB, so the Spark pipeline and the DuckDB oracle start from the
same rows. Every row of ``events`` becomes one broker message (envelope +
JSON payload) with faults planted deterministically from the event id ``e``;
rows with ``e % 50 = 0`` are re-sent once more (duplicates).

Output columns: the broker envelope after the lineage projection
(``kafka_key, raw_json, kafka_topic, kafka_partition, kafka_offset,
kafka_timestamp``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..contract import TOPIC

# Dialect slots.
_SPARK = {
    "str": "STRING",
    "unroll": "explode",
    "pair": "array(0, 1)",
    "one": "array(0)",
    "k": "CAST(get_json_object(props, '$.k') AS INT)",
    "millis": "date_format({t}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
    "secs": "date_format({t}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "plus": "({t} + make_interval(0, 0, 0, 0, 0, 0, {n}))",
}
_DUCK = {
    "str": "VARCHAR",
    "unroll": "unnest",
    "pair": "[0, 1]",
    "one": "[0]",
    "k": "CAST(json_extract_string(props, '$.k') AS INTEGER)",
    "millis": "strftime({t}, '%Y-%m-%dT%H:%M:%S.%gZ')",
    "secs": "strftime({t}, '%Y-%m-%dT%H:%M:%SZ')",
    "plus": "({t} + to_seconds({n}))",
}

_TEMPLATE = """
WITH src AS (
  SELECT event_id AS e, ts, user_id AS u, value AS v, {k} AS k,
         CASE event_type
           WHEN 'view' THEN 'add_to_cart'
           WHEN 'signup' THEN 'checkout'
           WHEN 'error' THEN CASE WHEN event_id % 5 = 0 THEN 'invalid_event_type' ELSE 'click' END
           ELSE event_type
         END AS et
  FROM {events}
),
copies AS (
  SELECT src.*, {unroll}(CASE WHEN e % 50 = 0 THEN {pair} ELSE {one} END) AS dup FROM src
),
fields AS (
  SELECT
    e, u, ts, dup,
    CASE WHEN e % 97 = 13 THEN NULL ELSE CAST(e AS {str}) END AS event_id,
    CASE WHEN e % 211 = 5 THEN NULL ELSE et END AS event_type,
    CASE
      WHEN e % 53 = 7 THEN {millis_late}
      WHEN e % 499 = 3 THEN 'not-a-time'
      WHEN e % 89 = 11 THEN {secs_ts}
      ELSE {millis_ts}
    END AS event_time,
    CASE WHEN e % 997 = 1 THEN 'bad' ELSE {millis_ingest} END AS ingest_time,
    CASE WHEN e % 307 = 2 THEN NULL ELSE 'user_' || lpad(CAST(u AS {str}), 4, '0') END AS user_id,
    CASE WHEN e % 401 = 9 THEN NULL
         ELSE 's-' || CAST(u AS {str}) || '-' || CAST(CAST(ts AS DATE) AS {str}) END AS session_id,
    CASE WHEN et = 'checkout' OR e % 61 = 4 THEN NULL
         ELSE 'sku_' || lpad(CAST(k AS {str}), 5, '0') END AS product_id,
    CASE WHEN et IN ('add_to_cart', 'purchase')
         THEN CASE WHEN e % 71 = 6 THEN -1 ELSE CAST(e % 5 + 1 AS INT) END END AS quantity,
    CASE WHEN et IN ('add_to_cart', 'purchase')
         THEN CASE WHEN e % 83 = 8 THEN -v ELSE v END END AS price,
    CASE WHEN et IN ('add_to_cart', 'purchase') AND e % 131 <> 10 THEN 'EUR' END AS currency,
    CASE WHEN et = 'purchase' AND e % 43 <> 12 THEN 'ord_' || CAST(e AS {str}) END AS order_id
  FROM copies
)
SELECT
  CAST(u AS {str}) AS kafka_key,
  '{{' ||
  '"event_id":' || coalesce('"' || event_id || '"', 'null') ||
  ',"event_version":1' ||
  ',"event_type":' || coalesce('"' || event_type || '"', 'null') ||
  ',"event_time":"' || event_time || '"' ||
  ',"ingest_time":"' || ingest_time || '"' ||
  ',"user_id":' || coalesce('"' || user_id || '"', 'null') ||
  ',"session_id":' || coalesce('"' || session_id || '"', 'null') ||
  ',"product_id":' || coalesce('"' || product_id || '"', 'null') ||
  ',"quantity":' || coalesce(CAST(quantity AS {str}), 'null') ||
  ',"price":' || coalesce(CAST(CAST(price AS DECIMAL(14, 2)) AS {str}), 'null') ||
  ',"currency":' || coalesce('"' || currency || '"', 'null') ||
  ',"order_id":' || coalesce('"' || order_id || '"', 'null') ||
  ',"source":"testdata"' ||
  '}}' AS raw_json,
  '{topic}' AS kafka_topic,
  CAST(u % 3 AS INT) AS kafka_partition,
  CAST(e + dup * 1000000000 AS BIGINT) AS kafka_offset,
  ts AS kafka_timestamp
FROM fields
"""


def contract_sql(dialect: str, events: str = "events") -> str:
    """The fixture as SQL text for ``dialect`` in {"spark", "duckdb"}."""
    s = _SPARK if dialect == "spark" else _DUCK
    late = s["plus"].format(t="ts", n="-(e % 600 + 1)")
    ingest = s["plus"].format(t="ts", n="(e % 3 + 60 * dup)")
    return _TEMPLATE.format(
        events=events,
        str=s["str"],
        unroll=s["unroll"],
        pair=s["pair"],
        one=s["one"],
        k=s["k"],
        millis_late=s["millis"].format(t=late),
        secs_ts=s["secs"].format(t="ts"),
        millis_ts=s["millis"].format(t="ts"),
        millis_ingest=s["millis"].format(t=ingest),
        topic=TOPIC,
    )


def contract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker envelope rows derived from ``{sf_dir}/events.parquet``.

    One scan, a projection and an explode for the re-sent copies: no shuffle,
    scales with the events table.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    view = f"kpipulse_events_{abs(hash(sf_dir))}"
    events.createOrReplaceTempView(view)
    df = spark.sql(contract_sql("spark", view))
    return df.selectExpr(
        "kafka_key",
        "raw_json",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "CAST(kafka_timestamp AS TIMESTAMP) AS kafka_timestamp",
    )
