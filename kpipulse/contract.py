"""Event contract v1: schemas, rule codes, KPI names and detector defaults.

Everything in the "fixed values" blocks must stay exactly as written: the
codes, names and formats are part of the data contract that downstream
tables and readers rely on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (contract v1) -- do not edit.
# ---------------------------------------------------------------------------
TOPIC = "ecom.events.raw.v1"

# Event types accepted by the contract, in contract order.
EVENT_TYPES = ("click", "add_to_cart", "checkout", "purchase")

# Primary timestamp format of event_time / ingest_time (ISO-8601, millis, zone).
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"

# Validation error codes, in the order they appear in the comma string.
ERR_MISSING_EVENT_ID = "missing_event_id"
ERR_INVALID_EVENT_TYPE = "invalid_event_type"
ERR_MISSING_USER_ID = "missing_user_id"
ERR_MISSING_SESSION_ID = "missing_session_id"
ERR_BAD_INGEST_TIME = "bad_ingest_time"
ERR_BAD_EVENT_TIME = "bad_event_time"
ERR_PRODUCT_FOR_CLICK_CART = "product_id_required_for_click_or_cart"
ERR_CART_FIELDS = "add_to_cart_requires_qty_price_currency"
ERR_PURCHASE_FIELDS = "purchase_requires_order_qty_price_currency"

# KPI metric names, in output order.
KPI_METRICS = (
    "events_total",
    "events_click",
    "events_add_to_cart",
    "events_checkout",
    "events_purchase",
    "revenue",
    "aov",
    "add_to_cart_rate",
    "checkout_rate",
    "purchase_conversion",
)

# Detector defaults (code defaults of the contract's detector).
DETECT_METRICS = (
    "events_total",
    "events_purchase",
    "revenue",
    "purchase_conversion",
    "add_to_cart_rate",
)
# Extra metrics loaded only for the rate guard.
GUARD_METRICS = ("events_click", "events_add_to_cart", "events_checkout")
RULE_NAME = "ewma_zscore_v1"
DETAILS_METHOD = "ewma+zscore(residual)"
SEVERITY_WARNING = "warning"
SEVERITY_CRITICAL = "critical"

# The 13 payload fields of a raw event, all nullable.
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_version", IntegerType(), True),
        StructField("event_type", StringType(), True),
        StructField("event_time", StringType(), True),
        StructField("ingest_time", StringType(), True),
        StructField("user_id", StringType(), True),
        StructField("session_id", StringType(), True),
        StructField("product_id", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("price", DoubleType(), True),
        StructField("currency", StringType(), True),
        StructField("order_id", StringType(), True),
        StructField("source", StringType(), True),
    ]
)
EVENT_FIELDS = tuple(f.name for f in EVENT_SCHEMA.fields)

# Broker envelope after the lineage projection.
ENVELOPE_SCHEMA = StructType(
    [
        StructField("kafka_key", StringType(), True),
        StructField("raw_json", StringType(), True),
        StructField("kafka_topic", StringType(), True),
        StructField("kafka_partition", IntegerType(), True),
        StructField("kafka_offset", LongType(), True),
        StructField("kafka_timestamp", TimestampType(), True),
    ]
)


# Column order of the quarantine table.
QUARANTINE_COLUMNS = (
    "raw_json",
    "validation_errors",
    "processing_time",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_key",
    "event_id",
    "event_type",
    "user_id",
    "session_id",
    "event_time_ts",
    "ingest_time_ts",
    "ingest_date",
    "ingest_hour",
)
# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DetectorParams:
    """Settings of the EWMA + rolling z-score detector.

    Durations are in seconds so they can drive range frames directly.
    ``lookback`` is the history each poll loads; ``rolling`` the number of
    residuals before the scored point that give mu and sigma.
    """

    metrics: tuple[str, ...] = DETECT_METRICS
    lookback_s: int = 180 * 60
    rolling: int = 60
    alpha: float = 0.2
    warn_z: float = 3.0
    crit_z: float = 5.0
    cooldown_s: int = 10 * 60
    ignore_recent_s: int = 60
    min_denom_clicks: int = 50
    min_denom_add_to_cart: int = 30
    rule_name: str = RULE_NAME
    # sigma at or below this fraction of max(1, |baseline|) counts as zero;
    # set exact_zero to divide by any non-zero sigma.
    sigma_eps: float = 1e-12
    exact_zero: bool = False
