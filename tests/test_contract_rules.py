"""Contract examples, the nine rules (R1-R9), parse edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from core_helpers import envelope_rows
from kpipulse.operators.bronze import to_bronze
from kpipulse.operators.validate import default_rules, quarantine, valid_rows, validate


def base_event(**kw):
    ev = {
        "event_id": "8d51b9e7",
        "event_version": 1,
        "event_type": "click",
        "event_time": "2026-01-24T13:05:12.123Z",
        "ingest_time": "2026-01-24T13:05:12.456Z",
        "user_id": "user_0042",
        "session_id": "9eae3b0f",
        "product_id": "sku_00123",
        "quantity": None,
        "price": None,
        "currency": None,
        "order_id": None,
        "source": "generator",
    }
    ev.update(kw)
    return ev


def run(spark, events, null_type="invalid"):
    payloads = [e if isinstance(e, str) else json.dumps(e) for e in events]
    v = validate(to_bronze(envelope_rows(spark, payloads)), default_rules(null_type))
    rows = v.orderBy("kafka_offset").select("validation_errors", "is_valid", "quantity", "price", "event_id").collect()
    return rows


CART = dict(event_type="add_to_cart", quantity=2, price=39.99, currency="EUR")
PURCHASE = dict(event_type="purchase", quantity=1, price=39.99, currency="EUR", order_id="ord_1")

# The documented examples: four valid, four invalid with one reason each.
EXAMPLES = [
    (base_event(), ""),
    (base_event(**CART), ""),
    (base_event(event_type="checkout", product_id=None), ""),
    (base_event(**PURCHASE), ""),
    (base_event(event_type="invalid_event_type"), "invalid_event_type"),
    (base_event(product_id=None), "product_id_required_for_click_or_cart"),
    (base_event(**{**CART, "quantity": -2, "price": -39.99}), "add_to_cart_requires_qty_price_currency"),
    (base_event(**{**PURCHASE, "order_id": None}), "purchase_requires_order_qty_price_currency"),
]


def test_documented_examples(spark):
    rows = run(spark, [e for e, _ in EXAMPLES])
    assert [r.validation_errors for r in rows] == [want for _, want in EXAMPLES]
    assert [r.is_valid for r in rows] == [want == "" for _, want in EXAMPLES]


@pytest.mark.parametrize(
    "patch,code",
    [
        (dict(event_id=None), "missing_event_id"),
        (dict(event_type="refund"), "invalid_event_type"),
        (dict(user_id=None), "missing_user_id"),
        (dict(session_id=None), "missing_session_id"),
        (dict(ingest_time="bad"), "bad_ingest_time"),
        (dict(event_time="not-a-time"), "bad_event_time"),
        (dict(product_id=None), "product_id_required_for_click_or_cart"),
        (dict(**CART, product_id=None), "product_id_required_for_click_or_cart,add_to_cart_requires_qty_price_currency"),
    ],
)
def test_each_rule(spark, patch, code):
    ev = base_event(**patch)
    if patch.get("product_id", "x") is None and ev["event_type"] == "add_to_cart":
        ev["quantity"] = None
    [row] = run(spark, [ev])
    assert row.validation_errors == code


def test_boundaries(spark):
    evs = [
        base_event(**{**CART, "quantity": 0}),
        base_event(**{**CART, "quantity": 1}),
        base_event(**{**CART, "price": 0.0}),
        base_event(**{**CART, "price": -0.01}),
        base_event(**{**CART, "currency": None}),
        base_event(**{**PURCHASE, "quantity": 0}),
        base_event(**{**PURCHASE, "price": -0.01}),
        base_event(**{**PURCHASE, "product_id": None}),  # not checked for purchase
    ]
    got = [r.validation_errors for r in run(spark, evs)]
    assert got == [
        "add_to_cart_requires_qty_price_currency",
        "",
        "",
        "add_to_cart_requires_qty_price_currency",
        "add_to_cart_requires_qty_price_currency",
        "purchase_requires_order_qty_price_currency",
        "purchase_requires_order_qty_price_currency",
        "",
    ]


def test_null_event_type_option(spark):
    ev = base_event(event_type=None)
    [strict] = run(spark, [ev], "invalid")
    [loose] = run(spark, [ev], "pass")
    assert strict.validation_errors == "invalid_event_type"
    assert loose.validation_errors == "" and loose.is_valid


def test_reason_order_with_many_faults(spark):
    ev = base_event(event_id=None, user_id=None, session_id=None, ingest_time="x", event_time="y", event_type="bogus")
    [row] = run(spark, [ev])
    assert row.validation_errors == (
        "missing_event_id,invalid_event_type,missing_user_id,missing_session_id,bad_ingest_time,bad_event_time"
    )


def test_malformed_json_keeps_row(spark):
    [row] = run(spark, ["{not json"])
    assert row.validation_errors == (
        "missing_event_id,invalid_event_type,missing_user_id,missing_session_id,bad_ingest_time,bad_event_time"
    )


def test_bad_field_types_null_only_that_field(spark):
    evs = [
        json.dumps(base_event(**CART)).replace('"quantity": 2', '"quantity": 1.5'),
        json.dumps(base_event(**CART)).replace('"quantity": 2', '"quantity": "x"'),
        json.dumps(base_event(**CART)).replace('"quantity": 2', '"quantity": 3000000000'),
    ]
    rows = run(spark, evs)
    for r in rows:
        assert r.quantity is None and r.price == 39.99 and r.event_id == "8d51b9e7"
        assert r.validation_errors == "add_to_cart_requires_qty_price_currency"


def test_time_parse_fallbacks(spark):
    times = [
        "2026-01-24T13:05:12.123Z",
        "2026-01-24T13:05:12Z",
        "2026-01-24T15:05:12.123+02:00",
        "2026-01-24 13:05:12",
        "garbage",
    ]
    payloads = [json.dumps(base_event(event_time=t)) for t in times]
    v = validate(to_bronze(envelope_rows(spark, payloads)))
    got = [
        r.t
        for r in v.orderBy("kafka_offset")
        .select(F.date_format("event_time_ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("t"))
        .collect()
    ]
    assert got == [
        "2026-01-24 13:05:12.123",
        "2026-01-24 13:05:12.000",
        "2026-01-24 13:05:12.123",
        "2026-01-24 13:05:12.000",
        None,
    ]


def test_split_is_partition_of_input(spark):
    from core_helpers import SF001
    from kpipulse.plans import pipeline as P

    v = P.validated(spark, SF001).cache()
    n = v.count()
    nq = quarantine(v).count()
    nv = valid_rows(v).count()
    assert nq + nv == n == 1020
    assert (nq, nv) == (105, 915)
    # valid iff no reasons
    assert v.filter((F.col("validation_errors") == "") != F.col("is_valid")).count() == 0
    # bad ingest time lands in the null partition
    q = quarantine(v).filter(F.col("validation_errors").contains("bad_ingest_time"))
    assert q.filter(F.col("ingest_date").isNotNull()).count() == 0
    v.unpersist()


def test_lineage_projection_from_broker_rows(spark):
    """Binary key / value and broker metadata -> the envelope columns."""
    import datetime as dt

    from kpipulse.operators.bronze import lineage_projection

    raw = spark.createDataFrame(
        [(bytearray(b"user_0001"), bytearray(json.dumps(base_event()).encode()), "ecom.events.raw.v1", 2, 41, dt.datetime(2026, 1, 24, 13, 5))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    env = lineage_projection(raw)
    assert env.columns == ["kafka_key", "raw_json", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]
    b = to_bronze(env).collect()[0]
    assert (b.kafka_key, b.kafka_partition, b.kafka_offset, b.event_id) == ("user_0001", 2, 41, "8d51b9e7")
    assert b.ingest_hour == 13 and str(b.ingest_date) == "2026-01-24"
