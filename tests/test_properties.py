"""Randomised properties: random payloads through parse -> rules -> KPIs."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from core_helpers import envelope_rows
from kpipulse.operators.bronze import to_bronze
from kpipulse.operators.kpis import kpis_wide
from kpipulse.operators.validate import quarantine, valid_rows, validate

TYPES = ["click", "add_to_cart", "checkout", "purchase", "refund", None]
TIMES = ["2026-01-24T13:05:12.123Z", "2026-01-24T13:06:00Z", "2026-01-24T14:00:59.999Z", "nope", None]

event = st.fixed_dictionaries(
    {
        "event_id": st.one_of(st.none(), st.text("abc", min_size=1, max_size=3)),
        "event_type": st.sampled_from(TYPES),
        "event_time": st.sampled_from(TIMES),
        "ingest_time": st.sampled_from(TIMES[:3] + ["bad"]),
        "user_id": st.one_of(st.none(), st.just("u1")),
        "session_id": st.one_of(st.none(), st.just("s1")),
        "product_id": st.one_of(st.none(), st.just("p1")),
        "quantity": st.one_of(st.none(), st.integers(-2, 3)),
        "price": st.one_of(st.none(), st.sampled_from([-1.5, 0.0, 2.25, 10.0])),
        "currency": st.one_of(st.none(), st.just("EUR")),
        "order_id": st.one_of(st.none(), st.just("o1")),
    }
)


def expected_codes(e):
    """Per-row Python statement of the nine rules (documented semantics)."""
    t = e["event_type"]
    ok_time = lambda s: s is not None and s not in ("nope", "bad")
    qty_ok = e["quantity"] is not None and e["quantity"] >= 1
    price_ok = e["price"] is not None and e["price"] >= 0
    codes = []
    if e["event_id"] is None:
        codes.append("missing_event_id")
    if t not in ("click", "add_to_cart", "checkout", "purchase"):
        codes.append("invalid_event_type")
    if e["user_id"] is None:
        codes.append("missing_user_id")
    if e["session_id"] is None:
        codes.append("missing_session_id")
    if not ok_time(e["ingest_time"]):
        codes.append("bad_ingest_time")
    if not ok_time(e["event_time"]):
        codes.append("bad_event_time")
    if t in ("click", "add_to_cart") and e["product_id"] is None:
        codes.append("product_id_required_for_click_or_cart")
    if t == "add_to_cart" and not (qty_ok and price_ok and e["currency"] is not None):
        codes.append("add_to_cart_requires_qty_price_currency")
    if t == "purchase" and not (e["order_id"] is not None and qty_ok and price_ok and e["currency"] is not None):
        codes.append("purchase_requires_order_qty_price_currency")
    return ",".join(codes)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=25))
def test_rules_split_and_kpis(spark, events):
    v = validate(to_bronze(envelope_rows(spark, [json.dumps(e) for e in events]))).cache()
    rows = v.orderBy("kafka_offset").select("validation_errors", "is_valid").collect()
    assert [r.validation_errors for r in rows] == [expected_codes(e) for e in events]
    assert all(r.is_valid == (r.validation_errors == "") for r in rows)
    good, bad = valid_rows(v), quarantine(v)
    n_good, n_bad = good.count(), bad.count()
    assert n_good + n_bad == len(events)
    k = kpis_wide(good, "1 minute").agg(
        F.sum("events_total").alias("t"),
        F.sum(F.col("events_click") + F.col("events_add_to_cart") + F.col("events_checkout") + F.col("events_purchase")).alias("s"),
    ).collect()[0]
    assert (k.t or 0) == n_good == (k.s or 0)
    v.unpersist()
