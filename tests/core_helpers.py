"""Constants and builders shared by the core tests (conftests hold fixtures
only, so that no module name clashes with another folder's conftest)."""

import datetime as dt
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def envelope_rows(spark, payloads, partition=0, start_offset=0):
    """Envelope DataFrame from raw JSON payload strings."""
    from kpipulse.contract import ENVELOPE_SCHEMA

    rows = [
        ("k", p, "ecom.events.raw.v1", partition, start_offset + i, dt.datetime(2026, 1, 24, 13, 0, 0))
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)
