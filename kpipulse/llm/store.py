"""Stored intermediate tables and sizing, shared by the operators.

A table that several branches read, or that ends a costly stage, is written
to the shared checkpoint folder of the session and read back: lineage is cut
and a lost executor costs no recomputation.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.pipeline import materialize


def stored(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, f"llm-{name}")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts (one aggregate over the text column)."""
    return docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def chunks_for(spark: SparkSession, n_bytes: int, chunk_bytes: int = 16 << 20) -> int:
    """How many chunks of about ``chunk_bytes`` the texts make, and at least
    one per shuffle partition."""
    return max(shuffle_width(spark), math.ceil(n_bytes / chunk_bytes))
