"""Dedupe by key: batch twin of the streaming ``dropDuplicates``.

Keeps, per key, the row with the least ordering tuple (by default broker
``(kafka_partition, kafka_offset)``: the first delivery wins). Expressed as
``row_number() = 1``, which Spark plans with a group limit on either side of the
shuffle: each task drops all but the first row of a key before it, so copies of
a hot key collapse map-side and one row per key and task crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: list[str] | str = "event_id", order: list[str] | None = None) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = ["kafka_partition", "kafka_offset"] if order is None else list(order)
    # the other columns break ties, so the choice is total and deterministic
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")
