"""Idempotent table writers and key checks (K5-K8).

* ``replace_windows``: the new rows of a batch replace **all** metrics of the
  windows they touch (anti join on ``window_start`` + union). Applying the same
  batch twice gives the same table.
* ``insert_if_absent``: new alerts are added only when their id is not in the
  table; duplicates inside the batch collapse to one deterministic row.
* ``versioned`` KPI storage for streams (``kpi_store``): each micro-batch is a
  version in a manifest, versions are merged into one file per date; the
  reader keeps, per window, the rows of the greatest ``(run, batch)``. No
  driver collect, no transaction needed.
* ``duplicate_keys`` / ``null_keys``: constraint checks as DataFrames that
  must come back empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources import files as FS
from .dedupe import dedupe
from .kpi_store import RETAIN_S, ConstraintError, KpiStore
from .kpi_store import VERSION_SCHEMA as KPI_VERSION_SCHEMA
from .kpi_store import write_dated as write_kpi_table

__all__ = [
    "KPI_VERSION_SCHEMA",
    "ConstraintError",
    "checked_append",
    "constraint_report",
    "duplicate_keys",
    "insert_if_absent",
    "null_keys",
    "read_versioned",
    "replace_windows",
    "violations",
    "with_created_at",
    "write_kpi_table",
    "write_versioned_batch",
]


def replace_windows(table: DataFrame, batch: DataFrame, key: str = "window_start") -> DataFrame:
    touched = batch.select(key).distinct()
    kept = table.join(touched, key, "left_anti")
    return kept.unionByName(batch.select(*table.columns))


def insert_if_absent(table: DataFrame, new: DataFrame, key: str = "alert_id", order: list[str] | None = None) -> DataFrame:
    cols = table.columns
    order = order or [c for c in cols if c != key]
    fresh = dedupe(new.select(*cols), key, order)
    return table.unionByName(fresh.join(table.select(key), key, "left_anti").select(*cols))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def with_created_at(alerts: DataFrame) -> DataFrame:
    """Server-side default: ``created_at`` is the write time when missing."""
    if "created_at" in alerts.columns:
        return alerts.withColumn("created_at", F.coalesce(F.col("created_at"), F.current_timestamp()))
    return alerts.withColumn("created_at", F.current_timestamp())


def write_versioned_batch(
    batch: DataFrame, path: str, run: int, batch_id: int, compact_every: int | None = None, retain_s: float = RETAIN_S
) -> None:
    """Commit one micro-batch of KPI rows to the table's manifest (a batch that
    is committed already changes nothing); after ``compact_every`` versions
    merge them into one file per date."""
    KpiStore(batch.sparkSession, path).commit(batch, run, batch_id, compact_every, retain_s)


def read_versioned(spark, path: str) -> DataFrame:
    """Current KPI rows: per window, the rows of the newest ``(run, batch)``;
    an empty table before the first batch. A reader follows the manifest it
    has seen; what a merge replaces stays for the retention time."""
    return KpiStore(spark, path).read()


def violations(new: DataFrame, keys: list[str], not_null: tuple[str, ...] = (), there: DataFrame | None = None) -> DataFrame:
    """One row per broken key of ``new``: the key, ``n`` (rows of the key in
    ``new``, and one if it is in the table ``there``) and ``n_nulls`` (rows
    with a null in a key or a ``not_null`` column). Empty when all is well."""
    null_any = reduce(lambda a, c: a | F.col(c).isNull(), (*keys, *not_null), F.lit(False))
    counted = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(null_any, 1).otherwise(0)).alias("n_nulls"))
    if there is not None:
        known = there.select(*keys).distinct().withColumn("_there", F.lit(1))
        counted = counted.join(known, keys, "left").withColumn("n", F.col("n") + F.coalesce("_there", F.lit(0))).drop("_there")
    return counted.filter((F.col("n") > 1) | (F.col("n_nulls") > 0))


def checked_append(new: DataFrame, path: str, keys: list[str], not_null: tuple[str, ...], writer, day: str = "window_start") -> int:
    """Append ``new`` to the table at ``path`` with ``writer(df, path)``, or
    raise ``ConstraintError`` and leave the table as it is.

    The rows are staged once (hidden beside the table) with an observation that
    counts rows and nulls on the way; keys are checked against the staged rows
    and the table's partitions of the dates that they touch, no others. Returns
    the number of rows appended."""
    spark = new.sparkSession
    stage = f"{path.rstrip('/')}.staged"
    null_any = reduce(lambda a, c: a | F.col(c).isNull(), (*keys, *not_null), F.lit(False))
    seen = Observation()
    counts = (F.count(F.lit(1)).alias("rows"), F.count_if(null_any).alias("nulls"), F.min(day).alias("lo"), F.max(day).alias("hi"))
    new.observe(seen, *counts).write.mode("overwrite").parquet(stage)
    found = seen.get
    staged = spark.read.schema(new.schema).parquet(stage)
    try:
        if found["nulls"]:
            raise ConstraintError(f"{found['nulls']} rows have a null in {', '.join((*keys, *not_null))}")
        there = None
        if found["rows"] and FS.exists(spark, path):
            table = spark.read.parquet(path)
            there = table.filter(F.col("window_date").between(F.to_date(F.lit(found["lo"])), F.to_date(F.lit(found["hi"]))))
        broken = violations(staged, keys, not_null, there).limit(3).collect()
        if broken:
            raise ConstraintError(f"keys that are not unique: {[tuple(r[k] for k in keys) for r in broken]}")
        if found["rows"]:
            writer(staged, path)
        return found["rows"]
    finally:
        FS.delete(spark, stage)


def constraint_report(df: DataFrame, keys: list[str], not_null: list[str]) -> DataFrame:
    """One row: ``n_rows``, ``n_keys`` (distinct key tuples) and
    ``n_null_values`` (rows with a null in ``not_null``). A table meets its
    primary key when ``n_rows == n_keys``. Partial aggregates throughout:
    the distinct count shuffles key tuples once, not rows to one task."""
    null_any = F.lit(False)
    for c in not_null:
        null_any = null_any | F.col(c).isNull()
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(null_any, 1).otherwise(0)).alias("_nulls")
    )
    return per_key.agg(
        F.sum("_n").cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("_nulls").cast("long").alias("n_null_values"),
    )
