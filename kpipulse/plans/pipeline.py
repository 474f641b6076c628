"""Batch plans: the stages chained over a table folder.

Nothing is collected. A plan that needs a derived table (Bronze, the KPI
tables) reads it from the folder named with ``use_tables``, or writes its own
first; from there on Catalyst sees the whole chain (scan -> projections ->
aggregate), prunes the scan to the columns each plan needs and pushes filters
into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.bronze import to_bronze
from ..operators.dedupe import dedupe
from ..operators.kpis import kpis_long, kpis_wide
from ..operators.validate import default_rules, quarantine, valid_rows, validate
from ..sources.fixture import contract_events


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(contract_events(spark, sf_dir))


def use_tables(spark: SparkSession, sf_dir: str, path: str | None) -> None:
    """Name the folder whose stored tables (``prepare``) the plans over
    ``sf_dir`` read; None: every plan builds what it needs from the source."""
    key = f"kpipulse.tables.{sf_dir.rstrip('/')}"
    if path is None:
        spark.conf.unset(key)
    else:
        spark.conf.set(key, path.rstrip("/"))


def table(spark: SparkSession, sf_dir: str, name: str, build, writer=None) -> DataFrame:
    """A derived table: read from the folder the caller has named with
    ``use_tables``, else built, written to scratch and read back by this plan
    alone. ``writer(df, path)`` sets the storage layout (default: parquet)."""
    named = spark.conf.get(f"kpipulse.tables.{sf_dir.rstrip('/')}", None)
    return spark.read.parquet(f"{named}/{name}" if named else write_table(build(), name, writer))


def prepare(spark: SparkSession, sf_dir: str, path: str, tables: dict) -> None:
    """Write the derived ``tables`` (name -> (build, writer)) of ``sf_dir``
    under ``path`` in order, each from the ones before, and name the folder."""
    use_tables(spark, sf_dir, path)
    for name, (build, writer) in tables.items():
        write = writer or (lambda df, to: df.write.mode("overwrite").parquet(to))
        write(build(spark, sf_dir), f"{path.rstrip('/')}/{name}")


def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Bronze table, written and read back (as the streaming Bronze sink
    does). Silver's filters then reach a parquet scan of Bronze columns instead
    of being pushed through the JSON parse, where Catalyst would copy
    ``from_json`` into every predicate that reads a parsed field."""
    return table(spark, sf_dir, "bronze", lambda: bronze(spark, sf_dir))


def validated(spark: SparkSession, sf_dir: str, null_type: str = "invalid") -> DataFrame:
    return validate(stored_bronze(spark, sf_dir), default_rules(null_type))


def quarantined(spark: SparkSession, sf_dir: str, null_type: str = "invalid") -> DataFrame:
    return quarantine(validated(spark, sf_dir, null_type))


DEDUPE_ORDER = ("kafka_partition", "kafka_offset")


def silver(spark: SparkSession, sf_dir: str, null_type: str = "invalid", cols: tuple[str, ...] | None = None) -> DataFrame:
    """Valid rows, one per event id (first delivery wins).

    With ``cols`` only those columns (plus the key and the delivery order)
    travel through the dedupe shuffle; the surviving copy is the same.
    """
    valid = valid_rows(validated(spark, sf_dir, null_type))
    if cols is not None:
        keep = list(dict.fromkeys(["event_id", *DEDUPE_ORDER, *cols]))
        valid = valid.select(*keep)
    return dedupe(valid, "event_id", list(DEDUPE_ORDER))


KPI_INPUT = ("event_time_ts", "ingest_time_ts", "event_type", "price", "quantity")


def gold_wide(spark: SparkSession, sf_dir: str, width: str = "1 minute") -> DataFrame:
    return kpis_wide(silver(spark, sf_dir, cols=KPI_INPUT), width)


def gold(spark: SparkSession, sf_dir: str, width: str = "1 minute") -> DataFrame:
    """The KPI table ``(window_start, metric, value)`` at ``width``."""
    return kpis_long(silver(spark, sf_dir, cols=KPI_INPUT), width)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder."""
    from ..session import scratch_dir

    return scratch_dir(spark, name)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a parquet table in a fresh folder under the session's
    ``spark.checkpoint.dir`` and read it back.

    Used where a derived table (Bronze, the KPI table) feeds later stages or
    several branches: they scan stored rows instead of re-running the upstream
    plan, lineage is cut, and unlike an RDD checkpoint the read-back is a
    parquet scan, so column pruning and filter pushdown still apply.
    """
    return df.sparkSession.read.parquet(write_table(df, name))


def write_table(df: DataFrame, name: str = "table", writer=None) -> str:
    """Write ``df`` as parquet into a fresh folder under the checkpoint folder
    (with ``writer(df, path)`` when given); return the folder."""
    from ..session import scratch_dir

    path = scratch_dir(df.sparkSession, name)
    if writer is None:
        df.write.mode("overwrite").parquet(path)
    else:
        writer(df, path)
    return path
