"""Versioned KPI storage with a manifest and compaction (K5 for streams).

Layout under one folder::

    run=<r>/batch=<b>/window_date=<d>/   rows of one micro-batch (a version)
    _base/at=<n>/window_date=<d>/        merged rows of a date, one sorted file
    _manifest/<n>.json                   what the table is after commit n

A micro-batch writes its own folder and then commits it: the manifest lists the
versions not yet merged (with their dates) and, for each date, the base folder
that holds it. A batch that is already committed writes nothing, so a replay
changes nothing. After ``compact_every`` versions they are merged: for each
date they touch, the newest rows of each window become the date's new base
folder, and the manifest forgets the versions. So a read opens one file per
date and those of a bounded number of versions, however long the stream has
run. Underscore folders are hidden from file streams: a stream over the table
sees each version once and never a merged file.

Folders that a merge has replaced stay for ``retain_s`` seconds, for readers
that were planned before it and streams that have yet to see them, and are
then removed by a later merge.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from ..sources import files as FS
from ..sources.log import CommitLog

ROW_FIELDS = [
    StructField("window_start", TimestampType(), True),
    StructField("metric", StringType(), True),
    StructField("value", DoubleType(), True),
]
DATE_FIELD = StructField("window_date", DateType(), True)
VERSION_SCHEMA = StructType([*ROW_FIELDS, StructField("run", IntegerType(), True), StructField("batch", IntegerType(), True), DATE_FIELD])
BASE_SCHEMA = StructType([*ROW_FIELDS, StructField("at", IntegerType(), True), DATE_FIELD])
COLUMNS = ("window_start", "metric", "value", "window_date")
RETAIN_S = 24 * 3600


def write_dated(kpi: DataFrame, path: str, mode: str = "overwrite") -> None:
    """KPI rows partitioned by ``window_date``, one file per date, sorted by
    ``(metric, window_start)``: range and latest reads prune by partition and
    by row-group statistics.

    Rows of a date meet in one task (a date of one-minute KPIs is 14,400
    rows), and the sort leads with the date because the partitioned write
    needs it: the order inside is then kept.
    """
    dated = kpi.withColumn("window_date", F.to_date("window_start"))
    rows = dated.repartition("window_date").sortWithinPartitions("window_date", "metric", "window_start")
    rows.write.mode(mode).partitionBy("window_date").parquet(path)


class ConstraintError(ValueError):
    """A write that would break a table's key or NOT NULL constraint."""


@dataclass
class Version:
    run: int
    batch: int
    dates: list[str]


@dataclass
class Snapshot:
    """The table after a commit: the newest ``(run, batch)`` committed, the
    versions that are not merged, the base map's file and its folders that
    wait for removal."""

    newest: tuple[int, int] = (-1, -1)
    versions: list[Version] = field(default_factory=list)
    base: int = 0
    replaced: list[tuple[str, float]] = field(default_factory=list)

    @classmethod
    def of(cls, body: dict) -> Snapshot:
        return cls(tuple(body["newest"]), [Version(**v) for v in body["versions"]], body["base"], [tuple(x) for x in body["replaced"]])


class KpiStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/_manifest")

    # ------------------------------------------------------------ manifest --
    def snapshot(self) -> tuple[int, Snapshot]:
        """Number and content of the newest commit (0 and empty before any)."""
        last = self.log.last()
        return (0, Snapshot()) if last is None else (last[0], Snapshot.of(last[1]))

    def base_map(self, n: int) -> dict[str, int]:
        """Date -> merge that wrote its base folder, as of merge ``n``."""
        text = FS.read_text(self.spark, self._map_file(n)) if n else None
        return json.loads(text) if text else {}

    def _map_file(self, n: int) -> str:
        return f"{self.path}/_manifest/base-{n:012d}.map"

    def _version_folder(self, v: Version, day: str = "") -> str:
        return f"{self.path}/run={v.run}/batch={v.batch}" + f"/window_date={day}" * bool(day)

    def _base_folder(self, n: int, day: str) -> str:
        return f"{self.path}/_base/at={n}/window_date={day}"

    # --------------------------------------------------------------- write --
    def commit(self, batch: DataFrame, run: int, batch_id: int, compact_every: int | None = None, retain_s: float = RETAIN_S) -> bool:
        """Add a micro-batch; False if it (or a later one) is committed already."""
        n, snap = self.snapshot()
        if (run, batch_id) <= snap.newest:
            return False
        version = Version(run, batch_id, [])
        write_dated(batch.select("window_start", "metric", "value"), self._version_folder(version))
        self._check(version)
        version.dates = sorted(d.removeprefix("window_date=") for d in FS.child_dirs(self.spark, self._version_folder(version)))
        snap.newest = (run, batch_id)
        if version.dates:  # an empty batch is recorded, but adds nothing to read
            snap.versions.append(version)
        self.log.append(n + 1, asdict(snap))
        if compact_every and len(snap.versions) >= compact_every:
            self.compact(retain_s)
        return True

    def _check(self, version: Version) -> None:
        """Key and NOT NULL of a version that is written but not committed: a
        batch that breaks them is refused, and the table stays as it is."""
        if not FS.child_dirs(self.spark, self._version_folder(version)):
            return
        rows = self.spark.read.schema(VERSION_SCHEMA).option("basePath", self.path).parquet(self._version_folder(version))
        nulls = F.count_if(F.col("window_start").isNull() | F.col("metric").isNull() | F.col("value").isNull())
        per_key = rows.groupBy("window_start", "metric").agg(F.count(F.lit(1)).alias("n"), nulls.alias("nulls"))
        found = per_key.agg(F.count_if(F.col("n") > 1).alias("twice"), F.sum("nulls").alias("nulls")).first()
        if found["twice"] or found["nulls"]:
            FS.delete(self.spark, self._version_folder(version))
            raise ConstraintError(f"batch {version.batch}: {found['twice']} keys occur twice, {found['nulls']} rows have nulls")

    def compact(self, retain_s: float = RETAIN_S) -> None:
        """Merge all versions into the base folders of the dates they touch."""
        n, snap = self.snapshot()
        now = time.time()
        if snap.versions:
            old = self.base_map(snap.base)
            days = sorted({d for v in snap.versions for d in v.dates})
            write_dated(self._current(snap.versions, {d: old[d] for d in days if d in old}), f"{self.path}/_base/at={n + 1}")
            FS.write_text(self.spark, self._map_file(n + 1), json.dumps(old | dict.fromkeys(days, n + 1)))
            gone = [self._version_folder(v) for v in snap.versions] + [self._base_folder(old[d], d) for d in days if d in old]
            gone += [self._map_file(snap.base)] if snap.base else []
            snap.versions, snap.base = [], n + 1
            snap.replaced += [(folder.removeprefix(f"{self.path}/"), now) for folder in gone]
        due = [x for x in snap.replaced if x[1] <= now - retain_s]
        snap.replaced = [x for x in snap.replaced if x[1] > now - retain_s]
        self.log.append(n + 1, asdict(snap))
        # only after the commit: until then the old manifest names them
        for folder, _ in due:
            FS.delete(self.spark, f"{self.path}/{folder}")

    # ---------------------------------------------------------------- read --
    def read(self, first: date | datetime | None = None, last: date | datetime | None = None) -> DataFrame:
        """Current KPI rows (``window_start, metric, value, window_date``), of
        the dates from ``first`` to ``last`` when given: other dates' folders
        are not even listed. An empty table before the first batch."""
        _, snap = self.snapshot()
        low, high = (None if d is None else d.strftime("%Y-%m-%d") for d in (first, last))
        inside = lambda d: (low is None or d >= low) and (high is None or d <= high)
        versions = [Version(v.run, v.batch, days) for v in snap.versions if (days := [d for d in v.dates if inside(d)])]
        return self._current(versions, {d: n for d, n in self.base_map(snap.base).items() if inside(d)})

    def days(self) -> list[str]:
        """The dates that hold rows, ascending (from the manifest alone)."""
        _, snap = self.snapshot()
        return sorted({d for v in snap.versions for d in v.dates} | set(self.base_map(snap.base)))

    def _parquet(self, schema: StructType, base: str, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders)

    def _current(self, versions: list[Version], base: dict[str, int]) -> DataFrame:
        """Per window, the rows of its newest version, else of its base."""
        parts = []
        touched = {d for v in versions for d in v.dates}
        still = [self._base_folder(n, d) for d, n in base.items() if d not in touched]
        if still:
            parts.append(self._parquet(BASE_SCHEMA, f"{self.path}/_base", still))
        if versions:
            folders = [self._version_folder(v, d) for v in versions for d in v.dates]
            newest = newest_versions(self._parquet(VERSION_SCHEMA, self.path, folders))
            if under := [self._base_folder(n, d) for d, n in base.items() if d in touched]:
                # windows that a version rewrites lose all their old metrics
                old = self._parquet(BASE_SCHEMA, f"{self.path}/_base", under)
                parts.append(old.join(newest.select("window_start").distinct(), "window_start", "left_anti"))
            parts.append(newest)
        if not parts:
            return self.spark.createDataFrame([], StructType([*ROW_FIELDS, DATE_FIELD]))
        out = parts[0].select(*COLUMNS)
        for part in parts[1:]:
            out = out.unionByName(part.select(*COLUMNS))
        return out


def newest_versions(raw: DataFrame) -> DataFrame:
    """Per window, the rows of its newest ``(run, batch)``."""
    ver = F.struct(F.col("run").cast("long"), F.col("batch").cast("long"))
    w = Window.partitionBy("window_start", "window_date")
    newest = raw.withColumn("_v", ver).withColumn("_m", F.max("_v").over(w)).filter(F.col("_v") == F.col("_m"))
    return newest.select(*COLUMNS)
