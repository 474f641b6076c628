"""Streaming cooldown as keyed state: candidates -> alerts.

The candidates of a metric arrive in the order of their windows, micro-batch by
micro-batch. For each metric the state store holds the time of its last alert
(the clock) and the newest candidate seen; a warning passes when the clock is a
cooldown old, a critical always, and either sets the clock. The clock starts
from the newest stored alert per metric (the initial state of a new
checkpoint); after that the alert table is never read. A timer at the clock
plus the cooldown evicts the state: from then on everything passes anyway, and
older candidates are late.

Rows at or before the newest seen are repeats of a replayed batch and dropped;
with the file sink's own log each alert is stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..contract import SEVERITY_CRITICAL, DetectorParams

CANDIDATE_SCHEMA = (
    "metric string, window_start timestamp, value double, baseline double, mu double, sigma double, z double, severity string"
)


def _processor(cooldown_s: int, critical: str, columns: list[str]) -> StatefulProcessor:
    """A processor made of local names only, so that workers need not import
    this package."""
    import pandas as pd

    class Cooldown(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.clock = handle.getValueState("clock", "last bigint, seen bigint")

        def _set(self, last: int | None, seen: int | None) -> None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.clock.update((last, seen))
            until = max(x for x in (last, seen) if x is not None)
            self.handle.registerTimer(until // 1_000 + cooldown_s * 1_000)

        def handleInitialState(self, key, initialState, timerValues) -> None:
            last = initialState["last_us"].max()
            if pd.notna(last):
                self._set(int(last), None)

        def handleInputRows(self, key, rows, timerValues):
            last, seen = self.clock.get() if self.clock.exists() else (None, None)
            batch = pd.concat(list(rows)).sort_values(["us", "severity"])
            keep = []
            for us, severity in zip(batch["us"].tolist(), batch["severity"].tolist()):
                fresh = seen is None or us > seen
                emit = fresh and (severity == critical or last is None or us - last >= cooldown_s * 1_000_000)
                if emit:
                    last = us if last is None else max(last, us)
                seen = us if fresh else seen
                keep.append(emit)
            if seen is not None or last is not None:
                self._set(last, seen)
            yield batch.loc[keep, columns]

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.clock.clear()
            return iter(())

        def close(self) -> None:
            pass

    return Cooldown()


def keyed_cooldown(candidates: DataFrame, p: DetectorParams, seeds: DataFrame) -> DataFrame:
    """The candidates of a stream (``CANDIDATE_SCHEMA``) that the cooldown lets
    pass. ``seeds``: ``metric, last_window_start`` of the stored alerts."""
    if p.cooldown_s <= 0:
        return candidates
    columns = candidates.columns
    micros = F.unix_micros("window_start")
    stream = candidates.withWatermark("window_start", "0 seconds").withColumn("us", micros)
    first = seeds.select("metric", F.unix_micros(F.col("last_window_start").cast("timestamp")).alias("last_us"))
    return stream.groupBy("metric").transformWithStateInPandas(
        _processor(p.cooldown_s, SEVERITY_CRITICAL, columns),
        outputStructType=candidates.schema,
        outputMode="append",
        timeMode="eventTime",
        initialState=first.groupBy("metric"),
    )
