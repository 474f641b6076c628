"""Progress of streaming queries as a table (ST1, ST9).

A listener writes one record per micro-batch: rows read, rows that a stateful
operator dropped as late, state rows and bytes, and the metrics that the query
observes (``observe_rules``: how often each validation rule fired, counted in
the stream itself). A record's file is named by query and batch, so a replayed
batch overwrites its own. ``read_progress`` gives the records as a DataFrame.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.validate import Rule
from ..sources import files as FS

SCHEMA = (
    "query string, batch_id bigint, at string, n_input bigint, n_late bigint, state_rows bigint, state_bytes bigint, "
    "watermark string, observed map<string, map<string, bigint>>"
)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every query of the session under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # events arrive after the batch: wait for those that are on their way
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        body = {
            "query": str(p.id),
            "batch_id": p.batchId,
            "at": p.timestamp,
            "n_input": p.numInputRows,
            "n_late": sum(op.numRowsDroppedByWatermark for op in p.stateOperators),
            "state_rows": sum(op.numRowsTotal for op in p.stateOperators),
            "state_bytes": sum(op.memoryUsedBytes for op in p.stateOperators),
            "watermark": (p.eventTime or {}).get("watermark"),
            "observed": {name: {k: v or 0 for k, v in row.asDict().items()} for name, row in (p.observedMetrics or {}).items()},
        }
        # an idle batch repeats the number of the last one: keep the record that read rows
        name = f"{self.path}/{body['query']}-{p.batchId:012d}.json"
        if p.numInputRows or not FS.exists(self.spark, name):
            FS.write_text(self.spark, name, json.dumps(body))


def read_progress(spark: SparkSession, path: str, query_id: str | None = None) -> DataFrame:
    """The records, one per query and micro-batch."""
    if not FS.child_files(spark, path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).json(path)
    return rows if query_id is None else rows.filter(F.col("query") == F.lit(str(query_id)))


OBSERVED = "rules"


def observe_rules(validated: DataFrame, rules: list[Rule]) -> DataFrame:
    """``validated`` with an observation of its rows and of the rows in which
    each rule fired: the counts come with a query's progress, no second scan."""
    codes = F.split("validation_errors", ",")
    fired = [F.count_if(F.array_contains(codes, r.code)).alias(r.code) for r in rules]
    return validated.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), *fired)


def rule_counts(progress: DataFrame) -> DataFrame:
    """``error_code, n_rows``: the observed counts of all batches."""
    each = progress.select(F.explode(F.col("observed")[OBSERVED]).alias("error_code", "n"))
    return each.filter("error_code != 'rows' AND n > 0").groupBy("error_code").agg(F.sum("n").alias("n_rows"))
